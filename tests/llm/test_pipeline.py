import corpus_pipeline as P

DIR = "/root/testdata/sf0.001"


def test_stages_keep_their_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    counts = [docs.count()]
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, DIR)
        out.write.parquet(str(tmp_path / str(k)))
        if k < len(P.STAGES) - 1:
            assert out.columns == docs.columns
            docs = spark.read.parquet(str(tmp_path / str(k)))
            counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert {r.doc_id for r in spark.read.parquet(str(tmp_path / "3")).collect()} == {r.doc_id for r in docs.collect()}


def test_copies_and_strange_rows(spark):
    long = " ".join(f"word{i}" for i in range(80))
    rows = [(5, long, "en", "a", 1), (2, long, "en", "a", 1), (None, long, "en", "a", 1), (7, long + " end", "en", "a", 1), (9, "other " + " ".join(f"x{i}" for i in range(60)), None, None, None), (9, None, "en", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = P.drop_copies(spark, df, DIR).collect()
    assert sorted((r.doc_id or -1, r.text is None) for r in kept) == [(2, False), (9, False), (9, True)]
    for _, stage in P.STAGES:
        assert stage(spark, df.limit(0), DIR).collect() == []
    more = df.selectExpr("*", "1 AS accepted", "2 AS toxicity", "3 AS frame_id", "4 AS n_words")
    assert P.keep_quality(spark, more, DIR).columns == more.columns and P.drop_copies(spark, more, DIR).count() == 3
    clean = P.keep_quality(spark, df, DIR).collect()
    assert sum(r.text == long for r in clean) == 3 and all(r.text for r in clean)


def test_copies_by_fingerprint_and_by_similarity(spark):
    base = [f"word{i}" for i in range(400)]
    line = " ".join(f"same{i}" for i in range(8)) + "\n"
    # shingles of the repeated lines outweigh the ends in the fingerprints, not in the sets of shingles
    weight = [line * 60 + " ".join(f"{e}{i}" for i in range(9)) for e in "ab"]
    edited = [base, base[:200] + ["changed"] + base[201:], base[:100] + ["other", *base[101:180], "new", *base[181:300], "more"] + base[301:]]
    texts = [*weight, *(" ".join(t) for t in edited), " ".join(f"far{i}" for i in range(50)), "", None]
    df = spark.createDataFrame([(10 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    coded = P.H.caption_phash(df, "text", words=5).collect()
    bits = lambda i, j: ((coded[i].phash ^ coded[j].phash) & (2**64 - 1)).bit_count()
    assert 0 < bits(0, 1) <= 4 < bits(2, 4)
    groups = {(r.row, r.group) for r in P.N.near_texts(df.select(df.doc_id.alias("row"), "text")).collect()}
    assert (11, 11) in groups and (14, 12) in groups
    assert sorted(r.doc_id for r in P.drop_copies(spark, df, DIR).collect()) == [10, 12, 15, 16]
