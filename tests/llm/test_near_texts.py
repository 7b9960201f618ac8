import corpus_pipeline as P
import numpy as np

from scenequarry.llm import near_texts as N


def slow_set(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def slow_groups(texts):
    sets = [slow_set(t) for t in texts]
    low = list(range(len(texts)))
    links = [(i, j) for i in low for j in range(i) if sets[i] == sets[j] or (sets[i] | sets[j]) and len(sets[i] & sets[j]) * 10 >= 8 * len(sets[i] | sets[j])]
    while True:
        old = list(low)
        for i, j in links:
            low[i] = low[j] = min(low[i], low[j])
        if low == old:
            return low, [len(sets[i] & sets[j]) / max(len(sets[i] | sets[j]), 1) for i, j in links]


def fixture(rng):
    """Texts, their copies with few to many changed words, a large group around one text, and texts that share a passage."""
    word = lambda n: [f"w{x}" for x in rng.integers(0, 3000, n)]
    texts = [None, "", " \t", "One", "one", "a b c d", "A b c d e"]
    for k in range(60):
        base = word(int(rng.integers(8, 400)))
        texts.append(" ".join(base))
        for _ in range(3):
            own = list(base)
            for at in rng.integers(0, len(own), int(rng.integers(1, 2 + len(own) // 40))):
                own[at] = "new" + str(rng.integers(0, 10**6))
            texts.append(" ".join(own[: len(own) - int(rng.integers(0, 1 + len(own) // 25))]))
    base = word(100)
    for k in range(60):
        own = list(base)
        own[int(rng.integers(0, 100))] = f"only{k}"
        texts.append(" ".join(own))
    passage = word(60)
    texts += [" ".join([*word(30), *passage, *word(int(rng.integers(5, 40)))]) for _ in range(40)]
    return texts + texts[10:20]


def test_groups_equal_brute_force(spark, rng):
    texts = fixture(rng)
    want, found = slow_groups(texts)
    assert sum(0.8 <= x < 0.85 for x in found) > 10 and sum(0.85 <= x < 0.95 for x in found) > 50
    df = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    got = {r.row: r.group for r in N.near_texts(df).collect()}
    assert [got[i] for i in range(len(texts))] == want
    docs = df.selectExpr("row AS doc_id", "text", "'en' AS lang", "'a' AS source", "1L AS n_chars")
    assert sorted(r.doc_id for r in P.drop_copies(spark, docs, "").collect()) == sorted(set(want))


def test_given_near_copies_meet(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pairs = [(1, 255), (643, 770), (709, 944), (582, 875), (2, 56)]
    some = docs.filter(docs["doc_id"].isin([x for p in pairs for x in p]))
    assert sorted(r.doc_id for r in P.drop_copies(spark, some, "").collect()) == sorted(min(p) for p in pairs)


def test_prefixes_of_similar_sets_meet(rng):
    for n in (1, 2, 4, 5, 9, 10, 50, 333):
        own = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        common = (own[::3], rng.integers(2, 5, len(own[::3])))
        for _ in range(20):
            gone = rng.permutation(len(own))[: len(own) - N.needed(len(own), 0.8)]
            other = np.delete(own, gone)
            assert N.similar(own, other, 0.8)
            assert len(np.intersect1d(N.prefix(own, common, 0.8), N.prefix(other, common, 0.8)))


def test_no_rows_and_no_words(spark):
    empty = spark.createDataFrame([], "row long, text string")
    assert N.near_texts(empty).count() == 0
    rows = spark.createDataFrame([(3, None), (5, ""), (9, " \n")], "row long, text string")
    assert sorted((r.row, r.group) for r in N.near_texts(rows).collect()) == [(3, 3), (5, 3), (9, 3)]
