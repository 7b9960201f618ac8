import re
from collections import Counter

from pyspark.sql import functions as F

from scenequarry.llm import decision_lists as D

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    t = text or ""
    w = WORD.findall(t)
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(wins)
    inside = {j for i, x in enumerate(wins) if n[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))


def test_counts_equal_brute_force(spark):
    texts = [None, "", " \n\t ", "a", "a a a a", "a b c a b c", "x y z\nx y z\n\n \nx y z", "a b c d a b c e f b c d", "#$% 🙂 <a|b> É", "  w\x0bv", "p q r " * 20_000, " lead and trail "]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "frame_id long, caption string, n_words long")
    got = {r.frame_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in D.caption_metrics(df).collect()}
    assert got == {i: slow(t) for i, t in enumerate(texts)}


def test_list_finds_planted_rules(spark, rng):
    rows = []
    for i in range(900):
        blur, exposure, coverage = rng.random(3).tolist()
        good = int(not (blur > 0.8 and exposure < 0.5 or coverage < 0.1))
        rows.append((i, blur, exposure, coverage, good if i % 10 else None))
    df = spark.createDataFrame(rows, "frame_id long, blur double, exposure double, coverage double, accepted int")
    measures = {c: F.col(c) for c in ("blur", "exposure", "coverage")}
    rules = D.fit_decision_list(df, measures)
    got = df.filter("accepted IS NOT NULL").select("accepted", rules.verdict(measures).alias("kept")).collect()
    assert sum(r.kept == bool(r.accepted) for r in got) >= 0.97 * len(got)
    assert rules.text().endswith("else keep") and "coverage <" in rules.text()


def test_empty_and_null_input(spark):
    schema = "frame_id long, blur double, accepted int"
    m = {"blur": F.col("blur")}
    for rows in ([], [(1, None, 0)], [(1, 0.5, 1), (2, 0.7, 1)], [(1, 0.5, None)]):
        df = spark.createDataFrame(rows, schema)
        rules = D.fit_decision_list(df, m)
        assert rules.rules == () and all(r.k for r in df.select(rules.verdict(m).alias("k")).collect())
    rules = D.DecisionList(((D.Threshold("blur", True, 0.5),),))
    df = spark.createDataFrame([(1, None, 0), (2, 0.5, 0), (3, 0.4, 0)], schema)
    assert [r.k for r in df.select(rules.verdict(m).alias("k")).collect()] == [True, False, True]
