import itertools

import numpy as np

from scenequarry.llm import deobfuscation as X

HIDDEN = {"1d10t": "idiot", "m0r0n": "moron", "st*pid": "stupid", "p@thetic": "pathetic", "tr4sh": "trash", "c1own": "clown", "idiooot": "idiot", "l.o.s.e.r": "loser", "m-o-r-o-n": "moron", "sc​um": "scum", "di$gusting": "disgusting"}


def test_readings(letters):
    for token, word in HIDDEN.items():
        assert word in X.readings(token, letters.table), token
    for plain in ("river", "River,", "boat!!", "went%%%", "***the***", "2024", "été", "the", "a", "1,000"):
        assert X.reading(plain, letters.table) == X.WORD.findall(plain.lower()), plain
    assert X.restore("you M 0 R 0 N went", letters.table) == "you moron went"
    assert X.restore("", letters.table) == ""


def test_viterbi_equals_all_paths(letters):
    def paths(reads):
        out = [("", 0.0)]
        for r in reads:
            out = [(t + x, c + y) for t, c in out for x, y in r]
        return out

    def score(text, cost):
        s, a = -cost, (0, 0, 0)
        for ch in text:
            d = X.CODE.get(ch, X.OTHER)
            s += float(letters.table[a][d])
            a = (*a[1:], d)
        return s + float(letters.table[a][0])

    for token in ("1d10t", "w0rth1e$$", "sssc8m", "l0$er", "b**t"):
        best = max(score(t, c) for t, c in paths(X.lattice(token)))
        read = X.decode(token, letters.table)
        assert np.isclose(max(score(t, c) for t, c in paths(X.lattice(token)) if t == read), best)


def test_held_out_notes(spark, letters):
    rng = np.random.default_rng(1)
    plain = "the went to see with some and was said in house of river other boat".split()
    bad = "idiot moron stupid scum loser worthless trash clown pathetic disgusting".split()
    rows = []
    for i in range(900):
        words, toxic = rng.choice(plain, 30).tolist(), int(i % 6 == 0)
        if toxic:
            words[7] = words[20] = str(rng.choice(bad))
        rows.append((i, " ".join(words), toxic if i % 13 else None))
    train = spark.createDataFrame(rows, "asset_id long, notes string, toxic int")
    model = X.fit_toxicity(train, letters)
    test = [(f"the river {h} house", 1) for h in HIDDEN] + [("the river went to the house", 0), ("see some 2024 boats!!", 0)]
    scored = X.score_notes(spark.createDataFrame([(i, t, 9.0) for i, (t, _) in enumerate(test)], "asset_id long, notes string, toxicity double"), model, restored="plain").collect()
    assert [int(r.toxicity >= 0.5) for r in scored] == [y for _, y in test]
    assert scored[0].plain == "the river idiot house"


def test_nulls_empty_tables_and_long_notes(spark, letters):
    for rows in ([], [("a", None)], [(None, 1)], [("x", 1), ("y", 1)], [("x", 0)]):
        model = X.fit_toxicity(spark.createDataFrame(rows, "notes string, toxic int"), letters)
        assert model.parts == {} and 0 <= model.score(None, model.told()) <= 1
    model = X.ToxicityModel(letters, 0.01, {"=idiot": 0.9})
    df = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "the river " * 60_000 + "1d10t")], "asset_id long, notes string")
    got = X.score_notes(df, model).collect()
    assert [round(r.toxicity, 3) for r in got] == [0.01, 0.01, 0.01, 0.901]
    assert X.score_notes(df.limit(0), model).collect() == []
    flat = X.letter_model(X.letter_counts(df.limit(0)))
    assert np.allclose(np.exp(flat.table).sum(-1), 1, atol=1e-3)


MORE_HIDDEN = {"stuupid": "stupid", "iddiot": "idiot", "moroon": "moron", "iiddiot": "idiot", "455": "ass", "@$$": "ass", "st***d": "stupid", "tr***h": "trash", "p********c": "pathetic"}


def test_doubled_letters_signs_only_and_long_masks(letters):
    for token, word in MORE_HIDDEN.items():
        assert word in X.readings(token, letters.table), token
    for plain in ("see", "disgusting", "boat!!", "2024", "1,000", "100", "***", "!!!", "(1)"):
        assert X.reading(plain, letters.table) == X.WORD.findall(plain.lower()), plain
    assert X.decode("b" + "*" * 60 + "t", letters.table)[0] == "b"


def test_masks_equal_all_paths(letters):
    for token in ("r***r", "c**wn", "*?#s"):
        best = (-np.inf, "")
        for reads in itertools.product(*X.lattice(token)):
            text, s, a = "".join(r[0] for r in reads), -sum(r[1] for r in reads), (0, 0, 0)
            for ch in text:
                s, a = s + float(letters.table[a][X.CODE[ch]]), (*a[1:], X.CODE[ch])
            best = max(best, (s + float(letters.table[a][0]), text))
        assert np.isclose(X.best_path(X.lattice(token), letters.table)[0], best[0]), token


def test_notes_hidden_by_repetition(spark, letters):
    model = X.ToxicityModel(letters, 0.01, {"=idiot": 0.9, "=stupid": 0.9, "=moron": 0.9})
    rows = [(i, f"the river {t} house") for i, t in enumerate(("stuupid", "iddiot", "moroon", "iiddiot", "st***d"))]
    assert all(r.toxicity > 0.9 for r in X.score_notes(spark.createDataFrame(rows, "asset_id long, notes string"), model).collect())


def test_spared_tokens_tell_nothing(letters):
    import random

    r = random.Random(2)
    model = X.ToxicityModel(letters, 0.1, {"=the": 0.2, "=idiot": 0.9, "stup": 0.9, "=mor": 0.5, "scumm": 0.7, "=eel": 0.4, "ïnne": 0.3})
    known = X.heads(model.parts)
    tokens = ["".join(r.choice("abdeinlmorstuupcïЕоа0$*.") for _ in range(r.randrange(1, 9))) for _ in range(3000)]
    tokens += ["sstuupid", "tthhee", "idioott!!", "iiddiioott", "mmoooorr", "scummmmm", "eeell", "(stupid)", "ïnnner", "ttthe", "eel"]
    spared = [t for t in tokens if not X.may_tell(t, known)]
    assert len(spared) > 300
    for t in tokens:
        full = {f for w in X.readings(t, letters.table) for f in X.features(w) if f in model.parts}
        assert full == model.hits(t, model.told())


def test_kept_readings_are_bounded_by_what_they_hold(monkeypatch):
    monkeypatch.setattr(X, "KNOWN", 100)
    words = X.Words(lambda t: [t + str(k) for k in range(9)])
    for i in range(500):
        assert words[f"w{i}"] == tuple(f"w{i}{k}" for k in range(9))
        assert sum(1 + len(v) for v in words.values()) <= 110


def test_texts_reach_python_tasks_in_small_batches(spark, letters):
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    try:
        for given, kept in (("10000", "1000"), ("0", "1000"), ("200", "200")):
            spark.conf.set(rows, given)
            X.score_notes(spark.createDataFrame([(1, "a")], "asset_id long, notes string"), X.ToxicityModel(letters))
            assert spark.conf.get(rows) == kept
    finally:
        spark.conf.set(rows, before)
