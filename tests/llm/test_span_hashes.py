import hashlib
import random

from scenequarry.llm import span_hashes as H


def test_spans_and_extensions_equal_brute_force():
    r = random.Random(3)
    for _ in range(60):
        a = "".join(r.choice("abé😀") for _ in range(r.randrange(0, 60)))
        b = a[r.randrange(len(a) + 1) :] + "".join(r.choice("ab") for _ in range(20))
        x, y = H.PrefixHashes(a), H.PrefixHashes(b)
        for _ in range(30):
            i, j, n = r.randrange(len(a) + 1), r.randrange(len(b) + 1), r.randrange(12)
            assert x.equal_spans(i, y, j, n) == (i + n <= len(a) and j + n <= len(b) and a[i : i + n] == b[j : j + n])
            want = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))
            assert x.common_extension(i, y, j) == want
        keep, take = r.randrange(len(a) + 1), r.randrange(len(b) + 1)
        s, t = x.splice(keep, y, take), H.PrefixHashes(a[:keep] + b[:take])
        assert s.span(0, s.n) == t.span(0, t.n) and str(s.fingerprint()) == str(t.fingerprint())


def test_long_texts_and_powers_beyond_the_table():
    r = random.Random(4)
    a = "".join(r.choice("abcdefgh ") for _ in range(200_000))
    x, y = H.PrefixHashes(a), H.PrefixHashes("zz" + a[70_000:])
    assert x.common_extension(70_000, y, 2) == 130_000 and x.common_extension(0, y, 2) < 40
    assert len(x.fingerprint().places) <= H.PLACES
    for text in ("a" * 100_000, "ab" * 5000, ""):
        f = H.PrefixHashes(text).fingerprint()
        assert len(f.places) <= H.PLACES and str(H.Fingerprint.parse(str(f))) == str(f)


def test_likeness_follows_the_common_share():
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 9))) for _ in range(3000)]
    for n in (30, 200, 2000):
        a = " ".join(r.choice(words) for _ in range(n))
        b = " ".join(r.choice(words) for _ in range(n))
        cut = 2 * len(a) // 3
        f, g, e = (H.PrefixHashes(t).fingerprint() for t in (a, b, a[:cut] + b[: len(a) - cut]))
        moved = H.PrefixHashes("something put in front of it " + a).fingerprint()
        assert f.likeness(f) == 1.0 and f.likeness(g) < 0.1
        assert 0.5 < f.likeness(e) <= 0.68
        assert f.likeness(moved) > 0.6
        assert H.Fingerprint.parse(str(f)).likeness(H.Fingerprint.parse(str(e))) == f.likeness(e)


def slow(rows):
    """(key, n, sha of the blend, blend, next text) in plain Python."""
    order = sorted(((k, t or "") for k, t in rows), key=lambda x: (x[0] is None, -(x[0] or 0)))
    out = []
    for i, (k, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        cut = len(t) // 3
        blend = t[: len(t) - cut] + after[:cut]
        out.append((k, len(t), hashlib.sha256(blend.encode()).hexdigest(), blend, t, after))
    return out


def test_neighbours_against_brute_force(spark):
    r = random.Random(6)
    rows = [(i * 7 % 501, "".join(r.choice("abc dé😀") for _ in range(r.choice([0, 1, 2, 5, 40, 400])))) for i in range(501)] + [(1000, None), (2000, "x" * 50_000), (None, "the last one")]
    df = spark.createDataFrame([(k, t, "extra", 1) for k, t in rows], "key long, text string, fingerprint string, _part int")
    got = {x.key: x for x in H.compare_neighbours(df).collect()}
    want = slow(rows)
    assert len(got) == len(want)
    for k, n, sha, blend, text, after in want:
        f, e, g = (H.PrefixHashes(t).fingerprint() for t in (text, blend, after))
        x = got[k]
        assert (x.n_chars, x.edited_sha256, x.fingerprint, x.edited_fingerprint) == (n, sha, str(f), str(e))
        assert (x.near_edited, x.near_next) == (f.likeness(e), f.likeness(g))
        assert 0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 and text[: x.common_prefix] == blend[: x.common_prefix]


def test_ties_repeats_and_empty_tables(spark):
    schema = "key long, text string"
    assert H.compare_neighbours(spark.createDataFrame([], schema)).collect() == []
    one = H.compare_neighbours(spark.createDataFrame([(1, "abcdef")], schema)).collect()
    assert [x.edited_sha256 for x in one] == [hashlib.sha256(b"abcdab").hexdigest()] and one[0].near_next == 1.0
    many = H.compare_neighbours(spark.createDataFrame([(5, "same text here, quite long")] * 300 + [(5, "other")], schema)).collect()
    assert len(many) == 301 and len({x.fingerprint for x in many}) == 2
    named = H.fingerprint_strings(spark.createDataFrame([("en", "a", "x"), ("en", "b", None), ("de", "c", "x")], "lang string, key string, text string")).collect()
    assert named[0].fingerprint == named[2].fingerprint != named[1].fingerprint
