import random
import re
from collections import Counter

import pytest

from scenequarry.llm import phrase_stripes as S


def slow(rows, max_words=3, least=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    held = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    longer = Counter()
    for (lang, p), a in held.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                longer[lang, p[i : i + k]] = max(longer[lang, p[i : i + k]], a)
    out = {}
    for (lang, p), a in held.items():
        if 100 * longer[lang, p] >= inside * a:
            continue
        score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, r, p.decode(), -a, le, ri, n[lang], -s) for lang, v in out.items() for r, (s, a, p, le, ri) in enumerate(sorted(v)[:top], 1))


def texts(seed, rows=700):
    r = random.Random(seed)
    words = ["The", "of", "été", "x=y", "#", "sea", "Wide", "blue", "\x0bsea", "ÉTÉ", *[f"w{i}" for i in range(60)]]
    out = [(r.choice(["en", "de", None, "und"]), "".join(r.choice(words[: r.choice([6, 12, 70])]) + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",x ", " new york city "]) for _ in range(r.randrange(60)))) for _ in range(rows)]
    return [*out, *[("en", "a b a b a b c " * 30)] * 40, ("en", None), ("de", ""), ("de", " \t "), ("fr", "?!"), ("en", "long " * 30_000)]


def frame(spark, rows):
    return spark.createDataFrame([(lang, "k", t, 1, "x", 2) for lang, t in rows], "lang string, key string, text string, n int, prefix string, part int").repartition(5)


def collected(df):
    return sorted((x.lang, x["rank"], x.phrase, x.a, x.l, x.r, x.n, x.score) for x in df.collect())


def test_phrases_against_brute_force(spark):
    rows = texts(1)
    got = collected(S.mine_phrases(frame(spark, rows)))
    assert len(got) > 200 and got == slow(rows)


@pytest.mark.parametrize("max_words,least,inside,top", [(2, 3, 50, 7), (4, 5, 80, 2000)])
def test_other_lengths_and_small_parts(spark, monkeypatch, max_words, least, inside, top):
    monkeypatch.setattr(S, "WHOLE", 40)
    monkeypatch.setattr(S, "WORDS", 300)
    monkeypatch.setattr(S, "ENTRIES", 8)
    monkeypatch.setattr(S, "SLICE", 64)
    rows = texts(2, 150)[:-1]
    assert collected(S.mine_phrases(frame(spark, rows), max_words, least, inside, top)) == slow(rows, max_words, least, inside, top)


def test_products_beyond_64_bits(spark):
    rows = [("en", "alpha beta " * 40_000)] * 60
    assert collected(S.mine_phrases(frame(spark, rows))) == slow(rows)


def test_empty_tables(spark):
    assert S.mine_phrases(frame(spark, [("en", "a")]).limit(0)).collect() == []
    assert S.mine_phrases(frame(spark, [("en", None), (None, "...")])).collect() == []
