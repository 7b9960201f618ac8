import re
from html import unescape

import numpy as np

from scenequarry.llm import page_content as C


def fitted(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    return pages, C.fit_content_model(C.self_labelled(pages, 100))


def test_held_out_pages(spark):
    pages, model = fitted(spark)
    got = C.extract_pages(pages, model).collect()
    right = 0
    for r in got:
        inner = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", r.html, re.S)[1])
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        right += r.text == "\n\n".join(b for b in blocks if b)
    assert right >= 0.99 * len(got)
    line = "People of the old house talk about the river and the market in town. They do so every day."
    p = "".join(f"<p>{line} {i}</p>" for i in range(5))
    main = "\n\n".join(f"{line} {i}" for i in range(5))
    forms = [
        f"<body><div class=header><a href=/>Home</a></div><div id=content>{p}</div><div id=comments><div class=comment><p>{line}</p></div></div></body>",
        f"<div><a href=/>Home</a> <a href=/b>Blog</a></div><div>{p}</div><div><a href=/t>Terms</a></div>",
        f"<main>{p}</main><div class='cookie-banner'><p>{line}</p></div><form><label>Mail</label><input></form><aside><p>{line}</p></aside>",
        f"<article>{p}<section class='comments'><h2>Comments</h2><p>{line}</p><p>{line}</p></section></article><script>var a = '<p>x</p>'</script>",
    ]
    for h in forms:
        assert C.page_texts([h], model) == [main], h[:60]


def test_broken_empty_and_long_pages(spark):
    _, model = fitted(spark)
    rows = [(1, None, "t"), (1, None, "t"), (2, "", "t"), (None, "<", "t"), (3, "<p", "t"), (4, "<script>never closed", "t"), (5, "</p></div>", "t"), (6, "<div>" * 3000, "t"), (7, "<article>" + "<p>Some words are here &amp;amp; there.\n Yes.<br>And more." * 4000, "t")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = C.extract_pages(df, model).collect()
    assert len(got) == len(rows) and all(r.text == "" for r in got if r.page_id != 7)
    assert next(r.text for r in got if r.page_id == 7) == "\n\n".join(["Some words are here &amp; there. Yes. And more."] * 4000)
    assert C.extract_pages(df.limit(0), model).collect() == []
    assert C.page_texts(["<article><p>A long enough sentence about the river. And one more.</p></article>"], C.fit_content_model(C.self_labelled(df.limit(0)))) == ["A long enough sentence about the river. And one more."]


def test_marginals_equal_all_labellings(spark, rng):
    _, model = fitted(spark)
    page = C.parse("<body><nav><a href=x>y</a></nav><div class=content><p>Words here.</p><ul><li>z</li></ul></div></body>")
    f = C.Forest([page])
    got = model.marginals(f)
    other = model.tags["#other"]
    own = C.TEXT_WEIGHT * model.bins[f.bins].sum(1)
    for i, tokens in enumerate(f.tokens):
        own[i] += sum((C.NAME_WEIGHT * np.array(model.tokens[t]) for t in tokens if t in model.tokens), np.zeros(2))
    total, ones = 0.0, np.zeros(f.n)
    for code in range(1 << f.n):
        y = [code >> i & 1 for i in range(f.n)]
        s = own[range(f.n), y].sum() + model.start[y[0]] + sum(model.steps[model.tags.get(f.tags[i], other), y[f.parent[i]], y[i]] for i in range(1, f.n))
        total += np.exp(s)
        ones += np.exp(s) * np.array(y)
    assert np.allclose(got, ones / total)


def test_broken_pages_cost_no_more_than_their_length():
    import time

    n = 1_000_000
    for html in ("<" + "a" * n, "<a" * (n // 2), "<a" * (n // 2) + ' "', "<a " * (n // 3) + '">' , "<a '\"" * (n // 5) + ">", '<a b="' * (n // 6), "<!" * (n // 2), "<!--" * (n // 4), "<div>" * (n // 5), "</b>" * (n // 4) + "<p>x", "<a \"'" * (n // 5) + "'>"):
        started = time.time()
        C.parse(html)
        assert time.time() - started < 10, html[:12]


def test_tags_end_outside_quotes():
    html = """a < b <p title='x > "y' id=k>one</p><!-- <b> --><i a="never closed>two <b>three</b> <?php x ?> <3 <em/>four <u"""
    found, at = [], 0
    tags = C.Tags(html)
    while t := tags.find(at):
        found.append((t[2] + t[3], t[4]))
        at = t[1]
    assert found == [("p", """ title='x > "y' id=k"""), ("/p", ""), ("", ""), ("b", ""), ("/b", ""), ("", ""), ("em", "/")]
