"""URL filters with redirect equivalence. The catalogue keeps no web addresses, so this works on any table of pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenequarry.llm.components import connected
from scenequarry.session import cut

AZ = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Parts of a page that hold no links of its own, and character references of addresses in the order of their decoding.
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<(?:script|style|template|textarea)\b.*?(?:</(?:script|style|template|textarea)\s*>|\z)"
REFERENCES = ((r"(?i)&quot;|&#0*34;|&#x0*22;", '"'), (r"(?i)&apos;|&#0*39;|&#x0*27;", "'"), (r"(?i)&sol;|&#0*47;|&#x0*2f;", "/"), (r"(?i)&amp;|&#0*38;|&#x0*26;", "&"))


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), *AZ)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def straight(path: Column) -> Column:
    """``path`` without the segments ``.`` and ``..``; what would lead above the root stays at the root."""
    ended = F.when(path.rlike(r"(?s)/\.\.?$"), F.concat(path, F.lit("/"))).otherwise(path)
    last = lambda done: F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
    kept = F.aggregate(F.split(ended, "/"), F.array().cast("array<string>"), lambda done, s: F.when(s == "..", last(done)).when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    return F.when(path.rlike(r"(?s)/\.\.?(?:/|$)"), F.array_join(kept, "/")).otherwise(path)


def canonical(url: Column) -> Column:
    """Address that stands for ``url``: host in lower case, no ``.`` and ``..`` segments, no fragment, no ``utm_`` parameters, no
    default port; null stays null.
    """
    head = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    port = F.when(head == "http", r":80$").when(head == "https", r":443$").otherwise(r"(?!)")
    query = F.regexp_replace(F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1), r"(?<=[?&])utm_[^&]*(&|$)", "")
    return F.when(F.instr(url, "://") > 0, F.concat(head, F.lit("://"), F.regexp_replace(url_host(url), port, ""), straight(url_path(url)), F.regexp_replace(query, r"[?&]+$", ""))).otherwise(url)


def alias_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(``url``, ``target``, ``kind``): where an address leads.

    ``self``: the address without what doesn't change the page, see ``canonical``; ``canonical``: the page's
    ``<link rel="canonical">``; ``redirect``: its ``<meta http-equiv="refresh">``. Comments, scripts and styles hold no links.
    Character references of a target are decoded. Targets without scheme and host are resolved against the page's address:
    ``//host``, ``/path``, ``?query`` and paths from the page's folder, with ``.`` and ``..``. Null addresses have no links, nor
    have pages without ``://`` in theirs where the target names no host, nor targets of other kinds (``mailto:``).
    """
    u, h = F.col(url), F.coalesce(F.col(html), F.lit(""))
    seen = F.when(h.rlike("(?i)canonical|refresh"), F.regexp_replace(h, UNSEEN, " ")).otherwise(F.lit(""))
    link = F.regexp_extract("_seen", r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    meta = F.regexp_extract("_seen", r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)
    scheme, origin = F.regexp_extract("url", r"(?s)^(.*?:)//", 1), F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1)
    path = url_path(F.col("url"))
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))

    def full(x: Column) -> Column:
        for pattern, sign in REFERENCES:
            x = F.regexp_replace(x, pattern, sign)
        named = F.when(x.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), x).when(x.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:|#|$)"), None).when(F.instr("url", "://") == 0, None)
        return named.when(x.startswith("//"), F.concat(scheme, x)).when(x.startswith("/"), F.concat(origin, x)).when(x.startswith("?"), F.concat(origin, path, x)).otherwise(F.concat(origin, folder, x))

    found = [F.struct(F.lit("self").alias("kind"), canonical(F.col("url")).alias("target"))]
    found += [F.struct(F.lit(k).alias("kind"), canonical(full(x)).alias("target")) for k, x in (("canonical", link), ("redirect", meta))]
    rows = pages.filter(u.isNotNull()).select(u.alias("url"), seen.alias("_seen"))
    return rows.select("url", F.inline(F.array(*found))).filter("target IS NOT NULL AND target <> ''").select("url", "target", "kind")


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, bool]]) -> tuple[Column, Column]:
    """(rule, allowed) of the longest rule that fits; both null without one. A rule is (host, path, allowed).

    It fits its host and all subdomains if the path starts with the rule's. Of several the longest text wins, then the
    first given. The rules become one ordered conditional expression.
    """
    name, allowed = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for h, p, ok in sorted(reversed(list(rules)), key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, allowed = F.when(fits, h + p).otherwise(name), F.when(fits, F.lit(ok)).otherwise(allowed)
    return name, allowed


def judge_pages(pages: DataFrame, links: DataFrame, rules: Sequence[tuple[str, str, bool]], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, url, host, path, rule, verdict, alias_verdict`` of every page; verdict is ``allow`` or ``block``.

    ``links`` (url, target) are redirect and canonical-link edges. Addresses that they connect are aliases. A page that a
    rule fits has the rule's verdict. Any other page is blocked if an alias, page or bare target, is blocked by a rule and
    none is allowed by one (an explicit allow takes precedence in its whole component); else it is allowed.
    ``alias_verdict`` is the component's decision, null if no rule fits any of its addresses. Components are found by
    distributed star contraction over different addresses; pages that share one address are one node, and a page whose
    address is linked to nothing needs no component. Repeated rows keep their number.
    """
    u = F.col(url)
    rule, allowed = rule_for(url_host(u), url_path(u), rules)
    judged = pages.select(F.col(page_id), u, url_host(u).alias("host"), url_path(u).alias("path"), rule.alias("rule"), allowed.alias("_allowed"))
    edges = cut(links.filter("url IS NOT NULL AND target IS NOT NULL AND url <> target").select("url", "target").distinct())
    parts = cut(connected(edges, "url", "target"))
    node = F.col("node")
    _, said = rule_for(url_host(node), url_path(node), rules)
    decided = parts.groupBy("component").agg(F.max(said).alias("_any"))
    known = parts.join(decided.filter("_any IS NOT NULL"), "component").select("node", "_any")
    out = judged.join(known, judged[url] == known["node"], "left")
    verdict = F.when(F.coalesce("_allowed", "_any", F.lit(True)), "allow").otherwise("block")
    return out.select(page_id, url, "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("_any"), "allow").when(~F.col("_any"), "block").alias("alias_verdict"))
