"""Registered queries of the numbered operators: thin steps from the given tables to the operators and back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scenequarry.llm import best_fit as B
from scenequarry.llm import decision_lists as D
from scenequarry.llm import deobfuscation as X
from scenequarry.llm import label_shards as S
from scenequarry.llm import licence_rules as L
from scenequarry.llm import multiprobe as M
from scenequarry.llm import near_frames as N
from scenequarry.llm import page_content as C
from scenequarry.llm import phrase_stripes as T
from scenequarry.llm import pieces as P
from scenequarry.llm import span_hashes as H
from scenequarry.llm import subvector_palette as V
from scenequarry.llm import url_rules as U
from scenequarry.session import cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def keep(fn):
        QUERIES[name] = fn
        return fn

    return keep


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as frames with captions."""
    return as_frames(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def as_frames(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("frame_id"), F.col("text").alias("caption"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` as frame verdicts: accepted 1 for good quality."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("frame_id"), F.col("quality").alias("accepted")).filter("frame_id IS NOT NULL")


#: Labelled rows, at most, that the pipeline's quality rules are fitted on.
VERDICTS = 20_000


def drawn_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most ``VERDICTS`` rows of ``verdicts``, drawn by a hash of the id: small enough to be sent to every worker."""
    return verdicts(spark, sf_dir).filter("accepted IS NOT NULL").orderBy(F.xxhash64("frame_id"), "frame_id").limit(VERDICTS)


@query("op9_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = cut(D.caption_metrics(captions(spark, sf_dir)).drop("caption"))
    rules = D.fit_decision_list(m.join(verdicts(spark, sf_dir), "frame_id"), D.caption_ratios())
    kept = ~base_failed() & rules.verdict(D.caption_ratios())
    return m.select(
        F.col("frame_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), kept.alias("kept"),
        rules.rule_number(D.caption_ratios()).alias("rule_number"),
    )


@query("op10_near_duplicates")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = N.near_frames(N.caption_phash(captions(spark, sf_dir)).drop("caption"))
    return groups.select(F.col("frame_id").alias("doc_id"), F.lower(F.lpad(F.hex("phash"), 16, "0")).alias("fingerprint"), F.col("group_id").alias("component_id"))


def as_assets(docs: DataFrame) -> DataFrame:
    """Documents as catalogue assets with notes."""
    return docs.select(F.col("doc_id").alias("asset_id"), F.col("text").alias("notes"))


def packed(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    pieces = B.token_pieces(as_assets(docs), vocabulary or public_tokenizers.path("word_bpe_49k.json"))
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return B.pack_pieces(pieces, ["asset_id", "piece"]).select(F.col("asset_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op7_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Labelled rows, at most, that the toxicity model is fitted on.
LABELLED = 12_000


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> X.ToxicityModel:
    """Letter counts over all documents; labels of a bounded sample outside the held-out fifth, drawn by a hash of the id."""
    assets = as_assets(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    drawn = F.broadcast(labels.select(F.col("doc_id").alias("asset_id"), "toxic").orderBy(F.xxhash64("asset_id"), "asset_id").limit(LABELLED))
    return X.fit_toxicity(assets.join(drawn, "asset_id"), X.letter_model(X.letter_counts(assets)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query("op8_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = X.score_notes(as_assets(docs), toxicity_model(spark, docs, sf_dir))
    return scored.select(F.col("asset_id").alias("doc_id"), held_out(F.col("asset_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


#: (host, path, allowed)
URL_RULES = (("net", "/", False), ("example.net", "/en/", True), ("example.com", "/de/", False), ("org", "/fr/", True))


@query("op3_url_filter")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return U.judge_pages(pages, U.alias_links(pages), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "alias_verdict")


_AZ = ", ".join(f"'{x}'" for x in U.AZ)


def _host_sql(url: str) -> str:
    return f"translate(regexp_extract({url}, '^.*?://([^/?#]*)', 1, 's'), {_AZ})"


def _path_sql(url: str) -> str:
    return f"regexp_extract({url}, '^.*?://[^/?#]*([^?#]*)', 1, 's')"


def _rule_sql(host: str, path: str, allowed: bool) -> str:
    rows = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
    then = (lambda r: str(r[2]).lower()) if allowed else (lambda r: f"'{r[0]}{r[1]}'")
    return "CASE " + " ".join(f"WHEN ({host} = '{r[0]}' OR {host} LIKE '%.{r[0]}') AND starts_with({path}, '{r[1]}') THEN {then(r)}" for r in rows) + " END"


def _canonical_sql(url: str) -> str:
    head = f"lower(regexp_extract({url}, '^(.*?)://', 1, 's'))"
    query = f"regexp_extract({url}, '^.*?://[^?#]*(\\?[^#]*)', 1, 's')"
    for _ in range(2):
        query = f"regexp_replace({query}, '([?&])utm_[^&]*(&|$)', '\\1', 'g')"
    host = f"CASE {head} WHEN 'http' THEN regexp_replace({_host_sql(url)}, ':80$', '') WHEN 'https' THEN regexp_replace({_host_sql(url)}, ':443$', '') ELSE {_host_sql(url)} END"
    return f"CASE WHEN contains({url}, '://') THEN {head} || '://' || {host} || {_straight_sql(_path_sql(url))} || regexp_replace({query}, '[?&]+$', '') ELSE {url} END"


def _straight_sql(path: str) -> str:
    ended = f"CASE WHEN regexp_matches({path}, '/\\.\\.?$', 's') THEN {path} || '/' ELSE {path} END"
    kept = f"list_reduce(list_transform(string_split({ended}, '/'), lambda z: [z]), lambda done, z: CASE z[1] WHEN '..' THEN done[1 : greatest(len(done) - 1, 1)] WHEN '.' THEN done ELSE list_concat(done, z) END)"
    return f"CASE WHEN regexp_matches({path}, '/\\.\\.?(/|$)', 's') THEN array_to_string({kept}, '/') ELSE {path} END"


def _full_sql(link: str) -> str:
    for pattern, sign in U.REFERENCES:
        link = f"regexp_replace({link}, '{pattern}', '{sign.replace(chr(39), chr(39) * 2)}', 'g')"
    scheme, origin, path = "regexp_extract(url, '^(.*?:)//', 1, 's')", "regexp_extract(url, '^(.*?://[^/?#]*)', 1, 's')", _path_sql("url")
    return f"""(SELECT CASE WHEN regexp_matches(z, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN z WHEN regexp_matches(z, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:|#|$)') OR NOT contains(url, '://') THEN NULL
WHEN starts_with(z, '//') THEN {scheme} || z WHEN starts_with(z, '/') THEN {origin} || z WHEN starts_with(z, '?') THEN {origin} || {path} || z
ELSE {origin} || CASE {path} WHEN '' THEN '/' ELSE regexp_extract({path}, '^(.*/)', 1, 's') END || z END FROM (SELECT {link} AS z))"""


_TAGS = {
    "link": ("rel\\s*=\\s*[\"'']?canonical\\b", "href"),
    "meta": ("http-equiv\\s*=\\s*[\"'']?refresh\\b", "url"),
}
_LINKS = ", ".join(
    f"""coalesce(nullif(regexp_extract(h, '<{tag}\\b[^>]*\\b{mark}[^>]*\\b{name}\\s*=\\s*["'']?([^"''\\s>]+)', 1, 'is'), ''), regexp_extract(h, '<{tag}\\b[^>]*\\b{name}\\s*=\\s*["'']?([^"''\\s>]+)[^>]*\\b{mark}', 1, 'is')) AS {tag}"""
    for tag, (mark, name) in _TAGS.items()
)
ORACLES["op3_url_filter"] = f"""WITH RECURSIVE p AS (SELECT page_id, url, regexp_replace(coalesce(html, ''), '{U.UNSEEN}', ' ', 'g') AS h, coalesce({_host_sql("url")}, '') AS host, coalesce({_path_sql("url")}, '') AS path FROM pages),
x AS (SELECT url, {_LINKS} FROM p WHERE url IS NOT NULL),
y AS (SELECT url, url AS target FROM x UNION ALL SELECT url, {_full_sql("link")} FROM x UNION ALL SELECT url, {_full_sql("meta")} FROM x),
e AS (SELECT DISTINCT url AS a, {_canonical_sql("target")} AS b FROM y WHERE target IS NOT NULL AND target <> ''),
d AS (SELECT a, b FROM e WHERE a <> b AND b <> '' UNION SELECT b, a FROM e WHERE a <> b AND b <> ''),
r AS (SELECT DISTINCT a AS node, a AS other FROM d UNION SELECT r.node, d.b FROM r JOIN d ON d.a = r.other),
k AS (SELECT node, max({_rule_sql(_host_sql("other"), _path_sql("other"), True)}) AS any_ok FROM r GROUP BY node)
SELECT page_id, host, path, {_rule_sql("host", "path", False)} AS rule, CASE WHEN coalesce({_rule_sql("host", "path", True)}, any_ok, true) THEN 'allow' ELSE 'block' END AS verdict,
CASE WHEN any_ok THEN 'allow' WHEN NOT any_ok THEN 'block' END AS alias_verdict FROM p LEFT JOIN k ON p.url = k.node"""


@query("op2_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = L.scan_notes(as_assets(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return scanned.select(F.col("asset_id").alias("doc_id"), "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


def _scan_sql() -> str:
    """Sentences, their normal form and numbers, then one step per rule on the documents that hold a known sentence."""
    quote = lambda x: x.replace("'", "''")
    dotted = "regexp_replace(regexp_replace(lower(x), '([0-9])\\.([0-9])', '\\1\x01\\2', 'g'), '([0-9])\\.([0-9])', '\\1\x01\\2', 'g')"
    normal = f"trim(regexp_replace(replace(replace({dotted}, '.', ' '), '\x01', '.'), '[^\\p{{L}}\\p{{N}}./()]+', ' ', 'g'))"
    normal = f"trim(regexp_replace(regexp_replace({normal}, '{L.SLASHES[0]}', ' ', 'g'), '{L.SLASHES[1]}', ''))"
    parts = f"CASE WHEN regexp_matches(s, '{L.SPDX}') THEN list_transform(string_split_regex(regexp_replace(regexp_replace(s, '{L.SPDX}', ''), '[()]', '', 'g'), '{L.SPDX_PARTS}'), lambda z: 'spdx ' || trim(z)) ELSE [s] END"
    number = "CASE " + " ".join(f"WHEN regexp_full_match(s, '{quote(form)}') THEN {n}" for n, form in L.SENTENCES) + " END"
    steps, last = [], "w0"
    for k, r in enumerate(L.RULES, 1):
        like = "%" + "%".join(f"|{n}|" for n in r.sentences) + "%"
        steps.append(
            f"w{k} AS (SELECT doc_id, CASE WHEN f THEN list_filter(rest, lambda z: NOT list_contains({list(r.sentences)}, z)) ELSE rest END AS rest, CASE WHEN f AND NOT list_contains(found, '{r.licence}') THEN list_append(found, '{r.licence}') ELSE found END AS found "
            f"FROM (SELECT *, array_to_string(list_transform(rest, lambda z: '|' || z || '|'), '') LIKE '{like}' AS f FROM {last}) q{k})"
        )
        last = f"w{k}"
    return f"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?;])\\s+', '\\1\n', 'g'), '[\\n\\r\\v\\f]+'), lambda z: trim(z) <> '') AS parts FROM documents),
n AS (SELECT doc_id, x, i FROM (SELECT doc_id, unnest(parts) AS x, generate_subscripts(parts, 1) AS i FROM t) u WHERE regexp_matches(x, '(?i){quote(L.HINTS)}')),
o AS (SELECT doc_id, i, unnest({parts}) AS s, generate_subscripts({parts}, 1) AS j FROM (SELECT doc_id, i, {normal} AS s FROM n) v),
m AS (SELECT doc_id, i, j, {number} AS id FROM o WHERE regexp_matches(s, '{quote(L.HINTS)}')),
w0 AS (SELECT doc_id, list(id ORDER BY i, j) AS rest, CAST([] AS VARCHAR[]) AS found FROM m WHERE id IS NOT NULL GROUP BY doc_id), {", ".join(steps)}
SELECT t.doc_id, CAST(len(parts) AS BIGINT) AS n_sentences, coalesce(array_to_string(w0.rest, ','), '') AS sentence_ids, coalesce(array_to_string({last}.found, ','), '') AS licences FROM t LEFT JOIN w0 USING (doc_id) LEFT JOIN {last} USING (doc_id)"""


ORACLES["op2_license_scan"] = _scan_sql()


@query("op6_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    assets = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("asset_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc32"), F.xxhash64(text).alias("content")
    )
    placed = S.place_assets(assets, "content", ["asset_id", "content"])
    return placed.select(F.col("asset_id").alias("doc_id"), "size", F.col("crc32").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op1_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    strings = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("value"))
    done = P.decode_strings(P.encode_strings(strings, model), model)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.hash("ids").alias("ids_hash"), F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"), (F.col("decoded") == F.col("value")).alias("round_trip"))


@query("op5_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("splat_id"), F.col("embedding").alias("features"))
    return M.nearest_splats(vectors, "id % 20 = 0").select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op4_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = C.extract_pages(pages, C.fit_content_model(C.self_labelled(pages)))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op11_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    strings = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("key"), "text")
    return H.compare_neighbours(strings).withColumnRenamed("key", "doc_id")


@query("op12_phrase_collocations")
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", F.col("doc_id").alias("key"), "text"))


ORACLES["op12_phrase_collocations"] = """WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda z: z <> '') AS w FROM t),
g AS (SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, size FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS size))),
f AS (SELECT lang, phrase, size, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
s AS (SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1 :], ' ')),
b AS (SELECT lang, phrase, a, min({'score': score, 'k': k, 'l': l, 'r': r}) AS v FROM s GROUP BY lang, phrase, a),
h AS (SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(a) AS longer FROM (SELECT *, unnest([1, 2]) AS i FROM c WHERE size = 3) GROUP BY ALL),
k AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY v.score DESC, a DESC, encode(b.phrase)) AS rank FROM b LEFT JOIN h USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, v.l AS l, v.r AS r, n, v.score AS score FROM k JOIN n USING (lang) WHERE rank <= 2000"""


@query("op13_centroid_clustering")
def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("splat_id"), F.col("embedding").alias("features"))
    return V.cluster_splats(vectors).withColumnRenamed("splat_id", "vec_id")


def _rounds_sql(rounds: int = 5, k: int = 40) -> str:
    """Rounds written out one after another: all distances, the nearest centroid, sums by component."""
    nearest = "(SELECT i, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT v.i, m.c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN m{0} m USING (j) GROUP BY v.i, m.c) GROUP BY i)"
    steps = []
    for n in range(rounds):
        moved = "SELECT c, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (SELECT c, j, sum(x)::BIGINT AS s, count(*) AS n FROM a JOIN v USING (i) GROUP BY c, j)"
        steps.append(f"m{n + 1} AS MATERIALIZED (WITH a AS {nearest.format(n)}, w AS ({moved}) SELECT c, j, coalesce(w.x, m.x) AS x FROM m{n} m LEFT JOIN w USING (c, j))")
    return f"""WITH e AS MATERIALIZED (SELECT vec_id AS i, embedding AS e FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda z: z IS NOT NULL AND isfinite(z))) = 64),
v AS MATERIALIZED (SELECT i, j, CAST(floor(256 * x::DOUBLE) AS BIGINT) AS x FROM (SELECT i, unnest(e) AS x, generate_subscripts(e, 1) AS j FROM e)),
m0 AS MATERIALIZED (SELECT c, j, x FROM (SELECT i, row_number() OVER (ORDER BY sha256('2:' || i)) - 1 AS c FROM e) JOIN v USING (i) WHERE c < {k}), {", ".join(steps)},
a AS MATERIALIZED {nearest.format(rounds)},
s AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM m{rounds} GROUP BY c)
SELECT i AS vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a JOIN s USING (c)"""


ORACLES["op13_centroid_clustering"] = _rounds_sql()
