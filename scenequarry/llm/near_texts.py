"""Near copies of texts: groups of texts whose sets of word shingles have a Jaccard similarity of at least a given value."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenequarry.llm.components import connected
from scenequarry.llm.shipping import ship
from scenequarry.session import cut

SEED = 42
#: Counters of a sketch, and the shingles from which on a text has none.
BINS, COUNTED = 128, 1 << 16
#: Words that a task keeps hashes of, the share of texts that the common shingles are counted on, and common shingles that are sent out.
KNOWN, SHARE, COMMON = 150_000, 0.25, 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """XXH64 of a word, worked out once per word and task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word, SEED)
        return out


def shingles(text: str | None, words: int, hashes: Hashes) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles; a text of fewer words is one shingle, one without words has none.

    A-Z are lower-cased and words are split at ASCII white space, as in ``caption_phash``.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    n = max(len(parts) - words, 0) + 1
    h = w[:n].copy()
    for k in range(1, min(words, len(parts))):
        h = h * _MIX + w[k : n + k]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(h ^ (h >> np.uint64(32)))


def needed(n: int, similarity: float) -> int:
    """Shingles, at least, that a text of ``n`` shares with any text as similar as that."""
    return math.ceil(similarity * n - 1e-9)


def similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both) - 1e-9


def common_shingles(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, count) of shingles that several different texts of a fixed share of all texts hold, by hash.

    They only set the order of shingles; no pair depends on them. The most frequent ones are taken, ``COMMON`` at most: all
    counts from the smallest one on that leaves no more than that.
    """
    drawn = texts.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(SHARE * (1 << 30))).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for b in batches:
            for k in range(0, b.num_rows, 500):
                h = [shingles(t, words, hashes) for t in b.column(0).slice(k, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h).view(np.int64))], ["h"])

    counted = cut(drawn.mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"))
    sizes = counted.groupBy(F.least("n", F.lit(COMMON)).alias("n")).agg(F.count("*").alias("m")).orderBy(F.desc("n")).collect()
    least, room = COMMON, COMMON
    for r in sizes:
        if r.m > room:
            break
        least, room = r.n, room - r.m
    t = counted.filter(F.col("n") >= least).toArrow()
    h, n = t.column("h").to_numpy().view(np.uint64), t.column("n").to_numpy()
    at = np.argsort(h)
    return h[at], n[at]


def prefix(own: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles by (count, hash): of two texts that are as similar as that, both hold one shingle at least among these."""
    count = np.zeros(len(own), np.int64)
    if len(common[0]) and len(own):
        at = np.minimum(np.searchsorted(common[0], own), len(common[0]) - 1)
        count = np.where(common[0][at] == own, common[1][at], 0)
    return own[np.argsort(count, kind="stable")[: len(own) - needed(len(own), similarity) + 1]]


def confirmed(pairs: DataFrame, texts: DataFrame, sets: DataFrame, similarity: float, words: int) -> DataFrame:
    """Pairs (``a``, ``b``) that are as similar as that, decided on all their shingles.

    Counts of shingles by remainder bound what two texts can share; only pairs that this bound lets through get their texts.
    """

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            na, nb = b.column("na").to_numpy(), b.column("nb").to_numpy()
            sa, sb = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, BINS) for c in ("sa", "sb"))
            most = np.minimum(sa, sb).sum(axis=1, dtype=np.int64)
            fit = (most * (1 + similarity) >= similarity * (na + nb) - 1e-9) | (np.maximum(na, nb) >= COUNTED)
            yield b.select(["a", "b"]).filter(pa.array(fit))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for b in batches:
            for k in range(0, b.num_rows, 500):
                own = b.slice(k, 500)
                fit = [similar(shingles(x, words, hashes), shingles(y, words, hashes), similarity) for x, y in zip(own.column("ta").to_pylist(), own.column("tb").to_pylist(), strict=True)]
                yield own.select(["a", "b"]).filter(pa.array(fit, pa.bool_()))

    def sides(side: DataFrame, columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
        return tuple(side.select(F.col("row").alias(k), *[F.col(c).alias(f"{s}{k}") for c, s in columns.items()]) for k in ("a", "b"))

    a, b = sides(sets, {"n": "n", "sketch": "s"})
    left = cut(pairs.join(a, "a").join(b, "b").mapInArrow(bounded, "a long, b long"))
    rows = left.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    a, b = sides(cut(texts.join(rows, "row", "left_semi")), {"text": "t"})
    return cut(left.join(a, "a").join(b, "b").mapInArrow(compared, "a long, b long"))


def near_texts(texts: DataFrame, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """(``row``, ``group``) of each row of the written table ``texts`` (``row`` long, each once; ``text``).

    ``group`` is the smallest row that is reached over pairs of texts with a Jaccard similarity of ``similarity`` or more of
    their shingles of ``words`` words; texts without words are one group. Copies with equal shingles are one point of the
    search. No pair is lost: each text lists its rarest shingles, as many as it may miss plus one, and two texts that are
    as similar as that meet in one list at least. First each text is compared with the centre of each of its lists: the text
    with the smallest share of rarer shingles, so the one that the others of a large group were most likely made from. Then
    texts of a list that are not in its centre's group are compared with those of other groups. Both steps take only pairs
    where the places of the shingle in both prefixes still leave room for enough common ones.
    Shingles are told apart by 64-bit hashes.
    """
    spark = texts.sparkSession
    ship(spark)
    common = spark.sparkContext.broadcast(common_shingles(texts, words))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                own = [shingles(t, words, hashes) for t in b.column("text").to_pylist()]
                sketch = [np.minimum(np.bincount((s % np.uint64(BINS)).astype(np.int64), minlength=BINS), COUNTED - 1).astype(np.uint16).tobytes() for s in own]
                first = [prefix(s, common.value, similarity).view(np.int64) for s in own]
                yield pa.RecordBatch.from_arrays(
                    [b.column("row"), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in own], pa.binary()), pa.array([len(s) for s in own], pa.int64()), pa.array(sketch, pa.binary()), pa.array(first, pa.list_(pa.int64()))],
                    ["row", "digest", "n", "sketch", "prefix"],
                )

    all_rows = cut(texts.select("row", "text").mapInArrow(described, "row long, digest binary, n long, sketch binary, prefix array<long>"))
    heads = cut(all_rows.groupBy("digest").agg(F.min("row").alias("head")))
    sets = all_rows.join(heads.select(F.col("head").alias("row")), "row", "left_semi")
    entries = sets.select("row", "n", F.posexplode("prefix").alias("at", "h")).select("h", "row", "n", (F.col("n") - F.col("at")).alias("left"))
    several = entries.groupBy("h").agg(F.count("*").alias("_n")).filter("_n > 1").select("h")
    lists = cut(entries.join(several, "h", "left_semi"))
    centre = lists.groupBy("h").agg(F.max_by(F.struct("row", "n", "left"), F.struct(F.col("left") / F.col("n"), "row")).alias("_c"))
    centres = cut(centre.select("h", F.col("_c.row").alias("c"), F.col("_c.n").alias("nc"), F.col("_c.left").alias("leftc")))

    def fits(k1: str, k2: str):
        """Lengths that allow the similarity, and, from this shingle on as the first common one, enough shingles on both sides."""
        n1, n2, left1, left2 = (F.col(c + k) for c in ("n", "left") for k in (k1, k2))
        return (F.least(n1, n2) >= similarity * F.greatest(n1, n2) - 1e-9) & (F.least(left1, left2) * (1 + similarity) >= similarity * (n1 + n2) - 1e-9)

    stars = cut(lists.join(centres, "h").filter("row <> c").filter(fits("", "c")).select(F.least("row", "c").alias("a"), F.greatest("row", "c").alias("b")).distinct())
    links = confirmed(stars, texts, sets, similarity, words)
    parts = cut(connected(links, "a", "b"))
    known = parts.select(F.col("node").alias("row"), F.col("component").alias("part"))
    home = centres.join(known.withColumnRenamed("row", "c"), "c", "left").select("h", F.coalesce("part", "c").alias("home"))
    placed = cut(lists.join(known, "row", "left").withColumn("part", F.coalesce("part", "row")).join(home, "h"))
    apart = placed.filter("part <> home")
    open_rows = placed.join(apart.select("h").distinct(), "h", "left_semi")
    one, two = (side.select("h", *more, *[F.col(c).alias(f"{c}{k}") for c in ("row", "n", "left", "part")]) for side, k, more in ((apart, "1", ["home"]), (open_rows, "2", [])))
    met = one.join(two, "h").filter("part1 <> part2 AND (row1 < row2 OR part2 = home)").filter(fits("1", "2"))
    rest = met.select(F.least("row1", "row2").alias("a"), F.greatest("row1", "row2").alias("b")).distinct()
    more = confirmed(cut(rest.join(stars, ["a", "b"], "left_anti")), texts, sets, similarity, words)
    parts = cut(connected(links.unionByName(more), "a", "b"))
    grouped = heads.join(parts, heads["head"] == parts["node"], "left").select("digest", F.coalesce("component", "head").alias("group"))
    return all_rows.select("row", "digest").join(grouped, "digest").select("row", "group")
