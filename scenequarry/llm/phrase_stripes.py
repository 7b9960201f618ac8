"""Phrases of locale strings by stripes: each prefix keys a counter of the words that follow it."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scenequarry.llm.shipping import ship
from scenequarry.session import cut

#: A-Z in lower case, tabs as spaces, the ends of pieces as line ends.
_FOLD = bytes(10 if c in b".,;:!?\n\v\f\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bytes that are cut into words at once, words of one language that are counted at once, entries of a stripe in one row.
SLICE, WORDS, ENTRIES = 1 << 20, 2_000_000, 8192
#: Entries, before merging, beyond which a prefix's stripe is dealt out by its next words.
WHOLE = 500_000
#: Bits of the filter that keeps phrases with a rare part out of the longer stripes: 8 MB at any size of the corpus.
FILTER_BITS = 26
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Ids(dict):
    """Numbers of words in order of their first use; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _slices(text: bytes) -> Iterator[bytes]:
    """``text`` in parts of about ``SLICE`` bytes that end at a space or the end of a piece."""
    at = 0
    while len(text) - at > SLICE:
        ends = [e for e in (text.find(b" ", at + SLICE), text.find(b"\n", at + SLICE)) if e >= 0]
        end = min(ends, default=len(text) - 1) + 1
        yield text[at:end]
        at = end
    yield text[at:]


def _phrase_hash(words: list[np.ndarray], lang: str) -> np.ndarray:
    """Places in the filter for phrases given by the CRC-32 of each of their words."""
    h = np.full(len(words[0]), zlib.crc32(lang.encode()), np.uint64)
    for w in words:
        h = (h + w.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _known(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class _Counter:
    """Words of one language, as numbers, until they are counted."""

    def __init__(self, lang: str, size: int, bits: np.ndarray | None) -> None:
        self.lang, self.size, self.bits = lang, size, bits
        self.start()

    def start(self) -> None:
        self.ids, self.parts, self.n = _Ids({b"\n": 0}), [], 0

    def add(self, text: bytes) -> None:
        ids = self.ids
        for part in _slices(text.translate(_FOLD) + b"\n"):
            found = np.array([ids[w] for w in part.replace(b"\n", b" \n ").split(b" ") if w], np.int32)
            self.parts.append(found)
            self.n += len(found)

    def stripes(self) -> Iterator[pa.RecordBatch]:
        """(lang, prefix, next, n) of what was added: one row per prefix, or several of ``ENTRIES`` entries each."""
        x, names = np.concatenate([*self.parts, np.zeros(self.size, np.int32)]).astype(np.int64), list(self.ids)
        self.start()
        names[0] = b""
        m = len(x) - self.size
        grams = [x[k : k + m] for k in range(self.size + 1)]
        keep = np.logical_and.reduce([g != 0 for g in grams[: self.size]])
        if self.bits is not None:
            crc = np.fromiter((zlib.crc32(w) for w in names), np.uint32, len(names))
            keep &= grams[-1] != 0
            grams = [g[keep] for g in grams]
            known = [_known(self.bits, _phrase_hash([crc[g] for g in grams[k : k + self.size]], self.lang)) for k in (0, 1)]
            keep = known[0] & known[1]
        grams = [g[keep] for g in grams]
        if not len(grams[0]):
            return
        key = grams[0]
        for g in grams[1 : self.size]:  # pairs of numbers stay below 2^63, as each is below the number of words
            _, first, key = np.unique(key * len(names) + g, return_index=True, return_inverse=True)
        if self.size > 1:
            order = [g[first] for g in grams[: self.size]]
        else:
            used, key = np.unique(key, return_inverse=True)
            order = [used]
        pairs, n = np.unique(key * len(names) + grams[-1], return_counts=True)
        key, last = pairs // len(names), pairs % len(names)
        words = pa.array(names, pa.binary())
        for a in range(0, len(key), 1 << 17):
            k, w, c = key[a : a + (1 << 17)], last[a : a + (1 << 17)], n[a : a + (1 << 17)]
            new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            within = np.arange(len(k)) - np.repeat(new, np.diff([*new, len(k)]))
            starts = np.flatnonzero(within % ENTRIES == 0)
            offsets = pa.array([*starts, len(k)], pa.int32())
            prefix = pc.binary_join_element_wise(*[words.take(pa.array(o[k[starts]])) for o in order], b" ")
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.lang] * len(starts), pa.string()), prefix, pa.ListArray.from_arrays(offsets, words.take(pa.array(w))), pa.ListArray.from_arrays(offsets, pa.array(c, pa.int64()))],
                ["lang", "prefix", "next", "n"],
            )


def text_stripes(strings: DataFrame, size: int, bits: np.ndarray | None = None, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, prefix, next, n): partial stripes of all prefixes of ``size`` words, counted task by task.

    The end of a piece counts as an empty next word. With ``bits`` only phrases count whose first and whose last ``size``
    words are marked there, and ends don't.
    """
    ship(strings.sparkSession)
    shared = None if bits is None else strings.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, _Counter] = {}
        for b in batches:
            for of, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                c = counters.get(of) or counters.setdefault(of, _Counter(of, size, shared and shared.value))
                c.add(t.as_py())
                if c.n >= WORDS or sum(x.n for x in counters.values()) >= 2 * WORDS:
                    yield from c.stripes()
        for c in counters.values():
            if c.n:
                yield from c.stripes()

    rows = strings.filter(F.length(text) > 0).select(F.coalesce(F.col(lang), F.lit("und")), F.col(text).cast("binary"))
    return rows.mapInArrow(run, "lang string, prefix binary, next array<binary>, n array<long>")


def merge_stripes(stripes: DataFrame, least: int) -> DataFrame:
    """(lang, prefix, total, next, n): stripes of the same prefix added up element by element.

    ``total`` counts the prefix, ends of pieces included; next words are kept from ``least`` on. A row with a null prefix
    adds up all totals of a task. Prefixes with more than ``WHOLE`` entries are dealt out by their next words and have
    several rows, whose totals add up and whose next words differ; a task holds no more than one such part and the next.
    """
    ship(stripes.sparkSession)
    stripes = cut(stripes)
    hot = cut(stripes.groupBy("lang", "prefix").agg(F.sum(F.size("next")).alias("_size")).filter(F.col("_size") > WHOLE).select("lang", "prefix", F.ceil(F.col("_size") / WHOLE).cast("int").alias("_parts")))
    dealt = stripes.withColumn("part", F.lit(0))
    if not hot.isEmpty():
        sized = stripes.join(hot, ["lang", "prefix"], "left")
        one = sized.filter("_parts IS NOT NULL").select("lang", "prefix", "_parts", F.explode(F.arrays_zip("next", "n")).alias("_e"))
        one = one.select("lang", "prefix", F.array("_e.next").alias("next"), F.array("_e.n").alias("n"), (F.pmod(F.xxhash64("_e.next"), F.col("_parts")) + 1).cast("int").alias("part"))
        dealt = sized.filter("_parts IS NULL").drop("_parts").withColumn("part", F.lit(0)).unionByName(one)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, int] = {}
        held: list[pa.RecordBatch] = []
        entries = 0
        for b in batches:
            held.append(b)
            entries += len(b.column(2).flatten())
            if entries >= WHOLE:
                table = pa.Table.from_batches(held).combine_chunks()
                new = _changes(table)
                last = int(np.flatnonzero(new)[-1])
                if last:
                    yield from _merged(table.slice(0, last), new[:last], least, sums)
                held = table.slice(last).to_batches()
                entries = sum(len(h.column(2).flatten()) for h in held)
        if held and sum(h.num_rows for h in held):
            table = pa.Table.from_batches(held).combine_chunks()
            yield from _merged(table, _changes(table), least, sums)
        empty = pa.array([[]] * len(sums), pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([None] * len(sums), pa.binary()), pa.array(list(sums.values()), pa.int64()), empty, pa.array([[]] * len(sums), pa.list_(pa.int64()))], ["lang", "prefix", "total", "next", "n"])

    by = ["lang", "prefix", "part"]
    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "lang string, prefix binary, total long, next array<binary>, n array<long>")


def _changes(table: pa.Table) -> np.ndarray:
    """Whether a row's prefix or part differs from that of the row before."""
    new = np.ones(table.num_rows, bool)
    columns = [table.column(c).combine_chunks() for c in ("lang", "prefix", "part")]
    new[1:] = np.logical_or.reduce([pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False) for c in columns])
    return new


def _merged(table: pa.Table, new: np.ndarray, least: int, sums: dict[str, int]) -> Iterator[pa.RecordBatch]:
    lists, counts = table.column("next").combine_chunks(), table.column("n").combine_chunks().flatten().to_numpy()
    row = np.repeat(np.cumsum(new) - 1, pc.list_value_length(lists).to_numpy())
    words = lists.flatten().dictionary_encode()
    size = max(len(words.dictionary), 1)
    pair, at = np.unique(row * size + words.indices.to_numpy(), return_inverse=True)
    n = np.zeros(len(pair), np.int64)
    np.add.at(n, at, counts)
    firsts = np.flatnonzero(new)
    total = np.zeros(len(firsts), np.int64)
    np.add.at(total, row, counts)
    langs = table.column("lang").combine_chunks().dictionary_encode()
    own = langs.indices.to_numpy()[firsts]
    for k, name in enumerate(langs.dictionary.to_pylist()):
        sums[name] = sums.get(name, 0) + int(total[own == k].sum())
    # a part of a stripe that was dealt out (1 or more) may hold few of its prefix, yet adds to the total
    prefixes, dictionary = table.column("prefix").combine_chunks().take(pa.array(firsts)), words.dictionary
    kept = (total >= least) | (table.column("part").combine_chunks().to_numpy()[firsts] > 0)
    often = (n >= least) & (pc.binary_length(dictionary).to_numpy()[pair % size] > 0)
    where, w, c = pair[often] // size, pair[often] % size, n[often]
    starts = np.searchsorted(where, np.flatnonzero(kept))
    offsets = pa.array([*starts, len(where)], pa.int32())
    yield pa.RecordBatch.from_arrays(
        [langs.dictionary.take(pa.array(own[kept])), prefixes.filter(pa.array(kept)), pa.array(total[kept]), pa.ListArray.from_arrays(offsets, dictionary.take(pa.array(w))), pa.ListArray.from_arrays(offsets, pa.array(c))],
        ["lang", "prefix", "total", "next", "n"],
    )


def frequent_filter(phrases: DataFrame) -> np.ndarray:
    """Bits of all ``phrases`` (lang, phrase): a false hit only costs work, and the size is fixed."""
    ship(phrases.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [int(_phrase_hash([np.array([zlib.crc32(w)], np.uint32) for w in p.encode("utf-8", "surrogatepass").split(b" ")], of)[0]) for of, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], ["at"])

    places = phrases.select("lang", "phrase").mapInArrow(run, "at long")
    found = places.groupBy(F.shiftright("at", 6).alias("row")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[found.column("row").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bits


def mine_phrases(strings: DataFrame, max_words: int = 3, least: int = 10, inside: int = 50, top: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """Collocations of locale strings (lang, key, text): lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and those into words at spaces and tabs; a null
    text is empty, a null language ``und``. Phrases of 2 to ``max_words`` words that occur ``least`` times or more are
    candidates, a being that count. Cut in two, they score floor(1,000,000 a a / (l r)), l and r being the counts of both
    parts; the lowest cut counts, of equal ones that with the shortest first part. A candidate is dropped if some longer
    candidate holds its words in a row and occurs in ``inside`` percent of its places or more. Each language gives its first
    ``top`` rows by score, a (both falling) and phrase (bytes rising); n counts all its words.

    Stripes of one word give all totals and pairs; a longer phrase counts only if both phrases one word shorter are frequent,
    so each further round builds stripes of frequent prefixes alone. A merged stripe holds a prefix's total, its extensions
    and the largest of them. Empty tables and texts without words give no rows; repeated rows count as often as they occur.
    """
    first = cut(merge_stripes(text_stripes(strings, 1, None, lang, text), least))
    words = first.filter("prefix IS NULL").groupBy("lang").agg(F.sum("total").alias("n"))
    prefix = F.col("prefix").cast("string")
    totals = first.filter("prefix IS NOT NULL").groupBy("lang", prefix.alias("phrase")).agg(F.sum("total").alias("f")).filter(F.col("f") >= least)
    level, counts, extended = first, [totals], []
    for size in range(1, max_words):
        if size > 1:
            frequent = counts[-1]
            level = cut(merge_stripes(text_stripes(strings, size, frequent_filter(frequent), lang, text), least))
        rows = level.filter("prefix IS NOT NULL").select("lang", prefix.alias("prefix"), F.explode(F.arrays_zip("next", "n")).alias("_e"))
        counts.append(cut(rows.select("lang", F.concat_ws(" ", "prefix", F.col("_e.next").cast("string")).alias("phrase"), F.col("_e.n").alias("f"))))
        if size > 1:
            extended.append(level.filter((F.col("prefix").isNotNull()) & (F.size("n") > 0)).groupBy("lang", prefix.alias("phrase")).agg(F.max(F.array_max("n")).alias("longer")))
    known = cut(_union(counts))
    candidates = _union(counts[1:]).withColumn("_w", F.split("phrase", " ")).withColumnRenamed("f", "a")
    k = F.explode(F.sequence(F.lit(1), F.size("_w") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "a", "_w", k).select(
        "lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("_w", 1, F.col("k"))).alias("_left"), F.concat_ws(" ", F.slice("_w", F.col("k") + 1, F.size("_w") - F.col("k"))).alias("_right")
    )
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l")), ["lang", "_left"]).join(known.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r")), ["lang", "_right"])
    # a <= l and a <= r, so the quotient fits a long; decimals hold the products
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * CAST(CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) AS DECIMAL(30,0))) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_c"))
    # the largest longer candidate around a phrase: stripes know what follows a prefix, the rest starts inside
    rest = candidates.filter(F.size("_w") > 2).select("lang", F.col("a").alias("longer"), "_w", F.explode(F.sequence(F.lit(2), F.size("_w") - 1)).alias("_size"))
    rest = rest.select("lang", "longer", F.explode(F.transform(F.sequence(F.lit(1), F.size("_w") - F.col("_size") + 1), lambda s: F.concat_ws(" ", F.slice("_w", s, F.col("_size"))))).alias("phrase"))
    around = _union([*extended, rest.select("lang", "phrase", "longer")]).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("_c.score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "_c.l", "_c.r", "n", "_c.score")


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
