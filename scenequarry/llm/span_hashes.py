"""Fingerprints of locale strings by prefix polynomial hashes.

A text's modular prefix array answers whether any two spans are equal with one product each; the longest common extension of
two places is found by binary search over such answers. A fingerprint keeps the prefix hashes at a bounded number of places
that the text itself picks, so two fingerprints can be compared in the same way as the texts, span by span.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenequarry.llm.shipping import ship
from scenequarry.session import cut

#: Two primes below 2^31 with a base each: a product of two residues fits 64 bits.
PRIMES, BASES = (2147483647, 2147483629), (1_234_567_891, 987_654_323)
LOW = 1 << 16
#: Characters of the window that picks places, which is also the shortest run that counts as common.
WINDOW = 8
#: Places that a fingerprint keeps at most.
PLACES = 32
_DIGITS = "0123456789abcdefghijklmnopqrstuvwxyz"


class _Powers:
    """Powers of ``base`` modulo ``prime`` for exponents of any size, from a table for the low 16 bits and one for the rest."""

    def __init__(self, base: int, prime: int) -> None:
        self.prime = np.uint64(prime)
        self.low = self._table(base, prime, LOW)
        self.step, self.high = pow(base, LOW, prime), np.ones(1, np.uint64)

    @staticmethod
    def _table(base: int, prime: int, n: int) -> np.ndarray:
        t = np.ones(1, np.uint64)
        while len(t) < n:
            t = np.concatenate([t, t * np.uint64(pow(base, len(t), prime)) % np.uint64(prime)])
        return t[:n]

    def run(self, first: int, n: int) -> np.ndarray:
        """The powers of ``first``, ``first`` + 1, ... (``n`` of them)."""
        if first + n <= LOW:
            return self.low[first : first + n]
        at = np.arange(first, first + n)
        if at[-1] >> 16 >= len(self.high):
            self.high = self._table(self.step, int(self.prime), int(at[-1] >> 16) * 2)
        return self.low[at & (LOW - 1)] * self.high[at >> 16] % self.prime


POWERS = tuple(_Powers(b, p) for b, p in zip(BASES, PRIMES, strict=True))
INVERSES = tuple(_Powers(pow(b, -1, p), p) for b, p in zip(BASES, PRIMES, strict=True))


class PrefixHashes:
    """Prefix arrays of one text: entry i is the sum of (code point + 1) * base^k over its first i characters, modulo a prime."""

    def __init__(self, text: str) -> None:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self._fill(codes, [self._sums(codes, m) for m in (0, 1)])

    def _fill(self, codes: np.ndarray, arrays: list[np.ndarray]) -> None:
        self.n, self.codes, self.arrays = len(codes), codes, arrays

    @staticmethod
    def _sums(codes: np.ndarray, m: int) -> np.ndarray:
        out = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * POWERS[m].run(0, len(codes)) % POWERS[m].prime, out=out[1:])
        return out % POWERS[m].prime

    def span(self, i: int, j: int) -> tuple[int, int]:
        """Hash of characters i to j (exclusive), the same wherever that span stands."""
        return tuple((int(a[j]) - int(a[i])) * int(inv.run(i, 1)[0]) % p for a, inv, p in zip(self.arrays, INVERSES, PRIMES, strict=True))

    def equal_spans(self, i: int, other: PrefixHashes, j: int, length: int) -> bool:
        return i + length <= self.n and j + length <= other.n and self.span(i, i + length) == other.span(j, j + length)

    def common_extension(self, i: int, other: PrefixHashes, j: int) -> int:
        """Characters that agree from place i here and place j there on, by binary search."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal_spans(i, other, j, middle) else (low, middle - 1)
        return low

    def splice(self, keep: int, other: PrefixHashes, take: int) -> PrefixHashes:
        """Hashes of the first ``keep`` characters followed by the first ``take`` of ``other``, from both arrays alone."""
        new = PrefixHashes.__new__(PrefixHashes)
        arrays = [np.concatenate([a[: keep + 1], (a[keep] + b[1 : take + 1] * p.run(keep, 1)[0]) % p.prime]) for a, b, p in zip(self.arrays, other.arrays, POWERS, strict=True)]
        new._fill(np.concatenate([self.codes[:keep], other.codes[:take]]), arrays)
        return new

    @cached_property
    def levels(self) -> np.ndarray:
        """For each place from ``WINDOW`` on, how rare the window that ends there is: trailing zeros of its mixed hash."""
        a, prime = self.arrays[0], POWERS[0].prime
        if self.n < WINDOW:
            return np.zeros(0, np.int8)
        h = (a[WINDOW:] + prime - a[:-WINDOW]) % prime * INVERSES[0].run(0, self.n - WINDOW + 1) % prime
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        low = (h & (~h + np.uint64(1))).astype(np.float64)
        return np.where(h == 0, 32, np.log2(np.maximum(low, 1))).astype(np.int8)

    def fingerprint(self) -> Fingerprint:
        """Length, whole hashes, and the prefix hashes at the places of the lowest level that has at most ``PLACES`` of them."""
        counts = np.bincount(self.levels, minlength=33)[::-1].cumsum()[::-1]
        level = int(np.argmax(counts <= PLACES)) if counts[-1] <= PLACES else 33
        at = np.flatnonzero(self.levels >= level)
        places = at + WINDOW
        return Fingerprint(self.n, tuple(int(a[-1]) for a in self.arrays), level, places.tolist(), self.levels[at].tolist(), self.arrays[0][places].tolist())


class Fingerprint:
    """What ``PrefixHashes.fingerprint`` keeps; ``str`` gives its text, equal for equal strings."""

    def __init__(self, n: int, whole: tuple[int, int], level: int, places: list[int], levels: list[int], hashes: list[int]) -> None:
        self.n, self.whole, self.level, self.places, self.levels, self.hashes = n, whole, level, places, levels, hashes

    def __str__(self) -> str:
        steps = [p - q for p, q in zip(self.places, [0, *self.places], strict=False)]
        parts = [f"{_DIGITS[v]}{s:x}.{h:08x}" for v, s, h in zip(self.levels, steps, self.hashes, strict=True)]
        return f"{self.n:x}-{self.whole[0]:08x}{self.whole[1]:08x}-{_DIGITS[self.level]}" + "".join(f"-{x}" for x in parts)

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        n, whole, level, *parts = text.split("-")
        steps = [int(x[1 : x.index(".")], 16) for x in parts]
        return cls(int(n, 16), (int(whole[:8], 16), int(whole[8:], 16)), _DIGITS.index(level), np.cumsum(steps, dtype=int).tolist(), [_DIGITS.index(x[0]) for x in parts], [int(x[-8:], 16) for x in parts])

    def marks(self, level: int) -> tuple[list[int], list[int]]:
        """Places and prefix hashes at ``level`` or rarer, with both ends of the text."""
        kept = [i for i, v in enumerate(self.levels) if v >= level]
        at, h = [0, *[self.places[i] for i in kept]], [0, *[self.hashes[i] for i in kept]]
        return (at, h) if at[-1] == self.n else ([*at, self.n], [*h, self.whole[0]])

    def likeness(self, other: Fingerprint) -> float:
        """Share of both texts that lies in common runs of ``WINDOW`` characters or more, 0 to 1; 1 for equal fingerprints.

        Both sides are cut at the places of the higher of their levels. From each span that the other side has too, the
        longest common extension is found by binary search over the kept prefix hashes; the longest run is taken, and no
        span counts twice.
        """
        if (self.n, self.whole) == (other.n, other.whole):
            return 1.0
        level, prime = max(self.level, other.level), PRIMES[0]
        (pa_, ha), (pb, hb) = self.marks(level), other.marks(level)
        ia, ib = [pow(BASES[0], -p, prime) for p in pa_], [pow(BASES[0], -p, prime) for p in pb]
        where: dict[tuple[int, int], list[int]] = {}
        for j in range(len(pb) - 1):
            where.setdefault((pb[j + 1] - pb[j], (hb[j + 1] - hb[j]) * ib[j] % prime), []).append(j)
        used, common, i = [False] * len(pb), 0, 0
        while i < len(pa_) - 1:
            best, at = 0, 0
            for j in where.get((pa_[i + 1] - pa_[i], (ha[i + 1] - ha[i]) * ia[i] % prime), ()):
                if used[j]:
                    continue
                low, high = 1, min(len(pa_) - 1 - i, next((k for k in range(j, len(pb) - 1) if used[k]), len(pb) - 1) - j)
                while low < high:
                    m = (low + high + 1) // 2
                    same = pa_[i + m] - pa_[i] == pb[j + m] - pb[j] and ((ha[i + m] - ha[i]) * ia[i] - (hb[j + m] - hb[j]) * ib[j]) % prime == 0
                    low, high = (m, high) if same else (low, m - 1)
                if low > best:
                    best, at = low, j
            if best and pa_[i + best] - pa_[i] >= WINDOW:
                common += pa_[i + best] - pa_[i]
                used[at : at + best] = [True] * best
            i += max(best, 1)
        return 2 * common / (self.n + other.n)


def fingerprint_strings(strings: DataFrame, text: str = "text", fingerprint: str = "fingerprint") -> DataFrame:
    """``strings`` (locale strings: lang, key, text) with the fingerprint of each whole text; null counts as empty.

    Equal texts have equal fingerprints. Other columns stay; a column that is already named ``fingerprint`` is replaced.
    """
    ship(strings.sparkSession)
    kept = strings.drop(fingerprint) if fingerprint != text else strings
    schema = T.StructType([*kept.schema.fields, T.StructField(fingerprint, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [str(PrefixHashes(t or "").fingerprint()) for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.string())], [*b.schema.names, fingerprint])

    return kept.mapInArrow(run, schema)


def _below(ends: Column, row: Column, n: int) -> Column:
    """How many entries of the sorted array ``ends`` (``n`` of them) lie below ``row``, by halving steps."""
    steps = [1 << k for k in reversed(range(n.bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when((at + s <= n) & (F.get(ends, at + s - 1) < row), at + s).otherwise(at))


def in_order(strings: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows in ranges that follow each other, each sorted and led by the row before it: adds ``_part`` and ``_lead``.

    Spark's own range partitioning of the order columns gives the ends of the ranges, one per shuffle partition, so their
    list is as long as the one that Spark itself keeps. The last row of a range goes to the next range too, with ``_lead``
    true; the last one of all leads the first range.
    """
    spark = strings.sparkSession
    row = F.struct(*order)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = strings.select(*order).repartitionByRange(n, *order).groupBy(F.spark_partition_id().alias("_p")).agg(F.max(row).alias("_end"))
    ends = cut(ranges.agg(F.array_sort(F.collect_set("_end")).alias("_ends")))
    count = max(ends.select(F.size("_ends")).first()[0], 1)
    part = _below(F.col("_ends"), row, count)
    placed = strings.withColumn("_ends", ends.scalar()).withColumn("_part", part).withColumn("_last", F.get("_ends", F.col("_part")) == row)
    here = F.struct(F.col("_part").alias("part"), F.lit(False).alias("lead"))
    there = F.struct(((F.col("_part") + 1) % count).alias("part"), F.lit(True).alias("lead"))
    dealt = placed.withColumn("_to", F.explode(F.when(F.col("_last"), F.array(here, there)).otherwise(F.array(here))))
    rows = dealt.select(*strings.columns, F.col("_to.part").alias("_part"), F.col("_to.lead").alias("_lead"))
    return rows.repartitionById(count, "_part").sortWithinPartitions("_part", F.desc("_lead"), *order)


#: Columns that ``compare_neighbours`` adds.
COMPARED = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, common_prefix long, near_edited double, near_next double"


def compare_neighbours(strings: DataFrame, key: str = "key", text: str = "text", part: int = 3) -> DataFrame:
    """Each locale string against the next one in descending order of ``key``, and against a blend of both.

    The blend replaces the last floor(n / ``part``) characters of a text by as many first ones of the next text, or all it
    has; after the last row comes the first. Its hashes are spliced from the two prefix arrays. Returns ``key`` with
    ``COMPARED``: characters, SHA-256 of the blend, both fingerprints, the characters that text and blend share from their
    start (binary search), and the likeness of the text's fingerprint to the blend's and to the next text's.

    Null texts count as empty; null keys come last; equal keys follow the hash of their text. Each row is kept, repeated
    ones too; a single row is its own next. An empty table gives no rows.
    """
    ship(strings.sparkSession)
    rows = strings.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn("_tie", F.xxhash64("_text"))
    dealt = in_order(rows, ["_key", "_tie"]).select("_key", "_text", "_part", "_lead")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_key", *[c.split()[0] for c in COMPARED.split(", ")]]
        after = None  # text, hashes and fingerprint of the row before, which is the next one in descending order
        for whole in batches:
            for b in (whole.slice(k, 500) for k in range(0, whole.num_rows, 500)):
                keep, found = [], []
                for i, (t, lead) in enumerate(zip(b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True)):
                    hashes = PrefixHashes(t)
                    own = t, hashes, hashes.fingerprint()
                    if not lead:
                        keep.append(i)
                        found.append(_compared(own, after or own, part))
                    after = own
                columns = [pa.array([f[k] for f in found], T_) for k, T_ in enumerate([pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.float64(), pa.float64()])]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), *columns], names)

    schema = T.StructType([dealt.schema["_key"], *T._parse_datatype_string(COMPARED).fields])
    return dealt.mapInArrow(run, schema).withColumnRenamed("_key", key)


def _compared(own: tuple, after: tuple, part: int) -> tuple:
    text, hashes, mark = own
    keep = len(text) - len(text) // part
    take = min(len(text) - keep, len(after[0]))
    edited = hashes.splice(keep, after[1], take)
    other = edited.fingerprint()
    sha = hashlib.sha256((text[:keep] + after[0][:take]).encode("utf-8", "surrogatepass")).hexdigest()
    return len(text), sha, str(mark), str(other), hashes.common_extension(0, edited, 0), mark.likeness(other), mark.likeness(after[2])
