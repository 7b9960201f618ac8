"""A palette of splat features by exact rounds of centroids over dictionaries of subvectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenequarry.llm.shipping import ship
from scenequarry.session import cut

#: Rows that share one dictionary.
CHUNK = 8192
#: Whole numbers below this bound keep all sums of products within 53 bits (for up to 1024 components); larger ones are worked out
#: with Python's numbers.
PLAIN = 1 << 20
LIMB = 1 << 40


def usable_features(splats: DataFrame, features: str = "features", components: int = 64) -> Column:
    """Whether the features have exactly ``components`` entries, none of them null, NaN or infinite."""
    v = F.col(features)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) == components) & ~bad, F.lit(False))


def whole_numbers(column: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) for each component, exactly; objects where the numbers leave ``PLAIN``."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    y = np.floor(scale * np.clip(x, -PLAIN, PLAIN))
    if not len(x) or max(abs(x.min()), abs(x.max())) * scale < PLAIN:
        return y.astype(np.int64)
    exact = [[(lambda a, b: scale * a // b)(*float(v).as_integer_ratio()) for v in row] for row in x]
    return np.array(exact, object).reshape(x.shape)


@dataclass
class Chunk:
    """Rows as codes into one dictionary of distinct subvectors per block of components."""

    codes: list[np.ndarray]
    entries: list[np.ndarray]

    @classmethod
    def encode(cls, x: np.ndarray, width: int) -> Chunk:
        codes, entries = [], []
        for a in range(0, x.shape[1], width):
            part = np.ascontiguousarray(x[:, a : a + width])
            if x.dtype == object:
                table: dict[tuple, int] = {}
                codes.append(np.array([table.setdefault(tuple(r), len(table)) for r in part], np.int64))
                entries.append(np.array(list(table), object).reshape(len(table), -1))
                continue
            _, first, code = np.unique(part.view(np.dtype((np.void, part.dtype.itemsize * part.shape[1]))).ravel(), return_index=True, return_inverse=True)
            codes.append(code)
            entries.append(part[first])
        return cls(codes, entries)

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distances (row, centroid): each distinct subvector against each centroid once, then sums by code."""
        out, a = 0, 0
        plain = self.entries[0].dtype != object and centroids.dtype != object
        for code, e in zip(self.codes, self.entries, strict=True):
            c = centroids[:, a : a + e.shape[1]]
            a += e.shape[1]
            if plain:  # whole numbers below 2^53: exact in doubles
                u, v = e.astype(np.float64), c.astype(np.float64)
                part = (u * u).sum(1)[:, None] - 2 * (u @ v.T) + (v * v).sum(1)[None, :]
            else:
                d = e.astype(object)[:, None, :] - c.astype(object)[None, :, :]
                part = (d * d).sum(2)
            out = out + part[code]
        return out

    def sums(self, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, component sums) of each centroid: uses of each subvector by centroid, times the subvectors."""
        parts = []
        for code, e in zip(self.codes, self.entries, strict=True):
            uses = np.bincount(of * len(e) + code, minlength=k * len(e)).reshape(k, len(e))
            parts.append(uses.astype(object) @ e if e.dtype == object else (uses.astype(np.float64) @ e.astype(np.float64)).astype(np.int64))
        return np.bincount(of, minlength=k), np.concatenate(parts, axis=1)

    def pack(self) -> tuple[list[bytes], list[bytes], list[int]]:
        """Codes and entries as bytes (numbers beyond ``PLAIN`` as decimal text) and the lengths of the dictionaries."""
        entries = [" ".join(map(str, e.ravel())).encode() if e.dtype == object else e.astype(np.int32).tobytes() for e in self.entries]
        return [c.astype(np.uint16).tobytes() for c in self.codes], entries, [len(e) for e in self.entries]

    @classmethod
    def unpack(cls, codes: list[bytes], entries: list[bytes], sizes: list[int], plain: bool) -> Chunk:
        read = (lambda e: np.frombuffer(e, np.int32).astype(np.int64)) if plain else (lambda e: np.array([int(x) for x in e.split()], object))
        return cls([np.frombuffer(c, np.uint16).astype(np.int64) for c in codes], [read(e).reshape(n, -1) for e, n in zip(entries, sizes, strict=True)])


def subvector_chunks(splats: DataFrame, splat_id: str = "splat_id", features: str = "features", components: int = 64, width: int = 8, scale: int = 256) -> DataFrame:
    """(ids, codes, entries, sizes, plain): features as whole numbers floor(scale * x), dictionary-encoded without loss.

    Each task encodes its rows ``CHUNK`` at a time; every block of ``width`` components gets a dictionary of its distinct
    subvectors. Rows whose features are not usable (see ``usable_features``) are left out.
    """
    ship(splats.sparkSession)
    rows = splats.filter(usable_features(splats, features, components)).select(F.col(splat_id).cast("long"), F.col(features).cast("array<double>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _of_size(batches, CHUNK):
            x = whole_numbers(b.column(1), scale)
            codes, entries, sizes = Chunk.encode(x, width).pack()
            yield pa.RecordBatch.from_pylist(
                [{"ids": b.column(0).to_pylist(), "codes": codes, "entries": entries, "sizes": sizes, "plain": x.dtype != object}],
                pa.schema({"ids": pa.list_(pa.int64()), "codes": pa.list_(pa.binary()), "entries": pa.list_(pa.binary()), "sizes": pa.list_(pa.int32()), "plain": pa.bool_()}),
            )

    return rows.mapInArrow(run, "ids array<long>, codes array<binary>, entries array<binary>, sizes array<int>, plain boolean")


def _of_size(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows``; the last may be shorter."""
    held, n = [], 0
    for b in batches:
        while n + b.num_rows >= rows:
            held.append(b.slice(0, rows - n))
            b, n = b.slice(rows - n), 0
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        if b.num_rows:
            held.append(b)
            n += b.num_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _chunks(b: pa.RecordBatch) -> Iterator[tuple[list[int], Chunk]]:
    for k in range(b.num_rows):
        ids, codes, entries, sizes, plain = (b.column(c)[k].as_py() for c in ("ids", "codes", "entries", "sizes", "plain"))
        yield ids, Chunk.unpack(codes, entries, sizes, plain)


def _array(rows: Sequence[Sequence[int]]) -> np.ndarray:
    big = any(abs(v) >= PLAIN for r in rows for v in r)
    return np.array(rows, object if big else np.int64).reshape(len(rows), -1)


def first_centroids(splats: DataFrame, k: int, splat_id: str, features: str, components: int, scale: int, salt: str) -> np.ndarray:
    """The ``k`` usable rows with the smallest hexadecimal SHA-256 of ``salt`` and id, in that order; equal ids by their features."""
    rows = splats.filter(usable_features(splats, features, components)).select(F.col(splat_id).cast("long").alias("i"), F.col(features).cast("array<double>").alias("v"))
    drawn = rows.orderBy(F.sha2(F.concat(F.lit(salt), F.col("i").cast("string")), 256).asc_nulls_last(), "v").limit(k).toArrow()
    return _array(whole_numbers(drawn.column("v").combine_chunks(), scale).tolist()) if drawn.num_rows else np.zeros((0, components), np.int64)


def cluster_splats(splats: DataFrame, k: int = 40, rounds: int = 5, splat_id: str = "splat_id", features: str = "features", components: int = 64, width: int = 8, scale: int = 256, salt: str = "2:") -> DataFrame:
    """Splats by the nearest of ``k`` palette entries: splat_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Features with exactly ``components`` finite entries take part, as whole numbers floor(scale * x). Palette entries start
    as the rows of ``first_centroids``. A round assigns each row to the nearest entry (squared Euclidean distance, ties to
    the smaller number) and moves each entry that has rows to the componentwise floor(sum / rows). After ``rounds`` rounds
    rows are assigned once more; ``distance`` is that squared distance, the inertias are its sums over the cluster and over
    all, and the hash is that of the entry's components, joined by commas.

    The tables of subvectors are built once; only ``k`` entries and their sums leave the tasks. Everything is exact; a
    distance or sum that no long can hold is null. Repeated rows count as often as they occur, rows with a null id start
    no entry before others; fewer than ``k`` rows give as many entries; an empty table gives no rows.
    """
    spark = splats.sparkSession
    chunks = cut(subvector_chunks(splats, splat_id, features, components, width, scale))
    centroids = first_centroids(splats, k, splat_id, features, components, scale, salt)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(chunks, centroids)
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, chunk in _chunks(b):
                d = chunk.distances(shared.value)
                of = d.argmin(1)
                best = [None if v >= 1 << 63 else int(v) for v in d[np.arange(len(of)), of]]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(of, pa.int32()), pa.array(best, pa.int64())], [splat_id, "cluster", "distance"])

    assigned = cut(chunks.mapInArrow(assign, f"`{splat_id}` long, cluster int, distance long"))
    total = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    own = assigned.groupBy("cluster").agg(F.count("distance").alias("_k"), F.count("*").alias("_n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("_s"))
    sums = {r.cluster: (r["_s"] if r["_k"] == r["_n"] else None) for r in own.toLocalIterator()}
    fits = lambda v: int(v) if v is not None and v < 1 << 63 else None
    whole = fits(sum(sums.values())) if all(v is not None for v in sums.values()) else None
    shas = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]
    told = spark.createDataFrame([(c, fits(v), whole, shas[c]) for c, v in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(told), "cluster").select(splat_id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _moved(chunks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Palette entries after one round. Sums travel in limbs of 40 bits, so no size overflows."""
    shared, k = chunks.sparkSession.sparkContext.broadcast(centroids), len(centroids)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = np.zeros(k, np.int64), 0
        for b in batches:
            for _, chunk in _chunks(b):
                n, s = chunk.sums(chunk.distances(shared.value).argmin(1), k)
                rows, sums = rows + n, sums + s.astype(object)
        if rows.any():
            out: list[tuple[int, int, int, int]] = []
            for c in np.flatnonzero(rows):
                out.append((int(c), -1, 0, int(rows[c])))
                for j, v in enumerate(sums[c]):
                    v, limb = int(v), 0
                    while abs(v) >= LIMB:
                        v, low = divmod(v, LIMB)
                        out.append((int(c), j, limb, low))
                        limb += 1
                    out.append((int(c), j, limb, v))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.int32(), pa.int32(), pa.int32(), pa.int64()], strict=True)], ["c", "j", "limb", "v"])

    found = chunks.mapInArrow(count, "c int, j int, limb int, v long").groupBy("c", "j", "limb").agg(F.sum("v").alias("v")).toLocalIterator()
    rows, sums = [0] * k, [[0] * centroids.shape[1] for _ in range(k)]
    for r in found:
        if r.j < 0:
            rows[r.c] = r.v
        else:
            sums[r.c][r.j] += r.v * LIMB**r.limb
    shared.unpersist()
    return _array([[v // n for v in s] if n else list(map(int, c)) for n, s, c in zip(rows, sums, centroids, strict=True)])
