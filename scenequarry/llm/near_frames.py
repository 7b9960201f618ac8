"""Near-duplicate frames: SimHash fingerprints of captions and vantage-point trees over their Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenequarry.llm.cells import cells
from scenequarry.llm.components import connected
from scenequarry.llm.shipping import ship
from scenequarry.session import cut

SEED = 42
STEP = 1 << 15


def caption_hash(caption: str | None, words: int) -> int:
    """64-bit SimHash of one caption as a signed number; see ``caption_phash``."""
    parts = (caption or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    text = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    n = max(len(parts) - words, 0) + 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(words, len(parts)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for k in range(0, n, STEP):
        h = np.fromiter((digest(text[i:j], SEED) for i, j in zip(starts[k : k + STEP], stops[k : k + STEP], strict=True)), np.uint64)
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view(np.int64)[0])


def caption_phash(frames: DataFrame, caption: str = "caption", phash: str = "phash", words: int = 4) -> DataFrame:
    """``frames`` with a 64-bit fingerprint of the whole caption in ``phash`` (bigint), all other columns as they were.

    A-Z are lower-cased, words are split at ASCII white space, shingles of ``words`` words count as often as they occur;
    a shorter caption is one shingle. Bit i is set when more than half of the shingles' XXH64 values (seed 42) have it
    set. A null or empty caption has fingerprint 0. A column that is already named ``phash`` is replaced.
    """
    ship(frames.sparkSession)
    kept = [c for c in frames.columns if c != phash]
    schema = T.StructType([*frames.select(*kept).schema.fields, T.StructField(phash, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = [caption_hash(t, words) for t in b.column(caption).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(h, pa.int64())], [*b.schema.names, phash])

    return frames.select(*kept).mapInArrow(run, schema)


class VantageTree:
    """A full binary tree: the points within ``radius`` of a node's vantage point go left, the others right.

    Built from a sample; any point can be routed. ``homes`` gives a point's own leaf, ``visits`` all leaves that can hold
    a point within ``reach`` of it, by the triangle bound on the distance to the vantage point.
    """

    def __init__(self, sample: np.ndarray, depth: int, seed: int = 7) -> None:
        self.depth = depth
        self.vantage = np.zeros((1 << depth) - 1, np.uint64)
        self.radius = np.zeros((1 << depth) - 1, np.int64)
        rng = np.random.default_rng(seed)
        parts = {0: np.unique(sample.astype(np.uint64))}
        for node in range((1 << depth) - 1):
            own = parts.pop(node)
            if len(own):
                tried = own[rng.integers(0, len(own), 6)]
                best = None
                for v in tried:
                    d = np.bitwise_count(own ^ v).astype(np.int64)
                    r = int(np.median(d))
                    r = min((r - 1, r), key=lambda x: abs(2 * int((d <= x).sum()) - len(own)))
                    cost = (max((d <= r).mean(), (d > r).mean()), int(((d == r) | (d == r + 1)).sum()))
                    if best is None or cost < best[0]:
                        best = (cost, v, r, d)
                _, self.vantage[node], self.radius[node], d = best
                parts[2 * node + 1], parts[2 * node + 2] = own[d <= self.radius[node]], own[d > self.radius[node]]
            else:
                parts[2 * node + 1] = parts[2 * node + 2] = own

    def homes(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            d = np.bitwise_count(x ^ self.vantage[at])
            at = 2 * at + 1 + (d > self.radius[at])
        return at - len(self.vantage)

    def visits(self, x: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf to be searched."""
        row, at = np.arange(len(x)), np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            d = np.bitwise_count(x[row] ^ self.vantage[at]).astype(np.int64)
            near, far = d - reach <= self.radius[at], d + reach > self.radius[at]
            row, at = np.concatenate([row[near], row[far]]), np.concatenate([2 * at[near] + 1, 2 * at[far] + 2])
        return row, at - len(self.vantage)


def _bands(bits: int) -> list[tuple[int, int, int]]:
    """(shift, width, reach) of bit ranges: two codes within ``bits`` are within ``reach`` in one range at least."""
    k = max(1, -(-(bits + 1) // 2))
    cuts = [64 * i // k for i in range(k + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i], bits // k) for i in range(k)]


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node joined to it) for the given links, without the smallest nodes themselves."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    low = np.arange(len(nodes))
    while True:
        old = low.copy()
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, low[a], m)
        np.minimum.at(low, low[b], m)
        low = low[low]
        if (low == old).all():
            break
    other = low != np.arange(len(nodes))
    return nodes[other], nodes[low[other]]


def linked_hashes(codes: DataFrame, phash: str = "phash", bits: int = 4, leaf: int = 1024, sample: int = 20_000) -> DataFrame:
    """Links (``a``, ``b``) that join all different fingerprints of at most ``bits`` differing bits, as spanning trees.

    The 64 bits are cut into ranges so that near pairs are at most one bit apart in one of them. Each range has a
    vantage-point tree; its leaves are the shards of the search. A fingerprint has a home in one leaf and visits those
    that the triangle bound does not rule out. Within a leaf, cells of at most ``leaf`` by ``leaf`` fingerprints are
    compared exactly on all 64 bits. ``sample`` fingerprints at most, drawn by hash, choose the vantage points; the result
    does not depend on them. A cell returns a spanning forest of its links, not all pairs.
    """
    spark = codes.sparkSession
    ship(spark)
    own = cut(codes.select(F.col(phash).alias("code")).filter("code IS NOT NULL").distinct())
    n = own.count()
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / leaf))))
    depth = min(depth, int(np.log2(sample / 8)))
    share = min(1.0, sample / max(n, 1))
    drawn = [r[0] for r in own.filter(F.pmod(F.xxhash64("code"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * sample).collect()] if depth else []
    points = np.array(drawn, np.int64).view(np.uint64)
    bands = _bands(bits)
    masks = [np.uint64((1 << w) - 1) for _, w, _ in bands]
    trees = spark.sparkContext.broadcast([VantageTree((points >> np.uint64(s)) & m, depth) for (s, _, _), m in zip(bands, masks, strict=True)])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = b.column(0).to_numpy(zero_copy_only=False)
            for k, (shift, _, reach) in enumerate(bands):
                x = (code.view(np.uint64) >> np.uint64(shift)) & masks[k]
                home = trees.value[k].homes(x)
                row, at = trees.value[k].visits(x, reach)
                for leaves, own_code, probe in ((home, code, False), (at, code[row], True)):
                    size = len(leaves)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(size, k, np.int32)), pa.array(leaves.astype(np.int32)), pa.array(own_code), pa.array(np.full(size, probe))], ["band", "leaf", "code", "visit"])

    routed = cut(own.mapInArrow(route, "band int, leaf int, code long, visit boolean"))
    grid = cells(routed.filter("NOT visit").drop("visit"), routed.filter("visit").drop("visit"), ["band", "leaf"], "code", leaf)

    def compare(_: tuple, rows: pa.Table) -> pa.Table:
        code, probe = rows.column("code").to_numpy(), rows.column("probe").to_numpy()
        index, probes = code[~probe].view(np.uint64), code[probe].view(np.uint64)
        left, right = [], []
        for k in range(0, len(probes), leaf):
            p = probes[k : k + leaf]
            i, j = np.nonzero(np.bitwise_count(p[:, None] ^ index[None, :]) <= bits)
            other = p[i] != index[j]
            left.append(p[i[other]].view(np.int64))
            right.append(index[j[other]].view(np.int64))
        a, b = forest(np.concatenate(left or [code[:0]]), np.concatenate(right or [code[:0]]))
        return pa.table({"a": a, "b": b})

    return grid.groupBy("band", "leaf", "ci", "cj").applyInArrow(compare, "a long, b long").distinct()


def near_frames(frames: DataFrame, frame_id: str = "frame_id", phash: str = "phash", bits: int = 4, out: str = "group_id") -> DataFrame:
    """``frames`` as a written table with ``out``: the smallest ``frame_id`` that is reached over links of at most ``bits`` differing bits.

    Frames with equal fingerprints are one point of the search, so copies make no pairs. A null fingerprint links to
    nothing: the frame keeps its own id. Null ids take no part in the smallest id; a group of null ids alone has null.
    Repeated rows keep their number. An existing column ``out`` is replaced.
    """
    frames = cut(frames.drop(out))
    heads = cut(frames.filter(F.col(phash).isNotNull()).groupBy(F.col(phash).alias("_code")).agg(F.min(frame_id).alias("_low")))
    parts = cut(connected(linked_hashes(heads, "_code", bits), "a", "b"))
    placed = heads.join(parts, heads["_code"] == parts["node"], "left").select("_code", "_low", F.coalesce("component", "_code").alias("_part"))
    lows = placed.groupBy("_part").agg(F.min("_low").alias("_group"))
    groups = placed.join(lows, "_part").select("_code", "_group")
    joined = frames.join(groups, frames[phash] == groups["_code"], "left")
    return joined.select(*frames.columns, F.when(F.col(phash).isNull(), F.col(frame_id)).otherwise(F.col("_group")).alias(out))
