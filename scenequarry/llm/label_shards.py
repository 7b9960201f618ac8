"""Shards of catalogue assets by balanced label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenequarry.llm.components import ranked
from scenequarry.session import cut


def _moves(linked: DataFrame, room: list[int]) -> DataFrame:
    """(n, target) of the moves that are admitted in one round, at most ``room`` into each shard."""
    counts = linked.groupBy("tie", "shard").agg(F.count("*").alias("k"))
    best = counts.withColumn("open", F.get(F.array(*[F.lit(r) for r in room]), F.col("shard")) > 0).groupBy("tie")
    aims = best.agg(F.max_by("shard", F.struct("open", "k", -F.col("shard"))).alias("target"), F.max(F.struct("open", "k")).alias("top"))
    aims = aims.filter("top.open").select("tie", "target", F.col("top.k").alias("there"))
    own = counts.join(aims, "tie").filter("shard <> target AND there - k + 1 > 0").select("tie", "shard", "target", (F.col("there") - F.col("k") + 1).alias("gain"))
    wishes = linked.join(own, ["tie", "shard"]).select("n", "target", F.negative("gain").alias("_order"), "tie")
    queue = ranked(wishes, "target", ["_order", "tie", "n"], "_place")
    return queue.filter(F.col("_place") < F.get(F.array(*[F.lit(r) for r in room]), F.col("target"))).select("n", "target")


def _swaps(linked: DataFrame, shards: int) -> DataFrame:
    """(n, target) of one round between full shards: as many go from one to another as come back, those of largest gain.

    All moves of a tie go to the one shard that holds most of it, so no round cuts more links than the last.
    """
    counts = linked.groupBy("tie", "shard").agg(F.count("*").alias("k"))
    aims = counts.groupBy("tie").agg(F.max_by("shard", F.struct("k", -F.col("shard"))).alias("target"), F.max("k").alias("there"))
    own = counts.join(aims, "tie").filter("shard <> target").select("tie", "shard", "target", (F.col("k") - F.col("there")).alias("_order"))
    wishes = linked.join(own, ["tie", "shard"]).select("n", "target", "_order", "tie", (F.col("shard") * shards + F.col("target")).alias("lane"))
    queue = cut(ranked(wishes, "lane", ["_order", "tie", "n"], "_place"))
    many = {r.lane: r.k for r in queue.groupBy("lane").agg(F.count("*").alias("k")).collect()}
    room = [min(many.get(s * shards + t, 0), many.get(t * shards + s, 0)) for s in range(shards) for t in range(shards)]
    return queue.filter(F.col("_place") < F.get(F.array(*[F.lit(r) for r in room]), F.col("lane"))).select("n", "target")


def place_assets(assets: DataFrame, tie: str, order: list[str], shards: int = 8, rounds: int = 8) -> DataFrame:
    """``assets`` as a table with ``shard`` (from 0), counts at most one apart, and ``slot``, gapless from 0 in each shard.

    Assets that share a ``tie`` (a hash of their content, a scene) are linked, each with each; null links to nothing.
    They start dealt out evenly by a hash. In each round every tie aims for the shard where most of its assets are, of
    those that have room; assets elsewhere ask to move there if that leaves fewer links cut. They queue by gain and are
    admitted up to the shard's room, which is its quota less the linked assets that it holds. Where no shard has room,
    assets that want to change places are swapped. Rounds end when nothing moves, or after ``rounds``. Assets without links then fill each shard to its quota and move only if they are over it.
    Votes are counts by (tie, shard), so a tie that a third of all assets share makes at most ``shards`` rows; queues are
    ranked by range. ``order`` (columns) breaks ties and orders the slots. Repeated rows keep their number; existing
    columns ``shard`` and ``slot`` are replaced.
    """
    kept = [c for c in assets.columns if c not in ("shard", "slot")]
    # the caller's columns travel as one struct, so none of their names can clash with those used here
    own = assets.select(F.struct(*[F.col(c) for c in kept]).alias("_own"), F.col(tie).alias("_tie"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    tie, order = "_tie", [f"_o{i}" for i in range(len(order))]
    dealt = cut(ranked(cut(own.withColumn("_all", F.lit(0)).withColumn("_h", F.xxhash64(*order))), "_all", ["_h", *order], "n").withColumn("shard", F.pmod("n", F.lit(shards)).cast("int")))
    total = dealt.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    ties = dealt.filter(F.col(tie).isNotNull()).groupBy(F.col(tie).alias("tie")).agg(F.count("*").alias("k")).filter("k > 1").select("tie")
    linked = cut(dealt.join(ties, dealt[tie] == ties["tie"]).select("n", "tie", "shard"))

    def held() -> list[int]:
        got = {r.shard: r.k for r in linked.groupBy("shard").agg(F.count("*").alias("k")).collect()}
        return [got.get(s, 0) for s in range(shards)]

    full = held()
    for _ in range(rounds if sum(full) else 0):
        moves = cut(_moves(linked, [q - f for q, f in zip(quota, full, strict=True)]))
        if moves.isEmpty():
            moves = cut(_swaps(linked, shards))
        if moves.isEmpty():
            break
        linked = cut(linked.join(moves, "n", "left").select("n", "tie", F.coalesce("target", "shard").alias("shard")))
        full = held()
    free = dealt.join(linked, "n", "left_anti").select("n", "shard")
    queue = cut(ranked(free, "shard", ["n"], "_place"))
    space = [q - f for q, f in zip(quota, full, strict=True)]
    over = F.col("_place") >= F.get(F.array(*[F.lit(s) for s in space]), F.col("shard"))
    stay = {r.shard: r.k for r in queue.filter(~over).groupBy("shard").agg(F.count("*").alias("k")).collect()}
    ends, so_far = [], 0
    for s in range(shards):
        so_far += space[s] - stay.get(s, 0)
        ends.append(so_far)
    spare = ranked(queue.filter(over).select("n").withColumn("_all", F.lit(0)), "_all", ["n"], "_place")
    sent = spare.select("n", F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: F.col("_place") >= e)).alias("shard"))
    places = cut(linked.select("n", "shard").unionByName(queue.filter(~over).select("n", "shard")).unionByName(sent))
    placed = dealt.drop("shard", "_all", "_h").join(places, "n").drop("n")
    return ranked(cut(placed), "shard", order, "slot").select(*[F.col("_own").getField(c).alias(c) for c in kept], "shard", "slot")
