"""Relocation of dead rows onto sampled live rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenequarry.operators.ordering import weighted_draw_replace
from scenequarry.operators.selection import is_dead


def relocate_dead(splats: DataFrame, min_opacity: float, weight: Column, seed: int, rows_per_bucket: int | None = None) -> DataFrame:
    """Each dead row with the parameters of a live row drawn by weight: the source's columns, ``source_id`` and ``copies``

    (the source and all dead rows placed on it).
    """
    dead = splats.filter(is_dead(min_opacity)).select("scene_id", F.col("splat_id").alias("draw_id"))
    live = splats.filter(~is_dead(min_opacity))
    drawn = weighted_draw_replace(live, ["scene_id"], weight, "splat_id", dead, seed, rows_per_bucket)
    counts = drawn.groupBy("scene_id", "splat_id").agg((F.count(F.lit(1)) + 1).alias("copies"))
    source = live.join(counts, ["scene_id", "splat_id"]).withColumnRenamed("splat_id", "source_id")
    placed = drawn.select("scene_id", F.col("draw_id").alias("splat_id"), F.col("splat_id").alias("source_id"))
    return placed.join(source, ["scene_id", "source_id"])
