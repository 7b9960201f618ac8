"""Connected components by alternating star contraction, and ranks without one big window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scenequarry.session import cut


def _stamp(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of ``links`` that has a partner; component is the smallest node that it reaches.

    Large-star and small-star rounds turn about until the edges stay as they are; the number of rounds grows with the
    logarithm of the longest chain. Hubs are met by an aggregate that combines before the shuffle and by a join whose
    large side adaptive execution may split. Null ends and self links count for nothing. Each round is a written table.
    """
    x, y = F.col(a), F.col(b)
    edges = cut(links.select(F.least(x, y).alias("u"), F.greatest(x, y).alias("v")).filter(x.isNotNull() & y.isNotNull() & (F.col("u") < F.col("v"))).distinct())
    stamp = _stamp(edges)
    while stamp[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = cut(both.join(low, "u").filter("v > u AND m < v").select(F.col("m").alias("u"), "v").distinct())
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").filter("m < u").select(F.col("m").alias("u"), F.col("u").alias("v"))
        edges = cut(small.unionByName(low.select(F.col("m").alias("u"), "v")).distinct())
        now = _stamp(edges)
        if now == stamp:
            break
        stamp = now
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)


def ranked(rows: DataFrame, group: str, order: list[str], rank: str, partitions: int | None = None) -> DataFrame:
    """``rows`` as a written table with ``rank``: the place of a row in its group, from 0 and without gaps.

    Rows are sorted by range over (group, order); the place inside a range comes from the row number that Spark gives each
    task's rows, and what lies in earlier ranges is added from a table of one row per range and group. No group meets in
    one task. Rows that tie in ``order`` come in any order.
    """
    spark = rows.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = cut(rows.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    per = laid.groupBy(part.alias("_part"), F.col(group).alias("_g")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = per.withColumn("_start", F.coalesce(before, F.lit(0)) - F.col("_first")).select("_part", "_g", "_start")
    out = laid.withColumn("_p", part).join(starts, (F.col("_p") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_g")))
    return out.select(*rows.columns, (F.col("_at") + F.col("_start")).alias(rank))

