"""Cells of bounded size for searches inside keys of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells(index: DataFrame, probes: DataFrame, keys: list[str], salt: str, limit: int) -> DataFrame:
    """Rows of both sides with ``probe`` (boolean) and the cell (``ci``, ``cj``) inside their key.

    A key with more than ``limit`` index rows or probes is cut into a grid: index rows go to one chunk by a hash of
    ``salt`` and are repeated for each chunk of probes, and the other way round, so each pair of an index row and a probe
    meets in exactly one cell and no cell holds much more than ``limit`` rows of a side. Keys without index rows or
    without probes drop out, as they hold no pair. Both sides need the same columns.
    """
    sized = index.groupBy(*keys).agg(F.count("*").alias("_ni")).join(probes.groupBy(*keys).agg(F.count("*").alias("_nj")), keys)
    chunks = sized.select(*keys, F.ceil(F.col("_ni") / limit).cast("int").alias("_ci"), F.ceil(F.col("_nj") / limit).cast("int").alias("_cj"))

    def spread(rows: DataFrame, own: str, other: str, mine: str, theirs: str, probe: bool) -> DataFrame:
        at = F.pmod(F.xxhash64(salt), F.col(own)).cast("int")
        return rows.join(chunks, keys).select(*rows.columns, F.lit(probe).alias("probe"), at.alias(mine), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(theirs)).select(*rows.columns, "probe", "ci", "cj")

    return spread(index, "_ci", "_cj", "ci", "cj", False).unionByName(spread(probes, "_cj", "_ci", "cj", "ci", True))
