"""Quality gates as row expressions: verdict, list of issues and the measured figures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GateLimits:
    """Default limits of the gates."""

    min_frames: int = 20
    max_frames: int = 500
    blur: float = 100.0
    exposure_low: float = 0.1
    exposure_high: float = 0.9
    min_psnr: float = 20.0
    min_ssim: float = 0.75
    min_mesh_vertices: int = 500
    max_mesh_vertices: int = 500_000
    watertight: bool = True
    normal_consistency: float = 0.7
    roundtrip_psnr: float = 18.0
    final_psnr: float = 22.0


def _issues(*pairs: tuple[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in pairs]))


def _verdict(df: DataFrame, fail: Column) -> DataFrame:
    v = F.when(F.size("issues") == 0, "pass").when(fail, "fail").otherwise("warn")
    return df.withColumn("verdict", v)


def input_gate(frames: DataFrame, limits: GateLimits = GateLimits(), key: str = "session_id") -> DataFrame:
    """Gate over a session's frames: blur_score, exposure_mean, coverage_score (the session coverage is their mean)."""
    g = frames.groupBy(key).agg(
        F.count(F.lit(1)).alias("frame_count"),
        F.avg("blur_score").alias("avg_blur"),
        (F.count_if(F.col("blur_score") < limits.blur) / F.count("blur_score")).alias("blurry_ratio"),
        (F.count_if(F.col("exposure_mean") < limits.exposure_low) / F.count("exposure_mean")).alias("under_ratio"),
        (F.count_if(F.col("exposure_mean") > limits.exposure_high) / F.count("exposure_mean")).alias("over_ratio"),
        ((F.count_if(F.col("exposure_mean") < limits.exposure_low) + F.count_if(F.col("exposure_mean") > limits.exposure_high))
         / F.count("exposure_mean")).alias("_badly_exposed"),
        F.avg("coverage_score").alias("coverage"),
    )
    few = F.col("frame_count") < limits.min_frames
    g = g.withColumn(
        "issues",
        _issues(
            ("too_few_frames", few),
            ("too_many_frames", F.col("frame_count") > limits.max_frames),
            ("blurry", F.col("blurry_ratio") > 0.5),
            ("exposure", F.col("_badly_exposed") > 0.3),
            ("coverage", F.col("coverage") < 0.3),
        ),
    ).drop("_badly_exposed")
    return _verdict(g, (F.size("issues") >= 3) | few)


def training_gate(runs: DataFrame, limits: GateLimits = GateLimits()) -> DataFrame:
    """Columns used: psnr, ssim, final_loss, converged, iterations, max_iterations."""
    loss = F.col("final_loss")
    df = runs.withColumn(
        "issues",
        _issues(
            ("psnr", F.col("psnr") < limits.min_psnr),
            ("ssim", F.col("ssim") < limits.min_ssim),
            ("not_converged", ~F.col("converged") & (F.col("iterations") >= F.col("max_iterations"))),
            ("diverged", F.isnan(loss) | (F.abs(loss) == float("inf"))),
        ),
    )
    return _verdict(df, F.col("psnr") < limits.min_psnr * 0.7)


def mesh_gate(meshes: DataFrame, limits: GateLimits = GateLimits()) -> DataFrame:
    """Columns used: vertex_count, is_watertight, normal_consistency."""
    n, c = F.col("vertex_count"), F.col("normal_consistency")
    df = meshes.withColumn(
        "issues",
        _issues(
            ("too_few_vertices", n < limits.min_mesh_vertices),
            ("too_many_vertices", n > limits.max_mesh_vertices),
            ("not_watertight", ~F.col("is_watertight") if limits.watertight else F.lit(False)),
            ("normals", c < limits.normal_consistency),
        ),
    )
    return _verdict(df, (n < 50) | (c < 0.3))


def roundtrip_gate(rows: DataFrame, limits: GateLimits = GateLimits()) -> DataFrame:
    p = F.col("roundtrip_psnr")
    v = F.when(p >= limits.roundtrip_psnr, "pass").when(p < limits.roundtrip_psnr * 0.7, "fail").otherwise("warn")
    return rows.withColumn("verdict", v)


def final_gate(rows: DataFrame, limits: GateLimits = GateLimits()) -> DataFrame:
    """Columns used: render_psnr, object_count. Any issue fails."""
    df = rows.withColumn(
        "issues", _issues(("psnr", F.col("render_psnr") < limits.final_psnr), ("no_objects", F.col("object_count") == 0))
    )
    return _verdict(df, F.lit(True))
