"""Votes, summaries, bounds, histograms, gates, logs and reductions."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenequarry.functions import splats as SP
from scenequarry.operators import aggregates as A
from scenequarry.operators import gates as G
from scenequarry.operators import projection as PJ
from scenequarry.plans.columns import rd
from scenequarry.plans.filters import PBOX_SQL
from scenequarry.plans.registry import query
from scenequarry.plans.sqltext import ALPHA, SEEN, VOTES, r


def labelled(load):
    s, v = load("splats"), load("views")
    votes = PJ.label_votes(s, v, load("mask_pixels"), counted=True)
    return A.majority_vote(votes, s.select("scene_id", "splat_id", "x", "y", "z"), 2)


@query(
    "image_cameras", "views",
    "SELECT scene_id, image_id, camera_id, width + camera_id AS width, fx + camera_id AS f FROM (SELECT *, image_id % 3 AS camera_id FROM views) v",
)
def _(load):
    v = load("views")
    images = v.select("scene_id", "image_id", (F.col("image_id") % 3).alias("camera_id"))
    cams = v.select(
        "scene_id", (F.col("image_id") % 3).alias("camera_id"), (F.col("width") + F.col("image_id") % 3).alias("width"),
        (F.col("fx") + F.col("image_id") % 3).alias("f"),
    ).distinct()
    return PJ.with_intrinsics(images, cams).select("scene_id", "image_id", "camera_id", "width", "f")


@query("label_votes", "splats views mask_pixels", "SELECT scene_id, splat_id, label, image_id AS view_index FROM votes", then=f"{SEEN}, {VOTES}")
def _(load):
    return PJ.label_votes(load("splats"), load("views"), load("mask_pixels"))


@query("majority_vote", "splats views mask_pixels", "SELECT scene_id, splat_id, label FROM labelled", then=f"{SEEN}, {VOTES}")
def _(load):
    return labelled(load).select("scene_id", "splat_id", "label")


_GEO = ", ".join(
    [f"CASE WHEN label = 0 THEN 0e0 ELSE round(avg({a}), 6)+0e0 END AS c{a}" for a in "xyz"]
    + [f"CASE WHEN label = 0 THEN 0e0 ELSE round({m}({a}), 6)+0e0 END AS {m}_{a}" for a in "xyz" for m in ("min", "max")]
)


@query(
    "object_summary", "splats views mask_pixels",
    f"SELECT scene_id, label, count(*) AS n, {_GEO} FROM labelled GROUP BY scene_id, label HAVING label = 0 OR count(*) >= 10",
    then=f"{SEEN}, {VOTES}",
)
def _(load):
    out = A.object_summary(labelled(load))
    return out.select("scene_id", "label", "n", *[rd(F.col(c), c) for c in out.columns[3:]])


@query(
    "label_distribution", "splats views mask_pixels",
    "SELECT scene_id, label, count(*) AS n, round(count(*)*100e0/sum(count(*)) OVER (PARTITION BY scene_id), 6) AS pct FROM labelled GROUP BY scene_id, label",
    then=f"{SEEN}, {VOTES}",
)
def _(load):
    return A.label_distribution(labelled(load)).select("scene_id", "label", "n", rd(F.col("pct"), "pct"))


@query(
    "label_map", "mask_pixels",
    """SELECT scene_id, image_id, px_row, px_col, min(object_id) AS label FROM (SELECT scene_id, image_id, px_row, px_col, label AS object_id FROM mask_pixels
UNION ALL SELECT scene_id, image_id, px_row, px_col, label+(px_row+px_col) % 3 - 1 FROM mask_pixels WHERE px_row % 2 = 0) m WHERE object_id > 0 GROUP BY ALL""",
)
def _(load):
    m = load("mask_pixels").withColumnRenamed("label", "object_id")
    more = m.filter("px_row % 2 = 0").withColumn("object_id", F.col("object_id") + (F.col("px_row") + F.col("px_col")) % 3 - 1)
    return PJ.label_map(m.unionByName(more).filter("object_id > 0"))


@query(
    "include_list", "views",
    "SELECT image_id, 'img_' || CAST(image_id AS VARCHAR) || '.jpg' AS name FROM views WHERE image_id % 3 = 0",
)
def _(load):
    v = load("views").select("image_id", F.concat(F.lit("img_"), F.col("image_id").cast("string"), F.lit(".jpg")).alias("name"))
    keep = load("views").filter("image_id % 3 = 0").select(F.concat(F.lit("img_"), F.col("image_id").cast("string"), F.lit(".png")).alias("name"))
    return PJ.include_images(v, keep).select("image_id", "name")


@query(
    "bounds", "splats",
    "SELECT scene_id, " + ", ".join(f"round(min({a})-0.5,6) AS min_{a}, round(max({a})+0.5,6) AS max_{a}" for a in "xyz") + " FROM splats GROUP BY scene_id",
)
def _(load):
    b = A.bounds(load("splats"), padding=0.5)
    return b.select("scene_id", *[rd(F.col(c), c) for c in b.columns[1:]])


@query(
    "bounds_trimmed", "splats",
    "SELECT scene_id, " + ", ".join(
        f"round(list_sort(list({a}))[CAST(floor(count(*)/100) AS BIGINT)+1],6)+0e0 AS min_{a}, round(list_sort(list({a}))[count(*)-CAST(floor(count(*)/100) AS BIGINT)],6)+0e0 AS max_{a}"
        for a in "xyz") + " FROM splats GROUP BY scene_id",
)
def _(load):
    b = A.bounds(load("splats"), trimmed=True)
    return b.select("scene_id", *[rd(F.col(c), c) for c in b.columns[1:]])


@query(
    "percentile_box", "splats",
    f"SELECT scene_id, {', '.join(r(f'{a}_mid', f'{a}_mid') for a in 'xyz')}, {', '.join(r(f'{a}_half', f'{a}_half') for a in 'xyz')}, {r('2*list_sort([x_half,y_half,z_half])[2]', 'median_size')}, {r('max_extent', 'max_extent')} FROM pb",
    then=PBOX_SQL,
)
def _(load):
    b = A.percentile_box(load("splats"))
    return b.select("scene_id", *[rd(F.col(c), c) for c in b.columns[1:]])


@query(
    "scene_scale", "splats",
    """SELECT scene_id, n AS n_rows, round(l[CAST(floor(n/2) AS BIGINT)+1], 6) AS scene_scale FROM (SELECT s.scene_id, count(*) AS n,
list_sort(list(sqrt((x-mx)*(x-mx)+(y-my)*(y-my)+(z-mz)*(z-mz)))) AS l FROM splats s JOIN (SELECT scene_id, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM splats GROUP BY scene_id) m ON s.scene_id = m.scene_id GROUP BY s.scene_id) q""",
)
def _(load):
    return A.scene_scale(load("splats")).select("scene_id", "n_rows", rd(F.col("scene_scale"), "scene_scale"))


@query(
    "scene_radius", "splats",
    """SELECT scene_id, round(rad,6) AS radius, round(mx,6)+0e0 AS cx, round(my-1.2*rad,6) AS min_y, round(mz+1.2*rad,6) AS max_z, round(2.5*rad,6) AS camera_distance FROM (
SELECT s.scene_id, any_value(mx) AS mx, any_value(my) AS my, any_value(mz) AS mz, quantile_cont(sqrt((x-mx)*(x-mx)+(y-my)*(y-my)+(z-mz)*(z-mz)), 0.98) AS rad FROM splats s JOIN
(SELECT scene_id, median(x) AS mx, median(y) AS my, median(z) AS mz FROM splats GROUP BY scene_id) m ON s.scene_id = m.scene_id GROUP BY s.scene_id) q""",
)
def _(load):
    b = A.scene_radius(load("splats"))
    return b.select("scene_id", *[rd(F.col(c), c) for c in ("radius", "cx", "min_y", "max_z", "camera_distance")])


_ANI = "greatest(exp(s0),exp(s1),exp(s2))/least(exp(s0),exp(s1),exp(s2))"


@query(
    "histogram", "splats",
    """SELECT b.scene_id, CAST(bin AS INTEGER) AS bin, round(lo+(hi-lo)/16*bin,6) AS edge_lo, round(lo+(hi-lo)/16*(bin+1),6) AS edge_hi, count(v) AS n
FROM (SELECT *, unnest(range(16)) AS bin FROM b) b LEFT JOIN a ON a.scene_id = b.scene_id AND least(15, floor((v-lo)/(hi-lo)*16)) = bin GROUP BY ALL""",
    then=f"a AS (SELECT scene_id, {_ANI} AS v FROM splats), b AS (SELECT scene_id, 1e0 AS lo, max(v) AS hi FROM a GROUP BY scene_id)",
)
def _(load):
    s = load("splats").withColumn("anisotropy", SP.anisotropy())
    h = A.histogram(s, "anisotropy", "anisotropy", 16)
    return h.select("scene_id", "bin", rd(F.col("edge_lo"), "edge_lo"), rd(F.col("edge_hi"), "edge_hi"), "n")


@query(
    "joint_histogram", "splats",
    f"""SELECT scene_id, CAST(least(7, floor((e-lo)/(hi-lo)*8)) AS INTEGER) AS bin_a, CAST(least(7, floor(o*8)) AS INTEGER) AS bin_b, count(*) AS n
FROM (SELECT scene_id, volume AS e, o, min(volume) OVER (PARTITION BY scene_id) AS lo, max(volume) OVER (PARTITION BY scene_id) AS hi FROM (SELECT scene_id, 4e0/3e0*pi()*exp(s0)*exp(s1)*exp(s2) AS volume, {ALPHA} AS o FROM splats) a) q GROUP BY ALL""",
)
def _(load):
    s = load("splats").withColumns({"volume": SP.volume(), "opacity": SP.opacity()})
    return A.joint_histogram(s, ("volume", "volume"), ("opacity", "opacity"), 8)


@query(
    "joint_cell", "splats",
    f"""SELECT scene_id, splat_id FROM (SELECT scene_id, splat_id, volume AS e, o, min(volume) OVER (PARTITION BY scene_id) AS lo, max(volume) OVER (PARTITION BY scene_id) AS hi
FROM (SELECT scene_id, splat_id, 4e0/3e0*pi()*exp(s0)*exp(s1)*exp(s2) AS volume, {ALPHA} AS o FROM splats) a) q
WHERE least(7, floor((e-lo)/(hi-lo)*8)) = 0 AND least(7, floor(o*8)) = 4""",
)
def _(load):
    """Rows of the smallest volumes and of the fifth opacity bin of eight."""
    s = load("splats").withColumns({"volume": SP.volume(), "opacity": SP.opacity()})
    return A.joint_cell(s, ("volume", "volume"), ("opacity", "opacity"), (0, 4), 8).select("scene_id", "splat_id")


_IG = {
    "too_few_frames": "frame_count < 20", "too_many_frames": "frame_count > 500", "blurry": "blurry_ratio > 0.5",
    "exposure": "under_ratio+over_ratio > 0.3", "coverage": "coverage < 0.3",
}
_NI = "(" + "+".join(f"CAST({c} AS INTEGER)" for c in _IG.values()) + ")"


@query(
    "input_gate", "frames",
    f"""SELECT session_id, frame_count, round(avg_blur,6) AS avg_blur, round(blurry_ratio,6) AS blurry_ratio, {_NI} AS n_issues,
CASE WHEN {_NI} = 0 THEN 'pass' WHEN {_NI} >= 3 OR frame_count < 20 THEN 'fail' ELSE 'warn' END AS verdict FROM (SELECT session_id, count(*) AS frame_count,
avg(blur_score) AS avg_blur, count(*) FILTER (blur_score < 30)*1e0/count(*) AS blurry_ratio, count(*) FILTER (exposure_mean < 0.1)*1e0/count(*) AS under_ratio,
count(*) FILTER (exposure_mean > 0.9)*1e0/count(*) AS over_ratio, avg(coverage_score) AS coverage FROM frames GROUP BY session_id) g""",
)
def _(load):
    g = G.input_gate(load("frames"), G.GateLimits(blur=30.0))
    return g.select(
        "session_id", "frame_count", rd(F.col("avg_blur"), "avg_blur"), rd(F.col("blurry_ratio"), "blurry_ratio"),
        F.size("issues").alias("n_issues"), "verdict",
    )


@query(
    "training_gate", "metrics losses",
    """SELECT run_id, converged, (psnr < 27)::INTEGER + (ssim < 0.75)::INTEGER + (NOT converged)::INTEGER AS n_issues,
 CASE WHEN psnr >= 27 AND ssim >= 0.75 AND converged THEN 'pass' WHEN psnr < 27*0.7 THEN 'fail' ELSE 'warn' END AS verdict
FROM (SELECT m.run_id, m.psnr, m.ssim, n >= 50 AND (f = 0 OR abs(l-f)/(abs(f)+1e-12) < 0.9) AS converged FROM
 (SELECT run_id, max_by(psnr, iteration) AS psnr, max_by(ssim, iteration) AS ssim FROM metrics GROUP BY run_id) m JOIN
 (SELECT run_id, max(k) AS n, max(loss) FILTER (k = 1) AS l, max(loss) FILTER (k = 50) AS f FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS k FROM losses) q GROUP BY run_id) c
 ON m.run_id = c.run_id) t""",
)
def _(load):
    from scenequarry.operators.series import convergence

    conv = convergence(load("losses"), ["run_id"], "step", "loss", 50, 0.9)
    last = A.best_metrics(load("metrics")).select(
        "run_id", F.col("final_psnr").alias("psnr"), F.col("final_ssim").alias("ssim"), F.col("final_iteration").alias("iterations")
    )
    runs = last.join(conv.select("run_id", "converged", F.col("last_loss").alias("final_loss")), "run_id").withColumn(
        "max_iterations", F.col("iterations")
    )
    g = G.training_gate(runs, G.GateLimits(min_psnr=27.0))
    return g.select("run_id", "converged", F.size("issues").alias("n_issues"), "verdict")


@query(
    "mesh_gate", "",
    """SELECT p_partkey, CASE WHEN n_issues = 0 THEN 'pass' WHEN vc < 50 OR nc < 0.3 THEN 'fail' ELSE 'warn' END AS verdict, n_issues FROM (
SELECT *, (vc < 500)::INTEGER + (vc > 500000)::INTEGER + (NOT wt)::INTEGER + (nc < 0.7)::INTEGER AS n_issues FROM
(SELECT p_partkey, p_partkey*400 AS vc, p_partkey % 2 = 0 AS wt, (p_partkey % 10)/10e0 AS nc FROM part) a) b""",
)
def _(load):
    m = load("part").select(
        "p_partkey", (F.col("p_partkey") * 400).alias("vertex_count"), (F.col("p_partkey") % 2 == 0).alias("is_watertight"),
        (F.col("p_partkey") % 10 / 10.0).alias("normal_consistency"),
    )
    return G.mesh_gate(m).select("p_partkey", "verdict", F.size("issues").alias("n_issues"))


@query(
    "roundtrip_and_final_gate", "metrics",
    """SELECT iteration, CASE WHEN psnr >= 18 THEN 'pass' WHEN psnr < 18*0.7 THEN 'fail' ELSE 'warn' END AS roundtrip,
CASE WHEN psnr >= 22 AND num_gaussians % 3 <> 0 THEN 'pass' ELSE 'fail' END AS final FROM metrics""",
)
def _(load):
    m = load("metrics").select(
        "iteration", F.col("psnr").alias("roundtrip_psnr"), F.col("psnr").alias("render_psnr"),
        (F.col("num_gaussians") % 3).alias("object_count"),
    )
    a = G.roundtrip_gate(m).withColumnRenamed("verdict", "roundtrip")
    return G.final_gate(a).select("iteration", "roundtrip", F.col("verdict").alias("final"))


@query(
    "metrics_report", "metrics",
    """SELECT run_id, round(max(psnr),6) AS best_psnr, max_by(iteration, [psnr, -iteration]) AS best_psnr_iteration, round(max(ssim),6) AS best_ssim,
max_by(iteration, [ssim, -iteration]) AS best_ssim_iteration, max(iteration) AS final_iteration, round(max_by(psnr, iteration),6) AS final_psnr FROM metrics GROUP BY run_id""",
)
def _(load):
    b = A.best_metrics(load("metrics"))
    return b.select(
        "run_id", rd(F.col("best_psnr"), "best_psnr"), "best_psnr_iteration", rd(F.col("best_ssim"), "best_ssim"),
        "best_ssim_iteration", "final_iteration", rd(F.col("final_psnr"), "final_psnr"),
    )


@query(
    "benchmark_summary", "metrics",
    """SELECT run_id, round(avg(psnr),5) AS psnr, round(avg(ssim),5) AS ssim, round(avg(g),4) AS num_gaussians FROM (SELECT run_id, max_by(psnr, iteration) AS psnr,
max_by(ssim, iteration) AS ssim, max_by(num_gaussians, iteration) AS g FROM metrics GROUP BY run_id) l GROUP BY ROLLUP (run_id)""",
)
def _(load):
    b = A.benchmark_summary(load("metrics"))
    return b.select("run_id", rd(F.col("psnr"), "psnr", 5), rd(F.col("ssim"), "ssim", 5), rd(F.col("num_gaussians"), "num_gaussians", 4))


@query(
    "image_psnr", "views mask_pixels",
    """SELECT scene_id, round(avg(-10*log10(mse)),5) AS mean_psnr, count(*) AS views FROM (SELECT scene_id, image_id, sum(w*d*d)/sum(w) AS mse FROM
(SELECT scene_id, image_id, CAST(px_row % 3 <> 0 AS INTEGER) AS w, label/5e0-((px_row*7+px_col*3+image_id) % 11)/11e0 AS d FROM mask_pixels) p GROUP BY ALL) q GROUP BY scene_id""",
)
def _(load):
    m = load("mask_pixels")
    pred = F.col("label") / 5.0
    target = (F.col("px_row") * 7 + F.col("px_col") * 3 + F.col("image_id")) % 11 / 11.0
    per = A.psnr(m, ["scene_id", "image_id"], pred, target, (F.col("px_row") % 3 != 0).cast("int"))
    return A.mean_of_finite(per, ["scene_id"]).select("scene_id", rd(F.col("mean_psnr"), "mean_psnr", 5), "views")


@query(
    "person_summary", "frames",
    """SELECT session_id, count(*) AS total, count(*) FILTER (p = 0) AS clean, count(*) FILTER (p > 0 AND c <= 0.15) AS inpainted,
count(*) FILTER (p > 0 AND c > 0.15 AND c <= 0.5) AS flagged_inpainted, count(*) FILTER (p > 0 AND c > 0.5) AS dropped
FROM (SELECT session_id, frame_id % 3 AS p, coverage_score AS c FROM frames) f GROUP BY session_id""",
)
def _(load):
    f = load("frames").select("session_id", (F.col("frame_id") % 3).alias("person_count"), F.col("coverage_score").alias("coverage"))
    return A.person_summary(A.person_actions(f))


@query(
    "stage_peaks", "trace",
    """SELECT stage, round(max(vram_mb),6) AS peak_vram_mb, round(max(ram_mb),6) AS peak_ram_mb, max(gpu_util) AS peak_gpu_util, max(power_w) AS peak_power_w,
count(*) AS sample_count, round(greatest(8192e0, max(vram_mb)*1.2e0),5) AS vram_needed_mb FROM trace GROUP BY ROLLUP (stage)""",
)
def _(load):
    t = A.stage_peaks(load("trace"))
    return t.select(
        "stage", rd(F.col("peak_vram_mb"), "peak_vram_mb"), rd(F.col("peak_ram_mb"), "peak_ram_mb"), "peak_gpu_util",
        "peak_power_w", "sample_count", rd(F.col("vram_needed_mb"), "vram_needed_mb", 5),
    )


@query(
    "recent_percentiles", "trace",
    """SELECT stage, count(*) AS samples, round(quantile_cont(vram_mb, 0.5),5) AS p50, round(quantile_cont(vram_mb, 0.95),5) AS p95 FROM
(SELECT *, row_number() OVER (PARTITION BY stage ORDER BY event_id DESC) AS k FROM trace) t WHERE k <= 120 GROUP BY stage""",
)
def _(load):
    p = A.recent_percentiles(load("trace"), "stage", ["event_id"], "vram_mb", 120, {"p50": 0.5, "p95": 0.95})
    return p.select("stage", "samples", rd(F.col("p50"), "p50", 5), rd(F.col("p95"), "p95", 5))


@query(
    "status_rollup", "",
    """SELECT element, count(*) AS findings, count(*) FILTER (s = 2) AS failures, CASE max(s) WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT p_brand AS element, CASE WHEN p_size > 45 AND p_partkey % 7 = 0 THEN 2 WHEN p_size > 40 THEN 1 ELSE 0 END AS s FROM part) q GROUP BY ROLLUP (element)""",
)
def _(load):
    st = F.when((F.col("p_size") > 45) & (F.col("p_partkey") % 7 == 0), "fail").when(F.col("p_size") > 40, "warn").otherwise("pass")
    return A.status_rollup(load("part").select(F.col("p_brand").alias("element"), st.alias("status")))


@query(
    "tag_counts", "assets",
    """SELECT tag, count(*) AS n FROM (SELECT lang AS tag FROM assets UNION ALL SELECT source FROM assets UNION ALL SELECT DISTINCT source FROM assets) t WHERE trim(tag) <> '' GROUP BY tag""",
)
def _(load):
    a = load("assets")
    tagged = a.select(F.array(F.concat(F.lit(" "), "lang"), F.col("source"), F.lit("  ")).alias("tags"))
    folders = a.select("source").distinct().select(F.array("source").alias("tags"))
    return A.tag_counts(tagged, folders)


@query("occurrence_counts", "", "SELECT l_orderkey AS splat_id, count(*) AS n FROM lineitem GROUP BY l_orderkey")
def _(load):
    return A.occurrence_counts(load("lineitem").select(F.col("l_orderkey").alias("splat_id")), ["splat_id"])


@query(
    "scatter_add", "",
    """SELECT o_orderkey, round(o_totalprice + coalesce(q, 0), 4) AS o_totalprice FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey) l ON l_orderkey = o_orderkey""",
)
def _(load):
    up = load("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_quantity").alias("o_totalprice"))
    out = A.scatter_add(load("orders").select("o_orderkey", "o_totalprice"), up, ["o_orderkey"], "o_totalprice")
    return out.select("o_orderkey", rd(F.col("o_totalprice"), "o_totalprice", 4))


@query(
    "scatter_put", "",
    """SELECT c_custkey, round(coalesce(v, c_acctbal), 4)+0e0 AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, max_by(o_totalprice, o_orderkey) AS v FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey""",
)
def _(load):
    up = load("orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), "o_orderkey")
    out = A.scatter_put(load("customer").select("c_custkey", "c_acctbal"), up, ["c_custkey"], "c_acctbal", "o_orderkey")
    return out.select("c_custkey", rd(F.col("c_acctbal"), "c_acctbal", 4))


_V = "((event_id*37) % 201-100)/100e0"


@query(
    "reductions", "",
    f"""SELECT user_id, round(sum(v),6)+0e0 AS sum, round(avg(v),6)+0e0 AS mean, round(max(v),6)+0e0 AS max, round(min(v),6)+0e0 AS min, round(product(v),6)+0e0 AS prod,
round(stddev_samp(v),6) AS std, round(var_samp(v),6) AS var, max_by(event_id, [v, -event_id]) AS argmax, min_by(event_id, [v, event_id]) AS argmin,
bool_or(v <> 0) AS "any", bool_and(v <> 0) AS "all", round(pow(sum(pow(abs(v),3)),1e0/3),6) AS norm_p, count(*) FILTER (v <> 0) AS count_nonzero
FROM (SELECT user_id, event_id, {_V} AS v FROM events) e GROUP BY user_id""",
)
def _(load):
    e = load("events").select("user_id", "event_id", ((F.col("event_id") * 37 % 201 - 100) / 100.0).alias("v"))
    out = A.reductions(e, ["user_id"], "v", "event_id")
    exact = {"user_id", "argmax", "argmin", "any", "all", "count_nonzero"}
    return out.select(*[c if c in exact else rd(F.col(c), c) for c in out.columns])


@query(
    "median_normalise", "frames",
    """SELECT frame_id, round(CASE WHEN m IS NULL THEN 0 ELSE v/greatest(m, 1e-9) END, 6)+0e0 AS normalised FROM (SELECT *, coverage_score-0.3 AS v FROM frames) f LEFT JOIN
(SELECT session_id, list_sort(list(v))[CAST(floor(count(*)/2) AS BIGINT)+1] AS m FROM (SELECT session_id, coverage_score-0.3 AS v FROM frames) q WHERE v > 0 GROUP BY session_id) g ON f.session_id = g.session_id""",
)
def _(load):
    from scenequarry.operators.ordering import normalise_by_median

    f = load("frames").withColumn("v", F.col("coverage_score") - 0.3)
    return normalise_by_median(f, ["session_id"], "v", "normalised").select("frame_id", rd(F.col("normalised"), "normalised"))


@query(
    "camera_exposure", "frames",
    """SELECT c.session_id AS rig_id, c.camera, round(coalesce(m,0),6)+0e0 AS mean_ev, round(pow(2e0, coalesce(m,0)),6) AS gain FROM
(SELECT session_id, unnest(range(4)) AS camera FROM (SELECT DISTINCT session_id FROM frames) d) c LEFT JOIN
(SELECT session_id, least(2, CAST(floor(frame_index/20e0) AS BIGINT)) AS camera, avg(exposure_mean-0.5) AS m FROM frames GROUP BY ALL) f ON c.session_id = f.session_id AND c.camera = f.camera""",
)
def _(load):
    """Four cameras per rig: 20 frames, 20 frames, the rest, none."""
    f = load("frames").select(
        F.col("session_id").alias("rig_id"), F.col("frame_index").cast("long").alias("frame_index"), (F.col("exposure_mean") - 0.5).alias("ev")
    )
    n = f.groupBy("rig_id").agg(F.count(F.lit(1)).alias("t"))
    a, b = F.least(F.lit(20), F.col("t")), F.least(F.lit(20), F.greatest(F.lit(0), F.col("t") - 20))
    sizes = n.select("rig_id", F.posexplode(F.array(a, b, F.col("t") - a - b, F.lit(0))).alias("camera", "n"))
    out = A.camera_exposure(f, sizes.withColumn("camera", F.col("camera").cast("long")))
    return out.select("rig_id", "camera", rd(F.col("mean_ev"), "mean_ev"), rd(F.col("gain"), "gain"))


