"""Video frames: verdicts, scores, near-duplicates, candidate choice and coverage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenequarry.functions.cameras import GOLDEN
from scenequarry.operators.scale import attach, rank_rows, take_smallest
from scenequarry.session import cut


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def with_verdict(
    frames: DataFrame, blur: float = 100.0, low: float = 0.1, high: float = 0.9, coverage: float = 0.3
) -> DataFrame:
    """Issues among blurry, under- and over-exposed, low coverage: two or more drop, one marginal, none keep."""
    flags = [
        F.col("blur_score") < blur,
        F.col("exposure_mean") < low,
        F.col("exposure_mean") > high,
        F.col("coverage_score") < coverage,
    ]
    n = sum((f.cast("int") for f in flags[1:]), flags[0].cast("int"))
    return frames.withColumn("issues", n).withColumn(
        "verdict", F.when(n >= 2, "drop").when(n == 1, "marginal").otherwise("keep")
    )


def composite_score(legacy: bool = False) -> Column:
    """0.4 sharpness + 0.2 exposure. ``legacy`` compares the [0, 1] mean with 128 directly, which zeroes the second term."""
    mean = F.col("exposure_mean") if legacy else F.col("exposure_mean") * 255.0
    return F.lit(0.4) * F.least(F.col("blur_score") / 500.0, F.lit(1.0)) + F.lit(0.2) * (
        F.lit(1.0) - F.least(F.abs(mean - 128.0) / 100.0, F.lit(1.0))
    )


# ------------------------------------------------------------------ near-duplicates

BANDS = 10
#: Hashes of a session that are compared without bands.
DIRECT_HASHES = 256


def _band_keys(h: Column) -> Column:
    """Keys of all pairs of ten bands. Eight differing bits leave at least two bands equal, so some key agrees."""
    cuts = [(64 * i) // BANDS for i in range(BANDS + 1)]
    parts = [
        F.shiftrightunsigned(h, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")) for a, b in zip(cuts, cuts[1:])
    ]
    keys = []
    for i in range(BANDS):
        for j in range(i + 1, BANDS):
            keys.append(
                F.struct(F.lit(i * BANDS + j).alias("band"), F.shiftleft(parts[i], 7).bitwiseOR(parts[j]).alias("value"))
            )
    return F.array(*keys)


def similar_hashes(frames: DataFrame, distance: int = 8, key: str = "session_id") -> DataFrame:
    """Pairs of distinct hashes of a session within ``distance`` bits (h1 < h2), each with its first frame.

    Equal hashes are one row here however many frames carry them, so a run of copies makes no pairs at all. Sessions of up to
    ``DIRECT_HASHES`` hashes compare all of theirs, which takes fewer rows than the bands of each hash; larger ones meet by bands.
    """
    if distance > BANDS - 2:
        raise ValueError(f"the band scheme is exact up to {BANDS - 2} differing bits")
    first = cut(frames.groupBy(key, F.col("phash").alias("h")).agg(F.min("frame_index").alias("first")))
    sized = cut(attach(first, first.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), [key]))
    small = sized.filter(F.col("_n") <= DIRECT_HASHES).select(key, "h", "first")
    large = sized.filter(F.col("_n") > DIRECT_HASHES)
    banded = large.select(key, "h", "first", F.explode(_band_keys(F.col("h"))).alias("k")).select(key, "h", "first", "k.*")

    def near(rows: DataFrame, on: list[str]) -> DataFrame:
        # sizes of exploded rows are guessed from the file below them, so the join must not choose to broadcast
        other = rows.select(*on, F.col("h").alias("h2"), F.col("first").alias("first2")).hint("merge")
        close = (F.col("h") < F.col("h2")) & (hamming(F.col("h"), F.col("h2")) <= distance)
        return rows.join(other, on).filter(close).select(key, F.col("h").alias("h1"), "h2", F.col("first").alias("first1"), "first2")

    met = near(banded, [key, "band", "value"]).groupBy(key, "h1", "h2").agg(F.min("first1").alias("first1"), F.min("first2").alias("first2"))
    return near(small, [key]).unionByName(met)

def near_duplicates(frames: DataFrame, distance: int = 8, key: str = "session_id") -> DataFrame:
    """Adds ``duplicate_of``: the earliest earlier frame of the session within ``distance`` bits, if any."""
    pairs = cut(similar_hashes(frames.filter(F.col("phash").isNotNull()), distance, key))
    near = pairs.select(key, F.col("h1").alias("phash"), F.col("first2").alias("f")).unionByName(
        pairs.select(key, F.col("h2").alias("phash"), F.col("first1").alias("f"))
    )
    own = frames.groupBy(key, "phash").agg(F.min("frame_index").alias("f"))
    best = near.unionByName(own).groupBy(key, "phash").agg(F.min("f").alias("_f"))
    j = frames.join(best, [key, "phash"], "left")
    return j.withColumn("duplicate_of", F.when(F.col("_f") < F.col("frame_index"), F.col("_f"))).drop("_f")


def demote_duplicates(frames: DataFrame) -> DataFrame:
    """A duplicate that was a keeper becomes marginal."""
    dup = F.col("duplicate_of").isNotNull() & (F.col("verdict") == "keep")
    return frames.withColumn("verdict", F.when(dup, "marginal").otherwise(F.col("verdict")))


def mark_duplicates(frames: DataFrame, distance: int = 8, key: str = "session_id") -> DataFrame:
    """Adds ``is_duplicate``: in frame order, a kept frame suppresses later frames closer than ``distance`` bits.

    Copies of one hash follow its first frame: either that frame is kept and suppresses them, or whatever suppressed it is
    earlier and as close to them. So the sequential rule runs on distinct hashes, ordered by first frame. Frames without a
    hash (unreadable images) are no duplicates and suppress nothing.
    """
    from scenequarry.operators.graphs import first_fit_independent_set

    hashed = frames.filter(F.col("phash").isNotNull())
    pairs = similar_hashes(hashed, distance - 1, key)
    ordered = pairs.select(key, F.least("first1", "first2").alias("u"), F.greatest("first1", "first2").alias("v"))
    first = hashed.groupBy(key, "phash").agg(F.min("frame_index").alias("id"))
    marked = first_fit_independent_set(first, ordered, [key])
    j = frames.join(marked.select(key, "phash", F.col("id").alias("_first"), "suppressed"), [key, "phash"], "left")
    hit = F.col("suppressed") | (F.col("frame_index") > F.col("_first"))
    return j.withColumn("is_duplicate", F.coalesce(hit, F.lit(False))).drop("_first", "suppressed")


# ------------------------------------------------------------------ people and candidates


def mark_people(frames: DataFrame, manifest: DataFrame, key: str = "session_id") -> DataFrame:
    """Join the person manifest (session, file name) and derive has_people and people_coverage (percent)."""
    m = manifest.select(key, "file_name", "action", "person_count", "coverage_pct")
    j = frames.join(m, [key, "file_name"], "left")
    dropped = F.coalesce(F.col("action") == "dropped", F.lit(False))
    seen = F.coalesce(F.col("person_count") > 0, F.lit(False))
    cov = F.when(dropped, F.coalesce("coverage_pct", F.lit(100.0))).when(seen, F.coalesce("coverage_pct", F.lit(0.0))).otherwise(0.0)
    return j.withColumns({"has_people": dropped | seen, "people_coverage": cov}).drop("action", "person_count", "coverage_pct")


def candidates(frames: DataFrame, blur: float = 50.0, max_people: float = 0.05, min_frames: int = 60, key: str = "session_id") -> DataFrame:
    """Sharp frames without crowds or duplicates; a session with too few falls back to non-duplicates of blur > 20.

    Columns used: blur_score, is_duplicate, has_people, people_coverage.
    """
    strict = (F.col("blur_score") >= blur) & ~F.col("is_duplicate") & ~(F.col("has_people") & (F.col("people_coverage") > max_people * 100))
    relaxed = ~F.col("is_duplicate") & (F.col("blur_score") > 20)
    n = frames.groupBy(key).agg(F.count_if(strict).alias("_n"))
    j = attach(frames, n, [key])
    return j.filter(F.when(F.col("_n") < min_frames, relaxed).otherwise(strict)).drop("_n")


def spread_choice(cands: DataFrame, target: int, score: str = "score", key: str = "session_id", rows_per_bucket: int | None = None) -> DataFrame:
    """Evenly spaced frames by index (every n//target-th), filled up by the best remaining scores."""
    n = cands.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    r = attach(rank_rows(cands, [key], ["frame_index"], "_rn", rows_per_bucket), n, [key])
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / target))
    even = (F.col("_n") <= target) | (((F.col("_rn") - 1) % step == 0) & ((F.col("_rn") - 1) / step < target))
    r = cut(r.withColumn("_even", even))
    got = r.filter("_even").groupBy(key).agg(F.count(F.lit(1)).alias("_got"))
    rest = attach(r.filter(~F.col("_even")), got, [key]).withColumn("_neg", -F.col(score))
    fill = rank_rows(rest, [key], ["_neg", "frame_index"], "_rk", rows_per_bucket).filter(F.col("_rk") <= F.lit(target) - F.col("_got"))
    return r.filter("_even").select(*cands.columns).unionByName(fill.select(*cands.columns))


# ------------------------------------------------------------------ viewpoint coverage


def nearest_lattice_cosine(rows: DataFrame, n: str, direction: tuple[str, str, str] = ("ux", "uy", "uz")) -> DataFrame:
    """Add ``cosine``: cosine to the nearest point of an n-point golden spiral (n is a column).

    Point i has height 1 - (2i+1)/n, so points within angle a of the direction have heights within sin(a) and lie in an
    index band. The band of half-width ~ 2.5 sqrt(n) covers the spacing of the spiral; a row whose best angle exceeds what its
    band guarantees gets a band widened to that angle, which is exact.
    """
    u = [F.col(c) for c in direction]
    nn = F.col(n).cast("double")
    centre = F.floor((F.lit(1.0) - u[2]) / 2.0 * nn)

    def best(lo: Column, hi: Column) -> Column:
        def cosine(i: Column) -> Column:
            z = F.lit(1.0) - F.lit(2.0) * (i + F.lit(0.5)) / nn
            r = F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - z * z))
            t = F.lit(2.0 * math.pi / GOLDEN) * i
            return r * F.cos(t) * u[0] + r * F.sin(t) * u[1] + z * u[2]

        return F.array_max(F.transform(F.sequence(lo, hi), lambda i: cosine(i.cast("double"))))

    half = F.ceil(F.lit(2.5) * F.sqrt(nn)) + 1
    lo, hi = F.greatest(F.lit(0), centre - half), F.least(F.col(n) - 1, centre + half)
    d = rows.withColumn("cosine", best(lo, hi))
    # a lattice point within the best angle has height in [cos(theta + a), cos(theta - a)]
    theta, a = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), u[2]))), F.acos(F.least(F.lit(1.0), F.col("cosine")))
    top = F.when(theta - a > 0, F.cos(theta - a)).otherwise(F.lit(1.0))
    bottom = F.when(theta + a < math.pi, F.cos(theta + a)).otherwise(F.lit(-1.0))
    d = d.withColumns(
        {
            "_lo": F.greatest(F.lit(0), F.floor((F.lit(1.0) - top) / 2.0 * nn - 0.5).cast("long")),
            "_hi": F.least(F.col(n) - 1, F.ceil((F.lit(1.0) - bottom) / 2.0 * nn - 0.5).cast("long")),
        }
    )
    wide = (F.col("_lo") < lo) | (F.col("_hi") > hi)
    d = d.withColumn("cosine", F.when(wide, best(F.col("_lo"), F.col("_hi"))).otherwise(F.col("cosine")))
    return d.drop("_lo", "_hi")


def coverage_scores(cams: DataFrame, n_target: Column, key: str, id_col: str, rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``coverage`` in [0, 1]: how close each camera's direction from the centroid is to a lattice point.

    ``n_target`` may use ``n_rows``. The n_target best cosines are unique claims, the others lose 0.3 (not below 0); scores are
    scaled to [0, 1] per group; co-located cameras and flat scores get 1.
    """
    mean = cams.groupBy(key).agg(*[F.avg(a).alias(f"_m{a}") for a in "xyz"], F.count(F.lit(1)).alias("n_rows"))
    j = attach(cams, mean, [key]).withColumn("_nt", n_target.cast("long"))
    j = j.withColumns({f"_d{a}": F.col(a) - F.col(f"_m{a}") for a in "xyz"})
    j = j.withColumn("_len", F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy") + F.col("_dz") * F.col("_dz")))
    safe = F.greatest(F.col("_len"), F.lit(1e-9))
    j = j.withColumns({f"u{a}": F.col(f"_d{a}") / safe for a in "xyz"})
    j = nearest_lattice_cosine(j, "_nt").withColumn("_neg", -F.col("cosine"))
    r = rank_rows(j, [key], ["_neg", id_col], "_rn", rows_per_bucket)
    raw = F.when(F.col("_rn") <= F.col("_nt"), F.col("cosine")).otherwise(F.greatest(F.lit(0.0), F.col("cosine") - 0.3))
    r = cut(r.withColumn("_raw", raw))
    span = r.groupBy(key).agg(F.min("_raw").alias("_a"), F.max("_raw").alias("_b"), F.max("_len").alias("_far"))
    s = attach(r, span, [key])
    flat = (F.col("_far") < 1e-9) | (F.col("_b") - F.col("_a") < 1e-9)
    cov = F.when(flat, F.lit(1.0)).otherwise((F.col("_raw") - F.col("_a")) / F.when(~flat, F.col("_b") - F.col("_a")))
    return s.withColumn("coverage", cov).select(*cams.columns, "coverage")


def choose_by_coverage(
    cams: DataFrame, quality: str, n_select: int, weight: float = 0.4, key: str = "session_id", id_col: str = "frame_id",
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """The n best frames by (1-w) * scaled quality + w * coverage."""
    c = coverage_scores(cams, F.greatest(F.lit(n_select), F.col("n_rows")), key, id_col, rows_per_bucket)
    c = cut(c)
    q = c.groupBy(key).agg(F.min(quality).alias("_q0"), F.max(quality).alias("_q1"))
    j = attach(c, q, [key])
    span = F.col("_q1") - F.col("_q0")
    norm = F.when(span > 1e-9, (F.col(quality) - F.col("_q0")) / F.when(span > 1e-9, span)).otherwise(F.lit(1.0))
    j = j.withColumn("combined", norm * (1.0 - weight) + F.col("coverage") * weight).withColumn("_neg", -F.col("combined"))
    return take_smallest(j, [key], "_neg", id_col, F.lit(n_select), rows_per_bucket).drop("_q0", "_q1", "_neg")


# ------------------------------------------------------------------ tracking


def track_objects(masks: DataFrame, threshold: float = 0.30) -> DataFrame:
    """Track id of each object mask: video_id, frame, object_id, track_id.

    ``masks``: video_id, frame, object_id, px_row, px_col. Overlaps of consecutive frames come from one pixel join; each frame
    pair is matched greedily by IoU, all frame pairs at once; tracks are the connected chains, numbered by first appearance.
    """
    from scenequarry.operators.graphs import connected_components, greedy_matching

    m = masks.select("video_id", "frame", "object_id", "px_row", "px_col")
    area = cut(m.groupBy("video_id", "frame", "object_id").agg(F.count(F.lit(1)).alias("area")))
    nxt = m.select("video_id", (F.col("frame") - 1).alias("frame"), F.col("object_id").alias("o2"), "px_row", "px_col")
    # pixels come from exploded masks, whose size the planner can't see: never broadcast them
    inter = m.join(nxt.hint("merge"), ["video_id", "frame", "px_row", "px_col"]).groupBy("video_id", "frame", "object_id", "o2").agg(F.count(F.lit(1)).alias("i"))
    a2 = area.select("video_id", (F.col("frame") - 1).alias("frame"), F.col("object_id").alias("o2"), F.col("area").alias("area2"))
    j = inter.join(area, ["video_id", "frame", "object_id"]).join(a2, ["video_id", "frame", "o2"])
    iou = F.col("i") / (F.col("area") + F.col("area2") - F.col("i"))
    e = j.select("video_id", "frame", (F.col("object_id") * 2).alias("u"), (F.col("o2") * 2 + 1).alias("v"), (-iou).alias("cost"))
    pairs = greedy_matching(e.filter(F.col("cost") <= -threshold), ["video_id", "frame"])
    node = lambda f, o: F.shiftleft(f.cast("long"), 20).bitwiseOR(o.cast("long"))
    links = pairs.select(
        "video_id", node(F.col("frame"), F.shiftright("u", 1)).alias("u"), node(F.col("frame") + 1, F.shiftright("v", 1)).alias("v")
    )
    comp = cut(connected_components(links, ["video_id"]))
    nodes = area.select("video_id", "frame", "object_id", node(F.col("frame"), F.col("object_id")).alias("id"))
    named = nodes.join(comp, ["video_id", "id"], "left").withColumn("component", F.coalesce("component", "id"))
    heads = rank_rows(named.select("video_id", "component").distinct(), ["video_id"], ["component"], "track_id")
    return named.join(heads, ["video_id", "component"]).select("video_id", "frame", "object_id", "track_id")
