"""Queries of scenes, side images, runtimes and placements, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from armlode.functions import camera as C
from armlode.functions import gripper as G
from armlode.functions import pose as P
from armlode.operators import renders as R
from armlode.operators.frames import active_sides, canonical
from armlode.operators.scale import union_rows
from armlode.queries.poses import _TARGET, TIE, UNIT
from armlode.queries.sequence import ACTIVE, ONE
from armlode.sources.tables import source_key, table

FRAME = ["episode_id", "frame_idx"]
FOCAL, CENTRE_U, CENTRE_V, BACK = 600.0, 320.0, 240.0, 2.0
WIDTH, HEIGHT = 640, 480


def _frames(spark: SparkSession, base: str) -> DataFrame:
    return canonical(table(spark, base, "frames"))


def _named(spark: SparkSession, base: str) -> DataFrame:
    """(episode_id, sides): the sides that any row of an episode names."""
    d = active_sides(table(spark, base, "episodes")).withColumn("name", F.when(F.col("side") == 0, "right").otherwise("left"))
    return d.groupBy("episode_id").agg(F.array_sort(F.collect_set("name")).alias("sides"))


def scene_split(spark, base):
    """Every frame's side as an object of its episode's scene; objects of each scene are counted."""
    name = F.concat(F.lit("ee_base_link_"), F.when(F.col("side") == 0, "right").otherwise("left"), F.lit("_00"))
    d = R.scene_objects(_frames(spark, base).select("episode_id", "frame_idx", name.alias("name")), _named(spark, base), ["episode_id"])
    return d.groupBy("episode_id", "scene").agg(F.count("*").alias("objects"), F.count_distinct("name").alias("names"))


def _camera(p):
    return C.project([p[0], p[1], p[2] + BACK], FOCAL, FOCAL, CENTRE_U, CENTRE_V)[:2]


def side_centres(spark, base):
    """Base, tool and centre of a side's arm in an image: the base is its place at the first frame, the tool its pinch centre where a gripper is known."""
    d = _frames(spark, base).withColumn("_n", P.norm(P.fields("pose")[1])).filter("abs(_n - 1) < 0.001")
    p, q = P.fields("pose")
    target = G.keep_pinch_centre((p, P.normalize(q)), F.col("gripper"))[1]
    side = ["episode_id", "side"]
    first = F.min_by("pose", "frame_idx").over(Window.partitionBy(*side))
    u, v = (lambda p: _camera(p)[0]), (lambda p: _camera(p)[1])
    at = lambda name, p: F.struct(F.lit(name).alias("name"), u(p).alias("u"), v(p).alias("v"))
    d = d.withColumn("_first", first)
    parts = F.array_compact(F.array(at("base_link_00", P.fields("_first")[0]), at("ee_base_link_00", p), F.when(F.col("gripper").isNotNull(), at("pinch", target))))
    points = d.select(*side, "frame_idx", F.explode(parts).alias("part")).select(*side, "frame_idx", "part.*")
    s = R.side_centres(points, [*side, "frame_idx"], "name", "u", "v")
    return s.select(*side, "frame_idx", "links", *[F.round(F.col(c) + TIE, 3).alias(c) for c in ("base_u", "base_v", "tool_u", "tool_v", "centre_u", "centre_v")])


def side_fallback(spark, base):
    """The closure of each active side at each frame: its own, else its part of the frame's mean."""
    d = _frames(spark, base).select(*FRAME, "side", "gripper")
    expected = d.select(*FRAME).distinct().join(active_sides(table(spark, base, "episodes")), "episode_id")
    mean = d.groupBy(*FRAME).agg(F.avg("gripper").alias("gripper"))
    combined = mean.withColumn("side", F.explode(F.array(F.lit(0).cast("byte"), F.lit(1).cast("byte"))))
    s = R.own_or_split(expected, d, combined, FRAME, "side", "gripper")
    return s.select(*FRAME, "side", F.round(F.col("gripper") + TIE, 6).alias("gripper"), "origin")


def _manifests(spark, base):
    """One manifest per side of an episode: its span of time, its lost frames, and the source it was made of."""
    side = F.when(F.col("side") == 0, "right").otherwise("left")
    return _frames(spark, base).groupBy("episode_id", side.alias("side")).agg(
        (F.max("t") - F.min("t")).alias("seconds"), (F.max("frame_idx") - F.min("frame_idx") + 1 - F.count("*")).alias("missing"), F.md5(F.min(source_key("source_dataset"))).alias("signature"),
    )


def render_runtimes(spark, base):
    """Runtimes of renders, one per scene of an episode: of each side where two are named, else combined."""
    e = table(spark, base, "episodes")
    now = e.groupBy("episode_id").agg(F.md5(F.min(source_key("source_dataset"))).alias("signature"))
    scenes = _named(spark, base).join(now, "episode_id").select("episode_id", F.explode(F.when(F.size("sides") == 2, F.col("sides")).otherwise(F.array(F.lit("both")))).alias("side"), "signature")
    m = _manifests(spark, base)
    whole = m.groupBy("episode_id").agg(F.lit("both").alias("side"), F.max("seconds").alias("seconds"), F.sum("missing").alias("missing"), F.min("signature").alias("signature"))
    r = R.render_runtimes(scenes, union_rows(m, whole), ["episode_id"])
    return r.select("episode_id", F.round(F.col("seconds") + TIE, 6).alias("seconds"), "error")


def preferred_runtimes(spark, base):
    """The runtime of an episode's first kind of manifest: the right side stands for the first kind, the left for the second."""
    r = R.preferred_runtimes(_manifests(spark, base).withColumnRenamed("side", "kind"), ["episode_id"], ["right", "left"])
    return r.select("episode_id", "kind", F.round(F.col("seconds") + TIE, 6).alias("seconds"))


def _pairs(spark, base):
    """Per frame base and tool of the right side (a) and of the left (b) in the plane seen from above."""
    d = _frames(spark, base).select("episode_id", "frame_idx", "side", F.col("pose.x").alias("x"), F.col("pose.y").alias("y"))
    first = d.groupBy("episode_id").agg(*[F.min_by(F.when(F.col("side") == s, F.struct("x", "y")), F.when(F.col("side") == s, F.col("frame_idx"))).alias(f"o{n}") for s, n in ((0, "a"), (1, "b"))])
    both = d.groupBy(*FRAME).agg(*[F.max(F.when(F.col("side") == s, F.struct("x", "y"))).alias(f"t{n}") for s, n in ((0, "a"), (1, "b"))])
    return both.filter("ta is not null and tb is not null").join(first, "episode_id")


def _point(name):
    return F.col(f"{name}.x"), F.col(f"{name}.y")


def arm_placements(spark, base):
    """The placements of each frame: fitted to the frame, and with the episode's median scale."""
    points = [_point(n) for n in ("oa", "ta", "ob", "tb")]
    d = _pairs(spark, base).select(*FRAME, "oa", "ta", "ob", "tb", *[c.alias(n) for n, c in R.frame_similarity(*points).items()])
    common = d.groupBy("episode_id").agg(F.percentile("scale", 0.5).alias("common"))
    f = d.join(common, "episode_id")
    fixed = R.fixed_scale_similarity(*points, F.col("common"))
    return f.select(*FRAME, *[F.round(F.col(c) + TIE, 4).alias(c) for c in ("scale", "dx", "dy")], F.round(F.cos("angle") + TIE, 5).alias("turn"), *[F.round(fixed[c] + TIE, 4).alias(f"fixed_{c}") for c in ("scale", "dx", "dy")])


def border_placements(spark, base):
    """Per episode the placement of the right side's path as a silhouette of pixels, reaching the border nearest to the left side's first place."""
    px = lambda c, middle: c * 200.0 + middle
    d = _pairs(spark, base)
    last = d.groupBy("episode_id").agg(F.max_by("ta", "frame_idx").alias("za"), F.max_by("tb", "frame_idx").alias("zb"))
    d = d.join(last, "episode_id").withColumns({"px": px(F.col("ta.x"), 320.0), "py": px(F.col("ta.y"), 240.0)})
    p = lambda n: (px(F.col(f"{n}.x"), 320.0), px(F.col(f"{n}.y"), 240.0))
    s = R.border_similarities(d, ["episode_id"], "px", "py", p("oa"), p("za"), p("ob"), p("zb"), WIDTH, HEIGHT)
    return s.select("episode_id", *[F.round(F.col(c) + TIE, 3).alias(c) for c in ("scale", "dx", "dy")], F.round(F.cos("angle") + TIE, 5).alias("turn"))


QUERIES = {f.__name__: f for f in (scene_split, side_centres, side_fallback, render_runtimes, preferred_runtimes, arm_placements, border_placements)}

_SIDE = "CASE side WHEN 0 THEN 'right' ELSE 'left' END"
_KEY = "lower(regexp_replace(source_dataset, '[^\\p{L}\\p{N}]+', '', 'g'))"
_UV = lambda x, y, z: (f"CASE WHEN ({z}) + {BACK} > 1e-6 THEN ({x}) / (({z}) + {BACK}) * {FOCAL} + {CENTRE_U} END", f"CASE WHEN ({z}) + {BACK} > 1e-6 THEN ({y}) / (({z}) + {BACK}) * {FOCAL} + {CENTRE_V} END")
_MAN = f"man AS (SELECT episode_id, {_SIDE} AS side, max(t) - min(t) AS seconds, max(frame_idx) - min(frame_idx) + 1 - count(*) AS missing, md5(min({_KEY})) AS signature FROM one GROUP BY 1, 2)"
_R = lambda e, n, k=4: f"round({e} + {TIE}, {k}) AS {n}"
_PAIRS = "pr AS (SELECT r.episode_id, r.frame_idx, r.pose.x AS ax, r.pose.y AS ay, l.pose.x AS bx, l.pose.y AS byy FROM one r JOIN one l ON r.episode_id = l.episode_id AND r.frame_idx = l.frame_idx AND r.side = 0 AND l.side = 1), fa AS (SELECT episode_id, pose.x AS oax, pose.y AS oay FROM one WHERE side = 0 QUALIFY row_number() OVER (PARTITION BY episode_id ORDER BY frame_idx) = 1), fb AS (SELECT episode_id, pose.x AS obx, pose.y AS oby FROM one WHERE side = 1 QUALIFY row_number() OVER (PARTITION BY episode_id ORDER BY frame_idx) = 1), al AS (SELECT * FROM pr JOIN fa USING (episode_id) JOIN fb USING (episode_id))"
_TURN = "atan2(ux * wy - uy * wx, ux * wx + uy * wy)"
_OK = "sqrt(ux * ux + uy * uy) >= 1e-6 AND sqrt(wx * wx + wy * wy) >= 1e-6"
SQL = {
    "scene_split": f"WITH {ONE}, {ACTIVE}, s AS (SELECT o.episode_id, {_SIDE.replace('side', 'o.side', 1)} AS name, o.side, (SELECT count(*) FROM act WHERE act.episode_id = o.episode_id) AS n, EXISTS (SELECT 1 FROM act WHERE act.episode_id = o.episode_id AND act.side = o.side) AS own FROM one o), k AS (SELECT * FROM s WHERE own OR n = 0), u AS (SELECT episode_id, 'both' AS scene, name FROM k UNION ALL SELECT episode_id, name, name FROM k WHERE n <> 1) SELECT episode_id, scene, count(*) AS objects, count(DISTINCT name) AS names FROM u GROUP BY 1, 2",
    "side_centres": f"WITH {UNIT}, b AS (SELECT episode_id, side, x AS ox, y AS oy, z AS oz FROM un QUALIFY row_number() OVER (PARTITION BY episode_id, side ORDER BY frame_idx) = 1), p AS (SELECT episode_id, side, frame_idx, {_UV('ox', 'oy', 'oz')[0]} AS bu, {_UV('ox', 'oy', 'oz')[1]} AS bv, {_UV('x', 'y', 'z')[0]} AS eu, {_UV('x', 'y', 'z')[1]} AS ev, CASE WHEN gripper IS NOT NULL THEN {_UV(*_TARGET)[0]} END AS pu, CASE WHEN gripper IS NOT NULL THEN {_UV(*_TARGET)[1]} END AS pv FROM un JOIN b USING (episode_id, side)) SELECT episode_id, side, frame_idx, CAST((bu IS NOT NULL) AS INT) + CAST((eu IS NOT NULL) AS INT) AS links, {_R('bu', 'base_u', 3)}, {_R('bv', 'base_v', 3)}, {_R('coalesce(pu, eu)', 'tool_u', 3)}, {_R('coalesce(pv, ev)', 'tool_v', 3)}, {_R('list_avg([bu, eu])', 'centre_u', 3)}, {_R('list_avg([bv, ev])', 'centre_v', 3)} FROM p",
    "side_fallback": f"WITH {ONE}, {ACTIVE}, m AS (SELECT episode_id, frame_idx, avg(gripper) AS part FROM one GROUP BY 1, 2), x AS (SELECT m.*, act.side, o.gripper AS own FROM m JOIN act ON act.episode_id = m.episode_id LEFT JOIN one o ON o.episode_id = m.episode_id AND o.frame_idx = m.frame_idx AND o.side = act.side) SELECT episode_id, frame_idx, side, {_R('coalesce(own, part)', 'gripper', 6)}, CASE WHEN own IS NOT NULL THEN 'own' WHEN part IS NOT NULL THEN 'split' ELSE 'none' END AS origin FROM x",
    "render_runtimes": f"WITH {ONE}, {ACTIVE}, {_MAN}, now AS (SELECT episode_id, md5(min({_KEY})) AS now FROM episodes GROUP BY 1), n AS (SELECT episode_id, count(*) AS n FROM act GROUP BY 1), sc AS (SELECT a.episode_id, {_SIDE} AS side FROM act a JOIN n ON n.episode_id = a.episode_id WHERE n = 2 UNION ALL SELECT episode_id, 'both' FROM n WHERE n = 1), al AS (SELECT episode_id, side, seconds, missing, signature FROM man UNION ALL SELECT episode_id, 'both', max(seconds), sum(missing), min(signature) FROM man GROUP BY 1), j AS (SELECT sc.episode_id, bool_or(al.seconds IS NULL) AS none, coalesce(bool_or(al.seconds IS NOT NULL AND now.now IS DISTINCT FROM al.signature), false) AS stale, coalesce(bool_or(missing > 0), false) AS lost, max(seconds) AS s FROM sc JOIN now ON now.episode_id = sc.episode_id LEFT JOIN al ON al.episode_id = sc.episode_id AND al.side = sc.side GROUP BY 1), r AS (SELECT *, CASE WHEN none THEN 'no render' WHEN stale THEN 'stale render' WHEN lost THEN 'incomplete render' END AS error FROM j) SELECT episode_id, CASE WHEN error IS NULL THEN round(s + {TIE}, 6) END AS seconds, error FROM r",
    "preferred_runtimes": f"WITH {ONE}, {_MAN} SELECT episode_id, arg_max(side, side) AS kind, {_R('arg_max(seconds, side)', 'seconds', 6)} FROM man GROUP BY 1",
    "arm_placements": f"WITH {ONE}, {_PAIRS}, ax AS (SELECT *, ax - oax AS ux, ay - oay AS uy, bx - obx AS wx, byy - oby AS wy FROM al), sc AS (SELECT *, CASE WHEN {_OK} THEN {_TURN} END AS g, CASE WHEN {_OK} THEN least(greatest(sqrt(wx * wx + wy * wy) / sqrt(ux * ux + uy * uy), 0.35), 4.0) END AS k FROM ax), md AS (SELECT *, quantile_cont(k, 0.5) OVER (PARTITION BY episode_id) AS c FROM sc) SELECT episode_id, frame_idx, {_R('k', 'scale')}, {_R('obx - k * (cos(g) * oax - sin(g) * oay)', 'dx')}, {_R('oby - k * (sin(g) * oax + cos(g) * oay)', 'dy')}, {_R('cos(g)', 'turn', 5)}, CASE WHEN g IS NOT NULL THEN round(c + {TIE}, 4) END AS fixed_scale, {_R('bx - c * (cos(g) * ax - sin(g) * ay)', 'fixed_dx')}, {_R('byy - c * (sin(g) * ax + cos(g) * ay)', 'fixed_dy')} FROM md",
    "border_placements": f"WITH {ONE}, {_PAIRS}, z AS (SELECT *, last_value(ax) OVER w AS zax, last_value(ay) OVER w AS zay, last_value(bx) OVER w AS zbx, last_value(byy) OVER w AS zby FROM al WINDOW w AS (PARTITION BY episode_id ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), p AS (SELECT episode_id, (zax - oax) * 200 AS ux, (zay - oay) * 200 AS uy, (zbx - obx) * 200 AS wx, (zby - oby) * 200 AS wy, zax * 200 + 320 AS tx, zay * 200 + 240 AS ty, zbx * 200 + 320 AS gx, zby * 200 + 240 AS gy, obx * 200 + 320 AS ex, oby * 200 + 240 AS ey, ax * 200 + 320 AS px, ay * 200 + 240 AS py FROM z), g AS (SELECT *, CASE WHEN {_OK} THEN {_TURN} END AS g FROM p), r AS (SELECT *, cos(g) * (px - tx) - sin(g) * (py - ty) AS rx, sin(g) * (px - tx) + cos(g) * (py - ty) AS ry FROM g), q AS (SELECT episode_id, any_value(g) AS g, any_value(tx) AS tx, any_value(ty) AS ty, any_value(gx) AS gx, any_value(gy) AS gy, any_value(ex) AS ex, any_value(ey) AS ey, any_value(sqrt(wx * wx + wy * wy)) AS len, quantile_cont(rx, 0.002) AS xlo, quantile_cont(rx, 0.998) AS xhi, quantile_cont(ry, 0.002) AS ylo, quantile_cont(ry, 0.998) AS yhi, greatest(max(rx) - min(rx), max(ry) - min(ry), 1.0) AS span FROM r GROUP BY 1), b AS (SELECT *, least(ex, 639 - ex, ey, 479 - ey) AS near FROM q), e AS (SELECT *, CASE WHEN ex = near THEN xlo WHEN 639 - ex = near THEN xhi WHEN ey = near THEN ylo ELSE yhi END AS reach, CASE WHEN ex = near OR 639 - ex = near THEN ex - gx ELSE ey - gy END AS wanted FROM b), k AS (SELECT *, CASE WHEN g IS NOT NULL THEN least(greatest(CASE WHEN abs(reach) < 1e-6 OR wanted * reach <= 0 THEN len / span ELSE wanted / reach END, 0.35), 2.2) END AS k FROM e) SELECT episode_id, {_R('k', 'scale', 3)}, {_R('gx - k * (cos(g) * tx - sin(g) * ty)', 'dx', 3)}, {_R('gy - k * (sin(g) * tx + cos(g) * ty)', 'dy', 3)}, {_R('cos(g)', 'turn', 5)} FROM k",
}
