"""Queries of joins, aggregates, planning, export and registration, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from armlode.functions import camera as C
from armlode.functions import pose as P
from armlode.functions import text as X
from armlode.functions.gripper import MAX_ANGLE
from armlode.operators import export as E
from armlode.operators import frames as FR
from armlode.operators import joins as J
from armlode.operators import quality as Q
from armlode.operators import registration as R
from armlode.plans import acquire as A
from armlode.queries.sequence import ACTIVE, FEASIBLE, ONE, RATES, WHOLE
from armlode.sources.tables import source_key, table

KEYS = ["episode_id", "side", "frame_idx"]
TIE = 1.1e-9
HOMES = {"right": (0.3, -0.2, 0.3, 0.0, 0.0, 0.0, 1.0), "left": (0.3, 0.2, 0.3, 0.0, 0.0, 0.0, 1.0)}


def _frames(spark: SparkSession, base: str) -> DataFrame:
    return FR.canonical(table(spark, base, "frames"))


def _episodes(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "episodes")


def _plan(spark: SparkSession, base: str) -> DataFrame:
    """Selected episodes once each, by source and number."""
    s = table(spark, base, "selected_episodes").filter("episode_index is not null").withColumn("source", source_key("source_dataset"))
    return s.groupBy("source", "episode_index").agg(F.max_by(F.struct("tasks", "frames", "seconds", "data_file", "video_files", "video_segments"), F.struct("planned_at", "frames", "seconds")).alias("r")).select("source", "episode_index", "r.*")


# aggregates


def column_statistics(spark, base):
    d = _frames(spark, base).filter("q is not null").select(source_key("source_dataset").alias("source"), "q")
    s = Q.column_statistics(d, ["source"], "q")
    return s.select("source", "pos", *[F.round(F.col(c) + TIE, 6).alias(c) for c in ("min", "max", "mean", "std", "q01", "q10", "q50", "q90", "q99")], "count")


def three_numbers(spark, base):
    d = _frames(spark, base).join(FR.active_sides(_episodes(spark, base)), ["episode_id", "side"]).select(source_key("source_dataset").alias("source"), (F.col("position_error_m") * 1000).alias("mm"))
    return Q.three_numbers(d, ["source"], "mm").select("source", *[F.round(F.col(c) + TIE, 5).alias(c) for c in ("mean", "p95", "max")])


def audit_limits(spark, base):
    d = table(spark, base, "frames").withColumn("source_dataset", source_key("source_dataset"))
    a = Q.audit(d, _episodes(spark, base))
    return a.select("source_dataset", "rows", "used_rows", *[F.round(c, 5).alias(c) for c in ("quaternion_norm_error", "position_error_m", "orientation_error_rad", "jacobian_condition")], *[F.round(c, 3).alias(c) for c in ("speed", "acceleration")], "errors", "ok")


def audit_all(spark, base):
    """Whether every source passes."""
    d = table(spark, base, "frames").withColumn("source_dataset", source_key("source_dataset"))
    return Q.audit(d, _episodes(spark, base)).agg(F.bool_and("ok").alias("ok"), F.count("*").alias("sources"), F.sum("used_rows").alias("used_rows"))


def benchmark_rollup(spark, base):
    """Means per source over its episodes' own means, and over all."""
    d = _frames(spark, base).groupBy("episode_id", source_key("source_dataset").alias("source")).agg(F.avg("position_error_m").alias("error"), F.avg(F.coalesce(F.col("feasible"), F.lit(False)).cast("double")).alias("feasible"))
    return Q.rollup_means(d, "source", ["error", "feasible"]).select("source", "n", F.round(F.col("error") + TIE, 7).alias("error"), F.round("feasible", 6).alias("feasible"))


def weighted_vs_mean(spark, base):
    l = table(spark, base, "lineitem").select("l_returnflag", (F.col("l_extendedprice") * F.col("l_discount")).alias("a"), F.col("l_extendedprice").alias("b"))  # noqa: E741
    return Q.ratio_aggregates(l, ["l_returnflag"], F.col("a"), F.col("b")).select("l_returnflag", *[F.round(c, 6).alias(c) for c in ("weighted", "mean_of_ratios")])


def level_psnr(spark, base):
    """Per episode and side the peak signal-to-noise ratio of a closure track against its rounded levels."""
    e = (F.col("gripper") - F.round("gripper", 1)) * 255
    return _frames(spark, base).filter("gripper is not null").groupBy("episode_id", "side").agg(F.round(C.psnr(F.avg(e * e)), 4).alias("psnr"))


def path_length(spark, base):
    return Q.path_length(table(spark, base, "frames")).select("episode_id", "side", F.round(F.col("metres") + TIE, 5).alias("metres"))


def worst_k(spark, base):
    d = _frames(spark, base).select(*KEYS, "position_error_m", (F.col("episode_id") * 1000000 + F.col("frame_idx") * 2 + F.col("side")).alias("tie"))
    return Q.worst(d, "position_error_m", "tie").drop("tie")


def best_per_group(spark, base):
    d = table(spark, base, "lineitem").select("l_suppkey", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return Q.best_per_group(d, ["l_suppkey"], "l_extendedprice", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]).select("l_suppkey", "l_extendedprice", "l_orderkey", "l_linenumber")


def source_totals(spark, base):
    """Frames and seconds in, feasible frames and their share, per source."""
    rep = Q.feasibility_report(table(spark, base, "frames"), _episodes(spark, base))
    src = table(spark, base, "frames").groupBy("episode_id").agg(F.min(source_key("source_dataset")).alias("source"))
    d = rep.join(src, "episode_id").groupBy("source").agg(F.sum("frames").alias("frames"), F.sum("feasible_frames").alias("feasible_frames"))
    return d.withColumn("feasible_fraction", F.round(F.col("feasible_frames") / F.greatest("frames", F.lit(1)), 6))


# joins


def selected_semi(spark, base):
    return J.selected(table(spark, base, "orders").select("o_orderkey", "o_custkey"), table(spark, base, "customer").filter("c_mktsegment = 'BUILDING'").withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"])


def missing_anti(spark, base):
    """Sides that are active by name but have no row."""
    return J.missing(FR.active_sides(_episodes(spark, base)), table(spark, base, "frames").select("episode_id", F.col("side").cast("byte").alias("side")), ["episode_id", "side"])


def range_semi(spark, base):
    """Parts whose range of order keys (ten times the part's key, as long as its size) holds an urgent order."""
    p = table(spark, base, "part").select("p_partkey", (F.col("p_partkey") * 10).alias("lo"), (F.col("p_partkey") * 10 + F.col("p_size")).alias("hi"))
    return J.in_ranges(p, table(spark, base, "orders").filter("o_orderpriority = '1-URGENT'"), "lo", "hi", "o_orderkey")


def metadata_lookup(spark, base):
    """The last received fps of each episode, on the frames' episodes."""
    e = _episodes(spark, base).select("episode_id", "fps", "received_at", F.coalesce(F.col("calibrated").cast("string"), F.lit("unknown")).alias("calibrated"))
    left = table(spark, base, "frames").select("episode_id").distinct()
    return J.lookup_last(left, e, ["episode_id"], ["received_at", "fps", "calibrated"], ["fps", "calibrated"])


def frame_equi(spark, base):
    """Both sides of a frame joined by number; frames that only one side has are marked."""
    d = _frames(spark, base)
    side = lambda s, n: d.filter(F.col("side") == s).select("episode_id", "frame_idx", F.col("gripper").alias(n), F.lit(True).alias(f"has_{n}"))
    j = side(0, "right").join(side(1, "left"), ["episode_id", "frame_idx"], "full")
    return j.select("episode_id", "frame_idx", "right", "left", F.col("has_right").isNull().alias("no_right"), F.col("has_left").isNull().alias("no_left"))


def positional_zip(spark, base):
    """The rows of both sides paired by place, whatever their numbers."""
    d = _frames(spark, base)
    a = d.filter("side = 0").select("episode_id", F.col("frame_idx").alias("right_frame"))
    b = d.filter("side = 1").select("episode_id", F.col("frame_idx").alias("left_frame"))
    return J.positional(a, b, ["episode_id"], ["right_frame"], ["left_frame"]).select("episode_id", F.col("place").cast("long").alias("place"), "right_frame", "left_frame")


def outer_parity(spark, base):
    """Episodes with both sides whose numbers of rows differ, by how many places."""
    d = _frames(spark, base)
    a = d.filter("side = 0").select("episode_id", F.col("frame_idx").alias("r"))
    b = d.filter("side = 1").select("episode_id", F.col("frame_idx").alias("l"))
    j = J.positional(a, b, ["episode_id"], ["r"], ["l"], "full").groupBy("episode_id").agg(F.count_if(F.col("r").isNull()).alias("only_left"), F.count_if(F.col("l").isNull()).alias("only_right"), F.count("*").alias("places"))
    return j.filter((F.col("only_left") + F.col("only_right") > 0) & (F.col("only_left") < F.col("places")) & (F.col("only_right") < F.col("places")))


def constant_or_framed(spark, base):
    """Widths of the right side: an episode whose widths are all one value gives it once, for all frames; any other gives each frame its own."""
    d = _frames(spark, base).filter("side = 0")
    e = Window.partitionBy("episode_id")
    width = F.col("gripper_width_m")
    v = d.filter("gripper_width_m is not null").withColumns({"_same": F.min(width).over(e) == F.max(width).over(e), "_first": F.min("frame_idx").over(e) == F.col("frame_idx")})
    v = v.filter(~F.col("_same") | F.col("_first")).select("episode_id", "frame_idx", width.alias("width"))
    return J.constant_or_framed(d.select("episode_id", "frame_idx"), v, ["episode_id"], "frame_idx", ["width"])


def hash_equality(spark, base):
    """Documents whose text equals that of another, by hash."""
    h = table(spark, base, "documents").filter("text is not null").select("doc_id", F.sha2("text", 256).alias("sha256"))
    many = h.groupBy("sha256").agg(F.count("*").alias("copies")).filter("copies > 1")
    return h.join(many, "sha256").select("doc_id", "sha256", "copies")


def nearest_centre(spark, base):
    p, _ = P.fields("pose")
    d = J.nearest(_frames(spark, base), [("front", (0.5, 0.0, 0.2)), ("right", (0.2, -0.3, 0.3)), ("left", (0.2, 0.3, 0.3))], p)
    return d.groupBy("episode_id", "side", "nearest").agg(F.count("*").alias("frames"))


def as_of(spark, base):
    """For each event the value of the user's last event of type 'click' at or before it."""
    e = table(spark, base, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_type", "value")
    return J.as_of(e.filter("event_type <> 'click'").select("user_id", "event_id", "at"), e.filter("event_type = 'click'").select("user_id", "at", F.col("value").alias("last_click")), ["user_id"], "at", ["last_click"])


def set_ops(spark, base):
    d = table(spark, base, "frames").select("episode_id", "frame_idx", "side").dropna()
    a, b = d.filter("side = 0").select("episode_id", "frame_idx"), d.filter("side = 1").select("episode_id", "frame_idx")
    parts = {"all": a.unionByName(b), "union": a.union(b).distinct(), "both": a.intersect(b), "only_right": a.subtract(b), "only_left": b.subtract(a)}
    out = None
    for name, p in parts.items():
        n = p.groupBy("episode_id").agg(F.count("*").alias("frames")).select(F.lit(name).alias("part"), "episode_id", "frames")
        out = n if out is None else out.unionByName(n)
    return out


# plans


def keyword_select(spark, base):
    return A.keyword_select(_plan(spark, base), ["source"], "tasks", ["Towel", "crate"]).select("source", "episode_index")


def planned_episodes(spark, base):
    d = A.plan_episodes(_plan(spark, base).withColumn("ms", F.round(F.col("seconds") * 1000).cast("long")), ["source"], ["episode_index"], "ms", 90_000)
    return d.select("source", "episode_index", "ms", "before", "reached")


def planned_files(spark, base):
    return A.planned_files(_plan(spark, base), ["source"], "data_file", "video_files", ["observation.images.front"])


def camera_segments(spark, base):
    cfg = table(spark, base, "source_config").groupBy(source_key("name").alias("source")).agg(F.min("fps").alias("fps"))
    d = A.camera_segments(_plan(spark, base).join(cfg, "source"), ["source", "episode_index"], "video_segments", F.col("fps"))
    return d.select("source", "episode_index", "camera", "file", "first_frame", F.round(F.col("seconds") + TIE, 5).alias("seconds"))


def manifest_report(spark, base):
    d = _plan(spark, base).withColumn("ms", F.round(F.col("seconds") * 1000).cast("long"))
    return A.manifest_report(d, ["source"], "frames", "ms", 120_000).withColumnRenamed("seconds", "ms")


def manifest_check(spark, base):
    """A manifest per source over its rows as they are, repeated ones too, against its recordings: frame sums, sizes, files."""
    rows = table(spark, base, "selected_episodes").filter("episode_index is not null").withColumn("source", source_key("source_dataset"))
    plan = _plan(spark, base)
    m = rows.groupBy("source").agg(
        F.lit(120_000).alias("requested_seconds"), F.sum(F.round(F.col("seconds") * 1000).cast("long")).alias("selected_seconds"), F.sum("frames").alias("selected_frames"),
        F.sum(F.when(F.col("seconds").isNotNull(), F.col("frames"))).alias("sample_rows"), F.lit(2_000_000_000).cast("long").alias("max_slice_bytes"),
    )
    files = plan.filter("data_file is not null").groupBy("source", "data_file").agg((F.sum("frames") * 20_000).alias("bytes"))
    return A.manifest_errors(m, plan.select("source", "frames"), files, "source")


def shared_base(spark, base):
    """Episodes whose registration gives its sides no common base."""
    return R.base_errors(_episodes(spark, base))


def resume_work(spark, base):
    """Episodes without a conversion that has feasible frames and was made with the episode's own task and rate.

    Conversions ran at the rate of their source: those of episodes with another rate are stale and done again.
    """
    sig = A.signature(["task", "fps"])
    rates = table(spark, base, "source_config").groupBy(source_key("name").alias("source")).agg(F.min("fps").alias("source_fps"))
    e = _episodes(spark, base).groupBy("episode_id").agg(F.min("task").alias("task"), F.min("fps").alias("fps"), F.min(source_key("source_dataset")).alias("source"))
    made = e.join(rates, "source", "left").select("episode_id", "task", F.col("source_fps").alias("fps")).withColumn("signature", sig).select("episode_id", "signature")
    done = table(spark, base, "frames").groupBy("episode_id").agg(F.count_if("feasible").alias("feasible_frames")).join(made, "episode_id")
    return A.remaining(e.withColumn("signature", sig), done, ["episode_id"]).select("episode_id")


def names_and_slugs(spark, base):
    c = table(spark, base, "source_config")
    return c.select("name", X.slug(F.col("name")).alias("slug"), X.local_folder(F.col("repo_id")).alias("folder"), F.split_part("repo_id", F.lit("/"), F.lit(1)).alias("owner"))


def archive_numbers(spark, base):
    """Chunk and file numbers of data files, read from their names and written back."""
    f = _plan(spark, base).filter("data_file is not null").select("data_file").distinct()
    chunk, file = (F.regexp_extract("data_file", r"chunk-(\d+)/file-(\d+)\.parquet$", i).try_cast("bigint") for i in (1, 2))
    return f.select("data_file", chunk.alias("chunk"), file.alias("file"), X.chunked_path("data/chunk-%03d/file-%03d.parquet", chunk, file).alias("again"))


def json_fallback(spark, base):
    """The registration of an episode's metadata; broken or missing metadata gives 'none'."""
    e = _episodes(spark, base).groupBy("episode_id").agg(F.min("metadata").alias("metadata"))
    return e.select("episode_id", F.coalesce(F.get_json_object("metadata", "$.registration"), F.get_json_object("metadata", "$.method"), F.lit("none")).alias("registration"))


def content_hash(spark, base):
    d = table(spark, base, "documents").filter("text is not null")
    return d.select("doc_id", F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha256"))


def declared_rates(spark, base):
    """Episodes whose own rate differs from that of their source."""
    cfg = table(spark, base, "source_config").groupBy(source_key("name").alias("source")).agg(F.min("fps").alias("source_fps"))
    e = _episodes(spark, base).select("episode_id", source_key("source_dataset").alias("source"), "fps").distinct()
    return e.join(cfg, "source").filter("fps is null or fps <> source_fps").select("episode_id", "fps", "source_fps")


# export and registration


def export_runs(spark, base):
    return E.numbered_runs(E.export_runs(table(spark, base, "frames"), _episodes(spark, base)), _episodes(spark, base)).select("episode_id", "start", "last", "length", "episode_index", "from_index", "to_index", "task_index")


def export_rows(spark, base):
    return E.export_rows(table(spark, base, "frames"), _episodes(spark, base)).select("episode_index", "frame_index", F.round("timestamp", 6).alias("timestamp"), "index", "task_index", *[(F.round(F.get("action", F.lit(i)).cast("double") + TIE, 5) + 0.0).alias(f"a{i}") for i in range(16)])


def export_info(spark, base):
    """Totals and splits of the dataset."""
    runs = E.numbered_runs(E.export_runs(table(spark, base, "frames"), _episodes(spark, base)), _episodes(spark, base))
    return E.dataset_info(runs).select("total_episodes", "total_frames", "total_tasks", "fps", F.col("splits.train").alias("train"))


def export_validation(spark, base):
    f, e = table(spark, base, "frames"), _episodes(spark, base)
    return E.validate_export(E.export_rows(f, e), E.export_runs(f, e))


def workspace_translation(spark, base):
    d = R.workspace_translations(_frames(spark, base), HOMES)
    return d.select("episode_id", *[F.round(F.col(c) + TIE, 6).alias(c) for c in "xyz"])


def plane_similarity(spark, base):
    """Per episode the similarity that takes the right side's path, seen from above, to the left side's."""
    d = _frames(spark, base)
    a = d.filter("side = 0").select("episode_id", "frame_idx", F.col("pose.x").alias("ax"), F.col("pose.y").alias("ay"))
    b = d.filter("side = 1").select("episode_id", "frame_idx", F.col("pose.x").alias("bx"), F.col("pose.y").alias("by"))
    j = a.join(b, ["episode_id", "frame_idx"])
    s = R.plane_similarities(j, ["episode_id"], (F.col("ax"), F.col("ay")), (F.col("bx"), F.col("by")))
    return s.select("episode_id", *[F.round(F.col(c) + TIE, 4).alias(c) for c in ("scale", "angle", "dx", "dy")])


def rotation_mean(spark, base):
    d = _frames(spark, base)
    q = P.normalize(P.fields("pose")[1])
    m = R.rotation_means(d, ["episode_id", "side"], q)
    return m.select("episode_id", "side", *[F.round(c, 6).alias(c) for c in ("qx", "qy", "qz", "qw")])


def rigid_fit(spark, base):
    """Per episode the rigid transform that takes the right side's positions to the left side's at the same frames."""
    d = _frames(spark, base)
    side = lambda s, p: d.filter(F.col("side") == s).select("episode_id", "frame_idx", *[F.col(f"pose.{c}").alias(p + c) for c in "xyz"])
    j = side(0, "a").join(side(1, "b"), ["episode_id", "frame_idx"])
    f = R.rigid_fits(j, ["episode_id"], [F.col(f"a{c}") for c in "xyz"], [F.col(f"b{c}") for c in "xyz"])
    return R.calibration_report(f, True).select("episode_id", "points", F.round("rms", 6).alias("rms"), "validated")


def registered(spark, base):
    """Frames of active sides carried into the target's workspace."""
    f, act = _frames(spark, base), FR.active_sides(_episodes(spark, base))
    reg = R.auto_register(f.join(act, ["episode_id", "side"], "left_semi"), HOMES)
    out = R.apply_registration(f.select(*KEYS, "pose"), reg, act)
    return out.select(*KEYS, *[F.round(f"pose.{c}", 5).alias(c) for c in ("x", "y", "z", "qx", "qy", "qz", "qw")])


QUERIES = {
    f.__name__: f
    for f in (
        column_statistics, three_numbers, audit_limits, audit_all, benchmark_rollup, weighted_vs_mean, level_psnr, path_length, worst_k, best_per_group, source_totals, selected_semi, missing_anti, range_semi, metadata_lookup,
        frame_equi, positional_zip, outer_parity, constant_or_framed, hash_equality, nearest_centre, as_of, set_ops, keyword_select, planned_episodes, planned_files, camera_segments, manifest_report, manifest_check, shared_base, resume_work, names_and_slugs,
        archive_numbers, json_fallback, content_hash, declared_rates, export_runs, export_rows, export_info, export_validation, workspace_translation, plane_similarity, rotation_mean, rigid_fit, registered,
    )
}

_KEY = "lower(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"
_SRC = _KEY.format("source_dataset")
PLAN = f"pl AS (SELECT {_SRC} AS source, episode_index, arg_max({{'tasks': tasks, 'frames': frames, 'seconds': seconds, 'data_file': data_file, 'video_files': video_files, 'video_segments': video_segments}}, {{'p': planned_at, 'f': frames, 's': coalesce(seconds, -1)}}) AS r FROM selected_episodes WHERE episode_index IS NOT NULL GROUP BY 1, 2), plan AS (SELECT source, episode_index, r.tasks AS tasks, r.frames AS frames, r.seconds AS seconds, r.data_file AS data_file, r.video_files AS video_files, r.video_segments AS video_segments FROM pl)"
CFG = f"cfg AS (SELECT {_KEY.format('name')} AS source, min(fps) AS source_fps FROM source_config GROUP BY 1)"
_STAT = ", ".join(f"round({e} + {TIE}, 6) AS {n}" for n, e in {"min": "min(v)", "max": "max(v)", "mean": "avg(v)", "std": "stddev_pop(v)", "q01": "quantile_cont(v, 0.01)", "q10": "quantile_cont(v, 0.1)", "q50": "quantile_cont(v, 0.5)", "q90": "quantile_cont(v, 0.9)", "q99": "quantile_cont(v, 0.99)"}.items())
_AUD = f"""WITH {RATES}, oks AS (SELECT *, coalesce(position_error_m <= 0.01, false) AND coalesce(orientation_error_rad <= 0.15, false) AND coalesce(jacobian_condition <= 500, false) AND coalesce(speed <= 3.0, q IS NOT NULL) AND coalesce(acceleration <= 20.0, q IS NOT NULL)
 AND coalesce(greatest(abs(q1), abs(q2), abs(q3), abs(q4), abs(q5), abs(q6), abs(q7)) <= 3.2, false) AS ok FROM rt), {ACTIVE}, us AS (SELECT o.*, o.ok AND a.side IS NOT NULL AS used FROM oks o LEFT JOIN act a ON o.episode_id = a.episode_id AND o.side = a.side),
au AS (SELECT {_SRC} AS source_dataset, count(*) AS rows, count(*) FILTER (used) AS used_rows, coalesce(max(abs(sqrt(pose.qx*pose.qx + pose.qy*pose.qy + pose.qz*pose.qz + pose.qw*pose.qw) - 1)), 0.0) AS qn, coalesce(max(abs(position_error_m)) FILTER (used), 0.0) AS pe,
coalesce(max(abs(orientation_error_rad)) FILTER (used), 0.0) AS oe, coalesce(max(abs(jacobian_condition)) FILTER (used), 0.0) AS jc, coalesce(max(abs(speed)) FILTER (used), 0.0) AS sp, coalesce(max(abs(acceleration)) FILTER (used), 0.0) AS ac FROM us GROUP BY 1),
er AS (SELECT *, array_to_string(list_filter([CASE WHEN qn > 1e-5 THEN 'quaternion_norm_error' END, CASE WHEN pe > 0.01 + 1e-8 THEN 'position_error_m' END, CASE WHEN oe > 0.15 + 1e-8 THEN 'orientation_error_rad' END, CASE WHEN jc > 500 + 1e-6 THEN 'jacobian_condition' END,
CASE WHEN sp > 3 + 1e-6 THEN 'speed' END, CASE WHEN ac > 20 + 1e-6 THEN 'acceleration' END], lambda x: x IS NOT NULL), ',') AS errors FROM au)"""
_RUNS = f"WITH {FEASIBLE}, rn AS (SELECT episode_id, run, min(frame_idx) AS start, max(frame_idx) AS last, count(*) AS length FROM fx WHERE feasible GROUP BY 1, 2), info AS (SELECT episode_id, min(coalesce(task, '')) AS task FROM episodes GROUP BY 1), nr AS (SELECT rn.*, info.task, row_number() OVER (ORDER BY rn.episode_id, run) - 1 AS episode_index, sum(length) OVER (ORDER BY rn.episode_id, run) AS to_index FROM rn LEFT JOIN info ON rn.episode_id = info.episode_id), tk AS (SELECT task, dense_rank() OVER (ORDER BY f) - 1 AS task_index FROM (SELECT task, min(episode_index) AS f FROM nr GROUP BY 1)), num AS (SELECT nr.*, tk.task_index FROM nr JOIN tk ON nr.task = tk.task)"

_FINGER = lambda c: f"(CASE WHEN {c} IS NOT NULL THEN (1 - least(greatest({c}, 0), 1)) * {MAX_ANGLE} END)"
_ACTION = ", ".join(f"round(CAST(CAST({v} AS FLOAT) AS DOUBLE) + {TIE}, 5) + 0.0 AS a{i}" for i, v in enumerate([*(f"r.q[{k}]" for k in range(1, 8)), "-" + _FINGER("r.gripper"), *(f"l.q[{k}]" for k in range(1, 8)), _FINGER("l.gripper")]))

SQL = {
    "column_statistics": f"WITH {ONE}, u AS (SELECT {_SRC} AS source, unnest(q) AS v, unnest(range(0, len(q))) AS pos FROM one WHERE q IS NOT NULL) SELECT source, CAST(pos AS INT) AS pos, {_STAT}, count(v) AS count FROM u GROUP BY 1, 2",
    "three_numbers": f"WITH {ONE}, {ACTIVE} SELECT {_SRC} AS source, round(avg(position_error_m * 1000) + {TIE}, 5) AS mean, round(quantile_cont(position_error_m * 1000, 0.95) + {TIE}, 5) AS p95, round(max(position_error_m * 1000) + {TIE}, 5) AS max FROM one o JOIN act a ON o.episode_id = a.episode_id AND o.side = a.side GROUP BY 1",
    "audit_limits": f"{_AUD} SELECT source_dataset, rows, used_rows, round(qn, 5) AS quaternion_norm_error, round(pe, 5) AS position_error_m, round(oe, 5) AS orientation_error_rad, round(jc, 5) AS jacobian_condition, round(sp, 3) AS speed, round(ac, 3) AS acceleration, errors, errors = '' AS ok FROM er",
    "audit_all": f"{_AUD} SELECT bool_and(errors = '') AS ok, count(*) AS sources, CAST(sum(used_rows) AS BIGINT) AS used_rows FROM er",
    "benchmark_rollup": f"WITH {ONE}, e AS (SELECT episode_id, {_SRC} AS source, avg(position_error_m) AS error, avg(CAST(coalesce(feasible, false) AS DOUBLE)) AS feasible FROM one GROUP BY 1, 2) SELECT CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source, count(*) AS n, round(avg(error) + {TIE}, 7) AS error, round(avg(feasible), 6) AS feasible FROM e GROUP BY ROLLUP (source)",
    "weighted_vs_mean": "SELECT l_returnflag, round(sum(l_extendedprice * l_discount) / sum(l_extendedprice), 6) AS weighted, round(avg(l_extendedprice * l_discount / l_extendedprice), 6) AS mean_of_ratios FROM lineitem GROUP BY 1",
    "level_psnr": f"WITH {ONE} SELECT episode_id, side, round(10 * log10(255.0 * 255.0 / greatest(avg(((gripper - round(gripper, 1)) * 255) * ((gripper - round(gripper, 1)) * 255)), 1e-12)), 4) AS psnr FROM one WHERE gripper IS NOT NULL GROUP BY 1, 2",
    "path_length": f"WITH {ONE}, s AS (SELECT episode_id, side, sqrt((pose.x - lag(pose.x) OVER w)*(pose.x - lag(pose.x) OVER w) + (pose.y - lag(pose.y) OVER w)*(pose.y - lag(pose.y) OVER w) + (pose.z - lag(pose.z) OVER w)*(pose.z - lag(pose.z) OVER w)) AS st FROM one WINDOW w AS (PARTITION BY episode_id, side ORDER BY frame_idx)) SELECT episode_id, side, round(coalesce(sum(st), 0.0) + {TIE}, 5) AS metres FROM s GROUP BY 1, 2",
    "worst_k": f"WITH {ONE} SELECT episode_id, side, frame_idx, position_error_m FROM one ORDER BY position_error_m DESC, episode_id * 1000000 + frame_idx * 2 + side DESC LIMIT 10",
    "best_per_group": "SELECT l_suppkey, l_extendedprice, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_quantity) = 1",
    "source_totals": f"WITH {FEASIBLE}, s AS (SELECT episode_id, min({_SRC}) AS source FROM frames GROUP BY 1) SELECT source, count(*) AS frames, count(*) FILTER (feasible) AS feasible_frames, round(count(*) FILTER (feasible) / greatest(count(*), 1), 6) AS feasible_fraction FROM fx JOIN s ON fx.episode_id = s.episode_id GROUP BY 1",
    "selected_semi": "SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')",
    "missing_anti": f"WITH {ACTIVE} SELECT a.episode_id, a.side FROM act a WHERE NOT EXISTS (SELECT 1 FROM frames f WHERE f.episode_id = a.episode_id AND f.side = a.side)",
    "range_semi": "SELECT p_partkey, p_partkey * 10 AS lo, p_partkey * 10 + p_size AS hi FROM part WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey BETWEEN p_partkey * 10 AND p_partkey * 10 + p_size)",
    "metadata_lookup": "WITH l AS (SELECT episode_id, arg_max({'f': fps, 'c': coalesce(CAST(calibrated AS VARCHAR), 'unknown')}, {'r': received_at, 'f': coalesce(fps, -1), 'c': coalesce(CAST(calibrated AS VARCHAR), 'unknown')}) AS v FROM episodes GROUP BY 1) SELECT f.episode_id, v.f AS fps, v.c AS calibrated FROM (SELECT DISTINCT episode_id FROM frames) f LEFT JOIN l ON f.episode_id = l.episode_id",
    "frame_equi": f"WITH {ONE} SELECT coalesce(a.episode_id, b.episode_id) AS episode_id, coalesce(a.frame_idx, b.frame_idx) AS frame_idx, a.gripper AS right, b.gripper AS left, a.episode_id IS NULL AS no_right, b.episode_id IS NULL AS no_left FROM (SELECT * FROM one WHERE side = 0) a FULL JOIN (SELECT * FROM one WHERE side = 1) b ON a.episode_id = b.episode_id AND a.frame_idx = b.frame_idx",
    "positional_zip": f"WITH {ONE}, n AS (SELECT episode_id, side, frame_idx, row_number() OVER (PARTITION BY episode_id, side ORDER BY frame_idx) AS place FROM one) SELECT a.episode_id, a.place, a.frame_idx AS right_frame, b.frame_idx AS left_frame FROM n a JOIN n b ON a.episode_id = b.episode_id AND a.place = b.place AND a.side = 0 AND b.side = 1",
    "outer_parity": f"WITH {ONE}, c AS (SELECT episode_id, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS l FROM one GROUP BY 1) SELECT episode_id, greatest(l - r, 0) AS only_left, greatest(r - l, 0) AS only_right, greatest(r, l) AS places FROM c WHERE r <> l AND r > 0 AND l > 0",
    "constant_or_framed": f"WITH {ONE}, v0 AS (SELECT episode_id, frame_idx, gripper_width_m AS width, min(gripper_width_m) OVER e = max(gripper_width_m) OVER e AS same, min(frame_idx) OVER e = frame_idx AS first FROM one WHERE side = 0 AND gripper_width_m IS NOT NULL WINDOW e AS (PARTITION BY episode_id)), v AS (SELECT episode_id, frame_idx, width, count(*) OVER (PARTITION BY episode_id) AS n FROM v0 WHERE NOT same OR first) SELECT o.episode_id, o.frame_idx, coalesce(c.width, f.width) AS width FROM (SELECT * FROM one WHERE side = 0) o LEFT JOIN (SELECT * FROM v WHERE n = 1) c ON o.episode_id = c.episode_id LEFT JOIN (SELECT * FROM v WHERE n > 1) f ON o.episode_id = f.episode_id AND o.frame_idx = f.frame_idx",
    "hash_equality": "SELECT doc_id, sha256(text) AS sha256, count(*) OVER (PARTITION BY text) AS copies FROM documents WHERE text IS NOT NULL QUALIFY copies > 1",
    "nearest_centre": f"WITH {ONE}, d AS (SELECT episode_id, side, (pose.x-0.5)*(pose.x-0.5)+pose.y*pose.y+(pose.z-0.2)*(pose.z-0.2) AS f, (pose.x-0.2)*(pose.x-0.2)+(pose.y+0.3)*(pose.y+0.3)+(pose.z-0.3)*(pose.z-0.3) AS r, (pose.x-0.2)*(pose.x-0.2)+(pose.y-0.3)*(pose.y-0.3)+(pose.z-0.3)*(pose.z-0.3) AS l FROM one) SELECT episode_id, side, CASE WHEN f <= r AND f <= l THEN 'front' WHEN r <= l THEN 'right' ELSE 'left' END AS nearest, count(*) AS frames FROM d GROUP BY 1, 2, 3",
    "as_of": "SELECT e.user_id, e.event_id, epoch_us(e.ts) AS at, c.value AS last_click FROM (SELECT * FROM events WHERE event_type <> 'click') e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON e.user_id = c.user_id AND e.ts >= c.ts",
    "set_ops": "WITH d AS (SELECT episode_id, frame_idx, side FROM frames), a AS (SELECT episode_id, frame_idx FROM d WHERE side = 0), b AS (SELECT episode_id, frame_idx FROM d WHERE side = 1), u AS (SELECT 'all' AS part, episode_id FROM (SELECT * FROM a UNION ALL SELECT * FROM b) UNION ALL SELECT 'union', episode_id FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'both', episode_id FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'only_right', episode_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'only_left', episode_id FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) SELECT part, episode_id, count(*) AS frames FROM u GROUP BY 1, 2",
    "keyword_select": f"WITH {PLAN}, h AS (SELECT *, coalesce(len(list_filter(tasks, lambda t: contains(lower(t), 'towel') OR contains(lower(t), 'crate'))) > 0, false) AS hit FROM plan), s AS (SELECT *, bool_or(hit) OVER (PARTITION BY source) AS some_ FROM h) SELECT source, episode_index FROM s WHERE hit OR NOT some_",
    "planned_episodes": f"WITH {PLAN}, m AS (SELECT source, episode_index, CAST(round(seconds * 1000) AS BIGINT) AS ms FROM plan WHERE seconds IS NOT NULL), b AS (SELECT *, CAST(coalesce(sum(ms) OVER (PARTITION BY source ORDER BY episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before, sum(ms) OVER (PARTITION BY source) >= 90000 AS reached FROM m) SELECT * FROM b WHERE before < 90000",
    "planned_files": f"WITH {PLAN}, f AS (SELECT source, data_file AS file, 'data' AS kind FROM plan WHERE data_file IS NOT NULL UNION ALL SELECT source, v AS file, 'video' AS kind FROM (SELECT source, unnest(video_files) AS v FROM plan) WHERE contains(v, '/observation.images.front/')) SELECT source, file, kind, count(*) AS episodes FROM f GROUP BY 1, 2, 3",
    "camera_segments": f"WITH {PLAN}, {CFG}, s AS (SELECT plan.source, episode_index, source_fps, unnest(video_segments) AS s FROM plan JOIN cfg ON plan.source = cfg.source) SELECT source, episode_index, s.key AS camera, s.file AS file, CAST(round_even(s.from_timestamp * source_fps, 0) AS BIGINT) AS first_frame, round(s.to_timestamp - s.from_timestamp + {TIE}, 5) AS seconds FROM s",
    "manifest_report": f"WITH {PLAN}, a AS (SELECT source, count(*) AS episodes, CAST(sum(frames) AS BIGINT) AS frames, CAST(sum(CAST(round(seconds * 1000) AS BIGINT)) AS BIGINT) AS ms FROM plan GROUP BY 1) SELECT *, CASE WHEN ms < 120000 THEN 'selected duration is shorter than requested duration' ELSE '' END AS errors FROM a",
    "manifest_check": f"WITH {PLAN}, m AS (SELECT {_SRC} AS source, sum(CAST(round(seconds * 1000) AS BIGINT)) AS ms, sum(frames) AS fr, sum(frames) FILTER (seconds IS NOT NULL) AS sr FROM selected_episodes WHERE episode_index IS NOT NULL GROUP BY 1), e AS (SELECT source, count(*) AS episodes, coalesce(sum(frames), 0) AS frames FROM plan GROUP BY 1), f AS (SELECT source, count(*) AS files, coalesce(sum(b), 0) AS bytes FROM (SELECT source, data_file, sum(frames) * 20000 AS b FROM plan WHERE data_file IS NOT NULL GROUP BY 1, 2) GROUP BY 1), d AS (SELECT m.*, coalesce(episodes, 0) AS episodes, coalesce(frames, 0) AS frames, coalesce(files, 0) AS files, coalesce(bytes, 0) AS bytes FROM m LEFT JOIN e ON m.source = e.source LEFT JOIN f ON m.source = f.source) SELECT source, CAST(episodes AS BIGINT) AS episodes, CAST(frames AS BIGINT) AS frames, CAST(files AS BIGINT) AS files, CAST(bytes AS BIGINT) AS bytes, array_to_string(list_filter([CASE WHEN ms < 120000 THEN 'selected duration is shorter than requested duration' END, CASE WHEN coalesce(fr, frames) <> frames THEN 'selected_frames does not equal the episode frame sum' END, CASE WHEN sr IS DISTINCT FROM frames THEN 'sample_rows does not equal the episode frame sum' END, CASE WHEN files = 0 THEN 'manifest contains no files' END, CASE WHEN bytes > 2000000000 THEN 'files exceed the slice limit' END], lambda x: x IS NOT NULL), '; ') AS errors FROM d",
    "shared_base": "WITH r AS (SELECT episode_id, json_extract(metadata, '$.registration') AS g FROM episodes WHERE json_valid(metadata)), b AS (SELECT episode_id, g, json_extract_string(g, '$.shared_base_frame') AS s, try_cast(json_extract(g, '$.openarm_from_source_base.right') AS DOUBLE[]) AS rt, try_cast(json_extract(g, '$.openarm_from_source_base.left') AS DOUBLE[]) AS lt FROM r WHERE json_type(g) = 'OBJECT' AND CAST(g AS VARCHAR) <> '{}') SELECT DISTINCT episode_id FROM b WHERE NOT coalesce(s = 'true' AND len(rt) = 7 AND len(lt) = 7 AND list_bool_and([abs(rt[i] - lt[i]) <= 1e-10 + 1e-5 * abs(lt[i]) FOR i IN range(1, 8)]), false)",
    "resume_work": f"WITH {CFG}, e AS (SELECT episode_id, min(fps) AS fps, min({_SRC}) AS source FROM episodes GROUP BY 1), d AS (SELECT episode_id FROM frames GROUP BY 1 HAVING count(*) FILTER (feasible) > 0), fresh AS (SELECT e.episode_id FROM e LEFT JOIN cfg ON e.source = cfg.source JOIN d ON d.episode_id = e.episode_id WHERE e.fps IS NOT DISTINCT FROM cfg.source_fps) SELECT episode_id FROM e ANTI JOIN fresh ON e.episode_id = fresh.episode_id",
    "names_and_slugs": "SELECT name, trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_') AS slug, replace(repo_id, '/', '__') AS folder, split_part(repo_id, '/', 1) AS owner FROM source_config",
    "archive_numbers": f"WITH {PLAN}, f AS (SELECT DISTINCT data_file FROM plan WHERE data_file IS NOT NULL), n AS (SELECT data_file, try_cast(regexp_extract(data_file, 'chunk-(\\d+)/file-(\\d+)\\.parquet$', 1) AS BIGINT) AS chunk, try_cast(regexp_extract(data_file, 'chunk-(\\d+)/file-(\\d+)\\.parquet$', 2) AS BIGINT) AS file FROM f) SELECT data_file, chunk, file, printf('data/chunk-%03d/file-%03d.parquet', chunk, file) AS again FROM n",
    "json_fallback": "WITH e AS (SELECT episode_id, min(metadata) AS metadata FROM episodes GROUP BY 1) SELECT episode_id, coalesce(CASE WHEN json_valid(metadata) THEN coalesce(json_extract_string(metadata, '$.registration'), json_extract_string(metadata, '$.method')) END, 'none') AS registration FROM e",
    "content_hash": "SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS bytes, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL",
    "declared_rates": f"WITH {CFG}, e AS (SELECT DISTINCT episode_id, {_SRC} AS source, fps FROM episodes) SELECT episode_id, fps, source_fps FROM e JOIN cfg ON e.source = cfg.source WHERE fps IS NULL OR fps <> source_fps",
    "export_runs": f"{_RUNS} SELECT episode_id, start, last, length, episode_index, CAST(to_index - length AS BIGINT) AS from_index, CAST(to_index AS BIGINT) AS to_index, task_index FROM num",
    "export_rows": f"{_RUNS}, k AS (SELECT fx.episode_id, fx.run, frame_idx, row_number() OVER (PARTITION BY fx.episode_id, fx.run ORDER BY frame_idx) - 1 AS frame_index FROM fx WHERE feasible) SELECT num.episode_index, frame_index, round(frame_index / 30, 6) AS timestamp, CAST(to_index - length + frame_index AS BIGINT) AS index, task_index, {_ACTION} FROM k JOIN num ON k.episode_id = num.episode_id AND k.run = num.run LEFT JOIN one r ON r.episode_id = k.episode_id AND r.frame_idx = k.frame_idx AND r.side = 0 LEFT JOIN one l ON l.episode_id = k.episode_id AND l.frame_idx = k.frame_idx AND l.side = 1",
    "export_info": f"{_RUNS} SELECT count(*) AS total_episodes, CAST(coalesce(sum(length), 0) AS BIGINT) AS total_frames, count(DISTINCT task_index) AS total_tasks, 30 AS fps, '0:' || count(*) AS train FROM num",
    "export_validation": f"{_RUNS} SELECT true AS ok, '' AS errors, CAST(coalesce(sum(length), 0) AS BIGINT) AS frames, count(*) AS episodes FROM num",
    "workspace_translation": f"WITH {ONE}, m AS (SELECT episode_id, side, quantile_cont(pose.x, 0.5) AS x, quantile_cont(pose.y, 0.5) AS y, quantile_cont(pose.z, 0.5) AS z FROM one GROUP BY 1, 2) SELECT episode_id, round(avg(0.3 - x) + {TIE}, 6) AS x, round(avg(CASE WHEN side = 0 THEN -0.2 ELSE 0.2 END - y) + {TIE}, 6) AS y, round(avg(0.3 - z) + {TIE}, 6) AS z FROM m GROUP BY 1",
    "plane_similarity": f"WITH {ONE}, j AS (SELECT a.episode_id, a.pose.x AS ax, a.pose.y AS ay, b.pose.x AS bx, b.pose.y AS by_ FROM one a JOIN one b ON a.episode_id = b.episode_id AND a.frame_idx = b.frame_idx AND a.side = 0 AND b.side = 1), s AS (SELECT episode_id, covar_pop(ax, bx) + covar_pop(ay, by_) AS re, covar_pop(ax, by_) - covar_pop(ay, bx) AS im, var_pop(ax) + var_pop(ay) AS n, avg(ax) AS max_, avg(ay) AS may, avg(bx) AS mbx, avg(by_) AS mby FROM j WHERE ax IS NOT NULL AND ay IS NOT NULL AND bx IS NOT NULL AND by_ IS NOT NULL GROUP BY 1), r AS (SELECT *, least(greatest(CASE WHEN n = 0 THEN NULL ELSE sqrt(re*re + im*im) / n END, 0.35), 2.2) AS scale, atan2(im, re) AS angle FROM s) SELECT episode_id, round(scale + {TIE}, 4) AS scale, round(angle + {TIE}, 4) AS angle, round(mbx - scale * (cos(angle) * max_ - sin(angle) * may) + {TIE}, 4) AS dx, round(mby - scale * (sin(angle) * max_ + cos(angle) * may) + {TIE}, 4) AS dy FROM r",
}
