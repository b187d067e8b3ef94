"""Queries of the general data problems, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from armlode.operators import regrid, spikes, units
from armlode.sources.tables import table


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    return spikes.implausible_readings(table(spark, base, "frames"), table(spark, base, "episodes"))


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    return regrid.missing_slots(*(table(spark, base, n) for n in ("frames", "episodes", "source_config")))


def p2_grid(spark: SparkSession, base: str) -> DataFrame:
    return regrid.regular_grid(*(table(spark, base, n) for n in ("frames", "episodes", "source_config")))


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    return units.uncommon_units(table(spark, base, "raw_frames"), table(spark, base, "source_config"))


def p5_common(spark: SparkSession, base: str) -> DataFrame:
    return units.common_units(table(spark, base, "raw_frames"), table(spark, base, "source_config"))


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p2_grid": p2_grid, "p5_found": p5_found, "p5_common": p5_common}

_KEY = "lower(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"

SQL = {
    "p2_found": f"""
WITH own AS (SELECT episode_id, min(CASE WHEN fps > 0 THEN fps END) AS own_fps, min({_KEY.format('source_dataset')}) AS source FROM episodes GROUP BY 1),
rates AS (SELECT {_KEY.format('name')} AS source, min(CASE WHEN fps > 0 THEN fps END) AS source_fps FROM source_config GROUP BY 1),
spans AS (SELECT episode_id, min(t) AS t0, max(t) AS t1, min({_KEY.format('source_dataset')}) AS frame_source FROM frames GROUP BY 1),
grids AS (SELECT s.episode_id, s.t0, coalesce(o.own_fps, r.source_fps) AS fps, s.t1 FROM spans s LEFT JOIN own o ON s.episode_id = o.episode_id
  LEFT JOIN rates r ON r.source = coalesce(o.source, s.frame_source) WHERE s.t0 IS NOT NULL),
sides AS (SELECT DISTINCT episode_id, side FROM frames),
slots AS (SELECT g.episode_id, s.side, unnest(range(0, CAST(floor((g.t1 - g.t0) * g.fps + 0.5) AS BIGINT) + 1)) AS slot FROM grids g JOIN sides s ON g.episode_id = s.episode_id WHERE g.fps IS NOT NULL),
seen AS (SELECT DISTINCT f.episode_id, f.side, CAST(floor((f.t - g.t0) * g.fps + 0.5) AS BIGINT) AS slot FROM frames f JOIN grids g ON f.episode_id = g.episode_id WHERE f.t IS NOT NULL AND g.fps IS NOT NULL)
SELECT s.episode_id, s.side, s.slot FROM slots s ANTI JOIN seen x ON s.episode_id = x.episode_id AND s.side = x.side AND s.slot = x.slot
""",
}


def _unit_rule() -> str:
    """Each record's units by the stated rule, as CTEs that end in ``o`` (record_id, pose, num, lu, ru, gu): text over notes over columns, then the reach. The wordings are the operator's fixed values."""
    u = units
    q = lambda w: "'" + w.replace("'", "''") + "'"
    has = lambda col, w: f"regexp_matches({col}, {q(w)})"
    about = lambda w, no=None: f"array_to_string(list_filter(sentences, lambda s: regexp_matches(s, {q(w)})" + (f" AND NOT regexp_matches(s, {q(no)})" if no else "") + "), ' | ')"
    pick = lambda col, pre="": " ".join(f"WHEN {has(col, pre + '(?:' + w + ')')} THEN '{n}'" for n, w in u._LENGTHS.items())
    scale = " ".join(f"WHEN abs(position_scale / {f} - 1) < 1e-6 THEN '{n}'" for n, f in u.METRES.items())
    return f"""n AS (SELECT *, {_KEY.format('name')} AS source, string_split_regex(lower(regexp_replace(regexp_replace(coalesce(notes, ''), '(?i)\\bi\\.\\s?e\\.', 'ie', 'g'), '(\\d)\\.(\\d)', '\\1 \\2', 'g')), '\\.(?:\\s+|$)') AS sentences FROM source_config),
a AS (SELECT *, {about(u._NOTE_POSITION, u._ROTVEC)} AS np, {about(u._NOTE_ROTATION)} AS nr, {about(u._NOTE_GRIPPER)} AS ng, {about('0 is open')} AS nc FROM n),
g AS (SELECT *, CASE WHEN {has('ng', u._INVERTED)} THEN 'inverted' WHEN {has('ng', u._SIGNED)} THEN 'signed' WHEN {has('ng', u._PERCENT)} THEN 'percent' WHEN {has('ng', u._LENGTHS['cm'])} THEN 'cm' WHEN {has('ng', u._LENGTHS['mm'])} THEN 'mm' WHEN {has('ng', u._COUNTS)} THEN 'counts' WHEN {has('ng', u._CLOSURE)} THEN 'closure'
 WHEN gripper_mode = 'width_mm' THEN 'mm' WHEN gripper_mode = 'signed' THEN 'signed' WHEN gripper_mode = 'closure_position' THEN 'counts' WHEN gripper_open_value > gripper_closed_value THEN 'inverted' ELSE 'closure' END AS gr FROM a),
cfg AS (SELECT source, min(CASE {pick('np')} {scale} ELSE 'm' END) AS len,
 min(CASE WHEN {has('nr', u._WXYZ)} THEN 'quat_wxyz' WHEN {has('nr', u._XYZW)} THEN 'quat_xyzw' WHEN {has('nr', u._ROTVEC)} THEN 'rotvec_rad' WHEN {has('nr', u._DEGREES)} THEN 'euler_deg' WHEN {has('nr', u._RADIANS)} THEN 'euler_rad'
 WHEN rotation_representation = 'rotvec' THEN 'rotvec_rad' WHEN rotation_representation = 'euler' THEN 'euler_rad' WHEN quaternion_order = 'wxyz' THEN 'quat_wxyz' ELSE 'quat_xyzw' END) AS rot,
 min(CASE WHEN nc <> '' AND gr NOT IN ('percent', 'cm', 'mm', 'signed', 'counts') THEN 'closure' ELSE gr END) AS grip FROM g GROUP BY 1),
raw AS (SELECT record_id, any_value({_KEY.format('source_dataset')}) AS source, any_value(pose) AS pose, lower(trim(coalesce(any_value(gripper), ''))) AS gt, lower(coalesce(any_value(unit_text), '')) AS txt FROM raw_frames GROUP BY 1),
t AS (SELECT record_id, source, pose, sqrt(pose[1]*pose[1] + pose[2]*pose[2] + pose[3]*pose[3]) AS d, CASE {pick('txt', u._TEXT_POSITION)} WHEN {has('txt', 'si lengths?')} THEN 'm' END AS tl,
 CASE WHEN {has('txt', u._WXYZ)} THEN 'quat_wxyz' WHEN {has('txt', u._XYZW)} THEN 'quat_xyzw' WHEN {has('txt', u._ROTVEC)} THEN 'rotvec_rad' WHEN {has('txt', 'angle|winkel|rpy|rot|euler')} AND {has('txt', u._DEGREES)} THEN 'deg' WHEN {has('txt', 'angle|winkel|rpy|rot|euler')} AND {has('txt', u._RADIANS)} THEN 'rad' END AS tr,
 regexp_matches(gt, '^[-+]?[0-9]') AS num, regexp_extract(gt, '^[-+]?[0-9.,]+\\s*(.*)$', 1) AS suf FROM raw),
r AS (SELECT t.*, coalesce(len, 'm') AS len, coalesce(rot, 'quat_xyzw') AS rot, coalesce(grip, 'closure') AS grip FROM t LEFT JOIN cfg ON t.source = cfg.source),
o AS (SELECT record_id, pose, num, coalesce(tl, CASE WHEN len IN ('m', 'mm') AND NOT (d * CASE len WHEN 'mm' THEN 0.001 ELSE 1 END BETWEEN {u.NEAREST} AND {u.FARTHEST}) THEN CASE len WHEN 'm' THEN 'mm' ELSE 'm' END ELSE len END) AS lu,
 CASE tr WHEN 'deg' THEN 'euler_deg' WHEN 'rad' THEN CASE rot WHEN 'rotvec_rad' THEN rot ELSE 'euler_rad' END ELSE coalesce(tr, rot) END AS ru,
 CASE WHEN regexp_matches(suf, '^(cm|centimet)') THEN 'cm' WHEN regexp_matches(suf, '^(mm|millimet)') THEN 'mm' WHEN regexp_matches(suf, '^(%|per ?cent)') THEN 'percent' ELSE grip END AS gu FROM r)"""


UNIT_RULE = _unit_rule()
SQL["p5_found"] = f"WITH {UNIT_RULE} SELECT record_id, 'position' AS quantity, lu AS unit FROM o WHERE pose IS NOT NULL AND lu <> 'm' UNION ALL SELECT record_id, 'rotation', ru FROM o WHERE pose IS NOT NULL AND ru <> 'quat_xyzw' UNION ALL SELECT record_id, 'gripper', gu FROM o WHERE num AND gu <> 'closure'"
