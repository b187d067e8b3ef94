"""Detections: plausible boxes, the best per side, expansion, carrying over from masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Plausible areas of robot and object boxes, as parts of the image.
ROBOT_AREA, OBJECT_AREA = (0.01, 0.35), (0.001, 0.15)


def area_share(box: Column, width: int, height: int) -> Column:
    """The part of the image that a box covers; null where its corners are malformed."""
    w, h = box["xmax"] - box["xmin"], box["ymax"] - box["ymin"]
    return F.when((w > 0) & (h > 0), w * h / (width * height))


def plausible(detections: DataFrame, width: int, height: int, area: tuple[float, float]) -> DataFrame:
    return detections.filter(area_share(F.col("box"), width, height).between(*area))


def expand(box: Column, share: float, width: int, height: int) -> Column:
    """The box grown by a share of its size on every side, kept within the image."""
    dx, dy = (box["xmax"] - box["xmin"]) * share, (box["ymax"] - box["ymin"]) * share
    low = lambda c: F.greatest(c, F.lit(0.0))
    return F.struct(low(box["xmin"] - dx).alias("xmin"), low(box["ymin"] - dy).alias("ymin"), F.least(box["xmax"] + dx, F.lit(float(width))).alias("xmax"), F.least(box["ymax"] + dy, F.lit(float(height))).alias("ymax"))


def robot_boxes(detections: DataFrame, keys: list[str], width: int, height: int, share: float = 0.05) -> DataFrame:
    """Per frame and half of the image the plausible box of greatest score, expanded; of equal scores the first listed.

    ``detections`` holds (keys, place, score, box); ``place`` is the order in which they were listed.
    """
    d = plausible(detections, width, height, ROBOT_AREA).withColumn("half", F.when((F.col("box.xmin") + F.col("box.xmax")) / 2 < width / 2, "left").otherwise("right"))
    w = Window.partitionBy(*keys, "half").orderBy(F.desc("score"), "place")
    return d.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*keys, "half", "score", expand(F.col("box"), share, width, height).alias("box"))


def prompt_boxes(detections: DataFrame, keys: list[str], width: int, height: int, most: int, share: float = 0.05) -> DataFrame:
    """Per frame the ``most`` plausible object boxes of greatest (score, box)."""
    d = plausible(detections, width, height, OBJECT_AREA)
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("box"))
    return d.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).select(*keys, "rank", "score", expand(F.col("box"), share, width, height).alias("box"))
