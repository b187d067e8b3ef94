"""File sources: metadata in file order, archive members, manifests, hashes, arrays, images."""

from __future__ import annotations

import io
import json
import struct
import tarfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlode.operators.pixels import LAYER


def ordered_parquet(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files under a folder, their columns united, with ``_file`` and ``_row`` as the order they are read in."""
    d = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)
    return d.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def columns_by_name(df: DataFrame, names: list[str], prefixes: list[str]) -> DataFrame:
    """The columns that are named, and those that start with a prefix; the scan reads no others."""
    return df.select([F.col(f"`{c}`") for c in df.columns if c in names or any(c.startswith(p) for p in prefixes)])


def json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON files that hold an object or an array of objects each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def file_records(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file, bytes, sha256) of every file under a folder, hashed where it is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(F.regexp_replace("path", "^file:/+", "/").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def _safe(member: tarfile.TarInfo, prefixes: tuple[str, ...]) -> bool:
    """A regular file below a prefix that stays within the folder it is written to."""
    parts = member.name.split("/")
    return member.isfile() and not member.name.startswith("/") and ".." not in parts and (not prefixes or member.name.startswith(prefixes))


def tar_members(spark: SparkSession, path: str, prefixes: tuple[str, ...] = (), strip: int = 0) -> DataFrame:
    """(archive, member, bytes, content): the safe members of tar archives; links, devices and paths that climb are left out.

    An archive is one task's work; members are given out one at a time.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, content in zip(f["path"], f["content"]):
                with tarfile.open(fileobj=io.BytesIO(content)) as archive:
                    for member in archive:
                        if _safe(member, prefixes):
                            data = archive.extractfile(member).read()
                            yield pd.DataFrame([(name, "/".join(member.name.split("/")[strip:]), len(data), data)], columns=["archive", "member", "bytes", "content"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInPandas(read, "archive string, member string, bytes long, content binary")


def depth_frames(spark: SparkSession, path: str) -> DataFrame:
    """(file, frame_idx, h, w, depth_m): depth images of ``NNNNNN.npy`` or ``.npz`` (key 'depth_m', else the first). Infinity means no hit."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for name, content in zip(f["path"], f["content"]):
                a = np.load(io.BytesIO(content), allow_pickle=False)
                if hasattr(a, "files"):
                    a = a["depth_m" if "depth_m" in a.files else a.files[0]]
                rows.append((name, int(name.rsplit("/", 1)[1].split(".")[0]), *a.shape, a.astype(np.float32).ravel().tolist()))
            yield pd.DataFrame(rows, columns=["file", "frame_idx", "h", "w", "depth_m"])

    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter(F.col("path").rlike(r"/\d+\.np[yz]$")).select("path", "content")
    return d.mapInPandas(read, "file string, frame_idx long, h int, w int, depth_m array<float>")


def image_frames(spark: SparkSession, path: str) -> DataFrame:
    """Layers of PNG sequences ``<clip>/NNNNNN.png`` by Spark's image source; colours come as blue, green, red (, alpha)."""
    d = spark.read.format("image").option("recursiveFileLookup", True).load(path)
    name = F.col("image.origin")
    return d.select(F.regexp_extract(name, r"([^/]+)/\d+\.png$", 1).alias("clip"), F.regexp_extract(name, r"(\d+)\.png$", 1).cast("long").alias("frame_idx"), F.col("image.height").alias("h"), F.col("image.width").alias("w"), F.col("image.nChannels").alias("c"), F.col("image.data").alias("data"))


def png(a: np.ndarray) -> bytes:
    """An 8-bit PNG of a grey [h, w], RGB or RGBA [h, w, c] image."""
    h, w = a.shape[:2]
    kind = {1: 0, 3: 2, 4: 6}[1 if a.ndim == 2 else a.shape[2]]
    raw = b"".join(b"\0" + row.tobytes() for row in np.ascontiguousarray(a, dtype=np.uint8).reshape(h, -1))
    chunk = lambda tag, data: struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def write_images(layers: DataFrame, folder: str) -> DataFrame:
    """Writes layers as ``folder/<clip>/NNNNNN.png`` from the tasks, and gives (clip, frame_idx, file). The folder must be shared."""
    import os

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for d in f.to_dict("records"):
                a = np.frombuffer(d["data"], dtype=np.uint8).reshape((d["h"], d["w"]) if d["c"] == 1 else (d["h"], d["w"], d["c"]))
                at = f"{folder}/{d['clip']}/{int(d['frame_idx']):06d}.png"
                os.makedirs(os.path.dirname(at), exist_ok=True)
                with open(f"{at}.part", "wb") as out:
                    out.write(png(a))
                os.replace(f"{at}.part", at)  # a task that is run again replaces whole files
                rows.append((d["clip"], int(d["frame_idx"]), at))
            yield pd.DataFrame(rows, columns=["clip", "frame_idx", "file"])

    return layers.select(*[c.split()[0] for c in LAYER.split(", ")]).mapInPandas(write, "clip string, frame_idx long, file string")


def write_report(df: DataFrame, path: str) -> None:
    """A report's rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_episodes(frames: DataFrame, path: str) -> None:
    """Frames as Parquet by hash of the episode: each file holds whole episodes in order."""
    frames.repartition("episode_id").sortWithinPartitions("episode_id", "side", "frame_idx").write.mode("overwrite").option("compression", "zstd").parquet(path)


def episode_npz(spark: SparkSession, path: str) -> DataFrame:
    """Frames of ``.npz`` episodes: (episode, frame_idx, side, t, pose, gripper, q, feasible, metadata); diagnostics are read by name elsewhere."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, content in zip(f["path"], f["content"]):
                a = np.load(io.BytesIO(content), allow_pickle=False)
                t = a["timestamp"]
                meta = str(a["metadata_json"]) if "metadata_json" in a.files else json.dumps({})
                q = a["joint_position"] if "joint_position" in a.files else None
                ok = a["feasible"] if "feasible" in a.files else None
                rows = [
                    (name, i, s, float(t[i]), dict(zip(("x", "y", "z", "qx", "qy", "qz", "qw"), a["ee_pose"][i, s].astype(float).tolist())), float(a["gripper"][i, s]), None if q is None else q[i, s].astype(float).tolist(), None if ok is None else bool(ok[i]), meta)
                    for i in range(len(t)) for s in range(a["ee_pose"].shape[1])
                ]
                yield pd.DataFrame(rows, columns=["episode", "frame_idx", "side", "t", "pose", "gripper", "q", "feasible", "metadata"])

    d = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").option("recursiveFileLookup", True).load(path).select("path", "content")
    return d.mapInPandas(read, "episode string, frame_idx long, side byte, t double, pose struct<x:double,y:double,z:double,qx:double,qy:double,qz:double,qw:double>, gripper double, q array<double>, feasible boolean, metadata string")
