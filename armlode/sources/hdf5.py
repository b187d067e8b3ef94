"""HDF5 episodes as a Python data source: ``spark.read.format("episode_hdf5")``. Needs h5py where it runs."""

from __future__ import annotations

import glob

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Where an episode's arrays are.
FIELDS = {"timestamp": "/timestamp", "position": "/state/end/position", "orientation": "/state/end/orientation", "gripper": "/state/effector/position"}


class File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.fields = {k: options.get(k, v) for k, v in FIELDS.items()}

    def partitions(self):
        return [File(p) for p in sorted(glob.glob(self.path))]

    def read(self, partition):
        import h5py

        with h5py.File(partition.path, "r") as f:
            a = {k: f[v][()] for k, v in self.fields.items()}
        first = int(a["timestamp"][0])
        for i, ns in enumerate(a["timestamp"]):
            for side, place in ((0, 1), (1, 0)):  # stored left first
                # nanoseconds are subtracted as integers: as doubles since 1970 they would lose precision
                yield (partition.path, i, side, (int(ns) - first) * 1e-9, [*map(float, a["position"][i, place]), *map(float, a["orientation"][i, place])], float(a["gripper"][i, place]))


class EpisodeHdf5(DataSource):
    """One partition per file: (file, frame_idx, side, t, pose, gripper)."""

    @classmethod
    def name(cls) -> str:
        return "episode_hdf5"

    def schema(self) -> str:
        return "file string, frame_idx long, side int, t double, pose array<double>, gripper double"

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.options)
