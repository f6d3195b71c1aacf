"""Tables in a folder: versions of Parquet data, and numbered manifests that say which one is current.

A manifest holds the descriptor, the data's folder and its number of rows. It is written under another name and takes its number in
one rename, after its data; the highest number wins. So a reader, or a writer that starts after a crash, finds the old table or the
new one whole. All access goes through Hadoop's file systems, so a folder may be anywhere that Spark can write.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from hypercell.errors import InvalidTable
from hypercell.sources import descriptor as D

_MANIFEST = re.compile(r"manifest-(\d{10})\.json")


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir``; a folder of our own only where that is unset and all runs on one machine."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if top is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        top = tempfile.mkdtemp(prefix="hypercell-")
    return top.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, which goes when the application ends."""
    store = Store(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    store._fs.mkdirs(store._path(store.path))
    store._fs.deleteOnExit(store._path(store.path))
    return store.path


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._jvm = jvm

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}")

    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._path(self.path)):
            return []
        found = (_MANIFEST.fullmatch(x.getPath().getName()) for x in self._fs.listStatus(self._path(self.path)))
        return sorted(int(m[1]) for m in found if m)

    def exists(self) -> bool:
        return bool(self._numbers())

    def manifest(self) -> dict:
        """``version``, ``data``, ``rows`` and ``descriptor`` of the current version."""
        numbers = self._numbers()
        if not numbers:
            raise InvalidTable(f"{self.path} is not a table")
        stream = self._fs.open(self._at(f"manifest-{numbers[-1]:010d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode()) | {"version": numbers[-1]}
        finally:
            stream.close()

    def _publish(self, number: int, data: str, rows: int, desc: dict) -> None:
        hidden, seen = self._at(f".manifest-{uuid.uuid4().hex}"), self._at(f"manifest-{number:010d}.json")
        stream = self._fs.create(hidden, True)
        try:
            stream.write(bytearray(json.dumps({"data": data, "rows": rows, "descriptor": desc}, sort_keys=True).encode()))
        finally:
            stream.close()
        if self._fs.exists(seen) or not self._fs.rename(hidden, seen):
            raise OSError(f"version {number} of {self.path} could not be written")

    def descriptor(self) -> dict:
        return self.manifest()["descriptor"]

    def rows(self) -> int:
        return self.manifest()["rows"]

    def set_descriptor(self, desc: dict) -> None:
        """A new version with the same data."""
        now = self.manifest()
        self._publish(now["version"] + 1, now["data"], now["rows"], desc)

    def version(self) -> int:
        return self.manifest()["version"]

    def read(self) -> DataFrame:
        now = self.manifest()
        return self.spark.read.schema(D.schema(now["descriptor"])).parquet(f"{self.path}/{now['data']}")

    def commit(self, df: DataFrame, desc: dict, clustered: bool = False) -> None:
        """Write ``df`` (with row numbers) as the next version, rows in order within and across files, so that row ranges prune
        row groups; then make it current."""
        new = (self._numbers() or [-1])[-1] + 1
        df = df.select(D.ROW, *D.columns(desc))
        if not clustered:
            df = df.repartitionByRange(D.ROW).sortWithinPartitions(D.ROW)
        # What a writer that failed has left under this number is not read by anyone.
        data = f"data/v={new}"
        df.write.mode("overwrite").parquet(f"{self.path}/{data}")
        rows = self.spark.read.schema(D.schema(desc)).parquet(f"{self.path}/{data}").count()  # from the files' footers
        self._publish(new, data, rows, desc)

    def vacuum(self) -> int:
        """Delete manifests and data that are not current; returns how many versions of data."""
        now, gone = self.manifest(), 0
        for n in self._numbers()[:-1]:
            self._fs.delete(self._at(f"manifest-{n:010d}.json"), False)
        for x in self._fs.listStatus(self._at("data")):
            name = x.getPath().getName()
            if name.startswith("v=") and f"data/{name}" != now["data"]:
                gone += bool(self._fs.delete(x.getPath(), True))
        return gone

    def remove(self) -> None:
        self._fs.delete(self._path(self.path), True)


def split(filename: str) -> str:
    """``path::NAME`` names the subtable NAME of the table at path."""
    path, sep, name = filename.partition("::")
    return f"{path.rstrip('/')}/{name}" if sep else path.rstrip("/")
