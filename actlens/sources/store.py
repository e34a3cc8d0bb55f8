"""A table of key buckets on any file system that Spark writes: the next state is published by one new file.

Rows lie in buckets by a hash of their key. A write puts the buckets that it touches into a folder of its own and then
publishes a manifest, a small file that names the folder of each bucket; the manifest of the largest number is the
table. A manifest is written under another name and renamed to one that does not exist yet, which is atomic on the
file systems that rename, so that a reader, and the next writer after a crash at any point, sees the old state or the
new one and nothing else. Folders that neither the last two manifests name are taken away after a write.

One writer at a time is assumed; a second one that publishes the same number fails and leaves the table as it is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 32
_BUCKET = "__bucket"


class Store:
    """``path`` holds the table of ``schema`` with ``keys``; it is empty until the first write."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: StructType, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.keys, self.schema, self.buckets = spark, path.rstrip("/"), keys, schema, buckets
        self._jvm = spark._jvm
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _numbers(self) -> list[int]:
        found = self._fs.globStatus(self._at("manifest-*.json")) or []
        return sorted(int(x.getPath().getName()[len("manifest-") : -len(".json")]) for x in found)

    def _manifest(self, number: int) -> dict:
        stream = self._fs.open(self._at(f"manifest-{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> dict:
        """Number, folders by bucket and the last batch of the published state."""
        numbers = self._numbers()
        return self._manifest(numbers[-1]) if numbers else {"number": 0, "buckets": self.buckets, "folders": {}, "batch": None}

    def bucket(self, buckets: int | None = None) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets or self.current()["buckets"])).cast("int")

    def read(self, only: Iterable[int] | None = None) -> DataFrame:
        """The published rows, of all buckets or of some."""
        folders = self.current()["folders"]
        wanted = [f"{self.path}/{folders[k]}" for k in (folders if only is None else map(str, sorted(only))) if k in folders]
        return self.spark.read.schema(self.schema).parquet(*wanted) if wanted else self.spark.createDataFrame([], self.schema)

    def replace(self, rows: DataFrame, only: Iterable[int] | None = None, batch: int | None = None) -> None:
        """Publishes ``rows`` as the new content of some buckets (all by default); rows must lie in those."""
        now = self.current()
        folder = f"data-{uuid.uuid4().hex}"
        out = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).withColumn(_BUCKET, self.bucket(now["buckets"]))
        out.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        written = {s.getPath().getName().split("=")[1]: f"{folder}/{s.getPath().getName()}" for s in self._fs.globStatus(self._at(f"{folder}/{_BUCKET}=*")) or []}
        gone = set(now["folders"]) if only is None else set(map(str, only))
        folders = {k: v for k, v in now["folders"].items() if k not in gone} | written
        self._publish(now["number"] + 1, {"number": now["number"] + 1, "buckets": now["buckets"], "folders": folders, "batch": now["batch"] if batch is None else batch})

    def _publish(self, number: int, manifest: dict) -> None:
        draft, final = self._at(f".draft-{uuid.uuid4().hex}"), self._at(f"manifest-{number:012d}.json")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise OSError(f"{self.path} was written by another writer")
        self._sweep(number, manifest)

    def _sweep(self, number: int, manifest: dict) -> None:
        """Takes away what neither the last manifest nor the one before it names."""
        kept = [manifest, *(self._manifest(k) for k in self._numbers() if k == number - 1)]
        named = {f.split("/")[0] for m in kept for f in m["folders"].values()}
        for status in self._fs.globStatus(self._at("data-*")) or []:
            if status.getPath().getName() not in named:
                self._fs.delete(status.getPath(), True)
        for k in self._numbers():
            if k < number - 1:
                self._fs.delete(self._at(f"manifest-{k:012d}.json"), False)
        for status in self._fs.globStatus(self._at(".draft-*")) or []:
            self._fs.delete(status.getPath(), False)
