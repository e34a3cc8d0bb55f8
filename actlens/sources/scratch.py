"""Tables of one job in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tasks a core that write a table of numbers, so many that a slow one doesn't hold up the others for long.
TASKS = 4
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the context's checkpoint folder; a temporary one in local mode only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local.setdefault(context.applicationId, "file://" + tempfile.mkdtemp(prefix="actlens-"))


class Scratch:
    """Written tables. Each cuts the lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, tag: str) -> None:
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}", 0

    def put(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it back; the frame carries its path for ``drop``."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        # no mark of success: nothing reads it, and on a local folder each file and folder costs a process (chmod)
        df.write.option("compression", "zstd").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch_path = path
        return back

    def few(self, df: DataFrame) -> DataFrame:
        """``put`` by at most ``TASKS`` tasks a core: for rows of a few numbers, which are not worth a file for each partition."""
        return self.put(df.coalesce(TASKS * self.spark.sparkContext.defaultParallelism))

    def drop(self, *frames: DataFrame) -> None:
        """Delete written tables that nothing reads any more."""
        for frame in frames:
            self._delete(frame._scratch_path)

    def clear(self) -> None:
        """Delete all tables of the job."""
        self._delete(self.root)

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
