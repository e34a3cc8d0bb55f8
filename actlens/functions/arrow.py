"""Arrow maps: Python over record batches, with this package's sources sent to the workers."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows in one Arrow batch. Texts may be 100 kB and more, so that batches must stay short.
BATCH_ROWS = 512
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once for each Spark application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="actlens-")) / "actlens_sources.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def arrow_map(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table]], schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` with state made once a task: ``make()`` returns the function for one batch.

    If that function has an attribute ``close``, it is called at the task's end, to free what a worker process keeps.
    """
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        try:
            for batch in batches:
                step = step or make()
                out = step(batch)
                if isinstance(out, pa.Table):
                    yield from out.to_batches()
                else:
                    yield out
        finally:
            getattr(step, "close", int)()
            step = None
            free_memory()

    return df.mapInArrow(run, schema)


def free_memory() -> None:
    """Gives what a task has freed back to the system, as idle worker processes live on beside other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library on Linux only
    if trim is not None:
        trim(0)


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a column; null becomes the empty text."""
    return [x or "" for x in column_of(batch, name).to_pylist()]
