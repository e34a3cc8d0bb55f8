"""Reading and writing tables and files."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actlens import schema


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A logical table with its fixed schema; a missing column is an error, not a guess."""
    return spark.read.schema(schema.struct(name)).parquet(f"{root}/{name}")


def read_jdbc(spark: SparkSession, url: str, name: str, key: str, low: int, high: int, parts: int = 64, fetch: int = 10_000) -> DataFrame:
    """A database table in ranges of a numeric key, each fetched in batches by one task."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts, fetchsize=fetch).load()


def missing_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows that a copy still lacks: compared on the full key, so that a resumed copy leaves no gap."""
    return source.join(target.select(*keys).distinct(), keys, "left_anti")


def after_mark(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows over the target's largest key; rows at the boundary need ``missing_rows``."""
    mark = target.agg(F.max(key).alias("__m"))
    return source.join(F.broadcast(mark)).where(F.col("__m").isNull() | (F.col(key) > F.col("__m"))).drop("__m")  # one row


def shard(rows: DataFrame, key: str, n: int, i: int) -> DataFrame:
    return rows.where(F.pmod(F.col(key), F.lit(n)) == i)


def remapped(rows: DataFrame, columns: dict[str, str | Column]) -> DataFrame:
    """New name -> old name or expression."""
    return rows.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def table_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def can_write(spark: SparkSession, path: str) -> bool:
    """Whether this session may write under a path, by its nearest folder that exists; an audit refuses one that may."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    while not fs.exists(place) and place.getParent() is not None:
        place = place.getParent()
    try:
        fs.access(place, jvm.org.apache.hadoop.fs.permission.FsAction.WRITE)
    except Py4JJavaError as refused:
        if "AccessControlException" in str(refused.java_exception):
            return False
        raise
    return True


def append_missing(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Appends the rows whose keys a table lacks, one per key, so that a repeated run adds nothing."""
    spark = rows.sparkSession
    out = rows.dropDuplicates(keys)
    if table_exists(spark, path):
        out = missing_rows(out, spark.read.parquet(path), keys).select(*rows.columns)
    out.write.mode("append").parquet(path)


def copy_tables(spark: SparkSession, source: str, target: str, plan: dict[str, dict[str, str | Column] | None], keys: dict[str, list[str]] | None = None) -> dict[str, int]:
    """Copies tables in the order of ``plan``, columns renamed, ids kept; returns each table's next id.

    Rows are told apart by ``keys`` (``id`` where none are given); a copy that is run again, or resumed, adds only
    what is missing.
    """
    next_ids = {}
    for name, columns in plan.items():
        rows = spark.read.parquet(f"{source}/{name}")
        out = remapped(rows, columns) if columns else rows
        append_missing(out, f"{target}/{name}", (keys or {}).get(name, ["id"]))
        if "id" in out.columns:
            next_ids[name] = (spark.read.parquet(f"{target}/{name}").agg(F.max("id")).first()[0] or 0) + 1
    return next_ids


def read_landmarks(spark: SparkSession, path: str) -> DataFrame:
    """The semicolon list of landmark acts: tipo_ato;numero;ano;motivo."""
    return spark.read.schema("tipo_ato string, numero string, ano int, motivo string").option("header", True).option("sep", ";").csv(path)


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    """Batch results, one JSON object a line; broken lines are kept aside in ``quebrada``."""
    return spark.read.schema("custom_id string, result struct<type:string,message:string,error:string>, quebrada string").option("columnNameOfCorruptRecord", "quebrada").json(path)


def write_requests(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def append(rows: DataFrame, path: str, partition: list[str] | None = None) -> None:
    writer = rows.write.mode("append")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)


def write_report(sections: dict[str, DataFrame], folder: str, title: str, rows: int = 50) -> str:
    """One CSV a section, and a text with the first rows of each as a table."""
    parts = [f"# {title}"]
    for name, df in sections.items():
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
        head = [df.columns, *[[("" if v is None else str(v)) for v in r] for r in df.limit(rows).collect()]]
        parts.append(f"## {name}\n\n| " + " |\n| ".join([" | ".join(head[0]), " | ".join("-" for _ in head[0]), *[" | ".join(r) for r in head[1:]]]) + " |")
    return "\n\n".join(parts)


def read_json_config(path: str) -> dict:
    """A small configuration file on the driver."""
    import json

    with open(path, encoding="utf-8") as file:
        return json.load(file)


def stored_replies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chave string, resposta string").json(path)


def pdf_texts(spark: SparkSession, path: str, extract: Callable[[bytes], str]) -> DataFrame:
    """(path, texto) of binary files by an injected extractor; what can't be read gives the empty text."""
    import pyarrow as pa

    from actlens.functions.arrow import arrow_map, column_of

    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def make():
        def one(raw: bytes) -> str:
            try:
                return extract(raw) or ""
            except Exception:  # a corrupt file must not stop the others
                return ""

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([column_of(batch, "path"), pa.array([one(x) for x in column_of(batch, "content").to_pylist()], pa.string())], ["path", "texto"])

        return step

    return arrow_map(files, make, "path string, texto string", rows=16)
