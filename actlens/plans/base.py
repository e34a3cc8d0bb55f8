"""Registration of queries, and the driver tables seen as acts, matters, segments and states."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
AS_OF = "2001-08-02"


def query(sql: str | None = None, dates: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL if there is one; ``dates`` are returned as ISO texts."""

    def keep(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in dates})

        QUERIES[f.__name__] = run if dates else f
        if sql:
            text = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in dates)}) FROM ({sql.strip()}) z" if dates else sql
            SQL[f.__name__] = text
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(c: str):
    return F.col(c).cast("date")


def matters(spark: SparkSession, sf_dir: str, texts=None, vectors=None) -> DataFrame:
    """Documents with a vector as matters: id, body, embedding, theme, act, act type, kind, issuer, sign and a date.

    ``texts`` and ``vectors`` may work on the tables that hold body and embedding before they are joined.
    """
    d, e, l = (table(spark, sf_dir, n) for n in ("documents", "embeddings", "labels"))
    d = d.select("doc_id", F.col("text").alias("body"), F.col("lang").alias("tipo_ato"), F.col("source").alias("ato"))
    e = e.select(F.col("vec_id").alias("doc_id"), "embedding", F.col("label").alias("theme"))
    signs = l.select("doc_id", F.when(F.col("toxic") == 1, "VEDA").when(F.col("quality") == 1, "AUTORIZA").otherwise("INDETERMINADO").alias("sinal"), "quality")
    rows = (texts(d) if texts else d).join(vectors(e) if vectors else e, "doc_id").join(signs, "doc_id", "left").withColumnRenamed("doc_id", "id")
    kinds, issuers = (F.array(*map(F.lit, x)) for x in (KINDS, ISSUERS))
    rows = rows.withColumns({"especie": F.get(kinds, F.col("id") % 4), "emissor": F.get(issuers, F.col("id") % 3)})
    return rows.withColumn("data_publicacao", F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") % 2400).cast("int")))


KINDS = ["SOLUCAO_CONSULTA", "INSTRUCAO_NORMATIVA", "SOLUCAO_DIVERGENCIA", "PORTARIA"]
ISSUERS = ["COSIT", "DISIT", "COANA"]
MATTERS_SQL = """
m AS (
  SELECT d.doc_id AS id, d.text AS body, e.embedding::DOUBLE[] AS v, e.label AS theme, d.source AS ato, d.lang AS tipo_ato, l.quality,
    CASE WHEN l.toxic = 1 THEN 'VEDA' WHEN l.quality = 1 THEN 'AUTORIZA' WHEN l.doc_id IS NOT NULL THEN 'INDETERMINADO' END AS sinal,
    CAST(DATE '1995-01-01' + CAST(d.doc_id % 2400 AS INTEGER) AS DATE) AS data_publicacao, d.doc_id % 4 AS k, d.doc_id % 3 AS i
  FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def vector_of(spark: SparkSession, sf_dir: str, vec_id: int) -> list[float]:
    row = table(spark, sf_dir, "embeddings").where(F.col("vec_id") == vec_id).select("embedding").first()
    return [float(x) for x in row[0]]
