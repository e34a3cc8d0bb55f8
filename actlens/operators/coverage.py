"""Coverage of the collection: stages, funnel, defects, breakdowns.

Every act is flagged once by joins with pre-aggregated children; each section is one aggregation of the flags.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.functions.text import has_text

STAGES = ["0_pendente", "1_pdf_indicado", "2_pdf_baixado", "3_com_texto", "4_categorizado", "5_embeddado"]
UNAVAILABLE = "nao_disponivel_portal"


def flags(acts: DataFrame, contents: DataFrame, matters: DataFrame, coleta: DataFrame | None = None) -> DataFrame:
    """One row per act: tem_texto, linha_conteudo, materias, embeddadas, pdf_conhecido and the collection state.

    Columns that a source lacks are taken as absent: no ``embedding`` leaves ``embeddadas`` null, no collection
    table leaves ``pdf_status`` null.
    """
    texts = contents.groupBy("ato_id").agg(F.bool_or(has_text(F.col("texto_completo"))).alias("tem_texto"), F.bool_or(F.col("pdf_path").isNotNull()).alias("tem_pdf"), F.count("*").alias("linhas_conteudo"))
    with_vector = F.count(F.col("embedding")) if "embedding" in matters.columns else F.lit(None).cast("long")
    found = matters.groupBy("ato_id").agg(F.count("*").alias("materias"), with_vector.alias("embeddadas"))
    states = (coleta if coleta is not None else acts.select(F.col("id").alias("ato_id"), F.lit(None).cast("string").alias("pdf_status"), F.lit(0).alias("tentativas")).limit(0)).select("ato_id", "pdf_status", "tentativas")
    out = acts.join(texts, acts["id"] == texts["ato_id"], "left").drop("ato_id").join(found, F.col("id") == F.col("ato_id"), "left").drop("ato_id").join(states, F.col("id") == F.col("ato_id"), "left").drop("ato_id")
    for c in ("tem_texto", "tem_pdf", "pdf_disponivel", "content_disponivel", "analise_completa"):
        out = out.withColumn(c, F.coalesce(F.col(c).cast("boolean"), F.lit(False)))
    for c in ("linhas_conteudo", "materias"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    pending = F.col("materias") - F.col("embeddadas")
    return out.withColumn("vetores_visiveis", F.lit("embedding" in matters.columns)).withColumn("pendentes", F.when(F.col("materias") == 0, F.lit(0)).otherwise(pending))


def stage(flagged: DataFrame) -> DataFrame:
    """Flags with ``estagio``, the furthest stage that an act has reached."""
    s = (
        F.when((F.col("materias") > 0) & (F.col("pendentes") == 0), STAGES[5])
        .when(F.col("materias") > 0, STAGES[4])
        .when(F.col("tem_texto"), STAGES[3])
        .when(F.col("tem_pdf"), STAGES[2])
        .when(F.col("pdf_disponivel"), STAGES[1])
        .otherwise(STAGES[0])
    )
    return flagged.withColumn("estagio", s)


def funnel(flagged: DataFrame) -> DataFrame:
    """One row: acts, acts with text, with a matter, with all matters embedded, and those with no PDF for sure."""
    return flagged.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("tem_texto")).alias("com_texto"),
        F.count_if(F.col("materias") > 0).alias("com_materia"),
        F.count_if((F.col("materias") > 0) & (F.col("pendentes") == 0)).alias("embeddados"),
        F.count_if(F.coalesce(F.col("pdf_status") == "sem_pdf_no_portal", F.lit(False))).alias("sem_pdf_no_portal"),
    )


def defects(flagged: DataFrame) -> DataFrame:
    """Flags with the eight defect columns d1..d8; d6 is null where vectors can't be seen."""
    text, matter, done = F.col("tem_texto"), F.col("materias") > 0, F.col("analise_completa")
    return flagged.withColumns(
        {
            "d1": done & ~text,
            "d2": F.col("content_disponivel") & ~text,
            "d3": ~F.col("content_disponivel") & text,
            "d4": (F.col("pdf_disponivel") | F.coalesce("tem_pdf", F.lit(False))) & ~text,
            "d5": text & ~matter,
            "d6": F.when(F.col("vetores_visiveis"), F.col("pendentes") > 0),
            "d7": ~text & (F.coalesce("tentativas", F.lit(0)) == 0),
            "d8": F.coalesce(F.col("status_vigencia") == UNAVAILABLE, F.lit(False)) & ~text,
        }
    )


def defect_counts(flagged: DataFrame) -> DataFrame:
    """(defeito, n); null where a defect can't be told."""
    counts = [F.when(F.count(f"d{k}") == F.count("*"), F.count_if(F.col(f"d{k}"))).alias(f"d{k}") for k in range(1, 9)]
    one = defects(flagged).agg(*counts)
    return one.select(F.expr("stack(8, " + ", ".join(f"'D{k}', d{k}" for k in range(1, 9)) + ") as (defeito, n)"))


def samples(flagged: DataFrame, defect: str, size: int = 10) -> DataFrame:
    return defects(flagged).where(F.col(defect)).orderBy("id").limit(size)


def breakdown(flagged: DataFrame, dimension: str) -> DataFrame:
    """(dimension, total, sem_texto, pct): acts without text by a dimension, most first."""
    out = flagged.groupBy(dimension).agg(F.count("*").alias("total"), F.count_if(~F.col("tem_texto")).alias("sem_texto"))
    return out.withColumn("pct", F.round(F.lit(100.0) * F.col("sem_texto") / F.col("total"), 1)).orderBy(F.desc("sem_texto"), F.col(dimension).asc_nulls_last())


def focus(flagged: DataFrame, ids: list[int]) -> DataFrame:
    """The asked acts, each with whether it exists."""
    asked = flagged.sparkSession.createDataFrame([(i,) for i in ids], "id long")
    return asked.join(stage(flagged).withColumn("existe", F.lit(True)), "id", "left").withColumn("existe", F.coalesce("existe", F.lit(False)))


def inferred_collection(acts: DataFrame, contents: DataFrame, coleta: DataFrame | None = None) -> DataFrame:
    """Collection rows for acts that have none: ``baixado`` with text, else ``nao_tentado``; absence is never inferred."""
    texts = contents.where(has_text(F.col("texto_completo"))).select(F.col("ato_id").alias("id")).distinct().withColumn("t", F.lit(True))
    rows = acts.select("id").join(texts, "id", "left").select(F.col("id").alias("ato_id"), F.when(F.col("t"), "baixado").otherwise("nao_tentado").alias("pdf_status"), F.lit(0).alias("tentativas"))
    return rows.join(coleta.select("ato_id"), "ato_id", "left_anti") if coleta is not None else rows


def volumetry(acts: DataFrame, kind: str, published: str) -> DataFrame:
    """(kind, n, first, last): size and freshness by kind."""
    return acts.groupBy(kind).agg(F.count("*").alias("n"), F.min(published).alias("first"), F.max(published).alias("last"))


def vector_coverage(matters: DataFrame, vec: str = "embedding") -> DataFrame:
    """One row (n, com_vetor, pct): matters, those that have a vector, and their share in percent."""
    out = matters.agg(F.count("*").alias("n"), F.count(F.col(vec)).alias("com_vetor"))
    return out.withColumn("pct", F.round(F.lit(100.0) * F.col("com_vetor") / F.col("n"), 1))


def graph_statistics(relations: DataFrame) -> DataFrame:
    """(tipo_relacao, n, origens, pendentes): relations by type, their distinct origins, and those whose target is not held."""
    return relations.groupBy("tipo_relacao").agg(F.count("*").alias("n"), F.countDistinct("ato_origem_id").alias("origens"), F.count_if(F.col("ato_destino_id").isNull()).alias("pendentes"))
