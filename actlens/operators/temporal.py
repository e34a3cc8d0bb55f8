"""Versions of segments, text in force and timelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actlens.operators.search import binding_efficacy, binding_window


def change_ordinals(changes: DataFrame) -> DataFrame:
    """Changes with their number inside (act, segment): by date, nulls last, then id."""
    order = Window.partitionBy("ato_id", "id_segmento").orderBy(F.col("data").asc_nulls_last(), "id")
    return changes.withColumn("n_alteracao", F.row_number().over(order))


def validity(segments: DataFrame, changes: DataFrame, acts: DataFrame) -> DataFrame:
    """Segments with ``inicio``: version 1 from publication, version n from the (n-1)th change, else from publication."""
    numbered = change_ordinals(changes).select("ato_id", "id_segmento", (F.col("n_alteracao") + 1).alias("versao"), F.col("data").alias("__change"))
    out = segments.join(numbered, ["ato_id", "id_segmento", "versao"], "left").join(acts.select("ato_id", "data_publicacao"), "ato_id")
    return out.withColumn("inicio", F.when(F.col("versao") == 1, F.col("data_publicacao")).otherwise(F.coalesce("__change", "data_publicacao"))).drop("__change", "data_publicacao")


def in_force(valid: DataFrame, at: str, omit_mode: str = "before_max") -> DataFrame:
    """The latest version of each segment that had begun by a day.

    ``before_max`` leaves omitted versions out before the latest is taken, so that an earlier one shows again;
    ``after_max`` takes the latest first, so that an omitted segment is absent; ``ignore`` shows it.
    """
    if omit_mode not in ("before_max", "after_max", "ignore"):
        raise ValueError(f"unknown omit_mode {omit_mode}")
    rows = valid.where(F.col("inicio") <= F.lit(at).cast("date"))
    if omit_mode == "before_max":
        rows = rows.where(~F.coalesce("is_omitido", F.lit(False)))
    names = [c for c in rows.columns if c not in ("ato_id", "id_segmento")]
    best = rows.groupBy("ato_id", "id_segmento").agg(F.max_by(F.struct(*names), "versao").alias("s")).select("ato_id", "id_segmento", "s.*")
    return best.where(~F.coalesce("is_omitido", F.lit(False))) if omit_mode == "after_max" else best


def register_text_in_force(valid: DataFrame, name: str = "texto_vigente_em") -> None:
    """A SQL table function ``name(ato, dia)`` over segments with ``inicio`` (see ``validity``): the text shown on a day.

    It returns (ato_id, id_segmento, versao, ordem, texto_integra), omitted versions left out before the latest is
    taken, for this session. The segments become the temporary view ``name_segmentos``.
    """
    spark = valid.sparkSession
    columns = ("ato_id", "id_segmento", "versao", "ordem", "texto_integra")
    valid.select(*columns, "inicio", "is_omitido").createOrReplaceTempView(f"{name}_segmentos")
    types = {f.name: f.dataType.simpleString() for f in valid.schema}
    best = ", ".join(f"s.{c}" for c in columns[2:])
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(ato BIGINT, dia DATE) RETURNS TABLE ({", ".join(f"{c} {types[c]}" for c in columns)}) RETURN
        SELECT ato_id, id_segmento, {best} FROM (SELECT ato_id, id_segmento, max_by(struct({", ".join(columns[2:])}), versao) AS s FROM {name}_segmentos
        WHERE ato_id = ato AND inicio <= dia AND NOT coalesce(is_omitido, false) GROUP BY ato_id, id_segmento)""")


def current_segments(segments: DataFrame, changes: DataFrame) -> DataFrame:
    """Compiled segments with the number of their changes."""
    counts = changes.groupBy("ato_id", "id_segmento").agg(F.count("*").alias("alteracoes"))
    return segments.where("is_compilado").join(counts, ["ato_id", "id_segmento"], "left").withColumn("alteracoes", F.coalesce("alteracoes", F.lit(0)).cast("long"))


def evolution(changes: DataFrame, acts: DataFrame, acts_all: DataFrame) -> DataFrame:
    """Changes with the changed act and, where it is known, the changing one."""
    target = acts.select(F.col("ato_id"), F.col("nome").alias("alvo"))
    modifier = acts_all.select(F.col("ato_id").alias("modificador_id"), F.col("nome").alias("modificador"))
    return changes.join(target, "ato_id").join(modifier, "modificador_id", "left")


def timeline(rows: DataFrame, binding_at: str | None = None, months: int = 60) -> DataFrame:
    """(ano, ...): rows of a theme with their year, in order; with a day only those binding then, known efficacy only."""
    kept = rows.where(binding_window(F.col("data"), binding_at, months) & binding_efficacy(F.col("eficacia"), False)) if binding_at else rows
    return kept.withColumn("ano", F.year("data")).orderBy(F.col("data").asc_nulls_last(), "id")


def by_year(rows: DataFrame, *sums: Column) -> DataFrame:
    return timeline(rows).groupBy("ano").agg(*sums)
