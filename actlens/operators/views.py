"""Portal views: segments, history rows, assembled text and status from nested JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.functions.text import date_dmy, has_text, squeeze

SEGMENT = "struct<idSegmento:long,versaoSegmento:int,ordemSegmentoAto:int,idTipoSegmento:int,idAssunto:int,textoIntegra:string,original:boolean,compilado:boolean,omitir:boolean,tachado:boolean,agendado:boolean,arquivoBinario:struct<idArquivoBinario:long>>"
HISTORY = "struct<idAto:long,idSegmento:long,idAnotacao:long,texto:string,dataInicioVigencia:string,dataRepublicacao:string,ehAgendamento:boolean,textoAgendamento:string>"
VIEW = f"idAto long, vigente boolean, visao string, dataPublicacao string, dataVigenciaInicio string, ehRepublicado string, ementas array<{SEGMENT}>, outrosSegmentos array<{SEGMENT}>, historico array<{HISTORY}>"


def _list(name: str, kind: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast(f"array<{kind}>"))


def all_segments() -> Column:
    """Abstracts, then other segments, each with whether it is an abstract and its place."""
    marked = F.concat(
        F.transform(_list("ementas", SEGMENT), lambda s: F.struct(s.alias("s"), F.lit(True).alias("ementa"))),
        F.transform(_list("outrosSegmentos", SEGMENT), lambda s: F.struct(s.alias("s"), F.lit(False).alias("ementa"))),
    )
    return F.transform(marked, lambda x, i: F.struct(F.coalesce(x["s"]["ordemSegmentoAto"], F.lit(0)).alias("ordem"), i.alias("lugar"), x["ementa"].alias("ementa"), x["s"].alias("s")))


def shown_segments() -> Column:
    """Segments that are shown, in the act's order; ties keep their place."""
    return F.array_sort(F.filter(all_segments(), lambda x: ~F.coalesce(x["s"]["omitir"], F.lit(False))))


def view_text() -> Column:
    """The shown text: paragraphs by empty lines, abstracts under their mark."""
    parts = F.transform(shown_segments(), lambda x: F.struct(x["ementa"].alias("e"), squeeze(x["s"]["textoIntegra"]).alias("t")))
    full = F.filter(parts, lambda x: x["t"] != "")
    return F.array_join(F.transform(full, lambda x: F.when(x["e"], F.concat(F.lit("## EMENTA\n"), x["t"])).otherwise(x["t"])), "\n\n")


def body_in_file() -> Column:
    """Whether a shown segment has its body only as an attached file."""
    return F.exists(shown_segments(), lambda x: x["s"]["arquivoBinario"].isNotNull() & (squeeze(x["s"]["textoIntegra"]) == ""))


def status() -> Column:
    changed = (F.size(_list("historico", HISTORY)) > 0) | F.exists(all_segments(), lambda x: F.coalesce(x["s"]["versaoSegmento"], F.lit(1)) > 1)
    return F.when(~F.coalesce("vigente", F.lit(False)), "nao_vigente").when(changed, "vigente_alterado").otherwise("vigente_nunca_alterado")


def texts(views: DataFrame) -> DataFrame:
    """(idAto, texto, sha256, status, corpo_em_arquivo) of each view."""
    return views.select("idAto", view_text().alias("texto"), status().alias("status"), body_in_file().alias("corpo_em_arquivo")).withColumn("sha256", F.sha2("texto", 256))


def segments(views: DataFrame) -> DataFrame:
    """All versions of all segments with their marks."""
    rows = views.select("idAto", F.explode(all_segments()).alias("x")).select(F.col("idAto").alias("ato_id"), "x.s").where("s.idSegmento is not null")

    def mark(name: str) -> Column:
        return F.coalesce(F.col(f"s.{name}"), F.lit(False))

    return rows.select(
        "ato_id", F.col("s.idSegmento").alias("id_segmento"), F.coalesce("s.versaoSegmento", F.lit(1)).alias("versao_segmento"), F.col("s.ordemSegmentoAto").alias("ordem"),
        F.col("s.idTipoSegmento").alias("id_tipo_segmento"), F.col("s.idAssunto").alias("id_assunto"), F.col("s.textoIntegra").alias("texto_integra"),
        mark("original").alias("is_original"), mark("compilado").alias("is_compilado"), mark("tachado").alias("is_tachado"), mark("omitir").alias("is_omitido"), mark("agendado").alias("is_agendado"),
    )


def history(views: DataFrame) -> DataFrame:
    """Change events of each view."""
    rows = views.select(F.col("idAto").alias("ato_alvo_id"), F.explode("historico").alias("h")).where("h.idSegmento is not null")
    return rows.select(
        "ato_alvo_id", F.col("h.idSegmento").alias("id_segmento_alvo"), F.col("h.idAto").alias("id_ato_modificador_portal"), date_dmy(F.col("h.dataInicioVigencia")).alias("data_inicio_vigencia"),
        date_dmy(F.col("h.dataRepublicacao")).alias("data_republicacao"), F.col("h.texto").alias("texto_anotacao"), F.col("h.idAnotacao").cast("int").alias("raw_anotacao_id"),
        F.coalesce("h.ehAgendamento", F.lit(False)).alias("eh_agendamento"), F.col("h.textoAgendamento").alias("texto_agendamento"),
    )


def load(views: DataFrame, tables: dict[str, DataFrame], run_id: str) -> dict[str, DataFrame]:
    """Next states of content, snapshots, segments, history, acts and collection after loading views, and the change log.

    All come from one reading of the views and are one unit: the caller publishes them together or not at all. A view
    that was loaded before changes nothing and logs nothing. Where ``tables`` has ``ato`` (id, status_vigencia,
    content_disponivel) and ``ato_coleta`` (ato_id, pdf_status, tentativas, origem), acts that got a text are flagged
    and take the view's status, and their collection is ``baixado`` from the portal; bodies in files stay open.
    """
    from actlens.operators import merge

    found = texts(views)
    content = found.select(F.col("idAto").alias("ato_id"), F.col("texto").alias("texto_completo"), F.length("texto").alias("caracteres"), F.lit("vigente").alias("tipo_versao"))
    snaps = found.select(F.col("idAto").alias("ato_id"), F.lit("multivigente").alias("visao"), "sha256", "texto")
    out = {}
    if "ato" in tables:
        state = found.select(F.col("idAto").alias("id"), F.col("status").alias("__s"), (has_text(F.col("texto")) & ~F.col("corpo_em_arquivo")).alias("__t"))
        acts = tables["ato"].join(state, "id", "left")
        flag = F.coalesce("content_disponivel", F.lit(False)) | F.coalesce("__t", F.lit(False))
        out["ato"] = acts.withColumns({"status_vigencia": F.coalesce("__s", "status_vigencia"), "content_disponivel": flag}).select(*tables["ato"].columns)
    if "ato_coleta" in tables:
        got = found.where(has_text(F.col("texto")) & ~F.col("corpo_em_arquivo")).select(F.col("idAto").alias("ato_id"), F.lit("baixado").alias("pdf_status"), F.lit(0).alias("tentativas"), F.lit("portal").alias("origem"))
        out["ato_coleta"] = merge.upsert(tables["ato_coleta"], got, ["ato_id"], {"tentativas": lambda old, new: old})
    next_content = merge.upsert(tables["ato_content"], content, ["ato_id", "tipo_versao"])
    return out | {
        "ato_content": next_content,
        "ato_texto_visao": merge.insert_missing(tables["ato_texto_visao"], snaps, ["ato_id", "visao", "sha256"]),
        "ato_segmento": merge.upsert(tables["ato_segmento"], segments(views), ["ato_id", "id_segmento", "versao_segmento"]),
        "ato_alteracao_historico": merge.insert_missing(tables["ato_alteracao_historico"], history(views), ["ato_alvo_id", "id_segmento_alvo", "raw_anotacao_id"]),
        "ato_mudanca": merge.change_log(tables["ato_content"], next_content, ["ato_id", "tipo_versao"], ["texto_completo"]).withColumn("run_id", F.lit(run_id)),
    }
