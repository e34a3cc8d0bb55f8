"""Model replies to matters: extraction, checks, row sets, merging of parts, reports and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.functions.text import fold, has_text, html_paragraphs, null_if_empty

PROVISION = "struct<tipo_norma:string,referencia:string,dispositivo:string,texto_resumido:string,tipo_uso:string>"
EXTERNAL = "struct<tipo_fonte:string,referencia:string,texto_resumido:string>"
OWN = "struct<artigo:string,paragrafo:string,inciso:string,alinea:string,texto_resumido:string>"
MATTER = f"struct<ordem:int,natureza:string,tema_macro:string,tema_especifico:string,subtema:string,tags:array<string>,tributos:array<struct<codigo:string,regime:string>>,dispositivos:array<{PROVISION}>,fundamentacao_externa:array<{EXTERNAL}>,dispositivos_do_ato:array<{OWN}>,cnaes_aplicaveis:array<struct<codigo:string,descricao:string,relevancia:string,confianca:string>>,ementa_trecho:string,fato_consultado:string,solucao:string,fundamentacao_resumo:string,resultado:string>"
REPLY = f"struct<ato_metadata:struct<eficacia:string,abrangencia:string,norma_base_regulamentada:array<struct<referencia:string>>>,materias:array<{MATTER}>>"


def json_object(reply: Column) -> Column:
    """The JSON object in a reply: from the first brace to the last, null if there is none."""
    first = F.instr(reply, "{")
    last = F.length(reply) - F.instr(F.reverse(reply), "}") + 1
    return F.when((first > 0) & (F.instr(reply, "}") > 0) & (last >= first), F.substring(reply, first, last - first + 1))


def parsed(rows: DataFrame, reply_col: str) -> DataFrame:
    """Rows with ``saida`` (typed reply) and ``erros`` (structural faults, empty if none)."""
    text = json_object(F.col(reply_col))
    valid = F.try_parse_json(text).isNotNull()
    listed = F.schema_of_variant(F.try_parse_json(F.get_json_object(text, "$.materias"))).startswith("ARRAY")
    out = rows.withColumn("saida", F.from_json(text, REPLY))

    def lacking(test) -> Column:
        return F.exists(F.coalesce(F.col("saida.materias"), F.array().cast(f"array<{MATTER}>")), test)

    faults = F.array(
        F.when(text.isNull() | ~F.coalesce(valid, F.lit(False)), "sem objeto JSON"),
        F.when(text.isNotNull() & valid & ~F.coalesce(listed, F.lit(False)), "materias ausente"),
        F.when(lacking(lambda m: ~(has_text(m["tema_macro"]) | has_text(m["tema_especifico"]))), "materia sem tema"),
        F.when(lacking(lambda m: ~(has_text(m["solucao"]) | has_text(m["ementa_trecho"]) | has_text(m["fundamentacao_resumo"]))), "materia sem solucao"),
    )
    return out.withColumn("erros", F.array_compact(faults))


def merged(parts: DataFrame, key: str = "ato_id") -> DataFrame:
    """Per act: matters of all parts in order, first efficacy and scope, divergences and parts without matters.

    ``parts`` has (key, parte, saida).
    """
    order = F.sort_array(F.collect_list(F.struct("parte", "saida")))
    rows = parts.groupBy(key).agg(order.alias("p"))

    def seen(field: str) -> Column:
        return F.array_distinct(F.filter(F.transform("p", lambda x: x["saida"]["ato_metadata"][field]), lambda v: has_text(v)))

    out = rows.select(key, F.flatten(F.filter(F.transform("p", lambda x: x["saida"]["materias"]), lambda m: m.isNotNull())).alias("materias"), seen("eficacia").alias("e"), seen("abrangencia").alias("a"), F.transform(F.filter("p", lambda x: F.coalesce(F.size(x["saida"]["materias"]), F.lit(0)) < 1), lambda x: x["parte"]).alias("partes_sem_materia"))
    return out.select(key, "materias", F.get("e", F.lit(0)).alias("eficacia"), F.get("a", F.lit(0)).alias("abrangencia"), F.when(F.size("e") > 1, F.col("e")).alias("divergencia_eficacia"), F.when(F.size("a") > 1, F.col("a")).alias("divergencia_abrangencia"), "partes_sem_materia")


def matter_rows(acts: DataFrame, aliases: DataFrame, key: str = "ato_id") -> dict[str, DataFrame]:
    """Four row sets (materia, tributo, dispositivo, cnae) of merged acts, with normalised values."""
    from actlens.operators.normalize import normalized

    m = acts.select(key, F.posexplode("materias").alias("i", "m")).withColumn("ordem", F.col("i") + 1).drop("i")
    base = m.select(key, "ordem", *[F.col(f"m.{c}").alias(c) for c in ("natureza", "tema_macro", "tema_especifico", "subtema", "ementa_trecho", "fato_consultado", "solucao", "fundamentacao_resumo", "resultado", "tags")])
    matters = normalized(base, "tema_macro", "temas_macro", aliases, "tema_canonico").withColumn("tema_macro", F.coalesce("tema_canonico", F.lit("__NOVO_TEMA"))).drop("tema_canonico")
    taxes = m.select(key, "ordem", F.explode("m.tributos").alias("t")).select(key, "ordem", F.col("t.codigo").alias("codigo"), F.col("t.regime").alias("r"))
    taxes = normalized(normalized(taxes, "codigo", "tributos", aliases, "tributo_codigo"), "r", "regimes_tributarios", aliases, "regime").where("tributo_codigo is not null").select(key, "ordem", "tributo_codigo", "regime").distinct()
    cited = m.select(key, "ordem", F.explode("m.dispositivos").alias("d")).select(key, "ordem", "d.*")
    outside = m.select(key, "ordem", F.explode("m.fundamentacao_externa").alias("d")).select(key, "ordem", F.col("d.tipo_fonte").alias("tipo_norma"), "d.referencia", F.lit(None).cast("string").alias("dispositivo"), "d.texto_resumido", F.lit("fundamentacao_externa").alias("tipo_uso"))
    own = m.select(key, "ordem", F.explode("m.dispositivos_do_ato").alias("d")).select(key, "ordem", F.lit(None).cast("string").alias("tipo_norma"), F.lit(None).cast("string").alias("referencia"), article_label(F.col("d")).alias("dispositivo"), "d.texto_resumido", F.lit("dispositivo_do_ato").alias("tipo_uso"))
    provisions = normalized(cited, "tipo_norma", "tipo_norma", aliases, "n").withColumn("tipo_norma", F.coalesce("n", "tipo_norma")).drop("n").unionByName(outside).unionByName(own)
    cnaes = m.select(key, "ordem", F.explode("m.cnaes_aplicaveis").alias("c")).select(key, "ordem", F.col("c.codigo").alias("cnae_codigo"), "c.descricao", "c.relevancia", "c.confianca").where(has_text(F.col("cnae_codigo"))).dropDuplicates([key, "ordem", "cnae_codigo"])
    return {"ato_materia": matters, "materia_tributo": taxes, "materia_dispositivo": provisions, "materia_cnae": cnaes}


def article_label(d: Column) -> Column:
    """art. 3º, § 1º, II, a"""
    number = F.when(d["artigo"].rlike(r"^\s*\d+"), F.concat(F.lit("art. "), F.trim(d["artigo"]))).otherwise(null_if_empty(F.trim(d["artigo"])))
    para = F.when(d["paragrafo"].rlike(r"^\s*\d+"), F.concat(F.lit("§ "), F.trim(d["paragrafo"]))).otherwise(null_if_empty(F.trim(d["paragrafo"])))
    return F.concat_ws(", ", number, para, null_if_empty(F.trim(d["inciso"])), null_if_empty(F.trim(d["alinea"])))


def article_numbers(text: Column) -> Column:
    """Distinct article numbers that begin a paragraph of a text."""
    blocks = F.split(html_paragraphs(text), "\n\n")
    return F.array_distinct(F.array_compact(F.transform(blocks, lambda b: article_number(F.when(b.rlike(r"(?i)^Art\.\s*\d"), b)))))


def article_number(label: Column) -> Column:
    """12 or 12-a out of a label; null if it has no number."""
    pattern = r"(?i)^\s*(?:art(?:igo)?\.?\s*)?(\d+)\s*[ºo°]?\s*(?:-\s*([a-z])\b)?"
    number, letter = F.regexp_extract(label, pattern, 1), F.regexp_extract(label, pattern, 2)
    return F.when(number != "", F.concat(number, F.when(letter != "", F.concat(F.lit("-"), F.lower(letter))).otherwise("")))


def plain(text: Column) -> Column:
    """Folded, lower-case, one blank between words and at both ends."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(fold(F.coalesce(text, F.lit("")))), r"\s+", " "), F.lit(" "))


def anchoring(matters: DataFrame, texts: DataFrame, names: dict[str, list[str]], regimes: dict[str, list[str]], key: str = "ato_id") -> DataFrame:
    """Matters with ``problemas``: taxes whose names do not occur in the text, and mostly unknown law numbers.

    ``matters`` has (key, ordem, tributos, referencias); a composite regime in the text anchors its taxes.
    """
    rows = matters.join(texts.select(key, plain(F.col("texto")).alias("__p")), key)
    rows = rows.withColumn("__d", F.regexp_replace("__p", r"\D", ""))
    by_regime = F.flatten(F.array_compact(F.array(*[F.when(F.contains(F.col("__p"), F.lit(r)), F.array(*[F.lit(t) for t in ts])) for r, ts in regimes.items()], F.array().cast("array<string>"))))
    named = {t: reduce(lambda a, b: a | b, [F.contains(F.col("__p"), F.lit(n)) for n in ns]) for t, ns in names.items()}
    absent = F.array_compact(F.array(*[F.when(F.array_contains(F.coalesce("tributos", F.array().cast("array<string>")), t) & ~hit & ~F.array_contains("__r", t), F.lit(f"tributo {t} não aparece no texto")) for t, hit in named.items()], F.lit(None).cast("string")))
    numbers = F.filter(F.transform(F.coalesce("referencias", F.array().cast("array<string>")), lambda r: F.replace(F.regexp_extract(r, r"(\d{1,3}(?:\.\d{3})+|\d{3,6})", 1), F.lit("."), F.lit(""))), lambda n: n != "")
    rows = rows.withColumn("__r", by_regime).withColumn("__n", numbers)
    outside = F.size(F.filter("__n", lambda n: ~F.contains(F.col("__d"), n)))
    wrong = F.when((F.size("__n") > 0) & (outside / F.size("__n") > 0.5), F.concat(outside.cast("string"), F.lit(" de "), F.size("__n").cast("string"), F.lit(" normas citadas não aparecem no texto")))
    return rows.withColumn("problemas", F.concat(absent, F.array_compact(F.array(wrong)))).drop("__p", "__d", "__r", "__n")


def quality_report(matters: DataFrame, texts: DataFrame, key: str = "ato_id") -> DataFrame:
    """One row per act: matters, without solution or tax, off the taxonomy, repeated themes, unanchored, article coverage.

    ``matters`` has (key, ordem, tema_macro, tema_especifico, solucao, tributos, artigos, problemas).
    """
    themes = matters.where("tema_especifico is not null").groupBy(key, "tema_especifico").count().where("count > 1").groupBy(key).agg(F.count("*").alias("temas_repetidos"))
    cited = matters.select(key, F.explode("artigos").alias("a")).select(key, article_number(F.col("a")).alias("n")).groupBy(key).agg(F.collect_set("n").alias("citados"))
    counts = matters.groupBy(key).agg(
        F.count("*").alias("materias"), F.count_if(~has_text(F.col("solucao"))).alias("sem_solucao"), F.count_if(F.coalesce(F.size("tributos"), F.lit(0)) < 1).alias("sem_tributo"),
        F.count_if(F.col("tema_macro") == "__NOVO_TEMA").alias("fora_da_taxonomia"), F.count_if(F.size("problemas") > 0).alias("desancoradas"),
    )
    out = texts.select(key, article_numbers(F.col("texto")).alias("t")).join(counts, key, "left").join(themes, key, "left").join(cited, key, "left")
    out = out.withColumn("artigos_no_texto", F.size("t")).withColumn("artigos_citados", F.coalesce(F.size(F.array_intersect("t", F.coalesce("citados", F.array().cast("array<string>")))), F.lit(0)))
    zero = {c: 0 for c in ("materias", "sem_solucao", "sem_tributo", "fora_da_taxonomia", "desancoradas", "temas_repetidos")}
    return out.fillna(zero).withColumn("cobertura_artigos", F.round(F.col("artigos_citados") / F.nullif(F.col("artigos_no_texto"), F.lit(0)), 3)).drop("t", "citados")


def gate(report: DataFrame) -> DataFrame:
    """Reports with ``motivos``: why an act goes to review; empty means that it may be written."""

    def over(c: str, share: float) -> Column:
        return (F.col("materias") > 0) & (F.col(c) / F.col("materias") > share)

    empty = F.coalesce(F.size("partes_sem_materia"), F.lit(0)) > 0 if "partes_sem_materia" in report.columns else F.lit(False)
    reasons = F.array(
        F.when(empty, "partes sem matéria"),
        F.when(over("fora_da_taxonomia", 0.5), "fora da taxonomia"),
        F.when(over("sem_solucao", 0.2), "sem solução"),
        F.when((F.col("artigos_no_texto") >= 20) & (F.coalesce("cobertura_artigos", F.lit(0.0)) < 0.8), "cobertura de artigos"),
        F.when(over("desancoradas", 0.2), "sem âncora"),
    )
    return report.withColumn("motivos", F.array_compact(reasons))


def result_state(gated: DataFrame) -> DataFrame:
    """gravado, revisao, vazio or erro."""
    failed = F.col("erro").isNotNull() if "erro" in gated.columns else F.lit(False)
    return gated.withColumn("estado", F.when(failed, "erro").when(F.col("materias") == 0, "vazio").when(F.size("motivos") > 0, "revisao").otherwise("gravado"))


def exit_code(results: DataFrame) -> int:
    """1 if any result failed or lacks a sign or vector that it was to have (columns erro, sem_sinal, sem_vetor), else 0."""
    bad = [F.col("erro").isNotNull() & (F.col("erro") != "")] if "erro" in results.columns else []
    bad += [F.coalesce(F.col(c), F.lit(False)) for c in ("sem_sinal", "sem_vetor") if c in results.columns]
    return int(bool(bad) and not results.where(reduce(lambda a, b: a | b, bad)).isEmpty())


def prompt(text: Column, label: Column, total: Column, path: Column, abstract_only: Column) -> Column:
    """The user message of a part: fragment header, warning for abstracts, then the text."""
    head = F.when(total > 1, F.concat(F.lit("Parte "), label, F.lit(" de "), total.cast("string"), F.when(path != "", F.concat(F.lit(" — "), path)).otherwise(""), F.lit("\n\n"))).otherwise("")
    warn = F.when(abstract_only, F.lit("Só a ementa está disponível; não infira o corpo do ato.\n\n")).otherwise("")
    return F.concat(head, warn, F.lit("<texto>\n"), text, F.lit("\n</texto>"))


def embedding_text(fields: list[Column], joiner: str = " || ", size: int = 6000, fallback: str = "(sem texto)") -> Column:
    """Non-empty fields joined and cut, or a fallback."""
    return F.coalesce(null_if_empty(F.left(F.concat_ws(joiner, *[null_if_empty(F.trim(f)) for f in fields]), F.lit(size))), F.lit(fallback))


def cost(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float, cached: Column | None = None, batch: bool = False) -> Column:
    """Cost in dollars: prices per million tokens, cached input at a tenth, batches at half."""
    held = cached if cached is not None else F.lit(0)
    total = ((tokens_in - held) * price_in + held * price_in * 0.1 + tokens_out * price_out) / 1e6
    return total * 0.5 if batch else total


def schema_faults(payload: Column, schema: dict) -> Column:
    """Faults of a JSON object under the required, enum and additionalProperties rules of a schema."""
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    faults = [F.when(~F.array_contains(keys, k), f"falta {k}") for k in schema.get("required", [])]
    for name, rule in schema.get("properties", {}).items():
        if "enum" in rule:
            value = F.get_json_object(payload, f"$.{name}")
            faults.append(F.when(value.isNotNull() & ~value.isin([str(v) for v in rule["enum"] if v is not None]), f"valor de {name}"))
    if schema.get("additionalProperties") is False:
        extra = F.array_except(keys, F.array(*[F.lit(k) for k in schema.get("properties", {})]))
        faults.append(F.when(F.size(extra) > 0, F.concat(F.lit("campo a mais: "), F.array_join(extra, ","))))
    return F.array_compact(F.array(*faults, F.lit(None).cast("string")))
