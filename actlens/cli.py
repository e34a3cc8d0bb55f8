"""Command line over a folder of Parquet tables. Every verb shows its result; nothing is written without ``--write``.

    python -m actlens.cli list
    python -m actlens.cli query NAME --data DIR
    python -m actlens.cli search TERM... --like MATTER --mode pratico --in-force-at 2020-01-01 --data DIR
    python -m actlens.cli facets COLUMN... | timeline THEME | conflicts [--theme T] [--limit-sim 0.85] [--clear]
    python -m actlens.cli audit [--type T] [--years 2000 2020] [--focus ID...] | backfill [--limit N]
    python -m actlens.cli pending | batches | routine [--plan | --check DAY | --panel]

The verbs after ``query`` read the logical tables of ``actlens.schema``, one folder each.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actlens.functions import scoring, text
from actlens.operators import conflicts, coverage, queues, runs, search, temporal
from actlens.plans import registry
from actlens.sources import tables


def matters(spark: SparkSession, data: str) -> DataFrame:
    """Matters with their acts: what search, timeline and conflicts read."""
    acts = tables.read_table(spark, data, "ato").select(F.col("id").alias("ato_id"), "tipo_ato", "emissor", "numero", "ano", "data_publicacao", "eficacia_atual", "status_vigencia")
    return tables.read_table(spark, data, "ato_materia").join(acts, "ato_id")


def run_search(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    rows = matters(spark, given.data)
    body = F.concat_ws(" ", "ementa_trecho", "fato_consultado", "solucao", "fundamentacao_resumo", "tema_especifico")
    rows = rows.select("id", "ato_id", "tipo_ato", "emissor", "numero", "ano", "tema_macro", "data_publicacao", "eficacia_atual", "status_vigencia", "embedding", body.alias("body"))
    like = rows.where(F.col("id") == given.like).select("embedding").first() if given.like is not None else None
    vector = [float(x) for x in like[0]] if like and like[0] else []
    terms = [r for r in spark.range(1).select(text.portuguese_terms(F.lit(" ".join(given.terms))).alias("t")).first()["t"]]
    nature = F.when(F.col("tipo_ato").isin("SOLUCAO_CONSULTA", "SOLUCAO_DIVERGENCIA", "SOLUCAO_CONSULTA_INTERNA"), "consultiva").when(F.col("tipo_ato").isin("INSTRUCAO_NORMATIVA", "DECRETO", "PARECER_NORMATIVO"), "normativa").otherwise("operacional")
    weight = scoring.lookup(nature, scoring.MODES[given.mode]) * scoring.secondary(nature, F.col("tipo_ato"), F.col("emissor")) * scoring.lookup(F.col("status_vigencia"), scoring.STATUS) * scoring.decay(F.col("data_publicacao"), given.as_of)
    predicate = search.filters(given.theme, given.type, given.efficacy, given.first, given.last, given.in_force_at, given.binding_at)
    boost = search.landmark_boost(tables.read_table(spark, given.data, "materia_dispositivo"))
    kept = search.scored(rows.where(predicate), terms, "body", vector, "embedding", text.portuguese_terms)
    return search.hybrid(kept, terms, vector, weight, boost, limit=given.limit)


def run_facets(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    return search.facets(matters(spark, given.data), given.columns).orderBy("dimension", F.desc("n"), "value")


def run_timeline(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    rows = matters(spark, given.data).where((F.col("tema_macro") == given.theme) | (F.col("tema_especifico") == given.theme))
    named = rows.select("id", "ato_id", "tipo_ato", "numero", F.col("data_publicacao").alias("data"), F.col("eficacia_atual").alias("eficacia"), "sinal", "solucao")
    return temporal.timeline(named, given.binding_at)


def run_conflicts(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    """Conflicts found now; with --write the table of conflicts after an upsert, or after --clear."""
    if given.clear:
        return conflicts.cleared(tables.read_table(spark, given.data, "conflito_temporal"), "tema_especifico", given.theme)
    rows = matters(spark, given.data).withColumn("theme", F.col("tema_especifico"))
    rows = rows.where(F.col("theme").isin(given.theme)) if given.theme else rows
    able = conflicts.eligible(rows, F.col("sinal"), ["SOLUCAO_CONSULTA", "SOLUCAO_DIVERGENCIA", "SOLUCAO_CONSULTA_INTERNA"], "tipo_ato", "eficacia_atual", "solucao")
    edges = tables.read_table(spark, given.data, "ato_relacao").select(F.col("ato_origem_id").alias("origem"), F.col("ato_destino_id").alias("destino"))
    found = conflicts.conflicts(able.select("id", F.col("ato_id").alias("ato"), "theme", F.col("data_publicacao").alias("data"), "sinal", "embedding"), edges, given.limit_sim)
    return found if not given.review else conflicts.to_review(found, given.limit)


def flagged(spark: SparkSession, data: str) -> DataFrame:
    return coverage.flags(*(tables.read_table(spark, data, n) for n in ("ato", "ato_content", "ato_materia", "ato_coleta")))


def run_audit(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    rows = flagged(spark, given.data)
    rows = rows.where(F.col("tipo_ato").isin(given.type)) if given.type else rows
    rows = rows.where(F.col("ano").between(*given.years)) if given.years else rows
    if given.focus:
        return coverage.focus(rows, given.focus).select("id", "existe", "estagio")
    return coverage.breakdown(rows, given.by) if given.by else coverage.defect_counts(rows)


def run_backfill(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    acts, contents, coleta = (tables.read_table(spark, given.data, n) for n in ("ato", "ato_content", "ato_coleta"))
    return queues.retry_queue(acts, contents, coleta, f"{given.as_of} 00:00:00", given.limit, given.type, given.years[0] if given.years else None).select("id", "tipo_ato", "numero", "ano", "data_publicacao", "tentativas")


def run_pending(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    acts, contents, found = (tables.read_table(spark, given.data, n) for n in ("ato", "ato_content", "ato_materia"))
    return queues.pending(acts, contents, found, kinds=given.type).select("id", "tipo_ato", "numero", "ano", "data_publicacao")


def run_batches(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    """Batch manifests by state, from the folder ``lote``."""
    return spark.read.parquet(f"{given.data}/lote").groupBy("estado").agg(F.count("*").alias("lotes")).orderBy("estado")


def run_routine(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    log = tables.read_table(spark, given.data, "rotina_execucao")
    if given.check:
        return runs.late(log, given.check).join(runs.needs_second_attempt(log, given.check))  # one row each
    if given.plan:
        return coverage.funnel(flagged(spark, given.data))
    return runs.numbers(log)


def run_query(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    return registry.queries()[given.name](spark, given.data)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="actlens", description=__doc__.split("\n")[0])
    verbs = out.add_subparsers(dest="verb", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--data", default=".", help="folder of the tables")
    common.add_argument("--write", help="folder to write the whole result to")
    common.add_argument("--explain", action="store_true", help="print the plan and stop")
    common.add_argument("--rows", type=int, default=20, help="rows to print")
    common.add_argument("--limit", type=int, default=15)
    common.add_argument("--as-of", default=date.today().isoformat(), help="the day that counts as today")
    common.add_argument("--type", action="append", help="act type, may be repeated")
    common.add_argument("--years", type=int, nargs=2)

    def verb(name: str, run, text: str) -> argparse.ArgumentParser:
        made = verbs.add_parser(name, parents=[common], help=text)
        made.set_defaults(run=run)
        return made

    verbs.add_parser("list", help="names of registered queries")
    verb("query", run_query, "a registered query").add_argument("name", choices=sorted(registry.queries()))
    found = verb("search", run_search, "hybrid search")
    found.add_argument("terms", nargs="*")
    found.add_argument("--like", type=int, help="a matter whose vector is searched with")
    found.add_argument("--mode", choices=sorted(scoring.MODES), default="pratico")
    for name in ("--theme", "--efficacy"):
        found.add_argument(name, action="append")
    for name in ("--first", "--last", "--in-force-at", "--binding-at"):
        found.add_argument(name)
    verb("facets", run_facets, "counts by columns").add_argument("columns", nargs="+")
    line = verb("timeline", run_timeline, "the matters of a theme in order of time")
    line.add_argument("theme")
    line.add_argument("--binding-at")
    pairs = verb("conflicts", run_conflicts, "opposite matters of a theme")
    pairs.add_argument("--theme", action="append")
    pairs.add_argument("--limit-sim", type=float, default=0.85)
    pairs.add_argument("--review", action="store_true", help="only those to be looked at first")
    pairs.add_argument("--clear", action="store_true", help="the table of conflicts without those of the themes")
    audit = verb("audit", run_audit, "defects of the collection")
    audit.add_argument("--focus", type=int, nargs="+")
    audit.add_argument("--by", help="a column to break acts without text down by")
    verb("backfill", run_backfill, "acts whose text is to be fetched next")
    verb("pending", run_pending, "acts that wait for analysis")
    verb("batches", run_batches, "batches by state")
    routine = verb("routine", run_routine, "runs of the routine")
    routine.add_argument("--plan", action="store_true", help="what there is to do")
    routine.add_argument("--check", metavar="DAY", help="whether the routine is late, and must run again on a day")
    routine.add_argument("--panel", action="store_true", help="the last runs (default)")
    return out


def main(args: list[str] | None = None) -> int:
    given = parser().parse_args(args)
    if given.verb == "list":
        print("\n".join(sorted(registry.queries())))
        return 0
    spark = SparkSession.builder.appName("actlens").getOrCreate()
    df = given.run(spark, given)
    if given.explain:
        df.explain("formatted")
    elif given.write:
        df.write.mode("errorifexists").parquet(given.write)
    else:
        df.show(given.rows, truncate=60)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
