"""Dossiers: several pattern queries merged by act, classified and set in sections; acts with all that hangs on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.functions.text import keyword_class, truncated


def pattern_query(patterns: list[str], column: str, mode: str = "any") -> Column:
    """Case-blind patterns over a column, any or all of which must match."""
    parts = [F.col(column).ilike(p) for p in patterns]
    return reduce((lambda a, b: a | b) if mode == "any" else (lambda a, b: a & b), parts)


def compiled(rows: DataFrame, queries: dict[str, Column], key: list[str], body: str, forbids: list[str], allows: list[str]) -> DataFrame:
    """(key, consultas, n, classe): rows that any query finds, one per key, in a single scan."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in queries.items()], F.lit(None).cast("string")))
    found = rows.withColumn("__q", names).where(F.size("__q") > 0)
    out = found.groupBy(*key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("__q")))).alias("q"), F.count("*").alias("n"), F.max_by(F.col(body), F.col(body)).alias("__b"))
    return out.select(*key, F.array_join("q", ",").alias("consultas"), "n", keyword_class(F.col("__b"), forbids, allows).alias("classe"))


def consolidated(acts: DataFrame, matters: DataFrame, taxes: DataFrame, provisions: DataFrame, relations: DataFrame, wanted: list[int], per_act: int = 8) -> DataFrame:
    """One document per wanted act: matters with their taxes and provisions, and its first relations."""
    from actlens.operators.relations import one_hop

    few = acts.where(F.col("id").isin(wanted))
    m = matters.join(few.select(F.col("id").alias("ato_id")), "ato_id", "left_semi")
    t = taxes.groupBy("materia_id").agg(F.sort_array(F.collect_set("tributo_codigo")).alias("tributos"))
    p = provisions.groupBy("materia_id").agg(F.sort_array(F.collect_list(F.struct("tipo_norma", "referencia", "dispositivo"))).alias("dispositivos"))
    full = m.join(t, F.col("id") == t["materia_id"], "left").drop("materia_id").join(p, F.col("id") == p["materia_id"], "left").drop("materia_id")
    listed = full.groupBy("ato_id").agg(F.sort_array(F.collect_list(F.struct("ordem", "tema_especifico", "solucao", "tributos", "dispositivos"))).alias("materias"))
    linked = one_hop(relations, acts, per_act)
    return few.join(listed, few["id"] == listed["ato_id"], "left").drop("ato_id").join(linked, few["id"] == linked["ato"], "left").drop("ato")


def context(documents: DataFrame, title: str, body: str, size: int, total: int) -> DataFrame:
    """(contexto): one text of all documents in order of id, each cut to ``size``, the whole to ``total`` characters.

    A line takes seven characters at least, so that no more than the first total / 7 documents can be seen; only
    those are gathered. Documents without a title or a body are left out.
    """
    part = F.concat(F.lit("### "), F.col(title), F.lit("\n"), truncated(F.col(body), size))
    first = documents.select("id", part.alias("t")).where("t is not null").orderBy("id", "t").limit(total // 7 + 1)
    lines = first.groupBy().agg(F.sort_array(F.collect_list(F.struct("id", "t"))).alias("l"))
    return lines.select(F.left(F.array_join(F.transform("l", lambda x: x["t"]), "\n\n"), F.lit(total)).alias("contexto"))


def synthesis(reports: DataFrame, name: str, body: str) -> DataFrame:
    """(pedido): all theme reports in order of name as one request."""
    return reports.groupBy().agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(name, body))), lambda x: F.concat(F.lit("## "), x[name], F.lit("\n"), x[body])), "\n\n").alias("pedido"))
