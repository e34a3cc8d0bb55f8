"""Hybrid search: a lexical and a vector branch, fused by rank, boosted and weighted.

The filter is given once and shared by both branches. Texts and vectors are read once, into term counts and a
similarity (``scored``), which can be done before tables are joined, so that neither is shuffled; the small rows are
written and both branches and the final ranking read those. Each branch keeps its best ``pool`` rows by a top-k, so
that no global sort and no unbounded window is needed; positions are numbered over those rows only.

A query of no terms has no lexical hits, and an empty vector no vector hits. Terms are values, never SQL text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actlens.functions import scoring, text, vector
from actlens.sources.scratch import Scratch

K1, B = 1.2, 0.75


def filters(themes: list[str] | None = None, kinds: list[str] | None = None, efficacy: list[str] | None = None, first: str | None = None, last: str | None = None, in_force_at: str | None = None, binding_at: str | None = None, allow_null_efficacy: bool = True) -> Column:
    """One predicate from optional parameters; what is not given, or is an empty list, does not filter."""
    last = last or in_force_at
    published = F.col("data_publicacao")
    parts = [F.lit(True)]
    parts += [F.col(c).isin(v) for c, v in (("tema_macro", themes), ("tipo_ato", kinds), ("eficacia_atual", efficacy)) if v]
    parts += [published >= F.lit(first).cast("date")] if first else []
    parts += [published <= F.lit(last).cast("date")] if last else []
    if binding_at:
        parts += [binding_window(published, binding_at), binding_efficacy(F.col("eficacia_atual"), allow_null_efficacy)]
    return reduce(lambda a, b: a & b, parts)


def binding_window(published: Column, at: str, months: int = 60) -> Column:
    """Published in the months up to a day, both ends included."""
    day = F.lit(at).cast("date")
    return published.between(F.add_months(day, -months), day)


def binding_efficacy(efficacy: Column, allow_null: bool = True) -> Column:
    binding = F.coalesce(efficacy.like("vinculante%"), F.lit(False))
    return efficacy.isNull() | binding if allow_null else binding


def numbered(rows: DataFrame, score: Column, key: str, pool: int) -> DataFrame:
    """The best ``pool`` rows with their positions; scores are rounded first, ties go by key."""
    best = rows.withColumn("__s", F.round(score, 9)).orderBy(F.col("__s").desc(), F.col(key)).limit(pool)
    return best.withColumn("pos", F.row_number().over(Window.orderBy(F.col("__s").desc(), F.col(key)))).drop("__s")


def scored(rows: DataFrame, terms: list[str] | None = None, body: str = "body", query: list[float] | None = None, vec: str = "embedding", analyse: Callable[[Column], Column] = text.tokens) -> DataFrame:
    """``rows`` with ``__n`` and ``__f0``.. (words and term frequencies) for ``body``, and ``__c`` (cosine) for ``vec``.

    ``analyse`` turns the body into terms; ``terms`` must be in its form. What is not asked for stays as it is.
    """
    out = rows
    if terms is not None:
        out = out.withColumn("__t", analyse(F.col(body)))
        counts = {f"__f{i}": F.size("__t") - F.size(F.array_remove("__t", F.lit(t))) for i, t in enumerate(terms)}
        out = out.withColumns({"__n": F.size("__t"), **counts}).drop("__t", body)
    if query is not None:
        out = out.withColumn("__c", vector.cosine_to(F.col(vec), query) if query else F.lit(None).cast("double")).drop(vec)
    return out


def lexical(rows: DataFrame, terms: list[str], key: str, body: str, pool: int, analyse: Callable[[Column], Column] = text.tokens) -> DataFrame:
    """(key, pos) of rows that hold all terms, by BM25; statistics are over all given rows. See ``scored``."""
    return lexical_positions(scored(rows.select(key, body), terms, body, analyse=analyse), len(terms), key, pool)


def lexical_positions(counted: DataFrame, terms: int, key: str, pool: int) -> DataFrame:
    """(key, pos) from the counts of ``scored``; the only exchange is one row of sums."""
    if not terms:
        return counted.select(key, F.lit(1).alias("pos")).limit(0)
    stats = counted.agg(F.count("*").alias("__docs"), F.avg("__n").alias("__avg"), *[F.count_if(F.col(f"__f{i}") > 0).alias(f"__d{i}") for i in range(terms)])
    both = counted.where(reduce(lambda a, b: a & b, [F.col(f"__f{i}") > 0 for i in range(terms)])).join(F.broadcast(stats))  # one row

    def part(i: int) -> Column:
        f, d = F.col(f"__f{i}"), F.col(f"__d{i}")
        idf = F.log(F.lit(1.0) + (F.col("__docs") - d + 0.5) / (d + 0.5))
        return idf * f * (K1 + 1) / (f + K1 * (F.lit(1 - B) + F.lit(B) * F.col("__n") / F.col("__avg")))

    return numbered(both, reduce(lambda a, b: a + b, [part(i) for i in range(terms)]), key, pool).select(key, "pos")


def nearest(rows: DataFrame, query: list[float], key: str, vec: str, pool: int) -> DataFrame:
    """(key, pos) by exact cosine similarity; rows without a vector are left out."""
    return nearest_positions(scored(rows.select(key, vec), query=query, vec=vec), key, pool)


def nearest_positions(near: DataFrame, key: str, pool: int) -> DataFrame:
    return numbered(near.select(key, "__c").where("__c is not null"), F.col("__c"), key, pool).select(key, "pos")


def fused(lexical_rows: DataFrame, vector_rows: DataFrame, key: str) -> DataFrame:
    """(key, rrf): full outer join of two ranked branches."""
    both = lexical_rows.withColumnRenamed("pos", "__l").join(vector_rows.withColumnRenamed("pos", "__v"), [key], "full_outer")
    return both.select(key, (scoring.reciprocal(F.col("__l")) + scoring.reciprocal(F.col("__v"))).alias("rrf"))


def landmark_boost(provisions: DataFrame, key: str = "materia_id", weights: dict[str, float] = scoring.LANDMARK) -> DataFrame:
    """(key, boost): sum of weights of the landmark rulings that a matter cites."""
    return provisions.groupBy(key).agg(F.sum(scoring.lookup(F.col("tipo_norma"), weights, 0.0)).alias("boost"))


def hybrid(rows: DataFrame, terms: list[str], query: list[float], weight: Column, boost: DataFrame | None = None, key: str = "id", body: str = "body", vec: str = "embedding", limit: int = 15, predicate: Column | None = None) -> DataFrame:
    """(key, score, ...): ``rows`` ranked by fused rank times ``weight`` plus boost.

    ``weight`` is an expression over the row's columns: nature x secondary x status x recency. ``rows`` have text and
    vector, or what ``scored`` made of them.
    """
    pool = max(limit * 6, 80)
    kept = rows.where(predicate) if predicate is not None else rows
    kept = scored(kept, None if "__n" in rows.columns else terms, body, None if "__c" in rows.columns else query, vec)
    held = Scratch(rows.sparkSession, "search").put(kept)
    counts = [c for c in held.columns if c.startswith("__")]
    ranks = fused(lexical_positions(held, len(terms), key, pool), nearest_positions(held, key, pool), key)
    top = ranks.orderBy(F.round("rrf", 9).desc(), key).limit(pool)
    out = held.drop(*counts).join(F.broadcast(top), key)  # at most 2 x pool rows
    if boost is not None:
        out = out.join(boost.withColumnRenamed(boost.columns[0], key), key, "left")
    score = F.col("rrf") * weight + (F.coalesce("boost", F.lit(0.0)) if boost is not None else F.lit(0.0))
    return out.withColumn("score", F.round(score, 6)).orderBy(F.desc("score"), key).limit(limit)


def multi_query(rows: DataFrame, queries: list[tuple[int, list[float]]], key: str, group: str, vec: str, per_query: int, limit: int) -> DataFrame:
    """(group, score): the best similarity of each group over several queries' top rows; only positive ones count."""
    each = []
    sims = Scratch(rows.sparkSession, "queries").put(rows.select(key, group, *[F.round(vector.cosine_to(F.col(vec), q), 9).alias(f"__s{i}") for i, (_, q) in enumerate(queries)]))
    for i, (number, _) in enumerate(queries):
        near = sims.select(key, group, F.col(f"__s{i}").alias("sim")).where("sim is not null")
        each.append(near.orderBy(F.desc("sim"), key).limit(per_query).withColumn("q", F.lit(number)))
    found = reduce(DataFrame.unionAll, each).where("sim > 0")
    return found.groupBy(group).agg(F.max("sim").alias("score"), F.countDistinct("q").alias("queries")).orderBy(F.desc("score"), group).limit(limit)


def facets(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimension, value, n) of several columns in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions])).alias("p")
    return rows.select(pairs).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))
