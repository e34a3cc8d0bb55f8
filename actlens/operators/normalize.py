"""Canonical values of vocabularies: an alias table joined on a folded key.

The vocabulary is a parameter, read from a JSON file of sections (taxes, macro themes, regimes, norm types, relation
types, uses, natures, results, sectors...) with ``_canonicos``, ``_aliases``, ``_realocar`` and ``_rejeitar_valores``.
Later entries win over earlier ones, rejected values over all.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actlens.functions.text import first_separator_split, fold_key
from actlens.operators import merge

#: Separators of composite values, in order of trial.
SEPARATORS = ["/", " e ", " E ", " AND ", " and ", "&", " + ", "+", " - ", "_E_"]


def read_vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def alias_entries(section: dict) -> list[tuple[str, str | None]]:
    """(alias, canonical) in order of precedence, last wins; rejected values are null. Notes (keys with _) are left out."""
    moved = section.get("_realocar") or section.get("_realocar_de_tributo_para_tema") or {}
    found: list[tuple[str, str | None]] = [(alias, canonical) for alias, canonical in moved.items() if not alias.startswith("_")]
    found += [(c, c) for c in section.get("_canonicos", [])]
    found += [(alias, c) for c, aliases in (section.get("_aliases") or {}).items() if not c.startswith("_") for alias in aliases]
    return found + [(r, None) for r in section.get("_rejeitar_valores", [])]


def alias_table(spark: SparkSession, vocabulary: dict) -> DataFrame:
    """(section, chave, canonico): one row per folded key, the last entry of a section winning."""
    rows = [(s, n, a, c) for s, body in vocabulary.items() if isinstance(body, dict) for n, (a, c) in enumerate(alias_entries(body))]
    df = spark.createDataFrame(rows, "section string, n int, alias string, canonico string")
    return df.groupBy("section", fold_key(F.col("alias")).alias("chave")).agg(F.max_by(F.struct("canonico"), "n").alias("c")).select("section", "chave", F.col("c.canonico").alias("canonico"))


def normalized(rows: DataFrame, column: str, section: str, aliases: DataFrame, out: str = "canonico") -> DataFrame:
    """Rows with the canonical value of a column, null where there is none."""
    table = aliases.where(F.col("section") == section).select(F.col("chave").alias("__k"), F.col("canonico").alias(out))
    return rows.withColumn("__k", fold_key(F.col(column))).join(table, "__k", "left").drop("__k")


def specific_theme(value: Column, macro: Column) -> Column:
    """MACRO.SUFFIX: upper case, prefixed by the macro theme where there is no dot; null if there is still none."""
    s = F.upper(F.translate(F.trim(value), " -", "__"))
    s = F.when(F.instr(s, ".") > 0, s).when(macro.isNotNull() & (macro != ""), F.concat(macro, F.lit("."), s))
    return F.when(F.length(F.trim(value)) > 0, s)


def decomposed(rows: DataFrame, key: str, column: str, aliases: DataFrame, section: str = "tributos") -> DataFrame:
    """(key, canonicos): composite values split at the first separator that gives a known part."""
    parts = [F.when(F.instr(F.col(column), s) > 0, F.struct(F.lit(n).alias("n"), first_separator_split(F.col(column), [s]).alias("p"))) for n, s in enumerate(SEPARATORS)]
    whole = F.struct(F.lit(len(SEPARATORS)).alias("n"), F.array(F.trim(F.col(column))).alias("p"))
    tries = rows.where(F.col(column).isNotNull()).select(key, F.explode(F.filter(F.array(*parts, whole), lambda x: x.isNotNull())).alias("t"))
    each = tries.select(key, "t.n", F.posexplode("t.p").alias("i", "part"))
    known = normalized(each, "part", section, aliases).where("canonico is not null")
    lists = known.groupBy(key, "n").agg(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("i", "canonico"))), lambda x: x["canonico"])).alias("l"))
    return lists.groupBy(key).agg(F.min_by("l", "n").alias("canonicos"))


def report(rows: DataFrame, column: str, section: str, aliases: DataFrame) -> DataFrame:
    """(antes, depois, n, acao): what normalising a column would change."""
    out = normalized(rows.select(column), column, section, aliases)
    counts = out.groupBy(F.col(column).alias("antes"), F.col("canonico").alias("depois")).agg(F.count("*").alias("n"))
    action = F.when(F.col("depois").isNull(), "removido").when(F.col("antes").eqNullSafe(F.col("depois")), "igual").otherwise("alterado")
    return counts.withColumn("acao", action)


def types_by_nature(spark: SparkSession, natures: dict[str, list[str]]) -> DataFrame:
    """(codigo, natureza) from {nature: [types]}."""
    table = spark.createDataFrame([(n, list(t)) for n, t in natures.items()], "natureza string, tipos array<string>")
    return table.select(F.explode("tipos").alias("codigo"), "natureza")


def seeded(lookups: dict[str, DataFrame], seeds: dict[str, DataFrame], key: str = "codigo") -> dict[str, DataFrame]:
    """Next states of lookup tables after seeding: new codes are added, known ones take the seed's columns; a seed of an
    unknown table is an error."""
    return {name: merge.upsert(rows, seeds[name], [key]) if name in seeds else rows for name, rows in ({n: lookups[n] for n in seeds} | lookups).items()}


def with_schemas(themes: DataFrame, schemas: DataFrame, key: str = "codigo") -> DataFrame:
    """Themes with the JSON schema whose file is named after them: ``schemas`` has (path, content); others keep theirs."""
    name = F.upper(F.regexp_extract("path", r"([^/]+)\.json$", 1))
    found = schemas.select(name.alias("__k"), F.col("content").cast("string").alias("__s")).where("__k <> ''").groupBy("__k").agg(F.max("__s").alias("__s"))
    return themes.join(found, F.upper(F.translate(F.col(key), ".", "_")) == F.col("__k"), "left").withColumn("schema_tematico", F.coalesce("__s", "schema_tematico")).drop("__k", "__s")
