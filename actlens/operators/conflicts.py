"""Similar pairs and conflicts inside themes.

Vectors of a theme are dealt into blocks of about ``BLOCK``; each pair of blocks is one row, compared as matrices, so
that a theme of any size is spread over tasks and only pairs over the threshold become rows. The comparison is exact:
in many dimensions no bound from norms or pivots rules pairs out, and one vector is sent to one block in ``BLOCK``.
Vectors of one call have one length; keys are whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.functions.arrow import arrow_map, column_of
from actlens.functions.text import has_text
from actlens.operators import merge

BLOCK = 2048
#: Vectors of a block whose similarities are held at once.
SLICE = 256


def similar_pairs(rows: DataFrame, threshold: float, theme: str = "theme", key: str = "id", act: str | None = None, vec: str = "embedding", side: str | None = None) -> DataFrame:
    """(theme, a, b, sim): pairs a < b of one theme whose cosine similarity is over the threshold, rounded to 4 places.

    With ``act`` pairs of one act are left out; with ``side`` (0 or 1) only pairs of different sides are compared.
    """
    act_col = F.col(act).cast("string") if act else F.lit(None).cast("string")
    side_col = F.col(side).cast("int") if side else F.lit(None).cast("int")
    cells = rows.where(F.col(vec).isNotNull() & F.col(theme).isNotNull()).select(F.col(theme).alias("theme"), F.struct(F.col(key).alias("id"), act_col.alias("act"), side_col.alias("side"), F.col(vec).cast("array<double>").alias("v")).alias("cell"))
    sizes = cells.groupBy("theme").agg(F.count("*").alias("n"))
    dealt = cells.join(sizes, "theme").withColumn("m", F.expr(f"cast(ceil(n / {BLOCK}) as int)")).withColumn("k", F.expr("cast(pmod(xxhash64(cell.id), m) as int)"))
    # a row of block k meets blocks 0..m-1; block pairs are named (low, high)
    spread = dealt.select("theme", "k", F.explode(F.expr("sequence(0, m - 1)")).alias("o"), "cell")
    spread = spread.select("theme", F.least("k", "o").alias("low"), F.greatest("k", "o").alias("high"), (F.col("k") <= F.col("o")).alias("first"), (F.col("k") >= F.col("o")).alias("second"), "cell")
    blocks = spread.groupBy("theme", "low", "high").agg(F.expr("collect_list(cell) filter (where first)").alias("x"), F.expr("collect_list(cell) filter (where second)").alias("y"))
    theme_type = dict(cells.dtypes)["theme"]
    key_type = dict(rows.dtypes)[key]

    def make():
        def unpacked(cells: pa.StructArray) -> tuple[np.ndarray, ...]:
            vectors = cells.field("v")
            v = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(cells), -1)
            act, side = cells.field("act"), cells.field("side").fill_null(-1)
            return cells.field("id").to_numpy(zero_copy_only=False), act, side.to_numpy(zero_copy_only=False), v, np.sqrt((v * v).sum(1))

        def numbers(x: pa.Array, y: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            """Equal numbers for equal acts of both sides; nulls are unlike all."""
            both = pa.concat_arrays([x, y]).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            return both[: len(x)], both[len(x) :]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            themes, found = column_of(batch, "theme"), [[np.zeros(0, np.int64)] * 3 + [np.zeros(0)]]
            lists = column_of(batch, "x"), column_of(batch, "y")
            low, high = (column_of(batch, c).to_pylist() for c in ("low", "high"))
            for row in range(batch.num_rows):
                xs, ys = (c[row].values for c in lists)
                if xs is None or ys is None or not len(xs) or not len(ys):
                    continue
                (i_x, act_x, side_x, x, n_x), (i_y, act_y, side_y, y, n_y) = unpacked(xs), unpacked(ys)
                act_x, act_y = numbers(act_x, act_y)
                for first in range(0, len(i_x), SLICE):
                    part = slice(first, first + SLICE)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        sims = (x[part] @ y.T) / (n_x[part, None] * n_y[None, :])
                    i, j = np.nonzero(sims > threshold)
                    s, i = sims[i, j], i + first
                    stay = (i_x[i] < i_y[j]) if low[row] == high[row] else (i_x[i] != i_y[j])
                    stay &= ((act_x[i] < 0) | (act_x[i] != act_y[j])) & ((side_x[i] < 0) | (side_x[i] != side_y[j]))
                    a, b = i_x[i[stay]], i_y[j[stay]]
                    found.append([np.full(len(a), row), np.minimum(a, b), np.maximum(a, b), s[stay]])
            row, a, b, s = (np.concatenate(c) for c in zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([themes.take(pa.array(row)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s)], ["theme", "a", "b", "s"])

        return step

    found = arrow_map(blocks, make, f"theme {theme_type}, a long, b long, s double", rows=4)
    return found.select("theme", F.col("a").cast(key_type).alias("a"), F.col("b").cast(key_type).alias("b"), F.round("s", 4).alias("sim"))


def eligible(rows: DataFrame, signs: Column, kinds: list[str] | None = None, kind: str = "tipo_ato", efficacy: str | None = None, solution: str | None = None) -> DataFrame:
    """Rows that can be in a conflict: sign AUTORIZA or VEDA, with a theme and a vector.

    Optionally of some kinds of act, of a binding efficacy (column ``efficacy``) and with a solution (column ``solution``).
    """
    out = rows.withColumn("sinal", signs).where("sinal in ('AUTORIZA', 'VEDA') and theme is not null and embedding is not null")
    if kinds:
        out = out.where(F.col(kind).isin(kinds))
    if efficacy:
        out = out.where(F.col(efficacy).like("vinculante%"))
    return out.where(has_text(F.col(solution))) if solution else out


def themes(rows: DataFrame, least: int = 3) -> DataFrame:
    """(theme, n) of themes with enough rows."""
    return rows.groupBy("theme").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def symmetric(edges: DataFrame, origin: str, target: str) -> DataFrame:
    """(x, y) of every edge in both directions, distinct."""
    one = edges.select(F.col(origin).alias("x"), F.col(target).alias("y")).where("x is not null and y is not null")
    return one.unionAll(one.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()


def conflicts(rows: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """Pairs of opposite signs in a theme, older first, with supersession and formal relation.

    ``rows`` has (id, ato, theme, data, sinal, embedding); equal dates keep the order of ids and do not supersede.
    Signs are split before similarity, so that only AUTORIZA x VEDA pairs are compared.
    """
    sided = rows.withColumn("side", (F.col("sinal") == "VEDA").cast("int"))
    pairs = similar_pairs(sided, threshold, act="ato", side="side")
    known = rows.select("id", "ato", "data", "sinal")
    left, right = known.toDF("a", "ato_a", "data_a", "sinal_a"), known.toDF("b", "ato_b", "data_b", "sinal_b")
    full = pairs.join(left, "a").join(right, "b")
    swap = F.col("data_b") < F.col("data_a")

    def older(x: str, y: str) -> Column:
        return F.when(swap, F.col(y)).otherwise(F.col(x))

    named = full.select("theme", "sim", *[older(f"{c}a", f"{c}b").alias(f"{c}old") for c in ("", "ato_", "data_", "sinal_")], *[older(f"{c}b", f"{c}a").alias(f"{c}new") for c in ("", "ato_", "data_", "sinal_")])
    named = named.toDF("theme", "sim", "materia_a", "ato_a", "data_a", "sinal_a", "materia_b", "ato_b", "data_b", "sinal_b")
    formal = symmetric(edges, "origem", "destino").select(F.col("x").alias("ato_a"), F.col("y").alias("ato_b"), F.lit(True).alias("formal"))
    out = named.join(formal, ["ato_a", "ato_b"], "left")
    return out.withColumn("supera", F.coalesce(F.col("data_b") > F.col("data_a"), F.lit(False))).withColumn("formal", F.coalesce("formal", F.lit(False)))


def to_review(found: DataFrame, limit: int = 30) -> DataFrame:
    """Superseding pairs without a formal relation, most similar and newest first."""
    order = [F.desc("sim"), F.col("data_b").desc_nulls_last(), F.col("materia_a"), F.col("materia_b")]
    return found.where("supera and not formal").orderBy(*order).limit(limit)


PAIR = ["materia_a", "materia_b"]


def upserted(table: DataFrame, found: DataFrame) -> DataFrame:
    """The table of conflicts after new ones: one row a pair, whose figures are replaced and whose note is kept."""
    return merge.upsert(table, found.select(*[c for c in found.columns if c in table.columns and c != "observacao"]), PAIR)


def cleared(table: DataFrame, theme: str, themes: list | None = None) -> DataFrame:
    """The table of conflicts without those of some themes, or without any."""
    return merge.delete_where(table, F.col(theme).isin(themes) if themes is not None else F.lit(True))
