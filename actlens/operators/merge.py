"""Table changes without a transactional format: classify by join, return the new state, log what changed.

Each function takes the target and the new rows as frames and returns the target's next state; ``sources.store`` puts
it in place.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actlens.sources.scratch import Scratch


def _paired(target: DataFrame, rows: DataFrame, keys: list[str], how: str) -> DataFrame:
    """target and rows side by side as structs t and s, joined null-safely on the keys; a missing side is null."""
    t = target.select(F.struct(*target.columns).alias("t"))
    s = rows.select(F.struct(*rows.columns).alias("s"))
    match = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    return t.join(s, match, how)


def classified(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct new rows with ``action``: inserted, updated or unchanged."""
    values = [c for c in rows.columns if c not in keys]
    both = _paired(target, rows.dropDuplicates(keys), keys, "right")
    same = reduce(lambda a, b: a & b, [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in values], F.lit(True))
    action = F.when(F.col("t").isNull(), "inserted").when(same, "unchanged").otherwise("updated")
    return both.select("s.*", action.alias("action"))


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], update: dict[str, Callable[[Column, Column], Column]] | None = None, touch: tuple[str, Column] | None = None) -> DataFrame:
    """Rows replace target rows of the same key and are added otherwise.

    ``update`` gives, per column, an expression of (old, new) for rows that exist, for instance to increment or to
    keep the old value; other columns take the new one if the new rows have them. ``touch`` sets a column where a
    row was written.
    """
    update = update or {}
    both = _paired(target, rows.dropDuplicates(keys), keys, "full_outer")
    old, new = F.col("t").isNotNull(), F.col("s").isNotNull()
    out = []
    for c in target.columns:
        was, now = F.col(f"t.{c}"), F.col(f"s.{c}") if c in rows.columns else F.lit(None)
        if c in keys:
            value = F.when(old, was).otherwise(now)
        elif c in update:
            value = F.when(old & new, update[c](was, now)).when(new, now).otherwise(was)
        elif c in rows.columns:
            value = F.when(new, now).otherwise(was)
        else:
            value = was
        if touch and c == touch[0]:
            value = F.when(new, touch[1]).otherwise(value)
        out.append(value.cast(target.schema[c].dataType).alias(c))
    return both.select(*out)


def insert_missing(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The target with those new rows, one per key, whose key it lacks."""
    fresh = rows.dropDuplicates(keys)
    known = target.select(*[F.col(k).alias(f"__{k}") for k in keys])
    match = reduce(lambda a, b: a & b, [fresh[k].eqNullSafe(known[f"__{k}"]) for k in keys])
    return target.unionByName(fresh.join(known, match, "left_anti").select(*target.columns))


def replace_groups(target: DataFrame, rows: DataFrame, group: str) -> DataFrame:
    """The target with all rows of the groups in ``rows`` replaced by them."""
    gone = rows.select(F.col(group).alias("__g")).distinct()
    return target.join(gone, target[group] == F.col("__g"), "left_anti").unionByName(rows)


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    return target.where(~F.coalesce(condition, F.lit(False)))


def cascaded(rows: DataFrame, column: str, parents: DataFrame, key: str, action: str = "delete") -> DataFrame:
    """Child rows after their parents changed: those whose parent is gone are deleted, or lose the reference (``set_null``).

    Rows without a reference stay as they are.
    """
    held = parents.where(F.col(key).isNotNull()).select(F.col(key).alias("__k")).distinct()
    if action == "delete":
        return rows.where(F.col(column).isNull()).unionByName(rows.join(held, F.col(column) == F.col("__k"), "left_semi"))
    if action != "set_null":
        raise ValueError(f"unknown action {action}; delete or set_null")
    return rows.join(held, F.col(column) == F.col("__k"), "left").withColumn(column, F.col("__k")).drop("__k")


def change_log(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, campo, antes, depois): one row per changed field of rows that both states have."""
    both = _paired(before.select(*keys, *fields), after.select(*keys, *fields), keys, "inner")
    cells = F.array(*[F.struct(F.lit(f).alias("campo"), F.col(f"t.{f}").cast("string").alias("antes"), F.col(f"s.{f}").cast("string").alias("depois")) for f in fields])
    out = both.select(*[F.col(f"s.{k}").alias(k) for k in keys], F.explode(cells).alias("c"))
    return out.select(*keys, "c.*").where(~F.col("antes").eqNullSafe(F.col("depois")))


def unchanged_since(target: DataFrame, seen: DataFrame, keys: list[str], body: str) -> DataFrame:
    """Rows of ``seen`` (keys, sha256) whose body in the target is still the one that was read; others must not be written."""
    now = target.select(*keys, F.sha2(F.col(body), 256).alias("__now"))
    return seen.join(now, keys).where(F.col("sha256") == F.col("__now")).drop("__now")


def create_or_complete(acts: DataFrame, rows: DataFrame, natural: list[str], issuer: str = "emissor") -> DataFrame:
    """Acts after new rows: filled where they had nothing, created where they were missing.

    Rows are matched by ``id_portal``. A held act takes the new issuer only if no other act already has the natural
    key that it would get.
    """
    values = [c for c in rows.columns if c != "id_portal"]
    new = rows.dropDuplicates(["id_portal"]).select("id_portal", *[F.col(c).alias(f"__n_{c}") for c in values])
    both = acts.join(new, "id_portal", "left")
    taken = acts.select(*[F.col(c).alias(f"__t_{c}") for c in natural], F.col("id").alias("__t_id"))
    wanted = {c: F.col(f"__n_{c}") if c == issuer and c in values else F.col(c) for c in natural}
    clash = reduce(lambda a, b: a & b, [wanted[c] == F.col(f"__t_{c}") for c in natural]) & (F.col("id") != F.col("__t_id"))
    free = both.join(taken, clash, "left_anti").select("id").withColumn("__free", F.lit(True))
    full = both.join(free, "id", "left")
    out = []
    for c in acts.columns:
        if c == issuer and c in values:
            value = F.when(F.col("__free") & F.col(f"__n_{c}").isNotNull(), F.col(f"__n_{c}")).otherwise(F.col(c))
        else:
            value = F.coalesce(F.col(c), F.col(f"__n_{c}")) if c in values else F.col(c)
        out.append(value.alias(c))
    known = acts.where("id_portal is not null").select("id_portal")
    fresh = rows.dropDuplicates(["id_portal"]).join(known, "id_portal", "left_anti")
    fresh = next_ids(fresh, acts, "id", ["id_portal"])
    return full.select(*out).unionByName(fresh, allowMissingColumns=True).select(*acts.columns)


def next_ids(rows: DataFrame, target: DataFrame, key: str, order: list[str]) -> DataFrame:
    """New rows with ids after the target's largest, in a stated order (nulls first); rows equal in it go in any order.

    The batch is written in ranges of the order, and each range is numbered from the sum of the ranges before it.
    """
    top = target.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    places = {"__part": F.spark_partition_id(), "__k": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}
    written = Scratch(rows.sparkSession, "ids").put(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(places))
    counts = written.groupBy("__part").agg(F.count("*").alias("__n"))
    before = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))  # one row a task
    return written.join(F.broadcast(before), "__part").withColumn(key, F.lit(top) + F.col("__before") + F.col("__k") + 1).drop("__part", "__k", "__before")


class Constraints:
    """Named rules of a table: checks, unique keys and references.

    ``enforce`` looks at new rows only, as a rule that was added unvalidated; ``validate`` returns all violating rows.
    """

    def __init__(self) -> None:
        self.checks: dict[str, Column] = {}
        self.uniques: dict[str, tuple[list[str], Column | None]] = {}
        self.references: dict[str, tuple[str, DataFrame, str]] = {}

    def check(self, name: str, condition: Column) -> Constraints:
        self.checks[name] = condition
        return self

    def unique(self, name: str, keys: list[str], where: Column | None = None) -> Constraints:
        self.uniques[name] = (keys, where)
        return self

    def reference(self, name: str, column: str, parent: DataFrame, key: str) -> Constraints:
        self.references[name] = (column, parent, key)
        return self

    def violations(self, rows: DataFrame) -> DataFrame:
        """(regra, linha json) of each violation; a null condition does not violate."""
        line = F.to_json(F.struct(*rows.columns)).alias("linha")
        parts = [rows.where(~F.coalesce(c, F.lit(True))).select(F.lit(n).alias("regra"), line) for n, c in self.checks.items()]
        for n, (keys, where) in self.uniques.items():
            kept = (rows.where(where) if where is not None else rows).where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
            twice = kept.groupBy(*keys).count().where("count > 1").drop("count")
            parts.append(twice.select(F.lit(n).alias("regra"), F.to_json(F.struct(*keys)).alias("linha")))
        for n, (column, parent, key) in self.references.items():
            known = parent.select(F.col(key).alias("__k")).distinct()
            parts.append(rows.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("__k"), "left_anti").select(F.lit(n).alias("regra"), line))
        return reduce(DataFrame.unionAll, parts)

    validate = violations

    def enforce(self, rows: DataFrame) -> DataFrame:
        bad = self.violations(rows).limit(5).collect()
        if bad:
            raise ValueError("; ".join(f"{r['regra']}: {r['linha']}" for r in bad))
        return rows
