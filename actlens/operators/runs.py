"""Parity of two stores, and metrics of routine runs."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parity(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """(tabela, origem, destino, ok) of row counts, each table counted once a side."""
    parts = [source[n].agg(F.count("*").alias("origem")).join(target[n].agg(F.count("*").alias("destino"))).select(F.lit(n).alias("tabela"), "origem", "destino") for n in source]  # one row each
    return reduce(DataFrame.unionAll, parts).withColumn("ok", F.col("origem") == F.col("destino"))


def distribution_matches(rows: DataFrame, column: str, expected: dict[str, int], tolerance: float = 0.0) -> DataFrame:
    """(valor, n, esperado, ok) of a column against expected counts."""
    want = rows.sparkSession.createDataFrame(list(expected.items()), "valor string, esperado long")
    found = rows.groupBy(F.col(column).alias("valor")).agg(F.count("*").alias("n"))
    both = want.join(found, "valor", "full_outer").fillna(0, ["n", "esperado"])
    return both.withColumn("ok", F.abs(F.col("n") - F.col("esperado")) <= tolerance * F.col("esperado"))


def orphans(checks: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(regra, orfaos): rows of a child whose reference has no parent."""
    parts = []
    for name, (child, column, parent, key) in checks.items():
        known = parent.select(F.col(key).alias("__k")).distinct()
        lost = child.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("__k"), "left_anti")
        parts.append(lost.agg(F.count("*").alias("orfaos")).select(F.lit(name).alias("regra"), "orfaos"))
    return reduce(DataFrame.unionAll, parts)


def numbers(runs: DataFrame, last: int = 14) -> DataFrame:
    """The last runs with totals per run and the time each took."""
    spent = (F.unix_timestamp("fim") - F.unix_timestamp("inicio")) / 60
    return runs.orderBy(F.desc("inicio")).limit(last).withColumn("minutos", F.round(spent, 1)).withColumn("erros", F.col("erros_coleta") + F.col("erros_categorizacao"))


def late(runs: DataFrame, as_of: str, hours: int = 26) -> DataFrame:
    """One row: the last good run and whether it is too long ago."""
    last = runs.where("estado = 'ok'").agg(F.max("inicio").alias("ultima"))
    return last.withColumn("atrasada", F.coalesce(F.col("ultima") < F.lit(as_of).cast("timestamp") - F.expr(f"interval {hours} hours"), F.lit(True)))


def message(runs: DataFrame) -> DataFrame:
    """(run_id, mensagem): one line a run."""
    parts = [F.concat(F.col(c).cast("string"), F.lit(f" {label}")) for c, label in (("atos_coletados", "coletados"), ("atos_categorizados", "categorizados"), ("materias_gravadas", "matérias"), ("para_revisao", "para revisão"))]
    return runs.select("run_id", F.concat_ws(" · ", F.col("estado"), *parts).alias("mensagem"))


def needs_second_attempt(runs: DataFrame, day: str) -> DataFrame:
    """One row: whether the routine must run again on a day, and whether it must send a batch."""
    today = runs.where(F.col("inicio").cast("date") == F.lit(day).cast("date"))
    return today.agg(F.count("*").alias("n"), F.count_if(F.col("estado") == "ok").alias("ok"), F.coalesce(F.sum("lotes_enviados"), F.lit(0)).alias("lotes")).select((F.col("ok") == 0).alias("rodar"), (F.col("lotes") == 0).alias("enviar_lote"))


def lock_free(held_since: str | None, as_of: str, hours: int = 12) -> bool:
    """Whether a run may begin: no lock, or one that has expired."""
    return held_since is None or datetime.fromisoformat(as_of) - datetime.fromisoformat(held_since) > timedelta(hours=hours)


class RunLock:
    """A lock file: one run at a time, an expired lock is taken over; attempts of a day are kept one file each."""

    def __init__(self, folder: str, as_of: str, hours: int = 12) -> None:
        self.folder, self.as_of, self.hours = Path(folder), as_of, hours
        self.file = self.folder / "lock"

    def __enter__(self) -> RunLock:
        self.folder.mkdir(parents=True, exist_ok=True)
        if self.file.exists() and lock_free(self.file.read_text(), self.as_of, self.hours):
            self.file.unlink()
        try:
            with self.file.open("x") as file:  # fails if another run made it first
                file.write(self.as_of)
        except FileExistsError as held:
            raise RuntimeError(f"a run holds the lock since {self.file.read_text()}") from held
        return self

    def __exit__(self, *_: object) -> None:
        self.file.unlink(missing_ok=True)

    def keep_attempt(self, text: str) -> Path:
        """Writes one attempt's report under the day and the next free number."""
        day = self.as_of[:10]
        number = 1 + len(list(self.folder.glob(f"{day}-*.txt")))
        path = self.folder / f"{day}-{number}.txt"
        with path.open("x", encoding="utf-8") as file:
            file.write(text)
        return path


def semantic_smoke(rows: DataFrame, query: list[float], key: str, vec: str, expected: list, size: int = 10) -> bool:
    """Whether the rows that must be near a query vector are among its nearest."""
    from actlens.operators.search import nearest

    found = {r[0] for r in nearest(rows, query, key, vec, size).select(key).collect()}  # ``size`` rows
    return set(expected) <= found
