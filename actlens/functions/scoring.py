"""Rank fusion, decay and weight look-ups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the ranking configuration.
RRF_K = 60
HALF_LIFE_YEARS = 15.0
MODES = {
    "pratico": {"normativa": 1.20, "consultiva": 1.05, "operacional": 0.50},
    "consultivo": {"normativa": 1.05, "consultiva": 1.20, "operacional": 0.30},
    "operacional": {"normativa": 0.70, "consultiva": 0.70, "operacional": 1.20},
    "historico": {"normativa": 1.00, "consultiva": 1.00, "operacional": 0.70},
}
SECONDARY = {
    "consultiva": {"SOLUCAO_DIVERGENCIA": 1.15, "SOLUCAO_CONSULTA": {"_default": 1.00, "COSIT": 1.10, "COANA": 1.10}, "SOLUCAO_CONSULTA_INTERNA": 1.10},
    "normativa": {"INSTRUCAO_NORMATIVA": 1.05, "DECRETO": 1.05, "PARECER_NORMATIVO": 1.05},
}
STATUS = {"vigente_nunca_alterado": 1.00, "vigente_alterado": 0.95, "revigorado": 1.00, "retificador": 0.70, "nao_vigente": 0.40, "publicacao_repetida": 0.0, "nao_disponivel_portal": 0.0, "_default": 1.00}
LANDMARK = {"tema_stf": 0.10, "tema_stj": 0.10, "sumula_carf": 0.08, "sumula_vinculante": 0.10, "sumula_stf": 0.08, "sumula_stj": 0.08}


def reciprocal(position: Column, k: int = RRF_K) -> Column:
    """1 / (k + position), 0 where there is none."""
    return F.coalesce(F.lit(1.0) / (F.lit(k) + position), F.lit(0.0))


def decay(published: Column, as_of: str, half_life: float = HALF_LIFE_YEARS) -> Column:
    """0.5 to the power of years / half-life at a stated day; 1 for null dates and no half-life."""
    if half_life <= 0:
        return F.lit(1.0)
    return F.coalesce(F.pow(F.lit(0.5), F.date_diff(F.lit(as_of).cast("date"), published) / F.lit(365.25) / F.lit(half_life)), F.lit(1.0))


def lookup(c: Column, weights: dict[str, float], default: float = 1.0) -> Column:
    return reduce(lambda x, e: F.when(c == e[0], F.lit(float(e[1]))).otherwise(x), reversed([e for e in weights.items() if e[0] != "_default"]), F.lit(float(weights.get("_default", default))))


def secondary(nature: Column, kind: Column, issuer: Column, table: dict = SECONDARY) -> Column:
    """Weight by nature, type and, where given, issuer."""
    out = F.lit(1.0)
    for n, kinds in table.items():
        for k, value in kinds.items():
            weight = lookup(issuer, value) if isinstance(value, dict) else F.lit(float(value))
            out = F.when((nature == n) & (kind == k), weight).otherwise(out)
    return out


def backoff(attempt: Column, jitter: Column, cap: float = 6 * 3600.0) -> Column:
    """Seconds to the next attempt: doubling minutes times a jitter of 0.5 to 1.5, capped after the jitter."""
    return F.least(F.lit(cap), F.pow(F.lit(2.0), F.greatest(F.lit(0), attempt)) * 60.0 * (F.lit(0.5) + jitter))
