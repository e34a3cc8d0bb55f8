"""Quality rules as a ledger of failure bits.

Every rule is evaluated once over whole texts. The ledger keeps the measurements and one bit for each failed
rule; a policy is a named, versioned mask over those bits, so that policies can change, be compared or be
ablated without reading a text again.

Defined cases: a null text counts as empty; an empty text has no words and fails ``too_few_words``; repeated
rows each get their own ledger row; other columns of the input are ignored, so clashing names do no harm; an
empty table gives an empty ledger.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.llm.common import arrow_map, texts_of

#: name -> condition of failure over the measurements; the place in this list is the bit.
RULES = {
    "too_few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "shouting": "10 * n_upper > 4 * word_chars",
    "exclamations": "10 * n_bangs > n_words",
    "long_words": "word_chars > 20 * n_words",
    "few_distinct_words": "n_words >= 50 and 20 * n_distinct < n_words",
}
BITS = {name: 1 << k for k, name in enumerate(RULES)}
#: version -> rules that reject.
POLICIES = {
    "base-1": ["too_few_words", "repeated_windows"],
    "prose-1": ["too_few_words", "repeated_windows", "symbols", "duplicate_lines", "shouting", "exclamations", "long_words"],
    "strict-1": list(RULES),
}
DEFAULT_POLICY = "prose-1"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs", "n_distinct")
SPACE, SYMBOLS, UPPER = b" \t\n\r\x0b\x0c", b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def repeated_words(words: list[bytes], order: dict[bytes, int]) -> int:
    """Words that lie in a window of five words found twice or more in the text, the first one included."""
    n = len(words)
    if n <= WINDOW or len(order) == n:
        return 0
    ids = np.fromiter(map(order.__getitem__, words), np.uint64, n) + np.uint64(1)
    ids ^= ids << np.uint64(29)
    ids *= np.uint64(0xBF58476D1CE4E5B9)
    ids ^= ids >> np.uint64(32)
    m = n - WINDOW + 1
    keys = ids[:m] * _MULT[0]
    for k in range(1, WINDOW):
        keys ^= keys >> np.uint64(31)
        keys += ids[k : m + k]
        keys *= _MULT[k]
    ranked = np.sort(keys)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return 0
    found = np.isin(keys, twice)
    covered = np.zeros(n, bool)
    for k in range(WINDOW):
        covered[k : m + k] |= found
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``MEASURES``."""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()] if b"\n" in raw else [raw] * bool(words)
    order = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return (
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, SPACE))),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words, order),
        len(lines),
        len(raw) - len(raw.translate(None, UPPER)),
        raw.count(b"!!"),
        len(order),
    )


def failure_bits() -> Column:
    """The bits of all failed rules as one long, from the measurement columns."""
    bits = F.lit(0).cast("long")
    for name, condition in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def mask(policy: str) -> int:
    return sum(BITS[x] for x in POLICIES[policy])


def _measured(source: DataFrame, text_col: str) -> DataFrame:
    """All columns of ``source`` and the measurements of one of them. No shuffle."""
    fields = [f"`{n}` {t}" for n, t in source.dtypes] + [f"{m} long" for m in MEASURES]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [measure(t) for t in texts_of(batch, text_col)]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * len(MEASURES)
            return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *MEASURES])

        return step

    return arrow_map(source, make, ", ".join(fields))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, measurements and ``fail_bits``."""
    rows = _measured(docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")), "__text")
    return rows.select(F.col("__id").alias(id_col), *MEASURES, failure_bits().alias("fail_bits"))


def verdicts(rows: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Adds base_failed and kept under a policy; a failed base rule always rejects."""
    base = F.col("fail_bits").bitwiseAND(F.lit(mask("base-1"))) != 0
    return rows.select("*", base.alias("base_failed"), (~base & (F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0)).alias("kept"))


def ablation(rows: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """For each rule of a policy: rows that fail it, and rows that only it rejects; one aggregation of the ledger."""
    all_bits = mask(policy)
    sums = []
    for name in POLICIES[policy]:
        hit = F.col("fail_bits").bitwiseAND(F.lit(all_bits))
        sums += [F.count_if(hit.bitwiseAND(F.lit(BITS[name])) != 0).alias(f"f_{name}"), F.count_if(hit == F.lit(BITS[name])).alias(f"s_{name}")]
    one = rows.agg(F.count("*").alias("n"), F.bit_or("fail_bits").alias("seen"), *sums)
    parts = ", ".join(f"'{n}', f_{n}, s_{n}" for n in POLICIES[policy])
    return one.select("n", "seen", F.expr(f"stack({len(POLICIES[policy])}, {parts}) as (rule, failed, failed_alone)"))


def filter_documents(docs: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The rows that a policy keeps, with their own columns only."""
    names = docs.columns
    source = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(names)])
    rows = _measured(source, f"__c{names.index('text')}").withColumn("fail_bits", failure_bits())
    return verdicts(rows, policy).where("kept").select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(names)])
