"""Token counts by section: whole texts are encoded once, and token spans are joined to sections by position.

Each token has a span of code points in its text. A section takes the tokens that lie in it; a token that crosses
boundaries goes by an explicit rule: to the section of its ``first`` character, to the ``largest`` part (the
earlier of equals), or to each section by its ``share`` of the token's bytes. Fields, that is columns, are counted as
sections of one text into which they are joined (``field_counts``).

Defined cases: null and empty texts have no sections and no rows by default sections; sections may leave gaps, whose
tokens are counted for no section; a null start is the text's start and a null end its end, a null section counts as
one without length; sections are taken in order of their starts, and where they overlap the later one begins at the
end of the earlier; bounds beyond the text are its ends; a token of less than one character counts at the character
it is part of; sections of no length get no tokens; repeated rows are counted each; other columns pass by; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.llm import bpe
from actlens.llm.common import arrow_map, column_of, texts_of

RULES = ("first", "largest", "share")


def token_bytes(v: bpe.Vocabulary, ids: np.ndarray) -> np.ndarray:
    """The end of each token in bytes."""
    return np.cumsum(v.sizes[ids])


def line_bounds(raw: bytes) -> np.ndarray:
    """Ends, in bytes, of the lines of a text, each with its line break."""
    breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    return breaks if len(raw) and raw.endswith(b"\n") else np.append(breaks, len(raw)) if raw else breaks


def allocate(ends: np.ndarray, starts_of: np.ndarray, ends_of: np.ndarray, rule: str) -> np.ndarray:
    """Tokens, by their ends in bytes, for each of the ordered and disjoint sections [starts_of, ends_of)."""
    counts = np.zeros(len(starts_of))
    if not len(ends) or not len(starts_of):
        return counts
    begins = np.concatenate([[0], ends[:-1]])
    if rule == "first":
        at = np.searchsorted(ends_of, begins, "right")
        inside = (at < len(starts_of)) & (begins >= starts_of[np.minimum(at, len(starts_of) - 1)])
        return np.bincount(at[inside], minlength=len(starts_of)).astype(float)
    first, last = np.searchsorted(ends_of, begins, "right"), np.searchsorted(starts_of, ends, "left") - 1
    one = first == last
    whole = one & (begins >= starts_of[np.minimum(first, len(starts_of) - 1)]) & (ends <= ends_of[np.minimum(first, len(starts_of) - 1)])
    counts += np.bincount(first[whole], minlength=len(starts_of))
    for k in np.flatnonzero(~whole & (last >= first)):
        sections = np.arange(first[k], last[k] + 1)
        parts = np.minimum(ends[k], ends_of[sections]) - np.maximum(begins[k], starts_of[sections])
        if rule == "share":
            counts[sections] += np.maximum(parts, 0) / (ends[k] - begins[k])
        elif parts.max() > 0:
            counts[sections[int(parts.argmax())]] += 1
    return counts


def section_counts(docs: DataFrame, rule: str = "largest", id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """(id, section, start, end, n_tokens, doc_tokens): one row per section, offsets in code points.

    ``sections_col`` is an array of structs (start, end); without it the sections are lines. Rows are numbered as the
    sections are given. One pass, no shuffle.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule}; one of {', '.join(RULES)}")
    path = vocabulary or bpe.default_vocabulary()
    odd = bpe.odd_characters(path)
    own = F.col(sections_col) if sections_col else F.lit(None).cast("array<struct<start:long,end:long>>")
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"), own.alias("__sections"))

    def make():
        v = bpe.vocabulary_of(path, odd)

        def bounds(text: str, raw: bytes, given: list | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            if given is None and sections_col is None:
                ends_b = line_bounds(raw)
                marks = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) if len(raw) != len(text) else None
                ends_c = ends_b if marks is None else np.searchsorted(marks, ends_b)
                return np.concatenate([[0], ends_b[:-1]]), ends_b, np.concatenate([[0], ends_c[:-1]]), ends_c
            marks = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))
            limit = len(marks) - 1
            spans = [(0, 0) if x is None else (x["start"] or 0, limit if x["end"] is None else x["end"]) for x in given or []]
            starts_c, ends_c = np.array([s for s, _ in spans], np.int64), np.array([e for _, e in spans], np.int64)
            return marks[np.clip(starts_c, 0, limit)], marks[np.clip(ends_c, 0, limit)], starts_c, ends_c

        def counted(ends: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
            order = np.lexsort((ends_b, starts_b))
            last = np.maximum.accumulate(np.concatenate([[0], ends_b[order]]))
            begins = np.maximum(starts_b[order], last[:-1])
            out = np.zeros(len(order))
            out[order] = allocate(ends, begins, np.maximum(begins, ends_b[order]), rule)
            return out

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows: list[list[np.ndarray]] = [[], [], [], [], []]
            which: list[np.ndarray] = []
            given = column_of(batch, "__sections").to_pylist() if sections_col else [None] * batch.num_rows
            for k, (text, own) in enumerate(zip(texts_of(batch, "__text"), given, strict=True)):
                raw = text.encode()
                ends = token_bytes(v, v.encode(text))
                starts_b, ends_b, starts_c, ends_c = bounds(text, raw, own)
                n = len(ends_b)
                if not n:
                    continue
                which.append(np.full(n, k))
                for column, values in zip(rows, (np.arange(n), starts_c[:n], ends_c, counted(ends, starts_b[:n], ends_b), np.full(n, len(ends))), strict=True):
                    column.append(values)
            index = np.concatenate([np.zeros(0, np.int64), *which]).astype(np.int64)
            flat = [np.concatenate([np.zeros(0), *c]) for c in rows]
            types = (np.int64, np.int64, np.int64, np.float64, np.int64)
            return pa.RecordBatch.from_arrays([column_of(batch, "__id").take(pa.array(index)), *[pa.array(c.astype(t)) for c, t in zip(flat, types, strict=True)]], ["__id", "section", "start", "end", "n_tokens", "doc_tokens"])

        step.close = v.forget
        return step

    out = arrow_map(source, make, f"__id {dict(source.dtypes)['__id']}, section long, start long, end long, n_tokens double, doc_tokens long")
    return out.withColumnRenamed("__id", id_col)


def field_counts(docs: DataFrame, fields: list[str], joiner: str = "\n", rule: str = "largest", id_col: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """(id, field, n_tokens, doc_tokens): the tokens of each field in the text that they make when joined, encoded once.

    A null field counts as empty; the joiner's own tokens belong to no field.
    """
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    sections, at = [], F.lit(0).cast("long")
    for part in parts:
        end = at + F.length(part)
        sections.append(F.struct(at.alias("start"), end.alias("end")))
        at = end + F.lit(len(joiner))
    joined = docs.select(F.col(id_col).alias("__key"), F.concat_ws(joiner, *parts).alias("__joined"), F.array(*sections).alias("__sections"))
    rows = section_counts(joined, rule, "__key", "__joined", "__sections", vocabulary)
    names = F.array(*[F.lit(f) for f in fields])
    return rows.select(F.col("__key").alias(id_col), F.get(names, F.col("section")).alias("field"), "n_tokens", "doc_tokens")
