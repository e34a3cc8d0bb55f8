"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

Random strings are written with few characters a token under a byte-pair vocabulary, words with many. Every run of
key characters (letters, digits and ``+/_=.~-``) outside what a pattern found is a candidate as a whole, so that a
token of several dotted parts is one; where its ratio is ``MAX_RATIO`` or more its words are, and in a word, or
across words, the stretches in which tokens are short: a token adds ``MAX_RATIO`` less its characters, and a stretch
whose sum stays positive has a lower ratio. Stretches are widened to the ends of their words where the ratio bears
it. A readable prefix can therefore not hide a key, and a key inside a path is found. Words of up to ``WORD`` letters
in one case are found in prose, in compounding languages with a ratio as low, and are no evidence by themselves.

Left out before the test are known digests (hexadecimal of the usual lengths, subresource integrity values) and
identifiers (UUIDs, plain and grouped numbers, the scheme and host of a URL, mail addresses).

Defined cases: null and empty texts have no spans; long texts are scanned whole; offsets are code points with
exclusive end; ties at one start are ordered by kind as in ``KINDS``; repeated rows are scanned each; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.llm.common import arrow_map, column_of, texts_of

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=.~-]{16,}")
PART = re.compile(r"[A-Za-z0-9]+")
#: what is known not to be a secret
KNOWN = re.compile(
    r"""(?<![A-Za-z0-9])(?:
        (?:[0-9a-f]{128}|[0-9a-f]{96}|[0-9a-f]{64}|[0-9a-f]{56}|[0-9a-f]{40}|[0-9a-f]{32})
        |[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}
        |sha(?:256-[A-Za-z0-9+/]{43}|384-[A-Za-z0-9+/]{64}|512-[A-Za-z0-9+/]{86})={0,2}
        |(?<![0-9][-_/.T])(?=[0-9._/T-]{16})[0-9]+(?:[-_/.T][0-9]+)*
    )(?![A-Za-z0-9])""",
    re.I | re.X | re.A,
)
SCHEME, LOCAL = re.compile(r"[A-Za-z0-9+.-]*\Z", re.A), re.compile(r"[A-Za-z0-9._%+-]*\Z", re.A)
HOST, DOMAIN = re.compile(r"(?:[^\s/?#@]*@)?([^\s/?#]*)"), re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.A)
#: characters that are encoded at once, so that the time stays linear in a run
BLOCK = 4096
LEAST = 16
#: letters of one case that make a candidate where nothing else stands with them
WORD = 24
#: characters of a stretch that is taken if it can be widened to LEAST
CORE = 8
#: characters by which a stretch may be widened on each side
SIDE = 64
MAX_RATIO = 2.0
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(4)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern kinds: leftmost and non-overlapping per kind, failing matches dropped."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Schemes and hosts of URLs, and mail addresses; the name and password of a URL are no part of its host."""
    at = text.find("://")
    inside = 0
    while at >= 0:
        host = HOST.match(text, at + 3)
        yield at - len(SCHEME.search(text, max(0, at - SIDE), at)[0]), at + 3
        yield host.span(1)
        inside = host.end()
        at = text.find("://", inside)
    at = text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        local = LOCAL.search(text, max(0, at - SIDE), at)
        if domain and local[0] and not _in_url(text, local.start()):
            yield local.start(), domain.end()
        at = text.find("@", at + 1)


def _in_url(text: str, at: int) -> bool:
    return "://" in text[max(0, at - SIDE) : at].rsplit(" ", 1)[-1]


def joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, with overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def outside(start: int, end: int, gone: list[tuple[int, int]], first: int = 0) -> Iterator[tuple[int, int]]:
    """The parts of a range that ordered and disjoint ``gone`` ranges, from number ``first`` on, leave."""
    at, k = start, first
    while k < len(gone) and gone[k][0] < end:
        if gone[k][1] > at:
            if gone[k][0] > at:
                yield at, gone[k][0]
            at = gone[k][1]
        k += 1
    if at < end:
        yield at, end


def short_tokens(run: str, bpe: tiktoken.Encoding, max_ratio: float) -> bool:
    """Whether a string has fewer than ``max_ratio`` characters a token."""
    return len(run) < max_ratio * sum(len(bpe.encode_ordinary(run[k : k + BLOCK])) for k in range(0, len(run), BLOCK))


def wordlike(run: str) -> bool:
    """Whether all of a string's words are shorter than ``WORD`` and of letters in one case, with or without a capital."""
    return all(len(w) < WORD and w.isalpha() and (w[1:].islower() or w[1:].isupper() or len(w) == 1) for w in PART.findall(run))


def random_ranges(run: str, bpe: tiktoken.Encoding, max_ratio: float) -> list[tuple[int, int]]:
    """Ranges of one run that are random strings, in order and disjoint: all of it, else words, else stretches."""
    if wordlike(run):
        return []
    if short_tokens(run, bpe, max_ratio):
        return [(0, len(run))]
    words = [m.span() for m in PART.finditer(run) if m.end() - m.start() >= LEAST]
    found = [(a, b) for a, b in words if (a, b) != (0, len(run)) and not wordlike(run[a:b]) and short_tokens(run[a:b], bpe, max_ratio)]
    for a, b in list(outside(0, len(run), found)):
        at = a
        for s, e in stretches(run[a:b], bpe, max_ratio):
            left, right = widened(run[a:b], s, e, bpe, max_ratio)
            left = max(left, at - a)
            if right - left >= LEAST and not wordlike(run[a + left : a + right]):
                found.append((a + left, a + right))
                at = a + right
    return sorted(found)


def stretches(run: str, bpe: tiktoken.Encoding, max_ratio: float) -> list[tuple[int, int]]:
    """Ranges of a run whose characters-per-token ratio is under ``max_ratio``, as long as tokens stay short."""
    ends, gains, at = [], [], 0
    for k in range(0, len(run), BLOCK):
        for token in bpe.encode_ordinary(run[k : k + BLOCK]):
            size = len(bpe.decode_single_token_bytes(token))
            at += size
            ends.append(at)
            gains.append(max_ratio - size)
    found, total, first, best, best_end, start = [], 0.0, 0, 0.0, 0, 0

    def keep() -> None:
        if best > 0 and best_end - first >= CORE:
            found.append((first, best_end))

    for end, gain in zip(ends, gains, strict=True):
        if total <= 0:
            keep()
            total, first, best, best_end = 0.0, start, 0.0, start
        total += gain
        if total > best:
            best, best_end = total, end
        start = end
    keep()
    return found


def widened(run: str, start: int, end: int, bpe: tiktoken.Encoding, max_ratio: float) -> tuple[int, int]:
    """The range out to the ends of its first and last word, if the ratio of the whole still is under ``max_ratio``."""
    left, right = start, end
    while left and run[left - 1].isalnum() and start - left < SIDE:
        left -= 1
    while right < len(run) and run[right].isalnum() and right - end < SIDE:
        right += 1
    # padding belongs to the string that it ends
    while right < len(run) and run[right] == "=" and right - end < SIDE:
        right += 1
    if (left, right) == (start, end) or right - left < max_ratio * len(bpe.encode_ordinary(run[left:right])):
        return left, right
    return start, end


def random_spans(text: str, bpe: tiktoken.Encoding, taken: list[tuple[int, int, str]], max_ratio: float = MAX_RATIO) -> list[tuple[int, int, str]]:
    """Spans that the token-efficiency test finds outside ``taken``, in order and disjoint."""
    found: list[tuple[int, int, str]] = []
    gone: list[tuple[int, int]] | None = None
    first = 0
    for m in RUN.finditer(text):
        if gone is None:
            gone = joined([*((s, e) for s, e, _ in taken), *addresses(text)])
        while first < len(gone) and gone[first][1] <= m.start():
            first += 1
        for start, end in outside(m.start(), m.end(), gone, first):
            if end - start < LEAST:
                continue
            known = [(start + k.start(), start + k.end()) for k in KNOWN.finditer(text[start:end])]
            for a, b in outside(start, end, known):
                run = text[a:b]
                if b - a < LEAST or sum(map(len, PART.findall(run))) < LEAST - 4:
                    continue
                found += [(a + s, a + e, "random") for s, e in random_ranges(run, bpe, max_ratio)]
    return found


def scan(text: str, bpe: tiktoken.Encoding, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, str]]:
    base = base_spans(text)
    extra = random_spans(text, bpe, base, max_ratio)
    return sorted(base + extra, key=lambda x: (x[0], KINDS.index(x[2]))) if extra else base


SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, max_ratio: float = MAX_RATIO) -> DataFrame:
    """(id, spans) of every row, spans ordered by start and kind. No shuffle; one pass over whole texts."""
    path = vocabulary or default_vocabulary()
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))

    def make():
        bpe = encoding(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            spans = [[{"kind": k, "start": s, "end": e} for s, e, k in scan(t, bpe, max_ratio)] for t in texts_of(batch, "__text")]
            return pa.RecordBatch.from_arrays([column_of(batch, "__id"), pa.array(spans, _SPANS)], ["__id", "spans"])

        return step

    return arrow_map(source, make, f"__id {dict(source.dtypes)['__id']}, spans {SPANS}").withColumnRenamed("__id", id_col)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each stretch that spans cover replaced by one mark; overlapping spans are merged."""
    parts, at, k = [], 0, 0
    while k < len(spans):
        start, end, kind = spans[k]
        while k + 1 < len(spans) and spans[k + 1][0] < end:
            k += 1
            end = max(end, spans[k][1])
        parts += [text[at:start], f"<{kind}>"]
        at, k = end, k + 1
    return "".join([*parts, text[at:]])


def redact_documents(docs: DataFrame, vocabulary: str | None = None, max_ratio: float = MAX_RATIO) -> DataFrame:
    """All rows and columns, with secrets in ``text`` replaced and ``n_chars`` following; a null text stays null."""
    path = vocabulary or default_vocabulary()
    names = docs.columns
    source = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(names)])
    at = names.index("text")

    def make():
        bpe = encoding(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t if t is None else redacted(t, scan(t, bpe, max_ratio)) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            return pa.RecordBatch.from_arrays(columns, batch.schema.names)

        return step

    types = dict(source.dtypes)
    out = arrow_map(source, make, ", ".join(f"__c{i} {types[f'__c{i}']}" for i in range(len(names)))).toDF(*names)
    if "n_chars" in names:
        changed = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
    return out.select(*names)
