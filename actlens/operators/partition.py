"""Documents into parts: by headings and articles, into outlines and into paragraph chunks.

A text is a row of atoms, each with an offset, an end and a rank: the blocks between empty lines, and, of a block
that is over the limit, its lines, and of such a line its slices. A part is a stretch of the text from the start of
one atom to the end of another, so that nothing in it is changed; only the break at a cut is left out. Parts are cut
one after another: of the atoms that could begin the next part the one of the best rank is taken (a heading, else an
article, else any block, line or slice), of equals the furthest.

The functions work on one text; the frame functions run them over rows in Arrow batches. Null texts count as empty;
an empty text is one empty part, has an empty outline and no chunks.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.functions.arrow import arrow_map, column_of, texts_of

#: Fixed patterns of headings and articles, and the depth of each heading.
HEADING = re.compile(r"^(LIVRO|T[ÍI]TULO|CAP[ÍI]TULO|SUBSE[ÇC][ÃA]O|SE[ÇC][ÃA]O|ANEXO)\s+([IVXLCDM]+|\d+|[ÚU]NIC[OA])\b", re.I)
DEPTH = {"LIVRO": 0, "ANEXO": 0, "TITULO": 1, "CAPITULO": 2, "SECAO": 3, "SUBSECAO": 4}
ARTICLE = re.compile(r"^Art\.\s*(\d+[\w-]*)", re.I)
JOIN = "\n\n"
LIMIT = 60_000
#: Fixed lengths: of a heading's shown lines, and of a block that can be a heading's name.
NAME, TITLE = 60, 200
RANK_HEADING, RANK_ARTICLE, RANK_BLOCK, RANK_LINE, RANK_SLICE = range(5)


class Atom(NamedTuple):
    start: int
    end: int
    rank: int
    #: of a heading its depth and label, of an article its number
    depth: int | None = None
    label: str = ""


def blocks_of(text: str) -> Iterator[tuple[int, str]]:
    """(offset, block) of the blocks between empty lines."""
    at = 0
    for block in text.split(JOIN):
        yield at, block
        at += len(block) + len(JOIN)


def depth_of(word: str) -> int:
    return DEPTH[unicodedata.normalize("NFKD", word).encode("ascii", "ignore").decode().upper()]


def can_be_name(block: str) -> bool:
    return 0 < len(block) <= TITLE and "\n" not in block and not ARTICLE.match(block) and not HEADING.match(block)


def atoms_of(text: str) -> list[Atom]:
    """The blocks of a text with what they begin. A heading's name is its second line, else a short block after it."""
    found: list[Atom] = []
    unnamed = None
    for at, block in blocks_of(text):
        end = at + len(block)
        if unnamed is not None and can_be_name(block.strip()):
            found[unnamed] = found[unnamed]._replace(label=f"{found[unnamed].label} ({block.strip()[:NAME]})")
        unnamed = None
        if heading := HEADING.match(block):
            shown = [x.strip()[:NAME] for x in block.split("\n") if x.strip()][:2]
            if len(shown) == 1:
                unnamed = len(found)
            found.append(Atom(at, end, RANK_HEADING, depth_of(heading[1]), shown[0] + (f" ({shown[1]})" if len(shown) > 1 else "")))
        elif article := ARTICLE.match(block):
            found.append(Atom(at, end, RANK_ARTICLE, None, article[1]))
        else:
            found.append(Atom(at, end, RANK_BLOCK))
    return found


def refined(text: str, atoms: list[Atom], limit: int) -> Iterator[Atom]:
    """Atoms of at most ``limit`` characters: longer blocks by lines, longer lines by slices."""
    for atom in atoms:
        if atom.end - atom.start <= limit:
            yield atom
            continue
        at = atom.start
        for line in text[atom.start : atom.end].split("\n"):
            for k in range(0, max(1, len(line)), limit):
                first = at == atom.start and k == 0
                piece = Atom(at + k, at + min(k + limit, len(line)), RANK_SLICE if k else RANK_LINE)
                yield atom._replace(end=piece.end) if first else piece
            at += len(line) + 1


def stretches(atoms: list[Atom], limit: int) -> Iterator[tuple[int, int]]:
    """(first, end) of the atoms of each part."""
    ends = [a.end for a in atoms]
    first = 0
    while first < len(atoms):
        far = bisect_right(ends, atoms[first].start + limit, first)
        if far < len(atoms):
            # the part after this one begins at one of the atoms up to the first that does not fit
            far = min(range(first + 1, far + 1), key=lambda k: (atoms[k].rank, -k))
        yield first, far
        first = far


def parts(text: str, limit: int = LIMIT) -> list[tuple[str, str, str]]:
    """(label, text, path) of parts up to ``limit`` characters.

    Joining the parts gives the text again, but for the line breaks at cuts inside a block that is itself over the
    limit. The path names the headings in force where a part begins; a text that is one part has none.
    """
    if len(text) <= limit:
        return [("1", text, "")]
    atoms = list(refined(text, atoms_of(text), limit))
    out: list[tuple[str, str, str]] = []
    path: list[Atom] = []
    for first, end in stretches(atoms, limit):
        for k in range(first, end):
            if atoms[k].rank == RANK_HEADING:
                path = [*(h for h in path if h.depth < atoms[k].depth), atoms[k]]
            if k == first:
                shown = " > ".join(h.label for h in path)
        out.append((str(len(out) + 1), text[atoms[first].start : atoms[end - 1].end], shown))
    return out


def outline(text: str) -> str:
    """Headings by depth, each with the first article that follows it."""
    lines: list[str] = []
    article = ""
    for atom in reversed(atoms_of(text)):
        if atom.rank == RANK_ARTICLE:
            article = f" — art. {atom.label}"
        elif atom.rank == RANK_HEADING:
            lines.append("  " * atom.depth + atom.label + article)
    return "\n".join(reversed(lines))


def chunks(text: str, limit: int = 4000, least: int = 30) -> list[str]:
    """Paragraphs gathered up to a size; a longer paragraph is cut; chunks under the least size are left out."""
    pieces = [p[k : k + limit] for p in (x.strip() for _, x in blocks_of(text)) for k in range(0, len(p), limit)]
    out: list[list[str]] = []
    room = 0
    for piece in pieces:
        room -= len(JOIN) + len(piece)
        if not out or room < 0:
            out.append([])
            room = limit - len(piece)
        out[-1].append(piece)
    return [c for c in map(JOIN.join, out) if len(c) >= least]


def halves(text: str, depth: int = 0, least: int = 4000, deepest: int = 3) -> list[tuple[str, str, str]] | None:
    """A part whose reply was cut, as two or more smaller ones; None where it is too small or too deep to split."""
    return None if len(text) < 2 * least or depth >= deepest else parts(text, len(text) // 2 + 1)


def body_without_abstract(text: str) -> str:
    return JOIN.join(b for b in text.split(JOIN) if not b.lstrip().startswith("## EMENTA")).strip()


def abstract_only(text: str, least: int = 200) -> bool:
    """Whether a text holds too little beside its abstract."""
    return len(body_without_abstract(text)) < least


def _rows(df: DataFrame, id_col: str, text_col: str, columns: list[tuple[str, str, pa.DataType]], make: Callable[[str], list[tuple]]) -> DataFrame:
    source = df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [(k, *row) for k, t in enumerate(texts_of(batch, "__text")) for row in make(t)]
            ids = column_of(batch, "__id").take(pa.array([r[0] for r in found], pa.int64()))
            return pa.RecordBatch.from_arrays([ids, *[pa.array([r[c + 1] for r in found], t) for c, (_, _, t) in enumerate(columns)]], ["__id", *[n for n, _, _ in columns]])

        return step

    schema = ", ".join([f"__id {dict(source.dtypes)['__id']}", *[f"{n} {t}" for n, t, _ in columns]])
    return arrow_map(source, start, schema).withColumnRenamed("__id", id_col)


def part_rows(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT) -> DataFrame:
    """(id, rotulo, texto, caminho) of every row's parts."""
    return _rows(df, id_col, text_col, [("rotulo", "string", pa.string()), ("texto", "string", pa.string()), ("caminho", "string", pa.string())], lambda t: parts(t, limit))


def outline_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return _rows(df, id_col, text_col, [("sumario", "string", pa.string())], lambda t: [(outline(t),)])


def chunk_rows(df: DataFrame, id_col: str, text_col: str, limit: int = 4000, least: int = 30) -> DataFrame:
    """(id, seq, texto) of every row's chunks."""
    return _rows(df, id_col, text_col, [("seq", "int", pa.int32()), ("texto", "string", pa.string())], lambda t: list(enumerate(chunks(t, limit, least))))


def decided_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, so_ementa, partes): whether a text is only its abstract, and into how many parts a cut reply splits it."""
    return _rows(df, id_col, text_col, [("so_ementa", "boolean", pa.bool_()), ("partes", "int", pa.int32())], lambda t: [(abstract_only(t), len(halves(t) or [t]))])
