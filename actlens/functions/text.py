"""Text and date expressions; all JVM-side except where a name says udf."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
_PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"
#: HTML entities that occur in portal texts.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&ordm;": "º", "&ordf;": "ª", "&sect;": "§", "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def fold(c: Column) -> Column:
    """Latin letters without their marks; other letters beyond ASCII fall away."""
    return F.regexp_replace(F.translate(c, _ACCENTED, _PLAIN), r"[^\x00-\x7F]", "")


def fold_key(c: Column) -> Column:
    """Lower-case ASCII key with underscores for spaces, hyphens and slashes; '' for null."""
    return F.translate(F.lower(fold(F.trim(F.coalesce(c, F.lit(""))))), " -/", "___")


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """A regular expression's group, null where nothing matches."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def has_text(c: Column) -> Column:
    return F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))


def unescape(c: Column) -> Column:
    """Common entities to characters, the ampersand last."""
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), c)


def squeeze(c: Column) -> Column:
    """Entities undone, no-break spaces and runs of blanks to one blank, ends trimmed."""
    return F.regexp_replace(F.regexp_replace(F.translate(unescape(F.coalesce(c, F.lit(""))), " ", " "), r"[ \t]+", " "), r"^\s+|\s+$", "")


def html_paragraphs(c: Column) -> Column:
    """HTML to lines: breaks and paragraph ends become lines, tags go, at most one empty line stays."""
    x = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?i)<\s*br\s*/?\s*>|</\s*p\s*>", "\n")
    x = F.translate(unescape(F.regexp_replace(x, r"<[^>]+>", "")), " ", " ")
    x = F.regexp_replace(F.regexp_replace(x, r"[ \t]+", " "), r" *\n *", "\n")
    return F.regexp_replace(F.regexp_replace(x, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def slug(c: Column) -> Column:
    return F.regexp_replace(c, r"[^a-zA-Z0-9_-]", "_")


def issuer(c: Column) -> Column:
    """Issuer code: upper case, slashes and blanks to underscores, RFB when blank."""
    return F.coalesce(null_if_empty(F.translate(F.upper(F.trim(c)), "/ ", "__")), F.lit("RFB"))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def date_dmy(c: Column) -> Column:
    """dd/mm/yyyy with or without a time; null for anything else."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("dd/MM/yyyy HH:mm:ss")), F.try_to_timestamp(c, F.lit("dd/MM/yyyy"))).cast("date")


def date_iso(c: Column) -> Column:
    """The first ten characters as an ISO date; null for anything else."""
    head = F.left(c, F.lit(10))
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(head, F.lit("yyyy-MM-dd")).cast("date"))


def shown_date(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "dd/MM/yyyy"), F.lit("?"))


def thousands(c: Column) -> Column:
    """An integer with dots between thousands."""
    return F.replace(F.format_number(c, 0), F.lit(","), F.lit("."))


def tokens(c: Column) -> Column:
    """Letter runs in lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+)"), F.lit(1))


def truncated(c: Column, size: int, mark: str = " [...]") -> Column:
    return F.when(F.length(c) > size, F.concat(F.left(c, F.lit(size)), F.lit(mark))).otherwise(c)


def any_contains(c: Column, words: list[str]) -> Column:
    """How many of the words occur in the lower-cased text."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return reduce(lambda x, w: x + low.contains(w).cast("int"), words, F.lit(0))


def keyword_class(c: Column, forbids: list[str], allows: list[str]) -> Column:
    """VEDADO, AUTORIZADO or CONDICIONADO by keyword counts; '?' for empty texts."""
    v, a = any_contains(c, forbids), any_contains(c, allows)
    return F.when(~has_text(c), "?").when(v > a, "VEDADO").when(a > 0, "AUTORIZADO").otherwise("CONDICIONADO")


def sign_label(c: Column) -> Column:
    """A sign label out of a reply: its first word, else the first label found anywhere, else INDETERMINADO."""
    labels = ["AUTORIZA", "VEDA", "CONDICIONA", "INDETERMINADO"]
    up = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    word = F.regexp_extract(up, r"^\W*(\w+)", 1)
    found = F.when(word.isin(labels), word)
    for label in labels:
        found = F.coalesce(found, F.when(up.contains(label), F.lit(label)))
    return F.coalesce(found, F.lit("INDETERMINADO"))


#: Type codes and their short names.
ACRONYMS = {"SOLUCAO_CONSULTA": "SC", "SOLUCAO_DIVERGENCIA": "SD", "SOLUCAO_CONSULTA_INTERNA": "SCI", "INSTRUCAO_NORMATIVA": "IN", "PARECER_NORMATIVO": "PN", "ATO_DECLARATORIO_EXECUTIVO": "ADE", "ATO_DECLARATORIO_INTERPRETATIVO": "ADI"}


def acronym(c: Column) -> Column:
    return F.coalesce(reduce(lambda x, e: x.when(c == e[0], e[1]), list(ACRONYMS.items())[1:], F.when(c == "SOLUCAO_CONSULTA", "SC")), c)


def first_separator_split(c: Column, separators: list[str]) -> Column:
    """The trimmed, non-empty parts by the first separator of the list that occurs; the whole value if none does."""
    whole = F.array(F.trim(c))
    out = whole
    for s in reversed(separators):
        parts = F.filter(F.transform(F.split(c, "\\Q" + s + "\\E"), F.trim), lambda x: x != "")
        out = F.when(F.instr(c, s) > 0, parts).otherwise(out)
    return out


#: Portuguese words that carry no content, folded.
STOPWORDS = "a ao aos as ate com como da das de dele do dos e ela ele em entre era essa esse esta este eu foi ha isso ja la lhe mais mas me mesmo na nao nas nem no nos o os ou para pela pelo por qual quando que quem se sem ser seu sua tambem te tem um uma voce".split()
#: Endings that the light stemmer takes off, the first that fits and leaves three letters.
ENDINGS = "amentos|imentos|amento|imento|adoras|adores|acoes|idades|ismos|istas|mente|idade|acao|ador|avel|ivel|oes|aes|ais|eis|ois|is|es|as|os|a|o|e|s"


def portuguese_terms(c: Column) -> Column:
    """Folded words without stopwords, cut to light stems: an analyser for the lexical branch of search."""
    words = F.regexp_extract_all(F.lower(fold(c)), F.lit(r"([a-z0-9]+)"), F.lit(1))
    kept = F.filter(words, lambda w: ~w.isin(STOPWORDS))
    return F.transform(kept, lambda w: F.regexp_replace(w, f"^(\\w{{3,}}?)(?:{ENDINGS})$", "$1"))


def recollect_from(last: Column, today: Column, days: int = 10) -> Column:
    """First day of an incremental window: some days before the last one seen, and never after today."""
    return F.date_sub(F.least(last, today), days)


def with_path(payload: Column, path: list[str], value: Column) -> Column:
    """A typed payload (struct) with one field set by path."""
    return payload.withField(".".join(path), value)
