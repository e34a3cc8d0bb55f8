"""Portal pages and views from a landing folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actlens.functions.text import null_if_empty, squeeze
from actlens.operators.views import VIEW


def read_views(spark: SparkSession, path: str) -> DataFrame:
    """Views as JSON documents, one a file; files that do not parse are left out."""
    return spark.read.schema(VIEW).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def listing_rows(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(tipo, numero, orgao, publicacao, ementa, idAto) of the five-column result table of listing pages."""
    table = F.regexp_extract(F.col(html_col), r'(?is)<table[^>]*id="?tabelaAtos"?[^>]*>(.*?)</table>', 1)
    rows = pages.select(F.explode(F.regexp_extract_all(table, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("r"))
    cells = rows.select("r", F.regexp_extract_all("r", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1)).alias("c")).where(F.size("c") >= 5)

    def cell(i: int) -> Column:
        return squeeze(F.regexp_replace(F.get("c", F.lit(i)), r"<[^>]+>", " "))

    return cells.select(*[cell(i).alias(n) for i, n in enumerate(("tipo", "numero", "orgao", "publicacao", "ementa"))], null_if_empty(F.regexp_extract("r", r"idAto=(\d+)", 1)).cast("long").alias("idAto"))


def page_numbers(html: Column) -> Column:
    """Numbers of the listing's pages from its page selector."""
    options = F.regexp_extract(html, r'(?is)<select[^>]*name="?p"?[^>]*>(.*?)</select>', 1)
    return F.transform(F.regexp_extract_all(options, F.lit(r'value="?(\d+)'), F.lit(1)), lambda x: x.cast("int"))


def pdf_link(html: Column, base: Column) -> Column:
    """The first anchor to a PDF: its address ends so, or its text says so; resolved against the page's address."""
    anchors = F.regexp_extract_all(html, F.lit(r'(?is)(<a\s[^>]*href="[^"]*"[^>]*>.*?</a>)'), F.lit(1))
    hit = F.get(F.filter(anchors, lambda a: F.lower(F.regexp_extract(a, r'(?i)href="([^"]*)"', 1)).endswith(".pdf") | F.lower(F.regexp_replace(a, r"<[^>]+>", "")).contains("pdf")), F.lit(0))
    href = F.regexp_extract(hit, r'(?i)href="([^"]*)"', 1)
    root = F.regexp_extract(base, r"^(https?://[^/]+)", 1)
    folder = F.regexp_extract(base, r"^(https?://.*/)", 1)
    return F.when(hit.isNotNull(), F.when(href.rlike("^(?i)https?://"), href).when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(folder, href)))
