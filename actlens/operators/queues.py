"""Work queues, response classes, attempts, budgets and packing."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.functions import scoring
from actlens.functions.text import has_text

RETRIABLE = ["nao_tentado", "erro_http", "erro_rede", "erro_extracao"]
MAX_ATTEMPTS = 4
#: HTTP answers after which another attempt can help.
TRY_AGAIN = [408, 425, 429, 500, 502, 503, 504]


def retry_queue(acts: DataFrame, contents: DataFrame, coleta: DataFrame, as_of: str, limit: int, kinds: list[str] | None = None, year_from: int | None = None, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Acts without text whose collection may be tried again and is due: first kind first, then newest, then id."""
    texts = contents.where(has_text(F.col("texto_completo"))).select(F.col("ato_id").alias("id"))
    rows = acts.join(texts, "id", "left_anti").join(coleta.select(F.col("ato_id").alias("id"), "pdf_status", "proxima_tentativa", "tentativas"), "id", "left")
    rows = rows.where(F.coalesce("pdf_status", F.lit("nao_tentado")).isin(RETRIABLE) & (F.col("proxima_tentativa").isNull() | (F.col("proxima_tentativa") <= F.lit(as_of).cast("timestamp"))) & (F.coalesce("tentativas", F.lit(0)) < max_attempts))
    if kinds:
        rows = rows.where(F.col("tipo_ato").isin(kinds))
    if year_from is not None:
        rows = rows.where(F.col("ano") >= year_from)
    return rows.orderBy((F.col("tipo_ato") == "INSTRUCAO_NORMATIVA").desc(), F.col("data_publicacao").desc_nulls_last(), "id").limit(limit)


def response_class(status: Column, content_type: Column, body: Column) -> Column:
    """State of a fetch: 404 is a fact, 429 a block, other errors and empty bodies are tried again; HTML is no PDF."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    size = F.coalesce(F.octet_length(body), F.lit(0))
    head = F.lower(F.regexp_replace(F.decode(F.substring(body, 1, 200), "iso-8859-1"), r"^\s+", ""))
    pdf = F.coalesce(F.substring(body, 1, 5) == F.lit(b"%PDF-"), F.lit(False)) | kind.contains("application/pdf")
    return (
        F.when(status == 404, "sem_pdf_no_portal")
        .when(status == 429, "bloqueado")
        .when(status >= 400, "erro_http")
        .when(size == 0, "erro_http")
        .when(pdf, "baixado")
        .when(kind.contains("text/html") | head.startswith("<!doctype") | head.startswith("<html"), "sem_pdf_no_portal")
        .otherwise("baixado")
    )


def retriable(state: Column, http_status: Column) -> Column:
    """Whether another attempt can help: after a network error, or an answer of ``TRY_AGAIN``; never null."""
    return F.coalesce((state == "erro_rede") | F.coalesce(http_status.isin(TRY_AGAIN), F.lit(False)), F.lit(False))


def fold_attempts(coleta: DataFrame, results: DataFrame, as_of: str, jitter: float = 0.5) -> DataFrame:
    """Collection state after one attempt per act: counters up, first time kept, next time by backoff where it is worth it.

    ``results`` has (ato_id, pdf_status, url_tentada, http_status, content_type, bytes_baixados, sha256, erro, origem).
    """
    new, old = results.alias("n"), coleta.alias("o")
    now = F.lit(as_of).cast("timestamp")
    both = old.join(new, F.col("o.ato_id") == F.col("n.ato_id"), "full_outer")
    tried = F.col("n.ato_id").isNotNull()
    attempts = F.coalesce("o.tentativas", F.lit(0)) + tried.cast("int")
    wait = scoring.backoff(attempts, F.lit(jitter)).cast("long")
    out = {
        "ato_id": F.coalesce("o.ato_id", "n.ato_id"),
        "tentativas": attempts,
        "primeira_tentativa": F.when(tried, F.coalesce("o.primeira_tentativa", now)).otherwise(F.col("o.primeira_tentativa")),
        "ultima_tentativa": F.when(tried, now).otherwise(F.col("o.ultima_tentativa")),
        "proxima_tentativa": F.when(tried, F.when(retriable(F.col("n.pdf_status"), F.col("n.http_status")), F.timestamp_seconds(F.unix_timestamp(now) + wait))).otherwise(F.col("o.proxima_tentativa")),
    }
    for c in ("pdf_status", "url_tentada", "http_status", "content_type", "bytes_baixados", "sha256", "erro", "origem"):
        out[c] = F.when(tried, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return both.select(*[v.alias(k) for k, v in out.items()])


def realigned(acts: DataFrame, texts: DataFrame) -> DataFrame:
    """Acts with content_disponivel as texts are, and analyses taken back where there is no text."""
    known = texts.where(has_text(F.col("texto_completo"))).select(F.col("ato_id").alias("id"), F.lit(True).alias("__t")).distinct()
    out = acts.join(known, "id", "left").withColumn("content_disponivel", F.coalesce("__t", F.lit(False)))
    return out.withColumn("analise_completa", F.coalesce("analise_completa", F.lit(False)) & F.col("content_disponivel")).drop("__t")


def resolved_url(url_pdf: Column, link: Column, url_html: Column, id_portal: Column, base: str) -> Column:
    """The most trusted http(s) address, else one built from the portal id, else null."""
    found = [F.when(F.trim(c).rlike(r"^(?i)https?://"), F.trim(c)) for c in (url_pdf, link, url_html)]
    return F.coalesce(*found, F.when(id_portal.isNotNull(), F.concat(F.lit(base), id_portal.cast("string"))))


def pending(acts: DataFrame, contents: DataFrame, matters: DataFrame, excluded: list[str] | None = None, kinds: list[str] | None = None) -> DataFrame:
    """Acts with text, without matters and not marked done, in order of publication; optional kinds in or out."""
    texts = contents.where(has_text(F.col("texto_completo"))).select(F.col("ato_id").alias("id"))
    rows = acts.join(texts, "id", "left_semi").join(matters.select(F.col("ato_id").alias("id")), "id", "left_anti").where(~F.col("analise_completa").eqNullSafe(F.lit(True)))
    if kinds:
        rows = rows.where(F.col("tipo_ato").isin(kinds))
    if excluded:
        rows = rows.where(~F.coalesce(F.col("tipo_ato").isin(excluded), F.lit(False)))
    return rows.orderBy(F.col("data_publicacao").desc_nulls_last(), "id")


def not_in_flight(rows: DataFrame, manifests: DataFrame, as_of: str, grace_hours: int = 24) -> DataFrame:
    """Rows whose act is in no open batch; a batch that is still being created counts for the grace time only."""
    open_batch = F.col("estado").isin("enviado", "baixado") | ((F.col("estado") == "criando") & (F.col("criado_em") >= F.lit(as_of).cast("timestamp") - F.expr(f"interval {grace_hours} hours")))
    return rows.join(manifests.where(open_batch).select(F.col("ato_id").alias("id")).distinct(), "id", "left_anti")


def requeued(acts: DataFrame, contents: DataFrame, matters: DataFrame) -> DataFrame:
    """Acts marked as analysed without text; refused for those that have a matter."""
    texts = contents.where(has_text(F.col("texto_completo"))).select(F.col("ato_id").alias("id"))
    found = acts.where(F.coalesce("analise_completa", F.lit(False))).join(texts, "id", "left_anti")
    counts = matters.groupBy(F.col("ato_id").alias("id")).agg(F.count("*").alias("materias"))
    out = found.join(counts, "id", "left").withColumn("materias", F.coalesce("materias", F.lit(0)))
    return out.withColumn("acao", F.when(F.col("materias") > 0, "recusado").otherwise("reenfileirado"))


def next_batch_state(state: Column, finished: Column, complete: Column, manual: Column, asked: Column) -> Column:
    """criando -> enviado -> baixado -> aplicado; incomplete results stay, manual batches are applied only when asked."""
    return F.when((state == "enviado") & finished, "baixado").when((state == "baixado") & complete & (~manual | asked), "aplicado").otherwise(state)


def with_batch_state(manifests: DataFrame, results: DataFrame, asked: bool = False) -> DataFrame:
    """Batch manifests (lote, estado, manual, pedidos) after one round of results (lote, respondidos, terminado)."""
    both = manifests.join(results, "lote", "left")
    complete = F.coalesce(F.col("respondidos") >= F.col("pedidos"), F.lit(False))
    state = next_batch_state(F.col("estado"), F.coalesce("terminado", F.lit(False)), complete, F.coalesce("manual", F.lit(False)), F.lit(asked))
    return both.withColumn("estado", state).select(*manifests.columns)


def _greedy(rows: DataFrame, group: str | list[str], schema: str, step) -> DataFrame:
    return rows.groupBy(*([group] if isinstance(group, str) else group)).applyInPandas(step, schema)


def admit_within_budget(rows: DataFrame, cost: str, order: list[str], budget: float, group: str | list[str]) -> DataFrame:
    """Rows with ``aceito``: taken in order while the running cost fits; what does not fit is skipped, not a stop.

    The choice of a row depends on all before it, so that a group is one task; a sender with a long queue gives a
    second column (a day, a range of ids), and each of its values has the budget. Null costs are never taken.
    """
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", aceito boolean"

    def step(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order, kind="stable")
        spent, taken = 0.0, []
        for c in part[cost]:
            fits = spent + c <= budget
            spent += c if fits else 0.0
            taken.append(fits)
        return part.assign(aceito=taken)

    return _greedy(rows, group, schema, step)


def pack(rows: DataFrame, size: str, order: list[str], limit: int, group: str | list[str], atom: str | None = None) -> DataFrame:
    """Rows with ``bin``: filled in order up to ``limit`` each; rows of one atom stay together; never an empty bin.

    Bins are numbered in each group, which is one task; a group that is too long for one is cut by a second column,
    whose values share no bin.
    """
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", bin int"

    def step(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order, kind="stable")
        units = part.groupby(atom, sort=False)[size].sum() if atom else part[size]
        held, number, bins = 0, 0, []
        for s in units:
            if held and held + s > limit:
                held, number = 0, number + 1
            held += s
            bins.append(number)
        if atom:
            return part.assign(bin=part[atom].map(dict(zip(units.index, bins, strict=True))).astype("int32"))
        return part.assign(bin=pd.array(bins, "int32"))

    return _greedy(rows, group, schema, step)


def call_model(requests: DataFrame, schema: str, model, batch: int = 64) -> DataFrame:
    """Requests answered by an injected callable (pandas frame -> pandas frame) on the workers."""
    requests.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield model(frame)

    return requests.mapInPandas(run, schema)


def request_key(*columns: str) -> Column:
    """Key of a stored reply: the start of the request's hash."""
    return F.left(F.sha2(F.to_json(F.struct(*columns)), 256), F.lit(24))


def unanswered(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Requests whose key has no stored reply, one per key."""
    return requests.dropDuplicates(["chave"]).join(stored.select("chave"), "chave", "left_anti")
