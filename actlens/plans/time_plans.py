"""Versions, text in force, timelines and validity ends."""

from __future__ import annotations

from pyspark.sql import functions as F

from actlens.operators import relations as R
from actlens.operators import temporal as T
from actlens.plans.base import day, query, table

#: Events as versions: a user is an act, a type a segment, its events in order the versions; changes are the days of events.
_SEG = """
s AS (SELECT user_id AS ato_id, event_type AS id_segmento, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS versao, event_id, value > 150 AS is_omitido FROM events),
ch AS (SELECT user_id AS ato_id, event_type AS id_segmento, row_number() OVER (PARTITION BY user_id, event_type ORDER BY d NULLS LAST, event_id) AS n, d, event_id FROM (SELECT *, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS d FROM events)),
a AS (SELECT DISTINCT user_id AS ato_id, (SELECT min(CAST(ts AS DATE)) FROM events) AS data_publicacao FROM events),
v AS (SELECT s.*, CASE WHEN s.versao = 1 THEN a.data_publicacao ELSE coalesce(ch.d, a.data_publicacao) END AS inicio FROM s JOIN a USING (ato_id) LEFT JOIN ch ON ch.ato_id = s.ato_id AND ch.id_segmento = s.id_segmento AND ch.n + 1 = s.versao)"""


def _parts(spark, sf_dir):
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events")
    order = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    segments = e.select(F.col("user_id").alias("ato_id"), F.col("event_type").alias("id_segmento"), F.row_number().over(order).alias("versao"), "event_id", (F.col("value") > 150).alias("is_omitido"))
    changes = e.select(F.col("user_id").alias("ato_id"), F.col("event_type").alias("id_segmento"), F.when(F.col("event_id") % 11 != 0, day("ts")).alias("data"), F.col("event_id").alias("id"))
    first = e.agg(F.min(day("ts")).alias("data_publicacao"))
    acts = e.select(F.col("user_id").alias("ato_id")).distinct().join(F.broadcast(first))  # one row
    return segments, changes, acts


@query(f"WITH {_SEG.strip()} SELECT ato_id, id_segmento, versao, event_id, inicio FROM v", ("inicio",))
def segment_validity(spark, sf_dir):
    return T.validity(*_parts(spark, sf_dir)).select("ato_id", "id_segmento", "versao", "event_id", "inicio")


def _as_of(spark, sf_dir, mode):
    segments, changes, acts = _parts(spark, sf_dir)
    at = acts.select(F.date_add("data_publicacao", 15).cast("string")).first()[0]
    return T.in_force(T.validity(segments, changes, acts), at, mode).select("ato_id", "id_segmento", "versao", "event_id")


_AT = "inicio <= (SELECT min(CAST(ts AS DATE)) + 15 FROM events)"


@query(f"WITH {_SEG.strip()} SELECT ato_id, id_segmento, max(versao) AS versao, max_by(event_id, versao) AS event_id FROM v WHERE {_AT} AND NOT coalesce(is_omitido, false) GROUP BY 1, 2")
def text_in_force(spark, sf_dir):
    return _as_of(spark, sf_dir, "before_max")


@query(f"WITH {_SEG.strip()}, x AS (SELECT ato_id, id_segmento, max(versao) AS versao, max_by(event_id, versao) AS event_id, max_by(coalesce(is_omitido, false), versao) AS o FROM v WHERE {_AT} GROUP BY 1, 2) SELECT ato_id, id_segmento, versao, event_id FROM x WHERE NOT o")
def text_in_force_after_max(spark, sf_dir):
    return _as_of(spark, sf_dir, "after_max")


@query(f"WITH {_SEG.strip()} SELECT ato_id, id_segmento, max(versao) AS versao, max_by(event_id, versao) AS event_id FROM v WHERE {_AT} GROUP BY 1, 2")
def text_in_force_ignore(spark, sf_dir):
    return _as_of(spark, sf_dir, "ignore")


@query("""
WITH c AS (SELECT l_orderkey AS o, l_partkey AS p, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
SELECT l.l_orderkey AS ato_id, l.l_partkey AS id_segmento, l.l_linenumber AS versao, coalesce(c.n, 0) AS alteracoes
FROM lineitem l LEFT JOIN c ON c.o = l.l_orderkey AND c.p = l.l_partkey WHERE l.l_linestatus = 'O'""")
def current_segments(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    segments = l.select(F.col("l_orderkey").alias("ato_id"), F.col("l_partkey").alias("id_segmento"), F.col("l_linenumber").alias("versao"), (F.col("l_linestatus") == "O").alias("is_compilado"))
    changes = l.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("ato_id"), F.col("l_partkey").alias("id_segmento"))
    return T.current_segments(segments, changes).drop("is_compilado")


@query("""
SELECT l.l_orderkey AS ato_id, l.l_linenumber AS n, CAST(l.l_shipdate AS DATE) AS data, o.o_orderpriority AS alvo, m.o_orderpriority AS modificador
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN orders m ON m.o_orderkey = l.l_partkey * 50""", ("data",))
def evolution(spark, sf_dir):
    l, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    acts = o.select(F.col("o_orderkey").alias("ato_id"), F.col("o_orderpriority").alias("nome"))
    changes = l.select(F.col("l_orderkey").alias("ato_id"), F.col("l_linenumber").alias("n"), day("l_shipdate").alias("data"), (F.col("l_partkey") * 50).alias("modificador_id"))
    return T.evolution(changes, acts, acts).select("ato_id", "n", "data", "alvo", "modificador")


@query("""
SELECT year(o_orderdate) AS ano, count(*) AS atos, round(sum(o_totalprice), 2) AS valor, count(DISTINCT o_custkey) AS clientes FROM orders GROUP BY 1""")
def timeline_by_year(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), day("o_orderdate").alias("data"), "o_totalprice", "o_custkey")
    return T.by_year(o, F.count("*").alias("atos"), F.round(F.sum("o_totalprice"), 2).alias("valor"), F.countDistinct("o_custkey").alias("clientes"))


@query("""
SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS data, year(o_orderdate) AS ano FROM orders
WHERE o_orderpriority LIKE '1%' AND CAST(o_orderdate AS DATE) BETWEEN DATE '2000-02-29' - INTERVAL 60 MONTH AND DATE '2000-02-29' AND o_orderstatus = 'F'""", ("data",))
def timeline_binding(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderpriority like '1%'")
    rows = o.select(F.col("o_orderkey").alias("id"), day("o_orderdate").alias("data"), F.when(F.col("o_orderstatus") == "F", "vinculante_cosit").alias("eficacia"))
    return T.timeline(rows, "2000-02-29").select("id", "data", "ano")


@query("""
WITH i AS (SELECT l_orderkey AS id, l_suppkey AS outro, l_linenumber AS n, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_shipdate AS DATE) END AS efeito, CAST(l_shipdate AS DATE) AS publicacao
  FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'),
s AS (SELECT s_suppkey AS outro, CAST(DATE '1994-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS DATE) AS inicio FROM supplier WHERE s_suppkey % 3 = 0),
j AS (SELECT i.id, i.efeito, coalesce(s.inicio, i.publicacao) AS est, CASE WHEN s.inicio IS NOT NULL THEN 'inicio_vigencia_do_revogador' ELSE 'publicacao_do_revogador' END AS de FROM i LEFT JOIN s USING (outro)),
g AS (SELECT id, min(efeito) AS fim, min(CASE WHEN efeito IS NULL THEN est END) AS e FROM j GROUP BY id),
d AS (SELECT j.id, min(de) AS de FROM j JOIN g ON g.id = j.id AND j.efeito IS NULL AND j.est = g.e GROUP BY j.id)
SELECT g.id, g.fim, CASE WHEN g.fim IS NULL THEN g.e END AS estimativa, CASE WHEN g.fim IS NOT NULL THEN 'data_efeito_portal' ELSE d.de END AS origem FROM g LEFT JOIN d USING (id)""", ("fim", "estimativa"))
def validity_end(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    hint = F.when(F.col("l_linestatus") == "F", "Revogação total").otherwise("Revogação Parcial")
    impacts = l.select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("outro"), F.lit("REV").alias("sigla"), hint.alias("hint"), F.when(F.col("l_linenumber") % 2 == 0, day("l_shipdate")).alias("efeito"), day("l_shipdate").alias("publicacao"))
    starts = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("outro"), F.date_add(F.lit("1994-01-01").cast("date"), (F.col("s_suppkey") % 365).cast("int")).alias("inicio"))
    return R.validity_end(impacts, starts)
