"""Single relational constructs, parity, runs, sources and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from actlens.functions import text as X
from actlens.functions.text import has_text
from actlens.operators import merge as M
from actlens.operators import queues as Q
from actlens.operators import runs as N
from actlens.operators import search as S
from actlens.plans.base import day, query, table
from actlens.sources import portal, tables
from actlens.sources.scratch import shared_dir
from actlens.sources.store import Store
from actlens.streaming import stream


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus IS DISTINCT FROM 'F' AND o_totalprice > 100000")
def filter_membership(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW") & ~F.col("o_orderstatus").eqNullSafe(F.lit("F")) & (F.col("o_totalprice") > 100000)).select("o_orderkey")


@query("SELECT p_partkey FROM part WHERE (p_name ILIKE '%RED%' OR p_name ILIKE 'small%') AND p_type LIKE 'E%' AND NOT regexp_matches(p_brand, '#1\\d$')")
def filter_patterns(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "part").where((c("p_name").ilike("%RED%") | c("p_name").ilike("small%")) & c("p_type").like("E%") & ~c("p_brand").rlike(r"#1\d$")).select("p_partkey")


@query("""SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS com_f FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 490000)""")
def exists_and_not_exists(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    kept = c.join(o.where("o_totalprice > 490000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    f = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("com_f", F.lit(True))
    return kept.join(f, "c_custkey", "left").select("c_custkey", F.coalesce("com_f", F.lit(False)).alias("com_f"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 8 = 3 AND length(trim(o_orderpriority)) > 0")
def hash_shard(spark, sf_dir):
    return tables.shard(table(spark, sf_dir, "orders"), "o_orderkey", 8, 3).where(has_text(F.col("o_orderpriority"))).select("o_orderkey")


@query("SELECT o_orderkey, NULL::VARCHAR AS coluna_ausente, o_orderstatus AS presente FROM orders")
def adaptive_columns(spark, sf_dir):
    o = table(spark, sf_dir, "orders")

    def maybe(name: str, out: str):
        return (F.col(name) if name in o.columns else F.lit(None).cast("string")).alias(out)

    return o.select("o_orderkey", maybe("o_nothing", "coluna_ausente"), maybe("o_orderstatus", "presente"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS fornecedores, max(l_quantity) AS maior, round(sum(CASE WHEN l_discount > 0.05 THEN l_extendedprice ELSE 0 END), 2) AS com_desconto, count(*) FILTER (l_tax = 0) AS sem_taxa
FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 3""")
def grouped_aggregates(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.countDistinct("l_suppkey").alias("fornecedores"), F.max("l_quantity").alias("maior"), F.round(F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice")).otherwise(0)), 2).alias("com_desconto"), F.count_if(F.col("l_tax") == 0).alias("sem_taxa")).where("n >= 3")


@query("""SELECT o_orderkey, coalesce((SELECT round(sum(CASE l_returnflag WHEN 'R' THEN 0.1 WHEN 'A' THEN 0.08 ELSE 0 END), 4) FROM lineitem WHERE l_orderkey = o_orderkey), 0)::DOUBLE AS peso FROM orders""")
def scalar_subquery(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    w = l.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum(F.when(F.col("l_returnflag") == "R", 0.1).when(F.col("l_returnflag") == "A", 0.08).otherwise(0.0)), 4).alias("peso"))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(w, "o_orderkey", "left").select("o_orderkey", F.coalesce("peso", F.lit(0.0)).alias("peso"))


@query("""
WITH a AS (SELECT o_custkey, count(*) AS pedidos, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) FILTER (o_totalprice > 300000) AS caros FROM orders GROUP BY 1),
b AS (SELECT o_custkey, count(*) AS itens FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT c_custkey, coalesce(a.pedidos, 0) AS pedidos, a.caros, coalesce(b.itens, 0) AS itens FROM customer LEFT JOIN a ON a.o_custkey = c_custkey LEFT JOIN b ON b.o_custkey = c_custkey""")
def act_summary(spark, sf_dir):
    """Children are aggregated before they are joined, so that two of them do not multiply."""
    c, o, l = (table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem"))
    dear = F.array_sort(F.collect_set(F.when(F.col("o_totalprice") > 300000, F.col("o_orderpriority"))))
    a = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("pedidos"), dear.alias("d")).withColumn("caros", F.when(F.size("d") > 0, F.array_join("d", ","))).drop("d")
    b = l.select("l_orderkey").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("itens"))
    return c.select("c_custkey").join(a, "c_custkey", "left").join(b, "c_custkey", "left").fillna(0, ["pedidos", "itens"]).select("c_custkey", "pedidos", "caros", "itens")


@query("""SELECT o_custkey, to_json({{'n': count(*), 'estados': list_sort(list(DISTINCT o_orderstatus))}})::VARCHAR AS meta FROM orders GROUP BY 1""".replace("{{", "{").replace("}}", "}"))
def nested_json(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("o_orderstatus")).alias("estados"))
    return o.select("o_custkey", F.to_json(F.struct("n", "estados")).alias("meta"))


@query("SELECT o_orderstatus, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1)::DOUBLE AS pct FROM orders GROUP BY 1")
def percent_of_total(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    total = o.agg(F.sum("n").alias("t"))
    return o.join(F.broadcast(total)).select("o_orderstatus", "n", F.round(F.lit(100.0) * F.col("n") / F.col("t"), 1).alias("pct"))  # one row


@query("""SELECT c_custkey, o_orderkey FROM customer FULL JOIN (SELECT * FROM orders WHERE o_totalprice > 480000) o ON o.o_custkey = c_custkey AND c_acctbal > 0""")
def full_outer(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_totalprice > 480000").select("o_custkey", "o_orderkey")
    return table(spark, sf_dir, "customer").join(o, (F.col("o_custkey") == F.col("c_custkey")) & (F.col("c_acctbal") > 0), "full_outer").select("c_custkey", "o_orderkey")


@query("""SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority LIKE '1%') o ON o.o_custkey = c_custkey""")
def left_outer(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderpriority like '1%'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return table(spark, sf_dir, "customer").select("c_custkey").join(o, "c_custkey", "left")


@query("""SELECT n_name, r_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2""")
def four_way_join(spark, sf_dir):
    o, c, n, r = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    j = o.join(c, F.col("c_custkey") == F.col("o_custkey")).join(n, F.col("n_nationkey") == F.col("c_nationkey")).join(r, F.col("r_regionkey") == F.col("n_regionkey"))
    return j.groupBy("n_name", "r_name").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END ASC NULLS LAST, o_orderkey) AS k FROM orders")
def ranked_versions(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    w = Window.partitionBy("o_custkey").orderBy(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")).asc_nulls_last(), "o_orderkey")
    return o.select("o_custkey", "o_orderkey", F.row_number().over(w).alias("k"))


@query("SELECT o_orderkey FROM orders ORDER BY (o_orderpriority = '1-URGENT') DESC, o_orderdate DESC NULLS LAST, o_orderkey LIMIT 100")
def top_by_keys(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy((F.col("o_orderpriority") == "1-URGENT").desc(), F.col("o_orderdate").desc_nulls_last(), "o_orderkey").limit(100).select("o_orderkey")


@query("""SELECT 'uniao' AS op, c FROM (SELECT c_nationkey AS c FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'intersecao', c FROM (SELECT c_nationkey AS c FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'diferenca', c FROM (SELECT c_nationkey AS c FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_suppkey < 20)""")
def set_operations(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("c")), table(spark, sf_dir, "supplier")
    k = s.select(F.col("s_nationkey").alias("c"))
    few = s.where("s_suppkey < 20").select(F.col("s_nationkey").alias("c"))
    parts = {"uniao": c.union(k).distinct(), "intersecao": c.intersect(k), "diferenca": c.subtract(few)}
    out = None
    for name, df in parts.items():
        df = df.select(F.lit(name).alias("op"), "c")
        out = df if out is None else out.unionAll(df)
    return out


@query("SELECT l_suppkey, arg_min(l_orderkey, l_orderkey) AS primeiro FROM lineitem GROUP BY 1")
def first_match(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.min("l_orderkey").alias("primeiro"))


@query("SELECT l_orderkey, CAST(least(max(CAST(l_shipdate AS DATE)), DATE '2000-06-30') - 10 AS DATE) AS desde FROM lineitem GROUP BY 1", ("desde",))
def incremental_window(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max(day("l_shipdate")).alias("u"))
    return l.select("l_orderkey", X.recollect_from(F.col("u"), F.lit("2000-06-30").cast("date")).alias("desde"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, user_id AS dono, event_type AS tipo FROM events")
def json_set(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("p", F.from_json("props", "k long, meta struct<dono:long>"))
    e = e.withColumn("p", X.with_path(F.col("p").withField("meta", F.struct(F.lit(0).cast("long").alias("dono"))), ["meta", "dono"], F.col("user_id")).withField("tipo", F.col("event_type")))
    return e.select("event_id", "p.k", F.col("p.meta.dono").alias("dono"), "p.tipo")


@query("SELECT doc_id, true AS lido FROM documents WHERE doc_id % 3 <> 0")
def optimistic_check(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    seen = d.select("doc_id", F.sha2(F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")), 256).alias("sha256"))
    return M.unchanged_since(d, seen, ["doc_id"], "text").select("doc_id", F.lit(True).alias("lido"))


@query("""WITH k AS (SELECT DISTINCT o_custkey % 500 AS c, o_orderpriority AS p FROM orders) SELECT count(*) AS pedidos FROM k WHERE NOT (c < 250 AND p LIKE '1%')""")
def unanswered_requests(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 500).alias("c"), F.col("o_orderpriority").alias("p")).withColumn("chave", Q.request_key("c", "p"))
    return Q.unanswered(o, o.where("c < 250 and p like '1%'").select("chave")).agg(F.count("*").alias("pedidos"))


@query("""SELECT c_custkey AS id, c_custkey AS id_portal, CASE WHEN c_custkey % 4 = 0 THEN 'NOVO' || c_custkey ELSE 'E' || c_nationkey END AS emissor, CASE WHEN c_custkey % 2 = 0 THEN coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_name END, 'novo') WHEN c_custkey % 3 = 0 THEN c_name END AS ementa FROM customer""")
def create_or_complete(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    acts = c.select(k.alias("id"), k.alias("id_portal"), F.concat(F.lit("E"), F.col("c_nationkey").cast("string")).alias("emissor"), F.when(k % 3 == 0, F.col("c_name")).alias("ementa"))
    rows = c.where("c_custkey % 2 = 0").select(k.alias("id_portal"), F.when(k % 4 == 0, F.concat(F.lit("NOVO"), k.cast("string"))).otherwise(F.concat(F.lit("E"), F.col("c_nationkey").cast("string"))).alias("emissor"), F.lit("novo").alias("ementa"))
    return M.create_or_complete(acts, rows, ["emissor"])


#: the analyser in SQL: folded words without stopwords, cut to light stems
_PT = f"""list_transform(list_filter(regexp_extract_all(lower(regexp_replace(translate(text, '{X._ACCENTED}', '{X._PLAIN}'), '[^\\x00-\\x7F]', '', 'g')), '[a-z0-9]+'),
  lambda w: NOT list_contains({X.STOPWORDS!r}, w)), lambda w: regexp_replace(w, '^(\\w{{3,}}?)(?:{X.ENDINGS})$', '\\1'))"""


@query(f"""
WITH c AS (SELECT doc_id AS id, len(t) AS n, len(list_filter(t, lambda x: x = 'the')) AS f0, len(list_filter(t, lambda x: x = 'and')) AS f1 FROM (SELECT doc_id, {_PT} AS t FROM documents)),
s AS (SELECT count(*) AS nd, avg(n) AS av, count(*) FILTER (f0 > 0) AS d0, count(*) FILTER (f1 > 0) AS d1 FROM c),
b AS (SELECT id, round(
    ln(1.0 + (nd - d0 + 0.5) / (d0 + 0.5)) * f0 * 2.2 / (f0 + 1.2 * (0.25 + 0.75 * n / av)) +
    ln(1.0 + (nd - d1 + 0.5) / (d1 + 0.5)) * f1 * 2.2 / (f1 + 1.2 * (0.25 + 0.75 * n / av)), 9) AS sc
  FROM c, s WHERE f0 > 0 AND f1 > 0)
SELECT id, CAST(row_number() OVER (ORDER BY sc DESC, id) AS INTEGER) AS pos FROM b QUALIFY pos <= 20""")
def portuguese_search(spark, sf_dir):
    """The lexical branch with the light Portuguese analyser."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body"))
    return S.lexical(d, ["the", "and"], "id", "body", 20, X.portuguese_terms)


# --- parity and runs


@query("SELECT unnest(['orders', 'customer']) AS tabela, unnest([(SELECT count(*) FROM orders), (SELECT count(*) FROM customer)]) AS origem, unnest([(SELECT count(*) FROM orders WHERE o_orderkey > 10), (SELECT count(*) FROM customer)]) AS destino, unnest([(SELECT count(*) FROM orders WHERE o_orderkey <= 10) = 0, true]) AS ok")
def parity(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return N.parity({"orders": o, "customer": c}, {"orders": o.where("o_orderkey > 10"), "customer": c})


@query("SELECT 'item sem pedido' AS regra, count(*) AS orfaos FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0) UNION ALL SELECT 'pedido sem cliente', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def orphans(spark, sf_dir):
    l, o, c = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    return N.orphans({"item sem pedido": (l, "l_orderkey", o.where("o_orderkey % 9 <> 0"), "o_orderkey"), "pedido sem cliente": (o, "o_custkey", c, "c_custkey")})


@query("SELECT o_orderstatus AS valor, count(*) AS n, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END::BIGINT AS esperado, false AS ok FROM orders GROUP BY 1")
def distribution_parity(spark, sf_dir):
    return N.distribution_matches(table(spark, sf_dir, "orders"), "o_orderstatus", {"F": 1})


def _runs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    begin = F.timestamp_seconds(F.lit(946684800) + k * 3600)
    return o.select(F.concat(F.lit("r"), k.cast("string")).alias("run_id"), begin.alias("inicio"), F.timestamp_seconds(F.lit(946684800) + k * 3600 + (k % 50) * 30).alias("fim"), F.when(k % 3 == 0, "ok").otherwise("com_erro").alias("estado"), (k % 7).cast("int").alias("erros_coleta"), (k % 5).cast("int").alias("erros_categorizacao"), (k % 4).cast("int").alias("lotes_enviados"), k.cast("int").alias("atos_coletados"), k.cast("int").alias("atos_categorizados"), k.cast("int").alias("materias_gravadas"), k.cast("int").alias("para_revisao"))


@query("SELECT 'r' || o_orderkey AS run_id, round((o_orderkey % 50) * 30 / 60.0, 1)::DOUBLE AS minutos, CAST(o_orderkey % 7 + o_orderkey % 5 AS INTEGER) AS erros FROM orders ORDER BY o_orderkey DESC LIMIT 14")
def run_metrics(spark, sf_dir):
    return N.numbers(_runs(spark, sf_dir)).select("run_id", "minutos", "erros")


@query("SELECT 'r' || o_orderkey AS run_id, CASE WHEN o_orderkey % 3 = 0 THEN 'ok' ELSE 'com_erro' END || ' · ' || o_orderkey || ' coletados · ' || o_orderkey || ' categorizados · ' || o_orderkey || ' matérias · ' || o_orderkey || ' para revisão' AS mensagem FROM orders")
def run_messages(spark, sf_dir):
    return N.message(_runs(spark, sf_dir))


@query("""SELECT (SELECT max(946684800 + o_orderkey * 3600) FROM orders WHERE o_orderkey % 3 = 0) < epoch(TIMESTAMP '2000-03-01') - 26 * 3600 AS atrasada,
count(*) FILTER (o_orderkey % 3 = 0) = 0 AS rodar, coalesce(sum(o_orderkey % 4), 0) = 0 AS enviar_lote FROM orders WHERE o_orderkey BETWEEN 24 AND 47""")
def run_lateness(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    return N.late(runs, "2000-03-01").select("atrasada").join(N.needs_second_attempt(runs, "2000-01-02"))  # one row each


# --- sources


@query("SELECT page_id, url || '/doc.pdf' AS link FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) || '/a/b' FROM pages WHERE page_id % 2 = 1")
def pdf_links(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    html = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit('<a href="/x">x</a><a class="k" href="'), "url", F.lit('/doc.pdf">baixar</a>'))).otherwise('<p><a href="/a/b">Versão em <b>PDF</b></a>')
    return p.select("page_id", portal.pdf_link(html, F.col("url")).alias("link"))


@query("SELECT 'SC' AS tipo, o_orderkey::VARCHAR AS numero, 'RFB' AS orgao, '01/02/2003' AS publicacao, 'E & ' || o_orderpriority AS ementa, o_orderkey AS \"idAto\" FROM orders")
def listing_scan(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    row = F.concat(F.lit('<tr><td>SC</td><td><a href="ato?idAto='), F.col("o_orderkey").cast("string"), F.lit('">'), F.col("o_orderkey").cast("string"), F.lit("</a></td><td> RFB</td><td>01/02/2003</td><td>E &amp;  "), "o_orderpriority", F.lit("</td></tr>"))
    pages = o.groupBy(F.expr("o_orderkey div 100").alias("pagina")).agg(F.concat(F.lit('<html><table id="tabelaAtos"><tr><th>x</th></tr>'), F.concat_ws("\n", F.collect_list(row)), F.lit("</table>")).alias("html"))
    return portal.listing_rows(pages)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0")
def resumable_copy(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return tables.missing_rows(o, o.where("o_orderkey % 10 = 0"), ["o_orderkey"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-05')")
def high_water_copy(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return tables.after_mark(o, o.where("o_orderdate < timestamp '1995-01-05'"), "o_orderkey").select("o_orderkey")


# --- streams: our extension, checked against the same query over the table


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS inicio, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2", ("inicio",))
def event_windows(spark, sf_dir):
    return stream.windows(table(spark, sf_dir, "events"), "ts", "event_type", "1 hour").withColumn("total", F.round("total", 4))


@query("SELECT user_id, event_type, max_by(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY 1, 2")
def stream_upsert(spark, sf_dir):
    """The events as a stream of files, merged into a table by user and type; the latest event wins."""
    root = f"{shared_dir(spark)}/stream-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "event_id")
    e.repartition(3).write.parquet(f"{root}/landing")
    schema = "user_id long, event_type string, value double, event_id long"
    rows = stream.read_stream(spark, f"{root}/landing", schema, files=1)
    stream.run_once(rows, stream.upsert_sink(f"{root}/table", ["user_id", "event_type"], "event_id"), f"{root}/state")
    return Store(spark, f"{root}/table", ["user_id", "event_type"], rows.schema).read()
