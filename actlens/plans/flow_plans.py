"""Files and sinks, view loads, edges, batches, seeds and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from actlens.operators import coverage as V
from actlens.operators import matters as G
from actlens.operators import merge as M
from actlens.operators import normalize as N
from actlens.operators import partition as P
from actlens.operators import queues as Q
from actlens.operators import relations as R
from actlens.operators import views as W
from actlens.plans.base import query, table
from actlens.sources import tables
from actlens.sources.scratch import Scratch

# --- files


@query("SELECT c_mktsegment AS tipo_ato, c_custkey::VARCHAR AS numero, CAST(1990 + c_nationkey AS INTEGER) AS ano, c_name AS motivo FROM customer")
def landmark_file(spark, sf_dir):
    """Customers written as the semicolon list of landmark acts and read again."""
    c = table(spark, sf_dir, "customer")
    path = f"{Scratch(spark, 'marcos').root}/marcos.csv"
    c.select("c_mktsegment", "c_custkey", (F.col("c_nationkey") + 1990), "c_name").toDF("tipo_ato", "numero", "ano", "motivo").write.option("header", True).option("sep", ";").csv(path)
    return tables.read_landmarks(spark, path)


@query("SELECT 'a' || o_orderkey AS custom_id, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'errored' ELSE 'succeeded' END AS tipo, o_orderkey % 7 = 0 AS quebrada FROM orders WHERE o_orderkey % 7 <> 0 UNION ALL SELECT NULL, NULL, true FROM orders WHERE o_orderkey % 7 = 0")
def reply_file(spark, sf_dir):
    """Batch results as JSON lines, some of them broken."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    whole = F.to_json(F.struct(F.concat(F.lit("a"), k.cast("string")).alias("custom_id"), F.struct(F.when(k % 5 == 0, "errored").otherwise("succeeded").alias("type")).alias("result")))
    path = f"{Scratch(spark, 'respostas').root}/r.jsonl"
    o.select(F.when(k % 7 == 0, F.left(whole, F.lit(12))).otherwise(whole).alias("value")).write.text(path)
    rows = tables.read_replies(spark, path)
    return rows.select("custom_id", F.col("result.type").alias("tipo"), F.col("quebrada").isNotNull().alias("quebrada"))


@query("SELECT o_orderkey AS chave, o_orderpriority AS resposta FROM orders")
def request_file(spark, sf_dir):
    """Requests written as JSON lines and read again as stored replies."""
    path = f"{Scratch(spark, 'pedidos').root}/p"
    tables.write_requests(table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("chave"), F.col("o_orderpriority").alias("resposta")), path)
    return tables.stored_replies(spark, path).select(F.col("chave").cast("long").alias("chave"), "resposta")


@query("SELECT o_orderkey AS id, o_orderstatus AS estado, o_custkey AS cliente FROM orders")
def copied_tables(spark, sf_dir):
    """A copy with renamed columns: begun with a part of the rows, run to its end, and run once more."""
    root = Scratch(spark, "copia").root
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    names = {"id": "o_orderkey", "estado": "o_orderstatus", "cliente": "o_custkey"}
    o.write.parquet(f"{root}/origem/pedidos")
    tables.append(tables.remapped(o.where("o_orderstatus = 'F'"), names), f"{root}/destino/pedidos")
    for _ in range(2):
        tables.copy_tables(spark, f"{root}/origem", f"{root}/destino", {"pedidos": names})
    return spark.read.parquet(f"{root}/destino/pedidos")


# --- portal


def _impacts(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_returnflag") == "R", 3).when(F.col("l_returnflag") == "A", 2).otherwise(9)
    item = F.struct(F.col("l_partkey").alias("idAto"), F.col("l_returnflag").alias("sigla"), kind.alias("corSimbolo"), F.when(F.col("l_linestatus") == "F", "Revogação Parcial").alias("hint"), F.date_format("l_shipdate", "dd/MM/yyyy").alias("dataPublicacaoDMY"), F.lit(None).cast("string").alias("dataVigenciaPrimeiraAnotacao"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("epigrafeBase"))
    rows = l.withColumn("i", item).groupBy(F.col("l_orderkey").alias("id_portal")).agg(F.collect_list(F.when(F.col("l_linenumber") % 2 == 0, F.col("i"))).alias("ativo"), F.collect_list(F.when(F.col("l_linenumber") % 2 == 1, F.col("i"))).alias("passivo"))
    return rows.withColumn("publicacao", F.lit("2000-01-01").cast("date"))


@query("""SELECT CASE WHEN l_linenumber % 2 = 0 THEN l_partkey ELSE l_orderkey END AS origem_portal, CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey ELSE l_partkey END AS destino_portal,
CASE l_returnflag WHEN 'R' THEN 'interrompe' WHEN 'A' THEN 'altera' ELSE 'corSimbolo_9' END AS tipo_relacao, CASE WHEN l_linestatus = 'F' THEN l_returnflag || ': Revogação Parcial' ELSE l_returnflag END AS observacao,
CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_shipdate AS DATE) ELSE DATE '2000-01-01' END AS data_relacao, l_linestatus = 'F' AS parcial, 'P' || l_partkey AS rotulo_outro FROM lineitem WHERE l_partkey <> 0""", ("data_relacao",))
def portal_edges(spark, sf_dir):
    return R.portal_edges(_impacts(spark, sf_dir)).select("origem_portal", "destino_portal", "tipo_relacao", "observacao", "data_relacao", "parcial", "rotulo_outro")


@query("""SELECT o_orderkey AS id_portal, 'SC' AS tipo_ato, o_orderkey::VARCHAR AS numero, year(o_orderdate) AS ano, CASE WHEN o_custkey % 2 = 0 THEN 'COSIT' ELSE 'RFB' END AS emissor, CAST(o_orderdate AS DATE) AS data_publicacao, CASE WHEN o_custkey % 3 = 0 THEN 'da visão' ELSE o_orderpriority END AS ementa FROM orders""", ("data_publicacao",))
def act_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    listing = o.select(F.col("o_orderkey").alias("idAto"), F.lit("SC").alias("tipo"), F.concat(F.lit("nº "), F.col("o_orderkey").cast("string")).alias("numero"), F.when(F.col("o_custkey") % 2 == 0, "Cosit").otherwise("  ").alias("orgao"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("publicacao"), F.col("o_orderpriority").alias("ementa"), F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).alias("dataAto"), F.when(F.col("o_custkey") % 3 == 0, F.array(F.lit("  "), F.lit(" da visão "))).alias("ementas"))
    return R.act_rows(listing)


@query("""
WITH v AS (SELECT l_orderkey AS id, bool_or(l_returnflag <> 'R') AS t FROM lineitem GROUP BY 1)
SELECT o_orderkey AS id, CASE WHEN v.id IS NOT NULL THEN 'vigente_nunca_alterado' ELSE o_orderstatus END AS status_vigencia, o_orderkey % 2 = 0 OR coalesce(v.t, false) AS content_disponivel,
  CASE WHEN v.t THEN 'baixado' WHEN o_orderkey % 3 = 0 THEN 'nao_tentado' END AS pdf_status, CASE WHEN o_orderkey % 3 = 0 THEN 2 WHEN v.t THEN 0 END::INTEGER AS tentativas
FROM orders LEFT JOIN v ON v.id = o_orderkey""")
def view_load(spark, sf_dir):
    """Acts and their collection after views were loaded as one unit, twice."""
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    part = F.struct(F.col("l_partkey").alias("idSegmento"), F.lit(1).alias("versaoSegmento"), F.col("l_linenumber").alias("ordemSegmentoAto"), F.lit("texto").alias("textoIntegra"), (F.col("l_returnflag") == "R").alias("omitir"))
    lines = l.withColumn("s", F.to_json(part)).groupBy("l_orderkey").agg(F.concat_ws(",", F.collect_list("s")).alias("s"))
    views = lines.select(F.from_json(F.concat(F.lit('{"idAto":'), F.col("l_orderkey").cast("string"), F.lit(',"vigente":true,"outrosSegmentos":['), "s", F.lit("]}")), W.VIEW).alias("v")).select("v.*")
    views = Scratch(spark, "visoes").put(views)
    k = F.col("o_orderkey")
    held = {
        "ato": o.select(k.alias("id"), F.col("o_orderstatus").alias("status_vigencia"), (k % 2 == 0).alias("content_disponivel")),
        "ato_coleta": o.where("o_orderkey % 3 = 0").select(k.alias("ato_id"), F.lit("nao_tentado").alias("pdf_status"), F.lit(2).alias("tentativas"), F.lit(None).cast("string").alias("origem")),
        "ato_content": spark.createDataFrame([], "ato_id long, texto_completo string, caracteres int, tipo_versao string"),
        "ato_texto_visao": spark.createDataFrame([], "ato_id long, visao string, sha256 string, texto string"),
        "ato_segmento": W.segments(views).limit(0),
        "ato_alteracao_historico": W.history(views).limit(0),
    }
    for run in ("r1", "r2"):
        held = W.load(views, held, run)
    return held["ato"].join(held["ato_coleta"].select(F.col("ato_id").alias("id"), "pdf_status", "tentativas"), "id", "left")


# --- queues


@query("""SELECT o_orderkey AS id, o_orderstatus <> 'P' AS content_disponivel, o_orderkey % 2 = 0 AND o_orderstatus <> 'P' AS analise_completa FROM orders""")
def realigned_flags(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    acts = o.select(k.alias("id"), (k % 3 == 0).alias("content_disponivel"), (k % 2 == 0).alias("analise_completa"))
    texts = o.select(k.alias("ato_id"), F.when(F.col("o_orderstatus") != "P", "texto").otherwise("  ").alias("texto_completo"))
    return Q.realigned(acts, texts)


@query("""
SELECT o_orderkey AS lote, CASE WHEN o_orderkey % 4 = 0 THEN 'criando' WHEN o_orderkey % 4 = 1 THEN CASE WHEN o_custkey % 2 = 0 THEN 'baixado' ELSE 'enviado' END
  WHEN o_orderkey % 4 = 2 THEN CASE WHEN o_custkey % 3 = 0 AND o_orderstatus <> 'F' THEN 'aplicado' ELSE 'baixado' END ELSE 'aplicado' END AS estado FROM orders""")
def batch_states(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    manifests = o.select(k.alias("lote"), F.get(F.array(*map(F.lit, ("criando", "enviado", "baixado", "aplicado"))), k % 4).alias("estado"), (F.col("o_orderstatus") == "F").alias("manual"), F.lit(10).alias("pedidos"))
    results = o.select(k.alias("lote"), F.when(F.col("o_custkey") % 3 == 0, 10).otherwise(9).alias("respondidos"), (F.col("o_custkey") % 2 == 0).alias("terminado"))
    return Q.with_batch_state(manifests, results).select("lote", "estado")


@query("SELECT o_orderkey AS id, o_orderkey % 2 = 0 AS escrita, CASE WHEN o_orderkey % 2 = 0 THEN 'agora' ELSE 'antes' END AS em FROM orders")
def touched_rows(spark, sf_dir):
    """An upsert that marks the rows it writes."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit(False).alias("escrita"), F.lit("antes").alias("em"))
    rows = o.where("id % 2 = 0").select("id", F.lit(True).alias("escrita"))
    return M.upsert(o, rows, ["id"], touch=("em", F.lit("agora")))


@query("SELECT l_orderkey, l_linenumber, 'delete' AS modo FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' UNION ALL SELECT CASE WHEN o_orderstatus <> 'P' THEN l_orderkey END, l_linenumber, 'set_null' FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey")
def cascades(spark, sf_dir):
    """Order lines after orders of one status were deleted."""
    parents = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    gone, cut = (M.cascaded(l, "l_orderkey", parents, "o_orderkey", a).withColumn("modo", F.lit(a)) for a in ("delete", "set_null"))
    return gone.unionByName(cut)


# --- texts


@query(r"SELECT doc_id, length(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g')) < 200 AS so_ementa, CASE WHEN length(text) >= 8000 THEN 'dividir' ELSE 'manter' END AS ao_truncar FROM documents")
def truncation(spark, sf_dir):
    """What is done with a part whose reply was cut, and whether a text is only its abstract."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("t"))
    rows = P.decided_rows(d, "doc_id", "t")
    return rows.select("doc_id", "so_ementa", F.when(F.col("partes") > 1, "dividir").otherwise("manter").alias("ao_truncar"))


@query("SELECT p_partkey AS ato_id, 1 AS ordem, CASE WHEN p_size % 2 = 0 THEN '01.1' ELSE '99' END AS cnae_codigo, CASE WHEN p_size % 2 = 0 THEN p_name END AS descricao FROM part")
def matter_cnaes(spark, sf_dir):
    """Activity codes of matters: blank ones left out, repeated ones once."""
    p = table(spark, sf_dir, "part")
    code = F.struct(F.when(F.col("p_size") % 2 == 0, "01.1").otherwise("99").alias("codigo"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).alias("descricao"))
    matter = F.struct(F.lit("x").alias("solucao"), F.array(code, code, F.struct(F.lit("  ").alias("codigo"), F.lit("nada").alias("descricao"))).alias("cnaes_aplicaveis"))
    reply = F.to_json(F.struct(F.struct(F.lit("v").alias("eficacia")).alias("ato_metadata"), F.array(matter).alias("materias")))
    rows = G.parsed(p.select(F.col("p_partkey").alias("ato_id"), F.lit(1).alias("parte"), reply.alias("r")), "r")
    return G.matter_rows(G.merged(rows.select("ato_id", "parte", "saida")), N.alias_table(spark, {"temas_macro": {"_canonicos": ["X"]}}))["materia_cnae"].select("ato_id", "ordem", "cnae_codigo", "descricao")


# --- vocabularies and statistics


@query("SELECT p_partkey::VARCHAR AS codigo, CASE WHEN p_partkey % 2 = 0 THEN 'novo' ELSE p_name END AS nome, CASE WHEN p_partkey % 5 = 0 THEN '{\"x\":1}' END AS schema_tematico FROM part")
def taxonomy_seed(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("codigo"), F.col("p_name").alias("nome"), F.lit(None).cast("string").alias("schema_tematico"))
    seed = p.where("cast(codigo as long) % 2 = 0").select("codigo", F.lit("novo").alias("nome"))
    files = p.where("cast(codigo as long) % 5 = 0").select(F.concat(F.lit("/s/"), "codigo", F.lit(".json")).alias("path"), F.lit('{"x":1}').alias("content"))
    return N.with_schemas(N.seeded({"temas": p}, {"temas": seed})["temas"], files)


@query("SELECT count(*) AS n, count(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS com_vetor, round(100.0 * count(CASE WHEN l_returnflag <> 'R' THEN 1 END) / count(*), 1)::DOUBLE AS pct FROM lineitem")
def vector_coverage(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return V.vector_coverage(l.select(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("embedding")))


@query("SELECT l_returnflag AS tipo_relacao, count(*) AS n, count(DISTINCT l_orderkey) AS origens, count(*) FILTER (l_linestatus = 'O') AS pendentes FROM lineitem GROUP BY 1")
def graph_statistics(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return V.graph_statistics(l.select(F.col("l_returnflag").alias("tipo_relacao"), F.col("l_orderkey").alias("ato_origem_id"), F.when(F.col("l_linestatus") != "O", F.col("l_partkey")).alias("ato_destino_id")))
