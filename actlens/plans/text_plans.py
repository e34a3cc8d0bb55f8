"""Texts, dates, JSON, vocabularies, parts, replies, gates and dossiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from actlens.functions import text as X
from actlens.operators import dossier as D
from actlens.operators import matters as G
from actlens.operators import normalize as N
from actlens.operators import partition as P
from actlens.operators import views as W
from actlens.plans.base import query, table

#: The values that these queries name.
VOCABULARY = {
    "tributos": {"_canonicos": ["IRPJ", "CSLL", "PIS", "COFINS", "ISS", "GILRAT", "EMPRESTIMO_COMPULSORIO"], "_aliases": {"PIS": ["PASEP", "PIS-PASEP"], "COFINS": ["FINSOCIAL"], "CSLL": ["CSL"], "ISS": ["ISSQN"], "GILRAT": ["RAT"]}, "_rejeitar_valores": ["IN", "FGTS"]},
    "temas_macro": {"_canonicos": ["CREDITAMENTO"], "_aliases": {"CREDITAMENTO": ["CREDITAMENTE"]}},
    "regimes_tributarios": {"_canonicos": ["nao_cumulativo"], "_aliases": {"nao_cumulativo": ["não-cumulativo"]}},
}
_HTML = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate({e}, chr(160), ' '), '[ \t]+', ' ', 'g'), ' *\n *', E'\n', 'g'), '\n{{3,}}', E'\n\n', 'g'), '^\s+|\s+$', '', 'g')"""
_TAGS = r"""regexp_replace(regexp_replace(coalesce(html, ''), '(?i)<\s*br\s*/?\s*>|</\s*p\s*>', E'\n', 'g'), '<[^>]+>', '', 'g')"""
_UNESCAPED = _TAGS
for _entity, _char in X.ENTITIES.items():
    _UNESCAPED = f"replace({_UNESCAPED}, '{_entity}', '{_char.replace(chr(39), chr(39) * 2)}')"


@query(f"SELECT page_id, {_HTML.format(e=_UNESCAPED)} AS texto FROM pages")
def html_paragraphs(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.html_paragraphs(F.col("html")).alias("texto"))


@query("SELECT doc_id, sha256(text) AS sha, substr(sha256(text), 1, 24) AS chave FROM documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.left(F.sha2("text", 256), F.lit(24)).alias("chave"))


@query(r"SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9_-]', '_', 'g') AS nome, NULLIF(regexp_extract(url, '/(\d+)', 1), '') AS numero, lpad(CAST(page_id // 1000 AS VARCHAR), 4, '0') || '/' || page_id || '.pdf' AS caminho FROM pages")
def slug_and_path(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    path = F.concat(F.lpad(F.floor(F.col("page_id") / 1000).cast("string"), 4, "0"), F.lit("/"), F.col("page_id").cast("string"), F.lit(".pdf"))
    return p.select("page_id", X.slug(F.col("url")).alias("nome"), X.first_match(F.col("url"), r"/(\d+)").alias("numero"), path.alias("caminho"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) END AS dmy, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS iso, strftime(o_orderdate, '%d/%m/%Y') AS mostrada FROM orders""", ("dmy", "iso"))
def date_parsing(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 4
    dmy = F.when(k == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(k == 1, F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss")).when(k == 2, "31/02/2020").otherwise("")
    iso = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).otherwise("2020-13-01")
    return o.select("o_orderkey", X.date_dmy(dmy).alias("dmy"), X.date_iso(iso).alias("iso"), X.shown_date(F.col("o_orderdate")).alias("mostrada"))


@query("""SELECT doc_id, CASE WHEN v > a THEN 'VEDADO' WHEN a > 0 THEN 'AUTORIZADO' ELSE 'CONDICIONADO' END AS classe FROM (
SELECT doc_id, contains(lower(text), 'scum')::INT + contains(lower(text), 'worthless')::INT + contains(lower(text), 'disgusting')::INT AS v, contains(lower(text), 'license')::INT + contains(lower(text), 'with')::INT AS a FROM documents)""")
def keyword_class(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.keyword_class(F.col("text"), ["scum", "worthless", "disgusting"], ["license", "with"]).alias("classe"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'AUTORIZA' WHEN 1 THEN 'VEDA' WHEN 2 THEN 'CONDICIONA' WHEN 3 THEN 'AUTORIZA' WHEN 4 THEN 'VEDA' ELSE 'INDETERMINADO' END AS sinal,
CASE WHEN p_size % 3 = 0 THEN 'RFB' ELSE replace(replace(upper(p_name), '/', '_'), ' ', '_') END AS emissor FROM part""")
def sign_and_issuer(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 6
    reply = F.when(k == 0, "autoriza.").when(k == 1, F.concat(F.lit("VEDA - "), "p_name")).when(k == 2, " Condiciona").when(k == 3, "o ato autoriza o crédito").when(k == 4, "sinal: veda").otherwise("nada disso")
    return p.select("p_partkey", X.sign_label(reply).alias("sinal"), X.issuer(F.when(F.col("p_size") % 3 == 0, "  ").otherwise(F.col("p_name"))).alias("emissor"))


@query("""SELECT o_orderkey, substr('SOLUCAO', 1, 0) || CASE o_orderpriority WHEN '1-URGENT' THEN 'SC' WHEN '2-HIGH' THEN 'IN' ELSE o_orderpriority END AS sigla, replace(format('{:,}', CAST(floor(o_totalprice) AS BIGINT)), ',', '.') AS valor,
CASE WHEN length(o_orderpriority) > 6 THEN substr(o_orderpriority, 1, 6) || ' [...]' ELSE o_orderpriority END AS cortado FROM orders""")
def acronyms_and_numbers(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "SOLUCAO_CONSULTA").when(F.col("o_orderpriority") == "2-HIGH", "INSTRUCAO_NORMATIVA").otherwise(F.col("o_orderpriority"))
    return o.select("o_orderkey", X.acronym(kind).alias("sigla"), X.thousands(F.floor("o_totalprice")).alias("valor"), X.truncated(F.col("o_orderpriority"), 6).alias("cortado"))


@query("""SELECT doc_id, left(concat_ws(' || ', NULLIF(trim(source), ''), CASE WHEN lang <> 'en' THEN lang END, substr(text, 1, 200)), 120) AS t FROM documents""")
def embedding_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.left(F.concat_ws(" || ", X.null_if_empty(F.trim("source")), F.when(F.col("lang") != "en", F.col("lang")), F.left("text", F.lit(200))), F.lit(120)).alias("t"))


# --- JSON


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.k') AS k_texto, json_extract(props, '$.z') IS NOT NULL AS tem_z FROM events""")
def json_props(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("v", F.parse_json("props"))
    return e.select("event_id", F.variant_get("v", "$.k", "int").alias("k"), F.variant_get("v", "$.k", "string").alias("k_texto"), F.variant_get("v", "$.z", "string").isNotNull().alias("tem_z"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'click' ELSE CAST(json_extract(props, '$.k') AS VARCHAR) END AS k, event_type AS tipo, event_id % 3 = 0 AS tem_x FROM events""")
def json_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    base = F.from_json("props", "map<string,string>")
    extra = F.map_from_arrays(F.array(F.lit("tipo")), F.array("event_type"))
    over = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("k"), F.lit("click"))).otherwise(F.create_map().cast("map<string,string>"))
    mark = F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("x"), F.lit("1"))).otherwise(F.create_map().cast("map<string,string>"))
    # shallow merge, later keys win: what is overridden is removed first
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k))
    m = F.map_concat(kept, over, extra, mark)
    return e.withColumn("m", m).select("event_id", F.element_at("m", "k").alias("k"), F.element_at("m", "tipo").alias("tipo"), F.map_contains_key("m", "x").alias("tem_x"))


@query("""SELECT conv_id, string_agg(DISTINCT role, ',' ORDER BY role) AS papeis, min_by(role, turn) AS primeiro, count(DISTINCT role) > 1 AS diverge, count(*) AS partes FROM conversations GROUP BY conv_id""")
def part_merge(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("papeis"), F.min_by("role", "turn").alias("primeiro"), (F.countDistinct("role") > 1).alias("diverge"), F.count("*").alias("partes"))


def _replies(spark, sf_dir):
    """Replies made of parts: fenced, plain, broken, without matters, without themes."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 5
    good = F.concat(F.lit('{"ato_metadata":{"eficacia":"'), "p_type", F.lit('"},"materias":[{"ordem":1,"tema_macro":"'), F.when(F.col("p_size") % 2 == 0, "CREDITAMENTE").otherwise("XYZ"), F.lit('","solucao":"sim","tributos":[{"codigo":"PASEP","regime":"não-cumulativo"},{"codigo":"IN"},{"codigo":"'), F.when(F.col("p_size") % 3 == 0, "COFINS").otherwise("ISSQN"), F.lit('"}],"dispositivos_do_ato":[{"artigo":"3º","inciso":"II"}]}]}'))
    reply = F.when(k == 0, F.concat(F.lit("```json\n"), good, F.lit("\n```"))).when(k == 1, good).when(k == 2, "sem resposta").when(k == 3, '{"ato_metadata":{}}').otherwise('{"materias":[{"ordem":1,"solucao":"x"}]}')
    return p.select(F.col("p_partkey").alias("ato_id"), F.lit(1).alias("parte"), reply.alias("resposta"), "p_size", "p_type")


@query("""SELECT p_partkey AS ato_id, CASE p_partkey % 5 WHEN 2 THEN 'sem objeto JSON' WHEN 3 THEN 'materias ausente' WHEN 4 THEN 'materia sem tema' ELSE '' END AS erros FROM part""")
def reply_validation(spark, sf_dir):
    return G.parsed(_replies(spark, sf_dir), "resposta").select("ato_id", F.array_join("erros", ",").alias("erros"))


@query("""SELECT p_partkey AS ato_id, 1 AS ordem, unnest(['PIS', CASE WHEN p_size % 3 = 0 THEN 'COFINS' ELSE 'ISS' END]) AS tributo_codigo, unnest(['nao_cumulativo', NULL]) AS regime FROM part WHERE p_partkey % 5 < 2""")
def matter_taxes(spark, sf_dir):
    return _matter_rows(spark, sf_dir)["materia_tributo"]


@query("""SELECT p_partkey AS ato_id, 1 AS ordem, CASE WHEN p_size % 2 = 0 THEN 'CREDITAMENTO' ELSE '__NOVO_TEMA' END AS tema_macro, 'sim' AS solucao FROM part WHERE p_partkey % 5 < 2""")
def matter_themes(spark, sf_dir):
    return _matter_rows(spark, sf_dir)["ato_materia"].select("ato_id", "ordem", "tema_macro", "solucao")


@query("""SELECT p_partkey AS ato_id, 1 AS ordem, 'art. 3º, II' AS dispositivo, 'dispositivo_do_ato' AS tipo_uso FROM part WHERE p_partkey % 5 < 2""")
def matter_provisions(spark, sf_dir):
    return _matter_rows(spark, sf_dir)["materia_dispositivo"].select("ato_id", "ordem", "dispositivo", "tipo_uso")


def _matter_rows(spark, sf_dir):
    rows = G.parsed(_replies(spark, sf_dir), "resposta").where("size(erros) = 0")
    return G.matter_rows(G.merged(rows.select("ato_id", "parte", "saida")), N.alias_table(spark, VOCABULARY))


@query("""SELECT p_partkey AS ato_id, CASE WHEN p_partkey % 2 = 0 AND p_size % 4 = 0 THEN 'falta nome,valor de tipo' WHEN p_partkey % 2 = 0 THEN 'falta nome' WHEN p_size % 4 = 0 THEN 'valor de tipo,campo a mais: x' ELSE 'campo a mais: x' END AS faltas FROM part""")
def schema_validation(spark, sf_dir):
    schema = {"required": ["nome"], "additionalProperties": False, "properties": {"nome": {}, "tipo": {"enum": ["a", "b"]}}}
    p = table(spark, sf_dir, "part")
    kind = F.when(F.col("p_size") % 4 == 0, "c").otherwise("a")
    payload = F.when(F.col("p_partkey") % 2 == 0, F.to_json(F.struct(kind.alias("tipo")))).otherwise(F.to_json(F.struct(kind.alias("tipo"), F.lit("n").alias("nome"), F.lit(1).alias("x"))))
    return p.select(F.col("p_partkey").alias("ato_id"), F.array_join(G.schema_faults(payload, schema), ",").alias("faltas"))


@query("""
SELECT *, sha256(texto) AS sha256 FROM (
SELECT l_orderkey AS "idAto", coalesce(string_agg('Art. ' || l_partkey || ' x', E'\n\n' ORDER BY l_suppkey, '{"idSegmento":' || (l_partkey + 1) || ',"versaoSegmento":' || l_linenumber || ',') FILTER (l_returnflag <> 'R'), '') AS texto,
  CASE WHEN max(l_linenumber) > 1 THEN 'vigente_alterado' ELSE 'vigente_nunca_alterado' END AS status, false AS corpo_em_arquivo FROM lineitem GROUP BY 1) z""")
def view_texts(spark, sf_dir):
    return W.texts(_views(spark, sf_dir))


@query("""SELECT o_orderkey AS ato_id, count(*) AS segmentos, count(*) FILTER (l_returnflag = 'R') AS omitidos, max(l_linenumber) AS maior FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def view_segments(spark, sf_dir):
    s = W.segments(_views(spark, sf_dir))
    return s.groupBy("ato_id").agg(F.count("*").alias("segmentos"), F.count_if(F.col("is_omitido")).alias("omitidos"), F.max("versao_segmento").alias("maior"))


def _views(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    segment = F.to_json(F.struct((F.col("l_partkey") + 1).alias("idSegmento"), F.col("l_linenumber").alias("versaoSegmento"), F.col("l_suppkey").alias("ordemSegmentoAto"), F.concat(F.lit("Art. "), F.col("l_partkey").cast("string"), F.lit("&nbsp;x")).alias("textoIntegra"), (F.col("l_returnflag") == "R").alias("omitir")))
    lines = l.withColumn("s", segment).groupBy("l_orderkey").agg(F.concat_ws(",", F.array_sort(F.collect_list("s"))).alias("s"))
    raw = F.concat(F.lit('{"idAto":'), F.col("l_orderkey").cast("string"), F.lit(',"vigente":true,"outrosSegmentos":['), "s", F.lit("]}"))
    return lines.select(F.from_json(raw, W.VIEW).alias("v")).select("v.*")


# --- vocabularies


def _tax_values(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    names = ["Pis-Pasep", "FINSOCIAL", "FGTS", "RAT", "empréstimo compulsório", "ISSQN", "csl", "nada"]
    value = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("p_partkey") % 8 + 1).cast("int"))
    return p.select("p_partkey", value.alias("tributo"))


_TAX = "CASE p_partkey % 8 WHEN 0 THEN 'PIS' WHEN 1 THEN 'COFINS' WHEN 3 THEN 'GILRAT' WHEN 4 THEN 'EMPRESTIMO_COMPULSORIO' WHEN 5 THEN 'ISS' WHEN 6 THEN 'CSLL' END"


@query(f"SELECT p_partkey, {_TAX} AS canonico FROM part")
def normalised_tax(spark, sf_dir):
    return N.normalized(_tax_values(spark, sf_dir), "tributo", "tributos", N.alias_table(spark, VOCABULARY)).select("p_partkey", "canonico")


@query(f"""SELECT ['Pis-Pasep', 'FINSOCIAL', 'FGTS', 'RAT', 'empréstimo compulsório', 'ISSQN', 'csl', 'nada'][p_partkey % 8 + 1] AS antes, {_TAX} AS depois, count(*) AS n, CASE WHEN {_TAX} IS NULL THEN 'removido' ELSE 'alterado' END AS acao FROM part GROUP BY 1, 2, 4""")
def normalisation_report(spark, sf_dir):
    return N.report(_tax_values(spark, sf_dir), "tributo", "tributos", N.alias_table(spark, VOCABULARY))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'PIS,COFINS' WHEN 1 THEN 'IRPJ,CSLL' WHEN 2 THEN 'ISS' ELSE 'IRPJ' END AS canonicos FROM part WHERE p_partkey % 5 <> 4""")
def composite_tax(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 4
    value = F.when(F.col("p_partkey") % 5 == 4, "nada/nenhum").when(k == 0, "PIS/COFINS").when(k == 1, "IRPJ E CSLL").when(k == 2, "ISSQN").otherwise("xx - IRPJ")
    return N.decomposed(p.select("p_partkey", value.alias("t")), "p_partkey", "t", N.alias_table(spark, VOCABULARY)).select("p_partkey", F.array_join("canonicos", ",").alias("canonicos"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'IRPJ.LUCRO_REAL' WHEN 1 THEN 'CREDITO.' || upper(replace(p_name, ' ', '_')) END AS tema FROM part""")
def specific_theme(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 3
    return p.select("p_partkey", N.specific_theme(F.when(k == 0, "irpj.lucro-real").when(k == 1, F.col("p_name")).otherwise("solto"), F.when(k == 1, "CREDITO")).alias("tema"))


@query("SELECT unnest(['IN', 'DECRETO', 'SC', 'SD']) AS codigo, unnest(['normativa', 'normativa', 'consultiva', 'consultiva']) AS natureza")
def types_by_nature(spark, sf_dir):
    return N.types_by_nature(spark, {"normativa": ["IN", "DECRETO"], "consultiva": ["SC", "SD"]})


# --- parts


@query()
def partition_parts(spark, sf_dir):
    return P.part_rows(table(spark, sf_dir, "documents"), "doc_id", "text", 3000)


@query()
def partition_outline(spark, sf_dir):
    return P.outline_rows(table(spark, sf_dir, "documents"), "doc_id", "text")


@query()
def partition_chunks(spark, sf_dir):
    return P.chunk_rows(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("""SELECT doc_id, length(text) < 200 AS so_ementa, CASE WHEN lang = 'en' THEN 'Parte 1 de 2 — ' || source || E'\n\n' ELSE '' END || CASE WHEN length(text) < 200 THEN E'Só a ementa está disponível; não infira o corpo do ato.\n\n' ELSE '' END || E'<texto>\n' || text || E'\n</texto>' AS pedido FROM documents""")
def prompts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("so_ementa", F.length("text") < 200)
    return d.select("doc_id", "so_ementa", G.prompt(F.col("text"), F.lit("1"), F.when(F.col("lang") == "en", 2).otherwise(1), F.col("source"), F.col("so_ementa")).alias("pedido"))


# --- reports and gates


def _gate_rows(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 7
    texts = d.select(F.col("doc_id").alias("ato_id"), F.concat(F.lit("PIS Lei 10.833 "), F.array_join(F.transform(F.sequence(F.lit(1), F.when(k < 3, 25).otherwise(4)), lambda i: F.concat(F.lit("\n\nArt. "), i.cast("string"), F.lit(". texto"))), "")).alias("texto"))
    m = d.select(F.col("doc_id").alias("ato_id"), F.explode(F.sequence(F.lit(1), (F.col("doc_id") % 4 + 1).cast("int"))).alias("ordem"))
    j = F.col("ordem")
    last = F.when(F.col("ato_id") % 7 == 0, 24).when(F.col("ato_id") % 7 == 1, 5).otherwise(3)
    m = m.select("ato_id", "ordem", F.when(F.col("ato_id") % 5 == 0, "__NOVO_TEMA").otherwise("IPI").alias("tema_macro"), F.lit("T.X").alias("tema_especifico"), F.when((F.col("ato_id") % 3 == 0) & (j == 1), "").otherwise("sim").alias("solucao"), F.array(F.when(F.col("ato_id") % 11 == 0, "COFINS").otherwise("PIS")).alias("tributos"), F.array(F.when(F.col("ato_id") % 13 == 0, "Lei 99.999").otherwise("Lei 10.833")).alias("referencias"), F.transform(F.sequence(F.lit(1), last), lambda i: F.concat(F.lit("art. "), i.cast("string"))).alias("artigos"))
    return m, texts


_GATE = """
g AS (SELECT doc_id AS ato_id, doc_id % 4 + 1 AS materias, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS sem_solucao, CASE WHEN doc_id % 5 = 0 THEN doc_id % 4 + 1 ELSE 0 END AS fora,
  CASE WHEN doc_id % 7 < 3 THEN 25 ELSE 4 END AS n, CASE WHEN doc_id % 7 = 0 THEN 24 WHEN doc_id % 7 = 1 THEN 5 ELSE 3 END AS c,
  CASE WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 THEN doc_id % 4 + 1 ELSE 0 END AS d FROM documents)"""


def _report(spark, sf_dir):
    m, texts = _gate_rows(spark, sf_dir)
    anchored = G.anchoring(m, texts, {"PIS": ["pis", "pasep"], "COFINS": ["cofins"]}, {"lucro real": ["IRPJ", "CSLL"]})
    return G.quality_report(anchored, texts)


@query("""SELECT doc_id AS ato_id, CAST(i AS INTEGER) AS ordem, concat_ws('; ', CASE WHEN doc_id % 11 = 0 THEN 'tributo COFINS não aparece no texto' END, CASE WHEN doc_id % 13 = 0 THEN '1 de 1 normas citadas não aparecem no texto' END) AS problemas FROM documents, range(1, 5) t(i) WHERE i <= doc_id % 4 + 1""")
def anchoring(spark, sf_dir):
    m, texts = _gate_rows(spark, sf_dir)
    out = G.anchoring(m, texts, {"PIS": ["pis", "pasep"], "COFINS": ["cofins"]}, {"lucro real": ["IRPJ", "CSLL"]})
    return out.select("ato_id", "ordem", F.array_join("problemas", "; ").alias("problemas"))


@query(f"WITH {_GATE.strip()} SELECT ato_id, materias, sem_solucao, fora AS fora_da_taxonomia, d AS desancoradas, n AS artigos_no_texto, least(n, c) AS artigos_citados, round(least(n, c)::DOUBLE / n, 3) AS cobertura_artigos FROM g")
def quality_report(spark, sf_dir):
    return _report(spark, sf_dir).select("ato_id", "materias", "sem_solucao", "fora_da_taxonomia", "desancoradas", "artigos_no_texto", "artigos_citados", "cobertura_artigos")


@query(f"""WITH {_GATE.strip()}, r AS (SELECT ato_id, concat_ws(',', CASE WHEN fora * 1.0 / materias > 0.5 THEN 'fora da taxonomia' END, CASE WHEN sem_solucao * 1.0 / materias > 0.2 THEN 'sem solução' END, CASE WHEN n >= 20 AND least(n, c) * 1.0 / n < 0.8 THEN 'cobertura de artigos' END, CASE WHEN d * 1.0 / materias > 0.2 THEN 'sem âncora' END) AS motivos FROM g)
SELECT ato_id, motivos, CASE WHEN motivos <> '' THEN 'revisao' ELSE 'gravado' END AS estado FROM r""")
def gate(spark, sf_dir):
    return G.result_state(G.gate(_report(spark, sf_dir))).select("ato_id", F.array_join("motivos", ",").alias("motivos"), "estado")


@query("SELECT o_orderkey, round(((o_orderkey * 100 - o_custkey) * 3.0 + o_custkey * 0.3 + 500 * 15.0) / 1e6 * 0.5, 9) AS custo FROM orders")
def batch_cost(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.round(G.cost(F.col("o_orderkey") * 100, F.lit(500), 3.0, 15.0, F.col("o_custkey"), True), 9).alias("custo"))


# --- dossiers


@query("""WITH f AS (SELECT source, lang, concat_ws(',', CASE WHEN text ILIKE '%scum%' OR text ILIKE '%worthless%' THEN 'toxico' END, CASE WHEN text ILIKE '%license%' AND text ILIKE '%gnu%' THEN 'licenca' END) AS q, text FROM documents),
k AS (SELECT source, lang, unnest(string_split(q, ',')) AS c FROM f WHERE q <> ''),
n AS (SELECT source, lang, count(*) AS n FROM f WHERE q <> '' GROUP BY 1, 2)
SELECT k.source, k.lang, string_agg(DISTINCT c, ',' ORDER BY c) AS consultas, any_value(n.n) AS n FROM k JOIN n ON n.source = k.source AND n.lang = k.lang GROUP BY 1, 2""")
def dossier(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    queries = {"toxico": D.pattern_query(["%scum%", "%worthless%"], "text"), "licenca": D.pattern_query(["%license%", "%gnu%"], "text", "all")}
    return D.compiled(d, queries, ["source", "lang"], "text", ["scum"], ["license"]).drop("classe")


@query("""
WITH l AS (SELECT *, l_orderkey * 10 + l_linenumber AS id FROM lineitem WHERE l_orderkey IN (1, 2, 3, 50, 77)),
t AS (SELECT id, string_agg(c, '+' ORDER BY c) AS t FROM (SELECT DISTINCT id, 'T' || l_linestatus AS c FROM l) GROUP BY id),
p AS (SELECT id, string_agg('lei ' || lpad(l_suppkey::VARCHAR, 9, '0') || ' art. ' || l_linenumber, '+' ORDER BY l_suppkey) AS p FROM l WHERE l_returnflag <> 'N' GROUP BY id)
SELECT l_orderkey AS id, string_agg(concat_ws(':', l_linenumber, l_returnflag, t.t, coalesce(p.p, '')), ';' ORDER BY l_linenumber, l_partkey, l_suppkey) AS materias
FROM l JOIN t USING (id) LEFT JOIN p USING (id) GROUP BY 1""")
def consolidation(spark, sf_dir):
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    acts = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("nome"))
    matter = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    m = l.select(F.col("l_orderkey").alias("ato_id"), F.col("l_linenumber").alias("ordem"), F.concat_ws("-", F.lpad(F.col("l_partkey").cast("string"), 9, "0"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("tema_especifico"), F.col("l_returnflag").alias("solucao"), matter.alias("id"))
    taxes = l.select(matter.alias("materia_id"), F.concat(F.lit("T"), "l_linestatus").alias("tributo_codigo"))
    provisions = l.where("l_returnflag <> 'N'").select(matter.alias("materia_id"), F.lit("lei").alias("tipo_norma"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0").alias("referencia"), F.concat(F.lit("art. "), F.col("l_linenumber").cast("string")).alias("dispositivo"))
    edges = l.select(F.col("l_orderkey").alias("origem"), F.col("l_returnflag").alias("tipo"), F.col("l_partkey").alias("destino"))
    out = D.consolidated(acts, m, taxes, provisions, edges, [1, 2, 3, 50, 77])

    def written(x):
        uses = F.transform(x["dispositivos"], lambda d: F.concat_ws(" ", d["tipo_norma"], d["referencia"], d["dispositivo"]))
        return F.concat_ws(":", x["ordem"].cast("string"), x["solucao"], F.array_join(x["tributos"], "+"), F.coalesce(F.array_join(uses, "+"), F.lit("")))

    return out.where("materias is not null").select("id", F.array_join(F.transform("materias", written), ";").alias("materias"))


@query("SELECT left(string_agg('### ' || source || E'\n' || CASE WHEN length(text) > 40 THEN substr(text, 1, 40) || ' [...]' ELSE text END, E'\n\n' ORDER BY doc_id), 2000) AS contexto FROM documents")
def context(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("id", F.col("doc_id"))
    return D.context(d, "source", "text", 40, 2000)


@query("SELECT string_agg('## ' || r_name || E'\n' || r_regionkey, E'\n\n' ORDER BY r_name) AS pedido FROM region")
def study_synthesis(spark, sf_dir):
    return D.synthesis(table(spark, sf_dir, "region").select("r_name", F.col("r_regionkey").cast("string").alias("t")), "r_name", "t")
