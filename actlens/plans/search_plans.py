"""Search, facets, similar pairs and conflicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from actlens.functions import scoring
from actlens.operators import conflicts as C
from actlens.operators import search as S
from actlens.plans.base import AS_OF, MATTERS_SQL, matters, query, table, vector_of

TERMS = ["the", "and"]
NATURE = {"en": "normativa", "fr": "consultiva"}


def _weight(mode: str = "pratico"):
    nature = F.when(F.col("tipo_ato") == "en", "normativa").when(F.col("tipo_ato") == "fr", "consultiva").otherwise("operacional")
    status = F.when(F.col("quality") == 0, "retificador").otherwise("vigente_nunca_alterado")
    second = scoring.secondary(nature, F.col("especie"), F.col("emissor"))
    return scoring.lookup(nature, scoring.MODES[mode]) * second * scoring.lookup(status, scoring.STATUS) * scoring.decay(F.col("data_publicacao"), AS_OF)


#: kinds (k) are SOLUCAO_CONSULTA, INSTRUCAO_NORMATIVA, SOLUCAO_DIVERGENCIA, PORTARIA; issuers (i) COSIT, DISIT, COANA
_SECOND = "CASE WHEN m.tipo_ato = 'fr' AND m.k = 2 THEN 1.15 WHEN m.tipo_ato = 'fr' AND m.k = 0 AND m.i <> 1 THEN 1.10 WHEN m.tipo_ato = 'en' AND m.k = 1 THEN 1.05 ELSE 1.0 END"


def _hybrid_sql(where: str, mode: tuple[float, float, float]) -> str:
    return f"""
WITH {MATTERS_SQL.strip()},
k AS (SELECT *, regexp_extract_all(lower(body), '\\p{{L}}+') AS t FROM m WHERE {where}),
c AS (SELECT id, len(t) AS n, len(list_filter(t, lambda x: x = 'the')) AS f0, len(list_filter(t, lambda x: x = 'and')) AS f1 FROM k),
s AS (SELECT count(*) AS nd, avg(n) AS av, count(*) FILTER (f0 > 0) AS d0, count(*) FILTER (f1 > 0) AS d1 FROM c),
b AS (SELECT id, round(
    ln(1.0 + (nd - d0 + 0.5) / (d0 + 0.5)) * f0 * 2.2 / (f0 + 1.2 * (0.25 + 0.75 * n / av)) +
    ln(1.0 + (nd - d1 + 0.5) / (d1 + 0.5)) * f1 * 2.2 / (f1 + 1.2 * (0.25 + 0.75 * n / av)), 9) AS sc
  FROM c, s WHERE f0 > 0 AND f1 > 0),
fts AS (SELECT id, row_number() OVER (ORDER BY sc DESC, id) AS pos FROM b QUALIFY pos <= 90),
q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 3),
vec AS (SELECT id, row_number() OVER (ORDER BY round(list_cosine_similarity(v, qv), 9) DESC, id) AS pos FROM k, q QUALIFY pos <= 90),
r AS (SELECT coalesce(f.id, x.id) AS id, coalesce(1.0::DOUBLE / (60 + f.pos), 0) + coalesce(1.0::DOUBLE / (60 + x.pos), 0) AS rrf FROM fts f FULL JOIN vec x ON f.id = x.id),
p AS (SELECT *, row_number() OVER (ORDER BY round(rrf, 9) DESC, id) AS o FROM r QUALIFY o <= 90)
SELECT m.id, m.ato, m.tipo_ato, round(p.rrf * CASE m.tipo_ato WHEN 'en' THEN {mode[0]} WHEN 'fr' THEN {mode[1]} ELSE {mode[2]} END * {_SECOND}
  * CASE WHEN m.quality = 0 THEN 0.7 ELSE 1.0 END * pow(0.5, date_diff('day', m.data_publicacao, DATE '{AS_OF}') / 365.25 / 15.0)
  + CASE WHEN m.theme IN (1, 2) THEN 0.10 WHEN m.theme = 3 THEN 0.08 ELSE 0 END, 6) AS score
FROM p JOIN m ON m.id = p.id ORDER BY score DESC, m.id LIMIT 15"""


def _search(spark, sf_dir, mode, predicate=None):
    vector = vector_of(spark, sf_dir, 3)
    rows = matters(spark, sf_dir, lambda d: S.scored(d, TERMS), lambda e: S.scored(e, query=vector))
    provisions = rows.select(F.col("id").alias("materia_id"), F.when(F.col("theme") == 1, "tema_stf").when(F.col("theme") == 2, "sumula_vinculante").when(F.col("theme") == 3, "sumula_carf").otherwise("lei").alias("tipo_norma"))
    out = S.hybrid(rows, TERMS, vector, _weight(mode), S.landmark_boost(provisions), predicate=predicate)
    return out.select("id", "ato", "tipo_ato", "score")


@query(_hybrid_sql("true", (1.2, 1.05, 0.5)))
def hybrid_search(spark, sf_dir):
    return _search(spark, sf_dir, "pratico")


@query(_hybrid_sql("data_publicacao BETWEEN DATE '2000-06-30' - INTERVAL 60 MONTH AND DATE '2000-06-30'", (1.05, 1.2, 0.3)))
def hybrid_search_window60(spark, sf_dir):
    return _search(spark, sf_dir, "consultivo", S.binding_window(F.col("data_publicacao"), "2000-06-30"))


@query(_hybrid_sql("tipo_ato IN ('en', 'de') AND data_publicacao <= DATE '1999-12-31'", (1.0, 1.0, 0.7)))
def hybrid_search_filtered(spark, sf_dir):
    return _search(spark, sf_dir, "historico", S.filters(kinds=["en", "de"], in_force_at="1999-12-31"))


@query("""
SELECT 'lang' AS dimension, lang AS value, count(*) AS n FROM documents GROUP BY lang
UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source""")
def facets(spark, sf_dir):
    return S.facets(table(spark, sf_dir, "documents"), ["lang", "source"])


@query(f"""
WITH {MATTERS_SQL.strip()},
q AS (SELECT vec_id AS q, embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id IN (3, 7, 11)),
s AS (SELECT q, id, ato, round(list_cosine_similarity(v, qv), 9) AS sim FROM m, q),
t AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY sim DESC, id) AS k FROM s QUALIFY k <= 20)
SELECT ato, max(sim) AS score, count(DISTINCT q) AS queries FROM t WHERE sim > 0 GROUP BY ato ORDER BY score DESC, ato LIMIT 35""")
def multi_query_union(spark, sf_dir):
    queries = [(n, vector_of(spark, sf_dir, n)) for n in (3, 7, 11)]
    return S.multi_query(matters(spark, sf_dir).select("id", "ato", "embedding"), queries, "id", "ato", "embedding", 20, 35)


@query("""
SELECT a.label AS theme, a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS sim
FROM embeddings a JOIN embeddings b ON a.label = b.label AND b.vec_id > a.vec_id
WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > 0.3""")
def similar_pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("theme"), "embedding")
    return C.similar_pairs(rows, 0.3)


def _conflicts_sql(tail: str) -> str:
    return f"""
WITH {MATTERS_SQL.strip()},
e AS (SELECT * FROM m WHERE sinal IN ('AUTORIZA', 'VEDA') AND k IN (0, 2) AND quality IS NOT NULL AND length(trim(substr(body, 1, 20))) > 0),
p AS (SELECT a.theme, a.id AS i, b.id AS j, round(list_cosine_similarity(a.v, b.v), 4) AS sim FROM e a JOIN e b ON a.theme = b.theme AND b.id > a.id AND a.ato <> b.ato AND a.sinal <> b.sinal
  WHERE list_cosine_similarity(a.v, b.v) > 0.1),
o AS (SELECT p.theme, p.sim, CASE WHEN y.data_publicacao < x.data_publicacao THEN y.id ELSE x.id END AS materia_a, CASE WHEN y.data_publicacao < x.data_publicacao THEN x.id ELSE y.id END AS materia_b
  FROM p JOIN e x ON x.id = p.i JOIN e y ON y.id = p.j),
ed AS (SELECT DISTINCT 'src' || (c_custkey % 20) AS x, 'src' || (c_custkey * c_custkey % 20) AS y FROM customer),
f AS (SELECT x, y FROM ed UNION SELECT y, x FROM ed),
r AS (SELECT o.theme, o.materia_a, o.materia_b, o.sim, a.sinal AS sinal_a, b.sinal AS sinal_b, a.data_publicacao AS data_a, b.data_publicacao AS data_b,
    b.data_publicacao > a.data_publicacao AS supera, f.x IS NOT NULL AS formal
  FROM o JOIN e a ON a.id = o.materia_a JOIN e b ON b.id = o.materia_b LEFT JOIN f ON f.x = a.ato AND f.y = b.ato)
{tail}"""


def _conflicts(spark, sf_dir):
    rows = matters(spark, sf_dir, lambda d: d.withColumn("solucao", F.left("body", F.lit(20))).drop("body")).withColumn("eficacia_atual", F.when(F.col("quality").isNotNull(), "vinculante_cosit"))
    rows = C.eligible(rows, F.col("sinal"), ["SOLUCAO_CONSULTA", "SOLUCAO_DIVERGENCIA"], "especie", "eficacia_atual", "solucao").withColumn("data", F.col("data_publicacao"))
    k = F.col("c_custkey")
    source = [F.concat(F.lit("src"), x.cast("string")) for x in (k % 20, k * k % 20)]
    edges = table(spark, sf_dir, "customer").select(source[0].alias("origem"), source[1].alias("destino"))
    return C.conflicts(rows, edges, 0.1).select("theme", "materia_a", "materia_b", "sim", "sinal_a", "sinal_b", "data_a", "data_b", "supera", "formal")


@query(_conflicts_sql("SELECT * FROM r"), ("data_a", "data_b"))
def conflicts(spark, sf_dir):
    return _conflicts(spark, sf_dir)


@query(_conflicts_sql("SELECT * FROM r WHERE supera AND NOT formal ORDER BY sim DESC, data_b DESC NULLS LAST, materia_a, materia_b LIMIT 30"), ("data_a", "data_b"))
def conflicts_top(spark, sf_dir):
    return C.to_review(_conflicts(spark, sf_dir))


@query(f"WITH {MATTERS_SQL.strip()} SELECT theme, count(*) AS n FROM m WHERE sinal IN ('AUTORIZA', 'VEDA') GROUP BY theme HAVING count(*) >= 3")
def conflict_themes(spark, sf_dir):
    return C.themes(C.eligible(matters(spark, sf_dir), F.col("sinal")))


@query(_conflicts_sql("""SELECT theme, materia_a, materia_b, sim, CASE WHEN materia_a % 2 = 0 THEN 'vista' END AS observacao FROM r WHERE theme <> 0
UNION ALL SELECT 1, -1, -2, 0.5, 'antiga'"""))
def conflict_upsert(spark, sf_dir):
    """A table of conflicts that holds some of those found, with other figures and notes, after upsert and clearing of a theme."""
    found = _conflicts(spark, sf_dir).select("theme", "materia_a", "materia_b", "sim")
    held = found.where("materia_a % 2 = 0").withColumn("sim", F.lit(0.0)).withColumn("observacao", F.lit("vista"))
    old = spark.createDataFrame([(1, -1, -2, 0.5, "antiga"), (0, -3, -4, 0.5, "antiga")], held.schema)
    return C.cleared(C.upserted(held.unionByName(old), found), "theme", [0])
