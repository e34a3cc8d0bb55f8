"""Scenarios of the other operators."""

from __future__ import annotations

import datetime
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from actlens.functions import scoring
from actlens.operators import conflicts as C
from actlens.operators import matters as G
from actlens.operators import merge as M
from actlens.operators import normalize as N
from actlens.operators import partition as P
from actlens.operators import queues as Q
from actlens.operators import relations as R
from actlens.operators import temporal as T
from actlens.operators import views as W
from actlens.plans import registry
from actlens.sources.store import Store
from actlens.streaming import stream

D = datetime.date
#: The entries that the cases below name.
VOCABULARY = {
    "tributos": {
        "_canonicos": ["CSLL", "PIS", "COFINS", "GILRAT"],
        "_aliases": {"_nota": ["x"], "PIS": ["PIS-PASEP", "piscofins"], "COFINS": ["FINSOCIAL"], "CSLL": ["CSL"], "CONTRIB_PREV": ["INSS", "RAT"], "CONTRIB_TERCEIROS": ["CONTAG"], "GILRAT": ["RAT"], "ICMS": ["ICM"], "ISS": ["ISSQN"], "EMPRESTIMO_COMPULSORIO": ["EMPRÉSTIMO_COMPULSÓRIO"], "MULTA_ISOLADA": ["MULTA_OFICIO"]},
        "_rejeitar_valores": ["IN", "6912", "FGTS"],
    },
    "temas_macro": {"_canonicos": ["CREDITAMENTO"], "_aliases": {"PROCESSO_ADMINISTRATIVO": ["PROCESS_ADMINISTRATIVO"], "CREDITAMENTO": ["CREDITAMENTE"], "LANCAMENTO": ["LANCAMENTOS"]}, "_realocar": {"_nota": "x", "CSLL": "IRPJ_CSLL", "PIS_COFINS": "ALIQUOTA_E_BASE_CALCULO"}},
    "regimes_tributarios": {"_canonicos": ["nao_cumulativo"], "_aliases": {"nao_cumulativo": ["não-cumulativo"]}},
    "tipo_norma": {"_canonicos": ["lei_complementar"], "_aliases": {"lei_complementar": ["LC", "Lei Complementar"]}},
    "tipo_relacao": {"_aliases": {"altera": ["ALT"], "interrompe": ["REV"]}},
}


def test_normaliser_table(spark):
    cases = [
        ("PIS", "tributos", "PIS"), ("piscofins", "tributos", "PIS"), ("Pis-Pasep", "tributos", "PIS"), ("ISSQN", "tributos", "ISS"), ("FINSOCIAL", "tributos", "COFINS"), ("ICM", "tributos", "ICMS"), ("CSLL", "tributos", "CSLL"),
        ("CSL", "tributos", "CSLL"), ("EMPRÉSTIMO_COMPULSÓRIO", "tributos", "EMPRESTIMO_COMPULSORIO"), ("INSS", "tributos", "CONTRIB_PREV"), ("CONTAG", "tributos", "CONTRIB_TERCEIROS"), ("MULTA_OFICIO", "tributos", "MULTA_ISOLADA"),
        ("IN", "tributos", None), ("6912", "tributos", None), ("RAT", "tributos", "GILRAT"), ("FGTS", "tributos", None), ("PROCESS_ADMINISTRATIVO", "temas_macro", "PROCESSO_ADMINISTRATIVO"), ("CREDITAMENTE", "temas_macro", "CREDITAMENTO"),
        ("LANCAMENTOS", "temas_macro", "LANCAMENTO"), ("PIS_COFINS", "temas_macro", "ALIQUOTA_E_BASE_CALCULO"), ("CSLL", "temas_macro", "IRPJ_CSLL"), ("nao_cumulativo", "regimes_tributarios", "nao_cumulativo"), ("não-cumulativo", "regimes_tributarios", "nao_cumulativo"),
        ("Lei Complementar", "tipo_norma", "lei_complementar"), ("LC", "tipo_norma", "lei_complementar"), ("ALT", "tipo_relacao", "altera"), ("REV", "tipo_relacao", "interrompe"), (None, "tributos", None), ("", "tributos", None),
    ]
    aliases = N.alias_table(spark, VOCABULARY)
    for section in {c[1] for c in cases}:
        rows = spark.createDataFrame([(c[0], c[2]) for c in cases if c[1] == section], "v string, e string")
        wrong = N.normalized(rows, "v", section, aliases).where("not (e <=> canonico)").collect()
        assert wrong == []


def text_of(titles, articles):
    return "\n\n".join(f"TÍTULO {t}\nDO TEMA {t}\n\n" + "\n\n".join(f"Art. {t * articles + a}. {'x' * 120}\n\n§ 1º {'y' * 90}" for a in range(articles)) for t in range(1, titles + 1))


def begins(text, limit):
    """(offset, rank) of every place where a part may begin, block by block: a plain reading."""
    out, at = [], 0
    for block in text.split("\n\n"):
        if len(block) <= limit or P.HEADING.match(block) or P.ARTICLE.match(block):
            out.append((at, 0 if P.HEADING.match(block) else 1 if P.ARTICLE.match(block) else 2))
        if len(block) > limit:
            inside = at
            for line in block.split("\n"):
                for k in range(0, max(1, len(line)), limit):
                    if (inside + k, 0) not in out and (inside + k, 1) not in out:
                        out.append((inside + k, 2 if inside + k == at else 3 if k == 0 else 4))
                inside += len(line) + 1
        at += len(block) + 2
    return out


def check_parts(text, limit):
    """Parts are stretches of the text, none over the limit, each cut at the best place that it could have."""
    found = P.parts(text, limit)
    assert [p[0] for p in found] == [str(k + 1) for k in range(len(found))]
    if len(text) <= limit:
        assert found == [("1", text, "")]
        return
    places = dict(begins(text, limit))
    at = 0
    for k, (_, part, _) in enumerate(found):
        assert len(part) <= limit and text.startswith(part, at)
        end = at + len(part)
        if k + 1 == len(found):
            assert end == len(text)
            break
        ranks = {b: r for b, r in places.items() if at < b and len(text[at:b].removesuffix("\n\n" if text[:b].endswith("\n\n") and r < 3 else "\n" if text[b - 1] == "\n" and r == 3 else "")) <= limit}
        best = min(ranks, key=lambda b: (ranks[b], -b))
        assert text[end:best] in ("\n\n", "\n", "") and best in ranks
        at = best


@pytest.mark.parametrize(("titles", "articles", "limit"), [(3, 20, 1000), (2, 5, 300), (4, 3, 600)])
def test_parts_are_lossless_and_bounded(titles, articles, limit):
    text = text_of(titles, articles)
    found = P.parts(text, limit)
    assert "\n\n".join(p[1] for p in found) == text
    assert all(len(p[1]) <= limit and not p[1].startswith("§") for p in found)
    check_parts(text, limit)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["Art. 1. a", "§ 1º b", "TÍTULO I", "Seção II\nDo B", "texto", "", "\0", "x" * 30 + "\n" + "y" * 95 + "\0\nz", "ANEXO 2 " + "w" * 90]), min_size=1, max_size=40), st.integers(15, 80))
def test_parts_join_to_the_text(blocks, limit):
    check_parts("\n\n".join(blocks), limit)


def test_paths_of_parts():
    text = "\n\n".join(["LIVRO I", "Do Livro", "TÍTULO I\nDo T", "Art. 1 " + "a" * 40, "Art. 2 " + "b" * 40, "TÍTULO II", "Art. 3 " + "c" * 40, "ANEXO ÚNICO", "d" * 40])
    assert [(p[1][:8], p[2]) for p in P.parts(text, 90)] == [
        ("LIVRO I\n", "LIVRO I (Do Livro)"), ("TÍTULO I", "LIVRO I (Do Livro) > TÍTULO I (Do T)"), ("Art. 2 b", "LIVRO I (Do Livro) > TÍTULO I (Do T)"),
        ("TÍTULO I", "LIVRO I (Do Livro) > TÍTULO II"), ("ANEXO ÚN", "ANEXO ÚNICO (" + "d" * 40 + ")"),
    ]
    assert P.outline(text).split("\n")[0] == "LIVRO I (Do Livro) — art. 1" and P.outline(text).split("\n")[-1].startswith("ANEXO ÚNICO")


def test_giant_block_loses_only_its_cuts():
    text = "\n".join("z" * 50 for _ in range(30))
    found = P.parts(text, 200)
    assert text.count("\n") - sum(p[1].count("\n") for p in found) == len(found) - 1
    assert P.parts("q" * 500, 200) == [("1", "q" * 200, ""), ("2", "q" * 200, ""), ("3", "q" * 100, "")]
    assert "".join(p[1] for p in P.parts("\0" * 199 + "\0" * 301, 200)) == "\0" * 500


def plain_chunks(text, limit, least):
    pieces = [p.strip()[k : k + limit] for p in text.split("\n\n") for k in range(0, len(p.strip()), limit)]
    out = []
    while pieces:
        n = max(k for k in range(1, len(pieces) + 1) if k == 1 or len("\n\n".join(pieces[:k])) <= limit)
        out.append("\n\n".join(pieces[:n]))
        pieces = pieces[n:]
    return [c for c in out if len(c) >= least]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["a" * 12, " bb ", "", "c" * 95, "d\ne"]), max_size=20), st.integers(10, 60))
def test_chunks_equal_a_plain_reading(blocks, limit):
    assert P.chunks("\n\n".join(blocks), limit, 5) == plain_chunks("\n\n".join(blocks), limit, 5)


def test_outline_and_chunks():
    assert P.outline(text_of(2, 2)).split("\n") == ["  TÍTULO 1 (DO TEMA 1) — art. 2", "  TÍTULO 2 (DO TEMA 2) — art. 4"]
    assert P.chunks("a" * 20 + "\n\n" + "b" * 40, 4000) == ["a" * 20 + "\n\n" + "b" * 40]
    assert P.chunks("curto") == [] and P.chunks("") == [] and P.outline("") == "" and P.parts("") == [("1", "", "")]
    assert P.abstract_only("## EMENTA\n" + "x" * 500) and not P.abstract_only("## EMENTA\nx\n\n" + "y" * 300)
    assert P.halves("x" * 7999) is None and P.halves("x" * 9000, depth=3) is None and [len(p[1]) for p in P.halves("x" * 9000)] == [4501, 4499]


def test_part_queries_equal_plain_readings(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found: dict = {}
    for r in registry.queries()["partition_parts"](spark, sf_dir).collect():
        found.setdefault(r["doc_id"], []).append((r["rotulo"], r["texto"], r["caminho"]))
    assert {k: sorted(v, key=lambda p: int(p[0])) for k, v in found.items()} == {k: P.parts(t, 3000) for k, t in texts.items()}
    for t in texts.values():
        check_parts(t, 3000)
    assert {(r["doc_id"], r["seq"]): r["texto"] for r in registry.queries()["partition_chunks"](spark, sf_dir).collect()} == {(k, n): c for k, t in texts.items() for n, c in enumerate(plain_chunks(t, 4000, 30))}
    outlines = {r["doc_id"]: r["sumario"] for r in registry.queries()["partition_outline"](spark, sf_dir).collect()}
    assert outlines == {k: "\n".join("  " * P.depth_of(P.HEADING.match(b)[1]) + b[:0] for b in t.split("\n\n") if P.HEADING.match(b)) for k, t in texts.items()}


def test_view_text_status_and_segments(spark):
    old = {"idSegmento": 1, "versaoSegmento": 1, "ordemSegmentoAto": 2, "textoIntegra": "Art. 1 Velho", "omitir": True, "original": True}
    new = {"idSegmento": 1, "versaoSegmento": 2, "ordemSegmentoAto": 2, "textoIntegra": "Art. 1&nbsp; Texto  novo", "compilado": True}
    same = {"idSegmento": 2, "versaoSegmento": 1, "ordemSegmentoAto": 3, "textoIntegra": "Art. 2 Igual"}
    import json

    view = {"idAto": 9, "vigente": True, "ementas": [{"idSegmento": 7, "ordemSegmentoAto": 1, "textoIntegra": "Dispõe sobre X"}], "outrosSegmentos": [same, old, new], "historico": [{"idAto": 777, "idSegmento": 1, "idAnotacao": 5, "dataInicioVigencia": "30/12/2022"}]}
    df = spark.createDataFrame([(json.dumps(view),)], "j string").select(F.from_json("j", W.VIEW).alias("v")).select("v.*")
    row = W.texts(df).first()
    assert row["texto"] == "## EMENTA\nDispõe sobre X\n\nArt. 1 Texto novo\n\nArt. 2 Igual" and row["status"] == "vigente_alterado"
    segments = {(r["id_segmento"], r["versao_segmento"]): r for r in W.segments(df).collect()}
    assert len(segments) == 4 and segments[1, 1]["is_omitido"] and segments[1, 1]["is_original"]
    event = W.history(df).first()
    assert (event["data_inicio_vigencia"], event["id_ato_modificador_portal"]) == (D(2022, 12, 30), 777)
    tables = {
        "ato_content": spark.createDataFrame([], "ato_id long, texto_completo string, caracteres int, tipo_versao string"),
        "ato_texto_visao": spark.createDataFrame([], "ato_id long, visao string, sha256 string, texto string"),
        "ato_segmento": W.segments(df).limit(0),
        "ato_alteracao_historico": W.history(df).limit(0),
    }
    once = W.load(df, tables, "r1")
    again = W.load(df, once, "r2")
    assert once["ato_segmento"].count() == again["ato_segmento"].count() == 4
    assert again["ato_mudanca"].count() == 0 and again["ato_texto_visao"].count() == 1


def test_edges_and_validity_end(spark):
    impact = "struct<idAto:long,sigla:string,corSimbolo:int,hint:string,dataPublicacaoDMY:string,dataVigenciaPrimeiraAnotacao:string,epigrafeBase:string>"
    rows = [(10, D(2020, 1, 1), [(5, "REV", 3, "Revoga", "02/02/2021", "03/03/2021", "IN 5"), (0, "x", 1, None, None, None, None)], [(6, "ALT", 2, "Altera parcial", None, None, "IN 6"), (7, None, 9, None, None, None, None)])]
    views = spark.createDataFrame(rows, f"id_portal long, publicacao date, ativo array<{impact}>, passivo array<{impact}>")
    found = {(r["origem_portal"], r["destino_portal"]): r for r in R.portal_edges(views).collect()}
    assert set(found) == {(5, 10), (10, 6), (10, 7)}
    assert found[5, 10]["tipo_relacao"] == "interrompe" and found[5, 10]["data_relacao"] == D(2021, 2, 2) and found[5, 10]["data_efeito"] == D(2021, 3, 3)
    assert found[10, 6]["parcial"] and found[10, 6]["data_relacao"] == D(2020, 1, 1)
    assert found[10, 7]["tipo_relacao"] == "corSimbolo_9" and found[10, 7]["observacao"] is None
    impacts = spark.createDataFrame([(1, 5, "REV", "total", None, D(2021, 1, 1)), (1, 6, "REV", "Parcial", D(2019, 1, 1), None), (1, 7, "SUS", "x", D(2018, 1, 1), None), (2, 5, "REV", None, D(2022, 5, 5), None), (2, 6, "REV", None, D(2022, 4, 4), None)], "id long, outro long, sigla string, hint string, efeito date, publicacao date")
    starts = spark.createDataFrame([(5, D(2021, 6, 1))], "outro long, inicio date")
    ends = {r["id"]: tuple(r)[1:] for r in R.validity_end(impacts, starts).collect()}
    assert ends == {1: (None, D(2021, 6, 1), "inicio_vigencia_do_revogador"), 2: (D(2022, 4, 4), None, "data_efeito_portal")}


def test_link_on_arrival_without_duplicate(spark):
    relations = spark.createDataFrame([(1, None, 50, "altera"), (1, None, 60, "altera"), (1, 3, None, "altera")], "origem long, destino long, destino_id_portal int, tipo string")
    acts = spark.createDataFrame([(2, 50), (3, 60)], "id long, id_portal int")
    found = {(r["destino_id_portal"], r["destino"], r["ligada"]) for r in R.link_pending(relations, acts).collect()}
    assert found == {(50, 2, True), (60, None, False), (None, 3, False)}


def test_link_pending_of_acts_that_share_a_portal_id(spark):
    relations = spark.createDataFrame([(1, None, 50, "altera"), (1, None, 60, "altera")], "origem long, destino long, destino_id_portal int, tipo string")
    acts = spark.createDataFrame([(2, 50), (4, 50), (4, 50), (3, None)], "id long, id_portal int")

    def found(**how):
        return sorted((r["destino_id_portal"], r["destino"] or 0, r["ligada"]) for r in R.link_pending(relations, acts, **how).collect())

    assert found() == [(50, 2, True), (60, 0, False)]
    assert found(each=True) == [(50, 2, True), (50, 4, True), (50, 4, True), (60, 0, False)]


def shared_keys(tmp_path, sf_dir):
    """The tables of relations twice, with keys shifted so that suppliers meet parts under the same portal ids."""
    con = duckdb.connect()
    for name, keys in (("supplier", {"s_suppkey": 1000}), ("part", {"p_partkey": 20000}), ("lineitem", {"l_suppkey": 1000, "l_partkey": 20000})):
        shifted = ", ".join(f"{k} + i * {v} AS {k}" for k, v in keys.items())
        con.execute(f"COPY (SELECT t.* REPLACE ({shifted}) FROM '{sf_dir}/{name}.parquet' t, range(2) r(i)) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS FROM read_parquet('{tmp_path}/{name}.parquet')")
    assert con.execute("SELECT count(*) FROM supplier JOIN part ON s_suppkey = p_partkey + 1000 WHERE p_size > 10").fetchone()[0] > 0
    return con


def same_as_sql(spark, con, folder, name):
    df = registry.queries()[name](spark, str(folder))
    assert Counter(tuple(r) for r in df.collect()) == Counter(con.execute(f"SELECT {', '.join(df.columns)} FROM ({registry.oracle_sql()[name]})").fetchall())


def test_link_pending_on_shared_portal_ids(spark, sf_dir, tmp_path):
    same_as_sql(spark, shared_keys(tmp_path, sf_dir), tmp_path, "link_pending")


def test_edge_merge_on_shared_portal_ids(spark, sf_dir, tmp_path):
    same_as_sql(spark, shared_keys(tmp_path, sf_dir), tmp_path, "edge_merge")


def test_act_row_of_a_listing(spark):
    rows = spark.createDataFrame([(9, "IN", "2.470", "Cosit/X", "05/07/2021", None, ["", " A "], "e"), (8, "SC", "abc", None, "01/01/2020", "31/12/2019", None, "e2")], "idAto long, tipo string, numero string, orgao string, publicacao string, dataAto string, ementas array<string>, ementa string")
    found = {r["id_portal"]: r for r in R.act_rows(rows).collect()}
    assert (found[9]["numero"], found[9]["ano"], found[9]["emissor"], found[9]["ementa"]) == ("2470", 2021, "COSIT_X", "A")
    assert (found[8]["numero"], found[8]["ano"], found[8]["emissor"], found[8]["ementa"]) == (None, 2019, "RFB", "e2")


def test_text_in_force_modes(spark):
    segments = spark.createDataFrame([(1, 7, v, v == 3) for v in (1, 2, 3)], "ato_id long, id_segmento long, versao int, is_omitido boolean")
    changes = spark.createDataFrame([(1, 1, 7, D(2010, 1, 1)), (2, 1, 7, D(2015, 6, 30)), (3, 1, 7, None)], "id long, ato_id long, id_segmento long, data date")
    acts = spark.createDataFrame([(1, D(2000, 1, 1))], "ato_id long, data_publicacao date")
    valid = T.validity(segments, changes, acts)

    def version(at, mode="before_max"):
        return [r["versao"] for r in T.in_force(valid, at, mode).collect()]

    assert version("1999-12-31") == [] and version("2009-12-31") == [1] and version("2010-01-01") == [2]
    assert version("2016-01-01") == [2] and version("2016-01-01", "after_max") == [] and version("2016-01-01", "ignore") == [3]


def test_conflicts_scenario(spark):
    a, b, c = [1.0, 0.0], [0.99, 0.1], [0.0, 1.0]
    rows = [(1, "x", 1, D(2020, 1, 1), "AUTORIZA", a), (2, "y", 1, D(2019, 1, 1), "VEDA", b), (3, "x", 1, D(2020, 1, 1), "VEDA", b), (4, "z", 1, D(2020, 1, 1), "VEDA", c), (5, "w", 1, D(2020, 1, 1), "VEDA", a), (6, "w", 2, D(2020, 1, 1), "VEDA", a)]
    df = spark.createDataFrame(rows, "id long, ato string, theme int, data date, sinal string, embedding array<double>")
    edges = spark.createDataFrame([("x", "y")], "origem string, destino string")
    found = {(r["materia_a"], r["materia_b"]): (r["supera"], r["formal"]) for r in C.conflicts(df, edges, 0.85).collect()}
    assert found == {(2, 1): (True, True), (1, 5): (False, False)}


def test_similar_pairs_over_many_blocks(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(C, "BLOCK", 7)
    v = np.random.default_rng(1).standard_normal((60, 4))
    df = spark.createDataFrame([(k, k % 2, x.tolist()) for k, x in enumerate(v)], "id long, theme int, embedding array<double>")
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if i % 2 == j % 2 and unit[i] @ unit[j] > 0.5}
    assert {(r["a"], r["b"]) for r in C.similar_pairs(df, 0.5).collect()} == want


def test_merge_is_idempotent_and_null_safe(spark):
    target = spark.createDataFrame([(1, None, "a"), (2, "k", "b")], "id long, k string, v string")
    rows = spark.createDataFrame([(1, None, "c"), (3, None, "d"), (3, None, "d")], "id long, k string, v string")
    once = M.upsert(target, rows, ["id", "k"])
    assert {tuple(r) for r in once.collect()} == {(1, None, "c"), (2, "k", "b"), (3, None, "d")}
    assert M.change_log(once, M.upsert(once, rows, ["id", "k"]), ["id", "k"], ["v"]).count() == 0
    assert {r["action"] for r in M.classified(once, rows, ["id", "k"]).collect()} == {"unchanged"}
    assert M.insert_missing(target, rows, ["id", "k"]).count() == 3


def _store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/t", ["id"], spark.range(1).withColumn("v", F.lit("")).schema, 4)


def test_store_publishes_whole_states(spark, tmp_path):
    def rows(*ids):
        return spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string")

    store = _store(spark, tmp_path)
    assert store.read().count() == 0
    store.replace(rows(0, 1, 2))
    store.replace(M.upsert(store.read(), rows(2, 3, 4), ["id"]))
    assert sorted(r["id"] for r in store.read().collect()) == [0, 1, 2, 3, 4]
    only = [r[0] for r in rows(3).select(store.bucket()).collect()]
    store.replace(store.read(only).where("id <> 3"), only)
    assert sorted(r["id"] for r in _store(spark, tmp_path).read().collect()) == [0, 1, 2, 4]
    store.replace(rows())
    assert store.read().count() == 0 and len(store._numbers()) == 2


@pytest.mark.parametrize("step", ["replace", "_publish", "_sweep"])
def test_a_writer_that_dies_leaves_the_old_or_the_new_state(spark, tmp_path, monkeypatch, step):
    def write(number, ids):
        batch = spark.createDataFrame([(i, number) for i in ids], "id long, at long")
        stream.upsert_sink(f"file://{tmp_path}/t", ["id"], "at")(batch, number)

    def state():
        store = Store(spark, f"file://{tmp_path}/t", ["id"], spark.createDataFrame([], "id long, at long").schema)
        return sorted((r["id"], r["at"]) for r in store.read().collect())

    write(0, [1, 2])
    real = getattr(Store, step)

    def dies(self, *args):
        if step == "_publish":  # between the draft and its new name
            self._fs.create(self._at(".draft-x"), False).close()
        raise KeyboardInterrupt

    monkeypatch.setattr(Store, step, dies)
    with pytest.raises(KeyboardInterrupt):
        write(1, [2, 3])
    monkeypatch.setattr(Store, step, real)
    assert state() == ([(1, 0), (2, 1), (3, 1)] if step == "_sweep" else [(1, 0), (2, 0)])
    write(1, [2, 3])  # the batch comes again
    assert state() == [(1, 0), (2, 1), (3, 1)]
    write(2, [4])
    assert state() == [(1, 0), (2, 1), (3, 1), (4, 2)]
    left = [x.name for x in (tmp_path / "t").iterdir()]
    assert not [x for x in left if x.startswith(".draft")] and sum(x.startswith("manifest") for x in left) == 2


def test_two_writers_of_one_state(spark, tmp_path):
    one, two = _store(spark, tmp_path), _store(spark, tmp_path)
    rows = spark.createDataFrame([(1, "a")], "id long, v string")
    one.replace(rows)
    with pytest.raises(OSError, match="another writer"):
        two._publish(1, {})
    assert one.read().count() == 1


def test_next_ids_over_many_ranges(spark):
    rows = spark.createDataFrame([(f"k{k % 50:03}", k) for k in range(500)] + [(None, 1000)], "k string, n long").repartition(7)
    out = M.next_ids(rows, spark.createDataFrame([(41,)], "id long"), "id", ["k", "n"]).orderBy("id").collect()
    assert [r["id"] for r in out] == list(range(42, 42 + 501))
    assert [(r["k"] or "", r["n"]) for r in out] == sorted((r["k"] or "", r["n"]) for r in out)
    assert [r["id"] for r in M.next_ids(rows.limit(1), spark.createDataFrame([], "id long"), "id", ["n"]).collect()] == [1]


def test_response_classes(spark):
    rows = [(404, "text/html", b"x"), (503, None, b""), (429, None, b"x"), (200, "text/html", b"%PDF-1"), (200, "text/html", b"<p>"), (200, None, b"  <!DOCTYPE html>"), (200, "application/pdf", b""), (200, "application/pdf", b"z"), (200, "x/y", b"z"), (200, None, None)]
    df = spark.createDataFrame(rows, "s int, c string, b binary")
    found = [r[0] for r in df.select(Q.response_class(F.col("s"), F.col("c"), F.col("b"))).collect()]
    assert found == ["sem_pdf_no_portal", "erro_http", "bloqueado", "baixado", "sem_pdf_no_portal", "sem_pdf_no_portal", "erro_http", "baixado", "baixado", "erro_http"]


def test_budget_skips_and_bins_keep_atoms(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 4.0), (4, 2.0), (0, None)], "id long, c double").withColumn("g", F.lit("a"))
    assert [r["id"] for r in Q.admit_within_budget(rows, "c", ["id"], 10.0, "g").where("aceito").orderBy("id").collect()] == [1, 3]
    units = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 1), (3, 1)], "ato long, n int").withColumn("g", F.lit("a"))
    packed = Q.pack(units, "n", ["ato"], 3, "g", atom="ato")
    assert {r["ato"]: r["bin"] for r in packed.collect()} == {1: 0, 2: 1, 3: 1}


def test_backoff_is_capped_after_jitter(spark):
    r = spark.range(1).select(scoring.backoff(F.lit(1), F.lit(0.5)).alias("a"), scoring.backoff(F.lit(20), F.lit(0.99)).alias("b")).first()
    assert r["a"] == 120.0 and r["b"] == 21600.0


def test_gate_thresholds(spark):
    rows = [(1, 10, 2, 5, 2, 20, 0.8), (2, 10, 3, 0, 0, 4, None), (3, 10, 0, 6, 0, 4, None), (4, 10, 0, 0, 0, 20, 0.79), (5, 10, 0, 0, 3, 19, 0.1)]
    df = spark.createDataFrame(rows, "ato_id long, materias int, sem_solucao int, fora_da_taxonomia int, desancoradas int, artigos_no_texto int, cobertura_artigos double")
    found = {r["ato_id"]: r["motivos"] for r in G.gate(df).collect()}
    assert found == {1: [], 2: ["sem solução"], 3: ["fora da taxonomia"], 4: ["cobertura de artigos"], 5: ["sem âncora"]}


def test_merged_parts_keep_first_and_tell_divergence(spark):
    import json

    def reply(e, n):
        return json.dumps({"ato_metadata": {"eficacia": e}, "materias": [{"tema_macro": "A", "solucao": "s"}] * n})

    rows = spark.createDataFrame([(1, 2, reply("v2", 1)), (1, 1, reply("v1", 2)), (1, 3, reply(None, 0))], "ato_id long, parte int, r string")
    out = G.merged(G.parsed(rows, "r").select("ato_id", "parte", "saida")).first()
    assert out["eficacia"] == "v1" and out["divergencia_eficacia"] == ["v1", "v2"] and len(out["materias"]) == 3 and out["partes_sem_materia"] == [3]
