"""Coverage on twelve acts, one per situation."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from actlens.operators import coverage as V
from actlens.operators import merge as M
from actlens.operators import queues as Q


@pytest.fixture(scope="module")
def acts(spark):
    ok, gone = "vigente_nunca_alterado", "nao_disponivel_portal"
    rows = [
        (1, "SC", 2023, ok, True, True, True), (2, "SC", 2023, ok, True, True, False), (3, "SC", 2024, ok, True, True, True), (4, "PORTARIA", 2022, ok, True, False, False),
        (5, "ADE", 2021, ok, True, False, False), (6, "PN", 2020, ok, True, True, False), (7, "NOTA", 2019, ok, False, False, False), (16630, "INSTRUCAO_NORMATIVA", 2022, gone, False, False, True),
        (16707, "INSTRUCAO_NORMATIVA", 2023, ok, True, True, False), (14575, "SC", 2025, ok, True, True, True), (12100, "SC", 2023, ok, True, True, True), (20, "AD", 2018, gone, False, False, True),
    ]
    return spark.createDataFrame(rows, "id long, tipo_ato string, ano int, status_vigencia string, pdf_disponivel boolean, content_disponivel boolean, analise_completa boolean").withColumn("data_publicacao", F.make_date("ano", F.lit(1), F.lit(1)))


@pytest.fixture(scope="module")
def contents(spark):
    rows = [(i, "texto", "p") for i in (1, 2, 3, 5, 16707, 14575, 12100)] + [(4, "   ", "p"), (6, None, None)]
    return spark.createDataFrame(rows, "ato_id long, texto_completo string, pdf_path string")


@pytest.fixture(scope="module")
def matters(spark):
    rows = [(1, [1.0]), (3, [1.0]), (3, None), (5, [1.0]), (14575, [1.0]), (12100, [1.0])]
    return spark.createDataFrame(rows, "ato_id long, embedding array<double>")


def counts(df):
    return {r["defeito"]: r["n"] for r in df.collect()}


def test_funnel_and_defects(acts, contents, matters):
    flagged = V.flags(acts, contents, matters)
    f = V.funnel(flagged).first()
    assert (f["total"], f["com_texto"], f["com_materia"], f["embeddados"]) == (12, 7, 5, 4)
    assert counts(V.defect_counts(flagged)) == {"D1": 2, "D2": 1, "D3": 1, "D4": 2, "D5": 2, "D6": 1, "D7": 5, "D8": 2}


def test_stages(acts, contents, matters):
    found = {r["id"]: r["estagio"] for r in V.stage(V.flags(acts, contents, matters)).collect()}
    assert found[1] == "5_embeddado" and found[3] == "4_categorizado" and found[2] == "3_com_texto"
    assert found[16630] == "0_pendente" and found[7] == "0_pendente"


def test_missing_vectors_are_not_counted(acts, contents, matters):
    found = counts(V.defect_counts(V.flags(acts, contents, matters.drop("embedding"))))
    assert found["D6"] is None and found["D5"] == 2


def test_backfill_infers_text_and_never_absence(spark, acts, contents):
    first = V.inferred_collection(acts, contents)
    states = {r["pdf_status"]: r["count"] for r in first.groupBy("pdf_status").count().collect()}
    assert states == {"baixado": 7, "nao_tentado": 5}
    assert V.inferred_collection(acts, contents, first).count() == 0


def test_attempts_change_d7_and_1b(spark, acts, contents, matters):
    coleta = spark.createDataFrame([(7, "sem_pdf_no_portal", 1), (16630, "erro_http", 3)], "ato_id long, pdf_status string, tentativas int")
    flagged = V.flags(acts, contents, matters, coleta)
    assert counts(V.defect_counts(flagged))["D7"] == 3
    assert V.funnel(flagged).first()["sem_pdf_no_portal"] == 1


def test_retry_queue_order(spark, acts, contents):
    coleta = spark.createDataFrame([], "ato_id long, pdf_status string, proxima_tentativa timestamp, tentativas int")
    found = [r["id"] for r in Q.retry_queue(acts, contents, coleta, "2026-01-01", 100).collect()]
    assert set(found) == {4, 6, 7, 16630, 20} and found[0] == 16630


def test_pending_queue(spark, acts, contents, matters):
    found = {r["id"] for r in Q.pending(acts, contents, matters).collect()}
    assert 2 in found and not found & {1, 3, 4, 6}


def test_constraint_tolerates_old_rows_and_rejects_new(acts):
    rule = M.Constraints().check("analise_exige_conteudo", ~(F.col("analise_completa") & ~F.col("content_disponivel")))
    assert rule.validate(acts).count() == 2
    with pytest.raises(ValueError, match="analise_exige_conteudo"):
        rule.enforce(acts.where("id = 20"))
    rule.enforce(acts.where("id = 1"))


def test_focus_names_absent_acts(acts, contents, matters):
    found = {r["id"]: r["existe"] for r in V.focus(V.flags(acts, contents, matters), [1, 99]).collect()}
    assert found == {1: True, 99: False}
