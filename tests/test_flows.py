"""Sources, sinks, runs, search and the command line on small tables."""

from __future__ import annotations

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from actlens import cli, schema
from actlens.functions import scoring
from actlens.functions import text as X
from actlens.operators import conflicts as C
from actlens.operators import matters as G
from actlens.operators import merge as M
from actlens.operators import normalize as N
from actlens.operators import queues as Q
from actlens.operators import runs
from actlens.operators import search as S
from actlens.operators import temporal as T
from actlens.sources import portal, tables
from actlens.sources.scratch import shared_dir
from actlens.streaming import stream


def test_view_files_leave_broken_ones_out(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"idAto": 1, "vigente": True, "ementas": [{"idSegmento": 1, "textoIntegra": "x"}]}, indent=1))
    (tmp_path / "b.json").write_text("{\"idAto\": 2, ")
    assert [r["idAto"] for r in portal.read_views(spark, str(tmp_path)).collect()] == [1]


def test_pages_of_a_listing(spark):
    page = spark.createDataFrame([("<select name=\"p\"><option value=\"1\">1<option value=\"12\"></select>",), ("<p>",), (None,)], "h string")
    assert [r["n"] for r in page.select(portal.page_numbers(F.col("h")).alias("n")).collect()] == [[1, 12], [], None]


def test_pdf_texts_survive_corrupt_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1 one")
    (tmp_path / "b.pdf").write_bytes(b"broken")

    def extract(raw):
        return raw.decode().split("%PDF-1 ")[1]

    found = {r["path"].rsplit("/", 1)[-1]: r["texto"] for r in tables.pdf_texts(spark, str(tmp_path), extract).collect()}
    assert found == {"a.pdf": "one", "b.pdf": ""}


def test_configuration_files(tmp_path):
    (tmp_path / "v.json").write_text(json.dumps({"tributos": {"_canonicos": ["PIS"]}}), encoding="utf-8")
    assert tables.read_json_config(str(tmp_path / "v.json")) == N.read_vocabulary(str(tmp_path / "v.json")) == {"tributos": {"_canonicos": ["PIS"]}}


def test_database_tables_are_read_in_ranges(spark):
    jvm = spark._jvm
    url = "jdbc:derby:memory:acts;create=true"
    jvm.java.lang.Class.forName("org.apache.derby.iapi.jdbc.AutoloadedDriver", True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    connection = jvm.java.sql.DriverManager.getConnection(url)
    statement = connection.createStatement()
    statement.execute("CREATE TABLE ATO (ID INT, NOME VARCHAR(20))")
    statement.execute("INSERT INTO ATO VALUES " + ", ".join(f"({k}, 'n{k}')" for k in range(50)))
    rows = tables.read_jdbc(spark, url, "ATO", "ID", 0, 50, parts=4, fetch=7)
    assert rows.rdd.getNumPartitions() == 4 and sorted(r["ID"] for r in rows.collect()) == list(range(50))
    connection.close()


def test_reports(spark, tmp_path):
    text = tables.write_report({"acts": spark.createDataFrame([(1, None), (2, "b")], "id long, nome string").orderBy("id")}, f"file://{tmp_path}/r", "Coverage")
    assert text == "# Coverage\n\n## acts\n\n| id | nome |\n| - | - |\n| 1 |  |\n| 2 | b |"
    assert spark.read.option("header", True).csv(f"{tmp_path}/r/acts").count() == 2


def test_appends_are_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id long, v string")
    for _ in range(2):
        tables.append_missing(rows, f"file://{tmp_path}/t", ["id"])
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [(1, "a"), (2, "b")]
    tables.append(rows.withColumn("p", F.lit(1)), f"file://{tmp_path}/p", ["p"])
    assert (tmp_path / "p" / "p=1").exists()


def test_write_permission(spark, tmp_path):
    (tmp_path / "open").mkdir()
    (tmp_path / "shut").mkdir(mode=0o500)
    (tmp_path / "shut").chmod(0o500)
    assert tables.can_write(spark, f"file://{tmp_path}/open/new/t") and not tables.can_write(spark, f"file://{tmp_path}/shut/t")


def test_a_cluster_needs_a_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    nowhere = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False)))
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=SimpleNamespace(_jsc=nowhere, master="spark://x", applicationId="a"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(bare)
    bare.sparkContext.master = "local[2]"
    assert shared_dir(bare) == shared_dir(bare) and shared_dir(bare).startswith("file:///")


def test_locks_and_attempts(tmp_path):
    with runs.RunLock(str(tmp_path), "2024-01-02T03:00:00") as lock:
        assert lock.keep_attempt("one").name == "2024-01-02-1.txt" and lock.keep_attempt("two").name == "2024-01-02-2.txt"
        with pytest.raises(RuntimeError, match="holds the lock"), runs.RunLock(str(tmp_path), "2024-01-02T14:00:00"):
            pass
        with runs.RunLock(str(tmp_path), "2024-01-02T15:30:00"):
            pass
    assert not (tmp_path / "lock").exists()


def test_semantic_smoke(spark):
    rows = spark.createDataFrame([(k, [float(k == j) + 0.01 for j in range(3)]) for k in range(3)], "id long, v array<double>")
    assert runs.semantic_smoke(rows, [1.0, 0.0, 0.0], "id", "v", [0], 1) and not runs.semantic_smoke(rows, [1.0, 0.0, 0.0], "id", "v", [1], 1)


def test_what_is_tried_again(spark):
    rows = [("erro_http", 403), ("erro_http", 410), ("erro_http", 503), ("bloqueado", 429), ("erro_rede", None), ("erro_http", None), ("baixado", 200), ("erro_http", 408), (None, None)]
    df = spark.createDataFrame(rows, "s string, h int")
    assert [r[0] for r in df.select(Q.retriable(F.col("s"), F.col("h"))).collect()] == [False, False, True, True, True, False, False, True, False]


def test_terms_are_values(spark):
    rows = spark.createDataFrame([(1, "d'agua agua", [1.0, 0.0]), (2, "x', y", [0.0, 1.0]), (3, None, None)], "id long, body string, embedding array<double>")
    assert S.lexical(rows, ["x') or ('1' = '1"], "id", "body", 5).collect() == []
    assert [r["id"] for r in S.lexical(rows, ["agua"], "id", "body", 5).collect()] == [1]
    assert S.lexical(rows, [], "id", "body", 5).collect() == [] and S.nearest(rows, [], "id", "embedding", 5).collect() == []
    quoted = S.lexical(rows, ["d'agua"], "id", "body", 5, lambda c: F.split(c, " "))
    assert [r["id"] for r in quoted.collect()] == [1]
    assert [r["id"] for r in S.hybrid(rows, [], [0.0, 2.0], F.lit(1.0)).collect()] == [2, 1]
    assert S.hybrid(rows, ["nothing"], [], F.lit(1.0)).collect() == []


def test_secondary_weights(spark):
    rows = [("consultiva", "SOLUCAO_DIVERGENCIA", None), ("consultiva", "SOLUCAO_CONSULTA", "COSIT"), ("consultiva", "SOLUCAO_CONSULTA", "DISIT"), ("normativa", "DECRETO", "x"), ("normativa", "SOLUCAO_CONSULTA", "COSIT"), (None, None, None)]
    df = spark.createDataFrame(rows, "n string, k string, i string")
    assert [r[0] for r in df.select(scoring.secondary(F.col("n"), F.col("k"), F.col("i"))).collect()] == [1.15, 1.1, 1.0, 1.05, 1.0, 1.0]


def test_conflict_table_keeps_notes(spark):
    table = spark.createDataFrame([(1, 2, 0.5, "seen", "T"), (3, 4, 0.6, None, "U")], "materia_a long, materia_b long, sim double, observacao string, tema string")
    found = spark.createDataFrame([(1, 2, 0.9, "T"), (5, 6, 0.7, "T")], "materia_a long, materia_b long, sim double, tema string")
    out = C.upserted(table, found)
    assert {tuple(r) for r in out.collect()} == {(1, 2, 0.9, "seen", "T"), (3, 4, 0.6, None, "U"), (5, 6, 0.7, None, "T")}
    assert {r["tema"] for r in C.cleared(out, "tema", ["T"]).collect()} == {"U"} and C.cleared(out, "tema").count() == 0


def test_models_are_injected_and_replies_stored_once(spark):
    def model(frame):
        return frame.assign(resposta=frame["texto"].str.upper())[["chave", "resposta"]]

    rows = spark.createDataFrame([("a", 1), ("b", 2), ("a", 1)], "texto string, n int").withColumn("chave", Q.request_key("texto", "n"))
    asked = Q.unanswered(rows, spark.createDataFrame([], "chave string"))
    replies = Q.call_model(asked, "chave string, resposta string", model, batch=1)
    assert sorted(r["resposta"] for r in replies.collect()) == ["A", "B"]
    assert Q.unanswered(rows, replies).count() == 0 and all(len(r["chave"]) == 24 for r in replies.collect())


def test_exit_codes(spark):
    def code(rows, names):
        return G.exit_code(spark.createDataFrame(rows, names))

    assert code([(1, None, False), (2, "", None)], "id long, erro string, sem_vetor boolean") == 0
    assert code([(1, None, False), (2, "x", None)], "id long, erro string, sem_vetor boolean") == 1
    assert code([(1, True)], "id long, sem_sinal boolean") == 1 and code([(1,)], "id long") == 0


def test_text_in_force_as_a_sql_function(spark):
    rows = [(1, 10, 1, 1, "old", "2000-01-01", False), (1, 10, 2, 1, "new", "2005-01-01", False), (1, 10, 3, 1, "gone", "2006-01-01", True), (1, 11, 1, 2, "other", "2004-01-01", None), (2, 10, 1, 1, "x", "2000-01-01", False)]
    valid = spark.createDataFrame(rows, "ato_id long, id_segmento long, versao int, ordem int, texto_integra string, d string, is_omitido boolean").withColumn("inicio", F.col("d").cast("date")).drop("d")
    T.register_text_in_force(valid)

    def shown(act, day):
        return [r["texto_integra"] for r in spark.sql(f"SELECT * FROM texto_vigente_em({act}, DATE '{day}') ORDER BY ordem").collect()]

    assert shown(1, "2003-01-01") == ["old"] and shown(1, "2007-01-01") == ["new", "other"] and shown(2, "2007-01-01") == ["x"] and shown(3, "2007-01-01") == []
    same = T.in_force(valid.where("ato_id = 1"), "2007-01-01").orderBy("ordem").collect()
    assert [r["texto_integra"] for r in same] == shown(1, "2007-01-01")


def test_seeds_of_unknown_tables_fail(spark):
    one = spark.createDataFrame([("a", "x")], "codigo string, nome string")
    assert N.seeded({"t": one, "u": one}, {"t": one.withColumn("nome", F.lit("y"))})["t"].first()["nome"] == "y"
    with pytest.raises(KeyError):
        N.seeded({"t": one}, {"v": one})


def test_streamed_sessions_and_first_rows(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 00:05:00", 2.0), (1, "2024-01-01 02:00:00", 3.0), (2, "2024-01-01 00:00:00", 4.0), (2, "2024-01-01 00:00:00", 4.0)]
    events = spark.createDataFrame(rows, "user_id long, t string, value double").select("user_id", F.col("t").cast("timestamp").alias("ts"), "value")
    events.write.parquet(f"{tmp_path}/in")
    live = stream.read_stream(spark, f"{tmp_path}/in", "user_id long, ts timestamp, value double")
    got: dict = {}

    def keep(name):
        def write(batch, number):
            got.setdefault(name, []).extend(tuple(r) for r in batch.collect())

        return write

    def run(df, name, mode):
        df.writeStream.foreachBatch(keep(name)).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start().awaitTermination()

    run(stream.sessions(live, "ts", "user_id", "10 minutes").select("user_id", "n"), "sessions", "complete")
    assert sorted(got["sessions"]) == sorted(tuple(r) for r in stream.sessions(events, "ts", "user_id", "10 minutes").select("user_id", "n").collect()) == [(1, 1), (1, 2), (2, 2)]
    run(stream.first_seen(live, ["user_id", "ts"], "ts").select("user_id", "value"), "first", "append")
    assert sorted(got["first"]) == [(1, 1.0), (1, 2.0), (1, 3.0), (2, 4.0)]
    assert stream.first_seen(events, ["user_id", "ts"], "ts").count() == 4


@pytest.fixture(scope="module")
def acts(spark, tmp_path_factory):
    """A folder of logical tables with four acts."""
    root = tmp_path_factory.mktemp("acts")

    def put(name, rows):
        struct = schema.struct(name)
        for f in struct:
            f.nullable = True
        whole = [tuple(r.get(f.name) for f in struct) for r in rows]
        spark.createDataFrame(whole, struct).write.parquet(f"{root}/{name}")

    import datetime

    put("ato", [{"id": k, "tipo_ato": "SOLUCAO_CONSULTA", "numero": str(k), "ano": 2000 + k, "emissor": "COSIT", "data_publicacao": datetime.date(2000 + k, 1, 1), "eficacia_atual": "vinculante_cosit", "status_vigencia": "vigente_nunca_alterado", "pdf_disponivel": True} for k in range(1, 5)])
    put("ato_content", [{"ato_id": 1, "texto_completo": "t", "tipo_versao": "vigente"}])
    put("ato_materia", [{"id": 10 + k, "ato_id": k, "ordem": 1, "tema_macro": "PIS", "tema_especifico": "PIS.X", "solucao": "crédito de frete permitido" if k % 2 else "nada", "sinal": "AUTORIZA" if k % 2 else "VEDA", "embedding": [1.0, float(k) / 10]} for k in range(1, 4)])
    put("materia_dispositivo", [{"id": 1, "materia_id": 11, "tipo_norma": "tema_stf"}])
    put("ato_relacao", [{"id": 1, "ato_origem_id": 2, "ato_destino_id": 1, "tipo_relacao": "altera"}])
    put("conflito_temporal", [])
    put("ato_coleta", [{"ato_id": 3, "pdf_status": "sem_pdf_no_portal", "tentativas": 1}])
    put("rotina_execucao", [{"run_id": "r1", "inicio": datetime.datetime(2024, 1, 1, 1), "fim": datetime.datetime(2024, 1, 1, 2), "estado": "ok", "erros_coleta": 0, "erros_categorizacao": 1, "lotes_enviados": 0}])
    spark.createDataFrame([("enviado", 1), ("enviado", 2)], "estado string, lote long").write.parquet(f"{root}/lote")
    return str(root)


def rows_of(spark, acts, tmp_path, *args):
    out = f"{tmp_path}/out{abs(hash(args))}"
    assert cli.main([*args, "--data", acts, "--as-of", "2024-06-01", "--write", out]) == 0
    return spark.read.parquet(out).collect()


def test_command_line(spark, acts, tmp_path, capsys):
    found = rows_of(spark, acts, tmp_path, "search", "créditos", "fretes", "--like", "11", "--mode", "consultivo")
    assert found and max(found, key=lambda r: r["score"])["id"] == 11
    assert {r["value"]: r["n"] for r in rows_of(spark, acts, tmp_path, "facets", "sinal")} == {"AUTORIZA": 2, "VEDA": 1}
    assert sorted(r["ano"] for r in rows_of(spark, acts, tmp_path, "timeline", "PIS.X")) == [2001, 2002, 2003]
    assert [r["ano"] for r in rows_of(spark, acts, tmp_path, "timeline", "PIS", "--binding-at", "2002-06-01")] == [2001, 2002]
    pairs = {(r["materia_a"], r["materia_b"]): r["formal"] for r in rows_of(spark, acts, tmp_path, "conflicts", "--theme", "PIS.X")}
    assert pairs == {(11, 12): True, (12, 13): False}
    assert rows_of(spark, acts, tmp_path, "conflicts", "--clear") == []
    assert [r["materia_b"] for r in rows_of(spark, acts, tmp_path, "conflicts", "--review")] == [13]
    defects = {r["defeito"]: r["n"] for r in rows_of(spark, acts, tmp_path, "audit", "--type", "SOLUCAO_CONSULTA")}
    assert defects["D4"] == 3 and defects["D7"] == 2
    assert {r["id"]: r["existe"] for r in rows_of(spark, acts, tmp_path, "audit", "--focus", "1", "99")} == {1: True, 99: False}
    assert [r["sem_texto"] for r in rows_of(spark, acts, tmp_path, "audit", "--by", "tipo_ato", "--years", "2002", "2004")] == [3]
    assert sorted(r["id"] for r in rows_of(spark, acts, tmp_path, "backfill")) == [2, 4]
    assert rows_of(spark, acts, tmp_path, "pending") == []
    assert [tuple(r) for r in rows_of(spark, acts, tmp_path, "batches")] == [("enviado", 2)]
    assert rows_of(spark, acts, tmp_path, "routine", "--check", "2024-01-01")[0].asDict() == {"ultima": rows_of(spark, acts, tmp_path, "routine")[0]["inicio"], "atrasada": False, "rodar": False, "enviar_lote": True}
    assert rows_of(spark, acts, tmp_path, "routine", "--plan")[0]["total"] == 4
    assert cli.main(["routine", "--panel", "--data", acts]) == 0 and cli.main(["audit", "--explain", "--data", acts]) == 0 and cli.main(["list"]) == 0
    assert "hybrid_search" in capsys.readouterr().out


def test_analyser_of_search(spark):
    row = spark.range(1).select(X.portuguese_terms(F.lit("Os créditos de Fretes, não-cumulativos")).alias("t")).first()
    assert row["t"] == ["credit", "fret", "cumulativ"]
    assert M.insert_missing(spark.createDataFrame([(1,)], "id long"), spark.createDataFrame([(1,), (2,)], "id long"), ["id"]).count() == 2
