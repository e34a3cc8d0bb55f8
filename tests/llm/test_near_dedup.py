from __future__ import annotations

import random
from pathlib import Path

import pytest

from actlens.llm import common
from actlens.llm import near_dedup as N


def brute(rows, size, percent):
    sets = {i: N.shingle_set(N.words_of(t or ""), size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    rows, texts = [], []
    for i in range(n):
        kind = draw.random()
        if texts and kind < 0.6:
            w = draw.choice(texts).split()
            for _ in range(draw.randint(0, 6)):
                if w:
                    w[draw.randrange(len(w))] = draw.choice(words)
            text = " ".join(w)
        else:
            text = " ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 1, 2, 3, 30, 60, 90])))
        texts.append(text)
        rows.append((i * 3, text if draw.random() > 0.03 else None))
    return rows


@pytest.mark.parametrize(("size", "seed", "hot"), [(2, 1, 6), (5, 2, 1024)])
def test_components_equal_brute_force(spark, monkeypatch, size, seed, hot):
    monkeypatch.setattr(N, "BLOCK", 8)
    monkeypatch.setattr(N, "TEXTS", 4)
    monkeypatch.setattr(common, "HOT", hot)  # some keys by broadcast and others joined, or all by broadcast
    rows = corpus(seed, 220)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    found = {r["doc_id"]: r for r in N.near_duplicates(docs, size, 80).collect()}
    want = brute(rows, size, 80)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in found.items())


def test_edges(spark):
    rows = [(5, "A b"), (3, "a  B"), (9, ""), (8, None), (7, " \t"), (6, "solo"), (4, "SOLO"), (None, "a b"), (5, "a b"), (2, "É b"), (1, "é b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(docs, 2).collect()), key=str)
    assert found == sorted([(5, 1, 3, False), (5, 1, 3, False), (3, 1, 3, True), (9, 0, 9, True), (8, 0, 8, True), (7, 0, 7, True), (6, 1, 4, False), (4, 1, 4, True), (None, 1, None, True), (2, 1, 2, True), (1, 1, 1, True)], key=str)
    assert N.near_duplicates(docs.limit(0)).count() == 0


def test_deduplicate_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "k"), (2, "a b c d e f", "k"), (3, None, None)], "doc_id long, text string, kept string")
    out = N.deduplicate(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3]


def test_thresholds_prune_little_at_the_limit():
    least = N.least_matches(80)
    assert least[N.HASHES] < 0.8 * N.HASHES and least[N.HASHES] > 0.65 * N.HASHES
    assert all(a <= b for a, b in zip(least, least[1:], strict=False))


def test_components_of_a_chain(spark):
    from actlens.llm.common import Scratch, components

    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 100), (201, 200)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(Scratch(spark, "t"), edges).collect()}
    assert found == {**{k: 0 for k in range(41)}, 200: 200, 201: 200}
    assert components(Scratch(spark, "t"), edges.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [1, 4, 1024])
def test_spread_join_equals_a_join(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT", hot)
    rows = spark.createDataFrame([(k % 7 if k % 2 else 1, k) for k in range(200)] + [(None, 900), (50, 901)], "a long, v long")
    firsts = rows.where("a < 50").groupBy("a").count().withColumnRenamed("count", "n").selectExpr("a", "a * 10 as w", "n").where("a <> 3")
    out = common.spread_join(rows, firsts, ["a"])
    assert sorted((r["a"], r["v"], r["w"]) for r in out.collect()) == sorted((r["a"], r["v"], r["a"] * 10) for r in rows.collect() if r["a"] not in (None, 3, 50))


def test_tables_of_numbers_take_few_files(spark):
    scratch = common.Scratch(spark, "files")
    changed = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        found = common.components(scratch, spark.range(4000).selectExpr("id + 4000 as a", "id div 2 as b"))
        assert found.count() == 6000 and found.where("component = node").count() == 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    tables = [[f.name for f in t.iterdir()] for t in Path(scratch.root.removeprefix("file://")).iterdir()]
    assert tables and all(0 < sum(f.endswith(".parquet") for f in t) <= 4 * spark.sparkContext.defaultParallelism for t in tables)
    assert not any("_SUCCESS" in t for t in tables)
    scratch.clear()
