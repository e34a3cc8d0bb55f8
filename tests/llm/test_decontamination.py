"""Retrieval of benchmark passages against common subsequences and answers over all pairs."""

from __future__ import annotations

import random

import numpy as np

from actlens.llm import decontamination as D


def brute_force(docs: list[tuple[int, str]], items: list[tuple[int, str]]) -> dict[tuple[int, int], float]:
    """(doc, item) -> share in order, of all pairs that pass the two tests in any window."""
    found: dict[tuple[int, int], float] = {}
    parts = D.passages(items)
    numbers: dict[bytes, int] = {}
    coded = [(i, [numbers.setdefault(w, len(numbers)) for w in p], [numbers.setdefault(w, len(numbers)) for w in a]) for i, p, a in parts]
    masks = [(D.masks_of(p), len(p), D.masks_of(a), len(a)) for _, p, a in coded]
    width = max(len(p) for _, p, _ in coded)
    grid = np.array([p + [len(numbers)] * (width - len(p)) for _, p, _ in coded])
    for doc, text in docs:
        words = [numbers.get(w.strip(D.EDGES), -1) for w in D.words_of(text or "")]
        held = np.zeros(len(numbers) + 1, bool)
        held[[w for w in words if w >= 0]] = True
        enough = held[grid].sum(1) >= D.COVERED * np.array([len(p) for _, p, _ in coded])
        for k in np.flatnonzero(enough):
            pattern, n, answer, m = masks[k]
            for start in range(0, max(1, len(words)), D.SEGMENT):
                region = words[max(0, start - n // 2) : start + 2 * D.SEGMENT + n // 2]
                share = D.common_subsequence(pattern, n, region) / n
                if share < D.COVERED:
                    continue
                answered = D.common_subsequence(answer, m, region) / m if m else 1.0
                if share >= D.SURE or answered >= D.ANSWERED:
                    key = doc, coded[k][0]
                    found[key] = max(found.get(key, 0.0), share)
    return found


def passage(draw, words, n=48):
    """Three sentences and an answer."""
    w = draw.sample(words, n)
    return " ".join(x + ("." if k % 12 == 11 else "") for k, x in enumerate(w))


def test_all_pairs_of_a_thousand_items_and_two_thousand_documents(spark):
    draw = random.Random(21)
    # words of prose: some common, most rare
    words = [f"term{k}" for k in range(8000)]
    common = [f"the{k}" for k in range(60)]
    items = [(k, passage(draw, words + common * 8)) for k in range(1000)]
    docs, copies, paraphrases = [], set(), set()
    for d in range(2000):
        w = [draw.choice(common) if draw.random() < 0.4 else draw.choice(words) for _ in range(draw.randint(20, 160))]
        if d % 5 < 2:
            item = items[draw.randrange(1000)]
            planted = item[1].split()
            if d % 5:  # other words for 15 to 35 in 100, the answer stands
                rate = draw.uniform(0.15, 0.35)
                planted = [draw.choice(words) if k < 36 and draw.random() < rate else x for k, x in enumerate(planted)]
            at = draw.randint(0, len(w))
            w[at:at] = planted
            (paraphrases if d % 5 else copies).add((d, item[0]))
        docs.append((d, " ".join(w)))
    want = brute_force(docs, items)
    assert copies <= set(want)
    rows = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r["doc_id"], r["item_id"]): r["lcs_share"] for r in rows}
    assert set(found) <= set(want) and copies <= set(found)
    hit = len(set(want) & paraphrases & set(found)) / len(set(want) & paraphrases)
    print("copies", len(copies), "paraphrases", len(set(want) & paraphrases), "found", hit)
    assert len(set(want) & paraphrases) > 300 and hit >= 0.97
    assert all(found[k] <= want[k] + 1e-9 for k in found) and sum(found[k] >= want[k] - 1e-9 for k in found) >= 0.97 * len(found)


def test_small_corpora_and_an_item_in_every_document(spark):
    draw = random.Random(22)
    words = [f"w{k}" for k in range(500)]
    items = [(k, passage(draw, words, 36)) for k in range(5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for n in (1, 6, 9, 200):
        docs = [(d, " ".join([*(draw.choice(words) for _ in range(draw.randint(0, 40))), items[2][1], *(draw.choice(words) for _ in range(draw.randint(0, 40)))])) for d in range(n)]
        rows = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
        assert {(r["doc_id"], r["item_id"]) for r in rows} == set(brute_force(docs, items)) >= {(d, 2) for d in range(n)}


def test_long_items_keep_their_ends():
    for n in (1, 4, 95, 96, 97, 98, 193, 400):
        item = " ".join(f"w{k}" for k in range(n))
        parts = D.passages([(1, item)])
        assert [w for _, p, _ in parts for w in p] == item.encode().split()
        assert max(len(p) for _, p, _ in parts) <= D.PASSAGE and (n <= D.PASSAGE or min(len(p) for _, p, _ in parts) >= D.PASSAGE // 2)
        assert parts[-1][2] == item.encode().split()[-8:]


def test_several_readings_and_searches_find_the_same(spark, monkeypatch):
    draw = random.Random(23)
    words = [f"w{k}" for k in range(3000)]
    items = [(k // 2, passage(draw, words, 40)) for k in range(24)]
    docs = [(d, " ".join([*draw.sample(words, 30), items[d % 24][1], *draw.sample(words, 20)])) for d in range(36)]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(r["doc_id"], r["item_id"]) for r in D.contaminated(frame, bench).collect()}
    assert want >= {(d, items[d % 24][0]) for d in range(36)}
    for name, value in (("GROUP", 9), ("VOCABULARY", 500), ("PASSAGES", 11)):
        with monkeypatch.context() as m:
            m.setattr(D, name, value)
            rows = D.contaminated(frame, bench).collect()
        assert len(rows) == len(want) and {(r["doc_id"], r["item_id"]) for r in rows} == want
