from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from actlens.llm import bpe, token_counts, token_output

PATH = bpe.default_vocabulary()


@pytest.fixture(scope="module")
def v():
    return bpe.vocabulary_of(PATH)


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def same(v, reference, text):
    ids = v.encode(text)
    want = reference.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want, text[:80]
    assert v.decode(ids).decode("utf-8", "replace") == reference.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", " ", "a", "\n", "  a  b ", "x <|endoftext|> y<|endoftext|>", "isn't we'll", "é\u00a0ñ\x1c\x85z", "日本語 🙂", "a" * 3000, "ab" * 2000 + "c", " " * 500, "thethertherein" * 300, "\n\n a\r\n b"])
def test_edge_texts(v, reference, text):
    same(v, reference, text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(bpe.vocabulary_of(PATH), Tokenizer.from_file(PATH) if not hasattr(test_any_text, "t") else test_any_text.t, text)


test_any_text.t = Tokenizer.from_file(PATH)


def test_every_code_point(v, reference):
    import sys

    cut = reference.pre_tokenizer.pre_tokenize_str
    codes = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(codes), 5000):
        part = codes[k : k + 5000]
        # planes without letters in long runs, all others one by one beside letters, numbers and contractions
        texts = ["".join(part)] if "\U00040000" <= part[0] < "\U000dffff" or part[0] > "\U000e2000" else ["\n".join(f"a{c}'ll1{c}! {c}" for c in part)]
        for text in texts:
            assert v.cuts(text) == [text[a:b] for _, (a, b) in cut(text)], hex(k)
    odd = sorted(v.odd)
    assert odd
    for k in range(0, len(odd), 500):  # whole encodings, as chunks and as texts
        same(v, reference, " ".join(f"a{c}'ll {c}{c}1{c}" for c in odd[k : k + 60]))
        same(v, reference, "\n".join(f"a{c}'ll  {c}" for c in odd[k : k + 60]))


def test_random_words(v, reference):
    draw = random.Random(3)
    for _ in range(3000):
        same(v, reference, "".join(draw.choice("etaoinshrdlu ÉÑé,.") for _ in range(draw.randint(1, 30))))


def test_full_memo_changes_nothing(v, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    for text in ["the quick brown fox jumps over", "one two three four five six seven"]:
        same(v, reference, text)


def test_queries_rows(spark):
    rows = [(1, "the cat sat", 5), (1, "the cat sat", 5), (2, None, 6), (3, "", 7), (None, "x", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = bpe.round_trip(docs).collect()
    assert len(found) == 5
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r["n_tokens"], r["ids_sha256"]) for r in found if r["doc_id"] in (2, 3)} == {(0, empty)}
    one = next(r for r in found if r["doc_id"] == 1)
    assert one["decoded_sha256"] == hashlib.sha256(b"the cat sat").hexdigest()
    encoded = bpe.encode_documents(docs)
    back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(encoded).collect()}
    assert back == {1: "the cat sat", 2: "", 3: "", None: "x"}
    assert bpe.round_trip(docs.limit(0)).count() == 0


def brute(text, sections, rule, v):
    """Tokens of each section, token by token over characters."""
    out, at = [0.0] * len(sections), 0
    bytes_of = [(len(text[:a].encode()), len(text[:b].encode())) for a, b in sections]
    for i in v.encode(text):
        end = at + int(v.sizes[i])
        parts = [max(0, min(end, b) - max(at, a)) for a, b in bytes_of]
        if rule == "first":
            for k, (a, b) in enumerate(bytes_of):
                out[k] += a <= at < b
        elif rule == "share":
            out = [o + p / (end - at) for o, p in zip(out, parts, strict=True)]
        elif max(parts, default=0) > 0:
            out[parts.index(max(parts))] += 1
        at = end
    return out


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_section_counts_against_brute_force(spark, v, rule):
    draw = random.Random(5)
    rows = []
    for k in range(40):
        text = "".join(draw.choice(["the ", "cat", "é", "\n", " sat", "ñandú", "🙂", "123"]) for _ in range(draw.randint(0, 30)))
        cuts = sorted(draw.sample(range(len(text) + 1), min(len(text) + 1, draw.randint(0, 6))))
        rows.append((k, text, [(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, s array<struct<start:long,end:long>>")
    found = {(r["doc_id"], r["section"]): r["n_tokens"] for r in token_counts.section_counts(docs, rule, sections_col="s").collect()}
    for k, text, sections in rows:
        assert [round(found[k, n], 9) for n in range(len(sections))] == [round(x, 9) for x in brute(text, sections, rule, v)]


def test_sections_of_any_bounds(spark, v):
    text = "one two three"
    given = [[(None, 3), (3, None)], [(8, 13), (0, 8)], [(0, 9), (4, 13)], [(-5, 4), (4, 99)], [None, (0, None)], [(5, 2), (3, 3)], None, []]
    docs = spark.createDataFrame([(k, text, s) for k, s in enumerate(given)] + [(9, None, [(None, None)])], "doc_id long, text string, s array<struct<start:long,end:long>>")
    found = {(r["doc_id"], r["section"]): r["n_tokens"] for r in token_counts.section_counts(docs, sections_col="s").collect()}
    n = len(v.encode(text))
    assert n == 3
    want = {(0, 0): 1, (0, 1): 2, (1, 0): 1, (1, 1): 2, (2, 0): 2, (2, 1): 1, (3, 0): 1, (3, 1): 2, (4, 0): 0, (4, 1): 3, (5, 0): 0, (5, 1): 0, (9, 0): 0}
    assert found == want


def test_field_counts(spark, v):
    docs = spark.createDataFrame([(1, "a title", None, "the body of it"), (2, None, None, None)], "doc_id long, title string, text string, body string")
    found = {(r["doc_id"], r["field"]): r["n_tokens"] for r in token_counts.field_counts(docs, ["title", "text", "body"]).collect()}
    assert found == {(1, "title"): len(v.encode("a title")), (1, "text"): 0, (1, "body"): len(v.encode("the body of it")), (2, "title"): 0, (2, "text"): 0, (2, "body"): 0}


def test_lines_take_every_token_once(spark, v):
    docs = spark.createDataFrame([(1, "one two\nthree\n\nfour"), (2, None), (3, ""), (4, "é\n" * 20)], "doc_id long, text string")
    rows = token_counts.section_counts(docs).collect()
    assert {r["doc_id"] for r in rows} == {1, 4}
    for k, text in ((1, "one two\nthree\n\nfour"), (4, "é\n" * 20)):
        mine = [r for r in rows if r["doc_id"] == k]
        assert sum(r["n_tokens"] for r in mine) == len(v.encode(text)) == mine[0]["doc_tokens"]
        assert "".join(text[r["start"] : r["end"]] for r in sorted(mine, key=lambda r: r["section"])) == text
    with pytest.raises(ValueError, match="unknown rule"):
        token_counts.section_counts(docs, "none")


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_feistel_is_a_permutation(n):
    for key in (1, 2):
        assert sorted(token_output.feistel(np.arange(n), n, key).tolist()) == list(range(n))
    if n > 60:
        assert token_output.feistel(np.arange(n), n, 1).tolist() != token_output.feistel(np.arange(n), n, 2).tolist()


def test_shards_hold_every_token_once(spark, tmp_path, v):
    rows = [(k, " ".join(f"word{j}" for j in range(k % 37)) or None, "x") for k in range(120)] + [(7, "one more", "x"), (7, "one more", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot string")
    folder = f"file://{tmp_path}/shards"
    manifest = token_output.write_shards(docs.repartition(3, "doc_id"), folder, length=16, per_shard=10).collect()
    n = len(manifest)
    assert sorted(m["slot"] for m in manifest) == sorted(m["sequence"] for m in manifest) == list(range(n))
    everything = token_output.read_slots(folder, 0, n + 5, length=16, per_shard=10)
    assert len(everything) == n
    for m in manifest:
        assert hashlib.sha256(everything[m["slot"]].tobytes()).hexdigest() == m["sha256"]
        assert (m["shard"], m["offset"]) == (m["slot"] // 10, m["slot"] % 10 * 32)
        assert m["slot"] == token_output.feistel(np.array([m["sequence"]]), n, 1)[0]
    resumed = token_output.read_slots(folder, 13, 4, length=16, per_shard=10)
    assert (resumed == everything[13:17]).all()
    # by number, the sequences joined are the documents' tokens by id, each followed by the end token
    by_number = sorted(manifest, key=lambda m: m["sequence"])
    stream = np.concatenate([everything[m["slot"]][: m["n_tokens"]] for m in by_number])
    want = [[*v.encode(t).tolist(), token_output.END] for _, t, _ in sorted(rows, key=lambda r: r[0]) if t]
    assert sorted(tuple(d.tolist()) for d in np.split(stream, np.flatnonzero(stream == token_output.END) + 1) if len(d)) == sorted(map(tuple, want))
    assert all(m["n_tokens"] == 16 for m in by_number[:-1]) and (everything[by_number[-1]["slot"]][by_number[-1]["n_tokens"] :] == token_output.END).all()
    # the documents of each sequence, token by token
    owners = np.concatenate([np.full(len(w), k) for k, w in enumerate(want)])
    ids = [i for i, t, _ in sorted(rows, key=lambda r: r[0]) if t]
    for m in by_number:
        mine = owners[m["sequence"] * 16 : m["sequence"] * 16 + m["n_tokens"]]
        assert (m["first_doc"], m["n_docs"]) == (ids[mine[0]], len(set(mine.tolist()))), m
    assert token_output.write_shards(docs.limit(0), f"file://{tmp_path}/none").count() == 0


def test_order_does_not_depend_on_tasks(spark, tmp_path):
    docs = spark.createDataFrame([(f"d{k:03}", " ".join(f"word{j * k}" for j in range(k % 23)) or None) for k in range(60)], "doc_id string, text string")
    seen = []
    for k, parts in enumerate((1, 3, 7)):
        token_output.write_shards(docs.repartition(parts), f"file://{tmp_path}/a{k}", length=16, per_shard=10)
        seen.append(token_output.read_slots(f"file://{tmp_path}/a{k}", 0, 1000, length=16, per_shard=10).tolist())
    # a second run into a folder takes its old shards away, and files are read in order however they are split
    docs.orderBy("doc_id").coalesce(1).write.option("parquet.block.size", 1024).parquet(f"{tmp_path}/docs")
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("400b", split):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        token_output.write_shards(spark.read.parquet(f"{tmp_path}/docs"), f"file://{tmp_path}/a0", length=16, per_shard=10)
        seen.append(token_output.read_slots(f"file://{tmp_path}/a0", 0, 1000, length=16, per_shard=10).tolist())
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert all(x == seen[0] for x in seen)
    with pytest.raises(Exception, match="Unrecognized filesystem"):
        token_output.write_shards(docs, "nowhere://x/y")
