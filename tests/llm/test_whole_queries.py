"""Registered queries that SQL cannot express, against plain versions over the whole smallest tables."""

from __future__ import annotations

import hashlib
import html
import re

import numpy as np
from test_decontamination import brute_force
from test_near_dedup import brute
from tokenizers import Tokenizer

import corpus_pipeline
from actlens.llm import bpe, language_id, quality_rules, secret_scan, token_output
from actlens.llm import queries as R
from actlens.llm.common import table


def texts_of(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}


def test_html_text_of_all_pages(spark, sf_dir):
    """The pages of the test data have their article in one element, read here by patterns."""
    want = {}
    for r in table(spark, sf_dir, "pages").collect():
        found = re.search(r"<article>(.*)</article>", r["html"] or "", re.S)
        text = re.sub(r"<!--.*?-->|<(script|style).*?</\1>", "", found[1] if found else "", flags=re.S)
        text = re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:b|i|a|em|span|strong)\b[^>]*>", "", text))
        want[r["page_id"]] = " ".join(html.unescape(text).split())
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in R.op5_html_text(spark, sf_dir).collect()}
    assert got == {k: (t, len(t)) for k, t in want.items()}


def test_language_of_all_documents(spark, sf_dir):
    """The full Viterbi search, word by word, with the same word scores."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs.where(~language_id.held_out(docs["doc_id"])))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in R.op6_language_id(spark, sf_dir).collect()}
    for doc, text in texts_of(spark, sf_dir).items():
        words = language_id.words_of(text or "")
        if not words:
            assert got[doc] == ("und", 0.0)
            continue
        own = dict(zip(set(words), model.scores(list(set(words)))[0], strict=True)) if len(words) < 4000 else None
        if own is None:
            continue
        state, back = own[words[0]].astype(float), []
        for w in words[1:]:
            top = int(state.argmax())
            stay = state >= state[top] - language_id.PENALTY
            back.append(np.where(stay, np.arange(len(state)), top))
            state = np.maximum(state, state[top] - language_id.PENALTY) + own[w]
        at, letters = int(state.argmax()), {}
        for k in range(len(words) - 1, -1, -1):
            letters[at] = letters.get(at, 0) + len(words[k])
            at = int(back[k - 1][at]) if k else at
        best = max(letters.values())
        assert abs(got[doc][1] - best / sum(letters.values())) < 1e-6 and letters[model.languages.index(got[doc][0])] == best


def test_shards_of_all_documents(spark, sf_dir):
    """Sequences by number, joined, are the texts in order of the file, each with the end token."""
    manifest = R.op8_token_output(spark, sf_dir).collect()
    rows = table(spark, sf_dir, "documents").select("text", "_metadata.row_index").orderBy("row_index").collect()
    encoding = secret_scan.encoding(secret_scan.default_vocabulary())
    ids = [t for r in rows if r["text"] for t in (*encoding.encode_ordinary(r["text"]), token_output.END)]
    n = -(-len(ids) // token_output.LENGTH)
    ids += [token_output.END] * (n * token_output.LENGTH - len(ids))
    whole = np.array(ids, "<u2").reshape(n, token_output.LENGTH)
    assert len(manifest) == n
    for m in manifest:
        assert m["sha256"] == hashlib.sha256(whole[m["sequence"]].tobytes()).hexdigest()
        assert m["slot"] == token_output.feistel(np.array([m["sequence"]]), n, 1)[0]


def rejected(text):
    """The rules of policy prose-1 in plain Python."""
    m = dict(zip(quality_rules.MEASURES, quality_rules.measure(text or ""), strict=True))
    rules = [quality_rules.RULES[x] for x in quality_rules.POLICIES["prose-1"]]
    return any(eval(rule, {}, m) for rule in rules)


def test_pipeline_equals_plain_stages(spark, sf_dir):
    docs = {k: t for k, t in texts_of(spark, sf_dir).items() if not rejected(t)}
    groups = brute(list(docs.items()), 5, 80)
    docs = {k: t for k, t in docs.items() if groups[k][1] == k}
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").orderBy("item_id").collect()]
    leaks = {doc for doc, _ in brute_force(list(docs.items()), items)}
    encoding = secret_scan.encoding(secret_scan.default_vocabulary())
    docs = {k: secret_scan.redacted(t, secret_scan.scan(t, encoding)) for k, t in docs.items() if k not in leaks}
    reference = Tokenizer.from_file(bpe.default_vocabulary())
    want = {k: reference.encode(t, add_special_tokens=False).ids for k, t in docs.items()}
    got = {r["doc_id"]: (r["n_tokens"], r["token_ids"]) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == {k: (len(ids), ids) for k, ids in want.items()}
