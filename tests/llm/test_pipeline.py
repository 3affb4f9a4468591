"""The pipeline's stages, one after another, against plain versions."""

import collections

import pytest
from conftest import SMALL
from test_llm_operators import DOCS, SENTENCE, brute_spans

import corpus_pipeline
from loomframe.llm import pii
from loomframe.llm.shared import table


@pytest.fixture(scope="module")
def results(spark):
    docs, out = table(spark, SMALL, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL))
        out.append(docs)
    return out


def test_stages_take_effect(spark, results):
    documents = {r.doc_id: r for r in table(spark, SMALL, "documents").collect()}
    quality, single, clean, masked, packed = results
    for df in results[:4]:
        assert df.columns == corpus_pipeline.COLUMNS
    good = {r.doc_id: r for r in quality.collect()}
    assert all(good[k] == documents[k] for k in good) and 0 < len(good) < len(documents)

    grams = {}
    for k, r in good.items():
        w = r.text.translate({c: c + 32 for c in range(65, 91)}).split()
        grams[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    root = {k: k for k in good}
    for a in sorted(good):
        for b in sorted(good):
            if b < a and 100 * len(grams[a] & grams[b]) >= 75 * len(grams[a] | grams[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if r == high else r for k, r in root.items()}
    assert {r.doc_id for r in single.collect()} == {k for k in good if root[k] == k}

    kept = {r.doc_id: r for r in masked.collect()}
    assert set(kept) == {r.doc_id for r in clean.collect()} < set(good)
    for k, r in kept.items():
        assert not brute_spans(r.text) and r.n_chars == len(r.text)
        if not brute_spans(good[k].text):
            assert r.text == good[k].text or "<" in r.text
    assert set(r.doc_id for r in packed.collect()) == set(kept)


def test_empty_and_awkward_input(spark):
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (None, SENTENCE, "en", "a", 1), (3, SENTENCE + " now", "en", "a", 1),
            (3, SENTENCE + " now", "en", "a", 1), (4, "mail a.b@c.de to " + SENTENCE[20:] + " or else to nobody", "en", "a", 5)]
    for data in ([], rows):
        docs = spark.createDataFrame(data, DOCS)
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, SMALL))
        got = collections.Counter(r.doc_id for r in docs.collect())
        assert got == ({} if not data else {None: 1, 3: 1, 4: 1})


def test_masks_name_their_kind():
    assert pii.masked("x a@b.c y", [(0, 2, 7)]) == "x <EMAIL> y"
