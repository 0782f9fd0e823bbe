import hashlib
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from __spark_entry__ import queries
from tests.llm import brute

from checks.compare import difference, duck
from tablejobs.llm import tokens
from tablejobs.llm.queries import ORACLES, QUERIES, TOKENIZERS, table

LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def items(spark, sf):
    return [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert QUERIES.items() <= queries().items() and queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_duckdb(spark, sf, name):
    assert difference(QUERIES[name](spark, sf), duck(sf), ORACLES[name]) is None


def test_substring_dedup(spark, sf, docs):
    got = {tuple(r) for r in QUERIES["op5_substring_dedup"](spark, sf).collect()}
    assert got == {(d, n, gone, brute.sha(kept)) for d, n, gone, kept in brute.repeats(docs)}


def test_decontaminate(spark, sf, docs, items):
    got = {tuple(r) for r in QUERIES["op6_decontaminate"](spark, sf).collect()}
    assert got == {(d, n, hit, len(own), brute.sha(",".join(own)), hit > 0) for d, n, hit, own in brute.leaks(docs, items)}


def test_token_files(spark, sf, docs):
    library, start, expected = tokens.tokenizer_of(f"{TOKENIZERS}/byte_bpe_50k.json"), 0, set()
    for d, t in sorted(docs):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        expected.add((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert {tuple(r) for r in QUERIES["op8_token_files"](spark, sf).collect()} == expected


def test_bpe(spark, sf, docs):
    library, expected = tokens.tokenizer_of(f"{TOKENIZERS}/word_bpe_49k.json"), set()
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        whole = library.decode(ids, skip_special_tokens=False)
        expected.add((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), brute.sha(whole)))
    assert {tuple(r) for r in QUERIES["op9_bpe"](spark, sf).collect()} == expected


def test_held_out_accuracy(spark):
    langs = {r[0]: r[1] for r in table(spark, LARGER, "documents").select("doc_id", "lang").collect()}
    rows = QUERIES["op1_language_mixture"](spark, LARGER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows) and len(rows) == len(langs)
    assert np.mean([langs[r.doc_id] == r.lang_pred for r in rows if r.held_out]) > 0.97
    labels = {r.doc_id: r for r in table(spark, LARGER, "labels").collect()}
    good = [(r.predicted, labels[r.doc_id].quality) for r in QUERIES["op4_quality"](spark, LARGER).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in good]) > 0.95
    toxic = [r for r in QUERIES["op2_toxicity"](spark, LARGER).collect() if r.doc_id in labels]
    seen = Counter((labels[r.doc_id].toxic, r.predicted) for r in toxic)
    assert seen[0, 1] <= 3 and seen[1, 1] > seen[1, 0]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in toxic)


def test_pipeline(spark, sf, docs, items):
    """All stages but the classifier by brute force, on what the classifier keeps."""
    whole = table(spark, sf, "documents")
    good = corpus_pipeline.good_documents(spark, whole, sf)
    assert good.columns == whole.columns
    kept = {r.doc_id: r.text for r in good.collect()}
    quality = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    assert np.mean([(d in kept) == bool(q) for d, q in quality.items()]) > 0.95
    found = brute.similar(list(kept.items()))
    left = [(d, t) for d, t in kept.items() if found[d][1] == d]
    texts = {d: w if gone else dict(left)[d] for d, _, gone, w in brute.repeats(left)}
    clean = {d for d, _, hit, _ in brute.leaks(list(texts.items()), items) if not hit}
    library = tokens.tokenizer_of(corpus_pipeline.TOKENIZER)
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert rows.keys() == texts.keys()
    for d, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        own = np.frombuffer(rows[d].ids, "<u4").tolist()
        assert own == ids if d in clean else len(own) < len(ids)


def test_stages_keep_columns_and_stand_edges(spark, sf):
    schema = "text string, score string, doc_id long, lang string, source string, n_chars long, n_removed int"
    odd = [(None, "a", 1, None, None, None, 1), ("", "b", None, "en", "s", 0, 2), ("x " * 3, "c", 1, "en", "s", 6, None)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, sf)
            assert got.columns == docs.columns, name
            own = {r.score for r in got.collect()}
            assert own <= {"a", "b", "c"} and (name == "quality_classifier" or len(own) == len(rows)), name
        assert corpus_pipeline.token_ids(spark, docs, sf).count() == len(rows)
