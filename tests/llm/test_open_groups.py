"""Near duplicates: families of documents that are alike but not similar enough, and the files that steps leave behind."""

import random
import time
from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tablejobs.llm import jaccard, links, packed

from . import brute

SCHEMA = "doc_id long, text string"


def families(seed: int, n: int, changed: int) -> list[tuple[int, str]]:
    """Five families of n versions of a text of 120 words, each with words of its own at `changed` places."""
    r, docs = random.Random(seed), []
    for family in range(5):
        words = [f"f{family}w{i}" for i in range(120)]
        for _ in range(n):
            own = list(words)
            for place in r.sample(range(120), changed):
                own[place] = f"x{r.randrange(10**9)}"
            docs.append((len(docs), " ".join(own)))
    return docs


@pytest.fixture
def written(monkeypatch):
    """What the steps write, by label."""
    found = {}

    def kept(df, label, keep=links.kept):
        found[label] = keep(df, label)
        return found[label]

    monkeypatch.setattr(jaccard, "kept", kept)
    return found


def test_alike_but_not_similar_sets_are_not_compared_in_blocks(spark, written):
    """Every two versions share about half their shingles: hundreds of signature groups, not one link."""
    docs = families(1, 40, 6)
    got = {r.doc_id: r.component_id for r in jaccard.similar_documents(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == {d: c for d, (_, c) in brute.similar(docs).items()}
    assert written["groups"].select("key").distinct().count() > 150
    assert written["homes"].count() < 20


def test_stage_of_the_pipeline_keeps_alike_documents(spark, written):
    docs = families(2, 30, 6)
    docs += [(1000 + d, t) for d, t in docs[:3]]
    got = corpus_pipeline.first_of_similar(spark, spark.createDataFrame(docs, SCHEMA), "")
    assert sorted(tuple(r) for r in got.collect()) == docs[:150]
    assert written["homes"].count() < 20


@pytest.mark.parametrize("leaders", [0, 1, 3])
def test_leaders_do_not_change_the_result(spark, leaders, monkeypatch):
    monkeypatch.setattr(jaccard, "LEADERS", leaders)
    monkeypatch.setattr(jaccard, "PAIRS", 50)
    docs = [(d + 1000 * changed, t) for changed in (1, 2, 3) for d, t in families(changed, 12, changed)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == brute.similar(docs)


def test_a_set_meets_few_leaders(spark):
    rows = [(sig, 1, (9, leader)) for leader in range(10, 20) for sig in range(leader * 100, leader * 101)] + [(1, 1, (9, 1)), (1, 2, (9, 1))]
    led = spark.createDataFrame(rows, "sig long, key long, top struct<weight: long, key: long>")
    assert sorted(tuple(r) for r in jaccard._with_leaders(led).collect()) == [(1, 2), (1, 18), (1, 19)]


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_candidates_hold_every_similar_pair_of_other_labels(spark, percent):
    r = np.random.default_rng(percent)
    sets = []
    for _ in range(12):
        source = r.integers(0, 1 << 63, int(r.integers(1, 60))).astype(np.uint64)
        for _ in range(8):
            own = r.random(len(source)) < r.choice([0.7, 0.9, 0.97])
            some = np.concatenate([source[own], r.integers(0, 1 << 63, int(r.integers(0, 6))).astype(np.uint64), source[:1]])
            sets.append(np.unique(some))
    label = [i if i % 3 else i // 24 for i in range(len(sets))]
    frame = spark.createDataFrame([(i, label[i], packed.pack_sorted(s)) for i, s in enumerate(sets)], "key long, label long, hashes binary")
    found = {tuple(x) for x in jaccard._candidates(frame, jaccard.Bands(percent), 3).collect()}
    plain = [set(s.tolist()) for s in sets]
    similar = {
        (i, j) for j in range(len(sets)) for i in range(j) if label[i] != label[j] and 100 * len(plain[i] & plain[j]) >= percent * len(plain[i] | plain[j])
    }
    assert similar and similar <= found
    assert all(label[a] != label[b] and a < b for a, b in found)


def test_a_large_component_beside_one_other_set(spark):
    """5000 equal versions of one label and a set of another: the pairs within the label are not gone through."""
    hashes = np.arange(1, 41).astype(np.uint64) << np.uint64(57)
    hashes = np.unique(hashes)
    rows = [(i, 0, packed.pack_sorted(hashes)) for i in range(5000)] + [(5000, 1, packed.pack_sorted(hashes))]
    frame = spark.createDataFrame(rows, "key long, label long, hashes binary")
    found = jaccard._candidates(frame, jaccard.Bands(80), 2)
    assert (found.count(), found.agg(F.min("b")).first()[0]) == (5000, 5000)


def test_shuffle_files_go_with_the_write(spark):
    folder = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].toString())
    files = lambda: set(folder.glob("*/shuffle_*.data"))
    before = files()
    setting = spark.conf.get(links.CLEANUP, None)
    found = links.kept(spark.range(1000).repartition(4, "id"), "cleaned")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(links.CLEANUP, None) == setting
    assert found.count() == 1000
