"""Locally consistent parsing against a plain parser, fingerprints on all documents, and strips of common features."""

from itertools import groupby

import numpy as np
import pytest
from tests.llm.test_operators import prose

from tablejobs.llm import fingerprints, flat, jaccard
from tablejobs.llm.queries import QUERIES

TEXTS = ["", "a", "ab", "aaaa", "abcabc", "the cat sat on the mat", "日本語のテキスト", "x" * 5000, "ab" * 3000]


def labels(symbols, rounds):
    for n in range(rounds):
        out = []
        for i, s in enumerate(symbols):
            low = ((s ^ symbols[i - 1]) & -(s ^ symbols[i - 1])).bit_length() - 1 if i else 0
            out.append(2 * low + (s >> low & 1))
        symbols = out
    return symbols


def plain_levels(data: bytes):
    """Phrases of each level as lists of (symbol, length of its run); names count up, equal phrases share one."""
    symbols, rounds, levels = list(data), 3, []
    while symbols:
        runs = [(s, len(list(g))) for s, g in groupby(symbols)]
        label = labels([s for s, _ in runs], rounds)
        marks = [i for i in range(len(runs)) if i == 0 or (i < len(runs) - 1 and label[i - 1] < label[i] > label[i + 1])]
        phrases = [tuple(runs[a:b]) for a, b in zip(marks, [*marks[1:], len(runs)])]
        levels.append(phrases)
        if len(phrases) == 1:
            return levels
        symbols, rounds = named(phrases), 4
    return levels


def named(phrases):
    """The operator's names of phrases, one at a time."""
    out = []
    for phrase in phrases:
        s, n = (np.array(x, np.uint64) for x in zip(*phrase))
        value = flat.mix(s + n * np.uint64(0xC2B2AE3D27D4EB4F))
        total = flat.mix(value ^ fingerprints._PLACES[: len(phrase)]).sum(dtype=np.uint64)
        out.append(int(flat.mix(np.array([total]))[0]))
    return out


def test_levels_against_a_plain_parser():
    texts = [*TEXTS, *[prose(seed, 40 * seed) for seed in range(12)]]
    got = fingerprints.sketches([t.encode() for t in texts])
    for text, sketch in zip(texts, got):
        want = [sorted({n >> 24 for n in named(p)})[: fingerprints.SKETCH] for p in plain_levels(text.encode())]
        assert [level.tolist() for level in sketch] == want
        assert not sketch or len(sketch[-1]) == 1
        assert fingerprints.read(fingerprints.spelled(sketch)) == want


def test_neighbours_in_a_batch_change_nothing():
    """The text behind must not decide whether a text's last symbol begins a phrase."""
    texts = [bytes([a, b, c]) for a in range(96, 112) for b in range(96, 112) for c in range(96, 112)]
    alone = [fingerprints.spelled(fingerprints.sketches([t])[0]) for t in texts[::7]]
    together = [fingerprints.spelled(s) for s in fingerprints.sketches(texts)][::7]
    assert alone == together


@pytest.mark.parametrize("size", range(100, 160, 6))
def test_likeness_is_even_around_any_length(size):
    text = (" ".join(f"word{i * i}" for i in range(40)))[:size]
    edited = text[: size - size // 3] + "completely other words come here to stand"[: size // 3]
    spell = [fingerprints.spelled(s) for s in fingerprints.sketches([text.encode(), edited.encode()])]
    assert 0.25 < fingerprints.likeness(*spell) < 0.9 and fingerprints.likeness(*spell) == fingerprints.likeness(*spell[::-1])


def test_registered_query(spark, sf):
    rows = QUERIES["op3_fingerprints"](spark, sf).collect()
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    text = {r.doc_id: r.text or "" for r in documents}
    assert len(rows) == len(documents)
    for r in rows:
        assert r.n_chars == len(text[r.doc_id])
        assert r.fingerprint == fingerprints.spelled(fingerprints.sketches([text[r.doc_id].encode()])[0])
        assert r.near_edited > r.near_next or r.n_chars < 3


@pytest.mark.parametrize("strip", [1, 7, 1 << 15])
def test_common_features_in_strips(strip, monkeypatch):
    monkeypatch.setattr(jaccard, "STRIP", strip)
    random = np.random.default_rng(5)
    sets = [np.unique(random.integers(0, 60, n).astype(np.uint64) << np.uint64(57)) for n in (1, 3, 20, 50, 90)]
    got = jaccard._in_common(sets[:3], sets)
    assert got.tolist() == [[len({*a.tolist()} & {*b.tolist()}) for b in sets] for a in sets[:3]]
