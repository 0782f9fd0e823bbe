"""Collocations, packing and Merkle manifests on small tables, against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests.llm import brute

from tablejobs.llm import collocations, flat, jaccard, merkle, packing, substrings, tokenfiles, tokens, wordcache
from tablejobs.llm.labelled import fold
from tablejobs.llm.queries import QUERIES, table
from tablejobs.session import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


# --- collocations --------------------------------------------------------------------------------


def phrases(rows, support, ranks):
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                count[lang].update(" ".join(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in count.items():
        known = {p: n for p, n in own.items() if n >= support and " " in p}
        found = []
        for p, a in known.items():
            w = p.split(" ")
            if any(100 * n >= 50 * a for q, n in known.items() if q.count(" ") > p.count(" ") and f" {p} " in f" {q} "):
                continue
            cuts = [(own[" ".join(w[:k])], own[" ".join(w[k:])]) for k in range(1, len(w))]
            left, right = min(cuts, key=lambda c: 1000000 * a * a // (c[0] * c[1]))
            found.append((-(1000000 * a * a // (left * right)), -a, p.encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(found)[:ranks]):
            out.append((lang, i + 1, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


ODD = [
    (None, None), ("", "en"), (" \t\n", "en"), ("Über alles über ALLES. über, alles", None), ("a b a b a b a b", "und"), ("a b a b a b a b", "und"),
    ("x\x0by z\x0cx y z x y z", "en"), ("w" * 9000 + " " + "p q r " * 4000, "de"), ("数学 数学 数学 数学", "zh"),
]


@pytest.mark.parametrize("support, ranks, parts", [(2, 5, 1), (2, 2000, 6), (10, 2000, 9)])
def test_collocations(spark, support, ranks, parts):
    rows = ODD * 2 + [(brute_prose(i), ["en", "fr"][i % 2]) for i in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    docs = docs.withColumns({c: F.lit("own") for c in ("n", "phrase", "width", "rank", "hash", "key")})
    got = collocations.collocations(docs, support=support, ranks=ranks).collect()
    assert sorted(map(tuple, got)) == phrases(rows, support, ranks)


def brute_prose(seed):
    r = np.random.default_rng(seed)
    return " ".join(f"w{min(int(x), 40)}" + (". " if x > 20 else "") for x in r.zipf(1.5, 60))


def test_no_collocations(spark):
    nothing = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(nothing).count() == 0
    assert collocations.collocations(spark.createDataFrame(ODD[:3], "text string, lang string"), support=1).count() == 0


def test_local_supports_add_up(spark):
    docs = spark.createDataFrame([("x" * 10 * i, "en") for i in range(50)], "__text string, __lang string").repartition(7)
    least = collocations.local_supports(docs, 10, 4)
    assert len(least) == 4 and all(1 <= n <= 10 for n in least) and sum(n - 1 for n in least) < 10


def test_full_filter_and_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANGE_BYTES", 500)
    monkeypatch.setattr(collocations, "_AT_ONCE", 4)
    monkeypatch.setattr(collocations, "_BUFFER", 100)
    monkeypatch.setattr(collocations, "_LEAST_BITS", 7)
    monkeypatch.setattr(collocations, "_MOST_BITS", 7)
    rows = [(brute_prose(i), "en") for i in range(30)]
    got = collocations.collocations(spark.createDataFrame(rows, "text string, lang string"), support=3).collect()
    assert sorted(map(tuple, got)) == phrases(rows, 3, 2000)


# --- packing -------------------------------------------------------------------------------------


def check_sequences(rows, capacity):
    """Gapless sequences of at most `capacity`; returns their number."""
    own = defaultdict(list)
    for r in rows:
        own[r.sequence_id].append((r.offset, r.length or 0))
    for pieces in own.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(own)


@pytest.mark.parametrize("shard_pieces, waste", [(50, 0.06), (4096, 0.02)])
def test_packing_of_lengths(spark, shard_pieces, waste):
    r = np.random.default_rng(5)
    lengths = [int(x) for x in np.concatenate([r.integers(1, 100, 300), r.integers(40, 101, 200), [100] * 20])]
    docs = spark.createDataFrame([(i % 7, n, "own") for i, n in enumerate(lengths)], "doc_id long, length long, offset string").repartition(5)
    docs = docs.withColumns({c: F.lit("x") for c in ("shard", "at", "bin", "closed", "island")})
    got = packing.pack(docs, 100, shard_pieces=shard_pieces)
    rows = got.collect()
    assert sorted((x.doc_id, x.length) for x in rows) == sorted((i % 7, n) for i, n in enumerate(lengths))
    assert got.columns == ["doc_id", "length", "shard", "at", "bin", "closed", "island", "sequence_id", "offset"]
    least = packing.lower_bound(np.array(lengths), 100)
    assert least >= max(-(-sum(lengths) // 100), sum(n > 50 for n in lengths))
    assert least <= check_sequences(rows, 100) <= least * (1 + waste) + 1


def test_lower_bound():
    for lengths, least in [([], 0), ([0], 1), ([60, 60, 30], 2), ([60, 60, 50, 50], 3), ([51] * 3 + [50], 4), ([90, 90, 20, 20], 3), ([34, 33, 33], 1), ([60, 60, 45], 3)]:
        assert packing.lower_bound(np.array(lengths, np.int64), 100) == least


def test_packing_edges(spark):
    for lengths in ([], [0, 0, None], [100], [0] * 200, [100] * 9, [60] * 120):
        docs = spark.createDataFrame([(None, n) for n in lengths], "doc_id long, length long")
        rows = packing.pack(docs, 100, shard_pieces=30).collect()
        assert len(rows) == len(lengths)
        assert check_sequences(rows, 100) >= -(-sum(n or 0 for n in lengths) // 100)
    with pytest.raises(ValueError, match="holds 100"):
        packing.pack(spark.createDataFrame([(1, 101)], "doc_id long, length long"), 100)


def test_islands_improve(monkeypatch):
    """Triplets that fill bins exactly: evolution ends with no more bins than best fit, and keeps every piece."""
    r = np.random.default_rng(2)
    first = r.integers(200, 500, 60)
    second = (1000 - first) // 2 + r.integers(-50, 50, 60)
    lengths = np.concatenate([first, second, 1000 - first - second])
    plain = packing.Shard(lengths, 1000, 1)
    people = packing.Shard(lengths, 1000, 1).evolve([], 12, 40)
    assert people[0].max() + 1 <= plain.start(0.0).max() + 1
    for bins in people:
        assert plain.fills(bins).max() <= 1000 and len(bins) == len(lengths) and bins.min() == 0
    mother, father = plain.start(0.2), plain.start(0.3)
    child = plain.crossover(mother, father)
    groups = lambda b: {tuple(np.flatnonzero(b == i)) for i in range(b.max() + 1)}
    assert groups(child) & groups(father)


def test_pieces(spark):
    library = tokens.tokenizer_of(PATH)
    texts = [None, "", "one Two  three", "ÉCLAIR don't 'rest, a.b,c 3.5!! x́\x1c y z 数学", "word " * 500, "ΣΑΣ. ©™", "<|endoftext|> 'S", "a | b || c| |d |"]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted((r.doc_id, r.piece, r.start, r.length, tuple(np.frombuffer(r.ids, "<u4"))) for r in packing.cut(docs, PATH, 64, 7).collect())
    expected = []
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 7]
        expected += [(i // 2, k // 64, k, len(ids[k : k + 64]), tuple(ids[k : k + 64])) for k in range(0, len(ids), 64)]
    assert got == sorted(expected)


@pytest.mark.parametrize("name, split", [("word_bpe_49k.json", "between"), ("byte_bpe_50k.json", "before")])
def test_few_words_remembered(monkeypatch, name, split):
    monkeypatch.setattr(wordcache, "REMEMBERED", 3)
    path = public_tokenizers.path(name)
    encoder, library = wordcache.Encoder(path, split), tokens.tokenizer_of(path)
    texts = ["some words here and there", "", "Other words, here; and more.\n\nSo  a.b,c don't!", " some words ", "ÉCLAIR 3.5!! x́\x1c y. z 数学.", "a"]
    for own in (texts[:2], texts[2:], texts):
        data = "".join(own).encode()
        offsets = np.cumsum([0, *[len(t.encode()) for t in own]])
        ids, bounds = encoder.ids(np.frombuffer(data, np.uint8), offsets)
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in own]


def test_encode_and_count(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = [(1, "some words, some more."), (1, "some"), (None, None), (3, "")]
    found, counts = wordcache.encode_and_count(spark.createDataFrame(docs, "doc_id long, text string"), path, split="before")
    ids = [tokens.tokenizer_of(path).encode(t or "", add_special_tokens=False).ids for _, t in docs]
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, tokens.unpack_ids(r.packed).tolist()) for r in found.collect())
    assert got == sorted((d is None, d, len(own), own) for (d, _), own in zip(docs, ids))
    assert {r.token: r.n for r in counts.collect()} == Counter(t for own in ids for t in own)


def test_packing_query(spark, sf):
    rows = QUERIES["op12_best_fit_packing"](spark, sf).collect()
    library, expected = tokens.tokenizer_of(PATH), set()
    for d, t in table(spark, sf, "documents").select("doc_id", "text").collect():
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            expected.add((d, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())))
    assert len(rows) == len(expected) and {tuple(r)[:5] for r in rows} == expected
    least = -(-sum(r.length for r in rows) // 2048)
    assert check_sequences(rows, 2048) <= least + 1


# --- Merkle manifests ----------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """The root of a list of hashes, and the siblings (left, right) of each leaf on its way up."""
    paths, ranks = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for leaf, at in enumerate(ranks):
            run = runs[at // 8]
            paths[leaf].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        ranks = [at // 8 for at in ranks]
        nodes = [sha(*run) for run in runs]
    return nodes[0], paths


def plain_manifest(rows):
    def leaf(row, text):
        own = [row[0], row[3], row[2], row[4], text]
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in own])

    groups = defaultdict(list)
    for row in rows:
        low = None if row[1] is None else row[1].translate(brute.LOWER)
        hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), leaf(row, low if hit else row[1]), row[0]))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: climb([x[2] for x in sorted(groups[lang])]) for lang in langs}
    root, tops = climb([trees[lang][0] for lang in langs]) if langs else (None, [])
    out = []
    for lang, top in zip(langs, tops):
        for (_, _, own, held, id), path in zip(sorted(groups[lang]), trees[lang][1]):
            way, h = path + top, held
            for left, right in way:
                h = sha(left, h, right)
            out.append((id, own, trees[lang][0], root, sha(*[a + b for a, b in way]), h, h == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n, langs", [(0, ["en"]), (1, ["en"]), (8, ["en"]), (9, [None]), (200, ["en", "fr", None, "de"]), (90, [f"l{i}" for i in range(20)] + ["ß", ""])])
def test_manifest(spark, n, langs):
    rows = [(i if i % 10 else 5, [None, "", "Ab", "Zü"][i % 4], langs[i % len(langs)], None if i % 3 else "s", i) for i in range(n)]
    rows += [(None, "Null Id", langs[0], None, None)] * (n > 100)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    docs = docs.withColumns({c: F.lit("own") for c in ("pos", "count", "group", "hash", "node", "held", "path")})
    found = merkle.manifest(docs, tampered=fold("doc_id", 3) == 0)
    got = found.withColumn("proof", F.sha2(merkle.proof(F.col("path")), 256)).withColumn("ok", F.col("folded_root") == F.col("root"))
    rows_of = got.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "ok").collect()
    assert sorted(map(tuple, rows_of), key=repr) == plain_manifest(rows)


# --- equality of words ---------------------------------------------------------------------------


def crafted():
    """Two words of 1,024 letters that any polynomial of an odd base gives one value modulo 2 ** 64."""
    one = "a"
    for _ in range(10):
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_hashes_tell_words_apart():
    words = [*crafted(), "", "a", "a\0", "b" * 8, "b" * 9, "b" * 16, "b" * 17, "bbbbbbbbcccccccc", "ccccccccbbbbbbbb"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    own = flat.Words.between(data, np.array([0, len(data)]), np.concatenate([[0], ends[:-1]]), ends).hashes()
    assert len(set(own.tolist())) == len(words)
    # A word has one hash wherever it lies.
    text = " ".join(words[3:] * 3).encode()
    found = flat.Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), flat.NOT_SPACE).hashes()
    assert found.reshape(3, -1).tolist() == [own[3:].tolist()] * 3


def test_crafted_words(spark):
    one, two = crafted()
    shared = " ".join(f"w{i}" for i in range(49))
    docs = [(1, f"{one} {shared}"), (2, f"{two} {shared}"), (3, f"{one} b c d e"), (4, f"{two} b c d e"), (5, one), (6, two)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    removed = {r.doc_id: r.n_removed for r in substrings.remove_repeats(frame).collect()}
    assert set(removed.values()) == {0}
    linked = {r.doc_id: r.component_id for r in jaccard.similar_documents(frame).collect()}
    assert (linked[3], linked[4], linked[5], linked[6]) == (3, 4, 5, 6)
    for name, split in (("word_bpe_49k.json", "between"), ("byte_bpe_50k.json", "before")):
        path = public_tokenizers.path(name)
        library = tokens.tokenizer_of(path)
        got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in tokens.encode(frame, path, split=split).collect()}
        assert got == {d: library.encode(t, add_special_tokens=False).ids for d, t in docs}


# --- checkpoints of token files ------------------------------------------------------------------


def test_tokens_behind_an_interior_checkpoint(spark, monkeypatch):
    """A long document has a checkpoint for every 65,536 tokens, and what lies before one is not decoded."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = " ".join(f"w{i * 7919 % 10007}" for i in range(60_000))
    frame = spark.createDataFrame([(1, text), (2, "end")], "doc_id long, text string")
    found, counts = tokens.encode_and_count(frame, path, split="before")
    folder = scratch_dir(spark, "files")
    tokenfiles.write_tokens(found, counts, 2, folder)
    ids = [*tokens.tokenizer_of(path).encode(text, add_special_tokens=False).ids, 2]
    block = max(spark.read.parquet(f"{folder}/blocks").collect(), key=lambda r: r.n_tokens)
    grain = block.lanes * block.every
    assert grain == 65_536 and len(block.states) // (8 * block.lanes) == -(-block.n_tokens // grain) > 2
    begins = []
    decode = tokenfiles.Coder.decode
    monkeypatch.setattr(tokenfiles.Coder, "decode", lambda *a: begins.append(a[7]) or decode(*a))
    coder = tokenfiles.Coder(np.frombuffer(spark.read.parquet(f"{folder}/table").first()[0], "<i4"))
    whole = coder.decode(block.n_tokens, block.lanes, block.every, block.words, block.states, block.places, 1, None)
    assert begins == [1] and whole.tolist() == ids[grain : block.n_tokens]
    start = 2 * grain + 5
    part = tokenfiles.read_from_checkpoints(spark, folder, block.file, start, start + 100).first()
    assert part.start == start and np.frombuffer(part.ids, "<u4").tolist() == ids[start : start + 100]
