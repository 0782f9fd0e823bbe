import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import brute

from tablejobs.llm import (
    decontaminate,
    fingerprints,
    jaccard,
    languages,
    links,
    packed,
    quality,
    rans,
    substrings,
    tokenfiles,
    tokens,
    toxicity,
    warc,
)
from tablejobs.llm.queries import TOKENIZERS
from tablejobs.session import scratch_dir

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau Éclair ß 数学".split()
SCHEMA = "doc_id long, text string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(60)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, and texts at the edges."""
    passage, base = prose(1, 70), prose(2, 300)
    docs = [(1, base), (2, base), (7, base.replace(" ", "\n\t ")), (3, None), (4, ""), (5, " \n "), (6, "one"), (8, "one"), (9, "One")]
    for i in range(10, 30):
        words = base.split()
        r = random.Random(i)
        for _ in range(i % 9):
            words[r.randrange(len(words))] = f"edit{i}{r.randrange(9)}"
        docs.append((i, " ".join(words)))
    docs += [(i, f"{prose(i, 80)} {passage} {prose(-i, i)}") for i in range(40, 52)]
    docs += [(i, prose(i, i % 13)) for i in range(60, 80)]
    docs.append((90, "long" * 40_000 + " " + prose(90, 20_000)))
    docs.append((91, passage + " " + passage))
    return docs


@pytest.fixture(scope="module")
def frame(spark, corpus):
    """The corpus with columns whose names the operators use themselves."""
    df = spark.createDataFrame(corpus, SCHEMA).repartition(5)
    clash = ("n_words", "spans", "items", "kept", "n_removed", "score", "key", "label", "ids", "batch", "part", "n", "s", "evidence")
    return df.withColumns({c: F.lit(f"own {c}") for c in clash})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_packing():
    r = np.random.default_rng(3)
    for n, top in [(0, 9), (1, 9), (500, 7), (5000, 1 << 48), (5000, 1 << 63)]:
        keys = np.sort(r.integers(0, top, n, dtype=np.uint64))
        assert (packed.unpack_sorted(packed.pack_sorted(keys)) == keys).all()
        assert (packed.unpack_numbers(packed.pack_numbers(keys)) == keys).all()
        mixed = r.permutation(keys)
        groups = packed.Groups(mixed)
        assert (groups.order == np.argsort(mixed, kind="stable")).all() and (groups.spread(groups.keys) == mixed).all()
        bounds = packed.range_bounds(np.unique(keys), 7, 64)
        assert bounds[0] == 0 and bounds[-1] == len(np.unique(keys))


# --- substrings ----------------------------------------------------------------------------------


@pytest.mark.parametrize("window", [4, 50])
def test_repeats(frame, corpus, window):
    got = substrings.remove_repeats(frame, window=window)
    assert {"label", "kept", "n_words"} < set(got.columns) and got.filter("label <> 'own label'").isEmpty()
    found = {(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()}
    assert found == set(brute.repeats(corpus, window))


def test_repeats_of_equal_and_null_ids(spark, nothing):
    text = prose(5, 60)
    docs = [(None, text), (5, text), (5, text), (7, f"x {text} y")]
    got = substrings.remove_repeats(spark.createDataFrame(docs, SCHEMA))
    found = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()), key=repr)
    assert found == sorted(brute.repeats(docs), key=repr)
    assert [r[2] for r in found] == [0, 0, 60, 60]
    assert substrings.remove_repeats(nothing).count() == 0
    with pytest.raises(ValueError, match="even"):
        substrings.remove_repeats(nothing, window=5)


# --- decontamination -----------------------------------------------------------------------------


@pytest.mark.parametrize("shard_rows", [20, 200_000])
def test_leaks(spark, frame, corpus, shard_rows):
    texts = dict(corpus)
    items = [(1, texts[40][100:400].upper()), (2, texts[41]), (2, texts[41]), (3, "one"), (4, None), (5, "!?"), (None, "ALPHA1, beta2")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(frame, benchmark, shard_rows=shard_rows)
    assert got.filter("kept <> 'own kept'").isEmpty()
    found = [(r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), r["items"]) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(brute.leaks(corpus, items), key=repr)


def test_spans_are_cut_out(spark, nothing):
    docs = [(1, "Say: one, TWO three four! End."), (2, None), (3, "clean text"), (4, "two three")]
    benchmark = spark.createDataFrame([(1, "two three four"), (2, "two three")], "item_id long, text string")
    found = decontaminate.find_leaks(spark.createDataFrame(docs, SCHEMA), benchmark)
    got = {r.doc_id: r.text for r in decontaminate.remove_spans(found).collect()}
    assert got == {1: "Say: one, End.", 2: None, 3: "clean text", 4: ""}
    empty = benchmark.limit(0)
    assert decontaminate.find_leaks(spark.createDataFrame(docs, SCHEMA), empty).filter("size(spans) > 0").isEmpty()
    assert decontaminate.find_leaks(nothing, benchmark).count() == 0


# --- near duplicates -----------------------------------------------------------------------------


def test_similar_documents(frame, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(frame).collect()}
    assert got == brute.similar(corpus)


@pytest.mark.parametrize("seed", [1])
def test_similar_documents_of_many_versions(spark, seed, monkeypatch):
    """Versions that drift apart: links form chains, many pairs lie near the bound, blocks are small."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    r, docs = random.Random(seed), []
    for family in range(6):
        words = prose(seed * 100 + family, r.choice([7, 12, 20, 45, 160])).split()
        for _ in range(25):
            docs.append((len(docs), " ".join(words)))
            if r.random() < 0.7:
                words = list(words)
            words[r.randrange(len(words))] = r.choice(WORDS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == brute.similar(docs)


def test_similar_documents_at_the_edges(spark, nothing):
    assert jaccard.similar_documents(nothing).count() == 0
    rows = jaccard.similar_documents(spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "x"), (None, "alone")], SCHEMA)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in rows), key=repr) == sorted([(None, 4), (4, 4), (4, 4), (None, None)], key=repr)


def test_bands_cover_every_link():
    bands = jaccard.Bands(80)
    for a in range(1, 400):
        for b in range(a, a * 5 // 4 + 1):
            x, y = (int(v) for v in bands.of(np.array([a, b])))
            assert y - x in (0, 1)
            most = a + b - 2 * -(-80 * (a + b) // 180)  # differences of two linked sets
            assert most <= bands.n[y] - 1 - bands.t[y]


def test_components(spark):
    pairs = [(i, i + 1) for i in range(20)] + [(100, 50), (50, 100), (7, 7), (None, 3), (30, 31)]
    got = {r.node: r.label for r in links.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(21)} | {100: 50, 50: 50, 30: 30, 31: 30}


# --- tokens --------------------------------------------------------------------------------------

TRICKY = [
    "a  b\n\n c \t d  e <|endoftext|> f<|endoftext|>  g",
    " x",
    "   ",
    "é́   z　 q \x1c w  \u0085 k's I'll  don't",
    "\n a\n  b  ",
    "word " * 300,
    "x" * 3000,
    "tab\tend   nbsp   em",
]


@pytest.mark.parametrize(("name", "split"), [("word_bpe_49k.json", "between"), ("byte_bpe_50k.json", "before")])
def test_token_ids_are_the_library_s(spark, frame, corpus, name, split):
    path = f"{TOKENIZERS}/{name}"
    library = tokens.tokenizer_of(path)
    docs = [(i, t) for i, t in enumerate(TRICKY)]
    for own, df in ((docs, spark.createDataFrame(docs, SCHEMA)), (corpus, frame)):
        got = {r.doc_id: (r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in tokens.encode(df, path, split=split).collect()}
        for d, t in own:
            ids = library.encode(t or "", add_special_tokens=False).ids
            assert got[d] == (len(ids), ids), d


def test_texts_of_ids(spark, frame, corpus, nothing):
    path = f"{TOKENIZERS}/word_bpe_49k.json"
    library = tokens.tokenizer_of(path)
    both = {r.doc_id: r.decoded for r in tokens.encode_and_decode(frame, path).collect()}
    apart = {r.doc_id: r.decoded for r in tokens.decode(tokens.encode(frame, path), path).collect()}
    assert both == apart
    for d, t in corpus:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert both[d] == library.decode(ids, skip_special_tokens=False)
    odd = spark.createDataFrame([(1, None), (2, b""), (3, np.array([5, 999_999], "<u4").tobytes())], "doc_id long, ids binary")
    assert [r.decoded for r in tokens.decode(odd, path).orderBy("doc_id").collect()] == ["", "", library.id_to_token(5)]
    assert tokens.encode(nothing, path).count() == 0
    with pytest.raises(ValueError, match="split"):
        tokens.encode(nothing, path, split="other")


def test_token_files(spark, frame, corpus):
    path, folder = f"{TOKENIZERS}/byte_bpe_50k.json", scratch_dir(spark, "tokens")
    found, counts = tokens.encode_and_count(frame, path, split="before")
    tokenfiles.write_tokens(found, counts, len(corpus), folder)
    library, start, whole = tokens.tokenizer_of(path), 0, []
    got = {r.doc_id: (r.start, r.n_tokens, zlib.crc32(r.ids)) for r in tokenfiles.read_tokens(spark, folder).collect()}
    for d, t in sorted(corpus):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert got[d] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        whole += ids
    files = sorted((r.file, r.n) for r in spark.read.parquet(f"{folder}/blocks").groupBy("file").agg(F.sum("n_tokens").alias("n")).collect())
    begin = 0
    for file, n in files:
        for low, high in ((0, n), (n // 3, n // 2 + 1), (n - 1, n)):
            parts = tokenfiles.read_from_checkpoints(spark, folder, file, low, high).orderBy("start").collect()
            ids = np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist()
            assert ids == whole[begin + low : begin + high]
        begin += n


def test_token_files_of_nothing(spark, nothing):
    folder = scratch_dir(spark, "tokens")
    found, counts = tokens.encode_and_count(nothing, f"{TOKENIZERS}/byte_bpe_50k.json", split="before")
    tokenfiles.write_tokens(found, counts, 0, folder)
    assert tokenfiles.read_tokens(spark, folder).count() == 0


@pytest.mark.parametrize("n", [1, 5, 700, 6_000])
def test_rans(n):
    ids = np.random.default_rng(n).zipf(1.3, n).clip(1, 3000).astype(np.uint32)
    coder = rans.Coder(rans.quantised(np.bincount(ids)))
    for lanes, every in ((1, 3), (16, 4), (256, 8)):
        words, states, places = coder.encode(ids, lanes, every)
        assert (coder.decode(n, lanes, every, words, states, places) == ids).all()
        marks = len(places) // 8
        for k in {0, 1 % marks, marks // 2, marks - 1}:
            assert (coder.decode(n, lanes, every, words, states, places, k) == ids[k * lanes * every :]).all()
        if len(words) > 8:
            with pytest.raises(ValueError, match="stream"):
                coder.decode(n, lanes, every, words[:-4] + b"\0\0\0\1" + b"\0\0\0\0", states, places)


# --- fingerprints --------------------------------------------------------------------------------


def test_edited_neighbours(frame, corpus):
    got = {r.doc_id: r for r in fingerprints.edited_neighbours(frame).collect()}
    ordered = sorted(corpus, reverse=True)
    for (d, t), (_, following) in zip(ordered, [*ordered[1:], ordered[0]]):
        t, following = t or "", following or ""
        cut = len(t) // 3
        row = got[d]
        assert (row.n_chars, row.edited) == (len(t), t[: len(t) - cut] + following[:cut])
        assert 0 <= row.near_next <= 1 and 0 <= row.near_edited <= 1
        if len(t) > 200:
            assert 0.4 < row.near_edited < 1 or row.edited == t
    assert got[1].fingerprint == got[2].fingerprint and got[3].fingerprint == got[4].fingerprint == ""
    assert fingerprints.likeness(got[40].fingerprint, got[60].fingerprint) < 0.1
    assert fingerprints.likeness("", "") == 1 and fingerprints.likeness("", got[1].fingerprint) == 0


def test_fingerprints_do_not_depend_on_the_offset():
    inner = prose(8, 400)
    a, b = fingerprints.sketches([f"{prose(1, 3)} {inner}".encode(), f"{prose(2, 11)} {inner} {prose(3, 5)}".encode()])
    assert fingerprints.likeness(fingerprints.spelled(a), fingerprints.spelled(b)) > 0.85
    assert len(fingerprints.sketches([b"a" * 100_000])[0]) < 10


def test_neighbours_of_few(spark, nothing, frame):
    assert fingerprints.edited_neighbours(nothing).count() == 0
    one = fingerprints.edited_neighbours(spark.createDataFrame([(3, "abcdef")], SCHEMA)).collect()
    assert [(r.doc_id, r.edited, r.near_next) for r in one] == [(3, "abcdab", 1.0)]
    same = fingerprints.edited_neighbours(spark.createDataFrame([(3, "bbb"), (3, "aaa"), (None, "ccc")], SCHEMA)).collect()
    assert sorted((r.edited for r in same)) == ["aab", "bbc", "cca"]
    plain = fingerprints.fingerprint(frame.select("doc_id", "text"))
    assert plain.filter("text is null and fingerprint <> ''").isEmpty() and plain.columns == ["doc_id", "text", "fingerprint"]


# --- languages -----------------------------------------------------------------------------------


def test_languages(spark, frame, nothing):
    english = "the cat and the dog went to the house with an old friend of the family".split()
    german = "der Hund und die Katze gingen mit einem alten Freund der Familie in das große Haus".split()
    r = random.Random(4)
    say = lambda words, n: " ".join(r.choice(words) for _ in range(n))
    train = [(i, say(english, 60), "en") for i in range(30)] + [(50 + i, say(german, 60), "de") for i in range(30)]
    train += [(99, None, "en"), (98, "lost", None)]
    model = languages.fit(spark.createDataFrame(train, f"{SCHEMA}, lang string"))
    assert model.languages == ("de", "en")
    docs = [(1, say(english, 40)), (2, say(german, 40)), (3, say(english, 60) + " " + say(german, 30)), (4, None), (5, "12 €"), (6, "")]
    got = {x.doc_id: x for x in languages.identify(spark.createDataFrame(docs, SCHEMA).withColumn("score", F.lit("x")), model).collect()}
    assert [got[i].lang_pred for i in range(1, 7)] == ["en", "de", "en", "und", "und", "und"]
    assert got[1].languages == ["en"] and got[3].languages == ["en", "de"] and abs(got[3].score - 2 / 3) < 0.1
    assert got[4].score == got[5].score == 0
    none = languages.fit(nothing.withColumn("lang", F.lit("xx")))
    assert {x.lang_pred for x in languages.identify(frame, none).collect()} == {"und"}
    assert languages.identify(nothing, model).count() == 0
    with pytest.raises(ValueError, match="at most 1"):
        languages.fit(spark.createDataFrame(train, f"{SCHEMA}, lang string"), languages=1)


# --- toxicity ------------------------------------------------------------------------------------


def test_toxicity_learns_folds_and_excuses(spark, frame, nothing):
    r = random.Random(6)
    docs, labels = [], []
    for i in range(400):
        text, bad = prose(i, 30), i % 4 == 0
        if bad:
            text += " you Fool " + r.choice(["idiot", "ID1OT", "іdiоt"])
        elif i % 20 == 1:
            text += " holy fool"
        docs.append((i, text))
        labels.append((i, int(bad) if i % 50 else None))
    lexicon = toxicity.fit(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {"idiot", "fool"} <= set(lexicon.weights) and "holy fool" in lexicon.exceptions
    new = [(1, "what an 1d10t"), (2, "a holy fool"), (3, "the idiotic"), (4, None), (5, ""), (6, "idiot " * 20_000)]
    got = {x.doc_id: x for x in toxicity.score(spark.createDataFrame(new, SCHEMA).withColumn("weight", F.lit(1)), lexicon).collect()}
    assert got[1].terms == ["idiot"] and got[1].score > 0.5 and got[6].score > 0.5
    assert all(got[i].terms == [] and got[i].score < 0.5 for i in (2, 3, 4, 5))
    assert toxicity.score(frame, lexicon).count() == frame.count() and toxicity.score(nothing, lexicon).count() == 0
    unlabelled = toxicity.fit(frame, spark.createDataFrame([], "doc_id long, toxic int"))
    assert not unlabelled.weights and toxicity.score(frame, unlabelled).filter("score >= 0.5").isEmpty()


# --- quality -------------------------------------------------------------------------------------


def test_shares_of_sites(spark, frame):
    """Sums by hand: paths shrink to their host, hosts to all, without the document itself."""
    rows = [(i, "a", "x", 0.9) for i in range(30)] + [(100 + i, "b", "y", 0.2) for i in range(30)] + [(200, "b", "z", 0.9), (201, None, None, 0.5)]
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, evidence double").withColumn("n", F.lit("own"))
    got = {r.doc_id: r for r in quality.posteriors(scored).collect()}
    assert len(got) == len(rows) and got[0].n == "own"
    assert got[0].host_share > 0.75 and got[100].host_share < 0.35
    assert got[200].path_share < 0.9 and got[0].score > 0.9 > 0.2 > got[100].score
    assert abs(got[200].path_share - got[200].host_share) < 1e-9  # alone on its path
    assert quality.posteriors(scored.limit(0)).count() == 0


def test_quality_classifier(spark, frame, nothing):
    good = [(i, prose(i, 40 + i)) for i in range(60)]
    bad = [(1000 + i, " | ".join(prose(i, 30).split())) for i in range(60)]
    labels = spark.createDataFrame([(d, int(d < 1000)) for d, _ in good + bad], "doc_id long, quality int")
    classifier = quality.fit(spark.createDataFrame(good + bad, SCHEMA), labels)
    new = [(1, prose(777, 50)), (2, " | ".join(prose(778, 50).split())), (3, None), (4, "")]
    got = {r.doc_id: r.evidence for r in quality.evidence(spark.createDataFrame(new, SCHEMA), classifier).collect()}
    assert got[1] > 0.5 > got[2] and got[3] == got[4]
    assert quality.evidence(frame, classifier).count() == frame.count() and quality.evidence(nothing, classifier).count() == 0
    plain = quality.fit(nothing, labels)
    assert {r.evidence for r in quality.evidence(spark.createDataFrame(new, SCHEMA), plain).collect()} == {0.5}


# --- archives ------------------------------------------------------------------------------------

RECORD = "record_id long, url string, warc_type string, time timestamp, etag string, last_modified string, digest string, headers map<string,string>, payload string"


def test_revisits(spark):
    from tests.helpers import at

    t = lambda h: at(f"2024-01-01 {h:02}:00:00")
    rows = [
        (1, "http://www.Ex.com/a/?utm_source=q", "response", t(1), "v1", None, "d1", {"etag": "v1", "date": "1", "server": "s"}, "one"),
        (2, "https://ex.com/a#x", "revisit", t(2), "W/v1", None, "d1", {"date": "2", "content-length": "0"}, None),
        (3, "ex.com/a", "response", t(3), "v2", "m", "d2", None, "two"),
        (4, "ex.com/a", "revisit", t(3), "v1", None, None, {"x": "y"}, None),
        (5, "ex.com/a", "revisit", t(4), "v1", None, None, None, None),
        (6, "ex.com/a", "revisit", t(5), None, "m", "other", None, None),
        (7, "ex.com/a", "revisit", t(6), None, None, None, None, None),
        (8, "ex.com/b", "revisit", t(6), "v", None, None, None, None),
        (9, None, "revisit", t(6), "v", None, None, None, None),
        (10, "ex.com/a", "revisit", None, "v", None, None, None, None),
        (11, "ex.com/a", "request", t(7), None, None, None, None, None),
        (12, "ex.com/a", "response", t(3), "v0", None, "d0", None, "tie"),
    ]
    df = spark.createDataFrame(rows, RECORD).withColumn("status", F.lit("own"))
    for slice_records in (2, 1_000_000):
        got = {r.record_id: (r.status, r.resolved_from, r.headers, r.payload) for r in warc.resolve(df, slice_records).collect()}
        assert got[1] == ("full", None, {"etag": "v1", "date": "1", "server": "s"}, "one")
        assert got[2] == ("resolved", 1, {"etag": "v1", "server": "s", "date": "2"}, "one")
        assert got[4] == ("resolved", 1, {"etag": "v1", "date": "1", "server": "s"}, "one")  # of a smaller time
        assert got[5] == ("mismatch", None, {}, None)
        assert got[6][0] == "mismatch" and got[7] == ("unchecked", 12, {}, "tie")
        assert {got[i][0] for i in (8, 9, 10)} == {"missing"} and 11 not in got and len(got) == 11
    assert warc.resolve(df.limit(0)).count() == 0
    assert warc.resolve(df.union(df)).count() >= 11
