import random
import time

from tablejobs.llm import toxicity


def test_all_terms_and_exceptions_with_support_stay(spark):
    pairs = [c + v for c in "bcdfghjklmnpqrtvwxyz" for v in "aeiou"]
    words = [a + b for a in pairs for b in pairs if a != b]
    certain, common = words[:3000] + words[6000:9000], words[3000:6000]
    bad = "sus " + " ".join(certain)
    excused = " ".join(f"{w} sus" for w in common)
    docs = [(i, bad) for i in range(30)] + [(100 + i, excused) for i in range(8)] + [(200 + i, "plain words") for i in range(500)]
    labels = [(d, int(d < 100)) for d, _ in docs]
    lexicon = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(certain) | {"sus"} == lexicon.weights.keys()
    assert len(lexicon.exceptions) == 2 * len(common) - 1


def test_many_hits_and_phrases():
    """As every term against every phrase, and in a second for some hundred thousand words."""
    lexicon = toxicity.Lexicon({"fool": 2.0, "fool fool": 1.0}, frozenset({"holy fool", "fool holy fool fool"}))
    r = random.Random(4)
    for _ in range(50):
        text = " " + " ".join(r.choice(["holy", "fool", "fool", "x"]) for _ in range(12)) + " "
        spans = [(i, i + n) for n in (1, 2, 4) for i in range(13 - n)]
        said = lambda i, j: " ".join(text.split()[i:j])
        excused = [s for s in spans if said(*s) in lexicon.exceptions]
        clear = [said(*s) for s in spans if said(*s) in lexicon.weights and not any(x <= s[0] and s[1] <= y for x, y in excused)]
        assert sorted(t for t, _ in lexicon.found(text)) == sorted(clear)
    begin = time.perf_counter()
    assert len(lexicon.found(" " + "holy fool fool x " * 24_000)) > 1000
    assert time.perf_counter() - begin < 5
