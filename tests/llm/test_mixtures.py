import random

from pyspark.sql import functions as F

from tablejobs.llm import languages

SCHEMA = "doc_id long, text string"


def spoken(seed, n):
    """Words of a language of its own: six letters and no others."""
    r = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèêàçñåøæœłźżőű"[seed * 6 : seed * 6 + 6]
    return " ".join("".join(r.choice(letters) for _ in range(6)) for _ in range(n))


def test_six_languages_in_a_text(spark):
    train = [(i, spoken(i % 6, 200), f"l{i % 6}") for i in range(60)]
    model = languages.fit(spark.createDataFrame(train, f"{SCHEMA}, lang string"))
    docs = [(1, " ".join(spoken(k, 50) for k in range(6))), (2, " ".join(spoken(k, 60) for k in range(5))), (3, spoken(2, 40))]
    got = {x.doc_id: x for x in languages.identify(spark.createDataFrame(docs, SCHEMA), model).collect()}
    assert [len(got[i].languages) for i in (1, 2, 3)] == [6, 5, 1]
    assert abs(got[1].score - 1 / 6) < 0.02 and abs(got[2].score - 1 / 5) < 0.02 and got[3].lang_pred == "l2"
    assert abs(sum(got[1].shares) - 1) < 1e-3


def test_all_labelled_rows_count(spark):
    """A language of a few documents among very many is learnt, whatever their ids."""
    rare = (F.col("doc_id") < 20) & (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1)
    docs = spark.range(0, 200_001, 1, 8).withColumnRenamed("id", "doc_id")
    docs = docs.withColumn("text", F.when(rare, "zyx").otherwise("abc")).withColumn("lang", F.when(rare, "rare").otherwise("common"))
    assert languages.fit(docs).languages == ("common", "rare")
