"""The registered queries of this subpackage: each operator over its whole table, as the columns to compare."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.llm import (
    collocations,
    decontaminate,
    fingerprints,
    jaccard,
    languages,
    merkle,
    oracles,
    packing,
    quality,
    substrings,
    tokenfiles,
    tokens,
    toxicity,
    warc,
    wordcache,
)
from tablejobs.llm.labelled import fold
from tablejobs.session import scratch_dir

TOKENIZERS = os.path.dirname(public_tokenizers.path("byte_bpe_50k.json"))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.SQL)


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Python workers of a local session import this package from where the driver has it.
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, folder, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = substrings.remove_repeats(docs, keep_text=False)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{TOKENIZERS}/word_bpe_49k.json"
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = tokens.encode_and_decode(docs, path)
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found, counts = wordcache.encode_and_count(docs, public_tokenizers.path("byte_bpe_50k.json"), split="before")
    path = scratch_dir(spark, "token-files")
    tokenfiles.write_tokens(found, counts, found.count(), path)
    return tokenfiles.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprints.edited_neighbours(table(spark, folder, "documents").select("doc_id", "text"))
    sha = F.sha2("edited", 256).alias("edited_sha256")
    return found.select("doc_id", "n_chars", sha, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query
def op1_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = fold("doc_id", 3) == 1
    model = languages.fit(docs.filter(~held).select("doc_id", "text", "lang"))
    found = languages.identify(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "languages", "shares")


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    held = fold("doc_id", 5) == 0
    lexicon = toxicity.fit(docs, labels.filter(~held))
    found = toxicity.score(docs.select("doc_id", held.alias("held_out"), "text"), lexicon)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "terms", "n_words")


def quality_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with their quality; the host is the source, and languages are the paths of a host."""
    held = fold("doc_id", 5) == 0
    classifier = quality.fit(docs, labels.filter(~held))
    scored = quality.evidence(docs, classifier).drop("text")
    return quality.posteriors(scored, host="source", path="lang").withColumn("held_out", held)


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    found = quality_of(docs, table(spark, folder, "labels"))
    kept = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return found.select("doc_id", "held_out", "evidence", "host_share", "path_share", "score", kept)


def captures(pages: DataFrame) -> DataFrame:
    """Four captures of each page as archive records: a full response now and then, else a revisit.

    The version of a page changes with a full response, and its entity tag with it. Every 17th revisit names a wrong tag,
    every 5th has a weak one, every 7th none but a digest.
    """
    n = F.col("page_id") * 4 + F.col("k")
    full = ((F.col("page_id") + F.col("k") * 3) % 5 == 0) | ((F.col("k") == 0) & (F.col("page_id") % 9 != 0))
    version = F.md5(F.col("html"))
    wrong = n % 17 == 0
    tag = F.when(~full & (n % 7 == 0), None).when(~full & wrong, F.lit("none")).otherwise(version)
    tag = F.when(~full & (n % 5 == 0), F.concat(F.lit("W/"), tag)).otherwise(tag)
    dated = F.col("k") * 1_000_000 + F.col("page_id")
    headers = F.when(
        full, F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("date"), dated.cast("string"), F.lit("content-length"), F.length("html").cast("string"))
    ).otherwise(F.create_map(F.lit("date"), dated.cast("string"), F.lit("content-length"), F.lit("0"), F.lit("expires"), F.lit("soon")))
    return pages.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(
        n.alias("record_id"),
        "url",
        F.when(full, "response").otherwise("revisit").alias("warc_type"),
        F.timestamp_seconds(dated).alias("time"),
        tag.alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        version.alias("digest"),
        headers.alias("headers"),
        F.when(full, F.col("html")).alias("payload"),
    )


@query
def op7_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve(captures(table(spark, folder, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    return found.select(
        "record_id",
        "canonical",
        "status",
        "resolved_from",
        F.array_join(lines, "|").alias("headers"),
        F.sha2("payload", 256).alias("payload_sha256"),
    )


ORACLES["op7_warc_revisits"] = r"""
WITH record AS (
    SELECT page_id * 4 + k AS record_id, k, html, k * 1000000 + page_id AS tick, page_id,
        (page_id + k * 3) % 5 = 0 OR (k = 0 AND page_id % 9 <> 0) AS whole,
        regexp_replace(regexp_replace(regexp_replace(split_part(url, '#', 1), '^[a-z]+://(www\.)?', ''),
            '([?&])(utm_source|ref)=[^&]*', '\1', 'g'), '/?[?&]*$', '') AS stripped
    FROM pages, range(4) r(k)
), tidy AS (
    SELECT *, regexp_replace(stripped, '/+\?', '?') AS canonical FROM record
), version AS (
    SELECT *, CASE WHEN whole THEN md5(html) WHEN record_id % 7 = 0 THEN NULL
        WHEN record_id % 17 = 0 THEN 'none' ELSE md5(html) END AS tag
    FROM tidy
), pair AS (
    SELECT v.*, f.record_id AS f_id, f.html AS f_html, f.tick AS f_tick
    FROM version v LEFT JOIN version f ON f.canonical = v.canonical AND f.whole AND f.tick < v.tick AND NOT v.whole
    QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY f.tick DESC NULLS LAST, f.record_id DESC) = 1
), judged AS (
    SELECT *, CASE WHEN whole THEN 'full' WHEN f_id IS NULL THEN 'missing'
        WHEN coalesce(tag = md5(f_html), md5(html) = md5(f_html)) THEN 'resolved' ELSE 'mismatch' END AS status
    FROM pair
)
SELECT record_id, canonical, status, CASE WHEN status = 'resolved' THEN f_id END AS resolved_from,
    CASE status
        WHEN 'full' THEN 'content-length:' || length(html) || '|content-type:text/html|date:' || tick
        WHEN 'resolved' THEN 'content-length:' || length(f_html) || '|content-type:text/html|date:' || tick || '|expires:soon'
        ELSE 'content-length:0|date:' || tick || '|expires:soon' END AS headers,
    CASE status WHEN 'full' THEN sha256(html) WHEN 'resolved' THEN sha256(f_html) END AS payload_sha256
FROM judged
"""


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents").select("text", "lang"))


ORACLES["op11_collocations"] = r"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
    FROM (SELECT lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), total AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang
), gram AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM piece, (VALUES (1), (2), (3)) v(k)
), f AS (
    SELECT lang, k, phrase, count(*) AS n FROM gram GROUP BY ALL HAVING count(*) >= 10
), cut AS (
    SELECT c.lang, c.k, c.phrase, c.n AS a, l.n AS l, r.n AS r, l.k AS at,
        CAST(1000000 AS HUGEINT) * c.n * c.n // (CAST(l.n AS HUGEINT) * r.n) AS score
    FROM f c JOIN f l ON l.lang = c.lang AND l.k < c.k
        AND l.phrase = array_to_string(string_split(c.phrase, ' ')[:l.k], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(string_split(c.phrase, ' ')[l.k + 1:], ' ')
    WHERE c.k > 1
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, l.k) = 1
), longer AS (
    SELECT lang, phrase, max(n) AS n FROM (
        SELECT lang, n, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase
        FROM f WHERE k = 3) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n,
    CAST(score AS BIGINT) AS score
FROM cut JOIN total USING (lang)
WHERE NOT EXISTS (SELECT 1 FROM longer x WHERE x.lang = cut.lang AND x.phrase = cut.phrase AND 100 * x.n >= 50 * cut.a)
QUALIFY rank <= 2000
"""


@query
def op12_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    pieces = packing.cut(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    found = merkle.manifest(docs, tampered=fold("doc_id", 3) == 0)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _merkle_sql() -> str:
    def field(column: str) -> str:
        text = f"CAST({column} AS VARCHAR)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    lower = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
    # crc32, a byte at a time and a bit at a time.
    crc = """xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""
    return f"""
WITH RECURSIVE leaf AS (
    SELECT doc_id, lang, {leaf('text')} AS h, CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS held,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, {leaf('text')}) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n
    FROM documents
), up AS (
    SELECT 0 AS level, lang, pos, n, h FROM leaf
    UNION ALL
    SELECT level + 1, lang, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1
    GROUP BY level, lang, n, pos // 8
), sub AS (
    SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
), top AS (
    SELECT 0 AS level, pos, n, h FROM sub
    UNION ALL
    SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1
    GROUP BY level, n, pos // 8
), way AS (
    SELECT l.doc_id, l.lang, l.pos AS own, u.level, l.pos // (8 ** u.level)::BIGINT AS pos FROM leaf l
    JOIN (SELECT DISTINCT lang, level FROM up WHERE n > 1) u ON u.lang IS NOT DISTINCT FROM l.lang
), sibling AS (
    SELECT w.lang, w.own, w.level, coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos < w.pos), '') AS l,
        coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos > w.pos), '') AS r
    FROM way w JOIN up u ON u.level = w.level AND u.lang IS NOT DISTINCT FROM w.lang AND u.pos // 8 = w.pos // 8
    GROUP BY w.lang, w.own, w.level
    UNION ALL
    SELECT s.lang, l.pos, 1000 + t.level, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < s.pos // (8 ** t.level)::BIGINT), ''),
        coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > s.pos // (8 ** t.level)::BIGINT), '')
    FROM sub s JOIN leaf l ON l.lang IS NOT DISTINCT FROM s.lang
    JOIN top t ON t.n > 1 AND t.pos // 8 = s.pos // (8 ** (t.level + 1))::BIGINT
    GROUP BY s.lang, l.pos, t.level
), path AS (
    SELECT lang, own, list(l ORDER BY level) AS l, list(r ORDER BY level) AS r, string_agg(l || r, '' ORDER BY level) AS proof
    FROM sibling GROUP BY lang, own
), fold AS (
    SELECT leaf.lang, leaf.pos, 1 AS step, held AS h FROM leaf
    UNION ALL
    SELECT f.lang, f.pos, step + 1, sha256(p.l[step] || f.h || p.r[step]) FROM fold f
    JOIN path p ON p.lang IS NOT DISTINCT FROM f.lang AND p.own = f.pos WHERE step <= len(p.l)
), last AS (
    SELECT lang, pos, arg_max(h, step) AS h FROM fold GROUP BY lang, pos
)
SELECT leaf.doc_id, leaf.h AS leaf, sub.h AS subroot, top.h AS root, sha256(coalesce(path.proof, '')) AS proof_sha256,
    last.h AS folded_root, last.h = top.h AS verified
FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang JOIN top ON top.n = 1
JOIN last ON last.lang IS NOT DISTINCT FROM leaf.lang AND last.pos = leaf.pos
LEFT JOIN path ON path.lang IS NOT DISTINCT FROM leaf.lang AND path.own = leaf.pos
"""


ORACLES["op13_merkle_manifest"] = _merkle_sql()
