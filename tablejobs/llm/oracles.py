"""DuckDB SQL of the operators on word windows and shingles, over whole tables."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(column: str) -> str:
    return f"translate({column}, '{UPPER}', '{UPPER.lower()}')"


# A window is its words, joined by spaces; the smallest id in which it starts tells who keeps it.
SUBSTRING_DEDUP = r"""
WITH doc AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), win AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)
), owner AS (
    SELECT g, min(doc_id) AS first_id FROM win GROUP BY g
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN owner USING (g) WHERE first_id < doc_id
), word AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(words, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Documents are cut into windows of every length that an item's window has: 10 words, or those of the shorter items.
DECONTAMINATE = f"""
WITH doc AS (
    SELECT doc_id, coalesce(regexp_extract_all({_lower('text')}, '{WORDS}'), []) AS w FROM documents
), item AS (
    SELECT item_id, regexp_extract_all({_lower('text')}, '{WORDS}') AS w FROM benchmark
), item_window AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)
), doc_window AS (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc JOIN (SELECT DISTINCT k FROM item_window) ON len(w) >= k)
), hit AS (
    SELECT DISTINCT doc_id, k, i, item_id FROM doc_window JOIN item_window USING (k, g)
), word AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(word.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(word.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# Pairs come from shared shingles, components from all that is reached by links.
NGRAM_JACCARD_JOIN = rf"""
WITH RECURSIVE doc AS (
    SELECT doc_id, coalesce(regexp_extract_all({_lower('text')}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM doc WHERE len(w) > 0)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), pair AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM pair p JOIN size x ON x.doc_id = p.a JOIN size y ON y.doc_id = p.b
    WHERE 100 * p.n >= 80 * (x.n + y.n - p.n)
), both_ways AS (
    SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
    SELECT doc_id, doc_id AS other FROM doc
    UNION
    SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.other
)
SELECT doc_id, coalesce(size.n, 0) AS n_shingles, c.component_id
FROM doc LEFT JOIN size USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

SQL = {
    "op5_substring_dedup": SUBSTRING_DEDUP,
    "op6_decontaminate": DECONTAMINATE,
    "op10_ngram_jaccard_join": NGRAM_JACCARD_JOIN,
}
