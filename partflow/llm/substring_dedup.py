"""Substring dedup: near-duplicate paragraphs by MinHash banding, removed by connected components.

A paragraph is a line with words. Bands are tuned for recall (``BANDS`` of ``ROWS``: a link at a
similarity of 0.8 is missed with a probability of 1e-5, and unrelated paragraphs, which share no
five-word shingle, never meet). Colliding paragraphs are joined and confirmed by the exact Jaccard
similarity of their shingle sets, and of each component only its first paragraph stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import table, text_hash
from partflow.llm.near_dup import PERCENT, near_groups

SHINGLE, BANDS, ROWS, MIN_WORDS = 5, 16, 3, 10
_WORD = r"[^\x20\x09-\x0D]+"


def paragraph_groups(documents: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, text_key, line_no, words, first): paragraphs of min_words words or more, and their component.

    first is the component's smallest (doc_id, text_key, line_no), nulls before numbers: the
    paragraph that stays. Rows that repeat a doc_id and text give one set of paragraphs. Lines of any
    length are taken whole; other columns are ignored, whatever their names.
    """
    lines = documents.select("doc_id", text_hash(F.col("text")).alias("text_key"), F.posexplode(F.split("text", "\n")))
    words = F.regexp_count("col", F.lit(_WORD))
    # min_words words take so many characters: most short lines go without the pattern.
    items = lines.filter((F.char_length("col") >= 2 * min_words - 1) & (words >= min_words)).select(
        F.struct("doc_id", "text_key", F.col("pos").alias("line_no")).alias("id"), F.col("col").alias("text")
    )
    found = near_groups(items, SHINGLE, BANDS, ROWS, percent, sketched=False)
    # As many rows as paragraphs; a paragraph of a repeated row counts once.
    return found.groupBy("id").agg(F.first("component").alias("first"))


def dedup_paragraphs(documents: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """The input's rows and columns, text without later near-copies of paragraphs, and n_paragraphs, deleted, copies_of.

    deleted lists the numbers of the lines that went (from 0), copies_of the doc_ids of the
    paragraphs that stay in their place. n_paragraphs counts the lines of min_words words or more.
    Paragraphs are near-copies within a document too. Shorter lines stay. Null and empty texts stay
    as they are. Rows that repeat a doc_id and text get the same result. Input columns with one of
    the three names are replaced; an empty table gives an empty result.
    """
    docs = documents.drop("n_paragraphs", "deleted", "copies_of").withColumn("__key", text_hash(F.col("text")))
    later = ~F.col("id").eqNullSafe(F.col("first"))
    per_doc = (
        paragraph_groups(documents, min_words, percent)
        .groupBy(F.col("id.doc_id").alias("__d"), F.col("id.text_key").alias("__k"))
        .agg(
            F.count("*").alias("n"),
            F.sort_array(F.collect_list(F.when(later, F.col("id.line_no")))).alias("gone"),
            F.sort_array(F.collect_set(F.when(later, F.col("first.doc_id")))).alias("of"),
        )
    )
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    text = F.when(F.size("gone") > 0, F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), "\n")).otherwise(
        F.col("text")
    )
    out = docs.join(per_doc, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__key") == F.col("__k")), "left")
    return out.select(
        *[text.alias("text") if c == "text" else c for c in docs.columns if c != "__key"],
        F.coalesce("n", F.lit(0)).alias("n_paragraphs"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("deleted"),
        F.coalesce("of", F.array().cast(f"array<{documents.schema['doc_id'].dataType.simpleString()}>")).alias("copies_of"),
    )


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = dedup_paragraphs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("deleted").cast("long").alias("n_deleted"),
        "copies_of",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


OP2_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, text FROM documents),
p AS (
  SELECT doc_id, p, line, regexp_extract_all(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS p FROM d)),
k AS (SELECT *, row_number() OVER (ORDER BY doc_id, p) AS id FROM p WHERE len(w) >= 10),
s AS (SELECT DISTINCT id, sh FROM (
  SELECT id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS sh FROM k)),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
link AS (
  SELECT a.id AS a, b.id AS b FROM s AS a JOIN s AS b ON a.sh = b.sh AND a.id <> b.id
  JOIN n AS na ON na.id = a.id JOIN n AS nb ON nb.id = b.id
  GROUP BY a.id, b.id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
top AS (SELECT a AS id, min(b) AS b FROM reach GROUP BY a),
gone AS (SELECT k.doc_id, k.p, f.doc_id AS of FROM k JOIN top USING (id) JOIN k AS f ON f.id = top.b WHERE top.b < k.id),
kept AS (
  SELECT p.doc_id, string_agg(p.line, chr(10) ORDER BY p.p) AS text FROM p ANTI JOIN gone ON p.doc_id = gone.doc_id AND p.p = gone.p
  GROUP BY p.doc_id)
SELECT doc_id, coalesce(n, 0) AS n_paragraphs, coalesce(m, 0) AS n_deleted, coalesce(of, []) AS copies_of,
  sha256(coalesce(kept.text, '')) AS text_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM k GROUP BY 1) USING (doc_id)
  LEFT JOIN (SELECT doc_id, count(*) AS m, list_sort(list(DISTINCT of)) AS of FROM gone GROUP BY 1) USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
