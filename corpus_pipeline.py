"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of documents.

What all stages do: null and empty texts are rows like others (language ID drops them, as they hold
no language); rows that repeat are treated alike, but for near-dedup, which keeps one; texts of any length are
taken whole; further columns, of any names, are kept; an empty table gives an empty one. Ties are
decided by doc_id and a hash of the text, never by the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm.common import drop_written, scratch, table, text_hash, written
from partflow.llm.decontaminate import contamination
from partflow.llm.language_id import UNDECIDED, identify
from partflow.llm.line_dedup import dedup_lines
from partflow.llm.mixing import in_shards, mix
from partflow.llm.near_dup import drop_near_duplicates

#: A document stays only if its language is at least this probable.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose language can't be told."""
    found = identify(docs.select("doc_id", "text", "lang", F.struct("*").alias("__row")), F.lit(True))
    return found.filter((F.col("lang_pred") != UNDECIDED) & (F.col("score") >= LEAST_SCORE)).select("__row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs, and documents of which nothing else is left."""
    rest = F.struct(*[c for c in docs.columns if c not in ("doc_id", "text", "n_chars")])
    found = dedup_lines(docs.select("doc_id", "text", rest.alias("__rest")))
    left = found.filter((F.col("n_lines") == 0) | (F.col("n_lines") > F.size("deleted")))
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return left.select("doc_id", "text", n_chars, "__rest.*").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, with the parameters of op10 (two-word shingles, similarity 0.8)."""
    return drop_near_duplicates(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten or more consecutive words of a benchmark item (or a whole shorter one)."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = found.filter(F.size("spans") > 0).select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("__d")) & (text_hash(docs["text"]) == F.col("__k"))
    return docs.join(hit, same, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each copy that the mix takes, with its shard."""
    return in_shards(mix(docs))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

#: Prefix doubling, components and the splitting tree are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on documents. A stage's own tables go when its result is written, and that when the next one's is."""
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch() as tables:
            docs = written(stage(spark, docs, sf_dir), name)
            tables.remove(docs)
        drop_written(*last)
        last = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
