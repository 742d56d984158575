"""Line dedup over a suffix array of line ids, with DataFrame functions only.

The documents, in the order of doc_id, are one long sequence of lines. Prefix doubling names each
suffix by its first 1, 2, 4, ... lines: suffixes with a common prefix of that length form an
interval of the suffix array and share a name, the position of the earliest of them, and a name of
twice the length comes from the names at a suffix and one length further on. Suffixes alone in
their interval have no longer common prefix and drop out, so only repeated lines go round.

A run of lines repeats if its interval (the names of two overlapping powers of two that cover it)
has an earlier suffix. Only runs with ``min_words`` words or more count. Each longer repeated run
is the union of the shortest such runs that begin or end at its lines, so doubling stops at the
depth which these need: maximal runs appear as the union, and are deleted wherever they have an
earlier copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partflow.llm.common import drop_written, table, text_hash, written

MIN_WORDS = 10
_BLANKS = "\x20\x09\x0b\x0c\x0d"
_WORD = r"[^\x20\x09-\x0D]+"


def _lines(docs: DataFrame) -> DataFrame:
    """Each line with words: its document, k (its number among such lines), line_no, two hashes, words, and id.

    ids follow (doc_id, text_key, k) and are dense in a document, so id - k stands for it.
    """
    lines = F.transform(
        F.split("text", "\n"), lambda x, i: F.struct(i.alias("line_no"), F.btrim(x, F.lit(_BLANKS)).alias("line"))
    )
    rows = docs.select(
        "doc_id", "text_key", F.posexplode(F.filter(lines, lambda x: x["line"] != "")).alias("k", "x")
    ).select(
        "doc_id",
        "text_key",
        "k",
        F.col("x.line_no").alias("line_no"),
        F.xxhash64("x.line").alias("h1"),
        F.xxhash64("x.line", F.lit(1)).alias("h2"),
        F.regexp_count("x.line", F.lit(_WORD)).alias("words"),
    )
    # Repeated rows meet in a range, so dropping them and sorting take no further shuffle.
    rows = rows.repartitionByRange("doc_id", "text_key").dropDuplicates(["doc_id", "text_key", "k"])
    rows = rows.sortWithinPartitions("doc_id", "text_key", "k")
    return written(rows.withColumn("id", F.monotonically_increasing_id()), "lines")


def repeated_runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows (doc, start, length, first): shortest runs of min_words words with an earlier copy at id first.

    lines: rows (id, k, h1, h2, words); doc is the id of the document's first line, start a k.
    """
    # Groups are written before they join: a join of two plain shuffles can split the rows of a hot line.
    groups = lines.groupBy("h1", "h2").agg(F.min("id").alias("n0"), F.count("*").alias("c")).filter("c > 1").drop("c")
    groups = written(groups, "groups")
    base = written(
        lines.join(groups, ["h1", "h2"]).select((F.col("id") - F.col("k")).alias("doc"), "k", "words", "n0"), "level"
    )
    # The shortest runs of repeated lines, by where they start and by where they end.
    at = Window.partitionBy("doc").orderBy("k")
    runs = base.withColumn("island", F.col("k") - F.row_number().over(at))
    island = Window.partitionBy("doc", "island")
    runs = runs.withColumn("upto", F.sum("words").over(island.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.withColumn("before", F.col("upto") - F.col("words"))
    ahead, back = island.orderBy("before").rangeBetween(0, min_words - 1), island.orderBy("upto").rangeBetween(1 - min_words, 0)
    runs = runs.select(
        "doc",
        "k",
        F.count("*").over(ahead).cast("int").alias("m"),
        (F.max("upto").over(ahead) - F.col("before")).alias("w"),
        F.count("*").over(back).cast("int").alias("m_back"),
        (F.col("upto") - F.min("before").over(back)).alias("w_back"),
    )
    both = F.array(F.struct("k", "m", "w"), F.struct((F.col("k") - F.col("m_back") + 1).alias("k"), F.col("m_back").alias("m"), F.col("w_back").alias("w")))
    runs = runs.select("doc", F.inline(F.array_distinct(both))).filter(F.col("w") >= min_words)
    runs = written(runs.select("doc", F.col("k").alias("start"), F.col("m").alias("length")).distinct(), "runs")
    longest = runs.agg(F.max("length")).first()[0] or 1

    level = 0
    while 2 << level <= longest:
        step = 1 << level
        name, nxt = f"n{level}", f"n{level + 1}"
        shifted = base.withColumn("further", F.max(name).over(at.rangeBetween(step, step)))
        has = F.col(name).isNotNull() & F.col("further").isNotNull()
        # Without a pair, a key of its own: such rows match nothing and don't meet in one partition.
        keyed = shifted.withColumn("a", F.when(has, F.col(name)).otherwise(-1 - F.col("doc") - F.col("k"))).withColumn(
            "b", F.when(has, F.col("further")).otherwise(F.lit(-1).cast("long"))
        )
        groups = (
            keyed.filter(has)
            .groupBy("a", "b")
            .agg(F.min(F.col("doc") + F.col("k")).alias(nxt), F.count("*").alias("c"))
            .filter("c > 1")
            .drop("c")
        )
        groups = written(groups, "groups")
        longer = written(keyed.join(groups, ["a", "b"], "left").drop("a", "b", "further"), "level")
        drop_written(base)
        base, level = longer, level + 1

    power = F.floor(F.log2(F.col("length") + 0.5)).cast("int")
    names = base.select("doc", "k", F.array(*[f"n{i}" for i in range(level + 1)]).alias("names"))
    runs = runs.withColumn("power", power).withColumn("tail", (F.col("start") + F.col("length") - F.expr("shiftleft(1, power)")).cast("int"))
    runs = (
        runs.join(names.select("doc", F.col("k").alias("start"), F.col("names").alias("x")), ["doc", "start"])
        .join(names.select("doc", F.col("k").alias("tail"), F.col("names").alias("y")), ["doc", "tail"])
        .select(
            "doc",
            "start",
            "length",
            F.element_at("x", F.col("power") + 1).alias("a"),
            F.element_at("y", F.col("power") + 1).alias("b"),
        )
        .filter("a is not null and b is not null")
    )
    runs = written(runs, "named")
    drop_written(base)
    firsts = runs.groupBy("a", "b", "length").agg(F.min(F.col("doc") + F.col("start")).alias("first"), F.count("*").alias("c"))
    firsts = written(firsts.filter("c > 1"), "firsts")
    return (
        runs.join(firsts, ["a", "b", "length"])
        .filter(F.col("doc") + F.col("start") > F.col("first"))
        .select("doc", "start", "length", "first")
    )


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The input's rows and columns, text without later copies of repeated line runs, and n_lines, deleted.

    A line is deleted if it lies in a run of consecutive lines of its document, of min_words words
    or more together, that also occurs earlier: in a document before it (by doc_id, nulls first,
    then by a hash of the text), or further up in its own. Lines are compared without white space
    at their ends; lines without words belong to no run, do not interrupt one and stay. n_lines
    counts the lines with words, deleted lists the line numbers (from 0) that went. Rows that
    repeat a doc_id and a text are one document and get the same result. Null and empty texts stay
    as they are, with no lines. Input columns named n_lines or deleted are replaced.
    """
    docs = documents.drop("n_lines", "deleted").withColumn("__key", text_hash(F.col("text")))
    lines = _lines(docs.select("doc_id", F.col("__key").alias("text_key"), "text"))
    runs = repeated_runs(lines.select("id", "k", "h1", "h2", "words"), min_words)
    gone = (
        runs.select(F.explode(F.sequence(F.col("doc") + F.col("start"), F.col("doc") + F.col("start") + F.col("length") - 1)).alias("id"))
        .distinct()
        .join(lines.select("id", "doc_id", "text_key", "line_no"), "id")
        .groupBy(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"))
        .agg(F.sort_array(F.collect_set("line_no")).alias("deleted"))
    )
    all_lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("deleted"))
    text = F.when(F.col("deleted").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at(all_lines, i + 1)), "\n")
    )
    has_words = F.filter(all_lines, lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    out = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__key") == F.col("__k")), "left")
    return out.select(
        *[text.alias("text") if c == "text" else c for c in docs.columns if c != "__key"],
        F.coalesce(F.size(has_words), F.lit(0)).alias("n_lines"),
        F.coalesce("deleted", F.array().cast("array<int>")).alias("deleted"),
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size("deleted").cast("long").alias("n_deleted"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, text FROM documents),
l AS (
  SELECT r, p, line, row_number() OVER (PARTITION BY r ORDER BY p) AS k, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT r, p, trim(x, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line
        FROM (SELECT r, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS p FROM d))
  WHERE line <> ''),
c AS (SELECT *, sum(words) OVER (PARTITION BY r ORDER BY k) AS upto FROM l),
-- every run of lines with ten words or more that no longer has them without its first, or without its last, line
run AS (
  SELECT a.r, a.k AS a, b.k AS b
  FROM c AS a JOIN c AS b ON a.r = b.r AND b.k BETWEEN a.k AND a.k + 9
  WHERE b.upto - a.upto + a.words >= 10 AND (b.upto - a.upto < 10 OR b.upto - b.words - a.upto + a.words < 10)),
whole AS (SELECT r, list(line ORDER BY k) AS lines FROM l GROUP BY r),
named AS (SELECT run.*, array_to_string(lines[a:b], chr(10)) AS name FROM run JOIN whole USING (r)),
later AS (
  SELECT * FROM (SELECT *, min((r, a)) OVER (PARTITION BY name) AS first FROM named) WHERE first < (r, a)),
gone AS (SELECT DISTINCT r, k FROM (SELECT r, unnest(range(a, b + 1)) AS k FROM later)),
cut AS (SELECT l.r, l.p FROM gone JOIN l USING (r, k)),
kept AS (
  SELECT x.r, string_agg(x.line, chr(10) ORDER BY x.p) AS text
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS p FROM d) AS x
  ANTI JOIN cut ON x.r = cut.r AND x.p = cut.p GROUP BY x.r)
SELECT doc_id, coalesce(n, 0) AS n_lines, coalesce(m, 0) AS n_deleted, sha256(coalesce(kept.text, '')) AS text_sha256
FROM d LEFT JOIN (SELECT r, count(*) AS n FROM l GROUP BY r) USING (r) LEFT JOIN (SELECT r, count(*) AS m FROM cut GROUP BY r) USING (r)
  LEFT JOIN kept USING (r)
"""
