"""Benchmark decontamination by winnowing, with DataFrame functions only.

Both sides are cut into words and hashed in five-word grams. Of each window of six grams, which spans
ten words, the smallest hash is kept: the fingerprints of a text are the grams that are the smallest of
some window. Two texts that share ten words share the smallest gram among them, so every such span has
a fingerprint in common. Documents' fingerprints meet those of the benchmark in a join, and each hit is
extended word by word to both sides: runs of ten equal words or more are contaminated. The windows that a gram
is the fingerprint of reach five words to each side of it, and no hit is extended further: the next fingerprint
takes over there. So what a benchmark fingerprint needs is these words, and places with the same ones, as in
a text that repeats a word or a line that many items have, are one place, named by a 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.llm.common import drop_written, lower_ascii, table, text_hash, written

WINDOW, GRAM = 10, 5
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The benchmark's words and fingerprints are broadcast up to this many bytes, else both sides are shuffled.
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), NOT_WORD), ""), F.array().cast("array<string>"))


def _pairs(df: DataFrame, new: str, left: str, right: str, shift: int, merge) -> DataFrame:
    """new[i] = merge(left[i], right[i + shift]) wherever right has such an element."""
    n = F.least(F.size(left), F.greatest(F.size(right) - F.lit(shift), F.lit(0)))
    return df.withColumn(new, F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(1 + shift), n), merge))


def winnowed(df: DataFrame) -> DataFrame:
    """Adds fp, for each five-word gram of ``words`` its hash if it is a fingerprint, else null.

    A gram is one if it is the smallest of a window of six, that is if the largest of the minima of
    the windows around it is its own hash. Texts of fewer than ten words have none.
    """
    hashed = lambda a, b: F.xxhash64(a, b)
    least, most = lambda a, b: F.least(a, b), lambda a, b: F.greatest(a, b)
    df = df.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    df = _pairs(df, "h2", "h1", "h1", 1, hashed)
    df = _pairs(df, "h4", "h2", "h2", 2, hashed)
    df = _pairs(df, "h5", "h4", "h1", 4, hashed).drop("h1", "h2", "h4")
    df = _pairs(df, "m2", "h5", "h5", 1, least)
    df = _pairs(df, "m4", "m2", "m2", 2, least)
    df = _pairs(df, "m6", "m4", "m2", 4, least).drop("m2", "m4")
    edge = F.array_repeat(F.lit(-(2**63)).cast("long"), WINDOW - GRAM)
    df = df.withColumn("m6", F.when(F.size("m6") > 0, F.concat(edge, "m6", edge)).otherwise(F.slice("m6", 1, 0)))
    df = _pairs(df, "x2", "m6", "m6", 1, most)
    df = _pairs(df, "x4", "x2", "x2", 2, most)
    df = _pairs(df, "x6", "x4", "x2", 4, most).drop("m6", "x2", "x4")
    return df.withColumn("fp", F.zip_with(F.slice("h5", F.lit(1), F.size("x6")), "x6", lambda h, x: F.when(h == x, h))).drop("h5", "x6")


def _short(words: str, n: int) -> Column:
    """The hashes of all runs of n words."""
    last = F.size(words) - F.lit(n - 1)
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(n))))


def _equal(a: Column, b: Column) -> Column:
    """How many words a and b have in common from their beginning on."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x == y), False)
    return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def _around(words: str, p: Column) -> tuple[Column, Column]:
    """The words before the gram at p, backwards, and those after it, as far as its windows reach."""
    reach = WINDOW - GRAM
    before = F.least(p, F.lit(reach))
    return F.reverse(F.slice(words, p - before + 1, before)), F.slice(words, p + GRAM + 1, F.lit(reach))


def _extended(hits: DataFrame) -> DataFrame:
    """hits (doc_id, text_key, p, own_before, own_after, place, before, after) as runs (doc_id, text_key, s, e, place) of ten words or more.

    p is where the document has a gram in common with a benchmark place, counted from 0; before and after are the words
    around the place, own_before and own_after those around p.
    """
    start = F.col("p") - _equal(F.col("own_before"), F.col("before"))
    end = F.col("p") + GRAM + _equal(F.col("own_after"), F.col("after"))
    runs = hits.select("doc_id", "text_key", start.alias("s"), end.alias("e"), "place")
    return runs.filter(F.col("e") - F.col("s") >= WINDOW)


def contamination(documents: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document row: doc_id, text_key, n_words, spans, items.

    spans: the document's words inside a benchmark window, as sorted structs (start, end), end
    excluded, overlapping windows merged. items: ids of the items with a window in the document.
    Null and empty texts have no words and no spans. Items without words match nothing; an item
    without an id marks words but adds no id. Repeated rows get a row each; texts of any length are
    taken whole; other columns of either table are ignored, whatever their names. Empty tables give no
    rows, or rows without spans.
    """
    key = F.col("doc_id"), text_hash(F.col("text")).alias("text_key")
    docs = documents.select(*key, words_of(F.col("text")).alias("words"))
    items = benchmark.select("item_id", words_of(F.col("text")).alias("item")).filter(F.size("item") > 0)
    items = written(items.withColumn("number", F.monotonically_increasing_id()), "items")
    prints = winnowed(items.filter(F.size("item") >= WINDOW).select("item_id", F.col("item").alias("words")))
    # The outer forms keep Spark from deriving a filter of the arrays, which would repeat how they are computed.
    prints = prints.select("item_id", "words", F.posexplode_outer("fp").alias("q", "fp")).filter("fp is not null")
    before, after = _around("words", F.col("q"))
    around = ["fp", "before", "after"]
    prints = prints.select("item_id", "fp", before.alias("before"), after.alias("after")).distinct()
    prints = written(prints.withColumn("place", F.xxhash64(*around)), "prints")
    places, of_place = prints.select("place", *around).distinct(), prints.select("place", "item_id")
    size = lambda words: F.aggregate(words, F.lit(0), lambda n, w: n + F.octet_length(w) + 24)
    short = items.filter(F.size("item") < WINDOW)
    nbytes = sum(x.first()[0] or 0 for x in (prints.agg(F.sum(size("before") + size("after") + 64)), short.agg(F.sum(size("item") + 64))))
    small, done = nbytes <= broadcast_bytes, [items, prints]

    # The text goes along with no fingerprint: the few documents that have a known one are looked at again.
    probes = winnowed(docs).select("doc_id", "text_key", F.posexplode_outer("fp").alias("p", "fp")).filter("fp is not null")
    within = F.broadcast if small else lambda df: df
    met = probes.join(within(places.select("fp").distinct()), "fp", "left_semi")
    met = written(met.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("p", "fp")).alias("at")), "met")
    done.append(met)
    few = (met.agg(F.sum(64 + 24 * F.size("at"))).first()[0] or 0) <= broadcast_bytes
    of_met = met.select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"), "at")
    again = documents.select(*key, "text").join(F.broadcast(of_met) if few else of_met, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_key") == F.col("__k")))
    again = again.select("doc_id", "text_key", "at", words_of(F.col("text")).alias("words"))

    def around_hit(x: Column) -> Column:
        own_before, own_after = _around("words", x["p"])
        return F.struct(x["p"].alias("p"), x["fp"].alias("fp"), own_before.alias("own_before"), own_after.alias("own_after"))

    hits = again.select("doc_id", "text_key", F.explode_outer(F.transform("at", around_hit)).alias("x")).filter("x is not null").select("doc_id", "text_key", "x.*")
    runs = _extended(hits.join(within(places), "fp"))

    # Shorter items are windows as they are.
    short = short.groupBy("item").agg(F.max("number").alias("number"))  # equal items are one place
    of_short = items.join(short.withColumnRenamed("number", "place"), "item").select("place", "item_id")
    short = short.select((-1 - F.col("number")).alias("place"), F.size("item").alias("n"), F.xxhash64("item").alias("fp"), "item")
    lengths = sorted(r["n"] for r in short.select("n").distinct().collect())  # nine at most
    if lengths:
        hashes = F.array(*[_short("words", n) for n in lengths])
        probes = docs.select("doc_id", "text_key", "words", F.posexplode_outer(hashes).alias("l", "fps"))
        probes = probes.withColumn("n", F.element_at(F.array(*[F.lit(n) for n in lengths]), F.col("l") + 1))
        probes = probes.select("doc_id", "text_key", "words", "n", F.posexplode_outer("fps").alias("s", "fp"))
        if small:
            found = probes.join(F.broadcast(short), ["n", "fp"]).filter(F.slice("words", F.col("s") + 1, F.col("n")) == F.col("item"))
        else:
            window = F.slice("words", F.col("s") + 1, F.col("n")).alias("window")
            done.append(written(short, "short"))
            found = probes.select("doc_id", "text_key", "n", "s", "fp", window).join(done[-1], ["n", "fp"]).filter("window = item")
        runs = runs.union(found.select("doc_id", "text_key", "s", (F.col("s") + F.col("n")).alias("e"), "place"))
        of_place = of_place.union(of_short.select(-1 - F.col("place"), "item_id"))

    runs = written(runs.distinct(), "runs")
    in_order = Window.partitionBy("doc_id", "text_key").orderBy("s", "e")
    merged = runs.select("doc_id", "text_key", "s", "e").distinct()
    merged = merged.withColumn("upto", F.max("e").over(in_order.rowsBetween(Window.unboundedPreceding, -1)))
    merged = merged.withColumn("span", F.count_if(F.col("upto").isNull() | (F.col("upto") < F.col("s"))).over(in_order))
    merged = merged.groupBy("doc_id", "text_key", "span").agg(F.min("s").alias("start"), F.max("e").alias("end"))
    merged = merged.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    ids = runs.select("doc_id", "text_key", "place").distinct().join(of_place, "place").groupBy("doc_id", "text_key").agg(F.collect_set("item_id").alias("items"))
    found = merged.join(ids.withColumnsRenamed({"doc_id": "d", "text_key": "k"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
    found = written(found.select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"), "spans", "items"), "contaminated")
    drop_written(runs, *done)
    all_docs = docs.select("doc_id", "text_key", F.size("words").alias("n_words"))
    out = all_docs.join(found, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_key") == F.col("__k")), "left")
    none = lambda c: F.array().cast(found.schema[c].dataType)
    return out.select("doc_id", "text_key", "n_words", *[F.coalesce(c, none(c)).alias(c) for c in ("spans", "items")])


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["start"]))
    ids = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0))),
dw AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
hit AS (SELECT r, n, i, item_id FROM dw JOIN bw USING (n, win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""
