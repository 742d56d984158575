"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents fall into blocks by hash (as many a source as the shards ask for), the blocks of a source stand in a
permuted order, and a source is taken in whole passes plus a prefix of that order which is cut to
the word in one last block. The block copies are then dealt to output shards: the root holds all of
them, every node hands its left half an exact number of copies, drawn from its sources without
replacement, and a leaf's counts are the quota of each source in one shard. A shard takes the next
copies of the permuted order, so that shards are disjoint, and is shuffled locally.

The tree's top is split on the driver, down to TOP_NODES nodes at most; tasks split the rest, each node by
random numbers of its own. One row a source comes to the driver (MOST_SOURCES at most); blocks, documents
and shards stay on the executors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.llm.common import drop_written, table, text_hash, written

#: Blocks a source has at most (the more, the more shards), and rows a block has about.
BLOCKS, BLOCKS_PER_SHARD, BLOCK_ROWS, SEED = 1024, 16, 64, 20
SHARD_WORDS, LEAST_SHARDS = 50_000_000, 16
MOST_TIMES, TOP_NODES = 3, 64
#: Sources are planned on the driver: host names or other keys without a bound have to be grouped first.
MOST_SOURCES = 100_000
#: Block and choice tables are broadcast up to this many rows (of some 100 bytes).
BROADCAST_ROWS = 200_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def share(sizes: list[int], weights: list[float], total: float, most: float = MOST_TIMES) -> list[float]:
    """Shares of total by weight, none above ``most`` times its size: the excess goes to the others by weight.

    Those with the least size for their weight reach the bound first; once one doesn't, none after it does.
    """
    order = sorted(range(len(sizes)), key=lambda i: sizes[i] / weights[i] if weights[i] else math.inf)
    target, left, weight = [0.0] * len(sizes), total, sum(weights)
    for at, i in enumerate(order):
        if not weight or left * weights[i] / weight <= most * sizes[i]:
            for k in order[at:]:
                target[k] = left * weights[k] / weight if weight else 0.0
            break
        target[i] = float(most * sizes[i])
        left, weight = left - target[i], weight - weights[i]
    return target


def _halves(have: np.ndarray, first: int, n: int, seed: int) -> list[tuple[np.ndarray, int, int]]:
    """The two children of the node that has these copies for shards first to first + n - 1."""
    rng = np.random.default_rng([seed, first, n])
    half = n // 2
    left = rng.multivariate_hypergeometric(have, int(have.sum()) * half // n, method="marginals") if len(have) else have
    return [(left, first, half), (have - left, first + half, n - half)]


def split_quotas(counts: list[int], shards: int, seed: int = SEED, first: int = 0) -> np.ndarray:
    """counts[s] block copies of each source over shards: an array (source, shard) with exact row sums."""
    out = np.zeros((len(counts), shards), dtype=np.int64)
    nodes = [(np.asarray(counts, dtype=np.int64), first, shards)]
    while nodes:
        have, at, n = nodes.pop()
        if n == 1:
            out[:, at - first] = have
        else:
            nodes += _halves(have, at, n, seed)
    return out


def shard_quotas(spark, counts: list[int], shards: int, seed: int = SEED) -> DataFrame:
    """Rows (sid, shard, begin, n): the n copies of a source, from begin on, that a shard gets. As ``split_quotas``."""
    top = [(np.asarray(counts, dtype=np.int64), 0, shards)]
    while len(top) < TOP_NODES and any(n > 1 for _, _, n in top):
        top = [x for node in top for x in (_halves(*node, seed) if node[2] > 1 else [node])]
    begins = np.cumsum([have for have, _, _ in top], axis=0) - np.array([have for have, _, _ in top])
    rows = [(first, n, have.tolist(), begin.tolist()) for (have, first, n), begin in zip(top, begins)]

    def split(batches):
        for batch in batches:
            for first, n, have, begin in zip(*(batch.column(c).to_pylist() for c in ("first", "n", "have", "begin"))):
                q = split_quotas(have, n, seed, first)
                at = np.array(begin, np.int64)[:, None] + np.cumsum(q, axis=1) - q
                sid, shard = np.nonzero(q)
                columns = [sid.astype(np.int32), (shard + first).astype(np.int32), at[sid, shard], q[sid, shard]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["sid", "shard", "begin", "n"])

    nodes = spark.createDataFrame(rows, "first int, n int, have array<long>, begin array<long>").repartition(len(rows), "first")
    return nodes.mapInArrow(split, "sid int, shard int, begin long, n long")


def ranked(blocks: DataFrame, seed: int) -> DataFrame:
    """blocks (sid, block, words, ...) with rank and upto (words so far) in the permuted order of each source.

    The order is by ranges, so that a source with very many blocks fills many tasks: places inside a
    range come from a window over it, what ranges before it hold from sums over all.
    """
    blocks = blocks.withColumn("at", F.xxhash64("sid", "block", F.lit(seed)))
    blocks = blocks.repartitionByRange("sid", "at", "block").sortWithinPartitions("sid", "at", "block")
    blocks = written(blocks.withColumn("range", F.spark_partition_id()), "ranges")
    of_range = blocks.groupBy("sid", "range").agg(F.count("*").alias("c"), F.sum("words").alias("w"))
    before = Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    of_range = of_range.select("sid", "range", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}_before") for x in ("c", "w")])
    inside = Window.partitionBy("sid", "range").orderBy("at", "block")
    upto = F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    found = blocks.withColumns({"rank": F.row_number().over(inside) - 1, "upto": upto}).join(of_range, ["sid", "range"])
    found = found.withColumns({"rank": F.col("rank") + F.col("c_before"), "upto": F.col("upto") + F.col("w_before")})
    return found.drop("at", "range", "c_before", "w_before")


def _some(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def mix(documents: DataFrame, weights: dict | None = None, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The input's rows and columns with size, source_size, target, taken (words) and shards.

    shards: how many, by default one for 50 million words. weights: by source; otherwise the sources in code point order, null last, weigh 1, 2, 3, 1, ...
    ``shards`` lists a shard number for each copy that the mix takes of a row, so a row may be taken
    0 to 3 times; ``in_shards`` lays the copies out. A null or empty text has size 0 and is not
    taken. A null source is a source like others. Rows that repeat a doc_id and text of a source
    are taken alike. Blocks and rows with equal hashes stand in the order of their numbers. Texts of any length
    are taken whole. Input columns with one of the five names are replaced, others kept. Reruns agree, whatever
    the partitions. An empty table gives an empty result; more than MOST_SOURCES sources are an error.
    """
    new = ("size", "source_size", "target", "taken", "shards")
    docs = documents.drop(*new).withColumns(
        {"__key": text_hash(F.col("text")), "size": word_count(F.col("text"))}
    )
    slim = written(docs.select("doc_id", "__key", "source", "size"), "sizes")
    found = slim.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; group them first")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    given = [float(weights[r["source"]]) if weights else 1.0 + i % 3 for i, r in enumerate(found)]
    shards = shards or max(LEAST_SHARDS, -(-sum(r["size"] for r in found) // SHARD_WORDS))
    most = max(BLOCKS, BLOCKS_PER_SHARD * shards)
    targets = share([r["size"] for r in found], given, float(sum(r["size"] for r in found)))
    plan = []
    for i, (r, t) in enumerate(zip(found, targets)):
        passes = min(MOST_TIMES, int(t // r["size"])) if r["size"] else 0
        plan.append((r["source"], i, min(most, -(-r["n"] // BLOCK_ROWS)), r["size"], t, passes, t - passes * r["size"]))
    spark = documents.sparkSession
    plan = _some(
        spark.createDataFrame(
            plan, "s string, sid int, n_blocks int, source_size long, target double, passes int, rest double"
        ),
        len(plan),
    )

    def placed(df: DataFrame) -> DataFrame:
        """With the plan of the row's source and the row's block."""
        df = df.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        return df.withColumn("block", F.pmod(F.xxhash64("doc_id", "__key", F.lit(seed)), F.col("n_blocks")))

    blocks = ranked(placed(slim).groupBy("sid", "block", "passes", "rest").agg(F.sum("size").alias("words")), seed)
    blocks = written(
        blocks.withColumn("whole", F.col("upto") <= F.col("rest"))
        .withColumn("cut", ~F.col("whole") & (F.col("upto") - F.col("words") < F.col("rest")))
        .withColumn("need", F.col("rest") - (F.col("upto") - F.col("words"))),
        "blocks",
    )
    counts = (
        blocks.groupBy("sid")
        .agg(F.count("*").alias("n"), F.max("passes").alias("passes"), F.count_if(F.col("whole") | F.col("cut")).alias("m"))
        .orderBy("sid")
        .collect()
    )
    of_sid = {r["sid"]: r for r in counts}
    copies = [of_sid[i]["passes"] * of_sid[i]["n"] + of_sid[i]["m"] if i in of_sid else 0 for i in range(len(found))]
    # Copy number k of a source is that of the block with rank k modulo its number of blocks: as many rows as copies.
    quotas = shard_quotas(spark, copies, shards, seed)
    quotas = quotas.select("sid", "shard", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("n") - 1)).alias("copy"))
    many = _some(spark.createDataFrame([(r["sid"], r["n"]) for r in counts], "sid int, n_of_source long"), len(counts))
    quotas = quotas.join(many, "sid").withColumns({"rank": F.col("copy") % F.col("n_of_source"), "pass": F.floor(F.col("copy") / F.col("n_of_source"))})
    own = quotas.groupBy("sid", "rank").agg(F.transform(F.sort_array(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"]).alias("own"))
    dealt = blocks.join(own, ["sid", "rank"], "left").select("sid", "block", "whole", "cut", F.coalesce("own", F.array().cast("array<int>")).alias("own"))

    # In the block where a source's last pass ends: rows in hashed order while they fit, then what still fits the rest.
    units = (
        placed(slim)
        .join(F.broadcast(blocks.filter("cut").select("sid", "block", "need")), ["sid", "block"])
        .groupBy("sid", "need", "doc_id", "__key")
        .agg(F.sum("size").alias("unit"))
    )
    running = Window.partitionBy("sid").orderBy(F.xxhash64("doc_id", "__key", F.lit(seed + 1)), "doc_id", "__key")
    running = running.rowsBetween(Window.unboundedPreceding, 0)
    units = units.withColumn("upto", F.sum("unit").over(running)).withColumn("first", F.col("upto") <= F.col("need"))
    whole = Window.partitionBy("sid")
    units = units.withColumn("left", F.col("need") - F.coalesce(F.max(F.when(F.col("first"), F.col("upto"))).over(whole), F.lit(0)))
    fits = ~F.col("first") & (F.col("unit") <= F.col("left"))
    units = units.withColumn("again", F.sum(F.when(fits, F.col("unit")).otherwise(0)).over(running))
    chosen = written(
        units.filter(F.col("first") | (fits & (F.col("again") <= F.col("left")))).select(
            F.col("sid").alias("__s"), F.col("doc_id").alias("__d"), F.col("__key").alias("__k"), F.lit(True).alias("chosen")
        ),
        "chosen",
    )
    out = (
        placed(docs)
        .join(_some(dealt, blocks.count()), ["sid", "block"])
        .join(
            _some(chosen, chosen.count()),
            (F.col("sid") == F.col("__s")) & F.col("doc_id").eqNullSafe(F.col("__d")) & F.col("__key").eqNullSafe(F.col("__k")),
            "left",
        )
    )
    drop_written(slim)
    extra = F.col("whole") | (F.col("cut") & F.coalesce("chosen", F.lit(False)))
    copies = F.when(F.col("size") > 0, F.col("passes") + extra.cast("int")).otherwise(0)
    return out.select(
        *[c for c in documents.columns if c not in new],
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).alias("taken"),
        F.slice("own", F.lit(1), copies).alias("shards"),
    )


def in_shards(mixed: DataFrame, seed: int = SEED) -> DataFrame:
    """One row for each copy, with its shard; each shard in one partition, in a random order of its own."""
    rows = mixed.withColumn("shard", F.explode("shards")).drop("shards")
    order = F.xxhash64("shard", "doc_id", "text", F.lit(seed))
    return rows.repartition("shard").sortWithinPartitions("shard", order)


def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(documents).select("doc_id", "size", "source_size", "target", "taken", "shards")
