"""Runs of words that repeat with a period, by a dictionary of basic factors.

The factors of a text are its stretches of 1, 2, 4, ... words; equal ones get the same number, that of a doubled
length from the numbers of its halves. Where a factor occurs again after at most its length, the
occurrences lie in an arithmetic progression, whose difference is proposed as a period; positions next to each
other with the same difference make up a run, which ends a factor and a period after the last of them. A run
with four periods shows up so at one length alone, the least power of two that is no shorter than its period.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import table

#: A run has this many words and periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Texts are numbered together up to this many bytes; a longer one is taken alone.
AT_ONCE = 1 << 22

SPACE = r"[\x20\x09-\x0D]+"


def _again(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For names by position, the next position with the same name (or -1), and whether another one has it at all."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    following = np.full(len(names), -1)
    following[order[:-1][same]] = order[1:][same]
    repeated = np.zeros(len(names), bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    return following, repeated


def runs_of(words: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """The runs of a sequence of word numbers as rows (start, length, period), by start and then period.

    Numbers must differ between texts that are given in one sequence. Only positions whose factor
    occurs again are carried on to the next length.
    """
    if least_periods < 4:
        raise ValueError("runs of fewer than four periods may show at no length")
    n, found = len(words), []
    at, names, length = np.arange(n), words, 1  # positions whose factor of this length occurs again, or may
    while len(at):
        following, repeated = _again(names)
        gap = np.where(following >= 0, at[following] - at, 0)
        hit = np.flatnonzero((gap > length // 2) & (gap <= length))
        if len(hit):
            cut = np.flatnonzero((np.diff(at[hit]) != 1) | (np.diff(gap[hit]) != 0)) + 1
            first, last = hit[np.r_[0, cut]], hit[np.r_[cut - 1, len(hit) - 1]]
            period = gap[first]
            found.append(np.column_stack([at[first], at[last] + period + length - at[first], period]))
        at, names = at[repeated], names[repeated]
        if not len(at):
            break
        # The factor that begins a length later; both halves have to occur again.
        half = np.searchsorted(at, at + length).clip(max=len(at) - 1)
        both = at[half] == at + length
        _, pair = np.unique(names[both] * (names.max() + 1) + names[half[both]], return_inverse=True)
        at, names, length = at[both], pair, 2 * length
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[runs[:, 1] >= np.maximum(least_words, least_periods * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def dropped_words(runs: np.ndarray, n: int) -> np.ndarray:
    """Marks the words of a run after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:n]) > 0


SCHEMA = "doc_id {}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(documents: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """Rows (doc_id, n_words, runs, collapsed) for rows (doc_id, text), a row each.

    Words are what stands between spaces, tabs and line ends. runs holds (start, length, period) of every stretch with the smallest
    period ``period`` that no neighbouring word extends and that has enough words and periods, by start and
    then period; collapsed the words that no run holds after its first period, joined by spaces. Null and
    empty texts have no words. Repeated rows and null ids get a row each; texts of any length are taken whole, one
    text's words being held in memory at a time if it is long; other columns are ignored, whatever their names;
    an empty table gives an empty result.
    """

    def found(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            size = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
            part = (np.cumsum(size) - size) // AT_ONCE
            cuts = np.flatnonzero(np.diff(part)) + 1
            for a, b in itertools.pairwise([0, *cuts.tolist(), len(size)]):
                if a < b:
                    yield of_part(ids.slice(a, b - a), texts.slice(a, b - a).to_pylist())

    def of_part(ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
        split = [(t or "").encode().split() for t in texts]  # of bytes: just the six ASCII spaces
        number, numbers, base = {}, [], 0
        for words in split:  # a text's numbers begin after those of the last, so that no factor reaches over its end
            number.clear()
            numbers.append(base + np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
            base += len(number)
        ends = np.cumsum([len(w) for w in split])
        runs = runs_of(np.concatenate(numbers) if numbers else np.zeros(0, np.int64), least_words, least_periods)
        upto = np.searchsorted(runs[:, 0], ends)
        collapsed, lists = [], []
        for words, end, a, b in zip(split, ends.tolist(), [0, *upto[:-1].tolist()], upto.tolist(), strict=True):
            own = runs[a:b] - [end - len(words), 0, 0]
            lists.append([{"start": s, "length": n, "period": p} for s, n, p in own.tolist()])
            if a < b:
                words = list(itertools.compress(words, (~dropped_words(own, len(words))).tolist()))
            collapsed.append(b" ".join(words).decode())
        of_run = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        return pa.RecordBatch.from_arrays([ids, pa.array([len(w) for w in split], pa.int64()), pa.array(lists, of_run), pa.array(collapsed)], ["doc_id", "n_words", "runs", "collapsed"])

    schema = SCHEMA.format(documents.schema["doc_id"].dataType.simpleString())
    return documents.select("doc_id", "text").mapInArrow(found, schema)


def with_periods(documents: DataFrame) -> DataFrame:
    """Documents whose crc32 of the id ends with 0: their words from a place on repeat the first of these (op12's contract)."""
    h, words = F.crc32(F.col("doc_id").cast("string").cast("binary")), F.array_remove(F.split("text", SPACE), "")
    rows = documents.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, F.pmod("g", n)).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = n - F.col("a")
    cycle = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), rest)), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    longest = F.reduce("runs", F.lit(None).cast("struct<start: long, length: long, period: long>"), lambda a, x: F.when(a.isNull() | (x["length"] > a["length"]), x).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda x: F.format_string("%d,%d,%d\n", x["start"], x["length"], x["period"])), "")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("r"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "r.*", F.floor(1000 * F.col("r.length") / F.col("r.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
    xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s % 2 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)) AS h
  FROM documents),
e AS (SELECT *, len(w) AS n, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM e),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM f),
t AS (
  SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE
    list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM p),
x AS (SELECT r, unnest(range(0, n)) AS i, unnest(w) AS word FROM t),
eq AS (
  SELECT a.r, a.i, b.i - a.i AS q FROM x AS a JOIN t USING (r) JOIN x AS b ON a.r = b.r AND a.word = b.word AND b.i > a.i
  WHERE 4 * (b.i - a.i) <= t.n),
isle AS (SELECT r, q, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k, i FROM eq),
stretch AS (SELECT r, q, min(i) AS s, count(*) + q AS l FROM isle GROUP BY r, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT r, s, l, min(q) AS q FROM stretch GROUP BY r, s, l),
told AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS told,
    list({'s': s, 'l': l, 'q': q} ORDER BY l DESC, s, q)[1] AS top FROM run GROUP BY r),
gone AS (SELECT r, list(DISTINCT i) AS gone FROM (SELECT r, unnest(range(s + q, s + l)) AS i FROM run) GROUP BY r),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM x LEFT JOIN gone USING (r) WHERE NOT coalesce(list_contains(gone, i), false) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.l AS length, top.q AS period, 1000 * top.l // top.q AS exponent_milli,
  sha256(coalesce(told, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN told USING (r) LEFT JOIN kept USING (r)
"""
