"""Ranked lexical search by branch and bound over trees of documents.

Of each document only the terms that some item asks for are kept, the most frequent first, so that
documents share beginnings. A task sorts its documents so and makes the shared beginnings the nodes of a
tree, in which paths without a branch are one node and small neighbours are one leaf. A node knows the
largest tf of each term below it and the smallest m; an item's score with these is more than no document's there. The search
for an item goes depth-first and leaves out what is under the bound of the best so far; what remains of all
tasks is merged.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from partflow.llm.common import drop_written, shuffles, table, written

TOP = 20
#: Items are searched for in blocks of about so many bytes of their texts (their terms go to all tasks).
ITEM_BYTES = 4 << 20
#: Documents of a tree, and of a leaf at most.
TREE, LEAF = 16_384, 64
#: The best leaves that a search begins with.
FIRST = 4
#: Parts in which a first merge takes the tasks' results.
PARTS = 64

#: Bytes of terms: letters, of which A-Z become small, digits and all beyond ASCII. The others are spaces.
BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def gain(tf, m):
    """A term's share of the score for a weight of one; grows with tf and falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def restricted(documents: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of each document: how many terms it has, and of those with a number which and how often."""
    number = documents.sparkSession.sparkContext.broadcast(number)

    def vectors(batches):
        known = number.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                n, ends, terms, tfs = [], [0], [], []
                for text in part.column("text").to_pylist():
                    words = terms_of(text)
                    n.append(len(words))
                    for word, tf in Counter(words).items():
                        if (k := known.get(word)) is not None:
                            terms.append(k)
                            tfs.append(tf)
                    ends.append(len(terms))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(vectors, f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


def _largest(node: np.ndarray, term: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest tf of each node and term."""
    order = np.lexsort((term, node))
    node, term, tf = node[order], term[order], tf[order]
    first = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (term[1:] != term[:-1])][: len(node)])
    return node[first], term[first], np.maximum.reduceat(tf, first) if len(first) else tf


class Tree:
    """Documents as (terms, tfs, m), terms being ranks with the most frequent term first. Each document has one at least."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray, n_terms: int, leaf: int = LEAF):
        row = np.repeat(np.arange(len(m)), np.diff(starts))
        order = np.lexsort((terms, row))
        big, lists = terms[order].astype(">u4").tobytes(), starts.tolist()
        paths = [big[4 * a : 4 * b] for a, b in itertools.pairwise(lists)]
        self.docs = np.array(sorted(range(len(m)), key=paths.__getitem__), np.int64)
        paths = [paths[k] for k in self.docs]
        size = np.diff(starts)[self.docs]
        self.starts = np.r_[0, np.cumsum(size)]
        entries = order[np.repeat(starts[self.docs] - self.starts[:-1], size) + np.arange(self.starts[-1])]
        self.terms, self.tfs, self.m = terms[entries].astype(np.int64), tfs[entries].astype(np.int64), m[self.docs]
        self._branch(np.array([self._shared(a, b) for a, b in itertools.pairwise(paths)], np.int64), leaf)
        self._bounds(n_terms)

    @staticmethod
    def _shared(a: bytes, b: bytes) -> int:
        """How many terms two paths begin with in common."""
        if a == b:
            return len(a) // 4
        n = min(len(a), len(b))
        differ = np.flatnonzero(np.frombuffer(a, ">u4", n // 4) != np.frombuffer(b, ">u4", n // 4))
        return int(differ[0]) if len(differ) else n // 4

    def _branch(self, shared: np.ndarray, leaf: int) -> None:
        """Nodes in the order of a depth-first walk: from, to (documents), parent, level, skip (the next node that isn't below) and leaf."""
        nodes, todo = [], [(0, len(self.m), -1, 0)]
        while todo:
            a, b, parent, level = todo.pop()
            k = len(nodes)
            nodes.append((a, b, parent, level, b - a <= leaf))
            if b - a <= leaf:
                continue
            inner = shared[a : b - 1]
            cuts = [a, *(a + 1 + np.flatnonzero(inner == inner.min())).tolist(), b]
            parts, begun = [], a
            for x, y in itertools.pairwise(cuts):  # small neighbours are one leaf
                if y - x > leaf or y - begun > leaf:
                    if x > begun:
                        parts.append((begun, x))
                    begun = x
                if y - x > leaf:
                    parts.append((x, y))
                    begun = y
            if begun < b:
                parts.append((begun, b))
            todo += [(x, y, k, level + 1) for x, y in reversed(parts)]
        self.a, self.b, self.parent, self.level, self.leaf = (np.array(x) for x in zip(*nodes, strict=True))
        skip = np.arange(1, len(nodes) + 1)
        for k in range(len(nodes) - 1, 0, -1):
            skip[self.parent[k]] = max(skip[self.parent[k]], skip[k])
        self.skip, self.is_leaf = skip.tolist(), self.leaf.tolist()

    def _bounds(self, n_terms: int) -> None:
        """For each term the nodes that have it below them with its largest tf, and for each node the smallest m."""
        leaves = np.flatnonzero(self.leaf)
        self.least_m = np.full(len(self.a), np.iinfo(np.int64).max)
        self.least_m[leaves] = np.minimum.reduceat(self.m, self.a[leaves])
        of_doc = np.repeat(leaves, self.b[leaves] - self.a[leaves])
        own = _largest(np.repeat(of_doc, np.diff(self.starts)), self.terms, self.tfs)
        own_level, all_of = self.level[own[0]], []
        below = tuple(np.zeros(0, np.int64) for _ in range(3))
        for level in range(int(self.level.max()), -1, -1):
            here = tuple(np.concatenate([x[own_level == level], y]) for x, y in zip(own, below, strict=True))
            all_of.append(here)
            if level:
                below = _largest(self.parent[here[0]], here[1], here[2])
                at = np.flatnonzero(self.level == level)
                np.minimum.at(self.least_m, self.parent[at], self.least_m[at])
        node, term, tf = (np.concatenate([x[c] for x in all_of]) for c in range(3))
        order = np.argsort(term, kind="stable")
        self.node, self.most = node[order], tf[order]
        self.of_term = np.searchsorted(term[order], np.arange(n_terms + 1))

    def bound(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each node a score that no document below it exceeds."""
        out = np.zeros(len(self.a), np.int64)
        for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
            at = slice(self.of_term[t], self.of_term[t + 1])
            nodes = self.node[at]
            out[nodes] += w * gain(self.most[at], self.least_m[nodes])
        return out

    def scores(self, k: int, dense: np.ndarray) -> np.ndarray:
        """The scores of leaf k's documents, dense having the weights of all terms."""
        a, b = self.a[k], self.b[k]
        first, last = self.starts[a], self.starts[b]
        w, tf = dense[self.terms[first:last]], self.tfs[first:last]
        m = np.repeat(self.m[a:b], np.diff(self.starts[a : b + 1]))
        return np.add.reduceat(w * gain(tf, m), self.starts[a:b] - first)

    def search(self, terms: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: list, top: int, key) -> tuple[list, int]:
        """best, sorted (-score, key of the document, ...), with the documents of this tree; and how many leaves were scored."""
        bounds = self.bound(terms, weights)
        dense[terms] = weights
        leaves = np.flatnonzero(self.leaf)
        first = leaves[np.argsort(-bounds[leaves], kind="stable")[:FIRST]].tolist()
        done, bounds, scored = set(), bounds.tolist(), 0

        def least(best: list) -> int:
            return -best[-1][0] if len(best) >= top else 1

        def look(k: int, best: list) -> list:
            found = self.scores(k, dense)
            good = np.flatnonzero(found >= least(best))
            if not len(good):
                return best
            return sorted(best + [(-int(found[x]), *key(self.docs[self.a[k] + x])) for x in good.tolist()])[:top]

        for k in first:
            if bounds[k] >= least(best):
                best, scored = look(k, best), scored + 1
            done.add(k)
        k, end = 0, len(bounds)
        while k < end:
            if bounds[k] < least(best):
                k = self.skip[k]
                continue
            if self.is_leaf[k] and k not in done:
                best, scored = look(k, best), scored + 1
            k += 1
        dense[terms] = 0
        return best, scored


def _searched(vectors: DataFrame, items: list, weights: np.ndarray, n_docs: int, n_terms_all: int, top: int, tree: int, id_type) -> DataFrame:
    """(item, item_id, doc_id, score): each task's best documents for each item. items: (number, item_id, term numbers, their counts)."""
    rank = np.empty(len(weights), np.int64)
    rank[np.argsort(weights, kind="stable")] = np.arange(len(weights))  # a smaller weight is a larger df
    items = [(k, i, rank[t], weights[t] * c) for k, i, t, c in items]
    shared = vectors.sparkSession.sparkContext.broadcast((items, rank))
    doc_type = vectors.schema["doc_id"].dataType.simpleString()

    def search(batches):
        items, rank = shared.value
        dense, best = np.zeros(len(rank), np.int64), [[] for _ in items]

        def block(rows: pa.Table) -> None:
            ids = rows.column("doc_id").to_pylist()
            n = rows.column("n").to_numpy()
            m = np.array([75 + 25 * x * n_docs // n_terms_all for x in n.tolist()], np.int64)
            terms, tfs = (rows.column(c).combine_chunks() for c in ("terms", "tfs"))
            terms = pa.concat_arrays(terms.chunks) if isinstance(terms, pa.ChunkedArray) else terms
            tfs = pa.concat_arrays(tfs.chunks) if isinstance(tfs, pa.ChunkedArray) else tfs
            starts = terms.offsets.to_numpy().astype(np.int64)
            of_block = Tree(starts - starts[0], rank[terms.flatten().to_numpy()], tfs.flatten().to_numpy().astype(np.int64), m, len(rank))
            key = lambda x: (ids[x] is None, ids[x] if ids[x] is not None else 0)
            for k, (_, _, terms_of_item, w) in enumerate(items):
                best[k], _ = of_block.search(terms_of_item, w, dense, best[k], top, key)

        held = []
        for batch in batches:
            for at in range(0, batch.num_rows, tree):
                held.append(batch.slice(at, tree))
                if sum(len(x) for x in held) >= tree:
                    block(pa.Table.from_batches(held))
                    held = []
        if sum(len(x) for x in held):
            block(pa.Table.from_batches(held))
        rows = [(number, item_id, None if x[1] else x[2], -x[0]) for (number, item_id, _, _), found in zip(items, best, strict=True) for x in found]
        for at in range(0, len(rows), 10_000):
            columns = list(zip(*rows[at : at + 10_000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[c], kinds[c]) for c in range(4)], names)

    names = ["item", "item_id", "doc_id", "score"]
    kinds = [pa.int64(), to_arrow_type(id_type), to_arrow_type(vectors.schema["doc_id"].dataType), pa.int64()]
    return vectors.select("doc_id", "n", "terms", "tfs").mapInArrow(search, f"item long, item_id {id_type.simpleString()}, doc_id {doc_type}, score long")


def ranked(documents: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES, tree: int = TREE) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the top documents with a score above 0 for each row of items, all if fewer.

    documents: doc_id, text; items: item_id, text. Equal scores go by doc_id, a null one last. A null
    text has no term; an item without terms has no rows, a document without terms isn't counted. Items that repeat, and
    documents that do, get rows each. Texts are taken whole, one at a time; other columns are ignored, whatever their
    names; empty tables give an empty result. Each block of items, by the size of their texts, is a pass over the documents.
    """
    items = written(items.select("item_id", "text", F.monotonically_increasing_id().alias("item")), "items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-size // item_bytes)
    out = []
    for k in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == k)
        number, asked = {}, []
        for row in block.orderBy("item").toLocalIterator():  # some item_bytes
            counts = Counter(number.setdefault(t, len(number)) for t in terms_of(row["text"]))
            if counts:
                asked.append((row["item"], row["item_id"], np.array(list(counts)), np.array(list(counts.values()))))
        if not asked:
            continue
        vectors = written(restricted(documents, number), "vectors")
        n_docs, n_all = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            drop_written(vectors)
            continue
        df = np.zeros(len(number), np.int64)
        for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():  # the items' terms at most
            df[row["t"]] = row["count"]
        weights = np.array([weight(n_docs, x) for x in df.tolist()], np.int64)
        # Few bytes make much work: the session's number of partitions, in turn.
        some = vectors.filter(F.size("terms") > 0).repartition(shuffles(vectors.sparkSession))
        found = _searched(some, asked, weights, n_docs, n_all, top, tree, items.schema["item_id"].dataType)
        out.append(written(_best(found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS))), ["item", "part"], top).drop("part", "rank"), "best"))
        drop_written(vectors)
    if not out:
        doc_id = documents.schema["doc_id"].dataType
        none = items.filter("false").select("item", "item_id", F.lit(None).cast(doc_id).alias("doc_id"), F.lit(0).cast("long").alias("score"))
        out = [none]
    both = out[0]
    for more in out[1:]:
        both = both.unionByName(more)
    return _best(both, ["item"], top).select("item_id", "rank", "doc_id", "score")


def _best(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT row_number() OVER () AS k, item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
s AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_all FROM d),
q AS (SELECT k, term, count(*) AS c FROM (SELECT k, unnest(w) AS term FROM b) GROUP BY k, term),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 75 + (25 * len(w) * n_docs) // n_all AS m FROM d, s WHERE len(w) > 0),
scored AS (
  SELECT k, doc_id, r, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY k, doc_id, r HAVING score > 0),
best AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id) AS rank FROM scored)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM best JOIN b USING (k) WHERE rank <= 20
"""
