"""Near-duplicate vectors by lattice hashing.

A table projects the unit vectors on 16 random directions and decodes the two halves to points of the
lattice E8, the densest in eight dimensions. A vector is entered in its own cell and in the neighbouring
cells that it is nearest to (a cell is a pair of lattice points); vectors that meet in a cell of some table
are compared by cosine. Equal vectors are one node with a count; a pair counts in one of the cells that
it shares, so links are counted and never listed.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import components, drop_written, shuffles, table, written

COSINE = 0.98
#: Tables, and the cells of each that a vector is entered in. As measured, a pair at the least cosine is missed by
#: a table with about 0.07 and by all with 0.00003; one at 0.985 with 0.0000007.
TABLES, PROBES = 4, 12
#: Scale of the lattice in distances of vectors at the least cosine.
CELL = 5.6
SEED = 20_011
#: Vectors that a task compares with as many; a fuller cell is dealt out in blocks.
BLOCK = 2048
#: Cells with fewer vectors than this are compared together, pair by pair; the rest by products of matrices.
FEW = 48


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of one, or eight of a half with an even number of minus signs."""
    whole = [[a if k == i else b if k == j else 0 for k in range(8)] for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    half = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(whole + half, dtype=float)


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The lattice point nearest to each row: the better one of D8 (whole numbers, even sum) and D8 moved by a half."""

    def d8(x: np.ndarray) -> np.ndarray:
        found = np.rint(x)
        odd = np.flatnonzero(found.sum(axis=1) % 2)
        gap = x[odd] - found[odd]
        worst = np.abs(gap).argmax(axis=1)
        found[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1, -1)
        return found

    a, b = d8(y), d8(y - 0.5) + 0.5
    return np.where(((y - a) ** 2).sum(axis=1, keepdims=True) <= ((y - b) ** 2).sum(axis=1, keepdims=True), a, b)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers, well mixed (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Lattice:
    """The tables for vectors of any dimension."""

    def __init__(self, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, seed: int = SEED):
        self.tables, self.probes, self.seed = tables, probes, seed
        self.scale, self.roots, self.maps = CELL * (2 - 2 * cosine) ** 0.5, _roots(), {}
        self.odd = np.random.default_rng(seed).integers(0, 2**63, size=(2, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def _near(self, y: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The probes' nearest lattice points to each row as numbers, and how much farther than the first they are."""
        home, k = nearest_e8(y), min(self.probes - 1, len(self.roots))
        rows = np.arange(len(y))[:, None]
        farther = 2 - 2 * (y - home) @ self.roots.T  # squared distances to the neighbours, less that to home
        best = np.argpartition(farther, k - 1, axis=1)[:, :k] if k else np.zeros((len(y), 0), int)
        number = lambda points: (2 * points).astype(np.int64).view(np.uint64) @ odd
        points = np.concatenate([number(home)[:, None], number(home)[:, None] + number(self.roots)[best]], axis=1)
        return points, np.concatenate([np.zeros((len(y), 1)), farther[rows, best]], axis=1)

    def cells(self, unit: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """rows x tables x probes: the cells of unit vectors as 64-bit numbers, apart by salt and table."""
        d = unit.shape[1]
        if d not in self.maps:
            self.maps[d] = np.random.default_rng((self.seed, d)).standard_normal((self.tables, d, 16)) / self.scale
        out = np.empty((len(unit), self.tables, self.probes), np.int64)
        for t in range(self.tables):
            y = unit @ self.maps[d][t]
            (a, far_a), (b, far_b) = self._near(y[:, :8], self.odd[0]), self._near(y[:, 8:], self.odd[1])
            far = (far_a[:, :, None] + far_b[:, None, :]).reshape(len(y), -1)
            pairs = (_mixed(a)[:, :, None] + b[:, None, :]).reshape(len(y), -1)
            best = np.argpartition(far, self.probes - 1, axis=1)[:, : self.probes]
            own = _mixed(salt.view(np.uint64) + np.uint64(t + 1))
            out[:, t] = _mixed(pairs[np.arange(len(y))[:, None], best] ^ own[:, None]).view(np.int64)
        return out


def _unit(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, their unit vectors) for each length of list; of the vectors none is null or zero."""
    n = np.diff(column.offsets.to_numpy())
    values, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()[:-1]
    out = []
    for d in np.unique(n).tolist():
        rows = np.flatnonzero(n == d)
        x = values[starts[rows][:, None] + np.arange(d)].astype(float)
        x /= np.abs(x).max(axis=1, keepdims=True)  # no square of it is too large or too small for a double
        out.append((rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))))
    return out


def _entered(nodes: DataFrame, lattice: Lattice) -> DataFrame:
    """(node, cell) for each cell that a node is entered in."""

    def cells(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                node, salt = part.column("node").to_numpy(), part.column("salt").to_numpy()
                for rows, unit in _unit(pa.concat_arrays([part.column("vec")])):
                    found = lattice.cells(unit, salt[rows]).reshape(len(rows), -1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(node[rows], found.shape[1])), pa.array(found.ravel())], ["node", "cell"])

    return nodes.select("node", "salt", "vec").mapInArrow(cells, "node long, cell long")


def _pairs_of(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within groups of rows that follow each other."""
    after = np.repeat(sizes, sizes) - 1 - (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    first = np.repeat(starts, sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    x = np.repeat(first, after)
    return x, x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(after) - after, after)


def _linked(unit: np.ndarray, groups: list[tuple[int, int, np.ndarray | None]], cosine: float):
    """Batches of pairs of rows with the cosine. groups: (start, end, side); rows of different sides meet, or all if it is None."""
    few = [g for g in groups if g[2] is None and g[1] - g[0] <= FEW]
    if few:
        x, y = _pairs_of(np.array([g[0] for g in few]), np.array([g[1] - g[0] for g in few]))
        for at in range(0, len(x), 20_000):
            i, j = x[at : at + 20_000], y[at : at + 20_000]
            ok = (unit[i] * unit[j]).sum(axis=1) >= cosine
            yield i[ok], j[ok]
    for start, end, side in (g for g in groups if g[2] is not None or g[1] - g[0] > FEW):
        left, right = (np.arange(start, end),) * 2 if side is None else (start + np.flatnonzero(side == 0), start + np.flatnonzero(side == 1))
        for at in range(0, len(left), 512):
            i, j = np.nonzero(unit[left[at : at + 512]] @ unit[right].T >= cosine)
            i, j = left[at : at + 512][i], right[j]
            ahead = i < j if side is None else np.ones(len(i), bool)
            i, j = i[ahead], j[ahead]
            for cut in range(0, len(i), 20_000):
                yield i[cut : cut + 20_000], j[cut : cut + 20_000]


def _links(rows: DataFrame, lattice: Lattice, cosine: float) -> DataFrame:
    """(node, links, root): how many vectors node is linked with, as far as a cell counts them, and a node that these links reach.

    rows: node, cell, i, j, own, salt, copies, vec, those of a (cell, i, j) together. Block i of the cell is
    compared with block j. A pair counts in the smallest of the cells that both are entered in.
    """

    def of_salt(part: pa.Table, rows: np.ndarray, unit: np.ndarray):
        cell, i, j, own, salt, node, copies = (part.column(c).to_numpy()[rows] for c in ("cell", "i", "j", "own", "salt", "node", "copies"))
        cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in (cell, i, j, salt)], axis=0)) + 1 if len(rows) > 1 else []
        ends = [0, *cuts, len(rows)]
        groups = [(a, b, None if i[a] == j[a] else (own[a:b] == j[a]).astype(int)) for a, b in itertools.pairwise(ends) if b - a > 1]
        root, links = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        for x, y in _linked(unit, groups, cosine):
            if not len(x):
                continue
            used, at = np.unique(np.concatenate([x, y]), return_inverse=True)
            entered = lattice.cells(unit[used], salt[used])
            a, b, first = entered[at[: len(x)]], entered[at[len(x) :]], np.ones(len(x), bool)
            for k in range(lattice.probes):
                first &= ~((a == b[:, :, k : k + 1]) & (a < cell[x][:, None, None])).any(axis=(1, 2))
            x, y = x[first], y[first]
            links += np.bincount(x, copies[y], len(rows)).astype(np.int64) + np.bincount(y, copies[x], len(rows)).astype(np.int64)
            while True:  # the pairs' rows take the smallest row that they reach
                low = np.minimum(root[x], root[y])
                if (root[x] == low).all() and (root[y] == low).all():
                    break
                for side in (x, y):
                    np.minimum.at(root, root[side], low)
                    np.minimum.at(root, side, low)
                root = root[root]
        some = np.flatnonzero(links)
        return node[some], links[some], node[root[some]]

    def found(batches):
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            if held is None or not len(held):
                continue
            end = len(held)
            if batch is not None:  # the last group may go on
                keys = [held.column(c).to_numpy() for c in ("cell", "i", "j")]
                end = int(np.flatnonzero(np.all([k == k[-1] for k in keys], axis=0))[0])
            part, held = held.slice(0, end).combine_chunks(), held.slice(end)
            if not len(part):
                continue
            for rows, unit in _unit(part.column("vec").combine_chunks() if part.column("vec").num_chunks != 1 else pa.concat_arrays([part.column("vec").chunk(0)])):
                columns = of_salt(part, rows, unit)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "links", "root"])

    return rows.mapInArrow(found, "node long, links long, root long")


def linked_vectors(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for rows (vec_id, embedding, label), a row each.

    Two rows are linked if their labels are equal, their vectors equally long and the cosine, in doubles, is at least
    the given one. n_links counts the other rows that a row is linked with, component_id is the smallest vec_id
    that links reach, kept marks the rows that have it. A null label, a vector that is null, empty or zero, and
    one with components that are null or not finite link with nothing, and so are their own component. Rows that repeat are
    linked with each other; of vec_ids in a component nulls are ignored (a component without others has a null one). Vectors are
    taken as equal if 128 bits of hash are. Other columns are ignored, whatever their names; an empty table
    gives an empty result.
    """
    lattice = Lattice(cosine, tables, probes)
    vec = F.col("embedding")
    fine = vec.isNotNull() & F.col("label").isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    key = F.when(F.coalesce(fine, F.lit(False)), F.struct(F.xxhash64("label", vec).alias("a"), F.xxhash64(F.lit(SEED), vec, "label").alias("b")))
    rows = vectors.select("vec_id", "label", "embedding", key.alias("key"))
    ids = written(rows.select("vec_id", "key"), "ids")
    nodes = rows.filter("key is not null").groupBy("key").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first(F.struct(F.xxhash64("label", F.size(vec)).alias("salt"), vec.alias("vec"))).alias("of")
    )
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "key", "copies", "least", "of.*"), "nodes")

    entered = _entered(nodes, lattice)
    shared = written(entered.groupBy("cell").agg(F.count("*").alias("c")).filter("c > 1"), "shared")
    met = written(entered.join(shared, "cell"), "met")
    blocks = F.ceil(F.col("c") / block).cast("int")
    met = met.select("cell", "node", blocks.alias("blocks"), F.pmod(F.xxhash64("node", "cell"), blocks).cast("int").alias("own"))
    with_each = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    met = met.select("cell", "node", "own", F.explode(with_each).alias("k")).select("cell", "node", "own", "k.*")
    met = met.join(nodes.select("node", "salt", "copies", "vec"), "node")
    met = met.repartition(shuffles(met.sparkSession), "cell", "i", "j").sortWithinPartitions("cell", "i", "j", "salt")
    found = written(_links(met, lattice, cosine), "found")

    reached = components(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    of_node = nodes.select("node", "key", "copies", "least").join(links, "node", "left").join(reached, "node", "left")
    of_node = of_node.select("key", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("group"))
    of_node = written(of_node, "grouped")
    drop_written(shared, met, found, reached, nodes)
    smallest = of_node.groupBy("group").agg(F.min("least").alias("component_id"))
    of_node = of_node.join(smallest, "group").select("key", "n_links", "component_id", F.lit(True).alias("known"))
    out = ids.join(of_node, "key", "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op13_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (
  SELECT r, vec_id, label, x, sqrt(list_sum(list_transform(x, lambda c: c * c))) AS n FROM v
  WHERE label IS NOT NULL AND x IS NOT NULL
    AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
link AS (
  SELECT a.r AS a, b.r AS b, b.vec_id FROM u AS a JOIN u AS b ON a.label = b.label AND a.r <> b.r AND len(a.x) = len(b.x)
  WHERE list_inner_product(a.x, b.x) / (a.n * b.n) >= 0.98),
reach AS (SELECT a, b, vec_id FROM link UNION SELECT reach.a, link.b, link.vec_id FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a, min(vec_id) AS m FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
  vec_id <= coalesce(m, vec_id) AS kept
FROM v LEFT JOIN n ON n.a = r LEFT JOIN least ON least.a = r
"""
