"""Near-duplicate texts: MinHash banding, candidates weighed by odd sketches, links confirmed on full sets.

1. Each text becomes the set of its distinct word shingles; equal sets are one node.
2. A set is thrown into SAMPLES bins, round after round, until each bin has an element: the first to
   come is the bin's MinHash sample, so that one pass over a set gives all samples. Samples give band
   keys, and fold into an odd sketch: a bitmap that keeps the parity of how many samples fell on each
   bit. The bits in which two sketches differ number about the samples in which their sets differ,
   which gives high similarities precisely.
3. In every band bucket, nodes are proposed against the bucket's smallest node. A pair whose
   sketches allow the similarity is decided on the full sets. Of buckets with the same nodes, one counts.
4. Where a bucket still holds nodes of several components, the nodes outside its largest component
   are compared with all others of the bucket, in tasks of at most two blocks. Sketches and sizes choose
   the pairs, full sets decide them in the task, and only links that join components leave it: a
   group of copies, or of near misses, is never expanded into rows of pairs.
5. Components of the links are the groups.

A link is missed only if no band of its texts agrees (probability ``(1 - s**rows)**bands``: about
1e-6 at a similarity of 0.8 with the defaults, less above) or if a sketch is off by five deviations
(3e-7 at 0.8, and far less above). Sizes of sets and similarities are exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import components, drop_written, shuffles, table, text_hash, written

SHINGLE, BANDS, ROWS, PERCENT = 2, 45, 6, 80
#: Samples of a set (a power of two), the bits that they fold into, and how far off a sketch may be.
SAMPLES, SKETCH_BITS, DEVIATIONS = 1024, 2048, 5
#: A block has about so many nodes and shingles at most.
BLOCK_NODES, BLOCK_SHINGLES = 4096, 1_000_000
#: Texts that a task hashes at once, and their bytes (a longer text is hashed alone).
AT_ONCE, BYTES_AT_ONCE = 200, 1 << 20
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of anything but ASCII white space, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def shingle_set(text: str | None, k: int) -> set[tuple[bytes, ...]]:
    """The distinct runs of k words; of fewer words, the whole sequence; without words, nothing."""
    w = words_of(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(k))))


def alike(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return bool(both) and 100 * both >= percent * (len(a) + len(b) - both)


class _Hashes(dict):
    """64-bit hashes of words, kept for the words seen of late."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def _slices(batch: pa.RecordBatch):
    """The batch in slices of AT_ONCE rows and BYTES_AT_ONCE bytes of text at most, or of one row."""
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    at, held = 0, 0
    for k, n in enumerate(size.tolist()):
        if k > at and (k - at == AT_ONCE or held + n > BYTES_AT_ONCE):
            yield batch.slice(at, k - at)
            at, held = k, 0
        held += n
    if at < len(size):
        yield batch.slice(at)


def hashed_sets(texts: list[str | None], k: int, hashes: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of all texts, one text after the other, and where each begins."""
    words = [words_of(t) for t in texts]
    count = np.fromiter(map(len, words), np.int64, len(words))
    ids = np.fromiter((hashes[w] for each in words for w in each), np.uint64, int(count.sum()))
    width = np.minimum(count, k)  # of a text's shingles
    shingles = count - width + (count > 0)
    text_of = np.repeat(np.arange(len(words)), shingles)
    begin = np.cumsum(count) - count
    at = np.arange(len(text_of)) - np.repeat(np.cumsum(shingles) - shingles - begin, shingles)
    h = width[text_of].astype(np.uint64)
    for j in range(k):
        longer = width[text_of] > j
        if longer.all():
            h = _mixed(h * _M2 + ids[at + j])
        else:
            h[longer] = _mixed(h[longer] * _M2 + ids[at[longer] + j])
    order = np.lexsort((h, text_of))
    h = h[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (text_of[1:] != text_of[:-1])
    return h[first], np.concatenate([[0], np.cumsum(np.bincount(text_of[first], minlength=len(words)))])


def hashed_set(text: str | None, k: int) -> np.ndarray:
    return hashed_sets([text], k, _Hashes())[0]


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    a = rng.integers(0, 2**64, count, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 2**64, count, dtype=np.uint64)


#: Rounds that have multipliers of their own; a set of one element needs all but a few of so many.
ROUNDS = 16 * SAMPLES


def samples_of(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """SAMPLES MinHash samples of a set x of sorted hashes: the element that came first to each bin.

    Of those of one round, the smallest comes first. Bins that ROUNDS rounds leave empty (with one
    element, one bin in ten million) keep 0.
    """
    out = np.zeros(SAMPLES, np.uint64)
    if not len(x):
        return out
    shift, done, wanted = np.uint64(64 - SAMPLES.bit_length() + 1), 0, np.arange(SAMPLES)
    while len(wanted) and done < ROUNDS:
        upto = min(ROUNDS, done + max(1, int(SAMPLES * (np.log(len(wanted)) + 2) // len(x))))
        bins = ((a[done:upto, None] * x + b[done:upto, None]) >> shift).astype(np.int64).ravel()
        comes = np.full(SAMPLES, -1)
        comes[bins[::-1]] = np.arange(len(bins) - 1, -1, -1)
        found = wanted[comes[wanted] >= 0]
        out[found] = x[comes[found] % len(x)]
        wanted, done = wanted[comes[wanted] < 0], upto
    return out


def _least(h: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each text the smallest value of each multiplier, of texts with shingles: a row for each text."""
    out = np.zeros((len(starts) - 1, len(a)), np.uint64)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        for j in range(len(a)):
            out[full, j] = np.minimum.reduceat(h * a[j] + b[j], starts[:-1][full])
    return out


def _odd(least: np.ndarray, bits: int) -> np.ndarray:
    """Odd sketches of rows of MinHash samples, as 64-bit words: the parity of the samples on each bit."""
    order = np.arange(least.shape[1], dtype=np.uint64) * _M1
    bit = (_mixed(least ^ order) >> np.uint64(40)) % np.uint64(bits)
    flat = bit.astype(np.int64) + np.arange(len(least))[:, None] * bits
    odd = np.bincount(flat.ravel(), minlength=len(least) * bits).reshape(-1, bits) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def _lists(x: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(x).view(np.int64).ravel()))


def _sketched(h: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.stack([samples_of(h[i:j], a, b) for i, j in zip(starts[:-1], starts[1:])])


def signatures(items: DataFrame, k: int, bands: int, rows: int, sketched: bool = True) -> DataFrame:
    """Rows (id, n, set_hash, bands, sketch) for items (id, text); n is the size of the shingle set.

    Without sketches, each sample has a multiplier of its own, which is less work for few samples.
    """
    count = bands * rows

    def sign(batches):
        a, b = _multipliers(ROUNDS if sketched else count)
        hashes = _Hashes()
        for batch in batches:
            for part in _slices(batch):
                h, starts = hashed_sets(part.column("text").to_pylist(), k, hashes)
                n = np.diff(starts)
                sums = np.zeros((part.num_rows, 2), np.uint64)
                if len(h):
                    for i, x in enumerate((h, _mixed(h ^ _M1))):
                        sums[n > 0, i] = np.add.reduceat(x, starts[:-1][n > 0])
                least = _sketched(h, starts, a, b) if sketched else _least(h, starts, a, b)
                keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (part.num_rows, 1))
                for r in range(rows):
                    keys = _mixed(keys * _M2 + least[:, r:count:rows])
                sketch = _lists(_odd(least, SKETCH_BITS)) if sketched else pa.nulls(part.num_rows, pa.list_(pa.int64()))
                digest = pa.array([x.tobytes() for x in sums], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), digest, _lists(keys), sketch], ["id", "n", "set_hash", "bands", "sketch"]
                )

    kind = items.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n long, set_hash binary, bands array<long>, sketch array<long>"
    return items.select("id", "text").mapInArrow(sign, schema)


def sets_of(texts: DataFrame, k: int) -> DataFrame:
    """Rows (node, shingles, sketch) for texts (node, text): the sorted shingle hashes of each."""

    def hashed(batches):
        a, b = _multipliers(ROUNDS)
        hashes = _Hashes()
        for batch in batches:
            for part in _slices(batch):
                h, starts = hashed_sets(part.column("text").to_pylist(), k, hashes)
                shingles = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(h.view(np.int64)))
                columns = [part.column("node"), shingles, _lists(_odd(_sketched(h, starts, a, b), SKETCH_BITS))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "shingles", "sketch"])

    return texts.select("node", "text").mapInArrow(hashed, "node long, shingles array<long>, sketch array<long>")


def most_differing(samples: int, bits: int, percent: int) -> int:
    """Bits in which the sketches of sets with this similarity differ, DEVIATIONS above the mean.

    The samples in which the sets differ vary binomially, and each adds two parities; the bits that
    these leave odd vary as an occupancy.
    """
    s = percent / 100
    load = 2 * samples * (1 - s) / bits
    mean = bits * (1 - np.exp(-2 * load)) / 2
    from_samples = 2 * (samples * s * (1 - s)) ** 0.5 * np.exp(-2 * load)
    from_bits = (bits * ((1 - np.exp(-4 * load)) / 4 - load * np.exp(-4 * load))) ** 0.5
    return int(np.ceil(mean + DEVIATIONS * np.hypot(from_samples, from_bits)))


def differing(a: str, b: str) -> Column:
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda n, x: n + x)


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """pairs (a, b) with link: whether their full sets are alike."""

    def confirm(batches):
        last, of_last = None, set()
        for batch in batches:
            out = []
            for a, b, x, y in zip(batch.a, batch.b, batch.text_a, batch.text_b):
                if a != last:
                    last, of_last = a, shingle_set(x, k)
                out.append((a, b, alike(of_last, shingle_set(y, k), percent)))
            yield pd.DataFrame(out, columns=["a", "b", "link"])

    of = lambda side: texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
    both = pairs.select("a", "b").join(of("b"), "b").join(of("a"), "a")
    return both.select("a", "b", "text_a", "text_b").mapInPandas(confirm, "a long, b long, link boolean")


def _open(members: DataFrame) -> DataFrame:
    """Of members (bucket, node, n, component) those in buckets of several components: with in_main, n_main and n_rest.

    in_main marks the bucket's largest component, which has n_main blocks, all others together n_rest.
    Two nodes of a bucket have been compared already.
    """
    blocks = lambda nodes, shingles: F.ceil(F.greatest(nodes / BLOCK_NODES, shingles / BLOCK_SHINGLES)).cast("int")
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    sizes = sizes.groupBy("bucket").agg(
        F.max(F.struct("c", "component", "n")).alias("top"), F.sum("c").alias("c"), F.sum("n").alias("n"), F.count("*").alias("parts")
    )
    sizes = sizes.filter("parts > 1 and c > 2").select(
        "bucket",
        F.col("top.component").alias("main"),
        blocks(F.col("top.c"), F.col("top.n")).alias("n_main"),
        blocks(F.col("c") - F.col("top.c"), F.col("n") - F.col("top.n")).alias("n_rest"),
    )
    rows = members.join(written(sizes, "sizes"), "bucket")
    return rows.withColumn("in_main", F.col("component") == F.col("main")).drop("main", "n")


def _across(rows: DataFrame, marks: DataFrame, most: int, percent: int) -> DataFrame:
    """Links (a, b) that join the components which the buckets of rows hold.

    rows: as of ``_open``; marks: (node, shingles, sketch, buckets). Each node outside a bucket's
    largest component is weighed against the nodes of other components, by size and sketch, in the
    smallest of the buckets that both have, so that a pair comes up once; what passes is decided on the
    full sets. A task leaves out links within components that it has joined already.
    """
    own = F.pmod(F.xxhash64("node", "bucket"), F.when(F.col("in_main"), F.col("n_main")).otherwise(F.col("n_rest"))).cast("int")
    rows = rows.withColumn("own", own)
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    key = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    others = F.filter(upto("n_rest"), lambda j: j != F.col("own"))
    keys = F.when(F.col("in_main"), F.transform(upto("n_rest"), lambda j: key(F.col("own"), j))).otherwise(
        F.concat(
            F.transform(upto("n_main"), lambda i: key(i, F.col("own"))),
            F.transform(others, lambda j: key(-1 - F.least(F.col("own"), j), F.greatest(F.col("own"), j))),
        )
    )
    rows = rows.select("bucket", "node", "component", "in_main", "own", F.explode(keys).alias("key")).join(marks, "node")
    rows = rows.select("bucket", "key.i", "key.j", "node", "component", "in_main", "own", "shingles", "sketch", "buckets")
    rows = rows.repartition(shuffles(rows.sparkSession), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def links_of(group: pa.Table) -> list[tuple[int, int]]:
        column = lambda name: group.column(name).to_numpy()
        node, part, main, own = (column(x) for x in ("node", "component", "in_main", "own"))
        main, bucket, i = main.astype(bool), group.column("bucket")[0].as_py(), group.column("i")[0].as_py()
        # Rest with main, and a rest block with itself beside the first block of main; or two rest blocks.
        left = np.flatnonzero(~main if i >= 0 else own == -1 - i)
        right = np.arange(len(node)) if i == 0 else np.flatnonzero(main if i > 0 else own != -1 - i)
        if not len(left) or not len(right):
            return []
        lists = group.column("shingles").combine_chunks()
        at_set, shingles = lists.offsets.to_numpy(), lists.values.to_numpy()
        n, bits = np.diff(at_set), group.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
        names, buckets, roots, found = group.column("buckets"), {}, {}, []

        def root(x: int) -> int:
            while roots.get(x, x) != x:
                x = roots[x] = roots.get(roots[x], roots[x])
            return x

        def meet_here(x: int, y: int) -> bool:
            for z in (x, y):
                if z not in buckets:
                    buckets[z] = set(names[z].as_py())
            return min(buckets[x] & buckets[y]) == bucket

        def common(x: int, ys: np.ndarray) -> np.ndarray:
            """The sizes of the intersections of x's set with each of ys'."""
            of_x = np.sort(shingles[at_set[x] : at_set[x + 1]])
            each = np.concatenate([shingles[at_set[y] : at_set[y + 1]] for y in ys])
            same = of_x[np.searchsorted(of_x, each).clip(max=len(of_x) - 1)] == each
            return np.add.reduceat(same, np.cumsum(n[ys]) - n[ys], dtype=np.int64)

        step = max(1, 65_536 // len(right))
        for at in range(0, len(left), step):
            l = left[at : at + step, None]  # noqa: E741
            ok = (part[l] != part[right]) & (100 * np.minimum(n[l], n[right]) >= percent * np.maximum(n[l], n[right]))
            ok &= np.bitwise_count(bits[l] ^ bits[right]).sum(axis=2) <= most
            for k in np.flatnonzero(ok.any(axis=1)):
                x = int(l[k, 0])
                ys = [y for y in right[ok[k]].tolist() if root(part[x]) != root(part[y]) and meet_here(x, y)]
                for cut in range(0, len(ys), 1000):
                    y = np.array(ys[cut : cut + 1000])
                    both = common(x, y)
                    for z in y[100 * both >= percent * (n[x] + n[y] - both)].tolist():
                        a, b = sorted((root(part[x]), root(part[z])))
                        if a != b:
                            roots[b] = a
                            found.append((int(node[x]), int(node[z])))
        return found

    def join_up(batches):
        held = None
        for batch in _and_end(batches):
            if batch is not None:
                held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            if held is None or not len(held):
                continue
            keys = [held.column(c).to_numpy() for c in ("bucket", "i", "j")]
            ends = (np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1).tolist() + [len(held)] * (batch is None)
            at, links = 0, []
            for end in ends:  # the last group may go on in the next batch
                links += links_of(held.slice(at, end - at).combine_chunks())
                at = end
            held = held.slice(at)
            yield pa.RecordBatch.from_arrays([pa.array([x[side] for x in links], pa.int64()) for side in (0, 1)], ["a", "b"])

    return rows.mapInArrow(join_up, "a long, b long")


def _and_end(batches):
    yield from batches
    yield None


def near_groups(
    items: DataFrame,
    k: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    percent: int = PERCENT,
    sketched: bool = True,
) -> DataFrame:
    """Rows (id, n, component) for items (id, text): n distinct shingles, component the smallest id reachable.

    Items are linked if 100 * intersection >= percent * union of their sets of k-word shingles;
    texts without words, and nulls, have no shingles and are linked with nothing. ids may be of any
    type with an order, repeat and be null in parts; each row of items gets a row. A task holds a text
    whole when it hashes it, together with AT_ONCE - 1 others.

    With ``sketched``, all nodes get sketches, which weigh each pair. Without, as for short texts, pairs are
    decided on their sets at once, and only nodes that have to be compared in blocks get sketches.
    """
    most = most_differing(SAMPLES, SKETCH_BITS, percent)
    signed = written(signatures(items, k, bands, rows, sketched), "signed")
    nodes = written(
        signed.filter("n > 0")
        .groupBy("set_hash", "n")
        .agg(F.min("id").alias("first"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    ids = written(signed.select("id", "n", "set_hash"), "ids")
    drop_written(signed)
    met = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = met.groupBy("bucket").agg(
        F.min("node").alias("hub"), F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("same")
    )
    shared = shared.filter("c > 1").groupBy("hub", "c", "same").agg(F.min("bucket").alias("bucket")).select("bucket", "hub", "c")
    # Written first: a join of two plain shuffles can split a hot bucket.
    shared = written(shared, "shared")
    met = written(met.join(shared, "bucket"), "met")

    texts = nodes.select("node", "first").join(met.select("node").distinct(), "node", "left_semi")
    texts = texts.join(items.select("id", "text"), F.col("first") == F.col("id"))
    texts = written(texts.groupBy("first", "node").agg(F.first("text").alias("text")), "texts")

    proposed = met.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    of = lambda side: nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))
    proposed = proposed.join(of("a"), "a").join(of("b"), "b")
    proposed = proposed.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    proposed = proposed.filter(differing("s_a", "s_b") <= most) if sketched else proposed
    tested = written(_confirmed(proposed, texts, k, percent), "tested")
    component = components(tested.filter("link").select("a", "b"))

    def members(of: DataFrame) -> DataFrame:
        found = of.select("bucket", "node", "n").join(component, "node", "left")
        return found.select("bucket", "node", "n", F.coalesce("component", "node").alias("component"))

    rows_open = written(_open(members(met.filter("c > 2"))), "open")
    links = tested.filter("link").select("a", "b")
    if not rows_open.isEmpty():
        buckets = rows_open.groupBy("node").agg(F.collect_list("bucket").alias("buckets"))
        marks = written(sets_of(texts.join(buckets, "node", "left_semi"), k).join(buckets, "node"), "marks")
        links = links.union(written(_across(rows_open, marks, most, percent), "across"))
        component = components(links)
        drop_written(marks)
    drop_written(met, texts, rows_open, shared)

    rows_of = ids.join(nodes.select("set_hash", "n", "node"), ["set_hash", "n"], "left")
    rows_of = rows_of.join(component, "node", "left").select("id", "n", F.coalesce("component", "node").alias("group"))
    rows_of = written(rows_of, "groups")
    smallest = rows_of.filter("group is not null").groupBy("group").agg(F.min("id").alias("smallest"))
    smallest = written(smallest, "smallest")
    drop_written(ids, nodes, tested)
    return rows_of.join(smallest, "group", "left").select("id", "n", F.coalesce("smallest", "id").alias("component"))


def near_duplicates(documents: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, text_key, n_shingles, component_id, kept) for each row of documents.

    component_id is the smallest doc_id of the group (a null one is smaller than any), kept marks
    the rows that have it. Null texts and texts without words form groups of their own. Repeated
    rows are in one group; of equal doc_ids with different texts, the smaller text_key comes first.
    Texts of any length are taken whole. Other columns are ignored, whatever their names; an empty
    table gives an empty result.
    """
    return _found(documents, k, percent).drop("first")


def _found(documents: DataFrame, k: int, percent: int) -> DataFrame:
    """``near_duplicates``, with first: whether the row is of the group's smallest (doc_id, text_key)."""
    items = documents.select(F.struct("doc_id", text_hash(F.col("text")).alias("text_key")).alias("id"), "text")
    found = near_groups(items, k=k, percent=percent)
    return found.select(
        "id.*",
        F.col("n").alias("n_shingles"),
        F.col("component.doc_id").alias("component_id"),
        F.col("id.doc_id").eqNullSafe(F.col("component.doc_id")).alias("kept"),
        F.col("id").eqNullSafe(F.col("component")).alias("first"),
    )


def drop_near_duplicates(documents: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The input's rows and columns, one document of each group of near duplicates.

    The document with the smallest (doc_id, text hash) stays, nulls before numbers, and of rows that
    repeat both one. Rows without words all stay. Columns of any names are kept; an empty table gives an empty result.
    """
    found = _found(documents, k, percent).groupBy("doc_id", "text_key").agg(
        F.first("first").alias("first"), ((F.count("*") > 1) & (F.max("n_shingles") > 0)).alias("repeated")
    )
    found = written(found.filter("not first or repeated"), "dropped")
    marked = found.select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"), "first", "repeated")
    same = documents["doc_id"].eqNullSafe(F.col("__d")) & (text_hash(documents["text"]) == F.col("__k"))
    left = documents.join(marked, same, "left_anti")
    again = marked.filter("first and repeated").drop("first", "repeated")
    if again.isEmpty():
        return left
    again = documents.join(again, same).dropDuplicates(["__d", "__k"]).select(*documents.columns)
    return left.unionByName(again)


def op10_near_dup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS sh
    FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s AS a JOIN s AS b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN n AS na ON na.doc_id = a.doc_id JOIN n AS nb ON nb.doc_id = b.doc_id
  WHERE nb.n * 100 >= 80 * na.n AND na.n * 100 >= 80 * nb.n
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
  doc_id <= coalesce(b, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON doc_id = a
"""
