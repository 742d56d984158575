"""Dedup, near-dup, decontamination and mixing against brute force, with nulls, ties, repeats and empty tables."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from partflow.llm import decontaminate, line_dedup, mixing, near_dup, substring_dedup
from partflow.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string"


def documents(spark, texts, source="s"):
    rows = [(i, t, None, source, None, "own") if not isinstance(t, tuple) else (t[0], t[1], None, source, None, "own") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def some_texts(seed, n=30):
    rng = random.Random(seed)
    lines = [" ".join(rng.choices("ab cd ef gh ij kl mn op qr st".split(), k=rng.randint(1, 7))) for _ in range(12)]
    texts = ["\n".join(rng.choices([*lines, "", "  "], k=rng.randint(0, 14))) for _ in range(n)]
    return texts + [None, "", texts[0], texts[3] + "\n" + texts[4], (None, texts[1]), (5, texts[2]), (7, texts[7])]


def lines_to_delete(rows, least):
    """Every run of lines of every document, by definition."""
    first, out = {}, collections.defaultdict(set)
    docs = sorted({(d is not None, d or 0, i, t) for i, d, t in rows})
    for _, d, key, text in docs:
        lines = [(n, x.strip()) for n, x in enumerate((text or "").split("\n")) if x.strip()]
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = tuple(x for _, x in lines[a:b])
                if sum(len(x.split()) for x in run) >= least:
                    if run in first:
                        out[key].update(n for n, _ in lines[a:b])
                    else:
                        first[run] = key
    return out


@pytest.mark.parametrize("seed", [1])
def test_line_dedup_is_brute_force(spark, seed):
    df = documents(spark, some_texts(seed))
    got = line_dedup.dedup_lines(df, 10).collect()
    keyed = df.select("doc_id", "text", F.xxhash64("text").alias("k")).collect()
    want = lines_to_delete({((r.doc_id, r.k), r.doc_id, r.text) for r in keyed}, 10)
    hashes = {(r.doc_id, r.text): r.k for r in keyed}
    assert len(got) == len(keyed)
    texts = {(r.doc_id, r.k): r.text for r in keyed}
    left = collections.Counter((r.doc_id, r.text) for r in got)
    expected = collections.Counter()
    for r in keyed:
        gone = want.get((r.doc_id, r.k), set())
        kept = None if r.text is None else "\n".join(x for n, x in enumerate(r.text.split("\n")) if n not in gone)
        expected[(r.doc_id, kept)] += 1
    assert left == expected and hashes and texts
    assert set(got[0].asDict()) == {*df.columns, "n_lines", "deleted"}


def test_empty_tables(spark):
    none = documents(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert line_dedup.dedup_lines(none).count() == 0
    assert near_dup.near_duplicates(none).count() == 0
    assert substring_dedup.dedup_paragraphs(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(documents(spark, ["a b", None]), bench).filter("size(spans) > 0").count() == 0


def test_components_of_chain_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 130)] + [(200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in range(100, 130)} == {100} and got[200] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def groups_by_definition(texts, k, percent):
    sets = [near_dup.shingle_set(t, k) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if near_dup.alike(sets[i], sets[j], percent):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))], sets


def near_copies(seed):
    """A hub whose copies are unlike each other, chains of edits, copies, short texts and nulls."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    base = [word() for _ in range(120)]
    texts = []
    for _ in range(60):
        copy = base[:]
        for at in rng.sample(range(120), rng.choice([2, 5, 6, 9])):
            copy[at] = word()
        texts.append(" ".join(copy))
    chain = [word() for _ in range(60)]
    for i in range(20):
        chain[i * 3] = word()
        texts.append(" ".join(chain))
    texts += [" ".join(word() for _ in range(rng.randint(1, 80))) for _ in range(60)]
    texts.insert(30, " ".join(base).upper())
    return texts + [texts[0], texts[0] + " ", None, "", "  ", "one", "ONE", "one two", "one two three"]


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_are_brute_force(spark, k):
    texts = near_copies(k)
    want, sets = groups_by_definition(texts, k, 80)
    rows = near_dup.near_duplicates(documents(spark, texts), k).collect()
    got = {r.doc_id: r for r in rows}
    assert [got[i].component_id for i in range(len(texts))] == want
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert near_dup.drop_near_duplicates(documents(spark, texts), k).count() == len(set(want))


def test_near_duplicates_of_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h"
    rows = near_dup.near_duplicates(documents(spark, [(3, text), (3, text), (None, text), (9, "x y")])).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in rows) == [(-1, None, True), (3, None, False), (3, None, False), (9, 9, True)]


def test_whole_groups_leave_one_document(spark):
    text = "a b c d e f g h"
    df = documents(spark, [(3, text), (3, text), (None, text), (None, text), (None, text + " "), (9, "x y"), (9, "x y"), (4, None), (4, None), (5, "")])
    left = near_dup.drop_near_duplicates(df).collect()
    assert sorted((r.doc_id or -1, (r.text or "").strip()) for r in left) == [(-1, text), (4, ""), (4, ""), (5, ""), (9, "x y")]


def test_other_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(1, "a b c", 7, 8, 9), (2, "a b c", 7, 8, 9)], "doc_id long, text string, kept long, component_id long, node long")
    out = near_dup.drop_near_duplicates(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [(1, "a b c", 7, 8, 9)]


def test_very_long_texts_are_taken_whole(spark):
    words = [f"w{i}" for i in range(120_000)]
    texts = [" ".join(words), " ".join(words[:-3] + ["x", "y", "z"]), " ".join(words[:90_000]), " ".join(words[:95_000]) + " q" * 9]
    want, sets = groups_by_definition(texts, 2, 80)
    rows = sorted(near_dup.near_duplicates(documents(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [r.component_id for r in rows] == want and [r.n_shingles for r in rows] == [len(s) for s in sets]


def near_misses(pairs, singles=0):
    """One group of texts that share 80 words: two of a pair have 81 of 101 words in common, all others 80 of 102."""
    core = " ".join(f"core{i}" for i in range(80))
    own = lambda i: " ".join(f"own{i}x{j}" for j in range(10))
    return [f"{core} both{i // 2} {own(i)}" for i in range(2 * pairs)] + [f"{core} {own(i)} own{i}" for i in range(2 * pairs, 2 * pairs + singles)]


@pytest.mark.parametrize("block", [near_dup.BLOCK_NODES, 50])
def test_links_among_many_near_misses_are_found(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_NODES", block)
    n = 300 if block > 50 else 80
    rows = near_dup.near_duplicates(documents(spark, near_misses(n, 40)), k=1).collect()
    assert sorted(r.component_id for r in rows) == sorted([i // 2 * 2 for i in range(2 * n)] + list(range(2 * n, 2 * n + 40)))


@pytest.mark.parametrize("block", [near_dup.BLOCK_NODES, 16])
def test_components_of_a_bucket_are_joined_by_few_links(spark, monkeypatch, block):
    """Nodes 0 to 99 in one bucket, two in common: equal sets of even nodes, of odd nodes, and of 90 and more none."""
    monkeypatch.setattr(near_dup, "BLOCK_NODES", block)
    members = spark.range(100).selectExpr("7L AS bucket", "id AS node", "10L AS n", "greatest(id, 30) AS component")
    sets = "transform(sequence(1L, 10L), x -> if(id >= 90, id * 100 + x, x + 10 * (id % 2)))"
    marks = spark.range(100).selectExpr("id AS node", f"{sets} AS shingles", "array(0L) AS sketch", "array(9L, 7L) AS buckets")
    links = [(r.a, r.b) for r in near_dup._across(near_dup._open(members), marks, 0, 80).collect()]
    part = near_dup.components(spark.createDataFrame(links + [(i, 30) for i in range(30)], "a long, b long"))
    got = {r.node: r.component for r in part.collect()}
    assert {got[i] for i in range(90)} == {0} and not any(i in got for i in range(90, 100))
    assert len(links) == len(set(links)) and all(a % 2 == b % 2 and max(a, b) < 90 for a, b in links)
    assert len(links) < (90 if block > 50 else 90 * 8)


def test_samples_and_sketches_estimate_similarities():
    import numpy as np

    rng = np.random.default_rng(0)
    a, b = near_dup._multipliers(near_dup.ROUNDS)
    most = near_dup.most_differing(near_dup.SAMPLES, near_dup.SKETCH_BITS, 80)
    for size in (1, 10, 400, 30_000):
        for s, close in ((0.9, True), (0.8, True), (0.6, False)):
            both = round(2 * size * s / (1 + s))
            x = rng.integers(0, 2**63, 2 * size - both, dtype=np.uint64)
            s = both / len(x)
            samples = np.stack([near_dup.samples_of(np.sort(y), a, b) for y in (x[:size], x[size - both :])])
            assert np.isin(samples[0], x[:size]).all() and abs((samples[0] == samples[1]).mean() - s) < 0.06
            words = near_dup._odd(samples, near_dup.SKETCH_BITS).view(np.uint64)
            assert size == 1 or (np.bitwise_count(words[0] ^ words[1]).sum() <= most) == close


def test_shingles_of_many_texts_at_once():
    texts = near_copies(1) + [" ".join("ab" * 9), "x"]
    for k in (1, 2, 5):
        h, starts = near_dup.hashed_sets(texts, k, near_dup._Hashes())
        for i, text in enumerate(texts):
            assert h[starts[i] : starts[i + 1]].tolist() == near_dup.hashed_set(text, k).tolist()
            assert starts[i + 1] - starts[i] == len(near_dup.shingle_set(text, k))


def test_paragraphs_near_copies_go(spark):
    rng = random.Random(4)
    para = [" ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(60)) for _ in range(3)]
    near = para[0].rsplit(" ", 1)[0] + " other"
    df = documents(spark, [f"{para[0]}\nshort", f"{para[1]}\n{near}", f"{para[1]}\n{para[1]}", para[2], None, ""])
    got = {r.doc_id: r for r in substring_dedup.dedup_paragraphs(df).collect()}
    assert [list(got[i].deleted) for i in range(6)] == [[], [1], [0, 1], [], [], []]
    assert got[1].copies_of == [0] and got[2].copies_of == [1] and got[1].text == para[1] and got[4].text is None


@pytest.mark.parametrize("broadcast", [100_000, -1])
def test_decontamination_is_brute_force(spark, broadcast):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choices("abc", k=n))) for i, n in enumerate([3, 10, 14, 1, 25, 9])] + [(7, None), (8, "!!"), (None, "z z z z z z z z z z z"), (4, "Ünï ü")]
    texts = [" ".join(rng.choices("abcz", k=rng.randint(0, 120))).upper() for _ in range(25)] + [None, "", "x; ünï-ü", "z " * 30]
    df = documents(spark, texts + [(0, texts[0])])
    found = decontaminate.contamination(df, spark.createDataFrame(items, "item_id long, text string"), broadcast).collect()
    assert len(found) == len(texts) + 1
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = lambda t: "".join(c if ord(c) > 127 or c.isalnum() else " " for c in (t or "").translate(low)).split()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        w, hit, ids = words(t), set(), set()
        for item, x in items:
            x = words(x)
            n = min(10, len(x))
            wins = {tuple(x[j : j + n]) for j in range(len(x) - n + 1)} if n else set()
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in wins:
                    hit.update(range(j, j + n))
                    ids.add(item)
        for r in by_id[i]:
            assert r.n_words == len(w)
            assert {p for s in r.spans for p in range(s.start, s.end)} == hit
            assert set(r["items"]) == ids - {None}
    assert len(by_id[0]) == 2


def test_fingerprints_are_the_smallest_of_each_window(spark):
    rng = random.Random(8)
    texts = [rng.choices("abcdefgh", k=n) for n in (0, 9, 10, 11, 40, 200)] + [["z"] * 30]
    rows = decontaminate.winnowed(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, words array<string>")).collect()
    for r in rows:
        w, fp = texts[r.i], {p for p, h in enumerate(r.fp) if h is not None}
        assert len(r.fp) == (len(w) - 4 if len(w) >= 10 else 0)
        for a in range(len(w) - 9):  # each ten words have a fingerprint, the same one wherever they stand
            assert fp & set(range(a, a + 6))
        if len(w) == 200:
            assert len(fp) < 80


def test_long_shared_spans_among_clashing_columns(spark):
    rng = random.Random(9)
    item = [f"w{rng.randint(0, 500)}" for _ in range(3000)]
    text = ["start", *item[100:2900], "x", *item[5:14], "y", *item[20:30], "end"] + ["pad"] * 50_000
    df = spark.createDataFrame([(1, " ".join(text), 5, 6, 7)], "doc_id long, text string, item_id int, words int, fp int")
    bench = spark.createDataFrame([(3, " ".join(item), 1)], "item_id long, text string, doc_id int")
    for limit in (1 << 20, -1):
        got = decontaminate.contamination(df, bench, limit).collect()
        assert len(got) == 1 and got[0]["items"] == [3] and got[0].n_words == len(text)
        assert [tuple(x) for x in got[0].spans] == [(1, 2801), (2812, 2822)]


def test_shares_reach_caps():
    assert mixing.share([10, 10, 10], [1, 2, 3], 30) == pytest.approx([5, 10, 15])
    assert mixing.share([1, 100], [9, 1], 101) == pytest.approx([3, 98])
    assert mixing.share([0, 5], [1, 1], 5) == pytest.approx([0, 5])


def test_quotas_are_exact():
    q = mixing.split_quotas([7, 0, 100], 8)
    assert q.sum(axis=1).tolist() == [7, 0, 100] and q.min() >= 0 and set(q.sum(axis=0)) <= {13, 14}


def test_quotas_in_tasks_are_those_of_the_tree(spark):
    for counts, shards in (([70, 0, 1000], 200), ([5], 1), ([0, 0], 70)):
        want = mixing.split_quotas(counts, shards)
        got = {(r.sid, r.shard): (r.begin, r.n) for r in mixing.shard_quotas(spark, counts, shards).collect()}
        begin = want.cumsum(axis=1) - want
        assert got == {(i, j): (begin[i, j], want[i, j]) for i in range(len(counts)) for j in range(shards) if want[i, j]}


def test_mix_is_brute_force(spark):
    """taken and shards of each row, from the hashes and the tree."""
    rng = random.Random(6)
    texts = [(rng.choice("aaab"), "w " * rng.randint(0, 30)) for _ in range(700)] + [(None, "w x"), (None, "y")]
    rows = [(i, t, s, "own") for i, (s, t) in enumerate(texts)] + [(3, texts[3][1], texts[3][0], "own"), (None, "z " * 9, "b", "own")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken string")
    shards, seed = 5, mixing.SEED
    got = {(r.doc_id, r.text): r for r in mixing.mix(df, shards=shards).collect()}
    hashed = lambda *c: F.xxhash64(*c)
    key = hashed("text")
    rows = df.distinct().select("doc_id", "text", "source", hashed("doc_id", key, F.lit(seed)).alias("h"), hashed("doc_id", key, F.lit(seed + 1)).alias("later"), key.alias("k")).collect()
    repeated = {(3, texts[3][1])}
    times = lambda r: 2 if (r.doc_id, r.text) in repeated else 1
    size = lambda r: len(r.text.split())
    names = ["a", "b", None]
    sizes = [sum(size(r) * times(r) for r in rows if r.source == s) for s in names]
    targets = mixing.share(sizes, [1.0, 2.0, 3.0], float(sum(sizes)))
    at = spark.range(2000).selectExpr("id AS block").withColumn("sid", F.explode(F.array(*map(F.lit, range(3))))).select("sid", "block", hashed("sid", "block", F.lit(seed)).alias("h"))
    order_of = {(r.sid, r.block): (r.h, r.block) for r in at.collect()}
    want, copies = {}, []
    for i, s in enumerate(names):
        mine = [r for r in rows if r.source == s]
        n_blocks = -(-sum(map(times, mine)) // mixing.BLOCK_ROWS)
        passes = min(3, int(targets[i] // sizes[i]))
        rest, blocks = targets[i] - passes * sizes[i], {}
        for r in mine:
            blocks.setdefault(r.h % n_blocks, []).append(r)
        order, upto, extra, cut = sorted(blocks, key=lambda b: order_of[i, b]), 0, set(), None
        for b in order:
            words = sum(size(r) * times(r) for r in blocks[b])
            if upto + words <= rest:
                extra |= {(r.doc_id, r.text) for r in blocks[b]}
            elif upto < rest:
                cut, left = b, rest - upto
            upto += words
        if cut is not None:
            sofar, total, again = 0, 0, 0
            ordered = sorted(blocks[cut], key=lambda r: (r.later, r.doc_id is not None, r.doc_id or 0, r.k))
            for r in ordered:
                total += size(r) * times(r)
                if total <= left:
                    extra.add((r.doc_id, r.text))
                    sofar = total
            total = 0
            for r in ordered:
                unit = size(r) * times(r)
                total += unit
                if total > left and unit <= left - sofar:
                    again += unit
                    if again <= left - sofar:
                        extra.add((r.doc_id, r.text))
        n_extra = sum(1 for b in order if all((r.doc_id, r.text) in extra for r in blocks[b]) and b != cut) + (cut is not None)
        copies.append((passes, order, blocks, extra, passes * len(order) + n_extra))
    quotas = mixing.split_quotas([c[-1] for c in copies], shards)
    for i, (passes, order, blocks, extra, _) in enumerate(copies):
        shard_of = [j for j in range(shards) for _ in range(quotas[i, j])]
        for rank, b in enumerate(order):
            for r in blocks[b]:
                n = (passes + ((r.doc_id, r.text) in extra)) if size(r) else 0
                want[r.doc_id, r.text] = [shard_of[k * len(order) + rank] for k in range(n)]
    assert {k: list(r.shards) for k, r in got.items()} == want
    assert all(r.taken == r.size * len(r.shards) for r in got.values())


def test_mix_meets_targets_and_reruns_agree(spark):
    rng = random.Random(5)
    texts = [("a", rng.randint(0, 60)) for _ in range(500)] + [("b", rng.randint(1, 40)) for _ in range(100)] + [(None, 30), (None, 5), ("é", 10)]
    rows = [(i, " ".join("w" * n), None, s, None, "own") for i, (s, n) in enumerate(texts)] + [(1000, None, None, "b", None, "own")]
    df = spark.createDataFrame(rows, DOCS)
    mixed = mixing.mix(df, shards=4)
    got = mixed.collect()
    assert len(got) == len(rows) and set(mixed.columns) == {*DOCS.replace("doc_id long", "doc_id").replace(" string", "").replace(" long", "").replace("shard", "shard").split(", "), "size", "source_size", "target", "taken", "shards"}
    taken, target, longest = collections.Counter(), {}, collections.Counter()
    for r in got:
        assert r.taken == r.size * len(r.shards) and r.taken <= 3 * r.size and all(0 <= s < 4 for s in r.shards)
        taken[r.source] += r.taken
        target[r.source] = r.target
        longest[r.source] = max(longest[r.source], r.size)
    assert sum(target.values()) == pytest.approx(sum(r.size for r in got))
    for s in target:
        assert abs(taken[s] - target[s]) <= longest[s], s
    key = lambda rows: sorted((r.doc_id, r.taken, tuple(r.shards)) for r in rows)
    assert key(mixing.mix(df.repartition(7), shards=4).collect()) == key(got)
    copies = mixing.in_shards(mixed)
    assert copies.count() == sum(len(r.shards) for r in got)
    assert copies.select("shard", F.spark_partition_id().alias("p")).distinct().groupBy("shard").count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("word", ["z ", "a b ", "a b c d e f g "])
def test_decontamination_of_repeated_words(spark, word, limit):
    """Each gram of a text that repeats words is a fingerprint; places with the same words around them are one."""
    df, bench = documents(spark, [word * 4000, "q " + word * 9, None]), spark.createDataFrame([(1, word * 5000), (2, word * 12), (None, word * 3000)], "item_id long, text string")
    found = {r.doc_id: (r.n_words, [tuple(s) for s in r.spans], sorted(r.items)) for r in decontaminate.contamination(df, bench, limit).collect()}
    n = len(word.split())
    short = 9 * n
    assert found[0] == (4000 * n, [(0, 4000 * n)], [1, 2])
    assert found[1] == (1 + short, [(1, 1 + short)] if short >= 10 else [], [1, 2] if short >= 10 else [])
    assert found[2] == (0, [], [])


def test_long_shared_spans(spark):
    rng = random.Random(4)
    span = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(20_000))
    df = documents(spark, ["x y " + span + " z", span[:1000]])
    (a, b) = decontaminate.contamination(df, spark.createDataFrame([(5, span, 1)], "item_id long, text string, doc_id int")).orderBy("doc_id").collect()
    assert [tuple(s) for s in a.spans] == [(2, 20_002)] and a.items == [5] and len(b.spans) == 1
