"""Ranked search, periodic runs and near-duplicate vectors against brute force, with nulls, ties, repeats and empty tables."""

import collections
import math
import random
import re

import numpy as np
import pytest

from partflow.llm import embedding_dedup, lexical_search, periodic_runs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def ranked_by_definition(docs, items, top):
    terms = lambda t: TERM.findall((t or "").translate(UPPER))
    of = [(d, terms(t)) for d, t in docs]
    n_docs, n_all = sum(bool(w) for _, w in of), sum(len(w) for _, w in of)
    df = collections.Counter(t for _, w in of for t in set(w))
    out = []
    for item, text in items:
        scored = []
        for d, w in of:
            if w:
                m, tf = 75 + 25 * len(w) * n_docs // n_all, collections.Counter(w)
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in terms(text) if tf[t])
                scored += [(-s, d is None, d or 0)] if s > 0 else []
        out += [(item, k + 1, None if x[1] else x[2], -x[0]) for k, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def some_docs(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Über", "ÉTÉ", "x2", "don't"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 3, 20, 60, 400])))) for i in range(n)]


@pytest.mark.parametrize(("tree", "leaf", "item_bytes"), [(16_384, 64, 1 << 22), (40, 3, 100)])
def test_search_is_brute_force(spark, monkeypatch, tree, leaf, item_bytes):
    monkeypatch.setattr(lexical_search.Tree.__init__, "__defaults__", (leaf,))
    docs = some_docs(3, 150) + [(400, None), (401, ""), (402, "w1 w2 w3"), (403, "w1 w2 w3"), (None, "w1 w2 w3"), (5, "w40 w41 w40"), (404, "... !")]
    items = [(0, "w0 w1 w2 w2"), (1, "W40 w41-w42 Über über"), (2, None), (3, "nowhere"), (4, "w1 w2 w3"), (4, "w1 w2 w3"), (None, "ÉTÉ été x2"), (6, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS rank", "3 AS score", "4 AS n")
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS item")
    found = lexical_search.ranked(df.repartition(3), asked, top=7, item_bytes=item_bytes, tree=tree).collect()
    assert sorted(map(tuple, found), key=repr) == ranked_by_definition(docs, items, 7)
    assert lexical_search.ranked(df.limit(0), asked).count() == 0 and lexical_search.ranked(df, asked.limit(0)).count() == 0


def test_trees_share_paths_bound_scores_and_leave_leaves_out():
    rng = np.random.default_rng(1)
    lists = [np.sort(rng.choice(200, size=rng.integers(1, 12), replace=False, p=(w := 1 / np.arange(1, 201)) / w.sum())) for _ in range(3000)]
    starts = np.r_[0, np.cumsum([len(x) for x in lists])]
    tfs, m = rng.integers(1, 9, starts[-1]), rng.integers(75, 200, len(lists))
    tree = lexical_search.Tree(starts, np.concatenate(lists), tfs, m, 200, leaf=8)
    assert len(tree.a) < 1500 and tree.b[tree.leaf].sum() - tree.a[tree.leaf].sum() == len(lists)
    terms, weights = np.array([0, 3, 150, 190]), np.array([10, 400, 5000, 6000])
    dense = np.zeros(200, np.int64)
    dense[terms] = weights
    bound = tree.bound(terms, weights)
    scores = np.zeros(len(lists), np.int64)
    for k in np.flatnonzero(tree.leaf):
        scores[tree.a[k] : tree.b[k]] = tree.scores(k, dense)
    assert all(bound[k] >= scores[tree.a[k] : tree.b[k]].max() for k in range(len(tree.a)))
    best, scored = tree.search(terms, weights, dense * 0, [], 5, lambda x: (False, int(x)))
    assert [-x[0] for x in best] == sorted(scores.tolist())[:-6:-1] and scored < tree.leaf.sum() / 4


def runs_by_definition(words):
    """Stretches with a smallest period that can't go on."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        s = 0
        while s < n - q:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e > s and e + q - s >= max(6, 4 * q):
                found.setdefault((s, e + q), q)
            s = max(e, s) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def test_runs_are_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "a", "a a a a a a", "a a a a a", "a b " * 4, "a b a b " * 3, "x " * 5000 + "y " * 70, "a b " * 3000, "aa a " * 9 + "b " + "aa a " * 9]
    texts += [" ".join(rng.choices("ab", k=rng.randint(0, 90))) for _ in range(80)]
    for _ in range(60):  # nested and neighbouring repeats
        root = rng.choices("abc", k=rng.randint(1, 9))
        text = rng.choices("abc", k=rng.randint(0, 5)) + root * rng.randint(1, 7) + root[: rng.randint(0, len(root))]
        texts.append(" ".join(text * rng.choice([1, 1, 4, 5]) + rng.choices("abc", k=3)))
    rows = [*enumerate(texts), (None, "a " * 6), (4, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "2 AS n_words", "3 AS start")
    found = periodic_runs.periodic_runs(df.repartition(3)).collect()
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        runs = runs_by_definition(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i, len(words), runs, b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found), key=repr) == sorted(want, key=repr)
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.runs_of(np.zeros(9, np.int64), least_periods=3)


def links_by_definition(rows, least):
    def fine(v, label):
        return v is not None and label is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    near = [set() for _ in range(n)]
    for a in range(n):
        for b in range(a):
            (_, v, k), (_, w, j) = rows[a], rows[b]
            if fine(v, k) and fine(w, j) and k == j and len(v) == len(w) and np.dot(v, w) / math.sqrt(np.dot(v, v) * np.dot(w, w)) >= least:
                near[a].add(b)
                near[b].add(a)
    out = []
    for a in range(n):
        reached, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()] - reached:
                reached.add(b)
                todo.append(b)
        ids = [rows[b][0] for b in reached if rows[b][0] is not None]
        out.append((rows[a][0], len(near[a]), min(ids, default=None), rows[a][0] == min(ids, default=None)))
    return sorted(out, key=repr)


def some_vectors(seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(20, 24))
    noisy = lambda v, s: v + s * np.linalg.norm(v) / 24**0.5 * rng.normal(size=24)
    vectors = [b.tolist() for b in base] + [noisy(base[k % 5], s).tolist() for k, s in enumerate([0.02, 0.08, 0.12, 0.14, 0.16, 0.2] * 12)]
    rows = [(i, v, i % 5 if i < 20 else (i - 20) % 5) for i, v in enumerate(vectors)]
    rows += [(100 + i, (np.array(rows[0][1]) * 3).tolist(), 0) for i in range(4)] + [(110, rows[0][1], 0), (0, rows[0][1], 0), (None, rows[1][1], 1), (111, rows[0][1], None)]
    bad = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [1e-200] * 24, [1e200] * 24, [1.0] * 24, [1.0] * 23]
    return rows + [(200 + i, v, 9) for i, v in enumerate(bad)] + [(300, [5.0], 9), (301, [7.0], 9), (302, [-5.0], 9)]


@pytest.mark.parametrize("block", [2048, 7])
def test_vector_links_are_brute_force(spark, block):
    rows = some_vectors(2)
    rows = [r for r in rows if r[1] is None or not r[1] or r[1][0] != 1e200]  # its square isn't a double: not for the naive cosine
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS node", "2 AS cell", "3 AS copies")
    found = embedding_dedup.linked_vectors(df.repartition(3), block=block).collect()
    want = links_by_definition([(i, None if v is None else v, k) for i, v, k in rows if not (v and v[0] == 1e-200)], 0.98)
    got = [tuple(r) for r in found if r.vec_id != 206]
    scaled = {(i, n, c, k) for i, n, c, k in got if i == 208}
    assert scaled == {(208, 1, 206, False)}  # the tiny vector has its direction
    got = [(i, 0, 208, True) if i == 208 else (i, n, c, k) for i, n, c, k in got]
    assert sorted(got, key=repr) == want
    assert embedding_dedup.linked_vectors(df.limit(0)).count() == 0


def test_lattice_points_are_the_nearest_and_pairs_meet():
    rng = np.random.default_rng(4)
    lattice = embedding_dedup.Lattice()
    y = rng.normal(size=(300, 8)) * 3
    home = embedding_dedup.nearest_e8(y)
    twice = np.rint(2 * home).astype(int)
    assert (2 * home == twice).all() and (twice.sum(axis=1) % 4 == 0).all() and all(len(set(x % 2)) == 1 for x in twice)
    assert lattice.roots.shape == (240, 8) and np.allclose((lattice.roots**2).sum(axis=1), 2)
    assert (((y - home) ** 2).sum(axis=1) <= ((y[:, None] - home[:, None] - lattice.roots) ** 2).sum(axis=2).min(axis=1) + 1e-9).all()
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    a, b = (lattice.cells(v, np.zeros(4000, np.int64)) for v in (x, 0.98 * x + (1 - 0.98**2) ** 0.5 * z))
    met = np.array([(a[:, t, :, None] == b[:, t, None, :]).any(axis=(1, 2)) for t in range(lattice.tables)])
    assert (met.mean(axis=1) > 0.9).all() and met.any(axis=0).all()
