"""The booster against a naive one, models that don't hang on partitions, the forecast's carried state, and loads that break off."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from partflow.operators import boosting, catalog, demand, hub, leadtime, stock
from partflow.operators.boosting import Booster
from partflow.rules import Rules
from partflow.sources import erp


def naive_split(x, rows, g, h):
    """The best (gain, column, threshold, missing rows go left) over all rows, by trying each."""
    best, totals = (1e-9, None, None, None), (sum(g[r] for r in rows), sum(h[r] for r in rows))
    for side in (True, False):
        for c in range(x.shape[1]):
            for t in boosting.thresholds_of(x[:, c]):
                left = [r for r in rows if (side if math.isnan(x[r, c]) else x[r, c] <= t)]
                gl, hl = sum(g[r] for r in left), sum(h[r] for r in left)
                gr, hr = totals[0] - gl, totals[1] - hl
                if hl >= boosting.LEAST_CHILD and hr >= boosting.LEAST_CHILD:
                    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - totals[0] ** 2 / (totals[1] + 1)
                    if gain > best[0] + 1e-7:
                        best = (gain, c, t, side)
    return best


def naive_scores(x, y, trees, rate, depth):
    """Boosting row by row, for shares of rows and columns of 1."""
    n, mean = len(y), y.mean()
    score = np.full(n, math.log(mean))
    for t in range(trees):
        mu = np.exp(score)
        g, h = mu - y, mu * math.exp(boosting.LONGEST_STEP)
        groups = [list(range(n))]
        for _ in range(depth if t else depth // 2):
            parts = []
            for rows in groups:
                _, c, at, side = naive_split(x, rows, g, h)
                left = rows if c is None else [r for r in rows if (side if math.isnan(x[r, c]) else x[r, c] <= at)]
                parts += [left, [r for r in rows if r not in set(left)]]
            groups = [p for p in parts if p]
        for rows in groups:
            if t:
                score[rows] += rate * min(max(-g[rows].sum() / (h[rows].sum() + 1), -0.7), 0.7)
            else:
                score[rows] += math.log((y[rows].sum() + mean) / (mu[rows].sum() + mean))
    return np.exp(score)


def counts(seed, n, d=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)), 2)
    y = rng.poisson(np.exp(1 + 0.8 * x[:, 0] + (x[:, 1] > 0.3))).astype(float)
    x[rng.random((n, d)) < 0.15] = np.nan
    return x, y


def test_booster_is_the_naive_one(monkeypatch):
    monkeypatch.setattr(boosting, "ROW_SHARE", 1.1)
    monkeypatch.setattr(boosting, "COLUMN_SHARE", 1.0)
    x, y = counts(1, 60)
    made = Booster.fit(x, y, trees=4, rate=0.3, depth=2, seed=0)
    assert np.allclose(made.predict(x), naive_scores(x, y, 4, 0.3, 2), rtol=1e-6)
    again = Booster.from_bytes(made.to_bytes())
    assert (again.predict(x) == made.predict(x)).all() and (made.predict(x) > 0).all()


def test_leaves_are_newton_steps_and_missing_values_take_a_learned_side():
    assert boosting.leaf_value(np.array([6.0, -100.0, 100.0]), np.array([11.0, 4.0, 4.0])).tolist() == [-0.5, 0.7, -0.7]
    x = np.array([[1.0]] * 40 + [[2.0]] * 40 + [[np.nan]] * 40)
    y = np.array([1.0] * 40 + [9.0] * 40 + [9.0] * 40)
    found = Booster.fit(x, y, trees=60, rate=0.3, depth=2, seed=1).predict(np.array([[1.0], [2.0], [np.nan], [0.0], [5.0]]))
    assert np.allclose(found, [1, 9, 9, 1, 9], rtol=0.1)


def panel(spark, parts=40, months=48):
    rows = [(f"P{p}", dt.date(2018 + i // 12, i % 12 + 1, 1), float(max(0, round(6 + 5 * math.sin(i * math.pi / 6 + p) + (p * 7 + i * 3) % 4)))) for p in range(parts) for i in range(months)]
    return spark.createDataFrame(rows, "part_number string, month date, demand_qty double")


def test_model_of_several_groups_is_the_same_for_any_partitioning(spark, monkeypatch):
    monkeypatch.setattr(demand, "GROUP_ROWS", 100)
    monkeypatch.setattr(demand, "VOTES", 3)
    monkeypatch.setattr(demand, "ROWS_AT_ONCE", 20)
    h = panel(spark)
    a, b = (demand.train_demand_model(x, trees=40, rate=0.1, depth=4) for x in (h, h.repartition(7, "month")))
    assert a.groups >= 10 and a.metrics["mase_vs_naive"] < 1
    assert a.metrics == pytest.approx(b.metrics, rel=1e-9)
    made = [sorted(map(tuple, demand.forecast_next(h, m).collect())) for m in (a, b)]
    assert made[0] == made[1] and len(made[0]) == 120
    assert abs(sum(r.importance for r in a.importances(spark).collect()) - 1) < 1e-9


class Seen:
    """A model that keeps what it is asked."""

    def __init__(self):
        self.rows = []

    def predict(self, features):
        self.rows += [(r.part_number, r.month, r.months_since_demand, r.tenure_months) for r in features.collect()]
        return features.withColumn("predicted", F.when(F.col("part_number") == "A", 0.0).otherwise(2.0))


def test_forecast_carries_what_lies_before_the_last_year(spark):
    rows = [(p, dt.date(2018 + i // 12, i % 12 + 1, 1), float(i == 3) if p != "N" else 0.0) for p in "ABN" for i in range(30)]
    h = spark.createDataFrame(rows, "part_number string, month date, demand_qty double")
    seen = Seen()
    demand.forecast_next(h, seen).collect()
    want = {}
    for step, month in enumerate((dt.date(2020, 7, 1), dt.date(2020, 8, 1), dt.date(2020, 9, 1))):
        want |= {("A", month): (26 + step, 30 + step), ("N", month): (30 if step == 0 else step - 1, 30 + step), ("B", month): (26 if step == 0 else step - 1, 30 + step)}
    want = {k: (0 if k[0] in "BN" and k[1].month > 7 else v[0], v[1]) for k, v in want.items()}
    assert {(p, m): (s, t) for p, m, s, t in seen.rows} == want


FILE_STEPS = ("_write", "_publish", "_clean", "_delete")


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("step", FILE_STEPS)
@pytest.mark.parametrize("kind", ["merge", "append", "rollback"])
def test_a_load_that_breaks_off_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, step, when, kind):
    rows = lambda a, b, v: spark.range(a, b).select("id", F.lit(v).alias("v"))
    first = hub.Hub(spark, str(tmp_path), "b1")
    first.load(rows(0, 40, "old"), "t", ("id",))
    first.load(rows(40, 60, "old"), "t", ("id",))
    old = {(r.id, r.v) for r in first.read("t").collect()}
    second = hub.Hub(spark, str(tmp_path), "b2")
    if kind == "rollback":
        second.load(rows(30, 50, "new"), "t", ("id",))
        old = {(r.id, r.v) for r in first.read("t").collect()}
        new, act = {x for x in old if x[1] == "old"}, lambda: second.rollback_batch("t", "b2")
    elif kind == "append":
        new, act = old | {(k, "new") for k in range(80, 100)}, lambda: second.load(rows(80, 100, "new"), "t", ("id",), mode="append")
    else:
        new = {x for x in old if not 30 <= x[0] < 70} | {(k, "new") for k in range(30, 70)}
        act = lambda: second.load(rows(30, 70, "new"), "t", ("id",))
    real = getattr(hub.Hub, step)

    def broken(self, *args):
        if when == "after":
            real(self, *args)
        raise OSError("gone")

    monkeypatch.setattr(hub.Hub, step, broken)
    try:
        act()
    except OSError:
        pass
    monkeypatch.undo()
    left = [(r.id, r.v) for r in hub.Hub(spark, str(tmp_path)).read("t").collect()]
    assert len(left) == len(set(left)) and set(left) in (old, new)
    if kind == "merge":
        second.load(rows(30, 70, "new"), "t", ("id",))
        assert {(r.id, r.v) for r in first.read("t").collect()} == new


def test_buckets_grow_with_the_table_and_readers_keep_what_they_opened(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hub, "BUCKET_ROWS", 50)
    table = hub.Hub(spark, str(tmp_path), "b1")
    put = lambda a, b: table.load(spark.range(a, b).selectExpr("id", "id AS v"), "t", ("id",))
    put(0, 100)
    opened = table.read("t")
    assert table._state("t")["n"] == 8
    put(90, 1000)
    assert opened.count() == 100 and table._state("t")["n"] == 64
    assert table.read("t").count() == table.read("t").select("id").distinct().count() == 1000
    table.load(spark.range(0).selectExpr("id", "id AS v"), "t", ("id",))
    assert table.rollback_batch("t", "b1") == 1000 and table.read("t").count() == 0


def test_equal_hot_rows_are_dealt_over_all_salts(spark, monkeypatch):
    left = spark.range(100_000).select(F.lit(1).alias("k"), F.lit("same").alias("v"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    right = spark.createDataFrame([(1, "x")], "k int, w string")
    joined = catalog.salted_join(left, right, "k", "left", Rules(hot_key_rows=10))
    assert joined.count() == 100_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" in plan


def test_orders_are_filtered_by_their_change_date(spark, tmp_path):
    (tmp_path / "with").mkdir()
    (tmp_path / "without").mkdir()
    head, line = "EBELN,EBELP,MATNR,MENGE,NETPR,WAERS,EINDT", "{0},1,7,5,1,USD,20200101"
    (tmp_path / "with/ekpo.csv").write_text("\n".join([head + ",AEDAT", line.format("A") + ",20240501", line.format("B") + ",20240401"]) + "\n")
    (tmp_path / "without/ekpo.csv").write_text("\n".join([head, line.format("A"), line.format("B")]) + "\n")
    since = dt.date(2024, 4, 15)
    assert [r.po_number for r in erp.purchase_orders(spark, str(tmp_path / "with"), since).collect()] == ["A"]
    assert erp.purchase_orders(spark, str(tmp_path / "with")).count() == erp.purchase_orders(spark, str(tmp_path / "without"), since).count() == 2


def test_entry_errors_come_with_the_deliveries(spark, tmp_path):
    day = lambda n: dt.date(2024, 1, n)
    rows = [(day(5), day(9), day(9)), (day(5), day(3), day(9)), (day(5), None, day(9)), (dt.date(2019, 1, 1), day(3), day(9))]
    orders = spark.createDataFrame(rows, "order_date date, actual_delivery_date date, promised_date date")
    kept, errors = leadtime.written_deliveries(orders, day(20), str(tmp_path / "d"))
    assert kept.count() == 1 and errors.collect() == leadtime.entry_errors(orders, day(20)).collect() and errors.first().asDict() == {"delivered": 2, "negative_lead_times": 1}


def test_the_last_date_of_a_stored_history_is_read_alone(spark, tmp_path):
    rows = [(dt.date(2024, 1, n), f"P{k}", n * k) for n in (1, 2, 3) for k in range(4)]
    spark.createDataFrame(rows, "run_date date, part_number string, n int").write.partitionBy("run_date").parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    last = stock.latest_snapshot(stored, "run_date")
    assert sorted((r.part_number, r.n) for r in last.collect()) == [(f"P{k}", 3 * k) for k in range(4)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan and "Subquery" in plan and "ReadSchema: struct<>" in plan
    assert stock.latest_snapshot(stored, "run_date", stored.filter("part_number = 'P1'")).first().n == 3
    assert stock.latest_snapshot(stored.filter("false"), "run_date").count() == 0


def test_sums_of_the_larger_child_are_exactly_what_the_smaller_one_leaves():
    """Bins without rows hold 0 after the subtraction, so that equal splits stay equal."""
    rng = np.random.default_rng(2)
    seen, node = rng.integers(0, 64, (5, 400)).astype(np.uint8), rng.integers(0, 8, 400)
    weights = [np.round(rng.normal(size=400) * 2.0**20) / 2.0**20 for _ in range(2)]
    parents = boosting.histograms(seen, node >> 1, weights, 4, 64, None)
    direct = boosting.histograms(seen, node, weights, 8, 64, None)
    found = boosting.histograms(seen, node, weights, 8, 64, parents)
    assert all((a == b).all() for a, b in zip(direct, found, strict=True))
    assert direct[0].shape == (8, 5, 64) and direct[0][3, 2, 7] == sum(w for w, n, b in zip(weights[0], node, seen[2]) if (n, b) == (3, 7))


def test_the_highest_values_are_told_from_missing_ones():
    """Values above the last threshold have a bin of their own, which missing ones don't share."""
    x = np.append(np.arange(640.0), np.full(64, np.nan))[:, None]
    y = np.where(x[:, 0] >= 630, 50.0, 1.0)
    made = Booster.fit(x, y, trees=60, rate=0.3, depth=2, seed=1)
    assert np.allclose(made.predict(np.array([[639.0], [631.0], [np.nan], [3.0]])), [50, 50, 1, 1], rtol=0.3)


def test_a_short_column_takes_its_own_bins_alone():
    """Histograms of columns of any number of bins, one after another, hold what those of equally many bins do."""
    rng = np.random.default_rng(3)
    sizes = np.array([3, 64, 2])
    seen, node = np.array([rng.integers(0, k, 500) for k in sizes]), rng.integers(0, 4, 500)
    weights = [np.round(rng.normal(size=500) * 2.0**20) / 2.0**20 for _ in range(2)]
    first = np.cumsum(sizes) - sizes
    wide = boosting.histograms(seen, node, weights, 4, 64, None)
    for parents in (None, boosting.histograms(seen, node >> 1, weights, 2, sizes, None)):
        found = boosting.histograms(seen, node, weights, 4, sizes, parents)
        assert found.shape == (2, 4, sizes.sum())
        assert all((found[:, :, a : a + k] == wide[:, :, c, :k]).all() for c, (a, k) in enumerate(zip(first, sizes)))


def test_a_table_of_rows_is_predicted_as_each_row_alone(monkeypatch):
    x, y = counts(4, 300, 5)
    made = Booster.fit(x, y, trees=20, rate=0.2, depth=4, seed=3)
    made.threshold[5, 0], made.missing_left[5, 0] = np.inf, False  # all values left, missing ones right
    assert (made.feature >= 0).sum() > 100 and not made.missing_left.all()
    alone = []
    for row in x:
        total = made.start
        for t in range(len(made.feature)):
            node = 0
            for level in range(4):
                k = 2**level - 1 + node
                f = made.feature[t, k]
                left = f < 0 or (made.missing_left[t, k] if math.isnan(row[f]) else row[f] <= made.threshold[t, k])
                node = 2 * node + (not left)
            total += made.value[t, node]
        alone.append(math.exp(total))
    monkeypatch.setattr(boosting, "ROWS_OF_TREE", 128)
    assert np.allclose(made.predict(x), alone, rtol=1e-12)


def test_steps_of_a_forecast_do_not_read_the_history_again(spark, tmp_path):
    panel(spark, 4, 30).write.parquet(str(tmp_path / "history"))
    read = []

    class Model:
        def predict(self, features):
            read.append(features.inputFiles())
            return features.withColumn("predicted", F.lit(1.0))

    assert demand.forecast_next(spark.read.parquet(str(tmp_path / "history")), Model()).count() == 12
    assert len(read) == 3 and all(files and not any("/history/" in f for f in files) for files in read)
