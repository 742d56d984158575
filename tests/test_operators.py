import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from partflow.operators import catalog, demand, hub, leadtime, risk, stock, views
from partflow.rules import Rules

AS_OF = dt.date(2024, 6, 1)
ORDERS = "po_number string, po_line int, part_number string, supplier_id string, order_date date, promised_date date, actual_delivery_date date, quantity double, status string"


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDERS)


def line(i, lead, slip, age=30, supplier="S1", part="P1"):
    day = AS_OF - dt.timedelta(days=age)
    got = day + dt.timedelta(days=lead)
    return (f"PO{i}", 1, part, supplier, day, got - dt.timedelta(days=slip) if slip is not None else None, got, 1.0, "DELIVERED")


def quantile(values, weights, q):
    order = np.argsort(values, kind="stable")
    v, w = np.array(values, float)[order], np.array(weights)[order]
    return np.interp(q, (np.cumsum(w) - 0.5 * w) / w.sum(), v)


def test_profile_equals_brute_force_and_any_partitioning(spark):
    rng = np.random.default_rng(1)
    rows = [line(i, int(rng.integers(5, 40)), int(rng.integers(-20, 20)), int(rng.integers(0, 700))) for i in range(60)]
    df = leadtime.prepare_deliveries(orders(spark, rows), AS_OF)
    rows.sort(key=lambda r: (r[6] - r[4], r[4]))
    leads = [(r[6] - r[4]).days for r in rows]
    weights = [0.5 ** ((AS_OF - r[4]).days / 180) for r in rows]
    found = [leadtime.lead_time_profiles(x, AS_OF).first() for x in (df, df.repartition(7), df.coalesce(1))]
    for got in found:
        for name, q in leadtime.QUANTILES.items():
            assert got[name] == pytest.approx(quantile(leads, weights, q))
        assert got["mean_days"] == pytest.approx(np.average(leads, weights=weights))
        x = [-(AS_OF - r[4]).days / 365 for r in rows]
        assert got["trend_days_per_year"] == pytest.approx(np.polyfit(x, leads, 1)[0])
        assert got["p50_days"] <= got["p80_days"] <= got["p95_days"]
        assert got["confidence"] == "HIGH"


def test_deliveries_drop_negative_old_and_open(spark):
    rows = [line(1, -3, 0), line(2, 10, 0, age=800), line(3, 10, None), line(4, 10, -31), line(5, 10, 0)]
    rows.append(("PO6", 1, "P1", "S1", AS_OF, AS_OF, None, 1.0, "OPEN"))
    found = {r.po_number: r.on_time for r in leadtime.prepare_deliveries(orders(spark, rows), AS_OF).collect()}
    assert found == {"PO3": False, "PO4": False, "PO5": True}


def test_scorecard_of_nothing_and_fallback(spark):
    assert leadtime.supplier_scorecard(orders(spark, []), AS_OF).count() == 0
    rows = [line(i, 10 + i, 0) for i in range(6)] + [line(9, 30, 0, part="P2")]
    found = {r.part_number: r for r in leadtime.supplier_part_lead_times(orders(spark, rows), AS_OF).collect()}
    assert found["P1"].confidence == "MEDIUM" and found["P2"].confidence == "FALLBACK" and found["P2"].n_deliveries == 7


def test_inventory_rules(spark):
    rows = [("W", "P1", "10", "2", "1", "ne ", None), ("W", "P2", "10", "x", None, "AR", None), ("W", "P3", "10", "0", "0", "OH", "2024-05-31"), ("W", "P4", "1", "5", "0", None, "2024-06-01"), ("W", "P5", "3", "0", "0", "SV", "bad")]
    df = spark.createDataFrame(rows, "warehouseId string, part_number string, quantityOnHand string, qty_reserved string, quantityQuarantine string, condition string, expiryDate string")
    found = stock.normalize_inventory(df, "X", AS_OF)
    assert {r.part_number: r.qty_available for r in found.collect()} == {"P1": 7, "P2": 0, "P3": 0, "P4": 0, "P5": 3}
    assert stock.stock_accuracy(found, AS_OF).first().asDict() == {"records": 5, "stale_pct": 100.0, "trusted_pct": 0.0}
    assert stock.stock_accuracy(found.limit(0), AS_OF).first().asDict() == {"records": 0, "stale_pct": 0.0, "trusted_pct": 0.0}


def inputs(spark, stock_rows, order_rows=(), demand_rows=(("P1", 30.0), ("P2", 30.0)), work=None):
    return dict(
        parts=spark.createDataFrame([("P1", "NO_GO", "A", 10.0), ("P2", "GO", "A", 5.0)], "part_number string, criticality string, ata_chapter string, unit_cost_usd double"),
        inventory=spark.createDataFrame(list(stock_rows), "part_number string, qty_available int"),
        orders=spark.createDataFrame(list(order_rows), "part_number string, expected_date date, supplier_id string, po_number string, po_line int"),
        demand=spark.createDataFrame(list(demand_rows), "part_number string, monthly_demand double"),
        work_orders=None if work is None else spark.createDataFrame(work, "part_number string, qty_required double, wo_type string"),
    )


def scores(x):
    return {r.part_number: r for r in risk.score_risk(AS_OF, **x).collect()}


def test_risk_is_bounded_and_follows_stock_and_criticality(spark):
    none, ample = scores(inputs(spark, [])), scores(inputs(spark, [("P1", 100), ("P1", 900)]))
    assert none["P1"].aog_risk_score > none["P2"].aog_risk_score
    assert none["P1"].aog_risk_score > ample["P1"].aog_risk_score
    assert all(0 <= r.aog_risk_score <= 100 for r in (*none.values(), *ample.values()))
    assert none["P1"].factor_replenishment == 1.0 and ample["P1"].factor_replenishment == 0.0


def test_no_demand_is_no_coverage_risk(spark):
    found = scores(inputs(spark, [], demand_rows=[]))
    assert found["P1"].factor_coverage == 0 and found["P1"].days_of_cover == 9999


def test_grounded_aircraft_scores_100(spark):
    assert scores(inputs(spark, [("P1", 1)], work=[("P1", 2.0, "AOG")]))["P1"].aog_risk_score == 100.0
    assert scores(inputs(spark, [("P1", 2)], work=[("P1", 2.0, "AOG")]))["P1"].aog_risk_score < 100.0


def test_early_warning_has_stock_that_runs_out(spark):
    scored = risk.score_risk(AS_OF, **inputs(spark, [("P1", 10)]))
    rows = risk.early_warning(scored).collect()
    assert [(r.part_number, r.warning_hours, r.projected_stockout_date) for r in rows] == [("P1", 240.0, AS_OF + dt.timedelta(days=10))]


def test_cooldown_border_is_strict(spark):
    now = dt.datetime(2024, 6, 1, 12)
    log = spark.createDataFrame([("A", now - dt.timedelta(hours=12)), ("B", now - dt.timedelta(hours=11))], "part_number string, alerted_at timestamp")
    got = risk.without_recent(spark.createDataFrame([("A",), ("B",)], "part_number string"), log, now)
    assert [r[0] for r in got.collect()] == ["A"]


def test_supersessions_with_chains_branches_and_cycles(spark):
    edges = [("A", "B"), ("B", "C"), ("X", "Z"), ("X", "Y"), ("P", "Q"), ("Q", "R"), ("R", "P"), ("L", "Q"), ("S", "S")]
    edges += [(f"N{i:02d}", f"N{i + 1:02d}") for i in range(20)]
    df = spark.createDataFrame(edges, "old_part_number string, new_part_number string")
    got = {r.part_key: (r.master_part_key, r.in_cycle) for r in catalog.resolve_supersessions(catalog.supersession_edges(df)).collect()}
    assert got["A"] == got["B"] == ("C", False) and got["X"] == ("Y", False)
    assert got["P"] == got["Q"] == got["R"] == got["L"] == ("P", True) and "S" not in got
    assert {got[f"N{i:02d}"] for i in range(20)} == {("N20", False)}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(spark, how):
    left = spark.range(300).select((F.col("id") % 7 * F.when(F.col("id") % 3 == 0, 1).otherwise(0)).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (0, "b"), (3, "c")], "k long, v string")
    got = catalog.salted_join(left, right, "k", how, Rules(hot_key_rows=50, salt_buckets=4))
    want = left.join(right, "k", how)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        catalog.salted_join(left, right, "k", "full")


def test_upsert_twice_is_once_and_rollback(spark, tmp_path):
    table = hub.Hub(spark, str(tmp_path), "b1")
    first = spark.createDataFrame([("W1", "OPEN", 1), ("W2", "OPEN", 2)], "work_order_id string, status string, n int")
    change = spark.createDataFrame([("W2", "CLOSED"), ("W3", "OPEN")], "work_order_id string, status string")
    assert table.load(first, "fct_work_orders") == 2
    for _ in range(2):
        hub.Hub(spark, str(tmp_path), "b2").load(change, "fct_work_orders")
    rows = {r.work_order_id: (r.status, r.n) for r in table.read("fct_work_orders").collect()}
    assert rows == {"W1": ("OPEN", 1), "W2": ("CLOSED", 2), "W3": ("OPEN", None)}
    assert table.rollback_batch("fct_work_orders", "b2") == 2
    assert [r.work_order_id for r in table.read("fct_work_orders").collect()] == ["W1"]
    assert table.load(first.limit(0), "fct_work_orders") == 0
    with pytest.raises(ValueError):
        table.load(first.union(first), "fct_work_orders")
    with pytest.raises(ValueError):
        table.load(first, "unknown")
    assert table.load_all({"notes": first, "fct_work_orders": first}) == {"fct_work_orders": 2, "notes": 2}


def test_upserts_keep_the_newest_across_batches(spark, tmp_path):
    table = hub.Hub(spark, str(tmp_path), "b1")
    rows = lambda *x: spark.createDataFrame(x, "k string, at int, v string")
    table.load(rows(("a", 5, "new"), ("b", 1, "old")), "t", ("k",), order="at")
    hub.Hub(spark, str(tmp_path), "b2").load(rows(("a", 3, "late"), ("b", 2, "newer"), ("c", 1, "c")), "t", ("k",), order="at")
    assert sorted((r.k, r.v) for r in table.read("t").collect()) == [("a", "new"), ("b", "newer"), ("c", "c")]


def test_results_by_run_date(spark, tmp_path):
    day = lambda n: dt.date(2024, 1, n)
    for n in (1, 2, 2):
        hub.write_results({"x": spark.range(n).toDF("n")}, str(tmp_path), day(n))
    assert hub.read_results(spark, str(tmp_path), "x").count() == 2 and hub.read_results(spark, str(tmp_path), "x", day(1)).count() == 1


def test_risk_tables_are_checked(spark):
    x = inputs(spark, [])
    with pytest.raises(ValueError, match="lacks"):
        risk.score_risk(AS_OF, **{**x, "inventory": x["parts"]})
    with pytest.raises(ValueError, match="no "):
        risk.score_risk(AS_OF, parts=x["parts"])
    with pytest.raises(TypeError):
        risk.score_risk(AS_OF, **x, planes=x["parts"])


def test_scoped_tables_have_these_parts_alone(spark):
    rows = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "part_number string, qty_available int")
    cards = spark.createDataFrame([("S", 1.0)], "supplier_id string, on_time_rate double")
    few = spark.createDataFrame([("B",), ("B",)], "part_number string")
    out = risk.scoped({"inventory": rows, "supplier_scores": cards, "customs": None}, few)
    assert [tuple(r) for r in out["inventory"].collect()] == [("B", 2)]
    assert out["supplier_scores"].count() == 1 and out["customs"] is None
    assert risk.scoped({"inventory": rows}, few.limit(0))["inventory"].count() == 0


def test_order_of_scores_and_cards(spark):
    scored = risk.score_risk(AS_OF, **inputs(spark, [("P1", 10), ("P2", 3)]))
    found = [r.aog_risk_score for r in risk.ranked(scored).collect()]
    assert found == sorted(found, reverse=True)
    cover = [r.days_of_cover for r in risk.early_warning(scored).collect()]
    assert len(cover) == 2 and cover == sorted(cover)
    rows = [line(i, 10 + 5 * (i % 3), (i % 3) * 9, supplier=f"S{i % 3}") for i in range(30)]
    cards = [r.composite_score for r in leadtime.supplier_scorecard(orders(spark, rows), AS_OF).collect()]
    assert len(cards) == 3 and cards == sorted(cards)
    bad = [line(1, 5, 0), line(2, -3, 0), line(3, 4, 0, age=5000)]
    assert leadtime.entry_errors(orders(spark, bad), AS_OF).first().asDict() == {"delivered": 2, "negative_lead_times": 1}


def test_scd2_keeps_history(spark):
    schema = "part_number string, criticality string, unit_cost_usd double, master_part_number string, is_superseded boolean"
    a = spark.createDataFrame([("P1", "GO", 1.0, "P1", False), ("P2", None, 1.0, "P2", False)], schema)
    b = spark.createDataFrame([("P1", "GO", 2.0, "P1", False), ("P2", None, 1.0, "P2", False), ("P3", "GO", 1.0, "P3", False)], schema)
    day = lambda n: dt.datetime(2024, 1, n)
    out = hub.scd2(hub.scd2(None, a, day(1)), b, day(2))
    assert sorted((r.part_number, r.unit_cost_usd, r.is_current) for r in out.collect()) == [("P1", 1.0, False), ("P1", 2.0, True), ("P2", 1.0, True), ("P3", 1.0, True)]
    assert hub.scd2(out, b, day(3)).count() == 4
    assert hub.current_parts(out).count() == 3


def history(spark, series):
    rows = [("P", dt.date(2020 + i // 12, i % 12 + 1, 1), float(y)) for i, y in enumerate(series)]
    return spark.createDataFrame(rows, "part_number string, month date, demand_qty double")


def test_features_look_back_only(spark):
    y = [3, 0, 0, 5, 1, 0, 2, 0, 0, 0, 4, 1, 2, 7]
    full = {r.month: r for r in demand.build_features(history(spark, y)).collect()}
    cut = {r.month: r for r in demand.build_features(history(spark, y[:9] + [99])).collect()}
    month = dt.date(2020, 10, 1)
    for c in demand.feature_columns(demand.build_features(history(spark, y))):
        assert full[month][c] == cut[month][c], c
    last = full[dt.date(2021, 2, 1)]
    assert last.lag_1 == 2 and last.roll_mean_3 == pytest.approx(7 / 3) and last.roll_max_12 == 5 and last.months_since_demand == 0
    assert full[dt.date(2020, 1, 1)].roll_nonzero_3 == 0 and full[month].months_since_demand == 2


def test_demand_patterns(spark):
    pattern = lambda y: demand.demand_profile(history(spark, y)).first()
    assert pattern([5, 6, 5, 6] * 6).pattern == "SMOOTH" and pattern([5, 6, 5, 6] * 6).forecastable
    assert pattern([1, 30, 1, 1] * 6).pattern == "ERRATIC"
    assert pattern([0, 0, 5, 0, 0, 5] * 4).pattern == "INTERMITTENT"
    assert pattern([0, 0, 1, 0, 0, 40] * 4).pattern == "LUMPY"
    assert pattern([0] * 35 + [1]).pattern == "NO_DEMAND"


def test_model_learns_and_forecasts(spark, tmp_path):
    frames = []
    for p in range(4):
        rows = [(f"P{p}", dt.date(2018 + i // 12, i % 12 + 1, 1), float(10 + 8 * np.sin(i * np.pi / 6 + p))) for i in range(48)]
        frames += rows
    h = spark.createDataFrame(frames, "part_number string, month date, demand_qty double")
    model = demand.train_demand_model(h, trees=10)
    assert model.metrics["mase_vs_naive"] < 1 and demand.publishable(model) is model
    made = demand.forecast_next(h, model).collect()
    assert len(made) == 12 and all(r.forecast_qty >= 0 for r in made) and {r.forecast_month for r in made} == {dt.date(2022, m, 1) for m in (1, 2, 3)}
    assert model.importances(spark).first().importance > 0
    saved = str(tmp_path / "m")
    sunday, monday = dt.date(2022, 1, 2), dt.date(2022, 1, 3)
    first = demand.refreshed_model(h, saved, monday, trees=10)  # none is there yet
    kept = demand.refreshed_model(h.limit(0), saved, monday)
    assert (kept.columns, kept.smearing, kept.kind, kept.metrics) == (first.columns, first.smearing, first.kind, first.metrics)
    again = demand.forecast_next(h, kept).collect()
    assert sorted(again) == sorted(demand.forecast_next(h, first).collect())
    assert demand.refreshed_model(h, saved, sunday, trees=3).metrics != first.metrics
    poisson = demand.train_demand_model(h, kind="poisson")
    assert poisson.metrics["n_test"] == 24
    with pytest.raises(ValueError):
        demand.train_demand_model(h.filter("month < '2018-11-01'"))


def test_registered_model_has_the_reference_parameters(monkeypatch):
    import inspect

    from partflow.plans import queries as plans

    default = {k: p.default for k, p in inspect.signature(demand.train_demand_model).parameters.items()}
    assert (default["trees"], default["rate"], default["depth"]) == (600, 0.05, 6)
    monkeypatch.setattr(plans, "_history", lambda *_: "history")
    monkeypatch.setattr(plans.V, "parts", lambda *_: "parts")
    monkeypatch.setattr(demand, "train_demand_model", lambda *args, **given: (args, given))
    assert plans._model(None, None) == (("history", "parts"), {})


def test_latest_snapshot_and_first_alert(spark):
    rows = [("A", dt.date(2024, 1, 1), 5), ("A", dt.date(2024, 2, 1), 0), ("B", dt.date(2024, 1, 1), 1)]
    df = spark.createDataFrame(rows, "part_number string, snapshot_date date, qty_available int")
    assert stock.latest_snapshot(df, "snapshot_date").count() == 1
    assert stock.latest_snapshot(df, "snapshot_date", df.filter("part_number = 'B'")).first().part_number == "B"
    scored = spark.createDataFrame([("A", dt.datetime(2024, 1, 30, 12, 30), "HIGH")], "part_number string, scored_at timestamp, risk_band string")
    assert views.early_warning_lead(scored, df).first().warning_lead_hours == 36


def test_the_panel_of_months_is_not_shuffled(spark):
    """Observed months are gathered by part; what is laid out of them takes the windows' one sort and no further shuffle."""
    months = [dt.date(2001, m, 1) for m in range(1, 7)]
    rows = [("a", months[1], 3.0), ("a", months[1], 4.0), ("a", months[5], None), ("b", dt.date(1999, 1, 1), 9.0)]
    observed = spark.createDataFrame(rows, "part_number string, month date, demand_qty double")
    history = demand.dense_history(observed, months[0], months[5])
    got = sorted((r["part_number"], r["month"], r["demand_qty"]) for r in history.collect())
    want = [("a", m, 0.0) for m in months if m != months[1]] + [("a", months[1], 3.0), ("a", months[1], 4.0)] + [("b", m, 0.0) for m in months]
    assert got == sorted(want)
    plan = demand.build_features(history)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1, plan


def test_part_master_sorts_engineering_rows_alone(spark):
    """Offers and stock are summed by hash; a part without a number is one row of all three sources."""
    erp = spark.createDataFrame([("P-1", "b"), ("P1", "a"), (None, "x")], "part_number string, description string")
    for c, t in {"ata_chapter": "string", "criticality": "string", "unit_cost_usd": "double", "shelf_life_months": "int", "repairable_flag": "boolean"}.items():
        erp = erp.withColumn(c, F.lit(None).cast(t))
    offers = spark.createDataFrame([("P1", "S1", 2.0, 3.0, 9), ("P1", "S2", 1.0, 4.0, 8), (None, "S1", 5.0, 1.0, 7)], "part_number string, supplier_id string, unit_price_usd double, qty_available double, quoted_lead_time_days int")
    wms = spark.createDataFrame([("P-1", "W1", 5, 6.0), ("P2", "W1", 1, 2.0)], "part_number string, warehouse_id string, qty_available int, qty_on_hand double")
    master = catalog.build_part_master(erp, offers, wms)
    got = {r["part_key"]: (r["erp_part_number"], r["description"], r["best_supplier_price_usd"], r["supplier_count"], r["supplier_qty_available"], r["qty_available"], r["stocking_locations"], r["single_source_flag"]) for r in master.collect()}
    assert got == {"P1": ("P-1", "b", 1.0, 2, 7.0, 5, 1, False), None: (None, "x", 5.0, 1, 1.0, 0, 0, True), "P2": (None, None, None, 0, 0.0, 1, 1, True)}
    plan = master._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and not [x for x in plan.split("\n") if "SortAggregate" in x and "offered" in x], plan
