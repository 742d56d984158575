"""DuckDB SQL for the registered queries, written from the definitions and not from the Spark code."""

from __future__ import annotations

import textwrap

AS_OF = "DATE '2001-08-02'"
_PN = "'PN-' || lpad(CAST({0} AS VARCHAR), 6, '0')"
_SUP = "'SUP-' || lpad(CAST({0} AS VARCHAR), 5, '0')"


def pn(c: str) -> str:
    return _PN.format(c)


def sup(c: str) -> str:
    return _SUP.format(c)


def inventory_sql(as_of: str, upto: str | None = None) -> str:
    cut = f"AND l_shipdate < CAST({upto} AS TIMESTAMP) + INTERVAL 1 DAY" if upto else ""
    return f"""
    SELECT warehouse_id, part_number, CAST(qty_on_hand AS DOUBLE) AS qty_on_hand, CAST(qty_reserved AS DOUBLE) AS qty_reserved,
      CAST(qty_quarantine AS DOUBLE) AS qty_quarantine,
      CASE WHEN condition_code IN ('NE', 'OH', 'SV') AND NOT coalesce(expiry_date < {as_of}, false)
        THEN greatest(qty_on_hand - qty_reserved - qty_quarantine, 0) ELSE 0 END AS qty_available,
      CAST(NULL AS VARCHAR) AS bin_location, condition_code, expiry_date, last_counted, 'WMS' AS source_system
    FROM (
      SELECT 'WH-' || (l_suppkey % 3) AS warehouse_id, {pn('l_partkey')} AS part_number, CAST(floor(sum(l_quantity) / 10) AS INT) AS qty_on_hand,
        CAST(count(*) AS INT) AS qty_reserved, CAST(sum(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) AS INT) AS qty_quarantine,
        CASE (l_partkey + l_suppkey % 3) % 10 WHEN 0 THEN 'AR' WHEN 1 THEN 'OH' WHEN 2 THEN 'SV' ELSE 'NE' END AS condition_code,
        CASE WHEN l_partkey % 5 = 0 THEN CAST(CAST(max(l_shipdate) AS DATE) + 365 AS DATE) END AS expiry_date, CAST(max(l_shipdate) AS DATE) AS last_counted
      FROM lineitem WHERE l_returnflag = 'R' {cut} GROUP BY l_suppkey % 3, l_partkey)"""


def profile_sql(keys: str, deliveries: str, as_of: str) -> str:
    """Weighted profile, each quantile by interpolation between all deliveries of a key."""
    quantile = lambda q: f"""max(CASE WHEN {q} <= p AND rn = 1 THEN v WHEN {q} >= p AND np IS NULL THEN v
        WHEN {q} >= p AND {q} < np THEN v + ({q} - p) / (np - p) * (nv - v) END)"""  # noqa: E731
    return f"""
    SELECT {keys}, count(*) AS n_deliveries, {quantile(0.5)} AS p50_days, {quantile(0.8)} AS p80_days, {quantile(0.95)} AS p95_days,
      sum(w * v) / sum(w) AS mean_days, sqrt(greatest(sum(w * v * v) / sum(w) - (sum(w * v) / sum(w)) * (sum(w * v) / sum(w)), 0)) AS volatility_days,
      sum(CASE WHEN on_time THEN w ELSE 0 END) / sum(w) AS on_time_rate, sum(w * slip_days) / sum(w) AS avg_slip_days,
      CASE WHEN count(*) >= 3 AND min(x) < max(x) THEN regr_slope(v, x) ELSE 0 END AS trend_days_per_year,
      CASE WHEN count(*) >= 20 THEN 'HIGH' WHEN count(*) >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS confidence
    FROM (SELECT *, lead(p) OVER (PARTITION BY {keys} ORDER BY v, w, rn) AS np, lead(v) OVER (PARTITION BY {keys} ORDER BY v, w, rn) AS nv
          FROM (SELECT *, row_number() OVER k AS rn, (sum(w) OVER (k ROWS UNBOUNDED PRECEDING) - w / 2) / sum(w) OVER (PARTITION BY {keys}) AS p
                FROM (SELECT *, CAST(actual_lead_time_days AS DOUBLE) AS v, pow(0.5, greatest(date_diff('day', order_date, {as_of}), 0) / 180.0) AS w,
                        date_diff('day', {as_of}, order_date) / 365.0 AS x FROM {deliveries})
                WINDOW k AS (PARTITION BY {keys} ORDER BY v, w, po_number, po_line, part_number, quantity)))
    GROUP BY {keys}"""


def features_sql(history: str) -> str:
    lags = ", ".join(f"lag(demand_qty, {k}) OVER w AS lag_{k}" for k in (1, 2, 3, 6, 12))
    rolling = ", ".join(
        f"avg(demand_qty) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS roll_mean_{n}, stddev_samp(demand_qty) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS roll_std_{n}, max(demand_qty) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS roll_max_{n}, avg(had) OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS roll_nonzero_{n}"
        for n in (3, 6, 12)
    )
    return f"""SELECT part_number, month, demand_qty, {lags}, {rolling}, row_number() OVER w - 1 AS tenure_months,
        row_number() OVER w - coalesce(max(CASE WHEN had = 1 THEN rn END) OVER (w ROWS UNBOUNDED PRECEDING), 1) AS months_since_demand
      FROM (SELECT *, row_number() OVER (PARTITION BY part_number ORDER BY month) AS rn, CASE WHEN lag(demand_qty) OVER (PARTITION BY part_number ORDER BY month) > 0 THEN 1 ELSE 0 END AS had FROM {history} )
      WINDOW w AS (PARTITION BY part_number ORDER BY month)"""


#: Terms of the given linear model (``queries.LINEAR``).
_TERMS = {
    "lag_1": (0.004, "coalesce(lag_1, 0)"), "lag_12": (0.002, "coalesce(lag_12, 0)"), "roll_mean_3": (0.006, "coalesce(roll_mean_3, 0)"), "roll_mean_12": (0.01, "coalesce(roll_mean_12, 0)"),
    "roll_std_6": (0.001, "coalesce(roll_std_6, 0)"), "roll_nonzero_6": (0.6, "coalesce(roll_nonzero_6, 0)"), "months_since_demand": (-0.02, "months_since_demand"),
    "month_sin": (0.05, "sin(2 * pi() * month(month) / 12)"), "log_unit_cost": (0.01, "ln(1 + coalesce(unit_cost_usd, 0))"),
}


def linear_sql(features: str) -> str:
    return f"SELECT *, 0.4::DOUBLE + {' + '.join(f'({k}::DOUBLE) * ({x})' for k, x in _TERMS.values())} AS y FROM {features} LEFT JOIN (SELECT part_number, unit_cost_usd FROM parts_ ) USING (part_number)"


def deliveries_sql(as_of: str) -> str:
    return f"""
    SELECT * FROM (
      SELECT *, date_diff('day', order_date, actual_delivery_date) AS actual_lead_time_days, date_diff('day', promised_date, actual_delivery_date) AS slip_days,
        date_diff('day', promised_date, actual_delivery_date) BETWEEN -30 AND 0 AS on_time
      FROM orders_ WHERE actual_delivery_date IS NOT NULL AND order_date >= {as_of} - 730)
    WHERE actual_lead_time_days >= 0"""


def card_sql(as_of: str) -> str:
    return f"""
    SELECT *, CASE WHEN composite_score <= 50 THEN 'CRITICAL' WHEN composite_score <= 70 THEN 'WATCH' WHEN composite_score <= 85 THEN 'ACCEPTABLE' ELSE 'PREFERRED' END AS risk_tier,
      round_even(p80_days - base_lead_time_days, 1) AS contract_gap_days
    FROM (SELECT *, round_even(otd, 1) AS otd_score, round_even(consistency, 1) AS consistency_score, round_even(trend, 1) AS trend_score,
            round_even(0.55 * otd + 0.30 * consistency + 0.15 * trend, 1) AS composite_score
          FROM (SELECT *, on_time_rate * 100 AS otd, (1 - least(greatest(volatility_days / greatest(p50_days, 1), 0), 1)) * 100 AS consistency,
                  (1 - (least(greatest(trend_days_per_year, -30), 30) + 30) / 60) * 100 AS trend
                FROM ({profile_sql('supplier_id', '(' + deliveries_sql(as_of) + ')', as_of)})))
    LEFT JOIN (SELECT supplier_id, supplier_name, country, base_lead_time_days FROM suppliers_) USING (supplier_id)"""


def risk_sql(as_of: str, upto: str | None = None) -> str:
    """Scores with the unrounded factors f_*."""
    return f"""
    SELECT *, CASE WHEN aog_risk_score >= 80 THEN 'CRITICAL' WHEN aog_risk_score >= 60 THEN 'HIGH' WHEN aog_risk_score >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band,
      CASE greatest(0.30 * f_criticality, 0.28 * f_coverage, 0.20 * f_replenishment, 0.12 * f_supplier, 0.10 * f_customs) WHEN 0.30 * f_criticality THEN 'criticality'
        WHEN 0.28 * f_coverage THEN 'coverage' WHEN 0.20 * f_replenishment THEN 'replenishment' WHEN 0.12 * f_supplier THEN 'supplier' ELSE 'customs' END AS primary_driver,
      {as_of} AS scored_at, 45 AS horizon_days
    FROM (
      SELECT *, CASE WHEN aog_wo_demand > 0 AND qty_available < aog_wo_demand THEN 100.0
          ELSE round_even((0.30 * f_criticality + 0.28 * f_coverage + 0.20 * f_replenishment + 0.12 * f_supplier + 0.10 * f_customs) * 100, 1) END AS aog_risk_score
      FROM (
        SELECT part_number, criticality, ata_chapter, unit_cost_usd, qty_available, monthly_demand, firm_wo_demand, aog_wo_demand,
          CASE WHEN monthly_demand > 0 THEN round_even(cover, 1) ELSE 9999 END AS days_of_cover,
          CASE criticality WHEN 'NO_GO' THEN 1.0::DOUBLE WHEN 'GO_IF' THEN 0.55::DOUBLE WHEN 'GO' THEN 0.15::DOUBLE ELSE 0.5::DOUBLE END AS f_criticality,
          CASE WHEN monthly_demand > 0 THEN least(greatest((daily * 45 - qty_available) / (daily * 45), 0), 1) ELSE 0 END AS f_coverage,
          CASE WHEN cover IS NULL OR cover >= 45 THEN 0 WHEN next_receipt IS NULL THEN 1
            ELSE least(greatest((date_diff('day', {as_of}, next_receipt) - cover) / 45.0, 0), 1) END AS f_replenishment,
          coalesce(least(greatest(1 - on_time_rate, 0), 1), 0.5) AS f_supplier, coalesce(customs_risk, 0) AS f_customs
        FROM (
          SELECT p.*, coalesce(i.q, 0)::DOUBLE AS qty_available, coalesce(m.monthly_demand, 0)::DOUBLE AS monthly_demand, coalesce(w.firm, 0)::DOUBLE AS firm_wo_demand,
            coalesce(w.aog, 0)::DOUBLE AS aog_wo_demand, coalesce(m.monthly_demand, 0) / 30.0 AS daily,
            CASE WHEN m.monthly_demand > 0 THEN coalesce(i.q, 0) / (m.monthly_demand / 30.0) END AS cover, o.next_receipt, s.on_time_rate, c.customs_risk
          FROM (SELECT part_number, criticality, ata_chapter, unit_cost_usd FROM parts_) AS p
          LEFT JOIN (SELECT part_number, sum(qty_available) AS q FROM ({inventory_sql(as_of, upto)}) GROUP BY 1) AS i USING (part_number)
          LEFT JOIN (SELECT part_number, avg(demand_qty) AS monthly_demand FROM history_ GROUP BY 1) AS m USING (part_number)
          LEFT JOIN (SELECT part_number, sum(qty_required) AS firm, sum(CASE WHEN wo_type = 'AOG' THEN qty_required END) AS aog FROM work_ WHERE status = 'OPEN' GROUP BY 1) AS w USING (part_number)
          LEFT JOIN (SELECT part_number, min(promised_date) AS next_receipt, arg_min(supplier_id, (promised_date, po_number, po_line, supplier_id)) AS supplier_id
                     FROM orders_ WHERE status = 'OPEN' GROUP BY 1) AS o USING (part_number)
          LEFT JOIN (SELECT supplier_id, on_time_rate FROM card_) AS s ON s.supplier_id = o.supplier_id
          LEFT JOIN (SELECT part_number, max(customs_risk) AS customs_risk FROM customs_risk_ GROUP BY 1) AS c USING (part_number))))"""


def key_sql(c: str) -> str:
    return f"""regexp_replace(regexp_replace(regexp_replace(upper(trim({c})), '\\s*(REV|REVISION)\\s*[A-Z0-9]+$', ''), '/[A-Z0-9]{{1,3}}$', ''), '[^A-Z0-9]', '', 'g')"""


DATES = ("2001-05-31", "2001-06-30", "2001-07-31")
CARD_DATES = ("1999-09-30", "1999-12-31", "2000-03-31", "2000-06-30", "2000-09-30", "2000-12-31", "2001-03-31", "2001-06-30")
_ADS = {d: f"DATE '{d}'" for d in (*DATES, *CARD_DATES)}

CTE = {
    "parts_": f"""SELECT {pn('p_partkey')} AS part_number, p_name AS description, p_type AS ata_chapter, upper(p_type[1]) || lower(p_type[2:]) AS ata_chapter_name,
      CASE WHEN p_size <= 8 THEN 'NO_GO' WHEN p_size <= 25 THEN 'GO_IF' ELSE 'GO' END AS criticality, p_retailprice AS unit_cost_usd,
      p_partkey % 5 < 2 AS repairable_flag, p_partkey % 3 = 0 AS single_source_flag, p_partkey FROM part""",
    "suppliers_": f"""SELECT {sup('s_suppkey')} AS supplier_id, s_name AS supplier_name, n_name AS country, CAST(30 + (s_suppkey * 37) % 510 AS INT) AS base_lead_time_days,
      s_suppkey % 10 <> 0 AS approved_vendor FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "orders_": f"""SELECT 'PO-' || l_orderkey AS po_number, l_linenumber AS po_line, {pn('l_partkey')} AS part_number, {sup('l_suppkey')} AS supplier_id, l_quantity AS quantity,
      l_extendedprice / l_quantity AS unit_price_usd, CAST(o_orderdate AS DATE) AS order_date, CAST(CAST(o_orderdate AS DATE) + CAST(30 + (l_suppkey * 37) % 510 AS INT) AS DATE) AS promised_date,
      CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS actual_delivery_date, CASE WHEN l_linestatus = 'F' THEN 'DELIVERED' ELSE 'OPEN' END AS status
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "work_": f"""SELECT 'WO-' || o_orderkey AS work_order_id, 'AC-' || min(o_custkey) AS aircraft_reg, {pn('min(l_partkey)')} AS part_number, max(l_quantity) AS qty_required,
      CASE min(o_orderpriority) WHEN '1-URGENT' THEN 'AOG' WHEN '2-HIGH' THEN 'UNSCHEDULED' ELSE 'SCHEDULED' END AS wo_type, CAST(min(o_orderdate) AS DATE) AS opened_date,
      CASE WHEN min(o_orderstatus) = 'O' AND CAST(min(o_orderdate) AS DATE) >= DATE '2001-04-04' THEN 'OPEN' ELSE 'CLOSED' END AS status
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
    "customs_": f"""SELECT 'AWB' || l_orderkey || '-' || l_linenumber AS awb, 'PO-' || l_orderkey AS po_number, {pn('l_partkey')} AS part_number, l_quantity AS quantity,
      CASE (l_orderkey + l_linenumber) % 5 WHEN 0 THEN 'IN_TRANSIT' WHEN 1 THEN 'AT_CUSTOMS' WHEN 2 THEN 'HELD' WHEN 3 THEN 'CLEARED' ELSE 'DELIVERED' END AS clearance_status,
      CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE CAST(l_orderkey % 21 + 1 AS INT) END AS estimated_clearance_days
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'O' AND o_orderdate >= TIMESTAMP '2001-04-04'""",
    "projected_": f"""SELECT *, CASE clearance_status WHEN 'IN_TRANSIT' THEN 0 WHEN 'AT_CUSTOMS' THEN 1 WHEN 'HELD' THEN 2 WHEN 'CLEARED' THEN 3 ELSE 4 END AS clearance_stage,
      CAST({AS_OF} + coalesce(estimated_clearance_days, CASE clearance_status WHEN 'IN_TRANSIT' THEN 3 WHEN 'AT_CUSTOMS' THEN 5 WHEN 'HELD' THEN 14 WHEN 'CLEARED' THEN 1 ELSE 0 END) AS DATE) AS projected_clearance_date,
      clearance_status = 'HELD' AS is_held FROM customs_""",
    "customs_risk_": f"""SELECT po_number, part_number, max(CASE WHEN clearance_status IN ('CLEARED', 'DELIVERED') THEN 0 WHEN is_held THEN 1
      ELSE least(greatest(date_diff('day', {AS_OF}, projected_clearance_date), 0) / 21.0, 1) END) AS customs_risk, max(projected_clearance_date) AS projected_clearance_date
      FROM projected_ GROUP BY 1, 2""",
    "inventory_": inventory_sql(AS_OF),
    "observed_": f"""SELECT {pn('l_partkey')} AS part_number, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(l_quantity) AS demand_qty FROM lineitem
      WHERE l_returnflag <> 'R' AND l_shipdate < TIMESTAMP '2001-08-01' GROUP BY 1, 2""",
    "history_": """SELECT part_number, month, coalesce(demand_qty, 0)::DOUBLE AS demand_qty FROM (SELECT DISTINCT part_number FROM observed_) CROSS JOIN
      (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-07-01', INTERVAL 1 MONTH)) AS DATE) AS month) LEFT JOIN observed_ USING (part_number, month)""",
    "card_": card_sql(AS_OF),
    "risk_": risk_sql(AS_OF),
    "profile_": """SELECT part_number, months_observed, monthly_demand, demand_std, zero_month_pct, peak_month_qty, avg_nonzero_qty, pattern,
      pattern IN ('SMOOTH', 'ERRATIC') AND months_observed >= 18 AS forecastable
      FROM (SELECT *, CASE WHEN n < 2 THEN 'NO_DEMAND' WHEN months_observed / n < 1.32 AND cv2 < 0.49 THEN 'SMOOTH' WHEN months_observed / n < 1.32 THEN 'ERRATIC'
              WHEN cv2 < 0.49 THEN 'INTERMITTENT' ELSE 'LUMPY' END AS pattern
            FROM (SELECT part_number, count(*) AS months_observed, avg(demand_qty) AS monthly_demand, coalesce(stddev_samp(demand_qty), 0) AS demand_std,
                    round_even(100 * avg(CASE WHEN demand_qty = 0 THEN 1.0 ELSE 0.0 END), 1) AS zero_month_pct, max(demand_qty) AS peak_month_qty,
                    coalesce(avg(demand_qty) FILTER (demand_qty > 0), 0) AS avg_nonzero_qty, count(*) FILTER (demand_qty > 0) AS n,
                    pow(coalesce(stddev_samp(demand_qty) FILTER (demand_qty > 0), 0) / avg(demand_qty) FILTER (demand_qty > 0), 2) AS cv2
                  FROM history_ GROUP BY part_number))""",
    "early_": f"""SELECT part_number, criticality, qty_available, days_of_cover, round_even(days_of_cover * 24, 0) AS warning_hours,
      CAST({AS_OF} + to_seconds(CAST(round_even(days_of_cover * 86400, 0) AS BIGINT)) AS DATE) AS projected_stockout_date
      FROM risk_ WHERE qty_available > 0 AND days_of_cover < 45""",
    "cards_": " UNION ALL ".join(f"SELECT *, {_ADS[d]} AS as_of_date FROM ({card_sql(_ADS[d])})" for d in CARD_DATES),
    "latest_": """SELECT l.* EXCLUDE (supplier_name, country, base_lead_time_days), s.supplier_name, s.country, s.base_lead_time_days, s.approved_vendor
      FROM (SELECT * FROM cards_ QUALIFY row_number() OVER (PARTITION BY supplier_id ORDER BY as_of_date DESC) = 1) AS l JOIN suppliers_ AS s USING (supplier_id)""",
    "snapshots_": " UNION ALL ".join(f"SELECT *, {_ADS[d]} AS snapshot_date FROM ({inventory_sql(_ADS[d], _ADS[d])})" for d in DATES),
    "risks_": " UNION ALL ".join(f"SELECT * FROM ({risk_sql(_ADS[d], _ADS[d])})" for d in DATES),
    "blocked_": f"""SELECT w.work_order_id, w.aircraft_reg, w.wo_type, w.opened_date, date_diff('day', w.opened_date, {AS_OF})::INT AS days_open, w.part_number, p.description, p.criticality,
      w.qty_required, coalesce(s.q, 0)::BIGINT AS qty_available, w.qty_required - coalesce(s.q, 0) AS shortfall, r.aog_risk_score, r.risk_band, r.primary_driver, po.promised_date AS next_receipt_date
      FROM work_ AS w JOIN parts_ AS p USING (part_number)
      LEFT JOIN (SELECT part_number, sum(qty_available) AS q FROM snapshots_ WHERE snapshot_date = (SELECT max(snapshot_date) FROM snapshots_) GROUP BY 1) AS s USING (part_number)
      LEFT JOIN (SELECT * FROM risks_ WHERE scored_at = (SELECT max(scored_at) FROM risks_)) AS r USING (part_number)
      LEFT JOIN (SELECT * FROM orders_ WHERE status = 'OPEN') AS po USING (part_number)
      WHERE w.status = 'OPEN' AND w.qty_required > coalesce(s.q, 0)
      QUALIFY row_number() OVER (PARTITION BY w.work_order_id ORDER BY po.promised_date NULLS LAST) = 1""",
    "offers_": "SELECT part_number, supplier_id, unit_price_usd, quantity, date_diff('day', order_date, promised_date) AS days FROM orders_ WHERE status = 'OPEN'",
    "features_": features_sql("history_"),
    "linear_": linear_sql("features_"),
    "smear_": "SELECT avg(exp(ln(1 + demand_qty) - y)) AS smearing FROM linear_ WHERE tenure_months >= 12 AND month < DATE '2001-02-01'",
    **{name: text for k in (1, 2, 3) for name, text in (
        (f"before_{k}_", "SELECT part_number, month, demand_qty FROM history_ " + "".join(f" UNION ALL SELECT part_number, forecast_month, forecast_qty FROM step_{j}_ " for j in range(1, k)) + f" UNION ALL SELECT DISTINCT part_number, DATE '2001-{7 + k:02d}-01', CAST(NULL AS DOUBLE) FROM history_ "),
        (f"features_{k}_", f"SELECT * FROM ({features_sql(f'before_{k}_')}) WHERE month = DATE '2001-{7 + k:02d}-01'"),
        (f"linear_{k}_", linear_sql(f"features_{k}_")),
        (f"step_{k}_", f"SELECT part_number, month AS forecast_month, {k} AS horizon_step, round_even(greatest((exp(y) - 1) * smearing, 0), 2) AS forecast_qty FROM linear_{k}_ , smear_ "),
    )},
    "candidates_": "SELECT user_id AS part_number, ts AS alert_ts, event_id AS alert_id, value AS score FROM events WHERE event_type = 'error'",
    "first_": "SELECT po_number, po_line, min(quantity) AS quantity, max(status) AS status FROM orders_ GROUP BY 1, 2",
    "base_": "SELECT part_number, criticality, unit_cost_usd, part_number AS master_part_number, false AS is_superseded, p_partkey % 7 = 0 AS changed, p_partkey % 10 <> 9 AS early FROM parts_",
    "dim_": """SELECT part_number, criticality, unit_cost_usd, master_part_number, is_superseded, '2001-01-01' AS valid_from, CASE WHEN changed THEN '2001-08-02' END AS valid_to, NOT changed AS is_current FROM base_ WHERE early
      UNION ALL SELECT part_number, criticality, CASE WHEN changed THEN unit_cost_usd + 1 ELSE unit_cost_usd END, master_part_number, is_superseded, '2001-08-02', NULL, true FROM base_ WHERE changed OR NOT early""",
}


def sql(body: str) -> str:
    """The body with the named tables that it and they use, in order."""
    need: set[str] = set()

    def add(text: str) -> None:
        for name, definition in CTE.items():
            if name not in need and name in text.replace("(", " ").replace(")", " ").replace(",", " ").split():
                need.add(name)
                add(definition)

    add(body)
    named = [f"{n} AS (\n{textwrap.dedent(d)})" for n, d in CTE.items() if n in need]
    if body.startswith("--ctes"):  # tables of its own, which may refer to themselves
        return "WITH RECURSIVE " + ",\n".join([*named, body.removeprefix("--ctes")])
    return "WITH " + ",\n".join(named) + "\n" + body if named else body


def r(columns: str, digits: int = 4) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns.split())


_MEASURES = "p50_days p80_days p95_days mean_days volatility_days on_time_rate avg_slip_days trend_days_per_year"
_FACTORS = "f_criticality f_coverage f_replenishment f_supplier f_customs"
_ACTION = """CASE primary_driver WHEN 'criticality' THEN 'Review MEL coverage; confirm alternate/PMA part approved' WHEN 'coverage' THEN 'Raise replenishment PO; check sister-station stock for loan'
  WHEN 'replenishment' THEN 'Expedite open PO with supplier; request partial shipment' WHEN 'supplier' THEN 'Escalate to supplier quality; dual-source this part number'
  ELSE 'Chase broker on clearance; verify EASA Form 1 / FAA 8130-3 paperwork' END"""
_MASTER = f"""--ctes edge AS (SELECT {key_sql(pn('p_partkey'))} AS old, {key_sql(pn('p_partkey + 1'))} AS new FROM part WHERE p_partkey % 16 < 6),
walk AS (SELECT old, new, 1 AS n FROM edge UNION ALL SELECT walk.old, edge.new, n + 1 FROM walk JOIN edge ON walk.new = edge.old),
top AS (SELECT old AS part_key, arg_max(new, n) AS master FROM walk GROUP BY 1),
k AS (SELECT {key_sql('part_number')} AS part_key, * FROM parts_ JOIN (SELECT p_partkey, (p_size % 5) * 12 AS shelf FROM part) USING (p_partkey)),
o AS (SELECT {key_sql('part_number')} AS part_key, min(days) AS days, min(unit_price_usd) AS price, count(DISTINCT supplier_id) AS n, sum(quantity) AS q FROM offers_ GROUP BY 1),
i AS (SELECT {key_sql('part_number')} AS part_key, sum(qty_available) AS q, sum(qty_on_hand) AS h, count(DISTINCT warehouse_id) AS n FROM inventory_ GROUP BY 1),
master AS (
  SELECT part_key, shelf AS shelf_life_months, coalesce(master, part_key) AS master_part_key, part_number AS erp_part_number, description, ata_chapter, criticality, round(unit_cost_usd, 6) AS unit_cost_usd, repairable_flag,
    days::INT AS best_quoted_lead_time_days, round(price, 6) AS best_supplier_price_usd, coalesce(o.n, 0) AS supplier_count, coalesce(o.q, 0)::DOUBLE AS supplier_qty_available,
    coalesce(i.q, 0)::BIGINT AS qty_available, coalesce(i.h, 0)::DOUBLE AS qty_on_hand, coalesce(i.n, 0) AS stocking_locations, sha256(coalesce(master, part_key))[1:16] AS part_uid,
    master IS NOT NULL AS is_superseded, coalesce(o.n, 0) <= 1 AS single_source_flag
  FROM (SELECT part_key FROM k UNION SELECT part_key FROM o UNION SELECT part_key FROM i) LEFT JOIN top USING (part_key) LEFT JOIN k USING (part_key) LEFT JOIN o USING (part_key) LEFT JOIN i USING (part_key))
"""

ORACLES = {
    "normalize_part_numbers": f"""SELECT part_number, spelling, {key_sql('spelling')} AS part_key, sha256({key_sql('spelling')})[1:16] AS part_uid
      FROM (SELECT part_number, unnest([part_number, replace(part_number, '-', ''), lower(replace(part_number, '-', ' ')) || ' rev b', part_number || '/B']) AS spelling FROM parts_ )""",
    "unpad_material_numbers": "SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 18, '0') AS padded, CASE WHEN p_partkey = 0 THEN repeat('0', 18) ELSE CAST(p_partkey AS VARCHAR) END AS part_number FROM part",
    "part_master": _MASTER + "SELECT * FROM master",
    "catalog_coverage": _MASTER + """SELECT count(*) AS total_parts, count(*) FILTER (description IS NULL) AS missing_description, count(*) FILTER (criticality IS NULL) AS missing_criticality,
      count(*) FILTER (supplier_count = 0) AS no_supplier_link, count(*) FILTER (single_source_flag) AS single_sourced, count(*) FILTER (is_superseded) AS superseded_parts,
      round(100.0 * count(criticality) / count(*), 2) AS criticality_coverage_pct FROM master""",
    "supersession_closure": _MASTER + "SELECT part_key, master AS master_part_key, false AS in_cycle FROM top",
    "salted_join": "SELECT l_suppkey, s_name, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2",
    "prepare_deliveries": f"SELECT po_number, po_line, part_number, supplier_id, order_date, actual_lead_time_days::INT AS actual_lead_time_days, slip_days::INT AS slip_days, on_time FROM ({deliveries_sql(AS_OF)}) AS x, (SELECT count(*) FROM orders_ ) AS y",
    "lead_time_profiles": f"SELECT supplier_id, n_deliveries, {r(_MEASURES)}, confidence FROM card_ ",
    "supplier_part_lead_times": f"""SELECT supplier_id, part_number, CASE WHEN p.n_deliveries >= 5 THEN p.n_deliveries ELSE s.n_deliveries END AS n_deliveries,
      {', '.join(f'round(CASE WHEN p.n_deliveries >= 5 THEN p.{c} ELSE s.{c} END, 3) AS {c}' for c in _MEASURES.split())}, CASE WHEN p.n_deliveries >= 5 THEN p.confidence ELSE 'FALLBACK' END AS confidence
      FROM ({profile_sql('supplier_id, part_number', '(' + deliveries_sql(AS_OF) + ')', AS_OF)}) AS p JOIN card_ AS s USING (supplier_id) """,
    "supplier_scorecard": f"SELECT supplier_id, n_deliveries, {r(_MEASURES)}, confidence, otd_score, consistency_score, trend_score, composite_score, risk_tier, supplier_name, country, base_lead_time_days, round(contract_gap_days, 4) AS contract_gap_days FROM card_ ",
    "normalize_inventory": "SELECT * FROM inventory_ ",
    "stock_accuracy": f"""SELECT count(*) AS records, round_even(100 * avg(CASE WHEN last_counted < {AS_OF} - 90 THEN 1.0 ELSE 0.0 END), 1) AS stale_pct,
      round_even(100 * avg(CASE WHEN last_counted < {AS_OF} - 90 THEN 0.0 ELSE 1.0 END), 1) AS trusted_pct FROM inventory_ """,
    "union_inventory": """SELECT warehouse_id, count(*) AS n, sum(qty_available)::BIGINT AS qty_available FROM inventory_ GROUP BY 1
      UNION ALL SELECT 'SUPPLIER_STOCK', count(DISTINCT part_number), sum(quantity)::BIGINT FROM offers_ """,
    "customs_projection": "SELECT * FROM projected_ ",
    "customs_risk": "SELECT po_number, part_number, round(customs_risk, 6) AS customs_risk, projected_clearance_date FROM customs_risk_ ",
    "open_orders": "SELECT po_number, po_line, part_number, supplier_id, quantity, promised_date AS expected_date FROM orders_ WHERE status = 'OPEN'",
    "aog_factors": f"SELECT part_number, qty_available, round(monthly_demand, 4) AS monthly_demand, firm_wo_demand, aog_wo_demand, days_of_cover, {r(_FACTORS)} FROM risk_ ",
    "aog_risk": f"""SELECT part_number, criticality, ata_chapter, unit_cost_usd, qty_available, round(monthly_demand, 4) AS monthly_demand, firm_wo_demand, aog_wo_demand, days_of_cover, aog_risk_score,
      risk_band, primary_driver, horizon_days, {', '.join(f'round_even({f}, 3) AS {f.replace("f_", "factor_")}' for f in _FACTORS.split())} FROM risk_ """,
    "recommended_actions": f"SELECT part_number, criticality, aog_risk_score, risk_band, qty_available, days_of_cover, primary_driver, {_ACTION} AS recommended_action FROM risk_ ORDER BY aog_risk_score DESC, part_number LIMIT 25",
    "early_warning": "SELECT part_number, qty_available, days_of_cover, warning_hours, projected_stockout_date FROM early_ ",
    "aog_summary": """SELECT count(*) AS parts_scored, count(*) FILTER (risk_band = 'CRITICAL') AS critical_count, count(*) FILTER (risk_band = 'HIGH') AS high_count,
      count(*) FILTER (criticality = 'NO_GO' AND aog_risk_score >= 60) AS no_go_at_risk, round_even(100 * avg(CASE WHEN aog_risk_score >= 60 THEN 1.0 ELSE 0.0 END), 1) AS pct_at_risk,
      round(coalesce(sum(unit_cost_usd) FILTER (aog_risk_score >= 60), 0), 2) AS value_at_risk_usd FROM risk_ """,
    "run_kpis": """SELECT 'supplier_tiers' AS kpi, risk_tier AS label, count(*)::DOUBLE AS value FROM card_ GROUP BY 2
      UNION ALL SELECT 'risk_bands', risk_band, count(*) FROM risk_ GROUP BY 2 UNION ALL SELECT 'demand_patterns', pattern, count(*) FROM profile_ GROUP BY 2
      UNION ALL SELECT 'drivers_at_risk', primary_driver, count(*) FROM risk_ WHERE aog_risk_score >= 60 GROUP BY 2 UNION ALL SELECT 'median_contract_gap_days', NULL, round(median(contract_gap_days), 3) FROM card_
      UNION ALL SELECT 'fleet_otd_pct', NULL, round(100 * avg(on_time_rate), 3) FROM card_ UNION ALL SELECT 'median_warning_hours', NULL, round(median(warning_hours), 3) FROM early_
      UNION ALL SELECT 'warned_in_time', NULL, count(*) FILTER (warning_hours >= 72) FROM early_ UNION ALL SELECT 'no_go_warned', NULL, count(*) FILTER (criticality = 'NO_GO') FROM early_
      UNION ALL SELECT 'parts_unified', NULL, count(DISTINCT part_number) FROM risk_ """,
    "demand_features": f"""SELECT f.part_number, month, demand_qty, lag_1, lag_2, lag_3, lag_6, lag_12, tenure_months::INT AS tenure_months, months_since_demand::INT AS months_since_demand,
      {', '.join(r(f'roll_mean_{n} roll_std_{n} roll_max_{n} roll_nonzero_{n}', 8) for n in (3, 6, 12))}, round(CASE WHEN roll_mean_12 <> 0 THEN roll_mean_3 / roll_mean_12 END, 8) AS momentum_3_12,
      month(month)::INT AS month_num, round(sin(2 * pi() * month(month) / 12), 8) + 0.0 AS month_sin, round(cos(2 * pi() * month(month) / 12), 8) + 0.0 AS month_cos, coalesce(code, -1)::INT AS ata_chapter,
      CASE criticality WHEN 'NO_GO' THEN 2 WHEN 'GO_IF' THEN 1 WHEN 'GO' THEN 0 ELSE -1 END AS criticality_code, round(ln(1 + coalesce(unit_cost_usd, 0)), 8) AS log_unit_cost,
      CASE WHEN repairable_flag THEN 1 ELSE 0 END AS repairable_flag
      FROM features_ AS f LEFT JOIN parts_ USING (part_number) LEFT JOIN (SELECT ata_chapter, row_number() OVER (ORDER BY ata_chapter) - 1 AS code FROM (SELECT DISTINCT ata_chapter FROM parts_ )) USING (ata_chapter)""",
    "demand_profile": f"SELECT part_number, months_observed, {r('monthly_demand demand_std')}, zero_month_pct, peak_month_qty, round(avg_nonzero_qty, 4) AS avg_nonzero_qty, pattern, forecastable FROM profile_ ",
    "naive_forecast_metrics": """SELECT count(*) AS n_test, round(avg(abs(g)), 4) AS mae, round(sqrt(avg(g * g)), 4) AS rmse, round(avg(g), 4) AS bias, round(avg(abs(z)), 4) AS naive_mae,
      round(avg(abs(g)) / avg(abs(z)), 4) AS mase_vs_naive FROM (SELECT coalesce(roll_mean_12, 0) - demand_qty AS g, coalesce(lag_1, 0) - demand_qty AS z FROM features_ WHERE tenure_months >= 12 AND month >= DATE '2001-02-01')""",
    "linear_model": " UNION ALL ".join(f"SELECT '{c}' AS feature, round(abs({k}) * stddev_samp(({x})::DOUBLE), 6) AS importance, (SELECT round(smearing, 6) FROM smear_ ) AS smearing FROM linear_ WHERE tenure_months >= 12 AND month < DATE '2001-02-01'" for c, (k, x) in _TERMS.items()),
    "linear_metrics": """SELECT count(*) AS n_test, round(avg(abs(g)), 4) AS mae, round(sqrt(avg(g * g)), 4) AS rmse, round(avg(g), 4) AS bias, round(avg(abs(z)), 4) AS naive_mae, round(avg(abs(g)) / avg(abs(z)), 4) AS mase_vs_naive
      FROM (SELECT greatest((exp(y) - 1) * smearing, 0) - demand_qty AS g, coalesce(lag_1, 0) - demand_qty AS z FROM linear_ , smear_ WHERE tenure_months >= 12 AND month >= DATE '2001-02-01')""",
    "linear_forecast": """SELECT f.*, pattern, forecastable FROM (SELECT * FROM step_1_ UNION ALL SELECT * FROM step_2_ UNION ALL SELECT * FROM step_3_ ) AS f LEFT JOIN profile_ USING (part_number)""",
    "nearest_demand": "SELECT part_number, forecast_qty FROM step_1_ ",
    "upsert_orders": """SELECT po_number, po_line, CASE WHEN po_line <= 2 THEN quantity + 1 ELSE quantity END AS quantity, status, CASE WHEN po_line <= 2 THEN 'b2' ELSE 'b1' END AS _batch_id FROM first_
      UNION ALL SELECT po_number, po_line + 100, quantity, NULL, 'b2' FROM first_ WHERE po_line = 3""",
    "rollback_batch": "SELECT po_number, po_line, quantity, status, 'b1' AS _batch_id FROM first_ WHERE po_line > 2",
    "scd2_parts": "SELECT * FROM dim_ ",
    "current_parts": "SELECT part_number, criticality, unit_cost_usd FROM dim_ WHERE is_current",
    "parts_by_chapter": """SELECT ata_chapter, ata_chapter_name, count(*) AS part_count, count(*) FILTER (criticality = 'NO_GO') AS no_go_parts, count(*) FILTER (single_source_flag) AS single_sourced_parts,
      round(avg(unit_cost_usd), 2) AS avg_unit_cost_usd FROM parts_ GROUP BY 1, 2""",
    "latest_scorecard": f"SELECT supplier_id, supplier_name, country, approved_vendor, as_of_date, n_deliveries, base_lead_time_days, round(contract_gap_days, 4) AS contract_gap_days, {r('p80_days on_time_rate volatility_days trend_days_per_year')}, round(on_time_rate * 100, 1) AS on_time_pct, composite_score, risk_tier, confidence FROM latest_ ",
    "supplier_trend": """SELECT supplier_id, qtr, round(s, 1) AS avg_score, round(o, 1) AS avg_otd_pct, round(s - lag(s) OVER (PARTITION BY supplier_id ORDER BY qtr), 1) AS score_delta_qoq
      FROM (SELECT supplier_id, CAST(date_trunc('quarter', as_of_date) AS DATE) AS qtr, avg(composite_score) AS s, avg(on_time_rate) * 100 AS o FROM cards_ GROUP BY 1, 2)""",
    "single_source_exposure": """SELECT p.part_number, p.description, p.criticality, round(p.unit_cost_usd, 3) AS unit_cost_usd, s.supplier_id, s.supplier_name, s.composite_score, s.risk_tier, round(s.p80_days, 3) AS p80_days
      FROM parts_ AS p JOIN orders_ AS o USING (part_number) JOIN latest_ AS s ON s.supplier_id = o.supplier_id
      WHERE p.single_source_flag AND p.criticality IN ('NO_GO', 'GO_IF') AND s.risk_tier IN ('CRITICAL', 'WATCH')
      QUALIFY row_number() OVER (PARTITION BY p.part_number ORDER BY o.order_date DESC, o.po_number DESC, o.po_line DESC, o.supplier_id DESC) = 1""",
    "risk_heatmap": """SELECT p.ata_chapter, p.ata_chapter_name, k.criticality, count(*) AS parts_scored, count(*) FILTER (risk_band = 'CRITICAL') AS critical_parts,
      count(*) FILTER (risk_band IN ('CRITICAL', 'HIGH')) AS at_risk_parts, round(avg(aog_risk_score), 1) AS avg_risk_score, round(max(aog_risk_score), 1) AS max_risk_score,
      round(sum(CASE WHEN aog_risk_score >= 60 THEN p.unit_cost_usd ELSE 0 END), 2) AS value_at_risk_usd
      FROM (SELECT * FROM risks_ WHERE scored_at = (SELECT max(scored_at) FROM risks_ )) AS k JOIN parts_ AS p USING (part_number) GROUP BY 1, 2, 3""",
    "blocked_work_orders": "SELECT * FROM blocked_ ",
    "early_warning_lead": """SELECT part_number, s AS first_stockout_date, date_diff('hour', a::TIMESTAMP, s::TIMESTAMP) AS warning_lead_hours
      FROM (SELECT part_number, min(scored_at) AS a FROM risks_ WHERE risk_band IN ('CRITICAL', 'HIGH') GROUP BY 1)
      JOIN (SELECT part_number, min(snapshot_date) AS s FROM snapshots_ WHERE qty_available <= 0 GROUP BY 1) USING (part_number) WHERE a < s""",
    "parts_to_rescore": "SELECT DISTINCT part_number FROM blocked_ WHERE wo_type = 'AOG' OR aog_risk_score >= 60",
    "alert_candidates": f"""SELECT part_number, criticality, aog_risk_score, risk_band, qty_available, days_of_cover, primary_driver, {_ACTION} AS recommended_action,
      format('[{{}}] {{}} ({{}}) score {{:.1f}}, {{:.0f}} available, {{:.0f}}d cover -> {{}}', risk_band, part_number, criticality, aog_risk_score::DOUBLE, qty_available::DOUBLE, round(days_of_cover::DOUBLE), {_ACTION}) AS alert_text
      FROM risk_ WHERE aog_risk_score >= 75""",
    "alert_cooldown_batch": """SELECT part_number, count(*) AS candidates FROM candidates_ WHERE alert_ts > TIMESTAMP '2024-01-15'
      AND part_number NOT IN (SELECT part_number FROM candidates_ WHERE alert_ts <= TIMESTAMP '2024-01-15' AND alert_ts > TIMESTAMP '2024-01-14 12:00:00') GROUP BY 1""",
    "alert_cooldown_stream": """--ctes o AS (SELECT *, row_number() OVER (PARTITION BY part_number ORDER BY alert_ts, alert_id) AS n FROM candidates_ ),
      go AS (SELECT *, alert_ts AS last, true AS out FROM o WHERE n = 1
        UNION ALL SELECT o.*, CASE WHEN o.alert_ts - go.last >= INTERVAL 12 HOUR THEN o.alert_ts ELSE go.last END, o.alert_ts - go.last >= INTERVAL 12 HOUR
        FROM go JOIN o ON o.part_number = go.part_number AND o.n = go.n + 1)
      SELECT part_number, alert_id, score FROM go WHERE out""",
    "stream_upsert": "SELECT part_number, max(alert_id) AS alert_id, arg_max(score, alert_id) AS score FROM candidates_ GROUP BY 1",
    "source_status": """SELECT warehouse_id AS source, true AS ok, count(*) AS rows, NULL AS retrieved FROM inventory_ GROUP BY 1 UNION ALL SELECT 'WH-gone', false, 0, NULL
      UNION ALL SELECT 'SUPPLIERS', true, count(*), CASE WHEN count(*) > 0 THEN '2001-08-02 00:00' END FROM offers_ """,
    "rescored_parts": """SELECT part_number, qty_available, days_of_cover, aog_risk_score, risk_band, primary_driver FROM risk_
      WHERE part_number IN (SELECT part_number FROM work_ WHERE status = 'OPEN' AND wo_type = 'AOG')""",
    "entry_errors": f"SELECT count(*) AS delivered, count(*) FILTER (actual_delivery_date < order_date) AS negative_lead_times FROM orders_ WHERE actual_delivery_date IS NOT NULL AND order_date >= {AS_OF} - 730",
    "catalog_files": _MASTER + "SELECT ata_chapter, count(*) AS parts, sum(qty_available)::BIGINT AS qty_available, count(DISTINCT part_uid) AS masters FROM master GROUP BY 1",
    "run_results": f"SELECT supplier_id, composite_score, risk_tier, {AS_OF} AS run_date FROM card_ ",
    "alert_log": "SELECT part_number, CASE WHEN criticality = 'NO_GO' THEN '06' ELSE '12' END AS hour, aog_risk_score FROM risk_ WHERE aog_risk_score >= 75",
    "replayed_alert_log": "SELECT part_number, strftime(alert_ts, '%Y-%m-%d %H:%M:%S.%g') AS alerted_at, max(alert_id) AS alert_id, arg_max(score, alert_id) AS score FROM candidates_ GROUP BY 1, 2",
    "delivered_once": "SELECT part_number, alert_id, score FROM candidates_ ",
    "projected_open_orders": "SELECT po_number, po_line, part_number, CAST(CASE WHEN po_line % 2 = 0 THEN promised_date + CAST(po_line AS INT) ELSE promised_date END AS DATE) AS expected_date FROM orders_ WHERE status = 'OPEN'",
    "loaded_tables": """SELECT 0 AS place, 'dim_parts' AS "table", count(*) AS loaded, count(*) AS rows FROM parts_ UNION ALL SELECT 1, 'fct_work_orders', count(*), count(*) FROM work_
      UNION ALL SELECT 2, 'notes', count(*), count(*) FROM customs_ WHERE clearance_status = 'HELD'""",
    "publication_gate": """SELECT coalesce(nullif(avg(abs(g)) / nullif(avg(abs(z)), 0), 0), 1) < 1 AS published, count(*) AS n_test
      FROM (SELECT greatest((exp(y) - 1) * smearing, 0) - demand_qty AS g, coalesce(lag_1, 0) - demand_qty AS z FROM linear_ , smear_ WHERE tenure_months >= 12 AND month >= DATE '2001-02-01')""",
    "scan_wms_jdbc": "SELECT warehouse_id, condition_code, count(*) AS n, sum(qty_available)::BIGINT AS qty_available, max(last_counted) AS last_counted FROM inventory_ WHERE qty_on_hand > 0 GROUP BY 1, 2",
    "landed_pages": "SELECT supplier_id, count(*) AS n, sum(quantity) AS qty_available, '2001-08-02 00:00' AS retrieved FROM offers_ GROUP BY 1",
    "scan_erp": "SELECT CASE WHEN p_partkey = 0 THEN repeat('0', 18) ELSE CAST(p_partkey AS VARCHAR) END AS part_number, p_name AS description, p_type AS material_type, p_brand AS material_group, 1.5::DOUBLE AS net_weight_kg, CASE WHEN p_size % 7 <> 0 THEN p_size::DOUBLE END AS shelf_life_months, 'ERP' AS source_system FROM part",
    "scan_erp_orders": "SELECT CASE WHEN part_number = 'PN-000000' THEN repeat('0', 18) ELSE '' || CAST(part_number[4:] AS INT) END AS part_number, count(*) AS n, sum(quantity) AS quantity, max(promised_date) AS last_promised FROM orders_ GROUP BY 1",
    "scan_erp_work_orders": "SELECT work_order_id, wo_type, aircraft_reg AS equipment_id, opened_date, status FROM work_ ",
    "scan_customs_xml": "SELECT awb, po_number, part_number, quantity, clearance_status, estimated_clearance_days::DOUBLE AS estimated_clearance_days, CASE WHEN clearance_status = 'HELD' THEN 'papers of ' || awb ELSE '' END AS hold_reason FROM customs_ ",
    "scan_edi_850": "SELECT po_number, CAST(po_line AS VARCHAR) AS po_line, quantity, 'EA' AS uom, 1.0::DOUBLE AS unit_price_usd, part_number, order_date, 'EDI_850' AS source_system FROM orders_ ",
    "scan_edi_856": "SELECT po_number AS shipment_id, po_number, part_number, actual_delivery_date AS ship_date, supplier_id AS carrier, quantity AS quantity_shipped, 'EDI_856' AS source_system FROM orders_ WHERE status = 'DELIVERED'",
    "scan_supplier_json": "SELECT supplier_id, 'NE' AS condition_code, '2001-08-02 00:00' AS retrieved, count(*) AS n, sum(quantity) AS qty_available, min(days)::DOUBLE AS best_lead_time FROM offers_ GROUP BY 1",
    "scan_order_status": "SELECT supplier_id, status, count(*) AS n, CAST(max(promised_date) + 1 AS DATE) AS last_promised, 0::BIGINT AS revised FROM orders_ WHERE order_date >= DATE '2001-01-01' GROUP BY 1, 2",
    "scan_wms": "SELECT s AS source_system, warehouse_id, count(*) AS n, sum(qty_available)::BIGINT AS qty_available FROM inventory_ , (SELECT unnest(['WMS_CLOUD', 'WMS_FILES']) AS s) GROUP BY 1, 2",
}


def oracle_sql() -> dict[str, str]:
    return {name: sql(text) for name, text in ORACLES.items()}
