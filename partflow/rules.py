"""Business constants. They are semantics: results depend on each."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    # Risk score.
    weight_criticality: float = 0.30
    weight_coverage: float = 0.28
    weight_replenishment: float = 0.20
    weight_supplier: float = 0.12
    weight_customs: float = 0.10
    horizon_days: int = 45
    alert_lead_hours: int = 72
    at_risk_score: float = 60.0
    days_per_month: float = 30.0
    unknown_supplier_risk: float = 0.5
    no_cover_days: float = 9999.0
    # Lead times.
    lookback_days: int = 730
    half_life_days: int = 180
    late_tolerance_days: int = 0
    early_tolerance_days: int = 30
    least_deliveries: int = 5
    high_confidence_deliveries: int = 20
    # Demand.
    lags: tuple[int, ...] = (1, 2, 3, 6, 12)
    windows: tuple[int, ...] = (3, 6, 12)
    forecast_horizon: int = 3
    least_history_months: int = 18
    least_tenure_months: int = 12
    adi_cutoff: float = 1.32
    cv2_cutoff: float = 0.49
    # Customs, stock and alerts.
    customs_worst_days: int = 21
    stale_count_days: int = 90
    alert_score: float = 75.0
    near_alert_margin: float = 15.0
    cooldown_hours: int = 12
    accuracy_target_pct: float = 95.0
    # Skewed joins.
    hot_key_rows: int = 100_000
    salt_buckets: int = 32


RULES = Rules()

# Maps of codes.
CRITICALITY = {"NO_GO": 1.0, "GO_IF": 0.55, "GO": 0.15}
CRITICALITY_CODE = {"NO_GO": 2, "GO_IF": 1, "GO": 0}
BANDS = ((80.0, "CRITICAL"), (60.0, "HIGH"), (40.0, "MEDIUM"))
TIERS = ((50.0, "CRITICAL"), (70.0, "WATCH"), (85.0, "ACCEPTABLE"))
ISSUABLE = ("NE", "OH", "SV")
CLEARANCE_STAGE = {"IN_TRANSIT": 0, "AT_CUSTOMS": 1, "HELD": 2, "CLEARED": 3, "DELIVERED": 4}
CLEARANCE_DELAY_DAYS = {"IN_TRANSIT": 3, "AT_CUSTOMS": 5, "HELD": 14, "CLEARED": 1, "DELIVERED": 0}
ACTIONS = {
    "criticality": "Review MEL coverage; confirm alternate/PMA part approved",
    "coverage": "Raise replenishment PO; check sister-station stock for loan",
    "replenishment": "Expedite open PO with supplier; request partial shipment",
    "supplier": "Escalate to supplier quality; dual-source this part number",
    "customs": "Chase broker on clearance; verify EASA Form 1 / FAA 8130-3 paperwork",
}
