"""Column functions for debt service, leverage and distress rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp(x, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), _c(x)))


def bps_to_decimal(x) -> Column:
    return _c(x) / F.lit(10000.0)


def decimal_to_bps(x) -> Column:
    return _c(x) * F.lit(10000.0)


def percent_to_decimal(x) -> Column:
    return _c(x) / F.lit(100.0)


def safe_divide(num, den, default: float | None = None) -> Column:
    """``num/den``; a zero or null denominator gives ``default`` (or null)."""
    q = F.try_divide(_c(num), _c(den))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def rounded(x, places: int) -> Column:
    """``round`` half up of a double, from its nearest whole multiple where that is beyond doubt: only values near
    a half, large ones and those that are no numbers go through decimals, which cost most of a row's time."""
    unit = F.lit(10.0 ** abs(places))
    scaled = _c(x) * unit if places >= 0 else _c(x) / unit
    whole = F.floor(scaled + 0.5)
    clear = (F.abs(scaled) < 1e10) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-4)
    return F.when(clear, whole / unit if places >= 0 else whole * unit).otherwise(F.round(_c(x), places))


def level_payment_factor(annual_rate) -> Column:
    """Yearly payment per unit of balance on a 30-year level-pay schedule."""
    monthly = _c(annual_rate) / 12.0
    growth = F.pow(1.0 + monthly, F.lit(float(C.AMORTISATION_MONTHS)))
    level = monthly * growth / (growth - 1.0) * 12.0
    return F.when(monthly > 0, level).otherwise(F.lit(1.0 / 30.0))


def annual_debt_service(balance, annual_rate, amortization) -> Column:
    """Interest-only: balance x rate; otherwise a 30-year level payment."""
    interest = _c(balance) * _c(annual_rate)
    level = _c(balance) * level_payment_factor(annual_rate)
    return F.when(_c(amortization) == "interest_only", interest).otherwise(level)


def remaining_balance_factor(annual_rate, months_paid, floor: float = 0.5) -> Column:
    """Share of a 30-year level-pay loan still owed after ``months_paid`` payments."""
    monthly = _c(annual_rate) / 12.0
    total = F.pow(1.0 + monthly, F.lit(float(C.AMORTISATION_MONTHS)))
    paid = F.pow(1.0 + monthly, _c(months_paid).cast("double"))
    left = (total - paid) / (total - 1.0)
    return F.when(monthly > 0, F.greatest(left, F.lit(floor))).otherwise(F.lit(1.0))


def spread_bps(property_type) -> Column:
    """Refinance spread by property type, case-folded; a five-branch constant lookup."""
    folded = F.lower(_c(property_type))
    expr = F.when(F.lit(False), F.lit(0.0))
    for name, spread, _sector, _risk in C.PROPERTY_TYPES:
        expr = expr.when(folded == name, F.lit(spread))
    return expr.otherwise(F.lit(C.DEFAULT_SPREAD_BPS))


def refinance_rate(treasury_pct, property_type) -> Column:
    return (_c(treasury_pct) + spread_bps(property_type) / 100.0) / 100.0


def distress_tier(dscr="new_dscr", ltv="current_ltv") -> Column:
    weak_cover, high_ltv = _c(dscr) < 1.0, _c(ltv) > 0.80
    thin = (_c(dscr) < 1.25) | (_c(ltv) > 0.70)
    return (
        F.when(weak_cover & high_ltv, "critical")
        .when(weak_cover | high_ltv, "high")
        .when(thin, "medium")
        .otherwise("low")
    )


def dscr_severity(dscr="new_dscr") -> Column:
    d = _c(dscr)
    return F.when(d >= 1.5, F.lit(0.0)).when(d >= 1.0, (1.5 - d) / 0.5).otherwise(1.0 + (1.0 - d))


def ltv_severity(ltv="current_ltv") -> Column:
    v = _c(ltv)
    return (
        F.when(v <= 0.60, F.lit(0.0))
        .when(v <= 0.80, (v - 0.60) / 0.20)
        .otherwise(1.0 + (v - 0.80) / 0.20)
    )


def truthy(x) -> Column:
    """1 for the texts true/1 in any case, else 0."""
    return F.coalesce(F.lower(_c(x).cast("string")).isin("true", "1").cast("int"), F.lit(0))


def pd_tier(pd) -> Column:
    """Right-closed bands: up to 0.40 low, up to 0.70 medium, above that high."""
    p = _c(pd)
    return F.when(p <= 0.40, "low").when(p <= 0.70, "medium").when(p <= 1.01, "high")


def pd_action(pd) -> Column:
    p = _c(pd)
    return (
        F.when(p >= 0.70, "high_priority_review")
        .when(p >= 0.50, "quarterly_review")
        .otherwise("standard_monitoring")
    )
