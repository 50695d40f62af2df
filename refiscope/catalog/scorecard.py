"""A fixed logistic formula over observation features.

It stands in for a fitted model wherever the check needs the same score in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# feature, weight, centre
TERMS = [
    ("current_ltv_at_Tobs", 2.5, 0.8),
    ("current_dscr_at_Tobs", -3.0, 1.2),
    ("rate_gap_bps_at_Tobs", 0.004, 50.0),
    ("cap_rate_delta_since_origination_at_Tobs", 0.3, 0.0),
    ("occupancy_pct", -0.8, 0.7),
]
BIAS = -0.4

PD_SQL = "round(1e0 / (1e0 + exp(-(" + " + ".join(f"{w}::DOUBLE * ({c} - {m}::DOUBLE)" for c, w, m in TERMS) + f" + {BIAS}::DOUBLE))), 7)"


def contribution(name: str, weight: float, centre: float):
    return F.lit(weight) * (F.col(name) - F.lit(centre))


def score(df: DataFrame) -> DataFrame:
    z = F.lit(BIAS)
    total = None
    for t in TERMS:
        total = contribution(*t) if total is None else total + contribution(*t)
    return df.withColumn("pd", F.round(1.0 / (1.0 + F.exp(-(total + z))), 7))
