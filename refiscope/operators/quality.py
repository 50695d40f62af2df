"""Data-quality gates: one aggregate pass per table, one report row per check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..plans.silver import is_missing

REPORT = "check_name string, status string, affected bigint, rate double"


class DataQualityError(Exception):
    """A gate found at least one FAIL row."""

    def __init__(self, failures: list[str]):
        self.failures = failures
        super().__init__(f"{len(failures)} failed check(s): " + ", ".join(failures))


def _n(cond: Column) -> Column:
    return F.count_if(cond)


def _status(bad: Column, level: str) -> Column:
    return F.when(bad, F.lit(level)).otherwise(F.lit("PASS"))


def _row(name: str, status: Column, affected: Column, total: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        status.alias("status"),
        affected.cast("bigint").alias("affected"),
        F.round(F.coalesce(F.try_divide(affected.cast("double"), total.cast("double")), F.lit(0.0)), 6).alias("rate"),
    )


def _report(df: DataFrame, measures: dict[str, Column], rows: list[Column]) -> DataFrame:
    """Aggregate once, then turn the single row into report rows (nulls skipped)."""
    one = df.agg(*[expr.alias(name) for name, expr in measures.items()])
    return one.select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")


Rule = tuple[str, tuple[str, ...], dict[str, Column], Column]  # name, columns it needs, measures, report row


def _range_rules(ranges: dict[str, tuple[float, float]]) -> list[Rule]:
    """A column without values has no row, as there is nothing to judge."""
    out: list[Rule] = []
    for c, (lo, hi) in ranges.items():
        v = F.col(c).try_cast("double")
        bad, seen = F.col(f"out_{c}"), F.col(f"seen_{c}")
        measures = {f"seen_{c}": F.count(v), f"out_{c}": _n((v < lo) | (v > hi))}
        out.append((f"RANGE({c})", (c,), measures, F.when(seen > 0, _row(f"RANGE({c})", _status(bad > 0, "WARN"), bad, seen))))
    return out


def _apply(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One pass for all rules whose columns are there; the others are reported as SKIPPED."""
    have = set(df.columns)
    measures: dict[str, Column] = {"n": F.count(F.lit(1))}
    rows = []
    for name, needed, own, row in rules:
        if have.issuperset(needed):
            measures |= own
            rows.append(row)
        else:
            rows.append(_row(name, F.lit("SKIPPED"), F.lit(0), F.lit(0)))
    return _report(df, measures, rows)


def _rate_rule(bad: Column, total: Column, limit: float) -> Column:
    return F.when(bad > total * limit, "FAIL").when(bad > 0, "WARN").otherwise("PASS")


# Bounds, checked columns and limits of the gates.
LOAN_RANGES = {
    "ltv_at_origination": (0.0, 2.0), "dscr_at_origination": (0.0, 10.0), "note_rate": (0.0, 0.20),
    "occupancy_pct": (0.0, 1.0), "original_balance": (0.0, 1e10),
}
FEATURE_RANGES = {"current_ltv": (0.0, 5.0), "new_dscr": (0.0, 50.0), "refinance_rate": (0.0, 0.20)}
NULL_CHECKED = ("loan_id", "maturity_date", "original_balance")
FEATURE_NULLS = ("current_ltv", "refinance_rate", "new_dscr", "debt_yield")


def columns_present(df: DataFrame, required: Sequence[str], name: str) -> DataFrame:
    """FAIL when a required column is absent; answered from the schema alone."""
    missing = [c for c in required if c not in df.columns]
    status = "FAIL" if missing else "PASS"
    return df.sparkSession.sql(
        f"SELECT '{name}' AS check_name, '{status}' AS status, {len(missing)}L AS affected, "
        f"{round(len(missing) / len(required), 6)}D AS rate"
    )


def _not_empty(n: Column) -> Column:
    return _row("ROW_COUNT", _status(n == 0, "FAIL"), n, n)


def loan_gate(df: DataFrame, max_null_rate: float = 0.05, complete: bool = False) -> DataFrame:
    """Row count, schema, null rates, duplicates, ranges and accepted types of raw loans.

    A missing column fails the schema row. With ``complete`` the report goes on after it: rules of
    the columns that are there are judged in the same pass, the others are SKIPPED.
    """
    schema = columns_present(df, C.REQUIRED_LOAN_COLUMNS, "SCHEMA")
    if not complete and any(c not in df.columns for c in C.REQUIRED_LOAN_COLUMNS):
        return schema
    have = set(df.columns)
    accepted = [t for t, *_ in C.PROPERTY_TYPES]
    ptype = F.lower("property_type")
    missing = lambda c: is_missing(df, c) if c in have else F.lit(None)
    named_id = F.when(~missing("loan_id"), F.col("loan_id"))
    n, dup = F.col("n"), F.col("ids") - F.col("unique_ids")
    rules: list[Rule] = [("ROW_COUNT", (), {}, _not_empty(n))]
    for c in NULL_CHECKED:
        bad = F.col(f"null_{c}")
        rules.append((f"NULL_RATE({c})", (c,), {f"null_{c}": _n(missing(c))}, _row(f"NULL_RATE({c})", _rate_rule(bad, n, max_null_rate), bad, n)))
    rules.append(("DUPLICATES", ("loan_id",), {"ids": F.count(named_id), "unique_ids": F.count_distinct(named_id)}, _row("DUPLICATES", _rate_rule(dup, n, 0.01), dup, n)))
    rules += _range_rules(LOAN_RANGES)
    odd = F.col("odd_type")
    rules.append(("PROPERTY_TYPE", ("property_type",), {"odd_type": _n((ptype != "") & ~ptype.isin(*accepted))}, _row("PROPERTY_TYPE", _status(odd > 0, "WARN"), odd, n)))
    return schema.unionByName(_apply(df, rules))


def market_gate(df: DataFrame) -> DataFrame:
    """Row count, expected series, null values, rate range and history of raw market data; rules of
    absent columns are SKIPPED."""
    is_rate = F.col("data_type").isin("treasury_10y", "treasury_5y", "sofr", "cap_rate")
    value = F.col("value").cast("double")
    kinds = {f"n_{t}": _n(F.col("data_type") == t) for t in C.MARKET_TYPES}
    n = F.col("n")
    absent = sum([(F.col(f"n_{t}") == 0).cast("int") for t in C.MARKET_TYPES], F.lit(0))
    history = F.col("n_treasury_10y")
    rules: list[Rule] = [
        ("ROW_COUNT", (), {}, _not_empty(n)),
        ("DATA_TYPES", ("data_type",), kinds, _row("DATA_TYPES", _status(absent > 0, "FAIL"), absent, F.lit(len(C.MARKET_TYPES)))),
        ("NULL_VALUES", ("value",), {"nulls": _n(F.col("value").isNull())}, _row("NULL_VALUES", _rate_rule(F.col("nulls"), n, 0.05), F.col("nulls"), n)),
        ("VALUE_RANGE", ("data_type", "value"), {"rates": _n(is_rate), "outside": _n(is_rate & ((value < -1.0) | (value > 20.0)))},
         _row("VALUE_RANGE", _status(F.col("outside") > 0, "WARN"), F.col("outside"), F.col("rates"))),
        ("HISTORY", ("data_type",), kinds, _row("HISTORY", _status(history < 12, "WARN"), history, n)),
    ]
    return _apply(df, rules)


def feature_gate(df: DataFrame, complete: bool = False) -> DataFrame:
    """Row count, derived columns, derived nulls and ranges of the loan features; ``complete`` as in ``loan_gate``."""
    schema = columns_present(df, C.DERIVED_COLUMNS, "FEATURES")
    if not complete and any(c not in df.columns for c in C.DERIVED_COLUMNS):
        return schema
    n = F.col("n")
    rules: list[Rule] = [("ROW_COUNT", (), {}, _not_empty(n))]
    for c in FEATURE_NULLS:
        bad = F.col(f"null_{c}")
        rules.append((f"DERIVED_NULLS({c})", (c,), {f"null_{c}": _n(F.col(c).isNull())}, _row(f"DERIVED_NULLS({c})", _rate_rule(bad, n, 0.05), bad, n)))
    return schema.unionByName(_apply(df, rules + _range_rules(FEATURE_RANGES)))


def enforce(report: DataFrame, halt: bool = True) -> bool:
    """True when no check failed; with ``halt`` a failure raises. Only the few report rows are collected."""
    failed = [r["check_name"] for r in report.where("status = 'FAIL'").select("check_name").collect()]
    if failed and halt:
        raise DataQualityError(failed)
    return not failed


def summary(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def missing_values(df: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """Expected values that do not occur (one column ``value``)."""
    return expected.join(df.select(F.col(column).alias("value")).distinct(), "value", "left_anti")


def unexpected_values(df: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """Values that occur but are not expected."""
    seen = df.select(F.col(column).alias("value")).where("value is not null and value <> ''").distinct()
    return seen.join(expected, "value", "left_anti")


def not_null(df: DataFrame, column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def table_tests(df: DataFrame, table: str, not_null_columns: Sequence[str] = (), unique_columns: Sequence[str] = (),
                accepted: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Declarative column tests; ``violations`` counts offending rows (unique: surplus keys)."""
    out = None
    measures, labels = [], []
    for c in not_null_columns:
        measures.append(not_null(df, c)), labels.append(("not_null", c))
    for c, values in (accepted or {}).items():
        measures.append(F.count_if(~F.col(c).isin(*values))), labels.append(("accepted_values", c))
    for c in unique_columns:
        measures.append(F.count(F.col(c)) - F.count_distinct(c)), labels.append(("unique", c))
    one = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)])
    rows = [
        F.struct(F.lit(table).alias("table_name"), F.lit(k).alias("test"), F.lit(c).alias("column_name"),
                 F.col(f"m{i}").cast("bigint").alias("violations"))
        for i, (k, c) in enumerate(labels)
    ]
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out


def split_overlap(frame: DataFrame, key: str = "loan_id", split: str = "split") -> DataFrame:
    """Number of keys found in more than one split."""
    per_key = frame.groupBy(key).agg(F.min(split).alias("lo"), F.max(split).alias("hi"))
    return per_key.agg(F.count_if(F.col("lo") != F.col("hi")).alias("overlapping_keys"))
