"""Leakage-free training frame: features two years before maturity, label at maturity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import finance as fin
from ..functions import noise
from ..functions.dates import months_between_days, observation_date, parse_date
from ..operators import asof, encode


@dataclass(frozen=True)
class MarketCurves:
    treasury: asof.Curve
    caps: asof.Curve
    history: tuple[str, str]  # first and last treasury date


def history_bounds(market: DataFrame) -> tuple[str, str]:
    """Treasury history as two literals, so that the filter reaches the loan scan."""
    return tuple(asof.treasury_range(market).first())


def market_curves(market: DataFrame) -> MarketCurves:
    return MarketCurves(asof.treasury_curve(market), asof.cap_rate_curve(market), history_bounds(market))


def _number(name: str) -> Column:
    return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0))


def with_observation_dates(loans: DataFrame) -> DataFrame:
    """Parsed dates and the observation date; loans without a maturity date are dropped."""
    dated = loans.withColumns({"maturity_d": parse_date("maturity_date"), "origination_d": parse_date("origination_date")})
    return dated.where("maturity_d is not null").withColumn("t_obs", observation_date("maturity_d"))


def within_market_history(loans: DataFrame, history: tuple[str, str], need_maturity: bool = True) -> DataFrame:
    """Observation date (and maturity, unless relaxed) inside the treasury history."""
    first, last = (F.lit(d).cast("date") for d in history)
    out = loans.where(F.col("t_obs") >= first)
    return out.where(F.col("maturity_d") <= last) if need_maturity else out.where("origination_d is not null")


def _balance() -> Column:
    return F.coalesce(F.col("current_balance").try_cast("double"), _number("original_balance"))


def _leverage(noi: Column, cap_pct: Column, no_value: float) -> Column:
    value = F.when(cap_pct > 0, noi / (cap_pct / 100.0)).otherwise(F.lit(0.0))
    return F.when(value > 0, _balance() / value).otherwise(F.lit(no_value))


def _coverage(noi: Column, rate: Column) -> Column:
    service = fin.annual_debt_service(_balance(), rate, F.col("amortization_type").cast("string"))
    return F.when(service > 0, noi / service).otherwise(F.lit(0.0))


def with_rate_features(df: DataFrame, noi: Column | None = None) -> DataFrame:
    """Rate gap, LTV and DSCR from the treasury and cap-rate columns at observation."""
    noi = _number("noi_annual") if noi is None else noi
    df = df.withColumn("refi_rate_at_Tobs", fin.refinance_rate("treasury_10y_at_Tobs", "property_type"))
    return df.withColumns(
        {
            "rate_gap_bps_at_Tobs": (F.col("refi_rate_at_Tobs") - F.col("note_rate")) * 10000.0,
            "current_ltv_at_Tobs": _leverage(noi, F.col("cap_rate_at_Tobs"), 0.0),
            "current_dscr_at_Tobs": _coverage(noi, F.col("refi_rate_at_Tobs")),
        }
    )


def observation_features(loans: DataFrame, curves: MarketCurves) -> DataFrame:
    """The twelve numeric features as they were known at the observation date."""
    df = loans.withColumns(
        {
            "log_original_balance": F.log1p(_number("original_balance")),
            **{c: _number(c) for c in ("note_rate", "ltv_at_origination", "dscr_at_origination", "occupancy_pct")},
            "months_since_origination_at_Tobs": F.coalesce(months_between_days("t_obs", "origination_d"), F.lit(0.0)),
        }
    )
    df = asof.with_treasury(df, curves.treasury, "t_obs", "treasury_10y_at_Tobs")
    df = asof.with_cap_rate(df, curves.caps, "t_obs", "property_type", "cap_rate_at_Tobs")
    df = asof.with_cap_rate(df, curves.caps, "origination_d", "property_type", "cap_rate_at_origination")
    df = df.withColumn(
        "cap_rate_delta_since_origination_at_Tobs", F.col("cap_rate_at_Tobs") - F.col("cap_rate_at_origination")
    )
    return with_rate_features(df)


def label_shocks(key: str = "loan_id", property_type: str = "property_type", surprise: float = 0.05) -> dict[str, Column]:
    """Hash-driven idiosyncratic noise per loan: NOI multiplier, cap-rate shift, forced default."""
    kind = F.lower(F.col(property_type))
    vol = noise.uniform_between(key, "|vol", 0.10, 0.40)
    drift = fin.clamp(noise.gaussian(key, "|noi") * vol * F.sqrt(F.lit(2.0)), -0.60, 0.60)
    chance = F.when(kind.isin("office", "retail"), 0.25).when(kind == "hotel", 0.10).otherwise(0.0)
    loss = F.when(noise.uniform(key, "|loss") < chance, noise.uniform_between(key, "|size", 0.15, 0.50)).otherwise(0.0)
    cap = F.when(noise.uniform(key, "|cap") < 0.30, noise.gaussian(key, "|capsize")).otherwise(0.0)
    return {
        "noi_multiplier": (1.0 + drift) * (1.0 - loss),
        "cap_shift": cap,
        "forced_default": noise.uniform(key, "|surprise") < surprise,
    }


def maturity_label(df: DataFrame, curves: MarketCurves, shocks: bool = True, surprise: float = 0.05) -> DataFrame:
    """1 when cover at maturity is below 1.0 or leverage above 0.90; optional noise.

    Every column describing the maturity date is dropped again.
    """
    out = asof.with_treasury(df, curves.treasury, "maturity_d", "_treasury_m")
    out = asof.with_cap_rate(out, curves.caps, "maturity_d", "property_type", "_cap_m")
    noi, cap = _number("noi_annual"), F.col("_cap_m")
    forced = F.lit(False)
    if shocks:
        s = label_shocks(surprise=surprise)
        noi, cap, forced = noi * s["noi_multiplier"], cap + s["cap_shift"], s["forced_default"]
    out = out.withColumns({"_noi_m": noi, "_cap_s": cap, "_rate_m": fin.refinance_rate("_treasury_m", "property_type")})
    dscr = _coverage(F.col("_noi_m"), F.col("_rate_m"))
    ltv = _leverage(F.col("_noi_m"), F.col("_cap_s"), C.NO_VALUE_LTV)
    return out.withColumn(C.LABEL, ((dscr < 1.0) | (ltv > 0.90) | forced).cast("int")).drop(
        "_treasury_m", "_cap_m", "_noi_m", "_cap_s", "_rate_m"
    )


@dataclass(frozen=True)
class TrainingFrame:
    rows: DataFrame  # loan_id, split, label and the feature columns
    features: list[str]
    metro_means: DataFrame
    global_mean: DataFrame


def labelled_loans(loans: DataFrame, curves: MarketCurves, shocks: bool = True) -> DataFrame:
    """Eligible loans with observation features, label and split."""
    eligible = within_market_history(with_observation_dates(loans), curves.history)
    labelled = maturity_label(observation_features(eligible, curves), curves, shocks)
    return labelled.withColumn("split", encode.split_of())


@dataclass(frozen=True)
class SparseFrame:
    """The training frame with one code per categorical column in place of one column per category."""

    rows: DataFrame  # loan_id, origination_year, split, label, numbers, categorical columns and their codes
    numeric: list[str]
    categories: list[str]
    codes: list[str]
    vocabulary: DataFrame
    metro_means: DataFrame
    global_mean: DataFrame


def assemble_sparse(labelled: DataFrame, gate: bool = True) -> SparseFrame:
    """Target-encode the metro and code the categories, of which any number may exist. ``labelled`` is read
    several times and should be staged. ``gate``: see ``check_frame``."""
    means, overall = encode.target_means(labelled, "metro_area", C.LABEL)
    encoded = encode.encode_target(labelled, "metro_area", means, overall, "metro_encoded")
    vocab = encode.vocabulary(labelled)
    numeric, categories = [*C.NUMERIC_FEATURES, "metro_encoded"], list(C.ONEHOT_COLUMNS)
    keep = ["loan_id", "origination_year", "split", C.LABEL, *categories]
    coded = encode.with_codes(encoded, vocab)
    rows = encode.align(coded, numeric, keep=[*keep, *encode.code_columns()])
    out = SparseFrame(rows, numeric, categories, encode.code_columns(), vocab, means, overall)
    if gate:
        check_frame(out)
    return out


def check_frame(frame: SparseFrame) -> DataFrame:
    """Gate of a training frame: feature names that point at the outcome date and features that follow
    the label raise ``LeakageError``; empty or one-sided splits warn. Returns the five largest correlations."""
    encode.check_feature_names(frame.numeric)
    encode.check_categories(frame.vocabulary)
    encode.check_splits(frame.rows, C.LABEL)
    every = encode.sparse_correlations(frame.rows, frame.numeric, frame.codes, frame.vocabulary, C.LABEL)
    top = every.orderBy(F.desc("abs_corr"), "feature").limit(5)
    if frame.rows.where("split = 'train'").limit(11).count() > 10:  # fewer rows say nothing
        encode.check_correlations(top)
    return top


def assemble_frame(labelled: DataFrame, gate: bool = True) -> TrainingFrame:
    """The frame with one column per category, for tables of few categories; any number of them is for
    ``assemble_sparse``, whose gate it passes first. ``labelled`` is read several times and should be staged.
    """
    if gate:
        assemble_sparse(labelled)
    means, overall = encode.target_means(labelled, "metro_area", C.LABEL)
    encoded = encode.encode_target(labelled, "metro_area", means, overall, "metro_encoded")
    cats = encode.categories(labelled)
    features = [*C.NUMERIC_FEATURES, "metro_encoded", *encode.onehot_columns(cats)]
    encode.check_feature_names(features)
    rows = encode.align(encode.encode_onehot(encoded, cats), features, keep=["loan_id", "origination_year", "split", C.LABEL])
    return TrainingFrame(rows, features, means, overall)
