"""Score metrics as aggregations over distinct scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .ordered import running_totals

EPS = 1e-15


def _grouped(df: DataFrame, keys: Sequence[str]):
    return df.groupBy(*keys) if keys else df.groupBy()


def rank_metrics(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """ROC area (ties count one half) and average precision, per key.

    One distributed running count of positives and negatives over distinct scores.
    """
    y = F.col(label)
    t = running_totals(df, score, {"pos": y.cast("bigint"), "neg": (1 - y).cast("bigint")}, keys)
    below = F.col("neg_cum") - F.col("neg") / 2.0
    above_pos = F.col("pos_all") - F.col("pos_cum") + F.col("pos")
    above_all = above_pos + F.col("neg_all") - F.col("neg_cum") + F.col("neg")
    return _grouped(t, keys).agg(
        F.try_divide(F.sum(F.col("pos") * below), F.max(F.col("pos_all").cast("double") * F.col("neg_all"))).alias("auc_roc"),
        F.try_divide(F.sum(F.col("pos") * above_pos / above_all), F.max("pos_all").cast("double")).alias("pr_auc"),
    )


def probability_losses(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Brier score and log loss with clipped probabilities."""
    p = F.least(F.greatest(F.col(score), F.lit(EPS)), F.lit(1.0 - EPS))
    y = F.col(label)
    return _grouped(df, keys).agg(
        F.avg(F.pow(F.col(score) - y, F.lit(2.0))).alias("brier_score"),
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1.0 - p))).alias("log_loss"),
    )


def classification_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """The four headline metrics in one row."""
    return rank_metrics(df, score, label).crossJoin(F.broadcast(probability_losses(df, score, label)))  # one-row sides


def confusion_matrix(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    predicted = (F.col(score) >= threshold).cast("int")
    return df.groupBy(F.col(label).alias("actual"), predicted.alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def calibration_curve(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean prediction and observed rate in uniform bins; empty bins do not appear."""
    which = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(which.alias("bin")).agg(
        F.avg(score).alias("mean_predicted"), F.avg(label).alias("fraction_positive"), F.count(F.lit(1)).alias("n")
    )


def calibration_deviation(df: DataFrame, score: str, label: str, limit: float = 0.15) -> DataFrame:
    gap = F.abs(F.col("mean_predicted") - F.col("fraction_positive"))
    return calibration_curve(df, score, label).select("bin", gap.alias("deviation"), (gap > limit).alias("alert"))


def population_stability(df: DataFrame, features: Sequence[str], is_current: Column, bins: int = 10, limit: float = 0.25) -> DataFrame:
    """PSI of each feature between base and current rows, in equal-width bins of the base range.

    Features are unpivoted, so all of them share one aggregation of at most
    ``features x bins`` groups; empty bins count as a share of 1e-4.
    """
    long = df.withColumn("_cur", is_current).unpivot(["_cur"], list(features), "feature", "value").where("value is not null")
    span = long.where("not _cur").groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    placed = long.join(F.broadcast(span), "feature").withColumn(  # one row per feature name
        "bin",
        F.when(F.col("hi") > F.col("lo"), F.least(F.greatest(
            F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(0)), F.lit(bins - 1))).otherwise(F.lit(0)),
    )
    counts = placed.groupBy("feature", "bin").agg(F.count_if(~F.col("_cur")).alias("b"), F.count_if(F.col("_cur")).alias("c"))
    whole = Window.partitionBy("feature")  # at most ``bins`` rows each
    share = lambda n: F.greatest(F.try_divide(F.col(n), F.sum(n).over(whole).cast("double")), F.lit(1e-4))
    shares = counts.select("feature", share("b").alias("e"), share("c").alias("a"))
    psi = F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e")))
    return shares.groupBy("feature").agg(psi.alias("psi")).withColumn("alert", F.col("psi") > limit)


def ks_statistic(df: DataFrame, score: str, is_current: Column, limit: float = 0.10) -> DataFrame:
    """Largest gap between the two cumulative score distributions."""
    one = df.withColumn("_cur", is_current)
    t = running_totals(one, score, {"b": (~F.col("_cur")).cast("bigint"), "c": F.col("_cur").cast("bigint")})
    gap = F.abs(F.try_divide(F.col("b_cum"), F.col("b_all").cast("double")) - F.try_divide(F.col("c_cum"), F.col("c_all").cast("double")))
    return t.agg(F.max(gap).alias("ks")).withColumn("alert", F.col("ks") > limit)


def rolling_auc(df: DataFrame, score: str, label: str, month: Column, months: int = 6, limit: float = 0.75) -> DataFrame:
    """ROC area over the trailing ``months`` ending at each month.

    Each row is placed in the windows it belongs to (a constant fan-out).
    """
    placed = df.select(score, label, F.explode(F.sequence(month, month + (months - 1))).alias("window_end"))
    out = rank_metrics(placed, score, label, ["window_end"]).select("window_end", "auc_roc")
    return out.where("auc_roc is not null").withColumn("alert", F.col("auc_roc") < limit)


def champion_check(incumbent: DataFrame, challenger: DataFrame, share: float = 0.95) -> DataFrame:
    """Challenger passes when its area is at least 95 % of the incumbent's."""
    a = incumbent.select(F.col("auc_roc").alias("incumbent_auc"))
    b = challenger.select(F.col("auc_roc").alias("challenger_auc"))
    return a.crossJoin(F.broadcast(b)).withColumn(  # one-row sides
        "promote", F.col("challenger_auc") >= F.col("incumbent_auc") * share
    )


def concordance(df: DataFrame, time: str, event: str, risk: str) -> DataFrame:
    """Share of comparable pairs in which the earlier event carries the higher risk.

    A pair is comparable when one loan has the event and the other lasts longer (or is
    censored at the same time); equal risks count one half. No pairs are formed: times
    are replaced by their rank among the distinct times (fractions and negative times included), every loan is counted in the dyadic intervals holding its
    time (one per bit of the largest time), each event asks the intervals that tile the
    times after its own, and inside an interval a running count over risk answers "how
    many below".
    """
    times = df.select(F.col(time).cast("double").alias("_time")).where("_time is not null").distinct()
    ranks = stage(running_totals(times, "_time", {"place": F.lit(1)}).select(F.col("_time").alias("_t"), F.col("place_cum").cast("bigint").alias("_place")), "time-ranks")
    ranked = df.join(ranks, F.col(time).cast("double") == F.col("_t"))
    key = (F.col("_place") * 2 + (1 - F.col(event))).alias("key")
    rows = ranked.select(key, F.col(event).cast("int").alias("event"), F.col(risk).cast("double").alias("risk"))
    rows = stage(rows.groupBy("key", "event", "risk").agg(F.count(F.lit(1)).alias("w")), "risk-groups")
    bits = max(int(rows.agg(F.max("key")).first()[0] or 0).bit_length(), 1)
    levels = F.sequence(F.lit(0), F.lit(bits - 1))
    node = F.expr("shiftright(key, level)")
    at = rows.select("key", "event", "risk", "w", F.explode(levels).alias("level")).withColumn("node", node)
    held = at.select("level", "node", "risk", F.col("w").alias("n_held"), F.lit(0).cast("bigint").alias("n_asked"))
    asked = at.where((F.col("event") == 1) & (F.col("node") % 2 == 0)).select(
        "level", (F.col("node") + 1).alias("node"), "risk", F.lit(0).cast("bigint").alias("n_held"), F.col("w").alias("n_asked")
    )
    t = running_totals(held.unionByName(asked), "risk", {"held": F.col("n_held"), "asked": F.col("n_asked")}, ["level", "node"])
    lower = F.col("held_cum") - F.col("held")
    d = lambda c: c.cast("double")
    return t.agg(
        F.sum(d(F.col("asked")) * F.col("held_all")).alias("comparable"),
        F.try_divide(
            F.sum(d(F.col("asked")) * (d(lower) + d(F.col("held")) / 2.0)), F.sum(d(F.col("asked")) * F.col("held_all"))
        ).alias("concordance"),
    )
