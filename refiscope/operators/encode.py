"""Categorical encodings, splits and column alignment for the training frame."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import constant_table, release, stage

#: Distinct categories that a task adds up before it hands them on.
_CATEGORIES_AT_ONCE = 1 << 20


def split_of(year="origination_year") -> Column:
    y = F.col(year).try_cast("int")
    return F.when(y <= 2018, "train").when(y == 2019, "valid").when(y >= 2020, "test")


def target_means(frame: DataFrame, key: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Mean label per key and overall, from the train rows only.

    The per-key table is staged: its join is a broadcast while its files are small.
    """
    train = frame.where("split = 'train'")
    per_key = train.groupBy(key).agg(F.avg(label).alias("key_mean"))
    return stage(per_key, "target-means"), train.agg(F.avg(label).alias("global_mean"))


def encode_target(frame: DataFrame, key: str, means: DataFrame, overall: DataFrame | None, out: str, default: float = 0.5) -> DataFrame:
    side = means.select(F.col(key).alias("_k"), "key_mean")
    joined = frame.join(side, F.col(key) == F.col("_k"), "left")
    fallback = F.lit(default)
    if overall is not None:
        joined = joined.crossJoin(F.broadcast(overall))  # one-row side
        fallback = F.coalesce("global_mean", fallback)
    return joined.withColumn(out, F.coalesce("key_mean", fallback)).drop("_k", "key_mean", "global_mean")


def categories(frame: DataFrame, columns: Sequence[str] = tuple(C.ONEHOT_COLUMNS), limit: int = 1000) -> dict[str, list[str]]:
    """Sorted category texts per column over all splits.

    One aggregate; more than ``limit`` distinct values is an error, as the result
    becomes one column each.
    """
    sizes = frame.agg(*[F.count_distinct(F.col(c).cast("string")).alias(c) for c in columns]).first()
    wide = [c for c in columns if sizes[c] > limit]
    if wide:
        raise ValueError(f"too many categories for one-hot encoding: {wide}")
    row = frame.agg(*[F.sort_array(F.collect_set(F.col(c).cast("string"))).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def vocabulary(frame: DataFrame, columns: Sequence[str] = tuple(C.ONEHOT_COLUMNS)) -> DataFrame:
    """column_name, category, code: every distinct category text with a dense code, from 0 in the order of
    column and category. Nulls have no code.

    Nothing but the table itself grows with the categories: they are range-partitioned and numbered
    within their partition, and the sizes of the partitions before it are added.
    """
    texts = frame.select(*[F.col(c).cast("string").alias(c) for c in columns])
    every = texts.unpivot([], list(columns), "column_name", "category").where("category is not null").distinct()
    ordered = every.repartitionByRange("column_name", "category").sortWithinPartitions("column_name", "category")
    at = F.monotonically_increasing_id()  # partition and place in it
    placed = stage(ordered.select("column_name", "category", F.shiftright(at, 33).alias("part"), at.bitwiseAND((1 << 33) - 1).alias("place")), "categories")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stage(sizes.select("part", before.alias("start")), "category-starts")
    out = stage(placed.join(starts, "part").select("column_name", "category", (F.col("place") + F.col("start")).alias("code")), "vocabulary")
    release(placed, starts)
    return out


def code_columns(columns: Sequence[str] = tuple(C.ONEHOT_COLUMNS)) -> list[str]:
    return [f"{c}_code" for c in columns]


def with_codes(frame: DataFrame, vocab: DataFrame, columns: Sequence[str] = tuple(C.ONEHOT_COLUMNS)) -> DataFrame:
    """Adds the code of each categorical column, null for an unknown category. The vocabulary is a staged
    table: a join is a broadcast only while its files are small."""
    for i, c in enumerate(columns):
        side = vocab.where(F.col("column_name") == c).select(F.col("category").alias(f"_category_{i}"), F.col("code").alias(f"{c}_code"))
        frame = frame.join(side, F.col(c).cast("string") == F.col(f"_category_{i}"), "left").drop(f"_category_{i}")
    return frame


def sparse_vector(numeric: Sequence[str], codes: Sequence[str]) -> Column:
    """Struct of indices and values of a row: numbers that are not zero, then a 1 at the place of each category."""
    numbers = [F.struct(F.lit(i).cast("bigint").alias("index"), F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias("value")) for i, c in enumerate(numeric)]
    ones = [F.struct((F.col(c) + len(numeric)).cast("bigint").alias("index"), F.lit(1.0).alias("value")) for c in codes]
    held = F.array_sort(F.filter(F.array(*numbers, *ones), lambda e: e["index"].isNotNull() & (e["value"] != 0.0)))
    return F.struct(held["index"].alias("indices"), held["value"].alias("values"))


def _moments(n_numeric: int):
    """Per task: sums of x, x*x and x*y of every feature that occurs, and the count and sums of y at -1."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(3)
        dense = np.zeros((n_numeric, 3))
        sparse: pd.DataFrame | None = None
        for batch in batches:
            y = batch["y"].to_numpy(float)
            total += (len(y), y.sum(), (y * y).sum())
            if n_numeric and len(y):
                x = np.stack(batch["x"].to_numpy())
                dense += np.stack([x.sum(0), (x * x).sum(0), (x * y[:, None]).sum(0)], axis=1)
            held = np.concatenate([*batch["codes"].to_numpy(), np.zeros(0)]).astype(np.int64)
            own = np.repeat(y, [len(c) for c in batch["codes"]])
            code, at = np.unique(held, return_inverse=True)
            found = pd.DataFrame({"feature": code, "sx": np.bincount(at, minlength=len(code)).astype(float), "sxy": np.bincount(at, own, len(code))})
            sparse = found if sparse is None else pd.concat([sparse, found]).groupby("feature", as_index=False).sum()
            if len(sparse) > _CATEGORIES_AT_ONCE:
                yield sparse.assign(feature=sparse["feature"] + n_numeric, sxx=sparse["sx"])
                sparse = None
        yield pd.DataFrame({"feature": [-1], "sx": [total[0]], "sxx": [total[2]], "sxy": [total[1]]})
        yield pd.DataFrame({"feature": np.arange(n_numeric), "sx": dense[:, 0], "sxx": dense[:, 1], "sxy": dense[:, 2]})
        if sparse is not None and len(sparse):
            yield sparse.assign(feature=sparse["feature"] + n_numeric, sxx=sparse["sx"])

    return rows


def sparse_correlations(frame: DataFrame, numeric: Sequence[str], codes: Sequence[str], vocab: DataFrame, label: str) -> DataFrame:
    """feature and abs_corr with the label of every number and every category's indicator, on train rows.

    One pass: each task adds up the moments of its rows over the entries that are not zero, and one row
    a feature and task is summed. A feature without variation has no correlation.
    """
    train = frame.where("split = 'train'").where(F.col(label).isNotNull())
    held = F.filter(F.array(*[F.col(c).cast("bigint") for c in codes]).cast("array<bigint>"), lambda c: c.isNotNull())
    rows = train.select(F.col(label).cast("double").alias("y"), F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in numeric]).cast("array<double>").alias("x"), held.alias("codes"))
    sums = rows.mapInPandas(_moments(len(numeric)), "feature bigint, sx double, sxx double, sxy double")
    sums = stage(sums.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("sx", "sxx", "sxy")]), "moments")
    whole = sums.where("feature = -1").select(F.col("sx").alias("n"), F.col("sxy").alias("sy"), F.col("sxx").alias("syy"))
    n, sx, sxx, sxy, sy, syy = (F.col(c) for c in ("n", "sx", "sxx", "sxy", "sy", "syy"))
    spread = F.greatest(n * sxx - sx * sx, F.lit(0.0)) * F.greatest(n * syy - sy * sy, F.lit(0.0))
    every = sums.where("feature >= 0").crossJoin(F.broadcast(whole))  # one-row side
    scored = every.select("feature", F.abs(F.try_divide(n * sxy - sx * sy, F.sqrt(spread))).alias("abs_corr")).where("abs_corr is not null")
    names = vocab.select((F.col("code") + len(numeric)).alias("feature"), F.concat_ws("_", "column_name", "category").alias("name"))
    plain = constant_table(frame.sparkSession, [(i, c) for i, c in enumerate(numeric)], "feature bigint, name string")
    return scored.join(names.unionByName(plain), "feature").select(F.col("name").alias("feature"), "abs_corr")


def onehot_columns(cats: dict[str, list[str]]) -> list[str]:
    return [f"{c}_{v}" for c, values in cats.items() for v in values]


def encode_onehot(frame: DataFrame, cats: dict[str, list[str]]) -> DataFrame:
    """0/1 column per known category; a value seen nowhere else gives zeros."""
    return frame.withColumns(
        {f"{c}_{v}": F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0)) for c, values in cats.items() for v in values}
    )


def align(frame: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the expected feature columns: absent ones 0.0, extras dropped, null to 0.0."""
    have = set(frame.columns)
    cell = lambda c: F.coalesce(F.col(f"`{c}`").try_cast("double"), F.lit(0.0)) if c in have else F.lit(0.0)
    return frame.select(*keep, *[cell(c).alias(c) for c in expected])


def constant_columns(frame: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at most one value, found in one pass by min and max."""
    row = frame.agg(
        *[F.min(f"`{c}`").alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(f"`{c}`").alias(f"hi_{i}") for i, c in enumerate(columns)],
    ).first()
    return [c for i, c in enumerate(columns) if row[f"lo_{i}"] == row[f"hi_{i}"]]


def leaking_names(columns: Sequence[str]) -> list[str]:
    """Names that point at the outcome date."""
    return [c for c in columns if any(p in c for p in C.LEAKAGE_PATTERNS)]


def check_feature_names(columns: Sequence[str]) -> None:
    """Feature names must not point at the outcome date."""
    leaking = leaking_names(columns)
    if leaking:
        raise LeakageError(f"feature names refer to maturity: {leaking}")


class LeakageError(Exception):
    """A feature carries information from after the observation date."""


def label_correlations(frame: DataFrame, features: Sequence[str], label: str, k: int = 5) -> DataFrame:
    """Top ``k`` features by absolute correlation with the label on train rows; one pass."""
    train = frame.where("split = 'train'")
    y = F.col(label).cast("double")

    def corr(c: str) -> Column:  # a constant column has no correlation; F.corr would divide by zero
        x = F.col(f"`{c}`").cast("double")
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(c)

    one = train.agg(*[corr(c) for c in features])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.abs(F.col(f"`{c}`")).alias("abs_corr")) for c in features])
    rows = one.select(F.explode(pairs).alias("p")).select("p.*").where("abs_corr is not null")
    return rows.orderBy(F.desc("abs_corr"), "feature").limit(k)


class DegenerateSplitWarning(UserWarning):
    """A split has no rows or only one label."""


def check_splits(frame: DataFrame, label: str) -> list[str]:
    """Warns of every split without rows or with one label only; returns their names."""
    bad = [(r["split"], r["n_rows"], r["label_rate"]) for r in label_rates(frame, label).where("degenerate").orderBy("split").collect()]  # three rows at most
    for split, n, rate in bad:
        warnings.warn(f"split {split}: {n} rows, label rate {rate}", DegenerateSplitWarning, stacklevel=3)
    return [b[0] for b in bad]


def check_categories(vocab: DataFrame) -> None:
    """Names of indicators must not point at the outcome date either."""
    name = F.concat_ws("_", "column_name", "category")
    hit = F.lit(False)
    for p in C.LEAKAGE_PATTERNS:
        hit = hit | F.contains(name, F.lit(p))
    bad = vocab.where(hit).select(name.alias("name")).limit(5).collect()
    if bad:
        raise LeakageError(f"category names refer to maturity: {[r['name'] for r in bad]}")


def check_correlations(top: DataFrame) -> None:
    worst = top.orderBy(F.desc("abs_corr")).first()
    if worst is not None and worst["abs_corr"] > C.LEAKAGE_CORRELATION:
        raise LeakageError(f"feature {worst['feature']} correlates {worst['abs_corr']:.4f} with the label")


def class_balance(frame: DataFrame, label: str) -> DataFrame:
    """Positives, negatives and the weight of a positive row, from train rows."""
    pos = F.coalesce(F.sum(F.col(label)), F.lit(0))
    n = F.count(F.lit(1))
    return frame.where("split = 'train'").agg(
        pos.cast("bigint").alias("positives"), (n - pos).cast("bigint").alias("negatives"),
        ((n - pos) / F.greatest(pos, F.lit(1))).alias("scale_pos_weight"),
    )


def label_rates(frame: DataFrame, label: str) -> DataFrame:
    """Rows, positives, rate and a degenerate flag for each of the three splits."""
    splits = F.explode(F.array(F.lit("train"), F.lit("valid"), F.lit("test"))).alias("split")
    every = frame.sparkSession.range(1).select(splits)
    seen = frame.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(label)).cast("bigint").alias("positives"), F.avg(label).alias("label_rate")
    )
    joined = every.join(seen, "split", "left").fillna(0, ["n_rows", "positives"])
    return joined.withColumn(
        "degenerate", (F.col("n_rows") == 0) | (F.col("positives") == 0) | (F.col("positives") == F.col("n_rows"))
    ).withColumn("negatives", F.col("n_rows") - F.col("positives"))
