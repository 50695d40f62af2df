"""Fitted models: search, scoring and explanations. SQL states what holds for any right fit: who is
scored, explained and stressed, within which bounds; the values themselves are checked in tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import explain, metrics, treeshap
from ..plans import classifier, frame, stress
from ..session import scratch_path, stage
from . import frame_queries as FQ
from .registry import query, rounded
from .risk_queries import portfolio
from .sqlviews import sql_with

TRIALS = 20


def training(spark, sf):
    return frame.assemble_sparse(FQ.labelled(spark, sf), gate=False)


#: Folder of the fitted model per application and input: the search runs once for all queries of a session.
_FITTED: dict[tuple[str, str], str] = {}


def searched(spark, sf, tf=None):
    """The model of the full search, its training frame and the folder with the trials."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        tf = tf or training(spark, sf)
        found = classifier.search(tf, classifier.random_params(TRIALS))
        folder = scratch_path(spark, "classifier")
        classifier.save(spark, found.model, f"{folder}/model")
        found.trials.write.parquet(f"{folder}/trials")
        _FITTED[key] = folder
    return classifier.load(spark, f"{_FITTED[key]}/model"), _FITTED[key]


@query("classifier_search_trials", f"""
SELECT CAST(i AS INTEGER) AS trial, TRUE AS in_range, TRUE AS grown_to_a_stop, {TRIALS} AS n_trials FROM range({TRIALS}) AS t(i)""")
def classifier_search_trials(spark, sf):
    """Every trial of the search: its parameters lie in the ranges and it ended by a rule."""
    trials = spark.read.parquet(f"{searched(spark, sf)[1]}/trials")
    inside = F.lit(True)
    for name, (lo, hi) in C.SEARCH_RANGES.items():
        inside = inside & F.col(name).between(lo, hi)
    ended = F.col("ended").isin("complete", "median", "patience") & (F.col("grown") >= 1) & (F.col("grown") <= F.col("n_trees")) & (F.col("best_trees") <= F.col("grown"))
    return trials.select("trial", inside.alias("in_range"), ended.alias("grown_to_a_stop"), F.lit(TRIALS).alias("n_trials"))


@query("classifier_search_log")
def classifier_search_log(spark, sf):
    """Parameters, trees and validation area of every trial."""
    return spark.read.parquet(f"{searched(spark, sf)[1]}/trials")


@query("classifier_chosen_trial", "SELECT 1 AS n_chosen, TRUE AS has_the_best_area, TRUE AS better_than_chance")
def classifier_chosen_trial(spark, sf):
    """One trial is chosen, the one with the best validation area."""
    trials = spark.read.parquet(f"{searched(spark, sf)[1]}/trials")
    area = F.max(F.when(F.col("chosen"), F.col("valid_auc")))
    return trials.agg(F.count_if("chosen").cast("int").alias("n_chosen"), (area == F.max("valid_auc")).alias("has_the_best_area"), (area > 0.5).alias("better_than_chance"))


@query("classifier_test_metrics")
def classifier_test_metrics(spark, sf):
    tf = training(spark, sf)
    return classifier.evaluate(searched(spark, sf, tf)[0], tf)


@query("classifier_scores_by_split", sql_with("labelled", f"""
SELECT split, count(*) AS n_loans, CAST(sum({C.LABEL}) AS BIGINT) AS positives, TRUE AS probabilities FROM labelled WHERE split IS NOT NULL GROUP BY split"""))
def classifier_scores_by_split(spark, sf):
    tf = training(spark, sf)
    scored = classifier.score(searched(spark, sf, tf)[0], tf.rows).where("split is not null")
    inside = F.min(F.col("pd").between(0.0, 1.0))
    return scored.groupBy("split").agg(F.count(F.lit(1)).alias("n_loans"), F.sum(C.LABEL).cast("bigint").alias("positives"), inside.alias("probabilities"))


@query("classifier_test_confusion", sql_with("labelled", f"SELECT {C.LABEL} AS actual, count(*) AS n FROM labelled WHERE split = 'test' GROUP BY 1"))
def classifier_test_confusion(spark, sf):
    """Rows of the test split by label, summed from the confusion matrix."""
    tf = training(spark, sf)
    scored = classifier.score(searched(spark, sf, tf)[0], tf.rows.where("split = 'test'"))
    return metrics.confusion_matrix(scored, "pd", C.LABEL).groupBy("actual").agg(F.sum("n").alias("n"))


@query("classifier_feature_importance")
def classifier_feature_importance(spark, sf):
    return classifier.importances(searched(spark, sf)[0])


@query("classifier_importance_facts", "SELECT TRUE AS sums_to_one, TRUE AS none_negative, TRUE AS sorted_down")
def classifier_importance_facts(spark, sf):
    """Gains are shares of the whole, largest first."""
    model = searched(spark, sf)[0]
    every = classifier.importances(model, k=len(model.features))
    listed = every.agg(F.collect_list("importance").alias("v"), F.sum("importance").alias("total"), F.min("importance").alias("least"))
    return listed.select((F.abs(F.col("total") - 1.0) < 1e-9).alias("sums_to_one"), (F.col("least") >= 0).alias("none_negative"),
                         (F.col("v") == F.sort_array("v", asc=False)).alias("sorted_down"))


def stressed(spark, sf):
    tf = training(spark, sf)
    scorer = classifier.portfolio_scorer(searched(spark, sf, tf)[0], tf)
    return stage(stress.run_scenarios(portfolio(spark, sf, dealt=True), stress.scenario_table(spark), scorer), "stress-results")


@query("classifier_stress_summary")
def classifier_stress_summary(spark, sf):
    return stress.summarize(stressed(spark, sf))


@query("classifier_stressed_loans", sql_with("pobsf", f"""
SELECT s.scenario_name, count(*) AS n_loans, TRUE AS probabilities, TRUE AS baseline_is_unchanged
FROM pobsf CROSS JOIN (VALUES {", ".join(f"('{s[0]}')" for s in C.SCENARIOS)}) AS s(scenario_name) GROUP BY s.scenario_name"""))
def classifier_stressed_loans(spark, sf):
    """Every loan is scored under every scenario; the baseline leaves its probability as it was."""
    inside = F.min(F.col("stressed_pd").between(0.0, 1.0))
    same = (F.col("scenario_name") != "baseline") | (F.max(F.abs("delta_pd")) < 1e-12)
    return stressed(spark, sf).groupBy("scenario_name").agg(F.count(F.lit(1)).alias("n_loans"), inside.alias("probabilities"), same.alias("baseline_is_unchanged"))


def _explained(spark, sf):
    tf = training(spark, sf)
    model = searched(spark, sf, tf)[0]
    _, leaves = treeshap.boosted_leaves(model)
    scored = classifier.score(model, tf.rows)
    return treeshap.with_drivers(scored, model.features, leaves, columns=model.columns()), model.features


def _top_explained(spark, sf):
    tf = training(spark, sf)
    model = searched(spark, sf, tf)[0]
    _, leaves = treeshap.boosted_leaves(model)
    top = explain.riskiest(classifier.score(model, tf.rows), "pd", 100)
    return explain.explanation_rows(treeshap.with_drivers(top, model.features, leaves, columns=model.columns()), "pd", "drivers", 10)


@query("classifier_top_risk_explanations")
def classifier_top_risk_explanations(spark, sf):
    return _top_explained(spark, sf)


@query("classifier_top_risk_ranks", sql_with("labelled", """
SELECT CAST(r AS INTEGER) AS rank_in_loan, least(100, (SELECT count(*) FROM labelled)) AS n_loans FROM range(1, 11) AS t(r)"""))
def classifier_top_risk_ranks(spark, sf):
    """The hundred riskiest loans have ten drivers each."""
    return _top_explained(spark, sf).groupBy("rank_in_loan").agg(F.count_distinct("loan_id").alias("n_loans"))


@query("classifier_loan_explanations")
def classifier_loan_explanations(spark, sf):
    rows, _ = _explained(spark, sf)
    return explain.loan_explanations(rows, "pd", "drivers")


@query("classifier_loans_explained", sql_with("labelled", "SELECT count(*) AS n_loans, TRUE AS five_drivers_each, TRUE AS sorted_by_size FROM labelled"))
def classifier_loans_explained(spark, sf):
    """Every loan has five drivers, largest first."""
    rows, _ = _explained(spark, sf)
    told = explain.loan_explanations(rows, "pd", "drivers")
    sizes = F.transform("top_drivers", lambda d: F.abs(d["shap"]))
    return told.agg(F.count(F.lit(1)).alias("n_loans"), F.min(F.size("top_drivers") == 5).alias("five_drivers_each"),
                    F.min(sizes == F.sort_array(sizes, asc=False)).alias("sorted_by_size"))


@query("classifier_global_contributions")
def classifier_global_contributions(spark, sf):
    rows, features = _explained(spark, sf)
    return explain.global_importance(rows, "drivers", features=features)


@query("classifier_metro_driver_audit")
def classifier_metro_driver_audit(spark, sf):
    rows, _ = _explained(spark, sf)
    return explain.top_driver_share(rows, "drivers", "metro_encoded")


@query("classifier_contribution_additivity", sql_with("labelled", "SELECT count(*) AS n, TRUE AS additive FROM labelled"))
def classifier_contribution_additivity(spark, sf):
    """Base plus contributions give the model's own log-odds for every loan."""
    tf = training(spark, sf)
    model = searched(spark, sf, tf)[0]
    expected, leaves = treeshap.boosted_leaves(model)
    scored = classifier.score(model, tf.rows).withColumn("_shap", treeshap.contributions(model.features, leaves, model.columns()))
    total = F.aggregate("_shap", F.lit(0.0), lambda a, b: a + b) + F.lit(expected)
    margin = F.log(F.col("pd") / (1.0 - F.col("pd")))
    return scored.agg(F.count(F.lit(1)).alias("n"), (F.max(F.abs(total - margin)) < 1e-6).alias("additive"))
