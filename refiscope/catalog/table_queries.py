"""Readers, writers, star schema, incremental history and end-to-end builds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics
from ..plans import build, export, gold, silver, stress, survival
from ..session import scratch_path, stage
from ..sources import adapter, market_feeds
from ..sources import tables as T
from ..streaming import history as stream
from . import scorecard
from . import views as V
from .frame_queries import AUC_SQL, AP_SQL, LOSS_SQL, scored, with_drivers
from .gold_queries import HISTORY_COLS, HISTORY_SQL
from .registry import query, rounded
from .risk_queries import COX, SUMMARY_SQL, results, surv_frame
from .sqlviews import TIER, sql_with, view

LOAN_COLS = "loan_id, origination_year, original_balance, note_rate, balloon_flag"


def _loans(spark, sf):
    return adapter.loans(spark, sf).select(*LOAN_COLS.split(", "))


@query("partitioned_table_round_trip", sql_with("loans", f"SELECT {LOAN_COLS} FROM loans"))
def partitioned_table_round_trip(spark, sf):
    path = scratch_path(spark, "by-vintage")
    T.write_table(_loans(spark, sf), path, "origination_year")
    return T.read_table(spark, path)


@query("parquet_table_round_trip", sql_with("loans", f"SELECT {LOAN_COLS} FROM loans"))
def parquet_table_round_trip(spark, sf):
    path = scratch_path(spark, "plain")
    T.write_table(_loans(spark, sf), path)
    return T.read_table(spark, path)


@query("json_lines_table_round_trip", sql_with("loans", f"SELECT {LOAN_COLS} FROM loans"))
def json_lines_table_round_trip(spark, sf):
    path = scratch_path(spark, "json")
    rows = _loans(spark, sf)
    rows.write.mode("overwrite").partitionBy("origination_year").json(path)
    return T.read_json_table(spark, path, rows.schema)


@query("single_partition_read", sql_with("loans", f"SELECT {LOAN_COLS} FROM loans WHERE origination_year = 2018"))
def single_partition_read(spark, sf):
    path = scratch_path(spark, "by-vintage")
    T.write_table(_loans(spark, sf), path, "origination_year")
    return T.read_partition(spark, path, "origination_year", 2018)


@query("table_row_count", "SELECT count(*) AS row_count FROM orders")
def table_row_count(spark, sf):
    path = scratch_path(spark, "count")
    T.write_table(adapter.table(spark, sf, "orders"), path)
    return T.row_count(spark, path)


@query("table_schema_listing", sql_with("loans", f"""
SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS data_type
FROM (DESCRIBE SELECT {LOAN_COLS} FROM loans)"""))
def table_schema_listing(spark, sf):
    path = scratch_path(spark, "schema")
    T.write_table(_loans(spark, sf), path, "origination_year")
    return T.table_schema(spark, path)


@query("append_then_read", sql_with("loans", """
SELECT origination_year, count(*) * 2 AS n FROM loans GROUP BY 1"""))
def append_then_read(spark, sf):
    path = scratch_path(spark, "append")
    rows = _loans(spark, sf)
    T.write_table(rows, path, "origination_year")
    T.write_table(rows, path, "origination_year", mode="append")
    return T.read_table(spark, path).groupBy("origination_year").agg(F.count(F.lit(1)).alias("n"))


@query("overwrite_one_partition_twice", sql_with("loans", """
SELECT origination_year, count(*) AS n, round(sum(note_rate * CASE WHEN origination_year = 2017 THEN 2 ELSE 1 END), 6) AS total_rate FROM loans GROUP BY 1"""))
def overwrite_one_partition_twice(spark, sf):
    path = scratch_path(spark, "dynamic")
    rows = _loans(spark, sf)
    T.write_table(rows, path, "origination_year")
    rerun = rows.where("origination_year = 2017").withColumn("note_rate", F.col("note_rate") * 2)
    for _ in range(2):
        T.overwrite_partitions(rerun, path, "origination_year")
    return rounded(T.read_table(spark, path).groupBy("origination_year").agg(F.count(F.lit(1)).alias("n"), F.sum("note_rate").alias("total_rate")))


@query("explicit_loan_schema", sql_with("raw_loans", """
SELECT loan_id, TRY_CAST(original_balance AS DOUBLE) AS original_balance, TRY_CAST(loan_term_years AS INTEGER) AS loan_term_years,
  CAST(balloon_flag AS BOOLEAN) AS balloon_flag, ingested_at, CAST(NULL AS VARCHAR) AS source FROM raw_loans"""))
def explicit_loan_schema(spark, sf):
    return T.conform_bronze_loans(adapter.raw_loans(spark, sf)).select(
        "loan_id", "original_balance", "loan_term_years", "balloon_flag", "ingested_at", "source")


@query("explicit_market_schema", sql_with("raw_market", """
SELECT data_type, observation_date, value, nullif(property_type, '') AS property_type, nullif(metro, '') AS metro, nullif(series_id, '') AS series_id FROM raw_market"""))
def explicit_market_schema(spark, sf):
    return T.conform_bronze_market(adapter.raw_market(spark, sf)).select("data_type", "observation_date", "value", "property_type", "metro", "series_id")


@query("landed_json_observations", """
SELECT 'treasury_10y' AS data_type, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS observation_date, round(sum(o_orderkey) % 400 / 100e0, 2) AS value, 'monthly' AS frequency, 'DGS10' AS series_id, 'fred_api' AS source
FROM orders GROUP BY 2 HAVING sum(o_orderkey) % 11 <> 0 AND sum(o_orderkey) % 13 <> 0""")
def landed_json_observations(spark, sf):
    total = F.sum("o_orderkey")
    daily = adapter.table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(
        F.when(total % 11 == 0, ".").when(total % 13 == 0, "n/a").otherwise((F.round(total % 400 / 100.0, 2)).cast("string")).alias("value"))
    payload = daily.groupBy(F.year("d").alias("y")).agg(
        F.collect_list(F.struct(F.col("d").cast("string").alias("date"), "value")).alias("observations"))  # one year of days each
    path = scratch_path(spark, "payload")
    payload.select("observations").write.mode("overwrite").json(path)
    out = market_feeds.read_observations_json(spark, path, "treasury_10y", "monthly", "DGS10")
    return out.select("data_type", "observation_date", "value", "frequency", "series_id", "source")


@query("loan_csv_export", sql_with("loans", """
SELECT loan_id, CAST(original_balance AS BIGINT) AS original_balance, note_rate FROM loans"""))
def loan_csv_export(spark, sf):
    path = scratch_path(spark, "csv")
    T.write_csv(adapter.loans(spark, sf).select("loan_id", F.col("original_balance").cast("bigint").alias("original_balance"), "note_rate"), path)
    return spark.read.schema("loan_id string, original_balance bigint, note_rate double").option("header", True).csv(path)


@query("metrics_json_export", sql_with("scored", f"""
SELECT (SELECT round(num / den, 6) FROM {AUC_SQL.format(where='')}) AS auc_roc, (SELECT round(ap, 6) FROM {AP_SQL}) AS pr_auc, {LOSS_SQL} FROM scored"""))
def metrics_json_export(spark, sf):
    path = scratch_path(spark, "metrics")
    T.write_metrics_json(rounded(metrics.classification_metrics(scored(spark, sf), "pd", "distress_at_maturity")), path)
    return spark.read.schema("auc_roc double, pr_auc double, brier_score double, log_loss double").json(path)


@query("stress_summary_export", sql_with("results", "SELECT scenario_name, total_loans, pct_loans_distressed, worst_metros FROM (" + SUMMARY_SQL + ")"))
def stress_summary_export(spark, sf):
    path = scratch_path(spark, "stress-summary")
    T.write_table(stress.summarize(stage(results(spark, sf), "stress-results")), f"{path}/table")
    T.write_csv(T.read_table(spark, f"{path}/table"), f"{path}/csv", single_file=True)
    return T.read_table(spark, f"{path}/table").select("scenario_name", "total_loans", "pct_loans_distressed", "worst_metros")


# --- star schema ------------------------------------------------------------------


@query("fact_and_dim_projections", sql_with("state", """
SELECT loan_id, distress_tier, current_ltv, refinance_rate, is_matured, round(dscr_change, 6) AS dscr_change, sponsor_credit_tier, loan_purpose, loan_term_years FROM state"""))
def fact_and_dim_projections(spark, sf):
    s = stage(V.state(spark, sf), "state")
    fact = export.fact_loan_current(s).select("loan_id", "distress_tier", "current_ltv", "refinance_rate", "is_matured", "dscr_change")
    dim = export.dim_loan(s).select("loan_id", "sponsor_credit_tier", "loan_purpose", "loan_term_years")
    return rounded(fact.join(dim, "loan_id"))


@query("metro_regions", sql_with("loans", """
SELECT metro_area AS metro, 'Other' AS region FROM loans GROUP BY 1"""))
def metro_regions(spark, sf):
    return export.dim_metro(adapter.loans(spark, sf))


@query("metro_regions_known_names", sql_with("loans", """
SELECT metro, CASE metro WHEN 'New York' THEN 'Northeast' WHEN 'Chicago' THEN 'Midwest' WHEN 'Denver' THEN 'Mountain West' ELSE 'Other' END AS region
FROM (SELECT DISTINCT CASE loan_key % 4 WHEN 0 THEN 'New York' WHEN 1 THEN 'Chicago' WHEN 2 THEN 'Denver' ELSE 'Elsewhere' END AS metro FROM loans)"""))
def metro_regions_known_names(spark, sf):
    names = F.element_at(F.array(*[F.lit(n) for n in ("New York", "Chicago", "Denver", "Elsewhere")]), (F.col("loan_key") % 4 + 1).cast("int"))
    return export.dim_metro(adapter.loans(spark, sf).withColumn("metro_area", names))


@query("star_join_by_sector_and_region", sql_with("state", """
SELECT CASE property_type WHEN 'office' THEN 'Office' WHEN 'retail' THEN 'Retail' WHEN 'industrial' THEN 'Industrial' WHEN 'multifamily' THEN 'Multifamily' ELSE 'Hospitality' END AS sector,
  CASE property_type WHEN 'office' THEN 'high' WHEN 'retail' THEN 'medium-high' WHEN 'industrial' THEN 'low' WHEN 'multifamily' THEN 'medium' ELSE 'high' END AS risk_tier,
  'Other' AS region, count(*) AS n, sum(current_balance) AS upb FROM state GROUP BY 1, 2"""))
def star_join_by_sector_and_region(spark, sf):
    s = stage(V.state(spark, sf), "state")
    dim = export.dim_loan(s).select("loan_id", "property_type", "metro_area")
    joined = (
        export.fact_loan_current(s).select("loan_id", "current_balance").join(dim, "loan_id")
        .join(export.dim_property_type(spark), "property_type")
        .join(export.dim_metro(s).withColumnRenamed("metro", "metro_area"), "metro_area")
    )
    return joined.groupBy("sector", "risk_tier", "region").agg(F.count(F.lit(1)).alias("n"), F.sum("current_balance").alias("upb"))


@query("history_by_calendar_month", sql_with("snap_features", """
SELECT CAST(year(d) AS INTEGER) AS year, 'Q' || quarter(d) AS quarter_name, strftime(d, '%B') AS month_name, count(*) AS n_snapshots, count(*) FILTER (last_day(d) = d) AS n_month_end
FROM (SELECT CAST(snapshot_at AS TIMESTAMP)::DATE AS d FROM snap_features) GROUP BY 1, 2, 3"""))
def history_by_calendar_month(spark, sf):
    hist = export.fact_loan_history(gold.distress_history(V.snapshot_features(spark, sf)))
    dated = hist.withColumn("date", F.substring("snapshot_at", 1, 10))
    joined = dated.join(export.dim_date(spark, dated=dated), "date")
    return joined.groupBy("year", "quarter_name", "month_name").agg(
        F.count(F.lit(1)).alias("n_snapshots"), F.count_if("is_month_end").alias("n_month_end"))


@query("calendar_of_maturities", sql_with("loans", """
SELECT CAST(d AS VARCHAR) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, last_day(d) = d AS is_month_end, count(loan_id) AS n_maturing
FROM (SELECT CAST(unnest(generate_series(DATE '2015-01-01', (SELECT greatest(DATE '2028-12-31', max(CAST(maturity_date AS DATE))) FROM loans), INTERVAL 1 DAY)) AS DATE) AS d) LEFT JOIN loans ON maturity_date = CAST(d AS VARCHAR) GROUP BY d"""))
def calendar_of_maturities(spark, sf):
    per_day = adapter.loans(spark, sf).groupBy(F.col("maturity_date").alias("date")).agg(F.count(F.lit(1)).alias("n_maturing"))
    out = export.dim_date(spark, dated=per_day).join(per_day, "date", "left").fillna(0, ["n_maturing"])
    return out.select("date", "year", "quarter", "month", "is_month_end", "n_maturing")


@query("stress_by_scenario_dimension", sql_with("results scen", """
SELECT scenario_name, rate_bps AS rate_shock_bps, coalesce(ptype, 'all') AS property_type_filter, severity_rank, count(*) AS n, round(avg(stressed_pd), 6) AS mean_pd
FROM results JOIN scen USING (scenario_name) GROUP BY 1, 2, 3, 4"""))
def stress_by_scenario_dimension(spark, sf):
    fact = export.fact_stress_results(results(spark, sf))
    joined = fact.join(export.dim_scenario(spark), "scenario_name")
    return rounded(joined.groupBy("scenario_name", "rate_shock_bps", "property_type_filter", "severity_rank").agg(
        F.count(F.lit(1)).alias("n"), F.avg("stressed_pd").alias("mean_pd")))


@query("star_schema_export", sql_with("state results surv_pred snap_features scored", """
SELECT 'fact_loan_current' AS table_name, count(*) AS n FROM state UNION ALL SELECT 'dim_loan', count(*) FROM state
UNION ALL SELECT 'fact_loan_history', count(*) FROM snap_features UNION ALL SELECT 'fact_stress_results', count(*) FROM results
UNION ALL SELECT 'fact_shap_top_features', count(*) * 5 FROM scored UNION ALL SELECT 'fact_survival', count(*) FROM surv_pred
UNION ALL SELECT 'dim_metro', count(DISTINCT metro_area) FROM state UNION ALL SELECT 'dim_scenario', 8 UNION ALL SELECT 'dim_property_type', 5 UNION ALL SELECT 'dim_date', 5114"""))
def star_schema_export(spark, sf):
    from ..operators import explain

    market = V.loan_market(spark, sf)
    state = stage(V.state(spark, sf, market), "state")  # loans are joined and priced once for all tables of one row a loan
    rows = surv_frame(spark, sf, market, state)
    return export.export_star_schema(
        scratch_path(spark, "star"), state,
        gold.distress_history(V.snapshot_features(spark, sf, market)), results(spark, sf, market, state),
        explain.explanation_rows(with_drivers(scored(spark, sf, market)), "pd", "drivers", 10),
        survival.predict(rows, COX, survival.baseline_hazard(rows, COX)),
    )


@query("recent_history_only", sql_with("snap_features", """
SELECT count(*) AS n, count(DISTINCT loan_id) AS n_loans FROM (SELECT loan_id, CAST(_feature_computed_at AS TIMESTAMP)::DATE AS d,
  max(CAST(_feature_computed_at AS TIMESTAMP)::DATE) OVER (PARTITION BY loan_id) AS newest FROM snap_features) WHERE d >= newest - INTERVAL 2 MONTH"""))
def recent_history_only(spark, sf):
    hist = stage(gold.distress_history(V.snapshot_features(spark, sf)).select("loan_id", "snapshot_at", "distress_tier"), "history")
    return export.fact_loan_history(hist, months=2).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("loan_id").alias("n_loans"))


# --- incremental history ----------------------------------------------------------


def _streamed(spark, sf):
    root = scratch_path(spark, "stream")
    snaps = silver.add_time_to_maturity(adapter.loan_snapshots(spark, sf), adapter.REFERENCE_DATE)
    snaps.write.parquet(f"{root}/landed")
    schema = spark.read.parquet(f"{root}/landed").schema
    now = V.now(spark, sf)
    for checkpoint in ("first", "first", "lost"):  # later runs find no new files, also without a checkpoint
        stream.append_snapshots(spark, f"{root}/landed", schema, now, f"{root}/history", f"{root}/checkpoint-{checkpoint}")
    return stream.read_history(spark, f"{root}/history")


@query("streamed_snapshot_history", sql_with("snap_features", HISTORY_SQL))
def streamed_snapshot_history(spark, sf):
    return rounded(_streamed(spark, sf).select(*HISTORY_COLS))


@query("latest_state_from_streamed_history", sql_with("snap_features", f"""
SELECT loan_id, snapshot_at, distress_tier FROM (SELECT loan_id, _feature_computed_at AS snapshot_at, {TIER} AS distress_tier, current_balance, new_dscr FROM snap_features)
QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY snapshot_at DESC, current_balance DESC, new_dscr DESC) = 1"""))
def latest_state_from_streamed_history(spark, sf):
    out = stream.latest_state(_streamed(spark, sf), [F.desc("current_balance"), F.desc("new_dscr")])
    return out.select("loan_id", "snapshot_at", "distress_tier")


@query("history_manifest", sql_with("snap_features", """
SELECT TRUE AS all_files_named, TRUE AS one_row_a_file, count(*) AS n_rows FROM snap_features"""))
def history_manifest(spark, sf):
    """Every landed file stands in the manifest once, and the committed rows are those of the files."""
    root = scratch_path(spark, "manifest")
    snaps = silver.add_time_to_maturity(adapter.loan_snapshots(spark, sf), adapter.REFERENCE_DATE)
    snaps.write.parquet(f"{root}/landed")
    landed = spark.read.parquet(f"{root}/landed")
    for checkpoint in ("first", "lost"):
        stream.append_snapshots(spark, f"{root}/landed", landed.schema, V.now(spark, sf), f"{root}/history", f"{root}/{checkpoint}")
    files = landed.select(F.col("_metadata.file_name").alias("file")).distinct()
    named = stream.read_manifest(spark, f"{root}/history")
    both = files.join(named.groupBy("file").agg(F.count(F.lit(1)).alias("n")), "file", "full")
    counted = stream.read_history(spark, f"{root}/history").agg(F.count(F.lit(1)).alias("n_rows"))
    facts = both.agg(F.min(F.col("n").isNotNull()).alias("all_files_named"), (F.max("n") == 1).alias("one_row_a_file"))
    return facts.crossJoin(F.broadcast(counted))  # one-row sides


# --- end to end -------------------------------------------------------------------



@query("silver_build", sql_with("imputed market", """
SELECT 'loans_count' AS item, 'OK' AS status, count(*) AS n FROM imputed UNION ALL SELECT 'market_rates_count', 'OK', count(*) FROM market
UNION ALL SELECT 'loan_features_count', 'OK', count(*) FROM imputed UNION ALL SELECT 'bronze_loan_quality', 'FAIL', NULL
UNION ALL SELECT 'bronze_market_quality', 'PASS', NULL UNION ALL SELECT 'silver_features_quality', 'PASS', NULL"""))
def silver_build(spark, sf):
    return build.build_silver(adapter.raw_loans(spark, sf), adapter.raw_market(spark, sf), scratch_path(spark, "silver"), [F.col("ingested_at").asc()],
                              adapter.REFERENCE_DATE, halt=False, stamp=F.lit(adapter.STAMP))
