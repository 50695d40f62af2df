"""History and stress results that are run again."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType
from test_risk import portfolio

from refiscope import catalog
from refiscope.catalog import views as V
from refiscope.plans import silver, stress
from refiscope.session import scratch_path
from refiscope.sources import adapter
from refiscope.streaming import history

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((r.loan_id, str(r.snapshot_at), r.distress_tier) for r in df.select("loan_id", "snapshot_at", "distress_tier").collect())


def test_history_survives_a_lost_checkpoint(spark):
    root = scratch_path(spark, "history-test")
    snaps = silver.add_time_to_maturity(adapter.loan_snapshots(spark, SF), adapter.REFERENCE_DATE).limit(600)
    snaps.repartition(3).write.parquet(f"{root}/landed")
    schema, now = spark.read.parquet(f"{root}/landed").schema, V.now(spark, SF)
    run = lambda checkpoint, n=1000: history.append_snapshots(spark, f"{root}/landed", schema, now, f"{root}/history", f"{root}/{checkpoint}", max_files=n)
    assert history.read_manifest(spark, f"{root}/history").count() == 0
    run("a", 2)
    first = rows_of(history.read_history(spark, f"{root}/history"))
    assert len(first) == 600
    run("b")  # offers all files anew, in other batches
    assert rows_of(history.read_history(spark, f"{root}/history")) == first == rows_of(spark.read.parquet(f"{root}/history"))
    snaps.limit(50).coalesce(1).write.mode("append").parquet(f"{root}/landed")
    run("c", 1)
    assert len(rows_of(history.read_history(spark, f"{root}/history"))) == 650
    named = history.read_manifest(spark, f"{root}/history")
    assert named.count() == named.select("file").distinct().count() == 4
    # A partition without a manifest row is of a run that broke off.
    spark.read.parquet(f"{root}/history").limit(5).withColumn("ingest_batch", F.lit("broken")).write.mode("append").partitionBy("ingest_batch").parquet(f"{root}/history")
    assert len(rows_of(history.read_history(spark, f"{root}/history"))) == 650


def scorer(df):
    return df.withColumn("pd", F.least(F.lit(1.0), F.col("current_dscr_at_Tobs") * 0 + F.col("refi_rate_at_Tobs") * 5))


def observed(spark):
    extra = {c: F.lit(0.05) for c in ("refi_rate_at_Tobs", "treasury_10y_at_Tobs", "cap_rate_at_Tobs", "cap_rate_at_origination", "cap_rate_delta_since_origination_at_Tobs",
                                      "rate_gap_bps_at_Tobs", "current_ltv_at_Tobs", "current_dscr_at_Tobs")}
    return portfolio(spark).withColumns(extra).withColumn("original_balance", F.col("current_balance"))


def test_one_scenario_is_run_again_and_a_broken_run_changes_nothing(spark):
    path = scratch_path(spark, "runs-test")
    scenarios = stress.scenario_table(spark)
    rows = observed(spark)
    stress.run_and_commit(rows, scenarios, scorer, path)
    per = lambda: {r.scenario_name: (r["count"], r.noi) for r in stress.read_committed(spark, path).groupBy("scenario_name").agg(F.count("*").alias("count"), F.sum("noi_annual").alias("noi")).collect()}
    before = per()
    assert len(before) == 8 and {n for n, _ in before.values()} == {2}
    again = scenarios.withColumn("noi_shock_pct", F.lit(-0.5))
    stress.run_and_commit(rows, again, scorer, path, ["combined_severe"])
    after = per()
    assert after["combined_severe"][1] < before["combined_severe"][1] and {k: v for k, v in after.items() if k != "combined_severe"} == {k: v for k, v in before.items() if k != "combined_severe"}

    def breaks(df):
        return df.withColumn("pd", F.raise_error(F.lit("broken")).cast("double"))

    with pytest.raises(Exception, match="broken"):
        stress.run_and_commit(rows, again, breaks, path)
    assert per() == after and sorted(r.number for r in stress.latest_runs(spark, path).collect()) == [1] * 7 + [2]


def test_files_in_the_manifest_are_not_decoded_again(spark):
    root = scratch_path(spark, "history-names")
    snaps = silver.add_time_to_maturity(adapter.loan_snapshots(spark, SF), adapter.REFERENCE_DATE).limit(40)
    snaps.write.parquet(f"{root}/landed")
    schema, now = spark.read.parquet(f"{root}/landed").schema, V.now(spark, SF)
    history.append_snapshots(spark, f"{root}/landed", schema, now, f"{root}/history", f"{root}/a")
    unreadable = StructType([StructField(f.name, BooleanType() if f.name == "noi_annual" else f.dataType) for f in schema])  # a column that can't be decoded so
    history.append_snapshots(spark, f"{root}/landed", unreadable, now, f"{root}/history", f"{root}/lost")
    assert history.read_history(spark, f"{root}/history").count() == 40


def test_rows_of_scenarios_are_written_without_a_sort(spark, monkeypatch):
    path, rows = scratch_path(spark, "runs-unsorted"), observed(spark).crossJoin(spark.range(50).drop("id"))
    seen, key = [], "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    real = stress._write_unsorted
    monkeypatch.setattr(stress, "_write_unsorted", lambda r, p: (real(r, p), seen.append(spark.conf.get(key))))
    stress.run_and_commit(rows, stress.scenario_table(spark), scorer, path)
    assert seen == [before]  # the setting is as it was
    assert len(set(r.file for r in spark.read.parquet(f"{path}/rows").select(F.input_file_name().alias("file")).distinct().collect())) >= 8
    committed = stress.read_committed(spark, path).groupBy("scenario_name").count().collect()
    assert {r["count"] for r in committed} == {100} and len(committed) == 8
    broken = observed(spark).withColumn("current_balance", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        stress.run_and_commit(broken, stress.scenario_table(spark), scorer, path)
    assert spark.conf.get(key) == before


def test_frames_are_staged_by_the_columns_in_use(spark):
    from refiscope.catalog import risk_queries as RQ

    assert RQ.surv_frame(spark, SF).columns == RQ.SURVIVAL_COLUMNS
    rows, features = RQ.fitted_survival.__globals__["survival"].model_frame(V.state(spark, SF), RQ.frame.market_curves(V.loan_market(spark, SF)))
    assert set(features) <= set(rows.columns) and not {"deal_name", "property_id", "snapshot_at"} & set(rows.columns)


def test_the_export_prices_the_loans_once(spark, monkeypatch):
    star_schema_export = catalog.load()[0]["star_schema_export"]
    calls, priced = [], V.state
    monkeypatch.setattr(V, "state", lambda *args: calls.append(1) or priced(*args))
    counts = {r.table_name: r.n for r in star_schema_export(spark, SF).collect()}
    assert len(calls) == 1 and len(counts) == 10 and counts["fact_stress_results"] == 8 * counts["dim_loan"]
