import json

from pyspark.sql import functions as F

from refiscope.plans import export
from refiscope.session import scratch_path, scratch_root, stage
from refiscope.sources import market_feeds as feeds
from refiscope.sources import tables as T

ROWS = [("a", 1.0, "alpha", 1), ("b", 2.0, "alpha", 2), ("c", 3.0, "beta", 3), ("d", 4.0, "beta", 4), ("e", 5.0, "gamma", 5)]


def small(spark):
    return spark.createDataFrame(ROWS, "id string, value double, category string, count int")


def test_partitioned_round_trip_append_and_prune(spark):
    path = scratch_path(spark, "t")
    T.write_table(small(spark), path, "category")
    assert sorted(tuple(r) for r in T.read_table(spark, path).select("id", "value", "category", "count").collect()) == ROWS
    one = T.read_partition(spark, path, "category", "beta")
    assert sorted(r.id for r in one.collect()) == ["c", "d"]
    assert "PartitionFilters: [isnotnull(category" in one._jdf.queryExecution().executedPlan().toString().replace("\n", " ")
    T.write_table(small(spark), path, "category", mode="append")
    assert T.row_count(spark, path).first().row_count == 10
    T.write_table(small(spark).where("category = 'alpha'"), path, "category")
    assert T.row_count(spark, path).first().row_count == 2


def test_dynamic_overwrite_touches_one_partition(spark):
    path = scratch_path(spark, "t")
    T.write_table(small(spark), path, "category")
    T.overwrite_partitions(small(spark).where("id = 'c'"), path, "category")
    assert sorted(r.id for r in T.read_table(spark, path).collect()) == ["a", "b", "c", "e"]


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = stage(small(spark), "x")
    assert all(f.removeprefix("file:").replace("///", "/").startswith(scratch_root(spark).removeprefix("file:")) for f in staged.inputFiles())


def test_conform_fills_and_widens(spark):
    df = spark.createDataFrame([("L", 5, "x")], "loan_id string, original_balance int, note_rate string")
    row = T.conform_bronze_loans(df).first()
    assert row.original_balance == 5.0 and row.note_rate is None and row.source is None and len(row) == 25


def test_landed_observations_drop_missing(spark, tmp_path):
    payload = {"observations": [{"date": "2024-01-01", "value": "4.25"}, {"date": "2024-02-01", "value": "."}, {"date": "2024-03-01", "value": "abc"}]}
    (tmp_path / "dgs10.json").write_text(json.dumps(payload))
    rows = feeds.read_observations_json(spark, str(tmp_path), "treasury_10y", "monthly", "DGS10").collect()
    assert [(r.data_type, r.observation_date, r.value, r.series_id) for r in rows] == [("treasury_10y", "2024-01-01", 4.25, "DGS10")]


def test_feeds(spark):
    seed = spark.createDataFrame([("2024-01", 4.0)], "month string, value double")
    assert feeds.monthly_series(seed, "sofr", "SOFR").first().observation_date == "2024-01-01"
    wide = spark.createDataFrame([("office", 6.8, 6.7), ("hotel", 8.0, None)], "property_type string, `2015-Q1` double, `2015-Q2` double")
    national = feeds.wide_cap_rates(wide)
    assert sorted((r.property_type, r.observation_date, r.value, r.metro) for r in national.collect()) == [
        ("hotel", "2015-Q1", 8.0, "National"), ("office", "2015-Q1", 6.8, "National"), ("office", "2015-Q2", 6.7, "National")]
    local = feeds.metro_cap_rates(national, feeds.metro_adjustments(spark))
    got = {(r.property_type, r.observation_date, r.metro): r.value for r in local.collect()}
    assert len(got) == 75 and got[("office", "2015-Q1", "New York")] == 6.0 and got[("office", "2015-Q1", "Houston")] == 7.3
    growth = spark.createDataFrame([("2015-Q1", 0.02), ("2015-Q2", 0.02), ("2015-Q3", -0.04)], "quarter string, annual_growth double")
    assert [r.value for r in feeds.compounded_index(growth).orderBy("observation_date").collect()] == [100.5, 101.0, 99.99]


def test_calendar_and_export(spark):
    days = export.dim_date(spark)
    ends = days.agg(F.count("*").alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi"), F.count_if("is_month_end").alias("m")).first()
    assert tuple(ends) == (5114, "2015-01-01", "2028-12-31", 168)
    state = spark.createDataFrame([("LN-1", "office", "New York", 1.0), ("LN-2", "hotel", "Gotham", 2.0)], "loan_id string, property_type string, metro_area string, current_balance double")
    folder = scratch_path(spark, "star")
    history = state.select("loan_id", F.lit("2025-01-01T00:00:00").alias("snapshot_at"))
    counts = {r.table_name: r.n for r in export.export_star_schema(folder, state, history, stress=state.where("1 = 0")).collect()}
    assert counts["fact_loan_current"] == counts["dim_loan"] == 2 and counts["fact_survival"] == counts["fact_stress_results"] == 0
    assert counts["dim_scenario"] == 8 and counts["dim_property_type"] == 5 and counts["dim_date"] == 5114
    regions = {r.metro: r.region for r in spark.read.option("header", True).csv(f"{folder}/dim_metro.csv").collect()}
    assert regions == {"New York": "Northeast", "Gotham": "Other"}
    assert export.dim_scenario(spark).where("property_type_filter = 'all'").count() == 7
