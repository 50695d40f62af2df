"""op1 on hosts longer than a DNS name, against its SQL."""

import duckdb

from refiscope.llm import queries


def test_long_hosts_equal_the_sql(spark, tmp_path):
    long = ".".join(["a" * 50] * 6)
    hosts = [f"{'x' * 260}.casino.com", f"{'user' * 70}@www.casino.com", f"www.casino.{long}.com", f"casino.{long}.com", f"{long}.fine.com", f"{long}.example.net", "www.casino.com", "fine.com"]
    rows = [(i, f"http://{h}/p") for i, h in enumerate(hosts)]
    spark.createDataFrame(rows, "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {tuple(r) for r in queries.QUERIES["op1_url_filters"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert got == set(con.execute(queries.SQL["op1_url_filters"]).fetchall())
    verdicts = {r[0]: r[-1] for r in got}
    assert [verdicts[i] for i in range(5)] == ["block", "block", "block", "block", "allow"]
