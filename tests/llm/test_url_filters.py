import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from repseq.llm import url_filters as U

D = dt.date


def test_hosts_and_keys(spark):
    urls = {"http://A.b.example.COM:80/x?y#z": ["example.com", "b.example.com", "a.b.example.com"], "https://u:p@h.org.": ["h.org"], "ftp://localhost/": ["localhost"], "mailto:x@y.z": [], "": [], None: []}
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", U.host_keys(U.host_of(F.col("url"))).alias("k")).collect()
    assert {r.url: r.k for r in rows} == urls


def test_intervals(spark):
    events = [("a", "x", D(2020, 1, 1), "add"), ("a", "x", D(2020, 2, 1), "add"), ("a", "x", D(2020, 3, 1), "remove"), ("a", "x", D(2020, 4, 1), "remove"), ("a", "x", D(2020, 5, 1), "add"),
              ("b", "x", D(2020, 1, 1), "remove"), ("c", "x", D(2020, 1, 1), "add"), ("c", "x", D(2020, 1, 1), "remove"), (None, "x", D(2020, 1, 1), "add"), ("d", "y", None, "add"), ("d", "y", D(2020, 1, 1), "?")]
    rows = U.validity_intervals(spark.createDataFrame([*events, events[0]], "key string, category string, dated date, action string")).collect()
    assert sorted(map(tuple, rows)) == [("a", "x", D(2020, 1, 1), D(2020, 3, 1)), ("a", "x", D(2020, 5, 1), None)]


def test_as_of_join_against_brute_force(spark):
    intervals = [("example.com", "spam", D(2020, 1, 15), D(2020, 3, 2)), ("a.example.com", "adult", D(2019, 12, 31), None), ("example.com", "adult", D(2020, 3, 2), D(2020, 3, 3)), ("org", "x", D(2000, 1, 1), None)]
    days = [D(2019, 12, 30), D(2019, 12, 31), D(2020, 1, 14), D(2020, 1, 15), D(2020, 3, 1), D(2020, 3, 2), D(2020, 3, 3), None]
    urls = ["http://a.example.com/", "http://example.com", "http://x.org/", None, "x"]
    captures = [(i, u, d) for i, (u, d) in enumerate((u, d) for u in urls for d in days)]
    frame = spark.createDataFrame([*captures, captures[3]], "page_id long, url string, fetched_on date").selectExpr("*", "1 AS host")
    table = spark.createDataFrame(intervals, "key string, category string, valid_from date, valid_to date")
    rows = U.active_entries(frame, table).collect()
    assert len(rows) == len(captures) + 1
    for r in rows:
        host = (r.url or "").removeprefix("http://").strip("/") if (r.url or "").startswith("http") else ""
        keys = {host, host.split(".", 1)[-1]} if host.count(".") > 1 else {host}
        active = [c for k, c, a, b in intervals if r.fetched_on and k in keys and a <= r.fetched_on and (b is None or r.fetched_on < b)]
        assert (r.host, r.n_entries, r.categories) == (host, len(active), ",".join(sorted(set(active))))
    assert U.active_entries(frame.limit(0), table).count() == 0
    assert U.active_entries(frame, table.limit(0)).where("n_entries > 0").count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_against_sql(spark, sf):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    rows = sorted(map(tuple, U.op3_url_filters(spark, sf).collect()))
    assert rows == sorted(db.sql(U.ORACLE).fetchall())
    assert 0 < sum(r[-1] for r in rows) < len(rows)


def test_hosts_of_many_labels_are_looked_up_whole(spark):
    labels = [f"l{i}" for i in range(39)] + ["example", "com"]
    host = ".".join(labels)
    rows = spark.createDataFrame([(host,)], "host string").select(U.host_keys(F.col("host")).alias("k")).first()
    assert rows.k == [".".join(labels[i:]) for i in range(39, -1, -1)]
    intervals = [(host, "spam", D(2020, 1, 1), None), (host.split(".", 1)[1], "adult", D(2020, 1, 1), None)]
    table = spark.createDataFrame(intervals, "key string, category string, valid_from date, valid_to date")
    captures = spark.createDataFrame([(1, f"http://{host}/", D(2020, 2, 1)), (2, f"http://x{host}/", D(2020, 2, 1))], "page_id long, url string, fetched_on date")
    got = {r.page_id: (r.n_entries, r.categories) for r in U.active_entries(captures, table).collect()}
    assert got == {1: (2, "adult,spam"), 2: (1, "adult")}


def test_hosts_too_long_to_be_one(spark):
    label = "a" * 62
    long = [".".join([label] * 4), ".".join([label] * 4) + "aa", ".".join([label] * 4) + "aaa", ".".join(["b"] * 127), ".".join(["b"] * 128), ".".join(["c"] * 6000)]
    assert [len(x) for x in long[:3]] == [251, 253, 254]
    pages = spark.createDataFrame([(i, f"http://{h}/x", "") for i, h in enumerate(long)], "page_id long, url string, html string")
    captures = U.captures_of(pages)
    got = U.active_entries(captures, U.validity_intervals(U.entries_of(captures))).orderBy("page_id").collect()
    assert [r.host for r in got] == [long[0], long[1], "", long[3], "", ""]
    db = duckdb.connect()
    rows = pages.toPandas()  # noqa: F841  DuckDB reads it by name
    db.sql("CREATE VIEW pages AS SELECT * FROM rows")
    assert [r[:2] for r in sorted(db.sql(U.ORACLE).fetchall())] == [(r.page_id, r.host) for r in got]
    assert len(spark.createDataFrame([(long[3],)], "host string").select(U.host_keys(F.col("host")).alias("k")).first().k) == 126
