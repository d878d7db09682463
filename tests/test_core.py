import datetime as dt
import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from confluo.functions import text
from confluo.operators import history, profile, quality, resolution
from confluo.plans import registry
from confluo.sources import api, files
from confluo.streaming.incremental import read_table, upsert_new_files

T = lambda *a: dt.datetime(2025, 1, *a)
CAPTURES = "source_system string, source_customer_id string, change_type string, current_record_hash string, effective_from timestamp_ntz, captured_at timestamp_ntz, effective_to string"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_history_folds_captures(spark):
    data = [
        ("S", "a", "INSERT", "h1", T(1), T(1, 1), "x"), ("S", "a", "UPDATE", "h1", T(2), T(2, 1), None), ("S", "a", "UPDATE", "h2", T(3), T(3, 1), None), ("S", "a", "UPDATE", "h3", T(3), T(3, 2), None),
        ("S", "a", "DELETE", None, T(4), T(4, 1), None), ("S", "a", "DELETE", None, T(5), T(5, 1), None), ("S", "a", "INSERT", "h3", T(6), T(6, 1), None), ("S", "a", "INSERT", "h3", T(6), T(6, 1), None),
        ("S", "b", "DELETE", None, T(1), None, None), ("S", None, "INSERT", None, T(1), None, None), ("S", "c", "INSERT", "h", None, T(1), None),
    ]
    df = spark.createDataFrame(data, CAPTURES)
    want = Counter([("S", "a", "2025-01-01 00:00:00", "2025-01-03 00:00:00", "h1"), ("S", "a", "2025-01-03 00:00:00", "2025-01-04 00:00:00", "h3"), ("S", "a", "2025-01-06 00:00:00", "open", "h3"), ("S", None, "2025-01-01 00:00:00", "open", None)])
    assert rows(history.as_text(history.type_two_history(df))) == want
    assert rows(history.as_text(history.type_two_history(df, hot_rows=1))) == want  # every key in time segments
    assert history.type_two_history(df.limit(0)).count() == 0


def test_a_row_hash_tells_values_apart(spark):
    schema = "k int, a string, b string, row_hash string, valid_from string, valid_to string"
    one = history.snapshot_merge(spark.createDataFrame([], schema), spark.createDataFrame([(1, "a||b", "c")], "k int, a string, b string"), ["k"], ["a", "b"], F.lit("t1"))
    two = history.snapshot_merge(one, spark.createDataFrame([(1, "a", "b||c")], "k int, a string, b string"), ["k"], ["a", "b"], F.lit("t2"))
    assert rows(two.select("k", "a", "valid_to")) == Counter([(1, "a||b", "t2"), (1, "a", None)])


def test_merging_batches_equals_the_whole(spark):
    import random

    rng = random.Random(3)
    data = [("S", rng.choice("abcd"), rng.choice(["INSERT", "UPDATE", "DELETE"]), rng.choice(["h1", "h2", "h3"]), T(rng.randint(1, 9)), T(rng.randint(1, 28), rng.randint(0, 23)), None) for _ in range(120)]
    data = [(*r[:3], None if r[2] == "DELETE" else r[3], *r[4:]) for r in data]
    whole = history.type_two_history(spark.createDataFrame(data, CAPTURES))
    log, dim = spark.createDataFrame([], CAPTURES), whole.limit(0)
    for i in range(0, 120, 40):
        batch = spark.createDataFrame(data[i : i + 40], CAPTURES)
        dim = history.merge_dimension(dim, log, batch)
        log = log.unionByName(batch)
    assert rows(dim) == rows(whole)


def test_upsert_and_snapshot(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "k int, h string, made string")
    s = spark.createDataFrame([(2, "b", "y"), (3, "c", "y")], "k int, h string, made string")
    assert rows(history.upsert(t, s, ["k"])) == Counter([(1, "a", "x"), (2, "b", "y"), (3, "c", "y")])
    assert rows(history.upsert(t, s, ["k"], hash_column="h")) == Counter([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")])
    assert rows(history.upsert(t, s, ["k"], preserve=["made"])) == Counter([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")])


def test_profile_finds_the_departing_load(spark):
    data = []
    for load in range(6):
        for i in range(300):
            email = None if load == 2 and i % 2 else f"user{i}@firm{i % 50}.example"
            phone = f"+1 {i:03d} 555" if load == 4 else f"{i:03d}-555-{i:04d}"
            data.append(("S", f"L{load}", email, phone, ["Retail", "Media", None, ""][i % 4], "clash"))
    df = spark.createDataFrame(data, "source_system string, load_batch_id string, email string, phone string, industry string, value string")
    found = profile.departing_loads(df, ["email", "phone", "industry"]).select("load", "column_name").distinct()
    assert rows(found) == Counter([("L2", "email"), ("L4", "phone")])
    p = {(r["load"], r["column_name"]): r for r in profile.column_profile(df, ["email", "industry"]).collect()}
    assert p["L2", "email"]["nulls"] == 150 and p["L0", "email"]["dominant_mask"].startswith("a9")
    assert p["L0", "industry"]["blanks"] == 75
    assert profile.departing_loads(df.limit(0), ["email"]).count() == 0


def test_masks(spark):
    df = spark.createDataFrame([("Ab c-12",), ("ÄÖü",), (None,), ("x" * 10_000 + "-1" * 500,)], "v string")
    got = [r[0] for r in df.select(profile.value_mask(F.col("v"))).collect()]
    assert got[:3] == ["Aa a-99", "Aa", None] and got[3].startswith("<long")


@pytest.mark.parametrize("function,value,want", [
    (text.company_name, "  Acme, Inc. ", "ACME INC"), (text.company_key, "Acme, Inc.", "ACME"), (text.company_key, "Inc", "INC"), (text.company_key_sql, "acme inc", "ACME "),
    (text.email, " User@Example.COM ", "user@example.com"), (text.email, "n/a", None), (text.email_domain, "a@b@c", "c"), (text.email_domain, "none here", None), (text.phone, "+1 (312) 555-0101", "3125550101"),
    (text.address, "12 Main Street, # 5", "12 MAIN ST 5"), (text.state, "illinois", "IL"), (text.country, "United States", "US"), (text.postal, "60601-12", "6060112"), (text.website, "https://www.Acme.com:80/x", "acme.com"), (text.name, "", None),
])
def test_text(spark, function, value, want):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(function(F.col("v"))).first()[0] == want


def test_rules_on_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", 1.5), ("A ", None), (None, 0.5)], "k string, x double")
    got = {r["rule_name"]: r["failed"] for r in quality.rule_failures(df, [{"name": "r", "type": "between", "column": "x", "min": 0, "max": 1}, {"name": "n", "type": "not_null", "column": "k"}]).unionByName(quality.unique_failures(df, "u", ["k"])).collect()}
    assert got == {"r": 1, "n": 1, "u": 2}
    assert quality.evaluated(quality.unique_failures(df.limit(0), "u", ["k"])).first()["score"] == 1.0


def test_groups(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e"), ("c", "z")], "left string, right string")
    assert rows(resolution.groups(links)) == Counter([(x, "a") for x in "abcz"] + [(x, "d") for x in "de"])


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,at\n1,2024-01-01\n2,\n3,2024-01-03\n")
    df = files.csv_scan(spark, str(tmp_path / "*.csv"), ["id", "at"])
    kept = df.where(files.newer_than("at", "2024-01-02"))
    assert sorted(r["id"] for r in kept.collect()) == ["2", "3"]
    assert df.agg(files.mark_of(df, "at")).first()[0] == "2024-01-03"
    b = files.bronze(df, "S", "o", ["id"], "run", F.lit(None).cast("timestamp")).collect()
    assert b[0]["source_record_id"] == "1" and b[0]["raw_payload"] == '{"id":"1","at":"2024-01-01"}'
    (tmp_path / "b.json").write_text('[{"x": 1}, {"x": 2}]')
    assert files.json_scan(spark, str(tmp_path / "b.json"), "x int").count() == 2


def fake_fetch(params):
    return 200, {"data": [{"id": i} for i in range(3)][(params["page"] - 1) * 2 :][:2]}


def test_paged_api(spark):
    assert [r["id"] for r in api.pages(fake_fetch, {"paging": "page", "page_size": 2})] == [0, 1, 2]
    with pytest.raises(OSError):
        list(api.pages(lambda p: (500, {}), {}))
    assert list(api.pages(lambda p: (200, {"a": {"b": [1]}}), {"records_path": "a.b"})) == [{"value": 1}]


def test_stream_upserts_new_files(spark, tmp_path):
    folder, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "k int, v string, at int"
    run = lambda: upsert_new_files(spark, folder, schema, target, check, ["k"], ["at"], buckets=4)
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (5, "e", 5)], schema).write.parquet(folder)
    run()
    spark.createDataFrame([(1, "c", 3), (2, "d", 1), (5, "late", 4)], schema).write.mode("append").parquet(folder)
    run()
    spark.createDataFrame([(1, "late", 2)], schema).write.mode("append").parquet(folder)
    run()
    run()
    assert rows(read_table(spark, target).select("k", "v", "at")) == Counter([(1, "c", 3), (2, "d", 1), (5, "e", 5)])


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["p7_found", "text_company_key", "row_validation", "suite_run", "pair_scores", "golden_master", "scd2_snapshot", "enrichment", "segment_health", "p7_batches", "silver_customer", "silver_increment", "bronze_models", "match_predictions", "cluster_table", "identity_rows", "health_features", "evaluation", "drilldown", "executive_daily", "daily_alerts", "suite_runs", "run_summary", "dq_dashboard", "ingest_results", "audit_log", "checksum", "orphan_check", "feature_utilization"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    df = registry.QUERIES[name](spark, SF)
    c = con.execute(registry.ORACLE[name])
    names = [d[0] for d in c.description]
    assert sorted(names) == sorted(df.columns)
    norm = lambda v: f"{float(v):.8g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    assert Counter(tuple(map(norm, r)) for r in df.select(*[f"`{n}`" for n in names]).collect()) == Counter(tuple(map(norm, r)) for r in c.fetchall())
