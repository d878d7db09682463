import datetime as dt
import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from confluo import config
from confluo.functions import scores, similarity, text
from confluo.operators import audit, health_model, quality, resolution, suites
from confluo.plans import accounts
from confluo.sources import api, ingest, sinks, systems

T = lambda *a: dt.datetime(2025, 1, *a)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# ---- ingestion
def service(spark, path):
    return ingest.Ingestion(spark, f"{path}/bronze", ingest.WatermarkStore(spark, f"{path}/marks"), lambda: "2026-01-01", sleep=lambda s: None)


def test_ingestion_keeps_what_is_new_and_moves_the_mark(spark, tmp_path):
    s = service(spark, tmp_path)
    data = [("1", "old", "2024-01-01T00:00:00"), ("2", "new", "2024-01-02T00:00:00"), ("3", "undated", None)]
    source = ingest.Source("CRM", "customers", lambda since: spark.createDataFrame(data, "customer_id string, company_name string, at string"), ["customer_id"], "at")
    first = s.ingest(source, "r1")
    assert (first.status, first.rows, first.mark) == ("SUCCESS", 3, "2024-01-02T00:00:00") and s.marks.get("CRM", "customers") == first.mark
    second = s.ingest(source, "r2")
    assert (second.rows, second.mark) == (1, None) and s.marks.get("CRM", "customers") == first.mark
    got = spark.read.parquet(s.path(source)).where("customer_id = '2'").first()
    assert got["source_record_id"] == "2" and json.loads(got["raw_payload"]) == {"customer_id": "2", "company_name": "new", "at": "2024-01-02T00:00:00"}
    with pytest.raises(ValueError):
        s.marks.save("CRM", "customers", " ", "now")


def test_a_failure_never_passes_for_the_end_of_the_data(spark, tmp_path):
    s, calls = service(spark, tmp_path), []

    def extract(since):
        calls.append(since)
        if len(calls) < 2:
            raise OSError("not yet")
        return spark.createDataFrame([("1",)], "id string")

    assert s.ingest(ingest.Source("A", "x", extract, ["id"]), "r").attempts == 2

    def broken(batches):
        yield next(batches)
        raise OSError("in the middle")

    bad = ingest.Source("B", "x", lambda since: spark.createDataFrame([(str(i), str(i)) for i in range(50)], "id string, at string").repartition(4).mapInPandas(broken, "id string, at string"), ["id"], "at")
    off = ingest.Source("C", "x", extract, ["id"], enabled=False)
    assert [r.status for r in s.ingest_all([bad, off], "r")] == ["FAILED", "SKIPPED"] and s.marks.get("B", "x") is None
    with pytest.raises(Exception, match="middle"):
        s.ingest(bad, "r")


def test_waits_double_up_to_a_bound():
    waits = []
    with pytest.raises(OSError):
        ingest.retried(lambda: (_ for _ in ()).throw(OSError()), 5, 10, 30, sleep=waits.append)
    assert waits == [10, 20, 30, 30]


def test_api_over_http(spark):
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def answer(self, page):
            seen.append((self.command, self.headers.get("Authorization"), page))
            body = json.dumps({"data": [{"id": i} for i in range(3)][(page - 1) * 2 :][:2]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            self.answer(int(self.path.split("page=")[-1].split("&")[0]))

        def do_POST(self):
            self.answer(json.loads(self.rfile.read(int(self.headers["Content-Length"])))["page"])

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(api.PagedApi)
    for method in ("GET", "POST"):
        df = spark.read.format("paged_api").options(url=f"http://127.0.0.1:{server.server_port}/x", method=method, token="t", paging="page", page_size="2").load()
        assert sorted(json.loads(r["record"])["id"] for r in df.collect()) == [0, 1, 2]
    server.shutdown()
    assert {(m, a) for m, a, _ in seen} == {("GET", "Bearer t"), ("POST", "Bearer t")} and {p for *_, p in seen} == {1, 2}


# ---- sources in one form
def test_bronze_model_and_conformed_rows(spark):
    schema = "source_record_id string, usage_event_id string, customer_id string, event_date date, company_name string, created_date timestamp_ntz, last_modified_timestamp timestamp_ntz, is_deleted boolean, load_batch_id string, load_timestamp timestamp_ntz"
    data = [(None, None, "c1", dt.date(2025, 1, 2), "A", None, None, None, None, T(3)), (" ", "", "c2", None, "B", None, T(1), True, "L", T(3))]
    b = systems.bronze_model(spark.createDataFrame(data, schema), "PRODUCT_USAGE", "run-9").collect()
    assert [(r["source_record_id"], r["load_batch_id"], r["is_deleted"], r["last_modified_timestamp"]) for r in b] == [("c1-2025-01-02", "run-9", False, T(3))]
    c = systems.conformed(systems.bronze_model(spark.createDataFrame(data, schema), "PRODUCT_USAGE"), "PRODUCT_USAGE").first()
    assert c["source_customer_id"] == "c1" and c["email"] is None and c["source_priority"] == 30


@pytest.mark.parametrize("function,value,want", [
    (text.certifications, '["a ", "B", ""]', ["A", "B"]), (text.certifications, " x, y ,,", ["X", "Y"]), (text.certifications, None, []), (text.certifications, '{"a": 1}', []), (text.as_number, " 12.5 ", 12.5), (text.as_number, "x", None),
    (text.as_integer, "-3.9", -3), (text.day_of, "2024-01-02T03:04:05Z", "2024-01-02"), (text.day_of, " ", None), (text.enabled_share, '{"a": true, "b": false, "c": "false", "d": null}', 0.5), (text.enabled_share, "[1, 0, {}, [0]]", 0.5),
    (text.enabled_share, "{}", None), (text.enabled_share, "no json", None), (text.as_time, "2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)), (text.as_time, "12345", None), (text.as_time, None, None),
])
def test_coercions(spark, function, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(function(F.col("v"))).first()[0] == want


def test_similarities(spark):
    df = spark.createDataFrame([("martha", "marhta"), ("a", None), ("", ""), ("abc", "xyz")], "a string, b string")
    got = df.select(similarity.exact(F.col("a"), F.col("b")), similarity.edit_share(F.col("a"), F.col("b")), similarity.jaro_winkler("a", "b"), similarity.sequence_ratio("a", "b")).collect()
    assert tuple(got[0]) == (0.0, 0.66666667, 0.96111111, 0.83333333) and tuple(got[1]) == (None,) * 4 and tuple(got[2]) == (1.0, 1.0, 1.0, 1.0) and tuple(got[3]) == (0.0, 0.0, 0.0, 0.0)


# ---- resolution
def test_hot_blocks_give_the_same_pairs(spark):
    data = [("S", f"i{i:02d}", "shared@x.example", None, None, f"name {i % 4}", None) for i in range(30)]
    df = spark.createDataFrame(data, "source_system string, id string, email string, phone string, website_domain string, company_name string, address string")
    want = Counter((f"i{a:02d}", f"i{b:02d}") for a in range(30) for b in range(a + 1, 30))
    assert rows(resolution.candidate_pairs(df)) == want == rows(resolution.candidate_pairs(df, block_rows=4))


MEMBER = "source_system string, source_customer_id string, company_name string, email string, phone string, address string, source_priority int, data_quality_score decimal(5,4), completeness_score decimal(5,4), created_date timestamp_ntz, last_modified_timestamp timestamp_ntz, standardized_at timestamp_ntz, load_batch_id string, is_deleted boolean"


def member(i, system="S", lm=1, deleted=False, priority=10, **v):
    return (system, i, v.get("company"), v.get("email"), v.get("phone"), v.get("address"), priority, v.get("dq"), None, T(1), T(lm), T(lm), "L", deleted)


def test_golden_records_take_counting_rows(spark):
    data = [member("a", company="Old Best", email="old@x.example", lm=1, priority=1), member("a", company="New", email="bad", phone="(555) 010-1234", lm=2), member("b", company="Gone", lm=1), member("b", company="Gone", lm=2, deleted=True), member("c", email="c@x.example", priority=20), member("a", system="T", company="Other system")]
    m = spark.createDataFrame([("k", "S", x) for x in "abca"], "cluster_id string, source_system string, source_customer_id string")
    held = spark.createDataFrame([("k", "S", "c", 0.9)], "cluster_id string, representative_source_system string, representative_source_customer_id string, confidence_score double")
    got = resolution.golden_records(m, spark.createDataFrame(data, MEMBER), ("company_name", "email", "phone", "address"), held).collect()
    assert len(got) == 1 and (got[0]["company_name"], got[0]["email"], got[0]["phone"], got[0]["address"]) == ("New", "c@x.example", "5550101234", None)
    assert (got[0]["members"], got[0]["completeness"], got[0]["primary_source_customer_id"], got[0]["confidence_score"]) == (2, 0.75, "c", 0.9)
    assert json.loads(got[0]["survivorship"])["email"] == {"source_system": "S", "source_customer_id": "c", "value": "c@x.example", "confidence": "0.2000"}
    assert resolution.golden_records(m.limit(0), spark.createDataFrame(data, MEMBER), ("email",)).count() == 0


def test_clusters_and_identities(spark):
    r = spark.createDataFrame([("S", "a"), ("T", "b"), ("S", "c")], "source_system string, id string")
    scored = spark.createDataFrame([("a", "b", 0.96, 0.9, "r1"), ("b", "c", 0.5, 0.4, "r2")], "left string, right string, match_probability double, confidence double, blocking_rule string")
    c = {x["cluster_size"]: x for x in resolution.cluster_rows(scored, r).collect()}
    assert c[2]["source_customer_ids"] == ["a", "b"] and c[2]["cluster_rules"] == ["r1"] and c[2]["avg_match_probability"] == 0.96 and c[1]["max_match_probability"] == 1.0
    assert c[2]["cluster_id"].startswith("cluster_") and len(c[2]["cluster_id"]) == 32 and c[2]["cluster_id"][8:] == c[2]["golden_customer_id"][5:]
    clusters = resolution.cluster_rows(scored, r).withColumn("source_members", F.when(F.col("cluster_size") > 2, F.col("source_members")))
    ids = rows(resolution.identity_rows(clusters, spark.createDataFrame([("S", "c", "rec")], "source_system string, source_customer_id string, source_record_id string")).select("source_customer_id", "source_record_id", "is_primary_source"))
    assert ids == Counter([("c", "rec", True)])  # two systems without members can't be told apart


# ---- health
def test_health_labels(spark):
    df = spark.createDataFrame([("healthy", None), ("AT_RISK", "x"), (None, " churn-risk"), ("n/a", "")], "a string, b string")
    assert [r[0] for r in df.select(scores.health_class(F.col("a"), F.col("b"))).collect()] == ["Healthy", "At Risk", "Churn Risk", None]


def test_models_are_trained_chosen_and_used(spark):
    data = [(str(i), float(i % 3) + (i % 5) / 100, float(i % 3 == 1), ("At Risk", "Churn Risk", "Healthy")[i % 3]) for i in range(90)]
    df = spark.createDataFrame(data, "k string, x double, y double, label string")
    a, b = health_model.split(df, "k")
    assert {r["k"] for r in a.collect()}.isdisjoint(r["k"] for r in b.collect()) and a.count() + b.count() == 90 and {r["label"] for r in b.collect()} == {"At Risk", "Churn Risk", "Healthy"}
    best, model, figures = health_model.choose(df, ["x", "y"], "k", accounts.evaluated)
    assert best in health_model.CANDIDATES and all(0 <= r["accuracy"] <= 1 for r in figures.collect()) and figures.where("chosen").count() == 1
    out = health_model.predict(model, df.drop("label"), ["k"]).collect()
    assert len(out) == 90 and abs(sum(json.loads(out[0]["probabilities"]).values()) - 1) < 1e-5
    tiny = df.limit(5)
    assert [x.count() for x in health_model.split(tiny, "k")] == [5, 5]


# ---- quality
def test_suites_raise_and_tell(spark):
    data = [member("a", email="bad@@", lm=1), member("a", email="no", lm=1)]
    df = spark.createDataFrame(data, MEMBER)
    told = []
    with pytest.raises(ValueError, match="source_customer_unique"):
        suites.validate(df, "silver", F.lit(T(9)), told.append)
    assert {x["rule_name"] for x in told} == {"source_customer_unique", "email_valid_format", "silver_customer_freshness_24h"}
    good = spark.createDataFrame([member("a", email="a@x.example", lm=1)], MEMBER)
    assert suites.validate(good, "silver", F.lit(T(1, 12))).count() == 10
    assert suites.summary(suites.run(df, suites.SUITES["customer_silver_suite"], F.lit(T(9)))).first()["metrics_failed"] == 3


def test_suites_from_documents(spark):
    doc = {"expectations": [{"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "x", "min_value": 0}, "meta": {"rule_name": "r", "rule_type": "validity", "severity": "WARNING"}}, {"expectation_type": "expect_compound_columns_to_be_unique", "kwargs": {"column_list": ["x", "y"]}, "meta": {"rule_name": "u"}}]}
    df = spark.createDataFrame([(-1.0, "a"), (2.0, None), (2.0, None)], "x double, y string")
    got = {r["rule_name"]: (r["failed"], r["status"]) for r in suites.run(df, suites.from_document(doc)).collect()}
    assert got == {"r": (1, "WARN"), "u": (2, "FAIL")}
    with pytest.raises(ValueError):
        suites.from_document({"expectations": [{"expectation_type": "other"}]})
    assert quality.evaluated(quality.rule_failures(df.limit(0), [{"name": "c", "type": "row_count", "min": 1}])).first()["score"] == 1.0


# ---- operations
def test_audit(spark, tmp_path):
    ticks = iter(dt.datetime(2026, 1, 1) + dt.timedelta(seconds=5 * i) for i in range(99))
    log = audit.AuditLog(spark, lambda: next(ticks), str(tmp_path))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    with log.run("r", "p", "t") as run:
        run.counts.read, run.counts.inserted = 100, 100
        run.step("s", "a", "b", 2, 2, df)
    with pytest.raises(KeyError), log.run("r", "p", "bad"):
        raise KeyError("x")
    log.flush()
    got = {r["task"]: r for r in spark.read.parquet(f"{tmp_path}/runs").collect()}
    assert (got["t"]["rows_processed"], got["t"]["duration_s"], got["t"]["status"]) == (200, 10.0, "SUCCESS") and got["bad"]["status"] == "FAILED" and "KeyError" in got["bad"]["error"]
    assert audit.checksum(df) == audit.checksum(df.orderBy(F.desc("id"))) != audit.checksum(df.limit(1)) and spark.read.parquet(f"{tmp_path}/lineage").count() == 1


def test_scripts_and_sets(spark, tmp_path):
    assert sinks.statements("select ';' as a; -- no; \nselect \"b;\" /* ; */;\n;") == ["select ';' as a", '-- no; \nselect "b;" /* ; */']
    df = spark.createDataFrame([(1, "a,b")], "x int, y string")
    assert sinks.publish(df, "s", {"s": "1"}, str(tmp_path)) == "dry-run:s"
    assert sinks.publish(df, "s", {"s": "1"}, str(tmp_path), lambda i, f: f"{i}:{spark.read.option('header', True).csv(f).first()['y']}") == "1:a,b"
    with pytest.raises(KeyError):
        sinks.publish_all({"s": df, "t": df}, {"s": "1"}, str(tmp_path))


def test_tables_are_replaced_or_merged(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = str(tmp_path / "t")
    assert rows(sinks.materialise(df, path, "incremental", ["k"])) == rows(df)
    df.write.parquet(path)
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(sinks.materialise(new, path, "incremental", ["k"])) == Counter([(1, "a"), (2, "c"), (3, "d")])
    assert rows(sinks.materialise(new, path)) == rows(new) and rows(spark.read.parquet(path)) == rows(df)


def test_settings(tmp_path):
    path = tmp_path / "s.json"
    path.write_text('{"link_threshold": 0.9, "sources": {"a": {"url": "${HOST:-local}/x", "token": "${TOKEN}"}}}')
    s = config.settings(str(path), {"TOKEN": "t"})
    assert s.sources["a"] == {"url": "local/x", "token": "t"} and s.attempts == 3
    with pytest.raises(KeyError):
        config.settings(str(path), {})
    for bad in ('{"link_threshold": 1.2}', '{"other": 1}', '{"attempts": 0}'):
        path.write_text(bad)
        with pytest.raises(ValueError):
            config.settings(str(path), {})
