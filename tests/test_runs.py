from tidedesk.operators import runs


def test_metrics_and_history(spark):
    checks = spark.createDataFrame([("a", True), ("b", False)], "check string, passed boolean")
    r = runs.run_metrics(spark, run_id="r", timestamp="t", checks=checks, ingested=checks).first()
    assert (r.records_ingested, r.records_validated, r.quality_checks_failed, r.anomalies_found, r.agent_actions_taken) == (2, 0, 1, 0, 0)
    assert r.pipeline_status == "success"
    h = spark.createDataFrame([(f"r{i}", f"2024-01-{i:02d}") for i in range(1, 21)], "run_id string, timestamp string")
    assert [x.run_id for x in runs.last_runs(h.repartition(4), 3).collect()] == ["r18", "r19", "r20"]
    assert runs.last_runs(h.limit(0)).count() == 0


def test_freshness(spark):
    expected = spark.createDataFrame([("a", "failed"), ("b", "degraded"), ("c", "failed")], "name string, missing_status string")
    seen = spark.createDataFrame([("a", "2024-01-02 00:00:00"), ("a", "2024-01-01 00:00:00"), ("c", "2024-01-01 00:00:00")],
                                 "name string, seen_at string")
    seen = seen.withColumn("seen_at", seen.seen_at.cast("timestamp"))

    def at(t, exp=expected):
        rows = runs.freshness(exp, seen, t).collect()
        return {r.name: r.status for r in rows}, {r.overall for r in rows}

    assert at("2024-01-02 00:00:00") == ({"a": "ok", "b": "degraded", "c": "ok"}, {"degraded"})
    assert at("2024-01-02 01:00:00") == ({"a": "ok", "b": "degraded", "c": "degraded"}, {"degraded"})
    gone = spark.createDataFrame([("a", "failed"), ("z", "failed")], "name string, missing_status string")
    assert at("2024-01-02 00:00:00", gone) == ({"a": "ok", "z": "failed"}, {"failed"})
    assert at("2024-01-02 00:00:00", gone.limit(1)) == ({"a": "ok"}, {"ok"})
