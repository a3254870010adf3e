"""Scoring, audit, sources, state, streams and the whole training flow."""

import datetime
import json
import math

import pytest
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.operators import audit, scoring
from hearthline.operators.models import LinearFormula
from hearthline.operators.preprocess import FeatureFit, Preprocessing
from hearthline.plans import house
from hearthline.sources import files, state
from hearthline.streaming import flows
from test_quality import EXAMPLE, requests

FIT = Preprocessing(tuple(FeatureFit(f, 1.0, 0.0, 1.0) for f in S.FEATURES))
SCORER = scoring.Scorer("linear_regression", LinearFormula(tuple(S.FEATURES), (0.0, 0.0, 100.0) + (0.0,) * 8, 1000.0), FIT)


def test_scores_and_refusals(spark):
    scored, refused = scoring.batch_score(requests(spark, EXAMPLE, {**EXAMPLE, "sqft_living": 99}), SCORER)
    row = scored.first()
    assert (row["prix_predit"], row["confiance"], row["modele_utilise"]) == (181000.0, "Faible", "linear_regression")
    assert len(row["request_id"]) == 36 and row["timestamp"].endswith("Z")
    assert refused.first()["reasons"] == ["sqft_living < 100"]


def test_audit_record_shape(spark):
    bad = {**EXAMPLE, "bedrooms": None}
    rows = scoring.audit_rows(requests(spark, EXAMPLE, bad), SCORER, client_ip=F.lit("10.0.0.1"), duration_ms=F.lit(15.237)).toJSON().collect()
    good, failed = (json.loads(r) for r in rows)
    assert good["status"] == "success" and good["input"]["feature_count"] == 11 and good["performance"]["duration_ms"] == 15.24
    assert good["output"] == {"prediction": 181000.0, "confidence": "Faible", "model_used": "linear_regression"}
    assert failed["status"] == "error" and failed["error"] == "bedrooms missing"
    assert failed["output"]["prediction"] == 0.0 and failed["output"]["confidence"] == "Erreur"


def test_audit_keeps_the_request_as_it_came(spark):
    row = scoring.audit_rows(requests(spark, {**EXAMPLE, "sqft_basement": None}), SCORER).first()
    assert row["error"] == "sqft_basement missing" and row["input"]["features"]["sqft_basement"] is None


def test_no_model_raises_before_any_record(spark):
    with pytest.raises(ValueError, match="no model"):
        scoring.audit_rows(requests(spark, EXAMPLE), scoring.Scorer("none", None, FIT))


def test_audit_log_counts_and_tail(spark, tmp_path):
    lines = ['{"event_type":"prediction","status":"success"}', "123", "plain text", '{"event_type":"error"}',
             '{"event_type":"prediction","status":"error"}', '{"event_type":"other"}', '{"event_type":"health_check"}', '{"broken":']
    (tmp_path / "a.log").write_text("\n".join(lines) + "\n")
    log = files.scan_audit_log(spark, str(tmp_path))
    assert tuple(audit.audit_event_counts(log).first()) == (2, 1, 1)
    tail = audit.audit_tail(log, 3, files.LINE_ORDER).collect()
    assert [r["entry"] or r["raw_message"] for r in tail] == lines[::-1][:3]
    assert tail[0]["type"] == "raw" and tail[0]["total_logs"] == 8 and tail[0]["showing"] == 3
    assert audit.audit_tail(log, 100, files.LINE_ORDER).first()["showing"] == 8
    with pytest.raises(ValueError):
        audit.audit_tail(log, 0)


def test_audit_sink_appends_json_lines(spark, tmp_path):
    path = str(tmp_path / "log")
    files.sink_audit(scoring.audit_rows(requests(spark, EXAMPLE), SCORER), path)
    files.sink_audit(scoring.health_record(True, 1.234, spark), path)
    files.sink_audit(scoring.error_record(spark, "startup", "no file", {"path": "x"}), path)
    files.sink_audit(scoring.error_record(spark, "startup", "no details"), path)
    log = files.scan_audit_log(spark, path)
    assert tuple(audit.audit_event_counts(log).first()) == (1, 1, 2)
    parsed = {r["event_type"]: r for r in audit.parse_audit(log).select("record.*").where("message IS NULL OR message = 'no file'").collect()}
    assert parsed["error"]["details"] == {"path": "x"} and parsed["health_check"]["model_loaded"] is True
    assert parsed["prediction"]["input"]["features"]["sqft_living"] == 1800.0


def test_csv_in_two_encodings(spark, tmp_path):
    for name, encoding in (("u.csv", "utf-8"), ("l.csv", "latin-1")):
        (tmp_path / name).write_bytes("id,ville\n1,Évry\n2,Nîmes\n".encode(encoding))
        assert [r["ville"] for r in files.scan_raw(spark, str(tmp_path / name)).orderBy("id").collect()] == ["Évry", "Nîmes"]


def test_csv_types_follow_the_content(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b,c,d,e,f,g\n1,1,1.5,x,True,NA,1d\n2,,nan,"y ""q"", z",False,,2\n')
    df = files.scan_raw(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "double", "d": "string", "e": "boolean", "f": "double", "g": "string"}
    assert df.collect()[1]["d"] == 'y "q", z' and df.collect()[1]["b"] is None


def test_csv_cell_over_two_lines(spark, tmp_path):
    (tmp_path / "m.csv").write_text('id,t\n1,"two\nlines"\n2,one\n')
    assert [r["t"] for r in files.scan_raw(spark, str(tmp_path / "m.csv")).orderBy("id").collect()] == ["two\nlines", "one"]


def test_unknown_formats_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        files.scan_raw(spark, "x", "excel")
    with pytest.raises(ValueError):
        files.scan_table(spark, "x.xlsx")
    with pytest.raises(ValueError):
        files.sink_table(spark.range(1), str(tmp_path / "x.xlsx"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.scan_raw(spark, str(tmp_path / "absent.csv"))


def test_one_split_reads_only_its_files(spark, tmp_path):
    path = str(tmp_path / "s")
    files.sink_splits(spark.range(90).selectExpr("id", "CASE id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split"), path)
    train = files.scan_splits(spark, path, "train")
    assert train.count() == 30
    assert "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().executedPlan().toString()


RAW_HEADER = ["Id", "Price", *[f.replace("_", " ").title() for f in S.FEATURES]]


def raw_csv(path, n=400):
    lines = [",".join(RAW_HEADER)]
    for i in range(n):
        living = 500 + (i * 37) % 3000
        row = {"bedrooms": i % 6, "bathrooms": 1 + i % 4 * 0.5, "sqft_living": living, "sqft_lot": 1000 + (i * 53) % 9000,
               "floors": 1 + i % 3 * 0.5, "waterfront": int(i % 50 == 0), "view": i % 5, "condition": 1 + i % 5,
               "sqft_above": living - (i * 7) % 400, "sqft_basement": "" if i % 11 == 0 else (i * 7) % 400, "yr_built": 1900 + i % 120}
        price = 50000 + 120 * living + 9000 * row["bathrooms"] - 300 * (2024 - row["yr_built"])
        lines.append(",".join(str(v) for v in [i, price, *row.values()]))
    lines += [lines[5], lines[6]]
    path.write_text("\n".join(lines) + "\n")


def test_training_from_raw_file_to_scores(spark, tmp_path):
    raw_csv(tmp_path / "raw.csv")
    out = str(tmp_path / "out")
    config = {"linear_regression": {"algorithm": "LinearRegression", "hyperparameters": {"fit_intercept": True}},
              "random_forest": {"algorithm": "RandomForestRegressor", "hyperparameters": {"n_estimators": 3, "max_depth": 3, "random_state": 42}}}
    chosen = house.run_training(spark, str(tmp_path / "raw.csv"), out, config=config)
    assert chosen.best.name == "linear_regression" and chosen.test["r2"] > 0.999 and chosen.generalisation == "excellent"
    splits = {r["split"]: r["count"] for r in files.scan_splits(spark, f"{out}/splits").groupBy("split").count().collect()}
    assert splits == {"train": 280, "val": 40, "test": 80}
    runs = spark.read.parquet(f"{out}/runs")
    assert {r["run_name"] for r in runs.collect()} == {"train_linear_regression", "train_random_forest", "test_linear_regression"}
    table = files.scan_table(spark, f"{out}/comparison.csv")
    assert table.first()["model"] == "linear_regression" and "cv_rmse_mean" in table.columns

    assert state.model_health(spark, out, f"{out}/fit").first()["status"] == "healthy"
    assert state.model_health(spark, out, f"{out}/nothing").first()["status"] == "unhealthy"
    scorer = house.load_scorer(spark, out)
    scored, _ = scoring.batch_score(requests(spark, EXAMPLE), scorer)
    assert scored.first()["prix_predit"] == pytest.approx(50000 + 120 * 1800 + 9000 * 2 - 300 * 29, abs=2000)
    info = state.dataset_info(files.scan_splits(spark, f"{out}/splits"), S.FEATURES)
    assert info["train_samples"] == 280 and info["n_features"] == 11 and math.isfinite(info["price_std_val"])


def test_a_second_run_leaves_the_first_one_as_it_was(spark, tmp_path):
    raw_csv(tmp_path / "one.csv")
    lines = (tmp_path / "one.csv").read_text().splitlines()
    other = [lines[0]] + [",".join([c[0], str(float(c[1]) * (1 + k * 7919 % 13)), *c[2:4], str(int(c[4]) * 9 + 777), *c[5:]])
                          for k, c in enumerate(x.split(",") for x in lines[1:-2])]
    (tmp_path / "two.csv").write_text("\n".join(other) + "\n")
    out = str(tmp_path / "out")
    linear = {"linear_regression": {"algorithm": "LinearRegression", "hyperparameters": {}}}
    forest = {"random_forest": {"algorithm": "RandomForestRegressor", "hyperparameters": {"n_estimators": 2, "max_depth": 2, "random_state": 1}}}
    houses = requests(spark, *[{**EXAMPLE, "sqft_living": 600 + 300 * k} for k in range(5)])

    def prices(**which):
        return [r["prediction"] for r in house.load_scorer(spark, out, **which).predictions(houses).select("prediction").collect()]
    first = house.run_training(spark, str(tmp_path / "one.csv"), out, config=linear, run_id="one")
    before = prices()
    second = house.run_training(spark, str(tmp_path / "two.csv"), out, config=forest, run_id="two")
    assert first.best.metrics["val"]["r2"] > second.best.metrics["val"]["r2"]
    assert prices() == before == prices(run_id="one") and prices(run_id="two") != before
    bundles = {run: state.load_bundle(spark, out, run_id=run) for run in ("one", "two")}
    assert bundles["one"].fit != bundles["two"].fit and bundles["two"].name == "random_forest"
    assert bundles["one"].features == S.FEATURES and bundles["one"].metrics_test["r2"] > 0.999
    ready = files.scan_splits(spark, f"{out}/splits").select("id", "split")  # the second run's
    again = bundles["two"].rule.apply(spark.read.parquet(f"{out}/clean.parquet")).select("id", "split")
    assert again.exceptAll(ready).isEmpty() and ready.exceptAll(again).isEmpty()
    tags = {r["run_name"]: r["tags"] for r in spark.read.parquet(f"{out}/runs").collect()}
    assert tags["train_linear_regression"]["performance_ok"] == "True" and tags["test_linear_regression"]["verdict"] == "good"
    assert "r2" in tags["train_random_forest"]["warnings"] and tags["test_random_forest"]["run_id"] == "two"
    assert state.model_health(spark, out).first()["status"] == "healthy"
    with pytest.raises(FileNotFoundError):
        state.load_bundle(spark, out, run_id="three")


def test_models_saved_without_a_fit_are_no_bundle(spark, tmp_path):
    out = str(tmp_path)
    old = "name string, kind string, path string, features array<string>, r2_val double, saved_at timestamp"
    spark.createDataFrame([("a", "LinearRegressionModel", f"{out}/x", ["f"], 0.5, datetime.datetime(2024, 1, 1))], old).write.parquet(f"{out}/models")
    with pytest.raises(FileNotFoundError, match="no bundle"):
        state.load_bundle(spark, out)
    assert state.model_health(spark, out).first()["status"] == "unhealthy"


def test_best_saved_model_is_loaded_by_score(spark, tmp_path):
    raw_csv(tmp_path / "raw.csv", 200)
    out = str(tmp_path / "out")
    config = {n: {"algorithm": a, "hyperparameters": h} for n, a, h in [
        ("a_forest", "RandomForestRegressor", {"n_estimators": 2, "max_depth": 1, "random_state": 1}),
        ("b_linear", "LinearRegression", {})]}
    ready, fit = house.prepare(files.scan_raw(spark, str(tmp_path / "raw.csv")).dropDuplicates().transform(
        lambda d: d.toDF(*[c.strip().lower().replace(" ", "_") for c in d.columns])), fit_on="train")
    chosen = house.train_and_select(ready, config, k=0)
    for r in chosen.results.values():
        state.save_model(spark, r, out)
    assert state.load_model(spark, out)[0] == "b_linear"
    name, forest, features = state.load_model(spark, out, "a_forest")
    assert (name, features) == ("a_forest", S.FEATURES) and forest.getNumTrees == 2
    with pytest.raises(FileNotFoundError):
        state.load_model(spark, out, "c")
    with pytest.raises(FileNotFoundError):
        state.load_model(spark, str(tmp_path / "none"))


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = requests(spark, *[{**EXAMPLE, "sqft_living": 90 + 40 * i} for i in range(30)])
    rows.repartition(5).write.parquet(source)
    ident = F.md5(F.col("sqft_living").cast("string"))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    want = scoring.batch_score(spark.read.parquet(source), SCORER, ident, at)[0]
    stream = flows.read_stream(spark, source, rows.schema, max_files=2)
    flows.write_stream(flows.stream_score(stream, SCORER, ident, at), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 29 and got.exceptAll(want).count() == 0
    flows.stream_audit_lines(stream, SCORER, str(tmp_path / "log"), str(tmp_path / "cp2")).awaitTermination()
    assert tuple(audit.audit_event_counts(files.scan_audit_log(spark, str(tmp_path / "log"))).first()) == (30, 0, 0)


def test_stream_counts_over_batches_and_late_lines(spark, tmp_path):
    source = tmp_path / "in"
    schema = "ts timestamp, line string"

    def arrive(i, *moments):
        rows = [(m, '{"event_type":"prediction"}') for m in moments]
        spark.createDataFrame(rows, "ts string, line string").selectExpr("CAST(ts AS TIMESTAMP) AS ts", "line").coalesce(1).write.mode(
            "append").parquet(str(source))

    def run():
        stream = flows.read_stream(spark, str(source), spark.createDataFrame([], schema).schema, max_files=1)
        flows.write_counts(flows.stream_audit_counts(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return {str(r["window_start"]): r["n"] for r in flows.read_counts(spark, str(tmp_path / "out")).collect()}

    arrive(0, "2024-01-01 10:05:00", "2024-01-01 10:50:00")
    assert run() == {"2024-01-01 10:00:00": 2}
    arrive(1, "2024-01-01 10:59:00", "2024-01-01 11:10:00")
    assert run() == {"2024-01-01 10:00:00": 3, "2024-01-01 11:00:00": 1}
    arrive(2, "2024-01-01 15:00:00")
    assert run()["2024-01-01 15:00:00"] == 1
    arrive(3, "2024-01-01 10:01:00")  # its window closed when 15:00 was seen
    assert run()["2024-01-01 10:00:00"] == 3


def _arrive(spark, source, rows, columns):
    spark.createDataFrame(rows, columns).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)


def test_counts_of_a_renewed_checkpoint(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    columns = "ts string, line string"

    def run(checkpoint):
        schema = "ts timestamp, line string"
        stream = flows.read_stream(spark, source, spark.createDataFrame([], schema).schema, max_files=1)
        flows.write_counts(flows.stream_audit_counts(stream), out, str(tmp_path / checkpoint)).awaitTermination()
        return {str(r["window_start"]): r["n"] for r in flows.read_counts(spark, out).collect()}

    for _ in range(3):  # the first run counts in three batches
        _arrive(spark, source, [("2024-01-01 10:05:00", '{"event_type":"prediction"}')], columns)
    assert run("first") == {"2024-01-01 10:00:00": 3}
    _arrive(spark, source, [("2024-01-01 10:06:00", '{"event_type":"prediction"}')], columns)
    # the later run reads more in fewer batches; its lower batch numbers must not lose
    spark.read.parquet(source).coalesce(1).write.parquet(source + "2")
    source = source + "2"
    assert run("second") == {"2024-01-01 10:00:00": 4}
    assert run("second") == {"2024-01-01 10:00:00": 4}


def test_folders_of_counts_stay_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(flows, "FOLD", 3)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    columns = "ts string, line string"
    for i in range(11):
        _arrive(spark, source, [(f"2024-01-01 {10 + i % 2}:05:00", '{"event_type":"error"}')], columns)
    stream = flows.read_stream(spark, source, spark.createDataFrame([], "ts timestamp, line string").schema, max_files=1)
    flows.write_counts(flows.stream_audit_counts(stream, delay="9 hours"), out, checkpoint).awaitTermination()
    assert {r["window_start"].hour: r["n"] for r in flows.read_counts(spark, out).collect()} == {10: 6, 11: 5}
    folders = [f for level in (tmp_path / "out").iterdir() for f in level.iterdir() if f.is_dir()]
    assert len(folders) <= 6  # at most two of each of three levels
    # a folder left beside its fold by a crash changes nothing
    rows = spark.read.option("recursiveFileLookup", True).parquet(out)
    rows.write.parquet(f"{out}/level=0/000001-000000000000")
    assert {r["window_start"].hour: r["n"] for r in flows.read_counts(spark, out).collect()} == {10: 6, 11: 5}


def test_requests_sent_again_are_scored_and_logged_once(spark, tmp_path):
    source = str(tmp_path / "in")
    row = requests(spark, EXAMPLE).first().asDict()
    columns = requests(spark, EXAMPLE).withColumns({c: F.lit(None).cast("string") for c in ("key", "ts")}).schema

    def send(*sent):
        _arrive(spark, source, [(*row.values(), key, ts) for key, ts in sent], columns)

    send(("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:01:00"), ("a", "2024-01-01 10:00:00"))
    send(("a", "2024-01-01 10:00:30"), (None, "2024-01-01 10:02:00"), (None, "2024-01-01 10:02:00"), (None, None))
    send(("c", "2024-01-01 13:00:00"))
    send(("d", "2024-01-01 13:01:00"))
    send(("late", "2024-01-01 10:30:00"))  # behind the watermark of an earlier batch
    stream = flows.once(flows.read_stream(spark, source, spark.read.parquet(source).schema, max_files=1), "key", "ts")
    scored = flows.write_stream(flows.stream_score(stream, SCORER, keep=("key",)), str(tmp_path / "out"), str(tmp_path / "cp"))
    scored.awaitTermination()
    assert sorted(str(r["key"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["None", "a", "b", "c", "d"]
    assert flows.late(scored) == 1
    flows.stream_audit_lines(stream, SCORER, str(tmp_path / "log"), str(tmp_path / "cp2")).awaitTermination()
    assert tuple(audit.audit_event_counts(files.scan_audit_log(spark, str(tmp_path / "log"))).first()) == (5, 0, 0)


def test_requests_with_times_without_a_zone_are_passed_on_once(spark, tmp_path):
    source, columns = str(tmp_path / "in"), "key string, ts timestamp_ntz"
    noon = datetime.datetime(2024, 1, 1, 12)
    for sent in ([("a", noon), ("a", noon), ("b", noon)], [("a", noon), ("c", None), (None, noon), (None, noon)],
                 [("d", noon + datetime.timedelta(hours=3))], [("e", noon + datetime.timedelta(hours=3))], [("late", noon)]):
        spark.createDataFrame(sent, columns).coalesce(1).write.mode("append").parquet(source)
    stream = flows.once(flows.read_stream(spark, source, spark.read.parquet(source).schema, max_files=1), "key", "ts")
    assert dict(stream.dtypes) == {"key": "string", "ts": "timestamp_ntz"}
    query = flows.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    got = {(r["key"], r["ts"].hour) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("a", 12), ("b", 12), (None, 12), ("d", 15), ("e", 15)} and flows.late(query) == 1


def test_event_type_takes_whole_objects_only(spark):
    lines = ['{"event_type":"a"}, "end of line"]', '{"event_type":"a"} {}', '[{"event_type":"a"}]', '5', '', None, '{"event_type":"a"',
             '{"event_type":"a","event_type":"b"}', ' {"event_type":"b"} ', '{"event_type":"b", "end of line": 3}']
    found = audit.event_type(spark.createDataFrame([(v,) for v in lines], "line string")).collect()
    assert [r["event_type"] for r in found] == [None] * 7 + ["b"] * 3
