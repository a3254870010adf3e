import pytest
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.operators import quality

EXAMPLE = {"bedrooms": 3, "bathrooms": 2.0, "sqft_living": 1800, "sqft_lot": 7500, "floors": 2.0, "waterfront": 0,
           "view": 0, "condition": 3, "sqft_above": 1800, "sqft_basement": 0, "yr_built": 1995}


def requests(spark, *rows):
    return spark.createDataFrame([tuple(r[f] for f in S.FEATURES) for r in rows], S.REQUEST_SCHEMA)


def test_names_are_tidied_and_may_not_collide(spark):
    df = spark.createDataFrame([(1, 2)], [" Sqft Living ", "Price"])
    assert quality.normalize_column_names(df).columns == ["sqft_living", "price"]
    with pytest.raises(ValueError, match="collide"):
        quality.normalize_column_names(spark.createDataFrame([(1, 2)], ["A b", "a_B "]))


@pytest.mark.parametrize("columns,needed", [(4, 2), (5, 3)])
def test_sparse_rows_need_half_of_the_columns(spark, columns, needed):
    rows = [tuple(1.0 if i < present else None for i in range(columns)) for present in range(columns + 1)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(columns)))
    kept = {sum(v is not None for v in r) for r in quality.drop_sparse_rows(df).collect()}
    assert kept == set(range(needed, columns + 1))


def test_duplicates_count_nan_and_null_as_equal(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, None), (1.0, None), (nan, "a"), (nan, "a"), (2.0, "b")], "x double, t string")
    assert quality.drop_duplicates(df).count() == 3
    assert quality.count_duplicates(df).first().asDict() == {"n_rows": 5, "n_duplicates": 2}


def test_clean_and_its_report_agree(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, "a")] * 4 + [(None, None, "b"), (float("nan"), None, "b"), (3.0, None, "c")], "` X` double, y double, z string")
    report = quality.cleaning_report(df).first().asDict()
    assert quality.clean(df).count() == report["n_final"] == 2
    assert report == {"n_initial": 7, "n_final": 2, "n_duplicates": 4, "n_sparse": 1, "n_removed": 5}


def test_ranges_give_all_reasons(spark):
    bad = {**EXAMPLE, "bedrooms": 21, "sqft_lot": 499, "view": None}
    valid, refused = quality.validate_ranges(requests(spark, EXAMPLE, bad))
    assert valid.count() == 1
    assert refused.first()["reasons"] == ["bedrooms > 20", "sqft_lot < 500", "view missing"]


def test_bounds_belong_to_the_range(spark):
    edges = [{**EXAMPLE, name: (low if whole else float(low))} for name, whole, low, _ in S.REQUEST_BOUNDS]
    edges += [{**EXAMPLE, name: (high if whole else float(high))} for name, whole, _, high in S.REQUEST_BOUNDS]
    assert quality.validate_ranges(requests(spark, *edges))[1].count() == 0


def test_whole_numbers_may_come_as_doubles_but_not_as_fractions(spark):
    df = requests(spark, EXAMPLE, EXAMPLE).withColumn(
        "bedrooms", F.when(F.monotonically_increasing_id() % 2 == 0, 3.0).otherwise(3.5)).coalesce(1)
    valid, refused = quality.validate_ranges(df)
    rows = valid.count() + refused.count()
    assert rows == 2 and all(r["reasons"] == ["bedrooms not whole"] for r in refused.collect())


def test_nan_request_is_refused(spark):
    df = requests(spark, {**EXAMPLE, "bathrooms": float("nan")})
    valid, refused = quality.validate_ranges(df)
    assert valid.count() == 0 and refused.first()["reasons"] == ["bathrooms missing"]


def test_profile_and_describe(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, float("nan"), None), (3, 4.0, "b"), (10, None, "b")], "i int, x double, t string")
    profile = {r["column_name"]: (r["n_rows"], r["n_missing"], r["type"]) for r in quality.profile_table(df).collect()}
    assert profile == {"i": (4, 0, "int"), "x": (4, 2, "double"), "t": (4, 1, "string")}
    rows = {r["column_name"]: r for r in quality.describe_numeric(df).collect()}
    assert rows["i"]["q50"] == 2.5 and rows["x"]["count"] == 2 and rows["x"]["mean"] == 2.5
    assert set(rows) == {"i", "x"}


def test_casts_count_missing_flags_as_zero(spark):
    df = spark.createDataFrame([(True,), (None,), (False,)], "b boolean")
    assert [r[0] for r in quality.cast_columns(df, {"b": "int", "absent": "int"}).collect()] == [1, 0, 0]


def test_topk_ties_go_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)], "t string")
    assert [tuple(r) for r in quality.value_counts_topk(df, "t", 2).collect()] == [("c", 2), ("a", 1)]


def test_valid_rows_are_filtered_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "r")
    requests(spark, EXAMPLE).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    df = quality.validate_ranges(spark.read.parquet(path))[0].select("bedrooms")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(" in plan and "GreaterThanOrEqual(bedrooms,0)" in plan


def test_heavy_hitters_equal_the_full_grouping(spark, monkeypatch):
    skewed = "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 7 = 0 THEN 'b' WHEN id % 11 = 0 THEN NULL ELSE concat('v', id % 900) END AS v"
    flat = "concat('v', id % 5000) AS v"
    monkeypatch.setattr(quality, "BUCKETS", 512)
    for expr, tracked in ((skewed, 16), (skewed, 10_000), (flat, 64), ("CAST(NULL AS string) AS v", 10), ("id % 3 AS v", 10)):
        rows = spark.range(40_000).selectExpr(expr, "id AS n", "1 AS __bucket")
        got = quality.heavy_hitters(rows, "v", 5, tracked)
        assert got.collect() == quality.value_counts_topk(rows, "v", 5).collect()
    assert quality.heavy_hitters(rows.limit(0), "v").count() == 0
