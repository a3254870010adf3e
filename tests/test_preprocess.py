import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.operators import preprocess
from hearthline.sources import state


def table(spark, n=41):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        row = [float(x) for x in rng.integers(1, 50, len(S.FEATURES))]
        row[2] = None if i % 5 == 0 else row[2]
        row[4] = float("nan") if i % 7 == 0 else row[4]
        row[9] = None if i % 3 == 0 else row[9]
        row[8] = 4.0
        rows.append((i, float(i * 100), *row))
    return spark.createDataFrame(rows, "id bigint, price double, " + ", ".join(f"{f} double" for f in S.FEATURES))


def expected(df):
    pdf = df.toPandas()
    out = {}
    for f in S.FEATURES:
        x = pdf[f].to_numpy(dtype=float)
        x = np.where(np.isnan(x), 0.0, x) if f in S.NULL_DEFAULTS else x
        m = np.nanmedian(x)
        x = np.where(np.isnan(x), m, x)
        out[f] = (m, x.mean(), x.std(), x)
    return out


def test_fit_equals_numpy(spark):
    df = table(spark)
    want = expected(df)
    for f in preprocess.fit_preprocessing(df).fits:
        assert (f.median, f.mean, f.std_pop) == pytest.approx(want[f.feature][:3], rel=1e-9, abs=1e-12)


def test_features_are_kept_during_the_fit_only(spark, monkeypatch):
    df, plain, seen = table(spark), preprocess.exact_quantiles, []
    monkeypatch.setattr(preprocess, "exact_quantiles", lambda rows, *a: seen.append((rows, rows.storageLevel.useMemory)) or plain(rows, *a))
    fit = preprocess.fit_preprocessing(df)
    assert [kept for _, kept in seen] == [True] and not seen[0][0].storageLevel.useMemory
    mine = seen[0][0].persist()  # what the caller keeps stays
    assert preprocess.fit_preprocessing(mine) == fit and mine.storageLevel.useMemory
    mine.unpersist()


def test_scaled_training_rows_have_mean_zero_and_std_one(spark):
    out, _ = preprocess.preprocess_fit_transform(table(spark))
    assert out.columns == [*S.FEATURES, "price"]
    row = out.agg(*[F.avg(f).alias(f"m{f}") for f in S.FEATURES], *[F.stddev_pop(f).alias(f"s{f}") for f in S.FEATURES]).first()
    for f in S.FEATURES:
        assert row[f"m{f}"] == pytest.approx(0, abs=1e-9)
        assert row[f"s{f}"] == pytest.approx(0 if f == "sqft_above" else 1, abs=1e-9)


def test_constant_feature_is_only_centred_on_new_rows(spark):
    fit = preprocess.fit_preprocessing(table(spark))
    new = table(spark, 3).withColumn("sqft_above", F.lit(9.0))
    assert {r["sqft_above"] for r in preprocess.preprocess_transform(new, fit).collect()} == {5.0}


def test_transform_without_fit_is_an_error(spark):
    with pytest.raises(ValueError, match="not been fitted"):
        preprocess.preprocess_transform(table(spark), None)


def test_absent_features_get_defaults_or_medians(spark):
    df = table(spark)
    fit = preprocess.fit_preprocessing(df)
    medians = {f.feature: f.median for f in fit.fits}
    row = preprocess.add_missing_features(df.select("id", "price"), fit).first()
    assert (row["condition"], row["view"], row["waterfront"], row["sqft_basement"]) == (3.0, 0.0, 0.0, 0.0)
    assert row["bedrooms"] == medians["bedrooms"]


def test_transform_uses_stored_values_and_drops_the_target(spark):
    df = table(spark)
    fit = preprocess.fit_preprocessing(df)
    one = preprocess.preprocess_transform(df.where("id = 5"), fit, keep=("id",))
    assert one.columns == ["id", *S.FEATURES]
    want = expected(df)
    row = one.first()
    for f in S.FEATURES:
        m, mean, std, x = want[f]
        assert row[f] == pytest.approx((x[5] - mean) / (std or 1.0), rel=1e-9, abs=1e-9)


def test_fit_on_some_rows_only(spark):
    df = table(spark)
    part = preprocess.fit_preprocessing(df, where=F.col("id") < 20)
    assert part == preprocess.fit_preprocessing(df.where("id < 20"))


def test_feature_without_values_is_an_error(spark):
    with pytest.raises(ValueError, match="nothing to fit"):
        preprocess.fit_preprocessing(table(spark).withColumn("view", F.lit(None).cast("double")))


def test_fit_state_survives_a_round_trip(spark, tmp_path):
    fit = preprocess.fit_preprocessing(table(spark))
    state.save_fit_state(spark, fit, str(tmp_path / "fit"))
    assert state.load_fit_state(spark, str(tmp_path / "fit")) == fit
    with pytest.raises(FileNotFoundError):
        state.load_fit_state(spark, str(tmp_path / "none"))


def test_engineered_medians_leave_no_missing_value(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1, 1.0, inf), (2, None, -inf), (3, 4.0, 2.0), (4, float("nan"), 8.0)], "id int, a double, b double")
    medians = preprocess.fit_engineered_medians(df)
    assert medians == {"a": 2.5, "b": 5.0}
    rows = preprocess.impute_engineered(df, medians).collect()
    assert all(v is not None and math.isfinite(v) for r in rows for v in r)
