import pytest
from pyspark.sql import functions as F

from hearthline.operators import codes, features
from hearthline.functions.columns import bin_code, confidence, zip_zone
from hearthline.operators.quality import quantile_edges


def one(df, *columns):
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    return [r[0] for r in rows] if len(columns) == 1 else rows


def test_flags_of_missing_values_are_zero(spark):
    df = spark.createDataFrame([(None, None, None, None), (float("nan"),) * 4], "yr_renovated double, sqft_basement double, view double, waterfront double")
    fit = features.Engineering()
    out = features._projected(df, fit)
    assert one(out, "a_ete_renovee", "a_sous_sol", "vue_premium") == [(0, 0, 0)] * 2


def test_age_categories(spark):
    df = spark.createDataFrame([(2024 - a,) for a in (0, 10, 11, 30, 200, 201, -1)], "yr_built int")
    assert one(features.add_time_features(df), "categorie_age") == [
        "Neuve", "Neuve", "Récente", "Récente", "Très_ancienne", "nan", "nan"]


def test_area_categories(spark):
    df = spark.createDataFrame([(0.0,), (1000.0,), (1000.5,), (5000.0,), (1e9,), (float("inf"),), (None,), (-1.0,)], "sqft_living double")
    assert one(features.add_area_features(df), "categorie_superficie") == [
        "Petit", "Petit", "Moyen", "Très_grand", "Exceptionnel", "Exceptionnel", "nan", "nan"]


def test_no_bedrooms_keeps_the_whole(spark):
    df = spark.createDataFrame([(0, 900.0, 1.5), (3, 900.0, 1.5), (None, 900.0, 1.5)], "bedrooms int, sqft_living double, bathrooms double")
    out = features.add_quality_features(features.add_area_features(df), (None, None))
    assert one(out, "superficie_par_chambre", "ratio_sdb_par_chambre") == [(900.0, 1.5), (300.0, 0.5), (900.0, 1.5)]


def test_zero_lot_gives_a_missing_ratio_that_is_imputed(spark):
    df = spark.createDataFrame([(100.0, 0), (100.0, 50), (300.0, 100)], "sqft_living double, sqft_lot int")
    assert one(features.add_area_features(df), "ratio_interieur_terrain") == [None, 2.0, 3.0]
    fit = features.fit_engineering(df)
    assert one(features.engineer_all(df, fit), "ratio_interieur_terrain") == [2.5, 2.0, 3.0]


def test_renovation_years(spark):
    df = spark.createDataFrame([(1990, 2010), (1990, 0), (1990, None)], "yr_built int, yr_renovated int")
    assert one(features.add_time_features(df), "annees_depuis_renovation") == [14, 34, 34]
    alone = df.select("yr_renovated")
    assert one(features.add_time_features(alone), "annees_depuis_renovation") == [14, 0, 0]


def test_zip_zone_floors(spark):
    df = spark.createDataFrame([(98115,), (999,), (-1,), (None,)], "z bigint")
    assert one(df.select(zip_zone(F.col("z")).alias("z")), "z") == ["98", "0", "-1", "nan"]


def test_constant_grade_has_no_score_scale(spark):
    df = spark.createDataFrame([(3, 7), (5, 7)], "condition int, grade int")
    assert one(features.add_quality_features(df, features.grade_range(df)), "score_qualite_global") == [None, None]


def test_features_appear_only_with_their_inputs(spark):
    df = spark.createDataFrame([(2000,)], "yr_built int")
    out = features.engineer_all(df, features.fit_engineering(df))
    assert out.columns == ["yr_built", "age_propriete", "categorie_age"]


def test_odd_city_names(spark):
    df = spark.createDataFrame([("St. Paul",), ("a`b",), ("a`b",), (None,)], "city string")
    out = features.engineer_all(df, features.fit_engineering(df))
    assert set(out.columns) == {"ville_a`b", "ville_St. Paul", "city_encoded"}
    assert sorted(r["city_encoded"] for r in out.collect()) == [0, 1, 1, 2]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.5,), (30.0,), (31.0,), (None,)], "x double")
    assert one(df.select(bin_code("x", [0.0, 10.0, 30.0]).alias("b")), "b") == [0, 0, 1, 1, None, None]


def test_edges_drop_duplicates(spark):
    df = spark.createDataFrame([(1.0,)] * 80 + [(float(i),) for i in range(20)], "price double")
    edges = quantile_edges(df)
    assert edges == sorted(set(edges)) and len(edges) < 11


def test_confidence_tiers(spark):
    df = spark.createDataFrame([(500000.0,), (500000.01,), (200000.0,), (200000.01,), (424413.27,)], "p double")
    assert one(df.select(confidence(F.col("p")).alias("c")), "c") == ["Bonne", "Élevée", "Faible", "Bonne", "Bonne"]


@pytest.mark.parametrize("broadcast_rows", [1_000, 3])
def test_codes_are_ranks_whichever_way_they_are_made(spark, broadcast_rows):
    words = ["b", "a", "é", "Z", None, "b", "b", "zz", "aa"] + ["hot"] * 40
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "w string, i int")
    fit = codes.fit_label_codes(df, "w", broadcast_rows, task_rows=8)
    assert fit.small == (broadcast_rows == 1_000)
    order = sorted({w or "nan" for w in words})
    assert {r["value"]: r["code"] for r in fit.table.collect()} == {w: i for i, w in enumerate(order)}
    out = codes.lookup_label_codes(df, "w", fit, "code")
    assert {r["i"]: r["code"] for r in out.collect()} == {i: order.index(w or "nan") for i, w in enumerate(words)}
    assert out.columns == ["w", "i", "code"]


@pytest.mark.parametrize("broadcast_rows", [1_000, 1])
def test_unseen_value(spark, broadcast_rows):
    fit = codes.fit_label_codes(spark.createDataFrame([("a",), ("b",)], "w string"), "w", broadcast_rows)
    new = spark.createDataFrame([("a",), ("x",)], "w string")
    out = codes.lookup_label_codes(new, "w", fit, "code", unseen_is_error=False)
    assert {r["w"]: r["code"] for r in out.collect()} == {"a": 0, "x": None}
    with pytest.raises(Exception, match="not seen in the fit"):
        codes.lookup_label_codes(new, "w", fit, "code").collect()
