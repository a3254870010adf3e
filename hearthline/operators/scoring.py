"""Scoring tables of requests, and the audit records that go with it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.base import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions.columns import confidence, quoted
from hearthline.operators.models import LinearFormula, predict
from hearthline.operators.preprocess import Preprocessing, add_missing_features, imputed_sql, scaled_sql
from hearthline.operators.quality import valid_request, validate_ranges, violations

API_VERSION = "2.0"


@dataclass(frozen=True)
class Scorer:
    """All that scoring needs. Serving imputes exactly as training did."""

    name: str
    model: Model | LinearFormula
    fit: Preprocessing

    def predictions(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """``df`` with the prediction; the request columns keep their own values."""
        if self.model is None or self.fit is None:
            raise ValueError("no model is loaded")
        full = add_missing_features(df, self.fit)
        types = {f.name: f.dataType for f in full.schema.fields}
        scaled = scaled_sql(self.fit, imputed_sql(self.fit, types, S.NULL_DEFAULTS))
        names = [f"__z{i}" for i in range(len(scaled))]
        model = self.model
        if hasattr(model, "coefficients"):
            numbers = model if isinstance(model, LinearFormula) else LinearFormula.of(model, self.fit.features)
            model = LinearFormula(tuple(names), numbers.coefficients, numbers.intercept)
        ready = full.selectExpr("*", *[f"{e} AS {n}" for n, e in zip(names, scaled.values())])
        out = predict(ready, model, names, output).drop(*names)
        return out.drop(*[f for f in self.fit.features if f not in df.columns])


def _response(request_id: Column | None, at: Column | None, name: str) -> dict[str, Column]:
    return {
        "request_id": F.uuid() if request_id is None else request_id,
        "prix_predit": F.round("prediction", 2),
        "confiance": confidence(F.col("prediction")),
        "modele_utilise": F.lit(name),
        "timestamp": _stamp(at),
    }


def _stamp(at: Column | None) -> Column:
    moment = F.current_timestamp() if at is None else at
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def batch_score(
    requests: DataFrame, scorer: Scorer, request_id: Column | None = None, at: Column | None = None,
    keep: tuple[str, ...] = (), duration_ms: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Responses for the valid requests, and the refused rows with their reasons.

    ``duration_ms`` is what the caller measured for a request, null if nothing was.

    ``request_id`` defaults to a random one per row; give a column that follows from
    the row where a rerun must repeat it.
    """
    valid, refused = validate_ranges(requests)
    took = F.lit(None).cast("double") if duration_ms is None else F.round(duration_ms, 2)
    response = _response(request_id, at, scorer.name) | {"duration_ms": took}
    scored = scorer.predictions(valid).withColumns(response)
    columns = [*keep, *response]
    return scored.select(*[quoted(c) for c in columns]), refused


def feature_map(features: list[str] = S.FEATURES) -> Column:
    entries = [x for f in features for x in (F.lit(f), quoted(f).cast("double"))]
    return F.create_map(*entries)


def prediction_record(
    request_id: Column, features: Column, prediction: Column, tier: Column, model: Column,
    duration_ms: Column, client_ip: Column, error: Column, at: Column | None = None,
    environment: str = "development",
) -> Column:
    """The nested audit record of one prediction."""
    return F.struct(
        _stamp(at).alias("timestamp"),
        request_id.alias("request_id"),
        F.lit("prediction").alias("event_type"),
        client_ip.alias("client_ip"),
        F.struct(features.alias("features"), F.size(features).alias("feature_count")).alias("input"),
        F.struct(prediction.alias("prediction"), tier.alias("confidence"), model.alias("model_used")).alias("output"),
        F.struct(F.round(duration_ms, 2).alias("duration_ms")).alias("performance"),
        F.when(error.isNull(), "success").otherwise("error").alias("status"),
        error.alias("error"),
        F.struct(F.lit(API_VERSION).alias("api_version"), F.lit(environment).alias("environment")).alias("metadata"),
    )


def audit_rows(
    requests: DataFrame, scorer: Scorer, request_id: Column | None = None, at: Column | None = None,
    client_ip: Column | None = None, duration_ms: Column | None = None, environment: str = "development",
) -> DataFrame:
    """One record per request: scored ones as success, refused ones as error with prediction 0.

    Without a model it raises before any record is made. One scan serves both kinds.
    """
    valid = valid_request({f.name: f.dataType for f in requests.schema.fields})
    judged = scorer.predictions(requests.withColumn("__failed", ~F.coalesce(valid, F.lit(False))))
    failed = F.col("__failed")
    return judged.select(prediction_record(
        request_id=F.uuid() if request_id is None else request_id,
        features=feature_map(),
        prediction=F.when(failed, 0.0).otherwise(F.col("prediction")),
        tier=F.when(failed, S.CONFIDENCE_ERROR).otherwise(confidence(F.col("prediction"))),
        model=F.lit(scorer.name),
        duration_ms=F.lit(None).cast("double") if duration_ms is None else duration_ms,
        client_ip=F.lit(None).cast("string") if client_ip is None else client_ip,
        error=F.when(failed, F.array_join(violations(), "; ")),
        at=at, environment=environment,
    ).alias("record")).select("record.*")


def health_record(healthy: bool, duration_ms: float, spark: SparkSession, environment: str = "development") -> DataFrame:
    return spark.range(1).select(
        _stamp(None).alias("timestamp"), F.lit("health_check").alias("event_type"),
        F.lit("healthy" if healthy else "unhealthy").alias("status"), F.lit(healthy).alias("model_loaded"),
        F.round(F.lit(float(duration_ms)), 2).alias("duration_ms"), F.lit(environment).alias("environment"))


def error_record(spark: SparkSession, error_type: str, message: str, details: dict[str, str] | None = None,
                 environment: str = "development") -> DataFrame:
    pairs = [F.lit(x) for kv in (details or {}).items() for x in kv]
    return spark.range(1).select(
        _stamp(None).alias("timestamp"), F.lit("error").alias("event_type"), F.lit(error_type).alias("error_type"),
        F.lit(message).alias("message"), F.create_map(*pairs).cast("map<string,string>").alias("details"),
        F.lit(environment).alias("environment"))
