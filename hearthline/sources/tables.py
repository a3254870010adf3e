"""House listings and audit lines as views over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_HOUSE = """
  o.o_orderkey AS id,
  o.o_orderdate AS date,
  o.o_totalprice AS price,
  CAST(o.o_orderkey % 7 AS BIGINT) AS bedrooms,
  (1 + o.o_custkey % 9) * CAST(0.5 AS DOUBLE) AS bathrooms,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL
       ELSE CAST(400 + (o.o_orderkey * 37) % 5200 AS DOUBLE) END AS sqft_living,
  CASE WHEN o.o_orderkey % 101 = 0 THEN CAST(0 AS BIGINT) ELSE 500 + (o.o_custkey * 53) % 20000 END AS sqft_lot,
  1 + (o.o_orderkey % 5) * CAST(0.5 AS DOUBLE) AS floors,
  CAST(CASE WHEN o.o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS BIGINT) AS waterfront,
  o.o_custkey % 5 AS view,
  1 + o.o_orderkey % 5 AS condition,
  1 + o.o_custkey % 13 AS grade,
  CAST(300 + (o.o_orderkey * 37) % 4000 AS DOUBLE) AS sqft_above,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL WHEN o.o_orderkey % 2 = 0 THEN CAST(0 AS DOUBLE)
       ELSE CAST((o.o_custkey * 29) % 1500 AS DOUBLE) END AS sqft_basement,
  1900 + o.o_orderkey % 126 AS yr_built,
  CASE WHEN o.o_orderkey % 3 = 0 THEN 1950 + o.o_orderkey % 75 ELSE CAST(0 AS BIGINT) END AS yr_renovated,
  98000 + (o.o_custkey * 17) % 2200 AS zipcode
"""

# Valid in Spark and in DuckDB alike. Houses without their city need no join.
HOUSES_SQL = f"SELECT {_HOUSE} FROM orders o"
LISTINGS_SQL = f"""SELECT {_HOUSE}, n.n_name AS city
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""

AUDIT_SQL = """SELECT event_id AS line_no, CAST(ts AS TIMESTAMP) AS ts,
       CASE WHEN event_id % 13 = 0 THEN concat('plain text line ', CAST(event_id AS VARCHAR(20)))
            ELSE concat('{"event_type":"',
                        CASE WHEN event_type IN ('click','purchase') THEN 'prediction'
                             WHEN event_type = 'view' THEN 'health_check'
                             WHEN event_type = 'error' THEN 'error' ELSE 'other' END,
                        '","status":"', CASE WHEN event_id % 29 = 0 THEN 'error' ELSE 'success' END,
                        '","performance":{"duration_ms":', CAST(event_id % 40 AS VARCHAR(20)), '}}') END AS line
FROM events"""

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _view(spark: SparkSession, folder: str, sql: str, names: list[str]) -> DataFrame:
    """Run SQL over tables of one folder, passed as arguments so no shared view name is taken."""
    return spark.sql(_braced(sql, names), **{n: table(spark, folder, n) for n in names})


def _braced(sql: str, names: list[str]) -> str:
    out = sql.replace("{", "{{").replace("}", "}}")
    for n in names:
        out = out.replace(f"FROM {n}", "FROM {" + n + "}").replace(f"JOIN {n}", "JOIN {" + n + "}")
    return out


def houses(spark: SparkSession, folder: str) -> DataFrame:
    return houses_of(table(spark, folder, "orders"))


def houses_of(orders: DataFrame) -> DataFrame:
    """Houses from an orders table, batch or stream."""
    return orders.sparkSession.sql(_braced(HOUSES_SQL, ["orders"]), orders=orders)


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, LISTINGS_SQL, ["orders", "customer", "nation"])


def audit_log(spark: SparkSession, folder: str) -> DataFrame:
    return audit_of(table(spark, folder, "events"))


def audit_of(events: DataFrame) -> DataFrame:
    """Audit lines from an events table, batch or stream."""
    return events.sparkSession.sql(_braced(AUDIT_SQL, ["events"]), events=events)
