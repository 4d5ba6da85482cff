"""SQL-callable functions, registered over built-in expressions only."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Category names and upper bounds of the air-quality index.
_SQL_FUNCTIONS = {
    "f_to_c": "(f DOUBLE) RETURNS DOUBLE RETURN round((f - 32) * 5 / 9, 2)",
    "c_to_f": "(c DOUBLE) RETURNS DOUBLE RETURN round(c * 9 / 5 + 32, 2)",
    "aqi_status": "(aqi INT) RETURNS STRING RETURN CASE "
                  "WHEN aqi <= 50 THEN 'Good' "
                  "WHEN aqi <= 100 THEN 'Moderate' "
                  "WHEN aqi <= 150 THEN 'Unhealthy for Sensitive Groups' "
                  "WHEN aqi <= 200 THEN 'Unhealthy' "
                  "WHEN aqi <= 300 THEN 'Very Unhealthy' "
                  "ELSE 'Hazardous' END",
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions callable from ``spark.sql``; they inline into the query plan."""
    for name, body in _SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return sorted(_SQL_FUNCTIONS)
