"""External tables over the gold layer and the consumer views."""

from __future__ import annotations

from pyspark.sql import SparkSession

from wardflow.schemas import GOLD_METRICS, PREDICTIONS
from wardflow.sources.lake import TABLES, path_of

_EXTERNAL = {
    "gold_ops_metrics_hourly": ("gold_metrics", GOLD_METRICS),
    "gold_predictions": ("gold_predictions", PREDICTIONS),
}


def create_tables(spark: SparkSession, root: str, database: str = "default") -> None:
    """Declares the gold tables where their files are and registers their partitions."""
    for name, (table, schema) in _EXTERNAL.items():
        columns = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in schema]
                            + [f"{c} string" for c in TABLES[table][1] if c not in schema.fieldNames()])
        by = ", ".join(TABLES[table][1])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet "
                  f"PARTITIONED BY ({by}) LOCATION '{path_of(root, table)}'")
        spark.sql(f"MSCK REPAIR TABLE {database}.{name}")


def create_views(spark: SparkSession, database: str = "default", as_of: str | None = None,
                 temporary: bool = False) -> None:
    """`vw_current_status` and `vw_forecast_next_24h` over the external tables.

    They follow the clock unless `as_of` ('2024-01-15 10:30:00') fixes the moment.
    """
    now = f"TIMESTAMP_NTZ '{as_of}'" if as_of else "localtimestamp()"
    kind, prefix = ("TEMPORARY VIEW", "") if temporary else ("VIEW", f"{database}.")
    spark.sql(f"""
        CREATE OR REPLACE {kind} {prefix}vw_current_status AS
        SELECT sector_id, window_start, arrivals_count, avg_triage_acuity
        FROM {database}.gold_ops_metrics_hourly
        WHERE window_start >= {now} - INTERVAL 2 HOURS
          AND window_start <= {now}
          AND dt BETWEEN to_date({now} - INTERVAL 2 HOURS) AND to_date({now})""")
    spark.sql(f"""
        CREATE OR REPLACE {kind} {prefix}vw_forecast_next_24h AS
        SELECT sector_id, predicted_arrivals_h1, dt
        FROM {database}.gold_predictions
        WHERE dt = to_date({now})""")
