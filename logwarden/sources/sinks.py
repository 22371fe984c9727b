"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.operators.enrich import ioc_summary

THREAT_CSV = {
    "id": "ID", "threat_type": "Threat Type", "source_ip": "Source IP", "risk_score": "Risk Score",
    "description": "Description", "timestamp": "Timestamp", "status": "Status",
}
# event time column per stored table
TABLE_TIME = {
    "log_entry": "timestamp", "threat": "timestamp", "alert": "created_at", "incident": "created_at", "attack_pattern": "start_time",
}


def sink_threat_csv(threats: DataFrame, path: str, mode: str = "append") -> None:
    """All threats as CSV with seven named columns."""
    columns = [F.col(c).alias(name) for c, name in THREAT_CSV.items()]
    threats.select(*columns).write.mode(mode).csv(path, header=True, timestampFormat="yyyy-MM-dd'T'HH:mm:ss")


def sink_intel_export(history: DataFrame, ioc: DataFrame, path: str, format: str = "json", mode: str = "append", last: int = 50) -> None:
    """Threat intelligence as ``json``, ``csv`` or ``xml`` under ``path``, a folder for each part:

    the latest searches, the indicator counts, the indicator table itself, and the totals with the time of the export.
    """
    searches = history.orderBy(F.desc("timestamp"), "indicator").limit(last)
    database = ioc.select("ioc_type", "value", *[c for c in ("id", "threat_level", "source", "is_active", "created_at") if c in ioc.columns])
    totals = history.agg(F.count("*").alias("total_searches")).crossJoin(ioc.agg(F.count("*").alias("total_iocs")))  # one row by one row
    totals = totals.withColumn("export_timestamp", F.current_timestamp())
    for name, rows in (("search_history", searches), ("ioc_summary", ioc_summary(ioc)), ("ioc_database", database), ("system_info", totals)):
        writer = rows.write.mode(mode).format(format)
        if format == "csv":
            writer = writer.option("header", True)
        if format == "xml":
            writer = writer.option("rootTag", "threat_intelligence_export").option("rowTag", name)
        writer.save(f"{path}/{name}")


def sink_soc_tables(path: str, mode: str = "append", partitioned: bool = True, **tables: DataFrame) -> None:
    """Append tables (log_entry, threat, alert, incident, attack_pattern) as parquet by event date.

    Rows are spread over (date, hash) before writing: one file set per date without collecting a
    busy date in one task.
    """
    for name, rows in tables.items():
        time = TABLE_TIME[name]
        dated = rows.withColumn("event_date", F.to_date(time))
        if partitioned:
            # rebalancing lets adaptive execution split large dates and join small ones
            dated.hint("rebalance", "event_date").write.mode(mode).partitionBy("event_date").parquet(f"{path}/{name}")
        else:
            dated.write.mode(mode).parquet(f"{path}/{name}")
