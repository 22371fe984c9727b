"""Live detection with Structured Streaming.

Streams use the batch column expressions; windows close once, when the watermark passes them.  Rules with a silent time
after each hit wait in a stateful processor until the watermark has passed a row, so that rows count in the order of
their time, not of their arrival.  Rows behind the watermark are dropped by Spark; :func:`stream_late_rows` lists them.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable, Iterator
from datetime import timedelta
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from logwarden import rules
from logwarden.common import operator, with_threat_id
from logwarden.functions import scoring
from logwarden.operators import alerts, correlate, iforest, risk
from logwarden.operators.detect import brute_force_text, port_scan_text
from logwarden.operators.flows import flow_standardize
from logwarden.operators.parsing import (
    ENTRY_FEATURES, entry_features, failed_attempt, normalize_log_entry, parse_log_lines, port_scan_attempt, strip,
)
from logwarden.sources.logs import decoded

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_log_source(
    spark: SparkSession, path: str, pattern: str = "*.log", max_files: int | None = None, include_existing: bool = True
) -> DataFrame:
    """(file_path, raw_log, ingested_at) of files that appear under ``path``.

    The file source sees whole new files, so producers roll files into the folder.  With
    ``include_existing`` False only files changed after the start are read.
    """
    reader = spark.readStream.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if not include_existing:
        from datetime import datetime, timezone

        reader = reader.option("modifiedAfter", datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
    return (
        reader.text(path)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            strip(decoded(F.col("value"))).alias("raw_log"),
            F.current_timestamp().alias("ingested_at"),
        )
        .where("raw_log <> ''")
    )


@operator
def stream_parse(lines: DataFrame, as_of=None) -> DataFrame:
    return normalize_log_entry(parse_log_lines(lines, as_of=as_of))


@operator
def stream_dedup(logs: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drop repeats of (source_ip, raw_log) within the watermark."""
    return logs.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["source_ip", "raw_log"])


def _windowed(logs: DataFrame, watermark: str, window: str, slide: str | None, *keys: str, where=None):
    """Rows grouped by window; all rows move the watermark, also those that ``where`` leaves out."""
    marked = logs.withWatermark("timestamp", watermark)
    # a condition without the time would be moved below the watermark, which then stood still while no row meets it
    marked = marked if where is None else marked.where(F.when(F.col("timestamp").isNotNull(), where))
    return marked.groupBy(F.window("timestamp", window, slide).alias("w"), *keys)


@operator
def stream_brute_force(
    logs: DataFrame, watermark: str = "2 minutes", window_s: int = rules.BRUTE_FORCE_WINDOW_S, slide_s: int = 10,
    threshold: int = rules.BRUTE_FORCE_THRESHOLD,
) -> DataFrame:
    """Threats per address and overlapping window."""
    n = F.col("n")
    grouped = _windowed(logs, watermark, f"{window_s} seconds", f"{slide_s} seconds", "source_ip", where=failed_attempt())
    return (
        grouped.agg(F.count("*").alias("n"))
        .where(n >= threshold)
        .select(
            F.lit("brute_force").alias("threat_type"), "source_ip", scoring.brute_force_score(n).alias("risk_score"),
            brute_force_text(n, window_s).alias("description"), F.col("w.start").alias("window_start"),
            F.col("w.end").alias("timestamp"), n.alias("attempt_count"),
        )
    )


@operator
def stream_port_scan(
    logs: DataFrame, watermark: str = "10 minutes", window_s: int = rules.PORT_SCAN_WINDOW_S, slide_s: int = 60,
    min_attempts: int = rules.PORT_SCAN_MIN_ATTEMPTS, min_ports: int = rules.PORT_SCAN_MIN_PORTS,
) -> DataFrame:
    """Ports are collected as a set per window and address, which the number of ports bounds."""
    attempt = port_scan_attempt() & (F.col("destination_port") != 0)
    n, ports = F.col("n"), F.col("ports")
    return (
        _windowed(logs, watermark, f"{window_s} seconds", f"{slide_s} seconds", "source_ip", where=attempt)
        .agg(F.count("*").alias("n"), F.collect_set("destination_port").alias("seen"))
        .withColumn("ports", F.size("seen"))
        .where((n >= min_attempts) & (ports >= min_ports))
        .select(
            F.lit("port_scan").alias("threat_type"), "source_ip", scoring.port_scan_score(n, ports).alias("risk_score"),
            port_scan_text(n, ports).alias("description"), F.col("w.start").alias("window_start"),
            F.col("w.end").alias("timestamp"), n.alias("total_attempts"), ports.cast("bigint").alias("unique_ports"),
        )
    )


@operator
def stream_ddos_minute(threats: DataFrame, watermark: str = "2 minutes", threshold: int = rules.DDOS_PER_MINUTE) -> DataFrame:
    low = F.lower("threat_type")
    hit = F.lit(False)
    for word in rules.DDOS_WORDS:
        hit = hit | low.contains(word)
    return (
        _windowed(threats, watermark, "1 minute", None, where=hit)
        .agg(F.count("*").alias("event_count"))
        .where(F.col("event_count") >= threshold)
        .select(F.lit("ddos").alias("pattern_type"), F.col("w.start").alias("minute"), "event_count",
                F.least(F.col("event_count") / 200, F.lit(rules.PATTERN_MAX_CONFIDENCE)).alias("confidence_score"))
    )


@operator
def stream_rate_metric(logs: DataFrame, watermark: str = "2 minutes") -> DataFrame:
    """Log lines per second, per minute."""
    return (
        _windowed(logs, watermark, "1 minute", None)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("minute"), "n", F.bround(F.col("n") / 60, 2).alias("logs_per_second"))
    )


@operator
def stream_anomaly_score(logs: DataFrame, forest: iforest.IsolationForest, scale: dict[str, tuple[float, float]]) -> DataFrame:
    """Score entries with a fitted forest; no state."""
    return iforest.predict(flow_standardize(entry_features(logs), scale), forest).drop(*ENTRY_FEATURES)


@operator
def stream_state_ttl(df: DataFrame, keep: str = "24 hours") -> DataFrame:
    """Bound the state of everything after it: rows and state older than ``keep`` behind the newest
    event are dropped."""
    return df.withWatermark("timestamp", keep)


# --- rules with a silent time ---------------------------------------------------------


#: Keys that a task remembers within a batch, at most.
SEEN = 100_000


class InOrder(StatefulProcessor):
    """Holds the rows of a key until the watermark has passed their second and releases them in the order of time.

    A second is complete when the watermark passes its end: rows of it that come later are dropped by Spark.  The state
    of a key ends ``keep_s`` after its last released row.  Each call of the state goes to the JVM and back, so what a key
    gets in a batch is one packed entry, and a key whose timers expire together is looked at once.
    """

    def __init__(self, columns: list[str], keep_s: int) -> None:
        self.columns, self.keep_s = columns, keep_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.latest = handle.getValueState("latest", "sec bigint")
        self.seen: set = set()  # keys whose timers of this batch have been worked off
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Declare further state."""

    def taken(self, rows: Iterator) -> list[tuple]:
        """What is to wait, as tuples that begin with the second."""
        raise NotImplementedError

    def release(self, key: Any, rows: list[tuple], complete: int) -> list[tuple]:
        """Results of rows that are complete, in the order of time; what comes later is at ``complete`` or after."""
        raise NotImplementedError

    def forget(self) -> None:
        """Clear further state."""

    def given(self, out: list[tuple]) -> Iterator:
        """Results as the operator wants them."""
        return map(Row(*self.columns), *zip(*out)) if out else iter(())

    def handleInputRows(self, key: Any, rows: Iterator, timerValues: Any) -> Iterator:
        new = self.taken(rows)
        if new:
            self.waiting.appendValue((pickle.dumps(new),))
            self.handle.registerTimer((min(r[0] for r in new) + 1) * 1000)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator:
        if (name := tuple(key)) in self.seen:
            return
        if len(self.seen) >= SEEN:  # looking at a key again changes nothing
            self.seen.clear()
        self.seen.add(name)
        complete = timerValues.getCurrentWatermarkInMs() // 1000  # seconds before this one
        waiting = [r for (packed,) in self.waiting.get() for r in pickle.loads(packed)]
        due = sorted((r for r in waiting if r[0] < complete), key=lambda r: tuple((x is None, x) for x in r))
        rest = [r for r in waiting if r[0] >= complete]
        out = self.release(key, due, complete) if due else []
        if rest:
            if due:
                self.waiting.put([(pickle.dumps(rest),)])
                self.latest.update((due[-1][0],))
            self.handle.registerTimer((min(r[0] for r in rest) + 1) * 1000)
        else:
            if waiting:
                self.waiting.clear()
            latest = (due[-1][0],) if due else self.latest.get()
            if latest is not None:
                ends = int(latest[0]) + self.keep_s + 1
                if ends <= complete:
                    self.latest.clear()
                    self.forget()
                elif due:
                    self.latest.update(latest)
                    self.handle.registerTimer(ends * 1000)
        yield from self.given(out)

    def close(self) -> None:
        pass


class PatternProcessor(InOrder):
    """Tags of the last ``window_s`` seconds of one address, counted per (second, tag); emits at
    ``min_matches`` and then stays silent for ``cooldown_s``."""

    def __init__(self, window_s: int, min_matches: int, cooldown_s: int) -> None:
        super().__init__(["source_ip", "sec", "total_matches", "risk_score"], max(window_s, cooldown_s))
        self.window_s, self.min_matches, self.cooldown_s = window_s, min_matches, cooldown_s

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.hits = handle.getValueState("hits", "rows binary")
        self.emitted = handle.getValueState("emitted", "sec bigint")

    def taken(self, rows: Iterator[Row]) -> list[tuple]:
        counts: Counter = Counter()
        for r in rows:
            if r["tag"] is not None:
                counts[r["sec"], r["tag"]] += r["n"]
        return [(sec, tag, n) for (sec, tag), n in counts.items()]

    def release(self, key: Any, rows: list[tuple], complete: int) -> list[tuple]:
        packed, before = self.hits.get(), self.emitted.get()
        known = pickle.loads(packed[0]) if packed else []
        last = before = int(before[0]) if before else None
        out = []
        for i, (sec, tag, n) in enumerate(rows):
            known.append((sec, tag, n))
            if i + 1 < len(rows) and rows[i + 1][0] == sec:
                continue
            known = [h for h in known if h[0] >= sec - self.window_s]
            total = sum(n for _, _, n in known)
            if total >= self.min_matches and (last is None or sec - last >= self.cooldown_s):
                last = sec
                weighted = sum(n * rules.TAG_WEIGHTS.get(t, rules.OTHER_TAG_WEIGHT) for _, t, n in known)
                out.append((key[0], sec, total, round(min(weighted, 10.0), 1)))
        self.hits.update((pickle.dumps(known),))
        if last != before:
            self.emitted.update((last,))
        return out

    def forget(self) -> None:
        self.hits.clear()
        self.emitted.clear()


def _use_rocksdb(df: DataFrame) -> None:
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


@operator
def stream_suspicious_pattern(
    logs: DataFrame, watermark: str = "5 minutes", window_s: int = rules.PATTERN_WINDOW_S, min_matches: int = rules.PATTERN_MIN_MATCHES,
    cooldown_s: int = rules.PATTERN_COOLDOWN_S,
) -> DataFrame:
    """Tag threats per address with a silent time after each.

    State is one count per (second, tag) of the window; it goes when its window and silence are over.
    """
    _use_rocksdb(logs)
    # as in _windowed, rows without tags are to move the watermark as well
    tags = F.when(F.col("timestamp").isNotNull() & (F.col("source_ip") != ""), F.col("parsed_data.suspicious_patterns"))
    hits = logs.withWatermark("timestamp", watermark).select(
        "source_ip", "timestamp", F.unix_seconds("timestamp").alias("sec"), F.explode(tags).alias("tag"), F.lit(1).cast("bigint").alias("n"))
    found = hits.groupBy("source_ip").transformWithState(
        PatternProcessor(window_s, min_matches, cooldown_s),
        outputStructType="source_ip string, sec bigint, total_matches bigint, risk_score double",
        outputMode="Append",
        timeMode="EventTime",
    )
    return found.select(
        F.lit("suspicious_pattern").alias("threat_type"), "source_ip", "risk_score", F.timestamp_seconds("sec").alias("timestamp"),
        "total_matches",
    )


#: A group of (ip, type) pairs shares its state, as a call for each pair costs more than the pair's rows.
GROUPS = 1024


class SilenceProcessor(InOrder):
    """Lets one threat per (ip, type) pass and drops those up to ``gap_s`` after it; a key holds many such pairs.

    Keys have many rows here, so rows come and go as frames.  Whole numbers of the id come as text, which a frame keeps
    as it is beside missing ones.
    """

    def __init__(self, gap_s: int, columns: list[str], whole_ids: bool) -> None:
        super().__init__(columns, gap_s)
        self.gap_s, self.whole_ids = gap_s, whole_ids
        self.pair = [columns.index(c) for c in ("source_ip", "threat_type")]

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "rows binary")

    def taken(self, rows: Iterator[pd.DataFrame]) -> list[tuple]:
        out = []
        for part in rows:
            values = {c: [None if x is None or x != x else x for x in part[c].tolist()] for c in self.columns}
            if self.whole_ids:
                values["id"] = [None if x is None else int(x) for x in values["id"]]
            out += zip(*values.values())
        return out

    def given(self, out: list[tuple]) -> Iterator[pd.DataFrame]:
        if out:
            frame = pd.DataFrame(out, columns=self.columns, dtype=object)
            if self.whole_ids:
                frame["id"] = frame["id"].map(str, na_action="ignore")
            yield frame

    def release(self, key: Any, rows: list[tuple], complete: int) -> list[tuple]:
        packed = self.last.get()
        last = pickle.loads(packed[0]) if packed else {}
        ip, kind = self.pair
        kept = []
        for row in rows:
            before = last.get((row[ip], row[kind]))
            if before is None or row[0] - before > self.gap_s:
                last[row[ip], row[kind]] = row[0]
                kept.append(row)
        # a pair whose silence is over is as one that was never seen
        last = {pair: sec for pair, sec in last.items() if sec + self.gap_s >= complete}
        if last:
            self.last.update((pickle.dumps(last),))
        elif packed:
            self.last.clear()
        return kept

    def forget(self) -> None:
        self.last.clear()


@operator
def stream_threat_dedup(
    threats: DataFrame, watermark: str = "5 minutes", gap_s: int = rules.THREAT_DEDUP_S, groups: int = GROUPS,
) -> DataFrame:
    """One threat per (ip, type), then silence for ``gap_s``; of one second the smallest id comes first.

    State is kept for ``groups`` groups of pairs; the number must stay as it is over the life of a checkpoint.
    """
    _use_rocksdb(threats)
    columns = ["sec", "id", "source_ip", "threat_type", "risk_score", "description"]
    id_type = threats.schema["id"].dataType
    whole = isinstance(id_type, T.IntegralType)
    rows = threats.withWatermark("timestamp", watermark).select(
        F.unix_seconds("timestamp").alias("sec"), F.col("id").cast("string" if whole else id_type).alias("id"), "source_ip", "threat_type", F.col("risk_score").cast("double").alias("risk_score"), "description", "timestamp")
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    kept = rows.withColumn("pairs", F.pmod(F.xxhash64("source_ip", "threat_type"), F.lit(groups))).groupBy("pairs").transformWithStateInPandas(
        SilenceProcessor(gap_s, columns, whole), outputStructType=schema, outputMode="Append", timeMode="EventTime")
    return kept.select(F.col("id").cast(id_type).alias("id"), "source_ip", "threat_type", "risk_score", "description", F.timestamp_seconds("sec").alias("timestamp"))


# --- late rows ------------------------------------------------------------------------


def late_writer(path: str, watermark: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: writes the rows behind the watermark and the watermark after each batch.

    As in Spark's own rule, the watermark of a batch comes from the batches before it: their newest time less the
    delay.  ``path/watermark`` has one row a batch, ``path/late`` the rows; a batch that is run again overwrites its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = spark.createDataFrame([], "watermark timestamp, batch_id int")
        if batch_id > 0:
            # the batch before has taken the largest of all before it
            marks = spark.read.schema("watermark timestamp").parquet(f"{path}/watermark/batch_id={batch_id - 1}")
        before = marks.agg(F.max("watermark")).first()[0]
        late = batch.where(F.lit(False)) if before is None else batch.where(F.col("timestamp") < F.lit(before))
        late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        newest = batch.agg((F.max("timestamp") - F.expr(f"INTERVAL {watermark}")).alias("watermark"))
        newest.select(F.greatest("watermark", F.lit(before).cast("timestamp")).alias("watermark")).write.mode("overwrite").parquet(
            f"{path}/watermark/batch_id={batch_id}")

    return write


def stream_late_rows(
    rows: DataFrame, path: str, checkpoint: str, watermark: str = "2 minutes", available_now: bool = False, interval: str = "15 seconds"
) -> StreamingQuery:
    """List the rows that come too late for a job with this watermark on the same source, and the watermark by batch.

    The job reads the source once more, without state, so that late rows are neither lost nor counted twice.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return rows.writeStream.foreachBatch(late_writer(path, watermark)).option("checkpointLocation", checkpoint).trigger(**trigger).start()


# --- writing --------------------------------------------------------------------------


def start(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append", available_now: bool = False, interval: str = "15 seconds"
) -> StreamingQuery:
    """Write a stream as parquet; in ``append`` mode each window and each threat is written once, when it is complete."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger).format("parquet").start(path)


def threat_writer(path: str, rank: Callable[[DataFrame], DataFrame] | None = None, id_column: str = "id") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: scores a batch of threats against the stored history and writes
    threats, alerts and incidents of the batch.

    Threats of a detector get the id that follows from their type, address and time.  History is what earlier batches
    stored: occurrences by address, type and second under ``path/history``, by date, of which a batch reads the dates
    that its look-back touches and no others.  Each batch owns its folders and overwrites them, so a batch that is run
    again leaves no duplicates; its input is evaluated once, which state before it demands.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def kept(rows: DataFrame, name: str) -> DataFrame:
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
            return spark.read.schema(rows.schema).parquet(f"{path}/{name}/batch_id={batch_id}")

        if "description" not in batch.columns:
            batch = batch.withColumn("description", F.lit(None).cast("string"))
        rows = kept(with_threat_id(batch.drop("batch_id"), id_column), "arrived")
        first, last = rows.agg(F.min("timestamp") - F.expr(f"INTERVAL {rules.HISTORY_LOOKBACK_S} SECOND"), F.max("timestamp")).first()
        scored = risk.risk_comprehensive(rows, _history(spark, path, batch_id, first, last))
        scored = rank(scored) if rank else scored
        # later tables read the written threats back, so a batch is scored once
        done = kept(scored, "threat")
        alert = alerts.alert_candidates(done).select(
            F.col(id_column).alias("threat_id"), F.lit("message").alias("alert_type"), "description",
            F.lit(None).cast("string").alias("sent"), F.col("timestamp").alias("created_at"))
        kept(alert, "alert")
        kept(correlate.incident_create(done), "incident")
        counts = rows.groupBy("source_ip", "threat_type", F.date_trunc("second", "timestamp").alias("timestamp")).agg(F.count("*").alias("occurrences"))
        counts.withColumns({"event_date": F.to_date("timestamp"), "batch_id": F.lit(batch_id)}).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").parquet(f"{path}/history")

    return write


HISTORY = "source_ip string, threat_type string, timestamp timestamp, occurrences bigint, event_date date, batch_id int"


def _history(spark: SparkSession, path: str, batch_id: int, first, last) -> DataFrame | None:
    """Occurrences from ``first`` to ``last`` that earlier batches stored; only the folders of these dates are listed."""
    if first is None:
        return None
    dates = ",".join(str((first + timedelta(days=i)).date()) for i in range((last.date() - first.date()).days + 1))
    reader = spark.read.schema(HISTORY).option("basePath", f"{path}/history")
    try:
        found = reader.parquet(f"{path}/history/event_date={{{dates}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.where((F.col("batch_id") < batch_id) & (F.col("timestamp") >= F.lit(first)))


def stream_sink_threats(threats: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str = "15 seconds") -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        threats.writeStream.foreachBatch(threat_writer(path)).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
