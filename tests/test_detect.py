"""Detectors against plain-Python replays, with one address that holds most rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logwarden.operators import detect as op
from logwarden.operators import risk

START = datetime(2024, 1, 1)
SCHEMA = (
    "id bigint, source_ip string, timestamp timestamp, destination_port int, protocol string, action string, raw_log string, "
    "parsed_data struct<status:string,suspicious_patterns:array<string>>"
)


@pytest.fixture(scope="module")
def attempts():
    random.seed(11)
    rows = []
    for i in range(1500):
        ip = "10.0.0.1" if random.random() < 0.6 else f"10.0.1.{random.randrange(5)}"
        # bursts, quiet stretches and times around block borders
        sec = random.choice([random.randrange(0, 400), random.randrange(3500, 3700), random.randrange(7100, 7300), random.randrange(0, 50000)])
        rows.append((i, ip, START + timedelta(seconds=sec), random.randrange(1, 9), "TCP", "drop", "x", ("", ["xss", "other"] if i % 3 else [])))
    return rows


@pytest.fixture(scope="module")
def logs(spark, attempts):
    return spark.createDataFrame(attempts, SCHEMA).cache()


def windows(attempts, window):
    by_ip = {}
    for r in attempts:
        by_ip.setdefault(r[1], []).append((r[2], r[3]))
    for ip, hits in by_ip.items():
        for end in sorted({t for t, _ in hits}):
            inside = [p for t, p in hits if end - timedelta(seconds=window) <= t <= end]
            yield ip, end, len(inside), len(set(inside))


@pytest.mark.parametrize("window", [1, 60, 450, 5000])
def test_sliding_brute_force(spark, logs, attempts, window):
    best = {}
    for ip, end, n, _ in windows(attempts, window):
        if n >= 3 and (ip not in best or n > best[ip][0]):
            best[ip] = (n, end)
    got = {r["source_ip"]: (r["details"]["attempt_count"], r["timestamp"]) for r in op.detect_brute_force_sliding(logs, window, 3).collect()}
    assert got == best


@pytest.mark.parametrize("window", [60, 450, 5000])
def test_sliding_port_scan(spark, logs, attempts, window):
    best = {}
    for ip, end, n, ports in windows(attempts, window):
        rank = (n * 3 + ports * 5, n, ports)
        if n >= 4 and ports >= 3 and (ip not in best or rank > best[ip][0]):
            best[ip] = (rank, end)
    got = {
        r["source_ip"]: (r["details"]["total_attempts"], r["details"]["unique_ports"], r["timestamp"])
        for r in op.detect_port_scan_sliding(logs, window, 4, 3).collect()
    }
    assert got == {ip: (rank[1], rank[2], end) for ip, (rank, end) in best.items()}


def test_sliding_peak_is_at_least_the_trailing_count(logs):
    peak = {r["source_ip"]: r["details"]["attempt_count"] for r in op.detect_brute_force_sliding(logs, 300, 1).collect()}
    for r in op.detect_brute_force(logs, window_s=300, threshold=1).collect():
        assert r["details"]["attempt_count"] <= peak[r["source_ip"]]
        assert sum(a["n"] for a in r["details"]["attempts"]) == r["details"]["attempt_count"]


def test_results_do_not_depend_on_partitioning(logs):
    def rows(df):
        return sorted(map(str, op.detect_suspicious_pattern(df, window_s=60000).collect()))

    assert rows(logs) == rows(logs.repartition(13, "id").orderBy(F.desc("raw_log")))


def test_chain_and_store_dedup(spark, attempts):
    threats = spark.createDataFrame([(r[0], r[1], "t", r[2]) for r in attempts], "id bigint, source_ip string, threat_type string, timestamp timestamp")
    kept, last = set(), {}
    for r in sorted(attempts, key=lambda r: (r[2], r[0])):
        if r[1] not in last or (r[2] - last[r[1]]).total_seconds() > 900:
            last[r[1]] = r[2]
            kept.add(r[0])
    assert {r["id"] for r in op.threat_dedup_chain(threats).collect()} == kept
    new, store = [r for r in attempts if r[0] % 2], [r for r in attempts if not r[0] % 2]
    want = {
        r[0] for r in new if not any(s[1] == r[1] and timedelta(0) <= r[2] - s[2] <= timedelta(seconds=900) for s in store)
    }
    got = op.threat_dedup_15m(threats.where("id % 2 = 1"), threats.where("id % 2 = 0"))
    assert {r["id"] for r in got.collect()} == want


def test_history_features_with_a_busy_address(spark):
    random.seed(2)
    rows = [
        (i, "10.0.0.1" if i % 3 else f"10.0.1.{i % 4}", random.choice(["a", "b", "c"]), START + timedelta(seconds=random.randrange(0, 45 * 86400)))
        for i in range(500)
    ]
    # exact borders of the three windows
    base = START + timedelta(days=60)
    for j, back in enumerate([0, 1, 86400, 86401, 8 * 86400 - 1, 8 * 86400, 30 * 86400, 30 * 86400 + 1]):
        rows.append((1000 + j, "10.9.9.9", f"t{j % 2}", base - timedelta(seconds=back)))
    df = spark.createDataFrame(rows, "id bigint, source_ip string, threat_type string, timestamp timestamp")
    got = {r["id"]: tuple(r[c] for c in risk.HISTORY) for r in risk.risk_history_features(df).collect()}
    for i, ip, kind, at in rows:
        back = [((at - t).total_seconds(), k) for _, p, k, t in rows if p == ip]
        recent = sum(1 <= s < 8 * 86400 for s, _ in back)
        old = sum(8 * 86400 <= s <= 30 * 86400 for s, _ in back)
        types = len({k for s, k in back if 1 <= s <= 30 * 86400})
        same = sum(1 <= s <= 86400 and k == kind for s, k in back)
        assert got[i] == (recent, old, types, same), i


def test_comprehensive_risk_values(spark):
    noon = datetime(2024, 1, 3, 12)
    rows = [("brute_force", 10.0, 7.2, "HIGH"), ("port_scan", 8.8, 5.3, "MEDIUM"), ("suspicious_pattern", 10.0, 9.0, "CRITICAL"),
            ("suspicious_pattern", 7.5, 6.8, "HIGH"), ("suspicious_pattern", 6.0, 5.4, "MEDIUM")]
    df = spark.createDataFrame([(i, k, "1.1.1.1", s, noon) for i, (k, s, _, _) in enumerate(rows)],
                               "id bigint, threat_type string, source_ip string, risk_score double, timestamp timestamp")
    got = {r["id"]: (r["risk_score"], r["risk_level"]) for r in risk.risk_comprehensive(df).collect()}
    assert got == {i: (score, level) for i, (_, _, score, level) in enumerate(rows)}


def test_own_column_names(spark, logs):
    mine = logs.withColumnsRenamed({"source_ip": "client", "timestamp": "at"})
    got = op.detect_brute_force(mine, window_s=300, threshold=1, cols={"source_ip": "client", "timestamp": "at"})
    assert {"client", "at"} <= set(got.columns)
    assert got.count() == op.detect_brute_force(logs, window_s=300, threshold=1).count()
