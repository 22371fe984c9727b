"""Registered queries: coverage and agreement with their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
from checks.compare import TESTDATA, compare, duck

SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()
# one or more of every kind; `python -m checks.compare` runs all of them
SAMPLE = [
    "parse_log_lines", "classify_private_ip", "log_search", "log_dedup_exact", "incident_apply_changes", "detect_brute_force", "detect_brute_force_sliding",
    "detect_port_scan_sliding", "detect_suspicious_pattern", "threat_log_link", "risk_comprehensive", "pattern_ddos", "pattern_members",
    "sequence_detect_by_ip", "alert_suppress", "geo_enrich", "intel_search", "threat_hunting", "attack_heatmap", "mitre_heatmap",
    "rules_association_all", "rules_flow_bins", "src_flow_csv", "stream_brute_force", "stream_suspicious_pattern", "stream_sink_threats",
]

needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES) and len(QUERIES) >= 132


@needs_tables
def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    # same rule and window as the registered query, whose SQL is checked below
    want = duck(SF_DIR).execute(ORACLE["detect_brute_force_sliding"]).fetchall()
    assert len(rows) == len(want) > 0
    assert [r["risk_score"] for r in rows] == sorted((r["risk_score"] for r in rows), reverse=True)


@needs_tables
@pytest.mark.parametrize("name", SAMPLE)
def test_agrees_with_sql(spark, name):
    ok, text = compare(spark, SF_DIR, name, QUERIES[name], ORACLE[name], duck(SF_DIR))
    assert ok, text


@needs_tables
def test_the_whole_union_holds_every_detector(spark):
    union = QUERIES["threat_union_all"](spark, SF_DIR).collect()
    rest = QUERIES["threat_union"](spark, SF_DIR).collect()
    anomalies = QUERIES["detect_anomalies"](spark, SF_DIR).collect()
    assert sorted(map(str, (r for r in union if r["threat_type"] != "anomaly"))) == sorted(map(str, rest))
    found = sorted((r["source_ip"], r["risk_score"]) for r in union if r["threat_type"] == "anomaly")
    assert found == sorted((r["source_ip"], r["risk_score"]) for r in anomalies) and found


@needs_tables
def test_firewall_verdict_query_calls_its_operator(spark, monkeypatch):
    from checks import q_parsing

    assert compare(spark, SF_DIR, "firewall_verdict", QUERIES["firewall_verdict"], ORACLE["firewall_verdict"], duck(SF_DIR))[0]
    monkeypatch.setattr(q_parsing.op, "firewall_verdict", lambda df: df)
    assert {r["action"] for r in QUERIES["firewall_verdict"](spark, SF_DIR).collect()} == {"none"}
