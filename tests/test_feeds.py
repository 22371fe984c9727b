"""Feeds with several rows for an indicator, and flow files whose headers differ."""

import pytest

from logwarden import rules
from logwarden.operators import enrich
from logwarden.operators.enrich import intel_score
from logwarden.operators.mining import rules_pairwise
from logwarden.sources.flows import read_flows


def test_one_score_for_several_feed_rows(spark):
    asked = spark.createDataFrame([("1.2.3.4", "ip"), ("5.6.7.8", "ip")], "indicator string, indicator_type string")
    ioc = spark.createDataFrame([], "value string, ioc_type string")
    feed = spark.createDataFrame(
        [("1.2.3.4", 2, 10, 90, 5, "NL", "a", "x"), ("1.2.3.4", 7, 10, 20, 3, "DE", "b", "y"), ("1.2.3.4", None, None, None, None, None, None, None)],
        "indicator string, positives int, total int, abuse_confidence int, total_reports int, country string, isp string, usage_type string")
    got = {r.indicator: r for r in intel_score(asked, ioc, feed, require_match=False).collect()}
    assert len(got) == 2 and got["1.2.3.4"].overall_score == 90 and got["5.6.7.8"].overall_score == 0
    assert (got["1.2.3.4"].positives, got["1.2.3.4"].total_reports, got["1.2.3.4"].country) == (7, 8, "NL")


def test_all_pairs_with_support_count(spark):
    rows = [([f"i{k:02d}", f"j{k:02d}"],) for k in range(300)] * 2
    got = rules_pairwise(spark.createDataFrame(rows, "items array<string>"), min_support=0.003, min_confidence=0.5)
    assert got.count() == 300


def test_flow_files_in_another_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Flow Duration,Total Fwd Packets,Label\n1,2,BENIGN\n")
    (tmp_path / "b.csv").write_text("Total Fwd Packets,Flow Duration,Label\n2,1,BENIGN\n")
    with pytest.raises(Exception, match="CSV header"):
        read_flows(spark, str(tmp_path)).collect()


def test_smallest_block_among_many_in_one_network(spark):
    """Host blocks fill a quarter of a /16; other addresses of it fall back to wider blocks, and odd blocks match nothing."""
    hosts = [(f"45.33.{i // 256}.{i % 256}/32", f"host{i}") for i in range(16384)]
    wide = [("45.33.0.0/16", "net"), ("45.33.255.77/24", "part"), ("0.0.0.0/0", "world"), ("45.33.0.0/40", "odd"), ("45.33.0.0", "odd"), (None, "odd")]
    ranges = spark.createDataFrame([(c, "X", p, 0.0, 0.0, "XX") for c, p in hosts + wide],
                                   "cidr string, country string, city string, latitude double, longitude double, country_code string")
    asked = ["45.33.0.0", "45.33.63.255", "45.33.64.0", "45.33.255.1", "9.9.9.9", "not an address", None]
    got = enrich.geo_enrich(spark.createDataFrame([(a,) for a in asked], "source_ip string"), None, ranges)
    cities = {r["source_ip"]: r["city"] for r in got.collect()}
    assert [cities[a] for a in asked[:5]] == ["host0", "host16383", "net", "part", "world"]
    assert cities["not an address"] == cities[None] == rules.UNKNOWN_PLACE[1]


def test_many_patterns_with_one_start(spark):
    patterns = [f"www.site{i}.example" for i in range(5000)] + ["ww", "é", "WWW.Site7.EXAMPLE"]
    texts = [f"see http://www.site{i}.example/" for i in (0, 7, 77, 4999)] + ["www.nothing.example", "café", "", None]
    left = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    right = spark.createDataFrame([(p,) for p in patterns], "part string")
    got = sorted((r["id"], r["part"]) for r in enrich.contains_join(left, "text", right, "part", shard_chars=30_000).collect())
    assert got == sorted((i, p) for i, t in enumerate(texts) for p in patterns if t and p.lower() in t.lower())
