import ipaddress
import random
import re
from datetime import datetime

from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import round_1
from logwarden.functions import parsing
from logwarden.operators import parsing as op
from logwarden.sources.logs import read_logs

ACCESS = '10.1.2.3 - - [05/Mar/2024:10:11:12 +0200] "GET /admin?q=select HTTP/1.1" 404 17'
FIREWALL = "Mar 05 10:11:12 fw kernel: [UFW BLOCK] IN=eth0 OUT= SRC=172.16.9.8 DST=10.0.0.1 PROTO=TCP SPT=4 DPT=443"
SSH = "Dec  1 23:59:59 host sshd[7]: Failed password for bob from 8.8.4.4 port 22 ssh2"
SYSLOG = "Jan 2 03:04:05 host app: link to 9.8.7.6 lost now"


def parsed(spark, lines, as_of="2024-03-06 00:00:00"):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "id int, raw_log string")
    return {r["id"]: r for r in op.parse_log_lines(df, as_of=as_of).collect()}


def test_formats_and_first_match_wins(spark):
    rows = parsed(spark, [ACCESS, FIREWALL, SSH, SYSLOG, "seen 1.2.3.4 only", "10.1.2 - - no quad", "   "])
    assert [rows[i]["log_type"] for i in range(5)] == ["apache_access", "firewall", "ssh_auth", "syslog", "unknown"]
    assert set(rows) == set(range(5))
    assert (rows[0]["ip"], rows[0]["method"], rows[0]["status"], rows[0]["size"]) == ("10.1.2.3", "GET", "404", "17")
    assert rows[0]["timestamp"] == datetime(2024, 3, 5, 8, 11, 12)
    assert (rows[1]["protocol"], rows[1]["port"], rows[1]["action"]) == ("TCP", "443", "drop")
    assert rows[2]["action"] == "Failed" and rows[2]["port"] is None
    assert rows[4]["ip"] == "1.2.3.4" and rows[4]["timestamp"] == datetime(2024, 3, 6)


def test_year_of_yearless_times(spark):
    rows = parsed(spark, [SSH, SYSLOG, FIREWALL])
    # December lies in the future of March, so it belongs to the year before
    assert [rows[i]["timestamp"].year for i in range(3)] == [2023, 2024, 2024]


def test_verdict_can_be_left_out(spark):
    df = spark.createDataFrame([(FIREWALL,)], "raw_log string")
    assert op.parse_log_lines(df, as_of="2024-03-06", verdict=False).first()["action"] is None


def test_tags_equal_the_regexes(spark):
    random.seed(3)
    bits = ["UNION", "select", "<Script", "../", "..\\", "%2e%2e%2f", ";", "|", "&", "`", "$(", "${", "Admin", "root", "plain", " ", "x=1", "/"]
    lines = ["".join(random.choices(bits, k=random.randint(0, 5))) for _ in range(400)]
    df = spark.createDataFrame([(line,) for line in lines], "raw_log string")
    for row in op.tag_suspicious_patterns(df).collect():
        want = [name for name, p in rules.SUSPICIOUS_TAGS if re.search(p, row["raw_log"])]
        assert row["suspicious_patterns"] == want, row["raw_log"]


def test_patterns_that_are_not_literals_stay_regexes(spark):
    assert parsing.literal_words(r"(a.c|b)") is None
    assert parsing.literal_words(r"(a\.c|b)") == (["a.c", "b"], True)
    df = spark.createDataFrame([("abc",), ("xyz",)], "raw_log string")
    rows = op.tag_suspicious_patterns(df, tags=[("t", r"a.c")]).collect()
    assert [r["suspicious_patterns"] for r in rows] == [["t"], []]


def test_private_addresses(spark):
    random.seed(5)
    edges = [n + d for b in rules.PRIVATE_BLOCKS for n in (int(ipaddress.ip_network(b)[0]), int(ipaddress.ip_network(b)[-1])) for d in (-1, 0, 1)]
    numbers = [n for n in edges if 0 <= n < 2**32] + [random.randrange(2**32) for _ in range(500)] + [3221225481, 3221225482]
    texts = [str(ipaddress.ip_address(n)) for n in numbers] + ["256.1.1.1", "1.2.3", "01.2.3.4", ""]

    def private(text):
        try:
            return ipaddress.ip_address(text).is_private
        except ValueError:
            return False

    df = spark.createDataFrame([(t,) for t in texts], "source_ip string")
    for row in op.classify_private_ip(df).collect():
        assert row["is_private_ip"] == private(row["source_ip"]), row


def test_rounding_is_pythons(spark):
    random.seed(1)
    values = [k / 20 for k in range(0, 201)] + [random.uniform(0, 10) for _ in range(300)] + [0.6 * 7.5 * 1.5, 2.675, 0.15, 0.25, 0.35]
    df = spark.createDataFrame([(float(x),) for x in values], "x double").withColumn("r", round_1(F.col("x")))
    for row in df.collect():
        assert row["r"] == round(row["x"], 1), row


def test_failed_and_scan_flags(spark):
    rows = parsed(spark, [ACCESS, FIREWALL, SSH, SYSLOG])
    df = spark.createDataFrame([(i, r["raw_log"]) for i, r in rows.items()], "id int, raw_log string")
    logs = op.normalize_log_entry(op.parse_log_lines(df, as_of="2024-03-06"))
    flags = {r["id"]: (r["is_failed_attempt"], r["is_port_scan_attempt"]) for r in op.flag_port_scan_attempt(op.flag_failed_attempt(logs)).collect()}
    assert flags == {0: (True, False), 1: (True, True), 2: (True, False), 3: (False, False)}


def test_line_numbers_over_several_splits(spark, tmp_path):
    for name, n in (("a.log", 3000), ("b.log", 10)):
        text = "".join("" if i % 7 else "\n" for i in range(0)) + "".join(f"line {i} of {name}\n" if i % 5 else "  \n" for i in range(1, n + 1))
        (tmp_path / name).write_bytes(text.encode() + b"bad \xff\xfe byte\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = read_logs(spark, str(tmp_path), line_numbers=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == 2400 + 8 + 2
    for r in rows:
        found = re.match(r"line (\d+) of (\S+)", r["raw_log"])
        if found:
            assert int(found[1]) == r["line_number"] and r["file_path"].endswith(found[2])
        else:
            assert r["raw_log"] == "bad  byte" and r["line_number"] in (3001, 11)
