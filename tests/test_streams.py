"""Streams over several batches with late rows against plain replays; state that ends; the scoring sink."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import with_threat_id
from logwarden.operators import risk
from logwarden.streaming import jobs

START = datetime(2024, 3, 1, tzinfo=timezone.utc)


class Stream:
    """A folder of rows that arrive in batches, and a job that is stopped and started again for each."""

    def __init__(self, spark, root, schema):
        self.spark, self.root, self.schema, self.batches = spark, root, schema, 0

    def feed(self, rows, job, run):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        stream = job(self.spark.readStream.schema(self.schema).parquet(f"{self.root}/in"))
        run(stream).awaitTermination()
        self.batches += 1
        return stream

    def written(self, batches, job):
        for rows in batches:
            stream = self.feed(rows, job, lambda df: jobs.start(df, f"{self.root}/out", f"{self.root}/state", available_now=True))
        return self.spark.read.schema(stream.schema).parquet(f"{self.root}/out").collect()

    def state(self, name):
        return self.spark.read.format("statestore").option("stateVarName", name).load(f"{self.root}/state").collect()


def at(seconds):
    return START + timedelta(seconds=seconds)


LOG = "source_ip string, timestamp timestamp, parsed_data struct<suspicious_patterns: array<string>>"
SCHEMA = {"logs": LOG, "threats": "id bigint, source_ip string, threat_type string, risk_score double, description string, timestamp timestamp"}


def replayed(hits, window_s, least, cooldown_s):
    """Alerts of rows in the order of their time."""
    out = []
    by_ip = defaultdict(list)
    for ip, sec, tags in hits:
        by_ip[ip] += [(sec, t) for t in tags]
    for ip, rows in by_ip.items():
        last = None
        for sec in sorted({s for s, _ in rows}):
            inside = [t for s, t in rows if sec - window_s <= s <= sec]
            if len(inside) >= least and (last is None or sec - last >= cooldown_s):
                last = sec
                weighted = sum(rules.TAG_WEIGHTS.get(t, rules.OTHER_TAG_WEIGHT) for t in inside)
                out.append((ip, sec, len(inside), round(min(weighted, 10.0), 1)))
    return sorted(out)


def test_pattern_rule_in_event_time(spark, tmp_path):
    rng = random.Random(6)
    tags = [*list(rules.TAG_WEIGHTS)[:3], "other"]
    hits = sorted(((rng.choice(["a", "a", "a", "b", "c"]), rng.randrange(6000), rng.choices(tags, k=rng.randint(1, 2))) for _ in range(150)), key=lambda h: h[1])
    # a third of the rows comes up to 200 seconds late, in a later batch
    batches = [[], [], [], []]
    for i, hit in enumerate(hits):
        batches[min(3, (hit[1] + (200 if i % 3 == 0 else 0)) * 4 // 6000)].append(hit)
    assert any(h[1] < max(x[1] for x in batches[k - 1]) for k in (1, 2, 3) for h in batches[k])
    end = [[("", 20_000, [])], [("", 20_001, [])]]  # moves the watermark
    rows = [[(ip, at(sec), (t,)) for ip, sec, t in batch] for batch in [*batches, *end]]
    job = lambda logs: jobs.stream_suspicious_pattern(
        logs.withColumn("source_ip", F.col("source_ip")), "5 minutes", window_s=300, min_matches=3, cooldown_s=120)
    stream = Stream(spark, str(tmp_path), LOG)
    got = stream.written([[*rows[0], ("z", at(0), (["other"],))], *rows[1:4]], job)
    assert stream.state("waiting") and stream.state("hits")
    closing = [[("y", at(20_000), (["other"],))], [("y", at(20_001), (["other"],))]]
    got = stream.written(closing, job)
    mine = sorted((r["source_ip"], int((r["timestamp"].replace(tzinfo=timezone.utc) - START).total_seconds()), r["total_matches"], r["risk_score"]) for r in got)
    assert mine == replayed([*hits, ("z", 0, ["other"])], 300, 3, 120) and len(mine) > 10
    # what idle addresses had is gone: nothing but the rows that wait now is left
    assert {r["key"]["source_ip"] for r in stream.state("waiting")} == {"y"}
    assert stream.state("hits") == [] and stream.state("emitted") == [] and stream.state("latest") == []


def test_silence_in_event_time(spark, tmp_path):
    rng = random.Random(2)
    threats = [(i, rng.choice("ab"), rng.choice(["x", "y"]), 5.0, None, at(rng.randrange(4000))) for i in range(120)]
    order = sorted(threats, key=lambda t: t[5] + timedelta(seconds=100 * (t[0] % 2)))
    batches = [order[:40], order[40:80], order[80:], [(900, "q", "x", 1.0, None, at(9000))], [(901, "q", "x", 1.0, None, at(9001))]]
    job = lambda t: jobs.stream_threat_dedup(t, "3 minutes", gap_s=300)
    got = Stream(spark, str(tmp_path), SCHEMA["threats"]).written(batches, job)
    want, last = [], {}
    for t in sorted(threats, key=lambda t: (t[5], t[0])):
        key = t[1:3]
        if key not in last or (t[5] - last[key]).total_seconds() > 300:
            last[key] = t[5]
            want.append(t[0])
    assert sorted(r["id"] for r in got) == sorted(want)


def test_pairs_share_state(spark, tmp_path):
    """State grows with the groups, not with the pairs of address and type; ids beside missing ones stay whole."""
    rng = random.Random(8)
    big = 2**53 + 1
    ips = [*[f"10.0.0.{i}" for i in range(60)], None]
    threats = [(big + 2 * i if i % 50 else None, rng.choice(ips), rng.choice(["x", "y"]), float("nan") if i % 7 == 0 else 5.0, None, at(rng.randrange(4000))) for i in range(600)]
    order = sorted(threats, key=lambda t: t[5])
    batches = [order[:300], order[300:], [(1, "q", "x", 1.0, None, at(9000))], [(2, "q", "x", 1.0, None, at(9001))]]
    stream = Stream(spark, str(tmp_path), SCHEMA["threats"])
    job = lambda t: jobs.stream_threat_dedup(t, "3 minutes", gap_s=300, groups=8)
    stream.written(batches[:1], job)
    assert len({tuple(r["key"]) for r in stream.state("waiting")}) <= 8
    got = stream.written(batches[1:], job)
    want, last = [], {}
    for t in sorted(threats, key=lambda t: (t[5], t[0] is None, t[0])):
        key = t[1:3]
        if key not in last or (t[5] - last[key]).total_seconds() > 300:
            last[key] = t[5]
            want.append((t[0], *key, t[5]))
    assert sorted(((r["id"], r["source_ip"], r["threat_type"], r["timestamp"].replace(tzinfo=timezone.utc)) for r in got), key=str) == sorted(want, key=str)
    assert {r["risk_score"] for r in got} <= {5.0, None}
    # what is left is what waits and the group of q
    assert len({tuple(r["key"]) for r in stream.state("waiting")}) == 1 and stream.state("last") == [] and len(stream.state("latest")) <= 1


def test_a_batch_waits_as_one_entry(spark, tmp_path):
    """Each entry of the state costs a call, so an address has one for each batch, whatever its rows."""
    tags = ["other", "other", "sql_injection", None]
    hits = [("a", sec, tags[sec % 4]) for sec in range(0, 600, 7)]
    stream = Stream(spark, str(tmp_path), LOG)
    job = lambda logs: jobs.stream_suspicious_pattern(logs, "5 minutes", window_s=60, min_matches=3, cooldown_s=90)
    stream.written([[(ip, at(sec), ([tag],)) for ip, sec, tag in hits]], job)
    assert len(stream.state("waiting")) == 1
    got = stream.written([[("y", at(s), (["other"],))] for s in (9000, 9001)], job)
    mine = sorted((r["source_ip"], int((r["timestamp"].replace(tzinfo=timezone.utc) - START).total_seconds()), r["total_matches"], r["risk_score"]) for r in got)
    assert mine == replayed([(ip, sec, [tag]) for ip, sec, tag in hits if tag], 60, 3, 90) and mine


def test_windows_close_once_and_late_rows_are_listed(spark, tmp_path):
    schema = "id bigint, timestamp timestamp"
    batches = [[(1, at(10)), (2, at(30)), (3, at(400))], [(4, at(20)), (5, at(390)), (6, at(700))], [(7, at(290)), (8, at(580))], [(9, at(5000))], [(10, at(5001))]]
    got = Stream(spark, str(tmp_path / "w"), schema).written(batches, lambda rows: jobs.stream_rate_metric(rows, "2 minutes"))
    counts = {int((r["minute"].replace(tzinfo=timezone.utc) - START).total_seconds()): r["n"] for r in got}
    # 4 and 7 come after the watermarks 280 and 580; every window is there once
    assert counts == {0: 2, 360: 2, 660: 1, 540: 1} and len(got) == len(counts)
    late = Stream(spark, str(tmp_path / "l"), schema)
    for rows in batches:
        late.feed(rows, lambda rows: rows, lambda df: jobs.stream_late_rows(df, f"{late.root}/out", f"{late.root}/state", "2 minutes", available_now=True))
    assert sorted(r["id"] for r in spark.read.parquet(f"{late.root}/out/late").collect()) == [4, 7]
    marks = sorted(r["watermark"].replace(tzinfo=timezone.utc) for r in spark.read.parquet(f"{late.root}/out/watermark").collect())
    assert marks == [at(280), at(580), at(580), at(4880), at(4881)]


def test_sink_reads_its_own_history(spark, tmp_path):
    rng = random.Random(3)
    day = 86_400
    rows = [(i, rng.choice("aaab"), rng.choice(["brute_force", "port_scan"]), 4.0, None, at(rng.randrange(50 * day))) for i in range(200)]
    rows.sort(key=lambda r: r[5])
    batches = [rows[:80], rows[80:150], rows[150:]]
    frames = [spark.createDataFrame(b, SCHEMA["threats"]) for b in batches]
    write = jobs.threat_writer(str(tmp_path / "soc"))
    for number, frame in enumerate(frames):
        write(frame, number)
    write(frames[1], 1)  # a batch that is run again
    got = {r["id"]: r["risk_score"] for r in spark.read.parquet(str(tmp_path / "soc" / "threat")).collect()}
    assert sorted(got) == list(range(200))
    for number, frame in enumerate(frames):
        history = spark.createDataFrame([r for b in batches[:number] for r in b], SCHEMA["threats"]) if number else None
        want = {r["id"]: r["risk_score"] for r in risk.risk_comprehensive(frame, history).collect()}
        assert want == {i: got[i] for i in want}
    stored = spark.read.parquet(str(tmp_path / "soc" / "history"))
    assert stored.agg(F.sum("occurrences")).first()[0] == 200
    first, last = min(r[5] for r in rows[150:]) - timedelta(seconds=rules.HISTORY_LOOKBACK_S), max(r[5] for r in rows)
    read = jobs._history(spark, str(tmp_path / "soc"), 2, first.replace(tzinfo=None), last.replace(tzinfo=None))
    dates = {f.split("event_date=")[1].split("/")[0] for f in read.inputFiles()}
    assert min(dates) >= str(first.date()) and len(dates) < stored.select("event_date").distinct().count()


def test_detector_output_goes_to_the_sink(spark, tmp_path):
    logs = "source_ip string, timestamp timestamp, action string, raw_log string, parsed_data struct<status: string>"
    lines = [("10.0.0.1", at(i), "failed", "Failed password", ("200",)) for i in range(8)]
    job = lambda rows: jobs.stream_brute_force(rows, "1 minute", window_s=60, slide_s=60, threshold=5)
    stream = Stream(spark, str(tmp_path), logs)
    run = lambda df: jobs.stream_sink_threats(df, f"{tmp_path}/soc", f"{tmp_path}/state", available_now=True)
    for rows in (lines, [("", at(900), "", "", None)], [("", at(901), "", "", None)]):
        stream.feed(rows, job, run)
    threats = spark.read.parquet(f"{tmp_path}/soc/threat").collect()
    assert [(t["threat_type"], t["source_ip"], len(t["id"])) for t in threats] == [("brute_force", "10.0.0.1", 32)]
    assert spark.read.parquet(f"{tmp_path}/soc/incident").first()["threat_ids"] == [threats[0]["id"]]


def test_threat_ids_are_stable(spark):
    rows = spark.createDataFrame([("x", "a", at(1)), ("x", "a", at(2)), ("x", None, at(1)), (None, "x", None)], "threat_type string, source_ip string, timestamp timestamp")
    ids = [r["id"] for r in with_threat_id(rows).orderBy("timestamp", "source_ip", "threat_type").collect()]
    again = [r["id"] for r in with_threat_id(rows.repartition(4)).orderBy("timestamp", "source_ip", "threat_type").collect()]
    assert ids == again and len(set(ids)) == 4
    assert with_threat_id(rows.withColumn("id", F.lit(7))).first()["id"] == 7


def test_batch_job_over_a_folder(spark, tmp_path):
    from logwarden.plans import soc

    lines = [f'10.9.8.7 - - [05/Mar/2024:10:00:{i:02} +0000] "GET /login HTTP/1.1" 401 12 "-" "x"' for i in range(12)]
    lines += ['10.9.8.8 - - [05/Mar/2024:10:00:30 +0000] "GET /?q=1%27+UNION+SELECT+1 HTTP/1.1" 200 12 "-" "union select 1 from x"'] * 4
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "a.log").write_text("\n".join(lines) + "\n")
    (folder / "b.log").write_text("\n".join(lines[:5]) + "\n")  # repeats
    tables = soc.soc_batch_files(spark, str(folder), str(tmp_path / "one"), as_of="2024-12-31 00:00:00", thresholds={"brute_force": 1}, anomalies=False)
    assert tables["log_entry"].count() == len(set(lines))
    threats = {r["id"]: r for r in tables["threat"].collect()}
    assert {("brute_force", "10.9.8.7")} <= {(r["threat_type"], r["source_ip"]) for r in threats.values()}
    assert {r["threat_id"] for r in tables["alert"].collect()} <= set(threats)
    assert {i for r in tables["incident"].collect() for i in r["threat_ids"]} == {i for i, r in threats.items() if r["risk_score"] >= rules.INCIDENT_THRESHOLD}
    assert ("brute_force", "10.9.8.7") in {(r["pattern_type"], r["pattern_key"]) for r in tables["attack_pattern"].collect()}
    again = soc.soc_batch_files(spark, str(folder), str(tmp_path / "two"), as_of="2024-12-31 00:00:00", anomalies=False)
    assert {r["id"] for r in again["threat"].collect()} == set(threats)
