"""The Jaccard join against all pairs, and components against a plain union-find."""

import itertools
import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from logwarden.llm import jaccard_join
from logwarden.llm.components import components
from logwarden.llm.jaccard_join import TILE_BYTES, _Join, jaccard_groups
from tests.llm.test_tables import docs_of

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(" " if c in SPACES else c for c in lowered).split(" ") if lowered else []


def sets_of(rows, k):
    out = []
    for _, text, _ in rows:
        w = [x for x in words_of(text) if x]
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute(rows, k, num, den):
    sets, up = sets_of(rows, k), list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and den * len(a & b) >= num * len(a | b):
            up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _, _) in enumerate(rows):
        r = root(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return sorted(((doc, len(sets[i]), least[root(i)]) for i, (doc, _, _) in enumerate(rows)), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.5:
            words[at] = f"new{rng.randrange(10**6)}"
        elif kind < 0.75 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, rng.choice(words))
    return words


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    line = [rng.choice(vocabulary) for _ in range(60)]  # a passage that many share
    rows, bases = [], [[rng.choice(vocabulary) for _ in range(rng.choice([4, 8, 12, 20, 60, 150, 400]))] for _ in range(25)]
    for i in range(n):
        base = bases[0] if rng.random() < 0.3 else rng.choice(bases)
        words = edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 5, 9])) if base else base
        if rng.random() < 0.3:
            words = line + words[:rng.choice([0, 5, 12])]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w.upper() if rng.random() < 0.02 else w for w in words), "s"))
    return rows


@pytest.mark.parametrize(("seed", "k", "num"), [(1, 4, 85), (2, 4, 85), (3, 5, 80), (4, 3, 60)])
def test_against_all_pairs(spark, seed, k, num):
    rows = corpus(seed)
    got = sorted(map(tuple, jaccard_groups(docs_of(spark, rows), k, (num, 100)).collect()), key=str)
    assert got == brute(rows, k, num, 100)


def test_odd_cases(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, " \n\t", "s"), (4, "one", "s"), (5, "ONE", "s"), (6, "one two three", "s"), (7, "one\ntwo three", "s"), (7, "one\ntwo three", "s"),
            (8, "a b c d", "s"), (None, "a b c d", "s"), (9, "É b c d", "s"), (10, "é b c d", "s"), (11, "x y " * 400_000, "s"), (12, "X Y " * 400_000, "s"),
            (13, "z" * 3_000_000 + " tail", "s"), (14, "z" * 3_000_000 + " tail", "s"), (15, "one\xa0two three", "s")]
    got = sorted(map(tuple, jaccard_groups(docs_of(spark, rows), 4, (85, 100)).collect()), key=str)
    assert got == brute(rows, 4, 85, 100)
    assert jaccard_groups(docs_of(spark, [])).count() == 0


def test_chain_of_links(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 600), (500, 700), (650, 700)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {i: 0 for i in range(201)} | {i: 500 for i in (500, 600, 650, 700)} | {1000 + i: 1000 for i in range(300)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_tiles_in_runs(spark, monkeypatch):
    """Tiles shuffled as sorted runs are the groups of equal tiles, and of tiles with the same nodes one is left open."""
    monkeypatch.setattr("logwarden.llm.jaccard_join.HELD_TILES", 50)
    docs = docs_of(spark, corpus(5)).selectExpr("doc_id", "xxhash64(doc_id) AS h", "text")
    join = _Join(docs, 4, 85, 100)
    tiles, names = defaultdict(set), (1 << 40) - 1
    for r in join.nodes.select("rid", "tiles").collect():
        for i in range(0, len(r.tiles), TILE_BYTES):
            tiles[int.from_bytes(r.tiles[i:i + TILE_BYTES], "little") & names].add(r.rid)
    members = join.members()
    want = {(t, i, min(s), max(s), len(s)) for t, s in tiles.items() if len(s) > 1 for i in s}
    assert set(map(tuple, members.collect())) == want and members.count() == len(want) > 0
    alone = spark.createDataFrame([], "node long, component long")
    held = defaultdict(set)
    for r in join.open_tiles(members, alone).collect():
        held[r.tile].add(r.rid)
    large = {frozenset(s) for s in tiles.values() if len(s) > 3}
    assert sorted(map(sorted, held.values())) == sorted(map(sorted, large))
    join.clear()


def test_no_job_for_each_partition(spark):
    """Small tables come to the driver in one job, and a star of links is seen to be one without another round."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.sparkContext.setJobGroup("jaccard-frequencies", "")
        jaccard_join.frequencies(docs_of(spark, corpus(6, 40)), 4)
        spark.sparkContext.setJobGroup("jaccard-star", "")
        assert components(spark.createDataFrame([(1, i) for i in range(2, 40)], "u long, v long")).count() == 39
    finally:
        spark.sparkContext.setJobGroup("rest", "")
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    jobs = {g: len(spark.sparkContext.statusTracker().getJobIdsForGroup(g)) for g in ("jaccard-frequencies", "jaccard-star")}
    assert jobs["jaccard-frequencies"] < 10 and jobs["jaccard-star"] < 20, jobs


def test_bounds_of_many_pairs(spark):
    """Signatures of any lengths bound the difference, and blocks give the pairs that single comparisons give."""
    rng = np.random.default_rng(3)
    whole = rng.integers(0, 2**63, 2000).astype(np.uint64)
    sets = [np.unique(rng.choice(whole[:size], int(size * share))) for size in (9, 40, 150, 600, 2000) for share in (0.7, 0.8, 0.9, 0.95, 1.0)]
    signed = [jaccard_join.signature(s) for s in sets]
    pairs = list(itertools.combinations(range(len(sets)), 2))
    least = jaccard_join.at_least_different([signed[i] for i, _ in pairs], [signed[j] for _, j in pairs])
    assert all(low <= len(np.setxor1d(sets[i], sets[j])) for low, (i, j) in zip(least, pairs, strict=True)) and least.max() > 100
    n = [len(s) for s in sets]
    run = pd.DataFrame({"unit": 1, "rid": range(len(sets)), "n": n, "part": range(len(sets)), "sketch": signed, "side": 0, "same": True})
    got = {tuple(p) for out in jaccard_join._blocks(85, 100)(iter([run])) for p in out.itertuples(index=False)}
    want = set()
    for low, (i, j) in zip(least, pairs, strict=True):
        shared = (n[i] + n[j] - low) // 2
        if 100 * min(n[i], n[j]) >= 85 * max(n[i], n[j]) and 100 * shared >= 85 * (n[i] + n[j] - shared):
            want.add((i, j))
    assert got == want and 0 < len(want) < len(pairs)
