"""Line dedup and nearest neighbours against brute force."""

import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.llm import q_search
from logwarden.llm.ann import nearest
from logwarden.llm.line_dedup import dedup_lines, dedup_passages
from tests.llm.test_tables import docs_of

SPACES = " \t\n\x0b\x0c\r"
SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def brute_lines(rows, min_words):
    """{(id, text): deleted lines}: every run against every earlier one, in the order of ids."""
    docs, places = [], []
    for i, text, _ in sorted(set((i, t or "", None) for i, t, _ in rows), key=lambda r: r[0]):
        solid = [(n, x.strip(SPACES)) for n, x in enumerate(text.split("\n")) if x.strip(SPACES)]
        docs.append((i, text, solid))
    seen, out = set(), {}
    for d, (i, text, solid) in enumerate(docs):
        gone = set()
        for a in range(len(solid)):
            words = 0
            for b in range(a, len(solid)):
                words += len([w for w in "".join(" " if c in SPACES else c for c in solid[b][1]).split(" ") if w])
                run = tuple(x for _, x in solid[a:b + 1])
                if words >= min_words and run in places_before(seen, d, a):
                    gone |= {n for n, _ in solid[a:b + 1]}
            for b in range(a, len(solid)):
                seen.add(tuple(x for _, x in solid[a:b + 1]))
        out[i, text] = sorted(gone)
    return out


def places_before(seen, d, a):
    return seen  # runs are added start by start, so all of them start earlier


@pytest.mark.parametrize(("seed", "min_words"), [(1, 5), (2, 8), (3, 1), (4, 20)])
def test_lines_against_brute_force(spark, seed, min_words):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 1, 2, 3, 4, 9]))) for _ in range(12)]
    rows = []
    for i in range(60):
        body = [rng.choice(lines) if rng.random() < 0.8 else f"own {rng.random()}" for _ in range(rng.randrange(12))]
        if rng.random() < 0.3:
            body = body[:2] + lines[3:9] + body[2:]
        if rng.random() < 0.2:
            body.insert(rng.randrange(len(body) + 1), "  \r")
        rows.append((i, "\n".join(rng.choice(["", " "]) + x for x in body), "s"))
    rows += [(3, rows[3][1], "s"), (100, None, "s"), (101, "", "s"), (102, "\n\n \n", "s"), (103, rows[5][1], "s"), (104, "x y z\n" * 500, "s"), (105, "w " * 30_000 + "\n" + "w " * 30_000, "s")]
    want = brute_lines([r for r in rows if r[0] != 104], min_words)
    got = {(r.doc_id, r.deleted_lines is not None): r for r in dedup_lines(docs_of(spark, rows), min_words).collect()}
    texts = {i: t or "" for i, t, _ in rows}
    for (i, _), r in got.items():
        if i != 104:
            assert r.deleted_lines == want[i, texts[i]], i
        assert r.text == "\n".join(x for n, x in enumerate(texts[i].split("\n")) if n not in set(r.deleted_lines))
        assert r.n_lines == texts[i].count("\n") + 1
    assert dedup_lines(docs_of(spark, []), min_words).count() == 0


def test_every_row_comes_back(spark):
    rows = [(1, "a b c\nd e f", "s")] * 3 + [(None, "a b c\nd e f", "s"), (2, "zz\na b c\nd e f", "s")]
    got = Counter((r.doc_id, r.text) for r in dedup_lines(docs_of(spark, rows), 4).collect())
    assert got == {(None, "a b c\nd e f"): 1, (1, ""): 3, (2, "zz"): 1}


def brute_words(rows, min_words):
    """{id: deleted words}, of texts in the order of ids: each run of min_words words against every earlier one."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        words, gone = text.split(), set()
        for a in range(len(words) - min_words + 1):
            run = tuple(words[a:a + min_words])
            if run in seen:
                gone |= set(range(a, a + min_words))
            seen.add(run)
        out[i] = gone
    return out


@pytest.mark.parametrize(("seed", "min_words"), [(1, 5), (3, 1), (4, 50)])
def test_passages_against_brute_force(spark, seed, min_words):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(3 * min_words)]
    rows = []
    for i in range(60):
        words = [f"own{rng.random()}" for _ in range(rng.randrange(3 * min_words))]
        for _ in range(rng.randrange(3)):
            a, at = rng.randrange(2 * min_words), rng.randrange(len(words) + 1)
            words[at:at] = passage[a:a + rng.randrange(min_words, 2 * min_words)]
        rows.append((i, "".join(rng.choice([" ", " ", " ", "  ", "\n", "\n\n"]) + w for w in words) + rng.choice(["", " ", "\n"])))
    rows += [(90, rows[3][1]), (91, rows[3][1] + "\x00 \x01\n"), (92, ""), (93, " \n\n"), (94, "w " * 20_000)]
    want = brute_words(rows, min_words)
    texts = dict(rows)
    for r in dedup_passages(docs_of(spark, [(*r, "s") for r in rows]), min_words).collect():
        gone, text = want[r.doc_id], texts[r.doc_id]
        words, n, lines, cut = text.split(), 0, [], []
        assert r.deleted_words == len(gone), r.doc_id
        assert r.text.split() == [w for k, w in enumerate(words) if k not in gone]
        for k, line in enumerate(text.split("\n")):
            own = range(n, n + len(line.split()))
            n += len(own)
            if own and gone.issuperset(own):
                cut.append(k)
            else:
                lines.append([words[w] for w in own if w not in gone] if gone.intersection(own) else line)
        assert (r.n_lines, r.deleted_lines) == (text.count("\n") + 1, cut)
        assert [x if isinstance(w, str) else x.split() for x, w in zip(r.text.split("\n") if lines else [], lines, strict=True)] == lines
    assert dedup_passages(docs_of(spark, []), min_words).count() == 0


def test_a_passage_inside_a_line_goes(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(1, f"a b {shared} c d", "s"), (2, f"e f g {shared} h\ni", "s")]
    got = {r.doc_id: (r.deleted_lines, r.deleted_words, r.text) for r in dedup_passages(docs_of(spark, rows), 50).collect()}
    assert got == {1: ([], 0, rows[0][1]), 2: ([], 60, "e f g h\ni")}


def brute_nearest(rows, k):
    valid = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 16:
            valid[i] = np.array(v, np.float32).astype(float)
    ids = np.array(sorted(valid))
    x = np.stack([valid[i] for i in ids])
    out = {}
    for q in ids[ids % 20 == 0]:
        s = (x * valid[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def check_nearest(spark, rows, recall):
    df = spark.createDataFrame([(i, v, 1, "a") for i, v in rows], "vec_id long, embedding array<float>, score int, rank string")
    got = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r["rank"]))
    want = brute_nearest(rows, 20)
    assert set(got) == set(want)
    hits = total = 0
    for q, found in got.items():
        assert [r for _, _, r in found] == list(range(1, len(found) + 1))
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and q not in [i for i, _, _ in found]
        scores = dict(want[q])
        assert all(abs(scores[i] - s) < 1e-12 for i, s, _ in found if i in scores)
        hits += len({i for i, _, _ in found} & set(scores))
        total += len(scores)
    assert hits >= recall * total, hits / max(total, 1)


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_nearest_against_brute_force(spark, spread):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((8, 16))
    rows = [(i, ((centres[i % 8] + rng.standard_normal(16) * 0.3) * (1 + spread * rng.random())).astype(np.float32).tolist()) for i in range(3000)]
    hot = rows[7][1]
    rows += [(5000 + i, hot) for i in range(1200)]  # one vector of a third of all rows
    rows += [(40_000, None), (40_020, [0.0] * 16), (40_040, [float("nan")] * 16), (40_060, [None] * 16), (40_080, [1.0] * 3), (None, [1.0] * 16), (40_100, [float("inf")] * 16)]
    check_nearest(spark, rows, 0.9)


def test_few_vectors(spark):
    check_nearest(spark, [(0, [1.0] * 16), (1, [1.0] * 16), (20, [2.0] + [0.0] * 15)], 1.0)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(empty, F.col("vec_id") % 20 == 0).count() == 0


@needs_tables
def test_recall_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = {(r.query_id, r.vec_id) for r in q_search.op3_nearest(spark, SF_DIR).collect()}
    x, ids = np.array([v for _, v in rows], float), np.array([i for i, _ in rows])
    want = set()
    for q in ids[ids % 20 == 0].tolist():
        s = x @ x[ids == q][0]
        want |= {(q, int(ids[i])) for i in [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]}
    assert len(got & want) >= 0.9 * len(want)


def test_only_texts_that_may_repeat_are_hashed_twice(spark, monkeypatch):
    from logwarden.llm import line_dedup

    grams, seen = line_dedup._grams, []
    monkeypatch.setattr(line_dedup, "_grams", lambda texts, n: seen.append(texts.count()) or grams(texts, n))
    shared = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"own{i}x{k}" for k in range(70)), "s") for i in range(40)] + [(90, shared, "s"), (91, "one " + shared + " two", "s")]
    got = {r.doc_id: r.deleted_words for r in dedup_passages(docs_of(spark, rows), 50).collect()}
    assert got == {i: 60 * (i == 91) for i, _, _ in rows} and seen == [42, 2]


def test_only_places_near_a_repeat_are_dealt_out(spark, monkeypatch):
    """A shorter repeat costs nothing; one inside a text deals out its own places, not all of the text."""
    from logwarden.llm import line_dedup

    dealt, write = [], line_dedup.stored

    def counted(df, name):
        out = write(df, name)
        if name == "word-places":
            dealt.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "stored", counted)
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(400))
    short, long = (" ".join(f"{c}{k}" for k in range(n)) for c, n in (("s", 24), ("l", 60)))
    rows = [(1, f"{own(1)} {short} {own(2)} {short}", "s"), (2, f"{own(3)} {long} {own(4)} {long}", "s"), (3, f"{short} {own(5)}", "s")]
    got = {r.doc_id: r.deleted_words for r in dedup_passages(docs_of(spark, rows), 50).collect()}
    assert got == {1: 0, 2: 60, 3: 0} and len(dealt) == 1 and 22 <= dealt[0] < 200, dealt


def test_a_unit_that_occurs_once_rules_out_the_places_around_it(spark, monkeypatch):
    """48 equal words on both sides of a word that differs are no run of 50; of their 192 places only those at the ends are dealt out."""
    from logwarden.llm import line_dedup

    dealt, write = [], line_dedup.stored

    def counted(df, name):
        out = write(df, name)
        if name == "word-places":
            dealt.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "stored", counted)
    side = lambda c: " ".join(f"{c}{k}" for k in range(48))
    rows = [(i, f"{side('a')} own{i}x1 {side('b')}", "s") for i in range(4)]
    # white space is not compared, nor does it change the cuts; without cuts every place is looked at
    plain = [f"w{'q' * k}r" for k in range(70)]
    rows += [(10, " ".join(plain), "s"), (11, "\t" + "\r\n ".join(plain[5:60]) + "\x0b\x0c", "s")]
    got = {r.doc_id: r.deleted_words for r in dedup_passages(docs_of(spark, rows), 50).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 10: 0, 11: 55} and dealt == [4 * 4 + 21 + 6], dealt
