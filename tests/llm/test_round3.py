"""Whitening, phrases and SentencePiece against dense algebra, plain counting and the installed tokenizer library."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.llm import phrases as ph
from logwarden.llm import q_pieces
from logwarden.llm import sentencepiece_bpe as sp_bpe
from logwarden.llm.phrases import phrases
from logwarden.llm.whitening import whiten

VECTORS = "vec_id long, embedding array<float>, x string, n string, component string, weight string, count string, id string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d", "e", "f") for i, v in rows], VECTORS)


def dense_whitening(rows, components, once=False):
    """deviation, |whitened| by component and explained of each usable row, all at once."""
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], dtype=np.int64)
    fit = np.unique(x, axis=0) if once else x
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    e, u = np.linalg.eigh(covariance)
    order = np.argsort(e)[::-1][:components]
    z = (x - sums / n) @ u[:, order] / np.sqrt(e[order])
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return [(i, n, int(deviation[k]), np.abs(z[k]), e[order] / e.sum()) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening(spark, weights):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 6)) * [3, 2, 1.5, 1, 0.5, 0.2]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    hot = rows[7][1]
    rows += [(1000 + i, hot) for i in range(200)] + [(5, rows[5][1]), (None, rows[6][1])]
    bad = [(9001, None), (9002, []), (9003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (9004, [float("nan")] * 6), (9005, [float("inf")] + [0.0] * 5),
           (9006, [1e30] + [0.0] * 5)]
    odd = [(9100, [1.0, 2.0])]
    got = whiten(vectors_of(spark, rows + bad + odd), components=4, weights=weights).collect()
    want = dense_whitening(rows, 4, weights == "one")
    assert len(got) == len(want) * 4 and {r.component for r in got} == {1, 2, 3, 4}
    key = lambda i, dev, k, z: (i is None, i or 0, dev, k, round(z, 6))
    mine = sorted(key(r.vec_id, int(r.deviation), r.component, abs(r.whitened)) for r in got)
    theirs = sorted(key(i, dev, k + 1, z[k]) for i, _, dev, z, _ in want for k in range(4))
    for a, b in zip(mine, theirs):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], abs=2e-6)
    explained = {r.component: r.explained for r in got}
    assert [explained[k + 1] for k in range(4)] == pytest.approx(list(want[0][4]), rel=1e-9)
    assert {r.n for r in got} == {want[0][1]} and got[0].identity_error < 1e-9
    # one sign for all rows
    signed = {(r.vec_id, r.component): r.whitened for r in got if r.vec_id is not None}
    other = {(r.vec_id, r.component): r.whitened for r in whiten(vectors_of(spark, rows[::-1]), components=4, weights=weights).collect() if r.vec_id is not None}
    assert all(signed[k] == pytest.approx(other[k], abs=1e-8) for k in signed)


def test_whitening_of_little(spark):
    assert whiten(vectors_of(spark, [])).count() == 0
    assert whiten(vectors_of(spark, [(1, None)])).count() == 0
    assert whiten(vectors_of(spark, [(1, [1.0, 2.0])] * 5)).count() == 0  # no variance
    line = whiten(vectors_of(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(10)])).collect()
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1)
    huge = whiten(vectors_of(spark, [(i, [float(1 << 40) * (i % 3), float(i)]) for i in range(9)])).collect()
    assert max(int(r.deviation) for r in huge) == sum((9 * x - s) ** 2 for x, s in (((1 << 47), 9 * (1 << 46)), (64 * 8, 64 * 36)))


def counted_phrases(docs, least, top):
    """The same by counting in plain Python."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, sizes = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for size in (1, 2, 3):
                f.update((lang, *words[i:i + size]) for i in range(len(words) - size + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    longer = Counter()
    for p, a in candidates.items():
        if len(p) == 4:
            for inner in ((p[0], p[1], p[2]), (p[0], p[2], p[3])):
                longer[inner] = max(longer[inner], a)
    rows = []
    for p, a in candidates.items():
        if 100 * longer[p] >= 50 * a and longer[p]:
            continue
        cuts = [(1_000_000 * a * a // (f[p[:1 + k]] * f[(p[0], *p[1 + k:])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        rows.append((p[0], " ".join(p[1:]), a, f[p[:1 + k]], f[(p[0], *p[1 + k:])], sizes[p[0]], score))
    rows.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    out, seen = [], Counter()
    for r in rows:
        seen[r[0]] += 1
        if seen[r[0]] <= top:
            out.append((r[0], seen[r[0]], *r[1:]))
    return out


PHRASE_DOCS = "lang string, text string, w1 string, n string, part string, score string"


def test_phrases(spark, monkeypatch):
    rng = random.Random(11)
    words = ["the", "of", "New", "york", "Ünï", "a\xa0b", "city", "\x1cx", "日本", "z"] + [f"w{i}" for i in range(40)]
    weights = [30, 20] + [6] * 8 + [1] * 40
    docs = []
    for i in range(400):
        text = "".join(rng.choices(words, weights)[0] + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "?!"]) for _ in range(rng.randint(0, 60)))
        docs.append((rng.choice(["en", "en", "de", None, "und"]), text))
    docs += [("en", None), ("en", ""), ("en", " . "), (None, "of of of of"), ("en", "the the the " * 3000), ("fr", "ab cd ef " * 9), ("fr", "gh ij. " * 10)]
    docs += docs[:20]
    frame = spark.createDataFrame([(a, b, "x", "y", "z", "s") for a, b in docs], PHRASE_DOCS)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for size, share, top in ((1 << 20, 2000, 60), (64, 20, 5000)):
        monkeypatch.setattr(ph, "SLICE", size)
        monkeypatch.setattr(ph, "COMMON_SHARE", share)
        got = sorted(tuple(r[c] for c in columns) for r in phrases(frame.repartition(3), 10, top).collect())
        assert got == sorted(counted_phrases(docs, 10, top))
    assert phrases(frame.limit(0)).count() == 0
    assert phrases(frame, 10, None).count() == len(counted_phrases(docs, 10, 10**9))


def test_phrase_scores_are_exact(spark):
    row = spark.createDataFrame([(10**15 - 1, 10**15, 10**15 + 7)], "a long, l long, r long").select(ph._score("a", "l", "r")).first()
    assert row[0] == 10**6 * (10**15 - 1) ** 2 // (10**15 * (10**15 + 7))


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(q_pieces.MODEL))


def odd_texts():
    rng = random.Random(4)
    some = ["", " ", "a", "  a  b ", "\n\t x", "▁▁x▁", "é́", "日本語", "\x00z", "<s> <0x41> </s>", "\U0001f600" * 3, "​", "�", "ａｂ"]
    some += [" " * k + s for k in (1, 2, 14, 15, 16, 17, 31, 32, 33, 34, 47, 48, 49, 65) for s in ("", "a", "日")]
    some += ["".join(rng.choice("ab etn oi ▁\nst") for _ in range(rng.randint(0, 90))) for _ in range(300)]
    some += ["".join(chr(rng.choice([rng.randint(32, 0x17f), rng.randint(0x300, 0xd7ff), rng.randint(0xe000, 0x10ffff)])) for _ in range(40)) for _ in range(200)]
    return [*some, "long" * 20_000, " " * 30_000, "word and " * 20_000, "".join(rng.choice("abcdefghij") for _ in range(5_000))]


def test_pieces_as_the_library(spark, library, monkeypatch):
    texts = odd_texts()
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(0, texts[20], "x", "y"), (None, "null id", "x", "y"), (77, None, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens string").repartition(3)
    for cached in (200_000, 50):
        monkeypatch.setattr(sp_bpe, "CACHED", cached)
        got = sp_bpe.piece_tokens(docs, q_pieces.model_file()).collect()
        want = sorted(str((i, library.encode(t or ""), library.decode(library.encode(t or "")))) for i, t, *_ in rows)
        assert sorted(str((r.doc_id, r.ids, r.decoded)) for r in got) == want
        assert all(r.n_tokens == len(r.ids) for r in got)
    assert sp_bpe.piece_tokens(docs.limit(0), q_pieces.model_file()).count() == 0


def test_pieces_decode_any_ids(library):
    model = sp_bpe.Model(q_pieces.model_file())
    rng = random.Random(8)
    lists = [[rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randint(0, 12))] for _ in range(2_000)]
    assert [model.decode(x) for x in lists] == [library.decode(x) for x in lists]


def test_pieces_of_every_character(library):
    encoder = sp_bpe.Encoder(q_pieces.model_file())
    texts = [f"x{chr(c)}y {chr(c)}" for c in [*range(1, 0x3000), *range(0xd000, 0xd800), *range(0xe000, 0x11000, 7), *range(0x11000, 0x110000, 997)]]
    assert [np.frombuffer(x, "<i4").tolist() for x in encoder.encode(texts)] == library.encode(texts)


def test_piece_digest(spark, library, tmp_path):
    texts = ["Hello there.", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in q_pieces.op13_sentencepiece(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))


def test_equal_products_go_to_the_smaller_ids():
    import pyarrow as pa

    from logwarden.llm.ann import _score

    rng = np.random.default_rng(1)
    rest = rng.normal(size=(401, 15))
    ids = rng.permutation(400).tolist()
    # one query and 400 different vectors whose product with it is 1, and a few above and below
    rows = [(0, 1000, [1.0] + [0.0] * 15)] + [(1, i, [1.0, *rest[k]]) for k, i in enumerate(ids)]
    rows += [(1, 500, [1.5, *rest[400]]), (1, 501, [0.999, *rest[400]])]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7] * len(rows)), pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])], ["unit", "kind", "id", "x"])
    found = pa.Table.from_batches(list(_score(21)(iter([batch])))).to_pylist()
    assert [r["v"] for r in found] == [500, *range(20)] and {r["q"] for r in found} == {1000}
