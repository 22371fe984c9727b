"""The pipeline stage by stage against plain Python."""

import os
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logwarden.llm import bpe, q_tables, quality
from tests.llm.test_jaccard import brute
from tests.llm.test_tables import ROWS

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "mixing sources", "byte-level BPE"]


@needs_tables
def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r.doc_id for r in quality.score_quality(docs).where("kept").collect()}
    rows = [r for r in docs.collect() if r.doc_id in kept]
    best = {}
    for r in rows:
        body = "".join(c for c in r.text if c not in " \t\n\x0b\x0c\r")
        best.setdefault(body, []).append(r)
    rows = sorted((min(group, key=lambda r: (-len(r.text), r.doc_id)) for group in best.values()), key=lambda r: r.doc_id)
    groups = brute([(r.doc_id, r.text, r.source) for r in rows], 5, 80, 100)
    first = {doc for doc, _, component in groups if doc == component}
    rows = [r for r in rows if r.doc_id in first]
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    # the mix: whole documents at most twice, every source near its target
    times = Counter(r.doc_id for r in got)
    assert set(times) <= first and max(times.values()) <= 2
    size, source, total = {r.doc_id: len(r.text.split()) for r in rows}, {r.doc_id: r.source for r in rows}, defaultdict(int)
    for i, n in times.items():
        total[source[i]] += n * size[i]
    sizes = Counter()
    for r in rows:
        sizes[r.source] += size[r.doc_id]
    assert abs(sum(total.values()) - 1.5 * sum(sizes.values())) < 0.1 * sum(sizes.values())
    text = {r.doc_id: r.text for r in rows}
    ranks, pattern = q_tables.vocabulary()
    encoder = bpe.Encoder(bpe.read_ranks(ranks), pattern)
    assert all(bytes(r.ids) == encoder.encode(text[r.doc_id]) for r in got)
    tiktoken = pytest.importorskip("tiktoken")
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(ranks), special_tokens={})
    assert all(np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text[r.doc_id]) for r in got[:40])


def test_stages_take_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, None, s, None) for i, t, s in ROWS], COLUMNS)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs, empty = stage(spark, docs, SF_DIR), stage(spark, empty, SF_DIR)
        assert empty.count() == 0
        assert docs.columns == empty.columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)


def test_copies_with_one_id(spark):
    text = "It was the best of times, it was the worst of times, said the man in the street."
    docs = spark.createDataFrame([(1, text, None, "s", 1), (1, text, None, "s", 1), (2, text, None, "s", 1)], COLUMNS)
    assert corpus_pipeline.exact_stage(spark, docs, "").agg(F.collect_set("doc_id")).first()[0] == [1]
