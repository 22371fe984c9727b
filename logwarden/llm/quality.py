"""Quality classifier: weak labels joined by expectation-maximisation, then a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import WORD, bounded_batches
from logwarden.llm.linear import fit_linear
from logwarden.llm.shingles import CHUNK, U, mix, word_arrays

BAD, GOOD, ABSTAIN = 0, 1, 2
#: Rows on which the linear scorer is fitted, about; they are spread evenly over all rows.
SAMPLE = 4000
#: Hash buckets of the scorer's features.
BUCKETS = 1024
#: Levels of repeated and of different words.
EXTRA = 10
#: Triples of looks at which a text's features count half.
DAMPING = 60

# what a byte looks like: letters small and capital, digits, space, ends of sentences, other marks, symbols one by one
_LOOK = np.full(256, 5, np.uint8)
_LOOK[97:123] = _LOOK[0x80:] = 0
_LOOK[65:91], _LOOK[48:58] = 1, 2
_LOOK[[32, *range(9, 14)]] = 3
_LOOK[list(b".?")] = 4
for _look, _marks in enumerate([b",;:'\"()-", b"!", b"|", b"#", b"$", b"%", b"&", b"*", b"<>/\\=", b"_~^@+"], 6):
    _LOOK[list(_marks)] = _look
LOOKS = 16
_SLOT = (mix(np.arange(LOOKS**3, dtype=U) + U(1)) % U(BUCKETS)).astype(np.int64)


def _banded(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


def votes_of(looks: np.ndarray, words: np.ndarray, text_bytes: int) -> list[int]:
    """The labellers: each sees a share of the text and says bad, good or nothing; several see the same fault.

    ``looks``: how often each look occurs; ``words``: the word hashes.
    """
    m, solid = len(words), max(text_bytes - int(looks[3]), 1)
    letters = int(looks[0] + looks[1])
    symbols = int(looks[7:15].sum())
    same = float((words[1:] == words[:-1]).mean()) if m > 1 else 0.0
    variety = len(np.unique(words)) / max(m, 1)
    length = solid / max(m, 1)
    share = (letters + int(looks[2])) / solid  # digits too: numbers are no fault
    capital = looks[1] / max(letters, 1)
    marks = symbols / max(m, 1)
    ends = (looks[4] + looks[7]) / max(m, 1)
    return [
        ABSTAIN if m < 8 else _banded(share < 0.85, share > 0.93),
        _banded(capital > 0.4, capital < 0.2 and letters > 0),
        _banded(marks > 0.3, marks < 0.05),
        ABSTAIN if m < 8 else _banded(same > 0.15, same < 0.05),
        ABSTAIN if m < 20 else _banded(variety < 0.2, variety > 0.35),
        ABSTAIN if m < 20 else _banded(ends > 0.5 or ends < 0.004, 0.02 < ends < 0.3),
        ABSTAIN if m < 8 else _banded(length > 14 or length < 2, 3 < length < 10),
    ]


def features_of(triples: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Shares of hashed triples of looks, then levels of repetition, and at the end how many triples there were."""
    x = np.zeros(BUCKETS + EXTRA + 1, np.float32)
    total = float(triples.sum())
    x[:BUCKETS] = np.bincount(_SLOT, weights=triples, minlength=BUCKETS) / max(total, 1.0)
    if len(words) > 7:
        x[BUCKETS + int(np.searchsorted([0.03, 0.08, 0.15, 0.3], (words[1:] == words[:-1]).mean()))] = 1
        x[BUCKETS + 5 + int(np.searchsorted([0.1, 0.2, 0.35, 0.6], len(np.unique(words)) / len(words)))] = 1
    x[-1] = total
    return x


class Scorer(NamedTuple):
    """A text's features count as far from the sample's ``mean`` as its length can support."""

    mean: np.ndarray
    weights: np.ndarray
    offset: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        total = x[..., -1:]
        return (x[..., :-1] - self.mean) * (total / (total + DAMPING))

    def score(self, triples: np.ndarray, words: np.ndarray) -> float:
        if not len(words):
            return 0.0
        margin = self.centred(features_of(triples, words)).astype(np.float64) @ self.weights + self.offset
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def described(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each text: counts of looks, counts of triples of looks, word hashes, bytes.  Long texts are read in chunks."""
    column = column.cast(pa.large_binary())
    at = 0
    for words, bounds in word_arrays(column):
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            value = column[at].as_buffer()
            at += 1
            data = np.frombuffer(value, np.uint8) if value is not None and value.size else np.zeros(0, np.uint8)
            looks, triples = np.zeros(LOOKS, np.int64), np.zeros(LOOKS**3, np.int64)
            for start in range(0, len(data), CHUNK):
                part = _LOOK[data[start:start + CHUNK + 2]].astype(np.int32)
                looks += np.bincount(part[:CHUNK], minlength=LOOKS)
                if len(part) > 2:
                    triples += np.bincount((part[:-2] * LOOKS + part[1:-1]) * LOOKS + part[2:], minlength=LOOKS**3)
            yield looks, triples, words[a:b], len(data)


def combine(patterns: list[tuple[str, int]], rounds: int = 100) -> dict[str, float]:
    """Probability that a text is good for every pattern of votes, by expectation-maximisation.

    ``patterns`` has the pattern ('0120…') and its number of texts.  The model: a text is good or bad, and each
    labeller says bad, good or nothing with probabilities of its own for either.  It starts from the texts on which
    nobody says bad and alternates between the probabilities and the labels.
    """
    if not patterns:
        return {}
    votes = np.array([[int(c) for c in p] for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    good = np.where((votes == BAD).any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        log_odds = np.log((n @ good + 1) / (n @ (1 - good) + 1)) + np.zeros(len(n))
        for j in range(votes.shape[1]):
            seen = np.array([[(n * (votes[:, j] == v) * p).sum() + 1 for v in (BAD, GOOD, ABSTAIN)] for p in (good, 1 - good)])
            seen /= seen.sum(axis=1, keepdims=True)
            log_odds += np.log(seen[0] / seen[1])[votes[:, j]]
        good = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return {p: float(g) for (p, _), g in zip(patterns, good, strict=True)}


def _voted(docs: DataFrame) -> DataFrame:
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ["".join(map(str, votes_of(looks, words, n))) if len(words) else None for looks, _, words, n in described(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["votes"])

    return docs.select("text").mapInArrow(vote, "votes string")


def fit_quality(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> tuple[dict[str, float], Scorer]:
    """(probabilities by vote pattern, scorer).  The patterns are counted over all texts with words."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text"))
    # at most 3^7 rows
    patterns = [(r["votes"], r["count"]) for r in _voted(texts).where("votes IS NOT NULL").groupBy("votes").count().orderBy("votes").collect()]
    posterior = combine(patterns)
    total = sum(n for _, n in patterns)
    chosen = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < int(min(1.0, sample / max(total, 1)) * (1 << 30))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [("".join(map(str, votes_of(looks, words, n))), features_of(triples, words).tobytes())
                    for looks, triples, words, n in described(batch.column(0)) if len(words)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["votes", "x"])

    rows = texts.where(chosen).mapInArrow(describe, "votes string, x binary").collect()  # about `sample` rows of 4 KiB
    rows.sort()
    if not rows:
        return posterior, Scorer(np.zeros(BUCKETS + EXTRA), np.zeros(BUCKETS + EXTRA), 0.0)
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows])
    y = np.array([posterior.get(r["votes"], 0.5) for r in rows], np.float32)
    scorer = Scorer(x[:, :-1].mean(axis=0), np.zeros(0), 0.0)
    return posterior, scorer._replace(**dict(zip(("weights", "offset"), fit_linear(scorer.centred(x), y, hinge=False), strict=True)))


def quality_score(text: Column, scorer: Scorer) -> Column:
    """The scorer as a column; 0 for texts without words."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([scorer.score(triples, words) for _, triples, words, _ in described(texts)], pa.float64())

    return score(text)


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """One row per document: id, votes, posterior, score and kept.

    Seven overlapping heuristics vote on every text.  How often each pattern of votes occurs in all documents is
    enough to estimate, by expectation-maximisation and without any label, how far each heuristic can be trusted; that
    gives every pattern a probability.  These train a logistic scorer on hashed triples of byte looks (small letter,
    capital, space, symbol ...), on a sample of about ``sample`` rows.  The score is the scorer's; ``kept`` is score
    >= ``threshold``.

    Null texts and texts without words are not kept and have score 0 and null votes and posterior.  Repeated rows are
    scored like any other; an empty table gives an empty result; other columns are not read.
    """
    posterior, scorer = fit_quality(docs, text_col, sample)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes, scores = [], []
            for looks, triples, words, n in described(batch.column(1)):
                votes.append("".join(map(str, votes_of(looks, words, n))) if len(words) else None)
                scores.append(scorer.score(triples, words))
            likely = [None if v is None else posterior.get(v, 0.5) for v in votes]
            kept = [v is not None and s >= threshold for s, v in zip(scores, votes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(votes, pa.string()), pa.array(likely, pa.float64()), pa.array(scores, pa.float64()), pa.array(kept, pa.bool_())],
                ["id", "votes", "posterior", "score", "kept"])

    kind = slim.schema["id"].dataType.simpleString()
    made = slim.mapInArrow(score, f"id {kind}, votes string, posterior double, score double, kept boolean")
    return made.withColumnRenamed("id", id_col)


def keep_quality(docs: DataFrame, text_col: str = "text", threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that :func:`score_quality` keeps, with all their columns."""
    _, scorer = fit_quality(docs, text_col, sample)
    scored = docs.withColumn("_quality", quality_score(F.col(text_col), scorer))
    has_words = F.coalesce(F.col(text_col).rlike(WORD), F.lit(False))
    return scored.where((F.col("_quality") >= threshold) & has_words).drop("_quality")
