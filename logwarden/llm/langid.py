"""Language identification in two steps: the family, then one-versus-one linear support vector machines inside it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import bounded_batches
from logwarden.llm.linear import fit_linear
from logwarden.llm.shingles import CHUNK, U

UNKNOWN = "und"
#: Families of language codes; a code that is not listed is a family by itself.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
}
BUCKETS = 2048
#: Labelled rows on which the machines are fitted, about, for each language.
SAMPLE = 1000


def _letters(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode(), np.uint8)
    return np.where((data >= 0x80) | ((data >= 97) & (data <= 122)), data, 32)


def profile(text: str) -> np.ndarray | None:
    """Square roots of the shares of hashed byte triples of the lower-case letters; None without a letter.

    Everything that is not a letter of ASCII and not a longer character counts as a space.  Long texts are read whole,
    in chunks.
    """
    if not text or not any(c.isalpha() for c in text):
        return None
    counts = np.zeros(BUCKETS)
    for start in range(0, len(text), CHUNK):
        data = _letters(" " + text[start:start + CHUNK] + " ").astype(np.uint32)
        keep = np.ones(len(data), bool)
        keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
        data = data[keep]
        code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]).astype(U)
        counts += np.bincount(((code * U(0x9E3779B97F4A7C15)) >> U(53)).astype(np.int64), minlength=BUCKETS)
    return np.sqrt(counts / max(counts.sum(), 1.0)).astype(np.float32)


class Model:
    """``family`` holds one machine per family against the others; ``pairs`` one per two languages of a family."""

    def __init__(self, families: dict[str, str], family: dict, pairs: dict):
        self.families, self.family, self.pairs = families, family, pairs
        self.members: dict[str, list[str]] = {}
        for lang, name in sorted(families.items()):
            self.members.setdefault(name, []).append(lang)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        if not self.members:
            return UNKNOWN, 0.0
        names = sorted(self.members)
        margins = np.array([x @ w + b for w, b in (self.family[n] for n in names)]) if len(names) > 1 else np.zeros(1)
        share = np.exp(2 * (margins - margins.max()))
        best = int(margins.argmax())
        langs = self.members[names[best]]
        won = dict.fromkeys(langs, 0.0)
        for a, b in combinations(langs, 2):
            w, offset = self.pairs[a, b]
            p = float(1 / (1 + np.exp(-np.clip(2 * (x @ w + offset), -30, 30))))
            won[a] += p
            won[b] += 1 - p
        lang = max(langs, key=lambda name: (won[name], name))
        inside = won[lang] / (len(langs) - 1) if len(langs) > 1 else 1.0
        return lang, float(share[best] / share.sum() * inside)


def fit_languages(docs: DataFrame, usable: Column, text_col: str = "text", lang_col: str = "lang", families=None, sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` rows per language of those that are ``usable`` and have a language."""
    bounded_batches(docs.sparkSession)
    named = {lang: name for name, langs in (families or FAMILIES).items() for lang in langs}
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    limit = F.lit(0)
    for lang, n in sorted(counts.items()):
        limit = F.when(F.col("lang") == lang, F.lit(int(min(1.0, sample / n) * (1 << 30)))).otherwise(limit)
    chosen = rows.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < limit)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(lang, x.tobytes()) for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if (x := profile(text)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.binary())], ["lang", "x"])

    found = sorted(map(tuple, chosen.mapInArrow(describe, "lang string, x binary").collect()))  # `sample` rows of 8 KiB a language
    if not found:
        return Model({}, {}, {})
    langs = np.array([r[0] for r in found])
    x = np.stack([np.frombuffer(r[1], np.float32) for r in found])
    belongs = {lang: named.get(lang, lang) for lang in sorted(set(langs.tolist()))}
    family = np.array([belongs[lang] for lang in langs.tolist()])
    machine = lambda rows, y: fit_linear(x[rows], y[rows].astype(np.float32), hinge=True)
    every = np.ones(len(langs), bool)
    names = sorted(set(belongs.values()))
    first = {n: machine(every, np.where(family == n, 1, -1)) for n in names} if len(names) > 1 else {}
    pairs = {(a, b): machine((langs == a) | (langs == b), np.where(langs == a, 1, -1)) for a, b in combinations(sorted(belongs), 2) if belongs[a] == belongs[b]}
    return Model(belongs, first, pairs)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred and score (0 to 1).

    Only the text is looked at: first the family's machines, then a vote among the languages of the best family.  A
    null text or one without a letter is ``und`` with score 0, and so is every text when nothing could be learned.
    Repeated rows get equal results; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(UNKNOWN, 0.0) if (x := profile(text)) is None else model.predict(x) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.float64())], ["id", "lang_pred", "score"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(label, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
