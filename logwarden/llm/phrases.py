"""Phrase collocations by stripes: what follows each word, counted in one structure per word."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from logwarden.llm.common import BITMAP_BITS, bounded_batches, key_bitmap, stored

#: A-Z to lower case, what ends a piece to a line feed, tabs to spaces (fixed characters).
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")
#: Stands between pieces; no UTF-8 text has this byte.
_BREAK = b"\xff"

#: Words counted together in one task at a time.
SLICE = 1 << 20
#: A word is common if it makes up at least this share of all words, so that at most 2,000 words are.
COMMON_SHARE = 2_000
#: What follows a common word is dealt out to so many stripes.
PARTS = 64

#: Pairs of words are counted by a hash of so many bits, dealt out by the upper 12 of them.
HASH_BITS, DEALT_BITS = 40, 12
#: Pairs that may be frequent enough are marked in a bitmap of 16 bits each, of at most 4,096 pieces of 4 KiB.  Beyond some
#: ten million such pairs it lets more of the others through, which costs exchange and changes no result.
PAIR_BITS, MOST_PIECES = 16, 4_096

CELLS = "lang string, w1 string, part int, w2 array<string>, w3 array<string>, n array<long>"


def words_of(text: str) -> list[bytes]:
    """The words of a text with a break after every piece."""
    coded = text.encode("utf-8", "replace").translate(_TABLE)
    # a break is a word to split(), which takes any run of spaces for one
    return [*coded.replace(b"\n", b" " + _BREAK + b" ").split(), _BREAK]


def _runs(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[tuple[str, list[bytes], int]]:
    """(lang, words, of which so many start a phrase) with at most SLICE starts; the rest follows the last start."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            words = held.setdefault(lang, [])
            before = len(words)
            words += words_of(text)
            size += len(words) - before
            if size < SLICE:
                continue
            for key, words in held.items():
                for start in range(0, len(words), SLICE):
                    part = words[start:start + SLICE + overlap]
                    yield key, part, min(SLICE, len(words) - start)
            held, size = {}, 0
    for key, words in held.items():
        for start in range(0, len(words), SLICE):
            yield key, words[start:start + SLICE + overlap], min(SLICE, len(words) - start)


def _codes(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Distinct words, of which the first is the break, and the number of each word in them."""
    places = {_BREAK: 0}
    codes = np.fromiter((places.setdefault(w, len(places)) for w in words), dtype=np.int64, count=len(words))
    return list(places), codes


def _strings(words: list[bytes]) -> pa.Array:
    return pa.array([None, *words[1:]], pa.binary()).cast(pa.string())


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of each slice of the words."""
    for lang, words, _ in _runs(batches, 0):
        names, codes = _codes(words)
        counts = np.bincount(codes, minlength=len(names))[1:]
        strings = _strings(names).slice(1)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(strings), pa.string()), strings, pa.array(counts, pa.int64())], ["lang", "word", "n"])


def _pair_hashes(lang: str, names: list[bytes], codes: np.ndarray) -> np.ndarray:
    """A hash of each word and the next one."""
    prefix = lang.encode() + _BREAK
    hashes = np.array([xxhash.xxh3_64_intdigest(prefix + n) for n in names], dtype=np.uint64)
    mixed = (hashes[codes[:-1]] * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[codes[1:]]
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, low, n) of each slice: how often each hash of two words occurs, dealt out by its upper bits."""
    for lang, words, starts in _runs(batches, 1):
        names, codes = _codes(words)
        real = (codes[:-1] > 0) & (codes[1:] > 0)
        hashes, counts = np.unique(_pair_hashes(lang, names, codes)[real], return_counts=True)
        if not len(hashes):
            continue
        shift = HASH_BITS - DEALT_BITS
        part, low = hashes >> shift, hashes & ((1 << shift) - 1)
        edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        offsets = pa.array(np.append(edges, len(part)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (low, counts)]
        yield pa.RecordBatch.from_arrays([pa.array(part[edges], pa.int32()), *lists], ["part", "low", "n"])


def frequent_pairs(slim: DataFrame, min_count: int) -> np.ndarray:
    """Bitmap of the hashes of pairs that may occur ``min_count`` times: those that do, and few others."""
    counted = slim.mapInArrow(count_pairs, "part int, low array<int>, n array<int>").repartition("part")
    counted = counted.select("part", F.inline(F.arrays_zip("low", "n"))).groupBy("part", "low").agg(F.sum("n").alias("n"))
    hashes = (F.col("part").cast("long") * (1 << (HASH_BITS - DEALT_BITS)) + F.col("low")).alias("hash")
    keys = stored(counted.where(F.col("n") >= min_count).select(hashes), "phrase-maybe")
    pieces = min(MOST_PIECES, keys.count() * PAIR_BITS // BITMAP_BITS + 1)
    bits = np.zeros(pieces * BITMAP_BITS // 8, dtype=np.uint8)
    for row in key_bitmap(keys, "hash", pieces).collect():
        start = row["_bucket"] * BITMAP_BITS // 8
        bits[start:start + BITMAP_BITS // 8] = np.frombuffer(row["_bits"], dtype=np.uint8)
    return bits


def count_stripes(batches: Iterator[pa.RecordBatch], common: set[tuple[str, str]], maybe: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Stripes of each slice: for a word w1 the pairs (w2, w3) that follow it, with counts.

    Null stands for the end of the piece and for words that cannot make a phrase with those before, as the pair is too
    rare; so the sum over a stripe stays the count of w1.  The stripe of a common word is dealt out by w2, and where w2
    is common too by w2 and w3, so that neither a word nor a pair of words meets in one place.
    """
    for lang, words, starts in _runs(batches, 2):
        names, codes = _codes(words)
        first = np.flatnonzero(codes[:starts] > 0)
        codes = np.concatenate((codes, [0, 0]))
        bit = _pair_hashes(lang, names, codes) % (len(maybe) * 8)
        alive = (maybe[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
        one = codes[first]
        two = np.where(alive[first], codes[first + 1], 0)
        three = np.where((two > 0) & alive[np.minimum(first + 1, len(alive) - 1)], codes[first + 2], 0)
        # fewer than 2 ** 21 different words in a slice: three numbers fit into one
        cells, counts = np.unique((one << 42) | (two << 21) | three, return_counts=True)
        mask = (1 << 21) - 1
        one, two, three = cells >> 42, (cells >> 21) & mask, cells & mask
        is_common = np.array([(lang, n.decode()) in common if i else False for i, n in enumerate(names)], dtype=bool)
        part = np.zeros(len(cells), dtype=np.int64)
        if is_common.any():
            checks = np.array([zlib.crc32(n) for n in names], dtype=np.int64)
            pair = is_common[one] & is_common[two]
            part = np.where(is_common[one], 1 + checks[two] % PARTS, 0)
            part = np.where(pair, 1 + PARTS + (checks[two] * 31 + checks[three]) % PARTS, part)
            order = np.lexsort((part, one))
            one, two, three, counts, part = one[order], two[order], three[order], counts[order], part[order]
        if not len(one):
            continue
        edges = np.flatnonzero(np.concatenate(([True], (one[1:] != one[:-1]) | (part[1:] != part[:-1]))))
        offsets = pa.array(np.append(edges, len(one)), pa.int32())
        strings = _strings(names)
        lists = [pa.ListArray.from_arrays(offsets, v) for v in (strings.take(pa.array(two)), strings.take(pa.array(three)), pa.array(counts, pa.int64()))]
        rows = pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(edges), pa.string()), strings.take(pa.array(one[edges])), pa.array(part[edges], pa.int32()), *lists],
            ["lang", "w1", "part", "w2", "w3", "n"])
        for start in range(0, rows.num_rows, 1 << 14):
            yield rows.slice(start, 1 << 14)


def merged_stripes(docs: DataFrame, min_count: int, lang_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(stripes, common words).

    A stripe (lang, w1, part) has ``total``, how often w1 occurs in front of what belongs to this part, and ``nexts``:
    (w2, f2, ends) for each next word, where f2 counts w1 w2 and ends holds (w3, f3) of phrases that are frequent enough.
    """
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    counts = stored(slim.mapInArrow(count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase-words")
    share = counts.agg(F.sum("n") / COMMON_SHARE).scalar()
    # at most COMMON_SHARE rows, whatever the input
    rows = counts.where(F.col("n") >= share).collect()
    known = {(r.lang, r.word) for r in rows}
    common = docs.sparkSession.createDataFrame(rows, "lang string, word string, n long")
    maybe = frequent_pairs(slim, min_count)
    stripes = slim.mapInArrow(lambda batches: count_stripes(batches, known, maybe), CELLS)
    # equal stripes are merged cell by cell, where they meet
    cells = stripes.repartition("lang", "w1", "part").select("lang", "w1", "part", F.inline(F.arrays_zip("w2", "w3", "n")))
    cells = cells.groupBy("lang", "w1", "part", "w2", "w3").agg(F.sum("n").alias("n"))
    frequent = F.when((F.col("n") >= min_count) & F.col("w3").isNotNull(), F.struct("w3", F.col("n").alias("f3")))
    nexts = cells.groupBy("lang", "w1", "part", "w2").agg(F.sum("n").alias("f2"), F.collect_list(frequent).alias("ends"))
    # the counts of pairs dealt out by w3 are partial, so these are kept whatever they are
    kept = F.when(F.col("w2").isNotNull() & ((F.col("f2") >= min_count) | (F.col("part") > PARTS)), F.struct("w2", "f2", "ends"))
    merged = nexts.groupBy("lang", "w1", "part").agg(F.sum("f2").alias("total"), F.collect_list(kept).alias("nexts"))
    return stored(merged, "phrase-stripes"), common


def _with_count(rows: DataFrame, word: str, name: str, totals: DataFrame, common: DataFrame) -> DataFrame:
    """``rows`` with the count of the word in column ``word``: those of common words come from the short list."""
    short = F.broadcast(common.select("lang", F.col("word").alias(word), F.col("n").alias(name)))
    rest = rows.join(short, ["lang", word], "left_anti").join(totals.select("lang", F.col("w1").alias(word), F.col("total").alias(name)), ["lang", word])
    return rows.join(short, ["lang", word]).unionByName(rest)


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact for counts up to 10^15, beyond which ``a`` squared has over 30 digits."""
    wide = lambda n: f"CAST({n} AS DECIMAL(16, 0))"
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * {wide(a)} * {wide(a)}) div ({wide(left)} * {wide(right)})")


def phrases(
    docs: DataFrame, min_count: int = 10, top: int | None = 2000, subsumed_percent: int = 50, lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """Phrases of two and three words by language: lang, rank, phrase, a, l, r, n, score.

    ``a`` is how often the phrase occurs, ``l`` and ``r`` its two parts at the lowest-scoring cut, ``n`` all words of the
    language and the score floor(1000000 * a * a / (l * r)).  Phrases that occur less than ``min_count`` times do not
    count, nor do those of which a longer one makes up ``subsumed_percent`` or more.  ``top`` ranks stay, or all.

    Null languages are ``und``, null and empty texts have no words, an empty table gives no rows, repeated rows count
    each time, ties go to the phrase that comes first in UTF-8; other columns are not read.  Very long texts are
    counted a slice at a time.
    """
    stripes, common = merged_stripes(docs, min_count, lang_col, text_col)
    sizes = stripes.groupBy("lang").agg(F.sum("total").alias("n"))
    totals = stripes.groupBy("lang", "w1").agg(F.sum("total").alias("total")).where(F.col("total") >= min_count)
    pairs = stripes.select("lang", "w1", F.inline("nexts"))
    # the longest continuation and the count of a pair come from its stripe; parts of a dealt-out pair are put together
    right = F.array_max(F.transform("ends", lambda e: e["f3"]))
    twos = stored(pairs.groupBy("lang", "w1", "w2").agg(F.sum("f2").alias("f2"), F.max(right).alias("longer")).where(F.col("f2") >= min_count), "phrase-pairs")
    threes = stored(pairs.select("lang", "w1", "w2", F.inline("ends")), "phrase-threes")
    before = threes.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("f3").alias("earlier"))

    best = twos.join(before, ["lang", "w1", "w2"], "left").where(
        100 * F.greatest(F.coalesce("longer", F.lit(0)), F.coalesce("earlier", F.lit(0))) < subsumed_percent * F.col("f2"))
    best = _with_count(_with_count(best, "w1", "l", totals, common), "w2", "r", totals, common)
    short = best.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f2").alias("a"), "l", "r", _score("f2", "l", "r").alias("score"))

    inner = threes.join(twos.select("lang", "w1", "w2", F.col("f2").alias("l2")), ["lang", "w1", "w2"])
    inner = inner.join(twos.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f2").alias("r1")), ["lang", "w2", "w3"])
    inner = _with_count(_with_count(inner, "w1", "l1", totals, common), "w3", "r2", totals, common)
    inner = inner.withColumns({"s1": _score("f3", "l1", "r1"), "s2": _score("f3", "l2", "r2")})
    pick = lambda x, y: F.when(F.col("s1") <= F.col("s2"), F.col(x)).otherwise(F.col(y))
    long = inner.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f3").alias("a"),
                        pick("l1", "l2").alias("l"), pick("r1", "r2").alias("r"), F.least("s1", "s2").alias("score"))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = short.unionByName(long).withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    ranked = ranked.join(sizes, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
