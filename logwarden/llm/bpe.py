"""Byte-level BPE: encoding with a rank queue under a hierarchical bitmap, and decoding."""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import bounded_batches

#: Letters and numbers that the installed ``regex`` knows and tiktoken's older Unicode tables do not.
#: Both sides of a split must take these for unassigned, or the ids differ.
UNASSIGNED = (
    "\u0558 \u058b-\u058c \u088f \u0c5c \u0cdc \u208f \u209d-\u209f \ua7ce-\ua7cf \ua7d2 \ua7d4 \ua7dd \ua7e2 \ua7f1 \uab6c-\uab6d "
    "\U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee \U00011b0a \U00011db0-\U00011ddb "
    "\U00011de0-\U00011de9 \U00011df1 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 \U00016ea0-\U00016eb8 "
    "\U00016ebb-\U00016ed3 \U00016ff2-\U00016ff6 \U000187f8-\U000187ff \U00018cd6-\U00018cda \U00018d09-\U00018d20 "
    "\U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 \U0001b123-\U0001b128 \U0001b168 \U0001d6a6 "
    "\U0001df1f-\U0001df24 \U0001df2b-\U0001df81 \U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de "
    "\U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 \U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff "
    "\U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead \U000323b0-\U00033479 \U0003d000-\U0003fc3f")
_UNASSIGNED = regex.compile(f"[{UNASSIGNED.replace(' ', '')}]")
_STAND_IN = "\U0010ffff"

#: Pre-tokens kept with their ids, per Python worker, in each of two generations: a full one becomes the old one and the
#: old one is dropped, so pre-tokens that keep coming back stay known.
CACHED, CACHED_CHARS = 200_000, 64
#: Pre-tokens taken at a time, so that a very long text is never held as a list of all its pre-tokens.
SLICE = 50_000
#: Documents whose ids and bytes are held at a time.
OUT_ROWS = 256


def read_ranks(lines: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


class RankQueue:
    """Positions in buckets by merge rank under a bitmap of the buckets in use, and a bitmap of its words above it.

    A rank is a word's number and 8 bits inside the word; only words in use are kept.  The lowest rank takes one
    find-first-set in the upper bitmap and one in the word; a bucket is a heap, so it gives its leftmost position.
    """

    BITS = 8

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.words: dict[int, int] = {}
        self.upper = 0

    def add(self, rank: int, position: int) -> None:
        if (bucket := self.buckets.get(rank)) is not None:
            heappush(bucket, position)
        else:
            self.buckets[rank] = [position]
            word = rank >> self.BITS
            self.words[word] = self.words.get(word, 0) | 1 << (rank & (1 << self.BITS) - 1)
            self.upper |= 1 << word

    def pop(self) -> tuple[int, int] | None:
        if not self.upper:
            return None
        word = (self.upper & -self.upper).bit_length() - 1
        bits = self.words[word]
        rank = (word << self.BITS) + (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.words[word] = bits = bits & (bits - 1)
            if not bits:
                self.upper &= self.upper - 1
        return rank, position


#: The bit of each rank inside its word, and of each word in the upper bitmap.
_BIT = [1 << i for i in range(1 << RankQueue.BITS)]


class Ranks:
    """Token ranks with tables for the first look at a pre-token: ranks of single bytes and of two bytes (-1 for none)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.get, self.one = ranks.get, [ranks.get(bytes([a]), -1) for a in range(256)]
        self.two = [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self.upper = [1 << i for i in range((max(ranks.values(), default=0) >> RankQueue.BITS) + 1)]


def merge(piece: bytes, ranks: Ranks) -> list[int]:
    """Ids of one pre-token: again and again the leftmost pair of the lowest rank becomes one token.

    The rank of a pair is the id of the token it becomes.  The queue is that of :class:`RankQueue`, written out here
    because calls would cost more than the work.
    """
    get, bit, above = ranks.get, _BIT, ranks.upper
    if (whole := get(piece)) is not None:
        return [whole]
    n = len(piece)
    # the token that starts at i is token[i] = piece[i:end[i]], the one before it starts at left[i], and the pair that
    # starts at i has the rank pair[i], -1 for none
    one, two = ranks.one, ranks.two
    token = [one[a] for a in piece]
    end, left = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = [two[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]
    pair.append(-1)
    buckets: dict[int, list[int]] = {}
    words: dict[int, int] = {}
    upper = alive = 0
    for i, rank in enumerate(pair):
        if rank >= 0:
            alive += 1
            if rank in buckets:
                buckets[rank].append(i)  # rising positions: a heap already
            else:
                buckets[rank] = [i]
                word = rank >> 8
                if word in words:
                    words[word] |= bit[rank & 255]
                else:
                    words[word] = bit[rank & 255]
                    upper |= above[word]
    while alive:
        word = (upper & -upper).bit_length() - 1
        bits = words[word]
        low = bits & -bits
        rank = (word << 8) + low.bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) > 1:
            i = heappop(bucket)
        else:
            i = bucket[0]
            del buckets[rank]
            if bits == low:
                del words[word]
                upper ^= above[word]
            else:
                words[word] = bits ^ low
        if pair[i] != rank:
            continue  # stale: one side has been merged since
        middle = end[i]
        end[i] = stop = end[middle]
        token[i] = rank
        alive -= 1
        if pair[middle] >= 0:
            pair[middle] = -1
            alive -= 1
        new = -1
        if stop < n:
            left[stop] = i
            new = get(piece[i:end[stop]], -1)
            if new >= 0:
                alive += 1
                if new in buckets:
                    heappush(buckets[new], i)
                else:
                    buckets[new] = [i]
                    word = new >> 8
                    if word in words:
                        words[word] |= bit[new & 255]
                    else:
                        words[word] = bit[new & 255]
                        upper |= above[word]
        pair[i] = new
        i = left[i]
        if i >= 0:
            old, new = pair[i], get(piece[i:stop], -1)
            if new != old:
                pair[i] = new
                alive += (new >= 0) - (old >= 0)
                if new >= 0:
                    if new in buckets:
                        heappush(buckets[new], i)
                    else:
                        buckets[new] = [i]
                        word = new >> 8
                        if word in words:
                            words[word] |= bit[new & 255]
                        else:
                            words[word] = bit[new & 255]
                            upper |= above[word]
    out, i = [], 0
    while i < n:
        out.append(token[i])
        i = end[i]
    return out


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.table, self.split = ranks, Ranks(ranks), regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, piece: str) -> bytes:
        """Ids of a pre-token as little-endian 32-bit numbers."""
        packed = self.known.get(piece) or self.old.get(piece)
        if packed is None:
            found = merge(piece.encode(), self.table)
            packed = pack(f"<{len(found)}I", *found)
        if len(piece) <= CACHED_CHARS:
            if len(self.known) >= CACHED:
                self.old, self.known = self.known, {}
            self.known[piece] = packed
        return packed

    def pieces(self, text: str) -> Iterator[str]:
        """The matches of the pattern, one after another."""
        if not _is_latin(text):  # the usual texts, tested fast
            if _UNASSIGNED.search(text):
                spans = self.split.finditer(_UNASSIGNED.sub(_STAND_IN, text))
                return (text[m.start():m.end()] for m in spans)
        if len(text) > 1 << 20:
            return (m.group() for m in self.split.finditer(text))
        return iter(self.split.findall(text))

    def encode(self, text: str) -> bytes:
        parts, pieces = [], self.pieces(text)
        while some := list(islice(pieces, SLICE)):
            known = self.known
            parts.append(b"".join([known.get(p) or self.ids(p) for p in some]))
        return b"".join(parts)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text.  Merging makes many short-lived lists and no cycles: the cycle collector would only walk
        through the known pre-tokens again and again, so it rests meanwhile."""
        resting = gc.isenabled()
        gc.disable()
        try:
            return [self.encode(t) if t else b"" for t in texts]
        finally:
            if resting:
                gc.enable()


@lru_cache(1)
def encoder_of(ranks: str, pattern: str) -> Encoder:
    """One for each Python worker, so that its known pre-tokens serve the next task as well."""
    return Encoder(read_ranks(ranks), pattern)


class Decoder:
    """All tokens' bytes in one array, with the start and the length of each; a text is gathered from it."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, dtype="<u4")
        return b"".join(self._gather(numbers[i:i + SLICE]) for i in range(0, len(numbers), SLICE))

    def _gather(self, numbers: np.ndarray) -> bytes:
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[numbers] - ends + lengths, lengths)
        at += np.arange(len(at))
        return self.bytes[at].tobytes()


def encode_column(text: Column, ranks: str, pattern: str) -> Column:
    """Ids of a text as binary, four little-endian bytes each (the layout of token files); null counts as empty.

    ``ranks`` is the text of the rank file, at most a few MB, which goes to the executors with the function.
    """

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = encoder_of(ranks, pattern)
        for batch in batches:
            yield pd.Series(encoder.encode_all(batch.tolist()), dtype=object)

    return encode(text)


def decode_column(ids: Column, ranks: str) -> Column:
    """The bytes that the ids of :func:`encode_column` stand for."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(read_ranks(ranks))
        for batch in batches:
            yield pd.Series([decoder.decode(b) if b else b"" for b in batch], dtype=object)

    return decode(ids)


def tokenize(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids (binary, see :func:`encode_column`), n_tokens and decoded (binary).

    Every match of ``pattern`` is merged by itself.  Needs no shuffle: a lost executor costs its own tasks.  Encoding
    and decoding share one Python pass over small record batches.  Null and empty texts have no tokens; repeated rows
    are encoded like any other; other columns are not read.
    """

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(ranks, pattern)
        decoder = Decoder(encoder.ranks)
        for batch in batches:
            for start in range(0, batch.num_rows, OUT_ROWS):
                some = batch.slice(start, OUT_ROWS)
                ids = encoder.encode_all(some.column(1).to_pylist())
                decoded = pa.array([decoder.decode(x) for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), decoded], ["id", "ids", "n_tokens", "decoded"])
        pa.default_memory_pool().release_unused()

    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(both, f"id {kind}, ids binary, n_tokens long, decoded binary").withColumnRenamed("id", id_col)
