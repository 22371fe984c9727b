"""SentencePiece BPE: encoding in vectorised merge rounds over flat symbol arrays, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from struct import unpack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import bounded_batches

#: The visible character that stands for a space inside pieces.
SPACE = "▁"
#: Piece types of the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

#: Words kept with their ids, per Python worker, in each of two generations: a full one becomes the old one and the
#: old one is dropped, so words that keep coming back stay known.
CACHED, CACHED_CHARS = 200_000, 64
#: Words taken at a time, so that a very long text is never held as a list of all its words.
SLICE = 50_000
#: Texts encoded together and results held at a time, by rows and by bytes.
GROUP_ROWS, GROUP_BYTES = 2_048, 1 << 21

NEVER = np.iinfo(np.int32).max
SLOT_BITS = 20


def _slot(keys: np.ndarray) -> np.ndarray:
    """Slot of a pair in the table of pairs, by its multiplicative hash."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a message: an integer, four or eight bytes, or the bytes of a nested value."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at:at + size]
        at += size


class Model:
    """Pieces, scores and types of a ``.model`` file, and the tables that merging needs.

    Only what the encoder does exactly is taken: BPE with byte fallback, no text normalisation, no user-defined pieces,
    one space put before the text and no space removed.
    """

    def __init__(self, data: bytes):
        self.pieces, scores, self.types = [], [], []
        trainer, normalizer = {}, {}
        for number, value in _fields(data):
            if number == 1:
                entry = dict(_fields(value))
                self.pieces.append(entry.get(1, b"").decode())
                scores.append(unpack("<f", entry[2])[0] if 2 in entry else 0.0)
                self.types.append(entry.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        plain = not normalizer.get(2) and normalizer.get(3, 1) and not normalizer.get(4, 1) and normalizer.get(5, 1)
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24) or not plain or {USER_DEFINED, UNUSED} & set(self.types):
            raise ValueError("only BPE models with byte fallback, a leading space and no normalisation are encoded")
        self.unknown = trainer.get(44, " ⁇ ".encode())
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.texts: list[bytes] = []
        for i, (piece, kind) in enumerate(zip(self.pieces, self.types)):
            if kind == BYTE:
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.texts.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.texts.append(self.unknown if kind == UNKNOWN else b"" if kind == CONTROL else piece.replace(SPACE, " ").encode())
        self.controls = {i for i, kind in enumerate(self.types) if kind == CONTROL}
        self._merges(scores)

    def _merges(self, scores: list[float]) -> None:
        """Symbols are ids of pieces, then one number for each further character; pairs that join have a rank."""
        ids = {piece: i for i, piece in enumerate(self.pieces) if self.types[i] == NORMAL}
        more = sorted({c for piece in ids for c in piece} - ids.keys())
        symbol = ids | {c: len(self.pieces) + i for i, c in enumerate(more)}
        self.n = len(self.pieces) + len(more)
        # higher scores join first, equal scores have equal ranks
        order = {s: i for i, s in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
        rank_of = np.full(self.n, NEVER, dtype=np.int32)
        for i in ids.values():
            rank_of[i] = order[scores[i]]
        pairs = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.n + right] = i
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        joined = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int32)
        # one entry more, which no key finds
        self.keys = np.append(self.keys, np.iinfo(np.int64).max)
        self.joined = np.append(joined, 0)
        self.ranks = np.append(rank_of[joined] if len(joined) else joined, NEVER)
        # most pairs are found, or known to be none, by one look into a table; where another pair has the slot they are searched
        self.slots = np.full(1 << SLOT_BITS, len(self.keys) - 1, dtype=np.int32)
        self.slots[_slot(self.keys[:-1])] = np.arange(len(self.keys) - 1)
        self.chars = np.array(sorted(ord(c) for c in symbol if len(c) == 1), dtype=np.uint32)
        self.char_symbols = np.array([symbol[chr(c)] for c in self.chars.tolist()], dtype=np.int32)
        beside = {ord(a) << 32 | ord(b) for piece in ids for a, b in zip(piece, piece[1:])}
        self.beside = np.array(sorted(beside) + [np.iinfo(np.int64).max], dtype=np.int64)
        # pieces of spaces alone may share one score and then join strictly from the left: a run becomes blocks of the longest
        self.block = max((len(p) for p in ids if not p.strip(SPACE)), default=1)
        if self.block > 1:
            one, several = [SPACE * self.block], [SPACE * (3 * self.block + 1)]
            (some,), (ids,) = self.encode_words(several), self.encode_words(one)
            if not some.startswith(ids * 3):
                self.block = 1

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in the tables; the last place, of rank NEVER, for pairs that do not join."""
        keys = left.astype(np.int64) * self.n + right
        keys[(left < 0) | (right < 0)] = -1
        at = self.slots[_slot(keys)]
        other = np.flatnonzero((self.keys[at] != keys) & (at < len(self.keys) - 1))
        search = keys[other]
        spot = np.searchsorted(self.keys[:-1], search)
        at[other] = np.where(self.keys[spot] == search, spot, len(self.keys) - 1)
        return at

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit numbers, all words at once.

        Each round takes the least rank in every word and joins the pairs of that rank, the leftmost first where pairs
        overlap.  Where joining creates a pair that would come next itself, joins further right in that word wait for
        another round, so that the order is that of one join at a time.  Words without a pair leave; the rest closes up.
        """
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        at = np.minimum(np.searchsorted(self.chars, flat), max(len(self.chars) - 1, 0))
        known = self.chars[at] == flat if len(self.chars) else np.zeros(len(flat), dtype=bool)
        # characters outside the model are negative: they never join
        symbols = np.where(known, self.char_symbols[at] if len(self.chars) else 0, -1 - flat.astype(np.int64)).astype(np.int32)
        # a word falls apart where no piece has the two characters side by side
        parts = owner
        if len(flat) > 1:
            beside = flat[:-1].astype(np.int64) << 32 | flat[1:]
            apart = self.beside[np.searchsorted(self.beside[:-1], beside)] != beside
            parts = np.concatenate(([0], np.cumsum(apart | (owner[1:] != owner[:-1]))))
        place = np.arange(len(flat))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        at = np.full(len(flat), len(self.keys) - 1)
        if len(flat) > 1:
            at[:-1] = np.where(parts[1:] == parts[:-1], self._pairs(symbols[:-1], symbols[1:]), len(self.keys) - 1)
        while len(symbols):
            rank = self.ranks[at]
            first = np.concatenate(([True], parts[1:] != parts[:-1]))
            starts = np.flatnonzero(first)
            least = np.minimum.reduceat(rank, starts)
            least = np.repeat(least, np.diff(np.append(starts, len(rank))))
            live = least < NEVER
            if not live.all():
                done.append((place[~live], symbols[~live]))
                symbols, parts, place, at, rank, least, first = (x[live] for x in (symbols, parts, place, at, rank, least, first))
                if not len(symbols):
                    break
            chosen = np.flatnonzero(rank == least)
            # overlapping pairs are neighbours: of a row of them, every other one, from the first
            fresh = np.concatenate(([True], (np.diff(chosen) != 1) | first[chosen[1:]]))
            since = np.arange(len(chosen)) - np.maximum.accumulate(np.where(fresh, np.arange(len(chosen)), 0))
            chosen = chosen[since % 2 == 0]
            new = self.joined[at[chosen]]
            same = parts[chosen[1:]] == parts[chosen[:-1]]
            if same.any():
                chosen, new = self._until_next(symbols, parts, least, chosen, new, same)
            symbols[chosen] = new
            stay = np.ones(len(symbols), dtype=bool)
            stay[chosen + 1] = False
            changed = np.zeros(len(symbols), dtype=bool)
            changed[chosen] = True
            symbols, parts, place, at, changed = symbols[stay], parts[stay], place[stay], at[stay], changed[stay]
            # the pairs that start with a new symbol or with the one before it
            look = changed.copy()
            look[:-1] |= changed[1:]
            look = np.flatnonzero(look)
            inner = look[look + 1 < len(symbols)]
            inner = inner[parts[inner] == parts[inner + 1]]
            at[look] = len(self.keys) - 1
            at[inner] = self._pairs(symbols[inner], symbols[inner + 1])
        if not done:
            return [b"" for _ in words]
        place = np.concatenate([d[0] for d in done])
        symbols = np.concatenate([d[1] for d in done])
        order = np.argsort(place)
        place, symbols = place[order], symbols[order]
        ids, owners = self._with_bytes(symbols, owner[place], flat[place])
        raw, ends = ids.astype("<i4").tobytes(), (np.searchsorted(owners, np.arange(len(words)), "right") * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _until_next(self, symbols, parts, least, chosen, new, same):
        """The joins up to, in each part, the first that creates a pair of the same or a lower rank."""
        before = np.maximum(chosen - 1, 0)
        left = np.where((chosen > 0) & (parts[before] == parts[chosen]), symbols[before], -1)
        close = np.concatenate(([False], same & (chosen[1:] - chosen[:-1] == 2)))
        left[1:] = np.where(close[1:], new[:-1], left[1:])
        after = np.minimum(chosen + 2, len(symbols) - 1)
        right = np.where((chosen + 2 < len(symbols)) & (parts[after] == parts[chosen]), symbols[after], -1)
        soon = np.minimum(self.ranks[self._pairs(left, new)], self.ranks[self._pairs(new, right)]) <= least[chosen]
        if not soon.any():
            return chosen, new
        earlier = np.cumsum(soon) - soon
        starts = np.flatnonzero(np.concatenate(([True], ~same)))
        keep = earlier == np.repeat(earlier[starts], np.diff(np.append(starts, len(chosen))))
        return chosen[keep], new[keep]

    def _with_bytes(self, symbols, owners, chars):
        """Characters that are no piece become the ids of their bytes."""
        strange = (symbols < 0) | (symbols >= len(self.pieces))
        if not strange.any():
            return symbols, owners
        spots = np.flatnonzero(strange)
        coded = [np.frombuffer(chr(c).encode("utf-8", "replace"), dtype=np.uint8) for c in chars[spots].tolist()]
        sizes = np.ones(len(symbols), dtype=np.int64)
        sizes[spots] = [len(c) for c in coded]
        ids = np.repeat(symbols, sizes)
        ids[np.repeat(strange, sizes)] = self.byte_ids[np.concatenate(coded)]
        return ids, np.repeat(owners, sizes)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: a leading space is taken off, bytes that are no UTF-8 become U+FFFD one by one."""
        try:
            # a control piece parts the bytes before and after it
            text = b"".join(map(self.texts.__getitem__, ids)).decode() if self.controls.isdisjoint(ids) else self._decode_runs(ids)
        except UnicodeDecodeError:
            text = self._decode_runs(ids)
        first = next((i for i in ids if self.types[i] != CONTROL), None)
        return text[1:] if first is not None and self.types[first] == NORMAL and text.startswith(" ") else text

    def _decode_runs(self, ids: list[int]) -> str:
        out, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.types[i] == BYTE:
                run += self.texts[i]
                continue
            while run:
                try:
                    out.append(run.decode())
                    break
                except UnicodeDecodeError as bad:
                    out.append(run[:bad.start].decode() + "�")
                    run = run[bad.start + 1:]
            run = b""
            if i is not None:
                out.append(self.texts[i].decode())
        return "".join(out)


class Encoder:
    def __init__(self, data: bytes):
        self.model = Model(data)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        block = rf" {{{self.model.block}}}(?= )|" if self.model.block > 1 else ""
        #: Spaces and what follows up to the next space.
        self.split = re.compile(rf"{block} *[^ ]+| +")

    def words(self, text: str) -> Iterator[str]:
        text = " " + text.replace(SPACE, " ")
        if len(text) > 1 << 20:
            return (m.group() for m in self.split.finditer(text))
        return iter(self.split.findall(text))

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Merges words that are not known, all in the same rounds; gives the long ones, the others are known then."""
        if len(self.known) + len(words) > CACHED:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        back = {w: old[w] for w in words if w in old}
        fresh = [w for w in words if w not in back]
        known.update(back)
        found = dict(zip(fresh, self.model.encode_words([w.replace(" ", SPACE) for w in fresh])))
        long = {w: found.pop(w) for w in fresh if len(w) > CACHED_CHARS}
        known.update(found)
        return long

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text.  The unknown words of some texts, or of a part of a long one, are merged together."""
        out: list[list[bytes]] = [[] for _ in texts]
        todo: list[tuple[int, list[str]]] = []
        fresh: set[str] = set()

        def flush() -> None:
            before = self.known
            long = self.learn(fresh)
            for i, words in todo:
                if long or before is not self.known:
                    # words may have gone into the older generation
                    known, old = self.known, self.old
                    out[i].append(b"".join([known.get(w) or long.get(w) or old[w] for w in words]))
                else:
                    out[i].append(b"".join(map(before.__getitem__, words)))
            todo.clear()
            fresh.clear()

        for i, text in enumerate(texts):
            words = self.words(text) if text else iter(())
            while some := list(islice(words, SLICE)):
                todo.append((i, some))
                fresh.update(set(some).difference(self.known))
                if len(fresh) >= SLICE:
                    flush()
        flush()
        return [b"".join(parts) for parts in out]


@lru_cache(1)
def encoder_of(data: bytes) -> Encoder:
    """One for each Python worker, so that its known words serve the next task as well."""
    return Encoder(data)


def groups(texts: pa.Array) -> Iterator[slice]:
    """Rows to be handled together: at most GROUP_ROWS, and no more than GROUP_BYTES bytes besides one text."""
    sizes = pc.binary_length(texts).fill_null(0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > GROUP_BYTES or i - start >= GROUP_ROWS):
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def piece_tokens(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids (array of int) and decoded, the text that the ids stand for.

    ``model`` holds the bytes of a ``.model`` file, at most a few MB, which go to the executors with the function.
    Needs no shuffle: a lost executor costs its own tasks.  Null and empty texts have no tokens and decode to the empty
    text; repeated rows are encoded like any other and an empty table gives an empty one; other columns are not read.
    A very long text is cut into words a slice at a time; words without a space inside are merged in one piece, in as
    many rounds as their different merges need, over arrays of a few numbers per character.
    """

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        for batch in batches:
            for rows in groups(batch.column(1)):
                some = batch.slice(rows.start, rows.stop - rows.start)
                ids = [np.frombuffer(x, dtype="<i4") for x in encoder.encode(some.column(1).to_pylist())]
                decoded = [encoder.model.decode(x.tolist()) for x in ids]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(np.diff(offsets), pa.int64()), lists, pa.array(decoded, pa.string())], ["id", "n_tokens", "ids", "decoded"])
        pa.default_memory_pool().release_unused()

    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(both, f"id {kind}, n_tokens long, ids array<int>, decoded string").withColumnRenamed("id", id_col)
