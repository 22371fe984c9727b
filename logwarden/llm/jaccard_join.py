"""Exact Jaccard self-join of word-shingle sets by size-banded tiles with hashed bitmap signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import BITMAP_BITS, bounded_batches, clear_stored, in_bitmap, key_bitmap, new_group, stored
from logwarden.llm.components import stars
from logwarden.llm.shingles import U, mix, shingle_sets

#: Counters of the shingle frequencies.  They only set the order in which a set's shingles are looked at, so their
#: number affects the work and never the result.  They are counted and sent in pieces; a level takes one byte.
COUNTERS, PIECE = 1 << 22, 1 << 16
#: Size of the bitmaps that spare work (4 KiB a bucket), whatever the input's size.
NODE_BUCKETS, SET_BUCKETS = 1024, 256
#: Tiles are dealt out in at least 2^8 pieces and at most 2^16, of about as many tiles each; a tile's name has 32 bits
#: inside its piece.  Tiles that share a name cost comparisons and change no result.
PIECE_BITS, PIECE_TILES, TILE_BYTES = 8, 1 << 20, 6
#: Tiles that a task holds before it hands them on.
HELD_TILES = 1 << 20
#: Rows of a tile that are compared with each other at a time.
BLOCK = 256
#: How many other centres tiles that still hold several components draw before their pairs are compared in blocks.
#: More draws only spare work.
DRAWS = 2


def frequencies(texts: DataFrame, k: int) -> np.ndarray:
    """The whole part of the logarithm to base 2 of how often shingles with each counter's number occur in all sets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for held in shingle_sets(batch.column(0), k):
                np.add.at(total, (held & U(COUNTERS - 1)).astype(np.int64), np.uint32(1))
        for at in range(COUNTERS // PIECE):
            piece = total[at * PIECE:(at + 1) * PIECE]
            if piece.any():
                narrow = piece.astype(np.min_scalar_type(int(piece.max())))
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([narrow.tobytes()], pa.binary())], ["at", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # at most COUNTERS numbers
        for batch in batches:
            for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = total.setdefault(at, np.zeros(PIECE, np.int64))
                held += np.frombuffer(counts, f"u{len(counts) // PIECE}")
        for at, held in total.items():
            levels = np.floor(np.log2(np.maximum(held, 1))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([levels.tobytes()], pa.binary())], ["at", "levels"])

    pieces = texts.select("text").mapInArrow(count, "at int, counts binary").repartition("at").mapInArrow(add, "at int, levels binary")
    level = np.zeros(COUNTERS, np.uint8)
    for row in pieces.collect():  # at most COUNTERS / PIECE rows of 64 KiB; toLocalIterator() runs a job for each partition
        level[row["at"] * PIECE:(row["at"] + 1) * PIECE] = np.frombuffer(row["levels"], np.uint8)
    return level


def bands(num: int, den: int, largest: int = 1 << 40) -> list[int]:
    """First size of each band: sets that can reach the threshold lie in one band or in neighbours."""
    starts = [1]
    while starts[-1] < largest:
        starts.append(starts[-1] * den // num + 1)
    return starts


def signature(held: np.ndarray) -> bytes:
    """Parities of the hashes' low bits, four to eight bits for each member; the length is a power of two.

    Two signatures differ in at most as many bits as the sets differ in members, also after the longer one is folded
    to the length of the shorter by XOR of its halves.
    """
    bits = 64
    while bits < 4 * len(held):
        bits *= 2
    return np.packbits((np.bincount(((held >> U(8)) & U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def _folded(a: np.ndarray, width: int) -> np.ndarray:
    """Rows of signatures, as words of 64 bits, folded to ``width`` words."""
    while a.shape[1] > width:
        a = a[:, :a.shape[1] // 2] ^ a[:, a.shape[1] // 2:]
    return a


def _stacked(signatures: list[bytes]) -> np.ndarray:
    """Signatures of one length as rows of 64-bit words."""
    return np.frombuffer(b"".join(signatures), U).reshape(len(signatures), -1)


def at_least_different(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """A lower bound of the symmetric difference of each pair of sets, from their signatures."""
    out = np.zeros(len(a), np.int64)
    wide = np.array([(len(x), len(y)) for x, y in zip(a, b, strict=True)], np.int64).reshape(-1, 2)
    for x, y in np.unique(wide, axis=0).tolist():
        at = np.flatnonzero((wide == (x, y)).all(axis=1))
        width = min(x, y) // 8
        left, right = (_folded(_stacked([c[i] for i in at.tolist()]), width) for c in (a, b))
        out[at] = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def set_table(texts: DataFrame, k: int, num: int, den: int, levels: np.ndarray) -> DataFrame:
    """(doc_id, h, n, d1, d2, sketch, tiles) of every document: set size, 128-bit digest, signature and tiles (six bytes each).

    A tile is a shingle and a size band.  With its shingles ordered from rare to frequent, a set must share one of
    its first n - ceil(threshold x n) + 1 with every linked set that is not larger, and one of its first
    n - ceil(2 threshold / (1 + threshold) x n) + 1 with every one that is not smaller.  The longer start goes to the
    tiles of its own band, the shorter to those of the next.
    """
    starts = np.array(bands(num, den))
    shared = texts.sparkSession.sparkContext.broadcast(levels)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in batches:
            sizes, d1, d2, sketches, tiles = [], [], [], [], []
            for held in shingle_sets(batch.column(2), k):
                n = len(held)
                sizes.append(n)
                d1.append(int(mix(held ^ U(0x5DEECE66D)).sum(dtype=U)) + n & (1 << 64) - 1)
                d2.append(int(mix(held * U(0xD6E8FEB86659FD93) + U(11)).sum(dtype=U)))
                if not n:
                    sketches.append(None)
                    tiles.append(None)
                    continue
                sketches.append(signature(held))
                mixed = mix(held + U(77))
                order = level[(held & U(COUNTERS - 1)).astype(np.int64)].astype(U) << U(56) | mixed >> U(8)
                long, short = n + num * n // -den + 1, n + 2 * num * n // -(num + den) + 1
                first = np.argpartition(order, long - 1)[:long] if long < n else np.arange(n)
                first = mixed[first[np.argsort(order[first])]]
                band = int(np.searchsorted(starts, n, "right"))
                both = np.concatenate([mix(first + U(band)), mix(first[:short] + U(band + 1))])
                tiles.append(both.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TILE_BYTES].tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(_signed(np.array(d1, U))), pa.array(_signed(np.array(d2, U))),
                pa.array(sketches, pa.binary()), pa.array(tiles, pa.binary())],
                ["doc_id", "h", "n", "d1", "d2", "sketch", "tiles"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "h", "text").mapInArrow(make, f"doc_id {kind}, h long, n long, d1 long, d2 long, sketch binary, tiles binary")


def _dealt(bits: int):
    """(piece, base, tiles, nodes): tiles of rows (rid, tiles) sorted by name; nodes are numbers of 16 bits from ``base``."""

    def flush(base: int, rids: list[np.ndarray], tiles: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rid, tile = np.concatenate(rids), np.concatenate(tiles)
        order = np.argsort(tile)
        rid, tile = rid[order], tile[order]
        cuts = np.searchsorted(tile, np.arange((1 << bits) + 1, dtype=U) << U(32))
        low = tile.astype(np.uint32)
        pieces = np.flatnonzero(cuts[1:] > cuts[:-1])
        for start in range(0, len(pieces), 64):
            some = pieces[start:start + 64].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([base] * len(some), pa.int64()),
                 *(pa.array([x[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary()) for x in (low, rid))], ["piece", "base", "tiles", "nodes"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, rids, tiles = None, 0, [], []
        for batch in batches:
            for rid, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if held and (rid >> 16 << 16 != base or held >= HELD_TILES):
                    yield from flush(base, rids, tiles)
                    held, rids, tiles = 0, [], []
                base = rid >> 16 << 16
                raw = np.frombuffer(own.as_buffer(), np.uint8).reshape(-1, TILE_BYTES)
                names = np.zeros((len(raw), 8), np.uint8)
                names[:, :TILE_BYTES] = raw
                tiles.append(names.view("<u8").ravel() & U((1 << bits + 32) - 1))
                rids.append(np.full(len(raw), rid - base, np.uint16))
                held += len(raw)
        if held:
            yield from flush(base, rids, tiles)

    return deal


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tile, rid, lo, hi, size) of the tiles with several nodes, from rows of :func:`_dealt` in the order of pieces.

    A task holds one piece, and of a node in it twelve bytes.
    """

    def members(piece: int, parts: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        low = np.concatenate([np.frombuffer(t, np.uint32) for _, t, _ in parts])
        rid = np.concatenate([np.frombuffer(r, np.uint16).astype(np.int64) + base for base, _, r in parts])
        order = np.lexsort((rid, low))
        low, rid = low[order], rid[order]
        fresh = np.ones(len(low), bool)
        fresh[1:] = (low[1:] != low[:-1]) | (rid[1:] != rid[:-1])
        low, rid = low[fresh], rid[fresh]
        starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        sizes = np.diff(np.append(starts, len(low)))
        size = np.repeat(sizes, sizes)
        keep = size > 1
        lo, hi = np.repeat(rid[starts], sizes), np.repeat(rid[starts + sizes - 1], sizes)
        tile = low.astype(np.int64) + (piece << 32)
        columns = [x[keep] for x in (tile, rid, lo, hi, size)]
        for start in range(0, len(columns[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[start:start + (1 << 16)]) for x in columns], ["tile", "rid", "lo", "hi", "size"])

    now, parts = None, []
    for batch in batches:
        for piece, *part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if piece != now and parts:
                yield from members(now, parts)
                parts = []
            now = piece
            parts.append(tuple(part))
    if parts:
        yield from members(now, parts)


def _may_link(num: int, den: int):
    """Keep pairs whose sizes and signatures leave room for the threshold."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            total = pdf["nu"].to_numpy(np.int64) + pdf["nv"].to_numpy(np.int64)
            shared = (total - at_least_different(pdf["su"].tolist(), pdf["sv"].tolist())) // 2
            yield pdf.loc[den * shared >= num * (total - shared), ["u", "v"]]

    return keep


def _blocks(num: int, den: int):
    """Pairs inside sorted runs of rows with one ``unit``: different components, fitting sizes and signatures."""

    def pairs_of(run: pd.DataFrame) -> list[tuple[int, int]]:
        ids, n, part, side = run["rid"].to_numpy(), run["n"].to_numpy(), run["part"].to_numpy(), run["side"].to_numpy()
        sketches = run["sketch"].tolist()
        wide = np.array([len(s) // 8 for s in sketches])
        # for each length: where the signatures of at least this length are, and these folded to it
        folded = {}
        for width in np.unique(wide).tolist():
            place, rows = np.full(len(ids), -1), []
            for w in np.unique(wide[wide >= width]).tolist():
                at = np.flatnonzero(wide == w)
                place[at] = sum(map(len, rows)) + np.arange(len(at))
                rows.append(_folded(_stacked([sketches[i] for i in at.tolist()]), width))
            folded[width] = place, np.concatenate(rows)
        out = []
        for i in range(len(ids)):
            small, large = np.minimum(n[i], n), np.maximum(n[i], n)
            near = (ids > ids[i]) if run["same"].iat[0] else (side != side[i]) & (side[i] == 0)
            near = np.flatnonzero(near & (part != part[i]) & (den * small >= num * large))
            least = np.minimum(wide[near], wide[i])
            for width in np.unique(least).tolist():
                some, (place, rows) = near[least == width], folded[width]
                differ = np.bitwise_count(rows[place[some]] ^ rows[place[i]]).sum(axis=1, dtype=np.int64)
                shared = (n[i] + n[some] - differ) // 2
                good = some[den * shared >= num * (n[i] + n[some] - shared)]
                out += [(min(ids[i], j), max(ids[i], j)) for j in ids[good]]
        return out

    def run_over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            units = rest["unit"].to_numpy()
            last = int(np.searchsorted(units, units[-1])) if len(units) else 0
            whole, rest = rest.iloc[:last], rest.iloc[last:]
            found = [p for _, run in whole.groupby("unit", sort=False) for p in pairs_of(run)]
            yield pd.DataFrame(found, columns=["u", "v"], dtype="int64")
        if rest is not None and len(rest):
            yield pd.DataFrame([p for _, run in rest.groupby("unit", sort=False) for p in pairs_of(run)], columns=["u", "v"], dtype="int64")

    return run_over


def _edges(found: DataFrame) -> DataFrame:
    """Known components as links of each node to the smallest."""
    return found.select(F.col("component").alias("u"), F.col("node").alias("v"))


class _Join:
    def __init__(self, texts: DataFrame, k: int, num: int, den: int):
        bounded_batches(texts.sparkSession)
        self.texts, self.k, self.num, self.den = texts, k, num, den
        #: tables of this call, removed when its result is written, or earlier
        self.group = new_group("jaccard")
        made = set_table(texts, k, num, den, frequencies(texts, k))
        self.sets = self.stored(made.withColumn("rid", F.monotonically_increasing_id()), "jaccard-sets")
        held = self.sets.where("n > 0")
        # equal sets are one node, named by the smallest row number
        self.classes = self.stored(held.groupBy("d1", "d2").agg(
            F.min("rid").alias("node"), F.count("*").alias("members"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("least")).select(
            "d1", "d2", "node", "members", F.col("least.doc_id").alias("least_id"), F.col("least.h").alias("h")), "jaccard-classes")
        copies = self.stored(held.select("d1", "d2", "rid").join(self.classes.where("members > 1"), ["d1", "d2"])
                        .where("rid != node").select("rid"), "jaccard-copies")
        self.nodes = held.join(copies, "rid", "left_anti")

    def stored(self, df: DataFrame, name: str, part: str = "") -> DataFrame:
        return stored(df, name, f"{self.group}/{part}")

    def clear(self, part: str = "") -> None:
        """Remove the tables of a finished part, or of the whole call."""
        clear_stored(self.texts.sparkSession, f"{self.group}/{part}")

    def members(self) -> DataFrame:
        """(tile, rid, lo, hi, size) of the tiles that hold at least two nodes; lo and hi are its first and last.

        Tiles are shuffled in sorted runs, some six bytes for a node in a tile; a run has the tiles of one task.
        """
        rows = self.nodes.select("rid", "tiles")
        count = self.sets.agg(F.sum(F.octet_length("tiles"))).first()[0] or 0
        bits = min(max((count // TILE_BYTES // PIECE_TILES).bit_length(), PIECE_BITS), 16)
        runs = rows.mapInArrow(_dealt(bits), "piece int, base long, tiles binary, nodes binary").repartition("piece").sortWithinPartitions("piece")
        return self.stored(runs.mapInArrow(_gathered, "tile long, rid long, lo long, hi long, size long"), "jaccard-members")

    def signed(self, rids: DataFrame) -> DataFrame:
        """(rid, n, sketch) of the nodes in ``rids`` (rid) and a few more: a bitmap keeps most others out of the shuffle."""
        key = F.xxhash64("rid").alias("key")
        bits = key_bitmap(rids.select(key), "key", NODE_BUCKETS)
        rows = in_bitmap(self.nodes.select("rid", "n", "sketch", key), "key", bits, NODE_BUCKETS, "maybe")
        return rows.where("maybe").select("rid", "n", "sketch")

    def may_link(self, pairs: DataFrame) -> DataFrame:
        size = lambda c: self.nodes.select(F.col("rid").alias(c), F.col("n").alias(f"n{c}"))
        sized = pairs.join(size("u"), "u").join(size("v"), "v").where(
            self.den * F.least("nu", "nv") >= self.num * F.greatest("nu", "nv")).select("u", "v", "nu", "nv")
        sized = self.stored(sized, "jaccard-sized", "sized")
        signed = self.signed(sized.select(F.col("u").alias("rid")).union(sized.select(F.col("v").alias("rid"))))
        side = lambda c: signed.select(F.col("rid").alias(c), F.col("sketch").alias(f"s{c}"))
        both = sized.join(side("u"), "u").join(side("v"), "v").select("u", "v", "nu", "nv", "su", "sv")
        found = self.stored(both.mapInPandas(_may_link(self.num, self.den), "u long, v long"), "jaccard-pairs")
        self.clear("sized")
        return found

    def whole_sets(self, pairs: DataFrame) -> DataFrame:
        """(rid, held) of the nodes in ``pairs``: their sorted shingle hashes, made again from the texts.

        A bitmap of fixed size picks the texts in the scan's tasks; only the sets of these are shuffled.
        """
        wanted = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
        wanted = self.stored(self.classes.join(wanted, "node").select("d1", "d2", "h", "node"), "jaccard-wanted", "held")
        keyed = wanted.select(F.col("d1").bitwiseXOR(F.col("h")).alias("key"))
        bits = np.zeros(SET_BUCKETS * BITMAP_BITS // 8, np.uint8)
        for row in key_bitmap(keyed, "key", SET_BUCKETS).collect():  # at most SET_BUCKETS rows of 4 KiB
            bits[row["_bucket"] * 4096:(row["_bucket"] + 1) * 4096] = np.frombuffer(row["_bits"], np.uint8)
        shared, k = self.texts.sparkSession.sparkContext.broadcast(bits), self.k

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits, seen = shared.value, set()
            for batch in batches:
                rows = []
                for h, held in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), k), strict=True):
                    d1 = _signed(np.array([int(mix(held ^ U(0x5DEECE66D)).sum(dtype=U)) + len(held) & (1 << 64) - 1], U))[0]
                    place = (int(d1) ^ h) % (SET_BUCKETS * BITMAP_BITS)
                    if not len(held) or not bits[place // 8] >> place % 8 & 1:
                        continue
                    d2 = int(_signed(np.array([int(mix(held * U(0xD6E8FEB86659FD93) + U(11)).sum(dtype=U))], U))[0])
                    if (int(d1), d2, h) not in seen:  # repeated rows of one document
                        seen.add((int(d1), d2, h))
                        rows.append((int(d1), d2, h, _signed(held)))
                for start in range(0, len(rows), 64):
                    some = rows[start:start + 64]
                    ends = np.cumsum([0, *(len(r[3]) for r in some)])
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([r[i] for r in some], pa.int64()) for i in range(3)),
                         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([r[3] for r in some])))], ["d1", "d2", "h", "held"])

        made = self.texts.select("h", "text").mapInArrow(make, "d1 long, d2 long, h long, held array<long>")
        return self.stored(made.groupBy("d1", "d2", "h").agg(F.first("held").alias("held")).join(wanted, ["d1", "d2", "h"])
                      .select(F.col("node").alias("rid"), "held"), "jaccard-held", "held")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sets reach the threshold, by the intersection of their sorted arrays."""
        num, den = self.num, self.den
        held = self.whole_sets(pairs)
        side = lambda c: held.select(F.col("rid").alias(c), F.col("held").alias(f"s{c}"))

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = []
                for a, b in zip(batch.column(2), batch.column(3), strict=True):
                    a, b = a.values.to_numpy(), b.values.to_numpy()
                    if len(a) > len(b):
                        a, b = b, a
                    a, b = a.view(U), b.view(U)
                    at = np.searchsorted(b, a)
                    at[at == len(b)] = 0
                    shared = int((b[at] == a).sum())
                    good.append(den * shared >= num * (len(a) + len(b) - shared))
                yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

        both = pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "su", "sv")
        links = self.stored(both.mapInArrow(exact, "u long, v long"), "jaccard-links")
        self.clear("held")
        return links

    def components(self, links: DataFrame) -> DataFrame:
        """(node, component) of the nodes that are not the smallest of theirs; the others name themselves."""
        return stars(links, self.group).select(F.col("v").alias("node"), F.col("u").alias("component"))

    def open_tiles(self, members: DataFrame, found: DataFrame) -> DataFrame:
        """(tile, rid, part, size) of the tiles of four nodes or more that hold several components.

        The pairs of smaller tiles all have its first or last node, so they have been tested.
        """
        parts = found.select(F.col("node").alias("rid"), F.col("component").alias("part"))
        rows = members.where("size > 3").select("tile", "rid", "size").join(parts, "rid", "left").withColumn("part", F.coalesce("part", "rid"))
        self.clear("open")  # of the call before
        rows = self.stored(rows, "jaccard-parts", "parts")
        held = [F.bit_xor(F.xxhash64("rid", F.lit(i))).alias(f"x{i}") for i in range(2)]
        mixed = rows.groupBy("tile", "size").agg(F.min("part").alias("a"), F.max("part").alias("b"), *held).where("a < b")
        # tiles of the same nodes (a 128-bit digest, as for sets) are one
        mixed = mixed.groupBy("size", "x0", "x1").agg(F.min("tile").alias("tile")).select("tile")
        open_ = self.stored(rows.join(mixed, "tile"), "jaccard-open", "open")
        self.clear("parts")
        return open_

    def new_stars(self, open_: DataFrame) -> DataFrame:
        """Pairs of nodes drawn by hash in each open tile with the tile's nodes of other components.

        Every tile draws for itself, so a group that meets in many tiles is tried from many of its nodes.
        """
        drawn = [F.struct(F.xxhash64("rid", "tile", F.lit(i)).alias("at"), F.col("rid").alias("centre"), F.col("part").alias("centre_part")) for i in range(DRAWS)]
        centres = open_.groupBy("tile").agg(*(F.min(d).alias(f"d{i}") for i, d in enumerate(drawn)))
        centres = centres.select("tile", F.inline(F.array(*(F.struct(F.col(f"d{i}.centre").alias("centre"), F.col(f"d{i}.centre_part").alias("centre_part")) for i in range(DRAWS)))))
        pairs = open_.join(centres, "tile").where("part != centre_part")
        return pairs.select(F.least("centre", "rid").alias("u"), F.greatest("centre", "rid").alias("v")).distinct()

    def crossing(self, open_: DataFrame, tested: DataFrame) -> DataFrame:
        """Pairs of different components in open tiles, compared in blocks by their signatures."""
        open_ = open_.join(self.signed(open_.select("rid")), "rid")
        # a tile of many rows is dealt out to pairs of blocks
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("rid"), blocks).cast("int")
        dealt = open_.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
        low, high = F.least("own", "other"), F.greatest("own", "other")
        dealt = dealt.select(
            F.xxhash64("tile", low, high).alias("unit"), "rid", "n", "part", "sketch",
            (F.col("own") == high).cast("int").alias("side"), (F.col("own") == F.col("other")).alias("same"))
        runs = dealt.repartition("unit").sortWithinPartitions("unit")
        pairs = runs.mapInPandas(_blocks(self.num, self.den), "u long, v long").distinct()
        return self.stored(pairs.join(tested, ["u", "v"], "left_anti"), "jaccard-crossing")

    def labels(self) -> DataFrame:
        members = self.members()
        stars = members.select(F.col("lo").alias("u"), F.col("rid").alias("v")).union(members.select(F.col("rid").alias("u"), F.col("hi").alias("v")))
        tested = self.may_link(stars.where("u < v").distinct())
        found = self.components(self.linked(tested))
        open_ = self.open_tiles(members, found)
        pairs = self.may_link(self.new_stars(open_).join(tested, ["u", "v"], "left_anti"))
        if not pairs.isEmpty():
            tested = tested.union(pairs)
            links = self.linked(pairs)
            if not links.isEmpty():
                found = self.components(_edges(found).union(links))
                open_ = self.open_tiles(members, found)
        more = self.crossing(open_, tested)
        if more.isEmpty():
            return found
        return self.components(_edges(found).union(self.linked(more)))


def jaccard_groups(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles and component_id, the smallest id that links lead to.

    A document's set holds its distinct shingles of ``k`` words (case of A-Z folded); two documents link when
    intersection / union reaches ``threshold``, a fraction of whole numbers.  All links count, between texts of any
    size; no shingle, tile or candidate is left out.

    Equal sets become one node.  Nodes meet in tiles (see :func:`set_table`).  Each tile's first and last node are
    compared with its other nodes; in a group of near copies these stars usually connect nearly all of them.  Where
    they do not, because those two nodes are far from the rest, tiles draw other centres; only what still lies in
    different components of a tile is compared in blocks.  A pair's sizes, then the bits in which
    its signatures differ, bound the overlap from above; what passes is decided by the exact intersection.  So the
    work does not grow with the square of a group of copies, and every pair in a tile is linked, excluded by the
    bound, compared, or already in one component.

    Texts without words (null, empty or white space) link with nothing.  Repeated rows are copies.  Null ids come
    last.  Other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text"))
    join = _Join(texts, k, *threshold)
    labels = join.labels()
    classes = join.classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = join.stored(classes.select("d1", "d2", "component", "least_id"), "jaccard-labels")
    least = classes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = classes.join(least, "component").select("d1", "d2", F.lit(True).alias("full"), "component_id")
    rows = join.sets.select("doc_id", "n", "d1", "d2").join(named, (join.sets["d1"] == named["d1"]) & (join.sets["d2"] == named["d2"]) & (F.col("n") > 0), "left")
    component = F.when(F.col("full"), F.col("component_id")).otherwise(F.col("doc_id"))
    rows = rows.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
    rows = stored(rows, "jaccard-rows")
    join.clear()
    return rows
