"""Nearest neighbours by multiprobe p-stable hashing with exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.llm.common import stored
from logwarden.llm.shingles import U, mix

#: Hash tables, and functions of each: more functions make smaller buckets, of which more must be visited (at most 3 to
#: their power).
TABLES, FUNCTIONS = 4, 4
#: Rows looked at to choose the number of probes, and the share of true neighbours these must find among them.
SAMPLE_ROWS, SAMPLE_QUERIES, TARGET = 2000, 100, 0.95
#: Rows of a bucket that are scored in one piece; a larger bucket is dealt out to several tasks.
PIECE = 4096


class Hashes(NamedTuple):
    """Tables of ``m`` functions floor((a x + b) / width) over vectors made longer by one component.

    With sqrt(limit² - |x|²) as the extra component of a row and 0 of a query, the nearest rows by distance are those
    of the largest inner product.
    """

    a: np.ndarray  # tables, m, dimension + 1
    b: np.ndarray  # tables, m
    width: float
    limit: float

    def project(self, x: np.ndarray, query: bool) -> np.ndarray:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.limit**2 - (x**2).sum(axis=1), 0))
        longer = np.concatenate([x, extra[:, None]], axis=1)
        return (np.einsum("nd,tmd->tnm", longer, self.a) + self.b[:, None, :]) / self.width

    def cells(self, table: int, buckets: np.ndarray) -> np.ndarray:
        """One number for each row of bucket coordinates."""
        out = np.full(buckets.shape[:-1], U(table + 1))
        for i in range(buckets.shape[-1]):
            out = mix(out * U(0x9E3779B97F4A7C15) + buckets[..., i].astype(np.int64).view(U))
        return out.view(np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables): the bucket of each row in each table."""
        at = np.floor(self.project(x, query=False))
        return np.stack([self.cells(t, at[t]) for t in range(len(at))], axis=1)

    def probes(self, x: np.ndarray, count: int) -> np.ndarray:
        """(queries, tables x count): the buckets most likely to hold near rows.

        A step to a neighbouring bucket in one function costs the squared distance to that side; the buckets with the
        smallest sums come first, the query's own, at no cost, before all.
        """
        at, out = self.project(x, query=True), []
        which = np.array(list(product(range(3), repeat=at.shape[2])))
        steps = np.array([0, -1, 1])[which]
        for t in range(len(at)):
            low = np.floor(at[t])
            inside = at[t] - low
            costs = np.stack([np.zeros_like(inside), inside**2, (1 - inside) ** 2], axis=2)  # for 0, -1 and 1
            total = np.zeros((len(x), len(steps)))
            for i in range(at.shape[2]):
                total += costs[:, i, which[:, i]]
            best = np.argsort(total, axis=1, kind="stable")[:, :count]
            out.append(self.cells(t, low[:, None, :] + steps[best]))
        return np.concatenate(out, axis=1)


def make_hashes(dimension: int, functions: int, limit: float, tables: int = TABLES, width: float = 2.0, seed: int = 7) -> Hashes:
    rng = np.random.default_rng(seed)
    width *= limit
    return Hashes(rng.standard_normal((tables, functions, dimension + 1)), rng.random((tables, functions)) * width, width, limit)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def choose(rows: np.ndarray, queries: np.ndarray, functions: int, k: int, limit: float) -> tuple[Hashes, int]:
    """Tables of ``functions`` hash functions, and the fewest probes that find TARGET of the sample's true neighbours.

    If not even all neighbouring buckets reach the target, fewer functions.  The full table has nearer neighbours than
    the sample, so its recall is higher.
    """
    scores = queries @ rows.T
    true = np.argsort(-scores, axis=1, kind="stable")[:, :k + 1]
    while True:
        hashes = make_hashes(rows.shape[1], functions, limit)
        cells, probes = hashes.rows(rows), hashes.probes(queries, 3**functions).reshape(len(queries), TABLES, -1)
        best = []  # in how many probes each true neighbour is found
        for q in range(len(queries)):
            order = np.full(k + 1, np.inf)[:true.shape[1]]
            for t in range(TABLES):
                hit = probes[q, t][None, :] == cells[true[q], t][:, None]
                order = np.minimum(order, np.where(hit.any(axis=1), hit.argmax(axis=1), np.inf))
            best.append(order)
        found = np.sort(np.concatenate(best)) if best else np.zeros(1)
        need = found[min(int(np.ceil(TARGET * len(found))), len(found)) - 1]
        if np.isfinite(need) or functions == 1:
            return hashes, int(need) + 1 if np.isfinite(need) else 3**functions
        functions -= 1


def _cells_of(hashes: Hashes, probes: int | None):
    """Rows (cell, id) for the index, or for queries when ``probes`` is given, with the vector."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                x = _matrix(batch.column(1))
                cells = hashes.rows(x) if probes is None else hashes.probes(x, probes)
                at = np.repeat(np.arange(len(x)), cells.shape[1])
                for piece in range(0, len(at), 8192):
                    take = pa.array(at[piece:piece + 8192])
                    yield pa.RecordBatch.from_arrays([pa.array(cells.reshape(-1)[piece:piece + 8192]), batch.column(0).take(take), batch.column(1).take(take)], ["cell", "id", "x"])

    return deal


def _score(k: int):
    """The ``k`` best rows for each query of each unit, from rows sorted by unit with the queries first."""

    def best_of(queries: list, rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, v = np.stack([x for _, x in queries]), np.stack([x for _, x in rows])
        qid, vid = np.array([i for i, _ in queries]), np.array([i for i, _ in rows])
        scores = q @ v.T
        least = np.full(len(q), -np.inf)
        if len(rows) > k:
            # a matrix product rounds in another order than the final sums: all rows that may tie with the k-th are looked at
            margin = 1e-12 * np.linalg.norm(q, axis=1) * np.linalg.norm(v, axis=1).max()
            least = -np.partition(-scores, k - 1, axis=1)[:, k - 1] - margin
        at, to = np.nonzero(scores >= least[:, None])
        exact = np.concatenate([(q[at[i:i + 8192]] * v[to[i:i + 8192]]).sum(axis=1) for i in range(0, len(at), 8192)])
        order = np.lexsort((vid[to], -exact, at))
        at, to, exact = at[order], to[order], exact[order]
        first = np.searchsorted(at, np.arange(len(q)))
        kept = np.arange(len(at)) - first[at] < k
        return qid[at[kept]], vid[to[kept]], exact[kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, queries, rows = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if queries and rows:
                for start in range(0, len(queries), 256):
                    found = best_of(queries[start:start + 256], rows)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["q", "v", "score"])
            rows.clear()

        for batch in batches:
            units, kinds, ids = (batch.column(i).to_numpy() for i in range(3))
            x = _matrix(batch.column(3))
            for i in range(len(units)):
                if units[i] != unit:
                    yield from flush()
                    unit = units[i]
                    queries = []
                if kinds[i] == 0:
                    queries.append((ids[i], x[i]))
                elif queries:
                    rows.append((ids[i], x[i]))
                    if len(rows) >= PIECE:
                        yield from flush()
        yield from flush()

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", functions: int = FUNCTIONS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product found for every query.

    Queries are the rows for which ``is_query`` holds; a query's own row is no candidate.  Each row lies in one bucket of
    every table; a query asks for the buckets most likely to hold its neighbours (:meth:`Hashes.probes`).  How many
    is chosen on a sample of a fixed size; every row is indexed.  Whatever the tables give is scored exactly in double precision
    on the original vectors.  Equal scores go to the smaller id.

    Equal vectors are one entry with its k + 1 smallest ids, which is all that any result can hold, so a vector that
    fills a third of the table costs no more than another.  Buckets are never cut: one with many rows is dealt out
    to several tasks.

    Null vectors, zero vectors, vectors with a null or non-finite component, of another length than the most frequent
    one, or with a null id take no part.  Rows with equal id and vector count once.  Other columns are not read.
    """
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    valid = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(fine).select(
        F.col(id_col).alias("id"), F.transform(x, lambda c: c + 0.0).alias("x"), is_query.alias("asks"))
    sizes = valid.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], schema)
    valid = stored(valid.where(F.size("x") == sizes["size"]), "ann-valid")
    # the smallest ids of each vector; the limit per task comes before the shuffle
    first = valid.select("id", "x").distinct().withColumn("_n", F.row_number().over(Window.partitionBy("x").orderBy("id"))).where(F.col("_n") <= k + 1)
    entries = stored(first.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("id"), "x", "ids"), "ann-entries")
    asking = stored(valid.where("asks").select("x", F.col("id").alias("query_id")).distinct().join(entries.select("x", F.col("id").alias("q")), "x"), "ann-queries")
    wanted = stored(asking.select("q", "x").dropDuplicates(["q"]), "ann-asked")

    facts = entries.agg(F.count("*"), F.max(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c))).first()
    take = lambda df, n, total: [r["x"] for r in df.select("x").where(F.pmod(F.xxhash64("x", F.lit(3)), F.lit(1 << 30)) < int(min(1.0, n / max(total, 1)) * (1 << 30))).limit(2 * n).collect()]
    rows = np.array(take(entries, SAMPLE_ROWS, facts[0])).reshape(-1, sizes["size"])
    queries = np.array(take(wanted, SAMPLE_QUERIES, wanted.count())).reshape(-1, sizes["size"])
    hashes, probes = choose(rows, queries, functions, k, float(np.sqrt(facts[1])))

    made = "cell long, id long, x array<double>"
    index = entries.select("id", "x").mapInArrow(_cells_of(hashes, None), made)
    asked = wanted.select("q", "x").mapInArrow(_cells_of(hashes, probes), made)
    large = stored(index.groupBy("cell").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces")).where("pieces > 1"), "ann-large")
    piece = F.coalesce("pieces", F.lit(1))
    index = index.join(large, "cell", "left").select(F.xxhash64("cell", F.pmod(F.xxhash64("id"), piece).cast("int")).alias("unit"), F.lit(1).alias("kind"), "id", "x")
    asked = asked.join(large, "cell", "left").select("cell", "id", "x", F.explode(F.sequence(F.lit(0), piece - 1)).alias("_p")).select(
        F.xxhash64("cell", "_p").alias("unit"), F.lit(0).alias("kind"), "id", "x")
    units = index.union(asked).repartition("unit").sortWithinPartitions("unit", "kind")
    scored = units.mapInArrow(_score(k + 1), "q long, v long, score double").groupBy("q", "v").agg(F.max("score").alias("score"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "v")
    scored = scored.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).select("q", "v", "score")
    # entries back to ids, k + 1 for each asked vector, then the query's own row leaves
    ids = scored.join(entries.select(F.col("id").alias("v"), "ids"), "v").select("q", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ids = ids.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).drop("_n")
    answers = asking.select("q", "query_id").join(stored(ids, "ann-ids"), "q").where("query_id != vec_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
