"""Exact top-k search by inner product with no random access (NRA).

Candidates come in blocks. A block has one sorted list for each dimension, read from the end that a query's sign of the
dimension favours. All lists are read in step, a stretch at a time and for a block of queries at once, so that what is known of
each candidate, and what can be at most by the values where reading stands, are matrix products. Candidates that can't reach the
query's k-th best score by their upper bounds go; reading goes on until few are left, and their scores are then resolved. A
query's k-th best score is carried from block to block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Candidates and queries in a block, and bytes of candidates that a task holds: bounds of its memory.
BLOCK, QUERIES, HELD = 4096, 512, 64 << 20
#: The share of each list that is read first and at a time after, and the share of a block that may be left to resolve.
FIRST, STEP, FEW = 0.3, 1 / 6, 0.1
#: Pairs that are resolved at a time.
RESOLVED = 1 << 16
#: Stands for a null vec_id, which is the last among equal scores.
NONE = 2**63 - 1

PACKED = "block long, dim int, n int, ids binary, values binary"


def scaled(vector: list | None, scale: float) -> np.ndarray | None:
    """The whole numbers floor(scale * x), exact as doubles; None for vectors that take no part."""
    if vector is None or None in vector:
        return None
    with np.errstate(over="ignore"):
        x = np.floor(scale * np.array(vector, np.float64))
    return x if np.isfinite(x).all() else None


def _pack(size: int, scale: int):
    schema = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple[int, np.ndarray]]] = {}

        def out(dim: int) -> pa.RecordBatch:
            nonlocal count
            rows = held.pop(dim)
            count += 1
            ids = np.array([x[0] for x in rows], np.int64)
            return common.emit({"block": [part << 32 | count], "dim": [dim], "n": [len(rows)], "ids": [ids.tobytes()], "values": [np.stack([x[1] for x in rows]).tobytes()]}, schema)

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (x := scaled(v, scale)) is None:
                    continue
                held.setdefault(len(x), []).append((NONE if i is None else i, x))
                if len(held[len(x)]) >= size:
                    yield out(len(x))
        for dim in list(held):
            yield out(dim)

    return common.lean(run)


class Lists:
    """A block's vectors, and the values of each dimension from the lowest to the highest."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.x = ids, values
        self.sorted = np.sort(values, axis=0)
        self.most = float(np.abs(values).max(initial=0))
        # As single precision where its sums are exact, for queries that allow it.
        self.single = (self.x.astype(np.float32), self.sorted.astype(np.float32)) if self.most < 2**24 else None


class Best:
    """The k best of each query of a block so far: scores and ids, the best first, and how many there are."""

    def __init__(self, own: np.ndarray, queries: np.ndarray, k: int):
        self.own, self.q, self.k = own, queries, k
        self.at, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.most = np.abs(queries).max(axis=1, initial=0)
        self.share = FIRST  # of each list that most queries had to read in the block before

    def floor(self) -> np.ndarray:
        """Each query's k-th best score, as a double; minus infinity with fewer."""
        out = np.full(len(self.q), -np.inf)
        full = np.flatnonzero(np.bincount(self.at, minlength=len(self.q)) == self.k)
        out[full] = self.score[np.searchsorted(self.at, full, side="right") - 1]
        return out

    def add(self, at: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        at, score, id_ = np.r_[self.at, at], np.r_[self.score, score], np.r_[self.id, id_]
        order = np.lexsort((id_, ~score, at))  # ~score falls as score rises, at any 64-bit value
        at, score, id_ = at[order], score[order], id_[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        self.at, self.score, self.id = (x[rank < self.k] for x in (at, score, id_))


def _resolved(lists: Lists, best: Best, x: np.ndarray, at: np.ndarray, which: np.ndarray, floor: np.ndarray) -> None:
    """Adds the pairs (query, candidate) that are left, by their scores."""
    for a in range(0, len(at), RESOLVED):
        q, c = at[a : a + RESOLVED], which[a : a + RESOLVED]
        score = np.einsum("ij,ij->i", best.q[q].astype(x.dtype), x[c])
        good = (score >= floor[q]) & ((lists.ids[c] != best.own[q]) | (best.own[q] == NONE))
        best.add(q[good], score[good].astype(np.int64), lists.ids[c[good]])
        floor = np.maximum(floor, best.floor())


def search(lists: Lists, best: Best) -> None:
    """Takes a block of candidates into the k best of a block of queries.

    The lists are read to the same depth for all queries at once. A query's upper bound of a candidate is the product with what was
    read of it and, for the rest, with the values where reading stands; its lower bound that with the lists' last values instead.
    """
    n, dim = lists.x.shape
    bound = lists.most * best.most * max(1, dim)
    for i in np.flatnonzero(bound >= 2**51):  # beyond what doubles add exactly
        q, own = [int(v) for v in best.q[i]], best.own[i]
        found = [(max(-(2**63), min(2**63 - 1, sum(int(a) * b for a, b in zip(x, q, strict=True)))), int(c)) for x, c in zip(lists.x, lists.ids, strict=True) if own == NONE or c != own]
        best.add(np.full(len(found), i), np.array([s for s, _ in found], np.int64), np.array([c for _, c in found], np.int64))
    left = np.flatnonzero(bound < 2**51)
    if not len(left):
        return
    single = lists.single is not None and bound[left].max() < 2**23 and best.most[left].max() < 2**24
    x, ordered = lists.single if single else (lists.x, lists.sorted)
    high, low = (part(best.q[left], 0).astype(x.dtype) for part in (np.maximum, np.minimum))
    sides, floor = np.hstack([high, low]), best.floor()
    depth, step, half = max(1, int(n * best.share)), max(1, int(np.ceil(n * STEP))), len(left) / 2
    while True:
        top, bottom = ordered[n - depth], ordered[depth - 1]
        if (unknown := np.flatnonzero(floor[left] == -np.inf)).size and n > best.k:
            worst = np.hstack([np.where(x >= top, x, ordered[0]), np.where(x <= bottom, x, ordered[-1])])
            lower = sides[unknown] @ worst.T
            own = best.own[left][unknown]
            lower[(own[:, None] == lists.ids) & (own != NONE)[:, None]] = -np.inf
            kth = np.partition(lower, n - best.k, axis=1)[:, n - best.k]
            least = floor.copy()
            least[left[unknown]] = kth
        else:
            least = floor
        upper = sides @ np.hstack([np.maximum(x, top), np.minimum(x, bottom)]).T
        open_ = upper >= least[left, None].astype(x.dtype)
        done = np.count_nonzero(open_, axis=1) <= max(best.k, FEW * n) if depth < n else np.ones(len(left), bool)
        at, which = np.nonzero(open_[done])
        _resolved(lists, best, x, left[done][at], which, least)
        if len(left) > half >= len(left) - np.count_nonzero(done):
            best.share = depth / n
        left, sides = left[~done], sides[~done]
        if not len(left):
            return
        depth = min(n, depth + step)


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("qb", pa.int64()), ("qi", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each group its blocks of candidates come first, then blocks of queries one after the other."""
        group, held = None, []
        for batch in batches:
            for r in range(batch.num_rows):
                row = {f: batch.column(i)[r].as_py() for i, f in enumerate(batch.schema.names)}
                if row["grp"] != group:
                    group, held = row["grp"], []
                ids, values = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["values"], np.float64).reshape(row["n"], row["dim"])
                if not row["asks"]:
                    held.append(Lists(ids, values))
                    continue
                best = Best(ids, values, k)
                for lists in held:
                    search(lists, best)
                own, vec = (pa.array(x, mask=x == NONE) for x in (ids[best.at], best.id))
                yield common.emit({"query_id": own, "qb": [row["block"]] * len(own), "qi": pa.array(best.at.astype(np.int32)), "vec_id": vec, "score": pa.array(best.score)}, schema)

    return common.lean(run)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` its k highest integer inner products with `vectors`.

    Both have vec_id and embedding; each component x counts as floor(scale * x). A query's own vec_id is no candidate;
    equal scores rank by vec_id, null last; fewer candidates give fewer rows, none gives no row. Vectors take no part that are
    null or hold null or non-finite components (also those that scaling takes beyond a double); vectors of different lengths
    don't meet. Sums are exact at any size; a score beyond 64 bits counts as the nearest long. Repeated rows count each by
    itself. Other columns are ignored.

    Candidate blocks are dealt to groups, each shuffled once; every block of queries goes to each group, whose task holds
    the group's blocks and streams the queries. Each task keeps k rows for each query; these are then ranked.
    """
    pick = [F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")]
    cand = common.stored(vectors.select(*pick).mapInArrow(_pack(BLOCK, scale), PACKED))
    spark = vectors.sparkSession
    asked = queries.select(*pick)
    packed = common.stored(asked.repartition(max(1, -(-asked.count() // QUERIES))).mapInArrow(_pack(QUERIES, scale), PACKED))
    shape = cand.agg(F.count("*").alias("blocks"), F.sum(F.octet_length("values")).alias("bytes")).first()
    groups = max(1, -(-(shape["bytes"] or 0) // HELD), min(shape["blocks"], spark.sparkContext.defaultParallelism))
    there = common.numbered(cand.withColumn("one", F.lit(0).cast("long")), "one", "nr").withColumn("grp", F.pmod("nr", F.lit(groups))).drop("one", "nr")
    there = common.stored(there)
    names = there.select("grp", "dim").distinct()
    asks = packed.join(names, "dim").select("grp", F.lit(True).alias("asks"), "block", "dim", "n", "ids", "values")
    met = (
        there.select("grp", F.lit(False).alias("asks"), "block", "dim", "n", "ids", "values").union(asks)
        .withColumn("grp", F.struct("grp", "dim")).repartition(groups, "grp").sortWithinPartitions("grp", "asks", "block")
        .withColumn("grp", F.xxhash64("grp"))
    )
    found = met.mapInArrow(_search(k), "query_id long, qb long, qi int, vec_id long, score long")
    order = Window.partitionBy("qb", "qi").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
