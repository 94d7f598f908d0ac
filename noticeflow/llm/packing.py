"""Best-fit packing by patterns: which few lengths fill a sequence, and how often, by non-negative least squares.

Only the histogram of lengths (one number for each length below the sequence's) reaches the driver. Patterns of two and
three documents that fill a sequence exactly are fitted to it, their counts rounded down, and what is left is packed
best-fit from the longest on. Ranks of documents among those of their length then lead to the places that the plan has.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens


def patterns(size: int) -> np.ndarray:
    """All pairs and triples of lengths that add up to `size`; (pattern, 3), a pair with 0 as its third length."""
    a, b = np.triu_indices(size)
    a, b = a + 1, b + 1
    c = size - a - b
    keep = (c >= b) & (c < size)
    pairs = np.arange(1, size // 2 + 1)
    return np.concatenate([np.c_[a[keep], b[keep], c[keep]], np.c_[pairs, size - pairs, 0 * pairs]]).astype(np.int64)


def fit(rows: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts w >= 0 of the patterns, least squares to the histogram, by accelerated projected gradients.

    histogram[0] is ignored. Each pattern's step is scaled by how many patterns its lengths are in.
    """
    size = len(histogram)
    h = histogram.astype(float)
    h[0] = 0

    def fitted(w: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(rows[:, j], weights=w, minlength=size) for j in range(3))
        out[0] = 0
        return out

    crowd = fitted(np.ones(len(rows)))
    crowd[0] = 0
    step = 1 / np.maximum(1, crowd[rows].sum(axis=1))
    w = np.zeros(len(rows))
    y, t = w, 1.0
    for _ in range(rounds):
        gap = h - fitted(y)
        gap[0] = 0
        new = np.maximum(0, y + step * gap[rows].sum(axis=1))
        if float(((y - new) * (new - w)).sum()) > 0:  # momentum points uphill
            t = 1.0
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / after * (new - w)
        w, t = new, after
    return w


def best_fit(histogram: np.ndarray, size: int) -> Counter:
    """Best-fit decreasing over a histogram: how often each tuple of lengths is packed."""
    rooms: dict[int, Counter] = defaultdict(Counter)
    for length in range(size, 0, -1):
        left = int(histogram[length])
        while left:
            room = next((r for r in range(length, size) if rooms.get(r)), None)
            if room is None:
                each = size // length
                for n, count in ((each, left // each), (left % each, 1)):
                    if n and count:
                        rooms[size - n * length][(length,) * n] += count
                break
            have, count = rooms[room].popitem()
            use = min(left, count)
            if count > use:
                rooms[room][have] = count - use
            rooms[room - length][(*have, length)] += use
            left -= use
    out: Counter = Counter()
    for found in rooms.values():
        out.update(found)
    return out


def plan(histogram: np.ndarray, size: int, rounds: int = 400) -> Counter:
    """How often each tuple of lengths is packed, for histogram[length] documents of each length from 1 to `size`."""
    left = histogram.astype(np.int64).copy()
    out: Counter = Counter()
    if left[size]:
        out[(size,)] = int(left[size])
        left[size] = 0
    if size >= 2 and left[1:].sum():
        rows = patterns(size)
        rows = rows[(left[rows] > 0)[:, :2].all(axis=1) & ((rows[:, 2] == 0) | (left[rows[:, 2]] > 0))]
        counts = np.floor(fit(rows, left[:size] if size < len(left) else left, rounds) + 1e-9).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
        for k in np.argsort(-counts, kind="stable"):
            if not counts[k]:
                break
            need = Counter(int(x) for x in rows[k] if x)
            n = min(int(counts[k]), *(int(left[x]) // m for x, m in need.items()))
            if n:
                out[tuple(sorted(need.elements(), reverse=True))] += n
                for x, m in need.items():
                    left[x] -= n * m
    out.update(best_fit(left, size))
    return out


def places(packed: Counter, size: int) -> dict[str, np.ndarray]:
    """For the documents of each length, in order: until which rank (`upto`) they go where; sorted by length and rank."""
    rows: list[tuple[int, ...]] = []
    used: Counter = Counter()
    sequence = 0
    for lengths, count in packed.items():
        offset = 0
        for x in lengths:
            rows.append((x, used[x], sequence, offset))
            used[x] += count
            offset += x
        sequence += count
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, size: int, end: int | None):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.Encoder.of(path)
        for whole in batches:
            for batch in common.by_bytes(whole, "text", tokens.BATCH):
                out: list[list] = [[], [], [], [], []]
                for doc, data in zip(batch.column(0).to_pylist(), encoder.encode(common.strings(batch.column(1))), strict=True):
                    if end is not None:
                        data.append(end)
                    if sys.byteorder == "big":
                        data.byteswap()
                    first = len(data) % size or min(size, len(data))
                    bounds = [0, *range(first, len(data) + 1, size)] if len(data) else []
                    raw = memoryview(data.tobytes())
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        for column, x in zip(out, (doc, k, a, b - a, zlib.crc32(raw[4 * a : 4 * b])), strict=True):
                            column.append(x)
                yield common.emit(dict(zip(schema.names, out, strict=True)), schema)

    return common.lean(run)


def pieces(docs: DataFrame, path: str, size: int = 1024, end: int | None = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut into pieces of `size` ids.

    The first piece takes what is over, so that all others are full. A null text counts as empty.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_cut(path, size, end), _PIECES)


def _place(table: dict[str, np.ndarray], ranks: int):
    keys = table["length"] * ranks + table["rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            rank = column["rank"].to_numpy()
            at = np.searchsorted(keys, column["length"].to_numpy() * ranks + rank, side="right") - 1
            sequence = table["sequence"][at] + rank - table["rank"][at]
            kept = [column[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch([*kept, pa.array(sequence), pa.array(table["offset"][at])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return common.lean(run)


def pack(docs: DataFrame, path: str, size: int = 1024, end: int | None = 2, rounds: int = 400) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): where each piece of each document is packed.

    Only documents of more than `size` ids (with the end id) are cut. Sequences hold `size` ids at most and have no gaps.
    Null and empty texts are the end id alone (with `end=None` they have no piece). Null doc_ids and repeated rows are packed
    like others; an empty table gives no rows; other columns are ignored.
    """
    cut = common.stored(pieces(docs, path, size, end))  # written first, lest each task keeps a second worker
    cut = common.numbered(cut, "length", "rank")
    cut = common.stored(cut)
    histogram = np.zeros(size + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():  # `size` rows at most
        histogram[length] = n
    table = places(plan(histogram, size, rounds), size)
    return cut.mapInArrow(_place(table, int(histogram.max()) + 1), _PIECES + ", sequence_id long, offset long")
