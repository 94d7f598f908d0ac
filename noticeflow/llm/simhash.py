"""SimHash near-dedup through deletion-variant signatures.

A 64-bit fingerprint is cut into so few segments that of two fingerprints within `bits` bits, one segment differs by
one bit at most. Each fingerprint is indexed under every segment with one bit struck out (64 keys in all), so that an
equality join on these keys finds all pairs; the distance of each is then verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, passages

#: Shingles hashed at a time.
CHUNK = 1 << 16
#: Runs of one key up to this length are compared pair by pair; longer ones are linked through a spanning forest.
PAIRS = 8
#: Rows of one key that a task holds; of a key with more the fingerprints meet under finer keys.
LARGE = 1 << 16


def fingerprint(features: list[bytes], seed: int = 42) -> int:
    """Majority bits of the XXH64 of all features; zero without features."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(features), CHUNK):
        part = features[k : k + CHUNK]
        h = np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in part), np.dtype(">u8"), len(part))
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(features)).tobytes(), "big")


def wide(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """(set, bits / 64): fingerprints of as many bits of sets of hashes, each the majority of another function; zero without members."""
    sizes = np.array([len(x) for x in sets], np.int64)
    out, some = np.zeros((len(sets), bits), bool), np.flatnonzero(sizes)
    if len(some):
        h, n = np.concatenate([sets[k] for k in some]), sizes[some]
        parts = -(-n // 255)  # eight counts in the bytes of a number, of 255 members at most
        first = np.cumsum(parts) - parts
        starts = np.repeat(np.cumsum(n) - n, parts) + 255 * (np.arange(int(parts.sum())) - np.repeat(first, parts))
        for k in range(bits // 8):
            g = passages.mix(h, 1000 + k // 8) if k % 8 == 0 else g  # noqa: F821
            counts = np.add.reduceat((g >> np.uint64(k % 8)) & np.uint64(0x0101010101010101), starts).view(np.uint8).reshape(-1, 8)
            out[some, 8 * k : 8 * k + 8] = 2 * np.add.reduceat(counts, first, axis=0, dtype=np.int64) > n[:, None]
    return np.packbits(out, axis=1).view(np.int64)


def shingles(words: list[bytes], n: int) -> list[bytes]:
    """All n-word shingles in order, repeats included; of fewer words the whole sequence."""
    if len(words) <= n:
        return [b" ".join(words)] if words else []
    return [b" ".join(x) for x in zip(*(words[i:] for i in range(n)), strict=False)]


def _features(text: bytes, n: int) -> list[bytes]:
    words = text.lower().split()
    return shingles(words, n) if n else list(set(words))


def _fingerprints(n: int, seed: int = 42):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.by_bytes(whole, "text"):
                known: dict[bytes, int] = {}
                out = []
                for text in common.utf8(batch.column(1)):
                    if text not in known:
                        fp = fingerprint(_features(text, n), seed)
                        known[text] = fp - (1 << 64) if fp >> 63 else fp
                    out.append(known[text])
                yield common.emit({"doc_id": batch.column(0), "fp": out}, schema)

    return common.lean(run)


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): signed 64-bit SimHash of the lower-cased (A-Z) text's word shingles; `shingle=0` takes distinct words.

    Null and blank texts get 0. Other columns of `docs` are ignored, whatever their names.
    """
    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return picked.mapInArrow(_fingerprints(shingle, seed), "doc_id long, fp long")


def segments(bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one differs by one bit at most, given `bits` differences."""
    if not 0 <= bits <= 30:
        raise ValueError("bits must be from 0 to 30")
    n = bits // 2 + 1
    cuts = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _variants(bits: int):
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
    parts = segments(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 8192):
                fp = batch.column(0)[k : k + 8192].to_numpy(zero_copy_only=False).view(np.uint64)
                keys = np.empty((64, len(fp)), np.uint64)
                for at, width in parts:
                    value = (fp >> np.uint64(at)) & np.uint64((1 << width) - 1)
                    for i in range(width):  # a segment without its bit i, and which segment and bit that is
                        low = value & np.uint64((1 << i) - 1)
                        rest = (value >> np.uint64(i + 1)) << np.uint64(i) if i < 63 else np.uint64(0)
                        keys[at + i] = (low | rest) if width == 64 else (low | rest) | np.uint64((at + i) << 56)
                        if width == 64:
                            keys[at + i] ^= np.uint64(xxhash.xxh64_intdigest(bytes([i]), 42))
                yield common.emit({"key": pa.array(keys.ravel().view(np.int64)), "fp": pa.array(np.tile(fp, 64).view(np.int64))}, schema)

    return common.lean(run)


def spanning(fp: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges (positions) of a forest with the same components as all pairs within `bits` bits."""
    edges, left = [], np.arange(1, len(fp))
    queue = [0]
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
            continue
        at = queue.pop()
        near = np.bitwise_count(fp[left] ^ fp[at]) <= bits
        found = left[near]
        edges += [(at, int(x)) for x in found]
        queue += found.tolist()
        left = left[~near]
    return edges


def _finer(key: int, fp: np.ndarray, bits: int) -> np.ndarray:
    """(bits + 1, fingerprint): keys of which two fingerprints of one key within `bits` bits share one at least.

    The bits outside the key's segment are cut into as many parts: one of them is the same in both.
    """
    place = key >> 56 & 63
    at, width = next((a, w) for a, w in segments(bits) if a <= place < a + w)
    rest = np.array([i for i in range(64) if not at <= i < at + width], np.uint64)
    out = np.empty((bits + 1, len(fp)), np.uint64)
    for k, part in enumerate(np.array_split(rest, bits + 1)):
        mask = np.uint64(sum(1 << int(i) for i in part))
        salt = np.uint64(xxhash.xxh64_intdigest(f"{key} {k}".encode(), 42))
        out[k] = passages.mix((fp & mask) ^ salt, 3)
    return out


#: Of a row: kind 0 is a link (a, b), kind 1 a fingerprint b under the finer key a.
_FOUND = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])


def _bounded_runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """(whether it is part of a key with more than `most` rows, or a batch more, rows): other rows come in whole runs of their key."""
    held: list[pa.RecordBatch] = []  # rows of the last key so far
    large = None
    whole = lambda parts: pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    for batch in batches:
        keys = batch.column(0).to_numpy()
        if large is not None and len(keys):
            others = np.flatnonzero(keys != large)
            lead = int(others[0]) if len(others) else len(keys)
            if lead:
                yield True, batch.slice(0, lead)
            batch, keys = batch.slice(lead), keys[lead:]
        if not len(keys):
            continue
        large = None
        others = np.flatnonzero(keys != keys[-1])
        last = int(others[-1]) + 1 if len(others) else 0
        if not last and (not held or held[0].column(0)[0].as_py() == keys[0]):
            held.append(batch)
        else:
            if done := [*held, batch.slice(0, last)] if last else held:
                yield False, whole(done)
            held = [batch.slice(last)]
        if sum(x.num_rows for x in held) > most:
            for x in held:
                yield True, x
            held, large = [], keys[-1]
    if held:
        yield False, whole(held)


def _links(bits: int, pairs: int, most: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _bounded_runs(batches, most) if most else ((False, x) for x in common.runs(batches, "key"))
        for large, batch in runs:
            key = batch.column(0).to_numpy()
            fp = batch.column(1).to_numpy().view(np.uint64)
            if large:
                finer = _finer(int(key[0]) & (2**64 - 1), fp, bits)
                yield common.emit({"kind": pa.array(np.ones(finer.size, np.int32)), "a": pa.array(finer.ravel().view(np.int64)), "b": pa.array(np.tile(fp, bits + 1).view(np.int64))}, _FOUND)
                continue
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            a, b = [], []
            small = np.repeat(sizes <= pairs, sizes)
            for step in range(1, min(pairs, int(sizes.max()))):
                at = np.flatnonzero((key[step:] == key[:-step]) & small[step:])
                at = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= bits]
                a.append(fp[at])
                b.append(fp[at + step])
            for start, size in zip(starts[sizes > pairs], sizes[sizes > pairs], strict=True):
                if found := spanning(run_fp := fp[start : start + size], bits):
                    found = np.array(found)
                    a.append(run_fp[found[:, 0]])
                    b.append(run_fp[found[:, 1]])
            if a and len(both := np.unique(np.c_[np.concatenate(a), np.concatenate(b)], axis=0)):
                yield common.emit({"kind": pa.array(np.zeros(len(both), np.int32)), "a": pa.array(both[:, 0].copy().view(np.int64)), "b": pa.array(both[:, 1].copy().view(np.int64))}, _FOUND)

    return common.lean(run)


def links(fps: DataFrame, bits: int = 2, pairs: int = PAIRS) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp` at `bits` or fewer differing bits.

    All linked pairs that share a key with fewer than `pairs` others are there; of larger groups a spanning forest, so
    the components are those of all pairs. Rows: 64 keys for each distinct fingerprint, in one shuffle. Fingerprints of a key
    that more than LARGE of them have are dealt anew by finer keys, so that no task holds them all.
    """
    index = fps.where("fp is not null").select("fp").distinct().mapInArrow(_variants(bits), "key long, fp long")
    ordered = index.repartition("key").sortWithinPartitions("key", "fp")
    shape = "kind int, a long, b long"
    first = common.stored(ordered.mapInArrow(_links(bits, pairs, LARGE), shape))
    finer = first.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    out = first.where("kind = 0")
    if not finer.isEmpty():
        out = out.union(finer.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_links(bits, pairs, None), shape))
    return out.select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id, component_size) for every row of `docs`.

    component_id is the smallest doc_id whose fingerprint is reachable over links of at most `bits` bits. Null and blank
    texts have fingerprint zero and are linked like any other. A null doc_id gets its group's component_id (null if the
    group has no other). Repeated rows stay; an empty table gives no rows.
    """
    fps = common.stored(fingerprints(docs, shingle))
    groups = fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    roots = common.components(links(fps, bits)).select(F.col("node").alias("fp"), "root")
    named = groups.join(roots, "fp", "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    classes = named.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("component_size"))
    labels = common.stored(named.join(classes, "root").select("fp", "component_id", "component_size"))
    return fps.join(labels, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component_size"
    )
