"""Shared pieces: tables in the shared folder, word splitting, Arrow helpers and connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Everything that separates words; `bytes.split()` splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a Python operator yields at a time.
OUT_ROWS = 4096


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: `spark.checkpoint.dir`.

    Where it isn't set, a session of one machine (master local) gets a temporary folder; on a cluster there is nowhere to write.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not found:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = getattr(context, "_noticeflow_shared", None)
        if found is None:
            found = context._noticeflow_shared = "file://" + tempfile.mkdtemp(prefix="noticeflow-")
    return found.rstrip("/") + "/noticeflow"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, Python gets at most TEXT_ROWS rows at a time; the session's own setting comes back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    if not 0 < int(was) <= TEXT_ROWS:
        spark.conf.set(name, str(TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, was)


#: The tables that were written on the way to what `settled` is making in this thread (or task), if it is making anything.
_made: ContextVar[list[Stored] | None] = ContextVar("made", default=None)


class Stored:
    """A table written to the shared folder, so that a lost executor costs no recomputation of what made it."""

    def __init__(self, df: DataFrame):
        self.spark, self.path = df.sparkSession, f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
        with small_batches(self.spark):
            df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        if (made := _made.get()) is not None:
            made.append(self)

    def drop(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        if (made := _made.get()) and self in made:
            made.remove(self)


def stored(df: DataFrame) -> DataFrame:
    return Stored(df).df


def settled(build: Callable[[], DataFrame]) -> DataFrame:
    """What `build` returns, written down; the tables that were written on the way to it go, also if it fails. What other threads
    write meanwhile stays."""
    own: list[Stored] = []
    outer, out = _made.set(own), None
    try:
        out = Stored(build())
    finally:
        _made.reset(outer)
        for table in own:
            if table is not out:
                table.drop()
    if (made := _made.get()) is not None:
        made.append(out)
    return out.df


def small(spark: SparkSession, columns: dict[str, tuple[pa.DataType, list]]) -> DataFrame:
    """A small table of the driver's, made without a job, to be broadcast."""
    return F.broadcast(spark.createDataFrame(pa.table({n: pa.array(v, t) for n, (t, v) in columns.items()})))


def clean(spark: SparkSession) -> None:
    """Deletes all tables that operators wrote to the shared folder; frames that were made from them can't be read after.

    An operator's result is a lazy frame over such tables: a long session calls this between one use and the next.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as bytes; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """The texts of an Arrow string column; null counts as empty, bytes that are no UTF-8 as replacement characters."""
    try:
        return [x or "" for x in column.to_pylist()]
    except UnicodeDecodeError:
        return [x.decode("utf-8", "replace") for x in utf8(column)]


def by_bytes(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each piece has about `most` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_pylist()
    start = held = 0
    for k, size in enumerate(sizes):
        if k > start and held + size > most:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += size
    yield batch.slice(start)


def emit(columns: dict[str, list | pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip((columns[f.name] for f in schema), schema, strict=True)], schema=schema)


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Regroups sorted batches so that no run of one key is cut in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key))
        last = keys[len(keys) - 1]
        if held and held[-1].column(batch.schema.get_field_index(key))[held[-1].num_rows - 1] != keys[0]:
            yield _joined(held)
            held = []
        if keys[0] == last:
            held.append(batch)
            continue
        cut = pc.index(pc.equal(keys, last), True).as_py()
        held.append(batch.slice(0, cut))
        yield _joined(held)
        held = [batch.slice(cut)]
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    table = pa.Table.from_batches(batches).combine_chunks()
    return table.to_batches()[0]


#: Bits of the bitmaps by which rows are told apart before a join; their size doesn't depend on the data.
BITMAP = 1 << 26
#: Rows that go to Python at a time where a table is written; Spark's own bound in bytes holds as well.
TEXT_ROWS = 2000


def bitmap(hashes: DataFrame) -> DataFrame:
    """(bucket, bits): which of BITMAP numbers the 64-bit hashes in the only column of `hashes` take; 8 MB at most."""
    bit = F.col(hashes.columns[0]).bitwiseAND(F.lit(BITMAP - 1)) + 1
    return hashes.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))


def maybe_in(df: DataFrame, h: str, bits: DataFrame, name: str) -> DataFrame:
    """Adds the boolean `name`: false only where the hash in column `h` is certainly not in the bitmap. Nothing is shuffled."""
    bit = F.col(h).bitwiseAND(F.lit(BITMAP - 1)) + 1
    known = F.broadcast(bits.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits")))  # of a fixed size
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substr(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    out = df.withColumn("_b", F.bitmap_bucket_number(bit)).join(known, F.col("_b") == F.col("_bucket"), "left")
    return out.withColumn(name, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("_b", "_bucket", "_bits")


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same operator on batches, which gives back to the system what memory it had; a worker lives on after its task."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # not every system's library can
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def _local_ranks(group: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(group)).to_numpy(zero_copy_only=False)
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, np.int64)
            sizes = np.diff(np.r_[starts, len(keys)])
            base = np.array([seen.get(k, 0) for k in ordered[starts].tolist()], np.int64)
            ranks = np.empty(len(keys), np.int64)
            ranks[order] = np.arange(len(keys)) + np.repeat(base - starts, sizes)
            seen.update(zip(ordered[starts].tolist(), (base + sizes).tolist(), strict=True))
            yield pa.record_batch([*batch.columns, pa.array(np.full(len(keys), part, np.int32)), pa.array(ranks)], names=[*batch.schema.names, "part_", "local_"])

    return lean(run)


def numbered(df: DataFrame, group: str, name: str) -> DataFrame:
    """Adds `name`: numbers from 0 without gaps within each value of the long column `group` (not null), in no given order.

    Rows are counted where they lie and written down; each part of the table then starts at the sum of the parts before it,
    so that no group comes together in one task, however large it is.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("part_", T.IntegerType()), T.StructField("local_", T.LongType())])
    kept = stored(df.mapInArrow(_local_ranks(group), schema))
    counts = kept.groupBy(group, "part_").agg(F.count("*").alias("n_"))
    before = Window.partitionBy(group).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "part_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("start_"))
    return kept.join(starts, [group, "part_"]).withColumn(name, F.col("start_") + F.col("local_")).drop("part_", "local_", "start_")


#: Edges of a node from which on it is a centre, and how many centres there are at most.
CENTRE, CENTRES = 1000, 40_000


def _with_least(rows: DataFrame, least: DataFrame, edges: int, most: int) -> DataFrame:
    """rows (u, v) with the m of their u from least (u, m, n), n being the edges of u.

    The edges of a centre would meet in one task: its m goes to where they lie. Centres have so many edges that there can't
    be more than CENTRES of them, which bounds what is broadcast. No node has more than `most` edges.
    """
    many = max(CENTRE, 2 * edges // CENTRES)
    if most <= many:
        return rows.join(least.select("u", "m"), "u").select("u", "v", "m")
    centres = F.broadcast(least.where(F.col("n") > many).select("u", F.col("m").alias("cm")))
    marked = rows.join(centres, "u", "left")
    others = marked.where("cm is null").select("u", "v").join(least.where(F.col("n") <= many).select("u", "m"), "u")
    return others.select("u", "v", "m").union(marked.where("cm is not null").select("u", "v", F.col("cm").alias("m")))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has an edge (a, b).

    Alternates large-star and small-star rounds, each written to the shared folder, until the edges stay the same. A node of
    very many edges is not gathered in one task. Nulls and loops are ignored; without edges the result is empty.
    """
    now = Stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    nodes = now
    seen = _state(now.df)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        both = now.df.union(now.df.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = _with_least(both.where("v > u"), least, *seen[::2]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _with_least(large, low, *seen[::2])  # no node has more edges to lower ones than it had before
        after = Stored(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        was, seen = seen, _state(after.df)
        if now is not nodes:
            now.drop()
        now = after
        if seen == was:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    found = now.df.groupBy("u").agg(F.min("v").alias("v"))
    roots = found.select(F.col("v").alias("u"), "v").distinct()
    return found.union(roots).select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(df: DataFrame) -> tuple[int, int, int]:
    """Twice the number of edges, a hash of them all, and the most edges of a node."""
    ends = df.select("u", F.xxhash64("u", "v").alias("h")).union(df.select("v", F.lit(0).cast("long")))
    each = ends.groupBy("u").agg(F.count("*").alias("n"), F.bit_xor("h").alias("h"))
    n, h, most = each.agg(F.sum("n"), F.bit_xor("h"), F.max("n")).first()
    return n or 0, h or 0, most or 0


#: Texts whose 64-bit hash another text has as well: at 10^10 texts a handful are to be expected.
CLASHES = 1000


def text_hash(docs: DataFrame) -> Column:
    """A 64-bit number of the column `text` (null counts as empty) that no two different texts of `docs` share.

    It is the text's hash, unless a second, independent one tells that different texts have the same: those get a number
    from both. Two texts are taken for one only if they agree in 128 bits.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    first, second = F.xxhash64(text), F.xxhash64(F.lit("second"), text)
    each = docs.select(first.alias("h"), second.alias("g")).groupBy("h").agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
    clashes = [r["h"] for r in each.where("lo <> hi").select("h").limit(CLASHES).collect()]
    if len(clashes) == CLASHES:
        raise RuntimeError("too many texts share a hash")
    return F.when(first.isin(clashes), F.xxhash64(first, second)).otherwise(first) if clashes else first
