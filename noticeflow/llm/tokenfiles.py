"""Token ids as Parquet list columns, in ascending order of the documents, and what is read back from them.

A file has one row for each document: doc_id, its place in the file, the ids, and a struct `meta` of the other columns, so that
metadata is read without tokens and tokens without metadata. Ids are dictionary-encoded as long as a column chunk's dictionary
fits its page, else as deltas; row groups are of a set size and pages of a set number of rows, with an index of each page's
smallest and largest doc_id, so that a range of documents is read without the pages beside it.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import unicodedata
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Bytes of text encoded at a time.
BATCH = 2 << 20
#: White space of ASCII, which every rule takes for such and which cuts texts into words.
SPACES = " \t\n\x0b\x0c\r"
#: Code points for which this module and the tokenizer's library agree on case, composition and kind; the tests hold all of them.
AGREED = "\t-\r -~\u00a1-\u017f\u0391-\u03a1\u03a4-\u03ce\u0400-\u0482\u048a-\u04ff\u2010-\u2027\u2030-\u205e\u20a0-\u20ac\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
SAFE = re.compile(f"[{AGREED}]*")
UNSAFE = re.compile(f"[^{AGREED}]")
#: The split that the quick way knows, as tokenizer files write it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _class(kind: str) -> str:
    """The AGREED code points of a general category, as ranges for a pattern."""
    points = [k for k in range(0x10000) if SAFE.fullmatch(chr(k)) and unicodedata.category(chr(k))[0] == kind]
    starts = [k for k in points if k - 1 not in set(points[max(0, bisect_left(points, k) - 1) : bisect_left(points, k)])]
    ends = [points[(bisect_left(points, b) if b else len(points)) - 1] for b in [*starts[1:], None]]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends, strict=True))


#: The same for lower-case texts of AGREED code points; kinds of pieces begin with different letters.
PIECES = re.compile(rf"[{_class('L')}]+|'(?:[stmd]|re|ve|ll)|[{_class('N')}]|[^\s{_class('L')}{_class('N')}]+")
ASCII_PIECES = re.compile(r"[a-z]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\sa-z0-9]+")
#: What ends a piece for the quick way; no text that goes there has it.
END = "\x00"
#: Pieces whose ids a worker keeps, and letters of one up to which it does.
KEPT, KEPT_LETTERS = 1 << 18, 32

#: Layout of the files: bytes of a row group and of a page, rows of a page.
LAYOUT = {"parquet.block.size": 64 << 20, "parquet.page.size": 1 << 20, "parquet.page.row.count.limit": 2000, "parquet.dictionary.page.size": 1 << 20, "parquet.writer.version": "v2", "parquet.enable.dictionary": "true"}

_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids by a tokenizer file (.json) whose pieces never hold white space, as its library gives them without special tokens.

    Then a text's ids are those of its words one after the other, whatever stands between. Where the file is a byte-level BPE with
    word ends whose merges are ranked by id, words of AGREED code points go to a quicker encoder built from the same file; all
    others, and those with a special token's string, to the library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        self.marks = [x["content"] for x in spec.get("added_tokens") or ()]
        probe = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        self.by_words = all(probe(f"a{x}{y}b") == probe("a") + probe("b") for x in SPACES for y in (x, "")) and not any(set(x) & set(SPACES) for x in self.marks)
        self.pieces = _ranked(spec) if self.by_words else None

    @staticmethod
    def of(path: str) -> WordEncoder:
        if path not in _encoders:
            _encoders[path] = WordEncoder(path)
        return _encoders[path]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if self.pieces is None:
            return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        parts = [part for text in texts for part in self._parts(text)]
        fast = (self.pieces.ids(x) for quick, x in parts if quick)
        rest = [x for quick, x in parts if quick is False]
        slow = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else ())
        out, held = [], []
        for quick, _ in parts:
            if quick is None:  # the text's end
                out.append(held[0] if len(held) == 1 else np.concatenate(held) if held else np.zeros(0, np.uint32))
                held = []
            else:
                held.append(next(fast) if quick else np.array(next(slow).ids, np.uint32))
        return out

    def _parts(self, text: str) -> Iterator[tuple[bool | None, str]]:
        """Stretches of words for the quick way (True) and for the library, and None for the text's end."""
        if SAFE.fullmatch(text) and not any(x in text for x in self.marks):
            yield True, text
        else:
            strange = lambda word: bool(UNSAFE.search(word)) or any(x in word for x in self.marks)
            for odd, words in itertools.groupby(re.split(f"[{SPACES}]+", text), strange):
                yield not odd, " ".join(words)
        yield None, ""


class Pieces(dict):
    """The ids of pieces as bytes: those that have come before are kept, a bounded number of them, others are encoded."""

    def __init__(self, encoding, ids: np.ndarray):
        self.encoding, self.order = encoding, ids

    def __missing__(self, piece: str) -> bytes:
        found = self.order[self.encoding._encode_single_piece((piece + END).encode())].tobytes()
        if len(self) < KEPT and len(piece) <= KEPT_LETTERS:
            self[piece] = found
        return found

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text of AGREED code points."""
        found = (ASCII_PIECES if text.isascii() else PIECES).findall(text.lower())
        return np.frombuffer(b"".join(map(self.__getitem__, found)), np.uint32)


def _ranked(spec: dict) -> Pieces | None:
    """The pieces' encoder, if the file is of the kind known."""
    model, split = spec["model"], {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
    case = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    if spec["normalizer"] != case or spec["pre_tokenizer"] != {"type": "Sequence", "pretokenizers": [split, level]} or model.get("type") != "BPE":
        return None
    end = model.get("end_of_word_suffix")
    if not end or any(model.get(k) for k in ("continuing_subword_prefix", "byte_fallback", "dropout", "ignore_merges")):
        return None
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in such files
    letters = {x: chr(x) for x in plain} | {x: chr(256 + k) for k, x in enumerate(sorted({*range(256)} - {*plain}))}
    back = {c: x for x, c in letters.items()}

    def raw(token: str) -> bytes:
        word = token.removesuffix(end)
        return bytes(back[c] for c in word) + (END.encode() if word != token else b"")

    vocab = model["vocab"]
    merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    made = [a + b for a, b in merges]
    if any(t not in vocab for t in made) or len(set(made)) != len(made) or any(letters[x] + e not in vocab for x in range(256) for e in ("", end)):
        return None
    # a last byte joins its END before anything else, single bytes are what is left, then the merges in their order
    order = [*[letters[x] + end for x in range(256)], *[letters[x] for x in range(256)], *made]
    import tiktoken

    encoding = tiktoken.Encoding("words", pat_str=f"[^{END}]*{END}", mergeable_ranks={raw(t): k for k, t in enumerate(order)}, special_tokens={})
    return Pieces(encoding, np.array([vocab[t] for t in order], np.uint32))


def _encode(path: str, end: int | None):
    """Rows in order, their texts as ids, with the part's number and the place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, place = WordEncoder.of(path), TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in common.by_bytes(whole, "text", BATCH):
                ids = encoder.encode(common.strings(batch.column(1)))
                if end is not None:
                    ids = [np.append(x, np.uint32(end)) for x in ids]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                values = np.concatenate(ids).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values))
                n = batch.num_rows
                yield pa.record_batch([batch.column(0), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n)), lists, *batch.columns[2:]], names=["doc_id", "part", "place", "ids", *batch.schema.names[2:]])
                place += n

    return common.lean(run)


def write(docs: DataFrame, folder: str, path: str, end: int | None = 1, layout: dict | None = None) -> None:
    """Writes the ids of every whole text of `docs` to `folder`, documents in ascending order of doc_id over all its files.

    `path` is the tokenizer's file; `end` follows each document. A null text is empty and leaves the end alone. Null doc_ids come
    first, rows of one doc_id in the order in which they are read. Columns other than doc_id and text go to `meta`, whatever their
    names. An empty table makes a folder without rows.
    """
    more = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([F.struct(*more).alias("meta")] if more else []))
    kinds = [T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), *rows.schema.fields[2:]]
    with common.small_batches(docs.sparkSession):
        ordered = rows.withColumn("came", F.monotonically_increasing_id()).repartitionByRange("doc_id", "came").sortWithinPartitions("doc_id", "came").drop("came")
        made = ordered.mapInArrow(_encode(path, end), T.StructType(kinds))
        made.write.options(**(LAYOUT | (layout or {}))).parquet(folder)


def read(spark: SparkSession, folder: str, low: int | None = None, high: int | None = None, meta: list[str] | None = None, ids: bool = True) -> DataFrame:
    """doc_id, ids (unless left out) and the chosen fields of meta, of the documents from `low` to `high`; pages of others are skipped."""
    rows = spark.read.parquet(folder)
    for bound, keep in ((low, F.col("doc_id") >= F.lit(low)), (high, F.col("doc_id") <= F.lit(high))):
        rows = rows if bound is None else rows.where(keep)
    return rows.select("doc_id", *(["ids"] if ids else []), *[F.col(f"meta.`{m}`").alias(m) for m in meta or []])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, part, place, n_tokens, ids_crc32) from ids as they were read."""
    for batch in batches:
        lists = batch.column(3)
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False)
        data = memoryview(values.astype("<u4")).cast("B")
        crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in itertools.pairwise(offsets.tolist())]
        yield pa.record_batch([*batch.columns[:3], pa.array(np.diff(offsets).astype(np.int64)), pa.array(crcs, pa.int64())], names=["doc_id", "part", "place", "n_tokens", "ids_crc32"])


def offsets(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row of the files: start counts the ids of all rows before it.

    Each file's ids are summed up by themselves; files then start at the sum of those before, so that only a row for each file
    comes together.
    """
    rows = spark.read.parquet(folder).select("doc_id", "part", "place", "ids")
    summed = common.stored(rows.mapInArrow(common.lean(_summed), "doc_id long, part int, place long, n_tokens long, ids_crc32 long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = summed.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    earlier = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    local = summed.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    return local.join(parts, "part").select("doc_id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str, end: int | None = 1) -> DataFrame:
    """Writes the ids of all documents to the shared folder and gives each row's offset, number and checksum as read from there."""
    spark = docs.sparkSession
    folder = f"{common.shared_dir(spark)}/{uuid.uuid4().hex}"
    write(docs, folder, path, end)
    return offsets(spark, folder)
