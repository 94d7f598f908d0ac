"""Token counts by batch encoding in Arrow functions.

Batches are balanced by bytes. A text is split at safe boundaries, where a byte-level tokenizer always starts a new piece, so
that no id depends on what stands beyond: before a single space that follows another character, and around long runs of
white space.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bytes of text in a batch, and characters of a long text encoded at a time.
BATCH, LONG = 2 << 20, 1 << 16
#: Code points for which both tokenizer libraries agree what is a letter, a number or white space; the tests hold all of them.
AGREED = re.compile(r"[\x00-\u024f\u0300-\u036f\u0391-\u03ff\u0400-\u04ff\u2000-\u206f\u3040-\u3096\u30a0-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]*")
#: What a plain byte-level tokenizer file splits by, and the same for texts without two white-space characters in a row.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPLIT_SINGLE = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
DOUBLE = re.compile(r"\s\s")
SAFE = re.compile(r"(?<=\S) (?=\S)")
#: What the tokenizers' patterns take for white space, and how much of it in a row is split off: their matchers recurse over it.
SPACE = r"[\t-\r\x20\x85\xa0  -     　]"
RUN = 256
RUNS = re.compile(SPACE + f"{{{RUN},}}")
#: How a part is encoded: by the file's own library, by ranks with or without two white-space characters in a row, or as one piece.
LIBRARY, RANKS, SINGLE, PIECE = range(4)

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts by a byte-level BPE tokenizer file (.json), as its library gives them without added special tokens.

    Where the file is a plain byte-level BPE whose merges are ranked by id, parts of well-known code points go to a quicker encoder
    built from the same file; everything else goes to the file's own library. Either encodes a batch of parts at a time.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        self.marks = [x["content"] for x in spec.get("added_tokens") or ()]
        self.quick = _ranked(spec)
        self.plain = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and not spec.get("normalizer") and not any(" " in x for x in self.marks)

    @staticmethod
    def of(path: str) -> Encoder:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        return _encoders[path]

    def encode(self, texts: list[str]) -> list[array]:
        """The ids of each text."""
        out = [array("I") for _ in texts]
        for k, ids in self._encoded(texts):
            out[k].extend(ids)
        return out

    def count(self, texts: list[str]) -> list[int]:
        """The number of ids of each text; the ids themselves are never held for more than a batch of parts."""
        out = [0] * len(texts)
        for k, ids in self._encoded(texts):
            out[k] += len(ids)
        return out

    def _encoded(self, texts: list[str]) -> Iterator[tuple[int, list[int]]]:
        """(place of the text, ids) of each part of each text, in order; parts are encoded in batches of BATCH characters."""
        held: list[tuple[int, int, str]] = []
        size = 0
        for k, text in enumerate(texts):
            for how, part in self._parts(text):
                held.append((k, how, part))
                size += len(part)
                if size >= BATCH:
                    yield from self._batch(held)
                    held, size = [], 0
        yield from self._batch(held)

    def _parts(self, text: str) -> Iterator[tuple[int, str]]:
        if not self.plain or any(x in text for x in self.marks):
            yield LIBRARY, text
            return
        for part in parts(text):
            if not self.quick or not AGREED.fullmatch(part):
                yield LIBRARY, part
            elif not DOUBLE.search(part):
                yield SINGLE, part
            else:
                for piece, x in split_runs(part):
                    yield PIECE if piece else RANKS, x

    def _batch(self, held: list[tuple[int, int, str]]) -> Iterator[tuple[int, list[int]]]:
        found: dict[int, Iterator[list[int]]] = {}
        for how in (LIBRARY, RANKS, SINGLE, PIECE):
            own = [x for _, h, x in held if h == how]
            if how == LIBRARY:
                found[how] = (x.ids for x in self.tokenizer.encode_batch_fast(own, add_special_tokens=False)) if own else iter(())
            elif how == PIECE:
                found[how] = (self.quick[0]._encode_single_piece(x) for x in own)
            else:
                found[how] = iter(self.quick[how - RANKS].encode_ordinary_batch(own, num_threads=1)) if own else iter(())
        for k, how, _ in held:
            yield k, next(found[how])


def split_runs(text: str) -> Iterator[tuple[bool, str]]:
    """(whether it is one piece, part): long runs of white space by themselves, but for a last character that goes with what follows."""
    at = 0
    for m in RUNS.finditer(text):
        a, b = m.start(), m.end() if m.end() == len(text) else m.end() - 1
        if a > at:
            yield False, text[at:a]
        yield True, text[a:b]
        at = b
    if at < len(text) or not text:
        yield False, text[at:]


def parts(text: str, most: int = LONG) -> Iterator[str]:
    """Cuts a text before single spaces between other characters, at the first one after every `most` characters."""
    start = 0
    while len(text) - start > most and (cut := SAFE.search(text, start + most)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def _ranked(spec: dict):
    """An encoder by ranks, if the ids of the file's vocabulary rank its merges; else None."""
    model = spec["model"]
    if model.get("type") != "BPE" or any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "dropout", "ignore_merges")):
        return None
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in such files
    back = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(sorted({*range(256)} - {*plain}))}
    marks = {x["content"] for x in spec.get("added_tokens") or ()}
    vocab = {x: i for x, i in model["vocab"].items() if x not in marks}
    merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
    ids = [vocab.get(a + b, -1) for a, b in merges]
    if len(vocab) != 256 + len(merges) or ids != sorted(ids) or any(x not in back for t in vocab for x in t):
        return None
    import tiktoken

    ranks = {bytes(back[x] for x in t): i for t, i in vocab.items()}
    return [tiktoken.Encoding(p, pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (SPLIT, SPLIT_SINGLE)]


def _counts(path: str, limit: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for whole in batches:
            for batch in common.by_bytes(whole, "text", BATCH):
                sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
                n = encoder.count(common.strings(batch.column(1)))
                yield common.emit({"doc_id": batch.column(0), "n_bytes": sizes, "n_tokens": n, "over_limit": [x > limit for x in n]}, schema)

    return common.lean(run)


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row's whole text; only the counts leave the Arrow function.

    A null text counts as empty: 0 bytes, 0 tokens. Null doc_ids and repeated rows stay as they are, an empty table gives
    no rows, other columns are ignored. Nothing is shuffled.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _counts(path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
