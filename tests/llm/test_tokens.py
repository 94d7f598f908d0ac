import array
import random
import re
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from noticeflow.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [" ", " ", "  ", "\n", "\t", "a", "the", "'s", "'", "1", "é", "中", "<|endoftext|>", "<|endof", "text|>", ".", " ", "　", "\x1c", "​", "\x85", " ", "\U0001f600", "_", "́", "՘", "don't"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_ids_are_the_library_s(library, monkeypatch):
    encoder = tokens.Encoder(PATH)
    assert encoder.plain and encoder.quick
    for most in (tokens.LONG, 4):
        monkeypatch.setattr(tokens, "LONG", most)
        texts = random_texts(3000, most)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [list(x) for x in encoder.encode(texts)] == want
        assert encoder.count(texts) == [len(x) for x in want]


def test_long_runs_are_the_library_s(library, monkeypatch):
    encoder = tokens.Encoder(PATH)
    monkeypatch.setattr(tokens, "RUNS", re.compile(tokens.SPACE + "{3,}"))
    r = random.Random(5)
    runs = [" ", "\n", "\t", "\xa0", "\u3000", "a", "!", "1", "é", "'s", "<|endoftext|>"]
    texts = ["".join(r.choice(runs) * r.choice([1, 1, 2, 3, 7, 40]) for _ in range(r.randint(0, 9))) for _ in range(1500)]
    assert [list(x) for x in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("unit", [" ", "\n", " \n\t", "a", "!", "7", "x" + " " * 999_999])
def test_texts_of_a_million_characters_of_a_kind(library, unit):
    encoder = tokens.Encoder(PATH)
    text = unit * (10**6 // len(unit)) + "y"
    assert list(encoder.encode([text])[0]) == library.encode_batch_fast([text], add_special_tokens=False)[0].ids
    if unit in (" ", "a"):
        assert encoder.count([unit * 10**7, "one"])[1] == 1


def test_both_libraries_agree_on_the_code_points_that_take_the_quick_way(library):
    encoder = tokens.Encoder(PATH)
    chars = [c for c in map(chr, range(0xD800)) if tokens.AGREED.fullmatch(c)]
    texts = [f"a{c}1{c}.{c} {c}" for c in chars]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [encoder.quick[0].encode_ordinary(t) for t in texts] == want


def test_counts(spark, library):
    texts = [None, "", "one", "x " * 600, "<|endoftext|> a", "long " * 50_000, *random_texts(60)]
    rows = [(k, t, "c", 0) for k, t in enumerate(texts)] + [(None, "z", "c", 0), (2, "one", "c", 0)]
    got = tokens.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, over_limit int"), PATH, 512).collect()
    want = sorted(((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t, _, _ in rows), key=repr)
    assert sorted((tuple(x) for x in got), key=repr) == want
    assert tokens.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_packing(spark, library):
    r = random.Random(2)
    rows = [(k, " ".join(r.choice(["alpha", "be", "gamma ray", "x"]) for _ in range(int(r.paretovariate(0.7))))[:9000]) for k in range(300)]
    rows += [(1000, None), (1001, ""), (None, "null id"), (5, rows[5][1]), (1002, "y " * 5000)]
    got = packing.pack(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, rank int").repartition(3), PATH, size=256, end=2).collect()
    sequences, docs = defaultdict(list), defaultdict(list)
    for x in got:
        sequences[x.sequence_id].append((x.offset, x.length))
        docs[x.doc_id].append((x.piece, x.start, x.length, x.ids_crc32))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    want = defaultdict(list)
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 256 or 256
        bounds = [0, *range(first, len(ids) + 1, 256)]
        want[i] += [(k, a, b - a, zlib.crc32(array.array("I", ids[a:b]).tobytes())) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    assert {i: sorted(x) for i, x in docs.items()} == {i: sorted(x) for i, x in want.items()}
    assert len(sequences) <= -(-sum(x.length for x in got) // 256) * 1.02 + 1
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_plan_packs_every_document_once():
    import numpy as np

    r = random.Random(3)
    for size in (1, 2, 3, 17, 64):
        for _ in range(4):
            h = np.array([0, *(r.choice([0, 0, 1, 5, 400]) for _ in range(size))])
            packed = packing.plan(h, size, 100)
            used = np.zeros(size + 1, np.int64)
            for lengths, n in packed.items():
                assert n > 0 and sum(lengths) <= size
                for x in lengths:
                    used[x] += n
            assert used.tolist() == h.tolist()
            total = int((h * np.arange(size + 1)).sum())
            alone = int(h[size // 2 + 1 :].sum())  # longer than half a sequence
            assert sum(packed.values()) <= max(alone, 1.25 * total / size) + alone * 0.25 + 2


def test_texts_that_are_no_utf8(spark):
    df = spark.sql("select 1L as doc_id, cast(X'61ff62' as string) as text")
    assert [(x.n_bytes, x.n_tokens > 0) for x in tokens.count_tokens(df, PATH).collect()] == [(3, True)]
