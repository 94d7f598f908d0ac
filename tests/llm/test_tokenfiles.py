import array
import glob
import random
import zlib

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from noticeflow.llm import tokenfiles

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = [" ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", "　", " ", "​", "a", "the", "The", "'s", "'", "1", "é", "é", "́", "中文", "<|endoftext|>", "<|endof", "text|>", "<|startoftext|>", ".", "!!", "\U0001f600", "Σ", "ς", "İ", "don't", "가"]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    return lambda text: found.encode(text, add_special_tokens=False).ids


def test_ids_are_the_library_s(library, monkeypatch):
    encoder = tokenfiles.WordEncoder(PATH)
    assert encoder.by_words and encoder.pieces is not None
    monkeypatch.setattr(tokenfiles, "KEPT", 200)  # most pieces are not kept
    r = random.Random(5)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 14))) for _ in range(3000)] + ["", " ", "x" * 5000, "Aé " * 4000]
    texts += [" ".join("".join(r.choice("theornadilsu'S1.") for _ in range(r.randint(1, 14))) for _ in range(30)) for _ in range(300)]
    got = encoder.encode(texts)
    assert [x.tolist() for x in got] == [library(t) for t in texts]


def test_agreed_code_points_are_encoded_as_the_library_does(library):
    encoder = tokenfiles.WordEncoder(PATH)
    points = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000 and tokenfiles.SAFE.fullmatch(chr(k))]
    texts = ["".join(points[k : k + 40]) for k in range(0, len(points), 40)] + ["a".join(points[k : k + 40]) + "1" for k in range(0, len(points), 40)]
    texts += ["e" + c for c in points[:2500]] + ["1" + c + "." for c in points[:2500]]
    assert [x.tolist() for x in encoder.encode(texts)] == [library(t) for t in texts]


def test_every_token_is_reached_alike(library):
    encoder = tokenfiles.WordEncoder(PATH)
    words = [t for t in (encoder.tokenizer.id_to_token(k).removesuffix("</w>") for k in range(encoder.tokenizer.get_vocab_size())) if t.isascii() and t.isalpha()]
    text = " ".join(words)
    assert len(words) > 20000 and encoder.encode([text])[0].tolist() == library(text)
    joined = [a + b for a, b in zip(words[::7], words[3::7], strict=False)]
    assert encoder.encode([" ".join(joined)])[0].tolist() == library(" ".join(joined))


def brute(rows, library, end=1):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = array.array("I", [*library(text or ""), end])
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip_gives_what_the_library_gives(spark, library):
    r = random.Random(8)
    rows = [(k, r.choice([None, "", "one two", " ".join(r.choice(PIECES) for _ in range(r.randint(0, 400)))])) for k in range(300)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(tuple(x) for x in tokenfiles.round_trip(df, PATH).collect())
    assert got == brute(rows, library)


def test_edges(spark, library):
    assert tokenfiles.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
    rows = [(None, "a b"), (3, "same"), (3, "same"), (3, "same"), (-1, None)]
    df = spark.createDataFrame([(*x, 1, "p", "q") for x in rows], "doc_id long, text string, ids int, part string, place string")
    got = sorted((tuple(x) for x in tokenfiles.round_trip(df, PATH).collect()), key=lambda x: x[1])
    assert got == brute(rows, library)


def test_files_are_in_order_and_laid_out_as_asked(spark, tmp_path, library):
    rows = [(k, f"word{k % 50} and more", f"m{k}", k % 7) for k in range(4000)]
    folder = str(tmp_path / "files")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, place int").repartition(3)
    tokenfiles.write(df, folder, PATH, layout={"parquet.page.row.count.limit": 100, "parquet.block.size": 1 << 11})
    last, groups = -1, 0
    for name in sorted(glob.glob(folder + "/part-*")):
        file = pq.ParquetFile(name)
        ids = [x for x in file.read(columns=["doc_id"]).column(0).to_pylist()]
        assert ids == sorted(ids) and (not ids or ids[0] > last)
        last = ids[-1] if ids else last
        for g in range(file.metadata.num_row_groups):
            group = file.metadata.row_group(g)
            columns = {group.column(c).path_in_schema: group.column(c) for c in range(group.num_columns)}
            assert all(c.has_offset_index and c.has_column_index for n, c in columns.items() if n == "doc_id")
            tokens = next(c for n, c in columns.items() if n.startswith("ids"))
            assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED", "PLAIN_DICTIONARY"} & set(tokens.encodings)
            groups += 1
    assert last == 3999 and groups > 4
    some = tokenfiles.read(spark, folder, 1000, 1009, meta=["lang", "place"])
    assert [(x.doc_id, x.lang, x.place, list(x.ids)) for x in some.orderBy("doc_id").collect()] == [(k, f"m{k}", k % 7, [*library(rows[k][1]), 1]) for k in range(1000, 1010)]
    light = tokenfiles.read(spark, folder, meta=["lang"], ids=False)
    assert "ids" not in light._jdf.queryExecution().executedPlan().toString() and light.count() == 4000


def test_ids_of_wide_vocabularies_are_deltas(spark, tmp_path):
    r = random.Random(2)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(20000)]
    df = spark.createDataFrame([(k, " ".join(words[20 * k : 20 * k + 20])) for k in range(1000)], "doc_id long, text string").coalesce(1)
    folder = str(tmp_path / "wide")
    tokenfiles.write(df, folder, PATH, layout={"parquet.dictionary.page.size": 4096})
    found = set()
    for name in glob.glob(folder + "/part-*"):
        group = pq.ParquetFile(name).metadata
        for g in range(group.num_row_groups):
            found |= {e for c in range(group.num_columns) for e in group.row_group(g).column(c).encodings if group.row_group(g).column(c).path_in_schema.startswith("ids")}
    assert "DELTA_BINARY_PACKED" in found
