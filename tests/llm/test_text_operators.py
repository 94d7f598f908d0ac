import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from noticeflow.llm import dedup, flac, secrets, toxicity


def damerau(a, b):
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_finds_words_within_one_edit():
    r = random.Random(1)
    terms = ["abcab", "bacab", "ccccc", "abcd", "cabbac"]
    a = toxicity.Automaton(dict.fromkeys(terms, 1.0))
    for _ in range(4000):
        word = "".join(r.choice("abcd") for _ in range(r.randint(1, 8)))
        if r.random() < 0.5:
            word = list(r.choice(terms))
            for _ in range(r.randint(0, 2)):
                k = r.randrange(len(word))
                word[k : k + r.randint(0, 2)] = r.choice(["", "a", "x", "ba"])
            word = "".join(word) or "a"
        near = sorted(t for t in terms if len(t) >= toxicity.FUZZY and damerau(word, t) == 1)
        want = (word, False) if word in terms else (near[0], True) if near else None
        assert a._find(word) == want, word
    assert toxicity.Automaton({"abus*": 1.0}).find("abusive") == ("abus*", False)


def test_quotation_weighs_less_than_abuse():
    terms = {"idiot": 5.0}
    a = toxicity.Automaton(terms)
    quoted = toxicity.features('the report said "what an idiot" once', terms, a)
    abuse = toxicity.features("well you really are an idiot my friend", terms, a)
    assert quoted[2] == 1 and abuse[2] == 0 and abuse[3] == 1 and quoted[4] < abuse[4]


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(2)
    bad, plain = ["idiot", "scum", "moron"], [f"word{k}" for k in range(300)]
    docs, labels = [], []
    for k in range(900):
        toxic = k % 4 == 0
        words = [r.choice(plain) for _ in range(r.randint(5, 60))]
        for _ in range(3 if toxic else 0):
            w = r.choice(bad)
            words.insert(r.randrange(len(words)), w if r.random() < 0.8 else w[:2] + w[3] + w[2] + w[4:])
        docs.append((k, " ".join(words), "x", 1.0))
        labels.append((k, int(toxic)))
    docs += [(None, "idiot scum", "x", 1.0), (9000, None, "x", 1.0), (9001, "", "x", 1.0), (9002, "fine " * 40_000, "x", 1.0), (0, docs[0][1], "x", 1.0)]
    labels += [(None, 1), (5, None), (0, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, toxic string, score double").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(df, toxicity.fit(df, lab)).collect()
    assert len(got) == len(docs) and all(x.held_out == (zlib.crc32(str(x.doc_id).encode() if x.doc_id is not None else b"") % 3 == 1) and 0 <= x.score <= 1 and x.predicted == (x.score >= 0.7) for x in got)
    truth = {i: y for i, y in labels if i is not None and i < 900}
    held = [x for x in got if x.held_out and x.doc_id in truth and x.doc_id not in (0, 5)]
    assert sum(x.predicted == (x.doc_id % 4 == 0) for x in held) >= 0.97 * len(held) and len(held) > 200
    blank = toxicity.fit(df, lab.limit(0))
    assert {x.predicted for x in toxicity.score(df, blank).collect()} == {0} and toxicity.score(df.limit(0), blank).collect() == []
    kept = toxicity.keep_civil(df, toxicity.fit(df, lab))
    assert kept.columns == df.columns and kept.where("doc_id = 9000").count() == 1 and kept.where("doc_id is null").count() == 0


def base(text):
    out = []
    for kind, pattern, least, group in (("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2), ("access", r"(AKIA[A-Z0-9]+)", 18, 1), ("hex", r"([0-9a-f]+)", 16, 1)):
        out += [(m.start(), ("assign", "access", "hex").index(kind), m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return sorted(out)


def test_secrets_base_against_the_plain_patterns(spark):
    r = random.Random(3)
    bits = ["password", "PassWd", "apikey", "api_key", "token", ":", "=", " ", '"', "'", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "long-value_of.12+/=", "é", "\n", "key"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 12))) for _ in range(3000)] + [None, "", "x " * 100_000 + "token = deadbeefdeadbeef00"]
    df = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)] + [(None, "token=abcdefghijkl", "s"), (1, texts[1], "s")], "doc_id long, text string, spans string")
    for x in secrets.find_secrets(df).collect():
        text = (texts[x.doc_id] or "") if x.doc_id is not None else "token=abcdefghijkl"
        want = base(text)
        names = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in want]
        assert x.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [s for s in x.spans.split(",") if s and not s.startswith("guess")] == names and (x.n_assign, x.n_access, x.n_hex) == tuple(sum(w[1] == k for w in want) for k in range(3))
    assert secrets.find_secrets(df.limit(0)).collect() == []


def test_guesses():
    easy = ["password", "Password1", "123456", "qwertyuiop", "aaaaaaaaaaaa", "2024-01-15", "letmein2024", "abcdefgh", "abcabcabcabc"]
    hard = ["x7#Kq9!vLm2$", "Tr0ub4dor&3xZq", "gH8sK2mQ9pLw"]
    guesses = secrets.Guesser().guesses
    assert max(guesses(x) for x in easy) < secrets.GUESSES < min(guesses(x) for x in hard)
    assert guesses("p4ssword") < guesses("pxqsword") and guesses("x" * 5000) < 9
    found = secrets.scan('db pwd: "x7#Kq9!vLm2$" and password = changeme')
    assert [k for _, k, _ in found] == [3] and secrets.masked('pwd: "x7#Kq9!vLm2$"!') == 'pwd: "[SECRET]"!'
    assert secrets.masked("no secret here") == "no secret here"


def test_masking_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "token = deadbeefdeadbeef00 é", 28), (2, None, 0), (3, "plain", 7)], "doc_id long, text string, n_chars long")
    assert [tuple(x) for x in secrets.mask_secrets(df).orderBy("doc_id").collect()] == [(1, "[SECRET] é", 10), (2, None, 0), (3, "plain", 7)]


def test_flac_round_trips():
    r = random.Random(4)
    data = [b"", b"a", b"hello world " * 50, bytes(r.randrange(256) for _ in range(5000)), b"\0" * 400, bytes([0, 255] * 300), b" " * 192, b"a" * 191 + b"\xff", b"z" * 190 + b"\0" * 400]
    streams = flac.encode(data)
    assert [(x + 128).astype(np.uint8).tobytes() for x in flac.decode(streams)] == data
    for at in (-1, -30, -120, 60, 45):
        broken = bytearray(streams[3])
        broken[at] ^= 16
        with pytest.raises(flac.FlacError):
            flac.decode([bytes(broken)])


def bit_stream(total, frames, bits=16):
    """A FLAC stream from frames as (samples, subframe bits); no seek table and no MD5."""
    info = (4096).to_bytes(2, "big") * 2 + bytes(6) + (8000 << 44 | (bits - 1) << 36 | total).to_bytes(8, "big") + bytes(16)
    out = b"fLaC" + bytes([0x80, 0, 0, 34]) + info
    for k, (n, body) in enumerate(frames):
        head = bytes([0xFF, 0xF8, 0x74, {8: 2, 16: 8}[bits], k]) + (n - 1).to_bytes(2, "big")
        buf = np.frombuffer(head, np.uint8)
        frame = head + bytes([int(flac.crc8(buf, np.array([0]), np.array([len(head)]))[0])])
        body += "0" * (-len(body) % 8)
        frame += int(body, 2).to_bytes(len(body) // 8, "big")
        frame += int(flac.crc16(np.frombuffer(frame, np.uint8), np.array([0]), np.array([len(frame)]))[0]).to_bytes(2, "big")
        out += frame
    return out


def test_flac_reads_linear_predictors_partitions_escapes_and_wasted_bits():
    r = random.Random(5)
    field = lambda x, n: format(x & (1 << n) - 1, f"0{n}b")
    rice = lambda x, k: "0" * ((u := x << 1 ^ x >> 63) >> k) + "1" + (field(u, k) if k else "")
    x = [int(6000 * np.sin(t / 7)) + r.randint(-9, 9) for t in range(64)]
    coefs, shift = [1900, -950], 10
    body = "0" + field(32 + 1, 6) + "0" + field(x[0], 16) + field(x[1], 16) + field(12 - 1, 4) + field(shift, 5) + "".join(field(c, 12) for c in coefs)
    res = [x[t] - ((coefs[0] * x[t - 1] + coefs[1] * x[t - 2]) >> shift) for t in range(2, 64)]
    body += "00" + field(1, 4) + field(7, 4) + "".join(rice(v, 7) for v in res[:30]) + field(15, 4) + field(16, 5) + "".join(field(v, 16) for v in res[30:])
    even = [2 * v for v in range(-20, 20)]
    wasted = "0" + field(1, 6) + "1" + "1" + "".join(field(v >> 1, 15) for v in even)
    wide = "0" + field(8 + 1, 6) + "0" + field(5, 16) + "01" + field(0, 4) + field(3, 5) + "".join(rice(v, 3) for v in [4, -4, 900])
    assert flac.decode([bit_stream(64 + 40 + 4, [(64, body), (40, wasted), (4, wide)])])[0].tolist() == x + even + [5, 9, 5, 905]
    long = "0" + field(8, 6) + "0" + "00" + field(0, 4) + field(0, 4) + "".join(rice(v, 0) for v in [60, -64, 0, 5])
    assert flac.decode([bit_stream(4, [(4, long)], 8)])[0].tolist() == [60, -64, 0, 5]


def test_flac_columns(spark):
    rows = [(1, "text é", "m"), (2, None, "m"), (3, "", "m"), (None, "text é", "m"), (4, "long " * 60_000, "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, media string")
    got = {x.doc_id: x for x in flac.round_trip(df).collect()}
    for i, t, _ in rows:
        data = flac.payload((t or "").encode())
        x = got[i]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len((t or "").encode()), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:])) and len(data) % 192 == 0
    assert got[1][2:] == got[None][2:] and got[2].media_sha256 == got[3].media_sha256
    blocks = flac.pcm_blocks(flac.store(df)).where("media_id = 4").orderBy("block").collect()
    assert [b.first_sample for b in blocks] == list(range(0, got[4].payload_bytes, 192))
    assert b"".join((np.frombuffer(b.pcm, "<i4") + 128).astype(np.uint8).tobytes() for b in blocks).decode().rstrip() == ("long " * 60_000).rstrip()
    assert flac.round_trip(df.limit(0)).collect() == []


def test_near_duplicates_keep_one(spark):
    r = random.Random(6)
    words = lambda n: [f"w{r.randrange(10**5)}" for _ in range(n)]
    texts = {k: words(120) for k in range(40)}
    rows = [(k, " ".join(t)) for k, t in texts.items()]
    for k in range(20):  # near copies: one word of 120 differs
        t = list(texts[k])
        t[r.randrange(120)] = "changed"
        rows.append((100 + k, " ".join(t)))
    for k in range(20, 30):  # half the text is another
        rows.append((100 + k, " ".join(texts[k][:60] + words(60))))
    rows += [(500, rows[3][1]), (500, rows[3][1]), (600, None), (601, ""), (602, " "), (None, "alone here"), (700, "twice"), (700, "twice")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, th string, a int").repartition(4)
    kept = dedup.keep_one(df).collect()
    ids = sorted(x.doc_id if x.doc_id is not None else -1 for x in kept)
    clean = {*range(40), *range(120, 130), 600, 700, -1}
    assert clean <= set(ids) and len(ids) == len(set(ids)) and not {500, 601} & set(ids) and len(set(ids) - clean - {602}) <= 2
    assert dedup.keep_one(df.limit(0)).collect() == [] and kept[0].asDict().keys() == {"doc_id", "text", "th", "a"}


def test_guesses_against_all_segmentations():
    """The cheapest of all ways to cut a value, found by trying each one."""
    guesser = secrets.Guesser(("happiness", "fang", "lor"))
    r = random.Random(8)
    pieces = ["pass", "happiness", "2024-05-01", "1987", "qwert", "aaaa", "x9", "zQ", "lor", "!", "abab", "fang", "k"]
    for _ in range(300):
        value = "".join(r.choice(pieces) for _ in range(r.randint(1, 4)))[:12]
        known = {}
        for i, j, cost in secrets.spans(value, guesser.rank, guesser.longest):
            known[i, j] = min(cost, known.get((i, j), 99))

        def cheapest(i):
            return min((min((j - i) * secrets.BRUTE, known.get((i, j), 99)) + secrets.SPAN + cheapest(j) for j in range(i + 1, len(value) + 1)), default=0.0)

        assert abs(cheapest(0) - guesser.guesses(value)) < 1e-9, value


def test_secrets_in_prose_and_in_a_credential_s_place():
    """Precision on prose of 1.0, and recall of 0.95 on random passwords, on invented sentences."""
    words = "happiness everything persistence unbelievably Sonnenschein required optional well-known word-of-mouth 2024-05-01 555-123-4567 https://example.com/login bob@example.com secret/ state-of-the-art UPPERCASE".split()
    prose = [f"The {a} is {w}{e} they say" for a in ("secret", "password", "token", "api key", "credential") for w in words for e in ("", ".", ",", "!", ")")]
    prose += [f"{a}: {w}" for a in ("Token", "Password", "secret") for w in words if len(w) < 12 or not w.isascii()]
    assert [t for t in prose if any(k == 3 for _, k, _ in secrets.scan(t))] == []
    r = random.Random(9)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&*+@^~"
    keys = ["".join(r.choice(alphabet) for _ in range(r.randint(10, 16))) for _ in range(400)]
    found = sum(any(k == 3 for _, k, _ in secrets.scan(f"{r.choice(['pwd:', 'password is', 'passphrase:', 'Authorization: Bearer', 'private_key='])} {x} and more")) for x in keys)
    assert found >= 0.95 * len(keys)
    base = sum(any(k < 3 for _, k, _ in secrets.scan(f"password is {x}")) for x in keys)
    assert base < 0.05 * len(keys)  # what the fixed patterns alone would find


def test_lexicon(spark):
    rows = [(k, "Alpha beta. GAMMA" if k < 6 else "alpha 'delta' alpha x9") for k in range(12)] + [(99, None), (98, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert secrets.lexicon(df, most=10, least=5) == ("alpha", "beta", "delta", "gamma")
    assert secrets.lexicon(df, most=2, least=5) == ("alpha",) and secrets.lexicon(df.limit(0)) == ()


def test_the_cost_decides_what_reads_like_no_word():
    guess = lambda t, g=secrets.Guesser(): [t[a:b] for a, k, b in secrets.scan(t, g) if k == 3]
    for text, value in (("password: xkqjzvwpfh", "xkqjzvwpfh"), ("pwd: xkqjzvwpfhgt", "xkqjzvwpfhgt"), ("password is 8491736205", "8491736205"), ("secret: kQ@zvh.tWq77x", "kQ@zvh.tWq77x"), ("secret: KqZvHtWxLp", "KqZvHtWxLp")):
        assert guess(text) == [value]
    for text in ("auth: OAuth2Authentication", "token: McDonaldsBurgerKing", "token: getElementById2", "token is 555-123-4567 ok", "mail token: bob@example.com", "secret: www.example.org/x", "The password is everything."):
        assert guess(text) == []
    r = random.Random(5)
    for letters, n, least in (("abcdefghijklmnopqrstuvwxyz", 12, 0.93), ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 12, 0.97), ("0123456789", 12, 0.9), ("abcdefghijklmnopqrstuvwxyz0123456789!@#%^&*", 10, 0.93)):
        values = ["".join(r.choice(letters) for _ in range(n)) for _ in range(400)]
        assert sum(bool(guess(f"pwd: {v} and")) for v in values) >= least * 400


def test_a_leak_that_is_copied_becomes_no_word(spark):
    leak = "our password: kqzvhtwx and more of the same page"
    rows = [(leak,)] * 40 + [(f"{leak} {k}",) for k in range(40)] + [("zvqkxjwp stands in one text only",)] * 30 + [(f"common words number {k} in many texts",) for k in range(12)]
    known = secrets.lexicon(spark.createDataFrame(rows, "text string").repartition(5), texts=secrets.LEAST)
    assert {"common", "words", "page", "many"} <= set(known) and not {"kqzvhtwx", "zvqkxjwp", "stands"} & set(known)
    assert [k for _, k, _ in secrets.scan("password: kqzvhtwxLp", secrets.Guesser(known))] == [3]
