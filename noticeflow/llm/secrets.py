"""Secret scans: fixed patterns, and values in a credential's place that are hard to guess.

How many guesses a value takes is the cheapest of all ways to cut it into known words, dates, repeats, keyboard walks,
sequences and brute-force spans, found by dynamic programming. Words are known from a fixed list and from the corpus: its most
frequent ones in several different texts, counted over all documents, but never in a credential's place. The cost decides. Only
what reads like words (by the pairs of letters that known words have), a number in groups, or an address is no secret whatever
its cost.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("assign", "access", "hex", "guess")
#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Words that announce a credential, and the value that follows them.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|auth|account|encryption)[_-]?key|auth(?:orization)?|credentials?|bearer)"""
    r"""["']?[ \t]*(?:[:=]{1,2}|=>|[ \t]is[ \t])[ \t]*(?:bearer[ \t]+)?["']?([^\s"'<>,;]{6,})""",
    re.IGNORECASE | re.ASCII,
)
MARKS = ("pass", "pwd", "secret", "token", "key", "auth", "credential", "bearer")
#: Frequent words of passwords, the most frequent first.
COMMON = (
    "password 123456 qwerty admin welcome letmein monkey dragon master login iloveyou princess sunshine football baseball shadow "
    "superman michael trustno1 hello freedom whatever secret token user test guest root changeme default example sample public "
    "access summer winter spring autumn love house computer internet server database company office money school batman killer "
    "charlie jordan thomas hunter ranger soccer hockey george andrew daniel jessica pepper ginger cookie cheese banana orange "
    "purple silver golden diamond flower butterfly angel heaven star moon light night happy lucky magic power system network "
    "the and you that was for are with his they this have from one had word but not what all were when your can said there use"
).split()
KEYBOARD = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "qaz", "wsx", "edc", "rfv", "tgb", "yhn", "ujm")
ORDERED = ("abcdefghijklmnopqrstuvwxyz", "0123456789")
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
#: Digits and signs that stand for letters.
LEET = str.maketrans("4@301!5$7+", "aaeoiisstt")
#: Decimal digits of guesses from which on a value counts as a secret, the cost of one more span, and of a brute-force character.
GUESSES, SPAN, BRUTE = 9.0, 0.3, 1.0
#: Words of the corpus that are known, and in how many different texts one has to be (documented bounds of the frequency table).
MOST, LEAST = 50_000, 5
#: Letters of a word of the corpus.
LETTERS = (3, 20)
#: Values whose guesses a worker keeps.
KEPT = 20_000
#: Characters around a value that belong to the sentence, and values that are addresses.
EDGES = "()[]{}.!?:*`"
ADDRESS = re.compile(r"[a-z][a-z0-9+.-]*://[^/@]*(?:/|$)|[\w.+-]+@(?:[a-z0-9-]+\.)+[a-z]{2,24}$|www\.(?:[\w-]+\.)+[a-z]{2,24}(?:/|$)", re.IGNORECASE | re.ASCII)
#: Parts of a name in which capitals begin words, digits of such a name, and the digits of a number in groups.
PARTS, DIGITS, GROUP = re.compile("[A-Z]?[a-z]+|[A-Z]+(?![a-z])"), 2, re.compile(r"[+(]?\d{1,6}(?:[-./ ()]{1,2}\d{1,6})+")
#: What a pair of letters may cost on average in a word, and the share of a name's letters that such words have to be.
READS, SHARE = 1.4, 0.7
#: Signs between words.
JOINTS = "-_./'"

_NEXT = {a + b for row in (*KEYBOARD, *ORDERED) for line in (row, row[::-1]) for a, b in zip(line, line[1:], strict=False)}


def spans(value: str, rank: Mapping[str, int], longest: int) -> list[tuple[int, int, float]]:
    """(start, end, cost) of all stretches of the value that are a known word, a date, a repeat, a walk or a sequence."""
    n = len(value)
    low = value.lower()
    plain = low.translate(LEET)
    out: list[tuple[int, int, float]] = []
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            for text, twist in ((low[i:j], 0.0), (plain[i:j], 0.5)):
                if text in rank:
                    case = 0.0 if value[i:j] == low[i:j] else 0.3 if value[i + 1 : j] == low[i + 1 : j] or value[i:j].isupper() else 1.0
                    out.append((i, j, math.log10(rank[text] + 1) + twist + case))
                    break
    for m in DATE.finditer(value):
        out.append((*m.span(), 2.1 if m.end() - m.start() == 4 else 4.6))
    i = 0
    while i < n:  # runs of one character, and of keyboard or alphabet neighbours
        j = i + 1
        while j < n and value[j] == value[i]:
            j += 1
        if j - i >= 3:
            out += [(s, j, math.log10(95 * (j - s))) for s in range(i, min(j - 2, i + 2))]
        k = i + 1
        while k < n and low[k - 1] + low[k] in _NEXT:
            k += 1
        if k - i >= 3:
            out.append((i, k, math.log10(47 * 4 * (k - i))))
        i = max(i + 1, j - 1 if j - i >= 3 else 0, k - 1 if k - i >= 3 else 0)
    for size in range(2, min(math.ceil(GUESSES / BRUTE), n // 2) + 1):  # a block that comes again at once; a longer one costs GUESSES by itself
        i = 0
        while i + 2 * size <= n:
            reps = 1
            while value[i : i + size] == value[i + reps * size : i + (reps + 1) * size] and len(set(value[i : i + size])) > 1:
                reps += 1
            if reps > 1:
                out.append((i, i + reps * size, size * BRUTE + math.log10(reps)))
                i += reps * size
            else:
                i += 1
    return out


class Guesser:
    """How hard values are to guess, given the words of a corpus, the most frequent first."""

    def __init__(self, words: tuple[str, ...] = ()):
        self.rank = {w: k + 1 for k, w in reversed([*enumerate(COMMON), *enumerate(words, len(COMMON))])}
        self.longest = max(map(len, self.rank))
        self.known: dict[str, float] = {}
        pairs = Counter(w[k : k + 2] for w in self.rank for k in range(len(w) - 1))
        firsts = Counter(w[k] for w in self.rank for k in range(len(w) - 1))
        letters = ORDERED[0]
        self.pairs = {a + b: -math.log10((pairs[a + b] + 0.5) / (firsts[a] + 13)) for a in letters for b in letters}

    def reads(self, *words: str) -> bool:
        """Whether letters follow each other, on average over the words, as they do in known ones; other letters than a to z count as
        the usual ones do, known words as good ones."""
        costs = [0.0 if w.lower() in self.rank else self.pairs.get(w.lower()[k : k + 2], READS) for w in words for k in range(len(w) - 1)]
        return sum(costs) <= READS * len(costs)

    def wordlike(self, value: str) -> bool:
        """Whether a value is made of what reads like words: joined by signs, or a name of several in one with few digits."""
        if any(not c.isalnum() and c not in JOINTS for c in value) or sum(c.isdigit() for c in value) > DIGITS:
            return False
        words = [w for w in re.split(r"[\W\d_]+", value) if w]
        parts = [p for w in words for p in ([w] if w.islower() or w.isupper() or w.istitle() else PARTS.findall(w))]
        letters, long = sum(map(len, words)), [p for p in parts if len(p) >= 3]
        whole = not any(c.isdigit() for c in value) and all(w.islower() or w.isupper() or w.istitle() for w in words)
        return bool(long) and (self.reads(*words) if whole else all(map(self.reads, long)) and sum(map(len, long)) >= SHARE * letters)

    def guesses(self, value: str) -> float:
        """The decimal logarithm of the guesses that the cheapest segmentation of the value takes."""
        if value not in self.known:
            if len(self.known) >= KEPT:
                self.known.clear()
            self.known[value] = self._guesses(value)
        return self.known[value]

    def _guesses(self, value: str) -> float:
        n = len(value)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # by end: (start, cost)
        for i, j, cost in spans(value, self.rank, self.longest):
            ends[j].append((i, cost))
        last, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)  # the last span is of a known kind, or brute force
        for j in range(1, n + 1):
            brute[j] = min(brute[j - 1], last[j - 1] + SPAN) + BRUTE
            last[j] = min([math.inf, *(min(last[i], brute[i]) + cost + SPAN for i, cost in ends[j])])
        return min(last[n], brute[n])

    def secret(self, text: str, start: int, end: int) -> tuple[int, int] | None:
        """Where a value in a credential's place is without the sentence's signs, if it is a secret."""
        while end > start and text[end - 1] in EDGES:
            end -= 1
        while start < end and text[start] in EDGES:
            start += 1
        value = text[start:end]
        if end - start < 6 or self.guesses(value) < GUESSES or ADDRESS.match(value) or GROUP.fullmatch(value) or self.wordlike(value):
            return None
        return start, end


@common.lean
def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, text): in how many documents a word is, and the hashes of at most LEAST different texts that have it, one a row."""
    shape = re.compile(rb"[a-z]{%d,%d}" % LETTERS)
    counts: Counter = Counter()
    texts: dict[bytes, set[int]] = {}

    def flat() -> pa.RecordBatch:
        rows = [(w, n if k == 0 else 0, t) for w, n in counts.items() for k, t in enumerate(texts[w])]
        words, n, t = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.record_batch([pa.array([w.decode() for w in words], pa.string()), pa.array(n, pa.int64()), pa.array(t, pa.int64())], names=["word", "n", "text"])

    for whole in batches:
        for batch in common.by_bytes(whole, "text"):
            for text in common.strings(batch.column(0)):
                low = text.lower()
                if any(m in low for m in MARKS):
                    low = CONTEXT.sub(" ", low)
                data = low.encode("utf-8", "replace")
                ident = int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)
                for w in {w for w in set(data.translate(None, b".,;:!?\"'()").split()) if shape.fullmatch(w)}:
                    counts[w] += 1
                    own = texts.setdefault(w, set())
                    if len(own) < LEAST:
                        own.add(ident)
            if len(counts) > 50_000:
                yield flat()
                counts.clear()
                texts.clear()
    yield flat()


def lexicon(docs: DataFrame, most: int = MOST, least: int = LEAST, texts: int = 1) -> tuple[str, ...]:
    """The words (a to z, 3 to 20 letters) that most documents have, `least` at least, `most` words at most, each in `texts`
    different texts (LEAST at most).

    All documents are counted, whole; what stands in a credential's place isn't, so that a leak that is copied over and over doesn't
    become a word, nor, where several texts are asked for, does any other word of one text and its copies. Different texts are
    counted by a sketch, which may take five for four. Words of about as many documents (an eighth of a doubling) are all taken or, at
    the cut, none, unless there would be no words then. Only the words that are kept go to the driver.
    """
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_word_counts, "word string, n long, text long")
    sums = rows.groupBy("word").agg(F.sum("n").alias("n"), F.approx_count_distinct("text", 0.1).alias("texts"))
    counts = common.stored(sums.where((F.col("n") >= least) & (F.col("texts") >= min(texts, LEAST))).select("word", "n"))
    step = F.floor(8 * F.log2(F.col("n").cast("double")))  # eight steps for each doubling
    levels, total, cut = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect(), 0, None
    for level in levels:
        total += level["count"]
        if total > most:
            break
        cut = level["step"]
    if cut is None and levels:  # more words in the first step than are wanted: the first of these
        found = counts.where(step == levels[0]["step"]).orderBy(F.desc("n"), "word").limit(most).collect()
    else:
        found = counts.where(step >= cut).collect() if levels else []
    return tuple(r["word"] for r in sorted(found, key=lambda r: (-r["n"], r["word"])))


_fixed = Guesser()


def scan(text: str, guesser: Guesser = _fixed) -> list[tuple[int, int, int]]:
    """(start, kind as a place in KINDS, end) of all secrets, in order; offsets are code points, ends exclusive."""
    found = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    low = text.lower()
    if any(m in low for m in MARKS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
        found += [(at[0], 3, at[1]) for m in CONTEXT.finditer(text) if (at := guesser.secret(text, *m.span(1)))]
    return sorted(found)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_KINDS = "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string"


def _scan(words: tuple[str, ...]):
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guesser = Guesser(words)
        for whole in batches:
            for batch in common.by_bytes(whole, "text"):
                all_ = [scan(t, guesser) for t in common.strings(batch.column(1))]
                base = [hashlib.sha256(spelled([x for x in s if x[1] < 3]).encode()).hexdigest() for s in all_]
                counts = {f"n_{name}": [sum(x[1] == k for x in s) for s in all_] for k, name in enumerate(KINDS)}
                yield common.emit({"doc_id": batch.column(0), **counts, "base_sha256": base, "spans": [spelled(s) for s in all_]}, schema)

    return common.lean(run)


def find_secrets(docs: DataFrame, words: tuple[str, ...] | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans) of every row's whole text.

    `words` are those that make a value easy to guess, the most frequent first; by default the `lexicon` of `docs`. Null counts
    as empty: no spans. Null doc_ids and repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    known = lexicon(docs, texts=LEAST) if words is None else words
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_scan(known), _KINDS)


def masked(text: str, guesser: Guesser = _fixed, mask: str = "[SECRET]") -> str:
    """The text with each stretch of overlapping secrets replaced."""
    out, at, end = [], 0, -1
    for a, _, b in scan(text, guesser):
        if a >= end:
            out += [text[at:a], mask]
        end = at = max(end, b)
    return "".join([*out, text[at:]])


def _mask(names: list[str], words: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guesser = Guesser(words)
        for whole in batches:
            for batch in common.by_bytes(whole, "text"):
                at = names.index("text")
                texts = batch.column(at).to_pylist()
                new = [t if t is None else masked(t, guesser) for t in texts]
                columns = list(batch.columns)
                columns[at] = pa.array(new, batch.schema.field(at).type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    old = columns[k].to_pylist()
                    columns[k] = pa.array([n if t == o else len(t) for n, t, o in zip(old, new, texts, strict=True)], batch.schema.field(k).type)
                yield pa.record_batch(columns, schema=batch.schema)

    return common.lean(run)


def mask_secrets(docs: DataFrame, words: tuple[str, ...] | None = None) -> DataFrame:
    """All rows and columns of `docs`, each secret in `text` replaced by [SECRET]; n_chars follows where the text changed."""
    return docs.mapInArrow(_mask(docs.columns, lexicon(docs, texts=LEAST) if words is None else words), docs.schema)
