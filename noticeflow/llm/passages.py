"""Substring dedup: near-duplicate passages by compact windows.

A text is the sequence of its five-word shingles. Under each of a few hash functions its Cartesian tree is taken: the least
hash at p is the min-hash of all subsequences within its compact window [l, r] that hold p, so the windows of a passage's
length and more stand for all passages. Windows of the same min-hash are grouped by the exact words around it, and each is
linked to one of its group. Groups by as many words as a passage has at least, but for a few, are tested as they are; of
groups by fewer words an interval join keeps the links whose windows overlap, in both texts, with those of enough other hash
functions. Each link is verified on the shingles themselves: extended both ways, over edits, as far as the similarity holds.

Passages that are equal word for word are all found: every one is in a group by its own words. Where one of such a group turns
out to share less than a passage, its windows are grouped once more, by every stretch of a passage's whole length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Fixed multipliers of a 64-bit mixing step.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Low bits of a hash that give way to the position, which makes hashes distinct in a window.
_LOW = np.uint64((1 << 20) - 1)
#: Distances, in words, of the contexts that group windows: the words from so far before the min-hash, or so far after it.
NEAR, FAR = 8, 20
#: Contexts on both sides, of nearly a passage's length: from one to the next so many places are shifted from behind to before.
SHIFT = 6
#: How far past a difference the next common shingle is looked for first; four times as far each time after.
GAP = 16
#: An odd factor, the powers of which tell the places of a stretch apart, and its inverse.
_B = 0x9E3779B97F4A7C15
_INVERSE = pow(_B, -1, 2**64)


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def compact_windows(hashes: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, l, r): all nodes of the texts' Cartesian trees whose window [l, r] has `least` places or more.

    hashes: of all texts one after the other, each followed by one place, in `ends`, that belongs to none. The nodes are the
    places that are least in some stretch of `least` places; the nearest smaller ones of a node are such nodes themselves, so
    that one pass with a stack over the nodes finds the windows.
    """
    n = len(hashes)
    if n < least:
        return (np.zeros(0, np.int64),) * 3
    at = np.arange(n, dtype=np.uint64)
    v = (hashes & ~_LOW) | (at & _LOW)
    v = np.where(hashes < _LOW, v | (_LOW + np.uint64(1)), v)
    v[ends] = 0
    low, width = v, 1
    while 2 * width <= least:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if least > width:
        low = np.minimum(low[: len(low) - (least - width)], low[least - width :])
    first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]] & (low != 0))
    p = np.unique(first + ((low[first].astype(np.int64) - first) & int(_LOW)))
    nodes = np.sort(np.concatenate([p, ends]))
    values, places = v[nodes].tolist(), nodes.tolist()
    left, right = [-1] * len(nodes), [n] * len(nodes)
    stack: list[int] = []
    for k, x in enumerate(values):
        while stack and values[stack[-1]] > x:
            right[stack.pop()] = places[k]
        left[k] = places[stack[-1]] if stack else -1
        stack.append(k)
    own = v[nodes] != 0
    return nodes[own], np.array(left, np.int64)[own] + 1, np.array(right, np.int64)[own] - 1


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(0, n - 1), np.uint64(base))])


class Stretches:
    """Hashes of stretches of a sequence of shingles, each in one step."""

    def __init__(self, h: np.ndarray):
        n = len(h) + 1
        self.sums = np.r_[np.uint64(0), np.add.accumulate(h * _powers(_B, n)[: len(h)])]
        self.back = _powers(_INVERSE, n)

    def hash(self, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        return mix((self.sums[after] - self.sums[first]) * self.back[first], 9)


def wide_contexts(least: int) -> list[tuple[int, int]]:
    """(places before, places behind): of any stretch of `least` places around a place, one of these lies within."""
    return [(b, max(0, least - 1 - (b + SHIFT - 1))) for b in range(0, least, SHIFT)]


def _contexts(h: np.ndarray, start: np.ndarray, end: np.ndarray, p: np.ndarray, least: int) -> np.ndarray:
    """(context, window): hashes of 1 to 65535 of the words around p, one-sided ones first; 0 where the text doesn't reach so far.

    Windows that only share such a hash are linked for nothing, which the verification shows.
    """
    stretches = Stretches(h)
    reach = [(NEAR, 0), (0, NEAR), (FAR, 0), (0, FAR), *wide_contexts(least)]
    out = np.zeros((len(reach), len(p)), np.uint16)
    for row, (before, behind) in enumerate(reach):
        inside = (p - before >= start) & (p + behind < end)
        x = stretches.hash(p[inside] - before, p[inside] + behind + 1)
        out[row, inside] = (x % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    return out


def _context_names(least: int) -> list[str]:
    return [f"c{k}" for k in range(4 + len(wide_contexts(least)))]


def _columns(least: int) -> list[str]:
    """Columns that hold two contexts each, or of a link found early the other window's p, l, r and its text in two halves."""
    return [f"x{k}" for k in range(max(5, (len(_context_names(least)) + 1) // 2))]


def _row(least: int) -> pa.Schema:
    """Of a window: kind is its hash function. Of a link found early: kind is -1 - 2 * function - wide."""
    return pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("th", pa.int64()), *((c, pa.int32()) for c in ("p", "l", "r", *_columns(least)))])


def _packed(rows: dict[str, np.ndarray], least: int) -> dict[str, np.ndarray]:
    names, n = _context_names(least), len(rows["p"])
    all_ = np.zeros((n, 2 * len(_columns(least))), np.uint16)
    for k, c in enumerate(names):
        all_[:, k] = rows[c]
    two = all_.view(np.int32)
    return {k: v for k, v in rows.items() if k not in names} | {c: two[:, k].copy() for k, c in enumerate(_columns(least))}


def _unpacked(rows: dict[str, np.ndarray], least: int) -> dict[str, np.ndarray]:
    columns = _columns(least)
    two = np.stack([rows[c] for c in columns], axis=1).view(np.uint16) if len(rows["p"]) else np.zeros((0, 2 * len(columns)), np.uint16)
    return {k: v for k, v in rows.items() if k not in columns} | {c: two[:, k] for k, c in enumerate(_context_names(least))}


#: wide: found in a group by nearly a passage's words.
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), *((c, pa.int32()) for c in ("j", "wide", "pa", "la", "ra", "pb", "lb", "rb"))])
LINKS = "a long, b long, key long, j int, wide int, pa int, la int, ra int, pb int, lb int, rb int"


def _spelled(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'int'}" for f in schema)


def _hashed(texts: list[bytes], n: int) -> list[np.ndarray]:
    """A hash of each n-word shingle of each text, mixed from the hashes of its words; none of texts with fewer words."""
    words = [t.lower().split() for t in texts]
    h = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(words)), np.uint64, sum(map(len, words)))
    out = h[: max(0, len(h) - n + 1)]
    for k in range(1, n):
        out = mix(out, k) ^ h[k : k + len(out)]
    out = mix(out, n)
    stops = np.cumsum([len(w) for w in words]).tolist()
    return [out[stop - len(w) : max(stop - len(w), stop - n + 1)] for w, stop in zip(words, stops, strict=True)]


def _windows(shingle: int, least: int, functions: int):
    """Rows of windows, and of links found within a piece of a partition; windows that others stand for go no further."""
    schema, names = _row(least), _context_names(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.by_bytes(whole, "text"):
                texts = dict(zip(batch.column(0).to_pylist(), common.utf8(batch.column(1)), strict=True))
                held = [(th, h) for th, h in zip(texts, _hashed(list(texts.values()), shingle), strict=True) if len(h) >= least]
                if not held:
                    continue
                sizes = np.array([len(h) + 1 for _, h in held])
                stops = np.cumsum(sizes)
                ends, begins = stops - 1, stops - sizes
                h = np.zeros(int(stops[-1]), np.uint64)
                for (_, x), s in zip(held, begins, strict=True):
                    h[s : s + len(x)] = x
                ths = np.array([th for th, _ in held], np.int64)
                for j in range(functions):
                    g = mix(h, j + 1)
                    p, left, right = compact_windows(g, ends, least)
                    if not len(p):
                        continue
                    doc = np.searchsorted(stops, p, side="right")
                    c, base = _contexts(h, begins[doc], ends[doc], p, least), begins[doc]
                    rows = {"kind": np.full(len(p), j, np.int32), "key": g[p].view(np.int64), "th": ths[doc], "p": (p - base).astype(np.int32), "l": (left - base).astype(np.int32), "r": (right - base).astype(np.int32), **dict(zip(names, c, strict=True))}
                    rows = _different(rows, names, least)
                    first, met = np.ones(len(rows["p"]), bool), _repeated(rows["key"])
                    links, first[met] = _star({k: v[met] for k, v in rows.items()}, names)
                    if n := len(links["a"]):
                        halves = links["b"].copy().view(np.int32).reshape(-1, 2)
                        early = {"kind": -1 - 2 * links["j"] - links["wide"], "key": links["key"], "th": links["a"], "p": links["pa"], "l": links["la"], "r": links["ra"], **dict.fromkeys(_columns(least), np.zeros(n, np.int32))}
                        early |= {"x0": links["pb"], "x1": links["lb"], "x2": links["rb"], "x3": halves[:, 0].copy(), "x4": halves[:, 1].copy()}
                        yield common.emit({k: pa.array(v) for k, v in early.items()}, schema)
                    yield common.emit({k: pa.array(v) for k, v in _packed({k: v[first] for k, v in rows.items()}, least).items()}, schema)

    return common.lean(run)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys are there more than once."""
    order = np.argsort(keys, kind="stable")
    twice = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order] = np.r_[False, twice] | np.r_[twice, False] if len(keys) else out
    return out


def _different(rows: dict[str, np.ndarray], names: list[str], least: int) -> dict[str, np.ndarray]:
    """Of windows of a text with the same min-hash and the same words around it, `least` places apart at least: others, of a text
    that repeats a few words, would find the same."""
    again = _repeated(rows["key"] ^ mix(rows["th"].view(np.uint64), 5).view(np.int64))
    keep = np.ones(len(again), bool)
    if again.any():
        part = {k: v[again] for k, v in rows.items()}
        order = np.lexsort((part["p"], *(part[c] for c in names), part["th"], part["key"]))
        same = np.ones(len(order), bool)
        same[:1] = False
        for c in ("key", "th", *names):
            same[1:] &= part[c][order][1:] == part[c][order][:-1]
        dropped, last = np.zeros(len(order), bool), 0
        for k, (at, alike) in enumerate(zip(part["p"][order].tolist(), same.tolist(), strict=True)):
            if alike and at - last < least:
                dropped[order[k]] = True
            else:
                last = at
        keep[again] = ~dropped
    return {k: v[keep] for k, v in rows.items()}


def _star(rows: dict[str, np.ndarray], names: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Links of each window to one text's with its min-hash and one of its contexts: the first or, of every other one-sided
    context, the last by hash, so that two texts, not one, stand for a group; and which windows are such ones.

    A window that is first in none of its contexts need go no further: others stand for it.
    """
    n = len(rows["key"])
    first, pairs = np.zeros(n, bool), [np.zeros((3, 0), np.int64)]
    by_text = np.lexsort((rows["p"], rows["th"]))
    place = np.empty(n, np.int64)
    place[by_text] = np.arange(n)
    for k, c in enumerate(names):
        some = np.flatnonzero(rows[c])
        order = some[np.lexsort((-place[some] if k in (1, 3) else place[some], rows[c][some], rows["key"][some]))]
        if not len(order):
            continue
        key, ctx = rows["key"][order], rows[c][order]
        fresh = np.r_[True, (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])]
        lead = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        first[order[fresh]] = True
        link = rows["th"][lead] != rows["th"][order]
        pairs.append(np.stack([lead[link], order[link], np.full(int(link.sum()), k >= 4)]))
    a, b, wide = np.concatenate(pairs, axis=1).astype(np.int64)
    a, b = np.where(rows["th"][a] > rows["th"][b], b, a), np.where(rows["th"][a] > rows["th"][b], a, b)
    order = np.lexsort((-wide, b, a))  # of links found in several groups one, as wide as any
    a, b, wide = a[order], b[order], wide[order]
    fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    a, b, wide = a[fresh], b[fresh], wide[fresh]
    out = {"a": rows["th"][a], "b": rows["th"][b], "key": rows["key"][a], "j": rows["kind"][a], "wide": wide.astype(np.int32)}
    for side, at in (("a", a), ("b", b)):
        out |= {x + side: rows[x][at] for x in "plr"}
    return out, first


def _meet(least: int):
    """Links of the windows of each min-hash; those found early pass through."""
    names = _context_names(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.runs(batches, "key"):
            column = {f: batch.column(k).to_numpy() for k, f in enumerate(batch.schema.names)}
            early = column["kind"] < 0
            if early.any():
                o = {k: v[early] for k, v in column.items()}
                code = -1 - o["kind"]
                other = np.stack([o["x3"], o["x4"]], axis=1).view(np.int64)[:, 0]
                named = {"a": o["th"], "b": other, "key": o["key"], "j": code >> 1, "wide": code & 1, "pa": o["p"], "la": o["l"], "ra": o["r"], "pb": o["x0"], "lb": o["x1"], "rb": o["x2"]}
                yield common.emit({k: pa.array(v) for k, v in named.items()}, _LINK)
            rows = {k: v[~early] for k, v in column.items()}
            if (many := _repeated(rows["key"])).any():
                links, _ = _star(_unpacked({k: v[many] for k, v in rows.items()}, least), names)
                if len(links["a"]):
                    yield common.emit({k: pa.array(v) for k, v in links.items()}, _LINK)

    return common.lean(run)


#: Two texts, the parts of them that their links' windows reach (and AROUND more places on either side), and the anchors.
_PAIR = "a long, b long, alo int, ahi int, blo int, bhi int, anchors binary"
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), *((c, pa.int32()) for c in ("alo", "ahi", "blo", "bhi")), ("anchors", pa.binary())])
AROUND = 256
#: An anchor: the places of a common shingle, and the min-hash of the group that it comes from (0: none that need be whole).
ANCHOR = np.dtype([("x", np.int32), ("y", np.int32), ("key", np.int64)])


#: Pairs of links that are tested at once; neighbours, among the links as much shifted, that a link is held against first; links
#: in one's reach, on average, from which on it is worth while to look in which text fewer are.
TESTED, BESIDE, MANY = 1 << 19, 4, 500


def supported(x: dict[str, np.ndarray], least: int, enough: int = 64, asked: np.ndarray | None = None) -> np.ndarray:
    """How many hash functions have a link whose windows overlap a link's in both texts; links sorted by a and b.

    Exact below `enough`, from which on no more are looked for; of links that aren't asked for it may be less. Most links have
    what they need from a neighbour. The others meet the links of each other function by the length of the window in a (or in b,
    if that leaves fewer), doubling: those in reach are then one stretch of each length.
    """
    own = np.int64(1) << x["j"].astype(np.int64)
    seen = own.copy()
    open_ = np.ones(len(own), bool) if asked is None else asked
    if not open_.any():
        return np.bitwise_count(seen)
    pair = np.cumsum(np.r_[False, (x["a"][1:] != x["a"][:-1]) | (x["b"][1:] != x["b"][:-1])])
    la, ra, lb, rb = (x[c].astype(np.int64) for c in ("la", "ra", "lb", "rb"))

    def overlap(u: np.ndarray, v: np.ndarray) -> np.ndarray:
        inside = np.minimum(ra[u], ra[v]) - np.maximum(la[u], la[v]) + 1 >= least
        return inside & (np.minimum(rb[u], rb[v]) - np.maximum(lb[u], lb[v]) + 1 >= least)

    order = np.lexsort((la, lb - la, pair))
    for d in range(1, BESIDE + 1):
        u, v = order[:-d], order[d:]
        on = (pair[u] == pair[v]) & overlap(u, v)
        seen[u] |= np.where(on, own[v], 0)
        seen[v] |= np.where(on, own[u], 0)
    open_ = np.flatnonzero(open_ & (np.bitwise_count(seen) < enough))
    bits = int(max(ra.max(), rb.max()) + 1).bit_length()

    def near(left: np.ndarray, right: np.ndarray, asks: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(function, its links with windows of a length, by place, and the first and the number of them in reach of each link)."""
        level = np.frexp((right - left).astype(float))[1].astype(np.int64)  # the least with right - left < 2 ** level
        kind = x["j"].astype(np.int64) << 6 | level
        base = pair[asks] << bits
        for c in np.unique(kind).tolist():
            to = np.flatnonzero(kind == c)
            key = (pair[to] << bits) + left[to]
            sort = np.argsort(key, kind="stable")
            first = np.searchsorted(key[sort], base + np.maximum(0, left[asks] + least - (1 << (c & 63))))
            size = np.searchsorted(key[sort], base + right[asks] - least + 1, side="right") - first
            yield c >> 6, to[sort], first, np.where(own[asks] == 1 << (c >> 6), 0, size)

    total = lambda *ends: sum((size for *_, size in near(*ends, open_)), np.zeros(len(open_), np.int64))
    by_a = np.ones(len(open_), bool)
    if len(open_) > MANY and (in_a := total(la, ra)).sum() > MANY * len(open_):
        by_a = in_a <= total(lb, rb)
    for ends, asks in (((la, ra), open_[by_a]), ((lb, rb), open_[~by_a])):
        for j, to, first, size in near(*ends, asks) if len(asks) else ():
            some = np.flatnonzero((size > 0) & (np.bitwise_count(seen[asks]) < enough))
            if not len(some):
                continue
            at, first, size = asks[some], first[some], size[some]
            sums = np.cumsum(size)
            cuts = np.unique(np.r_[0, np.searchsorted(sums, np.arange(TESTED, sums[-1], TESTED)), len(at)]).tolist()
            for i, k in pairwise(cuts):
                begin = sums[i:k] - size[i:k]
                other = to[np.arange(begin[0], sums[k - 1]) + np.repeat(first[i:k] - begin, size[i:k])]
                on = np.logical_or.reduceat(overlap(np.repeat(at[i:k], size[i:k]), other), begin - begin[0])
                seen[at[i:k][on]] |= 1 << j
    return np.bitwise_count(seen)


def _reach(x: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, pa.Array]:
    ends = {f"{side}lo": np.maximum(0, np.minimum.reduceat(x["l" + side], starts) - AROUND) for side in "ab"}
    ends |= {f"{side}hi": np.maximum.reduceat(x["r" + side], starts) + AROUND for side in "ab"}
    return {k: pa.array(v.astype(np.int32)) for k, v in ends.items()}


def _possible(x: dict[str, np.ndarray], enough: int) -> dict[str, np.ndarray]:
    """The links, sorted by a and b, of pairs that have a wide one or links of `enough` hash functions: no other can be supported."""
    starts = np.flatnonzero(np.r_[True, (x["a"][1:] != x["a"][:-1]) | (x["b"][1:] != x["b"][:-1])])
    seen = np.bitwise_or.reduceat(np.int64(1) << x["j"].astype(np.int64), starts)
    able = (np.maximum.reduceat(x["wide"], starts) > 0) | (np.bitwise_count(seen) >= enough)
    keep = np.repeat(able, np.diff(np.r_[starts, len(x["a"])]))
    return {k: v[keep] for k, v in x.items()}


def _support(least: int, enough: int):
    """The interval join: links of a pair of texts that are wide, or whose windows overlap in both with those of `enough` hash functions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.runs(batches, "a"):
            x = {f: batch.column(k).to_numpy() for k, f in enumerate(batch.schema.names)}
            x = _possible(x, enough)
            if not len(x["a"]):
                continue
            order = np.lexsort((x["pb"], x["pa"], x["j"], x["la"], x["b"], x["a"]))
            x = {k: v[order] for k, v in x.items()}
            fresh = np.ones(len(order), bool)  # links of copies come again
            fresh[1:] = np.any([x[c][1:] != x[c][:-1] for c in ("a", "b", "j", "wide", "pa", "pb")], axis=0)
            x = {k: v[fresh] for k, v in x.items()}
            good = (x["wide"] > 0) | (supported(x, least, enough, x["wide"] == 0) >= enough)
            if not good.any():
                continue
            x = {k: v[good] for k, v in x.items()}
            x["key"] = np.where(x["wide"] > 0, x["key"], 0)
            order = np.lexsort((x["key"], x["pb"], x["pa"], x["b"], x["a"]))
            x = {k: v[order] for k, v in x.items()}
            starts = np.flatnonzero(np.r_[True, (x["a"][1:] != x["a"][:-1]) | (x["b"][1:] != x["b"][:-1])])
            fresh = np.ones(len(order), bool)
            fresh[1:] = np.any([x[c][1:] != x[c][:-1] for c in ("a", "b", "pa", "pb", "key")], axis=0)
            all_ = np.empty(int(fresh.sum()), ANCHOR)
            all_["x"], all_["y"], all_["key"] = x["pa"][fresh], x["pb"][fresh], x["key"][fresh]
            cuts = np.r_[(np.cumsum(fresh) - 1)[starts], len(all_)].tolist()
            anchors = [all_[i:k].tobytes() for i, k in pairwise(cuts)]
            yield common.emit({"a": pa.array(x["a"][starts]), "b": pa.array(x["b"][starts]), **_reach(x, starts), "anchors": anchors}, _PAIRS)

    return common.lean(run)


def _sequences(shingle: int):
    schema = pa.schema([("th", pa.int64()), ("h", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.by_bytes(whole, "text"):
                own = dict(zip(batch.column(0).to_pylist(), common.utf8(batch.column(1)), strict=True))
                yield common.emit({"th": list(own), "h": [h.view(np.int64) for h in _hashed(list(own.values()), shingle)]}, schema)

    return common.lean(run)


#: For stretches of so many places at most all are compared with all.
ALL = 256
#: The pairs of GAP places by their sum, as flat numbers.
_NEAREST = np.argsort(np.add.outer(np.arange(GAP), np.arange(GAP)).ravel(), kind="stable")


def _next_common(a: np.ndarray, b: np.ndarray, most: int) -> tuple[int, int] | None:
    """The least (places in a, places in b) by their sum to a common shingle, neither over `most`."""
    reach = GAP
    while True:
        near_a, near_b = a[: min(reach, most + 1)], b[: min(reach, most + 1)]
        if len(near_a) == len(near_b) == GAP:
            met = (near_a[:, None] == near_b).ravel()
            k = int(_NEAREST[met[_NEAREST].argmax()])
            if met[k]:
                return divmod(k, GAP)
        elif reach == GAP:
            u, v = (near_a[:, None] == near_b).nonzero()
            if len(u):
                k = int(np.argmin(u + v))
                return int(u[k]), int(v[k])
        elif reach <= ALL:
            u, v = (near_a[:, None] == near_b).nonzero()
            if len(u):
                least = np.flatnonzero(u + v == (u + v).min())
                k = least[np.argmin(near_a[u[least]])]
                return int(u[k]), int(v[k])
        else:
            _, u, v = np.intersect1d(near_a, near_b, return_indices=True)  # of each the first place
            if len(u):
                k = int(np.argmin(u + v))
                return int(u[k]), int(v[k])
        if reach > most or reach >= max(len(a), len(b)):
            return None
        reach *= 4


def _run(a: np.ndarray, b: np.ndarray) -> int:
    """How many places a and b begin with in common."""
    n, size = min(len(a), len(b)), 64
    done = 0
    while done < n:
        differ = a[done : min(n, done + size)] != b[done : min(n, done + size)]
        k = int(differ.argmax())
        if differ[k]:
            return done + k
        done, size = done + len(differ), 8 * size
    return n


class _Way:
    """The runs that a and b have in common from their beginnings on, and the steps between them, each found once."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b = a, b
        self.runs: list[int] = []
        self.steps: list[tuple[tuple[int, int] | None, int]] = []

    def run(self, k: int, i: int, j: int) -> int:
        if k == len(self.runs):
            self.runs.append(_run(self.a[i:], self.b[j:]))
        return self.runs[k]

    def step(self, k: int, i: int, j: int, most: int) -> tuple[int, int] | None:
        """What `_next_common` finds: the same for a lesser bound, unless over it, and for a greater one that shows no nearer place."""
        if k < len(self.steps):
            known, bound = self.steps[k]
            if (most <= bound or known and sum(known) <= bound) and max(known or (0,)) <= most:
                return known
            del self.steps[k:], self.runs[k + 1 :]
        found = _next_common(self.a[i:], self.b[j:], most)
        self.steps.append((found, most))
        return found


def _grow(way: _Way, same: int, la: int, lb: int, similarity: float) -> tuple[int, int, int, int, int]:
    """How far a and b go on alike from their beginnings, (places, places, same, la, lb), given what is alike before them."""
    end_a, end_b = len(way.a), len(way.b)
    i = j = gone_a = gone_b = k = 0
    best = (0, 0, same, la, lb)
    while i < end_a and j < end_b:
        run = way.run(k, i, j)
        i, j, same = i + run, j + run, same + run
        la, lb = la + run + gone_a, lb + run + gone_b
        gone_a = gone_b = 0
        if same >= similarity * (la + lb - same):
            best = (i, j, same, la, lb)
        # With all that can still be alike, so many differences at most leave the similarity.
        could = same + min(end_a - i, end_b - j)
        most = int(could / similarity) - (la + lb - same) - (could - same)
        if most < 0 or i >= end_a or j >= end_b or (step := way.step(k, i, j, most)) is None:
            break
        gone_a, gone_b = step
        i, j, k = i + gone_a, j + gone_b, k + 1
    return best


def extend(a: np.ndarray, b: np.ndarray, x: int, y: int, similarity: float) -> tuple[int, int, int, int]:
    """The widest (start, end) in a and in b around the common shingle at (x, y) whose shingles stay similar, edits between.

    From the end of a run in common, the next common place on both sides, the nearest by their sum, goes on, as far as the
    similarity can still be reached. What one side lacks the other can make good, so that they grow in turn.
    """
    sides = (_Way(a[x:], b[y:]), _Way(a[:x][::-1], b[:y][::-1]))
    ends, own = [(0, 0), (0, 0)], [(0, 0, 0), (0, 0, 0)]
    for k in (0, 1, 0, 1, 0, 1):
        other = own[1 - k]
        i, j, *all_ = _grow(sides[k], *other, similarity)
        same = (i, j) == ends[k]
        ends[k], own[k] = (i, j), tuple(u - v for u, v in zip(all_, other, strict=True))
        if same and (k or ends[1] != (0, 0)):  # nothing more for the other side
            break
    (right_a, right_b), (left_a, left_b) = ends
    return x - left_a, x + right_a, y - left_b, y + right_b


def shared(ha: np.ndarray, hb: np.ndarray, anchors: np.ndarray, least: int, similarity: float) -> tuple[list[tuple[int, int, int, int]], np.ndarray]:
    """Stretches that two sequences share around the anchors, and which anchors lie in one."""
    spans: list[tuple[int, int, int, int]] = []
    x, y = anchors["x"].astype(np.int64), anchors["y"].astype(np.int64)
    open_ = (x >= 0) & (y >= 0) & (x < len(ha)) & (y < len(hb))
    open_[open_] = ha[x[open_]] == hb[y[open_]]
    held = np.zeros(len(anchors), bool)
    while open_.any():
        k = int(np.argmax(open_))
        s, e, t, f = extend(ha, hb, int(x[k]), int(y[k]), similarity)
        good = False
        if min(e - s, f - t) >= least:
            p, q = np.unique(ha[s:e]), np.unique(hb[t:f])
            both = len(np.intersect1d(p, q, assume_unique=True))
            if good := both >= similarity * (len(p) + len(q) - both):
                spans.append((s, e, t, f))
        # What lies within the stretch, as much shifted, would lead to the same one.
        within = (x >= s) & (x < e) & (y >= t) & (y < f) & (np.abs((x - y) - (s - t)) <= abs((e - s) - (f - t)) + GAP)
        within[k] = True
        held |= within & good
        open_ &= ~within
    return spans, held


_TESTED = "a long, b long, sa int, ea int, sb int, eb int, grp long"


def _verify(least: int, similarity: float):
    """Spans (grp 0), and of each wide link that doesn't hold its group."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), *((c, pa.int32()) for c in ("sa", "ea", "sb", "eb")), ("grp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k in range(batch.num_rows):
                a, b, low_a, low_b = (batch.column(c)[k].as_py() for c in range(4))
                anchors = np.frombuffer(batch.column(4)[k].as_py(), ANCHOR).copy()
                ha, hb = (batch.column(c)[k].values.to_numpy() for c in (5, 6))
                anchors["x"] -= low_a
                anchors["y"] -= low_b
                spans, held = shared(ha, hb, anchors, least, similarity)
                out += [(a, b, s + low_a, e + low_a, t + low_b, f + low_b, 0) for s, e, t, f in spans]
                out += [(a, b, 0, 0, 0, 0, key) for key in np.unique(anchors["key"][~held]).tolist() if key]
            yield common.emit(dict(zip(schema.names, map(list, zip(*out, strict=True)) if out else [[]] * 7, strict=True)), schema)

    return common.lean(run)


@common.lean
def _wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, th, p): both windows of each wide link of the pairs."""
    for batch in batches:
        for k in range(batch.num_rows):
            anchors = np.frombuffer(batch.column(2)[k].as_py(), ANCHOR)
            anchors = anchors[anchors["key"] != 0]
            if n := len(anchors):
                sides = np.repeat([batch.column(0)[k].as_py(), batch.column(1)[k].as_py()], n)
                yield pa.record_batch([pa.array(np.tile(anchors["key"], 2)), pa.array(sides), pa.array(np.concatenate([anchors["x"], anchors["y"]]))], names=["grp", "th", "p"])


def _stretches(least: int):
    """(w, th, s): a hash of each stretch of `least` shingles of a text that one of the places p is in."""
    schema = pa.schema([("w", pa.int64()), ("th", pa.int64()), ("s", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                h, p = batch.column(1)[k].values.to_numpy().view(np.uint64), batch.column(2)[k].values.to_numpy()
                s = np.unique((p[:, None] - np.arange(least)).ravel())
                s = s[(s >= 0) & (s + least <= len(h))].astype(np.int64)
                if len(s):
                    w = Stretches(h).hash(s, s + least).view(np.int64)
                    yield common.emit({"w": pa.array(w), "th": pa.array(np.full(len(s), batch.column(0)[k].as_py(), np.int64)), "s": pa.array(s.astype(np.int32))}, schema)

    return common.lean(run)


def _equal(least: int):
    """Spans of the pairs of texts that equal stretches lead to: those that follow each other, as much shifted, are one."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), *((c, pa.int32()) for c in ("sa", "ea", "sb", "eb")), ("grp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.runs(batches, "a"):
            a, b, x, y = (batch.column(k).to_numpy() for k in range(4))
            shift = y - x
            order = np.lexsort((x, shift, b, a))
            a, b, x, shift = a[order], b[order], x[order], shift[order]
            new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (shift[1:] != shift[:-1]) | (x[1:] - x[:-1] > least)]
            first = np.flatnonzero(new)
            s, e = x[first], x[np.r_[first[1:], len(x)] - 1] + least
            columns = (a[first], b[first], s, e, s + shift[first], e + shift[first], np.zeros(len(first), np.int64))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return common.lean(run)


def _whole(texts: DataFrame, pairs: DataFrame, tested: DataFrame, shingle: int, least: int) -> DataFrame | None:
    """Spans in the groups of which a wide link didn't hold: their texts meet by every stretch of a passage's whole length.

    All that have a stretch in common share a passage with the first of them, so that no link between any two is lost.
    """
    broken = common.stored(tested.where("grp <> 0").select("grp").distinct())
    if broken.isEmpty():
        return None
    wide = pairs.select("a", "b", "anchors").mapInArrow(_wide, "grp long, th long, p int")
    near = common.maybe_in(wide, "grp", common.bitmap(broken), "_maybe").where("_maybe").join(broken, "grp", "left_semi")
    members = common.stored(near.select("th", "p").distinct())
    places = members.groupBy("th").agg(F.collect_set("p").alias("p"))  # no more than the text has words
    own = _chosen(texts, members.select("th"), shingle).join(places, "th").select("th", "h", "p")
    rows = common.stored(own.mapInArrow(_stretches(least), "w long, th long, s int"))
    first = rows.groupBy("w").agg(F.min(F.struct("th", "s")).alias("f"), F.max("th").alias("other")).where("other <> f.th")
    met = rows.join(common.stored(first.select("w", F.col("f.th").alias("a"), F.col("f.s").alias("x"))), "w").where("th <> a")
    pairs = met.select("a", F.col("th").alias("b"), "x", F.col("s").alias("y")).repartition("a", "b").sortWithinPartitions("a", "b")
    return common.stored(pairs.mapInArrow(_equal(least), _TESTED))


def passages(docs: DataFrame, words: int = 51, shingle: int = 5, similarity: float = 0.8, functions: int = 4, enough: int = 2) -> DataFrame:
    """(doc_id, start, end, class_id, kind, n_docs): passages of `words` words or more that other documents have as well.

    start and end count words of the lower-cased (A-Z) text, the end exclusive. kind is `passage` for stretches found in
    different texts, `copy` for whole texts of any length that several rows have (then from 0 to the number of words, 0 for
    blank ones). Passages of one text that overlap are one. class_id is the smallest doc_id of the passages linked to each
    other; n_docs how many rows are in the class. Rows of equal texts each get the passages of their text.

    Two passages are linked if their sets of `shingle`-word shingles have a Jaccard similarity of `similarity` or more. Equal
    ones are all found. Of others those are found whose min-hash one of four (`functions`) hash functions shares in a group by
    nearly a passage's words, or two (`enough`) of them, 97 of 100 pairs at a similarity of 0.8, in groups by fewer words of
    which one that stands for the group has the passage as well (tests/llm/test_passages.py measures the recall over all
    pairs). Of a text that repeats a few words over and over, the ends of what it shares may stay unmarked. Null texts count as empty; null doc_ids stay and are
    nobody's class_id unless alone; repeated rows are copies; an empty table gives no rows; other columns are ignored.
    """
    least = words - shingle + 1
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    th = common.text_hash(docs)
    texts = docs.select(th.alias("th"), text.alias("text"))
    ids = common.stored(docs.select(F.col("doc_id").cast("long"), th.alias("th"), text.alias("text")).mapInArrow(_counted, "doc_id long, th long, n int"))
    rows = texts.mapInArrow(_windows(shingle, least, functions), _spelled(_row(least)))
    links = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(least), LINKS)
    pairs = common.stored(links.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(_support(least, enough), _PAIR))
    tested = common.stored(_verified(texts, pairs, shingle, least, similarity))
    more = _whole(texts, pairs, tested, shingle, least)
    spans = (tested if more is None else tested.union(more)).where("grp = 0").drop("grp")
    places = spans.select(F.col("a").alias("th"), F.col("sa").alias("s"), F.col("ea").alias("e")).union(spans.select("b", "sb", "eb")).distinct()
    order = Window.partitionBy("th").orderBy("s", "e")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("s") >= reach), F.col("s"))
    merged = common.stored(
        places.withColumn("new", new).withColumn("first", F.last("new", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .select("th", "s", "e", F.xxhash64("th", "first").alias("node"), "first")
    )
    at = lambda t, s, e, name: merged.select(F.col("th").alias(t), F.col("s").alias(s), F.col("e").alias(e), F.col("node").alias(name))
    edges = spans.join(at("a", "sa", "ea", "na"), ["a", "sa", "ea"]).join(at("b", "sb", "eb", "nb"), ["b", "sb", "eb"]).select(F.col("na").alias("a"), F.col("nb").alias("b"))
    roots = common.components(edges)
    nodes = merged.groupBy("th", "node", "first").agg(F.max("e").alias("end")).join(roots, "node")
    found = ids.join(nodes, "th").select("doc_id", F.col("first").alias("start"), (F.col("end") + shingle - 1).alias("end"), "root", F.lit("passage").alias("kind"))
    often = ids.groupBy("th").agg(F.count("*").alias("c")).where("c > 1").select("th")
    copies = ids.join(often, "th").select("doc_id", F.lit(0).alias("start"), F.col("n").alias("end"), F.col("th").alias("root"), F.lit("copy").alias("kind"))
    all_ = common.stored(found.union(copies))
    classes = common.stored(all_.groupBy("root", "kind").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_docs")))
    return all_.join(classes, ["root", "kind"]).select("doc_id", "start", "end", "class_id", "kind", "n_docs")


@common.lean
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = pa.array([len(t.split()) for t in common.utf8(batch.column(2))], pa.int32())
        yield pa.record_batch([batch.column(0), batch.column(1), n], names=["doc_id", "th", "n"])


def _chosen(texts: DataFrame, ths: DataFrame, shingle: int) -> DataFrame:
    """(th, h): the shingles of the texts of these hashes, and of a few more."""
    chosen = common.maybe_in(texts, "th", common.bitmap(ths), "_maybe").where("_maybe").select("th", "text")
    return chosen.mapInArrow(_sequences(shingle), "th long, h array<long>").dropDuplicates(["th"])


def _verified(texts: DataFrame, pairs: DataFrame, shingle: int, least: int, similarity: float) -> DataFrame:
    """(a, b, sa, ea, sb, eb, grp): the spans, in shingles, that candidate pairs really share (grp 0), and their wide links."""
    sequences = _chosen(texts, pairs.select(F.col("a").alias("th")).union(pairs.select("b")), shingle)
    part = lambda h, lo, hi: F.slice(h, F.col(lo) + 1, F.col(hi) - F.col(lo) + 1)
    cut = pairs.join(sequences.withColumnRenamed("th", "a"), "a").select("a", "b", "alo", "blo", "bhi", "anchors", part("h", "alo", "ahi").alias("ha"))
    both = cut.join(sequences.select(F.col("th").alias("b"), "h"), "b").select("a", "b", "alo", "blo", "anchors", "ha", part("h", "blo", "bhi").alias("hb"))
    return both.mapInArrow(_verify(least, similarity), _TESTED)
