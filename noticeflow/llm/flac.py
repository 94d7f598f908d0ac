"""FLAC media columns: texts stored as 8-bit samples, and streams decoded to PCM blocks with seekable sample offsets.

Frames of a batch are coded side by side: one step handles the same sample of all frames, so that Rice residuals decode at
the pace of array operations. Streams have a seek point for each frame. Every header's CRC-8, every frame's CRC-16 and the
stream's MD5 are verified.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Samples in a block, and the sample rate that streams carry.
BLOCK, RATE = 192, 8000
#: Frames coded side by side.
LANES = 1 << 13
#: Fixed values of the format: block sizes, bits of a sample and sample rates that need no more bytes, by their codes.
BLOCK_SIZES = [0, 192, 576, 1152, 2304, 4608, 0, 0, 256, 512, 1024, 2048, 4096, 8192, 16384, 32768]
SAMPLE_BITS = [0, 8, 12, 0, 16, 20, 24, 32]


class FlacError(ValueError):
    """A stream that is broken, or uses what this reader doesn't read (several channels)."""


def _table(poly: int, bits: int, width: int) -> np.ndarray:
    """The remainders of all `width`-bit words."""
    x = np.arange(1 << width, dtype=np.uint64) << np.uint64(bits - width if bits > width else 0)
    for _ in range(width):
        top = x >> np.uint64(bits - 1) & np.uint64(1)
        x = (x << np.uint64(1) & np.uint64((1 << bits) - 1)) ^ top * np.uint64(poly)
    return x.astype(np.uint16 if bits == 16 else np.uint8)


_CRC8, _CRC16 = _table(0x07, 8, 8), _table(0x8005, 16, 16)
_ZEROS16 = np.array([16 - int(x).bit_length() for x in range(1 << 16)], np.uint8)


def _aligned(buf: np.ndarray, start: np.ndarray, size: np.ndarray, even: bool = False) -> np.ndarray:
    """(byte, frame): frames aligned at their ends, zeros before them; zeros before don't change a CRC that begins at zero."""
    most = int(size.max())
    most += most % 2 if even else 0
    at = start + size - most
    index = at[None, :] + np.arange(most)[:, None]
    return np.where(index >= start[None, :], buf[np.maximum(index, 0)], 0)


def crc8(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.zeros(len(start), np.uint8)
    for row in _aligned(buf, start, size):
        out = _CRC8[out ^ row]
    return out


def crc16(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.zeros(len(start), np.uint16)
    rows = _aligned(buf, start, size, even=True).astype(np.uint16)
    for a, b in zip(rows[::2], rows[1::2], strict=True):
        out = _CRC16[out ^ (a << 8 | b)]
    return out


def _number(n: int) -> bytes:
    """A frame number as the format writes it, in one to seven bytes."""
    if n < 0x80:
        return bytes([n])
    more = next(k for k in range(1, 7) if n < 1 << (6 - k + 6 * k))
    return bytes([(0xFF00 >> (more + 1) & 0xFF) | n >> 6 * more, *(0x80 | n >> 6 * k & 0x3F for k in reversed(range(more)))])


def encode_frames(x: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, their end offsets) of 8-bit mono frames; x: (frame, sample), of one block size.

    Each frame takes the cheapest of: constant, verbatim, fixed predictors of order 0 to 2 with one Rice parameter.
    """
    n, size = x.shape
    x = x.astype(np.int16)
    best = np.full(n, 8 * size, np.int64)
    kind, rice = np.full(n, -1), np.zeros(n, np.int64)
    residual, held = x, {}
    for order in range(min(3, size)):
        residual = residual if order == 0 else np.diff(residual, axis=1)
        u = ((residual << 1) ^ (residual >> 15)).astype(np.uint16)
        held[order] = u
        low = np.floor(np.log2(np.maximum(u.mean(axis=1), 1))).astype(np.int64)
        for k in (np.maximum(low - 1, 0), low):
            cost = 8 * order + 10 + (k + 1) * u.shape[1] + (u >> k[:, None].astype(np.uint16)).sum(axis=1, dtype=np.int64)
            better = cost < best
            best[better], kind[better], rice[better] = cost[better], order, k[better]
    constant = (x == x[:, :1]).all(axis=1)
    kind[constant], best[constant] = -2, 8
    code = BLOCK_SIZES.index(size) if size in BLOCK_SIZES[1:] else 6 if size <= 256 else 7
    extra = b"" if code not in (6, 7) else struct.pack(">B" if code == 6 else ">H", size - 1)
    heads = [bytes([0xFF, 0xF8, code << 4 | 4, 2]) + _number(int(i)) + extra for i in numbers]
    head = np.array([len(h) for h in heads])
    body = 1 + (best + 7) // 8
    ends = np.cumsum(head + 1 + body + 2)
    starts = np.r_[0, ends[:-1]]
    buf = np.zeros(int(ends[-1]), np.uint8)
    flat = np.frombuffer(b"".join(heads), np.uint8)
    buf[np.repeat(starts - np.r_[0, np.cumsum(head)[:-1]], head) + np.arange(len(flat))] = flat
    buf[starts + head] = crc8(buf, starts, head)
    at = starts + head + 1
    buf[at] = np.where(kind == -2, 0, np.where(kind == -1, 2, (8 + kind) << 1))
    raw = (x & 0xFF).astype(np.uint8)
    buf[at[constant] + 1] = raw[constant, 0]
    v = np.flatnonzero(kind == -1)
    buf[at[v][:, None] + 1 + np.arange(size)] = raw[v]
    places, values = [], []
    for order, u in held.items():
        f = np.flatnonzero(kind == order)
        if not len(f):
            continue
        buf[at[f][:, None] + 1 + np.arange(order)] = raw[f, :order]
        k = rice[f]
        first = 8 * (at[f] + 1 + order)
        k32 = k.astype(np.int32)[:, None]
        mine = u[f]
        q = mine >> k[:, None].astype(np.uint16)
        pos = np.cumsum(q + (1 + k)[:, None].astype(np.uint16), axis=1, dtype=np.int32)
        pos += (first + 9).astype(np.int32)[:, None] - k32
        codes = (1 << k32) | (mine & ((1 << k) - 1)[:, None].astype(np.uint16))
        for p, w, c in ((first + 6, 4, k), (pos, k32 + 1, codes)):
            word = (c << (24 - (p & 7) - w)).ravel()
            p = (p >> 3).ravel()
            for j in range(3):
                places.append(p + j)
                values.append((word >> (16 - 8 * j)).astype(np.uint8))
    if places:  # no two codes share a bit, so that sums are unions
        size = len(buf) + 2
        for where, what in zip(places, values, strict=True):
            some = np.flatnonzero(what)
            buf += np.bincount(where[some], weights=what[some], minlength=size)[: len(buf)].astype(np.uint8)
    sums = crc16(buf, starts, ends - starts - 2)
    buf[ends - 2], buf[ends - 1] = sums >> 8, sums & 0xFF
    return buf, ends


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream for each payload of bytes, each byte b as the sample b - 128."""
    jobs: dict[int, list[tuple[int, int]]] = {}  # by block size: (payload, frame)
    arrays = [np.frombuffer(p, np.uint8).astype(np.int16) - 128 for p in payloads]
    frames: list[list[bytes]] = [[b""] * -(-len(a) // BLOCK) for a in arrays]
    for i, a in enumerate(arrays):
        whole, rest = divmod(len(a), BLOCK)
        if whole:
            jobs.setdefault(BLOCK, []).extend((i, k) for k in range(whole))
        if rest:
            jobs.setdefault(rest, []).append((i, whole))
    for size, todo in jobs.items():
        for s in range(0, len(todo), LANES):
            part = todo[s : s + LANES]
            if size == BLOCK:
                x = np.concatenate([arrays[i][a * BLOCK : (b + 1) * BLOCK] for i, a, b in _spans(part)]).reshape(-1, BLOCK)
            else:
                x = np.stack([arrays[i][k * BLOCK : k * BLOCK + size] for i, k in part])
            buf, ends = encode_frames(x, np.array([k for _, k in part]))
            data, start = buf.tobytes(), 0
            for (i, k), end in zip(part, ends.tolist(), strict=True):
                frames[i][k] = data[start:end]
                start = end
    return [_stream(payloads[i], a, frames[i]) for i, a in enumerate(arrays)]


def _spans(part: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(payload, first frame, last frame) of runs in (payload, frame) pairs."""
    start = part[0]
    last = start
    for now in part[1:]:
        if now[0] != last[0]:
            yield start[0], start[1], last[1]
            start = now
        last = now
    yield start[0], start[1], last[1]


def _stream(payload: bytes, samples: np.ndarray, frames: list[bytes]) -> bytes:
    sizes = [len(f) for f in frames]
    pcm = hashlib.md5(samples.astype(np.int8).tobytes()).digest()
    low, high = (min(sizes), max(sizes)) if sizes else (0, 0)
    info = struct.pack(">HH", BLOCK, BLOCK) + low.to_bytes(3, "big") + high.to_bytes(3, "big")
    info += (RATE << 44 | 0 << 41 | 7 << 36 | len(samples)).to_bytes(8, "big") + pcm
    seek = np.zeros(len(frames), np.dtype([("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")]))
    seek["sample"] = np.arange(len(frames)) * BLOCK
    seek["offset"] = np.cumsum([0, *sizes[:-1]]) if sizes else []
    seek["n"] = np.minimum(BLOCK, len(samples) - seek["sample"].astype(np.int64))
    points = seek[: (1 << 24) // 18 - 1].tobytes()
    return b"".join([b"fLaC", bytes([0]), (34).to_bytes(3, "big"), info, bytes([0x83]), len(points).to_bytes(3, "big"), points, *frames])


def _metadata(data: bytes) -> tuple[dict, int]:
    if data[:4] != b"fLaC":
        raise FlacError("no FLAC stream")
    at, last, found = 4, False, {"seek": [(0, 0)]}
    while not last:
        if at + 4 > len(data):
            raise FlacError("metadata is cut off")
        last, kind, size = bool(data[at] & 0x80), data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
        block = data[at + 4 : at + 4 + size]
        if kind == 0:
            x = int.from_bytes(block[10:18], "big")
            found |= {"rate": x >> 44, "channels": (x >> 41 & 7) + 1, "bits": (x >> 36 & 31) + 1, "total": x & (1 << 36) - 1, "md5": block[18:34]}
        elif kind == 3:
            t = np.frombuffer(block[: size // 18 * 18], np.dtype([("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")]))
            t = t[t["sample"] != 2**64 - 1]
            if len(t) and t["sample"][0] == 0:
                found["seek"] = list(zip(t["sample"].tolist(), t["offset"].tolist(), strict=True))
        at += 4 + size
    if "total" not in found or found["channels"] != 1:
        raise FlacError("no stream information" if "total" not in found else "more than one channel")
    return found, at


def _headers(buf: np.ndarray, at: np.ndarray, bits: np.ndarray) -> dict[str, np.ndarray]:
    b = [buf[at + k].astype(np.int64) for k in range(5)]
    if ((b[0] << 8 | b[1]) >> 1 != 0xFFF8 >> 1).any() or (b[3] >> 4).any():
        raise FlacError("no frame of one channel where one should begin")
    lead = _ZEROS16[(~b[4].astype(np.uint8)).astype(np.uint16)].astype(np.int64) - 8
    digits = np.where(lead > 0, lead, 1)
    size, end = np.array(BLOCK_SIZES)[b[2] >> 4], at + 4 + digits
    eight, sixteen = b[2] >> 4 == 6, b[2] >> 4 == 7
    size = np.where(eight, buf[end].astype(np.int64) + 1, np.where(sixteen, (buf[end].astype(np.int64) << 8 | buf[end + 1]) + 1, size))
    end = end + eight + 2 * sixteen
    rate = b[2] & 15
    end = end + (rate == 12) + 2 * ((rate == 13) | (rate == 14))
    width = np.array(SAMPLE_BITS)[b[3] >> 1 & 7]
    if (crc8(buf, at, end - at) != buf[end]).any():
        raise FlacError("a frame header's checksum is wrong")
    return {"size": size, "bits": np.where(width == 0, bits, width), "body": end + 1}


def _rice(words: np.ndarray, pos: np.ndarray, k: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sample, frame) residuals of frames that begin at these bits, and the bits where they end."""
    out = np.empty((n, len(pos)), np.int64)
    k = k.astype(np.uint64)
    after, one = np.uint64(63) - k, np.uint64(1)
    for i in range(n):
        word = words[pos >> 3].astype(np.uint64) << (pos & 7).astype(np.uint64)
        q = _ZEROS16[word >> np.uint64(48)].astype(np.uint64)
        whole = q
        while (long := q == 16).any():
            pos = pos + 16 * long
            word = np.where(long, words[pos >> 3].astype(np.uint64) << (pos & 7).astype(np.uint64), word)
            more = _ZEROS16[word >> np.uint64(48)].astype(np.uint64)
            whole = whole + np.where(long, more, 0).astype(np.uint64)
            q = np.where(long, more, np.where(q == 16, 0, q)).astype(np.uint64)
        u = whole << k | (word << (q + one)) >> one >> after
        out[i] = (u >> one).astype(np.int64) ^ -(u & one).astype(np.int64)
        pos = pos + (q + one + k).astype(np.int64)
    return out, pos


def _frames(buf: np.ndarray, at: np.ndarray, bits: np.ndarray, limit: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Samples and end offset of the frame at each offset."""
    head = _headers(buf, at, bits)
    body, size = head["body"], head["size"]
    words = np.ndarray((len(buf) - 7,), ">u8", buf, 0, (1,))
    kind = buf[body] >> 1
    order = np.where((kind >= 8) & (kind <= 12), kind - 8, 0)
    start = 8 * (body + 1) + head["bits"] * order
    method = words[start >> 3].astype(np.uint64) << (start & 7).astype(np.uint64) >> np.uint64(54)
    plain = (buf[body] & 1 == 0) & (head["bits"] == 8) & (kind >= 8) & (kind <= 12) & (method >> np.uint64(4) == 0) & (method != 15)
    flat = (buf[body] & 1 == 0) & (head["bits"] == 8) & (kind <= 1)
    out: list = [None] * len(at)
    ends = np.zeros(len(at), np.int64)
    groups: dict[tuple, list[int]] = {}
    for f, key in enumerate(zip(plain.tolist(), flat.tolist(), kind.tolist(), size.tolist(), strict=True)):
        groups.setdefault(key if key[0] or key[1] else (False, False), []).append(f)
    for key, members in groups.items():
        f = np.array(members)
        if key[0]:
            o, n = key[2] - 8, key[3]
            r, pos = _rice(words, start[f] + 10, (method[f] & np.uint64(15)), n - o)
            warm = buf[body[f][:, None] + 1 + np.arange(o)].astype(np.int8).astype(np.int64).T
            for j in reversed(range(o)):
                r = np.diff(warm, j, axis=0)[-1] + np.cumsum(r, axis=0)
            samples = np.concatenate([warm, r]).T if o else r.T
            ends[f] = (pos + 7) >> 3
        elif key[1]:
            n = key[3]
            samples = buf[body[f][:, None] + 1 + (np.arange(n) if key[2] else np.zeros(n, np.int64))].astype(np.int8).astype(np.int64)
            ends[f] = body[f] + 1 + (n if key[2] else 1)
        else:
            samples = []
            for i in members:
                got, end = _subframe(buf, int(8 * body[i]), int(size[i]), int(head["bits"][i]))
                samples.append(got)
                ends[i] = (end + 7) >> 3
        for i, got in zip(members, samples, strict=True):
            out[i] = got
    if (ends + 2 > limit).any():
        raise FlacError("a frame is cut off")
    sums = crc16(buf, at, ends - at)
    if (sums != (buf[ends].astype(np.uint16) << 8 | buf[ends + 1])).any():
        raise FlacError("a frame's checksum is wrong")
    return out, ends + 2


def _subframe(buf: np.ndarray, pos: int, size: int, bits: int) -> tuple[np.ndarray, int]:
    """Any one subframe, bit by bit: also linear predictors, several Rice partitions, escaped ones and wasted bits."""
    big = int.from_bytes(buf[pos >> 3 : (pos >> 3) + size * 8 + 4096].tobytes(), "big")
    total = 8 * len(buf[pos >> 3 : (pos >> 3) + size * 8 + 4096])
    base, at = pos & ~7, pos & 7

    def take(n: int, signed: bool = False) -> int:
        nonlocal at
        if at + n > total:
            raise FlacError("a frame is cut off")
        x = big >> (total - at - n) & (1 << n) - 1
        at += n
        return x - (1 << n) if signed and n and x >> (n - 1) else x

    def unary() -> int:
        n = 0
        while not take(1):
            n += 1
        return n

    take(1)
    kind, wasted = take(6), 0
    if take(1):
        wasted = unary() + 1
        bits -= wasted
    if kind == 0:
        x = [take(bits, True)] * size
    elif kind == 1:
        x = [take(bits, True) for _ in range(size)]
    elif 8 <= kind <= 12 or kind >= 32:
        order = kind - 8 if kind <= 12 else kind - 31
        x = [take(bits, True) for _ in range(order)]
        if kind >= 32:
            precision, shift = take(4) + 1, take(5, True)
            coefs = [take(precision, True) for _ in range(order)]
        else:
            coefs, shift = [math.comb(order, j + 1) * (-1) ** j for j in range(order)], 0
        width = 5 if take(2) else 4
        parts = take(4)
        for p in range(1 << parts):
            n = (size >> parts) - (order if p == 0 else 0)
            k = take(width)
            raw = take(5) if k == (1 << width) - 1 else None
            for _ in range(n):
                if raw is not None:
                    r = take(raw, True)
                else:
                    u = unary() << k | take(k)
                    r = u >> 1 ^ -(u & 1)
                x.append(r + (sum(c * x[-1 - j] for j, c in enumerate(coefs)) >> shift))
    else:
        raise FlacError("a reserved kind of subframe")
    return np.array(x, np.int64) << wasted, base + at


def decode(streams: list[bytes]) -> list[np.ndarray]:
    """The samples of each mono stream; all checksums are verified."""
    infos = [_metadata(s) for s in streams]
    base = np.cumsum([0, *map(len, streams)])
    buf = np.frombuffer(b"".join([*streams, bytes(16)]), np.uint8)
    lanes, stops, whose = [], [], []
    for i, (info, first) in enumerate(infos):
        offsets = [x[1] for x in info["seek"]] if len(streams[i]) > first else []
        begin = [int(base[i]) + first + x for x in offsets]
        lanes += begin
        stops += [*begin[1:], int(base[i + 1])][: len(begin)]
        whose += [i] * len(begin)
    got: list[list[np.ndarray]] = [[] for _ in lanes]
    at, stop, bits = np.array(lanes, np.int64), np.array(stops, np.int64), np.array([infos[i][0]["bits"] for i in whose], np.int64)
    active = np.flatnonzero(at < stop)
    while len(active):
        for s in range(0, len(active), LANES):
            part = active[s : s + LANES]
            samples, ends = _frames(buf, at[part], bits[part], int(base[-1]))
            for lane, x in zip(part.tolist(), samples, strict=True):
                got[lane].append(x)
            at[part] = ends
        active = active[at[active] < stop[active]]
    if (at > stop).any():
        raise FlacError("a frame goes beyond its seek point")
    out: list[list[np.ndarray]] = [[] for _ in streams]
    for i, x in zip(whose, got, strict=True):
        out[i] += x
    done = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
    for (info, _), x in zip(infos, done, strict=True):
        if info["total"] and info["total"] != len(x):
            raise FlacError("the stream has not as many samples as it says")
        if any(info["md5"]) and hashlib.md5(_pcm(x, info["bits"])).digest() != info["md5"]:
            raise FlacError("the stream's MD5 is wrong")
    return done


def _pcm(samples: np.ndarray, bits: int) -> bytes:
    """Little-endian signed PCM in whole bytes."""
    size = (bits + 7) // 8
    if size == 3:
        return samples.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    return samples.astype({1: "<i1", 2: "<i2", 4: "<i4"}[size]).tobytes()


def payload(text: bytes) -> bytes:
    """The text, filled with spaces up to a positive multiple of the block."""
    return text + b" " * (max(BLOCK, -(-len(text) // BLOCK) * BLOCK) - len(text))


def feature(samples: np.ndarray) -> str:
    """Of a stream: root mean square, sign changes, extremes, and the lag-1 product sum, all whole numbers."""
    n = max(1, len(samples))
    changes = int(np.count_nonzero(np.signbit(samples[1:]) != np.signbit(samples[:-1])))
    low, high = (int(samples.min()), int(samples.max())) if len(samples) else (0, 0)
    return f"rms={math.isqrt(int((samples * samples).sum()) // n)};zc={changes};min={low};max={high};lag1={int((samples[1:] * samples[:-1]).sum()) // n}"


_MEDIA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.large_binary())])


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in common.by_bytes(whole, "text", LANES * BLOCK):
            texts = common.utf8(batch.column(1))
            own = list(dict.fromkeys(texts))
            media = dict(zip(own, encode([payload(t) for t in own]), strict=True))
            yield common.emit({"doc_id": batch.column(0), "n_bytes": [len(t) for t in texts], "media": [media[t] for t in texts]}, _MEDIA)


def _picked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def store(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each text's padded UTF-8 bytes as an 8-bit FLAC stream. Null counts as empty."""
    return _picked(docs).mapInArrow(_store, "doc_id long, n_bytes long, media binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("media_id", pa.int64()), ("block", pa.int64()), ("first_sample", pa.int64()), ("n_samples", pa.int32()), ("pcm", pa.large_binary())])
    for whole in batches:
        for batch in common.by_bytes(whole, "media"):
            data = [bytes(x) for x in batch.column(1).to_pylist()]
            for i, x in zip(batch.column(0).to_pylist(), decode(data), strict=True):
                pcm = x.astype("<i4")
                first = list(range(0, len(x), BLOCK))
                yield common.emit({"media_id": [i] * len(first), "block": [s // BLOCK for s in first], "first_sample": first, "n_samples": [min(BLOCK, len(x) - s) for s in first], "pcm": [pcm[s : s + BLOCK].tobytes() for s in first]}, schema)


def pcm_blocks(media: DataFrame) -> DataFrame:
    """(media_id, block, first_sample, n_samples, pcm) from (doc_id, media): blocks of little-endian 32-bit samples.

    Null media give no blocks; a broken stream fails with FlacError.
    """
    picked = media.where("media is not null").select(F.col("doc_id").cast("long").alias("media_id"), "media")
    return picked.mapInArrow(_blocks, "media_id long, block long, first_sample long, n_samples int, pcm binary")


def _round_trip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
    for batch in _store(batches):
        media = batch.column(2).to_pylist()
        own = list(dict.fromkeys(media))
        known = {}
        for m, samples in zip(own, decode(own), strict=True):
            data = (samples + 128).astype(np.uint8).tobytes()
            known[m] = (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(m), hashlib.sha256(m).hexdigest(), feature(samples))
        rows = list(zip(*(known[m] for m in media), strict=True))
        yield common.emit({"doc_id": batch.column(0), "n_bytes": batch.column(1), **dict(zip(schema.names[2:], map(list, rows), strict=True))}, schema)


def round_trip(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: sizes, digests and features of its text stored as FLAC and read back.

    Null and empty texts make one block of spaces. Null doc_ids and repeated rows stay; an empty table gives no rows;
    other columns are ignored. Equal texts get equal values.
    """
    kinds = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return _picked(docs).mapInArrow(_round_trip, kinds)
