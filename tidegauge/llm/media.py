"""Media columns by signature sniffing.

An Aho-Corasick automaton finds the magic bytes of all known formats in one pass; each hit goes to the format's
validator, which walks the structure and returns the length it proves (or nothing). A file whose first bytes validate
gets that type, whatever its name said; validated media further in, outside what is already accounted for, are carved.

The query stores each text's payload as 8-bit samples in one of four containers (WAV, BMP, PGM, AU, picked by the
payload's CRC), under a declared type that is picked by another part of the CRC and so wrong three times of four. It sniffs
the stored bytes, which corrects the type, reads the samples back from the container found, sniffs in these for media
that the text itself holds, and describes all that.

Validators that walk a chain of parts remember the places from which no walk ends well, so that a file takes time in
proportion to its length, however many magic bytes it holds.

Cases: null text is the empty payload, one unit of padding; equal texts give equal rows; bytes without a signature
keep type application/octet-stream and nothing is carved; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import batches, rows_of

UNIT = 576
UNKNOWN = "application/octet-stream"
#: Magic bytes, where they stand in a file, and the format.
MAGIC = [
    (b"RIFF", 0, "audio/wav"),
    (b"BM", 0, "image/bmp"),
    (b"P5", 0, "image/x-portable-graymap"),
    (b"P6", 0, "image/x-portable-pixmap"),
    (b".snd", 0, "audio/basic"),
    (b"\x89PNG\r\n\x1a\n", 0, "image/png"),
    (b"GIF87a", 0, "image/gif"),
    (b"GIF89a", 0, "image/gif"),
    (b"\xff\xd8\xff", 0, "image/jpeg"),
    (b"OggS", 0, "audio/ogg"),
    (b"ftyp", 4, "video/mp4"),
]


def _u32(b: bytes, at: int, order: str = "<") -> int:
    return struct.unpack_from(order + "I", b, at)[0] if at + 4 <= len(b) else -1


def wav_end(b: bytes, at: int, dead: set) -> tuple[int, tuple[int, int]] | None:
    end = at + 8 + _u32(b, at + 4)
    if b[at + 8 : at + 12] != b"WAVE" or end > len(b) or end < at + 12:
        return None
    p, seen, data = at + 12, False, None
    while p + 8 <= end:
        kind, size = b[p : p + 4], _u32(b, p + 4)
        if p + 8 + size > end:
            return None
        if kind == b"fmt ":
            seen = size >= 16 and struct.unpack_from("<HHI", b, p + 8)[1] > 0
        if kind == b"data":
            data = (p + 8, size)
        p += 8 + size + size % 2
    return (end, data) if seen and data else None


def bmp_end(b: bytes, at: int, dead: set) -> tuple[int, tuple[int, int]] | None:
    if at + 54 > len(b):
        return None
    size, reserved, offset, dib, width, height, planes, depth = struct.unpack_from("<IIIIiiHH", b, at + 2)
    row = (width * depth + 31) // 32 * 4
    fits = dib in (40, 108, 124) and planes == 1 and depth in (1, 4, 8, 16, 24, 32) and width > 0 and height != 0 and reserved == 0
    if not fits or offset < 14 + dib or size < offset + row * abs(height) or at + size > len(b):
        return None
    return at + size, (at + offset, row * abs(height))


PNM = re.compile(rb"P[56]\s+(?:#[^\n]*\n\s*)*(\d{1,9})\s+(\d{1,9})\s+(\d{1,5})\s")


def pnm_end(b: bytes, at: int, dead: set) -> tuple[int, tuple[int, int]] | None:
    m = PNM.match(b, at)
    if not m or not 0 < int(m[3]) < 65536:
        return None
    size = int(m[1]) * int(m[2]) * (1 if b[at + 1] == 53 else 3) * (1 if int(m[3]) < 256 else 2)
    return (m.end() + size, (m.end(), size)) if 0 < size <= len(b) - m.end() else None


def au_end(b: bytes, at: int, dead: set) -> tuple[int, tuple[int, int]] | None:
    if at + 24 > len(b):
        return None
    head, size, encoding, rate, channels = struct.unpack_from(">5I", b, at + 4)
    if head < 24 or size == 0xFFFFFFFF or not 1 <= encoding <= 27 or not rate or not 1 <= channels <= 64 or at + head + size > len(b):
        return None
    return at + head + size, (at + head, size)


def _walk(b: bytes, p: int, step, dead: set) -> int | None:
    """Follow step (place -> next place and whether that is the end, or None) from p; the end it comes to, or None. What
    comes next depends on the place alone, so places without an end are remembered in `dead`."""
    seen = []
    while p not in dead:
        seen.append(p)
        got = step(b, p)
        if got is None:
            break
        p, done = got
        if done:
            return p
    dead.update(seen)
    return None


def _png_step(b: bytes, p: int):
    size, kind = _u32(b, p, ">"), b[p + 4 : p + 8]
    if p + 12 > len(b) or p + 12 + size > len(b) or zlib.crc32(b[p + 4 : p + 8 + size]) != _u32(b, p + 8 + size, ">"):
        return None
    return p + 12 + size, kind == b"IEND"


def png_end(b: bytes, at: int, dead: set) -> tuple[int, tuple[int, int]] | None:
    end = _walk(b, at + 8, _png_step, dead) if b[at + 12 : at + 16] == b"IHDR" else None
    return (end, (at, end - at)) if end else None


def _gif_step(b: bytes, place: int):
    """A place is twice a position, plus one within a chain of sub-blocks."""
    p = place // 2
    if p >= len(b):
        return None
    if place % 2:
        return (2 * (p + 1 + b[p]) + 1, False) if b[p] else (2 * (p + 1), False)
    if b[p] == 0x3B:
        return 2 * (p + 1), True
    if b[p] == 0x21:
        return 2 * (p + 2) + 1, False
    if b[p] != 0x2C or p + 10 > len(b):
        return None
    return 2 * (p + 11 + (3 * 2 ** (b[p + 9] % 8 + 1) if b[p + 9] & 128 else 0)) + 1, False


def gif_end(b: bytes, at: int, dead: set) -> tuple[int, tuple[int, int]] | None:
    if at + 13 > len(b):
        return None
    end = _walk(b, 2 * (at + 13 + (3 * 2 ** (b[at + 10] % 8 + 1) if b[at + 10] & 128 else 0)), _gif_step, dead)
    return (end // 2, (at, end // 2 - at)) if end else None


def _jpeg_step(b: bytes, p: int):
    if p + 4 > len(b) or b[p] != 0xFF or 0xD0 <= b[p + 1] <= 0xD9 or b[p + 1] in (0, 0xFF):
        return None
    size = struct.unpack_from(">H", b, p + 2)[0]
    if size < 2:
        return None
    scan, p = b[p + 1] == 0xDA, p + 2 + size
    while scan and (p := b.find(b"\xff", p)) >= 0:
        if p + 1 >= len(b):
            return None
        if b[p + 1] == 0xD9:
            return p + 2, True
        if b[p + 1] and not 0xD0 <= b[p + 1] <= 0xD7:
            break
        p += 2
    return None if p < 0 else (p, False)


def jpeg_end(b: bytes, at: int, dead: set) -> tuple[int, tuple[int, int]] | None:
    end = _walk(b, at + 2, _jpeg_step, dead)
    return (end, (at, end - at)) if end else None


def _ogg_step(b: bytes, p: int):
    if b[p : p + 4] != b"OggS" or p + 27 > len(b) or b[p + 4] != 0:
        return None
    count = b[p + 26]
    end = p + 27 + count + sum(b[p + 27 : p + 27 + count])
    return (end, bool(b[p + 5] & 4)) if end <= len(b) else None


def ogg_end(b: bytes, at: int, dead: set) -> tuple[int, tuple[int, int]] | None:
    end = _walk(b, at, _ogg_step, dead)
    return (end, (at, end - at)) if end else None


def _box_end(b: bytes, p: int) -> int | None:
    size = _u32(b, p, ">")
    return p + size if p + 8 <= len(b) and size >= 8 and p + size <= len(b) and b[p + 4 : p + 8].isalnum() else None


def _mp4_step(b: bytes, p: int):
    end = _box_end(b, p)
    return None if end is None else (end, b[p + 4 : p + 8] == b"moov")


def mp4_end(b: bytes, at: int, dead: set) -> tuple[int, tuple[int, int]] | None:
    p = _walk(b, at, _mp4_step, dead)
    while p and (more := _box_end(b, p)):
        p = more
    return (p, (at, p - at)) if p else None


END_OF = {
    "audio/wav": wav_end, "image/bmp": bmp_end, "image/x-portable-graymap": pnm_end, "image/x-portable-pixmap": pnm_end,
    "audio/basic": au_end, "image/png": png_end, "image/gif": gif_end, "image/jpeg": jpeg_end, "audio/ogg": ogg_end, "video/mp4": mp4_end,
}


@cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for magic, at, kind in MAGIC:
        found.add_word(magic.decode("latin-1"), (len(magic), at, kind))
    found.make_automaton()
    return found


def sniff(b: bytes) -> list[tuple[str, int, int, tuple[int, int]]]:
    """(type, start, end, (start and length of its samples)) of all media that validate and don't overlap, in order."""
    hits = sorted({(last - size + 1 - at, kind) for last, (size, at, kind) in automaton().iter(b.decode("latin-1"))})
    found, free, dead = [], 0, {kind: set() for kind in END_OF}
    for start, kind in hits:
        if start >= free and (got := END_OF[kind](b, start, dead[kind])):
            found.append((kind, start, got[0], got[1]))
            free = got[0]
    return found


def wav(samples: bytes) -> bytes:
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples), b"WAVE", b"fmt ", 16, 1, 1, 8000, 8000, 1, 8, b"data", len(samples)) + samples


def bmp(samples: bytes, width: int = UNIT) -> bytes:
    colours = b"".join(bytes((v, v, v, 0)) for v in range(256))
    head = struct.pack("<2sIIIIiiHHIIiiII", b"BM", 54 + 1024 + len(samples), 0, 54 + 1024, 40, width, len(samples) // width, 1, 8, 0, len(samples), 2835, 2835, 256, 0)
    return head + colours + samples


def pgm(samples: bytes, width: int = UNIT) -> bytes:
    return b"P5\n%d %d\n255\n" % (width, len(samples) // width) + samples


def au(samples: bytes) -> bytes:
    return struct.pack(">4s5I", b".snd", 24, len(samples), 2, 8000, 1) + samples


STORE = [wav, bmp, pgm, au]
STORED_TYPES = ["audio/wav", "image/bmp", "image/x-portable-graymap", "audio/basic"]


def payload(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (UNIT - len(raw) if not raw else -len(raw) % UNIT), len(raw)


def store(samples: bytes) -> tuple[str, bytes]:
    """A declared type, which need not be right, and 8-bit samples in a container; equal samples, equal results."""
    crc = zlib.crc32(samples)
    return STORED_TYPES[crc // len(STORE) % len(STORE)], STORE[crc % len(STORE)](samples)


def describe(samples: bytes, declared: str, kind: str, carved: list[str]) -> str:
    v = np.frombuffer(samples, np.uint8)
    shares = np.bincount(v, minlength=256) / max(1, len(v))
    shares = shares[shares > 0]
    entropy = float(-(shares * np.log2(shares)).sum())
    return f"type={kind};samples={len(v)};mean={int(v.sum(dtype=np.int64)) / max(1, len(v)):.4f};peak={int(v.max(initial=0))};entropy={entropy:.4f};declared={declared};corrected={str(kind != declared).lower()};carved={len(carved)}{''.join(f":{k}" for k in carved)}"


def examine(b: bytes, declared: str | None) -> tuple[str, tuple[int, int] | None, list]:
    """The type that the bytes have (the declared one if nothing validates at their start), where its samples lie, and
    the media further in as sniff() gives them."""
    found = sniff(b)
    top = found[0] if found and found[0][1] == 0 else None
    return (top[0] if top else declared or UNKNOWN), (top[3] if top else None), (found[1:] if top else found)


def carve(files: DataFrame) -> DataFrame:
    """files (id, declared, data binary) -> one row for each file: declared type, found type (the declared one if nothing
    validates at its start), whether that corrects it, and the embedded media as structs of type, start, end, data."""

    def rows(stream):
        for key, declared, data in rows_of(stream, 16):
            kind, _, inner = examine(data or b"", declared)
            yield key, declared, kind, kind != declared, [{"type": k, "start": s, "end": e, "data": data[s:e]} for k, s, e, _ in inner]

    item = pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("data", pa.binary())])
    schema = pa.schema([("id", pa.int64()), ("declared", pa.string()), ("type", pa.string()), ("corrected", pa.bool_()), ("embedded", pa.list_(item))])
    ddl = "id long, declared string, type string, corrected boolean, embedded array<struct<type:string,start:long,end:long,data:binary>>"
    return files.select(F.col("id").cast("long"), "declared", "data").mapInArrow(lambda it: batches(rows(it), schema, 500), ddl)


DIGEST = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()),
        ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()),
        ("declared", pa.string()), ("type", pa.string()), ("embedded", pa.int64()),
    ]
)


def digests(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> sizes and digests of the payload as read back from the stored form, and its features."""

    def rows(stream):
        for doc_id, text in rows_of(stream):
            samples, n = payload(text)
            declared, stored = store(samples)
            kind, (at, size), outside = examine(stored, declared)
            back = stored[at : at + size]
            inside = outside + sniff(back)
            feature = describe(back, declared, kind, [k for k, *_ in inside])
            yield (
                doc_id, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(stored),
                hashlib.sha256(stored).hexdigest(), feature, declared, kind, len(inside),
            )

    ddl = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, declared string, type string, embedded long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda it: batches(rows(it), DIGEST, 5000), ddl)


def op9_media(spark, sf_dir: str) -> DataFrame:
    from tidegauge.llm.common import documents

    return digests(documents(spark, sf_dir))
