"""Media columns: bytes kept in containers, and signature sniffing that corrects declared types.

One Aho-Corasick pass finds every magic number in a value; a validator per format
then confirms structure and lengths from the bytes themselves. What starts at 0 gives
the true type, what starts later is embedded media and can be carved out.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Rate written into the header; the samples are data, not sound.
RATE = 8000


def wav_of(payload: bytes) -> bytes:
    """A RIFF/WAVE file with the payload as unsigned 8-bit mono samples."""
    pad = len(payload) % 2
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8)
    body = b"WAVE" + fmt + struct.pack("<4sI", b"data", len(payload)) + payload + b"\0" * pad
    return struct.pack("<4sI", b"RIFF", len(body)) + body


def _times(a: int, b: int) -> int:
    """Product of two remainders of the checksum's polynomial, highest power in the lowest bit."""
    got = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            got ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return got


def _powers() -> list[list[int]]:
    """For each byte of a length, what a checksum is multiplied by for as many zero bytes."""
    tables, one = [], 1 << 23
    for _ in range(4):
        row = [1 << 31]
        for _ in range(256):
            row.append(_times(row[-1], one))
        one = row.pop()
        tables.append(row)
    return tables


_POWERS = _powers()


def _shifted(crc: int, zeros: int) -> int:
    """What crc adds to the checksum of a text that goes on for as many bytes."""
    for k in range(4):
        if byte := zeros >> 8 * k & 255:
            crc = _times(_POWERS[k][byte], crc)
    return crc


class Marks:
    """Where magic numbers and end marks stand in a value, from one Aho-Corasick pass, and what has been walked already: so hostile values take linear time."""

    def __init__(self, data: bytes):
        self.data = data
        self.signs: list[tuple[int, int]] = []
        self.ends: dict[bytes, list[int]] = {m: [] for m in ENDS}
        # by where a block stands, what its chain of blocks comes to
        self.chains: dict[int, int] = {}
        self.dead: set[int] = set()
        self.samples: dict[int, tuple[int, bool | None]] = {}
        self.images: dict[int, int] = {}
        self.scans: dict[int, int] = {}
        # sizes of archives and ends of documents by where they start, from their end records
        self.archives: dict[int, int] | None = None
        self.documents: dict[int, int] | None = None
        # checksums of the first bytes, up to every 4096th
        self.sums: list[int] = [0]
        # latin-1 text has one character per byte
        for end, (n, sign) in _magic.iter(data.decode("latin-1")):
            if n < 0:
                self.ends[sign].append(end - len(sign) + 1)
            else:
                self.signs.append((end - len(sign) + 1, n))
        self.ends[b"%PDF-"] = [at for at, n in self.signs if FORMATS[n][0] == b"%PDF-"]

    def crc(self, start: int, end: int) -> int:
        """zlib.crc32 of data[start:end]; of long stretches from the checksums of what lies before their ends, so nested stretches are not read again."""
        view = memoryview(self.data)
        if end - start <= 2 * STEP:
            return zlib.crc32(view[start:end])
        while len(self.sums) * STEP <= end:
            at = (len(self.sums) - 1) * STEP
            self.sums.append(zlib.crc32(view[at : at + STEP], self.sums[-1]))
        upto = lambda at: zlib.crc32(view[at // STEP * STEP : at], self.sums[at // STEP])
        return upto(end) ^ _shifted(upto(start), end - start)

    def after(self, mark: bytes, at: int) -> int:
        """Where mark stands first from at on, -1 if nowhere."""
        found = self.ends[mark]
        i = bisect_left(found, at)
        return found[i] if i < len(found) else -1

    def before(self, mark: bytes, at: int) -> int:
        """Where mark stands last before at, -1 if nowhere."""
        i = bisect_left(self.ends[mark], at)
        return self.ends[mark][i - 1] if i else -1


def _wav(data: bytes, start: int, marks: Marks) -> tuple[int, int, int] | None:
    """Size, and where the samples start and end, if a whole WAVE file begins at start."""
    if start + 12 > len(data) or data[start + 8 : start + 12] != b"WAVE":
        return None
    end = start + 8 + struct.unpack_from("<I", data, start + 4)[0]
    if end > len(data):
        return None
    # where the chain of chunks comes to samples, and whether the last format before them is whole; -1 if the value ends first
    at, path, samples = start + 12, [], -1
    while at + 8 <= len(data) and at not in marks.samples:
        kind, n = struct.unpack_from("<4sI", data, at)
        if kind == b"data":
            samples = at
            break
        path.append((at, n >= 16 if kind == b"fmt " else None))
        at += 8 + n + n % 2
    samples, whole = marks.samples.get(at, (samples, None))
    for at, own in reversed(path):
        whole = own if whole is None else whole
        marks.samples[at] = samples, whole
    if samples < 0 or not whole or (last := samples + 8 + struct.unpack_from("<I", data, samples + 4)[0]) > end:
        return None
    return end - start, samples + 8 - start, last - start


def _png(data: bytes, start: int, marks: Marks) -> tuple[int, int, int] | None:
    """Every chunk must lie within data and match its checksum; the first is IHDR, the last IEND."""
    at, path, end = start + 8, [], -1
    if data[at : at + 8] != b"\0\0\0\rIHDR":
        return None
    while at + 12 <= len(data) and at not in marks.images:
        path.append(at)
        n, kind = struct.unpack_from(">I4s", data, at)
        if at + 12 + n > len(data) or marks.crc(at + 4, at + 8 + n) != struct.unpack_from(">I", data, at + 8 + n)[0]:
            break
        at += 12 + n
        if kind == b"IEND":
            end = at
            break
    else:
        end = marks.images.get(at, -1)
    marks.images.update(dict.fromkeys(path, end))
    return (end - start, 0, end - start) if end >= 0 else None


def _gif(data: bytes, start: int, marks: Marks) -> tuple[int, int, int] | None:
    """Screen descriptor, colour tables, then extension and image blocks up to the trailer."""
    if start + 13 > len(data):
        return None
    table = lambda flags: 3 << (flags & 7) + 1 if flags & 128 else 0

    def blocks(at: int) -> int:
        path = []
        while at < len(data) and data[at] and at not in marks.chains:
            path.append(at)
            at += 1 + data[at]
        end = marks.chains.get(at, at + 1)
        marks.chains.update(dict.fromkeys(path, end))
        return end

    at, seen = start + 13 + table(data[start + 10]), []
    while at < len(data) and at not in marks.dead:
        seen.append(at)
        if data[at] == 0x3B:
            return at + 1 - start, 0, at + 1 - start
        if data[at] == 0x21:
            at = blocks(at + 2)
        elif data[at] == 0x2C and at + 10 <= len(data):
            at = blocks(at + 11 + table(data[at + 9]))
        else:
            break
    marks.dead.update(seen)
    return None


def _jpeg(data: bytes, start: int, marks: Marks) -> tuple[int, int, int] | None:
    """Segments by their lengths, bytes that fill before a marker passed over, up to the scan, then the end marker."""
    at, path, scan = start + 2, [], -1
    while at + 4 <= len(data) and data[at] == 0xFF and at not in marks.scans:
        path.append(at)
        if data[at + 1] == 0xFF:
            at += 1
            continue
        n = struct.unpack_from(">H", data, at + 2)[0]
        if n < 2 or at + 2 + n > len(data):
            break
        if data[at + 1] == 0xDA:
            scan = at + 2 + n
            break
        at += 2 + n
    else:
        scan = marks.scans.get(at, -1)
    marks.scans.update(dict.fromkeys(path, scan))
    end = marks.after(b"\xff\xd9", scan) if scan >= 0 else -1
    return (end + 2 - start, 0, end + 2 - start) if end >= 0 else None


def _documents(data: bytes, marks: Marks) -> dict[int, int]:
    """Ends of PDF files by their starts, as their last pointers say: those count from the file's start to the table or stream of references, which is the last before the pointer."""
    starts = set(marks.ends[b"%PDF-"])
    tables = [at for at in marks.ends[b"xref"] if data[at - 5 : at] != b"start"]
    streams, found = marks.ends[b" obj"], {}
    for at in marks.ends[b"startxref"]:
        end, value = marks.after(b"%%EOF", at), _POINTER.match(data, at + 9)
        if end < 0 or not value:
            continue
        for places in (tables, streams):
            if i := bisect_left(places, at):
                place = places[i - 1]
                if places is streams:  # from the name of the object
                    name = _OBJECT.search(data[max(0, place - 20) : place])
                    place = max(0, place - 20) + name.start() if name else -1
                if place - int(value[1]) in starts:
                    found[place - int(value[1])] = end + 5
    return found


def _pdf(data: bytes, start: int, marks: Marks) -> tuple[int, int, int] | None:
    """A version number, and an end: the furthest that the file's own pointers or its linearization name, else the last pointer with an end mark before the next file of the kind."""
    if not data[start + 5 : start + 8].replace(b".", b"").isdigit():
        return None
    if marks.documents is None:
        marks.documents = _documents(data, marks)
    end = marks.documents.get(start, -1)
    if (line := _LINEAR.search(data, start, start + 1024)) and (mark := marks.before(b"%%EOF", start + int(line[1]))) >= start + int(line[1]) - 16:
        end = max(end, mark + 5)
    if end < 0:
        following = marks.after(b"%PDF-", start + 1)
        mark = marks.before(b"%%EOF", following if following >= 0 else len(data))
        pointer = marks.before(b"startxref", mark) if mark > start else -1
        end = mark + 5 if pointer > start else -1
        if end < 0 and (pointer := marks.after(b"startxref", start)) >= 0 and (mark := marks.after(b"%%EOF", pointer)) >= 0:
            end = mark + 5
    return (end - start, 0, end - start) if end >= 0 else None


def _zip(data: bytes, start: int, marks: Marks) -> tuple[int, int, int] | None:
    """An end record must say that the directory that it ends lies behind this start."""
    if marks.archives is None:
        marks.archives = {}
        for end in marks.ends[b"PK\x05\x06"]:
            if end <= len(data) - 22:
                size, offset, note = struct.unpack_from("<IIH", data, end + 12)
                if end + 22 + note <= len(data):
                    marks.archives.setdefault(end - size - offset, end + 22 + note - (end - size - offset))
    size = marks.archives.get(start)
    return (size, 0, size) if size else None


#: The magic number that opens each format, its media type, its validator, and the marks that end some of them.
FORMATS = [
    (b"RIFF", "audio/wav", _wav),
    (b"\x89PNG\r\n\x1a\n", "image/png", _png),
    (b"GIF87a", "image/gif", _gif),
    (b"GIF89a", "image/gif", _gif),
    (b"\xff\xd8\xff", "image/jpeg", _jpeg),
    (b"%PDF-", "application/pdf", _pdf),
    (b"PK\x03\x04", "application/zip", _zip),
]
ENDS = (b"\xff\xd9", b"startxref", b"xref", b" obj", b"%%EOF", b"PK\x05\x06")
UNKNOWN = "application/octet-stream"
#: The number after a pointer, the name of an object, and the length of a linearized file.
_POINTER, _OBJECT, _LINEAR = re.compile(rb"\s{1,4}(\d{1,12})\s"), re.compile(rb"\d{1,8} \d{1,5}$"), re.compile(rb"/Linearized[^>]{0,200}?/L (\d{1,12})")
#: Bytes between checksums that are kept.
STEP = 4096

_magic = ahocorasick.Automaton()
for _n, (_sign, _kind, _check) in enumerate(FORMATS):
    _magic.add_word(_sign.decode("latin-1"), (_n, _sign))
for _sign in ENDS:
    _magic.add_word(_sign.decode("latin-1"), (-1, _sign))
_magic.make_automaton()


def sniff(data: bytes) -> list[tuple[int, int, str, int, int]]:
    """Confirmed media in data in order: start, size, type, and where its payload starts and ends (from start).

    A WAVE file's samples are looked into, since they may hold anything; what lies in another confirmed
    file belongs to that file. A magic number whose structure does not hold is not reported.
    """
    found, marks, closed = [], Marks(data), 0
    for start, n in marks.signs:
        if start < closed:
            continue
        _, kind, check = FORMATS[n]
        if (got := check(data, start, marks)) is not None:
            found.append((start, got[0], kind, got[1], got[2]))
            if check is not _wav:
                closed = start + got[0]
    return found


#: Types that a careless crawler declares.
DECLARED = (UNKNOWN, "audio/wav", "image/png", "text/plain")


def sliced(batches: Iterator[pa.RecordBatch], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about so many bytes in the last column, or of one row that has more."""
    for batch in batches:
        size, start = 0, 0
        for at, n in enumerate(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_pylist()):
            if size and size + n > most:
                yield batch.slice(start, at - start)
                size, start = 0, at
            size += n
        yield batch.slice(start)


def store_payload(df: DataFrame, text: str = "text", unit: int = 64) -> DataFrame:
    """df without its text, and n_bytes (UTF-8 size of the whole text; null: 0), media, declared_type.

    media is a WAVE file of the bytes, zeros added up to a positive multiple of unit.
    declared_type is what a careless crawler would say of the value: one of DECLARED by a checksum of it, mostly wrong.
    Other columns stay, those named like the new ones are replaced; an empty table gives none.
    """
    kept = [f for f in df.schema.fields if f.name not in (text, "n_bytes", "media", "declared_type")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            raw = [(t or "").encode() for t in batch.column(len(kept)).to_pylist()]
            media = [wav_of(b + b"\0" * (-len(b) % unit or (0 if b else unit))) for b in raw]
            new = [pa.array([len(b) for b in raw], pa.int64()), pa.array(media, pa.binary()), pa.array([DECLARED[zlib.crc32(b) % len(DECLARED)] for b in raw], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *new], names=[*(f.name for f in kept), "n_bytes", "media", "declared_type"])

    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_bytes bigint, media binary, declared_type string"])
    return df.select(*[df[f.name] for f in kept], df[text]).mapInArrow(run, out)


def sniff_media(df: DataFrame, media: str = "media", carve: bool = False) -> DataFrame:
    """df and what its media column holds: true_type, payload, embedded.

    true_type is the confirmed type at 0, else application/octet-stream; payload is
    that file's content (samples of a WAVE file, else the whole file), the value itself
    where nothing is confirmed. embedded lists (start, size, type, bytes) of confirmed
    media that starts later; bytes only if carve, and none for what starts inside a file that is carved already,
    whose place says where its bytes are: so no byte is copied twice. Null counts as empty. Other columns stay, those named like
    the new ones are replaced; an empty table gives none.
    """
    kept = [f for f in df.schema.fields if f.name not in ("true_type", "payload", "embedded")]
    item = pa.struct([("start", pa.int64()), ("size", pa.int64()), ("type", pa.string()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            kinds, payloads, inner = [], [], []
            for data in batch.column(len(kept)).to_pylist():
                data = data or b""
                found = sniff(data)
                whole = next((f for f in found if f[0] == 0), (0, len(data), UNKNOWN, 0, len(data)))
                kinds.append(whole[2])
                payloads.append(data[whole[3] : whole[4]])
                inner.append([])
                carved = 0
                for s, n, k, _, _ in found:
                    if s:
                        own = carve and s >= carved
                        inner[-1].append({"start": s, "size": n, "type": k, "bytes": data[s : s + n] if own else None})
                        carved = s + n if own else carved
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(kinds, pa.string()), pa.array(payloads, pa.binary()), pa.array(inner, pa.list_(item))],
                names=[*(f.name for f in kept), "true_type", "payload", "embedded"])

    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept),
                     "true_type string, payload binary, embedded array<struct<start:bigint,size:bigint,type:string,bytes:binary>>"])
    return df.select(*[df[f.name] for f in kept], df[media]).mapInArrow(run, out)
