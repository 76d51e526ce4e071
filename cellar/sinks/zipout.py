"""Zip container for pre-deflated members (used by the workbook commit task).

Sheet XML is deflated in parallel by the rendering tasks: every fragment is a raw deflate
stream ended with a sync flush, so fragments concatenate into one valid stream. Their
CRC-32s are combined here (the zlib ``crc32_combine`` algorithm over GF(2) matrices),
so the commit task only copies bytes.
"""

from __future__ import annotations

import json
import struct
import time
import zlib

_SYNC = zlib.Z_SYNC_FLUSH
_FINISH_BLOCK = zlib.compressobj(1, zlib.DEFLATED, -15).flush(zlib.Z_FINISH)  # empty final block


def deflate_fragment(data: bytes, level: int = 1) -> tuple[bytes, int, int]:
    """Raw deflate with a sync flush (not final): (bytes, crc32, raw length)."""
    co = zlib.compressobj(level, zlib.DEFLATED, -15)
    out = co.compress(data) + co.flush(_SYNC)
    return out, zlib.crc32(data), len(data)


def _gf2_times(mat, vec):
    s = 0
    i = 0
    while vec:
        if vec & 1:
            s ^= mat[i]
        vec >>= 1
        i += 1
    return s


def _gf2_square(mat):
    return [_gf2_times(mat, mat[n]) for n in range(32)]


def crc32_combine(crc1: int, crc2: int, len2: int) -> int:
    """CRC-32 of A+B from crc(A), crc(B) and len(B)."""
    if len2 <= 0:
        return crc1
    odd = [0xEDB88320] + [1 << n for n in range(31)]
    even = _gf2_square(odd)
    odd = _gf2_square(even)
    while True:
        even = _gf2_square(odd)
        if len2 & 1:
            crc1 = _gf2_times(even, crc1)
        len2 >>= 1
        if not len2:
            break
        odd = _gf2_square(even)
        if len2 & 1:
            crc1 = _gf2_times(odd, crc1)
        len2 >>= 1
        if not len2:
            break
    return crc1 ^ crc2


def _dos_time(t: float | None = None):
    lt = time.localtime(t if t is not None else time.time())
    dtime = (lt.tm_hour << 11) | (lt.tm_min << 5) | (lt.tm_sec // 2)
    ddate = ((max(lt.tm_year, 1980) - 1980) << 9) | (lt.tm_mon << 5) | lt.tm_mday
    return dtime, ddate


_MARK = b"cellar-batches:"


def read_marks(comment: bytes) -> dict[str, int]:
    """Stream names and the last batch of each that a workbook holds, from its zip comment."""
    for line in comment.split(b"\n"):
        if line.startswith(_MARK):
            return json.loads(line[len(_MARK):])
    return {}


def with_marks(comment: bytes, marks: dict[str, int] | None) -> bytes:
    """A zip comment with ``marks`` added; other comments stay."""
    if not marks:
        return comment
    rest = [line for line in comment.split(b"\n") if line and not line.startswith(_MARK)]
    return b"\n".join([*rest, _MARK + json.dumps(read_marks(comment) | marks, sort_keys=True).encode()])


class ZipWriter:
    """Streams members into a binary file object; members may come as deflate pieces."""

    def __init__(self, fh):
        self.fh = fh
        self.offset = 0
        self.entries = []
        self.dtime, self.ddate = _dos_time()

    def _write(self, b: bytes):
        self.fh.write(b)
        self.offset += len(b)

    def add_bytes(self, name: str, data: bytes, level: int = 6):
        co = zlib.compressobj(level, zlib.DEFLATED, -15)
        comp = co.compress(data) + co.flush(zlib.Z_FINISH)
        self._member(name, [comp], zlib.crc32(data), len(data), len(comp))

    def add_pieces(self, name: str, pieces):
        """pieces: iterable of (deflated_bytes_or_callable, crc32, raw_len, comp_len), all sync-flushed.

        Sizes are summed up front (they come from fragment metadata) so the local header is exact.
        """
        pieces = list(pieces)
        crc = 0
        raw = 0
        comp = 0
        for _, c, r, k in pieces:
            crc = crc32_combine(crc, c, r) if raw else c
            raw += r
            comp += k
        comp += len(_FINISH_BLOCK)
        if raw == 0:
            crc = 0

        def chunks():
            for data, _, _, _ in pieces:
                yield data() if callable(data) else data
            yield _FINISH_BLOCK

        self._member(name, chunks(), crc, raw, comp)

    def copy_member(self, src, fh, info, block: int = 1 << 20):
        """Copy a member of another zip (``src`` over the seekable ``fh``) without inflating it."""
        if info.compress_type != 8 or info.flag_bits & 1:
            self.add_bytes(info.filename, src.read(info.filename))
            return
        fh.seek(info.header_offset)
        head = fh.read(30)
        at = info.header_offset + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little")

        def chunks():
            left = info.compress_size
            fh.seek(at)
            while left:
                data = fh.read(min(block, left))
                left -= len(data)
                yield data

        self._member(info.filename, chunks(), info.CRC, info.file_size, info.compress_size)

    def _member(self, name, chunks, crc, raw, comp):
        bname = name.encode("utf-8")
        zip64 = raw >= 0xFFFFFFFF or comp >= 0xFFFFFFFF
        extra = struct.pack("<HHQQ", 1, 16, raw, comp) if zip64 else b""
        header_offset = self.offset
        self._write(
            struct.pack(
                "<IHHHHHIIIHH",
                0x04034B50,
                45 if zip64 else 20,
                0x0800,
                8,
                self.dtime,
                self.ddate,
                crc & 0xFFFFFFFF,
                0xFFFFFFFF if zip64 else comp,
                0xFFFFFFFF if zip64 else raw,
                len(bname),
                len(extra),
            )
            + bname
            + extra
        )
        written = 0
        for c in chunks:
            self._write(c)
            written += len(c)
        if written != comp:
            raise IOError(f"zip member {name}: expected {comp} compressed bytes, wrote {written}")
        self.entries.append((bname, crc & 0xFFFFFFFF, comp, raw, header_offset))

    def close(self, comment: bytes = b""):
        cd_start = self.offset
        for bname, crc, comp, raw, off in self.entries:
            need64 = comp >= 0xFFFFFFFF or raw >= 0xFFFFFFFF or off >= 0xFFFFFFFF
            extra = struct.pack("<HHQQQ", 1, 24, raw, comp, off) if need64 else b""
            self._write(
                struct.pack(
                    "<IHHHHHHIIIHHHHHII",
                    0x02014B50,
                    45,
                    45 if need64 else 20,
                    0x0800,
                    8,
                    self.dtime,
                    self.ddate,
                    crc,
                    0xFFFFFFFF if need64 else comp,
                    0xFFFFFFFF if need64 else raw,
                    len(bname),
                    len(extra),
                    0,
                    0,
                    0,
                    0,
                    0xFFFFFFFF if need64 else off,
                )
                + bname
                + extra
            )
        cd_size = self.offset - cd_start
        n = len(self.entries)
        if n >= 0xFFFF or cd_start >= 0xFFFFFFFF or cd_size >= 0xFFFFFFFF:
            z64_off = self.offset
            self._write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, cd_size, cd_start))
            self._write(struct.pack("<IIQI", 0x07064B50, 0, z64_off, 1))
            self._write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF,
                                    len(comment)) + comment)
        else:
            self._write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, cd_size, cd_start, len(comment)) + comment)
