"""Gzip files made of blocks: where blocks begin, what they hold, and shares of such a file.

A block is a gzip member of at most 64 KB whose header tells its compressed size. A place in the
data is a virtual offset: the block's offset in the file times 65,536, plus the place within the
block's data.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np

MAGIC = b"\x1f\x8b\x08\x04"
#: Bytes of data that a written block holds.
FULL = 65_280
#: The virtual offset of a file's end.
END = (1 << 63) - 1


def block_size(head: bytes) -> int:
    """Compressed size of the block that ``head`` begins; 0 if it begins none."""
    if head[:4] != MAGIC or len(head) < 18:
        return 0
    extra, at = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]], 0
    while at + 6 <= len(extra):
        size = struct.unpack_from("<H", extra, at + 2)[0]
        if extra[at : at + 2] == b"BC" and size == 2:
            return struct.unpack_from("<H", extra, at + 4)[0] + 1
        at += 4 + size
    return 0


def blocks(raw: io.BufferedReader, at: int) -> Iterator[tuple[int, bytes]]:
    """(offset, data) of the blocks from the one at offset ``at``."""
    raw.seek(at)
    while head := raw.read(18):
        size = block_size(head)
        if not size:
            raise ValueError(f"no block at {at}")
        whole = head + raw.read(size - 18)
        yield at, zlib.decompress(whole[12 + struct.unpack_from("<H", whole, 10)[0] : -8], -15)
        at += size


def first_block(raw: io.BufferedReader, start: int, size: int) -> int:
    """Offset of the first block at ``start`` or later which another one or the file's end follows; ``size`` if none."""
    if start >= size:
        return size
    raw.seek(start)
    data = raw.read(1 << 18)
    at = data.find(MAGIC)
    while at >= 0:
        n = block_size(data[at : at + 64])
        if n and (start + at + n == size or data[at + n : at + n + 4] == MAGIC):
            return start + at
        at = data.find(MAGIC, at + 1)
    return size


def compressed(data: bytes) -> bytes:
    """``data``, ``FULL`` bytes at most, as one block."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    return MAGIC + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


class Window:
    """Data of the blocks from offset ``start`` on, as far as it was asked for, and where it lies in the file."""

    def __init__(self, raw: io.BufferedReader, start: int):
        self._blocks = blocks(raw, start)
        self.data = bytearray()
        self._begins: list[int] = []  # of each block held, in ``data``
        self._offsets: list[int] = []

    def more(self) -> bool:
        found = next(self._blocks, None)
        if found is None:
            return False
        self._begins.append(len(self.data))
        self._offsets.append(found[0])
        self.data += found[1]
        return True

    def has(self, n: int) -> bool:
        """Whether there are ``n`` bytes of data, once as many blocks as needed are read."""
        while len(self.data) < n:
            if not self.more():
                return False
        return True

    def places(self, at: np.ndarray) -> np.ndarray:
        """Virtual offsets of places in ``data``."""
        block = np.searchsorted(self._begins, at, "right") - 1
        return (np.array(self._offsets, np.int64)[block] << 16) + at - np.array(self._begins, np.int64)[block]

    def place(self, at: int) -> int:
        """Virtual offset of one place, of the next block's data if a block ends there."""
        return int(self.places(np.array([at]))[0]) if self.has(at + 1) else END

    def until(self, place: int) -> int:
        """Where in ``data`` the virtual offset lies, or the end of what is held if it lies beyond that."""
        k = int(np.searchsorted(self._offsets, place >> 16))
        if k == len(self._offsets):
            return len(self.data)
        return self._begins[k] + (place & 0xFFFF if self._offsets[k] == place >> 16 else 0)

    def reached(self, place: int) -> bool:
        return bool(self._offsets) and self._offsets[-1] >= place >> 16

    def drop(self, n: int) -> None:
        """Forget the first ``n`` bytes of data."""
        del self.data[:n]
        keep = max(0, int(np.searchsorted(self._begins, n, "right")) - 1)
        self._begins = [b - n for b in self._begins[keep:]]
        self._offsets = self._offsets[keep:]
