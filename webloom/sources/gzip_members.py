"""Byte ranges of archives that consist of many gzip members.

A gzip file may hold any number of members one after another, each a stream of
its own; archives of records are written with a member per record, so that they can be
read from any member on.  ``runs`` reads the members that begin inside a byte
range: it looks for the gzip mark, and takes it for a border where the bytes behind it
decompress to something that begins with ``head``.  Members that begin otherwise
continue the run before them.  Every byte belongs to the run of exactly one range:
the file's first run begins at byte 0 whatever it holds, and a run that begins inside a
range is read beyond the range's end up to the next border.

Memory follows the block size, not the member or the file.  Limit: an archive that lies
uncompressed inside a member of another one is taken for members of the outer one.
"""

from __future__ import annotations

import io
import zlib

# Fixed values of the gzip format: mark and method; zlib's window bits for gzip.
GZIP_MARK = b"\x1f\x8b\x08"
_GZIP = 31

BLOCK = 1 << 18


def begins(file, offset: int, head: bytes) -> bool:
    """Does a member at ``offset`` decompress to something that begins with ``head``?"""
    file.seek(offset)
    inflate, out = zlib.decompressobj(_GZIP), b""
    try:
        while len(out) < len(head) and not inflate.eof:
            data = file.read(4096)
            if not data:
                break
            out += inflate.decompress(data, len(head) - len(out))
    except zlib.error:
        return False
    return out.startswith(head)


def find(file, start: int, end: int, head: bytes) -> int | None:
    """The first border in [start, end), or None."""
    at = start
    while at < end:
        file.seek(at)
        block = file.read(BLOCK + len(GZIP_MARK) - 1)
        hit = block.find(GZIP_MARK)
        while hit >= 0 and at + hit < end:
            if begins(file, at + hit, head):
                return at + hit
            hit = block.find(GZIP_MARK, hit + 1)
        if len(block) < BLOCK:
            return None
        at += BLOCK
    return None


class Run(io.RawIOBase):
    """The decompressed bytes from the border at ``start`` to the next one.

    At its end ``border`` is the next border (None at the end of the file); ``damage``
    says what is wrong where the bytes from ``at`` on are no gzip member."""

    def __init__(self, file, start: int, head: bytes):
        self.file, self.start, self.head = file, start, head
        self.at = self.read_at = start
        self.raw, self.out, self.fresh, self.inflate = b"", b"", None, None
        self.border = self.damage = None
        self.done = False

    def readable(self):
        return True

    def readinto(self, buf):
        while not self.out and not self.done:
            self._step()
        n = min(len(buf), len(self.out))
        buf[:n], self.out = self.out[:n], self.out[n:]
        return n

    def finish(self):
        """Goes to the end without keeping what is read."""
        while not self.done:
            self.out = b""
            self._step()
        self.out = b""

    def _more(self) -> bytes:
        self.file.seek(self.read_at)
        data = self.file.read(BLOCK)
        self.read_at += len(data)
        return data

    def _next_member(self):
        # Zero bytes may pad a member's end.
        self.raw = self.raw.lstrip(b"\0")
        while not self.raw:
            data = self._more()
            if not data:
                self.done = True
                return
            self.raw = data.lstrip(b"\0")
        self.at = self.read_at - len(self.raw)
        self.inflate, self.fresh = zlib.decompressobj(_GZIP), b"" if self.at > self.start else None

    def _step(self):
        if self.inflate is None:
            self._next_member()
            return
        data = self.raw or self._more()
        # A member's first bytes decide whether it is a border, whatever follows them.
        limit = BLOCK if self.fresh is None else len(self.head) - len(self.fresh)
        try:
            out = self.inflate.decompress(data, limit) if data else self.inflate.flush()
        except zlib.error as e:
            self.done, self.damage = True, str(e)
            return
        ended = self.inflate.eof
        self.raw = self.inflate.unused_data if ended else self.inflate.unconsumed_tail
        if not data and not ended:
            self.done, self.damage = True, "the last member is cut off"
        if self.fresh is not None:
            self.fresh += out
            out = b""
            if len(self.fresh) >= len(self.head) or ended or self.done:
                if self.fresh.startswith(self.head):
                    self.done, self.border, self.damage = True, self.at, None
                else:
                    out = self.fresh
                self.fresh = None
        self.out += out
        if ended:
            self.inflate = None


def runs(file, start: int, end: int, head: bytes):
    """Yields (run, buffered reader) of each run that begins in [start, end)."""
    at = 0 if start == 0 else find(file, start, end, head)
    while at is not None and at < end:
        run = Run(file, at, head)
        yield run, io.BufferedReader(run, buffer_size=BLOCK)
        run.finish()
        at = find(file, run.at + 1, end, head) if run.damage else run.border
