"""Block-compressed files: blocks found from any offset, and records found from any block, so that a file is read in parts."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

MAGIC = b"\x1f\x8b\x08\x04"
#: Fixed value: the empty block that ends every whole file.
LAST = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Bytes that a block is filled with at most; compressed bytes read at once; uncompressed bytes cut into records at once.
PAYLOAD, READ, WINDOW = 65280, 4 << 20, 8 << 20
#: Uncompressed bytes after the end of a part over which the next part's first record is worked out again.
PROOF = 1 << 18


def place(uri: str):
    """(file system, path) of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if re.match(r"[a-z0-9]+:", uri) else (fs.LocalFileSystem(), uri)


def listing(uri: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of a folder's files by name; names that begin with '_' or '.' don't count."""
    from pyarrow import fs

    system, path = place(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(uri)
    found = [info] if info.type == fs.FileType.File else [x for x in system.get_file_info(fs.FileSelector(path)) if x.type == fs.FileType.File and x.base_name[0] not in "_."]
    return sorted((x.path, x.size) for x in found)


def block_size(head: bytes) -> int | None:
    """The size of the block that begins with head, None if none does."""
    if len(head) < 18 or head[:4] != MAGIC:
        return None
    extra, at = struct.unpack_from("<H", head, 10)[0], 12
    while at + 4 <= min(12 + extra, len(head) - 2):
        n = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"BC" and n == 2:
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + n
    return None


def is_blocked(uri: str) -> bool:
    """Whether the first file there is block-compressed; plain gzip isn't."""
    system, _ = place(uri)
    files = listing(uri)
    if not files:
        return False
    with system.open_input_file(files[0][0]) as f:
        return block_size(f.read(512)) is not None


def pack_block(payload: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = c.compress(payload) + c.flush()
    return MAGIC + struct.pack("<IBBHHHH", 0, 0, 255, 6, 0x4342, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(payload), len(payload))


def first_block(file, size: int, at: int) -> int:
    """The first offset from `at` on at which a block begins, or size: its header, its checksum and the header behind it agree."""
    while 0 < at < size:
        file.seek(at)
        raw = file.read(1 << 18)
        for m in re.finditer(re.escape(MAGIC), raw):
            k = m.start()
            n = block_size(raw[k : k + 512])
            if not n or k + n > len(raw):
                continue
            behind = raw[k + n : k + n + 512]
            if at + k + n < size and len(behind) >= 18 and block_size(behind) is None:
                continue
            try:
                zlib.decompress(raw[k : k + n], 31)
            except zlib.error:
                continue
            return at + k
        if len(raw) < 1 << 18:
            return size
        at += len(raw) - (1 << 16) - 512
    return min(at, size)


def blocks(file, size: int, at: int) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of the blocks from the one at `at` on; a cut or damaged one is an error."""
    file.seek(at)
    raw, k = b"", 0
    while True:
        n = block_size(raw[k : k + 512])
        if n is None or k + n > len(raw):
            more = file.read(READ)
            if not more:
                if k < len(raw):
                    raise ValueError(f"no whole block at offset {at + k}: the file is truncated or damaged")
                return
            at, raw, k = at + k, raw[k:] + more, 0
            continue
        try:
            payload = zlib.decompress(raw[k : k + n], 31)
        except zlib.error as e:
            raise ValueError(f"the block at offset {at + k} is damaged: {e}") from e
        yield at + k, payload
        k += n


#: (buffer, first position, whether nothing follows) to the starts of the whole records there, and the end of the last.
Cut = Callable[[bytes, int, bool], tuple[list[int], int]]
#: (buffer, position, whether nothing follows) to the first record that begins behind the position, None without one.
Border = Callable[[bytes, int, bool], int | None]


def records(file, size: int, start: int, stop: int, cut: Cut, border: Border, skip: int | None = None) -> Iterator[tuple[bytes, list[int]]]:
    """(buffer, the starts of its records and the last one's end) over the records of one part of a file, compressed bytes start to stop.

    Records belong to the part in whose blocks they begin; one that begins with a part's first block
    belongs to the part before. skip, if given, says at which byte of the part's first block its first
    record begins (the start of a file needs no search). Where a part ends, the search of the next one
    is repeated on the same bytes: if it would find another record than the one that really
    follows, that is an error, so records are never lost or read twice.
    """
    at = start if skip is not None else first_block(file, size, start)
    if at >= min(stop, size):
        return
    source, buf, limit, pos, whole = blocks(file, size, at), b"", None, skip, False

    def more() -> None:
        nonlocal buf, limit, whole
        parts, n = [buf], len(buf)
        want = n + WINDOW if limit is None else n + PROOF
        while n < want:
            offset, payload = next(source, (None, b""))
            if offset is None:
                whole = True
                break
            if limit is None and offset >= stop:
                limit = n
                want = n + PROOF
            parts.append(payload)
            n += len(payload)
        buf = b"".join(parts)

    more()
    while skip and len(buf) < skip and not whole:
        more()
    while pos is None:
        pos = border(buf, 0, whole)
        if pos is None:
            if whole:
                return
            more()
        elif limit is not None and pos > limit:
            return
    while True:
        starts, end = cut(buf, pos, whole)
        if limit is None:
            if starts:
                yield buf, [*starts, end]
            if whole:
                return
            buf, pos = buf[end:], 0
            more()
            continue
        mine = [x for x in starts if x <= limit]
        behind = next((x for x in [*starts, end] if x > limit), None)
        if behind is None or (behind == end and not whole):
            # The last record isn't whole yet, or what follows it isn't known.
            more()
            continue
        guess = border(buf, limit, whole)
        if guess is None and behind < len(buf):
            if not whole:
                more()
                continue
            raise ValueError("a part's first record can't be found: read the file in fewer parts")
        if guess is not None and guess != behind:
            raise ValueError("a part's first record was taken for another: read the file in fewer parts")
        if mine:
            yield buf, [*mine, behind]
        return
