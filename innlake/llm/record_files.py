"""Length-delimited binary records with masked checksums and a separate index.

A data file is a row of frames:
    length u64 | masked CRC-32 of those 8 bytes u32 | payload | masked CRC-32 of the payload u32
all little-endian. A checksum is masked, rotated and shifted by a constant, so
that data which holds checksums itself doesn't look valid by chance. An index
file is: the offset of each frame u64 ..., their number u64, masked CRC-32 of
all before u32. The index lets a reader fetch frames in any order.

Files go to the cluster's shared folder through pyarrow's file systems, under a
name of their own attempt, and take their final name when complete: a task that
runs twice leaves the same file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyarrow import fs

_MASK = 0xA282EAD8


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked_crc(head)) + payload + struct.pack("<I", masked_crc(payload))


def write_records(folder: str, name: str, attempt: int, payloads: Iterable[bytes]) -> tuple[int, int]:
    """(records, bytes) written to folder/name.records and folder/name.index."""
    where, path = open_folder(folder)
    where.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{attempt}"
    offsets, at = [], 0
    with where.open_output_stream(f"{part}.records") as out:
        for payload in payloads:
            data = frame(payload)
            out.write(data)
            offsets.append(at)
            at += len(data)
    index = np.array([*offsets, len(offsets)], "<u8").tobytes()
    with where.open_output_stream(f"{part}.index") as out:
        out.write(index + struct.pack("<I", masked_crc(index)))
    for kind in ("records", "index"):
        where.move(f"{part}.{kind}", f"{path}/{name}.{kind}")
    return len(offsets), at


def read_index(folder: str, name: str) -> np.ndarray:
    where, path = open_folder(folder)
    with where.open_input_stream(f"{path}/{name}.index") as source:
        data = source.read()
    if len(data) < 12 or masked_crc(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError(f"damaged index of {name}")
    offsets = np.frombuffer(data[:-4], "<u8")
    if offsets[-1] != len(offsets) - 1:
        raise ValueError(f"index of {name} is cut off")
    return offsets[:-1]


def _next(source, name: str) -> bytes | None:
    head = source.read(12)
    if not head:
        return None
    if len(head) < 12 or masked_crc(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError(f"damaged length in {name}")
    size = struct.unpack("<Q", head[:8])[0]
    body = source.read(size + 4)
    if len(body) < size + 4 or masked_crc(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
        raise ValueError(f"damaged record in {name}")
    return body[:-4]


def read_all(folder: str, name: str) -> Iterator[bytes]:
    """All payloads in file order; fails on a checksum or a count that doesn't match."""
    where, path = open_folder(folder)
    expected, n = len(read_index(folder, name)), 0
    with where.open_input_stream(f"{path}/{name}.records", buffer_size=1 << 20) as source:
        while (payload := _next(source, name)) is not None:
            n += 1
            yield payload
    if n != expected:
        raise ValueError(f"{name} has {n} records, its index {expected}")


def read_some(folder: str, name: str, positions: Iterable[int]) -> Iterator[bytes]:
    """The payloads at the given positions, in that order, found through the index."""
    where, path = open_folder(folder)
    offsets = read_index(folder, name)
    with where.open_input_file(f"{path}/{name}.records") as source:
        for position in positions:
            source.seek(int(offsets[position]))
            yield _next(source, name)
