"""Files of sorted arrays in the shared folder, which workers map into memory.

A file is one line of JSON, `{"rows": n, "columns": [[name, type], ...]}`, padded with spaces to a
multiple of 64 bytes, and then the values of each column, padded likewise; little-endian. A file is written
under the name of its task attempt and then renamed. A task that runs again finds the file and
leaves it, as its bytes follow from the input alone.
"""

from __future__ import annotations

import json
import uuid
from functools import lru_cache

import numpy as np
from pyarrow import fs as pafs

from .records import store

_ALIGN = 64
#: Files that one worker keeps open; those of a local mount take no memory of their own.
OPEN_FILES = 512


def _padded(data: bytes, with_: bytes = b"\0") -> bytes:
    return data + with_ * (-len(data) % _ALIGN)


def put(folder: str, name: str, columns: dict[str, np.ndarray]) -> None:
    """Write columns of equal length as the file `name` of the folder."""
    system, base = store(folder)
    path = f"{base}/{name}"
    if system.get_file_info(path).type == pafs.FileType.File:
        return
    system.create_dir(base)
    own = f"{path}.{uuid.uuid4().hex}"
    head = {"rows": len(next(iter(columns.values()))), "columns": [[n, a.dtype.newbyteorder("<").str] for n, a in columns.items()]}
    with system.open_output_stream(own) as f:
        f.write(_padded(json.dumps(head).encode() + b"\n", b" "))
        for n, a in columns.items():
            f.write(_padded(np.ascontiguousarray(a).astype(a.dtype.newbyteorder("<"), copy=False).tobytes()))
    try:
        system.move(own, path)
    except OSError:
        if system.get_file_info(path).type != pafs.FileType.File:
            raise
        system.delete_file(own)


@lru_cache(maxsize=OPEN_FILES)
def get(folder: str, name: str) -> dict[str, np.ndarray] | None:
    """The columns of a file, mapped into memory where the folder is a mount, else read; None if there is no such file."""
    system, base = store(folder)
    path = f"{base}/{name}"
    info = system.get_file_info(path)
    if info.type != pafs.FileType.File:
        return None
    if isinstance(system, pafs.LocalFileSystem):
        data = np.memmap(path, np.uint8, "r").view(np.ndarray)  # a plain array is sliced faster
    else:
        with system.open_input_file(path) as f:
            data = np.frombuffer(f.read(), np.uint8)
    end = data[: 1 << 20].tobytes().index(b"\n") + 1
    head, at, out = json.loads(data[:end].tobytes()), end + -end % _ALIGN, {}
    for n, kind in head["columns"]:
        size = np.dtype(kind).itemsize * head["rows"]
        out[n] = data[at : at + size].view(kind)
        at += size + -size % _ALIGN
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each of the wanted keys stands among sorted keys, -1 if nowhere. Ascending `wanted` are fastest."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)
