"""Files of records that Spark has no reader for: opened by content, listed and paired by name."""

from __future__ import annotations

import gzip
import io
import os
from typing import BinaryIO

import pyarrow.fs as pafs

SUFFIXES = tuple(s + z for s in (".fastq", ".fq", ".txt") for z in ("", ".gz"))
GZIP = b"\x1f\x8b"
#: A folder of parts that stands for one read file is named by Spark's way to write it.
NAMED = "name="


def located(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[5:]
    return pafs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


def opened(path: str) -> BinaryIO:
    """A buffered stream of ``path``, unzipped if its first bytes (not its name) say so."""
    store, name = located(path)
    with store.open_input_file(name) as f:
        zipped = f.read(2) == GZIP
    raw = store.open_input_stream(name, compression=None)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw) if zipped else raw, 1 << 20)  # type: ignore[arg-type]


def names_pair(a: str, b: str) -> bool:
    """Whether names differ in nothing but 1 against 2, as far as the shorter goes."""
    return all(x == y or {x, y} == {"1", "2"} for x, y in zip(a, b, strict=False))


def difference_positions(a: str, b: str) -> list[int]:
    return [i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y]


def prefix(path: str) -> str:
    """A file's name without folder, ``.gz`` and one extension."""
    return os.path.splitext(os.path.basename(path.removesuffix(".gz")).removeprefix(NAMED))[0]


def _listed(folder: str) -> list[pafs.FileInfo]:
    store, name = located(folder)
    return store.get_file_info(pafs.FileSelector(name))


def parts(path: str) -> list[str]:
    """The files that make up a read file: itself, or the parts in its folder by name."""
    store, name = located(path)
    if store.get_file_info(name).type != pafs.FileType.Directory:
        return [path]
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    return sorted(f"{scheme}{i.path}" for i in _listed(path) if i.is_file and i.base_name.startswith("part-"))


def listed_reads(folder: str) -> list[str]:
    """The read files of a folder by name: files with one of ``SUFFIXES``, and folders ``name=...`` of parts."""
    scheme = folder.split("://")[0] + "://" if "://" in folder else ""
    return sorted(f"{scheme}{i.path}" for i in _listed(folder) if (i.base_name.endswith(SUFFIXES) if i.is_file else i.base_name.startswith(NAMED)))


def paired(folder: str) -> list[tuple[str, str]]:
    """Neighbours of the sorted read files of ``folder``.

    No read files, an odd number of them, and names that do not pair are errors.
    """
    found = listed_reads(folder)
    if not found:
        raise ValueError(f"no read files in {folder}")
    if len(found) % 2:
        raise ValueError(f"an odd number of read files in {folder}")
    pairs = list(zip(found[::2], found[1::2], strict=True))
    for a, b in pairs:
        if not names_pair(a, b):
            raise ValueError(f"files do not pair: {a} {b}")
    return pairs


def read_text(path: str) -> str:
    """A small text file, gzipped or not, of any file system."""
    with opened(path) as stream:
        return stream.read().decode()


def size(path: str) -> int:
    store, name = located(path)
    return store.get_file_info(name).size


def exists(path: str) -> bool:
    store, name = located(path)
    return store.get_file_info(name).type != pafs.FileType.NotFound


def write_text(path: str, text: str) -> None:
    store, name = located(path)
    store.create_dir(os.path.dirname(name), recursive=True)
    with store.open_output_stream(name, compression=None) as out:
        out.write(text.encode())
