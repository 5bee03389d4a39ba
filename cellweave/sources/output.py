"""Folders whose parts appear together, once all of them are written."""

from __future__ import annotations

import json
import uuid
from types import TracebackType

from pyspark.sql import SparkSession

from cellweave.session import removed, renamed
from cellweave.sources.files import exists, read_text, write_text

#: Names what a run wrote, and is written last; where parts lie until then.
MANIFEST, STAGED = "_MANIFEST", "_staged"


class Output:
    """What one run writes into ``folder``: parts are written where :meth:`path` says, and named at the end.

    A folder with a manifest is finished, and writing into it is an error. What is in a folder
    without one a killed run has left: it is no output, and the next run writes it anew. Each run
    stages its parts by itself, so two runs beside each other never mix; the later one fails.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.names = spark, folder.rstrip("/"), []  # type: ignore[var-annotated]
        self._staged = f"{self.folder}/{STAGED}/{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        if name not in self.names:
            self.names.append(name)
        return f"{self._staged}/{name}"

    def __enter__(self) -> Output:
        if exists(f"{self.folder}/{MANIFEST}"):
            raise FileExistsError(self.folder)
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        if kind is None:
            written = [n for n in self.names if exists(self.path(n))]
            if exists(f"{self.folder}/{MANIFEST}"):
                kind = FileExistsError
            else:
                for name in written:
                    removed(self.spark, f"{self.folder}/{name}")
                    renamed(self.spark, self.path(name), f"{self.folder}/{name}")
                write_text(f"{self.folder}/{MANIFEST}", json.dumps({"parts": written}))
        removed(self.spark, self._staged)
        if kind is FileExistsError and error is None:
            raise FileExistsError(self.folder)


def part(folder: str, name: str) -> str:
    """The path of a finished folder's part; a folder that no run has finished is an error."""
    if not exists(f"{folder}/{MANIFEST}"):
        raise FileNotFoundError(f"{folder} is unfinished")
    if name not in json.loads(read_text(f"{folder}/{MANIFEST}"))["parts"]:
        raise FileNotFoundError(f"{folder} has no {name}")
    return f"{folder}/{name}"
