"""An append-only log of commits in a shared folder.

Whoever has written something under a name of its own makes it visible by one commit, a file of
a few bytes that is renamed into place; numbers are consecutive, and of two writers that want
the same number only one gets it. Nothing in the log is ever changed, so a reader that has read
it sees the same state until it reads again. The folder must be in a store whose rename is atomic.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from excursio.sources.state import read_or_none


class CommitConflict(Exception):
    """Another writer has committed what this one wanted to bring."""


@dataclass(frozen=True)
class Commit:
    """``name`` says what was done, once only; ``label`` where its rows are."""

    number: int
    name: str
    label: str
    #: Everything committed before no longer counts.
    replaces: bool = False


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs

    def all(self) -> list[Commit]:
        """Every commit in order; one row for each comes to the driver."""
        rows = read_or_none(self._spark, self._path, "json", "number long, name string, label string, replaces boolean")
        return sorted((Commit(**r.asDict()) for r in rows.collect()), key=lambda c: c.number) if rows is not None else []

    def current(self) -> list[Commit]:
        """The commits from the last replacing one on."""
        found = self.all()
        start = max((k for k, c in enumerate(found) if c.replaces), default=0)
        return found[start:]

    def add(
        self, name: str, label: str, *, replaces: bool = False, compatible: Callable[[list[Commit]], bool] | None = None, seen: int = 0
    ) -> Commit:
        """Commit under the next number.

        If others have committed since the log had ``seen`` entries, ``compatible`` decides on theirs:
        if it returns false, ``CommitConflict`` is raised and nothing is committed.
        """
        while True:
            found = self.all()
            if any(c.name == name for c in found) or (compatible and len(found) > seen and not compatible(found[seen:])):
                raise CommitConflict(name)
            seen, commit = len(found), Commit(len(found), name, label, replaces)
            if self._rename_into_place(f"{commit.number:010d}.json", json.dumps(asdict(commit))):
                return commit

    def _rename_into_place(self, name: str, text: str) -> bool:
        conf = self._spark.sparkContext._jsc.hadoopConfiguration()
        folder = self._hadoop.Path(self._path)
        files = folder.getFileSystem(conf)
        folder = files.makeQualified(folder)
        files.mkdirs(folder)
        hidden = self._hadoop.Path(folder, f".{uuid.uuid4().hex}")
        out = files.create(hidden, False)
        out.write(bytearray(text, "utf-8"))
        out.close()
        context = self._hadoop.FileContext.getFileContext(folder.toUri(), conf)
        rename = getattr(self._hadoop, "Options$Rename")
        try:
            context.rename(hidden, self._hadoop.Path(folder, name), self._spark.sparkContext._gateway.new_array(rename, 0))
        except Py4JJavaError as error:
            files.delete(hidden, False)
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
