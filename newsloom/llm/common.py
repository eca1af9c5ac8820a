"""What several operators of this folder share: intermediate tables and words."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

#: The six ASCII white-space characters part words; every other character belongs to one.
WORD_CHARS = r"[^\x20\x09-\x0D]+"


class Scratch:
    """Intermediate tables of one run, in the folder that all executors share.

    A saved frame no longer depends on the executors that made it, and what it numbers or samples
    cannot change any more. ``drop`` removes tables that no later step reads; what a returned frame
    still reads stays in the shared folder.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        if _scopes:
            _scopes[-1].append(self)
        self.run = uuid.uuid4().hex
        self.root = f"{shared_dir(spark).rstrip('/')}/newsloom/{tag}-{self.run}"
        self._made = 0

    def save(self, df: DataFrame, name: str, codec: str = "zstd", by: tuple[str, ...] = ()) -> DataFrame:
        self._made += 1
        path = f"{self.root}/{self._made:03d}-{name}"
        df.write.option("compression", codec).partitionBy(*by).parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved.scratch_path = path
        return saved

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self._delete(table.scratch_path)

    def remove(self) -> None:
        """Delete all tables of this run, once nothing reads them any more."""
        self._delete(self.root)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


_scopes: list[list[Scratch]] = []


@contextmanager
def scratch_scope():
    """Remove at the end what operators called inside have kept. What is still needed of their results must
    have been written by then, by a ``Scratch`` made outside."""
    _scopes.append([])
    try:
        yield
    finally:
        for scratch in _scopes.pop():
            scratch.remove()


_made_of: tuple[Any, Any] = (None, None)


def worker_model(value: Any, make: Callable[[Any], Any]) -> Any:
    """What ``make`` builds of a broadcast value, kept by a Python worker between tasks. A worker holds
    one such object at a time, so a later operator does not pay for the tables of an earlier one. The
    value itself is kept beside it, so another one cannot be taken for it."""
    global _made_of
    if _made_of[0] is not value:
        _made_of = (None, None)
        _made_of = (value, make(value))
    return _made_of[1]


class Generations:
    """A table of results in two generations of up to ``limit`` entries: when the younger is full it
    becomes the older one, whose entries are forgotten unless they were met again meanwhile."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def turn(self) -> None:
        """Make room; call between pieces of work, as entries may go."""
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}

    def recall(self, keys: Iterable) -> list:
        """Take keys that the older generation knows into the younger; returns those it does not know."""
        fresh = []
        for key in keys:
            value = self.old.get(key)
            if value is None:
                fresh.append(key)
            else:
                self.young[key] = value
        return fresh


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8, with A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split() if text else []
