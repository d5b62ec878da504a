"""Keeping a small derived table, so that later steps do not rescan the trips."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame

_kept: ContextVar[list[DataFrame] | None] = ContextVar("kept", default=None)


@contextmanager
def settling() -> Iterator[None]:
    """The tables that ``settle`` keeps inside this block are released at its end, also if it fails.

    The block holds the last reader of these tables, that is the action on whatever derives from them. Of
    nested blocks, each releases its own.
    """
    own: list[DataFrame] = []
    token = _kept.set(own)
    try:
        yield
    finally:
        _kept.reset(token)
        for table in reversed(own):
            table.unpersist()


def settle(df: DataFrame) -> DataFrame:
    """Keep the rows of a zone-sized or hourly-sized table once they were computed.

    The same under any master and without any setting. The executors hold the rows, on disk if memory
    runs short; those of a lost executor are computed again from their source. The batch job writes
    its tables to its output folder and reads them back instead. Inside ``settling`` the table is released at
    the end of the block, elsewhere by its caller.
    """
    if (own := _kept.get()) is not None:
        own.append(df)
    return df.persist()
