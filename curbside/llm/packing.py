"""Best-fit packing of token sequences in bulk rounds, planned on the driver.

Pieces of one length are interchangeable, and so are gaps of one width. A round takes all pieces of the greatest length that
is left, finds the successor gap (the narrowest that is wide enough), fills as many gaps of that width as there are
pieces or gaps, moves these gaps to their new width and repeats; without a successor it opens new sequences. So one step
moves thousands of pieces at once, and the state is a histogram with at most ``capacity`` lengths and widths, however
many pieces there are; the rounds run as one loop on the driver, not in Spark. Conflicts are resolved by rank: pieces are range-sorted by length and id in Spark, and the piece of
rank r within its length takes the r-th place that the rounds gave to this length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbside.llm.bpe import word_ids
from curbside.llm.storage import hand_back, stage

CAPACITY = 4096


def cut_documents(docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Token pieces of every whole document: ids, then ``end_id``, cut after every ``capacity`` ids.

    A null text counts as empty and so has the one id ``end_id``. Repeated rows and null ids stay rows of their own.
    """
    spec = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()  # what tasks of earlier stages left
        cache = word_ids(spec.value)
        look, end, width = cache.__getitem__, np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
                stream = b"".join([*map(look, cache.words(raw.as_py() or b"")), end])
                for piece, at in enumerate(range(0, len(stream), width)):
                    ids = memoryview(stream)[at : at + width]
                    for column, value in zip(rows, (i, piece, at // 4, len(ids) // 4, zlib.crc32(ids)), strict=True):
                        column.append(value)
            kinds = (batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def plan_places(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[tuple[int, int, int, int]]]:
    """The rounds. For each length the places in rank order: (first rank, ranks a sequence holds side by side, first
    sequence, offset); a run of ranks ends where the next begins."""
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # width: runs (first sequence, number of sequences)
    widths: list[int] = []
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    opened = 0

    def release(width: int, run: tuple[int, int]) -> None:
        if width and run[1]:
            if width not in gaps:
                bisect.insort(widths, width)
            gaps[width].append(run)

    for length in sorted(histogram, reverse=True):
        left, rank, places[length] = histogram[length], 0, []
        while left:
            at = bisect.bisect_left(widths, length)
            if at < len(widths):
                width = widths[at]
                first, number = gaps[width].pop()
                if not gaps[width]:
                    del gaps[width], widths[at]
                taken = min(number, left)
                release(width, (first + taken, number - taken))
                side = 1
            else:
                width, first = capacity, opened
                side = min(capacity // length, left)
                taken = left // side
                opened += taken
            places[length].append((rank, side, first, capacity - width))
            release(width - side * length, (first, taken))
            rank, left = rank + side * taken, left - side * taken
    return places


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each piece (``doc_id``, ``piece``, ``length``, others are kept) its ``sequence_id`` and ``offset``.

    Sequences hold at most ``capacity`` and have no holes. Ties are ranked by ``doc_id`` (null first), then ``piece``.
    An empty table gives an empty one. Longer pieces than the capacity are an error of the caller.
    """
    order = ["length", "doc_id", "piece"]
    pieces = stage(pieces, "unsorted-pieces")  # sorting by ranges reads its input twice
    rows = pieces.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    rows = stage(rows, "pieces")
    # One row per length and range: lengths lie in ranges in order, so that there are not many more than both together.
    runs = rows.groupBy("length", "part").count().orderBy("length", "part").collect()
    before: dict[int, int] = defaultdict(int)
    first: dict[tuple[int, int], int] = {}
    for r in runs:
        first[r.length, r.part] = before[r.length]
        before[r.length] += r["count"]
    if before and not 0 < min(before) <= max(before) <= capacity:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    places = plan_places(before, capacity)
    tables = {n: np.array(runs, np.int64) for n, runs in places.items()}
    spec = pieces.sparkSession.sparkContext.broadcast((tables, first))  # bounded by the lengths and ranges
    names = [c for c in rows.columns if c != "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, first = spec.value
        for batch in batches:
            length, part, rank = (batch.column(c).to_numpy() for c in ("length", "part", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for key in set(zip(length.tolist(), part.tolist(), strict=True)):
                mine = np.flatnonzero((length == key[0]) & (part == key[1]))
                ranks = rank[mine] - 1 + first[key]
                t = tables[key[0]]
                t = t[np.searchsorted(t[:, 0], ranks, "right") - 1]
                sequence[mine] = t[:, 2] + (ranks - t[:, 0]) // t[:, 1]
                offset[mine] = t[:, 3] + (ranks - t[:, 0]) % t[:, 1] * key[0]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("part", "length").orderBy("doc_id", "piece")).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "part")
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Tokenise once, then pack: the pieces hold a checksum of their ids, and so the texts move nowhere."""
    return pack(cut_documents(docs, definition, capacity, end_id), capacity)
