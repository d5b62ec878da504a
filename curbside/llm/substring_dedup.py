"""Removal of long passages that occur more than once.

Every window of ``width`` words has a Rabin-Karp hash. Documents are dealt once into chunks; a chunk counts its own windows
first, so that a passage that fills a third of the data leaves each chunk at most once, and sends the distinct hashes to
buckets, chosen by a second, independent hash. A bucket counts each hash over all chunks and answers every chunk with one
bit per hash. The chunks are the same in both passes (the same exchange, read again), so that the bits find their windows by
order alone. Repeated windows merge into maximal intervals, and the words outside are kept. Equal rows are one row with a
count, which a chunk never holds twice; they are merged within each batch before they move.

Two different windows are only confused if the 64-bit hash and the bucket of the other hash both agree.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.storage import carrying, hand_back, release_caches
from curbside.llm.words import Words

WIDTH = 35

#: A row that stands for more equal ones than this leaves its chunk as several.
MOST_COPIES = 4096

#: Rows that leave a batch at once, so that batches of long texts are not held twice.
ROWS = 1024

#: Text in a chunk and hashes in a bucket, in bytes; both are counted out for the data at hand.
CHUNK_BYTES, BUCKET_BYTES, LEAST_PARTS = 3 << 20, 12 << 20, 128


def remove_repeats(docs: DataFrame, width: int = WIDTH, keep_text: bool = True, id_column: str = "doc_id") -> DataFrame:
    """``n_words``, ``n_removed``, ``removed`` (intervals of word places) and ``kept_text`` of every document.

    A word goes if any window of ``width`` words that covers it also starts elsewhere in the data, in the same document
    included: all copies go, the first too. Windows are judged on the input. Words are maximal runs of bytes other than
    space and 0x09-0x0D; kept words are joined by one space. A null or empty text has no words and an empty kept text;
    fewer words than ``width`` are never removed. Rows with the same or a null ``doc_id`` are documents of their own: two
    equal rows lose all windows. Other columns are ignored. ``keep_text=False`` gives ``kept_sha256`` instead of the text.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(LEAST_PARTS, math.ceil(size / CHUNK_BYTES))
    buckets = max(LEAST_PARTS, math.ceil(size / 5 * 8 / BUCKET_BYTES))
    # A third of all rows may share an id, so that the text takes part in the choice of a chunk.
    key = F.xxhash64(id_column, "text").alias("key")
    rows = docs.select(key, F.col(id_column).alias("id"), "text")
    merged = rows.mapInArrow(_merge, carrying(docs, id_column, "id", "key bigint, text string, times bigint"))
    dealt = merged.withColumn("chunk", F.pmod("key", F.lit(chunks)).cast("int")).repartition(_tasks(chunks), "chunk")
    # The exchange by chunk holds all rows of one key already: no second one.
    dealt = dealt.groupBy("chunk", "id", "text").agg(F.sum("times").alias("times"))

    hashes = dealt.groupBy("chunk").applyInArrow(_sender(width, buckets), "chunk int, bucket int, hashes binary, many binary")
    answers = hashes.repartition(_tasks(buckets), "bucket").groupBy("bucket").applyInArrow(_count, "chunk int, bucket int, repeated binary")
    kept = "kept_text string" if keep_text else "kept_sha256 string"
    rest = f"n_words bigint, n_removed bigint, removed array<struct<first:bigint,end:bigint>>, {kept}, _copies bigint"
    found = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_remover(width, buckets, keep_text, id_column), carrying(docs, id_column, id_column, rest))
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return found.withColumn("_copies", copies).drop("_copies")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch that repeat id and text, as one row with the number of ``times``."""
    release_caches()
    for batch in batches:
        key = batch.column("key").to_numpy()
        order = np.argsort(key, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        for i in np.flatnonzero(~new):  # equal keys: the rows themselves decide
            a, b = int(order[i - 1]), int(order[i])
            new[i] = any(batch.column(c)[a].as_py() != batch.column(c)[b].as_py() for c in ("id", "text"))
        times = np.bincount(np.cumsum(new) - 1, minlength=int(new.sum()))
        first = order[new]
        for at in range(0, len(first), ROWS):
            kept = batch.take(pa.array(first[at : at + ROWS]))
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in ("id", "key", "text")), pa.array(times[at : at + ROWS], pa.int64())], names=["id", "key", "text", "times"])


def _tasks(groups: int) -> int:
    """Several groups per task, so that hashing groups to tasks comes out even."""
    return max(1, groups // 4)


class ChunkWindows:
    """The windows of a chunk's rows, in whatever order these arrive."""

    def __init__(self, texts: pa.Table, width: int, buckets: int):
        self.words = Words(texts.column("text"))
        self.starts, self.hashes = self.words.windows(width)
        _, other = self.words.windows(width, 1)
        self.buckets = ((other >> np.uint64(24)) % np.uint64(buckets)).astype(np.uint32)
        self.times = texts.column("times").to_numpy()[self.words.row[self.starts]]

    def sorted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bucket, hash and number of windows of each distinct pair, by bucket and hash; the order of the windows, and
        for each window in that order the place of its pair."""
        by_hash = np.argsort(self.hashes)
        order = by_hash[np.argsort(self.buckets[by_hash], kind="stable")]
        bucket, value = self.buckets[order], self.hashes[order]
        new = np.ones(len(order), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (value[1:] != value[:-1])
        place = np.cumsum(new) - 1
        return bucket[new], value[new], np.bincount(place, self.times[order], minlength=int(new.sum())), order, place


def _sender(width: int, buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        hand_back()
        bucket, value, n, *_ = ChunkWindows(rows, width, buckets).sorted()
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=1 << 40)) if len(bucket) else np.zeros(1, np.int64)
        out: tuple[list, ...] = ([], [], [], [])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            out[0].append(rows.column("chunk")[0].as_py())
            out[1].append(int(bucket[a]))
            out[2].append(value[a:b].tobytes())
            out[3].append(np.packbits(n[a:b] > 1).tobytes())
        return pa.table([pa.array(c, k) for c, k in zip(out, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "bucket", "hashes", "many"])

    return run


def _count(rows: pa.Table) -> pa.Table:
    """Which hashes of a bucket stand in several chunks, or several times in one: bits in the order of each sender."""
    hand_back()
    sent = [np.frombuffer(x.as_py(), np.uint64) for x in rows.column("hashes")]
    many = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(s)) for x, s in zip(rows.column("many"), sent, strict=True)]
    every, flags = np.concatenate(sent), np.concatenate(many)
    order = np.argsort(every)
    value = every[order]
    same = value[1:] == value[:-1]
    again = np.zeros(len(value), bool)
    again[1:] |= same
    again[:-1] |= same
    repeated = np.empty(len(value), bool)
    repeated[order] = again
    repeated |= flags.astype(bool)
    bits = [np.packbits(part).tobytes() for part in np.split(repeated, np.cumsum([len(s) for s in sent])[:-1])]
    return pa.table([rows.column("chunk"), rows.column("bucket"), pa.array(bits, pa.binary())], names=["chunk", "bucket", "repeated"])


def _remover(width: int, buckets: int, keep_text: bool, id_column: str):
    names = [id_column, "n_words", "n_removed", "removed", "kept_text" if keep_text else "kept_sha256"]

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            raise ValueError("an answer without its chunk")
        hand_back()
        chunk = ChunkWindows(rows, width, buckets)
        words = chunk.words
        bucket, _, _, order, place = chunk.sorted()
        repeated = np.zeros(len(bucket), bool)
        for b, bits in zip(answers.column("bucket").to_pylist(), answers.column("repeated"), strict=True):
            a, z = np.searchsorted(bucket, [b, b + 1])
            repeated[a:z] = np.unpackbits(np.frombuffer(bits.as_py(), np.uint8), count=z - a)
        starts = chunk.starts[order[repeated[place]]]
        edge = np.zeros(len(words.hashes) + 1, np.int32)
        edge[starts] += 1
        edge[starts + width] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        before = np.concatenate([[0], np.cumsum(gone)])
        removed = before[words.first[1:]] - before[words.first[:-1]]
        intervals, kept = [], []
        for i, text in enumerate(rows.column("text")):
            a, z = int(words.first[i]), int(words.first[i + 1])
            cuts = np.flatnonzero(np.diff(gone[a:z], prepend=False, append=False)) if removed[i] else np.zeros(0, np.int64)
            pairs = cuts.reshape(-1, 2).tolist()
            intervals.append([{"first": p, "end": q} for p, q in pairs])
            own = (text.as_py() or "").encode().split() if removed[i] < z - a else []
            for p, q in reversed(pairs):
                del own[p:q]
            joined = b" ".join(own)
            kept.append(joined.decode() if keep_text else hashlib.sha256(joined).hexdigest())
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])), pa.string())
        columns = [rows.column("id"), *(pa.array(c, k) for c, k in zip((words.counts, removed, intervals, kept), kinds, strict=True))]
        times = rows.column("times").to_numpy()
        parts = -(-times // MOST_COPIES)
        sizes = np.full(int(parts.sum()), MOST_COPIES, np.int64)
        sizes[np.cumsum(parts) - 1] = times - (parts - 1) * MOST_COPIES
        found = pa.table(columns, names=names)
        if len(sizes) > len(times):
            found = found.take(pa.array(np.repeat(np.arange(len(times)), parts)))
        return found.append_column("_copies", pa.array(sizes))

    return run
