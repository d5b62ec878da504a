"""Quartile bucket digests of texts, and of texts edited with their successor.

A digest counts hashed byte triplets in 256 buckets and writes for each bucket in which quartile of the counts it lies, after
a header with the logarithm of the length and the ratios of the quartiles. The difference of two digests is bounded, so the
likeness is a number from 0 to 1. Everything follows from the bytes alone: equal texts have equal digests.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.words import slices

BUCKETS = 256

#: A permutation of the bytes for hashing triplets, and the start value of each way to take three of four bytes.
TABLE = np.random.default_rng(1990).permutation(256).astype(np.uint8)
TRIPLETS = ((49, 1, 2), (12, 1, 3), (84, 2, 3))

#: Weights of a difference: each bucket differs by 0 to 3 steps, three steps count twice as much; each part of the header
#: is cut at HEADER_MOST.
BUCKET_COST = np.array([0, 1, 2, 6])
HEADER_MOST = 36
MOST = 6 * BUCKETS + 3 * HEADER_MOST


def bucket_counts(data: np.ndarray) -> np.ndarray:
    """How many hashed triplets of ``data`` fall in each bucket; a text under three bytes has none."""
    counts = np.zeros(BUCKETS, np.int64)
    first = [TABLE[data ^ np.uint8(salt)] for salt, _, _ in TRIPLETS]
    for (_, i, j), h in zip(TRIPLETS, first, strict=True):
        if (n := len(data) - j) > 0:
            h = TABLE[h[:n] ^ data[i : n + i]]
            counts += np.bincount(TABLE[h ^ data[j:]], minlength=BUCKETS)
    return counts


def digest(text: bytes) -> str:
    """80 hexadecimal characters: length class, both quartile ratios, check byte, then two bits per bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(1, len(data)), 1 << 20):  # three bytes of overlap: each triplet counts once
        piece = data[at : at + (1 << 20) + 3]
        counts += bucket_counts(piece)
        if at + (1 << 20) < len(data):
            counts -= bucket_counts(piece[1 << 20 :])
    ordered = np.sort(counts)
    low, middle, high = (int(ordered[BUCKETS * q // 4 - 1]) for q in (1, 2, 3))
    codes = (counts > low).astype(np.uint8) + (counts > middle) + (counts > high)
    length = min(255, round(8 * math.log2(len(data) + 1)))
    ratios = [min(255, round(255 * x / high)) if high else 0 for x in (low, middle)]
    packed = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    return bytes([length, *ratios, sum(ratios, length) % 256, *packed]).hex()


_STEPS = np.array([[abs((a >> s & 3) - (b >> s & 3)) for s in (0, 2, 4, 6)] for a in range(256) for b in range(256)])
_PAIR_COST = BUCKET_COST[_STEPS].sum(axis=1).reshape(256, 256)


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 for the greatest difference."""
    x, y = (np.frombuffer(bytes.fromhex(d), np.uint8) for d in (a, b))
    header = sum(min(HEADER_MOST, abs(int(x[i]) - int(y[i]))) for i in range(3))
    return 1.0 - (header + int(_PAIR_COST[x[4:], y[4:]].sum())) / MOST


def fingerprint_documents(docs: DataFrame, bytes_per_part: int = 8 << 20) -> DataFrame:
    """Digest every whole text and its text edited with the next document, in ascending ``doc_id``.

    The ids are cut into ranges at sampled quantiles, each range also gets the first document of the next one that
    holds any (of the first, after the last), and so the texts are moved once and each task streams its range in order.
    Null texts are empty. Null ids come first; rows of one id follow by text. A single row is its own successor.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size, count = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = max(1, min(int(count or 0) // 16, max(64, math.ceil((size or 0) / bytes_per_part))))
    cuts = docs.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    cuts = sorted({int(c) for c in cuts})
    edges = F.array(*(F.lit(c).cast("long") for c in cuts)) if cuts else F.expr("array(cast(null as bigint))")
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(edges, lambda c: c <= F.col("doc_id"))))
    rows = rows.withColumn("part", place if cuts else F.lit(0))

    # The first document of every range: a row per range, at most ``parts``.
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")
    heads = rows.groupBy("part").agg(F.min(order).alias("o")).select("part", "o.doc_id").orderBy("part").collect()
    if not heads:
        return spark.createDataFrame([], _SCHEMA)
    before = {h.part: heads[i - 1].part for i, h in enumerate(heads)}
    chosen = F.lit(False)
    for h in heads:
        if h.doc_id is None:
            chosen = chosen | F.col("doc_id").isNull()
    known = [h.doc_id for h in heads if h.doc_id is not None]
    first = rows.where(chosen | F.col("doc_id").isin(known)).groupBy("part", "doc_id").agg(F.min("text").alias("text"))
    to = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    extra = first.select("doc_id", "text", to[F.col("part")].alias("part"), F.lit(True).alias("guest"))
    both = rows.select("doc_id", "text", "part", F.lit(False).alias("guest")).unionByName(extra)
    tasks = both.repartitionByRange(max(1, len(heads)), "part").sortWithinPartitions("part", "guest", "doc_id", "text")
    return tasks.select("part", "guest", "doc_id", "text").mapInArrow(_fingerprint, _SCHEMA)


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple | None = None  # the document that waits for its successor
    out: list[tuple] = []
    for batch in batches:
        for part in slices(batch, "text"):
            for place, guest, doc_id, text in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                own = None if guest and held is None else digest(text.encode())
                if held is not None and held[0] == place:
                    out.append(_row(held, text, own))
                held = None if guest else (place, doc_id, text, own)
            yield _batch(out)
            out = []


def _row(held: tuple, following: str, next_digest: str) -> tuple:
    _, doc_id, text, own = held
    half = len(text) // 2
    edited = (text[: len(text) - half] + following[:half]).encode()
    changed = digest(edited)
    return doc_id, len(text), hashlib.sha256(edited).hexdigest(), own, changed, likeness(own, changed), likeness(own, next_digest)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))
