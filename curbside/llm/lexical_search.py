"""Ranked lexical search by scanning the documents with an automaton of all query terms.

There is no index of the documents. An Aho-Corasick automaton of the items' terms, each between two boundary marks, reads
every whole text once and gives the number of occurrences of each term; each output is mapped to the items that hold
the term. A first scan counts documents and lengths, a second one scores: a task keeps the best documents of each item, and
these meet in two steps, so that no task sees more than a bounded number of lists of one item.

Texts are read as bytes: all separators become one space and A-Z become a-z by one table, so that a term's boundaries are
spaces, whatever stood there. All score arithmetic is in 64-bit integers.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbside.llm.words import NO_TERM, buffers, slices

BEST = 50

#: Text of items searched in one scan, in bytes; more items make more scans.
PART_BYTES = 2 << 20

#: Sums of a block of documents held at once, and lists of one item that meet in one task.
CELLS, LISTS = 1 << 22, 256

#: One space for every byte that ends a term, a-z for A-Z.
PLAIN = bytes(0x20 if NO_TERM[b] else ord(chr(b).lower()) if b < 128 else b for b in range(256))

TERM = re.compile(rb"[^ ]+")


@dataclass(frozen=True)
class Queries:
    """The terms of some items, sorted, and which items hold each."""

    ids: tuple
    terms: tuple[bytes, ...]
    starts: np.ndarray  # of each term: where its items start; one more for the end
    items: np.ndarray
    name: str  # of the content


def terms_of(text: str | None) -> set[bytes]:
    return set(TERM.findall((text or "").encode().translate(PLAIN)))


def read_queries(rows: list[tuple]) -> Queries:
    """Rows of one id are one item with the terms of all."""
    by: dict = {}
    for item, text in rows:
        by.setdefault(item, set()).update(terms_of(text))
    ids = tuple(sorted(by, key=lambda i: (i is not None, i)))
    terms = sorted(set().union(*by.values()))
    held: list[list[int]] = [[] for _ in terms]
    place = {t: k for k, t in enumerate(terms)}
    for k, item in enumerate(ids):
        for t in by[item]:
            held[place[t]].append(k)
    starts = np.cumsum([0, *map(len, held)])
    items = np.array([k for x in held for k in x], np.int64)
    return Queries(ids, tuple(terms), starts, items, hashlib.sha256(b" ".join(terms)).hexdigest())


_automata: dict[str, ahocorasick.Automaton] = {}


def automaton(queries: Queries) -> ahocorasick.Automaton:
    """Terms between spaces, built once for each worker process; only the last one is kept."""
    if queries.name not in _automata:
        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, term in enumerate(queries.terms):
            made.add_word(f" {term.decode('latin-1')} ", k)
        made.make_automaton()
        _automata.clear()
        _automata[queries.name] = made
    return _automata[queries.name]


def count_terms(texts: pa.Array, queries: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, with repeats; and row, term and occurrences of each query term in a text, by row and term."""
    data, offsets = buffers(texts)
    plain = data.tobytes().translate(PLAIN)
    inside = np.append(np.frombuffer(plain, np.uint8) != 0x20, False)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[offsets] |= inside[offsets]
    first[-1] = False
    sums = np.append(0, np.cumsum(first))
    lengths = sums[offsets[1:]] - sums[offsets[:-1]]
    keys: list[np.ndarray] = [np.zeros(0, np.int64)]
    if queries.terms:
        machine, size, found = automaton(queries), len(queries.terms), itemgetter(1)
        text = plain.decode("latin-1")
        for row in np.flatnonzero(lengths).tolist():
            hits = np.fromiter(map(found, machine.iter(f" {text[offsets[row] : offsets[row + 1]]} ")), np.int64)
            hits += row * size
            keys.append(hits)
    key, times = np.unique(np.concatenate(keys), return_counts=True)
    row, term = np.divmod(key, max(1, len(queries.terms)))
    return lengths, row, term, times


def rank_documents(docs: DataFrame, items: DataFrame, best: int = BEST, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``best`` documents of each item with a score above 0.

    Equal scores are ranked by ascending id, null ids first; documents that repeat an id are ranked one by one. Null and
    empty texts have no terms and are never found, but nor do they count. Items of one id are one item with the terms of
    all; those without terms have no rows, and neither has an empty table on either side. Other columns are ignored. Ids
    of documents are integers.

    Items are read in parts of about ``part_bytes`` of their text, each a scan of its own.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    items = items.select(F.col(item_column).alias("item"), F.col(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / part_bytes))
    kind = items.schema["item"].dataType.simpleString()
    found = None
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part) if parts > 1 else items
        queries = read_queries([tuple(r) for r in mine.collect()])  # bounded by part_bytes
        own = _search(docs, queries, best, kind)
        found = own if found is None else found.unionByName(own)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def statistics(docs: DataFrame, queries: Queries) -> tuple[int, int, np.ndarray]:
    """N, L, and in how many documents each term occurs, over all documents."""
    spec = docs.sparkSession.sparkContext.broadcast(queries)  # bounded by PART_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = spec.value
        seen = np.zeros(len(queries.terms) + 2, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                lengths, _, term, _ = count_terms(part.column(0), queries)
                seen[:-2] += np.bincount(term, minlength=len(seen) - 2)
                seen[-2:] += (np.count_nonzero(lengths), lengths.sum())
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["term", "n"])

    rows = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    spec.destroy()
    out = np.zeros(len(queries.terms) + 2, np.int64)
    for r in rows:
        out[r.term] = r.n
    return int(out[-2]), int(out[-1]), out[:-2]


def _search(docs: DataFrame, queries: Queries, best: int, kind: str) -> DataFrame:
    spark = docs.sparkSession
    documents, words, seen = statistics(docs, queries)
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in seen.tolist()], np.int64)
    spec = spark.sparkContext.broadcast((queries, weights))  # bounded by PART_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = spec.value
        lists = BestLists(len(queries.ids), best)
        for batch in batches:
            for part in slices(batch, "text"):
                _score(part, queries, weights, documents, words, lists)
        item, score, valid, ids = lists.all()
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=~valid), pa.array(score)], names=["place", "id", "score"])

    found = docs.mapInArrow(run, "place int, id long, score long").withColumn("list", F.pmod(F.spark_partition_id(), F.lit(LISTS)))
    order = (F.desc("score"), F.asc_nulls_first("id"))
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("place", "list").orderBy(*order))).where(F.col("rank") <= best)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(*order))).where(F.col("rank") <= best)
    names = spark.createDataFrame(list(enumerate(queries.ids)), f"place int, item {kind}")
    return ranked.join(F.broadcast(names), "place").select("item", "rank", "id", "score")


def _score(part: pa.RecordBatch, queries: Queries, weights: np.ndarray, documents: int, words: int, lists: BestLists) -> None:
    lengths, row, term, times = count_terms(part.column(1), queries)
    if not len(row):
        return
    ids = part.column(0)
    valid = ids.is_valid().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy()
    half = 50 + (50 * lengths[row] * documents) // words
    value = weights[term] * ((1_000_000_000 * times) // (1000 * times + 20 * half))
    block = max(1, CELLS // lists.items)
    for at in range(0, int(row[-1]) + 1, block):
        a, b = np.searchsorted(row, [at, at + block])
        number = queries.starts[term[a:b] + 1] - queries.starts[term[a:b]]
        where = np.repeat(queries.starts[term[a:b]] - np.cumsum(number) + number, number) + np.arange(number.sum())
        sums = np.zeros((min(block, len(lengths) - at), lists.items), np.int64)
        np.add.at(sums.ravel(), np.repeat(row[a:b] - at, number) * lists.items + queries.items[where], np.repeat(value[a:b], number))
        r, item = np.nonzero(sums >= lists.floor)
        lists.add(item, sums[r, item], valid[at + r], ids[at + r])


class BestLists:
    """The ``best`` scores above 0 of each item so far, equal ones by id, null ids first."""

    def __init__(self, items: int, best: int):
        self.items, self.best = max(1, items), best
        self.floor = np.ones(self.items, np.int64)  # of each item: a smaller score is not among the best
        self.kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        self.new: list[tuple] = []
        self.size, self.room = 0, max(1 << 17, 2 * best * self.items)

    def add(self, *columns: np.ndarray) -> None:
        self.new.append(columns)
        self.size += len(columns[0])
        if self.size > self.room:
            self.all()

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        item, score, valid, ids = (np.concatenate(x) for x in zip(self.kept, *self.new, strict=True))
        order = np.lexsort((ids, valid, -score, item))
        first = np.searchsorted(item[order], np.arange(self.items + 1))
        order = order[np.arange(len(order)) - first[item[order]] < self.best]
        item, score, valid, ids = self.kept = item[order], score[order], valid[order], ids[order]
        first = np.searchsorted(item, np.arange(self.items + 1))
        full = np.flatnonzero(np.diff(first) == self.best)
        self.floor[full] = score[first[full + 1] - 1]
        self.new, self.size = [], 0
        return self.kept
