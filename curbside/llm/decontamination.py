"""Benchmark decontamination by suffix arrays over the training text.

A shard is a run of whole texts that one task holds at a time; its suffix array orders all suffixes of its word sequence, by
prefix doubling over word numbers, as far as the longest test item reaches. Every suffix of every item is found in it by a
binary search that runs for all of them at once. Its neighbours give the longest verbatim match; where that covers a window
of the item, two more searches bound all places of the window, and the words there are hit. Test suffixes are sorted
arrays of word hashes in one file that each machine fetches once and maps into memory. No text is shuffled.

Words count as equal if their 64-bit hashes agree.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.storage import carrying, serve
from curbside.llm.words import NO_TERM, Words, slices

WIDTH = 10

#: Words of a shard, bytes of text read for one, and test suffixes that are searched at once.
SHARD_WORDS, SHARD_BYTES, AT_ONCE = 1 << 21, 8 << 20, 1 << 16

#: Largest set of test items, in bytes of its text.
MOST_BYTES = 1 << 30


@dataclass(frozen=True)
class ItemIndex:
    """The test items: the name of the shipped file of word hashes, where each item starts in it, and its id."""

    name: str
    starts: tuple[int, ...]  # one more than items
    ids: tuple
    width: int
    longest: int  # words of the longest item


def index_items(items: DataFrame, width: int = WIDTH, id_column: str = "item_id", text_column: str = "text") -> ItemIndex:
    """Ship the word hashes of all items to the executors.

    Rows of one id are items of their own that count under one name. Items without words or text have no window. The items
    are a stated query set whose size is checked against ``MOST_BYTES``.
    """
    rows = items.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MOST_BYTES:
        raise ValueError(f"the test items have {size} bytes of text, more than {MOST_BYTES}")
    found = rows.orderBy("id", "text").toArrow()
    words = Words(found.column("text"), lower=True, apart=NO_TERM)
    keep = np.flatnonzero(words.counts)
    ids = [found.column("id")[int(i)].as_py() for i in keep]
    starts = np.append(words.first[keep], len(words.hashes))
    name = "items-" + hashlib.sha256(words.hashes.tobytes() + repr((starts.tolist(), ids)).encode()).hexdigest()[:24] + ".npy"
    serve(items.sparkSession, name, words.hashes)
    return ItemIndex(name, tuple(starts.tolist()), tuple(ids), width, int(words.counts.max(initial=0)))


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes of ``words`` (numbers from 0), in order of their first ``depth`` words.

    The first words of a suffix are packed into one number and sorted; then suffixes that still tie are sorted by the
    ranks of what follows, so that each round at most doubles the ordered length and only touches ties.
    """
    n = len(words)
    bits = max(1, int(words.max(initial=0) + 1).bit_length())
    done = max(1, min(63 // bits, depth))
    padded = np.concatenate([words.astype(np.int64) + 1, np.zeros(done, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(done):
        key = (key << bits) | padded[j : j + n]
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    rank = np.zeros(n + depth + 1, np.int64)  # behind the end: before all
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1
    while done < depth:
        alone = new & np.append(new[1:], True)
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        step = min(done, depth - done)  # overlaps what is ordered, so that the depth is met exactly
        places = order[tied]
        key = rank[places] * (n + 2) + rank[places + step]
        sort = np.argsort(key)
        order[tied], key = places[sort], key[sort]
        first = np.ones(len(tied), bool)
        first[1:] = key[1:] != key[:-1]
        new[tied] = first
        rank[order[tied]] = np.maximum.accumulate(np.where(first, tied, 0)) + 1
        done += step
    return order


class Shard:
    """The suffix array of a word sequence, and the searches in it."""

    def __init__(self, hashes: np.ndarray, ends: np.ndarray, depth: int):
        """``ends``: after which words a text ends; no match crosses such a place."""
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        numbers = numbers + 1  # 0 stands behind each text
        self.words = np.insert(numbers, ends, 0)
        self.places = np.delete(np.arange(len(self.words)), ends + np.arange(len(ends)))  # of each word
        self.word_at = np.zeros(len(self.words), np.int64)
        self.word_at[self.places] = np.arange(len(hashes))
        self.order = suffix_array(self.words, depth)
        self.words = np.append(self.words * 2, np.zeros(depth, np.int64))  # odd numbers: words that the shard lacks

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.vocabulary, hashes)
        known = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == hashes
        return np.where(known, 2 * at + 2, 2 * at + 1)

    def compare(self, places: np.ndarray, items: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words each suffix has in common with its pattern, and whether it comes before it."""
        common, before = np.zeros(len(places), np.int64), np.zeros(len(places), bool)
        live = np.flatnonzero(lengths > 0)
        step = 0
        while len(live):
            a, b = self.words[places[live] + step], items[starts[live] + step]
            before[live[a < b]] = True
            live = live[a == b]
            step += 1
            common[live] = step
            live = live[lengths[live] > step]
        return common, before

    def search(self, items: np.ndarray, starts: np.ndarray, lengths: np.ndarray, behind: bool = False) -> np.ndarray:
        """For each pattern, the number of suffixes that come before it (``behind``: or begin with it)."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.order))
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            common, before = self.compare(self.order[middle], items, starts[open_], lengths[open_])
            right = before | (common == lengths[open_]) if behind else before
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
        return low

    def longest(self, items: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pattern, how many of its first words stand together in the shard at most, and the first word there."""
        at = self.search(items, starts, lengths)
        best, where = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        for near in (at - 1, at):  # a binary search ends between the two best
            inside = np.flatnonzero((near >= 0) & (near < len(self.order)))
            places = self.order[near[inside]]
            common, _ = self.compare(places, items, starts[inside], lengths[inside])
            better = common > best[inside]
            best[inside[better]], where[inside[better]] = common[better], self.word_at[places[better]]
        return best, where


def _suffixes(index: ItemIndex) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of all test suffixes: item (by place), first word, words to the item's end."""
    bounds = np.array(index.starts)
    for at in range(0, int(bounds[-1]), AT_ONCE):
        start = np.arange(at, min(at + AT_ONCE, int(bounds[-1])))
        item = np.searchsorted(bounds, start, "right") - 1
        yield item, start, bounds[item + 1] - start


def _shards(words: Words, index: ItemIndex) -> Iterator[tuple[int, Shard]]:
    """Shards of at most about ``SHARD_WORDS`` words, with the number of the first word. A longer text goes on in the next
    shard, with an overlap that holds any match."""
    n = len(words.hashes)
    for at in range(0, n, SHARD_WORDS):
        to = min(n, at + SHARD_WORDS + index.longest - 1)
        ends = words.first[1:]
        ends = np.unique(ends[(ends > at) & (ends <= to)]) - at
        yield at, Shard(words.hashes[at:to], ends, index.longest)


def find_leaks(docs: DataFrame, index: ItemIndex, id_column: str = "doc_id", text_column: str = "text", *, carry: str | None = None) -> DataFrame:
    """``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated`` of every document.

    A window is ``index.width`` consecutive words of an item; an item with fewer, but not none, is one window. A word is hit
    if it lies in a place where the words of a window stand; ``n_items`` counts the ids of items with such windows, and the
    digest is of these ids, sorted as text and joined by commas. Null and empty texts have no words. Repeated rows and null
    ids stay rows of their own. Other columns are ignored, or handed through as one value ``carry``. Narrow: no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = np.load(SparkFiles.get(index.name), mmap_mode="r") if index.ids else np.zeros(0, np.uint64)
        names = [str(i) for i in index.ids]
        size = np.diff(np.array(index.starts)) if index.ids else np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                words = Words(part.column(1), lower=True, apart=NO_TERM)
                edge = np.zeros(len(words.hashes) + 1, np.int64)
                held = _Pairs(len(names))
                for at, shard in _shards(words, index) if index.ids else ():
                    for low, high, item, width in _windows(shard, index, items, size):
                        word = at + shard.word_at[shard.order[low:high]]
                        np.add.at(edge, word, 1)
                        np.add.at(edge, word + width, -1)
                        held.add(np.unique(words.row[word]), item)
                hit = np.append(0, np.cumsum(np.cumsum(edge[:-1]) > 0))
                n_hit = hit[words.first[1:]] - hit[words.first[:-1]]
                row, item = held.all()
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
                of = [sorted({names[i] for i in item[a:b].tolist()}) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in of]
                columns = [pa.array(words.counts, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(map(len, of), pa.int64()), pa.array(digests), pa.array(n_hit > 0)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[carry or id_column, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    kept = carry or id_column
    rows = docs.select(F.col(f"`{kept}`").alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, carrying(docs, kept, kept, "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"))


class _Pairs:
    """Different pairs of document and item."""

    def __init__(self, items: int):
        self.items, self.parts, self.size, self.room = items, [np.zeros(0, np.int64)], 0, 1 << 20

    def add(self, rows: np.ndarray, items: np.ndarray) -> None:
        self.parts.append((rows[:, None] * self.items + items).ravel())
        self.size += len(self.parts[-1])
        if self.size > self.room:
            self.parts = [np.unique(np.concatenate(self.parts))]
            self.size = len(self.parts[0])
            self.room = max(self.room, 2 * self.size)

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        return np.divmod(np.unique(np.concatenate(self.parts)), max(1, self.items))


def _windows(shard: Shard, index: ItemIndex, items: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, int]]:
    """Each different window that the shard holds: its suffixes in the array's order, the items that have it, its width."""
    for item, start, left in _suffixes(index):
        width = np.minimum(index.width, size[item])
        window = left >= width
        numbers = shard.numbers(np.asarray(items[start[0] : start[-1] + index.longest]))
        longest, _ = shard.longest(numbers, start - start[0], left)
        found = np.flatnonzero(window & (longest >= width))
        if not len(found):
            continue
        first = start[found] - start[0]
        low, high = shard.search(numbers, first, width[found]), shard.search(numbers, first, width[found], behind=True)
        key, place = np.unique(np.stack([low, high, width[found]]), axis=1, return_inverse=True)
        place = place.ravel()
        sort = np.argsort(place, kind="stable")
        groups = np.split(item[found][sort], np.cumsum(np.bincount(place))[:-1])
        for (a, b, w), own in zip(key.T.tolist(), groups, strict=True):
            yield a, b, np.unique(own), w


def longest_matches(docs: DataFrame, index: ItemIndex, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For every test suffix with any word in the documents, its longest verbatim match: ``item_id``, ``item_word`` (where the
    suffix starts), ``n_words``, and a place where it stands, ``doc_id`` and ``doc_word``.

    Of equally long ones the smallest id and place are given, null ids first. Items that share an id are told apart by
    ``item_row``. Each shard sends one row per suffix, reduced on the way. Null and empty texts match nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = np.load(SparkFiles.get(index.name), mmap_mode="r") if index.ids else np.zeros(0, np.uint64)
        bounds = np.array(index.starts)
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                words = Words(part.column(1), lower=True, apart=NO_TERM)
                for at, shard in _shards(words, index) if index.ids else ():
                    for item, start, left in _suffixes(index):
                        numbers = shard.numbers(np.asarray(items[start[0] : start[-1] + index.longest]))
                        n, _ = shard.longest(numbers, start - start[0], left)
                        first = start - start[0]
                        low, high = shard.search(numbers, first, n), shard.search(numbers, first, n, behind=True)
                        for q in np.flatnonzero(n).tolist():
                            word = at + shard.word_at[shard.order[low[q] : high[q]]]
                            row = words.row[word]
                            ids = pa.array(np.unique(row))
                            own = part.column(0).take(ids)
                            best = _least(own)
                            places = word[row == ids[best].as_py()] - words.first[ids[best].as_py()]
                            columns = [[int(item[q])], [int(start[q] - bounds[item[q]])], [int(n[q])]]
                            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), own.slice(best, 1), pa.array([int(places.min())], pa.int64())], names=["item_row", "item_word", "n_words", "doc_id", "doc_word"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = rows.mapInArrow(run, f"item_row long, item_word long, n_words long, doc_id {kind}, doc_word long")
    place = F.struct((-F.col("n_words")).alias("n"), F.col("doc_id"), F.col("doc_word"))
    best = found.groupBy("item_row", "item_word").agg(F.min(place).alias("best"))
    if not index.ids:
        return best.select(F.lit(None).cast("long").alias("item_id"), "item_row", "item_word", (-F.col("best.n")).alias("n_words"), "best.doc_id", "best.doc_word")
    names = docs.sparkSession.createDataFrame([(r, i) for r, i in enumerate(index.ids)], ["item_row", "item_id"])
    return best.join(F.broadcast(names), "item_row").select("item_id", "item_row", "item_word", (-F.col("best.n")).alias("n_words"), "best.doc_id", "best.doc_word")


def _least(ids: pa.Array) -> int:
    """Where the smallest id stands, a null before all."""
    if ids.null_count:
        return ids.is_null().index(pa.scalar(True)).as_py()
    return int(pa.compute.sort_indices(ids)[0].as_py())


def remove_contaminated(docs: DataFrame, index: ItemIndex) -> DataFrame:
    """The documents without a word that is hit, with all their columns. Null and empty texts stay."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    return find_leaks(rows, index, carry="row").where(~F.col("contaminated")).select("row.*")
