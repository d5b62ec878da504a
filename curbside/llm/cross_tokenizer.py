"""Alignment of the tokens of two tokenizers over the same bytes.

Byte offsets at which tokens of both end cut them into groups; tokens whose byte ranges overlap are linked. Both tokenizers
end a token before a space that follows no white space, so that a text is a sequence of chunks, each a space and what follows up
to the next such space, that can be encoded and aligned one by one; the alignment of a chunk is made once for all its
repeats, in numpy for many chunks at a time. (This is checked when the tokenizers are loaded, as far as it rests on the
vocabulary.)

An array made once gives to every id of A the id of B with the same bytes. Links of such pairs, nearly all of them in groups
of one token each, are counted in one vector as long as the vocabulary; only the other pairs are counted by a shuffle. Their
counts come back in two ways: those of the most frequent pairs as a sorted array of bounded size, all others by a join, in
which no key can be hot, as its number of rows is the count that kept it out of the array.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from curbside.llm.storage import carrying, kept_by_workers, release_unused, stage
from curbside.llm.words import slices

#: Most pairs whose counts are broadcast, 16 bytes each.
MOST_PAIRS = 1 << 20

#: Chunks and links kept ready by a worker; pairs counted before they are handed on.
CHUNKS, LINKS, PENDING = 200_000, 1 << 23, 1 << 21

#: Chunks encoded and aligned at once: what the tokenizers return holds a hundred times the bytes of a chunk.
ENCODED = 4096

#: Bits of a pair's code; a row's number stands above them.
CODE_BITS = 40

#: Text aligned at once, in bytes.
BLOCK_BYTES = 1 << 19

#: Where a chunk begins: at a space behind anything but white space.
CUT = re.compile(r"(?<=\S)(?= )")

SPACE = "▁"


@dataclass(frozen=True)
class Definitions:
    """The two vocabulary files: A as the text of a byte-level BPE definition, B as a piece model."""

    a: str
    b: bytes

    @staticmethod
    def read(path_a: str, path_b: str) -> Definitions:
        with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
            return Definitions(a.read(), b.read())


def byte_level() -> dict[str, int]:
    """The byte of each character of a byte-level entry: printable bytes stand for themselves, the others, in order, for
    the characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Aligned:
    """Aligned chunks, numbered: token and group counts, the groups as text, and the codes of the links in order."""

    def __init__(self, ok: np.ndarray, counts: np.ndarray, groups: list[str], codes: np.ndarray, edges: np.ndarray):
        self.ok, self.counts, self.groups, self.codes, self.edges = ok, counts, groups, codes, edges


class Aligner:
    """Both tokenizers, the bytes of their tokens, and ``same``: for every id of A the id of B with its bytes, or -1."""

    def __init__(self, definitions: Definitions):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(definitions.a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=definitions.b)
        byte = byte_level()
        entries = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        self.bytes_a = [entries.get(i, b"") for i in range(max(entries) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece crosses the beginning of a word: chunks cannot be encoded one by one")
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        by_bytes = {x: i for i, x in reversed(list(enumerate(self.bytes_b))) if self.b.is_byte(i)}
        by_bytes |= {x: i for i, x in reversed(list(enumerate(self.bytes_b))) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        self.size_a, self.size_b = len(self.bytes_a), len(self.bytes_b)
        if self.size_a * self.size_b > 1 << CODE_BITS:
            raise ValueError("the vocabularies are too large for the codes of pairs")
        self.code_type = np.uint32 if self.size_a * self.size_b <= 1 << 32 else np.uint64
        self.same = np.array([by_bytes.get(x, -1) for x in self.bytes_a], np.int64)
        self.length_a, self.length_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        most = max(self.size_a, self.size_b)
        self.text = [f"{i}{mark}" for mark in ",|;" for i in range(most)]
        self.most = most
        self.lead = len(self.b.encode("a"))  # pieces of a letter in front, which keeps the model from adding a space

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both. Each chunk begins with a space, which B gets behind a letter."""
        a = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        b = [ids[self.lead :] for ids in self.b.encode([f"a{c}" for c in chunks], num_threads=1)]
        return a, b

    def align(self, chunks: list[str]) -> Aligned:
        """Align each chunk. Where the bytes of A's or B's tokens are not the chunk's, it is not ``ok`` and has no tokens."""
        ids_a, ids_b = self.encode(chunks)
        ok = np.zeros(len(chunks), bool)
        for k, (chunk, x, y) in enumerate(zip(chunks, ids_a, ids_b, strict=True)):
            raw = chunk.encode()
            ok[k] = b"".join([self.bytes_a[i] for i in x]) == raw and b"".join([self.bytes_b[i] for i in y]) == raw
            if not ok[k]:
                ids_a[k], ids_b[k] = [], []
        n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (ids_a, ids_b))
        a, b = (np.fromiter((i for ids in x for i in ids), np.int64, int(n.sum())) for x, n in ((ids_a, n_a), (ids_b, n_b)))
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        total = int(end_a[-1]) if len(end_a) else 0
        is_a, is_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        is_a[end_a], is_b[end_b] = True, True
        ends = np.flatnonzero(is_a | is_b)  # each the end of one link: of the tokens that both hold the byte before
        is_a, is_b = is_a[ends], is_b[ends]
        both = is_a & is_b
        at_a, at_b = np.cumsum(is_a) - is_a, np.cumsum(is_b) - is_b
        codes = a[at_a] * self.size_b + b[at_b]
        edges = np.searchsorted(ends, np.append(0, end_a)[np.cumsum(np.append(0, n_a))], "right")
        group = np.cumsum(both) - both
        n_groups = np.diff(np.append(0, np.cumsum(both))[edges])
        group_a, group_b = group[is_a], group[is_b]
        many = int(both.sum())
        before_b = np.append(0, np.cumsum(np.bincount(group_b, minlength=many)))[group_a]
        upto_a = np.cumsum(np.bincount(group_a, minlength=many))[group_b] if many else group_b
        written = np.empty(len(a) + len(b), np.int64)
        written[np.arange(len(a)) + before_b] = a + self.most * both[is_a]
        written[np.arange(len(b)) + upto_a] = b + 2 * self.most * both[is_b]
        parts, cut = [self.text[c] for c in written.tolist()], np.cumsum(np.append(0, n_a + n_b)).tolist()
        groups = ["".join(parts[x:y])[:-1] for x, y in zip(cut[:-1], cut[1:], strict=True)]
        return Aligned(ok, np.stack([n_a, n_b, n_groups, np.diff(edges)], axis=1), groups, codes, edges)


class Chunks:
    """The alignments of the chunks met so far; beyond ``CHUNKS`` of them, or ``LINKS`` links, it starts anew."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.number: dict[str, int] = {}
        self.known = aligner.align([])

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, Aligned]:
        """Numbers of the chunks of all texts in order, how many each text has, and the alignments by number."""
        if len(self.number) > CHUNKS or len(self.known.codes) > LINKS:
            self.__init__(self.aligner)
        number, known, fresh, ids, counts = self.number, self.known, [], [], []
        for text in texts:
            chunks = CUT.split(f" {text}") if text else []
            counts.append(len(chunks))
            for c in chunks:
                if (i := number.get(c)) is None:
                    i = number[c] = len(known.groups) + len(fresh)
                    fresh.append(c)
                ids.append(i)
        if fresh:
            every = [known, *(self.aligner.align(fresh[at : at + ENCODED]) for at in range(0, len(fresh), ENCODED))]
            before = np.cumsum([0, *(len(x.codes) for x in every)])
            edges = [known.edges[:1], *(x.edges[1:] + n for x, n in zip(every, before[:-1], strict=True))]
            ok, rows, codes = (np.concatenate([getattr(x, name) for x in every]) for name in ("ok", "counts", "codes"))
            self.known = Aligned(ok, rows, [g for x in every for g in x.groups], codes, np.concatenate(edges))
        return np.array(ids, np.int64), np.array(counts, np.int64), self.known


@kept_by_workers
@lru_cache(maxsize=1)
def chunks_of(definitions: Definitions) -> Chunks:
    """The tokenizers of a worker and the chunks it has met, kept between tasks."""
    return Chunks(Aligner(definitions))


class Pending:
    """How many of the documents so far hold each pair: a vector for pairs of the same bytes, a list for all others."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.same = np.zeros(aligner.size_a, np.int64)
        self.codes, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new: list[np.ndarray] = []
        self.size = 0

    def add(self, codes: np.ndarray) -> None:
        """Pairs of documents, each pair once for each document that holds it."""
        a, b = np.divmod(codes, self.aligner.size_b)
        same = self.aligner.same[a] == b
        self.same += np.bincount(a[same], minlength=len(self.same))
        self.new.append(codes[~same])
        self.size += len(self.new[-1])

    def full(self) -> bool:
        """Whether it is time to hand the counts on, even when equal pairs are added up."""
        if self.size > PENDING:
            self._merge()
        return len(self.codes) > PENDING // 2

    def _merge(self) -> None:
        new = np.concatenate([np.zeros(0, np.int64), *self.new])
        self.new = []
        new.sort()
        first = np.flatnonzero(np.diff(new, prepend=-1))
        every, n = np.append(self.codes, new[first]), np.append(self.n, np.diff(first, append=len(new)))
        order = np.argsort(every, kind="stable")
        every, n = every[order], n[order]
        first = np.flatnonzero(np.diff(every, prepend=-1))
        self.codes, self.n = every[first], np.add.reduceat(n, first) if len(first) else n
        self.new, self.size = [], 0

    def out(self) -> dict[str, list | np.ndarray]:
        self._merge()
        some = np.flatnonzero(self.same)
        rows = {"kind": ["same"] * len(some) + ["pair"] * len(self.codes), "code": np.append(some, self.codes), "n": np.append(self.same[some], self.n)}
        self.__init__(self.aligner)
        return rows


def align_texts(docs: DataFrame, definitions: Definitions, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Alignments and counts of pairs, written once; ``kind`` tells the rows apart.

    ``document``: ``row`` (a number of its own), ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, and its different pairs
    of linked ids, ``codes`` (A's id times the size of B's vocabulary plus B's id, ascending) with their numbers of links,
    ``times``. ``same``: how many documents hold id ``code`` of A linked with the id of B of the same bytes. ``pair``: how
    many hold the pair ``code``, of the others. Counts are partial ones, of one task.

    Null and empty texts, and those that one of the tokenizers does not give back byte by byte, have no tokens.
    """
    spec = docs.sparkSession.sparkContext.broadcast(definitions)  # two vocabulary files: a few MB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunks_of(spec.value)
        pairs = Pending(chunks.aligner)
        for batch in batches:
            release_unused()
            for part in slices(batch, "text", BLOCK_BYTES):
                yield _batch(schema, _documents(part, chunks, pairs))
                if pairs.full():
                    yield _batch(schema, pairs.out())
        yield _batch(schema, pairs.out())

    rest = "kind string, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, times binary, code long, n long"
    fields = carrying(docs, id_column, "doc_id", rest)
    schema = to_arrow_schema(fields)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return stage(rows.mapInArrow(run, fields), "aligned")


def _batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """A batch with the given columns; the others are null."""
    size = len(columns["kind"])
    arrays = [pa.nulls(size, f.type) if (c := columns.get(f.name)) is None else c if isinstance(c, pa.Array) else pa.array(c, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _documents(part: pa.RecordBatch, chunks: Chunks, pairs: Pending) -> dict:
    texts, n = part.column(2).to_pylist(), part.num_rows
    ids, size, known = chunks.of(texts)
    row = np.repeat(np.arange(n), size)
    failed = np.bincount(row, ~known.ok[ids], n) > 0
    counts = np.zeros((n, 4), np.int64)
    np.add.at(counts, row, known.counts[ids])
    first = np.append(0, np.cumsum(size)).tolist()
    places, groups = ids.tolist(), known.groups
    written = [";".join([groups[i] for i in places[x:y]]) for x, y in zip(first[:-1], first[1:], strict=True)]
    good = ~failed[row]
    keys = [_keys(row[good], ids[good], known)]
    if failed.any():  # a text is judged as a whole
        again = np.flatnonzero(failed)
        whole = chunks.aligner.align([f" {texts[i]}" for i in again])
        counts[again] = whole.counts
        for k, i in enumerate(again.tolist()):
            written[i] = whole.groups[k]
        keys.append(_keys(again, np.arange(len(again)), whole))
    key, times = np.unique(np.concatenate(keys), return_counts=True)
    codes = key & ((1 << CODE_BITS) - 1)
    bounds = np.searchsorted(key >> CODE_BITS, np.arange(n + 1)).tolist()
    pairs.add(codes)
    codes, times = codes.astype(chunks.aligner.code_type), times.astype(np.uint32)
    cut = lambda x: pa.array([x[a:z].tobytes() for a, z in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
    digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
    out = {"kind": ["document"] * n, "row": part.column(0), "doc_id": part.column(1), "groups_sha256": digests, "codes": cut(codes), "times": cut(times)}
    return out | dict(zip(("n_a", "n_b", "n_groups", "n_links"), counts.T.copy(), strict=True))


def _keys(row: np.ndarray, ids: np.ndarray, known: Aligned) -> np.ndarray:
    """Row and code of every link of the rows' chunks."""
    low, n = known.edges[ids], known.edges[ids + 1] - known.edges[ids]
    where = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
    return (np.repeat(row, n) << CODE_BITS) | known.codes[where]


def link_counts(docs: DataFrame, definitions: Definitions, id_column: str = "doc_id", text_column: str = "text", most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every document.

    A pair of ids counts in how many documents it is linked. ``count_sum`` adds the counts of all links up, ``n_best`` counts
    the links whose pair has the highest count of its id of A, ties included. Documents without tokens (null or empty texts,
    and those that one tokenizer changes) have zeros and no digest. Repeated rows count one by one, and null ids stay;
    an empty table gives an empty one. Other columns are ignored.
    """
    aligner = Aligner(definitions)
    rows = align_texts(docs, definitions, id_column, text_column)
    size_b, code_type = aligner.size_b, aligner.code_type
    same, best = np.zeros(aligner.size_a, np.int64), np.zeros(aligner.size_a, np.int64)
    for r in rows.where("kind = 'same'").groupBy("code").agg(F.sum("n").alias("n")).collect():  # at most a row per id of A
        same[r.code] = r.n
    pairs = stage(rows.where("kind = 'pair'").groupBy("code").agg(F.sum("n").alias("n")), "pairs")
    for r in pairs.groupBy(F.expr(f"code div {size_b}").alias("a")).agg(F.max("n").alias("n")).collect():  # as many
        best[r.a] = r.n
    best = np.maximum(best, same)

    # The most frequent pairs: whole steps of their counts, from the top, as far as the array has room.
    step = F.floor(8 * F.log2("n")).alias("step")
    least, room = None, most_pairs
    steps = sorted(pairs.groupBy(step).agg(F.min("n").alias("least"), F.count("*").alias("pairs")).collect(), reverse=True)
    for r in steps:  # a few hundred, whatever the data
        if r.pairs > room:
            break
        least, room = r.least, room - r.pairs
    often = pairs.where(F.col("n") >= least if least is not None else F.lit(False)).toArrow()
    codes, n = (often[c].to_numpy() for c in ("code", "n"))
    order = np.argsort(codes)
    spec = docs.sparkSession.sparkContext.broadcast((aligner.same, same, best, codes[order], n[order]))  # bounded by most_pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, same, best, often, n = spec.value
        for batch in batches:
            code, edges = _numbers(batch.column("codes"), code_type)
            times, _ = _numbers(batch.column("times"), np.uint32)
            row = np.repeat(np.arange(batch.num_rows), np.diff(edges))
            a, b = np.divmod(code, size_b)
            at = np.minimum(np.searchsorted(often, code), max(0, len(often) - 1))
            known = often[at] == code if len(often) else np.zeros(len(code), bool)
            count = np.where(known, n[at], -1) if len(often) else np.full(len(code), -1)
            count = np.where(ids[a] == b, same[a], count)
            found = count >= 0
            total, top = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, row[found], (times * count)[found])
            np.add.at(top, row[found], (times * (count == best[a]))[found])
            rest = np.flatnonzero(~found)
            bounds = pa.array(np.searchsorted(row[rest], np.arange(batch.num_rows + 1)), pa.int32())
            left = pa.StructArray.from_arrays([pa.array(x[rest], pa.int64()) for x in (code, times, best[a])], ["code", "times", "best"])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(total), pa.array(top), pa.ListArray.from_arrays(bounds, left)], names=[*kept, "count_sum", "n_best", "rest"])

    kept = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    fields = carrying(docs, id_column, "doc_id", "row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, count_sum long, n_best long, rest array<struct<code:long,times:long,best:long>>")
    found = rows.where("kind = 'document'").select(*kept, "codes", "times").mapInArrow(run, fields)
    if steps and (least is None or least > steps[-1].least):  # pairs outside the array: each in few documents
        found = stage(found, "linked")
        rare = pairs if least is None else pairs.where(F.col("n") < least)
        sums = found.select("row", F.inline("rest")).join(rare.hint("shuffle_merge"), "code").groupBy("row")
        sums = sums.agg(F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("top"))
        found = found.join(sums, "row", "left").withColumns({"count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0)), "n_best": F.col("n_best") + F.coalesce("top", F.lit(0))})
    return found.select(F.col("doc_id").alias(id_column), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _numbers(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed ones, as 64-bit integers, and where each row's start."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind).astype(np.int64), (offsets - offsets[0]) // np.dtype(kind).itemsize
