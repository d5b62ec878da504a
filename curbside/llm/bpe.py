"""Byte-pair encoding by dynamic programming over prefixes.

For every prefix of a word there is exactly one token that can end its encoding. An automaton over the vocabulary yields
the tokens that end at each position; the one whose start is reached by a compatible token is stored for that prefix, and
back-pointers from the whole word give the ids. Two tokens are compatible when the merge rules leave their concatenation as
just these two. The result is exact for any merge table, in time linear in the word, however long it is.

Reads the public ``tokenizers`` JSON format with NFC, white space and lower-case normalisers, a split pattern, byte-level
symbols and a word-end suffix. The vocabulary comes in as text, so that executors need no path of the driver.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from curbside.llm.storage import kept_by_workers
from curbside.llm.words import slices

#: Entries of each generation of the caches of words, of their parts and of pairs of tokens: they bound a worker's memory
#: and never change a result.
CACHE_WORDS, CACHE_PARTS, CACHE_PAIRS = 250_000, 60_000, 400_000

#: End of the Latin, Greek and Cyrillic blocks.
COMMON_END = "\u0530"

#: Code points are shifted by this to mark the last symbol of a word.
FINAL = 0x20000


#: In place of a rule, for single symbols.
NEVER = (-1, "", "")

#: Before the first token, which any token may follow.
START = (0, "", {}, -1)


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Cache(dict):
    """Results of ``make`` for the keys met most recently: two generations, of which the older one goes."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key: str | bytes) -> object:
        if (value := self.older.get(key)) is None:
            value = self.make(key)
            if len(key) > 64:
                return value
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class PrefixEncoder:
    """Encodes single pre-tokens into ids."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        import ahocorasick

        self.symbols = byte_symbols()
        self.suffix = suffix
        self.ids = {self._inner(token): i for token, i in vocabulary.items()}
        self.ranks: dict[tuple[str, str], int] = {}
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[self._inner(a), self._inner(b)] = rank
        #: The rule that makes each token, and its parts. Trained tables list a token's parts before it.
        self.made = {a + b: (rank, a, b) for (a, b), rank in reversed(self.ranks.items())}
        self.in_order = all(max(self.made.get(x, NEVER)[0], self.made.get(y, NEVER)[0]) < rank for rank, x, y in self.made.values())
        self.in_order &= len(self.made) == len(self.ranks)
        self.known = 0
        self.matches = ahocorasick.Automaton()
        for token in self.ids:
            if len(token) == 1 or len(self.merge(token)) == 1:  # others never stand in an encoding
                self.matches.add_word(token, (len(token), token, {"": True}, self.ids[token]))
        self.matches.make_automaton()

    def _inner(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + FINAL)
        return token

    def merge(self, text: str) -> list[str]:
        """The merge rules applied literally; used only on one token or a pair of tokens."""
        parts = list(text)
        while len(parts) > 1:
            best = min(zip(parts, parts[1:], strict=False), key=lambda p: self.ranks.get(p, 1 << 60))
            if best not in self.ranks:
                break
            joined, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    joined.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    joined.append(parts[i])
                    i += 1
            parts = joined
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Whether the rules leave ``a`` and ``b`` beside each other as they are.

        Walks back in time from the two tokens: of the two that meet at the border, the one that was made later is
        taken apart. No rule for the two may come before the one that was just undone.
        """
        if not self.in_order:
            return self.merge(a + b) == [a, b]
        made, ranks, limit = self.made, self.ranks, 1 << 60
        while True:
            if ranks.get((a, b), limit) < limit:
                return False
            rank_a, left, right = made.get(a, NEVER)
            rank_b, first, _ = made.get(b, NEVER)
            if rank_a > rank_b:
                limit, a = rank_a, right
            elif rank_b >= 0:
                limit, b = rank_b + 1, first  # of equal rules the left one goes first
            else:
                return True

    def __call__(self, text: str) -> bytes:
        """Ids of one pre-token, given as byte symbols, as packed 32-bit numbers."""
        if self.suffix:
            text = text[:-1] + chr(ord(text[-1]) + FINAL)
        last: list[tuple | None] = [None] * len(text)
        last.append(START)  # also found at -1, before the first symbol
        for end, match in self.matches.iter(text):
            if last[end] is None and (before := last[end - match[0]]) is not None:
                if (fit := match[2].get(before[1])) is None:
                    fit = self._remember(match[2], before[1], match[1])
                if fit:
                    last[end] = match
        out, at = [], len(text) - 1
        while at >= 0:
            match = last[at]
            out.append(match[3])
            at -= match[0]
        out.reverse()
        return array("I", out).tobytes()

    def _remember(self, fits: dict[str, bool], before: str, token: str) -> bool:
        """What was found out about pairs is kept with their second token, up to a bound."""
        self.known += 1
        if self.known > CACHE_PAIRS:
            self.known = 0
            for _, _, other, _ in self.matches.values():
                other.clear()
                other[""] = True
        fit = fits[before] = self.compatible(before, token)
        return fit


class Codec:
    """Encodes whole texts, by their white-space separated words."""

    def __init__(self, definition: str):
        import regex
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or spec["decoder"] or spec["post_processor"]:
            raise ValueError("this form of tokenizer file is not supported")
        model = spec["model"]
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.letters = "[\\p{L}]+|" in split["pattern"]["Regex"]  # a word of letters is one part
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.uncommon = re.compile(f"[{COMMON_END}-\U0010ffff]").search
        self.mark = os.path.commonprefix(list(self.special))  # quick to look for; empty is in every text
        self.encoder = PrefixEncoder(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.symbols = {b: c for b, c in byte_symbols().items() if chr(b) != c}
        self.tokens = {i: t for t, i in (model["vocab"] | self.special).items()}
        self.parts = Cache(self.encoder, CACHE_PARTS)
        rules = Tokenizer.from_str(definition)
        self.normalizer, self.splitter = rules.normalizer, rules.pre_tokenizer

    def word(self, raw: bytes) -> bytes:
        """Packed ids of a stretch of text without ASCII white space. No rule of the normaliser or the pattern crosses
        white space, so a text's ids are those of its words in order."""
        text = raw.decode("utf-8")
        if self.special and self.mark in text:
            pieces = [p for p in self.cut.split(text) if p]
            return b"".join([array("I", [self.special[p]]).tobytes() if p in self.special else self._plain(p) for p in pieces])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        parts = self._split(text)
        return self.encoder(parts[0]) if len(parts) == 1 else b"".join(map(self.parts.__getitem__, parts))

    def _split(self, text: str) -> list[str]:
        """Pre-tokens in byte symbols. The classes of characters in the main alphabets are the same in every Unicode
        version; beyond them the file's own library decides."""
        if text.isascii() and text.isprintable():  # these stand for themselves
            return [text.lower()] if self.letters and text.isalpha() else self.pattern.findall(text.lower())
        if self.uncommon(text):
            return [part for part, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))]
        text = unicodedata.normalize("NFC", text)
        text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        parts = [text] if self.letters and text.isalpha() else self.pattern.findall(text)
        return [part.encode("utf-8").decode("latin-1").translate(self.symbols) for part in parts]

    def encode(self, text: str) -> list[int]:
        return array("I", b"".join(map(self.word, text.encode("utf-8").split()))).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """Without a decoder in the file, tokens are joined by one space."""
        return " ".join(self.tokens[i] for i in ids)


@kept_by_workers
@lru_cache(maxsize=2)
def codec(definition: str) -> Codec:
    """One codec per worker and vocabulary, kept between tasks."""
    return Codec(definition)


class WordIds(Cache):
    """Packed ids of white-space separated words, kept between tasks."""

    def __init__(self, tool: Codec):
        super().__init__(self.ids, CACHE_WORDS)
        self.tool = tool
        self.tails = {c: tool.word(c) for c in (b".", b",")}

    def ids(self, raw: bytes) -> bytes:
        """A full stop or comma after a letter or digit is a part of its own, so that the word before may be known."""
        if self.tool.letters and raw.isalpha():  # ASCII letters alone are one part
            return self.tool.encoder(raw.lower().decode())
        if (tail := self.tails.get(raw[-1:])) is not None and raw[-2:-1].isalnum():
            return self[raw[:-1]] + tail
        return self.tool.word(raw)

    def words(self, text: bytes) -> list[bytes]:
        """The words of a text; in lower case, which they become anyway, unless it may hold special tokens."""
        if self.tool.special and self.tool.mark.encode() in text:
            return text.split()
        return text.lower().split()


@kept_by_workers
@lru_cache(maxsize=2)
def word_ids(definition: str) -> WordIds:
    return WordIds(codec(definition))


@kept_by_workers
@lru_cache(maxsize=2)
def word_streams(definition: str) -> Cache:
    """Per word the number of ids, and its stretch of the texts that list ids and tokens."""
    tool = codec(definition)

    def view(raw: bytes) -> tuple[int, bytes, bytes]:
        ids = array("I", word_ids(definition).ids(raw))
        return len(ids), " ".join(map(str, ids)).encode(), tool.decode(ids).encode()

    return Cache(view, CACHE_WORDS // 2)


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_texts(docs: DataFrame, definition: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Whole texts to ``n_tokens``, ``ids`` (array of int) and ``decoded``; a null text counts as empty.

    One row per input row, in one narrow pass; repeated rows and null ids stay. Other columns are ignored.
    """
    spec = docs.sparkSession.sparkContext.broadcast(definition)  # a vocabulary file: a few MB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(spec.value)
        for batch in batches:
            for part in slices(batch, text_column, 1 << 20):
                ids = [tool.encode(raw.as_py() or "") for raw in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(map(tool.decode, ids), pa.string())],
                    names=[id_column, "n_tokens", "ids", "decoded"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, ids array<int>, decoded string")


def token_digests(docs: DataFrame, definition: str) -> DataFrame:
    """Per document the number of tokens, and digests of the ids and of the decoded text.

    The ids and tokens of each word are kept ready as bytes, so that a document's streams are joined, hashed and
    dropped one at a time; memory holds one text, its two streams and the word cache.
    """
    spec = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, words = word_streams(spec.value), word_ids(spec.value).words
        look = cache.__getitem__
        for batch in batches:
            rows: tuple[list, list, list] = ([], [], [])
            for raw in batch.column(1).cast(pa.large_binary()):
                found = [x for x in map(look, words(raw.as_py() or b"")) if x[0]]
                rows[0].append(sum(x[0] for x in found))
                rows[1].append(hashlib.sha256(b" ".join([x[1] for x in found])).hexdigest())
                rows[2].append(hashlib.sha256(b" ".join([x[2] for x in found])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
