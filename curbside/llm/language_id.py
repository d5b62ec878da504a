"""Language identification by string kernels.

Two texts are as similar as the number of byte n-grams (one to three bytes, each counted once) that both hold, over the
geometric mean of their own numbers: the blended spectrum presence kernel. Nystroem landmarks stand for the kernel's space;
one-versus-rest kernel ridge regression is solved on the driver for a bounded sample of labelled rows. Texts are scored in
batches by two matrix products: presence by landmarks gives kernel rows, kernel rows by weights give a value per language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside.llm.storage import carrying
from curbside.llm.words import buffers, slices

#: Codes of n-grams: one byte, then two, then three.
CODES = 256 + (1 << 16) + (1 << 24)

#: Letters count in lower case, everything else below 0x80 as a space.
FOLD = np.array([b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint32)

PIECE_BYTES = 1 << 20


def gram_codes(data: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of one text's bytes, with repeats."""
    one = FOLD[data]
    two = one[:-1] << 8 | one[1:]
    three = two[:-1] << 8 | one[2:]
    return np.concatenate([one, two + np.uint32(256), three + np.uint32(256 + (1 << 16))])


def distinct_codes(data: np.ndarray) -> np.ndarray:
    parts = [np.unique(gram_codes(data[at : at + PIECE_BYTES + 2])) for at in range(0, len(data), PIECE_BYTES)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)


@dataclass(frozen=True)
class LanguageModel:
    """Landmarks (their n-grams and norms), the weights per language, and the languages."""

    languages: tuple[str, ...]
    grams: np.ndarray  # codes of the landmarks' n-grams, ascending
    landmarks: np.ndarray  # presence of each of these in each landmark, scaled by the landmark's norm
    weights: np.ndarray


def fit(docs: DataFrame, allowed: Column, per_language: int = 150, landmarks_per_language: int = 24, ridge: float = 1e-3) -> LanguageModel:
    """Learn from at most ``per_language`` rows of every language with ``allowed``, those of the smallest hashes.

    Rows with a null or empty text or language teach nothing. Bounded by the number of languages, whatever the data. The
    rows' n-gram sets come to the driver, not their texts.
    """
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    usable = docs.where(allowed & F.col("lang").isNotNull() & (F.length("text") > 0) & F.col("doc_id").isNotNull())
    ids = [r.doc_id for r in usable.select("doc_id", "lang").withColumn("rank", rank).where(F.col("rank") <= per_language).collect()]

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = buffers(part.column(2))
                sets = [distinct_codes(data[a:b]).astype(np.int32) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sets, pa.list_(pa.int32()))], names=["doc_id", "lang", "codes"])

    sample = usable.where(F.col("doc_id").isin(ids)).select("doc_id", "lang", "text")
    rows = sample.mapInArrow(codes, "doc_id long, lang string, codes array<int>").orderBy("lang", F.xxhash64("doc_id"), "doc_id").collect()
    languages = tuple(sorted({r.lang for r in rows}))
    chosen, seen = [], dict.fromkeys(languages, 0)
    for r in rows:
        if seen[r.lang] < landmarks_per_language:
            seen[r.lang] += 1
            chosen.append(np.array(r.codes))
    if not rows:
        return LanguageModel((), np.zeros(0, np.int32), np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32))
    grams = np.unique(np.concatenate(chosen))
    landmarks = np.zeros((len(grams), len(chosen)), np.float32)
    for j, c in enumerate(chosen):
        landmarks[np.searchsorted(grams, c), j] = 1 / np.sqrt(len(c))

    kernel = np.empty((len(rows), len(chosen)))
    for i, r in enumerate(rows):
        c = np.array(r.codes)
        at = np.minimum(np.searchsorted(grams, c), len(grams) - 1)
        kernel[i] = landmarks[at[grams[at] == c]].sum(axis=0) / np.sqrt(len(c))
    own = np.array([landmarks[np.searchsorted(grams, c)].sum(axis=0) / np.sqrt(len(c)) for c in chosen])
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = kernel @ root
    truth = np.array([[1.0 if r.lang == name else -1.0 for name in languages] for r in rows])
    solved = np.linalg.solve(features.T @ features + ridge * len(rows) * np.eye(features.shape[1]), features.T @ truth)
    return LanguageModel(languages, grams, landmarks, (root @ solved).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text", batch_rows: int = 256) -> DataFrame:
    """``lang_pred`` and ``score`` (0 to 1, how clearly that language leads) of every whole text.

    ``und`` with score 0 for a null text, for one without any letter, and if no language was learned. Equal texts get
    equal rows; repeated rows and null ids stay; other columns are ignored. Narrow: no shuffle.
    """
    spec = docs.sparkSession.sparkContext.broadcast(model)  # bounded by landmarks times their n-grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel = spec.value
        absent = len(m.grams)
        place = np.full(CODES, absent, np.uint16 if absent < 65_535 else np.uint32)
        place[m.grams] = np.arange(absent)
        for batch in batches:
            for part in slices(batch, "text"):
                for at in range(0, part.num_rows, batch_rows):
                    yield _score(part.slice(at, batch_rows), m, place, absent, id_column)

    text = F.col(text_column)
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"), text.alias("text"))
    return rows.mapInArrow(run, carrying(docs, id_column, id_column, "lang_pred string, score double"))


def _score(part: pa.RecordBatch, m: LanguageModel, place: np.ndarray, absent: int, id_column: str) -> pa.RecordBatch:
    data, offsets = buffers(part.column(2))
    known = np.zeros((part.num_rows, absent + 1), np.float32)
    size = np.zeros(part.num_rows)
    for i, (low, high) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        other = []
        for start in range(low, high, PIECE_BYTES):
            codes = gram_codes(data[start : min(high, start + PIECE_BYTES + 2)])
            at = place[codes]
            known[i, at] = 1
            other.append(codes[at == absent])
        size[i] = known[i, :absent].sum() + (len(np.unique(np.concatenate(other))) if other else 0)
    letters = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
    if not m.languages:
        letters[:] = False
        names, score = [], np.zeros(part.num_rows)
    else:
        kernel = known[:, :absent] @ m.landmarks / np.sqrt(np.maximum(size, 1))[:, None]
        values = 4 * (kernel @ m.weights).astype(np.float64)
        best = values.argmax(axis=1)
        score = 1 / np.exp(values - values.max(axis=1, keepdims=True)).sum(axis=1)
        names = [m.languages[b] for b in best]
    lang = [names[i] if letters[i] else "und" for i in range(part.num_rows)]
    return pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(np.where(letters, score, 0.0))], names=[id_column, "lang_pred", "score"])
