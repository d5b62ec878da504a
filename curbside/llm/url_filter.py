"""URL rules in a sorted digest array.

Rules are pairs of host and path prefix. Their 64-bit xxhash keys lie in one sorted array, the rule strings beside it; both
are files that every executor fetches once and maps into memory, so that all tasks of a machine share one copy. A url is
judged by a few keys: each of its host's suffixes that could be a rule's host, with each prefix of its path that is as long
as some rule's path. The JVM computes keys for whole columns; numpy finds them by one binary search per batch; each hit is
confirmed by comparing the full strings, so that a collision can't decide.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Seed of Spark's ``xxhash64``.
SEED = 42

#: Largest rule list that is shipped to every machine, in bytes of its strings.
MOST_BYTES = 1 << 30

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class RuleIndex:
    """Names of the shipped files, and what lengths a rule's parts have."""

    name: str
    labels: tuple[int, ...]
    path_lengths: tuple[int, ...]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both are empty for null and where there is no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substr(url, F.instr(url, "://") + F.lit(3)), "?", 1))
    rest = F.substring_index(rest, "#", 1)
    slash = F.instr(rest, "/")
    host = F.when(slash > 0, F.substr(rest, F.lit(1), slash - 1)).otherwise(rest)
    path = F.when(slash > 0, F.substr(rest, slash)).otherwise("")
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def build_index(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> RuleIndex:
    """Write the sorted digest array of (verdict, ``host/path``) rules and ship it to the executors.

    Repeated rules count once; of two verdicts for one rule, ``block`` holds. A rule list is far smaller than the data and
    checked against ``MOST_BYTES``.
    """
    verdicts: dict[str, str] = {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block") or "/" not in rule:
            raise ValueError(f"not a rule: {verdict} {rule}")
        verdicts[rule] = max(verdict, verdicts.get(rule, verdict))
    if sum(len(r) for r in verdicts) > MOST_BYTES:
        raise ValueError(f"the rules are larger than {MOST_BYTES} bytes")
    keyed = sorted((xxhash.xxh64_intdigest(r.encode(), seed=SEED), r, v == "block") for r, v in verdicts.items())
    texts = [r.encode() for _, r, _ in keyed]
    arrays = {
        "keys": np.array([k for k, _, _ in keyed], np.uint64),
        "ends": np.cumsum([0, *map(len, texts)]),
        "blocks": np.array([b for _, _, b in keyed], bool),
        "texts": np.frombuffer(b"".join(texts) or b"\0", np.uint8),
    }
    name = "rules-" + hashlib.sha256(b"".join(a.tobytes() for a in arrays.values())).hexdigest()[:24]
    with tempfile.TemporaryDirectory() as folder:  # Spark copies the files from here to the driver's file server
        for part, values in arrays.items():
            path = os.path.join(folder, f"{name}.{part}.npy")
            np.save(path, values)
            if f"{name}.{part}.npy" not in {os.path.basename(f) for f in spark.sparkContext.listFiles}:
                kept = os.path.join(_served(), f"{name}.{part}.npy")
                os.replace(path, kept)
                spark.sparkContext.addFile(kept)
    hosts = [r.partition("/")[0] for r in verdicts]
    lengths = {len(r) - len(h) for r, h in zip(verdicts, hosts, strict=True)}
    return RuleIndex(name, tuple(sorted({h.count(".") + 1 for h in hosts})), tuple(sorted(lengths)))


_folder: list[tempfile.TemporaryDirectory] = []


def _served() -> str:
    """A folder of the driver from which Spark serves the files while the session lasts."""
    if not _folder:
        _folder.append(tempfile.TemporaryDirectory())
    return _folder[0].name


def judge_urls(pages: DataFrame, index: RuleIndex, url_column: str = "url", id_column: str = "page_id", default: str = "allow") -> DataFrame:
    """``host``, ``path``, ``rule`` and ``verdict`` of every url; the longest rule that fits wins.

    A rule fits its host and all subdomains when the path starts with the rule's. Null and empty urls, and those without
    ``://``, fit none and get ``default`` with a null rule; so does everything under an empty list. One row per input row;
    repeated rows and null ids stay; other columns are ignored. Narrow: no shuffle.
    """
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("u"))
    host, path = url_parts(F.col("u"))
    rows = rows.select("id", host.alias("host"), path.alias("path"))
    hosts = F.array(*(F.substring_index("host", ".", -n) for n in index.labels)) if index.labels else F.expr("array(cast(null as string))")
    prefixes = F.array(*(F.when(F.length("path") >= n, F.left("path", F.lit(n))) for n in index.path_lengths)) if index.path_lengths else F.expr("array(cast(null as string))")
    names = F.array_distinct(F.flatten(F.transform(F.array_compact(prefixes), lambda p: F.transform(hosts, lambda h: F.concat(h, p)))))
    rows = rows.withColumn("names", F.array_compact(names))
    rows = rows.withColumn("keys", F.transform("names", lambda n: F.xxhash64(n)))
    name = index.name

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = lambda part: np.load(SparkFiles.get(f"{name}.{part}.npy"), mmap_mode="r")
        keys, ends, blocks, texts = (load(part) for part in ("keys", "ends", "blocks", "texts"))
        for batch in batches:
            found = confirm(batch.column(3), batch.column(4), keys, ends, texts)
            rule = [None if i < 0 else texts[ends[i] : ends[i + 1]].tobytes().decode() for i in found]
            verdict = [default if i < 0 else "block" if blocks[i] else "allow" for i in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=[id_column, "host", "path", "rule", "verdict"])

    kind = pages.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(probe, f"`{id_column}` {kind}, host string, path string, rule string, verdict string")


def confirm(names: pa.ListArray, hashed: pa.ListArray, keys: np.ndarray, ends: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """For each row the place of the longest listed name whose full string is in the array, or -1.

    One binary search for all candidates of the batch; equal keys are walked through until the string agrees.
    """
    best, longest = np.full(len(names), -1, np.int64), np.zeros(len(names), np.int64)
    probes = hashed.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    if not len(probes) or not len(keys):
        return best
    row = np.repeat(np.arange(len(names)), hashed.value_lengths().to_numpy(zero_copy_only=False))
    candidates = names.flatten()
    at = np.searchsorted(keys, probes)
    hit = np.flatnonzero((at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == probes))
    for c in hit:
        text, i = candidates[int(c)].as_py().encode(), int(at[c])
        while i < len(keys) and keys[i] == probes[c]:
            if texts[ends[i] : ends[i + 1]].tobytes() == text:
                if len(text) > longest[row[c]]:
                    best[row[c]], longest[row[c]] = i, len(text)
                break
            i += 1
    return best
