"""Near-duplicate vectors by an epsilon grid order join.

Vectors of one label are scaled to length one and turned to their principal axes, so that a cosine is a distance and the first
dimensions tell the most. Sorted by the grid cells (of side epsilon) of the leading dimensions, near vectors stand near
each other; the order is cut into blocks. Two blocks are joined only if their cells touch and their bounding boxes, over
all dimensions, come as near as epsilon; inside, both intervals are halved again and again and every pair of halves that is
provably distant is skipped. What is left is decided by the exact cosine. A pair of blocks gives counts and a spanning forest
of its links, never the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.components import components, forest
from curbside.llm.storage import stage

#: Vectors in a block, in the smallest interval of the recursion, and leading dimensions with grid cells.
BLOCK, LEAF, GRID = 2048, 128, 4

#: Bounds are widened by this, far above any rounding.
SLACK = 1e-6


def link_vectors(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """``n_links``, ``component_id`` and ``kept`` of every row of ``vec_id``, ``embedding``, ``label``.

    Two vectors link if their labels are equal and not null, they have as many components and their cosine in double
    precision is at least ``cosine``. A vector that is null or zero, or holds a null or non-finite component, links with
    nothing: no links, a component of its own. Equal vectors of a label are joined once and counted as often as they
    occur. Rows are told apart by ``vec_id``; repeated rows with one id are copies of each other. A row with a null id has
    neither component nor neighbours, and is not kept. Other columns are ignored; an empty table gives an empty one.
    """
    rows = vectors.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"), "label")
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
    sound &= F.coalesce(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0), F.lit(False))
    rows = stage(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "vectors")
    copies = rows.where("sound").groupBy("label", "x").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    copies = stage(copies.withColumn("dim", F.size("x")), "distinct-vectors")
    # Copies are found again by their values, not by a list of members.
    member = rows.where("sound").select("vec_id", "label", "x").join(copies.select("label", "x", "rep", "n"), ["label", "x"]).select("vec_id", "rep", "n")

    axes = copies.sparkSession.sparkContext.broadcast(principal_axes(copies))  # dim x dim numbers
    blocks = stage(_blocks(copies, axes, cosine), "blocks")
    found = stage(_join_blocks(blocks, axes, cosine), "vector-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    groups = groups.withColumnRenamed("node", "rep")
    linked = member.join(counts, "rep", "left").join(groups, "rep", "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    alone = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _unit(data: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest component is scaled away first, so that no square over- or underflows."""
    data = data / np.abs(data).max(axis=1, keepdims=True)
    return data / np.sqrt((data**2).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = batch.column(0).to_numpy()
        for dim in np.unique(dims).tolist():
            x = _unit(_matrix(batch.column(1).filter(pa.array(dims == dim)), dim))
            sums[dim] = sums.get(dim, 0) + x.T @ x
    for dim, m in sums.items():
        i, j = np.indices(m.shape)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, dim), pa.int32()), pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(m.ravel())], names=["dim", "i", "j", "s"])


def principal_axes(copies: DataFrame) -> dict[int, np.ndarray]:
    """For each number of components the axes by falling variance, from sums over all vectors: dim x dim numbers."""
    axes = {}
    sums = copies.select("dim", "x").mapInArrow(_moments, "dim int, i int, j int, s double").groupBy("dim", "i", "j").agg(F.sum("s").alias("s"))
    for r in sums.collect():
        axes.setdefault(r.dim, np.zeros((r.dim, r.dim)))[r.i, r.j] = r.s
    return {dim: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1] for dim, m in axes.items()}


def epsilon(cosine: float) -> float:
    return math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK


def _blocks(copies: DataFrame, axes: Broadcast, cosine: float) -> DataFrame:
    """Blocks of the grid order: ids, counts and vectors, and the box around them along the principal axes."""
    side = epsilon(cosine)
    cells = [f"c{i}" for i in range(GRID)]

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = _matrix(part.column(4), dim)
                y = _unit(x) @ axes.value[dim]
                grid = np.zeros((len(y), GRID), np.int32)
                grid[:, : min(GRID, dim)] = np.floor(y[:, :GRID] / side)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], *(pa.array(grid[:, i]) for i in range(GRID)), pa.array([v.tobytes() for v in x], pa.binary())],
                    names=["label", "dim", "rep", "n", *cells, "x"],
                )

    kind = copies.schema["label"].dataType.simpleString()
    schema = f"label {kind}, dim int, rep long, n long, {', '.join(f'{c} int' for c in cells)}, x binary"
    turned = stage(copies.select("label", "dim", "rep", "n", "x").mapInArrow(turn, schema), "turned")
    order = ["label", "dim", *cells, "rep"]
    ordered = turned.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"block string, label {kind}, dim int, low array<double>, high array<double>, reps array<long>, ns array<long>, data binary"
    return ordered.mapInArrow(_cutter(axes), schema)


def _cutter(axes: Broadcast):
    names = ["block", "label", "dim", "low", "high", "reps", "ns", "data"]

    def block(rows: pa.Table) -> pa.RecordBatch:
        label, dim = rows.column("label")[0].as_py(), rows.column("dim")[0].as_py()
        reps, data = rows.column("rep").to_pylist(), b"".join(rows.column("x").to_pylist())
        y = _unit(np.frombuffer(data).reshape(-1, dim)) @ axes.value[dim]
        values = (f"{label}-{dim}-{reps[0]}", label, dim, y.min(axis=0).tolist(), y.max(axis=0).tolist(), reps, rows.column("n").to_pylist(), data)
        kinds = (pa.string(), rows.schema.field("label").type, pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            while held.num_rows:
                keys = list(zip(held.column("label").to_pylist(), held.column("dim").to_pylist(), strict=True))
                same = next((i for i, k in enumerate(keys) if k != keys[0]), len(keys))
                if same == len(keys) and same < BLOCK:
                    break
                yield block(held.slice(0, min(same, BLOCK)))
                held = held.slice(min(same, BLOCK))
        if held is not None and held.num_rows:
            yield block(held)

    return cut


def _join_blocks(blocks: DataFrame, axes: Broadcast, cosine: float) -> DataFrame:
    """Links of each pair of blocks that come near: per vector their number, and the root of its tree of links."""
    side = epsilon(cosine)
    box = blocks.select("block", "label", "dim", "low", "high")
    first = lambda c: F.floor(F.element_at(c, 1) / side)
    cells = box.withColumn("cell", F.explode(F.sequence(first("low"), first("high"))))
    around = box.withColumn("cell", F.explode(F.sequence(first("low") - 1, first("high") + 1)))
    near = cells.alias("a").join(around.alias("b"), ["label", "dim", "cell"]).where("a.block <= b.block")
    gap = lambda lo, hi: F.greatest(lo - hi, F.lit(0.0))
    apart = F.zip_with(F.zip_with("a.low", "b.high", gap), F.zip_with("b.low", "a.high", gap), lambda x, y: x * x + y * y)
    near = near.where(F.aggregate(apart, F.lit(0.0), lambda s, x: s + x) <= side * side)
    pairs = near.select(F.least("a.block", "b.block").alias("one"), F.greatest("a.block", "b.block").alias("two")).distinct()
    pairs = stage(pairs, "block-pairs")
    load = blocks.select("block", "dim", "reps", "ns", "data")
    named = lambda name, tag: load.select(F.col("block").alias(name), *(F.col(c).alias(f"{c}_{tag}") for c in ("dim", "reps", "ns", "data")))
    work = pairs.join(named("one", "a"), "one").join(named("two", "b"), "two")
    return work.mapInArrow(_linker(axes, cosine), "rep long, links long, root long")


def _linker(axes: Broadcast, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, row=row, batch=batch: batch.column(batch.schema.get_field_index(name))[row]
                same = get("one").as_py() == get("two").as_py()
                side = []
                for tag in ("a", "b"):
                    data = np.frombuffer(get(f"data_{tag}").as_buffer()).reshape(-1, get(f"dim_{tag}").as_py())
                    side.append((np.array(get(f"reps_{tag}").values), np.array(get(f"ns_{tag}").values), data))
                yield pa.RecordBatch.from_arrays(list(map(pa.array, link_blocks(*side, same, cosine, axes.value))), names=["rep", "links", "root"])

    return run


def link_blocks(a: tuple, b: tuple, same: bool, cosine: float, axes: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join two blocks (ids, counts, vectors): for each linked vector its number of links and a root."""
    (ids_a, n_a, x), (ids_b, n_b, y) = a, b
    x, y, turn = _unit(x), _unit(y), axes[x.shape[1]]
    links = np.zeros((len(x), len(y)), bool)
    _recurse(x, y, _boxes(x @ turn), _boxes(y @ turn), 0, len(x), 0, len(y), links, cosine, epsilon(cosine) ** 2)
    if same:
        np.fill_diagonal(links, False)
    ids = ids_a if same else np.concatenate([ids_a, ids_b])
    count = links @ n_b if same else np.concatenate([links @ n_b, links.T @ n_a])
    root = forest(links, ids_a, ids_b)[: len(ids)]  # of a block with itself, both sides are the same nodes
    keep = count > 0
    return ids[keep], count[keep].astype(np.int64), root[keep]


def _boxes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each run of LEAF vectors."""
    edges = np.arange(0, len(x), LEAF)
    return np.minimum.reduceat(x, edges), np.maximum.reduceat(x, edges)


def _recurse(x, y, box_x, box_y, a0, a1, b0, b1, links, cosine, most) -> None:
    """Mark the links of two intervals; distant ones are skipped, long ones halved."""
    i, j = slice(a0 // LEAF, -(-a1 // LEAF)), slice(b0 // LEAF, -(-b1 // LEAF))
    gap = np.maximum(0, np.maximum(box_x[0][i].min(axis=0) - box_y[1][j].max(axis=0), box_y[0][j].min(axis=0) - box_x[1][i].max(axis=0)))
    if (gap**2).sum() > most:
        return
    if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
        links[a0:a1, b0:b1] = x[a0:a1] @ y[b0:b1].T >= cosine
        return
    half = lambda lo, hi: [(lo, hi)] if hi - lo <= LEAF else [(lo, m := lo + -(-(hi - lo) // (2 * LEAF)) * LEAF), (m, hi)]
    for p in half(a0, a1):
        for q in half(b0, b1):
            _recurse(x, y, box_x, box_y, *p, *q, links, cosine, most)
