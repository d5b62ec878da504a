"""Chat formatting over a prefix tree of conversations.

A node is a turn after a certain sequence of turns: conversations that share their first turns share nodes. The output has
every node once, in depth-first order, with its place in the stream, the position at which its text stands in each of its
conversations, and the stream intervals of its ancestors: the only text besides itself that it may attend to. Places,
positions and intervals count characters, or tokens if a tokenizer is given; then every node has its token ids and a position
id per token, too.

Turns stay rows. They are sorted by ranges, and what runs along a conversation (depth, position, the polynomial hash of
all turns so far, the path) is summed up within each range first; one small row per range then says what the conversation that
it begins with brings along. All of these sums are associative, so that a conversation may be longer than any range.
A line of turns without a branch is one segment, and a path has one entry per segment: it grows with the branches on the way,
not with the turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.bpe import codec
from curbside.llm.storage import stage

START, END = "<|im_start|>", "<|im_end|>"

#: Hashes of turn sequences are polynomials over this prime field.
PRIME, BASE = (1 << 127) - 1, 0x5DEECE66D1CE4E5B9F4A7C159E3779B9

#: Letters of a path per segment.
STEP = 16

#: Rows after one node are dealt to so many tasks.
SALTS = 32

#: Rows that a task hands over at once.
ROWS = 512


def escape(text: str) -> str:
    """Puts a backslash into every ``<|``; ``<\\|`` gets one more, and so on. No control string is left."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def format_turn(role: str, text: str) -> str:
    role = escape(role).replace("\\", "\\\\").replace("\n", "\\n")
    return f"{START}{role}\n{escape(text)}{END}\n"


def parse_turn(formatted: str) -> tuple[str, str]:
    if not (formatted.startswith(START) and formatted.endswith(END + "\n")):
        raise ValueError("not a turn")
    role, _, text = formatted[len(START) : -len(END) - 1].partition("\n")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)
    return unescape(role), unescape(text)


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of all batches, a few at a time in Python."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in chain(rows, [None]):
        if row is not None:
            out.append(row)
        if out and (row is None or len(out) >= ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []


def _schema(**kinds: pa.DataType) -> pa.Schema:
    return pa.schema(list(kinds.items()))


_TEXT, _LONG, _FLAG = pa.string(), pa.int64(), pa.bool_()

_TURN = "part int, at long, conv_id {0}, opens boolean, steps long, before string, hash string, position long, size long, formatted string, loss_start long, loss_end long, ids array<int>, loss_ids_start int, loss_ids_end int"


def _format(definition: str | None) -> Callable:
    """Turns of sorted ranges, formatted, with what runs along each conversation since the range began.

    ``at`` is the row's place in its range, ``opens`` marks the conversation that the range begins with, ``steps`` counts
    its turns, ``hash`` is that of these turns and ``before`` that without the last, ``position`` the size of those before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict[str, pa.DataType] = {}

        def turns() -> Iterator[tuple]:
            tool = codec(definition) if definition else None
            conv, opens, steps, so_far, position = None, True, 0, 0, 0
            for at, (part, conv_id, role, text) in enumerate(_rows(peeked, "part", "conv_id", "role", "text")):
                if at and conv_id != conv:
                    opens, steps, so_far, position = False, 0, 0, 0
                conv, turn, before = conv_id, format_turn(role, text), so_far
                steps += 1
                so_far = (so_far * BASE + 1 + int.from_bytes(hashlib.md5(turn.encode()).digest(), "big")) % PRIME
                high = len(turn) - len(END) - 1
                low = high - len(escape(text)) if role == "assistant" else high
                ids, first, last = None, 0, 0
                if tool:
                    head, body, foot = (tool.encode(x) for x in (turn[: high - len(escape(text))], escape(text), turn[high:]))
                    ids = [*head, *body, *foot]
                    last = len(head) + len(body)
                    first = len(head) if role == "assistant" else last
                size = len(ids) if tool else len(turn)
                yield part, at, conv_id, opens, steps, f"{before:032x}", f"{so_far:032x}", position, size, turn, low, high, ids, first, last
                position += size

        if (first := next(batches, None)) is not None:
            peeked = chain([first], batches)
            kinds = dict(part=pa.int32(), at=_LONG, conv_id=first.schema.field("conv_id").type, opens=_FLAG, steps=_LONG, before=_TEXT, hash=_TEXT, position=_LONG, size=_LONG, formatted=_TEXT, loss_start=_LONG, loss_end=_LONG, ids=pa.list_(pa.int32()), loss_ids_start=pa.int32(), loss_ids_end=pa.int32())
            yield from _batches(turns(), _schema(**kinds))

    return run


def _brought(rows: DataFrame, value: list[str], follow: Callable, empty: tuple, kinds: dict[str, pa.DataType], ddl: str) -> DataFrame:
    """Per range what the conversation that it begins with ``brings`` along, and whether its last one ``goes_on``.

    ``rows`` have part, at, conv_id, opens and the columns ``value``, which hold for the conversation since its range
    began; ``follow`` joins two such values. Each range is one row here, and no more than that passes through one task.
    """
    last = F.struct(*value)
    ends = rows.groupBy("part").agg(
        F.min_by(F.struct("conv_id"), "at").alias("first"),
        F.max_by(F.struct("conv_id"), "at").alias("last"),
        F.max_by(last, F.when(F.col("opens"), F.col("at"))).alias("head"),
        F.max_by(last, "at").alias("tail"),
        F.min(F.col("opens")).alias("through"),
    )
    ends = ends.select("part", F.col("first.conv_id").alias("first"), F.col("last.conv_id").alias("last"), "through", *[F.col(f"{side}.{v}").alias(f"{side}_{v}") for side in ("head", "tail") for v in value])
    schema = _schema(part=pa.int32(), goes_on=_FLAG, **kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def states() -> Iterator[tuple]:
            names = [f"{side}_{v}" for side in ("head", "tail") for v in value]
            waiting, conv, state = None, None, empty
            for part, first, last, through, *found in _rows(batches, "part", "first", "last", "through", *names):
                head, tail = tuple(found[: len(value)]), tuple(found[len(value) :])
                same = waiting is not None and first == conv
                if waiting:
                    yield waiting[0], same, *waiting[1]
                brings = state if same else empty
                waiting = (part, brings)
                conv, state = last, follow(brings, head) if through else tail
            if waiting:
                yield waiting[0], False, *waiting[1]

        yield from _batches(states(), schema)

    return ends.repartition(1).sortWithinPartitions("part").mapInArrow(run, f"part int, goes_on boolean, {ddl}")


def _after(a: tuple, b: tuple) -> tuple:
    """Steps, hash and size of a sequence of turns after another."""
    joined = (int(a[1], 16) * pow(BASE, b[0], PRIME) + int(b[1], 16)) % PRIME
    return a[0] + b[0], f"{joined:032x}", a[2] + b[2]


_NODE = "part int, at long, node string, parent string, depth long, position long, last boolean"


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the turns: the hash of all turns of the conversation up to there."""

    def nodes() -> Iterator[tuple]:
        columns = ("part", "at", "opens", "steps", "before", "hash", "position", "ends", "brings_steps", "brings_hash", "brings_size")
        for part, at, opens, steps, before, here, position, ends, *brings in _rows(batches, *columns):
            if opens and brings[0]:
                before = _after(brings, (steps - 1, before, 0))[1]
                here = _after(brings, (steps, here, 0))[1]
                steps, position = steps + brings[0], position + brings[2]
            yield part, at, here, before if steps > 1 else None, steps - 1, position, ends

    schema = _schema(part=pa.int32(), at=_LONG, node=_TEXT, parent=_TEXT, depth=_LONG, position=_LONG, last=_FLAG)
    yield from _batches(nodes(), schema)


def _follow_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of each turn as far as its range knows it: one entry per segment that begins on the way."""

    def paths() -> Iterator[tuple]:
        known, path = None, ""
        for part, at, first, opens, node, head in _rows(batches, "part", "at", "first", "opens", "node", "head"):
            if first or part != known:
                path = ""
            known = part
            if head:
                path += node[:STEP]
            yield part, at, opens, node, path

    yield from _batches(paths(), _schema(part=pa.int32(), at=_LONG, opens=_FLAG, node=_TEXT, path=_TEXT))


def build_tree(conversations: DataFrame, definition: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The tree's nodes and, per conversation, its last node.

    Nodes: ``node``, ``tree`` (the root), ``stream_start`` and ``stream_end`` in the depth-first stream, ``position``,
    ``formatted``, ``loss_start`` and ``loss_end`` in characters within it (equal unless the role is ``assistant``),
    ``segment`` and ``attends``, the stream intervals of the ancestors from the root down. A line of turns without a
    branch is one segment, named by its start, and needs one interval. Members: ``conv_id``, ``n_turns``, ``node``.

    With the ``definition`` of a tokenizer, stream places, positions and intervals count tokens, and nodes have ``ids``,
    ``position_ids`` (one per token), ``loss_ids_start`` and ``loss_ids_end`` too. A turn's control strings with its role, its
    text, and its end are encoded apart, so that the loss begins and ends between tokens.

    Turns go by ``turn``, ties by role and text, null first; a repeated row is a turn of its own. A null role or text is
    empty. Rows with a null ``conv_id`` form one conversation with a null id. An empty table gives empty ones. No step
    collects a conversation, however long it is.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # Ranges by the beginning of the text, as the bounds of ranges pass the driver.
    dealt = turns.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(32)))
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("part", F.spark_partition_id())
    turns = stage(dealt.mapInArrow(_format(definition), _TURN.format(kind)), "chat-turns")

    sums = ["steps", "hash", "size"]
    kinds = dict(zip([f"brings_{v}" for v in sums], (_LONG, _TEXT, _LONG), strict=True))
    narrow = turns.select("part", "at", "conv_id", "opens", "steps", "before", "hash", "position", (F.col("position") + F.col("size")).alias("size"))
    brought = stage(_brought(narrow, sums, _after, (0, "0", 0), kinds, "brings_steps long, brings_hash string, brings_size long"), "chat-brought")
    # The last turn of a range goes on if its conversation does; any other is the last of its own if the next is a first one.
    ends = narrow.where("steps = 1 AND at > 0").select("part", (F.col("at") - 1).alias("at"), F.lit(True).alias("next"))
    tops = narrow.groupBy("part").agg(F.max("at").alias("top")).join(brought, "part")
    known = narrow.join(tops, "part").join(ends, ["part", "at"], "left")
    known = known.withColumn("ends", F.coalesce("next", (F.col("at") == F.col("top")) & ~F.col("goes_on")))
    named = stage(known.mapInArrow(_name, _NODE), "chat-named")
    members = named.where("last").join(turns.select("part", "at", "conv_id"), ["part", "at"]).select("conv_id", (F.col("depth") + 1).alias("n_turns"), "node")

    # A segment begins at a root and wherever a node has several children.
    edges = named.where("depth > 0").select("node", "parent").distinct()
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    branching = edges.groupBy("parent").count().where("count > 1").select(F.col("parent").alias("above"), F.lit(True).alias("branches"), salts)
    # A third of all turns may follow the same one.
    headed = named.withColumns({"above": F.coalesce("parent", "node"), "salt": F.pmod(F.hash("part", "at"), F.lit(SALTS))}).join(branching, ["above", "salt"], "left")
    headed = headed.join(narrow.select("part", "at", "opens", (F.col("steps") == 1).alias("first")), ["part", "at"])
    headed = headed.select("part", "at", "first", "opens", "node", ((F.col("depth") == 0) | F.col("branches").isNotNull()).alias("head"))
    ordered = headed.repartition("part").sortWithinPartitions("part", "at")
    paths = stage(ordered.mapInArrow(_follow_paths, "part int, at long, opens boolean, node string, path string"), "chat-paths")
    begun = paths.join(narrow.select("part", "at", "conv_id"), ["part", "at"])
    before = _brought(begun, ["path"], lambda a, b: (a[0] + b[0],), ("",), {"brings": _TEXT}, "brings string").drop("goes_on")
    whole = paths.join(before, "part").select("part", "at", F.when(F.col("opens"), F.concat("brings", "path")).otherwise(F.col("path")).alias("path"))
    chosen = named.join(whole, ["part", "at"]).groupBy("node").agg(F.min(F.struct("part", "at", "path", "depth", "position")).alias("one")).select("node", "one.*")

    # Every node once, in depth-first order: a segment before those that branch off at its end.
    carried = ["formatted", "loss_start", "loss_end", "size", *(["ids", "loss_ids_start", "loss_ids_end"] if definition else [])]
    nodes = stage(chosen.join(turns.select("part", "at", *carried), ["part", "at"]).drop("part", "at"), "chat-nodes")
    columns = ["node", "path", "depth", "position", *carried]
    spread = nodes.select(*columns).repartitionByRange("path", "depth").sortWithinPartitions("path", "depth").withColumn("part", F.spark_partition_id())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spread.schema)
    placed = stage(spread.mapInArrow(_place, f"{schema}, local_end long"), "chat-placed")
    totals = placed.groupBy("part").agg(F.sum("size").alias("total"))
    offsets = totals.repartition(1).sortWithinPartitions("part").mapInArrow(_offsets, "part int, base long")  # a row per range
    placed = placed.join(offsets, "part").withColumn("stream_end", F.col("base") + F.col("local_end"))
    placed = placed.withColumn("stream_start", F.col("stream_end") - F.col("size"))

    segments = stage(placed.groupBy("path").agg(F.min("stream_start").alias("segment"), F.max("stream_end").alias("end")), "chat-segments")
    wanted = segments.select(F.col("path").alias("own"), F.explode(F.sequence(F.lit(1), (F.length("path") / STEP).cast("int"))).alias("levels")).where(F.col("levels") * STEP < F.length("own"))
    wanted = wanted.select("own", F.substr("own", F.lit(1), F.col("levels") * STEP).alias("path"))
    span = F.struct(F.col("segment").alias("stream_start"), F.col("end").alias("stream_end"))
    above = wanted.join(segments, "path").groupBy(F.col("own").alias("path")).agg(F.sort_array(F.collect_list(span)).alias("above"))
    out = placed.join(segments.drop("end").join(above, "path", "left"), "path").withColumn("tree", F.left("path", F.lit(STEP)))
    none = F.array().cast("array<struct<stream_start:bigint,stream_end:bigint>>")
    own = F.when(F.col("segment") < F.col("stream_start"), F.array(F.struct(F.col("segment").alias("stream_start"), F.col("stream_start").alias("stream_end")))).otherwise(none)
    attends = F.concat(F.coalesce("above", none), own).alias("attends")
    tokens = ["ids", F.sequence(F.col("position"), F.col("position") + F.col("size") - 1).alias("position_ids"), "loss_ids_start", "loss_ids_end"] if definition else []
    return out.select("node", "tree", "segment", "stream_start", "stream_end", "position", "formatted", "loss_start", "loss_end", *tokens, attends), members


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each node ends within its range of the stream."""
    total = 0
    for batch in batches:
        ends = batch.column("size").to_numpy().cumsum() + total
        total = int(ends[-1]) if len(ends) else total
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.int64())], names=[*batch.schema.names, "local_end"])


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each range begins in the stream."""
    before = 0
    for batch in batches:
        ends = batch.column("total").to_numpy().cumsum() + before
        yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(ends - batch.column("total").to_numpy(), pa.int64())], names=["part", "base"])
        before = int(ends[-1]) if len(ends) else before


def read_back(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Every conversation as its last node may see it: the text of the attended intervals, then its own, in order.

    ``conv_id``, ``n_turns``, and of what was read: ``turns_read``, ``turns_sha256``, ``loss_chars``, ``loss_sha256`` and
    ``formatted_chars``. Each last node is read once, however many conversations end there, and turn by turn.
    """
    nodes = stage(nodes, "chat-stream")
    leaves = nodes.join(members.select("node").distinct(), "node", "left_semi")
    # The attended intervals, the last of them up to the end of the node itself. Each begins where a segment does.
    inner = F.filter("attends", lambda x: x.stream_start != F.col("segment"))
    own = F.struct(F.col("segment").alias("stream_start"), "stream_end")
    wanted = leaves.select("node", F.explode(F.concat(inner, F.array(own))).alias("span"))
    wanted = wanted.select("node", F.col("span.stream_start").alias("segment"), F.col("span.stream_end").alias("until"))
    texts = wanted.join(nodes.select("segment", "stream_end", "position", "formatted", "loss_start", "loss_end"), "segment").where("stream_end <= until")
    ordered = texts.select("node", "position", "formatted", "loss_start", "loss_end").repartition("node").sortWithinPartitions("node", "position")
    return members.join(ordered.mapInArrow(_digest, _DIGEST), "node").drop("node")


_DIGEST = "node string, turns_read long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def leaves() -> Iterator[tuple]:
        leaf = None
        for node, formatted, low, high in _rows(batches, "node", "formatted", "loss_start", "loss_end"):
            if node != leaf:
                if leaf is not None:
                    yield leaf, n, said.hexdigest(), learned_chars, learned.hexdigest(), chars
                leaf, n, said, learned, learned_chars, chars = node, 0, hashlib.sha256(), hashlib.sha256(), 0, 0
            role, text = parse_turn(formatted)
            said.update(f"{role}\n{text}\n".encode())
            part = unescape(formatted[low:high])
            learned.update(part.encode())
            n, learned_chars, chars = n + 1, learned_chars + len(part), chars + len(formatted)
        if leaf is not None:
            yield leaf, n, said.hexdigest(), learned_chars, learned.hexdigest(), chars

    yield from _batches(leaves(), _schema(node=_TEXT, turns_read=_LONG, turns_sha256=_TEXT, loss_chars=_LONG, loss_sha256=_TEXT, formatted_chars=_LONG))
