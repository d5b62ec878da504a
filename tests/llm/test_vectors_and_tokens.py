"""Vector links, components, chat trees, tokens and packing."""

import hashlib
import json
import random
import zlib
from array import array

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curbside.llm import bpe, chat_tree, embedding_join, packing
from curbside.llm.components import components


def linked_by_brute_force(rows, cosine):
    """Links and components of (id, vector, label) rows that are sound."""
    found = {}
    for i, x, label in rows:
        x = np.array(x, float)
        found[i] = {j for j, y, other in rows if j != i and other == label and len(y) == len(x) and x @ np.array(y, float) / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine}
    label = {i: i for i in found}
    while (new := {i: min([label[i], *(label[j] for j in js)]) for i, js in found.items()}) != label:
        label = new
    return {i: (len(js), label[i], label[i] == i) for i, js in found.items()}


@pytest.mark.parametrize("block", [7, 2048])
def test_vectors_link_as_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_join, "BLOCK", block)
    rng = np.random.default_rng(block)
    rows = []
    for label in (0, 1, 1, 2):
        for _ in range(4):
            centre = rng.normal(size=8)
            rows += [(centre + rng.normal(size=8) * s, label) for s in rng.choice([0.0, 0.05, 0.3, 1.0], 8)]
    rows += [(-rows[0][0], 0), (rows[0][0] * 1e-3, 0), (np.ones(3), 0), (np.ones(3) * 2, 0), (rows[0][0], 5)]
    order = rng.permutation(len(rows)).tolist()
    sound = [(100 + i, rows[k][0].astype(np.float32).tolist(), rows[k][1]) for i, k in enumerate(order)]
    odd = [(1, None, 0), (2, [0.0] * 8, 0), (3, [None] + [1.0] * 7, 0), (4, [float("nan")] * 8, 0), (5, [float("inf")] * 8, 0), (6, sound[0][1], None), (7, [], 0)]
    frame = spark.createDataFrame([(*r, "x", 1.0) for r in [*sound, *odd]], "vec_id long, embedding array<float>, label int, block string, links double")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_join.link_vectors(frame).collect()}
    assert found == linked_by_brute_force(sound, 0.93) | {i: (0, i, True) for i, *_ in odd}


def test_a_large_group_of_copies_and_an_empty_table(spark):
    frame = spark.range(3000).select(F.col("id").alias("vec_id"), F.expr("array(1f, 2f, cast(id % 2 as float))").alias("embedding"), F.lit(1).alias("label"))
    found = embedding_join.link_vectors(frame).groupBy("n_links", "component_id").count().collect()
    a, b = np.array([1, 2, 0]), np.array([1, 2, 1])
    assert a @ b / np.linalg.norm(a) / np.linalg.norm(b) < 0.93
    assert sorted(map(tuple, found)) == [(1499, 0, 1500), (1499, 1, 1500)]
    assert embedding_join.link_vectors(frame.limit(0)).collect() == []


def test_components_of_chains_stars_and_odd_links(spark):
    rnd = random.Random(2)
    chain = list(range(1000, 1040))
    rnd.shuffle(chain)
    links = [*zip(chain, chain[1:], strict=False), *((7, 100 + i) for i in range(50)), (5, 5), (None, 3), (3, None), (7, 100), (100, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {c: 1000 for c in chain} | {100 + i: 7 for i in range(50)} | {7: 7}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


CONTROL = st.text(alphabet="<|\\>imstart_end ok\n", max_size=30)


@settings(max_examples=300, deadline=None)
@given(CONTROL, CONTROL)
def test_turns_come_back_and_hold_no_control_string(role, text):
    turn = chat_tree.format_turn(role, text)
    assert chat_tree.parse_turn(turn) == (role, text)
    assert turn.count("<|") == 2 and chat_tree.unescape(chat_tree.escape(text)) == text


def conversations(spark):
    rows = []
    for c in range(40):
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of kind {c % (2 + t)}") for t in range(1 + c % 6)]
    rows += [(50, 0, "user", None), (50, 1, None, "no role"), (50, 1, "assistant", "<|im_end|>\\"), (51, 0, "user", "same"), (51, 0, "user", "same"), (None, 0, "user", "lost"), (52, None, "assistant", "é" * 100_000)]
    random.Random(3).shuffle(rows)
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, position int")


def test_conversations_come_back_from_the_tree(spark):
    rows, frame = conversations(spark)
    nodes, members = chat_tree.build_tree(frame)
    found = {r.conv_id: r for r in chat_tree.read_back(nodes, members).collect()}
    by_id = {}
    for c, t, role, text in rows:
        by_id.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(found) == set(by_id)
    for c, turns in by_id.items():
        turns = [(r, t) for *_, r, t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        r = found[c]
        assert (r.n_turns, r.turns_read, r.loss_chars) == (len(turns), len(turns), len(learned))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat_tree.format_turn(a, b)) for a, b in turns)


def merged(spans):
    out = []
    for a, b in spans:
        if out and out[-1][1] == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def test_shared_turns_stand_once_in_depth_first_order(spark):
    rows, frame = conversations(spark)
    nodes, members = chat_tree.build_tree(frame)
    out = sorted(nodes.collect(), key=lambda r: r.stream_start)
    prefixes = set()
    by_id = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by_id.setdefault(c, []).append((role or "", text or ""))
    for turns in by_id.values():
        prefixes |= {tuple(turns[: i + 1]) for i in range(len(turns))}
    assert len(out) == len(prefixes)
    place, open_nodes = 0, []
    for r in out:
        assert r.stream_start == place and r.stream_end == place + len(r.formatted)
        place = r.stream_end
        spans = merged((s.stream_start, s.stream_end) for s in r.attends)
        while open_nodes and merged(open_nodes) != spans:  # depth first: the ancestors are the nodes still open
            open_nodes.pop()
        assert merged(open_nodes) == spans and r.position == sum(b - a for a, b in spans)
        open_nodes.append((r.stream_start, r.stream_end))
    empty, nobody = chat_tree.build_tree(frame.limit(0))
    assert empty.collect() == [] and nobody.collect() == []
    assert chat_tree.read_back(empty, nobody).collect() == []


def test_a_conversation_of_100_000_turns_and_as_many_rows_without_an_id(spark):
    long = spark.range(100_000).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id") % 1000).alias("text"))
    lost = spark.range(100_000).select(F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.lit("x").alias("text"))
    prefix = long.where("turn < 50001").withColumn("conv_id", F.lit(8).cast("long")).withColumn("text", F.when(F.col("turn") == 50_000, "other").otherwise(F.col("text")))
    nodes, members = chat_tree.build_tree(long.unionByName(lost).unionByName(prefix))
    nodes = nodes.cache()
    found = {r.conv_id: r for r in chat_tree.read_back(nodes, members).collect()}
    turns = [("assistant" if i % 2 else "user", f"t{i % 1000}") for i in range(100_000)]
    for c, want in ((7, turns), (8, [*turns[:50_000], ("user", "other")]), (None, [("assistant", "x")] * 100_000)):
        assert (found[c].n_turns, found[c].turns_read) == (len(want), len(want))
        assert found[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in want).encode()).hexdigest()
        assert found[c].loss_sha256 == hashlib.sha256("".join(t for r, t in want if r == "assistant").encode()).hexdigest()
    assert nodes.count() == 200_001 and nodes.agg(F.max(F.size("attends"))).first()[0] == 2
    nodes.unpersist()


def test_nodes_in_tokens_are_those_of_the_library(spark, definition):
    rows, frame = conversations(spark)
    nodes, _ = chat_tree.build_tree(frame, definition)
    tool, place, open_nodes = library(definition), 0, []
    encode = lambda text: tool.encode(text, add_special_tokens=False).ids
    for r in sorted(nodes.collect(), key=lambda r: r.stream_start):
        role, text = chat_tree.parse_turn(r.formatted)
        body = chat_tree.escape(text)
        low = r.loss_end - len(body)
        head, inner, foot = encode(r.formatted[:low]), encode(body), encode(r.formatted[r.loss_end :])
        assert r.ids == head + inner + foot
        assert r.ids[r.loss_ids_start : r.loss_ids_end] == (inner if role == "assistant" else [])
        assert (r.stream_start, r.stream_end) == (place, place + len(r.ids))
        place = r.stream_end
        spans = merged((s.stream_start, s.stream_end) for s in r.attends)
        while open_nodes and merged(open_nodes) != spans:
            open_nodes.pop()
        assert merged(open_nodes) == spans and r.position == sum(b - a for a, b in spans)
        assert r.position_ids == list(range(r.position, r.position + len(r.ids)))
        open_nodes.append((r.stream_start, r.stream_end))


TEXTS = ["", "Hello,  WORLD!\nit's 2024", "<|endoftext|>a<|startoftext|> <|ENDOFTEXT|>", "ÉéΣΑΣ ŒÅﬁ İı ǅ é", "日本語 한글 🙂👨‍👩‍👧  x　y\x1cz\x85", "supercalifragilistic" * 40, "a" * 5000, "don't we'LL i'm 'S", "\x00\x01﻿​"]


def library(definition):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition)


def test_ids_are_those_of_the_library(make_docs, definition, spark):
    tool = library(definition)
    docs = make_docs([*enumerate(TEXTS), (None, None), (1, TEXTS[1])])
    for r in bpe.encode_texts(docs, definition).collect():
        ids = tool.encode(TEXTS[r.doc_id] if r.doc_id is not None else "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == tool.decode(ids, skip_special_tokens=False)
    for r in bpe.token_digests(docs, definition).collect():
        ids = tool.encode(TEXTS[r.doc_id] if r.doc_id is not None else "", add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tool.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.token_digests(make_docs([]), definition).collect() == []


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=40))
def test_any_text_encodes_as_in_the_library(definition, text):
    text = text.encode("utf-8", "ignore").decode()
    assert bpe.codec(definition).encode(text) == library_once(definition).encode(text, add_special_tokens=False).ids


_library = {}


def library_once(definition):
    return _library.setdefault(definition, library(definition))


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize("suffix", ["", "</w>"])
def test_prefix_encoding_equals_the_merge_rules(shuffled, suffix):
    """Also for tables in which a rule may come before the rules of its parts, as far as each token encodes as itself."""
    rnd = random.Random(9)
    vocabulary = {c + s: i for i, (c, s) in enumerate((c, s) for c in "abc" for s in {"", suffix})}
    merges = []
    while len(merges) < 60:
        a, b = rnd.choice([t for t in vocabulary if not suffix or not t.endswith(suffix)]), rnd.choice(list(vocabulary))
        if a + b not in vocabulary and len(a + b) < 14:
            vocabulary[a + b] = len(vocabulary)
            merges.append((a, b))
    encoder = bpe.PrefixEncoder(vocabulary, merges, suffix)
    assert encoder.in_order
    if shuffled:
        encoder.in_order = False  # the literal rules decide on pairs
    for _ in range(400):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
        inner = word[:-1] + chr(ord(word[-1]) + bpe.FINAL) if suffix else word
        assert array("I", encoder(word)).tolist() == [encoder.ids[t] for t in encoder.merge(inner)]


def test_caches_are_bounded_and_change_nothing():
    cache = bpe.Cache(lambda k: k * 2, 3)
    assert [cache[k] for k in [*"abcdefgabc", "x" * 100]] == [k * 2 for k in [*"abcdefgabc", "x" * 100]]
    assert len(cache) <= 3 and len(cache.older) <= 3


def test_unsupported_files_are_refused(definition):
    spec = json.loads(definition) | {"decoder": {"type": "ByteLevel"}}
    with pytest.raises(ValueError, match="not supported"):
        bpe.Codec(json.dumps(spec))


@pytest.mark.parametrize("seed", range(6))
def test_rounds_place_every_piece_without_holes(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 64, 4096])
    histogram = {rnd.randint(1, capacity): rnd.choice([1, 3, 1000]) for _ in range(200)}
    places = packing.plan_places(histogram, capacity)
    held = {}
    for length, runs in places.items():
        ends = [r[0] for r in runs[1:]] + [histogram[length]]
        assert runs[0][0] == 0
        for (rank, side, first, offset), end in zip(runs, ends, strict=True):
            for r in range(rank, end):
                held.setdefault(first + (r - rank) // side, []).append((offset + (r - rank) % side * length, length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(k * n for k, n in histogram.items()) // capacity)
    large = sum(n for k, n in histogram.items() if 2 * k > capacity)
    assert len(held) <= max(least, large) * 11 / 9 + 1 and sorted(held) == list(range(len(held)))


def test_packing_equals_best_fit_of_single_pieces():
    """In the number of sequences, piece by piece in falling length."""
    rnd = random.Random(4)
    sizes = sorted((rnd.randint(1, 100) for _ in range(500)), reverse=True)
    gaps = []
    for s in sizes:
        fits = [g for g in gaps if g >= s]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - s)
        else:
            gaps.append(100 - s)
    histogram = {s: sizes.count(s) for s in sizes}
    places = packing.plan_places(histogram, 100)
    used = max(first + (min([r[0] for r in runs if r[0] > rank] + [histogram[k]]) - rank - 1) // side for k, runs in places.items() for rank, side, first, _ in runs) + 1
    assert used == len(gaps)


def test_documents_are_packed_whole(make_docs, definition):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["the", "cat", "sat", "on", "extraordinary"]) for _ in range(rnd.choice([0, 1, 5, 60, 60, 60, 300]))) for _ in range(200)] + ["word " * 9000, None, *TEXTS]
    tool = library(definition)
    ids = {i: [*tool.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    rows = packing.pack_documents(make_docs(list(enumerate(texts))), definition, capacity=512).collect()
    pieces, sequences = {}, {}
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes()) and r.start == 512 * r.piece
        pieces.setdefault(r.doc_id, []).append(r.length)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {i: sum(p) for i, p in pieces.items()} == {i: len(x) for i, x in ids.items()}
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))] and sum(n for _, n in held) <= 512
    assert len(sequences) <= 1.1 * sum(map(len, ids.values())) / 512 + 1
    again = packing.pack_documents(make_docs([(None, "a"), (None, "a"), (1, "a"), (1, "a")]), definition).collect()
    assert sorted(r.offset for r in again) == [0, 2, 4, 6] and {r.sequence_id for r in again} == {0}
    assert packing.pack_documents(make_docs([]), definition).collect() == []
