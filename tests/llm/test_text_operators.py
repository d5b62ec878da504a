"""Word hashing, repeated passages, Jaccard components and fingerprints against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curbside.llm import fingerprint, jaccard_join, substring_dedup
from curbside.llm.words import Words, slices

AWKWARD = [
    (None, "a null id"),
    (None, "a null id"),
    (1000, None),
    (1001, ""),
    (1002, " \t\n\r\x0b\x0c "),
    (1003, "one"),
    (1004, "ONE"),
    (1005, "no break space"),
    (1006, "é" * 3000 + " " + "x" * 200_000),
    (1007, "four words only here"),
    (1008, "Four  words\tonly here"),
]


def random_texts(seed, n, vocabulary=12, most=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    return ["".join(rnd.choice(words) + rnd.choice([" ", "  ", "\n"]) for _ in range(rnd.randint(0, most))) for _ in range(n)]


def test_words_are_those_of_a_split():
    texts = [t for _, t in AWKWARD] + random_texts(1, 50)
    column = pa.array(["front", *texts, "back"]).slice(1, len(texts))
    words = Words(column)
    for i, text in enumerate(texts):
        own = [bytes(words.data[a:b]) for a, b in zip(words.starts[words.first[i] : words.first[i + 1]], words.ends[words.first[i] : words.first[i + 1]], strict=True)]
        assert own == (text or "").encode().split()
    by_hash = {}
    for a, b, h in zip(words.starts, words.ends, words.hashes, strict=True):
        assert by_hash.setdefault(int(h), bytes(words.data[a:b])) == bytes(words.data[a:b])
    assert len(by_hash) == len(set(by_hash.values()))


def test_words_longer_than_a_piece_and_folded_ones():
    long = "x" * 3_000_000
    a, b = Words(pa.array([f"A {long} b", f"a {long} B"]), lower=True), Words(pa.array([f"A {long} b", f"a {long} B"]))
    assert (a.hashes[:3] == a.hashes[3:]).all() and len(a.hashes) == 6
    assert (b.hashes[:3] == b.hashes[3:]).tolist() == [False, True, False]


def test_beginnings_are_shared_by_inflected_words():
    words = Words(pa.array(["Loweisch loweient low lowe"]), lower=True, letters=True, beginnings=(4, 5))
    (at4, four), (at5, five) = words.beginnings
    assert at4.tolist() == [0, 1] == at5.tolist() and four[0] == four[1] and five[0] == five[1] and four[0] != five[0]


def test_windows_are_equal_exactly_for_equal_words():
    words = Words(pa.array(random_texts(2, 40, vocabulary=2, most=40)))
    flat = [bytes(words.data[a:b]) for a, b in zip(words.starts, words.ends, strict=True)]
    seen = {}
    starts, hashes = words.windows(5)
    for s, h in zip(starts.tolist(), hashes.tolist(), strict=True):
        assert words.row[s] == words.row[s + 4]
        assert seen.setdefault(h, flat[s : s + 5]) == flat[s : s + 5]
    assert len(seen) == len({tuple(v) for v in seen.values()})
    assert len(starts) == sum(max(0, n - 4) for n in words.counts)


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(["a" * 10, None, "b" * 50, "", "c" * 10])], names=["i", "text"])
    parts = list(slices(batch, "text", 20))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1], [2], [3, 4]] or sum((p.column(0).to_pylist() for p in parts), []) == list(range(5))
    assert list(slices(batch.slice(0, 0), "text")) == []


def removed_by_brute_force(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_repeats_go_as_by_brute_force(make_docs, seed):
    passage = " ".join(f"p{i}" for i in range(9))
    texts = random_texts(seed, 60, vocabulary=40) + [f"{t} {passage} z{i}" for i, t in enumerate(random_texts(seed + 9, 40, most=5))]
    texts += ["a a a a a a a a a a", " ".join(["b"] * 5), "same text of six words here", "same text of six words here"]
    rows = [*enumerate(texts), *AWKWARD]
    found = substring_dedup.remove_repeats(make_docs(rows), width=5).collect()
    expected = removed_by_brute_force([t for _, t in rows], 5)
    key = lambda r: (r[0] is not None, r[0] or 0, r[3])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found), key=key) == sorted(((i, *e) for (i, _), e in zip(rows, expected, strict=True)), key=key)
    for r in found:
        assert sum(x["end"] - x["first"] for x in r.removed) == r.n_removed


def test_digests_of_kept_words_and_hand_through_of_rows(make_docs):
    docs = make_docs([(1, "a b c d e"), (2, "x a b c d e y"), (3, None)])
    found = {r.doc_id: r for r in substring_dedup.remove_repeats(docs, width=5, keep_text=False).collect()}
    assert found[2].kept_sha256 == hashlib.sha256(b"x y").hexdigest() and found[1].n_removed == 5 and found[3].n_words == 0
    assert substring_dedup.remove_repeats(docs, width=5, id_column="source").columns[0] == "source"


def test_equal_rows_are_one_row_with_a_count(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "MOST_COPIES", 7)
    words = " ".join(f"w{i}" for i in range(40))
    docs = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 2, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 2, F.concat(F.lit("own "), F.col("id"))).otherwise(words).alias("text"))
    found = substring_dedup.remove_repeats(docs).groupBy("doc_id", "n_words", "n_removed", "kept_text").count()
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_text): r["count"] for r in found.where("doc_id IS NULL OR doc_id = 5").collect()}
    assert got == {(5, 40, 40, ""): 10_000, (None, 40, 40, ""): 10_000, (5, 2, 0, "own 5"): 1}
    assert found.count() == 2 + 10_000


def test_no_documents_at_all(make_docs):
    empty = make_docs([])
    assert substring_dedup.remove_repeats(empty).collect() == []
    assert jaccard_join.similar_documents(empty).collect() == []
    assert jaccard_join.keep_one_each(empty).collect() == []
    assert fingerprint.fingerprint_documents(empty).collect() == []


def shingles(text):
    w = (text or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})).encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components_by_brute_force(rows):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i, a in sets.items():
            for j, b in sets.items():
                if a and b and 100 * len(a & b) >= 80 * len(a | b) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def near_copies(seed, families=6, members=8):
    """Families of texts that drift apart, so that many similarities lie around the threshold."""
    rnd = random.Random(seed)
    texts = []
    for f in range(families):
        words = [f"f{f}w{rnd.randint(0, 400)}" for _ in range(rnd.choice([30, 60, 150]))]
        for _ in range(members):
            words = list(words)
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = f"new{rnd.random()}"
            texts.append(" ".join(words).upper() if rnd.random() < 0.3 else " ".join(words))
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [5, 6])
def test_components_are_those_of_brute_force(make_docs, seed):
    shared = " ".join(f"license{i}" for i in range(30))
    texts = near_copies(seed) + [f"{shared} own{i} text{i} with{i}" for i in range(40)] + [f"{shared} {t}" for t in random_texts(seed, 20)]
    rows = [*enumerate(texts), *(r for r in AWKWARD if r[0] is not None)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_documents(make_docs([*rows, (None, texts[0])])).collect()}
    assert found.pop(None) == (len(shingles(texts[0])), None)
    assert found == components_by_brute_force(rows)


def test_groups_that_pivots_miss_are_found_by_the_matrix(make_docs, monkeypatch):
    """Without any pivot, every link has to come from opened groups."""
    rows = list(enumerate(near_copies(7, families=3)))
    monkeypatch.setattr(jaccard_join, "_pivots", lambda sets: sets.selectExpr("rep AS a", "rep AS b", "0 AS agree").limit(0))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_documents(make_docs(rows)).collect()}
    assert found == components_by_brute_force(rows)


@pytest.mark.parametrize("parts", [(1, 1), (3, 2)])
def test_parts_and_loose_groups_change_nothing(make_docs, monkeypatch, parts):
    """Tiny parts; and groups of sets that agree in a single minimum, of which most members are not linked."""
    monkeypatch.setattr(jaccard_join, "QUERIES", parts[0])
    monkeypatch.setattr(jaccard_join, "MEMBERS", parts[1])
    monkeypatch.setattr(jaccard_join, "AGREE", 1)
    monkeypatch.setattr(jaccard_join, "MOST_WANTED", 0)
    rows = list(enumerate(near_copies(12, families=3)))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_documents(make_docs(rows)).collect()}
    assert found == components_by_brute_force(rows)


def test_products_give_the_forest_of_all_links():
    rng = np.random.default_rng(2)
    base = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(4)]
    sides = []
    for first in (0, 100):
        sides.append([(first + i, np.sort(rng.choice(base[i % 4], len(base[i % 4]) - rng.integers(0, 4), replace=False))) for i in range(30)])
    for columns in (7, 4096):
        a, b = jaccard_join.link_sets(*sides, 80, columns)
        root = dict(zip(a.tolist(), b.tolist(), strict=True))
        label = {i: i for side in sides for i, _ in side}
        while True:
            before = dict(label)
            for i, x in sides[0]:
                for j, y in sides[1]:
                    both = len(np.intersect1d(x, y))
                    if 100 * both >= 80 * (len(x) + len(y) - both):
                        label[i] = label[j] = min(label[i], label[j])
            if label == before:
                break
        assert {i: root.get(i, i) for i in label} == label
    assert all(len(c) == 0 for c in jaccard_join.link_sets([], sides[1], 80))


def test_rows_of_one_id_are_one_document(make_docs):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    docs = make_docs([(1, a), (2, a), (2, b), (3, b), (3, b), (4, "alone")])
    assert {(r.doc_id, r.component_id) for r in jaccard_join.similar_documents(docs).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}
    kept = jaccard_join.keep_one_each(docs.unionByName(make_docs([(None, a), (5, None), (6, ""), (7, "twice"), (7, "twice")]))).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept if r.text is not None) == [(0, a), (1, a), (4, "alone"), (6, ""), (7, "twice")]
    assert [r.doc_id for r in kept if r.text is None] == [5] and kept[0].score == "x"


def test_frequent_tokens_go_last_and_prefixes_keep_their_length():
    tokens = np.array([3, 5, 8, 9, 12, 20, 30, 31, 32, 40], np.uint64)
    assert jaccard_join.prefix(tokens, (np.zeros(0, np.uint64), np.zeros(0, np.int64)), 80).tolist() == [3, 5, 8, 9, 12]
    frequent = (np.array([3, 5, 8, 9, 12, 20], np.uint64), np.array([9, 2, 4, 4, 7, 1]))
    assert jaccard_join.prefix(tokens, frequent, 80).tolist() == [30, 31, 32, 40, 20]


def test_fingerprints_follow_the_texts(make_docs):
    texts = {i: t for i, t in enumerate([*random_texts(8, 30), "", "ab", "abc", "é", "x" * 2_500_000, "same", "same"])}
    rows = list(texts.items())
    random.Random(1).shuffle(rows)
    found = {r.doc_id: r for r in fingerprint.fingerprint_documents(make_docs([(i, t or None) for i, t in rows]), bytes_per_part=1000).collect()}
    assert len(found) == len(rows)
    for i, text in texts.items():
        following = texts[(i + 1) % len(texts)]
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fingerprint.digest(text.encode()) and r.edited_fingerprint == fingerprint.digest(edited.encode())
        assert r.near_next == fingerprint.likeness(r.fingerprint, found[(i + 1) % len(texts)].fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_a_digest_counts_every_triplet_once_across_pieces():
    data = np.random.default_rng(3).integers(0, 255, (1 << 20) + 500, dtype=np.uint8)
    whole = fingerprint.bucket_counts(data)
    assert whole.sum() == sum(len(data) - j for _, _, j in fingerprint.TRIPLETS)
    ordered = np.sort(whole)
    codes = sum((whole > ordered[256 * q // 4 - 1]).astype(int) for q in (1, 2, 3))
    packed = bytes.fromhex(fingerprint.digest(data.tobytes()))[4:]
    assert [packed[i // 4] >> 2 * (i % 4) & 3 for i in range(256)] == codes.tolist()


def test_likeness_is_bounded_and_symmetric():
    a, b = "ff00ff00" + "00" * 64, "00ff00ff" + "ff" * 64
    assert fingerprint.likeness(a, a) == 1 and fingerprint.likeness(a, b) == fingerprint.likeness(b, a) == 0


def test_fingerprints_of_repeated_and_null_ids(make_docs):
    found = fingerprint.fingerprint_documents(make_docs([(None, "n"), (1, "a"), (1, "b"), (2, "cc")])).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in found) == [(0, 1), (1, 1), (1, 1), (2, 2)]
    assert len(fingerprint.fingerprint_documents(make_docs([(7, "only one")])).collect()) == 1


def test_windows_hashed_in_pieces_are_the_same(monkeypatch):
    from curbside.llm import words

    texts = pa.array(["a b c d e f " * 40, None, "one two three", "x y z " * 90])
    whole = [words.Words(texts).windows(5, which) for which in (0, 1)]
    monkeypatch.setattr(words, "PIECE_WORDS", 7)
    monkeypatch.setattr(words, "PIECE_BYTES", 16)
    for (starts, hashes), which in zip(whole, (0, 1), strict=True):
        again = words.Words(texts).windows(5, which)
        assert (again[0] == starts).all() and (again[1] == hashes).all() and len(starts) == 236 + 266
    words.Words(texts).windows(300)  # wider than any row


def test_merged_rows_leave_a_batch_in_parts(monkeypatch):
    monkeypatch.setattr(substring_dedup, "ROWS", 2)
    rows = {"id": [1, 1, 2, 3, 4], "key": [9, 9, 5, 6, 7], "text": ["a", "a", "b", "c", "d"]}
    out = list(substring_dedup._merge(iter([pa.RecordBatch.from_pydict(rows)])))
    assert [b.num_rows for b in out] == [2, 2]
    assert sorted((r["id"], r["times"]) for b in out for r in b.to_pylist()) == [(1, 2), (2, 1), (3, 1), (4, 1)]
