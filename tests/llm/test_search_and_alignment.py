"""Cross-tokenizer alignment, ranked search and decontamination against brute force and SQL."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from curbside.llm import cross_tokenizer, decontamination, lexical_search, oracle, queries
from curbside.llm.words import Words

SF = "/root/testdata/sf0.001"
NAMES = [public_tokenizers.path(n) for n in queries.ALIGNED]
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\nb", "a \n b", "a\t b ", "word  \n\n  word", "don't  can't 's", "<|endoftext|> <s> </s> <unk>",
    "a▁b", "▁", "x  y", "x  y", "  z", "\x1c \x1d q", "日本語 の テキスト", "é̀ ﬁ ⅷ", "🙂🙂 🙂", "\x00 \x00", "1234 5,678.90", "a" * 500, "ab " * 300, "\u0085 k", "end\r\n start",
]


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


# --- alignment ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def definitions():
    return cross_tokenizer.Definitions.read(*NAMES)


@pytest.fixture(scope="module")
def aligner(definitions):
    return cross_tokenizer.Aligner(definitions)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(NAMES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=NAMES[1])


def aligned_by_brute_force(rows, libraries):
    a_tool, b_tool = libraries
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in visible)}
    entries = {i: t for t, i in a_tool.get_vocab().items()}
    found, held = [], Counter()
    for text in rows:
        raw = f" {text or ''}".encode()
        a = a_tool.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_tool.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in entries[i]) for i in a]
        bytes_b = [bytes([int(b_tool.id_to_piece(i)[3:-1], 16)]) if b_tool.is_byte(i) else b_tool.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            found.append(([], [], [], ""))
            continue
        spans_a, spans_b = ([(sum(map(len, x[:k])), sum(map(len, x[: k + 1]))) for k in range(len(x))] for x in (bytes_a, bytes_b))
        links = [(x, y) for x, (p, q) in zip(a, spans_a, strict=True) for y, (r, s) in zip(b, spans_b, strict=True) if p < s and r < q]
        groups, low = [], 0
        for end in sorted({q for _, q in spans_a} & {q for _, q in spans_b}):
            inside = [",".join(str(i) for i, (p, q) in zip(ids, spans, strict=True) if p >= low and q <= end) for ids, spans in ((a, spans_a), (b, spans_b))]
            groups.append("|".join(inside))
            low = end
        found.append((a, b, links, ";".join(groups)))
        held.update(set(links))
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(len(a), len(b), g.count("|") if a else 0, len(l), sum(held[p] == best[p[0]] for p in l), sum(held[p] for p in l), hashlib.sha256(g.encode()).hexdigest() if g else "") for a, b, l, g in found]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_chunks_give_the_ids_of_whole_texts(aligner, libraries):
    pick = random.Random(5)
    parts = [*ODD, " ", "\n", "\t", "the", "The", "'ll", "ñandú", "x9", "…", "　", "​"]
    texts = ODD + ["".join(pick.choices(parts, k=pick.randint(1, 12))) for _ in range(400)]
    for text in filter(None, texts):
        chunks = cross_tokenizer.CUT.split(f" {text}")
        a, b = aligner.encode(chunks)
        assert "".join(chunks) == f" {text}"
        assert [i for x in a for i in x] == libraries[0].encode(f" {text}", add_special_tokens=False).ids, repr(text)
        if "▁" not in text:  # which the model reads as a space; such texts are judged as a whole
            assert [i for x in b for i in x] == libraries[1].encode(text), repr(text)


def test_same_bytes_on_both_sides(aligner):
    some = np.flatnonzero(aligner.same >= 0)
    assert len(some) > 10_000
    assert all(aligner.bytes_a[i] == aligner.bytes_b[aligner.same[i]] for i in some.tolist())
    held = {x for i, x in enumerate(aligner.bytes_b) if not (aligner.b.is_control(i) or aligner.b.is_unknown(i))}
    assert not any(x in held for x, i in zip(aligner.bytes_a, aligner.same.tolist(), strict=True) if i < 0)


@pytest.mark.parametrize("most_pairs", [1 << 20, 40, 0])
def test_alignment_equals_brute_force(spark, make_docs, definitions, libraries, most_pairs):
    real = [r.text[:400] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(12).collect()]
    texts = [*ODD, None, *real, *real[:3], real[0]]
    docs = make_docs(list(enumerate(texts))).repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in cross_tokenizer.link_counts(docs, definitions, most_pairs=most_pairs).collect()}
    assert [got[i] for i in range(len(texts))] == aligned_by_brute_force(texts, libraries)


def test_alignment_of_repeated_null_and_no_rows(spark, make_docs, definitions, libraries):
    rows = [(None, "one two"), (1, "one two"), (1, "one two"), (2, None)]
    found = cross_tokenizer.link_counts(make_docs(rows), definitions)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected = aligned_by_brute_force([t for _, t in rows], libraries)
    got = sorted(((r.doc_id or 0), *(r[c] for c in COLUMNS)) for r in found.collect())
    assert got == sorted((i or 0, *e) for (i, _), e in zip(rows, expected, strict=True))
    assert cross_tokenizer.link_counts(make_docs([]), definitions).collect() == []


def test_chunks_start_anew_when_many(aligner, monkeypatch):
    monkeypatch.setattr(cross_tokenizer, "CHUNKS", 3)
    chunks = cross_tokenizer.Chunks(aligner)
    for text in ("a b c d e f", "g a", "b h"):
        ids, counts, known = chunks.of([text, None, ""])
        fresh = aligner.align(cross_tokenizer.CUT.split(f" {text}"))
        assert counts.tolist() == [len(ids), 0, 0] and [known.groups[i] for i in ids] == fresh.groups
    assert len(chunks.number) == 4  # of the last two texts


def test_pending_counts_are_whole_when_handed_on_early(aligner, monkeypatch):
    monkeypatch.setattr(cross_tokenizer, "PENDING", 4)
    pending, total = cross_tokenizer.Pending(aligner), Counter()
    some = int(np.flatnonzero(aligner.same >= 0)[0])
    alike = some * aligner.size_b + int(aligner.same[some])
    for codes in ([1, 2, 3], [1, 2, alike], [4, 5, 6], [1, alike]):
        pending.add(np.array(codes))
        if pending.full():
            out = pending.out()
            total.update({(k, c): n for k, c, n in zip(out["kind"], out["code"].tolist(), out["n"].tolist(), strict=True)})
    out = pending.out()
    total.update({(k, c): n for k, c, n in zip(out["kind"], out["code"].tolist(), out["n"].tolist(), strict=True)})
    assert total == {("pair", 1): 3, ("pair", 2): 2, ("pair", 3): 1, ("pair", 4): 1, ("pair", 5): 1, ("pair", 6): 1, ("same", some): 2}


# --- search -------------------------------------------------------------------------------------


def ranked_by_brute_force(docs, items, best):
    held = [(i, terms(t)) for i, t in docs]
    n, words = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = Counter(t for _, x in held for t in set(x))
    by = {}
    for i, t in items:
        by.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in by.items():
        scores = []
        for i, t in held:
            tf = Counter(t)
            m = 50 + 50 * len(t) * n // words if words else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * tf[w] // (1000 * tf[w] + 20 * m)) for w in wanted if tf[w])
            if score > 0:
                scores.append((-score, i is not None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:best])]
    return sorted(out, key=str)


DOCS = [(1, "The cat, the CAT and the dog."), (2, "a cat_dog x9 ñandú"), (3, None), (4, ""), (5, "...!"), (None, "cat dog"), (7, "cat dog"), (7, "cat dog"), (8, "Ñandú ñandú É é"), (9, "dog " * 3000), (6, "cat dog")]
ITEMS = [(10, "cat the dog"), (11, None), (12, "..."), (13, "zebra"), (14, "CAT ñandú x9"), (14, "dog"), (None, "é and a")]


@pytest.mark.parametrize(("best", "part_bytes"), [(50, 1 << 20), (2, 1 << 20), (3, 4)])
def test_ranks_equal_brute_force(spark, make_docs, best, part_bytes):
    items = spark.createDataFrame([(i, t, "x", "y") for i, t in ITEMS], "item_id long, text string, rank string, id string")
    docs = make_docs(DOCS).repartition(4)
    found = lexical_search.rank_documents(docs, items, best=best, part_bytes=part_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == ranked_by_brute_force(DOCS, ITEMS, best)


def test_ranks_of_empty_tables(spark, make_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.rank_documents(make_docs([]), items).collect() == []
    assert lexical_search.rank_documents(make_docs(DOCS), items.limit(0)).collect() == []


def test_best_lists_are_whole_in_any_order(monkeypatch):
    pick = random.Random(3)
    rows = [(pick.randrange(3), pick.randrange(1, 30), True, i) for i in range(3000)]
    lists = lexical_search.BestLists(3, 5)
    lists.room = 40
    for at in range(0, len(rows), 7):
        lists.add(*(np.array(c) for c in zip(*(r for r in rows[at : at + 7] if r[1] >= lists.floor[r[0]]), strict=True)) if any(r[1] >= lists.floor[r[0]] for r in rows[at : at + 7]) else (np.zeros(0, np.int64),) * 4)
    item, score, _, ids = lists.all()
    expected = [r for i in range(3) for r in sorted((r for r in rows if r[0] == i), key=lambda r: (-r[1], r[3]))[:5]]
    assert list(zip(item.tolist(), score.tolist(), ids.tolist(), strict=True)) == [(r[0], r[1], r[3]) for r in expected]


# --- decontamination ----------------------------------------------------------------------------


def leaks_by_brute_force(docs, items, width):
    windows = {}
    for i, t in items:
        w = terms(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, names = terms(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    names |= own
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def leak_rows():
    pick = random.Random(11)
    few = ["the", "of", "Ab", "cd9", "é", "zz"]
    some = lambda n: " ".join(pick.choices(few, k=n))
    items = [(i, some(pick.randint(1, 14))) for i in range(12)] + [(100, None), (101, "-- !"), (102, ""), (9, "the of"), (None, some(6))]
    docs = [(i, some(pick.randint(0, 80))) for i in range(60)]
    docs += [(200, None), (201, ""), (None, items[0][1]), (202, items[1][1].upper().replace(" ", "__")), (203, "ab\n" * 4000), (203, "ab\n" * 4000), (204, items[2][1] + " " + items[3][1])]
    return docs, items


@pytest.mark.parametrize("width", [4, 10])
def test_leaks_equal_brute_force(spark, make_docs, monkeypatch, width):
    docs, items = leak_rows()
    rows = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_hit string")
    index = decontamination.index_items(rows, width)
    found = decontamination.find_leaks(make_docs(docs).repartition(3), index)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = leaks_by_brute_force(docs, items, width)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    clean = {e[0] for e in expected if not e[-1]}
    kept = decontamination.remove_contaminated(make_docs(docs), index)
    assert kept.columns == make_docs(docs).columns and {r.doc_id for r in kept.collect()} == clean


def test_leaks_of_empty_tables(spark, make_docs):
    docs, items = leak_rows()
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontamination.find_leaks(make_docs(docs), decontamination.index_items(none)).collect())
    index = decontamination.index_items(spark.createDataFrame(items, "item_id long, text string"))
    assert decontamination.find_leaks(make_docs([]), index).collect() == []
    assert decontamination.longest_matches(make_docs([]), index).collect() == []


def test_suffix_array_is_in_order():
    pick = np.random.default_rng(1)
    for size, kinds, depth in ((0, 1, 5), (1, 1, 5), (300, 2, 7), (300, 2, 40), (200, 50, 12), (64, 1, 64), (50, 1 << 40, 9)):
        words = pick.integers(0, kinds, size)
        order = decontamination.suffix_array(words, depth).tolist()
        key = [tuple(words[i : i + depth].tolist()) for i in order]
        assert sorted(order) == list(range(size)) and key == sorted(key)


def test_shards_cut_inside_a_text_find_all(monkeypatch):
    """Also a text that is longer than a shard, whose windows stand across the cuts."""
    docs, items = leak_rows()
    monkeypatch.setattr(decontamination, "SHARD_WORDS", 16)
    texts = [t for _, t in docs]
    words = Words(pa.array(texts), lower=True, apart=decontamination.NO_TERM)
    hashes = Words(pa.array([t for _, t in items]), lower=True, apart=decontamination.NO_TERM)
    keep = np.flatnonzero(hashes.counts)
    index = decontamination.ItemIndex("", tuple([*hashes.first[keep].tolist(), len(hashes.hashes)]), tuple(keep.tolist()), 4, int(hashes.counts.max()))
    hit = np.zeros(len(words.hashes), bool)
    for at, shard in decontamination._shards(words, index):
        for low, high, _, width in decontamination._windows(shard, index, hashes.hashes, np.diff(np.array(index.starts))):
            for word in at + shard.word_at[shard.order[low:high]]:
                hit[word : word + width] = True
    got = [int(hit[a:b].sum()) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    assert got == [leaks_by_brute_force([(0, t)], items, 4)[0][2] for t in texts]


def test_longest_matches_equal_brute_force(spark, make_docs):
    docs, items = leak_rows()
    docs = [d for d in docs if d[0] != 203]
    index = decontamination.index_items(spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.item_id, r.item_row, r.item_word): (r.n_words, r.doc_id, r.doc_word) for r in decontamination.longest_matches(make_docs(docs).repartition(3), index).collect()}
    rows = sorted(((i, t) for i, t in items if terms(t)), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    expected = {}
    for k, (item, text) in enumerate(rows):
        w = terms(text)
        for start in range(len(w)):
            found = []
            for i, t in docs:
                d = terms(t)
                for at in range(len(d)):
                    n = 0
                    while start + n < len(w) and at + n < len(d) and w[start + n] == d[at + n]:
                        n += 1
                    if n:
                        found.append((-n, i is not None, i or 0, at, i))
            if found:
                n, _, _, at, i = min(found, key=lambda x: x[:4])
                expected[item, k, start] = (-n, i, at)
    assert got == expected


# --- the registered queries ---------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op12_lexical_search", "op13_decontamination"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    expected = con.sql(oracle.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF).select(expected.columns)
    rows = expected.fetchall()
    assert rows and sorted(map(tuple, got.collect())) == sorted(rows)


def test_alignment_query_has_a_row_for_each_document(spark):
    found = queries.QUERIES["op11_cross_tokenizer"](spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups and r.count_sum >= r.n_links for r in found)


def test_chunks_are_aligned_in_slices_and_kept_between_tasks(monkeypatch):
    import public_tokenizers

    from curbside.llm import cross_tokenizer as ct
    from curbside.llm.storage import release_caches

    definitions = ct.Definitions.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["one two three four", "", None, "zwei drei one, ßü two", "new words here"]
    ids, counts, known = ct.Chunks(ct.Aligner(definitions)).of(texts)
    seen = []
    plain = ct.Aligner.align
    monkeypatch.setattr(ct, "ENCODED", 3)
    monkeypatch.setattr(ct.Aligner, "align", lambda self, chunks: (seen.append(len(chunks)), plain(self, chunks))[1])
    chunks = ct.chunks_of(definitions)
    assert ct.chunks_of(definitions) is chunks
    chunks.of(texts[:1])
    again, many, sliced = chunks.of(texts)
    assert max(seen) == 3 and (again == ids).all() and (many == counts).all()
    assert sliced.groups == known.groups and (sliced.counts == known.counts).all() and (sliced.ok == known.ok).all()
    assert (sliced.codes == known.codes).all() and (sliced.edges == known.edges).all()
    release_caches()
    assert ct.chunks_of(definitions) is not chunks


def test_pending_counts_add_up_over_merges():
    from types import SimpleNamespace

    from curbside.llm import cross_tokenizer as ct

    pairs = ct.Pending(SimpleNamespace(size_a=4, size_b=10, same=np.array([0, 1, 2, 3])))
    pairs.add(np.array([0, 5, 7, 11, 12]))
    pairs._merge()
    pairs.add(np.array([5, 12, 39]))
    out = pairs.out()
    assert list(zip(out["kind"], out["code"].tolist(), out["n"].tolist(), strict=True)) == [("same", 0, 1), ("same", 1, 1), ("pair", 5, 2), ("pair", 7, 1), ("pair", 12, 2), ("pair", 39, 1)]
    assert len(pairs.out()["kind"]) == 0
