"""Url rules, language identification and toxicity."""

import random
import re
from collections import Counter
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curbside.llm import bpe, language_id, storage, toxicity, url_filter
from curbside.llm.queries import RULES
from curbside.llm.storage import held_out

URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "http://a.b.example.org/es/", "http://example.org/es", "http://example.org/en/1", "http://example.org/en/12?q=/es/",
    "http://example.org/en/2", "http://example.org", "http://example.org?x", "https://notexample.org/es/", "http://com/fr/", "http://x.com/fr/#top", "http://x.com/de/#/fr/", "http://x.com/de",
    "http://x.com#/de/", "http://org.net/x", "http://x.com:80/fr/", "ftp://a://b.org/x", "http://É.ORG/ÉS/", "http://x..org//", "http://a." * 500 + "org/x", "http://x.org/" + "é" * 100_000,
]


def judged(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1].split("?")[0].split("#")[0]
    host, slash, path = rest.partition("/")
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path
    best = None
    for verdict, rule in rules:
        rule_host, _, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best and best[1], best[0] if best else default


def test_urls_are_judged_as_by_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x", "y", 1) for i, u in enumerate(URLS)] + [(0, None, "x", "y", 1), (None, URLS[4], "x", "y", 1)], "page_id long, url string, host string, rule string, keys int")
    found = url_filter.judge_urls(pages, url_filter.build_index(spark, RULES)).collect()
    assert len(found) == len(URLS) + 2
    for r in found:
        url = URLS[r.page_id] if r.page_id is not None else URLS[4]
        assert (r.host, r.path, r.rule, r.verdict) == judged(url, RULES), url


def test_empty_rules_and_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert url_filter.judge_urls(pages, url_filter.build_index(spark, [])).first().verdict == "allow"
    assert url_filter.judge_urls(pages.limit(0), url_filter.build_index(spark, RULES)).collect() == []
    with pytest.raises(ValueError, match="not a rule"):
        url_filter.build_index(spark, [("deny", "a/")])
    index = url_filter.build_index(spark, [("allow", "a.org/"), ("block", "a.org/"), ("block", "a.org/")])
    assert url_filter.judge_urls(pages, index).first().verdict == "block"


def test_a_colliding_key_does_not_decide():
    texts = [b"one/", b"two/"]
    keys, ends = np.array([7, 7], np.uint64), np.array([0, 4, 8])
    stored = np.frombuffer(b"".join(texts), np.uint8)
    names = pa.array([["two/"], ["three/"], [], ["one/", "two/"]])
    hashed = pa.array([[7], [7], [], [7, 9]], pa.list_(pa.int64()))
    assert url_filter.confirm(names, hashed, keys, ends, stored).tolist() == [1, -1, -1, 0]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return language_id.fit(docs, ~held_out(F.col("doc_id")))


def test_held_out_documents_are_recognised(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(held_out(F.col("doc_id")))
    found = language_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    right, n, low, high = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 200 and right / n >= 0.98 and 0 <= low <= high <= 1


def test_texts_without_letters_have_no_language(make_docs, model):
    rows = [(1, None), (2, ""), (3, " 12 !? \n"), (4, "the of and that was for it with"), (None, "the of and that was for it with"), (4, "the of and that was for it with"), (5, "x" * 3_000_000)]
    found = language_id.predict(make_docs(rows), model).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in found)[:7][1:4] == [(1, "und"), (2, "und"), (3, "und")]
    same = {(r.lang_pred, round(r.score, 5)) for r in found if r.doc_id in (4, None)}
    assert len(found) == 7 and len(same) == 1 and all(r.score == 0 for r in found if r.lang_pred == "und")
    assert language_id.predict(make_docs([]), model).collect() == []


def test_nothing_to_learn_from(make_docs):
    untaught = language_id.fit(make_docs([(1, "text"), (2, None)], [None, "en"]), F.lit(True))
    assert [r.lang_pred for r in language_id.predict(make_docs([(1, "text")]), untaught).collect()] == ["und"]


def test_the_kernel_counts_common_grams():
    a, b = (set(language_id.distinct_codes(np.frombuffer(t, np.uint8)).tolist()) for t in (b"Abc1", b"abd2"))
    text = lambda t: {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    assert len(a & b) == len(text("abc ") & text("abd ")) and len(a) == len(text("abc "))
    long = np.random.default_rng(1).integers(97, 100, (1 << 20) + 99, dtype=np.uint8)
    assert set(language_id.distinct_codes(long).tolist()) == set(np.unique(language_id.gram_codes(long)).tolist())


def test_labels_and_languages_of_held_out_rows_teach_nothing(make_docs):
    rows = [(i, f"wort{i % 7} und das ist ein text nummer {i}") for i in range(60)]
    langs = ["de" if i % 3 else "xx" for i in range(60)]
    learned = language_id.fit(make_docs(rows, langs), F.col("lang") == "de")
    assert learned.languages == ("de",)


def index_of(rng, terms=40, examples=300, neighbours=7):
    sparse = []
    for _ in range(examples):
        own = np.sort(rng.choice(terms, rng.integers(0, 6), replace=False))
        sparse.append((own, rng.integers(1, 5, len(own)).astype(float)))
    names = np.sort(rng.integers(0, 2**60, terms, dtype=np.uint64))
    toxic = rng.integers(0, 2, examples)
    seen = np.array([sum(t in s for s, _ in sparse) for t in range(terms)])
    return toxicity.build_index(names, seen, sparse, np.arange(examples), toxic, {0: 900, 1: 100}, neighbours), sparse


@pytest.mark.parametrize("postings", [1 << 20, 1])
def test_neighbours_are_exact(monkeypatch, postings):
    monkeypatch.setattr(toxicity, "POSTINGS", postings)
    rng = np.random.default_rng(11)
    index, sparse = index_of(rng)
    vector = lambda t, c: (lambda v: v / np.sqrt((v**2).sum()))(np.bincount(t, (1 + np.log(c)) * index.idf[t], len(index.terms)))
    all_vectors = {int(i): vector(*sparse[i]) for i in index.ids}
    for _ in range(200):
        terms = np.sort(rng.choice(len(index.terms), rng.integers(1, 6), replace=False))
        counts = rng.integers(1, 5, len(terms)).astype(float)
        query = vector(terms, counts)
        places, cosines = index.nearest(terms, counts)
        best = sorted((query @ v for v in all_vectors.values() if query @ v > 1e-12), reverse=True)[: index.neighbours]
        assert np.allclose(cosines, best) and np.allclose(cosines, [query @ all_vectors[int(i)] for i in index.ids[places]])


def test_scores_lie_in_bounds_and_rise_with_votes():
    index, _ = index_of(np.random.default_rng(12))
    assert (np.diff(index.raw) >= 0).all() and (np.diff(index.calibrated) >= 0).all() and 0 <= index.calibrated.min() <= index.calibrated.max() <= 1
    assert index.score(np.zeros(0, np.int64), np.zeros(0))[0] == index.without < 0.7


@pytest.fixture(scope="module")
def judged_docs(make_docs, spark):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        words = [f"{rnd.choice('abcdefgh')}{rnd.choice('aeiou')}{rnd.choice('klmn')}{rnd.choice('aeiou')}" for _ in range(60)]
        if bad := i % 5 == 0:
            for _ in range(3):
                words[rnd.randrange(60)] = "gruesome" + rnd.choice(["ly", "ness", "ish", "est"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    labels += [(None, 1, 1), (5, None, None), (0, 1, 0), (9999, 1, 1), (3, 1, 7)]
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_texts_are_found_with_evidence(judged_docs, make_docs):
    docs, labels = judged_docs
    index = toxicity.fit(docs, labels, F.col("doc_id") % 3 != 1)
    found = {r.doc_id: r for r in toxicity.score_texts(docs, index).collect()}
    unseen = [i for i in found if i % 3 == 1]
    assert all((found[i].score >= 0.7) == (i % 5 == 0) for i in unseen)
    toxic = next(i for i in unseen if i % 5 == 0)
    assert found[toxic].evidence and all(e % 3 != 1 for e in found[toxic].evidence) and found[toxic].cosines == sorted(found[toxic].cosines, reverse=True)
    odd = [(1, None), (2, ""), (3, "gruesomely gruesomeness gruesomeish"), (None, "gruesomely gruesomeness gruesomeish"), (4, "na " * 500_000)]
    scores = [(r.doc_id, r.score) for r in toxicity.score_texts(make_docs(odd), index).collect()]
    assert [s >= 0.7 for _, s in sorted(scores, key=lambda x: x[0] or 9)] == [False, False, True, False, True]
    assert toxicity.score_texts(make_docs([]), index).collect() == []


def test_texts_inside_whole_rows_score_alike(judged_docs, make_docs):
    docs, labels = judged_docs
    index = toxicity.fit(docs, labels, F.col("doc_id") % 3 != 1)
    some = docs.limit(40).unionByName(make_docs([(1, None), (None, ""), (2, "gruesomely gruesomeness gruesomeish")]).select(docs.columns))
    some = some.withColumn("score", F.lit("an extra column of a clashing name"))
    rows = toxicity.score_texts(storage.whole_rows(some), index, "row", "row.text").collect()
    key = lambda r: (str(r[0]), r[1])
    plain = toxicity.score_texts(some, index).collect()
    assert sorted(((r.row.doc_id, r.score) for r in rows), key=key) == sorted(((r.doc_id, r.score) for r in plain), key=key)
    assert {r.row.score for r in rows} == {"an extra column of a clashing name"} and len(rows) == 43


def test_caches_of_earlier_stages_are_dropped():
    made = []
    cached = storage.kept_by_workers(lru_cache(maxsize=2)(lambda x: made.append(x) or x))
    cached(1), cached(1), storage.release_caches(), cached(1)
    assert made == [1, 1]
    assert {bpe.codec, bpe.word_ids, bpe.word_streams} <= set(storage._caches)
    storage._caches.remove(cached)


def test_free_memory_of_arrays_is_handed_back():
    held = lambda: int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()).group(1)) >> 10
    arrays = [np.ones(1 << 12) for _ in range(4000)]  # 32 KB each: too small for memory of their own
    last, full = arrays[-1], held()
    del arrays  # the last one keeps the heap from shrinking by itself
    storage.hand_back()
    assert len(last) and held() < full - 80


def test_toxicity_without_labels_or_examples(judged_docs, make_docs):
    docs, labels = judged_docs
    for index in (toxicity.fit(docs, labels.limit(0), F.lit(True)), toxicity.fit(make_docs([]), labels, F.lit(True)), toxicity.fit(docs, labels.where("toxic = 0"), F.lit(True))):
        assert all(0 <= r.score < 0.7 for r in toxicity.score_texts(docs.limit(5), index).collect())


def test_every_word_counts_in_the_cosines(spark, make_docs):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdeiou") for _ in range(rnd.randrange(1, 9)))
    words = [word() for _ in range(150)]
    texts = [" ".join(rnd.choices(words, k=30) + [word() for _ in range(3)]) for _ in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 > 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    learnable = [t for i, t in enumerate(texts) if i % 3 != 1]
    index = toxicity.fit(make_docs([*enumerate(texts)]), labels, F.col("doc_id") % 3 != 1)

    terms = lambda text: Counter(t for w in text.split() for t in [w, *((w[:n], "...") for n in (4, 5, 6) if len(w) > n)])
    seen = Counter(t for text in learnable for t in terms(text))
    examples = {i: terms(texts[i]) for i in range(60) if i % 3 != 1}
    known = {t for e in examples.values() for t in e}  # of other words, no count is at hand
    held = lambda t: 1 + (seen[t] if t in known else 0)
    idf = lambda t: np.log((1 + len(learnable)) / held(t)) * held(t) / (held(t) + 0.005 * len(learnable))
    weigh = lambda found: {t: (1 + np.log(c)) * idf(t) for t, c in found.items()}
    length = lambda v: np.sqrt(sum(x * x for x in v.values()))
    for r in toxicity.score_texts(make_docs([*enumerate(texts)]), index).collect():
        v = weigh(terms(texts[r.doc_id]))
        near = {i: sum(x * w.get(t, 0) for t, x in v.items()) / length(v) / length(w) for i, w in ((i, weigh(e)) for i, e in examples.items())}
        assert np.allclose(r.cosines, sorted(near.values(), reverse=True)[:30]) and np.allclose(r.cosines, [near[i] for i in r.evidence])
    nothing = toxicity.score_texts(make_docs([(1, ""), (2, "zzzz")]), index).collect()
    share = np.mean([i % 4 > 0 for i in examples])
    assert all(np.isclose(r.score, share) and not r.evidence for r in nothing)  # what is known of any text


def test_few_telling_words_decide_among_many_others(spark, make_docs):
    rnd = random.Random(21)
    plain = ["".join(rnd.choice("abcdeiou") for _ in range(rnd.randrange(3, 9))) for _ in range(600)]
    slurs = ["grime", "vermin", "scab", "louse", "filth", "maggot", "blight", "sewer", "mildew", "rot"]
    often = [1 / (i + 10) for i in range(600)]
    texts = [rnd.choices(plain, often, k=250) + (rnd.sample(slurs, 3) if i % 9 == 0 else []) for i in range(900)]
    docs = make_docs([(i, " ".join(rnd.sample(words, len(words)))) for i, words in enumerate(texts)])
    labels = spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(900)], "doc_id long, quality int, toxic int")
    index = toxicity.fit(docs, labels, F.col("doc_id") % 2 == 0)
    score = {r.doc_id: r.score for r in toxicity.score_texts(docs, index).collect() if r.doc_id % 2}
    caught, flagged = (np.mean([s >= 0.7 for i, s in score.items() if (i % 9 == 0) == bad]) for bad in (True, False))
    assert caught >= 0.9 and flagged <= 0.02


def test_votes_weigh_the_telling_part_of_each_cosine():
    rng = np.random.default_rng(13)
    index, sparse = index_of(rng, terms=12)
    held = lambda i, t: t in sparse[i][0]

    def telling(t, but=None):
        rows = [j for j in range(len(index.ids)) if j != but]
        number = [sum(index.toxic[j] == k for j in rows) for k in (0, 1)]
        share = [sum(index.toxic[j] == k and held(int(index.ids[j]), t) for j in rows) / number[k] for k in (0, 1)]
        return max(0, 2 * abs(share[1] - share[0]) / (sum(share) + toxicity.UNSURE / min(number)) - 1)

    weigh = lambda t, c: dict(zip(t.tolist(), ((1 + np.log(c)) * index.idf[t]).tolist(), strict=True))
    length = lambda v: np.sqrt(sum(x * x for x in v.values()))
    object.__setattr__(index, "toxic", np.array([int(held(int(i), 3) or held(int(i), 7)) for i in index.ids]))
    counts = np.stack([np.array([sum(index.toxic[j] == k and held(int(i), t) for j, i in enumerate(index.ids)) for t in range(12)] + [(index.toxic == k).sum()]) for k in (0, 1)])
    object.__setattr__(index, "held", counts)
    object.__setattr__(index, "telling", toxicity.telling_of(counts[:, :-1], counts[:, -1]))
    assert index.telling[[3, 7]].min() > 0.2 > index.telling[[0, 1, 2]].max()
    for place in [*range(0, len(index.ids), 20), -1]:
        terms, times = sparse[int(index.ids[place])]
        (places, cosines, told), but = next(index.nearest_to_each(np.array([0, len(terms)]), terms, times, np.zeros(1), np.array([place]))), place if place >= 0 else None
        own = weigh(terms, times)
        for at, cosine, part in zip(places, cosines, told, strict=True):
            other = weigh(*sparse[int(index.ids[at])])
            parts = {t: x * other[t] / length(own) / length(other) for t, x in own.items() if t in other}
            assert np.isclose(sum(parts.values()), cosine) and np.isclose(sum(x * telling(t, but) for t, x in parts.items()), part)


def test_postings_are_added_up_in_bounded_runs(monkeypatch):
    index, sparse = index_of(np.random.default_rng(14), terms=400, examples=900)
    sizes, ranges = [], toxicity._ranges
    monkeypatch.setattr(toxicity, "POSTINGS", 16)
    monkeypatch.setattr(toxicity, "_ranges", lambda low, high: sizes.append(int((high - low).sum())) or ranges(low, high))
    longest = int(np.diff(index.starts).max())
    terms = np.arange(400)
    places, cosines = index.nearest(terms, np.ones(400))
    assert len(sizes) > 20 and max(sizes) <= max(16, longest) and len(places) == 7
    monkeypatch.setattr(toxicity, "POSTINGS", 1 << 20)
    assert index.nearest(terms, np.ones(400))[0].tolist() == places.tolist()
