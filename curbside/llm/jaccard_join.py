"""Near-duplicate documents by a Jaccard join of word n-gram sets over a token-group matrix.

1. Documents with equal sets are one set. Sets whose minima agree under most of several hash functions form groups. Any
   grouping would give the same result.
2. The token-group matrix holds, for each token, the groups in whose union it stands. Only tokens of prefixes matter: in any
   order of all tokens, sets with a similarity of at least t share some of their first n - ceil(t n) + EXTRA tokens, at
   least EXTRA of them. The order is rare first, so that passages which very many documents share come last.
3. A set's overlap with a group's union bounds its overlap with every member. Groups that reach the bound are opened: the
   whole texts of queries and members come together in parts, and a matrix product gives all overlaps of a part, from
   which only a spanning forest of the links goes out. A group is opened for its own members, too, except
   for those that a comparison with few pivots has linked already.

No candidate is dropped except by these bounds, so that the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.components import components, forest
from curbside.llm.storage import stage
from curbside.operators.lookup import broadcast_if
from curbside.llm.words import Words, mix, slices

#: Words in a shingle, hash functions for grouping, tokens by which prefixes are longer than they must be.
SHINGLE, FUNCTIONS, EXTRA = 5, 8, 3

#: A token seen so often among so many tokens of one task is reported as frequent; the most frequent are kept, up to a
#: number that bounds the broadcast. They only move to the end of the order, which changes no result.
OFTEN, AMONG, MOST_FREQUENT = 2, 3_000_000, 1 << 20

#: Of FUNCTIONS minima so many agree within a group; pivots tried for each set; queries and members in a part; and the
#: most rows of wanted documents that are broadcast to the texts instead of shuffling these.
AGREE, TRIED, QUERIES, MEMBERS, MOST_WANTED = 5, 2, 256, 256, 250_000

_odd = np.random.default_rng(5).integers(1, 2**62, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WHOLE = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending. A text of fewer words is one shingle, an empty one none."""
    words = Words(texts, lower=True)
    starts, hashes = words.windows(width)
    edges = np.searchsorted(starts, words.first)
    sets = []
    for i in range(len(texts)):
        n = words.counts[i]
        if n >= width:
            own = np.sort(hashes[edges[i] : edges[i + 1]])
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            sets.append(own[new])
        elif n:
            one = np.array([n], np.uint64) * WHOLE
            for h in words.hashes[words.first[i] : words.first[i + 1]]:
                one = mix(one ^ h) * WHOLE
            sets.append(one)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


_PROFILE = "doc_id long, n long, s1 long, s2 long, least array<long>, tokens array<long>, counts array<int>"


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document: size, digest and minima of its set; then rows of frequent tokens, without a document."""
    seen: list[np.ndarray] = []
    total = 0
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(part.column(1))
            seen += sets
            total += sum(map(len, sets))
            n = np.array(list(map(len, sets)))
            full = np.flatnonzero(n)
            digests, least = np.zeros((2, len(sets)), np.uint64), np.zeros((len(full), FUNCTIONS), np.uint64)
            if len(full):
                every = np.concatenate(sets)
                edges = np.cumsum(n[full]) - n[full]
                digests[0, full] = np.add.reduceat(every, edges)
                digests[1, full] = np.add.reduceat(mix(every ^ WHOLE), edges)
                for k, odd in enumerate(_odd):
                    least[:, k] = np.minimum.reduceat(every * odd, edges)
            minima = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum((n > 0) * FUNCTIONS)]).astype(np.int32), pa.array(least.ravel().view(np.int64)))
            none = pa.nulls(len(sets), pa.list_(pa.int64())), pa.nulls(len(sets), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *(pa.array(d.view(np.int64)) for d in digests), minima, *none], names=["doc_id", "n", "s1", "s2", "least", "tokens", "counts"])
            if total >= AMONG:
                yield _frequent(seen)
                seen, total = [], 0
    if seen:
        yield _frequent(seen)


def _frequent(sets: list[np.ndarray]) -> pa.RecordBatch:
    every = np.concatenate(sets)
    every.sort()
    edges = np.flatnonzero(np.diff(every, prepend=every[:1] ^ np.uint64(1))) if len(every) else np.zeros(0, np.int64)
    n = np.diff(edges, append=len(every))
    often = n >= OFTEN
    tokens, counts = every[edges[often]].view(np.int64), n[often].astype(np.int32)
    one = [None], [None], [None], [None], [None]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(one, kinds, strict=True)), pa.array([tokens], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int32()))], names=["doc_id", "n", "s1", "s2", "least", "tokens", "counts"])


def similar_documents(docs: DataFrame, percent: int = 80, width: int = SHINGLE) -> DataFrame:
    """``n_shingles`` and ``component_id`` of every row of ``doc_id``, ``text``.

    A set holds the distinct shingles of ``width`` words (A-Z lower-cased; words are maximal runs of bytes other than space
    and 0x09-0x0D) of the whole text; with fewer words, the whole sequence as one; a null text, or one without words, has
    an empty set and links with nothing. Two documents link when 100 * intersection >= ``percent`` * union. The component
    id is the smallest ``doc_id`` reached by links, itself included. Rows with one ``doc_id`` are one document: their
    links add up. A row with a null id links with nothing and has a null component. Other columns are ignored.
    """
    if width != SHINGLE:
        raise ValueError(f"sets are built of {SHINGLE} words")
    profiles = stage(docs.select("doc_id", "text").mapInArrow(_profile, _PROFILE), "profiles")
    rows = profiles.where("n is not null").select("doc_id", "n", "s1", "s2", "least")
    sets = rows.where("n > 0 and doc_id is not null").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.min("least").alias("least"))
    sets = stage(sets, "sets")
    texts = docs.where("doc_id is not null").select("doc_id", "text")

    rated = stage(_pivots(sets), "rated-pivots")
    pivots = rated.select(F.col("b").alias("g"), "b").distinct()
    near = stage(_open(texts, rated.select("a", F.col("b").alias("g")), pivots, percent), "pivot-links")
    likely = rated.where(F.col("agree") >= AGREE).select("a", "b")
    # Groups hang together by likely and by certain links, their parts by certain ones.
    loose, firm = F.lit(0).alias("kind"), F.lit(1).alias("kind")
    both = likely.unionByName(near).select("a", "b", loose).unionByName(near.select("a", "b", firm))
    found = stage(components(both, "kind").withColumnRenamed("node", "rep"), "groups")
    groups = found.where("kind = 0").select("rep", F.col("component").alias("grp"))
    linked = found.where("kind = 1").select("rep", F.col("component").alias("part"))
    members = sets.select("rep", "n").join(groups, "rep", "left").join(linked, "rep", "left")
    members = stage(members.select("rep", "n", F.coalesce("grp", "rep").alias("grp"), F.coalesce("part", "rep").alias("part")), "members")
    sizes = stage(members.groupBy("grp").agg(F.count("*").alias("size")), "sizes")
    members = stage(members.join(sizes, "grp"), "sized-members")
    queries = _stragglers(members).unionByName(_other_groups(texts, members, _order(profiles), percent))
    inside = members.select(F.col("rep").alias("b"), F.col("grp").alias("g"))
    far = stage(_open(texts, queries, inside, percent), "group-links")

    # Rows of one id are one document, also if their sets differ.
    own = rows.where("n > 0 and doc_id is not null").join(sets.select("n", "s1", "s2", "rep"), ["n", "s1", "s2"])
    same = own.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(near.unionByName(far).unionByName(same)).withColumnRenamed("node", "doc_id")
    return rows.join(found, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _pivots(sets: DataFrame) -> DataFrame:
    """For each set those TRIED of its pivots with which most minima agree.

    Under every hash function, the sets of one minimum have one of them as pivot, another one for each function: a set
    that has drifted away from one member of its family is near to others.
    """
    minima = sets.select("rep", F.posexplode("least").alias("i", "minimum"))
    chosen = minima.groupBy("i", "minimum").agg(F.min_by("rep", F.struct(F.xxhash64("rep", "i"), "rep")).alias("pivot"), F.count("*").alias("k"))
    pivots = stage(chosen.where("k > 1").drop("k"), "pivots")
    met = stage(minima.join(pivots, ["i", "minimum"]).where("rep <> pivot").select("rep", "pivot").distinct(), "met-pivots")
    own, other = sets.select("rep", "least"), sets.select(F.col("rep").alias("pivot"), F.col("least").alias("other"))
    agree = F.size(F.filter(F.zip_with("least", "other", lambda x, y: x == y), lambda e: e))
    rated = met.join(own, "rep").join(other, "pivot").select("rep", F.struct(-agree, "pivot").alias("rated"))
    best = rated.groupBy("rep").agg(F.slice(F.sort_array(F.collect_list("rated")), 1, TRIED).alias("best"))  # FUNCTIONS at most
    return best.select(F.col("rep").alias("a"), F.explode("best").alias("x")).select("a", F.col("x.pivot").alias("b"), (-F.col("x.col1")).alias("agree"))


def _stragglers(members: DataFrame) -> DataFrame:
    """Members that are not linked to the largest linked part of their group, as queries for it."""
    parts = stage(members.groupBy("grp", "part").agg(F.count("*").alias("k")), "group-parts")
    main = parts.groupBy("grp").agg(F.max_by("part", F.struct("k", "part")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    return members.join(main, "grp").where("part <> main").select(F.col("rep").alias("a"), F.col("grp").alias("g"))


def _order(profiles: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent tokens, ascending, and how often each was reported: at most MOST_FREQUENT."""
    pairs = profiles.where("tokens is not null").select(F.explode(F.arrays_zip("tokens", "counts")).alias("x"))
    counts = stage(pairs.groupBy("x.tokens").agg(F.sum("x.counts").alias("seen")), "frequent")
    # Counts are grouped by their logarithm: a handful of rows shows from which count on the table is small enough.
    level = F.floor(F.log2("seen") * 8)
    least, held = None, 0
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        held += r["count"]
        if held > MOST_FREQUENT:
            break
        least = r.level
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kept = counts.where(level >= least).toArrow()
    tokens = kept.column("tokens").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], kept.column("seen").to_numpy()[order]


def prefix(tokens: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray:
    """The first tokens of a set, given ascending: unreported ones by hash, then by how often they were reported."""
    n = len(tokens)
    length = min(n, n - -(-percent * n // 100) + EXTRA)
    if not len(frequent[0]):
        return tokens[:length]
    at = np.minimum(np.searchsorted(frequent[0], tokens), len(frequent[0]) - 1)
    hit = frequent[0][at] == tokens
    rare = tokens[~hit]
    if len(rare) >= length:
        return rare[:length]
    often, seen = tokens[hit], frequent[1][at[hit]]
    return np.concatenate([rare, often[np.lexsort((often, seen))][: length - len(rare)]])


def _other_groups(texts: DataFrame, members: DataFrame, order: tuple, percent: int) -> DataFrame:
    """Sets and the other groups whose unions reach the bound."""
    spec = texts.sparkSession.sparkContext.broadcast(order)  # at most MOST_FREQUENT tokens

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [prefix(s, spec.value, percent) for s in shingle_sets(part.column(1))]
                ids = np.repeat(part.column(0).to_numpy(), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(ids)], names=["token", "doc_id"])

    prefixes = stage(texts.mapInArrow(tokens, "token long, doc_id long"), "prefixes")
    shared = stage(prefixes.groupBy("token").count().where("count > 1").select("token"), "shared-tokens")
    prefixes = prefixes.join(shared, "token", "left_semi")
    # Of documents with equal sets only the one that stands for them goes on.
    held = prefixes.join(members, prefixes.doc_id == members.rep).select("token", "rep", "n", "grp", "size").distinct()
    held = stage(held, "held-tokens")
    mixed = stage(held.groupBy("token").agg(F.min("grp").alias("p"), F.max("grp").alias("q")).where("p < q").select("token"), "mixed-tokens")
    held = stage(held.join(mixed, "token", "left_semi"), "open-tokens")
    matrix = stage(held.select("token", F.col("grp").alias("g"), F.col("size").alias("of")).distinct(), "token-groups")
    # Of two groups the smaller one asks: a member of either has met the other.
    overlaps = held.join(matrix, "token").where("size < of or (size = of and grp < g)").groupBy("rep", "g", "n").count()
    need = F.least(F.lit(EXTRA), F.ceil(F.col("n") * percent / 100))
    return overlaps.where(F.col("count") >= need).select(F.col("rep").alias("a"), "g")


def _open(texts: DataFrame, queries: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links (``a``, ``b``) between queries (``a``) of groups (``g``) and these groups' members (``b``), as a forest.

    Queries and members of a group are dealt into parts; each part of queries meets each part of members once.
    """
    queries, members = stage(queries.distinct(), "queries"), stage(members, "opened-members")
    parts = lambda df, size, name: df.groupBy("g").agg(F.ceil(F.count("*") / size).alias(name))
    sizes = stage(parts(queries, QUERIES, "qs").join(parts(members, MEMBERS, "ms"), "g"), "group-sizes")
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    asked = queries.join(sizes, "g").select(F.col("a").alias("doc_id"), "g", own("a", "qs").alias("q"), every("ms").alias("m"), F.lit(0).alias("side"))
    held = members.join(sizes, "g").select(F.col("b").alias("doc_id"), "g", every("qs").alias("q"), own("b", "ms").alias("m"), F.lit(1).alias("side"))
    wanted = stage(asked.unionByName(held), "wanted")
    found = texts.join(broadcast_if(wanted.count() <= MOST_WANTED, wanted), "doc_id")
    tasks = found.repartition("g", "q", "m").sortWithinPartitions("g", "q", "m", "side")
    return tasks.select("g", "q", "m", "side", "doc_id", "text").mapInArrow(_compare(percent), "a long, b long").distinct()


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, ([], [])
        for batch in batches:
            for part in slices(batch, "text"):
                links: list[tuple[np.ndarray, np.ndarray]] = []
                for *own, side, doc_id, s in zip(*(part.column(i).to_pylist() for i in range(5)), shingle_sets(part.column(5)), strict=True):
                    if own != key or side and len(sides[1]) >= 2 * MEMBERS:
                        links.append(link_sets(*sides, percent))
                        key, sides = own, (sides[0] if own == key else [], [])
                    sides[side].append((doc_id, s))
                yield _pairs(links)
        yield _pairs([link_sets(*sides, percent)])

    return run


def _pairs(links: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*links, strict=True)] if links else [np.zeros(0, np.int64)] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])


def link_sets(queries: list, members: list, percent: int, columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """(id, set) of queries and members to a spanning forest of their links, by products of incidence matrices."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not queries or not members:
        return nothing
    sizes = [np.array([len(s) for _, s in side]) for side in (queries, members)]
    if len(queries) == len(members) == 1:
        both = np.array([[np.intersect1d(queries[0][1], members[0][1], assume_unique=True).size]])
    else:
        flat = [np.concatenate([s for _, s in side]) for side in (queries, members)]
        common = np.intersect1d(*flat)
        both = np.zeros((len(queries), len(members)), np.float32)
        where = []
        for tokens, n in zip(flat, sizes, strict=True):
            at = np.searchsorted(common, tokens)
            hit = np.flatnonzero((at < len(common)) & (common[np.minimum(at, max(0, len(common) - 1))] == tokens)) if len(common) else np.zeros(0, np.int64)
            where.append((np.repeat(np.arange(len(n)), n)[hit], at[hit]))
        for low in range(0, len(common), columns):
            blocks = []
            for (row, at), n in zip(where, sizes, strict=True):
                block = np.zeros((len(n), min(columns, len(common) - low)), np.float32)
                mine = (at >= low) & (at < low + columns)
                block[row[mine], at[mine] - low] = 1
                blocks.append(block)
            both += blocks[0] @ blocks[1].T
    links = (both > 0) & (100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both))
    ids = [np.array([i for i, _ in side], np.int64) for side in (queries, members)]
    every = np.concatenate(ids)
    root = forest(links, *ids)
    keep = every != root
    return every[keep], root[keep]


def keep_one_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each component: that with the component's id, of several rows with this id the smallest.

    Rows with a null id link with nothing and stay.
    """
    found = similar_documents(docs, percent).where("doc_id is not null")
    ids = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("n"))
    ids = stage(ids.where("doc_id <> component_id or n > 1"), "other-ids")  # most documents are alone
    small = ids.count() <= MOST_WANTED
    rest = docs.join(broadcast_if(small, ids.select("doc_id")), "doc_id", "left_anti")
    several = docs.join(broadcast_if(small, ids.where("doc_id = component_id").select("doc_id")), "doc_id", "left_semi")
    several = several.groupBy(F.col("doc_id").alias("id")).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return rest.select(docs.columns).unionByName(several)
