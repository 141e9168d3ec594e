"""Similarity join of documents on word n-grams with prefix trees.

Two documents link when the Jaccard similarity of their sets of distinct ``k``-word shingles is at
least ``percent`` / 100; a component holds all documents that links reach.

1. A set whose partner is at least 75 % alike misses at most a quarter of it, so among its shingles
   of smallest hash, a quarter and a tenth of the set, a known number occurs in another document.
   Documents with fewer such shingles are out after one pass (:mod:`repeats`).
2. Equal sets become one class, told by a digest; only the set of one row per class is written, in a
   second pass over the texts. Shingles get one global order: those of one class first (they match
   nothing), the others by frequency (in steps of two where it is low), then by hash. Sets that share
   none of the first ``n - ceil(0.75 n) + 1`` shingles of this order cannot link.
3. Sets that such shared shingles connect form a cluster. Per cluster the ordered sets are stored in
   a prefix tree; a search walks it once per set, counts shared shingles along common paths, and
   leaves a subtree when what remains cannot reach the needed overlap, or when its sets are already
   in the component of the searching set.
4. In a cluster beyond ``BLOCK`` sets only shared shingles of sets of one size class, or of two
   neighbouring ones, connect, as sizes of linked sets differ by a quarter at most; chains over other
   sizes no longer hold it together. What is still larger is compared with its smallest id's set
   first, all at once, then with some of the sets found so; only sets that link with none of them are
   searched against the whole, block by block.

Defined cases: a null or empty text has an empty set and links with nothing; fewer than ``k`` words
make one shingle; rows that repeat an id have a set each, and sets of one id that can have partners
are tied together; a row without id is no link between others, its component is that of an equal set
or else null. Other input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidedesk.llm import hashing
from tidedesk.llm.components import components
from tidedesk.llm.repeats import MAX_BITS, Filter, build_filter, packed_hashes, range_bits, repeated_filter, split_ranges
from tidedesk.session import materialize

#: Sets, and shingles, of a cluster that one task compares with each other.
BLOCK, BLOCK_TOKENS = 500, 600_000
#: Most shingles that are ordered by their frequency (12 bytes each are broadcast); rarer ones are ordered by hash.
FREQUENT = 1 << 20
#: Sets of a large cluster that its others are compared with before the search by blocks.
PIVOTS = 4


def shingle_sets(text: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes sorted within each document, and where each document begins."""
    w = hashing.words(text, lower=True)
    keys, at = hashing.sequences(w, k)
    doc = w.doc[at]
    counts = np.diff(w.first)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        own = []
        for d in short:
            h = np.uint64(counts[d])
            for x in w.hashes[w.first[d]:w.first[d + 1]]:
                h = hashing.mix(np.array([h ^ x], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]
            own.append(h)
        keys, doc = np.concatenate([keys, np.array(own, np.uint64)]), np.concatenate([doc, short])
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    keys, doc = keys[new], doc[new]
    return keys, np.searchsorted(doc, np.arange(len(counts) + 1))


def missing(n: np.ndarray | int, percent: int = 75):
    """How many shingles of a set of ``n`` a partner may lack."""
    return n * (100 - percent) // 100


def sure(n):
    """How many further shingles of smallest hash are looked at."""
    return np.maximum(1, -(-n // 10))


def low_keys(text: pa.Array, k: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document the shingles of smallest hash that decide whether it can have a partner, mixed again so that
    they spread evenly over the ranges of the filter."""
    keys, first = shingle_sets(text, k)
    n = np.diff(first)
    take = np.minimum(n, missing(n, percent) + sure(n))
    doc = np.repeat(np.arange(len(n)), n)
    low = np.arange(len(keys)) - first[doc] < take[doc]
    return hashing.mix(keys[low]), doc[low]


def document_sets(docs: DataFrame, seen: Filter, k: int, percent: int) -> DataFrame:
    """``doc_id, text_hash, n, sig`` of every row; ``sig``, a digest of the set, is null where no partner is possible."""
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for at, stop in hashing.slices(batch.column(2)):
                keys, first = shingle_sets(batch.column(2).slice(at, stop - at), k)
                n = np.diff(first)
                doc = np.repeat(np.arange(len(n)), n)
                low = np.arange(len(keys)) - first[doc] < np.minimum(n, missing(n, percent) + sure(n))[doc]
                hits = np.bincount(doc[low], weights=known.has(hashing.mix(keys[low])), minlength=len(n))
                least = sure(-(-n * percent // 100))  # of the smallest partner
                sig = [hashlib.blake2b(keys[first[i]:first[i + 1]].tobytes(), digest_size=16).digest()
                       if n[i] and hits[i] >= min(least[i], n[i]) else None for i in range(len(n))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, stop - at), batch.column(1).slice(at, stop - at), pa.array(n, pa.int64()),
                     pa.array(sig, pa.binary())], ["doc_id", "text_hash", "n", "sig"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, n long, sig binary")


def class_sets(docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """``id, n, keys`` of the rows that speak for the ``classes`` (``id, text_hash``; a written table). They are picked by a
    filter, so some others may be among them, and copies of a row; a set more costs time, not results."""
    chosen = build_filter(packed_hashes(classes.filter(F.col("id").isNotNull()).select(F.xxhash64("id", "text_hash"))))
    shared = docs.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sent = shared.value, set()
        for batch in batches:
            rows = np.asarray(batch.column(1), np.int64).view(np.uint64)
            some = [int(i) for i in np.flatnonzero(known.has(rows)) if rows[i] not in sent and not sent.add(rows[i])]
            batch = batch.take(pa.array(some, pa.int64()))
            for at, stop in hashing.slices(batch.column(2)):
                keys, first = shingle_sets(batch.column(2).slice(at, stop - at), k)
                n = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, stop - at), pa.array(n, pa.int64()),
                     pa.array([keys[first[i]:first[i + 1]].tobytes() for i in range(len(n))], pa.binary())], ["id", "n", "keys"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("text_hash"), "text").filter("id is not null")
    return rows.select("id", F.xxhash64("id", "text_hash").alias("row"), "text").mapInArrow(run, "id long, n long, keys binary").filter("n > 0")


def key_counts(sets: DataFrame) -> DataFrame:
    """``range, keys, counts, n``: shingles of two or more sets and their number of sets, packed and sorted by key."""
    bits = range_bits(sets.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            k, n = np.unique(np.concatenate(held), return_counts=True)
            once, many, n = k[n == 1], k[n > 1], n[n > 1].astype(np.int64)
            a, b = split_ranges(once, bits), split_ranges(many, bits)
            some = [i for i in range(1 << bits) if a[i + 1] > a[i] or b[i + 1] > b[i]]
            return pa.RecordBatch.from_arrays([
                pa.array(some, pa.int32()), *(pa.array([x[e[i]:e[i + 1]].tobytes() for i in some], pa.binary())
                                              for x, e in ((once, a), (many, b), (n, b)))], ["range", "once", "keys", "counts"])

        for batch in batches:
            for x in batch.column(0):
                held.append(np.frombuffer(x.as_py(), np.uint64))
                size += len(held[-1])
                if size > 3_000_000:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()

    def gather(group: pa.Table) -> pa.Table:
        once = np.concatenate([np.frombuffer(x, np.uint64) for x in group["once"].to_pylist()])
        k = np.concatenate([once, *(np.frombuffer(x, np.uint64) for x in group["keys"].to_pylist())])
        n = np.concatenate([np.ones(len(once), np.int64), *(np.frombuffer(x, np.int64) for x in group["counts"].to_pylist())])
        keys, inverse = np.unique(k, return_inverse=True)
        total = np.bincount(inverse, weights=n).astype(np.int64)
        keys, total = keys[total > 1], total[total > 1]
        return pa.table({"range": pa.array([group["range"][0].as_py()], pa.int32()), "keys": pa.array([keys.tobytes()], pa.binary()),
                         "counts": pa.array([total.tobytes()], pa.binary()), "n": pa.array([len(keys)], pa.int64()),
                         "sum": pa.array([int(total.sum())], pa.int64())})

    sent = sets.select("keys").mapInArrow(send, "range int, once binary, keys binary, counts binary")
    return sent.groupBy("range").applyInArrow(gather, "range int, keys binary, counts binary, n long, sum long")


class Order:
    """The global order of shingles: by count for the frequent ones; for others by the largest of the ``levels`` (a count
    and a filter of the shingles of so many sets, ascending) that knows them, 0 for the rest; then by hash. A filter's
    false hits move a shingle, but alike for all sets."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, levels: list[tuple[int, Filter]] | None = None) -> None:
        self.keys, self.counts, self.levels = keys, counts, levels or []

    def count(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for least, known in self.levels:
            left = left[known.has(keys[left])]
            out[left] = least
        if not len(self.keys):
            return out
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], out)

    def sort(self, keys: np.ndarray) -> np.ndarray:
        return keys[np.lexsort((keys, self.count(keys)))]


def frequent_order(counts: DataFrame) -> Order:
    """The counts of at most ``FREQUENT`` shingles: those of more sets than the sum of counts over ``FREQUENT``, 8 at least.
    Below that number filters of at most 32 MB in all tell those of 4, 8, 16 and so on sets. Without them all rarer
    shingles would come in the order of their hashes, and as that number grows with the corpus, lines and passages that
    some documents share would tie unrelated sets to clusters that grow faster than the corpus."""
    total = counts.agg(F.sum("sum")).first()[0] or 0
    least = max(8, total // FREQUENT + 1)
    floors = [1 << i for i in range(2, int(least - 1).bit_length())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, n in zip(batch.column(0), batch.column(1), strict=True):
                k, n = np.frombuffer(k.as_py(), np.uint64), np.frombuffer(n.as_py(), np.int64)
                some = n >= least
                yield pa.RecordBatch.from_arrays([pa.array([k[some].tobytes()], pa.binary()), pa.array([n[some].tobytes()], pa.binary())], ["k", "n"])

    rows = counts.select("keys", "counts").mapInArrow(run, "k binary, n binary").collect()
    k = np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(r["k"], np.uint64) for r in rows]])
    n = np.concatenate([np.empty(0, np.int64), *[np.frombuffer(r["n"], np.int64) for r in rows]])
    at = np.argsort(k)

    def at_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, k, n in zip(*batch.columns, strict=True):
                k, n = np.frombuffer(k.as_py(), np.uint64), np.frombuffer(n.as_py(), np.int64)
                some = [(floor, k[n >= floor]) for floor in floors if (n >= floor).any()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f for f, _ in some], pa.int64()), pa.array([part.as_py()] * len(some), pa.int32()),
                     pa.array([x.tobytes() for _, x in some], pa.binary()), pa.array([len(x) for _, x in some], pa.int64())],
                    ["floor", "range", "keys", "n"])

    levels = materialize(counts.select("range", "keys", "counts").mapInArrow(at_least, "floor long, range int, keys binary, n long"), "join-levels")
    return Order(k[at], n[at], [(f, build_filter(levels.filter(F.col("floor") == f), MAX_BITS >> (i + 3))) for i, f in enumerate(floors)])


def prefixes(sets: DataFrame, order: Order, repeated: Filter, percent: int) -> DataFrame:
    """``id, n, shared, prefix``: shingles that other sets may hold, in global order, and those of the prefix among
    them; sets whose prefix has none are left out."""
    context = sets.sparkSession.sparkContext
    shared_order, shared_filter = context.broadcast(order), context.broadcast(repeated)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, known = shared_order.value, shared_filter.value
        for batch in batches:
            rows = []
            for rep, n, packed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                keys = np.frombuffer(packed, np.uint64)
                keys = ranks.sort(keys[known.has(keys)])
                look = missing(n, percent) + 1 - (n - len(keys))
                if look > 0:
                    rows.append((rep, n, keys.tobytes(), keys[:look].astype(np.int64).tolist()))
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                pa.array(cols[3], pa.list_(pa.int64()))], ["id", "n", "shared", "prefix"])

    return sets.select("id", "n", "keys").mapInArrow(run, "id long, n long, shared binary, prefix array<long>")


def needed(a: int, b: int, percent: int) -> int:
    """Least overlap with which sets of ``a`` and ``b`` shingles link."""
    return -(-percent * (a + b) // (100 + percent))


class _Branch:
    """A path-compressed piece of the tree. ``low``/``high``: sizes of the sets below; ``tail``: the most shingles of one
    of them from this piece on; ``one``: a set below, and whether all below were of one component when last seen."""

    __slots__ = ("path", "kids", "ends", "low", "high", "tail", "one", "uniform")

    def __init__(self, path: np.ndarray, item: int, n: int) -> None:
        self.path, self.kids, self.ends = path, {}, [item]
        self.low = self.high = n
        self.tail, self.one, self.uniform = len(path), item, True


class PrefixTree:
    """Ordered sets of ranks; ``search`` unites the searching set with those that link with it."""

    def __init__(self, sizes: list[int], percent: int) -> None:
        self.sizes, self.percent = sizes, percent
        self.parent = list(range(len(sizes)))
        self.kids: dict[int, _Branch] = {}
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def insert(self, item: int, ranks: np.ndarray) -> None:
        n, kids, at, me = self.sizes[item], self.kids, 0, self.find(item)
        while True:
            branch = kids.get(int(ranks[at]))
            if branch is None:
                kids[int(ranks[at])] = _Branch(ranks[at:], item, n)
                return
            rest = ranks[at:]
            m = min(len(rest), len(branch.path))
            differ = np.flatnonzero(rest[:m] != branch.path[:m])
            same = int(differ[0]) if len(differ) else m
            if same < len(branch.path):
                lower = _Branch(branch.path[same:], branch.one, n)
                lower.kids, lower.ends, lower.low, lower.high = branch.kids, branch.ends, branch.low, branch.high
                lower.uniform, lower.tail = branch.uniform, branch.tail - same
                branch.path, branch.kids, branch.ends = branch.path[:same], {int(lower.path[0]): lower}, []
            branch.low, branch.high = min(branch.low, n), max(branch.high, n)
            branch.tail = max(branch.tail, len(rest))
            branch.uniform = branch.uniform and self.find(branch.one) == me
            if same == len(rest):
                branch.ends.append(item)
                return
            kids, at = branch.kids, at + same

    def search(self, item: int, ranks: np.ndarray) -> None:
        n, percent = self.sizes[item], self.percent
        smallest, largest = -(-percent * n // 100), n * 100 // percent
        have = set(ranks.tolist())
        todo = [(b, 0, 0) for _, b in sorted(self.kids.items(), key=lambda kb: kb[0] in have)]
        while todo:
            branch, shared, passed = todo.pop()
            if branch.high < smallest or branch.low > largest:
                continue
            if branch.uniform and self.find(branch.one) == self.find(item):
                continue
            want = needed(n, max(branch.low, smallest), percent)
            if shared + min(len(ranks) - passed, branch.tail) < want:
                continue
            place = np.searchsorted(ranks, branch.path)
            inside = place < len(ranks)
            shared += int((ranks[place[inside]] == branch.path[inside]).sum())
            passed = int(np.searchsorted(ranks, branch.path[-1], side="right"))
            for other in branch.ends:
                if shared >= needed(n, self.sizes[other], percent) and self.find(other) != self.find(item):
                    self.links.append((item, other))
                    self.parent[self.find(item)] = self.find(other)
            rest = branch.tail - len(branch.path)
            if branch.kids and shared + min(len(ranks) - passed, rest) >= want:
                todo += [(b, shared, passed) for _, b in sorted(branch.kids.items(), key=lambda kb: kb[0] in have)]


def tree_links(ids: list[int], sizes: list[int], sets: list[np.ndarray], order: Order, percent: int) -> list[tuple[int, int]]:
    """Links between ``sets`` that span the components among them."""
    every = np.unique(np.concatenate(sets))
    rank = np.empty(len(every), np.int64)
    rank[np.lexsort((every, order.count(every)))] = np.arange(len(every))
    tree = PrefixTree(sizes, percent)
    for i in np.argsort(sizes, kind="stable"):
        ranks = np.sort(rank[np.searchsorted(every, sets[i])])
        tree.search(int(i), ranks)
        tree.insert(int(i), ranks)
    return [(ids[a], ids[b]) for a, b in tree.links]


def _unit_links(units: DataFrame, order: Order, percent: int) -> DataFrame:
    """Links within each unit (``cluster, i, j, id, n, shared``); a task holds one unit at a time."""
    shared_order = units.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, now, held = shared_order.value, None, []

        def links() -> pa.RecordBatch:
            got = []
            if len(held) > 1:
                got = tree_links([h[0] for h in held], [h[1] for h in held], [np.frombuffer(h[2], np.uint64) for h in held], ranks, percent)
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.int64())], ["a", "b"])

        for batch in batches:
            for c, i, j, rep, n, packed in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if (c, i, j) != now:
                    if held:
                        yield links()
                    now, held = (c, i, j), []
                held.append((rep, n, packed))
        if held:
            yield links()

    cols = ["cluster", "i", "j"]
    dealt = units.select(*cols, "id", "n", "shared").repartition(*cols).sortWithinPartitions(*cols)
    return dealt.mapInArrow(run, "a long, b long")


def _pivot_links(members: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """``members`` with ``linked``: whether the set links with the set of its cluster's pivot (itself counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, m, b = (batch.column(i).to_pylist() for i in range(4))
            out = []
            for x, p, y, q in zip(n, a, m, b, strict=True):
                common = len(np.intersect1d(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), assume_unique=True))
                out.append(common >= needed(x, y, percent))
            yield pa.RecordBatch.from_arrays([batch.column(4), batch.column(5), pa.array(out, pa.bool_())], ["id", "cluster", "linked"])

    joined = members.join(pivots, "cluster").select("n", "shared", "pivot_n", "pivot_shared", "id", "cluster")
    return joined.mapInArrow(run, "id long, cluster long, linked boolean")


def _sized(members: DataFrame) -> DataFrame:
    """``cluster, blocks``: how many blocks each cluster makes."""
    return members.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.octet_length("shared") / 8) / BLOCK_TOKENS)).cast("int").alias("blocks"))


def _ties(tokens: DataFrame) -> DataFrame:
    """``a, b``: every ``id`` of a ``token`` that has several, and the smallest of them."""
    # written, so that Spark can split the tokens of many sets when it joins
    hubs = materialize(
        tokens.groupBy("token").agg(F.min("id").alias("hub"), F.max("id").alias("_last")).filter("hub <> _last").drop("_last"), "join-hubs")
    return tokens.join(hubs, "token").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()


def links(sets: DataFrame, order: Order, repeated: Filter, percent: int = 75) -> DataFrame:
    """``a, b``: links that span the components of the sets (``id, n, keys``)."""
    ready = materialize(prefixes(sets, order, repeated, percent), "join-prefixes")
    tokens = materialize(ready.select("id", "n", F.explode("prefix").alias("token")), "join-tokens")
    clusters = components(_ties(tokens))
    columns = ["cluster", "id", "n", "shared"]
    members = materialize(
        ready.join(clusters.select(F.col("id").alias("_m"), F.col("label").alias("cluster")), F.col("id") == F.col("_m")).select(*columns),
        "join-members")
    large = materialize(_sized(members).filter("blocks > 1").select("cluster"), "join-large")
    whole_unit = [F.lit(0).alias("i"), F.lit(0).alias("j")]
    found = _unit_links(members.join(large, "cluster", "left_anti").select("cluster", *whole_unit, "id", "n", "shared"), order, percent)
    if not large.limit(1).count():
        return found
    # sets that link lie in one size class or in neighbouring ones, and share a shingle of their prefixes; so in a large
    # cluster only ties within such a layer count
    size_class = F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / percent)))
    layers = F.explode(F.array(size_class, size_class + 1)).alias("layer")
    within = members.join(large, "cluster")
    layered = materialize(
        tokens.join(within.select("id").distinct(), "id", "left_semi").select("id", "token", layers)
        .select(F.xxhash64("id", "layer").alias("id"), F.xxhash64("token", "layer").alias("token")), "join-layers")
    parts = components(_ties(layered)).select(F.col("id").alias("_m"), F.col("label").alias("cluster"))
    split = materialize(
        within.select("id", "n", "shared", layers).join(parts, F.xxhash64("id", "layer") == F.col("_m")).select(*columns), "join-split")
    sizes = materialize(_sized(split), "join-sizes")
    huge = sizes.filter("blocks > 1")
    found = found.union(_unit_links(
        split.join(huge, "cluster", "left_anti").select("cluster", *whole_unit, "id", "n", "shared"), order, percent))
    if not huge.limit(1).count():
        return found
    big = materialize(split.join(huge, "cluster"), "join-big")
    # sets that link with one pivot are in one component; later pivots are taken from those that are in the first one's
    others, rest, pool = big.select("cluster", "id").distinct(), big, big
    for turn in range(PIVOTS):
        first = F.xxhash64("id", F.lit(turn)) if turn else F.col("id")
        pivots = materialize(pool.groupBy("cluster").agg(F.min(F.struct(first.alias("_first"), "id", "n", "shared")).alias("p")).select(
            "cluster", F.col("p.id").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.shared").alias("pivot_shared")), "join-pivots")
        tested = materialize(_pivot_links(rest, pivots.drop("pivot"), percent), "join-tested")
        found = found.union(
            tested.filter("linked").join(pivots.select("cluster", "pivot"), "cluster").select(F.col("id").alias("a"), F.col("pivot").alias("b")))
        done = tested.groupBy("cluster", "id").agg(F.min("linked").alias("_all")).filter("_all").drop("_all")
        others = materialize(others.join(done, ["cluster", "id"], "left_anti"), "join-others")
        rest, pool = (big.join(others, ["cluster", "id"], how) for how in ("left_semi", "left_anti"))
    rest = materialize(rest, "join-rest")
    rest_blocks = _sized(rest.drop("blocks")).withColumnRenamed("blocks", "rest_blocks")
    rest = rest.join(rest_blocks, "cluster").select(
        "cluster", F.pmod(F.xxhash64("id"), "rest_blocks").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), "id", "n", "shared")
    whole = big.join(rest_blocks, "cluster").select(
        "cluster", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("i"),
        F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("j"), "id", "n", "shared")
    return found.union(_unit_links(rest.union(whole), order, percent))


def join_rows(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id`` of every row of ``docs``."""
    seen = repeated_filter(docs, lambda text: low_keys(text, k, percent), "join-low-keys")
    every = materialize(document_sets(docs, seen, k, percent), "join-rows")
    candidates = every.filter(F.col("sig").isNotNull())
    classes = materialize(
        candidates.groupBy("sig").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("c"))
        .select("sig", F.col("c.doc_id").alias("id"), F.col("c.text_hash").alias("text_hash")), "join-classes")
    sets = materialize(class_sets(docs, classes, k), "join-sets")
    counts = materialize(key_counts(sets), "join-counts")
    found = materialize(links(sets, frequent_order(counts), build_filter(counts), percent), "join-links")
    labels = components(found)
    named = classes.select("sig", "id").join(labels.select(F.col("id").alias("_l"), "label"), F.col("id") == F.col("_l"), "left").select(
        F.col("sig").alias("_sig"), F.coalesce("label", "id").alias("_component"))
    own = ["doc_id", "text_hash", F.col("n").alias("n_shingles")]
    single = every.filter(F.col("sig").isNull()).select(*own, F.col("doc_id").alias("component_id"))
    grouped = candidates.join(named, F.col("sig") == F.col("_sig")).select(*own, F.col("_component").alias("component_id"))
    return single.unionByName(grouped)


def join(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``."""
    return join_rows(docs, k, percent).drop("text_hash")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """One document of each component, all columns as they were: that with the smallest id (a null id is the
    largest; of equal ids that with the smaller row key).

    Rows are judged by a key of their own, a hash of id and text, so rows that repeat an id with unrelated texts, or
    have none, stay where nothing links them. Rows that repeat both are copies.
    """
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text").isNull(), F.coalesce("text", F.lit("")))
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), key.alias("key"), "text")
    rows = join_rows(keyed.select(F.col("key").alias("doc_id"), "text"), k, percent)
    none = F.lit(None).cast("long")
    # a sum over both tables instead of a join, so that copies of one row meet only after they are combined
    both = rows.select(F.col("doc_id").alias("key"), "component_id", none.alias("id"), F.lit(0).alias("one")).unionByName(
        keyed.select("key", none.alias("component_id"), "id", F.lit(1).alias("one")))
    named = materialize(
        both.groupBy("key").agg(F.max("component_id").alias("component_id"), F.min("id").alias("id"), F.sum("one").alias("times")), "join-named")
    chosen = materialize(named.groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("c")).select("c.key"), "join-chosen")
    doubtful = named.join(chosen, "key", "left_anti").select("key").union(named.filter("times > 1").select("key"))
    kept = _membership(keyed, chosen, doubtful)
    compared = kept.filter("kept = 2").select("row", "key").join(chosen, "key", "left_semi")
    once = compared.withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy("key"))).filter("copy = 1")
    return kept.filter("kept = 1").select("row.*").union(once.select("row.*"))


def _membership(keyed: DataFrame, chosen: DataFrame, doubtful: DataFrame) -> DataFrame:
    """``keyed`` with ``kept``: 0 where the key is not chosen, 1 where it is and not doubtful, 2 where filters cannot tell;
    so few whole rows have to move."""
    spark = keyed.sparkSession
    has, may = (spark.sparkContext.broadcast(build_filter(materialize(packed_hashes(x.select("key")), "join-filter"))) for x in (chosen, doubtful))

    def run(key):
        keys = key.to_numpy().view(np.uint64)
        known = has.value.has(keys)
        return pd.Series(np.where(known, 1 + may.value.has(keys), 0).astype(np.int32))

    return keyed.withColumn("kept", F.pandas_udf(run, "int")("key"))
