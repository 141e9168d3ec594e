"""Substring deduplication with suffix automata of reference shards.

A passage of ``window`` or more consecutive words that also starts in a document with a smaller id is
removed, every word of it. The corpus is its own reference, so an automaton of the whole cannot be
broadcast; it is cut into shards such that no match crosses two:

1. Every window of words has an anchor, the smallest hash among its ``anchor``-word grams. Equal
   windows have equal anchors, so only windows whose anchor occurs in two documents matter
   (:mod:`repeats`, a filter of bounded size that never loses one).
2. Neighbouring windows with one anchor form a snippet of at most ``2 * window - anchor`` words. First
   only hashes of snippets are gathered, to find the smallest document that holds each; a second
   filter of bounded size tells that document to send the words. These snippets are the reference;
   they go to the shard of their anchor.
3. Each task builds the suffix automaton of its shard, hands the smallest document down the suffix
   links, and streams the snippets through it: where the matching statistic reaches the window, the
   state of that length names the first document with this window.
4. Anchors with very many different snippets would make one shard too large; their windows are
   looked up by grouping on the window itself instead.
5. Occurrences take the answer for their snippet; a word goes if some window over it has a smaller
   first document than its own.

Defined cases: a null or empty text has no words; texts shorter than the window lose nothing; rows
that repeat an id do not count as smaller than each other; a row without id neither loses nor takes
words. Other input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidedesk.llm import hashing
from tidedesk.llm.repeats import Filter, build_filter, range_bits, repeated_filter
from tidedesk.session import materialize

WINDOW, ANCHOR = 13, 5
#: Different snippets of one anchor that one task takes into its automaton.
SHARD_SNIPPETS = 20_000
NO_DOC = np.iinfo(np.int64).max


def window_anchors(w: hashing.Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of every window by its first word, and which of them lie within one document."""
    n = len(w.hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)
    grams = np.zeros(len(w.hashes) - anchor + 1, np.uint64)
    for j in range(anchor):
        grams += hashing.mix(w.hashes[j:len(grams) + j] + hashing._FACTORS[j]) * hashing._FACTORS[j]
    grams = hashing.mix(grams)
    span, width = window - anchor + 1, 1
    while width * 2 <= span:
        grams = np.minimum(grams[:-width], grams[width:])
        width *= 2
    rest = span - width
    # minima are small numbers; mixed again they spread evenly over shards and filter ranges
    low = hashing.mix(np.minimum(grams[:n], grams[rest:rest + n]))
    return low, w.doc[:n] == w.doc[window - 1:]


def anchor_keys(text: pa.Array, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    w = hashing.words(text, lower=False)
    low, whole = window_anchors(w, window, anchor)
    at = np.flatnonzero(whole)
    low, doc = low[at], w.doc[at]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
    return low[new], doc[new]


class Snippets(NamedTuple):
    """Snippets of a slice: anchor, key (hash of anchor and words), document, first word and number of windows."""

    anchor: np.ndarray
    key: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    size: np.ndarray


def find_snippets(w: hashing.Words, seen: Filter, window: int, anchor: int) -> Snippets:
    """Runs of windows with one repeated anchor, in pieces of at most ``window - anchor + 1`` windows."""
    longest, factor = window - anchor + 1, hashing._FACTORS
    low, whole = window_anchors(w, window, anchor)
    wanted = whole.copy()
    wanted[whole] = seen.has(low[whole])
    pos = np.flatnonzero(wanted)
    new = np.ones(len(pos), bool)
    new[1:] = (np.diff(pos) > 1) | (low[pos[1:]] != low[pos[:-1]]) | (w.doc[pos[1:]] != w.doc[pos[:-1]])
    run_start = pos[new]
    length = np.diff(np.append(np.flatnonzero(new), len(pos)))
    pieces = -(-length // longest)
    first = np.repeat(run_start, pieces) + longest * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    size = np.minimum(longest, np.repeat(run_start + length, pieces) - first)
    key = low[first]
    for j in range(longest + window - 1):
        inside = j < size + window - 1
        key[inside] = (key[inside] + hashing.mix(w.hashes[first[inside] + j] ^ factor[j])) * factor[j + 1]
    return Snippets(low[first], hashing.mix(key + size.astype(np.uint64)), w.doc[first], first, size)


def _pair(anchor: np.ndarray, key: np.ndarray, doc: np.ndarray, bits: int) -> np.ndarray:
    """A filter key of snippet and document in the range of the anchor."""
    low = np.uint64(64 - bits)
    return (anchor >> low << low) | (hashing.mix(key ^ hashing.mix(doc.astype(np.uint64))) >> np.uint64(bits))


def _ids(column: pa.Array) -> np.ndarray:
    return np.asarray(column.fill_null(NO_DOC), np.int64)


def occurrences(docs: DataFrame, seen: Filter, window: int, anchor: int) -> DataFrame:
    """``anchor, key, doc_id, text_hash, start``: every occurrence of a snippet, without its words."""
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, marks = _ids(batch.column(0)), np.asarray(batch.column(1), np.int64)
            for at, stop in hashing.slices(batch.column(2)):
                w = hashing.words(batch.column(2).slice(at, stop - at), lower=False)
                s = find_snippets(w, known, window, anchor)
                own = ids[at + s.doc]
                yield pa.RecordBatch.from_arrays([
                    pa.array(s.anchor.astype(np.int64)), pa.array(s.key.astype(np.int64)), pa.array(own, mask=own == NO_DOC),
                    pa.array(marks[at + s.doc]), pa.array((s.first - w.first[s.doc]).astype(np.int32))],
                    ["anchor", "key", "doc_id", "text_hash", "start"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "anchor long, key long, doc_id long, text_hash long, start int")


def first_holders(found: DataFrame) -> DataFrame:
    """``range, keys, n``: of each snippet the pair with its smallest document, packed for a filter."""
    bits = range_bits(found.sparkSession)

    def gather(group: pa.Table) -> pa.Table:
        anchor, key = (np.asarray(group[c]).astype(np.uint64) for c in ("anchor", "key"))
        least = np.asarray(group["least"])
        order = np.lexsort((least, key))
        new = np.ones(len(order), bool)
        new[1:] = key[order][1:] != key[order][:-1]
        at = order[new]
        pairs = np.sort(_pair(anchor[at], key[at], least[at], bits))
        return pa.table({"range": pa.array([int(anchor[0] >> np.uint64(64 - bits))], pa.int32()),
                         "keys": pa.array([pairs.tobytes()], pa.binary()), "n": pa.array([len(pairs)], pa.int64())})

    least = found.groupBy("anchor", "key").agg(F.min(F.coalesce("doc_id", F.lit(NO_DOC))).alias("least"))
    ranged = least.withColumn("range", F.shiftrightunsigned("anchor", 64 - bits))
    return ranged.groupBy("range").applyInArrow(gather, "range int, keys binary, n long")


def reference(docs: DataFrame, seen: Filter, holders: Filter, window: int, anchor: int) -> DataFrame:
    """``anchor, key, words, least``: the words of every snippet, from the first document that holds it.

    The filter may let another document through as well; its row adds nothing wrong.
    """
    shared = docs.sparkSession.sparkContext.broadcast((seen, holders))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, first_holder = shared.value
        for batch in batches:
            ids = _ids(batch.column(0))
            for at, stop in hashing.slices(batch.column(1)):
                w = hashing.words(batch.column(1).slice(at, stop - at), lower=False)
                s = find_snippets(w, known, window, anchor)
                own = ids[at + s.doc]
                pairs = _pair(s.anchor, s.key, own, first_holder.range_bits)
                keep = np.flatnonzero(first_holder.has(pairs))
                keep = keep[np.unique(pairs[keep], return_index=True)[1]]
                begin, end = w.start[s.first[keep]], w.end[s.first[keep] + s.size[keep] + window - 2]
                texts = [bytes(w.data[x:y]) for x, y in zip(begin.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(s.anchor[keep].astype(np.int64)), pa.array(s.key[keep].astype(np.int64)),
                    pa.array(texts, pa.binary()), pa.array(own[keep])], ["anchor", "key", "words", "least"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "anchor long, key long, words binary, least long")


class SuffixAutomaton:
    """Automaton of several word sequences; every state knows the smallest document among its occurrences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [NO_DOC]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(NO_DOC)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for the shorter strings that end the path from ``p`` over ``c``."""
        nxt, link = self.next, self.link
        copy = self._state(self.length[p] + 1, link[q], dict(nxt[q]))
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        link[q] = copy
        return copy

    def add(self, sequence: list[int], doc: int) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in sequence:
            q = nxt[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
            else:
                state = self._state(length[last] + 1, 0, {})
                p = last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = state
                    p = link[p]
                if p >= 0:
                    q = nxt[p][c]
                    link[state] = q if length[q] == length[p] + 1 else self._split(p, c, q)
                last = state
            if doc < self.first[last]:
                self.first[last] = doc

    def close(self) -> None:
        """Hands the smallest documents down the suffix links, longest strings first."""
        first, link = self.first, self.link
        for v in np.argsort(-np.array(self.length), kind="stable").tolist():
            p = link[v]
            if p >= 0 and first[v] < first[p]:
                first[p] = first[v]

    def stream(self, sequence: list[int], least: int) -> Iterator[tuple[int, int]]:
        """``(end, document)`` for each end of a match of ``least`` or more words: the smallest document that holds
        the last ``least`` of them."""
        nxt, link, length = self.next, self.link, self.length
        v = matched = 0
        for end, c in enumerate(sequence, 1):
            while v and c not in nxt[v]:
                v = link[v]
                matched = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                matched += 1
            while v and length[link[v]] >= least:
                v = link[v]
                matched = length[v]
            if matched >= least:
                yield end, self.first[v]


def shard_owners(group: pa.Table, window: int) -> pa.Table:
    """``key, owners`` of a shard: for each window of each snippet the smallest document that holds it."""
    key, least = np.asarray(group["key"]), np.asarray(group["least"])
    order = np.lexsort((least, key))
    new = np.ones(len(order), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    rows = order[new]
    texts = group["words"].combine_chunks().take(pa.array(rows)).cast(pa.large_binary()).cast(pa.large_string())
    automaton, streams = SuffixAutomaton(), []
    w = hashing.words(texts, lower=False)
    symbols = np.unique(w.hashes, return_inverse=True)[1].tolist()
    for i, row in enumerate(rows):
        own = symbols[w.first[i]:w.first[i + 1]]
        streams.append(own)
        automaton.add(own, int(least[row]))
    automaton.close()
    owners = [[doc for _, doc in automaton.stream(own, window)] for own in streams]
    return pa.table({"key": pa.array(key[rows]), "owners": pa.array(owners, pa.list_(pa.int64()))})


def window_owners(rows: DataFrame, window: int) -> DataFrame:
    """The same for anchors with very many snippets, by grouping on the windows themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = hashing.words(batch.column(1).cast(pa.large_binary()).cast(pa.large_string()), lower=False)
            keys, at = hashing.sequences(w, window)
            doc = w.doc[at]
            row = pa.array(doc)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(row), batch.column(2).take(row), pa.array(at - w.first[doc], pa.int64()),
                pa.array(keys.astype(np.int64)), pa.array(hashing.mix(keys ^ w.hashes[at]).astype(np.int64))],
                ["key", "least", "i", "w1", "w2"])

    each = materialize(rows.select("key", "words", "least").mapInArrow(
        run, "key long, least long, i long, w1 long, w2 long"), "substring-windows")
    first = each.groupBy(F.col("w1").alias("_k"), F.col("w2").alias("_k2")).agg(F.min("least").alias("owner"))
    told = each.select("key", "i", "w1", "w2").distinct().join(first, (F.col("w1") == F.col("_k")) & (F.col("w2") == F.col("_k2")))
    listed = F.array_sort(F.collect_list(F.struct("i", "owner")))
    return told.groupBy("key").agg(F.transform(listed, lambda s: s["owner"]).alias("owners"))


def owners(ref: DataFrame, window: int, most: int = SHARD_SNIPPETS) -> DataFrame:
    """``key, owners`` of every snippet of the reference ``ref`` (a written table)."""
    many = materialize(ref.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > most).select(
        F.col("anchor").alias("_many")), "substring-many")
    bits = range_bits(ref.sparkSession) + 3
    hot = many.limit(1).count() > 0
    usual = ref.join(many, F.col("anchor") == F.col("_many"), "left_anti") if hot else ref
    shard = F.shiftrightunsigned("anchor", 64 - bits).alias("shard")
    by_shard = usual.select(shard, "key", "words", "least").groupBy("shard").applyInArrow(
        lambda group: shard_owners(group, window), "key long, owners array<long>")
    if not hot:
        return by_shard
    return by_shard.unionByName(window_owners(ref.join(many, F.col("anchor") == F.col("_many")).drop("_many"), window))


def removed_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, most: int = SHARD_SNIPPETS) -> DataFrame:
    """``doc_id, text_hash, starts``: per document the first words of the windows that a smaller document holds."""
    seen = repeated_filter(docs, lambda text: anchor_keys(text, window, anchor), "substring-anchors")
    found = materialize(occurrences(docs, seen, window, anchor), "substring-snippets")
    holders = build_filter(materialize(first_holders(found), "substring-holders"))
    ref = materialize(reference(docs, seen, holders, window, anchor), "substring-reference")
    told = materialize(owners(ref, window, most), "substring-owners").select(F.col("key").alias("_key"), "owners")
    hits = found.select("key", "doc_id", "text_hash", "start").join(told, F.col("key") == F.col("_key"))
    own = F.filter(F.transform("owners", lambda o, i: F.when(o < F.col("doc_id"), F.col("start") + i)), lambda x: x.isNotNull())
    hits = hits.select("doc_id", "text_hash", own.alias("own")).filter(F.size("own") > 0)
    return hits.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_set("own")).alias("starts"))


def deduplicate(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, most: int = SHARD_SNIPPETS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` of every document; ``kept`` is what is left of the text."""
    spans = removed_windows(docs, window, anchor, most).select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "starts")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    joined = rows.join(spans, (F.col("doc_id") == F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left").select("doc_id", "text", "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, digests, kept = [], [], [], []
            for text, starts in zip(batch.column(1), batch.column(2), strict=True):
                words = (text.as_py() or "").encode("utf-8").split()
                n.append(len(words))
                if starts.is_valid:
                    flags = np.zeros(len(words) + 1, np.int64)
                    at = np.unique(starts.values.to_numpy())
                    np.add.at(flags, at, 1)
                    np.add.at(flags, at + window, -1)
                    stay = np.cumsum(flags)[:-1] == 0
                    words = [x for x, s in zip(words, stay.tolist(), strict=True) if s]
                gone.append(n[-1] - len(words))
                left = b" ".join(words)
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string()),
                pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
