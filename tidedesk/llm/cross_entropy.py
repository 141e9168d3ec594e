"""Cross-entropy difference: how much better a target model predicts a document than a background model.

Both are word bigram models over one vocabulary: every word of the target and of the background texts
(``words="both"``, as in the query), or the words that occur at least twice in the target texts, all others being one
unknown word (``words="target"``). A model interpolates the bigram estimate with the unigram estimate,
which adds one to each count, and is counted over all texts it is given. The score is the mean over a
document's tokens (its end among them) of the loss under the target model minus the loss under the
background model: the lower, the closer to the target.

Counts have no cap and no table of them stands on one machine. Texts become chunks of about a
million symbols. A chunk asks once for each of its words and bigrams, with its own counts, by range of a
64-bit hash of (history, word); the range adds up the counts of all chunks and answers each with the
totals of what it asked for. A frequent word or bigram therefore counts once per chunk in a shuffle,
and ranges grow in number with the corpus. The driver gets three numbers per range.

Defined cases: a null or empty text has no tokens and null losses and score; it adds nothing to the
counts; an empty target leaves its model the flat estimate over the vocabulary; repeated rows count
and are scored each. Words are runs of characters other than white space, A-Z lower-cased, and are
compared by 64-bit hash. The vocabulary size counts the unknown word and the edge of a text. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidedesk.llm import hashing
from tidedesk.llm.decontaminate import LOWER, UPPER
from tidedesk.llm.repeats import range_bits, split_ranges
from tidedesk.session import materialize

_U = np.uint64
#: Symbols of the edge of a text and of the unknown word.
EDGE, UNKNOWN = _U(0x5EDCE5EDCE5EDCE1), _U(0x0DDBA110DDBA1101)
#: Words that a target vocabulary may hold; it stands on the driver and in every task (40 MB).
MAX_VOCABULARY = 5_000_000
#: Symbols of a chunk (or one text), and symbols asked for per range.
CHUNK, RANGE = 1_000_000, 1_000_000
_CHUNK_SCHEMA = "chunk long, size long, ids array<long>, lengths binary, words binary, stream binary"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, as many as the largest needs; low-valued planes compress away."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel().astype(np.int64)


def vocabulary(target: DataFrame, least: int = 2) -> np.ndarray:
    """Sorted hashes of all words of ``target`` with a count of ``least`` or more."""
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    tokens = target.select(F.explode(F.split(lowered, r"[\x20\x09-\x0D]+")).alias("word")).filter("word <> ''")
    common = tokens.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("word")
    rows = common.limit(MAX_VOCABULARY + 1).collect()
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"the target holds over {MAX_VOCABULARY} words; use words='both', which keeps none on the driver")
    return np.sort(hashing.words(pa.array([r["word"] for r in rows], pa.string()), lower=True).hashes)


def chunks(docs: DataFrame, known: np.ndarray | None) -> DataFrame:
    """``chunk, size, ids, lengths, words, stream``: ids and lengths of texts, and their symbols, each text
    followed by the edge, as places in ``words`` (most frequent first)."""
    shared = None if known is None else docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = None if shared is None else shared.value
        base, made = TaskContext.get().partitionId() << 32, 0
        ids, lengths, held, size = [], [], [], 0

        def packed() -> pa.RecordBatch:
            stream = np.concatenate(held)
            words, at, n = np.unique(stream, return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            every = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([base + made], pa.int64()), pa.array([len(stream)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every),
                pa.array([pack(np.concatenate(lengths))], pa.binary()), pa.array([words[order].tobytes()], pa.binary()),
                pa.array([pack(place[at])], pa.binary())], ["chunk", "size", "ids", "lengths", "words", "stream"])

        for batch in batches:
            for at, stop in hashing.slices(batch.column(1)):
                w = hashing.words(batch.column(1).slice(at, stop - at), lower=True)
                symbols, n = w.hashes, np.diff(w.first)
                if vocab is not None:
                    near = np.minimum(np.searchsorted(vocab, symbols), max(len(vocab) - 1, 0))
                    symbols = np.where(vocab[near] == symbols, symbols, UNKNOWN) if len(vocab) else np.full(len(symbols), UNKNOWN)
                held.append(np.insert(symbols, w.first[1:][n > 0], EDGE))
                ids.append(batch.column(0).slice(at, stop - at))
                lengths.append(n)
                size += len(held[-1]) + len(n)
                if size > CHUNK:
                    yield packed()
                    ids, lengths, held, size, made = [], [], [], 0, made + 1
        if ids:
            yield packed()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _CHUNK_SCHEMA)


def symbols_of(words: bytes, stream: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of a chunk, its stream as places in them, and the bigram hash of every place."""
    known, at = np.frombuffer(words, np.uint64), unpack(stream)
    symbols = known[at]
    before = np.empty_like(symbols)
    before[:1], before[1:] = EDGE, symbols[:-1]  # each text ends with the edge, which begins the next
    return known, at, hashing.mix(hashing.mix(before) * _U(0x9E3779B97F4A7C15) + symbols)


def requests(made: DataFrame, bits: int, side: int) -> DataFrame:
    """``n, range, side, chunk, keys, counts``: the words (n = 1) and bigrams (n = 2) of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, stream in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                known, at, pairs = symbols_of(words, stream)
                order = np.argsort(known)
                single = known[order], np.bincount(at, minlength=len(known))[order]
                for n, (keys, counts) in ((1, single), (2, np.unique(pairs, return_counts=True))):
                    edges = split_ranges(keys, bits)
                    some = np.flatnonzero(np.diff(edges))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(some), n), pa.int32()), pa.array(some, pa.int32()), pa.array(np.full(len(some), side), pa.int32()),
                        pa.array(np.full(len(some), chunk), pa.int64()),
                        pa.array([keys[edges[i]:edges[i + 1]].tobytes() for i in some], pa.binary()),
                        pa.array([pack(counts[edges[i]:edges[i + 1]]) for i in some], pa.binary())],
                        ["n", "range", "side", "chunk", "keys", "counts"])

    return made.select("chunk", "words", "stream").mapInArrow(run, "n int, range int, side int, chunk long, keys binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """``n, range, chunk, target, background``: counts in both tables of what a background chunk asked for.

    A row of each range without a chunk holds the number of its keys and the sums of their counts.
    """

    def gather(group: pa.Table) -> pa.Table:
        side, chunk = group["side"].to_pylist(), group["chunk"].to_pylist()
        keys = [np.frombuffer(x, np.uint64) for x in group["keys"].to_pylist()]
        counts = np.concatenate([unpack(x) for x in group["counts"].to_pylist()])
        every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        ends = np.cumsum([len(k) for k in keys])
        of_target = np.repeat(np.array(side), [len(k) for k in keys]) == 0
        # counts are whole numbers below 2**53, so sums of doubles are exact
        totals = [np.bincount(inverse, weights=np.where(pick, counts, 0), minlength=len(every)).astype(np.int64) for pick in (of_target, ~of_target)]
        rows = [(None, *(pack(np.array([len(every), t.sum()])) for t in totals))]
        for s, c, k, end in zip(side, chunk, keys, ends, strict=True):
            if s:
                own = inverse[end - len(k):end]
                rows.append((c, *(pack(t[own]) for t in totals)))
        n, r = group["n"][0].as_py(), group["range"][0].as_py()
        return pa.table({
            "n": pa.array([n] * len(rows), pa.int32()), "range": pa.array([r] * len(rows), pa.int32()), "chunk": pa.array([x[0] for x in rows], pa.int64()),
            "target": pa.array([x[1] for x in rows], pa.binary()), "background": pa.array([x[2] for x in rows], pa.binary())})

    return asked.groupBy("n", "range").applyInArrow(gather, "n int, range int, chunk long, target binary, background binary")


def score(docs: DataFrame, target: DataFrame, weight: float = 0.6, least: int = 2, words: str = "target") -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score`` of every document; the background is ``docs``.

    ``least`` holds for ``words="target"``, whose vocabulary is broadcast.
    """
    if words not in ("both", "target"):
        raise ValueError("words must be both or target")
    known = vocabulary(target, least) if words == "target" else None
    sides = [materialize(chunks(table, known), f"lm-{name}")
             for name, table in (("target", target.withColumn("doc_id", F.lit(None).cast("long"))), ("background", docs))]
    size = sum(made.agg(F.sum("size")).first()[0] or 0 for made in sides)
    bits = max(range_bits(docs.sparkSession), (size // RANGE).bit_length())
    asked = requests(sides[0], bits, 0).unionByName(requests(sides[1], bits, 1))
    found = materialize(answers(asked), "lm-answers")
    sums = [[unpack(r[c]) for c in ("target", "background")] for r in found.filter("chunk is null and n = 1").toLocalIterator()]
    total = [float(sum(s[i][1] for s in sums)) for i in (0, 1)]
    # in ``both`` the keys are the words and the edge
    width = float(len(known) + 2 if known is not None else sum(s[0][0] for s in sums) + 1)

    def losses(counts: list[np.ndarray], at: np.ndarray, which: np.ndarray, edge: int, n_all: float) -> np.ndarray:
        single, pair = counts[0].astype(np.float64), counts[1].astype(np.float64)[which]
        seen = single[np.append(edge, at[:-1])]
        # a history that the model has not seen leaves all the weight to the unigram
        share = np.where(seen > 0, weight, 0.0)
        return -np.log(share * (pair / np.maximum(seen, 1)) + (1 - share) * ((single[at] + 1) / (n_all + width)))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        reply = {n: sorted((r for r in right.to_pylist() if r["n"] == n), key=lambda r: r["range"]) for n in (1, 2)}
        for ids, length, words_, stream in zip(
                left["ids"].combine_chunks(), *(left[c].to_pylist() for c in ("lengths", "words", "stream")), strict=True):
            lengths = unpack(length)
            some, n = lengths > 0, len(lengths)
            values = [np.zeros(n), np.zeros(n)]
            if some.any():
                symbols, at, pairs = symbols_of(words_, stream)
                which = np.unique(pairs, return_inverse=True)[1]
                order, edge = np.argsort(symbols), int(np.flatnonzero(symbols == EDGE)[0])
                first = np.cumsum(np.append(0, lengths[some] + 1))[:-1]
                for i, name in enumerate(("target", "background")):
                    single = np.empty(len(symbols), np.int64)
                    single[order] = np.concatenate([unpack(r[name]) for r in reply[1]])
                    loss = losses([single, np.concatenate([unpack(r[name]) for r in reply[2]])], at, which, edge, total[i])
                    values[i][some] = np.add.reduceat(loss, first) / (lengths[some] + 1)
            t, b = values
            parts.append(pa.table({"doc_id": ids.values, "n_tokens": pa.array(lengths, pa.int64()), **{
                name: pa.array(np.round(x, 6), pa.float64(), mask=~some)
                for name, x in (("target_loss", t), ("background_loss", b), ("score", t - b))}}))
        return pa.concat_tables(parts)

    joined = sides[1].groupBy("chunk").cogroup(found.filter("chunk is not null").groupBy("chunk"))
    return joined.applyInArrow(run, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
