"""Keys that occur in two or more documents, as a filter of bounded size.

Tasks send each key once per batch, packed as sorted arrays by range of the key; a key in very many
documents therefore crosses the shuffle at most once per batch. The result is a Bloom filter, built
range by range, of at most ``MAX_BITS`` bits: beyond that it only lets more keys through, so its
users must treat it as a filter of candidates and decide by themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidedesk.llm.hashing import mix, slices
from tidedesk.session import materialize

_U = np.uint64
#: 128 MB: the most that is ever broadcast.
MAX_BITS = 1 << 30
BITS_PER_KEY, PROBES = 12, 4
#: Keys that a task gathers before it sends them.
HELD = 3_000_000

#: From a slice of texts to keys and the row of each; keys may repeat within a row.
KeysOf = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def range_bits(spark: SparkSession) -> int:
    """Bits of the key that choose its range: at least twice as many ranges as shuffle partitions."""
    return max(4, (2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def split_ranges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each range begins in the sorted ``keys``; one entry more than ranges."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << _U(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def repeated_keys(docs: DataFrame, keys_of: KeysOf) -> DataFrame:
    """``range, keys, n``: sorted keys (packed 64-bit integers) found in at least two rows."""
    bits = range_bits(docs.sparkSession)

    def packed(keys: list[np.ndarray], rows: list[np.ndarray]) -> pa.RecordBatch:
        k, r = np.concatenate(keys), np.concatenate(rows)
        order = np.argsort(k, kind="stable")  # rows ascend within a key
        k, r = k[order], r[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
        k, n = np.unique(k[new], return_counts=True)
        once, many = k[n == 1], k[n > 1]
        a, b = split_ranges(once, bits), split_ranges(many, bits)
        some = [i for i in range(1 << bits) if a[i + 1] > a[i] or b[i + 1] > b[i]]
        return pa.RecordBatch.from_arrays([
            pa.array(some, pa.int32()), pa.array([once[a[i]:a[i + 1]].tobytes() for i in some], pa.binary()),
            pa.array([many[b[i]:b[i + 1]].tobytes() for i in some], pa.binary())], ["range", "once", "many"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows, held, seen = [], [], 0, 0
        for batch in batches:
            text = batch.column(0)
            for at, stop in slices(text):
                k, r = keys_of(text.slice(at, stop - at))
                keys.append(k)
                rows.append(r + seen)
                seen += stop - at
                held += len(k)
                if held > HELD:
                    yield packed(keys, rows)
                    keys, rows, held = [], [], 0
        if held:
            yield packed(keys, rows)

    def gather(group: pa.Table) -> pa.Table:
        both = np.concatenate([np.frombuffer(x, np.uint64) for x in group["once"].to_pylist()] or [np.empty(0, np.uint64)])
        many = [np.frombuffer(x, np.uint64) for x in group["many"].to_pylist()]
        k, n = np.unique(np.concatenate([both, *many, *many]), return_counts=True)
        k = k[n > 1]
        return pa.table({"range": pa.array([group["range"][0].as_py()], pa.int32()), "keys": pa.array([k.tobytes()], pa.binary()),
                         "n": pa.array([len(k)], pa.int64())})

    sent = docs.select("text").mapInArrow(send, "range int, once binary, many binary")
    return sent.groupBy("range").applyInArrow(gather, "range int, keys binary, n long")


@dataclass(frozen=True)
class Filter:
    """``bits`` by range: range ``i`` owns ``size`` bytes from ``i * size`` on."""

    bits: np.ndarray
    range_bits: int
    size: int

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not self.size:
            return np.zeros(len(keys), bool)
        base = (keys >> _U(64 - self.range_bits)).astype(np.int64) * self.size
        found = np.ones(len(keys), bool)
        for place in _places(keys, self.size):
            found &= (self.bits[base + (place >> 3)] >> (place & 7).astype(np.uint8)) & 1 > 0
        return found


def _places(keys: np.ndarray, size: int) -> Iterator[np.ndarray]:
    a, b = mix(keys), mix(keys + _U(0x9E3779B97F4A7C15)) | _U(1)
    for i in range(PROBES):
        yield ((a + _U(i) * b) & _U(size * 8 - 1)).astype(np.int64)


def packed_hashes(hashes: DataFrame) -> DataFrame:
    """``range, keys, n`` of the longs in the only column, packed and sorted; a range has a row per task, keys may repeat."""
    bits = range_bits(hashes.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            k = np.unique(np.concatenate(held).view(np.uint64))
            a = split_ranges(k, bits)
            some = [i for i in range(1 << bits) if a[i + 1] > a[i]]
            return pa.RecordBatch.from_arrays([
                pa.array(some, pa.int32()), pa.array([k[a[i]:a[i + 1]].tobytes() for i in some], pa.binary()),
                pa.array([a[i + 1] - a[i] for i in some], pa.int64())], ["range", "keys", "n"])

        for batch in batches:
            held.append(np.asarray(batch.column(0), np.int64))
            size += len(held[-1])
            if size > HELD:
                yield packed()
                held, size = [], 0
        if size:
            yield packed()

    return hashes.mapInArrow(run, "range int, keys binary, n long")


def build_filter(keys: DataFrame, most: int = MAX_BITS) -> Filter:
    """A filter of at most ``most`` bits (a power of two) of the packed ``keys`` (a written table); its pieces are made in
    tasks and are all that the driver gets."""
    bits = range_bits(keys.sparkSession)
    total = keys.agg(F.sum("n")).first()[0] or 0
    if not total:
        return Filter(np.empty(0, np.uint8), bits, 0)
    wanted = min(most, BITS_PER_KEY * total) / (1 << bits)
    size = max(8, 1 << max(0, int(np.ceil(np.log2(wanted))) - 3))
    size = max(8, min(size, (most >> bits) // 8))

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for packed in batch.column(1):
                flags = np.zeros(size * 8, np.uint8)
                for place in _places(np.frombuffer(packed.as_py(), np.uint64), size):
                    flags[place] = 1
                out.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["range", "bits"])

    held = np.zeros(size << bits, np.uint8)
    for row in keys.select("range", "keys").mapInArrow(piece, "range int, bits binary").toLocalIterator():
        held[row["range"] * size:(row["range"] + 1) * size] |= np.frombuffer(row["bits"], np.uint8)
    return Filter(held, bits, size)


def repeated_filter(docs: DataFrame, keys_of: KeysOf, label: str) -> Filter:
    return build_filter(materialize(repeated_keys(docs, keys_of), label))
