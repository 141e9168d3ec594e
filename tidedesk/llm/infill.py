"""Fill-in-the-middle rewriting: texts are cut at two hash-seeded ranks and their parts reordered behind sentinels.

The units of a text (code points, or the matches of a pattern) form an indexable skip list: lane 0 links
every unit, each higher lane about one in sixteen nodes of the lane below, and every link carries how many
units and how many code points it spans. A cut rank is reached by descending from the top lane and summing
widths, which gives its offset in code points exactly.

Ranks and form come from the SHA-256 of ``seed:doc_id`` alone, so a rerun gives the same rows. A text that
holds a sentinel stays plain, so that every output can be taken apart again (``restored``).

Defined cases: a null text is an empty one and an empty text is plain; a null id is hashed as ``null``;
rows that repeat an id are cut by the same draws, each at its own length; further input columns are
ignored; an empty table gives no rows. Python holds one Arrow batch, and lanes above it of a sixteenth of
a text's units; outputs leave in batches of a few MB or one text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, functions as F

from tidedesk.llm.hashing import mix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
#: Lane 0 is hashed in stretches of so many nodes; outputs are sent on from so many code points.
STRETCH, SEND = 1 << 18, 1 << 22


class SkipList:
    """Units of one text, given by their widths in code points.

    Whether a node stands in the next lane is read from a hash of its rank and lane; the head stands in all.
    """

    def __init__(self, widths: np.ndarray):
        self.units: list[np.ndarray] = [np.broadcast_to(np.int64(1), len(widths))]
        self.points: list[np.ndarray] = [widths]
        self.down: list[np.ndarray] = []
        ranks, total = None, len(widths)
        while len(self.units[-1]) > 32:
            ranks = self._raise(ranks, total)

    def _raise(self, ranks: np.ndarray | None, total: int) -> np.ndarray:
        """Adds a lane above the last; ``ranks`` are the units before each node of that (None: 0, 1, 2, ...)."""
        points, lane, size = self.points[-1], len(self.units), len(self.units[-1])
        kept, offsets, before = [], [], 0
        for a in range(0, size, STRETCH):
            b = min(a + STRETCH, size)
            rank = np.arange(a, b) if ranks is None else ranks[a:b]
            up = np.flatnonzero((mix(rank.astype(np.uint64) * np.uint64(64) + np.uint64(lane)) & np.uint64(15)) == 0)
            if a == 0 and (not len(up) or up[0]):
                up = np.concatenate([[0], up])
            sums = np.cumsum(points[a:b], dtype=np.int64)
            kept.append(up + a)
            offsets.append(before + sums[up] - points[a:b][up])
            before += int(sums[-1])
        down = np.concatenate(kept)
        above = down if ranks is None else ranks[down]
        self.down.append(down)
        self.units.append(np.diff(above, append=total))
        self.points.append(np.diff(np.concatenate(offsets), append=before))
        return above

    def locate(self, rank: int) -> int:
        """The offset in code points of the boundary before unit ``rank`` (of the end, if there is none)."""
        at = units = points = 0
        for lane in range(len(self.units) - 1, -1, -1):
            width, span = self.units[lane], self.points[lane]
            while at < len(width) and units + width[at] <= rank:
                units += int(width[at])
                points += int(span[at])
                at += 1
            if units == rank:
                break
            if lane:
                at = int(self.down[lane - 1][at])
        return points


def unit_widths(text: str, unit: re.Pattern | None = None) -> np.ndarray:
    """Widths in code points of the units of ``text``: its code points, or the matches of ``unit`` from left to
    right, where a stretch between matches is a unit too."""
    if unit is None:
        return np.broadcast_to(np.int64(1), len(text))
    ends, last = [], 0
    for m in unit.finditer(text):
        if m.start() > last:
            ends.append(m.start())
        if m.end() > m.start():
            ends.append(m.end())
            last = m.end()
    if last < len(text):
        ends.append(len(text))
    return np.diff(np.array(ends, np.int64), prepend=0)


def rearrange(doc_id: int | None, text: str, seed: str = "1", plain: int = 90, spm: int = 20,
              unit: re.Pattern | None = None) -> tuple[int, str, int | None, int | None, str]:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    widths = unit_widths(text, unit)
    n = len(widths)
    if not n or h3 % 100 >= plain or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    cuts = SkipList(widths)
    a, b = (cuts.locate(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    head, mid, tail = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{tail}{PREFIX}{head}{MIDDLE}{mid}"
    return n, "psm", a, b - a, f"{PREFIX}{head}{SUFFIX}{tail}{MIDDLE}{mid}"


def transform(docs: DataFrame, seed: str = "1", plain: int = 90, spm: int = 20, unit: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    Of a hundred texts ``plain`` are rearranged, ``spm`` in a hundred of them with the suffix first. ``unit`` is
    a pattern; without it a unit is a code point.
    """
    pattern = None if unit is None else re.compile(unit)
    arrow = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                       ("middle_chars", pa.int64()), ("output", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                i, t = doc_id.as_py(), text.as_py() or ""
                rows.append((i, *rearrange(i, t, seed, plain, spm, pattern)))
                size += len(t)
                if size > SEND:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def restored(form: Column, output: Column) -> Column:
    """The text that ``output`` was made from; sentinels stand in it once each and in a fixed order."""

    def parts(second: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(4))
        one = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(one) + 4)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substr(rest, F.length(two) + 4)

    head, tail, mid = parts(SUFFIX)
    tail2, head2, mid2 = parts(PREFIX)
    return F.when(form == "psm", F.concat(head, mid, tail)).when(form == "spm", F.concat(head2, mid2, tail2)).otherwise(output)


def digests(rearranged: DataFrame) -> DataFrame:
    """Rows of ``transform`` with the digests of the output and of the text rebuilt from it, in place of the output."""
    return rearranged.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))
