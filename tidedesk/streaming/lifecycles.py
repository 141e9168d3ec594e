"""When tickets were opened and how that ended, kept as state over a stream.

An opening stands until the next opening or closing of its ticket or until its time to live is over, whichever
comes first: it ends ``closed``, ``reopened`` (the next opening begins its own) or ``expired``. An event at exactly
the end of the time to live still counts. A closing with nothing open is ignored, as are other kinds of event.
Events at one time go by their sequence number.

The stream may come in any order within the delay. Events wait in state until the watermark has passed them and are
then taken in order of time, so the outcome does not depend on how the input fell into batches. An event that
comes when the watermark has passed its time is late: it is left out and counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ListState

from tidedesk.operators.ordered import scan

OPEN, CLOSE = "open", "close"
SCHEMA = "ticket string, opened_at timestamp, ended_at timestamp, outcome string"
#: Tickets are dealt by hash to so many groups, each with a state of its own. Fixed for the life of a checkpoint.
GROUPS = 4096
#: Events that stand in one entry of a state at most.
ENTRY = 10_000
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ms(us: int) -> int:
    return -(-us // 1000)


def _entries(rows: list[list]) -> Iterator[tuple[str]]:
    return ((json.dumps(rows[i:i + ENTRY]),) for i in range(0, len(rows), ENTRY))


def _rows(state: ListState) -> list[list]:
    return [row for (entry,) in state.get() for row in json.loads(entry)]


class Lifecycles(StatefulProcessor):
    """State of a group of tickets: events that the watermark has not passed, and the openings that stand.

    Every call to the state is a message between processes, so tickets share a state: a batch appends the events of a
    group in one entry, and a timer takes all that is due in the group at once. A group has one timer, at what comes
    first of its waiting events and the ends of its openings; a batch that brings events adds one for the first of them.
    """

    def __init__(self, ttl_us: int):
        self.ttl = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # [ticket, time, number, whether it opens] and [ticket, time], as JSON lists
        self.waiting = handle.getListState("waiting", "events string")
        self.standing = handle.getListState("standing", "openings string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = None
        while new := [[r.ticket, r.us, r.seq, r.opens] for r in islice(rows, ENTRY)]:
            for entry in _entries(new):
                self.waiting.appendValue(entry)
            least = min(r[1] for r in new)
            first = least if first is None else min(first, least)
        if first is not None:
            self.handle.registerTimer(_ms(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        stood = _rows(self.standing)
        standing = dict(stood)
        held = _rows(self.waiting)
        due = sorted(h for h in held if h[1] <= passed)
        for ticket, at, _, opens in due:
            opened = standing.pop(ticket, None)
            if opened is not None:
                end = opened + self.ttl
                yield Row(ticket=ticket, opened_us=opened, ended_us=min(at, end), outcome="expired" if at > end else "reopened" if opens else "closed")
            if opens:
                standing[ticket] = at
        for ticket, opened in standing.items():
            if opened + self.ttl <= passed:
                yield Row(ticket=ticket, opened_us=opened, ended_us=opened + self.ttl, outcome="expired")
        stands = [[ticket, opened] for ticket, opened in standing.items() if opened + self.ttl > passed]
        rest = [h for h in held if h[1] > passed]
        if due:
            self._keep(self.waiting, rest)
        if stands != stood:
            self._keep(self.standing, stands)
        ahead = [h[1] for h in rest] + [opened + self.ttl for _, opened in stands]
        if ahead:
            self.handle.registerTimer(_ms(min(ahead)))

    @staticmethod
    def _keep(state: ListState, rows: list[list]) -> None:
        if rows:
            state.put(list(_entries(rows)))
        else:
            state.clear()

    def close(self) -> None:
        pass


def _events(events: DataFrame, ticket: str, at: str, kind: str, seq: str) -> DataFrame:
    rows = events.select(F.col(ticket).cast("string").alias("ticket"), F.col(at).cast("timestamp").alias("at"),
                         F.col(kind).alias("kind"), F.coalesce(F.col(seq).cast("long"), F.lit(0)).alias("seq"))
    return rows.filter(F.col("ticket").isNotNull() & F.col("at").isNotNull() & F.col("kind").isin(OPEN, CLOSE)).withColumn(
        "us", F.unix_micros("at"))


def follow(events: DataFrame, ttl_seconds: int, delay_seconds: int, *, ticket: str = "ticket_id", at: str = "at",
           kind: str = "kind", seq: str = "seq") -> DataFrame:
    """Ended openings of a streaming frame of events: ``ticket, opened_at, ended_at, outcome``.

    Events without ticket or time, and of other kinds than ``open`` and ``close``, are left out. The session needs the
    RocksDB state store, which ``run`` sets.
    """
    timed = _events(events, ticket, at, kind, seq).withWatermark("at", f"{delay_seconds} seconds").select(
        F.pmod(F.xxhash64("ticket"), F.lit(GROUPS)).alias("group"), "ticket", "at", "us", "seq", (F.col("kind") == OPEN).alias("opens"))
    ended = timed.groupBy("group").transformWithState(
        statefulProcessor=Lifecycles(ttl_seconds * 1_000_000), outputStructType="ticket string, opened_us long, ended_us long, outcome string",
        outputMode="append", timeMode="eventTime")
    return ended.select("ticket", F.timestamp_micros("opened_us").alias("opened_at"), F.timestamp_micros("ended_us").alias("ended_at"), "outcome")


def run(ended: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append ended openings to a Parquet table, exactly once, until the input is used up.

    Started again with the same checkpoint it goes on from the state it left.
    """
    spark = ended.sparkSession
    old = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        query = ended.writeStream.format("parquet").outputMode("append").option("path", path).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(_STORE, old)
    return query


def late_rows(query: StreamingQuery) -> int:
    """Events that a run left out because the watermark had passed them."""
    return sum(int(s.numRowsDroppedByWatermark) for p in query.recentProgress for s in p.stateOperators)


def settled(events: DataFrame, ttl_seconds: int, until_us: int | None, *, ticket: str = "ticket_id", at: str = "at",
            kind: str = "kind", seq: str = "seq") -> DataFrame:
    """The batch form: what ``follow`` has given when the watermark stands at ``until_us`` and no event came late.

    ``None`` stands for the end of time: every opening has ended. A hot ticket's events are spread over tasks.
    """
    ttl = ttl_seconds * 1_000_000
    rows = _events(events, ticket, at, kind, seq)
    if until_us is not None:
        rows = rows.filter(F.col("us") <= until_us)
    backwards = rows.select("ticket", "us", "seq", "kind", (-F.col("us")).alias("_back"), (-F.col("seq")).alias("_seq"))
    # latest first, so the row before is the next in time; at one time and number a closing goes first, as in the stream
    nexts = scan(backwards.withColumn("_kind", F.when(F.col("kind") == OPEN, 0).otherwise(1)), "ticket", ["_back", "_seq", "_kind"],
                 previous={"next_us": "us", "next_kind": "kind"})
    end = F.col("us") + ttl
    met = F.col("next_us").isNotNull() & (F.col("next_us") <= end)
    over = F.lit(True) if until_us is None else (F.col("next_us").isNotNull() | (end <= until_us))
    outcome = F.when(met, F.when(F.col("next_kind") == CLOSE, "closed").otherwise("reopened")).otherwise("expired")
    return nexts.filter((F.col("kind") == OPEN) & (met | over)).select(
        "ticket", F.timestamp_micros("us").alias("opened_at"), F.timestamp_micros(F.least(end, F.coalesce("next_us", end))).alias("ended_at"),
        outcome.alias("outcome"))
