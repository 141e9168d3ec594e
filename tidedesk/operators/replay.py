"""Conversations replayed turn by turn: a table function over partitions.

``replay(TABLE(turns), limit)`` walks each conversation in order and keeps its state: a user turn begins a step,
tokens are a quarter of the characters so far, and once they pass ``limit`` the context is trimmed to the current
turn, from which counting goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, SelectedColumn, lit, udtf
from pyspark.sql.types import BooleanType, LongType, StructType

KEY, TURN, ROLE, TEXT = "conv_id", "turn", "role", "text"


@udtf
class Replay:
    """One row per turn; the key and turn keep their own types, which ``analyze`` reads off the table."""

    @staticmethod
    def analyze(turns: AnalyzeArgument, limit: AnalyzeArgument) -> AnalyzeResult:
        if not turns.isTable:
            raise ValueError("the first argument must be a table")
        if limit.isTable or limit.value is None or int(limit.value) < 1:
            raise ValueError("the limit must be a positive number")
        given = {f.name: f.dataType for f in turns.dataType.fields}
        missing = [c for c in (KEY, TURN, ROLE, TEXT) if c not in given]
        if missing:
            raise ValueError(f"the table lacks {', '.join(missing)}")
        out = StructType().add(KEY, given[KEY]).add(TURN, given[TURN]).add("step", LongType()).add("turn_of_step", LongType())
        out = out.add("context_chars", LongType()).add("context_tokens", LongType()).add("trimmed", BooleanType())
        return AnalyzeResult(
            schema=out, partitionBy=[PartitioningColumn(KEY)], orderBy=[OrderingColumn(TURN)],
            select=[SelectedColumn(KEY), SelectedColumn(TURN), SelectedColumn(ROLE), SelectedColumn(f"char_length({TEXT})", "size")])

    def __init__(self):
        self.step = self.place = self.chars = 0

    def eval(self, row, limit):
        if row[ROLE] == "user":
            self.step, self.place = self.step + 1, 0
        self.place += 1
        size = row["size"] or 0
        self.chars += size
        trimmed = self.chars // 4 > int(limit)
        if trimmed:
            self.chars = size
        yield row[KEY], row[TURN], self.step, self.place, self.chars, self.chars // 4, trimmed


def replay(turns: DataFrame, limit: int) -> DataFrame:
    """The table function on a frame; see the module. The text itself does not leave the JVM, only its length does."""
    return Replay(turns.asTable(), lit(limit))


def register(spark: SparkSession, name: str = "replay") -> None:
    """Make the function known to SQL: ``SELECT * FROM replay(TABLE(conversations), 1000)``."""
    spark.udtf.register(name, Replay)
