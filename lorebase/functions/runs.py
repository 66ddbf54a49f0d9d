"""A table function over messages: `SELECT * FROM fold_runs(TABLE(messages) PARTITION BY conv_id ORDER BY seq)`.

The SQL form of `operators.messages.merge_assistant_runs` without tool calls: consecutive assistant messages become one. Spark sorts each
conversation and passes it row by row to one task, so a conversation of any length is folded without being held, but a hot one is one
task's work; `merge_assistant_runs` splits those into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession, functions as F

RUNS = "conv_id BIGINT, run_no BIGINT, seq BIGINT, n_messages BIGINT, role STRING, content STRING"
#: Contents that say nothing.
EMPTY = (None, "", "tool call")


class FoldRuns:
    """Folds rows with conv_id, seq, role and content; other columns are ignored."""

    def __init__(self) -> None:
        self.conv, self.run, self.number = None, None, 0

    def eval(self, row: Row) -> Iterator[tuple]:
        self.conv = row["conv_id"]
        if self.run is not None and row["role"] == "assistant" == self.run[2]:
            self.run[1] += 1
        else:
            yield from self.finished()
            # Its first seq, number of messages, role, first content, and the contents that say something.
            self.run = [row["seq"], 1, row["role"], row["content"], []]
        if row["content"] not in EMPTY:
            self.run[4].append(row["content"])

    def finished(self) -> Iterator[tuple]:
        if self.run is not None:
            seq, count, role, first, texts = self.run
            # A message on its own stays as it is, and so does the first of those that say nothing.
            yield self.conv, self.number, seq, count, role, "\n".join(texts) if texts else first
            self.number += 1

    def terminate(self) -> Iterator[tuple]:
        yield from self.finished()


def create_fold_runs(spark: SparkSession, name: str = "fold_runs") -> None:
    """Register the table function for the session's SQL."""
    spark.udtf.register(name, F.udtf(FoldRuns, returnType=RUNS))
