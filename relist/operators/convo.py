"""Conversation operators: recent history, last substantial reply, last
question.  One pass per conversation key; windows are partitioned by the
conversation, aggregates are partial (max_by)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_turns(conv: DataFrame, n: int = 6, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """The last ``n`` turns of each conversation, as rows with their
    position from the end (1 = latest)."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return conv.withColumn("from_end", F.row_number().over(w)).filter(F.col("from_end") <= n)


def history_text(conv: DataFrame, n: int = 6, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """'role: text' lines of the last ``n`` turns in chronological order.
    The group is bounded by ``n`` before it is collected."""
    t = last_turns(conv, n, key, order)
    lines = F.collect_list(F.struct(F.col(order).alias("o"),
                                    F.concat(F.col("role"), F.lit(": "), F.col("text")).alias("line")))
    return (t.groupBy(key).agg(F.array_sort(lines).alias("_l"))
            .select(key, F.array_join(F.transform("_l", lambda x: x["line"]), "\n").alias("history")))


def last_reply(conv: DataFrame, min_len: int = 100, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """Last assistant message longer than ``min_len`` characters, else the
    last message of any role."""
    good = (F.col("role") == "assistant") & (F.length("text") > min_len)
    return conv.groupBy(key).agg(
        F.coalesce(F.max_by(F.when(good, F.col("text")), F.when(good, F.col(order))),
                   F.max_by("text", order)).alias("reply"))


def last_question(conv: DataFrame, key: str = "conv_id", order: str = "turn",
                  role: str | None = None) -> DataFrame:
    """Last message (optionally of one role) of each conversation."""
    df = conv if role is None else conv.filter(F.col("role") == role)
    return df.groupBy(key).agg(F.max_by("text", order).alias("question"),
                               F.max(order).alias("turn"))
