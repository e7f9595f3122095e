"""Chat rendering, response masks and think-block history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ChatML turn markers.
START, END = "<|im_start|>", "<|im_end|>"


def render_messages(messages: Column) -> Column:
    """array<struct<role, content>> -> ChatML text."""
    one = lambda m: F.concat(F.lit(START), m["role"], F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit(END + "\n"))
    return F.array_join(F.transform(messages, one), "")


def render_long(conversations: DataFrame, by: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Long form -> (by, text); a conversation's turns are gathered, which bounds a group by its length."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))))
    return conversations.groupBy(by).agg(render_messages(parts).alias("text"))


def response_spans(text: Column, response: str = START + "assistant\n", end: str = END) -> Column:
    """What is trained on: array of the texts between a response marker and the next end marker (or the end)."""
    pieces = F.slice(F.split(text, r"\Q" + response + r"\E", -1), 2, 1 << 30)
    return F.transform(pieces, lambda p: F.substring_index(p, end, 1))


def mask_coverage(rendered: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_chars, trained_chars and n_responses (long); a row with trained_chars = 0 would teach nothing."""
    spans = response_spans(F.col(text))
    total = F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    return rendered.withColumns({"n_chars": F.length(text).cast("long"), "trained_chars": total, "n_responses": F.size(spans).cast("long")})


def strip_think_history(messages: Column, think_open: str = "<think>", think_close: str = "</think>") -> Column:
    """Messages whose think blocks are gone but for the last assistant message's."""
    last = F.array_max(F.transform(messages, lambda m, i: F.when(m["role"] == "assistant", i).otherwise(-1)))
    block = r"(?s)\Q" + think_open + r"\E.*?\Q" + think_close + r"\E\s*"

    def one(m: Column, i: Column) -> Column:
        content = F.when((m["role"] == "assistant") & (i < last), F.regexp_replace(m["content"], block, "")).otherwise(m["content"])
        return F.struct(m["role"].alias("role"), content.alias("content"))

    return F.transform(messages, one)


def occurrences(text: Column, literal: str) -> Column:
    return (F.size(F.split(text, r"\Q" + literal + r"\E", -1)) - 1).cast("long")
