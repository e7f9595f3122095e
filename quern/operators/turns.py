"""Conversations to training examples: first turns, completeness guard, reasoning scaffold, ordered limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import after, before, or_empty, strip, without

# The markers of the source's assistant turns.
BEGIN_THOUGHT, END_THOUGHT = "<|begin_of_thought|>", "<|end_of_thought|>"
BEGIN_SOLUTION, END_SOLUTION = "<|begin_of_solution|>", "<|end_of_solution|>"


def first_turns(conversations: DataFrame, by: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Long form -> one row a conversation: its first user and first assistant text, stripped; null if there is no such turn.

    An empty first turn counts: later ones do not step in. One shuffle, with one (turn, text) a role and task in it.
    """
    first = lambda who: strip(or_empty(F.min_by(F.struct(F.col(text).alias("t")), F.when(F.col(role) == who, F.col(turn)))["t"]))
    has = lambda who: F.max(F.when(F.col(role) == who, F.lit(True)))
    return conversations.groupBy(by).agg(F.when(has("user"), first("user")).alias("user"), F.when(has("assistant"), first("assistant")).alias("assistant"))


def first_turns_nested(rows: DataFrame, column: str = "conversations") -> DataFrame:
    """Nested form, array<struct<from, value>> -> the same two columns, without a shuffle."""

    def first(who: str) -> Column:
        own = F.filter(F.coalesce(F.col(column), F.array()), lambda t: t["from"] == who)
        return F.when(F.size(own) > 0, strip(or_empty(F.get(own, F.lit(0))["value"])))

    return rows.withColumns({"user": first("user"), "assistant": first("assistant")})


def scaffold(reasoning: Column, solution: Column, think_open: str = "", think_close: str = "") -> Column:
    """The assistant's content: reasoning between the tags, then the solution; without any tag a blank line parts them."""
    if think_open or think_close:
        return F.concat(F.lit(think_open), reasoning, F.lit(think_close), solution)
    return F.concat(reasoning, F.lit("\n\n"), solution)


def split_thought(turns: DataFrame) -> DataFrame:
    """Adds reasoning, solution and ok: both turns present, the thought complete, and all three parts non-empty."""
    u, a = or_empty(F.col("user")), or_empty(F.col("assistant"))
    reasoning = strip(without(before(a, END_THOUGHT), BEGIN_THOUGHT))
    solution = strip(without(strip(after(a, END_THOUGHT)), BEGIN_SOLUTION, END_SOLUTION))
    out = turns.withColumns({"reasoning": reasoning, "solution": solution})
    return out.withColumn("ok", (u != "") & (a != "") & a.contains(END_THOUGHT) & (F.col("reasoning") != "") & (F.col("solution") != ""))


def accepted_in_order(rows: DataFrame, order: str, n: int) -> DataFrame:
    """The first n rows that are ok, in order: a top-n, so no task sorts all rows."""
    return rows.filter("ok").orderBy(order).limit(n)


def build_examples(turns: DataFrame, order: str, n: int = 1000, think_open: str = "", think_close: str = "") -> DataFrame:
    """(order, messages): the first n complete examples as array<struct<role, content>>."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    content = scaffold(F.col("reasoning"), F.col("solution"), think_open, think_close)
    kept = accepted_in_order(split_thought(turns), order, n)
    return kept.select(order, F.array(message("user", F.col("user")), message("assistant", content)).alias("messages"))


def build_counts(turns: DataFrame, order: str, n: int = 1000) -> DataFrame:
    """One row (written, skipped): what a reader in order has accepted and rejected when it stops at the n-th accepted row.

    The stopping place comes from the top n; counting up to it is then an ordinary aggregate.
    """
    rows = split_thought(turns)
    stop = accepted_in_order(rows, order, n).agg(F.max(order).alias("last"), F.count(F.lit(1)).alias("written"))
    stop = stop.withColumn("last", F.when(F.col("written") >= n, F.col("last")))
    upto = rows.join(F.broadcast(stop), F.col("last").isNull() | (F.col(order) <= F.col("last")), "inner")
    bad = upto.agg(F.count_if(~F.col("ok")).alias("skipped"))
    return stop.select("written").join(F.broadcast(bad), F.lit(True)).select("written", "skipped")


class TooFewRows(RuntimeError):
    """A builder found fewer rows than asked for; nothing is published."""


def require_rows(df: DataFrame, n: int, what: str = "examples") -> DataFrame:
    """df; raises TooFewRows if it has fewer than n rows (it reads no more than n)."""
    got = df.limit(n).count()
    if got < n:
        raise TooFewRows(f"only wrote {got} of {n} {what}")
    return df


