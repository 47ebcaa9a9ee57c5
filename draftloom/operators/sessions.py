"""Generation sessions: turns of an arm that share a history under a token budget."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the share of a model's window that a session may fill.
FILL = 0.8


def next_prompt(history_chars: Column, last_prompt: Column, last_reply: Column, ask_chars: Column) -> Column:
    """The estimated tokens of a next prompt: what the last one was told to be, its reply and the new passage; without a count, characters over four."""
    measured = last_prompt + F.coalesce(last_reply, F.lit(0)) + F.floor(ask_chars / 4)
    return F.when(F.coalesce(last_prompt, F.lit(0)) > 0, measured).otherwise(F.floor((history_chars + ask_chars) / 4)).cast("bigint")


def token_cap(own_budget: Column, window: Column, default: int | None) -> Column:
    """A session's budget: the generator's own, else the default, and no more than its share of the window; null if nothing bounds it."""
    return F.least(F.coalesce(own_budget, F.lit(default)), F.floor(window * FILL).cast("int"))


def run(items: DataFrame, order: list[str], turns: int, budget: int) -> DataFrame:
    """(arm, item, session, turn, estimate, outcome): how the items of an arm run in sessions.

    A turn joins the session's history (its passage and reply). When the next
    prompt's estimate is above the budget, or the session has had its turns,
    or a turn failed, what is left goes on in a fresh session with an empty
    history; a session's first turn always runs, so every item runs once.
    Turns count from 1. Input: arm, item, ask_chars, reply_chars, failed and
    the order's columns. A fold over the sorted items as a stream; null counts are none.
    """
    rows = items.select("arm", *[F.col(o).alias(f"_o{k}") for k, o in enumerate(order)], "item", F.coalesce("ask_chars", F.lit(0)).alias("ask"), F.coalesce("reply_chars", F.lit(0)).alias("reply"), F.coalesce("failed", F.lit(False)).alias("failed"))
    ordered = rows.repartition("arm").sortWithinPartitions("arm", *[f"_o{k}" for k in range(len(order))], "item")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        arm, session, turn, history, ended = object(), 0, 0, 0, False  # no arm yet
        for b in batches:
            out = []
            for a, item, ask, reply, failed in zip(b["arm"], b["item"], b["ask"], b["reply"], b["failed"]):
                estimate = (history + ask) // 4
                if a != arm:
                    arm, session, turn, history, ended, estimate = a, 0, 0, 0, False, 0
                elif ended or turn >= turns or history and estimate > budget:
                    session, turn, history, ended, estimate = session + 1, 0, 0, False, 0
                turn += 1
                out.append((a, item, session, turn, estimate, "error" if failed else "ran"))
                if failed:
                    ended = True
                else:
                    history += ask + reply
            yield pd.DataFrame(out, columns=["arm", "item", "session", "turn", "estimate", "outcome"])

    kind = lambda c: items.schema[c].dataType.simpleString()
    return ordered.mapInPandas(fold, f"arm {kind('arm')}, item {kind('item')}, session int, turn int, estimate bigint, outcome string")
