"""Conversations formatted as training windows of a token budget.

Prefix sums of turn tokens choose spans of whole turns. A window is the conversation's
leading system turn, the turns that begin in the last ``HISTORY_TOKENS`` before the span as
far as they fit, and the span: as many further turns as the budget holds beside them. Only
a single turn that is longer makes a longer window. What is repeated is masked; of the
span's turns the assistant's texts are under the loss.

A conversation may hold a third of all turns, so turns are sorted by ranges, not by
conversation; a prefix sum is the one within the range plus the ranges before. The sums
also cut conversations into blocks of ``BLOCK_TOKENS``, each beginning a span; spans are
chosen within a block, from its own turns and copies of the few before it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelab.llm.inputs import small_batches, whole_text
from pricelab.llm.tokens import chunk_ids, tokenizer_path
from pricelab.plans.staging import stage

#: Tokens of a window; of the history in it, at most; of the marks around a turn; of a block.
WINDOW_TOKENS = 1024
HISTORY_TOKENS = 256
MARK_TOKENS = 4
BLOCK_TOKENS = 64 * 1024

#: Characters of a role by which turns with one number are ordered.
TIE_CHARS = 16

#: What a turn is to a block, and the columns of a window.
SYSTEM, PAST, OWN = range(3)
WINDOW = ["window", "n_repeated", "n_new", "n_tokens", "text", "loss"]

TURN, END = "<|turn|>", "<|end|>"
_PARSED = re.compile(re.escape(TURN) + r"([^\n]*)\n([^<]*)" + re.escape(END) + "\n")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PLAIN = {"\\": "\\", "l": "<", "n": "\n"}


def escaped(text: str) -> str:
    """Without ``<``, so that no control string can occur in a text."""
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text)


class Sample(NamedTuple):
    text: str
    loss: list[tuple[int, int]]  # code points, end exclusive


def formatted(turns: list[tuple[str, str]], repeated: int) -> Sample:
    """The window of (role, text) turns, of which the first ``repeated`` are masked."""
    parts, loss, at = [], [], 0
    for number, (role, text) in enumerate(turns):
        head = TURN + escaped(role).replace("\n", "\\n") + "\n"
        body = escaped(text)
        if role == "assistant" and number >= repeated and body:
            loss.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return Sample("".join(parts), loss)


def parsed(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted window."""
    return [(unescaped(role), unescaped(body)) for role, body in _PARSED.findall(text)]


def spans(
    tokens: list[int], past: list[int], system: int, held: bool, budget: int, history: int
) -> Iterator[tuple[int, int, int]]:
    """(first, end, repeated): spans of turns, and how many turns before ``first`` go with it.

    ``tokens`` are those of a block's turns, ``past`` those of the turns just before it,
    ``system`` of the system turn, which is the block's own first turn if ``held``.
    """
    sums = list(accumulate(past + tokens, initial=0))
    first, last = len(past), len(past) + len(tokens)
    while first < last:
        at_lead = held and first == 0
        left = budget - (0 if at_lead else system)
        room = min(history, left - (sums[first + 1] - sums[first]))
        start = first if at_lead or room <= 0 else bisect_left(sums, sums[first] - room, held, first)
        end = max(first + 1, bisect_right(sums, sums[start] + left, first + 1) - 1)
        yield first - len(past), end - len(past), first - start
        first = end


def numbered_turns(turns: DataFrame) -> DataFrame:
    """_conv, _turn, _role, _text with _place (from 0), _tokens and _before added."""

    path = tokenizer_path()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = chunk_ids(path)
        for batch in batches:
            tokens = [len(known.ids(text)) // 4 + MARK_TOKENS for text in batch["_text"]]
            yield batch.assign(_tokens=tokens)

    # Ties go by hash, not by text: ranges are found in the driver, from sampled rows.
    order = [F.col(name).asc_nulls_first() for name in ("_conv", "_turn", "_front", "_tie")]
    # Written first: finding the ranges reads the turns once more.
    counted = stage(
        turns.mapInPandas(
            count, "_conv string, _turn string, _role string, _text string, _tokens long"
        ).withColumns(
            {
                "_turn": F.col("_turn").cast("long"),
                "_front": F.left("_role", F.lit(TIE_CHARS)),
                "_tie": F.xxhash64("_role", "_text"),
            }
        ),
        "chat-tokens",
    )
    ordered = stage(
        counted.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")),
        "chat-turns",
    )
    inside = Window.partitionBy("_conv", "_part").orderBy("_at")
    until = inside.rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("_conv", "_part").agg(
        F.sum("_tokens").alias("_sum"), F.count("*").alias("_n")
    )
    before = (
        Window.partitionBy("_conv").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = parts.select(
        F.col("_conv").alias("_of"),
        F.col("_part").alias("_of_part"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
    )
    return (
        ordered.select(
            "*",
            F.coalesce(F.sum("_tokens").over(until), F.lit(0)).alias("_sum_inside"),
            (F.row_number().over(inside) - 1).alias("_n_inside"),
        )
        .join(offsets, F.expr("_conv <=> _of AND _part = _of_part"))
        .select(
            "_conv",
            "_role",
            "_text",
            "_tokens",
            (F.col("_sum_before") + F.col("_sum_inside")).alias("_before"),
            (F.col("_n_before") + F.col("_n_inside")).alias("_place"),
        )
    )


def chat_windows(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    budget: int = WINDOW_TOKENS,
    history: int = HISTORY_TOKENS,
    block: int = BLOCK_TOKENS,
) -> DataFrame:
    """Per window: conv_id, window, n_repeated, n_new, n_tokens, text, loss (start, end).

    ``window`` is the tokens of the conversation before its first new turn, so windows of a
    conversation go by it.

    * Turns go by turn number (NULL first), ties by the role's first characters, then by a
      hash of role and text. Repeated rows are turns.
    * NULL texts and roles are empty. NULL is a conversation of its own.
    * Turns are never cut: a turn that does not fit beside the system turn has a window of
      these two. Turns longer than the history are not repeated.
    * Columns not named are not read; an empty table gives no rows.
    """
    small_batches(conversations.sparkSession)
    id_type = conversations.select(id_column).schema[0].dataType
    turns = stage(
        numbered_turns(
            conversations.select(
                F.col(id_column).cast("string").alias("_conv"),
                F.col(turn_column).cast("string").alias("_turn"),
                whole_text(role_column).alias("_role"),
                whole_text(text_column).alias("_text"),
            )
        ).withColumn("_block", F.floor(F.col("_before") / block)),
        "chat-numbered",
    )
    columns = ["_conv", "_block", "_kind", "_place", "_before", "_role", "_text", "_tokens"]
    own = turns.withColumn("_kind", F.lit(OWN)).select(columns)
    # The first turn of the next block begins in it, so what is before it by ``history``
    # begins here; what is copied too far back is left out again.
    past = (
        turns.where((F.col("_tokens") <= history) & ~F.expr("_place = 0 AND _role = 'system'"))
        .where(F.col("_before") >= (F.col("_block") + 1) * block - history)
        .withColumns({"_kind": F.lit(PAST), "_block": F.col("_block") + 1})
        .select(columns)
    )
    system = turns.where("_place = 0 AND _role = 'system'").select(
        F.col("_conv").alias("_of"), "_role", "_text", "_tokens"
    )
    later = turns.where("_block > 0").select("_conv", "_block").distinct()
    zero = F.lit(0).cast("long")
    kept = (
        later.join(system, F.expr("_conv <=> _of"))
        .withColumns({"_kind": F.lit(SYSTEM), "_place": zero, "_before": zero})
        .select(columns)
    )
    turn = F.struct("_kind", "_place", "_before", "_tokens", "_role", "_text")
    blocks = (
        own.unionByName(past)
        .unionByName(kept)
        .groupBy("_conv", "_block")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .where(F.exists("turns", lambda t: t["_kind"] == OWN))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for conv, found in zip(batch["_conv"], batch["turns"]):
                yield pd.DataFrame(
                    [(conv, *window) for window in block_windows(list(found), budget, history)],
                    columns=["_conv", *WINDOW],
                )

    return blocks.mapInPandas(
        run,
        "_conv string, window long, n_repeated long, n_new long, n_tokens long, text string,"
        " loss array<struct<start:int,end:int>>",
    ).select(F.col("_conv").cast(id_type).alias("conv_id"), *WINDOW)


def block_windows(turns: list[dict], budget: int, history: int) -> Iterator[tuple]:
    """The ``WINDOW`` columns of the windows of a block: its system turn, past and own turns."""
    own = [t for t in turns if t["_kind"] == OWN]
    system = [t for t in turns if t["_kind"] == SYSTEM]
    past = []  # those that lead up to the block without a gap
    for t in reversed([t for t in turns if t["_kind"] == PAST]):
        if t["_place"] + len(past) + 1 != own[0]["_place"]:
            break
        past.insert(0, t)
    held = own[0]["_place"] == 0 and own[0]["_role"] == "system"
    if held:
        system = own[:1]
    lead = sum(t["_tokens"] for t in system)
    every, tokens = past + own, [t["_tokens"] for t in own]
    for first, end, repeated in spans(
        tokens, [t["_tokens"] for t in past], lead, held, budget, history
    ):
        at = first + len(past)
        before = ([] if held and first == 0 else system) + every[at - repeated : at]
        window = before + own[first:end]
        sample = formatted([(t["_role"], t["_text"]) for t in window], len(before))
        yield (
            own[first]["_before"],
            len(before),
            end - first,
            sum(t["_tokens"] for t in window),
            sample.text,
            [{"start": a, "end": b} for a, b in sample.loss],
        )
