"""Conversations read back from their formatted windows, as digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.llm.chat import parsed, unescaped


class Conversation:
    """What has been read of one conversation; digests grow, texts are not kept."""

    def __init__(self, key: str | None) -> None:
        self.key, self.turns, self.loss_chars, self.chars = key, 0, 0, 0
        self.texts, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, repeated: int, loss: list) -> None:
        for role, body in parsed(text)[repeated:]:
            self.turns += 1
            self.texts.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
        for span in loss:
            found = unescaped(text[span["start"] : span["end"]])
            self.loss_chars += len(found)
            self.loss.update(found.encode("utf-8", "surrogatepass"))
        self.chars += len(text)

    def row(self) -> tuple:
        return (
            self.key, self.turns, self.texts.hexdigest(), self.loss_chars,
            self.loss.hexdigest(), self.chars,
        )


NAMES = ["_conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def read_back(windows: DataFrame) -> DataFrame:
    """One row per conversation of ``chat_windows``.

    A digest is a chain over all turns, so the windows of one conversation stream, in order,
    through one task; it holds one window at a time.
    """
    id_type = windows.schema["conv_id"].dataType
    ordered = (
        windows.select(
            F.col("conv_id").cast("string").alias("_conv"), "window", "n_repeated", "text", "loss"
        )
        .repartition("_conv")
        .sortWithinPartitions("_conv", "window")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = None
        for batch in batches:
            done = []
            for key, text, repeated, loss in zip(
                batch["_conv"], batch["text"], batch["n_repeated"], batch["loss"]
            ):
                key = None if pd.isna(key) else key
                if current is None or current.key != key:
                    done += [current.row()] if current else []
                    current = Conversation(key)
                current.read(text, repeated, loss)
            yield pd.DataFrame(done, columns=NAMES)
        if current:
            yield pd.DataFrame([current.row()], columns=NAMES)

    return ordered.mapInPandas(
        run,
        "_conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long",
    ).select(F.col("_conv").cast(id_type).alias("conv_id"), *NAMES[1:])
