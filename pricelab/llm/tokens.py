"""Token ids of texts by a vocabulary file of the ``tokenizers`` library.

The vocabulary's words never span blanks, so a text is the sequence of its chunks between
spaces and line ends, and a letter run stands alone before what follows it. Ids are kept
per chunk; only chunks not met before go through the tokenizer.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from functools import cache
from struct import pack

import numpy as np
import pandas as pd

#: Chunks whose ids a Python worker keeps; beyond, it starts over.
KEPT_CHUNKS = 400_000

TOKENIZER_FILE = "word_bpe_49k.json"

#: Characters whose lower case depends on their neighbours or is longer than one.
UNEVEN_LOWER = ("Σ", "İ")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in set(plain))
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class ChunkIds(dict):
    """Chunk to its ids as little-endian unsigned 32-bit bytes, filled as chunks are met."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.specials = {token.content for token in self.tokenizer.get_added_tokens_decoder().values()}

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha() and chunk.islower():
            ids = [token.id for token in self.model.tokenize(chunk)]
        elif self.single_letter_run(chunk):
            word = "".join([self.letters[b] for b in chunk.encode()])
            ids = [token.id for token in self.model.tokenize(word)]
        else:
            core = chunk.rstrip(".,!?;:#$%&*|")
            if core != chunk and core.isalpha() and not self.has_special(chunk):
                return self.kept(chunk, self[core] + self[chunk[len(core) :]])
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return self.kept(chunk, pack(f"<{len(ids)}I", *ids))

    def kept(self, chunk: str, ids: bytes) -> bytes:
        if len(self) >= KEPT_CHUNKS:
            self.clear()
        self[chunk] = ids
        return ids

    def single_letter_run(self, chunk: str) -> bool:
        return (
            chunk.isalpha()
            and unicodedata.is_normalized("NFC", chunk)
            and chunk == chunk.lower()
            and not any(c in chunk for c in UNEVEN_LOWER)
        )

    def has_special(self, chunk: str) -> bool:
        return any(special in chunk for special in self.specials)

    def ids(self, text: str) -> bytes:
        if not any(c in text for c in UNEVEN_LOWER) and not self.has_special(text):
            text = text.lower()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@cache
def chunk_ids(path: str) -> ChunkIds:
    """The chunks that this Python worker has met; its tasks go on with them."""
    return ChunkIds(path)


def piece_batches(
    batches: Iterator[pd.DataFrame], path: str, most: int, end_id: int
) -> Iterator[pd.DataFrame]:
    """Pieces of at most ``most`` ids of each row's text, ``end_id`` after each document."""
    from pricelab.llm.inputs import chunks

    known = chunk_ids(path)
    end = np.array([end_id], "<u4").tobytes()
    for batch in chunks(batches):
        columns = {name: [] for name in ("row", "piece", "start", "length", "ids")}
        for row, text in enumerate(batch["text"]):
            ids = known.ids(text) + end
            for piece, at in enumerate(range(0, len(ids), 4 * most)):
                part = ids[at : at + 4 * most]
                for name, value in zip(columns, (row, piece, at // 4, len(part) // 4, part)):
                    columns[name].append(value)
        pieces = pd.DataFrame(columns)
        others = batch.drop(columns="text").iloc[pieces.pop("row")].reset_index(drop=True)
        yield pd.concat((others, pieces), axis=1)
