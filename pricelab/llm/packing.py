"""Packing documents into sequences: best fit, then local search by swaps.

Pieces are dealt by hash to groups of about ``GROUP_BINS`` sequences and each group is
packed on its own, so no group grows with the data, whatever document, source or length
is frequent; it costs at most a sequence or so per group.

Within a group, best fit decreasing comes first. As long as more sequences are in use
than a proven bound, one is then emptied into others, the emptiest that can be: by
moving a piece, by exchanging one for one or any two for one, or by exchanges among the
others that make room. What did not empty a sequence stays only if the sum of squared
fills rose. An emptied sequence stays closed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.llm.inputs import for_pandas, restored, schema_of, small_batches, whole_text
from pricelab.llm.tokens import piece_batches, tokenizer_path
from pricelab.plans.staging import stage

SEQUENCE_TOKENS = 4096
END_ID = 1
GROUP_BINS = 2_000


def document_pieces(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    most: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    path: str | None = None,
    keep: list[str] | tuple[str, ...] = (),
    small: bool = False,
) -> DataFrame:
    """Per piece: doc_id, ``keep``, piece, start, length, ids (little-endian unsigned 32-bit).

    ``small`` adds ids_crc32 and keeps the ids as ``small_ids`` has them.

    A document is the ids of its text (none where NULL or empty), then ``end_id``. Only
    longer ones are cut, every ``most`` ids. Rows with equal or NULL ids stay separate.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), *keep, whole_text(text_column).alias("text"))
    safe, path = for_pandas(rows), path or tokenizer_path()
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in piece_batches(batches, path, most, end_id):
            if small:
                batch = batch.assign(ids_crc32=batch["ids"].map(zlib.crc32), ids=batch["ids"].map(small_ids))
            yield batch

    columns = ["piece int", "start long", "length long", "ids binary", *(["ids_crc32 long"] if small else [])]
    pieces = safe.mapInPandas(cut, schema_of(safe, *columns, without="text"))
    return restored(pieces, rows)


def small_ids(ids: bytes) -> bytes:
    """Ids in less room: of two bytes each where all are so small, deflated."""
    values = np.frombuffer(ids, "<u4")
    wide = bool(values.max(initial=0) >> 16)
    return bytes([wide]) + zlib.compress(ids if wide else values.astype("<u2").tobytes(), 1)


def whole_ids(small: bytes) -> bytes:
    """What ``small_ids`` was given."""
    ids = zlib.decompress(memoryview(small)[1:])
    return ids if small[0] else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def least_bins(lengths: list[int], most: int) -> int:
    """A proven lower bound on the number of sequences, by classes of fill.

    For each limit up to half a sequence: what is longer than the rest needs a sequence
    alone, what is over half one of its own, and what is at least the limit fits only into
    the room that those over half leave, or into more sequences.
    """
    if not lengths:
        return 0
    sizes = np.sort(np.asarray(lengths, "int64"))
    sums = np.concatenate(([0], np.cumsum(sizes)))
    limits = np.arange(most // 2 + 1)
    alone = np.searchsorted(sizes, most - limits, side="right")  # from here on
    half = int(np.searchsorted(sizes, most // 2, side="right"))
    small = np.minimum(np.searchsorted(sizes, limits, side="left"), half)
    single = np.maximum(alone, half)
    room = (single - half) * most - (sums[single] - sums[half])
    over = np.maximum(0, sums[half] - sums[small] - room)
    return int((len(sizes) - half - (-over // most)).max())


class Bins:
    """Sequences of one group; a piece is its place in the group's list of lengths.

    Where each piece is and how much room each sequence has are kept up with every move, as
    are the sum of squared fills and a list of moves to take back. A sequence that has been
    emptied is closed: nothing is put there again.
    """

    def __init__(self, lengths: list[int], most: int) -> None:
        self.lengths, self.most = lengths, most
        self.sizes = np.asarray(lengths, "int64")
        self.by_size = np.argsort(self.sizes, kind="stable")
        self.ordered = self.sizes[self.by_size]
        self.members: list[dict[int, None]] = []
        self.free: list[int] = []
        self.at_free: list[dict[int, None]] = [{} for _ in range(most + 1)]
        self.some_at = 0  # bit f: some open bin has f tokens left
        self.squares = 0
        self.where = np.full(len(lengths), -1)
        self.room = np.zeros(len(lengths) + 1, "int64")  # of bins; -1 where closed
        self.moves: list[tuple[int, int]] = []  # piece, from

    def set_free(self, b: int, free: int) -> None:
        old = self.free[b]
        self.at_free[old].pop(b, None)
        if not self.at_free[old]:
            self.some_at &= ~(1 << old)
        self.squares += (self.most - free) ** 2 - (self.most - old) ** 2
        self.free[b] = self.room[b] = free
        self.at_free[free][b] = None
        self.some_at |= 1 << free

    def open(self) -> int:
        b = len(self.free)
        self.members.append({})
        self.free.append(self.most)
        self.at_free[self.most][b] = None
        self.some_at |= 1 << self.most
        self.room[b] = self.most
        return b

    def close(self, b: int) -> None:
        self.at_free[self.most].pop(b)
        if not self.at_free[self.most]:
            self.some_at &= ~(1 << self.most)
        self.room[b] = -1

    def tightest(self, length: int, besides: int = -1) -> int:
        """The fullest bin with room for ``length``, or -1."""
        frees = self.some_at >> length
        free = length
        while frees:
            step = (frees & -frees).bit_length() - 1
            free += step
            for b in self.at_free[free]:
                if b != besides:
                    return b
            frees >>= step + 1
            free += 1
        return -1

    def put(self, piece: int, b: int) -> None:
        self.members[b][piece] = None
        self.where[piece] = b
        self.set_free(b, self.free[b] - self.lengths[piece])

    def take(self, piece: int) -> None:
        b = int(self.where[piece])
        del self.members[b][piece]
        self.set_free(b, self.free[b] + self.lengths[piece])

    def move(self, to: dict[int, int]) -> None:
        """Pieces to bins, all at once."""
        for piece in to:
            self.moves.append((piece, int(self.where[piece])))
            self.take(piece)
        for piece, b in to.items():
            self.put(piece, b)

    def take_back(self) -> None:
        """All moves since the list of moves was emptied."""
        self.move(dict(reversed(self.moves)))
        self.moves = []

    def best_fit(self) -> None:
        for piece in self.by_size[::-1].tolist():
            b = self.tightest(self.lengths[piece])
            self.put(piece, self.open() if b < 0 else b)

    def improve(self) -> int:
        """Empty bins, the emptiest first, until no fewer can do; how many are in use.

        Every bin is tried until one has been emptied. It ends when none can be, or when the
        bound proves the number.
        """
        least = least_bins(self.lengths, self.most)
        used = [b for b, members in enumerate(self.members) if members]
        emptied = True
        while emptied and len(used) > least:
            emptied = False
            for low in sorted(used, key=lambda b: -self.free[b]):
                self.moves, before = [], self.squares
                while self.members[low] and (self.raise_fill(low) or self.fill_others(low)):
                    pass
                if not self.members[low]:
                    self.close(low)
                    used.remove(low)
                    emptied = True
                    break
                if self.squares <= before:
                    self.take_back()
        return len(used)

    def raise_fill(self, low: int) -> bool:
        """One move or exchange that takes tokens out of ``low`` into a fuller bin."""
        own = sorted(self.members[low], key=lambda p: self.lengths[p])
        for piece in reversed(own):
            b = self.tightest(self.lengths[piece], besides=low)
            if b >= 0:
                self.move({piece: b})
                return True
        # Sums of one or any two pieces of ``low``; two of one length are enough.
        ones = {self.lengths[p]: [p] for p in own}
        few = [p for i, p in enumerate(own) if i < 2 or self.lengths[own[i - 2]] != self.lengths[p]]
        sizes = self.sizes[few]
        i, j = np.triu_indices(len(few), 1)
        pairs = sizes[i] + sizes[j]
        best = np.zeros(self.most + 1, "int64")  # the largest sum up to each room
        best[list(ones)] = list(ones)
        best[pairs] = pairs
        best = np.maximum.accumulate(best)

        # Of all pieces in bins that are not emptier, one that the most room is beside.
        room = self.room[self.where]
        can = (room > 0) & (room <= self.free[low]) & (self.where != low)
        can &= best[np.where(can, self.sizes + room, 0)] > self.sizes
        if not can.any():
            return False
        other = int(np.where(can, room, 0).argmax())
        b, total = int(self.where[other]), int(best[self.sizes[other] + room[other]])
        if total in ones:
            give = ones[total]
        else:
            at = int(np.flatnonzero(pairs == total)[0])
            give = [few[i[at]], few[j[at]]]
        self.move({other: low} | dict.fromkeys(give, b))
        return True

    def fill_others(self, low: int) -> bool:
        """Exchange pieces between bins besides ``low`` so that some become full.

        The other bin of an exchange is no fuller, so the sum of squared fills rises, and it
        gets room that pieces of ``low`` may fit.
        """
        room = self.room[self.where]
        inside = (room > 0) & (self.where != low)
        # Per length the most room beside such a piece, its bin, and the most in another bin.
        most = np.zeros(self.most + 1, "int64")
        np.maximum.at(most, self.sizes[inside], room[inside])
        at_most = inside & (room == most[self.sizes])
        owner = np.full(self.most + 1, -1)
        owner[self.sizes[at_most]] = self.where[at_most]
        second = np.zeros(self.most + 1, "int64")
        apart = inside & (self.where != owner[self.sizes])
        np.maximum.at(second, self.sizes[apart], room[apart])
        wanted = np.where(inside, self.sizes + room, 0)
        beside = np.where(owner[wanted] == self.where, second[wanted], most[wanted])
        changed = False
        for piece in np.flatnonzero(inside & (beside >= room)).tolist():
            b = int(self.where[piece])
            free = self.free[b]
            if not free:
                continue
            want = self.lengths[piece] + free
            start, end = np.searchsorted(self.ordered, (want, want + 1))
            others = self.by_size[start:end]
            places = self.where[others]
            fits = (places != b) & (places != low) & (self.room[places] >= free)
            if fits.any():
                other = int(others[int(fits.argmax())])
                self.move({piece: int(self.where[other]), other: b})
                changed = True
        return changed


def pack_lengths(lengths: list[int], most: int) -> list[list[int]]:
    """Sequences as lists of places in ``lengths``."""
    bins = Bins(lengths, most)
    bins.best_fit()
    bins.improve()
    return [sorted(members) for members in bins.members if members]


def pack_pieces(
    pieces: DataFrame, most: int = SEQUENCE_TOKENS, group_bins: int = GROUP_BINS
) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``most``) with sequence_id and offset added.

    The columns should be few and narrow: what is packed is the lengths. A piece that fills
    a sequence alone gets one directly. NULLs in other columns, ties and repeated rows make
    no difference; an empty table gives no rows.
    """
    rows = stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == most
    total = rows.where(~full).agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // (most * group_bins)))
    safe = for_pandas(rows)
    schema = schema_of(safe, "sequence_id long", "offset long", without="_row")

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.iloc[np.argsort(part["_row"].astype("int64").to_numpy())]
        lengths = part["length"].astype("int64").to_numpy()
        sequence, offset = np.zeros(len(part), "int64"), np.zeros(len(part), "int64")
        for b, members in enumerate(pack_lengths(lengths.tolist(), most)):
            sequence[members] = (int(part["_group"].iloc[0]) << 32) + b
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
        return part.drop(columns=["_row", "_group"]).assign(sequence_id=sequence, offset=offset)

    group = F.pmod(F.xxhash64("_row"), F.lit(groups)).alias("_group")
    packed = safe.where(~full).select("*", group).groupBy("_group").applyInPandas(pack, schema)
    alone = rows.where(full).select(
        *[F.col(f"`{name}`") for name in pieces.columns],
        (-F.col("_row") - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return restored(packed, rows).unionByName(alone)


def packed_documents(docs: DataFrame, **names: str) -> DataFrame:
    """Per piece: doc_id, copy, piece, start, length, ids_crc32, sequence_id, offset, ids.

    ``copy`` is a number that the pieces of one row of ``docs`` share with no other row: rows
    that repeat stay apart. Only lengths are packed; the ids, written once and made
    small for the disk, join them by piece.
    """
    numbered = docs.withColumn("copy", F.monotonically_increasing_id())
    pieces = document_pieces(numbered, keep=["copy"], small=True, **names)
    pieces = stage(pieces.withColumn("_piece", F.monotonically_increasing_id()), "token-pieces")
    packed = pack_pieces(pieces.drop("ids")).join(pieces.select("_piece", "ids"), "_piece").select(
        "doc_id", "copy", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"
    )

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(ids=batch["ids"].map(whole_ids))

    safe = for_pandas(packed)
    return restored(safe.mapInPandas(whole, schema_of(safe)), packed)
