"""What quality rules look at, per text, in DataFrame functions only.

Arrays of a text are bound once by ``let``, so that no split is done again per element.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that words are apart by.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
CAPITALS = r"\p{Lu}"
#: Words of a window whose repetition counts.
WINDOW = 3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words between white space; none in a text without."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, r"[\x20\x09-\x0D]+")
    )


def repeated_words(found: Column) -> Column:
    """Words that lie in a window of three which occurs twice or more, the first included.

    Windows are compared by a 64-bit hash. A text without a repeated window, told by their
    distinct number, needs no more; else hashes are sorted with their places, equal
    neighbours give the places of repeated windows, and each adds the words up to the next.
    """

    def of_windows(windows: Column) -> Column:
        placed = F.sort_array(
            F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            let(placed, of_placed)
        )

    def of_placed(placed: Column) -> Column:
        def again(one: Column, j: Column) -> Column:
            beside = (F.get(placed, j - 1)["h"], F.get(placed, j + 1)["h"])
            before, after = (F.coalesce(one["h"] == h, F.lit(False)) for h in beside)
            return before | after

        starts = F.sort_array(F.transform(F.filter(placed, again), lambda one: one["i"]))
        return let(starts, of_starts)

    def of_starts(starts: Column) -> Column:
        gaps = F.transform(
            starts,
            lambda at, j: F.least(F.coalesce(F.get(starts, j + 1) - at, F.lit(WINDOW)), F.lit(WINDOW)),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    last = F.size(found) - WINDOW
    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)),
    )
    return F.when(last < 1, 0).otherwise(let(windows, of_windows))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""

    def of_lines(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    said = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    return let(said, of_lines)


def statistics(text: Column) -> Column:
    """A struct of whole numbers: the contents of ``values`` below, by name."""

    def of_words(found: Column) -> Column:
        chars = F.aggregate(found, F.lit(0), lambda total, word: total + F.char_length(word))
        values = {
            "n_words": F.size(found),
            "n_chars": F.char_length(text),
            "word_chars": chars,
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
            "n_dup_lines": duplicate_lines(text),
            "n_repeat_words": repeated_words(found),
            "n_distinct": F.size(F.array_distinct(found)),
            "n_capitals": F.regexp_count(text, F.lit(CAPITALS)),
        }
        return F.struct(*[value.cast("long").alias(name) for name, value in values.items()])

    return let(words(text), of_words)
