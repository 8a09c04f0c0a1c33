"""Personal data by bootstrapped contextual extraction.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. These are the
seeds: the words around them are lexical patterns, and a pattern that mostly surrounds
known identifiers of one kind vouches for the unknown identifier-like words it surrounds.
Patterns and instances score each other in turn over their graph, in Spark; instances of
high score are identifiers too, wherever they occur, and so vouch for further patterns.
A pattern is made of words in at most 100 characters before and 60 after an instance.

An unknown word is identifier-like if it has enough digits, an ``@`` or the outline of an
IP address, and no base span; so is a whole run of digit groups joined by single blanks,
brackets, dots, slashes or dashes that has the outline of a card or phone number. Either
can become of a kind only if it has that kind's outline.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelab.llm.inputs import chunks, for_pandas, restored, schema_of, small_batches, whole_text
from pricelab.plans.staging import stage

#: In the order that breaks ties of place.
KINDS = ("email", "ip", "card", "phone")

ROUNDS = 3
#: Different known instances a pattern must surround, and the score that counts as high.
LEAST_SUPPORT = 3
CONFIDENCE = 0.8

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SIGN = re.compile(r"[0-9@]")
#: Where a word may be identifier-like: at a sign, or between colons as in addresses.
MARK = re.compile(r"[0-9@:](?:(?<!:)|(?=[0-9A-Fa-f]*:))")
#: Groups of digits, none of them part of a word. Both start with a set, which is fast.
RUN = re.compile(
    r"[0-9](?<![\w@][0-9])[0-9]*+(?![\w@])(?:\)?[ ./-]?\(?[0-9]++(?![\w@]))++"
)
NOT_DIGIT = re.compile(r"[^0-9]+")
EDGES = ".,;:!?\"'()[]{}<>|*"

#: What a word must look like to become of a kind by its context, in lower case.
OUTLINES = {
    "email": re.compile(r"[^@]+@[^@]+"),
    "ip": re.compile(r"[0-9a-f]*(?:[.:][0-9a-f]*){3,}"),
    "card": re.compile(r"(?:[0-9][ .-]?){12,19}"),
    "phone": re.compile(r"\+?\(?(?:[0-9][ ()./-]*){7,15}"),
}

Span = tuple[int, int, int]


def passes_luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def email_spans(text: str) -> Iterator[tuple[int, int]]:
    """Around each ``@``, so that long runs without one cost nothing."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", found.end() if found else at + 1)


def base_spans(text: str) -> list[Span]:
    """(start, place in ``KINDS``, end), by start, then kind."""
    spans = [(start, 0, end) for start, end in email_spans(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def lexical_patterns(text: str, start: int, end: int) -> list[str]:
    """Contexts of a place: two words before; one before with one after."""
    before = text[max(0, start - 100) : start].lower().split()[-2:]
    after = text[end : end + 60].lower().split()[:1]
    if any(SIGN.search(word) for word in before + after):
        return []
    found = ["|".join(before) + "|_"] if len(before) == 2 else []
    if before and after:
        found.append(f"{before[-1]}|_|{after[0]}")
    return found


def unknown_spans(text: str, known: list[Span]) -> Iterator[tuple[int, int]]:
    """Identifier-like words that touch no base span, without punctuation at the edges."""
    taken, at, last = sorted((start, end) for start, _, end in known), 0, 0
    for sign in MARK.finditer(text):
        if sign.start() < last:
            continue
        start = last = sign.start()
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        while last < len(text) and not text[last].isspace():
            last += 1
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at < len(taken) and taken[at][0] < last:
            continue
        word = text[start:last]
        end = start + len(word.rstrip(EDGES))
        start += len(word) - len(word.lstrip(EDGES))
        word = text[start:end]
        digits = len(NOT_DIGIT.sub("", word))
        if len(word) >= 6 and (
            digits >= 5 or "@" in word or OUTLINES["ip"].fullmatch(word.lower())
        ):
            yield start, end


def unknown_runs(
    text: str, known: list[Span], words: list[tuple[int, int]]
) -> Iterator[tuple[int, int]]:
    """Runs with blanks that touch no base span and have the outline of a card or phone.

    Runs that share only a part of an address-like one of ``words`` are left to that word.
    """
    addresses = [
        (start, end)
        for start, end in words
        if any(OUTLINES[kind].fullmatch(text[start:end].lower()) for kind in ("email", "ip"))
    ]
    taken = sorted([*((start, end) for start, _, end in known), *addresses])
    inner, at = set(addresses), 0
    for m in RUN.finditer(text):
        start, end = m.span()
        if ")" in m[0] and text[max(0, start - 1)] == "(":
            start -= 1
        if text[max(0, start - 1)] == "+":
            start -= 1
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        run = text[start:end]
        if " " not in run or not any(OUTLINES[k].fullmatch(run) for k in ("card", "phone")):
            continue
        touched = [x for x in taken[at : at + len(run)] if x[0] < end]
        # Address-like words all inside, as groups with dots, do not hinder.
        if all(x in inner and start <= x[0] and x[1] <= end for x in touched):
            yield start, end


def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in chunks(batches, "_text"):
        base, near = [], []
        for text in batch.pop("_text"):
            spans = base_spans(text)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
            words = list(unknown_spans(text, spans))
            unknown = [*words, *unknown_runs(text, spans, words)]
            places = [*spans, *((s, -1, e) for s, e in unknown)]
            near.append(
                [
                    {"start": s, "kind": k, "end": e, "word": text[s:e].lower(), "patterns": found}
                    for s, k, e in places
                    if (found := lexical_patterns(text, s, e)) or k < 0
                ]
            )
        yield batch.assign(base=base, near=near)


def pattern_edges(occurrences: DataFrame) -> DataFrame:
    """Different (pattern, word, kind)."""
    edges = occurrences.select(F.explode("patterns").alias("pattern"), "word", "kind").distinct()
    return stage(edges, "pii-edges")


def high(scored: DataFrame) -> DataFrame:
    """(word, kind, score) of words whose score is high and that have the kind's outline."""
    outlines = [
        (F.col("kind") == at) & F.col("word").rlike(f"^(?:{OUTLINES[kind].pattern})$")
        for at, kind in enumerate(KINDS)
    ]
    fits = outlines[0] | outlines[1] | outlines[2] | outlines[3]
    return scored.where((F.col("score") >= CONFIDENCE) & fits)


def supported_graph(edges: DataFrame, found: DataFrame | None) -> DataFrame:
    """Edges of patterns with enough known words of one kind; ``found`` count as known."""
    known = edges.where("kind >= 0")
    if found is not None:
        more = edges.where("kind < 0").drop("kind").join(found.select("word", "kind"), "word")
        known = known.unionByName(more)
    supported = (
        known.groupBy("pattern", "kind")
        .agg(F.countDistinct("word").alias("n"))
        .where(F.col("n") >= LEAST_SUPPORT)
        .select("pattern")
        .distinct()
    )
    return stage(edges.join(supported, "pattern", "left_semi"), "pii-graph")


def discovered_words(occurrences: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(word, kind) of unknown words whose score gets high.

    Words found in one round support patterns in the next. There are at least ``rounds``
    rounds, and more until one finds no new word.
    """
    edges = pattern_edges(occurrences)
    scored, now, built, done = None, 0, -1, 0
    while True:
        if now > built:  # without new words, the graph stays as it is
            built = now
            graph = supported_graph(edges, None if scored is None else high(scored))
            totals = graph.groupBy("pattern").agg(F.countDistinct("word").alias("words"))
            seeds = graph.where("kind >= 0").select(
                "pattern", "word", "kind", F.lit(1.0).alias("score")
            )
            unknown = graph.where("kind < 0").select("pattern", "word")
        known = seeds if scored is None else seeds.unionByName(unknown.join(scored, "word"))
        # One more word than seen, and none of the kind, keeps rare patterns from certainty.
        trust = (
            known.groupBy("pattern", "kind")
            .agg(F.sum("score").alias("score"))
            .join(totals, "pattern")
            .select("pattern", "kind", (F.col("score") / (F.col("words") + 1)).alias("trust"))
            .where("trust >= 0.5")
        )
        scored = stage(
            unknown.join(trust, "pattern")
            .groupBy("word", "kind")
            .agg(F.exp(F.sum(F.log(1.0 - F.col("trust")))).alias("doubt"))
            .select("word", "kind", (1.0 - F.col("doubt")).alias("score")),
            "pii-scores",
        )
        # Supported patterns and scores only grow, so words once found stay found.
        found, done = high(scored).count(), done + 1
        if done >= rounds and found <= now:
            break
        now = found
    best = F.max_by("kind", F.struct("score", -F.col("kind")))
    return high(scored).groupBy("word").agg(best.alias("kind"))


def personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """Per row of ``docs``: doc_id, base, added: arrays of (start, kind, end), sorted.

    ``kind`` is a place in ``KINDS``; places are code points, ends exclusive. Spans that the
    method adds touch no base span and not each other; of a run and a word in it the run is
    given. NULL texts are empty and have none; repeated rows and
    NULL ids stay; columns not named are not read; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.monotonically_increasing_id().alias("_row"),
        whole_text(text_column).alias("_text"),
    )
    safe = for_pandas(rows)
    spans = safe.mapInPandas(
        scanned,
        schema_of(
            safe,
            "base array<struct<start:int,kind:int,end:int>>",
            "near array<struct<start:int,kind:int,end:int,word:string,patterns:array<string>>>",
            without="_text",
        ),
    )
    found = stage(restored(spans, rows), "pii-spans")
    occurrences = found.select("_row", F.inline("near"))
    longest_first = Window.partitionBy("_row").orderBy("start", F.desc("end"))
    covered = F.max("end").over(longest_first.rowsBetween(Window.unboundedPreceding, -1))
    added = (
        occurrences.where("kind < 0")
        .select("_row", "start", "end", "word")
        .join(discovered_words(occurrences, rounds), "word")
        .withColumn("_covered", covered)
        .where("_covered IS NULL OR _covered <= start")
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("added"))
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return found.join(added, "_row", "left").select(
        "doc_id", "base", F.coalesce("added", none).alias("added")
    )
