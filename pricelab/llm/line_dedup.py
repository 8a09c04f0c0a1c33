"""Line dedup by deletion neighbourhoods, over words or characters.

A line repeats an earlier one if both are equal and not blank, or near:

* Lines of ``MIN_NEAR_WORDS`` words or more are near if their words are at edit distance 1
  at most: one word replaced, added or left out. Words are what single white-space
  characters separate.
* Lines of fewer words but ``MIN_NEAR_CHARS`` characters or more, such as unspaced text and
  addresses, are near if their characters are at edit distance 1.

Every line that repeats an earlier line, of any document, is dropped, whether or not that
earlier line is itself dropped. Earlier goes by id, then line number.

1. Equal lines meet under two 64-bit hashes; the earliest stays.
2. Two different lines one unit (word or character) apart share their front or their back
   half: the half that the edit is not in. Four hashes of halves per line, counted, leave
   only lines that share one with another line, and say in which half the edit must be.
3. Of these, the variants with one unit of that half deleted are emitted as hashed keys.
   Under one key meet a line and those that a deletion turns into it; under a key and a
   place meet lines that differ in that place alone. Only the earliest of each is kept
   per key, combined on the map side: no pairs are made among lines that meet.
4. Each line is verified unit by unit against the earliest that it met.

All steps are DataFrame functions and equi-joins, whose large partitions adaptive
execution may split. A line with n units that shares a half hashes n / 2 variants of itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelab.llm.inputs import matched, whole_text
from pricelab.plans.staging import stage

#: Lines of at least so many words are near by words; of those with fewer words, the lines
#: of at least so many characters are near by characters. Other lines repeat only equal ones.
MIN_NEAR_WORDS = 8
MIN_NEAR_CHARS = 24

#: White space besides line ends, which separates words as a blank does.
BLANKS = "\t\x0b\f\r"

LINE = ["_doc", "_hash", "_no"]

#: Places of lines that a document's number stands for: 30 bits of hash, 31 of line number.
IN_DOC = 1 << 61


def without_unit(side: str) -> str:
    """SQL: a line without the unit at its place (from 1; 0: the whole line).

    ``side`` is what the names of its columns begin with: line, by_words, n, place.
    """
    line, place, end = f"{side}_line", f"{side}_place", f"{side}_n - {side}_place"
    words = (
        f"concat(substring_index({line}, ' ', {place} - 1),"
        f" if({place} > 1 AND {end} > 0, ' ', ''), substring_index({line}, ' ', -({end})))"
    )
    characters = f"concat(left({line}, {place} - 1), right({line}, {end}))"
    return f"CASE WHEN {place} = 0 THEN {line} WHEN {side}_by_words THEN {words} ELSE {characters} END"


def document_rows(docs: DataFrame, id_column: str, text_column: str, keep: list[str]) -> DataFrame:
    """_doc, _hash (of the text, tells rows with one id apart), _text, and columns to keep."""
    text = whole_text(text_column)
    return docs.select(
        F.col(id_column).cast("long").alias("_doc"),
        F.pmod(F.xxhash64(text), F.lit(1 << 30)).cast("int").alias("_hash"),
        text.alias("_text"),
        *[F.col(f"`{name}`").alias(f"_keep_{i}") for i, name in enumerate(keep)],
    )


def plain(line: str) -> str:
    """SQL: a line with blanks for other white space."""
    for sign in BLANKS:
        line = f"replace({line}, chr({ord(sign)}), ' ')"
    return line


def not_blank(line: str) -> str:
    """SQL: whether a line, with blanks for other white space, says anything."""
    return f"trim({line}) != ''"


def line_rows(rows: DataFrame) -> DataFrame:
    """Lines that are not blank: _doc, _hash, _no, _own, _line, _by_words, _n.

    ``_line`` has blanks for other white space; ``_n`` is its number of units, words if
    ``_by_words``, else characters.
    """
    other = F.expr(f"{plain('_text')} != _text")  # told once per text
    split = F.posexplode(F.split("_text", "\n")).alias("_no", "_own")
    return measured_lines(rows.select("_doc", "_hash", "_text", other.alias("_other")).select("*", split)).drop(
        "_text", "_other"
    )


def measured_lines(lines: DataFrame) -> DataFrame:
    """Of lines ``_own`` (``_other``: with white space besides blanks) those not blank, measured."""
    words = "octet_length(_line) - octet_length(replace(_line, ' ', '')) + 1"
    return (
        lines.withColumn("_line", F.expr(f"if(_other, {plain('_own')}, _own)"))
        .where(not_blank("_line"))
        .selectExpr("*", f"{words} AS _words")
        .selectExpr("*", f"_words >= {MIN_NEAR_WORDS} AS _by_words")
        .selectExpr("*", "if(_by_words, _words, char_length(_line)) AS _n")
        .drop("_words")
    )


def order() -> Column:
    """Place of a line among all: by id (NULL last), text hash, line number."""
    doc = "coalesce(cast(_doc AS decimal(20)), 9223372036854775808BD)"
    return F.expr(f"{doc} * {IN_DOC}BD + (shiftleft(cast(_hash AS bigint), 31) + _no)").cast("decimal(38)")


def line_of(place: str) -> list[str]:
    """SQL: _doc, _hash and _no of a line by its place, as from ``order``."""
    rest = f"cast(pmod({place}, {IN_DOC}BD) AS bigint)"
    doc = f"cast(({place} - pmod({place}, {IN_DOC}BD)) / {IN_DOC}BD AS decimal(20))"
    return [
        f"cast(nullif({doc}, 9223372036854775808BD) AS bigint) AS _doc",
        f"cast(shiftright({rest}, 31) AS int) AS _hash",
        f"cast({rest} & 2147483647 AS int) AS _no",
    ]


def half_hashes(length: str) -> list[str]:
    """SQL: hashes of the front and the back half of a line, as of one of ``length`` units."""
    half = f"cast(({length}) div 2 AS int)"
    rest = f"cast(({length}) - ({length}) div 2 AS int)"
    front = f"if(_by_words, substring_index(_line, ' ', {half}), left(_line, {half}))"
    back = f"if(_by_words, substring_index(_line, ' ', -{rest}), right(_line, {rest}))"
    return [
        f"xxhash64('front', _by_words, {length}, {front})",
        f"xxhash64('back', _by_words, {length}, {back})",
    ]


def repeated_lines(rows: DataFrame) -> DataFrame:
    """(_doc, _hash, _no) of the lines to drop, of repeated rows more than once.

    ``rows`` as from ``document_rows``.
    """
    is_near = f"_by_words OR _n >= {MIN_NEAR_CHARS}"
    halves = half_hashes("_n") + half_hashes("_n + 1")
    lines = stage(
        line_rows(rows)
        .select(
            *LINE,
            F.xxhash64("_own").alias("_h1"),
            F.xxhash64(F.lit("again"), "_own").alias("_h2"),
            *[F.expr(f"if({is_near}, {half}, NULL)").alias(f"_k{i}") for i, half in enumerate(halves)],
        ),
        "lines",
    )
    # One row per different line: copies are combined before the shuffle.
    groups = stage(
        lines.groupBy("_h1", "_h2").agg(
            F.min(order()).alias("_first"),
            F.count("*").alias("_times"),
            *[F.min(f"_k{i}").alias(f"_k{i}") for i in range(4)],
        ),
        "line-groups",
    )
    first = [part.replace(" AS _", " AS _first_") for part in line_of("_first")]
    several = groups.where("_times > 1").selectExpr("_h1", "_h2", *first)
    is_first = " AND ".join(f"{name} <=> _first{name}" for name in LINE)
    equal = lines.select(*LINE, "_h1", "_h2").join(several, ["_h1", "_h2"]).where(f"NOT ({is_first})")
    near = near_lines(rows, groups.where("_k0 IS NOT NULL"))
    return equal.select(*LINE).unionByName(near)


def near_lines(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Lines one unit from an earlier one; of equal lines only the earliest need be named."""
    halves = groups.select(
        F.col("_first").alias("_order"),
        F.posexplode(F.array("_k0", "_k1", "_k2", "_k3")).alias("_which", "_half"),
    )
    shared = halves.groupBy("_half").agg(F.count("*").alias("_times")).where("_times > 1")
    sharing = (
        matched(halves, stage(shared.select("_half"), "shared-halves"), ["_half"], "inner")
        .groupBy("_order")
        .agg(F.bit_or(F.expr("shiftleft(1, _which)")).alias("_shares"))
    )
    # Per document its lines that share a half, with how: only these are split off again.
    wanted = (
        sharing.selectExpr("_shares", *line_of("_order"))
        .groupBy("_doc", "_hash")
        .agg(F.collect_list(F.expr("cast(_no AS bigint) * 16 + _shares")).alias("_wanted"))
    )
    found = matched(rows, stage(wanted, "sharing-lines"), ["_doc", "_hash"], "inner")
    found = found.select("_doc", "_hash", F.split("_text", "\n").alias("_lines"), "_wanted")
    found = found.select("_doc", "_hash", "_lines", F.explode("_wanted").alias("_want")).selectExpr(
        "_doc",
        "_hash",
        "cast(_want div 16 AS int) AS _no",
        "cast(_want % 16 AS int) AS _shares",
        "_lines[cast(_want div 16 AS int)] AS _own",
        "true AS _other",
    )
    texts = stage(measured_lines(found).drop("_other", "_own").withColumn("_order", order()), "line-texts")

    # Bits of _shares: front and back at its own length, front and back at one unit more.
    places = """
        concat(
            if(_shares & 12 != 0, array(0), array()),
            if(_shares & 2 != 0 AND _n > 1, sequence(1, _n div 2), array()),
            if(_shares & 1 != 0, sequence(_n div 2 + 1, _n), array()))
    """
    variants = (
        texts.selectExpr("_order", "_line", "_by_words", "cast(_n AS int) AS _n", "_shares")
        .selectExpr("_order", "_line", "_by_words", "_n", f"explode({places}) AS _place")
        .selectExpr("_order", "_place", f"xxhash64(_by_words, {without_unit('')}) AS _key")
    )
    met = variants.groupBy("_key", "_place").agg(
        F.min("_order").alias("_first"), F.count("*").alias("_times")
    )
    met = stage(met, "line-variants")

    replaced = (
        variants.join(met.where("_place > 0 AND _times > 1"), ["_key", "_place"])
        .where("_order > _first")
        .select(F.col("_order").alias("_late"), F.col("_first").alias("_early"), "_place")
        .select("_late", "_early", F.expr("_place AS _late_place"), F.expr("_place AS _early_place"))
    )
    whole = met.where("_place = 0").select("_key", F.col("_first").alias("_whole"))
    deleted = met.where("_place > 0").join(whole, "_key").where("_first != _whole")
    added = deleted.selectExpr(
        "greatest(_first, _whole) AS _late",
        "least(_first, _whole) AS _early",
        "if(_first > _whole, _place, 0) AS _late_place",
        "if(_first > _whole, 0, _place) AS _early_place",
    )
    pairs = replaced.unionByName(added).distinct()

    def side(name: str) -> DataFrame:
        return texts.selectExpr(
            f"_order AS _{name}",
            f"_line AS _{name}_line",
            f"_by_words AS _{name}_by_words",
            f"cast(_n AS int) AS _{name}_n",
        )

    verified = (
        pairs.join(side("early"), "_early")
        .join(side("late"), "_late")
        .where("_early_by_words = _late_by_words")
        .where(f"{without_unit('_early')} = {without_unit('_late')}")
        .select(F.col("_late").alias("_order"))
        .distinct()
    )
    return texts.join(verified, "_order", "left_semi").select(*LINE)


def deduplicated_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """Per row of ``docs``: doc_id, text (of the lines that stay), n_lines, n_dropped, ``keep``.

    * NULL and empty texts are one empty line, which stays, as all blank lines do: those of
      blanks, tabs and returns only.
    * Equal lines meet whatever their length; near ones as stated above. Within a document
      the same holds.
    * NULL ids come last. Rows that share an id go by a hash of their text. Of rows that
      repeat id and text the first is treated as above; the others lose every line that
      is not blank.
    * Columns not named are not read; an empty table gives no rows.
    """
    rows = document_rows(docs, id_column, text_column, list(keep))
    dropped = (
        repeated_lines(rows.select("_doc", "_hash", "_text"))
        .groupBy("_doc", "_hash")
        .agg(F.collect_set("_no").alias("_dropped"))
    )
    # Split before the joins, so that texts are split once and not for every line.
    split = rows.withColumn("_lines", F.split("_text", "\n")).drop("_text")
    turns = Window.partitionBy("_doc", "_hash", "_lines").orderBy(F.lit(1))
    repeated = rows.groupBy("_doc", "_hash").agg(F.count("*").alias("_rows")).where("_rows > 1")
    found = matched(split, stage(dropped, "dropped-lines"), ["_doc", "_hash"], "left")
    found = matched(found, stage(repeated, "repeated-rows"), ["_doc", "_hash"], "left")
    once = found.where("_rows IS NULL").withColumn("_turn", F.lit(1))
    more = found.where("_rows IS NOT NULL").withColumn("_turn", F.row_number().over(turns))
    numbers = "sequence(0, size(_lines) - 1)"
    said = f"filter({numbers}, i -> {not_blank(plain('_lines[i]'))})"
    kept = f"transform(array_except({numbers}, _gone), i -> _lines[i])"
    return (
        once.unionByName(more)
        .withColumn("_gone", F.expr(f"if(_turn = 1, _dropped, {said})"))
        .select(
            F.col("_doc").alias("doc_id"),
            F.expr(
                f"array_join(if(_gone IS NULL, _lines, {kept}), '\\n')"
            ).alias("text"),
            F.size("_lines").cast("long").alias("n_lines"),
            F.coalesce(F.array_size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
            *[F.col(f"_keep_{i}").alias(name) for i, name in enumerate(keep)],
        )
    )
