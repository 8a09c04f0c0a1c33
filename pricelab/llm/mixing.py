"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key whose rate is its quality weight. A source whose
target is ``e`` and a fraction times its size is taken whole ``e`` times; the fraction
is the documents with the smallest keys, as many as their prefix sum of words allows.

A source may hold a third of all rows, so no source is sorted in one task: rows are
partitioned by ranges of source and key, of some ``SLICE_ROWS`` rows whatever the weights
are, and a prefix sum is the sum of the source's ranges before plus the one within the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelab.llm.inputs import matched, whole_text
from pricelab.plans.staging import stage

WEIGHT_CYCLE = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_TIMES = 2.0
SLICE_ROWS = 20_000
SEED = 42

WORD = r"[^\x20\x09-\x0D]+"
#: A run of characters that prose has few of.
SYMBOLS = r"[^\p{L}\p{N}\s.,;:'-]+"


def word_count(text: str | Column) -> Column:
    """Number of words between blanks; 0 where NULL."""
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def quality_weight(text: str | Column) -> Column:
    """From 1 for plain prose down towards 0 with the symbol runs per word."""
    symbols = F.regexp_count(whole_text(text), F.lit(SYMBOLS))
    words = F.greatest(word_count(text), F.lit(1))
    return F.lit(1.0) / (F.lit(1.0) + symbols / words)


def score_weight(score: str | Column) -> Column:
    """The weight of a learned quality score from 0 to 1; none is without a chance."""
    return F.greatest(F.coalesce(F.col(score) if isinstance(score, str) else score, F.lit(0.0)), F.lit(0.01))


def sampling_key(weight: Column, *identity: Column, seed: int = SEED) -> Column:
    """Exponential with rate ``weight``, from a hash of what identifies a document."""
    draw = F.pmod(F.xxhash64(F.lit(seed), *identity), F.lit(1 << 52)) + F.lit(0.5)
    return -F.log(draw / F.lit(float(1 << 52))) / weight


def source_targets(
    sources: DataFrame,
    cycle: Sequence[float] = WEIGHT_CYCLE,
    share: float = SHARE,
    most_times: float = MOST_TIMES,
) -> DataFrame:
    """(_source, _size, ...) with ``_target`` added.

    Sources by code point, NULL last, weigh ``cycle``, repeating. They share ``share`` of
    all sizes by weight; none gets above ``most_times`` its size, and what is over is
    shared again by weight among the others.
    """
    # Sources are many or few; their places come from a distributed sort, not one task.
    ordered = stage(
        sources.orderBy(F.col("_source").asc_nulls_last()).select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"),
        ),
        "mix-sources",
    )
    before, starts = 0, {}
    for row in ordered.groupBy("_part").count().orderBy("_part").collect():
        starts[row["_part"]] = before
        before += row["count"]
    if not before:
        return ordered.drop("_part", "_at").withColumn("_target", F.lit(0.0))
    entries = ", ".join(f"{part}, {start}L" for part, start in starts.items())
    place = F.expr(f"map({entries})[_part] + _at")
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    weighted = ordered.withColumn(
        "_share", F.get(weights, F.pmod(place, F.lit(len(cycle))).cast("int"))
    ).withColumn("_cap", F.col("_size") * most_times)

    # Sources at their cap stay there; the level per weight only rises, so this ends.
    level = 0.0
    while True:
        capped = F.col("_share") * F.lit(level) >= F.col("_cap")
        total, at_cap, open_share = weighted.agg(
            F.sum("_size") * share,
            F.sum(F.when(capped, F.col("_cap")).otherwise(0.0)),
            F.sum(F.when(~capped, F.col("_share")).otherwise(0.0)),
        ).first()
        if not open_share:
            break
        raised = (total - at_cap) / open_share
        if raised <= level * (1 + 1e-15):
            break
        level = raised
    target = F.least(F.col("_share") * F.lit(level), F.col("_cap"))
    return weighted.withColumn("_target", target).drop("_part", "_at", "_share", "_cap")


def key_ranges(rows: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(_source, _key, ...) with ``_part`` added: ranges of like size, in order of key per source.

    Ranges come from quantiles that Spark samples, of a hash of the source, the key and a
    number that parts equal keys.
    """
    n_parts = max(1, -(-rows.count() // slice_rows))
    order = ["_of_hash", "_key", "_number"]
    numbered = rows.withColumns(
        {"_of_hash": F.xxhash64("_source"), "_number": F.monotonically_increasing_id()}
    )
    parted = numbered.repartitionByRange(n_parts, *order).withColumn("_part", F.spark_partition_id())
    return stage(parted.drop("_of_hash"), "mix-ranges")


def planned_rows(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    source_column: str,
    weight: Column | None,
    cycle: Sequence[float],
    share: float,
    most_times: float,
    seed: int,
) -> DataFrame:
    """_id, _words, _size, _target, _of (source), _key, _epochs, _chosen (by the fraction)."""
    text = F.col(text_column)
    weight = quality_weight(text) if weight is None else weight
    rows = docs.select(
        F.col(id_column).alias("_id"),
        F.col(source_column).alias("_source"),
        word_count(text).alias("_words"),
        sampling_key(weight, F.col(id_column), whole_text(text), seed=seed).alias("_key"),
    )
    rows = key_ranges(stage(rows, "mix-rows"))
    parts = stage(rows.groupBy("_source", "_part").agg(F.sum("_words").alias("_in_part")), "mix-parts")
    sources = parts.groupBy("_source").agg(F.sum("_in_part").alias("_size"))
    targets = stage(source_targets(sources, cycle, share, most_times), "mix-targets").select(
        F.col("_source").alias("_of"),
        "_size",
        "_target",
        F.when(F.col("_size") > 0, F.floor(F.col("_target") / F.col("_size")))
        .otherwise(0)
        .alias("_epochs"),
    )
    so_far = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        F.col("_source").alias("_part_of"),
        F.col("_part").alias("_part_at"),
        F.coalesce(F.sum("_in_part").over(so_far), F.lit(0)).alias("_before"),
    )
    inside = (
        Window.partitionBy("_source", "_part")
        .orderBy("_key", "_id", "_words", "_number")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = (
        rows.withColumn("_through", F.sum("_words").over(inside))
        .join(before, F.expr("_source <=> _part_of AND _part = _part_at"))
        .join(targets, F.expr("_source <=> _of"))
    )
    rest = F.col("_target") - F.col("_epochs") * F.col("_size")
    middle = F.col("_before") + F.col("_through") - F.col("_words") / 2
    return summed.withColumn("_chosen", (rest > 0) & (middle <= rest))


def mix_sources(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weight: Column | None = None,
    cycle: Sequence[float] = WEIGHT_CYCLE,
    share: float = SHARE,
    most_times: float = MOST_TIMES,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    ``taken`` is the words the mix takes of the document: its size times whole epochs, and
    once more where the fraction of its source reaches it. The last document of a fraction
    is the one that ends nearest to the target.

    * NULL and empty texts have size 0 and are taken 0 times; NULL is a source of its own.
    * Keys hash id and text, so reruns agree and repeated rows get equal keys; which of
      them the fraction takes makes no difference. ``weight`` must be above 0.
    * Columns not named are not read; an empty table gives no rows.
    """
    planned = planned_rows(
        docs, id_column, text_column, source_column, weight, cycle, share, most_times, seed
    )
    times = F.col("_epochs") + F.col("_chosen").cast("int")
    return planned.select(
        F.col("_id").alias("doc_id"),
        F.col("_words").alias("size"),
        F.col("_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_words") * times).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weight: Column | None = None,
    cycle: Sequence[float] = WEIGHT_CYCLE,
    share: float = SHARE,
    most_times: float = MOST_TIMES,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix_sources`` takes it, all columns kept.

    A fraction is the documents up to its last key, so per source only that key is joined
    to the texts, which are not shuffled. Rows that repeat id and text are taken together.
    Texts without words are taken with the whole epochs of their source.
    """
    planned = planned_rows(
        docs, id_column, text_column, source_column, weight, cycle, share, most_times, seed
    )
    cuts = planned.groupBy("_of").agg(
        F.max("_epochs").alias("_epochs"), F.max(F.when(F.col("_chosen"), F.col("_key"))).alias("_cut")
    )
    text = F.col(text_column)
    weight = quality_weight(text) if weight is None else weight
    keyed = docs.withColumns(
        {
            "_of": F.col(source_column),
            "_key": sampling_key(weight, F.col(id_column), whole_text(text), seed=seed),
        }
    )
    cut = matched(keyed, stage(cuts, "mix-cuts"), ["_of"], "inner")
    times = F.col("_epochs") + F.when(F.col("_key") <= F.col("_cut"), 1).otherwise(0)
    again = F.explode(F.array_repeat(F.lit(0), times.cast("int")))
    return cut.withColumn("_again", again).select(*[F.col(f"`{name}`") for name in docs.columns])
