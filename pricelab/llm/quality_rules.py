"""Quality rules whose cutoffs are certified on labelled holdouts.

A rule rejects a text whose risk, one of ``RISKS``, is above a cutoff. Cutoffs come in
levels: level j has for every rule the value that a share ``TAILS[j]`` of good texts exceeds,
so levels only get stricter. Labelled texts that pass the base rules are in two folds:

* The first chooses: the cutoffs of each level, per stratum; which rules tell good from
  bad there; and how many good and bad texts each level rejects.
* The second certifies: of its n good texts in a stratum a level rejects k. If the share of
  good texts that the level rejects, by any rule, were above ``MOST_FALSE``, so few would
  be seen with a probability of at most P(Binomial(n, MOST_FALSE) <= k). A level is certified
  if that is at most ``ERROR`` / number of strata, and all levels before it are. Testing in
  this fixed order needs no correction within a stratum; the division corrects for the
  strata. So with probability 1 - ``ERROR`` no stratum has a certified level that falsely
  rejects more.

Of the certified levels the first with the largest difference of shares of rejected bad
and good texts, in the choosing fold, is used; without one nothing is rejected. All steps
are DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelab.llm.inputs import matched, whole_text
from pricelab.llm.rule_stats import statistics
from pricelab.plans.staging import stage

#: Largest share of good texts of a stratum that may be rejected, and the probability with
#: which that may fail to hold in any stratum.
MOST_FALSE = 0.05
ERROR = 0.1

#: Shares of good texts beyond the cutoffs of each level, from safe to strict.
TAILS = (0.0, 0.001, 0.002, 0.003, 0.005, 0.0075, 0.01, 0.015, 0.02, 0.03)

#: A rule is used where it rejects this many times the share of bad texts as of good ones.
TELLS = 2.0

#: Base rules: fewest words, and the largest percentage of words in repeated windows.
FEWEST_WORDS = 50
MOST_REPEATED = 50

#: SQL for what rules look at, the larger the worse.
RISKS = {
    "short_words": "-word_chars / n_words",
    "long_words": "word_chars / n_words",
    "symbols": "n_symbols / n_words",
    "duplicate_lines": "n_dup_lines / n_words",
    "repeated_words": "n_repeat_words / n_words",
    "few_words": "-n_distinct / n_words",
    "capitals": "n_capitals / n_chars",
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
CHOOSING = "left(md5(cast(_id AS string)), 1) < '6'"


def measured(docs: DataFrame, id_column: str, text_column: str, stratum_column: str) -> DataFrame:
    """_id, _stratum, the counts, base_failed, _risks (NULL for texts without words)."""
    base_failed = f"n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"
    risks = ", ".join(f"cast({risk} AS double)" for risk in RISKS.values())
    return (
        docs.select(
            F.col(id_column).alias("_id"),
            F.col(stratum_column).alias("_stratum"),
            statistics(whole_text(text_column)).alias("_s"),
        )
        .select("_id", "_stratum", "_s.*")
        .selectExpr(
            "_id",
            "_stratum",
            *COUNTS,
            f"{base_failed} AS base_failed",
            f"if(n_words > 0, array({risks}), NULL) AS _risks",
        )
    )


def binomial_tail(n: str, k: str, share: float) -> Column:
    """P(Binomial(n, share) <= k); 1 where k is not below the mean, or n is 0.

    The last term comes by logarithms and the others from it by their ratios, below 1.
    """
    odds, steps = share / (1 - share), f"sequence(1L, {k})"
    log_last = (
        f"aggregate({steps}, {n} * ln(1 - {share}D),"
        f" (t, i) -> t + ln(({n} - i + 1) / i) + ln({odds}D))"
    )
    ratios = (
        f"aggregate(reverse({steps}), named_struct('term', 1D, 'sum', 1D), (s, i) ->"
        f" named_struct('term', s.term * i / (({n} - i + 1) * {odds}D),"
        f" 'sum', s.sum + s.term * i / (({n} - i + 1) * {odds}D))).sum"
    )
    first = f"exp({n} * ln(1 - {share}D))"
    return F.expr(
        f"CASE WHEN {k} >= {n} * {share}D THEN 1D WHEN {k} = 0 THEN {first}"
        f" ELSE exp({log_last}) * {ratios} END"
    )


def labelled(rows: DataFrame, labels: DataFrame, id_column: str, label: str) -> DataFrame:
    """All rows that pass the base rules and have a label: _stratum, _risks, _good, _choosing."""
    known = (
        labels.select(F.col(id_column).alias("_id"), (F.col(label) > 0).alias("_good"))
        .where("_id IS NOT NULL AND _good IS NOT NULL")
        .distinct()
    )
    return rows.where("NOT base_failed").join(known, "_id").selectExpr(
        "_stratum", "_risks", "_good", f"{CHOOSING} AS _choosing"
    )


def cutoff_levels(by_rule: DataFrame) -> DataFrame:
    """_stratum, _rule, _levels: the values of ``_risk`` that each share of ``TAILS`` exceeds.

    Exact, however many rows a stratum has: equal values are counted, the values dealt to
    ranges in their order, and of these only the ranges where a place falls are summed through.
    """
    keys = ["_stratum", "_rule"]
    values = by_rule.groupBy(*keys, "_risk").agg(F.count("*").alias("_n"))
    values = stage(
        values.repartitionByRange(*keys, "_risk").withColumn("_part", F.spark_partition_id()), "rule-values"
    )
    places = ", ".join(f"greatest(ceil(_all * (1 - {tail}D)), 1L)" for tail in TAILS)
    whole = Window.partitionBy(*keys)
    so_far = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        values.groupBy(*keys, "_part")
        .agg(F.sum("_n").alias("_in_part"))
        .withColumn("_before", F.coalesce(F.sum("_in_part").over(so_far), F.lit(0)))
        .withColumn("_all", F.sum("_in_part").over(whole))
        .withColumn("_places", F.expr(f"array({places})"))
        .where("exists(_places, p -> p > _before AND p <= _before + _in_part)")
        .select(*keys, "_part", "_before", "_places")
    )
    inside = Window.partitionBy(*keys, "_part").orderBy("_risk").rowsBetween(Window.unboundedPreceding, 0)
    return (
        matched(values, stage(parts, "rule-parts"), [*keys, "_part"], "inner")
        .withColumn("_through", F.col("_before") + F.sum("_n").over(inside))
        .select(*keys, "_risk", "_n", "_through", F.posexplode("_places").alias("_level", "_place"))
        .where("_place <= _through AND _place > _through - _n")
        .groupBy(*keys)
        .agg(F.expr("transform(sort_array(collect_list(struct(_level, _risk))), x -> x._risk)").alias("_levels"))
    )


def first_level(risk: str, cutoffs: str) -> str:
    """SQL: the first level at which a rule rejects; the number of levels if none."""
    return f"size(filter({cutoffs}, c -> {risk} <= c))"


def fit_cutoffs(
    rows: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    label_column: str = "quality",
    most_false: float = MOST_FALSE,
    error: float = ERROR,
) -> DataFrame:
    """_stratum, _cutoffs (per rule; NULL: not used), for strata with a certified level."""
    known = stage(labelled(rows, labels, id_column, label_column), "rule-labels")
    by_rule = known.select(
        "_stratum", "_good", "_choosing", F.posexplode("_risks").alias("_rule", "_risk")
    )
    levels = stage(cutoff_levels(by_rule.where("_choosing AND _good")), "rule-levels")
    # Rules that tell bad from good at their strictest.
    strict = f"_risk > _levels[{len(TAILS) - 1}]"
    telling = (
        matched(by_rule.where("_choosing"), levels, ["_stratum", "_rule"], "inner")
        .groupBy("_stratum", "_rule", "_levels")
        .agg(
            F.avg(F.expr(f"if(_good, NULL, cast({strict} AS int))")).alias("_of_bad"),
            F.avg(F.expr(f"if(_good, cast({strict} AS int), NULL)")).alias("_of_good"),
        )
        .selectExpr(
            "_stratum", "_rule", f"if(_of_bad > {TELLS} * _of_good, _levels, NULL) AS _levels"
        )
        .groupBy("_stratum")
        .agg(F.expr("transform(sort_array(collect_list(struct(_rule, _levels))), x -> x._levels)").alias("_rules"))
    )
    telling = stage(telling, "rule-cutoffs")
    # Per text the first level at which any rule in use rejects it.
    first = first_level("_risks[i]", "r")
    level = F.expr(
        f"array_min(transform(_rules, (r, i) -> if(r IS NULL, {len(TAILS)}, {first})))"
    )
    counts = (
        matched(known, telling, ["_stratum"], "inner")
        .groupBy("_stratum", "_rules", level.alias("_level"))
        .agg(
            F.expr("count_if(_good AND NOT _choosing) AS _k"),
            F.expr("count_if(_good AND _choosing) AS _good_seen"),
            F.expr("count_if(NOT _good AND _choosing) AS _bad_seen"),
        )
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(len(TAILS))))
    frame = telling.select("_stratum", "_rules", every.alias("_level"))
    counts = matched(frame, stage(counts.drop("_rules"), "rule-counts"), ["_stratum", "_level"], "left")
    upto = Window.partitionBy("_stratum").orderBy("_level")
    whole = Window.partitionBy("_stratum")
    names = ("_k", "_good_seen", "_bad_seen")
    summed = counts.select(
        "_stratum",
        "_rules",
        "_level",
        *[F.sum(F.coalesce(n, F.lit(0))).over(upto).alias(n) for n in names],
        *[F.sum(F.coalesce(n, F.lit(0))).over(whole).alias(f"{n}_all") for n in names],
    ).where(f"_level < {len(TAILS)}")
    n_strata = max(1, telling.count())
    certain = binomial_tail("_k_all", "_k", most_false) <= error / n_strata
    gain = "_bad_seen / greatest(_bad_seen_all, 1) - _good_seen / greatest(_good_seen_all, 1)"
    chosen = (
        summed.withColumn("_certified", F.bool_and(certain).over(upto))
        .where("_certified")
        .groupBy("_stratum", "_rules")
        .agg(F.expr(f"min(struct(-({gain}) AS loss, _level)) AS _best"))
        .where("_best.loss < 0")
    )
    return chosen.selectExpr("_stratum", "transform(_rules, r -> r[_best._level]) AS _cutoffs")


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum_column: str = "lang",
    label_column: str = "quality",
    **limits: float,
) -> DataFrame:
    """Per row of ``docs``: doc_id, the counts, base_failed, kept.

    * NULL and empty texts have no words: all counts are 0 and the base rules reject them.
    * NULL is a stratum of its own. Strata with too few labels to certify a level reject by
      the base rules alone. Labels with a NULL id or value are not used; a document with
      both labels counts as both.
    * Equal texts of a stratum are treated alike; repeated rows and NULL ids stay.
    * Columns not named are not read; an empty table gives no rows.
    """
    rows = stage(measured(docs, id_column, text_column, stratum_column), "rule-counts")
    cutoffs = stage(fit_cutoffs(rows, labels, id_column, label_column, **limits), "cutoffs")
    judged = matched(rows, cutoffs, ["_stratum"], "left")
    above = "exists(zip_with(_risks, _cutoffs, (risk, cut) -> coalesce(risk > cut, false)), x -> x)"
    return judged.selectExpr(
        "_id AS doc_id", *COUNTS, "base_failed", f"NOT base_failed AND NOT coalesce({above}, false) AS kept"
    )
