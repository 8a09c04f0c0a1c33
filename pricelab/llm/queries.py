"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.llm import (
    chat,
    chat_digest,
    content_sort,
    dart_minhash,
    lexical_search,
    line_dedup,
    mixing,
    packing,
    personal_data,
    quality,
    quality_rules,
    secret_crf,
    spelling,
    syncmers,
)
from pricelab.llm.inputs import read
from pricelab.llm.spans import digests

Query = Callable[[SparkSession, str], DataFrame]


def op1_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_pairs(read(spark, sf_dir, "documents"))


def op2_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit_on_labels(docs, read(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model)


def op3_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(read(spark, sf_dir, "documents"))
    return digests(found, personal_data.KINDS)


def op4_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = secret_crf.secrets(docs, secret_crf.fit_on_base(docs))
    return digests(found, secret_crf.KINDS)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.document_pieces(read(spark, sf_dir, "documents"))
    narrow = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack_pieces(narrow)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated_lines(read(spark, sf_dir, "documents"))


OP6_SQL = r"""
    WITH split AS (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
    ), numbered AS (
        SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS no FROM split
    ), ordered AS (
        SELECT *, regexp_replace(line, '[\x09-\x0D]', ' ', 'g') AS plain,
               row_number() OVER (ORDER BY doc_id NULLS LAST, no) AS place
        FROM numbered
    ), firsts AS (
        SELECT line, plain, string_split(plain, ' ') AS words, min(place) AS first
        FROM ordered WHERE trim(plain) <> '' GROUP BY line, plain
    ), units AS (
        SELECT *, len(words) >= 8 AS by_words,
               CASE WHEN len(words) >= 8 THEN len(words) ELSE length(plain) END AS n
        FROM firsts WHERE len(words) >= 8 OR length(plain) >= 24
    ), cuts AS (
        SELECT by_words, first, spot,
               CASE WHEN by_words
                    THEN array_to_string(list_concat(words[:spot - 1], words[spot + 1:]), ' ')
                    ELSE plain[:spot - 1] || plain[spot + 1:] END AS rest
        FROM (SELECT *, unnest(range(1, n + 1)) AS spot FROM units)
    ), near AS (
        SELECT first FROM (
            SELECT first, min(first) OVER (PARTITION BY by_words, spot, rest) AS earliest FROM cuts
        ) WHERE earliest < first
        UNION
        SELECT greatest(c.first, u.first)
        FROM cuts c JOIN units u ON c.rest = u.plain AND c.by_words = u.by_words
    ), gone AS (
        SELECT o.place FROM ordered o JOIN firsts f ON o.line = f.line AND o.place > f.first
        UNION
        SELECT first FROM near
    )
    SELECT o.doc_id, coalesce(string_agg(o.line, chr(10) ORDER BY o.no)
                                  FILTER (WHERE g.place IS NULL), '') AS text,
           count(*) AS n_lines, count(g.place) AS n_dropped
    FROM ordered o LEFT JOIN gone g ON o.place = g.place
    GROUP BY o.doc_id
"""


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_duplicates(read(spark, sf_dir, "documents"))


OP7_SQL = """
    WITH texts AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS norm
        FROM documents
    ), placed AS (
        SELECT doc_id, norm, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) AS place
        FROM texts WINDOW w AS (PARTITION BY norm)
    )
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256
    FROM placed
"""


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    tricky = "</s>[INST] ok [/INST]"
    own = spark.sql(
        "SELECT -1L AS conv_id, n AS turn, if(n = 0, 'user', 'assistant') AS role, :text AS text"
        " FROM (SELECT explode(array(0L, 1L)) AS n)",
        args={"text": tricky},
    )
    names = ["conv_id", "turn", "role", "text"]
    return chat_digest.read_back(chat.chat_windows(conversations.select(names).unionByName(own)))


def op9_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_classes(read(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights are the quality scores that op2 learns."""
    docs = read(spark, sf_dir, "documents")
    model = quality.fit_on_labels(docs, read(spark, sf_dir, "labels"))
    scored = quality.quality_scores(docs, model, keep=["source"])
    return mixing.mix_sources(scored, weight=mixing.score_weight("score"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


def op12_norm_bucket_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return lexical_search.ranked_search(documents, items)


OP12_SQL = r"""
    WITH found AS (
        SELECT doc_id, row_number() OVER () AS no,
               regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), occurrences AS (
        SELECT doc_id, no, len(terms) AS n,
               translate(unnest(terms), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
        FROM found
    ), counted AS (
        SELECT doc_id, no, n, term, count(*) AS tf FROM occurrences GROUP BY ALL
    ), sizes AS (
        SELECT count(*) AS docs, sum(len(terms)) AS words FROM found WHERE len(terms) > 0
    ), frequencies AS (SELECT term, count(*) AS df FROM counted GROUP BY term),
    queries AS (
        SELECT DISTINCT item_id, translate(
            unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
        FROM benchmark
    ), weighted AS (
        SELECT item_id, term,
               cast(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
        FROM queries JOIN frequencies USING (term), sizes
    ), scores AS (
        SELECT item_id, no, doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * docs) // words))))) AS score
        FROM counted JOIN weighted USING (term), sizes GROUP BY item_id, no, doc_id
    ), ranked AS (
        SELECT item_id, doc_id, cast(score AS BIGINT) AS score,
               row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, no) AS rank
        FROM scores WHERE score > 0
    )
    SELECT item_id, cast(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op13_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality_rules.quality_rules(documents, labels)


OP13_TAILS = ", ".join(map(str, quality_rules.TAILS))
OP13_LEVELS = len(quality_rules.TAILS)
OP13_RULES = len(quality_rules.RISKS)
OP13_SQL = rf"""
    WITH texts AS (
        SELECT row_number() OVER () AS no, doc_id, lang, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), windows AS (
        SELECT no, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT no, w, unnest(range(1, len(w) - 1)) AS i FROM texts WHERE len(w) >= 3)
    ), twice AS (
        SELECT no, i FROM windows QUALIFY count(*) OVER (PARTITION BY no, a, b, c) > 1
    ), repeated AS (
        SELECT no, count(DISTINCT i + o) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) t(o) GROUP BY no
    ), dup AS (
        SELECT no, count(*) - count(DISTINCT line) AS n_dup_lines
        FROM (SELECT no, unnest(string_split(text, chr(10))) AS line FROM texts)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY no
    ), counts AS (
        SELECT no, doc_id, lang, len(w) AS n_words, length(text) AS n_chars,
               length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
               len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
               coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
               len(list_distinct(w)) AS n_distinct, len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals
        FROM texts LEFT JOIN dup USING (no) LEFT JOIN repeated USING (no)
    ), measured AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               CASE WHEN n_words > 0 THEN [{", ".join(quality_rules.RISKS.values())}] END AS risks
        FROM counts
    ), known AS (
        SELECT m.no, lang, risks, good, left(md5(doc_id::varchar), 1) < '6' AS choosing
        FROM measured m
        JOIN (SELECT DISTINCT doc_id, quality > 0 AS good FROM labels WHERE quality IS NOT NULL) USING (doc_id)
        WHERE NOT base_failed
    ), by_rule AS (
        SELECT *, unnest(range(1, {OP13_RULES} + 1)) AS rule, unnest(risks) AS risk FROM known
    ), levels AS (
        SELECT lang, rule, [sorted[greatest(ceil(n * (1::DOUBLE - t)), 1)::INTEGER]
                           FOR t IN [{OP13_TAILS}]::DOUBLE[]] AS cuts
        FROM (SELECT lang, rule, list_sort(list(risk)) AS sorted, count(*) AS n
              FROM by_rule WHERE choosing AND good GROUP BY lang, rule)
    ), telling AS (
        SELECT l.lang, l.rule, cuts,
               coalesce(avg((risk > cuts[{OP13_LEVELS}])::INT) FILTER (WHERE NOT good)
                        > {quality_rules.TELLS} * avg((risk > cuts[{OP13_LEVELS}])::INT) FILTER (WHERE good),
                        false) AS used
        FROM levels l JOIN by_rule b ON l.lang IS NOT DISTINCT FROM b.lang AND l.rule = b.rule
        WHERE choosing GROUP BY l.lang, l.rule, cuts
    ), first_levels AS (
        SELECT k.no, k.lang, good, choosing,
               min(CASE WHEN used THEN len([c FOR c IN cuts IF k.risks[t.rule] <= c]) ELSE {OP13_LEVELS} END)
                   AS level
        FROM known k JOIN telling t ON k.lang IS NOT DISTINCT FROM t.lang
        GROUP BY k.no, k.lang, good, choosing
    ), summed AS (
        SELECT lang, j AS level, count(*) FILTER (WHERE good AND NOT choosing) AS n,
               count(*) FILTER (WHERE good AND NOT choosing AND level <= j) AS k,
               count(*) FILTER (WHERE good AND choosing AND level <= j)
                   / greatest(count(*) FILTER (WHERE good AND choosing), 1) AS good_share,
               count(*) FILTER (WHERE NOT good AND choosing AND level <= j)
                   / greatest(count(*) FILTER (WHERE NOT good AND choosing), 1) AS bad_share
        FROM first_levels, range({OP13_LEVELS}) r(j) GROUP BY lang, j
    ), tested AS (
        SELECT *, CASE WHEN k >= n * {quality_rules.MOST_FALSE} THEN 1
            ELSE list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({quality_rules.MOST_FALSE})
                               + (n - i) * ln(1 - {quality_rules.MOST_FALSE})) FOR i IN range(k + 1)]) END AS p
        FROM summed
    ), certified AS (
        SELECT *, bool_and(p <= {quality_rules.ERROR} / (SELECT count(DISTINCT coalesce(lang, '?')) FROM telling))
                      OVER (PARTITION BY lang ORDER BY level) AS certain
        FROM tested
    ), best AS (
        SELECT lang, level FROM (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY good_share - bad_share, level) AS place
            FROM certified WHERE certain) WHERE place = 1 AND bad_share > good_share
    ), rejected AS (
        SELECT DISTINCT m.no FROM measured m
        JOIN best b ON m.lang IS NOT DISTINCT FROM b.lang
        JOIN telling t ON m.lang IS NOT DISTINCT FROM t.lang
        WHERE used AND m.risks[t.rule] > cuts[level + 1]
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
           n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND r.no IS NULL AS kept
    FROM measured m LEFT JOIN rejected r ON m.no = r.no
"""


def queries() -> dict[str, Query]:
    return {
        "op1_closed_syncmers": op1_closed_syncmers,
        "op2_pairwise_quality": op2_pairwise_quality,
        "op3_contextual_pii": op3_contextual_pii,
        "op4_secret_crf": op4_secret_crf,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_line_dedup": op6_line_dedup,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_chat_windows": op8_chat_windows,
        "op9_dart_minhash": op9_dart_minhash,
        "op10_source_mixing": op10_source_mixing,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_norm_bucket_search": op12_norm_bucket_search,
        "op13_certified_rules": op13_certified_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_line_dedup": OP6_SQL,
        "op7_exact_dedup": OP7_SQL,
        "op12_norm_bucket_search": OP12_SQL,
        "op13_certified_rules": OP13_SQL,
    }
