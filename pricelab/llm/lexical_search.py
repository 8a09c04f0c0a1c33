"""Ranked lexical search by buckets of impact vectors of like length (LEMP).

A document is a sparse vector of weighted impacts, over the terms of a block of queries; a
query is 1 at its terms, so a score is an inner product. Threshold of a query is the
score of its tenth best document so far.

1. One scan counts what scores need and keeps, per document, its query terms.
2. Vectors are ordered by length, the largest first; each batch is a bucket. A bucket whose
   largest length times the query's is below the threshold cannot hold a result
   (Cauchy-Schwarz), and from then on no later bucket can.
3. Inside a bucket, the largest value of each coordinate bounds what it can add. Coordinates
   whose bounds together stay below the threshold need not be looked at: a result has one of
   the others, the focus. What a document has there, plus the product of the lengths of the
   two rests, bounds its score.
4. Survivors are scored exactly, in 64-bit integers.

Thresholds start from the documents of the largest lengths, which are searched first; so a
task hands on few rows that are not results. Bounds are in doubles with some slack, and ties
are never pruned.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelab.llm.inputs import arrow_batches, chunks, small_batches, whole_text
from pricelab.plans.staging import stage

BEST = 10
#: Queries of a block, and characters of their texts; documents are scanned once per block.
BLOCK_QUERIES = 2_000
BLOCK_CHARS = 4_000_000
#: Documents of the largest lengths that thresholds start from, about.
SEED_ROWS = 2_000
#: Documents of a bucket.
BUCKET_ROWS = 2_000
#: Bounds are raised by this share, far above what doubles round.
SLACK = 1e-9

#: Bytes of terms: letters and digits, and all beyond ASCII; others part them.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def terms(text: str) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def term_rows(rows: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """_id, _row, n, terms, counts of documents with a term; terms only those of the vocabulary."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in chunks(batches):
            sizes, places, counts = [], [], []
            for text in batch["text"]:
                found = terms(text)
                known = Counter(map(vocabulary.get, found))
                known.pop(None, None)
                at = sorted(known)
                sizes.append(len(found))
                places.append(at)
                counts.append([known[t] for t in at])
            done = batch.drop(columns="text").assign(n=sizes, terms=places, counts=counts)
            yield done[done["n"] > 0]

    safe = rows.withColumn("_id", F.col("_id").cast("string"))
    found = safe.mapInPandas(
        run, "_id string, _row long, n long, terms array<int>, counts array<long>"
    )
    return found.withColumn("_id", F.col("_id").cast("long"))


@dataclass(frozen=True)
class Queries:
    """A block of queries, each the places of its terms, and the weights of all terms."""

    terms: list[np.ndarray]
    weights: np.ndarray
    n_documents: int
    n_terms: int

    def impacts(self, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of terms that occur ``counts`` times in documents of ``n`` terms."""
        m = 10 + (90 * n * self.n_documents) // self.n_terms
        return (1_000_000_000 * counts) // (1_000 * counts + 8 * m)


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def impact_vectors(counted: DataFrame, queries: Queries) -> DataFrame:
    """_id, _row, terms, values (weighted impacts), _length, of documents with a query's term."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sizes = batch["terms"].str.len().to_numpy()
            term, count = (np.concatenate(list(batch[name])).astype(np.int64) for name in ("terms", "counts"))
            value = queries.weights[term] * queries.impacts(np.repeat(batch.pop("n"), sizes).to_numpy(), count)
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            squares = np.add.reduceat(value.astype(float) ** 2, bounds[:-1])
            values = [value[a:b] for a, b in zip(bounds, bounds[1:])]
            yield batch.drop(columns="counts").assign(values=values, _length=np.sqrt(squares))

    safe = counted.where("size(terms) > 0").withColumn("_id", F.col("_id").cast("string"))
    found = safe.mapInPandas(
        run, "_id string, _row long, terms array<int>, values array<long>, _length double"
    )
    return found.withColumn("_id", F.col("_id").cast("long"))


class Best:
    """The best documents of each query so far, in order."""

    def __init__(self, thresholds: np.ndarray) -> None:
        self.thresholds = thresholds.copy()  # a lower score is no result
        self.rows: list[list[tuple]] = [[] for _ in thresholds]  # -score, id is NULL, id, row

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        least = max(1, self.thresholds[query])
        if len(scores) > BEST:
            least = max(least, np.partition(scores, -BEST)[-BEST])
        own = self.rows[query]
        for at in np.flatnonzero(scores >= least).tolist():
            own.append((-int(scores[at]), ids[at] is None, int(ids[at] or 0), int(rows[at])))
        if len(own) >= BEST:
            own.sort()
            del own[BEST:]
            self.thresholds[query] = max(self.thresholds[query], -own[-1][0])


class Bucket:
    """Documents of like length: their coordinates by term, and what bounds them."""

    def __init__(self, queries: Queries, batch: pd.DataFrame) -> None:
        self.queries = queries
        self.rows = batch["_row"].to_numpy()
        self.ids = batch["_id"].astype(object).where(batch["_id"].notna(), None).to_numpy()
        owner = np.repeat(np.arange(len(batch)), batch["terms"].str.len())
        term = np.concatenate(list(batch["terms"])).astype(np.int64)
        value = np.concatenate(list(batch["values"])).astype(np.int64)
        order = np.argsort(term, kind="stable")
        self.owner, self.value = owner[order], value[order]
        self.starts = np.searchsorted(term[order], np.arange(len(queries.weights) + 1))
        self.most = np.zeros(len(queries.weights))
        np.maximum.at(self.most, term, value)
        self.squares = np.bincount(owner, value.astype(float) ** 2, len(batch))
        self.length = math.sqrt(self.squares.max())

    def entries(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents with a term, and its values there."""
        at = slice(self.starts[term], self.starts[term + 1])
        return self.owner[at], self.value[at]

    def search(self, query: int, best: Best) -> int:
        """Offer what may be a result; how many documents were scored."""
        own, least = self.queries.terms[query], best.thresholds[query]
        bounds = self.most[own]
        order = np.argsort(bounds, kind="stable")
        # The longest run of small bounds that stays below the threshold is no focus.
        rest = int(np.searchsorted(np.cumsum(bounds[order]) * (1 + SLACK), least, side="left"))
        seen, left = np.zeros(len(self.rows)), self.squares.copy()
        for term in own[order[rest:]].tolist():
            owner, value = self.entries(term)
            seen[owner] += value
            left[owner] -= value.astype(float) ** 2
        bound = seen + math.sqrt(rest) * np.sqrt(np.maximum(left, SLACK * self.squares))
        at = np.flatnonzero((seen > 0) & (bound * (1 + SLACK) >= least))
        if len(at):
            scores = np.zeros(len(self.rows), np.int64)
            for term in own.tolist():
                owner, value = self.entries(term)
                scores[owner] += value
            best.offer(query, scores[at], self.ids[at], self.rows[at])
        return len(at)


def search_buckets(
    batches: Iterator[pd.DataFrame], queries: Queries, thresholds: np.ndarray
) -> Best:
    """The best documents of each query among batches in descending order of length."""
    best = Best(thresholds)
    lengths = np.sqrt([len(own) for own in queries.terms])
    left = np.arange(len(lengths))  # queries that a later bucket may still have results of
    for batch in batches:
        if not len(batch) or not len(left):
            continue
        bucket = Bucket(queries, batch)
        left = left[lengths[left] * bucket.length * (1 + SLACK) >= best.thresholds[left]]
        for query in left.tolist():
            bucket.search(query, best)
    return best


def searched(vectors: DataFrame, queries: Queries, thresholds: np.ndarray) -> DataFrame:
    """query, rank, doc_id, score: the best documents of each query."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = search_buckets(batches, queries, thresholds)
        found = [
            (query, -less, row, None if is_null else str(doc_id))
            for query, rows in enumerate(best.rows)
            for less, is_null, doc_id, row in sorted(rows)
        ]
        yield pd.DataFrame(found, columns=["query", "score", "_row", "doc_id"])

    safe = vectors.sortWithinPartitions(F.desc("_length")).drop("_length")
    found = (
        safe.withColumn("_id", F.col("_id").cast("string"))
        .mapInPandas(run, "query int, score long, _row long, doc_id string")
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )
    order = Window.partitionBy("query").orderBy(
        F.desc("score"), F.col("doc_id").asc_nulls_last(), "_row"
    )
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)
    return ranked.select("query", "rank", "doc_id", "score")


def block_results(rows: DataFrame, texts: list[str]) -> DataFrame:
    """query (place in ``texts``), rank, doc_id, score."""
    spark = rows.sparkSession
    vocabulary: dict[bytes, int] = {}
    own = []
    for text in texts:
        found = dict.fromkeys(terms(text))
        own.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in found], np.int64))
    counted = stage(term_rows(rows, vocabulary), "search-terms")
    n_documents, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most one row per term of the block.
    df = dict(counted.select(F.explode("terms").alias("_t")).groupBy("_t").count().collect())
    weights = [weight(n_documents, df.get(t, n_documents)) for t in range(len(vocabulary))]
    queries = Queries(own, np.array(weights, np.int64), n_documents, max(1, n_terms))
    vectors = stage(impact_vectors(counted, queries), "search-vectors")
    thresholds = np.zeros(len(texts), np.int64)
    with arrow_batches(spark, BUCKET_ROWS):
        n_vectors = vectors.count()
        if n_vectors > SEED_ROWS:
            share = 1 - SEED_ROWS / n_vectors
            long = vectors.agg(F.percentile_approx("_length", share, 10_000)).first()[0]
            seeds = searched(vectors.where(F.col("_length") >= long), queries, thresholds)
            for query, score in seeds.where(F.col("rank") == BEST).select("query", "score").collect():
                thresholds[query] = score
        return stage(searched(vectors, queries, thresholds), "search-results")


def query_blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[list]:
    """(_id, _text) rows of the queries, in blocks of bounded size (or one query)."""
    block, chars = [], 0
    for item in items.select(
        F.col(id_column).alias("_id"), whole_text(text_column).alias("_text")
    ).toLocalIterator():
        if block and (len(block) >= BLOCK_QUERIES or chars + len(item["_text"]) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append(item)
        chars += len(item["_text"])
    if block:
        yield block


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: the ten best documents of each row of ``items``.

    * Documents of score 0 are no results, so an item without terms, or whose terms no document
      has, gives no rows. NULL texts have no terms, and such documents do not count.
    * Equal scores go by ascending id, NULL last. Rows that repeat are documents of their
      own, as repeated items are items of their own.
    * Queries are the stated set; they pass through the driver in blocks of bounded size.
    * Columns not named are not read; empty tables give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        F.col(id_column).cast("long").alias("_id"),
        F.monotonically_increasing_id().alias("_row"),
        whole_text(text_column).alias("text"),
    )
    item_type = items.select(item_column).schema[0].dataType
    names = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", item_type)])
    results = [
        block_results(rows, [item["_text"] for item in block])
        .join(spark.createDataFrame([(q, item["_id"]) for q, item in enumerate(block)], names), "query")
        .select("item_id", "rank", "doc_id", "score")
        for block in query_blocks(items, item_column, item_text_column)
    ]
    if not results:
        return spark.createDataFrame([], f"item_id {item_type.simpleString()}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, results)
