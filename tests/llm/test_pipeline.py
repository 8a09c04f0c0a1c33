"""Each stage of the pipeline against a brute-force form, on what the stage before kept."""

from collections import Counter, defaultdict

import brute
import corpus_pipeline
import pytest
from conftest import SF_DIR

from pricelab.llm import mixing, quality
from pricelab.plans.staging import stage


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF_DIR), name)
        found.append(docs)
    return found


def rows(frame):
    return sorted(map(tuple, frame.select(corpus_pipeline.COLUMNS).collect()))


def test_stages_keep_the_columns(results):
    assert [f.columns for f in results[:-1]] == [corpus_pipeline.COLUMNS] * 5
    assert len({str(f.schema) for f in results[:-1]}) == 1


def test_quality_filter(spark, results):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.fit_on_labels(results[0], labels)
    kept = {
        r.doc_id for r in quality.quality_scores(results[0], model).collect() if r.score >= 0.3
    }
    assert rows(results[1]) == [row for row in rows(results[0]) if row[0] in kept]
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(good & kept) >= 0.97 * len(good) and len(bad & kept) <= 0.1 * len(bad)


def test_line_deduplication(results):
    before, after = rows(results[1]), {row[0]: row for row in rows(results[2])}
    texts = brute.kept_lines([row[1] for row in before])
    for old, text in zip(before, texts):
        if text == old[1] or text.strip(" \n\t\r"):
            assert after[old[0]] == (old[0], text, *old[2:4], len(text))
        else:
            assert old[0] not in after
    assert len(after) <= len(before)


def test_near_deduplication(results):
    before = rows(results[2])
    classes = brute.near_classes([row[1] for row in before])
    assert rows(results[3]) == [before[i] for i in sorted(set(classes))]


def test_source_mixing(spark, results):
    scored = corpus_pipeline.with_quality(spark, results[3], SF_DIR)
    assert scored.where("score >= 0.3").count() > 0.9 * scored.count()
    mixed = mixing.mix_sources(scored, weight=mixing.score_weight("score"))
    taken = {r.doc_id: (r.taken, r["size"]) for r in mixed.collect()}
    times = Counter(row[0] for row in rows(results[4]))
    before = {row[0]: row for row in rows(results[3])}
    for doc_id, (words, size) in taken.items():
        assert times[doc_id] * size == words
    assert set(rows(results[4])) <= set(before.values())


def test_sequences_decode_to_the_mixed_texts(results):
    """Sequence by sequence and place by place, the ids are those of the mixed rows, in order."""
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from pricelab.llm.tokens import tokenizer_path

    whole = Tokenizer.from_file(tokenizer_path())
    sequences, pieces = defaultdict(bytes), results[5].collect()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert len(sequences[p.sequence_id]) == 4 * p.offset and zlib.crc32(p.ids) == p.ids_crc32
        sequences[p.sequence_id] += p.ids
    copies = defaultdict(bytes)
    for p in sorted(pieces, key=lambda p: p.start):
        assert len(copies[p.doc_id, p.copy]) == 4 * p.start
        at = 4 * p.offset
        copies[p.doc_id, p.copy] += sequences[p.sequence_id][at : at + 4 * p.length]
    assert len({copy for _, copy in copies}) == len(copies) == results[4].count()
    known = {}
    want = Counter()
    for row in rows(results[4]):
        if row[1] not in known:
            known[row[1]] = np.array([*whole.encode(row[1], add_special_tokens=False).ids, 1], "<u4").tobytes()
        want[row[0], known[row[1]]] += 1
    assert Counter((doc_id, ids) for (doc_id, _), ids in copies.items()) == want
    assert max(want.values()) > 1


def test_sequence_packing(results):
    pieces = results[5].collect()
    documents = Counter(row[0] for row in rows(results[4]))
    assert Counter(p.doc_id for p in pieces if p.piece == 0) == documents
    fill = defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill[p.sequence_id]
        fill[p.sequence_id] += p.length
    assert max(fill.values()) <= 4096
    assert len(fill) == -(-sum(fill.values()) // 4096)


def test_run_equals_the_stages(spark, results):
    assert corpus_pipeline.ORACLE_SQL is None
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF_DIR).select(names).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, results[5].select(names).collect()))


def test_odd_documents_pass_all_stages(spark, odd):
    docs = odd
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF_DIR), name)
    assert docs.count() > 0


def test_no_documents(spark, nothing):
    docs = nothing
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF_DIR), name)
    assert docs.collect() == []
