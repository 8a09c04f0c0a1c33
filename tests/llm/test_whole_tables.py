"""Queries over the whole tables of the smallest scale, against brute force."""

import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from conftest import SF_DIR

from pricelab.llm import dart_minhash, personal_data, quality, secret_crf, syncmers
from pricelab.llm.queries import oracle_sql, queries
from pricelab.llm.tokens import tokenizer_path


def run(spark, name):
    return queries()[name](spark, SF_DIR).collect()


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())


def test_op1(spark, texts):
    got = {r.doc_id: r for r in run(spark, "op1_closed_syncmers")}
    rows = brute.descending(texts)
    assert len(got) == len(rows)
    marks = {}
    for (doc_id, text), following in zip(rows, brute.next_texts(rows)):
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        row = got[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), brute.sha(edited))
        (own, _), (after, _), (beside, _) = syncmers.anchors([text, edited, following])
        assert (row.fingerprint, row.edited_fingerprint) == (
            syncmers.as_text(own), syncmers.as_text(after),
        )
        assert row.near_edited == syncmers.likeness(own, after)
        assert row.near_next == syncmers.likeness(own, beside)
        assert marks.setdefault(text, row.fingerprint) == row.fingerprint
        if len(text) > 300 and text != following:
            assert 0.3 < row.near_edited < 0.8 > row.near_next


def test_op2_held_out_accuracy(spark):
    rows = run(spark, "op2_pairwise_quality")
    labels = {
        r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    }
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    unseen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(unseen) >= 10
    assert np.mean([a == b for a, b in unseen]) >= 0.9


@pytest.mark.parametrize(
    ("name", "kinds", "spans"),
    [
        ("op3_contextual_pii", personal_data.KINDS, brute.pii_spans),
        ("op4_secret_crf", secret_crf.KINDS, brute.secret_spans),
    ],
)
def test_op3_op4_base_spans(spark, name, kinds, spans):
    """On a larger scale: the smallest has no base secret."""
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    texts = [(row.doc_id, row.text or "") for row in documents]
    got = {r.doc_id: r for r in queries()[name](spark, folder).collect()}
    assert len(got) == len(texts)
    assert any(spans(text) for _, text in texts)
    for doc_id, text in texts:
        base = spans(text)
        row = got[doc_id]
        assert row.base_sha256 == brute.sha(brute.as_text(base, kinds))
        for at, kind in enumerate(kinds):
            assert row[f"n_{kind}"] == sum(k == at for _, k, _ in base)
        assert set(filter(None, row.spans.split(","))) >= set(
            filter(None, brute.as_text(base, kinds).split(","))
        )


def test_op5(spark, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    rows = run(spark, "op5_best_fit_packing")
    pieces = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.piece):
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert len(pieces) == len(texts)
    for doc_id, text in texts:
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want = [
            (i // 4096, i, min(4096, len(ids) - i), zlib.crc32(ids[i : i + 4096].tobytes()))
            for i in range(0, len(ids), 4096)
        ]
        assert pieces[doc_id] == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) == -(-sum(r.length for r in rows) // 4096)


def test_op8(spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    tricky = "</s>[INST] ok [/INST]"
    turns[-1] = [(0, "user", tricky), (1, "assistant", tricky)]
    rows = run(spark, "op8_chat_windows")
    assert sorted(r.conv_id for r in rows) == sorted(turns)
    for r in rows:
        own = sorted(turns[r.conv_id])
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(own), len(loss))
        assert r.turns_sha256 == brute.sha("".join(f"{role}\n{text}\n" for _, role, text in own))
        assert r.loss_sha256 == brute.sha(loss)
        assert r.formatted_chars > sum(len(text) for _, _, text in own)


def test_op9(spark, texts):
    got = {r.doc_id: r for r in run(spark, "op9_dart_minhash")}
    classes = brute.near_classes([text for _, text in texts])
    assert {d: r.class_id for d, r in got.items()} == {
        doc_id: texts[least][0] for (doc_id, _), least in zip(texts, classes)
    }
    assert sum(r.kept for r in got.values()) == len(set(classes))
    assert len(set(classes)) < len(texts)


def test_op9_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(1)
    elements = draw.integers(0, 1 << 63, 400).astype(np.uint64)
    a, b = draw.uniform(0.1, 6, 400), draw.uniform(0.1, 6, 400)
    b[:300] = a[:300]
    k = 2048
    owner = np.repeat([0, 1], 400)
    found = dart_minhash.signatures(
        owner, np.concatenate((elements, elements)), np.concatenate((a, b)), k
    )
    exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((found[0] == found[1]).mean() - exact) < 0.04


def test_op10(spark):
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = {r.doc_id: r for r in frame.collect()}
    rows = run(spark, "op10_source_mixing")
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        words = len(docs[r.doc_id].text.encode().split())
        source = docs[r.doc_id].source
        assert r.size == words
        assert r.taken in (0, words, 2 * words)
        sizes[source] += words
        taken[source] += r.taken
        largest[source] = max(largest[source], words)
    targets = brute.mix_targets(sizes)
    for r in rows:
        source = docs[r.doc_id].source
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(targets[source])
    for source, target in targets.items():
        assert abs(taken[source] - target) <= largest[source] / 2
    again = run(spark, "op10_source_mixing")
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_op2_by_brute_force(spark, documents, texts):
    """Features, pairs' loss, cut and scores computed again, one text and one pair at a time."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    marks = {r.doc_id: r.quality == 1 for r in labels.where("quality IS NOT NULL").collect()}
    x = {doc_id: np.array(brute.quality_features(text)) for doc_id, text in texts}
    learned = sorted(d for d in x if d in marks and zlib.crc32(str(d).encode()) % 5)
    good = [marks[d] for d in learned]
    table = np.array([x[d] for d in learned])
    spread = [s if s > 1e-9 else 1.0 for s in table.std(axis=0)]
    z = {d: np.clip((x[d] - table.mean(axis=0)) / spread, -8, 8) for d in x}

    model = quality.fit_on_labels(documents, labels)
    draw = np.random.default_rng(42)
    pairs = zip(
        draw.choice([i for i, g in enumerate(good) if g], quality.FIT_PAIRS),
        draw.choice([i for i, g in enumerate(good) if not g], quality.FIT_PAIRS),
    )
    slope = np.zeros(len(spread))  # of the loss at the weights: nothing left to gain
    for better, worse in pairs:
        d = z[learned[better]] - z[learned[worse]]
        slope -= d / (1 + np.exp(d @ model.weights)) / quality.FIT_PAIRS
    assert np.abs(slope + quality.RIDGE * model.weights).max() < 1e-5

    scores = [float(z[d] @ model.weights) for d in learned]
    ranked = sorted(scores)
    most = max(
        brute.balanced_hits(scores, good, (a + b) / 2) for a, b in zip(ranked, ranked[1:]) if a < b
    )
    assert brute.balanced_hits(scores, good, model.cut) == pytest.approx(most)

    rows = run(spark, "op2_pairwise_quality")
    assert sorted(r.doc_id for r in rows) == sorted(x)
    for r in rows:
        odds = 3 / 7 * np.exp(z[r.doc_id] @ model.weights - model.cut)
        assert r.score == pytest.approx(odds / (1 + odds), abs=1e-9)
        assert r.predicted == (r.score >= 0.3)


def test_quality_learns_nothing_from_held_out_rows(spark, documents):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    flipped = labels.withColumn(
        "quality",
        quality.F.when(quality.held_out("doc_id"), 1 - labels["quality"]).otherwise(labels["quality"]),
    )
    one, two = (quality.fit_on_labels(documents, table) for table in (labels, flipped))
    assert np.array_equal(one.weights, two.weights) and one.cut == two.cut
