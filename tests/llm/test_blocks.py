"""Large buckets of near copies, cut into blocks."""

import random

import pytest

from pricelab.llm import dart_minhash

MEMBERS = "_key long, _row long, _class long, _chars long"


def test_op9_one_outsider_adds_few_copies(spark, monkeypatch):
    monkeypatch.setattr(dart_minhash, "BLOCK_CHARS", 1_000)
    for n in (200, 400):
        rows = [(1, i, 7, 100) for i in range(n)] + [(1, 9_000, 8, 100)] + [(2, i, i % 3, 100) for i in range(6)]
        dealt = dart_minhash.dealt_members(spark.createDataFrame(rows, MEMBERS)).collect()
        large = [r for r in dealt if r["_key"] == 1]
        # Each copy of the class once; the outsider with each of their blocks, and with its own.
        assert sum(r["_class"] == 7 for r in large) == n
        assert sum(r["_class"] == 8 for r in large) == n // 10 + 1
        assert sum(r["_key"] == 2 for r in dealt) == 6
    assert dart_minhash.dealt_members(spark.createDataFrame([], MEMBERS)).count() == 0


@pytest.mark.parametrize("block", [500_000, 700, 150])
def test_op9_blocks_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(dart_minhash, "BLOCK_CHARS", block)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    texts, members = [], []
    for key in range(4):
        kinds = [[rng.choice(words) for _ in range(40)] for _ in range(5)]
        for place in range(30):
            kind = rng.randrange(5)
            text = list(kinds[kind])
            text[rng.randrange(40)] = rng.choice(words)
            row = key * 100 + place
            texts.append((row, " ".join(text)))
            # A third is known to be one class; the others are not known to be linked.
            known = kind == 0 and place % 3
            members.append((key, row, key * 100 + 99 if known else row, len(texts[-1][1])))
    members_frame = spark.createDataFrame(members, MEMBERS)
    found = dart_minhash.links_in_buckets(members_frame, spark.createDataFrame(texts, "_row long, _text string"), 0.8)
    text_of, class_of = dict(texts), {row: c for _, row, c, _ in members}

    def shingles(text):
        split = text.split()
        return {tuple(split[i : i + 5]) for i in range(len(split) - 4)}

    def near(a, b):
        x, y = shingles(text_of[a]), shingles(text_of[b])
        return len(x & y) >= 0.8 * len(x | y)

    def classes(pairs):
        label = {c: c for c in class_of.values()}
        for a, b in pairs:
            old, new = label[class_of[a]], label[class_of[b]]
            label = {c: new if at == old else at for c, at in label.items()}
        groups = {}
        for c, at in label.items():
            groups.setdefault(at, set()).add(c)
        return {frozenset(g) for g in groups.values()}

    got = [(r["_a"], r["_b"]) for r in found.collect()]
    assert all(near(a, b) and class_of[a] != class_of[b] for a, b in got)
    everything = [(a, b) for ka, a, _, _ in members for kb, b, _, _ in members if ka == kb and a < b and near(a, b)]
    assert classes(got) == classes(everything)
    assert any(class_of[a] != class_of[b] for a, b in everything)
