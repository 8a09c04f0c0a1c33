"""Spelling variants, lexical search and certified rules against brute force, with edge cases."""

import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from conftest import LONG, ODD_ROWS, PROSE, SF_DIR
from pyspark.sql import functions as F

from pricelab.llm import lexical_search, quality_rules, rule_stats, spelling
from pricelab.llm.queries import queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- spelling ----------------------------------------------------------------


def words_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 3}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def near_words(words):
    near, buckets = defaultdict(set), defaultdict(set)
    for word in words:
        for i in range(len(word) + 1):
            buckets[word[:i] + word[i + 1 :]].add(word)
        buckets[word].add(word)
    for group in buckets.values():
        for a in group:
            near[a] |= {b for b in group if a != b and is_near(a, b)}
    return near


def variants(words):
    near, forms = near_words(words), {}
    for word, n in words.items():
        best = min(near[word], key=lambda w: (-words[w], w.encode()), default=None)
        forms[word] = best if best is not None and words[best] >= 2 * n else None
    want = set()
    for word, n in words.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        form = forms[word]
        want.add((word, form, root, n, len(near[word]), None if form is None else words[form]))
    return want


def spelled(frame):
    rows = spelling.spelling_variants(frame).collect()
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def test_op11(spark, texts):
    rows = queries()["op11_spelling_variants"](spark, SF_DIR).collect()
    want = variants(words_of(texts))
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == want
    assert len(rows) == len(want) and sum(r.form is not None for r in rows) > 50


def test_spelling_of_odd_rows(odd, nothing):
    assert spelled(odd) == variants(words_of([row[:2] for row in ODD_ROWS]))
    assert spelling.spelling_variants(nothing).collect() == []


def test_spelling_by_few_letters(spark):
    """Many near words, chains of forms, ties, repeats and letters beyond ASCII."""
    draw = np.random.default_rng(4)
    rows = []
    for i in range(400):
        words = ["".join(draw.choice(list("abÀé×"), draw.integers(4, 8))) for _ in range(40)]
        rows.append((i % 390, "-".join(words + words[:20] * int(draw.integers(0, 4)))))
    chain = "abcdefgh abcdefgi abcdefji abcdekji abcdlkji".split()
    rows.append((1000, " ".join(" ".join([w] * 3**i) for i, w in enumerate(chain, 1))))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = variants(words_of(rows))
    assert spelled(frame) == want
    roots = {word: root for word, _, root, *_ in want}
    assert roots["abcdefgh"] == "abcdlkji" and len(want) > 500


def test_acceptor_is_minimal_and_composes():
    words = ["tap", "taps", "top", "tops", "tip", "stop", "a" * 3000, "a" * 3001, "b" + "a" * 2999]
    acceptor = spelling.Acceptor(words[:5])
    # After the first two letters, tap and top go on alike and tip does not.
    assert len(acceptor.final) == 6 and acceptor.language(acceptor.start) == sorted(words[:5])
    got = spelling.Acceptor(words).near_pairs()
    assert {tuple(sorted(p)) for p in got} == {
        tuple(sorted((a, b))) for a in words for b in words if a < b and is_near(a, b)
    }
    assert spelling.Acceptor([]).near_pairs() == set()


# ---- search ------------------------------------------------------------------


def ranked(docs, items):
    def terms(text):
        return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]

    found = [(i, Counter(terms(text))) for i, text in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, n_terms = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    want = Counter()
    for item_id, text in items:
        own, scored = set(terms(text)), []
        for i, counts in found:
            m = 100 - 90 + (90 * counts.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t in own & counts.keys()
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (less, null, i) in enumerate(sorted(scored)[:10], 1):
            want[item_id, rank, None if null else i, -less] += 1
    return want


def searched(docs, items):
    return Counter(map(tuple, lexical_search.ranked_search(docs, items).collect()))


def test_op12(spark, texts):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    got = queries()["op12_norm_bucket_search"](spark, SF_DIR).collect()
    want = ranked(texts, [(r.item_id, r.text) for r in items])
    assert Counter(map(tuple, got)) == want and want.total() > 50


ITEMS = [(1, PROSE), (2, None), (3, "..."), (4, "nowhere zebra"), (None, "école RIVER"), (4, "word7 tail"), (5, "the Σας a")]


def test_search_of_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns(
        {name: F.lit("own") for name in ("query", "score", "_row", "doc_id", "terms")}
    )
    assert searched(odd, items) == ranked([row[:2] for row in ODD_ROWS], ITEMS)
    assert searched(nothing, items) == searched(odd, items.where("false")) == Counter()


def test_search_with_seeds_blocks_and_buckets(spark, monkeypatch):
    """Small limits: thresholds from few documents, several blocks, many buckets, ties."""
    monkeypatch.setattr(lexical_search, "SEED_ROWS", 40)
    monkeypatch.setattr(lexical_search, "BUCKET_ROWS", 16)
    monkeypatch.setattr(lexical_search, "BLOCK_QUERIES", 7)
    draw = np.random.default_rng(5)
    names = [f"t{i}" for i in range(300)]
    rank = 1 / np.arange(1, 301)
    docs = [
        (int(i), " ".join(draw.choice(names, draw.integers(1, 60), p=rank / rank.sum())))
        for i in draw.permutation(1500)
    ]
    docs += [(2000 + i, docs[i % 3][1]) for i in range(60)]
    items = [(i, " ".join(draw.choice(names, draw.integers(1, 12)))) for i in range(20)]
    items += [(20, docs[0][1]), (21, "t0")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert searched(frame, spark.createDataFrame(items, "item_id long, text string")) == ranked(docs, items)


def test_buckets_prune_and_lose_nothing():
    draw = np.random.default_rng(6)
    n, width = 3000, 200
    own = [np.unique(draw.integers(0, width, 6)) for _ in range(12)]
    weights = np.arange(1, width + 1) * 40
    search = lexical_search.Queries(own, weights, n, n * 20)
    rows = []
    for i in range(n):
        at = np.unique(draw.integers(0, width, draw.integers(1, 25)))
        values = weights[at] * draw.integers(1, 900_000 if i % 50 else 3_000_000, len(at))
        rows.append((i, i, at, values, math.sqrt((values.astype(float) ** 2).sum())))
    table = pd.DataFrame(rows, columns=["_id", "_row", "terms", "values", "_length"])
    table = table.sort_values("_length", ascending=False).drop(columns="_length").reset_index(drop=True)
    scored, buckets = 0, [table[i : i + 250] for i in range(0, n, 250)]
    best = lexical_search.Best(np.zeros(12, np.int64))
    for batch in buckets:
        bucket = lexical_search.Bucket(search, batch)
        scored += sum(bucket.search(q, best) for q in range(12))
    whole = lexical_search.search_buckets(iter(buckets), search, np.zeros(12, np.int64))
    for q, terms in enumerate(own):
        every = sorted((-int(v[np.isin(t, terms)].sum()), False, i, i) for i, _, t, v in table.itertuples(index=False))
        assert best.rows[q] == whole.rows[q] == every[:10]
    assert scored < 0.4 * 12 * n


# ---- rules -------------------------------------------------------------------


def counts_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def test_counts_of_texts(spark, texts):
    draw = np.random.default_rng(8)
    more = [" ".join(draw.choice(list("abcd"), draw.integers(0, 40))) for _ in range(200)]
    more += ["a a a", "a b c a b c", "x\t\ty\x0b\n\n z\r\nz\n z\n \n", "", LONG, "a b c " * 3 + "c a b c"]
    rows = list(enumerate([text for _, text in texts] + more))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = frame.select("doc_id", rule_stats.statistics(F.col("text")).alias("s")).select("doc_id", "s.*")
    got = {r.doc_id: tuple(r[name] for name in quality_rules.COUNTS) for r in found.collect()}
    assert got == {i: counts_of(text) for i, text in rows}


@pytest.mark.parametrize("share", [0.05, 0.3])
def test_binomial_tail_is_exact(spark, share):
    pairs = [(n, k) for n in (0, 1, 7, 60, 400) for k in range(0, int(n * share) + 2)]
    frame = spark.createDataFrame(pairs, "n long, k long")
    exact = Fraction(share)
    for r in frame.select("n", "k", quality_rules.binomial_tail("n", "k", share).alias("p")).collect():
        tail = sum(math.comb(r.n, i) * exact**i * (1 - exact) ** (r.n - i) for i in range(r.k + 1))
        assert r.p == 1 if r.k >= r.n * share else r.p == pytest.approx(float(tail), rel=1e-9)
    large = spark.range(1).selectExpr("2000000L AS n", "99000L AS k")
    p = large.select(quality_rules.binomial_tail("n", "k", 0.05)).first()[0]
    z = (99000 + 0.5 - 100000) / math.sqrt(2000000 * 0.05 * 0.95)
    assert p == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), rel=0.05)


def documents_with_labels(n, draw):
    """In stratum a, bad texts have symbols; in b they do not differ; c has few labels."""
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        stratum = None if i % 40 == 39 else "ab"[i % 2] if i % 41 else "c"
        words = ["".join(draw.choice(list("abcdefgh"), draw.integers(3, 8))) for _ in range(60)]
        if draw.random() < 0.01 or bad and stratum == "a":
            words[::4] = ["##" + w for w in words[::4]]
        rows.append((i, " ".join(words), stratum))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def certified(rows, labels, most_false, error):
    """The stratum's cutoffs by plain Python, of the same risks."""
    import hashlib

    label, strata = dict(labels), defaultdict(list)
    for i, text, stratum in rows:
        n_words, word_chars, n_symbols, n_dup, n_repeat = counts_of(text)
        if n_words < 50 or 100 * n_repeat > 50 * n_words:
            continue
        words = text.split()
        risks = [
            -word_chars / n_words, word_chars / n_words, n_symbols / n_words, n_dup / n_words,
            n_repeat / n_words, -len(set(words)) / n_words, sum(c.isupper() for c in text) / len(text),
        ]
        choosing = hashlib.md5(str(i).encode()).hexdigest()[0] < "6"
        strata[stratum].append((risks, label[i] > 0, choosing))
    found, tails = {}, quality_rules.TAILS
    for stratum, known in strata.items():
        rules = []
        for r in range(7):
            good = sorted(x[r] for x, is_good, choosing in known if choosing and is_good)
            cuts = [good[max(1, math.ceil(len(good) * (1 - t))) - 1] for t in tails]
            of = {
                q: np.mean([x[r] > cuts[-1] for x, is_good, choosing in known if choosing and is_good == q])
                for q in (True, False)
            }
            rules.append(cuts if of[False] > 2 * of[True] else None)
        best = None
        for j in range(len(tails)):
            def out(x):
                return any(c is not None and x[r] > c[j] for r, c in enumerate(rules))

            holdout = [out(x) for x, is_good, choosing in known if is_good and not choosing]
            k, n, p = sum(holdout), len(holdout), most_false
            tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            if k >= n * p or tail > error / len(strata):
                break
            gain = np.mean([out(x) for x, g, c in known if c and not g]) - np.mean(
                [out(x) for x, g, c in known if c and g]
            )
            if gain > 0 and (best is None or gain > best[0] + 1e-12):
                best = (gain, [None if c is None else c[j] for c in rules])
        if best:
            found[stratum] = best[1]
    return found


def test_cutoffs_come_from_all_labels(spark):
    n = 250_000
    risks = ", ".join(f"pmod(xxhash64(id, {r}), {10 ** (r + 1)}) / 7D" for r in range(7))
    rows = spark.range(n).selectExpr(
        "id AS _id", "if(id % 50 = 1, NULL, 'a') AS _stratum", "false AS base_failed", f"array({risks}) AS _risks"
    )
    marks = spark.range(n).selectExpr("id AS doc_id", "cast(id % 5 > 0 AS int) AS quality")
    known = quality_rules.labelled(rows, marks, "doc_id", "quality")
    assert known.count() == n
    good = known.where("_good AND _choosing")
    by_rule = good.selectExpr("_stratum", "posexplode(_risks) AS (_rule, _risk)")
    got = {(r["_stratum"], r["_rule"]): r["_levels"] for r in quality_rules.cutoff_levels(by_rule).collect()}
    assert len(got) == 14
    table = good.toPandas()
    for stratum, own in table.groupby("_stratum", dropna=False):
        values = np.sort(np.stack(own["_risks"]), axis=0)
        at = [max(1, math.ceil(len(values) * (1 - tail))) - 1 for tail in quality_rules.TAILS]
        for rule in range(7):
            assert got[stratum if isinstance(stratum, str) else None, rule] == values[at, rule].tolist()


def test_certified_cutoffs(spark):
    rows, labels = documents_with_labels(4000, np.random.default_rng(9))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, quality int")
    measured = quality_rules.stage(quality_rules.measured(docs, "doc_id", "text", "lang"), "measured")
    got = {r["_stratum"]: r["_cutoffs"] for r in quality_rules.fit_cutoffs(measured, marks).collect()}
    want = certified(rows, labels, quality_rules.MOST_FALSE, quality_rules.ERROR)
    assert got == want and "a" in want and None not in want and "c" not in want
    judged = {r.doc_id: r for r in quality_rules.quality_rules(docs, marks).collect()}
    label = dict(labels)
    good = [judged[i].kept for i, _, s in rows if s == "a" and label[i]]
    bad = [judged[i].kept for i, _, s in rows if s == "a" and not label[i]]
    assert np.mean(good) > 1 - quality_rules.MOST_FALSE and not any(bad)
    assert all(judged[i].kept != judged[i].base_failed for i, _, s in rows if s == "c" or s is None)


def test_rules_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(None, 1), (3, None), (4, 1), (4, 0)], "doc_id long, quality int")
    got = quality_rules.quality_rules(odd, labels).collect()
    want = Counter()
    for doc_id, text, _ in ODD_ROWS:
        counts = counts_of(text or "")
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        want[doc_id, *counts, failed, not failed] += 1
    assert Counter(map(tuple, got)) == want
    assert quality_rules.quality_rules(nothing, labels.where("false")).collect() == []
    assert len(quality_rules.quality_rules(odd, labels.where("false")).collect()) == len(ODD_ROWS)
