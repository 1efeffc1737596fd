"""Periodic runs, substring dedup and ranked search against brute force, and on rows that are easy to get wrong."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import ball_tree_search, periodic_runs, substring_dedup
from gridloom.llm.queries import QUERIES

from .test_operators import DOCS, WORD, clashing, given, lowered, odd_docs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


# ---- 11


def brute_runs(w):
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            if i > s and length >= max(6, 4 * q) and not any(all(w[s + j] == w[s + j + d] for j in range(length - d)) for d in range(1, q)):
                out.add((s, length, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    milli = 1000 * top[1] // top[2] if runs else None
    return doc_id, len(runs), *top, milli, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))


def test_runs_of_random_words():
    rnd = random.Random(5)
    for _ in range(400):
        docs = []
        for _ in range(rnd.randint(1, 4)):
            w = []
            for _ in range(rnd.randint(0, 6)):
                letters = "abcdefgh"[: rnd.choice([1, 2, 3, 8])]
                w += [rnd.choice(letters).encode() for _ in range(rnd.randint(1, rnd.choice([3, 9, 30])))] * rnd.choice([1, 2, 4, 5, 9])
                w = w[: len(w) - rnd.randint(0, 3)]
            docs.append(w)
        found = [[(r["start"], r["length"], r["period"]) for r in x[1]] for x in periodic_runs._block(docs)]
        assert found == [brute_runs(w) for w in docs]


def test_few_diagonals_are_open():
    for words, most in (([b"w"] * 40_000, 1), (([b"w"] * 1000 + [b"x"]) * 40, 2), ([b"a", b"b"] * 20_000, 1)):
        _, at = np.unique(words, return_inverse=True)
        places, _ = periodic_runs.openings(at.astype(np.int64), len(words))
        assert np.bincount(places).max() <= most


def test_runs_of_all_documents(spark, sf):
    found = {r["doc_id"]: tuple(r) for r in QUERIES["op11_sparse_diagonal_runs"](spark, sf).collect()}
    rows = [(i, t) for i, t in given(sf) if len(WORD.findall(t or "")) < 3000]
    assert len(found) == len(given(sf)) and len(rows) > 0.9 * len(found)
    assert [found[i] for i, _ in rows] == [brute_row(i, t) for i, t in rows]
    assert sum(f[1] > 0 for f in found.values()) > 5


def test_runs_of_odd_rows(spark):
    docs, data = odd_docs(spark)
    found = periodic_runs.periodic_runs(clashing(docs))
    assert {"n_words", "runs", "strongest", "collapsed", "Fingerprint"} < set(found.columns)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    got = sorted(((r["doc_id"], r["text"], r["n_words"], [(x["start"], x["length"], x["period"]) for x in r["runs"]], r["collapsed"]) for r in found.collect()), key=key)
    for (i, text, n, runs, collapsed), (j, own) in zip(got, sorted((r[:2] for r in data), key=key), strict=True):
        w = WORD.findall(own or "")
        expected = [(0, 40_000, 1)] if len(w) > 40_000 else brute_runs(w)
        gone = {k for s, length, q in expected for k in range(s + q, s + length)}
        assert (i, text, n, runs, collapsed) == (j, own, len(w), expected, " ".join(x for k, x in enumerate(w) if k not in gone))
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


# ---- 12


def brute_dedup(rows, window=20):
    """rows of (doc_id, text), in the order in which they count."""
    seen, out = {}, []
    words = [WORD.findall(t or "") for _, t in rows]
    for d, w in enumerate(words):
        for i in range(len(w) - window + 1):
            seen.setdefault(tuple(w[i : i + window]), (d, i))
    for d, w in enumerate(words):
        gone = {k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] != (d, i) for k in range(i, i + window)}
        out.append((rows[d][0], len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_dedup_of_all_documents(spark, sf):
    found = sorted(map(tuple, QUERIES["op12_count_min_substring_dedup"](spark, sf).collect()))
    assert found == [(*r[:3], sha(r[3])) for r in brute_dedup(sorted(given(sf)))]


@pytest.mark.parametrize(("part_bytes", "block_bits"), [(1 << 10, 23), (1 << 12, 6)])
def test_no_repeat_is_lost_whatever_the_sketch(spark, part_bytes, block_bits):
    """Small parts, and a sketch of so few cells for so many windows that nearly all are overestimated."""
    rnd = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(80):
        w = [f"w{rnd.randint(0, 40)}" for _ in range(rnd.randint(0, 90))]
        if i % 3 == 0:
            at = rnd.randint(0, len(w))
            w[at:at] = passage[rnd.randint(0, 20) : rnd.randint(45, 60)]
        rows.append((i, " ".join(w + (w[:30] if i % 7 == 0 else [])), "en", None, 0))
    docs = spark.createDataFrame([*rows, *[(100 + i, rows[5][1], None, None, None) for i in range(20)]], DOCS).repartition(5)
    found = sorted(map(tuple, substring_dedup.without_repeats(docs, part_bytes=part_bytes, block_bits=block_bits).collect()))
    assert found == brute_dedup(sorted((r["doc_id"], r["text"]) for r in docs.collect()))


def test_dedup_of_odd_rows(spark):
    docs, data = odd_docs(spark)
    found = substring_dedup.without_repeats(clashing(docs)).collect()
    assert found[0].__fields__ == ["doc_id", "n_words", "n_removed", "kept"]
    order = sorted((r[:2] for r in data), key=lambda r: (r[0] is None, r[0] or 0))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    assert sorted(map(tuple, found), key=key) == sorted(brute_dedup(order), key=key)
    assert substring_dedup.without_repeats(docs.limit(0)).count() == 0


def test_dedup_shuffles_texts_once(spark, sf):
    found = substring_dedup.without_repeats(spark.read.parquet(f"{sf}/documents.parquet"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange [_id") == 2


# ---- 13


def brute_search(docs, items, top=20):
    split = [(i, Counter(t)) for i, t in ((i, TERM.findall(lowered(t))) for i, t in docs) if t]
    n_docs, total, df = len(split), sum(sum(c.values()) for _, c in split), Counter(w for _, c in split for w in c)
    w = {x: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for x, d in df.items()}
    out = []
    for item, text in items:
        asked, scores = Counter(TERM.findall(lowered(text))), []
        for i, c in split:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(k * w[x] * (10**9 * c[x] // (1000 * c[x] + 12 * m)) for x, k in asked.items() if x in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:top], 1)]
    return out


def by_rank(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0))


def test_search_of_odd_rows(spark):
    docs, data = odd_docs(spark)
    items = [(1, "One two SAME text"), (2, None), (3, ""), (None, "wörter ünïcode mit mit"), (4, "word word einmalig"), (4, "nothing of it"), (5, "a b c d")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("rank", F.lit("clash"))
    expected = by_rank(brute_search([r[:2] for r in data], items))
    assert by_rank(ball_tree_search.search(clashing(docs), bench).collect()) == expected
    assert by_rank(ball_tree_search.search(docs, bench, pass_bytes=16, tree_docs=3).collect()) == expected
    assert ball_tree_search.search(docs.limit(0), bench).count() == 0 and ball_tree_search.search(docs, bench.limit(0)).count() == 0


def test_ties_go_by_id(spark):
    docs = spark.createDataFrame([(i, "red green blue" if i % 2 else "red red green", None, None, None) for i in range(60, 0, -1)] + [(99, "other words", None, None, None)], DOCS).repartition(3)
    items = [(7, "red"), (8, "blue green")]
    found = ball_tree_search.search(docs, spark.createDataFrame(items, "item_id bigint, text string"), tree_docs=7).collect()
    assert by_rank(found) == by_rank(brute_search([(r["doc_id"], r["text"]) for r in docs.collect()], items))


def test_bounds_hold_and_prune():
    rnd = np.random.default_rng(4)
    n, v, q = 3000, 200, 30
    group = rnd.integers(0, 60, n)
    rows = [np.unique(np.concatenate([(g * 3 + np.arange(3)) % v, rnd.integers(0, v, 2)])) for g in group]
    begins, cols = np.concatenate(([0], np.cumsum([len(r) for r in rows]))), np.concatenate(rows)
    vals = rnd.integers(1, 1_000_000, len(cols))
    asked = [rnd.choice(v, 4, replace=False) for _ in range(q)]
    packed = (np.arange(0, 4 * q + 1, 4), np.concatenate(asked), rnd.integers(1, 13_000, 4 * q))
    tree = ball_tree_search.Tree(begins, cols, vals, v, packed)
    whole = np.zeros((n, v), np.int64)
    whole[np.repeat(np.arange(n), np.diff(begins)), cols] = vals
    weights = np.zeros((q, v), np.int64)
    weights[np.repeat(np.arange(q), 4), packed[1]] = packed[2]
    scores, bounds = whole @ weights.T, tree.bounds()
    assert all((scores[docs].max(axis=0) <= bounds[ball]).all() for ball, docs in enumerate(tree.docs))
    best = [[] for _ in range(q)]
    scored = ball_tree_search._searched(tree, [ball_tree_search._Key(i, i) for i in range(n)], vals, best, 20, bounds)
    for k, heap in enumerate(best):
        order = sorted(range(n), key=lambda i: (-scores[i, k], i))[:20]
        assert [(s, key.id) for s, key in sorted(heap, key=lambda e: (-e[0], e[1].id))] == [(scores[i, k], i) for i in order if scores[i, k] > 0]
    assert scored < 0.7 * n * q


# ---- 10, rows that share an id


@pytest.mark.parametrize("kind", ["null", "seven", "same rows"])
def test_mix_of_rows_that_share_an_id(spark, kind):
    from gridloom.llm import mixing

    text = lambda i: " ".join(f"w{i}x{j}" for j in range(10)) if kind != "same rows" else "one two three four five six seven eight nine ten"
    data = [(None if kind == "null" else 7, text(i), "en", f"s{i % 3}", 0) for i in range(3000)]
    docs = spark.createDataFrame(data, DOCS).repartition(6).cache()
    rows = mixing.mix(docs).collect()
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
    targets = {r["source"]: r["target"] for r in rows}
    assert sum(taken.values()) <= 45_000 and all(abs(taken[s] - t) <= 20 for s, t in targets.items())
    assert max(r["times"] for r in rows) <= 2 and mixing.mixed(docs).count() == sum(r["times"] for r in rows)


def test_intermediates_are_removed_on_a_failure(spark):
    from gridloom.llm import common

    with pytest.raises(KeyError):
        with common.intermediates(spark):
            common.materialize(spark.range(3), "kept")
            path = common._written[-1]
            raise KeyError
    assert not spark._jvm.java.io.File(path).exists()


# ---- 7, many edits


def test_edits_of_random_batches():
    from gridloom.llm import token_counts

    tok, rnd = token_counts.tokenizer(token_counts.VOCABULARY, token_counts.PATTERN), random.Random(11)
    piece = lambda n: "".join(rnd.choice(["a", "b", " ", "  ", "\n", "x1", "'s", "x'll", "l", "'", "é", "!!", "  \n ", "12"]) for _ in range(rnd.randint(0, n)))
    for _ in range(600):
        tree = token_counts.CountTree(piece(60), tok, rnd.choice([1, 2, 3, 8]))
        for _ in range(3):
            text = tree.text
            edits = [{"start": rnd.randint(0, len(text) + 1), "length": rnd.choice([0, 1, 2, 9]), "replacement": piece(3)} for _ in range(rnd.randint(0, 8))]
            tree.edit_all(edits)
            assert tree.text == token_counts.edited(text, edits) and tree.n_tokens == len(tok.encode(tree.text))
            assert sum(tree.leaves[0]) == len(tree.text) and sum(tree.leaves[1]) == tree.n_tokens


def test_many_edits_encode_little():
    from gridloom.llm import token_counts

    tok = token_counts.tokenizer(token_counts.VOCABULARY, token_counts.PATTERN)
    tree = token_counts.CountTree("word " * 8000, tok)
    for i in range(2000):
        tree.edit(tree.n_chars, 0, f" tail{i}")
    assert tree.encoded < 20 * tree.n_chars and max(map(len, tree.parts)) < 2 * 64 * 8
    for _ in range(200):
        tree.edit(1000, 0, "more words here ")
    before = tree.encoded
    tree.edit(1000, 0, "x")
    assert tree.encoded - before < 1000
    text = " ".join(f"user{i}@mail.example.org wrote" for i in range(5000))
    tree = token_counts.CountTree(text, tok)
    tree.edit_all([{"start": m.start(), "length": m.end() - m.start(), "replacement": "[removed]"} for m in re.finditer(token_counts.ADDRESS, text)])
    assert tree.encoded <= len(tree.text) and tree.n_tokens == len(tok.encode(tree.text))
