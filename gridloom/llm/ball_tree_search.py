"""Ranked lexical search: the documents with the greatest inner products with each item, by sparse ball trees."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import internal, materialize

#: Documents of one ball tree, and of one leaf.
TREE_DOCS, LEAF_DOCS = 4096, 16
#: Groups of terms, each with a radius of its own.
TERM_GROUPS = 1024
#: Bytes of item texts that are searched for in one pass: bounds what is broadcast. More items are dealt into more passes.
PASS_BYTES = 16 << 20
#: A bound is raised by this share and by one, over a thousand times what sums of doubles can lose here.
SAFE = 1e-9

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, lower-cased A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


class Items:
    """The items of a pass as sparse rows over their own terms: `weights` by term and `places` of the terms' numbers."""

    def __init__(self, texts: list[str | None]):
        self.vocabulary: dict[bytes, int] = {}
        counts = [Counter(terms(t)) for t in texts]
        self.cols = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in c], np.int64) for c in counts]
        self.times = [np.fromiter(c.values(), np.int64, len(c)) for c in counts]

    def weighed(self, n_docs: int, df: np.ndarray) -> list[np.ndarray]:
        """For each item the whole-number weights of its terms, repeats included."""
        w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        return [w[c] * t for c, t in zip(self.cols, self.times, strict=True)]


class Tree:
    """A ball tree over sparse rows (begins, cols, vals), each ball with its centroid's products with all items and radii.

    Terms are dealt into groups, and a ball has a radius in each: an item of a few dozen terms meets the radii of its own
    groups alone. One radius over thousands of terms would be so great that it rules nothing out.
    """

    def __init__(self, begins: np.ndarray, cols: np.ndarray, vals: np.ndarray, n_terms: int, items: tuple[np.ndarray, np.ndarray, np.ndarray], leaf: int = LEAF_DOCS, groups: int = TERM_GROUPS):
        self.begins, self.cols, self.vals, self.n_terms, self.leaf = begins, cols, vals.astype(np.float64), n_terms, leaf
        self.groups = max(1, min(groups, n_terms))
        self.item_begins, self.item_cols, self.item_weights = items
        self.squares = self._sums(self.vals**2, begins)
        self.docs, self.children, self.products, self.radii = [], [], [], []
        self._ball(np.arange(len(begins) - 1))

    @staticmethod
    def _sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Sums of the stretches from each begin to the next, each added up by itself; empty stretches are 0."""
        sums = np.add.reduceat(np.append(values, values.dtype.type(0)), begins[:-1])
        sums[begins[1:] == begins[:-1]] = 0
        return sums

    def rows(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begins, cols, vals) of some documents."""
        sizes = self.begins[docs + 1] - self.begins[docs]
        begins = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(begins[-1]) + np.repeat(self.begins[docs] - begins[:-1], sizes)
        return begins, self.cols[at], self.vals[at]

    def _ball(self, docs: np.ndarray) -> int:
        begins, cols, vals = self.rows(docs)
        center = np.bincount(cols, weights=vals, minlength=self.n_terms) / len(docs)
        cell = np.repeat(np.arange(len(docs)) * self.groups, np.diff(begins)) + cols % self.groups
        by_group = lambda values: np.bincount(cell, weights=values, minlength=len(docs) * self.groups).reshape(len(docs), self.groups)
        own = np.bincount(np.arange(self.n_terms) % self.groups, weights=center**2, minlength=self.groups)
        away = by_group(vals * (vals - 2 * center[cols]))
        number = len(self.radii)
        self.docs.append(docs)
        self.children.append(())
        self.products.append(self._sums(center[self.item_cols] * self.item_weights, self.item_begins))
        # a difference of squares loses digits: radii are raised by more than the greatest of them can lose
        self.radii.append(np.sqrt(np.maximum(away.max(axis=0) + own, 0) + SAFE * (by_group(vals**2).max(axis=0) + own)))
        if len(docs) > self.leaf:
            one, other = (np.zeros(self.n_terms) for _ in range(2))
            far = int(np.argmax(away.sum(axis=1)))
            one[cols[begins[far] : begins[far + 1]]] = vals[begins[far] : begins[far + 1]]
            from_one = self.squares[docs] - 2 * self._sums(one[cols] * vals, begins)
            far = int(np.argmax(from_one))
            other[cols[begins[far] : begins[far + 1]]] = vals[begins[far] : begins[far + 1]]
            side = np.argsort(self._sums((one - other)[cols] * vals, begins), kind="stable")
            half = len(docs) // 2
            del cols, vals, one, other, away, cell
            self.children[number] = (self._ball(docs[np.sort(side[:half])]), self._ball(docs[np.sort(side[half:])]))
        return number

    def bounds(self) -> np.ndarray:
        """balls x items: whole numbers that no inner product of a ball's documents with the item exceeds."""
        of = np.repeat(np.arange(len(self.item_begins) - 1), np.diff(self.item_begins))
        squares = np.bincount(of * self.groups + self.item_cols % self.groups, weights=self.item_weights.astype(np.float64) ** 2, minlength=(len(self.item_begins) - 1) * self.groups)
        norms = np.sqrt(squares.reshape(-1, self.groups))
        return np.floor((np.stack(self.products) + np.stack(self.radii) @ norms.T) * (1 + SAFE)) + 1


def _searched(tree: Tree, keys: list, exact: np.ndarray, best: list[list], top: int, bound: np.ndarray) -> int:
    """Adds a tree's documents to the `top` best of each item; how many documents were scored.

    best[q] is a heap of (score, reversed key), the worst first. Balls are taken best-first; once the best bound is below
    the worst of `top` scores, no other ball can hold a better or equal one. Leaves are scored in whole numbers.
    """
    leaves: dict[int, tuple] = {}
    scored = 0
    for q, heap in enumerate(best):
        a, b = tree.item_begins[q], tree.item_begins[q + 1]
        if a == b:
            continue
        weight = np.zeros(tree.n_terms, np.int64)
        weight[tree.item_cols[a:b]] = tree.item_weights[a:b]
        of = bound[:, q]
        open_ = [(-of[0], 0)]
        while open_:
            most, ball = heapq.heappop(open_)
            if len(heap) == top and -most < heap[0][0]:
                break
            if tree.children[ball]:
                for child in tree.children[ball]:
                    heapq.heappush(open_, (-of[child], child))
                continue
            if ball not in leaves:
                docs = tree.docs[ball]
                begins, cols, _ = tree.rows(docs)
                sizes = tree.begins[docs + 1] - tree.begins[docs]
                leaves[ball] = begins, cols, exact[np.arange(begins[-1]) + np.repeat(tree.begins[docs] - begins[:-1], sizes)]
            begins, cols, vals = leaves[ball]
            scores = Tree._sums(weight[cols] * vals, begins)
            scored += len(scores)
            least = heap[0][0] if len(heap) == top else 1
            for i in np.flatnonzero(scores >= max(least, 1)).tolist():
                entry = (int(scores[i]), keys[tree.docs[ball][i]])
                if len(heap) < top:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
    return scored


class _Key:
    """Place of a document among equal scores: the greater key is the earlier document, one without an id the last."""

    __slots__ = ("id", "row")

    def __init__(self, id_: object, row: int):
        self.id, self.row = id_, row

    def __lt__(self, other: _Key) -> bool:
        if self.id == other.id:
            return self.row > other.row
        return self.id is None or (other.id is not None and self.id > other.id)


def _vectors(frame: DataFrame, items: object) -> DataFrame:
    """(_id, _row, _n, _t, _tf): documents with at least one term; all terms' number, and the counts of items' terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = items.value.vocabulary.get
        for batch in batches:
            ids, rows, texts = batch.columns
            out = []
            for i in range(batch.num_rows):
                words = terms(texts[i].as_py())
                if words:
                    found = Counter(map(number, words))
                    found.pop(None, None)
                    out.append((i, len(words), list(found), list(found.values())))
            at, n, t, tf = zip(*out, strict=True) if out else [()] * 4
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(at), rows.take(at), pa.array(n, pa.int64()), pa.array(t, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32()))], names=["_id", "_row", "_n", "_t", "_tf"])

    kind = frame.schema["_id"].dataType.simpleString()
    return frame.withColumn("_row", F.monotonically_increasing_id()).select("_id", "_row", "_text").mapInArrow(count, f"_id {kind}, _row bigint, _n bigint, _t array<int>, _tf array<int>")


def _pass(frame: DataFrame, texts: list[str | None], top: int, tree_docs: int) -> DataFrame:
    """(_q, _id, _row, _score): for each item of a pass, by its number, the `top` best documents of every task."""
    spark = frame.sparkSession
    items = Items(texts)
    vectors = materialize(_vectors(frame, spark.sparkContext.broadcast(items)), "search-vectors")
    n_docs, total = (int(x or 0) for x in vectors.agg(F.count("*"), F.sum("_n")).first())
    df = np.zeros(len(items.vocabulary), np.int64)
    for term, n in vectors.select(F.explode("_t").alias("t")).groupBy("t").count().collect():  # as many as the pass's items have terms
        df[term] = n
    weights = items.weighed(n_docs, df)
    cols = np.concatenate(items.cols) if items.cols else np.zeros(0, np.int64)
    packed = (np.concatenate(([0], np.cumsum(np.array([len(c) for c in items.cols], np.int64)))), cols, np.concatenate(weights) if weights else cols)
    model = spark.sparkContext.broadcast((packed, len(df), n_docs, total))
    kind = vectors.schema["_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, n_terms, n_docs, total = model.value
        best: list[list] = [[] for _ in range(len(packed[0]) - 1)]
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("_id").type
            for a in range(0, batch.num_rows, tree_docs):
                part = batch.slice(a, tree_docs)
                t, tf = part.column(3), part.column(4)
                begins = np.asarray(t.offsets).astype(np.int64)
                cols, tf = (np.asarray(x.flatten()).astype(np.int64) for x in (t, tf))
                m = 100 - 25 + 25 * part.column(2).to_numpy() * n_docs // total
                exact = 1_000_000_000 * tf // (1000 * tf + 12 * np.repeat(m, np.diff(begins)))
                tree = Tree(begins - begins[0], cols, exact, n_terms, packed)
                keys = [_Key(i, r) for i, r in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                _searched(tree, keys, exact, best, top, tree.bounds())
        if id_type is not None:
            rows = [(q, k.id, k.row, s) for q, heap in enumerate(best) for s, k in heap]
            q, ids, docs, scores = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(ids, id_type), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], names=["_q", "_id", "_row", "_score"])

    return vectors.mapInArrow(search, f"_q int, _id {kind}, _row bigint, _score bigint")


def search(docs: DataFrame, items: DataFrame, top: int = 20, pass_bytes: int = PASS_BYTES, tree_docs: int = TREE_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each item with the highest scores above 0.

    Terms are runs of digits, letters and characters beyond ASCII in text lower-cased A-Z. N documents have terms, L with
    repeats; df of them hold a term, which weighs w = floor(1000 ln((2N + 2) / (2df + 1))); a document with n terms has
    m = 75 + (25 n N) div L; it scores the sum over the item's terms, repeats included, of w ((10^9 tf) div (1000 tf +
    12 m)). Equal scores go by ascending doc_id.

    A score is an inner product: of an item's weights and a document's whole numbers, over the items' terms alone, as no
    other term scores. Every task builds ball trees over its documents and searches each for all items, best ball first;
    a ball whose bound, centroid's product plus radii times the item's lengths by group of terms, rounded up, is below the
    item's present last place holds nothing better. Leaves are scored in whole numbers. Each task gives its own best, and those of all
    tasks are ranked for each item. Items come in passes of up to pass_bytes of text, so what is broadcast is bounded.

    Null and empty texts have no terms: such a document is never found, such an item finds nothing. Every row of items is
    an item of its own, also with a repeated or null id; repeated rows of docs are documents of their own, and documents
    without an id come last among equal scores. Empty tables give empty ones.
    """
    frame, _ = internal(docs, id="doc_id", text="text")
    asked, _ = internal(items, item="item_id", text="text")
    frame, asked = frame.select("_id", "_text"), asked.select("_item", "_text")
    spark = docs.sparkSession
    size = asked.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    passes = max(1, ceil(size / pass_bytes))
    kind = asked.schema["_item"].dataType.simpleString()
    found = None
    for k in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("_item", "_text"), F.lit(passes)) == k).collect()
        names = spark.createDataFrame([(q, r["_item"]) for q, r in enumerate(rows)], f"_q int, _item {kind}")
        best = _pass(frame, [r["_text"] for r in rows], top, tree_docs)
        order = Window.partitionBy("_q").orderBy(F.col("_score").desc(), F.col("_id").asc_nulls_last(), "_row")
        ranked = best.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top).join(names, "_q")
        told = ranked.select(F.col("_item").alias("item_id"), F.col("_rank").alias("rank"), F.col("_id").alias("doc_id"), F.col("_score").alias("score"))
        found = told if found is None else found.unionByName(told)
    return found
