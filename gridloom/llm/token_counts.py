"""Edit-aware token counts: per-document segment trees over pre-tokens, re-encoded only where edits touch them."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from pathlib import Path

import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import internal, with_added

#: Vocabulary of a public byte-level BPE, as base64 token and rank on each line, and its pre-token pattern.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens of a leaf of the tree, at first.
LEAF = 64
EDIT = "array<struct<start:int,length:int,replacement:string>>"
MEMO = 500_000
#: Characters behind a pre-token on which it can depend.
LOOK = 2


class Tokenizer:
    """Counts the tokens of pre-tokens; counts of pre-tokens met before are kept."""

    def __init__(self, vocabulary: bytes, pattern: str) -> None:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        self.split = regex.compile(pattern)
        self.encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.memo: dict[str, int] = {}
        self.space = regex.compile(r"\s").match

    def count(self, piece: str) -> int:
        n = self.memo.get(piece)
        if n is None:
            n = len(self.encode(piece))
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[piece] = n
        return n

    def counts(self, pieces: list[str]) -> list[int]:
        """The tokens of each of many pre-tokens."""
        found = list(map(self.memo.get, pieces))
        return [self.count(p) if n is None else n for n, p in zip(found, pieces, strict=True)] if None in found else found


@lru_cache(2)
def made(vocabulary: bytes, pattern: str) -> Tokenizer:
    return Tokenizer(vocabulary, pattern)


@lru_cache(2)
def tokenizer(path: str, pattern: str) -> Tokenizer:
    """The tokenizer of a vocabulary file that is here."""
    return made(Path(path).read_bytes(), pattern)


class CountTree:
    """A document's leaves, each the text of some pre-tokens, under sums of characters and tokens."""

    def __init__(self, text: str, tok: Tokenizer, leaf: int = LEAF, leaves: tuple[list[int], list[int]] | None = None) -> None:
        """leaves: characters and tokens of each leaf, from a tree of the same text; nothing is encoded then."""
        self.tok, self.leaf, self.encoded = tok, leaf, 0
        if leaves is None:
            pieces = tok.split.findall(text)
            parts, tokens = self._cut(pieces, tok.counts(pieces))
        else:
            ends = list(accumulate(leaves[0]))
            parts, tokens = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)], list(leaves[1])
        self._grow(parts, tokens)

    def _cut(self, pieces: list[str], counts: list[int]) -> tuple[list[str], list[int]]:
        """Leaves of `leaf` pre-tokens each, the last one of fewer."""
        steps = range(0, len(pieces), self.leaf)
        return ["".join(pieces[i : i + self.leaf]) for i in steps], [sum(counts[i : i + self.leaf]) for i in steps]

    def _grow(self, parts: list[str], tokens: list[int]) -> None:
        """All sums over the leaves that aren't empty."""
        kept = [i for i, part in enumerate(parts) if part]
        self.parts = [parts[i] for i in kept] or [""]
        self.size = 1 << (len(self.parts) - 1).bit_length()
        pad = [0] * (self.size - len(self.parts))
        self.chars, self.tokens = ([0] * self.size + x + pad for x in (list(map(len, self.parts)), [tokens[i] for i in kept] or [0]))
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    @property
    def text(self) -> str:
        return "".join(self.parts)

    @property
    def leaves(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the leaves, but for empty ones; what is to be stored of a tree."""
        kept = [i for i in range(self.size, 2 * self.size) if self.chars[i]]
        return [self.chars[i] for i in kept], [self.tokens[i] for i in kept]

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one beyond the end), and where it begins."""
        i, begin = 1, 0
        while i < self.size:
            i *= 2
            if at >= begin + self.chars[i]:
                begin += self.chars[i]
                i += 1
        i = min(i - self.size, len(self.parts) - 1)
        return i, begin if at < self.n_chars else self.n_chars - len(self.parts[i])

    def _first(self, start: int) -> tuple[int, int]:
        """The first leaf that an edit can change, and where it begins: that of the second character before the edit, or
        of the one before the white space that the edit follows. A pre-token depends on its own characters and the next
        LOOK ones (`'` and `ll`), or on all of a run of white space and the character behind."""
        far = self._find(max(start - LOOK, 0))
        i, begin = self._find(max(start - 1, 0))
        at = start - begin
        while True:
            while at and self.tok.space(self.parts[i][at - 1]):
                at -= 1
            if at or not i:
                return min(far, (i, begin))
            i -= 1
            at, begin = len(self.parts[i]), begin - len(self.parts[i])

    def edit_all(self, edits: list[dict] | None) -> int:
        """Applies edits that are each against the present text; how many there were."""
        limit, todo, plain = self.n_chars, ordered(edits), []
        for start, length, replacement in todo:
            at = min(start, limit)
            plain.append((at, min(at + length, limit), replacement))
            limit = min(limit, start)
        self._apply([e for e in reversed(plain) if e[0] < e[1] or e[2]])
        return len(todo)

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replaces characters start .. start + length of the text as it stands."""
        start = min(max(start, 0), self.n_chars)
        end = min(start + max(length, 0), self.n_chars)
        if start < end or replacement:
            self._apply([(start, end, replacement)])

    def _apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Edits (start, end, replacement), in order and apart from each other, in one pass over the leaves they touch.

        From the first leaf that an edit can change the text is split anew until, behind the edit, a boundary falls on
        that of an old leaf: from there on all is as before, unless the next edit can change that leaf too. What was
        split becomes leaves again, none of more than twice the usual pre-tokens, so that edits at one place, however
        many, touch a leaf's text each. Sums are renewed on the paths above; all of them if there are more leaves.
        """
        changes, k = [], 0
        while k < len(edits):
            first, begin = self._first(edits[k][0])
            k, after, parts, tokens = self._resplit(edits, k, first, begin)
            changes.append((first, after, parts, tokens))
        if all(len(parts) <= after - first for first, after, parts, _ in changes):
            for first, after, parts, tokens in changes:
                for j in range(first, after):
                    new = j - first < len(parts)
                    self._set(j, parts[j - first] if new else "", tokens[j - first] if new else 0)
            return
        every, sums, at = [], [], 0
        for first, after, parts, tokens in changes:
            every += self.parts[at:first] + parts
            sums += self.tokens[self.size + at : self.size + first] + tokens
            at = after
        self._grow(every + self.parts[at:], sums + self.tokens[self.size + at : self.size + len(self.parts)])

    def _set(self, j: int, part: str, tokens: int) -> None:
        self.parts[j] = part
        i = j + self.size
        self.chars[i], self.tokens[i] = len(part), tokens
        while i > 1:
            i //= 2
            self._sum(i)

    def _resplit(self, edits: list[tuple[int, int, str]], k: int, first: int, begin: int) -> tuple[int, int, list[str], list[int]]:
        """(next edit, next leaf, texts and tokens of the new leaves) of the edits from the k-th on that touch the leaves
        from `first`, which begins at `begin`."""
        leaf, old, text = first, begin, ""  # the next leaf to take and where it begins; what is taken but not yet split
        done, taken, bounds = 0, 0, {}  # characters split and taken; old boundaries behind the last edit, and the leaf there
        pieces: list[str] = []
        counts: list[int] = []
        parts: list[str] = []
        tokens: list[int] = []

        def take() -> None:
            nonlocal leaf, old, text, taken, k
            raw, at, new = self.parts[leaf], old, []
            leaf, old = leaf + 1, old + len(self.parts[leaf])
            edited = False
            while k < len(edits) and (edits[k][0] <= old or self._first(edits[k][0])[0] < leaf):
                start, end, replacement = edits[k]
                while old < end or old < start:
                    raw, old, leaf = raw + self.parts[leaf], old + len(self.parts[leaf]), leaf + 1
                new += [raw[len(raw) - (old - at) : len(raw) - (old - start)], replacement]
                at, k, edited = end, k + 1, True
            more = "".join([*new, raw[len(raw) - (old - at) :]]) if old > at else "".join(new)
            text, taken = text + more, taken + len(more)
            if edited:
                bounds.clear()
            bounds[taken] = leaf

        take()
        while True:
            if leaf < len(self.parts):
                take()
            ended, used = leaf == len(self.parts), 0
            for m in self.tok.split.finditer(text):
                if m.end() + LOOK > len(text) and not ended:
                    break
                pieces.append(m.group())
                counts.append(self.tok.count(m.group()))
                used = m.end()
                if done + used in bounds:
                    break
            text, done = text[used:], done + used
            if len(pieces) > 2 * self.leaf:
                whole = len(pieces) - len(pieces) % self.leaf
                cut = self._cut(pieces[:whole], counts[:whole])
                parts, tokens = parts + cut[0], tokens + cut[1]
                del pieces[:whole], counts[:whole]
            if done in bounds and done or ended and not text:
                break
        self.encoded += done
        if pieces:
            parts, tokens = [*parts, "".join(pieces)], [*tokens, sum(counts)]
        return k, bounds.get(done, leaf), parts, tokens


def ordered(edits: list[dict] | None) -> list[tuple[int, int, str]]:
    """Edits from the last to the first. A null edit or start is no edit, a null length none, a null replacement empty."""
    found = [(e["start"], e["length"], e["replacement"]) for e in (() if edits is None else edits) if e is not None]
    plain = [(int(a), 0 if b is None or b != b else int(b), c or "") for a, b, c in found if a is not None and a == a]
    return sorted(((max(a, 0), max(b, 0), c) for a, b, c in plain), key=lambda e: e[:2], reverse=True)


def shipped(spark: SparkSession, vocabulary: str):
    """The vocabulary file (a megabyte or so), read once by the driver and sent to the tasks."""
    return spark.sparkContext.broadcast(Path(vocabulary).read_bytes())


TREE = "struct<chars:array<int>,tokens:array<int>>"


def with_trees(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, leaf: int = LEAF, name: str = "tree") -> DataFrame:
    """docs with n_tokens and the document's tree (its leaves' characters and tokens), to be stored with the text.

    Null and empty texts have no tokens and an empty tree. A column of docs with the name of an added one gives way.
    """
    frame, back = internal(docs, text="text")
    words = shipped(docs.sparkSession, vocabulary)

    @F.pandas_udf(f"n_tokens long, tree {TREE}")
    def grown(texts: pd.Series) -> pd.DataFrame:
        tok, rows = made(words.value, pattern), []
        for text in texts:
            tree = CountTree(text or "", tok, leaf)
            rows.append((tree.n_tokens, dict(zip(("chars", "tokens"), tree.leaves, strict=True))))
        return pd.DataFrame(rows, columns=["n_tokens", "tree"])

    found = frame.withColumn("_grown", grown(F.col("_text")))
    return found.select(*with_added(back, docs.columns, **{"n_tokens": F.col("_grown.n_tokens"), name: F.col("_grown.tree")}))


def with_edits(docs: DataFrame, edits: str = "edits", tree: str = "tree", vocabulary: str = VOCABULARY, pattern: str = PATTERN, leaf: int = LEAF, keep_text: bool = True) -> DataFrame:
    """docs (text, tree, edits) after the edits: their text and tree (unless not keep_text) are the new ones.

    Added: n_tokens (before), n_edits, n_chars_after, n_tokens_after, n_chars_encoded. A stored tree is taken up and only
    touched leaves with their boundaries are encoded; without one (null) the text is. So batches of edits follow each
    other and none encodes a document as a whole. Edits are as in count_tokens.
    """
    frame, back = internal(docs, text="text", tree=tree, edits=edits)
    words = shipped(docs.sparkSession, vocabulary)
    kinds = {"n_tokens": "long", "n_edits": "long", "n_chars_after": "long", "n_tokens_after": "long", "n_chars_encoded": "long"} | ({"text": "string", "tree": TREE} if keep_text else {})

    @F.pandas_udf(", ".join(f"{n} {k}" for n, k in kinds.items()))
    def changed(texts: pd.Series, trees: pd.DataFrame, changes: pd.Series) -> pd.DataFrame:
        tok, rows = made(words.value, pattern), []
        for text, chars, tokens, edits in zip(texts, trees["chars"], trees["tokens"], changes, strict=True):
            grown = CountTree(text or "", tok, leaf, None if chars is None else (chars, tokens))
            before = grown.n_tokens
            n = grown.edit_all(edits)
            told = (before, n, grown.n_chars, grown.n_tokens, grown.encoded)
            rows.append((*told, grown.text if text is not None or n else None, dict(zip(("chars", "tokens"), grown.leaves, strict=True))) if keep_text else told)
        return pd.DataFrame(rows, columns=list(kinds))

    found = frame.withColumn("_new", changed(F.col("_text"), F.col("_tree").cast(TREE), F.col("_edits").cast(EDIT)))
    added = {n: F.col(f"_new.{n}") for n in kinds if n not in ("text", "tree")}
    new = {docs.columns.index("text"): F.col("_new.text").alias("text"), docs.columns.index(tree): F.col("_new.tree").alias(tree)} if keep_text else {}
    return found.select(*with_added([new.get(i, b) for i, b in enumerate(back)], docs.columns, **added))


def count_tokens(docs: DataFrame, edits: str = "edits", vocabulary: str = VOCABULARY, pattern: str = PATTERN, leaf: int = LEAF, carry: list[str] | None = None) -> DataFrame:
    """Every row of docs with n_tokens, n_edits, n_chars_after, n_tokens_after and n_chars_encoded.

    The column `edits` (array of start, length and replacement; null: none; a null edit or start is no edit, a null or
    negative length none, a null replacement empty, a negative start 0) has the edits of a document, each against the
    text as it was before all of them; they are applied from the last to the first, overlapping ones cut to what the
    later one left. n_tokens counts the text's tokens, n_tokens_after those after its edits, from a tree of which only
    the touched leaves and their boundaries were encoded again (n_chars_encoded characters). Null and empty texts have
    no tokens but can be edited. To keep trees between batches of edits, see with_trees and with_edits. A column of docs
    with the name of an added one gives way; repeated rows come out repeated; an empty table gives an empty one.
    """
    frame, back = internal(docs, text="text", edits=edits)
    names = [n for n in docs.columns if (carry is None and n != edits) or (carry is not None and n in carry)]
    own = {n: frame.columns[docs.columns.index(n)] for n in names}
    inner = frame.select(*dict.fromkeys([*own.values(), "_text", "_edits"])).withColumnsRenamed({"_text": "text"})
    renamed = {n: "text" if c == "_text" else c for n, c in own.items()}
    found = with_edits(with_trees(inner, vocabulary, pattern, leaf, "_tree"), "_edits", "_tree", vocabulary, pattern, leaf, keep_text=False)
    added = ["n_tokens", "n_edits", "n_chars_after", "n_tokens_after", "n_chars_encoded"]
    return found.select(*with_added([F.col(c).alias(n) for n, c in renamed.items()], names, **{n: F.col(n) for n in added}))


#: Addresses, long numbers and hexadecimal keys: what the query's edits take out of the texts.
ADDRESS = r"[\w.+-]{1,64}@[\w-]+(?:\.[\w-]+)+"
NUMBERS = r"\b[0-9a-f]{32,}\b|\+?\d[\d ().-]{7,}\d"
PRIVATE = f"{ADDRESS}|{NUMBERS}"


def redactions(replacement: str = "[removed]"):
    """A column function: the edits that take out every match of PRIVATE."""

    @F.pandas_udf(EDIT)
    def edits(texts: pd.Series) -> pd.Series:
        every, numbers = re.compile(PRIVATE).finditer, re.compile(NUMBERS).finditer  # no address without an @
        found = ((every if "@" in t else numbers)(t) for t in (t or "" for t in texts))
        return pd.Series([[{"start": m.start(), "length": m.end() - m.start(), "replacement": replacement} for m in ms] for ms in found], dtype=object)

    return edits


def edited(text: str | None, edits: list[dict] | None) -> str:
    """The text after edits, by the same rule; for tests."""
    text = text or ""
    limit = len(text)
    for start, length, replacement in ordered(edits):
        a = min(start, limit)
        b = a + min(length, limit - a)
        text = text[:a] + replacement + text[b:]
        limit = min(limit, start)
    return text
