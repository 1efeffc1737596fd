"""Periodic runs: stretches of words that repeat with a period, found online along sparse diagonals of equal words."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import internal, with_added

#: Words that are worked through at a time; a longer text is a block of its own.
BLOCK = 1 << 19
#: Words of context of the first level, and how much longer each level's context is than the one before. With these, a
#: run of period p and length of four periods or more holds a context that is as long as p and recurs p words later.
CONTEXT, STEP = 4, 3
#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _occurrences(places: np.ndarray, keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of `size` places: a number that equal keys share (-1: no other place has the key), and the nearest
    earlier place with the same key (-1: none). places ascend."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    numbers = np.concatenate(([0], np.cumsum(~same))) if len(order) else np.zeros(0, np.int64)
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    rank, before = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    rank[places[order[twice]]] = numbers[twice]
    before[places[order[1:][same]]] = places[order[:-1][same]]
    return rank, before


def _longer(left: np.ndarray, right: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of contexts that are made of a left one, ending `shift` words earlier, and a right one of that length."""
    places = np.flatnonzero((right[shift:] >= 0) & (left[: len(left) - shift] >= 0)) + shift
    return _occurrences(places, left[places - shift] * len(left) + right[places], len(left))


def openings(ids: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag), by place: where a word's earlier occurrence may open a diagonal.

    An earlier occurrence counts if the words before it are the same too, as many as the lag or up to three times that,
    and if it is the nearest such. The stretch behind it then is two periods long at least, and its smallest period is
    the lag: a smaller one would have given a nearer occurrence. So at any word few diagonals are open, however often
    the word has occurred, and no multiples of a period are. longest: words of the longest text.
    """
    rank, _ = _occurrences(np.arange(len(ids)), ids, len(ids))
    rank, _ = _longer(rank, rank, 1)
    rank, before = _longer(rank, rank, 2)
    at, lags, low, length = [], [], 0, CONTEXT
    while (rank >= 0).any():
        lag = np.arange(len(ids)) - before
        open_ = np.flatnonzero((before >= 0) & (lag > low) & (lag <= length))
        at.append(open_)
        lags.append(lag[open_])
        if LEAST_PERIODS * length > longest:
            break
        double, _ = _longer(rank, rank, length)
        rank, before = _longer(double, rank, length)
        low, length = length, STEP * length
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places, lags = np.concatenate(at), np.concatenate(lags)
    order = np.argsort(places, kind="stable")
    return places[order], lags[order]


def diagonal_runs(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, in the order in which they end.

    The words are gone through once. Each open diagonal, by its lag, holds how many words in a row match the word a lag
    before; a word that matches adds one, a word that doesn't ends the diagonal, and it is a run if it was long enough.
    Between openings with no diagonal open nothing is to be done.
    """
    at, lags = (x.tolist() for x in openings(ids, longest))
    if not at:
        return []
    words, found, matched, k, i = ids.tolist(), [], {}, 0, 0

    def closed(lag: int, n: int, end: int) -> None:
        if n + lag >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            found.append((end - n - lag, n + lag, lag))

    while matched or k < len(at):
        if not matched:
            i = at[k]
        if i == len(words):
            break
        for lag in list(matched):
            if words[i] == words[i - lag]:
                matched[lag] += 1
            else:
                closed(lag, matched.pop(lag), i)
        while k < len(at) and at[k] == i:
            lag = lags[k]
            if lag not in matched:
                n = 0
                while i - lag - n >= 0 and words[i - n] == words[i - lag - n]:
                    n += 1
                matched[lag] = n
            k += 1
        i += 1
    for lag, n in matched.items():
        closed(lag, n, len(words))
    return found


def _block(texts: list[list[bytes]]) -> list[tuple[int, list[dict], dict | None, str]]:
    """(n_words, runs, strongest, collapsed) of each text's words. Numbers of words differ between texts, so no diagonal
    goes from one text into the next."""
    begins = np.concatenate(([0], np.cumsum([len(w) for w in texts])))
    ids = np.empty(begins[-1], np.int64)
    for words, begin in zip(texts, begins.tolist(), strict=False):
        first: dict[bytes, int] = {}
        ids[begin : begin + len(words)] = list(map(first.setdefault, words, count(begin)))
    of: dict[int, list[tuple[int, int, int]]] = {}
    for run in diagonal_runs(ids, max(map(len, texts), default=0)):
        of.setdefault(int(np.searchsorted(begins, run[0], "right")) - 1, []).append(run)
    out = []
    for i, words in enumerate(texts):
        runs = sorted((s - int(begins[i]), n, p) for s, n, p in of.get(i, ()))
        runs.sort(key=lambda r: (r[0], r[2]))
        kept = words
        if runs:
            dropped = np.zeros(len(words), bool)
            for s, n, p in runs:
                dropped[s + p : s + n] = True
            kept = [words[j] for j in np.flatnonzero(~dropped).tolist()]
        told = [{"start": s, "length": n, "period": p} for s, n, p in runs]
        strongest = max(told, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None)
        out.append((len(words), told, strongest, b" ".join(kept).decode("utf-8", "surrogatepass")))
    return out


def periodic_runs(docs: DataFrame, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """Every row of docs with n_words, runs (array of start, length, period), strongest (one of them) and collapsed.

    Words are runs of other characters than space and 09-0D, numbered from 0. A run is a stretch of words with smallest
    period q that is at least six words and four periods long and that no neighbouring word extends keeping the period.
    runs are ordered by start, then period; strongest has the greatest length by period (of equal ones the earliest, then
    the one of the smallest period; null without runs). collapsed has the kept words, joined by one space: a word goes if
    some run contains it after that run's first period. carry: the columns to keep (all).

    A null text has no words, and so no runs and an empty collapsed text, as has an empty one; repeated rows come out
    repeated; columns of the names that are added give way; an empty table gives an empty one. Rows are worked through
    where they are, in blocks of words: nothing is shuffled, and a text's cost grows with its length alone.
    """
    frame, back = internal(docs, text=text)
    kept = [(n, b) for n, b in zip(docs.columns, back, strict=True) if carry is None or n in carry]
    own = list(dict.fromkeys([frame.columns[docs.columns.index(n)] for n, _ in kept] + ["_text"]))
    at = own.index("_text")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, words, total = 0, [], 0
            texts = batch.column(at)
            for i in range(batch.num_rows):
                words.append((texts[i].as_py() or "").encode("utf-8", "surrogatepass").split())
                total += len(words[-1])
                if total >= BLOCK or i == batch.num_rows - 1:
                    sizes, runs, strongest, collapsed = zip(*_block(words), strict=True)
                    added = [pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(strongest, _RUN), pa.array(collapsed, pa.string())]
                    part = batch.slice(first, len(words))
                    yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*own, "_n", "_runs", "_strongest", "_collapsed"])
                    first, words, total = i + 1, [], 0

    frame = frame.select(*own)
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in frame.schema.fields)}, _n bigint, _runs array<{RUN}>, _strongest {RUN}, _collapsed string"
    found = frame.mapInArrow(find, schema)
    col = lambda c: found[c]
    return found.select(*with_added([b for _, b in kept], [n for n, _ in kept], n_words=col("_n"), runs=col("_runs"), strongest=col("_strongest"), collapsed=col("_collapsed")))
