"""Periodic runs of words: stretches that repeat themselves at a fixed lag.

A stretch with smallest period q is a diagonal of the word-by-word comparison
of a text with itself: at lag q, word after word equals the word q before it.
A sparse dynamic program reads the text once and keeps, for each active lag,
how long the present diagonal has matched: an earlier occurrence of what is
read lengthens (or opens) the diagonal at its lag, a lag without one is closed,
and a closed diagonal that is long enough is emitted as a run.

Single words would make this quadratic, since frequent words occur everywhere.
A run of period q matches over 2q words or more, so the program for lags from
G to 2G - 1 (G = 16, 32, 64, ...) reads the text in blocks of G words: every
such diagonal holds a whole block.  A block opens or lengthens a diagonal by G
words, and the exact ends, less than a block further out, are found when the
diagonal is opened and closed.  Lags under 16 are read in blocks of 8: their runs match over 16
words or more.  A block has at most G earlier occurrences at these lags, so a
text of n words costs some n log n steps, however repetitive it is.

Occurrences are found by exact names: the names of all blocks of 2G words are
pairs of names of G words, numbered by sorting.  Nothing is hashed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import SPACE_CLASS

#: A run has this many words and this many periods at least.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Words of the first blocks; serves lags up to 15 (see above).
FIRST_BLOCK = 8
#: Words that are read together (one longer text is read on its own).
STEP_WORDS = 200_000
WORD = re.compile(SPACE_CLASS.replace("[", "[^") + "+")

Run = tuple[int, int, int]  # first word, words, smallest period
Rewrite = Callable[[int | None, list[str]], list[str]]


def words(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


class Names:
    """Exact names of the stretches of 1, 2, 4, ... words at every place of
    some texts, laid end to end.  Equal names: equal stretches, in one text."""

    def __init__(self, texts: list[list[str]]):
        sizes = np.array([len(t) for t in texts], np.int64)
        number: dict[str, int] = {}
        own = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        self.n = len(own)
        self.levels = [_numbered(owner * (len(number) + 1) + own)]

    def level(self, k: int) -> np.ndarray:
        """Names of the stretches of 2**k words (those that would pass the
        end have none)."""
        while len(self.levels) <= k:
            a, half = self.levels[-1], 1 << (len(self.levels) - 1)
            n = max(len(a) - half, 0)
            self.levels.append(_numbered(a[:n] * (self.n + 1) + a[half : half + n]))
        return self.levels[k]

    def same_after(self, i: np.ndarray, lag: np.ndarray, k: int) -> np.ndarray:
        """How many words from place i on equal those ``lag`` before, up to
        2**k - 1 of them."""
        at = i.copy()
        for level in range(k - 1, -1, -1):
            name, size = self.level(level), 1 << level
            fits = at < len(name)
            same = np.zeros(len(at), bool)
            same[fits] = name[at[fits]] == name[at[fits] - lag[fits]]
            at[same] += size
        return at - i

    def same_before(self, i: np.ndarray, lag: np.ndarray, k: int) -> np.ndarray:
        """How many words before place i equal those ``lag`` before them, up
        to 2**k - 1 of them."""
        at = i.copy()
        for level in range(k - 1, -1, -1):
            name, size = self.level(level), 1 << level
            fits = at - size - lag >= 0
            same = np.zeros(len(at), bool)
            same[fits] = name[at[fits] - size] == name[at[fits] - size - lag[fits]]
            at[same] -= size
        return i - at


def _numbered(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1).astype(np.int64)


def earlier_blocks(name: np.ndarray, size: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of each block that stands at a multiple of ``size`` and
    occurs ``least`` to ``most`` words earlier, by place, then lag."""
    n = len(name)
    order = np.argsort(name, kind="stable")
    key = name[order] * (n + 1) + order  # ascending
    block = np.arange(0, n, size)
    first = np.searchsorted(key, name[block] * (n + 1) + np.maximum(block - most, 0))
    last = np.searchsorted(key, name[block] * (n + 1) + np.maximum(block - least, -1), side="right")
    times = np.maximum(last - first, 0)
    place = np.repeat(block, times)
    nth = np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
    lag = place - order[np.repeat(last, times) - 1 - nth]
    return place, lag


def diagonals(place: np.ndarray, lag: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
    """The sparse dynamic program over blocks: (first word, end, lag) of each
    maximal chain of matching blocks on one diagonal, as it is closed."""
    active: dict[int, int] = {}  # lag -> words matched so far
    at, lags, k, n = -1, lag.tolist(), 0, len(place)
    places = place.tolist()
    while k < n:
        here = places[k]
        if here != at + size:  # blocks without an earlier occurrence lie between
            for d, matched in active.items():
                yield at + size - matched, at + size, d
            active = {}
        now: dict[int, int] = {}
        while k < n and places[k] == here:
            now[lags[k]] = active.pop(lags[k], 0) + size
            k += 1
        for d, matched in active.items():
            yield here - matched, here, d
        active, at = now, here
    for d, matched in active.items():
        yield at + size - matched, at + size, d


def find_runs(texts: list[list[str]]) -> list[list[Run]]:
    """The runs of each text, by first word, then period."""
    names = Names(texts)
    bounds = np.cumsum([0] + [len(t) for t in texts])
    longest = max((len(t) for t in texts), default=0)
    found: dict[tuple[int, int], int] = {}  # (first word, words) -> smallest period
    size, least = FIRST_BLOCK, 1
    while max(LEAST_WORDS, LEAST_PERIODS * least) <= longest:
        k = size.bit_length() - 1
        name = names.level(k)
        if not len(name) or name.max() + 1 == len(name):
            break  # no stretch of this size occurs twice, so no longer one does
        most = 2 * size - 1
        place, lag = earlier_blocks(name, size, least, most)
        chains = np.array(list(diagonals(place, lag, size)), np.int64).reshape(-1, 3)
        begin, end, d = chains[:, 0], chains[:, 1], chains[:, 2]
        begin = begin - names.same_before(begin, d, k)
        end = end + names.same_after(end, d, k)
        first, n_words = begin - d, end - begin + d
        enough = n_words >= np.maximum(LEAST_WORDS, LEAST_PERIODS * d)
        for s, m, q in zip(first[enough].tolist(), n_words[enough].tolist(), d[enough].tolist()):
            # The diagonals at multiples of q lie in the same stretch.
            found[s, m] = min(found.get((s, m), q), q)
        size, least = 2 * size, most + 1
    out: list[list[Run]] = [[] for _ in texts]
    for (s, m), q in found.items():
        text = int(np.searchsorted(bounds, s, side="right")) - 1
        out[text].append((s - int(bounds[text]), m, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def kept_words(own: list[str], runs: list[Run]) -> list[str]:
    """The words that no run repeats: all but those after the first period of
    some run."""
    if not runs:
        return own
    keep = np.ones(len(own), bool)
    for first, n, q in runs:
        keep[first + q : first + n] = False
    return [w for w, k in zip(own, keep.tolist()) if k]


def _grouped(rows: pd.DataFrame, rewrite: Rewrite | None) -> Iterator[list[list[str]]]:
    group, n = [], 0
    for doc_id, text in zip(rows["doc_id"].tolist(), rows["text"].tolist()):
        own = words(text)
        if rewrite is not None:
            own = rewrite(None if doc_id is None or doc_id != doc_id else int(doc_id), own)
        group.append(own)
        n += len(own)
        if n >= STEP_WORDS:
            yield group
            group, n = [], 0
    if group:
        yield group


_FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """(row, n_words, runs, collapsed), one row per document: its runs (start,
    length, period; by start, then period) and its kept words, joined by one
    space.

    ``rewrite``: a function of (doc_id, words) applied to the words first.
    Null and empty texts have no words, no runs and an empty ``collapsed``;
    repeated rows are read one by one; an empty table gives no rows; the columns
    of ``docs`` stay inside ``row``, so none can clash.  Nothing is shuffled.
    """

    def find(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in parts:
            n_words, all_runs, collapsed = [], [], []
            for group in _grouped(pd.DataFrame({"doc_id": ids, "text": texts}), rewrite):
                for own, runs in zip(group, find_runs(group)):
                    n_words.append(len(own))
                    all_runs.append([{"start": s, "length": m, "period": q} for s, m, q in runs])
                    collapsed.append(" ".join(kept_words(own, runs)))
            yield pd.DataFrame({"n_words": n_words, "runs": pd.Series(all_runs, dtype=object), "collapsed": pd.Series(collapsed, dtype=object)})

    found = F.pandas_udf(find, _FOUND)(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return docs.select(F.struct("*").alias("row"), found.alias("found")).select("row", "found.*")
