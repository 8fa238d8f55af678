"""Benchmark decontamination by greedy string tiling.

A document's words are joined with the seeds (runs of ``MIN_MATCH`` words) of
the benchmark items.  For each item with enough seeds in the document, running
Karp-Rabin hashes find the longest common runs of unmarked words again and
again and mark them, longest first, never overlapping in either text.  The
share of the item's words that end up marked is its coverage, whatever order
the passages stand in; an item covered to ``MIN_COVERAGE`` or more contaminates
the document.

The benchmark is the stated query set: it is cut into blocks of bounded size,
read and sent out one after another, and each worker indexes a block once.
Documents are never shuffled.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_MATCH = 5
MIN_COVERAGE = 0.6
#: Most characters of benchmark text in a block (one longer item is a block of its own).
BLOCK_CHARS = 8_000_000
WORD = re.compile(r"\w+")
MATCH_TYPE = "array<struct<item_id:{},coverage:double,n_tiles:int,n_words:int>>"
# Any odd number has an inverse modulo 2^64, so powers can be divided out.
_BASE = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, lower-cased."""
    return WORD.findall((text or "").lower())


def window_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Running Karp-Rabin hashes of all windows of ``size`` words.

    Sums of word times power of the base are running totals; a window's hash is
    the difference of two, divided by the power it starts at (all modulo 2^64),
    so a window costs the same whatever its size.
    """
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = np.full(len(tokens), _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    sums = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(tokens.astype(np.uint64) * np.multiply.accumulate(up), out=sums[1:])
    return (sums[size:] - sums[:-size]) * np.multiply.accumulate(down)


def maximal_matches(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(words, start in item, start in doc) of the common runs of ``least``
    words or more that no neighbouring word extends.

    Item places are read in order; a document place with the same window hash
    goes on with the run that ended one place before, or begins one.  Hashes
    only propose: every run is compared word by word.
    """
    hashes = window_hashes(doc, least)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    own = window_hashes(item, least)
    first = np.searchsorted(ordered, own)
    last = np.searchsorted(ordered, own, side="right")
    out: list[tuple[int, int, int]] = []
    nothing = np.zeros(0, np.int64)
    begun, at = nothing, nothing  # first and latest document place of the open runs
    for p in range(len(own) + 1):
        here = order[first[p] : last[p]] if p < len(own) else nothing
        on = np.isin(at + 1, here, assume_unique=True)
        for t, end in zip(begun[~on].tolist(), at[~on].tolist()):
            out += _compared(item, doc, p - 1 - (end - t), t, end - t + least, least)
        new = here[~np.isin(here, at + 1, assume_unique=True)]
        begun = np.concatenate([begun[on], new])
        at = np.concatenate([at[on] + 1, new])
    return out


def _compared(item: np.ndarray, doc: np.ndarray, p: int, t: int, n: int, least: int) -> list[tuple[int, int, int]]:
    """The parts of a proposed run that are equal words."""
    return [(b - a, p + a, t + a) for a, b in _stretches(item[p : p + n] == doc[t : t + n], least)]


def _stretches(flags: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(first, end) of the runs of ``least`` true flags or more."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False]))))
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= least]


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start in item, start in doc, words) of the tiles, longest first: again
    and again the longest common run of unmarked words is marked (of equal
    ones, the first in the item, then in the document), while it has ``least``
    words.

    A queue holds the maximal runs by length.  A run that lost words to a
    longer tile goes back with the stretches that are left of it.
    """
    queue = [(-n, p, t) for n, p, t in maximal_matches(item, doc, least)]
    heapq.heapify(queue)
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)
    out = []
    while queue:
        n, p, t = heapq.heappop(queue)
        n = -n
        free = free_item[p : p + n] & free_doc[t : t + n]
        if free.all():
            free_item[p : p + n] = False
            free_doc[t : t + n] = False
            out.append((p, t, n))
        else:
            for a, b in _stretches(free, least):
                heapq.heappush(queue, (a - b, p + a, t + a))
    return out


class BenchmarkIndex:
    """Seeds and words of one block of items (id, text)."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.ids, self.items, self.least = [], [], []
        self.vocabulary: dict[str, int] = {}
        for item_id, text in items:
            tokens = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if tokens:
                self.ids.append(item_id)
                self.items.append(np.array(tokens, np.int64))
                self.least.append(min(MIN_MATCH, len(tokens)))
        # For each seed length: sorted seed hashes, the items that hold them,
        # and at how many places of the item.
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted(set(self.least)):
            keys, owners, times = [], [], []
            for k, tokens in enumerate(self.items):
                if self.least[k] == size:
                    h, n = np.unique(window_hashes(tokens, size), return_counts=True)
                    keys.append(h)
                    owners.append(np.full(len(h), k))
                    times.append(n)
            key, owner = np.concatenate(keys), np.concatenate(owners)
            order = np.argsort(key, kind="stable")
            distinct, first = np.unique(key[order], return_index=True)
            self.seeds[size] = (distinct, np.append(first, len(key)), owner[order], np.concatenate(times)[order])

    def matches(self, text: str | None) -> list[dict]:
        """The items that ``text`` covers to MIN_COVERAGE or more."""
        get = self.vocabulary.get
        tokens = np.array([get(w, 0) for w in words(text)], np.int64)
        out = []
        for size, (keys, first, owner, times) in self.seeds.items():
            hashes = window_hashes(tokens, size)
            if not len(hashes):
                continue
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            places = np.flatnonzero(keys[at] == hashes)
            if not len(places):
                continue
            # At how many places of each item a seed occurs that the text holds: a bound on coverage.
            seen = np.unique(at[places])
            counts = first[seen + 1] - first[seen]
            held = np.concatenate([np.arange(first[s], first[s] + c) for s, c in zip(seen, counts)])
            item, inverse = np.unique(owner[held], return_inverse=True)
            n_places = np.bincount(inverse, weights=times[held]).astype(np.int64)
            for k, n in zip(item.tolist(), n_places.tolist()):
                need = MIN_COVERAGE * len(self.items[k])
                if n * size < need:  # each place marks at most ``size`` words
                    continue
                mine = places[np.isin(hashes[places], window_hashes(self.items[k], size))]
                tiled = tiles(self.items[k], _near(tokens, mine, size), size)
                marked = sum(n for _, _, n in tiled)
                if marked >= need:
                    out.append(
                        {
                            "item_id": self.ids[k],
                            "coverage": marked / len(self.items[k]),
                            "n_tiles": len(tiled),
                            "n_words": marked,
                        }
                    )
        return out


def _near(tokens: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """The words that windows at ``places`` cover, stretch after stretch with a
    word of no item between them.  Windows that share a word stay together, so
    each word of the document is there once."""
    parts = np.split(places, np.flatnonzero(np.diff(places) >= size) + 1)
    gap = np.array([-1], np.int64)
    return np.concatenate([x for p in parts for x in (tokens[p[0] : p[-1] + size], gap)])


def benchmark_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The items (item_id, text) in blocks of bounded size; each is read when
    the one before has been dealt with."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // block_chars)
    key = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    for b in range(n):
        block = items.where(key == b).collect()
        if block:
            yield sorted(((r.item_id, r.text) for r in block), key=lambda r: (r[0] is None, r[0], r[1]))


def block_matches(benchmark: DataFrame, text: Column) -> Iterator[Column]:
    """For each block of the benchmark, the array of its items that ``text``
    covers.  A worker keeps a block's index beside its copy of the block, so
    it is built once, however many tasks the worker runs."""
    kind = MATCH_TYPE.format(dict(benchmark.dtypes)["item_id"])
    context = benchmark.sparkSession.sparkContext

    def matcher(block: Broadcast):
        def matched(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known = block.value
            if "index" not in known:
                known["index"] = BenchmarkIndex(known["items"])
            for texts in parts:
                yield pd.Series([known["index"].matches(t) for t in texts], dtype=object)

        return F.pandas_udf(matched, kind)

    for items in benchmark_blocks(benchmark):
        yield matcher(context.broadcast({"items": items}))(text.cast("string"))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, n_words), one row per document and
    item it covers.  Null and empty texts and items match nothing; repeated
    rows of ``docs`` give repeated pairs, repeated items count once; an empty
    table on either side gives no rows.  A pass over ``docs`` per block."""
    kind = MATCH_TYPE.format(dict(benchmark.dtypes)["item_id"])
    out = None
    for found in block_matches(benchmark, F.col("text")):
        part = docs.select("doc_id", found.alias("found"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.select("doc_id", F.expr(f"cast(array() as {kind})").alias("found"))
    return out.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that cover no item, all columns kept, block by
    block.  Null and empty texts stay; repeated rows stay or go together; an
    empty benchmark drops nothing; other columns may have any names."""
    rows = docs.select(F.struct("*").alias("row"))
    for found in block_matches(benchmark, F.col("row.text")):
        rows = rows.where(F.size(found) == 0)
    return rows.select("row.*")
