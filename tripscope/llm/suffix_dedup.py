"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else in the corpus.  Four steps, each a Spark stage:

1. Every window of ``length`` bytes is assigned to an anchor, the gram with the
   smallest hash inside it (a function of the window alone, so equal windows
   have equal anchors).  Consecutive windows of one anchor make a segment, and
   a segment is one row: anchor hash, segment digest, place.
2. Segments are counted by (anchor, digest), combined before the shuffle.  An
   anchor seen once holds no repeat.  A digest seen twice is a repeat whole.
   An anchor with several digests is contested: its segments share the gram
   but differ around it.
3. Contested segments, one per digest, are dealt to shards by anchor.  A shard
   of bounded size sorts its suffixes by Larsson-Sadakane refinement and takes
   common prefixes by Kasai's recurrence; windows with ``length`` common bytes
   repeat.  Anchors whose segments fall in two shards of a group are merged by
   binary search of one shard's windows in the other's suffix array.
4. Repeated ranges are gathered per document and cut out.

An anchor with more contested segments than a group may hold is hot: its
segments are anchored anew with longer grams (at last the window itself), which
only windows with more in common share, so no group grows with the data and no
window is passed over.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import let, stored

LENGTH = 400
#: Gram lengths, as shares of ``LENGTH``: of the first anchors, then of those
#: that hot segments get.
GRAMS = (0.24, 0.72, 0.96, 1.0)
#: Window starts handled at once.
PIECE = 1 << 20
#: Contested segments of one anchor in one group, segments in a group, and
#: bytes of a shard's suffix array.
HOT = 2048
GROUP_SEGMENTS = 4096
SHARD_BYTES = 1 << 20

_POS_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
SEGMENT_TYPE = "row long, h long, d long, n long, a int, b int, len int, off int"


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _gram_hashes(data: np.ndarray, gram: int, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Mixed polynomial hash of every gram of ``data`` (uint8)."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[0][: len(data)], out=sums[1:])
    x = (sums[gram:] - sums[:-gram]) * powers[1][: len(data) - gram + 1]
    x ^= x >> np.uint64(31)
    x *= _MIX
    x ^= x >> np.uint64(29)
    return x


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(pieces: list[tuple[int, int, bytes, int]], length: int, gram: int, powers) -> pd.DataFrame:
    """Segment rows of pieces (row, offset of the piece, its bytes, how many
    equal pieces it stands for)."""
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    buffer = data.tobytes()
    sizes = np.array([len(p[2]) for p in pieces])
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    mask = np.uint64((1 << _POS_BITS) - 1)
    full = _gram_hashes(data, gram, powers)
    keys = (full & ~mask) | np.arange(len(full), dtype=np.uint64)
    anchor = (_sliding_min(keys, length - gram + 1) & mask).astype(np.int64)
    piece = np.repeat(np.arange(len(pieces)), sizes)[: len(anchor)]
    valid = np.arange(len(anchor)) <= begins[piece] + sizes[piece] - length
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(change & valid)
    last = np.concatenate((np.flatnonzero(change)[1:], [len(anchor)]))[np.searchsorted(np.flatnonzero(change), first)] - 1
    last = np.minimum(last, begins[piece[first]] + sizes[piece[first]] - length)
    off = anchor[first] - first
    digest = xxhash.xxh3_64_intdigest
    d = np.array(
        [digest(buffer[s:e], o) for s, e, o in zip(first.tolist(), (last + length).tolist(), off.tolist())], np.uint64
    ).view(np.int64)
    own = piece[first]
    h = full[anchor[first]].view(np.int64)
    # Equal neighbours of periodic text become one row that counts them.
    new = np.ones(len(first), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1]) | (own[1:] != own[:-1])
    at = np.flatnonzero(new)
    ends = np.concatenate((at[1:], [len(first)])) - 1 if len(at) else at
    rows = np.array([p[0] for p in pieces], np.int64)
    moved = np.array([p[1] for p in pieces]) - begins
    return pd.DataFrame(
        {
            "row": rows[own[at]],
            "h": h[at],
            "d": d[at],
            "n": (ends - at + 1) * np.array([p[3] for p in pieces], np.int64)[own[at]],
            "a": (first[at] + moved[own[at]]).astype(np.int32),
            "b": (last[ends] + length + moved[own[at]]).astype(np.int32),
            "len": (last[at] - first[at] + length).astype(np.int32),
            "off": off[at].astype(np.int32),
        }
    )


def _segmenter(length: int, gram: int, piece: int = PIECE):
    """mapInPandas function: (row, a, total, data) to segment rows."""

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = _powers((1 << _POS_BITS) + 1)
        held: list[tuple[int, int, bytes, int]] = []
        size = 0
        for part in parts:
            for row, a, total, data in zip(
                part["row"].tolist(), part["a"].tolist(), part["total"].tolist(), part["data"]
            ):
                for at in range(0, max(len(data) - length + 1, 0), piece):
                    own = bytes(data[at : at + piece + length - 1])
                    if held and size + len(own) > 2 * piece:
                        yield segments(held, length, gram, powers)
                        held, size = [], 0
                    held.append((row, a + at, own, total))
                    size += len(own)
        if held:
            yield segments(held, length, gram, powers)

    return batches


# -- suffix arrays of a shard --------------------------------------------------


def suffix_array(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """``starts`` in the order of the ``length`` bytes that follow them.

    Larsson-Sadakane: suffixes are ranked by their first 8 bytes; each round
    doubles the depth by the rank that far ahead, and sorts only the groups
    that are not single yet.
    """
    n = len(data)
    wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | wide[k : k + n]
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order][1:] != key[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    depth = 8
    while depth < length:
        ahead = min(depth, length - depth)
        single = np.append(new[1:], True) & new
        at = np.flatnonzero(~single)  # places in ``order`` inside unsorted groups
        if not len(at):
            break
        pos = order[at]
        there = pos + ahead
        follow = np.where(there < n, rank[np.minimum(there, n - 1)] + 1, 0)
        sub = np.lexsort((follow, rank[pos]))
        pos, follow = pos[sub], follow[sub]
        order[at] = pos
        old = rank[pos]
        split = np.ones(len(at), bool)
        split[1:] = (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])
        new[at] = split
        rank[pos] = at[np.flatnonzero(split)[np.cumsum(split) - 1]]
        depth += ahead
    keep = np.zeros(n, bool)
    keep[starts] = True
    return order[keep[order]]


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before it.

    Kasai's recurrence: where a suffix and its neighbour both move on by one
    byte, the common prefix shrinks by one.  Only the first suffix of such a
    chain is compared byte by byte.
    """
    n = len(data)
    before = np.full(n + 1, -2, np.int64)
    before[order[1:]] = order[:-1]
    pos = np.sort(order)
    chained = np.zeros(len(pos), bool)
    chained[1:] = (pos[1:] == pos[:-1] + 1) & (before[pos[1:]] == before[pos[:-1]] + 1) & (before[pos[:-1]] >= 0)
    shared = np.zeros(len(pos), np.int64)
    heads = np.flatnonzero(~chained & (before[pos] >= 0))
    wide = np.concatenate([data, np.zeros(1, np.uint8)])

    def compare(which: np.ndarray) -> None:
        live, got, step = which, np.zeros(len(which), np.int64), 64
        place = np.arange(len(which))
        while len(live):
            i, j = pos[live] + got[place], before[pos[live]] + got[place]
            room = n - np.maximum(i, j)
            span = np.arange(step)
            same = (wide[np.minimum(i[:, None] + span, n)] == wide[np.minimum(j[:, None] + span, n)]) & (span < room[:, None])
            run = np.where(same.all(axis=1), step, same.argmin(axis=1))
            got[place] += run
            more = run == step
            live, place = live[more], place[more]
        shared[which] = got

    while len(heads):
        for k in range(0, len(heads), 1 << 14):
            compare(heads[k : k + (1 << 14)])
        head = np.maximum.accumulate(np.where(~chained, np.arange(len(pos)), 0))
        left = shared[head] - (np.arange(len(pos)) - head)
        # a chain that ran out is compared afresh from there
        broken = chained & (left < 0)
        filled = chained & ~broken
        shared[filled] = left[filled]
        heads = np.flatnonzero(broken & ~np.append(False, broken[:-1] & chained[1:]))
        chained[heads] = False
    found = np.zeros(n + 1, np.int64)
    found[pos] = shared
    out = found[order]
    if len(out):
        out[0] = 0
    return out


class Shard:
    """Segments (bytes) of one shard, their suffix array over the window
    starts, and the windows found to repeat."""

    def __init__(self, parts: list[bytes], length: int):
        self.length = length
        self.buffer = b"".join(parts)
        data = np.frombuffer(self.buffer, np.uint8)
        sizes = np.array([len(p) for p in parts])
        self.begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.owner = np.repeat(np.arange(len(parts)), sizes)
        starts = np.flatnonzero(np.arange(len(data)) <= (self.begins + sizes - length)[self.owner])
        self.order = suffix_array(data, starts, length)
        equal = common_prefixes(data, self.order) >= length
        self.repeats = np.zeros(len(data), bool)
        self.repeats[self.order[equal]] = True
        self.repeats[self.order[np.flatnonzero(equal) - 1]] = True
        self.starts = starts

    def find(self, window: bytes) -> int:
        """Place in the suffix array of a suffix that begins with ``window``, or -1."""
        k = bisect.bisect_left(self.order, window, key=lambda i: self.buffer[i : i + self.length])
        if k < len(self.order) and self.buffer[self.order[k] : self.order[k] + self.length] == window:
            return k
        return -1

    def merge(self, other: "Shard", mine: np.ndarray) -> None:
        """Mark the windows of the segments ``mine`` that ``other`` holds too,
        in both shards."""
        for s in self.starts[np.isin(self.owner[self.starts], mine)].tolist():
            window = self.buffer[s : s + self.length]
            k = other.find(window)
            if k >= 0:
                self.repeats[s] = True
                while k < len(other.order) and other.buffer[other.order[k] : other.order[k] + self.length] == window:
                    other.repeats[other.order[k]] = True
                    k += 1

    def ranges(self) -> list[tuple[int, int, int]]:
        """(segment, first byte, end byte) of the repeated stretches."""
        at = np.flatnonzero(self.repeats)
        if not len(at):
            return []
        cut = np.flatnonzero((np.diff(at) > 1) | (self.owner[at[1:]] != self.owner[at[:-1]])) + 1
        return [
            (int(o), int(run[0] - self.begins[o]), int(run[-1] - self.begins[o] + self.length))
            for run in np.split(at, cut)
            for o in (self.owner[run[0]],)
        ]


def repeated_in_group(h: np.ndarray, parts: list[bytes], length: int, shard_bytes: int = SHARD_BYTES) -> list[tuple[int, int, int]]:
    """(segment, first byte, end byte) of the stretches that repeat among the
    segments of a group, sorted by anchor hash ``h``: a suffix array per shard,
    then a merge of the shards that an anchor's segments fall into."""
    bounds, size = [0], 0
    for k, p in enumerate(parts):
        if size and size + len(p) > shard_bytes:
            bounds.append(k)
            size = 0
        size += len(p)
    bounds.append(len(parts))
    shards = [Shard(parts[a:b], length) for a, b in zip(bounds, bounds[1:]) if b > a]
    for x in range(len(shards)):
        for y in range(x + 1, len(shards)):
            shared = h[bounds[x + 1] - 1]  # sorted: only this anchor can go on
            if h[bounds[y]] != shared:
                break
            mine = np.flatnonzero(h[bounds[x] : bounds[x + 1]] == shared)
            shards[x].merge(shards[y], mine)
    return [(bounds[k] + o, a, b) for k, s in enumerate(shards) for o, a, b in s.ranges()]


def _resolve(length: int):
    def group(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["h", "d"], kind="stable")
        rows, begins, single = part["row"].to_numpy(), part["a"].to_numpy(), part["total"].to_numpy() == 1
        found = repeated_in_group(part["h"].to_numpy(), [bytes(s) for s in part["data"]], length)
        found = [f for f in found if single[f[0]]]
        return pd.DataFrame(
            {
                "row": [rows[o] for o, _, _ in found],
                "a": [begins[o] + s for o, s, _ in found],
                "b": [begins[o] + e for o, _, e in found],
            }
        ).astype({"row": "int64", "a": "int32", "b": "int32"})

    return group


def _place() -> Column:
    return F.struct("row", "a", "len")


def _contested(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of segment rows: the repeated ranges (row, a, b) that counting alone
    finds, and one segment (h, d, total, m, row, a, len) of each digest of an
    anchor with several; m: how many the anchor has."""
    # Anchors seen twice: a row per task and anchor is shuffled, not a segment.
    twice = found.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    again = stored(found.join(twice, "h"), "segments-again")
    counts = again.groupBy("h", "d").agg(F.sum("n").alias("total"), F.min(_place()).alias("one"))
    many = counts.groupBy("h").agg(F.count("*").alias("m"))
    counts = stored(counts.join(many, "h"), "segment-counts")
    whole = again.join(counts.where("total > 1").select("h", "d"), ["h", "d"], "left_semi").select("row", "a", "b")
    return whole, counts.where("m > 1").select("h", "d", "total", "m", "one.*")


def _with_bytes(texts: DataFrame, picked: DataFrame) -> DataFrame:
    """``picked`` segments with their bytes (``data``), cut out of the texts."""
    places = picked.groupBy("row").agg(F.collect_list(F.struct("h", "d", "total", "a", "len")).alias("places"))
    joined = texts.join(places, "row")

    def cut(data: Column) -> Column:  # a text is encoded once, however many segments it has
        return F.transform(
            "places",
            lambda p: F.struct(
                *[p[c].alias(c) for c in ("h", "d", "total", "a")],
                F.substring(data, p["a"] + 1, p["len"]).alias("data"),
            ),
        )

    return joined.select("row", "doc", F.inline(let(F.encode("text", "UTF-8"), cut)))


def repeated_ranges(texts: DataFrame, length: int = LENGTH, hot: int = HOT, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """(row, a, b): byte ranges covered by strings of ``length`` bytes that
    start twice or more in ``texts`` (row long, doc, text).

    ``row`` names a row by its content, so repeated rows share it; each of
    them counts, and the ranges hold for all of them.
    """
    ranges = None
    pieces = texts.select(
        "row", F.lit(0).alias("a"), F.lit(1).cast("long").alias("total"), F.encode("text", "UTF-8").alias("data")
    ).where(F.octet_length("data") >= length)
    grams = sorted({max(8, min(length, round(g * length))) for g in GRAMS})
    for k, gram in enumerate(grams):
        found = stored(pieces.mapInPandas(_segmenter(length, gram), SEGMENT_TYPE), "segments")
        whole, contested = _contested(found)
        last = k == len(grams) - 1
        cold = contested if last else contested.where(F.col("m") <= hot)
        groups = max(1, -(-2 * cold.count() // group_segments))
        dealt = _with_bytes(texts, cold).withColumn("g", F.pmod(F.xxhash64("h"), F.lit(groups)))
        resolved = dealt.groupBy("g").applyInPandas(_resolve(length), "row long, a int, b int")
        both = whole.unionByName(resolved)
        ranges = both if ranges is None else ranges.unionByName(both)
        if last or contested.where(F.col("m") > hot).limit(1).count() == 0:
            break
        pieces = _with_bytes(texts, contested.where(F.col("m") > hot)).select("row", "a", "total", "data")
    return ranges


RESULT_TYPE = "n_bytes long, n_removed long, n_spans long, spans array<struct<start:int,end:int>>, kept binary"


def _cut(texts: pd.Series, ranges: pd.Series) -> pd.DataFrame:
    """Merge the ranges of each text and cut them out."""
    out = []
    for text, own in zip(texts, ranges):
        data = (text or "").encode("utf-8", "surrogatepass")
        spans: list[list[int]] = []
        for a, b in sorted((r["a"], r["b"]) for r in (own if own is not None else ())):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        kept, at = [], 0
        for a, b in spans:
            kept.append(data[at:a])
            at = b
        kept.append(data[at:])
        out.append(
            (
                len(data),
                sum(b - a for a, b in spans),
                len(spans),
                [{"start": a, "end": b} for a, b in spans],
                b"".join(kept),
            )
        )
    return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept binary) for every row
    of ``docs``: the UTF-8 bytes of the whole text without the repeated ones.

    A null text is empty; texts shorter than ``length`` keep every byte;
    repeated rows repeat each other; an empty table gives no rows.  ``kept``
    may end inside a character, so it is bytes.  Only doc_id and text are
    read, so other columns cannot clash.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.xxhash64("doc_id", text).alias("row"), F.col("doc_id").alias("doc"), text.alias("text"))
    ranges = repeated_ranges(texts, length, hot, group_segments)
    by_row = ranges.groupBy("row").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))
    cut = F.pandas_udf(_cut, RESULT_TYPE)
    return (
        texts.join(by_row, "row", "left")
        .select("doc", cut("text", "ranges").alias("c"))
        .select(F.col("doc").alias("doc_id"), "c.*")
    )
