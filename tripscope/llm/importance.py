"""Resampling towards a target distribution by importance weights.

Documents and target texts are seen as bags of hashed word runs (one and two
consecutive words).  A bucket's gain is the logarithm of how much likelier it
is among the target's runs than among the documents'; a document's weight is
the mean gain of its runs, looked up in one array of gains.  Weight plus a
Gumbel number hashed from the id is the score; the highest scores are a sample
drawn without replacement in proportion to the weights.

The draw is a distributed quickselect.  Scored rows are written once as a
narrow table; in each round some rows of the range in question, chosen by a
hash, are the pivots, one aggregate counts the rows below, at and between
them, and the range narrows to the stretch that holds the k-th key, until a
pivot is that key.  Keys are unique, so the draw is exact.  Only the winners
are sorted, by range, and ranked from the partitions' sizes.

What reaches the driver: the bucket counts (a fixed number), pivots and their
counts, and one count for each partition of the winners.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import stored

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
PERCENT = 25
#: Pivots of a round: a range shrinks about this many times.
PIVOTS = 64
# Words are letters, digits and everything beyond ASCII; only
# A-Z change case.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

# Bounds of a worker's memory: words remembered, words in one array step,
# bytes of a word whose checksum tables are kept.
MOST_WORDS = 400_000
STEP_WORDS = 200_000
TABLE_BYTES = 64

# The composite key, in drawing order: see ``score_documents``.
KEY = ("order", "no_id", "id", "n_features", "text_hash", "row_no")


class RunHasher:
    """crc32 of every run of one and two words of many documents at once.

    The checksum of "a b" follows from those of "a " and "b": checksums are
    linear, so crc(x + y) is crc(x) moved on by the length of y, exclusive-or
    crc(y).  A move by n bytes is four table look-ups.
    """

    def __init__(self):
        self.moves = np.zeros((TABLE_BYTES + 1, 4, 256), np.uint32)
        for n in range(TABLE_BYTES + 1):
            zeros = bytes(n)
            still = zlib.crc32(zeros)
            for k in range(4):
                for byte in range(256):
                    self.moves[n, k, byte] = zlib.crc32(zeros, byte << (8 * k)) ^ still
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.words: list[bytes] = []
        self.own, self.spaced, self.size = array("I"), array("I"), array("Q")

    def _add(self, word: str) -> int:
        data = word.encode("utf-8", "surrogatepass")
        self.words.append(data)
        own = zlib.crc32(data)
        self.own.append(own)
        self.spaced.append(zlib.crc32(b" ", own))
        self.size.append(len(data))
        n = self.number[word] = len(self.words) - 1
        return n

    def buckets(self, texts: list[list[str]], n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(bucket of every run, text it belongs to): the single words of all
        texts, then their pairs."""
        if len(self.words) > MOST_WORDS:
            self._forget()
        get, add = self.number.get, self._add
        numbers = [n if (n := get(w)) is not None else add(w) for words in texts for w in words]
        i = np.array(numbers, np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
        own = np.frombuffer(self.own, np.uint32)
        spaced = np.frombuffer(self.spaced, np.uint32)
        size = np.frombuffer(self.size, np.uint64)
        pair = np.flatnonzero(owner[1:] == owner[:-1]) if len(i) else np.zeros(0, np.int64)
        a, b = i[pair], i[pair + 1]
        start, length = spaced[a], size[b]
        short = np.minimum(length, TABLE_BYTES).astype(np.int64)
        moved = own[b].copy()
        for k in range(4):
            moved ^= self.moves[short, k, (start >> np.uint32(8 * k)) & np.uint32(255)]
        for p in np.flatnonzero(length > TABLE_BYTES).tolist():
            moved[p] = zlib.crc32(self.words[b[p]], int(start[p]))
        runs = np.concatenate([own[i], moved]) % np.uint32(n_buckets)
        del own, spaced, size  # the arrays may grow again
        return runs, np.concatenate([owner, owner[pair]])


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER)) if text else []


def _steps(texts: pd.Series) -> Iterator[list[list[str]]]:
    """The words of the texts, in groups of some STEP_WORDS words."""
    group, n = [], 0
    for text in texts:
        own = words(text)
        group.append(own)
        n += len(own)
        if n >= STEP_WORDS:
            yield group
            group, n = [], 0
    if group:
        yield group


def bucket_counts(texts: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """How many runs of all ``text`` values fall in each bucket.  A task adds
    up its own rows, so at most ``n_buckets`` numbers leave it."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, total = RunHasher(), np.zeros(n_buckets, np.int64)
        for part in parts:
            for group in _steps(part["text"]):
                total += np.bincount(hasher.buckets(group, n_buckets)[0], minlength=n_buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held.astype(np.int64), "n": total[held]})

    rows = texts.select(F.col("text").cast("string").alias("text"))
    out = np.zeros(n_buckets, np.int64)
    for r in rows.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(docs: DataFrame, target: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """Floored thousandths of each bucket's log-likelihood gain, counts plus
    one on either side.  Empty tables count nothing."""
    s, t = bucket_counts(docs, n_buckets), bucket_counts(target, n_buckets)
    all_s, all_t = float(s.sum() + n_buckets), float(t.sum() + n_buckets)
    return np.array(
        [
            math.floor(1000 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t)))
            for a, b in zip(s.tolist(), t.tolist())
        ],
        np.int64,
    )


def gumbel(doc_id: int | None, seed: int) -> int:
    """Floored thousandths of a Gumbel number hashed from the id."""
    name = "null" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, and
    the rest of the key by which documents are drawn, smallest first: ``order``
    (the score, negated), ``no_id`` (a null id comes last), ``id``,
    ``n_features``, ``text_hash`` and ``row_no``, which sets repeated rows
    apart.  ``row_no`` differs from run to run: write the rows before use."""
    gains_of = docs.sparkSession.sparkContext.broadcast(gains)
    n_buckets = len(gains)

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, gain = RunHasher(), gains_of.value
        for part in parts:
            n_words, n_features, weights = [], [], []
            for group in _steps(part["text"]):
                runs, owner = hasher.buckets(group, n_buckets)
                count = np.bincount(owner, minlength=len(group))
                total = np.zeros(len(group), np.int64)
                np.add.at(total, owner, gain[runs])
                n_words += [len(own) for own in group]
                n_features += count.tolist()
                weights += (total // np.maximum(count, 1)).tolist()
            ids = [None if v is None or v != v else int(v) for v in part["doc_id"].tolist()]
            out = pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "text_hash": part["text_hash"]})
            out["n_words"], out["n_features"], out["weight"] = n_words, n_features, weights
            out["score"] = [w + gumbel(i, seed) for w, i in zip(weights, ids)]
            yield out

    text = F.col("text").cast("string")
    # The id as text: as a number, a null would turn its batch into doubles.
    rows = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), text.alias("text"), F.coalesce(F.xxhash64(text), F.lit(0).cast("long")).alias("text_hash")
    )
    scored = rows.mapInPandas(
        score, "doc_id long, text_hash long, n_words long, n_features long, weight long, score long"
    )
    return scored.select(
        "*",
        (-F.col("score")).alias("order"),
        F.col("doc_id").isNull().cast("int").alias("no_id"),
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"),
        F.monotonically_increasing_id().alias("row_no"),
    )


def _literal(key: tuple, types: dict[str, str]) -> Column:
    return F.struct(*[F.lit(v).cast(types[name]).alias(name) for name, v in zip(KEY, key)])


def kth_key(rows: DataFrame, k: int, seed: int = SEED, pivots: int = PIVOTS) -> tuple | None:
    """The k-th smallest key (1 is the smallest) of ``rows``, whose KEY values
    are unique; None if there are fewer than k.

    Each round is two passes over the range in question: the pivots are its
    rows with the smallest hash of ``row_no`` and the round's number; then one
    aggregate counts the rows in each of the 2 * pivots + 1 places below, at
    and between them.
    """
    if k < 1:
        return None
    types = dict(rows.dtypes)
    key = F.struct(*[F.col(name) for name in KEY])
    low = high = None  # the range: keys above low and below high
    inside, turn = rows.select(*KEY), 0
    while True:
        drawn = inside.orderBy(F.xxhash64("row_no", F.lit(seed), F.lit(turn)), *KEY).limit(pivots).collect()
        points = sorted(tuple(r[name] for name in KEY) for r in drawn)
        if not points:
            return None
        bounds = F.array(*[_literal(p, types) for p in points])
        below = F.size(F.filter(bounds, lambda p: p < key))
        place = 2 * below + F.array_contains(bounds, key).cast("int")
        counts = {r.place: r.n for r in inside.groupBy(place.alias("place")).agg(F.count("*").alias("n")).collect()}
        place = 0
        while place <= 2 * len(points) and k > counts.get(place, 0):
            k -= counts.get(place, 0)
            place += 1
        if place > 2 * len(points):
            return None
        if place % 2:
            return points[place // 2]
        if place > 0:
            low = points[place // 2 - 1]
        if place < 2 * len(points):
            high = points[place // 2]
        inside, turn = rows.select(*KEY), turn + 1
        if low is not None:  # the first part of the key skips row groups
            inside = inside.where((F.col("order") >= low[0]) & (key > _literal(low, types)))
        if high is not None:
            inside = inside.where((F.col("order") <= high[0]) & (key < _literal(high, types)))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... by KEY: a range sort, then each
    partition's ranks start after the sizes of those before it."""
    number = F.monotonically_increasing_id()
    placed = stored(
        rows.repartitionByRange(*KEY).sortWithinPartitions(*KEY).select("*", number.alias("place")), "ranked"
    )
    part = F.shiftright("place", 33)
    sizes = sorted((r.part, r.n) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    starts = rows.sparkSession.createDataFrame(
        [(p, start) for (p, _), start in zip(sizes, before)], "part long, start long"
    )
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    found = placed.withColumn("part", part).join(F.broadcast(starts), "part")  # one row a partition
    return found.withColumn("rank", F.col("start") + inside + 1).drop("place", "part", "start")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    n_buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), one row for each row
    of ``docs``: ``rank`` orders the floor(percent * N / 100) drawn documents,
    N being those of ``least_words`` or more; the others have a null rank.

    Null and empty texts have no words, weight 0 and are not drawn.  Equal
    scores go to the smaller id, a null id last (it draws the number of
    "null"); repeated rows are documents of their own, with ranks in a row.
    An empty table gives no rows, an empty target equal chances for all but
    the documents' own frequencies.  Of ``docs`` only doc_id and text are read,
    so no other column can clash.
    """
    gains = bucket_gains(docs, target, n_buckets)
    scored = stored(score_documents(docs, gains, seed), "scored")
    out = ("doc_id", "n_words", "n_features", "weight", "score")
    eligible = scored.where(F.col("n_words") >= least_words)
    last = kth_key(eligible, max(percent * eligible.count() // 100, 0), seed)
    missed = scored.withColumn("rank", F.lit(None).cast("long"))
    if last is None:
        return missed.select(*out, "rank")
    drawn = F.struct(*[F.col(name) for name in KEY]) <= _literal(last, dict(scored.dtypes))
    won = ranked(eligible.where(drawn))
    return won.select(*out, "rank").unionByName(
        missed.where((F.col("n_words") < least_words) | ~drawn).select(*out, "rank")
    )
