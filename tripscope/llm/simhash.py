"""SimHash near-duplicates: fingerprints linked at a few differing bits.

Fingerprints are made in numpy batches.  Equal ones collapse to one node.  The
exact comparison runs over tiles: two fingerprints within the radius agree in
at least one of radius + 1 bands of bits, so each (band, value) group is
compared on its own; inside it fingerprints are sorted by population count and
cut into tiles, a tile pair is skipped when the counts differ beyond the
radius, and the others are compared by exclusive-or and bit counts.  A group
too large for one task is split again by the bands of its remaining bits, and
a dense one into tile pairs of their own tasks, which loses no link.  A group
returns a spanning forest of its links, never all pairs, and the forests are
joined to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import stored
from tripscope.llm.components import connected_components

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
TILE = 512
#: Groups with more fingerprints are split by further bands.
GROUP_LIMIT = 16_384
LEVELS = 2


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the ``width``-word shingles (repeats included) of the
    text with A-Z lower-cased; fewer words: the whole sequence as one shingle;
    no word: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))
        digest = xxhash.xxh64_intdigest
        n = len(words) - width + 1
        hashes = [
            digest(joined[a:b], SEED)
            for a, b in zip(starts[:n].tolist(), (ends[width - 1 :] - 1).tolist())
        ]
    total = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for k in range(0, len(values), 1 << 14):
        part = values[k : k + (1 << 14)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    set_bits = np.packbits(2 * total > len(values), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, h, fp) for every row of ``docs``: h the 64-bit hash of the
    text (with doc_id it names the row), fp the fingerprint as a signed long.
    A null text has no words."""

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            fp = np.array([fingerprint(t, width) for t in part.pop("text")], np.uint64)
            yield part.assign(fp=fp.view(np.int64))

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", text_hash(F.col("text")).alias("h"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(batches, f"doc_id {kind}, h long, fp long")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _forest(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (index pairs) of the links among distinct ``fp``."""
    n = len(fp)
    pops = np.bitwise_count(fp)
    order = np.argsort(pops, kind="stable")
    fp, pops = fp[order], pops[order].astype(np.int16)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left, right = [], []
    for a in range(0, n, TILE):
        x = fp[a : a + TILE]
        last = int(pops[min(a + TILE, n) - 1])
        for b in range(a, n, TILE):
            if int(pops[b]) - last > radius:
                break  # this and every later tile has too many bits set
            y = fp[b : b + TILE]
            near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
            if a == b:
                near = np.triu(near, 1)
            i, j = np.nonzero(near)
            if not len(i):
                continue
            for p, q in zip((i + a).tolist(), (j + b).tolist()):
                rp, rq = find(p), find(q)
                if rp != rq:
                    root[max(rp, rq)] = min(rp, rq)
                    left.append(p)
                    right.append(q)
    return order[np.array(left, np.int64)], order[np.array(right, np.int64)]


def _small_groups(group: np.ndarray, fp: np.ndarray, radius: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside groups of at most ``most`` neighbouring rows, compared at
    every distance at once."""
    left, right = [], []
    for k in range(1, most):
        near = (group[k:] == group[:-k]) & (np.bitwise_count(fp[k:] ^ fp[:-k]) <= radius)
        at = np.flatnonzero(near)
        left.append(at)
        right.append(at + k)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


SMALL = 24


def _group_links(radius: int):
    """Rows sorted by (tag, value) in, forest edges out; a group may span
    batches, so the last one is kept back until it is complete."""

    def links(tag: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        change = np.flatnonzero((tag[1:] != tag[:-1]) | (value[1:] != value[:-1])) + 1
        starts = np.concatenate(([0], change))
        sizes = np.diff(np.concatenate((starts, [len(fp)])))
        group = np.repeat(np.arange(len(starts)), sizes)
        small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
        at = np.flatnonzero(small)
        i, j = _small_groups(group[at], fp[at], radius, SMALL)
        a, b = [fp[at][i]], [fp[at][j]]
        for g in np.flatnonzero(sizes > SMALL):
            own = fp[starts[g] : starts[g] + sizes[g]]
            i, j = _forest(own, radius)
            a.append(own[i])
            b.append(own[j])
        return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: pd.DataFrame | None = None
        for part in parts:
            part = part if kept is None else pd.concat([kept, part], ignore_index=True)
            if not len(part):
                continue
            last = (part["tag"] == part["tag"].iloc[-1]) & (part["value"] == part["value"].iloc[-1])
            done = part[~last]
            kept = part[last]
            if len(done):
                yield links(done["tag"].to_numpy(), done["value"].to_numpy(), done["fp"].to_numpy().view(np.uint64))
        if kept is not None and len(kept):
            yield links(kept["tag"].to_numpy(), kept["value"].to_numpy(), kept["fp"].to_numpy().view(np.uint64))

    return batches


def _bands(fixed: tuple[int, ...], parts: int) -> list[tuple[int, ...]]:
    """The bits outside ``fixed`` cut into ``parts`` bands."""
    rest = [b for b in range(64) if b not in fixed]
    return [tuple(int(b) for b in p) for p in np.array_split(rest, parts) if len(p)]


def _mask(bits: tuple[int, ...]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def _tile_pairs(rows: DataFrame, radius: int, tile: int) -> DataFrame:
    """Edges inside large groups: ``rows`` (tag, value, fp).

    A group is cut into tiles of about ``tile`` fingerprints of one population
    count each, and every pair of tiles whose counts differ by the radius or
    less is one small task; the other pairs are never made.  Only the tiles'
    names are joined with each other, not the rows.
    """
    rows = rows.withColumn("p", F.bit_count("fp"))
    key = ["tag", "value", "p"]
    counts = stored(
        rows.groupBy(*key).agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("k")), "simhash-tiles"
    )
    tiles = counts.select(*key, F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("t"))
    x, y = (tiles.select("tag", "value", F.col("p").alias(f"p{s}"), F.col("t").alias(f"t{s}")) for s in "xy")
    pairs = x.join(y, ["tag", "value"]).where(
        F.col("py").between(F.col("px"), F.col("px") + radius)
        & ((F.col("px") < F.col("py")) | (F.col("tx") <= F.col("ty")))
    )
    tiled = rows.join(counts, key).select(*key, F.pmod(F.xxhash64("fp"), F.col("k")).cast("int").alias("t"), "fp")

    def side(s: str) -> DataFrame:
        return tiled.withColumnsRenamed({"p": f"p{s}", "t": f"t{s}"}).join(pairs, ["tag", "value", f"p{s}", f"t{s}"])

    columns = ["tag", "value", "px", "tx", "py", "ty"]
    other = side("y").where((F.col("px") < F.col("py")) | (F.col("tx") < F.col("ty")))
    both = side("x").select(*columns, "fp").unionByName(other.select(*columns, "fp"))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        fp = part["fp"].to_numpy()
        i, j = _forest(fp.view(np.uint64), radius)
        return pd.DataFrame({"a": fp[i], "b": fp[j]})

    return both.groupBy(*columns).applyInPandas(compare, "a long, b long")


def fingerprint_links(nodes: DataFrame, radius: int = RADIUS, limit: int = GROUP_LIMIT) -> DataFrame:
    """Edges (a, b) over distinct fingerprints ``nodes`` (fp long) that connect
    exactly what links of at most ``radius`` differing bits connect.

    A level gives each row a key for every band (tag: which bits agree so far,
    value: those bits).  Groups over ``limit`` go on to the next level, which
    cuts their remaining bits into bands.  A group that is still over it after
    ``LEVELS`` levels is a dense cluster: its tile pairs become tasks.
    """
    edges = None
    rows = nodes.select(F.lit(0).alias("tag"), "fp")
    fixed: list[tuple[int, ...]] = [()]
    for level in range(1, LEVELS + 1):
        tags: list[tuple[int, ...]] = []
        plan = []
        for bits in fixed:
            bands = []
            for band in _bands(bits, radius + 1):
                tags.append(tuple(sorted(bits + band)))
                bands.append(F.struct(F.lit(len(tags) - 1).alias("tag"), F.lit(_mask(tags[-1])).cast("long").alias("mask")))
            plan.append(F.array(*bands))
        keyed = rows.select(F.explode(F.get(F.array(*plan), F.col("tag"))).alias("b"), "fp").select(
            "b.tag", F.col("fp").bitwiseAND(F.col("b.mask")).alias("value"), "fp"
        )
        sizes = keyed.groupBy("tag", "value").agg(F.count("*").alias("n"))
        large = stored(sizes.where(F.col("n") > limit).select("tag", "value"), "simhash-large")
        hot = sorted(r["tag"] for r in large.select("tag").distinct().collect())
        small = keyed.join(large, ["tag", "value"], "left_anti") if hot else keyed
        found = (
            small.repartition("tag", "value")
            .sortWithinPartitions("tag", "value")
            .mapInPandas(_group_links(radius), "a long, b long")
        )
        edges = found if edges is None else edges.unionByName(found)
        if not hot:
            break
        within = stored(keyed.join(large, ["tag", "value"], "left_semi"), "simhash-within")
        if level == LEVELS:
            edges = edges.unionByName(_tile_pairs(within, radius, max(1, limit // 2)))
        else:
            names = F.array(*[F.lit(hot.index(t) if t in hot else -1) for t in range(len(tags))])
            rows = within.select(F.get(names, F.col("tag")).alias("tag"), "fp")
            fixed = [tags[t] for t in hot]
    return edges


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, h, fp, component, component_id) for every row of ``docs``.

    component: the smallest fingerprint of the group, which names it; ids may
    be null or repeated, so component_id does not.  component_id: the smallest
    doc_id that links of at most ``radius``
    differing bits reach, the row's own included (null if all of them are
    null).  Null and wordless texts have fingerprint zero and link like any
    other; repeated rows share a component.  An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, width), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = connected_components(fingerprint_links(nodes, radius))
    labelled = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    heads = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = labelled.join(heads, "component").select("fp", "component", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "h", "fp", "component", "component_id")


def keep_one(docs: DataFrame, width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate group: that
    with the smallest doc_id, null ones last (of several texts under that id,
    the one with the smallest hash; of repeated rows, any one)."""
    rows = stored(near_duplicates(docs, width, radius), "near-duplicates")
    heads = (
        rows.groupBy("component", "doc_id", "h")
        .agg(F.count("*").alias("copies"))
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "copies")).alias("m"))
        .select(F.col("m.doc_id").alias("kept_id"), F.col("m.h").alias("kept_h"), F.col("m.copies").alias("copies"))
    )
    kept = docs.select(F.struct("*").alias("row")).join(
        heads,
        F.col("row.doc_id").eqNullSafe(F.col("kept_id")) & (text_hash(F.col("row.text")) == F.col("kept_h")),
    )
    if heads.where("copies > 1").limit(1).count() == 0:
        return kept.select("row.*")
    repeated = kept.where("copies > 1").dropDuplicates(["kept_id", "kept_h"])
    return kept.where("copies = 1").select("row").unionByName(repeated.select("row")).select("row.*")
