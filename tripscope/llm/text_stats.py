"""Per-document text statistics as Spark column expressions (no Python code).

Everything is computed within the row: no explode, no shuffle.  The only
sorting is of one document's window hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import SPACE_CLASS, let

WINDOW = 3
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The maximal runs of non-space characters (empty array for no word)."""
    return F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != "")


def char_count(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in ``chars``."""
    rest = text
    for c in chars:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return (F.length(text) - F.length(rest)).cast("long")


POSITION_BITS = 24


def repeated_window_words(words: Column) -> Column:
    """Words inside a 3-word window that occurs twice or more in the text.

    The 64-bit window hashes are sorted with their positions packed into the
    low bits (a sort of plain longs); equal neighbours are repeats, checked on
    the full hashes.  A text with 2^24 words or more, or one where two
    different windows agree in the bits that are left, is sorted as
    (hash, position) pairs instead: the same result, only slower.  Each
    repeated window covers its three words, less the overlap with the next.
    """

    def covered(at: Column) -> Column:
        return F.when(F.size(at) == 0, F.lit(0)).otherwise(
            F.aggregate(
                at,
                F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
                lambda s, p: F.struct(
                    (s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n"),
                    p.alias("last"),
                ),
                lambda s: s["n"],
            )
        )

    def by_pairs(hashes: Column) -> Column:
        pairs = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def repeats(order: Column) -> Column:
            found = F.filter(
                order,
                lambda w, k: (F.get(order, k - 1)["h"] == w["h"])
                | (F.get(order, k + 1)["h"] == w["h"]),
            )
            return let(F.sort_array(F.transform(found, lambda w: w["i"])), covered)

        return let(pairs, repeats)

    mask = (1 << POSITION_BITS) - 1

    def position(packed: Column) -> Column:
        return packed.bitwiseAND(F.lit(mask)).cast("int")

    def by_packed(hashes: Column) -> Column:
        packed = F.sort_array(
            F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")))
        )

        def repeats(order: Column) -> Column:
            top = lambda x: F.shiftright(x, POSITION_BITS)
            return F.filter(
                order,
                lambda x, k: (top(F.get(order, k - 1)) == top(x))
                | (top(F.get(order, k + 1)) == top(x)),
            )

        def result(found: Column) -> Column:
            mixed = F.filter(
                found,
                lambda x, k: (F.shiftright(F.get(found, k - 1), POSITION_BITS) == F.shiftright(x, POSITION_BITS))
                & (F.get(hashes, position(F.get(found, k - 1))) != F.get(hashes, position(x))),
            )
            return F.when(F.size(mixed) > 0, by_pairs(hashes)).otherwise(
                let(F.sort_array(F.transform(found, position)), covered)
            )

        return let(packed, lambda order: let(repeats(order), result))

    def windows(h: Column) -> Column:
        return F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)),
        )

    def of_windows(hashes: Column) -> Column:
        return F.when(F.size(hashes) < mask, by_packed(hashes)).otherwise(by_pairs(hashes))

    word_hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(word_hashes, lambda h: let(windows(h), of_windows)).cast("long")


COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_unique_words",
    "n_upper",
    "n_digits",
    "n_bangs",
)


def with_stats(docs: DataFrame) -> DataFrame:
    """(row, stats): the input row as a struct, so no column name can clash,
    and the counts of its ``text`` (null text: no words).

    n_words, word_chars (code points in words), n_symbols, n_dup_lines
    (lines with a word that equal an earlier line), n_repeat_words, n_lines
    (lines with a word), n_unique_words, n_upper, n_digits, n_bangs.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0), lambda a, w: a + F.length(w)).cast("long").alias("word_chars"),
            repeated_window_words(words).alias("n_repeat_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_unique_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    def in_class(chars: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, f"[{chars}]+", ""))).cast("long")

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = docs.select(
        F.struct("*").alias("row"),
        let(words_of(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        char_count(text, SYMBOLS).alias("n_symbols"),
        char_count(text, "!").alias("n_bangs"),
        in_class("A-Z").alias("n_upper"),
        in_class("0-9").alias("n_digits"),
    )
    where = {"n_lines": "l.n_lines", "n_dup_lines": "l.n_dup_lines"}
    where |= {c: f"w.{c}" for c in ("n_words", "word_chars", "n_repeat_words", "n_unique_words")}
    stats = F.struct(*[F.col(where.get(c, c)).alias(c) for c in COUNTS])
    # A one-element explode: a filter on the counts stays above it, instead of
    # being pushed below with a copy of these expressions for every use.
    return parts.select("row", F.explode(F.array(stats)).alias("stats"))


def features(stats: str = "stats") -> dict[str, Column]:
    """The measures that the quality models use, from the counts struct."""
    s = {c: F.col(f"{stats}.{c}").cast("double") for c in COUNTS}
    words = F.greatest(s["n_words"], F.lit(1.0))
    chars = F.greatest(s["word_chars"], F.lit(1.0))
    lines = F.greatest(s["n_lines"], F.lit(1.0))
    return {
        "words": s["n_words"],
        "mean_word": s["word_chars"] / words,
        "symbols_per_word": s["n_symbols"] / words,
        "bangs_per_word": s["n_bangs"] / words,
        "dup_lines": s["n_dup_lines"] / lines,
        "repeats": s["n_repeat_words"] / words,
        "distinct_words": s["n_unique_words"] / words,
        "upper": s["n_upper"] / chars,
        "digits": s["n_digits"] / chars,
        "words_per_line": s["n_words"] / lines,
    }


def sample_matrix(sample: DataFrame) -> tuple[list[str], list[list[float]], list[int]]:
    """Feature names, rows and labels of a bounded labelled sample
    (``labelled_sample``), in the order of doc_id, on the driver."""
    measures = features()
    rows = (
        with_stats(sample)
        .select(
            F.col("row.doc_id").alias("doc_id"),
            F.col("row.label").alias("label"),
            F.struct(*[c.alias(n) for n, c in measures.items()]).alias("x"),
        )
        .collect()
    )
    rows.sort(key=lambda r: (r.doc_id, r.label, tuple(r.x)))
    return list(measures), [list(r.x) for r in rows], [r.label for r in rows]
