"""Secret scans: pattern spans plus tokens that look random to a Markov model.

Two first-order character models, one of random strings and one of ordinary
identifiers, are counted from a labelled sample; a token outside the pattern
spans whose log-likelihood ratio passes a margin is reported too.  All of it
is Spark column expressions on the row: no Python code, no shuffle of texts.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import hashed_sample, let

# Fixed patterns of the contract.  ``find`` is matched leftmost and without
# overlap; a match counts if its ``group`` has ``least`` characters or more.
# For access and hex the least length is part of the repetition: a maximal
# run that is too short holds no longer match, so the matches are the same.
_KEY = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = rf"(?i){_KEY}([A-Za-z0-9+/_.=-]+)"
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

# Tokens that the character models judge.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
SAMPLE_TOKEN = r"[A-Za-z0-9+/_=-]{6,}"
SAMPLE_DOCS = 8000
#: What joins two words of an identifier ("": each begins with a capital).
JOINTS = ("_", "", "/", "-")
SMOOTHING = 0.5
MARGIN = math.log(100_000.0)

# ``a`` and ``b``: first and end byte of the span in UTF-8.
_SPAN = "array<struct<start:int,kind:int,end:int,a:int,b:int>>"
BLOCK = 64


def running_before(values: Column, combine: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each element of an array, all elements before it combined (``zero``
    for the first).  Totals go by blocks, so the time does not grow with the
    square of the array."""

    def total(part: Column, start: Column) -> Column:
        return F.aggregate(part, start, combine)

    def by_block(v: Column) -> Column:
        n_blocks = F.ceil(F.size(v) / F.lit(BLOCK)).cast("int")
        totals = F.transform(
            F.sequence(F.lit(0), F.greatest(n_blocks - 1, F.lit(0))), lambda b: total(F.slice(v, b * BLOCK + 1, BLOCK), zero)
        )
        nothing = F.slice(F.array(zero), 1, 0)
        before = F.aggregate(
            totals,
            F.struct(nothing.alias("out"), zero.alias("at")),
            lambda s, x: F.struct(F.array_append(s["out"], s["at"]).alias("out"), combine(s["at"], x).alias("at")),
            lambda s: s["out"],
        )

        def place(p: Column) -> Column:
            def one(_: Column, i: Column) -> Column:
                block = F.floor(i / F.lit(BLOCK)).cast("int")
                return total(F.slice(p["v"], block * BLOCK + 1, i - block * BLOCK), F.get(p["before"], block))

            return F.transform(p["v"], one)

        return let(F.struct(v.alias("v"), before.alias("before")), place)

    return let(values, lambda v: F.when(F.size(v) > 0, by_block(v)).otherwise(F.slice(F.array(zero), 1, 0)))


def _add(a: Column, b: Column) -> Column:
    return a + b


def pattern_spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 1) -> Column:
    """Spans (start, kind, end; code points, end exclusive; and their bytes a,
    b) of the matches whose ``group`` has ``least`` characters or more.

    ``split`` gives the text between the matches, ``regexp_extract_all`` the
    matches; a match starts after all earlier lengths.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda g: F.length(g))
    found = let(
        F.struct(hits.alias("hit"), inner.alias("inner"), F.split(text, pattern, -1).alias("gap")),
        lambda p: F.when(F.size(p["hit"]) > 0, _placed(p, kind, least)),
    )
    return F.coalesce(found.cast(_SPAN), F.expr(f"cast(array() as {_SPAN})"))


def _placed(p: Column, kind: int, least: int) -> Column:
    def starts(length: Callable[[Column], Column]) -> Column:
        both = F.transform(p["hit"], lambda h, i: length(h) + length(F.get(p["gap"], i)))
        return running_before(both, _add, F.lit(0))

    def spans(v: Column) -> Column:
        def one(h: Column, i: Column) -> Column:
            gap = F.get(p["gap"], i)
            start, a = F.get(v["start"], i) + F.length(gap), F.get(v["a"], i) + F.octet_length(gap)
            return F.struct(
                start.alias("start"),
                F.lit(kind).alias("kind"),
                (start + F.length(h)).alias("end"),
                a.alias("a"),
                (a + F.octet_length(h)).alias("b"),
                F.get(p["inner"], i).alias("inner"),
            )

        kept = F.filter(F.transform(p["hit"], one), lambda s: s["inner"] >= least)
        return F.transform(kept, lambda s: F.struct(*[s[c] for c in ("start", "kind", "end", "a", "b")]))

    return let(F.struct(starts(F.length).alias("start"), starts(F.octet_length).alias("a")), spans)


def _only_if(test: Column, spans: Column) -> Column:
    return F.when(test, spans).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def base_spans(text: Column) -> Column:
    """The spans of the three fixed kinds, by start, then kind."""
    return F.array_sort(
        F.concat(
            _only_if(text.rlike(f"(?i){_KEY}"), pattern_spans(text, ASSIGN, 0, 2, ASSIGN_LEAST)),
            _only_if(F.contains(text, F.lit("AKIA")), pattern_spans(text, ACCESS, 1)),
            _only_if(text.rlike(HEX), pattern_spans(text, HEX, 2)),
        )
    )


@dataclass(frozen=True)
class RandomModel:
    """Log-likelihood ratios (random against ordinary) of a first character
    (``start``) and of each following pair (``pair``, row by row)."""

    start: tuple[float, ...]
    pair: tuple[float, ...]

    def ratio(self, token: Column) -> Column:
        """Log-likelihood ratio of a token over ALPHABET."""

        def constant(values: tuple[float, ...]) -> Column:
            return F.split(F.lit(",".join(f"{v:.6f}" for v in values)), ",").cast("array<double>")

        size = len(ALPHABET)
        codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
        return let(
            F.filter(codes, lambda c: c >= 0),
            lambda c: F.get(constant(self.start), F.get(c, F.lit(0)))
            + F.aggregate(
                F.transform(
                    F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))),
                    lambda a, i: F.get(constant(self.pair), a * size + F.get(c, i + 1)),
                ),
                F.lit(0.0),
                lambda s, x: s + x,
            ),
        )


def train_random_model(samples: DataFrame) -> RandomModel:
    """Count both models from ``samples`` (token string, random boolean).

    Only character-pair counts reach the driver: at most
    2 * (len(ALPHABET) + 1) * len(ALPHABET) rows, whatever the sample.  No
    samples give a model that reports nothing (ratio 0).
    """
    size = len(ALPHABET)
    codes = F.filter(
        F.transform(F.split("token", ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1), lambda c: c >= 0
    )
    pairs = samples.where(F.col("token").isNotNull() & F.col("random").isNotNull()).select(
        "random",
        F.explode(
            let(codes, lambda c: F.transform(c, lambda x, i: F.struct(F.coalesce(F.get(c, i - 1), F.lit(-1)).alias("a"), x.alias("b"))))
        ).alias("p"),
    )
    counts = {
        (r.random, r.a, r.b): r["n"]
        for r in pairs.groupBy("random", "p.a", "p.b").agg(F.count("*").alias("n")).collect()
    }

    def logs(random: bool, a: int) -> list[float]:
        row = [counts.get((random, a, b), 0) + SMOOTHING for b in range(size)]
        total = sum(row)
        return [math.log(v / total) for v in row]

    def ratios(a: int) -> list[float]:
        return [r - o for r, o in zip(logs(True, a), logs(False, a))]

    return RandomModel(tuple(ratios(-1)), tuple(v for a in range(size) for v in ratios(a)))


def labelled_tokens(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The training sample (token, random) from some ``sample_docs`` documents
    chosen by a hash of their id (never more than twice that).

    Random: the strings that the fixed patterns find, and digests of the
    sampled ids in hexadecimal and base64.  Ordinary: the other tokens, and
    identifiers, paths and names that join two neighbouring ones.  Null texts
    hold none; a repeated id counts once; no documents give no tokens.
    """
    rows = hashed_sample(docs, sample_docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordinary = F.regexp_extract_all(
        F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), f"{ACCESS}|{HEX}", " "),
        F.lit(SAMPLE_TOKEN),
        F.lit(0),
    )
    random = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda g: F.length(g) >= ASSIGN_LEAST),
        F.regexp_extract_all("text", F.lit(f"{ACCESS}|{HEX}"), F.lit(0)),
    )
    digest = F.sha2(F.col("doc_id").cast("string"), 256)
    digests = F.array(digest, F.base64(F.unhex(digest)), F.upper(F.substring(digest, 1, 20)))
    joints = F.array(*[F.lit(j) for j in JOINTS])

    def joined(words: Column) -> Column:
        def one(word: Column, i: Column) -> Column:
            after = F.coalesce(F.get(words, i + 1), F.lit(""))
            joint = F.get(joints, F.pmod(i, F.lit(len(JOINTS))))
            return F.when(joint == "", F.concat(F.initcap(word), F.initcap(after))).otherwise(F.concat(word, joint, after))

        return F.concat(words, F.transform(words, one))

    ordinary = let(ordinary, joined)
    return rows.select(
        F.explode(
            F.concat(
                F.transform(F.concat(random, digests), lambda t: F.struct(t.alias("token"), F.lit(True).alias("random"))),
                F.transform(ordinary, lambda t: F.struct(t.alias("token"), F.lit(False).alias("random"))),
            )
        ).alias("t")
    ).select("t.token", "t.random")


def random_spans(text: Column, base: Column, model: RandomModel) -> Column:
    """Tokens of 16 characters or more, apart from ``base`` spans, that the
    models call random."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    ratios = F.transform(tokens, model.ratio)
    found = let(
        F.struct(pattern_spans(text, TOKEN, 3).alias("spans"), ratios.alias("ratios")),
        lambda v: F.filter(v["spans"], lambda s, i: F.get(v["ratios"], i) > MARGIN),
    )
    apart = let(found, lambda f: F.when((F.size(f) > 0) & (F.size(base) > 0), _apart(f, base)).otherwise(f))
    return _only_if(text.rlike(TOKEN), apart.cast(_SPAN))


def _apart(spans: Column, base: Column) -> Column:
    """The ``spans`` (in order, none overlapping) that meet no ``base`` span:
    in one list by start, the ends before a span and the starts after it."""

    def marked(s: Column, mine: bool) -> Column:
        # At one start the base span comes first, so it counts as before.
        return F.struct(s["start"].alias("start"), F.lit(int(mine)).alias("mine"), s["end"].alias("end"), s.alias("span"))

    both = F.array_sort(
        F.concat(F.transform(base, lambda s: marked(s, False)), F.transform(spans, lambda s: marked(s, True)))
    )
    far = F.lit((1 << 31) - 1)

    def judged(v: Column) -> Column:
        ends = F.transform(v, lambda x: F.when(x["mine"] == 0, x["end"]).otherwise(0))
        starts = F.reverse(F.transform(v, lambda x: F.when(x["mine"] == 0, x["start"]).otherwise(far)))
        return let(
            F.struct(
                running_before(ends, lambda a, b: F.greatest(a, b), F.lit(0)).alias("end"),
                F.reverse(running_before(starts, lambda a, b: F.least(a, b), far)).alias("start"),
            ),
            lambda r: F.transform(
                F.filter(
                    v,
                    lambda x, i: (x["mine"] == 1) & (F.get(r["end"], i) <= x["start"]) & (F.get(r["start"], i) >= x["end"]),
                ),
                lambda x: x["span"],
            ),
        )

    return let(both, judged)


def find_secrets(docs: DataFrame, model: RandomModel) -> DataFrame:
    """(row, text, base, spans) for every row: ``base`` the fixed kinds,
    ``spans`` those and the random tokens, both sorted by start and kind.

    A null text counts as empty (no spans); repeated rows are scanned one by
    one; further columns stay inside ``row``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def both(v: Column) -> Column:
        return F.struct(
            v.alias("base"), F.array_sort(F.concat(v, random_spans(F.col("text"), v, model))).alias("spans")
        )

    return (
        docs.select(F.struct("*").alias("row"), text.alias("text"))
        .select("row", "text", let(base_spans(F.col("text")), both).alias("found"))
        .select("row", "text", "found.base", "found.spans")
    )


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order given."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(text: Column, spans: Column, mark: str = "<SECRET>") -> Column:
    """``text`` with each run of overlapping spans replaced by ``mark``.

    The pieces between the runs are cut out of the bytes by place and joined
    once, so the time grows with the text and its spans.
    """

    def cut(s: Column) -> Column:
        ends = running_before(F.transform(s, lambda x: x["b"]), lambda a, b: F.greatest(a, b), F.lit(0))

        def pieces(v: Column) -> Column:
            first = F.filter(
                F.transform(s, lambda x, i: F.struct(F.get(v["ends"], i).alias("from"), x["a"].alias("to"))),
                lambda g: g["to"] >= g["from"],
            )
            last = F.struct(F.array_max(F.transform(s, lambda x: x["b"])).alias("from"), F.octet_length(text).alias("to"))
            return F.array_join(
                F.transform(
                    F.concat(first, F.array(last)),
                    lambda g: F.substring(v["bytes"], g["from"] + 1, g["to"] - g["from"]).cast("string"),
                ),
                mark,
            )

        return let(F.struct(ends.alias("ends"), F.encode(text, "UTF-8").alias("bytes")), pieces)

    return F.when(F.size(spans) == 0, text).otherwise(cut(spans))
