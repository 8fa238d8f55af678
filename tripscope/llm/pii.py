"""Personal data: fixed patterns, and a linear-chain conditional random field
over word shapes for what the patterns miss.

The field tags words O, B-kind or I-kind.  It is trained on the driver from a
small labelled table (the fixed sentences below and at most SAMPLE_DOCS
documents tagged by the patterns) and decoded over whole texts.  A word's
score depends on three shapes alone, so each triple of shapes is scored once;
a word that is O on every best path, by a bound over all its neighbours' tags,
cuts the text, and Viterbi runs over numpy batches of what lies between.  The
result is that of Viterbi over every word.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
NAMES = KINDS + tuple(f"crf_{k}" for k in KINDS)
SAMPLE_DOCS = 800
SAMPLE_CHARS = 20_000
ORDINARY = 300
#: Training sequences hold the words this near to one with a digit or an at sign.
REACH = 2
#: Feature weights are hashed to this many rows.
ROWS = 1 << 12
EPOCHS = 60
RIDGE = 1e-3
BATCH_CELLS = 1 << 16
#: Texts are decoded together up to so many characters, and so many distinct words are remembered.
CHUNK_CHARS = 2_000_000
KNOWN_WORDS = 1 << 18

# Fixed patterns of the contract.  A match may start only where the scan can
# stand after a failure, so the look-behinds change no match; they keep long
# runs linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[^0-9]+")
_WORD = re.compile(r"\S+")

# Sentences labelled by hand; [kind ...] marks the spans.
LABELLED = (
    "call me at [phone +1 (212) 555-0134] after six",
    "phone [phone (212) 555-0134] or write",
    "mobile [phone 555-867-5309] please",
    "tel [phone 0044 20 7946 0958] office",
    "reach us on [phone 212.555.0187] today",
    "fax [phone 1-800-555-0199] free",
    "her number is [phone 020 7946 0321] now",
    "mail [email jane.doe@example.org] soon",
    "write to [email info@localhost] instead",
    "contact [email john_smith(at)example.com] there",
    "send it to [email a.b@mail] quickly",
    "ask [email jane(at)example.org] about it",
    "write [email sales(at)shop.net] please",
    "notify [email tom.hall(at)mail.example.com] first",
    "mail [email root@server] at once",
    "from [email tom@backup] and others",
    "server [ip 10.0.0.12] is down",
    "host [ip 192.168.1.1:8080] answers",
    "from [ip 172.16.254.1/24] in the log",
    "card [card 4111 1111 1111 1111] expires",
    "paid with [card 5500-0000-0000-0004] yesterday",
    "visa [card 4012888888881881] on file",
    "in 1998 the 3rd of 12 chapters had 240 pages",
    "version 1.2.3 was built on 2021-03-04 at 10:30",
    "price 19.99 and 20% off for 2 or 3 items",
    "section 4.1.2 page 77 line 1024",
    "order 20231105 weighs 12 kg",
    "the 21st century and the 90s",
    "token 9f86d081884c7d659a2feaa0c55ad015 again",
    "sum 3.14159 and 2.71828 are known",
    "room 12-34 on floor 5 at noon",
    "the function(s) f(x) and g(x).y return",
    "see list(a).size or main() for this",
    "follow @example and @other there",
)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed kinds, leftmost and without overlap
    inside a kind, by start, then kind."""
    out: list[tuple[int, int, int]] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        else:
            # a later local part may begin anywhere after this sign
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    if _MARK.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _DIGITS.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# -- the field ---------------------------------------------------------------

TAGS = ("O",) + tuple(f"{p}-{k}" for k in KINDS for p in "BI")
_SHAPE = str.maketrans(
    {**{c: "d" for c in "0123456789"}, **{chr(c): "x" for c in range(97, 123)}, **{chr(c): "X" for c in range(65, 91)}}
)
_LETTERS = re.compile("([xX])\\1+")


def shape(word: str) -> tuple[str, str]:
    """The word's shape with run lengths (to 9 and more), and without."""
    return _shape(word.translate(_SHAPE))


def _shape(mapped: str) -> tuple[str, str]:
    long, short = [], []
    k = 0
    while k < len(mapped):
        c, j = mapped[k], k
        if not c.isascii():
            c = "x" if c.isalpha() else "?"
        while j < len(mapped) and (mapped[j] == mapped[k] or (c == "x" and not mapped[j].isascii() and mapped[j].isalpha())):
            j += 1
        long.append(f"{c}{min(j - k, 9)}" if c == "d" else c)
        short.append(c)
        k = j
    return "".join(long[:24]), "".join(short[:24])


def _features(before: str, long: str, short: str, digits: int, after: str) -> list[int]:
    names = (
        f"a{long}", f"b{short}", f"c{digits}", f"d{before}", f"e{after}",
        f"f{short}|{after}", f"g{before}|{short}",
    )
    return [zlib.crc32(n.encode("utf-8", "replace")) % ROWS for n in names]


def word_features(words: list[str]) -> np.ndarray:
    """(words, 7) hashed feature rows: own shapes, size, neighbours' shapes."""
    shapes = [("^", "^"), *map(shape, words), ("$", "$")]
    out = np.empty((len(words), 7), np.int32)
    for k, word in enumerate(words):
        (_, before), (long, short), (_, after) = shapes[k], shapes[k + 1], shapes[k + 2]
        out[k] = _features(before, long, short, min(word.translate(_SHAPE).count("d"), 20), after)
    return out


class _Shapes(dict):
    """Word to the number of its shape, worked out at its first use."""

    def __init__(self):
        super().__init__()
        self.shapes = [("^", "^", 0), ("$", "$", 0)]  # before and after a text
        self.numbers: dict[tuple[str, str, int], int] = {}
        self.forms: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        # Runs of letters have no length in a shape, so most words share a form.
        form = _LETTERS.sub(r"\1", word.translate(_SHAPE))
        number = self.forms.get(form)
        if number is None:
            own = (*_shape(form), min(form.count("d"), 20))
            number = self.numbers.setdefault(own, len(self.shapes))
            if number == len(self.shapes):
                self.shapes.append(own)
            self.forms[form] = number
        self[word] = number
        return number


@dataclass(frozen=True)
class Field:
    emission: np.ndarray  # (ROWS, tags)
    transition: np.ndarray  # (tags, tags)
    start: np.ndarray  # (tags,)

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Best tag of every word of every sequence of feature rows."""
        scores = [self.emission[s].sum(axis=1) for s in sequences]
        for own in scores:
            own[:1] += self.start
        return self.best(scores)

    def best(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Best tags for the (words, tags) scores of every sequence, what its
        ends add included: Viterbi over batches of sequences of like length."""
        out: list[np.ndarray] = [np.empty(0, np.int8)] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
        at = 0
        while at < len(order):
            end, longest = at, 0
            while end < len(order) and (end == at or len(sequences[order[end]]) * (end - at + 1) <= BATCH_CELLS):
                longest = len(sequences[order[end]])
                end += 1
            part = order[at:end]
            at = end
            sizes = np.array([len(sequences[k]) for k in part])
            scores = np.zeros((len(part), longest, len(TAGS)), np.float32)
            for row, k in enumerate(part):
                scores[row, : sizes[row]] = sequences[k]
            back = np.zeros((len(part), longest, len(TAGS)), np.int8)
            best = scores[:, 0]
            for t in range(1, longest):
                step = best[:, :, None] + self.transition[None]
                back[:, t] = step.argmax(axis=1)
                new = step.max(axis=1) + scores[:, t]
                live = (sizes > t)[:, None]
                back[:, t] = np.where(live, back[:, t], np.arange(len(TAGS)))
                best = np.where(live, new, best)
            tag = best.argmax(axis=1)
            tags = np.zeros((len(part), longest), np.int8)
            rows = np.arange(len(part))
            for t in range(longest - 1, -1, -1):
                tags[:, t] = tag
                tag = back[rows, t, tag] if t else tag
            for row, k in enumerate(part):
                out[k] = tags[row, : sizes[row]]
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def train_field(rows: list[tuple[list[str], list[int]]]) -> Field:
    """Maximum likelihood with a ridge, by Adam over all sequences at once
    (forward-backward over padded batches).  No rows: a field of all O."""
    k = len(TAGS)
    emission, transition, start = np.zeros((ROWS, k)), np.zeros((k, k)), np.zeros(k)
    allowed = np.zeros((k, k))
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            allowed[:, j] = [0.0 if a[2:] == tag[2:] and a != "O" else -20.0 for a in TAGS]
    first = np.array([-20.0 if t[0] == "I" else 0.0 for t in TAGS])
    rows = [(w, t) for w, t in rows if w]
    if not rows:
        emission[:, 0] = 1.0
        return Field(emission.astype(np.float32), allowed.astype(np.float32), first.astype(np.float32))
    longest = max(len(w) for w, _ in rows)
    n = len(rows)
    feats = np.zeros((n, longest, 7), np.int32)
    tags = np.zeros((n, longest), np.int64)
    mask = np.zeros((n, longest), bool)
    for r, (words, own) in enumerate(rows):
        feats[r, : len(words)] = word_features(words)
        tags[r, : len(words)] = own
        mask[r, : len(words)] = True
    hot = np.eye(k)[tags] * mask[..., None]
    params = [emission, transition, start]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    words = mask.sum()
    for epoch in range(1, EPOCHS + 1):
        trans, begin = transition + allowed, start + first
        scores = emission[feats].sum(axis=2)
        alpha = np.zeros((n, longest, k))
        beta = np.zeros((n, longest, k))
        alpha[:, 0] = begin + scores[:, 0]
        for t in range(1, longest):
            new = _logsum(alpha[:, t - 1][:, :, None] + trans[None], 1) + scores[:, t]
            alpha[:, t] = np.where(mask[:, t][:, None], new, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = _logsum(trans[None] + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1][:, None], new, beta[:, t + 1])
        total = _logsum(alpha[:, -1], 1)
        node = np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
        wrong = (hot - node) / words
        g_trans = np.zeros((k, k))
        for t in range(1, longest):
            live = mask[:, t]
            if not live.any():
                break
            edge = np.exp(
                alpha[live, t - 1][:, :, None] + trans[None] + (scores[live, t] + beta[live, t])[:, None, :]
                - total[live][:, None, None]
            )
            g_trans += (hot[live, t - 1].T @ hot[live, t] - edge.sum(axis=0)) / words
        g_emit = np.zeros_like(emission)
        for f in range(feats.shape[2]):
            np.add.at(g_emit, feats[..., f][mask], wrong[mask])
        grads = [g_emit, g_trans, wrong[:, 0].sum(axis=0)]
        for p, g, (m, v) in zip(params, grads, moments):
            g = g - RIDGE / words * p * len(rows)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.15 * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
    return Field(
        emission.astype(np.float32), (transition + allowed).astype(np.float32), (start + first).astype(np.float32)
    )


def sequences_of(text: str) -> list[list[tuple[int, int]]]:
    """The word spans of each training sequence of a text: maximal runs of
    words no further than REACH from one with a mark."""
    if not _MARK.search(text):
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    out: list[list[tuple[int, int]]] = []
    last = -1
    for k, (a, b) in enumerate(spans):
        if _MARK.search(text, a, b):
            low = max(k - REACH, last + 1)
            if low > last + 1 or not out:
                out.append([])
            out[-1] += spans[low : k + REACH + 1]
            last = min(k + REACH, len(spans) - 1)
    return out


def _tags(words: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """Tags of word spans from labelled spans (start, kind, end), sorted."""
    out, at, open_ = [], 0, None
    for a, b in words:
        while at < len(spans) and spans[at][2] <= a:
            at += 1
        if at < len(spans) and spans[at][0] < b:
            start, kind, _ = spans[at]
            out.append(TAGS.index(f"{'I' if open_ == start else 'B'}-{KINDS[kind]}"))
            open_ = start
        else:
            out.append(0)
            open_ = None
    return out


def _ordinary(text: str, marked: set, known: _Shapes, seen: set) -> list[list[tuple[int, int]]]:
    """Seven words around each word outside ``marked`` with a triple of shapes
    that is not in ``seen``, until that holds ORDINARY."""
    spans = [m.span() for m in _WORD.finditer(text)] if len(seen) < ORDINARY else []
    ids = [0, *[known[text[a:b]] for a, b in spans], 1]
    out = []
    for k, span in enumerate(spans):
        triple = tuple(ids[k : k + 3])
        if span not in marked and triple not in seen and len(seen) < ORDINARY:
            seen.add(triple)
            out.append(spans[max(k - 3, 0) : k + 4])
    return out


def labelled_rows(texts: list[str]) -> list[tuple[list[str], list[int]]]:
    """The training table: the fixed sentences, the pattern-tagged sequences
    of ``texts``, each cut into at most 40 words, and around the first
    ORDINARY different triples of shapes of their other words the seven words
    there, as most words lie far from marks."""
    rows = []
    mark = re.compile(r"\[(\w+) ([^\]]*)\]")
    for sentence in LABELLED:
        words, own, at = [], [], 0
        for m in [*mark.finditer(sentence), None]:
            plain = sentence[at : m.start() if m else len(sentence)].split()
            words += plain
            own += [0] * len(plain)
            if m:
                inside = m[2].split()
                words += inside
                own += [TAGS.index(f"B-{m[1]}")] + [TAGS.index(f"I-{m[1]}")] * (len(inside) - 1)
                at = m.end()
        rows.append((words, own))
    rows = rows * 4
    known, seen = _Shapes(), set()
    for text in texts:
        spans = base_spans(text)
        flat = []
        for s in spans:  # overlapping kinds: the first one tags the words
            if not flat or s[0] >= flat[-1][2]:
                flat.append(s)
        marked = sequences_of(text)
        for words in [*marked, *_ordinary(text, {w for own in marked for w in own}, known, seen)]:
            own = _tags(words, flat)
            for c in range(0, len(words), 40):
                rows.append(([text[a:b] for a, b in words[c : c + 40]], own[c : c + 40]))
    return rows


def fit_pii(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """Train on the fixed sentences and at most ``sample_docs`` documents with
    a digit or an at sign, none longer than SAMPLE_CHARS (those with the
    smallest hash of their id)."""
    marked = docs.where(F.col("text").rlike("[0-9@]") & (F.length("text") <= SAMPLE_CHARS)).select(
        F.xxhash64("doc_id", "text").alias("h"), "text"
    )
    # Hashes alone are sorted (every task sends its smallest to the driver);
    # then the texts of the chosen ones, a number known in advance, are read.
    chosen = marked.select("h").distinct().orderBy("h").limit(sample_docs)
    rows = marked.join(F.broadcast(chosen), "h").groupBy("h").agg(F.first("text").alias("text")).collect()
    texts = [r.text for r in sorted(rows, key=lambda r: r.h)]
    return train_field(labelled_rows(texts))


class Tagger:
    """Decodes every word of whole texts."""

    def __init__(self, field: Field):
        self.field = field
        b, i = [k for k, t in enumerate(TAGS) if t[0] == "B"], [k for k, t in enumerate(TAGS) if t[0] == "I"]
        self.b, self.i = b, i
        t = field.transition.astype(np.float64)
        # What a path gains at least if its tag j > 0 of one word becomes O: before
        # the word; after it, where the next tag stays; and after it, where the next
        # tag I-k becomes B-k (which the word after that may follow less well).
        self.before = np.minimum((t[:, :1] - t[:, 1:]).min(axis=0), field.start[0] - field.start[1:])
        stays = [0, *b]
        self.stays = np.minimum((t[0, stays] - t[1:, stays]).min(axis=1), 0.0)
        follow = np.minimum((t[b] - t[i]).min(axis=1), 0.0)
        self.turns = t[0, b] - t[1:, i] + follow
        self.reset()

    def reset(self) -> None:
        self.words = _Shapes()
        self.rows: dict[int, int] = {}
        self.scores = np.empty((0, len(TAGS)), np.float32)
        self.easy, self.need, self.ratio = np.empty(0, bool), np.empty((0, len(KINDS))), np.empty((0, len(KINDS)))

    def _rows(self, keys: np.ndarray) -> np.ndarray:
        """Row of each distinct triple of shapes in the score tables."""
        new = [k for k in keys.tolist() if k not in self.rows]
        if new:
            shapes, low = self.words.shapes, (1 << 21) - 1
            feats = [
                _features(shapes[k >> 42][1], *shapes[k >> 21 & low], shapes[k & low][1]) for k in new
            ]
            for k in new:
                self.rows[k] = len(self.rows)
            scores = self.field.emission[np.array(feats)].sum(axis=1)
            wide = scores.astype(np.float64)
            gain = wide[:, :1] - wide[:, 1:] + self.before
            least = 1e-2  # above what rounding adds up to
            easy = (gain + self.stays > least).all(axis=1)
            need = (least - gain[:, :, None] - self.turns).max(axis=1)
            self.scores = np.concatenate([self.scores, scores])
            self.easy = np.concatenate([self.easy, easy])
            self.need = np.concatenate([self.need, need])
            self.ratio = np.concatenate([self.ratio, wide[:, self.b] - wide[:, self.i]])
        return np.array([self.rows[k] for k in keys.tolist()], np.int64)

    def tagged(self, texts: list[str]) -> list[list[tuple[list[tuple[int, int]], np.ndarray]]]:
        """For each text the runs of words (spans, tags) that hold a tag other than O."""
        if len(self.words) > KNOWN_WORDS:
            self.reset()
        ids: list[int] = []
        for text in texts:
            ids.append(0)
            ids.extend(map(self.words.__getitem__, text.split()))
            ids.append(1)
        shapes = np.array(ids, np.int64)
        at = np.flatnonzero(shapes > 1)
        out: list[list[tuple[list[tuple[int, int]], np.ndarray]]] = [[] for _ in texts]
        if not len(at):
            return out
        keys, inverse = np.unique(shapes[at - 1] << 42 | shapes[at] << 21 | shapes[at + 1], return_inverse=True)
        row = self._rows(keys)[inverse]
        first, last = shapes[at - 1] == 0, shapes[at + 1] == 1
        sure = self.easy[row]
        sure[:-1] &= last[:-1] | (self.ratio[row[1:]] > self.need[row[:-1]]).all(axis=1)
        begins = np.flatnonzero(~sure & (first | np.concatenate(([True], sure[:-1]))))
        ends = np.flatnonzero(~sure & (last | np.concatenate((sure[1:], [True])))) + 1
        parts = []
        for a, b in zip(begins.tolist(), ends.tolist()):
            own = self.scores[row[a:b]]
            own[0] += self.field.start if first[a] else self.field.transition[0]
            if not last[b - 1]:
                own[-1] += self.field.transition[:, 0]
            parts.append(own)
        owner = np.cumsum(shapes == 0)[at] - 1
        spans, of = [], -1
        for a, b, tags in zip(begins.tolist(), ends.tolist(), self.field.best(parts)):
            if tags.any():
                if owner[a] != of:
                    of = int(owner[a])
                    spans = [m.span() for m in _WORD.finditer(texts[of])]
                    offset = int(np.searchsorted(owner, of))
                out[of].append((spans[a - offset : b - offset], tags))
        return out

    def chunks(self, texts: list[str]) -> Iterator[list[tuple[list[tuple[int, int]], np.ndarray]]]:
        """``tagged`` of every text, a bounded number of characters (or one text) at a time."""
        at = 0
        while at < len(texts):
            end, chars = at + 1, len(texts[at])
            while end < len(texts) and chars + len(texts[end]) <= CHUNK_CHARS:
                chars += len(texts[end])
                end += 1
            yield from self.tagged(texts[at:end])
            at = end


def checked_kind(span: str, kind: int) -> int | None:
    """The kind of a span that the field tagged ``kind``, or None.

    Shapes cannot tell a card from any long number, so tags of the digit kinds
    have their digits checked: a card has 13 to 19 passing Luhn, an address four
    dotted numbers of at most 255 first, a phone 7 to 15.  A span that fails as
    tagged is what it passes as, card before address before phone (10 digits or
    more there); one that passes as nothing is no personal data."""
    if kind == 0:
        return kind
    digits = _DIGITS.sub("", span)
    ip = _IP.match(span)
    passes = {
        1: bool(ip) and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in ip[0].split(".")),
        2: 13 <= len(digits) <= 19 and _luhn(digits),
        3: (7 if kind == 3 else 10) <= len(digits) <= 15,
    }
    return next((k for k in (kind, 2, 1, 3) if passes[k]), None)


def _added(text: str, words: list[tuple[int, int]], tags: np.ndarray, base: list[tuple[int, int, int]]) -> list:
    """Spans that the field tags and whose digits pass, without edge punctuation, apart from ``base``."""
    out = []
    k = 0
    while k < len(tags):
        name = TAGS[tags[k]]
        j = k + 1
        if name != "O":
            while j < len(tags) and TAGS[tags[j]] == f"I-{name[2:]}":
                j += 1
            start, end = words[k][0], words[j - 1][1]
            while start < end and not (text[start].isalnum() or text[start] in "+("):
                start += 1
            while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")"):
                end -= 1
            kind = checked_kind(text[start:end], KINDS.index(name[2:])) if start < end else None
            if kind is not None:
                out.append((start, kind + len(KINDS), end))
        k = j
    if not base or not out:
        return out
    starts = np.array([b[0] for b in base])
    ends = np.maximum.accumulate([b[2] for b in base])
    kept = []
    for s in out:
        n = int(np.searchsorted(starts, s[2], side="left"))  # base spans that begin before its end
        if n == 0 or ends[n - 1] <= s[0]:
            kept.append(s)
    return kept


SPAN_TYPE = "array<struct<start:int,kind:int,end:int>>"


def pii_spans(text: Column, field: Field) -> Column:
    """All spans of whole texts (start, kind: index into NAMES, end; code
    points, end exclusive), by start, then kind.  Null and empty texts have
    none.  Base spans are never removed."""

    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tagger = Tagger(field)
        for texts in parts:
            texts = [t or "" for t in texts]
            out = []
            for t, runs in zip(texts, tagger.chunks(texts)):
                base = base_spans(t)
                spans = list(base)
                for words, tags in runs:
                    spans += _added(t, words, tags, base)
                out.append([{"start": a, "kind": k, "end": b} for a, k, b in sorted(spans)])
            yield pd.Series(out, dtype=object)

    return F.pandas_udf(scan, SPAN_TYPE)(text.cast("string"))


def find_pii(docs: DataFrame, field: Field) -> DataFrame:
    """(row, spans) for every row of ``docs``; further columns stay in ``row``."""
    return docs.select(F.struct("*").alias("row"), pii_spans(F.col("text"), field).alias("spans"))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in NAMES])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
