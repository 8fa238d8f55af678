"""Toxicity by compression distance: two zstandard dictionaries, one score.

An ordinary dictionary is trained on ordinary text.  A toxic dictionary is
made of the parts of toxic text that ordinary text does not share: byte runs
several times as frequent in toxic documents, by more than chance.  Each window
of a text, a few words long, is compressed with the ordinary dictionary alone
and with the toxic one in front of it; what the second saves tells toxic
windows from others.  Logistic regression on the savings calibrates them to a
probability: each fold of the labelled documents is measured with the
dictionaries of the others, so no document calibrates what it trained.

Fitting sees at most SAMPLE_ROWS documents of either label, none longer than
SAMPLE_CHARS, all of the training folds.  Scoring reads whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import labelled_sample

SAMPLE_ROWS = 3000
SAMPLE_CHARS = 20_000
ORDINARY_BYTES = 4096
TOXIC_BYTES = 3072
#: Bytes of a window (it ends at the next space) and the zstandard level.  The
#: levels above search for the fewest bits by prices that short windows do not
#: have, and pass over matches that would save bytes.
WINDOW = 16
LEVEL = 8
#: Bytes before every window.  They take a few bytes under either dictionary and
#: leave no window stored as it is, so that a saving of one byte is seen.
LEAD = bytes(32)
#: Length of the byte runs that tell the classes apart, the share of toxic
#: documents that must hold one, how much rarer it is elsewhere, how often one
#: document counts at most, and the least likelihood ratio statistic.
RUN = 6
RUN_SHARE = 0.02
RUN_RATIO = 5.0
RUN_CAP = 3
RUN_EVIDENCE = 25.0
#: A piece of toxic text is at least so long and found so often.
PIECE_BYTES = 4
PIECE_TIMES = 3
#: Places of the table that bounds the counting of runs.
TABLE = 1 << 22
FOLDS = 3
THRESHOLD = 0.7
RIDGE = 1e-2


def normal(text: str | None) -> bytes:
    """Lower-cased UTF-8 with single spaces."""
    return b" ".join((text or "").lower().encode("utf-8", "replace").split())


def windows(data: bytes, size: int = WINDOW) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        out.append(data[at:end])
        at = end
    return out


def _train(samples: list[bytes], size: int, segment: int) -> bytes:
    """Dictionary content of ``size`` bytes; too little text to train on is
    the dictionary itself."""
    samples = [s for s in samples if len(s) >= 8]
    total = sum(map(len, samples))
    size = min(size, total // 4)
    if size < 512 or len(samples) < 32:
        return b" ".join(samples)[-ORDINARY_BYTES:]
    try:
        trained = zstandard.train_dictionary(size, samples, k=segment, d=RUN, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]
    return trained[256:]  # the head holds entropy tables, not text


def _runs(data: bytes) -> np.ndarray:
    """The byte runs of RUN bytes at each place, as numbers."""
    wide = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = max(len(wide) - RUN + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(RUN):
        out = (out << np.uint64(8)) | wide[k : k + n]
    return out


def _capped(places: np.ndarray, known: np.ndarray) -> np.ndarray:
    """How often each of the ``known`` (ascending) runs stands at ``places``,
    RUN_CAP at most."""
    runs, times = np.unique(places, return_counts=True)
    at = np.minimum(np.searchsorted(runs, known), max(len(runs) - 1, 0))
    there = runs[at] == known if len(runs) else np.zeros(len(known), bool)
    return np.where(there, np.minimum(times[at], RUN_CAP) if len(runs) else 0, 0)


def marking_runs(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    """The runs that mark the class, ascending.

    A first pass counts the toxic texts that hold each run in a table of
    TABLE places by hash; only runs whose place reaches the least count are
    then counted one by one.  So memory is bounded however long the texts are,
    and a run that others share a place with is still judged by its own count.
    """
    least = max(3, RUN_SHARE * len(toxic))
    mix = np.uint64(0x9E3779B97F4A7C15)
    table = np.zeros(TABLE, np.int32)

    def place(runs: np.ndarray) -> np.ndarray:
        return ((runs * mix) >> np.uint64(40)).astype(np.int64) % TABLE

    for data in toxic:
        np.add.at(table, place(np.unique(_runs(data))), 1)
    found = [np.unique(r[table[place(r)] >= least]) for r in map(_runs, toxic)]
    known, holders = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), [])
    known = known[np.asarray(holders) >= least]
    there, elsewhere = np.zeros(len(known)), np.zeros(len(known))
    for data in toxic:
        there += _capped(_runs(data), known)
    for data in ordinary:
        elsewhere += _capped(_runs(data), known)
    n, m = max(len(toxic), 1), max(len(ordinary), 1)
    telling = _evidence(there, elsewhere, n, m) > RUN_EVIDENCE
    return known[telling & (there / n > RUN_RATIO * (elsewhere + 0.5) / m)]


def _evidence(there: np.ndarray, elsewhere: np.ndarray, n: int, m: int) -> np.ndarray:
    """Twice the log-likelihood ratio of counts in n and m texts against one
    rate for both."""
    total = there + elsewhere
    out = np.zeros(len(total))
    for count, share in ((there, n / (n + m)), (elsewhere, m / (n + m))):
        out += 2 * count * np.log(np.maximum(count, 1) / np.maximum(total * share, 1e-9))
    return out


def toxic_pieces(toxic: list[bytes], ordinary: list[bytes]) -> Counter:
    """How often each piece, the part of a word (with the space before it) that
    runs which mark the class cover, stands in the toxic texts."""
    toxic = [b" " + data + b" " for data in toxic]
    mark = marking_runs(toxic, [b" " + data + b" " for data in ordinary])
    pieces: Counter = Counter()
    for data in toxic:
        cover = np.zeros(len(data) + 2, np.int8)
        at = np.flatnonzero(np.isin(_runs(data), mark))
        for k in range(RUN):
            cover[at + 1 + k] = 1
        edges = np.flatnonzero(np.diff(cover))
        for i, j in zip(edges[::2], edges[1::2]):
            pieces.update(b" " + w for w in data[i:j].split(b" ") if len(w) >= PIECE_BYTES)
    return Counter({w: n for w, n in pieces.items() if n >= PIECE_TIMES})


def _toxic_dictionary(toxic: list[bytes], ordinary: list[bytes]) -> bytes:
    """The pieces as they are where they fit; else zstandard picks from them,
    each repeated as often as it was found.  Without pieces, from whole texts."""
    pieces = toxic_pieces(toxic, ordinary)
    if not pieces:
        return _train(toxic, TOXIC_BYTES, 16)
    if sum(map(len, pieces)) <= TOXIC_BYTES:
        return b"".join(sorted(pieces))
    return _train([w * n for w, n in sorted(pieces.items())], TOXIC_BYTES, 16)


def features(data: bytes, ordinary, toxic) -> list[float]:
    """What the toxic dictionary saves, over the windows of a text."""
    parts = windows(data)
    if not parts:
        return [0.0] * 8
    leads = [LEAD + w for w in parts]
    saved = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in leads], float)
    gain = np.maximum(saved, 0)
    top = np.sort(saved)[::-1]
    size = (len(data) + 50) / 100
    return [
        saved.sum() / size,
        gain.sum() / size,
        top[0],
        top[:3].mean(),
        (saved > 1).mean(),
        np.log1p((saved > 1).sum()),
        np.log1p((saved > 3).sum()),
        np.log1p(len(parts)),
    ]


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]

    def compressors(self):
        out = []
        for content in (self.ordinary, self.toxic + self.ordinary):
            shared = zstandard.ZstdCompressionDict(content or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(level=LEVEL)
            out.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=shared, write_content_size=False, write_dict_id=False
                )
            )
        return out

    def probability(self, rows: list[list[float]]) -> np.ndarray:
        x = (np.array(rows, float).reshape(len(rows), -1) - np.array(self.mean)) / np.array(self.scale)
        margin = self.weights[0] + x @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    a = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w = np.zeros(a.shape[1])
    ridge = RIDGE * len(x) / 100 * np.eye(len(w))
    ridge[0, 0] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + ridge + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, a.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def _dictionaries(texts: dict[int, list[bytes]]) -> tuple[bytes, bytes]:
    ordinary = _train([w for t in texts[0] for w in windows(t, 256)], ORDINARY_BYTES, 64)
    return ordinary, _toxic_dictionary(texts[1], texts[0])


def train_toxicity(rows: list[tuple[str | None, int]], prior: float | None = None) -> ToxicityModel:
    """Train on (text, label) rows: every fold of a class is measured with
    dictionaries of the other folds; the savings of all rows calibrate, and
    the model's dictionaries are trained on all rows.
    ``prior``: the share of label 1 where the rows are balanced by class.
    Without two rows of either class the score is the smoothed share of label 1."""
    texts = {k: [normal(t) for t, y in rows if y == k] for k in (0, 1)}
    n = [len(texts[0]), len(texts[1])]
    flat = (0.0,) * 8, (1.0,) * 8
    if min(n) < 2:
        share = (n[1] + 1) / (sum(n) + 2)
        return ToxicityModel(b"", b"", (float(np.log(share / (1 - share))),) + (0.0,) * 8, *flat)
    x, y = [], []
    folds = min(FOLDS, *n)
    for fold in range(folds):
        content = _dictionaries({k: [t for i, t in enumerate(v) if i % folds != fold] for k, v in texts.items()})
        pair = ToxicityModel(*content, (0.0,) * 9, *flat).compressors()
        for k, v in texts.items():
            x += [features(t, *pair) for t in v[fold::folds]]
            y += [k] * len(v[fold::folds])
    y = np.array(y, float)
    w, mean, scale = _logistic(np.array(x), y)
    if prior is not None and 0 < prior < 1:
        w[0] += np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean()))
    return ToxicityModel(*_dictionaries(texts), tuple(w.tolist()), tuple(mean.tolist()), tuple(scale.tolist()))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Train on at most ``sample_rows`` documents of either label of the
    training folds; the bounded sample is read on the driver."""
    sample = labelled_sample(docs, labels, "toxic", sample_rows, each=True, max_chars=SAMPLE_CHARS)
    rows = sorted((r.doc_id, r.label, r.text) for r in sample.where("text IS NOT NULL").collect())
    return train_toxicity([(t, y) for _, y, t in rows])


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """P(toxic) of whole texts, in Arrow batches; null and empty texts get
    the score of a text without windows.  A column expression: repeated rows
    score alike, an empty table stays empty, and no other column is touched."""

    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pair = model.compressors()
        for texts in parts:
            rows = [features(normal(t), *pair) for t in texts]
            yield pd.Series(model.probability(rows) if rows else [], dtype="float64")

    return F.pandas_udf(scores, "double")(text.cast("string"))
