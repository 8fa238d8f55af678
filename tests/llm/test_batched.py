"""Operators with numpy batches: suffix arrays, SimHash, personal data, token
counts, string tiling and compression distance, against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fixtures import awkward_docs, awkward_texts, empty_docs, labels_of
from tripscope.llm import decontamination, pii, queries, simhash, suffix_dedup, token_counts, toxicity
from tripscope.llm.common import table
from tripscope.llm.components import connected_components

SF = "/root/testdata/sf0.001"
SF_LABELS = "/root/testdata/sf0.01"


# -- suffix arrays ---------------------------------------------------------------


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        hit = np.zeros(len(d) + 2, np.int8)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                hit[i + 1 : i + 1 + length] = 1
        edge = np.flatnonzero(np.diff(hit))
        out.append(list(zip(edge[::2].tolist(), edge[1::2].tolist())))
    return out


def random_parts(rng, alphabet, n):
    parts = [bytes(rng.choice(alphabet) for _ in range(rng.randint(20, 120))) for _ in range(n)]
    for _ in range(n // 2):
        a = rng.choice(parts)
        i = rng.randrange(len(a))
        parts.append(a[:i] + bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 5))) + a[i:])
    return parts


@pytest.mark.parametrize("seed", range(12))
def test_shard_order_prefixes_and_merge(seed):
    rng = random.Random(seed)
    length = rng.choice([12, 16, 20, 33])
    parts = [p for p in random_parts(rng, b"ab" if seed % 2 else b"abcdefgh", 12) if len(p) >= length]
    shard = suffix_dedup.Shard(parts, length)
    data, order = shard.buffer, shard.order.tolist()
    assert [data[i : i + length] for i in order] == sorted(data[i : i + length] for i in order)
    shared = suffix_dedup.common_prefixes(np.frombuffer(data, np.uint8), shard.order)
    for k in range(1, len(order)):
        x, y = data[order[k - 1] :], data[order[k] :]
        same = next((n for n, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        assert shared[k] == same

    def cover(ranges):
        out = collections.defaultdict(set)
        for k, a, b in ranges:
            out[k].update(range(a, b))
        return out

    want = cover((k, a, b) for k, r in enumerate(brute_repeats([p.decode() for p in parts], length)) for a, b in r)
    assert cover(shard.ranges()) == want
    one_anchor = np.zeros(len(parts), np.int64)
    assert cover(suffix_dedup.repeated_in_group(one_anchor, parts, length, shard_bytes=150)) == want


def check_repeats(spark, texts, length, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, length, **kw).collect()}
    assert len(got) == len(texts)
    for k, want in enumerate(brute_repeats(texts, length)):
        data = (texts[k] or "").encode()
        kept = b"".join(data[a:b] for a, b in zip([0] + [e for _, e in want], [s for s, _ in want] + [len(data)]))
        r = got[k]
        assert [(s.start, s.end) for s in r.spans] == want
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(data), len(data) - len(kept), len(want), kept)


@pytest.mark.parametrize("kw", [{}, {"hot": 2, "group_segments": 8}])
def test_repeats_equal_brute_force(spark, kw):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 300))) for _ in range(40)]
    passage = "".join(rng.choice("xyz") for _ in range(70))
    texts = base + [rng.choice(base)[:150] + passage[: rng.randint(30, 70)] + rng.choice(base)[50:] for _ in range(50)]
    texts += ["ab" * 200, "ab" * 90, "q" * 500, None, "", base[3], base[3]]
    check_repeats(spark, texts, 40, **kw)


def test_repeats_of_the_documents_table(spark):
    rows = table(spark, SF, "documents").orderBy("doc_id").collect()
    want = brute_repeats([r.text for r in rows], suffix_dedup.LENGTH)
    got = {r.doc_id: r for r in queries.op1_suffix_dedup(spark, SF).collect()}
    for r, spans in zip(rows, want):
        data = r.text.encode()
        kept = b"".join(data[a:b] for a, b in zip([0] + [e for _, e in spans], [s for s, _ in spans] + [len(data)]))
        assert got[r.doc_id].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeats_edge_cases(spark):
    assert suffix_dedup.remove_repeats(empty_docs(spark)).count() == 0
    rows = suffix_dedup.remove_repeats(awkward_docs(spark, extra=True), 400).collect()
    assert len(rows) == len(awkward_texts()) + 4
    # a repeated row repeats itself: rows 3 (too short) aside, "y..." overlaps itself
    long = next(r for r in rows if r.doc_id == 8)
    assert long.n_removed == 50_000 and long.n_spans == 1
    twice = spark.createDataFrame([(1, "u" + "v" * 10 + "w" * 30)] * 2, "doc_id long, text string")
    assert [r.n_removed for r in suffix_dedup.remove_repeats(twice, 20).collect()] == [41, 41]


# -- SimHash ----------------------------------------------------------------------


def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(spark):
    docs = awkward_docs(spark, extra=True)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id is not None}
    assert all(r.fp % (1 << 64) == prints[r.doc_id] for r in rows if r.doc_id is not None)
    want = brute_components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == want
    zero = [r for r in rows if r.doc_id is None and r.fp == 0]
    assert [r.component_id for r in zero] == [0]


@pytest.mark.parametrize("limit", [12, simhash.GROUP_LIMIT])
def test_links_survive_splitting(spark, limit):
    rng = random.Random(limit)
    nodes = {rng.getrandbits(64) for _ in range(60)}
    for _ in range(240):
        x = rng.choice(sorted(nodes))
        for _ in range(rng.randint(1, 4)):
            x ^= 1 << rng.randrange(64)
        nodes.add(x)
    nodes |= {rng.getrandbits(6) | 0xFF00FF00FF00FF00 for _ in range(60)}
    signed = [n - (1 << 64) if n >> 63 else n for n in nodes]
    links = simhash.fingerprint_links(spark.createDataFrame([(n,) for n in signed], "fp long"), limit=limit)
    got = {r.node: r.component for r in connected_components(links).collect()}
    want = brute_components(signed, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 3)
    groups = collections.Counter(want.values())
    assert {n: got.get(n, n) for n in signed} == want
    assert len(groups) < len(signed)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {1000 + k: 1000 for k in range(300)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_of_each_group(spark):
    docs = awkward_docs(spark, extra=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = simhash.near_duplicates(docs).collect()
    assert kept.count() == len({r.component_id for r in rows})
    assert simhash.keep_one(empty_docs(spark)).count() == 0
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


def test_keep_one_names_groups_by_themselves_not_by_an_id(spark):
    rng = random.Random(11)
    a, b, c, d, e, f = (" ".join(f"{rng.getrandbits(40):x}" for _ in range(40)) for _ in range(6))
    rows = [
        (None, a), (None, b), (None, b), (None, c),  # unrelated texts without an id, one of them repeated
        (5, d), (9, d), (5, e), (12, e),  # one id with two texts, each the smallest of its group
        (None, f), (7, f),  # an id is kept before none
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert len({r.component for r in simhash.near_duplicates(docs).collect()}) == 6
    kept = sorted(((r.doc_id or 0, r.text) for r in simhash.keep_one(docs).collect()))
    assert kept == sorted([(0, a), (0, b), (0, c), (5, d), (5, e), (7, f)])


# -- personal data ----------------------------------------------------------------


def luhn(digits):
    return sum(v - 9 * (v > 9) for k, c in enumerate(reversed(digits)) for v in [int(c) * (1 + k % 2)]) % 10 == 0


PATTERNS = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(x) <= 255 for x in m.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m, d: 14 <= len(d) <= 19 and luhn(d)),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 10 <= len(d) <= 15),
]


def brute_pii(text):
    return sorted(
        (m.start(), k, m.end())
        for k, (p, keep) in enumerate(PATTERNS)
        for m in re.finditer(p, text)
        if keep(m[0], re.sub("[^0-9]", "", m[0]))
    )


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for text in [t or "" for t in awkward_texts() if len(t or "") < 5000]:
        assert pii.base_spans(text) == brute_pii(text)
    for _ in range(20_000):
        text = "".join(rng.choice("a1@.+- (5)%\n9Z") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute_pii(text), text
    assert pii.base_spans("a" * 200_000 + "1" * 200_000) == []  # long runs stay linear


def test_field_decodes_like_brute_force():
    rng = np.random.default_rng(2)
    k = len(pii.TAGS)
    field = pii.Field(
        rng.normal(size=(pii.ROWS, k)).astype(np.float32),
        rng.normal(size=(k, k)).astype(np.float32),
        rng.normal(size=k).astype(np.float32),
    )
    import itertools

    sequences = [pii.word_features(w.split()) for w in ("a1 b", "x", "call +1 now", "1 2 3 4")]
    for seq, tags in zip(sequences, field.decode(sequences)):
        def score(path):
            s = field.start[path[0]] + sum(field.emission[seq[t]].sum(axis=0)[p] for t, p in enumerate(path))
            return s + sum(field.transition[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product(range(k), repeat=len(seq)), key=score)
        assert abs(score(best) - score(tags.tolist())) < 1e-3


def test_pii_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in queries.op6_pii(spark, SF).collect():
        base = brute_pii(texts[r.doc_id])
        want = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) <= set(r.spans.split(",")) or not want
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == n for _, k, _ in base) for n in range(4))


def test_field_adds_what_the_patterns_miss(spark):
    field = pii.fit_pii(table(spark, SF, "documents"))
    docs = spark.createDataFrame(
        [(1, "please call (212) 555-0134 now"), (2, "in 1999 there were 24 of them"), (3, None), (4, "")],
        "doc_id long, text string",
    )
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_pii(docs, field).select("row.doc_id", "spans").collect()}
    assert found == {1: [(12, 7, 26)], 2: [], 3: [], 4: []}
    assert pii.find_pii(empty_docs(spark), field).count() == 0
    assert pii.find_pii(awkward_docs(spark, extra=True), pii.fit_pii(empty_docs(spark))).count() == len(awkward_texts()) + 4


def test_digits_of_added_spans_are_checked():
    card, ip, phone, email = (pii.KINDS.index(k) for k in ("card", "ip", "phone", "email"))
    assert pii.checked_kind("4111.1111.1111.1111", card) == card
    assert pii.checked_kind("4111.1111.1111.1111", ip) == card  # what it passes as
    assert pii.checked_kind("4111.1111.1111.1112", card) is None
    assert pii.checked_kind("10.0.0.1/24", ip) == ip
    assert pii.checked_kind("300.456.1.5", ip) is None
    assert pii.checked_kind("555-867-5309", ip) == phone
    assert pii.checked_kind("555-0134", phone) == phone
    assert pii.checked_kind("555-0134", card) is None
    assert pii.checked_kind("no digits", phone) is None
    assert pii.checked_kind("info@localhost", email) == email
    assert pii.checked_kind("9" * 100_000, card) is None


def test_added_spans_of_planted_data(spark):
    rng = random.Random(8)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))

    def number(valid):
        while True:
            digits = d(16)
            if pii._luhn(digits) == valid:
                return digits

    groups = lambda s, sep: sep.join(s[i : i + 4] for i in range(0, 16, 4))
    planted = [
        ("phone", lambda: f"({d(3)}) {d(3)}-{d(4)}"),
        ("phone", lambda: f"{d(3)}-{d(3)}-{d(4)}"),
        ("phone", lambda: f"{d(3)}.{d(3)}.{d(4)}"),
        ("phone", lambda: f"1-800-{d(3)}-{d(4)}"),
        ("card", lambda: groups(number(True), "  ")),
        ("email", lambda: f"{name()}(at){name()}.com"),
        ("email", lambda: f"{name()}@{name()}"),
    ]
    ordinary = [
        lambda: number(False), lambda: f"20{d(2)}-0{rng.randint(1, 9)}-1{d(1)}", lambda: f"19{d(2)}",
        lambda: f"v{d(1)}.{d(1)}.{d(2)}", lambda: f"${d(3)}.{d(2)}", lambda: "%032x" % rng.getrandbits(128),
        lambda: f"{rng.randint(300, 999)}.{rng.randint(256, 999)}.1.7", lambda: f"{name()}-{name()}", lambda: f"@{name()}",
    ]
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    tagger = pii.Tagger(pii.fit_pii(table(spark, SF, "documents")))
    words = [t.split() for _, t in sorted(texts.items()) if t and not re.search("[0-9@]", t) and len(t.split()) > 30][:40]

    def kinds(value):
        own = rng.choice(words)
        at = rng.randint(5, len(own) - 5)
        text = " ".join([*own[at - 5 : at], value, *own[at : at + 5]])
        base = pii.base_spans(text)
        return {pii.NAMES[k] for w, tags in next(tagger.chunks([text])) for _, k, _ in pii._added(text, w, tags, base)}

    found = [f"crf_{kind}" in kinds(make()) for kind, make in planted for _ in range(40)]
    assert sum(found) / len(found) > 0.8
    false = [bool(kinds(make())) for make in ordinary for _ in range(40)]
    assert sum(false) / len(false) < 0.05


def test_every_word_is_decoded(spark):
    field = pii.fit_pii(table(spark, SF, "documents"))
    plain = "we met and talked for a while in the old town hall and nobody minded the rain at all "
    rows, wanted = [], {}
    for k, sentence in enumerate(pii.LABELLED):
        text = re.sub(r"\[(\w+) ([^\]]*)\]", r"\2", sentence)
        rows.append((k, plain + text + " " + plain))
        m = re.search(r"\[(\w+) ([^\]]*)\]", sentence)
        if m:
            # the fixed patterns' own part of "10.0.0.1/24" stands for the whole
            base = [(pii.KINDS[kind], a, b) for a, kind, b in pii.base_spans(rows[-1][1])]
            wanted[k] = next(iter(base), (m[1], len(plain) + m.start(), len(plain) + m.start() + len(m[2])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(pii.NAMES[s.kind].removeprefix("crf_"), s.start, s.end) for s in r.spans]
             for r in pii.find_pii(docs, field).select("row.doc_id", "spans").collect()}
    assert {k: w for k, w in wanted.items() if w not in found[k]} == {}

    def whole(text):  # Viterbi over every word at once
        words = [m.span() for m in re.finditer(r"\S+", text)]
        tags = field.decode([pii.word_features([text[a:b] for a, b in words])])[0] if words else []
        return [(w, pii.TAGS[t]) for w, t in zip(words, tags) if t]

    texts = [t or "" for t in awkward_texts() if len(t or "") < 5000] + [t for _, t in rows]
    texts += [r.text for r in table(spark, SF, "documents").limit(60).collect()]
    for text, runs in zip(texts, pii.Tagger(field).chunks(texts)):
        assert [(w, pii.TAGS[t]) for words, tags in runs for w, t in zip(words, tags) if t] == whole(text)


# -- token counts -----------------------------------------------------------------


def test_histogram_and_suffix_sums(spark):
    with open(token_counts.RANKS, "rb") as f:
        encode = token_counts.encoder(f.read()).encode_ordinary
    docs = awkward_docs(spark, extra=True)
    lengths = [len(encode(r.text)) if r.text else 0 for r in docs.select("text").collect()]
    hist = token_counts.length_histogram(docs)
    sums = token_counts.suffix_sums(hist, block=16)
    rows = sums.collect()
    assert {r.n_tokens: r.n_docs for r in rows} == dict(collections.Counter(lengths))
    for r in rows:
        n = r.n_tokens
        assert r.docs_over == sum(x > n for x in lengths)
        assert r.tokens_over == sum(x for x in lengths if x > n)
        assert r.tokens_within == sum(x for x in lengths if x <= n)
        assert r.tokens_truncated == sum(min(x, n) for x in lengths)
        assert r.share_within == sum(x <= n for x in lengths) / len(lengths)
    for r in token_counts.at_limits(hist, [0, 7, 100, 10**6]).collect():
        assert r.tokens_truncated == sum(min(x, r.context_limit) for x in lengths)
        assert r.docs_over == sum(x > r.context_limit for x in lengths)
    ordered = sorted(lengths)
    for r in token_counts.quantiles(sums, [0.25, 0.5, 1.0]).collect():
        assert r.n_tokens == ordered[-(-int(r.share * 100) * len(ordered) // 100) - 1]
    assert token_counts.token_counts(empty_docs(spark)).count() == 0


def test_encoding_round_trip(spark):
    with open(token_counts.RANKS, "rb") as f:
        encoder = token_counts.encoder(f.read())
    for r in table(spark, SF, "documents").collect():
        assert encoder.decode(encoder.encode_ordinary(r.text)) == r.text


# -- string tiling ----------------------------------------------------------------


def brute_tiles(item, text, least):
    """Longest common run of unmarked words again and again."""
    p, t, marked = [True] * len(item), [True] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and p[i + n] and t[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return marked
        p[i : i + n] = [False] * n
        t[j : j + n] = [False] * n
        marked += n


def test_tiles_equal_strict_tiling():
    rng = random.Random(4)
    for n in range(400):
        letters, least = rng.choice([2, 4, 6, 20]), rng.choice([1, 2, 3, 5])
        item = [rng.randrange(letters) for _ in range(rng.randint(0, 25))]
        text = [rng.randrange(letters) for _ in range(rng.randint(0, 25))]
        for _ in range(rng.randint(0, 3)):  # passages of the item, overlapping ones too
            a = rng.randint(0, len(item))
            text += item[a : a + rng.randint(0, 12)] + [99] * rng.randint(0, 1)
        tiled = decontamination.tiles(np.array(item, np.int64), np.array(text, np.int64), least)
        assert sum(n for _, _, n in tiled) == brute_tiles(item, text, least)
        for where, place in ((item, 0), (text, 1)):
            used = [k for t in tiled for k in range(t[place], t[place] + t[2])]
            assert len(used) == len(set(used)) and all(0 <= k < len(where) for k in used)
        assert all(item[p : p + n] == text[t : t + n] for p, t, n in tiled)


def test_coverage_of_documents_equals_strict_tiling():
    """Items split over several runs of the document, through the index."""
    rng = random.Random(11)
    several = 0
    for _ in range(300):
        item = [f"w{rng.randrange(12)}" for _ in range(rng.randint(5, 30))]
        text = []
        for _ in range(rng.randint(1, 5)):
            a = rng.randrange(len(item))
            text += item[a : a + rng.randint(3, 14)] + [f"x{rng.randrange(9)}" for _ in range(rng.randint(0, 6))]
        index = decontamination.BenchmarkIndex([(1, " ".join(item))])
        found = index.matches(" ".join(text))
        words = brute_tiles(item, text, 5)
        if words >= 0.6 * len(item):
            assert [(f["n_words"], f["coverage"]) for f in found] == [(words, words / len(item))]
            several += found[0]["n_tiles"] > 1
        else:
            assert found == []
    assert several > 20


def test_words_of_a_document_count_once():
    index = decontamination.BenchmarkIndex([(1, "a b c d e d e f g h")])
    assert index.matches("a b c d e f g h") == []  # 5 of 10 words
    assert decontamination.tiles(np.array([1, 2, 3, 4, 5, 4, 5, 6, 7, 8]), np.array([1, 2, 3, 4, 5, 6, 7, 8]), 5) == [(0, 0, 5)]


def test_window_hashes_run():
    tokens = np.array([3, 1, 4, 1, 5, 9, 2, 6, 3, 1, 4], np.int64)
    for size in range(1, 13):
        hashes = decontamination.window_hashes(tokens, size)
        assert len(hashes) == max(0, len(tokens) - size + 1)
        for i in range(len(hashes)):
            want = sum(int(t) * pow(decontamination._BASE, k, 1 << 64) for k, t in enumerate(tokens[i : i + size])) % (1 << 64)
            assert int(hashes[i]) == want


def test_repetitive_texts_are_tiled():
    item, text = np.full(40, 7), np.full(5000, 7)
    assert decontamination.tiles(item, text, 5) == [(0, 0, 40)]
    both = decontamination.tiles(np.array([7] * 40 + [8] * 6), np.array([8] * 6 + [1] + [7] * 30), 5)
    assert both == [(0, 7, 30), (40, 0, 6)]


def test_reordered_passages_are_caught(spark):
    item = "the quick brown fox jumps over a lazy dog while seven wizards quietly boil green tea at noon"
    words = item.split()
    benchmark = spark.createDataFrame(
        [(1, item), (1, item), (2, "tiny one"), (3, None), (4, ""), (5, "   ")], "item_id long, text string"
    )
    docs = spark.createDataFrame(
        [
            (1, "So: " + item.upper() + "!"),
            (2, "x " + " ".join(words[9:]) + " y z " + " ".join(words[:9])),
            (3, " ".join(words[:6]) + " and nothing else of it"),
            (4, " ".join(reversed(words))),
            (5, None),
            (6, ""),
            (7, "a tiny one here"),
            (1, "So: " + item.upper() + "!"),
        ],
        "doc_id long, text string",
    ).withColumn("row", F.lit(1)).withColumn("found", F.lit(2))
    pairs = sorted((r.doc_id, r.item_id) for r in decontamination.contaminated_pairs(docs, benchmark).collect())
    assert pairs == [(1, 1), (1, 1), (2, 1), (7, 2)]
    kept = decontamination.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    none = benchmark.where("false")
    assert decontamination.contaminated_pairs(docs, none).count() == 0
    assert decontamination.drop_contaminated(docs, none).count() == 8
    assert decontamination.contaminated_pairs(empty_docs(spark), benchmark).count() == 0


def test_benchmark_blocks_hold_every_item(spark):
    benchmark = table(spark, SF, "benchmark")
    blocks = list(decontamination.benchmark_blocks(benchmark, block_chars=1000))
    assert len(blocks) > 3
    assert sorted(i for b in blocks for i in b) == sorted((r.item_id, r.text) for r in benchmark.collect())


def test_whole_items_in_documents_are_found(spark):
    items = {r.item_id: decontamination.words(r.text) for r in table(spark, SF_LABELS, "benchmark").collect()}
    docs = {r.doc_id: " " + " ".join(decontamination.words(r.text)) + " " for r in table(spark, SF_LABELS, "documents").collect()}
    whole = {(d, i) for d, t in docs.items() for i, w in items.items() if " " + " ".join(w) + " " in t}
    got = {(r.doc_id, r.item_id) for r in queries.op9_decontamination(spark, SF_LABELS).collect()}
    assert whole and whole <= got


def test_items_that_repeat_themselves_are_found(spark):
    line = "row your boat gently down the stream once more now"
    words = (line + " " + line).split()
    items = [(1, " ".join([line] * 10)), (2, "ha " * 40), (3, "one two three four five six seven eight nine ten")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(
        [
            (1, "so: " + items[0][1] + " end"),
            (2, "x " + items[1][1]),
            (3, "x " + " ".join(words[:7]) + " y"),
            (4, "a " + " ".join(words) + " b"),  # 20 of the 100 words
        ],
        "doc_id long, text string",
    )
    found = {(r.doc_id, r.item_id): r for r in decontamination.contaminated_pairs(docs, benchmark).collect()}
    assert sorted(found) == [(1, 1), (2, 2)]
    assert found[1, 1].coverage == found[2, 2].coverage == 1.0
    assert sorted(r.doc_id for r in decontamination.drop_contaminated(docs, benchmark).collect()) == [3, 4]


# -- compression distance ----------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    out = queries.op10_toxicity(spark, SF_LABELS)
    rows = out.join(table(spark, SF_LABELS, "labels"), "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.5
    assert sum(r.predicted for r in clean) / len(clean) < 0.05
    assert out.count() == 1000


def test_toxicity_edge_cases(spark):
    docs = awkward_docs(spark, extra=True)
    for labels in ([], [(1, 1, 0)], [(k, 1, k % 2) for k in range(5, 30)]):
        model = toxicity.fit_toxicity(docs, labels_of(spark, labels))
        scores = [r[0] for r in docs.select(toxicity.toxicity_score(F.col("text"), model)).collect()]
        assert len(scores) == len(awkward_texts()) + 4
        assert all(s is not None and 0 <= s <= 1 for s in scores)
    assert empty_docs(spark).select(toxicity.toxicity_score(F.col("text"), model)).count() == 0
    assert toxicity.windows(b"") == [] and b"".join(toxicity.windows(b"ab " * 500)) == b"ab " * 500


def brute_marks(toxic, ordinary):
    def runs(data):
        return collections.Counter(data[i : i + toxicity.RUN] for i in range(len(data) - toxicity.RUN + 1))

    there, holders, elsewhere = collections.Counter(), collections.Counter(), collections.Counter()
    for data in toxic:
        holders.update(runs(data).keys())
        there.update({r: min(n, toxicity.RUN_CAP) for r, n in runs(data).items()})
    for data in ordinary:
        elsewhere.update({r: min(n, toxicity.RUN_CAP) for r, n in runs(data).items()})
    least = max(3, toxicity.RUN_SHARE * len(toxic))

    def evidence(a, b):
        share = len(toxic) / (len(toxic) + len(ordinary))
        parts = [(a, (a + b) * share), (b, (a + b) * (1 - share))]
        return sum(2 * seen * math.log(seen / expected) for seen, expected in parts if seen)

    return {
        r
        for r, n in there.items()
        if holders[r] >= least
        and n / len(toxic) > toxicity.RUN_RATIO * (elsewhere[r] + 0.5) / len(ordinary)
        and evidence(n, elsewhere[r]) > toxicity.RUN_EVIDENCE
    }


@pytest.mark.parametrize("places", [1 << 22, 64])
def test_marking_runs_equal_brute_force(monkeypatch, places):
    monkeypatch.setattr(toxicity, "TABLE", places)  # with 64 places nearly all runs share one
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "epsilon"]
    ordinary = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))).encode() for _ in range(200)]
    toxic = [b" ".join([d, b"horrid thing", d[:9]] if k % 3 else [d, b"vile", b"vile stuff"]) for k, d in enumerate(ordinary[:60])]
    got = {int(r).to_bytes(toxicity.RUN, "big") for r in toxicity.marking_runs(toxic, ordinary)}
    assert got == brute_marks(toxic, ordinary) and b"horrid" in got
    assert len(toxicity.marking_runs([], ordinary)) == 0 and len(toxicity.marking_runs([b""] * 4, [])) == 0


def test_toxic_pieces_are_parts_of_words_that_mark_the_class():
    plain = [f"the plain words of text {k} go on".encode() for k in range(300)]
    toxic = [d + b" vermin and horridly horridness " for d in plain[:60]] + [d + b" rare" for d in plain[:2]]
    pieces = toxicity.toxic_pieces(toxic, plain)
    assert pieces[b" vermin"] == 60 and pieces[b" horridly"] == 60 and pieces[b" horridness"] == 60
    assert not any(b"rare" in w or b"plain" in w for w in pieces)
    assert toxicity.toxic_pieces([], plain) == toxicity.toxic_pieces(plain[:9], plain) == {}


def test_more_pieces_than_the_dictionary_holds(monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC_BYTES", 512)
    letters = random.Random(4)
    odd = ["".join(letters.choice("qxzjkvw") for _ in range(12)) for _ in range(80)]
    rows = [(f"the plain words of text {k} go on", 0) for k in range(300)]
    rows += [(f"the words of text {k} " + " ".join(odd[(k * 7 + j) % 80] for j in range(12)), 1) for k in range(120)]
    model = toxicity.train_toxicity(rows)
    assert 0 < len(model.toxic) <= 512
    pair = model.compressors()
    scores = model.probability([toxicity.features(toxicity.normal(t), *pair) for t in (rows[0][0], rows[310][0])])
    assert scores[0] < 0.5 < scores[1]


def test_window_savings_equal_direct_compression():
    import zstandard

    rows = [(f"good plain words number {k} of an ordinary text", 0) for k in range(200)]
    rows += [(f"some plain words then horrid vile thing number {k}", 1) for k in range(80)]
    model = toxicity.train_toxicity(rows)
    pair = model.compressors()
    for text in ("horrid vile thing " * 40, "good plain words " * 90, "", "x"):
        data = toxicity.normal(text)
        lengths = []
        for content in (model.ordinary, model.toxic + model.ordinary):
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            lengths.append([
                len(zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=shared, write_content_size=False, write_dict_id=False).compress(toxicity.LEAD + w))
                for w in toxicity.windows(data)
            ])
        saved = [a - b for a, b in zip(*lengths)]
        got = toxicity.features(data, *pair)
        assert b"".join(toxicity.windows(data)) == data
        if saved:
            assert got[0] == pytest.approx(sum(saved) * 100 / (len(data) + 50)) and got[2] == max(saved)
        else:
            assert got == [0.0] * 8
