"""Operators made of column expressions: statistics, rules, classifier,
secrets and mixing, against brute-force versions."""

import collections
import hashlib
import random
import re
import string
import zlib

import pytest
from pyspark.sql import functions as F

from fixtures import awkward_docs, awkward_texts, empty_docs, labels_of
from tripscope.llm import mixing, quality_classifier, quality_rules, queries, secrets
from tripscope.llm.common import hashed_sample, labelled_sample, table
from tripscope.llm.text_stats import features, with_stats

SF = "/root/testdata/sf0.001"
SF_LABELS = "/root/testdata/sf0.01"


def brute_counts(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered))


def test_counts_equal_brute_force(spark):
    rows = with_stats(awkward_docs(spark, extra=True)).select("row.text", "stats.*").collect()
    assert len(rows) == len(awkward_texts()) + 4
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(r.text), r.text[:80]


def test_counts_on_the_documents_table(spark):
    docs = table(spark, SF, "documents")
    for r in with_stats(docs).select("row.text", "stats.*").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(r.text)


def test_quality_rules_keep_good_and_drop_bad(spark):
    docs, labels = table(spark, SF_LABELS, "documents"), table(spark, SF_LABELS, "labels")
    rules = quality_rules.fit_quality_rules(docs, labels)
    assert rules
    out = queries.op4_quality_rules(spark, SF_LABELS)
    joined = out.join(labels, "doc_id").where("NOT base_failed")
    r = joined.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {x.quality: x.kept for x in r}
    assert share[1] > 0.97 and share[0] < 0.1
    assert out.where("base_failed AND kept").count() == 0
    assert out.count() == docs.count()


def test_quality_rules_edge_cases(spark):
    docs = awkward_docs(spark, extra=True)
    none = labels_of(spark, [])
    assert quality_rules.fit_quality_rules(docs, none) == []
    assert quality_rules.fit_quality_rules(docs, labels_of(spark, [(1, 1, 0), (2, 1, None), (None, 0, 0)])) == []
    out = quality_rules.apply_quality_rules(docs, []).select("row.text", "stats.n_words", "base_failed", "kept").collect()
    for r in out:
        words, *_, repeats = brute_counts(r.text)
        assert r.base_failed == (words < 50 or 100 * repeats > 50 * words)
        assert r.kept == (not r.base_failed)
    assert quality_rules.apply_quality_rules(empty_docs(spark), []).count() == 0


def test_decision_list_learns_ordered_conjunctions():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.random((900, 3))
    y = 1 - ((x[:, 0] > 0.7) & (x[:, 1] <= 0.5) | (x[:, 2] > 0.9)).astype(int)
    rules = quality_rules.learn_rules(["a", "b", "c"], x.tolist(), y.tolist())
    hit = np.zeros(len(x), bool)
    for rule in rules:
        hit |= quality_rules.covered(rule, x, ["a", "b", "c"])
    assert ((~hit).astype(int) == y).mean() > 0.95
    assert any(len(r) > 1 for r in rules)
    assert quality_rules.learn_rules(["a"], [[1.0], [2.0]], [1, 1]) == []


def test_quality_classifier_on_held_out_rows(spark):
    out = queries.op8_quality_classifier(spark, SF_LABELS)
    rows = out.join(table(spark, SF_LABELS, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert out.count() == 1000


def test_quality_classifier_edge_cases(spark):
    docs = awkward_docs(spark, extra=True)
    model = quality_classifier.fit_quality_classifier(docs, labels_of(spark, []))
    rows = quality_classifier.score_quality(docs, model).select("row.*", "score").collect()
    assert len(rows) == len(awkward_texts()) + 4 and {r[-1] for r in rows} == {0.5}
    assert quality_classifier.score_quality(empty_docs(spark), model).count() == 0
    fitted = quality_classifier.learn_ensemble(["a"], [[float(k)] for k in range(200)], [int(k > 100) for k in range(200)])
    assert fitted.rules and fitted.intercept is not None


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


@pytest.fixture(scope="module")
def secret_model(spark):
    return secrets.train_random_model(secrets.labelled_tokens(table(spark, SF, "documents")))


def test_secret_spans_equal_brute_force(spark, secret_model):
    many = spark.createDataFrame([(900, " ".join(f"token={k:014x}" for k in range(700)))], "doc_id long, text string")
    docs = awkward_docs(spark, extra=True).select("doc_id", "text").unionByName(many).unionByName(
        table(spark, SF, "documents").select("doc_id", "text")
    )
    for r in secrets.find_secrets(docs, secret_model).select("text", "base", "spans").collect():
        base = [tuple(s)[:3] for s in r.base]
        assert base == brute_secrets(r.text)
        added = [tuple(s)[:3] for s in r.spans if s.kind == 3]
        assert sorted(base + added) == [tuple(s)[:3] for s in r.spans]
        assert all(b[2] <= a[0] or a[2] <= b[0] for a in added for b in base)
        data = (r.text or "").encode()
        assert all(data[s.a : s.b].decode() == r.text[s.start : s.end] for s in r.spans)


def test_random_tokens_are_found_and_words_are_not(spark, secret_model):
    texts = [
        ("key Zk9Qx7Lm2Vb8Nw4Rt6Yp1Hs3 end", True),
        ("abc 7f3K9aQ2xZ8mB5vN1cL4 x", True),
        ("an internationalization notwithstanding", False),
        ("thanonontioniner scherstenverteheit", False),
    ]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: len(r.spans) for r in secrets.find_secrets(docs, secret_model).select("row.doc_id", "spans").collect()}
    assert found == {k: int(v) for k, (_, v) in enumerate(texts)}


def brute_added(text, base, model):
    """Tokens apart from every base span, judged one by one."""
    out = []
    for m in re.finditer("[A-Za-z0-9+/_=-]{16,}", text or ""):
        codes = [secrets.ALPHABET.index(c) for c in m[0]]
        ratio = model.start[codes[0]] + sum(model.pair[a * len(secrets.ALPHABET) + b] for a, b in zip(codes, codes[1:]))
        if ratio > secrets.MARGIN and all(e <= m.start() or m.end() <= b for b, _, e in base):
            out.append((m.start(), 3, m.end()))
    return out


def brute_redact(text, spans):
    out, at = "", 0
    for a, _, b in sorted(spans):
        if a >= at:
            out += text[at:a] + "<SECRET>"
        at = max(at, b)
    return out + text[at:]


def test_added_spans_and_redaction_equal_brute_force(spark, secret_model):
    rng = random.Random(12)
    alphabet = "abcXYZ019+/_=-"
    texts = []
    for _ in range(150):
        words = []
        for _ in range(rng.randint(0, 90)):
            kind = rng.randint(0, 5)
            token = "".join(rng.choice(secrets.ALPHABET) for _ in range(rng.randint(10, 30)))
            words.append(
                ["plain", token, f"token={token}", f"{token}{'0af1' * 5}{token}", "é🙂" + token, "".join(rng.choice(alphabet) for _ in range(20))][kind]
            )
        texts.append(rng.choice([" ", "", "\n"]).join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.find_secrets(docs, secret_model).select("text", "base", "spans", secrets.redact(F.col("text"), F.col("spans")).alias("red"))
    n = 0
    for r in found.collect():
        base = brute_secrets(r.text)
        added = brute_added(r.text, base, secret_model)
        n += len(added)
        assert [tuple(s)[:3] for s in r.spans] == sorted(base + added)
        assert r.red == brute_redact(r.text, base + added)
    assert n > 100


def test_many_secrets_in_one_text_take_time_in_proportion(spark, secret_model):
    import time

    def seconds(n):
        text = " ".join(f"token={k:016x}Q/{(k * 2654435761) % 2**32:08x}zzTq Zk9Qx7Lm2Vb8{k:06x}Nw4R" for k in range(n))
        found = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"), secret_model)
        found = found.select(F.size("spans").alias("n"), F.length(secrets.redact(F.col("text"), F.col("spans"))).alias("m"))
        found.collect()
        start = time.perf_counter()
        r = found.first()
        assert r.n >= 2 * n and r.m < len(text)
        return time.perf_counter() - start

    assert seconds(16_000) < 4 * seconds(4_000) + 0.5


def test_precision_and_recall_of_planted_tokens(spark, secret_model):
    """Keys of common shapes among ordinary identifiers, paths and words."""
    rng = random.Random(21)
    b64, upper, lower = string.ascii_letters + string.digits + "+/", string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits
    keys = ["".join(rng.choice(a) for _ in range(n)) for a, n in ((b64, 40), (b64, 24), (upper, 32), (lower, 32), (string.ascii_letters + string.digits, 36)) for _ in range(60)]
    parts = "get set user account number total index buffer value request handler stream config window table column parse render".split()
    names = ["_".join(rng.choice(parts) for _ in range(4)) for _ in range(100)]
    names += ["".join(rng.choice(parts).title() for _ in range(4)) for _ in range(100)]
    names += ["/".join(rng.choice(parts) for _ in range(4)) for _ in range(100)]
    tokens = [(t, True) for t in keys] + [(t, False) for t in names if len(t) >= 16]
    docs = spark.createDataFrame([(k, f"see {t} here") for k, (t, _) in enumerate(tokens)], "doc_id long, text string")
    hit = {r.doc_id for r in secrets.find_secrets(docs, secret_model).where(F.size("spans") > 0).select("row.doc_id").collect()}
    caught = sum(k in hit for k, (_, secret) in enumerate(tokens) if secret)
    false = sum(k in hit for k, (_, secret) in enumerate(tokens) if not secret)
    print(f"planted keys found {caught} of {len(keys)}, ordinary names reported {false} of {len(tokens) - len(keys)}")
    assert caught >= 0.9 * len(keys) and false <= 0.05 * (len(tokens) - len(keys))


def test_secret_query_digest_and_redaction(spark, secret_model):
    rows = queries.op3_secret_scans(spark, SF).collect()
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in rows:
        want = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in brute_secrets(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    docs = spark.createDataFrame([(1, "x token=abcdefghijkl y " + "f" * 16 + " z"), (2, "clean")], "doc_id long, text string")
    out = secrets.find_secrets(docs, secret_model).select("row.doc_id", secrets.redact(F.col("text"), F.col("spans")).alias("t"))
    assert {r.doc_id: r.t for r in out.collect()} == {1: "x <SECRET> y <SECRET> z", 2: "clean"}


def test_secrets_without_samples_or_rows(spark):
    model = secrets.train_random_model(secrets.labelled_tokens(empty_docs(spark)))
    assert set(model.pair) == {0.0}
    assert secrets.find_secrets(empty_docs(spark), model).count() == 0
    docs = spark.createDataFrame([(1, "Zk9Qx7Lm2Vb8Nw4Rt6Yp1Hs3")], "doc_id long, text string")
    assert secrets.find_secrets(docs, model).first().spans == []


def brute_copies(doc_id, rate, seed=mixing.SEED):
    import math

    u = int(hashlib.md5(f"{seed}:{doc_id if doc_id is not None else 'null'}".encode()).hexdigest()[:13], 16) / 2**52
    k, cdf = 0, math.exp(-rate)
    while cdf <= u and k < 1000:
        k += 1
        cdf += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
    return k


@pytest.mark.parametrize("broadcast", [True, False])
def test_mixing_equals_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    docs = awkward_docs(spark, extra=True)
    weights = {"s0": 3.0, "s1": 1.0, None: 2.0}
    got = collections.Counter(
        (r.doc_id, r.source, r.text) for r in mixing.mix_sources(docs, weights, total=400).select("row.*").collect()
    )
    rows = docs.select("doc_id", "source", "text").collect()
    sizes = collections.Counter(r.source for r in rows)
    want = collections.Counter()
    for r in rows:
        w = weights.get(r.source, 0.0)
        if w:
            want[(r.doc_id, r.source, r.text)] += brute_copies(r.doc_id, w / 6.0 * 400 / sizes[r.source])
    assert +got == +want


def test_mixing_edge_cases(spark):
    assert mixing.mix_sources(empty_docs(spark)).count() == 0
    docs = awkward_docs(spark)
    assert mixing.mix_sources(docs, {}).count() == 0
    one = mixing.mix_sources(docs).select("row.doc_id", "replica", "shuffle_key").collect()
    two = mixing.mix_sources(docs.repartition(7)).select("row.doc_id", "replica", "shuffle_key").collect()
    key = lambda r: (r.shuffle_key, r.doc_id or -1, r.replica)
    assert sorted(one, key=key) == sorted(two, key=key)


@pytest.mark.parametrize("rate", [1e4, 1e7])
def test_large_rates_invert_in_bounded_time(spark, rate):
    import math
    import time

    rates = spark.createDataFrame([("a", rate)], "source string, rate double")
    draws = [1e-9, 0.025, 0.5, 0.9, 0.999999]
    table = mixing.poisson_steps(rates)
    want = table.select(*[(F.col("low") + mixing.steps_below(F.col("steps"), F.lit(u))).alias(f"q{k}") for k, u in enumerate(draws)])
    want.collect()
    start = time.perf_counter()
    got = want.first()
    assert time.perf_counter() - start < 3  # a second in most runs
    for u, k in zip(draws, got):  # the distribution function around the answer, by lgamma
        lo = int(rate - 14 * math.sqrt(rate))
        below = math.fsum(math.exp(j * math.log(rate) - rate - math.lgamma(j + 1)) for j in range(lo, k))
        last = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        assert below <= u + 1e-6 and below + last > u - 1e-6
    assert table.select(F.size("steps")).first()[0] < 30 * math.sqrt(rate) + 100


def test_one_document_source_among_many(spark):
    rows = [(k, f"t{k}", "big") for k in range(2000)] + [(5000, "lone", "small"), (5001, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = collections.Counter(r.doc_id for r in mixing.mix_sources(docs).select("row.doc_id").collect())
    rate = 2002 / 3
    assert copies[5000] == brute_copies(5000, rate) and copies[5001] == brute_copies(5001, rate)


@pytest.mark.parametrize("at_once", [1, 7])
def test_copies_made_in_blocks_are_the_same(spark, monkeypatch, at_once):
    docs = awkward_docs(spark, extra=True)
    row = lambda r: (r.shuffle_key, r.doc_id or -1, r.replica)
    whole = mixing.mix_sources(docs, total=300).select("row.doc_id", "replica", "shuffle_key").collect()
    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", at_once)
    blocks = mixing.mix_sources(docs, total=300).select("row.doc_id", "replica", "shuffle_key").collect()
    assert sorted(whole, key=row) == sorted(blocks, key=row)


def test_sample_holds_one_row_of_an_id_that_fills_a_third(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    hot = spark.range(150).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("hot "), F.col("id") % 3).alias("text"))
    docs = docs.unionByName(hot)
    labels = docs.select("doc_id", F.lit(1).alias("quality")).unionByName(hot.select("doc_id", F.lit(0).alias("quality")))
    sample = labelled_sample(docs, labels, "quality", 200, training_fold=False).collect()
    assert len({r.doc_id for r in sample}) == len(sample) == 200
    again = labelled_sample(docs.repartition(5), labels, "quality", 200, training_fold=False).collect()
    assert sorted(sample) == sorted(again)
    some = hashed_sample(docs, 100).collect()
    assert len({r.doc_id for r in some}) == len(some) and 40 <= len(some) <= 200
    assert hashed_sample(docs, 1000).count() == 300 and hashed_sample(empty_docs(spark), 10).count() == 0


def test_native_plans_hold_no_python(spark):
    for query in ("op3_secret_scans", "op4_quality_rules", "op5_mixing", "op8_quality_classifier"):
        plan = queries.QUERIES[query](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), query


def test_mixing_query_equals_its_sql(spark):
    from oracle_check import compare, duckdb_connection

    ok, msg = compare(spark, duckdb_connection(SF), "op5_mixing", queries.op5_mixing, queries.ORACLES["op5_mixing"], SF)
    assert ok, msg


def test_features_are_finite_on_empty_texts(spark):
    rows = with_stats(awkward_docs(spark)).select(*[c.alias(n) for n, c in features().items()]).collect()
    assert all(v is not None and v == v for r in rows for v in r)
