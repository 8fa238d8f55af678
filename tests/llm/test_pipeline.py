"""The pipeline's stages against brute force, on the table and on awkward rows."""

import collections

import pytest

import corpus_pipeline
from fixtures import awkward_docs, empty_docs
from test_batched import brute_components, brute_fingerprint
from test_native import brute_copies, brute_secrets
from tripscope.llm import decontamination, quality_classifier
from tripscope.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "mixing_sources",
    ]


def test_pipeline_equals_brute_force_stage_by_stage(spark):
    docs = table(spark, SF, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], SF), f"test-{name}"))
    for f in frames[:-1]:
        assert f.columns == docs.columns
    rows = [f.collect() for f in frames]
    model = quality_classifier.fit_quality_classifier(docs, table(spark, SF, "labels"))
    scores = {r.doc_id: r.score for r in quality_classifier.score_quality(docs, model).select("row.doc_id", "score").collect()}
    assert {r.doc_id for r in rows[1]} == {d for d, s in scores.items() if s >= 0.5}
    prints = {r.doc_id: brute_fingerprint(r.text) for r in rows[1]}
    groups = brute_components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert {r.doc_id for r in rows[2]} == set(groups.values())
    items = [" " + " ".join(decontamination.words(r.text)) + " " for r in table(spark, SF, "benchmark").collect()]
    dirty = {r.doc_id for r in rows[2] if any(i in " " + " ".join(decontamination.words(r.text)) + " " for i in items)}
    kept = {r.doc_id for r in rows[3]}
    assert kept <= {r.doc_id for r in rows[2]} - dirty
    assert len(rows[2]) - len(dirty) - len(kept) <= 2  # reordered or partial passages
    before = {r.doc_id: r.text for r in rows[3]}
    assert {r.doc_id for r in rows[4]} == kept
    for r in rows[4]:
        assert brute_secrets(r.text) == [] and r.n_chars == len(r.text)
        if not brute_secrets(before[r.doc_id]):
            assert r.text == before[r.doc_id]
    sizes = collections.Counter(r.source for r in rows[4])
    want = collections.Counter()
    for r in rows[4]:
        want[(r.doc_id, r.text)] += brute_copies(r.doc_id, len(rows[4]) / (len(sizes) * sizes[r.source]))
    assert collections.Counter((r.doc_id, r.text) for r in rows[5]) == +want
    whole = corpus_pipeline.run(spark, SF)
    assert collections.Counter(map(tuple, whole.collect())) == collections.Counter(map(tuple, rows[5]))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_awkward_and_empty_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = awkward_docs(spark, extra=True)
    out = stage(spark, docs, SF)
    assert out.columns[: len(docs.columns)] == docs.columns
    assert len(out.columns) - len(docs.columns) == (name == "mixing_sources")
    assert out.count() <= 2 * docs.count()
    assert out.select("row").distinct().collect() == [("c0",)]  # a column of the input, not the operator's
    assert stage(spark, empty_docs(spark), SF).count() == 0


def test_one_copy_of_the_corpus_is_kept(spark):
    from tripscope.llm import common

    common.clear_stored(spark)
    corpus_pipeline.run(spark, SF).count()
    left = [p for p in common._FOLDERS[spark.sparkContext.applicationId] if "/pipeline-" in p]
    assert len(left) == 1 and "pipeline-secret_scans" in left[0]
    assert common.clear_stored(spark) >= 1 and common.clear_stored(spark) == 0
    assert not __import__("os").path.exists(left[0].removeprefix("file:"))
