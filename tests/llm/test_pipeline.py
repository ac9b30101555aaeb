"""The pipeline's stages on awkward rows and on the smallest tables, against brute force."""

import corpus_pipeline as pipeline
import pytest

from loamgrid.llm import decontam, toxicity

from .test_lines_and_rules import brute_lines
from .test_near_copies import brute
from .test_tokens_and_packing import check_packing

SF = "/root/testdata/sf0.001"
STAGES = dict(pipeline.STAGES)


def test_stages_are_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line dedup", "MinHash near-dedup", "benchmark decontamination", "best-fit packing"]
    assert pipeline.ORACLE_SQL is None and list(pipeline.queries()) == ["pipeline"]


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_columns_and_nothing(spark, awkward, nothing, name):
    out = STAGES[name](spark, awkward, SF)
    assert out.columns == awkward.columns and 0 < out.count() <= awkward.count()
    assert STAGES[name](spark, nothing, SF).count() == 0


def test_all_rows_through_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = STAGES["toxicity"](spark, docs, SF).cache()
    model = toxicity.fit(docs, labels)
    limits = {r.doc_id: model.thresholds.get(r.lang, model.threshold) for r in docs.collect()}
    scores = model.scores([toxicity.word_features(r.text) for r in docs.collect()])
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r, s in zip(docs.collect(), scores, strict=True) if s < limits[r.doc_id]}

    lines = STAGES["line dedup"](spark, clean, SF).cache()
    import hashlib

    want = {d: h for d, _, _, h in brute_lines([(r.doc_id, r.text) for r in clean.collect()], 40, 5)}
    rows = lines.collect()
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)

    apart = STAGES["MinHash near-dedup"](spark, lines, SF).cache()
    keep = {d for d, _, c in brute([(r.doc_id, r.text) for r in rows], 5) if d == c}
    assert {r.doc_id for r in apart.collect()} == keep

    safe = STAGES["benchmark decontamination"](spark, apart, SF).cache()
    items = [decontam.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def holds(text):
        words = decontam.words_of(text)
        joined = f" {' '.join(words)} "
        return any(f" {' '.join(i)} " in joined for i in items if len(i) >= decontam.GRAM)

    whole = {r.doc_id for r in apart.collect() if not holds(r.text)}
    left = {r.doc_id for r in safe.collect()}
    assert left <= whole and len(left) >= 0.98 * len(whole)  # edited copies go, too

    packed = STAGES["best-fit packing"](spark, safe, SF).collect()
    assert {r.doc_id for r in packed} == left
    assert check_packing(packed, 2048) <= -(-sum(r.length for r in packed) // 2048) + 1


def test_run_survives_clashing_names(spark, awkward):
    extra = awkward.toDF(*[{"TEXT_": "gone_id", "sig": "_keep_runs"}.get(c, c) for c in awkward.columns])
    docs = extra
    for name in list(STAGES)[:-1]:
        docs = STAGES[name](spark, docs, SF)
        assert docs.columns == extra.columns
    assert STAGES["best-fit packing"](spark, docs, SF).count() > 0
