"""The pipeline, stage by stage, against brute force on the given table."""

import re

import corpus_pipeline
from reelstats.llm import near, pii, quality
from reelstats.llm.packing import PIECES
from tests.conftest import SF001
from tests.llm.test_near_substring import brute_near
from tests.llm.test_tokens import check_pieces


def test_stages_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]

    good = steps["quality"](spark, docs, SF001)
    kept = {r.doc_id for r in quality.score_documents(docs, labels).where("kept").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept

    exact = steps["exact_dedup"](spark, good, SF001)
    first = {}
    for i in sorted(kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i]), i)
    assert exact.columns == docs.columns and sorted(r.doc_id for r in exact.collect()) == sorted(first.values())

    unique = steps["near_dedup"](spark, exact, SF001)
    groups = brute_near([(i, rows[i]) for i in first.values()])
    assert unique.columns == docs.columns
    assert sorted(r.doc_id for r in unique.collect()) == sorted({c for (_, c, _, _, _) in groups})

    clean = steps["pii"](spark, unique, SF001)
    assert clean.dtypes == docs.dtypes
    spans = {r.doc_id: r.spans for r in pii.label_documents(unique).collect()}
    texts = {r.doc_id: r for r in clean.collect()}
    for i, text in texts.items():
        assert text.n_chars == len(text.text)
        assert (text.text == rows[i]) == (spans[i] == "")

    packed = steps["packing"](spark, clean, SF001)
    check_pieces(packed.collect(), {i: [r.text] for i, r in texts.items()}, 2048)


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert out.columns == [c.split()[0] for c in PIECES.split(", ")]
    assert 0 < out.select("doc_id").distinct().count() <= 200
    assert near.GRAM == 5 and near.THRESHOLD == 0.8
