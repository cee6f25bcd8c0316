"""The pipeline's stages against plain Python over the same models."""

import corpus_pipeline
from corpusflow.llm import packing, quality, secrets, toxicity
from corpusflow.llm.common import table
from helpers import nothing
from test_similar import kept_by_hand

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    rows = {r.doc_id: r for r in docs.collect()}

    got = corpus_pipeline.quality_rules(spark, docs, SF)
    model = quality.train(docs, labels)
    kept = []
    for i, r in rows.items():
        counts = quality.rule_counts(r.text or "")
        if not quality.base_failed(counts[0], counts[4]) and model.score([r.text or ""])[0] >= quality.KEEP_FROM:
            kept.append(i)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(kept)

    got = corpus_pipeline.toxicity_grammar(spark, docs, SF)
    reader = toxicity.Reader(toxicity.train(docs, labels))
    clean = [i for i, r in rows.items() if reader.score([r.text or ""])[0] < toxicity.TOXIC_FROM]
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == sorted(clean)

    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    first = kept_by_hand({i: r.text for i, r in rows.items()})
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == first

    got = {r.doc_id: r.text for r in corpus_pipeline.secret_scan(spark, docs, SF).collect()}
    model = secrets.default_model()
    assert {i for i, t in got.items() if t != rows[i].text} == {i for i, r in rows.items() if secrets.spans_of(r.text, model)[1]}


def test_run_takes_decisions_in_order(spark):
    pieces = corpus_pipeline.run(spark, SF)
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert packing.WINDOW == 2048 and pieces.selectExpr("max(`offset` + length)").first()[0] <= 2048


def test_stages_take_an_empty_table(spark):
    docs = nothing(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_stages_give_back_what_training_took(monkeypatch):
    """Also where stages are run one by one: before rows are judged, not after all stages."""
    import corpus_pipeline as p

    done = []
    monkeypatch.setattr(p, "table", lambda *a: None)
    monkeypatch.setattr(p, "give_back", lambda: done.append("back"))
    for module, judge in ((p.quality, "keep_good"), (p.toxicity, "drop_toxic")):
        monkeypatch.setattr(module, "train", lambda *a: done.append("train"))
        monkeypatch.setattr(module, judge, lambda *a: done.append("judge"))
    p.quality_rules(None, None, "")
    p.toxicity_grammar(None, None, "")
    assert done == ["train", "back", "judge"] * 2
