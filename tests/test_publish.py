import json

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import cost, dimensions, publish
from corpusflow.plans import prompts
from corpusflow.plans.summary import outcome_counts, run_summary
from corpusflow.plans.transforms import TRANSFORMS, Passthrough, Synth, build_transform, register_transform
from corpusflow.schemas import DIMENSION, OUTCOME, POST


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_categories_match_name_then_slug(spark):
    dim = spark.createDataFrame(
        [(1, "World", "world"), (2, "Science & Tech", "sci-tech"), (3, "tech", "t"), (4, "Other", "tech")],
        DIMENSION,
    )
    wanted = ["world", "Sci & Tech", "Tech", "!!!", "???", "New One", "new one"]
    found = dimensions.ensure_categories(dim, names(spark, wanted))
    ids = {r.name: r.id for r in found.mapping.collect()}
    assert (ids["world"], ids["Sci & Tech"], ids["Tech"]) == (1, 2, 3)
    assert ids["!!!"] == ids["???"] and ids["New One"] == ids["new one"]
    created = {(r.id, r.slug) for r in found.created.collect()}
    assert {s for _, s in created} == {"category", "new-one"} and {i for i, _ in created} == {5, 6}
    assert (ids["!!!"], "category") in created


def test_authors_match_slug_then_name(spark):
    dim = spark.createDataFrame([(3, "bo", "x"), (4, "Other", "bo")], DIMENSION)
    found = dimensions.ensure_authors(dim, names(spark, ["Bo", "Ana Maria Paz", "??"]), "ex.org", "editor")
    ids = {r.name: r.id for r in found.mapping.collect()}
    assert ids["Bo"] == 4 and {ids["Ana Maria Paz"], ids["??"]} == {5, 6}
    rows = {r.slug: r for r in found.created.collect()}
    ana = rows["ana-maria-paz"]
    assert (ana.email, ana.first_name, ana.last_name) == ("ana-maria-paz@ex.org", "Ana", "Maria Paz")
    assert ana.roles == ["editor"] and rows["author"].last_name == ""


def test_first_dimension_rows_start_at_one(spark):
    empty = spark.createDataFrame([], DIMENSION)
    found = dimensions.ensure_categories(empty, names(spark, ["A", "B"]))
    assert {r.id for r in found.mapping.collect()} == {1, 2}
    ids = dimensions.dry_run_categories(spark, ["x", "y"])
    assert [tuple(r) for r in ids.collect()] == [("x", 1000), ("y", 1001)]


def make_posts(spark, rows):
    full = [(t, "c", cat, "Bo", "2020-01-01T00:00:00", sid, h) for sid, t, cat, h in rows]
    return spark.createDataFrame(full, POST)


def test_outcomes_and_created(spark, monkeypatch):
    monkeypatch.setattr(publish, "COPY_CHUNK", 7)
    rows = [("a", "1", "N", "h1"), ("a", "2", "N", "h0"), ("b", "1", "N", "h2"), ("x", "1", "Nope", "h3")]
    rows += [("old", "1", "N", "h4"), ("old", "2", "Nope", "h5")] + [("hot", str(i), "N", "") for i in range(50)]
    cats = spark.createDataFrame([("N", 11)], "name string, id long")
    existing = spark.createDataFrame([("old", 5)], "source_id string, post_id long")
    resolved = publish.with_author(publish.with_category(make_posts(spark, rows), cats), None)
    assigned = publish.assign_ids(resolved, existing, 100)
    outcomes = publish.publish_outcomes(resolved, assigned).cache()
    assert outcomes.schema.fieldNames() == OUTCOME.fieldNames()
    assert outcomes.count() == len(rows)
    ids = {r.source_id: r.post_id for r in assigned.collect()}
    assert ids["old"] == 5 and sorted(v for k, v in ids.items() if k != "old") == [101, 102, 103]
    got = outcomes.groupBy("source_id", "ok", "skipped").count().collect()
    assert {tuple(r) for r in got} == {
        ("a", True, None, 1), ("a", True, True, 1), ("b", True, None, 1), ("x", False, None, 1),
        ("old", True, True, 1), ("old", False, None, 1), ("hot", True, None, 1), ("hot", True, True, 49),
    }
    created = {r.source_id: r for r in publish.created_posts(resolved, assigned).collect()}
    assert set(created) == {"a", "b", "hot"} and created["a"].title == "2"
    counts = outcome_counts(outcomes).first()
    assert (counts.posts_uploaded, counts.posts_created, counts.posts_failed, counts.exit_code) == (54, 3, 2, 1)


def test_recovery(spark):
    rows = [
        ("lost", False, None, None, None, None, "timeout", 503),
        ("gone", False, None, None, None, None, "HTTP 400", 400),
        ("fine", True, 3, None, None, None, None, None),
    ]
    outcomes = spark.createDataFrame(rows, OUTCOME)
    target = spark.createDataFrame([("lost", 8), ("fine", 3)], "source_id string, post_id long")
    got = publish.recover(outcomes, target).cache()
    assert {tuple(r) for r in got.collect()} == {
        ("lost", True, 8, True, True, None, None, None),
        ("gone", False, None, None, None, None, "HTTP 400", 400),
        ("fine", True, 3, None, None, None, None, None),
    }
    posts = make_posts(spark, [("lost", "t", "N", "hl"), ("fine", "t", "N", "hf")])
    assert [tuple(r) for r in publish.recovered_entries(got, posts).collect()] == [("lost", 8, "hl")]


def test_payload_leaves_out_a_missing_author(spark):
    df = make_posts(spark, [("a", 'A "b" <c>', "N", "h")]).withColumn("category_id", F.lit(7))
    some = json.loads(df.withColumn("author_id", F.lit(3)).select(publish.payload(byline=True)).first()[0])
    assert some["title"] == "A &quot;b&quot; &lt;c&gt;" and some["categories"] == [7] and some["author"] == 3
    assert some["content"].startswith("<!-- wp:paragraph -->\n<p><em>By Bo</em></p>")
    assert some["meta"] == {"source_id": "a", "byline": "Bo", "content_hash": "h"}
    none = json.loads(df.withColumn("author_id", F.lit(None)).select(publish.payload("draft")).first()[0])
    assert "author" not in none and none["status"] == "draft"


@pytest.mark.parametrize(
    "model, usd, priced",
    [
        ("gpt-4o-mini", 0.030025, True),
        ("gpt-4o-mini-2024-07-18", 0.030025, True),
        ("GPT-4o", 0.500423, True),
        ("gpt-4", 0.0, False),
        ("local", 0.0, False),
    ],
)
def test_chat_cost(spark, model, usd, priced):
    usage = spark.createDataFrame([(model, 181613, 4639)], "model string, input_tokens long, output_tokens long")
    row = cost.chat_cost(usage, cost.pricing_table(spark)).first()
    assert row.est_usd == pytest.approx(usd, abs=1e-6) and row.priced is priced


def test_pricing_sources(spark, tmp_path):
    assert cost.load_pricing(spark, str(tmp_path / "none.json")).isEmpty()
    (tmp_path / "p.json").write_text('{"M": {"input": 1, "output": null}}')
    assert [tuple(r) for r in cost.load_pricing(spark, str(tmp_path / "p.json")).collect()] == [("M", 1.0, 0.0)]


def test_embedding_tokens_are_floored_after_the_sum(spark):
    posts = spark.createDataFrame([("abc",), ("abcdef",)], "content string")
    assert cost.embedding_cost(posts, 0.02).first().est_tokens == 2
    assert cost.embedding_cost(posts.limit(0), 0.02).first().est_tokens == 0


def test_summary_without_funnel(spark):
    posts = make_posts(spark, [("a", "t", "N", "")])
    failed = spark.createDataFrame([("x", False, None, None, None, None, "e", None)], OUTCOME)
    row = run_summary(publish.dry_run_outcomes(posts).unionByName(failed), posts, 3.0).first()
    assert (row.rows_fetched, row.posts_uploaded, row.posts_failed, row.pace_sec_per_post) == (2, 0, 1, 3.0)
    assert row.rows_funnel is None and row.chat_cost is None
    none = run_summary(failed.limit(0), posts.limit(0), 1.0).first()
    assert none.pace_sec_per_post is None and none.exit_code == 0


def test_prompts_and_signatures():
    text = prompts.system_prompt(None, ["A {x}", "B"], "2007-04-01", "2015-04-30")
    assert "A {x}, B" in text and "2007-04" in text and '{"title"' in text
    assert prompts.system_prompt("{labels}|{win_end}", ["A"], "2007-04-01", "2015-04-30") == "A|2015-04"
    assert prompts.response_schema(["A"])["properties"]["category"]["enum"] == ["A"]
    one = Passthrough(identity=prompts.source_identity({"type": "jsonl", "path": "a"}))
    two = Passthrough(identity=prompts.source_identity({"type": "jsonl", "path": "b"}))
    assert one.signature() != two.signature() and len(one.signature()) == 16

    from corpusflow.plans.transforms import Completing

    calls = Completing(lambda schema: None, model="m")
    ab = Synth(calls, ["A", "B"], "2007-04-01", "2015-04-30").signature()
    assert ab == Synth(calls, ["A", "B"], "2007-04-01", "2015-04-30").signature()
    assert ab != Synth(calls, ["B", "A"], "2007-04-01", "2015-04-30").signature()
    with pytest.raises(ValueError):
        Synth(calls, [], "2007-04-01", "2015-04-30")


def test_transform_registry():
    with pytest.raises(ValueError, match="unknown transform type 'x'; known: passthrough, synth"):
        build_transform({"transform": {"type": "x"}})
    with pytest.raises(ValueError, match="needs a completion client"):
        build_transform({"transform": {"type": "synth"}})
    register_transform("mine", lambda transform, cfg, completing: transform["x"])
    try:
        assert build_transform({"transform": {"type": "mine", "x": 5}}) == 5
    finally:
        TRANSFORMS.pop("mine")
