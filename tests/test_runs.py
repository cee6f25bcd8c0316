import json

import pytest

from corpusflow.operators.cache import CACHE_TABLE
from corpusflow.operators.completion import CallPolicy, Completion, TransientError
from corpusflow.operators.store import VersionedTable
from corpusflow.plans.config import ConfigError, validate_config
from corpusflow.plans.runs import PUBLISHED, catch_up, purge, run
from corpusflow.plans.transforms import Completing, labels_of
from corpusflow.schemas import LEDGER

LABELS = ["News", "Opinion", "Other"]


def config(tmp_path, **load):
    return {
        "dataset": {"sample_size": 1000, "seed": 7},
        "source": {
            "type": "jsonl",
            "path": str(tmp_path / "corpus.jsonl"),
            "field_map": {"id": "id", "title": "title", "body": "content", "category": "category"},
        },
        "transform": {
            "type": "passthrough",
            "category_field": "category",
            "author": {"pool": ["Ana Maria Paz", "Bo"]},
            "date": {"range_start": "2020-01-01", "range_end": "2020-12-31"},
            "category": {"labels": LABELS},
        },
        "load": {"dry_run": False, "target": str(tmp_path / "site"), **load},
    }


def write_corpus(tmp_path, rows):
    lines = [json.dumps(r) for r in rows]
    (tmp_path / "corpus.jsonl").write_text("\n".join(lines) + "\n")


ROWS = (
    [{"id": f"r{i}", "title": f"T {i}", "content": f"body {i}\n\nmore", "category": "News"} for i in range(20)]
    + [{"id": f"c{i}", "title": "copy", "content": "body 3\n\nmore"} for i in range(5)]
    + [{"id": "blank", "content": "", "title": " "}, {"id": "blank", "content": " "}]
    + [{"id": "bad", "content": "x", "category": "Nope"}]
    + [{"id": "r1", "content": "another body"}]
)


def test_run_resume_and_repeat(spark, tmp_path):
    write_corpus(tmp_path, ROWS)
    cfg = config(tmp_path)
    first = run(spark, cfg, str(tmp_path / "out1"), run_id="one")
    s = first.summary.first()
    assert s.rows_fetched == len(ROWS)
    assert s.rows_funnel.after_content_dedup == len(ROWS) - 5
    assert (s.content_dedup.cross_run, s.content_dedup.within_run, s.content_dedup.empty_hash) == (0, 5, 2)
    assert (s.posts_prepared, s.posts_uploaded, s.posts_created) == (24, 23, 21)
    assert (s.posts_skipped_existing, s.posts_failed, s.exit_code) == (2, 1, 1)
    assert first.exit_code == 1
    outcomes = {(r.source_id, r.ok, r.skipped, r.error) for r in first.outcomes.collect()}
    assert ("bad", False, None, "category not in mapping: 'Nope'") in outcomes
    assert ("blank", True, True, None) in outcomes and ("blank", True, None, None) in outcomes

    target = VersionedTable(spark, str(tmp_path / "site/posts"), PUBLISHED)
    posts = {r.source_id: r for r in target.read().collect()}
    assert len(posts) == 21
    assert sorted(r.post_id for r in posts.values()) == list(range(1, 22))
    p = posts["r0"]
    assert p.content == (
        "<!-- wp:paragraph -->\n<p>body 0</p>\n<!-- /wp:paragraph -->\n\n"
        "<!-- wp:paragraph -->\n<p>more</p>\n<!-- /wp:paragraph -->"
    )
    assert posts["blank"].title == "Untitled"
    raw = spark.read.parquet(str(tmp_path / "site/authors/data/v=0")).collect()
    assert {(r.username, r.first_name, r.last_name) for r in raw} == {
        ("ana-maria-paz", "Ana", "Maria Paz"), ("bo", "Bo", ""),
    }

    # the same run again replaces its output
    again = run(spark, cfg, str(tmp_path / "out1"), run_id="one").summary.first()
    assert (again.posts_created, again.posts_failed) == (21, 1)
    same = {r.source_id: r.post_id for r in target.read().collect()}
    assert same == {k: r.post_id for k, r in posts.items()}

    # a new run resumes: only new ids and new content are left
    write_corpus(tmp_path, ROWS + [{"id": "n1", "content": "body 4\n\nmore"}, {"id": "n2", "content": "new", "title": "A <b>"}])
    second = run(spark, cfg, str(tmp_path / "out2"), run_id="two").summary.first()
    assert second.rows_fetched == len(ROWS) + 2
    assert second.content_dedup.cross_run == 5 + 1
    assert second.posts_created == 1
    new = target.read(only="two").collect()
    assert [(r.source_id, r.post_id, r.title) for r in new] == [("n2", 22, "A &lt;b&gt;")]

    ledger = VersionedTable(spark, str(tmp_path / "site/ledger"), LEDGER)
    assert {r.source_id: r.post_id for r in ledger.read().collect()} == {**same, "n2": 22}

    # verify drops a ledger entry the target does not have, and reports the drift
    ledger.append(spark.createDataFrame([("ghost", 99, None, 1)], LEDGER), "ghost")
    third = run(spark, config(tmp_path, mode="verify"), str(tmp_path / "out3"), run_id="three")
    assert third.drift.first().asDict() == {"only_in_log": 1, "only_on_target": 0, "differing": 0}
    ledger = VersionedTable(spark, str(tmp_path / "site/ledger"), LEDGER)
    assert ledger.read().filter("source_id = 'ghost'").isEmpty()
    assert third.summary.first().posts_created == 0

    # a run that died between target and ledger is caught up with
    extra = spark.createDataFrame(
        [(50, "lost", "t", "c", "publish", "", 1, None, "", "hash", 2**62)], PUBLISHED
    )
    target.append(extra, "crashed")
    catch_up(ledger, target, "four")
    assert not ledger.read().filter("source_id = 'lost'").isEmpty()

    assert purge(target, ledger) == (23, 0)
    assert target.read().isEmpty() and ledger.read().isEmpty()


def test_empty_ledger_is_filled_from_target(spark, tmp_path):
    write_corpus(tmp_path, ROWS)
    run(spark, config(tmp_path), str(tmp_path / "o1"), run_id="one")
    moved = config(tmp_path, ledger=str(tmp_path / "other-ledger"))
    result = run(spark, moved, str(tmp_path / "o2"), run_id="two")
    assert result.summary.first().posts_created == 0
    assert result.drift.first().asDict() == {"only_in_log": 0, "only_on_target": 21, "differing": 0}
    ledger = VersionedTable(spark, str(tmp_path / "other-ledger"), LEDGER)
    assert ledger.read().count() == 21


def test_skip_mode_takes_nothing_as_published(spark, tmp_path):
    write_corpus(tmp_path, ROWS[:3])
    run(spark, config(tmp_path), str(tmp_path / "o1"), run_id="one")
    s = run(spark, config(tmp_path, mode="skip"), str(tmp_path / "o2"), run_id="two").summary.first()
    assert s.posts_created == 3


def test_dry_run_touches_nothing(spark, tmp_path):
    write_corpus(tmp_path, ROWS)
    cfg = config(tmp_path, dry_run=True)
    result = run(spark, cfg, str(tmp_path / "out"), run_id="dry")
    s = result.summary.first()
    assert (s.posts_prepared, s.posts_uploaded, s.posts_failed, s.exit_code) == (len(ROWS), 0, 0, 0)
    assert {r.content_hash for r in result.posts.collect()} == {""}
    assert all(r.dry_run and r.ok for r in result.outcomes.collect())
    assert not (tmp_path / "site").exists()


class Stub:
    """Answers from the text; counts calls in a folder shared by tasks."""

    def __init__(self, calls):
        self.calls, self.seen = calls, {}

    def __call__(self, schema):
        assert schema is None or schema["required"] == ["title", "category", "date"]
        return self.answer

    def answer(self, system, user, max_tokens):
        assert "News, Opinion, Other" in system and max_tokens == 77
        import uuid

        (self.calls / uuid.uuid4().hex).touch()
        body = user[len("Article:\n\n"):-len("\n\nJSON:")]
        if "body 7" in body:
            raise ValueError("boom")
        if "body 8" in body and not self.seen.get(body):
            self.seen[body] = True
            raise TransientError("slow down", retry_after=0.0)
        if "body 9" in body:
            raise TransientError("never", retry_after=0.0)
        if "body 10" in body:
            return Completion(None, 3, 0)
        return Completion(json.dumps({"title": body[:20], "category": "the opinion pages", "date": "2020-02"}), 10, 2)


def test_parquet_source_is_read_in_place(spark, tmp_path):
    write_corpus(tmp_path, ROWS)
    cfg = config(tmp_path)
    spark.read.json(str(tmp_path / "corpus.jsonl")).write.parquet(str(tmp_path / "corpus.parquet"))
    cfg["source"].update(type="table", path=str(tmp_path / "corpus.parquet"))
    s = run(spark, cfg, str(tmp_path / "out"), run_id="one").summary.first()
    assert (s.posts_created, s.posts_skipped_existing, s.posts_failed) == (21, 2, 1)
    assert s.content_dedup.within_run == 5
    assert not (tmp_path / "out/rows").exists() and (tmp_path / "out/keys").exists()


def test_synth_run_caches_and_isolates_failures(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    write_corpus(tmp_path, ROWS[:20])
    cfg = config(tmp_path)
    cfg["transform"].update(
        type="synth",
        max_tokens_combined=77,
        cleaners=[{"type": "regex_replace", "pattern": "more", "replacement": "less"}],
        cache={"path": str(tmp_path / "cache")},
    )
    cfg["costs"] = {"embedding": {"usd_per_1m_tokens": 0.02, "model": "e"}}
    stub = Completing(Stub(calls), model="gpt-4o-mini-2024-07-18", structured=True, policy=CallPolicy(max_retries=2))
    result = run(spark, cfg, str(tmp_path / "o1"), stub, run_id="one")
    s = result.summary.first()
    assert (s.posts_prepared, s.posts_created, s.posts_failed) == (18, 18, 2)
    assert s.completion_calls == 20
    assert (s.cache.hits, s.cache.misses, s.cache.loaded_at_start) == (0, 20, 0)
    assert (s.chat_cost.input_tokens, s.chat_cost.output_tokens, s.chat_cost.priced) == (173, 34, True)
    assert s.chat_cost.est_usd == pytest.approx((173 * 0.15 + 34 * 0.6) / 1e6, abs=1e-6)
    errors = {r.source_id: r.error for r in result.outcomes.filter("not ok").collect()}
    assert errors == {"r7": "transform: boom", "r9": "transform: never"}
    posts = {r.source_id: r for r in result.posts.collect()}
    assert posts["r0"].title == "body 0" and posts["r0"].category == "Opinion"
    assert posts["r0"].content == "body 0\n\nless" and posts["r0"].date_gmt.startswith("2020-02-")
    assert posts["r10"].title == "Untitled" and posts["r10"].category == "News"
    n = len(list(calls.iterdir()))
    assert n == 20 + 1 + 2

    # another target: only the failures are called again
    cfg2 = dict(cfg, load=dict(cfg["load"], target=str(tmp_path / "site2")))
    s = run(spark, cfg2, str(tmp_path / "o2"), stub, run_id="two").summary.first()
    assert len(list(calls.iterdir())) == n + 1 + 3
    assert (s.posts_prepared, s.cache.hits, s.cache.misses) == (18, 18, 2)
    assert s.cache.loaded_at_start == 18 and s.completion_calls == 2

    # another signature makes every entry stale
    cfg3 = json.loads(json.dumps(cfg2))
    cfg3["transform"]["title"] = {"max_length": 10}
    cfg3["load"]["dry_run"] = True
    s = run(spark, cfg3, str(tmp_path / "o3"), stub, run_id="three").summary.first()
    assert s.cache.stale_at_start >= 18 and s.cache.hits == 0


def test_config_problems_come_together():
    with pytest.raises(ConfigError) as e:
        validate_config(
            {
                "dataset": {"sample_size": True},
                "source": {"type": "jsonl", "field_map": ["x"]},
                "transform": {
                    "type": "synth",
                    "category": {"labels": ["a", ""]},
                    "date": {"range_start": "2021-01-01", "range_end": "2020-01-01"},
                    "cleaners": [{"type": "nope"}, {}],
                },
                "load": {"dry_run": False, "mode": "guess"},
            }
        )
    assert len(e.value.problems) == 10, e.value.problems
    ok = {
        "dataset": {"sample_size": 5},
        "source": {"type": "table", "name": "t"},
        "transform": {"type": "passthrough"},
    }
    validate_config(ok)
    bad = dict(ok, source={"type": "x"}, transform={})
    with pytest.raises(ConfigError, match="one of jsonl, table(.|\n)*transform.type = None"):
        validate_config(bad)


def test_finished_run_repeated_calls_failures_only(spark, tmp_path):
    """Tasks commit as they are done; a repeat uses all of them, also its own."""
    calls = tmp_path / "calls"
    calls.mkdir()
    write_corpus(tmp_path, ROWS[:20])
    cfg = config(tmp_path)
    cleaners = [{"type": "regex_replace", "pattern": "more", "replacement": "less"}]
    cfg["transform"].update(type="synth", max_tokens_combined=77, cleaners=cleaners, cache={"path": str(tmp_path / "cache")})
    stub = Completing(Stub(calls), model="m", structured=True, policy=CallPolicy(max_retries=2), slice_rows=4)
    first = run(spark, cfg, str(tmp_path / "o1"), stub, run_id="one").summary.first()
    n = len(list(calls.iterdir()))
    cache = VersionedTable(spark, str(tmp_path / "cache"), CACHE_TABLE)
    assert first.completion_calls == 20 and first.cache.size == 18
    assert cache.batches().count() == 1  # one job, and a file per task
    assert 5 <= len(list((tmp_path / "cache").glob("data/v=0/batch=*/*.parquet"))) <= 8
    again = run(spark, cfg, str(tmp_path / "o1"), stub, run_id="one").summary.first()
    assert len(list(calls.iterdir())) == n + 1 + 3  # the one that fails, and the one retried
    assert (again.completion_calls, again.posts_created, again.cache.hits) == (2, 18, 18)


def test_ids_stay_when_a_run_is_repeated(spark, tmp_path):
    """Run one, a run with one more label, then run one again with another label."""
    write_corpus(tmp_path, ROWS)
    cfg = config(tmp_path)
    run(spark, cfg, str(tmp_path / "o1"), run_id="one")

    def tables():
        kept = {}
        for name, key in (("categories", "name"), ("authors", "name"), ("posts", "source_id")):
            path = str(tmp_path / f"site/{name}/data/v=0")
            for r in spark.read.parquet(path).collect():
                kept[name, r[key]] = r["id"] if "id" in r else r["post_id"]
        return kept

    one = tables()
    write_corpus(tmp_path, ROWS + [{"id": "z9", "content": "something new", "title": "T"}])
    more = config(tmp_path)
    more["transform"]["category"] = {"labels": [*labels_of(cfg["transform"]), "Fourth"]}
    run(spark, more, str(tmp_path / "o2"), run_id="two")
    two = tables()
    assert {k: two[k] for k in one} == one and len(two) == len(one) + 2
    more["transform"]["category"] = {"labels": [*labels_of(cfg["transform"]), "Fifth"]}
    run(spark, more, str(tmp_path / "o3"), run_id="one")
    three = tables()
    assert {k: three[k] for k in two} == two


def test_summary_counts_in_every_mode(spark, tmp_path):
    write_corpus(tmp_path, ROWS)
    cfg = config(tmp_path)
    cfg["dataset"]["sample_size"] = "all"
    cfg["dataset"]["dedup_content"] = False
    run(spark, cfg, str(tmp_path / "o1"), run_id="one")
    write_corpus(tmp_path, ROWS + [{"id": "z9", "content": "something new", "title": "T"}])
    s = run(spark, cfg, str(tmp_path / "o2"), run_id="two").summary.first()
    assert s.rows_fetched == len(ROWS) + 1 == s.rows_funnel.fetched
    assert s.rows_funnel.after_source_id_resume == s.rows_funnel.after_content_dedup < len(ROWS)
    cfg["load"]["dry_run"] = True
    s = run(spark, cfg, str(tmp_path / "o3"), run_id="dry").summary.first()
    assert s.rows_funnel.fetched == s.rows_funnel.after_content_dedup == len(ROWS) + 1


def test_catch_up_with_a_clock_that_runs_backwards(spark, tmp_path):
    write_corpus(tmp_path, ROWS)
    run(spark, config(tmp_path), str(tmp_path / "o1"), run_id="one")
    target = VersionedTable(spark, str(tmp_path / "site/posts"), PUBLISHED)
    ledger = VersionedTable(spark, str(tmp_path / "site/ledger"), LEDGER)
    late = spark.createDataFrame([(50, "lost", "t", "c", "publish", "", 1, None, "", "hash", 3)], PUBLISHED)
    target.append(late, "crashed")
    catch_up(ledger, target, "next")
    assert ledger.read().filter("source_id = 'lost'").count() == 1
    before = ledger.batches().count()
    catch_up(ledger, target, "next")
    assert ledger.batches().count() == before
    assert target.next_seq() > target.read().selectExpr("max(seq)").first()[0]
