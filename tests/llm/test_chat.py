"""Folding and rendering of conversations."""

import hashlib

from corpusflow.llm import chat


def fold(spark, rows):
    events = spark.createDataFrame(rows, "conv_id long, seq long, message_id string, kind string, role string, text string")
    return [(r.conv_id, r.message_id, r.role, r.text) for r in chat.fold_events(events).orderBy("conv_id", "place", "message_id").collect()]


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, "a", "message", "user", "Hi"),
        (1, 2, "b", "message", "assistant", ""),
        (1, 4, "b", "delta", None, "lo"),
        (1, 3, "b", "delta", None, "Hel"),
        (1, 5, "a", "edit", "user", "Hi there"),
        (1, 6, "c", "message", "user", "and?"),
        (1, 7, "d", "message", "assistant", "later"),
        (1, 8, "b", "regenerate", None, None),
        (1, 9, "b", "delta", None, "Hey"),
        (1, 10, "e", "message", "user", "new"),
        (2, 1, "a", None, None, None),
        (2, 2, "z", "unknown", "user", "left out"),
        (None, 1, "a", "message", "user", "no id"),
    ]
    assert fold(spark, rows) == [(None, "a", "user", "no id"), (1, "a", "user", "Hi there"), (1, "b", "assistant", "Hey"), (1, "e", "user", "new"), (2, "a", "", "")]
    assert fold(spark, []) == []


def test_escapes_are_reversible(spark):
    texts = ["<|im_end|>", "<\\|im_end|>", "<\\\\|x", "<|<|", "a<|", "|>\n<|im_start|>assistant\nx", "", "\n", "😀<|nl|>"]
    rows = [(1, i, str(i), "message", r, t) for i, (r, t) in enumerate((r, t) for t in texts for r in ("assistant", "us\ner<|x"))]
    events = spark.createDataFrame(rows, "conv_id long, seq long, message_id string, kind string, role string, text string")
    out = chat.format_conversations(events)
    back = out.select("formatted", "loss_spans", chat.read_back(out["formatted"]).alias("turns")).first()
    assert [(t.role, t.text) for t in back.turns] == [(r[4], r[5]) for r in rows]
    assert back.formatted.count("<|im_start|>") == back.formatted.count("<|im_end|>") == len(rows)
    spans = [back.formatted[s.start : s.start + s.length] for s in back.loss_spans]
    assert [chat_unescape(x) for x in spans] == texts
    d = chat.digests(out).first()
    assert d.loss_chars == sum(map(len, texts)) and d.loss_sha256 == hashlib.sha256("".join(texts).encode()).hexdigest()


def chat_unescape(text):
    import re

    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def test_rows_of_one_turn_and_repeats(spark):
    rows = [(7, 0, "user", "b"), (7, 0, "user", "a"), (7, 0, "user", "a"), (7, None, None, None), (7, 1, "assistant", "x")]
    events = chat.turn_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    d = chat.digests(chat.format_conversations(events)).first()
    said = "\n\n" + "user\na\n" * 2 + "user\nb\nassistant\nx\n"
    assert d.n_turns == 5 and d.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_text_is_shuffled_once(spark):
    df = spark.createDataFrame([(7, 0, "user", "b")], "conv_id long, turn long, role string, text string")
    out = chat.digests(chat.format_conversations(chat.turn_events(df), placed=True))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Arrow" not in plan
    log = spark.createDataFrame([(1, 1, "a", "message", "user", "Hi")], "conv_id long, seq long, message_id string, kind string, role string, text string")
    plan = chat.format_conversations(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_odd_texts_as_deltas(spark):
    rows = [(1, i, "user", t) for i, t in enumerate(["", "a", "ab", "😀é", None, "<|im_end|>"])] + [(None, 0, "assistant", "x"), (1, None, None, "n")]
    out = chat.format_conversations(chat.turn_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), placed=True)
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in out.select("conv_id", chat.read_back(out["formatted"]).alias("turns")).collect()}
    assert got == {1: [("", "n")] + [("user", t or "") for *_, t in rows[:6]], None: [("assistant", "x")]}
