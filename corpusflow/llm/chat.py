"""Chat formatting from an event log.

A log holds events of conversations: ``conv_id, seq, message_id, kind, role, text``. The
kinds are ``message`` (begins a message with a text), ``delta`` (adds streamed text),
``edit`` (replaces the text so far) and ``regenerate`` (discards the text so far, and the
later messages that stood when it came). Events are folded into messages, and messages
rendered with marked turns; control strings inside texts are escaped so that they can be
read back. Everything is grouping, windows and Column functions. Rows are brought
together by conversation once, which serves all of these steps, so a text is shuffled
once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_START, TURN_END, LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
#: The role whose texts are trained on.
LOSS_ROLE = "assistant"
RESETS = ("message", "edit", "regenerate")


def escaped(text: Column) -> Column:
    """One backslash more between each ``<`` and ``|``, so no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def together(rows: DataFrame) -> DataFrame:
    """Rows of a conversation in one partition."""
    return rows.repartition("conv_id")


def fold_events(events: DataFrame, placed: bool = False) -> DataFrame:
    """(conv_id, message_id, place, role, text) of the messages that remain; ``placed``
    says that the events come from ``together`` already.

    Events of a message are folded in order of seq (nulls first), then kind, text and
    role, so ties have one result. A null kind is a message, a null text empty; events of
    other kinds are left out. A message's place is its first event's seq and its role the
    first one given, empty if none is. A null conv_id or message_id is an id like any
    other. An event that repeats counts each time.
    """
    kind = F.coalesce("kind", F.lit("message"))
    rows = events.select("conv_id", "message_id", "seq", kind.alias("kind"), F.coalesce("text", F.lit("")).alias("text"), "role")
    rows = rows.where(F.col("kind").isin(*RESETS, "delta"))
    rows = rows if placed else together(rows)
    event = F.struct("seq", "kind", "text", "role")
    folded = rows.groupBy("conv_id", "message_id").agg(
        F.sort_array(F.collect_list(event)).alias("log"),
        F.min(F.struct(F.col("seq").isNotNull(), "seq"))["seq"].alias("place"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"),
    )
    last = F.coalesce(F.array_max(F.transform("log", lambda e, i: F.when(e["kind"].isin(*RESETS), i + 1))), F.lit(1))
    text = F.array_join(F.transform(F.slice("log", last, F.size("log")), lambda e: e["text"]), "")
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    messages = folded.select(
        "conv_id",
        "message_id",
        "place",
        "again",
        F.when(F.size(roles) > 0, F.element_at(roles, 1)).otherwise("").alias("role"),
        text.alias("text"),
    )
    before = Window.partitionBy("conv_id").orderBy("place", "message_id").rowsBetween(Window.unboundedPreceding, -1)
    kept = messages.withColumn("cut", F.max("again").over(before))
    return kept.where("cut is null or place is null or cut <= place").drop("again", "cut")


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, formatted, loss_spans) of each conversation.

    ``loss_spans`` are (start, length) in code points of the formatted text: the escaped
    texts of ``loss_role``. Offsets are running sums, so time is linear in the turns.
    """
    role = F.regexp_replace(escaped(F.col("role")), "\n", LINE)
    turns = messages.select("conv_id", "place", "message_id", F.concat(F.lit(TURN_START), role, F.lit("\n")).alias("head"), escaped(F.col("text")).alias("body"), (F.col("role") == loss_role).alias("loss"))
    turns = turns.withColumn("size", (F.char_length("head") + F.char_length("body") + len(TURN_END)).cast("long"))
    w = Window.partitionBy("conv_id").orderBy("place", "message_id")
    placed = turns.withColumn("n", F.row_number().over(w)).withColumn("at", F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    turn = F.struct(
        "n",
        F.concat("head", "body", F.lit(TURN_END)).alias("turn"),
        F.when(F.col("loss"), F.struct((F.col("at") + F.char_length("head")).alias("start"), F.char_length("body").cast("long").alias("length"))).alias("span"),
    )
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: Column, loss_role: str = LOSS_ROLE) -> Column:
    """array of (role, text, loss) that a formatted conversation says."""

    def turn(part: Column) -> Column:
        head = F.instr(part, "\n")
        role = unescaped(F.replace(F.substring(part, F.lit(1), head - 1), F.lit(LINE), F.lit("\n")))
        text = unescaped(F.substring(part, head + 1, F.char_length(part) - head - len(TURN_END)))
        return F.struct(role.alias("role"), text.alias("text"), (role == loss_role).alias("loss"))

    parts = F.split(formatted, r"<\|im_start\|>")
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def format_conversations(events: DataFrame, loss_role: str = LOSS_ROLE, placed: bool = False) -> DataFrame:
    """(conv_id, formatted, loss_spans) of an event log. An empty log gives no rows."""
    return render(fold_events(events, placed), loss_role)


def turn_events(conversations: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` as events, those of a conversation together.

    Each row is a message of its own that begins with the first half of its text and
    streams the rest as a delta. Rows of one turn come in order of role and text.
    """
    w = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = together(conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")))
    ranked = rows.withColumn("n", F.row_number().over(w))
    half = F.floor(F.char_length("text") / 2).cast("int")
    begun = F.struct(F.lit(0).alias("step"), F.lit("message").alias("kind"), F.col("role"), F.substring("text", F.lit(1), half).alias("text"))
    rest = F.struct(F.lit(1).alias("step"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), F.substring(F.col("text"), half + 1, F.char_length("text")).alias("text"))
    events = ranked.select("conv_id", "turn", "n", F.explode(F.array(begun, rest)).alias("event"))
    return events.select(
        "conv_id",
        F.struct("turn", F.col("event.step").alias("step")).alias("seq"),
        F.struct("turn", "n").alias("message_id"),
        "event.kind",
        "event.role",
        "event.text",
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, in figures and hashes."""
    turns = formatted.select("conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"), read_back(F.col("formatted")).alias("turns"))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), said.alias("said"), loss.alias("loss"), "formatted_chars")
    return rows.select(
        "conv_id",
        "n_turns",
        F.sha2("said", 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
