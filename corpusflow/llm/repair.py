"""Conversation structure repair by a persistent audit DP.

A conversation's rows are kept, given another role, deleted, or joined by empty turns, at
least cost, so that the initials of their roles read ``(s?(ua)+)?``. Edits are letters of
an audit string (D, I, K, R); of equally cheap audits the least in ASCII order wins. The
state is what came last: nothing, a system, a user or an assistant turn. It says which role
an R or I must give, so an audit names its edits fully.

Audits are not strings but nodes: each state has one node, a letter linked to the node of
the audit before it, so states share their prefixes. A node keeps its depth, a rolling hash
of its audit and its ancestors at distances of powers of two. Two audits are compared by
lifting both to one depth and searching their longest common prefix by hashes, in
logarithmic time; nodes of equal hash that are not the same node are compared letter by
letter back to where they meet. Once all states share a prefix it is written out and its nodes
are forgotten, so memory follows the length of what is still open, not of the conversation.

Spark brings the rows of a conversation together and sorts them; the rows then stream
through the task. Which rows repeat an earlier one is found beforehand on digests, so a task
holds no texts and no sets of them: a conversation with a third of all rows costs its
audit, a byte per row. Repaired texts are hashed on the way, one running hash per state.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import python_ready

#: Costs of the edits, and of leaving a truncated row in.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after a system, user, assistant turn; ends that read right.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: The state that a user or assistant turn leads to, by the state before.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
#: Open nodes from which on the shared prefix is looked for.
OPEN = 1 << 12
_BASE, _MOD = 1_000_003, (1 << 61) - 1
_WORD = re.compile(r"[^\x20\x09-\x0D]")


class Node:
    """An audit: its last letter, and links to the audits before."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, letter: str, parent: Node | None) -> None:
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * _BASE + ord(letter)) % _MOD
        up, k = [parent], 0
        while k < len(up[k].up):  # the ancestor twice as far
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)

    def at(self, depth: int) -> Node:
        """The ancestor of this depth."""
        node, gap = self, self.depth - depth
        while gap:
            k = gap.bit_length() - 1
            node, gap = node.up[k], gap - (1 << k)
        return node


def same(a: Node, b: Node) -> bool:
    """Whether two audits of one depth are equal; equal hashes are verified."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Node, b: Node) -> bool:
    """Whether the audit ``a`` comes before ``b``, as strings."""
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if same(x, y):
        return a.depth < b.depth
    while True:  # down to the first place where they differ
        for k in range(len(x.up) - 1, -1, -1):
            if not same(x.up[k], y.up[k]):
                x, y = x.up[k], y.up[k]
                break
        else:
            return x.letter < y.letter


def letters(node: Node) -> str:
    out = []
    while node.depth:
        out.append(node.letter)
        node = node.up[0]
    return "".join(reversed(out))


class Repair:
    """One conversation, row by row."""

    def __init__(self) -> None:
        self.rows = self.gaps = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.turns = 0
        self.initial: str | None = None
        self.audit = bytearray()
        self.open = OPEN
        self.made = 0
        # by state: cost, audit, hash of the repaired text
        self.best: list[tuple | None] = [(0, Node("", None), sha256()), None, None, None]

    def turn(self, turn: int | None) -> None:
        """Rows come in order of their turns, nulls first."""
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        self.rows += 1
        self.turn(turn)
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        end = next((c for c in reversed(text) if _WORD.match(c)), None)
        must_go = end is None or repeated
        cut = not must_go and end not in ".!?"
        self.blank += end is None
        self.duplicate += repeated and end is not None
        self.truncated += cut
        self._insert()
        extra = TRUNCATED if cut else 0
        new: list[tuple | None] = [None] * 4
        # a candidate: cost, the audit before, its letter, the hash before, its line
        for state, was in enumerate(self.best):
            if was is None:
                continue
            cost, node, text_hash = was
            self._offer(new, state, cost + DELETE, node, "D", text_hash, None)
            if must_go:
                continue
            to = NEXT[state]
            before = "" if state == START else "\n"
            if initial == "s" and state == START:
                self._offer(new, SYSTEM, cost + KEEP + extra, node, "K", text_hash, f"{role}:{text}")
            elif (initial == "u" and to == USER) or (initial == "a" and to == ASSISTANT):
                self._offer(new, to, cost + KEEP + extra, node, "K", text_hash, f"{before}{role}:{text}")
            self._offer(new, to, cost + REROLE + extra, node, "R", text_hash, f"{before}{ROLE[to]}:{text}")
        self.best = [self._made(c) for c in new]
        self.made += sum(c is not None for c in new)
        if self.made > self.open:
            self._forget()

    def _offer(self, new: list, state: int, cost: int, node: Node, letter: str, text_hash, line: str | None) -> None:
        old = new[state]
        if old is None or cost < old[0] or (cost == old[0] and self._less(node, letter, old)):
            new[state] = (cost, node, letter, text_hash, line)

    def _less(self, node: Node, letter: str, old: tuple) -> bool:
        return less(Node(letter, node), Node(old[2], old[1]))

    def _made(self, candidate: tuple | None) -> tuple | None:
        if candidate is None:
            return None
        cost, node, letter, text_hash, line = candidate
        if line is not None:
            text_hash = text_hash.copy()
            text_hash.update(line.encode("utf-8", "surrogatepass"))
        return cost, Node(letter, node), text_hash

    def _insert(self) -> None:
        """Empty turns at this place: one after another while that is cheaper."""
        moved = True
        while moved:
            moved = False
            for state, was in enumerate(self.best):
                if was is None:
                    continue
                to = NEXT[state]
                cost, old = was[0] + INSERT, self.best[to]
                if old is None or cost < old[0] or (cost == old[0] and less(Node("I", was[1]), old[1])):
                    line = f"{'' if state == START else chr(10)}{ROLE[to]}:"
                    self.best[to] = self._made((cost, was[1], "I", was[2], line))
                    self.made += 1
                    moved = True

    def _forget(self) -> None:
        """Write the prefix that all states share, and link what is open anew."""
        nodes = [b[1] for b in self.best if b is not None]
        depth = min(n.depth for n in nodes)
        meet = [n.at(depth) for n in nodes]
        while any(n is not meet[0] for n in meet):
            meet = [n.up[0] for n in meet]
        shared = meet[0]
        self.audit += letters(shared).encode()
        fresh = {id(shared): Node("", None)}
        for n in nodes:
            path = []
            while id(n) not in fresh:
                path.append(n)
                n = n.up[0]
            for old in reversed(path):
                fresh[id(old)] = Node(old.letter, fresh[id(old.up[0])])
        self.best = [b and (b[0], fresh[id(b[1])], b[2]) for b in self.best]
        self.made = len(fresh)
        self.open = max(OPEN, 2 * self.made)

    def result(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)."""
        self._insert()
        ends = [self.best[s] for s in ENDS if self.best[s] is not None]
        end = ends[0]
        for other in ends[1:]:
            if other[0] < end[0] or (other[0] == end[0] and less(other[1], end[1])):
                end = other
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        audit = self.audit.decode() + letters(end[1])
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, end[0], audit, end[2].hexdigest()


FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)
    of each conversation of ``rows(conv_id, turn, role, text)``.

    Rows go by turn, nulls first, those of one turn by role and then by the SHA-256 of the
    text; equal rows stand together and all but the first repeat it. A null role or text is
    one space. A row whose column ``gone`` is true (where there is one) is no row of its
    conversation, which is reported all the same: without rows its figures are zero, its
    audit is empty and its hash that of nothing. A null conv_id is an id like any other.
    Columns of other names play no part. An empty table gives no rows. Texts are hashed and
    looked at whole, one at a time.
    """
    python_ready(rows.sparkSession)
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    said = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        gone.alias("gone"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    said = said.withColumn("digest", F.when(~F.col("gone"), F.unhex(F.sha2("text", 256))))
    # turns at which a (role, text) stands again, from digests alone
    seen = Window.partitionBy("conv_id", "role", "digest").orderBy("turn")
    keys = said.where("not gone").select("conv_id", "turn", "role", "digest").distinct()
    again = keys.withColumn("_n", F.row_number().over(seen)).where("_n > 1").drop("_n")
    # such a mark stands right before the rows it is about
    null = F.lit(None).cast("string")
    marks = again.select("conv_id", "turn", F.lit(False).alias("gone"), "role", null.alias("text"), "digest", F.lit(0).alias("kind"))
    both = said.withColumn("kind", F.when(F.col("gone"), 2).otherwise(1)).withColumn("text", F.when(~F.col("gone"), F.col("text")))
    both = both.unionByName(marks).drop("gone")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "kind"]
    streamed = both.repartition("conv_id").sortWithinPartitions(*order)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, now, before, mark = None, None, None, None

        def out() -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            types = [streamed_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", *[f.split()[0] for f in FOUND.split(", ")]])

        streamed_type = None
        for batch in batches:
            streamed_type = batch.schema.field("conv_id").type
            for low in range(0, batch.num_rows, 512):
                some = batch.slice(low, 512)
                for conv_id, turn, role, text, digest, what in zip(*(some.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "digest", "kind"))):
                    if now is None or conv_id != conv:
                        if now is not None:
                            done.append((conv, *now.result()))
                        conv, now, before, mark = conv_id, Repair(), None, None
                    key = (turn, role, digest)
                    if what == 0:
                        mark = key
                    elif what == 1:
                        now.add(turn, role, text, key == mark or key == before)
                        before = key
                if len(done) >= 1024:
                    yield out()
        if now is not None:
            done.append((conv, *now.result()))
        if done:
            yield out()

    return streamed.mapInArrow(run, f"conv_id {kind}, {FOUND}")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows damaged by a checksum of their place, modulo 20: 0 takes a row out, 1
    empties its text, 2 takes out its ends of sentences, 3 repeats it, 4 makes its role
    user. Nulls count as one space; rows taken out stay with ``gone`` set, for their ids."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select(
        "conv_id",
        "turn",
        (F.crc32(name.cast("binary")) % 20).alias("how"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    how = F.col("how")
    rows = rows.withColumn("role", F.when(how == 4, "user").otherwise(F.col("role")))
    rows = rows.withColumn("text", F.when(how == 1, "").when(how == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    copies = F.when(how == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.withColumn("copy", F.explode(copies)).withColumn("gone", how == 0)
    return rows.select("conv_id", "turn", "role", "text", "gone")
