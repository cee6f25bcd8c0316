"""Document fingerprints: Merkle trees over clauses, paragraphs and sections.

A text is cut into sections (at empty lines), these into paragraphs (lines), these into
leaves: clauses up to a full stop, or forty characters and the rest of the word. Nothing
is lost in cutting, so equal roots mean equal texts. A leaf's hash is the MD5 of its
text, an upper node's the SHA-256 of its children's hashes, and the root's that of the
sections'. Two versions of a text are compared from the top: sections with equal hashes
are equal, and only below differing ones the edit has to be looked for.

All of it is Column expressions; trees are built where the text is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import written

#: Up to forty characters without a full stop, then the full stops or the rest of the word.
LEAF = r"[^.!?]{0,40}(?:[.!?]+|[^ \t]*[ \t]*)"
#: Bits of doc_id within a block: rows of a block are ordered together, so a block's
#: rows are bounded. The further bits are ordered in the same way, level by level.
BLOCK_BITS, LEVEL_BITS = 10, (14, 20, 20)


def tree(text: Column) -> Column:
    """array of sections, each an array of paragraphs, each an array of leaf hashes.
    A null text is an empty one: a section with one paragraph without leaves."""

    def leaves(paragraph: Column) -> Column:
        found = F.regexp_extract_all(paragraph, F.lit(LEAF), F.lit(0))
        return F.transform(F.filter(found, lambda x: x != ""), F.md5)

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), lambda s: F.transform(F.split(s, "\n"), leaves))


def hashed(leaves: Column) -> Column:
    """array of (hash, paragraphs(hash, leaves)) of a tree."""
    section = F.transform(
        leaves,
        lambda s: F.transform(s, lambda p: F.struct(F.sha2(F.array_join(p, ""), 256).alias("hash"), p.alias("leaves"))),
    )
    return F.transform(
        section,
        lambda s: F.struct(F.sha2(F.array_join(F.transform(s, lambda p: p["hash"]), ""), 256).alias("hash"), s.alias("paragraphs")),
    )


def root(sections: Column) -> Column:
    return F.sha2(F.array_join(F.transform(sections, lambda s: s["hash"]), ""), 256)


def short_leaves(leaves: Column) -> Column:
    """The distinct leaves of a tree, eight hex digits each, in order."""
    return F.array_distinct(F.transform(F.flatten(F.flatten(leaves)), lambda x: F.substring(x, 1, 8)))


def fingerprint(root_hash: Column, short: Column) -> Column:
    return F.concat(root_hash, F.lit(":"), F.array_join(short, ""))


def likeness(a: Column, b: Column) -> Column:
    """Shared among all leaves of two fingerprints; 1 for two without leaves."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def merkle_trees(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``merkle``: struct(root, sections(hash, paragraphs(hash, leaves)))."""
    sections = docs.withColumn("merkle", hashed(tree(F.col(text))))
    return sections.withColumn("merkle", F.struct(root(F.col("merkle")).alias("root"), F.col("merkle").alias("sections")))


def changed_paragraphs(old: Column, new: Column) -> Column:
    """Where two trees differ: array of (section, paragraph), counted from 0, found from the
    top down. Sections and paragraphs are matched by place; those only one tree has differ."""
    pairs = F.arrays_zip(old["sections"].alias("a"), new["sections"].alias("b"))

    def below(pair: Column, i: Column) -> Column:
        lines = F.arrays_zip(pair["a"]["paragraphs"].alias("a"), pair["b"]["paragraphs"].alias("b"))
        lines = F.when(pair["a"]["hash"].eqNullSafe(pair["b"]["hash"]), F.slice(lines, 1, 0)).otherwise(
            F.coalesce(lines, F.transform(F.coalesce(pair["a"]["paragraphs"], pair["b"]["paragraphs"]), lambda p: F.struct(p.alias("a"), F.lit(None).cast(p_type).alias("b"))))
        )
        places = F.transform(lines, lambda l, j: F.struct(i.alias("section"), j.alias("paragraph"), l["a"]["hash"].eqNullSafe(l["b"]["hash"]).alias("same")))
        return F.transform(F.filter(places, lambda x: ~x["same"]), lambda x: F.struct(x["section"].alias("section"), x["paragraph"].alias("paragraph")))

    p_type = "struct<hash:string,leaves:array<string>>"
    found = F.flatten(F.transform(pairs, below))
    return F.when(old["root"] == new["root"], F.slice(found, 1, 0)).otherwise(found)


def following(keys: DataFrame, bits: tuple[int, ...] = LEVEL_BITS) -> DataFrame:
    """(k, next_k) for the distinct numbers ``keys(k)``: the next greater one, and after
    the greatest the least. Numbers that share their upper bits are ordered together; the
    last of such a group goes on to the first of the next group, which is found likewise."""
    if not bits:
        w = Window.orderBy("k")  # what is left of 64 bits: the sign
        first = F.min("k").over(Window.partitionBy())
        return keys.select("k", F.coalesce(F.lead("k").over(w), first).alias("next_k"))
    group = F.shiftright("k", bits[0]).alias("g")
    inside = keys.select("k", group).withColumn("next_k", F.lead("k").over(Window.partitionBy("g").orderBy("k")))
    heads = keys.groupBy(group).agg(F.min("k").alias("head"))
    after = following(heads.select(F.col("g").alias("k")), bits[1:]).select(F.col("k").alias("g"), F.col("next_k").alias("next_g"))
    entry = after.join(heads.select(F.col("g").alias("next_g"), "head"), "next_g").select("g", "head")
    return inside.join(entry, "g").select("k", F.coalesce("next_k", "head").alias("next_k"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text) of ``docs(doc_id, text)``: the text of the row that follows
    by doc_id, and by text among equal ids; after the last row comes the first. Rows
    without an id have no place in the order, and an empty next text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    block = F.shiftright(F.col("doc_id").cast("long"), BLOCK_BITS).alias("block")
    w = Window.partitionBy("block").orderBy("doc_id", "text")
    placed = (
        rows.where("doc_id is not null")
        .select("*", block)
        .select("*", F.lead("text").over(w).alias("next_text"), F.lag("doc_id").over(w).isNull().alias("head"))
    )
    edge = written(placed.where("next_text is null or head"))
    after = following(docs.where("doc_id is not null").select(block.alias("k")).distinct())
    entry = after.join(edge.where("head").select(F.col("block").alias("next_k"), F.col("text").alias("next_text")), "next_k")
    last = edge.where("next_text is null").drop("next_text").join(entry, F.col("block") == F.col("k"))
    columns = ["doc_id", "text", "next_text"]
    return (
        placed.where("next_text is not null")
        .select(*columns)
        .unionByName(last.select(*columns))
        .unionByName(rows.where("doc_id is null").withColumn("next_text", F.lit("")))
    )


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last quarter replaced by as much of the next one's start."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(next_text, F.lit(1), quarter))


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and its edited text, and how alike they are.

    Null texts are empty. Rows are rows, however often an id repeats; other columns are
    not read. An empty table gives no rows; a single document follows itself.
    """
    rows = with_next(docs).select("doc_id", "text", edited(F.col("text"), F.col("next_text")).alias("edited"), "next_text")
    trees = rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        *(tree(F.col(c)).alias(f"tree_{c}") for c in ("text", "edited", "next_text")),
    )
    parts = trees.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        *(short_leaves(F.col(f"tree_{c}")).alias(f"short_{c}") for c in ("text", "edited", "next_text")),
        *(root(hashed(F.col(f"tree_{c}"))).alias(f"root_{c}") for c in ("text", "edited")),
    )
    return parts.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("root_text"), F.col("short_text")).alias("fingerprint"),
        fingerprint(F.col("root_edited"), F.col("short_edited")).alias("edited_fingerprint"),
        likeness(F.col("short_text"), F.col("short_edited")).alias("near_edited"),
        likeness(F.col("short_text"), F.col("short_next_text")).alias("near_next"),
    )
