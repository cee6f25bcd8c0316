"""Text functions as Column expressions. All of them run inside the JVM."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0 "
    "           "
    "    　"
)

# The block markup around one paragraph.
BLOCK_OPEN = "<!-- wp:paragraph -->\n<p>"
BLOCK_CLOSE = "</p>\n<!-- /wp:paragraph -->"

# A run of blanks with two line feeds parts paragraphs; blanks before the first one
# are trimmed off later. Inside a paragraph a run of line ends, and blanks between
# them, is one break. Neither backs up, so long runs of blanks cost only their length.
BLANKS = r"[\s\x1c-\x1f]"
INLINE = r"[\s\x1c-\x1f&&[^\n]]"
LINE_ENDS = r"[\n\x0b\f\r\x1c\x1d\x1e\x85  ]"
NO_END = r"[\s\x1c-\x1f&&[^\n\x0b\f\r\x1c\x1d\x1e\x85  ]]"
PARAGRAPH_BREAK = rf"(?U)\n{INLINE}*+\n{BLANKS}*+"
LINE_BREAK = rf"(?U){LINE_ENDS}(?:{NO_END}*+{LINE_ENDS})*+"

# HTML entities, ampersand first so that it is not escaped twice.
HTML_ENTITIES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
    ("'", "&#x27;"),
)

# What counts as a credential-like token, and its stand-in.
TOKEN_RUN = "[A-Za-z0-9+/_-]{32,}={0,2}"
TOKEN_START = "(?<![A-Za-z0-9+/_-])"  # a run matches from its start or not at all
REDACTED = "[redacted]"

# Fixed value: the title of a post without one.
UNTITLED = "Untitled"
EMPTY_MD5 = hashlib.md5(b"").hexdigest()


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def or_else(c: Column, fallback: Column) -> Column:
    """``c`` unless it is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), fallback)


def py_strip(c: Column) -> Column:
    """Unicode strip. Spark's own ``trim`` removes only the space character."""
    return F.trim(c, F.lit(WHITESPACE))


def py_lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITESPACE))


def content_hash(c: Column) -> Column:
    """MD5 of the stripped text; blank or missing text has the empty hash."""
    # the digest of nothing stands for blank, so that a text is stripped only once
    return or_empty(F.nullif(F.md5(py_strip(c)), F.lit(EMPTY_MD5)))


def truncate_words(c: Column, limit: int) -> Column:
    """Cut to ``limit`` characters, back to the last space, and mark with ``...``.

    The mark comes on top, so a result may be up to ``limit + 3`` long.
    """
    cut = F.regexp_replace(F.left(c, F.lit(limit)), r" [^ ]*\z", "")
    return F.when(F.length(c) > limit, F.concat(cut, F.lit("..."))).otherwise(c)


# Labels that a model puts before a title.
TITLE_LABEL = r"(?i)\A(?:headline:|title:)"


def clean_title(c: Column, limit: int) -> Column:
    """First line, without a leading label, quotes or emphasis, cut to ``limit``."""
    line = py_strip(F.substring_index(c, "\n", 1))
    line = py_strip(F.regexp_replace(line, TITLE_LABEL, ""))
    for mark in ('"', "'", "*"):
        line = F.trim(line, F.lit(mark))
    return truncate_words(py_strip(line), limit)


def title_from_summary(c: Column, limit: int) -> Column:
    """The first sentence of a summary, or ``Untitled``."""
    sentence = py_strip(F.substring_index(or_empty(c), ".", 1))
    return or_else(truncate_words(sentence, limit), F.lit(UNTITLED))


def html_escape(c: Column) -> Column:
    for char, entity in HTML_ENTITIES:
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def block_content(c: Column) -> Column:
    """Plain text to paragraph blocks; single line ends become ``<br/>``.

    Blank lines go and other lines keep their blanks, so two substitutions over the
    escaped text say it all; nothing is taken apart line by line.
    """
    paragraphs = F.split(html_escape(py_strip(c)), PARAGRAPH_BREAK)

    def block(p: Column) -> Column:
        lines = F.regexp_replace(F.rtrim(p, F.lit(WHITESPACE)), LINE_BREAK, "<br/>")
        return F.concat(F.lit(BLOCK_OPEN), lines, F.lit(BLOCK_CLOSE))

    return F.array_join(F.transform(F.filter(paragraphs, lambda p: p != ""), block), "\n\n")


def with_byline(content: Column, author: Column) -> Column:
    byline = F.concat(
        F.lit(BLOCK_OPEN + "<em>By "), html_escape(author), F.lit("</em>" + BLOCK_CLOSE)
    )
    return F.concat(byline, F.lit("\n\n"), content)


def redact(c: Column, limit: int = 300) -> Column:
    """Hide credential-like token runs in an error excerpt, then shorten it.

    The excerpt length belongs to error reports; ``limit=0`` keeps the whole text.
    """
    hidden = F.regexp_replace(c, TOKEN_START + TOKEN_RUN, REDACTED)
    return F.left(hidden, F.lit(limit)) if limit else hidden


def slugify(c: Column, default: str) -> Column:
    dashed = F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-")
    return or_else(F.trim(dashed, F.lit("-")), F.lit(default))


def first_name(c: Column) -> Column:
    return F.substring_index(c, " ", 1)


def last_name(c: Column) -> Column:
    """Everything after the first space; empty for a single word."""
    return or_empty(F.get(F.split(c, " ", 2), F.lit(1)))


def synthetic_email(slug: Column, domain: str) -> Column:
    return F.concat(slug, F.lit("@" + domain))


def year_month(iso: Column) -> Column:
    """The YYYY-MM of an ISO date."""
    return F.left(iso, F.lit(7))


def token_estimate(chars: Column) -> Column:
    """Four characters to a token, rounded down."""
    return F.floor(chars / F.lit(4)).cast("bigint")
