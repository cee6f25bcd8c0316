"""Seeded picks: every draw is a hash of (seed, purpose, row id).

A draw depends on nothing but its row, so it is the same for any partitioning,
any sample size and any resumed run.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

# Fixed value: the form of a year and month.
YEAR_MONTH = r"\A\d{4}-(0[1-9]|1[0-2])\z"


def sample_key(id_: Column, seed: int = 42) -> Column:
    """Hex digest that puts rows in their seeded random order."""
    return F.md5(F.concat(F.lit(f"{seed}:sample:"), id_))


def draw(id_: Column, purpose: str, seed: int = 42) -> Column:
    """Uniform integer in [0, 2**32)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), id_))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def pick_author(id_: Column, pool: list[str], seed: int = 42) -> Column:
    """One author of the pool per row; an empty pool gives an empty author."""
    if not pool:
        return F.lit("")
    names = F.array(*[F.lit(name) for name in pool])
    slot = F.pmod(draw(id_, "author", seed), F.lit(len(pool))) + 1
    return F.element_at(names, slot.cast("int"))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def pick_date(id_: Column, start: str, end: str, seed: int = 42) -> Column:
    """A second in [start, end]; a range that runs backwards gives its start."""
    first, last = datetime.fromisoformat(start), datetime.fromisoformat(end)
    span = max(int((last - first).total_seconds()), 0)
    # two draws make 62 bits, enough for any range of seconds
    wide = F.shiftleft(draw(id_, "date_hi", seed).bitwiseAND(F.lit(0x3FFFFFFF)), 32).bitwiseOR(
        draw(id_, "date", seed)
    )
    offset = F.pmod(wide, F.lit(span + 1))
    origin = F.lit(first.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return _iso(F.timestamp_add("SECOND", offset, origin))


def is_year_month(c: Column) -> Column:
    return F.coalesce(c.rlike(YEAR_MONTH), F.lit(False))


def date_from_year_month(ym: Column, id_: Column, start: str, end: str, seed: int = 42) -> Column:
    """A valid day and time in month ``ym``; null when malformed or out of window.

    The window is checked by month, so its edge months count whole.
    """
    inside = is_year_month(ym) & ym.between(F.lit(start[:7]), F.lit(end[:7]))
    # year 0000 has the right form but is no year
    inside = inside & (F.left(ym, F.lit(4)) != "0000")
    month_start = F.try_to_date(F.concat(ym, F.lit("-01")), "yyyy-MM-dd")
    days = F.dayofmonth(F.last_day(month_start))

    def part(purpose: str, n: Column) -> Column:
        return F.pmod(draw(id_, purpose, seed), n)

    text = F.format_string(
        "%s-%02dT%02d:%02d:%02d",
        ym,
        part("day", days) + 1,
        part("hour", F.lit(24)),
        part("minute", F.lit(60)),
        part("second", F.lit(60)),
    )
    return F.when(inside, text)
