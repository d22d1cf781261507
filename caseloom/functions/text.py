"""Text expressions.  All of them stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space spelled out, so that it means the same everywhere.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_RUN = r"(?U)[\s\x1C-\x1F]+"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a variable of ``body``: however often it is used, it is written and computed once."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` alone only removes spaces)."""
    return F.btrim(_col(c), F.lit(SPACES))


def collapse_whitespace(c: Column | str) -> Column:
    """Squeeze white-space runs to one space, strip, and turn NULL into ''."""
    return F.coalesce(F.trim(F.regexp_replace(_col(c), _RUN, " ")), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """True for NULL, '' and white space only."""
    return F.coalesce(strip(c) == "", F.lit(True))


def contains_any(c: Column | str, needles: Iterable[str], word_boundary: bool = False) -> Column:
    """Whether the text, lower-cased, contains any needle."""
    def test(low: Column) -> Column:
        found = F.lit(False)
        for needle in needles:
            found = found | _contains(low, needle, word_boundary)
        return found

    return let(F.lower(_col(c)), test)


def matching(c: Column | str, needles: Iterable[str], word_boundary: bool = False) -> Column:
    """The needles contained in the lower-cased text, in needle order."""
    needles = list(needles)
    if not needles:
        return F.array().cast("array<string>")
    return let(
        F.lower(F.coalesce(_col(c), F.lit(""))),
        lambda low: F.array_compact(F.array(*[F.when(_contains(low, n, word_boundary), F.lit(n)) for n in needles])),
    )


def _contains(low: Column, needle: str, word_boundary: bool) -> Column:
    if word_boundary:
        return F.rlike(low, F.lit(rf"\b{re.escape(needle)}\b"))
    return F.contains(low, F.lit(needle))


def regex_hits(c: Column | str, patterns: Iterable[str]) -> Column:
    """All whole matches, ignoring case, by pattern and then by position."""
    found = [F.regexp_extract_all(_col(c), F.lit(f"(?iU){p}"), F.lit(0)) for p in patterns]
    return F.flatten(F.array(*found))


def tokens(c: Column | str) -> Column:
    """Lower-cased word tokens of at least two characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(c), F.lit(""))), F.lit(TOKEN), F.lit(0))


def first_label(c: Column | str, rules, default: str, null_label: str | None = None) -> Column:
    """First label, in rule order, having a keyword in the text."""
    return let(F.lower(_col(c)), lambda low: first_label_of(low, rules, default, null_label))


def first_label_of(low: Column, rules, default: str, null_label: str | None = None) -> Column:
    """The same for a text that is lower-cased already."""
    out = F.when(low.isNull(), F.lit(default if null_label is None else null_label))
    for label, keywords in rules:
        test = F.lit(False)
        for k in keywords:
            test = test | F.contains(low, F.lit(k))
        out = out.when(test, F.lit(label))
    return out.otherwise(F.lit(default))


def parse_when(c: Column | str) -> Column:
    """Timestamp from ``Tue Oct 31 22:10:47 +0000 2017`` or an ISO string; NULL if neither."""
    c = _col(c)
    # A format that does not fit costs an exception per row, so the form is looked at first.
    weekday_first = F.rlike(c, F.lit("^[A-Z][a-z]{2} [A-Z][a-z]{2} "))
    return F.when(
        weekday_first, F.try_to_timestamp(F.substring(c, 5, 40), F.lit("MMM dd HH:mm:ss Z yyyy"))
    ).otherwise(F.try_to_timestamp(c))


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    """Signed minutes from ``earlier`` to ``later``."""
    return (F.unix_micros(_col(later)) - F.unix_micros(_col(earlier))) / F.lit(6e7)


def seeded_order(seed: int, *ids: Column | str) -> Column:
    """Pseudo-random sort key that depends only on the seed and the ids."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[_col(i).cast("string") for i in ids]))
