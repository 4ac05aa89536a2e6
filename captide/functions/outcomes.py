"""Fetch outcomes, playlist ids and metadata fields as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from captide.functions.text import trim_spaces

# Messages that identify a failure, tested in this order on the
# lower-cased error text.
RATE_LIMITED_MESSAGES = (
    "too many requests",
    "429",
    "rate limit",
    "http error 429",
)
NO_SUBTITLES_MESSAGES = (
    "no subtitles",
    "no automatic captions",
    "there are no subtitles",
    "subtitles not available",
)
UNAVAILABLE_MESSAGES = (
    "video unavailable",
    "private video",
    "has been removed",
    "not available",
    "members-only",
    "this video is unavailable",
    "410",
    "403",
)
# How much of an error text is reported.
ERROR_DETAIL_LENGTH = 120

# A year, month and day as strptime's %Y%m%d reads them.
_COMPACT_DATE = r"^(\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])\z"


def _contains_any(text: Column, needles: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(n) for n in needles])


def classify_failure(returncode: Column, stderr: Column) -> Column:
    """Exit code and error text to a fetch status."""
    text = F.lower(stderr)
    return (
        F.when(returncode == 0, "ok")
        .when(_contains_any(text, RATE_LIMITED_MESSAGES), "rate_limited")
        .when(_contains_any(text, NO_SUBTITLES_MESSAGES), "no_subtitles")
        .when(_contains_any(text, UNAVAILABLE_MESSAGES), "unavailable")
        .otherwise("unavailable")
    )


def resolve_outcome(has_caption: Column, returncode: Column, stderr: Column) -> Column:
    """A caption counts as success whatever the exit code; a clean exit without one does not."""
    return (
        F.when(has_caption, "ok")
        .when(returncode != 0, classify_failure(returncode, stderr))
        .otherwise("no_subtitles")
    )


def error_detail(stderr: Column) -> Column:
    """Start of the error text without surrounding white space."""
    return F.substring(trim_spaces(stderr), 1, ERROR_DETAIL_LENGTH)


def playlist_id(url: Column) -> Column:
    """The ``list=`` parameter of a URL, or the input itself when it has none."""
    after = F.split_part(url, F.lit("list="), F.lit(2))
    return F.when(url.contains("list="), F.split_part(after, F.lit("&"), F.lit(1))).otherwise(url)


def compact_date(text: Column) -> Column:
    """``YYYYMMDD`` to a date; anything else, or an impossible day, to null."""
    dashed = F.replace(F.regexp_replace(text, _COMPACT_DATE, "$1-$2-$3"), F.lit(" "), F.lit(""))
    is_date = text.rlike(_COMPACT_DATE) & ~text.startswith("0000")
    return F.when(is_date, dashed.try_cast("date"))


def first_filled(first: Column, second: Column) -> Column:
    """``first`` unless it is null or empty, else ``second``."""
    return F.coalesce(F.nullif(first, F.lit("")), second)


def whole_number(text: Column, kind: str) -> Column:
    """Number text to an integer type, fractions rounded half to even."""
    return F.coalesce(text.try_cast(kind), F.rint(text.try_cast("double")).try_cast(kind))
