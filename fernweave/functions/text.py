"""Text expressions, all JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers that normalisation leaves, and the character classes it blanks.
TRAVERSAL, TRAVERSAL_MARK = "/..", " pathsearcherdetected "
HOST_CHECK, HOST_CHECK_MARK = "host: [0-9].", " hostcheckdetected "
TRAIN_CLASS = r"[\-%./!@#$?,;:&*)(+=0-9]"
PREDICT_CLASS = r"[\-%.!@#$?,;:&*)(+=0-9]"
COLUMNS_CLASS = r"[\./!@#$?,;:&*)(_]"
#: Noise that prediction removes from agent and path before normalising.
AGENT_NOISE = ["or", "from", "protocol discovery", "alert.gogigong.kr", "preserving prefetch proxy"]
PATH_NOISE = [
    "alert",
    "javascript",
    "nice",
    "update.ini",
    "xmlrpc.php",
    "callservletservice.jsp",
    "/etc/",
    ".well-known/traffic-advice",
]


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_decoded(c: Column | str) -> Column:
    """Percent-decoding that leaves ``+`` and malformed escapes alone."""
    safe = F.regexp_replace(F.replace(column(c), F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(safe)


def without(c: Column | str, parts: list[str]) -> Column:
    """The lower-cased text without the given substrings, removed one after the other."""
    out = F.lower(column(c))
    for part in parts:
        out = F.replace(out, F.lit(part), F.lit(""))
    return out


def normalised(c: Column | str, blanked: str = TRAIN_CLASS, lower: bool = True, host_check: bool = True) -> Column:
    """Decoded (and lower-cased) text with markers for traversal and host checks, and ``blanked`` turned into spaces."""
    out = url_decoded(c)
    if lower:
        out = F.lower(out)
    out = F.replace(out, F.lit(TRAVERSAL), F.lit(TRAVERSAL_MARK))
    if host_check:
        out = F.regexp_replace(out, HOST_CHECK, HOST_CHECK_MARK)
    return F.regexp_replace(out, blanked, " ")


def joined_text(*columns: Column | str) -> Column:
    """Columns with single spaces between; a null column counts as empty."""
    return F.concat_ws(" ", *[F.coalesce(column(c), F.lit("")) for c in columns])


def after(c: Column | str, literal: str) -> Column:
    """What stands between the first and second ``literal``; empty if there is none."""
    return F.split_part(column(c), F.lit(literal), F.lit(2))


def tokens(c: Column | str) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores of any script."""
    return F.regexp_extract_all(F.lower(column(c)), F.lit(r"([\p{L}\p{N}_]{2,})"), 1)


def excluded(c: Column | str, pattern: str) -> Column:
    """Whether the lower-cased text matches the lower-cased pattern; an empty pattern excludes nothing."""
    if not pattern:
        return F.lit(False)
    return F.coalesce(F.lower(column(c)).rlike(pattern.lower()), F.lit(False))


def distinct_text(c: Column | str) -> Column:
    """Aggregate: the distinct texts of a group in order, joined by a space."""
    return F.array_join(F.sort_array(F.collect_set(column(c))), " ")


def slashed(c: Column | str) -> Column:
    """Any value as text with backslashes turned into slashes."""
    return F.replace(column(c).cast("string"), F.lit("\\"), F.lit("/"))


def unpunctuated(c: Column | str) -> Column:
    """Text without ASCII punctuation."""
    return F.regexp_replace(column(c), r"[!-/:-@\[-`{-~]", "")
