"""Text functions. White space is Unicode's, as a bare trim() or \\s knows only some of it."""

from __future__ import annotations

from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WHITE = r"[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}]"
LINE_END = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x85\x{2028}\x{2029}]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WHITE}+|{WHITE}+$", "")


def collapse(c: Column) -> Column:
    """Every run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{WHITE}+", " "))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def nonblank_lines(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, LINE_END), strip), lambda x: x != "")


def last_line(c: Column) -> Column:
    """The last line of the stripped text, in upper case; empty for a blank one."""
    return F.upper(F.coalesce(F.element_at(F.split(strip(c), LINE_END), -1), F.lit("")))


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def suffix(c: Column) -> Column:
    """The lower-case suffix of a path, without its dot; empty if there is none."""
    return F.lower(F.regexp_extract(basename(c), r"^.+\.([^.]+)$", 1))


def path_key(c: Column) -> Column:
    """Sorts paths by their parts, so that a/b comes before a.txt."""
    return F.split(c, "/")


def is_safe_path(c: Column) -> Column:
    """A relative path that can't leave its folder."""
    up = F.array_contains(F.split(c, "/"), "..")
    return c.isNotNull() & (c != "") & ~c.rlike(r"^(\./?)+$") & ~c.startswith("/") & ~c.contains("\\") & ~c.contains(":") & ~up


def path_steps(name: str) -> list[str] | None:
    """is_safe_path() of one name on the driver: its steps, or None for a path that could leave its folder."""
    steps = [s for s in name.split("/") if s not in ("", ".")]
    odd = name.startswith("/") or ".." in steps or not set(name).isdisjoint("\\:")
    return None if odd else steps or None


def under(path: Column, folder: str) -> Column:
    """Whether a path lies in a folder, by its beginning: the filter reaches the scan."""
    return path.startswith(folder)


def cut(c: Column, most: int) -> Column:
    return F.substring(c, 1, most)


def reaches(c: Column, most: int) -> Column:
    """Whether a text is as long as it may be: what was cut can't be told from what just fits."""
    return F.length(c) >= most


@F.pandas_udf(StringType())
def _casefold(texts: pd.Series) -> pd.Series:
    return texts.map(str.casefold, na_action="ignore")


def folded(c: Column) -> Column:
    """For comparison without case, by Unicode's full folding: one letter and its two-letter form agree.

    lower() and upper() aren't that: they know the place of a letter in its word, and the optimizer takes one of the two
    away. Texts are folded in batches in Python, as a look at each letter by expressions takes several times as long."""
    return _casefold(c)


# Names and beginnings of names of files that office programs and file managers leave behind.
LEFT_BEHIND, LEFT_BEGINNINGS = (".DS_Store", "Thumbs.db"), ("._", "~$")


def is_metadata_file(c: Column) -> Column:
    """Files that office programs and file managers leave behind."""
    name = basename(c)
    return reduce(or_, [name.startswith(x) for x in LEFT_BEGINNINGS], name.isin(*LEFT_BEHIND))


def packet_name(ordinal: Column) -> Column:
    return F.format_string("t_%02d", ordinal)


def deliverable_name(ordinal: Column) -> Column:
    return F.format_string("t%02d", ordinal)


def joined_notes(*notes: Column) -> Column:
    from ..schemas import NOTE_SEPARATOR

    return F.concat_ws(NOTE_SEPARATOR, *[F.when(n != "", n) for n in notes])


def is_https(url: Column) -> Column:
    return url.rlike(r"^(?i:https)://[^/?#:@]+")
