"""Column functions over names, paths and keys (JVM-side only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind, for Java's and for RE2's regular expressions.
SPACE = r"[\s\x0B\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SEPARATOR = SPACE[:-1] + r"_\-]"


def strip_space(c: Column) -> Column:
    """``c`` without white space of any kind at its ends."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def is_blank(c: Column) -> Column:
    """True for null, empty or only white space; a long text is read up to its first other character only."""
    return ~F.coalesce(c.rlike("[^" + SPACE[1:]), F.lit(False))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: Column) -> Column:
    """File name without folders and last extension; a leading dot is no extension."""
    return F.regexp_replace(file_name(path), r"(?s)(?<=.)\.[^.]*$", "")


def plain_key(c: Column) -> Column:
    """Spelling-free form of a key: ends stripped, lower case, pieces joined by one hyphen."""
    return F.regexp_replace(F.lower(strip_space(c)), f"{SEPARATOR}+", "-")


def group_of(group_key: Column, path: Column) -> Column:
    """Spelling-free group key; the file's stem stands in for a blank one."""
    return plain_key(F.when(is_blank(group_key), file_stem(path)).otherwise(group_key))


def split_name(c: Column) -> Column:
    """train, val or test as written in any way; anything else gives null."""
    s = F.lower(strip_space(c))
    return F.when(s.isin("valid", "validation"), "val").when(s.isin("train", "val", "test"), s)
