"""Column functions for keys, hashes, names and report texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: How a dive stands in an address (fixed value).
DIVE = r"/([A-Za-z]+/(?:D|T|V)?\d{3,5})/"


def make_group(stem: Column, mode: str = "none", pattern: str | None = None, field: Column | None = None) -> Column:
    """Group of an image: its stem, the first capture of a pattern matched at the stem's start, or a field of its record; the stem wherever that is missing or blank."""
    if mode == "regex" and pattern:
        return F.when(stem.rlike(f"^(?:{pattern})"), F.regexp_extract(stem, f"^(?:{pattern})", 1)).otherwise(stem)
    if mode == "field" and field is not None:
        return F.coalesce(F.nullif(field.cast("string"), F.lit("")), stem)
    return stem


def stable_bucket(key: Column, buckets: int = 100) -> Column:
    """First eight hexadecimal digits of the key's MD5, modulo ``buckets``; the same on every machine."""
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def out_name(dataset: Column, path: Column) -> Column:
    """``dataset_`` and ten digits of the SHA-1 of the root-relative path."""
    return F.concat(dataset, F.lit("_"), F.substring(F.sha1(path), 1, 10))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def dive_of(url: Column, uuid: Column) -> Column:
    """The dive named in an image's address, else its uuid."""
    return F.coalesce(F.nullif(F.regexp_extract(url, DIVE, 1), F.lit("")), uuid)


def flat_name(path: Column) -> Column:
    """``session_file`` of ``.../session/file``."""
    parts = F.split(path, "/")
    return F.concat_ws("_", F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1)))


def human_bytes(n: Column) -> Column:
    """Bytes on the 1024 ladder with one decimal."""
    units = ["B", "KB", "MB", "GB", "TB", "PB"]
    out = F.format_string("%.1fPB", n / float(1024**5))
    for i in range(len(units) - 2, -1, -1):
        out = F.when(F.abs(n) < float(1024 ** (i + 1)), F.format_string(f"%.1f{units[i]}", n / float(1024**i))).otherwise(out)
    return out


def class_score(ap: Column) -> Column:
    """A class's score with four decimals, or that it has no instances."""
    return F.when(ap.isNull(), F.lit("n/a (0 instances)")).otherwise(F.format_string("%.4f", ap))


def number(token: Column) -> Column:
    """A token as a finite double, null if it isn't written as a plain decimal number."""
    return F.when(token.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), token.try_cast("double"))


def dhash_of_gray(gray: Column, columns: int = 9) -> Column:
    """Difference hash of a gray matrix given row by row: one bit where a value is less than its right neighbour, first bit highest.

    ``columns`` values a row; 9 columns and 8 rows give 64 bits, fewer values fewer bits.
    """
    pairs = F.filter(F.sequence(F.lit(0), F.size(gray) - 2), lambda i: i % columns < columns - 1)
    bit = lambda i: F.when(F.get(gray, i) < F.get(gray, i + 1), F.lit(1)).otherwise(F.lit(0)).cast("long")
    return F.when(F.size(gray) > 1, F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, i: F.shiftleft(acc, 1).bitwiseOR(bit(i))))
