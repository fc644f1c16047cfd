"""Columns read off an alignment record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import NAME_SEPARATOR, REVERSE


def name_parts(qname: Column) -> Column:
    return F.split(qname, "\\|\\|\\|")


def name_part(parts: Column, tag: str) -> Column:
    """The value of the last part `tag:Z:value` of the parts of a read name, or ''."""
    found = F.filter(parts, lambda p: F.startswith(p, F.lit(f"{tag}:Z:")))
    return F.coalesce(F.substring(F.try_element_at(found, F.lit(-1)), 6, 1 << 30), F.lit(""))


def plain_name(qname: Column) -> Column:
    """A read name without its tag parts."""
    return F.split_part(qname, F.lit(NAME_SEPARATOR), F.lit(1))


def negative_strand(flag: Column) -> Column:
    return flag.bitwiseAND(REVERSE) != 0


def with_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseOR(bit)


def marker(pos: Column, mpos: Column, isize: Column) -> Column:
    """Both ends of the fragment as digits in a row, without a separator: some fragments share one."""
    return F.when(isize < 0, F.concat((mpos - isize).cast("string"), mpos.cast("string"))).otherwise(F.concat(pos.cast("string"), (pos + isize).cast("string")))


def barcode_column(barcode: Column) -> Column:
    return F.try_element_at(F.split(barcode, "_"), F.lit(-1)).try_cast("int")


def barcode_row(barcode: Column) -> Column:
    return F.try_element_at(F.split(barcode, "_"), F.lit(-2)).try_cast("int")


def hamming(a: Column, b: Column) -> Column:
    """Places of a at which b differs or has ended."""
    return F.aggregate(F.sequence(F.lit(1), F.length(a)), F.lit(0), lambda n, i: n + (F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))).cast("int"))


def split_nonempty(text: Column, delimiter: str) -> Column:
    """The parts of text between delimiters, without empty ones."""
    return F.filter(F.split(text, f"\\Q{delimiter}\\E"), lambda p: p != "")


def rate(x: Column, n: Column) -> Column:
    """x as a percentage of n, 0 where n is."""
    return F.coalesce(F.try_divide(x * 100.0, n), F.lit(0.0))
