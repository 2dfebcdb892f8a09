"""Expressions for delimited fields, flags and formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_flag(flags: Column, flag: Column | str, when: Column) -> Column:
    """Appends a flag to a ';' list where the condition holds; it replaces PASS."""
    text = F.lit(flag) if isinstance(flag, str) else flag
    return F.when(F.coalesce(when, F.lit(False)), F.when(flags == "PASS", text).otherwise(F.concat_ws(";", flags, text))).otherwise(flags)


def attributes(text: Column) -> Column:
    """Attributes `key "value"; ...` or `key=value; ...` as a map; a repeated key keeps its last value."""
    parts = F.filter(F.transform(F.split(text, ";"), lambda p: F.btrim(p)), lambda p: p != "")
    pairs = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"^[^\s=]+", 0).alias("key"), F.regexp_replace(F.regexp_replace(p, r"^[^\s=]+\s*=?\s*", ""), '"', "").alias("value")))
    # A list used inside a lambda is made again for each element, unless it is an element itself.
    last = lambda all_: F.filter(all_, lambda x, i: ~F.exists(F.slice(all_, i + 2, F.size(all_)), lambda y: y["key"] == x["key"]))
    return F.get(F.transform(F.array(pairs), lambda all_: F.map_from_entries(last(all_))), F.lit(0))


def attribute(text: Column, key: str) -> Column:
    """One GTF attribute, null if it is absent."""
    found = F.regexp_extract(text, rf'(?:^|;\s*){key} "?([^";]*)"?', 1)
    return F.when(found != "", found)


def info(text: Column) -> Column:
    """VCF INFO as a map."""
    return F.str_to_map(text, F.lit(";"), F.lit("="))


def header_tag(header: Column, tag: str) -> Column:
    """The value of `tag:value` in a FASTA header, null if it is absent."""
    found = F.regexp_extract(header, rf"(?:^|\s){tag}:(\S+)", 1)
    return F.when(found != "", found)


def without_version(name: Column) -> Column:
    return F.split_part(name, F.lit("."), F.lit(1))


def with_version(name: Column, version: Column) -> Column:
    return F.concat_ws(".", name, version)


def strip_chr(name: Column) -> Column:
    return F.regexp_replace(name, "^chr", "")


def add_chr(name: Column) -> Column:
    """1 to chr1, MT to chrM; names that have the prefix stay."""
    return F.when(name == "MT", "chrM").when(name.startswith("chr"), name).otherwise(F.concat(F.lit("chr"), name))


def locus(contig: Column, start: Column, end: Column | None = None) -> Column:
    """contig:start or contig:start-end."""
    text = F.concat_ws(":", contig, start.cast("string"))
    return text if end is None else F.concat_ws("-", text, end.cast("string"))


def safe_float(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def flip(direction: Column, strand: Column) -> Column:
    """A break end's direction seen from the other strand where the strand is '-'."""
    return F.when(strand == "-", F.when(direction == "+", "-").otherwise("+")).otherwise(direction)


def sanitized(name: Column) -> Column:
    return F.replace(name, F.lit("#"), F.lit("_HASH_"))


def restored(name: Column) -> Column:
    return F.replace(name, F.lit("_HASH_"), F.lit("#"))


def mean3(value: Column) -> Column:
    """A mean with three decimals, half to even."""
    return F.bround(value, 3)
