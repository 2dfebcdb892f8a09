"""Sequence expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Complements; symbols that are not listed stay. Fixed values.
COMPLEMENTS = {
    "acgtn": ("ACGTNacgtn", "TGCANtgcan"),
    "iupac": ("ACGTNWSMKRYBDHVacgtnwsmkrybdhv", "TGCANWSKMYRVHDBtgcanwskmyrvhdb"),
}


def reverse_complement(seq: Column, dialect: str = "acgtn", upper: bool = False) -> Column:
    """The reverse complement; unknown symbols are kept in place."""
    source, target = COMPLEMENTS[dialect]
    return F.reverse(F.translate(F.upper(seq) if upper else seq, source, target))


def canonical_allele(ref: Column, alt: Column) -> Column:
    """The smaller of (ref, alt) and their reverse complements: one key for both strands."""
    own = F.struct(ref.alias("ref"), alt.alias("alt"))
    other = F.struct(reverse_complement(ref, upper=True).alias("ref"), reverse_complement(alt, upper=True).alias("alt"))
    return F.least(own, other)


def poly_at(seq: Column) -> Column:
    """'polyA' if the end is a run of A (20 other bases may follow), else 'polyT' if the start is one of T, else null."""
    a = seq.rlike("AAAAAAAAAA([ACGT]{1,20}?)?$")
    t = seq.rlike("^([ACGT]{1,20}?)?TTTTTTTTTT")
    return F.when(a, "polyA").when(t, "polyT")


def self_repeat(seq: Column, max_period: int = 200) -> Column:
    """struct(share, period): the best share of bases equal to the one `period` later; the smaller period on ties."""
    n = F.length(seq)
    top = F.least(F.lit(max_period), F.floor(n / 2).cast("int"))

    def share(p: Column) -> Column:
        same = F.size(F.filter(F.sequence(F.lit(1), n - p), lambda i: F.substring(seq, i, F.lit(1)) == F.substring(seq, i + p, F.lit(1))))
        return F.struct((same / (n - p)).alias("share"), (-p).alias("back"))

    best = F.array_max(F.transform(F.sequence(F.lit(1), top), share))
    return F.when(top >= 1, F.struct(best["share"].alias("share"), (-best["back"]).alias("period")))


def kmers(seq: Column, k: int) -> Column:
    """All k-mers of a sequence in order; none if it is shorter."""
    spots = F.sequence(F.lit(1), F.length(seq) - k + 1)
    return F.when(F.length(seq) >= k, F.transform(spots, lambda i: F.substring(seq, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
