"""License scans by ordered signature rules, in native expressions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table
from .license_rules import GATES, WEIGHTS, Rule, rules

#: Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _any(parts: Sequence[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def _keyword(rule: Rule) -> str:
    """The rule's keyword, or the longest stretch of plain letters that its pattern cannot do without."""
    if rule.keyword:
        return rule.keyword
    depth, plain, best = 0, "", ""
    pattern = rule.pattern + "("
    for i, c in enumerate(pattern):
        after = pattern[i + 1 : i + 2]
        if c in "([":
            depth += 1
        if depth == 0 and (c.isalnum() or c == " ") and after not in ("?", "*", "{") and pattern[i - 1 : i] != "\\":
            plain += c
        else:
            best, plain = max(best, plain.strip(" "), key=len), ""
        if c in ")]":
            depth -= 1
    return best


DETECTION = "struct<start:int,stop:int,rank:int,label:string,weight:double>"


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """What `combine` makes of each value and all before it, by steps of doubling width: n log n, and no array grows by one."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def doubled(now: Column, k: Column) -> Column:
        width = F.pow(F.lit(2), k).cast("int")
        return F.transform(now, lambda v, i: F.when(i >= width, combine(v, F.get(now, i - width))).otherwise(v))

    return F.aggregate(steps, values, doubled)


def detections(norm: Column, signatures: Sequence[Rule]) -> Column:
    """All places of the rules in the spaced words: array of (start, stop, rank, label, weight).

    The rules are one constant array. Only those whose keyword the text holds are matched; the places of a rule
    follow from what its pattern splits the text into. Nothing is matched twice by one rule at one place.
    """
    constant = F.array(*[F.struct(F.lit(_keyword(r)).alias("keyword"), F.lit(f" (?:{r.pattern})(?= )").alias("pattern"), F.lit(i).alias("rank"), F.lit(r.label).alias("label"), F.lit(WEIGHTS[r.kind]).alias("weight")) for i, r in enumerate(signatures)])

    def places(r: Column) -> Column:
        def located(hits: Column, gaps: Column) -> Column:
            ends = running(F.transform(hits, lambda h, i: F.get(gaps, i) + F.length(h)), lambda a, b: a + b)
            return F.transform(F.arrays_zip(hits.alias("hit"), ends.alias("end")), lambda x: F.struct((x["end"] - F.length(x["hit"]) + 1).alias("start"), x["end"].alias("stop"), r["rank"].alias("rank"), r["label"].alias("label"), r["weight"].alias("weight")))

        gaps = F.transform(F.split(norm, r["pattern"], -1), lambda x: F.length(x))
        return let(F.regexp_extract_all(norm, r["pattern"], F.lit(0)), lambda hits: let(gaps, lambda g: located(hits, g)))

    gated = F.filter(constant, lambda r: F.contains(norm, r["keyword"]))
    return F.flatten(F.transform(gated, places))


def resolved(found: Column) -> Column:
    """Detections left after suppression, in order of place.

    One that lies inside another goes (of equal intervals the one of lower priority), which a running maximum over
    the sorted detections finds. Those left are swept from left to right: one that overlaps the last kept takes its
    place if its priority is higher, else it goes, so one that has gone suppresses nothing after it. A sweep begins anew
    where nothing overlaps, so its arrays are as long as a chain of overlaps.
    """
    ordered = F.transform(F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["stop"]).alias("back"), d["rank"].alias("rank"), d.alias("d")))), lambda x: x["d"])

    def outer(o: Column) -> Column:
        tops = running(F.transform(o, lambda d: d["stop"]), lambda a, b: F.greatest(a, b))
        return let(tops, lambda top: F.filter(o, lambda d, i: (i == 0) | (d["stop"] > F.get(top, i - 1))))

    def apart(k: Column) -> Column:
        begin = F.struct(F.array().cast(f"array<{DETECTION}>").alias("kept"), F.lit(None).cast(DETECTION).alias("last"))

        def step(acc: Column, d: Column) -> Column:
            last, kept = acc["last"], acc["kept"]
            beside = F.struct(F.when(last.isNull(), kept).otherwise(F.array_append(kept, last)).alias("kept"), d.alias("last"))
            return F.when(last.isNull() | (last["stop"] <= d["start"]), beside).when(d["rank"] < last["rank"], F.struct(kept.alias("kept"), d.alias("last"))).otherwise(acc)

        return F.aggregate(k, begin, step, lambda acc: F.when(acc["last"].isNull(), acc["kept"]).otherwise(F.array_append(acc["kept"], acc["last"])))

    def swept(k: Column) -> Column:
        # After the first step stops rise with starts, so only neighbours tell where a chain of overlaps ends.
        opens = F.filter(F.transform(k, lambda d, i: F.when((i == 0) | (F.get(k, i - 1)["stop"] <= d["start"]), i)), lambda i: i.isNotNull())
        chains = let(opens, lambda at: F.transform(at, lambda b, j: F.slice(k, b + 1, F.coalesce(F.get(at, j + 1), F.size(k)) - b)))
        return F.flatten(F.transform(chains, apart))

    return let(let(ordered, outer), swept)


def base_places(ws: Column, phrase: str) -> Column:
    """Where the phrase's words stand consecutively, counted in words from 0."""
    parts = phrase.split(" ")
    spots = F.sequence(F.lit(0), F.size(ws) - len(parts))

    def here(i: Column) -> Column:
        out = F.get(ws, i) == parts[0]
        for k, w in enumerate(parts[1:], 1):
            out = out & (F.get(ws, i + k) == w)
        return out

    return F.when(F.size(ws) < len(parts), F.array().cast("array<int>")).otherwise(F.filter(spots, here))


def scanned(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), signatures: Sequence[Rule] | None = None, phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """keep columns, n_words, n_base, first_word, last_word, base_labels, labels, score and the detections.

    Whole texts, one projection, no shuffle and no Python on the executors. A null text is empty; empty texts have no
    words, empty labels and score 0. Only texts that hold a gate word are matched against base phrases and rules. Rows
    are judged one by one, so repeated rows get equal results, and detections of equal place and rank go to the rule that
    stands first; an empty table gives an empty result. Other columns than text and `keep` are not read and cannot clash.
    A very long text is one task's; its time grows with n log n in the n places found
    in it, but with the square of the length of a chain of overlapping ones.
    score is the weight of the strongest detection left (0.6 for a bare name up to 1.0 for licence text; base
    phrases alone count 0.6).
    """
    signatures = rules() if signatures is None else signatures
    lowered = docs.select(*keep, F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER).alias("_t"))
    spaced = lowered.select(*keep, F.btrim(F.regexp_replace("_t", BREAKS, " ")).alias("_n"))
    # Gates are sought in the spaced words, as rules are: a line break between two words closes none.
    spaced = spaced.withColumn("_gate", _any([F.contains("_n", F.lit(g)) for g in GATES]))
    padded = F.concat(F.lit(" "), F.col("_n"), F.lit(" "))
    no_place, none = F.array().cast("array<int>"), F.array().cast(f"array<{DETECTION}>")
    held = [F.contains("_n", F.lit(p)) for p, _ in phrases]
    by_phrase = let(F.split("_n", " ", -1), lambda ws: F.array(*[base_places(ws, p) for p, _ in phrases]))
    places = F.when(F.col("_gate") & _any(held), by_phrase).otherwise(F.array(*[no_place for _ in phrases]))
    found = F.when(F.col("_gate"), let(padded, lambda n: resolved(detections(n, signatures)))).otherwise(none)
    counted = spaced.select(
        *keep,
        F.when(F.col("_n") == "", 0).otherwise(F.length("_n") - F.length(F.replace(F.col("_n"), F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"),
        places.alias("_p"),
        found.alias("detections"),
    )
    every = F.flatten("_p")
    base = F.array_compact(F.array(*[F.when(F.size(F.get("_p", F.lit(i))) > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]))
    base = F.array_sort(F.array_distinct(base))
    both = F.array_sort(F.array_distinct(F.concat(base, F.transform("detections", lambda d: d["label"]))))
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["weight"])), F.lit(0.0))
    n_base = F.size(every)
    return counted.select(
        *keep, "n_words", n_base.cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"), F.greatest(best, F.when(n_base > 0, WEIGHTS["name"]).otherwise(0.0)).alias("score"), "detections",
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents")).drop("detections")


QUERIES = {"op5_licenses": op5_licenses}
SQL: dict[str, str] = {}
