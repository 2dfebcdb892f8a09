"""URL filters: host and path rules, and logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))

#: What URL filters commonly name when they block, and ordinary subjects of sites, from general knowledge: fixed values.
BLOCK_WORDS = (
    "casino poker roulette blackjack jackpot betting slots bingo lottery sportsbook viagra cialis pharmacy pills tramadol xanax steroids "
    "slimming porn xxx nude escort cams hentai erotic fetish swingers warez torrent crack keygen serials nulled cheats malware phishing "
    "spyware ransomware payday loans forex doubler giveaway prizes sweepstakes replica counterfeit knockoff freegift clickbait adserver "
    "popunder doorway linkfarm backlinks spam traffic-bot bulkmail getrich miracle"
).split()
ALLOW_WORDS = (
    "library university museum school kindergarten newspaper weather recipes garden travel history science music theatre hospital clinic "
    "council parliament research journal books poetry football cycling railway bridges astronomy biology chemistry physics mathematics "
    "geology forest rivers mountains bakery kitchen crafts knitting pottery architecture films photography languages dictionary "
    "encyclopedia documentation developers opensource volunteers charity choir orchestra farming beekeeping sailing hiking birds"
).split()
#: Hosts and paths around a labelled word and a second of its class. Both classes use all of them alike.
HOSTS = ("www.{a}.com", "{a}-{b}.org", "the{a}.net", "{a}.{b}world.com", "shop.{a}{b}.info", "my-{a}.co.uk")
PATHS = ("/", "/index.html", "/{b}/{a}", "/blog/2021/{b}.html", "/view.php", "/en/about-{a}")


def seed_table(words: Sequence[Sequence[str]] = (ALLOW_WORDS, BLOCK_WORDS)) -> list[tuple[str, int]]:
    """The labelled table that the model is trained from: (url, 1 to block, 0 to allow), two rows for each word."""
    rows = []
    for label, names in enumerate(words):
        for i, name in enumerate(names):
            for k in (0, 1):
                other = names[(i + 7 * k + 3) % len(names)]
                host, path = HOSTS[(i + 3 * k) % len(HOSTS)], PATHS[(2 * i + k) % len(PATHS)]
                rows.append(("https://" + (host + path).format(a=name, b=other), label))
    return rows


def host_path(url: Column) -> tuple[Column, Column]:
    """Host after the first :// with A-Z lower-cased, and the path; both empty for null or no ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as struct(rule, verdict), or null; equal lengths go to the smaller text."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def parsed(pages: DataFrame, url: str = "url", rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    host, path = host_path(F.col(url))
    split = pages.select(*keep, host.alias("host"), path.alias("path"))
    return split.withColumn("_m", matched(F.col("host"), F.col("path"), rules)).select(*keep, "host", "path", F.col("_m.rule").alias("rule"), F.col("_m.verdict").alias("_verdict"))


def _windows(texts: Sequence[str], salt: int, lengths: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, hash) of all character n-grams of ^text$, all texts at once."""
    codes = np.frombuffer("".join(f"^{t}$" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(owner))  # characters from here to the text's end
    for n in lengths:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, salt * 31 + n, np.uint64)
        for k in range(n):
            h = (h ^ codes[k : len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inside = left[: len(h)] >= n
        yield owner[: len(h)][inside], h[inside]


def features(hosts: Sequence[str], paths: Sequence[str], bits: int, lengths: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot): distinct hashed slots of the character n-grams of each row's host and path, host and path apart."""
    found = [(o << bits) | (h >> np.uint64(64 - bits)).astype(np.int64) for salt, texts in enumerate((hosts, paths)) for o, h in _windows(texts, salt + 1, lengths)]
    both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return both >> bits, both & (1 << bits) - 1


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float
    bits: int
    lengths: tuple[int, ...]

    def scores(self, hosts: Sequence[str], paths: Sequence[str], most: int = 1 << 18) -> np.ndarray:
        """The probabilities of block, in slices of about `most` characters."""
        out, start, size = [], 0, 0
        for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
            if i > start and size + len(h) + len(p) > most:
                out.append(self._slice(hosts[start:i], paths[start:i]))
                start, size = i, 0
            size += len(h) + len(p)
        out.append(self._slice(hosts[start:], paths[start:]))
        return np.concatenate(out)

    def _slice(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        row, slot = features(hosts, paths, self.bits, self.lengths)
        total, count = np.bincount(row, self.weights[slot], len(hosts)), np.bincount(row, minlength=len(hosts))
        return 1 / (1 + np.exp(-(self.bias + total / np.sqrt(np.maximum(1, count)))))


def trained(rows: Sequence[tuple[str, str, int]], bits: int = 16, lengths: tuple[int, ...] = (3, 4, 5), rounds: int = 200, rate: float = 1.0, ridge: float = 1e-4, prior: float = 0.3) -> UrlModel:
    """Logistic regression by full-batch gradient descent over (host, path, label) rows.

    The classes are weighted so that block has the share `prior`: of a url that shares nothing with the table, allow is
    the likelier.
    """
    weights, bias = np.zeros(1 << bits), float(np.log(prior / (1 - prior)))
    if not rows:
        return UrlModel(weights, bias, bits, lengths)
    owner, slot = features([h for h, *_ in rows], [p for _, p, _ in rows], bits, lengths)
    norm = np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(rows))))
    y = np.array([label for *_, label in rows], float)
    share = np.where(y == 1, prior / max(1, y.sum()), (1 - prior) / max(1, (1 - y).sum()))
    for _ in range(rounds):
        z = bias + np.bincount(owner, weights[slot], len(rows)) / norm
        miss = (1 / (1 + np.exp(-z)) - y) * share
        weights -= rate * 10 * (np.bincount(slot, (miss / norm)[owner], 1 << bits) + ridge * weights)
        bias -= rate * miss.sum()
    return UrlModel(weights, bias, bits, lengths)


def labelled(seeds: Sequence[tuple[str, int]]) -> list[tuple[str, str, int]]:
    """(host, path, label) of a labelled URL table, split as host_path() does."""
    rows = []
    for address, label in seeds:
        rest = address.partition("://")[2].split("#")[0].split("?")[0]
        host, slash, path = rest.partition("/")
        rows.append((host.translate(str.maketrans(UPPER, LOWER)), slash + path, label))
    return rows


def judged(pages: DataFrame, url: str = "url", rules: Sequence[Rule] = RULES, seeds: Sequence[tuple[str, int]] | None = None, threshold: float = 0.5, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Rules decide where one fits, else the model: keep columns, host, path, rule, verdict, score.

    The model is trained on the driver from the labelled table alone (seed_table() by default), which is small by
    contract and independent of the pages. score is the probability of block, null where a rule decides. Null urls and
    urls without :// have empty host and path and go to the model like any other; with an empty labelled table it
    allows. Rows are judged one by one: repeated rows, ties and hot hosts cost no shuffle, an empty table gives an empty
    result, a very long url is scored whole by one task, and only url and `keep` are read, so other names cannot clash.
    """
    spark = pages.sparkSession
    base = parsed(pages, url, rules, keep)
    model = spark.sparkContext.broadcast(trained(labelled(seed_table() if seeds is None else seeds)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            free = np.flatnonzero(b["_verdict"].is_null().to_numpy(zero_copy_only=False))
            score = np.full(b.num_rows, np.nan)
            if len(free):
                rest = b.take(pa.array(free))
                score[free] = model.value.scores(rest["host"].to_pylist(), rest["path"].to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score, pa.float64(), from_pandas=True)], names=[*b.schema.names, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    verdict = F.coalesce(F.col("_verdict"), F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return base.mapInArrow(scored, f"{kinds}, score double").select(*keep, "host", "path", "rule", verdict.alias("verdict"), "score")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


QUERIES = {"op2_url_filters": op2_url_filters}
SQL: dict[str, str] = {}
