import random

import pytest

from locus.operators import elements
from locus.operators.intervals import union_of_spans

KIND = "contig string, strand string, start long, `end` long, q_start long, q_end long, n_match long, aligned long"


def walk(found, minus):
    """Chains of one contig's strand, by one walk over all hits."""
    chains = []
    for h in sorted(found):
        c = chains[-1] if chains else None
        if c and h[0] - c[-1][1] <= 60 and h[1] - c[0][0] <= 400 and (h[3] <= min(x[2] for x in c) + 40 if minus else h[2] >= max(x[3] for x in c) - 40):
            c.append(h)
        else:
            chains.append([h])
    return chains


@pytest.mark.parametrize("step", [3, 25, 120, 900])
def test_chains_cross_sections(spark, monkeypatch, step):
    """Sections of four spans, hits in one island or with whole sections between them: the chains of one walk."""
    monkeypatch.setattr(elements, "SECTION", 1)
    rng, hits, want = random.Random(step), [], []
    for strand in "+-":
        at, found = 0, set()
        for _ in range(700):
            at += rng.randrange(2 * step)
            q = (at if rng.random() < 0.98 else at + rng.randrange(400)) % 500
            q = 500 - q if strand == "-" else q
            found.add((at, at + 20 + rng.randrange(60), q, q + 30 + rng.randrange(30)))
        hits += [("c", strand, *h, h[1] - h[0] - 1, h[1] - h[0]) for h in found]
        for c in walk(found, strand == "-"):
            covered, lo, hi = sum(b - a for a, b in union_of_spans((x[2], x[3]) for x in c)), c[0][0], max(x[1] for x in c)
            if covered >= 50 and 60 <= hi - lo <= 400:
                want.append(("c", strand, lo, hi, covered, len(c), round(sum(x[1] - x[0] - 1 for x in c) / sum(x[1] - x[0] for x in c), 4)))
    got = elements.chain_hsps(spark.createDataFrame(hits, KIND), 500, max_gap=60, tolerance=40, min_cov=0.1, min_span=60, max_span=400)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and (want or step == 900)


def test_a_contig_without_gaps_is_not_one_group(spark):
    hits = spark.range(40_000).selectExpr("'c' contig", "'+' strand", "id * 100 start", "id * 100 + 90 as `end`", "id * 100 % 6000 q_start", "id * 100 % 6000 + 90 q_end")
    groups = []
    plain = elements.stored
    elements.stored = lambda df: groups.append(plain(df)) or groups[-1]
    try:
        assert elements.chain_hsps(hits, 6000).count() == 667  # the last one has 40 hits of 60
    finally:
        elements.stored = plain
    assert groups[0].select("section").distinct().count() == 8
