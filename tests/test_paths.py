"""Paths of linked rearrangements against the walk over all edges."""

import random

from locus.operators import sv

KIND = "from_sv string, to_sv string, from_turn string, to_turn string, first_size long, sizes string"
PLACES = "sv_id string, chr1 string, pos1 long, dir1 string, chr2 string, pos2 long, dir2 string"


def variants(names):
    return [(n, "c", 10 * i, "+", "d", 10 * i + 5, "-") for i, n in enumerate(names)]


def walked(edges, svs):
    ends = {n: (f"{c1}:{p1}:{d1}", f"{c2}:{p2}:{d2}") for n, c1, p1, d1, c2, p2, d2 in svs}
    way = lambda n, turn: "|".join(ends[n] if turn == "+" else ends[n][::-1])
    rows = [{"from_sv": a, "to_sv": b, "from_turn": s, "to_turn": t, "size": n, "reads": r, "head": way(a, s), "tail": way(b, t)} for a, b, s, t, n, r in sorted(edges)]
    return sorted(tuple(r) for r in sv._laid(rows))


def linked(spark, edges, svs):
    got = sv.link_rearrangements(spark.createDataFrame(edges, KIND), spark.createDataFrame(svs, PLACES)).select("path", "step", "sv_id", "turn", "size", "reads").collect()
    return sorted((tuple(r) for r in got), key=lambda x: tuple((v is None, v) for v in x))


def test_random_graphs_like_the_walk(spark):
    """Paths, rings, turned edges and branches, many components at once."""
    rng = random.Random(31)
    svs, edges = [], set()
    for g in range(60):
        names = [f"g{g:02}v{i}" for i in range(rng.randrange(1, 9))]
        svs += names
        if g % 3 == 0:  # a path or ring that is turned here and there
            order, ways = rng.sample(names, len(names)), [rng.choice("+-") for _ in names]
            for k in range(len(order) - (g % 2)):
                a, b = k, (k + 1) % len(order)
                if a == b and len(order) > 1:
                    continue
                e = (order[a], order[b], ways[a], ways[b])
                flip = {"+": "-", "-": "+"}
                edges.add(e if rng.random() < 0.5 else (e[1], e[0], flip[e[3]], flip[e[2]]))
        else:
            for _ in range(rng.randrange(1, 8)):
                edges.add((rng.choice(names), rng.choice(names), rng.choice("+-"), rng.choice("+-")))
    rows = [(*e, i, str(i)) for i, e in enumerate(sorted(edges))]
    want = sorted(walked(rows, variants(svs)), key=lambda x: tuple((v is None, v) for v in x))
    assert linked(spark, rows, variants(svs)) == want
    assert len({w[0] for w in want}) > 60


def test_long_paths_and_rings_take_log_rounds(spark, monkeypatch):
    """A path of 400 edges and a ring of 60: doubling, no component in one task."""
    n, rounds = 400, []
    plain = sv.checkpointed
    monkeypatch.setattr(sv, "checkpointed", lambda df: rounds.append(1) or plain(df))
    monkeypatch.setattr(sv, "_laid", lambda edges: 1 / 0)
    names = [f"p{i:05}" for i in range(n + 1)] + [f"r{i:03}" for i in range(60)]
    edges = [(f"p{i:05}", f"p{i + 1:05}", "+", "+", i, "x") for i in range(n)] + [(f"r{i:03}", f"r{(i + 1) % 60:03}", "+", "+", i, "x") for i in range(60)]
    got = linked(spark, edges, variants(names))
    path = sorted((r[1], r[2]) for r in got if r[2].startswith("p"))
    assert path == [(i, f"p{i:05}") for i in range(n + 1)]
    assert len([r for r in got if r[2].startswith("r")]) == 61 and len(rounds) < 70


def test_a_choice_of_edges(spark):
    """Two edges lead on from one variant: the first in order is taken, the other is a path of its own."""
    svs = variants(["a", "b", "c", "d"])
    edges = [("a", "b", "+", "+", 1, "1"), ("b", "d", "+", "+", 2, "2"), ("b", "c", "+", "+", 3, "3")]
    got = linked(spark, edges, svs)
    assert [(r[0], r[2]) for r in got] == [("a:a>b", "a"), ("a:a>b", "b"), ("a:a>b", "c"), ("b:b>d", "b"), ("b:b>d", "d")]
    assert linked(spark, [], svs) == []
