"""Periodic runs, repaired conversations and boosted trees against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from locus.llm import boosting, conversations, periodic
from tests.llm.test_corpus import awkward, documents, empty
from tests.oracle import same

SF = "/root/testdata/sf0.001"

# 11: periodic runs


def plain_runs(w):
    """Every period at every place."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and w[e] == w[e + q]:
                e += 1
            if e > s and e + q - s >= max(6, 4 * q):
                out.setdefault((s, e + q - s), q)
            s = e + 1
    return sorted((s, length, q) for (s, length), q in out.items())


def random_text(rng):
    n = rng.choice([0, 1, 5, 6, 7, 20, 60, 200, 500])
    letters = rng.choice([1, 2, 3, 50])
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 10 else 0):
        p, s, size = rng.randrange(1, n // 4 + 1), rng.randrange(n), rng.randrange(n)
        for i in range(s + p, min(n, s + size)):
            w[i] = w[i - p]
    return " ".join(f"w{x}" for x in w)


@pytest.mark.parametrize(("long", "section"), [(1 << 20, 1 << 16), (40, 16)])
def test_runs_by_brute_force(spark, long, section):
    """Whole texts, and texts cut into sections of which the higher octaves have one for each tile."""
    rng = random.Random(7)
    texts = [random_text(rng) for _ in range(300)]
    docs = documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in periodic.analysed(docs, long=long, section=section).collect()}
    found = 0
    for i, t in enumerate(texts):
        w = t.split()
        want = plain_runs(w)
        assert [tuple(r) for r in got[i].runs] == want, t
        gone = {k for s, length, q in want for k in range(s + q, s + length)}
        assert got[i].collapsed == " ".join(x for k, x in enumerate(w) if k not in gone) and got[i].n_words == len(w)
        assert got[i].plain_sha256 == hashlib.sha256(" ".join(w).encode()).hexdigest()
        found += len(want)
    assert found > 200


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        for i, z in enumerate(periodic.z_function(s)[1:], 1):
            assert s[i : i + z] == s[:z] and (i + z == len(s) or s[i + z] != s[z])


def test_equal_words_take_linear_time_a_tile():
    n = 50_000
    which, per, start, end = periodic.fragments(np.zeros(n, np.int32), [periodic.Section(0, 0, n, periodic.octaves(n), 0, n)])
    assert len(per) < n * n.bit_length() and start[per == 1].min() == 0 and end[per == 1].max() == n


def test_runs_oracle(spark):
    same(spark, periodic.op11_periodic_runs, periodic.SQL["op11_periodic_runs"], SF)


def test_greatest_run_by_exact_ratio(spark):
    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"
    data = [([(0, 12, 3), (5, 8, 2), (9, 4, 1)],), ([(0, 3000000001, 750000000), (1, 12, 3)],), ([],), ([(0, 13, 3), (40, 26, 6)],)]
    got = [r.b and tuple(r.b) for r in spark.createDataFrame(data, f"r {kind}").select(periodic.greatest(F.col("r")).alias("b")).collect()]
    assert got == [(0, 12, 3), (0, 3000000001, 750000000), None, (0, 13, 3)]


def test_runs_of_awkward_rows(spark):
    docs = awkward(spark)
    got = periodic.analysed(docs, keep=("doc_id", "size", "rank")).collect()
    assert len(got) == docs.count() and {r.size for r in got} == {"clash"}
    by = {r.doc_id: r for r in got}
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[1].collapsed == "" and by[1].runs == []
    assert [tuple(r) for r in by[4].runs] == [(0, 40000, 10)] and by[4].collapsed == "the word and other words of a very long text"
    assert periodic.analysed(empty(spark)).count() == 0
    assert {r.doc_id: r.text for r in periodic.planted(docs).collect()}[1] is None


# 12: conversations


def every_repair(codes):
    """All edit sequences with up to two inserts in a gap, as strings."""
    ends = []

    def walk(i, state, cost, audit, run):
        if i == len(codes) and state in (conversations.START, conversations.ASSISTANT):
            ends.append((cost, audit))
        if run < 2:
            for role, to in conversations.NEXT[state].items():
                if role != "s":
                    walk(i, to, cost + 5, audit + "I", run + 1)
        if i < len(codes):
            kind, fault = divmod(conversations.CODES.index(codes[i]), 4)
            walk(i + 1, state, cost + 2, audit + "D", 0)
            for role, to in conversations.NEXT[state].items():
                if fault < 2 and "suax"[kind] == role:
                    walk(i + 1, to, cost + 5 * fault, audit + "K", 0)
                if fault < 2 and role != "s":
                    walk(i + 1, to, cost + 1 + 5 * fault, audit + "R", 0)

    walk(0, conversations.START, 0, "", 0)
    return min(ends)


def test_least_integer_is_the_cheapest_and_first_audit():
    rng = random.Random(3)
    for _ in range(250):
        codes = "".join(rng.choice(conversations.CODES) for _ in range(rng.randrange(6)))
        want = every_repair(codes)
        assert conversations.best_audit(conversations.block_paths(codes, 0)) == want
        cut = rng.randrange(len(codes) + 1)
        then = [conversations.block_paths(codes[cut:], s) for s in range(4)]
        assert conversations.best_audit(conversations.joined(conversations.block_paths(codes[:cut], 0), conversations.unpacked(conversations.packed(then)))) == want


def test_inserts_are_weighed_like_other_edits(monkeypatch):
    """With cheap inserts they are taken, and blocks still agree with the whole."""
    monkeypatch.setattr(conversations, "INSERT", 1)
    paths = conversations.block_paths("EE", 0)  # two sound user rows
    assert conversations.best_audit(paths) == (1, "KR")  # against KIKI at 2
    assert conversations.plan_of("EE", "KIKI") == "K,AK,A"


def conversation_rows(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


def test_conversations_oracle(spark):
    same(spark, conversations.op12_conversations, conversations.SQL["op12_conversations"], SF)


def test_blocks_agree_with_whole_conversations(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = rows.unionByName(rows.where("conv_id % 3 = 0").withColumns({"conv_id": F.lit(-1).cast("long"), "turn": F.col("conv_id") * 20 + F.col("turn")}))
    damaged = conversations.damaged(rows)
    whole, cut = (sorted(map(tuple, conversations.repaired(damaged, block=b).collect())) for b in (10_000, 3))
    assert whole == cut and len(whole) == 101


def test_awkward_conversations(spark):
    """Nulls in any column, ties, repeated rows, roles of other kinds, a conversation of which damage leaves nothing."""
    case = lambda *at: zlib.crc32("{}:{}".format(*at).encode()) % 20
    gone = next(i for i in range(1000) if case(i, 0) == 0)
    sound = next(i for i in range(1000) if i != gone and min(case(i, " "), case(i, 5), case(i, 9)) > 4)
    data = [(None, None, None, None), (None, 1, "user", "Hi."), (gone, 0, "user", "gone."), (sound, None, "tool", "x."), (sound, None, "", "y."), (sound, 5, "user", "tie."), (sound, 5, "user", "tie."), (sound, 5, "assistant", "tie."), (sound, 9, None, "\t\n"), (1008, 3, "user", "no end")]
    df = conversation_rows(spark, data).withColumn("rank", F.lit("clash"))
    for block in (64, 1):
        got = {r.conv_id: r for r in conversations.repaired(conversations.damaged(df), block=block).collect()}
        assert set(got) == {None, gone, sound, 1008}
        zero = got[gone]
        assert (zero.gaps, zero.cost, zero.audit, zero.repaired_sha256) == (0, 0, "", hashlib.sha256(b"").hexdigest())
        ours = got[sound]  # rows: "", tool, assistant, user, user, none by turn, role and text
        assert (ours.gaps, ours.blank, ours.duplicate, ours.truncated, ours.illegal, ours.cost, ours.audit) == (3, 1, 1, 0, 4, 8, "RRRRDD")
    assert conversations.repaired(conversations.damaged(conversation_rows(spark, []))).count() == 0


def test_repaired_lines(spark):
    rows = [[("system", "Be kind."), ("user", "Hello?"), ("user", "Hello?"), ("user", "And then."), ("user", ""), ("assistant", "cut")]]
    df = spark.createDataFrame([(1, t, [r]) for t, r in enumerate(rows[0])], "conv_id long, turn long, rows array<struct<role:string,text:string>>")
    got = conversations.repaired(df).first()
    assert (got.blank, got.duplicate, got.truncated, got.illegal, got.cost, got.audit) == (1, 1, 1, 3, 7, "KKDRDD")
    assert got.repaired_sha256 == hashlib.sha256(b"system:Be kind.\nuser:Hello?\nassistant:And then.").hexdigest()


# 13: boosted trees


def test_histogram_splits_by_plain_loops():
    rng = np.random.default_rng(5)
    binned, node, g, h = rng.integers(0, 6, (80, 3)), rng.integers(0, 2, 80), rng.normal(size=80), rng.uniform(0.1, 0.25, 80)
    feature, cut, gain = boosting.best_splits(binned, node, 2, g, h, 6, 1.0, 0.5)
    for k in range(2):
        best = 0.0
        for f in range(3):
            for b in range(6):
                left, right = (node == k) & (binned[:, f] <= b), (node == k) & (binned[:, f] > b)
                if h[left].sum() >= 0.5 and h[right].sum() >= 0.5:
                    own = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, right)) - g[node == k].sum() ** 2 / (h[node == k].sum() + 1)
                    best = max(best, own)
        left, right = (node == k) & (binned[:, feature[k]] <= cut[k]), (node == k) & (binned[:, feature[k]] > cut[k])
        assert gain[k] == pytest.approx(best) and gain[k] == pytest.approx(sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, right)) - g[node == k].sum() ** 2 / (h[node == k].sum() + 1))


def test_traversal_by_a_walk():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    trees = boosting.trained(x, y, rounds=20, depth=3)
    for row, m in zip(x[:50], trees.margin(x[:50]), strict=True):
        total = trees.base
        for t in range(20):
            at = 0
            for _ in range(3):
                at = 2 * at + (2 if row[trees.feature[t, at]] > trees.threshold[t, at] else 1)
            total += trees.value[t, at - 7]
        assert m == pytest.approx(total)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95


def test_trees_without_labels_or_with_one_class():
    none = boosting.trained(np.zeros((0, 3)), np.zeros(0))
    assert none.score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    one = boosting.trained(np.ones((9, 3)), np.ones(9)).score(np.zeros((1, 3)))
    assert 0.9 < one[0] < 1 and len(none.score(np.zeros((0, 3)))) == 0


def test_held_out_accuracy(spark):
    """Labels of rows that training never saw; and a fit takes nothing from them."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null")
    got = boosting.op13_quality_classifier(spark, sf).join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "quality").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    for label in (0, 1):
        own = [r.predicted == label for r in held if r.quality == label]
        assert len(own) > 100 and sum(own) >= 0.98 * len(own)


def test_training_ignores_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("quality", F.when(boosting.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = boosting.fitted(docs, labels), boosting.fitted(docs, turned)
    assert (a.value == b.value).all() and (a.threshold == b.threshold).all()
    small = boosting.fitted(docs, labels, most=50)
    assert small.value.shape == a.value.shape and (small.value != a.value).any()


def test_scores_of_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1), (99, 0), (6, 7)], "doc_id long, quality int")
    trees = boosting.fitted(docs, labels)
    got = boosting.scored(docs, trees).collect()
    assert len(got) == docs.count() and len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert boosting.scored(empty(spark), trees).count() == 0
    assert boosting.fitted(empty(spark), labels).score(np.zeros((1, len(boosting.FEATURES)))).tolist() == [0.5]
