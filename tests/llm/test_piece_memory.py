"""Encoding holds the numbers of a portion of a batch, not of all its rows."""

import pyarrow as pa

from locus.llm import pieces


def test_batches_are_encoded_in_portions(spark, monkeypatch):
    assert [(p.start, p.stop) for p in pieces.portions(pa.array(["aaaa", None, "", "bb", "cc", "ddddddddd", "e"]), 6)] == [(0, 4), (4, 5), (5, 6), (6, 7)]
    assert not list(pieces.portions(pa.array([], pa.string())))
    rows, sizes = [(k, f"word {k} of {k * k}" * (k % 7) or None) for k in range(300)], []
    plain = pieces._pieces
    monkeypatch.setattr(pieces, "_pieces", lambda e, t: sizes.append(sum(len(x.as_py() or "") for x in t)) or plain(e, t))
    monkeypatch.setattr(pieces.portions, "__defaults__", (1000,))
    docs = spark.createDataFrame(rows, "doc_id int, text string")

    class Rows:
        """Runs the function that the query hands to Spark here."""

        schema = spark.createDataFrame([], "k int").schema

        def select(self, *_):
            return self

        def mapInArrow(self, run, kind):
            return list(run(iter([pa.RecordBatch.from_pydict({"k": [r[0] for r in rows], "t": [r[1] or "" for r in rows]})])))

    taken = [r for b in pieces.digests(Rows()) for r in b.to_pylist()]
    assert max(sizes) <= 1000 and len(sizes) > 5
    monkeypatch.undo()
    assert sorted(map(str, (tuple(r.values()) for r in taken))) == sorted(map(str, map(tuple, pieces.digests(docs).collect())))
