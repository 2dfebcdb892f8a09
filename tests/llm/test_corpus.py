"""The corpus operators against brute force, exact round trips and the libraries they must agree with."""

import base64
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from locus.llm import common, jpeg, licenses, media, mixing, piece_model, pieces, quality, simhash, suffixes, token_counts, urls, warc
from locus.llm.license_rules import GATES, WEIGHTS, rules
from tests.oracle import same

SF = "/root/testdata/sf0.001"
MODEL = pieces._model_path()


def documents(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")


def awkward(spark):
    """Nulls everywhere, empty and blank texts, repeated rows, ties, a long text, and a clashing extra column."""
    long = "the word and other words of a very long text " * 4000
    data = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", None, 4), (4, long, "en", "s", len(long)), (4, long, "en", "s", len(long)), (None, "a b c", None, "s", 5), (None, None, None, None, None), (5, "tie one two three", "de", "t", 17), (6, "tie one two three", "de", "t", 17)]
    return documents(spark, data).withColumn("size", F.lit("clash")).withColumn("rank", F.lit(1)).withColumn("rk", F.lit("x")).withColumn("fp", F.lit(0))


def empty(spark):
    return documents(spark, [])


# every operator on awkward and empty tables


def run_all(docs):
    yield "simhash", simhash.grouped(docs)
    yield "dedup", simhash.deduplicated(docs)
    yield "suffix", suffixes.deduped(docs, F.col("doc_id"))
    yield "cut", suffixes.without_repeats(docs)
    yield "quality", quality.measured(docs)
    yield "filter", quality.filtered(docs)
    yield "mixing", mixing.draws(docs.select("doc_id", "source", common.n_words(F.col("text")).alias("size")))
    yield "mixed", mixing.mixed(docs)
    yield "pieces", pieces.digests(docs)
    yield "spans", pieces.encoded(docs)
    yield "tokens", token_counts.counted(docs)
    yield "licenses", licenses.scanned(docs)
    yield "media", media.features(media.stored(docs))
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("text").alias("html"), "size", "rank")
    yield "warc", warc.read(warc.archived(pages))
    yield "urls", urls.judged(pages)


def test_awkward_rows(spark):
    docs = awkward(spark)
    counts = {name: len(df.collect()) for name, df in run_all(docs)}
    n = docs.count()
    for name in ("simhash", "suffix", "cut", "quality", "mixing", "pieces", "spans", "tokens", "licenses", "media", "warc", "urls"):
        assert counts[name] == n, name
    assert counts["dedup"] < n


def test_empty_tables(spark):
    assert {name: len(df.collect()) for name, df in run_all(empty(spark).withColumn("size", F.lit(1)).withColumn("rank", F.lit(1)))} == dict.fromkeys([n for n, _ in run_all(empty(spark).withColumn("size", F.lit(1)).withColumn("rank", F.lit(1)))], 0)


# 1: near duplicates


@pytest.mark.parametrize("cut", [simhash.FEW_ANCHORS, simhash.MANY_ANCHORS])
def test_anchors_meet_every_near_pair(cut):
    """Of pairs that differ in up to 4 bits some table holds the visitor at its partner's home, whichever is at home."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 400)
    y = x.copy()
    for i in range(400):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            y[i] = int(np.uint64(y[i]).view(np.int64)) ^ (1 << int(bit) if bit < 63 else -(1 << 63))
    met = [set(), set()]
    for (vx, width), (vy, _) in zip(cut.values(x), cut.values(y), strict=True):
        ix, ax, hx = simhash.anchors(vx, width)
        iy, ay, hy = simhash.anchors(vy, width)
        assert sorted(ix[hx]) == list(range(400))
        all_x, all_y = set(zip(ix.tolist(), ax.tolist(), strict=True)), set(zip(iy.tolist(), ay.tolist(), strict=True))
        met[0] |= {i for i, a in set(zip(ix[hx].tolist(), ax[hx].tolist(), strict=True)) & all_y}
        met[1] |= {i for i, a in set(zip(iy[hy].tolist(), ay[hy].tolist(), strict=True)) & all_x}
    assert met == [set(range(400))] * 2


def test_cuts_that_could_lose_pairs_are_refused():
    for blocks, join in ((2, 1), (4, 2), (3, 2), (6, 1)):
        with pytest.raises(ValueError, match="pair"):
            simhash.Cut(blocks, join)


def test_replicas_of_a_fingerprint_are_constant():
    """Rows for each fingerprint do not depend on how many there are."""
    rng = np.random.default_rng(4)
    for cut, most in ((simhash.FEW_ANCHORS, 45), (simhash.MANY_ANCHORS, 240)):
        for n in (1_000, 20_000):
            assert sum(len(simhash.anchors(v, w)[0]) for v, w in cut.values(rng.integers(0, 1 << 62, n))) / n < most


@pytest.mark.parametrize("cut", [simhash.FEW_ANCHORS, simhash.MANY_ANCHORS])
def test_links_of_both_cuts(spark, cut):
    rng = np.random.default_rng(5)
    fps = {int(v) for v in rng.integers(-(1 << 62), 1 << 62, 60)}
    for f in list(fps):
        for _ in range(rng.integers(0, 4)):
            for bit in rng.choice(62, rng.integers(1, 6), replace=False):
                f ^= 1 << int(bit)
            fps.add(f)
    fps = sorted(fps)
    found = {r.node: r.root for r in common.components(simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), cut)).collect()}
    assert [found.get(f, f) for f in fps] == closure(fps, [f & (1 << 64) - 1 for f in fps])


def test_fingerprint_by_its_definition(spark):
    """Votes over every shingle, in plain loops."""
    import xxhash

    def plain(text):
        ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        shingles = [" ".join(ws[i : i + 4]) for i in range(len(ws) - 3)] or ([" ".join(ws)] if ws else [])
        votes = [0] * 64
        for h in (xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles):
            for k in range(64):
                votes[k] += h >> k & 1
        return sum(1 << k for k in range(64) if 2 * votes[k] > len(shingles))

    texts_ = [d.text for d in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect()]
    for t in [*texts_, None, "", " \n", "A b", "É A", "a\x0bb\x1fc d e", "x " * 70_000]:
        assert simhash.fingerprint(t) == plain(t)


def closure(ids, fps):
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in zip(ids, fps, strict=True):
        for j, b in zip(ids, fps, strict=True):
            if (a ^ b).bit_count() <= simhash.NEAR:
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return [find(i) for i in ids]


@pytest.mark.parametrize("cell", [5, 1024])
def test_components_by_brute_force(spark, cell, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", cell)
    got = simhash.op1_simhash(spark, SF).collect()
    ids, fps = [r.doc_id for r in got], [int(r.fingerprint, 16) for r in got]
    assert [r.component_id for r in got] == closure(ids, fps)


def test_fingerprint_hashes_like_the_contract(spark):
    assert spark.sql("select xxhash64('a b c d') h").first().h == np.array([simhash.fingerprint("A  b\nC d")], np.uint64).view(np.int64)[0]
    assert simhash.fingerprint(None) == simhash.fingerprint("  ") == 0


def test_one_document_stays(spark):
    docs = documents(spark, [(3, "same text here now", "en", "s", 1), (1, "same text here now", "en", "s", 1), (1, "same text here now", "en", "s", 1), (9, "quite different words stand in this one", "en", "s", 1), (None, "nameless text of its own kind", "en", "s", 1), (None, "nameless text of its own kind", "en", "s", 1)])
    assert sorted(str(r.doc_id) for r in simhash.deduplicated(docs).collect()) == ["1", "9", "None"]


def test_ids_of_any_size_and_none(spark):
    """Large and negative ids, one id with two texts, and near texts without ids."""
    words_ = "one two three four five six seven eight nine ten eleven twelve".split() * 30
    near = [" ".join(words_), " ".join([*words_, "thirteen"])]
    assert 0 < (simhash.fingerprint(near[0]) ^ simhash.fingerprint(near[1])).bit_count() <= 4
    other, third = "a text that stands alone among others here", "yet another one with words of its own today"
    docs = documents(spark, [((1 << 63) - 1, near[0], "", "", 1), (1 << 62, near[1], "", "", 1), (-5, other, "", "", 2), (-5, third, "", "", 3)])
    got = sorted((r.doc_id, r.component_id) for r in simhash.grouped(docs).collect())
    assert got == [(-5, -5), (-5, -5), (1 << 62, 1 << 62), ((1 << 63) - 1, 1 << 62)]
    assert sorted(r.n_chars for r in simhash.deduplicated(docs).collect()) == [1, 2, 3]
    nameless = documents(spark, [(None, near[0], "", "", 1), (None, near[1], "", "", 2), (None, None, "", "", 3)])
    assert len(simhash.deduplicated(nameless).collect()) == 2


# 2: urls


def test_rules_and_hosts(spark):
    pages = spark.createDataFrame([(1, "https://A.Example.NET/en/x?q"), (2, "http://b.example.com/de/"), (3, "ftp://x.org/fr/1"), (4, "http://example.net?x/"), (5, None), (6, "no scheme/net/"), (7, "http://badexample.net/en/")], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages).collect()}
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[2][2:] == ("example.com/de/", "block") and got[3][2:] == ("org/fr/", "allow")
    assert got[4][:3] == ("example.net", "", None) and got[5][:3] == ("", "", None) and got[6][:3] == ("", "", None) and got[7][2:] == ("net/", "block")


def test_url_model_on_held_out_rows():
    """Known words in hosts and paths that training had not; and words held out whole, of which the model knows nothing.

    Grams of unseen words say little: accuracy over both classes is chance there (README has the figures), and what the
    prior is for is that unseen words are let through.
    """
    blocked, right = [], []
    for fold in range(5):
        seen, unseen = ([[w for i, w in enumerate(words_) if (i % 5 == fold) == held] for words_ in (urls.ALLOW_WORDS, urls.BLOCK_WORDS)] for held in (False, True))
        model = urls.trained(urls.labelled(urls.seed_table(seen)))
        rows = [(f"go.{w}-{seen[label][(i + 11) % len(seen[label])]}.example", f"/p/{w}", label) for label in (0, 1) for i, w in enumerate(seen[label])]
        right += ((model.scores([h for h, *_ in rows], [p for _, p, _ in rows]) >= 0.5) == np.array([y for *_, y in rows])).tolist()
        clean = [(h, p) for h, p, y in urls.labelled(urls.seed_table(unseen)) if not y]
        blocked += (model.scores([h for h, _ in clean], [p for _, p in clean]) >= 0.5).tolist()
    assert np.mean(right) > 0.95 and np.mean(blocked) < 0.15
    model, rows = urls.trained(urls.labelled(urls.seed_table())), urls.labelled(urls.seed_table())
    assert np.mean((model.scores([h for h, *_ in rows], [p for _, p, _ in rows]) >= 0.5) == [y for *_, y in rows]) > 0.95
    assert urls.trained([]).scores(["a"], ["/"])[0] < 0.5


def test_url_scores_gram_by_gram():
    """The model's score in plain loops over characters."""
    model, mask = urls.trained(urls.labelled(urls.seed_table())), (1 << 64) - 1

    def plain(host, path):
        slots = set()
        for salt, text in ((1, f"^{host}$"), (2, f"^{path}$")):
            for n in model.lengths:
                for i in range(len(text) - n + 1):
                    h = salt * 31 + n
                    for c in text[i : i + n]:
                        h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 & mask
                        h ^= h >> 29
                    slots.add(h >> 64 - model.bits)
        return 1 / (1 + np.exp(-(model.bias + sum(model.weights[s] for s in slots) / max(1, len(slots)) ** 0.5)))

    rows = [("www.casino.com", "/a/b"), ("", ""), ("é漢😀.org", "/x" * 300), ("library.net", "/"), ("a", "")]
    hosts, paths = [h for h, _ in rows], [p for _, p in rows]
    for most in (1, 50, 1 << 18):
        assert np.allclose(model.scores(hosts, paths, most), [plain(h, p) for h, p in rows])


def test_url_parts_and_rules_by_sql(spark):
    """host, path, rule and the verdicts of rules over all pages."""
    import duckdb

    from tests.oracle import _norm

    listed = ", ".join(f"('{r.host}', '{r.path}', '{r.text}', '{r.verdict}')" for r in urls.RULES)
    found = duckdb.sql(f"""
        WITH u AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM '/root/testdata/sf0.1/pages.parquet'),
        h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        r(rh, rp, rule, verdict) AS (VALUES {listed})
        SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
        FROM h LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL""").fetchall()
    got = urls.op2_url_filters(spark, "/root/testdata/sf0.1").select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")), F.col("verdict").isin("allow", "block").alias("known")).collect()
    assert all(r.known for r in got) and _norm(tuple(r)[:5] for r in got) == _norm(found)


# 3 and 8: pieces


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts():
    r = random.Random(1)
    letters = "ab eEthe  \n\t▁é漢😀<s></s>.,'0129\x00日本ñü"
    return ["", " ", "  a", "▁", "a\n b", *("".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(800))]


def test_encoding_is_the_librarys(library):
    e, c = pieces.encoder(MODEL), token_counts.counter(MODEL)
    for t in texts():
        want = library.encode(t, add_eos=True)
        assert e.encode(t) == want and c.count(t) == len(want) - 1 and e.model.decode(want) == library.decode(want)
        ids, starts, ends = e.spans(t)
        raw = t.encode()
        assert ids == want and starts[0] == 0 and ends[-1] == len(raw) and starts[1:] == ends[:-1]


def test_decoding_of_any_ids(library):
    r = random.Random(2)
    model = piece_model.loaded(MODEL)
    for _ in range(1500):
        ids = [r.choice([1, 2, 0, *range(3, 259), *r.sample(range(259, 32000), 9)]) for _ in range(r.randrange(9))]
        assert model.decode(ids) == library.decode(ids)


def test_counting_is_merging():
    model, r = piece_model.loaded(MODEL), random.Random(5)
    for _ in range(400):
        s = "▁" + "".join(r.choice("aeioutnrsthéö漢") for _ in range(r.randrange(1, 60)))
        assert model.initial(s) - model.n_merges(s) == len(model.stretch_ids(s))


def test_scans_merge_like_the_heap():
    model, r = piece_model.loaded(MODEL), random.Random(6)
    for _ in range(1500):
        s = "▁" + "".join(r.choice("aeioutnrsthéö漢s") for _ in range(r.randrange(1, 90)))
        assert model._scanned(s) == model._heaped(s) == model.merged(s)


def test_character_map():
    """A map of 'a' to 'x' and 'ab' to 'y z', as a double array by hand."""
    offset = lambda n: n << 10
    units = [0] * 512
    units[0] = offset(256)
    a = 256 ^ 97
    units[a] = 97 | 256 | offset(a ^ 128)
    units[128] = 0x80000000
    b = 128 ^ 98
    units[b] = 98 | 256 | offset(b ^ 132)
    units[132] = 0x80000000 | 2
    m = piece_model.CharMap(struct.pack("<I", 2048) + struct.pack("<512I", *units) + b"x\0y z\0")
    assert m.longest(b"ac", 0) == (1, b"x") and m.longest(b"abc", 0) == (2, b"y z") and m.longest(b"c", 0) is None
    model = object.__new__(piece_model.PieceModel)
    model.charmap, model.strip, model.escape, model.dummy_prefix = m, False, True, True
    assert model.aligned("ab c") == ("▁y▁z▁c", [0, 0, 0, 0, 0, 0, 0, 0, 2, 2, 2, 3, 4])


def test_digests(spark, library):
    got = {r.doc_id: r for r in pieces.op3_sentencepiece(spark, SF).collect()}
    counts = {r.doc_id: r for r in token_counts.op8_token_counts(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(d.text, add_eos=True)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert (counts[d.doc_id].n_tokens, counts[d.doc_id].n_bytes) == (len(ids) - 1, len(d.text.encode()))
        spans = [x for p in library.encode(d.text, return_type="proto").pieces for x in (p.begin, p.end)] + [len(d.text.encode())] * 2
        assert r.spans_sha256 == hashlib.sha256(struct.pack(f"<{len(spans)}i", *spans)).hexdigest()


def test_spans_are_the_alignments(library):
    """Of every text: the library's spans, and those of a model that must take its alignment from aligned()."""
    e, other = pieces.encoder(MODEL), piece_model.PieceModel(MODEL)
    other.plain = False
    slow = pieces.Encoder(other)
    for t in texts():
        assert e.spans(t) == slow.spans(t)
        at = [len(t[:i].encode()) for i in range(len(t) + 1)]
        want = [(p.id, p.begin, p.end) for p in library.encode(t, return_type="proto").pieces]
        assert list(zip(*e.spans(t, end=False), strict=True)) == want


def test_digests_rest_on_spans(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b漢\u0001 cd"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in pieces.encoded(docs).join(pieces.digests(docs), "doc_id").collect()}
    assert {k: (len(r.pieces), hashlib.sha256(" ".join(str(p.id) for p in r.pieces).encode()).hexdigest()) for k, r in found.items()} == {k: (r.n_tokens, r.ids_sha256) for k, r in found.items()}
    real = pieces._pieces

    def shifted(e, texts):
        found = real(e, texts).to_pylist()
        found[0][0]["end"] += 1
        return pieces.pa.array(found, pieces.PIECES)

    monkeypatch.setattr(pieces, "_pieces", shifted)
    with pytest.raises(Exception, match="tile"):
        pieces.digests(docs).collect()


# 4: archives


def test_archives_sql(spark):
    same(spark, warc.op4_warc, warc.SQL["op4_warc"], SF)


def test_seekable_bundle():
    b = warc.Bundle()
    raw = [warc.record(i, f"http://x/{i}\n", bytes([i]) * 40_000, 40_000, "D", None, False) for i in range(20)]
    for i, r in enumerate(raw):
        b.add(i, r)
    index = b.index
    seek = warc.Seekable(b.closed())
    assert len(seek.frames()) > 3
    for x, r in zip(index, raw, strict=True):
        assert seek.record(x["frame"], x["offset"], x["length"]) == r
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(seek.data, read_across_frames=True).read()
    assert whole == b"".join(raw)


def test_revisits_and_files(spark, tmp_path):
    pages = spark.createDataFrame([(2, "u", "same"), (1, "u", "same"), (3, None, None), (4, "u", ""), (None, "u", "same")], "page_id long, url string, html string")
    archives = common.written(warc.archived(pages), "t")
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.read(archives).collect())
    assert got == [("1", 4, "response", None), ("2", 4, "revisit", 1), ("3", 0, "response", None), ("4", 0, "revisit", 3), ("None", 4, "revisit", 1)]
    assert {r.payload_digest for r in warc.read(archives).collect()} == {base64.b32encode(hashlib.sha1(x).digest()).decode() for x in (b"same", b"")}
    for r in warc.exported(archives, str(tmp_path)).collect():
        assert warc.Seekable(open(r.file, "rb").read()).frames()


# 5: licences


def test_rules_are_gated():
    assert len(rules()) > 200
    assert not [r for r in rules() if len(licenses._keyword(r)) < 2]
    assert not [r for r in rules() if not any(g in r.pattern.replace("licen[cs]", "license") for g in GATES)]


def shortest(pattern):
    """Strings that the pattern matches, one for each way through its branches: what may be absent is."""

    def of(parsed):
        out = {""}
        for op, arg in parsed:
            match str(op):
                case "LITERAL":
                    more = {chr(arg)}
                case "BRANCH":
                    more = set().union(*map(of, arg[1]))
                case "SUBPATTERN":
                    more = of(arg[3])
                case "MAX_REPEAT":
                    more = {x * arg[0] for x in of(arg[2])}
                case "IN":
                    more = {"0" if str(kind) == "CATEGORY" else chr(value if str(kind) == "LITERAL" else value[0]) for kind, value in arg[:1]}
                case "ANY":
                    more = {"x"}
            out = {x + y for x in out for y in more}
        return out

    return of(re._parser.parse(pattern))


def test_gates_hold_for_the_shortest_match(spark):
    """No gate may rest on a word that a pattern can do without."""
    short = [(r.pattern, t) for r in rules() for t in shortest(r.pattern)]
    assert len(short) > 1000 and all(re.fullmatch(p, t) for p, t in short)
    assert not [t for _, t in short if not any(g in t for g in GATES)]
    docs = documents(spark, [(1, "Released under MIT No Attribution.", "", "", 0), (2, "MIT no attribution", "", "", 0), (3, "nothing here", "", "", 0)])
    assert rows_of(licenses.scanned(docs)) == [(1, "mit-0", 0.8), (2, "mit-0", 0.6), (3, "", 0.0)]


def test_wrapped_texts_keep_their_detections(spark):
    """Each rule's shortest matches, their words joined by what licence files have between them."""
    short = sorted({(t, r.label) for r in rules() for t in shortest(r.pattern)})
    docs = documents(spark, [(4 * i + k, sep.join(t.split(" ")), "", "", 0) for i, (t, _) in enumerate(short) for k, sep in enumerate(("\n", "\t", "  ", ", "))])
    plain = {r.doc_id: (r.labels, r.score) for r in licenses.scanned(documents(spark, [(i, t, "", "", 0) for i, (t, _) in enumerate(short)])).collect()}
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scanned(docs).collect()}
    assert all(plain[i][1] > 0 for i in plain)
    assert [i for i in got if got[i] != plain[i // 4]] == []
    wrapped = "This notice may not be removed or\naltered\nsource versions must be plainly marked as such"
    assert rows_of(licenses.scanned(documents(spark, [(1, wrapped, "", "", 0)]))) == [(1, "zlib", 1.0)]


def test_many_places_in_one_text(spark):
    """Tens of thousands of places, apart and in chains of overlaps."""
    import time

    n = 20_000
    docs = documents(spark, [(1, "MIT License. x\n" * n, "", "", 0), (2, "under the apache license version 2 0 or the gnu general public license v3 \n" * 3000, "", "", 0)])
    began = time.time()
    got = {r.doc_id: r for r in licenses.scanned(docs).collect()}
    assert got[1].n_base == len(got[1].detections) == n and got[1].last_word == 3 * (n - 1) and time.time() - began < 60
    first = licenses.scanned(documents(spark, [(2, "under the apache license version 2 0 or the gnu general public license v3 \n", "", "", 0)])).first()
    assert len(got[2].detections) == 3000 * len(first.detections)
    assert [d.start for d in got[2].detections] == sorted(d.start for d in got[2].detections)


def rows_of(scanned):
    return sorted((r.doc_id, r.labels, r.score) for r in scanned.collect())


def test_licenses_by_brute_force(spark):
    extra = documents(spark, [(-1, "SPDX-License-Identifier: Apache-2.0\nLicensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance", "", "", 0), (-2, "MIT License mit license GENERAL public-license", "", "", 0), (-4, "MIT No Attribution License MPL 2.0 CC BY SA 4.0 license. Distributed under the Boost Software License Version 1.0, \u00c9 GPL V2 GNU GPL v3 or later MIT LICENSE", "", "", 0), (-3, "GNU Lesser General Public License v3 or the MIT license, all rights reserved", "", "", 0)])
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(extra).select("doc_id", "text")
    signatures, patterns = rules(), [re.compile(f" (?:{r.pattern})(?= )", re.A) for r in rules()]
    found, lower = 0, str.maketrans(licenses.UPPER, licenses.LOWER)
    for r in docs.join(licenses.scanned(docs), "doc_id").collect():
        norm = " " + re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", (r.text or "").translate(lower)).strip(" ") + " "
        ws = norm.split()
        base = [(i, label) for p, label in licenses.PHRASES for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
        hits = [(m.start() + 1, m.end(), k) for k, p in enumerate(patterns) if licenses._keyword(signatures[k]) in norm for m in p.finditer(norm)]
        outer = sorted(x for x in hits if not any(y != x and y[0] <= x[0] and y[1] >= x[1] and (y[:2] != x[:2] or y[2] < x[2]) for y in hits))
        left = []
        for x in outer:
            if left and left[-1][1] > x[0]:
                left[-1] = min(left[-1], x, key=lambda y: y[2])
            else:
                left.append(x)
        names = {label for _, label in base}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(ws), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None))
        assert r.base_labels == ",".join(sorted(names)) and r.labels == ",".join(sorted(names | {signatures[k].label for *_, k in left}))
        assert r.score == max([0.0, *(WEIGHTS[signatures[k].kind] for *_, k in left), *(0.6 for _ in base[:1])])
        found += bool(left)
    assert found >= 3


# 6: media


def test_jpeg_round_trip():
    r = random.Random(5)
    payloads = [media.padded(x) for x in (b"", b"hello", bytes(r.randrange(256) for _ in range(5000)), bytes([128]) * 3000, bytes(r.choice([126, 127, 128, 129, 130]) for _ in range(9000)), ("text é ü " * 300).encode())]
    payloads += [media.padded(bytes(r.choice([128] * 30 + [127, 129, 5]) for _ in range(2000))) for _ in range(9)]
    payloads += [media.padded(bytes(r.choice([108] * n + [107, 109, 5, 255]) for _ in range(3000))) for n in (1, 5, 20, 90)]
    payloads += [media.padded(bytes([108] * 20 + [109] + [108] * 40 + [107, 0, 255]) * 30), media.padded(bytes([109]) * 5000), media.padded(bytes([107] * 16 + [108] * 16) * 99)]
    files = media.encoded(payloads)
    back = list(media.decoded(files))
    assert [p for p, _ in back] == payloads
    for p, f, (_, t) in zip(payloads, files, back, strict=True):
        assert media.encoded([p]) == [f] and (next(media.decoded([f]))[1] == t).all()
        assert f[:2] == b"\xff\xd8" and f[-2:] == b"\xff\xd9" and f.count(b"\xff\xda") == 11


def test_foreign_files_are_refused():
    f = media.encoded([media.padded(b"abc")])[0]
    at = f.index(b"\xff\xdb")
    for bad in (f[: at + 6] + b"\2" + f[at + 7 :], f.replace(b"\xff\xc2", b"\xff\xc0", 1), f.replace(jpeg.COMPONENTS, bytes([3, 1, 0x11, 0, 2, 0x11, 0, 3, 0x11, 0]), 1)):
        with pytest.raises(ValueError, match="only"):
            jpeg.read([bad])


def test_colours_in_plain_loops():
    """Chroma by replication and the usual conversion, pixel by pixel."""
    rng = np.random.default_rng(9)
    across, down = 3, 2
    planes = rng.integers(-40, 300, (6 * across * down, 64)).astype(np.int32)
    got = jpeg.rgb(planes, across, down)

    def at(first, wide, y, x):
        return int(planes[first + y // 8 * wide + x // 8, y % 8 * 8 + x % 8])

    n = across * down
    for y in range(16 * down):
        for x in range(16 * across):
            luma, cb, cr = at(0, 2 * across, y, x), at(4 * n, across, y // 2, x // 2) - 128, at(5 * n, across, y // 2, x // 2) - 128
            want = [luma + 1.402 * cr, luma - 0.344136 * cb - 0.714136 * cr, luma + 1.772 * cb]
            assert all(abs(int(g) - min(255, max(0, w))) <= 1 for g, w in zip(got[y, x], want, strict=True))


def test_inverse_transform_is_the_cosine_sum():
    rng = np.random.default_rng(1)
    block = rng.integers(-60, 60, (1, 64)).astype(np.int16)
    natural = np.zeros(64)
    natural[jpeg.ZIGZAG] = block[0]
    f, want = natural.reshape(8, 8), np.zeros((8, 8))
    for y in range(8):
        for x in range(8):
            want[y, x] = sum((0.5**0.5 if u == 0 else 1) * (0.5**0.5 if v == 0 else 1) / 4 * f[u, v] * np.cos((2 * y + 1) * u * np.pi / 16) * np.cos((2 * x + 1) * v * np.pi / 16) for u in range(8) for v in range(8)) + 128
    assert np.abs(jpeg.samples(block).reshape(8, 8) - want).max() < 2


def test_media_contract(spark):
    got = {r.doc_id: r for r in media.op6_media(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        r, p = got[d.doc_id], media.padded(d.text.encode())
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(d.text.encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))


def test_tensors(spark):
    t = media.tensors(media.stored(documents(spark, [(1, "abc", "", "", 3)]))).first()
    assert len(t.rgb) == t.height * t.width * 3


# 7: quality


def test_quality_sql(spark):
    same(spark, quality.op7_quality_rules, quality.SQL["op7_quality_rules"], SF)


def test_clean_text_stays_and_junk_goes(spark):
    clean = (
        "The garden behind the old house was full of flowers, and the children of the village came there to play.\n"
        "It is known that a tree by the gate stood in that place for two hundred years, long before anyone built the wall.\n"
        "When winter came, the gardener closed the shutters and went to live with his sister near the sea.\n"
        "He wrote to us about the storms, the fishing boats and the quiet evenings that he spent with a book.\n"
    )
    junk = [clean.replace("e", "#"), "x9 " * 200, " ".join(f"{i}" for i in range(300)), "short text"]
    docs = documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate([clean, *junk])])
    assert [r.doc_id for r in quality.filtered(docs).collect()] == [0]


# 9: mixing


def test_mixing_sql(spark):
    same(spark, mixing.op9_mixing, mixing.SQL["op9_mixing"], SF)


def test_targets_by_resharing(spark):
    r = random.Random(8)
    for _ in range(4):
        sizes = {f"s{i:02d}": r.choice([1, 5, 40, 300, 2000]) for i in range(r.randrange(1, 9))} | {None: 7}
        rows = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
        weight = dict(zip(sorted((k for k in sizes if k), key=str.encode), (mixing.WEIGHTS[i % 3] for i in range(99)), strict=False)) | {None: mixing.WEIGHTS[(len(sizes) - 1) % 3]}
        total, done = 1.5 * sum(sizes.values()), {}
        while True:
            rest = [k for k in sizes if k not in done]
            left = total - sum(done.values())
            share = {k: left * weight[k] / sum(weight[x] for x in rest) for k in rest}
            over = {k: 2.0 * sizes[k] for k in rest if share[k] > 2 * sizes[k]}
            if not over:
                break
            done |= over
        want = done | share
        for row in mixing.targets(rows).collect():
            assert row.target == pytest.approx(want[row.source])


def test_taken_is_near_target_and_bounded(spark):
    got = mixing.op9_mixing(spark, SF).collect()
    assert all(r.taken <= 2 * r.size for r in got)
    by = {}
    for r in got:
        t = by.setdefault((r.source_size, r.target), [0, 0])
        t[0] += r.taken
        t[1] = max(t[1], r.size)
    assert all(abs(n - target) <= 2 * most for (_, target), (n, most) in by.items())


# 10: repeated strings


def brute(rows):
    first, out = {}, {}
    rows = sorted((d if d is not None else 1 << 63, (t or "").encode()) for d, t in rows)
    for d, b in rows:
        for i in range(len(b) - 99):
            first.setdefault(b[i : i + 100], (d, i))
    for d, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if first[b[i : i + 100]] != (d, i):
                gone[i : i + 100] = b"\1" * 100
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.setdefault(d, []).append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


def random_texts():
    r = random.Random(3)
    ws = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 8))) for _ in range(60)]
    base = " ".join(r.choice(ws) for _ in range(400))
    rows = []
    for i in range(50):
        k = r.randrange(5)
        if k == 2:
            t = list(base)
            for _ in range(r.randrange(8)):
                t[r.randrange(len(t))] = "é"
            t = "".join(t)
        else:
            other = " ".join(r.choice(ws) for _ in range(60))
            t = {0: base[r.randrange(500) :][: r.randrange(50, 900)], 1: "ab" * r.randrange(300), 3: other + base[300 : 300 + r.randrange(80, 300)] + other, 4: "x" * r.randrange(400) + base[100:230]}[k]
        rows.append((i, t))
    return [*rows, (7, rows[7][1]), (7, "other " + base[:150]), (None, base), (200, None), (201, ""), (202, "\x00" * 150)]


@pytest.mark.parametrize(("wide", "bytes_"), [(False, 12_000_000), (True, 100)])
def test_suffixes_by_brute_force(spark, wide, bytes_, monkeypatch):
    """With both digests, and with so small buckets that ranges are cut further by hashes."""
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", bytes_)
    monkeypatch.setattr(suffixes, "MOST_SPLITTERS", 40)
    data = random_texts()
    got = {}
    for r in suffixes.deduped(spark.createDataFrame(data, "doc_id long, text string"), F.col("doc_id"), wide=wide).collect():
        got.setdefault(r.row if r.row is not None else 1 << 63, []).append(tuple(r)[1:])
    assert {k: sorted(v) for k, v in got.items()} == brute(data)


def test_hot_leads_are_cut():
    """A lead of a third of all strings is spread over about a third of the buckets; equal strings stay together."""
    rng = np.random.default_rng(7)
    leads = rng.integers(97, 123, (30_000, 16)).astype(np.uint8)
    leads[:10_000] = 32
    r = suffixes.Ranges(np.zeros(0, "S24"), leads.view("S16").ravel()[::7], 64)
    digest = rng.integers(0, 1 << 62, 30_000).astype(np.uint64)
    bucket = r.of_strings(leads, digest)
    assert np.bincount(bucket).max() < 3 * 30_000 / 64 and len(np.unique(bucket[:10_000])) > 15
    assert (r.of_strings(leads[::-1].copy(), digest[::-1].copy())[::-1] == bucket).all()


def test_suffixes_sql(spark):
    same(spark, suffixes.op10_suffixes, suffixes.SQL["op10_suffixes"], SF)


def test_slabs_lose_no_string(monkeypatch):
    monkeypatch.setattr(suffixes, "SLAB", 150)
    texts_ = [t.encode() for _, t in random_texts() if t]
    data = np.frombuffer(b"".join(texts_), np.uint8)
    ends = np.cumsum([len(t) for t in texts_])
    covered = {(int(d), int(s)) for doc, lo, hi, *_ in suffixes.units(data, ends - [len(t) for t in texts_], ends) for d, a, b in zip(doc, lo, hi, strict=True) for s in range(a, b - 99)}
    assert covered == {(i, s) for i, t in enumerate(texts_) for s in range(len(t) - 99)}


def test_multikey_sorts_like_tuples():
    rng = np.random.default_rng(2)
    cols = [rng.integers(0, 3, 500).astype(np.uint64) for _ in range(4)]
    order, same_ = suffixes.multikey(cols)
    got = [tuple(int(c[i]) for c in cols) for i in order]
    assert got == sorted(got) and [bool(x) for x in same_] == [i > 0 and got[i] == got[i - 1] for i in range(500)]


# the pipeline


def test_pipeline_against_single_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    good = {r.doc_id for r in quality.measured(docs).where("kept").select("doc_id").collect()}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    ids = sorted(rows)
    roots = closure(ids, [simhash.fingerprint(rows[i]) for i in ids])
    kept = [i for i, root in zip(ids, roots, strict=True) if i == root]
    removed = brute([(i, rows[i]) for i in kept])
    stage = docs
    for name, f in corpus_pipeline.STAGES[:3]:
        stage = common.written(f(spark, stage, SF), "stage")
        assert stage.columns == columns, name
    left = {r.doc_id: r.text for r in stage.collect()}
    assert sorted(left) == kept
    for i, t in left.items():
        if removed[i][0][1] == 0:
            assert t == rows[i]
        else:
            assert len(t.encode()) <= removed[i][0][0] - removed[i][0][1]
    mixed = corpus_pipeline.STAGES[3][1](spark, stage, SF)
    taken = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    want = {r.doc_id: r.copies for r in mixing.draws(stage.select("doc_id", "source", common.n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_h")), ("size", "doc_id", "_h")).collect() if r.copies}
    assert taken == want and mixed.columns == columns
    assert corpus_pipeline.run(spark, SF).count() == sum(want.values())


# 6 again: files at rest


def test_media_are_read_back_from_storage(spark):
    """The query reads the files that it wrote, not its documents."""
    found = media.op6_media(spark, SF)
    files = found.inputFiles()
    assert files and all("/media-" in f for f in files)
    kept = {r.doc_id: hashlib.sha256(r.media).hexdigest() for r in spark.read.parquet(*files).select("doc_id", "media").collect()}
    assert {r.doc_id: r.media_sha256 for r in found.collect()} == kept and len(kept) == spark.read.parquet(f"{SF}/documents.parquet").count()


# values of awkward rows


def test_values_of_awkward_rows(spark, library):
    """Null, empty and blank texts, repeated rows and clashing columns, by value."""
    docs = awkward(spark)

    def by_id(df, *cols):
        return {(r.doc_id, *[r[c] for c in cols]) for r in df.collect() if r.doc_id in (1, 2, 3, 5, 6)}

    assert by_id(token_counts.counted(docs), "n_bytes", "n_tokens") == {(1, 0, 0), (2, 0, 0), (3, 4, len(library.encode(" \n\t "))), (5, 17, len(library.encode("tie one two three"))), (6, 17, len(library.encode("tie one two three")))}
    assert by_id(licenses.scanned(docs), "n_words", "first_word", "labels", "score") == {(i, n, None, "", 0.0) for i, n in ((1, 0), (2, 0), (3, 0), (5, 4), (6, 4))}
    assert by_id(quality.measured(docs), "n_words", "base_failed", "kept") == {(i, n, True, False) for i, n in ((1, 0), (2, 0), (3, 0), (5, 4), (6, 4))}
    prints = {r.doc_id: r for r in simhash.grouped(docs).collect()}
    assert [prints[i].fp for i in (1, 2, 3)] == [0, 0, 0] and prints[3].component_id == 1 and prints[6].component_id == 5
    media_ = {r.doc_id: r for r in media.features(media.stored(docs)).collect()}
    assert media_[1].media_sha256 == media_[2].media_sha256 and media_[5].feature == media_[6].feature and media_[1].payload_bytes == 576
    cut = {r.doc_id: r.text for r in suffixes.without_repeats(docs).where("doc_id < 7").collect()}
    assert cut[1] is None and cut[2] == "" and cut[3] == " \n\t " and cut[5] == cut[6] == "tie one two three"


def test_repeated_rows_share_their_copies(spark):
    """Rows that agree in id, source and text take turns, whatever their other columns hold."""
    rows_ = [(None, None, "en", "s", i % 3) for i in range(20)] + [(1, "a b c", "en", "s", 1)] * 4 + [(2, "d e", "en", None, None)] * 3
    docs = documents(spark, rows_)
    got = mixing.mixed(docs)
    per = {(r.doc_id, r.source): r.n for r in got.groupBy("doc_id", "source").agg(F.count("*").alias("n")).collect()}
    keyed = docs.select("source", common.n_words(F.col("text")).alias("size"), "doc_id", F.xxhash64("text").alias("_h"))
    want = {(r.doc_id, r.source): r.n for r in mixing.draws(keyed, ("size", "doc_id", "_h")).groupBy("doc_id", "source").agg(F.sum("copies").alias("n")).collect()}
    assert per == {k: n for k, n in want.items() if n} and got.columns == docs.columns
    each = {tuple(r)[:-1]: r.n for r in got.where("doc_id is null").groupBy(*docs.columns).agg(F.count("*").alias("n")).collect()}
    assert max(each.values()) - min(each.values()) <= 8


def test_remembered_characters_are_bounded():
    model = piece_model.loaded(MODEL)
    known = piece_model.Remembered(model, len, 0, 1000)
    known.MOST_CHARS = 5_000
    for i in range(50):
        assert known.values(f"w{i:0900d} x") == [902, 2]
        assert sum(map(len, (*known.whole, *known.inner, *known.edge))) <= 5_000
