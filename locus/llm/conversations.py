"""Repair of conversation structure: one integer minimum decides cost and audit together."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, let, ranked, table

#: Conversations of more rows are solved in blocks of so many over several tasks.
BLOCK = 64
#: Blocks that one task multiplies in a round.
FAN = 16
BROADCAST_IDS = 100_000
#: Edit costs: a contract's figures.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
#: Letters by their digits, in ASCII order; digit 0 is the padding behind the end.
LETTERS = " DIKR"
WIDTH = 3
#: A row's code is a letter for role class (s, u, a, other) and fault.
CLASSES, FAULTS = "sua", ("none", "truncated", "blank", "duplicate")
CODES = "ABCDEFGHIJKLMNOP"
#: Role initials so far: nothing, s, and those that end in u or a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where the next role leads from each state.
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}

Entry = tuple[int, int, int]  # cost, letters as digits, number of letters


def _edges(state: int, code: int) -> Iterator[tuple[int, str, int]]:
    """The edits of a row: next state, letter, cost."""
    kind, fault = divmod(code, len(FAULTS))
    yield state, "D", DELETE
    if fault < 2:
        extra = CUT * fault
        for role, to in NEXT[state].items():
            if kind < len(CLASSES) and CLASSES[kind] == role:
                yield to, "K", extra
            elif role != "s":
                yield to, "R", REROLE + extra


def _inserts(state: int) -> Iterator[int]:
    return (to for role, to in NEXT[state].items() if role != "s")


EDGES = {c: [list(_edges(state, i)) for state in range(4)] for i, c in enumerate(CODES)}


def block_paths(codes: str, start: int) -> list[Entry | None]:
    """The cheapest edits of a block from one state to each state, None where no edits lead.

    Nodes are (rows done, state, letters written). A weight is one integer: the cost in its high digits, then a digit
    for each place of the audit, zero behind its end. A letter's place is known at its node, so weights add along a path,
    and the least integer is the cheapest path whose audit comes first in ASCII. Deleting all rows and inserting two
    shows that no best path has more than 2n/5 + 2 inserts.
    """
    n = len(codes)
    most = DELETE * n // INSERT + 2
    places = n + most
    high = WIDTH * places
    digit = {x: LETTERS.index(x) for x in LETTERS[1:]}
    now: dict[tuple[int, int], int] = {(start, 0): 0}
    for i in range(n + 1):
        # Two inserts lead from any state to u or a, so what costs more than they do beside another path is on no best one.
        beyond = (min(now.values()) >> high) + 2 * INSERT + 1 << high
        now = {at: w for at, w in now.items() if at[0] < USER or w < beyond}
        j, last = min(j for _, j in now), max(j for _, j in now)
        while j <= last and j < most:  # inserts before row i, or at the end
            for state in range(4):
                v = now.get((state, j), beyond) + (INSERT << high) + (digit["I"] << WIDTH * (places - 1 - i - j))
                if v < beyond:
                    for to in _inserts(state):
                        if v < now.get((to, j + 1), v + 1):
                            now[to, j + 1], last = v, max(last, j + 1)
            j += 1
        if i == n:
            break
        after: dict[tuple[int, int], int] = {}
        edges = EDGES[codes[i]]
        for (state, j), w in now.items():
            shift = WIDTH * (places - 1 - i - j)
            for to, x, cost in edges[state]:
                v = w + (cost << high) + (digit[x] << shift)
                if v < after.get((to, j), v + 1):
                    after[to, j] = v
        now = after
    out: list[Entry | None] = []
    for state in range(4):
        ends = [(w, j) for (to, j), w in now.items() if to == state]
        if not ends:
            out.append(None)
            continue
        w, j = min(ends)
        out.append((w >> WIDTH * places, (w & (1 << WIDTH * places) - 1) >> WIDTH * (places - n - j), n + j))
    return out


def joined(first: list[Entry | None], second: list[list[Entry | None]]) -> list[Entry | None]:
    """Paths through one block and then another: again the least integer, padded to one width."""
    out: list[Entry | None] = []
    for end in range(4):
        pairs = [(a, second[mid][end]) for mid, a in enumerate(first) if a and second[mid][end]]
        places = max((a[2] + b[2] for a, b in pairs), default=0)
        weigh = lambda a, b, p=places: (a[0] + b[0] << WIDTH * p) + (a[1] << WIDTH * (p - a[2])) + (b[1] << WIDTH * (p - a[2] - b[2]))
        best = min(pairs, key=lambda ab: weigh(*ab), default=None)
        out.append(best and (best[0][0] + best[1][0], (best[0][1] << WIDTH * best[1][2]) + best[1][1], best[0][2] + best[1][2]))
    return out


def audit_of(entry: Entry) -> str:
    digits = oct(entry[1])[2:].zfill(entry[2]) if entry[2] else ""
    return digits.translate(str.maketrans("1234", LETTERS[1:]))


def _entry(text: str) -> Entry | None:
    cost, _, audit = text.partition(":")
    return (int(cost), int(audit.translate(str.maketrans(LETTERS[1:], "1234")) or "0", 8), len(audit)) if cost else None


def packed(paths: list[list[Entry | None]]) -> str:
    return ";".join(f"{e[0]}:{audit_of(e)}" if e else "" for row in paths for e in row)


def unpacked(text: str) -> list[list[Entry | None]]:
    flat = [_entry(x) for x in text.split(";")]
    return [flat[4 * i : 4 * i + 4] for i in range(4)]


def best_audit(from_start: list[Entry | None]) -> tuple[int, str]:
    """The cheaper of no roles at all and of roles that end with an assistant."""
    ends = [(e[0], audit_of(e)) for e in (from_start[START], from_start[ASSISTANT]) if e]
    return min(ends)


def plan_of(codes: str, audit: str) -> str:
    """What the audit does, row by row and comma-joined: inserts (U, A), then K, D, or u, a for a new role; at last the inserts at the end."""
    state, parts, now, rows = START, [], "", iter(codes)
    for x in audit:
        if x == "I":
            state = next(_inserts(state))
            now += "U" if state == USER else "A"
            continue
        code = CODES.index(next(rows))
        state, now = next((to, now + ({USER: "u", ASSISTANT: "a"}[to] if x == "R" else x)) for to, y, _ in _edges(state, code) if y == x)
        parts.append(now)
        now = ""
    return ",".join([*parts, now])


def tallied(codes: str) -> tuple[int, int, int, int]:
    """blank, duplicate, truncated rows and illegal neighbours."""
    at = [divmod(CODES.index(c), len(FAULTS)) for c in codes]
    fault = [f for _, f in at]
    roles = "".join("suax"[k] for k, _ in at)
    illegal = sum(roles[i : i + 2] not in ("su", "ua", "au") for i in range(len(roles) - 1))
    return fault.count(2), fault.count(3), fault.count(1), illegal


FOUND = T.StructType([T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")] + [T.StructField(c, T.StringType()) for c in ("audit", "plan")])


@F.pandas_udf(FOUND)
def _solved(codes: pd.Series) -> pd.DataFrame:
    known: dict[str, tuple] = {}
    for c in set(codes):
        cost, audit = best_audit(block_paths(c, START))
        known[c] = (*tallied(c), cost, audit, plan_of(c, audit))
    return pd.DataFrame([known[c] for c in codes], columns=FOUND.names)


@F.pandas_udf(T.StringType())
def _block(codes: pd.Series) -> pd.Series:
    known = {c: packed([block_paths(c, s) for s in range(4)]) for c in set(codes)}
    return codes.map(known)


@F.pandas_udf(T.StringType())
def _product(parts: pd.Series) -> pd.Series:
    def multiplied(texts) -> str:
        now = unpacked(texts[0])
        for t in texts[1:]:
            then = unpacked(t)
            now = [joined(row, then) for row in now]
        return packed(now)

    return parts.map(multiplied)


@F.pandas_udf(FOUND)
def _finished(codes: pd.Series, paths: pd.Series) -> pd.DataFrame:
    rows = []
    for c, p in zip(codes, paths, strict=True):
        cost, audit = best_audit(unpacked(p)[START])
        rows.append((*tallied(c), cost, audit, plan_of(c, audit)))
    return pd.DataFrame(rows, columns=FOUND.names)


BLANK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn and the rows (role, text) that damage leaves of each row, as an array of none, one or two."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(case == 1, "").when(case == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(case == 4, "user").otherwise(space("role"))
    row = F.struct(role.alias("role"), text.alias("text"))
    return conversations.select("conv_id", "turn", F.when(case == 0, F.array_repeat(row, 0)).when(case == 3, F.array_repeat(row, 2)).otherwise(F.array_repeat(row, 1)).alias("rows"))


def _code(role: Column, text: Column, repeated: Column) -> Column:
    initial = F.substring(role, 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(~text.rlike(BLANK), 2).when(repeated, 3).when(~text.rlike(ENDED), 1).otherwise(0)
    return F.substring(F.lit(CODES), kind * len(FAULTS) + fault + 1, F.lit(1))


def _lines(plan: Column, role: Column, text: Column) -> Column:
    """The repaired lines of a row: those inserted before it and its own."""
    inserted = F.transform(F.filter(F.split(F.regexp_replace(plan, "[KDua]", ""), ""), lambda x: x != ""), lambda x: F.when(x == "U", "user:").otherwise("assistant:"))
    own = lambda head: F.array(F.concat(head, F.lit(":"), text))
    verdict = F.when(plan.endswith("K"), own(role)).when(plan.endswith("u"), own(F.lit("user"))).when(plan.endswith("a"), own(F.lit("assistant"))).otherwise(F.array().cast("array<string>"))
    return F.concat(inserted, verdict)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
GAPS = "cast(coalesce(_hi - _lo + 1 - _n, 0) as bigint) AS gaps"


def _short(rows: DataFrame) -> DataFrame:
    """Conversations of few rows: one aggregate gathers each, expressions judge it, and the solver sees codes alone."""
    per = rows.groupBy("conv_id").agg(F.collect_list(F.struct(F.col("turn").isNotNull().alias("has"), "turn", "rows")).alias("_all"))
    # Ties in turn are ordered by what the rows hold.
    ordered = F.array_sort(F.filter("_all", lambda x: F.size(x["rows"]) > 0))
    per = per.select("conv_id", ordered.alias("_o"))
    turns = F.array_compact(F.transform("_o", lambda x: x["turn"]))
    per = per.select("conv_id", F.array_max(turns).alias("_hi"), F.array_min(turns).alias("_lo"), F.size(F.array_distinct(turns)).alias("_n"), F.flatten(F.transform("_o", lambda x: x["rows"])).alias("_r"))
    code = F.transform("_r", lambda x, i: _code(x["role"], x["text"], F.array_position(F.col("_r"), x) <= i))
    per = per.withColumn("_codes", F.array_join(code, "")).withColumn("_f", _solved("_codes"))

    def text(plans: Column) -> Column:
        lines = F.flatten(F.transform("_r", lambda x, i: _lines(F.get(plans, i), x["role"], x["text"])))
        return F.array_join(F.concat(lines, _lines(F.element_at(plans, -1), F.lit(""), F.lit(""))), "\n")

    return per.select("conv_id", F.expr(GAPS), *[f"_f.{c}" for c in COLUMNS[2:8]], F.sha2(let(F.split("_f.plan", ",", -1), text), 256).alias("repaired_sha256"))


def _hashed(lines: DataFrame) -> DataFrame:
    """SHA-256 of each key's lines in order, joined by newlines. The hash is one chain by definition: a key's lines stream through one task and none is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, None
        for b in batches:
            done = []
            for k, line in zip(b["_k"].to_pylist(), b["_line"], strict=True):
                if k != key:
                    if now:
                        done.append((key, now.hexdigest()))
                    key, now = k, hashlib.sha256()
                else:
                    now.update(b"\n")
                now.update(line.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], names=["_k", "sha"])
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (key, now.hexdigest())], names=["_k", "sha"])

    return lines.repartition("_k").sortWithinPartitions("_k", "rank").select("_k", "_line").mapInArrow(run, "_k string, sha string")


def _long(rows: DataFrame, block: int) -> DataFrame:
    """Conversations of any length: rows are numbered over tasks, blocks of them solved from every state to every state, and
    their paths multiplied in rounds of FAN until one is left; edits go back to the blocks' rows."""
    key = F.to_json(F.struct("conv_id"))
    rows = rows.withColumn("_k", key)
    ids = rows.groupBy("_k").agg(F.first("conv_id").alias("conv_id"))
    flat = rows.select("_k", "turn", F.explode("rows").alias("_r")).select("_k", "turn", "_r.role", "_r.text")
    at = ranked(flat, "_k", ("turn", "role", "text")).withColumns({"_b": F.floor((F.col("rank") - 1) / block), "_d": F.sha2("text", 256)})
    turns = at.groupBy("_k", "turn").agg(F.count(F.lit(1))).groupBy("_k").agg(F.max("turn").alias("_hi"), F.min("turn").alias("_lo"), F.count("turn").alias("_n"))
    first = at.groupBy("_k", "role", "_d").agg(F.min("rank").alias("_first"))
    coded = at.join(first, ["_k", "role", "_d"]).select("_k", "_b", "rank", _code(F.col("role"), F.col("text"), F.col("rank") > F.col("_first")).alias("code"))
    in_order = lambda what: F.transform(F.array_sort(F.collect_list(F.struct(*what))), lambda x: x[what[-1]])
    coded = coded.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_k", "_b")  # work does not follow bytes here
    now = checkpointed(coded.groupBy("_k", "_b").agg(F.array_join(in_order(("rank", "code")), "").alias("codes")).withColumn("paths", _block("codes")))
    while (now.agg(F.max("_b")).first()[0] or 0) > 0:
        both = now.groupBy("_k", F.floor(F.col("_b") / FAN).alias("_b")).agg(F.array_join(in_order(("_b", "codes")), "").alias("codes"), in_order(("_b", "paths")).alias("_p"))
        now = checkpointed(both.select("_k", "_b", "codes", _product("_p").alias("paths")))
    found = checkpointed(now.withColumn("_f", _finished("codes", "paths")).select("_k", "_f.*"))

    def pieces(plans: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(plans) - 1) / block).cast("int")), lambda b: F.struct(b.cast("long").alias("_b"), F.slice(plans, b * block + 1, F.lit(block)).alias("_plans")))

    edits = found.select("_k", F.explode(let(F.split("plan", ",", -1), pieces)).alias("_e")).select("_k", "_e.*")
    body = at.join(edits, ["_k", "_b"]).select("_k", "rank", _lines(F.get("_plans", (F.col("rank") - 1 - F.col("_b") * block).cast("int")), F.col("role"), F.col("text")).alias("_l"))
    tail = found.select("_k", F.lit((1 << 63) - 1).alias("rank"), _lines(F.element_at(F.split("plan", ",", -1), -1), F.lit(""), F.lit("")).alias("_l"))
    sha = _hashed(body.unionByName(tail).where(F.size("_l") > 0).select("_k", "rank", F.array_join("_l", "\n").alias("_line")))
    out = ids.join(turns, "_k", "left").join(found, "_k", "left").join(sha, "_k", "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in COLUMNS[2:7]]
    return out.select("conv_id", F.expr(GAPS), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repaired(rows: DataFrame, block: int | None = None) -> DataFrame:
    """A row per conv_id: its faults, the cost and audit of the cheapest repair and the digest of the repaired lines.

    rows: conv_id, turn and `rows`, an array of (role, text) that stand there. Order is by turn with nulls first, and
    ties are ordered by role and text. A null conv_id is a conversation of its own; one without rows has zeros, an empty
    audit and the digest of an empty text. Roles count by their first character; one that is empty or none of s, u, a
    cannot be kept. Equal rows repeat one another and are duplicates. Other columns are not read. Conversations of up to `block`
    rows are gathered; longer ones, of whatever length, are numbered and solved in blocks over tasks. An empty table gives an empty result.
    """
    block = BLOCK if block is None else block
    rows = rows.select("conv_id", "turn", "rows")
    long = checkpointed(rows.groupBy("conv_id").agg(F.sum(F.size("rows")).alias("_m"), F.count(F.lit(1)).alias("_o")).where(F.greatest("_m", "_o") > block).select(F.col("conv_id").alias("_long")))
    n = long.count()
    if not n:
        return _short(rows)
    ids = F.broadcast(long) if n <= BROADCAST_IDS else long
    same = F.col("conv_id").eqNullSafe(F.col("_long"))
    return _short(rows.join(ids, same, "left_anti")).unionByName(_long(rows.join(ids, same, "left_semi"), block))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations")))


SQL = {
    "op12_conversations": r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::UBIGINT)),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT) % 20 AS k
  FROM conversations),
r AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM c, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, role, text) AS i FROM r),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE 'o' END AS fault,
         left(role, 1) AS x, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS y
  FROM o),
n AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, (count(*) FILTER (fault = 'b'))::BIGINT AS blank,
         (count(*) FILTER (fault = 'd'))::BIGINT AS duplicate, (count(*) FILTER (fault = 't'))::BIGINT AS truncated,
         (count(*) FILTER (y || x NOT IN ('su', 'ua', 'au')))::BIGINT AS illegal, count(*) AS m
  FROM f GROUP BY conv_id),
e(state, nxt, role, ins) AS (VALUES ('', 's', 's', false), ('', 'u', 'u', true), ('s', 'u', 'u', true), ('u', 'a', 'a', true), ('a', 'u', 'u', true)),
p(conv_id, i, ended, state, best) AS (
  SELECT conv_id, 0::BIGINT, false, '', {'cost': 0, 'audit': '', 'text': []::VARCHAR[]} FROM n
  UNION ALL
  SELECT conv_id, i, ended, state, min(best) FROM (
    WITH z AS (
      SELECT * FROM p WHERE NOT ended
      UNION ALL
      SELECT p.conv_id, p.i, p.ended, e.nxt, {'cost': p.best.cost + 5, 'audit': p.best.audit || 'I', 'text': list_append(p.best.text, CASE e.role WHEN 'u' THEN 'user:' ELSE 'assistant:' END)}
      FROM p JOIN e ON p.state = e.state AND e.ins WHERE NOT p.ended),
    h AS (SELECT z.conv_id, z.i, z.state, z.best, f.role, f.text, f.x, f.fault, f.i AS fi FROM z LEFT JOIN f ON z.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = z.i + 1)
    SELECT conv_id, i + 1 AS i, false AS ended, state, {'cost': best.cost + 2, 'audit': best.audit || 'D', 'text': best.text} AS best FROM h WHERE fi IS NOT NULL
    UNION ALL
    SELECT conv_id, i + 1, false, e.nxt, {'cost': best.cost + CASE WHEN fault = 't' THEN 5 ELSE 0 END, 'audit': best.audit || 'K', 'text': list_append(best.text, h.role || ':' || h.text)}
    FROM h JOIN e ON h.state = e.state AND h.x = e.role WHERE fi IS NOT NULL AND fault IN ('o', 't')
    UNION ALL
    SELECT conv_id, i + 1, false, e.nxt, {'cost': best.cost + 1 + CASE WHEN fault = 't' THEN 5 ELSE 0 END, 'audit': best.audit || 'R', 'text': list_append(best.text, CASE e.role WHEN 'u' THEN 'user:' ELSE 'assistant:' END || h.text)}
    FROM h JOIN e ON h.state = e.state AND e.ins WHERE fi IS NOT NULL AND fault IN ('o', 't')
    UNION ALL
    SELECT conv_id, i, true, 'end', best FROM h WHERE fi IS NULL AND state IN ('', 'a')) GROUP BY conv_id, i, ended, state)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.text, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON c.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN (SELECT * FROM p WHERE ended) p ON c.conv_id IS NOT DISTINCT FROM p.conv_id
"""
}
QUERIES = {"op12_conversations": op12_conversations}
