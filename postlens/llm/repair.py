"""Conversation structure repair: the cheapest edits by one integer per path."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from postlens.llm.common import crc32_sql, keep, table

#: Rows and characters of a conversation that one pass holds; longer ones are cut into pieces of this size.
ROWS, CHARS = 512, 1 << 22
#: What a row's first fault is: none, one that forces its deletion, a cut-off end.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Edit letters are octal digits in ASCII order; 0 pads the end.
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LETTERS = str.maketrans("1234", "DIKR")
DIGITS = str.maketrans("DIKR", "1234")
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
CUT_OFF = 3  # what an undeleted truncated row adds
SPACE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The initial that an inserted or a reroled row gets in each state, and the ends.
DUE = "uuau"
ENDS = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}


# ------------------------------------------------------------- the DP
def transfer(rows: list[tuple[str, int]], entries: tuple[int, ...] = (START,)) -> dict[int, dict[int, tuple[int, int]]]:
    """``rows``: (role initial, fault).  For every entry state the least path to each
    state behind the rows, as (weight, number of edits).

    A weight is one integer: cost * 8 ** width plus the audit as ``width`` = 2 * rows
    octal digits, the first edit's highest.  Two paths of one cost to one state
    differ inside both audits (a proper prefix would lack inserts only, and be
    cheaper), so the plain minimum decides cost first and ASCII order next.  Two
    inserts side by side, or one before a delete, are never least: the first cost 6 for
    a pair that can go, the second could follow the delete, which is less in ASCII."""
    width = 2 * len(rows)
    out = {}
    for entry in entries:
        best = {entry: (0, 0)}
        for left, (initial, fault) in enumerate(rows):
            found: dict[int, tuple[int, int]] = {}

            def offer(state, weight, at, digit, more=0):
                weight += ((COST[digit] + more) << 3 * width) + (digit << 3 * (width - 1 - at))
                if state not in found or weight < found[state][0]:
                    found[state] = (weight, at + 1)
                return weight, at + 1

            for state, (weight, at) in best.items():
                offer(state, weight, at, DELETE)
                if fault in (BLANK, DUPLICATE):
                    continue
                more = CUT_OFF if fault == TRUNCATED else 0
                filled = weight + (COST[INSERT] << 3 * width) + (INSERT << 3 * (width - 1 - at)), at + 1
                for s, (w, k) in ((state, (weight, at)), (MOVES[state][DUE[state]], filled)):
                    if initial in MOVES[s]:
                        offer(MOVES[s][initial], w, k, KEEP, more)
                    offer(MOVES[s][DUE[s]], w, k, REROLE, more)
            best = found
        out[entry] = best
    return out


def finish(best: dict[int, tuple[int, int]], width: int) -> tuple[int, int, int]:
    """Of (weight, edits) by state the least legal end, an assistant put in where a
    user stands last: (weight of width + 1 digits, edits, the state it came from)."""
    ends = []
    for state, (weight, at) in best.items():
        weight <<= 3  # one more digit of padding
        if state in ENDS:
            ends.append((weight, at, state))
        elif state == USER:
            ends.append((weight + (COST[INSERT] << 3 * (width + 1)) + (INSERT << 3 * (width - at)), at + 1, state))
    return min(ends)


def read(weight: int, width: int) -> tuple[int, str]:
    """(cost, audit) of a weight."""
    code = weight & ((1 << 3 * width) - 1)
    return weight >> 3 * width, f"{code:o}".zfill(width).rstrip("0").translate(LETTERS) if width else ""


def apply_edits(audit: str, state: int, initials: list[str]) -> Iterator[tuple[int, str | None, str | None]]:
    """``(row, put, role)`` for every row and, where the audit ends with an insert, one
    behind them: the role inserted before the row or None; the role it gets, '' for
    its own, None where it is deleted.  ``state``: where the rows begin."""
    row, put = 0, None
    for letter in audit:
        due = DUE[state]
        if letter == "I":
            put, state = NAMES[due], MOVES[state][due]
            continue
        yield row, put, None if letter == "D" else "" if letter == "K" else NAMES[due]
        if letter != "D":
            state = MOVES[state][initials[row] if letter == "K" else due]
        row, put = row + 1, None
    if put is not None:
        yield row, put, None


# ------------------------------------------------------------- tallies
LEGAL = {"su", "ua", "au"}


def tally(initials: list[str], faults: list[int], turns: list[int | None]) -> dict:
    """Counts of rows in order, and what joining them to their neighbours needs."""
    known = [t for t in turns if t is not None]
    return {"blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), "opens": initials[0], "closes": initials[-1],
            "lo": min(known, default=None), "hi": max(known, default=None), "turns": len(set(known))}


def joined(a: dict, b: dict) -> dict:
    """The tally of two neighbouring pieces; turns ascend, so they share one at most."""
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated")}
    out["illegal"] = a["illegal"] + b["illegal"] + (a["closes"] + b["opens"] not in LEGAL)
    out["turns"] = a["turns"] + b["turns"] - (a["hi"] is not None and a["hi"] == b["lo"])
    return out | {"opens": a["opens"], "closes": b["closes"], "lo": b["lo"] if a["lo"] is None else a["lo"], "hi": a["hi"] if b["hi"] is None else b["hi"]}


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def counts(t: dict) -> dict:
    return {"gaps": 0 if t["lo"] is None else t["hi"] - t["lo"] + 1 - t["turns"]} | {k: t[k] for k in COUNTS[1:]}


def fault(text: str) -> int:
    left = text.rstrip(SPACE)
    return BLANK if not left else SOUND if left[-1] in ".!?" else TRUNCATED


def repair_whole(rows: list[tuple[int | None, str, str]]) -> dict:
    """All that is told of a conversation held at once: ``(turn, role, text)`` in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        f = fault(text)
        faults.append(DUPLICATE if f != BLANK and (role, text) in seen else f)
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    width = 2 * len(rows)
    cost, audit = read(finish(transfer(list(zip(initials, faults)))[START], width)[0], width + 1)
    roles, texts = [], []
    for i, put, role in apply_edits(audit, START, initials):
        if put is not None:
            roles.append(put)
            texts.append("")
        if role is not None:
            roles.append(role or rows[i][1])
            texts.append(rows[i][2])
    return counts(tally(initials, faults, [t for t, _, _ in rows])) | {"cost": cost, "audit": audit, "roles": roles, "texts": texts}


# ------------------------------------------------------------- Spark jobs
TALLY = "blank long, duplicate long, truncated long, illegal long, opens string, closes string, lo long, hi long, turns long"
TOLD = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
PLACE = "key string, part int, seq long"


def _map(df: DataFrame, rows_of, schema: str) -> DataFrame:
    """``df`` row by row (exact integers and nulls) through the generator ``rows_of``."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in rows_of(r for b in batches for at in range(0, b.num_rows, 1024) for r in b.slice(at, 1024).to_pylist()):
            held.append(row)
            size += 200 + sum(len(v) if isinstance(v, str) else sum(map(len, v)) if k == "texts" and v else 0 for k, v in row.items())
            if size > CHARS:
                yield pa.RecordBatch.from_pylist(held, arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, arrow)

    return df.mapInArrow(run, schema)


def _pieces(rows: Iterator[dict]) -> Iterator[dict]:
    """Conversations that lie whole inside a partition are repaired at once.  The first
    and the last one may go on next door, and long ones are not held: their rows
    come out as they are, in numbered pieces."""
    part, first = TaskContext.get().partitionId(), True

    def out(key, seq, held):
        for i, (turn, role, text) in enumerate(held):
            yield {"key": key, "part": part, "seq": seq, "i": i, "turn": turn, "role": role, "text": text, "fault": fault(text)}

    held, now, seq, size = [], None, 0, 0
    for r in rows:
        if now is not None and r["key"] != now:
            if first or seq:
                yield from out(now, seq, held)
            else:
                yield {"key": now} | repair_whole(held)
            held, seq, size, first = [], 0, 0, False
        elif len(held) == ROWS or size > CHARS:
            yield from out(now, seq, held)
            held, seq, size = [], seq + 1, 0
        now = r["key"]
        held.append((r["turn"], r["role"], r["text"]))
        size += len(r["text"])
    if now is not None:
        yield from out(now, seq, held)


def _summaries(rows: Iterator[dict]) -> Iterator[dict]:
    """Of every piece the tally and the least paths from each state to each."""
    for (key, part, seq), piece in groupby(rows, lambda r: (r["key"], r["part"], r["seq"])):
        piece = list(piece)  # ROWS at most
        initials, faults = [r["initial"] for r in piece], [r["fault"] for r in piece]
        paths = []
        for entry, best in transfer(list(zip(initials, faults)), (START, SYSTEM, USER, ASSISTANT)).items():
            for state, (weight, _) in best.items():
                cost, audit = read(weight, 2 * len(piece))
                paths.append({"entry": entry, "state": state, "cost": cost, "audit": audit})
        yield {"key": key, "part": part, "seq": seq, "initials": initials, "paths": paths} | tally(initials, faults, [r["turn"] for r in piece])


def _folds(rows: Iterator[dict]) -> Iterator[dict]:
    """The pieces of a conversation one after the other: four weights are held, and for
    every piece by which state each state was reached.  A weight is widened by
    padding, and a piece's audit goes where the path's digits end."""
    for key, pieces in groupby(rows, lambda r: r["key"]):
        best, width, back, total = {START: (0, 0)}, 0, [], None
        for p in pieces:
            more = 2 * len(p["initials"])
            found = {}
            for x in p["paths"]:
                if x["entry"] in best:
                    weight, at = best[x["entry"]]
                    code = int("0" + x["audit"].translate(DIGITS), 8) << 3 * (width + more - at - len(x["audit"]))
                    weight = (weight << 3 * more) + (x["cost"] << 3 * (width + more)) + code
                    if x["state"] not in found or weight < found[x["state"]][0]:
                        found[x["state"]] = (weight, at + len(x["audit"]), x["entry"])
            back.append((p["part"], p["seq"], {s: f[2] for s, f in found.items()}))
            best, width = {s: f[:2] for s, f in found.items()}, width + more
            total = {k: p[k] for k in ("blank", "duplicate", "truncated", "illegal", "opens", "closes", "lo", "hi", "turns")} if total is None else joined(total, p)
        weight, _, state = finish(best, width)
        cost, audit = read(weight, width + 1)
        yield {"key": key} | counts(total) | {"cost": cost, "audit": audit}
        last = state == USER
        for part, seq, came in reversed(back):
            yield {"key": key, "part": part, "seq": seq, "entry": came[state], "state": state, "last": last}
            state, last = came[state], False


def _edits(rows: Iterator[dict]) -> Iterator[dict]:
    for r in rows:
        audit = next(x["audit"] for x in r["paths"] if x["entry"] == r["entry"] and x["state"] == r["state"])
        for i, put, role in apply_edits(audit + "I" * r["last"], r["entry"], r["initials"]):
            yield {"key": r["key"], "part": r["part"], "seq": r["seq"], "i": i, "put": put, "new": role}


def _digests(rows: Iterator[dict]) -> Iterator[dict]:
    for key, lines in groupby(rows, lambda r: r["key"]):
        h = hashlib.sha256()
        for n, r in enumerate(lines):
            h.update(("\n" * (n > 0) + r["role"] + ":" + r["text"]).encode())
        yield {"key": key, "sha": h.hexdigest()}


def conversation_key(conv_col: str) -> Column:
    return F.coalesce(F.col(conv_col).cast("string"), F.lit(" "))


class Repair:
    """The cheapest repair of every conversation of ``rows`` (columns key, turn,
    role, text; no nulls but in turn).

    Rows are dealt by ranges of (key, turn, role, text hash), so a conversation of any
    length is spread; only a conversation at the edge of a range, or one of over ``ROWS``
    rows or ``CHARS`` characters, takes the longer way: duplicates by aggregation, least
    paths per piece, pieces folded in order.  What one task holds of it is its audit."""

    def __init__(self, rows: DataFrame):
        mark = F.md5("text").alias("mark")
        r = rows.select("key", "turn", "role", "text", mark, F.monotonically_increasing_id().alias("at"))
        order = ["key", F.col("turn").asc_nulls_first(), "role", "mark", "at"]
        dealt = r.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "turn", "role", "text")
        self.pieces = keep(_map(dealt, _pieces, f"{PLACE}, i int, turn long, role string, text string, fault int, {TOLD}, roles array<string>, texts array<string>"), "repair-pieces")
        self.open = self.pieces.filter("part is not null").select("key", "part", "seq", "i", "turn", "role", "text", "fault")
        self.whole = self.pieces.filter("part is null")
        place = ["key", "part", "seq"]
        said = ["key", "role", "mark"]
        o = self.open.select(*place, "i", "turn", "fault", "role", mark)
        firsts = o.groupBy(*said).agg(F.min(F.struct("part", "seq", "i")).alias("first"))
        again = (F.col("fault") != BLANK) & (F.struct("part", "seq", "i") > F.col("first"))
        o = o.join(firsts, said).select(*place, "i", "turn", F.substring("role", 1, 1).alias("initial"), F.when(again, DUPLICATE).otherwise(F.col("fault")).alias("fault"))
        paths = "paths array<struct<entry: int, state: int, cost: long, audit: string>>"
        summed = _map(o.repartition(*place).sortWithinPartitions(*place, "i"), _summaries, f"{PLACE}, initials array<string>, {paths}, {TALLY}")
        self.summaries = keep(summed, "repair-summaries")
        folded = self.summaries.repartition("key").sortWithinPartitions(*place)
        self.folds = keep(_map(folded, _folds, f"{PLACE}, entry int, state int, last boolean, {TOLD}"), "repair-folds")
        ways = self.folds.filter("part is not null").select(*place, "entry", "state", "last")
        self.edits = _map(self.summaries.select(*place, "initials", "paths").join(ways, place), _edits, f"{PLACE}, i int, put string, new string")

    def told(self) -> DataFrame:
        """``key, gaps, blank, duplicate, truncated, illegal, cost, audit``."""
        names = ["key", *COUNTS, "cost", "audit"]
        return self.whole.select(*names).unionByName(self.folds.filter("part is null").select(*names))

    def _open_rows(self) -> DataFrame:
        e = self.edits.join(self.open.select("key", "part", "seq", "i", "role", "text"), ["key", "part", "seq", "i"], "left")
        put = F.when(F.col("put").isNotNull(), F.struct(F.lit(0).alias("j"), F.col("put").alias("role"), F.lit("").alias("text")))
        own = F.when(F.col("new").isNotNull(), F.struct(F.lit(1).alias("j"), F.when(F.col("new") == "", F.col("role")).otherwise(F.col("new")).alias("role"), F.col("text").alias("text")))
        return e.select("key", "part", "seq", "i", F.explode(F.array_compact(F.array(put, own))).alias("x")).select("key", "part", "seq", "i", "x.*")

    def repaired(self) -> DataFrame:
        """``key, part, seq, i, j, role, text``: the rows after the repair, a
        conversation's in the order of the four numbers."""
        x = self.whole.select("key", F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "x"))
        x = x.select("key", F.lit(0).alias("part"), F.lit(0).cast("long").alias("seq"), "i", F.lit(1).alias("j"), F.col("x.roles").alias("role"), F.col("x.texts").alias("text"))
        return x.unionByName(self._open_rows())

    def digests(self) -> DataFrame:
        """``key, sha``: SHA-256 of the repaired lines ``role:text``.  An open
        conversation's lines stream through one task, as one digest needs them in order."""
        lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
        rest = self._open_rows().repartition("key").sortWithinPartitions("key", "part", "seq", "i", "j").select("key", "role", "text")
        return self.whole.select("key", F.sha2(lines.cast("binary"), 256).alias("sha")).unionByName(_map(rest, _digests, "key string, sha string"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``key, turn, role, text`` after the damage of the contract: nulls read as one
    space (a null turn stays null for the order), then by the CRC-32 of ``key:turn``
    modulo 20 a row is dropped, emptied, stripped of sentence ends, doubled, or
    said by the user."""
    sp = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    m = F.crc32(F.concat(conversation_key("conv_id"), F.lit(":"), sp("turn")).cast("binary")) % 20
    d = conversations.select(conversation_key("conv_id").alias("key"), F.col("turn").cast("long").alias("turn"), sp("role").alias("role"), sp("text").alias("text"), m.alias("m"))
    d = d.filter("m <> 0").withColumn("copy", F.explode(F.when(F.col("m") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("m") == 1, F.lit("")).when(F.col("m") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return d.select("key", "turn", F.when(F.col("m") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"))


def repair_digest(conversations: DataFrame) -> DataFrame:
    """The contract's row for every ``conv_id`` of ``conversations``.

    Rows of one conversation stand by turn, nulls first; rows of one turn by role and
    the text's md5; repeated rows are duplicates of each other.  A null conv_id is a
    conversation of its own.  No rows after damage: zeros, empty audit, the empty
    string's digest.  Empty table: no rows.  Other columns are not read."""
    fix = Repair(damaged(conversations))
    ids = conversations.select("conv_id", conversation_key("conv_id").alias("key")).distinct()
    zero = {"audit": F.lit("")}
    out = ids.join(fix.told(), "key", "left").join(fix.digests(), "key", "left")
    return out.select("conv_id", *[F.coalesce(c, zero.get(c, F.lit(0))).alias(c) for c in (*COUNTS, "cost", "audit")],
                      F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digest(table(spark, sf_dir, "conversations"))


_DUE = "CASE st WHEN 'u' THEN 'a' ELSE 'u' END"
_NAME = "CASE st WHEN 'u' THEN 'assistant' ELSE 'user' END"
ORACLE = f"""
WITH RECURSIVE d AS (SELECT coalesce(conv_id::VARCHAR, ' ') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
m AS (SELECT *, {crc32_sql("k || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS m FROM d),
x AS (SELECT k, turn, CASE m WHEN 4 THEN 'user' ELSE role END AS role,
   CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
   FROM m, range(2) c(copy) WHERE m <> 0 AND (copy = 0 OR m = 3)),
y AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM x),
o AS (SELECT *, row_number() OVER (PARTITION BY k, role, text ORDER BY i) AS said, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS e FROM y),
f AS (SELECT k, i, turn, role, text, substr(role, 1, 1) AS c, CASE WHEN e = '' THEN 'b' WHEN said > 1 THEN 'd' WHEN e NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS f FROM o),
p(k, i, st, v) AS (
  SELECT DISTINCT k, 0::BIGINT, '', {{'c': 0::BIGINT, 'a': '', 'l': ''}} FROM f
  UNION ALL
  SELECT k, i, st, min(v) FROM (
    SELECT k, i, z.st AS st, z.v AS v FROM (
      SELECT q.k, q.i, unnest([
        CASE WHEN NOT q.put THEN {{'st': q.st, 'v': {{'c': q.v.c + 4, 'a': q.v.a || 'D', 'l': q.v.l}}}} END,
        CASE WHEN q.f NOT IN ('b', 'd') AND ((q.st = '' AND q.c IN ('s', 'u')) OR (q.st IN ('s', 'a') AND q.c = 'u') OR (q.st = 'u' AND q.c = 'a'))
          THEN {{'st': q.c, 'v': {{'c': q.v.c + q.more, 'a': q.v.a || 'K', 'l': q.v.l || q.role || ':' || q.text || chr(10)}}}} END,
        CASE WHEN q.f NOT IN ('b', 'd') THEN {{'st': {_DUE.replace("st", "q.st")}, 'v': {{'c': q.v.c + q.more + 3, 'a': q.v.a || 'R',
          'l': q.v.l || {_NAME.replace("st W", "q.st W")} || ':' || q.text || chr(10)}}}} END]) AS z
      FROM (SELECT f.k, f.i, f.c, f.f, f.role, f.text, CASE f.f WHEN 't' THEN 3 ELSE 0 END AS more, y.st, y.v, y.put FROM f JOIN (
        SELECT k, i, st, v, false AS put FROM p UNION ALL
        SELECT k, i, {_DUE} AS st, {{'c': v.c + 3, 'a': v.a || 'I', 'l': v.l || {_NAME} || ':' || chr(10)}} AS v, true AS put FROM p) y
        ON f.k = y.k AND f.i = y.i + 1) q) WHERE z IS NOT NULL)
  GROUP BY k, i, st),
n AS (SELECT k, max(i) AS n, count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
   coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM f GROUP BY k),
g AS (SELECT k, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT k, lag(c) OVER (PARTITION BY k ORDER BY i) || c AS pair FROM f) GROUP BY k),
z AS (SELECT p.k, min(CASE WHEN st = 'u' THEN {{'c': v.c + 3, 'a': v.a || 'I', 'l': v.l || 'assistant:' || chr(10)}} ELSE v END) AS v FROM p JOIN n ON p.k = n.k AND p.i = n.n WHERE st <> 's' GROUP BY p.k)
SELECT u.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
   coalesce(illegal, 0) AS illegal, coalesce(v.c, 0) AS cost, coalesce(v.a, '') AS audit, sha256(coalesce(v.l[:length(v.l) - 1], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) u LEFT JOIN n ON coalesce(u.conv_id::VARCHAR, ' ') = n.k LEFT JOIN g ON n.k = g.k LEFT JOIN z ON n.k = z.k
"""
