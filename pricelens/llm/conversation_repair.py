"""Cheapest repair of a conversation's turn structure.

Rows of a conversation are judged in Spark: blank, copy of an earlier one, cut
off.  A conversation then is a string of two letters a row (role initial and
fault), over which an iterative-deepening A* looks for the cheapest edits that
leave ``system? (user assistant)+`` or nothing.  Every round is a depth-first
search in the ASCII order of the edits under a bound on cost plus a lower bound
of what is left; places that failed with at least as much left to spend are not
entered again.  The first accepting path of the first bound that has one is the
cheapest, and of the cheapest the least in ASCII order.

The search sees no texts.  Its edits are joined back as one row in front of the
conversation's rows, in a sorted stream that writes the repaired rows one by
one, so memory holds two letters and one edit a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, settle

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
#: What may follow, as (initial, state after): nothing yet, after the system turn, after a user turn, after an assistant turn.
LEGAL = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTING = (0, 3)
LEGAL_PAIRS = ("su", "ua", "au")
FAR = 1 << 60


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after the damage that crc32 of ``conv_id:turn`` names, and one row with
    ``here`` false for every conversation.

    A null is one space: in the hash, as role and as text.  0 of 20 drops the
    row, 1 empties its text, 2 takes its sentence ends out, 3 repeats it and 4
    makes it a user's.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    what = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(what == 1, "").when(what == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    rows = conversations.select("conv_id", "turn", F.when(what == 4, USER).otherwise(shown("role")).alias("role"), text.alias("text"), what.alias("what"))
    hit = rows.where("what <> 0").select("conv_id", "turn", "role", "text", F.explode(F.when(F.col("what") == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(F.lit(True)))).alias("here"))
    every = conversations.select("conv_id").distinct()
    return hit.unionByName(every, allowMissingColumns=True).withColumn("here", F.coalesce("here", F.lit(False)))


def body() -> Column:
    """Digest of role and text."""
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))


def judged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, letter, n): equal rows of a turn as one with their number.

    ``letter`` says b for blank, x for a
    copy of an earlier row, t for cut off and k for none of them; of equal rows
    of one turn the first may be k or t and the others are copies.
    """
    words = F.col("text").rlike(f"[^{SPACE_CLASS[1:-1]}]")
    ends_well = F.col("text").rlike(r"[.!?]" + SPACE_CLASS + r"*\z")
    slim = rows.select("conv_id", "turn", "role", body().alias("body"), F.when(~words, "b").when(~ends_well, "t").otherwise("k").alias("letter"))
    per_turn = slim.groupBy("conv_id", "turn", "role", "body", "letter").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("conv_id", "body").orderBy(F.col("turn").asc_nulls_first())
    again = (F.row_number().over(order) > 1) & (F.col("letter") != "b")
    return per_turn.withColumn("letter", F.when(again, "x").otherwise(F.col("letter")))


def lower_bounds(letters: str) -> list[tuple[int, int, int]]:
    """For every place a bound on what the rest costs: with nothing said yet, with a user or an assistant turn next.

    The bound is exact for a looser goal, under which any place may be the last.
    """
    begin = user = assistant = 0
    out = [(begin, user, assistant)]
    for i in range(len(letters) - 2, -1, -2):
        initial, fault = letters[i], letters[i + 1]
        costs = [DELETE + begin, DELETE + user, DELETE + assistant]
        if fault in "kt":
            extra = CUT_OFF if fault == "t" else 0
            spoken = [extra + (KEEP if initial == "u" else REROLE) + assistant, extra + (KEEP if initial == "a" else REROLE) + user]
            costs = [min(costs[0], spoken[0]), min(costs[1], spoken[0]), min(costs[2], spoken[1])]
            if initial == "s":
                costs[0] = min(costs[0], extra + KEEP + user)
        # a turn put in front of the row
        begin, user, assistant = min(costs[0], INSERT + costs[2]), min(costs[1], INSERT + costs[2]), min(costs[2], INSERT + costs[1])
        out.append((begin, user, assistant))
    return out[::-1]


#: The bound that holds in each state.
BOUND_OF = (0, 1, 2, 1)


def steps(letters: str, place: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits at a place in ASCII order: initial of the edit, its cost, place and state after."""
    here = 2 * place < len(letters)
    initial, fault = (letters[2 * place], letters[2 * place + 1]) if here else ("", "")
    turn = LEGAL[state].get("a" if state == 2 else "u")
    if here:
        yield "D", DELETE, place + 1, state
    yield "I", INSERT, place, turn
    if here and fault in "kt":
        extra = CUT_OFF if fault == "t" else 0
        if initial in LEGAL[state]:
            yield "K", KEEP + extra, place + 1, LEGAL[state][initial]
        yield "R", REROLE + extra, place + 1, turn


def search(letters: str) -> tuple[int, str]:
    """Cost and edits of the cheapest repair, the least in ASCII order among equals.

    ``letters`` names a row by two: its role's initial and its fault.
    """
    bounds = lower_bounds(letters)
    end = len(letters) // 2

    def least(place: int, state: int) -> int:
        return bounds[place][BOUND_OF[state]]

    bound = least(0, 0)
    while True:
        failed: dict[int, int] = {}  # most that was left to spend where the search found no way
        beyond = FAR
        # an open place: (place, state, spent, its edits to come)
        path = [(0, 0, 0, steps(letters, 0, 0))]
        edits: list[str] = []
        while path:
            place, state, spent, rest = path[-1]
            if place == end and state in ACCEPTING:
                return spent, "".join(edits)
            for edit, cost, to, then in rest:
                total = spent + cost
                if total + least(to, then) > bound:
                    beyond = min(beyond, total + least(to, then))
                elif failed.get(4 * to + then, -1) < bound - total:
                    path.append((to, then, total, steps(letters, to, then)))
                    edits.append(edit)
                    break
            else:
                failed[4 * place + state] = bound - spent
                path.pop()
                if edits:
                    edits.pop()
        bound = beyond


AUDIT = "conv_id long, no_id boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def found(rows: DataFrame) -> DataFrame:
    """AUDIT of every conversation, from its letters in order of turn."""
    order = ["no_id", "conv_id", F.col("here"), F.col("turn").asc_nulls_first(), "role", "body"]

    def audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        letters: list[str] = []
        turns: list[int] = []  # least, last, how many different
        done: list[tuple] = []

        def close() -> None:
            text = "".join(letters)
            initials, faults = text[::2], text[1::2]
            cost, audit = search(text)
            legal = sum(initials[i: i + 2] in LEGAL_PAIRS for i in range(len(initials) - 1))
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
            done.append((*now, gaps, faults.count("b"), faults.count("x"), faults.count("t"), max(0, len(initials) - 1) - legal, cost, audit))

        def emit() -> pa.RecordBatch:
            cols = [[r[i] for r in done] for i in range(9)]
            types = (pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.string())
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [c.split()[0] for c in AUDIT.split(", ")])

        for batch in batches:
            for conv, no_id, here, turn, initial, letter, n in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "no_id", "here", "turn", "initial", "letter", "n")]):
                if (conv, no_id) != now:
                    if now is not None:
                        close()
                        if len(done) >= 2000:
                            yield emit()
                    now, letters, turns = (conv, no_id), [], []
                if not here:
                    continue
                # a role without initial takes a letter of its own, like any unknown one
                letters.append((initial or " ") + letter)
                letters.extend([(initial or " ") + ("b" if letter == "b" else "x")] * (n - 1))
                if turn is not None:
                    turns = [turns[0], turn, turns[2] + (turn != turns[1])] if turns else [turn, turn, 1]
        if now is not None:
            close()
            yield emit()

    keyed = judged(rows.where("here")).select("conv_id", F.lit(True).alias("here"), "turn", "role", "body", F.substring("role", 1, 1).alias("initial"), "letter", "n")
    every = rows.where("NOT here").select("conv_id", "here")
    both = keyed.unionByName(every, allowMissingColumns=True).withColumn("no_id", F.col("conv_id").isNull())
    return both.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(audited, AUDIT)


def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Read each conversation's audit, then its rows, and apply the edits.

    Yields ("start", audit row), ("turn", role, text, number or None) for every
    turn that is left, and ("stop",).
    """
    names = [f.split()[0] for f in AUDIT.split(", ")]
    audit, at, state, began = "", 0, 0, False

    def put_in() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            yield "turn", ASSISTANT if state == 2 else USER, "", None
            state = 3 if state == 2 else 2
            at += 1

    for batch in batches:
        rows = zip(*[batch.column(c).to_pylist() for c in (*names, "here", "turn", "role")])
        for (*head, here, turn, role), text in zip(rows, batch.column("text")):
            if not here:
                if began:
                    yield from put_in()
                    yield ("stop",)
                audit, at, state, began = head[-1], 0, 0, True
                yield "start", tuple(head)
                continue
            yield from put_in()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                role = ASSISTANT if state == 2 else USER
            state = LEGAL[state][role[0]]
            yield "turn", role, text.as_py(), turn
    if began:
        yield from put_in()
        yield ("stop",)


def edited(rows: DataFrame, write, schema: str) -> DataFrame:
    """Rows that ``write`` makes of the events of ``walked``, a bounded number held at a time."""
    audits = settle(found(rows), "audits").withColumn("here", F.lit(False))
    texts = rows.where("here").withColumns({"no_id": F.col("conv_id").isNull(), "body": body()})
    both = texts.unionByName(audits, allowMissingColumns=True)
    laid = both.repartition("conv_id").sortWithinPartitions("no_id", "conv_id", "here", F.col("turn").asc_nulls_first(), "role", "body")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        size = 0
        for row in write(walked(batches)):
            done.append(row)
            size += sum(len(x) for x in row if isinstance(x, str)) + 100
            if size > 1 << 20:
                yield _batch(done, schema)
                done, size = [], 0
        yield _batch(done, schema)

    return laid.mapInArrow(written, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conversation.

    ``rows`` are those of ``damaged``.  A conversation's rows stand in order of
    turn, nulls first, then role, then digest of role and text; a row's first
    fault counts.  All rows without a conv_id are one conversation.  A
    conversation without rows has zeros, no edits and the digest of nothing.  A
    role that does not begin with s, u or a can only be changed or go.  Other
    columns are ignored; an empty table gives no rows.

    A conversation's texts pass through one task, because its digest is one
    chain, but are not held there; the search holds two letters a row.
    """
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def digests(events: Iterator[tuple]) -> Iterator[tuple]:
        head, digest, first = (), hashlib.sha256(), True
        for kind, *of in events:
            if kind == "start":
                head, digest, first = of[0], hashlib.sha256(), True
            elif kind == "turn":
                digest.update(("" if first else "\n").encode() + f"{of[0]}:{of[1]}".encode())
                first = False
            else:
                yield (head[0], *head[2:], digest.hexdigest())

    return edited(rows, digests, schema)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text): the turns that the repair leaves, ``place`` from 0.

    A turn that was put in has no number and an empty text.  A conversation that
    loses all its turns has no row.  Otherwise the cases of ``repaired``.
    """

    def turns(events: Iterator[tuple]) -> Iterator[tuple]:
        conv, place = None, 0
        for kind, *of in events:
            if kind == "start":
                conv, place = of[0][0], 0
            elif kind == "turn":
                yield conv, place, of[2], of[0], of[1]
                place += 1

    return edited(rows, turns, "conv_id long, place long, turn long, role string, text string")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[t]) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])


REPAIR_SQL = r"""
WITH RECURSIVE shown AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS named FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                  flatten(list_transform(string_split(named, ''), lambda ch: list_transform(range(8), lambda i: CAST((ascii(ch) >> CAST(i AS INTEGER)) & 1 AS BIGINT))))),
                  lambda c, bit: xor(c >> 1, CAST(3988292384 AS BIGINT) * (xor(c, bit) & 1))), CAST(4294967295 AS BIGINT)) % 20 AS what FROM shown),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN what = 1 THEN '' WHEN what = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN what = 3 THEN 2 ELSE 1 END)) AS again
  FROM hashed WHERE what <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS n FROM rows_),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'x'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE 'k' END AS fault, substr(role, 1, 1) AS initial,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) || substr(role, 1, 1) AS pair FROM placed),
convs AS (SELECT DISTINCT conv_id FROM conversations),
counts AS (
  SELECT c.conv_id, count(f.n) AS n_rows, coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'x') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM convs c LEFT JOIN faults f ON c.conv_id IS NOT DISTINCT FROM f.conv_id GROUP BY c.conv_id),
-- cheapest (cost, edits, text) that ends after nothing, a system, a user, an assistant turn: before and after turns put in
ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, [{'cost': 0, 'edits': '', 'out': ''}, {'cost': 1000000, 'edits': '', 'out': ''}, {'cost': 1000000, 'edits': '', 'out': ''}, {'cost': 1000000, 'edits': '', 'out': ''}] AS w FROM convs
  UNION ALL
  SELECT conv_id, n, [
    {'cost': p[1].cost + 2, 'edits': p[1].edits || 'D', 'out': p[1].out},
    list_min([{'cost': p[2].cost + 2, 'edits': p[2].edits || 'D', 'out': p[2].out},
              {'cost': p[1].cost + CASE WHEN initial = 's' THEN here ELSE 1000000 END, 'edits': p[1].edits || 'K', 'out': p[1].out || kept}]),
    list_min([{'cost': p[3].cost + 2, 'edits': p[3].edits || 'D', 'out': p[3].out},
              {'cost': before_user.cost + CASE WHEN initial = 'u' THEN here ELSE 1000000 END, 'edits': before_user.edits || 'K', 'out': before_user.out || kept},
              {'cost': before_user.cost + 1 + here, 'edits': before_user.edits || 'R', 'out': before_user.out || chr(10) || 'user:' || text}]),
    list_min([{'cost': p[4].cost + 2, 'edits': p[4].edits || 'D', 'out': p[4].out},
              {'cost': p[3].cost + CASE WHEN initial = 'a' THEN here ELSE 1000000 END, 'edits': p[3].edits || 'K', 'out': p[3].out || kept},
              {'cost': p[3].cost + 1 + here, 'edits': p[3].edits || 'R', 'out': p[3].out || chr(10) || 'assistant:' || text}])]
  FROM (SELECT *, list_min([p[1], p[2], p[4]]) AS before_user FROM (
    SELECT *, [w[1], w[2], u, list_min([w[4], {'cost': u.cost + 5, 'edits': u.edits || 'I', 'out': u.out || chr(10) || 'assistant:'}])] AS p FROM (
      SELECT ways.conv_id, f.n, f.initial, f.text, chr(10) || f.role || ':' || f.text AS kept,
             CASE f.fault WHEN 'k' THEN 0 WHEN 't' THEN 5 ELSE 1000000 END AS here, w,
             list_min([w[3], {'cost': list_min([w[1], w[2], w[4]]).cost + 5, 'edits': list_min([w[1], w[2], w[4]]).edits || 'I',
                              'out': list_min([w[1], w[2], w[4]]).out || chr(10) || 'user:'}]) AS u
      FROM ways JOIN faults f ON ways.conv_id IS NOT DISTINCT FROM f.conv_id AND f.n = ways.n + 1)))),
ended AS (
  SELECT c.conv_id, list_min([w[1], w[4], {'cost': u.cost + 5, 'edits': u.edits || 'I', 'out': u.out || chr(10) || 'assistant:'}]) AS best FROM (
    SELECT *, list_min([w[3], {'cost': list_min([w[1], w[2], w[4]]).cost + 5, 'edits': list_min([w[1], w[2], w[4]]).edits || 'I',
                               'out': list_min([w[1], w[2], w[4]]).out || chr(10) || 'user:'}]) AS u FROM ways) e
  JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id AND c.n_rows = e.n)
SELECT c.conv_id, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, CAST(e.best.cost AS BIGINT) AS cost, e.best.edits AS audit, sha256(substr(e.best.out, 2)) AS repaired_sha256
FROM counts c JOIN ended e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
