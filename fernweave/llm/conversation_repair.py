"""Conversation structure repair by error-correcting Earley parsing.

Roles of a conversation shall follow an optional system turn with pairs of user
and assistant turns, or be none. A weighted grammar says so, and has productions
for errors too: a row may be deleted (4), may stand for a user or assistant turn
(3), and an empty turn may be inserted (3). Items of the Earley chart keep their
least (cost, audit), the audit being the edits' initials in order; the completed
items of the last column give the repair. Two derivations of one symbol over the
same rows that cost the same have audits of which neither begins with the other
(the longer would have insertions more, hence cost more), so the least audit of
a whole is made of least audits of its parts.

How the work is dealt: all decisions are made on light rows without texts (a
number for each row's fault and role). They are sorted by conversation over
range partitions, so that one very long conversation is many partitions' work;
conversations inside a partition are parsed there, pieces of others (at most
``PIECE`` rows) for each state they may begin and end in, and then composed. In
the last step a conversation's texts come sorted, one by one, with the audit
before them, through one task, as its digest is over all of them in order; that
task holds the audit, a byte a row, and no texts.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernweave.llm.common import Scratch, bounded_batches, held, table

#: Costs of edits and of a truncated row that stays (fixed by the contract).
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: Rows of a piece of a conversation that is parsed at once, and parses that a worker remembers.
PIECE, REMEMBERED = 512, 50_000
#: White space of the contract, and ends of complete texts.
SPACE, ENDS = " \t\n\v\f\r", ".!?"

#: What a conversation has become so far: the states of the grammar.
STATES = ["Begin", "Opened", "Asked", "Answered"]
#: Left side, right side, cost, initial. Small letters are terminals: a role's initial, any row that may stay, any row.
RULES = [
    ("Begin", ("Begin", "Gone"), 0, ""),
    ("Opened", ("Begin", "System"), 0, ""),
    ("Opened", ("Opened", "Gone"), 0, ""),
    ("Asked", ("Begin", "User"), 0, ""),
    ("Asked", ("Opened", "User"), 0, ""),
    ("Asked", ("Answered", "User"), 0, ""),
    ("Asked", ("Asked", "Gone"), 0, ""),
    ("Answered", ("Asked", "Assistant"), 0, ""),
    ("Answered", ("Answered", "Gone"), 0, ""),
    ("System", ("s",), 0, "K"),
    ("User", ("u",), 0, "K"),
    ("User", ("row",), REROLE, "R"),
    ("User", (), INSERT, "I"),
    ("Assistant", ("a",), 0, "K"),
    ("Assistant", ("row",), REROLE, "R"),
    ("Assistant", (), INSERT, "I"),
    ("Gone", ("any",), DELETE, "D"),
    *((state, (), 0, "") for state in STATES),  # where a piece begins; only that of the given state is used
]
SEEDS = {state: len(RULES) - len(STATES) + i for i, state in enumerate(STATES)}
BY_LEFT = {left: [i for i, r in enumerate(RULES) if r[0] == left and i not in SEEDS.values()] for left, *_ in RULES}

Weight = tuple[int, str]


def fits(terminal: str, row: str) -> bool:
    """Rows are ``d`` (must go) or ``s``, ``u``, ``a``, ``x`` (any other role), in capitals if truncated."""
    return terminal == "any" or (row != "d" if terminal == "row" else row.lower() == terminal)


def parse(rows: str, begin: str) -> dict[str, Weight]:
    """Least (cost, audit) of each state that the rows can lead to from ``begin``."""
    chart: list[dict[tuple, Weight]] = [{} for _ in range(len(rows) + 1)]
    waiting: list[defaultdict] = [defaultdict(set) for _ in chart]
    for state in STATES:
        for i in BY_LEFT[state]:
            chart[0][i, 0, 0] = 0, ""
    chart[0][SEEDS[begin], 0, 0] = 0, ""
    for j, column in enumerate(chart):
        agenda, empty = list(column), {}

        def add(item: tuple, weight: Weight, column=column, agenda=agenda) -> None:
            if item not in column or weight < column[item]:
                column[item] = weight
                agenda.append(item)

        while agenda:
            rule, dot, origin = item = agenda.pop()
            left, right, price, initial = RULES[rule]
            cost, audit = column[item]
            if dot == len(right):
                done = cost + price, audit + initial
                if origin == j and (left not in empty or done < empty[left]):
                    empty[left] = done
                for r, d, o in list(waiting[origin][left]):
                    c, a = chart[origin][r, d, o]
                    add((r, d + 1, o), (c + done[0], a + done[1]))
            elif right[dot] in BY_LEFT:
                waiting[j][right[dot]].add(item)
                for i in BY_LEFT[right[dot]] if right[dot] not in STATES else ():
                    add((i, 0, j), (0, ""))
                if right[dot] in empty:
                    c, a = empty[right[dot]]
                    add((rule, dot + 1, origin), (cost + c, audit + a))
            elif j < len(rows) and fits(right[dot], rows[j]):
                weight = cost + (TRUNCATED if rows[j].isupper() and right[dot] != "any" else 0), audit
                chart[j + 1][rule, dot + 1, origin] = min(weight, chart[j + 1].get((rule, dot + 1, origin), weight))
    found: dict[str, Weight] = {}
    for (rule, dot, origin), weight in chart[-1].items():
        left, right, *_ = RULES[rule]
        if left in STATES and dot == len(right) and origin == 0 and (rule not in SEEDS.values() or not rows):
            found[left] = min(weight, found.get(left, weight))
    return found


def best(found: dict[str, Weight]) -> Weight:
    """The repair: nothing is left, or pairs are complete."""
    return min(found[s] for s in ("Begin", "Answered") if s in found)


def whole(rows: str) -> Weight:
    """The repair of a whole conversation; workers remember those of short ones."""
    known = held(("conversation_repair", "parses"), dict)
    if rows not in known:
        if len(known) >= REMEMBERED:
            known.clear()
        found = best(parse(rows, "Begin"))
        if len(rows) > 32:
            return found
        known[rows] = found
    return known[rows]


Piece = dict[tuple[str, str], Weight]


def piece(rows: str) -> Piece:
    """Least (cost, audit) of the rows for each state before and after them."""
    return {(p, q): w for p in STATES for q, w in parse(rows, p).items()}


def composed(one: Piece, two: Piece) -> Piece:
    out: Piece = {}
    for (p, q), (c, a) in one.items():
        for (r, s), (d, b) in two.items():
            if q == r:
                cost = c + d
                if (p, s) not in out or cost <= out[p, s][0]:
                    out[p, s] = min((cost, a + b), out.get((p, s), (cost + 1, "")))
    return out


def all_composed(pieces: list[Piece]) -> Piece:
    """Pieces composed pairwise, so that a long audit is copied a few times only."""
    while len(pieces) > 1:
        pieces = [reduce(composed, pieces[i : i + 2]) for i in range(0, len(pieces), 2)]
    return pieces[0]


#: The order of a conversation's rows.
ORDER = ["turn", "role", "key"]


def light_rows(df: DataFrame) -> DataFrame:
    """Distinct rows (``conv``, ``turn``, ``role``, ``key``, a hash of conversation, role and text) with ``n`` copies and faults."""
    kept = F.rtrim("text", F.lit(SPACE))
    told = df.select("conv", *ORDER, "n", (kept == "").alias("blank"), (~F.right(kept, F.lit(1)).isin(*ENDS)).alias("cut"))
    return told.groupBy("conv", *ORDER, "blank", "cut").agg(F.sum("n").alias("n"))


def keyed(df: DataFrame, conv: str, turn: str, role: str, text: str, n: Column) -> DataFrame:
    """The rows that the operator works on; nulls in role and text are one space."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit(" ")) for c in (role, text))
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{conv}`").cast("string")), F.lit(""))
    told = F.concat(F.length(name), F.lit(":"), F.length(role), F.lit(":"), name, role, text)
    key = F.substring(F.unhex(F.sha2(told.cast("binary"), 256)), 1, 16)
    return df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), role.alias("role"), text.alias("text"), key.alias("key"), n.cast("long").alias("n"))


def marked_rows(light: DataFrame) -> DataFrame:
    """Light rows with ``later``: the same role and text stand at an earlier turn of the conversation."""
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = light.where("n > 0").groupBy(F.col("key").alias("k")).agg(F.min(at).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    joined = light.where("n > 0").join(first, light["key"] == F.col("k"), "left")
    return joined.select("conv", *ORDER, "n", "blank", "cut", F.coalesce(at > F.col("first"), F.lit(False)).alias("later"))


def counts(light: DataFrame) -> DataFrame:
    """Numbers of each conversation, in rows that add up: missing turns, and faulty rows by their first fault."""
    turn = F.when(F.col("n") > 0, F.col("turn"))
    gaps = light.groupBy("conv").agg(F.coalesce(F.max(turn) - F.min(turn) + 1 - F.countDistinct(turn), F.lit(0)).alias("gaps"))
    texts = light.where("n > 0").groupBy("conv", "key", "blank", "cut").agg(F.sum("n").alias("n"))
    faults = texts.groupBy("conv").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.sum((F.col("cut") & ~F.col("blank")).cast("long")).alias("truncated"),
    )
    return gaps.unionByName(faults, allowMissingColumns=True)


def parsed(marked: DataFrame) -> DataFrame:
    """``conv``, ``cost`` and ``audit`` of each conversation with rows."""
    order = [F.col("conv"), *(F.col(c).asc_nulls_first() for c in ORDER)]
    sorted_rows = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    conv = marked.schema["conv"]
    pieces = T.StructType(
        [conv, T.StructField("at", T.LongType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("ends", T.ArrayType(T.StringType()))]
        + [T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out, now, rows, is_whole, kind = TaskContext.get().partitionId() << 32, [], None, [], False, None

        def put(last: bool) -> None:
            """Conversations that touch neither the partition's ends nor a cut are whole."""
            nonlocal at
            if now is None:
                return
            text = "".join(rows)
            if is_whole and not last:
                out.append((now[0], at, *whole(text), None, None, None))
            else:
                found = piece(text)
                out.append((now[0], at, None, None, [f"{p} {q}" for p, q in found], [c for c, _ in found.values()], [a for _, a in found.values()]))
            at += 1

        def batch_of() -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.string())]
            columns = list(zip(*out, strict=True)) if out else [[]] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=pieces.names)

        begun = False
        for batch in batches:
            kind = batch.schema.field("conv").type
            columns = [batch.column(c).to_pylist() for c in ("conv", "role", "n", "blank", "cut", "later")]
            for c, role, n, blank, cut, later in zip(*columns, strict=True):
                if now is None or now[0] != c:
                    put(False)
                    now, rows, is_whole, begun = (c,), [], begun, True
                letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
                symbols = "d" * n if blank or later else (letter.upper() if cut else letter) + "d" * (n - 1)
                for i in range(0, len(symbols), PIECE):
                    if sum(map(len, rows[-1:])) and len(rows) + len(symbols[i : i + PIECE]) > PIECE:
                        is_whole = False
                        put(True)
                        rows = []
                    rows.extend(symbols[i : i + PIECE])
            if len(out) >= 1000:
                yield batch_of()
                out.clear()
        put(True)
        if kind is not None:
            yield batch_of()

    found = sorted_rows.select("conv", "role", "n", "blank", "cut", "later").mapInArrow(run, pieces)

    def combine(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        read = [
            {tuple(e.split(" ")): (c, a) for e, c, a in zip(*r, strict=True)}
            for r in zip(*(group.column(c).to_pylist() for c in ("ends", "costs", "audits")), strict=True)
        ]
        cost, audit = best({q: w for (p, q), w in all_composed(read).items() if p == "Begin"})
        return pa.table([group.column("conv").slice(0, 1), pa.array([cost], pa.int64()), pa.array([audit], pa.string())], ["conv", "cost", "audit"])

    return found, lambda written: written.where("ends is null").select("conv", "cost", "audit").union(
        written.where("ends is not null").groupBy("conv").applyInArrow(combine, T.StructType([conv, pieces["cost"], pieces["audit"]]))
    )


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class Repair:
    """One conversation as its rows come by: numbers, and the repaired text or its digest."""

    def __init__(self, conv, digest: bool):
        self.conv, self.numbers, self.audit, self.at, self.turn, self.before = conv, dict.fromkeys(NUMBERS, 0), "", 0, 0, None
        self.sha, self.lines = hashlib.sha256(), None if digest else []
        self.empty = True

    def line(self, role: str, text: str) -> None:
        if self.lines is not None:
            self.lines.append(f"{role}:{text}")
        else:
            self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def said(self, text: str) -> None:
        self.line("user" if self.turn == 0 else "assistant", text)
        self.turn ^= 1

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.said("")
            self.at += 1

    def row(self, role: str, text: str, n: int) -> None:
        for _ in range(n):
            if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
                self.numbers["illegal"] += 1
            self.before = role[:1]
            self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "R":
                self.said(text)
            elif edit == "K":
                self.line(role, text)
                if role[:1] != "s":
                    self.turn ^= 1

    def result(self) -> tuple:
        self.inserted()
        return (self.conv, *self.numbers.values(), self.audit, self.sha.hexdigest() if self.lines is None else "\n".join(self.lines))


def repaired(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", n: Column | None = None, digest: bool = False) -> DataFrame:
    """One row a conversation: numbers of faults, cost and audit of the cheapest repair, and the repaired text.

    ``n`` is how often each row stands there (default once; a conversation whose
    rows all have 0 comes out with zeros). Rows are taken by turn, those without
    one first; rows of one turn by role, then by a hash of their text. Nulls in
    role and text are one space; a null id is a conversation of its own. Equal
    rows stand next to each other and all but one are duplicates. A row of
    an empty role can only be given another or go. Columns: the id, ``gaps`` (turns missing
    between the first and last), ``blank``, ``duplicate`` and ``truncated`` (rows
    by their first fault), ``illegal`` (neighbouring roles that may not follow
    each other), ``cost``, ``audit`` and ``repaired`` (lines of ``role:text``,
    or their SHA-256 if ``digest``). Other columns are not read. An empty table
    gives an empty one. Very long texts come in batches of bounded bytes.
    """
    bounded_batches(df.sparkSession)
    scratch = Scratch(df.sparkSession)
    rows = keyed(df, conv, turn, role, text, F.lit(1) if n is None else n)
    light = scratch.written(light_rows(rows))
    found, finish = parsed(scratch.written(marked_rows(light)))
    audits = finish(scratch.written(found))
    stream = counts(light).withColumn("kind", F.lit(0))
    stream = stream.unionByName(audits.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    texts = rows.where("n > 0").withColumn("kind", F.lit(2))
    stream = stream.unionByName(texts, allowMissingColumns=True)
    order = [F.col("conv"), F.col("kind"), *(F.col(c).asc_nulls_first() for c in ORDER)]
    stream = stream.repartition("conv").sortWithinPartitions(*order)
    key = rows.schema["conv"]
    schema = T.StructType([key, *(T.StructField(c, T.LongType()) for c in NUMBERS), T.StructField("audit", T.StringType()), T.StructField("repaired", T.StringType())])
    given = ["gaps", "blank", "duplicate", "truncated", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kind = None, None

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            types = [kind, *[pa.int64()] * len(NUMBERS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)

        for batch in batches:
            kind, out = batch.schema.field("conv").type, []
            columns = [batch.column(c).to_pylist() for c in ("conv", "kind", "audit", "role", "text", "n", *given)]
            for c, what, audit, role, text, n, *numbers in zip(*columns, strict=True):
                if now is None or now.conv != c:
                    if now is not None:
                        out.append(now.result())
                    now = Repair(c, digest)
                if what == 2:
                    now.row(role, text, n)
                    continue
                for name, number in zip(given, numbers, strict=True):
                    now.numbers[name] += number or 0
                now.audit = audit or now.audit
            if out:
                yield batch_of(out)
        if now is not None:
            yield batch_of([now.result()])

    out = stream.select("conv", "kind", "audit", "role", "text", "n", *given).mapInArrow(run, schema)
    return out.withColumnRenamed("conv", conv)


def damaged(df: DataFrame) -> tuple[DataFrame, Callable]:
    """The damage of the query, by CRC-32 of ``conv_id:turn`` mod 20, with ``copies`` of each row; nulls are one space."""
    name, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    h = F.crc32(F.concat(name, F.lit(":"), turn).cast("binary")) % 20
    return df.select(
        "conv_id",
        "turn",
        F.when(h == 4, "user").otherwise(role).alias("role"),
        F.when(h == 1, "").when(h == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("copies"),
    )


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    found = repaired(damaged(table(spark, sf_dir, "conversations")), n=F.col("copies"), digest=True)
    return found.withColumnRenamed("repaired", "repaired_sha256")


#: The same by shortest paths over (rows read, state), rows of one turn by role and text.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT conv_id, coalesce('=' || conv_id::VARCHAR, '') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
           lambda acc, c: list_reduce(list_prepend(xor(acc, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, (a & 1) * 3988292384)))) % 20 AS h
  FROM conversations
), e AS (
  SELECT k, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM d
), n AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM e
), f AS (
  SELECT *, left(role, 1) AS initial, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last, row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 AS again,
         lag(left(role, 1)) OVER (PARTITION BY k ORDER BY i) AS before
  FROM n
), r AS (
  SELECT *, last = '' AS blank, last <> '' AND again AS duplicate, last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS truncated FROM f
), counts AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM r GROUP BY k
), inserts(p, q, ins, cost) AS (
  VALUES (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 3), (1, 2, 'I', 3), (3, 2, 'I', 3), (2, 3, 'I', 3), (0, 3, 'II', 6), (1, 3, 'II', 6), (3, 3, 'II', 6), (2, 2, 'II', 6)
), moves(q, initial, t, edit, cost) AS (
  VALUES (0, 's', 1, 'K', 0), (0, 'u', 2, 'K', 0), (1, 'u', 2, 'K', 0), (3, 'u', 2, 'K', 0), (2, 'a', 3, 'K', 0), (0, NULL, 2, 'R', 3), (1, NULL, 2, 'R', 3), (3, NULL, 2, 'R', 3), (2, NULL, 3, 'R', 3),
         (0, NULL, 0, 'D', 4), (1, NULL, 1, 'D', 4), (2, NULL, 2, 'D', 4), (3, NULL, 3, 'D', 4)
), steps AS (
  SELECT a.p, b.initial, b.t, a.ins || b.edit AS audit, b.edit, a.cost + b.cost AS cost FROM inserts a JOIN moves b USING (q)
), walk(k, i, q, best) AS (
  SELECT k, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': ''} FROM counts
  UNION ALL
  SELECT w.k, w.i + 1, s.t, min({'cost': (w.best.cost + s.cost + CASE WHEN r.truncated AND s.edit <> 'D' THEN 3 ELSE 0 END)::BIGINT, 'audit': w.best.audit || s.audit})
  FROM walk w JOIN r ON r.k = w.k AND r.i = w.i + 1 JOIN steps s ON s.p = w.q AND (s.initial IS NULL OR s.initial = r.initial) AND (s.edit = 'D' OR NOT (r.blank OR r.duplicate))
  GROUP BY w.k, w.i, s.t
), done AS (
  SELECT w.k, min({'cost': (w.best.cost + s.cost)::BIGINT, 'audit': w.best.audit || s.ins}) AS best
  FROM walk w JOIN counts c ON c.k = w.k AND c.n = w.i JOIN inserts s ON s.p = w.q WHERE (w.q = 0 AND s.ins = '') OR s.q = 3 GROUP BY w.k
), edits AS (
  SELECT k, unnest(range(1, length(best.audit) + 1)) AS j, best.audit AS audit FROM done
), placed AS (
  SELECT k, j, audit[j] AS edit, j - length(replace(replace(replace(left(audit, j), 'K', ''), 'R', ''), 'D', '')) AS i FROM edits
), said AS (
  SELECT p.*, r.role, r.text, coalesce(sum(CASE WHEN edit IN ('R', 'I') OR (edit = 'K' AND r.initial <> 's') THEN 1 ELSE 0 END) OVER (PARTITION BY p.k ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far
  FROM placed p LEFT JOIN r ON r.k = p.k AND r.i = p.i AND p.edit <> 'I'
), texts AS (
  SELECT k, string_agg(CASE WHEN edit = 'K' THEN role WHEN so_far % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS text FROM said WHERE edit <> 'D' GROUP BY k
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, k FROM d) c LEFT JOIN counts USING (k) LEFT JOIN done USING (k) LEFT JOIN texts USING (k)
"""

QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLES = {"op12_conversation_repair": ORACLE}
