"""Conversation structure repair by weighted CYK parsing over intervals of turns.

A well-formed conversation has role initials ``(s?(ua)+)?``.  Edits: keep a row
(0), give it the role user or assistant (1), delete it (2; blank and duplicate
rows must go), insert an empty user or assistant turn anywhere (5); a truncated
row that stays adds 5.  The cheapest edits win, among equals the ASCII-least
string of edit initials in order (the audit).

Grammar, in Chomsky normal form: the nonterminals are ``""`` (nothing is left of
the interval) and the seven kinds of fragments of a well-formed role string,
named by first and last initial (``ss su sa uu ua au aa``).  Every rule joins two
neighbouring intervals: ``xy -> xp qy`` where ``pq`` may follow each other, and
``""`` joins with anything.  A row derives its edits, the empty interval its
insertions; every cell is closed under insertions at both of its ends.  A cell
holds the minimum (cost, audit) of each nonterminal.  Equal costs never leave one
audit a proper prefix of another (the longer one has more insertions), so minima
of parts give minima of wholes.

Cells are combined bottom-up by span length: all splits of all spans inside
leaves of ``LEAF`` rows, and above the leaves spans of doubling length.  There one
split is enough: the nonterminals cover every fragment, so whatever stays left
and right of any fixed split is a cell of its part, closed under insertions.
A conversation of n rows costs O(n log n), and while it streams through a task only
O(log n) open cells are held; their audits are as long as the one in the result.

Faults are judged on the rows in order: blank (nothing but ASCII white space),
duplicate (role and text seen earlier), truncated (last other character not one
of ``.!?``); the first that applies counts.

Defined results: rows go by turn, nulls first, then by role and the text's
SHA-256; null roles and texts are one space, a null conversation is one of its
own; a role with another initial (or none) cannot be kept, only given a role or
deleted; repeated rows are duplicates; texts of any length are hashed and judged
whole; an empty table gives no rows; other columns never matter.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstats.session import materialize

LEAF = 8
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL = ("su", "ua", "au")
KINDS = ("", "ss", "su", "sa", "uu", "ua", "au", "aa")
WELL_FORMED = ("", "sa", "ua")
NAMES = {"u": "user", "a": "assistant"}
WHITE = r"\x20\x09-\x0D"


def kind_of(left: str, right: str) -> str | None:
    """The fragment that two neighbouring fragments make, or None."""
    if not left or not right:
        return left or right
    return left[0] + right[1] if left[1] + right[0] in LEGAL else None


RULES = [(x, y, kind_of(x, y)) for x in KINDS for y in KINDS if kind_of(x, y) is not None]


def put(cell: dict, kind: str, cost: int, *parts: str) -> None:
    """Keep the smaller (cost, audit); the audit is joined only where it matters."""
    old = cell.get(kind)
    if old is None or cost < old[0]:
        cell[kind] = (cost, "".join(parts))
    elif cost == old[0]:
        cell[kind] = min(old, (cost, "".join(parts)))


def combine(left: dict, right: dict, into: dict | None = None) -> dict:
    """Cell of an interval from the cells of its two parts."""
    out = {} if into is None else into
    for x, y, z in RULES:
        if x in left and y in right:
            (a, one), (b, two) = left[x], right[y]
            put(out, z, a + b, one, two)
    return out


INSERTED = {"uu": (INSERT, "I"), "aa": (INSERT, "I")}


def closed(cell: dict) -> dict:
    """Insertions before and after the interval, as many as help."""
    while True:
        wider = combine(cell, INSERTED, combine(INSERTED, cell, dict(cell)))
        if wider == cell:
            return cell
        cell = wider


EMPTY = closed({"": (0, "")})


def row_cell(symbol: str) -> dict:
    """Edits of one row.  ``-`` must go; a letter is the role's initial (x: another), upper case if truncated."""
    cell = {"": (DELETE, "D")}
    if symbol != "-":
        extra = TRUNCATED if symbol.isupper() else 0
        if symbol.lower() != "x":
            put(cell, symbol.lower() * 2, extra, "K")
        for role in "ua":
            put(cell, role * 2, RELABEL + extra, "R")
    return closed(cell)


def chart(symbols: str) -> dict:
    """The CYK chart of a leaf, by span length over all splits; the cell of the whole span."""
    n = len(symbols)
    cells = {(i, i + 1): row_cell(s) for i, s in enumerate(symbols)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: dict = {}
            for k in range(i + 1, i + length):
                combine(cells[i, k], cells[k, i + length], cell)
            cells[i, i + length] = closed(cell)
    return cells[0, n] if n else EMPTY


class Parse:
    """Rows of one conversation in order; open cells of spans of doubling length."""

    def __init__(self, chart=chart):
        self.leaf, self.spans, self.chart = [], [], chart

    def add(self, symbol: str) -> None:
        self.leaf.append(symbol)
        if len(self.leaf) == LEAF:
            self.close_leaf()

    def close_leaf(self) -> None:
        level, cell = 0, self.chart("".join(self.leaf))
        self.leaf = []
        while self.spans and self.spans[-1][0] == level:
            level, cell = level + 1, combine(self.spans.pop()[1], cell)
        self.spans.append((level, cell))

    def best(self) -> tuple[int, str]:
        cell = self.chart("".join(self.leaf))
        for _, left in reversed(self.spans):
            cell = combine(left, cell)
        return min(cell[k] for k in WELL_FORMED if k in cell)


def parse(symbols: str) -> tuple[int, str]:
    """(cost, audit) of one conversation given as row symbols."""
    p = Parse()
    for s in symbols:
        p.add(s)
    return p.best()


# ---------------------------------------------------------------- faults and parses
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Tally:
    """Counts and parse of one conversation while its rows pass."""

    def __init__(self, chart=chart):
        self.parse, self.faults = Parse(chart), {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.first = self.last = None
        self.turns = 0

    def add(self, turn, initial: str, fault: str) -> None:
        if turn is not None:
            if self.first is None:
                self.first = turn
            self.turns += turn != self.last
            self.last = turn
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        if fault:
            self.faults[fault] += 1
        known = initial if initial and initial in "sua" else "x"
        self.parse.add("-" if fault in ("blank", "duplicate") else known.upper() if fault else known)

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, audit = self.parse.best()
        return (gaps, *self.faults.values(), self.illegal, cost, audit)


def parse_stream(batches):
    """Sorted rows -> one row per conversation; a conversation may run over any number of batches."""
    names, key, tally, out = ["conv_id", *COUNTS, "audit"], None, None, []
    leaves = lru_cache(maxsize=1 << 14)(chart)  # most leaves of a task repeat

    def flush():
        cols = list(zip(*out))
        arrays = [pa.array(cols[0], kind)] + [pa.array(c, pa.int64()) for c in cols[1:-1]] + [
            pa.array(cols[-1], pa.string())]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, turn, initial, fault in zip(*(batch.column(c).to_pylist()
                                                for c in ("conv_id", "turn", "initial", "fault"))):
            if tally is None or conv != key:
                if tally is not None:
                    out.append((key, *tally.row()))
                key, tally = conv, Tally(leaves)
            tally.add(turn, initial, fault)
        if len(out) >= 10_000:
            yield flush()
    if tally is not None:
        out.append((key, *tally.row()))
        yield flush()


def order(digest: str = "digest") -> list:
    """Order of the rows of a conversation, the same for parsing and rewriting."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col(digest), F.col("copy")]


def rows_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", copy: str | None = None) -> DataFrame:
    """(conv_id, turn, role, text, copy, digest): nulls in role and text are one space."""
    def text(c): return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return conversations.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        text(role_col).alias("role"), text(text_col).alias("text"),
        (F.col(copy) if copy else F.lit(0)).cast("int").alias("copy")).withColumn("digest", F.sha2("text", 256))


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, copy, initial, fault) without texts, partitioned by conversation.

    One shuffle of narrow rows serves the duplicates and the order: the window
    over role and text inside a conversation needs no other partitioning.
    """
    seen = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first(), "copy")
    blank = ~F.col("text").rlike(f"[^{WHITE}]")
    whole = F.col("text").rlike(rf"[.!?][{WHITE}]*\z")
    narrow = rows.select("conv_id", "turn", "role", "digest", "copy", F.substring("role", 1, 1).alias("initial"),
                         blank.alias("blank"), whole.alias("whole"))
    fault = (F.when(F.col("blank"), "blank").when(F.row_number().over(seen) > 1, "duplicate")
             .when(~F.col("whole"), "truncated").otherwise(""))
    return narrow.repartition("conv_id").withColumn("fault", fault).drop("blank", "whole")


def parses(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"
    return (faults(rows).sortWithinPartitions("conv_id", *order()).select("conv_id", "turn", "initial", "fault")
            .mapInArrow(parse_stream, schema))


# ---------------------------------------------------------------- repaired conversations
def turns_of(audit: str, rows):
    """Apply an audit to (role, text) rows as they pass: yields (edit, role, text)."""
    at, last = 0, None

    def expected():
        return "a" if last == "u" else "u"

    for role, text in rows:
        while audit[at] == "I":
            last, at = expected(), at + 1
            yield "I", NAMES[last], ""
        edit, at = audit[at], at + 1
        if edit == "K":
            last = role[0]
            yield edit, role, text
        elif edit == "R":
            last = expected()
            yield edit, NAMES[last], text
    for _ in audit[at:]:
        last = expected()
        yield "I", NAMES[last], ""


def conversations_of(batches):
    """Cut the sorted stream of audits and rows into (conv_id, audit, rows) without holding any rows."""
    def flat():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")))

    stream, head = flat(), None

    def body():
        nonlocal head
        for conv, audit, role, text in stream:
            if audit is not None:
                head = (conv, audit)
                return
            yield role, text

    for conv, audit, _, _ in stream:
        head = (conv, audit)
        while head is not None:
            (conv, audit), head = head, None
            yield conv, audit, body()


def rewrite_stream(batches):
    """Sorted audits and rows -> (conv_id, seq, edit, role, text) of the repaired conversations, in order."""
    def batch_of(rows, kind):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], kind), pa.array(cols[1], pa.int64())] + [pa.array(c, pa.string()) for c in cols[2:]],
            names=["conv_id", "seq", "edit", "role", "text"])

    kinds = []

    def noted():
        for batch in batches:
            kinds[:] = [batch.schema.field("conv_id").type]
            yield batch

    out, size = [], 0
    for conv, audit, rows in conversations_of(noted()):
        seq = 0
        for edit, role, text in turns_of(audit, rows):
            seq += 1
            out.append((conv, seq, edit, role, text))
            size += 100 + len(text)
            if size > 8 << 20:
                yield batch_of(out, kinds[0])
                out, size = [], 0
    if out:
        yield batch_of(out, kinds[0])


def repaired(rows: DataFrame, parsed: DataFrame) -> DataFrame:
    """(conv_id, seq, edit, role, text) of every repaired conversation.

    Each conversation's audit comes ahead of its rows in one sorted stream, so no
    task ever holds a conversation's texts.  The result is partitioned by
    conversation and ordered inside; ``digests`` relies on it.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"),
                                                         ("copy", "int"), ("digest", "string"))]
    heads = parsed.select("conv_id", "audit", *nothing, F.lit(0).alias("body"))
    body = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "copy", "digest",
                       F.lit(1).alias("body"))
    return (heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "body", *order())
            .select("conv_id", "audit", "role", "text")
            .mapInArrow(rewrite_stream, f"conv_id {kind}, seq long, edit string, role string, text string"))


def digest_stream(batches):
    """Ordered repaired rows -> SHA-256 of ``role:text`` lines, one row per conversation."""
    key, state, out, kind = None, None, [], None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, seq, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seq", "role", "text"))):
            if seq == 1:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
    if state is not None:
        out.append((key, state.hexdigest()))
        cols = list(zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], kind), pa.array(cols[1], pa.string())],
                                         names=["conv_id", "repaired_sha256"])


def digests(lines: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) from the result of ``repaired``."""
    kind = lines.schema["conv_id"].dataType.simpleString()
    return lines.mapInArrow(digest_stream, f"conv_id {kind}, repaired_sha256 string")


# ---------------------------------------------------------------- the damaged table of the query
def damage(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` damaged by crc32(``conv_id:turn``) % 20, as ``rows_of`` gives them."""
    def text(c): return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = conversations.select(
        "conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
        (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("harm")).where("harm <> 0")
    harm = F.col("harm")
    d = d.select("conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
                 F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
                 .alias("text"),
                 F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows_of(d, copy="copy")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """One row per original conversation: conv_id, the counts, cost, audit, repaired_sha256."""
    rows = damage(conversations)
    parsed = materialize(parses(rows), "parses")
    found = digests(repaired(rows, parsed))
    everyone = conversations.select("conv_id").distinct()

    def same(a, b): return a["conv_id"].eqNullSafe(b["conv_id"])
    out = everyone.join(parsed, same(everyone, parsed), "left").drop(parsed["conv_id"])
    out = out.join(found, same(everyone, found), "left").drop(found["conv_id"])
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def sql() -> str:
    """DuckDB SQL by another algorithm: one pass over the rows with the cheapest edits per last role.

    A cell is the cost in nine digits followed by the audit, so text order is (cost, audit) order.
    """
    def add(cell, cost, letter):
        return f"(lpad(cast(cast(substr({cell}, 1, 9) AS bigint) + {cost} AS varchar), 9, '0') || substr({cell}, 10) || '{letter}')"

    def insertions(z, s, u, a):
        u1 = f"least({u}, {add(z, 5, 'I')}, {add(s, 5, 'I')}, {add(a, 5, 'I')})"
        return f"{z} AS z, {s} AS s, {u1} AS u, least({a}, {add(u1, 5, 'I')}) AS a"

    def stays(cells, role):
        # keep where the initial fits, else give the role; a truncated row costs five more
        kept = [f"CASE WHEN k.initial = '{role}' THEN {add(c, 'k.extra', 'K')} END" for c in cells]
        given = [f"CASE WHEN k.fault IN ('', 'truncated') THEN {add(c, '(1 + k.extra)', 'R')} END" for c in cells]
        return kept + (given if role != "s" else [])

    def least(*parts):
        return f"least({', '.join(parts)})"

    null = "CAST(NULL AS varchar)"
    z = add("d.z", 2, "D")
    s = least(add("d.s", 2, "D"), *stays(["d.z"], "s"))
    u = least(add("d.u", 2, "D"), *stays(["d.z", "d.s", "d.a"], "u"))
    a = least(add("d.a", 2, "D"), *stays(["d.u"], "a"))
    return rf"""
WITH RECURSIVE bits AS (
  SELECT range AS b, range AS c, 0 AS i FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' ') AS k FROM conversations),
crcs AS (
  SELECT raw.*, xor(list_reduce(list_transform(string_split(k, ''), lambda x: cast(ascii(x) AS bigint)),
    lambda h, x: xor(h >> 8, crc.t[cast(xor(h, x) & 255 AS bigint) + 1]), cast(4294967295 AS bigint)), 4294967295) % 20 AS harm
  FROM raw, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM crcs WHERE harm <> 0),
judged AS (
  SELECT *, substr(role, 1, 1) AS first1,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
    CASE WHEN NOT regexp_matches(text, '[^{WHITE}]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][{WHITE}]*$') THEN 'truncated' ELSE '' END AS fault FROM damaged),
keyed AS (
  SELECT *, CASE WHEN fault IN ('', 'truncated') THEN first1 END AS initial,
    CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra,
    lag(first1) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
    count(*) OVER (PARTITION BY conv_id) AS n FROM judged),
steps AS (
  SELECT conv_id, cast(0 AS bigint) AS pos, {insertions("'000000000'", null, null, null)}
  FROM (SELECT DISTINCT conv_id FROM keyed)
  UNION ALL
  SELECT e.conv_id, e.pos, {insertions("e.z", "e.s", "e.u", "e.a")}
  FROM (SELECT d.conv_id, k.pos, {z} AS z, {s} AS s, {u} AS u, {a} AS a
        FROM steps d JOIN keyed k ON d.conv_id IS NOT DISTINCT FROM k.conv_id AND k.pos = d.pos + 1) e),
best AS (
  SELECT s.conv_id, least(z, a) AS cell FROM steps s JOIN (SELECT conv_id, max(pos) AS n FROM keyed GROUP BY conv_id) m
  ON s.conv_id IS NOT DISTINCT FROM m.conv_id AND s.pos = m.n),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || first1 NOT IN ('su', 'ua', 'au')) AS illegal
  FROM keyed GROUP BY conv_id),
audits AS (SELECT conv_id, cast(substr(cell, 1, 9) AS bigint) AS cost, substr(cell, 10) AS audit FROM best),
edits AS (
  SELECT conv_id, generate_subscripts(string_split(audit, ''), 1) AS nr, unnest(string_split(audit, '')) AS edit
  FROM audits WHERE audit <> ''),
placed AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER w AS pos, count(*) FILTER (edit <> 'D') OVER w AS seq FROM edits
  WINDOW w AS (PARTITION BY conv_id ORDER BY nr)),
kept AS (
  SELECT p.conv_id, p.nr, p.edit, p.seq, k.role, coalesce(k.text, '') AS text,
    max(CASE WHEN p.seq = 1 AND p.edit = 'K' AND k.first1 = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS sys
  FROM placed p LEFT JOIN keyed k ON p.edit <> 'I' AND p.conv_id IS NOT DISTINCT FROM k.conv_id AND p.pos = k.pos
  WHERE p.edit <> 'D'),
lines AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (seq - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY nr)) AS h FROM kept GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN audits a ON o.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN lines l ON o.conv_id IS NOT DISTINCT FROM l.conv_id
"""
