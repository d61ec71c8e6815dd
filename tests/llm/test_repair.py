"""Conversation repair: exhaustive search, other parses, SQL on the given table, odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from reelstats.llm import queries, repair
from tests.conftest import SF001

WELL = re.compile(r"(s?(ua)+)?\Z")


def exhaustive(symbols: str, inserts: int = 3):
    """Cheapest (cost, audit) over all edit sequences with at most so many insertions."""
    best = None
    n = len(symbols)
    per_row = []
    for s in symbols:
        options = [("D", "", 2)]
        if s != "-":
            extra = 5 if s.isupper() else 0
            options += [("R", r, 1 + extra) for r in "ua"]
            if s.lower() != "x":
                options.append(("K", s.lower(), extra))
        per_row.append(options)
    for edits in itertools.product(*per_row):
        base = sum(e[2] for e in edits)
        for k in range(inserts + 1):
            for places in itertools.combinations_with_replacement(range(n + 1), k):
                for roles in itertools.product("ua", repeat=k):
                    initials, audit = "", ""
                    for i in range(n + 1):
                        for p, r in zip(places, roles):
                            if p == i:
                                initials += r
                                audit += "I"
                        if i < n:
                            audit += edits[i][0]
                            initials += edits[i][1]
                    if WELL.match(initials):
                        found = (base + 5 * k, audit)
                        best = found if best is None else min(best, found)
    return best


def linear(symbols: str):
    """Another algorithm: one pass with the cheapest edits per last role."""
    def better(cells, state, value):
        if state not in cells or value < cells[state]:
            cells[state] = value

    def with_insertions(cells):
        for _ in range(3):
            for state, (c, a) in list(cells.items()):
                better(cells, "a" if state == "u" else "u", (c + 5, a + "I"))
        return cells

    cells = with_insertions({"": (0, "")})
    for s in symbols:
        new = {}
        for state, (c, a) in cells.items():
            better(new, state, (c + 2, a + "D"))
            if s == "-":
                continue
            extra = 5 if s.isupper() else 0
            after = "a" if state == "u" else "u"
            better(new, after, (c + 1 + extra, a + "R"))
            if s.lower() == after or (s.lower() == "s" and state == ""):
                better(new, s.lower(), (c + extra, a + "K"))
        cells = with_insertions(new)
    return min(cells[k] for k in ("", "a") if k in cells)


def test_short_conversations_equal_exhaustive_search():
    for n in range(4):
        for symbols in itertools.product("suaxSUAX-", repeat=n):
            text = "".join(symbols)
            if n < 3 or random.Random(text).random() < 0.15:
                assert repair.parse(text) == exhaustive(text), text


def test_any_length_equals_the_linear_pass():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("suuuaaaxSUA-") for _ in range(rng.randrange(60)))
        assert repair.parse(text) == linear(text), text
    text = "".join(rng.choice("uuaasxUA-") for _ in range(3000))
    assert repair.parse(text) == linear(text)


def test_doubled_spans_equal_the_whole_chart():
    rng = random.Random(6)
    for _ in range(20):
        text = "".join(rng.choice("suaxUA-") for _ in range(rng.randrange(9, 30)))
        whole = repair.chart(text)
        assert repair.parse(text) == min(whole[k] for k in repair.WELL_FORMED if k in whole)


def brute(rows):
    """The contract on plain rows (conv_id, turn, role, text)."""
    out = []
    for conv in sorted({r[0] for r in rows}, key=lambda c: (c is not None, c or 0)):
        damaged = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if harm == 0:
                continue
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            role = "user" if harm == 4 else role
            damaged += [(turn, role, text)] * (2 if harm == 3 else 1)
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, symbols, count = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in damaged:
            solid = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                     else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
            if fault:
                count[fault] += 1
            s = role[0] if role and role[0] in "sua" else "x"
            symbols += "-" if fault in ("blank", "duplicate") else s.upper() if fault else s
        turns = [r[0] for r in damaged if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[1][:1] for r in damaged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = linear(symbols)
        lines, last, at = [], None, 0
        for e in audit:
            if e == "D":
                at += 1
                continue
            role = damaged[at][1] if e == "K" else "assistant" if last == "u" else "user"
            lines.append(f"{role}:{'' if e == 'I' else damaged[at][2]}")
            last = role[0]
            at += e != "I"
        out.append((conv, gaps, *count.values(), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def odd_rows():
    rng = random.Random(3)
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rng.randrange(1, 12)):
            rows.append((conv, rng.choice([turn, turn, turn * 2, None]),
                         rng.choice(["user", "assistant", "system", "tool", None, "", "User"]),
                         rng.choice(["Fine.", "fine", None, "", " \t", "Is it? ", "same.", "İ é.", "a\nb!"])))
    rows += [(500, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(700)]
    rows += [(600, 0, "user", "copy.")] * 50
    rows += [(700, 0, "user", "w. " * 100_000), (700, 1, "assistant", "long" * 100_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, digest string, copy int")


def test_odd_rows_equal_brute_force(spark):
    rows = odd_rows()
    got = repair.repair_damaged(frame(spark, rows))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted((tuple(r) for r in got.collect()), key=key) == brute(rows)


def test_nothing_left_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.repair_damaged(frame(spark, [(gone, 0, "user", "Hi.")])).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert repair.repair_damaged(frame(spark, odd_rows()).where("false")).count() == 0


def test_repaired_conversations_are_well_formed(spark):
    rows = repair.rows_of(frame(spark, odd_rows()))
    lines = repair.repaired(rows, repair.parses(rows)).collect()
    by_conv = {}
    for r in lines:
        by_conv.setdefault(r.conv_id, []).append(r)
    for conv in by_conv.values():
        conv.sort(key=lambda r: r.seq)
        assert [r.seq for r in conv] == list(range(1, len(conv) + 1))
        assert WELL.match("".join(r.role[0] for r in conv))
        assert all(r.text == "" for r in conv if r.edit == "I")


def test_a_conversation_streams_over_small_batches(spark):
    rows = odd_rows()
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "3")
    try:
        got = repair.repair_damaged(frame(spark, rows)).collect()
    finally:
        spark.conf.unset(key)
    assert sorted((tuple(r) for r in got), key=lambda r: (r[0] is not None, r[0] or 0)) == brute(rows)


@pytest.mark.parametrize("name", ["op11_conversation_repair"])
def test_query_equals_sql(spark, duck, name):
    got = queries.LLM_QUERIES[name](spark, SF001)
    cols = sorted(got.columns)
    want = sorted(duck.execute(queries.LLM_SQL[name]).df()[cols].itertuples(index=False, name=None))
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == want
