"""Operator 12 against a search over all edits, a plain search over whole strings, and SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import duckdb
import pytest

from ledgerloom.llm import turn_repair
from ledgerloom.llm.common import table
from tests.llm.plain import SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_search(rows):
    """Least (cost, audit) of ``rows`` (initial, must go, truncated), from the last row to the first."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    ask = (2, 2, 3, 2)
    n, best = len(rows), {}
    for i in range(n, -1, -1):
        here = {q: (0, "") if i == n and q in (0, 3) else None for q in range(4)}
        for q in range(4):
            options = [here[q]] if here[q] else []
            if i < n:
                initial, gone, cut = rows[i]
                options.append((best[i + 1, q][0] + 3, "D" + best[i + 1, q][1]))
                if not gone:
                    if (q, initial) in after:
                        c, a = best[i + 1, after[q, initial]]
                        options.append((c + cut, "K" + a))
                    c, a = best[i + 1, ask[q]]
                    options.append((c + 2 + cut, "R" + a))
            here[q] = min(options, default=(10**9, ""))
        for _ in range(4):
            for q in range(4):
                c, a = here[ask[q]]
                here[q] = min(here[q], (c + 2, "I" + a))
        best.update({(i, q): here[q] for q in range(4)})
    return best[0, 0]


def all_edits(rows, most_inserts=2):
    """Every audit string with at most so many inserts at a place, tried against the grammar itself."""
    found = []

    def go(i, said, cost, audit, inserts):
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            found.append((cost, audit))
        if inserts < most_inserts:
            for r in "ua":
                go(i, said + r, cost + 2, audit + "I", inserts + 1)
        if i < len(rows):
            initial, gone, cut = rows[i]
            go(i + 1, said, cost + 3, audit + "D", 0)
            if not gone:
                go(i + 1, said + initial, cost + cut, audit + "K", 0)
                for r in "ua":
                    go(i + 1, said + r, cost + 2 + cut, audit + "R", 0)

    go(0, "", 0, "", 0)
    return min(found)


def by_operator(rows):
    machine, out, most = turn_repair.Repair(), [], 0
    for i, (initial, gone, cut) in enumerate(rows):
        out += [e[0] for e in machine.add((i, initial, "", None), initial, gone, bool(cut))]
        most = max(most, machine.open_edits())
    costs = [machine.costs[q] for q in (0, 3) if machine.costs[q] is not None]
    return min(costs), "".join(out + [e[0] for e in machine.end()]), most


def draw_rows(draw, n, initials="suaux"):
    return [(draw.choice(initials), draw.random() < 0.15, int(draw.random() < 0.2)) for _ in range(n)]


def test_plain_search_is_the_best_of_all_edits():
    draw = random.Random(1)
    for _ in range(120):
        rows = draw_rows(draw, draw.randrange(4))
        assert plain_search(rows) == all_edits(rows)


@pytest.mark.parametrize("initials", ["suaux", "u", "ua", "uuuua", "as", "sua"])
def test_edits_are_the_least(initials):
    draw = random.Random(initials)
    for n in [*range(12)] * 12 + [60, 200]:
        rows = draw_rows(draw, n, initials)
        assert by_operator(rows)[:2] == plain_search(rows)
    rows = [(initials[i % len(initials)], False, 0) for i in range(150)]
    assert by_operator(rows)[:2] == plain_search(rows)


def test_a_long_conversation_holds_few_open_edits():
    draw = random.Random(4)
    rows = [("ua"[i % 2] if draw.random() > 0.1 else draw.choice("suax"), draw.random() < 0.05, int(draw.random() < 0.1)) for i in range(30_000)]
    _, audit, most = by_operator(rows)
    assert len(audit) >= len(rows) and most < 200


def plain_report(rows):
    """The contract, conversation by conversation."""
    space = lambda v: " " if v is None else v
    after = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv in {r[0] for r in rows}:
        here = sorted(after[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in here:
            rest = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = plain_search([(r[1][:1], f in ("blank", "duplicate"), int(f == "truncated")) for r, f in zip(here, faults)])
        said, i, system = [], 0, 0
        for letter in audit:
            if letter in "RI":
                said.append((("user", "assistant")[(len(said) - system) % 2], here[i][2] if letter == "R" else ""))
            elif letter == "K":
                system += here[i][1][:1] == "s"
                said.append(here[i][1:])
            i += letter != "I"
        turns = {r[0] for r in here} - {None}
        initials = [r[1][:1] for r in here]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in turn_repair.FAULTS),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest(),
        ))
    return Counter(out)


def odd_conversations():
    draw = random.Random(9)
    texts = [None, "", " \n", "Yes.", "No", "Why?", "Why? ", "a\nb!", " ", "é", "x" * 5000, "Yes."]
    rows = [(c, draw.choice([None, 0, 1, 2, 3, 5, 9]), draw.choice(["user", "assistant", "system", None, "", "tool", "u"]), draw.choice(texts))
            for c in [None, *range(60)] for _ in range(draw.randrange(1, 12))]
    rows += [(70, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(400)] + [(71, i, "user", "Same.") for i in range(60)]
    # one conversation of which the damage leaves nothing
    gone = next(c for c in range(100, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(gone, 0, "user", "Gone.")] + rows[:20]


@pytest.mark.parametrize("which", ["conversations", "odd", "empty"])
def test_report(spark, which):
    if which == "conversations":
        rows = table(spark, SMALL, "conversations")
    else:
        rows = spark.createDataFrame(odd_conversations() if which == "odd" else [], SCHEMA).selectExpr("*", "1 AS kind", "'k' AS key", "2 AS copy", "3 AS n", "4 AS `a.b`", "5 AS seen", "6 AS id")
    given = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    assert Counter(tuple(r) for r in turn_repair.report(rows).collect()) == plain_report(given)


def test_sql(spark, tmp_path):
    rows = odd_conversations()
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "c"))
    base = duckdb.connect()
    base.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    assert Counter(base.execute(turn_repair.sql()).fetchall()) == plain_report(rows)


def test_edits_give_the_conversation_back(spark):
    rows = spark.createDataFrame(odd_conversations(), SCHEMA)
    edits = turn_repair.repair(rows).collect()
    assert sum(e["edit"] != "I" for e in edits) == rows.count()
    said = defaultdict(str)
    for e in edits:
        if e["role"] is not None:
            said[e["conv_id"]] += e["role"][0]
        assert (e["edit"] == "D") == (e["role"] is None) and (e["edit"] == "I") == (e["before"] is None)
        assert e["fault"] not in ("blank", "duplicate") or e["edit"] == "D"
    assert all(re.fullmatch("(s?(ua)+)?", s) for s in said.values())


def test_order_of_edit_strings():
    @lru_cache
    def plain(a, b):
        short = min(len(a), len(b))
        return (0, len(b) - len(a)) if a[:short] == b[:short] else ((-1 if a < b else 1), 0)

    for a, b in (("K", "KI"), ("KII", "K"), ("D", "K"), ("KI", "KR"), ("", "II")):
        for x, y in (("K", "D"), ("D", "IK"), ("IK", "IK"), ("I", "")):
            assert turn_repair._compare(plain(a, b), x, y) == plain(a + x, b + y)
