"""Operator 11 against brute force over whole conversations."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings, strategies as st

from terralist.llm import conversation_repair as repair, queries

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def faults(rows):
    """(kind, fault) of each (role, text), in order."""
    seen, out = set(), []
    for role, text in rows:
        code = repair.ROLES.find(role[:1]) if role else -1
        code = repair.NO_ROLE if code < 0 else code
        stripped = text.strip(SPACE)
        fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((code + {"truncated": 4, None: 0}.get(fault, 8), fault))
    return out


def best(kinds):
    """(cost, audit, turns) by plain recursion; turns are (row or None, title or None)."""
    shape = re.compile(r"(s?(ua)+)?")

    @lru_cache(None)
    def go(i, written, inserts):
        # ``written`` holds the first letters so far, shortened to what decides how to go on.
        options = []
        if i == len(kinds):
            if shape.fullmatch(written):
                options.append((0, "", ()))
        else:
            kind = kinds[i]
            add(options, go(i + 1, written, 0), 2, "D", None)
            if kind < 8:
                code, more = kind & 3, 5 if kind & 4 else 0
                for letter, cost in [("sua"[code] if code < 3 else None, 0), ("u", 1), ("a", 1)]:
                    if letter and allowed(written, letter):
                        add(options, go(i + 1, short(written + letter), 0), cost + more, "K" if not cost else "R", (i, letter if cost else None))
        if inserts < 3:
            for letter in "ua":
                if allowed(written, letter):
                    add(options, go(i, short(written + letter), inserts + 1), 5, "I", (None, letter))
        return min(options) if options else (10**9, "", ())

    def allowed(written, letter):
        return bool(re.fullmatch(r"(s?(ua)*u?)?", written + letter))

    def short(written):
        return written if len(written) < 3 else written[:1].replace("u", "").replace("a", "") + ("uau" if written[-1] == "u" else "ua")

    def add(options, rest, cost, letter, turn):
        if rest[0] < 10**9:
            options.append((rest[0] + cost, letter + rest[1], ((turn,) if turn else ()) + rest[2]))

    return go(0, "", 0)


def run_blocks(kinds, size):
    """The same through blocks of ``size`` rows, as the scans do it."""
    parts = [kinds[i:i + size] for i in range(0, len(kinds), size)]
    after = [list(repair.LAST)]
    for part in reversed(parts[1:]):
        after.append(repair._through(repair.matrix(part), after[-1]))
    after.reverse()
    state, audit, cost = 0, "", 0
    for number, (part, vector) in enumerate(zip(parts, after, strict=True)):
        done = repair._emit(0, part, vector if number + 1 < len(parts) else list(repair.LAST), state)
        audit, cost = audit + done["audit"], cost + done["cost"]
        state = repair.walk(part, vector, range(4))[state]
    return cost, audit


KINDS = st.lists(st.sampled_from(sorted({*range(8), 8, 11})), max_size=9)


@given(KINDS)
@settings(max_examples=400, deadline=None)
def test_least_edits(kinds):
    cost, audit, _ = best(tuple(kinds))
    done = repair._emit(0, kinds, list(repair.LAST), 0) if kinds else {"audit": "", "cost": 0}
    assert (done["cost"], done["audit"]) == (cost, audit)


@given(st.lists(st.sampled_from(sorted({*range(8), 8, 11})), min_size=1, max_size=60), st.integers(1, 20))
@settings(max_examples=200, deadline=None)
def test_blocks_of_any_size_give_the_same(kinds, size):
    whole = repair._emit(0, kinds, list(repair.LAST), 0)
    assert run_blocks(kinds, size) == (whole["cost"], whole["audit"])
    composed = None
    for i in range(0, len(kinds), size):
        m = repair.matrix(kinds[i:i + size])
        composed = m if composed is None else repair._product(composed, m)
    assert repair._through(composed, list(repair.LAST)) == list(repair.backwards(kinds, list(repair.LAST)))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        one = lambda v: " " if v is None else str(v)
        k = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        if k:
            out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def expected(rows, hurt=True):
    out = {}
    kept = damaged(rows) if hurt else rows
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        pairs = [(r[2], r[3]) for r in own]
        judged = faults(pairs)
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit, kept_turns = best(tuple(k for k, _ in judged))
        names = {"u": "user", "a": "assistant"}
        lines = [f"{names[t]}:" if i is None else f"{names.get(t) or pairs[i][0]}:{pairs[i][1]}" for i, t in kept_turns]
        initials = [r[2][:1] for r in own]
        count = lambda f: sum(fault == f for _, fault in judged)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def random_rows(seed, convs, length):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", "  ", "Go on!\n", "a.b", "\x1c"]
    rows = []
    for conv in convs:
        for turn in range(rng.randrange(length)):
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice([*texts, f"Turn {turn}.", None])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_query(spark, tmp_path):
    rows = random_rows(1, [*range(40), None], 12)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    given_rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    for folder, rows in ((str(tmp_path), rows), ("/root/testdata/sf0.001", [tuple(r) for r in given_rows.collect()])):
        got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op11_conversation_repair"](spark, folder).collect()}
        assert got == expected(rows)


@pytest.mark.parametrize("bits, fan", [(1, 1), (2, 2), (12, 12)])
def test_conversations_over_many_blocks(spark, bits, fan):
    rows = random_rows(2, ["x"], 2) + random_rows(3, ["long"] * 3, 60) + random_rows(4, ["y", "z", None], 9)
    rows += [("same", 1, "user", "Hello.")] * 20 + [("gone", 1, "user", "")] + [("sys", 0, "system", "Be kind.")]
    docs = spark.createDataFrame(rows, "conv string, t int, r string, x string").selectExpr("conv AS name", "t AS turn", "r AS role", "x AS text", "'mine' AS conv", "'mine' AS n", "0 AS block")
    ordered = repair.ordered_rows(docs, conv="name")
    edited = repair.edits(repair.row_blocks(ordered, bits), fan)
    ids = docs.selectExpr("name AS conv").distinct()
    got = {r["conv"]: tuple(r)[1:] for r in repair.summary(ids, ordered, edited).collect()}
    named = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got == expected(named, hurt=False)
    lines = {}
    for r in sorted(repair.repaired_turns(ordered, edited).collect(), key=lambda r: r["place"]):
        lines.setdefault(r["conv"], []).append(f"{r['role']}:{r['text']}")
        assert r["place"] == len(lines[r["conv"]]) - 1
    for conv, want in got.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == want[-1]


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    ordered = repair.ordered_rows(docs)
    edited = repair.edits(repair.row_blocks(ordered))
    assert repair.summary(docs.selectExpr("conv_id AS conv"), ordered, edited).count() == 0
    assert repair.repaired_turns(ordered, edited).count() == 0


def test_sql_is_the_same():
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    rows = random_rows(9, [*range(60), None], 10)
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert {r[0]: r[1:] for r in con.execute(repair.repair_sql()).fetchall()} == expected(rows)
