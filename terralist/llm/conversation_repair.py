"""Repair of conversations with the least edits, ties to the ASCII-least record of them.

Each row is kept (0), given another role (1) or deleted (2, the only choice for
blank and repeated rows), and empty turns are inserted (5), so that roles follow
``(s?(ua)+)?`` by their first letters; a truncated row that stays costs 5 more.  A
conversation is a walk through four states: nothing yet, after a system row, after
a user row, after an assistant row.  The vector of least costs from a row to the
end, one number a state, follows from that of the next row.

Vectors are kept only at checkpoints.  Rows are numbered in order over the whole
table and cut into blocks of 4096 numbers.  What a block does to a vector is a
4 x 4 matrix; a scan over the matrices of a conversation gives the vector behind
every block, the outer checkpoints.  In a block, vectors are kept every square root
of its rows and recomputed in between while walking forward from the state the
block is entered in, always along edits that keep the least cost, the least letter
first.  For each of the four states the walk leaves a block in one state; a second
scan over these maps tells every block its own.  Nearly all conversations lie in one
block and take no part in the scans; one that holds a third of all rows is spread
over all tasks.  Only its text in order, and the digest of that, pass through one
task, as a stream.

Defined results: rows are ordered by turn (nulls first), then role, then text; a
null role or text counts as one space; null conversations are one conversation; an
empty role is not kept; equal rows are repeats of each other; a conversation of
which no row stays has an empty record; other columns are left out.
"""

import hashlib
from math import isqrt

import pyarrow as pa
from pyspark.sql import functions as F, types as T

from terralist.llm.words import SPACE_CHARS
from terralist.operators.keys import number_rows
from terralist.session import cut_lineage

#: Rows of a block as a power of two, and blocks that one step of a scan takes together.
BLOCK_BITS, FAN_BITS = 12, 12
RETITLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Kinds of rows: the code of the role, and 4 for truncated or 8 for rows that have to go.
ROLES = "sua"
NO_ROLE, CUT_OFF, MUST_GO = 3, 4, 8
NEVER = 1 << 60
#: States by number, and where a turn of each role leads from each; None is not allowed.
NEXT = ((1, 2, None), (None, 2, None), (None, None, 3), (None, 2, None))
TITLES = (None, "user", "assistant")
#: The turn that may be inserted in a state is the only user or assistant turn that may follow.
FOLLOWS = tuple(1 if n[2] is None else 2 for n in NEXT)


def closed(a, b, c, d):
    """Costs when empty turns may come first."""
    user, other = min(c, d + INSERT), min(d, c + INSERT)
    return min(a, user + INSERT), min(b, user + INSERT), user, other


#: Behind the last row nothing, or a whole exchange, may stand.
LAST = closed(0, NEVER, NEVER, 0)


def moves(kind, state):
    """(letter, cost, next state) of the edits of a row, letters in ASCII order."""
    yield "D", DELETE, state
    if kind < MUST_GO:
        more, role = (TRUNCATED, kind - CUT_OFF) if kind >= CUT_OFF else (0, kind)
        if role != NO_ROLE and NEXT[state][role] is not None:
            yield "K", more, NEXT[state][role]
        follows = FOLLOWS[state]
        if role != follows:
            yield "R", more + RETITLE, NEXT[state][follows]


MOVES = [[tuple(moves(kind, state)) for state in range(4)] for kind in range(MUST_GO + 4)]


def before(kind, vector):
    """Costs from a row on, given those from the next row on."""
    return closed(*[min([cost + vector[to] for _, cost, to in choices]) for choices in MOVES[kind]])


def backwards(kinds, vector):
    for kind in reversed(kinds):
        vector = before(kind, vector)
    return vector


def matrix(kinds):
    """Least cost from each state in front of the rows to each state right behind them."""
    columns = [backwards(kinds, [0 if s == t else NEVER for s in range(4)]) for t in range(4)]
    return [min(columns[t][s], NEVER) for s in range(4) for t in range(4)]


def walk(kinds, after, states, emit=None):
    """Follow the rows from ``states``, given the costs behind them: the states reached.

    Vectors are kept at every square root of the rows and recomputed in between.
    ``emit(number, inserted, letter, state)`` is called for each row if a single
    state is followed.
    """
    step = isqrt(len(kinds)) + 1
    borders = list(range(0, len(kinds), step))
    kept = [after]
    for at in reversed(borders[1:]):
        kept.append(backwards(kinds[at:at + step], kept[-1]))
    states = list(states)
    for at in borders:
        part = kinds[at:at + step]
        vectors = [kept.pop()]
        for kind in reversed(part):
            vectors.append(before(kind, vectors[-1]))
        for number, kind in enumerate(part, at):
            here, then = vectors.pop(), vectors[-1]
            for k, state in enumerate(states):
                inserted = 0
                while True:
                    choices = MOVES[kind][state]
                    # D comes before I, I before K and R.
                    letter, cost, to = choices[0]
                    if cost + then[to] == here[state]:
                        break
                    put = NEXT[state][FOLLOWS[state]]
                    if here[put] + INSERT == here[state]:
                        state, inserted = put, inserted + 1
                        continue
                    letter, _, to = next(c for c in choices[1:] if c[1] + then[c[2]] == here[state])
                    break
                states[k] = to
                if emit:
                    emit(number, inserted, letter, to)
    return states


def closing(state):
    """Turns inserted behind the last row."""
    count = 0
    while LAST[state]:
        state, count = NEXT[state][FOLLOWS[state]], count + 1
    return count


# What is composed in a scan: matrices from the last block back, maps of states forth.

def _product(left, right):
    return [min(min(left[4 * s + k] + right[4 * k + t] for k in range(4)), NEVER) for s in range(4) for t in range(4)]


def _through(m, vector):
    return [min(m[4 * s + t] + vector[t] for t in range(4)) for s in range(4)]


def _chained(first, second):
    return [second[s] for s in first]


def _batch(rows, schema):
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(df, *columns):
    """Arrow schema of some columns of a frame."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.select(*columns).schema)


def scan(blocks, top, compose, apply, reverse, fan=FAN_BITS):
    """(conv, block, given): what stands behind (or in front of) every block of its conversation.

    ``blocks`` has (conv, block, value).  Groups of 2^fan neighbouring blocks
    are composed, groups of groups again, until one is left; then what is known of
    the whole goes down to the parts.
    """
    lists = T.ArrayType(T.LongType())
    arrow = _arrow(blocks, "conv")
    up = pa.schema([*arrow, ("block", pa.int64()), ("value", pa.list_(pa.int64()))])
    down = pa.schema([*arrow, ("block", pa.int64()), ("given", pa.list_(pa.int64()))])

    def grouped(nodes):
        group = F.shiftright("block", fan).alias("_group")
        return nodes.groupBy("conv", group).agg(F.sort_array(F.collect_list(F.struct("block", "value"))).alias("_parts"))

    def composed(batches):
        for batch in batches:
            for r in batch.to_pylist():
                value = None
                for part in r["_parts"]:
                    value = part["value"] if value is None else compose(value, part["value"])
                yield _batch([{"conv": r["conv"], "block": r["_group"], "value": value}], up)

    def handed(batches):
        for batch in batches:
            for r in batch.to_pylist():
                given, out = r["given"], []
                for part in (reversed(r["_parts"]) if reverse else r["_parts"]):
                    out.append({"conv": r["conv"], "block": part["block"], "given": given})
                    given = apply(part["value"], given)
                yield _batch(out, down)

    levels = [blocks]
    most = blocks.agg(F.max("block")).first()[0] or 0
    while most >> fan:
        fields = T.StructType([blocks.schema["conv"], T.StructField("block", T.LongType()), T.StructField("value", lists)])
        levels.append(cut_lineage(grouped(levels[-1]).mapInArrow(composed, fields)))
        most >>= fan
    fields = T.StructType([blocks.schema["conv"], T.StructField("block", T.LongType()), T.StructField("given", lists)])
    known = None
    for level in reversed(levels):
        parts = grouped(level)
        if known is None:
            parts = parts.withColumn("given", F.array(*[F.lit(v).cast("long") for v in top]))
        else:
            parts = _matched(parts, known.withColumnRenamed("block", "_group"), "_group")
        known = parts.mapInArrow(handed, fields)
    return known


def _matched(left, right, number):
    """Inner join on a conversation, null being one, and a number."""
    right = right.withColumnsRenamed({"conv": "_conv", number: "_number"})
    return left.join(right, left["conv"].eqNullSafe(right["_conv"]) & (left[number] == right["_number"])).drop("_conv", "_number")


def ordered_rows(rows, conv="conv_id", turn="turn", role="role", text="text"):
    """(conv, turn, role, text, n): rows numbered in order, written once."""
    named = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"),
        # Equal rows may be many: where they stand keeps them apart.
        F.monotonically_increasing_id().alias("_copy"),
    )
    return cut_lineage(number_rows(named, ["conv", "turn", "role", "text", "_copy"], output="n", start_at=0).drop("_copy"))


def row_blocks(ordered, bits=BLOCK_BITS):
    """(conv, block, n, kinds, value, blank, duplicate, truncated, illegal) of every block, written once.

    ``value`` is the matrix of a block that has neighbours in its conversation.
    """
    stripped = F.rtrim("text", F.lit(SPACE_CHARS))
    code = F.lit(NO_ROLE)
    for number, letter in enumerate(ROLES):
        code = F.when(F.left("role", F.lit(1)) == letter, number).otherwise(code)
    fault = F.when(stripped == "", MUST_GO).when(~F.right(stripped, F.lit(1)).isin(".", "!", "?"), CUT_OFF).otherwise(0)
    block = F.shiftright("n", bits)
    narrow = ordered.select("conv", "n", (code + fault).alias("kind"), F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")).alias("_same"))
    own = narrow.select("conv", block.alias("block"), "n", "kind")
    # The first of equal rows is told by number; the last row of a block is also shown to the next block.
    first = narrow.groupBy("conv", "_same").agg(F.min("n").alias("n")).select("conv", block.alias("block"), "n", F.lit(-1).alias("kind"))
    last = own.filter(F.shiftright(F.col("n") + 1, bits) > F.col("block")).withColumn("block", F.col("block") + 1)
    together = own.unionByName(first).unionByName(last).groupBy("conv", "block").agg(F.collect_list(F.struct("n", "kind")).alias("rows"))
    counts = ("blank", "duplicate", "truncated", "illegal")
    fields = [ordered.schema["conv"]] + [T.StructField(c, T.LongType()) for c in ("block", "n", *counts)]
    fields += [T.StructField("kinds", T.BinaryType()), T.StructField("value", T.ArrayType(T.LongType()))]
    schema = pa.schema([
        *_arrow(ordered, "conv"), *[(c, pa.int64()) for c in ("block", "n", *counts)],
        ("kinds", pa.binary()), ("value", pa.list_(pa.int64())),
    ])

    def made(batches):
        for batch in batches:
            out = [b for r in batch.to_pylist() if (b := _block(r["conv"], r["block"], r["rows"], bits))]
            if out:
                yield _batch(out, schema)

    return cut_lineage(together.mapInArrow(made, T.StructType(fields)))


LEGAL = {(0, 1), (1, 2), (2, 1)}


def _block(conv, block, rows, bits):
    begin = block << bits
    firsts = {r["n"] for r in rows if r["kind"] < 0}
    kinds = dict(sorted((r["n"], r["kind"]) for r in rows if r["kind"] >= 0))
    previous = kinds.pop(begin - 1, None)
    if not kinds:
        return None
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    out = bytearray()
    code = None if previous is None else previous & 3
    for n, kind in kinds.items():
        if code is not None and (code, kind & 3) not in LEGAL:
            counts["illegal"] += 1
        code = kind & 3
        if kind >= MUST_GO:
            counts["blank"] += 1
        elif n not in firsts:
            counts["duplicate"] += 1
            kind = MUST_GO + code
        elif kind >= CUT_OFF:
            counts["truncated"] += 1
        out.append(kind)
    first, full = next(iter(kinds)), max(kinds) + 1 == (block + 1) << bits
    linked = previous is not None or full
    return {"conv": conv, "block": block, "n": first, "kinds": bytes(out), "value": matrix(out) if linked else None, **counts}


def edits(blocks, fan=FAN_BITS):
    """(conv, block, cost, audit, steps): the edits of every block, written once.

    ``steps`` has (n, before, edit, title, after) of rows that stay or have turns
    inserted: how many before and after, and the new role of those retitled.
    """
    linked = blocks.filter(F.col("value").isNotNull())
    behind = scan(linked.select("conv", "block", "value"), LAST, _product, _through, reverse=True, fan=fan)
    lists = T.ArrayType(T.LongType())
    joined = cut_lineage(_matched(linked.drop("value"), behind.withColumnRenamed("given", "after"), "block"))
    arrow = _arrow(blocks, "conv")
    exits = pa.schema([*arrow, ("block", pa.int64()), ("value", pa.list_(pa.int64()))])

    def left(batches):
        for batch in batches:
            yield _batch([
                {"conv": r["conv"], "block": r["block"], "value": walk(r["kinds"], r["after"], range(4))} for r in batch.to_pylist()
            ], exits)

    fields = [blocks.schema["conv"], T.StructField("block", T.LongType()), T.StructField("value", lists)]
    maps = joined.select("conv", "block", "kinds", "after").mapInArrow(left, T.StructType(fields))
    entered = scan(cut_lineage(maps), [0], _chained, lambda m, s: [m[s[0]]], reverse=False, fan=fan)
    several = _matched(joined, entered.withColumnRenamed("given", "state"), "block")
    alone = blocks.filter(F.col("value").isNull()).drop("value").withColumns({
        "after": F.array(*[F.lit(v).cast("long") for v in LAST]), "state": F.array(F.lit(0).cast("long")),
    })
    counts = ("blank", "duplicate", "truncated", "illegal")
    step = [("n", T.LongType(), pa.int64()), ("before", T.LongType(), pa.int64()), ("edit", T.StringType(), pa.string()),
            ("title", T.StringType(), pa.string()), ("after", T.LongType(), pa.int64()), ("next", T.StringType(), pa.string())]
    fields = [blocks.schema["conv"]] + [T.StructField(c, T.LongType()) for c in ("block", *counts, "cost")]
    fields += [T.StructField("audit", T.StringType()), T.StructField("steps", T.ArrayType(T.StructType([T.StructField(c, k) for c, k, _ in step])))]
    schema = pa.schema([
        *arrow, *[(c, pa.int64()) for c in ("block", *counts, "cost")], ("audit", pa.string()),
        ("steps", pa.list_(pa.struct([(c, k) for c, _, k in step]))),
    ])

    def emitted(batches):
        for batch in batches:
            for piece in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                yield _batch([
                    {c: r[c] for c in ("conv", "block", *counts)} | _emit(r["n"], r["kinds"], r["after"], r["state"][0])
                    for r in piece.to_pylist()
                ], schema)

    return cut_lineage(several.unionByName(alone).mapInArrow(emitted, T.StructType(fields)))


def _emit(n, kinds, after, state):
    steps, audit, cost = [], [], 0
    # The title of the next inserted turn follows from the state, as they alternate.
    at = [state]

    def emit(number, inserted, letter, to):
        nonlocal cost
        first = TITLES[FOLLOWS[at[0]]]
        audit.append("I" * inserted + letter)
        kind = kinds[number]
        cost += INSERT * inserted + (DELETE if letter == "D" else (TRUNCATED if kind >= CUT_OFF else 0) + (RETITLE if letter == "R" else 0))
        if inserted or letter != "D":
            steps.append({"n": n + number, "before": inserted, "edit": letter, "title": TITLES[to - 1] if letter == "R" else None, "after": 0, "next": first})
        at[0] = to

    end, = walk(kinds, after, [state], emit)
    # Only the last block of a conversation has the costs of its end behind it.
    more = closing(end) if list(after) == list(LAST) else 0
    if more:
        steps.append({"n": n + len(kinds) - 1, "before": 0, "edit": None, "title": None, "after": more, "next": TITLES[FOLLOWS[end]]})
        audit.append("I" * more)
        cost += INSERT * more
    return {"steps": steps, "audit": "".join(audit), "cost": cost}


def _in_order(ordered, edited):
    """Edits and rows of each conversation as one sorted stream in one partition."""
    steps = edited.select("conv", F.explode("steps").alias("s")).select(
        "conv", "s.n", F.when(F.col("s.after") > 0, 2).otherwise(0).alias("kind"),
        (F.col("s.before") + F.col("s.after")).alias("inserted"), "s.edit", "s.title", "s.next",
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
    )
    given = ordered.select(
        "conv", "n", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("inserted"),
        *[F.lit(None).cast("string").alias(c) for c in ("edit", "title", "next")], "role", "text",
    )
    return steps.unionByName(given).repartition("conv").sortWithinPartitions("conv", "n", "kind")


def _turns(batches):
    """(conv, role, text) of the repaired turns of a stream; (conv, None, None) once for each conversation."""
    none = object()
    now, step = none, None
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            for r in batch.slice(i, 256).to_pylist():
                if r["conv"] != now or now is none:
                    now, step = r["conv"], None
                    yield now, None, None
                if r["kind"] == 1:
                    if step is not None and step["n"] == r["n"] and step["edit"] in ("K", "R"):
                        yield now, step["title"] or r["role"], r["text"]
                    continue
                step = r
                title = r["next"]
                for _ in range(r["inserted"]):
                    yield now, title, ""
                    title = "assistant" if title == "user" else "user"


def repaired_turns(ordered, edited):
    """(conv, place, role, text): the repaired conversations."""
    stream = _in_order(ordered, edited)
    schema = pa.schema([*_arrow(ordered, "conv"), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches):
        place, held, size = 0, [], 0
        for conv, role, text in _turns(batches):
            if role is None:
                place = 0
                continue
            held.append({"conv": conv, "place": place, "role": role, "text": text})
            place, size = place + 1, size + len(text)
            if len(held) >= 4096 or size > 1 << 22:
                yield _batch(held, schema)
                held, size = [], 0
        if held:
            yield _batch(held, schema)

    return stream.mapInArrow(run, T.StructType([ordered.schema["conv"], *T._parse_datatype_string("place long, role string, text string").fields]))


def repaired_digests(ordered, edited):
    """(conv, digest): sha256 of the repaired ``role:text`` lines of each conversation."""
    stream = _in_order(ordered, edited)
    schema = pa.schema([*_arrow(ordered, "conv"), ("digest", pa.string())])

    def run(batches):
        held, now, digest, lines = [], None, None, 0
        for conv, role, text in _turns(batches):
            if role is None:
                if digest is not None:
                    held.append({"conv": now, "digest": digest.hexdigest()})
                now, digest, lines = conv, hashlib.sha256(), 0
                if len(held) >= 4096:
                    yield _batch(held, schema)
                    held = []
                continue
            digest.update((("\n" if lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            lines += 1
        if digest is not None:
            held.append({"conv": now, "digest": digest.hexdigest()})
        if held:
            yield _batch(held, schema)

    return stream.mapInArrow(run, T.StructType([ordered.schema["conv"], T.StructField("digest", T.StringType())]))


def turn_gaps(ordered):
    """(conv, gaps): turn numbers missing between the least and the largest."""
    return ordered.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
    )


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def summary(ids, ordered, edited):
    """One row for each of ``ids`` (conv): counts, cost, record of edits and digest of the repaired turns."""
    def part(df, **has):
        zeros = {c: F.lit(0).cast("long") for c in COUNTS}
        texts = {"digest": F.lit(None).cast("string"), "audit": F.lit(None).cast("struct<block:long,audit:string>")}
        return df.select("conv", *[(has.get(c, v)).alias(c) for c, v in (zeros | texts).items()])

    own = {c: F.col(c) for c in COUNTS if c != "gaps"}
    together = (
        part(ids)
        .unionByName(part(turn_gaps(ordered), gaps=F.col("gaps")))
        .unionByName(part(edited, **own, audit=F.struct("block", "audit")))
        .unionByName(part(repaired_digests(ordered, edited), digest=F.col("digest")))
    )
    # A record of edits is as long as its conversation; its parts are as many as the blocks.
    audit = F.array_join(F.transform(F.sort_array(F.collect_list("audit")), lambda a: a["audit"]), "")
    return together.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in COUNTS], audit.alias("audit"),
        F.coalesce(F.max("digest"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def damage(rows):
    """Rows with faults put in by crc32 of ``conv_id:turn``: dropped, emptied, without stops, repeated, retitled."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.encode(F.concat(text("conv_id"), F.lit(":"), text("turn")), "UTF-8")) % 20
    hurt = rows.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(text("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        fault.alias("_fault"),
    ).filter("_fault != 0")
    return hurt.withColumn("_copy", F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_fault", "_copy")


def repair_sql():
    """The same over ``conversations`` in DuckDB's SQL: whole conversations, folded from their last row back.

    Each state carries its least (cost, record of edits, text) to the end.
    """
    never = f"{{'c': {NEVER}, 'a': '', 'b': ''}}"

    def step(cost, letter, line, rest):
        return f"{{'c': {rest}.c + {cost}, 'a': '{letter}' || {rest}.a, 'b': {line} || {rest}.b}}"

    def best(*options):
        return f"list_sort([{', '.join(options)}])[1]"

    def kept(role, rest):
        return f"CASE WHEN r.fault < {MUST_GO} AND r.code = {role} THEN {step('r.more', 'K', 'r.line', rest)} ELSE {never} END"

    def retitled(role, rest):
        line = f"chr(10) || '{TITLES[role]}:' || r.said"
        return f"CASE WHEN r.fault < {MUST_GO} THEN {step(f'r.more + {RETITLE}', 'R', line, rest)} ELSE {never} END"

    def inserted(role, rest):
        return step(INSERT, "I", f"chr(10) || '{TITLES[role]}:'", rest)

    rows = []
    for state, follows in enumerate(NEXT):
        options = [step(DELETE, "D", "''", f"v[{state + 1}]")]
        options += [kept(role, f"v[{to + 1}]") for role, to in enumerate(follows) if to is not None]
        role = FOLLOWS[state]
        rows.append(best(*options, retitled(role, f"v[{follows[role] + 1}]")))
    # First the two states that insert into each other, then those that lead to them.
    pair = f"[o[1], o[2], {best('o[3]', inserted(2, 'o[4]'))}, {best('o[4]', inserted(1, 'o[3]'))}]"
    closed_sql = f"[{best('p[1]', inserted(1, 'p[3]'))}, {best('p[2]', inserted(1, 'p[3]'))}, p[3], p[4]]"
    fold = f"list_transform([{pair}], lambda p: {closed_sql})[1]"
    fold = f"list_transform([[{', '.join(rows)}]], lambda o: {fold})[1]"
    last = "[{'c': 0, 'a': '', 'b': ''}, {'c': 10, 'a': 'II', 'b': chr(10) || 'user:' || chr(10) || 'assistant:'}, {'c': 5, 'a': 'I', 'b': chr(10) || 'assistant:'}, {'c': 0, 'a': '', 'b': ''}]"
    typed = "CAST({} AS STRUCT(c BIGINT, a VARCHAR, b VARCHAR)[])"
    space = r"\x20\x09-\x0D"
    code = " ".join(f"WHEN left(role, 1) = '{letter}' THEN {i}" for i, letter in enumerate(ROLES))
    return rf"""
WITH table_of AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT)) AS b FROM conversations),
marked AS (SELECT *, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 20 AS f FROM given, table_of),
hurt AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM marked WHERE f <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
  regexp_extract(text, '([^{space}])[{space}]*$', 1) AS final FROM hurt),
compared AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again FROM placed),
judged AS (SELECT *, final = '' AS blank, final <> '' AND again AS duplicate, final <> '' AND NOT again AND final NOT IN ('.', '!', '?') AS truncated,
  CASE {code} ELSE {NO_ROLE} END AS code, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS two FROM compared),
lists AS (SELECT conv_id, list({{'code': code, 'fault': CASE WHEN blank OR duplicate THEN {MUST_GO} ELSE 0 END, 'more': CASE WHEN truncated THEN {TRUNCATED} ELSE 0 END,
    'line': chr(10) || role || ':' || text, 'said': text}} ORDER BY n DESC) AS rows,
  coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
  count(*) FILTER (truncated) AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
folded AS (SELECT *, list_reduce(rows, lambda v, r: {typed.format(fold)}, {typed.format(last)})[1] AS best FROM lists),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.b, 2), '')) AS repaired_sha256
FROM ids i LEFT JOIN folded f ON f.conv_id IS NOT DISTINCT FROM i.conv_id"""
