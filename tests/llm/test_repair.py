"""Mended conversations against a plain search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from tidemill.llm import registered, repair

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}  # what may follow the last initial
BAD = "[.!?][\x20\x09-\x0d]*\\Z"


def plain(rows):
    """Report of one conversation's rows (turn, role, text), in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        if not re.search("[^\x20\x09-\x0d]", text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if re.search(BAD, text) else "truncated")
        seen.add((role, text))

    @functools.cache
    def best(i, last, inserted):
        """Least (cost, edits, rows) from row i on, behind an initial and so many inserted rows."""
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        new = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[new]
        if inserted < 3:
            found.append(more(3, "I", (name, ""), best(i, new, inserted + 1)))
        if i < len(rows):
            _, role, text = rows[i]
            found.append(more(4, "D", None, best(i + 1, last, 0)))
            if faults[i] not in ("blank", "duplicate"):
                late = 3 * (faults[i] == "truncated")
                if role[:1] and role[:1] in NEXT[last]:
                    found.append(more(late, "K", (role, text), best(i + 1, role[:1], 0)))
                found.append(more(late + 3, "R", (name, text), best(i + 1, new, 0)))
        return min(found) if found else (10**9, "", ())

    def more(cost, edit, row, rest):
        return cost + rest[0], edit + rest[1], ((row,) if row else ()) + rest[2]

    cost, audit, left = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
        faults.count("truncated"), sum(x not in ("su", "ua", "au") for x in pairs), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
    )


def ordered(rows):
    def digest(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()

    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[1], r[2])))


def _random(rng, n):
    texts = ["Yes.", "No!", "cut off", "", " \t\n", "What?", "Done. ", "x"]
    roles = ["user", "assistant", "system", "tool", "", "ubuntu"]
    return [(rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts) + rng.choice(["", "a.", "b"])) for _ in range(n)]


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_walk_against_all_edits():
    rng = random.Random(1)
    for _ in range(1500):
        initials = [rng.choice("suat") for _ in range(rng.randint(0, 12))]
        steps = [rng.randint(1, 3) if rng.random() < 0.2 else (x, rng.random() < 0.3) for x in initials]
        rows = []
        for i, step in enumerate(steps):
            many = step if isinstance(step, int) else 1
            rows += [(i, "t", "") if isinstance(step, int) else (i, step[0], f"{i}" + "." * (not step[1]))] * many
        want = plain(rows)
        edits, cost, state = repair.walk(steps, repair.END, repair.START, True)
        assert (cost, "".join(edits)) == want[5:7]
        assert state in (repair.START, repair.ASSISTANT)
        assert repair.applied(repair.matrix(steps), repair.END)[repair.START] == cost


def test_a_walk_stores_few_vectors():
    steps = [("u" if i % 3 else "a", i % 7 == 0) for i in range(10000)]
    made, most, before = [0], [0], repair.before

    def counted(step, v):
        made[0] += 1
        return before(step, v)

    repair.before = counted
    try:
        repair.walk(steps, repair.END, repair.START, True)
    finally:
        repair.before = before
    assert made[0] <= 2 * len(steps)


@pytest.mark.parametrize("rows_of_a_block", [1, 3, 1024])
def test_conversations_in_spark(spark, rows_of_a_block, monkeypatch):
    """However a conversation is cut into blocks and parts, the report is the same."""
    monkeypatch.setattr(repair, "ROWS", rows_of_a_block)
    rng = random.Random(rows_of_a_block)
    given = {i: _random(rng, rng.choice([0, 1, 2, 5, 9])) for i in [None, *range(40)]}
    given[99] = _random(rng, 60) + [(5, "user", "again and again.")] * 50
    given[7] = [(None, None, None), (3, "user", None)]
    rows = [(i, *row, "x", 1) for i, part in given.items() for row in part]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, id string, part int")
    blocks = repair.mended_blocks(df)
    found = {r["conv_id"]: tuple(r[x] for x in REPORT) for r in repair.reports(blocks).collect()}
    assert found == {i: plain(tuple(ordered(part))) for i, part in given.items() if part}
    left = repair.mended_rows(blocks)
    assert left.columns == ["conv_id", "part", "block", "nth", "role", "text"]
    for id, of_id in given.items():
        own = sorted((r for r in left.collect() if r["conv_id"] == id), key=lambda r: r[1:4]) if id in (None, 99, 7) else []
        if own:
            joined = "\n".join(f"{r['role']}:{r['text']}" for r in own)
            assert hashlib.sha256(joined.encode()).hexdigest() == found[id][-1]


def test_long_texts_and_empty_tables(spark):
    fields = "conv_id string, turn long, role string, text string"
    rows = [("a", i, "user" if i % 2 else "assistant", "x" * 3_000_000 + str(i)) for i in range(5)]
    found = repair.reports(repair.mended_blocks(spark.createDataFrame(rows, fields))).collect()
    assert [tuple(r[x] for x in REPORT) for r in found] == [plain(tuple(r[1:] for r in rows))]
    assert repair.reports(repair.mended_blocks(spark.createDataFrame([], fields))).collect() == []


def damage(rows):
    out = []
    for id, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if id is None else id}:{' ' if turn is None else turn}".encode()) % 20
        text, role = " " if text is None else text, " " if role is None else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(id, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def _wanted(rows):
    left = damage(rows)
    want = {}
    for id in {r[0] for r in rows}:
        own = ordered([r[1:] for r in left if r[0] == id])
        want[id] = plain(tuple(own))
    return want


def test_query_over_whole_conversations(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = registered.QUERIES["op12_conversation_repair"](spark, sf)
    assert found.columns == ["conv_id", *REPORT]
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == _wanted(rows)


def test_query_on_hard_rows(spark, tmp_path):
    """Conversations that lose all rows are reported with zeros."""
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(4)]), rng.choice([None, "user", "assistant"]),
             rng.choice([None, "", "Well.", "so"])) for _ in range(150)]
    lost = next(i for i in range(100, 1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "Well."))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r[0]: tuple(r)[1:] for r in registered.QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    assert found == _wanted(rows)
    assert found[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
