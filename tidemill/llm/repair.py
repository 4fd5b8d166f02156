"""Conversations mended by the cheapest edits, found by a checkpointed dynamic programme.

A conversation's rows, in order of their turn, are kept, given another role or deleted,
and empty rows are inserted, until the roles' initials read ``(s?(ua)+)?``.  Which of
these comes next depends on the last initial alone, so four states and their costs to the
end tell all.  A walk over a block stores these vectors at checkpoints a square root of
its steps apart, counted from the end, and computes the ones between again while it goes
forward and emits, of the tight edits, the least in ASCII.

A block holds a bounded number of rows of one conversation.  Most conversations are one
block.  For those cut, by size or by the borders of the sort, each block's costs are a
4 x 4 matrix; matrices passed backwards give the vector at each block's end, the blocks'
walks from all four states, passed forwards, the state at its begin.  Only those small
rows of a long conversation pass through one task, its texts and steps do not.

Rows of one turn are in order of role, then of a digest of the text.  A row's fault is the
first that holds: blank (white space only), duplicate (role and text seen earlier),
truncated (the last character that is no white space does not end a sentence).

* Null role or text counts as one blank; a null turn comes before all others and belongs to
  no gap.  Rows with a null id are one conversation.
* Rows repeated in full are counted before they are sorted, and their texts move once.
* Empty and very long texts are rows like others; extra columns are ignored.
* An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemill.llm.components import written

ROWS = 1024          # steps of a block
BYTES = 4 << 20      # characters of text after which a block ends
BATCH = 8 << 20      # characters of text in one batch of blocks
SPACE = r"[\x20\x09-\x0D]"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3  # costs
FAR = 1 << 60
# States: nothing yet, behind s, behind u, behind a.
START, SYSTEM, USER, ASSISTANT = range(4)
ONWARD = (USER, USER, ASSISTANT, USER)  # the state behind a user or assistant row, whichever fits
KEPT_AS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}

Vector = tuple[int, int, int, int]
# A live row's initial and whether it is truncated, or a number of rows that must go.
Step = tuple[str, bool] | int


def closed(v: Vector) -> Vector:
    """Costs of the states when rows may be inserted first."""
    u, a = min(v[USER], v[ASSISTANT] + INSERT), min(v[ASSISTANT], v[USER] + INSERT)
    return min(v[START], u + INSERT), min(v[SYSTEM], u + INSERT), u, a


END = closed((0, FAR, FAR, 0))


def before(step: Step, v: Vector) -> Vector:
    """Costs in front of a step from those behind it."""
    if isinstance(step, int):
        return tuple(x + DELETE * step for x in v)
    initial, late = step
    more = TRUNCATED if late else 0
    out = [min(v[s] + DELETE, v[ONWARD[s]] + REROLE + more) for s in range(4)]
    for s, kept in enumerate(KEPT_AS):
        if initial in kept:
            out[s] = min(out[s], v[kept[initial]] + more)
    return closed(tuple(out))


def matrix(steps: list[Step]) -> list[int]:
    """Row s, column t: the cost from state s in front of the steps to state t behind them."""
    columns = []
    for t in range(4):
        v = closed(tuple(0 if s == t else FAR for s in range(4)))
        for step in reversed(steps):
            v = before(step, v)
        columns.append(v)
    return [min(columns[t][s], FAR) for s in range(4) for t in range(4)]


def applied(matrix: list[int], v: Vector) -> Vector:
    return tuple(min(min(matrix[4 * s + t] + v[t] for t in range(4)), FAR) for s in range(4))


def walk(steps: list[Step], end: Vector, state: int, last: bool) -> tuple[list[str], int, int]:
    """Edits of the steps from a state (for rows that must go, one item for all), cost, state behind.

    Rows may be inserted in front of each step, behind them all only if they are the last.
    """
    n = len(steps)
    width = max(1, math.isqrt(n))
    checkpoints, v = {n: end}, end
    for i in range(n - 1, -1, -1):
        v = before(steps[i], v)
        if i % width == 0:
            checkpoints[i] = v
    edits, cost = [], 0
    for begin in range(0, n, width):
        until = min(begin + width, n)
        vectors = [checkpoints[until]]
        for i in range(until - 1, begin - 1, -1):
            vectors.append(before(steps[i], vectors[-1]))
        vectors.reverse()
        for i in range(begin, until):
            step, here, behind = steps[i], vectors[i - begin], vectors[i - begin + 1]
            if isinstance(step, int):
                edits.append("D" * step)
                cost += DELETE * step
                continue
            initial, late = step
            more = TRUNCATED if late else 0
            while here[state] != behind[state] + DELETE and here[state] == here[ONWARD[state]] + INSERT:
                edits.append("I")
                cost += INSERT
                state = ONWARD[state]
            if here[state] == behind[state] + DELETE:
                edits.append("D")
                cost += DELETE
                continue
            kept = KEPT_AS[state].get(initial)
            if kept is not None and here[state] == behind[kept] + more:
                edits.append("K")
                state = kept
            else:
                edits.append("R")
                cost += REROLE
                state = ONWARD[state]
            cost += more
    while last and END[state]:
        edits.append("I")
        cost += INSERT
        state = ONWARD[state]
    return edits, cost, state


def _steps(kinds: list[int], roles: list[str]) -> list[Step]:
    """Steps from their stored form: 0 and 1 for a live row, -n for n rows that must go."""
    live = iter(roles)
    return [-x if x < 0 else (next(live)[:1], bool(x)) for x in kinds]


def _rows_left(
    steps: list[Step], edits: list[str], state: int, roles: list[str], texts: list[str]
) -> tuple[list[str], list[str]]:
    out_roles, out_texts = [], []
    live, ahead = zip(roles, texts), iter(steps)
    for edit in edits:
        if edit == "I":
            state = ONWARD[state]
            out_roles.append(ROLES[state])
            out_texts.append("")
            continue
        step = next(ahead)
        if isinstance(step, int):
            continue
        role, text = next(live)
        if edit == "D":
            continue
        state = ONWARD[state] if edit == "R" else KEPT_AS[state][role[:1]]
        out_roles.append(ROLES[state] if edit == "R" else role)
        out_texts.append(text)
    return out_roles, out_texts


COUNTS = "blank long, duplicate long, truncated long, illegal long"
PLACE = "part int, block int"
LEFT = "edits string, cost long, roles array<string>, texts array<string>"
STATS = f"{COUNTS}, first_initial string, last_initial string, first_turn long, last_turn long, turns long"


class _Block:
    """What is gathered of one block."""

    def __init__(self, id: object, block: int, begins: bool) -> None:
        self.id, self.block, self.begins = id, block, begins
        self.kinds: list[int] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.size = 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str | None, n: int, blank: bool, late: bool) -> None:
        """n equal rows; their text is given if they are the first with it."""
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.illegal += n - 1
        self.last = initial
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        if text is not None:
            self.kinds.append(int(late))
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(text)
            self.truncated += late
            n -= 1
        if blank:
            self.blank += n
        else:
            self.duplicate += n
        if n:
            self.kinds.append(-n)

    def full(self) -> bool:
        return len(self.kinds) >= ROWS or self.size >= BYTES

    def row(self, part: int, whole: bool) -> dict:
        steps = _steps(self.kinds, self.roles)
        out = {
            "id": self.id, "part": part, "block": self.block, "whole": whole, "kinds": self.kinds,
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
            "first_initial": self.first, "last_initial": self.last, "first_turn": self.first_turn,
            "last_turn": self.last_turn, "turns": self.turns,
            "roles": self.roles, "texts": self.texts, "matrix": None, "edits": None, "cost": None,
        }
        if whole:
            edits, cost, _ = walk(steps, END, START, True)
            out["roles"], out["texts"] = _rows_left(steps, edits, START, self.roles, self.texts)
            out["edits"], out["cost"] = "".join(edits), cost
        else:
            out["matrix"] = matrix(steps)
        return out


def _gathered(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted rows, numbered in their part.  What is surely one conversation is mended at once."""
    out, size, now, text_ahead, part = [], 0, None, None, 0
    for batch in batches:
        for id, turn, role, _, text, n, blank, late, part in zip(*(x.to_pylist() for x in batch.columns)):
            if now is None:
                now = _Block(id, 0, False)  # it may have begun in the part before
            elif now.id != id or (now.full() and text_ahead is None):
                out.append(now.row(part, now.begins and now.id != id))
                size += now.size
                now = _Block(id, now.block + 1, now.id != id)
            if not n:
                text_ahead = text
            else:
                now.add(turn, role, text_ahead, n, blank, late)
                text_ahead = None
            if size >= BATCH or len(out) >= 2000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
    if now is not None:
        out.append(now.row(part, False))  # it may go on in the part behind
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _passed(schema: pa.Schema, backwards: bool):
    """A function that hands vectors back, or states on, from block to block of a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, id, carried = False, None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                at_border = not begun or row["id"] != id
                begun, id = True, row["id"]
                if backwards:
                    vector = END if at_border else carried
                    out.append({**{k: row[k] for k in ("part", "block")}, "vector": list(vector), "last": at_border})
                    carried = applied(row["matrix"], vector)
                else:
                    state = START if at_border else carried
                    out.append({k: row[k] for k in ("part", "block", "vector", "last")} | {"state": state})
                    carried = row["ends"][state]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _arrow(schema: str | StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def _with_id(id_type: str, fields: str) -> str:
    return f"id {id_type}, {fields}"


def mended_blocks(
    rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Blocks of mended conversations, in order of part and block: edits, what is left, faults.

    id, part, block, whole (the block is the conversation), edits (initials), cost, roles
    and texts of the rows left, blank, duplicate, truncated, illegal (pairs of neighbours
    inside the block), first and last initial and turn, turns (distinct ones).
    """
    given = rows.select(
        rows[id].alias("id"), rows[turn].try_cast("long").alias("turn"),
        F.coalesce(rows[role].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(rows[text].cast("string"), F.lit(" ")).alias("text"),
    ).select(
        "*", (~F.col("text").rlike(rf"[^{SPACE[1:-1]}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?]{SPACE}*\z")).alias("late"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
    )
    id_type = given.schema["id"].dataType.simpleString()
    counted = given.groupBy("id", "turn", "role", "digest", "blank", "late").agg(F.count("*").alias("n"))
    firsts = given.where("not blank").groupBy("id", "role", "text", "digest", "late").agg(
        F.bool_or(F.col("turn").isNull()).alias("unplaced"), F.min("turn").alias("least")
    )
    runs = firsts.select(
        "id", F.when(~F.col("unplaced"), F.col("least")).alias("turn"), "role", "digest", "text",
        F.lit(0).cast("long").alias("n"), F.lit(False).alias("blank"), "late",
    ).unionByName(counted.withColumn("text", F.lit(None).cast("string")))
    order = ["id", "turn", "role", "digest"]
    # A text stands in front of the count of its first turn.
    ranged = runs.repartitionByRange(*order).sortWithinPartitions(*order, "n")
    fields = _with_id(id_type, f"{PLACE}, whole boolean, kinds array<long>, {STATS}, {LEFT}, matrix array<long>")
    schema = _arrow(fields)
    ranged = ranged.select(*order, "text", "n", "blank", "late", F.spark_partition_id().alias("part"))
    blocks = written(ranged.mapInArrow(lambda batches: _gathered(batches, schema), fields), "conversations")

    cut = blocks.where("not whole")
    vector_fields = f"{PLACE}, vector array<long>, last boolean"
    backwards = _passed(_arrow(vector_fields), True)
    vectors = (
        cut.select("id", "part", "block", "matrix").repartition("id")
        .sortWithinPartitions("id", F.desc("part"), F.desc("block")).mapInArrow(backwards, vector_fields)
    )
    end_fields = _with_id(id_type, f"{vector_fields}, ends array<int>")
    end_schema = _arrow(end_fields)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                steps, vector = _steps(row["kinds"], row["roles"]), tuple(row["vector"])
                row["ends"] = [walk(steps, vector, s, row["last"])[2] for s in range(4)]
                out.append({k: row[k] for k in end_schema.names})
            yield pa.RecordBatch.from_pylist(out, schema=end_schema)

    initials = F.transform("roles", lambda x: F.substring(x, 1, 1)).alias("roles")
    ended = cut.select("id", "part", "block", "kinds", initials).join(vectors, ["part", "block"])
    state_fields = f"{vector_fields}, state int"
    forwards = _passed(_arrow(state_fields), False)
    states = (
        ended.select("id", "part", "block", "kinds", "roles", "vector", "last").mapInArrow(ends, end_fields)
        .repartition("id").sortWithinPartitions("id", "part", "block").mapInArrow(forwards, state_fields)
    )
    out_fields = _with_id(id_type, f"{PLACE}, whole boolean, {STATS}, {LEFT}")
    out_schema = _arrow(out_fields)

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A block at a time: each may hold BYTES of text.
            for row in (x for i in range(batch.num_rows) for x in batch.slice(i, 1).to_pylist()):
                steps = _steps(row["kinds"], row["roles"])
                edits, row["cost"], _ = walk(steps, tuple(row["vector"]), row["state"], row["last"])
                row["roles"], row["texts"] = _rows_left(steps, edits, row["state"], row["roles"], row["texts"])
                row["edits"] = "".join(edits)
                yield pa.RecordBatch.from_pylist([{k: row[k] for k in out_schema.names}], schema=out_schema)

    mended = cut.join(written(states, "states"), ["part", "block"]).mapInArrow(mend, out_fields)
    names = [x.name for x in StructType.fromDDL(out_fields)]
    done = blocks.where("whole").withColumn("whole", F.lit(True)).select(*names)
    return done.unionByName(mended.withColumn("whole", F.lit(False)))


def mended_rows(blocks: DataFrame, id: str = "conv_id") -> DataFrame:
    """Rows left, with the place that puts them in order: id, part, block, nth, role, text."""
    rows = F.posexplode(F.arrays_zip("roles", "texts")).alias("nth", "row")
    return blocks.select(F.col("id").alias(id), "part", "block", rows).select(
        id, "part", "block", "nth", F.col("row.roles").alias("role"), F.col("row.texts").alias("text")
    )


def reports(blocks: DataFrame, id: str = "conv_id") -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit (edits), repaired_sha256.

    The digest runs over all rows left in order; blocks of a conversation that was cut pass
    through one task for it, one after the other.
    """
    id_type = blocks.schema["id"].dataType.simpleString()
    fields = _with_id(id_type, f"gaps long, {COUNTS}, cost long, audit string, repaired_sha256 string")
    schema = _arrow(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def row() -> dict:
            turns = now["last"] - now["first"] + 1 - now["turns"] if now["turns"] else 0
            return {
                "id": now["id"], "gaps": turns, "audit": "".join(now["audit"]), "repaired_sha256": now["sha"].hexdigest(),
                **{k: now[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")},
            }

        for batch in batches:
            for x in (x for i in range(0, batch.num_rows, 64) for x in batch.slice(i, 64).to_pylist()):
                if now is None or now["id"] != x["id"]:
                    if now is not None:
                        out.append(row())
                    now = {"id": x["id"], "sha": hashlib.sha256(), "audit": [], "any": False, "initial": None}
                    now |= dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
                    now |= {"first": None, "last": None}
                for key in ("blank", "duplicate", "truncated", "illegal", "cost", "turns"):
                    now[key] += x[key]
                if x["first_initial"] is not None:
                    if now["initial"] is not None and now["initial"] + x["first_initial"] not in LEGAL:
                        now["illegal"] += 1
                    now["initial"] = x["last_initial"]
                if x["first_turn"] is not None:
                    now["turns"] -= x["first_turn"] == now["last"]
                    now["first"] = x["first_turn"] if now["first"] is None else now["first"]
                    now["last"] = x["last_turn"]
                now["audit"].append(x["edits"])
                for role, text in zip(x["roles"], x["texts"]):
                    now["sha"].update(f"{chr(10) if now['any'] else ''}{role}:{text}".encode())
                    now["any"] = True
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if now is not None:
            out.append(row())
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    cut = blocks.where("not whole").repartition("id").sortWithinPartitions("id", "part", "block")
    whole = blocks.where("whole").mapInArrow(run, fields)
    return whole.unionByName(cut.mapInArrow(run, fields)).withColumnRenamed("id", id)
