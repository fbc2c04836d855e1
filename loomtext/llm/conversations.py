"""Conversation repair at least cost by divide and conquer.

The roles of a repaired conversation read ``(s?(ua)+)?``, which an automaton of four states accepts. Half of a conversation gives the costs forward from a
state, the other half the costs backward from a state; where both meet, the crossing of least total cost and, among equals, of the least
audit is taken, and both halves are repaired the same way (Hirschberg 1975), in space linear in the rows.

A stretch of rows is summed up by the costs from every state to every state and by the order of the audits they stand for. So the crossings of a conversation of any length
are found first between what partitions hold, then between pieces of bounded length, and only then between rows.

Why an order of end states is enough: from one state each letter of an audit leads to one state only, so different end states have different
audits; each holds one letter that is no insertion for every row and ends in one (insertions stand before a row), so none begins another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import count, pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import saved

#: Costs of the edits; a truncated row that stays costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Nothing out yet, after s, after u, after a. The next role that each state lets in, and the state it leads to, for user and assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
NEVER = 1 << 60
SPACE = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
#: Rows and characters of a piece.
PIECE, PIECE_CHARS = 1_024, 4 << 20

REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
OPEN = "piece long, kinds string, sames array<binary>, roles array<string>, texts array<string>, illegal_inside long, first_initial string, last_initial string, first_turn long, last_turn long, turns long"
REWRITTEN = "conv_id long, piece long, kinds string, illegal_inside long, first_initial string, last_initial string, first_turn long, last_turn long, turns long, end int, cost long, audit string, lines string"


class Step:
    """Costs from state to state, the edits' letters (of a single row), and the order of the end states' audits."""

    def __init__(self, cost: list[list[int]], rank: list[list[int]], letters: list[list[str]] | None = None) -> None:
        self.cost, self.rank, self.letters = cost, rank, letters

    def flat(self) -> list[int]:
        return [x for table in (self.cost, self.rank) for line in table for x in line]

    @staticmethod
    def of(flat: list[int]) -> Step:
        lines = [list(flat[i : i + 4]) for i in range(0, 32, 4)]
        return Step(lines[:4], lines[4:])


def _inserted(state: int) -> Iterator[tuple[int, int, str]]:
    """(state, cost, letters) after 0 to 2 insertions; more come back to a state that fewer reach."""
    for n in range(3):
        yield state, n * INSERT, "I" * n
        state = NEXT[state][1]


def _ranked(lines: list[list[object]], cost: list[list[int]]) -> list[list[int]]:
    """Places of the end states in the order of the keys, for each begin."""
    placed = []
    for keys, costs in zip(lines, cost, strict=True):
        order = sorted((e for e in range(4) if costs[e] < NEVER), key=lambda e: keys[e])
        placed.append([order.index(e) if costs[e] < NEVER else 4 for e in range(4)])
    return placed


def _step(edits: Callable[[int], Iterator[tuple[int, int, str]]]) -> Step:
    """The step whose cheapest way from state to state is the best of insertions and one of ``edits`` (state, cost, letter)."""
    cost, letters = [[NEVER] * 4 for _ in range(4)], [[""] * 4 for _ in range(4)]
    for begin in range(4):
        for state, paid, inserted in _inserted(begin):
            for end, price, letter in edits(state):
                if (paid + price, inserted + letter) < (cost[begin][end], letters[begin][end]) or cost[begin][end] == NEVER:
                    cost[begin][end], letters[begin][end] = paid + price, inserted + letter
    return Step(cost, _ranked(letters, cost), letters)


def _row_edits(kind: str) -> Callable[[int], Iterator[tuple[int, int, str]]]:
    stays = TRUNCATED if kind.isupper() else 0

    def edits(state: int) -> Iterator[tuple[int, int, str]]:
        yield state, DELETE, "D"
        if kind in "bd":
            return
        role, after = NEXT[state]
        if kind.lower() == role[0]:
            yield after, stays, "K"
        if kind.lower() == "s" and state == START:
            yield SYSTEM, stays, "K"
        yield after, REROLE + stays, "R"

    return edits


#: A row's kind: blank (b), duplicate (d), or the initial of its role (o: no known one), in upper case if it is truncated.
STEPS = {kind: _step(_row_edits(kind)) for kind in "bdsuaoSUAO"}
#: After the last row: insertions up to a state that ends a conversation. All ways lead to START.
END = _step(lambda state: iter([(START, 0, "")] if state in (START, ASSISTANT) else []))


def forward(steps: list[Step], low: int, high: int, begin: int) -> tuple[list[int], list[int]]:
    """Costs of the states after ``steps[low:high]`` from ``begin``, and the order of their least audits."""
    cost, rank = [NEVER] * 4, [4] * 4
    cost[begin] = rank[begin] = 0
    for at in range(low, high):
        step, best, keys = steps[at], [NEVER] * 4, [(4, 4)] * 4
        for end in range(4):
            total, place, via = min((cost[t] + step.cost[t][end], rank[t], t) for t in range(4))
            if total < NEVER:
                best[end], keys[end] = total, (place, step.rank[via][end])
        order = sorted(e for e in range(4) if best[e] < NEVER)
        order.sort(key=keys.__getitem__)
        cost, rank = best, [order.index(e) if best[e] < NEVER else 4 for e in range(4)]
    return cost, rank


def backward(steps: list[Step], low: int, high: int, end: int) -> list[int]:
    """Costs from every state over ``steps[low:high]`` to ``end``."""
    cost = [NEVER] * 4
    cost[end] = 0
    for at in range(high - 1, low - 1, -1):
        cost = [min(NEVER, min(steps[at].cost[s][t] + cost[t] for t in range(4))) for s in range(4)]
    return cost


def summed(steps: list[Step]) -> Step:
    """One step for all."""
    both = [forward(steps, 0, len(steps), begin) for begin in range(4)]
    return Step([c for c, _ in both], [r for _, r in both])


def crossings(steps: list[Step], begin: int, end: int) -> list[int]:
    """The states before, between and after the steps on the cheapest way of the least audit."""
    states = [begin] * len(steps) + [end]

    def between(low: int, high: int) -> None:
        if high - low < 2:
            return
        middle = (low + high) // 2
        cost, rank = forward(steps, low, middle, states[low])
        rest = backward(steps, middle, high, states[high])
        states[middle] = min((cost[s] + rest[s], rank[s], s) for s in range(4))[2]
        between(low, middle)
        between(middle, high)

    between(0, len(steps))
    return states


def audit(kinds: str, begin: int, end: int) -> list[str]:
    """The letters of each row."""
    steps = [STEPS[k] for k in kinds]
    return [step.letters[a][b] for step, (a, b) in zip(steps, pairwise(crossings(steps, begin, end)), strict=True)]


#: Repairs a task remembers; most conversations are of few kinds. A plain table, as it travels to the executors by value.
REMEMBERED, _known = 1 << 14, {}


def repaired(kinds: str) -> tuple[int, tuple[str, ...]]:
    """Cost and letters of a whole conversation, the last ones for its end."""
    if kinds not in _known:
        if len(_known) >= REMEMBERED:
            _known.clear()
        _known[kinds] = _repaired(kinds)
    return _known[kinds]


def _repaired(kinds: str) -> tuple[int, tuple[str, ...]]:
    steps = [*(STEPS[k] for k in kinds), END]
    states = crossings(steps, START, START)
    taken = list(zip(steps, pairwise(states), strict=True))
    return sum(s.cost[a][b] for s, (a, b) in taken), tuple(s.letters[a][b] for s, (a, b) in taken)


def rewritten(letters: Iterator[str], roles: list[str], texts: list[str], state: int) -> tuple[list[str], int]:
    """The ``role:text`` lines that the edits make of the rows, and the state after them."""
    lines = []
    for i, edits in enumerate(letters):
        for letter in edits:
            role, after = NEXT[state]
            if letter == "D":
                continue
            if letter == "K":
                after = SYSTEM if roles[i][:1] == "s" else after
                role = roles[i]
            lines.append(f"{role}:{'' if letter == 'I' else texts[i]}")
            state = after
    return lines, state


def kind_of(role: str, text: str) -> str:
    """A row's kind, duplicates aside."""
    said = text.rstrip(SPACE)
    if not said:
        return "b"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial if said[-1] in ".!?" else initial.upper()


def same_as(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


class Tally:
    """What is counted over the rows of a conversation, piece by piece."""

    def __init__(self) -> None:
        self.illegal = self.turns = 0
        self.initial = self.low = self.high = None

    def row(self, turn: int | None, role: str) -> None:
        self.join(0, role[:1], role[:1], turn, turn, int(turn is not None))

    def join(self, illegal: int, first: str | None, last: str | None, low: int | None, high: int | None, turns: int) -> None:
        """What follows: illegal pairs inside, first and last initial, first and last turn, different turns."""
        if first is not None:
            self.illegal += illegal + (self.initial is not None and self.initial + first not in LEGAL)
            self.initial = last
        if low is not None:
            self.turns += turns - (self.high == low)
            self.low = low if self.low is None else self.low
            self.high = high

    def gaps(self) -> int:
        missing = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (missing + (1 << 63)) % (1 << 64) - (1 << 63)


def counted(kinds: str) -> tuple[int, int, int]:
    """Blank, duplicate and truncated rows."""
    return kinds.count("b"), kinds.count("d"), sum(k.isupper() for k in kinds)


class Sheet:
    """Rows of a result, handed on in batches."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.size = schema, [], 0

    def put(self, row: dict, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= 2_048 or self.size > PIECE_CHARS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.size = [], 0


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in [*kinds.items(), ("binary", pa.binary())]}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, turn, role, text, live): a report for each conversation that lies inside of this partition, pieces of all others."""
    schema = _arrow(f"{REPORT}, {OPEN}")
    sheet, numbers = Sheet(schema), count(TaskContext.get().partitionId() << 32)
    rows: list[tuple[int | None, str, str]] = []
    began, key, whole, chars = False, None, False, 0

    def report() -> Iterator[pa.RecordBatch]:
        tally, seen, kinds = Tally(), set(), []
        for turn, role, text in rows:
            tally.row(turn, role)
            kind = kind_of(role, text)
            kinds.append("d" if kind != "b" and (role, text) in seen else kind)
            seen.add((role, text))
        kinds = "".join(kinds)
        cost, letters = repaired(kinds)
        lines, _ = rewritten(letters, [r for _, r, _ in rows], [t for _, _, t in rows], START)
        blank, duplicate, truncated = counted(kinds)
        yield from sheet.put({
            "conv_id": key, "gaps": tally.gaps(), "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": tally.illegal,
            "cost": cost, "audit": "".join(letters), "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        })

    def piece() -> Iterator[pa.RecordBatch]:
        tally, kinds = Tally(), "".join(kind_of(role, text) for _, role, text in rows)
        for turn, role, _ in rows:
            tally.row(turn, role)
        yield from sheet.put({
            "conv_id": key, "piece": next(numbers), "kinds": kinds, "sames": [None if k == "b" else same_as(r, t) for k, (_, r, t) in zip(kinds, rows, strict=True)],
            "roles": [r for _, r, _ in rows], "texts": [t for _, _, t in rows], "illegal_inside": tally.illegal,
            "first_initial": rows[0][1][:1] if rows else None, "last_initial": tally.initial, "first_turn": tally.low, "last_turn": tally.high, "turns": tally.turns,
        }, chars)

    for batch in batches:
        for conv, turn, role, text, live in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if not began or conv != key:
                if began:
                    yield from report() if whole else piece()
                whole, began, key, rows, chars = began, True, conv, [], 0  # the first may have begun in another partition
            if live:
                if len(rows) >= PIECE or chars + len(text) > PIECE_CHARS:
                    yield from piece()
                    whole, rows, chars = False, [], 0
                rows.append((turn, role, text))
                chars += len(text)
    if began:
        yield from piece()  # the last may go on in another one
    yield from sheet.rest()


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, piece, kinds, firsts) with the places of first rows: the kinds with duplicates, and the sum of the piece."""
    sheet = Sheet(_arrow("conv_id long, piece long, part long, kinds string, step array<long>"))
    for batch in batches:
        for row in batch.to_pylist():
            firsts = set(row["firsts"] or ())
            kinds = "".join(k if k == "b" or i in firsts else "d" for i, k in enumerate(row["kinds"]))
            step = summed([STEPS[k] for k in kinds]).flat()
            yield from sheet.put({"conv_id": row["conv_id"], "piece": row["piece"], "part": row["piece"] >> 32, "kinds": kinds, "step": step})
    yield from sheet.rest()


def _of_part(table: pa.Table) -> pa.Table:
    rows = sorted(table.select(["conv_id", "piece", "part", "step"]).to_pylist(), key=lambda r: r["piece"])
    whole = summed([Step.of(r["step"]) for r in rows]).flat()
    return pa.Table.from_pylist([{"conv_id": rows[0]["conv_id"], "part": rows[0]["part"], "step": whole}], _arrow("conv_id long, part long, step array<long>"))


def _between_parts(table: pa.Table) -> pa.Table:
    """One conversation: the states before and after what each partition holds."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    states = crossings([*(Step.of(r["step"]) for r in rows), END], START, START)
    made = [{"conv_id": r["conv_id"], "part": r["part"], "begin": a, "end": b} for r, (a, b) in zip(rows, pairwise(states[:-1]), strict=True)]
    return pa.Table.from_pylist(made, _arrow("conv_id long, part long, begin int, end int"))


def _between_pieces(table: pa.Table, known: pa.Table) -> pa.Table:
    rows = sorted(table.select(["piece", "kinds", "step"]).to_pylist(), key=lambda r: r["piece"])
    ends = known.to_pylist()[0]
    states = crossings([Step.of(r["step"]) for r in rows], ends["begin"], ends["end"])
    made = [{"piece": r["piece"], "kinds": r["kinds"], "begin": a, "end": b} for r, (a, b) in zip(rows, pairwise(states), strict=True)]
    return pa.Table.from_pylist(made, _arrow("piece long, kinds string, begin int, end int"))


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their states: the edits, their cost and the lines they make."""
    names = ["conv_id", "piece", "kinds", "illegal_inside", "first_initial", "last_initial", "first_turn", "last_turn", "turns", "end"]
    sheet = Sheet(_arrow(REWRITTEN))
    for batch in batches:
        for row in batch.to_pylist():
            letters = audit(row["kinds"], row["begin"], row["end"])
            lines, _ = rewritten(letters, row["roles"], row["texts"], row["begin"])
            steps = [STEPS[k] for k in row["kinds"]]
            cost = forward(steps, 0, len(steps), row["begin"])[0][row["end"]]
            made = {n: row[n] for n in names} | {"cost": cost, "audit": "".join(letters), "lines": "\n".join(lines) if lines else None}
            yield from sheet.put(made, len(made["lines"] or ""))
    yield from sheet.rest()



def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rewritten pieces in the order of conversation and piece: the reports. Lines pass by, only the audit is kept."""
    sheet = Sheet(_arrow(REPORT))
    began, key = False, None

    def report() -> dict:
        ended = END.letters[state][START]
        more = "\n".join(rewritten(iter([ended]), [], [], state)[0])
        digest.update((("\n" if any_line and more else "") + more).encode())
        return {
            "conv_id": key, "gaps": tally.gaps(), "blank": faults[0], "duplicate": faults[1], "truncated": faults[2], "illegal": tally.illegal,
            "cost": cost + END.cost[state][START], "audit": "".join([*audits, ended]), "repaired_sha256": digest.hexdigest(),
        }

    for batch in batches:
        for row in batch.to_pylist():
            if not began or row["conv_id"] != key:
                if began:
                    yield from sheet.put(report())
                began, key, tally, digest, faults = True, row["conv_id"], Tally(), hashlib.sha256(), [0, 0, 0]
                cost, audits, any_line = 0, [], False
            tally.join(row["illegal_inside"], row["first_initial"], row["last_initial"], row["first_turn"], row["last_turn"], row["turns"])
            faults = [a + b for a, b in zip(faults, counted(row["kinds"]), strict=True)]
            cost, state = cost + row["cost"], row["end"]
            audits.append(row["audit"])
            if row["lines"] is not None:
                digest.update((("\n" if any_line else "") + row["lines"]).encode())
                any_line = True
    if began:
        yield from sheet.put(report())
    yield from sheet.rest()


def damage(conversations: DataFrame) -> DataFrame:
    """Known damage to (conv_id, turn, role, text), and ``live``: false for a dropped row, which stays to keep its conversation known.

    ``crc32("conv_id:turn") % 20`` decides: 0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes the role user. A null counts
    as one space, in the key too. ``tie`` orders rows of one turn: a hash of role and text as they were. Other columns are left out.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(what == 1, "").when(what == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    hit = rows.select("*", what.alias("what"), F.xxhash64("role", "text").alias("tie"), F.explode(F.when(what == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    live, gone = F.col("what") != 0, F.lit(None).cast("string")
    return hit.select(
        "conv_id", "turn", F.when(live, F.when(F.col("what") == 4, "user").otherwise(F.col("role"))).otherwise(gone).alias("role"),
        F.when(live, text).otherwise(gone).alias("text"), live.alias("live"), "tie",
    )


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, live, tie): what is wrong with it and its cheapest repair.

    gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 as the module and ``Step`` define them. Rows are taken by turn (null first), then ``tie``; rows
    alike in all that are equal, so their order does not matter. A null conv_id is a conversation of its own; one without live rows has zeros, an empty audit and the hash of an empty
    text; null roles and texts of live rows count as one space. A role that starts with other than s, u or a cannot be kept; the empty role has no initial. An empty table gives an empty result.

    Rows are dealt by ranges of conversation and turn, so a conversation of any size is spread over tasks, and identical rows too. What lies inside of one partition is done there;
    of the others pieces of at most 1,024 rows are summed up. A task gets the sums of a conversation's partitions (one a partition at most), or of
    the pieces of one partition, never its rows. Only the hash of a repaired text is made by one task, which streams through its pieces: SHA-256 has no parallel form.
    """
    blank = lambda c: F.when(F.col("live"), F.coalesce(F.col(c), F.lit(" "))).alias(c)
    order = ["conv_id", "turn", "tie", "salt"]
    dealt = rows.select("conv_id", "turn", blank("role"), blank("text"), "live", "tie").withColumn("salt", F.monotonically_increasing_id())
    sorted_ = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "live")
    cut = saved(sorted_.mapInArrow(_cut, f"{REPORT}, {OPEN}"), "pieces")
    names = [c.split()[0] for c in REPORT.split(", ")]
    pieces = cut.where("piece IS NOT NULL")

    said = pieces.select("conv_id", "piece", F.posexplode("sames").alias("at", "same")).where("same IS NOT NULL")
    firsts = said.groupBy("conv_id", "same").agg(F.min(F.struct("piece", "at")).alias("first"))
    firsts = firsts.groupBy(F.col("first.piece").alias("piece")).agg(F.collect_list("first.at").alias("firsts"))
    marked = pieces.select("conv_id", "piece", "kinds").join(firsts, "piece", "left").select("conv_id", "piece", "kinds", "firsts")
    steps = saved(marked.mapInArrow(_marked, "conv_id long, piece long, part long, kinds string, step array<long>"), "steps")

    parts = steps.groupBy("conv_id", "part").applyInArrow(_of_part, "conv_id long, part long, step array<long>")
    ends = parts.groupBy("conv_id").applyInArrow(_between_parts, "conv_id long, part long, begin int, end int")
    states = steps.groupBy("conv_id", "part").cogroup(ends.groupBy("conv_id", "part")).applyInArrow(_between_pieces, "piece long, kinds string, begin int, end int")

    fixed = pieces.drop("kinds", *[n for n in names if n != "conv_id"]).join(states, "piece")
    wanted = [c.split()[0] for c in f"{REWRITTEN}, begin int, roles x, texts x".split(", ") if c.split()[0] not in ("cost", "audit", "lines")]
    lines = fixed.select(*wanted).mapInArrow(_rewrite, REWRITTEN)
    long = lines.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(_reported, REPORT)
    return cut.where("piece IS NULL").select(*names).unionByName(long)


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged conversations: one row for every conv_id of the input."""
    return repair(damage(conversations))
