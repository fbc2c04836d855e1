"""Conversation repair: against all ways to edit short conversations, against SQL on odd rows, and cut into pieces at every place."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from loomtext.llm import conversations as c

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def ways(kinds: str, state: int = c.START, inserted: int = 0):
    """All (cost, audit) that make a legal conversation."""
    if inserted < 2:
        for cost, audit in ways(kinds, c.NEXT[state][1], inserted + 1):
            yield cost + c.INSERT, "I" + audit
    if not kinds:
        if state in (c.START, c.ASSISTANT):
            yield 0, ""
        return
    kind, stays = kinds[0], c.TRUNCATED if kinds[0].isupper() else 0
    rest = lambda s: list(ways(kinds[1:], s))
    for cost, audit in rest(state):
        yield cost + c.DELETE, "D" + audit
    if kind in "bd":
        return
    role, after = c.NEXT[state]
    for cost, audit in rest(after):
        yield cost + c.REROLE + stays, "R" + audit
        if kind.lower() == role[0]:
            yield cost + stays, "K" + audit
    if kind.lower() == "s" and state == c.START:
        for cost, audit in rest(c.SYSTEM):
            yield cost + stays, "K" + audit


@pytest.mark.parametrize("seed", range(12))
def test_repair_is_the_least_of_all_ways(seed):
    rng = random.Random(seed)
    for _ in range(6):
        kinds = "".join(rng.choice("bdsuaoSUAO") for _ in range(rng.randint(0, 5)))
        cost, letters = c.repaired(kinds)
        assert (cost, "".join(letters)) == min(ways(kinds)), kinds


def test_repair_with_dear_deletions_inserts(monkeypatch):
    """Insertions are never cheapest at the real costs; with others they are, and the audits still agree."""
    for name, value in (("DELETE", 9), ("REROLE", 7), ("INSERT", 1)):
        monkeypatch.setattr(c, name, value)
    monkeypatch.setattr(c, "STEPS", {kind: c._step(c._row_edits(kind)) for kind in "bdsuaoSUAO"})
    monkeypatch.setattr(c, "END", c._step(lambda s: iter([(c.START, 0, "")] if s in (c.START, c.ASSISTANT) else [])))
    rng = random.Random(4)
    seen = set()
    for _ in range(60):
        kinds = "".join(rng.choice("suaobU") for _ in range(rng.randint(0, 4)))
        cost, letters = c._repaired(kinds)
        assert (cost, "".join(letters)) == min(ways(kinds)), kinds
        seen |= set("".join(letters))
    assert "I" in seen


def test_pieces_give_what_the_whole_gives():
    rng = random.Random(8)
    for _ in range(30):
        kinds = "".join(rng.choice("bdsuuaaoSUAO") for _ in range(rng.randint(1, 60)))
        cost, letters = c.repaired(kinds)
        cuts = sorted(rng.sample(range(len(kinds) + 1), min(len(kinds), rng.randint(0, 5))))
        pieces = [kinds[a:b] for a, b in zip([0, *cuts], [*cuts, len(kinds)], strict=True)]
        sums = [c.summed([c.STEPS[k] for k in p]) for p in pieces]
        states = c.crossings([*(c.Step.of(s.flat()) for s in sums), c.END], c.START, c.START)
        got = [x for p, a, b in zip(pieces, states, states[1:], strict=False) for x in c.audit(p, a, b)]
        assert "".join(got) + c.END.letters[states[-2]][c.START] == "".join(letters)
        assert c.forward([c.STEPS[k] for k in kinds], 0, len(kinds), c.START)[0][states[-2]] + c.END.cost[states[-2]][c.START] == cost


def by_hand(rows: list[tuple]) -> dict:
    """Reports of damaged conversations, row by row and with whole strings."""
    damaged, plain = defaultdict(list), lambda x: " " if x is None else x
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        kept = damaged[conv]
        what = zlib.crc32(f"{plain(conv)}:{plain(turn)}".encode()) % 20
        role, text = plain(role), plain(text)
        text = "" if what == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if what == 2 else text
        if what:
            kept += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    out = {}
    for conv, kept in damaged.items():
        kinds, seen = "", set()
        for _, role, text in kept:
            said = text.strip(c.SPACE)
            first = role[:1] if role[:1] in ("s", "u", "a") else "o"
            kinds += "b" if not said else "d" if (role, text) in seen else first if said[-1] in ".!?" else first.upper()
            seen.add((role, text))
        best = {c.START: (0, "", [])}
        for kind, (_, role, text) in zip(kinds, kept, strict=True):
            new = {}
            for state, (cost, audit, lines) in best.items():
                for n in range(3):
                    at, inserted = state, []
                    for _ in range(n):
                        inserted.append(f"{c.NEXT[at][0]}:")
                        at = c.NEXT[at][1]
                    start, stays = (cost + 5 * n, audit + "I" * n, lines + inserted), 5 if kind.isupper() else 0
                    to = [(at, 2, "D", [])]
                    if kind not in "bd":
                        to.append((c.NEXT[at][1], 1 + stays, "R", [f"{c.NEXT[at][0]}:{text}"]))
                        if kind.lower() == c.NEXT[at][0][0]:
                            to.append((c.NEXT[at][1], stays, "K", [f"{role}:{text}"]))
                        if kind.lower() == "s" and at == c.START:
                            to.append((c.SYSTEM, stays, "K", [f"{role}:{text}"]))
                    for end, price, letter, line in to:
                        way = (start[0] + price, start[1] + letter, start[2] + line)
                        new[end] = min(new.get(end, way), way)
            best = new
        ends = [(*way[:2], way[2]) for s, way in best.items() if s in (c.START, c.ASSISTANT)]
        ends += [(w[0] + 5, w[1] + "I", [*w[2], "assistant:"]) for s, w in best.items() if s == c.USER]
        ends += [(w[0] + 10, w[1] + "II", [*w[2], "user:", "assistant:"]) for s, w in best.items() if s == c.SYSTEM]
        cost, audit, lines = min(ends)
        turns = {t for t, _, _ in kept if t is not None}
        initials = [r[:1] for _, r, _ in kept]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("b"), kinds.count("d"), sum(k.isupper() for k in kinds),
            sum(a + b not in c.LEGAL for a, b in zip(initials, initials[1:], strict=False)), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def odd_conversations(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
    text = lambda: rng.choice(["Yes.", "No", "Why?", "", " \t", None, "Wait!  \n", "é😀.", f"number {rng.random()}.", f"no end {rng.random()}"])
    rows = [(conv, turn, role(), text()) for conv in range(60) for turn in range(rng.randint(1, 9)) if rng.random() < 0.9]
    rows += [(100, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(700)]  # far more than the others together
    rows += [(101, 0, "user", "the same")] * 300  # a third are alike in every column
    rows += [(None, t, "user", "no id?") for t in range(4)] + [(102, None, "assistant", "no turn.")]
    rows += [(103, t, role(), "long " * 50_000 + rng.choice("a.")) for t in range(5)]
    gone = next(n for n in range(1000, 9999) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    return [*rows, (gone, 0, "user", "dropped."), (104, -(2**63), "user", "first."), (104, 2**63 - 1, "assistant", "last.")]


@pytest.mark.parametrize("piece", [1_024, 16])
def test_reports_of_odd_conversations(spark, monkeypatch, piece):
    monkeypatch.setattr(c, "PIECE", piece)
    rows = odd_conversations()
    table = spark.createDataFrame(rows, SCHEMA).repartition(6).selectExpr("*", "'x' AS live", "'x' AS tie", "'x' AS piece", "1 AS salt", "2 AS what", "3 AS copy")
    got = {r.conv_id: tuple(r)[1:] for r in c.damaged_and_repaired(table).collect()}
    want = by_hand(rows)
    want[104] = ((want[104][0] + 2**63) % 2**64 - 2**63, *want[104][1:])  # wraps, as long arithmetic does
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv


def test_no_conversations(spark):
    assert c.damaged_and_repaired(spark.createDataFrame([], SCHEMA)).count() == 0


def test_undamaged_rows_can_be_repaired(spark):
    rows = [(1, 0, "user", "Hi.", True, 0), (1, 1, "user", "Hello.", True, 0), (2, 0, None, None, True, 0), (3, 0, "user", "x", False, 0)]
    table = spark.createDataFrame(rows, f"{SCHEMA}, live boolean, tie bigint")
    got = {r.conv_id: (r.blank, r.cost, r.audit, r.repaired_sha256) for r in c.repair(table).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {1: (0, 1, "KR", sha("user:Hi.\nassistant:Hello.")), 2: (1, 2, "D", sha("")), 3: (0, 0, "", sha(""))}
