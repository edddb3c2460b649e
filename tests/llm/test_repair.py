"""Conversation repair against a full chart, all edit sequences, and odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest
from texts import ODD, with_clashes

from probity.llm import repair

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING"
RIGHT = re.compile("(s?(ua)+)?")
CODES = [(i, f) for i in ("s", "u", "a", "x") for f in range(4)]


def all_splits(rows):
    """The chart of every interval with every split."""
    n = len(rows)
    cells = {(i, i + 1): repair.row_cells(initial, fault) for i, (initial, fault) in enumerate(rows)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            merged = {}
            for k in range(i + 1, i + size):
                for key, found in repair.joined(cells[i, k], cells[k, i + size]).items():
                    merged[key] = min(found, merged.get(key, found))
            cells[i, i + size] = merged
    return cells[0, n]


def by_trying(rows, most=2):
    """The least (cost, audit) of all edits with at most so many insertions."""
    edits = []
    for initial, fault in rows:
        own = [(2, "D", "")]
        if fault in (repair.NONE, repair.TRUNCATED):
            cut = 5 if fault == repair.TRUNCATED else 0
            own += [(cut, "K", initial), (cut + 1, "R", "u"), (cut + 1, "R", "a")]
        edits.append(own)
    best = None
    for chosen in itertools.product(*edits):
        for extra in range(most + 1):
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), extra):
                for roles in itertools.product("ua", repeat=extra):
                    steps = []
                    for at in range(len(rows) + 1):
                        steps += [(5, "I", r) for p, r in zip(places, roles, strict=True) if p == at]
                        steps += chosen[at : at + 1]
                    if RIGHT.fullmatch("".join(s[2] for s in steps)):
                        found = (sum(s[0] for s in steps), "".join(s[1] for s in steps))
                        best = found if best is None else min(best, found)
    return best


def least(cells):
    return min(cells["S", q] for q in repair.END if ("S", q) in cells)


def test_one_split_of_each_interval_is_as_good_as_all():
    draw = random.Random(5)
    for _ in range(150):
        rows = tuple(draw.choice(CODES) for _ in range(draw.randint(1, 12)))
        assert repair.chart(tuple((i if i != "x" else "", f) for i, f in rows)) == all_splits(rows)


def test_least_edits_are_those_of_trying_all():
    draw = random.Random(6)
    for _ in range(120):
        rows = tuple(draw.choice(CODES) for _ in range(draw.randint(1, 3)))
        assert least(repair.chart(rows)) == by_trying(rows)


def expected(rows):
    """The report of one conversation's rows (turn, role, text), by the full chart."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
    rows = [(t, r or "", x or "") for t, r, x in rows]
    faults, seen = [], set()
    for _, role, text in rows:
        tail = text.rstrip(repair.SPACES)[-1:]
        own = repair.BLANK if not tail else repair.DUPLICATE if (role, text) in seen else 0
        faults.append(own or (0 if tail in ".!?" else repair.TRUNCATED))
        seen.add((role, text))
    cost, audit = least(all_splits([(r[:1], f) for (_, r, _), f in zip(rows, faults, strict=True)]))
    made = repair.edited([(r, x) for _, r, x in rows], audit)
    whole = "\n".join(f"{role}:{text}" for edit, role, text, _ in made if edit != "D")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    counts = [faults.count(f) for f in (repair.BLANK, repair.DUPLICATE, repair.TRUNCATED)]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest())


def some_conversations(seed=7, count=60):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \n", "Why?  ", "naïve 你好.", "a\x0b", None]
    roles = ["user", "assistant", "system", "tool", "", None, "uzbek"]
    rows = []
    for conv in range(count):
        turns = [draw.choice([None, *range(12)]) for _ in range(draw.randint(1, 14))]
        rows += [(conv, t, draw.choice(roles[: draw.choice([3, 7])]), draw.choice(texts)) for t in turns]
    return [*rows, (None, 1, "user", "Hello."), (None, 2, "assistant", "Hi."), (None, 2, "assistant", "Hi.")]


def by_conversation(rows):
    found = {}
    for conv, *row in rows:
        found.setdefault(conv, []).append(tuple(row))
    return found


def test_reports_are_those_of_the_full_chart(spark, rows):
    given = some_conversations()
    report = repair.repair(with_clashes(rows(SCHEMA, given))).collect()
    assert {r[0]: tuple(r)[1:] for r in report} == {c: expected(own) for c, own in by_conversation(given).items()}


def test_a_long_conversation_is_joined_from_blocks(spark, rows, monkeypatch):
    draw = random.Random(8)
    roles = ["user", "assistant", "assistant", "user", "system"]
    long = [(1, k, draw.choice(roles), f"Text {draw.randint(0, 80)}{draw.choice('.!x')}") for k in range(140)]
    # The same rows in blocks of several sizes; workers have the size of the module, so run it here.
    want = expected([r[1:] for r in long])
    for size in (1, 7, 64, 256):
        monkeypatch.setattr(repair, "BLOCK", size)
        whole, seen = repair._Conversation(1), set()
        for _, turn, role, text in long:
            again = (role, text) in seen
            seen.add((role, text))
            own = repair.TRUNCATED if text[-1] == "x" else repair.NONE
            whole.add(turn, role, text, repair.DUPLICATE if again else own)
        assert whole.result()[1:] == want
    many = [(2, k, "user" if k % 2 == 0 else "assistant", f"Number {k}.") for k in range(3000)]
    report = repair.repair(rows(SCHEMA, [*long, *many])).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in report}[1] == want
    assert {r["conv_id"]: (r["cost"], set(r["audit"])) for r in report}[2] == (0, {"K"})


def test_repaired_turns_have_the_digest_of_the_report(spark, rows):
    given = rows(SCHEMA, some_conversations(9))
    report = repair.repair(given)
    made = by_conversation([tuple(r) for r in repair.repaired_turns(given, report).collect()])
    for r in report.collect():
        own = sorted(made.get(r["conv_id"], []))
        assert "".join(o[1] for o in own) == r["audit"]
        lines = "\n".join(f"{o[2]}:{o[3]}" for o in own if o[1] != "D")
        assert hashlib.sha256(lines.encode()).hexdigest() == r["repaired_sha256"]
        assert RIGHT.fullmatch("".join(o[2][:1] for o in own if o[1] != "D"))


@pytest.mark.parametrize("given", [[], [(1, None, None, None)], [(1, 1, "user", t) for t in ODD]])
def test_odd_rows(spark, rows, given):
    report = repair.repair(rows(SCHEMA, given)).collect()
    assert {r[0]: tuple(r)[1:] for r in report} == {c: expected(own) for c, own in by_conversation(given).items()}


def test_query_on_damaged_rows_keeps_every_conversation(spark, tmp_path, rows):
    from zlib import crc32

    from probity.llm.queries import op11_conversation_repair

    given = [*some_conversations(10, 40), *[(c, 0, "user", "Alone.") for c in range(1000, 1060)]]
    rows(SCHEMA, given).write.parquet(str(tmp_path / "conversations.parquet"))
    after = {conv: [] for conv, *_ in given}
    for conv, turn, role, text in given:
        way = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        row = (turn, "user" if way == 4 else role, text)
        after[conv] += [row] * (0 if way == 0 else 2 if way == 3 else 1)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {c: expected(own) if own else nothing for c, own in after.items()}
    assert nothing in want.values()
    found = op11_conversation_repair(spark, str(tmp_path)).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == want
