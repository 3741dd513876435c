"""Conversation repair against brute force, whole and in blocks."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from attestry.llm import conversations as cv

ROWS = "conv_id long, turn long, role string, text string"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def all_repairs(rows):
    """(cost, audit) of every edit script of a few rows (role, forced, truncated), with up to two inserts in each gap."""
    best = None
    gaps = list(itertools.product(("", "u", "a", "ua", "au"), repeat=len(rows) + 1))
    for edits in itertools.product("KDua", repeat=len(rows)):
        if any(f and e != "D" for e, (_, f, _) in zip(edits, rows, strict=True)):
            continue
        cost = sum({"K": 0, "D": 3}.get(e, 2) + (t if e != "D" else 0) for e, (_, _, t) in zip(edits, rows, strict=True))
        letters = ["R" if e in "ua" else e for e in edits]
        kept = [{"K": r, "D": ""}.get(e, e) for e, (r, _, _) in zip(edits, rows, strict=True)]
        for gap in gaps:
            if best and cost + 2 * sum(map(len, gap)) > best[0]:
                continue
            if re.fullmatch("(s?(ua)+)?", gap[0] + "".join(k + g for k, g in zip(kept, gap[1:], strict=True))):
                found = (cost + 2 * sum(map(len, gap)), "I" * len(gap[0]) + "".join(x + "I" * len(g) for x, g in zip(letters, gap[1:], strict=True)))
                best = min(best or found, found)
    return best


def by_strings(rows):
    """(cost, audit, turns) by a plain table that holds whole audits."""
    now = {0: (0, "", [])}
    closure = {0: ["", "u", "ua"], 1: ["", "u", "ua"], 2: ["", "a", "au"], 3: ["", "u", "ua"]}
    name = {"u": "user", "a": "assistant"}

    def inserted(state, cell, gap):
        for x in gap:
            state = NEXT[state, x]
        return state, (cell[0] + 2 * len(gap), cell[1] + "I" * len(gap), cell[2] + [f"{name[x]}:" for x in gap])

    for role, text, forced, truncated in rows:
        then = {}
        for p, cell in now.items():
            for gap in closure[p]:
                s, (c, a, t) = inserted(p, cell, gap)
                found = [(s, (c + 3, a + "D", t))]
                if not forced:
                    if (q := NEXT.get((s, role[:1]))) is not None:
                        found.append((q, (c + truncated, a + "K", t + [f"{role}:{text}"])))
                    found += [(q, (c + 2 + truncated, a + "R", t + [f"{name[x]}:{text}"])) for x in "ua" if (q := NEXT.get((s, x))) is not None]
                for q, x in found:
                    if q not in then or x[:2] < then[q][:2]:
                        then[q] = x
        now = then
    ends = [inserted(p, cell, gap) for p, cell in now.items() for gap in closure[p]]
    return min((x for s, x in ends if s in (0, 3)), key=lambda x: x[:2])


def brute(rows):
    """The contract's columns by conversation, from (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = []
        for c, turn, role, text in rows:
            if c == conv:
                cells = [" " if x is None else x for x in (c, turn, role, text)]
                hit = zlib.crc32(f"{cells[0]}:{cells[1]}".encode()) % 20
                role, text = cells[2], cells[3]
                if hit:
                    text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
                    own += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in own if t is not None]
        counts, seen, marked = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}, set(), []
        for _, role, text in own:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, left = by_strings(marked)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def same(spark, rows):
    got = {r[0]: tuple(r)[1:] for r in cv.digests(spark.createDataFrame(rows, ROWS)).collect()}
    assert got == brute(rows)


def test_every_script_of_short_conversations():
    rng = random.Random(5)
    for _ in range(120):
        rows = [(rng.choice("suaat"), rng.random() < 0.2, int(rng.random() < 0.3)) for _ in range(rng.randint(1, 3))]
        tables = [cv._deleted(1) if f else cv._ROWS["sua".find(r) % 4 + 4 * t] for r, f, t in rows]
        state, cost = cv.last_state(tables)
        states = cv.crossings(tables, 0, state)
        keys = [next(k for q, _, k in t[p] if q == n) for t, p, n in zip(tables, states, states[1:], strict=False)]
        assert (cost, "".join(keys) + "I" * cv._CLOSING[state]) == all_repairs(rows), rows


def test_blocks_cross_as_rows_do():
    rng = random.Random(6)
    for _ in range(40):
        tables = [cv._deleted(1) if rng.random() < 0.2 else rng.choice(cv._ROWS) for _ in range(rng.randint(2, 40))]
        state, _ = cv.last_state(tables)
        whole = cv.crossings(tables, 0, state)
        cuts = sorted({0, len(tables), *(rng.randint(0, len(tables)) for _ in range(3))})
        blocks = [cv._as_table(cv._summary(tables[a:b])) for a, b in itertools.pairwise(cuts)]
        assert cv.last_state(blocks) == cv.last_state(tables)
        assert cv.crossings(blocks, 0, state) == [whole[c] for c in cuts]


def test_random_conversations(spark):
    rng = random.Random(7)
    rows = []
    for conv in range(120):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, turn if rng.random() < 0.9 else rng.choice([None, 3]), role, rng.choice(["Hello.", "So, and", " ", "", None, "Why? ", f"n{turn}!"])))
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b."), *[(7, 2, "user", "Hello.")] * 5]
    same(spark, rows)


@pytest.mark.parametrize("bits", [2, 4])
def test_long_conversations_in_blocks(spark, monkeypatch, bits):
    """Fans of four tables over a conversation of hundreds of rows: several levels."""
    monkeypatch.setattr(cv, "BITS", bits)
    rng = random.Random(bits)
    long = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["x.", "y", f"t{t}."])) for t in range(300)]
    same(spark, long + [(c, t, rng.choice(["user", "assistant"]), f"{t}.") for c in range(2, 30) for t in range(rng.randint(1, 7))])


def test_repaired_turns_alternate(spark):
    df = spark.createDataFrame([(1, 0, "user", "a.", 1), (1, 1, "user", "b", 2), (1, 2, "assistant", "c.", 1), (2, 0, "assistant", " ", 1)], ROWS + ", copies long")
    left = [(r.conv_id, r.role, r.text) for r in cv.repaired(cv.edits(df)).orderBy("pos", "n").collect()]
    assert left == [(1, "user", "a."), (1, "assistant", "c.")]


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], ROWS)
    assert cv.digests(empty).count() == 0
    more = spark.createDataFrame([(1, 0, "user", "a.", 5, "x"), (1, 1, "assistant", "b." * 50_000, 6, "y")], ROWS + ", cost long, audit string")
    assert cv.digests(more).count() == 1
