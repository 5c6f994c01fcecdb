import hashlib
import itertools
import random
import re
import zlib

import pytest

from practica.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string, audit string, start string, digest string, place string, cost string"
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:c.START], hashlib.sha256(r[3].encode()).digest()))


def faults(rows):
    seen, out = set(), []
    for r in rows:
        text = r[3].rstrip(SPACES)
        out.append(c.BLANK if not text else c.DUPLICATE if r[2:4] in seen else c.CUT if text[-1] not in ".!?" else c.FINE)
        seen.add(r[2:4])
    return out


def cheapest(turns):
    """(cost, audit) of (fault, initial) by plain strings, all states."""
    def insert(best):
        for _ in range(3):
            for state, nxt in (("", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                if state in best:
                    new = best[state][0] + 5, best[state][1] + "I"
                    best[nxt] = min(best.get(nxt, new), new)
        return best
    best = insert({"": (0, "")})
    for fault, initial in turns:
        after = {}
        for state, (cost, audit) in best.items():
            moves = [(state, cost + 2, "D")]
            if fault not in (c.BLANK, c.DUPLICATE):
                more = cost + 5 * (fault == c.CUT)
                if state + initial in ("s", "u", "su", "ua", "au"):
                    moves.append((initial, more, "K"))
                moves.append(("a" if state == "u" else "u", more + 1, "R"))
            for nxt, cost2, letter in moves:
                new = cost2, audit + letter
                after[nxt] = min(after.get(nxt, new), new)
        best = insert(after)
    return min(best[s] for s in ("", "a") if s in best)


def every_edit(turns):
    """(cost, audit) by trying all edits with up to two insertions at a place."""
    best = None
    gaps = ["", "u", "a", "ua", "au", "uu"]
    options = []
    for fault, initial in turns:
        some = [("D", "", 2)]
        if fault not in (c.BLANK, c.DUPLICATE):
            more = 5 * (fault == c.CUT)
            some += [("K", initial, more), ("R", "u", more + 1), ("R", "a", more + 1)]
        options.append(some)
    for edits in itertools.product(*options):
        for put in itertools.product(gaps, repeat=len(turns) + 1):
            roles = put[0] + "".join(e[1] + p for e, p in zip(edits, put[1:]))
            if re.fullmatch("(s?(ua)+)?", roles):
                audit = "I" * len(put[0]) + "".join(e[0] + "I" * len(p) for e, p in zip(edits, put[1:]))
                new = sum(e[2] for e in edits) + 5 * sum(map(len, put)), audit
                best = new if best is None or new < best else best
    return best


def solve(turns, size):
    runs = [turns[i:i + size] for i in range(0, len(turns), size)]
    return c.join_segments([c.run_segment(r, False) for r in runs])


def test_all_edits_of_short_conversations():
    kinds = list(itertools.product((c.FINE, c.BLANK, c.CUT), "suax"))
    for n in (0, 1, 2):
        for turns in itertools.product(kinds, repeat=n):
            want = every_edit(turns)
            assert cheapest(turns) == want
            if n:
                assert c.join_segments([c.run_segment(list(turns), True)]) == want


@pytest.mark.parametrize("prime", [None, 3])
def test_long_conversations_in_runs_of_any_size(monkeypatch, prime):
    if prime:       # nearly all hashes collide: the comparison itself decides
        monkeypatch.setattr(c, "_PRIME", prime)
    rng = random.Random(5)
    for n in (3, 7, 40, 90):
        for _ in range(12):
            turns = [(rng.choice([c.FINE] * 5 + [c.BLANK, c.DUPLICATE, c.CUT]), rng.choice("suauauax")) for _ in range(n)]
            want = cheapest(turns)
            assert c.join_segments([c.run_segment(turns, True)]) == want
            for size in (1, 4, 33):
                assert solve(turns, size) == want
    turns = [(c.FINE, "u")] * 2000
    assert solve(turns, 700) == cheapest(turns)


def repaired(rows, audit):
    out, state, i = [], "", 0
    for letter in audit:
        if letter == "D":
            i += 1
        elif letter == "K":
            state = rows[i][2][0]
            out.append(rows[i][2] + ":" + rows[i][3])
            i += 1
        else:
            state = "a" if state == "u" else "u"
            out.append({"a": "assistant:", "u": "user:"}[state] + (rows[i][3] if letter == "R" else ""))
            i += letter == "R"
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = in_order(damaged([r for r in rows if r[0] == conv]))
        found = faults(mine)
        initials = [r[2][:1] or " " for r in mine]
        cost, audit = cheapest(list(zip(found, initials)))
        turns = [r[1] for r in mine if r[1] is not None]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count(c.BLANK),
                    found.count(c.DUPLICATE), found.count(c.CUT),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    repaired(mine, audit)))
    return sorted(out, key=str)


def table(spark):
    rng = random.Random(8)
    texts = ["Hello there.", "What? ", "no end", "", " \n", None, "Yes!\r\n", "end ", "long " * 4000 + ".", "same start of a text A.",
             "same start of a text B."]
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 12)):
            rows.append((conv, rng.choice([turn, turn, turn, turn * 3, None]), rng.choice(
                ["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"]), rng.choice(texts)))
    rows += [(None, i, "user", "a.") for i in range(4)] + [(999, None, None, None), (7, 1, "user", "x.")]
    rows += [(1000, i, rng.choice(["user", "assistant", "system"]), rng.choice(texts)) for i in range(600)]
    return rows + rows[:40]


@pytest.mark.parametrize("size", [3, c.SEGMENT])
def test_equals_plain_strings(spark, size):
    rows = table(spark)
    turns = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)
    got = sorted(map(tuple, c.repair_conversations(turns, size).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    assert c.repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
