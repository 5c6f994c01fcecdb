"""Conversation repair with a persistent audit.

A conversation's turns, in order, are kept, given another role, deleted, or
joined by inserted ones, at least cost, so that the initials of its roles read
``(s?(ua)+)?``; among the cheapest the ASCII-least string of edit initials (its
audit) counts. A dynamic program over four states (nothing yet, behind a system,
a user, an assistant turn) holds for each the least cost and its audit.

Audits are persistent: a linked node for each added part, whose parent is
shared by all audits that go on from it, with binary-lifting ancestors and a
rolling hash of the whole prefix. Equal costs compare by a search for the
longest common prefix over ancestors' hashes; the prefix that the hashes say is
common is then compared itself, up to nodes that are shared or were compared
before, and a collision moves the search before it.

Distribution: turns are numbered through by a range sort on (conversation, turn,
role, start of text, hash of text), so a conversation of any size is spread over
tasks. Each task runs the program over its runs of a conversation's turns, at
most ``SEGMENT`` turns at a time, from the one state that is possible at its
start, or from all four; the runs of a conversation, one row each, are then
joined in order by the same program with runs in the place of turns. Texts stay
out of this: only for the repaired conversation's hash, which takes its texts in
order, do they pass sorted through one task a conversation, one batch at a time.

Defined results: ``damage`` states the damage; a null role or text is one space
before it, as is a null id or turn in the damage's key. Turns of equal number
are ordered by role, then by text (the first ``START`` characters, then their
hash). An empty role's initial is a space, which no kept turn may have. Repeated
rows are duplicates of the first. A null conversation id is a conversation. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from practica.llm.common import release_memory
from practica.session import materialize

SEGMENT = 8_192             # turns of one run
START = 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FINE, BLANK, DUPLICATE, CUT = range(4)
# States: nothing, behind system, behind user, behind assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT_KEEP = {(EMPTY, "s"): SYSTEM, **{(s, "u"): USER for s in (EMPTY, SYSTEM, ASSISTANT)}, (USER, "a"): ASSISTANT}
NEXT_TURN = (USER, USER, ASSISTANT, USER)       # by a rerole or an insertion
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
SPACES = " \t\n\x0b\x0c\r"
_BASE, _PRIME = 0x5DEECE66D, (1 << 61) - 1


class Audit:
    """A string as its last part and the string before it."""

    __slots__ = ("parent", "part", "size", "hash", "up")

    def __init__(self, parent: Audit | None, part: str):
        self.parent, self.part = parent, part
        if parent is None:
            self.size, self.hash, self.up = len(part), spell(0, part), ()
            return
        self.size, self.hash = parent.size + len(part), spell(parent.hash, part)
        up, k = [parent], 0                     # ancestors 1, 2, 4, ... back
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)

    def __str__(self) -> str:
        parts, node = [], self
        while node is not None:
            parts.append(node.part)
            node = node.parent
        return "".join(reversed(parts))

    def at(self, size: int) -> Audit:
        """The shortest of this and its ancestors of at least that size."""
        node = self
        for k in range(len(node.up) - 1, -1, -1):
            while k < len(node.up) and node.up[k].size >= size:
                node = node.up[k]
        return node

    def prefix(self, size: int) -> int:
        """Hash of the first characters."""
        node = self.at(size)
        if node.size == size:
            return node.hash
        before = node.parent
        return spell(before.hash if before else 0, node.part[:size - (before.size if before else 0)])

    def letter(self, i: int) -> str:
        node = self.at(i + 1)
        return node.part[i - node.size + len(node.part)]


def spell(h: int, part: str) -> int:
    for c in part:
        h = (h * _BASE + ord(c)) % _PRIME
    return h


class Order:
    """Compares audits."""

    def __init__(self):
        self.same: set[tuple[int, int]] = set()
        self.kept: list[Audit] = []             # so that their ids stay theirs

    def first_difference(self, a: Audit, b: Audit, upto: int) -> int | None:
        """The first place before ``upto`` where they differ, compared from the
        back to a shared or known node."""
        found, at = None, upto
        x, y = a.at(upto), b.at(upto)
        while at and x is not y:
            begin = max(x.size - len(x.part), y.size - len(y.part))
            for i in range(at - 1, begin - 1, -1):
                if x.part[i - x.size + len(x.part)] != y.part[i - y.size + len(y.part)]:
                    found = i
            at = begin
            if x.size - len(x.part) == at and x.parent is not None:
                x = x.parent
            if y.size - len(y.part) == at and y.parent is not None:
                y = y.parent
            if x.size == y.size == at and (id(x), id(y)) in self.same:
                break
        return found

    def common(self, a: Audit, b: Audit) -> int:
        """Length of the longest common prefix."""
        low, high = 0, min(a.size, b.size)
        while low < high:
            mid = (low + high + 1) // 2
            x, y = a.at(mid), b.at(mid)
            if x is y or a.prefix(mid) == b.prefix(mid):
                low = mid
            else:
                high = mid - 1
        real = self.first_difference(a, b, low) if low else None
        if real is not None:                    # two prefixes of one hash
            return real
        if low:
            x, y = a.at(low), b.at(low)
            if x.size == y.size == low and x is not y:
                self.same.add((id(x), id(y)))
                self.kept += (x, y)
        return low

    def less(self, a: Audit, b: Audit) -> bool:
        if a is b:
            return False
        if a.parent is b.parent and a.parent is not None and a.part[:1] != b.part[:1]:
            return a.part < b.part
        n = self.common(a, b)
        if n == a.size or n == b.size:
            return a.size < b.size
        return a.letter(n) < b.letter(n)


Best = dict[int, tuple[int, Audit]]


def better(best: Best, state: int, cost: int, parent: Audit, part: str, order: Order) -> None:
    held = best.get(state)
    if held is None or cost < held[0]:
        best[state] = cost, Audit(parent, part)
    elif cost == held[0]:
        new = Audit(parent, part)
        if order.less(new, held[1]):
            best[state] = cost, new


def with_inserts(best: Best, order: Order) -> Best:
    """Turns inserted here: at most a user and an assistant turn can pay."""
    for state in (EMPTY, SYSTEM, ASSISTANT):
        if state in best:
            better(best, USER, best[state][0] + INSERT, best[state][1], "I", order)
    if USER in best:
        better(best, ASSISTANT, best[USER][0] + INSERT, best[USER][1], "I", order)
    return best


def step(best: Best, fault: int, initial: str, order: Order) -> Best:
    """All edits of one turn, then those inserted behind it."""
    after: Best = {}
    for state, (cost, audit) in best.items():
        better(after, state, cost + DELETE, audit, "D", order)
        if fault in (BLANK, DUPLICATE):
            continue
        more = cost + TRUNCATED * (fault == CUT)
        kept = NEXT_KEEP.get((state, initial))
        if kept is not None:
            better(after, kept, more + KEEP, audit, "K", order)
        better(after, NEXT_TURN[state], more + REROLE, audit, "R", order)
    return with_inserts(after, order)


def run_segment(turns: list[tuple[int, str]], whole: bool) -> list[tuple[int, int, int, str]]:
    """(state before, state behind, cost, audit) over a run of (fault, initial);
    ``whole``: it is the first run, and nothing stands before it."""
    out = []
    for start in (EMPTY,) if whole else (EMPTY, SYSTEM, USER, ASSISTANT):
        order = Order()
        best = {start: (0, Audit(None, ""))}
        if whole:
            best = with_inserts(best, order)
        for fault, initial in turns:
            best = step(best, fault, initial, order)
        out += [(start, end, cost, str(audit)) for end, (cost, audit) in best.items()]
    return out


def join_segments(segments: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """(cost, audit) of a conversation from its runs in order."""
    order = Order()
    best = with_inserts({EMPTY: (0, Audit(None, ""))}, order)
    for segment in segments:
        after: Best = {}
        for start, end, cost, part in segment:
            if start in best:
                better(after, end, best[start][0] + cost, best[start][1], part, order)
        best = after
    ends = [best[s] for s in (EMPTY, ASSISTANT) if s in best]
    cost = min(c for c, _ in ends)
    ends = [a for c, a in ends if c == cost]
    least = ends[0]
    for a in ends[1:]:
        if order.less(a, least):
            least = a
    return cost, str(least)


def role_behind(state: int, edit: str, role: str) -> tuple[int, str | None]:
    """The state behind an edit, and the role of the turn that it leaves."""
    if edit == "D":
        return state, None
    if edit == "K":
        return NEXT_KEEP[state, role[:1]], role
    state = NEXT_TURN[state]
    return state, ROLE_OF[state]


# ------------------------------------------------------------------ the rows
def damage(turns: DataFrame) -> DataFrame:
    """By the CRC of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its
    text, 2 takes ``.!?`` from it, 3 repeats it, 4 sets its role to user."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
            .filter("kind <> 0"))
    return (rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                        text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))))
            .drop("col"))


ORDER = ["turn", "role", "start", "digest"]


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with what orders equal turns."""
    return rows.withColumns({"start": F.substring("text", 1, START), "digest": F.unhex(F.sha2("text", 256))})


def marked_turns(rows: DataFrame) -> DataFrame:
    """Turns without their texts: order, initial and first fault."""
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first()))
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    fault = (F.when(F.col("last") == "", BLANK).when(F.col("seen") > 1, DUPLICATE)
             .when(~F.col("last").isin(".", "!", "?"), CUT).otherwise(FINE))
    initial = F.when(F.col("role") == "", " ").otherwise(F.substring("role", 1, 1))
    return (ordered(rows).select("conv_id", *ORDER, last.alias("last")).withColumn("seen", seen)
            .select("conv_id", *ORDER, "seen", initial.alias("initial"), fault.cast("int").alias("fault")))


SEGMENTS = ("conv_id long, place long, first_turn long, last_turn long, low long, high long, turns long, blank long, "
            "duplicate long, truncated long, illegal long, first string, last string, before array<int>, "
            "behind array<int>, cost array<long>, audit array<string>")


def segment_table(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """One row for each run of a conversation's turns in a task of the range
    sort, in order by (conversation, place)."""
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), *ORDER[1:], "seen"]
    rows = turns.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = rows.select("conv_id", "turn", "initial", "fault", F.spark_partition_id().cast("long").alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key, place, opens = None, 0, False      # opens: the run is its conversation's first for certain
        out: list[dict] = []

        def close() -> None:
            nonlocal place
            if not held:
                return
            found = [h[1] for h in held if h[1] is not None]
            runs = run_segment([(h[3], h[2]) for h in held], opens)
            out.append({
                "conv_id": held[0][0], "place": place, "first_turn": found[0] if found else None,
                "last_turn": found[-1] if found else None, "low": found[0] if found else None,
                "high": found[-1] if found else None, "turns": len(set(found)),
                **{n: sum(h[3] == f for h in held) for n, f in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT))},
                "illegal": sum(a[2] + b[2] not in ("su", "ua", "au") for a, b in zip(held, held[1:])),
                "first": held[0][2], "last": held[-1][2], "before": [r[0] for r in runs], "behind": [r[1] for r in runs],
                "cost": [r[2] for r in runs], "audit": [r[3] for r in runs]})
            place += 1
            held.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "task")]
            for conv, turn, initial, fault, task in zip(*columns):
                if key is None or key[0] != conv:
                    close()
                    opens = key is not None     # what came before in this task is another conversation
                    if key is None:
                        place = task << 32
                    key = (conv,)
                elif len(held) >= size:
                    close()
                    opens = False
                held.append((conv, turn, initial, fault))
            if out:
                yield pa.Table.from_pylist(out, schema=_arrow(SEGMENTS)).combine_chunks().to_batches()[0]
                out.clear()
        close()
        if out:
            yield pa.Table.from_pylist(out, schema=_arrow(SEGMENTS)).combine_chunks().to_batches()[0]
        release_memory()

    return rows.mapInArrow(run, SEGMENTS)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()),
             "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in schema.split(", "))])


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def repaired_audits(segments: DataFrame) -> DataFrame:
    """One row for each conversation that has rows: its figures and audit."""
    def done(held: list[dict]) -> dict:
        cost, audit = join_segments([list(zip(s["before"], s["behind"], s["cost"], s["audit"])) for s in held])
        turns = distinct = 0
        low = high = last = None
        for s in held:
            if s["low"] is not None:
                distinct += s["turns"] - (last == s["first_turn"])
                low, high, last = s["low"] if low is None else low, s["high"], s["last_turn"]
        if low is not None:
            turns = high - low + 1 - distinct
        edges = sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        return {"conv_id": held[0]["conv_id"], "gaps": turns, "cost": cost, "audit": audit,
                "illegal": edges + sum(s["illegal"] for s in held),
                **{n: sum(s[n] for s in held) for n in ("blank", "duplicate", "truncated")}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    out.append(done(held))
                    held = []
                held.append(row)
            if out:
                yield from pa.Table.from_pylist(out, schema=_arrow(REPORT)).to_batches()
        if held:
            yield from pa.Table.from_pylist([done(held)], schema=_arrow(REPORT)).to_batches()
        release_memory()

    keys = [F.col("conv_id").asc_nulls_first(), F.col("place")]
    return segments.repartition("conv_id").sortWithinPartitions(*keys).mapInArrow(run, REPORT)


def repaired_texts(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): turns stream through in order behind their audit."""
    columns = ["conv_id", *ORDER, "text", "audit"]
    both = (audits.select("conv_id", *[F.lit(None).cast(k).alias(n) for n, k in
                                       (("turn", "long"), ("role", "string"), ("start", "string"), ("digest", "binary"),
                                        ("text", "string"))], "audit")
            .unionByName(ordered(rows).select(*columns[:-1], F.lit(None).cast("string").alias("audit"))))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("audit").isNull(), F.col("turn").asc_nulls_first(), *ORDER[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = audit = digest = None
        at, state, begun = 0, EMPTY, False

        def put(role: str, text: str) -> None:
            nonlocal begun
            digest.update((("\n" if begun else "") + role + ":" + text).encode())
            begun = True

        def inserted() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state, role = role_behind(state, "I", "")
                put(role, "")
                at += 1

        for batch in batches:
            out = []
            for row_conv, row_audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))):
                if row_audit is not None:
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    conv, audit, digest, at, state, begun = row_conv, row_audit, hashlib.sha256(), 0, EMPTY, False
                    inserted()
                    continue
                state, left = role_behind(state, audit[at], role)
                at += 1
                if left is not None:
                    put(left, text)
                inserted()
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array([o[0] for o in out], pa.int64()),
                                              "repaired_sha256": pa.array([o[1] for o in out], pa.string())})
            del batch
        if digest is not None:
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array([conv], pa.int64()),
                                              "repaired_sha256": pa.array([digest.hexdigest()], pa.string())})
        release_memory()

    sort = both.repartition("conv_id").sortWithinPartitions(*keys).select("conv_id", "audit", "role", "text")
    return sort.mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair(turns: DataFrame, rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """The report on ``rows`` (conv_id, turn, role, text), with a row for every
    conversation of ``turns``."""
    audits = materialize(repaired_audits(segment_table(marked_turns(rows), size)), "conversation_audits")
    texts = repaired_texts(rows, audits)
    every = turns.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    found = audits.join(texts, audits["conv_id"].eqNullSafe(texts["conv_id"])).select(audits["*"], "repaired_sha256")
    out = every.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def repair_conversations(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Damages the conversations, then reports their repair."""
    return repair(turns, damage(turns), size)
