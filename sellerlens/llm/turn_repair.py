"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A lattice node is (rows consumed, state of the role grammar). Edits are its
edges: Delete and, for a row that is neither blank nor a duplicate, Keep
(where the grammar takes the row's role initial) or Rerole (to the one role
that the grammar takes next, user or assistant) consume a row; Insert adds an
empty turn of the role that comes next. A truncated row that stays costs more.

Two heaps, from the start and from the accepting ends, settle nodes by cost.
They stop once the sum of their least keys exceeds the best meeting cost, so
all crossings of that cost are finished: every node of every cheapest path is
then settled from one side at least. Of these paths the one with the least
audit is read off letter by letter, as each letter leads to one node only.

Grammar of role initials: (s?(ua)+)?  Row faults, the first that holds: blank
(no word character), duplicate (role and text were seen before), truncated
(the last character that is not white space is none of . ! ?).

Cases: rows are taken by turn, null turns first, ties by role and text; null
roles and texts are one space, so such rows are blank; a role whose first
character is none of s, u, a (an empty one too) cannot be kept; null conv_id
is one conversation; a row whose ``present`` (if there) is false only names
its conversation, which without other rows gives zeros and no turns; an empty
table gives an empty result; other columns are ignored. A conversation is
held by one task: its rows, and about 60 bytes a row for the lattice.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerlens.llm.common import map_arrow

# Edit costs.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5

# States of the grammar: 0 nothing yet, 1 after s, 2 after u, 3 after a; 0 and 3 accept.
STATES, ACCEPTING = 4, (0, 3)
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # state after a kept row
NEXT = (2, 2, 3, 2)  # state after a user or assistant turn, whichever the grammar takes
ROLE = {2: "user", 3: "assistant"}
BEFORE = ((), (), (0, 1, 3), (2,))  # states whose NEXT this is

_WORD = re.compile(r"[^\x20\x09-\x0D]")
_FAR = 1 << 30
LEGAL = {"su", "ua", "au"}

REPAIRED = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
            "turns array<struct<role:string,text:string>>")


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """'blank', 'duplicate', 'truncated' or '' for each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        end = text.rstrip(" \t\n\v\f\r")
        if not end:
            out.append("blank")
        elif key in seen:
            out.append("duplicate")
        else:
            out.append("" if end[-1] in ".!?" else "truncated")
        seen.add(key)
    return out


class Lattice:
    """Edit lattice of one conversation; node = 4 * rows consumed + state."""

    def __init__(self, initials: list[str], fault: list[str]):
        self.n = len(initials)
        # what staying costs a row besides its edit; -1: it has to go
        self.stay = [-1 if f in ("blank", "duplicate") else TRUNCATED if f == "truncated" else 0 for f in fault]
        self.initials = initials

    def edges(self, node: int):
        """(letter, next node, cost), letters ascending."""
        i, state = divmod(node, STATES)
        if i < self.n:
            yield "D", node + STATES, DELETE
        yield "I", STATES * i + NEXT[state], INSERT
        if i < self.n and self.stay[i] >= 0:
            kept = KEPT[state].get(self.initials[i])
            if kept is not None:
                yield "K", STATES * (i + 1) + kept, self.stay[i]
            yield "R", STATES * (i + 1) + NEXT[state], REROLE + self.stay[i]

    def edges_back(self, node: int):
        """(previous node, cost)."""
        i, state = divmod(node, STATES)
        for p in BEFORE[state]:
            yield STATES * i + p, INSERT
        if i:
            yield node - STATES, DELETE
            if self.stay[i - 1] >= 0:
                for p in BEFORE[state]:
                    yield STATES * (i - 1) + p, REROLE + self.stay[i - 1]
                for p in range(STATES):
                    if KEPT[p].get(self.initials[i - 1]) == state:
                        yield STATES * (i - 1) + p, self.stay[i - 1]

    def cheapest(self) -> tuple[int, str]:
        """(cost, least audit of that cost)."""
        size = STATES * (self.n + 1)
        ahead, back = array("i", [_FAR]) * size, array("i", [_FAR]) * size
        done_ahead, done_back = bytearray(size), bytearray(size)
        # keys hold cost and node; at equal cost the search goes on in its own direction
        heap, heap_back = [0], []
        ahead[0] = 0
        for a in ACCEPTING:
            node = STATES * self.n + a
            back[node] = 0
            heappush(heap_back, size - 1 - node)
        best, order = _FAR, array("q")
        if back[0] == 0:
            best = 0
        while heap and heap_back and heap[0] // size + heap_back[0] // size <= best:
            if heap[0] // size <= heap_back[0] // size:
                node = heappop(heap) % size
                if done_ahead[node]:
                    continue
                done_ahead[node] = 1
                order.append(node)
                for _, to, cost in self.edges(node):
                    far = ahead[node] + cost
                    if far < ahead[to]:
                        ahead[to] = far
                        heappush(heap, far * size + to)
                        best = min(best, far + back[to])
            else:
                node = size - 1 - heappop(heap_back) % size
                if done_back[node]:
                    continue
                done_back[node] = 1
                for to, cost in self.edges_back(node):
                    far = back[node] + cost
                    if far < back[to]:
                        back[to] = far
                        heappush(heap_back, far * size + size - 1 - to)
                        best = min(best, far + ahead[to])
        # forward side: nodes from which a finished crossing is reached at the best cost
        leads = bytearray(size)

        def cheap(to: int, spent: int) -> bool:
            # a distance still open that meets the best cost is exact: nothing is cheaper
            return spent + back[to] == best or (bool(leads[to]) and spent == ahead[to])

        for node in reversed(order):
            leads[node] = ahead[node] + back[node] == best or any(
                cheap(to, ahead[node] + cost) for _, to, cost in self.edges(node))
        node, spent, audit = 0, 0, []
        while not (node // STATES == self.n and node % STATES in ACCEPTING and spent == best):
            letter, node, cost = next(e for e in self.edges(node) if cheap(e[1], spent + e[2]))
            spent += cost
            audit.append(letter)
        return best, "".join(audit)


def apply_audit(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired (role, text) rows."""
    out, i, state = [], 0, 0
    for letter in audit:
        if letter == "D":
            i += 1
        elif letter == "I":
            state = NEXT[state]
            out.append((ROLE[state], ""))
        else:
            role, text = rows[i]
            state = KEPT[state][role[:1]] if letter == "K" else NEXT[state]
            out.append((role if letter == "K" else ROLE[state], text))
            i += 1
    return out


def repair_rows(turns: list[int | None], rows: list[tuple[str, str]]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired rows) of one conversation."""
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[:1] for r, _ in rows]
    fault = faults(rows)
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    cost, audit = Lattice(initials, fault).cheapest()
    return gaps, *(fault.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, apply_audit(rows, audit)


_SCHEMA = pa.schema([(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
    ("audit", pa.string()), ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])


def _repairer(batches):
    conv, turns, rows, done, started, held = None, [], [], [], False, 0

    def close():
        *numbers, repaired = repair_rows(turns, rows)
        done.append((conv, *numbers, [{"role": r, "text": t} for r, t in repaired]))

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _SCHEMA)], schema=_SCHEMA)
        done.clear()
        return out

    for b in batches:
        for c, turn, role, text, present in zip(*(b.column(i).to_pylist() for i in range(5))):
            if started and c != conv:
                close()
                turns, rows = [], []
                if len(done) >= 1000 or held > 1 << 24:
                    yield flush()
                    held = 0
            conv, started = c, True
            if present:
                turns.append(turn)
                rows.append((role, text))
                held += len(text)
    if started:
        close()
    if done:
        yield flush()


def repair(conversations: DataFrame) -> DataFrame:
    """Per conversation its faults, the cost and audit of its cheapest repair, and the repaired turns."""
    present = F.coalesce("present", F.lit(True)) if "present" in conversations.columns else F.lit(True)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), present.alias("present"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_arrow(rows, _repairer, REPAIRED)
