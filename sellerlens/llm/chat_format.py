"""Chat formatting with incremental black-box rendering.

A template is any function from turns to one string. The operator renders
successive turn prefixes and compares consecutive outputs: where an output
begins with the one before, the rest is the new turn's span; where it does
not, the template rewrites history and the conversation is flagged, as spans
found in prefixes would not hold in the whole. Inside a span the text is
located by rendering the same prefix with two probe texts of the text's own
length: between their first and last difference the text stands, and what
follows there must follow the real text too. A template that shortens texts,
or whose surroundings depend on what a text says, cannot be located like
this; it is flagged as well.

The own template marks each turn by control strings and escapes these inside
roles and texts with backslashes, reversibly. ``parse`` reads the turns back
from the output alone.

Conversations stream: rows are dealt by conversation and sorted, and one
conversation at a time is held. By default every prefix is rendered and
compared, whatever the length, so rewriting at any prefix is seen; time is
quadratic in a conversation's characters, as a black box allows no less. With
``every=k`` a caller who knows that his template does not rewrite has only
every k-th prefix (and the last) rendered: k turns' pieces are then located
one by one behind that prefix.

Cases: null role or text is empty; null conv_id is one conversation; rows tie
by (turn, role, text), null turn first; repeated rows are turns of their own;
an empty table gives an empty result; columns besides (conv_id, turn, role,
text) are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from sellerlens.llm.common import map_arrow

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# The control strings of the own template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<|text|>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(\\)?", re.DOTALL)
_TURN = re.compile(r"<s>(?P<role>.*?)<\|text\|>(?:\[INST\](?P<inst>.*?)\[/INST\]|(?P<plain>.*?))</s>", re.DOTALL)

FORMATTED = "conv_id long, formatted string, rewrites boolean, spans array<struct<turn:int,s:int,e:int,loss:boolean>>"


def escape(text: str) -> str:
    """Backslashes doubled, control strings broken by one after their first character."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] or "", text)


def inst_template(turns: list[Turn]) -> str:
    """``<s>role<|text|>text</s>`` per turn; user texts stand in [INST] .. [/INST]."""
    out = []
    for role, text in turns:
        t = escape(text)
        out.append(f"<s>{escape(role)}<|text|>{f'[INST]{t}[/INST]' if role == 'user' else t}</s>")
    return "".join(out)


def parse(formatted: str) -> list[Turn]:
    """The turns of ``inst_template``'s output."""
    return [(unescape(m["role"]), unescape(m["inst"] if m["inst"] is not None else m["plain"])) for m in _TURN.finditer(formatted)]


def first_difference(a: str, b: str) -> int | None:
    """Where two strings first differ, by halving; None if one begins with the other."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return None
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def place(head: list[Turn], turn: Turn, now: str, template: Template) -> tuple[int, int] | None:
    """[s, e) of the last turn's text in the output ``now`` of ``[*head, turn]``; None if it cannot be told."""
    role, text = turn
    size = max(1, len(text))
    a, b = (template([*head, (role, c * size)]) for c in "AB")
    start = first_difference(a, b)
    # the probes must differ in their whole length and nowhere else
    if start is None or len(a) != len(b) or a[start:start + size] != "A" * size or b[start:start + size] != "B" * size:
        return None
    tail = a[start + size:]
    end = len(now) - len(tail)
    if b[start + size:] != tail or end < start or now[:start] != a[:start] or now[end:] != tail:
        return None
    return start, end


def locate(turns: list[Turn], template: Template, every: int = 1) -> tuple[str, bool, list[tuple[int, int]]]:
    """(output, rewrites history or hides its texts, text span [s, e) of each turn; empty list if so)."""
    spans, before = [], ""
    for i, turn in enumerate(turns):
        if every > 1 and i % every and i < len(turns) - 1:
            continue
        now = template(turns[:i + 1])
        if not now.startswith(before):
            return template(turns), True, []
        for j in range(len(spans), i + 1):
            upto = now if j == i else template(turns[:j + 1])
            found = place(turns[:j], turns[j], upto, template)
            if found is None or found[0] < (spans[-1][1] if spans else 0) or (j == i and found[0] < len(before)):
                return template(turns), True, []
            spans.append(found)
        before = now
    return before, False, spans


def _formatter(template: Template, loss_role: str, every: int):
    schema = pa.schema([
        ("conv_id", pa.int64()), ("formatted", pa.string()), ("rewrites", pa.bool_()),
        ("spans", pa.list_(pa.struct([("turn", pa.int32()), ("s", pa.int32()), ("e", pa.int32()), ("loss", pa.bool_())]))),
    ])

    def one(conv, turns):
        out, rewrites, spans = locate(turns, template, every)
        return conv, out, rewrites, [{"turn": i, "s": s, "e": e, "loss": turns[i][0] == loss_role} for i, (s, e) in enumerate(spans)]

    def run(batches):
        conv, turns, done = None, [], []
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        for b in batches:
            for c, role, text in zip(*(b.column(b.schema.get_field_index(n)).to_pylist() for n in ("conv_id", "role", "text"))):
                if turns and c != conv:
                    done.append(one(conv, turns))
                    turns = []
                conv = c
                turns.append((role or "", text or ""))
            if len(done) >= 1000:
                yield flush()
                done.clear()
        if turns:
            done.append(one(conv, turns))
        if done:
            yield flush()

    return run


def format_chats(conversations: DataFrame, template: Template = inst_template, loss_role: str = "assistant", every: int = 1) -> DataFrame:
    """Per conversation: formatted text, whether the template rewrites history (or its texts cannot be
    located), and each turn's text span (code points, end exclusive) with its loss flag."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_arrow(rows, _formatter(template, loss_role, every), FORMATTED)
