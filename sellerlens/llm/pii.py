"""Personal data: base patterns and bootstrapped contextual extraction.

Base spans (email, ip, card, phone) are the seed entities. Their neighbours
become lexical patterns: the word to the left or to the right of a slot, past
quotes, assignment signs and other marks. Other identifier-like tokens (long,
with several digits, not yet judged by a base pattern) are candidates, and
stand with their shape: runs of letters and digits reduced to classes, so that
unseen identifiers of one make support each other. Spark scores the graph of
patterns and shapes in turns: a pattern by the share of known occurrences in
its slot and by their number, a shape by the share of its occurrences in slots
that are good without it and by the number of different patterns. Accepted shapes count as known
in the next turn. In the end candidates of accepted shapes in accepted slots
join the base spans as kind ``id``.

One pass over the texts leaves base spans and candidates; all further work is
on these. Pattern and shape counts are pre-aggregated before each shuffle and
meet by equi-joins.

Cases: null text is empty; the base rules are linear in a text's length;
matches that fail their check are dropped without retries; rows equal in
doc_id and text share their result; an empty table, or one without seeds,
gives base results alone; columns besides (doc_id, text) are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerlens.llm.common import map_arrow, materialise

KINDS = ["email", "ip", "card", "phone"]
FOUND = "id"
TURNS = 3
MIN_SHARE = 0.6
MIN_SEEN = 3
MIN_PATTERNS = 3
MIN_CHARS, MIN_DIGITS = 8, 4

# The base patterns (the email's local part is walked backwards from each @).
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGIT_OR_AT = re.compile(r"[0-9@]")
FROM_DIGIT = re.compile(r"[0-9]\S*")
WORD_LEFT = re.compile(r"(\S{1,40})\Z")
WORD_RIGHT = re.compile(r"\S{1,40}")
EDGE = "\"'`()[]{}<>.,;:!?*|=#$%&~^"
# Marks between a word and its slot (quotes, assignment, table bars) are no words of their own.
MARKS = EDGE + "\\/-_ \t\r\n\v\f"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; leftmost and non-overlapping per kind."""
    out = []
    low, at = 0, text.find("@")
    while at >= 0:
        i = at
        while i > low and text[i - 1] in LOCAL:
            i -= 1
        m = DOMAIN.match(text, at + 1) if i < at else None
        if m:
            out.append(("email", i, m.end()))
            low = m.end()
        at = text.find("@", max(at + 1, low))
    for run in DOTTED.finditer(text):
        parts, start = run[0].split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                out.append(("ip", start, end))
            start = end + 1
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _only_digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= len(_only_digits(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def shape(token: str) -> str:
    """Letters up to a separator kept as they are before '=' or ':', else classes, whatever their case; mixed runs become one class with their length."""
    head, sep, tail = "", "", token
    m = re.match(r"([A-Za-z_]{2,30})([=:])(.+)", token, re.DOTALL)
    if m:
        head, sep, tail = m[1].lower(), m[2], m[3]

    def run(m: re.Match) -> str:
        s = m[0]
        kinds = ("a" if re.search("[A-Za-z]", s) else "") + ("0" if re.search("[0-9]", s) else "")
        return f"{kinds}{len(s)}" if len(s) < 64 else f"{kinds}64+"

    return f"{head}{sep}" + re.sub(r"[A-Za-z0-9]+", run, tail)[:60]


def _neighbours(text: str, start: int, end: int) -> tuple[str, str]:
    """The nearest words on both sides, marks skipped and cut off; digits are folded."""
    left = WORD_LEFT.search(text[max(0, start - 60):start].rstrip(MARKS))
    right = WORD_RIGHT.match(text[end:end + 60].lstrip(MARKS))
    fold = lambda m, mark: mark + (re.sub("[0-9]", "0", m[0].strip(MARKS).lower()) if m else "^")
    return fold(left, "L:"), fold(right, "R:")


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, shape) of identifier-like tokens that touch no base span."""
    out = []
    spans = sorted((s, e) for _, s, e in taken)
    k = last = 0
    for m in FROM_DIGIT.finditer(text):
        s, e = m.span()
        while s > last and not text[s - 1].isspace():
            s -= 1
        last = e
        while s < e and text[s] in EDGE:
            s += 1
        while s < e and text[e - 1] in EDGE:
            e -= 1
        if e - s < MIN_CHARS or sum("0" <= c <= "9" for c in text[s:e]) < MIN_DIGITS:
            continue
        while k < len(spans) and spans[k][1] <= s:
            k += 1
        if any(a < e and s < b for a, b in spans[k:k + 8]):
            continue
        if DOTTED.fullmatch(text, s, e) or PHONE.fullmatch(text, s, e) or (CARD.fullmatch(text, s, e) and 16 <= len(_only_digits(text[s:e])) <= 19):
            continue  # a base pattern has judged it already
        out.append((s, e, shape(text[s:e])))
    return out


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32())]))
_SLOT = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("shape", pa.string()), ("seed", pa.bool_()),
                            ("left", pa.string()), ("right", pa.string())]))
EXTRACT = ("doc_id long, h long, base array<struct<kind:string,s:int,e:int>>, "
           "slots array<struct<s:int,e:int,shape:string,seed:boolean,left:string,right:string>>")


def _extract(batches):
    for b in batches:
        docs, hashes, base, slots = b.column(0).to_pylist(), [], [], []
        for text in b.column(1).to_pylist():
            text = text or ""
            hashes.append(xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63))
            if not DIGIT_OR_AT.search(text):
                base.append([])
                slots.append([])
                continue
            spans = base_spans(text)
            base.append([{"kind": k, "s": s, "e": e} for k, s, e in spans])
            found = [(s, e, k, True) for k, s, e in spans] + [(s, e, x, False) for s, e, x in candidates(text, spans)]
            slots.append([dict(zip(("s", "e", "shape", "seed", "left", "right"), (*x, *_neighbours(text, x[0], x[1])))) for x in found])
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(hashes, pa.int64()), pa.array(base, _SPAN), pa.array(slots, _SLOT)],
            names=["doc_id", "h", "base", "slots"])


def bootstrap(slots: DataFrame, turns: int = TURNS, min_share: float = MIN_SHARE, min_seen: int = MIN_SEEN,
              min_patterns: int = MIN_PATTERNS) -> tuple[DataFrame, DataFrame]:
    """(patterns with scores, accepted shapes) from occurrences (pattern, shape, seed)."""
    graph = materialise(slots.groupBy("pattern", "shape", "seed").agg(F.count(F.lit(1)).alias("n")))
    shapes = graph.where("seed").select("shape", "seed").distinct()
    patterns = None
    for _ in range(turns):
        known = graph.join(shapes.withColumn("_in", F.lit(True)), ["shape", "seed"], "left")
        rated = materialise(
            known.groupBy("pattern").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("_in"), F.col("n")).otherwise(0)).alias("good"))
            .where(F.col("n") >= min_seen)
            .withColumn("score", F.col("good") / F.col("n") * F.log2(F.col("good") + 1))
            .withColumn("ok", (F.col("good") >= min_seen) & (F.col("good") >= min_share * F.col("n")))
        )
        patterns = rated.where("ok").select("pattern", "score")
        # a shape is judged by slots that are seen often enough without it: its own occurrences say nothing
        # about a slot, so a keyword that always goes with one shape is no evidence for or against it
        others, good = F.col("_n") - F.col("n"), F.col("_good") - F.when(F.col("_in"), F.col("n")).otherwise(0)
        found = (
            known.where("NOT seed").join(rated.select("pattern", F.col("n").alias("_n"), F.col("good").alias("_good")), "pattern")
            .withColumns({"_seen": others >= min_seen, "_ok": (good >= min_seen) & (good >= min_share * others)}).where("_seen").groupBy("shape")
            .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("_ok"), F.col("n")).otherwise(0)).alias("good"),
                 F.sum(F.col("_ok").cast("int")).alias("patterns"))
            .where((F.col("good") >= min_share * F.col("n")) & (F.col("patterns") >= min_patterns))
        )
        shapes = materialise(graph.where("seed").select("shape", "seed").distinct().unionByName(
            found.select("shape", F.lit(False).alias("seed"))))
    return patterns, shapes.where("NOT seed").select("shape")


def find_pii(docs: DataFrame, turns: int = TURNS) -> DataFrame:
    """Per document: doc_id, base spans, and all spans with those discovered (kind ``id``)."""
    rows = materialise(map_arrow(docs.select("doc_id", "text"), _extract, EXTRACT))
    slot = rows.where("size(slots) > 0").select("doc_id", "h", F.explode("slots").alias("x")).select("doc_id", "h", "x.*")
    sides = F.explode(F.array("left", "right")).alias("pattern")
    patterns, shapes = bootstrap(slot.select(sides, "shape", "seed"), turns)
    found = (
        slot.where("NOT seed").join(shapes, "shape").select("doc_id", "h", "s", "e", sides)
        .join(patterns.select("pattern"), "pattern", "left_semi")
        .select("doc_id", "h", F.struct(F.lit(FOUND).alias("kind"), "s", "e").alias("x")).distinct()
        .groupBy("doc_id", "h").agg(F.sort_array(F.collect_list("x")).alias("found"))
        .withColumnsRenamed({"doc_id": "_d", "h": "_h"})
    )
    out = rows.join(found, rows["doc_id"].eqNullSafe(found["_d"]) & (rows["h"] == found["_h"]), "left")
    none = F.array().cast("array<struct<kind:string,s:int,e:int>>")
    return out.select("doc_id", "base", F.concat("base", F.coalesce("found", none)).alias("spans"))
