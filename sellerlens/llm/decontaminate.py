"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items form one automaton; document words stream
through it and the longest matching length is tracked. A window is 13
consecutive item words (a shorter, non-empty item is one window of its own);
document words inside an occurrence of a window are hit.

Benchmarks are read in shards of at most ``shard_words`` item words (longer
items in pieces that overlap by a window less one word, so every window lies
in a piece). One shard is held by the driver at a time and travels with the
tasks, so what is broadcast has a fixed bound; larger benchmarks mean more
passes, whose spans are merged per text hash. One plan serves every size: the
first pass returns every row, later ones only texts with a match. (The longest
match is told within a piece: an item longer than a shard counts as its pieces.)

Before streaming, NumPy keeps only stretches in which every adjacent word
pair also occurs in an item: a necessary condition for any window, so
nothing is lost and almost no word of a clean text reaches the automaton.

Cases: null or wordless documents have 0 words, no hits and are not
contaminated; null or wordless items give no window; items with equal texts
each count; a null item_id hits words but is not listed; every row, with a
null or repeated doc_id too, has its own result for any number of shards; empty
tables give empty results; columns besides (doc_id, text) are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerlens.llm.common import ALNUM_TABLE, alnum_words, apart, keep_if_listed, map_arrow, materialise, unpacked

WINDOW = 13
SHARD_WORDS = 500_000
DROP_COVERAGE = 0.5

FOUND = "n_words long, longest long, spans array<struct<s:int,e:int>>, items array<string>"
ROWS = f"row struct<doc_id:long,k:binary>, {FOUND}"
HITS = f"k binary, {FOUND}"
_FOUND = ("n_words", "longest", "spans", "items")
_WORD = re.compile(rb"[^ ]+")


class SuffixAutomaton:
    """Generalised suffix automaton over word ids, with the windows that end in each state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        coded = []
        for item, words in items:
            if words:
                codes = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
                coded.append((item, codes))
                state = 0
                for c in codes:
                    state = self._extend(state, c)
        self.least = min([window, *(len(c) for _, c in coded)])
        self.full: dict[int, set] = {}
        self.short: dict[int, tuple[int, set]] = {}
        for item, codes in coded:
            if len(codes) >= window:
                for _, state, length in self.stream(codes):
                    if length >= window:
                        self.full.setdefault(self._shrink(state, window), set()).add(item)
            else:
                *_, (_, state, _) = self.stream(codes)
                state = self._shrink(state, len(codes))
                self.short.setdefault(state, (len(codes), set()))[1].add(item)
        # nearest state up the suffix links (itself included) where a short item ends
        self.above: list[int] = [-1] * len(self.len)
        for s in sorted(range(len(self.len)), key=self.len.__getitem__):
            self.above[s] = s if s in self.short else self.above[self.link[s]] if s else -1
        size = len(self.vocab) + 1
        pairs = {a * size + b for _, c in coded for a, b in zip(c, c[1:])}
        self.size, self.pairs = size, np.array(sorted(pairs), dtype=np.int64)

    def _new(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, parent: int, child: int, c: int) -> int:
        """The state of the longest string of ``parent`` followed by c, cut out of ``child`` if needed."""
        if self.len[child] == self.len[parent] + 1:
            return child
        clone = self._new(self.len[parent] + 1, self.link[child], dict(self.next[child]))
        self.link[child] = clone
        while parent != -1 and self.next[parent].get(c) == child:
            self.next[parent][c] = clone
            parent = self.link[parent]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, self.next[last][c], c)
        new = self._new(self.len[last] + 1, 0, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p != -1:
            self.link[new] = self._split(p, self.next[p][c], c)
        return new

    def _shrink(self, state: int, length: int) -> int:
        """The state of the suffix of this length."""
        while self.len[self.link[state]] >= length:
            state = self.link[state]
        return state

    def stream(self, codes) -> Iterator[tuple[int, int, int]]:
        """(position, state, longest matching length that ends there)."""
        state = length = 0
        for i, c in enumerate(codes):
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.len[state]
            if c in self.next[state]:
                state = self.next[state][c]
                length += 1
            yield i, state, length

    def stretches(self, words: list[bytes]) -> list[tuple[int, np.ndarray]]:
        get = self.vocab.get
        ids = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))
        if self.least == 1:
            good = ids > 0
        else:
            pair = ids[:-1] * self.size + ids[1:]
            at = np.searchsorted(self.pairs, pair)
            at[at == len(self.pairs)] = 0
            good = (self.pairs[at] == pair) & (ids[:-1] > 0) & (ids[1:] > 0) if len(self.pairs) else np.zeros(len(pair), bool)
        if not good.any():
            return []
        edge = np.flatnonzero(np.diff(np.concatenate(([0], good.view(np.int8), [0]))))
        extra = 0 if self.least == 1 else 1
        return [(a, ids[a:b + extra]) for a, b in zip(edge[::2], edge[1::2]) if b - a + extra >= self.least]

    def scan(self, words: list[bytes]) -> tuple[int, list[tuple[int, int]], set]:
        """(longest match seen in candidate stretches, merged hit spans, items)."""
        longest, spans, items = 0, [], set()
        if len(words) < self.least or not self.vocab:
            return longest, spans, items
        for start, codes in self.stretches(words):
            for i, state, length in self.stream(codes.tolist()):
                longest = max(longest, length)
                reach = 0
                if length >= self.window:
                    reach = self.window
                    items |= self.full[self._shrink(state, self.window)]
                s = self.above[state]
                while s > 0:
                    size, found = self.short[s]
                    if size <= length:
                        reach = max(reach, size)
                        items |= found
                    s = self.above[self.link[s]]
                if reach:
                    a, b = int(start) + i + 1 - reach, int(start) + i + 1
                    while spans and spans[-1][1] >= a:
                        a = min(a, spans.pop()[0])
                    spans.append((a, b))
        return longest, spans, items


def contaminated(n_hit, n_words):
    return (n_hit > 0) & (20 * n_hit >= n_words)


_built: dict[int, SuffixAutomaton] = {}


def _automaton(key: int, items: list, window: int) -> SuffixAutomaton:
    """One automaton at a time in a worker."""
    if key not in _built:
        _built.clear()
        _built[key] = SuffixAutomaton([(i, alnum_words(t)) for i, t in items], window)
    return _built[key]


def _pieces(piece_words: int, window: int):
    """(item, words of a piece joined by blanks, their number)."""
    step = max(1, piece_words - window + 1)

    def run(batches):
        for b in batches:
            out = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                words = alnum_words(text or b"")
                for s in range(0, max(1, len(words) - window + 1), step):
                    part = words[s:s + step + window - 1]
                    out.append((item, b" ".join(part), len(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 3, (pa.string(), pa.binary(), pa.int64()))],
                                             names=["item", "words", "n"])

    return run


def shards(benchmark: DataFrame, shard_words: int, window: int = WINDOW) -> Iterator[list[tuple[str | None, bytes]]]:
    """Normalised items, one bounded shard at a time; one empty shard if there is no word."""
    rows = map_arrow(benchmark.select(F.col("item_id").cast("string").alias("item"), "text"),
                     _pieces(max(window, shard_words), window), "item string, words binary, n long").where("n > 0")
    shard, size = [], 0
    for r in materialise(rows).toLocalIterator():
        if shard and size + r.n > shard_words:
            yield shard
            shard, size = [], 0
        shard.append((r.item, bytes(r.words)))
        size += r.n
    yield shard


def merged(spans) -> list[tuple[int, int]]:
    """Spans in order, touching ones as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def _scanner(items: list, window: int, every_row: bool) -> Callable:
    """First column, then FOUND; without ``every_row`` only of texts with a match, be it too short to hit."""
    key = hash((window, tuple(items)))

    def run(batches):
        automaton = _automaton(key, items, window)
        for b in batches:
            out, rows = [], []
            for i, text in enumerate(b.column(1).cast(pa.binary())):
                words = alnum_words(text.as_py() or b"")
                longest, spans, found = automaton.scan(words)
                if every_row or longest:
                    rows.append(i)
                    out.append((len(words), longest, [{"s": a, "e": e} for a, e in spans], sorted(x for x in found if x is not None)))
            cols = list(zip(*out)) or [[]] * 4
            types = [pa.int64(), pa.int64(), _SPANS, pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, types))],
                                             names=[b.schema.names[0], "n_words", "longest", "spans", "items"])
        _built.clear()

    return run


def _merger(batches):
    for b in batches:
        k = b.schema.get_field_index("spans")
        spans = [[{"s": a, "e": e} for a, e in merged((x["s"], x["e"]) for x in row)] for row in b.column(k).to_pylist()]
        yield b.set_column(k, "spans", pa.array(spans, _SPANS))


def _key(text: Column) -> Column:
    """Equal texts have equal results, so shards are merged per text hash: no id is needed, rows stay rows."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _shard_hits(docs: DataFrame, items: list, window: int) -> DataFrame:
    """HITS of the texts with a match in one shard, once per text, written to the shared folder."""
    d = docs.where("text IS NOT NULL").select(_key(F.col("text")).alias("k"), "text")
    found = map_arrow(d, _scanner(items, window, every_row=False), HITS)
    return materialise(found.groupBy("k").agg(*[F.max(c).alias(c) for c in ("n_words", "longest", "spans", "items")]))


def _merged_hits(parts: list[DataFrame]) -> DataFrame:
    """HITS per text over all shards: at most one row per shard and text is collected."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    every = every.groupBy("k").agg(
        F.max("n_words").alias("n_words"), F.max("longest").alias("longest"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return map_arrow(every, _merger, HITS)


def _n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per document: n_words, longest match, hit word spans [s, e) and the items whose windows occur."""
    d = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), _key(F.col("text")).alias("k")).alias("row"), "text")
    rows, more = None, []
    for items in shards(benchmark, shard_words, window):
        if rows is None:
            rows = map_arrow(d, _scanner(items, window, every_row=True), ROWS).select("row.*", *_FOUND)
        else:
            more.append(_shard_hits(docs, items, window))
    if not more:
        return rows.drop("k")
    first = [F.col(c).alias(f"_{c}") for c in _FOUND]
    out = rows.select("doc_id", "k", *first).join(apart(_merged_hits(more)), "k", "left")
    none = {"spans": "CAST(array() AS array<struct<s:int,e:int>>)", "items": "CAST(array() AS array<string>)"}
    both = [F.concat(f"_{c}", F.coalesce(c, F.expr(v))).alias(c) for c, v in none.items()]
    out = out.select("doc_id", F.col("_n_words").alias("n_words"), F.greatest("_longest", F.coalesce("longest", F.lit(0).cast("long"))).alias("longest"), *both)
    out = out.withColumn("items", F.array_sort(F.array_distinct("items")))
    return map_arrow(out, _merger, f"doc_id long, {FOUND}")


def measure(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``scan`` with n_hit and the contamination verdict."""
    out = scan(docs, benchmark, window, shard_words).withColumn("n_hit", _n_hit())
    return out.withColumn("contaminated", contaminated(F.col("n_hit"), F.col("n_words")))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at = [m.span() for m in _WORD.finditer(text.translate(ALNUM_TABLE))]
    cut = 0
    kept = []
    for s, e in spans:
        kept.append(text[cut:at[s][0]])
        cut = at[e - 1][1]
    return b"".join([*kept, text[cut:]])


def _cutter(batches):
    for b in batches:
        text, spans = (b.column(b.schema.get_field_index(c)) for c in ("text", "spans"))
        new = [cut_spans(t, [(x["s"], x["e"]) for x in s]) for t, s in zip(text.cast(pa.binary()).to_pylist(), spans.to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [b.column(b.schema.get_field_index("row")), pa.array(new, pa.binary()).cast(pa.string())], names=["row", "text"])


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
                 drop_coverage: float = DROP_COVERAGE) -> DataFrame:
    """``docs`` with the hit spans cut out of contaminated texts.

    A text whose hits cover more than ``drop_coverage`` of its words goes
    altogether; texts that are not contaminated stay byte for byte. All
    columns are kept, ``n_chars`` (if there) follows a changed text. Both
    verdicts count the hits of all shards together.

    Each round scans (hash, text) only; then rows of contaminated texts are cut
    or dropped and all others pass by. Texts that were cut go into the next
    round, as a cut may join words into a new window. Every round takes words
    away, so it ends.
    """
    columns, todo, done = docs.columns, docs, None
    while True:
        hits = _merged_hits([_shard_hits(todo, items, window) for items in shards(benchmark, shard_words, window)])
        bad = materialise(hits.withColumn("n_hit", _n_hit()).where(contaminated(F.col("n_hit"), F.col("n_words"))))
        if bad.isEmpty():
            return todo if done is None else done.unionByName(todo)
        rows = todo.select(_key(todo["text"]).alias("k"), F.struct(*[todo[c] for c in columns]).alias("row"))
        maybe = keep_if_listed(rows, "k", bad.select("k"))
        clean = keep_if_listed(rows, "k", bad.select("k"), listed=False).unionByName(maybe.join(apart(bad), "k", "left_anti"))
        clean = unpacked(clean, columns)
        done = clean if done is None else done.unionByName(clean)
        dirty = bad.where(F.col("n_hit") <= drop_coverage * F.col("n_words")).select("k", "spans")
        dirty = maybe.join(apart(dirty), "k").select("row", F.col("row.text").alias("text"), "spans")
        changed = {"text": F.col("text")}
        if "n_chars" in columns:
            changed["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cut = map_arrow(dirty, _cutter, dirty.select("row", "text").schema)
        todo = materialise(unpacked(cut, columns, **changed))
