"""Ranked lexical search: Block-Max MaxScore over sharded, block-compressed postings.

* **Index.** Every partition of the documents is cut into shards of bounded
  text size. A shard keeps one row per term: postings (local document number,
  tf) in blocks of 128, stored as byte-wide gaps, and per block a head with
  the last document and what bounds its impact whatever the corpus: the
  largest tf with the shortest text of those with tf > 1, and the shortest
  text with tf = 1. One more row holds the shard's doc_ids and lengths. Index
  rows know nothing of corpus totals, so shards can be added later; the
  totals N, L and df are sums over index rows.
* **Search.** Queries come in blocks of bounded size; their terms' rows go to
  their shard. There lists are ordered by their *global* bound (their largest
  block bound times the query's weight). Lists whose bounds together cannot
  reach the k-th best score so far are non-essential: only the others are
  scanned. Their candidates then meet the non-essential lists, strongest
  first; the *block maximum* at the candidate's place rejects it before that
  block is decompressed. Rejection is strict, so ties are settled by doc_id.
* **Merge.** A task carries each query's best k from shard to shard; the
  tasks' heaps are merged by a ranked window whose limit is applied before
  the shuffle.

Scores are 64-bit integers as ``impact`` and ``weight`` say.

Cases: null or wordless texts are not documents (they count nowhere); null
or wordless queries get no rows; a query's repeated terms count each time;
every query row and every document row stands for itself, repeated ids too;
equal scores go by doc_id, null ids last; empty tables give no rows; columns
besides (doc_id, text) and (item_id, text) are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerlens.llm.common import alnum_words, map_arrow, materialise

TOP = 20
BLOCK = 128
# Text bytes of a shard; a single longer text is a shard of its own.
SHARD_BYTES = 16 << 20
# Partitions of fewer stored bytes than this are read together.
SCAN_BYTES = 8 << 20
# (query, term) rows searched at a time, about.
QUERY_ROWS = 200_000
# Documents that a search looks at first; later windows grow.
FIRST_WINDOW, LAST_WINDOW = 512, 1 << 16

# The score's constants.
SCALE, SATURATION, LENGTH_PERCENT = 1_000_000_000, 12, 25

INDEX = "shard long, term string, n long, n_terms long, heads binary, body binary"
_HEAD = np.dtype([("last", "<u4"), ("tf", "<u4"), ("n_many", "<u4"), ("n_one", "<u4"), ("at", "<u4")])
_NONE = np.uint32(0xFFFFFFFF)  # no posting of this kind in the block
_WIDE = (np.dtype("u1"), np.dtype("<u2"), np.dtype("<u4"))


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def length_norm(n, documents: int, terms: int):
    """m of a text of n terms: 100 on average, in whole numbers."""
    return 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * documents) // terms


def impact(tf, m):
    return (SCALE * tf) // (1000 * tf + SATURATION * m)


# ------------------------------------------------------------------- index
def _width(x) -> np.ndarray:
    return (x > 0xFF).astype(np.int8) + (x > 0xFFFF)


class Shard:
    """Documents of one shard while it is built."""

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.terms: list[np.ndarray] = []
        self.tfs: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.bytes = 0

    def add(self, doc: int | None, words: list[bytes], size: int) -> None:
        counts = Counter(words)
        code = self.words
        self.terms.append(np.fromiter((code.setdefault(w, len(code)) for w in counts), np.int64, len(counts)))
        self.tfs.append(np.fromiter(counts.values(), np.int64, len(counts)))
        self.ids.append(doc)
        self.lengths.append(len(words))
        self.bytes += size

    def rows(self, shard: int):
        """The shard's document row, then one row per term."""
        null = np.array([i is None for i in self.ids], np.uint8)
        ids = np.array([i or 0 for i in self.ids], "<i8")
        lengths = np.array(self.lengths, "<u4")
        yield shard, None, len(ids), int(lengths.sum(dtype=np.int64)), ids.tobytes() + null.tobytes(), lengths.tobytes()

        term = np.concatenate(self.terms)
        doc = np.repeat(np.arange(len(self.ids)), [len(t) for t in self.terms])
        order = np.argsort(term, kind="stable")  # documents stay ascending within a term
        term, doc, tf = term[order], doc[order], np.concatenate(self.tfs)[order]
        size = np.bincount(term, minlength=len(self.words))
        start = np.concatenate(([0], np.cumsum(size)))
        blocks = -(-size // BLOCK)
        first_block = np.concatenate(([0], np.cumsum(blocks)))
        inside = np.arange(first_block[-1]) - np.repeat(first_block[:-1], blocks)
        lo = np.repeat(start[:-1], blocks) + inside * BLOCK
        hi = np.minimum(lo + BLOCK, np.repeat(start[1:], blocks))
        n = lengths[doc]
        heads = np.zeros(len(lo), _HEAD)
        heads["last"] = doc[hi - 1]
        heads["tf"] = np.maximum.reduceat(tf, lo)
        heads["n_many"] = np.minimum.reduceat(np.where(tf > 1, n, _NONE), lo)
        heads["n_one"] = np.minimum.reduceat(np.where(tf == 1, n, _NONE), lo)
        gap = np.diff(doc, prepend=-1)
        gap[start[:-1]] = doc[start[:-1]] + 1  # a list starts from document -1
        gap_width, tf_width = _width(np.maximum.reduceat(gap, lo)), _width(heads["tf"])
        packed = [bytes((int(g) << 2 | int(t),)) + gap[a:b].astype(_WIDE[g]).tobytes() + tf[a:b].astype(_WIDE[t]).tobytes()
                  for a, b, g, t in zip(lo, hi, gap_width, tf_width)]
        for t, word in enumerate(self.words):
            a, b = first_block[t], first_block[t + 1]
            mine = packed[a:b]
            heads["at"][a:b] = np.concatenate(([0], np.cumsum([len(x) for x in mine])[:-1]))
            yield shard, word.decode(), int(size[t]), 0, heads[a:b].tobytes(), b"".join(mine)


def _indexer(shard_bytes: int):
    names = ["shard", "term", "n", "n_terms", "heads", "body"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches):
        part, made, open_ = TaskContext.get().partitionId(), 0, Shard()

        def out():
            rows = []
            for r in open_.rows(part << 32 | made):
                rows.append(r)
                if len(rows) == 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
                text = text.as_py()
                words = alnum_words(text or b"")
                if not words:
                    continue
                if open_.ids and open_.bytes + len(text) > shard_bytes:
                    yield from out()
                    made, open_ = made + 1, Shard()
                open_.add(doc, words, len(text))
        if open_.ids:
            yield from out()

    return run


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Index rows (INDEX) of all documents, written to the shared folder; term null is a shard's document row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stored = int(str(d._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # many small files make few shards, so a search starts few times; nothing is shuffled
    d = d.coalesce(max(1, min(d.rdd.getNumPartitions(), -(-stored // SCAN_BYTES))))
    return materialise(map_arrow(d, _indexer(shard_bytes), INDEX))


# ------------------------------------------------------------------ search
class Postings:
    """One term's list in one shard; blocks are decompressed when they are first needed."""

    def __init__(self, n: int, heads: bytes, body: bytes, norm: np.ndarray, corpus: tuple[int, int]):
        h = np.frombuffer(heads, _HEAD)
        self.last, self.at, self.body, self.norm = h["last"].astype(np.int64), h["at"], body, norm
        bound = np.zeros(len(h) + 1, np.int64)  # one more: past the last block
        for tf, least in ((h["tf"], h["n_many"]), (np.ones(len(h), np.int64), h["n_one"])):
            there = least != _NONE
            m = length_norm(least[there].astype(np.int64), *corpus)
            bound[:-1][there] = np.maximum(bound[:-1][there], impact(tf[there].astype(np.int64), m))
        self.bound, self.best = bound, int(bound.max())
        # a block still closed shows its last document only, which keeps the array ascending
        self.docs = np.repeat(self.last, BLOCK)[:n]
        self.impacts = np.zeros(n, np.int64)
        self.closed = np.ones(len(h), bool)

    def open(self, blocks: np.ndarray) -> None:
        for k in blocks[self.closed[blocks]].tolist():
            a, b, at = k * BLOCK, min((k + 1) * BLOCK, len(self.docs)), int(self.at[k])
            gap, many = _WIDE[self.body[at] >> 2], _WIDE[self.body[at] & 3]
            gaps = np.frombuffer(self.body, gap, b - a, at + 1)
            tf = np.frombuffer(self.body, many, b - a, at + 1 + gap.itemsize * (b - a)).astype(np.int64)
            docs = np.cumsum(gaps, dtype=np.int64) + (int(self.last[k - 1]) if k else -1)
            self.docs[a:b], self.impacts[a:b] = docs, impact(tf, self.norm[docs])
            self.closed[k] = False

    def between(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.last, (lo, hi - 1))
        self.open(np.arange(k[0], min(k[1] + 1, len(self.last))))
        a, b = np.searchsorted(self.docs, (lo, hi))
        return self.docs[a:b], self.impacts[a:b]


class Heap:
    """A query's best documents so far, over all shards of a task."""

    def __init__(self, top: int):
        self.top, self.score = top, np.empty(0, np.int64)
        self.ids, self.null = np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """The score that a new document has to reach."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def put(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        s, i, z = (np.concatenate(x) for x in ((self.score, score), (self.ids, ids), (self.null, null)))
        order = np.lexsort((i, z, -s))[:self.top]
        self.score, self.ids, self.null = s[order], i[order], z[order]


def search_shard(lists: list[tuple[int, Postings]], ids: np.ndarray, null: np.ndarray, heap: Heap) -> int:
    """MaxScore over (weight, postings) of one shard; returns the number of candidates scored."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].best)
    bounds = np.cumsum([w * p.best for w, p in lists])
    rest = np.concatenate(([0], bounds))  # of all weaker lists
    lo, size, scored = 0, FIRST_WINDOW, 0
    while lo < len(ids):
        hi, size = min(len(ids), lo + size), min(4 * size, LAST_WINDOW)
        least = heap.least
        e = int(np.searchsorted(bounds, least))
        if e == len(lists):
            break
        total = np.zeros(hi - lo, np.int64)
        for w, p in lists[e:]:
            docs, impacts = p.between(lo, hi)
            total[docs - lo] += w * impacts
        at = np.flatnonzero((total > 0) & (total + rest[e] >= least))
        score = total[at]
        at += lo
        scored += len(at)
        for j in range(e - 1, -1, -1):
            w, p = lists[j]
            k = np.searchsorted(p.last, at)
            stay = score + w * p.bound[k] + rest[j] >= least
            if not stay.all():
                at, score, k = at[stay], score[stay], k[stay]
            if not len(at):
                break
            p.open(np.unique(k[k < len(p.last)]))
            spot = np.minimum(np.searchsorted(p.docs, at), len(p.docs) - 1)
            score = score + np.where(p.docs[spot] == at, w * p.impacts[spot], 0)
        if len(at):
            heap.put(score, ids[at], null[at])
        lo = hi
    return scored


def _searcher(queries: dict[int, dict[str, int]], corpus: tuple[int, int], top: int):
    """``queries``: number -> {term: weight times its count in the query}."""
    by_term: dict[str, list[tuple[int, int]]] = {}
    for q, terms in queries.items():
        for t, w in terms.items():
            by_term.setdefault(t, []).append((q, w))

    def run(batches):
        heaps: dict[int, Heap] = {}

        def finish(docs, rows):
            n = docs[0]
            ids, null = np.frombuffer(docs[1], "<i8", n), np.frombuffer(docs[1], np.uint8, n, 8 * n).astype(bool)
            norm = length_norm(np.frombuffer(docs[2], "<u4").astype(np.int64), *corpus)
            found: dict[int, list] = {}
            for term, size, heads, body in rows:
                p = Postings(size, heads, body, norm, corpus)
                for q, w in by_term.get(term, ()):
                    found.setdefault(q, []).append((w, p))
            for q, lists in found.items():
                search_shard(lists, ids, null, heaps.setdefault(q, Heap(top)))

        shard, docs, rows = None, None, []
        for b in batches:
            for s, term, n, heads, body in zip(*(b.column(b.schema.get_field_index(c)).to_pylist()
                                                 for c in ("shard", "term", "n", "heads", "body"))):
                if s != shard:
                    if docs:
                        finish(docs, rows)
                    shard, docs, rows = s, None, []
                if term is None:
                    docs = n, heads, body
                else:
                    rows.append((term, n, heads, body))
        if docs:
            finish(docs, rows)
        out = [(q, None if z else i, s) for q, h in heaps.items() for s, i, z in
               zip(h.score.tolist(), h.ids.tolist(), h.null.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 3,
                                         names=["query", "doc_id", "score"])

    return run


def _terms(batches):
    for b in batches:
        rows = [(q, t.decode(), n) for q, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist())
                for t, n in Counter(alnum_words(text or b"")).items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 3, (pa.int64(), pa.string(), pa.int64()))], names=["query", "term", "count"])


def ranked_search(docs: DataFrame, queries: DataFrame, top: int = TOP, shard_bytes: int = SHARD_BYTES,
                  query_rows: int = QUERY_ROWS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents with a score above 0 of every query row."""
    index = build_index(docs, shard_bytes)
    totals = index.where("term IS NULL").agg(F.sum("n"), F.sum("n_terms"), F.count(F.lit(1))).first()
    items = materialise(queries.select("item_id", "text").withColumn("query", F.monotonically_increasing_id()))
    terms = materialise(map_arrow(items.select("query", "text"), _terms, "query long, term string, count long"))
    blocks = max(1, -(-terms.count() // query_rows))
    corpus, found = (int(totals[0] or 0), int(totals[1] or 0)), None
    for k in range(blocks):
        block = terms.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == k)
        # one block's rows are bounded, so they may travel
        rows = block.collect()
        asked = F.broadcast(block.select(F.col("term").alias("_t")).distinct())
        mine = index.join(asked, F.col("term") == F.col("_t"), "left_semi")
        df = {r.term: r.df for r in mine.groupBy("term").agg(F.sum("n").alias("df")).collect()}
        weights: dict[int, dict[str, int]] = {}
        for q, t, n in rows:
            if t in df and (w := weight(df[t], corpus[0])):
                weights.setdefault(q, {})[t] = n * w
        lists = mine.unionByName(index.where("term IS NULL")).select("shard", "term", "n", "heads", "body")
        lists = lists.repartition(max(1, totals[2]), "shard").sortWithinPartitions("shard", F.asc_nulls_first("term"))
        best = materialise(map_arrow(lists, _searcher(weights, corpus, top), "query long, doc_id long, score long"))
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(items.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
