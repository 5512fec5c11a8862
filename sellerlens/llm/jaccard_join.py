"""N-gram Jaccard self-join with PartEnum signatures.

A document's set holds its distinct five-word shingles; two documents link
when 100 * |a & b| >= 80 * |a | b|.

* **Size bands.** Band k holds set sizes 2**k .. 2**(k+1)-1. Linked sets lie
  in the same or in neighbouring bands, so a set signs for its own band and,
  if it can have larger partners there, for the next.
* **Partitions.** In a band the shingle domain is cut into n1 ranges of the
  hash space. Linked sets a, b differ in at most (|a|+|b|)/9 shingles, and
  each of these spoils one partition at most: with more than D non-empty
  partitions, some partition agrees completely. The hash of (band, partition,
  its shingles) is a signature.
* **Which subset is enumerated.** Signatures are ordered by document
  frequency, rarest first. Linked sets agree on all but D of their
  partitions, so by the prefix principle each needs just its D+1 rarest
  ones, and signatures that no other document has fill these places first.
  Shared boilerplate is frequent and falls out; nothing is capped.
* **Sets with too few non-empty partitions** also sign with their
  floor(0.2 n)+1 smallest shingles (exact prefix filter among themselves).

Signatures shared by documents that are not yet in one component are *open*.
Linear star rounds test open documents against an open signature's pivot: its
most central document, the one whose signatures have the most holders (of a
text and its many near copies, the text). The first round tests each document
against the pivot it shares most with, later ones against all its pivots, after
which a pivot leaves its signatures; rounds go on while they pay off. What
stays open goes, as a query set, against its family's members in blocks of
bounded size. Labels that prune tests are contracted by a few hops only; the
components proper are computed once, from all links. Sets equal to each other
are one class from the start, so copies never meet.

Cases: null, empty or wordless text has n_shingles 0 and is linked with
nothing; fewer than five words give one shingle, the whole sequence; rows
that repeat a doc_id are one document; a null doc_id is linked with nothing
(component null); an empty table gives an empty result; columns besides
(doc_id, text) are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerlens.llm.common import (apart, connected_components, drop_listed, keep_if_listed, map_arrow, materialise, ship, space_words)

N = 5
# Expected shingles in a partition at a band's upper end.
PER_PARTITION = 3
# Star rounds go on while at least this share of their tests links.
STAR_YIELD = 0.2
# Shingles in a block of the last, blockwise test.
BLOCK_SHINGLES = 1 << 16
# Bounds of a task's word table, and signatures that it puts out at a time.
WORDS, WORD_BYTES, SIGNATURES_OUT = 100_000, 4 << 20, 200_000
# Hops by which labels are contracted after a round.
HOPS = 2
# A family's plan is repeated this often, so that its rows need not meet in one task.
SALTS = 32

U = np.uint64
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    """Word -> 64-bit hash; bounded, in words and bytes, by starting anew."""

    held = 0

    def __missing__(self, word: bytes) -> int:
        self.held += len(word)
        if len(self) > WORDS or self.held > WORD_BYTES:
            self.clear()
            self.held = len(word)
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles."""
    words = space_words((text or b"").lower())
    if not words:
        return np.empty(0, U)
    h = np.fromiter(map(hashes.__getitem__, words), U, len(words))
    if len(h) < N:  # the whole sequence as one; its length keeps it apart
        return mix((h * _ODD[:len(h)]).sum(dtype=U, keepdims=True) + U(len(h)))
    k = len(h) - N + 1
    a = h[:k] * _ODD[0]
    for i in range(1, N):
        a += h[i:k + i] * _ODD[i]
    a = np.sort(mix(a))
    return a[np.concatenate(([True], a[1:] != a[:-1]))]


def band_of(n: int) -> int:
    return n.bit_length() - 1


def instances(n: int) -> list[tuple[int, int, int]]:
    """(band, partitions, most differing shingles) that a set of n shingles signs for."""
    largest = n * 5 // 4
    out = []
    for band in range(band_of(n), band_of(largest) + 1):
        top = (2 << band) - 1
        out.append((band, max(1, -(-top // PER_PARTITION)), (n + min(largest, top)) // 9))
    return out


def signatures(s: np.ndarray):
    """Per instance: (signatures, places left once all are counted); then the small-set prefix."""
    n = len(s)
    scrambled = mix(s ^ _ODD[3])
    weak = False
    for which, (band, n1, most) in enumerate(instances(n)):
        part = ((s >> U(32)) * U(n1)) >> U(32)
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        g = mix(np.add.reduceat(scrambled, first) + (part[first] * U(64) + U(band)) * _ODD[1])
        weak |= len(g) <= most
        yield g, which, most + 1 - len(g)
    if weak:
        yield mix(s[:n // 5 + 1] ^ _ODD[4]), 2, 0


def _signer(batches):
    hashes = WordHashes()
    for b in batches:
        sig, doc, places, held = [], [], [], 0
        for d, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            s = shingle_set(t, hashes)
            if d is None or not len(s):
                continue
            for g, w, p in signatures(s):
                sig.append(g)
                doc.append(np.full(len(g), d, np.int64))
                places.append(np.full(len(g), p * 4 + w, np.int32))
                held += len(g)
            if held >= SIGNATURES_OUT:
                yield _rows(sig, doc, places)
                sig, doc, places, held = [], [], [], 0
        if sig:
            yield _rows(sig, doc, places)


def _rows(sig, doc, places):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(doc)), pa.array(np.concatenate(places))],
        names=["sig", "doc", "places"])


def _classifier(batches):
    hashes = WordHashes()
    for b in batches:
        out = []
        for d, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            s = shingle_set(t, hashes)
            k1, k2 = mix(s ^ _ODD[2]).sum(dtype=U), s.sum(dtype=U)
            out.append((d, len(s), int(k1.view(np.int64)), int(k2.view(np.int64))))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 4,
                                         names=["doc_id", "n_shingles", "k1", "k2"])


def _setter(batches):
    hashes = WordHashes()
    for b in batches:
        sets = [shingle_set(t, hashes) for t in b.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
            names=["doc", "n", "items"])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 80 * (len(a) + len(b) - both)


def _verifier(batches):
    for b in batches:
        x, y = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("items_a", "items_b"))
        ok = pa.array([linked(np.frombuffer(p, U), np.frombuffer(q, U)) for p, q in zip(x, y)], pa.bool_())
        yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in ("a", "b")), ok], names=["a", "b", "ok"])


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, rep): rep is the smallest doc_id with an equal set."""
    d = materialise(map_arrow(docs.select("doc_id", "text"), _classifier, "doc_id long, n_shingles long, k1 long, k2 long"))
    full = d.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = full.groupBy("n_shingles", "k1", "k2").agg(F.min("doc_id").alias("rep"))
    return full.join(apart(reps), ["n_shingles", "k1", "k2"]).select("doc_id", "n_shingles", "rep").unionByName(
        d.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("rep")))


def buckets(docs: DataFrame) -> DataFrame:
    """(sig, doc, w, mass): the enumerated signatures that two documents or more share.

    Signatures with the very same holders count as one, of weight w; a document's
    mass counts the holders of all its signatures."""
    rows = map_arrow(docs.select("doc_id", "text"), _signer, "sig long, doc long, places int")
    shared = materialise(rows.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("sig"))).where("df > 1"))
    own = Window.partitionBy("doc", "places")
    # a document's rows stay together through duplicates, ranks and the choice
    rare = (
        shared.repartition("doc").dropDuplicates(["sig", "doc", "places"])
        .withColumns({"_all": F.count(F.lit(1)).over(own), "_rank": F.row_number().over(own.orderBy("df", "sig"))})
        .where("(places & 3) = 2 OR _rank <= _all + shiftright(places, 2)").select("sig", "doc").distinct()
    )
    held = Window.partitionBy("sig")
    spot = lambda k: F.bit_xor(F.xxhash64("doc", F.lit(k))).over(held)
    held_by = rare.withColumns({"_n": F.count(F.lit(1)).over(held), "_h": F.xxhash64(spot(0), spot(1))}).where("_n > 1")
    # equal hashes of different holders would only put more documents together
    few = held_by.repartition("doc").groupBy("doc", "_n", "_h").agg(F.count(F.lit(1)).alias("w"))
    mass = F.sum(F.col("_n") * F.col("w")).over(Window.partitionBy("doc"))
    return few.select(F.xxhash64("_n", "_h").alias("sig"), "doc", "w", mass.alias("mass"))


def _open(members: DataFrame) -> DataFrame:
    """Open signatures of (sig, doc, mass, comp) with their pivot."""
    return (
        members.groupBy("sig").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.max(F.struct("mass", "doc", "comp")).alias("p"))
        .where("_lo < _hi").select("sig", F.col("p.doc").alias("pivot"), F.col("p.comp").alias("pivot_comp"))
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("doc").alias("a"), F.col("items").alias("items_a"))
    b = sets.select(F.col("doc").alias("b"), F.col("items").alias("items_b"))
    return map_arrow(pairs.join(b, "b").join(a, "a").select("a", "b", "items_a", "items_b"), _verifier, "a long, b long, ok boolean")


def _contract(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (doc, comp) where components of linked documents (a, b) took the most central label within ``HOPS`` hops."""
    one = links.join(labels.select(F.col("doc").alias("a"), F.col("comp").alias("u")), "a")
    ends = one.join(labels.select(F.col("doc").alias("b"), F.col("comp").alias("v")), "b").where("u <> v")
    up = ends.groupBy(F.least("u", "v").alias("low")).agg(F.max(F.greatest("u", "v")).alias("up"))
    for _ in range(HOPS):
        up = materialise(up)
        above = up.select(F.col("low").alias("_l"), F.col("up").alias("_u"))
        up = up.join(above, up["up"] == above["_l"], "left").select("low", F.coalesce("_u", "up").alias("up"))
    return materialise(labels.join(up, labels["comp"] == up["low"], "left").select("doc", F.coalesce("up", "comp").alias("comp")))


def _in_blocks(frame: pd.DataFrame) -> pd.DataFrame:
    """Links of the query rows to the other rows, family by family; one per pair of components."""
    found = []
    for _, f in frame.groupby("family", sort=False):
        sets = [np.frombuffer(x, U) for x in f["items"]]
        size = np.array([len(s) for s in sets])
        column, at = np.unique(np.concatenate(sets), return_inverse=True)
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        comp, doc, query, base = (f[c].to_numpy() for c in ("comp", "doc", "query", "base"))
        for i in np.flatnonzero(query):
            near = base & (comp != comp[i]) & (5 * np.minimum(size, size[i]) >= 4 * np.maximum(size, size[i]))
            if not near.any():
                continue
            flag = np.zeros(len(column), np.int64)
            flag[at[first[i]:first[i] + size[i]]] = 1
            both = np.add.reduceat(flag[at], first)
            hit = np.flatnonzero(near & (100 * both >= 80 * (size + size[i] - both)))
            _, k = np.unique(comp[hit], return_index=True)
            found += [(doc[i], doc[j]) for j in hit[k]]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _leftovers(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components of the open signatures' documents (sig, doc, mass, comp), tested in blocks.

    The documents of all open signatures with the same pivot are a family, so near copies that share
    many signatures meet once."""
    m = members.join(apart(_open(members)), "sig").select(F.col("pivot").alias("family"), "doc", F.col("comp.d").alias("comp")).distinct()
    m = materialise(m.join(sets.select("doc", "n"), "doc").select("family", "doc", "comp", "n"))
    sizes = m.groupBy("family", "comp").agg(F.sum("n").alias("n"))
    plan = sizes.groupBy("family").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("n_main"))
    block = F.lit(BLOCK_SHINGLES)
    plan = plan.select("family", "main", F.ceil(F.col("n") / block).alias("bases"),
                       F.ceil((F.col("n") - F.col("n_main")) / block).alias("queries"))
    # small families share a task; the number of such tasks follows their total size
    total = sizes.agg(F.sum("n")).first()[0] or 0
    packs = max(1, -(-total // BLOCK_SHINGLES))
    salted = plan.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    x = m.withColumn("_s", F.pmod(F.xxhash64("doc", F.lit(2)), F.lit(SALTS)).cast("int")).join(salted, ["family", "_s"]).drop("_s").withColumns({
        "_q": F.pmod(F.xxhash64("doc"), "queries"), "_b": F.pmod(F.xxhash64("doc", F.lit(1)), "bases"),
        "_small": (F.col("bases") == 1) & (F.col("queries") == 1),
    })
    span = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    as_query = x.where("comp <> main").withColumn("_b", F.explode(span("bases"))).withColumns({"query": F.lit(True), "base": F.lit(False)})
    as_base = x.withColumn("_q", F.explode(span("queries"))).withColumns({"query": F.lit(False), "base": F.lit(True)})
    rows = as_query.unionByName(as_base)
    rows = rows.groupBy("family", "doc", "comp", "_small", "_q", "_b").agg(F.max("query").alias("query"), F.max("base").alias("base"))
    key = F.when(F.col("_small"), F.struct(F.pmod(F.xxhash64("family"), F.lit(packs)).alias("f"), F.lit(-1).cast("long").alias("q"), F.lit(-1).cast("long").alias("b"))).otherwise(
        F.struct(F.col("family").alias("f"), F.col("_q").alias("q"), F.col("_b").alias("b")))
    ship(members.sparkSession)
    return (
        rows.withColumn("key", key).select("key", "family", "doc", "comp", "query", "base").join(sets.select("doc", "items"), "doc")
        .groupBy("key").applyInPandas(_in_blocks, "a long, b long")
    )


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document; component_id is the smallest reachable doc_id."""
    cls = materialise(classes(docs))
    copies = cls.where("doc_id <> rep").select("doc_id").distinct()
    shared = materialise(buckets(drop_listed(docs.select("doc_id", "text"), "doc_id", copies)))
    labels = materialise(shared.select("doc", F.struct(F.col("mass").alias("m"), F.col("doc").alias("d")).alias("comp")).distinct())
    ids = labels.select("doc")
    listed = keep_if_listed(docs.select("doc_id", "text").where("doc_id IS NOT NULL"), "doc_id", ids)
    listed = listed.join(ids, listed["doc_id"] == ids["doc"], "left_semi").dropDuplicates(["doc_id"])
    sets = materialise(map_arrow(listed, _setter, "doc long, n long, items binary"))

    links, turn = None, 0
    while True:
        members = shared.join(labels, "doc")
        starred = materialise(members.join(apart(_open(members)), "sig"))
        pairs = starred.where("comp <> pivot_comp").groupBy(F.col("pivot").alias("a"), F.col("doc").alias("b")).agg(F.sum("w").alias("_n"))
        if turn == 0:
            pairs = pairs.groupBy("b").agg(F.max_by("a", F.struct("_n", "a")).alias("a"))
        tested = materialise(_verified(pairs.select("a", "b"), sets))
        n, good = tested.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("ok").cast("int")), F.lit(0))).first()
        if good:
            found = tested.where("ok").select("a", "b")
            links = found if links is None else links.unionByName(found)
            labels = _contract(labels, found)
        # what is closed stays closed; a pivot that met all its signature's documents is done with it
        shared = starred.where("doc <> pivot" if turn else "true").select("sig", "doc", "w", "mass")
        if n == 0 or (turn and good < STAR_YIELD * n):
            break
        turn += 1
    if n:
        found = materialise(_leftovers(shared.join(labels, "doc"), sets))
        links = found if links is None else links.unionByName(found)
    if links is None:
        return cls.select("doc_id", "n_shingles", F.col("rep").alias("component_id"))
    # the linked documents stand for their classes; carry the components to every member
    linked_reps = connected_components(links)
    return cls.join(apart(linked_reps), cls["rep"] == linked_reps["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
