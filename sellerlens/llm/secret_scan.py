"""Secret scans: base patterns plus a character convolutional network over every candidate in its context.

* **Base.** Fixed patterns over the text's UTF-8 bytes (all are ASCII); spans
  are code points. A match that is too short is dropped, not retried.
* **Candidates.** Every run of token characters that holds a digit and at
  least 8 of them, or any 24, with ``CONTEXT`` characters on both sides. A
  candidate that overlaps a base span is a *labelled finding* (positive);
  others are negatives, unless the caller brings labels of his own.
* **Network.** Characters of context and candidate are symbols per region;
  one layer of width-5 filters (a table look-up per place and symbol), the
  maximum of each filter over the whole sequence (long candidates in
  overlapping pieces, so none is cut), one logistic unit. Plain NumPy, Adam.
  Each example is also seen with its context hidden and with its case
  swapped, and a finding of at least ``MOVED`` characters in the context of a
  negative, so neither the keyword nor the spelling alone decides. Negatives
  that a network of the other half of the examples takes for findings may be
  secrets that no pattern knows; the final network is not taught on them.
* **Examples.** Every different candidate of all documents, once. They are dealt
  by hash into shards of about ``SHARD``. In every epoch each shard goes on from
  the common state by steps over its own examples, and the weighted mean of
  the shards' states is the next common one; means are taken in Spark, the
  driver holds one state. Up to ``SHARD`` examples are one shard: plain training.
* **Calibration and threshold.** Every fifth example of a shard, in all its views, is set
  aside. A slope and an offset fitted to them (Platt) make probabilities; the threshold is
  the highest that keeps ``RECALL`` of the set-aside findings of every kind,
  and not below ``LEAST`` of calibrated probability, so that clean text stays.

Cases: null or empty text has no spans; without findings or without negatives
there is nothing to learn from and no span is added; repeated rows are judged
alike; a null doc_id stays null; an empty table gives an empty result; columns
besides (doc_id, text) are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerlens.llm.common import map_arrow, materialise, ship

KINDS = ("assign", "access", "hex")
LEARNED = "learned"
# The base patterns and the least length of what they find.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

# Runs of token characters, tried at their first character only, so time is linear.
_HEAD = rb"(?<![A-Za-z0-9+/_.=-])"
WITH_DIGIT = re.compile(_HEAD + rb"[A-Za-z+/_.=-]*+[0-9][A-Za-z0-9+/_.=-]*+")
LONG = re.compile(_HEAD + rb"[A-Za-z+/_.=-]{24,}+(?![0-9])")
LEAST_CANDIDATE = 8

CONTEXT = 24
MOVED = 16
# Examples per shard, about: what one task learns from in an epoch.
SHARD = 4500
# Of a longer candidate fitting sees its two ends; judging sees all of it.
FIT_VALUE = 256
RECALL, LEAST = 0.99, 0.5
FILTERS, WIDTH, EPOCHS, BATCH, RATE = 32, 5, 8, 64, 0.01
# Characters of a long sequence that are convolved at a time.
PIECE = 512

SPAN = "struct<kind:string,s:int,e:int>"
CANDIDATE = "struct<s:int,e:int,before:string,value:string,after:string,kind:string>"


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start byte, kind number, end byte) in the result's order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return sorted(out)


def candidates(text: bytes) -> list[tuple[int, int]]:
    out = [m.span() for m in WITH_DIGIT.finditer(text)] + [m.span() for m in LONG.finditer(text)]
    return sorted((s, e) for s, e in out if e - s >= LEAST_CANDIDATE)


class CodePoints:
    """Byte offsets of one text as code points; linear over ascending look-ups."""

    def __init__(self, text: bytes):
        self.text, self.ascii = text, text.isascii()
        if not self.ascii:
            lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
            self.before = np.concatenate(([0], np.cumsum(lead)))

    def __getitem__(self, byte: int) -> int:
        return byte if self.ascii else int(self.before[byte])


def _around(text: bytes, s: int, e: int) -> tuple[str, str]:
    """At most CONTEXT characters before and after."""
    before = text[max(0, s - 4 * CONTEXT):s].decode(errors="ignore")[-CONTEXT:]
    return before, text[e:e + 4 * CONTEXT].decode(errors="ignore")[:CONTEXT]


def _finder(batches):
    span = pa.struct([("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32())])
    cand = pa.struct([("s", pa.int32()), ("e", pa.int32()), ("before", pa.string()), ("value", pa.string()), ("after", pa.string()), ("kind", pa.string())])
    for b in batches:
        base, found = [], []
        for text in b.column(1).cast(pa.binary()):
            text = text.as_py() or b""
            spans = base_spans(text)
            tokens = candidates(text)
            at = CodePoints(text) if spans or tokens else None
            base.append([{"kind": KINDS[k], "s": at[s], "e": at[e]} for s, k, e in spans])
            row, starts = [], [s for s, _, _ in spans]
            reach = list(accumulate((e for _, _, e in spans), max))
            for s, e in tokens:
                # base spans that overlap the token: from the last that begins before its end, back while any reaches it
                i, kind = bisect_right(starts, e - 1) - 1, None
                while i >= 0 and reach[i] > s:
                    if spans[i][2] > s:
                        kind = KINDS[min(spans[i][1], KINDS.index(kind) if kind else len(KINDS))]
                    i -= 1
                before, after = _around(text, s, e)
                row.append({"s": at[s], "e": at[e], "before": before, "value": text[s:e].decode(), "after": after, "kind": kind})
            found.append(row)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, pa.list_(span)), pa.array(found, pa.list_(cand))],
                                         names=["doc_id", "base", "candidates"])


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base spans, candidates) of every row, written once for its readers."""
    return materialise(map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _finder,
                                 f"doc_id long, base array<{SPAN}>, candidates array<{CANDIDATE}>"))


# ----------------------------------------------------------------- network
PARTS = ("conv", "bias", "out", "offset")
SYMBOLS = 98  # printable ASCII, line breaks, other controls, everything else
_PAD = 0  # symbol 0 of the joint alphabet fills short sequences; its weights stay zero


def symbols(before: str, value: str, after: str) -> np.ndarray:
    """One sequence over 1 + 3 * SYMBOLS symbols: context and candidate have alphabets of their own."""
    out = []
    for region, part in enumerate((before, value, after)):
        c = np.frombuffer(part.encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        code = np.where((c >= 32) & (c < 127), c - 32, np.where((c == 10) | (c == 13), 95, np.where(c < 32, 96, 97)))
        out.append(1 + region * SYMBOLS + code)
    return np.concatenate(out)


class Network:
    """Convolution by table look-up, maximum over places, logistic unit."""

    def __init__(self, seed: int = 13, filters: int = FILTERS):
        rng = np.random.default_rng(seed)
        size = 1 + 3 * SYMBOLS
        self.w = {"conv": rng.normal(0, 0.1, (WIDTH, size, filters)), "bias": np.zeros(filters),
                  "out": rng.normal(0, 0.1, filters), "offset": np.zeros(1)}
        self.w["conv"][:, _PAD] = 0

    def pool(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(maximum, place) of each filter for rows of symbols, padded to the same length."""
        x = np.pad(x, ((0, 0), (WIDTH // 2, WIDTH // 2)))
        n = x.shape[1] - WIDTH + 1
        total = self.w["bias"] + sum(self.w["conv"][k][x[:, k:k + n]] for k in range(WIDTH))
        at = total.argmax(axis=1)
        return np.take_along_axis(total, at[:, None], axis=1)[:, 0], at

    def logit(self, sequence: np.ndarray) -> float:
        """Of a sequence of any length: pieces overlap by the filter width, so every place is seen whole."""
        if not len(sequence):
            sequence = np.zeros(1, np.int64)
        best = np.full(len(self.w["bias"]), -np.inf)
        x = np.pad(sequence, WIDTH // 2)
        for s in range(0, len(sequence), PIECE):
            part = x[s:s + PIECE + WIDTH - 1]
            n = len(part) - WIDTH + 1
            best = np.maximum(best, (self.w["bias"] + sum(self.w["conv"][k][part[k:k + n]] for k in range(WIDTH))).max(axis=0))
        return float(np.maximum(best, 0) @ self.w["out"] + self.w["offset"][0])

    def start(self) -> Network:
        """Adam's means before the first step."""
        self.first = {k: np.zeros_like(v) for k, v in self.w.items()}
        self.second = {k: np.zeros_like(v) for k, v in self.w.items()}
        self.step = 0
        return self

    def state(self) -> np.ndarray:
        return np.concatenate([part[k].ravel() for part in (self.w, self.first, self.second) for k in PARTS] + [np.array([float(self.step)])])

    @classmethod
    def of_state(cls, flat: np.ndarray) -> Network:
        net, at = cls().start(), 0
        for part in (net.w, net.first, net.second):
            for k in PARTS:
                part[k] = flat[at:at + part[k].size].reshape(part[k].shape).copy()
                at += part[k].size
        net.step = round(float(flat[at]))
        return net

    def epoch(self, data: list[tuple[np.ndarray, float]], number: int, share: float, seed: int = 13) -> None:
        """One pass of Adam steps over ``data`` in the order of epoch ``number``; ``share`` of all examples are findings."""
        rng = np.random.default_rng(seed)
        for _ in range(number + 1):
            order = rng.permutation(len(data))
        for s in range(0, len(order), BATCH):
            part = [data[i] for i in order[s:s + BATCH]]
            longest = max(1, max(len(x) for x, _ in part))
            x = np.zeros((len(part), longest), np.int64)
            for i, (seq, _) in enumerate(part):
                x[i, :len(seq)] = seq
            y = np.array([t for _, t in part])
            pooled, at = self.pool(x)
            alive = np.maximum(pooled, 0)
            p = sigmoid(alive @ self.w["out"] + self.w["offset"][0])
            g = (p - y) * np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share)) / len(part)  # both labels weigh the same
            back = np.outer(g, self.w["out"]) * (pooled > 0)
            grad = {"out": alive.T @ g, "offset": np.array([g.sum()]), "bias": back.sum(axis=0), "conv": np.zeros_like(self.w["conv"])}
            padded = np.pad(x, ((0, 0), (WIDTH // 2, WIDTH // 2)))
            rows, cols = np.arange(len(part))[:, None], np.arange(pooled.shape[1])[None, :]
            for k in range(WIDTH):
                np.add.at(grad["conv"][k], (padded[rows, at + k], cols), back)
            grad["conv"][:, _PAD] = 0
            self.step += 1
            for name, v in grad.items():
                self.first[name] = 0.9 * self.first[name] + 0.1 * v
                self.second[name] = 0.999 * self.second[name] + 0.001 * v * v
                self.w[name] -= RATE * (self.first[name] / (1 - 0.9 ** self.step)) / (np.sqrt(self.second[name] / (1 - 0.999 ** self.step)) + 1e-8)

    def fit(self, data: list[tuple[np.ndarray, float]], epochs: int = EPOCHS, seed: int = 13) -> None:
        self.start()
        for number in range(epochs):
            self.epoch(data, number, sum(y for _, y in data) / len(data), seed)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) with the least log loss against smoothed targets, by damped Newton steps."""
    n_pos, n_neg = y.sum(), (1 - y).sum()
    target = np.where(y > 0.5, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))

    def sums(a, b):
        p = sigmoid(a * logits + b)
        r, v = p - target, p * (1 - p) + 1e-9
        return (r * logits).sum(), r.sum(), (v * logits * logits).sum(), (v * logits).sum(), v.sum()

    return _platt_steps(sums)


def _platt_steps(sums) -> tuple[float, float]:
    """From ``sums(a, b)``: residuals by logit and alone, weights by squared logit, by logit and alone."""
    a, b = 1.0, 0.0
    for _ in range(50):
        rz, r, vzz, vz, v = sums(float(a), float(b))
        d = np.linalg.solve(np.array([[vzz + 1e-3, vz], [vz, v + 1e-6]]), np.array([rz + 1e-3 * (a - 1), r]))
        d *= min(1.0, 2.0 / (np.abs(d).max() + 1e-12))
        a, b = a - d[0], b - d[1]
        if np.abs(d).max() < 1e-12:
            break
    return float(max(a, 1e-3)), float(b)


class Model:
    """A fitted network with its calibration and threshold."""

    def __init__(self, net: Network, slope: float, offset: float, threshold: float):
        self.net, self.slope, self.offset, self.threshold = net, slope, offset, threshold

    def probability(self, before: str, value: str, after: str) -> float:
        return float(sigmoid(self.slope * self.net.logit(symbols(before, value, after)) + self.offset))


def _views(example: tuple, other: tuple[str, str] | None):
    """An example as it is, without its context and, a long enough finding, in a negative's; each in both cases."""
    before, value, after, kind = example
    seen = [(before, value, after), ("", value, "")]
    if kind is not None and other and len(value) >= MOVED:
        seen.append((other[0], value, other[1]))
    return [symbols(*(c.swapcase() if swap else c for c in x)) for x in seen for swap in (False, True)]


Example = tuple[str, str, str, str | None]  # before, value, after, kind or None for a negative
FINAL = 2  # the number of the final network; 0 and 1 learn from a half each


def _seen(examples: list[Example]) -> list[tuple[list[np.ndarray], str | None]]:
    """(views, kind) of examples in a fixed order."""
    contexts = [(b, a) for b, _, a, kind in examples if kind is None]
    return [(_views(x, contexts[i % len(contexts)] if contexts else None), x[3]) for i, x in enumerate(examples)]


def _lesson(every: list, doubtful: set[int], number: int) -> list[tuple[np.ndarray, float]]:
    """What a network learns from: ``number`` 0 and 1 from the examples of the other half, ``FINAL`` from the sure ones not set aside."""
    if number == FINAL:
        some = [x for i, x in enumerate(x for j, x in enumerate(every) if j not in doubtful) if i % 5 != 4]
    else:
        some = [x for i, x in enumerate(every) if i % 2 != number]
    return [(v, float(kind is not None)) for views, kind in some for v in views]


def _doubtful(every: list, nets: dict[int, Network]) -> set[int]:
    """Negatives of each half that the network of the other half takes for findings."""
    return {i for i, (views, kind) in enumerate(every) if kind is None and i % 2 in nets and nets[i % 2].logit(views[0]) > 0}


def _held(every: list, doubtful: set[int], net: Network) -> list[tuple[str, float]]:
    """(kind or empty, logit) of all views set aside."""
    sure = [x for j, x in enumerate(every) if j not in doubtful]
    return [(kind or "", net.logit(v)) for views, kind in sure[4::5] for v in views]


def _mixed(data: list[tuple[np.ndarray, float]]) -> bool:
    return len({y for _, y in data}) == 2


def train(examples: list[Example], recall: float = RECALL, least: float = LEAST) -> Model | None:
    """From examples in a fixed order, in one process: what ``fit`` does with a single shard."""
    every = _seen(examples)
    nets = {}
    for number in (0, 1):
        if _mixed(data := _lesson(every, set(), number)):
            nets[number] = Network()
            nets[number].fit(data)
    doubtful = _doubtful(every, nets)
    if not _mixed(data := _lesson(every, doubtful, FINAL)):
        return None
    net = Network()
    net.fit(data)
    held = _held(every, doubtful, net)
    kinds, logits = np.array([k for k, _ in held]), np.array([z for _, z in held])
    if not (kinds != "").any() or not (kinds == "").any():
        return None
    slope, offset = platt(logits, (kinds != "").astype(float))
    cuts = [np.sort(logits[kinds == kind])[::-1][int(np.ceil(recall * (kinds == kind).sum())) - 1] for kind in set(kinds) - {""}]
    return Model(net, slope, offset, max(least, float(sigmoid(slope * min(cuts) + offset))))


def examples_of(found: DataFrame, shard: int = SHARD) -> tuple[DataFrame, int]:
    """(shard, o, before, value, after, kind) of every different labelled candidate, and the number of shards."""
    half = FIT_VALUE // 2
    value = F.when(F.length("c.value") > FIT_VALUE, F.concat(F.left("c.value", F.lit(half)), F.right("c.value", F.lit(half)))).otherwise(F.col("c.value"))
    rows = found.select(F.explode("candidates").alias("c")).select("c.before", value.alias("value"), "c.after", "c.kind")
    # copies of a document must not weigh more
    one = rows.groupBy("before", "value", "after", F.col("kind").isNotNull().alias("_known")).agg(F.min("kind").alias("kind")).drop("_known")
    one = materialise(one.withColumn("o", F.xxhash64("before", "value", "after")))
    n = max(1, math.ceil(one.count() / shard))
    return one.select(F.pmod(F.xxhash64("o", "kind"), F.lit(n)).alias("shard"), "o", "before", "value", "after", "kind"), n


class Shards:
    """Passes over the shards of the examples: every task sees whole shards, in a fixed order."""

    SCHEMA = "shard long, o long, before string, value string, after string, kind string"

    def __init__(self, rows: DataFrame, n: int):
        ship(rows.sparkSession)
        self.rows, self.n, self.marked = rows, n, "doubtful" in rows.columns

    def each(self, func, schema: str) -> DataFrame:
        """``func(shard, every, doubtful, sorted rows)`` -> a table, of every shard."""
        def run(table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: (r["o"], r["before"], r["value"], r["after"], r["kind"] or ""))
            every = _seen([(r["before"], r["value"], r["after"], r["kind"]) for r in rows])
            return func(rows[0]["shard"], every, {i for i, r in enumerate(rows) if r.get("doubtful")}, rows)

        # a number of its own, so that adaptive execution does not put few bytes of much work into one task
        return self.rows.repartition(2 * self.n, "shard").groupBy("shard").applyInArrow(run, schema)

    def sizes(self, numbers: tuple[int, ...]) -> dict[int, tuple[int, float]]:
        """{network: (views, share of findings)} for networks that have both labels."""
        def count(_, every, doubtful, rows):
            got = [(k, len(d := _lesson(every, doubtful, k)), int(sum(y for _, y in d))) for k in numbers]
            return pa.table(dict(zip(("net", "n", "pos"), (pa.array(c, pa.int64()) for c in zip(*got)))))

        found = self.each(count, "net long, n long, pos long").groupBy("net").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).collect()
        return {r.net: (r.n, r.pos / r.n) for r in found if 0 < r.pos < r.n}

    def learn(self, numbers: tuple[int, ...]) -> dict[int, Network]:
        """The networks that have both labels to learn from, after all epochs."""
        sizes = self.sizes(numbers)
        states = {k: Network().start().state() for k in sizes}
        slots = math.ceil(math.sqrt(self.n))
        for epoch in range(EPOCHS if sizes else 0):
            def go(shard, every, doubtful, _, epoch=epoch, states=dict(states)):
                out = []
                for k, flat in states.items():
                    if data := _lesson(every, doubtful, k):
                        net = Network.of_state(flat)
                        net.epoch(data, epoch, sizes[k][1])
                        out.append((k, shard % slots, (net.state() * (len(data) / sizes[k][0])).tobytes()))
                return pa.table({c: pa.array([x[i] for x in out], t) for i, (c, t) in enumerate((("net", pa.int64()), ("slot", pa.int64()), ("w", pa.binary())))})

            some = self.each(go, "net long, slot long, w binary").groupBy("net", "slot").applyInArrow(_total, "net long, slot long, w binary")
            # one state per network
            for r in some.withColumn("slot", F.lit(0).cast("long")).groupBy("net").applyInArrow(_total, "net long, slot long, w binary").collect():
                states[r.net] = np.frombuffer(bytes(r.w))
        return {k: Network.of_state(flat) for k, flat in states.items()}

    def marked_by(self, nets: dict[int, Network]) -> Shards:
        """These shards with a mark on the negatives that the networks doubt."""
        def mark(_, every, __, rows):
            doubtful = _doubtful(every, nets)
            return pa.Table.from_pylist([r | {"doubtful": i in doubtful} for i, r in enumerate(rows)], schema=pa.schema([
                ("shard", pa.int64()), ("o", pa.int64()), *[(c, pa.string()) for c in ("before", "value", "after", "kind")], ("doubtful", pa.bool_())]))

        return Shards(materialise(self.each(mark, f"{self.SCHEMA}, doubtful boolean")), self.n)

    def held(self, net: Network) -> DataFrame:
        """(kind, logit) of all views set aside; kind is empty for negatives."""
        def judge(_, every, doubtful, __):
            got = _held(every, doubtful, net)
            return pa.table({"kind": pa.array([k for k, _ in got], pa.string()), "logit": pa.array([z for _, z in got], pa.float64())})

        return materialise(self.each(judge, "kind string, logit double"))


def _total(table: pa.Table) -> pa.Table:
    """The sum of the states of one network (and slot)."""
    total = sum(np.frombuffer(w) for w in table["w"].to_pylist())
    return pa.table({"net": table["net"][:1], "slot": table["slot"][:1], "w": pa.array([total.tobytes()], pa.binary())})


def _platt_of(held: DataFrame) -> tuple[float, float] | None:
    """``platt`` of (kind, logit) rows, each step's sums by Spark; None without findings or negatives."""
    y = F.when(F.col("kind") != "", 1.0).otherwise(0.0)
    n_pos, n_all = held.agg(F.sum(y), F.count(F.lit(1))).first()
    if not n_pos or n_pos == n_all:
        return None
    target = F.when(F.col("kind") != "", (n_pos + 1) / (n_pos + 2)).otherwise(1 / (n_all - n_pos + 2))
    z = F.col("logit")

    def sums(a, b):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), F.lit(a) * z + F.lit(b)))))
        r, v = p - target, p * (1 - p) + 1e-9
        return held.agg(F.sum(r * z), F.sum(r), F.sum(v * z * z), F.sum(v * z), F.sum(v)).first()

    return _platt_steps(sums)


def _threshold_of(held: DataFrame, slope: float, offset: float, recall: float = RECALL, least: float = LEAST) -> float:
    """The highest that keeps ``recall`` of the findings of every kind: the logit at that place, from running counts."""
    from sellerlens.operators.prefix import ordered_cumulative_sums  # on the driver only: tasks have this subpackage alone
    counts = held.where("kind <> ''").groupBy("kind", (-F.col("logit")).alias("z")).agg(F.count(F.lit(1)).alias("n"))
    run = ordered_cumulative_sums(counts, ["kind", "z"], ["n"])
    sizes = {r.kind: (r.total, r.before) for r in run.groupBy("kind").agg(F.sum("n").alias("total"), F.min(F.col("cum_n") - F.col("n")).alias("before")).collect()}
    wanted = [F.min(F.when((F.col("kind") == k) & (F.col("cum_n") - before >= int(np.ceil(recall * total))), F.col("z"))) for k, (total, before) in sizes.items()]
    return max(least, float(sigmoid(slope * -max(run.agg(*wanted).first()) + offset)))


def fit(found: DataFrame, shard: int = SHARD) -> Model | None:
    """A model from all labelled candidates, trained shard by shard."""
    halves = Shards(*examples_of(found, shard))
    shards = halves.marked_by(halves.learn((0, 1)))
    net = shards.learn((FINAL,)).get(FINAL)
    if net is None:
        return None
    held = shards.held(net)
    line = _platt_of(held)
    return Model(net, *line, _threshold_of(held, *line)) if line else None


def _judge(model: Model | None):
    """Adds candidates without a base span that the model takes for secrets."""
    order = {k: i for i, k in enumerate((*KINDS, LEARNED))}
    span = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32())]))

    def run(batches):
        for b in batches:
            every = []
            for base, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                spans = list(base)
                for c in found:
                    if model is not None and c["kind"] is None and model.probability(c["before"], c["value"], c["after"]) >= model.threshold:
                        spans.append({"kind": LEARNED, "s": c["s"], "e": c["e"]})
                every.append(sorted(spans, key=lambda x: (x["s"], order[x["kind"]])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(every, span)], names=["doc_id", "base", "spans"])

    return run


def scan(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """(doc_id, base, spans): base findings, and these with the learned ones; kind, code points [s, e)."""
    found = find(docs)
    return map_arrow(found, _judge(fit(found, shard)), f"doc_id long, base array<{SPAN}>, spans array<{SPAN}>")
