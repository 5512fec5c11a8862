"""Packing by bounded-space online best fit.

Each partition tokenises its documents and keeps a fixed number of open
windows. A document gives full windows of its own first; its rest goes to the
open window that it fills best. When it fits none and all windows are open,
the fullest one is emitted. What stays open at the end of a partition carries
its ids on; neighbouring partitions' leftovers (a bounded number of windows)
are merged by cutting their pieces at window borders, so that one window per
merge group is padded.

The first pass is written to the shared folder before its two readers, so a
recomputed task can never number sequences anew.

Cases: null or empty text is the closing id alone; a text of any length is
cut into as many windows as needed; repeated rows are packed once per row;
an empty table gives no pieces; columns besides (doc_id, text) are ignored.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerlens.llm.common import map_arrow, materialise, ship

WINDOW = 1024
OPEN_WINDOWS = 256
MERGE_PARTITIONS = 16
EOS = 0
CLOSED, OPEN = 0, 1

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary, state int, part int")
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
    ("state", pa.int32()), ("part", pa.int32()),
])

# Fixed value: the public byte-level BPE split pattern that goes with the vocabulary file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[str, Callable[[str], np.ndarray]] = {}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text -> uint32 ids of the ``tokenizers`` file at ``path``, without special tokens.

    A plain byte-level BPE whose ids follow its merge order is run by tiktoken,
    which gives the same ids several times faster; any other file is run by
    ``tokenizers`` itself, and so is a text on which tiktoken's pattern fails
    (a million blanks in a row exceed its stack).
    """
    if path in _encoders:
        return _encoders[path]
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    vocab, merges = model.get("vocab"), model.get("merges") or []
    plain = (
        model["type"] == "BPE" and not spec["normalizer"] and not spec["post_processor"]
        and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if plain:
        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
        plain = made == sorted(made)
    slow: list = []

    def whole(text: str) -> np.ndarray:
        if not slow:
            from tokenizers import Tokenizer

            slow.append(Tokenizer.from_file(path))
            slow[0].encode_special_tokens = True  # their strings in a text are ordinary text
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    if plain:
        import tiktoken

        # byte-level alphabet: printable Latin-1 stands for itself, the rest for code points from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}
        fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> np.ndarray:
            try:
                return fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:
                return whole(text)

        _encoders[path] = encode
    else:
        _encoders[path] = whole
    return _encoders[path]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class OpenWindows:
    """The open windows of one partition: best fit, emit the fullest when none fits."""

    def __init__(self, window: int, most: int, first_id: int):
        self.window, self.most, self.next_id = window, most, first_id
        self.by_fill: list[tuple[int, int]] = []  # (fill, sequence id), ascending
        self.pieces: dict[int, list] = {}

    def number(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, piece: tuple, size: int):
        """Put a piece (shorter than a window) down; yields (sequence id, offset, piece) of what closes."""
        k = bisect_right(self.by_fill, (self.window - size, 1 << 62)) - 1
        if k < 0:
            if len(self.by_fill) == self.most:
                yield from self.close(self.by_fill.pop())
            fill, seq = 0, self.number()
            self.pieces[seq] = []
        else:
            fill, seq = self.by_fill.pop(k)
        self.pieces[seq].append((fill, piece))
        if fill + size == self.window:
            yield from self.close((fill + size, seq))
        else:
            insort(self.by_fill, (fill + size, seq))

    def close(self, entry: tuple[int, int]):
        for offset, piece in self.pieces.pop(entry[1]):
            yield entry[1], offset, piece


def _first_pass(path: str, window: int, most: int, keep_ids: bool):
    def run(batches):
        encode = encoder(path)
        part = TaskContext.get().partitionId()
        windows = OpenWindows(window, most, part << 32)
        rows = []

        def put(seq, offset, piece, state):
            doc, start, ids, total = piece
            rows.append((doc, start, len(ids), crc(ids), total, seq, offset,
                         ids.astype("<u4").tobytes() if keep_ids or state == OPEN else None, state, part))

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
            rows.clear()
            return out

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(encode(text) if text else np.empty(0, np.uint32), np.uint32(EOS))
                total = len(ids)
                whole = total - total % window
                for start in range(0, whole, window):
                    put(windows.number(), 0, (doc, start, ids[start:start + window], total), CLOSED)
                if whole < total:
                    for seq, offset, piece in windows.place((doc, whole, ids[whole:].copy(), total), total - whole):
                        put(seq, offset, piece, CLOSED)
                if len(rows) >= 5000:
                    yield flush()
        for entry in list(windows.by_fill):
            for seq, offset, piece in windows.close(entry):
                put(seq, offset, piece, OPEN)
        if rows:
            yield flush()

    return run


def _merge(window: int, keep_ids: bool):
    def run(key, frame):
        frame = frame.sort_values(["part", "sequence_id", "offset"])
        out, seq, fill = [], (1 << 62) | (int(key[0]) << 32), 0
        for doc, start, total, part, raw in zip(frame.doc_id, frame.start, frame.doc_tokens, frame.part, frame.ids):
            ids = np.frombuffer(raw, dtype="<u4")
            while len(ids):
                cut = ids[:window - fill]
                out.append((doc, start, len(cut), crc(cut), total, seq, fill, cut.tobytes() if keep_ids else None, CLOSED, part))
                ids, start, fill = ids[len(cut):], start + len(cut), fill + len(cut)
                if fill == window:
                    seq, fill = seq + 1, 0
        done = pd.DataFrame(out, columns=_SCHEMA.names)
        done["doc_id"] = done["doc_id"].astype("Int64")
        return done

    return run


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS,
         merge_partitions: int = MERGE_PARTITIONS, keep_ids: bool = True) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids).

    ``ids`` (little-endian uint32) is null with ``keep_ids=False``.
    """
    ship(docs.sparkSession)
    first = materialise(map_arrow(docs.select("doc_id", "text"), _first_pass(tokenizer_path, window, open_windows, keep_ids), PIECES))
    left = (
        first.where(F.col("state") == OPEN)
        .groupBy(F.floor(F.col("part") / merge_partitions).cast("long").alias("block"))
        .applyInPandas(_merge(window, keep_ids), PIECES)
    )
    return first.where(F.col("state") == CLOSED).unionByName(left).drop("state", "part")


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """(sequences, tokens, pad): a sequence whose length is a power of two needs none."""
    fill = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    pad = F.when(F.bit_count("n") == 1, 0).otherwise(F.lit(window) - F.col("n"))
    return fill.agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("tokens"), F.sum(pad).alias("pad"))
