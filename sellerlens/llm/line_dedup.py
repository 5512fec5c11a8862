"""Line dedup by prefix doubling over line-id sequences. Native: DataFrame functions only.

A text is the sequence of its \\n-split lines; a run is a stretch of
consecutive lines. A line is deleted when it lies in a run of at least
``min_words`` words that also occurs earlier in the corpus, in the order
(doc_id, hash of the text, line number): of equal runs the first copy stays.

* Lines get 128-bit ids. Lines found once cannot be in a repeated run; the
  others form segments, and segments with too few words are dropped.
* **Prefix doubling.** The class of a suffix's first 2**(k+1) lines comes from
  the classes of its first 2**k lines and of those 2**k further on. After each
  doubling the corpus-wide class sizes are counted and classes of one member,
  which no longer suffix can leave, are struck out. Grouping suffixes by equal
  prefixes is all that is used of the suffix array's order, so classes carry
  128-bit names instead of ranks and no global sort is needed.
* **LCP intervals.** Each suffix looks at its shortest prefix with
  ``min_words`` words, and at the shortest such run that ends with its line.
  Any qualifying run is covered by such runs, and these by two overlapping
  doubled classes. Suffixes of equal class form an interval with a common
  prefix of that length; the smallest position in it stays, the later ones'
  lines are deleted. Neighbouring deletions merge into the maximal runs.

Classes are counted by partial aggregation and met again by equi-joins, so a
line or passage with a third of all occurrences is pre-aggregated and its join
partition can be split. Windows run over one text's lines only.

Cases: rows with null doc_id or null text and texts without repeated runs stay
as they are; rows equal in doc_id and text are one document; a run that
repeats within one text loses its later copies as well (overlaps included);
a text of any length is one sequence; an empty table gives an empty result;
further columns pass through; ``n_chars``, if there, follows a changed text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sellerlens.llm.common import apart, keep_if_listed, let, materialise, packed, unpacked

MIN_WORDS = 51
WORD = "[^\\x20\\x09-\\x0D]+"
KEY = ["doc", "h"]


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def _name(*parts: Column) -> Column:
    """A 128-bit name of the parts."""
    return F.struct(F.xxhash64(*parts).alias("x"), F.xxhash64(F.lit(7), *parts).alias("y"))


def line_table(docs: DataFrame) -> DataFrame:
    """(doc, h, pos, id, w): every line with its 128-bit id and number of words."""
    return (
        docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
        .select(F.col("doc_id").alias("doc"), text_key(F.col("text")).alias("h"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .select("doc", "h", "pos", _name(F.col("line")).alias("id"), F.regexp_count("line", F.lit(WORD)).alias("w"))
    )


def segments(lines: DataFrame, min_words: int) -> DataFrame:
    """Repeated lines in segments of consecutive ones with ``min_words`` words or more.

    ``upto`` counts the segment's words up to and including the line.
    """
    twice = lines.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    met = lines.join(apart(twice), "id").dropDuplicates([*KEY, "pos"])
    seg = [*KEY, "seg"]
    return (
        met.withColumn("seg", F.col("pos") - F.row_number().over(Window.partitionBy(*KEY).orderBy("pos")))
        .withColumn("upto", F.sum("w").over(Window.partitionBy(*seg).orderBy("pos")))
        .withColumn("total", F.sum("w").over(Window.partitionBy(*seg)))
        .where(F.col("total") >= min_words).drop("total")
    )


def shortest_runs(seg: DataFrame, min_words: int) -> DataFrame:
    """(doc, h, seg, pos, n): for each line the shortest run with enough words that begins or ends there."""
    part = [*KEY, "seg"]
    before = F.col("upto") - F.col("w")
    # a run from line i ends at the first line j with upto(j) >= before(i) + min_words
    ends = seg.select(*part, F.col("upto").alias("v"), F.lit(None).cast("int").alias("i"), F.col("pos").alias("j"))
    asks = seg.select(*part, (before + min_words).alias("v"), F.col("pos").alias("i"), F.lit(None).cast("int").alias("j"))
    down = Window.partitionBy(*part).orderBy(F.desc("v"), F.desc_nulls_last("j")).rowsBetween(Window.unboundedPreceding, 0)
    begun = (
        ends.unionByName(asks).withColumn("e", F.min("j").over(down)).where("i IS NOT NULL AND e IS NOT NULL")
        .select(*part, F.col("i").alias("pos"), (F.col("e") - F.col("i") + 1).alias("n"))
    )
    # a run to line j begins at the last line i with before(i) <= upto(j) - min_words
    starts = seg.select(*part, before.alias("v"), F.col("pos").alias("i"), F.lit(None).cast("int").alias("j"))
    asks = seg.select(*part, (F.col("upto") - min_words).alias("v"), F.lit(None).cast("int").alias("i"), F.col("pos").alias("j"))
    up = Window.partitionBy(*part).orderBy(F.asc("v"), F.desc_nulls_last("i")).rowsBetween(Window.unboundedPreceding, 0)
    ended = (
        starts.unionByName(asks).withColumn("b", F.max("i").over(up)).where("j IS NOT NULL AND b IS NOT NULL")
        .select(*part, F.col("b").alias("pos"), (F.col("j") - F.col("b") + 1).alias("n"))
    )
    return begun.unionByName(ended).distinct()


def doubled_classes(seg: DataFrame, longest: int) -> DataFrame:
    """(doc, h, pos, k, id): the class of the 2**k lines from pos, for classes of two members or more."""
    order = Window.partitionBy(*KEY, "seg").orderBy("pos")
    level = seg.select(*KEY, "seg", "pos", "id")
    levels = [level.where("id IS NOT NULL").select(*KEY, "pos", F.lit(0).alias("k"), "id")]
    for k in range(int(math.log2(max(longest, 1)))):
        further = F.lead("id", 1 << k).over(order)
        level = level.withColumn("_f", further).withColumn(
            "id", F.when(F.col("id").isNotNull() & F.col("_f").isNotNull(), _name(F.col("id"), F.col("_f")))).drop("_f")
        sizes = level.where("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", F.lit(True).alias("_in"))
        level = materialise(
            level.join(apart(sizes), "id", "left").select(*KEY, "seg", "pos", F.when(F.col("_in"), F.col("id")).alias("id")))
        levels.append(level.where("id IS NOT NULL").select(*KEY, "pos", F.lit(k + 1).alias("k"), "id"))
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out


def later_runs(runs: DataFrame, names: DataFrame) -> DataFrame:
    """The runs (doc, h, pos, n) of whose LCP interval an earlier position is part."""
    k = F.floor(F.log2("n")).cast("int")
    r = runs.select(*KEY, "pos", "n", k.alias("k"))
    head = r.join(names.withColumnRenamed("id", "head"), [*KEY, "pos", "k"])
    tail = names.withColumnsRenamed({"id": "tail", "pos": "at"})
    both = head.withColumn("at", F.col("pos") + F.col("n") - F.expr("shiftleft(1, k)")).join(tail, [*KEY, "at", "k"])
    both = materialise(both.select(*KEY, "pos", "n", "head", "tail"))
    first = both.groupBy("n", "head", "tail").agg(F.min(F.struct(*KEY, "pos")).alias("first"))
    return both.join(apart(first), ["n", "head", "tail"]).where(F.struct(*KEY, "pos") > F.col("first")).select(*KEY, "pos", "n")


def deleted_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, h, spans): per document with deletions its maximal runs [s, e) of deleted lines, in order."""
    lines = materialise(line_table(docs))
    seg = materialise(segments(lines, min_words))
    runs = materialise(shortest_runs(seg, min_words))
    longest = runs.agg(F.max("n")).first()[0] or 0
    gone = later_runs(runs, doubled_classes(seg, longest))
    gone = gone.select(*KEY, F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1)).alias("pos")).distinct()
    island = F.col("pos") - F.row_number().over(Window.partitionBy(*KEY).orderBy("pos"))
    return (
        gone.withColumn("_i", island).groupBy(*KEY, "_i").agg(F.min("pos").alias("s"), (F.max("pos") + 1).alias("e"))
        .groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("spans"))
    )


def _without(text: Column, spans: Column) -> Column:
    """``text`` without its lines in the sorted ``spans``."""
    def gaps(lines: Column) -> Column:
        begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda x: x["e"]))
        ends = F.concat(F.transform(spans, lambda x: x["s"]), F.array(F.size(lines)))
        parts = F.zip_with(begins, ends, lambda b, e: F.slice(lines, b + 1, e - b))
        return F.array_join(F.flatten(parts), "\n")

    return let(F.split(text, "\n"), gaps)


def cut_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``packed`` documents with the remaining ``text`` and the ``deleted`` spans (else empty)."""
    rows = packed(docs)
    spans = materialise(deleted_spans(docs.select("doc_id", "text"), min_words))
    none = F.array().cast("array<struct<s:int,e:int>>")
    listed = keep_if_listed(rows, "doc_id", spans.select("doc"))
    cut = listed.join(spans, (listed["doc_id"] == spans["doc"]) & (text_key(listed["text"]) == spans["h"]), "left")
    cut = cut.select(
        "doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("spans"))).alias("text"),
        "row", F.coalesce("spans", none).alias("deleted"))
    rest = keep_if_listed(rows, "doc_id", spans.select("doc"), listed=False)
    return cut.unionByName(rest.withColumn("deleted", none))


def remaining(cut: DataFrame, columns: list[str]) -> DataFrame:
    """The documents' own columns after ``cut_lines``."""
    changed = {"text": F.col("text")}
    if "n_chars" in columns:
        was = F.col("row")["n_chars"]
        kind = cut.schema["row"].dataType["n_chars"].dataType
        changed["n_chars"] = F.when(F.size("deleted") > 0, F.length("text").cast(kind)).otherwise(was)
    return unpacked(cut, columns, **changed)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the later copies of repeated runs."""
    return remaining(cut_lines(docs, min_words), docs.columns)
