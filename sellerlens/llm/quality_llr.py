"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target
and the raw corpus. Native: DataFrame functions only.

Every word and word pair of a text falls into one of ``bins`` hash bins. Two
multinomials over the bins are counted, one over trusted documents, one over
all documents, and a pseudo-count per bin keeps rare bins near ratio one, so
that unlabelled clean documents do not suffer from words of their own. A
document's score is the mean log ratio of its n-grams (length-normalised); ``kept`` is a fixed threshold on it, after simple base
rules. Raw counts cover every document; the trusted side is fitted on at most
``max_trusted`` labelled documents (lowest id hashes), so that the id list
that marks them has a proven size.

Cases: null or wordless text has zero counts, fails the base rule and is
rejected with score 0; tables without labels give score 0 for all; rows are
judged one by one, so repeated rows repeat their result; further columns pass
through untouched (result columns of the same name are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerlens.llm.common import let, materialise

BINS = 1 << 16
MAX_TRUSTED = 20_000
THRESHOLD = -0.16
# Pseudo-counts of trusted n-grams per bin: a bin with little evidence has a ratio near one.
PRIOR = 5.0
SPACES = "[\\x20\\x09-\\x0D]+"
COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept"]


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def bins_of(hashes: Column, bins: int) -> Column:
    """Bins of all words and adjacent word pairs of a word-hash array."""
    def of(hs: Column) -> Column:
        one = F.transform(hs, lambda h: F.pmod(h, F.lit(bins)).cast("int"))
        two = F.transform(hs, lambda h, i: F.when(i > 0, F.pmod(F.xxhash64(F.get(hs, i - 1), h), F.lit(bins)).cast("int")))
        return F.concat(one, F.slice(two, 2, F.greatest(F.size(hs) - 1, F.lit(0))))

    return let(hashes, of)


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """At most ``max_trusted`` distinct ids labelled good and not toxic, lowest hash first."""
    return (
        labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted)
    )


def bin_ratios(docs: DataFrame, labels: DataFrame, bins: int = BINS, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """One row, one array of ``bins`` doubles: log(p_target / p_raw) per bin."""
    t = trusted_ids(labels, max_trusted).withColumn("_t", F.lit(1))
    d = docs.select("doc_id", word_hashes(F.col("text")).alias("_h")).join(F.broadcast(t), "doc_id", "left")
    counts = (
        d.select(F.explode(bins_of(F.col("_h"), bins)).alias("bin"), F.coalesce("_t", F.lit(0)).alias("_t"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("raw"), F.sum("_t").alias("good"))
    )
    full = docs.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(counts, "bin", "left").na.fill(0)
    row = full.agg(
        F.sort_array(F.collect_list(F.struct("bin", "raw", "good"))).alias("c"),
        F.sum("raw").alias("n_raw"), F.sum("good").alias("n_good"),
    )
    # both multinomials get the same prior mass, the raw one scaled to its size
    share = F.col("n_good") / F.col("n_raw")
    ratio = F.when(F.col("n_good") == 0, F.transform("c", lambda x: F.lit(0.0))).otherwise(
        F.transform("c", lambda x: F.log((x["good"] + F.lit(PRIOR)) / (x["raw"] * share + F.lit(PRIOR)))))
    return materialise(row.select(ratio.alias("ratio")))


def _covered(starts: Column) -> Column:
    """Words inside five-word windows that begin at the sorted ``starts``."""
    return let(starts, lambda s: F.aggregate(
        F.transform(s, lambda p, i: F.least(F.lit(5), F.coalesce(F.get(s, i + 1) - p, F.lit(5)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x,
    ))


def _repeat_words(hashes: Column) -> Column:
    """Words in five-word windows found twice or more: sort the window hashes, keep equal neighbours."""
    windows = let(hashes, lambda hs: F.when(F.size(hs) >= 5, F.transform(
        F.sequence(F.lit(0), F.size(hs) - 5),
        lambda i: F.xxhash64(*[F.get(hs, i + k) for k in range(5)]),
    )).otherwise(F.array().cast("array<bigint>")))

    def repeated(ws: Column) -> Column:
        order = F.sort_array(F.transform(ws, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(order, lambda o: let(
            F.sort_array(F.transform(
                F.filter(o, lambda x, k: (x["h"] == F.get(o, k - 1)["h"]) | (x["h"] == F.get(o, k + 1)["h"])),
                lambda x: x["i"],
            )), _covered))

    return let(windows, lambda ws: F.when(F.size(F.array_distinct(ws)) == F.size(ws), F.lit(0).cast("long")).otherwise(repeated(ws)))


def score(docs: DataFrame, ratios: DataFrame, bins: int = BINS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the base measures, ``llr``, ``base_failed`` and ``kept``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.drop(*COLUMNS).withColumns({"_w": words(F.col("text")), "_r": ratios.select("ratio").scalar()})
    base = base.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike("[^\\x20\\x09-\\x0D]"))
    total = lambda b: F.aggregate(b, F.lit(0.0), lambda acc, x: acc + F.get(F.col("_r"), x))
    mean = let(bins_of(F.col("_h"), bins), lambda b: F.when(F.size(b) == 0, F.lit(0.0)).otherwise(total(b) / F.size(b)))
    out = base.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("_h")),
        "llr": F.coalesce(mean, F.lit(0.0)),
    })
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)).drop("_w", "_h", "_r")


def quality_rules(docs: DataFrame, labels: DataFrame, bins: int = BINS, max_trusted: int = MAX_TRUSTED,
                  threshold: float = THRESHOLD) -> DataFrame:
    """Every document with its measures and verdict."""
    return score(docs, bin_ratios(docs, labels, bins, max_trusted), bins, threshold)
