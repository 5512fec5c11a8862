"""Each operator against a brute-force version or an exact round trip, and on hostile small tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from sellerlens.llm import (chat_format, common, decontaminate, jaccard_join, language_id, license_scan, line_dedup, oracles, packing,
                            pii, quality_llr, queries, url_filters)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names the operators use inside
CLASH = ", row string, deleted string, kept string, n_words int, h string, doc string, spans string, ids string, _b long"
LOREM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def words(n, seed):
    r = random.Random(seed)
    return [r.choice(LOREM) + str(r.randrange(50)) for _ in range(n)]


def frame(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", len(t) if t else 0) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def hostile(spark):
    """Null ids, texts and columns; empty, blank, repeated, very long texts; clashing extra columns."""
    long = " ".join(words(30_000, 1))
    rows = [
        (0, None), (1, ""), (2, " \n\t\n "), (3, "one two"), (4, " ".join(words(60, 2))), (5, " ".join(words(60, 2))),
        (5, " ".join(words(60, 2))), (None, "no id here but some words " * 4), (None, None), (6, long), (7, long),
        (8, "x\n" * 200), (9, "é" * 50 + " 中文 text ñ 1.2.3.4 a@b.co"), (10, "\n".join([" ".join(words(60, 3))] * 3)), (11, "!!! ### $$$"),
    ]
    full = [(*r, None if i % 3 else "en", None if i % 2 else "src", None if i % 4 == 0 else 7, "r", "d", "k", 1, "h", "dd", "sp", "i", 5)
            for i, r in enumerate(rows)]
    return spark.createDataFrame(full, DOCS + CLASH)


def labels(spark, rows=((4, 1, 0), (6, 1, 0), (8, 0, 0), (None, 1, None), (4, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


# ---------------------------------------------------------------- helpers

def test_components_match_union_find(spark):
    r = random.Random(5)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(300)] + [(1000, i) for i in range(1001, 1300)] + [(i, i + 1) for i in range(2000, 2100)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = common.connected_components(spark.createDataFrame(edges + [(None, 3), (7, 7)], "a long, b long"))
    got = {x.node: x.component for x in got.collect()}
    assert all(got.get(x, x) == find(x) for x in parent)
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_listed_rows_are_never_lost(spark):
    df = spark.range(2000).withColumn("v", F.lit(1))
    ids = spark.range(0, 2000, 7).toDF("x")
    kept = {r.id for r in common.keep_if_listed(df, "id", ids).collect()}
    rest = {r.id for r in common.keep_if_listed(df, "id", ids, listed=False).collect()}
    assert set(range(0, 2000, 7)) <= kept and kept | rest == set(range(2000)) and not kept & rest
    assert {r.id for r in common.drop_listed(df, "id", ids).collect()} == set(range(2000)) - set(range(0, 2000, 7))


# ---------------------------------------------------------------- PII

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])

    def luhn(d):
        x = [int(c) for c in reversed(d)]
        return (sum(x[::2]) + sum(sum(divmod(2 * c, 10)) for c in x[1::2])) % 10 == 0

    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m)) <= 15]


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(3)
    pieces = ["a@b.co", "x.y+z@m-1.example.com", "@", "a@b", "a@b.c@d.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.004", "1..2.3.4.5",
              "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "+1 (555) 010-9999", "+1((", "+12", "é", "\n", " ", ".", "-", "+", "%", "9" * 30,
              "_", "a", "7", "٣", "+4420 7946 0958", "b@c.de_f@g.hi"]
    for _ in range(3000):
        t = "".join(r.choice(pieces) + r.choice(["", " ", "-"]) for _ in range(r.randrange(1, 9)))
        assert pii.base_spans(t) == plain_spans(t), t
    for t in ["x" * 200_000 + " 1", "1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + "(" * 100_000, "@" * 100_000]:
        pii.candidates(t, pii.base_spans(t))  # linear time


def test_bootstrap_finds_unseen_identifiers(spark):
    around = [("is", "now"), ("was", "then")]
    seeds = [f"my mail {a} u{i}x@example.org {b}" for i in range(30) for a, b in [around[i % 2]]]
    unseen = [f"my key {a} KEY{i:04d}QZ7{i:04d} {b}" for i in range(12) for a, b in [around[i % 2]]]
    other = [f"chapter number nr{i} 20{i:06d} pages" for i in range(30)]
    out = pii.find_pii(frame(spark, seeds + unseen + other)).collect()
    found = {r.doc_id for r in out if any(x.kind == "id" for x in r.spans)}
    assert found == set(range(30, 42))
    assert all([x.kind for x in r.base] == ["email"] for r in out if r.doc_id < 30)


def plain_bootstrap(rows, turns=3, share=0.6, seen=3, least=3):
    """(accepted patterns, accepted shapes) of (pattern, shape, seed) rows, by plain counting."""
    count = collections.Counter(rows)
    known = {(s, True) for _, s, seed in rows if seed}
    for _ in range(turns):
        n, good = collections.Counter(), collections.Counter()
        for (p, s, seed), c in count.items():
            n[p] += c
            good[p] += c * ((s, seed) in known)
        fine = {p for p in n if n[p] >= seen and good[p] >= seen and good[p] >= share * n[p]}
        total, held, places = collections.Counter(), collections.Counter(), collections.Counter()
        for (p, s, seed), c in count.items():
            if seed or n[p] < seen or n[p] - c < seen:
                continue
            g = good[p] - c * ((s, False) in known)
            ok = g >= seen and g >= share * (n[p] - c)
            total[s] += c
            held[s] += c * ok
            places[s] += ok
        known = {x for x in known if x[1]} | {(s, False) for s in total if held[s] >= share * total[s] and places[s] >= least}
    return fine, {s for s, seed in known if not seed}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bootstrap_equals_plain_counting(spark, seed):
    r = random.Random(seed)
    rows = [(f"p{int(r.random() ** 2 * 12)}", r.choice(["email", "ip"]), True) for _ in range(300)]
    rows += [(f"p{int(r.random() ** r.choice((1, 2)) * 16)}", f"s{r.randrange(5)}", False) for _ in range(150)]
    rows += [("key", "s1", False)] * 40
    patterns, shapes = pii.bootstrap(spark.createDataFrame(rows, "pattern string, shape string, seed boolean"))
    assert ({x.pattern for x in patterns.collect()}, {x[0] for x in shapes.collect()}) == plain_bootstrap(rows)


def test_tokens_behind_a_keyword_are_found_by_the_other_side(spark):
    r = random.Random(4)
    after = ["and", "the", "of", "with", "into"]
    key = lambda: "".join(r.choices("0123456789abcdef", k=40))
    seeds = [f"word{i} mail u{i}@example.org {after[i % 5]} so" for i in range(60)]
    tokens = [f'x{i} token = "{key()}" {after[i % 5]} so' for i in range(20)] + [f'X TOKEN = "{key().upper()}"!! {after[i]} so' for i in range(5)]
    out = pii.find_pii(frame(spark, seeds + tokens)).collect()
    assert {x.doc_id: x.spans[0].e - x.spans[0].s for x in out if x.doc_id >= 60} == dict.fromkeys(range(60, 85), 40)
    assert all([s.kind for s in x.spans] == ["email"] for x in out if x.doc_id < 60)


def test_pii_on_hostile_rows(spark, hostile):
    out = pii.find_pii(hostile).collect()
    assert len(out) == hostile.count()
    assert {(x.kind, x.s, x.e) for r in out if r.doc_id == 9 for x in r.base} == set(plain_spans("é" * 50 + " 中文 text ñ 1.2.3.4 a@b.co"))
    assert pii.find_pii(hostile.limit(0)).count() == 0


# ---------------------------------------------------------------- Jaccard join

def brute_components(rows):
    """doc_id -> smallest reachable id, by all pairs."""
    sets = {}
    for d, t in rows:
        w = [x for x in re.split("[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                u, v = find(a), find(b)
                parent[max(u, v)] = min(u, v)
    return {d: (len(sets[d]), find(d)) for d in sets}


def near_copies(seed, groups=12, per=14):
    """Families of edited copies around the threshold, over many sizes, with a shared boilerplate."""
    r = random.Random(seed)
    shared = words(25, 99)
    texts = []
    for g in range(groups):
        base = words(r.choice([1, 3, 4, 5, 6, 9, 14, 30, 60, 120, 300]), 1000 * seed + g)
        if g % 3 == 0:
            base = shared + base
        for _ in range(per):
            t = list(base)
            for _ in range(r.randrange(0, 1 + max(1, len(t) // 18))):
                t[r.randrange(len(t))] = f"w{r.randrange(10**6)}"
            texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_all_pairs(spark, seed):
    texts = near_copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(frame(spark, texts)).collect()}
    assert got == brute_components(list(enumerate(texts)))


def test_signatures_never_miss_a_linked_pair():
    """The prefix principle with all signatures unordered: linked sets share one of their signatures."""
    r = np.random.default_rng(4)
    for n in [*range(1, 40), 64, 100, 127, 128, 200, 333]:
        for _ in range(12):
            a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
            drop = int(r.integers(0, max(1, n // 8) + 1))
            b = np.unique(np.concatenate((a[drop:], r.integers(0, 2**63, int(r.integers(0, max(1, n // 8) + 1))).astype(np.uint64))))
            if len(b) and jaccard_join.linked(a, b):
                x, y = (set(np.concatenate([g for g, _, _ in jaccard_join.signatures(s)]).tolist()) for s in (a, b))
                assert x & y


def test_leftover_blocks_find_the_rest(spark, monkeypatch):
    """With star rounds that never pay and tiny blocks the block test alone completes the components."""
    monkeypatch.setattr(jaccard_join, "STAR_YIELD", 2.0)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 300)
    texts = near_copies(7, groups=6, per=20)
    got = {r.doc_id: r.component_id for r in jaccard_join.components(frame(spark, texts)).collect()}
    assert got == {d: c for d, (_, c) in brute_components(list(enumerate(texts))).items()}


def test_jaccard_on_hostile_rows(spark, hostile):
    out = jaccard_join.components(hostile).collect()
    assert len(out) == hostile.count()
    by = {r.doc_id: r for r in out}
    assert by[0].n_shingles == by[1].n_shingles == by[2].n_shingles == 0 and by[2].component_id == 2
    assert by[5].component_id == 4 and by[7].component_id == 6 and by[3].n_shingles == 1
    assert all(r.component_id is None for r in out if r.doc_id is None)
    assert jaccard_join.components(hostile.limit(0)).count() == 0


# ---------------------------------------------------------------- licences

def test_license_base_places(spark):
    r = random.Random(2)
    vocab = ["mit", "license", "apache", "general", "public", "the", "x"]
    texts = [" ".join(r.choice(vocab) for _ in range(r.randrange(0, 60))) for _ in range(120)] + ["MIT-License, Apache.License", None, ""]
    out = {x.doc_id: x for x in license_scan.scan(frame(spark, texts)).collect()}
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    for i, t in enumerate(texts):
        w = [x for x in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").lower()) if x]
        at = [(k, s) for k, p in phrases.items() for s in range(len(w)) if w[s:s + len(p)] == p]
        got = out[i]
        assert (got.n_words, got.n_base) == (len(w), len(at))
        assert (got.first_word, got.last_word) == (min((s for _, s in at), default=None), max((s for _, s in at), default=None))
        assert got.base_labels == sorted({k for k, _ in at}) and set(got.base_labels) <= set(got.labels) and 0 <= got.score <= 1


def test_license_labels_and_hostile_rows(spark, hostile):
    out = license_scan.scan(frame(spark, ["Licensed under CC BY-NC 4.0.", "All rights reserved.", "plain text"])).orderBy("doc_id").collect()
    assert [r.labels for r in out] == [["cc-by-nc"], ["reserved"], []] and out[0].score == pytest.approx(1.0)
    assert license_scan.scan(hostile).count() == hostile.count()
    assert license_scan.scan(hostile.limit(0)).count() == 0


def plain_license_places(words, templates, df, n_docs):
    """(template, start, score) by trying every key phrase at every word."""
    out = []
    idf = lambda w: np.log((n_docs + 1) / (df.get(w, 0) + 1)) + 1e-9
    for t, template in enumerate(templates):
        notice, key = template.notice.split(), template.key.split()
        shift = next(i for i in range(len(notice)) if notice[i:i + len(key)] == key)
        by_rarity = sorted(range(len(notice)), key=lambda i: (df.get(notice[i], 0), i))
        posted = set(by_rarity[:license_scan.RARE]) | set([i for i in by_rarity if shift <= i < shift + len(key)][:2])
        for p in range(len(words)):
            if words[p:p + len(key)] == key:
                near = {i: [words[q] for q in range(p - shift + i - license_scan.SLACK, p - shift + i + license_scan.SLACK + 1) if 0 <= q < len(words)] for i in posted}
                out.append((t, p, sum(idf(notice[i]) for i in posted if notice[i] in near[i]) / sum(idf(notice[i]) for i in posted)))
    return sorted(out, key=lambda x: (x[1], x[0]))


def test_license_places_and_scores_equal_brute_force(spark):
    r = random.Random(5)
    pool = [w for t in license_scan.TEMPLATES for w in t.notice.split()]
    texts = []
    for _ in range(150):
        words = [r.choice(pool) for _ in range(r.randrange(0, 30))]
        for t in r.sample(license_scan.TEMPLATES, r.randrange(0, 4)):  # whole notices, some with words lost, gained or changed
            notice = t.notice.split()
            for _ in range(r.randrange(0, 5)):
                at = r.randrange(len(notice))
                notice[at:at + r.randrange(0, 2)] = [r.choice(pool)] * r.randrange(0, 3)
                notice = notice or ["x"]
            words += notice + [r.choice(pool) for _ in range(r.randrange(0, 9))]
        texts.append(" ".join(words))
    words = [t.split() for t in texts]
    df = collections.Counter(w for ws in words for w in set(ws))
    got = {x.doc_id: x for x in license_scan.scan(frame(spark, texts)).collect()}
    n_places = 0
    for i, ws in enumerate(words):
        want = plain_license_places(ws, license_scan.TEMPLATES, df, len(texts))
        n_places += len(want)
        assert [(p.template, p.word) for p in got[i].places] == [w[:2] for w in want]
        assert np.allclose([p.score for p in got[i].places], [w[2] for w in want])
        assert got[i].labels == sorted({license_scan.TEMPLATES[t].label for t, _, _ in want})
    assert n_places > 100


def test_license_altered_notices(spark):
    """Words gained and lost outside the key phrase cost their share only; inside it, the template is not found."""
    t = next(t for t in license_scan.TEMPLATES if t.label == "bsd-3-clause")
    owner = t.notice.replace("the copyright holder", "Example Widgets of Nowhere Ltd")
    out = license_scan.scan(frame(spark, [t.notice, owner, t.notice.replace("may be used", "must not be used"), t.key])).orderBy("doc_id").collect()
    assert [r.labels for r in out] == [["bsd-3-clause"], ["bsd-3-clause"], [], ["bsd-3-clause"]]
    assert out[0].score == pytest.approx(1.0) and out[0].score > out[1].score > out[3].score > 0 == out[2].score
    with pytest.raises(ValueError):
        license_scan.Index([license_scan.Template("x", "some notice", "other words")], {}, 1)


# ---------------------------------------------------------------- decontamination

def alnum(t):
    return [x for x in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]


def brute_hits(text, bench):
    w, hit, found = alnum(text), set(), set()
    for item, t in bench:
        x = alnum(t)
        size = min(13, len(x))
        for a in range(len(x) - size + 1) if x else []:
            for s in range(len(w) - size + 1):
                if w[s:s + size] == x[a:a + size]:
                    hit.update(range(s, s + size))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("shard_words", [500_000, 40])
def test_hits_equal_brute_force(spark, shard_words):
    r = random.Random(8)
    small = ["a", "b", "c"]
    bench = [" ".join(r.choice(small) for _ in range(r.choice([0, 1, 3, 12, 13, 14, 25]))) for _ in range(9)] + [None, " ".join(words(30, 5)), " ".join(words(30, 5))]
    texts = [" ".join(r.choice([*small, "zz", "Q-q"]) for _ in range(r.randrange(0, 120))) for _ in range(40)]
    texts += [" ".join(words(40, 6) + words(30, 5)[7:27] + words(300, 7)), " ".join(words(30, 5)[:12]), None]
    bench = [b for b in bench if b is None or len(b.split()) != 1]
    out = decontaminate.measure(frame(spark, texts), items(spark, bench), shard_words=shard_words).collect()
    assert len(out) == len(texts)
    for x in out:
        assert (x.n_words, x.n_hit, sorted(x["items"])) == brute_hits(texts[x.doc_id], list(enumerate(bench)))
        assert x.contaminated == (x.n_hit > 0 and 20 * x.n_hit >= x.n_words)


def test_removed_spans_leave_clean_texts(spark, hostile):
    item = words(20, 5)
    texts = [" ".join(words(200, 1) + item + words(100, 2)), " ".join(item), " ".join(words(300, 3)), " ".join(words(900, 4) + item), None]
    bench = items(spark, [" ".join(item)])
    out = {r.doc_id: r for r in decontaminate.remove_spans(frame(spark, texts), bench).collect()}
    assert alnum(out[0].text) == alnum(" ".join(words(200, 1) + words(100, 2))) and out[0].n_chars == len(out[0].text)
    assert 1 not in out and out[2].text == texts[2] and out[3].text == texts[3] and out[4].text is None
    same = decontaminate.remove_spans(hostile, bench)
    assert same.columns == hostile.columns and same.exceptAll(hostile).count() == 0 and same.count() == hostile.count()
    assert decontaminate.measure(hostile, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.measure(hostile.limit(0), bench).count() == 0


def test_removed_spans_do_not_depend_on_shards(spark, hostile):
    a, b, c, d = (words(20, i) for i in (21, 22, 23, 24))
    join = lambda *parts: " ".join(w for p in parts for w in p)
    bench = items(spark, [" ".join(x) for x in (a, b, c, d)] + [None])
    texts = [
        join(words(300, 31), a, words(300, 32), b, words(30, 33)),  # 3 % from each of two shards
        join(words(10, 34), a, words(8, 35), b, words(8, 36)),  # over half only together
        join(words(100, 37), a, b, words(100, 38)),  # touching spans of two shards
        join(words(80, 39), c[:10], d, c[10:], words(80, 40)),  # the cut makes a new window
        join(words(900, 41), a), join(words(60, 42)), join(a, b), None, "",
    ]
    docs = frame(spark, texts).unionByName(frame(spark, texts[:3])).unionByName(frame(spark, texts).withColumn("doc_id", F.lit(None).cast("long")))
    assert sum(1 for _ in decontaminate.shards(bench, 40)) > 1
    for table in (docs, hostile):
        one, many = decontaminate.remove_spans(table, bench), decontaminate.remove_spans(table, bench, shard_words=40)
        assert many.columns == one.columns and many.exceptAll(one).count() == 0 and one.exceptAll(many).count() == 0
    out = {r.doc_id: r.text for r in decontaminate.remove_spans(frame(spark, texts), bench, shard_words=40).collect()}
    assert alnum(out[0]) == words(300, 31) + words(300, 32) + words(30, 33)
    assert alnum(out[3]) == words(80, 39) + words(80, 40)
    assert set(out) == {0, 2, 3, 4, 5, 7, 8}


def test_items_longer_than_a_shard_are_read_in_pieces(spark):
    long = words(200, 50)
    bench = items(spark, [" ".join(long), " ".join(words(25, 51)), "one", None, ""])
    read = list(decontaminate.shards(bench, 60))
    assert len(read) > 3 and all(sum(len(t.split()) for _, t in shard) <= 60 for shard in read)
    texts = [" ".join(long[a:a + 14]) + " x " + " ".join(words(9, a)) for a in range(0, 186, 7)]
    for row in decontaminate.measure(frame(spark, texts), bench, shard_words=60).collect():
        assert (row.n_words, row.n_hit, sorted(row["items"])) == brute_hits(texts[row.doc_id], [(0, " ".join(long)), (1, " ".join(words(25, 51))), (2, "one")])


def test_measured_rows_do_not_depend_on_shards(spark, hostile):
    a, b = words(20, 21), words(20, 22)
    rows = [(1, " ".join(words(60, 31) + a)), (1, " ".join(words(60, 31) + a)), (1, " ".join(words(60, 32) + b + a)),
            (None, " ".join(words(60, 33) + b)), (None, " ".join(words(90, 34))), (None, None), (2, None), (2, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    bench = items(spark, [" ".join(a), " ".join(b), " ".join(words(30, 1)[:20]), " ".join(words(60, 2)[9:40])])
    for table in (docs, hostile):
        one, many = decontaminate.measure(table, bench), decontaminate.measure(table, bench, shard_words=40)
        assert many.columns == one.columns and many.count() == table.count()
        assert many.exceptAll(one).count() == 0 and one.exceptAll(many).count() == 0


# ---------------------------------------------------------------- line dedup

def brute_deleted(rows, min_words):
    """doc_id -> deleted line numbers, by extending every earlier equal line."""
    rows = sorted((d, t.split("\n")) for d, t in rows)
    first, gone = collections.defaultdict(list), {}
    for n, (d, lines) in enumerate(rows):
        gone[d] = set()
        for p, line in enumerate(lines):
            best = 0
            for m, q in first[line]:
                other, k = rows[m][1], 0
                while p + k < len(lines) and q + k < len(other) and lines[p + k] == other[q + k]:
                    k += 1
                best = max(best, k)
            if best and sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines[p:p + best]) >= min_words:
                gone[d].update(range(p, p + best))
            first[line].append((n, p))
    return gone


@pytest.mark.parametrize("min_words", [1, 6, 15])
def test_deleted_lines_equal_brute_force(spark, min_words):
    r = random.Random(min_words)
    pool = ["", "a", "b c", "d e f", "g h i j", "k l m n o p"]
    texts = ["\n".join(r.choice(pool) if r.random() < 0.8 else f"own {r.randrange(10**6)}" for _ in range(r.randrange(1, 40))) for _ in range(60)]
    texts += ["a\n" * 50, "b c\na\n" * 30, texts[3]]
    want = brute_deleted(list(enumerate(texts)), min_words)
    out = line_dedup.cut_lines(frame(spark, texts), min_words).collect()
    for x in out:
        assert {i for s in x.deleted for i in range(s.s, s.e)} == want[x.doc_id]
        assert x.text == "\n".join(v for i, v in enumerate(texts[x.doc_id].split("\n")) if i not in want[x.doc_id])


def test_line_dedup_on_hostile_rows(spark, hostile):
    out = line_dedup.dedup_lines(hostile)
    assert out.columns == hostile.columns and out.count() == hostile.count()
    by = collections.defaultdict(list)
    for r in out.collect():
        by[r.doc_id].append(r)
    assert by[0][0].text is None and by[1][0].text == "" and by[7][0].text == "" and by[6][0].text
    assert [r.text for r in by[5]] == ["", ""] and by[4][0].text and "\n" not in by[10][0].text
    assert line_dedup.dedup_lines(hostile.limit(0)).count() == 0


# ---------------------------------------------------------------- language id

def test_language_held_out_accuracy(spark):
    r = random.Random(1)
    syllables = {"en": ["the", "ing", "and", "th", "er"], "de": ["der", "ung", "sch", "ei", "ü"], "fr": ["le", "eau", "tion", "é", "ou"]}
    rows = []
    for i in range(600):
        lang = "en" if i % 2 else r.choice(["de", "fr"])
        rows.append((i, " ".join("".join(r.choice(syllables[lang]) for _ in range(3)) for _ in range(15)), lang if i % 7 else None, i % 4 != 0, lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, train boolean, truth string")
    out = language_id.identify(df, dims=1 << 12).join(df.select("doc_id", "truth"), "doc_id").where("NOT train")
    good, mean, lo, hi = out.agg(F.avg((F.col("lang_pred") == F.col("truth")).cast("int")), F.avg("score"), F.min("score"), F.max("score")).first()
    assert good > 0.97 and 0 <= lo and hi <= 1 and mean > 0.8


def test_language_learns_from_training_rows_only(spark):
    rows = [(i, "aaa bbb" if i % 2 else "ccc ddd", "x" if i % 2 else "y", i < 20) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, train boolean")
    a = language_id.identify(df, dims=256).orderBy("doc_id").collect()
    lied = df.withColumn("lang", F.when(F.col("train"), F.col("lang")).otherwise("z"))
    assert a == language_id.identify(lied, dims=256).orderBy("doc_id").collect()


def plain_language_model(rows, dims, epochs=language_id.EPOCHS):
    """Text -> probability of every language, by dictionaries: n-gram counts, IDF, FTRL one coordinate at a time."""
    mask, a, b, c = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9

    def grams(text):
        t = [ord(x) + 1 for x in f" {text.lower()} "]
        out = collections.Counter()
        for n in (1, 2, 3):
            for i in range(len(t) - n + 1):
                h = sum(x * m for x, m in zip(t[i:i + n], (a, b, c))) & mask
                out[((h ^ (h >> 29)) * b & mask) >> (64 - (dims - 1).bit_length())] += 1
        return out

    seen = collections.Counter()
    for _, text, _ in rows:
        seen.update(set(grams(text)))
    classes = sorted({lang for _, _, lang in rows})
    idf = lambda g: math.log((len(rows) + 1) / (seen[g] + 1)) + 1.0

    def weigh(text):
        x = {g: math.log(1 + n) * idf(g) for g, n in grams(text).items()}
        size = math.sqrt(sum(v * v for v in x.values()))
        return {g: v / size for g, v in x.items()}

    def rank(doc_id):  # Spark's xxhash64 of a long, its low 30 bits
        return xxhash.xxh64(doc_id.to_bytes(8, "little", signed=True), seed=42).intdigest() % (1 << 30), doc_id

    order = []
    for lang in classes:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: rank(r[0]))
        order += [(i, classes.index(lang), weigh(text)) for i, (_, text, _) in enumerate(mine, 1)]
    order.sort(key=lambda o: o[:2])
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(g, k):
        v = z[g, k]
        if abs(v) <= language_id.L1:
            return 0.0
        return -(v - math.copysign(language_id.L1, v)) / ((language_id.BETA + math.sqrt(n[g, k])) / language_id.ALPHA + language_id.L2)

    def scores(x):
        return [sum(v * weight(g, k) for g, v in x.items()) for k in range(len(classes))]

    def soft(s):
        e = [math.exp(v - max(s)) for v in s]
        return [v / sum(e) for v in e]

    for _ in range(epochs):
        for i, y, x in order:
            if i % 5 == 0:
                continue
            p = soft(scores(x))
            step = {(g, k): (v * (p[k] - (k == y)), weight(g, k)) for g, v in x.items() for k in range(len(classes))}
            for at, (d, w) in step.items():
                z[at] += d - (math.sqrt(n[at] + d * d) - math.sqrt(n[at])) / language_id.ALPHA * w
                n[at] += d * d
    held = [(scores(x), y) for i, y, x in order if i % 5 == 0]
    loss = lambda t: -sum(math.log(soft([v / t for v in s])[y] + 1e-12) for s, y in held) / len(held)
    t = min((math.exp(math.log(0.05) + i * math.log(400) / 4000) for i in range(4001)), key=loss)
    return lambda text: dict(zip(classes, soft([v / t for v in scores(weigh(text))])))


def test_language_equals_plain_model(spark):
    r = random.Random(12)
    parts = {"en": ["the", "of", "tion", "ing", "rea"], "de": ["der", "sch", "und", "ein", "rea"], "fr": ["les", "que", "eau", "ê", "rea"]}
    rows = [(i, " ".join(r.choice(parts[r.choice(["en", "de", "fr"])] if r.random() < 0.35 else parts[lang]) for _ in range(r.randrange(2, 9))), lang, i % 4 != 2)
            for i, lang in ((i, r.choice(list(parts))) for i in range(120))]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, train boolean"), dims=512).collect()
    predict = plain_language_model([x[:3] for x in rows if x[3]], 512)
    assert len(got) == len(rows) and len({g.lang_pred for g in got}) == 3
    for g in got:
        p = predict(rows[g.doc_id][1])
        assert g.lang_pred == max(p, key=p.get) and abs(g.score - max(p.values())) < 5e-3


def test_language_on_hostile_rows(spark, hostile):
    df = hostile.withColumn("train", F.lit(True))
    out = {r.doc_id: r for r in language_id.identify(df, dims=256).collect()}
    assert out[0].lang_pred == out[1].lang_pred == out[11].lang_pred == "und" and out[3].lang_pred == "en"
    nobody = language_id.identify(hostile.withColumn("train", F.lit(False)), dims=256)
    assert nobody.where("lang_pred <> 'und'").count() == 0
    assert language_id.identify(df.limit(0), dims=256).count() == 0


def test_temperature_lowers_log_loss():
    r = np.random.default_rng(0)
    y = r.integers(0, 3, 400)
    s = 20 * (np.eye(3)[y] + r.normal(0, 0.7, (400, 3)))
    t = language_id.temperature(s, y)
    loss = lambda k: -np.log(language_id.softmax(s / k)[np.arange(400), y] + 1e-12).mean()
    assert t > 1 and loss(t) < loss(1.0)


# ---------------------------------------------------------------- packing

def test_packing_round_trip(spark, hostile):
    path = public_tokenizers.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    texts = [" ".join(words(n, n)) for n in (1, 5, 200, 900, 3000, 40, 41, 42, 700)] + [None, "", "naïve 中文 \r\n\t  don't"]
    for df in (frame(spark, texts).repartition(3), hostile.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        rows = packing.pack(df, path, open_windows=2).collect()
        want = {r.doc_id: [*tok.encode(r.text or "", add_special_tokens=False).ids, 0] for r in df.collect()}
        got, seqs = collections.defaultdict(dict), collections.defaultdict(list)
        for r in rows:
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert len(ids) == r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32 and r.doc_tokens == len(want[r.doc_id])
            got[r.doc_id][r.start] = ids
            seqs[r.sequence_id].append((r.offset, r.length))
        assert {d: sum((p[s] for s in sorted(p)), []) for d, p in got.items()} == want
        for parts in seqs.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= 1024


def test_packing_leaves_little_padding(spark, hostile):
    df = frame(spark, [" ".join(words(20 + 7 * (i % 90), i)) for i in range(600)]).repartition(4)
    r = packing.padding(packing.pack(df, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)).first()
    assert r.pad <= 0.02 * r.tokens
    assert packing.pack(hostile, public_tokenizers.path("byte_bpe_50k.json")).where("doc_id IS NULL").count() >= 2
    assert packing.pack(hostile.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_encoder_equals_tokenizers():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, fast = Tokenizer.from_file(path), packing.encoder(path)
    r = random.Random(0)
    alphabet = "abcdefgh  \n\t'.,!?0123456789éüß中文😀\r\x85\u00a0´’s"
    for _ in range(400):
        t = "".join(r.choice(alphabet) for _ in range(r.randrange(0, 300)))
        assert fast(t).tolist() == tok.encode(t, add_special_tokens=False).ids
    for c in " \na7é!":  # runs that exceed the fast pattern's stack too
        t = f"begin {c * 2_000_000} end"
        assert (fast(t) == np.array(tok.encode(t, add_special_tokens=False).ids, dtype=np.uint32)).all()


# ---------------------------------------------------------------- url filters

def plain_verdict(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for h, p, v in url_filters.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, *(best or (None, None))


def test_urls_rules_and_aliases(spark):
    link = '<html><link href="{}" rel="canonical"></html>'
    pages = [
        (0, "http://WWW.Example.com/en/1?x#y", None), (1, "https://m.example.com/en/2", ""), (2, "http://a.net/es/", None), (3, "http://a.net", None),
        (4, "no url", None), (5, None, None), (6, "http://notexample.com/en/1", None), (7, "http://anet/es/1", None), (8, "x://com/?://net/es/", None),
        (9, "http://one.org/a", link.format("http://b.net/es/q")), (10, "http://two.org/b", link.format("//one.org/a")),
        (11, "http://three.org/c", "<META content='0; URL=http://two.org/b' http-equiv=\"Refresh\">"),
        (12, "http://four.org/d", link.format("http://c.net/es/z")), (13, "http://four.org/e", link.format("http://four.org/d")),
        (14, "http://five.com/ok", link.format("http://four.org/e")), (15, "http://six.org/f?utm_source=q", None), (16, "https://six.org/f/", None),
        (16, "https://six.org/f/", None), (17, "http://six.org/g", link.format("http://d.net/fr/z")), (18, "https://www.six.org/g/index.html", None),
    ]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, verdict int")
    out = url_filters.filter_urls(df, url_filters.rule_table(spark)).collect()
    assert len(out) == len(pages)
    for r in out:
        host, path, rule, verdict = plain_verdict(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert verdict is None or r.verdict == verdict
    v = {r.page_id: (r.verdict, r.decided_by) for r in out}
    assert v[9] == v[10] == v[11] == ("block", "alias")  # the block runs back over the chain
    assert v[12] == v[13] == ("allow", "alias")  # the allowed page of the component takes precedence
    assert v[14] == ("allow", "rule") and v[15] == v[16] == ("allow", "default") and v[17] == v[18] == ("block", "alias")
    assert v[4] == v[5] == ("allow", "default")
    assert url_filters.filter_urls(df.limit(0), url_filters.rule_table(spark)).count() == 0


def test_urls_equal_recursive_closure(spark, tmp_path):
    """Random chains of links, redirects and rules against the SQL closure."""
    r = random.Random(4)
    hosts = ["a.net", "www.b.net", "m.c.org", "c.org", "d.com", "www.d.com", "www.Example.com", "x.example.com", "e.org", "www.f.org", "f.org"]
    spot = lambda: r.choice(hosts) + r.choice(["", "/", "/en/", "/es/1", "/fr/2.html", "/fr/2", "/q/index.html", "/q"])
    urls = [r.choice(["http://", "https://"]) + spot() + r.choice(["", "?ref=1", "?id=2&utm_source=x", "#z"]) for _ in range(90)] + ["none", None, "://", ""]
    forms = ["<link rel=canonical href={}>", '<LINK href="{}" rel="canonical">', "<link rel='canonical' href='{}'/>",
             '<meta http-equiv="refresh" content="3; url={}">', "<a href='{}'>"]
    targets = lambda: r.choice([r.choice(urls[:90]), "//" + spot(), "/es/1", "side", "mailto:a@b", "#top", "", "/q?a=1&amp;b=2"])
    pages = [(i, u, r.choice([None, "", *(r.choice(forms).format(targets()) for _ in range(4))])) for i, u in enumerate(urls)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(map(tuple, queries.QUERIES["op8_url_filters"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert got == sorted(con.execute(oracles.ORACLES["op8_url_filters"]).fetchall())
    assert {v[4:] for v in got} >= {("block", "alias"), ("allow", "alias"), ("block", "rule"), ("allow", "default")}


# ---------------------------------------------------------------- chats

def test_chat_template_round_trip():
    r = random.Random(6)
    bits = [*chat_format.CONTROLS, "\\", "\\\\", "<", "[", "/INST]", "s>", "user", "\n", "A", "B", "é", ""]
    for _ in range(500):
        turns = [(r.choice(["user", "assistant", "system", "", "</s>"]), "".join(r.choice(bits) for _ in range(r.randrange(0, 8)))) for _ in range(r.randrange(1, 6))]
        out, rewrites, spans = chat_format.locate(turns, chat_format.inst_template)
        assert not rewrites and chat_format.parse(out) == turns
        assert [chat_format.unescape(out[s:e]) for s, e in spans] == [t for _, t in turns]


def test_rewriting_templates_are_detected():
    def only_last_reasoning(turns):  # keeps <think> parts in the last turn alone
        return "".join(f"<{r}>{t if i == len(turns) - 1 else re.sub('<think>.*</think>', '', t)}</{r}>" for i, (r, t) in enumerate(turns))

    assert chat_format.locate([("user", "q"), ("assistant", "<think>x</think>a"), ("user", "r")], only_last_reasoning)[1]
    assert not chat_format.locate([("user", "q"), ("assistant", "a")], only_last_reasoning)[1]


def test_long_conversations_are_compared_at_every_prefix():
    r = random.Random(3)
    turns = [(r.choice(["user", "assistant", "system"]), " ".join(words(r.randrange(0, 12), i))) for i in range(90)]
    for every in (1, 7):
        out, rewrites, spans = chat_format.locate(turns, chat_format.inst_template, every)
        assert not rewrites and out == chat_format.inst_template(turns)
        assert [chat_format.unescape(out[s:e]) for s, e in spans] == [t for _, t in turns]

    def numbered(ts):
        return "".join(f"<{i}>{t}</{i}>" for i, (_, t) in enumerate(ts))

    out, rewrites, spans = chat_format.locate(turns, numbered)
    assert not rewrites and [out[s:e] for s, e in spans] == [t for _, t in turns]

    def only_last_full(ts):  # history is shortened
        return "".join(f"<{t if i == len(ts) - 1 else t[:3]}>" for i, (_, t) in enumerate(ts))

    assert chat_format.locate(turns, only_last_full)[1:] == (True, [])

    def compacting(ts):  # only at every 20th turn
        return f"<{len(ts)} turns>" if len(ts) % 20 == 0 else "".join(f"<{t}>" for _, t in ts)

    assert not chat_format.locate(turns[:19], compacting)[1]
    assert all(chat_format.locate(turns[:n], compacting)[1:] == (True, []) for n in (20, 21, 50, 90))


def test_text_dependent_surroundings():
    turns = [("user", "x" * n) for n in (120, 0, 1, 11, 2)]
    with_length = lambda ts: "".join(f"{t}|{len(t)};" for _, t in ts)
    out, rewrites, spans = chat_format.locate([t for t in turns if t[1]], with_length)
    assert not rewrites and [out[s:e] for s, e in spans] == [t for _, t in turns if t]
    checked = lambda ts: "".join(f"{t}|{zlib.crc32(t.encode())};" for _, t in ts)
    assert chat_format.locate(turns, checked)[1:] == (True, [])
    short = lambda ts: "".join(f"{t[:50]};" for _, t in ts)
    assert chat_format.locate(turns, short)[1:] == (True, [])


def test_chats_equal_plain_digest(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (2, None, "assistant", "first"), (None, 3, "user", "n"), (1, 2, "assistant", "c"), (1, 2, "assistant", "c")]
    df = spark.createDataFrame([(*x, "z") for x in rows], "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in chat_format.format_chats(df).collect()}
    assert chat_format.parse(out[1].formatted) == [("user", "a"), ("assistant", "b"), ("assistant", "c"), ("assistant", "c")]
    assert chat_format.parse(out[2].formatted) == [("assistant", "first"), ("", "")] and len(out) == 3
    assert [out[1].formatted[x.s:x.e] for x in out[1].spans if x.loss] == ["b", "c", "c"]
    assert chat_format.format_chats(df.limit(0)).count() == 0


# ---------------------------------------------------------------- quality

def xxh(data, seed=42):
    v = xxhash.xxh64_intdigest(data if isinstance(data, bytes) else int(data).to_bytes(8, "little", signed=True), seed=seed % (1 << 64))
    return v - (1 << 64) if v >= 1 << 63 else v


def brute_quality(rows, trusted, bins):
    grams = {}
    for i, (d, t) in enumerate(rows):
        h = [xxh(w.encode()) for w in re.split("[\x20\x09-\x0D]+", t or "") if w]
        grams[i] = [x % bins for x in h] + [xxh(b, xxh(a)) % bins for a, b in zip(h, h[1:])]
    raw, good = collections.Counter(), collections.Counter()
    for i, g in grams.items():
        raw.update(g)
        if rows[i][0] in trusted:
            good.update(g)
    share = sum(good.values()) / max(1, sum(raw.values()))
    k = quality_llr.PRIOR
    ratio = lambda b: math.log((good[b] + k) / (raw[b] * share + k)) if share else 0.0
    return {i: sum(map(ratio, g)) / len(g) if g else 0.0 for i, g in grams.items()}


def brute_base(t):
    t = t or ""
    w = [x for x in re.split("[\x20\x09-\x0D]+", t) if x]
    seen = collections.defaultdict(list)
    for i in range(len(w) - 4):
        seen[tuple(w[i:i + 5])].append(i)
    rep = {p + k for v in seen.values() if len(v) > 1 for p in v for k in range(5)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep)


def test_quality_equals_brute_force(spark, hostile):
    texts = [" ".join(words(n, n)) for n in (3, 12, 80, 300)] + ["a b c d e " * 20, "x y z\n\nx y z\n \nx y z", "### | <b> 100% &", None, "", "é ü " * 30]
    texts += ["p q r s t " + " ".join(words(100, 4)) + " p q r s t u p q r s t"]
    df = frame(spark, texts)
    lab = labels(spark, [(2, 1, 0), (3, 1, None), (4, 0, 0), (9, 1, 1)])
    bins = 128
    want = brute_quality(list(enumerate(texts)), {2, 3}, bins)
    out = quality_llr.quality_rules(df, lab, bins=bins).collect()
    assert len(out) == len(texts)
    for r in out:
        base = brute_base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.llr == pytest.approx(want[r.doc_id], abs=1e-9)
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        assert r.base_failed == failed and r.kept == (not failed and r.llr >= quality_llr.THRESHOLD)


def test_quality_on_hostile_rows(spark, hostile):
    out = quality_llr.quality_rules(hostile, labels(spark), bins=64)
    assert out.count() == hostile.count() and out.where("kept IS NULL OR llr IS NULL").count() == 0
    assert quality_llr.quality_rules(hostile, labels(spark).limit(0), bins=64).where("llr <> 0").count() == 0
    assert quality_llr.quality_rules(hostile.limit(0), labels(spark), bins=64).count() == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages_against_brute_force(spark, tmp_path):
    noise = random.Random(9)
    junk = [" ".join(noise.choice(LOREM) + "%%%" for _ in range(300)) for _ in range(8)]
    good = [" ".join(words(120, i)) for i in range(40)]
    item = " ".join(words(20, 500))
    passage = " ".join(words(55, 501))
    edited = " ".join(["new", *words(120, 3)[1:]])
    tainted = " ".join(words(150, 600) + item.split() + words(30, 601))
    texts = good + junk + [good[0], edited, tainted, f"{' '.join(words(60, 700))}\n{passage}", f"{passage}\n{' '.join(words(60, 701))}", None, ""]
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, [(i, 1, 0) for i in range(20)] + [(i, 0, 0) for i in range(40, 48)]).write.parquet(str(tmp_path / "labels.parquet"))
    items(spark, [item]).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()} if "doc_id" in docs.columns else {}
        columns = docs.columns
        docs = common.materialise(stage(spark, docs, str(tmp_path)))
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    before, out = seen["quality_rules"]
    kept = {r.doc_id for r in out.collect()}
    assert kept == {i for i, t in enumerate(texts) if t and "%" not in t}
    before, out = seen["line_dedup"]
    gone = brute_deleted(before.items(), line_dedup.MIN_WORDS)
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in before.items()}
    assert {r.doc_id: r.text for r in out.collect()} == {d: t for d, t in want.items() if t or before[d] == t}
    before, out = seen["jaccard_join"]
    comp = brute_components(list(before.items()))
    assert {r.doc_id for r in out.collect()} == {d for d, (_, c) in comp.items() if c == d}
    before, out = seen["decontaminate"]
    for r in out.collect():
        n, hit, _ = brute_hits(r.text, [(0, item)])
        assert not (hit and 20 * hit >= n)
        if r.text != before[r.doc_id]:
            assert alnum(r.text) == words(150, 600) + words(30, 601)
    before, out = seen["packing"]
    assert {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == {
        d: len(packing.encoder(corpus_pipeline.TOKENIZER)(t)) + 1 for d, t in before.items()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == out.count()


def test_pipeline_on_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, []).write.parquet(str(tmp_path / "labels.parquet"))
    items(spark, []).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_digest_of_no_spans_is_the_empty_hash():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
