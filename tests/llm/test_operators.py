"""Operators against brute force on small tables, and the awkward rows."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import frame, prose
from thermaquilt.llm import chat_trees, common, decontaminate, line_rules, mixing, near_dup, phrase_dedup, pieces, ppm, suffix_dedup, token_count, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def texts(df):
    return [(r.doc_id, (r.text or "").encode()) for r in df.collect()]


def expect_phrases(rows, n=13):
    first = defaultdict(lambda: math.inf)
    key = lambda i: math.inf if i is None else i
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - n + 1):
            first[tuple(w[k : k + n])] = min(first[tuple(w[k : k + n])], key(i))
    out = []
    for i, t in rows:
        w = t.split()
        gone = {j for k in range(len(w) - n + 1) if first[tuple(w[k : k + n])] < key(i) for j in range(k, k + n)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def expect_bytes(rows, n=400):
    seen = Counter(t[k : k + n] for _, t in rows for k in range(len(t) - n + 1))
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for k in range(len(t) - n + 1):
            if seen[t[k : k + n]] > 1:
                gone[k : k + n] = b"\1" * n
        spans = len([1 for j in range(len(t)) if gone[j] and (j == 0 or not gone[j - 1])])
        out.append((str(i), len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out)


@pytest.mark.parametrize("hot", [2, 1000])
def test_phrases(copies, hot, monkeypatch):
    monkeypatch.setattr(pieces, "HOT_PIECES", hot)
    monkeypatch.setattr(pieces, "DEAL_BYTES", 40 * hot)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in phrase_dedup.phrase_digests(copies).collect())
    assert got == expect_phrases(texts(copies))


def test_phrases_odd(odd, none):
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in phrase_dedup.phrase_digests(odd).collect())
    assert got == expect_phrases(texts(odd))
    assert phrase_dedup.phrase_digests(none).count() == 0


@pytest.mark.parametrize("hot", [2, 1000])
def test_bytes(copies, hot, monkeypatch):
    monkeypatch.setattr(pieces, "HOT_PIECES", hot)
    monkeypatch.setattr(pieces, "DEAL_BYTES", 40 * hot)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeated_bytes(copies).collect())
    assert got == expect_bytes(texts(copies))


def test_bytes_odd(odd, none):
    short = odd.where("doc_id IS NULL OR doc_id NOT IN (5, 6)").union(odd.where("doc_id IN (5, 6)").withColumn("text", F.substring("text", 1, 3000)))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeated_bytes(short).collect())
    assert got == expect_bytes(texts(short))
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0


def test_near_duplicates(copies, odd, none):
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicate_classes(copies).collect()}
    assert {k: v for k, v in got.items() if k != v} == {21: 20, 22: 20, 23: 20}
    got = sorted((str(r.doc_id), r.class_id) for r in near_dup.near_duplicate_classes(odd).collect())
    assert got == sorted([("1", 1), ("2", 1), ("3", 3), ("4", 4), ("None", None), ("5", 5), ("6", 5), ("7", 7), ("7", 7), ("8", 8)])
    assert near_dup.near_duplicate_classes(none).count() == 0


def test_large_near_group_is_one_class(spark):
    base = prose(9, 150).split()
    rows = []
    for i in range(60):
        w = list(base)
        for k in range(4):
            w[(i * 7 + k * 37) % 150] = f"x{i}y{k}"
        rows.append((i, " ".join(w), "s"))
    assert {r.class_id for r in near_dup.near_duplicate_classes(frame(spark, rows)).collect()} == {0}


def test_links_in_large_mixed_buckets(spark):
    """Form letters apart from each other (0.75 in common), some with a near copy (0.815) whose only shared shingles are the form's."""
    form, rows = prose(11, 150), []
    for i in range(130):
        own = [f"w{i}x{k}" for k in range(50)]
        rows.append((2 * i, " ".join([form, *own]), "s"))
        if i < 30:
            rows.append((2 * i + 1, " ".join([form, *(w if k % 4 == 0 else f"v{i}x{k}" for k, w in enumerate(own))]), "s"))
    df = frame(spark, rows)
    bands = {r.id: set(r.bands) for r in near_dup.sketch_texts(df.selectExpr("doc_id AS id", "text"), near_dup.OrderSettings()).collect()}
    pairs = [2 * i for i in range(30) if bands[2 * i] & bands[2 * i + 1]]
    assert len(pairs) >= 28
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicate_classes(df).collect()}
    assert all(got[i + 1] == i for i in pairs)
    assert sum(k != v for k, v in got.items()) <= 30


def test_near_duplicates_against_all_pairs(spark):
    """Texts with a growing share of scattered edits, and families that share a passage: 0.9 or more of all similar pairs share a class, no other class is made."""
    import random

    r, rows, passage = random.Random(4), [], prose(12, 60)
    for i in range(60):
        base = prose(400 + i, r.randrange(40, 160)).split()
        rows.append((10 * i, " ".join(base), "s"))
        for k, share in enumerate((0.02, 0.06, 0.1, 0.14)):
            rows.append((10 * i + k + 1, " ".join(f"z{i}q{k}x{j}" if r.random() < share else w for j, w in enumerate(base)), "s"))
    rows += [(1000 + i, prose(800 + i, 50) + " " + passage, "s") for i in range(100)]
    got = {x.doc_id: x.class_id for x in near_dup.near_duplicate_classes(frame(spark, rows)).collect()}
    s, raw = near_dup.OrderSettings(), [(i, t.encode()) for i, t, _ in rows]
    links = [(i, j) for a, (i, x) in enumerate(raw) for j, y in raw[a + 1 :] if near_dup.similar(x, y, s)]
    assert len(links) > 300 and sum(got[i] == got[j] for i, j in links) >= 0.9 * len(links)
    up = {i: i for i, _ in raw}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in links:
        up[max(root(i), root(j))] = min(root(i), root(j))
    assert all(root(i) == root(c) for i, c in got.items())


def test_rare_words_meet(spark):
    """Two texts within the edits allowed always share one of their rarest words."""
    import random

    r, s, rows = random.Random(8), near_dup.OrderSettings(), []
    for i in range(80):
        a = [r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(5, 60))]
        b = list(a)
        for _ in range(r.randrange(1 + len(a) // 5)):
            k = r.randrange(len(b))
            b[k : k + 1] = r.choice([[], ["new"], [b[k], "q"]])
        rows += [(2 * i, " ".join(a), "s"), (2 * i + 1, " ".join(b), "s")]
    tokens = defaultdict(set)
    for x in near_dup.rare_words(frame(spark, rows).selectExpr("doc_id AS id", "text"), s).collect():
        tokens[x.id].add(x.token)
    close = [i for i in range(80) if near_dup.similar(rows[2 * i][1].encode(), rows[2 * i + 1][1].encode(), s) and rows[2 * i][1] != rows[2 * i + 1][1]]
    assert len(close) > 40 and all(tokens[2 * i] & tokens[2 * i + 1] for i in close)


def test_rare_pairs_are_made_once(spark):
    """Every pair of different classes that shares a rare word and a bucket and fits in size, once, however many words it shares."""
    import random

    r, s, texts = random.Random(15), near_dup.OrderSettings(), []
    for i in range(60):  # a family that shares most of 30 words, and texts apart from it
        own = sorted(r.sample(range(30), 24)) if i < 40 else [100 + i // 2, 200 + i // 3]
        texts.append((i, r.randrange(90, 130), i if i % 4 else 0, r.sample(range(8), 3), [*own, 1000 + i]))
    held = spark.createDataFrame([t[:4] for t in texts], "id long, words long, label long, buckets array<long>")
    rare = spark.createDataFrame([(t[0], t[2], k) for t in texts for k in t[4]], "id long, label long, token long")
    want = [
        (x[0], y[0]) for n, x in enumerate(texts) for y in texts[n + 1 :]
        if x[2] != y[2] and abs(x[1] - y[1]) <= 0.2 * max(x[1], y[1]) + 1e-9 and set(x[3]) & set(y[3]) and set(x[4]) & set(y[4])
    ]
    got = sorted((x.a, x.b) for x in near_dup.rare_pairs(held, rare, s).collect())
    assert len(want) > 300 and got == want


def test_shared_words_need_no_explode(spark):
    """The rows of shared rare words come from windows: no list of them is made and taken apart again, and no join makes them."""
    held = spark.createDataFrame([(i, 100, i, [1]) for i in range(3)], "id long, words long, label long, buckets array<long>")
    rare = spark.createDataFrame([(i, i, k) for i in range(3) for k in range(4)], "id long, label long, token long")
    made = []
    before = near_dup.stage_table
    near_dup.stage_table = lambda df, name: (made.append(df._jdf.queryExecution().optimizedPlan().toString()), before(df, name))[1]
    try:
        pairs = near_dup.rare_pairs(held, rare, near_dup.OrderSettings()).collect()
    finally:
        near_dup.stage_table = before
    assert sorted((x.a, x.b, x.class_a, x.class_b) for x in pairs) == [(0, 1, 0, 1), (0, 2, 0, 2), (1, 2, 1, 2)]
    assert made and not any(k in plan for plan in made for k in ("Join", "Generate"))


def test_bitmaps_rule_out_no_link(spark):
    """Bitmaps allow for every similar pair, also where one is twice as long, and rule out nearly all pairs far apart; a missing one rules nothing out."""
    import random

    r, s, rows = random.Random(21), near_dup.OrderSettings(), []
    for i in range(240):
        a = [f"w{r.randrange(400)}" for _ in range(r.choice([r.randrange(5, 300), 60, 62, 64, 66, 126, 130, 250, 260]))]
        b = list(a)
        for _ in range(int(len(a) * (0.5 if i % 4 == 0 else r.uniform(0, 0.22)))):
            k = r.randrange(len(b))
            b[k : k + 1] = r.choice([[], [f"n{k}"], [b[k], f"q{k}"]])
            b = b or ["w"]
        rows.append((i, " ".join(a), " ".join(b)))
    bits = [(i, len(x.split()), len(y.split()), *(near_dup.word_bits(t.encode()).tolist() for t in (x, y))) for i, x, y in rows]
    assert sum(len(p) != len(q) for *_, p, q in bits) > 20
    both = spark.createDataFrame([*bits, (-1, 50, 50, None, [1]), (-2, 50, 50, [1], [1, 2, 3])], "id long, n long, m long, p array<long>, q array<long>")
    x, y = both.selectExpr("id", "n AS words", "p AS bits").alias("x"), both.selectExpr("id", "m AS words", "q AS bits").alias("y")
    may = {k for (k,) in x.join(y, F.col("x.id") == F.col("y.id")).where(near_dup.may_align(s)).select("x.id").collect()}
    close = {i for i, x, y in rows if near_dup.similar(x.encode(), y.encode(), s)}
    far = [i for i, x, _ in rows if i % 4 == 0 and len(x.split()) > 40]
    assert len(close) > 100 and close <= may and {-1, -2} <= may
    assert len(far) > 30 and sum(i in may for i in far) <= len(far) // 10


@pytest.mark.parametrize("paired", [near_dup.PAIRED_BUCKET, 20])
def test_family_below_the_limit_makes_few_pairs(spark, paired, monkeypatch):
    """Texts that are all about 0.75 alike share bands and rare words, but few of their pairs are compared; every class is that of all pairs that share a band, also where larger buckets go by rare words."""
    import random

    monkeypatch.setattr(near_dup, "PAIRED_BUCKET", paired)
    monkeypatch.setattr(near_dup, "FAMILY", near_dup.FAMILY if paired > 20 else 2)
    r, s, form, rows = random.Random(22), near_dup.OrderSettings(), prose(23, 300).split(), []
    for i in range(140):
        share = 0.09 if i % 20 == 0 else 0.14
        rows.append((i, " ".join(f"v{r.randrange(400)}" if r.random() < share else w for w in form), "s"))
    df = frame(spark, rows)
    bands = {x.id: set(x.bands) for x in near_dup.sketch_texts(df.selectExpr("doc_id AS id", "text"), s).collect()}
    met = [(x, y) for x in range(140) for y in range(x + 1, 140) if bands[x] & bands[y]]
    up = list(range(140))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, y in met:
        if near_dup.similar(rows[x][1].encode(), rows[y][1].encode(), s):
            up[max(root(x), root(y))] = min(root(x), root(y))
    compared, words, before, by_words = [], [], near_dup.verified, near_dup.rare_pairs
    monkeypatch.setattr(near_dup, "verified", lambda pairs, texts, s: (compared.append(pairs.count()), before(pairs, texts, s))[1])
    monkeypatch.setattr(near_dup, "rare_pairs", lambda *a: (words.append(1), by_words(*a))[1])
    got = {x.doc_id: x.class_id for x in near_dup.near_duplicate_classes(df).collect()}
    assert got == {i: root(i) for i in range(140)} and len(met) > 3000 and 10 < len(set(got.values())) < 140
    assert words if paired == 20 else sum(compared) < len(met) / 4, (sum(compared), len(met))


def test_bucket_pairs_are_made_once(spark):
    """Every pair of different classes that shares a bucket and fits in size, once, however many buckets it shares; bitmaps leave out only pairs that are not similar."""
    import random

    r, s, rows = random.Random(24), near_dup.OrderSettings(), []
    form = prose(25, 120).split()
    for i in range(50):
        words = [f"u{i}x{k}" if r.random() < (0.05 if i % 5 else 0.13) else w for k, w in enumerate(form[: r.randrange(90, 121)])]
        rows.append((i, " ".join(words), i if i % 3 else 0, r.sample(range(6), 2)))
    size = Counter(k for x in rows for k in x[3])
    table = spark.createDataFrame([(i, len(t.split()), c, k, size[k], 0) for i, t, c, b in rows for k in b], "id long, words long, label long, bucket long, size long, top long")
    texts = spark.createDataFrame([(i, t) for i, t, *_ in rows], "id long, text string")
    fit = {
        (x[0], y[0]): near_dup.similar(x[1].encode(), y[1].encode(), s) for n, x in enumerate(rows) for y in rows[n + 1 :]
        if x[2] != y[2] and set(x[3]) & set(y[3]) and abs(len(x[1].split()) - len(y[1].split())) <= 0.2 * max(len(x[1].split()), len(y[1].split())) + 1e-9
    }
    none = texts.selectExpr("id", "CAST(NULL AS array<long>) AS bits")
    assert sorted((x.a, x.b) for x in near_dup.bucket_pairs(table, none, s).collect()) == sorted(fit)
    got = [(x.a, x.b) for x in near_dup.bucket_pairs(table, near_dup.with_bits(texts), s).collect()]
    assert len(got) == len(set(got)) < len(fit) and {p for p, close in fit.items() if close} <= set(got) <= set(fit)


def test_merge_walks_classes(spark):
    """Links of a later round join whole classes: each is one vertex, texts without a class so far are their own."""
    label = spark.createDataFrame([(1, 1), (5, 1), (2, 2), (6, 2)], "id long, label long")
    pairs = spark.createDataFrame([(5, 6, 1, 2), (3, 6, 3, 2), (8, 9, 8, 9)], "a long, b long, class_a long, class_b long")
    same = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(20)) if i < 8 else f"t{i} " * 20) for i in range(10)], "id long, text string")
    got = {x.id: x.label for x in near_dup._merge(pairs, same, near_dup.OrderSettings(), label).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 1, 6: 1}


def test_most_frequent_is_one_job(spark):
    """The histogram of counts is gathered at once, not by a job for each of its partitions."""
    counts = spark.range(4000).selectExpr("id AS key", "1 + id % 700 AS n")
    spark.sparkContext.setJobGroup("most-frequent", "")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = common.most_frequent(counts, "key", 500)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    assert 0 < len(got) <= 500 and got["n"].min() > 500
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("most-frequent")
    spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) < 10


def test_split_expression_is_small(spark):
    """What split_quota computes from its inputs stands in the plan once: the driver holds sixteen of them while it plans the tree."""
    assert len(str(mixing.split_quota(F.col("good"), F.col("total"), F.col("drawn"), F.col("u")))) < 10_000


def test_scores(spark, copies, odd, none):
    rows = texts(copies)
    learn = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    k, edge = ppm.ORDER, b"\xff"
    contexts, words = defaultdict(Counter), Counter()
    for t in learn:
        b = edge * k + t + edge
        words.update([*t.lower().split(), b""])
        for i in range(k, len(b)):
            for o in range(k + 1):
                contexts[b[i - o : i]][b[i]] += 1

    def chance(context, symbol):
        out, left = 0.0, set()
        for o in range(k, -1, -1):
            c = contexts.get(context[len(context) - o :])
            if c is None:
                continue
            own = {x: n for x, n in c.items() if x not in left}
            if own:
                total = sum(own.values()) + len(own)
                if symbol in own:
                    return out + math.log10(own[symbol] / total)
                out += math.log10(len(own) / total)
            left |= set(c)
        return out - math.log10(256 - len(contexts[b""]))

    n, v = sum(words.values()), len(words)
    for most in (10, 200_000):
        got = {r.doc_id: r for r in ppm.score_texts(copies, ~ppm.held_out(F.col("doc_id")), most_words=most).collect()}
        for i, t in rows:
            b, own = edge * k + t + edge, [*t.lower().split(), b""]
            r = got[i]
            assert r.score == pytest.approx(sum(chance(b[j - k : j], b[j]) for j in range(k, len(b))), rel=1e-4)
            assert r.base_score == pytest.approx(sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), rel=1e-9)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(words[w] > 0 for w in own), n)
    assert ppm.score_texts(odd, F.lit(True)).where("score IS NULL OR base_score IS NULL").count() == 0
    assert ppm.score_texts(odd, F.lit(False)).where("n_known > 0 OR score >= 0").count() == 0
    assert ppm.score_texts(none, F.lit(True)).count() == 0


def test_scores_use_every_count(spark):
    """More distinct contexts and bytes than a broadcast trie held (2^19), each of them rare, in many shards and blocks."""
    import random

    import numpy as np

    r = random.Random(5)
    rows = [(i, "".join(r.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .", k=6000)), "s") for i in range(120)]
    df = frame(spark, rows).repartition(4)
    learnt = [t.encode() for i, t, _ in rows if i % 6]
    keys, n = np.unique(ppm.grams(learnt, ppm.ORDER)[0], return_counts=True)
    assert len(keys) > 1 << 19
    whole = ppm.Trie(keys, n.astype(float), ppm.ORDER)
    got = {x.doc_id: x.score for x in ppm.score_texts(df, F.col("doc_id") % 6 != 0, block_bytes=50_000).collect()}
    assert len(got) == 120
    for i, t, _ in rows:
        assert got[i] == pytest.approx(whole.log10(ppm.grams([t.encode()], ppm.ORDER)[0]).sum(), rel=1e-6)


def test_batches_are_bounded_by_bytes(spark):
    """Rows of lists of 1 MB, few enough for one batch by rows, as a shard of op1's trie gets; the session's own bound stays."""
    import pyarrow as pa

    from thermaquilt.llm import common

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    wide = spark.range(0, 40, 1, 1).select(F.expr("cast(repeat('x', 1048576) as binary)").alias("keys"))
    got = [r.n for r in common.stage_table(wide.mapInArrow(sizes, "n long"), "sizes").collect()]
    assert sum(got) >= 40 << 20
    assert max(got) <= common.BATCH_BYTES + (2 << 20)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_tokens(spark, odd, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    strange = frame(spark, [(i, t, "s") for i, t in enumerate(["՘՘ a", "  two  spaces\n\n", "don't we'LL 12 3४", "a b", "<|endoftext|><|endoftext|>", "𠀀𠀁 ok", "x" * 5000])])
    for df in (odd, strange):
        got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_count.count_tokens(df, BPE).collect())
        assert got == sorted((str(i), len(t), len(tok.encode(t.decode(), add_special_tokens=False).ids)) for i, t in texts(df))
    assert token_count.count_tokens(none, BPE).count() == 0


def test_decontamination(spark, odd, none):
    item = prose(50, 40)
    parts = item.split()
    docs = frame(spark, [(1, prose(51, 80) + " " + item.upper() + ". " + prose(52, 20), "s"), (2, " ".join([*parts[20:], "and", *parts[:20]]), "s"), (3, prose(53, 90), "s"), (4, " ".join(parts[:12]), "s"), (None, item, "s"), (1, item, "s")])
    bench = spark.createDataFrame([(7, item), (8, None), (9, "too short"), (7, item)], "item_id long, text string")
    for block in (500_000, 20):
        got = decontaminate.find_contamination(docs, bench, block_tokens=block).collect()
        assert Counter((r.doc_id, r.item_id) for r in got) == {(1, 7): 4, (2, 7): 2, (None, 7): 2}
        assert all(r.coverage == 1.0 for r in got) and {r.n_tiles for r in got if r.doc_id == 2} == {2}
    assert decontaminate.find_contamination(odd, bench).count() == 0
    assert decontaminate.find_contamination(none, bench).count() == 0 and decontaminate.find_contamination(docs, bench.limit(0)).count() == 0


def test_lines(spark, odd, none):
    good = "\n".join(prose(60 + i, 15) + "." for i in range(5))
    menu = "Home | News | About | Contact"
    df = frame(spark, [(1, good, "s"), (2, good + "\n" + menu, "s"), (3, "\n".join([menu] * 3 + [prose(70, 12) + "."]), "s"), (4, "few words.", "s")])
    got = {r.doc_id: r for r in line_rules.clean_lines(df).collect()}
    assert got[1].kept and got[2].kept and got[2].clean_text == good and not got[3].kept and got[4].base_failed
    assert got[3].n_dup_lines == 2 and got[2].n_symbols == 3
    rows = line_rules.clean_lines(odd).collect()
    assert len(rows) == 10 and not [r for r in rows if r.doc_id == 1][0].kept
    assert line_rules.clean_lines(none).count() == 0


def test_mixing(spark, copies, odd, none):
    for df in (copies, odd):
        mixed = mixing.draw_mix(df)
        assert set(df.columns) - {"mix_size"} <= set(mixed.columns)
        rows = mixed.collect()
        assert len(rows) == df.count() and all(len(r.mix_draws) <= 2 for r in rows)
        by = defaultdict(list)
        for r in rows:
            by[r.source].append(r)
        for own in by.values():
            taken = sum(r.mix_size * len(r.mix_draws) for r in own)
            assert abs(taken - own[0].mix_target) <= max(r.mix_size for r in own) * 2
            assert own[0].mix_target <= 2 * own[0].mix_source_size + 1e-6
        again = {(r.doc_id, r.text): r.mix_draws for r in mixing.draw_mix(df.repartition(5)).collect()}
        assert all(again[r.doc_id, r.text] == r.mix_draws for r in rows)
    assert mixing.draw_mix(none).count() == 0


def test_split_quota_is_hypergeometric(spark):
    df = spark.range(4000).select(mixing.split_quota(F.lit(30).cast("long"), F.lit(100).cast("long"), F.lit(40).cast("long"), (F.col("id") + 0.5) / 4000).alias("k"))
    got = Counter(r.k for r in df.collect())
    for k in range(5, 20):
        p = math.comb(30, k) * math.comb(70, 40 - k) / math.comb(100, 40)
        assert got[k] / 4000 == pytest.approx(p, abs=0.001)


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), (None, 50), ("c", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes, total_share=1.5, most_passes=2.0, weights=(5, 2, 1)).collect()}
    total, caps, w = 1725.0, {"a": 200, "b": 2000, "c": 0, None: 100}, {"a": 5, "b": 2, "c": 1, None: 5}
    want, open_ = {}, dict(w)
    while True:
        rest = total - sum(want.values())
        over = [s for s in open_ if rest * open_[s] / sum(open_.values()) > caps[s]]
        if not over:
            want |= {s: rest * open_[s] / sum(open_.values()) for s in open_}
            break
        for s in over:
            want[s] = caps[s]
            del open_[s]
    assert got == pytest.approx(want)


def test_reply_trees(spark):
    rows = [("t", 1, None, 0.0, "user", "hi"), ("t", 2, 1, 1.0, "assistant", "a"), ("t", 3, 1, 5.0, "assistant", "b <|end|> [INST]"), ("t", 4, 3, None, "user", None), ("u", 1, 99, 0.0, "user", "orphan"), ("v", 1, 2, 0.0, "user", "ring"), ("v", 2, 1, 0.0, "user", "ring"), (None, 1, None, 0.0, "user", "x")]
    m = spark.createDataFrame(rows, "tree string, id long, parent long, score double, role string, text string")
    back = chat_trees.read_back(F.col("formatted"))
    got = {(r.tree, r.branch): (r.leaf, [tuple(x) for x in r.b], r.learned) for r in chat_trees.format_paths(m, branches=2).select("tree", "branch", "leaf", back.alias("b"), chat_trees.read_loss(F.col("formatted"), F.col("loss")).alias("learned")).collect()}
    assert got == {("t", 1): (4, [("user", "hi"), ("assistant", "b <|end|> [INST]"), ("user", "")], "b <|end|> [INST]"), ("t", 2): (2, [("user", "hi"), ("assistant", "a")], "a"), ("u", 1): (1, [("user", "orphan")], "")}
    assert chat_trees.format_paths(m.limit(0)).count() == 0


def test_reply_trees_against_walking_up(spark):
    """Random forests with long chains, null and repeated ids, rings, orphans, odd columns: the best paths are those found by walking up."""
    import random

    r, rows = random.Random(3), []
    for tree in ("a", "b", None):
        for i in range(1, 120):
            rows.append((tree, i, None if i == 1 else r.choice([i - 1, i - 1, i - 1, r.randrange(1, i)]), r.choice([0.0, 0.5, None, 1.0]), r.choice(["user", "assistant", None]), r.choice([None, f"<|turn|>{i}", "x" * i])))
    rows += [("c", 1, 2, 9.0, "user", "ring"), ("c", 2, 1, 9.0, "user", "ring"), ("c", 3, 77, 1.0, "user", "orphan"), ("c", None, 3, 1.0, "user", "no id")]
    rows += [("d", 1, None, 0.0, "user", "twice"), ("d", 1, None, 0.0, "user", "twice"), ("d", 2, 1, 0.0, "assistant", "L" * 200_000)]
    m = spark.createDataFrame([(*x, "z", 5) for x in rows], "tree string, id long, parent long, score double, role string, text string, leaf string, place long")
    out = chat_trees.format_paths(m, branches=3, null_tree=True)
    got = {(x.tree, x.branch): (x.leaf, [tuple(y) for y in x.b]) for x in out.select("tree", "branch", "leaf", chat_trees.read_back(F.col("formatted")).alias("b")).collect()}
    want = {}
    for tree in {x[0] for x in rows}:
        own = {x[1]: x for x in rows if x[0] == tree and x[1] is not None}
        paths = []
        for i in own:
            if i in {x[2] for x in own.values()}:
                continue
            path, at = [], i
            while at in own and at not in path:
                path.append(at)
                at = own[at][2]
            paths.append((-sum(own[k][3] or 0.0 for k in path), i, path[::-1]))
        for b, (_, leaf, path) in enumerate(sorted(paths)[:3], 1):
            want[tree, b] = (leaf, [(own[k][4] or "", own[k][5] or "") for k in path])
    assert got == want


def test_mix_draws_what_the_tree_deals(spark, monkeypatch):
    """Shards hold disjoint runs of blocks, as many as the tree deals; with fewer blocks dealt, fewer rows are drawn."""
    rows = frame(spark, [(i, prose(i, 5 + i % 7), f"s{i % 3}") for i in range(600)])
    step = mixing._SPAN // mixing.BLOCKS
    places = {r.doc_id: (r.a, r.b) for r in rows.select("doc_id", *[mixing.unit(20240501, e, F.col("doc_id")).alias(n) for e, n in ((0, "a"), (1, "b"))]).collect()}
    tree = mixing.splitting_tree
    kept = []

    def spied(quotas, levels, seed):
        kept.append((quotas.collect(), out := tree(quotas, levels, seed)))
        return out

    monkeypatch.setattr(mixing, "splitting_tree", spied)
    drawn = mixing.draw_mix(rows).collect()
    quotas, ends = {r["rank"]: r.quota for r in kept[0][0]}, {r["rank"]: r.ends for r in kept[0][1].collect()}
    rank = {s: i + 1 for i, s in enumerate(sorted({r.source for r in drawn}))}
    for r in drawn:
        for d in r.mix_draws:
            block = d.epoch * mixing.BLOCKS + places[r.doc_id][d.epoch] // step
            own = ends[rank[r.source]]
            assert block < own[d.shard] and (d.shard == 0 or own[d.shard - 1] <= block)
    assert all(len(e) == 16 and e[-1] == quotas[k] and e == sorted(e) for k, e in ends.items())
    taken = sum(len(r.mix_draws) for r in drawn)
    monkeypatch.setattr(mixing, "splitting_tree", lambda q, levels, seed: tree(q.withColumn("quota", F.floor(F.col("quota") / 2)), levels, seed))
    assert 0.3 * taken < sum(len(r.mix_draws) for r in mixing.draw_mix(rows).collect()) < 0.7 * taken


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "<|turn|>", "<\\|end|>\\", "<\\\\|a<|", "<<SYS>>x<</SYS>>", "[\\INST]", "<s><<s>>", "\\", "漢<|body|>字"])
def test_escape_round_trip(spark, text):
    r = spark.createDataFrame([(text,)], "t string").select(chat_trees.escape(F.col("t")).alias("e"), chat_trees.unescape(chat_trees.escape(F.col("t"))).alias("u")).head()
    assert r.u == text and "<|" not in r.e


def test_toxicity(spark, odd, none):
    rows, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        rows.append((i, prose(i, 40) + (" idiot scum" if bad else ""), "s"))
        labels.append((i, i % 3 % 2, int(bad)))
    lab = spark.createDataFrame([*labels[:200], (0, 0, 1), (None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.is_toxic for r in toxicity.judge_toxicity(frame(spark, rows), lab).collect()}
    assert sum(got[i] == bool(t) for i, _, t in labels[200:]) >= 97
    assert toxicity.judge_toxicity(odd, lab).where("p_toxic IS NULL").count() == 0
    assert toxicity.judge_toxicity(odd, lab.limit(0)).where("p_toxic <> 0").count() == 0
    assert toxicity.judge_toxicity(none, lab).count() == 0


def test_chain_of_three_categories(spark):
    """Insult and threat are words of their own; abuse is either of them, and rare in the labels, so the chain's earlier probabilities tell it."""
    rows, labels = [], []
    for i in range(600):
        insult, threat = i % 5 == 0, i % 7 == 0
        rows.append((i, prose(i, 40) + " idiot scum" * insult + " hurt burn" * threat, "s"))
        labels.append((i, int(insult), int(threat), int(insult or threat)))
    lab = spark.createDataFrame(labels[:400], "doc_id long, insult int, threat int, abuse int")
    got = {r.doc_id: r for r in toxicity.judge_toxicity(frame(spark, rows), lab, categories=("insult", "threat", "abuse"), verdict="abuse").collect()}
    for k, c in ((1, "insult"), (2, "threat"), (3, "abuse")):
        assert sum((got[i][f"p_{c}"] > 0.5) == bool(labels[i][k]) for i in range(400, 600)) >= 194
    r = labels[:400]
    chain = toxicity.fit_chain([(toxicity.features_of(t.encode()), c[1:]) for (_, t, _), c in zip(rows, r, strict=False)], ["insult", "threat", "abuse"])
    weights = chain["models"][2]["weights"]
    assert (weights[-3:-1] > 0.5).all()  # abuse leans on both earlier probabilities


def test_words_chosen_by_executors_are_those_of_the_fit(spark):
    rows = frame(spark, [(i, prose(i, 60) + (" idiot scum" if i % 4 == 0 else ""), "s") for i in range(120)])
    lab = spark.createDataFrame([(i, i % 2, int(i % 4 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    s = toxicity.ChainSettings(max_words=50)
    table = toxicity.training_table(rows, lab, ["quality", "toxic"], s)
    whole = [(toxicity.features_of(r.text.encode()), (r.doc_id % 2, int(r.doc_id % 4 == 0))) for r in rows.collect()]
    small = toxicity.training_rows(table, toxicity.chosen_words(table, ["quality", "toxic"], s), ["quality", "toxic"])
    for a, b in zip(toxicity.fit_chain(small, ["quality", "toxic"], s)["models"], toxicity.fit_chain(whole, ["quality", "toxic"], s)["models"], strict=True):
        assert set(a["words"]) == set(b["words"])


def test_out_of_fold_probabilities_are_not_fitted_on():
    import numpy as np

    r = np.random.default_rng(1)
    rows = [(np.unique(r.integers(0, 60, 12)), (int(r.random() < 0.5), int(r.random() < 0.5))) for _ in range(200)]
    chain = toxicity.fit_chain(rows, ["a", "b"], toxicity.ChainSettings(least_documents=1))
    y = np.array([c[0] for _, c in rows])
    assert abs(((chain["out_of_fold"][:, 0] > 0.5) == y).mean() - 0.5) < 0.15
