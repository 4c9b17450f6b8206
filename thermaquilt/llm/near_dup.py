"""Near duplicates by Order MinHash, verified by banded alignment, with their connected classes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from thermaquilt.llm.common import concat, gram_hash, mix64, most_frequent, prefix_hash, release, span_hash, stage_table, text_chunks, tidy, word_spans

#: A bucket with at most so many texts outside its largest class, with so many texts at most, or whose largest class has such a share of it is paired outright; another by rare words. The pairs that must be verified are found either way.
SMALL_BUCKET, PAIRED_BUCKET, FAMILY = 8, 1024, 0.5
#: Members of a chunk that meet in one round, and the share of a bucket that its largest class must have for a round there. Both only settle links sooner.
CHUNK, GROWING = 32, 0.02
#: Words whose counts order the words of a text from rare to frequent. Any order gives the same links; this one keeps groups small.
FREQUENT_WORDS = 20_000
#: Pairs of one text above which its copies are dealt to several tasks; and rows of a table of such texts that is broadcast.
HEAVY_PAIRS, BROADCAST_ROWS = 256, 100_000
#: Edits up to which diagonals are walked one by one; and up to which a band is a number's bits, not numpy's.
EASY_EDITS, FEW_EDITS = 12, 2_000
#: Bits for each word of a text's bitmap, before rounding up to a power of two. Fewer only leave more pairs to the alignment.
WORD_BITS = 8


@dataclass(frozen=True)
class OrderSettings:
    """Each of bands * rows sketches holds the two least occurrence-labelled shingles in text order; a band is `rows` sketches. rounds: meetings before the rest of the mixed buckets is searched by rare words."""

    shingle: int = 5
    similarity: float = 0.8
    bands: int = 40
    rows: int = 1
    rounds: int = 2


def _multipliers(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def order_sketch(shingles: np.ndarray, s: OrderSettings) -> np.ndarray:
    """Band keys of one text from its shingles' hashes in text order."""
    n, h = len(shingles), s.bands * s.rows
    by = np.argsort(shingles, kind="stable")
    same = np.concatenate([[False], shingles[by][1:] == shingles[by][:-1]])
    label = np.zeros(n, np.uint64)
    if same.any():
        first = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
        label[by] = (np.arange(n) - first).astype(np.uint64)
    marked = mix64(shingles + label * np.uint64(0x9E3779B97F4A7C15))
    mult = _multipliers(h)[:, None]
    one, two = np.zeros(h, np.int64), np.zeros(h, np.int64)
    step = max(1, (1 << 21) // max(n, 1))
    for i in range(0, h, step):
        v = marked[None, :] * mult[i : i + step]
        v ^= v >> np.uint64(32)
        rows = np.arange(len(v))
        one[i : i + step] = v.argmin(1)
        v[rows, one[i : i + step]] = np.iinfo(np.uint64).max
        two[i : i + step] = v.argmin(1)
    a, b = np.minimum(one, two), np.maximum(one, two)
    pair = mix64(shingles[a] * np.uint64(0xD6E8FEB86659FD93) + shingles[b]).reshape(s.bands, s.rows)
    keys = np.arange(s.bands, dtype=np.uint64)
    for r in range(s.rows):
        keys = mix64(keys * np.uint64(0xD6E8FEB86659FD93) + pair[:, r])
    return keys


def sketch_texts(rows: DataFrame, s: OrderSettings) -> DataFrame:
    """(id, text_key, words, bands) of every row of (id, text): the number of words and the band keys; no bands for texts with less words than a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "text"):
            lower = [t.lower() for t in texts]
            buf, _, ends = concat(lower)
            begin, end = word_spans(buf)
            words = span_hash(prefix_hash(buf), begin, end)
            cut = np.searchsorted(begin, ends)
            keys, before, sizes = [], 0, np.diff(cut, prepend=0)
            for upto in cut:
                own = gram_hash(words[before:upto], s.shingle)
                keys.append(order_sketch(own, s).view(np.int64) if len(own) else np.zeros(0, np.int64))
                before = upto
            flat = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]), pa.int32()), pa.array(np.concatenate(keys)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([xxh3_128_digest(t) for t in texts], pa.binary()), pa.array(sizes, pa.int64()), flat], names=["id", "text_key", "words", "bands"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"id {kind}, text_key binary, words long, bands array<long>")


def _easy_edits(a: list, b: list, most: int) -> int | None:
    """banded_distance for few edits: the reach of each diagonal in a dict."""
    na, nb = len(a), len(b)
    reach = {}
    for e in range(most + 1):
        new = {}
        # Diagonals from which the end can still be reached in time.
        for k in range(max(-e, nb - na - most + e), min(e, nb - na + most - e) + 1):
            i = 0 if e == 0 else max(reach.get(k - 1, -1), reach.get(k, -2) + 1, reach.get(k + 1, -2) + 1)
            if i < 0 or i > na or i + k > nb or i + k < 0:
                i = min(i, na, nb - k)
                if i < 0 or i + k < 0:
                    continue
            j = i + k
            while i < na and j < nb and a[i] == b[j]:
                i += 1
                j += 1
            if i == na and j == nb:
                return e
            new[k] = i
        reach = new
    return None


def _few_edits(a: list, b: list, most: int) -> int | None:
    """banded_distance with the band's differences as bits of a number, a step for each word of the shorter text (Hyyrö's bit vectors).

    The sum that is kept stands at the band's lower edge, then in the last row,
    where it can still fall by one a step.
    """
    if len(a) < len(b):
        a, b = b, a
    na, nb = len(a), len(b)
    if not nb:
        return na if na <= most else None
    most = min(most, na)
    places: dict = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    width = 2 * most + 1
    full, edge = (1 << width) - 1, 1 << 2 * most
    up, down, now = full ^ ((1 << most) - 1), 0, most
    row = edge >> 1
    for j, w in enumerate(b):
        x = places.get(w, 0)
        x = (x << most - j if j < most else x >> j - most) & full
        d = ((((x & up) + up) ^ up) | x | down) & full
        right = down | (full ^ (d | up))
        left = d & up
        if j < na - most:
            now += not d & edge
        else:
            now += bool(right & row) - bool(left & row)
            row >>= 1
        if now > 2 * most + nb - na:
            return None
        d >>= 1
        up = left | (full ^ (d | right))
        down = d & right
    return now if now <= most else None


def _many_edits(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """banded_distance for wide bands: all diagonals of a step at once, their common runs by bisection over sums of word codes."""
    na, nb = len(a), len(b)
    width = max(na, nb) + 1
    up = np.full(width, 0x9E3779B97F4A7C15, np.uint64)
    up[0] = 1
    up = np.multiply.accumulate(up)
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix64(x.astype(np.uint64) + np.uint64(1)) * up[: len(x)], dtype=np.uint64)]) for x in (a, b)]
    k = np.arange(-most, most + 1)
    reach = np.full(2 * most + 3, -2, np.int64)  # one more place at each end
    for e in range(most + 1):
        lo, hi = most - e, most + e + 1
        if e == 0:
            i = np.zeros(1, np.int64)
        else:
            i = np.maximum(np.maximum(reach[lo:hi], reach[lo + 1 : hi + 1] + 1), reach[lo + 2 : hi + 2] + 1)
        own = k[lo:hi]
        i = np.minimum(i, np.minimum(na, nb - own))
        ok = (i >= 0) & (i + own >= 0)
        x = np.where(ok, i, 0)
        y = np.where(ok, x + own, 0)
        low, high = np.zeros(len(x), np.int64), np.minimum(na - x, nb - y)
        while (low < high).any():
            mid = (low + high + 1) // 2
            # Equal runs have equal sums once both are shifted to the same power.
            left, right = sums[0][x + mid] - sums[0][x], sums[1][y + mid] - sums[1][y]
            same = left * up[np.maximum(y - x, 0)] == right * up[np.maximum(x - y, 0)]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        i = np.where(ok, x + low, -2)
        if abs(nb - na) <= e and i[nb - na + e] >= na:
            return e
        reach[lo + 1 : hi + 1] = i
    return None


def banded_distance(a: list, b: list, most: int) -> int | None:
    """Edit distance in words; only diagonals within `most` are walked. None above it."""
    same = 0
    while same < min(len(a), len(b)) and a[-1 - same] == b[-1 - same]:
        same += 1
    a, b = a[: len(a) - same], b[: len(b) - same]
    if abs(len(a) - len(b)) > most:
        return None
    easy = _easy_edits(a, b, min(most, EASY_EDITS))
    if easy is not None or most <= EASY_EDITS:
        return easy
    if most <= FEW_EDITS:
        return _few_edits(a, b, most)
    code: dict = {}
    return _many_edits(*(np.array([code.setdefault(w, len(code)) for w in x], np.int64) for x in (a, b)), most)


@lru_cache(maxsize=2)
def _counted(text: bytes) -> tuple[list[bytes], Counter]:
    """Lower-case words of a text, in order and counted; pairs come sorted by one of their texts."""
    words = text.lower().split()
    return words, Counter(words)


def similar(a: bytes, b: bytes, s: OrderSettings) -> bool:
    """Whether two texts align word by word with at most 1 - similarity of the longer one's words changed, added or left out."""
    (x, in_x), (y, in_y) = _counted(a), _counted(b)
    longer = max(len(x), len(y))
    most = int((1 - s.similarity) * longer + 1e-9)
    # Words that the two do not share at all must each be edited.
    if min(len(x), len(y)) < s.shingle or longer - sum((in_x & in_y).values()) > most:
        return x == y
    # An edit changes at most two pairs of neighbours.
    if longer - 1 - sum((Counter(zip(x, x[1:], strict=False)) & Counter(zip(y, y[1:], strict=False))).values()) > 2 * most:
        return False
    start = 0
    while start < min(len(x), len(y)) and x[start] == y[start]:
        start += 1
    return banded_distance(x[start:], y[start:], most) is not None


def verified(pairs: DataFrame, texts: DataFrame, s: OrderSettings) -> DataFrame:
    """The pairs (a, b, class_a, class_b) whose texts are similar. texts: (id, text), one row per id.

    b may be one text for a third of all pairs (a hub): above HEAVY_PAIRS its
    text has a copy for each so many pairs, so no task gets them all.
    """
    heavy = stage_table(pairs.groupBy(F.col("b").alias("h")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HEAVY_PAIRS).select("h", F.ceil(F.col("n") / HEAVY_PAIRS).cast("int").alias("copies")), "omh-heavy")
    known = F.broadcast(heavy) if heavy.count() <= BROADCAST_ROWS else heavy
    dealt = pairs.join(known, F.col("b") == F.col("h"), "left").select("a", "b", "class_a", "class_b", F.pmod(F.xxhash64("a"), F.coalesce("copies", F.lit(1))).alias("copy"))
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.join(known, F.col("id") == F.col("h"), "left").select(F.col("id").alias("b"), F.col("text").alias("text_b"), F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy"))
    both = dealt.join(one, "a").join(two, ["b", "copy"]).select("a", "b", "class_a", "class_b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [similar(p or b"", q or b"", s) for p, q in zip(*(batch.column(i).cast(pa.binary()).to_pylist() for i in (4, 5)), strict=True)]
            yield batch.select(["a", "b", "class_a", "class_b"]).filter(pa.array(ok, pa.bool_()))
        _counted.cache_clear()

    kind = texts.schema["id"].dataType.simpleString()
    return both.mapInArrow(tidy(run), f"a {kind}, b {kind}, class_a {kind}, class_b {kind}")


def word_tokens(text: bytes) -> np.ndarray:
    """Hashes of a text's lower-case words, each with the number of its occurrence."""
    buf, _, _ = concat([text.lower()])
    words = np.sort(span_hash(prefix_hash(buf), *word_spans(buf)))
    if not len(words):
        return words
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    label = np.arange(len(words)) - np.repeat(first, np.diff(np.append(first, len(words))))
    return mix64(words + label.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_bits(text: bytes) -> np.ndarray:
    """A bitmap, in 64-bit numbers: whether an odd number of the text's words, with their occurrence, has each place. Twice the size folds to this one by exclusive or."""
    own = word_tokens(text)
    size = max(64, WORD_BITS << max(len(own) - 1, 0).bit_length())
    odd = np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def with_bits(texts: DataFrame) -> DataFrame:
    """(id, text, bits) of texts (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_chunks(batches, "text"):
            bits = [word_bits(t) for t in raw]
            flat = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(b) for b in bits])]), pa.int32()), pa.array(np.concatenate(bits)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), flat], names=["id", "text", "bits"])

    return texts.select("id", "text").mapInArrow(tidy(run), f"id {texts.schema['id'].dataType.simpleString()}, text string, bits array<long>")


def may_align(s: OrderSettings) -> Column:
    """Whether the bitmaps of x and y allow for a link; true where one of them is missing or more than twice as long as the other.

    Texts of n and m words that have c in common (counted as often as they
    occur) differ in n + m - 2 c words, and their bitmaps in no more places.
    A link leaves at most e = (1 - similarity) of the longer one's words out
    of c, so at most 2 e - |n - m| places differ. No similar pair is lost.
    """
    x, y = F.col("x.bits"), F.col("y.bits")

    def either(p: Column, q: Column) -> Column:
        return F.zip_with(p, q, lambda i, j: i.bitwiseXOR(j))

    def fold(p: Column) -> Column:
        half = F.floor(F.size(p) / 2).cast("int")
        return either(F.slice(p, F.lit(1), half), F.slice(p, half + 1, half))

    def differ(p: Column, q: Column) -> Column:
        return F.aggregate(either(p, q), F.lit(0), lambda n, i: n + F.bit_count(i))

    places = F.when(F.size(x) == F.size(y), differ(x, y)).when(F.size(x) == 2 * F.size(y), differ(fold(x), y)).when(2 * F.size(x) == F.size(y), differ(x, fold(y)))
    edits = F.floor((1 - s.similarity) * F.greatest("x.words", "y.words") + 1e-9)
    return F.coalesce(places <= 2 * edits - F.abs(F.col("x.words") - F.col("y.words")), F.lit(True))


def rare_words(texts: DataFrame, s: OrderSettings, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, the columns keep, token): enough of each text's rarest words that two similar texts have one of them in common.

    Texts with n words, the longer one's, and at most e = (1 - similarity) n
    edits share n - e words, counted as often as they occur. If all words are
    put in one order, two such texts share one of their first e + 1. The order
    is by count, as far as the most frequent words are known, so these stand last.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for _, texts in text_chunks(batches, "text"):
            own, n = np.unique(np.concatenate([word_tokens(t) for t in texts]), return_counts=True)
            keys, at = np.unique(np.concatenate([keys, own]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(keys)).astype(np.int64)
            if len(keys) > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["token", "n"])
                keys, counts = keys[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["token", "n"])

    counts = stage_table(texts.select("text").mapInArrow(tidy(count), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n > 1"), "omh-words")
    frequent = most_frequent(counts, "token", FREQUENT_WORDS)
    release(counts)
    known, times = (np.zeros(0, np.uint64), np.zeros(0, np.int64)) if not len(frequent) else (frequent["token"].to_numpy(np.int64).view(np.uint64), frequent["n"].to_numpy(np.int64))
    by = np.argsort(known)
    carried = texts.sparkSession.sparkContext.broadcast((known[by], times[by]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = carried.value
        for batch, raw in text_chunks(batches, "text"):
            parts = []
            for t in raw:
                own = word_tokens(t)
                n = np.zeros(len(own), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    n = np.where(known[at] == own, times[at], 0)
                parts.append(own[np.lexsort((own, n))[: int((1 - s.similarity) * len(own) + 1e-9) + 1]])
            take = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(take)) for c in ("id", *keep)), pa.array(np.concatenate(parts).view(np.int64))], names=["id", *keep, "token"])

    kinds = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in ("id", *keep))
    return texts.select("id", *keep, "text").mapInArrow(tidy(run), f"{kinds}, token long")


#: A pair of x and y with their classes.
_PAIR = "x.id AS a", "y.id AS b", "x.label AS class_a", "y.label AS class_b"


def rare_pairs(held: DataFrame, rare: DataFrame, s: OrderSettings) -> DataFrame:
    """(a, b, class_a, class_b): each pair of texts of different classes that share a rare word and a bucket and whose numbers of words allow for a link, once.

    held: (id, words, label, buckets and, if there are any, near), one row per text. rare: (id, label, token).
    Texts that share one of the buckets near have met there.
    Texts of one family share dozens of rare words, so a join by word would make
    a pair dozens of times. Each text's words stand in one order, the most shared
    first, and a pair is made at its first common word: a row holds the words
    before its own. Most pairs that met before have the very first in common.
    """
    of_word = Window.partitionBy("token")
    shared = rare.select("id", "token", F.min("label").over(of_word).alias("low"), F.max("label").over(of_word).alias("high"), F.count(F.lit(1)).over(of_word).alias("n")).where("low <> high")
    # A text's own row comes before those of its words and gives them its columns.
    of_text = Window.partitionBy("id").orderBy(F.desc_nulls_first("n"), "token")
    upto, ahead = of_text.rowsBetween(Window.unboundedPreceding, 0), of_text.rowsBetween(Window.unboundedPreceding, -1)
    held = held if "near" in held.columns else held.withColumn("near", F.lit(None).cast("array<long>"))
    rows = held.unionByName(shared.drop("low", "high"), allowMissingColumns=True)
    rows = rows.select("id", *(F.first(c, ignorenulls=True).over(upto).alias(c) for c in ("words", "label", "buckets", "near")), "token", F.collect_list("token").over(ahead).alias("before")).where("token is not null")
    keyed = stage_table(rows.withColumn("lead", F.get("before", F.lit(0))), "omh-keyed")
    fits = F.abs(F.col("x.words") - F.col("y.words")) <= (1 - s.similarity) * F.greatest("x.words", "y.words") + 1e-9
    apart = (F.col("x.label") != F.col("y.label")) & (F.col("x.id") < F.col("y.id")) & fits
    met = F.coalesce(F.col("x.lead") == F.col("y.lead"), F.lit(False)) | F.arrays_overlap("x.before", "y.before") | F.coalesce(F.arrays_overlap("x.near", "y.near"), F.lit(False))
    both = (F.col("x.token") == F.col("y.token")) & apart & ~met & F.arrays_overlap("x.buckets", "y.buckets")
    return keyed.alias("x").join(keyed.alias("y"), both).selectExpr(*_PAIR)


def bucket_pairs(rows: DataFrame, texts: DataFrame, s: OrderSettings) -> DataFrame:
    """(a, b, class_a, class_b): each pair of texts of different classes that share a bucket and whose numbers of words and bitmaps allow for a link, once.

    rows: (id, words, label, bucket, size, top), top the label of the bucket's
    largest class. texts: (id, bits). A text's buckets stand in one order, the
    largest first, and a pair is made at its first common bucket.
    """
    ahead = Window.partitionBy("id").orderBy(F.desc("size"), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("id", "words", "label", "bucket", "top", F.collect_list("bucket").over(ahead).alias("before")).join(texts.select("id", "bits"), "id")
    keyed = stage_table(rows.withColumn("lead", F.get("before", F.lit(0))), "omh-near")
    fits = F.abs(F.col("x.words") - F.col("y.words")) <= (1 - s.similarity) * F.greatest("x.words", "y.words") + 1e-9
    once = (F.col("x.label") != F.col("y.label")) & ((F.col("y.label") == F.col("y.top")) | (F.col("x.id") < F.col("y.id"))) & fits
    met = F.coalesce(F.col("x.lead") == F.col("y.lead"), F.lit(False)) | F.arrays_overlap("x.before", "y.before")
    rest = keyed.where(F.col("label") != F.col("top"))
    low, high = (f(F.struct("x.id", "x.label"), F.struct("y.id", "y.label")) for f in (F.least, F.greatest))
    both = rest.alias("x").join(keyed.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & once & ~met & may_align(s)).select(low.alias("low"), high.alias("high"))
    return both.select(F.col("low.id").alias("a"), F.col("high.id").alias("b"), F.col("low.label").alias("class_a"), F.col("high.label").alias("class_b"))


def components(links: DataFrame) -> DataFrame:
    """(id, label): the least id of each class that links (a, b) join. Every round takes the neighbours' least label and then its label's label."""
    both = stage_table(links.select("a", "b").union(links.select("b", "a")), "links")
    labels = stage_table(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), F.col("label").alias("near")), "b").groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near"))
        new = labels.join(near, "id", "left").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = new.select(F.col("id").alias("label"), F.col("label").alias("far"))
        new = stage_table(new.join(jump, "label", "left").select("id", "old", F.least("label", "far").alias("label")), "labels")
        release(labels)
        labels = new.select("id", "label")
        if not new.where("old <> label").head(1):
            release(both)
            return labels
        labels._stage_path = new._stage_path


def near_duplicate_classes(docs: DataFrame, settings: OrderSettings = OrderSettings(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008
    """(id, class_id) of every row: classes of texts that are equal or joined by links of similarity 0.8 or more; class_id is the least id.

    Similarity is 1 less the word edit distance over the longer text's words, as
    banded alignment measures it on the whole texts. Links are searched among
    texts that share a band of Order MinHash sketches; those that do are all
    settled:

    * Equal texts are one text from the start, so copies cost a group sum.
    * A bucket's hub is the member that shares most bands with others, a large
      group's common original. Each text meets the most shared of its hubs.
    * In buckets where a class grows, members of different classes meet in chunks
      of CHUNK, each text in its largest such bucket, dealt anew each round: a
      family whose texts are close to some of the others, but not to one hub,
      becomes one class in a few rounds, at CHUNK meetings a text.
    * In buckets that still hold several classes, members of different classes
      meet if their numbers of words allow for a link: all with the members
      outside the bucket's largest class if these are SMALL_BUCKET at most, the
      bucket has PAIRED_BUCKET at most or that class FAMILY of it, else those
      that share one of their rarest words, as two similar texts always do (see
      rare_words). So in a large bucket texts that share a common passage but no
      rare word never meet.
    * Texts that meet in a chunk or a bucket are a pair only if their bitmaps of
      words do not rule a link out (see may_align), so a family of texts that are
      nearly similar makes few.

    Null and empty texts are equal texts. Texts shorter than a shingle match
    equal texts only. Very long texts are sketched and aligned whole; alignment
    takes time with the edits allowed, a fifth of the words. Ties in popularity
    go to the larger id. Rows with the same id share a class. Rows with a null id
    get a null class. No rows give no rows; extra columns are ignored.
    """
    s = settings
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = stage_table(sketch_texts(rows.where("id is not null"), s), "omh-sketches")
    firsts = stage_table(known.groupBy("text_key").agg(F.min("id").alias("first"), F.first("words").alias("words"), F.first("bands").alias("bands")), "omh-texts")
    bands = firsts.select(F.col("first").alias("id"), "words", F.explode(F.array_distinct("bands")).alias("bucket"))
    sizes = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stage_table(bands.join(sizes, "bucket"), "omh-shared")
    popular = shared.groupBy("id").agg(F.sum("size").alias("popular"))
    members = stage_table(shared.join(popular, "id"), "omh-members")
    release(shared)
    texts = stage_table(with_bits(rows.join(members.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))), "omh-candidates")
    label = pairs = None
    fits = F.abs(F.col("x.words") - F.col("y.words")) <= (1 - s.similarity) * F.greatest("x.words", "y.words") + 1e-9
    apart = (F.col("x.label") != F.col("y.label")) & fits & (F.col("x.id") < F.col("y.id"))
    for i in range(s.rounds + 1):
        now = members.withColumn("label", F.col("id")) if label is None else members.join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
        classes = now.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("popular", "id")).alias("hub"))
        mixed = classes.groupBy("bucket").agg(F.count(F.lit(1)).alias("classes"), F.max(F.struct("n", "label")).alias("top"), F.max("hub").alias("hub")).where("classes > 1")
        left = stage_table(now.join(mixed.select("bucket", "top", "hub"), "bucket"), "omh-mixed")
        if i == s.rounds or not left.head(1):
            break
        if i == 0:
            meet = left.where(F.col("id") != F.col("hub.id")).groupBy("id").agg(F.max("hub").getField("id").alias("hub")).select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct().withColumns({"class_a": F.col("a"), "class_b": F.col("b")})
        else:
            growing = left.where((F.col("top.n") > 2) & (F.col("top.n") >= GROWING * F.col("size")))
            own = growing.groupBy("id", "words", "label").agg(F.max(F.struct("size", "bucket")).getField("bucket").alias("bucket"))
            own = stage_table(own, "omh-growing")
            if not own.head(1):
                break
            chunks = own.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
            dealt = own.join(chunks, "bucket").join(texts.select("id", "bits"), "id").select("id", "words", "label", "bits", F.xxhash64("bucket", F.pmod(F.xxhash64("id", F.lit(i)), "chunks")).alias("chunk"))
            meet = dealt.alias("x").join(dealt.alias("y"), (F.col("x.chunk") == F.col("y.chunk")) & apart & may_align(s)).selectExpr(*_PAIR).join(pairs, ["a", "b"], "left_anti")
        new = stage_table(meet, "omh-pairs")
        release(left)
        label = _merge(new, texts, s, label)
        pairs = new if pairs is None else pairs.union(new)
    near = (F.col("size") - F.col("top.n") <= SMALL_BUCKET) | (F.col("size") <= PAIRED_BUCKET) | (F.col("top.n") >= FAMILY * F.col("size"))
    many = left.where(~near)
    more = bucket_pairs(left.where(near).withColumn("top", F.col("top.label")), texts, s)
    if many.head(1):
        held = many.groupBy("id", "words", "label").agg(F.collect_set("bucket").alias("buckets"))
        held = stage_table(held.join(left.where(near).groupBy("id").agg(F.collect_set("bucket").alias("near")), "id", "left"), "omh-held")
        rare = stage_table(rare_words(texts.join(held.select("id", "label"), "id"), s, keep=("label",)), "omh-rare")
        more = more.union(rare_pairs(held, rare, s))
    more = more.distinct() if pairs is None else more.distinct().join(pairs, ["a", "b"], "left_anti")
    more = stage_table(more, "omh-rest-pairs")
    label = _merge(more, texts, s, label)
    release(left, members, texts)
    of_text = firsts.select("text_key", "first") if label is None else firsts.join(label, firsts["first"] == label["id"], "left").select("text_key", F.coalesce("label", "first").alias("first"))
    by_row = known.select("id", "text_key").join(of_text, "text_key")
    out = by_row.select(F.col("id").alias(id_col), F.col("first").alias("class_id"))
    return out.unionByName(docs.where(F.col(id_col).isNull()).select(F.col(id_col), F.lit(None).cast(out.schema["class_id"].dataType).alias("class_id")))


def _merge(pairs: DataFrame, texts: DataFrame, s: OrderSettings, label: DataFrame | None) -> DataFrame | None:
    """Labels with the links among the pairs that are similar. A class so far is one vertex, so only what is new is walked."""
    if not pairs.head(1):
        return label
    new = stage_table(verified(pairs, texts, s), "omh-links")
    if not new.head(1):
        return label
    joined = components(new.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))
    if label is None:
        return joined
    moved = label.join(joined.select(F.col("id").alias("label"), F.col("label").alias("to")), "label", "left").select("id", F.coalesce("to", "label").alias("label"))
    return stage_table(moved.union(joined.join(label, "id", "left_anti").select("id", "label")), "labels")
