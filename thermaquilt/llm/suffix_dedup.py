"""Exact substring removal by suffix arrays of shards, built by induced sorting, with permuted common prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermaquilt.llm.common import prefix_hash, span_hash, stage_table, text_chunks, tidy
from thermaquilt.llm.pieces import Units, by_anchor, cut_pieces, different_pieces, recurring_texts, unique_rows

_MATCHES = "hash long, piece long, begins array<int>, ends array<int>"


def suffix_types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last suffix, before the end, is larger."""
    n = len(t)
    step = np.sign(np.append(t[1:].astype(np.int64) - t[:-1], -1))
    # Equal letters take the type of the first unequal pair to their right.
    place = np.where(step != 0, np.arange(n), n - 1)
    nearest = np.minimum.accumulate(place[::-1])[::-1]
    return step[nearest] > 0


def _induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, letters: int) -> np.ndarray:
    """The suffix array that the sorted leftmost-smaller suffixes `seeds` induce, a bucket of one letter at a time."""
    n = len(t)
    seed_letter = t[seeds]
    cut = np.searchsorted(seed_letter, np.arange(letters + 1))
    # By suffix: the letter before it, and whether the suffix from there is small (1), large (0) or not there (2).
    ahead = np.concatenate([t[:1], t[:-1]])
    kind = np.concatenate([[2], small[:-1]]).astype(np.int8)
    larger: list[list[np.ndarray]] = [[] for _ in range(letters)]
    smaller: list[list[np.ndarray]] = [[] for _ in range(letters)]

    def deal(block: np.ndarray, to: list[list[np.ndarray]], want_small: bool) -> None:
        before = block[kind[block] == want_small]
        if len(before) < 2:
            if len(before):
                to[ahead[before[0]]].append(before - np.int32(1))
            return
        letter = ahead[before]
        before = before - np.int32(1)
        # Most blocks are short, so array methods are called without numpy's wrappers around them.
        by = letter.argsort(kind="stable")
        letter, before = letter[by], before[by]
        head = [0, *((letter[1:] != letter[:-1]).nonzero()[0] + 1).tolist()]
        for x, a, b in zip(letter[head].tolist(), head, [*head[1:], len(before)], strict=True):
            to[x].append(before[a:b])

    # The end of the text stands before all: it induces the last suffix.
    larger[int(t[n - 1])].append(np.array([n - 1], np.int32))
    for c in range(letters):
        k = 0
        while k < len(larger[c]):
            deal(larger[c][k], larger, False)
            k += 1
        deal(seeds[cut[c] : cut[c + 1]], larger, False)
    for c in range(letters - 1, -1, -1):
        k = 0
        while k < len(smaller[c]):
            deal(smaller[c][k], smaller, True)
            k += 1
        for block in reversed(larger[c]):
            deal(block[::-1], smaller, True)
    return np.concatenate([b for c in range(letters) for b in (*larger[c], *(x[::-1] for x in reversed(smaller[c])))])


def _ranked(t: np.ndarray) -> np.ndarray:
    """Suffix array of numbers of a large alphabet: places that share a prefix of h numbers are told apart by the ranks h further on, then h doubles.

    Places of one rank stand together; a rank is the first of their slots. Only
    those that are not alone are sorted again.
    """
    n, h = len(t), 1
    sa = t.argsort(kind="stable")
    rank = np.full(n + 1, -1)  # the end stands before all
    slots, places, key = np.arange(n), sa, t[sa]
    while len(slots):
        head = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.flatnonzero(head)
        sizes = np.diff(np.append(first, len(slots)))
        rank[places] = np.repeat(slots[first], sizes)
        tied = np.repeat(sizes > 1, sizes)
        slots, places = slots[tied], places[tied]
        key = rank[places] * (n + 1) + rank[np.minimum(places + h, n)] + 1
        by = key.argsort()
        places, key = places[by], key[by]
        sa[slots] = places
        h *= 2
    return sa


def suffix_array(t: np.ndarray, letters: int) -> np.ndarray:
    """Suffix array of t, numbers below `letters`, by induced sorting from the leftmost-smaller suffixes, which have names for letters and are ranked."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    if letters > 512:
        return _ranked(t)
    small = suffix_types(t)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    if not len(lms):
        return _induce(t, small, lms, letters)
    # Leftmost-smaller substrings in order: induced from their first letters alone.
    rough = _induce(t, small, lms[np.argsort(t[lms], kind="stable")], letters)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = rough[is_lms[rough]]
    ends = np.full(n, n)
    ends[lms[:-1]] = lms[1:]
    length = ends - np.arange(n) + 1
    x, y = ordered[:-1], ordered[1:]
    same = (length[x] == length[y]) & (ends[x] < n) & (ends[y] < n)
    left = np.flatnonzero(same)
    off = 0
    while len(left):
        left = left[off < length[x[left]]]
        bad = t[x[left] + off] != t[y[left] + off]
        same[left[bad]] = False
        left = left[~bad]
        off += 1
    name = np.zeros(n, np.int64)
    name[ordered] = np.concatenate([[0], np.cumsum(~same)])
    reduced = name[lms]
    if int(reduced.max()) + 1 < len(lms):
        ordered = lms[_ranked(reduced)]
    return _induce(t, small, ordered, letters)


def permuted_lcp(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """By text position: the common prefix, up to `most`, with the suffix before it in the suffix array.

    In text order the value falls by at most one a step, and by just one where
    the letters before the two suffixes agree. Only the others, the irreducible
    ones, are compared, all at once: bytes by eight as long as these are equal,
    then letter by letter.
    """
    n = len(t)
    prior = np.full(n, -1)
    prior[sa[1:]] = sa[:-1]
    at = np.arange(n)
    reducible = (at > 0) & (prior > 0)
    reducible[reducible] = t[at[reducible] - 1] == t[prior[reducible] - 1]
    whole = np.flatnonzero(~reducible & (prior >= 0))
    value, same = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if t.dtype == np.uint8 and n:
        eights = np.ndarray(n, np.uint64, np.append(t, np.zeros(8, np.uint8)), strides=(1,))
        left, off = whole, 0
        while len(left):
            x, y = left + off, prior[left] + off
            ok = np.maximum(x, y) + 8 <= n
            ok[ok] = eights[x[ok]] == eights[y[ok]]
            same[left[~ok]] = off
            left = left[ok]
            off += 8
    wide = np.append(t.astype(np.int64) + 1, np.zeros(most + 8, np.int64))
    left, off = whole, 0
    while len(left) and off < n + 1:
        x, y = left + same[left] + off, prior[left] + same[left] + off
        ok = (wide[np.minimum(x, n)] == wide[np.minimum(y, n)]) & (x < n) & (y < n)
        value[left[~ok]] = same[left[~ok]] + off
        left = left[ok]
        off += 1
    head = np.maximum.accumulate(np.where(reducible, 0, at))
    return np.minimum(np.maximum(value[head] - (at - head), 0), most)


def repeated_starts(contents: list[bytes], n: int) -> list[np.ndarray]:
    """For each content the offsets at which an n-byte string starts that also starts at another place of the contents."""
    sizes = np.array([len(c) for c in contents])
    text = np.frombuffer(b"".join(c + b"\xff" for c in contents), np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    # Letters are renumbered so that only those in use have buckets; 0xFF is in no UTF-8 text and ends each content.
    used = np.bincount(text, minlength=256) > 0
    t = (np.cumsum(used) - 1).astype(np.uint8)[text]
    sa = suffix_array(t, int(used.sum()))
    room = np.repeat(starts + sizes, sizes + 1) - np.arange(len(t))
    lcp = permuted_lcp(t, sa, n)
    enough = lcp >= n
    after = np.full(len(t), False)
    after[sa[:-1]] = enough[sa[1:]]
    hit = (enough | after) & (room >= n)
    return [np.flatnonzero(hit[a : a + m]) for a, m in zip(starts.tolist(), sizes.tolist(), strict=True)]


def runs(offsets: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last of each run of consecutive offsets."""
    if not len(offsets):
        return [], []
    gap = np.flatnonzero(np.diff(offsets) > 1)
    return offsets[np.append(0, gap + 1)].tolist(), offsets[np.append(gap, len(offsets) - 1)].tolist()


def locate(rows: list[tuple], n: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows of the pieces at hand, which hold all pieces of their anchors, from one suffix array.

    A piece that occurs twice or more is repeated throughout; alone under its
    anchor it has nothing to be sorted against.
    """
    pieces: dict[int, int] = {}
    for r in rows:
        pieces[r[0]] = pieces.get(r[0], 0) + 1
    out = [(r[0], r[1], [0], [len(r[2]) - n]) for r in rows if r[5] > 1]
    sort = [r for r in rows if pieces[r[0]] > 1]
    if sort:
        for r, at in zip(sort, repeated_starts([r[2] for r in sort], n), strict=True):
            if r[5] == 1 and len(at):
                out.append((r[0], r[1], *runs(at)))
    kinds = pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())
    yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["hash", "piece", "begins", "ends"])


_DIGEST = np.dtype([("a", "<u8"), ("b", "<u8")])
#: Content of a shard of hot pieces, and windows of a bucket of digests: both bound what a task holds.
SHARD_BYTES, BUCKET_WINDOWS = 4 << 20, 1 << 20


def window_digests(contents: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit digests of all n-byte windows, with their content's number and offset."""
    parts, of, at = [], [], []
    for k, c in enumerate(contents):
        size = len(c) - n + 1
        start = np.arange(size)
        both = np.zeros(size, _DIGEST)
        both["a"] = span_hash(prefix_hash(np.frombuffer(c, np.uint8)), start, start + n)
        # Read backwards with other letters, so its powers and letters differ from the first half's.
        both["b"] = span_hash(prefix_hash(np.frombuffer(c[::-1].translate(_OTHER), np.uint8)), start, start + n)[::-1]
        parts.append(both)
        of.append(np.full(size, k))
        at.append(start)
    return np.concatenate(parts), np.concatenate(of), np.concatenate(at)


#: A permutation of all bytes for the digest's second half.
_OTHER = bytes((167 * i + 13) % 256 for i in range(256))


def hot_strings(pieces: DataFrame, n: int) -> DataFrame:
    """The matches of hot hashes' pieces, however many one hash has.

    Pieces are dealt to shards by content hash. Each shard sends one sorted,
    distinct list of its windows' digests for each bucket of digests; a bucket
    finds those of two shards, or twice in one, and sends each shard its own
    back. So a window in all pieces travels once a shard.
    """
    size = pieces.agg(F.coalesce(F.sum(F.octet_length("content")), F.lit(0)).alias("bytes"), F.coalesce(F.sum(F.octet_length("content") - n + 1), F.lit(0)).alias("windows")).head()
    shards, buckets = int(size["bytes"]) // SHARD_BYTES + 1, int(size["windows"]) // BUCKET_WINDOWS + 1
    dealt = pieces.select("hash", "piece", "content", "n", F.pmod(F.xxhash64("hash", "piece"), F.lit(shards)).cast("int").alias("shard"))

    def send(table: pa.Table) -> pa.Table:
        digest, of, _ = window_digests(table["content"].to_pylist(), n)
        times = table["n"].to_numpy()[of]
        own, at = np.unique(digest, return_inverse=True)
        twice = np.bincount(at, times, len(own)) > 1
        bucket = (own["a"] % np.uint64(buckets)).astype(np.int64)
        rows = [(b, table["shard"][0].as_py(), own[bucket == b].tobytes(), twice[bucket == b].tobytes()) for b in np.unique(bucket).tolist()]
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "shard", "digests", "twice"])

    def meet(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, _DIGEST) for x in table["digests"].to_pylist()]
        own, at = np.unique(np.concatenate(lists), return_inverse=True)
        often = np.bincount(at, 1 + np.concatenate([np.frombuffer(x, bool) for x in table["twice"].to_pylist()]), len(own))
        known = own[often > 1]
        back = [x[np.isin(x, known)].tobytes() for x in lists]
        return pa.table([table["shard"], pa.array(back, pa.binary())], names=["shard", "known"])

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            digest, of, at = window_digests(left["content"].to_pylist(), n)
            hit = np.isin(digest, np.frombuffer(b"".join(right["known"].to_pylist()), _DIGEST))
            cut = np.searchsorted(of, np.arange(left.num_rows + 1))
            for k, (h, p) in enumerate(zip(left["hash"].to_pylist(), left["piece"].to_pylist(), strict=True)):
                found = at[cut[k] : cut[k + 1]][hit[cut[k] : cut[k + 1]]]
                if len(found):
                    rows.append((h, p, *runs(found)))
        kinds = pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["hash", "piece", "begins", "ends"])

    sent = dealt.groupBy("shard").applyInArrow(tidy(send), "bucket long, shard int, digests binary, twice binary")
    back = sent.groupBy("bucket").applyInArrow(tidy(meet), "shard int, known binary")
    return dealt.groupBy("shard").cogroup(back.groupBy("shard")).applyInArrow(tidy(find), _MATCHES)


def remove_repeated_bytes(docs: DataFrame, *, length: int = 400, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans, kept (binary), kept_text, and the struct `rest` of the columns `keep`.

    kept_text is kept without characters that a removed span has cut apart.

    A byte goes if a string of `length` bytes covers it that also starts at any
    other place of any row. Strings never cross rows and are judged on the input.

    Pieces around recurring anchors, equal ones as one, are dealt to shards by
    anchor; each shard's suffix array and permuted common prefixes give its
    repeated strings. A hash with HOT_PIECES or more different pieces meets by
    its windows' digests instead, summed in each shard before they travel.

    Null and empty texts have 0 bytes; texts shorter than `length` lose none.
    Repeated rows are repeats of each other. Null and repeated ids are carried:
    rows are told apart by a number of their own. Extra columns are ignored.
    """
    u = Units(length, max(1, length // 8), False, length - length * 11 // 25)
    rows = unique_rows(docs, id_col, text_col, keep)
    texts = recurring_texts(rows, u, False)
    pieces = stage_table(cut_pieces(texts, u), "suffix-pieces")
    different = stage_table(different_pieces(pieces), "suffix-different")
    calm, hot = by_anchor(different, lambda group: locate(group, length), _MATCHES)
    matches = stage_table(calm.unionByName(hot_strings(hot, length)), "suffix-matches")
    spans = F.transform(F.arrays_zip("begins", "ends"), lambda m: F.struct((m["begins"] + F.col("first")).alias("begin"), (m["ends"] + F.col("first") + length).alias("end")))
    found = pieces.select("hash", "piece", "row", "first").join(matches, ["hash", "piece"]).select("row", spans.alias("spans")).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    hit = stage_table(texts.select("row", "text").join(found, "row").select("row", "text", "spans.begin", "spans.end"), "suffix-hit")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_chunks(batches, "text"):
            removed, count, kept = [], [], []
            for text, begin, end in zip(raw, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                gone = np.zeros(len(text) + 1, np.int64)
                np.add.at(gone, begin, 1)
                np.add.at(gone, end, -1)
                stay = np.cumsum(gone[:-1]) == 0
                removed.append(int(len(text) - stay.sum()))
                count.append(int((~stay[1:] & stay[:-1]).sum() + (len(stay) > 0 and not stay[0])))
                kept.append(np.frombuffer(text, np.uint8)[stay].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.binary()), pa.array([k.decode("utf-8", "ignore") for k in kept])], names=["r", "n_removed", "n_spans", "kept", "kept_text"])

    changed = hit.mapInArrow(tidy(cut), "r long, n_removed long, n_spans long, kept binary, kept_text string")
    both = rows.join(changed, F.col("row") == F.col("r"), "left")
    none = F.lit(0).cast("long")
    return both.select(F.col("id").alias(id_col), F.octet_length("text").cast("long").alias("n_bytes"), F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept", F.col("text").cast("binary")).alias("kept"), F.coalesce("kept_text", "text").alias("kept_text"), "rest")
