"""Repeated-phrase removal: confirmed passages, sharded Aho-Corasick automata over words, every occurrence located."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from thermaquilt.llm.common import release, stage_table, text_chunks, tidy
from thermaquilt.llm.pieces import Units, by_anchor, cut_pieces, recurring_texts, sent_pieces, unique_rows

#: Content of a shard of anchors whose passages make one automaton; a small one stays in the processor's cache.
AUTOMATON_BYTES = 1 << 16
_MATCHES = "hash long, piece long, offsets array<int>, lows array<long>"


def confirm(stretches: list[tuple[int, tuple[int, ...], int, int]], n: int) -> dict[tuple[int, ...], tuple[int, int]]:
    """The passages that two documents have: by words, the least id that does and the number of windows. Stretches are (hash, words, least id, largest id).

    The only stretch of an anchor recurs whole or not at all, so it is one
    passage; of several, each window of n words is judged alone.
    """
    groups: dict[int, int] = {}
    for key, *_ in stretches:
        groups[key] = groups.get(key, 0) + 1
    whole: dict[tuple[int, ...], tuple[int, int]] = {}
    seen: dict[tuple[int, ...], list[int]] = {}
    for key, words, low, high in stretches:
        if groups[key] == 1:
            if low < high:
                whole[words] = low, len(words) - n + 1
            continue
        for i in range(len(words) - n + 1):
            span = seen.setdefault(words[i : i + n], [low, high])
            if low < span[0]:
                span[0] = low
            if high > span[1]:
                span[1] = high
    return whole | {w: (low, 1) for w, (low, high) in seen.items() if low < high}


def _letters(words: tuple[int, ...]) -> tuple[int, ...]:
    """Two letters a word, told apart by their range: a node's letters are searched one by one, so no node may have one for each word."""
    return tuple([x for w in words for x in (256 + (w >> 8), w & 255)])


def stream(passages: dict[tuple[int, ...], tuple[int, int]], stretches: list[tuple[int, int, tuple[int, ...]]], n: int) -> list[tuple[int, int, list[int], list[int]]]:
    """(hash, piece, offsets, lows) of every stretch with an occurrence: one automaton of the shard's confirmed passages reads them all, word by word."""
    import ahocorasick

    if not passages:
        return []
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for words, value in passages.items():
        automaton.add_word(_letters(words), value)
    automaton.make_automaton()
    out = []
    for key, piece, words in stretches:
        offsets, lows = [], []
        for end, (low, windows) in automaton.iter(_letters(words)):
            first = end // 2 - n - windows + 2
            offsets.extend(range(first, first + windows))
            lows.extend([low] * windows)
        if offsets:
            out.append((key, piece, offsets, lows))
    return out


def locate(rows: list[tuple], n: int) -> Iterator[pa.RecordBatch]:
    """Occurrences of the recurring passages in stretches (hash, piece, content, low, high), sorted by hash: an automaton for each AUTOMATON_BYTES of whole anchors."""
    shard: list[tuple] = []
    size = 0
    for i, r in enumerate(rows):
        shard.append(r)
        size += len(r[2])
        if i + 1 < len(rows) and (size < AUTOMATON_BYTES or rows[i + 1][0] == r[0]):
            continue
        code: dict[bytes, int] = {}
        words = [tuple([code.setdefault(w, len(code)) for w in s[2].split(b" ")]) for s in shard]
        passages = confirm([(s[0], w, s[3], s[4]) for w, s in zip(words, shard, strict=True)], n)
        yield _batch(stream(passages, [(s[0], s[1], w) for w, s in zip(words, shard, strict=True)], n))
        shard, size = [], 0


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["hash", "piece", "offsets", "lows"])


_DIGEST = np.dtype([("a", "<u8"), ("b", "<u8")])
#: Content of a shard of hot pieces, and windows of a bucket of digests: both bound what a task holds.
SHARD_BYTES, BUCKET_WINDOWS = 1 << 20, 1 << 20


def window_digests(contents: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit digests of all windows of n words, with their content's number and offset."""
    out, of, at = [], [], []
    for k, c in enumerate(contents):
        words = c.split(b" ")
        for i in range(len(words) - n + 1):
            out.append(xxh3_128_digest(b" ".join(words[i : i + n])))
            of.append(k)
            at.append(i)
    return np.frombuffer(b"".join(out), _DIGEST), np.array(of, np.int64), np.array(at, np.int64)


def hot_windows(pieces: DataFrame, n: int) -> DataFrame:
    """The matches of hot hashes' pieces, however many one hash has.

    Pieces are dealt to shards by content hash. Each shard sends its distinct
    windows' digests with the least and largest id, one list for each bucket of
    digests; a bucket confirms those of two documents and sends each shard its
    own back. So a window in all pieces travels once a shard. The shard compiles
    its confirmed windows into an automaton, which then locates them.
    """
    size = pieces.agg(F.coalesce(F.sum(F.octet_length("content")), F.lit(0)).alias("bytes")).head()["bytes"]
    shards, buckets = int(size) // SHARD_BYTES + 1, int(size) // (16 * BUCKET_WINDOWS) + 1
    dealt = pieces.select("hash", "piece", "content", "low", "high", F.pmod(F.xxhash64("hash", "piece"), F.lit(shards)).cast("int").alias("shard"))

    def least_and_most(at: np.ndarray, low: np.ndarray, high: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        lows, highs = np.full(size, np.iinfo(np.int64).max), np.full(size, np.iinfo(np.int64).min)
        np.minimum.at(lows, at, low)
        np.maximum.at(highs, at, high)
        return lows, highs

    def send(table: pa.Table) -> pa.Table:
        digest, of, _ = window_digests(table["content"].to_pylist(), n)
        own, at = np.unique(digest, return_inverse=True)
        lows, highs = least_and_most(at, table["low"].to_numpy()[of], table["high"].to_numpy()[of], len(own))
        bucket = (own["a"] % np.uint64(buckets)).astype(np.int64)
        rows = [(b, table["shard"][0].as_py(), *(x[bucket == b].tobytes() for x in (own, lows, highs))) for b in np.unique(bucket).tolist()]
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["bucket", "shard", "digests", "lows", "highs"])

    def meet(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, _DIGEST) for x in table["digests"].to_pylist()]
        own, at = np.unique(np.concatenate(lists), return_inverse=True)
        both = (np.concatenate([np.frombuffer(x, np.int64) for x in table[c].to_pylist()]) for c in ("lows", "highs"))
        lows, highs = least_and_most(at, *both, len(own))
        known, back = lows < highs, []
        for x in lists:
            place = np.searchsorted(own, x)
            ok = known[place]
            back.append((x[ok].tobytes(), lows[place[ok]].tobytes()))
        return pa.table([table["shard"], *(pa.array([b[i] for b in back], pa.binary()) for i in (0, 1))], names=["shard", "known", "lows"])

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            known = np.frombuffer(b"".join(right["known"].to_pylist()), _DIGEST)
            lows = np.frombuffer(b"".join(right["lows"].to_pylist()), np.int64)
            by = np.argsort(known)
            known, lows = known[by], lows[by]
            contents = left["content"].to_pylist()
            digest, of, at = window_digests(contents, n)
            own, first = np.unique(digest, return_index=True)
            place = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
            hit = known[place] == own if len(known) else np.zeros(len(own), bool)
            code: dict[bytes, int] = {}
            words = [tuple(code.setdefault(w, len(code)) for w in c.split(b" ")) for c in contents]
            passages = {words[of[i]][at[i] : at[i] + n]: (low, 1) for i, low in zip(first[hit].tolist(), lows[place[hit]].tolist(), strict=True)}
            rows = stream(passages, list(zip(left["hash"].to_pylist(), left["piece"].to_pylist(), words, strict=True)), n)
        kinds = pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["hash", "piece", "offsets", "lows"])

    sent = dealt.groupBy("shard").applyInArrow(tidy(send), "bucket long, shard int, digests binary, lows binary, highs binary")
    back = sent.groupBy("bucket").applyInArrow(tidy(meet), "shard int, known binary, lows binary")
    return dealt.groupBy("shard").cogroup(back.groupBy("shard")).applyInArrow(tidy(find), _MATCHES)


def _changed(docs: DataFrame, window: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows as (id, row, text), and (row, n_removed, kept_text) of those that lose words."""
    u = Units(window, min(8, window), True, window)
    rows = unique_rows(docs, id_col, text_col)
    texts = recurring_texts(rows, u, True)
    pieces = stage_table(cut_pieces(texts, u, content=False), "phrase-pieces")
    last = F.coalesce("id", F.lit((1 << 63) - 1))
    # Equal pieces are one, and one row sends its content.
    each = pieces.groupBy("hash", "piece").agg(F.min(last).alias("low"), F.max(last).alias("high"), F.min("row").alias("row"))
    anchor = each.groupBy("hash").agg(F.min("piece").alias("piece"), F.max("piece").alias("other"), F.min("low").alias("low"), F.max("high").alias("high"))
    each = stage_table(each.join(anchor.where("piece <> other OR low < high").select("hash"), "hash", "left_semi"), "phrase-each")
    asked = each.groupBy("row").agg(F.collect_list(F.struct("hash", "piece", "low", "high")).alias("asked"))
    different = stage_table(sent_pieces(texts.join(asked, "row"), u), "phrase-different")
    release(each)
    calm, hot = by_anchor(different, lambda group: locate(group, window), _MATCHES)
    matches = stage_table(calm.unionByName(hot_windows(hot, window)), "phrase-matches")
    release(different)
    at = F.transform(F.filter(F.arrays_zip("offsets", "lows"), lambda m: m["lows"] < last), lambda m: m["offsets"] + F.col("first"))
    found = pieces.select("hash", "piece", "id", "row", "first").join(matches, ["hash", "piece"]).select("row", at.alias("starts")).where(F.size("starts") > 0)
    starts = stage_table(found.groupBy("row").agg(F.flatten(F.collect_list("starts")).alias("starts")), "phrase-starts")
    release(pieces, matches)
    hit = stage_table(texts.select("row", "text").join(starts, "row"), "phrase-hit")
    release(texts, starts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_chunks(batches, "text"):
            removed, kept = [], []
            for text, starts in zip(raw, batch.column(2).to_pylist(), strict=True):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int64)
                starts = np.unique(np.array(starts, np.int64))
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + window, -1)
                stay = np.cumsum(gone[:-1]) == 0
                removed.append(int(len(words) - stay.sum()))
                kept.append(b" ".join(w for w, s in zip(words, stay.tolist(), strict=True) if s).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(kept)], names=["row", "n_removed", "kept_text"])

    return rows, hit.mapInArrow(tidy(cut), "row long, n_removed long, kept_text string")


def remove_repeated_phrases(docs: DataFrame, *, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_words, n_removed, kept_text.

    A word goes if a window of `window` words covers it that also starts in a
    document with a smaller id. Kept words are joined by one space. Windows are
    judged on the input.

    Windows with equal anchors meet in one shard, where those of two documents
    are confirmed and compiled into an automaton. Every stretch of every
    document around a recurring anchor, equal stretches as one, is streamed past
    its shard's automaton; other stretches hold no window that recurs.

    Null and empty texts have no words; texts shorter than a window lose none.
    Rows with the same id are not smaller than each other; null ids come after
    all others. No rows give no rows. Extra columns are ignored.
    """
    rows, changed = _changed(docs, window, id_col, text_col)
    left = rows.join(changed.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")
    return left.select(F.col("id").alias(id_col), _count().alias("n_words"), _none("n_removed").alias("n_removed"), F.coalesce("kept_text", _words()).alias("kept_text"))


def _words() -> Column:
    """The text's words joined by one space."""
    return F.array_join(F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != ""), " ")


def _count() -> Column:
    return F.regexp_count("text", F.lit("[^ \\t\\n\\x0B\\f\\r]+")).cast("long")


def _none(c: str) -> Column:
    return F.coalesce(c, F.lit(0)).cast("long")


def phrase_digests(docs: DataFrame, *, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """remove_repeated_phrases with a digest in the kept text's place; digests are taken before the join, so no text is shuffled for it."""
    rows, changed = _changed(docs, window, id_col, text_col)
    own = rows.select("id", "row", _count().alias("n_words"), F.sha2(_words(), 256).alias("own_sha256"))
    new = changed.select(F.col("row").alias("r"), "n_removed", F.sha2("kept_text", 256).alias("new_sha256"))
    return own.join(new, F.col("row") == F.col("r"), "left").select(F.col("id").alias(id_col), "n_words", _none("n_removed").alias("n_removed"), F.coalesce("new_sha256", "own_sha256").alias("kept_sha256"))
