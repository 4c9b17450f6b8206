"""Recurring stretches of text: minimizer anchors, and the pieces around anchors that occur twice or more.

A window is n consecutive units (words or bytes) of one document. Each window
has an anchor, the least-hashed gram of g units inside it, so equal windows have
equal anchors. A piece is the run of windows with one anchor: windows that are
equal anywhere are in pieces of the same anchor hash. Only windows whose anchors
all occur twice or more can recur, and only their pieces are cut out, compared
and located.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from thermaquilt.llm.common import concat, gram_hash, prefix_hash, span_hash, stage_table, text_chunks, tidy, window_minimum, word_spans

#: Hashes with so many different pieces, or more, are hot: their pieces are dealt by content, not by anchor.
HOT_PIECES = 1000
#: Content of whole groups that are solved at a time; more gains nothing, as it leaves the processor's cache.
SOLVE_BYTES = 3 << 19
#: Text of a chunk, about: what a task holds when hashes are counted.
DEAL_BYTES = 8 << 20
#: A table of hot hashes is broadcast up to so many rows, else joined by hash.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Units:
    """n units make a window, g of them an anchor's gram.

    Stretches of `inner` units have anchors too. A window can recur only if the
    anchors of all stretches inside it do, so the smaller inner is, the fewer
    windows are left to compare, and the more anchors are counted.
    """

    n: int
    g: int
    words: bool
    inner: int


@dataclass
class Anchors:
    """Of several texts: unit starts and ends in buf (words only), first unit of each text, and by window (inner or whole) its text, place and anchor."""

    buf: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    sizes: np.ndarray

    def windows(self, length: int, u: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place in the text, and place of the anchor for every stretch of `length` units of texts with a window."""
        best = window_minimum(self.hashes, length - u.g + 1)
        count = np.where(self.sizes >= u.n, self.sizes - length + 1, 0)
        of = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        return of, at, best[np.repeat(self.first, count) + at]


def anchors(texts: list[bytes], u: Units) -> Anchors:
    buf, starts, ends = concat(texts)
    if u.words:
        begin, end = word_spans(buf)
        first, last = np.searchsorted(begin, starts), np.searchsorted(begin, ends)
        hashes = gram_hash(span_hash(prefix_hash(buf), begin, end), u.g)
    else:
        begin = end = np.zeros(0, np.int64)
        first, last = starts, ends
        at = np.arange(max(len(buf) - u.g + 1, 0))
        hashes = span_hash(prefix_hash(buf), at, at + u.g)
    return Anchors(buf, begin, end, first, hashes, last - first)


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where any of the keys changes."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def unique_rows(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, row, text, rest): row is the id where ids are unique and not null, else a number that a staged copy of the table holds; rest holds the columns `keep`."""
    rest = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), rest.alias("rest"))
    odd = rows.groupBy("id").count().where("id is null or count > 1").head(1)
    if not odd:
        return rows.withColumn("row", F.col("id"))
    return stage_table(rows.withColumn("row", F.monotonically_increasing_id()), "rows")


def recurring_texts(rows: DataFrame, u: Units, other_document: bool) -> DataFrame:
    """(id, row, text, hashes, firsts, counts): the rows with pieces of anchors that recur; by piece its anchor's hash, first window and windows.

    other_document: only anchors that occur in two rows or more count.
    Texts are dealt to chunks of about DEAL_BYTES. A chunk sends its distinct
    hashes as one packed list for each bucket of hashes, and each bucket sends
    the chunk those back that recur. So a hash in a third of all rows costs each
    chunk 8 bytes, and no row travels for an anchor.
    """
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).head()["bytes"]
    chunks = int(size) // DEAL_BYTES + 1
    dealt = rows.select("id", "row", "text", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk"))

    def send(table: pa.Table) -> pa.Table:
        parts = []
        for _, texts in text_chunks(table.to_batches(), "text"):
            a = anchors(texts, u)
            of, _, where = a.windows(u.inner, u)
            head = _heads(of, where)
            of, h = of[head], a.hashes[where[head]]
            by = np.lexsort((h, of))
            of, h = of[by], h[by]
            head = _heads(of, h)
            # Each text's distinct hashes, and how often they occur there.
            parts.append((h[head], np.diff(np.append(head, len(h)))))
        own, at, pairs = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True, return_counts=True)
        many = pairs > 1 if other_document else np.bincount(at, np.concatenate([t for _, t in parts]), len(own)) > 1
        bucket = (own % np.uint64(chunks)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        cut = np.append(_heads(bucket[by]), len(by)) if len(by) else np.zeros(1, np.int64)
        own, many, bucket = own[by], many[by], bucket[by]
        spans = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
        chunk = table["chunk"][0].as_py()
        return pa.table(
            [pa.array(bucket[cut[:-1]], pa.int32()), pa.array([chunk] * len(spans), pa.int32()), pa.array([own[i:j].tobytes() for i, j in spans], pa.binary()), pa.array([many[i:j].tobytes() for i, j in spans], pa.binary())],
            names=["bucket", "chunk", "hashes", "many"],
        )

    def meet(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        own, at = np.unique(np.concatenate(lists), return_inverse=True)
        again = np.bincount(at, 1 + np.concatenate([np.frombuffer(x, bool) for x in table["many"].to_pylist()]), len(own))[at] > 1
        cut = np.cumsum([0, *map(len, lists)])
        back = [x[again[i:j]].tobytes() for x, i, j in zip(lists, cut[:-1], cut[1:], strict=True)]
        return pa.table([table["chunk"], pa.array(back, pa.binary())], names=["chunk", "known"])

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        known = np.sort(np.frombuffer(b"".join(right["known"].to_pylist()), np.uint64))
        names = ["id", "row", "text", "hashes", "firsts", "counts"]
        out = [pa.table([*(pa.array([], left.schema.field(c).type) for c in names[:3]), *(pa.array([], pa.list_(k)) for k in (pa.int64(), pa.int32(), pa.int32()))], names=names)]
        for batch, raw in text_chunks(left.to_batches(), "text") if len(known) else ():
            of, h, at, count = _places(anchors(raw, u), len(raw), known, u)
            if len(of):
                head = _heads(of)
                edge = pa.array(np.append(head, len(of)), pa.int32())
                own = batch.take(pa.array(of[head]))
                lists = (pa.ListArray.from_arrays(edge, pa.array(x, k)) for x, k in ((h.view(np.int64), pa.int64()), (at, pa.int32()), (count, pa.int32())))
                out.append(pa.table([*(own[c] for c in names[:3]), *lists], names=names))
        return pa.concat_tables(out)

    sent = dealt.groupBy("chunk").applyInArrow(tidy(send), "bucket int, chunk int, hashes binary, many binary")
    back = sent.groupBy("bucket").applyInArrow(tidy(meet), "chunk int, known binary")
    return stage_table(dealt.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(tidy(find), "id long, row long, text string, hashes array<long>, firsts array<int>, counts array<int>"), "recurring-texts")


def _places(a: Anchors, texts: int, known: np.ndarray, u: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash, first window and windows of each piece whose anchors are all among the sorted hashes `known`."""
    of, _, where = a.windows(u.inner, u)
    head = _heads(of, where)
    own = a.hashes[where[head]]
    ok = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own
    odd = np.concatenate([[0], np.cumsum(np.repeat(~ok, np.diff(np.append(head, len(of)))))])
    inner_first = np.searchsorted(of, np.arange(texts))
    of, at, where = a.windows(u.n, u)
    begin = inner_first[of] + at
    good = odd[begin + u.n - u.inner + 1] == odd[begin]
    of, at, where = of[good], at[good], where[good]
    head = _heads(of, where, at - np.arange(len(at)))
    return of[head], a.hashes[where[head]], at[head], np.diff(np.append(head, len(of)))


def _pieces(batch: pa.RecordBatch, raw: list[bytes], u: Units, asked: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Text, hash, first window, windows and content of the pieces that the batch lists; `asked`: by text, only those of these hashes."""
    of = np.repeat(np.arange(len(raw)), batch["hashes"].value_lengths().to_numpy(zero_copy_only=False))
    h, at, count = (batch[c].flatten().to_numpy(zero_copy_only=False) for c in ("hashes", "firsts", "counts"))
    if asked is not None:
        cut = np.searchsorted(of, np.arange(len(raw) + 1))
        ok = np.concatenate([np.zeros(0, bool), *(np.isin(h[cut[k] : cut[k + 1]], x) for k, x in enumerate(asked))])
        of, h, at, count = of[ok], h[ok], at[ok], count[ok]
    if u.words:
        buf, starts, _ = concat(raw)
        begin, end = word_spans(buf)
        i = np.searchsorted(begin, starts)[of] + at
        text = buf.tobytes()
        contents = [b" ".join(text[x:y].split()) for x, y in zip(begin[i].tolist(), end[i + count + u.n - 2].tolist(), strict=True)]
    else:
        contents = [raw[k][x : x + n] for k, x, n in zip(of.tolist(), at.tolist(), (count - 1 + u.n).tolist(), strict=True)]
    return of, h, at, count, contents


def _names(contents: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, contents), np.uint64, len(contents)).view(np.int64)


def cut_pieces(texts: DataFrame, u: Units, content: bool = True) -> DataFrame:
    """(hash, piece, id, row, first, windows, content) of each piece of recurring anchors; `piece` is a hash of the content, which may be left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_chunks(batches, "text"):
            of, h, at, count, contents = _pieces(batch, raw, u)
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(_names(contents)), batch["id"].take(take), batch["row"].take(take), pa.array(at.astype(np.int32)), pa.array(count.astype(np.int32)), *([pa.array(contents, pa.binary())] if content else [])],
                names=["hash", "piece", "id", "row", "first", "windows", *(["content"] if content else [])],
            )

    return texts.mapInArrow(tidy(run), "hash long, piece long, id long, row long, first int, windows int" + ", content binary" * content)


def sent_pieces(texts: DataFrame, u: Units) -> DataFrame:
    """(hash, piece, content, low, high) of the pieces that each row of recurring_texts and `asked` (a list of hash, piece, low, high) is asked for, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_chunks(batches, "text"):
            lists = [[tuple(x.values()) for x in row] for row in batch["asked"].to_pylist()]
            asked = [{piece: (low, high) for _, piece, low, high in x} for x in lists]
            of, h, _, _, contents = _pieces(batch, raw, u, [[x[0] for x in row] for row in lists])
            out = []
            for k, key, name, c in zip(of.tolist(), h.tolist(), _names(contents).tolist(), contents, strict=True):
                span = asked[k].pop(name, None)
                if span:
                    out.append((key, name, c, *span))
            kinds = pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=["hash", "piece", "content", "low", "high"])

    return texts.mapInArrow(tidy(run), "hash long, piece long, content binary, low long, high long")


def different_pieces(pieces: DataFrame) -> DataFrame:
    """(hash, piece, content, low, high, n): equal pieces as one, with their ids' range and number."""
    order = F.coalesce("id", F.lit((1 << 63) - 1))
    return pieces.groupBy("hash", "piece", "content").agg(F.min(order).alias("low"), F.max(order).alias("high"), F.count(F.lit(1)).alias("n"))


def by_anchor(different: DataFrame, solve: Callable, schema: str) -> tuple[DataFrame, DataFrame]:
    """solve over groups of all pieces with one anchor hash; and the pieces of hot hashes, which `solve` does not get.

    solve takes lists of rows (hash, piece, content, low, high, ...), several whole
    groups at a time, and returns Arrow batches.
    """
    hot = stage_table(different.groupBy("hash").agg(F.count(F.lit(1)).alias("pieces")).where(F.col("pieces") >= HOT_PIECES).select("hash"), "hot-hashes")
    small = hot.count() <= BROADCAST_ROWS
    hot = F.broadcast(hot) if small else hot
    calm = different.join(hot, "hash", "left_anti").repartition("hash").sortWithinPartitions("hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > SOLVE_BYTES and row[0] != waiting[-1][0]:
                    yield from solve(waiting)
                    waiting, size = [], 0
                waiting.append(row)
                size += len(row[2])
        if waiting:
            yield from solve(waiting)

    return calm.mapInArrow(tidy(run), schema), different.join(hot, "hash", "left_semi")
