"""Benchmark decontamination by greedy string tiling with running Karp-Rabin."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermaquilt.llm.common import mix64, text_chunks, tidy

#: Words of a seed, and so of the shortest tile.
SEED = 5
#: Tokens of benchmark text that one pass over the documents carries in its broadcast.
BLOCK_TOKENS = 500_000
_TOKEN = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15


def tokens(text: str) -> list[str]:
    """Lower-case words of a text, without punctuation."""
    return _TOKEN.findall(text.lower())


def _sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running Karp-Rabin sums of token codes modulo 2**64, and the powers that they are shifted by."""
    up = np.full(len(x) + 1, _BASE, np.uint64)
    up[0] = 1
    up = np.multiply.accumulate(up)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(x.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)]), up


def greedy_tiles(a: list[int], b: list[int], least: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (i, j, length) that cover a with parts of b, longest first, then by place in a, then in b; no token of a or b is in two tiles.

    The length of the longest match of unmarked tokens is found by bisection, as
    a match contains shorter ones; each probe compares the rolling hashes of all
    windows at once. Then all windows of that length are marked as they come. A
    place that a tile covers stays covered, so each list of places is walked
    once, and the tokens are read a few times for each length that tiles have.
    """
    x, y = np.array(a, np.int64), np.array(b, np.int64)
    free_x, free_y = np.ones(len(x), bool), np.ones(len(y), bool)
    size = max(len(x), len(y))
    (sum_x, up), (sum_y, up_y) = _sums(x), _sums(y)
    up = up if len(up) > len(up_y) else up_y

    def windows(sums: np.ndarray, taken: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the windows of s unmarked tokens, and their hashes, all shifted to one power."""
        at = np.flatnonzero(taken[s:] == taken[: len(taken) - s]) if len(taken) > s else np.zeros(0, np.int64)
        return at, (sums[at + s] - sums[at]) * up[size - at]

    tiles, most = [], min(len(x), len(y))
    while most >= least:
        taken_x, taken_y = (np.concatenate([[0], np.cumsum(~f)]) for f in (free_x, free_y))
        low, high = least - 1, most
        while low < high:
            s = (low + high + 1) // 2
            if np.isin(windows(sum_x, taken_x, s)[1], windows(sum_y, taken_y, s)[1]).any():
                low = s
            else:
                high = s - 1
        if low < least:
            break
        (at_x, hash_x), (at_y, hash_y) = windows(sum_x, taken_x, low), windows(sum_y, taken_y, low)
        ok = np.isin(hash_y, hash_x)
        places = defaultdict(list)
        for h, j in zip(hash_y[ok].tolist(), at_y[ok].tolist(), strict=True):
            places[h].append(j)
        walked = dict.fromkeys(places, 0)
        end_x, ends_y = -1, np.zeros(len(y) + 1, np.int64)  # end of the last tile in x; by place in y, whether a tile of this length covers it
        for h, i in zip(hash_x.tolist(), at_x.tolist(), strict=True):
            if i < end_x or h not in places:
                continue
            own, k = places[h], walked[h]
            while k < len(own) and (ends_y[own[k]] or ends_y[own[k] + low - 1]):
                k += 1
            walked[h] = k
            if k < len(own):
                j = own[k]
                ends_y[j : j + low] = 1
                end_x = i + low
                free_x[i : i + low] = False
                free_y[j : j + low] = False
                tiles.append((i, j, low))
        most = low - 1
    return tiles


def matches(items: list[tuple], threshold: float) -> Callable[[list[bytes]], Iterator[tuple]]:
    """A function from texts to (place in the list, item, tiles, covered, tokens of the item, coverage) for each text that tiles `threshold` of an item."""
    code: dict[str, int] = {}
    coded = [(item, [code.setdefault(w, len(code) + 1) for w in ws]) for item, ws in items]
    seeds = defaultdict(set)
    for k, (_, ws) in enumerate(coded):
        for g in zip(*(ws[i:] for i in range(SEED)), strict=False):
            seeds[g].add(k)
    no_seed = seeds.keys().isdisjoint

    def find(texts: list[bytes]) -> Iterator[tuple]:
        for row, raw in enumerate(texts):
            words = list(map(code.get, tokens(raw.decode("utf-8", "replace"))))
            if no_seed(zip(*(words[i:] for i in range(SEED)), strict=False)):
                continue
            stretches = defaultdict(list)
            for j, g in enumerate(zip(*(words[i:] for i in range(SEED)), strict=False)):
                for k in seeds.get(g, ()):
                    own = stretches[k]
                    if own and own[-1][1] >= j:
                        own[-1][1] = j + SEED
                    else:
                        own.append([j, j + SEED])
            for k, own in stretches.items():
                item, a = coded[k]
                if sum(end - begin for begin, end in own) < threshold * len(a):
                    continue
                b = []
                for begin, end in own:
                    b += [*words[begin:end], 0]
                tiles = greedy_tiles(a, b)
                covered = sum(n for _, _, n in tiles)
                if covered >= threshold * len(a):
                    yield row, item, len(tiles), covered, len(a), covered / len(a)

    return find


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, block_tokens: int) -> Iterator[Broadcast]:
    """The benchmark's items and tokens in blocks of at most about block_tokens tokens, each a broadcast."""
    items = benchmark.select(F.col(item_id).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    total = items.select(F.coalesce(F.sum(F.length("text")), F.lit(0))).head()[0] // 4
    blocks = max(1, math.ceil(total / block_tokens))
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("text", "item"), F.lit(blocks)) == block)
        yield benchmark.sparkSession.sparkContext.broadcast([(r["item"], tokens(r["text"])) for r in part.toLocalIterator()])


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(id, item_id, n_tiles, covered, item_tokens, coverage) for each document that tiles at least `threshold` of a benchmark item.

    Seeds of SEED words shared with an item pick the stretches of a document
    that can hold a tile; greedy string tiling then covers the item with the
    longest matches first, so passages in another order count in full.
    The benchmark goes to the workers in blocks of at most about block_tokens
    tokens, one pass over the documents for each block: a larger benchmark means
    more passes, not a larger broadcast. Documents are handled one by one, with
    no shuffle, so common passages make no hot group.

    Null and empty texts have no matches; very long ones are searched whole.
    Items with fewer than SEED words can't be told from common phrases and match
    nothing. Of equally long matches the first in the item, then the first in
    the document is taken. Repeated documents or items each give their own rows;
    null ids are carried; no documents or items give no rows; extra columns are
    ignored.
    """
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    schema = f"id {kinds[0]}, item {kinds[1]}, n_tiles long, covered long, item_tokens long, coverage double"
    item_kind = {"bigint": pa.int64(), "int": pa.int32()}.get(kinds[1], pa.string())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def one_pass(carried: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = matches(carried.value, threshold)
            for batch, texts in text_chunks(batches, "text"):
                out = list(find(texts))
                at = pa.array([o[0] for o in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), pa.array([o[1] for o in out], item_kind), *(pa.array([o[c] for o in out], pa.int64()) for c in (2, 3, 4)), pa.array([o[5] for o in out], pa.float64())],
                    names=["id", "item", "n_tiles", "covered", "item_tokens", "coverage"],
                )

        return rows.mapInArrow(tidy(run), schema)

    passes = [one_pass(b) for b in _blocks(benchmark, item_id, item_text, block_tokens)]
    out = passes[0]
    for other in passes[1:]:
        out = out.unionByName(other)
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item", "item_id")


def drop_contamination(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.5, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The rows of docs, with all their columns, that find_contamination does not report.

    Each row is judged by its own text in the pass that reads it, without ids
    and without a join, so rows with null or repeated ids are judged apart. A
    benchmark of several blocks is a chain of passes over what is left.
    """
    for carried in _blocks(benchmark, item_id, item_text, block_tokens):

        def run(batches: Iterator[pa.RecordBatch], carried: Broadcast = carried) -> Iterator[pa.RecordBatch]:
            find = matches(carried.value, threshold)
            for batch, texts in text_chunks(batches, text_col):
                stay = np.ones(len(texts), bool)
                stay[[o[0] for o in find(texts)]] = False
                yield batch.filter(pa.array(stay))

        docs = docs.mapInArrow(tidy(run), docs.schema)
    return docs
