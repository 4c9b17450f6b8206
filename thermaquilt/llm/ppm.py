"""Language-model scoring by prediction by partial matching over bytes, with escape estimation and symbol exclusion."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermaquilt.llm.common import mix64, most_frequent, stage_table, text_chunks, tidy

#: Bytes of context of the trie's deepest nodes.
ORDER = 4
#: Words whose counts go to every worker.
MOST_WORDS = 100_000
#: Shards of the trie at least, and about how many of its deepest entries each holds.
LEAST_SHARDS, SHARD_GRAMS = 24, 1 << 17
#: Bytes of text that look up their distinct numbers together.
BLOCK_BYTES = 4 << 20
#: Not a byte of UTF-8: stands before and after each text.
EDGE = 0xFF
_FLUSH = 500_000


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and its end, context and byte as one number; and where each text's numbers begin."""
    gap = bytes([EDGE]) * (order + 1)
    buf = np.frombuffer(gap[1:] + gap.join(texts) + gap, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    g = np.zeros(len(buf) - order, np.uint64)
    for i in range(order + 1):
        g <<= np.uint64(8)
        g |= buf[i : i + len(g)]
    starts = np.concatenate([[0], np.cumsum(sizes + order + 1)[:-1]])
    take = np.ones(len(g), bool)
    for j in range(order):
        at = starts[1:] - 1 - j
        take[at] = False
    return g[take][: int((sizes + 1).sum())], np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])


def gram_counts(docs: DataFrame, order: int) -> DataFrame:
    """(gram, n) over all texts: each task sums its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            k = np.concatenate([keys, *(w[0] for w in waiting)])
            c = np.concatenate([counts, *(w[1] for w in waiting)])
            by = np.argsort(k, kind="stable")
            k, c = k[by], c[by]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
            return k[first], np.add.reduceat(c, first) if len(k) else c

        for _, texts in text_chunks(batches, "text", 4 << 20):
            waiting.append(np.unique(grams(texts, order)[0], return_counts=True))
            if len(waiting) >= 8:
                keys, counts = merged()
                waiting = []
                if len(keys) > 2 * _FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["gram", "n"])
                    keys, counts = keys[:0], counts[:0]
        keys, counts = merged()
        for i in range(0, len(keys), _FLUSH):
            yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + _FLUSH].view(np.int64)), pa.array(counts[i : i + _FLUSH])], names=["gram", "n"])

    return docs.select("text").mapInArrow(tidy(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of lower-case words and of the end of text, as the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            words = list(seen)
            for i in range(0, len(words), 50_000):
                part = words[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([seen[w] for w in part], pa.int64())], names=["word", "n"])

        for _, texts in text_chunks(batches, "text"):
            for t in texts:
                seen.update(t.lower().split())
            seen[b""] += len(texts)
            if len(seen) > _FLUSH:
                yield from rows()
                seen.clear()
        yield from rows()

    return docs.select("text").mapInArrow(tidy(run), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lookup:
    """A hash table from numbers to places, probed for whole arrays at once."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 2.5))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.place = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64), np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.place[slot] < 0
            _, first = np.unique(np.where(free, slot, -1), return_index=True)
            first = first[free[first]]
            self.place[slot[first]], self.keys[slot[first]] = left[first], keys[left[first]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.place[slot].copy()
        odd = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(odd):
            slot[odd] = (slot[odd] + 1) & self.mask
            at = slot[odd]
            out[odd] = self.place[at]
            odd = odd[(out[odd] >= 0) & (self.keys[at] != keys[odd])]
        return out


class Trie:
    """Contexts of 0 to `order` bytes with their symbols' counts, ready to be looked up by level.

    Escape by method C: at a context with symbols counted T times, D of them
    distinct, a symbol seen n times has n / (T + D) and the escape D / (T + D).
    After an escape the shorter context leaves out the symbols of the longer
    one. Contexts nest, so what is left depends on the longer context alone and
    is kept with it. A shard of the trie has all entries whose contexts end in its
    pairs of bytes; `low`, the pairs of bytes of the whole trie and their counts,
    then stands for orders 0 and 1, which all shards share.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, low: tuple[np.ndarray, np.ndarray] | None = None):
        self.order, self.levels = order, []
        parent = None
        for k in range(order + 1):
            all_keys, all_counts = low if low is not None and k < 2 else (keys, counts)
            part = all_keys & np.uint64((1 << (8 * (k + 1))) - 1)
            own, at = np.unique(part, return_inverse=True)
            n = np.bincount(at, all_counts, len(own)) if len(own) else np.zeros(0)
            contexts, first, of = np.unique(own >> np.uint64(8), return_index=True, return_inverse=True)
            total, kinds = np.bincount(of, n, len(contexts)), np.bincount(of, minlength=len(contexts)).astype(float)
            level = {"grams": Lookup(own), "contexts": Lookup(contexts), "log_n": np.log10(np.maximum(n, 1e-300)), "total": total, "kinds": kinds}
            level["direct"] = level["log_n"] - np.log10(total + kinds)[of] if len(own) else n
            level["escape"] = np.log10(kinds / (total + kinds)) if len(own) else n
            if parent is not None and len(own):
                up = np.uint64((1 << (8 * k)) - 1)
                above = parent["contexts"]((contexts << np.uint64(8) & up) >> np.uint64(8)) if k > 1 else np.zeros(len(contexts), np.int32)
                shared = np.bincount(of, 10 ** parent["log_n"][parent["grams"](own & up)], len(contexts))
                left, others = np.maximum(np.round(parent["total"][above] - shared), 0), parent["kinds"][above] - kinds
                level["then"] = -np.log10(np.maximum(left + others, 1))
                level["then_escape"] = np.where(others > 0, np.log10(np.maximum(others, 1) / np.maximum(left + others, 1)), 0.0)
            parent = level
            self.levels.append({x: v.astype(np.float32) if isinstance(v, np.ndarray) and x not in ("total", "kinds") else v for x, v in level.items()})
        self.symbols = int(self.levels[0]["kinds"].sum())
        for level in self.levels:
            del level["total"], level["kinds"]

    def log10(self, g: np.ndarray) -> np.ndarray:
        """log10 of the chance of each number's last byte after its context."""
        out = np.zeros(len(g))
        left, longer = np.arange(len(g)), np.full(len(g), -1)
        for k in range(self.order, -1, -1):
            if not len(left):
                break
            level = self.levels[k]
            own = g[left] & np.uint64((1 << (8 * (k + 1))) - 1)
            at = level["grams"](own)
            hit, come = at >= 0, longer >= 0
            below = self.levels[k + 1] if k < self.order else None
            new = hit & ~come
            out[left[new]] += level["direct"][at[new]]
            old = hit & come
            if old.any():
                out[left[old]] += level["log_n"][at[old]] + below["then"][longer[old]]
            miss = ~hit
            left, own, longer = left[miss], own[miss], longer[miss]
            context = level["contexts"](own >> np.uint64(8)) if len(left) else np.zeros(0, np.int32)
            known, come = context >= 0, longer >= 0
            if come.any():
                out[left[come]] += below["then_escape"][longer[come]]
            new = known & ~come
            out[left[new]] += level["escape"][context[new]]
            longer = np.where(known, context, -1)
        out[left] -= np.log10(256 - self.symbols) if self.symbols < 256 else 0
        return out


def in_blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """The rows (id, text, learn) with the number of a block of about block_bytes of text, and a number of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        for batch, texts in text_chunks(batches, "text"):
            if size >= block_bytes:
                block, size = block + 1, 0
            size += sum(map(len, texts))
            yield batch.append_column("block", pa.array(np.full(len(texts), block)))

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"id {kind}, text string, learn boolean, block long").withColumn("row", F.monotonically_increasing_id())


def shard_of(g: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each number, by the last two bytes of its context: all orders from 2 up of a context are in one shard."""
    return (mix64(g >> np.uint64(8) & np.uint64(0xFFFF)) % np.uint64(shards)).astype(np.int64)


def _packed(block: int, shards: int, keys: np.ndarray, counts: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """A row for each shard met: (shard, block, keys, counts) with the arrays' bytes."""
    if len(keys):
        shard = shard_of(keys, shards)
        by = np.argsort(shard, kind="stable")
        names, first = np.unique(shard[by], return_index=True)
        parts = np.split(by, first[1:])
        values = [None if counts is None else counts[p].tobytes() for p in parts]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.full(len(names), block)), pa.array([keys[p].tobytes() for p in parts], pa.binary()), pa.array(values, pa.binary())], names=["shard", "block", "keys", "counts"])


def block_chances(texts: DataFrame, counts: DataFrame, order: int, shards: int) -> DataFrame:
    """(block, keys, logs): for the distinct numbers of each block of (block, text), their log10 chances under the trie of all counts (gram, n).

    Counts and asked numbers are dealt by shard, counts first, so that a task
    holds one shard of the trie at a time.
    """
    pairs = counts.groupBy(F.col("gram").bitwiseAND(0xFFFF).alias("gram")).agg(F.sum("n").alias("n")).toPandas()  # at most 65,536 rows
    low = texts.sparkSession.sparkContext.broadcast((pairs["gram"].to_numpy(np.int64).view(np.uint64), pairs["n"].to_numpy(float)))

    def deal_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append((batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size > _FLUSH:
                yield from _packed(-1, shards, *map(np.concatenate, zip(*waiting, strict=True)))
                waiting, size = [], 0
        if waiting:
            yield from _packed(-1, shards, *map(np.concatenate, zip(*waiting, strict=True)))

    def deal_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = -1, []
        for batch, part in text_chunks(batches, "text"):
            block = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if own and block[i] != now:
                    yield from _packed(now, shards, np.unique(np.concatenate(own)))
                    own = []
                now = int(block[i])
                own.append(np.unique(grams(part[i:j], order)[0]))
        if own:
            yield from _packed(now, shards, np.unique(np.concatenate(own)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counted, trie = -1, [], None
        for batch in batches:
            for i, (shard, block) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if shard != now:
                    now, counted, trie = shard, [], None
                keys = batch.column(2)[i].as_py()
                g = np.frombuffer(keys, np.uint64)
                if block < 0:
                    counted.append((g, np.frombuffer(batch.column(3)[i].as_py(), np.int64)))
                    continue
                if trie is None:
                    own, times = map(np.concatenate, zip(*counted, strict=True)) if counted else (np.zeros(0, np.uint64), np.zeros(0))
                    trie, counted = Trie(own, times.astype(float), order, low.value), []
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([keys], pa.binary()), pa.array([trie.log10(g).tobytes()], pa.binary())], names=["block", "keys", "logs"])

    packed = "shard long, block long, keys binary, counts binary"
    both = counts.mapInArrow(tidy(deal_counts), packed).union(texts.select("block", "text").mapInArrow(tidy(deal_blocks), packed))
    return both.repartition(shards, "shard").sortWithinPartitions("shard", "block").mapInArrow(tidy(look_up), "block long, keys binary, logs binary")


def score_texts(docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, most_words: int = MOST_WORDS, shard_grams: int = SHARD_GRAMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of docs: its id, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte.

    `learn` picks the rows that the models learn from; all rows are scored. The
    score is the log10 chance of the text and its end under the trie, pretrained
    on the counts of all learning texts. No count is left out: the trie is a table
    in shards of about shard_grams of its deepest entries, and a block of about
    block_bytes of text looks up each of its distinct contexts and bytes once. The base is a unigram
    model over all words: counts of at most most_words frequent words are
    broadcast, the rest are joined by word, so no count is left out.

    Null texts are empty: one token, the end. Null ids are learnt from or not as
    `learn` says; repeated rows are scored each; without learning rows only the
    smoothing is left. Extra columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    rows = stage_table(in_blocks(rows, block_bytes), "ppm-texts")
    train = rows.where("learn")
    words = stage_table(word_counts(train), "ppm-words")
    trained = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).head()
    n_all, distinct = int(trained["n"]), int(trained["v"])
    counts = stage_table(gram_counts(train, order), "ppm-grams")
    shards = max(LEAST_SHARDS, -(-counts.count() // shard_grams))
    chances = stage_table(block_chances(rows, counts, order, shards), "ppm-chances")
    common = most_frequent(words, "word", most_words)
    frequent = dict(zip(map(bytes, common["word"]), map(int, common["n"]), strict=True)) if len(common) else {}
    rare_from = min(frequent.values(), default=None)
    del common
    model = spark.sparkContext.broadcast(frequent)
    del frequent

    def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], Lookup, np.ndarray]]:
        now, parts, table, logs = None, [], None, None
        for whole in batches:
            block, with_text = whole.column(0).to_numpy(), whole.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(with_text) != 0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)], strict=True):
                if block[i] != now:
                    now, parts, table, logs = block[i], [], None, None
                piece = whole.slice(i, j - i)
                if not with_text[i]:
                    parts += zip(piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True)
                    continue
                if table is None:
                    keys, logs = (np.concatenate([np.frombuffer(p[k], kind) for p in parts]) for k, kind in enumerate((np.uint64, np.float64)))
                    table, parts = Lookup(keys), []
                for batch, texts in text_chunks([piece], "text"):
                    yield batch, texts, table, logs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = model.value
        for batch, texts, table, logs in by_block(b for b in batches if b.num_rows):
            g, starts = grams(texts, order)
            score = np.add.reduceat(logs[table(g)], starts)
            tokens, known, base, rare, rare_n = [], [], [], [], []
            for t in texts:
                own = t.lower().split()
                own.append(b"")
                found = list(map(frequent.get, own))
                tokens.append(len(own))
                if None in found:
                    other = Counter(w for w, c in zip(own, found, strict=True) if c is None)
                    rare.append(list(other))
                    rare_n.append(list(other.values()))
                    found = [c for c in found if c is not None]
                else:
                    rare.append([])
                    rare_n.append([])
                known.append(len(found))
                base.append(float(np.log10(np.array(found, float) + 0.5).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(4), batch.column(5), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(score), pa.array([len(t) for t in texts], pa.int64()), pa.array(rare, pa.list_(pa.binary())), pa.array(rare_n, pa.list_(pa.int32()))],
                names=["row", "id", "n_tokens", "n_known", "base", "score", "n_bytes", "rare", "rare_n"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"row long, id {kind}, n_tokens long, n_known long, base double, score double, n_bytes long, rare array<binary>, rare_n array<int>"
    none = lambda **types: [F.lit(None).cast(t).alias(c) for c, t in types.items()]
    tables = chances.select("block", F.lit(0).alias("with_text"), "keys", "logs", *none(row="long", id=kind, text="string"))
    both = tables.union(rows.select("block", F.lit(1).alias("with_text"), *none(keys="binary", logs="binary"), "row", "id", "text"))
    scored = stage_table(both.repartition("block").sortWithinPartitions("block", "with_text").mapInArrow(tidy(run), schema), "ppm-scored")
    rest = scored.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.rare_n").cast("long").alias("times"))
    seen = words if rare_from is None else words.where(F.col("n") <= rare_from)
    found = rest.join(seen, "word").groupBy("row").agg(F.sum("times").alias("times"), F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("logs"))
    both = scored.drop("rare", "rare_n").join(found, "row", "left")
    times, logs = F.coalesce("times", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    unknown = F.col("n_tokens") - F.col("n_known") - times
    base = F.col("base") + logs + unknown * float(np.log10(0.5)) - F.col("n_tokens") * float(np.log10(n_all + 0.5 * (distinct + 1)))
    return both.select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + times).cast("long").alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        base.alias("base_score"), "score", (-F.col("score") * float(np.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
