"""Toxicity by a chain of linear models: each category's model also sees the probabilities of those before it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from thermaquilt.llm.common import give_back, release, stage_table, text_chunks, tidy

#: Words whose hashes a worker remembers.
CACHED_WORDS = 500_000
_PUNCT = b".,;:!?\"'()[]{}<>|*#%&$"


@dataclass(frozen=True)
class ChainSettings:
    """max_rows bounds the labelled rows that are fitted on; max_words bounds the vocabulary of each category."""

    max_rows: int = 10_000
    max_words: int = 2_000
    least_documents: int = 5
    folds: int = 3
    rounds: int = 300
    ridge: float = 0.5


def words_of(text: bytes) -> set[bytes]:
    """Distinct lower-case words without marks at their ends, and the beginnings of the longer ones, which inflected forms share."""
    words = {w.strip(_PUNCT) for w in text.lower().split()}
    return words | {b"^" + w[:4] for w in words if len(w) > 4} | {b"^" + w[:7] for w in words if len(w) > 7}


def features_of(text: bytes) -> np.ndarray:
    """64-bit hashes of words_of(text), in order."""
    return np.sort(np.fromiter(map(xxh3_64_intdigest, words_of(text)), np.uint64).view(np.int64))


def _fit(rows: list[np.ndarray], extra: np.ndarray, y: np.ndarray, width: int, s: ChainSettings) -> np.ndarray:
    """Ridge logistic regression over sets of present words and extra columns, by accelerated gradient steps. Last weight: bias."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    of = np.repeat(np.arange(len(rows)), sizes)
    w = np.zeros(width + extra.shape[1] + 1)
    rate = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    w[-1] = np.log(rate / (1 - rate))
    z, t = w.copy(), 1.0
    seen = np.bincount(flat, minlength=width)[:width]
    scale = np.concatenate([1 / (s.ridge + np.maximum(seen, 1.0)), 1 / (s.ridge + (extra**2).sum(0) + 1e-9), [1 / len(y)]])
    step = scale * 4 / (1 + max(float(np.median(sizes)) if len(sizes) else 1.0, 1.0) ** 0.5)
    for _ in range(s.rounds):
        m = np.bincount(of, z[flat], len(rows)) + extra @ z[width:-1] + z[-1]
        g = 1 / (1 + np.exp(-np.clip(m, -40, 40))) - y
        grad = np.concatenate([np.bincount(flat, g[of], width)[:width], extra.T @ g, [g.sum()]])
        grad[:-1] += s.ridge * z[:-1]
        new = z - step * grad
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        z, w = new + (old - 1) / t * (new - w), new
    return w


def _chances(w: np.ndarray, rows: list[np.ndarray], extra: np.ndarray) -> np.ndarray:
    width = len(w) - extra.shape[1] - 1
    m = np.fromiter((w[r].sum() for r in rows), float, len(rows)) + extra @ w[width:-1] + w[-1]
    return 1 / (1 + np.exp(-np.clip(m, -40, 40)))


def fit_chain(labelled: list[tuple[np.ndarray, tuple[int, ...]]], categories: list[str], s: ChainSettings = ChainSettings()) -> dict:  # noqa: B008
    """The chain's models from (features_of each text, a 0 or 1 for each category).

    For each category in turn: choose its words by chi-square, fit it on them
    and on the earlier categories' probabilities, and add its own out-of-fold
    probabilities for those that follow. A category with one class only is a
    constant.
    """
    n = len(labelled)
    of = np.repeat(np.arange(n), [len(t) for t, _ in labelled])
    names, flat, seen = np.unique(np.concatenate([*(t for t, _ in labelled), np.zeros(0, np.int64)]), return_inverse=True, return_counts=True)
    common = np.flatnonzero(seen >= s.least_documents)
    place = np.full(len(names), -1)
    place[common] = np.arange(len(common))
    flat, names, seen = place[flat], names[common], seen[common]
    of, flat = of[flat >= 0], flat[flat >= 0]
    rows = np.split(flat, np.searchsorted(of, np.arange(1, n))) if n else []
    fold = np.arange(n) % s.folds
    extra = np.zeros((n, 0))
    models = []
    for k, name in enumerate(categories):
        y = np.array([c[k] for _, c in labelled], float)
        if n == 0 or y.min() == y.max():
            models.append({"name": name, "words": {}, "weights": None, "constant": float(y.mean()) if n else 0.0})
            extra = np.column_stack([extra, np.full(n, models[-1]["constant"])])
            continue
        both = np.bincount(flat, y[of], len(names))
        expect = seen * y.mean()
        chi = (both - expect) ** 2 / np.maximum(expect * (1 - y.mean()) * (1 - seen / n), 1e-9)
        chosen = np.argsort(-chi, kind="stable")[: s.max_words]
        chosen = chosen[chi[chosen] > 0]
        place = np.full(len(names), -1)
        place[chosen] = np.arange(len(chosen))
        own = [(p := place[r])[p >= 0] for r in rows]
        held = np.zeros(n)
        for f in range(s.folds):
            a, b = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if len(a) and len(b):
                held[b] = _chances(_fit([own[i] for i in a], extra[a], y[a], len(chosen), s), [own[i] for i in b], extra[b])
        models.append({"name": name, "words": {int(names[c]): i for i, c in enumerate(chosen)}, "weights": _fit(own, extra, y, len(chosen), s), "constant": 0.0})
        extra = np.column_stack([extra, held])
    return {"categories": categories, "models": models, "out_of_fold": extra}


def training_table(docs: DataFrame, labels: DataFrame, categories: list[str], s: ChainSettings, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features, c0, c1, ...) of at most max_rows labelled texts, chosen by a hash of the id, the same on every run; rows with a null label are left out."""
    full = labels.dropna(subset=[id_col, *categories]).groupBy(id_col).agg(*[F.max(c).cast("int").alias(f"label_{i}") for i, c in enumerate(categories)])
    key = F.md5(F.col(id_col).cast("string").cast("binary"))
    named = [f"label_{i}" for i in range(len(categories))]
    picked = full.orderBy(key, id_col).limit(s.max_rows).select(F.col(id_col).alias("label_id"), *named)
    # At most max_rows small rows are broadcast.
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(picked), F.col("id") == F.col("label_id")).select("id", "text", *named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "text"):
            features = pa.array([features_of(t).tobytes() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), features, *(batch.column(2 + i) for i in range(len(categories)))], names=["id", "features", *(f"c{i}" for i in range(len(categories)))])

    classes = [f"c{i}" for i in range(len(categories))]
    kept = rows.mapInArrow(tidy(run), "id string, features binary, " + ", ".join(f"{c} int" for c in classes))
    # Of several texts with one id the least features count.
    return stage_table(kept.groupBy("id").agg(F.min(F.struct("features", *classes)).alias("r")).select("id", "r.*"), "toxicity-rows")


def chosen_words(rows: DataFrame, categories: list[str], s: ChainSettings) -> np.ndarray:
    """The words of all categories: of each the max_words that tell most by chi-square, counted by the executors. At most max_words a category reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            words, at = np.unique(np.concatenate([*parts, np.zeros(0, np.int64)]), return_inverse=True)
            sums = [np.bincount(at, minlength=len(words))] + [np.bincount(at, batch.column(2 + i).to_numpy()[of], len(words)) for i in range(len(categories))]
            yield pa.RecordBatch.from_arrays([pa.array(words), *(pa.array(x.astype(np.int64)) for x in sums)], names=["word", "seen", *(f"b{i}" for i in range(len(categories)))])

    both = [f"b{i}" for i in range(len(categories))]
    counts = rows.mapInArrow(tidy(count), "word long, seen long, " + ", ".join(f"{b} long" for b in both)).groupBy("word").agg(*[F.sum(c).alias(c) for c in ("seen", *both)])
    counts = stage_table(counts.where(F.col("seen") >= s.least_documents), "toxicity-words")
    total = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"c{i}").alias(f"c{i}") for i in range(len(categories))]).head()
    chosen = [np.zeros(0, np.int64)]
    for i, b in enumerate(both):
        rate = total[f"c{i}"] or 0.0
        if not 0 < rate < 1:
            continue
        expect = F.col("seen") * rate
        chi = (F.col(b) - expect) ** 2 / F.greatest(expect * (1 - rate) * (1 - F.col("seen") / total["n"]), F.lit(1e-9))
        best = counts.select("word", chi.alias("chi")).where("chi > 0").orderBy(F.desc("chi"), "word").limit(s.max_words)
        chosen.append(best.select("word").toPandas()["word"].to_numpy(np.int64))
    release(counts)
    return np.unique(np.concatenate(chosen))


def training_rows(table: DataFrame, words: np.ndarray, categories: list[str]) -> list[tuple[np.ndarray, tuple[int, ...]]]:
    """The labelled rows with their features among `words`, in order of id."""
    carried = table.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [np.intersect1d(np.frombuffer(x, np.int64), carried.value, assume_unique=True).tobytes() for x in batch.column(1).to_pylist()]
            yield batch.set_column(1, "features", pa.array(kept, pa.binary()))

    classes = [f"c{i}" for i in range(len(categories))]
    rows = [(r["id"], bytes(r["features"]), tuple(r[c] for c in classes)) for r in table.mapInArrow(tidy(run), table.schema).toLocalIterator()]
    carried.destroy()
    return [(np.frombuffer(f, np.int64), c) for _, f, c in sorted(rows)]


def score_chain(docs: DataFrame, chain: dict, *, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns `keep` of every row and a probability p_<category> for each category, from the whole text; null text as empty."""
    model = docs.sparkSession.sparkContext.broadcast(chain["models"])
    names = [f"p_{c}" for c in chain["categories"]]
    scored = text_col if text_col in keep else "text to score"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch, texts in text_chunks(batches, scored):
            sets = []
            for t in texts:
                words = words_of(t)
                codes = list(map(known.get, words))
                if None in codes:
                    if len(known) > CACHED_WORDS:
                        known.clear()
                    codes = [known.setdefault(w, xxh3_64_intdigest(w) - ((xxh3_64_intdigest(w) >> 63) << 64)) for w in words]
                sets.append(set(codes))
            extra = np.zeros((len(sets), 0))
            for m in model.value:
                if m["weights"] is None:
                    p = np.full(len(sets), m["constant"])
                else:
                    at = m["words"]
                    p = _chances(m["weights"], [np.fromiter(map(at.__getitem__, sorted(x & at.keys())), np.int64) for x in sets], extra)
                extra = np.column_stack([extra, p])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *(pa.array(extra[:, i]) for i in range(len(names)))], names=[*keep, *names])

    rows = docs.select(*[F.col(c) for c in keep], *([] if text_col in keep else [F.col(text_col).alias(scored)]))
    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(n, T.DoubleType()) for n in names)])
    return rows.mapInArrow(tidy(run), schema)


def judge_toxicity(docs: DataFrame, labels: DataFrame, *, categories: tuple[str, ...] = ("quality", "toxic"), verdict: str = "toxic", threshold: float = 0.5, keep: tuple[str, ...] = ("doc_id",), settings: ChainSettings = ChainSettings()) -> DataFrame:  # noqa: B008
    """Every row of docs with the chain's probabilities and the boolean is_toxic. A column of `keep` with one of these names is left out.

    `categories` are columns of labels, any number of them in the chain's order;
    the given tables label two. The models are fitted on at most
    settings.max_rows labelled rows, with at most settings.max_words words each,
    so what is broadcast and what reaches the driver is bounded; all rows are
    scored in one pass without a shuffle, whole texts however long. Words with
    equal chi-square are taken in order of their hashes. Null and empty texts
    have no words and get the models' bias. Without labels every probability is
    0, as for a category whose labels are all 0. Repeated rows are scored alike;
    no rows give no rows; extra columns of either table are ignored unless named
    in `keep`.
    """
    table = training_table(docs, labels, list(categories), settings)
    chain = fit_chain(training_rows(table, chosen_words(table, list(categories), settings), list(categories)), list(categories), settings)
    release(table)
    give_back()
    made = {"is_toxic", *(f"p_{c}" for c in categories)}
    scored = score_chain(docs, chain, keep=tuple(c for c in keep if c not in made))
    return scored.withColumn("is_toxic", F.col(f"p_{verdict}") >= threshold)
