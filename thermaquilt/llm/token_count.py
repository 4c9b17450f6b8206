"""Token counts by a map-side two-tier lookup: no pre-token is shuffled."""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from thermaquilt.llm.common import text_chunks, tidy

#: The splitting pattern of byte-level BPE, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes agree in the splitting pattern's engine and in the library; a text with any other goes to the library whole.
PLAIN = "\x00-\u0557\u1e00-\u1eff\u2010-\u2064\u20a0-\u20bf\u2190-\u23ff\u3000-\u303f\u3041-\u3096\u30a0-\u30ff\u4e00-\u9ffc\uac00-\ud7a3\uff01-\uffbe"
#: Entries that a worker's own cache may hold before it is emptied.
CACHE_ENTRIES = 400_000
#: Pre-tokens longer than this are encoded but not cached.
CACHED_CHARS = 64


def plain_pattern() -> str:
    """PATTERN for the standard engine, half the time: its classes written out for the characters of PLAIN, the only ones that it meets."""
    import regex

    chars = "".join(filter(regex.compile(f"[{PLAIN}]").match, map(chr, range(0x10000))))

    def ranges(kind: str) -> str:
        codes = np.array([ord(c) for c in regex.findall(kind, chars)])
        ends = np.flatnonzero(np.diff(codes) > 1)
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(codes[np.append(0, ends + 1)].tolist(), codes[np.append(ends, len(codes) - 1)].tolist(), strict=True))

    letter, digit, space = map(ranges, (r"\p{L}", r"\p{N}", r"\s"))
    return f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+"


def frequent_lengths(path: str) -> dict[str, int]:
    """Tier one: each vocabulary entry that is one whole pre-token, with its token count. The vocabulary bounds its size."""
    import regex
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    split = regex.compile(PATTERN)
    words = [tok.decode([i]) for i in range(tok.get_vocab_size())]
    words = [w for w in words if w and "�" not in w and split.fullmatch(w) and split.findall(w) == [w]]
    counts = [len(e.ids) for e in tok.encode_batch(words, add_special_tokens=False)]
    return dict(zip(words, counts, strict=True))


def count_tokens(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row, equal to the library's count without added begin or end tokens.

    `path` is a byte-level BPE file of the tokenizers library, present on every
    worker. Text is split as the library splits it; a pre-token's length comes
    from the broadcast table of frequent pre-tokens, else from the worker's
    cache, else from the library. Special strings inside a text count as one
    token each, as is the library's default.
    Null text counts as empty (0 bytes, 0 tokens); null ids, repeated rows and
    extra columns are kept apart: one output row for each input row.
    """
    spark = df.sparkSession
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError("count_tokens needs a byte-level BPE file without prefix space or normalizer")
    specials = [t["content"] for t in spec.get("added_tokens", [])]
    table = spark.sparkContext.broadcast(frequent_lengths(path))
    plain = plain_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import regex
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        find = re.compile(plain).findall
        cut = regex.compile("|".join(map(regex.escape, specials))).split if specials else None
        other = regex.compile(f"[^{PLAIN}]").search
        first = table.value
        cache: dict[str, int] = {}

        def missing(words: set[str]) -> dict[str, int]:
            words = list(words)
            found = dict(zip(words, (len(e.ids) for e in tok.encode_batch(words, add_special_tokens=False)), strict=True))
            if len(cache) + len(found) > CACHE_ENTRIES:
                cache.clear()
            cache.update((w, n) for w, n in found.items() if len(w) <= CACHED_CHARS)
            return found

        def split(text: str) -> tuple[int, list[str]]:
            """Tokens that need no look-up, and the pre-tokens that do."""
            if not text.isascii() and other(text):
                return len(tok.encode(text, add_special_tokens=False).ids), []
            if cut and any(s in text for s in specials):
                parts = cut(text)
                return len(parts) - 1, [w for p in parts for w in find(p)]
            return 0, find(text)

        def count(texts: list[str]) -> np.ndarray:
            """A chunk's texts together: the library takes all its new pre-tokens in one call, which costs less than half of a call a text."""
            counted, words = zip(*map(split, texts), strict=True)
            flat = list(chain.from_iterable(words))
            lengths = list(map(first.get, flat))
            rest = [i for i, n in enumerate(lengths) if n is None]
            two = list(map(cache.get, map(flat.__getitem__, rest)))
            if None in two:
                found = missing({flat[i] for i, n in zip(rest, two, strict=True) if n is None})
                two = [found[flat[i]] if n is None else n for i, n in zip(rest, two, strict=True)]
            for i, n in zip(rest, two, strict=True):
                lengths[i] = n
            sums = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))])
            ends = np.cumsum([0, *map(len, words)])
            return sums[ends[1:]] - sums[ends[:-1]] + np.array(counted, np.int64)

        for batch, texts in text_chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(count([t.decode("utf-8", "replace") for t in texts]), pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    out = rows.mapInArrow(tidy(run), f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_col)
