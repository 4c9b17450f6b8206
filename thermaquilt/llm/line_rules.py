"""Line-first cleaning: rules judge each line, failing lines go, documents that lose too much go."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from thermaquilt.llm.common import text_chunks, tidy

#: Phrases of boilerplate lines, matched in lower case.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "use of cookies", "uses cookies", "privacy policy", "terms of use", "terms of service", "terms and conditions",
    "enable javascript", "javascript is disabled", "lorem ipsum", "copyright (c)", "©",
    "click here", "sign up for", "subscribe to our", "log in to", "skip to content", "powered by",
)
_SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """Parameters. prose_words: a line so long may end without a mark. max_lost: share of a document's words that may go with its failing lines."""

    terminal: str = ".!?…\"'”’»:;)。！？"
    prose_words: int = 20
    max_odd_words: float = 0.3
    min_menu_marks: int = 3
    max_menu_share: float = 0.15
    max_lost: float = 0.4
    min_words: int = 10
    window: int = 5
    max_repeat_percent: int = 20


def judge_line(line: str, rules: LineRules) -> str | None:
    """The rule that a line fails: punctuation, navigation or boilerplate; none for a good line or one without words."""
    words = line.split()
    if not words:
        return None
    marks = sum(w in ("|", "»", "›", "·", "•", ">", "/", "::") for w in words)
    if marks >= rules.min_menu_marks and marks > rules.max_menu_share * len(words):
        return "navigation"
    low = line.lower()
    if any(p in low for p in BOILERPLATE):
        return "boilerplate"
    if len(words) < rules.prose_words and line.rstrip()[-1] not in rules.terminal:
        return "punctuation"
    if any(s in line for s in ("!!", "??", "##", "**", "$$", "%%", "&&", "||", "<<", ">>")):
        odd = sum(any(s in w for s in ("!!", "??", "##", "**", "$$", "%%", "&&", "||", "<<", ">>")) for w in words)
        if odd > rules.max_odd_words * len(words):
            return "punctuation"
    return None


def repeated_words(words: list[bytes], n: int) -> int:
    """Words covered by windows of n words that occur twice or more, the first included."""
    if len(words) <= n:
        return 0
    grams = list(zip(*(words[i:] for i in range(n)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    seen, covered, end = Counter(grams), 0, 0
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered += i + n - max(i, end)
            end = i + n
    return covered


def clean_lines(df: DataFrame, rules: LineRules = LineRules(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008
    """One row per input row: the base counts, words lost by rule, the verdict and the text without its failing lines.

    Words are runs without ASCII white space, lines are cut at \\n. A line
    without words stays. Null and empty texts have no words, fail the base rule
    and keep an empty text. Repeated rows are judged alike, null ids are kept,
    extra columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "text"):
            out: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_punctuation", "lost_navigation", "lost_boilerplate", "clean_text")}
            for raw in texts:
                words = raw.split()
                n = len(words)
                lines = raw.split(b"\n")
                seen: set[bytes] = set()
                dup, lost, good = 0, Counter(), []
                for line in lines:
                    size = len(line.split())
                    if not size:
                        good.append(line)
                        continue
                    if line in seen:
                        dup += 1
                    else:
                        seen.add(line)
                    failed = judge_line(line.decode("utf-8", "replace"), rules)
                    if failed:
                        lost[failed] += size
                    else:
                        good.append(line)
                repeats = repeated_words(words, rules.window)
                base = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
                for k, v in (
                    ("n_words", n), ("word_chars", len(b"".join(words).decode("utf-8", "replace"))), ("n_symbols", len(raw) - len(raw.translate(None, _SYMBOLS))), ("n_dup_lines", dup), ("n_repeat_words", repeats), ("base_failed", base),
                    ("kept", not base and sum(lost.values()) <= rules.max_lost * n), ("lost_punctuation", lost["punctuation"]), ("lost_navigation", lost["navigation"]), ("lost_boilerplate", lost["boilerplate"]), ("clean_text", b"\n".join(good).decode("utf-8", "replace")),
                ):
                    out[k].append(v)
            kinds = {"base_failed": pa.bool_(), "kept": pa.bool_(), "clean_text": pa.string()}
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items())], names=["id", *out])

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, lost_punctuation long, lost_navigation long, lost_boilerplate long, clean_text string"
    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(tidy(run), schema).withColumnRenamed("id", id_col)
