"""Pure functions against brute force; no Spark."""

import random
import sys
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from thermaquilt.llm import common as C
from thermaquilt.llm import phrase_dedup
from thermaquilt.llm.decontaminate import greedy_tiles
from thermaquilt.llm.line_rules import LineRules, judge_line, repeated_words
from thermaquilt.llm.near_dup import _few_edits, _many_edits, banded_distance
from thermaquilt.llm.pieces import Units, anchors
from thermaquilt.llm.ppm import Lookup, grams
from thermaquilt.llm.suffix_dedup import _ranked, permuted_lcp, repeated_starts, suffix_array


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.sampled_from([4, 600]))
def test_suffix_array_and_lcp(t, letters):
    sa = suffix_array(np.array(t), letters).tolist()
    assert sa == sorted(range(len(t)), key=lambda i: t[i:])
    lcp = permuted_lcp(np.array(t), np.array(sa), 6)
    for a, b in zip(sa, sa[1:], strict=False):
        n = 0
        while n < 6 and max(a, b) + n < len(t) and t[a + n] == t[b + n]:
            n += 1
        assert lcp[b] == n


def _steps(f):
    """Lines of Python that f runs, and its result."""
    steps = 0

    def count(*_):
        nonlocal steps
        steps += 1
        return count

    before = sys.gettrace()
    sys.settrace(count)
    try:
        got = f()
    finally:
        sys.settrace(before)
    return steps, got


def test_suffix_array_steps():
    """Near copies repeat names of leftmost-smaller suffixes for long stretches; these are ranked by arrays, not one by one."""
    r = random.Random(6)
    words = ["".join(r.choices("abcdefgh", k=r.randrange(3, 9))) for _ in range(300)]
    text = " ".join(r.choices(words, k=800))
    copies = [text[:k] + "~" + text[k:] for k in range(100, 4000, 100)]
    t = np.frombuffer(b"\xff".join(c.encode() for c in copies), np.uint8)
    steps, sa = _steps(lambda: suffix_array(t, 256))
    raw = t.tobytes()
    assert sorted(sa.tolist()) == list(range(len(t)))
    assert all(raw[a:] < raw[b:] for a, b in zip(sa[::97].tolist(), sa[1::97].tolist(), strict=False))
    assert steps < 200_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=1, max_size=200))
def test_ranked(t):
    assert _ranked(np.array(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab", max_size=25).map(str.encode), min_size=1, max_size=5))
def test_repeated_starts(contents):
    seen = Counter(c[i : i + 4] for c in contents for i in range(len(c) - 3))
    for c, got in zip(contents, repeated_starts(contents, 4), strict=True):
        assert got.tolist() == [i for i in range(len(c) - 3) if seen[c[i : i + 4]] > 1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=12), st.lists(st.integers(0, 2), max_size=12), st.integers(0, 9))
def test_banded_distance(a, b, most):
    d = list(range(len(b) + 1))
    for i in range(len(a)):
        new = [i + 1]
        for j in range(len(b)):
            new.append(min(new[j] + 1, d[j + 1] + 1, d[j] + (a[i] != b[j])))
        d = new
    assert banded_distance(a, b, most) == (d[-1] if d[-1] <= most else None)
    assert _many_edits(np.array(a, np.int64), np.array(b, np.int64), most) == (d[-1] if d[-1] <= most else None)


def test_banded_distance_steps():
    """A pair of 700 words that are all alike but for scattered changes: the band is walked a row at a time, not a diagonal at a time."""
    r = random.Random(4)
    a = list(range(700))
    b = [x if r.random() < 0.77 else -x - 1 for x in a]
    changed = sum(x != y for x, y in zip(a, b, strict=True))
    steps, got = _steps(lambda: (banded_distance(a, b, 140), banded_distance(a, b, 200)))
    assert got == (None, changed) and 140 < changed < 200
    assert steps < 100_000


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(0, 3), max_size=60), st.integers(0, 60))
def test_banded_distance_by_bits(a, b, most):
    if abs(len(a) - len(b)) <= most:
        assert _few_edits(a, b, most) == _many_edits(np.array(a, np.int64), np.array(b, np.int64), most)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=30), min_size=1, max_size=4))
def test_word_spans_and_hashes(texts):
    buf, starts, ends = C.concat(texts)
    begin, end = C.word_spans(buf)
    raw = buf.tobytes()
    assert [raw[a:b] for a, b in zip(begin, end, strict=True)] == [w for t in texts for w in t.split()]
    h = C.span_hash(C.prefix_hash(buf), begin, end)
    words = [raw[a:b] for a, b in zip(begin, end, strict=True)]
    assert len(set(words)) == len({int(x) for x in h})
    assert [raw[a:b] for a, b in zip(starts, ends, strict=True)] == texts


@pytest.mark.parametrize("w", [1, 2, 5, 9])
def test_window_minimum(w):
    v = C.mix64(np.arange(60, dtype=np.uint64) % np.uint64(7) + np.uint64(1))
    top = [int(x) >> 32 for x in v]
    assert C.window_minimum(v, w).tolist() == [min(range(i, i + w), key=lambda j: (top[j], j)) for i in range(len(v) - w + 1)]


@pytest.mark.parametrize("u", [Units(13, 8, True, 13), Units(40, 5, False, 23)])
def test_equal_windows_have_equal_anchors(u):
    r = random.Random(5)
    words = [bytes(r.choice(b"abcd") for _ in range(3)) for _ in range(200)]
    shared = b" ".join(words[50:120])
    texts = [b" ".join(words), b"other start " + shared + b" other end", b"short"]
    a = anchors(texts, u)
    of, at, where = a.windows(u.n, u)
    seen = {}
    for k, i, q in zip(of.tolist(), at.tolist(), where.tolist(), strict=True):
        content = tuple(texts[k].split()[i : i + u.n]) if u.words else texts[k][i : i + u.n]
        assert seen.setdefault(content, a.hashes[q]) == a.hashes[q]
    assert set(of.tolist()) == {0, 1}


def test_grams_frame_each_text():
    g, starts = grams([b"ab", b"", b"c"], 2)
    f = 0xFF
    want = [(f, f, 97), (f, 97, 98), (97, 98, f), (f, f, f), (f, f, 99), (f, 99, f)]
    assert g.tolist() == [(x << 16) | (y << 8) | z for x, y, z in want] and starts.tolist() == [0, 3, 4]


def test_lookup():
    keys = np.unique(C.mix64(np.arange(1, 5000, dtype=np.uint64)))
    t = Lookup(keys)
    assert (t(keys) == np.arange(len(keys))).all() and (t(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()


def test_tiles_find_reordered_parts():
    a = list(range(30))
    b = [99, *a[15:30], 98, *a[:15], 97]
    assert sum(n for *_, n in greedy_tiles(a, b)) == 30 and len(greedy_tiles(a, b)) == 2
    assert greedy_tiles(a, list(range(100, 140))) == []
    assert sum(n for *_, n in greedy_tiles([1] * 12, [1] * 7)) == 7


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=30))
def test_repeated_words(words):
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    covered = {j for i, g in enumerate(grams) if seen[g] > 1 for j in range(i, i + 3)}
    assert repeated_words(words, 3) == len(covered)


def test_line_rules():
    r = LineRules()
    assert judge_line("A sentence that ends.", r) is None and judge_line("   ", r) is None
    assert judge_line("Home | News | About | Contact", r) == "navigation"
    assert judge_line("All rights reserved.", r) == "boilerplate"
    assert judge_line("Short heading", r) == "punctuation"
    assert judge_line("THIS!! IS!! LOUD!! TEXT.", r) == "punctuation"


def slow_tiles(a, b, least):
    """Greedy string tiling by trying every pair of places at every length."""
    free_a, free_b, tiles = [True] * len(a), [True] * len(b), []
    for n in range(min(len(a), len(b)), least - 1, -1):
        for i in range(len(a) - n + 1):
            for j in range(len(b) - n + 1):
                if a[i : i + n] == b[j : j + n] and all(free_a[i : i + n]) and all(free_b[j : j + n]):
                    free_a[i : i + n] = free_b[j : j + n] = [False] * n
                    tiles.append((i, j, n))
    return tiles


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=25), st.lists(st.integers(0, 3), max_size=25), st.integers(1, 4))
def test_tiles_against_all_pairs(a, b, least):
    assert greedy_tiles(a, b, least) == slow_tiles(a, b, least)


def test_tiles_of_repeated_tokens_are_fast():
    import time

    began = time.perf_counter()
    assert greedy_tiles([1] * 5000, [1] * 5000) == [(0, 0, 5000)]
    assert sum(n for _, _, n in greedy_tiles([1] * 5000, ([1] * 100 + [0]) * 60)) == 5000
    assert sum(n for _, _, n in greedy_tiles([1] * 5000, [x for k in range(5, 100) for x in [1] * k + [0]])) >= 4900
    assert time.perf_counter() - began < 3


def test_automaton_locates_confirmed_windows():
    """Windows of two documents only, with the least id, wherever they stand; a document's own repeats do not count."""
    r = random.Random(5)
    docs = [tuple(r.randrange(4) for _ in range(r.randrange(2, 40))) for _ in range(60)]
    n = 3
    passages = phrase_dedup.confirm([(0, w, i, i) for i, w in enumerate(docs)], n)
    ids = {}
    for i, w in enumerate(docs):
        for k in range(len(w) - n + 1):
            ids.setdefault(w[k : k + n], set()).add(i)
    assert passages == {w: (min(s), 1) for w, s in ids.items() if len(s) > 1}
    got = {p: list(zip(at, lows, strict=True)) for _, p, at, lows in phrase_dedup.stream(passages, [(0, i, w) for i, w in enumerate(docs)], n)}
    for i, w in enumerate(docs):
        assert got.get(i, []) == [(k, passages[w[k : k + n]][0]) for k in range(len(w) - n + 1) if w[k : k + n] in passages]
    assert phrase_dedup.stream({}, [(0, 0, docs[0])], n) == []
    # The only stretch of an anchor is one passage, if two documents have it.
    alone = phrase_dedup.confirm([(1, (7, 8, 9, 7, 8), 2, 6), (2, (5, 5, 5), 3, 3)], n)
    assert alone == {(7, 8, 9, 7, 8): (2, 3)}
    assert phrase_dedup.stream(alone, [(1, 4, (7, 8, 9, 7, 8)), (2, 5, (5, 5, 5))], n) == [(1, 4, [0, 1, 2], [2, 2, 2])]


def test_finished_kernels_hold_no_freed_memory():
    from pathlib import Path

    from thermaquilt.llm.common import tidy

    rss = lambda: int(Path("/proc/self/statm").read_text().split()[1]) * 4096
    pins = []

    def kernel(batches):
        for b in batches:
            held = [bytes(1000) for _ in range(200_000)]
            pins.append(bytes(1000))  # keeps the heap's end in use
            del held
            yield b, rss()

    (got, after_free), *_ = list(tidy(kernel)([1]))
    assert got == 1
    assert rss() < after_free - (100 << 20)
    assert tidy(lambda left: left + 1)(1) == 2
    assert tidy(lambda left, right: left + right)(1, 2) == 3


def test_plain_pattern_splits_as_the_library_does():
    import random
    import re

    import regex

    from thermaquilt.llm.token_count import PATTERN, PLAIN, plain_pattern

    chars = "".join(filter(regex.compile(f"[{PLAIN}]").match, map(chr, range(0x10000))))
    one, two = regex.compile(PATTERN).findall, re.compile(plain_pattern()).findall
    r = random.Random(4)
    assert all(one(f" {c}{c} a{c}1{c}  {c}") == two(f" {c}{c} a{c}1{c}  {c}") for c in chars)
    for _ in range(3000):
        t = "".join(r.choices(chars, k=20) + r.choices(" \t\n\x1c\x85\u3000ab1'sre.", k=40))
        t = "".join(r.sample(t, len(t)))
        assert one(t) == two(t)


def test_prefixes_by_eight_bytes():
    """Common prefixes around multiples of eight bytes, up to the text's end, against letter by letter."""
    import numpy as np

    from thermaquilt.llm.suffix_dedup import permuted_lcp, suffix_array

    for n in (1, 7, 8, 9, 15, 16, 17, 40):
        t = np.array([0, 1] * n + [2] + [0, 1] * n + [0, 0, 1, *[0] * n], np.uint8)
        sa = suffix_array(t, 3)
        assert permuted_lcp(t, sa, 1000).tolist() == permuted_lcp(t.astype(np.int64), sa, 1000).tolist()
