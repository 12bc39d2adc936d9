"""Blocks, words, rolling hashes and suffix arrays against plain Python."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabwright.llm import decontaminate, near_dup, pu_quality
from tabwright.llm.blocks import BYTE_BASE, PRIME, WORD_BASE, Rolling, blocks, content_ids, loose_windows, powers, sliding_min, words_of
from tabwright.llm.suffix import common_prefixes, repeated_places, suffix_array


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aé \t\n\x0b\x1f 日", max_size=12)), max_size=8), st.integers(1, 20))
def test_words_are_those_of_each_text(texts, limit):
    found = []
    for block in blocks(pa.array(texts, pa.string()), limit):
        w = words_of(block)
        for i in range(block.last - block.first):
            part = slice(w.bounds[i], w.bounds[i + 1])
            found.append([block.data[s:e].tobytes().decode() for s, e in zip(w.starts[part], w.ends[part], strict=True)])
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_rolling_hashes_tell_ranges_apart():
    data = np.frombuffer(b"abcabcab\0\0\0", np.uint8)
    roll = Rolling(data, BYTE_BASE)
    seen = {}
    for i in range(len(data)):
        for j in range(i + 1, len(data) + 1):
            h = int(roll.ranges(np.array([i]), np.array([j]))[0])
            assert seen.setdefault(h, data[i:j].tobytes()) == data[i:j].tobytes()
    assert len(seen) == len({data[i:j].tobytes() for i in range(11) for j in range(i + 1, 12)})
    assert (roll.windows(3) == roll.ranges(np.arange(9), np.arange(9) + 3)).all()


def thue_morse(n, a="a", b="b"):
    """2**n symbols and their mirror image: hashes modulo a power of two take the two for equal."""
    x, swap = a, str.maketrans(a + b, b + a)
    for _ in range(n):
        x += x.translate(swap)
    return x, x.translate(swap)


def test_regular_texts_are_told_apart():
    x, y = thue_morse(11)
    data = np.frombuffer((x + y).encode(), np.uint8)
    starts, ends = np.array([0, len(x)]), np.array([len(x), 2 * len(x)])
    assert len(set(loose_windows(data, len(x))[[0, len(x)]].tolist())) == 1  # why these decide nothing
    assert len(set(Rolling(data, BYTE_BASE).ranges(starts, ends).tolist())) == 2
    assert len(set(content_ids(data, starts, ends).tolist())) == 2
    assert suffix_array(data).tolist() == sorted(range(len(data)), key=lambda i: (x + y)[i:])


def test_arithmetic_of_hashes():
    rng = random.Random(2)
    values = [rng.randrange(1 << 64) for _ in range(3000)] + [PRIME - 1, PRIME, PRIME + 1, 0, (1 << 64) - 1]
    roll = Rolling(np.array(values, np.uint64), WORD_BASE)
    total, sums = 0, [0]
    for i, v in enumerate(values):
        total = (total + (v % PRIME + 1) * pow(WORD_BASE, i, PRIME)) % PRIME
        sums.append(total)
    assert roll.sums.tolist() == sums
    up, down = powers(BYTE_BASE, 70_000)
    assert all(int(up[i]) * int(down[i]) % PRIME == 1 and int(up[i]) == pow(BYTE_BASE, i, PRIME) for i in (0, 1, 2, 65_535, 65_536, 70_000))


def test_ids_of_ranges_follow_their_bytes():
    rng = random.Random(4)
    parts = [bytes(rng.choices(b"ab\0", k=n)) for n in range(1, 40) for _ in range(6)]
    data, ends = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])
    ids = content_ids(data, ends - [len(p) for p in parts], ends).tolist()
    assert len(set(zip(ids, parts, strict=True))) == len(set(ids)) == len(set(parts))


def test_sliding_minimum():
    x = np.random.default_rng(1).integers(0, 99, 50).astype(np.uint64)
    for w in (1, 2, 7, 24, 50, 51):
        assert sliding_min(x, w).tolist() == [min(x[i : i + w]) for i in range(50 - w + 1)]


def _texts():
    rng = random.Random(5)
    for _ in range(300):
        n, symbols = rng.randint(0, 60), rng.choice([1, 2, 4, 300])
        x = [rng.randrange(symbols) for _ in range(n)]
        yield x[:7] * 8 if rng.random() < 0.3 else x
    yield [1] * 3000
    yield [rng.randrange(3) for _ in range(5000)]


def test_suffix_array_and_prefixes():
    for x in _texts():
        text = np.array(x, np.int64)
        sa = suffix_array(text)
        assert sa.tolist() == sorted(range(len(x)), key=lambda i: x[i:])
        if len(x) > 100:
            continue
        before, common = common_prefixes(text, sa)
        for r in range(1, len(x)):
            i, j, k = int(sa[r]), int(sa[r - 1]), 0
            while max(i, j) + k < len(x) and x[i + k] == x[j + k]:
                k += 1
            assert (before[i], common[i]) == (j, k)
        windows = [tuple(x[i : i + 4]) for i in range(len(x) - 3)]
        assert np.flatnonzero(repeated_places(text, 4)).tolist() == [i for i, w in enumerate(windows) if windows.count(w) > 1]


def _steps():
    none = np.zeros((0, pu_quality.N_FEATURES))
    index = decontaminate.build_index([(1, "what is the name of the largest river of them all? It is the long one.")])
    return {
        "filter": pu_quality._filter(pu_quality.fit(none, none, 0.5), 0.3),
        "digest": near_dup._digest(5),
        "without": decontaminate._without(index),
    }


@pytest.mark.parametrize("step", ["filter", "digest", "without"])
def test_memory_of_a_step(step):
    """A worker that walks through 2 MB of texts holds a few MB beside them."""
    texts = [" ".join(f"w{(i * 7919 + k * k) % 5003}" for k in range(600)) for i in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array(texts)], names=["doc_id", "text"])
    run = _steps()[step]
    for _ in run(iter([batch.slice(0, 10)])):
        pass
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert rows == 600
    assert peak < 15, peak
