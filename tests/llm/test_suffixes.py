import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from murmur.llm.suffixes import permuted_prefixes, suffix_array


def plain(t):
    t = list(t)
    return sorted(range(len(t)), key=lambda i: t[i:])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=200))
def test_few_symbols(values):
    assert suffix_array(np.array(values), 4).tolist() == plain(values)


@pytest.mark.parametrize("seed", range(60))
def test_many_symbols_runs_and_copies(seed):
    rng = np.random.default_rng(seed)
    t = rng.integers(0, int(rng.choice([2, 5, 30, 300])), int(rng.integers(1, 300)))
    if seed % 3 == 0:
        t = np.repeat(t, rng.integers(1, 15, len(t)))
    if seed % 4 == 0:
        t = np.concatenate([t] * 3)
    assert suffix_array(t, 300).tolist() == plain(t)


def test_one_long_run_and_a_periodic_text():
    assert suffix_array(np.zeros(5000, np.int64), 1).tolist() == list(range(4999, -1, -1))
    t = np.tile([2, 1, 1, 0, 2], 400)
    assert suffix_array(t, 3).tolist() == plain(t)


@pytest.mark.parametrize("seed", range(10))
def test_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    strings = [rng.integers(1, 3, int(rng.integers(8, 40))) for _ in range(30)]
    strings += strings[:5]
    t = np.concatenate([np.append(s, 0) for s in strings])
    sizes = np.array([len(s) for s in strings])
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    counts = sizes - 8 + 1
    sa = suffix_array(t, 3)
    got = permuted_prefixes(t, sa, starts, counts, 8)
    text, before = t.tolist(), dict(zip(sa[1:].tolist(), sa[:-1].tolist()))
    for s, c in zip(starts.tolist(), counts.tolist()):
        for p in range(s, s + c):
            want = 0
            if p in before:
                a, b = text[p : p + 8], text[before[p] : before[p] + 8]
                want = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert got[p] == want
