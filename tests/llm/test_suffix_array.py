import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeforge.llm import suffix_array as sa


def brute(text):
    t = text.tolist()
    return sorted(range(len(t)), key=lambda i: t[i:])


def check(symbols):
    text = np.array([x + 1 for x in symbols] + [0], np.int64)
    array = sa.suffix_array(text, int(text.max()) + 1)
    assert array.tolist() == brute(text)
    common = sa.permuted_common_prefixes(text, array, stop=1)
    for a, b in zip(array, array[1:]):
        n = 0
        while a + n < len(text) and b + n < len(text) and text[a + n] == text[b + n] > 1:
            n += 1
        assert common[b] == n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_small_alphabet(symbols):
    check(symbols)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=40), st.integers(1, 5))
def test_repeats(symbols, times):
    check(symbols * times)


@pytest.mark.parametrize("text", [b"", b"a", b"aaaa", b"abab" * 30, b"mississippi" * 5, bytes(range(256)) * 3])
def test_known(text):
    check(list(text))


def test_doubling_of_ranks(monkeypatch):
    monkeypatch.setattr(sa, "SMALL_ALPHABET", 1)
    rng = np.random.default_rng(1)
    for n in (5, 50, 400):
        check(rng.integers(0, 4, n).tolist())
        check((rng.integers(0, 30, n // 3 + 1).tolist()) * 3)


def test_classes():
    text = np.array([2, 2, 3, 1, 1, 2, 0])
    assert sa.classify(text).tolist() == [True, True, False, True, True, False, True]
    assert sa.leftmost_smaller(sa.classify(text)).tolist() == [3, 6]
