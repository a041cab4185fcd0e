import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from questlog.llm.lyndon import neighbour_matches, suffix_array


def plain(text):
    return sorted(range(len(text)), key=lambda i: text[i:])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_any_text(symbols):
    assert suffix_array([*symbols, 0]) == plain([*symbols, 0])


def test_runs_periods_and_long_texts():
    rng = random.Random(2)
    texts = [[1] * 500, [1, 2] * 200, [2, 1] * 200, list(range(300, 0, -1)), list(range(1, 300)), [3, 3, 2] * 90 + [1, 3] * 50]
    texts += [[rng.randrange(1, k) for _ in range(3000)] for k in (2, 4, 300)]
    for text in texts:
        assert suffix_array([*text, 0]) == plain([*text, 0])
    assert suffix_array([]) == [] and suffix_array([5]) == [0]
    with pytest.raises(ValueError):
        suffix_array([1, 1])


def test_matches_of_neighbours():
    rng = random.Random(3)
    text = [*(rng.randrange(1, 4) for _ in range(200)), 0]
    def shared(i, j):
        k = 0
        while max(i, j) + k < len(text) and text[i + k] == text[j + k]:
            k += 1
        return k
    assert neighbour_matches(text, suffix_array(text)) == [max(shared(i, j) for j in range(len(text)) if j != i) for i in range(len(text))]
