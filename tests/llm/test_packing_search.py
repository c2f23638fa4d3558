"""The search over whole packings at any number of sequences."""

from collections import Counter

import pytest

from lakeretrieve.llm import packing


@pytest.mark.parametrize("n", [10, 100, 10_000, 1_000_000])
def test_search_is_entered_at_every_size(n):
    histogram = {1200: n, 1100: n, 500: n, 348: n, 448: n, 424: 2 * n}
    patterns = packing.pack(histogram)
    held = Counter()
    for pattern, times in patterns:
        assert sum(pattern) <= packing.CAPACITY
        for x in pattern:
            held[x] += times
    assert held == Counter(histogram)
    assert sum(times for _, times in patterns) == 22 * n // 10
