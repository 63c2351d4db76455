"""Split totals are the closest ones at any size."""

from __future__ import annotations

import random

from klipgrid.llm import splits as S


def test_choice_is_exact_beyond_the_kept_bits():
    rnd = random.Random(5)
    for _ in range(200):
        sizes = {rnd.randint(2, 60): rnd.randint(1, 4) for _ in range(rnd.randint(1, 6))}
        total = sum(s * m for s, m in sizes.items())
        target = rnd.randint(0, total)
        sums = {0}
        for s, m in sizes.items():
            sums = {x + s * k for x in sums for k in range(m + 1)}
        best = min(sums, key=lambda x: (abs(x - target), x))
        for bits in (1, 64, 1 << 22):
            taken = S.choose_counts(sizes, target, max_bits=bits)
            assert all(0 < n <= sizes[s] for s, n in taken.items())
            assert sum(s * n for s, n in taken.items()) == best


def test_choice_is_exact_beyond_four_million_records():
    # whoever takes the largest first is left with a rest that nothing fills
    sizes = {2_900_000: 1, 2_500_001: 2}
    assert S.choose_counts(sizes, 5_000_002) == {2_500_001: 2}
