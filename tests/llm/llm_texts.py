"""Texts for the tests."""

import random


def words(seed, n, size=400):
    """``n`` pseudo-words in a fixed order."""
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]
