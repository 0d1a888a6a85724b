"""Invented prose for the tests."""

import random

WORDS = [a + b for a in ("ka", "lo", "mi", "ter", "sun", "dra", "po") for b in ("ne", "ri", "vas", "tol", "qu", "é")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ","]) for _ in range(n))
