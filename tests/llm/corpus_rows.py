"""Made-up prose for the tests of corpus operators."""

from __future__ import annotations

import random

SYLLABLES = "ba ce di fo gu ka le mi no pu ra se ti vo wu ya".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))


def altered(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join("Changed" if rng.random() < share else w for w in text.split(" "))
