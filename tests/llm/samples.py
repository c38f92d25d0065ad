"""Made-up prose for the tests."""

import random

EN = "the of and to in that was for with as on river stone window garden evening letter market winter bridge".split()


def prose(seed: int, n: int, words=EN) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + (str(rng.randrange(50)) if rng.random() < 0.7 else "") for _ in range(n))
