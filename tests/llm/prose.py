"""Made-up texts with known copies."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(n: int, seed: int, size: int = 400) -> list[str]:
    draw = random.Random(seed)
    return [f"w{draw.randrange(size)}{'.' if draw.random() < 0.1 else ''}" for _ in range(n)]


def text(n: int, seed: int, size: int = 400) -> str:
    return " ".join(words(n, seed, size))


def edit(source: str, changes: int, seed: int) -> str:
    """``source`` with some words replaced."""
    draw, out = random.Random(seed), source.split(" ")
    for i in draw.sample(range(len(out)), changes):
        out[i] = f"changed{draw.randrange(10**6)}"
    return " ".join(out)
