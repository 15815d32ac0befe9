"""Small fixtures and brute-force twins shared by the operator tests."""

from __future__ import annotations

import re
from collections import Counter

SMALL = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def bag(tokens: list[str]) -> Counter:
    if len(tokens) < 5:
        return Counter([tuple(tokens)]) if tokens else Counter()
    return Counter(tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4))


def bag_similarity(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / max(1, sum((a | b).values()))


class Groups:
    """Union-find."""

    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def prose(seed: int, n: int) -> list[str]:
    import random

    r = random.Random(seed)
    return ["".join(r.choice("bcdfghklmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(n)]
