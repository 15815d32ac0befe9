import hashlib
import zlib

import numpy as np

from quarry.llm import prefix_trie
from quarry.llm.prefix_trie import Bases, trie

TURNS = "conv_id long, turn long, role string, text string, depth string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0), (role is not None, role or ""), digest, (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(v)] for c, v in convs.items()}
    members = {}
    length = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        length[c] = len(seq)
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    out = []
    for node, inside in members.items():
        below = [x for x in members if x[: len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        ends = sorted(c for c in inside if length[c] == len(node))
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * (len(x[-1][1].encode()) if x else 0) for x in below)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(inside), len(node), parent, len(inside), len(kids), len(leaves), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], TURNS)
    return sorted((tuple(r) for r in trie(df).collect()), key=repr)


def chats():
    rows = [(c, t, ("user", "assistant")[t % 2], f"{'same' if t < 3 else c % 4} {t}") for c in range(60) for t in range(c % 13)]
    rows += [(c, 0, "user", "only") for c in range(100, 140)]  # many heads of nothing or one turn
    rows += [(201, t, "user", f"é{t % 3}") for t in range(300)] + [(207, t, "user", f"é{t % 3}") for t in range(290)]  # long ones, without a base
    rows += [(301, None, None, None), (301, 1, "", ""), (301, 1, "", ""), (302, 2, "user", None), (302, None, "a", "x" * 200_000), (None, 0, "user", "none"), (-7, 0, "user", "same 0"), (-7, 1, "user", "z")]
    return rows


def test_equals_brute_force(spark):
    assert run(spark, chats()) == brute(chats())


def test_blocks_of_paths_and_packs_are_small(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 3)
    monkeypatch.setattr(prefix_trie, "PACK", 100)
    rows = chats()[:-8] + [(c, 0, "user", "crowd") for c in range(1000, 1300)]
    assert run(spark, rows) == brute(rows)


def test_no_conversations(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 0, "user", "x")]) == []


def test_fingerprints_compose():
    b = Bases(3)
    v = np.random.default_rng(0).integers(0, 1 << 63, (2, 20)).astype(np.uint64)
    sums = np.cumsum(v * b.power(np.arange(20)), axis=1, dtype=np.uint64)
    tail = (v[:, 7:] * b.power(np.arange(13))).sum(axis=1, dtype=np.uint64)
    assert ((sums[:, -1] - sums[:, 6]) * b.power(np.array([-7]))[:, 0] == tail).all()
    assert (sums[:, 6] + b.power(np.array([7]))[:, 0] * tail == sums[:, -1]).all()


def test_a_collision_changes_the_bases(spark, monkeypatch):
    """Bases that map everything to one fingerprint are rejected by the stored turns' digests."""
    used = []

    class Poor(Bases):
        def __init__(self, seed):
            super().__init__(seed)
            used.append(seed)
            if seed == 0:
                self.base = self.inverse = np.zeros(2, np.uint64)

    monkeypatch.setattr(prefix_trie, "Bases", Poor)
    rows = [(c, t, "user", f"{c % 3} {t}") for c in range(10) for t in range(9)]
    assert run(spark, rows) == brute(rows) and used == [0, 1]
