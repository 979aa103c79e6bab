"""The trie of conversations against plain dictionaries."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from wordloom.llm import prefix_trie

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            given[conv].append((turn is not None, turn or 0, digest, (role, text)))
    turns = {c: [x[3] for x in sorted(t, key=lambda x: x[:3])] for c, t in given.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = tuple(turns.get(first, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    below = defaultdict(list)
    for node in members:
        if node:
            below[node[:-1]].append(node)
    out = []
    for node, of in members.items():
        inside = [m for m in members if m[: len(node)] == node]
        ends = sorted(c for c in of if built[c] == node)
        out.append((
            min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(below[node]),
            sum(not below[m] for m in inside), sum((len(members[m]) - 1) * len(WORD.findall(m[-1][1])) for m in inside if m),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[1], r[0]))


def rows_of(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=lambda r: (r[1], r[0]))


def conversations(n, longest, seed):
    """Conversations that share beginnings of all lengths, copies among them."""
    rng = random.Random(seed)
    rows, known = [], []
    for c in range(n):
        base = rng.choice(known) if known and rng.random() < 0.8 else []
        seq = base[: rng.randrange(len(base) + 1)] if rng.random() < 0.7 else list(base)
        if rng.random() < 0.7:
            seq = seq + [(rng.choice("ua"), " ".join(rng.choices(["x", "yy", "z"], k=rng.randrange(4)))) for _ in range(rng.randrange(longest))]
        known.append(seq)
        rows += [(c * rng.choice([1, 1, 20, -3]), i, role, text) for i, (role, text) in enumerate(seq)]
    return rows


@pytest.mark.parametrize(("n", "longest", "seed"), [(120, 6, 1), (40, 25, 2)])
def test_equals_plain_trie(spark, n, longest, seed):
    rows = conversations(n, longest, seed)
    got = rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    assert got == brute(rows)


def test_copies_of_long_conversations(spark, monkeypatch):
    """A hot prefix with many members, lists in pieces, spans in parts, all ends in one node."""
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    monkeypatch.setattr(prefix_trie, "SPAN", 4)
    long = [("user", f"word {i}") for i in range(70)]
    rows = [(c, i, *t) for c in range(0, 60) for i, t in enumerate(long)]
    rows += [(c, i, *t) for c in range(100, 103) for i, t in enumerate(long[: 40 + c % 100] + [("x", f"own {c}")] * 20)]
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


ODD = [
    (1, 0, None, None), (1, 0, "", ""), (1, None, "user", "null first"), (2, 1, "a", "b c"), (2, 1, "ab", " c"), (2, 1, "a", "b c"),
    (None, 0, "user", "no conversation"), (20, 0, "user", " \t\n\x0b\x0c\r"), (21, 5, "user", "long " * 50_000), (22, 3, "user", "é😀 x\x1cy\xa0z"),
    (-1, 0, "user", "below"), (-21, 0, "user", "below"), (40, 0, "user", "t"), (41, 0, "user", "t"), (42, 0, "user", "t"), (43, 0, "user", "t"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    assert rows_of(prefix_trie.prefix_trie(df)) == brute(ODD)
    clash = df.selectExpr("*", "1 AS conv", "2 AS place", "'x' AS digest", "3 AS depth", "4 AS `a.b`")
    assert rows_of(prefix_trie.prefix_trie(clash)) == brute(ODD)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.prefix_trie(df.where("conv_id IS NULL")).count() == 0


def test_one_conversation(spark):
    for rows in ([(7, 0, "user", "a b"), (7, 1, "user", "c")], [(4, 0, "user", "gone")]):
        assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_head_sizes_cover_all_remainders():
    assert {zlib.crc32(str(c).encode()) % 4 for c in range(40)} == {0, 1, 2, 3}
