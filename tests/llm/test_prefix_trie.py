"""The prefix trie against one in plain Python, in shards of a few turns and in large ones."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerlake.llm import prefix_trie, queries


def conversations(seed=4, n=160):
    """Shared beginnings, copies, one conversation that begins another, repeats, nulls, a long one."""
    r = random.Random(seed)
    texts = [None, "", "Hi", "hi é", *(f"t{i}" for i in range(9)), "long " * 40_000]
    rows = []
    for c in range(n):
        if c % 7 == 3:
            continue
        if c % 3 == 0:
            own = [("user", "first"), ("bot", "second"), ("user", "third")][:r.randint(1, 3)]
        else:
            own = [(r.choice(["user", "bot", None]), r.choice(texts)) for _ in range(r.randint(1, 6))]
        rows += [(c * 3 - 40, t, *x) for t, x in enumerate(own)]
    rows += [(1000, t, "user", f"step {t % 5}") for t in range(700)]
    rows += [(1001, t, "user", f"step {t % 5}") for t in range(350)]
    rows += [(1002, None, "a", "x"), (1002, 0, "b", "y"), (1002, 0, "b", "y"), (1002, 0, None, None), (1002, None, "a", "w")]
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    r.shuffle(rows)
    return rows


def plain_sequences(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), key, (role, text)))
    return {c: [x[2] for x in sorted(v)] for c, v in own.items()}


def plain_rebuilt(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        b = c - int(np.fmod(c, 5))
        out[c] = seqs.get(b, [])[:h] + own[h:]
    return out


def plain_trie(seqs):
    members = defaultdict(list)
    for c, own in seqs.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        worth = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += worth
    out = []
    for node, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(seqs[c]) == len(node))))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(kids[node]),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def rows_of(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens", "ends_sha256").collect()), key=repr)


@pytest.mark.parametrize("turns", [1, 7, 100_000])
def test_nodes(spark, monkeypatch, turns):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    data = [r for r in conversations() if turns > 1 or r[0] is None or r[0] < 1000]
    table = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as seq", "'x' as chunk", "2 as part", "3 as shard")
    assert rows_of(prefix_trie.prefix_trie(prefix_trie.sequences(table))) == plain_trie(plain_sequences(data))


def test_the_query_over_rebuilt_conversations(spark, tmp_path):
    data = conversations(9, 90)
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    want = plain_rebuilt(plain_sequences(data))
    assert any(not x for x in want.values())          # one without a turn
    assert rows_of(queries.op12_prefix_trie(spark, str(tmp_path))) == plain_trie(want)


@pytest.mark.parametrize("data", [[], [(None, 1, "a", "b")], [(5, 1, "a", "b")]])
def test_small_tables(spark, data):
    got = rows_of(prefix_trie.prefix_trie(prefix_trie.sequences(spark.createDataFrame(data, SCHEMA))))
    assert got == (plain_trie(plain_sequences(data)) if any(r[0] is not None for r in data) else [])


def test_double_array_holds_its_sequences_and_no_others():
    r = random.Random(8)
    seqs = sorted({tuple(r.randrange(40) for _ in range(r.randint(0, 6))) for _ in range(3000)} | {tuple(range(300)), (7,) * 50})
    shared = [0] + [next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
                    for a, b in zip(seqs, seqs[1:], strict=False)]
    flat, lengths = np.array([x for s in seqs for x in s]), np.array(list(map(len, seqs)))
    trie = prefix_trie.DoubleArray(flat, lengths, np.array(shared))
    slots = trie.walk(flat, lengths)
    prefixes = {s[:d]: None for s in seqs for d in range(1, len(s) + 1)}
    found = {}
    for s, end in zip(seqs, np.cumsum(lengths), strict=True):
        for d in range(1, len(s) + 1):
            found.setdefault(s[:d], set()).add(int(slots[end - len(s) + d - 1]))
    assert found.keys() == prefixes.keys() and all(len(x) == 1 for x in found.values())
    assert len({next(iter(x)) for x in found.values()}) == len(prefixes) and -1 not in slots
    assert (trie.check != prefix_trie.FREE).sum() == len(prefixes) + 1
    others = [tuple(r.randrange(400) for _ in range(r.randint(1, 6))) for _ in range(2000)]
    own = trie.walk(np.array([x for s in others for x in s]), np.array(list(map(len, others))))
    at = 0
    for s in others:
        want = [next(iter(found[s[:d]])) if s[:d] in found else -1 for d in range(1, len(s) + 1)]
        assert own[at:at + len(s)].tolist() == want
        at += len(s)


def test_common_turns():
    w = prefix_trie.WIDTH
    a = bytes(range(w)) + b"b" * w
    assert prefix_trie.common_turns(a, a) == 2 and prefix_trie.common_turns(a, a[:w]) == 1
    assert prefix_trie.common_turns(a, b"") == 0 and prefix_trie.common_turns(a, a[:w] + b"b" * (w - 1) + b"c") == 1
