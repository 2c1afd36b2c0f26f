"""The trie of all conversations' prefixes, in double arrays.

A turn is 24 bytes: 16 of the SHA-256 of role and text, 8 of the text's length.
A conversation is the sequence of its turns, and a node of the trie is a
distinct sequence of first turns.  Copies of a conversation are one sequence
with a count.  Distinct sequences are sorted by ranges, and each range is cut
into prefix shards of some 100,000 turns: so what a shard shares with others
are the nodes on the path to its first and to its last sequence only, down to
where the neighbour's sequence parts from it.

A shard numbers its turns densely and packs its trie into two arrays: the child
of node s by turn c is slot ``base[s] + c``, if ``check`` of that slot is s.
Walking all sequences through the arrays gives the nodes and what they hold.
Nodes of one shard are final.  The shared upper nodes are merged over all
shards: every measure is a sum over shards, as each shard knows which of its
shared nodes an earlier one has counted already.

Rows without a conversation id belong to none.  Null roles and texts are empty.
Turns of equal number are ordered by digest, repeated rows are repeated turns.
An empty table has no node.  One conversation's turns (24 bytes each, not its
texts) and a task's sub-shard must fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise, pieces_for, prepare

WIDTH = 24                # bytes of a turn
SHARD_TURNS = 100_000     # turns of a sub-shard, or one sequence
CHUNK = 256               # conversation ids that are put together before a sequence's own are joined
FREE = -1


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, seq) of each conversation: its turns in order, null turns first.  Only digests are shuffled."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    spelled = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    token = F.concat(F.substring(F.sha2(spelled.cast("binary"), 256), 1, 32), F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0"))
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), token.alias("token"))
    own = F.sort_array(F.collect_list(F.struct("turn", "token")))
    return rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(
        F.unhex(F.array_join(F.transform(own, lambda x: x["token"]), "")).alias("seq"))


def common_turns(a: bytes, b: bytes) -> int:
    """How many first turns two sequences share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax()) // WIDTH


SORTED = ("part int, shard int, i long, seq binary, n long, conv_id long, ends string, before long, after long")


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct sequences of one sorted range: members, smallest member, SHA-256 of the members, and
    how many turns they share with the one before and after (null at the edges of the range)."""
    part, shard, turns, i = TaskContext.get().partitionId(), 0, 0, 0
    rows: list[tuple] = []
    held = 0
    now, before = None, None           # the sequence that is being read, and its turns shared with the one before
    n, least, ends = 0, None, None

    def row(after: int | None) -> tuple:
        nonlocal shard, turns, i
        if turns and turns + len(now) // WIDTH > SHARD_TURNS:
            shard, turns = shard + 1, 0
        turns, i = turns + len(now) // WIDTH, i + 1
        return part, shard, i, now, n, least, ends.hexdigest(), before, after

    def flush() -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, names=[f.split(" ")[0] for f in SORTED.split(", ")])

    for batch in batches:
        for seq, count, first, members in zip(*(batch.column(c).to_pylist() for c in ("seq", "n", "conv_id", "members")), strict=True):
            if seq != now:
                shared = None
                if now is not None:
                    shared = common_turns(now, seq)
                    rows.append(row(shared))
                    held += len(now) + 200
                    if held > 4 << 20:
                        held = 0
                        yield flush()
                now, before, n, least, ends = seq, shared, count, first, hashlib.sha256(members.encode())
            else:
                n, least = n + count, min(least, first)
                ends.update(b"," + members.encode())
    if now is not None:
        rows.append(row(None))
        yield flush()


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each range's first and last sequence share with the neighbour range's; -1 where there is none."""
    out: list[tuple] = []
    last = None                        # (part, shard, seq) of the last sequence of the range before
    for batch in batches:
        for part, shard, seq, first in zip(*(batch.column(c).to_pylist() for c in ("part", "shard", "seq", "first")), strict=True):
            if first:
                shared = -1 if last is None else common_turns(last[2], seq)
                out.append((part, shard, True, shared))
                if last is not None:
                    out.append((last[0], last[1], False, shared))
            else:
                last = (part, shard, seq)
    if last is not None:
        out.append((last[0], last[1], False, -1))
    if out:
        kinds = (pa.int32(), pa.int32(), pa.bool_(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                         names=["part", "shard", "is_before", "shared"])


class DoubleArray:
    """A trie of sorted distinct sequences of dense numbers, in the arrays ``base`` and ``check``.
    Slot 0 is the root; the child of slot s by c is ``base[s] + c`` if ``check`` there is s."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, shared: np.ndarray):
        """``codes``: all sequences, one after another; ``shared``: numbers each has in common with the one before."""
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, FREE, np.int64)
        self.check[0] = 0
        self.first_free = 1
        starts = np.cumsum(lengths) - lengths
        state = np.zeros(len(lengths), np.int64)
        live = np.flatnonzero(lengths > 0)
        depth = 0
        while len(live):
            own = codes[starts[live] + depth]
            new = live[shared[live] <= depth]              # the first sequence of each child
            parent, code = state[new], codes[starts[new] + depth]
            head = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
            size = np.diff(np.r_[head, len(parent)])
            for a, k in zip(head[size > 1].tolist(), size[size > 1].tolist(), strict=True):
                self._place(int(parent[a]), code[a:a + k])
            alone = head[size == 1]
            slots = self._free(len(alone))
            self.base[parent[alone]] = slots - code[alone]
            self.check[slots] = parent[alone]
            state[live] = self.base[state[live]] + own
            depth += 1
            live = live[lengths[live] > depth]

    def _room(self, upto: int) -> None:
        while upto >= len(self.check):
            self.base = np.concatenate([self.base, np.zeros_like(self.base)])
            self.check = np.concatenate([self.check, np.full_like(self.check, FREE)])

    def _free(self, n: int) -> np.ndarray:
        """The first n free slots."""
        self._room(self.first_free + n)
        found = self.first_free + np.flatnonzero(self.check[self.first_free:] == FREE)
        while len(found) < n:
            self._room(2 * len(self.check))
            found = self.first_free + np.flatnonzero(self.check[self.first_free:] == FREE)
        if n:
            self.first_free = int(found[n - 1]) + 1
        return found[:n]

    def _place(self, parent: int, code: np.ndarray) -> None:
        """First fit: the lowest free slot from which all children's slots are free."""
        code = np.sort(code)
        reach = code - code[0]
        at, step = self.first_free, 64
        while True:
            self._room(at + step + int(reach[-1]) + 1)
            window = at + np.flatnonzero(self.check[at:at + step] == FREE)
            if len(window):
                fits = (self.check[window[:, None] + reach] == FREE).all(1)
                if fits.any():
                    slots = window[fits.argmax()] + reach
                    self.base[parent] = slots[0] - code[0]
                    self.check[slots] = parent
                    while self.check[self.first_free] != FREE:
                        self.first_free += 1
                        self._room(self.first_free)
                    return
            at += step
            step = min(2 * step, max(64, (1 << 22) // len(reach)))

    def walk(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The slot after each number of each sequence, one after another; -1 from where a sequence leaves the trie."""
        out = np.full(len(codes), -1, np.int64)
        starts = np.cumsum(lengths) - lengths
        state = np.zeros(len(lengths), np.int64)
        live = np.flatnonzero(lengths > 0)
        depth = 0
        while len(live):
            at = starts[live] + depth
            to = self.base[state[live]] + codes[at]
            inside = (to > 0) & (to < len(self.check))
            inside &= self.check[np.where(inside, to, 0)] == state[live]
            live, at, to = live[inside], at[inside], to[inside]
            out[at] = state[live] = to
            depth += 1
            live = live[lengths[live] > depth]
        return out


def dense(tokens: np.ndarray) -> np.ndarray:
    """Numbers of turns from 0, in order of first appearance, so that siblings lie close."""
    _, first, inverse = np.unique(tokens, return_index=True, return_inverse=True)
    number = np.empty(len(first), np.int64)
    number[np.argsort(first)] = np.arange(len(first))
    return number[inverse]


NODES = ("key binary, depth long, conv_id long, parent_key binary, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends string")


def _keys(seq: bytes, depth: int) -> list[bytes]:
    """A name of each of the first nodes of a sequence, from the root on: the digest of the turns up to it."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for d in range(depth):
        h.update(seq[d * WIDTH:(d + 1) * WIDTH])
        out.append(h.copy().digest())
    return out


def _shard(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """The nodes of one sub-shard; those it shares with others have a key."""
    order = np.argsort(left.column("i").to_numpy())
    left = left.take(pa.array(order))
    seqs = [bytes(x) for x in left.column("seq").to_pylist()]
    before = left.column("before").to_pylist()
    after = left.column("after").to_pylist()
    for is_before, shared in zip(right.column("is_before").to_pylist(), right.column("shared").to_pylist(), strict=True):
        if is_before:
            before[0] = shared
        else:
            after[-1] = shared
    if any(x is None for x in (*before, *after)):
        raise ValueError("a sequence without its neighbours")
    n, conv = left.column("n").to_numpy(), left.column("conv_id").to_numpy()
    lengths = np.array([len(s) // WIDTH for s in seqs], np.int64)
    raw = np.frombuffer(b"".join(seqs), np.uint8).reshape(-1, WIDTH)
    codes = dense(raw.copy().view(f"S{WIDTH}").ravel())
    own_shared = np.array([0, *before[1:]], np.int64)
    trie = DoubleArray(codes, lengths, own_shared)
    slots = trie.walk(codes, lengths)

    size = len(trie.check)
    of = np.repeat(np.arange(len(seqs)), lengths)
    depth, parent, weight = np.full(size, -1, np.int64), trie.check, np.zeros(size, np.int64)
    starts = np.cumsum(lengths) - lengths
    depth[0], depth[slots] = 0, np.arange(len(slots)) - starts[of] + 1
    weight[slots] = raw[:, 16:].copy().view(">u8").ravel().astype(np.int64)
    n_convs, n_leaves = np.zeros(size, np.int64), np.zeros(size, np.int64)
    least = np.full(size, np.iinfo(np.int64).max, np.int64)
    leaf = (np.array(after, np.int64) < lengths).astype(np.int64)
    np.add.at(n_convs, slots, n[of])
    np.add.at(n_leaves, slots, leaf[of])
    np.minimum.at(least, slots, conv[of])
    n_convs[0], n_leaves[0], least[0] = n.sum(), leaf.sum(), conv.min()
    # shared nodes: on the first path what the shard before has counted already, on the last what others go on with
    counted = np.zeros(size, bool)
    keys: dict[int, bytes] = {}
    for i, shared, mine in ((0, before[0], True), (len(seqs) - 1, after[-1], False)):
        for d, name in enumerate(_keys(seqs[i], max(shared, 0)) if shared >= 0 else []):
            slot = int(slots[starts[i] + d - 1]) if d else 0
            keys[slot] = name
            counted[slot] |= mine
    nodes = np.flatnonzero(depth >= 0)
    nodes = nodes[np.argsort(depth[nodes], kind="stable")]
    fresh = nodes[~counted[nodes]]
    n_children, saved = np.zeros(size, np.int64), np.zeros(size, np.int64)
    np.add.at(n_children, parent[fresh[depth[fresh] > 0]], 1)
    saved[nodes] = (n_convs[nodes] - ~counted[nodes]) * weight[nodes]
    cut = np.searchsorted(depth[nodes], np.arange(1, depth[nodes[-1]] + 2))
    for a, b in reversed(list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))):
        np.add.at(saved, parent[nodes[a:b]], saved[nodes[a:b]])
    ends: list[str | None] = [None] * size
    for i, x in enumerate(left.column("ends").to_pylist()):
        ends[int(slots[starts[i] + lengths[i] - 1]) if lengths[i] else 0] = x
    own = nodes.tolist()
    above = [None if d == 0 else p for d, p in zip(depth[nodes].tolist(), parent[nodes].tolist(), strict=True)]
    return pa.table({
        "key": pa.array([keys.get(s) for s in own], pa.binary()), "depth": depth[nodes], "conv_id": least[nodes],
        "parent_key": pa.array([None if p is None else keys.get(p) for p in above], pa.binary()),
        "parent_conv_id": pa.array([None if p is None else int(least[p]) for p in above], pa.int64()),
        "n_convs": n_convs[nodes], "n_children": n_children[nodes], "n_leaves": n_leaves[nodes],
        "saved_tokens": saved[nodes], "ends": pa.array([ends[s] for s in own], pa.string())})


def prefix_trie(seqs: DataFrame, name: str = "trie") -> DataFrame:
    """One row per node of the trie of ``seqs`` (conv_id, seq): ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of its subtree),
    ``saved_tokens`` (over its subtree, (members - 1) x bytes of the last text), ``ends_sha256`` (of the ids
    of the conversations that end there, ascending, with commas).
    """
    prepare(seqs.sparkSession)
    members = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    chunks = seqs.groupBy("seq", F.expr(f"conv_id div {CHUNK}").alias("chunk")).agg(
        F.count(F.lit(1)).alias("n"), members.alias("members"), F.min("conv_id").alias("conv_id"))
    chunks = materialise(chunks, f"{name}-chunks")
    ranges = chunks.repartitionByRange(pieces_for(chunks, 4 << 20), "seq").sortWithinPartitions("seq", "chunk")
    found = materialise(ranges.select("seq", "n", "conv_id", "members").mapInArrow(_distinct, SORTED), f"{name}-sequences")
    # two rows a range, however many sequences it has
    first = found.where("before IS NULL").select("part", "shard", "seq", F.lit(True).alias("first"))
    last = found.where("after IS NULL").select("part", "shard", "seq", F.lit(False).alias("first"))
    edges = first.unionByName(last).repartition(1).sortWithinPartitions("part", F.desc("first")).mapInArrow(
        _edges, "part int, shard int, is_before boolean, shared long")
    nodes = materialise(found.groupBy("part", "shard").cogroup(
        materialise(edges, f"{name}-edges").groupBy("part", "shard")).applyInArrow(_shard, NODES), f"{name}-nodes")
    shared = materialise(nodes.where("key IS NOT NULL").groupBy("key").agg(
        F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends").alias("ends")), f"{name}-shared")
    above = shared.select(F.col("key").alias("k"), F.col("conv_id").alias("above"))
    final = nodes.where("key IS NULL")
    under = final.where("parent_key IS NOT NULL").drop("key", "parent_conv_id").unionByName(shared.drop("key"))
    under = under.join(above, F.col("parent_key") == F.col("k"), "left").withColumn("parent_conv_id", F.col("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")]
    return final.where("parent_key IS NULL").select(*columns).unionByName(under.select(*columns))
