"""SimHash near-dedup by covering locality-sensitive hashing.

Every bit position gets one of the 2^(r+1) - 1 non-zero vectors of r+1 bits, in
turn.  Table v (another such vector) keeps the bits whose vector has an odd
product with v.  Two fingerprints at r or fewer differing bits collide in some
table: the vectors of the differing bits span at most r dimensions, so some v
is orthogonal to all of them, and table v hides every differing bit (R. Pagh,
"CoveringLSH", 2018).

Equal fingerprints are one node.  Nodes that share a bucket are not paired: a
hot bucket would give a number of pairs that grows with its square.  Each node
is sent to all points at r/2 or fewer flips of bits that its shared tables hide
(r = 2: itself and one flip each).  Two nodes within r meet in the middle of
their differing bits, and nodes that meet at a point are within r of each
other.  So a point's nodes (65 at most for r = 2) can be linked as a star, no
link is lost and none is false; no bound on bucket sizes is needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import FILE, ROW, arrow_map, located, materialise, prepare, texts, without
from ledgerlake.llm.components import components

BITS, SEED = 64, 42


def covering_masks(radius: int = 2, bits: int = BITS) -> list[int]:
    """The bits that each table keeps; every ``radius`` bits are hidden by some table."""
    vectors = range(1, 1 << (radius + 1))
    return [sum(1 << i for i in range(bits) if (vectors[i % len(vectors)] & v).bit_count() % 2)
            for v in vectors]


def fingerprint(text: str, words: int = 3) -> int:
    """The SimHash of one text: words split at ASCII white space, A-Z lower-cased,
    shingles of ``words`` words (repeats count), XXH64 with seed 42."""
    import xxhash

    own = text.encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return 0
    shingles = map(b" ".join, zip(*(own[i:] for i in range(words)), strict=False)) \
        if len(own) >= words else [b" ".join(own)]
    n = max(1, len(own) - words + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in shingles), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 14):       # bounded, however long the text
        part = hashes[i:i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", words: int = 3) -> DataFrame:
    """Columns ``keep`` and ``fp``, the fingerprint as a signed long."""
    prepare(docs.sparkSession)

    def each(batch):
        own = [fingerprint(x, words) for x in texts(batch, "text")]
        fp = pa.array(np.array(own, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), fp], names=[*keep, "fp"])

    rows = docs.select(*keep, F.col(text_col).alias("text"))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return arrow_map(rows, each, f"{kinds}, fp long")


def links(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """Star edges (a, b) between different fingerprints ``fp`` at ``radius`` or fewer bits.

    For radius 2 (or less): the flips below are of one bit."""
    if radius > 2:
        raise ValueError("points in the middle are spelled out for a radius of 2 or less")
    signed = [int(np.uint64(m).astype(np.int64)) for m in covering_masks(radius)]
    tables = F.array(*[F.struct(F.lit(i).alias("table"), F.lit(m).alias("mask")) for i, m in enumerate(signed)])
    keyed = (nodes.select("fp", F.explode(tables).alias("t"))
             .select("fp", "t.table", "t.mask", F.col("fp").bitwiseAND(F.col("t.mask")).alias("key")))
    shared = keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hidden = (keyed.join(shared, ["table", "key"])
              .groupBy("fp").agg(F.bit_or(F.bitwise_not("mask")).alias("hidden")))
    # the middle of two fingerprints: one of both, or one flip from either
    flips = F.expr(f"transform(filter(sequence(0, {BITS - 1}), i -> (shiftrightunsigned(hidden, i) & 1) = 1), "
                   "i -> fp ^ shiftleft(1L, i))")
    points = hidden.select("fp", F.explode(F.concat(F.array("fp"), flips) if radius == 2
                                           else F.array("fp")).alias("point"))
    met = points.groupBy("point").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("members"))
    return (met.where(F.size("members") > 1).select("a", F.explode("members").alias("b"))
            .where("a <> b").distinct())


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   words: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``docs``: id, ``fp``, ``component_id`` (the smallest id that links
    reach, null ids aside), ``stays`` (one row of each component) and the row's locator.

    Null text counts as empty; texts without words have fingerprint 0.
    """
    rows = located(docs)
    prints = materialise(fingerprints(
        rows.select(F.col(id_col).alias("id"), FILE, ROW, F.col(text_col).alias("text")),
        ["id", FILE, ROW], "text", words), "simhash-prints")
    nodes = materialise(prints.groupBy("fp").agg(
        F.min("id").alias("least"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", FILE, ROW)).alias("first")),      # null ids last
        "simhash-nodes")
    edges = materialise(links(nodes.select("fp"), radius), "simhash-links")
    roots = components(edges, "a", "b")
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", "first", F.coalesce("root", "fp").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("head"))
    of_node = materialise(rooted.join(heads, "root").select("fp", "component_id", "head"), "simhash-components")
    stays = (F.col("head")[FILE] == F.col(FILE)) & (F.col("head")[ROW] == F.col(ROW))
    return prints.join(of_node, "fp").select(
        F.col("id").alias(id_col), "fp", "component_id", stays.alias("stays"), FILE, ROW)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     words: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id."""
    rows = located(docs)
    dropped = simhash_groups(rows, id_col, text_col, words, radius).where("not stays").select(FILE, ROW)
    return without(rows, materialise(dropped, "simhash-dropped"))
