"""Packing by first-fit decreasing over a tournament tree of bin capacities.

A document's ids (its text's, then the end id) are cut into full sequences and
a rest.  The pieces are dealt at random into groups of a bounded size, whose
number grows with the input; each group packs its pieces, longest first, into
the first bin with room.  The tree keeps the largest room below each node, so
that bin is found in one walk from the root.  Texts are encoded where they are
read; only lengths and check sums are shuffled, unless ids are asked for.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import FILE, ROW, forget, give_back, located, materialise, prepare, texts
from ledgerlake.llm.tokens import Encoder

CAPACITY, END_ID, SEED = 2048, 1, 20240501
GROUP = 8192      # pieces of a group, about


def first_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item.  Ties keep their order; items longer than ``capacity`` are an error."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n:
        return bins, offsets
    if lengths.max() > capacity:
        raise ValueError("an item is longer than a bin")
    leaves = 1 << (n - 1).bit_length()
    room = [capacity] * (2 * leaves)          # room[k]: the largest room of the bins below node k
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - room[node]
        room[node] -= need
        while node > 1:
            node >>= 1
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return bins, offsets


def pieces(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False,
           keep_words: bool = True, added_tokens: bool = False, batch_bytes: int = 8 << 20) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, ``key`` (a random long of
    the row, the same whenever a task runs again), and the ids if asked for."""
    prepare(docs.sparkSession, batch_bytes)
    rows = located(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                F.xxhash64(FILE, ROW, F.lit(SEED)).alias("key"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        if not keep_words:
            forget()
        encoder = Encoder.of(tokenizer_file, keep_words, added_tokens)
        for batch in batches:
            ids, counts = encoder.encode(texts(batch, "text"))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype("<u4")       # the end id after each document
            counts = counts + 1
            per = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), per)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)) * capacity
            length = np.minimum(capacity, counts[doc] - start)
            at = np.repeat(np.cumsum(counts) - counts, per) + start
            view = memoryview(ids)
            crc = [zlib.crc32(view[a:a + n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            columns = {"id": batch.column("id").take(pa.array(doc)), "start": pa.array(start), "length": pa.array(length),
                       "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(counts[doc]),
                       "key": batch.column("key").take(pa.array(doc))}
            if keep_ids:
                columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(np.r_[at, len(ids)].astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)
        if not keep_words:
            del encoder
            give_back()

    return rows.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, key long"
                           + ", ids array<int>" * keep_ids)


def pack(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP, keep_ids: bool = False,
         keep_words: bool = True, added_tokens: bool = False, batch_bytes: int = 8 << 20) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``.

    Null text counts as empty: one piece, the end id.  Each row is a document of
    its own, also if rows repeat.  An empty table gives no piece.  ``keep_words``: workers
    keep encoded words from task to task; without, their memory is free for other stages.
    ``added_tokens``: see ``Encoder``.  ``batch_bytes``: texts that a task takes at once, about.
    """
    cut = materialise(pieces(docs, tokenizer_file, id_col, text_col, capacity, end_id, keep_ids, keep_words,
                             added_tokens, batch_bytes), "pieces")
    groups = max(1, -(-cut.count() // group))
    cut = cut.withColumn("group", F.pmod(F.xxhash64("key", "start"), F.lit(groups)))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "start"], kind="stable", ignore_index=True)
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), capacity)
        return pdf.assign(sequence_id=(pdf["group"].to_numpy() << 32) + bins, offset=offsets)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    packed = cut.groupBy("group").applyInPandas(place, f"{fields}, sequence_id long, offset long")
    return packed.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
                         "sequence_id", "offset", *["ids"] * keep_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id`` and its ``ids`` in order.  Needs ``keep_ids``;
    a sequence holds no more ids than its capacity."""
    own = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("own"))
    return own.select("sequence_id", F.flatten("own.ids").alias("ids"))
