"""Token ids in binary files with fixed-width bit packing.

A file holds the documents of one shard, in order.  Layout, little-endian:

    8 bytes   magic
    blocks    each BLOCK ids (the last may have fewer), every id in ``width`` bits,
              the lowest bit first; a block is padded to whole bytes
    u64[]     block offsets, one more than blocks
    i64[]     document ids (0 where null)
    u8[]      1 where the id is not null
    u64[]     start of each document, in ids of this file, and their total
    footer    u32 width, u32 ids per block, u64 documents, u64 ids,
              u64 place of the block offsets, 8 bytes magic

``width`` is the number of bits of the largest id of the vocabulary.  Any range
of ids is read from the blocks it touches and unpacked by numpy as a whole.

Shards are written by tasks to the shared folder under a name of their own for
each attempt; the manifest, a table, lists the files of the attempts that ended
well.  A lost executor's files are never read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise, pieces_for, prepare, scratch, texts
from ledgerlake.llm.tokens import Encoder

MAGIC = b"IDSPACK1"
FOOTER = "<IIQQQ8s"
BLOCK = 4096
READ_IDS = 1 << 20     # ids read at a time


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8), bitorder="little").reshape(-1, 32)[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack_ids(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    out = np.zeros((n, 32), np.uint8)
    out[:, :width] = bits
    return np.packbits(out.ravel(), bitorder="little").view("<u4").astype(np.uint32)


class Writer:
    """Writes one file to an open stream."""

    def __init__(self, stream, width: int, block: int = BLOCK):
        self.stream, self.width, self.block = stream, width, block
        self.left = np.zeros(0, np.uint32)
        self.offsets, self.ids, self.valid, self.counts = [len(MAGIC)], [], [], []
        stream.write(MAGIC)

    def _put(self, ids: np.ndarray) -> None:
        data = pack_ids(ids, self.width)
        self.stream.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        """Documents in order: their ids, all tokens, and each one's number of tokens."""
        if len(ids) and int(ids.max()) >> self.width:
            raise ValueError(f"an id does not fit {self.width} bits")
        self.ids += [x or 0 for x in doc_ids]
        self.valid += [x is not None for x in doc_ids]
        self.counts += counts.tolist()
        self.left = np.concatenate([self.left, ids]).astype(np.uint32)
        whole = len(self.left) // self.block * self.block
        for i in range(0, whole, self.block):
            self._put(self.left[i:i + self.block])
        self.left = self.left[whole:]

    def close(self) -> tuple[int, int, int]:
        """Documents, ids and bytes of the file."""
        if len(self.left):
            self._put(self.left)
        place, n_ids = self.offsets[-1], sum(self.counts)
        tail = (np.array(self.offsets, "<u8").tobytes() + np.array(self.ids, "<i8").tobytes()
                + np.array(self.valid, np.uint8).tobytes()
                + np.concatenate([[0], np.cumsum(self.counts, dtype=np.uint64)]).astype("<u8").tobytes()
                + struct.pack(FOOTER, self.width, self.block, len(self.ids), n_ids, place, MAGIC))
        self.stream.write(tail)
        self.stream.close()
        return len(self.ids), n_ids, place + len(tail)


class Reader:
    """Random access to one file, opened for reading at any place."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        self.width, self.block, self.n_docs, self.n_ids, place, magic = struct.unpack(FOOTER, 
            self._at(size - struct.calcsize(FOOTER), struct.calcsize(FOOTER)))
        if magic != MAGIC:
            raise ValueError("not a file of packed ids, or cut off")
        blocks = -(-self.n_ids // self.block)
        tail = self._at(place, size - struct.calcsize(FOOTER) - place)
        self.offsets = np.frombuffer(tail, "<u8", blocks + 1).astype(np.int64)
        at = 8 * (blocks + 1)
        ids = np.frombuffer(tail, "<i8", self.n_docs, at)
        valid = np.frombuffer(tail, np.uint8, self.n_docs, at + 8 * self.n_docs)
        self.doc_ids = [int(x) if ok else None for x, ok in zip(ids, valid, strict=True)]
        self.starts = np.frombuffer(tail, "<u8", self.n_docs + 1, at + 9 * self.n_docs).astype(np.int64)

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` (exclusive) of the file."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        data = self._at(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        n = min(self.n_ids, (last + 1) * self.block) - first * self.block
        if self.block * self.width % 8 == 0:          # whole blocks join without padding between
            ids = unpack_ids(data, n, self.width)
        else:
            cut = (self.offsets[first:last + 2] - self.offsets[first]).tolist()
            ids = np.concatenate([unpack_ids(data[a:b], min(self.block, n - i * self.block), self.width)
                                  for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))])
        return ids[start - first * self.block:end - first * self.block]

    def document(self, number: int) -> np.ndarray:
        return self.read(int(self.starts[number]), int(self.starts[number + 1]))


def _open(uri: str, write: bool):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    if write:
        system.create_dir(path.rpartition("/")[0], recursive=True)
        return system.open_output_stream(path)
    return system.open_input_file(path)


def write_files(docs: DataFrame, tokenizer_file: str, folder: str | None = None, id_col: str = "doc_id",
                text_col: str = "text", end_id: int = 1, block: int = BLOCK, added_tokens: bool = False) -> DataFrame:
    """Write all documents in ascending order of their integer id (null first); the manifest:
    shard, file, docs, ids, bytes, and ``start``, the ids of all shards before.

    Null text counts as empty.  Rows with equal ids keep the order of the input's partitions.
    ``added_tokens``: see ``Encoder``.
    """
    spark = prepare(docs.sparkSession)
    folder = (folder or scratch(spark, "token-files")).rstrip("/")
    shards = pieces_for(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.monotonically_increasing_id().alias("tie"))
    ranged = rows.repartitionByRange(shards, "id", "tie").sortWithinPartitions("id", "tie").drop("tie")

    def run(batches):
        task = TaskContext.get()
        writer = encoder = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = Encoder.of(tokenizer_file, added_tokens=added_tokens)
                uri = f"{folder}/shard-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
                writer = Writer(_open(uri, True), width_of(encoder.tokenizer.get_vocab_size()), block)
            ids, counts = encoder.encode(texts(batch, "text"))
            ids = np.insert(ids, np.cumsum(counts), end_id)
            writer.add(batch.column("id").to_pylist(), ids, counts + 1)
        if writer is not None:
            done = writer.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([task.partitionId()], pa.int64()), "file": [uri],
                **{k: pa.array([v], pa.int64()) for k, v in zip(("docs", "ids", "bytes"), done, strict=True)}})

    manifest = materialise(ranged.mapInArrow(run, "shard long, file string, docs long, ids long, bytes long"),
                           "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)   # one row per file
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_files(manifest: DataFrame) -> DataFrame:
    """One row per document, read back: doc_id, start (ids of all documents before),
    n_tokens, ids_crc32 (of all its ids as little-endian unsigned 32-bit integers)."""
    def run(batches):
        for batch in batches:
            for uri, base in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                reader = Reader(_open(uri, False))
                starts = reader.starts
                crcs, doc = [], 0
                while doc < reader.n_docs:
                    # as many whole documents as fit one read, or one long document in parts
                    upto = max(doc + 1, int(np.searchsorted(starts, starts[doc] + READ_IDS, "right")) - 1)
                    upto = min(upto, reader.n_docs)
                    if upto > doc + 1 or starts[upto] - starts[doc] <= READ_IDS:
                        view = memoryview(reader.read(int(starts[doc]), int(starts[upto])).astype("<u4"))
                        cut = (starts[doc:upto + 1] - starts[doc]).tolist()
                        crcs += [zlib.crc32(view[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                    else:
                        crc = 0
                        for a in range(int(starts[doc]), int(starts[upto]), READ_IDS):
                            crc = zlib.crc32(reader.read(a, min(a + READ_IDS, int(starts[upto]))).astype("<u4"), crc)
                        crcs.append(crc)
                    doc = upto
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(reader.doc_ids, pa.int64()), "start": pa.array(starts[:-1] + base),
                    "n_tokens": pa.array(np.diff(starts)), "ids_crc32": pa.array(crcs, pa.int64())})

    kept = materialise(manifest, "token-starts")
    files = max(1, kept.count())
    return (kept.repartitionByRange(files, "shard")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))
