"""Repeated passages: every byte covered by an n-byte string that also starts earlier.

One index over a corpus cannot be built, and need not be.  Each n-byte window
has a minimizer, its k-gram of smallest hash; equal windows have equal ones.
So each text is cut into segments, the stretches of windows that share one
minimizer, and what has to be compared meets where the minimizer's hash sends
it.

1. Segments that are equal to an earlier one (by a digest of 128 bits, beside the 64 of the
   minimizer's hash) are repeats as a whole; most repeated text ends here.  Each task first keeps the earliest of
   its own copies, so a passage in a third of all rows is sent once per task.
2. Different segments of one minimizer (the rims of passages, edits) are
   compared by text: a run-length index of the earlier ones is built, and the
   matching statistics of the later ones are streamed over it.  For "earlier" to
   be exact, the segments of a minimizer, in order, are halved again and again:
   every right half is streamed over an index of its left half.  All halves of
   one size share an index; each pair of halves has symbols of its own.
3. Minimizers with very many different segments (``most_segments``) are compared by
   pieces of these: equal pieces meet by digests that are combined in each task first, and
   different ones only where the bytes that all their windows would share are equal; where
   very many meet even so, they are cut into smaller pieces, down to single windows.  They
   are known before step 1 from a count of the different segments whose digest is one
   of ``share``; theirs are dealt by minimizer and digest, so equal ones still meet and
   no task gathers all of a minimizer.  The count only chooses the way: the result is
   the same by either.

Positions are bytes of UTF-8.  Null text is empty.  Documents are ordered by id,
null first; rows with equal ids by text, then by their place in the input.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise, numbered, plan_bytes, prepare
from ledgerlake.llm.run_index import RunIndex

N, K = 100, 24
MOST_SEGMENTS = 4096
STRETCH = 1 << 17          # windows handled at a time: their arrays stay in the processor's cache
POSITION = np.uint64((1 << 23) - 1)
BUFFER = 400_000           # segments a task holds before it sends them
BUCKET_BYTES = 4 << 20     # of input per bucket of segments
INDEX_SEGMENTS = 8_000     # per index, about
MOST_BUCKETS = 100_000
HOT_BITS = 1 << 20         # of the map of hot minimizers; one taken for hot by mistake only costs time
COUNTED = 64               # different segments of a hot minimizer that are counted, about
# Odd multipliers with well-spread bits.
MIX = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)))


def gram_hashes(buffer: bytes, k: int = K) -> np.ndarray:
    """A hash of the ``k`` bytes (a multiple of 8) from each position."""
    words = np.lib.stride_tricks.as_strided(
        np.frombuffer(buffer, np.uint8), (len(buffer) - 7, 8), (1, 1)).copy().view("<u8").ravel()
    n = len(buffer) - k + 1
    h = np.zeros(n, np.uint64)
    for i in range(0, k, 8):
        h = (h ^ words[i:i + n]) * MIX[i // 8 % 3]
        h ^= h >> np.uint64(31)
    h *= MIX[3]
    return h ^ (h >> np.uint64(29))


def _halves(digest: np.ndarray) -> np.ndarray:
    """Digests of 16 bytes as two columns of 64 bits."""
    return np.ascontiguousarray(digest).view("<u8").reshape(-1, 2)


def segments(texts: list[bytes], n: int = N, k: int = K):
    """The segments of some texts: (minimizer hash, digest, text number, start, windows) arrays."""
    import xxhash

    buffer = b"".join(texts)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    begins = np.r_[0, ends[:-1]] if len(texts) else ends
    out = []
    width = n - k + 1                      # k-grams of a window
    for base in range(0, max(len(buffer) - n + 1, 0), STRETCH):
        part = buffer[base:base + STRETCH + n - 1]
        h = gram_hashes(part, k)
        key = (h & ~POSITION) | np.arange(len(h), dtype=np.uint64)
        least, reach = key, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[:reach - width], least[width - reach:])
        place = (least & POSITION).astype(np.int64)          # of each window's minimizer
        first, last = np.searchsorted(ends, (base, base + len(place) - 1), "right")
        upto = np.minimum(ends[first:last + 1] - base, len(place))
        size = np.diff(np.r_[0, upto])
        doc = np.repeat(np.arange(first, last + 1), size)
        # the windows that end in their own text: all but its last n - 1
        whole = np.arange(len(place)) <= np.repeat(ends[first:last + 1] - base - n, size)
        turn = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | (whole[1:] != whole[:-1])])
        count = np.diff(np.r_[turn, len(place)])
        turn, count = turn[whole[turn]], count[whole[turn]]
        view = memoryview(part)
        digest = np.fromiter((xxhash.xxh3_128_digest(view[a:a + c + n - 1]) for a, c in
                              zip(turn.tolist(), count.tolist(), strict=True)), "S16", len(turn))
        out.append((h[place[turn]], digest, doc[turn], base + turn - begins[doc[turn]], count))
    empty = [np.zeros(0, t) for t in (np.uint64, "S16", np.int64, np.int64, np.int64)]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else tuple(empty)


def _pack(gram, digest, doc, start, count) -> bytes:
    """Segments in columns, documents by number in a table before them: the shuffle compresses it well."""
    names, number = np.unique(doc, return_inverse=True)
    return b"".join([np.array([len(names), len(gram)], "<i8").tobytes(), names.astype("<i8").tobytes(),
                     gram.astype("<u8").tobytes(), digest.tobytes(), number.astype("<u4").tobytes(),
                     start.astype("<u4").tobytes(), count.astype("<u4").tobytes()])


def _unpack(data: bytes):
    names, n = np.frombuffer(data, "<i8", 2)
    at, out = 16, []
    for kind, size in (("<i8", names), ("<u8", n), ("S16", n), ("<u4", n), ("<u4", n), ("<u4", n)):
        out.append(np.frombuffer(data, kind, size, at))
        at += out[-1].nbytes
    table, gram, digest, number, start, count = out
    return gram, digest, table[number], start.astype(np.int64), count.astype(np.int64)


def _earliest(gram, digest, doc, start, count):
    """The segments in order (minimizer, digest, document, start); which is the first of its equals."""
    low, high = _halves(digest).T
    order = np.lexsort((start, doc, high, low, gram))
    sorted_ = tuple(x[order] for x in (gram, digest, doc, start, count))
    g, d = sorted_[:2]
    return sorted_, np.r_[True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])] if len(g) else np.zeros(0, bool)


def _merged(doc, a, b):
    """Spans joined where they touch, by document."""
    order = np.lexsort((a, doc))
    doc, a, b = doc[order], a[order], b[order]
    if not len(doc):
        return doc, a, b
    # ends only grow within a document: shift documents apart to take one running maximum
    rank = np.cumsum(np.r_[0, doc[1:] != doc[:-1]])
    shift = rank * (int(b.max()) + 1)
    reach = np.maximum.accumulate(b + shift)
    first = np.flatnonzero(np.r_[True, a[1:] + shift[1:] > reach[:-1]])
    last = np.r_[first[1:], len(doc)] - 1
    return doc[first], a[first], (reach - shift)[last]


FOUND = "bucket int, data binary, doc long, a long, b long"


def _found(doc, a, b, bucket=-1, data=None) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.broadcast_to(np.int32(bucket), n).copy() if np.isscalar(bucket) else bucket.astype(np.int32)),
         pa.array(data or [None] * n, pa.binary()), *(pa.array(np.asarray(x, np.int64)) for x in (doc, a, b))],
        names=["bucket", "data", "doc", "a", "b"])


def _written(df: DataFrame, name: str) -> DataFrame:
    """``materialise`` into files sized by what they hold: tasks that are sized by the texts they
    read leave little each, and a file of its own for each costs more than to deal the rows once more."""
    return materialise(df.hint("rebalance"), name)


def _hot(docs: DataFrame, n: int, k: int, most_segments: int) -> np.ndarray:
    """A map of ``HOT_BITS``: where the minimizers with over ``most_segments`` different segments
    are (with fewer, down to half of that, when not all are counted)."""
    share = max(1, most_segments // COUNTED)
    over = most_segments if share == 1 else most_segments // 2

    def run(batches):
        for batch in batches:
            gram, digest, *_ = segments([x or b"" for x in batch.column("text").to_pylist()], n, k)
            digest = _halves(digest)[:, 0]
            some = digest % np.uint64(share) == 0
            yield pa.RecordBatch.from_arrays([pa.array(x[some].view(np.int64)) for x in (gram, digest)],
                                             names=["gram", "digest"])

    pairs = docs.select("text").mapInArrow(run, "gram long, digest long").groupBy("gram", "digest").agg(F.lit(1).alias("one"))
    hot = pairs.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * share > over)
    places = hot.select(F.col("gram").bitwiseAND(F.lit(HOT_BITS - 1)).alias("place")).distinct()
    out = np.zeros(HOT_BITS, bool)
    out[places.toArrow().column("place").to_numpy()] = True
    return np.packbits(out)


def _is_hot(gram: np.ndarray, hot: np.ndarray) -> np.ndarray:
    place = (gram & np.uint64(HOT_BITS - 1)).astype(np.int64)
    return (hot[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)


def _cut(docs: DataFrame, buckets: int, n: int, k: int, hot) -> DataFrame:
    """Segments by bucket, packed, the earliest of each task; and spans (a, b) already known to repeat.
    ``hot``: the map of hot minimizers, broadcast."""
    def run(batches):
        held: list[tuple] = []

        def flush():
            (gram, digest, doc, start, count), first = _earliest(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            dealt = np.where(_is_hot(gram, hot.value), gram ^ (_halves(digest)[:, 0] * MIX[0]), gram)
            bucket = (dealt % np.uint64(buckets)).astype(np.int64)
            own = np.flatnonzero(first)
            own = own[np.lexsort((start[own], doc[own], bucket[own]))]
            cuts = np.flatnonzero(np.r_[True, np.diff(bucket[own]) != 0]) if len(own) else np.zeros(0, np.int64)
            parts = np.split(own, cuts[1:]) if len(own) else []
            for i in range(0, len(parts), 64):
                some = parts[i:i + 64]
                zero = np.zeros(len(some), np.int64)
                yield _found(zero, zero, zero, bucket[[p[0] for p in some]],
                             [_pack(*(x[p] for x in (gram, digest, doc, start, count))) for p in some])
            spans = _merged(doc[~first], start[~first], start[~first] + count[~first] + n - 1)
            if len(spans[0]):
                yield _found(*spans, spans[0] % buckets)

        for batch in batches:
            own = [x or b"" for x in batch.column("text").to_pylist()]
            gram, digest, doc, start, count = segments(own, n, k)
            held.append((gram, digest, batch.column("doc").to_numpy()[doc], start, count))
            if sum(len(x[0]) for x in held) >= BUFFER:
                yield from flush()
        if held:
            yield from flush()

    return docs.mapInArrow(run, FOUND)


def _settle(cut: DataFrame, n: int, hot, most_segments: int) -> DataFrame:
    """Per bucket: spans that repeat (``kind`` 0) and segments of minimizers with several
    different ones (``kind``: how many, of hot ones over ``most_segments``; ``gram``: the minimizer)."""
    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        known = pdf[pdf["data"].isna()]
        packed = [_unpack(x) for x in pdf["data"].dropna()]
        out = [pd.DataFrame({"kind": 0, "gram": 0, "doc": known["doc"], "a": known["a"], "b": known["b"]})]
        if packed:
            (gram, _, doc, start, count), first = _earliest(*(np.concatenate(x) for x in zip(*packed, strict=True)))
            end = start + count + n - 1
            d, a, b = _merged(doc[~first], start[~first], end[~first])
            out.append(pd.DataFrame({"kind": 0, "gram": 0, "doc": d, "a": a, "b": b}))
            gram, doc, start, end = (x[first] for x in (gram, doc, start, end))
            many = np.unique(gram, return_inverse=True, return_counts=True)
            size = np.where(_is_hot(gram, hot.value), most_segments + 1, many[2][many[1]])
            some = size > 1
            out.append(pd.DataFrame({"kind": size[some], "gram": gram[some].view(np.int64), "doc": doc[some],
                                     "a": start[some], "b": end[some]}))
        return pd.concat(out, ignore_index=True).astype(np.int64)

    return cut.groupBy("bucket").applyInPandas(settle, "kind long, gram long, doc long, a long, b long")


def earlier_windows(group: np.ndarray, texts: list[bytes], n: int = N) -> list[np.ndarray]:
    """For each text: which of its ``n``-byte windows occur in an earlier text of its group.
    Texts come in order within their group."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(lengths) - lengths
    all_bytes = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    found = np.zeros(len(all_bytes), bool)
    order = np.argsort(group, kind="stable")
    first = np.r_[True, group[order][1:] != group[order][:-1]]
    own = np.empty(len(group), np.int64)           # place in the group
    own[order] = np.arange(len(group)) - np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    number = np.unique(group, return_inverse=True)[1]

    def take(which: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The symbols of some texts, of their pair of halves alone; where they stand."""
        size = lengths[which]
        at = np.repeat(begins[which] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return np.repeat(pair[which] * 256, size) + all_bytes[at], size, at

    level = 0
    while (own >> level).any():
        block = own >> level
        pair = np.unique(number * (int(own.max()) + 1) + (block >> 1), return_inverse=True)[1]
        right = np.flatnonzero(block & 1)
        has_right = np.zeros(int(pair.max()) + 1, bool)
        has_right[pair[right]] = True
        left = np.flatnonzero((block & 1 == 0) & has_right[pair])
        symbols, size, _ = take(left, pair)
        index = RunIndex(symbols, size)
        symbols, size, at = take(right, pair)
        found[at] |= index.statistics(symbols, size) >= n
        level += 1
    return [found[b:b + s] for b, s in zip(begins, lengths, strict=True)]


def related(gram: np.ndarray, texts: list[bytes], n: int = N, k: int = K) -> np.ndarray:
    """Group labels of segments: those with different labels have no ``n``-byte window in common.

    A common window holds the minimizer and at least half of its other bytes lie on one side.
    So two segments that share a window share that many bytes next to the minimizer, to its
    left or to its right; the labels are the components of these two relations.
    """
    import xxhash

    m, half = len(texts), -(-(n - k) // 2)
    sizes = np.fromiter(map(len, texts), np.int64, m)
    ends = np.cumsum(sizes)
    h = gram_hashes(b"".join(texts), k)
    owner = np.repeat(np.arange(m), sizes)[:len(h)]
    at = np.flatnonzero((h == gram.view(np.uint64)[owner]) & (np.arange(len(h)) + k <= ends[owner]))
    found = np.bincount(owner[at], minlength=m)
    place = np.zeros(m, np.int64)
    place[owner[at]] = at - (ends - sizes)[owner[at]]
    number = np.unique(gram, return_inverse=True)[1]
    unclear = np.bincount(number, found != 1)[number] > 0     # a minimizer twice in a segment: one group
    label = np.arange(m)
    relations = []
    for side, room in ((0, place), (1, sizes - place - k)):
        has = np.flatnonzero((room >= half) & ~unclear)
        cuts = [texts[i][p - half:p] if side == 0 else texts[i][p + k:p + k + half]
                for i, p in zip(has.tolist(), place[has].tolist(), strict=True)]
        key = np.fromiter(map(xxhash.xxh3_64_intdigest, cuts), np.uint64, len(has)) ^ (gram[has].view(np.uint64) * MIX[0])
        relations.append((has, np.unique(key, return_inverse=True)[1]))
    relations.append((np.flatnonzero(unclear), number[unclear]))
    changed = True
    while changed:
        changed = False
        for has, key in relations:
            if len(has):
                least = np.full(int(key.max()) + 1, m)
                np.minimum.at(least, key, label[has])
                changed |= bool((least[key] < label[has]).any())
                label[has] = least[key]
    return label


def _texts_of(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(gram, doc, a, text) of the wanted stretches: each document is read once for all of its own."""
    per_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("gram", "a", "b")).alias("wanted"))

    def run(batches):
        for batch in batches:
            rows = [(w["gram"], d, w["a"], t[w["a"]:w["b"]]) for d, t, own in zip(
                *(batch.column(c).to_pylist() for c in ("doc", "text", "wanted")), strict=True) for w in own]
            for i in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(
                    zip(*rows[i:i + 20_000], strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    names=["gram", "doc", "a", "text"])

    return docs.join(per_doc, "doc").mapInArrow(run, "gram long, doc long, a long, text binary")


def _by_index(stretches: DataFrame, buckets: int, n: int, label_of) -> DataFrame:
    """Spans of stretches that occur in an earlier stretch of the same ``gram``; ``label_of`` (gram, texts)
    groups them further: those with different labels have no window in common."""
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["gram", "doc", "a"], ignore_index=True)
        label = label_of(pdf["gram"].to_numpy(), pdf["text"].tolist())
        some = np.bincount(label, minlength=len(pdf))[label] > 1      # others share no window
        pdf, label = pdf[some], label[some]
        hits = earlier_windows(label, pdf["text"].tolist(), n)
        doc, a = pdf["doc"].to_numpy(), pdf["a"].to_numpy()
        if not len(pdf):
            return pd.DataFrame({"doc": doc, "a": a, "b": a})
        where = [np.flatnonzero(h) for h in hits]
        many = np.fromiter(map(len, where), np.int64, len(where))
        at = np.repeat(a, many) + (np.concatenate(where) if where else 0)
        d, s, e = _merged(np.repeat(doc, many), at, at + n)
        return pd.DataFrame({"doc": d, "a": s, "b": e})

    return (stretches.select("gram", "doc", "a", "text").withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets)))
            .groupBy("bucket").applyInPandas(compare, "doc long, a long, b long"))


def places(gram: np.ndarray, texts: list[bytes], n: int = N, k: int = K) -> np.ndarray:
    """Where the minimizer of all windows of each segment starts in it: the first in the last window."""
    m = len(texts)
    sizes = np.fromiter(map(len, texts), np.int64, m)
    begins = np.cumsum(sizes) - sizes
    h = gram_hashes(b"".join(texts), k)
    owner = np.repeat(np.arange(m), sizes)[:len(h)]
    at = np.flatnonzero((h == gram.view(np.uint64)[owner]) & (np.arange(len(h)) >= (begins + sizes - n)[owner]))[::-1]
    place = np.zeros(m, np.int64)
    place[owner[at]] = at - begins[owner[at]]
    return place


PIECES = "piece binary, gram long, doc long, a long, place long, text binary"


def _pieces(stretches: DataFrame, windows: int, n: int, k: int) -> DataFrame:
    """Stretches cut into pieces of at most ``windows`` windows, by the minimizer's place in the window.

    ``gram``: a hash of the bytes that all windows of such a piece have, wherever it is; equal windows
    lie in pieces with equal ones.  ``piece``: a digest of the text; ``place``: the minimizer's.
    """
    def run(batches):
        import xxhash

        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("text").to_pylist()
            place = (batch.column("place").to_numpy() if "place" in batch.schema.names else
                     places(batch.column("gram").to_numpy(), own, n, k))
            rows = []
            for d, a, p, t in zip(batch.column("doc").to_pylist(), batch.column("a").to_pylist(), place.tolist(), own, strict=True):
                least = p - len(t) + n                  # the minimizer's place in the last window; p: in the first
                for q in range(least // windows, p // windows + 1):
                    low, high = q * windows, min(q * windows + windows - 1, n - k)
                    first, last = min(high, p), max(low, least)
                    text = t[p - first:p - last + n]
                    rows.append((xxhash.xxh3_128_digest(text), xxhash.xxh3_64_intdigest(t[p - low:p - high + n], low),
                                 d, a + p - first, first, text))
            for i in range(0, len(rows), 20_000):
                piece, gram, d, a, p, text = zip(*rows[i:i + 20_000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(piece, pa.binary()), pa.array(np.array(gram, np.uint64).view(np.int64)),
                     *(pa.array(c, pa.int64()) for c in (d, a, p)), pa.array(text, pa.binary())],
                    names=["piece", "gram", "doc", "a", "place", "text"])

    return stretches.mapInArrow(run, PIECES)


def _by_piece(stretches: DataFrame, n: int, k: int, most_segments: int) -> list[DataFrame]:
    """The same for minimizers that no task gathers: by ever smaller pieces of their stretches.

    Equal pieces but the earliest are repeats as a whole.  Of the others, those that are alone with their
    common bytes share no window, few ones are compared by index, and only where very many different ones
    meet they are cut again, down to single windows.
    """
    spans, windows, open_ = [], n - k + 1, stretches
    where = F.struct("doc", "a")
    while open_ is not None:
        windows = -(-windows // (2 if open_ is stretches else 4))
        pieces = _written(_pieces(open_, windows, n, k), "repeat-pieces")
        firsts = materialise(pieces.groupBy("gram", "piece").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n")),
                             "repeat-firsts")
        copied = firsts.where("n > 1").select("piece", "gram", "first")
        spans.append(pieces.join(copied, ["gram", "piece"]).where(where != F.col("first"))
                     .select("doc", "a", (F.col("a") + F.octet_length("text")).alias("b")))
        open_ = None
        if windows == 1:
            break
        sizes = firsts.groupBy("gram").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        few, largest = sizes.agg(F.sum(F.when(F.col("size") <= most_segments, F.col("size"))), F.max("size")).first()
        if not largest:
            break
        meeting = firsts.join(sizes, "gram").select("gram", "piece", "first", "size")
        meeting = pieces.join(meeting, ["gram", "piece"]).where(where == F.col("first"))
        if few:
            buckets = max(int(stretches.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-few // INDEX_SEGMENTS))
            spans.append(_by_index(meeting.where(F.col("size") <= most_segments), buckets, n,
                                   lambda gram, texts: np.unique(gram, return_inverse=True)[1]))
        if largest > most_segments:
            open_ = meeting.where(F.col("size") > most_segments).select("doc", "a", "place", "text")
    return spans


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, id, text): ``doc`` is a long in the documents' order, one per row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    if rows.schema["id"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        ids = rows.select("id")
        if ids.where("id is null").isEmpty() and ids.groupBy("id").count().where("count > 1").isEmpty():
            return rows.withColumn("doc", F.col("id").cast("long"))
    return numbered(rows, ["id", "text"], "repeat-rows")[0].withColumnRenamed("row_number", "doc")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, k: int = K,
            most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """One row per row of ``docs``: id, ``removed`` (maximal runs of bytes, as (a, b)), ``text``
    (the whole, binary) and ``kept`` (the bytes left, binary)."""
    spark = prepare(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    rows = keyed.select("doc", "text")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                  min(MOST_BUCKETS, -(-plan_bytes(docs) // BUCKET_BYTES)))
    hot = spark.sparkContext.broadcast(_hot(rows, n, k, most_segments))
    settled = _written(_settle(_cut(rows, buckets, n, k, hot), n, hot, most_segments), "repeat-segments")
    spans = settled.where("kind = 0").select("doc", "a", "b")
    open_ = settled.where("kind > 1")
    counts = open_.agg(F.count(F.lit(1)), F.max("kind")).first()
    if counts[0]:
        index_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-counts[0] // INDEX_SEGMENTS))
        stretches = _texts_of(open_.where(F.col("kind") <= most_segments).select("doc", "gram", "a", "b"), rows)
        spans = spans.unionAll(_by_index(stretches, index_buckets, n, lambda gram, texts: related(gram, texts, n, k)))
        if counts[1] > most_segments:
            large = _texts_of(open_.where(F.col("kind") > most_segments).select("doc", "gram", "a", "b"), rows)
            for own in _by_piece(large, n, k, most_segments):
                spans = spans.unionAll(own)
    per_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("spans"))   # as many as the text's own

    def run(batches):
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in batches:
            removed, kept = [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                own = own or []
                a, b = (np.array([s[c] for s in own], np.int64) for c in "ab")
                _, a, b = _merged(np.zeros(len(a), np.int64), a, b)
                removed.append([{"a": x, "b": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
                kept.append(b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(removed, kind), batch.column("text"), pa.array(kept, pa.binary())],
                names=["id", "removed", "text", "kept"])

    id_kind = keyed.schema["id"].dataType.simpleString()
    out = keyed.join(per_doc, "doc", "left").select("id", "text", "spans").mapInArrow(
        run, f"id {id_kind}, removed array<struct<a:long,b:long>>, text binary, kept binary")
    return out.withColumnRenamed("id", id_col)
