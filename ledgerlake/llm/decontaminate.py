"""Benchmark decontamination with one Aho-Corasick automaton.

Every window of the benchmark texts (questions, answers) is one pattern of a
single automaton, which each task runs once over each normalised text.
Normalising works on UTF-8 bytes and keeps their number, then joins the words
by single blanks; the start of every word before and after is kept, so hits
come back as words, and as byte offsets of the original text.

The windows are made in Spark tasks and sent to all executors only while they fit
``most_bytes``.  A larger benchmark is dealt by window into parts of about that
size.  Each part is a job of its own, whose hits are written before the next one
starts, so a task holds the automaton of one part; then the hits of a row are
joined.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import FILE, LOWER, ROW, UPPER, arrow_map, carried, fresh, located, materialise, prepare

# word bytes: digits, a-z and all of a non-ASCII character; other bytes become a blank
TABLE = bytes(ord(LOWER[UPPER.index(chr(b))]) if chr(b) in UPPER
              else b if chr(b).isdigit() and b < 128 or chr(b) in LOWER or b >= 128 else 32
              for b in range(256))
N = 13


def normalised(text: str | None) -> bytes:
    """The text's bytes, A-Z lower-cased, all but word bytes blank: as long as the original."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE)


def windows(text: str | None, n: int = N) -> list[bytes]:
    """All windows of ``n`` consecutive words; fewer words, but not none, are one window."""
    words = normalised(text).split(b" ")
    words = [w for w in words if w]
    return list(dict.fromkeys(b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))) if words else []


def joined_ranges(spans) -> list[tuple[int, int]]:
    """Ranges (first, end), in order, joined where they meet or overlap."""
    merged: list[tuple[int, int]] = []
    for start, end in spans:
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


class Scanner:
    """The automaton of some patterns: ``patterns`` maps a window to its numbers of items."""

    def __init__(self, patterns: dict[bytes, list[int]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for window, items in patterns.items():
            # blanks at both ends: whole words only.  Latin-1 stands for bytes.
            self.automaton.add_word(f" {window.decode('latin-1')} ", (len(window), items))
        if patterns:
            self.automaton.make_automaton()
        self.empty = not patterns

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words; merged hit ranges (first word, end); numbers of the items found."""
        words = normalised(text).split()
        if not words or self.empty:
            return len(words), [], set()
        joined = b" " + b" ".join(words) + b" "
        found = [(end - n, end, items) for end, (n, items) in self.automaton.iter(joined.decode("latin-1"))]
        if not found:
            return len(words), [], set()
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)  # of each word in ``joined``
        spans = sorted({(int(np.searchsorted(ends, start)), int(np.searchsorted(ends, end)) + 1)
                        for start, end in {(s, e - 1) for s, e, _ in found}})
        merged = joined_ranges(spans)
        return len(words), merged, {i for _, _, items in found for i in items}


def byte_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as byte ranges of the original text."""
    is_word = np.frombuffer(b" " + normalised(text) + b" ", np.uint8) != 32
    edges = np.flatnonzero(is_word[1:] != is_word[:-1])
    starts, ends = edges[::2], edges[1::2]
    return [(int(starts[a]), int(ends[b - 1])) for a, b in ranges]


def _windows(benchmark: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(window, item): each window of each item once, made in Spark tasks."""
    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = windows(text, n)
                if own:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.binary()), pa.array([item or ""] * len(own), pa.string())], names=["window", "item"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return materialise(rows.mapInArrow(run, "window binary, item string").distinct(), "benchmark-windows")


def _scanner(part: pa.Table) -> tuple[Scanner, list[str]]:
    """The automaton of a part's windows, and the names of its items."""
    items: dict[str, int] = {}
    found: dict[bytes, list[int]] = {}
    for window, item in zip(part.column("window").to_pylist(), part.column("item").to_pylist(), strict=True):
        found.setdefault(window, []).append(items.setdefault(item, len(items)))
    return Scanner(found), list(items)


RANGES = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
SCAN = pa.struct([("words", pa.int64()), ("ranges", RANGES), ("items", pa.list_(pa.string()))])
SCAN_DDL = "struct<words:long,ranges:array<struct<a:long,b:long>>,items:array<string>>"


def _fields(fields) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)


def _scan_once(docs: DataFrame, part, text_col: str, into: str) -> DataFrame:
    """``docs`` with ``into`` of (words, hit ranges, item names) by one automaton."""
    def run(batches):
        scanner, names = _scanner(part.value)
        for batch in batches:
            out = []
            for text in batch.column(text_col).to_pylist():
                n, ranges, items = scanner.scan(text)
                out.append({"words": n, "ranges": [{"a": a, "b": b} for a, b in ranges], "items": [names[i] for i in items]})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, SCAN)], names=[*batch.schema.names, into])

    return docs.mapInArrow(run, f"{_fields(docs.schema.fields)}{into} {SCAN_DDL}")


def _scan_parts(docs: DataFrame, parts: list[DataFrame], text_col: str, into: str) -> DataFrame:
    """The same, part after part: a job for each, over locators and texts, that writes the rows with hits."""
    sent = docs.sparkSession.sparkContext.broadcast
    had = docs.columns
    docs = located(docs)
    texts = docs.select(FILE, ROW, F.col(f"`{text_col}`").alias("text"))
    hits = None
    for part in parts:
        packed = sent(part.toArrow())
        found = _scan_once(texts, packed, "text", "found").where(F.size("found.items") > 0)
        written = materialise(found.select(FILE, ROW, "found.ranges", "found.items"), "benchmark-hits")
        packed.destroy()
        hits = written if hits is None else hits.unionAll(written)
    # a row's own hits, from each part at most once
    own = [fresh(had, "ranges"), fresh(had, "items")]
    per_row = hits.groupBy(FILE, ROW).agg(F.flatten(F.collect_list("ranges")).alias(own[0]),
                                          F.flatten(F.collect_list("items")).alias(own[1]))
    joined = docs.join(per_row, [FILE, ROW], "left").select(*carried(docs), *own)

    def run(batches):
        for batch in batches:
            out = []
            for text, ranges, items in zip(*(batch.column(c).to_pylist() for c in (text_col, *own)), strict=True):
                spans = joined_ranges(sorted((x["a"], x["b"]) for x in ranges or []))
                out.append({"words": len(normalised(text).split()), "ranges": [{"a": a, "b": b} for a, b in spans],
                            "items": list(dict.fromkeys(items or []))})
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in had), pa.array(out, SCAN)], names=[*had, into])

    return joined.mapInArrow(run, f"{_fields(joined.schema.fields[:len(had)])}{into} {SCAN_DDL}")


def scan_docs(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
              item_text: str = "text", n: int = N, most_bytes: int = 4 << 20, into: str = "_scan") -> DataFrame:
    """``docs`` with ``into``: the text's number of words, the ranges of words inside any
    occurrence of a window, and the distinct items whose windows occur.

    ``most_bytes`` of windows make one automaton: 4 MB of them take some 200 MB in a Python
    worker; a larger benchmark is scanned part after part.  Null has no words.  An item named twice counts once; a null item id is the empty name.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.drop(into)
    rows = _windows(benchmark, item_id, item_text, n)
    total = rows.agg(F.sum(F.octet_length("window") + F.octet_length("item"))).first()[0] or 0
    parts = max(1, -(-int(total) // most_bytes))
    if parts == 1:
        return _scan_once(docs, spark.sparkContext.broadcast(rows.toArrow()), text_col, into)
    dealt = materialise(rows.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(parts)).cast("int")),
                        "benchmark-parts", ["part"])
    return _scan_parts(docs, [dealt.where(F.col("part") == i).drop("part") for i in range(parts)], text_col, into)


def n_hit(scan: str = "_scan"):
    """Number of words in the ranges, each once."""
    order = f"array_sort({scan}.ranges)"
    return F.expr(f"aggregate({order}, named_struct('n', 0L, 'upto', 0L), (s, r) -> named_struct("
                  "'n', s.n + greatest(0L, r.b - greatest(r.a, s.upto)), 'upto', greatest(s.upto, r.b)), s -> s.n)")


def contaminated(scan: str = "_scan"):
    """Hit words are at least one in twenty."""
    hit = n_hit(scan)
    return (hit > 0) & (20 * hit >= F.col(f"{scan}.words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows; the same columns."""
    columns = docs.columns
    return scan_docs(docs, benchmark).where(~contaminated()).select(*[f"`{c}`" for c in columns])


def items_digest(names: list[str]) -> str:
    """Hex SHA-256 of the names, sorted, comma-joined."""
    return hashlib.sha256(",".join(sorted(set(names))).encode()).hexdigest()
