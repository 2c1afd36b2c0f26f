"""Secret scans with corpus-wide ownership frequency.

Patterns find candidates in whole texts.  Their values, hashed, are counted
over the corpus by distinct repositories and distinct owners.  A value that
many owners or many repositories carry is a copied example; one that a single
owner carries in few repositories and that looks random is a live-looking
credential, and gets a span of its own kind, ``live``, over the value.
Repositories that hold it only in exact copies of one text count once there: a
document that was copied as a whole says nothing about its values.  Values leave
the scan as hashes only.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import FILE, ROW, located, materialise, prepare, texts

# The patterns and the least lengths.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")     # maximal runs, so the least length can be part of the pattern
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "live")
LEAST_VALUE = 6
PLACEHOLDER = re.compile(r"(?i)example|sample|changeme|placeholder|dummy|your|test|xxx|1234567|abcdef")
EXAMPLE_OWNERS = 3       # so many owners make a value a copied example
EXAMPLE_REPOS = 10       # or so many repositories, exact copies once
LEAST_BITS, LEAST_LIVE = 2.5, 12


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def candidates(text: str) -> list[tuple[int, int, int, int, int, str]]:
    """(kind, start, end, value start, value end, value), by start, then kind; code points."""
    found = [(0, m.start(), m.end(), m.start(2), m.end(2), m[2])
             for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], x[0]))


def looks_live(value: str) -> bool:
    return len(value) >= LEAST_LIVE and entropy(value) >= LEAST_BITS and not PLACEHOLDER.search(value)


def scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """One row per row: id, locator, owner, repo, the base counts, ``base``, ``found`` and, if
    something is found, ``digest`` of the text."""
    prepare(docs.sparkSession)
    rows = located(docs).select(F.col(id_col).alias("id"), FILE, ROW, F.col(owner_col).cast("string").alias("owner"),
                                F.col(repo_col).cast("string").alias("repo"), F.col(text_col).alias("text"))
    one = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value_start", pa.int64()),
                     ("value_end", pa.int64()), ("hash", pa.string()), ("random", pa.bool_())])
    keep = ["id", FILE, ROW, "owner", "repo"]

    def run(batches):
        for batch in batches:
            all_found, base, digests = [], [], []
            for text in texts(batch, "text"):
                own = candidates(text)
                digests.append(hashlib.sha256(text.encode()).digest() if own else None)
                base.append(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b, *_ in own))
                all_found.append([{"kind": k, "start": a, "end": b, "value_start": c, "value_end": d,
                                   "hash": hashlib.sha256(v.encode()).hexdigest(), "random": looks_live(v)}
                                  for k, a, b, c, d, v in own])
            counts = [pa.array([sum(x["kind"] == k for x in f) for f in all_found], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *counts, pa.array(base, pa.string()), pa.array(all_found, pa.list_(one)),
                 pa.array(digests, pa.binary())],
                names=[*keep, "n_assign", "n_access", "n_hex", "base", "found", "digest"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {FILE} string, {ROW} long, owner string, repo string, n_assign long, "
                           "n_access long, n_hex long, base string, found array<struct<kind:int,start:long,end:long,"
                           "value_start:long,value_end:long,hash:string,random:boolean>>, digest binary")


def ownership(found: DataFrame) -> DataFrame:
    """hash -> ``n_repos``, ``n_owners``, ``n_sources``: the repositories after all rows of equal
    text were given to the first of theirs.  Counts are combined in their tasks first: a value
    that a third of all rows carry is spread by repository or text, then by owner.  A null owner
    or repository is one of its own."""
    by_repo = found.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.sum("one").alias("repos"))
    counts = by_owner.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))
    by_text = found.groupBy("hash", "digest").agg(F.min(F.struct("owner", "repo")).alias("first"))
    by_first = by_text.groupBy("hash", "first").agg(F.lit(1).alias("one"))
    return counts.join(by_first.groupBy("hash").agg(F.sum("one").alias("n_sources")), "hash")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                repo_col: str = "doc_id", example_owners: int = EXAMPLE_OWNERS,
                example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """One row per row of ``docs``: id, base counts, ``base`` (base spans, joined), ``spans`` (with
    the live ones), ``verdicts`` (per candidate: kind, start, end, verdict, n_repos, n_owners).

    Verdicts: ``example`` (``example_owners`` owners or more, or ``example_repos`` repositories or
    more, exact copies of a text counted once), ``live`` (one owner, fewer repositories, looks
    random), else ``unclear``.  Null text counts as empty.
    """
    scanned = materialise(scan(docs, id_col, text_col, owner_col, repo_col), "secrets")
    each = scanned.where(F.size("found") > 0).select(FILE, ROW, "owner", "repo", "digest", F.explode("found").alias("f"))
    each = each.select(FILE, ROW, "owner", "repo", "digest", "f.*")
    stats = materialise(ownership(each), "secret-owners")
    verdict = (F.when((F.col("n_owners") >= example_owners) | (F.col("n_sources") >= example_repos), "example")
               .when((F.col("n_owners") == 1) & F.col("random"), "live").otherwise("unclear"))
    judged = each.join(stats, "hash").withColumn("verdict", verdict)
    # a row's own candidates: bounded by its text
    by_row = judged.groupBy(FILE, ROW).agg(F.sort_array(F.collect_list(F.struct(
        "start", "kind", "end", "value_start", "value_end", "verdict", "n_repos", "n_owners"))).alias("own"))
    names = F.array(*map(F.lit, KINDS))
    base = F.transform("own", lambda x: F.struct(x["start"].alias("a"), x["kind"].alias("k"), x["end"].alias("b")))
    live = F.transform(F.filter("own", lambda x: x["verdict"] == "live"), lambda x: F.struct(
        x["value_start"].alias("a"), F.lit(3).alias("k"), x["value_end"].alias("b")))
    spans = F.array_join(F.transform(F.array_sort(F.array_distinct(F.concat(base, live))), lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["a"].cast("string"), x["b"].cast("string"))), ",")
    verdicts = F.transform("own", lambda x: F.struct(
        F.get(names, x["kind"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        x["verdict"].alias("verdict"), x["n_repos"].alias("n_repos"), x["n_owners"].alias("n_owners")))
    by_row = by_row.select(FILE, ROW, spans.alias("spans"), verdicts.alias("verdicts"))
    return scanned.drop("found", "owner", "repo", "digest").join(by_row, [FILE, ROW], "left").select(
        F.col("id").alias(id_col), "n_assign", "n_access", "n_hex", "base",
        F.coalesce("spans", F.lit("")).alias("spans"), "verdicts")
