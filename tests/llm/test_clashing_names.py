"""Columns named like those that operators use inside, and windows of other lengths."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import common, decontaminate, exact_dedup, repeats, sharding


def test_sharding_leaves_other_columns_alone(spark):
    df = spark.range(0, 50, 1, 4).selectExpr("id as doc_id", "7 as _at", "8 as at", "9 as _tie", "10 as tie", "11 as _part",
                                             "12 as part", "13 as _place", "14 as place", "15 as of", "16 as _start")
    got = sharding.shard(df, ["doc_id"], 3)
    assert got.columns == [*df.columns, "row_number", "shard", "slot"]
    for r in got.collect():
        assert tuple(r)[1:11] == (7, 8, 9, 10, 11, 12, 13, 14, 15, 16) and r["row_number"] == r["doc_id"]


def test_decontamination_in_parts(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words), "a", 1, 2), (2, "w1 w2", "b", 3, 4)],
                                 "doc_id long, text string, _ranges string, _items int, ranges int")
    bench = spark.createDataFrame([(f"i{k}", " ".join(words[k:k + 15])) for k in range(0, 40, 5)], "item_id string, text string")
    one, many = (decontaminate.scan_docs(docs, bench, most_bytes=size) for size in (1 << 20, 300))
    assert many.columns == one.columns == [*docs.columns, "_scan"]
    assert sorted(map(str, many.select("doc_id", "_ranges", "_items", "ranges", decontaminate.n_hit()).collect())) == \
        sorted(map(str, one.select("doc_id", "_ranges", "_items", "ranges", decontaminate.n_hit()).collect()))


def test_dropped_rows_by_bit_maps(spark, tmp_path):
    rows = [(i, f"t{i % 40}", i, 1) for i in range(120)] + [(5, "t5", 5, 1), (5, "t5", 5, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, bits int, page int").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == list(range(80, 120))
    rows = common.located(docs)
    none = rows.where("false").select(common.FILE, common.ROW)
    assert common.without(rows, none).count() == 122
    assert common.without(rows, rows.select(common.FILE, common.ROW)).count() == 0


@pytest.mark.parametrize("n", [100, 400])
def test_repeats_of_long_windows(spark, n):
    r = random.Random(n)
    passage = "".join(r.choice("abcdefgh ") for _ in range(1500))
    own = []
    for _ in range(40):
        a = r.randrange(900)
        own.append("".join(r.choice("xyz ") for _ in range(r.randint(0, 80))) + passage[a:a + r.randint(100, 600)])
    seen, want = set(), 0
    for text in own:
        hit = [False] * len(text)
        for i in range(len(text) - n + 1):
            if text[i:i + n] in seen:
                hit[i:i + n] = [True] * n
            seen.add(text[i:i + n])
        want += sum(hit)
    found = repeats.repeats(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string"), n=n)
    assert found.select(F.explode("removed").alias("x")).agg(F.sum(F.expr("x.b - x.a"))).first()[0] == want


LOCATORS = "doc_id long, text string, source string, _loc_file string, _LOC_ROW string, _loc_file1 int"


def test_columns_with_the_names_of_locators_come_back(spark, tmp_path):
    from ledgerlake.llm import secrets, simhash, url_lists

    rows = [(i, f"text {i % 4} of some more words", "s", f"f{i}", f"r{i}", i) for i in range(8)]
    spark.createDataFrame(rows, LOCATORS).write.parquet(str(tmp_path / "d"))
    for docs in (spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame(rows, LOCATORS)):
        got = exact_dedup.drop_copies(docs)
        assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == rows[4:]
        again = exact_dedup.drop_copies(got.withColumnRenamed("_loc_file", "other"))
        assert again.columns[3] == "other" and sorted(map(tuple, again.collect())) == rows[4:]
        near = simhash.drop_near_copies(docs)
        assert near.columns == docs.columns and set(map(tuple, near.collect())) <= set(rows[:4])
        assert simhash.simhash_groups(docs).count() == secrets.secret_scan(docs).count() == 8
        bench = spark.createDataFrame([("a", "text 1 of some more words"), ("b", "text 2 of some more words")], "item_id string, text string")
        scanned = decontaminate.scan_docs(docs, bench, most_bytes=20)
        assert scanned.columns == [*docs.columns, "_scan"] and sorted(tuple(x)[:6] for x in scanned.collect()) == rows
        captures = docs.selectExpr("doc_id as page_id", "'http://x.a.b' as url", "1 as day", "_loc_file", "_LOC_ROW")
        entries = spark.createDataFrame([("L", "a.b", 0, "add")], "list string, pattern string, day int, action string")
        judged = url_lists.judge(captures, url_lists.validity(entries), "page_id", "url", "day", 5)
        assert judged.columns[:5] == captures.columns
        assert sorted((x[0], x[3], x[4], x["blocked"]) for x in judged.collect()) == [(i, f"f{i}", f"r{i}", True) for i in range(8)]


def test_simhash_of_string_ids(spark):
    from ledgerlake.llm import simhash

    rows = [("b", "one two three four"), ("a", "one two three four"), (None, "one two three four"), ("c", "other words are here now")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r["doc_id"]: (r["component_id"], r["stays"]) for r in simhash.simhash_groups(docs).collect()}
    assert got == {"b": ("a", False), "a": ("a", True), None: ("a", False), "c": ("c", True)}


def test_equal_segments_are_told_by_all_bytes_of_their_digest(monkeypatch):
    import numpy as np

    digest = np.array([b"a" * 15 + b"x", b"a" * 15 + b"y", b"a" * 15 + b"x", b"\0" * 16], "S16")
    zero = np.zeros(4, np.int64)
    _, first = repeats._earliest(zero.astype(np.uint64), digest, np.arange(4), zero, zero + 1)
    assert first.sum() == 3
    packed = repeats._unpack(repeats._pack(zero.astype(np.uint64), digest, np.arange(4), zero, zero + 1))
    assert (packed[1] == digest).all() and packed[2].tolist() == [0, 1, 2, 3]
    text = bytes(range(32, 127)) * 20
    assert repeats.segments([text, text])[1].dtype.itemsize == 16


def test_packing_without_a_store_forgets_what_other_operators_kept():
    state = common.worker_state()
    state[("pieces", "some file")] = 1
    common.forget()
    assert ("pieces", "some file") not in state and "__name__" in state
