"""The Merkle manifest and its versions against trees in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import merkle, queries
from ledgerlake.llm.places import places

SIZES = {"one": 1, "two": 2, "a": 16, "b": 17, "c": 256, "d": 257, "e": 273, None: 40, "": 5, "é": 4097, "Z": 300}


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def levels(nodes):
    out = [list(nodes)]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def plain(leaves, changed):
    """{key: (leaf, subroot, root, proof, folded root)} and all nodes; leaves: {source: [(key, leaf)] in order}."""
    order = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x for _, x in leaves[s]]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out, copies = {}, {}
    for si, s in enumerate(order):
        for i, (key, leaf) in enumerate(leaves[s]):
            at, folded, proof, own = i, changed.get(key, leaf), "", []
            for tree, level, name in [*((trees[s], k, s) for k in range(len(trees[s]) - 1)),
                                      *((top, k, "upper") for k in range(len(top) - 1))]:
                if tree is top and level == 0:
                    at = si
                first = at // 16 * 16
                run = list(tree[level][first:first + 16])
                proof += "".join(run[:at - first] + run[at - first + 1:])
                run[at - first] = folded
                folded, at = h(*run), at // 16
                own.append((name, level + 1, at, folded))
            out[key] = (leaf, trees[s][-1][0], top[-1][0], proof, folded)
            if key in changed:
                copies[key] = own
    nodes = {(s, k, i): x for s in order for k, row in enumerate(trees[s]) for i, x in enumerate(row)}
    nodes |= {("upper", k, i): x for k, row in enumerate(top) for i, x in enumerate(row)}
    return out, copies, nodes


def name(tree):
    return "upper" if tree is None else None if tree == "" else tree[1:]


@pytest.fixture(scope="module")
def made(spark):
    rows, leaves, changed, key = [], defaultdict(list), {}, 0
    for source, n in SIZES.items():
        for i in range(n):
            leaf = h(f"{source}-{i}")
            new = h("new", leaf) if key % 5 == 0 else None
            rows.append((key, source, leaf, new, f"x{i}", 1, "t"))
            leaves[source].append((key, leaf))
            if new:
                changed[key] = new
            key += 1
    docs = spark.createDataFrame(rows, "id long, tree string, leaf string, changed string, place string, size int, digest string")
    # the digest column of the table is another one than the leaf
    found = merkle.build(docs, "id", "tree", keep=("changed",))
    return found, *plain(leaves, changed)


def test_proofs_and_versions(made):
    manifest, want, copies, _ = made
    got = merkle.versions(manifest, "changed").collect()
    assert len(got) == len(want)
    for r in got:
        assert (r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"]) == want[r["id"]]
        own = r["copies"]
        assert (own is None) == (r["id"] not in copies)
        if own is not None:
            assert [(name(c["tree"]), c["level"], c["place"], c["digest"]) for c in own] == copies[r["id"]]


def test_a_version_shares_all_but_its_copies(made):
    manifest, _, copies, nodes = made
    stored = {(name(r["tree"]), r["level"], r["place"]): r["digest"] for r in manifest.nodes().collect()}
    assert stored == nodes
    for key, own in list(copies.items())[:50]:
        assert {x[:3] for x in own} <= set(nodes) and all(nodes[x[:3]] != x[3] for x in own), key
    assert manifest.root() == max(((k, v) for k, v in nodes.items() if k[0] == "upper"), key=lambda x: x[0][1])[1]


def test_no_group_has_more_rows_than_a_block(made):
    manifest = made[0]
    for tier in manifest.forest.tiers:
        blocks = tier.groupBy("tree", F.expr(f"place div {merkle.BLOCK}").alias("block")).count()
        assert blocks.agg(F.max("count")).first()[0] <= merkle.BLOCK


def test_the_query_with_nulls_repeats_and_long_texts(spark, tmp_path):
    rows = [(i, f"Text {i} É", "en", "s", 7) for i in range(40)]
    rows += [(3, "Text 3 É", "en", "s", 7), (3, "other", None, "s", None), (None, None, None, None, None),
             (None, "x", "de", "s", 1), (90, "Long Words " * 300_000, "en", "t", 3_300_000), (91, "", "", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    leaves, changed, want = defaultdict(list), {}, []

    def leaf(r, text):
        return h(*map(value, (r[0], r[3], r[2], r[4], text)))

    ordered = sorted(enumerate(rows), key=lambda x: ((x[1][0] is not None, x[1][0] or 0), leaf(x[1], x[1][1])))
    for i, r in ordered:
        leaves[r[3]].append((i, leaf(r, r[1])))
        if zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5 == 0:
            changed[i] = leaf(r, r[1] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]))
    out, _, _ = plain(leaves, changed)
    for i, r in enumerate(rows):
        x = out[i]
        want.append((r[0], x[0], x[1], x[2], h(x[3]), x[4], x[4] == x[2]))
    got = queries.op11_merkle(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert any(not r["verified"] for r in got) and any(r["verified"] for r in got)


def test_one_leaf_and_no_leaf(spark):
    one = spark.createDataFrame([(1, "s", "abc")], "doc_id long, source string, leaf string")
    r = merkle.versions(merkle.build(one, "doc_id", "source")).first()
    assert (r["subroot"], r["root"], r["proof"], r["folded_root"], r["copies"]) == ("abc", "abc", "", "abc", None)
    empty = merkle.build(one.where("false"), "doc_id", "source")
    assert empty.root() is None and merkle.versions(empty).count() == 0 and empty.nodes().count() == 0


def test_places_of_a_hot_group_come_from_many_parts(spark):
    spark_rows = spark.range(0, 3000, 1, 16).selectExpr("id", "if(id % 3 = 0, 'hot', concat('g', id % 7)) as of", "id % 5 as n", "1 as at", "2 as part")
    got = places(spark_rows, "of", ["n", "id"], "test-places")
    assert got.columns == ["id", "of", "n", "at", "part", "place", "size"]
    seen = defaultdict(list)
    for r in got.collect():
        seen[r["of"]].append(r)
        assert r["at"] == 1 and r["part"] == 2
    for own in seen.values():
        own.sort(key=lambda r: (r["n"], r["id"]))
        assert [r["place"] for r in own] == list(range(len(own))) and {r["size"] for r in own} == {len(own)}
