"""The pipeline, stage by stage and as a whole, against plain Python; the queries against SQL."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from ledgerlake.llm import oracle, queries
from tests.compare import compare

SF001 = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


class PlainLanguages:
    """The same model by the book: counts, then a forward sum for each word, one at a time."""

    def __init__(self, docs):
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        n = model.get_piece_size()
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.number = {model.id_to_piece(i): i for i in range(n)
                       if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        counts = defaultdict(Counter)
        for r in docs:
            if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
                for w in self.words(r.text):
                    counts[r.lang].update(model.encode(w))
        self.langs = sorted(counts)
        self.p = {x: {i: (counts[x][i] + 0.5) / (sum(counts[x].values()) + 0.5 * n) for i in range(n)} for x in self.langs}
        self.known = {}

    def words(self, text):
        return re.findall(r"[^\W\d_]+", (text or "").lower())

    def word(self, w, lang):
        if (w, lang) not in self.known:
            text, p = "▁" + w, self.p[lang]
            sums = [1.0] + [0.0] * len(text)
            for j in range(1, len(text) + 1):
                for i in range(j):
                    piece = self.number.get(text[i:j])
                    if piece is not None:
                        sums[j] += sums[i] * p[piece]
                    elif j == i + 1:
                        sums[j] += sums[i] * math.prod(p[self.byte[b]] for b in text[i].encode())
            self.known[w, lang] = math.log(sums[-1])
        return self.known[w, lang]

    def __call__(self, text):
        own = [w for w in self.words(text) if any(map(str.isalpha, w))]
        if not own or not self.langs:
            return "und", 0.0
        total = {x: sum(self.word(w, x) for w in own) for x in self.langs}
        best = max(self.langs, key=total.get)
        return best, 1 / sum(math.exp(v - total[best]) for v in total.values())


def plain_language(docs):
    predict = PlainLanguages(docs)
    return [r for r in docs if predict(r.text)[1] >= 0.5]


def plain_exact(docs):
    last = {}
    for r in docs:
        last[lower(r.text)] = max(r.doc_id, last.get(lower(r.text), r.doc_id))
    return [r for r in docs if last[lower(r.text)] == r.doc_id]


def plain_near(docs):
    prints = []
    for r in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(r.text))
        shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        ones = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
        prints.append(sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles)))
    root = list(range(len(docs)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)), key=lambda i: docs[i].doc_id)
                root[y] = x
    return [r for i, r in enumerate(docs) if find(i) == i]


def plain_benchmark(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for text in items:
        w = word.findall(lower(text))
        windows |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    out = []
    for r in docs:
        w, hit = word.findall(lower(r.text)), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
        if not hit or 20 * len(hit) < len(w):
            out.append(r)
    return out


def plain_pieces(docs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    out = set()
    for r in docs:
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        out |= {(r.doc_id, a, min(2048, len(ids) - a), zlib.crc32(ids[a:a + 2048]), len(ids)) for a in range(0, len(ids), 2048)}
    return out


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """sf0.001 with copies, near copies, junk, an empty and a null text, and an extra column."""
    folder = tmp_path_factory.mktemp("planted")
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    some = docs.where("doc_id < 40 and n_chars > 1500")
    passage = bench.orderBy("item_id").first().text
    words = F.split("text", " ")
    added = (docs.where("doc_id in (3, 5, 8)").withColumn("doc_id", F.col("doc_id") + 1000)
             .unionByName(docs.where("doc_id in (3, 5)").withColumns({
                 "doc_id": F.col("doc_id") + 2000, "text": F.upper("text")}))
             .unionByName(some.withColumns({
                 "doc_id": F.col("doc_id") + 3000,
                 "text": F.concat_ws(" ", F.slice(words, 1, F.size(words) - 1), F.lit("zzz"))}))
             .unionByName(docs.where("doc_id in (1, 2)").withColumns({
                 "doc_id": F.col("doc_id") + 4000, "text": F.concat(F.lit(passage + " "), F.substring("text", 1, 200))}))
             .unionByName(spark.createDataFrame(
                 [(5001, None, None, "s", 0), (5002, "", "en", "s", 0), (5003, "123 456 !!", "en", None, 10),
                  (5004, "12 34", None, None, 5)], docs.schema)))
    docs.unionByName(added).withColumn("rows", F.lit(1)).repartition(3).write.parquet(f"{folder}/documents.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_against_plain_python(spark, planted):
    docs = queries.table(spark, planted, "documents")
    columns, rows = docs.columns, docs.collect()
    items = [r.text for r in spark.read.parquet(f"{planted}/benchmark.parquet").collect()]
    plain = {"language_id": plain_language, "exact_dedup": plain_exact, "simhash_near_dedup": plain_near,
             "benchmark_decontamination": lambda d: plain_benchmark(d, items)}
    from ledgerlake.llm.common import materialise
    sizes = [len(rows)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, planted), name)
        rows = plain[name](rows)
        assert docs.columns == columns
        assert sorted(docs.collect(), key=lambda r: r.doc_id) == sorted(rows, key=lambda r: r.doc_id), name
        sizes.append(len(rows))
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == 5      # each stage drops some
    got = corpus_pipeline.run(spark, planted).collect()
    assert {(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got} == plain_pieces(rows)
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for own in used.values():
        ends = [a + n for a, n in sorted(own)]
        assert [a for a, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_the_pipeline_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF001}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF001}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(oracle.queries()) <= set(entry.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(oracle.queries()))
def test_query_matches_its_sql(spark, name):
    assert compare(spark, SF001, [name], verbose=False)[name] == "ok"


def test_every_query_gives_a_row_per_document(spark):
    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    for name in ("op2_exact_dedup", "op3_decontamination", "op4_repeats", "op5_simhash", "op7_language_id",
                 "op8_sharding", "op9_token_files", "op10_secrets"):
        got = entry.queries()[name](spark, SF001)
        assert got.count() == n == got.select("doc_id").distinct().count(), name
