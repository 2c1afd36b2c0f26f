"""Forced-boundary encoding against the library, on scripts, signs, added tokens and long runs."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import bpe, queries

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
POOLS = ["abc de'fs tll \n", "aäößÉéàçñ .,!?0123 ", "the'S 'Re'll  \t\r\n", "日本語 кириллица Σσς İıſ ÅÅé x",
         "😀👍 ​　\x85\xa0\x00\x07\x0b\x0ć̇", "<|endoftext|> <|startoftext|>a b", "qzxjkv0o9_-+=/\\{}[]"]


def samples(n, seed=5):
    r = random.Random(seed)
    pieces = ["<|endoftext|>", "the", "THE ", "éa", "\n", " ", "<|startoftext|>", "ing", "''s", "\x0b"]
    own = [None, "", " ", "\n\t ", "a" * 3000, "ab" * 900, "漢字" * 500, "<|endoftext|>", "\x00\x01\x1c x", "z" * 200_000]
    while len(own) < n:
        pool = "".join(r.sample(POOLS, r.randint(1, 3)))
        own.append("".join(r.choice(pool) for _ in range(r.randint(0, 80))) if r.random() < 0.6
                   else r.choice(["", " "]).join(r.choice(pieces) for _ in range(r.randint(0, 12))))
    return own


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_and_text_are_those_of_the_library(path):
    model, library = bpe.ForcedBoundaries(path), Tokenizer.from_file(path)
    for text in samples(1500):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert model.encode(text or "").tolist() == ids, text
        assert model.decode(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)
    own = [x or "" for x in samples(1500)]
    many = bpe.ForcedBoundaries(path).encode_all(own)
    assert [x.tolist() for x in many] == [library.encode(x, add_special_tokens=False).ids for x in own]


def test_no_token_holds_a_cut():
    """The cuts are certain: no token of the vocabulary spans one."""
    model = bpe.ForcedBoundaries(WORDS)
    tokens = [t for t in Tokenizer.from_file(WORDS).get_vocab() if t not in model.added]
    inner = [bytes(model.byte_of[ord(c)] for c in t.removesuffix("</w>")) for t in tokens]
    whole = [x for t, x in zip(tokens, inner, strict=True) if t.endswith("</w>")]
    assert set(model.cuts(whole)[2].tolist()) == {1}
    # inside a word: the token is not cut, whatever follows
    begun = [x for t, x in zip(tokens, inner, strict=True) if not t.endswith("</w>")]
    symbols, starts, counts = model.cuts([x + b"!" for x in begun])
    assert set(counts.tolist()) <= {1, 2} and (np.add.reduceat(np.diff(np.r_[starts, len(symbols)]), np.cumsum(counts) - counts)
                                               == [len(x) + 1 for x in begun]).all()
    assert model.cuts([b"xqzjvkq", b"the"])[2][0] > 1


def one_by_one(model, ids):
    """Merged a pair at a time: the least rank, of equal ones the leftmost."""
    ids = list(ids)
    while found := [(model.merge[p][0], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in model.merge]:
        _, i = min(found)
        ids[i:i + 2] = [model.merge[ids[i], ids[i + 1]][1]]
    return ids


def test_fragments_are_merged_as_one_by_one():
    model = bpe.ForcedBoundaries(WORDS)
    r = random.Random(2)
    own = [bytes(r.choice(b"thenigaros") for _ in range(r.randint(1, 50))) for _ in range(400)] + [b"a", b"aaaa", b"a" * 32, b"a" * 33]
    symbols, starts, counts = model.cuts(own)
    ids, per_fragment = model.fragment_ids(symbols, starts)
    ends = np.cumsum(per_fragment)
    for start, end, a, b in zip(starts, [*starts[1:], len(symbols)], ends - per_fragment, ends, strict=True):
        plain = one_by_one(model, model.unit[symbols[start:end]].tolist())
        assert ids[a:b].tolist() == plain == model.merged(model.unit[symbols[start:end]].tolist())


def test_stores_start_anew(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_WORDS", 7)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 50)
    test_ids_and_text_are_those_of_the_library(WORDS)


def test_encode_and_decode_tables(spark):
    own = samples(200)
    rows = [(i, x, f"n{i}", i) for i, x in enumerate(own)] + [(3, own[20], None, 1), (3, own[20], None, 1), (None, "a b", "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, _text int")
    library = Tokenizer.from_file(WORDS)
    encoded = bpe.encode(docs, WORDS, decoded=True)
    assert encoded.columns == ["doc_id", "text", "_text", "n_tokens", "ids", "decoded"]
    got = encoded.collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    again = bpe.decode(bpe.encode(docs, WORDS), WORDS)
    assert sorted(map(str, again.select("doc_id", "decoded").collect())) == sorted(map(str, encoded.select("doc_id", "decoded").collect()))
    nulls = spark.sql("SELECT CAST(NULL AS BINARY) AS ids")
    assert bpe.decode(nulls, WORDS).first()["decoded"] is None


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(docs, WORDS, decoded=True).count() == 0


def test_the_query_against_the_library(spark, tmp_path):
    own = samples(60)
    spark.createDataFrame(list(enumerate(own)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(WORDS)
    got = {r["doc_id"]: r for r in queries.op13_bpe(spark, str(tmp_path)).collect()}
    for i, x in enumerate(own):
        ids = library.encode(x or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
