"""Learned counts and whole texts' scores of language ID, by brute force."""

import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from ledgerlake.llm import language_id

PIECES = public_tokenizers.path("piece_bpe_32k.model")
ROWS = [(1, "The cat sat. The CAT!", "en"), (2, "le chat été", "fr"), (3, None, "en"), (4, "", "fr"), (5, "12 _ 3", "en"),
        (6, "nobody's", None), (7, "le Chat le chat", "fr"), (8, "日本 ß", "xx"), (8, "日本 ß", "xx")]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(*r, "x", 1, 2) for r in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, piece string, n int, score int")


def plain_counts():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    out = {}
    for _, text, lang in ROWS:
        if lang is not None:
            own = out.setdefault(lang, Counter())
            for word in language_id.WORD.findall((text or "").lower()):
                own.update(model.encode(word))
    return model, out


def test_learned_probabilities_are_counts_of_pieces(labelled):
    languages, log_p = language_id.learn(labelled, PIECES)
    model, counts = plain_counts()
    assert languages == sorted(counts)
    for i, lang in enumerate(languages):
        n = [counts[lang][p] + language_id.SMOOTHING for p in range(model.get_piece_size())]
        assert np.allclose(log_p[:, i], np.log(np.array(n) / sum(n)), rtol=0, atol=1e-12)


def plain_word(pieces, p, text):
    """The sum over all ways to spell a text with pieces; a character that is none is spelled by its bytes."""
    if not text:
        return 1.0
    total = 0.0
    for n in range(1, len(text) + 1):
        own = pieces.number.get(text[:n])
        if own is not None:
            total += p[own] * plain_word(pieces, p, text[n:])
        elif n == 1:
            total += math.prod(p[pieces.byte[b]] for b in text[0].encode()) * plain_word(pieces, p, text[1:])
    return total


def test_scores_of_whole_texts(labelled):
    learned = language_id.learn(labelled, PIECES)
    pieces, probability = language_id.Pieces(PIECES), np.exp(learned[1])
    got = language_id.predict(labelled, *learned, PIECES).collect()
    assert len(got) == len(ROWS) and got[0]["n"] == 1
    for r in got:
        words = [w for w in language_id.WORD.findall((r["text"] or "").lower()) if any(map(str.isalpha, w))]
        if not words:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        each = np.array([math.prod(plain_word(pieces, probability[:, i], "▁" + w) for w in words)
                         for i in range(len(learned[0]))])
        assert r["lang_pred"] == learned[0][each.argmax()]
        assert r["score"] == pytest.approx(each.max() / each.sum(), rel=1e-9)


def test_arcs_are_all_pieces_at_all_places():
    pieces = language_id.Pieces(PIECES)
    words = ["▁the", "▁été", "▁日本x", "▁" + "abc" * 20, "▁qz"]
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    left = np.concatenate([np.arange(len(w), 0, -1) for w in words])
    got = {(p, n, x) for at, n, found in pieces.arcs(points, left) for p, x in zip(at.tolist(), found.tolist(), strict=True)}
    want, first = set(), 0
    for w in words:
        for i in range(len(w)):
            want |= {(first + i, j - i, pieces.number[w[i:j]]) for j in range(i + 1, len(w) + 1) if w[i:j] in pieces.number}
        first += len(w)
    assert got == want


def test_empty_tables(labelled):
    learned = language_id.learn(labelled, PIECES)
    empty = labelled.where("false")
    assert language_id.predict(empty, *learned, PIECES).count() == 0
    assert language_id.drop_unknown(empty, PIECES).count() == 0
    assert language_id.learn(empty, PIECES)[0] == []
