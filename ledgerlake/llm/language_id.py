"""Language ID by unigrams over pieces, all segmentations summed.

The vocabulary is fixed: the pieces of a public sentencepiece model.  Learning
counts the pieces of the labelled texts of each language, over all of them.  A
word's probability in a language is the sum, over all ways to spell the word
with pieces, of the product of the pieces' probabilities (forward algorithm);
a text's is the product over its words (runs of letters, lower-cased).  A
character that is no piece is spelled by its byte pieces.  Words repeat, so a
worker keeps the score vectors of those it has met, up to a bound.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import arrow_map, give_back, materialise, prepare, texts, worker_state
from ledgerlake.llm.prefix_trie import DoubleArray

WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
SMOOTHING = 0.5
MOST_LANGUAGES = 1000     # the model holds a row for each piece and a column for each language
MOST_WORDS = 200_000      # of a task's store
GROUP_CHARS = 1_000_000   # texts are scored about so much at a time, whole texts
LONG = 40                 # characters; longer words are scored one by one


class Pieces:
    """The vocabulary: text -> number of its piece."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = self.size = self.model.get_piece_size()
        plain = [i for i in range(n) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        self.number = {self.model.id_to_piece(i): i for i in plain}
        self.byte = [self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._grow_trie()

    def _grow_trie(self) -> None:
        """A double-array trie of the pieces, over dense numbers of their characters."""
        own = sorted(self.number)
        points = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32)
        chars, codes = np.unique(points, return_inverse=True)
        self.code = np.full(sys.maxunicode + 1, -1, np.int32)
        self.code[chars] = np.arange(len(chars))
        lengths = np.fromiter(map(len, own), np.int64, len(own))
        shared = [0, *(len(os.path.commonprefix(pair)) for pair in pairwise(own))]
        self.trie = DoubleArray(codes, lengths, np.array(shared, np.int64))
        ends = self.trie.walk(codes, lengths)[np.cumsum(lengths) - 1]
        self.at = np.full(len(self.trie.check), -1, np.int64)     # slot -> number of the piece that ends there
        self.at[ends] = [self.number[x] for x in own]

    def arcs(self, points: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Pieces at each place of a text of code points: (places, length, numbers), by length.  ``left``:
        characters from each place to the end of its word.  All places walk the trie at once."""
        base, check, codes = self.trie.base, self.trie.check, self.code[points].astype(np.int64)
        place, state, n = np.arange(len(points)), np.zeros(len(points), np.int64), 0
        while len(place):
            code = codes[place + n]
            to = base[state] + code
            inside = (code >= 0) & (to > 0) & (to < len(check))
            inside &= check[np.where(inside, to, 0)] == state
            place, state, n = place[inside], to[inside], n + 1
            found = self.at[state]
            yield place[found >= 0], n, found[found >= 0]
            on = left[place] > n
            place, state = place[on], state[on]


def _pieces(model_file: str) -> Pieces:
    state = worker_state()
    key = ("pieces", model_file)
    if key not in state:
        state[key] = Pieces(model_file)
    return state[key]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def learn(labelled: DataFrame, model_file: str, text_col: str = "text",
          lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and the log probability of each piece (row) in each (column).
    Rows without a language are left out.  Counts are summed in each task first."""
    prepare(labelled.sparkSession)
    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def run(batches):
        pieces = _pieces(model_file)
        seen: dict[str, Counter] = {}

        def flush():
            for lang, words in seen.items():
                counts = np.zeros(pieces.size, np.int64)
                own = list(words)
                for i in range(0, len(own), 4096):
                    ids = pieces.model.encode(own[i:i + 4096])
                    many = np.repeat([words[w] for w in own[i:i + 4096]], [len(x) for x in ids])
                    counts += np.bincount(np.fromiter((p for x in ids for p in x), np.int64, len(many)),
                                          many, pieces.size).astype(np.int64)
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(counts[some])],
                    names=["lang", "piece", "n"])
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch, "text"), strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, seen.values())) > MOST_WORDS:
                yield from flush()
        yield from flush()
        give_back()

    counted = materialise(rows.mapInArrow(run, "lang string, piece int, n long")
                          .groupBy("lang", "piece").agg(F.sum("n").alias("n")), "language-counts")
    languages = sorted(r[0] for r in rows.groupBy("lang").count().select("lang").limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    size = _pieces(model_file).size
    counts = np.zeros((size, len(languages)))
    column = {x: i for i, x in enumerate(languages)}
    for r in counted.toLocalIterator():          # at most a row for each piece and language
        counts[r["piece"], column[r["lang"]]] = r["n"]
    return languages, np.log((counts + SMOOTHING) / (counts + SMOOTHING).sum(0, keepdims=True))


class Scorer:
    """Log probabilities of texts in each language."""

    def __init__(self, pieces: Pieces, log_p: np.ndarray):
        self.pieces, self.n_langs = pieces, log_p.shape[1]
        self.log_p = log_p
        self.others: dict[str, int] = {}          # characters spelled by bytes -> row
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((1 << 12, self.n_langs))
        self.letters = np.zeros(1 << 12, bool)

    def _other(self, char: str) -> int:
        if char not in self.others:
            spelled = [self.pieces.byte[b] for b in char.encode("utf-8", "surrogatepass")]
            self.others[char] = len(self.log_p)
            self.log_p = np.vstack([self.log_p, self.log_p[spelled].sum(0)])
        return self.others[char]

    def forward(self, words: list[str]) -> np.ndarray:
        """Log of the sum over all segmentations, for each word and language."""
        spelled = ["▁" + w for w in words]
        lengths = np.fromiter(map(len, spelled), np.int64, len(words))
        points = np.frombuffer("".join(spelled).encode("utf-32-le", "surrogatepass"), np.uint32)
        of = np.repeat(np.arange(len(words)), lengths)
        inner = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        places, ends, pieces = [], [], []
        for at, n, found in self.pieces.arcs(points, lengths[of] - inner):
            places.append(at)
            ends.append(inner[at] + n)
            pieces.append(found)
        plain = np.ones(len(points), bool)        # characters that are no piece are spelled by their bytes
        plain[places[0]] = False
        odd = np.flatnonzero(plain)
        places.append(odd)
        ends.append(inner[odd] + 1)
        pieces.append(np.array([self._other(chr(x)) for x in points[odd].tolist()], np.int64))
        place, end, piece = map(np.concatenate, (places, ends, pieces))
        word, start = of[place], inner[place]
        order = np.lexsort((start, word, end))
        word, start, end, piece = word[order], start[order], end[order], piece[order]
        alpha = np.zeros((len(words), int(lengths.max()) + 1, self.n_langs))
        bounds = np.searchsorted(end, np.arange(1, alpha.shape[1] + 1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            terms = alpha[word[a:b], start[a:b]] + self.log_p[piece[a:b]]
            first = np.flatnonzero(np.r_[True, word[a + 1:b] != word[a:b - 1]])
            top = np.maximum.reduceat(terms, first)
            own = np.repeat(np.arange(len(first)), np.diff(np.r_[first, b - a]))
            alpha[word[a:b][first], end[a]] = top + np.log(np.add.reduceat(np.exp(terms - top[own]), first))
        return alpha[np.arange(len(words)), lengths]

    def _learn(self, fresh: list[str]) -> None:
        while len(self.rows) + len(fresh) > len(self.scores):
            self.scores = np.vstack([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        short = [w for w in fresh if len(w) <= LONG]
        for group in [*(short[i:i + 8192] for i in range(0, len(short), 8192)), *([w] for w in fresh if len(w) > LONG)]:
            at = len(self.rows)
            self.scores[at:at + len(group)] = self.forward(group)
            self.letters[at:at + len(group)] = [any(map(str.isalpha, w)) for w in group]
            self.rows.update(zip(group, range(at, at + len(group)), strict=True))

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each text in each language, and whether it has a letter; about
        ``GROUP_CHARS`` at a time, as lists of words take many times the memory of the text."""
        group = np.cumsum([0, *map(len, texts)])[:-1] // GROUP_CHARS if len(texts) else np.zeros(0, np.int64)
        starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        parts = [self._score(texts[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.rows) > MOST_WORDS:
            self.clear()
        words = [words_of(x) for x in texts]
        fresh = list(set().union(*words) - self.rows.keys())
        if fresh:
            self._learn(fresh)
        total, letter = np.zeros((len(texts), self.n_langs)), np.zeros(len(texts), bool)
        for i, own in enumerate(words):
            at = np.fromiter(map(self.rows.__getitem__, own), np.int64, len(own))
            letter[i] = self.letters[at].any()
            total[i] = self.scores[at[self.letters[at]]].sum(0)
        return total, letter


def _predictor(spark, languages: list[str], log_p: np.ndarray, model_file: str):
    """A function from texts to (language, score); the model is sent to each executor once."""
    sent = spark.sparkContext.broadcast((languages, log_p))

    def predict(own: list[str], state: dict):
        names, model = sent.value
        if not names:
            return [UNDETERMINED] * len(own), [0.0] * len(own)
        if "scorer" not in state:
            state["scorer"] = Scorer(_pieces(model_file), model)
        total, letter = state["scorer"].score(own)
        best = total.argmax(1)
        odds = np.exp(total - total.max(1, keepdims=True))
        score = np.where(letter, 1 / odds.sum(1), 0.0)
        return [names[b] if x else UNDETERMINED for b, x in zip(best, letter, strict=True)], score.tolist()

    return predict


def predict(docs: DataFrame, languages: list[str], log_p: np.ndarray, model_file: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (``und`` without a letter, or if no language was learned)
    and ``score`` (the language's share of the probability; 0 for ``und``)."""
    prepare(docs.sparkSession)
    one = _predictor(docs.sparkSession, languages, log_p, model_file)
    rest = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)

    def run(batches):
        state: dict = {}
        for batch in batches:
            lang, score = one(texts(batch, text_col), state)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f) for f in names), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*names, "lang_pred", "score"])
        state.clear()
        give_back()

    names = [f.name for f in rest]
    return docs.select(*[f"`{n}`" for n in names]).mapInArrow(run, f"{fields}, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """One third of the documents, by the crc32 of the id as text (null id: the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def drop_unknown(docs: DataFrame, model_file: str, least: float = 0.5, batch_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` without texts that have no letter or no language with a share of ``least``;
    the model is learned from the rows that are not held out.  The same columns."""
    from pyspark.sql.types import StructType

    languages, log_p = learn(docs.where(~held_out()), model_file)
    prepare(docs.sparkSession, batch_bytes)
    one = _predictor(docs.sparkSession, languages, log_p, model_file)

    def run(batches):
        state: dict = {}
        for batch in batches:
            lang, score = one(texts(batch, "text"), state)
            yield batch.filter(pa.array([x != UNDETERMINED and s >= least for x, s in zip(lang, score, strict=True)], pa.bool_()))
        state.clear()
        give_back()

    return docs.mapInArrow(run, StructType(docs.schema.fields))
