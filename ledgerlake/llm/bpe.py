"""Byte-pair encoding by forced boundaries, and decoding.

A merge can only join what lies side by side inside some token of the
vocabulary.  Two neighbouring bytes that no token holds side by side can
therefore never end up in one token: the text can be cut there, whatever
stands around, and each fragment encoded by itself.  The ids of the fragments,
one after another, are the ids of the text.

The table of such byte pairs is read off the vocabulary.  In a vocabulary with
word ends the last byte of a word is a symbol of its own, so there the table
tells inner from last bytes; white space, which no token holds, is cut first
(the tokenizer's own pattern splits words, numbers and signs).  Words that were
met before are looked up.  The fragments of new ones are merged many at a time,
the pair of least rank in each fragment at each step; a long fragment is merged
by itself with a heap, so an unbroken run of any length takes n log n steps.

Nulls count as the empty text, which has no ids.  Rows, ties and repeats are
independent of each other: one row out for each row in.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.common import fresh, prepare, texts, worker_state
from ledgerlake.llm.tokens import BYTE_WORDS, CUTS, KNOWN, PLAIN_WORDS, Numbers, byte_alphabet

MOST_WORDS = 200_000      # of a worker's store; then it starts anew
GROUP_CHARS = 1_000_000   # texts are encoded about so much at a time, whole texts
WIDTHS = (4, 8, 16, 32)   # bytes; fragments are merged together by width, longer ones by themselves
NEVER = 1 << 30           # the rank of a pair that does not merge


class ForcedBoundaries:
    """The model of a tokenizer's JSON file: its cuts, its merges, its tokens."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        unusual = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
                   if model.get(k)]
        if model.get("type", "BPE") != "BPE" or unusual:
            raise ValueError(f"not a plain byte-pair model: {unusual or model['type']}")
        self.library = Tokenizer.from_file(tokenizer_file)      # its normaliser and splitter, for other scripts
        self.decoder = (spec.get("decoder") or {}).get("type")
        if self.decoder not in (None, "ByteLevel"):
            raise ValueError(f"unknown decoder {self.decoder}")
        self.suffix = model.get("end_of_word_suffix") or ""
        alphabet = byte_alphabet()
        byte_of = self.byte_of = {c: b for b, c in alphabet.items()}
        vocab: dict[str, int] = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # symbols 0 to 255: bytes; 256 to 511: bytes that end a word (the same ones without word ends)
        last = 256 if self.suffix else 0
        self.last = last
        self.unit = np.full(512, -1, np.int64)
        for b, c in alphabet.items():
            self.unit[b] = vocab.get(chr(c), -1)
            self.unit[256 + b] = vocab.get(chr(c) + self.suffix, -1)
        if (self.unit < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        self.inside = np.zeros((256, 512), bool)
        for token in vocab:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            own = token.removesuffix(self.suffix) if ends else token
            if not own or any(ord(c) not in byte_of for c in own):
                continue
            symbols = [byte_of[ord(c)] for c in own]
            symbols[-1] += last if ends else 0
            for a, b in zip(symbols[:-1], symbols[1:], strict=True):
                self.inside[a, b] = True
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            self.merge[vocab[a], vocab[b]] = rank, vocab[a + b]
        by_rank = sorted((rank, a, b, new) for (a, b), (rank, new) in self.merge.items())
        ranks, a, b, new = np.array(by_rank, np.int64).T
        self.pair_new = np.zeros(ranks[-1] + 1, np.int64)
        self.pair_new[ranks] = new
        n_ids = max([*vocab.values(), *(x["id"] for x in spec["added_tokens"])]) + 1
        order = np.argsort(a * n_ids + b)
        self.pair_keys, self.pair_ranks = (a * n_ids + b)[order], ranks[order]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError("added tokens must be literal")
        literals = sorted(self.added, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, literals)) + ")") if literals else None
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        self.names = [names.get(i, "") for i in range(n_ids)]
        added = set(self.added.values())
        self.bytes = [t.encode() if i in added else bytes(byte_of[ord(c)] for c in t if ord(c) in byte_of)
                      for i, t in enumerate(self.names)]
        normal, split = str(self.library.normalizer), str(self.library.pre_tokenizer)
        self.lower = normal == r'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\s+"), content=" "), Lowercase()])'
        if split == "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)" and normal == "None":
            self.pattern = re.compile(BYTE_WORDS)
        elif self.lower and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in split:
            self.pattern = re.compile(PLAIN_WORDS)
        else:
            self.pattern = None
        self.clear()

    def clear(self) -> None:
        self.numbers = Numbers()                   # word, or id of an added token -> its number
        self.ids = np.zeros(1 << 16, np.uint32)    # ids of all words, one after another
        self.starts = np.zeros(1 << 14, np.int64)  # where the ids of each word start

    # -- words -------------------------------------------------------------------
    def spell(self, part: str) -> list[str]:
        """The words of a text without added tokens, normalised."""
        if self.pattern is not None and KNOWN.match(part):
            lowered = part.lower() if self.lower else part
            if KNOWN.match(lowered):
                return self.pattern.findall(lowered)
        own = part
        if self.library.normalizer is not None:
            own = self.library.normalizer.normalize_str(part)
        return [bytes(self.byte_of[ord(c)] for c in w).decode("utf-8", "surrogatepass")
                for w, _ in self.library.pre_tokenizer.pre_tokenize_str(own)]

    def words_of(self, text: str) -> list[str | int]:
        """The words and added tokens (as ids) of a whole text, in order."""
        out: list[str | int] = []
        parts = self.specials.split(text) if self.specials else [text]
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self.added[part])
            elif part and self.pattern is not None and KNOWN.match(part):
                out += self.spell(part)
            elif part:                             # only cuts with other characters go to the library
                out += chain.from_iterable(map(self.spell, CUTS.findall(part)))
        return out

    # -- fragments ---------------------------------------------------------------
    def cuts(self, spelled: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of the words, one after another; where each fragment starts; each word's number of
        fragments.  Cut is between words, and between bytes that no token holds side by side."""
        symbols = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, spelled), np.int64, len(spelled)))
        symbols[ends - 1] += self.last
        cut = ~self.inside[symbols[:-1] & 255, symbols[1:]]
        cut[ends[:-1] - 1] = True
        starts = np.r_[0, np.flatnonzero(cut) + 1]
        return symbols, starts, np.diff(np.searchsorted(starts, np.r_[0, ends]))

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; ``NEVER`` for one that does not merge, or with a missing side (-1)."""
        key = a * len(self.names) + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], NEVER)

    def _merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """Ids of fragments, a row each (-1: none), merged to the end.  At each step every row joins
        its pair of least rank, of equal ones the leftmost, and moves up what follows."""
        ids = np.hstack([ids, np.full((len(ids), 1), -1)])
        rank = self._rank(ids[:, :-1], ids[:, 1:])
        rows, width = np.arange(len(ids)), rank.shape[1]
        out, columns = ids, np.arange(width + 1)
        while len(rows):
            at = rank.argmin(1)
            least = rank[np.arange(len(rows)), at]
            live = least < NEVER
            if not live.all():
                out[rows[~live]] = ids[~live]
                rows, ids, rank, at, least = rows[live], ids[live], rank[live], at[live], least[live]
                if not len(rows):
                    break
            every = np.arange(len(rows))
            moved = np.minimum(columns + (columns > at[:, None]), width)
            ids = np.take_along_axis(ids, moved, 1)
            rank = np.take_along_axis(rank, np.minimum(moved[:, :-1], width - 1), 1)
            ids[:, -1], rank[:, -1] = -1, NEVER
            ids[every, at] = self.pair_new[least]
            rank[every, at] = self._rank(ids[every, at], ids[every, at + 1])
            left = np.flatnonzero(at)
            rank[left, at[left] - 1] = self._rank(ids[left, at[left] - 1], ids[left, at[left]])
        return out

    def fragment_ids(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all fragments, one after another, and each one's number of them."""
        lengths = np.diff(np.r_[starts, len(symbols)])
        counts = np.zeros(len(starts), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []      # (fragment of each id, ids in order)
        below = 0
        for width in WIDTHS:
            own = np.flatnonzero((lengths > below) & (lengths <= width))
            below = width
            if len(own):
                at = starts[own, None] + np.arange(width)
                ids = np.where(np.arange(width) < lengths[own, None], self.unit[symbols[np.minimum(at, len(symbols) - 1)]], -1)
                ids = self._merge_rows(ids)
                counts[own] = (ids >= 0).sum(1)
                found.append((np.repeat(own, counts[own]), ids[ids >= 0]))
        for i in np.flatnonzero(lengths > below).tolist():
            ids = self.merged(self.unit[symbols[starts[i]:starts[i] + lengths[i]]].tolist())
            counts[i] = len(ids)
            found.append((np.full(len(ids), i), np.array(ids, np.int64)))
        of, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        return ids[np.argsort(of, kind="stable")], counts

    def merged(self, ids: list[int]) -> list[int]:
        """Ids of one fragment, merged: the pair of least rank first, of equal ones the leftmost."""
        n, merge = len(ids), self.merge
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(*merge[p], i, *p) for i, p in enumerate(zip(ids[:-1], ids[1:], strict=True)) if p in merge]
        queue = [(rank, i, a, b, new) for rank, new, i, a, b in queue]
        heapq.heapify(queue)
        while queue:
            rank, i, a, b, new = heapq.heappop(queue)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue                       # one of the two has merged since
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (found := merge.get((new, ids[k]))) is not None:
                    heapq.heappush(queue, (found[0], i, new, ids[k], found[1]))
            h = before[i]
            if h >= 0 and (found := merge.get((ids[h], new))) is not None:
                heapq.heappush(queue, (found[0], h, ids[h], new, found[1]))
        return [x for x in ids if x >= 0]

    def _learn(self, fresh: list[str | int]) -> None:
        """Ids of new words, after those of the ones before."""
        spelled = [x.encode("utf-8", "surrogatepass") if isinstance(x, str) else b"!" for x in fresh]
        symbols, starts, fragments = self.cuts(spelled)
        ids, per_fragment = self.fragment_ids(symbols, starts)
        counts = np.add.reduceat(per_fragment, np.cumsum(np.r_[0, fragments[:-1]]))
        for i in [i for i, x in enumerate(fresh) if isinstance(x, int)]:
            ids[counts[:i].sum()] = fresh[i]       # the place held by one sign
        first = len(self.numbers) - len(fresh)
        while first + len(fresh) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        begin = self.starts[first]
        self.starts[first + 1:first + len(fresh) + 1] = begin + np.cumsum(counts)
        end = begin + len(ids)
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[begin:end] = ids

    # -- texts -------------------------------------------------------------------
    def encode_all(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text; about ``GROUP_CHARS`` at a time."""
        group = np.cumsum([0, *map(len, texts)])[:-1] // GROUP_CHARS if len(texts) else np.zeros(0, np.int64)
        cut = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        return [x for a, b in zip(cut[:-1], cut[1:], strict=True) for x in self._encode(texts[a:b])]

    def _encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        if len(self.numbers) > MOST_WORDS:
            self.clear()
        words: list[str | int] = []
        upto = [0]
        for text in texts:
            words += self.words_of(text)
            upto.append(len(words))
        at = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if self.numbers.fresh:
            self._learn(self.numbers.fresh)
            self.numbers.fresh = []
        begin = self.starts[at]
        lengths = self.starts[at + 1] - begin
        ends = np.cumsum(lengths)
        ids = self.ids[np.repeat(begin - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
        return np.split(ids, np.r_[0, ends][upto[1:-1]])

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids as the library spells it: the bytes of all tokens, or, without a decoder,
        the tokens' names between blanks."""
        own = ids.tolist()
        if self.decoder is None:
            return " ".join(map(self.names.__getitem__, own))
        return b"".join(map(self.bytes.__getitem__, own)).decode("utf-8", "replace")


def _model(tokenizer_file: str) -> ForcedBoundaries:
    state, key = worker_state(), ("forced boundaries", tokenizer_file)
    if key not in state:
        state[key] = ForcedBoundaries(tokenizer_file)
    return state[key]


def _little_endian(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def encode(docs: DataFrame, tokenizer_file: str, text_col: str = "text", keep: list[str] | None = None,
           decoded: bool = False) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_tokens`` (long) and ``ids`` (binary: little-endian
    unsigned 32-bit ids), and with ``decoded`` (the ids' text) if asked for.  Columns of these names
    are replaced.  A null text has no ids, and the empty text when decoded.
    """
    prepare(docs.sparkSession)
    new = ["n_tokens", "ids", *(["decoded"] if decoded else [])]
    rest = [f for f in docs.schema.fields if f.name not in new and (keep is None or f.name in keep)]
    names = [f.name for f in rest]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest)
    text = fresh(names, "text")

    def run(batches):
        model = _model(tokenizer_file)
        for batch in batches:
            own = model.encode_all(texts(batch, text))
            columns = [*(batch.column(i) for i in range(len(names))), pa.array(map(len, own), pa.int64()),
                       pa.array(map(_little_endian, own), pa.binary())]
            if decoded:
                columns.append(pa.array(map(model.decode, own), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *new])

    chosen = docs.select(*[docs[f"`{n}`"] for n in names], docs[f"`{text_col}`"].alias(text))
    return chosen.mapInArrow(run, f"{fields}n_tokens long, ids binary" + ", decoded string" * decoded)


def decode(encoded: DataFrame, tokenizer_file: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids (null ids: null)."""
    prepare(encoded.sparkSession)
    rest = [f for f in encoded.schema.fields if f.name != "decoded"]
    names = [f.name for f in rest]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest)

    def run(batches):
        model = _model(tokenizer_file)
        for batch in batches:
            own = [None if x is None else model.decode(np.frombuffer(x, "<u4")) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(own, pa.string())],
                                             names=[*names, "decoded"])

    return encoded.select(*[encoded[f"`{n}`"] for n in names]).mapInArrow(run, fields + "decoded string")
