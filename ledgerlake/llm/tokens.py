"""Token ids of whole texts by a public tokenizer, words encoded once per worker.

A tokenizer of the ``tokenizers`` library splits a text into words and encodes
each by itself.  Most words of a corpus repeat, so the ids of a word are kept
for the life of the Python worker (up to a bound, then the store starts anew)
and a text costs one look-up per different word of a group of texts, whose words
Arrow cuts and numbers as columns.  Texts are cut before white space: no
word of either pattern goes on from another character into white space, so the
ids of the cuts, in order, are those of the text.  A sign such as a comma between
a letter and white space is a cut of its own: there are fewer different ones.
A text with an added token
of the tokenizer's file (such as ``<|endoftext|>``) goes to the library whole.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerlake.llm.common import worker_state

# Unicode white space, and the letters and digits up to U+017F.
SPACE = "\t-\r \x85\xa0  -     　"
LATIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
LATIN_NUMBERS = "0-9²³¹¼-¾"
LATIN_SPACE = "\t-\r \x85\xa0"
LAST_LATIN = "ſ"
GROUP_CHARS = 4_000_000
BYTE_WORDS = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN_LETTERS}]+| ?[{LATIN_NUMBERS}]+"
              rf"| ?[^{LATIN_SPACE}{LATIN_LETTERS}{LATIN_NUMBERS}]+|[{LATIN_SPACE}]+(?![^{LATIN_SPACE}])|[{LATIN_SPACE}]+")
PLAIN_WORDS = (rf"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN_LETTERS}]+|[{LATIN_NUMBERS}]"
               rf"|[^{LATIN_SPACE}{LATIN_LETTERS}{LATIN_NUMBERS}]+")
# Cuts that the patterns above split as the library does.
KNOWN = re.compile(rf"[\t\n\r -{LAST_LATIN}]*\Z")
CUTS = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
# Texts (of Arrow, patterns of RE2) with more than one blank or line feed between words, or a mark.
ODD = (r"^[ \n]|[ \n]$|[ \n][ \n]|[\t\x01\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
       r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
SIGN = r"([A-Za-z])([,.;:?!])( |$)"


def byte_alphabet() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 stays, other bytes go to U+0100 and on."""
    stay = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = [b for b in range(256) if b not in stay]
    return {b: b for b in stay} | {b: 256 + i for i, b in enumerate(moved)}


class Numbers(dict):
    """Numbers new keys in order and lists them in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.fresh.append(key)
        return number


class Encoder:
    """``encode(texts)`` gives the ids of all texts in one array and each text's number of ids.

    ``tokenizer_file``: a JSON file of the ``tokenizers`` library.
    ``most_words``: the bound of the store of encoded cuts.
    ``added_tokens``: the file's added tokens are found in texts, as the library does by itself;
    without, their strings are ordinary text.
    ``group_chars``: how much text is cut into words at a time, about.
    """

    def __init__(self, tokenizer_file: str, most_words: int = 1_000_000, added_tokens: bool = False,
                 group_chars: int = GROUP_CHARS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if added_tokens:
            # tokens that are sought in the normalised text cannot be ruled out by a scan of the original
            literals = [] if any(x.normalized for x in added) else [re.escape(x.content) for x in added]
            self.added = re.compile("|".join(literals)) if literals or added else None
        else:
            self.tokenizer.encode_special_tokens = True
            self.added = None
        self.most_words, self.group_chars = most_words, group_chars
        self.alphabet = byte_alphabet()
        parts = str(self.tokenizer.pre_tokenizer)
        self.lower = str(self.tokenizer.normalizer) == \
            r'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\s+"), content=" "), Lowercase()])'
        byte_level = parts == "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
        if byte_level and self.tokenizer.normalizer is None:
            self.words = re.compile(BYTE_WORDS)
        elif self.lower and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in parts:
            self.words = re.compile(PLAIN_WORDS)
        else:
            self.words = None          # unknown splitting: the library does all of it
        self.clear()

    @classmethod
    def of(cls, tokenizer_file: str, keep_words: bool = True, added_tokens: bool = False) -> "Encoder":
        """The worker's encoder of this file, or one for a single task."""
        if not keep_words:
            return cls(tokenizer_file, 100_000, added_tokens, GROUP_CHARS // 16)
        key = ("encoder", tokenizer_file, added_tokens)
        state = worker_state()
        if key not in state:
            state[key] = cls(tokenizer_file, added_tokens=added_tokens)
        return state[key]

    def clear(self) -> None:
        self.numbers = Numbers()                   # cut -> its number
        self.word_ids: dict[str, list[int]] = {}
        self.ids = np.zeros(1 << 16, np.uint32)    # ids of all cuts, one after another
        self.starts = np.zeros(1 << 14, np.int64)  # where the ids of each cut start

    def _cuts(self, texts: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
        """The cuts of all texts, and each text's number of them.  A cut that follows one blank is
        written without it; others get a mark, so that equal keys have equal ids."""
        kind = pa.large_string()
        whole = pa.array(texts, kind)
        odd = pc.match_substring_regex(whole, ODD)
        odd = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        even = pc.replace_substring(whole, "\n", " \n")       # one blank or line feed between words
        even = pc.binary_join_element_wise(pa.scalar("\x01", kind), even, pa.scalar("", kind))
        if self.words is not None:
            even = pc.replace_substring_regex(even, SIGN, "\\1 \x01\\2\\3")
        cuts = pc.split_pattern(even, " ")
        none = [i for i, text in enumerate(texts) if not text]
        if len(odd) or none:
            other = {i: ["\x01" + x for x in CUTS.findall(texts[i])] for i in odd.tolist()} | dict.fromkeys(none, [])
            place = np.arange(len(texts))
            place[list(other)] = len(texts) + np.arange(len(other))
            cuts = pa.concat_arrays([cuts, pa.array(list(other.values()), cuts.type)]).take(pa.array(place))
        return cuts.flatten(), cuts.value_lengths().to_numpy()

    def _cut_ids(self, key: str) -> list[int]:
        if key.isascii() and key.isalpha() and self.words is not None:      # most: one word, its letters spell it
            word = key.lower() if self.lower else " " + key
            ids = self.word_ids.get(word)
            if ids is None:
                spelled = word if self.lower else chr(self.alphabet[32]) + key
                ids = self.word_ids[word] = [x.id for x in self.tokenizer.model.tokenize(spelled)]
            return ids
        cut = key[1:] if key[0] == "\x01" else key if key[0] == "\n" else " " + key
        spelled = unicodedata.normalize("NFC", cut).lower() if self.lower else cut
        if self.words is None or not KNOWN.match(cut) or not KNOWN.match(spelled):
            return self.tokenizer.encode(cut, add_special_tokens=False).ids
        found = [self.word_ids.get(x) or self._word(x) for x in self.words.findall(spelled)]
        return found[0] if len(found) == 1 else list(chain.from_iterable(found))

    def _word(self, word: str) -> list[int]:
        spelled = word.encode().decode("latin-1").translate(self.alphabet)
        ids = self.word_ids[word] = [x.id for x in self.tokenizer.model.tokenize(spelled)]
        return ids

    def _learn(self, fresh: list[str]) -> None:
        found = [self._cut_ids(x) for x in fresh]
        first, lengths = len(self.numbers) - len(fresh), np.fromiter(map(len, found), np.int64, len(found))
        while first + len(fresh) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        begin = self.starts[first]
        self.starts[first + 1:first + len(fresh) + 1] = begin + np.cumsum(lengths)
        end = begin + int(lengths.sum())
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[begin:end] = np.fromiter(chain.from_iterable(found), np.uint32, end - begin)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and each text's number of them; about ``group_chars`` at a time,
        whole texts, as the cuts take many times the memory of the text."""
        group = np.cumsum([0, *map(len, texts)])[:-1] // self.group_chars if len(texts) else np.zeros(0, np.int64)
        starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        parts = [self._encode(texts[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.numbers) > self.most_words:
            self.clear()
        whole = [i for i, text in enumerate(texts) if self.added.search(text)] if self.added else []
        own_ids = [np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32) for i in whole]
        if whole:
            texts = list(texts)
            for i in whole:
                texts[i] = ""
        flat, counts = self._cuts(texts)
        flat = flat.dictionary_encode()
        gc.disable()          # the store holds millions of strings and no cycles
        try:
            cuts = flat.dictionary.to_numpy(zero_copy_only=False)
            at = np.fromiter(map(self.numbers.__getitem__, cuts), np.int64, len(cuts))
            if self.numbers.fresh:
                self._learn(self.numbers.fresh)
                self.numbers.fresh = []
        finally:
            gc.enable()
        at = at[flat.indices.to_numpy()]
        begin = self.starts[at]
        lengths = self.starts[at + 1] - begin
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(begin - (ends - lengths), lengths) + np.arange(total)]
        upto = np.concatenate([[0], ends])[np.cumsum(np.r_[0, counts])]
        counts = np.diff(upto)
        if whole:
            counts[whole] = [len(x) for x in own_ids]
            ids = np.insert(ids, np.repeat(upto[whole], counts[whole]), np.concatenate(own_ids))
        return ids, counts
