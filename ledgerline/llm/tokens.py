"""Token ids of whole texts by a public tokenizer file, with a cache of words."""

from __future__ import annotations

import os
from functools import cached_property
from unicodedata import is_normalized

import numpy as np

CACHE_WORDS = 250_000  # of each of the two caches kept from block to block, some 50 MB
_PUNCTUATION = b".,;:!?"
_SEPARATOR = "\x01"
_TOGETHER = 4096  # words of one call


class WordTokenizer:
    """Ids of texts for tokenizers that drop white space and never join pieces across it.

    Such a tokenizer gives a text the ids of its words one after the other. Most words of a corpus
    repeat, so their ids come from two caches of bounded size: a full one is kept as ``before`` while the
    next fills, and words met again move over, so common words stay. New words are encoded many in one call:
    words of letters only, with or without closing punctuation, are told apart by the end-of-word
    mark, others by a separator between them. Words that normalising would not change skip it.
    """

    def __init__(self, path: str, end_of_word: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # What is in lower case and composed already stays as it is.
        self.bare.normalizer = None
        vocabulary = self.encoder.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(end_of_word)]] = True
        self.separator = self.ids(self.encoder, _SEPARATOR)
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def ids(self, encoder, text: str) -> np.ndarray:
        return np.array(encoder.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def encode(self, text: str) -> bytes:
        return self.ids(self.encoder, text).tobytes()

    def keep(self, words: list[bytes], ids: np.ndarray, stops: np.ndarray, gap: int = 0) -> None:
        """Cache of each word the ids up to its stop; the next word begins ``gap`` ids behind it."""
        data, at = ids.tobytes(), 0
        for word, stop in zip(words, (stops * 4).tolist(), strict=True):
            self.known[word] = data[at:stop]
            at = stop + 4 * gap

    def learn_letters(self, words: list[bytes], encoder) -> None:
        """Words of letters: each ends with its only end-of-word mark."""
        for at in range(0, len(words), _TOGETHER):
            part = words[at : at + _TOGETHER]
            ids = self.ids(encoder, b" ".join(part).decode())
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part) and stops[-1] == len(ids):
                self.keep(part, ids, stops)
            else:
                self.known.update((word, self.encode(word.decode())) for word in part)

    def learn_others(self, words: list[bytes], encoder) -> None:
        """Words of any characters, with the separator behind each."""
        mark = _SEPARATOR.encode()
        for at in range(0, len(words), _TOGETHER):
            part = words[at : at + _TOGETHER]
            ids = self.ids(encoder, " ".join(f"{word.decode()} {_SEPARATOR}" for word in part))
            stops = np.flatnonzero(ids == self.separator[0])
            if len(self.separator) == 1 and len(stops) == len(part) and not any(mark in word for word in part):
                self.keep(part, ids, stops, gap=1)
            else:
                self.known.update((word, self.encode(word.decode())) for word in part)

    def learn(self, words: set[bytes]) -> None:
        """Put the ids of new words into the cache."""
        known = self.known
        same, folded, forms = set(), set(), []
        others, folded_others = [], []
        for word in words:
            base = word.rstrip(_PUNCTUATION)
            if base.isalpha():  # of bytes: ASCII letters only
                letters, low = True, base.islower()
            else:
                text = base.decode()
                lower = text.lower()
                # Letters that normalising turns into letters and marks are not one piece.
                letters, low = lower.isalpha() and text.isalpha() and is_normalized("NFC", text), text == lower
            if letters:
                if len(base) != len(word):
                    forms.append((word, base))
                if base not in known:
                    (same if low else folded).add(base)
            else:
                text = word.decode()
                (others if text == text.lower() and is_normalized("NFC", text) else folded_others).append(word)
        self.learn_letters(list(same), self.bare)
        self.learn_letters(list(folded), self.encoder)
        tails = {word[len(base) :] for word, base in forms}
        self.learn_others(others + [tail for tail in tails if tail not in known], self.bare)
        self.learn_others(folded_others, self.encoder)
        for word, base in forms:
            known[word] = known[base] + known[word[len(base) :]]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers; null counts as empty."""
        if len(self.known) > CACHE_WORDS:
            self.before, self.known = self.known, {}
        split = []
        for text in texts:
            text = text or ""
            data = text.encode()
            lowered = data.lower()
            # The tokenizer folds case itself, after it has composed characters and found special tokens.
            if b"<|" not in data and (
                text.isascii() or (is_normalized("NFC", text) and is_normalized("NFC", lowered.decode()))
            ):
                data = lowered
            split.append(data.split())
        new = set().union(*split).difference(self.known)
        again = new.intersection(self.before)
        self.known.update((word, self.before[word]) for word in again)
        self.learn(new - again)
        find = self.known.__getitem__
        return [b"".join(map(find, words)) for words in split]


class HeldTokenizer:
    """A file's tokenizer, made where it is first used.

    As a broadcast value it lives as long as a worker's tasks use that broadcast, so that its words do
    not stay in memory beside the work of later jobs.
    """

    def __init__(self, path: str):
        self.path = path

    @cached_property
    def made(self) -> WordTokenizer:
        return WordTokenizer(self.path)
