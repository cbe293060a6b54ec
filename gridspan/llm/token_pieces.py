"""Encoding by a library tokenizer through a cache of words.

Both vocabularies split a text before they merge, and never merge over certain places.  Words between
such places are encoded once per worker by the library itself, in batches, and looked up after
that.  Texts for which the places are not certain go to the library whole or, when very long, in
parts cut where one blank stands between two other characters.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

CACHE_WORDS = 400_000
BATCH_BYTES = 1_000_000


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def by_bytes(texts: list[str], limit: int = BATCH_BYTES):
    """Index lists of about ``limit`` characters each; texts of like length stand together."""
    order = np.argsort([len(t) for t in texts], kind="stable")
    group, size = [], 0
    for i in order:
        if group and size + len(texts[i]) > limit:
            yield group
            group, size = [], 0
        group.append(int(i))
        size += len(texts[i])
    if group:
        yield group


def encode_all(tokenizer, texts: list[str]) -> list[list[int]]:
    """Library ids of each text, encoded in batches balanced by size."""
    out: list[list[int]] = [[]] * len(texts)
    for group in by_bytes(texts):
        found = tokenizer.encode_batch([texts[i] for i in group], add_special_tokens=False)
        for i, e in zip(group, found):
            out[i] = e.ids
    return out


class WordCache:
    """A map from word to encoded value of bounded size; words not met lately go first."""

    def __init__(self, encode: Callable[[list[str]], list], limit: int = CACHE_WORDS):
        self.encode, self.limit = encode, limit
        self.young: dict = {}
        self.old: dict = {}

    def learn(self, words) -> dict:
        """A dictionary that holds all of ``words`` (it may be larger than the limit)."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        missing = []
        for w in set(words).difference(self.young):
            value = self.old.get(w)
            if value is None:
                missing.append(w)
            else:
                self.young[w] = value
        if missing:
            self.young.update(zip(missing, self.encode(missing)))
        return self.young


def is_plain(text: str, parts: list[str]) -> bool:
    """Whether all white space of the text is single blanks and line ends between words."""
    return text.replace("\n", " ") == " ".join(parts)


def safe_parts(text: str, limit: int) -> list[str]:
    """Parts of about ``limit`` characters, cut before a blank that stands alone between two others.

    Such a blank begins a new word for both vocabularies, so the parts' ids are the text's.
    Where no such place follows, the part is longer.
    """
    parts, start, n = [], 0, len(text)
    while n - start > limit:
        at = text.find(" ", start + limit)
        while at > 0 and at + 1 < n and (text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0 or at + 1 >= n:
            break
        parts.append(text[start:at])
        start = at
    parts.append(text[start:])
    return parts
