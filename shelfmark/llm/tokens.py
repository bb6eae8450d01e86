"""Tokenizer files and tables of already encoded words, one per Python worker.

A table only saves work: past `TABLE_WORDS` entries it keeps the half used last, whatever the corpus holds.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Callable, Iterable

TABLE_WORDS = 300_000

_LOADED: dict = {}


def tokenizer_path(name: str) -> str:
    """Where the installed tokenizer files lie on this machine; a full path is returned as it is."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def once_per_worker(key, load: Callable):
    if key not in _LOADED:
        _LOADED[key] = load()
    return _LOADED[key]


def packed_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTable:
    """Works each distinct word out once: word -> whatever `work` gives for it."""

    def __init__(self, work: Callable[[list], Iterable], limit: int = TABLE_WORDS):
        self.work, self.half, self.known, self.older = work, limit // 2, {}, {}

    def of(self, words: list) -> list:
        try:
            return [*map(self.known.__getitem__, words)]
        except KeyError:
            pass
        if len(self.known) > self.half:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = []
        for word in set(words).difference(known):
            if word in older:
                known[word] = older[word]
            else:
                missing.append(word)
        if missing:
            known.update(zip(missing, self.work(missing)))
        return [*map(known.__getitem__, words)]
