"""Token ids of a byte-level BPE vocabulary, as little-endian 32-bit bytes."""

from __future__ import annotations

import json
import re

import tiktoken

from .common import worker_cache

# The splitting pattern over characters below U+0250, where the classes are
# plain ranges; other texts take the library's own splitting.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\t-\r \x85\xa0"
PLAIN_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
BEYOND = re.compile("[^\x00-ɏ]")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_CACHED = 300_000


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable
    bytes stand for themselves, the others count up from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class TokenIds:
    """Ids of a text by the vocabulary of a tokenizer file (byte-level BPE)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        as_byte = byte_characters()
        ranks = {bytes(as_byte[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.cache: dict[str, bytes] = {}

    def _of(self, text: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.encoding.encode_ordinary(text))

    def _plain(self, text: str) -> bytes:
        if not text.isascii() and BEYOND.search(text):
            return self._of(text)
        words = PLAIN_SPLIT.findall(text)
        cache = self.cache
        try:
            return b"".join([cache[w] for w in words])
        except KeyError:
            if len(cache) > MAX_CACHED:
                cache.clear()
            out = []
            for w in words:
                ids = cache.get(w)
                if ids is None:
                    ids = self._of(w)
                    if len(w) < 64:
                        cache[w] = ids
                out.append(ids)
            return b"".join(out)

    def __call__(self, text: str) -> bytes:
        if self.cut is None or "<" not in text:
            return self._plain(text)
        return b"".join(self.special[p].to_bytes(4, "little") if p in self.special else self._plain(p) for p in self.cut.split(text) if p)


def token_ids(path: str) -> TokenIds:
    """One instance per worker process and file, with its cache of words."""
    cache = worker_cache()
    if ("tokens", path) not in cache:
        cache["tokens", path] = TokenIds(path)
    return cache["tokens", path]
