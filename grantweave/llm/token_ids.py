"""Ids of the public byte-level BPE vocabulary."""

from __future__ import annotations

import array
import base64
import json
import re

import public_tokenizers
import tiktoken

_adjacent = re.compile(r"\s\s")
#: the part of the vocabulary's split that matters only where white space is adjacent
_RUNS = r"|\s+(?!\S)"


class TextIds:
    """Encodes texts to bytes of native 32-bit ids.

    The added tokens that the vocabulary's JSON file lists are one id wherever they occur in a text; what lies
    between them is encoded by itself, as ordinary text.

    The split of the vocabulary looks ahead at runs of white space, which makes its pattern slow. A text
    in which no two white-space characters touch is split by the pattern without that part; the
    result is the same and takes two thirds of the time.
    """

    def __init__(self, ranks_path: str | None = None, added_path: str | None = None):
        path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(added_path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
            self._added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        longest_first = sorted(self._added, key=len, reverse=True)
        self._at_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self._added else None

        def encoding(name: str, pattern: str) -> tiktoken.Encoding:
            return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

        self._any = encoding("byte-bpe", public_tokenizers.PATTERN)
        self._plain = encoding("byte-bpe-plain", public_tokenizers.PATTERN.replace(_RUNS, ""))

    def encode(self, text: str) -> bytes:
        if not any(token in text for token in self._added):
            return self._ordinary(text)
        parts = self._at_added.split(text)
        return b"".join(
            array.array("I", [self._added[p]]).tobytes() if i % 2 else self._ordinary(p) for i, p in enumerate(parts)
        )

    def _ordinary(self, text: str) -> bytes:
        encoding = self._any if _adjacent.search(text) else self._plain
        return array.array("I", encoding.encode_ordinary(text)).tobytes()
