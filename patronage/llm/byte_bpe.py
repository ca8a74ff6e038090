"""Byte-level BPE ids of whole texts, as the ``tokenizers`` library gives them.

Plain Latin texts are encoded whole by ``tiktoken`` from the same ranks (equal
ids; tested). Of other texts a worker keeps the ids of the space-separated
chunks it has met, since a call of ``tokenizers`` costs several microseconds a
word. The pre-tokenization pattern of such vocabularies always cuts before a
single space between two other characters, so a text's ids are the ids of its
chunks one after another. Texts for which this doesn't hold (runs of white
space, special tokens) go to a library whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

CACHE_CHUNKS = 300_000  # per worker and kind: bounded memory, about 60 MB
SEGMENT_CHARS = 1 << 20  # long texts are cut at spaces into segments of about this
LONG_CHUNK = 5_000  # letters of a word beyond which tiktoken isn't used
PLAIN = re.compile("[\\x20-\\x7e\\xa1-\\u024f\\n]*").fullmatch
ID_TYPE = np.dtype("<u4")


class _WholeText(Exception):
    """The chunk doesn't stand alone."""


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the others follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Cache(dict):
    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _WholeText
        ids = self.encode(self.lead + chunk)
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = ids
        return ids


class ByteBpe:
    """Encoder for a byte-level BPE vocabulary file of ``tokenizers``.

    ``encode(text)`` gives the ids as little-endian unsigned 32-bit integers;
    None counts as an empty text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.largest_id = max([*spec["model"]["vocab"].values(), *[t["id"] for t in spec["added_tokens"]]])
        pre = spec["pre_tokenizer"] or {}
        self.chunked = (spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex")
                        and not pre.get("add_prefix_space") and spec["model"]["type"] == "BPE")
        self.fast = self._ranked(spec["model"]) if self.chunked else None
        self.first = _Cache(self._encode, "")
        self.spaced = _Cache(self._encode, " ")

    @staticmethod
    def _ranked(model: dict):
        """tiktoken over the same vocabulary, if ids follow the merge order."""
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [vocab.get(a + b, -1) for a, b in pairs]
        if any(x >= y for x, y in zip(order, order[1:], strict=False)) or model.get("dropout") or model.get("ignore_merges"):
            return None
        import public_tokenizers
        import tiktoken

        back = {s: b for b, s in byte_symbols().items()}
        ranks = {bytes(back[c] for c in token): i for token, i in vocab.items()}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, text: str) -> bytes:
        if self.fast is not None and len(text) <= LONG_CHUNK and PLAIN(text):
            return self._ranks(text)
        return self._library(text)

    def _ranks(self, text: str) -> bytes:
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(ID_TYPE, copy=False).tobytes()

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, ID_TYPE).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.chunked or any(s in text for s in self.special):
            return self._library(text)
        if self.fast is not None and PLAIN(text) and (len(text) <= LONG_CHUNK or max(map(len, text.split(" "))) <= LONG_CHUNK):
            return b"".join(map(self._ranks, self._parts(text)))
        try:
            return b"".join(self._segments(text))
        except _WholeText:
            return self._encode(text)

    @staticmethod
    def _parts(text: str):
        """A long text in parts that begin with a single space between two other characters."""
        at = 0
        while at < len(text):
            end = text.find(" ", at + SEGMENT_CHARS)
            while 0 <= end < len(text) - 1 and (text[end - 1].isspace() or text[end + 1].isspace()):
                end = text.find(" ", end + 1)
            end = len(text) if end < 0 or end == len(text) - 1 else end
            yield text if end - at == len(text) else text[at:end]
            at = end

    def _segments(self, text: str):
        at, cache = 0, self.first
        while at <= len(text):
            end = text.find(" ", at + SEGMENT_CHARS)
            end = len(text) if end < 0 else end
            chunks = (text if end - at == len(text) else text[at:end]).split(" ")
            if cache is self.first:
                yield cache[chunks[0]]
                del chunks[0]
                cache = self.spaced
            yield b"".join(map(cache.__getitem__, chunks))
            at = end + 1


_LOADED: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """The worker's encoder for a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies (the default of the path parameters)."""
    import public_tokenizers

    return public_tokenizers.path(name)
