"""BPE encoding by backtracking, and decoding by an offset table.

Merging a word pair by pair takes more than linear time. The same tokens are
found from left to right instead: at each place take the longest token that
starts there (one Aho-Corasick pass finds all of them) if the merges would
keep it apart from the token before; otherwise try its next shorter prefix,
and if there is none, step back over the token before. Each place is left at
most once, so the work is linear in the word.

Two tokens are compatible if no merge that comes earlier would reach across
their border. That is decided by undoing merges from both sides, latest
first, and kept in a table.

Normalizing and cutting a text into words follow the vocabulary file: by the
library's own parts, or for plain Latin text by the same pattern here, with
equal results (tested).
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.byte_bpe import ID_TYPE, SEGMENT_CHARS, byte_symbols, vocabulary
from patronage.llm.common import prepare

CACHE_WORDS = 300_000  # per worker and table: bounded memory
_PLAIN = re.compile("[\\x21-\\x7e\\xa1-\\xac\\xae-\\u012f\\u0132-\\u024f]*").fullmatch
_LAST = 0xE000  # a word's last symbol is another letter of the alphabet: moved up by this
#: Fixed value: the cutting pattern for which words never span white space.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BATCH_BYTES = 4 << 20


class Merges:
    """The merge list as a linear-time encoder of single words.

    Tokens are numbered by merge order: first the alphabet, then each merge's
    result. A word is a string over the alphabet; with an end-of-word suffix,
    its last symbol is moved up by ``_LAST``.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        def inner(token: str) -> str:
            if suffix and token.endswith(suffix):
                body = token[:-len(suffix)]
                return body[:-1] + chr(ord(body[-1]) + _LAST)
            return token

        made = {a + b for a, b in merges}
        alphabet = [t for t in vocab if t not in made and len(inner(t)) == 1]
        self.suffix = suffix
        self.number: dict[str, int] = {}
        self.left: list[int] = []   # the merge that makes a token; itself for the alphabet
        self.right: list[int] = []
        self.merged: dict[tuple[int, int], int] = {}
        self.ids: list[int] = []
        for t in alphabet:
            self._add(inner(t), vocab[t], None)
        for a, b in merges:
            pair = self.number[inner(a)], self.number[inner(b)]
            if inner(a + b) not in self.number:
                self.merged[pair] = self._add(inner(a + b), vocab[a + b], pair)
        self.compatible_table: dict[tuple[int, int], bool] = {}
        names = list(self.number)
        whole = [n for n in range(len(names)) if self.left[n] == n or self._apart(self.left[n], self.right[n], n)]
        usable = {names[n]: n for n in whole}
        self.length = [len(s) for s in names]
        self.shorter = [-1] * len(names)
        self.automaton = ahocorasick.Automaton()
        for s, n in usable.items():
            self.automaton.add_word(s, n)
            self.shorter[n] = next((usable[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in usable), -1)
        self.automaton.make_automaton()

    def _add(self, name: str, token_id: int, pair: tuple[int, int] | None) -> int:
        n = self.number[name] = len(self.ids)
        self.ids.append(token_id)
        self.left.append(pair[0] if pair else n)
        self.right.append(pair[1] if pair else n)
        return n

    def _apart(self, a: int, b: int, limit: int) -> bool:
        """Whether merges numbered under ``limit`` leave a border between a and b."""
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < limit:
                return False
            # undo the later of the two tokens; a border of two letters is left
            whole_a, whole_b = self.right[a] == a, self.left[b] == b
            if whole_a and whole_b:
                return True
            if not whole_a and (whole_b or a > b):
                a, limit = self.right[a], min(limit, a)
            else:
                b, limit = self.left[b], min(limit, b + 1)

    def compatible(self, a: int, b: int) -> bool:
        key = (a, b)
        known = self.compatible_table.get(key)
        if known is None:
            if len(self.compatible_table) >= CACHE_WORDS:
                self.compatible_table.clear()
            known = self.compatible_table[key] = self._apart(a, b, len(self.ids))
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of a word whose symbols are all of the alphabet."""
        if self.suffix:
            word = word[:-1] + chr(ord(word[-1]) + _LAST)
        n = len(word)
        longest = [-1] * (n + 1)
        length = self.length
        for end, token in self.automaton.iter(word):
            start = end - length[token] + 1
            if longest[start] < 0 or length[longest[start]] < length[token]:
                longest[start] = token
        if longest[0] >= 0 and length[longest[0]] == n:
            return [self.ids[longest[0]]]
        open_ = [True] * (n + 1)  # places that a tokenization may still come through
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            while token >= 0:
                end = at + length[token]
                if open_[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at]
            else:
                open_[at] = False
                if not out:
                    raise ValueError("a symbol isn't in the vocabulary")
                token = out.pop()
                at -= length[token]
        return [self.ids[t] for t in out]


class _Words(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        ids = self.make(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids


class Tokenizer:
    """Encoder and decoder for a BPE vocabulary file of ``tokenizers``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("unk_token", "dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix")):
            raise ValueError("this kind of vocabulary isn't supported")
        library = Library.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens of this kind aren't supported")
        self.at_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        parts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        kinds = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
        self.spaced = (parts[0].get("type") == "Split" and parts[0].get("pattern") == {"Regex": _WORDS} and parts[0].get("invert")
                       and parts[0].get("behavior") == "Removed" and kinds == ["NFC", "Replace", "Lowercase"])
        self.pattern = regex.compile(_WORDS)
        self.symbols = byte_symbols()
        self.words, self.chunks = _Words(self._word), _Words(self._chunk)
        self._decoding(spec, model["vocab"])

    # -- encoding -----------------------------------------------------------
    def _word(self, word: str) -> bytes:
        return np.array(self.merges.encode(word), ID_TYPE).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if self.spaced and _PLAIN(chunk):
            words = self.pattern.findall(chunk.lower())
            if not chunk.isascii():
                words = ["".join(map(self.symbols.__getitem__, w.encode())) for w in words]
        else:
            text = self.normalizer.normalize_str(chunk) if self.normalizer else chunk
            words = [w for w, _ in self.pre_tokenizer.pre_tokenize_str(text)]
        return b"".join(self.words[w] for w in words)

    def _plain(self, text: str) -> Iterator[bytes]:
        if not self.spaced:
            yield self._chunk(text)
            return
        at = 0
        while at < len(text):
            end = text.find(" ", at + SEGMENT_CHARS)
            end = len(text) if end < 0 else end
            yield b"".join(map(self.chunks.__getitem__, text[at:end].replace("\n", " ").split(" ")))
            at = end + 1

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; None is empty."""
        if not text:
            return b""
        out, at = [], 0
        for m in self.at_special.finditer(text) if self.at_special else ():
            out += [*self._plain(text[at:m.start()]), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, *self._plain(text[at:])])

    # -- decoding -----------------------------------------------------------
    def _decoding(self, spec: dict, vocab: dict[str, int]) -> None:
        kind = (spec["decoder"] or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError("this kind of decoder isn't supported")
        self.gap = b" " if kind is None else b""
        back = {s: b for b, s in self.symbols.items()}
        tokens = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in vocab.items():
            tokens[i] = (t.encode() if kind is None else bytes(back[c] for c in t)) + self.gap
        for t, i in self.special.items():
            tokens[i] = t.encode() + self.gap
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])

    def decode(self, ids: bytes) -> str:
        """The text of the ids, each found by its offsets in the token bytes."""
        parts, all_ids = [], np.frombuffer(ids, ID_TYPE)
        for at in range(0, len(all_ids), 1 << 16):
            some = all_ids[at:at + (1 << 16)]
            start = self.offsets[some]
            length = self.offsets[some + 1] - start
            place = np.cumsum(length) - length
            index = np.arange(int(length.sum())) + np.repeat(start - place, length)
            parts.append(self.bytes[index].tobytes())
        out = b"".join(parts)
        return (out[:-1] if self.gap and out else out).decode("utf-8", "replace")


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The worker's tokenizer for a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def encode_decode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  vocabulary_path: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers), decoded of every
    row. Null and empty texts have no ids and decode to an empty text. Null ids
    and repeated rows stay. Further columns aren't read. No shuffle: each task
    works on the rows it reads."""
    prepare(docs.sparkSession)
    path = vocabulary_path or vocabulary("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        rows, held = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = bpe.encode(text.as_py())
                rows.append((doc, ids, bpe.decode(ids)))
                held += len(ids)
                if held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)

    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(run, "doc_id bigint, ids binary, decoded string"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.string()), strict=True)],
                                      names=["doc_id", "ids", "decoded"])


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
