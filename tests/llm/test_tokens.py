"""BPE, packing and token files against the tokenizers library."""

import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from patronage.llm import bpe, byte_bpe, packing, token_files
from patronage.llm.byte_bpe import vocabulary
from patronage.llm.common import scratch_path

POOL = list("abcdeinthgro'sTREvdéßİΣσς中文 \n\t\x1c\x85\xa0　!?.,123½ǅ") + ["é", "<|endoftext|>", "<|startoftext|>", "👍🏽", "the ", "ing", "ﬁ", "  "]


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def library_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(3))
def test_encoders_equal_the_library(library, seed):
    rng = random.Random(seed)
    mine = byte_bpe.ByteBpe(vocabulary("byte_bpe_50k.json")), bpe.Tokenizer(vocabulary("word_bpe_49k.json"))
    for _ in range(400):
        text = "".join(rng.choice(POOL) for _ in range(rng.randint(0, 50)))
        for own, lib in zip(mine, library, strict=True):
            ids = library_ids(lib, text)
            assert own.encode(text) == raw(ids), text
        assert mine[1].decode(raw(ids)) == library[1].decode(ids, skip_special_tokens=False)


def test_backtracking_on_bytes_round_trips(library):
    own = bpe.Tokenizer(vocabulary("byte_bpe_50k.json"))
    rng = random.Random(9)
    for _ in range(200):
        text = "".join(rng.choice("abcdeinthgro éß.") for _ in range(rng.randint(0, 80)))
        ids = own.encode(text)
        assert ids == raw(library_ids(library[0], text)) and own.decode(ids) == text


def test_long_words_and_small_caches(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 7)
    monkeypatch.setattr(byte_bpe, "CACHE_CHUNKS", 7)
    monkeypatch.setattr(byte_bpe, "SEGMENT_CHARS", 40)
    monkeypatch.setattr(bpe, "SEGMENT_CHARS", 40)
    own = bpe.Tokenizer(vocabulary("word_bpe_49k.json"))
    text = "abracadabra" * 4000 + " " + " ".join(f"w{i} thing" for i in range(300))
    assert own.encode(text) == raw(library_ids(library[1], text))
    assert byte_bpe.ByteBpe(vocabulary("byte_bpe_50k.json")).encode(text) == raw(library_ids(library[0], text))


def test_encode_decode_rows(edge_docs, edge_rows, library):
    got = Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in bpe.encode_decode(edge_docs).collect())
    ids = [(r[0], library_ids(library[1], r[1])) for r in edge_rows]
    assert got == Counter((i, raw(x), library[1].decode(x, skip_special_tokens=False)) for i, x in ids)


def test_cut_takes_every_token_once():
    for tokens in [1, 2, 1023, 1024, 1025, 5000]:
        pieces = packing.cut(tokens, 1024)
        assert [p[0] for p in pieces] == np.cumsum([0] + [p[1] for p in pieces])[:-1].tolist() and sum(p[1] for p in pieces) == tokens
    with pytest.raises(ValueError):
        packing.pack(None, capacity=1000)


def test_packing(edge_docs, edge_rows, library):
    rows = packing.pack(edge_docs, capacity=64).collect()
    docs = defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
    want = Counter((i, raw([*library_ids(library[0], t), 0])) for i, t, *_ in edge_rows)
    got = Counter()
    for i, pieces in docs.items():
        copies = sum(p["start"] == 0 for p in pieces)
        same = [p for p in pieces]
        same.sort(key=lambda p: p["start"])
        got[i, b"".join(bytes(p["ids"]) for p in same[::copies])] += copies
    assert got == want
    used = defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in used.values():
        pieces.sort()
        assert [p[0] for p in pieces] == np.cumsum([0] + [p[1] for p in pieces])[:-1].tolist()
        total = sum(p[1] for p in pieces)
        assert total <= 64 and total & (total - 1) == 0


def test_harmonic_bins_hold_a_fixed_number_of_pieces():
    bins, rng, closed = packing.HarmonicBins(100), random.Random(1), []
    sizes = [rng.randint(1, 100) for _ in range(500)]
    for i, s in enumerate(sizes):
        if full := bins.add((i, s), s):
            assert len(full) == 100 // s and sum(x[1] for x in full) <= 100
            closed += full
    closed += [x for run in bins.rest() for x in run]
    assert sorted(closed) == list(enumerate(sizes))


def test_empty_tables(no_docs, spark):
    assert packing.pack(no_docs).count() == 0 and bpe.encode_decode(no_docs).count() == 0
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write(no_docs, folder)
    assert token_files.placed(token_files.read(spark, folder), manifest).count() == 0


def test_token_files_round_trip(edge_docs, edge_rows, library, spark):
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write(edge_docs, folder, file_bytes=300, frame_bytes=128)
    assert manifest.count() >= 2
    rows = token_files.placed(token_files.read(spark, folder), manifest).orderBy("start").collect()
    order = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = [(r[0], raw([*library_ids(library[0], r[1]), 2])) for r in order]
    assert [(r["doc_id"], bytes(r["ids"])) for r in rows] == want
    assert [r["start"] for r in rows] == np.cumsum([0] + [len(w[1]) // 4 for w in want])[:-1].tolist()
    digests = token_files.placed(token_files.digest(token_files.read(spark, folder)), manifest).orderBy("start").collect()
    assert [(r["n_tokens"], r["ids_crc32"]) for r in digests] == [(len(w[1]) // 4, zlib.crc32(w[1])) for w in want]


def test_unlisted_files_do_not_count(edge_docs, edge_rows, spark):
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write(edge_docs, folder)
    token_files.write(edge_docs, folder)  # as a lost attempt would leave
    assert token_files.placed(token_files.read(spark, folder), manifest).count() == len(edge_rows)


def test_readers_take_only_the_frames_asked_for():
    writer = token_files.TokenFileWriter(2, 100)
    docs = [np.arange(n, dtype="<u4") for n in (0, 10, 500, 3, 49, 1)]
    for i, d in enumerate(docs):
        writer.add(None if i == 3 else i, d)
    content = bytes(writer.finish())
    reader = token_files.TokenFileReader(io.BytesIO(content))
    assert (reader.ids(5) == docs[5]).all() and reader.frames_read == 1
    assert all((reader.ids(i) == d).all() for i, d in enumerate(docs)) and reader.doc_id(3) is None and reader.doc_id(4) == 4
    import zstandard
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read()
    assert whole == np.concatenate(docs).astype("<u2").tobytes()
    broken = bytearray(content)
    broken[reader.place[2] - 6] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(map(token_files.TokenFileReader(io.BytesIO(bytes(broken))).ids, range(6)))


def test_long_plain_texts_are_cut_between_words(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SEGMENT_CHARS", 30)
    own = byte_bpe.ByteBpe(vocabulary("byte_bpe_50k.json"))
    rng = random.Random(3)
    for _ in range(50):
        text = "".join(rng.choice(["the", "Wörter", "  ", " ", " ", "\n", "12", ".", "'s"]) for _ in range(200))
        assert "".join(own._parts(text)) == text and own.encode(text) == raw(library_ids(library[0], text))


def test_the_width_follows_the_ids(edge_docs, edge_rows, spark):
    writer = token_files.TokenFileWriter(2)
    with pytest.raises(ValueError):
        writer.add(1, np.array([70_000], "<u4"))
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write(edge_docs, folder, end_id=70_000)
    rows = token_files.placed(token_files.read(spark, folder), manifest).collect()
    assert len(rows) == len(edge_rows) and all(np.frombuffer(r["ids"], "<u4")[-1] == 70_000 for r in rows)
