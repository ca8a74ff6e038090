"""Alignment of two tokenizers against a plain version."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from patronage.llm import alignment
from patronage.llm.byte_bpe import byte_symbols, vocabulary


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))


def plain(libraries, texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    a_lib, b_lib = libraries
    back = {s: b for b, s in byte_symbols().items()}
    docs = []
    for text in texts:
        if not text:
            docs.append(([], [], []))
            continue
        a = a_lib.encode(" " + text, add_special_tokens=False).ids
        b = b_lib.encode(text)
        ta = [bytes(back[c] for c in a_lib.id_to_token(i)) for i in a]
        tb = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        raw = (" " + text).encode()
        if b"".join(ta) != raw or b"".join(tb) != raw:
            docs.append(([], [], []))
            continue
        def spans(tokens):
            at, out = 0, []
            for t in tokens:
                out.append((at, at + len(t)))
                at += len(t)
            return out
        sa, sb = spans(ta), spans(tb)
        links = [(a[i], b[j]) for i, x in enumerate(sa) for j, y in enumerate(sb) if max(x[0], y[0]) < min(x[1], y[1])]
        ends = sorted({y for _, y in sa} & {y for _, y in sb})
        groups, low = [], 0
        for end in ends:
            groups.append(",".join(str(i) for i, s in zip(a, sa, strict=True) if low <= s[0] < end) + "|"
                          + ",".join(str(i) for i, s in zip(b, sb, strict=True) if low <= s[0] < end))
            low = end
        docs.append((a, b, links, ";".join(groups), len(ends)))
    count = Counter(p for d in docs for p in set(d[2]))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for d in docs:
        if not d[0]:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups, n = d
        out.append((len(a), len(b), n, len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(groups.encode()).hexdigest()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
POOL = list("abcdeinthgro'sTREvdéßİΣσς中文 \n\t　!?.,123½ǅ▁\0") + ["é", "<|endoftext|>", "<s>", "<0x0A>", "<unk>", "👍🏽", "the ", "ing", "ﬁ", "  ", "tion"]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 100])
def test_merge_path_pieces_stitch(piece):
    rng = np.random.default_rng(piece)
    for _ in range(30):
        last = int(rng.integers(1, 60))
        a = np.unique(np.append(rng.integers(1, last + 1, rng.integers(0, 40)), last))
        b = np.unique(np.append(rng.integers(1, last + 1, rng.integers(0, 40)), last))
        links, common = [], []
        for (i, j), (ca, cb) in alignment.merge_path(a, b, piece):
            links += zip(i.tolist(), j.tolist(), strict=True)
            common += zip(ca.tolist(), cb.tolist(), strict=True)
        start = lambda ends, k: ends[k - 1] if k else 0
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(start(a, i), start(b, j)) < min(a[i], b[j])]
        assert sorted(links) == want
        assert common == [(int(np.searchsorted(a, e)), int(np.searchsorted(b, e))) for e in np.intersect1d(a, b)]


def test_diagonals_split_the_work_evenly():
    a, b = np.arange(1, 1000, 3), np.arange(1, 1000, 7)
    for d in range(0, len(a) + len(b), 50):
        i, j = alignment.diagonal(a, b, d)
        assert i + j == d
        assert i == len(a) or j == 0 or b[j - 1] < a[i]
        assert j == len(b) or i == 0 or a[i - 1] <= b[j]


@pytest.mark.parametrize(("piece", "block"), [(alignment.PIECE, alignment.BLOCK_BYTES), (5, 60)])
def test_equals_the_plain_version(spark, libraries, piece, block):
    rng = random.Random(piece)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 40))) for _ in range(80)]
    texts += [None, "", " ", "the thing and the other thing", "the thing and the other thing", "naïve façade, straße", "x" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align(df, piece=piece, block_bytes=block, detail=False).collect()}
    for i, want in enumerate(plain(libraries, texts)):
        assert got[i] == want, texts[i]


def test_edges_and_details(edge_docs, edge_rows, no_docs, libraries):
    rows = alignment.align(edge_docs).collect()
    want = Counter((r[0], *w) for r, w in zip(edge_rows, plain(libraries, [r[1] if len(r[1] or "") < 5000 else None for r in edge_rows]), strict=True) if len(r[1] or "") < 5000)
    short = [r for r in rows if r["doc_id"] != 7]
    # counts are of the whole corpus, which the long text belongs to
    drop = [c for c in COLUMNS if c not in ("n_best", "count_sum")]
    at = [1 + COLUMNS.index(c) for c in drop]
    assert Counter((r["doc_id"], *(r[c] for c in drop)) for r in short) == Counter({(k[0], *(k[i] for i in at)): n for k, n in want.items()})
    long = next(r for r in rows if r["doc_id"] == 7)
    assert long["n_a"] == len(long["a_ids"]) > 5000 and long["n_links"] == long["n_a"] + long["n_b"] - long["n_groups"]
    assert long["a_groups"][-1] == long["n_a"] and long["b_groups"][-1] == long["n_b"]
    assert alignment.align(no_docs).count() == 0
