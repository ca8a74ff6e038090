"""Language identification: a bidirectional gated recurrent network over bytes.

One network reads a text's bytes from the left, one from the right; at each
byte both states together give a probability of every language. The network
is trained in numpy by backpropagation through time on the loss of every
position. A document's probabilities are the means over all its bytes.

Texts are read in segments of ``SEGMENT`` bytes, each from empty states, so
that many segments advance together and memory is bounded for texts of any
length; every byte of every text is in one segment.

Only fitting uses a bounded sample: ``per_language`` documents of each
language (those of smallest hash), ``windows`` pieces of ``window`` characters of
each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import prepare
from patronage.llm.quality import held_out

UNKNOWN = "und"
PER_LANGUAGE = 600  # documents of each language that the fit may use
MARGIN = 4          # as many documents are expected below the hash limit as a fit uses, times this
LANGUAGES = 1_000   # that a network may have
WINDOWS = 6         # pieces of each of them
WINDOW = 64         # characters of a piece
HIDDEN = 16         # size of either state
STEPS = 400         # minibatches
BATCH = 128
RATE = 0.01
CLIP = 1.0          # largest norm of a gradient
SEGMENT = 128       # bytes
SEGMENTS = 2048     # that advance together: about 10 MB
BATCH_BYTES = 4 << 20


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Cell:
    """A gated recurrent unit whose input is a byte. With table row x of the
    byte (the input weights and biases) and state h: z, r = sigmoid(x[:2] +
    h.U[:2]), n = tanh(x[2] + r * h.U[2]), next h = n + z * (h - n)."""

    def __init__(self, table: np.ndarray, recurrent: np.ndarray):
        self.table, self.recurrent = table, recurrent
        self.size = recurrent.shape[0]

    def step(self, x: np.ndarray, h: np.ndarray):
        s = self.size
        u = h @ self.recurrent
        gates = _sigmoid(x[:, :2 * s] + u[:, :2 * s])
        z, r = gates[:, :s], gates[:, s:]
        n = np.tanh(x[:, 2 * s:] + r * u[:, 2 * s:])
        return n + z * (h - n), (h, z, r, n, u[:, 2 * s:])

    def run(self, codes: np.ndarray, counts: Sequence[int]):
        """States after each position: codes[t] are the bytes of position t, of
        which the first counts[t] rows have one (counts descend). Yields (t,
        states of these rows, what :meth:`back` needs)."""
        h = np.zeros((codes.shape[1], self.size), self.table.dtype)
        for t, n in enumerate(counts):
            new, kept = self.step(self.table[codes[t, :n]], h[:n])
            yield t, new, kept
            h = new  # rows beyond n have ended

    def back(self, codes: np.ndarray, kept: list, grads: np.ndarray):
        """Gradients of (table, recurrent) for gradients of the states at each
        position, positions in the order of :meth:`run`."""
        s = self.size
        table, recurrent = np.zeros_like(self.table), np.zeros_like(self.recurrent)
        dh = np.zeros_like(grads[0])
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, n, un = kept[t]
            dh = dh + grads[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            dx = np.concatenate([dz, dr, dn], axis=1)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            np.add.at(table, codes[t], dx)
            recurrent += h.T @ du
            dh = dh * z + du @ self.recurrent.T
        return table, recurrent


class Reader:
    """:class:`Cell` for reading alone: keeps nothing for gradients. Each gate
    has a plane of its own, so that all arithmetic runs over contiguous memory,
    in buffers for up to ``rows`` texts that every step uses again. The halves
    inside the gates' sigmoid are in their weights, which is exact."""

    def __init__(self, cell: Cell, rows: int):
        half = np.array([0.5, 0.5, 1], cell.table.dtype)[:, None, None]
        self.tables = np.stack(np.split(cell.table, 3, axis=1)) * half
        self.recurrent = np.stack(np.split(cell.recurrent, 3, axis=1)) * half
        self.x, self.u = (np.empty((3, rows, cell.size), cell.table.dtype) for _ in range(2))

    def step(self, codes: np.ndarray, h: np.ndarray) -> None:
        """Replace each row's state in h by the next, after its byte in codes."""
        x, u = self.x[:, :len(codes)], self.u[:, :len(codes)]
        for table, plane in zip(self.tables, x, strict=True):
            table.take(codes, axis=0, out=plane, mode="clip")  # the other mode copies the buffer
        np.matmul(h, self.recurrent, out=u)
        z, r, n = x
        gates = x[:2]
        gates += u[:2]
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        r *= u[2]
        n += r
        np.tanh(n, out=n)
        h -= n
        h *= z
        h += n


@dataclass
class Network:
    """Languages and weights: a byte table and recurrent weights per direction,
    then the output weights of both states and the bias."""

    languages: list[str]
    weights: list[np.ndarray]  # left table, left recurrent, right table, right recurrent, output, bias

    @staticmethod
    def fresh(languages: Sequence[str], hidden: int = HIDDEN, seed: int = 0, dtype=np.float32) -> "Network":
        rng = np.random.default_rng(seed)

        def some(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(dtype)

        w = []
        for _ in range(2):
            w += [some(256, 3 * hidden, scale=0.3), some(hidden, 3 * hidden, scale=1 / np.sqrt(hidden))]
        w += [some(2 * hidden, len(languages), scale=1 / np.sqrt(2 * hidden)), np.zeros(len(languages), dtype)]
        return Network(list(languages), w)

    def loss(self, codes: np.ndarray, truth: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over all positions of codes (position, row), and its
        gradients by backpropagation through time."""
        left, right = Cell(*self.weights[:2]), Cell(*self.weights[2:4])
        out, bias = self.weights[4:]
        length, rows = codes.shape
        counts = [rows] * length
        a = list(left.run(codes, counts))
        b = list(right.run(codes[::-1], counts))
        states = np.stack([np.concatenate([a[t][1], b[length - 1 - t][1]], axis=1) for t in range(length)])
        p = _softmax(states @ out + bias)
        at = np.arange(rows)
        value = float(-np.log(np.maximum(p[:, at, truth], 1e-30)).mean())
        d = p
        d[:, at, truth] -= 1
        d /= length * rows
        flat = d.reshape(-1, d.shape[2])
        back = d @ out.T
        s = left.size
        grads = [*left.back(codes, [x[2] for x in a], back[:, :, :s]),
                 *right.back(codes[::-1], [x[2] for x in b], back[::-1, :, s:]),
                 states.reshape(len(flat), -1).T @ flat, flat.sum(axis=0)]
        return value, grads

    def segment_sums(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per row of codes (position, row) the sum of its positions'
        probabilities. Lengths descend; positions beyond them aren't read."""
        counts = [int(c) for c in np.searchsorted(-lengths, -np.arange(codes.shape[0]), side="left")]
        out, bias = self.weights[4:]
        left, right = Cell(*self.weights[:2]), Cell(*self.weights[2:4])
        s, rows = left.size, codes.shape[1]
        codes = codes.astype(np.intp)
        reader, h, logits = Reader(left, rows), np.zeros((rows, s), left.table.dtype), []
        for t, n in enumerate(counts):
            reader.step(codes[t, :n], h[:n])
            logits.append(h[:n] @ out[:s] + bias)
        sums = np.zeros((len(self.languages), rows), np.float64)
        reader, h = Reader(right, rows), np.zeros((rows, s), right.table.dtype)
        for t in range(len(counts) - 1, -1, -1):  # rows join at their last byte, with an empty state
            n = counts[t]
            reader.step(codes[t, :n], h[:n])
            p = np.ascontiguousarray((logits[t] + h[:n] @ out[s:]).T)  # by language: long sums over rows
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            sums[:, :n] += p
        return sums.T

    def document_probabilities(self, raws: Sequence[bytes]) -> np.ndarray:
        """Mean probabilities over all bytes of each text (empty: zeros)."""
        sizes = np.array([len(r) for r in raws], np.int64)
        data = np.frombuffer(b"".join(raws) + bytes(SEGMENT), np.uint8)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        per = -(-sizes // SEGMENT)
        doc = np.repeat(np.arange(len(raws)), per)
        inside = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        begin = starts[doc] + inside * SEGMENT
        length = np.minimum(SEGMENT, sizes[doc] - inside * SEGMENT)
        order = np.argsort(-length, kind="stable")
        sums = np.zeros((len(raws), len(self.languages)))
        for at in range(0, len(order), SEGMENTS):
            rows = order[at:at + SEGMENTS]
            n = int(length[rows[0]])
            codes = data[begin[rows][None, :] + np.arange(n)[:, None]]
            np.add.at(sums, doc[rows], self.segment_sums(codes, length[rows]))
        return sums / np.maximum(1, sizes)[:, None]


def fit(pieces: Sequence[bytes], truth: np.ndarray, languages: Sequence[str], *, hidden: int = HIDDEN, steps: int = STEPS,
        batch: int = BATCH, rate: float = RATE, seed: int = 0) -> Network:
    """Train on pieces of text. Minibatches take every language alike; a
    minibatch is cut to one length, so that short texts are met too."""
    net = Network.fresh(languages, hidden, seed)
    rng = np.random.default_rng(seed)
    groups = [np.flatnonzero(truth == k) for k in range(len(languages))]
    size = np.array([len(p) for p in pieces])
    width = int(size.max()) if len(pieces) else 0
    grid = np.zeros((len(pieces), width), np.uint8)
    for i, p in enumerate(pieces):  # shorter pieces go round
        grid[i] = np.resize(np.frombuffer(p, np.uint8), width)
    first, second = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    for step in range(1, steps + 1):
        k = np.arange(batch) % len(languages)
        rows = np.array([rng.choice(groups[i]) for i in k])
        length = int(rng.integers(max(1, width // 4), width + 1))
        _, grads = net.loss(np.ascontiguousarray(grid[rows, :length].T), k)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        down = min(1.0, CLIP / (norm + 1e-12))
        now = rate * (1 - 0.9 * step / steps)
        for w, g, m, v in zip(net.weights, grads, first, second, strict=True):  # Adam
            g = g * down
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= (now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(w.dtype)
    return net


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE, windows: int = WINDOWS, window: int = WINDOW, **options) -> Network | None:
    """Fit to text and language of documents that aren't held out (see
    :func:`patronage.llm.quality.held_out`) and have a language and a letter.
    At most ``per_language`` rows of each language come to the driver, as
    ``windows`` pieces of ``window`` characters each; they are the rows of smallest
    hash, found among those below a limit that the language's number of rows
    sets, so that however many rows a language has, few of them meet in one task.
    None if there is no such row; more than ``LANGUAGES`` languages raise."""
    prepare(docs.sparkSession)
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    known = docs.select(F.col(id_col).alias("id"), text.alias("text"), lang.alias("lang")).where(~held_out(F.col("id")) & F.col("lang").isNotNull())
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counts:
        return None
    limit = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, MARGIN * per_language / r["n"]))]), F.col("lang"))
    by_id, text = F.xxhash64(F.col("id").cast("string")), F.col("text")
    below = F.pmod(by_id, F.lit(1 << 40)) <= limit * float(1 << 40)
    hashed = F.xxhash64(by_id, text)
    room = F.greatest(F.length(text) - window + 1, F.lit(1))
    # the first piece is the text's beginning, the others lie anywhere
    cuts = F.array(*[F.substring(text, F.lit(1) if i == 0 else (F.pmod(F.xxhash64(F.lit(i), hashed), room) + 1).cast("int"), F.lit(window))
                     for i in range(windows)])
    rows = (known.where(below).where(text.rlike(r"\p{L}"))
            .select("lang", hashed.alias("hash"), cuts.alias("cuts")))
    # a limit on row numbers is applied in every task before rows of one language meet
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "cuts"))
    got = rows.withColumn("nth", nth).where(F.col("nth") <= per_language).select("lang", "hash", "cuts").toArrow().to_pylist()
    if not got:
        return None
    got.sort(key=lambda r: (r["lang"], r["hash"], r["cuts"]))
    languages = sorted({r["lang"] for r in got})
    pairs = [(p.encode(), languages.index(r["lang"])) for r in got for p in r["cuts"] if p]
    return fit([p for p, _ in pairs], np.array([k for _, k in pairs]), languages, **options)


def predict(docs: DataFrame, net: Network | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, probabilities (by language, in the order of
    ``net.languages``) of every row, by its text alone.

    Null texts and texts without a letter get ``und``, score 0 and
    probabilities null, as do all rows if ``net`` is None. Ties go to the language that is
    first in the alphabet. Null ids and repeated rows stay; further columns
    aren't read; an empty table gives no rows."""
    prepare(docs.sparkSession)

    def label(ids: list, texts: list) -> pa.RecordBatch:
        known = [i for i, t in enumerate(texts) if net is not None and t and has_letter(t)]
        lang, score, probabilities = [UNKNOWN] * len(ids), [0.0] * len(ids), [None] * len(ids)
        if known:
            p = net.document_probabilities([texts[i].encode() for i in known])
            for i, row in zip(known, p, strict=True):
                best = int(np.argmax(row))
                lang[i], score[i], probabilities[i] = net.languages[best], min(1.0, float(row[best])), row.tolist()
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lang), pa.array(score), pa.array(probabilities, pa.list_(pa.float64()))],
                                          names=["doc_id", "lang_pred", "score", "probabilities"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc)
                texts.append(text.as_py())
                held += len(texts[-1] or "")
                if held >= BATCH_BYTES or len(ids) >= 8192:
                    yield label(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield label(ids, texts)

    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(run, "doc_id bigint, lang_pred string, score double, probabilities array<double>"))


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
