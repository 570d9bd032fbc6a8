"""Language of documents by a bidirectional gated recurrent network over bytes.

The network reads a segment of bytes in both directions and labels every position; a
document's probabilities are the mean over all of its positions.  Segments are runs
without white space, longer ones cut after ``LONGEST`` bytes; the state starts anew with
each, so the probabilities of a segment are a fixed function of its bytes and computed
once per task, while every position of every text counts.

It is trained in numpy by backpropagation through time on segments drawn from a bounded
sample of rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import fold_of, read, ship, text_bytes

LONGEST = 32
HIDDEN = 16
#: The sample for the fit: rows of each language on average, and segments of a row at most,
#: drawn from anywhere in its text.
ROWS, PER_ROW = 500, 40
HELD_OUT = (4, 2)
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


def segments_of(text: bytes) -> list[bytes]:
    runs = text.split()
    if runs and max(map(len, runs)) > LONGEST:
        return [r[i : i + LONGEST] for r in runs for i in range(0, len(r), LONGEST)]
    return runs


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Direction:
    """One gated recurrent layer; ``back`` reads from the end."""

    def __init__(self, inputs: np.ndarray, inner: np.ndarray, back: bool):
        self.inputs, self.inner, self.back = inputs, inner, back

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        steps, batch = x.shape
        k = self.inner.shape[0]
        h = np.zeros((batch, k), dtype=np.float32)
        out = np.empty((steps, batch, k), dtype=np.float32)
        for t in range(steps - 1, -1, -1) if self.back else range(steps):
            g, u = self.inputs[x[t]], h @ self.inner
            both = _sigmoid(g[:, : 2 * k] + u[:, : 2 * k])
            z, r = both[:, :k], both[:, k:]
            n = np.tanh(g[:, 2 * k :] + r * u[:, 2 * k :])
            new = h + mask[t][:, None] * (1 - z) * (n - h)
            if keep is not None:
                keep.append((t, h, z, r, n, u[:, 2 * k :]))
            out[t] = h = new
        return out

    def backward(self, x: np.ndarray, mask: np.ndarray, kept: list, to_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = self.inner.shape[0]
        to_inner = np.zeros_like(self.inner)
        to_gates = np.zeros((*x.shape, 3 * k), dtype=np.float32)
        dh = np.zeros((x.shape[1], k), dtype=np.float32)
        for t, h, z, r, n, un in reversed(kept):
            dh = dh + to_out[t]
            moved = dh * mask[t][:, None]
            dn = moved * (1 - z) * (1 - n * n)
            dz = moved * (h - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            to_gates[t] = np.concatenate([dz, dr, dn], axis=1)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            to_inner += h.T @ du
            dh = dh - moved * (1 - z) + du @ self.inner.T
        hot = np.zeros((256, x.size), dtype=np.float32)
        hot[x.ravel(), np.arange(x.size)] = 1
        return hot @ to_gates.reshape(x.size, -1), to_inner


class Network:
    def __init__(self, params: list[np.ndarray]):
        self.params = params  # inputs and inner of each direction, then output and its bias

    @classmethod
    def new(cls, labels: int, hidden: int = HIDDEN, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0] if shape[0] != 256 else 10)).astype(np.float32)
        return cls([make(256, 3 * hidden), make(hidden, 3 * hidden), make(256, 3 * hidden), make(hidden, 3 * hidden), make(2 * hidden, labels), np.zeros(labels, np.float32)])

    def _sides(self) -> tuple[Direction, Direction]:
        return Direction(self.params[0], self.params[1], False), Direction(self.params[2], self.params[3], True)

    def positions(self, x: np.ndarray, mask: np.ndarray, kept: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each position, and the states they come from."""
        h = np.concatenate([d.forward(x, mask, kept and kept[i]) for i, d in enumerate(self._sides())], axis=2)
        s = h @ self.params[4] + self.params[5]
        s -= s.max(axis=2, keepdims=True)
        p = np.exp(s)
        return p / p.sum(axis=2, keepdims=True), h

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[list[np.ndarray], float]:
        kept: tuple[list, list] = ([], [])
        p, h = self.positions(x, mask, kept)
        n = max(1.0, float(mask.sum()))
        own = p[:, np.arange(x.shape[1]), label]
        loss = float(-(np.log(own + 1e-9) * mask).sum() / n)
        off = p.copy()
        off[:, np.arange(x.shape[1]), label] -= 1
        off *= mask[:, :, None] / n
        flat = off.reshape(-1, off.shape[2])
        to_h = off @ self.params[4].T
        k = self.params[1].shape[0]
        found = []
        for i, d in enumerate(self._sides()):
            found += d.backward(x, mask, kept[i], to_h[:, :, i * k : (i + 1) * k])
        return [*found, h.reshape(-1, h.shape[2]).T @ flat, flat.sum(axis=0)], loss

    def sums(self, segments: list[bytes]) -> np.ndarray:
        """Per segment the sum of its positions' probabilities."""
        out = np.zeros((len(segments), len(self.params[5])), dtype=np.float32)
        order = sorted(range(len(segments)), key=lambda i: len(segments[i]))
        for i in range(0, len(order), 4096):
            own = order[i : i + 4096]
            x, mask = padded([segments[j] for j in own])
            out[own] = (self.positions(x, mask)[0] * mask[:, :, None]).sum(axis=0)
        return out


def padded(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and mask as (positions, segments)."""
    size = np.array([len(s) for s in segments])
    width = int(size.max(initial=1))
    x = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in segments), dtype=np.uint8).reshape(len(segments), width)
    return np.ascontiguousarray(x.T), np.ascontiguousarray((np.arange(width)[:, None] < size).astype(np.float32))


def train(segments: list[bytes], labels: np.ndarray, n_labels: int, rounds: int = 4, batch: int = 256, rate: float = 0.01, seed: int = 5) -> Network:
    """Adam over batches of segments of like length."""
    net = Network.new(n_labels)
    rng = np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.params]
    by_size = np.array(sorted(range(len(segments)), key=lambda i: (len(segments[i]), zlib.crc32(segments[i]))), dtype=np.int64)
    groups = [by_size[i : i + batch] for i in range(0, len(by_size), batch)]
    step = 0
    for r in range(rounds):
        for g in rng.permutation(len(groups)):
            step += 1
            x, mask = padded([segments[i] for i in groups[g]])
            found, _ = net.gradients(x, mask, labels[groups[g]])
            now = rate * (1 - r / (rounds + 1))
            for p, d, (m, v) in zip(net.params, found, moments, strict=True):
                m += 0.1 * (d - m)
                v += 0.01 * (d * d - v)
                p -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def sample(docs: DataFrame, languages: dict[str, int]) -> DataFrame:
    """``lang`` and up to PER_ROW ``segments`` of rows that are not held out.

    Rows come by a hash of the id below a bound that leaves about ROWS of each language;
    segments by a hash of their place, from anywhere in the text.
    """
    modulus, held = HELD_OUT

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = []
            for text in text_bytes(batch.column(1)):
                own = segments_of(text)
                at = range(len(own)) if len(own) <= PER_ROW else sorted(np.random.default_rng(len(own)).choice(len(own), PER_ROW, replace=False).tolist())
                drawn.append([own[i] for i in at])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(drawn, pa.list_(pa.binary()))], names=["lang", "segments"])

    ship(docs.sparkSession)
    share = F.create_map(*(F.lit(x) for lang, n in languages.items() for x in (lang, min(1.0, ROWS / n))))
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    drawn = docs.where((fold_of(F.col("doc_id"), modulus) != held) & F.col("lang").isin(*languages) & (draw < share[F.col("lang")]))
    return drawn.select("lang", "text").mapInArrow(run, "lang string, segments array<binary>")


def fit(docs: DataFrame) -> tuple[list[str], Network | None]:
    """Learned languages, all that rows name, and the network; none if no row has one."""
    modulus, held = HELD_OUT
    open_to = docs.where((fold_of(F.col("doc_id"), modulus) != held) & F.col("lang").isNotNull())
    counted = open_to.groupBy("lang").agg(F.count("*").alias("n")).collect()
    languages = {r["lang"]: r["n"] for r in counted}
    if not languages:
        return [], None
    names = sorted(languages)
    rows = sample(docs, languages).limit(2 * ROWS * len(names)).collect()
    found = sorted((bytes(s), names.index(r["lang"])) for r in rows for s in r["segments"])
    if not found:
        return names, None
    return names, train([s for s, _ in found], np.array([k for _, k in found]), len(names))


def identify(docs: DataFrame, names: list[str], net: Network | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of each row, over whole texts.

    A null text or one without a letter is ``und`` with score 0, as is all without a
    trained network.
    """
    held = docs.sparkSession.sparkContext.broadcast((names, net and net.params))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, params = held.value
        own = Network(params) if params else None
        number: dict[bytes, int] = {}
        table = np.zeros((0, len(labels)), dtype=np.float32)
        for batch in batches:
            if len(number) > 300_000:
                number, table = {}, table[:0]
            texts = text_bytes(batch.column(1))
            found, fresh, places, sizes = [], [], [], []
            for text in texts:
                place = []
                if own is not None and LETTER.search(text.decode("utf-8")):
                    for s in segments_of(text):
                        k = number.get(s)
                        if k is None:
                            k = number[s] = len(number)
                            fresh.append(s)
                        place.append(k)
                places.append(np.array(place, dtype=np.int64))
                sizes.append(len(text) - sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))))
            if fresh:
                table = np.concatenate([table, own.sums(fresh)])
            for place, size in zip(places, sizes, strict=True):
                if len(place):
                    pooled = table[place].sum(axis=0, dtype=np.float64) / size
                    best = int(pooled.argmax())
                    found.append((labels[best], float(min(1.0, max(0.0, pooled[best])))))
                else:
                    found.append((UNDETERMINED, 0.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def language(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of each row, repeated ones alike.

    A null text or one without a letter is ``und`` with score 0, as is all if no row that
    isn't held out names a language; rows without a language aren't learned from.  A tie
    goes to the first language by name.  No rows: no rows.
    """
    modulus, held = HELD_OUT
    names, net = fit(docs.select("doc_id", "text", "lang"))
    return identify(docs, names, net).select("doc_id", (fold_of(F.col("doc_id"), modulus) == held).alias("held_out"), "lang_pred", "score")


def op8_language(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents``, learned from the rows outside the held-out fold.

    Null texts and texts without letters are ``und``; each row has its row, repeated ones the same values.
    """
    return language(read(spark, sf_dir, "documents"))
