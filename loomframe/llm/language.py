"""Language identification with a convolutional network over bytes, trained in numpy.

A text is cut into windows of ``WINDOW`` bytes. Bytes are embedded, filters of several
widths slide over each window, the largest answer of each filter over all places goes into
a softmax over the languages seen in training. A document's probabilities are the mean of
its windows', weighted by their bytes, so whole texts of any length count in full.

Training uses at most ``per_lang`` labelled documents per language in expectation (chosen
by a hash of their id) and never more than twice that over all, with ``per_doc`` windows
of each, evenly spread. Null text and text without a letter is ``und`` with score 0; so is
everything when nothing is labelled. Repeated rows are predicted alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm import arrow_text as at
from loomframe.llm.shared import only

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
PER_LANG, PER_DOC = 400, 4
UNKNOWN = "und"


def windows_of(data: np.ndarray, offsets: np.ndarray):
    """Bytes of all windows (zero behind a row's end), their lengths, first window of each row."""
    count = -(-np.diff(offsets) // WINDOW)
    first = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(count)), count)
    start = offsets[row] + (np.arange(first[-1]) - first[row]) * WINDOW
    length = np.minimum(offsets[row + 1] - start, WINDOW)
    place = np.arange(WINDOW)
    where = start[:, None] + place
    inside = place < length[:, None]
    cut = np.where(inside, data[np.minimum(where, max(len(data) - 1, 0))], 0) if len(data) else \
        np.zeros((0, WINDOW), np.uint8)
    return cut.astype(np.uint8), length, first


class ByteNet:
    """Embedding, filters of every width in one matrix, and the softmax layer."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.reach = max(WIDTHS)
        units = FILTERS * len(WIDTHS)
        #: A filter of width w has zeros behind its first w bytes.
        self.mask = np.zeros((self.reach * EMBED, units), np.float32)
        for k, width in enumerate(WIDTHS):
            self.mask[:width * EMBED, k * FILTERS:(k + 1) * FILTERS] = 1
        self.weights = {
            "embed": rng.normal(0, 0.5, (256, EMBED)), "filter": rng.normal(0, 0.3, self.mask.shape) * self.mask,
            "bias": np.zeros(units), "out": rng.normal(0, 0.1, (units, len(classes))), "out_bias": np.zeros(len(classes))}
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def pooled(self, cut: np.ndarray, where: bool = False):
        """Largest answer of each filter in each window, and on demand its place."""
        w, n = self.weights, len(cut)
        padded = np.zeros((n, WINDOW + self.reach - 1), np.uint8)
        padded[:, :WINDOW] = cut
        embedded = w["embed"][padded].reshape(n, -1)
        best = np.full((n, self.mask.shape[1]), -np.inf, np.float32)
        answer = np.empty_like(best)
        place = np.zeros(best.shape, np.int16) if where else None
        for p in range(WINDOW):
            np.dot(embedded[:, p * EMBED:(p + self.reach) * EMBED], w["filter"], out=answer)
            if where:
                place[answer > best] = p
            np.maximum(best, answer, out=best)
        return np.maximum(best + w["bias"], 0), place, padded

    def probabilities(self, cut: np.ndarray) -> np.ndarray:
        out = np.empty((len(cut), len(self.classes)), np.float32)
        for k in range(0, len(cut), 512):
            hidden, _, _ = self.pooled(cut[k:k + 512])
            out[k:k + 512] = softmax(hidden @ self.weights["out"] + self.weights["out_bias"])
        return out

    def gradients(self, cut: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.weights, len(cut)
        hidden, place, padded = self.pooled(cut, where=True)
        error = softmax(hidden @ w["out"] + w["out_bias"])
        error[np.arange(n), label] -= 1
        error /= n
        back = (error @ w["out"].T) * (hidden > 0)
        # Only the winning place of each filter sends a gradient down.
        read = padded[np.arange(n)[:, None, None], place[:, :, None] + np.arange(self.reach)]
        seen = w["embed"][read].reshape(n, len(w["bias"]), -1)
        down = (back[:, :, None] * w["filter"].T).reshape(-1, EMBED)
        hit = read.reshape(-1)
        embed = np.stack([np.bincount(hit, down[:, k], 256) for k in range(EMBED)], axis=1)
        return {"embed": embed, "filter": np.einsum("nu,nuk->ku", back, seen) * self.mask,
                "bias": back.sum(0), "out": hidden.T @ error, "out_bias": error.sum(0)}

    def train(self, cut: np.ndarray, label: np.ndarray, epochs: int = 8, batch: int = 128,
              rate: float = 0.01, seed: int = 7) -> "ByteNet":
        rng, step = np.random.default_rng(seed), 0
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for _ in range(epochs):
            order = rng.permutation(len(cut))
            for k in range(0, len(cut), batch):
                step += 1
                for name, g in self.gradients(cut[order[k:k + batch]], label[order[k:k + batch]]).items():
                    mean[name] = 0.9 * mean[name] + 0.1 * g
                    square[name] = 0.999 * square[name] + 0.001 * g * g
                    self.weights[name] -= (rate * (mean[name] / (1 - 0.9 ** step))
                                           / (np.sqrt(square[name] / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)
        return self


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def training_windows(labelled: DataFrame, per_lang: int = PER_LANG, per_doc: int = PER_DOC):
    """Windows and labels of the bounded sample of ``labelled`` (doc_id, lang, text)."""
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, int)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items()
                           for x in (lang, min(1.0, per_lang / n))])[F.col("lang")]
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)

    def cut(batches):
        for batch in batches:
            data, offsets = at.utf8(batch.column(1))
            windows, _, first = windows_of(data, offsets)
            take = [np.unique(np.linspace(a, b - 1, min(per_doc, b - a)).astype(int))
                    for a, b in zip(first[:-1], first[1:])]
            index = np.repeat(np.arange(len(take)), [len(t) for t in take])
            chosen = windows[np.concatenate(take)] if take else windows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index, pa.int64())),
                 pa.array([w.tobytes() for w in chosen], pa.binary())], names=["lang", "window"])

    chosen = labelled.filter(draw < share).limit(2 * per_lang * len(counts))
    rows = sorted((r[0], bytes(r[1])) for r in chosen.select("lang", "text").mapInArrow(
        cut, "lang string, window binary").collect())
    classes = sorted({lang for lang, _ in rows})
    windows = np.array([np.frombuffer(w, np.uint8) for _, w in rows]).reshape(-1, WINDOW)
    return classes, windows, np.array([classes.index(lang) for lang, _ in rows], int)


def fit(labelled: DataFrame, **bounds) -> ByteNet | None:
    classes, windows, label = training_windows(labelled, **bounds)
    return ByteNet(classes).train(windows, label) if len(windows) else None


def predict(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """doc_id, lang_pred, score for (doc_id, text); other columns of ``docs`` are not read."""
    def run(batches):
        for batch in batches:
            data, offsets = at.utf8(batch.column(2))
            letters = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            name, score = np.full(len(letters), UNKNOWN, object), np.zeros(len(letters))
            for i, j in at.pieces(offsets):
                if net is None or offsets[i] == offsets[j]:
                    continue
                cut, length, first = windows_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                share = net.probabilities(cut) * length[:, None]
                total = np.concatenate([np.zeros((1, share.shape[1])), np.cumsum(share, axis=0, dtype=np.float64)])
                mean = (total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(offsets[i:j + 1]), 1)[:, None]
                top = mean.argmax(axis=1)
                known = letters[i:j] & (np.diff(first) > 0)
                name[i:j] = np.where(known, np.array(net.classes, object)[top], UNKNOWN)
                score[i:j] = np.where(known, np.clip(mean[np.arange(j - i), top], 0, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(name, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return only(docs, doc_id="doc_id", text="text").select("doc_id", letter.alias("letter"), "text") \
        .mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Documents that are kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, **bounds) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from labelled documents not held out."""
    labelled = only(docs, doc_id="doc_id", lang="lang", text="text").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
        & ~held_out(F.col("doc_id")))
    return predict(docs, fit(labelled, **bounds)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
