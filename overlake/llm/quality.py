"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a row x is ``w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``.  The pairwise
part is computed in linear time as ``1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]``.

Learning uses at most ``SAMPLE`` labelled documents; scoring reads every text in full.

Null and empty texts have no words: their structure statistics are zero and they are scored
like any other row.  With no labelled row, or only one label, every score is the smoothed
share of the good label (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overlake.llm.tables import labelled_sample, recorded_size
from overlake.llm.words import Words, chunks

#: Labelled documents that learning sees, at most.
SAMPLE = 12_000
BUCKETS = 1 << 16
RANK = 8
EPOCHS = 8
#: Score from which a document counts as good.
THRESHOLD = 0.7

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE)
_STOPS = np.zeros(256, bool)
_STOPS[[33, 44, 46, 63]] = True
STATISTICS = 17


def _lines(text: bytes) -> tuple[int, int, int]:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(set(lines)), max(map(len, lines), default=0)


def features(texts: list[str | None], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Dense statistics of each text, and its hashed words as (buckets, values, offsets).

    ``sizes`` is the metadata: a recorded number of characters, not a number where it is absent.
    """
    dense, buckets, values, counts = [], [], [], []
    for first, encoded in chunks(texts):
        words = Words(encoded)
        n, n_words = len(encoded), np.maximum(words.counts, 1)
        owner, hashed = words.owner(), words.hashes()
        pair, times = np.unique(owner * BUCKETS + (hashed & np.uint64(BUCKETS - 1)).astype(np.int64), return_counts=True)
        of = pair // BUCKETS
        distinct = np.bincount(of, minlength=n)
        most = np.zeros(n)
        np.maximum.at(most, of, times)
        again = np.zeros(n)
        if len(words) > 1:
            same = (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])
            again = np.bincount(owner[1:][same], minlength=n)
        histograms = np.array([np.bincount(np.frombuffer(b, np.uint8), minlength=256) for b in encoded])
        n_bytes = np.maximum(histograms.sum(1), 1)
        lines = np.array([_lines(b) for b in encoded], float)
        letters = np.maximum(histograms[:, _LETTER].sum(1), 1)
        symbols = histograms[:, _SYMBOL].sum(1)
        word_length = np.bincount(owner, words.lengths, minlength=n) / n_words
        recorded = sizes[first : first + n]
        recorded = np.where(np.isfinite(recorded) & (recorded >= 0), recorded, n_bytes)
        dense.append(
            np.column_stack(
                [
                    np.log1p(n_bytes),
                    np.log1p(words.counts),
                    np.log1p(recorded),
                    word_length,
                    histograms[:, _UPPER].sum(1) / letters,
                    symbols / n_bytes,
                    (symbols - histograms[:, _STOPS].sum(1)) / n_words,
                    histograms[:, 124] / n_words,
                    histograms[:, 33] / n_words,
                    histograms[:, _DIGIT].sum(1) / n_bytes,
                    histograms[:, _SPACE].sum(1) / n_bytes,
                    distinct / n_words,
                    most / n_words,
                    again / n_words,
                    lines[:, 1] / np.maximum(lines[:, 0], 1),
                    np.log1p(lines[:, 2]),
                    np.log1p(n_words / np.maximum(lines[:, 0], 1)),
                ]
            )
        )
        weight = 1 + np.log(times)
        norm = np.sqrt(np.bincount(of, weight**2, minlength=n))
        buckets.append((pair % BUCKETS).astype(np.int32))
        values.append((weight / norm[of]).astype(np.float32))
        counts.append(distinct)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)
    return np.concatenate(dense), np.concatenate(buckets), np.concatenate(values), offsets


@dataclass
class FactorisationMachine:
    """``linear`` and ``factors`` cover the word buckets first, then the statistics."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def _sums(self, buckets, values, offsets, dense):
        """First-order part, factor sums and sums of squares of each row."""
        n = len(dense)
        w, v = self.linear[:BUCKETS], self.factors[:BUCKETS]
        owner = np.repeat(np.arange(n), np.diff(offsets))
        first = np.bincount(owner, w[buckets] * values, minlength=n) + dense @ self.linear[BUCKETS:]
        sums, squares = np.zeros((n, RANK)), np.zeros(n)
        for f in range(RANK):
            part = v[:, f][buckets] * values
            sums[:, f] = np.bincount(owner, part, minlength=n)
            squares += np.bincount(owner, part.astype(np.float64) ** 2, minlength=n)
        own = self.factors[BUCKETS:]
        return first, sums + dense @ own, squares + (dense**2) @ (own**2).sum(1)

    def standard(self, dense: np.ndarray) -> np.ndarray:
        return np.clip((dense - self.mean) / self.scale, -6, 6)

    def raw(self, buckets, values, offsets, dense) -> np.ndarray:
        first, sums, squares = self._sums(buckets, values, offsets, dense)
        return self.bias + first + 0.5 * ((sums**2).sum(1) - squares)

    def score(self, texts: list[str | None], sizes: np.ndarray) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        dense, buckets, values, offsets = features(texts, sizes)
        return 1 / (1 + np.exp(-np.clip(self.raw(buckets, values, offsets, self.standard(dense)), -30, 30)))


def _constant(labels: np.ndarray) -> FactorisationMachine:
    share = (labels.sum() + 1) / (len(labels) + 2)
    size = BUCKETS + STATISTICS
    return FactorisationMachine(
        float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, RANK)), np.zeros(STATISTICS), np.ones(STATISTICS)
    )


def train(dense, buckets, values, offsets, labels, epochs: int = EPOCHS, batch: int = 128) -> FactorisationMachine:
    """Logistic loss, both labels with equal total weight up to a shift of the bias; Adagrad; fixed seed."""
    if len(set(labels.tolist())) < 2:
        return _constant(labels)
    draw = np.random.default_rng(7)
    size = BUCKETS + dense.shape[1]
    fm = FactorisationMachine(
        0.0, np.zeros(size), draw.normal(0, 0.02, (size, RANK)), dense.mean(0), np.maximum(dense.std(0), 1e-6)
    )
    rows = fm.standard(dense)
    grown_w, grown_v, grown_b = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
    rate, decay = 0.1, 1e-5
    for _ in range(epochs):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            sizes = offsets[own + 1] - offsets[own]
            place = np.arange(int(sizes.sum())) + np.repeat(offsets[own] - (np.cumsum(sizes) - sizes), sizes)
            b, x = buckets[place], values[place]
            d, where = rows[own], np.concatenate([[0], np.cumsum(sizes)])
            first, sums, squares = fm._sums(b, x, where, d)
            guess = 1 / (1 + np.exp(-np.clip(fm.bias + first + 0.5 * ((sums**2).sum(1) - squares), -30, 30)))
            error = (guess - labels[own]) / len(own)
            owner = np.repeat(np.arange(len(own)), sizes)
            touched, back = np.unique(b, return_inverse=True)
            step = error[owner] * x
            grad_w = np.bincount(back, step, minlength=len(touched)) + decay * fm.linear[touched]
            v = fm.factors[touched]
            squared = np.bincount(back, step * x, minlength=len(touched))
            grad_v = np.column_stack(
                [np.bincount(back, step * sums[owner, f], minlength=len(touched)) for f in range(RANK)]
            ) - v * squared[:, None] + decay * v
            tail = slice(BUCKETS, None)
            own_v = fm.factors[tail]
            dense_w = error @ d + decay * fm.linear[tail]
            dense_v = (d * error[:, None]).T @ sums - own_v * ((d**2).T @ error)[:, None] + decay * own_v
            for index, gw, gv in ((touched, grad_w, grad_v), (tail, dense_w, dense_v)):
                grown_w[index] += gw**2
                grown_v[index] += gv**2
                fm.linear[index] -= rate * gw / np.sqrt(grown_w[index])
                fm.factors[index] -= 0.5 * rate * gv / np.sqrt(grown_v[index])
            grown_b += error.sum() ** 2
            fm.bias -= rate * error.sum() / np.sqrt(grown_b)
    return fm


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> FactorisationMachine:
    """A machine learnt from at most ``sample`` labelled documents of ``docs`` (doc_id, text, n_chars)."""
    rows = labelled_sample(docs, labels, label, sample)

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                d, b, x, o = features(list(frame["text"]), frame["size"].to_numpy(float))
                yield pd.DataFrame(
                    {
                        "key": frame["key"].astype(str),
                        "label": frame["label"],
                        "dense": [r.astype("<f8").tobytes() for r in d],
                        "buckets": [b[s:e].astype("<i4").tobytes() for s, e in zip(o, o[1:], strict=False)],
                        "weights": [x[s:e].astype("<f4").tobytes() for s, e in zip(o, o[1:], strict=False)],
                    }
                )

    # Bounded by ``sample`` rows of at most BUCKETS entries each.
    got = (
        rows.mapInPandas(extract, "key string, label int, dense binary, buckets binary, weights binary")
        .toPandas()
        .sort_values("key")
    )
    if not len(got):
        return _constant(np.zeros(0))
    dense = np.frombuffer(b"".join(got["dense"]), "<f8").reshape(len(got), -1)
    sizes = np.array([len(x) // 4 for x in got["buckets"]])
    return train(
        dense,
        np.frombuffer(b"".join(got["buckets"]), "<i4"),
        np.frombuffer(b"".join(got["weights"]), "<f4"),
        np.concatenate([[0], np.cumsum(sizes)]),
        got["label"].to_numpy(float),
    )


def score(docs: DataFrame, model: FactorisationMachine, text: str = "text") -> Column:
    """The score of each row as a column; only the text and its recorded size travel to Python."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, sizes in batches:
            yield pd.Series(held.value.score(list(texts), sizes.to_numpy(float)))

    return apply(F.col(text), recorded_size(docs))
