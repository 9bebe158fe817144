"""Language identification: a convolutional network over bytes, in numpy.

A text is cut into windows of ``WINDOW`` bytes, the last one padded.  Filters of several
widths run over each window; the maximum of each filter over the window feeds a softmax over
the languages.  A text's prediction multiplies the windows' probabilities, each weighted by
the bytes it holds.  Windows keep ``OVERLAP`` bytes of their neighbour, so that no filter
position is lost at a cut.

Learning uses windows of at most ``PER_LANGUAGE`` documents of each language (in expectation;
documents are chosen by key hash, so the same in every run).  Scoring reads every text in full.

A null text, or one without a letter, is ``und`` with score 0.  Documents without a language
teach nothing.  Without any, every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overlake.llm.tables import remainder
from overlake.llm.words import chunks

#: Training documents of each language, in expectation, and windows taken from each at most.
PER_LANGUAGE = 1_500
WINDOWS_EACH = 3
#: Languages that the softmax can have; the most frequent are learnt.
LANGUAGES = 512
WINDOW = 256
WIDTHS = (2, 3, 4)
OVERLAP = max(WIDTHS) - 1
FILTERS = 16
EMBEDDING = 12
EPOCHS = 4
#: Windows that go through the network together.
BATCH = 512
UNKNOWN = "und"

_LETTER = r"\p{L}"


def windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The windows of a text, zero-padded, and the bytes that each adds."""
    step = WINDOW - OVERLAP
    n = max(1, -(-max(len(text) - OVERLAP, 1) // step))
    padded = np.zeros(n * step + OVERLAP, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    own = np.minimum(step, len(text) - step * np.arange(n)).clip(1)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step], own


def _lowered(text: bytes) -> bytes:
    """ASCII letters lower-cased; ASCII digits and signs become spaces, so that only letters tell."""
    return text.translate(_ONLY_LETTERS)


_ONLY_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x E
    filters: list[np.ndarray]  # per width: width x E x F
    biases: list[np.ndarray]
    output: np.ndarray  # (widths * F) x languages
    output_bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """What each byte adds to each filter at each of its positions."""
        return [[(self.embedding @ w[j]).astype(np.float32) for j in range(len(w))] for w in self.filters]

    def pooled(self, batch: np.ndarray, tables: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Filter maxima of each window, and where they are."""
        maxima, places = [], []
        for parts, bias in zip(tables, self.biases, strict=True):
            n = WINDOW - len(parts) + 1
            total = parts[0][batch[:, :n]]
            for j in range(1, len(parts)):
                total += parts[j][batch[:, j : j + n]]
            at = total.argmax(1)
            places.append(at)
            maxima.append(np.take_along_axis(total, at[:, None], 1)[:, 0] + bias)
        return np.maximum(np.concatenate(maxima, 1), 0), places

    def log_probabilities(self, batch: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        out = self.pooled(batch, tables)[0] @ self.output + self.output_bias
        out -= out.max(1, keepdims=True)
        return out - np.log(np.exp(out).sum(1, keepdims=True))


class Scorer:
    """A network with its tables folded: pairs of bytes are looked up at once."""

    def __init__(self, network: Network):
        self.network = network
        single = network.tables()
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        self.folded = []
        for parts in single:
            looked, j = [], 0
            while j < len(parts):
                if j + 1 < len(parts):
                    looked.append((j, True, pair(parts[j], parts[j + 1])))
                    j += 2
                else:
                    looked.append((j, False, parts[j]))
                    j += 1
            self.folded.append((len(parts), looked))

    def _log_probabilities(self, batch: np.ndarray) -> np.ndarray:
        net = self.network
        wide = batch[:, :-1].astype(np.intp) * 256 + batch[:, 1:]
        maxima = []
        for (width, looked), bias in zip(self.folded, net.biases, strict=True):
            n = WINDOW - width + 1
            total = None
            for j, paired, table in looked:
                part = table.take((wide if paired else batch)[:, j : j + n], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            maxima.append(total.max(1) + bias)
        out = np.maximum(np.concatenate(maxima, 1), 0) @ net.output + net.output_bias
        out -= out.max(1, keepdims=True)
        return out - np.log(np.exp(out).sum(1, keepdims=True))

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the likeliest language, and its probability, of each text."""
        best, sure = [np.zeros(0, np.int64)], [np.zeros(0)]
        for _, encoded in chunks(texts, 1 << 20):
            cut = [windows(_lowered(b)) for b in encoded]
            rows, weight = np.concatenate([w for w, _ in cut]), np.concatenate([o for _, o in cut])
            logs = np.concatenate([self._log_probabilities(rows[i : i + BATCH]) for i in range(0, len(rows), BATCH)])
            first = np.cumsum([0] + [len(w) for w, _ in cut])[:-1]
            total = np.add.reduceat(logs * (weight / (WINDOW - OVERLAP))[:, None], first)
            total -= total.max(1, keepdims=True)
            share = np.exp(total) / np.exp(total).sum(1, keepdims=True)
            best.append(share.argmax(1))
            sure.append(share.max(1))
        return np.concatenate(best), np.concatenate(sure)


def train(rows: np.ndarray, classes: np.ndarray, languages: list[str], epochs: int = EPOCHS, batch: int = 64) -> Network:
    """Cross-entropy with equal total weight for each language; Adam; fixed seed."""
    draw = np.random.default_rng(11)
    net = Network(
        languages,
        draw.normal(0, 0.3, (256, EMBEDDING)),
        [draw.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS)) for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        draw.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))),
        np.zeros(len(languages)),
    )
    weight = len(classes) / (len(languages) * np.maximum(np.bincount(classes, minlength=len(languages)), 1))
    held = [net.embedding, *net.filters, *net.biases, net.output, net.output_bias]
    first, second, step = [np.zeros_like(p) for p in held], [np.zeros_like(p) for p in held], 0
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            x, y = rows[own], classes[own]
            hidden, places = net.pooled(x, net.tables())
            logits = hidden @ net.output + net.output_bias
            logits -= logits.max(1, keepdims=True)
            share = np.exp(logits)
            share /= share.sum(1, keepdims=True)
            share[np.arange(len(own)), y] -= 1
            share *= (weight[y] / len(own))[:, None]
            grad_output, grad_output_bias = hidden.T @ share, share.sum(0)
            back = (share @ net.output.T) * (hidden > 0)
            grad_embedding = np.zeros_like(net.embedding)
            grad_filters, grad_biases = [], []
            for k, (w, place) in enumerate(zip(net.filters, places, strict=True)):
                slope = back[:, k * FILTERS : (k + 1) * FILTERS]
                grad = np.zeros_like(w)
                for j in range(len(w)):
                    byte = x[np.arange(len(own))[:, None], place + j]
                    grad[j] = np.einsum("bf,bfe->ef", slope, net.embedding[byte])
                    np.add.at(grad_embedding, byte, slope[:, :, None] * w[j].T[None])
                grad_filters.append(grad)
                grad_biases.append(slope.sum(0))
            step += 1
            rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, m, v in zip(
                held, [grad_embedding, *grad_filters, *grad_biases, grad_output, grad_output_bias], first, second, strict=True
            ):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * m / (np.sqrt(v) + 1e-8)
    return net


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, mod: int = 3, kept_back: int = 1) -> Network | None:
    """A network learnt from (doc_id, text, lang), without rows that are kept back."""
    rows = docs.select(F.col("doc_id").alias("key"), F.col("lang").alias("lang"), F.col("text").alias("text")).where(
        F.col("lang").isNotNull() & F.col("key").isNotNull() & F.col("text").rlike(_LETTER)
    )
    rows = rows.where(remainder(F.col("key"), mod) != kept_back)
    chance = (
        rows.groupBy("lang")
        .count()
        .orderBy(F.desc("count"), "lang")
        .limit(LANGUAGES)
        .select("lang", (F.lit(per_language) / F.col("count")).alias("chance"))
    )
    hashed = F.pmod(F.xxhash64(F.lit(5), "key"), F.lit(1 << 30)) / float(1 << 30)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, langs, held = [], [], []
            for key, lang, text in zip(frame["key"], frame["lang"], frame["text"], strict=True):
                own, _ = windows(_lowered(text.encode("utf-8", "replace")))
                for i in np.linspace(0, len(own) - 1, min(WINDOWS_EACH, len(own))).astype(int):
                    keys.append(f"{key}:{i}")
                    langs.append(lang)
                    held.append(own[i].tobytes())
            yield pd.DataFrame({"key": keys, "lang": langs, "window": held})

    # At most LANGUAGES rows are broadcast; what returns is bounded by languages x per_language windows.
    got = (
        rows.join(F.broadcast(chance), "lang")
        .where(hashed < F.col("chance"))
        .select("key", "lang", "text")
        .mapInPandas(cut, "key string, lang string, window binary")
        .toPandas()
        .sort_values(["key", "lang", "window"])
    )
    if not len(got):
        return None
    languages = sorted(set(got["lang"]))
    rows_ = np.frombuffer(b"".join(got["window"]), np.uint8).reshape(len(got), WINDOW)
    return train(rows_, np.searchsorted(languages, got["lang"].to_numpy(str)), languages)


def predict(docs: DataFrame, network: Network | None, text: str = "text") -> Column:
    """(lang_pred, score) of each row as a struct; only the text travels to Python."""
    body = F.col(text)
    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if network is None:
        return none
    held = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("lang_pred string, score double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(held.value)
        names = np.array(held.value.languages, dtype=object)
        for texts in batches:
            best, sure = scorer.score(list(texts))
            yield pd.DataFrame({"lang_pred": names[best], "score": np.minimum(sure, 1.0)})

    return F.when(F.coalesce(body.rlike(_LETTER), F.lit(False)), apply(body)).otherwise(none)
