"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features are densities of a lexicon, second-person words near lexicon words, capitals,
punctuation and obfuscation rates.  The lexicon holds a few fixed words and what labelled
documents show: words, and word beginnings, that are toxic far more often than not.

Two halves of the sample teach each other: the lexicon of one gives the features of the other,
and the trees of one give the scores on which the other is calibrated.  So a chance word of a
training document does not count as evidence.  The lexicon and the trees that are kept are
learnt from both.

Learning uses at most ``SAMPLE`` labelled documents; scoring reads every text in full.  Null
and empty texts have all rates zero and are scored like any other row.  Without labelled rows,
or with one label only, every score is the smoothed share of toxic rows (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overlake.llm.tables import labelled_sample, stored
from overlake.llm.words import WORD_BYTES, Words, chunks

#: Labelled documents that learning sees, at most.
SAMPLE = 24_000
#: Learned lexicon entries, at most.
ENTRIES = 20_000
#: Documents that an entry must be in.
LEAST = 5
#: Score from which a document counts as toxic.
THRESHOLD = 0.3
#: Word beginnings of these many bytes are entries besides whole words (0).
PREFIXES = (0, 4, 5, 6)
#: A lexicon word counts as addressed when a second-person word is within so many words.
NEAR = 6

# Fixed values.
SEED_WORDS = "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown imbecile dumb".split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre usted ustedes tú ti vos".split()

_LEET = str.maketrans("013457@$", "oleastas")
#: As WORD_BYTES, with digits and signs that stand for letters read as those.
PLAIN_BYTES = bytes(
    ord(chr(b).translate(_LEET)) if chr(b) in "013457@$" else WORD_BYTES[b] for b in range(256)
)
FEATURES = 17

_CLASS = np.zeros(256, np.int8)  # 1 letters, 2 digits and signs inside words, 0 others
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[48:58] = 2
_CLASS[[33, 36, 42, 64, 95]] = 2


def _hashed(words: list[str]) -> np.ndarray:
    return np.sort(Words([" ".join(words).encode()]).hashes())


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


@dataclass
class Lexicon:
    """Sorted hashes by kind: whole words (0) and word beginnings of 4, 5 and 6 bytes."""

    entries: dict[int, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        self.seeds, self.second = _hashed(SEED_WORDS), _hashed(SECOND_PERSON)

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word is a whole entry; whether it begins like one."""
        whole = words.hashes()
        exact = _member(whole, self.seeds) | _member(whole, self.entries.get(0, self.seeds))
        begins = np.zeros(len(words), bool)
        for size in PREFIXES[1:]:
            if len(self.entries.get(size, ())):
                begins |= _member(words.hashes(size), self.entries[size])
        return exact, begins


def features(texts: list[str | None], lexicon: Lexicon) -> np.ndarray:
    rows = [np.zeros((0, FEATURES))]
    for _, encoded in chunks(texts):
        words, n = Words(encoded), len(encoded)
        owner, n_words = words.owner(), np.maximum(words.counts, 1)
        total = lambda mask: np.bincount(owner[mask], minlength=n)
        exact, begins = lexicon.hits(words)
        hit = exact | begins
        second = _member(words.hashes(), lexicon.second)
        # Words of one text are consecutive; a cumulative count gives those near each hit.
        seen = np.concatenate([[0], np.cumsum(second)])
        place = np.flatnonzero(hit)
        low = np.maximum(place - NEAR, words.offsets[:-1][owner[place]])
        high = np.minimum(place + NEAR + 1, words.offsets[1:][owner[place]])
        near = np.bincount(owner[place], (seen[high] > seen[low]).astype(float), minlength=n)
        plain = Words(encoded, PLAIN_BYTES)
        plain_exact, _ = lexicon.hits(plain)
        plain_hits = np.bincount(plain.owner()[plain_exact], minlength=n)
        hidden = np.maximum(plain_hits - total(exact), 0)
        body = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
        kind = _CLASS[body]
        inner = np.flatnonzero((kind[1:-1] == 2) & (kind[:-2] == 1) & (kind[2:] == 1)) + 1
        ends = np.cumsum([len(b) + 1 for b in encoded])
        mixed = np.bincount(np.searchsorted(ends, inner, "right"), minlength=n)
        histograms = np.array([np.bincount(np.frombuffer(b, np.uint8), minlength=256) for b in encoded])
        size = np.maximum(histograms.sum(1), 1)
        upper = histograms[:, 65:91].sum(1)
        letters = np.maximum(upper + histograms[:, 97:123].sum(1) + histograms[:, 128:].sum(1), 1)
        hits = total(hit)
        rows.append(
            np.column_stack(
                [
                    total(exact),
                    total(begins),
                    hits,
                    total(exact) / n_words,
                    total(begins) / n_words,
                    hits / n_words,
                    hits / np.sqrt(n_words),
                    near,
                    near / n_words,
                    total(second) / n_words,
                    hidden,
                    mixed / n_words,
                    upper / letters,
                    histograms[:, 33] / size,
                    histograms[:, 63] / size,
                    (histograms[:, 33:48].sum(1) + histograms[:, 58:65].sum(1)) / size,
                    np.log1p(words.counts),
                ]
            )
        )
    return np.concatenate(rows)


@dataclass
class Boosted:
    """Trees as arrays of split feature, split value and leaf; then calibration steps."""

    base: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    steps: tuple[np.ndarray, np.ndarray]

    def raw(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        for which, value, leaf in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (rows[np.arange(len(rows)), which[at]] > value[at])
            out += leaf[at - len(which)]
        return out

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(rows), *self.steps)


DEPTH, TREES, RATE, BINS = 3, 60, 0.2, 64


def grow(rows: np.ndarray, labels: np.ndarray) -> Boosted:
    """Second-order boosting of the logistic loss over histogram bins; ties take the first split."""
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), [], (np.zeros(1), np.zeros(1)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in rows.T]
    # A rate that is zero nearly everywhere keeps its non-zero range apart.
    for j, c in enumerate(rows.T):
        if len(positive := c[c > 0]):
            edges[j] = np.unique(np.concatenate([edges[j], [0.0], np.quantile(positive, np.linspace(0, 1, 17)[1:-1])]))
    bins = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, rows.T, strict=True)])
    width = max(len(e) for e in edges) + 1
    raw, nodes = np.full(len(rows), model.base), 2**DEPTH - 1
    for _ in range(TREES):
        guess = 1 / (1 + np.exp(-raw))
        slope, bend = guess - labels, np.maximum(guess * (1 - guess), 1e-6)
        which, value, cut = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.full(nodes, width, np.int64)
        at = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            first, here = 2**level - 1, 2**level
            best = np.full(here, 1e-3)
            for j in range(rows.shape[1]):
                if not len(edges[j]):
                    continue
                cell = (at - first) * width + bins[:, j]
                g = np.bincount(cell, slope, minlength=here * width).reshape(here, width)
                h = np.bincount(cell, bend, minlength=here * width).reshape(here, width)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < 1) | (ht - hl < 1)] = 0
                top = gain.argmax(1)
                better = gain[np.arange(here), top] > best
                for k in np.flatnonzero(better):
                    if top[k] < len(edges[j]):
                        best[k] = gain[k, top[k]]
                        which[first + k], value[first + k], cut[first + k] = j, edges[j][top[k]], top[k]
            at = 2 * at + 1 + (bins[np.arange(len(rows)), which[at]] > cut[at])
        leaf = -RATE * np.bincount(at - nodes, slope, minlength=nodes + 1) / (np.bincount(at - nodes, bend, minlength=nodes + 1) + 1)
        raw += leaf[at - nodes]
        model.trees.append((which, value, leaf))
    return model


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: the best non-decreasing fit, as points to interpolate between.

    Each block's share is smoothed by one half-row of either label, so that no score is
    certain beyond what the rows support.
    """
    points, back = np.unique(x, return_inverse=True)
    blocks: list[list[float]] = []
    for at, good, n in zip(points, np.bincount(back, y), np.bincount(back), strict=True):
        blocks.append([at, at, good, n])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, end, more, m = blocks.pop()
            blocks[-1][1:] = [end, blocks[-1][2] + more, blocks[-1][3] + m]
    xs = np.array([v for b in blocks for v in b[:2]])
    ys = np.repeat([(b[2] + 0.5) / (b[3] + 1) for b in blocks], 2)
    return xs, np.maximum.accumulate(ys)


@dataclass
class Model:
    lexicon: Lexicon
    boosted: Boosted | None
    constant: float = 0.0

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.boosted is None:
            return np.full(len(texts), self.constant)
        return self.boosted.score(features(texts, self.lexicon))


def learn_lexicons(rows: DataFrame) -> list[Lexicon]:
    """Lexicons of half 0, of half 1, and of all rows (text, label, half).

    An entry is in several documents and toxic in at least half of all, with 99 % confidence.
    Spark counts; at most ``ENTRIES`` entries of each lexicon return.
    """

    def entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            labels, halves = frame["label"].to_numpy(), frame["half"].to_numpy()
            for first, encoded in chunks(list(frame["text"])):
                words = Words(encoded)
                owner = words.owner()
                for size in PREFIXES:
                    long = np.ones(len(words), bool) if size == 0 else words.lengths > size
                    hashed = words.hashes(size or None)[long]
                    order = np.lexsort((hashed, owner[long]))
                    h, o = hashed[order], owner[long][order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                    h, of = h[new], first + o[new]
                    for half in (0, 1):
                        own = halves[of] == half
                        found, back = np.unique(h[own], return_inverse=True)
                        n = np.bincount(back, minlength=len(found))
                        toxic = np.bincount(back, labels[of[own]], minlength=len(found))
                        yield pd.DataFrame({"half": half, "size": size, "entry": found.view(np.int64), "toxic": toxic, "n": n})

    counts = (
        rows.mapInPandas(entries, "half int, size int, entry long, toxic double, n long")
        .groupBy("size", "entry")
        .agg(*[F.sum(F.when(F.col("half") == h, F.col(c)).otherwise(0)).alias(f"{c}{h}") for c in ("toxic", "n") for h in (0, 1)])
    )
    counts = stored(counts, "lexicon-counts")
    lexicons = []
    for toxic, n in (("toxic0", "n0"), ("toxic1", "n1"), ("toxic0 + toxic1", "n0 + n1")):
        n_, share, z = F.expr(n), F.expr(f"({toxic}) / ({n})"), 2.326
        margin = z * F.sqrt(share * (1 - share) / n_ + z**2 / (4 * n_**2))
        low = (share + z**2 / (2 * n_) - margin) / (1 + z**2 / n_)
        got = (
            counts.where(f"{n} >= {LEAST}")
            .withColumn("low", low)
            .where("low >= 0.5")
            .orderBy(F.desc("low"), "size", "entry")
            .limit(ENTRIES)
            .select("size", "entry")
            .toPandas()
        )
        lexicons.append(Lexicon({s: np.sort(g["entry"].to_numpy(np.int64).view(np.uint64)) for s, g in got.groupby("size")}))
    return lexicons


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model learnt from at most ``sample`` labelled documents of ``docs`` (doc_id, text)."""
    rows = labelled_sample(docs, labels, label, sample).withColumn("half", F.pmod(F.xxhash64(F.lit(9), "key"), F.lit(2)).cast("int"))
    rows = stored(rows, "toxicity-sample")
    lexicons = learn_lexicons(rows)
    held = docs.sparkSession.sparkContext.broadcast(lexicons)

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            halves, texts = frame["half"].to_numpy(), frame["text"].to_numpy()
            dense = np.zeros((len(frame), FEATURES))
            for half in (0, 1):
                own = halves == half
                dense[own] = features(list(texts[own]), held.value[1 - half])
            yield pd.DataFrame(
                {
                    "key": frame["key"].astype(str),
                    "label": frame["label"],
                    "half": halves,
                    "dense": [r.astype("<f8").tobytes() for r in dense],
                }
            )

    # At most ``sample`` rows of a few numbers.
    got = rows.mapInPandas(extract, "key string, label int, half int, dense binary").toPandas().sort_values("key")
    y, half = got["label"].to_numpy(float), got["half"].to_numpy()
    if min((len(set(y[half == h])) for h in (0, 1)), default=0) < 2:
        return Model(lexicons[2], None, float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.0)
    dense = np.frombuffer(b"".join(got["dense"]), "<f8").reshape(len(got), -1)
    raw = np.zeros(len(y))
    for h in (0, 1):
        raw[half == h] = grow(dense[half != h], y[half != h]).raw(dense[half == h])
    boosted = grow(dense, y)
    boosted.steps = isotonic(raw, y)
    return Model(lexicons[2], boosted)


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The calibrated score of each row as a column; only the text travels to Python."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(held.value.score(list(texts)))

    return apply(F.col(text))
