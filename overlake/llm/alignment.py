"""Cross-tokenizer alignment: which tokens of one vocabulary end together with which of another.

Every text, with a space before it, is encoded by a byte-level BPE vocabulary (A) and by a
piece vocabulary with byte fallback (B).  Byte offsets at which tokens of both end cut them
into groups; the last tokens of a group are linked.  As no token is empty, a group has one link.

Method.  ``fit`` aligns the documents once: each task sums its pairs.  The distinct pairs, cut
into buckets, get a minimal perfect hash per bucket, so the counts are dense vectors without
keys; each task makes one vector of what it reads and vectors are summed as a tree.  Keys
stand once beside the hash and are verified at every lookup.  ``align`` goes through the
documents a second time and looks up the counts of what it aligns.

Sizes.  Of two linked tokens one ends with the other, so there are at most as many distinct
pairs as ``Vocabularies.most_pairs`` says, some hundred thousand whatever the corpus: that
bounds the hash, the vectors, and what is broadcast.  Tasks hold one text at a time, as
numbers; texts are cut where no token of either vocabulary can reach across, and what is
encoded once is kept, most frequent first, up to ``KEPT`` pieces.

Null and empty texts, and texts whose tokens do not spell them (a text that holds U+2581 is
one), have no tokens and add no links.  Repeated rows count as often as they occur; a null or
repeated key is a row like others.  Other columns are left alone, and empty tables give empty
results.  A very long text is encoded in pieces; only one that nowhere can be cut is encoded whole.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from overlake.llm.tables import stored
from overlake.llm.words import mix, seeds

#: Folder of the vocabulary files; read by the driver, which sends their content to the tasks.
DIRECTORY = "/opt/tokenizers"
BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Encoded pieces that a Python worker keeps, and characters that it encodes at once.
KEPT, UNIT = 500_000, 1_000_000
#: Hash buckets of the pairs, entries in a row of a count vector, vectors summed at once.
BUCKETS, CHUNK, FAN = 61, 4_096, 32

_SPACE = " \t\n"
_LETTERS = "A-Za-z0-9À-ÖØ-öø-ÿ"
_MARKS = ".,;:!?"
#: White space that a token may hold together with what stands beside it.
_RARE_SPACE = re.compile(rf"[^\S{_SPACE}]")
#: Letters, digits and their marks: words end before a mark or white space, all else before white space.
_SEGMENT = re.compile(rf"[{_SPACE}]*+(?:[{_LETTERS}]++(?=[{_SPACE}{_MARKS}]|\Z)|[^{_SPACE}]++)|[{_SPACE}]++")
_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+\Z")
_CUT = re.compile(rf"(?<=[{_LETTERS}])(?=[{_SPACE}])")
#: What no piece may hold, for cuts to be safe: white space after something else, or a mark after a letter.
_ACROSS = re.compile(rf"[^▁\s][▁{_SPACE}]|[{_LETTERS}][{_MARKS}]")


def _byte_level() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable bytes are themselves, others follow from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabularies:
    """The content of the two vocabulary files."""

    byte_json: str
    piece_model: bytes

    @classmethod
    def read(cls, directory: str = DIRECTORY) -> Vocabularies:
        folder = Path(directory)
        return cls((folder / BYTE_VOCABULARY).read_text(), (folder / PIECE_VOCABULARY).read_bytes())

    def __reduce__(self):
        return Vocabularies, (self.byte_json, self.piece_model)

    @cached_property
    def digest(self) -> str:
        return sha256(self.byte_json.encode() + self.piece_model).hexdigest()

    @cached_property
    def byte_tokenizer(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        found = Tokenizer.from_str(self.byte_json)
        found.encode_special_tokens = True
        return found

    @cached_property
    def byte_model(self):
        return self.byte_tokenizer.model

    @cached_property
    def byte_names(self) -> dict[int, str]:
        """The character that the vocabulary has for each byte."""
        return {byte: name for name, byte in _byte_level().items()}

    @cached_property
    def piece_tokenizer(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.piece_model)

    @cached_property
    def byte_tokens(self) -> list[bytes]:
        to_byte = _byte_level()
        model = json.loads(self.byte_json)
        names = model["model"]["vocab"] | {t["content"]: t["id"] for t in model["added_tokens"]}
        out = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            out[i] = bytes(to_byte[c] for c in name)
        return out

    @cached_property
    def piece_tokens(self) -> list[bytes]:
        pieces = self.piece_tokenizer
        names = [pieces.id_to_piece(i) for i in range(pieces.vocab_size())]
        return [
            bytes([int(name[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", name) else name.replace("▁", " ").encode()
            for name in names
        ]

    @cached_property
    def can_be_cut(self) -> bool:
        """Whether no piece reaches across the places where texts are cut."""
        pieces = self.piece_tokenizer
        own = [i for i in range(pieces.vocab_size()) if not (pieces.is_byte(i) or pieces.is_control(i) or pieces.is_unknown(i))]
        return not any(_ACROSS.search(pieces.id_to_piece(i)) for i in own) and len(pieces.encode("a")) == 1

    def most_pairs(self) -> int:
        """No corpus has more distinct linked pairs: one token of a pair is a suffix of the other.

        Each token has as many suffixes as bytes, and each suffix stands for as many ids as spell it.
        """
        ids: dict[bytes, int] = {}
        for t in self.piece_tokens:
            ids[t] = ids.get(t, 0) + 1
        own: dict[bytes, int] = {}
        for t in self.byte_tokens:
            own[t] = own.get(t, 0) + 1
        shorter = sum(ids.get(t[i:], 0) for t in self.byte_tokens for i in range(len(t)))
        longer = sum(own.get(t[i:], 0) for t in self.piece_tokens for i in range(1, len(t)))
        return shorter + longer


def segments(piece: str) -> list[str]:
    """A piece cut where neither vocabulary has a token across."""
    return _CUT.split(piece) if _RARE_SPACE.search(piece) else _SEGMENT.findall(piece)


def pieces(text: str, size: int) -> Iterator[str]:
    """A text cut between words, where it has any, after every ``size`` characters."""
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class MinimalHash:
    """Numbers 0..n-1 for n distinct keys: a key counts at the first level where it is alone at its place.

    ``levels`` are bit sets of the places so taken, of ``widths`` bits; ``keys``, in the order
    of their numbers, verify every lookup.
    """

    def __init__(self, levels: Sequence[bytes], widths: Sequence[int], keys: np.ndarray):
        self.levels, self.widths, self.keys = list(levels), list(widths), keys.astype(np.uint64)

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalHash:
        left = np.unique(keys.astype(np.uint64))
        levels, widths, placed = [], [], [np.zeros(0, np.uint64)]
        while len(left):
            width = 2 * len(left) + 1
            place = cls._place(left, len(levels), width)
            alone = np.bincount(place, minlength=width) == 1
            mine = alone[place]
            placed.append(left[mine][np.argsort(place[mine])])
            levels.append(np.packbits(alone).tobytes())
            widths.append(width)
            left = left[~mine]
        return cls(levels, widths, np.concatenate(placed))

    @staticmethod
    def _place(keys: np.ndarray, level: int, width: int) -> np.ndarray:
        return (mix(keys + seeds(level + 1, 7)[level]) % np.uint64(width)).astype(np.int64)

    @cached_property
    def _ranks(self) -> list[tuple[np.ndarray, np.ndarray]]:
        out, before = [], 0
        for bits, width in zip(self.levels, self.widths, strict=True):
            alone = np.unpackbits(np.frombuffer(bits, np.uint8), count=width).astype(bool)
            out.append((alone, np.cumsum(alone) - 1 + before))
            before += int(alone.sum())
        return out

    def __len__(self) -> int:
        return len(self.keys)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 of what is none of the keys."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        waiting = np.arange(len(keys))
        for level, (alone, rank) in enumerate(self._ranks):
            place = self._place(keys[waiting], level, len(alone))
            mine = alone[place]
            out[waiting[mine]] = rank[place[mine]]
            waiting = waiting[~mine]
        found = np.flatnonzero(out >= 0)
        out[found[self.keys[out[found]] != keys[found]]] = -1
        return out


class PairIndex:
    """A minimal perfect hash of all pairs, put together from those of the buckets."""

    def __init__(self, parts: Sequence[tuple[int, MinimalHash]]):
        self.parts = dict(parts)
        self.first, n = {}, 0
        for bucket in sorted(self.parts):
            self.first[bucket] = n
            n += len(self.parts[bucket])
        self.n = n

    @property
    def keys(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *[self.parts[b].keys for b in sorted(self.parts)]]).astype(np.int64)

    def numbers(self, pairs: np.ndarray) -> np.ndarray:
        """The number of each pair; -1 of what is none of the pairs."""
        out = np.full(len(pairs), -1, np.int64)
        bucket = pairs % BUCKETS
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        for b in np.unique(bucket).tolist():
            mine = order[edges[b] : edges[b + 1]]
            if b in self.parts:
                own = self.parts[b].numbers(pairs[mine])
                out[mine] = np.where(own >= 0, own + self.first[b], -1)
        return out

    def known(self, pairs: np.ndarray) -> np.ndarray:
        """As ``numbers``; every pair must be there."""
        out = self.numbers(pairs)
        if (out < 0).any():
            raise ValueError("a pair is not in the index; the documents have changed since it was built")
        return out


class Counts:
    """Pair counts by their number in the index, and each B token's highest."""

    def __init__(self, index: PairIndex, counts: np.ndarray):
        self.index, self.counts = index, counts
        to = index.keys & 0xFFFFFFFF
        best = np.zeros(int(to.max(initial=0)) + 1, np.int64)
        np.maximum.at(best, to, counts)
        self.is_best = counts == best[to]


FIGURES = 7


class Segments:
    """Encoded and aligned pieces of text that a worker has met, by number."""

    def __init__(self, vocabularies: Vocabularies):
        self.of = vocabularies
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        #: Linked pairs, as the bytes of 64-bit numbers.
        self.links: list[bytes] = []
        #: n_a, n_b, links, spelt; then, as of ``model``, best, sum and links that have no count.
        self.figures = np.zeros((1024, FIGURES), np.int64)
        self.seen = np.zeros(1024, np.int64)
        self.model, self.scored = None, 0
        self.a_length = np.array(list(map(len, vocabularies.byte_tokens)))
        self.b_length = np.array(list(map(len, vocabularies.piece_tokens)))
        self.ids = max(len(self.a_length), len(self.b_length))
        #: Every id before a comma, a bar, a semicolon, and at the end of a segment.
        self.written = [f"{i}{end}" for end in ",|;\n" for i in range(self.ids)]

    def _by_bytes(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text by the byte-level vocabulary.

        A word of common letters, perhaps after a space, is one unit of that vocabulary's own
        cutting, so its model is asked at once.
        """
        of = self.of
        out: list[list[int] | None] = [
            [t.id for t in of.byte_model.tokenize(x.encode().decode("latin-1").translate(of.byte_names))] if _WORD.match(x) else None
            for x in texts
        ]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, of.byte_tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    def _spelt(self, texts: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Whether the tokens of each text spell it."""
        data, (a_tokens, b_tokens) = [t.encode() for t in texts], (self.of.byte_tokens, self.of.piece_tokens)
        size = np.fromiter(map(len, data), np.int64, len(data))

        def sizes(ids: list[list[int]], length: np.ndarray) -> np.ndarray:
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
            return np.bincount(np.repeat(np.arange(len(ids)), n), length[flat], len(ids)).astype(np.int64)

        # Where every size is right, one comparison of everything joined tells all.
        if (sizes(a, self.a_length) == size).all() and (sizes(b, self.b_length) == size).all():
            joined = b"".join(data)
            if all(b"".join(map(t.__getitem__, chain.from_iterable(x))) == joined for t, x in ((a_tokens, a), (b_tokens, b))):
                return np.ones(len(data), bool)
        return np.array(
            [
                b"".join([a_tokens[x] for x in own_a]) == own == b"".join([b_tokens[x] for x in own_b])
                for own, own_a, own_b in zip(data, a, b, strict=True)
            ],
            bool,
        )

    def _aligned(self, a: list[list[int]], b: list[list[int]]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Written groups of each text, all links, and the number of each text's links.

        Texts stand behind each other: byte ends grow over all of them.
        """
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a, n_a), (b, n_b)))
        end_a, end_b = np.cumsum(self.a_length[flat_a]), np.cumsum(self.b_length[flat_b])
        last_a = np.flatnonzero(np.isin(end_a, end_b, assume_unique=True))
        last_b = np.flatnonzero(np.isin(end_b, end_a, assume_unique=True))
        text_end = np.zeros(len(flat_a), bool)
        text_end[np.cumsum(n_a) - 1] = True
        closing = np.flatnonzero(text_end[last_a])
        n_links = np.diff(closing, prepend=-1)
        # A group's A tokens are written before its B tokens: each id is moved by those of the other kind.
        groups = len(last_a)
        group_a = np.repeat(np.arange(groups), np.diff(last_a, prepend=-1))
        group_b = np.repeat(np.arange(groups), np.diff(last_b, prepend=-1))
        place_a = np.arange(len(flat_a)) + np.concatenate([[0], last_b + 1])[group_a]
        place_b = np.arange(len(flat_b)) + (last_a + 1)[group_b]
        ending_a, ending_b = np.zeros(len(flat_a), np.int64), np.zeros(len(flat_b), np.int64)
        ending_a[last_a] = 1
        ending_b[last_b] = 2
        ending_b[last_b[closing]] = 3
        codes = np.zeros(len(flat_a) + len(flat_b), np.int64)
        codes[place_a] = flat_a + ending_a * self.ids
        codes[place_b] = flat_b + ending_b * self.ids
        written = "".join(map(self.written.__getitem__, codes.tolist())).split("\n")[:-1]
        return written, flat_a[last_a] << 32 | flat_b[last_b], n_links

    def _add(self, new: list[str]) -> None:
        first, n = len(self.groups), len(self.groups) + len(new)
        while n > len(self.seen):
            self.figures = np.concatenate([self.figures, np.zeros_like(self.figures)])
            self.seen = np.concatenate([self.seen, np.zeros_like(self.seen)])
        a = self._by_bytes(new)
        # The letter before is a token of its own, which keeps a space from being put there.
        b = [x[1:] for x in self.of.piece_tokenizer.encode([f"a{s}" for s in new], num_threads=1)]
        spelt = self._spelt(new, a, b)
        groups, n_links = [""] * len(new), np.zeros(len(new), np.int64)
        if spelt.all():
            groups, links, n_links = self._aligned(a, b)
        else:
            own = np.flatnonzero(spelt).tolist()
            written, links, sizes = self._aligned([a[i] for i in own], [b[i] for i in own])
            for i, w, size in zip(own, written, sizes.tolist(), strict=True):
                groups[i], n_links[i] = w, size
        raw, edge = links.tobytes(), (8 * np.concatenate([[0], np.cumsum(n_links)])).tolist()
        self.links += [raw[s:e] for s, e in zip(edge[:-1], edge[1:], strict=True)]
        self.groups += groups
        self.number.update(zip(new, range(first, n), strict=True))
        self.figures[first:n, :4] = np.stack([list(map(len, a)), list(map(len, b)), n_links, spelt], axis=1)
        self.seen[first:n] = 0
        self.scored = min(self.scored, first)

    def forget(self) -> None:
        """Keeps the more frequent half of what may be kept."""
        n = len(self.groups)
        kept = np.argsort(-self.seen[:n], kind="stable")[: KEPT // 2]
        texts = list(self.number)
        self.number = {texts[i]: at for at, i in enumerate(kept.tolist())}
        self.groups = [self.groups[i] for i in kept.tolist()]
        self.links = [self.links[i] for i in kept.tolist()]
        figures, seen = self.figures[kept], self.seen[kept]
        size = 1 << max(10, len(kept).bit_length())
        self.figures, self.seen = np.zeros((size, FIGURES), np.int64), np.zeros(size, np.int64)
        self.figures[: len(kept)] = figures
        # What was frequent long ago gives way.
        self.seen[: len(kept)] = seen // 2
        self.scored = 0

    def encoded(self, texts: Sequence[str | None], unit: int, forgetting=lambda: None) -> Iterator[tuple[int, np.ndarray]]:
        """The numbers of each text's segments, in order, where the text has any.

        ``forgetting`` is called before numbers lose their meaning, always between two texts.
        """
        held: list[tuple[int, str]] = []
        done: dict[int, list[np.ndarray]] = {}
        size = 0

        @_without_collection()
        def encode() -> None:
            lists = [segments(p) if self.of.can_be_cut else [p] for _, p in held]
            flat = list(chain.from_iterable(lists))
            found = list(map(self.number.get, flat))
            missing = [i for i, number in enumerate(found) if number is None]
            if missing:
                self._add(list(dict.fromkeys([flat[i] for i in missing])))
                for i in missing:
                    found[i] = self.number[flat[i]]
            numbers = np.array(found, np.int64)
            self.seen[: len(self.groups)] += np.bincount(numbers, minlength=len(self.groups))
            edges = np.cumsum([len(x) for x in lists])[:-1]
            for (text, _), own in zip(held, np.split(numbers, edges), strict=True):
                done.setdefault(text, []).append(own)
            held.clear()

        for at, text in enumerate(texts):
            if not text:
                continue
            for piece in pieces(f" {text}", unit) if self.of.can_be_cut else (f" {text}",):
                held.append((at, piece))
                size += len(piece)
                if size >= unit:
                    encode()
                    size = 0
            if len(text) > unit and held:
                encode()
                size = 0
            if not held:
                for key, parts in done.items():
                    yield key, np.concatenate(parts)
                done.clear()
                if len(self.groups) > KEPT:
                    forgetting()
                    self.forget()
        if held:
            encode()
        for key, parts in done.items():
            yield key, np.concatenate(parts)

    def pairs(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs and their sums, where segment i occurs ``times[i]`` times."""
        used = np.flatnonzero(times[: len(self.groups)])
        n = self.figures[used, 2]
        flat = np.frombuffer(b"".join([self.links[i] for i in used.tolist()]), np.int64)
        pairs, at = np.unique(flat, return_inverse=True)
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, at, np.repeat(times[used], n))
        return pairs, sums

    def score(self, counts: Counts) -> None:
        """Brings the figures that depend on the counts up to date."""
        if self.model is not counts:
            self.model, self.scored = counts, 0
        first, n = self.scored, len(self.groups)
        if first == n:
            return
        sizes = self.figures[first:n, 2]
        flat = np.frombuffer(b"".join(self.links[first:n]), np.int64)
        numbers = counts.index.numbers(flat)
        # A worker may have met segments in other documents; a text that uses them is refused.
        there = numbers >= 0
        owner = np.repeat(np.arange(first, n), sizes)
        self.figures[first:n, 4:] = 0
        np.add.at(self.figures[:, 4], owner[there], counts.is_best[numbers[there]])
        np.add.at(self.figures[:, 5], owner[there], counts.counts[numbers[there]])
        np.add.at(self.figures[:, 6], owner[~there], 1)
        self.scored = n


@contextmanager
def _without_collection():
    """No search for reference cycles while many small lists are made, none of which is in one."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


_segments: dict[str, Segments] = {}


def _of(vocabularies: Vocabularies) -> Segments:
    """This worker's segments of the given vocabularies."""
    if vocabularies.digest not in _segments:
        _segments.clear()
        _segments[vocabularies.digest] = Segments(vocabularies)
    return _segments[vocabularies.digest]


@dataclass(frozen=True)
class Alignment:
    """What ``fit`` returns: vocabularies and counts, as the driver holds and broadcasts them."""

    vocabularies: Vocabularies
    counts: Counts

    def pairs(self, spark: SparkSession) -> DataFrame:
        """(a_id, b_id, n, best): the table of linked tokens."""
        keys = self.counts.index.keys
        rows = pd.DataFrame({"a_id": keys >> 32, "b_id": keys & 0xFFFFFFFF, "n": self.counts.counts, "best": self.counts.is_best})
        return spark.createDataFrame(rows, "a_id int, b_id int, n long, best boolean")


def _pair_sums(docs: DataFrame, vocabularies: Vocabularies, text: str, unit: int) -> DataFrame:
    """(pair, n) of each task: the first pass over the documents."""
    held = docs.sparkSession.sparkContext.broadcast(vocabularies)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _of(held.value)
        total: dict[int, int] = {}
        times = np.zeros(len(own.seen), np.int64)

        def flush() -> None:
            for pair, n in zip(*map(np.ndarray.tolist, own.pairs(times)), strict=True):
                total[pair] = total.get(pair, 0) + n
            times[:] = 0

        for batch in batches:
            for _, numbers in own.encoded(batch["text"].tolist(), unit, flush):
                if len(times) < len(own.seen):
                    times = np.concatenate([times, np.zeros(len(own.seen) - len(times), np.int64)])
                if own.figures[numbers, 3].all():
                    np.add.at(times, numbers, 1)
        flush()
        yield pd.DataFrame({"pair": list(total.keys()), "n": list(total.values())}, dtype="int64")

    return docs.select(F.col(text).alias("text")).mapInPandas(sums, "pair long, n long")


def _index(sums: DataFrame) -> PairIndex:
    """A minimal perfect hash of the distinct pairs, built bucket by bucket in tasks."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = MinimalHash.build(rows["pair"].to_numpy())
        return pd.DataFrame(
            {"bucket": [key[0]], "levels": [own.levels], "widths": [own.widths], "keys": [own.keys.astype(np.int64)]}
        )

    distinct = sums.select("pair").distinct().withColumn("bucket", F.expr(f"cast(pair % {BUCKETS} as int)"))
    schema = "bucket int, levels array<binary>, widths array<long>, keys array<long>"
    rows = distinct.groupBy("bucket").applyInPandas(build, schema).collect()
    return PairIndex([(r["bucket"], MinimalHash(r["levels"], r["widths"], np.array(r["keys"], np.int64))) for r in rows])


def _totals(sums: DataFrame, index: PairIndex) -> np.ndarray:
    """The count vector: one dense vector per task, added up as a tree."""
    spark = sums.sparkSession
    held = spark.sparkContext.broadcast(index)
    schema = "part int, chunk int, vector array<long>"

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = held.value
        vector = np.zeros(own.n, np.int64)
        for batch in batches:
            np.add.at(vector, own.known(batch["pair"].to_numpy()), batch["n"].to_numpy())
        if starts := range(0, own.n, CHUNK):
            yield pd.DataFrame(
                {
                    "part": TaskContext.get().partitionId(),
                    "chunk": range(len(starts)),
                    "vector": [vector[s : s + CHUNK] for s in starts],
                }
            )

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "chunk": [key[1]], "vector": [np.sum(np.stack(rows["vector"].tolist()), axis=0)]})

    level = stored(sums.mapInPandas(vectors, schema), "pair-vectors")
    parts = level.agg(F.max("part")).first()[0]
    while parts:
        parts //= FAN
        up = F.expr(f"cast(part div {FAN} as int)")
        level = level.groupBy(up.alias("part"), "chunk").applyInPandas(add, schema)
    rows = level.orderBy("chunk").select("vector").collect()
    return np.concatenate([np.zeros(0, np.int64), *[np.array(r["vector"], np.int64) for r in rows]])


def fit(docs: DataFrame, vocabularies: Vocabularies | None = None, text: str = "text", unit: int = UNIT) -> Alignment:
    """Counts of all linked pairs of the documents."""
    vocabularies = vocabularies or Vocabularies.read()
    sums = stored(_pair_sums(docs, vocabularies, text, unit), "pair-sums")
    index = _index(sums)
    if index.n > vocabularies.most_pairs():
        raise ValueError(f"{index.n} distinct pairs are more than the vocabularies can have")
    return Alignment(vocabularies, Counts(index, _totals(sums, index)))


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def align(docs: DataFrame, alignment: Alignment, text: str = "text", unit: int = UNIT) -> Column:
    """How each text's tokens correspond: a struct column, the second pass over the documents.

    ``groups`` lists the ids of every group as ``a1,a2|b1;a3|b2,b3``; the counts are of tokens, groups, links,
    links that are their B token's most frequent one, and the corpus-wide counts of the links summed.
    """
    held = docs.sparkSession.sparkContext.broadcast(alignment)

    @F.pandas_udf(ALIGNED)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts = held.value.counts
        own = _of(held.value.vocabularies)
        for batch in batches:
            out = np.zeros((6, len(batch)), np.int64)
            groups = [""] * len(batch)
            for at, numbers in own.encoded(batch.tolist(), unit):
                if not own.figures[numbers, 3].all():
                    continue
                own.score(counts)
                n_a, n_b, links, _, best, total, unknown = own.figures[numbers].sum(axis=0)
                if unknown:
                    raise ValueError("a linked pair has no count; the documents are not those that were counted")
                out[:, at] = n_a, n_b, links, links, best, total
                groups[at] = ";".join([own.groups[i] for i in numbers.tolist()])
            names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
            yield pd.DataFrame(dict(zip(names, out, strict=True)) | {"groups": groups})

    return found(F.col(text))
