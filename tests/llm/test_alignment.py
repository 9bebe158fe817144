import hashlib
import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from overlake.llm import alignment, queries
from tests.llm import brute
from tests.llm.conftest import CLASHING, prose, text_of

SMALL = "/root/testdata/sf0.001"
ODD = [
    None,
    "",
    " ",
    "   ",
    "\n",
    "\n\n a\n b  c\n",
    "foo ",
    " foo",
    "a▁b",
    "<|endoftext|> <s> </s> <unk> <0x41> <0x0A>",
    "tab\tand\r\nreturn\r\n\r\nend \r",
    "no break     thin space　 wide \u0085next line",
    "\x1c\x1d!\x1c x\x0b\x0cy",
    "it's we'll I'd they've 'quoted' x's,y;z:w!?a.b.c...,,,",
    "12,345.67 3rd 4th ²³. ½ x². ÀÉÎõü,ß.ñ;ø:",
    "日本語のテキスト。 中文,文本 한국어 ไทย العربية עברית",
    "😀👍🏽 é ﬁ ﻿ \x00 ퟿ \U0010ffff",
    "a" * 3000,
    "ab, " * 500,
    "!?" * 700,
]


def digest(docs, unit=alignment.UNIT):
    vocabularies = alignment.Vocabularies.read()
    found = docs.select("doc_id", alignment.align(docs, alignment.fit(docs, vocabularies, unit=unit), unit=unit).alias("f"))
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    return [(r["doc_id"], *[r["f"][n] for n in names]) for r in found.collect()]


@pytest.mark.parametrize("unit", [alignment.UNIT, 16])
def test_like_whole_texts(frame, unit):
    """Encoding in cached segments gives what encoding whole texts gives, wherever texts are cut."""
    draw = random.Random(5)
    mixed = ["".join(draw.choices("ab é,.;:!?'-_ \n\t\r \x1c1²▁ßж日", k=60)) for _ in range(300)]
    texts = [*ODD, *mixed, text_of(prose(3, 500)), text_of(prose(3, 500))]
    expected, _ = brute.alignment(texts, alignment.DIRECTORY)
    assert sorted(digest(frame(list(enumerate(texts))), unit)) == [(i, *e) for i, e in enumerate(expected)]


def test_given_tables_like_whole_texts(spark):
    rows = queries.op11_alignment(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected, _ = brute.alignment([r["text"] for r in docs], alignment.DIRECTORY)
    wanted = [(r["doc_id"], *e[:6], hashlib.sha256(e[6].encode()).hexdigest() if e[6] else "") for r, e in zip(docs, expected, strict=True)]
    assert sorted(map(tuple, rows)) == sorted(wanted)
    assert len(rows) == len(docs) and any(r["n_links"] for r in rows)


def test_pairs_and_their_bound(spark, frame):
    texts = [text_of(prose(s, 200)) for s in range(20)]
    vocabularies = alignment.Vocabularies.read()
    fitted = alignment.fit(frame(list(enumerate(texts))), vocabularies)
    _, counts = brute.alignment(texts, alignment.DIRECTORY)
    rows = fitted.pairs(spark).collect()
    assert {(r["a_id"], r["b_id"]): r["n"] for r in rows} == dict(counts)
    for a, b in counts:
        x, y = vocabularies.byte_tokens[a], vocabularies.piece_tokens[b]
        assert x.endswith(y) or y.endswith(x)
    assert len(counts) <= vocabularies.most_pairs() < 1_000_000


def test_counts_survive_forgetting(frame, monkeypatch):
    """A worker that keeps few segments counts what one that keeps all does."""
    texts = [text_of(prose(s, 150)) for s in range(12)]
    vocabularies = alignment.Vocabularies.read()
    expected, _ = brute.alignment(texts, alignment.DIRECTORY)
    monkeypatch.setattr(alignment, "KEPT", 60)
    own, pairs = alignment.Segments(vocabularies), {}
    times = np.zeros(1 << 16, np.int64)

    def flush():
        for pair, n in zip(*own.pairs(times), strict=True):
            pairs[int(pair)] = pairs.get(int(pair), 0) + int(n)
        times[:] = 0

    links = []
    for _, numbers in own.encoded(texts, 300, flush):
        np.add.at(times, numbers, 1)
        links.append(int(own.figures[numbers, 2].sum()))
    flush()
    assert len(own.groups) < 400 and links == [e[3] for e in expected]
    assert sum(pairs.values()) == sum(links)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_minimal_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 62, n))
    own = alignment.MinimalHash.build(keys)
    assert sorted(own.numbers(keys).tolist()) == list(range(len(keys)))
    assert (own.keys[own.numbers(keys)] == keys.astype(np.uint64)).all()
    # Keys that were not built in are told by the stored ones.
    assert (own.numbers(keys + 1)[~np.isin(keys + 1, keys)] == -1).all()


def test_unknown_pairs_are_refused():
    index = alignment.PairIndex([(5, alignment.MinimalHash.build(np.array([5, 66])))])
    assert sorted(index.numbers(np.array([66, 5])).tolist()) == [0, 1]
    with pytest.raises(ValueError, match="not in the index"):
        index.known(np.array([7]))
    assert index.numbers(np.array([7, 66]))[0] == -1


def test_a_worker_that_has_met_other_documents(frame):
    """Segments of other documents, or of texts that their tokens do not spell, do not disturb."""
    first = [(1, "other words here"), (2, "strange a▁b zzqx qqzj"), (3, None)]
    second = [(1, text_of(prose(8, 50))), (2, "strange a▁b zzqx qqzj")]
    for rows in (first, second, first):
        expected, _ = brute.alignment([t for _, t in rows], alignment.DIRECTORY)
        assert sorted(digest(frame(rows))) == [(k, *e) for (k, _), e in zip(rows, expected, strict=True)]


def test_documents_that_were_not_counted_are_refused(frame):
    fitted = alignment.fit(frame([(1, "some words")]))
    docs = frame([(1, "quite different ones")])
    with pytest.raises(Exception, match="has no count"):
        docs.select(alignment.align(docs, fitted)).collect()


def test_counts_add_up_as_a_tree(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 2)
    monkeypatch.setattr(alignment, "CHUNK", 7)
    pairs = spark.range(0, 5000, 1, 11).select((F.col("id") % 97).alias("pair"), F.lit(2).cast("long").alias("n"))
    index = alignment._index(pairs)
    totals = dict(zip(index.keys.tolist(), alignment._totals(pairs, index).tolist(), strict=True))
    assert totals == {p: 2 * len(range(p, 5000, 97)) for p in range(97)}


def test_odd_rows(frame, odd_rows):
    docs = frame(odd_rows, CLASHING)
    found = digest(docs)
    expected, _ = brute.alignment([t for _, t in odd_rows], alignment.DIRECTORY)
    assert sorted(map(repr, found)) == sorted(repr((k, *e)) for (k, _), e in zip(odd_rows, expected, strict=True))
    assert digest(docs.limit(0)) == []


def test_letters_of_the_cuts():
    """Cuts after the listed letters are cuts after letters and digits by Unicode's own classes."""
    for c in map(chr, range(0x250)):
        if alignment.re.match(f"[{alignment._LETTERS}]", c):
            assert unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nd"
