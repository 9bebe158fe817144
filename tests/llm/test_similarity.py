"""The joins: n-gram Jaccard, repeated passages, nearest neighbours, components."""

import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest

from overlake.llm import neighbours, ngram_join, passages
from overlake.llm.components import components
from tests.llm import brute
from tests.llm.conftest import CLASHING, changed, prose, text_of


def corpus(seed):
    draw = random.Random(seed)
    docs = []
    for base in range(12):
        words = prose(100 * seed + base, draw.randint(3, 200))
        for copy in range(draw.randint(1, 6)):
            docs.append((len(docs), text_of(changed(words, copy, draw.choice([0, 0.01, 0.03, 0.06])))))
    return docs


def classes(df):
    return {r["key"]: (r["class_id"], r["n_links"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_jaccard_like_all_pairs(frame, seed):
    docs = corpus(seed)
    assert classes(ngram_join.join(frame(docs))) == brute.jaccard_classes(docs)


def test_jaccard_of_a_large_group_in_deep_buckets_and_blocks(frame, monkeypatch):
    monkeypatch.setattr(ngram_join, "TASK", 16)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    words = prose(4, 150)
    docs = [(i, text_of(changed(words, i, 0.01))) for i in range(60)] + [(60 + i, text_of(prose(50 + i, 40))) for i in range(5)]
    assert classes(ngram_join.join(frame(docs))) == brute.jaccard_classes(docs)


def test_one_document_of_each_group_stays(frame, odd_rows):
    docs = frame(odd_rows, CLASHING)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    left = sorted((str(r["doc_id"]) for r in kept.collect()))
    assert left == sorted(["0", "1", "2", "3", "4", "6", "8", "9", "None", "None", "12"])
    assert ngram_join.keep_one(docs.limit(0)).count() == 0


def test_jaccard_of_odd_rows(frame, odd_rows):
    rows = ngram_join.join(frame(odd_rows, CLASHING)).collect()
    assert len(rows) == len(odd_rows)
    got = {(r["key"], r["class_id"], r["n_links"]) for r in rows}
    assert {(0, 0, 0), (1, 1, 0), (3, 3, 1), (11, 3, 1), (4, 4, 3), (5, 4, 3), (10, 4, 3), (6, 6, 1), (7, 6, 1), (None, None, 0)} <= got


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    hub = [(100, 100 + i) for i in range(0, 50)] + [(101, 140)]
    rows = components(spark.createDataFrame(chain + hub, "a long, b long")).collect()
    assert {(r["node"], r["root"]) for r in rows} == {(i, 0) for i in range(41)} | {(100 + i, 100) for i in range(50)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_compact_windows_like_the_definition():
    draw = np.random.default_rng(5)
    for _ in range(20):
        values = draw.integers(0, 9, 60).astype(np.uint64)
        got = set(zip(*[x.tolist() for x in passages.compact_windows(values, 4)], strict=True))
        expected = set()
        for c, v in enumerate(values):
            if not v:
                continue
            left, right = c, c
            while left and values[left - 1] and values[left - 1] > v:
                left -= 1
            while right + 1 < len(values) and values[right + 1] and values[right + 1] >= v:
                right += 1
            if right - left + 1 >= 4:
                expected.add((left, c, right))
        assert got == expected


@pytest.fixture(scope="module")
def passage_docs():
    shared, own = prose(11, 70), [prose(20 + i, 150) for i in range(14)]
    docs = [(i, " ".join(w[:60] + shared + w[60:])) for i, w in enumerate(own[:8])]
    docs += [(8, " ".join(own[8])), (9, " ".join(own[9] + prose(11, 40))), (10, " ".join(changed(shared[:60], 1, 0.02) + own[10]))]
    docs += [(11, " ".join(own[11])), (12, " ".join(own[11])), (13, " ".join(own[12][:100] + own[13][:60])), (14, " ".join(own[13][:60]))]
    return docs


def test_passages_like_all_windows(frame, passage_docs):
    rows = {r["key"]: r for r in passages.repeats(frame(passage_docs)).collect()}
    verbatim = brute.repeats(passage_docs)
    for key, text in passage_docs:
        r = rows[key]
        spans = {i for s in r["spans"] for i in range(s["start"], s["end"])}
        assert r["n_words"] == len(brute.words(text)) and r["n_repeated"] == len(spans)
        assert verbatim[key] <= spans
        assert bool(spans) == (key not in (8, 9))
    assert {rows[i]["class_id"] for i in (*range(8), 10)} == {0}
    assert (rows[12]["class_id"], rows[14]["class_id"], rows[8]["class_id"], rows[9]["class_id"]) == (11, 13, 8, 9)


def test_passages_of_odd_rows(frame, odd_rows):
    rows = passages.repeats(frame(odd_rows, CLASHING)).collect()
    assert len(rows) == len(odd_rows)
    got = {(r["key"], r["class_id"], r["n_repeated"] > 0) for r in rows}
    assert {(0, 0, False), (3, 3, False), (11, 11, False), (4, 4, True), (5, 4, True), (6, 6, True), (7, 6, True), (9, 9, False)} <= got
    assert passages.repeats(frame([])).count() == 0


def test_a_passage_twice_in_the_smaller_text(frame):
    shared = prose(11, 60)
    docs = [(0, " ".join(shared + prose(40, 30) + shared)), (1, " ".join(prose(41, 300) + shared + prose(42, 100)))]
    verbatim = brute.repeats(docs)
    for r in passages.repeats(frame(docs)).collect():
        assert {i for s in r["spans"] for i in range(s["start"], s["end"])} >= verbatim[r["key"]]


def tied(frame, docs, a, b):
    """Whether two texts are in one class and their verbatim repeats in spans."""
    rows = {r["key"]: r for r in passages.repeats(frame(docs)).collect()}
    verbatim = brute.repeats(docs)
    inside = all(verbatim[k] and verbatim[k] <= {i for s in rows[k]["spans"] for i in range(s["start"], s["end"])} for k in (a, b))
    return inside and rows[a]["class_id"] == rows[b]["class_id"]


def test_a_passage_among_many_texts_with_parts_of_it(frame):
    shared = prose(11, 50)
    docs = [(0, " ".join(shared + prose(60, 20))), (1, " ".join(prose(61, 900) + shared))]
    docs += [(2 + i, " ".join(prose(70 + i, 20 + 12 * i) + shared[(i % 2) * 10 :][:40] + prose(170 + i, 20))) for i in range(60)]
    assert tied(frame, docs, 0, 1)


def test_a_passage_after_parts_of_it_in_a_long_text(frame):
    shared = prose(11, 50)
    parts = [" ".join(prose(300 + i, 60) + shared[i : i + 5]) for i in range(46)]
    docs = [(0, " ".join([*parts, *prose(60, 60), *shared])), (1, " ".join(prose(61, 100) + shared)), (2, " ".join(parts)), (3, " ".join(parts[::-1]))]
    assert tied(frame, docs, 0, 1)


def test_no_text_of_a_group_is_passed_over():
    n = 9
    place = passages._pack(0, np.zeros(n, np.int64), np.arange(n), np.full(n, 60))
    columns = dict.fromkeys([f.split()[0] for f in passages.REFINED.split(", ")], np.int64(0))
    keys = pd.DataFrame(columns | {"v": np.int64(7), "tid": np.arange(n), "place": place})
    found = passages._agreeing(keys)
    member = found["pa"].to_numpy().view(np.uint64) >> np.uint64(61) == passages._MEMBER
    group = set(found["a"][member])
    met = {tuple(sorted(x)) for x in zip(found["a"][~member], found["b"][~member])}
    assert met | {(a, b) for a in group for b in group if a < b} == {(a, b) for a in range(n) for b in range(a + 1, n)}


@pytest.mark.parametrize("sides", [1, 2])
def test_a_group_is_settled_like_all_pairs(sides):
    words = prose(4, 90)
    texts = [" ".join(prose(500 + i, 30) + changed(words[i % 5 * 8 :][:60], i, 0.02) + prose(600 + i, 15 * i)) for i in range(24)]
    values, offsets = passages._shingled(pd.Series([zlib.compress(t.encode(), 1) for t in texts]))
    side = np.arange(len(texts)) % sides

    def of(links):
        """Words of each text that runs similar to others cover, and the classes."""
        inside, root = [set() for _ in texts], list(range(len(texts)))
        for i, j, *both in links:
            for t, (starts, ends) in zip((i, j), both, strict=True):
                inside[t] |= {w for x, y in zip(starts, ends, strict=True) for w in range(x, y + passages.SHINGLE - 1)}
            root = [root[i] if r == root[j] else r for r in root]
        return inside, {frozenset(k for k, r in enumerate(root) if r == of) for of in root}

    own = [values[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
    runs = [passages.runs(x) for x in own]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    verbatim = [(i, j, *(np.flatnonzero(np.isin(x, y)) for x, y in ((runs[i], runs[j]), (runs[j], runs[i])))) for i, j in pairs]
    verbatim = [(i, j, (x, x + passages.LEAST), (y, y + passages.LEAST)) for i, j, x, y in verbatim if len(x)]
    every = [(i, j, *passages.both(own[i], own[j], *passages._anchors(own[i], own[j]))) for i, j in pairs if sides == 1 or side[i] != side[j]]
    every = [link for link in every if len(link[2][0])]
    some = passages.settle(values, offsets, side)
    assert of(some + verbatim) == of(every + verbatim) and len(some) < len(every)


def listing(texts):
    return passages._listing(pd.Series([zlib.compress(t.encode(), 1) for t in texts]))


def words_and_classes(n, links):
    """Words of each of ``n`` texts that links cover, and the classes."""
    inside, root = [set() for _ in range(n)], list(range(n))
    for i, j, *both in links:
        for t, (starts, ends) in zip((i, j), both, strict=True):
            inside[t] |= {w for x, y in zip(starts, ends, strict=True) for w in range(x, y + passages.SHINGLE - 1)}
        root = [root[i] if r == root[j] else r for r in root]
    return inside, {frozenset(k for k, r in enumerate(root) if r == of) for of in root}


def mixed_up(seed):
    """Texts of one passage: with words exchanged, put in, left out or said again, parts turned round, and short lines that come back."""
    draw = random.Random(seed)
    base, line = prose(seed, 110), prose(seed + 1, 7)
    out = []
    for i in range(26):
        w = base[draw.randint(0, 20) : draw.randint(80, 110)]
        for _ in range(draw.randint(0, 4)):
            at, n = draw.randrange(len(w)), draw.randint(1, 4)
            change = draw.choice(["other", "more", "less", "again", "line", "turned"])
            if change == "turned":
                w = w[at:] + w[:at]
            else:
                put = {"other": prose(seed + 50 * i + at, n), "more": prose(seed + 70 * i + at, n), "less": [], "again": w[at - n : at], "line": line}[change]
                w = w[:at] + put + w[at + n * (change in ("other", "less")) :]
        out.append(" ".join(prose(seed + 900 + i, draw.randint(0, 30)) + w + prose(seed + 990 + i, draw.randint(0, 30)) + line * draw.randint(0, 3)))
    return out


@pytest.mark.parametrize("sides", [1, 2])
@pytest.mark.parametrize("seed", range(8))
def test_texts_that_differ_in_many_ways_are_settled_like_all_pairs(sides, seed):
    texts = mixed_up(1000 * seed)
    values, offsets, *words = listing(texts)
    n, side = len(texts), np.arange(len(texts)) % sides
    own = [values[offsets[i] : offsets[i + 1]] for i in range(n)]
    runs = [passages.runs(x) for x in own]
    pairs = [(i, j) for i in range(n) for j in range(i)]
    verbatim = [(i, j, *(np.flatnonzero(np.isin(x, y)) for x, y in ((runs[i], runs[j]), (runs[j], runs[i])))) for i, j in pairs]
    verbatim = [(i, j, (x, x + passages.LEAST), (y, y + passages.LEAST)) for i, j, x, y in verbatim if len(x)]
    every = [(i, j, *passages.both(own[i], own[j], *passages._anchors(own[i], own[j]))) for i, j in pairs if sides == 1 or side[i] != side[j]]
    every = [link for link in every if len(link[2][0])]
    whole = words_and_classes(n, every + verbatim)
    for given in (None, tuple(words)):
        assert words_and_classes(n, passages.settle(values, offsets, side, given) + verbatim) == whole
    # What is known of a text is not looked for again, all else is found.
    known = [([0], [20]) if i % 3 else ([], []) for i in range(n)]
    found = words_and_classes(n, passages.settle(values, offsets, side, tuple(words), known) + verbatim)
    for i, (got, all_) in enumerate(zip(found[0], whole[0], strict=True)):
        assert got <= all_ and all_ - got <= (set(range(20)) if i % 3 else set())
    assert found[1] == whole[1]


def test_texts_of_a_group_are_compared_only_where_a_word_can_be_added():
    base = prose(8, 300)

    def text(i):
        """Some words of the passage put as two words that no other text has."""
        draw = random.Random(i)
        return " ".join(f"{w}x{i} {w}y{i}" if draw.random() < 0.02 else w for w in base)

    texts = [text(i) for i in range(60)]
    values, offsets = passages._shingled(pd.Series([zlib.compress(t.encode(), 1) for t in texts]))
    # Of 1,770 pairs.
    assert len(passages.settle(values, offsets, np.zeros(len(texts), np.int64))) < 2 * len(texts)


def test_what_a_task_holds_does_not_grow_with_a_group(spark, monkeypatch):
    monkeypatch.setattr(passages, "BLOCK", 8)
    members = spark.range(600).selectExpr("7L AS unit", "id AS tid").unionByName(spark.createDataFrame([(9, 1), (9, 2)], "unit long, tid long"))
    dealt = passages._dealt(members)[0].toPandas()
    assert dealt.groupby("task").size().max() <= 200
    # Each two texts of a unit meet in a task, within the same pair of blocks.
    met = {(u, *pair) for (u, _, _), g in dealt.groupby(["unit", "i", "j"]) for pair in itertools.combinations(sorted(g["tid"]), 2)}
    assert met == {(9, 1, 2)} | {(7, *pair) for pair in itertools.combinations(range(600), 2)}


def test_what_settling_holds_does_not_grow_with_repeats_in_a_text():
    line = prose(3, 60)
    texts = [" ".join(w for k in range(60) for w in (*line, f"u{i}x{k}")) for i in range(30)]
    values, offsets = passages._shingled(pd.Series([zlib.compress(t.encode(), 1) for t in texts]))
    tracemalloc.start()
    passages.settle(values, offsets, np.zeros(len(texts), np.int64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Every place of a text with every place of all others is 6 million numbers.
    assert peak < 100 << 20


def test_near_copies_share_enough_hashes():
    n, p = passages.HASHES, passages.SIMILARITY
    assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(passages.ENOUGH, n + 1)) >= 0.99


def test_no_window_of_a_task_is_left_out():
    shared = prose(11, 70)
    texts = pd.DataFrame({"tid": range(9), "text": [" ".join(shared + prose(30 + i, 40 * i)) for i in range(9)]})
    together, alone = pd.concat(passages._windows(iter([texts]))), [pd.concat(passages._windows(iter([texts[i : i + 1]]))) for i in range(9)]
    assert set(zip(together["v"], together["tid"])) == {x for f in alone for x in zip(f["v"], f["tid"])}


def brute_nearest(vectors, k):
    out = {}
    for q, v in vectors:
        if q % 50 == 0:
            scores = [(-np.dot(v, w) / np.sqrt(np.dot(v, v) * np.dot(w, w)), i) for i, w in vectors if i != q]
            out[q] = [i for _, i in sorted(scores)[:k]]
    return out


def test_neighbours_recall(spark):
    draw = np.random.default_rng(6)
    vectors = [(i, draw.normal(size=16)) for i in range(6000)]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in vectors], "vec_id long, embedding array<double>")
    own = neighbours.valid(rows, "vec_id", "embedding").cache()
    share = neighbours.fit_share(own, 5)
    assert share < 0.7
    found = neighbours.search(neighbours.build(own, 2000), own.where("id % 50 = 0"), 5, share).collect()
    true = brute_nearest(vectors, 5)
    hits = sum(r["vec_id"] in true[r["query_id"]] for r in found)
    assert len(found) == 600 and hits / 600 >= 0.9
    assert all(r["rank"] in range(1, 6) for r in found)


def test_neighbours_of_very_large_and_small_components(spark):
    rows = [
        (0, [1e-200, 0.0]), (1, [1e200, 1e200]), (2, [3.0, 4.0]), (3, [5e-324, 0.0]), (4, [1e308, -1e308]), (5, [-1e-300, 1e-300]),
        (50, [1e200, 1e-200]),
    ]
    own = neighbours.valid(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    found = neighbours.search(neighbours.build(own), own.where("id % 50 = 0"), 6, 1.0).collect()
    half = 0.5**0.5
    expected = [(3, 1.0), (1, half), (4, half), (2, 0.6), (5, -half)]
    got = {q: [(r["vec_id"], round(r["score"], 9)) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 50)}
    assert got[0] == [(v, round(s, 9)) for v, s in [(3, 1.0), (50, 1.0), *expected[1:]]]
    assert got[50] == [(v, round(s, 9)) for v, s in [(0, 1.0), *expected]]


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.5, 0.5]), (3, [3.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]),
        (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (50, [1.0, 2.0, 3.0]), (100, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]),
    ]
    own = neighbours.valid(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    found = neighbours.search(neighbours.build(own), own.where("id % 50 = 0"), 5, 1.0)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in found.collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 3, 1.0), (0, 3, 2, 0.707107), (50, 1, 100, 1.0), (100, 1, 50, 1.0)]
    empty = own.limit(0)
    assert neighbours.search(neighbours.build(empty), empty, 5, neighbours.fit_share(empty, 5)).count() == 0
