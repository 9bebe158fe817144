import random

import pytest

from overlake.llm import lines
from tests.llm import brute
from tests.llm.conftest import CLASHING


def kept(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_like_a_plain_pass(frame, seed):
    draw = random.Random(seed)
    pool = ["short", "a line that is long enough to count alone", "", "  ", "x", "yy", "another line of more than thirty letters", "z z"]
    docs = [(i, "\n".join(draw.choices(pool, k=draw.randint(0, 9)))) for i in range(40)]
    docs += [(100 + i, docs[draw.randrange(40)][1]) for i in range(10)]
    assert kept(lines.dedupe(frame(docs))) == brute.line_dedup(docs)
    assert kept(lines.dedupe(frame(docs), min_lines=4, min_chars=5)) == brute.line_dedup(docs, 4, 5)


def test_runs_and_their_lengths(frame):
    run = [f"line {i}" for i in range(9)]
    docs = [(1, "\n".join(["start", *run, "end"])), (2, "\n".join(["other", *run, "", "last", "line 0", "line 1"]))]
    rows = {r["doc_id"]: r for r in lines.dedupe(frame(docs)).collect()}
    assert rows[1]["line_stats"].asDict() == {"n_lines": 11, "n_deleted": 0, "n_runs": 0, "longest_copy": 0}
    assert rows[2]["text"] == "other\n\nlast"
    assert rows[2]["line_stats"].asDict() == {"n_lines": 13, "n_deleted": 11, "n_runs": 2, "longest_copy": 8}


def test_odd_rows(frame, odd_rows):
    docs = frame(odd_rows, CLASHING)
    out = lines.dedupe(docs, stats="stats")
    assert out.columns == [*docs.columns, "stats"]
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    texts = [(r["doc_id"], r["text"]) for r in rows]
    # Repeated rows are one document; the later copy 5 is emptied; null stays null.
    assert texts.count((4, odd_rows[4][1])) == 2 and (5, "") in texts and (0, None) in texts and (2, "   \n\n  ") in texts
    assert lines.dedupe(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        lines.dedupe(docs, min_lines=3)


def test_ranks_keep_suffix_order(frame):
    docs = frame([(1, "b\na\nb\na\nc"), (2, "a\nb\na")])
    own = lines.positions(lines.contents(docs, "doc_id", "text")).cache()
    levels = [x.toPandas().set_index("pos")["rank"] for x in lines.intervals(own)]
    keys = own.toPandas().set_index("pos")
    for k, level in enumerate(levels):
        suffix = {p: tuple((keys.h1[p + j], keys.h2[p + j]) for j in range(2**k)) for p in level.index}
        order = sorted(level.index, key=lambda p: (level[p], p))
        assert [suffix[p] for p in order] == sorted(suffix.values())
        assert all((suffix[p] == suffix[q]) == (level[p] == level[q]) for p in level.index for q in level.index)
