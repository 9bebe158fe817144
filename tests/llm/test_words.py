import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from overlake.llm.words import Words, chunks, encode, shingles
from tests.llm import brute


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZ09 .é\n-\x7f😀", max_size=30), max_size=6))
def test_words_and_shingles_like_the_definition(texts):
    words = Words([encode(t) for t in texts])
    expected = [brute.words(t) for t in texts]
    assert words.counts.tolist() == [len(w) for w in expected]
    hashed = words.hashes()
    known = {}
    for w, h in zip([x for t in expected for x in t], hashed.tolist(), strict=True):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    own, where = shingles(hashed, words.offsets)
    for i, w in enumerate(expected):
        runs = [tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))] if w else []
        assert where[i + 1] - where[i] == len(runs)
        assert len(set(own[where[i] : where[i + 1]].tolist())) == len(set(runs))


def test_prefix_hashes():
    words = Words([b"lower lowest low"])
    h = words.hashes(3)
    assert h[0] == h[1] == h[2] and len(set(words.hashes().tolist())) == 3


def test_chunks_keep_order_and_bound():
    texts = ["a" * 10, None, "", "b" * 50, "c"]
    got = [(i, b) for first, held in chunks(texts, 20) for i, b in enumerate(held, first)]
    assert [b for _, b in got] == [encode(t) for t in texts] and [i for i, _ in got] == list(range(5))
    assert np.array_equal([len(h) for _, h in chunks(texts, 20)], [4, 1])
