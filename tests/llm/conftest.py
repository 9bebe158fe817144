import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n):
    """``n`` invented words, some frequent."""
    draw = random.Random(seed)
    parts = ["ta", "ri", "mon", "é", "lus", "der", "an", "ko", "shi", "ü"]
    common = ["the", "of", "and", "to", "in"]
    return [draw.choice(common) if draw.random() < 0.3 else "".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(n)]


def text_of(words, per_line=12):
    return "\n".join(" ".join(words[i : i + per_line]) for i in range(0, len(words), per_line))


def changed(words, seed, share):
    draw = random.Random(seed)
    return [w + "x" if draw.random() < share else w for w in words]


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text) pairs."""

    def make(rows, extra=()):
        full = [(k, t, "en", "s", None if t is None else len(t), *[0] * len(extra)) for k, t in rows]
        return spark.createDataFrame(full, ", ".join([COLUMNS, *[f"{c} int" for c in extra]]))

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    base = prose(1, 120)
    long = prose(2, 30_000)
    return [
        (0, None),
        (1, ""),
        (2, "   \n\n  "),
        (3, "one"),
        (4, text_of(base)),
        (4, text_of(base)),
        (5, text_of(base)),
        (6, text_of(long)),
        (7, text_of(changed(long, 3, 0.005))),
        (8, "!!! ??? ..."),
        (9, " ".join(["same"] * 400)),
        (10, text_of(changed(base, 4, 0.02))),
        (11, "one"),
        (None, text_of(prose(5, 80))),
        (None, None),
        (12, "😀 " * 50 + "é" * 10),
    ]


#: Names that operators use inside or return.
CLASHING = ("score", "key", "_row", "blob", "found", "c1", "cls", "line_stats", "_kept", "tid", "label", "_about", "places")
