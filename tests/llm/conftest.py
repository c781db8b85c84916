import random

import pytest

WORDS = {
    "en": "the of and a in to is was it for with on as by at from that this river stone house garden winter morning people water",
    "de": "der die das und den von zu mit sich des auf ist im dem nicht ein eine als fluss stein haus garten winter morgen leute wasser",
}
EDGE_DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, score string, kept string, _row int"


def sentence(seed: int, n: int, lang: str = "en") -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty, blank, tiny and very long texts, repeated rows, and columns with clashing names."""
    long = sentence(5, 30_000)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "one", "en", "b"), (5, long, "en", "b"),
        (6, sentence(1, 80), "en", "b"), (6, sentence(1, 80), "en", "b"), (None, sentence(1, 80), "en", "c"), (None, None, None, None),
        (7, sentence(1, 79) + " ende", "de", "c"), (8, sentence(2, 60, "de"), "de", None), (9, "12345 !!! ???", None, "c"),
        (10, sentence(3, 60), None, "a"), (11, "Ünïcode\u00a0ÄÖ 日本語 \U0001f600 " + sentence(4, 20), "en", "a"),
    ]
    full = [(i, t, lang, s, None if t is None else len(t), "x", "y", "z", 1) for i, t, lang, s in rows]
    return spark.createDataFrame(full, EDGE_DDL)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_DDL)
