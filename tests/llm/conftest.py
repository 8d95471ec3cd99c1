from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd(spark):
    """Documents with nulls, empty and blank texts, repeated rows, one very long text and clashing columns."""
    r = random.Random(5)
    words = ["the", "and", "réeux", "Straße", "12", "x1", "don't", "日本", "ab|c", "..."]
    long = " ".join(r.choice(words) + str(r.randrange(50)) for _ in range(30_000))
    rows = [
        (1, "one two three four five", "en", "a", 23), (1, "one two three four five", "en", "a", 23),
        (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \t\n ", "de", "b", 4),
        (None, "one two three four five", "en", None, 23), (5, long, "en", "a", len(long)),
        (6, "w" * 50_000, "de", "b", 50_000), (7, "line\nline\n\nline two", "fr", "c", 19),
    ]
    df = spark.createDataFrame(rows, DOCUMENTS)
    for name in ("n_words", "fp", "kept", "token_ids", "score", "shard", "changes", "row", "place", "block"):
        df = df.selectExpr("*", f"'own' AS {name}")
    return df


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def prose(spark):
    """A function: documents of invented words in four languages, some of them near copies."""
    syllables = {
        "en": "the ing tion and er on is of", "de": "der ung sch ein lich keit und ver",
        "fr": "le eau que ment oux des tre ez", "es": "el ado ción los ar osa mente ijo",
    }

    def make(n, seed=1):
        r, rows = random.Random(seed), []
        for i in range(n):
            lang = r.choice(sorted(syllables))
            s = syllables[lang].split()
            text = " ".join("".join(r.choice(s) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(5, 200)))
            if rows and r.random() < 0.3:
                _, text, lang, *_ = r.choice(rows)
                text += r.choice(["", " the", " end of it"])
            rows.append((i, text, lang, f"src{min(int(r.expovariate(1)), 4)}", len(text)))
        return spark.createDataFrame(rows, DOCUMENTS)

    return make
