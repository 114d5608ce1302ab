import re

import pytest

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.fixture(scope="session")
def words_of():
    """Words of a text by the plain rule."""
    return lambda text: _WORD.findall(re.sub("[A-Z]", lambda match: match[0].lower(), text or ""))


AWKWARD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, "...", "en", "a"),
    (4, "one", None, "a"),
    (4, "one", None, "a"),
    (5, "One, two THREE four five six seven", "en", "a"),
    (6, "one two three four five six seven", "fr", "b"),
    (7, "Ünï çödé 日本語テキスト 🎉 <|endoftext|> x\x00y", "de", "b"),
    (None, "no id here at all, none", "en", "b"),
    (None, None, "en", None),
    (8, "long " * 40_000, "en", "a"),
    (9, "x" * 100_000, "en", "a"),
    (9, "same id, other text", "en", "a"),
    (2**63 - 1, "the largest id there is", "en", "c"),
    (-5, "a negative id", "es", "c"),
]


@pytest.fixture
def awkward(spark):
    """Documents with nulls, empty, long and repeated texts, repeated ids, and columns that clash with results."""
    names = "score lang_pred predicted n_hit n_words contaminated n_tokens ids size shard slot range guest key node __key".split()
    rows = [(*row, *[f"kept-{name}" for name in names]) for row in AWKWARD]
    schema = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"{name} string" for name in names)
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def nothing(awkward):
    return awkward.limit(0)
