import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = (
    "It was the season of rain and the river rose slowly over the lower fields. Nobody in the village remembered such a "
    "spring, though the old miller claimed that his grandfather had once rowed a boat to church.\n"
)


@pytest.fixture(scope="session")
def rows():
    """Nulls in every column, an empty and a long text, ties, repeated rows, odd spaces and letters."""
    long = " ".join(f"word{i * 7919 % 5003} line{i % 13}" for i in range(9000))
    texts = [
        PROSE * 3, PROSE * 3, PROSE * 3 + "And so it ended.", "", None, "one", "two words", long, long + " tail",
        "a b c d e f g h i j k l", "ÀÉÎ ñandú größe Straße\x1fx İstanbul ΑΣ", "x" * 5000, "tab\tand\x0bfeed\x0c\r\n\n\nlines\nlines\nlines",
        'token = "0123456789abcdef0123456789abcdef01234567" and password: hunter2hunter2hunter2',
        "Released under the MIT License. " + PROSE, None, "   \n\t ", "émile, été. Fin... \"(quoted).\" it's 42,5 <|endoftext|> <|ENDOFTEXT|>",
    ]
    made = [(i, t, "en" if i % 2 else None, None if i % 5 == 4 else f"src{i % 3}", None) for i, t in enumerate(texts)]
    return made + [made[0], (None, PROSE, None, None, 7), (None, None, None, None, None), (3, "", "de", "src1", 0)]


@pytest.fixture(scope="session")
def documents(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
