import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, blanks, repeats, odd white space, long words and texts."""
    line = "the same line is here again and again for all"
    return [
        None, "", " \t\r\n\x0b\x0c ", "one", "One TWO", "a b c", line, line, f"{line}\n{line}\n\n{line} \n{line}", "x" * 70_000,
        " ".join(f"w{i % 900}" for i in range(30_000)), "Äpfel und Öl \u0085 ΣΑΣ ß İi é", "a  b\x00c\x1fd", "\n\n\nx\n\nx\n", "word " * 40, "ab" * 5 + " " + "cd",
        " ".join("ababab"), "𝔘nicode 𝟘𝟙 end.", "1 2 3 4 5 6 7 8 1 2 3 4 5 6 7 8 9",
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_texts):
    rows = [(i, t, ["en", "de", None][i % 3], ["a", None, "b", "ä"][i % 4], len(t) if t else None) for i, t in enumerate(odd_texts)]
    return spark.createDataFrame([*rows, rows[3], rows[3], (None, "a row without id", None, None, None), (None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
