import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, row int, `key` string, n int, label int"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows, and names that operators use themselves."""
    long = " ".join(f"word{i % 997} and {i}." for i in range(60_000))
    same = "one two three four five six seven eight nine ten\nsecond line here\nthird line there\nfourth"
    rows = [
        (1, same), (2, same), (3, None), (4, ""), (5, " \n\t "), (6, long), (7, "…!? 123 ---"), (8, "Straße  groß  x"),
        (9, same + " eleven"), (9, same + " eleven"), (None, same), (None, None), (10, "a"), (11, "\n\n\nonly\n\n"),
        (12, "x" * 300_000), (13, "<|endoftext|> marks  an   end"),
    ]
    return spark.createDataFrame(
        [(i, t, None if i == 3 else "en", None if i in (3, 6) else "s", None if t is None else len(t), "i", 1, "k", 2, 3)
         for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
