import pytest

#: Nulls, empty and long texts, ties, repeated rows, and columns whose names the operators use inside.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "one two three"), (6, "one two three"), (None, "null id here"),
    (8, "The cat. The cat sat. The cat sat on the mat.\nThe cat.\n\n"), (9, "x " * 30_000), (10, "É ß \x00 \x0b\x0c\r\n#*$%"), (11, "!!! ... 123"),
]


@pytest.fixture()
def odd(spark):
    rows = [(i, t, "en" if t else None, "s", 0, 7, 8, 9) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key long, fp long, `n.x` long")


@pytest.fixture()
def none(odd):
    return odd.limit(0)
