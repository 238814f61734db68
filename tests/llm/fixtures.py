"""Documents with nulls, empty and long texts, ties, repeats and clashing columns."""

TEXTS = [
    (1, "The cat sat on the mat and then it ran off to the old red barn by the hill."),
    (2, "The cat sat on the mat and then it ran off to the old red barn by the hill."),
    (3, None),
    (4, ""),
    (4, ""),
    (5, "one two"),
    (6, "write to a.b@mail.example.com or 10.0.0.1, call +1 (706) 555-3138, pay 4111 1111 1111 1111"),
    (7, "é́😀 中文字 \n\n\t  it's  we're\r\n" * 200),
    (8, "word " * 30_000),
    (9, "x" * 70_000),
    (None, "a row without an id"),
    (10, "Released under the MIT License. The above copyright notice and this permission notice "
         "shall be included in all copies or substantial portions of the Software.\nEnd."),
    (11, " \n "),
]
# Columns that operators use themselves for what they add.
CLASHING = "doc_id long, text string, score double, ids string, bands string, spans string, n_words int, key int"


def documents(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


def clashing(spark):
    rows = [(i, t, 0.5, "ids", "b", "s", 1, 2) for i, t in TEXTS]
    return spark.createDataFrame(rows, CLASHING)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
