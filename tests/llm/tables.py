"""Small tables for the text operators, with the cases that every operator has to stand."""

from __future__ import annotations

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns named like those that operators make for themselves.
CLASHING = ", key int, bucket int, id string, row int, score double, host string, group int"

PROSE = "the cat sat on the mat and then it went to sleep under the old oak tree by the river where nobody goes"


def documents(spark, extra: bool = True):
    """Nulls in every column, empty and very long texts, repeated rows and ties."""
    rows = [
        (1, PROSE, "en", "a", 100), (2, PROSE, "en", "a", 100), (3, PROSE + " now", "en", "b", 104),
        (4, None, None, None, None), (5, "", "en", "a", 0), (5, "", "en", "a", 0), (None, "a lonely text", "en", "b", 13),
        (6, " \n\t ", "en", "c", 4), (7, "word " * 30_000, "en", "a", 150_000), (8, "one two", "en", "a", 7),
        (9, "naïve 😀 ﬁn \u2028 'tis don't", "fr", "b", 20), (10, PROSE.replace("oak", "elm"), "en", "a", 100),
    ]
    rows = [r + (1, 2, "x", 3, 0.5, "y", 4) for r in rows] if extra else rows
    return spark.createDataFrame(rows, DOCUMENTS + (CLASHING if extra else ""))
