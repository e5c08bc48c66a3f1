"""Small tables with the awkward cases that every operator must take."""

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names clash with those that the operators use inside or return.
EXTRA = "row bigint, n_words string, text_hash int, key string, `Doc Id` int, size string, taken array<int>, lines string"


def awkward(spark, texts=(), extra=False):
    """Rows with nulls in any column, empty and blank texts, a very long one, ties and repeated rows; then ``texts``."""
    long_text = "\n".join(" ".join(f"w{(i * 7 + j * j) % 997}" for j in range(60)) for i in range(300))
    rows = [
        (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \n\t\n", "en", None, 4), (4, "one", "en", "b", 3),
        (5, "one", "en", "b", 3), (5, "one", "en", "b", 3), (None, "no id here", "en", "b", 10), (None, "no id here", "en", "b", 10),
        (6, long_text, "de", "c", len(long_text)), (7, "x y z", "de", "c", 5), (7, "another text", "de", "c", 12),
        (8, "größe ÄÖ   漢字 \U0001f600", "de", "c", 18), (9, "<|endoftext|> 12 ids", None, None, 20), (-3, "minus", "fr", "", 5),
    ] + [(100 + i, t, "en", "t", len(t)) for i, t in enumerate(texts)]
    if not extra:
        return spark.createDataFrame(rows, COLUMNS)
    return spark.createDataFrame([(*r, 1, "x", 2, "k", 3, "s", [1], "l") for r in rows], f"{COLUMNS}, {EXTRA}")


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
