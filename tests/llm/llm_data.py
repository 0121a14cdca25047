"""Small tables for the operators' tests: nulls, empty and long texts, ties, repeated rows, clashing names."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, rid bigint, row string, size int"


def docs_of(spark, rows):
    """Documents from (doc_id, text, source) rows, with further columns whose names clash with the
    operators' own."""
    full = [(i, t, "en", s, None if t is None else len(t), "x", 7, "y", 3) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))

# nulls in every column, empty and blank texts, ties, repeated rows, a very long text
ODD = [
    (1, None, "a"), (2, "", None), (3, "  \n\t ", "a"), (None, "Hello there", "b"), (4, "Hello there", "b"),
    (4, "Hello there", "b"), (5, "hello THERE", None), (6, LONG, "a"), (7, LONG, "b"), (None, None, None),
    (8, "é" * 50 + " ß İ   x", "c"), (9, "a", "c"), (10, "one two three four five six", "c"),
]
