"""Rows that every operator has to stand: nulls, empties, ties, repetitions, clashing names."""

AWKWARD = [
    (1, "A plain text of a few words, nothing more."),
    (2, None),
    (3, ""),
    (4, "  \n\t "),
    (5, "12 34 !? --"),
    (6, "A plain text of a few words, nothing more."),
    (1, "A plain text of a few words, nothing more."),
    (None, "a text without an id"),
    (7, "long " * 20000),
    (8, "x" * 5000),
]
DOCS = "doc_id long, text string"
# Names that operators use inside or add themselves.
CLASHING = ("k", "node", "score", "n", "label", "lang_pred", "ids", "band", "t", "i", "evidence")


def awkward(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(AWKWARD, DOCS)
    return rows.select("*", *(F.lit(None).cast("string").alias(c) for c in CLASHING))


def empty(spark):
    return spark.createDataFrame([], DOCS)
