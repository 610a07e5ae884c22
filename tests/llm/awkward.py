"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
TEXTS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta\nSame long line here\nlast one"),
    (2, "  same LONG line here\t\nother text of the second document is this"),
    (2, "  same LONG line here\t\nother text of the second document is this"),
    (3, ""), (4, None), (None, "same long line here\nnobody owns this row"), (5, "  \n\t "),
    (6, LONG), (7, "one two"), (8, "one two"), (9, "ÄÖ ß 日本 𝄞 ▁ ​ \\ <|x|> | $$$ 1d10t"), (2, "a second text under the id two and more words"),
]
CLASHES = ("n_lines", "n_dropped", "score", "label", "node", "component_id", "ids", "h", "n", "words", "sig", "rule", "_host", "lead")


def awkward_docs(spark):
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "src0", None) for k, (i, t) in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def empty_docs(spark):
    return awkward_docs(spark).where("false")
