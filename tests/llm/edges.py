"""A small table of awkward rows: nulls, blanks, long texts, repeats, ties and columns with clashing names."""

LONG = "The thing over there and here is of no use. " * 4000
ROWS = [
    (1, "Plain words stand here. And more of them follow!", "en", 1),
    (2, None, None, 2),
    (3, "", "de", None),
    (4, " \t\n ", "de", 4),
    (5, LONG, "en", 5),
    (6, "ünïcödé 漢字 😀 don't  stop\r\n\r\nx", "fr", 6),
    (7, "x" * 3000, None, 7),
    (1, "Plain words stand here. And more of them follow!", "en", 1),
    (None, "No id at all, but words.", "en", 9),
    (8, "12345 --- !!!", "es", 10),
]
CLASH = ["ids", "decoded", "n_words", "n_tokens", "score", "lang_pred", "spans", "kept", "matches", "fingerprint"]
CLASH += ["component_id", "key", "doc", "value", "group", "statistics", "SCORE2", "a", "b", "code", "bucket"]


def edge_docs(spark, rows=ROWS):
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    for name in CLASH:
        made = made.selectExpr("*", f"'old' AS {name}")
    return made.repartition(3)


def empty_docs(spark):
    return edge_docs(spark).limit(0)
