"""Small document tables with the cases every operator must stand."""

PLAIN = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASHING = ", d string, tag string, k1 string, k2 string, spans string, row string, row_key string, fp string, value string, host string"


def documents(spark, texts, extra=False):
    """A table of (doc_id, text) or (doc_id, text, source) rows."""
    rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "h", None if r[1] is None else len(r[1])) for r in texts]
    if extra:
        rows = [(*r, *[f"x{i}" for i in range(10)]) for r in rows]
    return spark.createDataFrame(rows, PLAIN + CLASHING * extra)


LONG = " ".join(f"word{i % 977} and {i}" for i in range(30_000))
EDGES = [(1, "plain words here"), (1, "plain words here"), (None, "no id at all"), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (None, None), (6, "ÉÜß 日本 😀 end")]
