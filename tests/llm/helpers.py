"""Small tables for the operators' edge cases."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, kept string, to int, h string, score string"


def docs(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang); extra columns bear names that operators use themselves."""
    full = [(*r, None)[:3] for r in rows]
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), 7, "x", 3, "h", "y") for i, t, lang in full], DOCS)


def written(spark, df, tmp_path, name="documents"):
    df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


EDGES = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two"), (6, "a b c d e f g"), (6, "a b c d e f g"), (7, "A B C D E F G"), (None, "a b c d e f g"), (None, "zz yy xx ww vv"), (8, "é" * 500), (9, "x y " * 4000), (10, "<|endoftext|> 123 don't\r\n\u2003end")]
