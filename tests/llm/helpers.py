"""Small tables the tests of the training-data operators share."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, "en", "s")[:4] if len(row) == 2 else row
        full.append((doc_id, text, lang, source, None if text is None else len(text)))
    return spark.createDataFrame(full, DOCUMENTS)


def clashing(df):
    """The same rows with extra columns named as operators name theirs."""
    from pyspark.sql import functions as F

    names = "size shard slot key bytes fp block component_id score words part ids start"
    return df.withColumns({name: F.lit("x") for name in names.split()})
