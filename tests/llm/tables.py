"""Small awkward tables shared by the tests of this folder."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 997}" for i in range(30_000))


def awkward_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, further columns with clashing names."""
    rows = [(1, "the cat sat on the mat and then it sat again", "en", "a", 44), (1, "the cat sat on the mat and then it sat again", "en", "a", 44),
            (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \n\t ", "en", "b", 4), (5, LONG, "de", "a", len(LONG)),
            (6, LONG, "de", None, len(LONG)), (7, "THE CAT SAT ON THE MAT AND THEN IT SAT AGAIN", "en", "a", 44), (None, "lonely words here", "fr", "c", 17),
            (None, None, None, None, None), (9, "é ﬁ 漢字 ▁ 😀  x  y   z\r\n\x0b", "xx", "a", 20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.withColumns({name: F.lit("clash") for name in ("id", "raw", "fp", "root", "size", "shard", "tokens", "kept", "score", "batch")})


def empty_documents(spark):
    return awkward_documents(spark).limit(0)


def write(df, folder, name="documents"):
    df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
