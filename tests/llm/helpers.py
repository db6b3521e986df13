import uuid

from detour.session import fresh_path

SMALL = "/root/testdata/sf0.001"


def table(spark, rows, schema, parts=3):
    """Rows written as Parquet and read back, as the operators get them."""
    path = fresh_path(spark, "test-tables", uuid.uuid4().hex)
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def doc(i, text):
    return (i, text, "en", "s", None if text is None else len(text))


# Nulls, empty and very long texts, ties, repeated rows, no words, no spaces, other scripts.
ODD_TEXTS = [None, "", " ", "\n\n", "!!! ???", "one", "the the the the the the the the the the the the",
             "a b c d", "Ünïcode Wörter größer als ASCII, é, è… ×÷ 日本語", "x" * 3000, "word " * 5000,
             "it's don't 's we'll", "a b c d", "tab\tnew\r\nline  double  space ", "<|endoftext|> plain", "\x1c\x1f odd", "12,3.4a b__c-d"]


def odd_docs(spark, extra=()):
    rows = [doc(i, t) for i, t in enumerate(ODD_TEXTS)] + [doc(None, "no id"), doc(3, "same id"), doc(7, "a b c d")]
    return table(spark, rows + list(extra), DOCS)


def clashing(docs, *names):
    """``docs`` with columns called like those that operators add."""
    for n in names:
        docs = docs.selectExpr("*", f"lang as `{n}`")
    return docs


def reread(spark, df):
    path = fresh_path(spark, "test-tables", uuid.uuid4().hex)
    df.write.parquet(path)
    return spark.read.parquet(path)
