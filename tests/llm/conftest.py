import pytest

ROWS = [
    (1, "The cat sat on the mat.\nA line that many documents share here.\nIt is over.", "en", "src0"),
    (2, "Other words here!\n  a LINE that many documents share here. \nAnd more, it's done.", "en", "src1"),
    (3, "a line that many documents share here.", "en", "src0"),
    (4, None, "en", "src0"),
    (5, "", None, None),
    (6, " \t\n\n \x0b\x0c\r", "de", "src2"),
    (7, "Größe ÉCOLE ŒUVRE ﬁ ½ naïve café 日本語 テスト 😀 مرحبا Ω ǅ ́e x\x1cy\x85z", "de", "src2"),
    (8, "word " * 30, "en", "src1"),
    (8, "word " * 30, "en", "src1"),
    (None, "no id but a line that many documents share here.\na line that many documents share here.", "en", "src3"),
    (9, "<|endoftext|> special <|startoftext|>text<|endoftext|>", "fr", "src0"),
    (10, "x" * 5000 + " " + "long text of many words, " * 3000, "fr", "src0"),
    (11, "▁odd ▁▁ marks #*$%&|<> 12345 \n\n12", "fr", "src4"),
]
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, special strings and scripts."""
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
