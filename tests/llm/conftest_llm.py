import pytest

LONG = " ".join(f"w{i % 997}x{i}" for i in range(40_000))
PROSE = "The quick brown fox jumps over the lazy dog while seven wizards box with jovial pygmies near the old mill. " * 3


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables into a folder, named like the driver's."""
    def write(**tables):
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(2).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, shard int, chunk int, _k bigint"


def doc(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", None if text is None else len(text), 0.1, "k", 3, 4, 5)


EDGE = [doc(1, PROSE), doc(2, PROSE), doc(2, PROSE), doc(3, None), doc(None, "no id here"), doc(4, ""), doc(5, " \n\t "),
        doc(6, LONG), doc(7, "Ünïcödé 中文 😀 <|endoftext|> it's"), doc(8, "x", None), doc(9, "12 34 !!", None), doc(None, None, None)]
OTHERS = {"labels": ([(1, 1, 0), (4, 0, 0), (2, None, 1), (None, 1, 1), (1, 1, 0)], "doc_id bigint, quality int, toxic int"),
          "benchmark": ([(1, "seven wizards box with jovial pygmies"), (1, "seven wizards box with jovial pygmies"), (2, None),
                         (None, "old mill"), (3, ""), (4, "x")], "item_id bigint, text string"),
          "pages": ([(1, "http://a.net/x", "<p>a"), (2, None, None), (None, "nothing", ""), (1, "http://a.net/x", "<p>a"),
                     (3, "https://Q.example.COM/de/" + "y" * 5000, "<div>" * 3000 + "deep")], "page_id bigint, url string, html string")}
