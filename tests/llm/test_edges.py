"""Nulls, empty and very long texts, repeats, empty tables and clashing column names, for every query and stage."""

import zlib

import pytest
from conftest_llm import DOCS, EDGE, OTHERS

import corpus_pipeline
from stratalake.llm import decontaminate, html_text, language, quality, substrings
from stratalake.llm.common import stored
from stratalake.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_on_odd_rows(spark, folder, name):
    rows = QUERIES[name](spark, folder(documents=(EDGE, DOCS), **OTHERS)).collect()
    if name in ("op11_collocations", "op13_variants"):  # rows of phrases and words; test_words.py has their values
        assert (name == "op11_collocations") == (rows == [])
        return
    key = "page_id" if "page_id" in rows[0].asDict() else "doc_id"
    want = OTHERS["pages"][0] if key == "page_id" else EDGE
    if name != "op9_packing":
        assert sorted(str(r[key]) for r in rows) == sorted(str(r[0]) for r in want)
    else:
        assert {r[key] for r in rows} == {r[0] for r in want}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_on_empty_tables(spark, folder, name):
    empty = {k: ([], schema) for k, (_, schema) in OTHERS.items()}
    assert QUERIES[name](spark, folder(documents=([], DOCS), **empty)).collect() == []


@pytest.mark.parametrize("rows", [EDGE, []], ids=["odd", "empty"])
def test_stages(spark, folder, rows):
    sf = folder(documents=(rows, DOCS), **(OTHERS if rows else {k: ([], s) for k, (_, s) in OTHERS.items()}))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.count(), stored(stage(spark, docs, sf))
        assert docs.columns == columns, name
        assert docs.count() <= before
    corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()


def test_columns_named_like_results_give_way(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", -1, "y", "z", 0.5, "c", "i")],
                                 "doc_id int, text string, kept string, n_words int, chunk string, spans string, score double, _chunk string, items string")
    done = substrings.remove_repeats(docs).first()
    assert (done["kept"], done["n_words"], done["chunk"]) == ("a b c", 3, "y")
    found = decontaminate.benchmark_hits(docs, spark.createDataFrame([(7, "b c")], "item_id int, text string")).first()
    assert (found["n_words"], found["items"], found["kept"]) == (3, ["7"], "x")
    assert quality.score(docs, None, docs.columns).first()["score"] == 0.5
    pages = spark.createDataFrame([("<p>a", "b", 1)], "html string, text string, others int")
    assert html_text.extract(pages).first().asDict() == {"text": "a", "others": 1}


def test_numbers_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "\u00bd \u00b2 12"), (2, "\u03b1")], "doc_id int, text string")
    got = {r["doc_id"]: r["best"] for r in language.identify(docs, {"el": "\u03b1\u03b2".encode()}).collect()}
    assert got == {1: "und", 2: "el"}


def test_dictionaries_take_whole_texts_once(spark):
    opening = "same licence line in front of each document " * 20
    rows = [(k, opening + f"körper{k}", "de") for k in range(40)] + [(100 + k, "twice the same text", "en") for k in range(9)]
    docs = spark.createDataFrame([*rows, (None, "without id", "fr"), (None, "without id", "fr")], "doc_id bigint, text string, lang string")
    found = language.dictionaries(docs)
    learned = [k for k in range(40) if zlib.crc32(str(k).encode()) % 3 != 1]
    assert all(f"körper{k}".encode() in found["de"].split() for k in learned) and found["de"].count(b"\n") == len(learned) - 1
    assert found["en"] == b"twice the same text" and found["fr"] == b"without id"
    short = language.dictionaries(docs, size=2_000)["de"]
    assert len(short) == 2_000 and short == found["de"][:2_000]
    assert language.dictionaries(docs, docs_each=3)["de"] == b"\n".join(found["de"].split(b"\n")[:3])
