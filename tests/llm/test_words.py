"""Phrases, token ids and spelling variants against plain Python versions, and under settings that force every path."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from conftest_llm import DOCS, EDGE, OTHERS
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from stratalake.llm import byte_bpe, collocations, variants
from stratalake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OURS = byte_bpe.WordIds(byte_bpe.Vocabulary(open(PATH, encoding="utf-8").read()))


@pytest.fixture(params=["sf", "odd", "empty"])
def sf_dir(request, folder):
    rows = {"odd": EDGE, "empty": []}
    return SF if request.param == "sf" else folder(documents=(rows[request.param], DOCS), **OTHERS)


def texts(spark, sf):
    return [(r["doc_id"], r["lang"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


# Token ids

def ids(text):
    return np.frombuffer(OURS.encode(text), "<u4").tolist()


def test_ids_and_texts_equal_the_library(spark, sf_dir):
    want = Counter()
    for doc_id, _, text in texts(spark, sf_dir):
        found = LIBRARY.encode(text, add_special_tokens=False).ids
        back = LIBRARY.decode(found, skip_special_tokens=False)
        assert back == text
        want[doc_id, len(found), hashlib.sha256(np.array(found, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    got = QUERIES["op12_bpe"](spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "a<|endoftext|>b", "<|endoftext|><|endoftext|> <|endoftext|", "  two  spaces \t\n\n x", "it's WE'LL 'sx", "Ᲊᲊ new letters \U0001e5f8",
    "\U0002ebf0世界՘", "é‍\U0001f468‍\U0001f469 \x85\xa0　."])
def test_ids_of_odd_texts(text):
    assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("word", ["a" * 3000, "ab" * 400, "supercalifragilistic" * 40, "é" * 500, "!?" * 300, "xyzzy" * 51 + "q"])
def test_long_words_merge_like_short_ones(word):
    v = OURS.vocabulary
    parts = [v.id_of_byte[b] for b in word.encode()]
    assert v.merge_short(list(parts)) == v.merge_long(list(parts)) == LIBRARY.encode(word, add_special_tokens=False).ids


def test_decoding_of_any_ids(spark):
    rows = [(1, np.array([50256, 262], "<u4").tobytes()), (2, np.array([OURS.vocabulary.id_of_byte[0xC3]], "<u4").tobytes()), (3, None), (4, b"")]
    got = {r["doc_id"]: r["text"] for r in byte_bpe.decode(spark.createDataFrame(rows, "doc_id int, ids binary")).collect()}
    assert got == {1: "<|endoftext|> the", 2: "�", 3: "", 4: ""}


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 10)
    small = byte_bpe.WordIds(OURS.vocabulary)
    text = " ".join(f"word{k}" for k in range(100))
    assert small.encode(text) == OURS.encode(text) and len(small) <= 10


# Phrases

def counted(rows, support, longest):
    found, totals = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            found.update((lang, " ".join(words[i:i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    return {(lang, totals[lang], phrase, f) for (lang, phrase), f in found.items() if f >= support}


@pytest.mark.parametrize("limits", [{}, {"shard_bytes": 20_000}, {"shard_bytes": 3_000}, {"shard_bytes": 20_000, "broadcast_rows": 0}],
                         ids=["one shard", "shards", "thresholds of one", "no broadcast"])
@pytest.mark.parametrize("support", [20, 3])
def test_frequencies(spark, limits, support):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = collocations.frequencies(docs, support=support, longest=4, **limits).collect()
    assert len(got) == len(set(got))
    assert {(r["lang"], r["n"], r["phrase"], r["f"]) for r in got} == counted(texts(spark, SF), support, 4)


def test_frequencies_of_odd_rows(spark, folder):
    sf = folder(documents=(EDGE, DOCS), **OTHERS)
    got = collocations.frequencies(spark.read.parquet(f"{sf}/documents.parquet"), support=2).collect()
    assert {(r["lang"], r["n"], r["phrase"], r["f"]) for r in got} == counted(texts(spark, sf), 2, 5)


@pytest.mark.parametrize("bucket_rows", [500, 20_000])
def test_frequencies_of_many_buckets_and_parts(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(collocations, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(collocations, "LEAST_ROWS", 200)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = [(None, r["lang"], r["text"] or "") for r in docs.collect()]
    got = collocations.frequencies(spark.createDataFrame([r[1:] for r in rows], "lang string, text string"), support=4, broadcast_rows=300).collect()
    assert {(r["lang"], r["n"], r["phrase"], r["f"]) for r in got} == counted(rows, 4, 5)


def test_many_shards_do_not_send_rare_phrases(spark, monkeypatch):
    """Shards far more than the support: what is kept on the way must follow the frequent phrases, not the text."""
    kept, stored = [], collocations.stored

    def counting(df):
        kept.append((out := stored(df)).count())
        return out

    monkeypatch.setattr(collocations, "stored", counting)
    rows = [("en", " ".join(f"w{d}x{k}" for k in range(40)) + ". a b c") for d in range(200)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = collocations.frequencies(docs, support=100, shard_bytes=300).collect()
    assert {(r["n"], r["phrase"], r["f"]) for r in got} == {(200 * 43, p, 200) for p in ("a", "b", "c", "a b", "b c", "a b c")}
    assert sum(kept) < 100


def test_codes_are_found_and_undone():
    codes = np.unique(np.random.default_rng(3).integers(0, 2**62, 5000).astype(np.uint64))
    mixed = collocations.mixed(codes)
    assert (collocations.unmixed(mixed) == codes).all() and len(np.unique(mixed)) == len(codes)
    given = np.sort(mixed[::2])
    at = collocations.positions(given, mixed)
    assert (given[at[::2]] == mixed[::2]).all() and (at[1::2] == -1).all()
    assert collocations.positions(given[:0], mixed).tolist() == [-1] * len(mixed)
    ends = np.array([0, 2**64 - 1], np.uint64)
    assert collocations.positions(ends, np.append(ends, mixed[:3])).tolist() == [0, 1, -1, -1, -1]


def test_encoded_rows_part_no_phrase(monkeypatch):
    class Part:
        value = {"en": (pa.array([b"a", b"b", b"c"], pa.large_binary()), np.arange(3, dtype=np.int32))}

    monkeypatch.setattr(collocations, "ROW_WORDS", 4)
    texts = ["a b c a b", "x y a", "a  b\tc;a", "", "a b c a b c a"]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 5 + ["de"]), pa.array([t.encode() for t in [*texts, "a b"]], pa.binary())], names=["lang", "text"])
    rows = [np.frombuffer(x, "<i4").tolist() for b in collocations._encode([Part()], 10**6, [batch]) for x in b.column("at").to_pylist()]
    assert all(r[-1] == -1 for r in rows) and len(rows) > 2
    assert sum(rows, []) == [0, 1, 2, 0, 1, -1, 0, -1, 0, 1, 2, -1, 0, -1, 0, 1, 2, 0, 1, 2, 0, -1]


def test_pieces_part_phrases_and_overlaps_count(spark):
    docs = spark.createDataFrame([("x y. x\ty, x  y\nx;y a a a a", None), (None, None), ("\x1cx\x1dy  z", "de")], "text string, lang string")
    got = {(r["lang"], r["phrase"]): r["f"] for r in collocations.frequencies(docs, support=1).collect()}
    assert got["und", "x y"] == 3 and got["und", "a a"] == 3 and got["und", "a a a"] == 2 and ("und", "y x") not in got
    assert got["de", "\x1cx\x1dy  z"] == 1


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**13
    rows = [("en", 2 * big, "a", 1, big), ("en", 2 * big, "b", 1, big - 7), ("en", 2 * big, "a b", 2, big - 9)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, n bigint, phrase string, length int, f bigint")).collect()
    assert [(r["score"], r["l"], r["r"]) for r in got] == [(1000 * (big - 9) * 2 * big // (big * (big - 7)), big, big - 7)]


def test_cuts_ties_and_absorbed_phrases(spark):
    rows = [("en", 1000, p, p.count(" ") + 1, f) for p, f in {
        "a": 50, "b": 50, "c": 50, "a b": 40, "b c": 40, "a b c": 40, "x": 50, "y": 50, "x y": 45, "z": 50, "y z": 44, "x y z": 43}.items()]
    got = {r["phrase"]: r for r in collocations.scored(spark.createDataFrame(rows, "lang string, n bigint, phrase string, length int, f bigint")).collect()}
    assert set(got) == {"a b c", "x y", "y z", "x y z"}
    assert (got["a b c"]["l"], got["a b c"]["r"]) == (50, 40)  # both cuts score alike: the first counts
    assert (got["x y z"]["l"], got["x y z"]["r"]) == (45, 50)  # 45 * 50 is more than 50 * 44
    kept = [(r["rank"], r["phrase"]) for r in collocations.ranked(spark.createDataFrame(got.values()), top=2).orderBy("rank").collect()]
    order = sorted(got.values(), key=lambda r: (-r["score"], -r["a"], r["phrase"]))
    assert kept == [(k + 1, r["phrase"]) for k, r in enumerate(order[:2])]


# Spelling variants

def plain_variants(rows):
    counts = Counter()
    for doc_id, _, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 7 and k >= 2}
    holes, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[i, w[:i] + w[i + 1:]].add(w)
    for (_, hole), same in holes.items():
        for w in same:
            near[w] |= same - {w}
            if hole in n:
                near[w].add(hole)
                near[hole].add(w)
    form = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: f if f is not None and n[f] >= 10 * n[w] else None for w, f in form.items()}

    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def as_rows(found):
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found]


def test_variants(spark, sf_dir):
    got = as_rows(QUERIES["op13_variants"](spark, sf_dir).collect())
    assert len(got) == len(set(got)) and set(got) == plain_variants(texts(spark, sf_dir))


@pytest.mark.parametrize("key_pairs", [0, 3, 10**9], ids=["longest keys", "longer keys", "halves"])
def test_pairs_under_all_key_lengths(spark, key_pairs):
    stem = "abababab"
    words = {stem} | {stem[:k] + c + stem[k:] for k in range(9) for c in "abxé"} | {stem[:k] + c + stem[k + 1:] for k in range(8) for c in "abxé"}
    words |= {stem[:k] + stem[k + 1:] for k in range(8)} | {"a" * k for k in range(1, 14)} | {"y" * 90, "y" * 91, "y" * 45 + "z" * 46, "", "ab", "b"}
    got = [(r["a"], r["b"]) for r in variants.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n bigint"), key_pairs).collect()]

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        return a != b and (any(a == b[:k] + b[k + 1:] for k in range(len(b))) if len(a) < len(b)
                           else len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1)
    assert Counter(frozenset(p) for p in got) == Counter({frozenset((a, b)) for a in words for b in words if near(a, b)})


def test_roots_follow_forms_to_the_last(spark):
    counts = {"hundredz": 2, "hundredzz": 20, "hundredzzz": 200, "hundredzzzz": 2_000, "hundredzzzzz": 20_000, "hundredy": 20, "hundredx": 20}
    got = {r[0]: r for r in as_rows(variants.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect())}
    assert {w: r[2] for w, r in got.items()} == {w: w if w in ("hundredy", "hundredx") else "hundredzzzzz" if w != "hundredz" else "hundredx" for w in counts}
    assert got["hundredz"][1] == "hundredx"  # of three forms with 20 occurrences the smallest


def test_slips_are_made_by_id_and_run(spark):
    docs = [(k, "Nevertheless nevertheless ÀNEVERTHELESS") for k in range(200)]
    got = {r["word"]: r["n"] for r in variants.words(spark.createDataFrame(docs, "doc_id int, text string"), least_count=1).collect()}
    want = Counter()
    for k, text in docs:
        for run in text.translate(LOWER).split():
            want[variants.slipped(str(k), run, 31)] += 1
    assert got == want and len(got) > 4
