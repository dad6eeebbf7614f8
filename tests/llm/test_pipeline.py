"""The corpus pipeline against a version that compares every document with every other."""

import os
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ingotflow.llm import byte_bpe, language_id
from tests.llm.test_native import brute_force, shingle_set
from tests.llm.test_near_dedup import edited, reach

HEX = "0123456789abcdef" * 2
SF_DIR = "/root/testdata/sf0.01"


def corpus():
    rnd = random.Random(6)
    letters = {"xx": "ka to mi ru ne so".split(), "yy": "bri gol dwe stan pfu".split()}

    def words(lang, n):
        return ["".join(rnd.choices(letters[lang], k=rnd.randint(2, 4))) for _ in range(n)]

    items = [(j, " ".join(words("xx", 30))) for j in range(3)]
    rows = []
    for b in range(40):
        base = words("xx" if b % 3 else "yy", rnd.randint(30, 150))
        copies = [base, *(edited(rnd, base, s) for s in (0, .003, .01, .05)[:b % 5])]
        for copy in copies:
            if rnd.random() < .1:
                copy = [*copy, items[b % 3][1], "more", "words"]
            if rnd.random() < .15:
                copy = [*copy[:9], f"token={HEX}", *copy[9:]]
            rows.append((len(rows), " ".join(copy), "xx" if b % 3 else "yy"))
    rows += [(len(rows), None, "xx"), (len(rows) + 1, "123 456 ...", None), (len(rows) + 2, "", "yy"),
             (len(rows) + 3, "漢字 漢字", None)]
    return rows, items


def masked(text):
    spans = []
    for start, _, end, _ in brute_force(text):
        if spans and start < spans[-1][1]:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([start, end])
    for start, end in reversed(spans):
        text = text[:start] + "[secret]" + text[end:]
    return text


def plain_pipeline(rows, items, model, least):
    kept = []
    for i, text, _ in rows:
        (lang,), (score,) = model.predict([text])
        if lang != "und" and score >= least:
            kept.append((i, text, shingle_set_of_words(text)))
    links = [(i, j) for n, (i, _, s) in enumerate(kept) for j, _, t in kept[:n]
             if 100 * len(s & t) >= 80 * len(s | t)]
    component = reach([i for i, *_ in kept], links)
    kept = [(i, text) for i, text, _ in kept if component[i] == i]
    tests = [shingle_set(text) for _, text in items]
    kept = [(i, text) for i, text in kept
            if not any(100 * len(q & shingle_set(text)) >= 80 * len(q) for q in tests)]
    return {i: masked(text) for i, text in kept}


def shingle_set_of_words(text, size=5):
    words = text.lower().split()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, items = corpus()
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows],
                          "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_run_equals_plain_version(spark, tables):
    folder, rows, items = tables
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_id.fit(documents.where("crc32(cast(doc_id AS string)) % 4 <> 2"))
    held_out = documents.where("crc32(cast(doc_id AS string)) % 4 = 2")
    expected = plain_pipeline(rows, items, model, language_id.score_bound(held_out, model))
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=(
        byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))).encode_ordinary
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert {i: r.ids for i, r in out.items()} == {i: encode(t) for i, t in expected.items()}
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out.values())
    assert 20 < len(out) < len(rows) - 30


@pytest.mark.parametrize("left_out", ["es", "fr", "en"])
@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables here")
def test_a_language_that_was_not_learned_goes(spark, left_out):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("truth", F.col("lang"))
    docs = docs.withColumn("lang", F.when(F.col("lang") != left_out, F.col("lang")))
    kept = corpus_pipeline.keep_known_languages(spark, docs, SF_DIR)
    before, after = ({r["truth"]: r["count"] for r in df.groupBy("truth").count().collect()} for df in (docs, kept))
    assert after.get(left_out, 0) <= 0.05 * before[left_out]
    known = [lang for lang in before if lang != left_out]
    assert sum(after[lang] for lang in known) >= 0.99 * sum(before[lang] for lang in known)


def test_stages_keep_columns_and_stand_empty_tables(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), folder)
        assert out.count() == 0, name
        if name != "byte_bpe":
            assert out.columns == docs.columns


def test_rows_are_told_apart_by_their_texts(spark, tables):
    """Null and repeated ids: copies go, whatever their id; different texts of one id stay."""
    folder, rows, items = tables
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    first, other = rows[0][1], " ".join(f"own{i}" for i in range(40))
    docs = spark.createDataFrame([(i, t, "xx", s, 1) for i, t, s in (
        (None, first, "s"), (3, first, "s"), (3, first, "s"), (5, first, "t"), (3, other, "s"), (3, rows[9][1], "s"),
        (None, "alone " * 9, "s"), (None, None, "s"), (8, "", "s"), (8, "", "t"))], schema)
    out = sorted(((r.doc_id, r.text, r.source) for r in corpus_pipeline.drop_near_duplicates(spark, docs, folder)
                  .collect()), key=str)
    assert out == sorted([(3, first, "s"), (3, other, "s"), (3, rows[9][1], "s"), (None, "alone " * 9, "s"),
                          (None, None, "s"), (8, "", "s"), (8, "", "t")], key=str)
    bad = "so it begins " + items[0][1]
    docs = spark.createDataFrame([(i, t, "xx", "s", 1) for i, t in (
        (None, bad), (3, bad), (3, other), (None, other), (None, None))], schema)
    kept = corpus_pipeline.drop_benchmark_items(spark, docs, folder).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(3, other), (None, other), (None, None)], key=str)
