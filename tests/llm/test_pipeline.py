"""The pipeline's stages over a small corpus, each judged by plain Python on its own input."""

import hashlib

import public_tokenizers
import pytest
from fixtures_llm import prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    item = prose(20, 9000)
    passage = prose(60, 9001)
    rows = [(n, prose(80 + n % 40, n)) for n in range(120)]
    rows += [(200, rows[3][1]), (201, rows[4][1] + " tail"), (202, f"{prose(60, 700)} {item} {prose(60, 701)}")]
    rows += [(203, f"{prose(90, 702)} {passage} {prose(90, 703)}"), (204, f"{prose(90, 704)} {passage} {prose(90, 705)}")]
    rows += [(205, " ".join(w + "$$$ %%%" for w in prose(60, 706).split())), (206, "short"), (207, None)]
    path = tmp_path_factory.mktemp("corpus")
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)
    frame.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), dict(rows)


def test_stages_keep_what_is_clean(spark, corpus):
    path, texts = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = []
    for _, function in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = function(spark, docs, path).cache()
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.collect()})
    assert kept[0] == set(texts) - {205, 206, 207}
    assert kept[1] == kept[0] - {200, 201}
    assert kept[2] == kept[1]
    assert kept[3] == kept[2] - {202}
    left = {r.doc_id: r.text for r in docs.collect()}
    assert left[203] == texts[203] and len(left[204].split()) <= 180 + 15
    assert all(left[i] == texts[i] for i in left if i != 204)


def test_run_gives_the_tokens_of_what_is_left(spark, corpus):
    path, texts = corpus
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    assert set(found) == set(texts) - {200, 201, 202, 205, 206, 207}
    ids = library.encode(texts[5], add_special_tokens=False).ids
    assert found[5].n_tokens == len(ids)
    assert found[5].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_rows_with_null_and_repeated_ids(spark, corpus):
    path, _ = corpus
    item, clean = prose(20, 9000), [prose(70, 800 + k) for k in range(6)]
    hit = f"{clean[0]} {item} {clean[1]}"
    rows = [(None, hit), (None, clean[2]), (1, hit), (1, clean[3]), (2, clean[4]), (2, clean[4])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], COLUMNS).repartition(3)
    left = corpus_pipeline.benchmark_passages(spark, docs, path)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(None, clean[2]), (1, clean[3]), (2, clean[4]), (2, clean[4])], key=repr
    )
    rows = [(5, clean[0]), (5, clean[1]), (3, clean[0]), (7, clean[1] + " tail"), (None, clean[0]), (8, clean[4])]
    rows += [(None, clean[2]), (None, clean[2]), (None, clean[3]), (8, clean[4]), (9, None), (10, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS).repartition(3)
    left = corpus_pipeline.near_duplicates(spark, docs, path)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(3, clean[0]), (5, clean[1]), (None, clean[2]), (None, clean[3]), (8, clean[4]), (9, None), (10, None)],
        key=repr,
    )


def test_stages_keep_columns_of_any_name_and_empty_tables(spark, corpus):
    path, texts = corpus
    names = ["_key", "row", "first", "second", "none", "component_id", "runs", "_id", "_tag", "n", "hash"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    rows += [(300, prose(30_000, 8000), "en", "s", 0), (None, prose(80, 8001), "en", "s", 0)]
    docs = spark.createDataFrame(rows, COLUMNS).select("*", *[F.lit(n).alias(n) for n in names])
    for _, function in corpus_pipeline.STAGES[:-1]:
        found = function(spark, docs, path)
        assert found.columns == docs.columns
        kept = found.collect()
        assert {300, None} <= {r.doc_id for r in kept} and all(all(r[n] == n for n in names) for r in kept)
        assert function(spark, docs.filter("doc_id < 0"), path).collect() == []


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
