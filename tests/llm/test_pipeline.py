import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabeval.llm import decontam, langid, neardup, pieces, pii, queries
from tabeval.llm.stages import LEAST_SIMILARITY, PIECES_MODEL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What every stage keeps, on the smallest tables and some rows of every odd kind."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame(
        [(9000, None, None, "s", 0), (9001, "123 456 !", "en", None, 9), (9002, "", "en", "s", 0), (None, "the and of that", "en", "s", None), (9003, "漢字仮名交じり文", None, "s", 8)], docs.schema
    )
    out = [docs.unionByName(odd)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], FOLDER).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=str)


def test_stages_keep_the_columns_and_only_drop_rows(kept):
    for before, after in zip(kept[:-2], kept[1:-1]):
        assert after.columns == before.columns and dict(after.dtypes) == dict(before.dtypes)
        assert set(ids(after)) <= set(ids(before))
    assert ids(kept[4]) == ids(kept[3]) == ids(kept[5])


def test_each_stage_does_what_its_operator_says(spark, kept):
    docs, known, single, clean, private, coded = kept
    found = langid.identify_languages(docs).where((F.col("lang_pred") != "und") & (F.col("similarity") >= LEAST_SIMILARITY))
    assert ids(known) == ids(found) and not {9000, 9001, 9002, 9003} & set(ids(known))
    assert known.count() == docs.count() - 4  # clean documents stay
    assert ids(single) == ids(neardup.near_duplicates(known).where("kept")) and single.count() < known.count()
    held = decontam.contaminated(single, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
    assert ids(clean) == ids(held.where("not contaminated")) and clean.count() < single.count()
    texts = {r["doc_id"]: r for r in private.collect()}
    for row in pii.pseudonymise(clean, "tabeval-surrogates").collect():
        assert texts[row["doc_id"]]["text"] == row["text"]
        assert texts[row["doc_id"]]["n_chars"] == (len(row["text"]) if row["n_entities"] else row["n_chars"])
    back = {r["doc_id"]: r["text"] for r in pieces.decode(coded, PIECES_MODEL).collect()}
    assert back == {d: r["text"] for d, r in texts.items()} and coded.where("not round_trip or n_tokens <> size(ids)").isEmpty()


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert sorted(map(tuple, got.select("doc_id", "n_tokens").collect())) == sorted(map(tuple, docs.select("doc_id", "n_tokens").collect()))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "pii_surrogates", "sentencepiece"]


def test_an_empty_table_passes_all_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.collect() == []


def test_one_query_for_each_operator():
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 11))
    assert {int(n[2:].split("_")[0]) for n in queries.ORACLES} == {2, 4, 5, 7, 9}
