import zlib

from pyspark.sql import functions as F

from tabeval.llm import langid

SCHEMA = "doc_id bigint, text string, lang string, held_out string, score string"
FOLDER = "/root/testdata/sf0.01"


def test_held_out_documents_get_their_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r["doc_id"]: r for r in langid.identify_languages(docs).collect()}
    truth = {r["doc_id"]: r for r in docs.collect()}
    assert set(got) == set(truth)
    held = [d for d in got if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(got[d]["held_out"] == (d in set(held)) for d in got)
    assert sum(got[d]["lang_pred"] == truth[d]["lang"] for d in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_only_the_text_decides_and_held_out_labels_are_not_learned(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 300")
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = ({r["doc_id"]: r["lang_pred"] for r in langid.identify_languages(d).collect()} for d in (docs, other))
    assert a == b and "xx" not in b.values()


def test_nulls_texts_without_letters_and_nothing_to_learn_from(spark):
    rows = [(i, "the cat sat on the mat " * 5, "en", "a", "b") for i in range(12)] + [(100 + i, "der hund und die katze " * 5, "de", "a", "b") for i in range(12)]
    odd = [(200, None, "en", "", ""), (201, "", "en", "", ""), (202, "12 + 3 = 15 !", None, "", ""), (203, "Die Katze", None, None, None), (None, "the cat", "en", "", ""), (203, "Die Katze", None, None, None)]
    odd += [(204, "❤️ 1️⃣ 23", None, "", ""), (205, "\U00030000\U00030001", None, "", "")]  # marks without a letter; letters of a far plane
    got = langid.identify_languages(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    by = {r["doc_id"]: (r["lang_pred"], r["held_out"]) for r in got}
    assert len(got) == len(rows + odd) and [by[d][0] for d in (200, 201, 202, 204)] == ["und"] * 4 and by[205][0] in ("en", "de")
    assert by[203][0] == "de" and by[None] == ("en", True)
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    unlabelled = langid.identify_languages(spark.createDataFrame([(1, "text", None, "", "")], SCHEMA)).collect()
    assert [(r["lang_pred"], r["score"]) for r in unlabelled] == [("und", 0.0)]
    assert langid.identify_languages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_kernel_counts_shared_ngrams():
    letters = langid.letter_table()

    def grams(text):
        words = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        return {words[i : i + n] for n in (1, 2, 3) for i in range(len(words) - n + 1)} - {" "}

    texts = ["The cat", "a cat, the hat!", "Ünïcode 日本", "x"]
    sets = [langid.ngrams(t, letters)[0] for t in texts]
    for a, s in zip(texts, sets):
        assert len(s) == len(grams(a)) == len(set(s.tolist()))
        for b, t in zip(texts, sets):
            assert len(set(s.tolist()) & set(t.tolist())) == len(grams(a) & grams(b))


def test_long_texts_are_read_to_their_end(spark):
    rows = [(i, t, l, "", "") for i in range(10) for t, l in (("aba bab " * 5, "aa"), ("cdc dcd " * 5, "cc"))]
    late = "aba bab " + "cdc dcd dcc cdd ddc ccd " * 20_000
    got = langid.identify_languages(spark.createDataFrame([*[(10 * i + j, *r[1:]) for i, r in enumerate(rows) for j in [0]], (9999, late, None, "", "")], SCHEMA))
    assert {r["doc_id"]: r["lang_pred"] for r in got.collect()}[9999] == "cc"


def test_long_documents_are_learned(spark):
    words = {"xa": "lorem ipsum dolor sit amet ", "xb": "ninde gwok tawa ruku mbele "}
    long = [(f"k{i}", "1 " * 15_000 * (i % 2) + words[l] * 1000, l) for i, l in enumerate(["xa", "xb"] * 20)]
    rows = langid.identify_languages(spark.createDataFrame(long, "doc_id string, text string, lang string")).collect()
    right = {k: l for k, _, l in long}
    assert len(rows) == 40 and all(r["lang_pred"] == right[r["doc_id"]] for r in rows)
    only = langid.identify_languages(spark.createDataFrame(long, "doc_id string, text string, lang string"), max_languages=1).collect()
    assert len({r["lang_pred"] for r in only}) == 1
