from pyspark.sql import functions as F

from tabeval.functions import names, text
from tabeval.functions.fixed import KEYWORDS, KEYWORDS_SHORT
from tabeval.operators import analytics, catalog, prompts


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x"))).first()[0]


def test_column_names_agree_on_both_sides(spark):
    for raw in ["user_id", "first-name", "a  b\tc", "Price (USD)", "x__y", "", "%_of-total", "éa_b"]:
        assert one(spark, names.clean_column_name, raw) == names.clean_column_text(raw)
    assert names.clean_column_text("avg_price (USD)") == "AvgPriceUSD"


def test_table_names_keep_punctuation(spark):
    for raw in ["sales 2020", "my-data_set", "a.b c"]:
        assert one(spark, names.clean_table_name, raw) == names.clean_table_text(raw)
    assert names.clean_table_text("a.b c-d") == "A.bCD"


def test_colliding_column_names_are_numbered(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a_b` int, `a-b` int, `A B` int")
    assert names.sanitize_columns(df).columns == ["AB", "AB2", "AB3"]


def test_parse_size(spark):
    cases = {"12MB": 12 * 1024**2, "7KB": 7 * 1024, "about 3 GB": 3 * 1024**3, "5": None, "MB": None, "9B": 9}
    for raw, expected in cases.items():
        assert one(spark, names.parse_size, raw) == expected


def test_keywords_are_whole_words(spark):
    found = set(one(spark, text.classify_sql, "SELECT a FROM t GROUP BY a ORDER BY counter, in_x LIMIT 3 -- not"))
    assert found == {"from", "group by", "order by", "limit", "not"}
    spaced = one(spark, lambda c: text.classify_sql(c, "whitespace"), "select count(*) from t where a in (1)")
    assert set(spaced) == {"where", "in"}
    assert len(KEYWORDS) == 20 and len(KEYWORDS_SHORT) == 18


def raw_answer(n, fenced=True):
    if fenced:
        return "\n\n".join(f"{i}. Describe {i}:\n```sql\nSELECT {i} FROM t;\n```" for i in range(1, n + 1))
    return "Here they are\n\n" + "\n\n".join(f"{i}. Describe {i}\nSQL: SELECT {i} FROM t;" for i in range(1, n + 1)) + "\n\nDone"


def pairs(spark, answer, n):
    rows = prompts.parse_desc_sql(spark.createDataFrame([(1, answer)], "ref int, answer string"), "answer", n).collect()
    return [(r["query_idx"], r["desc"], r["sql"]) for r in rows]


def test_answers_split_at_blank_lines(spark):
    # piece by piece: the first line describes the rest
    got = pairs(spark, raw_answer(4, fenced=False), 4)
    assert got == [(i - 1, f"Describe {i}", f"SELECT {i} FROM t;") for i in range(1, 5)]


def test_answers_split_at_code_blocks(spark):
    got = pairs(spark, raw_answer(3), 3)
    assert [(d, s) for _, d, s in got] == [(f"Describe {i}:", f"SELECT {i} FROM t;") for i in range(1, 4)]


def test_alternating_descriptions_and_sql(spark):
    answer = "\n\n".join(f"{i}. Describe {i}\n\nSELECT {i}" for i in range(1, 4))
    assert [(d, s) for _, d, s in pairs(spark, answer, 3)] == [(f"Describe {i}", f"SELECT {i}") for i in range(1, 4)]


def test_an_answer_with_a_piece_without_select_is_dropped(spark):
    assert pairs(spark, raw_answer(3).replace("SELECT 2", "UPDATE 2"), 3) == []


def test_too_few_answers_are_rejected(spark):
    df = spark.createDataFrame([(1, "1.REL: a 2.REL: `b`", 2), (2, "1.REL: a", 2), (3, "intro 1.REL: x 2.REL: y 3.REL: z", 2)], "k int, a string, n int")
    rows = prompts.split_answers(df, "a", F.col("n")).select("k", "place", "code").collect()
    # two numbered answers after a preamble give three pieces, of which the last two count
    assert {tuple(r) for r in rows} == {(1, 0, "a"), (1, 1, "b"), (2, 0, ""), (2, 1, "a"), (3, 0, "y"), (3, 1, "z")}
    short = spark.createDataFrame([(4, "nothing numbered", 2)], "k int, a string, n int")
    assert prompts.split_answers(short, "a", F.col("n")).count() == 0


def test_long_prompts_continue_in_volumes(spark):
    parts = spark.range(25).select(F.lit("d").alias("ref"), F.col("id").alias("part_no"), F.col("id").cast("string").alias("text"))
    whole = {r["volume"]: r["prompt"] for r in prompts.assemble(parts, ["ref"], per_volume=10).collect()}
    assert whole[0] + whole[1] + whole[2] == "".join(str(i) for i in range(25)) and len(whole) == 3


def test_schema_prompt_wording_depends_on_the_number_of_tables(spark):
    tables = spark.createDataFrame([("a", 0, "S0", "{}"), ("b", 0, "S1", "{}"), ("b", 1, "S2", "{}")], "ref string, i int, s string, r string")
    made = {r["ref"]: r["prompt"] for r in prompts.assemble(prompts.schema_prompt_parts(tables, "ref", ["i"], "s", "r"), ["ref"]).collect()}
    assert "with 1 tables" in made["a"] and "joins" not in made["a"]
    assert "with 2 tables" in made["b"] and "If possible, use joins." in made["b"] and "Schema for table 1:\nS2" in made["b"]


def test_target_json_keeps_complete_answers_only(spark):
    rows = [('{"input_columns": ["a","b"], "output_column": "y"}',), ('{"input_columns": ["a"]}',), ("oops",), (None,)]
    assert prompts.parse_target_json(spark.createDataFrame(rows, "a string"), "a").count() == 1


def test_unknown_type_stops_the_job(spark):
    import pytest

    df = spark.createDataFrame([("TEXT",), ("BLOB",)], "t string")
    with pytest.raises(Exception, match="no mapping for type BLOB"):
        catalog.map_types(df, "t", {"TEXT": "string"}).collect()
    with pytest.raises(ValueError):
        catalog.sql_type_of("map<string,int>")


def test_component_table_keeps_components_that_never_occur(spark):
    df = spark.createDataFrame([("select a from t", "Valid")], "sql string, status string")
    rows = {r["type"]: r for r in analytics.component_validity(df, "sql", "status", total=True).collect()}
    assert rows["Total"]["sql_count"] == 1 and rows["union"]["sql_count"] == 0 and rows["union"]["pct_valid"] is None


def test_samples_that_are_too_small_are_an_error(spark):
    import pytest

    with pytest.raises(ValueError):
        analytics.sample_excluding(spark.range(5), "id", 5, spark.range(1), 1)
    assert analytics.sample_excluding(spark.range(5), "id", 4, spark.range(1), 1).count() == 4
