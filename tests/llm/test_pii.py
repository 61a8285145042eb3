import re

from pyspark.sql import functions as F

from tabeval.llm import pii

SCHEMA = "doc_id bigint, text string, kind string, unit string, attempt int"
KEY = "k"


def replaced(spark, texts, key=KEY):
    frame = spark.createDataFrame([(d, t, "a", "b", 1) for d, t in texts], SCHEMA)
    return {r["doc_id"]: (r["text"], r["n_entities"]) for r in pii.pseudonymise(frame, key).collect()}


def luhn(digits):
    total = 0
    for place, c in enumerate(reversed(re.sub(r"\D", "", digits))):
        n = int(c) * (2 if place % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def test_types_formats_gender_and_script(spark):
    text = (
        "Mr. John Smith and Mrs. Anna Müller met Herr Иван Петров; john.smith7@acme-corp.co.uk, "
        "+1 (017) 555-7713, 97.51.17.173, card 4111 1111 1111 1111, 123-45-6789, DE89 3704 0044 0532 0130 00, token = \"be24b64439e3e49cf46b2d7c90f3602a3d0b907f\"!"
    )
    out, n = replaced(spark, [(1, text)])[1]
    assert n == 10
    shape = re.fullmatch(
        r"Mr\. (\S+) (\S+) and Mrs\. (\S+) (\S+) met Herr ([А-Я][а-я]{3}) ([А-Я][а-я]{5}); ([a-z]{4}\.[a-z]{5}\d@[a-z]{4}-[a-z]{4}\.[a-z]{2}\.uk), "
        r"(\+1 \(\d{3}\) \d{3}-\d{4}), (\d+\.\d+\.\d+\.\d+), card (4\d{3} \d{4} \d{4} \d{4}), (\d{3}-\d{2}-\d{4}), (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d), token = \"([0-9a-f]{40})\"!", out)
    assert shape, out
    assert shape[1] in pii.GIVEN_M and shape[3] in pii.GIVEN_F
    assert all(0 <= int(o) <= 255 for o in shape[9].split(".")) and luhn(shape[10])
    for real in ("John", "Smith", "Anna", "Müller", "Иван", "acme", "555-7713", "97.51.17.173", "1111 1111", "45-6789", "3704", "be24b644"):
        assert real not in out


def test_coreference_and_distinctness_over_all_rows(spark):
    texts = [(i, f"mail user{i}@example.com or user{i % 7}@example.com, 10.0.{i // 250}.{i % 250}; Dr. Smith{'abcdefg'[i % 7]}") for i in range(600)]
    out = replaced(spark, texts)
    mails, hosts, names = {}, {}, {}
    for doc, text in texts:
        found = [re.findall(p, t) for t in (text, out[doc][0]) for p in (r"\S+@[^\s,]+", r"\d+\.\d+\.\d+\.\d+", r"Dr\. (\w+)")]
        for seen, real, drawn in zip((mails, hosts, names), found[:3], found[3:]):
            assert len(real) == len(drawn)
            for a, b in zip(real, drawn):
                assert seen.setdefault(a, b) == b
    for seen in (mails, hosts, names):
        assert len(set(seen.values())) == len(seen) and not set(seen) & set(seen.values())
    assert len({m.partition("@")[2] for m in mails.values()}) == 1


def test_spellings_of_one_number_and_other_keys(spark):
    texts = [(1, "4111111111111111 4111 1111 1111 1111 4111-1111-1111-1111 JOE@EXAMPLE.COM joe@example.com")]
    out = replaced(spark, texts)[1][0].split(" ")
    assert out[0] == "".join(out[1:5]) == out[5].replace("-", "") and out[6] == out[7].upper() != out[7]
    assert replaced(spark, texts, "other")[1][0] != " ".join(out)


def test_clashes_are_drawn_again(spark, monkeypatch):
    """With a single given name and one syllable almost every first draw clashes."""
    monkeypatch.setattr(pii, "SYLLABLES", ["ba", "de"])
    names = [f"{a}{b}son" for a in "ABCDEFGH" for b in "aeiou"]
    out = replaced(spark, [(i, f"Mrs. Clara {n} called") for i, n in enumerate(names)])
    drawn = {re.fullmatch(r"Mrs\. (.+) called", t)[1] for t, _ in out.values()}
    assert len(drawn) == len(names) and len({d.split(" ")[0] for d in drawn}) == 1
    units = spark.createDataFrame([("family", n) for n in names], "kind string, unit string")
    state = units.join(pii.attempts(units, KEY), ["kind", "unit"], "left").withColumn("d", pii.drawn_for(F.col("kind"), F.col("unit"), F.coalesce("attempt", F.lit(0)), KEY))
    assert state.select("d").distinct().count() == len(names)


def test_other_text_nulls_repeated_rows_and_empty_tables(spark):
    clean = "Version 3.14, 1,000,000 rows; @handle a@b tel 12345 1.2.3 999.1.1.1 Mr smith 12/12/2020 ١٢٣ drive."
    out = replaced(spark, [(1, clean), (2, None), (3, ""), (None, "x@y.org")])
    assert out[1] == (clean, 0) and out[2] == (None, 0) and out[3] == ("", 0)
    assert out[None][1] == 1 and "x@y.org" not in out[None][0]
    frame = spark.createDataFrame([(1, "x@y.org", "k", "u", 3)] * 2, SCHEMA)
    rows = pii.pseudonymise(frame, KEY).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and (rows[0]["kind"], rows[0]["unit"], rows[0]["attempt"]) == ("k", "u", 3)
    assert pii.pseudonymise(frame.limit(0), KEY).collect() == []
    long = "word " * 200_000 + "x@y.org"
    assert replaced(spark, [(1, long)])[1][0][:-7] == long[:-7]


def test_no_text_overflows_the_stack(spark):
    parts = ["a.", "a-", "a@", "@a.", "1.", "1 ", "Dr ", "A. ", "A-", "a:", "1:", ":", "+", "(1)", "A1 ", "key=", "'", "0 "]
    long = spark.createDataFrame([(part * (1_000_000 // len(part)),) for part in parts], "text string")
    assert long.select(F.size(F.regexp_extract_all("text", F.lit(pii.FOUND), F.lit(0))).alias("n"), F.col("text").rlike(pii.GATE)).count() == len(parts)
    sizes = long.select(F.substring("text", 1, 2).alias("part"), F.size(F.regexp_extract_all("text", F.lit(pii.FOUND), F.lit(0))).alias("n")).collect()
    assert {r["part"] for r in sizes if r["n"]} == {"1 ", "0 ", "Dr"}  # spaced digits look like card numbers, titles like names
    out = replaced(spark, [(100, "x@" + "a." * 2000 + "com"), (101, "x@" + "a." * 100 + "com"), (102, "a." * 300_000)])
    assert out[100][1] == out[102][1] == 0 and out[101][1] == 1 and not out[101][0].startswith("x@")


def test_titles_initials_and_capitals(spark):
    real = ["Prof. Dr. Anna Weber", "Mr. J. Smith", "Dr. SMITH", "Señora García", "Dr. Anna M. Weber", "Herr Prof. Müller-Lüdenscheidt", "Ms O'Brien"]
    out = replaced(spark, [(i, f"saw {t} today") for i, t in enumerate(real)])
    shown = [out[i][0].removeprefix("saw ").removesuffix(" today") for i in range(len(real))]
    assert all(out[i][1] == 1 for i in out)
    assert shown[0].startswith("Prof. Dr. ") and shown[2].startswith("Dr. ") and shown[2][4:].isupper()
    assert re.fullmatch(r"Mr\. \p{Lu}\. \p{Lu}\p{Ll}+".replace(r"\p{Lu}", "[A-Z]").replace(r"\p{Ll}", "[a-z]"), shown[1])
    assert re.fullmatch(r"Herr Prof\. [A-Z][a-z]+-[A-Z][a-z]+", shown[5]) and re.fullmatch(r"Ms [A-Z]'[A-Z][a-z]+", shown[6])
    for name in ("Anna", "Weber", "Smith", "SMITH", "García", "Müller", "Lüdenscheidt", "Brien"):
        assert not any(name in t for t in shown)
    assert shown[0].split(" ")[2:] == [shown[4].split(" ")[1], shown[4].split(" ")[3]]  # one Anna, one Weber


def test_a_name_is_the_same_after_any_title(spark):
    out = replaced(spark, [(1, "Mrs Agnes Brown"), (2, "Dr Agnes Brown"), (3, "Agnes"), (4, "Mr Kim Lee"), (5, "Prof. Kim Lee")])
    assert out[1][0].removeprefix("Mrs ") == out[2][0].removeprefix("Dr ") and out[1][0].split(" ")[1] in pii.GIVEN_F
    assert out[4][0].removeprefix("Mr ") == out[5][0].removeprefix("Prof. ") and out[4][0].split(" ")[1] in pii.GIVEN_M


def test_secrets_phones_and_addresses_in_more_forms(spark):
    real = ["API_KEY=abcdefghijkl1234", "Password: hunter2", "password=P@ssw0rd!2345", "call 030 1234567", "call 01 23 45 67 89", "at 2001:db8::8a2e:370:7334", "at 2001:0db8:85a3:0000:0000:8a2e:0370:7334"]
    out = replaced(spark, [(i, t) for i, t in enumerate(real)])
    for i, t in enumerate(real):
        head = re.match(r"(\w+ ?[=:]? ?)", t)[1]
        assert out[i][1] == 1 and out[i][0] != t and out[i][0].startswith(head), out[i]
    assert re.fullmatch(r"call \d{3} \d{7}", out[3][0]) and re.fullmatch(r"at [0-9a-f]{4}:[0-9a-f]{3}::[0-9a-f]{4}:[0-9a-f]{3}:[0-9a-f]{4}", out[5][0])
    clean = "password: required, Password reset; 12:30:45 std::vector a::b key: value"
    assert replaced(spark, [(1, clean)])[1] == (clean, 0)


def test_columns_of_any_name_are_kept(spark):
    frame = spark.createDataFrame([(1, "Mr Smith", "mine", 5, "f", "k")], "doc_id bigint, text string, _text string, n_entities int, found string, key string")
    row = pii.pseudonymise(frame, KEY).first()
    assert (row["_text"], row["found"], row["key"], row["n_entities"]) == ("mine", "f", "k", 1) and "Smith" not in row["text"]


def test_plan_has_no_python(spark):
    frame = spark.createDataFrame([(1, "x@y.org", "k", "u", 3)], SCHEMA)
    plan = pii.pseudonymise(frame, KEY)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("LogicalRDD", ""))


def test_small_spaces_and_other_scripts_get_surrogates(spark):
    phones = [f"+1{i:04d}" for i in range(5500)]
    mails = [f"{chr(97 + i)}@q.com" for i in range(26)] + ["Ա@ու.am", "ا@ق.org", "__@1.de"]
    names = ["Mr Արամ", "Mr Արմեն", "Mrs Ⴀა", "Dr Ⲁⲁ"]
    secrets = ["password=" + "=" * n for n in range(12, 16)]
    real = phones + mails + names + secrets
    frame = spark.createDataFrame(list(enumerate(real)), "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in pii.pseudonymise(frame, "k").collect()}
    shown = [rows[i]["text"] for i in range(len(real))]
    assert all(rows[i]["n_entities"] == 1 for i in rows) and len(rows) == len(real)
    assert len(set(shown)) == len(real) and not set(shown) & set(real)
    assert all(t.startswith("+1") and t[1:].isdigit() for t in shown[:5500]) and all("԰" < t[3] < "֐" for t in shown[5529:5531])
