"""Personal data replaced by keyed surrogates, with column expressions only.

A mention is found by one pattern, typed by its form and cut into units (the words of a name, else the whole mention in a
canonical spelling). Equal units get equal surrogates everywhere (coreference), different units different ones
(distinctness): every distinct unit's surrogate is computed from the key, checked against all other surrogates
and all real units, and drawn again where it clashes. A mention is rendered in its own format, so two spellings of one
number stay two spellings of one surrogate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.llm.frames import picked, written

TITLES_F, TITLES_M, TITLES = "Mrs|Ms|Miss|Mme|Frau|Sra|Señora|Madame", "Mr|Herr|Sr|Señor|Monsieur", "Dr|Prof|Professor"
TITLE_RUN = rf"(?:(?:{TITLES_F}|{TITLES_M}|{TITLES})\.?[ \u00a0]){{1,4}}"  # Prof. Dr. is a run of titles
INITIAL = r"\p{Lu}\."
WORD = r"(?:\p{Lu}[\p{L}'’\-]*\p{Ll}|\p{Lu}[\p{Lu}'’\-]*\p{Lu})"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
HEX = r"[0-9A-Fa-f]{1,4}"
LABEL = r"(?i:token|secret|passwd|password|api_key|apikey|access_key)[\"']?\s{0,2}[=:]\s{0,2}[\"']?"  # belongs to the mention, not to the unit
# No group repeats without a bound: Java matches groups by recursion, and a long text would overflow the stack.
PATTERNS = {  # in order of precedence
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[\p{L}\p{N}][\p{L}\p{N}\-]{0,62}+\.){1,126}\p{L}{2,24}(?![\p{L}\p{N}])",
    "secret": rf"(?:{LABEL}(?:[A-Za-z0-9+/=_\-]{{12,}}+|(?=[^\s\"'\d]{{0,64}}+\d)[^\s\"']{{6,256}}+)|\b(?:AKIA[0-9A-Z]{{16}}|gh[pousr]_[A-Za-z0-9]{{36}}|sk-[A-Za-z0-9\-]{{20,}})\b)",
    "ip": rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?![\d]|\.\d)",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:])(?=[0-9A-Fa-f:]{{0,38}}\d)(?:(?:{HEX}:){{7}}{HEX}|(?:{HEX}:){{1,6}}(?::{HEX}){{1,6}})(?![\p{{L}}\p{{N}}:])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "phone": r"(?<![\d+\p{L}])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,5}\)[ .\-]?)?\d{2,5}(?:[ .\-]?\d{2,5}){1,4}|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4}|0\d{2,4}[ /]\d{5,8}|0\d(?: \d\d){4})(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": r"(?<![\d\p{L}])\d(?:[ \-]?\d){12,18}(?![\d\p{L}])",
    "name": rf"\b{TITLE_RUN}(?:{INITIAL} ?){{0,3}}{WORD}(?: (?:{INITIAL} )?{WORD}){{0,3}}",
}
FOUND = "|".join(f"(?:{p})" for p in PATTERNS.values())
GATE = rf"[@\d]|\b(?:{TITLES_F}|{TITLES_M}|{TITLES})\b|(?i:token|secret|passw|key)|sk-|::"
GIVEN_F = ["Anna", "Clara", "Diana", "Elena", "Frida", "Greta", "Helen", "Irene", "Julia", "Laura", "Maria", "Nora", "Paula", "Rosa", "Sofia", "Vera"]
GIVEN_M = ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "James", "Leo", "Martin", "Oscar", "Paul", "Robert", "Victor"]
SYLLABLES = ["ba", "de", "fi", "go", "hu", "ka", "le", "mi", "no", "pu", "ra", "se", "ti", "vo", "wa", "zen"]
ROUNDS = 3  # draws in the length of the unit; every later draw is longer, so that no space of surrogates is too small


def kind_of(mention: Column) -> Column:
    """The type of a mention, by the first pattern that fits all of it."""
    typed = F.lit("secret")
    for kind in reversed([k for k in PATTERNS if k != "secret"]):
        typed = F.when(mention.rlike(rf"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(typed)
    return typed


def units_of(mention: Column, kind: Column) -> Column:
    """The units of a mention as structs of type and canonical spelling."""
    words = F.filter(F.split(F.regexp_replace(F.regexp_replace(mention, rf"^{TITLE_RUN}", ""), r"\.(?=\p{Lu})", ". "), " "), lambda w: w != "")
    titles = F.regexp_extract(mention, rf"^{TITLE_RUN}", 0)
    gender = F.when(titles.rlike(rf"\b(?:{TITLES_F})\b"), "f").when(titles.rlike(rf"\b(?:{TITLES_M})\b"), "m").otherwise("n")
    given = F.concat(F.lit("given_"), gender)
    # the last word is a family name, those before it are given names, in the gender of the word itself or of the title
    names = F.transform(words, lambda w, i: F.struct(
        F.when(w.rlike(f"^{INITIAL}$"), "initial").when(i < F.size(words) - 1, F.when(w.isin(GIVEN_F), "given_f").when(w.isin(GIVEN_M), "given_m").otherwise(given)).otherwise("family").alias("kind"),
        w.alias("unit"),
    ))
    canonical = (
        F.when(kind == "email", F.lower(mention)).when(kind.isin("phone", "ssn", "card"), F.regexp_replace(mention, r"[^0-9+]", ""))
        .when(kind == "iban", F.regexp_replace(mention, " ", "")).when(kind == "secret", F.regexp_replace(mention, rf"^{LABEL}", "")).otherwise(mention)
    )
    return F.when(kind == "name", names).otherwise(F.array(F.struct(kind.alias("kind"), canonical.alias("unit"))))


def number_at(noise: Column, place: Column, most: Column | int) -> Column:
    """A number below ``most`` from the noise (64 hexadecimal digits) of one place."""
    at = F.pmod(place * 7, F.lit(57)) + 1
    most = F.lit(most) if isinstance(most, int) else most
    return F.pmod(F.conv(noise.substr(at.cast("int"), F.lit(8)), 16, 10).cast("bigint") + place * 2654435761 % 1000003, most)


LETTERS = [  # ranges of one script and case that are closed under drawing
    ("a", "z"), ("A", "Z"), ("0", "9"), ("à", "ö"), ("ø", "ý"), ("À", "Ö"), ("Ø", "Ý"), ("а", "я"), ("А", "Я"), ("α", "ρ"), ("σ", "ω"),
    ("א", "ת"), ("ب", "غ"), ("ぁ", "ゖ"), ("ァ", "ヺ"), ("一", "龥"), ("가", "힣"),
    ("ف", "ي"), ("ա", "ֆ"), ("Ա", "Ֆ"), ("क", "ह"), ("ก", "ฮ"), ("ა", "ჰ"),
]


def redrawn(text: Column, noise: Column, keep: Column) -> Column:
    """Every letter and digit after the first ``keep`` characters drawn again within its script and case; others stay.

    Letters and digits of no listed script are drawn from a to z (A to Z if upper-case) and 0 to 9. Noise is refreshed for every 16 places, so long units do not repeat.
    """

    def by_range(c: Column, value) -> Column:
        out = F.lit(None).cast("bigint")
        for low, high, others in (("0", "9", r"^\p{N}$"), ("a", "z", r"^\p{L}$"), ("A", "Z", r"^\p{Lu}$")):
            out = F.when((c > "\x7f") & c.rlike(others), F.lit(value(ord(low), ord(high))).cast("bigint")).otherwise(out)
        for low, high in reversed(LETTERS):
            out = F.when((c >= low) & (c <= high), F.lit(value(ord(low), ord(high))).cast("bigint")).otherwise(out)
        return out

    def one(c: Column, i: Column) -> Column:
        fresh = F.sha2(F.concat_ws("/", noise, F.floor(i / 16).cast("string")), 256)
        code = by_range(c, lambda low, high: low) + number_at(fresh, F.pmod(i, F.lit(16)), by_range(c, lambda low, high: high - low + 1))
        letter = F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
        return F.when(i < keep, c).otherwise(F.coalesce(letter, c))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10."""
    parts = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.pmod(F.aggregate(parts, F.lit(0), lambda a, b: a + b), F.lit(10))


def chosen(options: list[str], noise: Column, place: int) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (number_at(noise, F.lit(place).cast("bigint"), len(options)) + 1).cast("int"))


def syllables(noise: Column, n: Column) -> Column:
    """A drawn name of n syllables; every further draw asks for one more, so there are always enough names."""
    options = F.array(*[F.lit(s) for s in SYLLABLES])
    return F.array_join(F.transform(F.sequence(F.lit(1).cast("bigint"), n.cast("bigint")), lambda p: F.element_at(options, (number_at(noise, p, len(SYLLABLES)) + 1).cast("int"))), "")


def longer(text: Column, attempt: Column) -> Column:
    """A text to draw again; after ROUNDS draws its last letter or digit is repeated, two more times for every further draw."""
    last = F.regexp_extract(text, r"([\p{L}\p{N}])[^\p{L}\p{N}]*$", 1)
    last = F.when(last == "", "x").otherwise(last)
    return F.when(attempt > ROUNDS, F.concat(text, F.repeat(last, ((attempt - ROUNDS) * 2).cast("int")))).otherwise(text)


def surrogate(kind: Column, unit: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a unit in its canonical spelling."""
    noise = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, unit, attempt.cast("string")), 256)
    domain = F.substring_index(unit, "@", -1)
    shared = F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit("domain"), domain), 256)  # one domain stays one domain
    is_email = kind == "email"
    parts = F.when(is_email, F.array(F.struct(longer(F.substring_index(unit, "@", 1), attempt).alias("t"), noise.alias("n")), F.struct(F.regexp_replace(domain, r"\.[^.]*$", "").alias("t"), shared.alias("n"))))
    parts = parts.otherwise(F.array(F.struct(longer(unit, attempt).alias("t"), noise.alias("n"))))
    keep = F.when(kind == "card", 1).when(kind.isin("iban"), 2).when((kind == "phone") & unit.startswith("+"), 2).otherwise(0)
    fresh = F.array_join(F.transform(parts, lambda p: redrawn(p["t"], p["n"], keep)), "@")  # computed once, whatever the type
    octets = F.array_join(F.transform(F.split(F.when(attempt > ROUNDS, F.concat(unit, F.repeat(F.lit(".0"), (attempt - ROUNDS).cast("int")))).otherwise(unit), r"\."), lambda o, i: F.when((i == 0) | (i == 3), number_at(noise, i.cast("bigint"), 254) + 1).otherwise(number_at(noise, i.cast("bigint"), 256)).cast("string")), ".")
    hexadecimal = F.substring(F.repeat(noise, 64), 1, 4096).substr(F.lit(1), F.length(longer(unit, attempt)))
    plain = syllables(noise, attempt + 3)
    latin = unit.rlike(r"^[\p{IsLatin}'’\-]+$")

    def part(token: Column, i: Column) -> Column:
        """Of a hyphenated name every part is drawn; hyphens, apostrophes and single letters keep their places."""
        own = F.when(i == 0, plain).otherwise(syllables(F.sha2(F.concat_ws("/", noise, i.cast("string")), 256), F.lit(3)))
        shown = F.when(token.rlike(r"^\p{Lu}{2,}$"), F.upper(own)).when(token.rlike(r"^\p{Ll}"), own).otherwise(F.initcap(own))
        return F.when(token.rlike(r"^['’\-]$"), token).when(F.length(token) == 1, F.upper(F.substring(own, 1, 1))).otherwise(shown)

    joint = F.split(unit, r"(?<=['’\-])|(?=['’\-])", -1)
    cased = F.concat(F.array_join(F.transform(joint, part), ""), F.when(attempt > ROUNDS, F.repeat(F.lit("a"), (attempt - ROUNDS).cast("int"))).otherwise(""))
    sixteen = F.array_join(F.transform(F.split(unit, ""), lambda c, i: F.when(c.rlike("^[0-9a-fA-F]$"), F.substring(noise, 1, 64).substr(F.pmod(i, F.lit(64)) + 1, F.lit(1))).otherwise(c)), "")
    # a list is small: later draws join a drawn ending to a listed name
    ending = F.when(attempt > 0, F.concat(F.lit("-"), F.initcap(syllables(noise, attempt + 1)))).otherwise("")
    female, male = F.concat(chosen(GIVEN_F, noise, 0), ending), F.concat(chosen(GIVEN_M, noise, 0), ending)
    out = F.when(is_email, F.concat(fresh, F.regexp_extract(domain, r"\.[^.]*$", 0))).when(kind == "ip", octets)
    out = out.when(kind == "ip6", F.concat(sixteen, F.when(attempt > ROUNDS, F.lit(":0")).otherwise("")))
    out = out.when((kind == "secret") & unit.rlike("^[0-9a-f]+$"), hexadecimal)
    out = out.when((kind == "family") & latin, cased).when((kind == "given_f") & latin, female).when((kind == "given_m") & latin, male)
    return out.when((kind == "given_n") & latin, F.when(number_at(noise, F.lit(1), 2) == 0, female).otherwise(male)).otherwise(fresh)


def luhn_kept(real: Column, drawn: Column) -> Column:
    """A drawn card number with its last digit set so that it is Luhn-valid exactly if the real one is."""
    body = drawn.substr(F.lit(1), F.length(drawn) - 1)
    check = F.pmod(10 - luhn(F.concat(body, F.lit("0"))), F.lit(10))
    last = F.when(luhn(real) == 0, check).when(luhn(drawn) == 0, F.pmod(check + 1, F.lit(10)))
    return F.when(last.isNull(), drawn).otherwise(F.concat(body, last.cast("string")))


def drawn_for(kind: Column, unit: Column, attempt: Column, key: str) -> Column:
    # through a one-element array the first draw is computed once and used several times
    return F.element_at(F.transform(F.array(surrogate(kind, unit, attempt, key)), lambda d: F.when(kind == "card", luhn_kept(unit, d)).otherwise(d)), 1)


def attempts(units: DataFrame, key: str) -> DataFrame:
    """(kind, unit, attempt) of the units whose first draw clashes; the others need no row.

    A surrogate may neither be shared by two units of a kind nor be a real unit. Only distinct units are compared, and only
    those that clash are drawn again. Initials are too few to differ.
    """

    def drawn(rows: DataFrame) -> DataFrame:
        return rows.withColumn("drawn", F.lower(drawn_for(F.col("kind"), F.col("unit"), F.col("attempt"), key)))

    state = written(drawn(units.where("kind <> 'initial'").select("kind", "unit", F.lit(0).alias("attempt"))), "units")
    real = state.select("kind", F.lower("unit").alias("drawn")).distinct()
    redrawn_some = False
    while True:  # draws get longer, so there is always an end
        owners = state.groupBy("kind", "drawn").agg(F.min(F.struct("attempt", "unit")).alias("owner"), F.count(F.lit(1)).alias("n"))
        shared = state.join(owners.where("n > 1"), ["kind", "drawn"]).where(F.col("owner.unit") != F.col("unit")).select("kind", "unit")
        taken = state.join(real, ["kind", "drawn"]).select("kind", "unit")
        again = written(shared.unionByName(taken).distinct(), "again")
        if again.isEmpty():
            break
        redrawn_some = True
        once_more = state.join(again, ["kind", "unit"], "left_semi").select("kind", "unit", (F.col("attempt") + 1).alias("attempt"))
        state = written(state.join(again, ["kind", "unit"], "left_anti").unionByName(drawn(once_more)), "units")
    return state.where("attempt > 0").drop("drawn") if redrawn_some else state.drop("drawn").limit(0)


def one_gender(typed: DataFrame) -> DataFrame:
    """Mentions whose given names have one type each: the one most mentions of the name tell, female first on a tie."""
    told = typed.where(F.col("kind").startswith("given_")).groupBy("unit", "kind").agg(F.count(F.lit(1)).alias("n"))
    count = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))
    women, men = count("given_f"), count("given_m")
    known = F.when((women == 0) & (men == 0), "given_n").when(women >= men, "given_f").otherwise("given_m")
    mixed = told.groupBy("unit").agg(known.alias("known"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1").drop("kinds")
    kind = F.when(F.col("kind").startswith("given_"), F.coalesce("known", "kind")).otherwise(F.col("kind"))
    return typed.join(mixed, "unit", "left").withColumn("kind", kind).drop("known")


def rendered(mention: Column, kind: Column, units: Column) -> Column:
    """A mention with its units' surrogates, in the format of the mention."""
    first = F.element_at(units, 1)
    digits = F.regexp_replace(first, r"[^0-9]", "")
    # what a longer surrogate has more stands at the end
    more = digits.substr(F.length(F.regexp_replace(mention, r"[^0-9]", "")) + 1, F.length(digits))
    spread = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(
        c.rlike("^[0-9]$"), digits.substr(F.length(F.regexp_replace(mention.substr(F.lit(1), i + 1), r"[^0-9]", "")), F.lit(1))
    ).otherwise(c)), "")
    rest = first.substr(F.length(F.regexp_replace(mention, " ", "")) + 1, F.length(first))
    packed = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(
        c != " ", first.substr(F.length(F.regexp_replace(mention.substr(F.lit(1), i + 1), " ", "")), F.lit(1))
    ).otherwise(c)), "")
    title = F.regexp_extract(mention, rf"^{TITLE_RUN}", 0)
    label = F.regexp_extract(mention, rf"^{LABEL}", 0)
    return (
        F.when((kind == "email") & (mention == F.upper(mention)) & (mention != F.lower(mention)), F.upper(first))
        .when(kind == "name", F.concat(title, F.array_join(units, " "))).when(kind.isin("phone", "ssn", "card"), F.concat(spread, more))
        .when(kind == "iban", F.concat(packed, rest)).when(kind == "secret", F.concat(label, first)).otherwise(first)
    )


def pseudonymise(docs: DataFrame, key: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with all its columns, ``text`` with surrogates for personal data, and n_entities.

    Types: email, phone, payment card (Luhn-valid stays valid), IBAN, social security number, IPv4 and IPv6 address, secret, and names
    after one or more titles (surrogates keep gender, script, hyphens and apostrophes; a given name has one gender everywhere).
    Defined cases: null text stays null with n_entities 0; texts without a mention are unchanged to the byte; null keys and repeated
    rows are treated like any other; an empty table gives no rows; a column n_entities of the caller is replaced, any other keeps its value.
    Surrogates depend on the key, the units and - for the few that clash - the set of units.
    """
    others = [c for c in docs.columns if c != "n_entities"]
    own = F.col(f"`{text}`").cast("string")
    found = F.when(own.rlike(GATE), F.regexp_extract_all(own, F.lit(FOUND), F.lit(0)))
    carried = F.struct(*[F.col(f"`{c}`") for c in others])
    rows = docs.select(carried.alias("row"), own.alias("text"), F.col(f"`{doc}`").alias("doc"), F.coalesce(found, F.array().cast("array<string>")).alias("found"))

    def whole(value: Column, n: Column) -> list[Column]:
        return [*[value.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in others], n.alias("n_entities")]

    plain = rows.where(F.size("found") == 0).select(*whole(F.col(f"row.`{text}`"), F.lit(0)))
    hits = rows.where(F.size("found") > 0).withColumn("key", F.xxhash64("text", "doc"))

    seen = hits.select("key", F.posexplode("found").alias("at", "mention")).distinct()
    typed = seen.withColumn("kind", kind_of(F.col("mention"))).withColumn("units", units_of(F.col("mention"), F.col("kind")))
    typed = typed.select("key", "at", "mention", "kind", F.posexplode("units").alias("part", "u")).select("key", "at", "mention", F.col("kind").alias("type"), "part", "u.kind", "u.unit")
    typed = one_gender(written(typed, "mentions"))
    clashes = attempts(typed.select("kind", "unit").distinct(), key)
    drawn = typed.join(clashes, ["kind", "unit"], "left").withColumn("drawn", drawn_for(F.col("kind"), F.col("unit"), F.coalesce("attempt", F.lit(0)), key))
    per_mention = drawn.groupBy("key", "at", "mention", "type").agg(F.array_sort(F.collect_list(F.struct("part", "drawn"))).alias("parts"))
    shown = per_mention.select("key", "at", rendered(F.col("mention"), F.col("type"), F.col("parts.drawn")).alias("shown"))
    per_row = shown.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "shown"))).alias("shown"))

    between = F.split(F.col("text"), FOUND, -1)
    joined = F.array_join(F.zip_with(between, F.concat(F.col("shown.shown"), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    changed = hits.join(per_row, "key").select(*whole(joined, F.size("found")))
    return plain.unionByName(changed)
