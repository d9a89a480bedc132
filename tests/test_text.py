import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docspark.functions import answers, dates, identifiers, text
from docspark.operators import noise as N
from docspark.operators import roles as R
from docspark.sources import tables as T

ALPHABET = "ab A.\t\n\r\x0b\x1c\x85\xa0\u2003\u2028\u200b\u3000\xe9-'\"\\"


def one(spark, value, *cols):
    return spark.createDataFrame([(value,)], "t string").select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def many(spark, values, col):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string").select("i", col.alias("c")).collect()
    return [r["c"] for r in sorted(df)]


@settings(max_examples=5, deadline=None)
@given(values=st.lists(st.text(ALPHABET, max_size=12), min_size=30, max_size=60))
def test_keys_follow_unicode_blanks(spark, values):
    t = F.col("t")
    assert many(spark, values, text.strip(t)) == [v.strip() for v in values]
    assert many(spark, values, text.text_key(t)) == [re.sub(r"\s+", " ", v).strip().lower() for v in values]
    punct = "[" + re.escape(text.BLANKS + text.PUNCTUATION) + "]+"
    assert many(spark, values, text.match_key(t)) == [re.sub(punct, " ", v.lower()).strip() for v in values]
    assert many(spark, values, F.array_join(text.lines_with_ends(t), "|")) == ["|".join(v.splitlines(keepends=True)) for v in values]


def test_pattern_spans_match_a_scan(spark):
    values = ["", "a1b22c", "11", "no", "x1", "1x", "é1é2", "1 1 1", "a\n12\n3"]
    got = many(spark, values, text.pattern_spans(F.col("t"), "[0-9]+"))
    want = [[(m.start(), m.end(), m.group()) for m in re.finditer("[0-9]+", v)] for v in values]
    assert [[tuple(s) for s in g] for g in got] == want


def test_literal_spans_are_literal_and_capped(spark):
    values = ["A.b a.B", "a-b", "", "A.B" * 7, "x\\Ey"]
    turkish = many(spark, ["İİİ the cat"], text.literal_spans(F.col("t"), F.lit("THE")))[0]
    assert [tuple(s) for s in turkish] == [(4, 7, "the")]
    spans = many(spark, values, text.literal_spans(F.col("t"), F.lit("a.b"), 3))
    want = [[m.span() for m in re.finditer(re.escape("a.b"), v, re.I)][:3] for v in values]
    assert [[(s["start"], s["end"]) for s in g] for g in spans] == want
    assert len(many(spark, ["x\\Ey x\\ey"], text.literal_spans(F.col("t"), F.lit("\\E")))[0]) == 2


def test_words_at_both_ends(spark):
    k = text.match_key(F.col("t"))
    r = one(spark, "One, two; three four five six seven", text.first_words(k, 6), text.last_words(k, 6))
    assert tuple(r) == ("one two three four five six", "two three four five six seven")
    r = one(spark, "One two", text.first_words(k, 6), text.last_words(k, 6))
    assert tuple(r) == ("one two", "one two")
    assert tuple(one(spark, " .", text.first_words(k, 6), text.last_words(k, 6))) == ("", "")


def test_quoted(spark):
    assert many(spark, ["a", "it's", "a\"'b"], text.quoted(F.col("t"))) == ["'a'", "\"it's\"", "'a\"\\'b'"]


def test_dates(spark):
    cases = {
        "08/12/2025 01:00:00 PM": "2025-08-12",
        "08/13/2025 01:15:00 PM PDT": "2025-08-13",
        "08/26/2025 07:41:01 PM ET": "2025-08-26",
        "01/25/1941 / M": "1941-01-25",
        "2024-03-23": "2024-03-23",
        "2024-03-23T23:59:59-08:00": "2024-03-23",
        "August 26, 2025 at 4:42 PM": "2025-08-26",
        "26 Aug 2025": "2025-08-26",
        "08.27.2025": "2025-08-27",
        "August 2025": None,
        "13/45/2025": None,
        "02/30/2024": None,
        "": None,
        None: None,
        "soon": None,
        "12-Aug-2025": "2025-08-12",
        "Aug. 12, 2025": "2025-08-12",
        "August 12 2025": "2025-08-12",
        "01/25/41": "2041-01-25",
        "01/25/81": "1981-01-25",
        "25/12/2024": "2024-12-25",
        "112/05/2024": None,
        "2024-01-155": None,
        "id 5512024-01-15": None,
    }
    assert many(spark, list(cases), dates.to_iso_date(F.col("t"))) == list(cases.values())


def test_identifiers(spark):
    values = ["1234567893", "1234567890", "123456789", " 1234567893 ", "12345678X3", None]
    assert many(spark, values, identifiers.identifier_reason(F.col("t"))) == [
        "Luhn check passed",
        "Luhn check failed",
        "Not exactly 10 digits",
        "Luhn check passed",
        "Not exactly 10 digits",
        "Not exactly 10 digits",
    ]
    assert many(spark, values, identifiers.is_valid_identifier(F.col("t"))) == [True, False, False, True, False, False]


def test_json_of_answer(spark):
    values = ['```json\n{"a":\n1}\n```\nor\n```json\n{"b":2}\n```', '{"a":1}', 'x\n```json\n{"a":1}\n```', '```\n{"a":{"b":2}}\n```', 'It is {"a":1}.', "{", "", None]
    want = ['{"a":\n1}', '{"a":1}', '{"a":1}', '{"a":{"b":2}}', '{"a":1}', None, None, None]
    assert many(spark, values, answers.json_of_answer(F.col("t"))) == want


def test_prefix_sums_of_short_and_long_arrays(spark):
    cases = [[], [5], list(range(9)), list(range(10)), list(range(11)), [3] * 57]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, a array<int>")
    got = {r["i"]: list(r["p"]) for r in df.select("i", text.prefix_sums(F.col("a"), 5).alias("p")).collect()}
    assert got == {i: [sum(a[:j]) for j in range(len(a))] for i, a in enumerate(cases)}


def test_very_many_matches_in_one_text(spark):
    import time

    n = 200_000
    df = spark.createDataFrame([("1 " * n,)], "t string")
    start = time.time()
    spans = df.select(text.pattern_spans(F.col("t"), "[0-9]").alias("s"))
    r = spans.select(F.size("s").alias("n"), F.element_at("s", -1).alias("last")).first()
    assert r["n"] == n and (r["last"]["start"], r["last"]["end"]) == (2 * n - 2, 2 * n - 1)
    assert time.time() - start < 60


def test_cheap_tests_come_first_and_change_nothing(spark):
    """Lines are stripped only where a pattern hits, and patterns with a needed literal are tried only where it stands."""
    noisy = [
        " ** INBOUND NOTIFICATION : FAX RECEIVED SUCCESSFULLY **", "time received x remote csid y duration\t", "01.02.2024 10:11:12 Page: 1 of 2",
        "Page: 1 of 2 Sender: a Recipient: +1234567", " 2024 at 10:11 AM x Received", "x ## y $$ z", "2024 at 10:11 x OK ",
    ]
    plain = ["", " \t", None, "  ", "a plain line", "at 10:11", "# one & one", "Page: 1", "\x1c", "a\n\nb"]
    lines = spark.createDataFrame([(t,) for t in noisy + plain], "text string")
    t = F.col("text")
    around = (("whole", r"^a plain line$"), ("tail", r"(?<! )b$"), ("taken", r" ++a"), ("blank", r"^$"), ("lead", r" +2024"))
    for patterns in (T.PROSE_NOISE, N.NOISE_PATTERNS, around, (("lead", r" 2024"), ("gap", r"\sat\s")), ()):
        rows = lines.select("text", N.is_noise(t, patterns).alias("got"), N.noise_name(t, patterns).isNotNull().alias("want")).collect()
        assert all(r["got"] == r["want"] for r in rows), [r for r in rows if r["got"] != r["want"]]
    assert lines.filter(N.is_noise(t, T.PROSE_NOISE)).count() == len(noisy)
    assert lines.filter(text.is_blank(t) != (F.coalesce(text.strip(t), F.lit("")) == "")).isEmpty()
    texts = ["a@mail x", "+1 (2", "@x + (", "1234567890123", "1.2.3.4", "token = 1", "5 = 6", "Abcdefghijk", "released under", ""]
    slow = [R.RoleRule(r.role, r.pattern, r.hints, r.confidence) for r in T.PROSE_ROLES]
    rows = spark.createDataFrame([(x,) for x in texts], "text string").select(R.role_of(t, T.PROSE_ROLES).alias("got"), R.role_of(t, slow).alias("want")).collect()
    assert all(r["got"] == r["want"] for r in rows) and len({r["got"] for r in rows}) == 5
    plan = lines.select(N.is_noise(t, T.PROSE_NOISE))._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(text" in plan and plan.index("RLIKE") < plan.index("trim")
