import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from docspark.llm import pseudonyms as P
from tests.llm.helpers import docs

SCHEMA = "doc_id bigint, text string, n_chars bigint"


def rewritten(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA)
    got = sorted(P.pseudonymise(df, key).collect(), key=lambda r: r["doc_id"])
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
    return [r["text"] for r in got]


def luhn(digits):
    s = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        s += n - 9 if n > 9 else n
    return s % 10 == 0


def with_check(payload):
    return next(payload + str(c) for c in range(10) if luhn(payload + str(c)))


def test_permutes_within_the_format(spark):
    kinds = {
        "phones": [f"+1 ({a:03d}) 555-{b:04d}" for a in (17, 200) for b in range(60)],
        "cards": [with_check(f"453201511283{i:03d}") for i in range(120)],
        "spaced": [re.sub(r"(\d{4})(?=\d)", r"\1 ", with_check(f"520000001283{i:03d}")) for i in range(60)],
        "ips": [f"97.51.{a}.{b}" for a in (0, 17, 255) for b in range(0, 256, 9)],
        "ssn": [f"123-45-{i:04d}" for i in range(80)],
        "iso": [(date(1999, 12, 1) + timedelta(days=i)).isoformat() for i in range(150)] + ["2000-02-29", "2100-01-01", "1700-01-01"],
        "us": [(date(2024, 2, 1) + timedelta(days=i)).strftime("%m/%d/%Y") for i in range(60)],
        "dotted": [(date(2024, 2, 1) + timedelta(days=i)).strftime("%d.%m.%Y") for i in range(60)],
    }
    for kind, values in kinds.items():
        values = list(dict.fromkeys(values))
        out = [t[1:-1] for t in rewritten(spark, [f"<{v}>" for v in values])]
        assert len(set(out)) == len(values), kind
        assert sum(a == b for a, b in zip(values, out)) <= 2, kind
        if kind != "ips":
            assert all(re.sub(r"\d", "9", a) == re.sub(r"\d", "9", b) for a, b in zip(values, out)), kind
        if kind in ("cards", "spaced"):
            assert all(luhn(re.sub(r"\D", "", v)) for v in out)
        if kind == "ips":
            assert all(all(0 <= int(x) <= 255 for x in v.split(".")) and v.count(".") == 3 for v in out)
        if kind == "iso":
            assert all(date.fromisoformat(v) for v in out)
            assert all((int(a[:4]) < 2100) == (int(b[:4]) < 2100) for a, b in zip(values, out))


def test_a_small_domain_is_permuted_exactly(spark):
    pair = P.feistel("k", F.lit("t"), F.floor(F.col("id") / 7), F.col("id") % 7, F.lit(11), F.lit(7))
    got = spark.range(77).select(pair.alias("p")).select((F.col("p.l") * 7 + F.col("p.r")).alias("n")).collect()
    assert sorted(r["n"] for r in got) == list(range(77))


def test_links_across_documents_and_keys(spark):
    texts = ["call +1 (017) 555-7713, 4532015112830366.", "card 4532 0151 1283 0366 of und.34@mail7.example.com", "(017)!! +1!! (017)!! 555-7713!! Und.34@mail7.example.com"]
    a, b, c = rewritten(spark, texts)
    digits = lambda s: re.sub(r"\D", "", s)
    assert re.search(r"\d{16}", a)[0] == digits(re.search(r"card ([\d ]+) of", b)[1])
    assert digits(re.search(r"\+1 (.*),", a)[1]) == digits(c.split("+1")[1].split("u")[0])
    assert re.search(r"u\w+@mail7.example.com", b)[0] == re.search(r"u\w+@mail7.example.com", c)[0]
    assert rewritten(spark, texts, key="other")[0] != a


def test_leaves_the_rest_alone(spark):
    same = [
        None, "", "plain text, nothing here", "4532015112830367 fails the check", "999.1.1.1 v1.2.3.4.5 1.2.3", "2024-02-30 13/45/2025 2024-01-155",
        "12345 1234-5678 3.14159 1,000,000", "a@b @handle x@", "deadbeef 0123456789abcdef", "x" * 200_000 + " 7",
    ]
    assert rewritten(spark, same) == same
    (out,) = rewritten(spark, ["room43 4532015112830366 7, also 4532-0151-1283-0366-"])
    assert "4532" not in out and out.startswith("room43 ") and re.search(r" 7, also \d{4}-\d{4}-\d{4}-\d{4}-$", out)
    secret = '"04dbebab91ab85687d33eeaaf9ac699e1188f962"'
    (out,) = rewritten(spark, [f"token = {secret} end"])
    assert re.fullmatch(r'token = "[0-9a-f]{40}" end', out) and secret not in out


def test_plan_is_native_and_empty_table(spark):
    df = docs(spark, [(None, "+1 (017) 555-7713", "x")] * 2, "doc_id bigint, text string, key string")
    out = P.pseudonymise(df, "k")
    assert not re.search("Python|Pandas|Arrow|Exchange", out._jdf.queryExecution().executedPlan().toString())
    assert len({r["text"] for r in out.collect()}) == 1 and out.columns == df.columns
    assert P.pseudonymise(df.limit(0), "k").count() == 0


def test_other_ways_to_write_numbers(spark):
    phones = [
        "+14155550123", "+1 415 555 0123", "+1.415.555.0123", "+1-415-555-0123", "+1 (415) 555-0123", "1-415-555-0123", "415.555.0123", "415 555 0123", "415-555-0123",
        "(415) 555-0123", "(415)555.0123", "+44 20 7946 0958", "+442079460958", "+33 1 23 45 67 89", "+33123456789", "+49 30 123456", "+49 (0)30/123456", "+4930123456",
    ]
    texts = [f"call {p}, or mail" for p in [*phones, "123 45 6789", "123-45-6789"]]
    out = rewritten(spark, texts)
    digits = lambda s: re.sub(r"\D", "", s)
    for a, b in zip(texts, out):
        assert re.sub(r"\d", "9", a) == re.sub(r"\d", "9", b) and a != b, (a, b)
    assert len({digits(t)[-10:] for t in out[:11]}) == 1
    assert digits(out[11]) == digits(out[12]) != digits(out[13]) == digits(out[14])
    assert digits(out[15]) == digits(out[17]) and digits(out[18]) == digits(out[19])
    dates = ["3/7/2021", "03/07/2021", "2021-3-7", "2021-03-07", "7.3.2021"]
    got = rewritten(spark, [f"on {d}." for d in dates])
    days = [tuple(map(int, re.findall(r"\d+", t))) for t in got]
    assert days[0] == days[1] and days[2] == days[3] and days[0] == (*days[2][1:], days[2][0]) == (days[4][1], days[4][0], days[4][2])
    assert days[2] != (2021, 3, 7) and not re.search(r"\b0\d", got[0] + got[2] + got[4])
    (kept,) = rewritten(spark, ["+33 1 23 45 67 89 2021-13-07 13/45/2025, 3/32/2021 +12345 1 + 2"])
    assert kept.endswith(" 2021-13-07 13/45/2025, 3/32/2021 +12345 1 + 2")
