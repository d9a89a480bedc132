import random
import re

from pyspark.sql import functions as F

from docspark.functions.text import stays_in_line
from docspark.operators import entities as E
from docspark.operators import roles as R
from docspark.plans import prose
from docspark.sources import tables as T
from docspark.vocab import HintRule

PAGES = "doc_id string, page_number int, text string, block_spans array<struct<block_id:string,start:int,end:int>>"
PATTERNS = (
    E.Pattern("m_first", "DATE", r"[0-9]{2}/[0-9]{2}/[0-9]{4}", "/"),
    E.Pattern("m_second", "GENE_OR_GENE_PRODUCT", r"(?:JAK2|KRAS)"),
    E.Pattern("m_second", "DATE", r"[0-9]{2}/[0-9]{2}/[0-9]{4}"),
    E.Pattern("m_second", "CELL", r"cell"),
    E.Pattern("m_second", "ORG", r"Tempus"),
)


def pages(spark):
    texts = [
        ("d", 1, "Collected 01/02/2024 JAK2 at Tempus\njak2 KRAS cell"),
        ("d", 2, "JAK2  again 01/02/2024"),
        ("e", 1, "nothing here"),
    ]
    rows = []
    for d, p, t in texts:
        spans, at = [], 0
        for i, line in enumerate(t.split("\n")):
            spans.append((f"{d}{p}{i}", at, at + len(line)))
            at += len(line) + 1
        rows.append((d, p, t, spans))
    return spark.createDataFrame(rows, PAGES)


def test_mentions_have_offsets_order_and_context(spark):
    p = pages(spark)
    found = E.recognise(p, PATTERNS).orderBy("doc_id", "page_number", "seq").collect()
    texts = {(r["doc_id"], r["page_number"]): r["text"] for r in p.collect()}
    assert [(r["page_number"], r["source_model"], r["text"]) for r in found] == [
        (1, "m_first", "01/02/2024"),
        (1, "m_second", "01/02/2024"),
        (1, "m_second", "JAK2"),
        (1, "m_second", "Tempus"),
        (1, "m_second", "KRAS"),
        (1, "m_second", "cell"),
        (2, "m_first", "01/02/2024"),
        (2, "m_second", "JAK2"),
        (2, "m_second", "01/02/2024"),
    ]
    for r in found:
        t = texts[r["doc_id"], r["page_number"]]
        a, b = r["char_start"], r["char_end"]
        assert t[a:b] == r["text"]
        assert r["excerpt"] == re.sub(r"\s+", " ", t[max(0, a - 50) : b + 50]).strip()
        assert r["left_text"] == t[max(0, a - 80) : a].lower()


def test_range_join_equals_brute_force(spark):
    rng = random.Random(3)
    spans, mentions = [], []
    for page in range(6):
        at = 0
        for i in range(60):
            n = rng.choice([1, 3, 50, 400])
            spans.append(("d", page, f"{page}-{i}", at, at + n))
            at += n + 1
        mentions += [("d", page, i, rng.randrange(at + 50)) for i in range(150)]
    s = spark.createDataFrame(spans, "doc_id string, page_number int, block_id string, start int, end int")
    m = spark.createDataFrame(mentions, "doc_id string, page_number int, seq int, char_start int")
    want = {
        (d, p, q, c, next((b for _, sp, b, a, z in spans if sp == p and a <= c < z), None)) for d, p, q, c in mentions
    }
    for width in (1, 64, 1024):
        df = E.attach_blocks(m, s, width)
        assert {tuple(r) for r in df.collect()} == want and df.count() == len(mentions)
    in_page = m.join(s.groupBy("doc_id", "page_number").agg(F.array_sort(F.collect_list(F.struct("start", "end", "block_id"))).alias("sp")), ["doc_id", "page_number"])
    got = in_page.select("doc_id", "page_number", "seq", "char_start", E.block_at(F.col("sp"), F.col("char_start"))["block_id"])
    assert {tuple(r) for r in got.collect()} == want


def resolved(spark, roles=None, hints=None, tables=E.Tables()):
    found = E.recognise(pages(spark), PATTERNS)
    span = E.block_at(F.col("block_spans"), F.col("char_start"))
    placed = found.withColumn("block_id", span["block_id"]).drop("block_spans")
    profiles = spark.createDataFrame(
        [("d", "d10", "other", ["report_metadata", "Genomic_Variant_umbrella", "none"]), ("d", "d20", "references", ["none"])],
        "doc_id string, block_id string, text_role string, hints array<string>",
    )
    gated = E.gate(E.attach_profiles(placed, profiles), tables)
    return gated, E.resolve_sections(gated, tables)


def test_gates_in_order(spark):
    gated, _ = resolved(spark, tables=E.Tables(stoplist=(" KRAS ",)))
    reasons = {(r["page_number"], r["seq"]): r["drop_reason"] for r in gated.collect()}
    assert reasons[1, 4] == "in stoplist (known false positive)"
    assert reasons[1, 5] == "label 'CELL' not in schema v2"
    assert {reasons[2, i] for i in range(3)} == {"block role 'references' in drop-set"}
    assert [reasons[1, i] for i in range(4)] == [None] * 4
    counts = E.drop_counts(gated).first()
    assert (counts["dropped_count"], counts["mentions"]) == (5, 9)
    assert E.drop_examples(gated, 2).count() == 2


def test_candidates_fold(spark):
    _, rows = resolved(spark)
    tables = E.Tables()
    out = {(r["text_key"], r["section"]): r for r in E.candidates(rows, tables, keep_occurrences=True).collect()}
    date = out["01/02/2024", "report_metadata"]
    assert date["n_occurrences"] == 2 and date["source_models"] == ["m_first", "m_second"] and date["pages"] == [1]
    assert date["field_hint"] == "Collection_Date" and date["confidence"] == 0.9
    assert [o["char_start"] for o in date["occurrences"]] == [10, 10]
    assert out["tempus", "report_metadata"]["field_hint"] == "Vendor_Name"
    jak2 = out["jak2", "Genomic_Variant_umbrella"]
    assert jak2["text"] == "JAK2" and jak2["confidence"] == 0.9 and jak2["field_hint"] is None
    assert jak2["rationale"] == "'JAK2' → Genomic_Variant_umbrella (block-confirmed; 1 occurrence(s) in other)"
    # the second block has no profile: all sections of the label, less confidence
    kras = [r for (k, _), r in out.items() if k == "kras"]
    assert {r["section"] for r in kras} == {"Genomic_Variant_umbrella", "tested_biomarker_umbrella"}
    assert {r["confidence"] for r in kras} == {0.6} and "label-only fallback" in kras[0]["rationale"] and "unknown block" in kras[0]["rationale"]
    assert E.candidate_occurrences(rows).count() == sum(r["n_occurrences"] for r in out.values())
    counts = E.section_counts(pages(spark).select("doc_id").distinct(), E.candidates(rows, tables))
    got = {(r["doc_id"], r["section"]): r["candidates"] for r in counts.collect()}
    assert len(got) == 8 and sum(v for (d, _), v in got.items() if d == "e") == 0 and sum(got.values()) == len(out)


def test_first_rule_wins_and_label_can_count(spark):
    _, rows = resolved(spark)
    rules = (HintRule("PERSON", ("collected",), "A"), HintRule("DATE", ("collected",), "B"))
    t = E.Tables(hint_rules=rules)
    hint = lambda **kw: {r["text"]: r["field_hint"] for r in E.candidates(rows, t, **kw).collect() if r["section"] == "report_metadata"}
    assert hint()["01/02/2024"] == "A" and hint(respect_label=True)["01/02/2024"] == "B"


def test_plugged_recogniser(spark):
    def load():
        def model(pdf):
            out = pdf[["doc_id", "page_number"]].copy()
            out["text"], out["label"], out["source_model"] = pdf["text"].str[:4], "ORG", "m"
            out["char_start"], out["char_end"] = 0, 4
            return out

        return model

    assert {r["text"] for r in E.recognise_with(pages(spark), load).collect()} == {"Coll", "JAK2", "noth"}


def test_text_repeated_in_one_document_costs_one_row_per_task(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), (F.col("id") % 500).cast("string"))).alias("doc_id"),
        F.lit("JAK2").alias("text"),
        F.lit("report_metadata").alias("section"),
        (F.col("id") % 100).cast("int").alias("page_number"),
        F.col("id").cast("int").alias("seq"),
        F.lit("b").alias("block_id"),
        F.lit("m").alias("source_model"),
        F.lit(0.9).alias("confidence"),
        F.lit("other").alias("text_role"),
        F.lit("x").alias("excerpt"),
        F.lit("y").alias("left_text"),
    )
    out = E.candidates(rows)
    assert out.filter("doc_id = 'hot'").first()["n_occurrences"] == 20_000
    assert out.agg(F.sum("n_occurrences")).first()[0] == 60_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_equal_expressions_are_scanned_once(spark):
    """Patterns of several models with the same expression share its matches; the mentions are those of each by itself."""
    pages = spark.createDataFrame([(1, 1, "a@b.de, 12 and c@d.org"), (1, 2, "no 7"), (2, 1, ""), (3, 1, None)], "doc_id int, page_number int, text string")
    mail, number = r"[a-z]+@[a-z.]+", r"[0-9]+"
    patterns = [E.Pattern("one", "MAIL", mail, "@"), E.Pattern("two", "NUM", number), E.Pattern("two", "POST", mail, "@"), E.Pattern("one", "ADDR", mail)]
    kept = ["doc_id", "page_number", "text", "label", "source_model", "char_start", "char_end", "excerpt", "left_text"]
    found = E.recognise(pages, patterns)
    alone = [r for p in patterns for r in E.recognise(pages, [p]).select(*kept).collect()]
    assert sorted(map(tuple, found.select(*kept).collect())) == sorted(map(tuple, alone)) and len(alone) == 8
    order = [(r["seq"], r["label"]) for r in found.filter("doc_id = 1 and page_number = 1").orderBy("seq").collect()]
    assert order == list(enumerate(["MAIL", "ADDR", "MAIL", "ADDR", "POST", "NUM", "POST"]))
    plan = E.recognise(pages, patterns[:3])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2


def test_only_pages_with_a_match_are_cleaned(spark):
    """Candidates of one section look for its patterns only, on the pages that hold one; they equal those of all pages."""
    texts = [
        "Krankenhaus\n\n  Muenchenstadt und\t\nplain\nmail a@b.de to Regensburgen\nAb licensed under c@d.org\n1\n2\n3\n4",
        "nothing\nhere 192.168.0.1\n\n### junk ### Augsburgische\nx",
        "## Nuernbergische ##\n Oberammergau was\n4111111111111111 e@mail1.example",
        "",
        None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    section = "report_metadata"
    every = E.recognise(prose.clean_pages(docs).drop("block_ids"), T.PROSE_PATTERNS).withColumn("span", E.block_at(F.col("block_spans"), F.col("char_start")))
    every = every.select("*", "span.block_id", F.coalesce("span.text_role", F.lit("")).alias("text_role")).drop("span", "block_spans")
    assert sorted(map(str, prose.placed_mentions(docs).drop("hints").collect())) == sorted(map(str, every.collect()))
    placed = every.withColumn("hints", R.hints_of(F.col("text_role"), T.PROSE_ROLES))
    want = E.of_section(E.candidates(E.resolve_sections(E.gate(placed, T.PROSE_TABLES), T.PROSE_TABLES), T.PROSE_TABLES), section)
    found = prose.candidates_of(docs, section)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and found.count() >= 5
    assert not re.search(r"regexp_extract_all\([^,]*, \[0-9\]", found._jdf.queryExecution().optimizedPlan().toString())
    pages = prose.mention_pages(docs, E.patterns_of(T.PROSE_PATTERNS, T.PROSE_TABLES, section))
    assert sorted((r["doc_id"], r["page_number"]) for r in pages.collect()) == [(0, 1), (0, 2), (1, 1), (2, 1)]


def test_patterns_that_leave_their_line(spark):
    """Patterns that look around or may take a line break are tried on all pages."""
    for regex in (r"a\sb", "^a", "a$", "[^a]", "(?s)a.b", "a++", "a\nb", "(?<=x)a", "[a[b]]", r"\Wx", r"\Qa", "[a&&b]"):
        assert not stays_in_line(regex), regex
    for regex in (r"a.b", "(?i)abc", "(?:a|b)+", r"[A-Z][a-z]{9,}", r"\+1 \([0-9]{3}\)", r"\bNo\.\d+"):
        assert stays_in_line(regex), regex
    docs = spark.createDataFrame([(1, "a\nb"), (2, "a b"), (3, "c")], "doc_id bigint, text string")
    over = E.Pattern("m", "ORG", r"a\sb")
    assert sorted((r["doc_id"], r["text"]) for r in prose.placed_mentions(docs, [over]).collect()) == [(1, "a\nb"), (2, "a b")]
