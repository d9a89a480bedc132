"""Printed laboratory reports that Spark derives from the customer table.

One report per customer, about 17 blocks on two pages. Every printed value and
every layout variant follows from the key, so the right record is known.

A report is many times the size of its customer in the file, so files say
little about the work: customers are spread by key before they become reports.
All that is derived from them stays laid out by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.sources.tables import table

FIRST = ("ORVEN", "Tilda", "Mirka", "Pavo")
LAST = ("QUILLON", "Brandt", "Osei", "Lindqvar", "Farrow")

#: Customers whose reports one task makes, about.
CUSTOMERS_PER_TASK = 25_000


def customers(spark: SparkSession, sf_dir: str, per_task: int = CUSTOMERS_PER_TASK) -> DataFrame:
    """The customers, spread by key over at least as many tasks as a shuffle has."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // per_task))
    return rows.repartition(tasks, "c_custkey")


def _choose(k: Column, *values) -> Column:
    cols = [v if isinstance(v, Column) else F.lit(v).cast("string") for v in values]
    out = F.when(k % len(cols) == 0, cols[0])
    for i, v in enumerate(cols[1:], 1):
        out = out.when(k % len(cols) == i, v)
    return out


def _date(base: str, days: Column) -> Column:
    return F.date_add(F.to_date(F.lit(base)), days.cast("int"))


def report_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    text = k.cast("string")
    segment = F.initcap("c_mktsegment")
    first, last = _choose(k, *FIRST), _choose(k, *LAST)
    collected = _date("2020-01-01", k * 37 % 1500)
    received, reported = F.date_add(collected, 1), F.date_add(collected, 5)
    born = _date("1940-01-01", k * 101 % 20000)
    us = "MM/dd/yyyy"
    none = F.lit(None).cast("string")
    lines = [
        _choose(
            k,
            F.concat(F.date_format(reported, "MM.dd.yyyy"), F.lit(" 10:11:12 Page: 1 of 2 Sender: NeoLab Recipient: +15550001234")),
            "** INBOUND NOTIFICATION : FAX RECEIVED SUCCESSFULLY **",
            none,
            none,
        ),
        _choose(k, "Final Report", "Molecular Genetics", "Colorectal Sample"),
        _choose(k, "Tempus Labs, Inc.", "Assay xT genomic profiling", "FoundationOne panel, Laboratory copy", "General Laboratory", "NeoGenomics Laboratories"),
        F.concat(F.lit("Patient Name: "), segment, F.lit(", "), first),
        F.concat(F.lit("DOB: "), F.date_format(born, us), F.lit(" / M")),
        _choose(
            k,
            F.concat(F.lit("MRN: 00"), text),
            F.concat(F.lit("Medical Record #: M"), text),
            F.concat(F.lit("Accession Number: A"), text),
            "MRN:",
            F.concat(F.lit("Patient ID: "), text),
            F.concat(F.lit("Med Rec #: R"), text),
        ),
        _choose(k, F.concat(F.lit("Collected: "), F.date_format(collected, us), F.lit(" 01:00:00 PM")), F.concat(F.lit("Collection Date: "), F.date_format(collected, "yyyy-MM-dd"))),
        F.concat(F.lit("Received Date: "), F.date_format(received, us), F.lit(" 01:15:00 PM PDT")),
        _choose(
            k,
            *[F.concat(F.lit("Report Date: "), F.date_format(reported, "MMMM d, yyyy"))] * 3,
            none,
            "Report Date: 13/45/2025",
            "Report Date: August 2025",
            F.concat(F.lit("Report Date: "), F.date_format(reported, us), F.lit(" 07:41:01 PM ET")),
        ),
        F.when(k % 9 == 0, F.lit("Treating Physician: Alex Quill, D.O.")),
        _choose(
            k,
            F.concat(F.lit("Ordering Physician: "), F.upper(first), F.lit(" D "), F.upper(last), F.lit(", M.D.")),
            F.concat(F.lit("Physician Dr. "), first, F.lit(" "), last),
            "Ordered By",
        ),
        _choose(k, "NPI: 1234567893", "NPI: 1234567890", "NPI: 12345"),
        F.when(k % 8 != 5, F.concat(F.lit("Practice: Nation "), nation.cast("string"), F.lit(" Oncology Clinic"))),
        _choose(k, F.concat(text, F.lit(" Juniper Rd. Suite "), (nation + 100).cast("string")), F.concat(text, F.lit(" Main St."))),
        _choose(k, "Eastmere, CA 40011", "Port Calder, ca 40022-1234", "Wellbrook, TX 40033"),
        _choose(k, "Test: ABC1 V100F Mutation Analysis", "Panel: Molecular profiling"),
        _choose(k, "Methodology: measured by quantitative PCR", "Method: Next Generation Sequencing and IHC", "Methodology: proprietary", none),
        _choose(k, "ABC1 p.V100F Detected", "KRAS p.G12D Not Detected"),
        F.when(
            (k % 3 == 2) | (k % 10 == 0),
            F.concat(F.lit("PATIENT: "), first, F.lit(" "), segment, F.lit("  CASE NUMBER: "), text, F.lit("  PHYSICIAN: Dr. "), first, F.lit(" "), last),
        ),
        F.lit("Electronically signed, CLIA 05D0000000"),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("ord"),
                F.concat_ws("-", text, F.lit(str(i))).alias("block_id"),
                F.lit(1 if i < 15 else 2).alias("page_number"),
                F.lit("page_1/paragraph" if i < 15 else "page_2/paragraph").alias("section_path"),
                line.alias("text"),
            )
            for i, line in enumerate(lines)
        ]
    )
    return customers(spark, sf_dir).select(k.alias("doc_id"), F.inline_outer(rows)).filter(F.col("text").isNotNull())


def gold_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The right record of each report, from the key alone."""
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    text = k.cast("string")
    none = F.lit(None).cast("string")
    collected = _date("2020-01-01", k * 37 % 1500)
    first = _choose(k, *[n.title() for n in FIRST])
    last = _choose(k, *[n.title() for n in LAST])
    confidence = F.when((k % 5).isin(1, 2), 0.8).when((k % 9 != 0) & (k % 3 == 2), 0.9).otherwise(0.95)
    record = {
        "total_pages": F.lit(2),
        "report_title": _choose(k, "Final Report", "Molecular Genetics", "Colorectal Sample"),
        "llm_confidence_score": confidence,
        "Patient_MRN": _choose(k, F.concat(F.lit("00"), text), F.concat(F.lit("M"), text), none, none, none, F.concat(F.lit("R"), text)),
        "Patient_First_Name": first,
        "Patient_Last_Name": F.initcap("c_mktsegment"),
        "Patient_DOB": _date("1940-01-01", k * 101 % 20000).cast("string"),
        "Vendor_Name": _choose(k, "Tempus", "Tempus", "Foundation Medicine", none, "NeoGenomics"),
        "Collection_Date": collected.cast("string"),
        "Received_Date": F.date_add(collected, 1).cast("string"),
        "Report_Date": F.when((k % 7).isin(0, 1, 2, 6), F.date_add(collected, 5).cast("string")),
        "Test_Name": _choose(k, "ABC1 V100F Mutation Analysis", "Molecular profiling"),
        "Procedure": _choose(k, "Quantitative PCR", "Next Generation Sequencing | IHC", none, none),
        "Ordering_Provider_First_Name": first,
        "Ordering_Provider_Last_Name": last,
        "Ordering_Provider_NPI": F.when(k % 3 == 0, F.lit("1234567893")),
        "Ordering_Provider_Title": F.when(k % 3 == 0, F.lit("M.D.")).otherwise(F.lit("Dr.")),
        "Practice_Name": F.when(k % 8 != 5, F.concat(F.lit("Nation "), nation.cast("string"), F.lit(" Oncology Clinic"))),
        "Practice_NPI": none,
        "Practice_Street_Address_1": F.concat(text, _choose(k, " Juniper Rd.", " Main St.")),
        "Practice_Street_Address_2": F.when(k % 2 == 0, F.concat(F.lit("Suite "), (nation + 100).cast("string"))),
        "Practice_City": _choose(k, "Eastmere", "Port Calder", "Wellbrook"),
        "Practice_State": _choose(k, "CA", "CA", "TX"),
        "Practice_ZIP_5digit": _choose(k, "40011", "40022", "40033"),
        "Practice_ZIP_4digit": _choose(k, none, "1234", none),
    }
    return customers(spark, sf_dir).select(k.alias("doc_id"), *[v.alias(n) for n, v in record.items()])


# The right record of each customer's report, in SQL over the customer table.
GOLD_SQL = """
SELECT c_custkey AS doc_id, CAST(2 AS BIGINT) AS total_pages,
  CASE c_custkey % 3 WHEN 0 THEN 'Final Report' WHEN 1 THEN 'Molecular Genetics' ELSE 'Colorectal Sample' END AS report_title,
  CASE WHEN c_custkey % 5 IN (1, 2) THEN CAST(0.8 AS DOUBLE) WHEN c_custkey % 9 <> 0 AND c_custkey % 3 = 2 THEN 0.9 ELSE 0.95 END AS llm_confidence_score,
  CASE c_custkey % 6 WHEN 0 THEN '00' || c_custkey WHEN 1 THEN 'M' || c_custkey WHEN 5 THEN 'R' || c_custkey END AS Patient_MRN,
  first AS Patient_First_Name, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS Patient_Last_Name,
  CAST(DATE '1940-01-01' + CAST(c_custkey * 101 % 20000 AS INTEGER) AS VARCHAR) AS Patient_DOB,
  CASE c_custkey % 5 WHEN 0 THEN 'Tempus' WHEN 1 THEN 'Tempus' WHEN 2 THEN 'Foundation Medicine' WHEN 4 THEN 'NeoGenomics' END AS Vendor_Name,
  CAST(collected AS VARCHAR) AS Collection_Date, CAST(collected + 1 AS VARCHAR) AS Received_Date,
  CASE WHEN c_custkey % 7 IN (0, 1, 2, 6) THEN CAST(collected + 5 AS VARCHAR) END AS Report_Date,
  CASE c_custkey % 2 WHEN 0 THEN 'ABC1 V100F Mutation Analysis' ELSE 'Molecular profiling' END AS Test_Name,
  CASE c_custkey % 4 WHEN 0 THEN 'Quantitative PCR' WHEN 1 THEN 'Next Generation Sequencing | IHC' END AS Procedure,
  first AS Ordering_Provider_First_Name, last AS Ordering_Provider_Last_Name,
  CASE WHEN c_custkey % 3 = 0 THEN '1234567893' END AS Ordering_Provider_NPI,
  CASE c_custkey % 3 WHEN 0 THEN 'M.D.' ELSE 'Dr.' END AS Ordering_Provider_Title,
  CASE WHEN c_custkey % 8 <> 5 THEN 'Nation ' || c_nationkey || ' Oncology Clinic' END AS Practice_Name,
  CAST(NULL AS VARCHAR) AS Practice_NPI,
  c_custkey || CASE c_custkey % 2 WHEN 0 THEN ' Juniper Rd.' ELSE ' Main St.' END AS Practice_Street_Address_1,
  CASE c_custkey % 2 WHEN 0 THEN 'Suite ' || (c_nationkey + 100) END AS Practice_Street_Address_2,
  CASE c_custkey % 3 WHEN 0 THEN 'Eastmere' WHEN 1 THEN 'Port Calder' ELSE 'Wellbrook' END AS Practice_City,
  CASE c_custkey % 3 WHEN 2 THEN 'TX' ELSE 'CA' END AS Practice_State,
  CASE c_custkey % 3 WHEN 0 THEN '40011' WHEN 1 THEN '40022' ELSE '40033' END AS Practice_ZIP_5digit,
  CASE c_custkey % 3 WHEN 1 THEN '1234' END AS Practice_ZIP_4digit
FROM (SELECT *, ['Orven', 'Tilda', 'Mirka', 'Pavo'][c_custkey % 4 + 1] AS first,
             ['Quillon', 'Brandt', 'Osei', 'Lindqvar', 'Farrow'][c_custkey % 5 + 1] AS last,
             DATE '2020-01-01' + CAST(c_custkey * 37 % 1500 AS INTEGER) AS collected FROM customer)"""
