"""Proxy of a book of business: several submissions, organizations, product lines
and requests over the same test tables, with faults in some requests.

Where ``plans.proxy`` samples one submission, here members belong to the
submission of their number and to the line of their segment, requests ask per
submission, line and year, metadata differs by year, and every criterion of
eligibility takes members out.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hybrid_sampling.operators import criteria as CR
from hybrid_sampling.operators import eligibility as E
from hybrid_sampling.plans import proxy as P
from hybrid_sampling.plans.job import Inputs
from hybrid_sampling.sources import control as CT
from hybrid_sampling.sources.extracts import Extract
from hybrid_sampling.sources.readers import local_table

# ---------------------------------------------------------------- fixed values
# submission = organization = run configuration = custkey mod 2 + 1
SUBMISSIONS = 2
# rate bands (floor percent -> sample size), small so that groups are drawn from
BANDS = (("95.00", 6), ("90.00", 9), ("0.00", 15))
# continuous enrollment asked of these members
MIN_MONTHS, ALLOWED_GAPS = 3, 1
# faults: years without RAND for COL (mod 5 = 0), RAND 1.5 for TRC (mod 4 = 1), a
# size of 0 below 90 percent in the Medicaid bands (mod 6 = 4); documents of submission 2 for
# Medicare ask 123456 percent for CBP (mod 3 = 0); submission 1 asks for CBP of Medicaid
# twice (even years); the last year has not passed quality review; submission 2 has
# no source for Commercial in years mod 7 = 5 (run configuration 99)
LOST_RUN_CONFIG = 99
# ------------------------------------------------------------------------------


def _submission(custkey: str):
    return (F.col(custkey) % SUBMISSIONS + 1).cast("bigint")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = P.facts(spark, sf_dir)
    own = (F.col("patient_id") % SUBMISSIONS + 1).cast("bigint")
    return f.withColumns({"submission_id": own, "organization_id": own, "run_config_id": own})


def enrollment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.enrollment(spark, sf_dir).withColumn("submission_id", (F.col("patient_id") % SUBMISSIONS + 1).cast("bigint"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One open request per submission, line and year, over the orders of its members: rates are sums of keys
    mod 101, the oversampling percent is a sum mod 30; and a second request of submission 1 for CBP of Medicaid."""
    o, c = P.table(spark, sf_dir, "orders"), P.table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey).select(
        _submission("o_custkey").alias("sub"),
        P._map("c_mktsegment", P.PRODUCT_LINE_OF_SEGMENT).alias("line"),
        F.year("o_orderdate").cast("int").alias("year"),
        P._map("o_orderpriority", P.MEASURE_OF_PRIORITY).alias("measure"),
        "o_orderkey", "o_custkey",
    )
    g = j.groupBy("sub", "line", "year", "measure").agg(F.sum("o_orderkey").alias("so"), F.sum("o_custkey").alias("sc"))
    overflow = (F.col("sub") == 2) & (F.col("line") == "Medicare") & (F.col("year") % 3 == 0) & (F.col("measure") == "CBP")
    group = F.struct(
        F.col("measure").alias("measureGroup"),
        F.when(overflow, F.lit(123456)).otherwise(F.col("sc") % 30).alias("oversamplingRate"),
        F.array(F.struct(F.concat("measure", F.lit("2")).alias("clinicalSubMeasureId"), (F.col("so") % 101).alias("cyar"), (F.col("sc") % 101).alias("pyr"))).alias("subMeasures"),
    )
    docs = g.groupBy("sub", "line", "year").agg(F.collect_list(group).alias("data"))  # five measures
    own_group = F.when((F.col("sub") == 2) & (F.col("year") % 2 == 1), F.array(F.lit("CBP"), F.lit("COL")))
    named = F.when(F.col("sub") == 2, F.concat(F.lit("CAMPAIGN-"), F.col("year").cast("string")))
    lost = (F.col("sub") == 2) & (F.col("line") == "Commercial") & (F.col("year") % 7 == 5)
    head = [
        F.col("line").alias("productCategory"), F.col("year").alias("measurementYear"), F.col("sub").alias("submissionId"), F.col("sub").alias("organizationId"),
        F.when(lost, F.lit(LOST_RUN_CONFIG)).otherwise(F.col("sub")).alias("runConfigId"), (F.col("sub") == 1).alias("excludeEmp"),
    ]
    name = F.concat_ws("-", F.lit("BOOK"), F.col("sub").cast("string"), "line", F.col("year").cast("string"))
    first = docs.select(name.alias("correlation_id"), F.to_json(F.struct(*head, "data", F.when(F.col("sub") == 2, "QC").alias("domainId"), named.alias("campaignId"), own_group.alias("sharedSampleGroup"))).alias("json_object"))
    again = docs.filter((F.col("sub") == 1) & (F.col("line") == "Medicaid") & (F.col("year") % 2 == 0))
    five = F.transform(F.filter("data", lambda x: x["measureGroup"] == "CBP"), lambda x: x.withField("oversamplingRate", F.lit(5).cast("bigint")))
    second = again.select(F.concat(F.lit("AGAIN-"), name).alias("correlation_id"), F.to_json(F.struct(*head, five.alias("data"))).alias("json_object"))
    both = first.unionByName(second)
    return both.select("correlation_id", F.lit("SAMPLING").alias("request_type"), F.lit("received").alias("campaign_status"), F.lit(0).alias("is_sampling_processed"), "json_object")


def product_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each submission has all lines of its members, but submission 1 lost Medicare in years mod 5 = 3."""
    o, c = P.table(spark, sf_dir, "orders"), P.table(spark, sf_dir, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(
        _submission("o_custkey").alias("submission_id"), F.year("o_orderdate").cast("int").alias("measurement_year"),
        P._map("c_mktsegment", P.PRODUCT_LINE_OF_SEGMENT).alias("product_category"),
    )
    gone = (F.col("submission_id") == 1) & (F.col("product_category") == "Medicare") & (F.col("measurement_year") % 5 == 3)
    return rows.filter(~gone).distinct()


def size_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(line, floor, size) for line in P.SIZE_LINES for floor, size in BANDS]
    t = local_table(spark, rows, [("product_line", "string"), ("rate_floor", "decimal(5,2)"), ("sample_size", "int")])
    t = t.select(P._years(spark, sf_dir), "product_line", "rate_floor", "sample_size")
    nothing = (F.col("product_line") == "Medicaid") & (F.col("measurement_year") % 6 == 4) & (F.col("rate_floor") == 0)
    return t.withColumn("sample_size", F.when(nothing, 0).otherwise(F.col("sample_size")))


def rand_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = P.rand_values(spark, sf_dir)
    r = r.filter(~((F.col("measure_code") == "COL") & (F.col("measurement_year") % 5 == 0)))
    wide = (F.col("measure_code") == "TRC") & (F.col("measurement_year") % 4 == 1)
    return r.withColumn("rand", F.when(wide, F.lit("1.500000").cast("decimal(9,6)")).otherwise(F.col("rand")))


def stage_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = P.years(spark, sf_dir).stop - 1
    st = P.stage_status(spark, sf_dir)
    return st.withColumn("is_complete", F.when(F.col("stage") == "FQR", F.col("measurement_year") != last).otherwise(F.col("is_complete")))


def run_configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run configuration n reads source n."""
    return P.table(spark, sf_dir, "nation").filter("n_nationkey BETWEEN 1 AND 2").select(
        F.col("n_nationkey").cast("bigint").alias("run_config_id"), F.col("n_nationkey").cast("bigint").alias("source_detail_id")
    )


def source_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source 1 is base_data_odd, source 2 base_data_even (by the number of the submission)."""
    return P.table(spark, sf_dir, "nation").filter("n_nationkey BETWEEN 1 AND 2").select(
        F.col("n_nationkey").cast("bigint").alias("source_detail_id"),
        F.when(F.col("n_nationkey") % 2 == 1, "base_data_odd").otherwise("base_data_even").alias("table_name"),
    )


def identified_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members with what identifies a person: segment, nation and the balance in units of 20."""
    c = P.table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("patient_id"), "c_mktsegment", "c_nationkey", F.floor(F.col("c_acctbal") / 20).alias("balance"))


def known_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known before the draw: deceased and hospice members, and duplicates. Data errors are found after it."""
    wide = P.invalid_members(spark, sf_dir).filter(F.col("measure_code").isNull())
    return wide.unionByName(E.duplicate_members(identified_members(spark, sf_dir), ["c_mktsegment", "c_nationkey", "balance"]))


def criteria(spark: SparkSession, sf_dir: str) -> E.Criteria:
    who = P.patients(spark, sf_dir).select("patient_id", "gender", F.col("organization_id").alias("member_org"))
    return E.Criteria(
        members=who,
        rules=P.age_gender_rules(spark),
        spans=enrollment(spark, sf_dir),
        years=tuple(P.years(spark, sf_dir)),
        min_months=MIN_MONTHS,
        allowed_gaps=ALLOWED_GAPS,
        events=P.qualifying_events(spark, sf_dir),
        associations=P.provider_nations(spark, sf_dir).select(F.col("organization_id").alias("member_org")),
        invalid=known_invalid(spark, sf_dir),
    )


# fixed values: the catalogue's rules: least and greatest age, gender, months, gaps, event, association
CATALOGUE = (
    ("CBP", 18, 85, None, 3, 1, "return", True),
    ("COL", 45, 75, None, 4, 0, None, False),
    ("TRC", 18, 64, "F", None, None, "return", None),
    (None, 18, 75, None, 2, 2, "urgent", True),
)
RULE_TYPES = ("string", "int", "int", "string", "int", "int", "string", "boolean")


def measure_criteria(spark: SparkSession, rows=CATALOGUE) -> DataFrame:
    return local_table(spark, rows, list(zip(CR.RULE_COLUMNS, RULE_TYPES, strict=True)))


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Qualifying events: returns, and urgent orders."""
    urgent = P.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return P.qualifying_events(spark, sf_dir).unionByName(
        urgent.select(F.col("o_custkey").alias("patient_id"), F.year("o_orderdate").cast("int").alias("measurement_year"), F.lit("urgent").alias("event_type"))
    )


def catalogue(spark: SparkSession, sf_dir: str, rows=CATALOGUE) -> CR.Catalogue:
    return CR.Catalogue(
        rules=measure_criteria(spark, rows),
        members=P.patients(spark, sf_dir).select("patient_id", "gender", "organization_id"),
        spans=enrollment(spark, sf_dir),
        events=typed_events(spark, sf_dir),
        associations=P.provider_nations(spark, sf_dir),
        invalid=known_invalid(spark, sf_dir),
    )


def extracts(spark: SparkSession, sf_dir: str) -> dict[str, Extract]:
    """Raw extracts: encounters are orders; those of orderkey mod 25 = 0 name a member nobody knows in
    even years and no member in years mod 3 = 0, a 25th each. Claims are the line items by year shipped."""
    o, li = P.table(spark, sf_dir, "orders"), P.table(spark, sf_dir, "lineitem")
    year = F.year("o_orderdate").cast("int")
    odd = F.col("o_orderkey") % 25 == 0
    member = F.when(odd & (year % 3 == 0), F.lit(None)).when(odd & (year % 2 == 0), -1 - F.col("o_custkey")).otherwise(F.col("o_custkey"))
    encounters = o.select(member.alias("patient_id"), year.alias("measurement_year"))
    claims = o.join(li, o.o_orderkey == li.l_orderkey).select(F.col("o_custkey").alias("member"), F.year("l_shipdate").cast("int").alias("served"))
    return {"RE_Encounter": Extract(encounters, max_null_share=0.01, max_orphan_share=0.05), "RE_Claims": Extract(claims, key="member", year="served", min_rows=100)}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    base = facts(spark, sf_dir)
    late = P.invalid_members(spark, sf_dir).filter(F.col("measure_code").isNotNull())
    return replace(
        P.inputs(spark, sf_dir),
        requests=requests(spark, sf_dir),
        size_bands=size_bands(spark, sf_dir),
        rand_values=rand_values(spark, sf_dir),
        product_categories=product_categories(spark, sf_dir),
        facts=base,
        enrollment=enrollment(spark, sf_dir),
        invalid=late,
        approvals=None,
        sample_history=None,
        criteria=criteria(spark, sf_dir),
        stage_status=stage_status(spark, sf_dir),
        required_tables={"base_data": P.table(spark, sf_dir, "orders")},
        run_configuration=run_configuration(spark, sf_dir),
        source_detail=source_detail(spark, sf_dir),
        fact_tables={"base_data_odd": base.filter("submission_id = 1"), "base_data_even": base.filter("submission_id = 2")},
    )


def gate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = inputs(spark, sf_dir)
    return CT.check_prerequisites(inp.stage_status, inp.required_tables)
