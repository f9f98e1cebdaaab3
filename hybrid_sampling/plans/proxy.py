"""Proxy views: the sampling tables expressed over the TPC-H-style test tables.

The test data has no healthcare tables, so each entity is a deterministic
projection of a real table (orders -> quality-report facts and visits,
customer -> patients, lineitem -> qualifying events, nation/region/supplier ->
organizations and sources). Every view is lazy and reads the whole table, so
work grows with the data.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hybrid_sampling.sources.readers import local_table

# ---------------------------------------------------------------- fixed values
# order priority -> measure code
MEASURE_OF_PRIORITY = {
    "1-URGENT": "CBP",
    "2-HIGH": "COL",
    "3-MEDIUM": "GSD",
    "4-NOT SPECIFIED": "TRC",
    "5-LOW": "EED",
}
# order status -> clinical status code (2 is not an eligible status)
STATUS_OF_ORDERSTATUS = {"F": 1, "O": 6, "P": 2}
# market segment -> product line
PRODUCT_LINE_OF_SEGMENT = {
    "AUTOMOBILE": "Commercial",
    "BUILDING": "Medicaid",
    "FURNITURE": "Medicare",
    "HOUSEHOLD": "Exchange",
    "MACHINERY": "Commercial",
}
# measure -> (standard sample size, oversampling percent, RAND, grain, shared group)
MEASURE_META = {
    "CBP": (411, "10.00", "0.950000", "member", None),
    "COL": (230, "10.00", "0.750000", "member", None),
    "GSD": (134, "10.00", "0.660000", "member", "GSD-EED"),
    "TRC": (106, "15.00", "0.250000", "visit", None),
    "EED": (134, "10.00", "0.500000", "member", "GSD-EED"),
}
# identifiers of the one proxy submission that is sampled
SUBMISSION_ID, ORGANIZATION_ID, RUN_CONFIG_ID, PRODUCT_LINE = 1, 1, 1, "Commercial"
# birth date rule: 1940-01-01 + (custkey * 7919) mod 25000 days
DOB_ORIGIN, DOB_MULT, DOB_MOD = "1940-01-01", 7919, 25000
# deleted when orderkey mod 20 = 0; employee when custkey mod 50 = 0
DELETED_MOD, EMPLOYEE_MOD = 20, 50
# enrollment span per order: order date .. + 120 days
SPAN_DAYS = 120
OPEN_MOD, FAR_MOD = 41, 43
# ------------------------------------------------------------------------------

GROUP = ["submission_id", "product_line", "measure_code", "measurement_year"]


def _map(col: str, mapping: dict, cast: str | None = None):
    expr = None
    for k, v in mapping.items():
        lit = F.lit(v) if cast is None else F.lit(v).cast(cast)
        expr = F.when(F.col(col) == k, lit) if expr is None else expr.when(F.col(col) == k, lit)
    return expr


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@lru_cache(maxsize=64)
def years(spark: SparkSession, sf_dir: str) -> range:
    """The years of the orders, first to last: the metadata (sizes, bands, RAND,
    periods, the proxy submission's factors) covers these."""
    lo, hi = table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return range(0) if lo is None else range(lo, hi + 1)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality-report facts / base data: one row per order."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderkey").alias("visit_id"),
        _map("o_orderpriority", MEASURE_OF_PRIORITY).alias("measure_code"),
        _map("o_orderpriority", MEASURE_OF_PRIORITY).alias("clinical_measure_id"),
        _map("o_orderstatus", STATUS_OF_ORDERSTATUS, "int").alias("clinical_status_code"),
        F.when(F.col("o_orderkey") % DELETED_MOD == 0, 1).otherwise(0).alias("is_deleted"),
        F.lit(RUN_CONFIG_ID).cast("bigint").alias("run_config_id"),
        F.lit(ORGANIZATION_ID).cast("bigint").alias("organization_id"),
        F.lit(SUBMISSION_ID).cast("bigint").alias("submission_id"),
        F.year("o_orderdate").cast("bigint").alias("reporting_period_id"),
        F.year("o_orderdate").cast("int").alias("measurement_year"),
        F.col("o_orderdate").cast("date").alias("event_date"),
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("patient_id"),
        F.col("c_mktsegment").alias("last_name"),
        F.col("c_name").alias("first_name"),
        F.date_add(F.lit(DOB_ORIGIN).cast("date"), ((F.col("c_custkey") * DOB_MULT) % DOB_MOD).cast("int")).alias("date_of_birth"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        _map("c_mktsegment", PRODUCT_LINE_OF_SEGMENT).alias("product_line"),
        F.col("c_nationkey").cast("bigint").alias("organization_id"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The patients without their line: the one proxy submission of the sampling
    chain holds them all."""
    return patients(spark, sf_dir).drop("product_line")


def enrollment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member enrollment spans, one per order, with the employee flag. Spans of
    orders with orderkey mod 41 = 0 have no end, with orderkey mod 43 = 0 the
    far end 9999-12-31."""
    o = table(spark, sf_dir, "orders")
    start = F.col("o_orderdate").cast("date")
    return o.select(
        F.col("o_custkey").alias("patient_id"),
        F.lit(SUBMISSION_ID).cast("bigint").alias("submission_id"),
        F.when(F.col("o_custkey") % EMPLOYEE_MOD == 0, 1).otherwise(0).alias("is_employee"),
        start.alias("span_start"),
        F.when(F.col("o_orderkey") % OPEN_MOD == 0, F.lit(None))
        .when(F.col("o_orderkey") % FAR_MOD == 0, F.lit("9999-12-31").cast("date"))
        .otherwise(F.date_add(start, SPAN_DAYS))
        .alias("span_end"),
    )


def reporting_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reporting periods (metadata): one calendar-year period per year of the
    orders, id = year."""
    ys = years(spark, sf_dir)
    df = spark.range(ys.start, ys.stop).select(F.col("id").alias("reporting_period_id"), F.col("id").cast("int").alias("y"))
    return df.select(
        "reporting_period_id",
        F.make_date(F.col("y"), F.lit(1), F.lit(1)).alias("period_start"),
        F.make_date(F.col("y"), F.lit(12), F.lit(31)).alias("period_end"),
    )


def measure_meta(spark: SparkSession) -> DataFrame:
    rows = [(m, g, s) for m, (_, _, _, g, s) in MEASURE_META.items()]
    return local_table(spark, rows, [("measure_code", "string"), ("grain", "string"), ("shared_group", "string")])


def measure_classification(spark: SparkSession) -> DataFrame:
    rows = [(m, "Hybrid") for m in MEASURE_META] + [("ABA", "Admin"), ("BCS", "Admin")]
    return local_table(spark, rows, [("clinical_measure_id", "string"), ("classification_value", "string")])


def measure_sizes(spark: SparkSession) -> DataFrame:
    """Per measure: mrss, os_pct, rand, grain and shared group (one local table)."""
    rows = [(m, mrss, os, r, g, sg) for m, (mrss, os, r, g, sg) in MEASURE_META.items()]
    cols = [("measure_code", "string"), ("mrss", "int"), ("os_pct", "decimal(5,2)"), ("rand", "decimal(9,6)"), ("grain", "string"), ("shared_group", "string")]
    return local_table(spark, rows, cols)


def sampling_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling factors of the proxy submission (request metadata): one row per
    measure and year of the orders, with the measure's sizes, RAND, grain and
    group. Years without eligible members simply draw nothing."""
    out = measure_sizes(spark).select("*", _years(spark, sf_dir))
    return out.select(
        F.lit(SUBMISSION_ID).cast("bigint").alias("submission_id"),
        F.lit(PRODUCT_LINE).alias("product_line"),
        "measure_code",
        F.col("measurement_year").cast("int").alias("measurement_year"),
        F.lit(RUN_CONFIG_ID).cast("bigint").alias("run_config_id"),
        F.lit(ORGANIZATION_ID).cast("bigint").alias("organization_id"),
        "mrss",
        "os_pct",
        "rand",
        F.lit(True).alias("exclude_emp"),
        "grain",
        "shared_group",
    )


# ------------------------------------------------------------ request proxies
# fixed values: request document rules
#   one request per customer and order year; submission = customer, organization
#   and run configuration = nation; sub-measure id = measure || (orderkey mod 2 + 1),
#   null when orderkey mod 97 = 0; cyar = orderkey mod 101 (null when orderkey mod 7 = 0);
#   pyr = custkey mod 101 (null when custkey mod 5 = 0), each the lowest over the
#   sub-measure's orders; oversampling percent =
#   custkey mod 26 (null when custkey mod 13 = 0); excludeEmp when custkey is even;
#   requests before 1997 are already processed; MACHINERY requests in even years are audits
PROCESSED_BEFORE_YEAR = 1997
SIZE_LINES = ("Commercial", "Medicaid", "Medicare")
EXCHANGE_MOD = 11
# rate bands (floor percent -> sample size), the same for every year and line
BANDS = (("95.00", 106), ("90.00", 134), ("0.00", 296))


def _year():
    return F.year("o_orderdate").cast("int")


def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat sub-measure rows, the content the request documents are built from:
    one row per request, measure group and sub-measure id, with the lowest
    CYAR and PYR of its orders (partial aggregation, so a document holds at
    most five groups of three sub-measures however many orders a customer has)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    measure = _map("o_orderpriority", MEASURE_OF_PRIORITY)
    sub_id = F.when(F.col("o_orderkey") % 97 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(measure, (F.col("o_orderkey") % 2 + 1).cast("string"))
    )
    rows = j.select(
        F.concat(F.lit("REQ-"), F.col("c_custkey").cast("string"), F.lit("-"), _year().cast("string")).alias("correlation_id"),
        _map("c_mktsegment", PRODUCT_LINE_OF_SEGMENT).alias("product_line"),
        measure.alias("measure_code"),
        sub_id.alias("clinical_measure_id"),
        F.when(F.col("c_custkey") % 13 == 0, F.lit(None)).otherwise(F.col("c_custkey") % 26).cast("decimal(5,2)").alias("oversampling_rate"),
        _year().alias("measurement_year"),
        F.col("c_custkey").alias("submission_id"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderkey") % 101).cast("decimal(5,2)").alias("cyar"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None)).otherwise(F.col("c_custkey") % 101).cast("decimal(5,2)").alias("pyr"),
        (F.col("c_custkey") % 2 == 0).alias("exclude_emp"),
        F.col("c_nationkey").cast("bigint").alias("organization_id"),
        F.col("c_nationkey").cast("bigint").alias("run_config_id"),
        F.col("c_mktsegment").alias("_segment"),
    )
    keys = [c for c in rows.columns if c not in ("cyar", "pyr")]
    # dealt by request once: the groupings by sub-measure, measure and request all stay in place
    return rows.repartition("correlation_id").groupBy(*keys).agg(F.min("cyar").alias("cyar"), F.min("pyr").alias("pyr"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling request table with the JSON document as text (``json_object``).

    Documents are built by two grouping steps (measure group, then request)
    over the pre-aggregated sub-measure rows, so each collected list is
    bounded by the code set (sub-measure ids per measure, measures per request).
    """
    r = request_rows(spark, sf_dir)
    head = ["correlation_id", "product_line", "measurement_year", "submission_id", "organization_id", "run_config_id", "exclude_emp", "_segment"]
    groups = r.groupBy(*head, "measure_code").agg(
        F.max("oversampling_rate").alias("oversamplingRate"),
        F.collect_list(F.struct(F.col("clinical_measure_id").alias("clinicalSubMeasureId"), "cyar", "pyr")).alias("subMeasures"),
    )
    docs = groups.groupBy(*head).agg(
        F.collect_list(F.struct(F.col("measure_code").alias("measureGroup"), "oversamplingRate", "subMeasures")).alias("data")
    )
    doc = F.struct(
        F.col("product_line").alias("productCategory"),
        F.col("measurement_year").alias("measurementYear"),
        F.col("submission_id").alias("submissionId"),
        F.col("organization_id").alias("organizationId"),
        F.col("run_config_id").alias("runConfigId"),
        F.col("exclude_emp").alias("excludeEmp"),
        "data",
    )
    processed = F.col("measurement_year") < PROCESSED_BEFORE_YEAR
    return docs.select(
        "correlation_id",
        F.when((F.col("_segment") == "MACHINERY") & (F.col("measurement_year") % 2 == 0), "AUDIT").otherwise("SAMPLING").alias("request_type"),
        F.when(processed, "PROCESSED").otherwise("received").alias("campaign_status"),
        F.when(processed, 1).otherwise(0).alias("is_sampling_processed"),
        F.to_json(doc).alias("json_object"),
    )


def product_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan product-category view: one row per order (duplicates on purpose).
    Customers with custkey mod 11 = 0 are on the exchange there, whatever their
    requests say."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    category = F.when(F.col("c_custkey") % EXCHANGE_MOD == 0, "Exchange").otherwise(_map("c_mktsegment", PRODUCT_LINE_OF_SEGMENT))
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_custkey").alias("submission_id"), _year().alias("measurement_year"), category.alias("product_category")
    )


def _years(spark: SparkSession, sf_dir: str):
    return F.explode(F.array(*[F.lit(y) for y in years(spark, sf_dir)]).cast("array<int>")).alias("measurement_year")


def size_info_rows():
    """Size metadata by rule, per measure and line (every year of the range):
    all but EED/Medicare; COL/Medicare has no CYAR flag and CBP/Medicaid no PYR flag."""
    rows = []
    for m, (mrss, os_pct, _, _, _) in MEASURE_META.items():
        for pl in SIZE_LINES:
            if (m, pl) == ("EED", "Medicare"):
                continue
            cy = None if (m, pl) == ("COL", "Medicare") else "CYAR"
            py = None if (m, pl) == ("CBP", "Medicaid") else "PYR"
            rows.append((m, pl, mrss, os_pct, cy, py))
    return rows


def size_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [("measure_code", "string"), ("product_line", "string"), ("sample_size", "int"),
            ("oversampling_rate", "decimal(5,2)"), ("cyar", "string"), ("pyr", "string")]
    t = local_table(spark, size_info_rows(), cols)
    return t.select("measure_code", "product_line", _years(spark, sf_dir), "sample_size", "oversampling_rate", "cyar", "pyr")


def size_band_rows():
    return [(pl, floor, size) for pl in SIZE_LINES for floor, size in BANDS]


def size_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [("product_line", "string"), ("rate_floor", "decimal(5,2)"), ("sample_size", "int")]
    t = local_table(spark, size_band_rows(), cols)
    return t.select(_years(spark, sf_dir), "product_line", "rate_floor", "sample_size")


def rand_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(m, r) for m, (_, _, r, _, _) in MEASURE_META.items()]
    t = local_table(spark, rows, [("measure_code", "string"), ("rand", "decimal(9,6)")])
    return t.select("measure_code", _years(spark, sf_dir), "rand")


def os_approvals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approved oversampling above the cap: (submission, measure) of fulfilled
    orders of customers with a balance above 5000."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey).filter((F.col("o_orderstatus") == "F") & (F.col("c_acctbal") > 5000))
    return j.select(F.col("o_custkey").alias("submission_id"), _map("o_orderpriority", MEASURE_OF_PRIORITY).alias("measure_code")).distinct()


# ------------------------------------------------------------ eligibility proxies
# fixed values: age / gender rules per measure (TRC stands in for a women-only measure)
AGE_GENDER_RULES = (
    ("CBP", 18, 85, None),
    ("COL", 45, 75, None),
    ("GSD", 18, 75, None),
    ("TRC", 18, 64, "F"),
    ("EED", 18, 75, None),
)
# fixed values: invalid members
#   deceased: negative account balance; hospice: custkey mod 37 = 0 (all measures)
#   data error: pending order with orderkey mod 50 = 0 (that order's measure only)
HOSPICE_MOD, DATA_ERROR_MOD = 37, 50
PROVIDER_BALANCE = 7000


def age_gender_rules(spark: SparkSession) -> DataFrame:
    return local_table(spark, list(AGE_GENDER_RULES), [("measure_code", "string"), ("min_age", "int"), ("max_age", "int"), ("rule_gender", "string")])


def qualifying_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Qualifying events: orders with a returned line item (patient, year)."""
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select("l_orderkey")
    o = table(spark, sf_dir, "orders")
    return o.join(li, o.o_orderkey == li.l_orderkey, "left_semi").select(
        F.col("o_custkey").alias("patient_id"), _year().alias("measurement_year"), F.lit("return").alias("event_type")
    )


def provider_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider associations: organizations (nations) with a supplier whose balance is above 7000."""
    return table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > PROVIDER_BALANCE).select(F.col("s_nationkey").cast("bigint").alias("organization_id"))


def invalid_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    none = F.lit(None).cast("string")
    # one customer scan: each member's member-wide reasons as an array, exploded
    reasons = F.array(F.when(F.col("c_acctbal") < 0, F.lit("deceased")), F.when(F.col("c_custkey") % HOSPICE_MOD == 0, F.lit("hospice")))
    member_wide = c.select(F.col("c_custkey").alias("patient_id"), F.explode(F.filter(reasons, lambda r: r.isNotNull())).alias("reason"))
    member_wide = member_wide.select("patient_id", none.alias("measure_code"), "reason")
    err = o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % DATA_ERROR_MOD == 0)).select(
        F.col("o_custkey").alias("patient_id"), _map("o_orderpriority", MEASURE_OF_PRIORITY).alias("measure_code"), F.lit("data error").alias("reason")
    )
    return member_wide.unionByName(err)


# ------------------------------------------------------------------ control proxies
def sample_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions and years already sampled by an earlier run: urgent
    fulfilled orders (customer, year)."""
    o = table(spark, sf_dir, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    return o.select(F.col("o_custkey").alias("submission_id"), _year().alias("measurement_year")).distinct()


def run_configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run configuration per nation -> source detail per region."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("bigint").alias("run_config_id"), F.col("n_regionkey").cast("bigint").alias("source_detail_id"))


def source_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(
        F.col("r_regionkey").cast("bigint").alias("source_detail_id"),
        F.concat(F.lit("base_data_lck_"), F.lower(F.regexp_replace("r_name", " ", "_"))).alias("table_name"),
    )


def stage_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upstream stage status per year: MP done when the year has orders, PP
    when line items shipped in the year, FQR when every order of the year has
    a line item."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", _year().alias("y"))
    li = table(spark, sf_dir, "lineitem")
    shipped = li.select(F.year("l_shipdate").cast("int").alias("y")).distinct().withColumn("_pp", F.lit(True))
    has_li = li.select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("_li", F.lit(True))
    per_year = o.join(has_li, "o_orderkey", "left").groupBy("y").agg(
        (F.count(F.lit(1)) > 0).alias("mp"), F.bool_and(F.coalesce(F.col("_li"), F.lit(False))).alias("fqr")
    )
    per_year = per_year.join(shipped, "y", "left").withColumn("pp", F.coalesce(F.col("_pp"), F.lit(False)))
    return per_year.select(
        F.col("y").alias("measurement_year"),
        F.explode(F.array(
            F.struct(F.lit("MP").alias("stage"), F.col("mp").alias("is_complete")),
            F.struct(F.lit("PP").alias("stage"), F.col("pp").alias("is_complete")),
            F.struct(F.lit("FQR").alias("stage"), F.col("fqr").alias("is_complete")),
        )).alias("s"),
    ).select("s.stage", "measurement_year", "s.is_complete")


def delivery_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery events: line items of urgent and high orders by the day they were shipped, many per visit."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    li = table(spark, sf_dir, "lineitem")
    return o.join(li, o.o_orderkey == li.l_orderkey).select(
        F.col("o_custkey").alias("patient_id"), F.col("o_orderkey").alias("visit_id"), F.col("l_shipdate").cast("date").alias("event_date")
    )


def inpatient_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inpatient stays: one per line item, from the day it was shipped, for partkey mod 20 days; partkeys mod 31 = 0 have no discharge."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    out = F.when(F.col("l_partkey") % 31 != 0, F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_partkey") % 20).cast("int")))
    return o.join(li, o.o_orderkey == li.l_orderkey).select(
        F.col("o_custkey").alias("patient_id"), F.col("o_orderkey").alias("visit_id"), F.col("l_shipdate").cast("date").alias("admit_date"), out.alias("discharge_date")
    )


def inputs(spark: SparkSession, sf_dir: str):
    """All proxy tables as inputs of the whole job."""
    from hybrid_sampling.plans.job import Inputs

    return Inputs(
        requests=requests(spark, sf_dir),
        size_info=size_info(spark, sf_dir),
        size_bands=size_bands(spark, sf_dir),
        rand_values=rand_values(spark, sf_dir),
        product_categories=product_categories(spark, sf_dir),
        classification=measure_classification(spark),
        periods=reporting_periods(spark, sf_dir),
        facts=facts(spark, sf_dir),
        enrollment=enrollment(spark, sf_dir),
        patients=patients(spark, sf_dir),
        invalid=invalid_members(spark, sf_dir),
        measure_meta=measure_meta(spark),
        approvals=os_approvals(spark, sf_dir),
        sample_history=sample_history(spark, sf_dir),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit dimension: orders with orderkey mod 3 <> 0, custkey mod 25 as the
    facility and the priority as the type."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 3 != 0)
    return o.select(F.col("o_orderkey").alias("visit_id"), (F.col("o_custkey") % 25).cast("bigint").alias("facility_id"), F.col("o_orderpriority").alias("visit_type"))


def discharge_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit / discharge dates: one row per line item (ship date), many per visit."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("visit_id"), F.col("l_shipdate").cast("date").alias("event_date"))
