"""Request documents: parse the JSON column and flatten it.

All open requests are parsed at once with ``from_json`` on the column (no
driver round trip, no schema inference job).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hybrid_sampling.schemas import REQUEST_DOCUMENT

# fixed value: the largest percent that a request may name
MAX_PERCENT = 100


def percent_of(text: Column) -> Column:
    """Number of a document as decimal(5,2) percent; null when absent, not a
    number, or outside 0 to 100."""
    wide = text.try_cast("decimal(38,6)")
    return F.when((wide >= 0) & (wide <= MAX_PERCENT), wide.cast("decimal(5,2)"))


def bad_numbers(**texts: Column) -> Column:
    """Names of the numbers that are given but not usable, or null when all are."""
    named = [F.when(c.isNotNull() & percent_of(c).isNull(), F.lit(n)) for n, c in texts.items()]
    bad = F.filter(F.array(*named), lambda x: x.isNotNull())
    return F.when(F.size(bad) > 0, F.array_join(bad, ","))


def parse_requests(requests: DataFrame, json_col: str = "json_object", keep=("correlation_id",)) -> DataFrame:
    """S3: JSON text -> nested struct ``doc`` with the fixed request schema."""
    return requests.select(*keep, F.from_json(F.col(json_col), REQUEST_DOCUMENT).alias("doc"))


def flatten_request(parsed: DataFrame, outer: bool = False) -> DataFrame:
    """Measure groups, then sub-measures, to one row per sub-measure.

    Keeps the oversampling percent (no division, D17) and turns excludeEmp into
    0/1. With ``outer`` an empty array keeps its parent row (nulls below it).
    """
    gen = F.explode_outer if outer else F.explode
    g = parsed.select("correlation_id", "doc", gen("doc.data").alias("grp"))
    s = g.select("correlation_id", "doc", "grp", gen("grp.subMeasures").alias("sub"))
    return s.select(
        "correlation_id",
        F.col("doc.productCategory").alias("product_line"),
        F.col("grp.measureGroup").alias("measure_code"),
        F.col("sub.clinicalSubMeasureId").alias("clinical_measure_id"),
        percent_of(F.col("grp.oversamplingRate")).alias("oversampling_rate"),
        F.col("doc.measurementYear").alias("measurement_year"),
        F.col("doc.submissionId").alias("submission_id"),
        percent_of(F.col("sub.cyar")).alias("cyar"),
        percent_of(F.col("sub.pyr")).alias("pyr"),
        F.col("doc.excludeEmp").cast("int").alias("exclude_emp"),
        F.col("doc.organizationId").alias("organization_id"),
        F.col("doc.runConfigId").alias("run_config_id"),
        F.col("doc.domainId").alias("domain_id"),
        F.col("doc.campaignId").alias("campaign_id"),
        F.col("doc.sharedSampleGroup").alias("shared_sample_group"),
        bad_numbers(oversamplingRate=F.col("grp.oversamplingRate"), cyar=F.col("sub.cyar"), pyr=F.col("sub.pyr")).alias("number_error"),
    )


def number_errors(flat: DataFrame) -> DataFrame:
    """Requests with a number that cannot be used: correlation_id and error,
    naming the measures (never a silent default)."""
    named = F.concat(F.col("measure_code"), F.lit(" "), F.col("number_error"))
    return flat.filter(F.col("number_error").isNotNull()).groupBy("correlation_id").agg(
        F.concat(F.lit("number outside 0 to 100: "), F.array_join(F.array_sort(F.collect_set(named)), "; ")).alias("error")
    )


def rejected_submeasures(flat: DataFrame) -> DataFrame:
    """Sub-measure rows without an id, counted per request."""
    return flat.filter(F.col("clinical_measure_id").isNull()).groupBy("correlation_id").agg(F.count(F.lit(1)).cast("bigint").alias("rejected"))
