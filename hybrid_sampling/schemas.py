"""Explicit schemas (no inference anywhere: an all-null rate would infer as string)."""

from pyspark.sql import types as T

RATE = T.DecimalType(5, 2)
RAND = T.DecimalType(9, 6)

# numbers of a document are read as text and converted when flattened, so that
# one that does not fit is seen (a typed field would silently become null)
SUB_MEASURE = T.StructType(
    [
        T.StructField("clinicalSubMeasureId", T.StringType()),
        T.StructField("cyar", T.StringType()),
        T.StructField("pyr", T.StringType()),
    ]
)
MEASURE_GROUP = T.StructType(
    [
        T.StructField("measureGroup", T.StringType()),
        T.StructField("oversamplingRate", T.StringType()),
        T.StructField("subMeasures", T.ArrayType(SUB_MEASURE)),
    ]
)
REQUEST_DOCUMENT = T.StructType(
    [
        T.StructField("productCategory", T.StringType()),
        T.StructField("measurementYear", T.IntegerType()),
        T.StructField("submissionId", T.LongType()),
        T.StructField("organizationId", T.LongType()),
        T.StructField("runConfigId", T.LongType()),
        T.StructField("excludeEmp", T.BooleanType()),
        T.StructField("data", T.ArrayType(MEASURE_GROUP)),
        # optional: name the output (absent in a document -> null -> defaults)
        T.StructField("domainId", T.StringType()),
        T.StructField("campaignId", T.StringType()),
        # optional: measures the client wants sampled together (overrides metadata groups)
        T.StructField("sharedSampleGroup", T.ArrayType(T.StringType())),
    ]
)
SAMPLING_REQUEST = T.StructType(
    [
        T.StructField("correlation_id", T.StringType()),
        T.StructField("request_type", T.StringType()),
        T.StructField("campaign_status", T.StringType()),
        T.StructField("is_sampling_processed", T.IntegerType()),
        T.StructField("json_object", T.StringType()),
    ]
)
SIZE_INFO = T.StructType(
    [
        T.StructField("measure_code", T.StringType()),
        T.StructField("product_line", T.StringType()),
        T.StructField("measurement_year", T.IntegerType()),
        T.StructField("sample_size", T.IntegerType()),
        T.StructField("oversampling_rate", RATE),
        T.StructField("cyar", T.StringType()),
        T.StructField("pyr", T.StringType()),
    ]
)
SIZE_BANDS = T.StructType(
    [
        T.StructField("measurement_year", T.IntegerType()),
        T.StructField("product_line", T.StringType()),
        T.StructField("rate_floor", RATE),
        T.StructField("sample_size", T.IntegerType()),
    ]
)
RAND_VALUES = T.StructType(
    [
        T.StructField("measure_code", T.StringType()),
        T.StructField("measurement_year", T.IntegerType()),
        T.StructField("rand", RAND),
    ]
)
SAMPLE_OUTPUT = T.StructType(
    [
        T.StructField("submission_id", T.LongType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("run_config_id", T.LongType()),
        T.StructField("domain_id", T.StringType()),
        T.StructField("product_line", T.StringType()),
        T.StructField("measure_code", T.StringType()),
        T.StructField("member_id", T.LongType()),
        T.StructField("visit_id", T.LongType()),
        T.StructField("measurement_year", T.IntegerType()),
        T.StructField("population_rank", T.LongType()),
        T.StructField("sample_order", T.LongType()),
        T.StructField("rand", RAND),
        T.StructField("list_type", T.StringType()),
        T.StructField("is_primary", T.BooleanType()),
        T.StructField("is_excluded", T.BooleanType()),
        T.StructField("exclusion_reason", T.StringType()),
        T.StructField("mrss_actual", T.LongType()),
    ]
)
SAMPLE_SUMMARY = T.StructType(
    [T.StructField("submission_id", T.LongType()), T.StructField("product_line", T.StringType()),
     T.StructField("measure_code", T.StringType()), T.StructField("measurement_year", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in (
        "em", "mrss_actual", "os_actual", "drawn", "primary_drawn", "auxiliary_drawn", "excluded", "replaced", "final_primary", "shortfall")]
)
