"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each key checks one or more operators of the inventory on the proxy views; the
matching DuckDB statement is in ``plans.oracle.SQL``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hybrid_sampling import schemas as SC
from hybrid_sampling.operators import draw as D
from hybrid_sampling.operators import eligibility as E
from hybrid_sampling.operators import episodes as EP
from hybrid_sampling.operators import factors as FA
from hybrid_sampling.operators import replacement as R
from hybrid_sampling.operators import request as RQ
from hybrid_sampling.operators import sizes as SZ
from hybrid_sampling.plans import book as BK
from hybrid_sampling.plans import job as PL
from hybrid_sampling.plans import proxy as P
from hybrid_sampling.plans import sampling as S
from hybrid_sampling.session import scratch_path
from hybrid_sampling.sources import control as CT
from hybrid_sampling.sources import sinks as SK
from hybrid_sampling.sources.extracts import extract_checks
from hybrid_sampling.sources.snapshot import Snapshot, gate_state
from hybrid_sampling.sources.staging import stage

GROUP = S.GROUP
UNIT = GROUP + ["patient_id", "visit_id"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _checked_types(df: DataFrame) -> DataFrame:
    """Checked outputs show exact decimals as doubles (the same nearest double
    in Spark and DuckDB) and dates as ISO text (yyyy-MM-dd in both), so value
    hashes do not depend on how a client maps those types. Computation inside
    stays decimal and date."""
    def show(f):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[show(f) for f in df.schema.fields])


def register(name: str):
    def deco(fn: Query) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _checked_types(fn(spark, sf_dir))

        query.__name__, query.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = query
        return fn

    return deco


@register("eligible_member")
def q_eligible_member(spark, sf_dir):
    return S.population(S.Run(spark, sf_dir)).select(*UNIT, "event_date", "last_name", "first_name", "date_of_birth")


@register("rank_even")
def q_rank_even(spark, sf_dir):
    r = S.ranked(S.Run(spark, sf_dir)).filter(F.col("measurement_year") % 2 == 0)
    return r.select(*UNIT, "population_rank")


@register("rank_odd")
def q_rank_odd(spark, sf_dir):
    r = S.ranked(S.Run(spark, sf_dir)).filter(F.col("measurement_year") % 2 == 1)
    return r.select(*UNIT, "population_rank")


@register("rank_large")
def q_rank_large(spark, sf_dir):
    # many more range partitions than groups' worth of rows per task: every
    # group is cut into several pieces, which is the large-group path
    n = 64
    return S.ranked(S.Run(spark, sf_dir), num_partitions=n).select(*UNIT, "population_rank", "em")


@register("plan_scenarios")
def q_plan_scenarios(spark, sf_dir):
    return S.plans(S.Run(spark, sf_dir)).select(
        *GROUP, "em", "mrss", "os_pct", "fss", "scenario", "n_interval", "start_pos", "rand", "mrss_actual", "os_actual", "sample_total"
    )


@register("sample_positions")
def q_sample_positions(spark, sf_dir):
    return D.sample_positions(S.plans(S.Run(spark, sf_dir)), GROUP)


@register("sample_draw")
def q_sample_draw(spark, sf_dir):
    return S.drawn(S.Run(spark, sf_dir)).select(*UNIT, "population_rank", "sample_order", "list_type")


# ------------------------------------------------------------- request and rates

FLAT_COLS = [
    "correlation_id", "product_line", "measure_code", "clinical_measure_id", "oversampling_rate", "measurement_year",
    "submission_id", "cyar", "pyr", "exclude_emp", "organization_id", "run_config_id",
]
KEY = ["correlation_id", "measure_code"]


def flat_requests(spark, sf_dir):
    return RQ.flatten_request(RQ.parse_requests(P.requests(spark, sf_dir)))


def gated(spark, sf_dir):
    r = FA.drop_product_lines(FA.drop_submeasures(FA.invert_rates(flat_requests(spark, sf_dir))))
    r = FA.attach_product_category(FA.attach_size_info(r, P.size_info(spark, sf_dir)), P.product_categories(spark, sf_dir))
    return FA.gate_rates(r)


def resolved(spark, sf_dir, mode="least"):
    return FA.resolve_factors(gated(spark, sf_dir), mode)


def sized(spark, sf_dir):
    f = SZ.size_for_rate(resolved(spark, sf_dir), P.size_bands(spark, sf_dir))
    f = SZ.default_mrss(f)
    f = SZ.check_oversampling(f, P.os_approvals(spark, sf_dir))
    return SZ.final_sizes(f)


@register("request_flatten")
def q_request_flatten(spark, sf_dir):
    return flat_requests(spark, sf_dir).select(*FLAT_COLS)


@register("rates_invert_gate")
def q_rates_invert_gate(spark, sf_dir):
    return gated(spark, sf_dir).select(
        *KEY, "clinical_measure_id", "product_line", "measurement_year", "submission_id", "cyar", "pyr",
        "info_sample_size", "info_os_pct", "cyar_used", "pyr_used",
    )


@register("rates_lowest")
def q_rates_lowest(spark, sf_dir):
    return resolved(spark, sf_dir, "least").select(*FA.FACTOR_KEYS, "min_cyar", "min_pyr", "rate")


@register("rates_coalesce")
def q_rates_coalesce(spark, sf_dir):
    return resolved(spark, sf_dir, "coalesce").select(*FA.FACTOR_KEYS, "min_cyar", "min_pyr", "rate")


@register("rates_shared")
def q_rates_shared(spark, sf_dir):
    f = FA.shared_rate(resolved(spark, sf_dir), P.measure_meta(spark))
    return f.select(*KEY, "shared_group", "rate", "shared_rate")


@register("mrss_band")
def q_mrss_band(spark, sf_dir):
    f = SZ.size_for_rate(resolved(spark, sf_dir), P.size_bands(spark, sf_dir))
    return f.select(*KEY, "product_line", "measurement_year", "rate", "mrss_band")


@register("mrss_default")
def q_mrss_default(spark, sf_dir):
    f = SZ.default_mrss(SZ.size_for_rate(resolved(spark, sf_dir), P.size_bands(spark, sf_dir)))
    return f.select(*KEY, "rate", "mrss_band", "info_sample_size", "mrss")


@register("os_cap")
def q_os_cap(spark, sf_dir):
    f = SZ.check_oversampling(resolved(spark, sf_dir), P.os_approvals(spark, sf_dir))
    return f.select(*KEY, "oversampling_rate", "info_os_pct", "os_requested", "os_capped", "os_pct")


@register("fss_ceiling")
def q_fss_ceiling(spark, sf_dir):
    return sized(spark, sf_dir).select(*KEY, "mrss", "os_pct", "fss")


# ------------------------------------------------------------------ eligibility
@register("eligible_visit")
def q_eligible_visit(spark, sf_dir):
    pop = S.population(S.Run(spark, sf_dir))
    return pop.filter(F.col("grain") == "visit").select(*UNIT, "event_date")


@register("eligible_counts")
def q_eligible_counts(spark, sf_dir):
    return E.eligible_counts(S.population(S.Run(spark, sf_dir)), GROUP)


@register("valid_line")
def q_valid_line(spark, sf_dir):
    return E.valid_product_line(P.patients(spark, sf_dir)).select("patient_id", "product_line")


@register("age_gender")
def q_age_gender(spark, sf_dir):
    pop = S.population(S.Run(spark, sf_dir)).join(P.patients(spark, sf_dir).select("patient_id", "gender"), "patient_id")
    return E.age_gender(pop, P.age_gender_rules(spark)).select(*UNIT, "gender", "age")


@register("requested_measures")
def q_requested_measures(spark, sf_dir):
    """P8 + E5: facts of the measures that open requests name, with the measure's grain and group."""
    named = RQ.flatten_request(RQ.parse_requests(CT.open_requests(P.requests(spark, sf_dir))))
    f = E.requested_only(P.facts(spark, sf_dir), named)
    return E.attach_measure(f, P.measure_meta(spark)).select("patient_id", "visit_id", "measure_code", "grain", "shared_group")


@register("visit_attributes")
def q_visit_attributes(spark, sf_dir):
    """Visits with the facility of the visit dimension, where it knows them."""
    visits = P.facts(spark, sf_dir).select("patient_id", "visit_id", "measure_code")
    return E.attach_visit(visits, P.visits(spark, sf_dir), ("facility_id", "visit_type"))


@register("enrolled_months")
def q_enrolled_months(spark, sf_dir):
    return E.enrolled_months(P.enrollment(spark, sf_dir), P.years(spark, sf_dir), min_months=3, allowed_gaps=1)


@register("with_event")
def q_with_event(spark, sf_dir):
    pop = S.population(S.Run(spark, sf_dir))
    ev = P.qualifying_events(spark, sf_dir)
    return E.with_event(pop, ev, ("patient_id", "measurement_year")).select(*UNIT)


@register("with_association")
def q_with_association(spark, sf_dir):
    pop = S.population(S.Run(spark, sf_dir)).join(P.patients(spark, sf_dir).select("patient_id", F.col("organization_id").alias("member_org")), "patient_id")
    prov = P.provider_nations(spark, sf_dir).select(F.col("organization_id").alias("member_org"))
    return E.with_association(pop, prov, "member_org").select(*UNIT)


@register("exclusions")
def q_exclusions(spark, sf_dir):
    f = E.flag_exclusions(S.population(S.Run(spark, sf_dir)), P.invalid_members(spark, sf_dir))
    return f.filter(F.col("is_excluded")).select(*UNIT, "exclusion_reason")


# ------------------------------------------------------------ replacement, sharing


@register("replace_excluded")
def q_replace_excluded(spark, sf_dir):
    return S.final(S.Run(spark, sf_dir)).select(
        *UNIT, "sample_order", "list_type", "is_excluded", "exclusion_reason", "final_list", "replaces_order", "shortfall"
    )


@register("shared_sample")
def q_shared_sample(spark, sf_dir):
    return S.shared_drawn(S.Run(spark, sf_dir)).select(*S.SHARED, "measure_code", "patient_id", "population_rank", "sample_order", "list_type")


@register("spread_exclusions")
def q_spread_exclusions(spark, sf_dir):
    return R.spread_exclusions(P.invalid_members(spark, sf_dir), P.measure_meta(spark))


@register("sample_output")
def q_sample_output(spark, sf_dir):
    return R.to_output(S.final(S.Run(spark, sf_dir)))


@register("sample_summary")
def q_sample_summary(spark, sf_dir):
    return R.sample_summary(S.final(S.Run(spark, sf_dir)), GROUP)


# ------------------------------------------------------------------ control

REQ_COLS = ["correlation_id", "request_type", "campaign_status", "is_sampling_processed"]


def parsed_open(spark, sf_dir):
    req = CT.open_requests(P.requests(spark, sf_dir))
    doc = RQ.parse_requests(req)
    return doc.select(
        "correlation_id",
        F.col("doc.submissionId").alias("submission_id"),
        F.col("doc.measurementYear").alias("measurement_year"),
        F.col("doc.runConfigId").alias("run_config_id"),
    )


def outcomes(spark, sf_dir):
    """A request succeeds when its document resolves to at least one factor."""
    ok = resolved(spark, sf_dir).select("correlation_id").distinct().withColumn("_ok", F.lit(True))
    o = CT.open_requests(P.requests(spark, sf_dir)).select("correlation_id").join(ok, "correlation_id", "left")
    ok_col = F.coalesce(F.col("_ok"), F.lit(False))
    return o.select("correlation_id", ok_col.alias("succeeded"), F.when(~ok_col, F.lit("no sampling factors resolved")).alias("message"))


@register("open_requests")
def q_open_requests(spark, sf_dir):
    return CT.open_requests(P.requests(spark, sf_dir)).select(*REQ_COLS)


@register("not_yet_sampled")
def q_not_yet_sampled(spark, sf_dir):
    return CT.not_yet_sampled(parsed_open(spark, sf_dir), P.sample_history(spark, sf_dir)).select("correlation_id", "submission_id", "measurement_year")


@register("close_requests")
def q_close_requests(spark, sf_dir):
    return CT.close_requests(P.requests(spark, sf_dir), outcomes(spark, sf_dir)).select(*REQ_COLS)


@register("failure_rows")
def q_failure_rows(spark, sf_dir):
    return CT.failure_rows(outcomes(spark, sf_dir))


@register("resolve_sources")
def q_resolve_sources(spark, sf_dir):
    s = CT.resolve_sources(parsed_open(spark, sf_dir), P.run_configuration(spark, sf_dir), P.source_detail(spark, sf_dir))
    return s.select("correlation_id", "run_config_id", "source_detail_id", "table_name")


@register("prerequisites")
def q_prerequisites(spark, sf_dir):
    tables = {
        "sampling_request": P.table(spark, sf_dir, "orders").join(P.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")),
        "size_info": P.size_info(spark, sf_dir),
        "size_bands": P.size_bands(spark, sf_dir),
        "rand_values": P.rand_values(spark, sf_dir),
        "base_data": P.facts(spark, sf_dir),
    }
    return CT.check_prerequisites(P.stage_status(spark, sf_dir), tables)


# ------------------------------------------------------------------ sinks
FACT_COLS = ["patient_id", "visit_id", "measure_code", "clinical_status_code", "is_deleted", "measurement_year", "event_date"]


@register("freeze_roundtrip")
def q_freeze_roundtrip(spark, sf_dir):
    return SK.freeze(P.facts(spark, sf_dir).select(*FACT_COLS), scratch_path(spark, "frozen-base"))


@register("write_sample_roundtrip")
def q_write_sample_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "sample")
    SK.write_sample(R.to_output(S.final(S.Run(spark, sf_dir))), root)
    return SK.read_sample(spark, root, SC.SAMPLE_OUTPUT)


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "summary-csv")
    SK.write_csv(R.sample_summary(S.final(S.Run(spark, sf_dir)), GROUP), path)
    return SK.read_csv(spark, path, SC.SAMPLE_SUMMARY)


# ------------------------------------------------------------------ whole job


@register("sample_all")
def q_sample_all(spark, sf_dir):
    run = S.Run(spark, sf_dir)
    inp = replace(P.inputs(spark, sf_dir), patients=P.members(spark, sf_dir))
    f = PL.sample_all(inp, run.factors, groups_bound=run.groups_bound)
    return f.select(
        *UNIT, "sampled_as", "population_rank", "sample_order", "list_type", "is_excluded", "exclusion_reason",
        "final_list", "replaces_order", "shortfall",
    )


# ------------------------------------------- several submissions, lines and requests


def book_factors(spark, sf_dir):
    inp = PL.with_open_requests(BK.inputs(spark, sf_dir))
    factors, errors = PL.split_errors(inp, stage(PL.resolve_factors(inp), "book-factors"))
    return inp, stage(factors, "book-to-sample"), errors


@register("book_factors")
def q_book_factors(spark, sf_dir):
    """Factors of the requests that can be sampled."""
    _, f, _ = book_factors(spark, sf_dir)
    return f.select("correlation_id", *GROUP, "shared_group", "rate", "shared_rate", "mrss", "os_pct", "fss", "rand", "exclude_emp", "domain_id", "campaign_id")


@register("book_errors")
def q_book_errors(spark, sf_dir):
    """What is wrong with the others: conflicts, sizes, RAND, numbers, the gate, sources."""
    _, _, errors = book_factors(spark, sf_dir)
    return errors.select("correlation_id", "error")


@register("eligible_full")
def q_eligible_full(spark, sf_dir):
    """Eligible units after every criterion."""
    inp, f, _ = book_factors(spark, sf_dir)
    return PL.eligible_units(inp, PL.source_facts(inp, f), f).select(*UNIT, "event_date")


@register("eligible_catalogue")
def q_eligible_catalogue(spark, sf_dir):
    """G1-G6, E15, E16 by stored rules: each measure asks for its own age, gender, months, gaps, event and association."""
    inp, f, _ = book_factors(spark, sf_dir)
    inp = replace(inp, criteria=None, catalogue=BK.catalogue(spark, sf_dir))
    return PL.eligible_units(inp, PL.source_facts(inp, f), f).select(*UNIT, "event_date")


@register("delivery_episodes")
def q_delivery_episodes(spark, sf_dir):
    """Delivery events more than 45 days apart are deliveries of their own."""
    return EP.delivery_episodes(P.delivery_events(spark, sf_dir), gap_days=45)


@register("discharge_episodes")
def q_discharge_episodes(spark, sf_dir):
    """Stays that follow each other within a day are one, with its last discharge."""
    return EP.discharge_episodes(P.inpatient_stays(spark, sf_dir), transfer_days=1)


@register("extract_checks")
def q_extract_checks(spark, sf_dir):
    """Raw extracts by year, and which of them are sound enough to sample from."""
    years = P.stage_status(spark, sf_dir).select("measurement_year")
    return extract_checks(BK.extracts(spark, sf_dir), P.patients(spark, sf_dir), years)


@register("ready_years")
def q_ready_years(spark, sf_dir):
    """The years that stages, tables and raw extracts let through."""
    inp = replace(BK.inputs(spark, sf_dir), extracts=BK.extracts(spark, sf_dir))
    return PL.checks(inp).filter("check_name = 'ready'").select("measurement_year", "passed")


@register("freeze_manifest")
def q_freeze_manifest(spark, sf_dir):
    """What is frozen of the book, as published: only what passed its gate, with rows and fingerprint."""
    inp = BK.inputs(spark, sf_dir)
    base = BK.facts(spark, sf_dir)
    snapshot = Snapshot(spark, scratch_path(spark, "snapshot"))
    snapshot.freeze(base, base.select("measurement_year", "submission_id").distinct(), gate_state(PL.checks(inp), inp.stage_status), "first")
    return snapshot.manifest().select("measurement_year", "submission_id", "n_rows", "fingerprint", "gate", "run_id")


@register("duplicate_members")
def q_duplicate_members(spark, sf_dir):
    return E.duplicate_members(BK.identified_members(spark, sf_dir), ["c_mktsegment", "c_nationkey", "balance"]).select("patient_id", "reason")


@register("sample_requests")
def q_sample_requests(spark, sf_dir):
    """Request documents to final lists, for every request that can be sampled."""
    inp, f, _ = book_factors(spark, sf_dir)
    out = PL.sample_all(inp, f, groups_bound=f.count())
    carry = f.select(*GROUP, "correlation_id", "domain_id", "campaign_id")
    return out.join(carry, GROUP).select(
        *UNIT, "correlation_id", "domain_id", "campaign_id", "sampled_as", "population_rank", "sample_order", "list_type",
        "is_excluded", "exclusion_reason", "final_list", "replaces_order", "shortfall",
    )


@register("event_dates")
def q_event_dates(spark, sf_dir):
    """Visits get the earliest discharge date (left join; visits without one keep null)."""
    visits = P.facts(spark, sf_dir).select("patient_id", "visit_id", "measure_code")
    return E.attach_event_date(visits, P.discharge_dates(spark, sf_dir)).select("patient_id", "visit_id", "measure_code", "event_date")
