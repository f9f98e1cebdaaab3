"""The end-to-end sampling job, for every open request in one lazy plan.

  requests -> open, not yet sampled -> parse -> flatten -> rates -> sizes
  -> errors and conflicts set aside, each with its message
  (small side, broadcast behind bounds)
  frozen facts -> eligibility and criteria -> grain -> rank (range-partitioned)
  -> draw (per measure, and once per shared group for its measures)
  -> exclusions (spread through shared groups) -> replacement -> output
  -> one write of every list -> request table version with statuses

Requests, measures and groups are rows, so the job is the same for one request
or thousands. Only when that one write fails are the requests run one by one, to
tell which of them fail.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hybrid_sampling.operators import draw as D
from hybrid_sampling.operators import eligibility as E
from hybrid_sampling.operators import factors as FA
from hybrid_sampling.operators import replacement as R
from hybrid_sampling.operators import request as RQ
from hybrid_sampling.operators import sizes as SZ
from hybrid_sampling.operators.criteria import Catalogue, apply_catalogue
from hybrid_sampling.operators.joins import bounded_broadcast, count_bound
from hybrid_sampling.schemas import SAMPLE_OUTPUT
from hybrid_sampling.sources import control as CT
from hybrid_sampling.sources import sinks as SK
from hybrid_sampling.sources.extracts import Extract, extract_checks
from hybrid_sampling.sources.ledger import Ledger
from hybrid_sampling.sources.snapshot import Snapshot, gate_state
from hybrid_sampling.sources.staging import stage

GROUP = ["submission_id", "product_line", "measure_code", "measurement_year"]
SHARED = ["submission_id", "product_line", "shared_group", "measurement_year"]
UNIT_GROUP = ["submission_id", "product_line", "sampling_unit", "measurement_year"]
UNIT = ["patient_id", "visit_id"]


@dataclass
class Inputs:
    """Tables of one run. ``facts`` should be the frozen snapshot."""

    requests: DataFrame
    size_info: DataFrame
    size_bands: DataFrame
    rand_values: DataFrame
    product_categories: DataFrame
    classification: DataFrame
    periods: DataFrame
    facts: DataFrame
    enrollment: DataFrame
    patients: DataFrame
    invalid: DataFrame
    measure_meta: DataFrame
    approvals: DataFrame | None = None
    sample_history: DataFrame | None = None
    visit_dates: DataFrame | None = None
    # who may be sampled at all, as code or as stored tables; ``invalid`` is what is found after the draw
    criteria: E.Criteria | None = None
    catalogue: Catalogue | None = None
    # deliveries and discharges (``episodes.visit_episodes``), for measures whose metadata name an anchor
    episodes: DataFrame | None = None
    # prerequisites: upstream stages by year, and tables that must not be empty
    stage_status: DataFrame | None = None
    required_tables: dict[str, DataFrame] | None = None
    extracts: dict[str, Extract] | None = None
    # run configuration -> source; with ``fact_tables`` the facts come from the tables it names
    run_configuration: DataFrame | None = None
    source_detail: DataFrame | None = None
    fact_tables: dict[str, DataFrame] | None = None


# fixed values: columns each input must provide
REQUIRED_COLUMNS = {
    "requests": ("correlation_id", "request_type", "campaign_status", "is_sampling_processed", "json_object"),
    "size_info": ("measure_code", "product_line", "measurement_year", "sample_size", "oversampling_rate", "cyar", "pyr"),
    "size_bands": ("measurement_year", "product_line", "rate_floor", "sample_size"),
    "rand_values": ("measure_code", "measurement_year", "rand"),
    "product_categories": ("submission_id", "measurement_year", "product_category"),
    "classification": ("clinical_measure_id", "classification_value"),
    "periods": ("reporting_period_id", "period_start", "period_end"),
    "facts": ("patient_id", "visit_id", "measure_code", "clinical_measure_id", "clinical_status_code", "is_deleted",
              "run_config_id", "organization_id", "submission_id", "reporting_period_id", "measurement_year", "event_date"),
    "enrollment": ("patient_id", "submission_id", "is_employee"),
    "patients": ("patient_id", "last_name", "first_name", "date_of_birth"),
    "invalid": ("patient_id", "measure_code", "reason"),
    "measure_meta": ("measure_code", "grain", "shared_group"),
    "approvals": ("submission_id", "measure_code"),
    "sample_history": ("submission_id", "measurement_year"),
    "visit_dates": ("visit_id", "event_date"),
    "stage_status": ("stage", "measurement_year", "is_complete"),
    "run_configuration": ("run_config_id", "source_detail_id"),
    "source_detail": ("source_detail_id", "table_name"),
}


def check_inputs(inp: Inputs) -> None:
    """Fail before planning when an input lacks a column the job reads."""
    missing = {}
    for name, cols in REQUIRED_COLUMNS.items():
        df = getattr(inp, name)
        if df is None:
            continue
        lack = [c for c in cols if c not in df.columns]
        if lack:
            missing[name] = lack
    facts = [inp.facts] if inp.fact_tables is None else list(inp.fact_tables.values())
    if "product_line" not in inp.patients.columns and any("product_line" not in f.columns for f in facts):
        missing["patients or facts"] = ["product_line"]
    if missing:
        raise ValueError(f"input tables lack columns: {missing}")


def opened(inp: Inputs) -> DataFrame:
    """Every open request with the heads of its document (nulls where it has none)."""
    doc = RQ.parse_requests(CT.open_requests(inp.requests))
    return doc.select(
        "correlation_id",
        F.col("doc.submissionId").alias("submission_id"),
        F.col("doc.measurementYear").alias("measurement_year"),
        F.col("doc.productCategory").alias("product_line"),
        F.col("doc.runConfigId").alias("run_config_id"),
    )


def with_open_requests(inp: Inputs) -> Inputs:
    """The inputs with their open requests only, written once: factors, errors and outcomes all start from them."""
    return replace(inp, requests=stage(CT.open_requests(inp.requests), "open-requests"))


def requests_to_run(inp: Inputs) -> DataFrame:
    """S7 + S8 + S3 + J1-J5: open requests not sampled before, flattened."""
    req = CT.open_requests(inp.requests)
    flat = RQ.flatten_request(RQ.parse_requests(req))
    if inp.sample_history is not None:
        flat = CT.not_yet_sampled(flat, inp.sample_history, CT.history_keys(inp.sample_history))
    return flat


def resolve_factors(
    inp: Inputs,
    rate_mode: str = "least",
    rand_default: str | None = None,
    inverse=FA.INVERSE_SUBMEASURES,
    dropped=FA.DROPPED_SUBMEASURES,
) -> DataFrame:
    """One factor row per request and measure with
    mrss, os_pct, fss, rand, grain and shared group."""
    f = FA.sampling_factors(requests_to_run(inp), inp.size_info, inp.product_categories, rate_mode, inverse, dropped)
    f = FA.shared_rate(f, inp.measure_meta)
    f = SZ.size_for_rate(f, inp.size_bands, rate_col="shared_rate")
    f = SZ.default_mrss(f)
    f = SZ.check_oversampling(f, inp.approvals)
    f = SZ.final_sizes(f)
    f = SZ.attach_rand(f, inp.rand_values, default=rand_default)
    f = E.attach_measure(f, inp.measure_meta.select("measure_code", "grain", *[c for c in ("anchor",) if c in inp.measure_meta.columns]), how="left")
    f = f.withColumn("grain", F.coalesce(F.col("grain"), F.lit("member")))
    return f.withColumn("exclude_emp", F.col("exclude_emp") == 1)


def factor_errors(factors: DataFrame) -> DataFrame:
    """Requests with a measure whose sizes or RAND cannot be used: what is
    wrong and the measures named (an error, never a silent default)."""
    f = factors.withColumn("_wrong", D.size_error(F.col("mrss"), F.col("rand"))).filter(F.col("_wrong").isNotNull())
    named = F.array_join(F.array_sort(F.collect_set("measure_code")), ",")
    return f.groupBy("correlation_id", "_wrong").agg(F.concat(F.col("_wrong"), F.lit(" for "), named).alias("error")).select("correlation_id", "error")


def checks(inp: Inputs) -> DataFrame:
    """What the run depends on, per year, and whether it is there."""
    sound = None
    if inp.extracts:
        sound = extract_checks(inp.extracts, inp.patients, inp.stage_status.select("measurement_year")).select("check_name", "measurement_year", "passed")
    return CT.check_prerequisites(inp.stage_status, inp.required_tables or {}, more=sound)


def split_errors(inp: Inputs, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Factors that can be sampled, and one row per request in error with all
    that is wrong with it. A request in error is not sampled at all, and does not
    count as a claimant of its groups."""
    heads = opened(inp)
    found = [RQ.number_errors(requests_to_run(inp)), factor_errors(resolved)]
    found.append(CT.no_gate_errors(heads) if inp.stage_status is None else CT.gate_errors(heads, checks(inp)))
    if inp.run_configuration is not None and inp.source_detail is not None:
        found.append(CT.source_errors(heads, inp.run_configuration, inp.source_detail))
    first = reduce(DataFrame.unionByName, found)
    factors, clash = FA.split_conflicts(resolved.join(first, "correlation_id", "left_anti"), GROUP)
    all_errors = first.unionByName(clash).groupBy("correlation_id").agg(F.array_join(F.array_sort(F.collect_set("error")), "; ").alias("error"))
    return factors.join(clash, "correlation_id", "left_anti"), all_errors


def source_facts(inp: Inputs, factors: DataFrame) -> DataFrame:
    """The facts of the run: ``inp.facts``, or each run configuration's rows
    of the table that it names."""
    if inp.fact_tables is None:
        return inp.facts
    runs = factors.select("run_config_id").distinct()
    named = CT.resolve_sources(runs, inp.run_configuration, inp.source_detail).select("run_config_id", "table_name").distinct()
    parts = []
    for name, df in sorted(inp.fact_tables.items()):
        own = named.filter(F.col("table_name") == name).select("run_config_id")
        parts.append(df.join(bounded_broadcast(own), "run_config_id", "left_semi"))
    return reduce(DataFrame.unionByName, parts)


def eligible_units(
    inp: Inputs, facts: DataFrame, factors: DataFrame, groups_bound: int | None = None, period_mode: str = "exact", status_codes=E.ELIGIBLE_STATUS
) -> DataFrame:
    """G7/G8 with the criteria of the run: eligible units per measure, as they are counted and ranked."""
    units = E.eligible_population(
        facts, factors, inp.periods, inp.classification, inp.enrollment, inp.patients, GROUP,
        status_codes=status_codes, period_mode=period_mode, factors_bound=groups_bound, visit_dates=inp.visit_dates, episodes=inp.episodes,
    )
    if inp.criteria is not None:
        units = E.apply_criteria(units, inp.criteria)
    if inp.catalogue is not None:
        years = tuple(sorted(r[0] for r in factors.select("measurement_year").distinct().collect()))  # a row a year
        units = apply_catalogue(units, inp.catalogue, years, groups_bound)
    return units


def sample_all(
    inp: Inputs,
    factors: DataFrame,
    groups_bound: int | None = None,
    num_partitions: int | None = None,
    period_mode: str = "exact",
    status_codes=E.ELIGIBLE_STATUS,
) -> DataFrame:
    """L8 + R1-R4: every group of every request drawn in one plan.

    Each measure is sampled on its own unless it belongs to a shared group; a
    shared group is sampled once on its measures' member union with the
    group's sizes. Both kinds are ranked in one pass, keyed by
    ``sampling_unit`` (the measure code or the shared group name), then each
    list is emitted for the measures it serves; exclusions of one measure
    spread to its group; excluded primaries are replaced in order.
    Output: group keys, units, sampled_as, ranks, plan columns, list_type,
    exclusion and replacement columns.
    """
    # one unit per member of a shared group (member union), else per measure
    # and grain: derived before the grain reduction, so one pass builds both
    unit = F.coalesce(F.col("shared_group"), F.col("measure_code"))
    grain = F.when(F.col("shared_group").isNotNull(), F.lit("member")).otherwise(F.col("grain"))
    facts = source_facts(inp, factors)
    if inp.criteria is None and inp.catalogue is None:
        units = E.eligible_population(
            facts, factors, inp.periods, inp.classification, inp.enrollment, inp.patients, UNIT_GROUP,
            status_codes=status_codes, period_mode=period_mode, factors_bound=groups_bound,
            derive={"sampling_unit": unit, "grain": grain},
            visit_dates=inp.visit_dates, episodes=inp.episodes,
        )
    else:
        # the criteria are the measure's own: they come before its units join a shared group
        units = eligible_units(inp, facts, factors, groups_bound, period_mode, status_codes)
        units = units.withColumn("sampling_unit", unit).withColumn("grain", grain)
        attrs = ["last_name", "first_name", "date_of_birth"]
        visit = F.when(F.col("grain") == "visit", F.col("visit_id")).alias("visit_id")
        units = units.groupBy(*UNIT_GROUP, "grain", "patient_id", visit, *attrs).agg(F.min("event_date").alias("event_date"))

    own_sizes = factors.filter(F.col("shared_group").isNull()).withColumn("sampling_unit", F.col("measure_code"))
    shared_sizes = R.shared_sizes(factors, SHARED).withColumnRenamed("shared_group", "sampling_unit")
    sizes = own_sizes.select(*UNIT_GROUP, "mrss", "os_pct", "rand").unionByName(shared_sizes.select(*UNIT_GROUP, "mrss", "os_pct", "rand"))
    drawn = D.draw_population(units, sizes, UNIT_GROUP, num_partitions, groups_bound)

    # which measures each sampling unit serves, per request (factor rows; the
    # groups may come from metadata or from the request itself)
    keys = ["submission_id", "product_line", "measurement_year", "sampling_unit"]
    serves = factors.select(*keys[:3], unit.alias("sampling_unit"), "measure_code").distinct()
    drawn = drawn.join(bounded_broadcast(serves, groups_bound), keys, "inner").withColumnRenamed("sampling_unit", "sampled_as")
    cols = GROUP + UNIT + ["sampled_as", "population_rank", "sample_order", "list_type", "em", "mrss_actual", "os_actual", "rand"]
    flagged = E.flag_exclusions(drawn.select(*cols), inp.invalid)
    # An exclusion in one measure applies to every measure the unit serves:
    # the unit's rows (one per measure served) share their first reason
    same_unit = Window.partitionBy("submission_id", "product_line", "measurement_year", "sampled_as", "patient_id", "visit_id")
    reason = F.col("exclusion_reason")
    best = F.min(F.when(reason.isNotNull(), F.struct(E.reason_priority("exclusion_reason").alias("_p"), reason.alias("_r")))).over(same_unit)
    flagged = flagged.withColumn("exclusion_reason", best["_r"]).withColumn("is_excluded", F.col("exclusion_reason").isNotNull())
    return R.replace_excluded(flagged, GROUP)


def output_summary(sample: DataFrame) -> DataFrame:
    """A6 over stored output rows: per group, drawn, primary and auxiliary
    drawn, excluded, replaced, final primaries and the shortfall against the
    stored MRSS."""
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    agg = sample.groupBy("domain_id", "campaign_id", *GROUP).agg(
        F.max("mrss_actual").alias("mrss_actual"),
        F.count(F.lit(1)).cast("bigint").alias("drawn"),
        n(F.col("list_type") == D.PRIMARY).alias("primary_drawn"),
        n(F.col("list_type") == D.AUXILIARY).alias("auxiliary_drawn"),
        n(F.col("is_excluded")).alias("excluded"),
        n((F.col("list_type") == D.AUXILIARY) & F.col("is_primary")).alias("replaced"),
        n(F.col("is_primary")).alias("final_primary"),
    )
    return agg.withColumn("shortfall", (F.col("mrss_actual") - F.col("final_primary")).cast("bigint"))


def request_outcomes(inp: Inputs, factors: DataFrame, errors: DataFrame, written: DataFrame) -> DataFrame:
    """Per open request: correlation_id, succeeded, message.

    It succeeded when a list was written for it (the message then names measures
    without eligible members), or when its submission-year was sampled before and
    every measure it names was sampled then (sampling runs once per year, S8: a measure
    left out then is refused, and the message names it). ``written``: the sampling groups with a list."""
    lists = factors.select("correlation_id", *GROUP).join(written.select(*GROUP).distinct().withColumn("_list", F.lit(True)), GROUP, "left")
    none = F.array_sort(F.collect_set(F.when(F.col("_list").isNull(), F.col("measure_code"))))
    ok = lists.groupBy("correlation_id").agg(F.coalesce(F.bool_or("_list"), F.lit(False)).alias("_ok"), none.alias("_none"))
    heads = opened(inp)
    if inp.sample_history is not None:
        keys = CT.history_keys(inp.sample_history)
        heads = heads.join(inp.sample_history.select(*keys).distinct().withColumn("_done", F.lit(True)), keys, "left")
        heads = heads.join(never_sampled(inp), "correlation_id", "left")
    else:
        heads = heads.withColumn("_done", F.lit(None).cast("boolean")).withColumn("_never", F.lit(None).cast("array<string>"))
    j = heads.join(errors, "correlation_id", "left").join(ok, "correlation_id", "left")
    before = F.coalesce(F.col("_done"), F.lit(False))
    refused = before & F.col("_never").isNotNull()
    ok_col = F.coalesce(F.col("_ok"), F.lit(False)) & F.col("error").isNull()
    message = (
        F.when(refused, F.concat(F.lit("sampled before without "), F.array_join("_never", ",")))
        .when(before, F.lit("already sampled"))
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("_none").isNull(), F.lit("no sampling factors resolved"))
        .when(F.size("_none") > 0, F.concat(F.lit("no eligible members for "), F.array_join("_none", ",")))
    )
    return j.select("correlation_id", ((before & ~refused) | (~before & ok_col)).alias("succeeded"), message.alias("message"))


def never_sampled(inp: Inputs) -> DataFrame:
    """The measures an open request names that its submission-year was sampled without: correlation_id, _never.
    A history that names no measures covers them all."""
    history = inp.sample_history
    named = RQ.flatten_request(RQ.parse_requests(CT.open_requests(inp.requests))).select("correlation_id", *GROUP).distinct()
    if "measure_code" not in history.columns:
        return named.select("correlation_id").limit(0).withColumn("_never", F.lit(None).cast("array<string>"))
    keys = CT.history_keys(history)
    whole = history.filter(F.col("measure_code").isNull()).select(*keys).distinct()  # a history of all measures
    drawn = history.select(*keys, "measure_code").distinct()
    missing = named.join(drawn, [*keys, "measure_code"], "left_anti").join(whole, keys, "left_anti")
    return missing.groupBy("correlation_id").agg(F.array_sort(F.collect_set("measure_code")).alias("_never"))


def scoped_facts(facts: DataFrame, factors: DataFrame, bound: int | None = None) -> DataFrame:
    """The facts of the factors' years and submissions. The factors are the small side of
    a semi join on the partition columns, so a partitioned table reads their partitions only, found
    out as the query runs (dynamic partition pruning), however many there are."""
    keys = ["measurement_year", "submission_id"]
    asked = factors.filter(F.col("measurement_year") > 0).select(*keys).distinct()
    return facts.join(bounded_broadcast(asked, bound), keys, "left_semi")


def _write_lists(inp: Inputs, factors: DataFrame, sample_root: str, period_mode: str, status_codes, frozen: tuple[Snapshot, str] | None = None) -> None:
    bound = count_bound(factors)
    facts = scoped_facts(source_facts(inp, factors), factors, bound)
    if frozen is not None:  # S11: what has passed the gate is frozen, then sampled from the snapshot only
        snapshot, run_id = frozen
        snapshot.freeze(facts, factors, gate_state(checks(inp), inp.stage_status), run_id)
        facts = snapshot.read(facts.schema, factors)
    final = sample_all(replace(inp, facts=facts, fact_tables=None), factors, groups_bound=bound, period_mode=period_mode, status_codes=status_codes)
    carry = factors.select(*GROUP, "run_config_id", "domain_id", "campaign_id")
    SK.write_sample(R.to_output(final.join(bounded_broadcast(carry, bound), GROUP, "left")), sample_root)


def write_lists(inp: Inputs, factors: DataFrame, sample_root: str, period_mode: str, status_codes, frozen: tuple[Snapshot, str] | None = None) -> DataFrame:
    """Write the lists of all requests in one job: (correlation_id, error) of those that fail.

    A set whose job fails is halved by the requests' ids, until a failing set is one request: with k
    bad requests among n some 2 k log2(n) jobs run, not n."""
    failed: list[tuple[str, str]] = []

    def write(part: DataFrame, ids: list[str] | None) -> None:
        try:
            _write_lists(inp, part, sample_root, period_mode, status_codes, frozen)
        except Exception as e:  # whatever it is, the request that it comes from is to be told from the others
            if ids is None:  # one short row a request, and only now
                ids = sorted(r[0] for r in part.select("correlation_id").distinct().collect())
            if len(ids) <= 1:
                text = (str(e).strip().splitlines() or [type(e).__name__])[0]
                failed.extend((i, f"run failed: {text}") for i in ids)
                return
            half = len(ids) // 2
            write(part.filter(F.col("correlation_id") < ids[half]), ids[:half])
            write(part.filter(F.col("correlation_id") >= ids[half]), ids[half:])

    write(factors, None)
    return factors.sparkSession.createDataFrame(failed, "correlation_id string, error string")


def snapshot_errors(inp: Inputs, factors: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Requests whose submission-year was frozen before its review was last passed."""
    late = snapshot.late(factors, gate_state(checks(inp), inp.stage_status))
    hit = factors.join(late, ["measurement_year", "submission_id"], "left_semi").select("correlation_id", "measurement_year").distinct()
    return hit.select("correlation_id", F.concat(F.lit("facts of "), F.col("measurement_year").cast("string"), F.lit(" were frozen before their review")).alias("error"))


def claim_groups(factors: DataFrame, claims: Ledger, run_id: str) -> tuple[DataFrame, DataFrame]:
    """This run's factors whose submission-year (and line) no other run has claimed, and an error for each
    request of the others. Claims are published at once, so of two runs at the same time one gets each."""
    year = ["submission_id", "product_line", "measurement_year"]
    groups = factors.select(*GROUP).distinct()
    mine = claims.append(lambda known: CT.claim_rows(groups if known is None else groups.join(CT.standing_claims(known), year, "left_anti"), run_id), run_id)
    own = groups.limit(0) if mine is None else mine
    rest = factors.join(own.select(*year).distinct(), year, "left_anti")
    errors = rest.join(CT.standing_claims(claims.read()), year).select(
        "correlation_id", F.concat(F.lit("being sampled by run "), F.col("run_id")).alias("error")
    ) if not rest.isEmpty() else rest.select("correlation_id", F.lit("").alias("error"))
    errors = errors.groupBy("correlation_id").agg(F.min("error").alias("error"))
    return factors.join(errors, "correlation_id", "left_anti"), errors


def stored_history(inp: Inputs, stored: DataFrame | None, claims: Ledger | None) -> DataFrame | None:
    """The sampled submission-years and lines with their measures: those stored, those that finished runs
    claimed (a measure may have had no members), and the history given (no measure: all of them)."""
    keys, parts = ["submission_id", "measurement_year", "product_line"], []
    if stored is not None:
        parts.append(stored.select(*keys, "measure_code").distinct())
        known = None if claims is None else claims.read()
        if known is not None:
            years = stored.select(*keys).distinct()
            parts.append(CT.standing_claims(known, measures=True).join(years, keys, "left_semi").select(*keys, "measure_code"))
    if inp.sample_history is not None:
        own = inp.sample_history.select(*CT.history_keys(inp.sample_history)).distinct()
        if "product_line" not in own.columns:  # all lines of the year
            lines = opened(inp).select("submission_id", "measurement_year", "product_line").distinct()
            own = own.join(lines, ["submission_id", "measurement_year"])
        parts.append(own.select(*keys, F.lit(None).cast("string").alias("measure_code")))
    return reduce(DataFrame.unionByName, parts).distinct() if parts else None


def run(
    inp: Inputs,
    sample_root: str,
    requests_out: str,
    failures_out: str | None = None,
    rate_mode: str = "least",
    status_mode: str = "errorifexists",
    summary_out: str | None = None,
    period_mode: str = "exact",
    status_codes=E.ELIGIBLE_STATUS,
    rand_default: str | None = None,
    inverse=FA.INVERSE_SUBMEASURES,
    dropped=FA.DROPPED_SUBMEASURES,
    run_id: str = "run",
    snapshot_root: str | None = None,
    claims_root: str | None = None,
    versions: Ledger | None = None,
) -> DataFrame:
    """Whole job: one write of all lists, then the request table's new version.

    Submission-years (per product line) that ``sample_root`` already holds are
    not sampled again, whoever calls. The status step runs only after the sample
    write has committed. With ``snapshot_root`` the facts of what passed the gate are frozen and
    sampled from there only; with ``claims_root`` a submission-year is claimed before it is sampled;
    with ``versions`` the request table's version is published there as well, on top of what other runs published
    meanwhile. Returns the new request table (read back).
    """
    check_inputs(inp)
    spark = inp.requests.sparkSession
    claims = Ledger(spark, claims_root) if claims_root else None
    if inp.stage_status is not None:
        inp = replace(inp, stage_status=stage(inp.stage_status, "stage-status"))  # the gate as this run saw it
    snapshot = Snapshot(spark, snapshot_root) if snapshot_root else None
    stored = SK.read_if_any(spark, sample_root, SAMPLE_OUTPUT)
    history = stored_history(inp, stored, claims)
    if history is not None:
        inp = replace(inp, sample_history=stage(history, "sampled-before"))  # as it was before this run
    every, inp = inp.requests, with_open_requests(inp)
    resolved = stage(resolve_factors(inp, rate_mode, rand_default, inverse, dropped), "factors")
    factors, errors = split_errors(inp, resolved)
    factors, errors = stage(factors, "factors-to-sample"), stage(errors, "request-errors")
    if snapshot is not None and not factors.isEmpty():
        late = stage(snapshot_errors(inp, factors, snapshot), "snapshot-errors")
        factors, errors = factors.join(late, "correlation_id", "left_anti"), errors.unionByName(late)
    if claims is not None and not factors.isEmpty():
        factors, taken = claim_groups(factors, claims, run_id)
        factors, errors = stage(factors, "factors-claimed"), errors.unionByName(stage(taken, "claim-errors"))
    claimed = None
    if not factors.isEmpty():
        broken = write_lists(inp, factors, sample_root, period_mode, status_codes, snapshot and (snapshot, run_id))
        errors = stage(errors.unionByName(broken), "request-errors")
        claimed, factors = factors, factors.join(errors, "correlation_id", "left_anti")
    elif stored is None:  # nothing to do: an empty sample all the same
        SK.write_sample(spark.createDataFrame([], SAMPLE_OUTPUT), sample_root)
    groups = factors.select(*GROUP).distinct()
    written = SK.read_if_any(spark, sample_root, SAMPLE_OUTPUT)
    run_rows = (spark.createDataFrame([], SAMPLE_OUTPUT) if written is None else written).join(bounded_broadcast(groups), GROUP, "left_semi")
    if claims is not None and claimed is not None:  # a submission-year of which nothing was sampled may be claimed again
        year = ["submission_id", "product_line", "measurement_year"]
        idle = claimed.select(*GROUP).distinct().join(run_rows.select(*year).distinct(), year, "left_anti")
        claims.append(lambda known: CT.claim_rows(idle, run_id, held=False), run_id)
    if summary_out:
        # A6 from the committed sample (read back, this run's groups only):
        # no second evaluation of the draw
        SK.write_ordered(output_summary(run_rows), summary_out, ["measure_code", "measurement_year", "submission_id", "product_line"], status_mode)
    outcomes = stage(request_outcomes(inp, factors, errors, run_rows.select(*GROUP)), "outcomes")
    closed = CT.close_requests(every, outcomes)
    if versions is not None:
        own = closed
        published = versions.append(lambda last: own if last is None else CT.keep_processed(own, last), run_id, last_only=True)
        closed = own if published is None else published
    closed.write.mode(status_mode).parquet(requests_out)
    if failures_out:
        CT.failure_rows(outcomes).write.mode(status_mode).parquet(failures_out)
    return spark.read.parquet(requests_out)
