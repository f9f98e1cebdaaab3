"""Run the sampling job over tables stored as Parquet.

    python -m hybrid_sampling --tables ROOT --out ROOT [--run-id ID] [--rate-mode least|coalesce]

``--tables`` holds one folder per input table (names below). A submission-year is sampled when its
prerequisites have passed: then it is claimed (``out/claims``, so no other run samples it), its facts are frozen
(``out/frozen``, published by manifest and never written again), and the sample is drawn from that
snapshot only. Without ``stage_status`` nothing is ready and every request is refused.

The facts come from ``base_data``, or, where ``run_configuration`` and ``source_detail`` are there, from the tables
that these name for each request. ``measure_criteria`` and the tables it asks for say who may be sampled.
``extract_rule`` names raw extracts (folders) and their thresholds; ``--required`` names folders that must not be empty.

The sample is written partitioned under ``out/sample``, the new request table version under
``out/requests/version=<run id>`` and through a ledger (``sources.control.read_current`` reads the last one), failures under
``out/failures/version=<run id>``, per-group counts under
``out/summary/version=<run id>``. Submission-years (per product line) already
present in ``out/sample`` are not sampled again. ``--give-back RUN`` frees what a lost run had claimed.
"""

from __future__ import annotations

import argparse
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from hybrid_sampling.operators import factors as FA
from hybrid_sampling.operators import episodes as EP
from hybrid_sampling.operators.criteria import Catalogue
from hybrid_sampling.plans.job import GROUP, Inputs, run
from hybrid_sampling.session import build_session
from hybrid_sampling.sources import control as CT
from hybrid_sampling.sources.extracts import Extract
from hybrid_sampling.sources.ledger import Ledger
from hybrid_sampling.sources.readers import read_parquet

# fixed values: input table folder names
TABLES = {
    "requests": "sampling_request",
    "size_info": "size_info",
    "size_bands": "size_bands",
    "rand_values": "rand_values",
    "product_categories": "product_category",
    "classification": "measure_classification",
    "periods": "reporting_period",
    "facts": "base_data",
    "enrollment": "enrollment",
    "patients": "patient",
    "invalid": "invalid_member",
    "measure_meta": "measure_meta",
}
OPTIONAL = {
    "approvals": "os_approval", "sample_history": "sample_history", "visit_dates": "visit_date", "stage_status": "stage_status",
    "run_configuration": "run_configuration", "source_detail": "source_detail",
}
# fixed values: tables of the criteria catalogue, and of the episodes
CRITERIA = {"members": "member", "events": "qualifying_event", "associations": "valid_association", "invalid": "known_invalid", "lines": "valid_line"}
RULES, EXTRACT_RULES, DELIVERIES, STAYS = "measure_criteria", "extract_rule", "delivery_event", "inpatient_stay"


def _optional(spark: SparkSession, root: str, name: str):
    try:
        return read_parquet(spark, root, name)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise


def load_inputs(spark: SparkSession, root: str, required: tuple[str, ...] = ()) -> Inputs:
    tables = {k: _optional(spark, root, name) for k, name in OPTIONAL.items()}
    named = _source_tables(spark, root, tables)
    for k, name in TABLES.items():
        tables[k] = read_parquet(spark, root, name) if named is None or k != "facts" else next(iter(named.values()))
    return Inputs(
        **tables, fact_tables=named, catalogue=_catalogue(spark, root, tables["enrollment"]), episodes=_episodes(spark, root), extracts=_extracts(spark, root),
        required_tables={name: read_parquet(spark, root, name) for name in required},
    )


def _source_tables(spark: SparkSession, root: str, tables: dict) -> dict | None:
    """The fact tables that the sources name and that are there (metadata: one row a source)."""
    if tables["run_configuration"] is None or tables["source_detail"] is None:
        return None
    names = sorted(r[0] for r in tables["source_detail"].select("table_name").distinct().dropna().collect())
    found = {n: t for n in names if (t := _optional(spark, root, n)) is not None}
    return found or None


def _catalogue(spark: SparkSession, root: str, enrollment) -> Catalogue | None:
    rules = _optional(spark, root, RULES)
    if rules is None:
        return None
    spans = enrollment if {"span_start", "span_end"} <= set(enrollment.columns) else None
    return Catalogue(rules=rules, spans=spans, **{k: _optional(spark, root, name) for k, name in CRITERIA.items()})


def _episodes(spark: SparkSession, root: str):
    events, stays = _optional(spark, root, DELIVERIES), _optional(spark, root, STAYS)
    return None if events is None and stays is None else EP.visit_episodes(events, stays)


def _extracts(spark: SparkSession, root: str) -> dict[str, Extract] | None:
    """``extract_rule`` (table_name, key_column, year_column, min_rows, max_null_share, max_orphan_share), a row an extract.
    An extract that is not there has no rows in any year."""
    rules = _optional(spark, root, EXTRACT_RULES)
    if rules is None:
        return None
    out = {}
    for r in rules.collect():  # one row an extract
        rows = _optional(spark, root, r.table_name)
        if rows is None:
            rows = spark.createDataFrame([], f"`{r.key_column}` long, `{r.year_column}` int")
        out[r.table_name] = Extract(rows, r.key_column, r.year_column, r.min_rows, float(r.max_null_share), float(r.max_orphan_share))
    return out


def give_back(spark: SparkSession, claims: Ledger, lost: str, run_id: str) -> None:
    """Free the submission-years that a lost run had claimed."""
    def rows(known):
        held = CT.standing_claims(known, measures=True) if known is not None else spark.createDataFrame([], "submission_id long, product_line string, measure_code string, measurement_year int, run_id string")
        return CT.claim_rows(held.filter(held.run_id == lost).select(*GROUP), lost, held=False)

    claims.append(rows, run_id)


def _codes(text: str) -> tuple[str, ...]:
    return tuple(x.strip() for x in text.split(",") if x.strip())


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    ap = argparse.ArgumentParser(prog="hybrid_sampling")
    ap.add_argument("--tables", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--rate-mode", default="least", choices=["least", "coalesce"])
    ap.add_argument("--period-mode", default="exact", choices=["exact", "contains", "start_year"],
                    help="how a reporting period matches the measurement year")
    ap.add_argument("--status-codes", default="1,6,15", help="eligible clinical status codes, comma separated")
    ap.add_argument("--rand-default", default=None, help="RAND for measures without one (opt-in; else the request fails)")
    ap.add_argument("--inverse-submeasures", default=",".join(FA.INVERSE_SUBMEASURES), help="sub-measures rated as 100 - rate")
    ap.add_argument("--dropped-submeasures", default=",".join(FA.DROPPED_SUBMEASURES), help="sub-measures left out of rates")
    ap.add_argument("--required", default="", help="tables that must not be empty before any year is sampled, comma separated")
    ap.add_argument("--give-back", default=None, metavar="RUN", help="free what this run, which was lost, had claimed")
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="shuffle and rank range partitions (size so a partition is ~100-200 MB)")
    a = ap.parse_args(argv)
    spark = spark or build_session(a.master, shuffle_partitions=a.shuffle_partitions)
    # run ids sort in time order, so the newest request version is the max
    run_id = a.run_id or time.strftime("%Y%m%d%H%M%S", time.gmtime()) + "-" + uuid.uuid4().hex[:6]
    out = a.out.rstrip("/")
    inp = load_inputs(spark, a.tables, _codes(a.required))
    if a.give_back:
        give_back(spark, Ledger(spark, f"{out}/claims"), a.give_back, run_id)
    run(inp, f"{out}/sample", f"{out}/requests/version={run_id}", f"{out}/failures/version={run_id}", a.rate_mode,
        summary_out=f"{out}/summary/version={run_id}", period_mode=a.period_mode,
        status_codes=tuple(int(x) for x in a.status_codes.split(",") if x.strip()), rand_default=a.rand_default,
        inverse=_codes(a.inverse_submeasures), dropped=_codes(a.dropped_submeasures),
        run_id=run_id, snapshot_root=f"{out}/frozen", claims_root=f"{out}/claims", versions=Ledger(spark, f"{out}/requests_ledger"))
    return run_id
