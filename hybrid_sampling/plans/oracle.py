"""Independent DuckDB statements of every registered query (the correctness gate).

They restate the proxy mapping and the business rules directly in SQL with no
shared code path: ranks by ``row_number()``, draws by enumerating the pick
positions with ``range`` (not the closed-form membership test Spark uses).
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
SIZES_VALUES = """(VALUES
    ('CBP', 411, 1000, 950000, 'member', NULL),
    ('COL', 230, 1000, 750000, 'member', NULL),
    ('GSD', 134, 1000, 660000, 'member', 'GSD-EED'),
    ('TRC', 106, 1500, 250000, 'visit', NULL),
    ('EED', 134, 1000, 500000, 'member', 'GSD-EED')
) AS s(measure_code, mrss_i, os_bp, rand6, grain, shared_group)"""
# ------------------------------------------------------------------------------

MEASURE_CASE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'CBP' WHEN '2-HIGH' THEN 'COL'
        WHEN '3-MEDIUM' THEN 'GSD' WHEN '4-NOT SPECIFIED' THEN 'TRC' WHEN '5-LOW' THEN 'EED' END"""

GROUP_SQL = "submission_id, product_line, measure_code, measurement_year"

# eligible units (status F/O = 1/6, not deleted, not employee), reduced to grain
POP_CTE = f"""
fact AS (
    SELECT o_custkey AS patient_id, o_orderkey AS visit_id, {MEASURE_CASE} AS measure_code,
           CAST(year(o_orderdate) AS INTEGER) AS measurement_year, CAST(o_orderdate AS DATE) AS event_date
    FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_orderkey % 20 <> 0 AND o_custkey % 50 <> 0
),
unit AS (
    SELECT measure_code, measurement_year, patient_id,
           CASE WHEN measure_code = 'TRC' THEN visit_id END AS visit_id, min(event_date) AS event_date
    FROM fact GROUP BY 1, 2, 3, 4
),
pop AS (
    SELECT CAST(1 AS BIGINT) AS submission_id, 'Commercial' AS product_line, u.measure_code, u.measurement_year,
           u.patient_id, u.visit_id, u.event_date, c.c_mktsegment AS last_name, c.c_name AS first_name,
           CAST(DATE '1940-01-01' + CAST((c.c_custkey * 7919) % 25000 AS INTEGER) AS DATE) AS date_of_birth
    FROM unit u JOIN customer c ON c.c_custkey = u.patient_id
)"""

def rank_expr(part: str) -> str:
    return f"""CAST(CASE WHEN measurement_year % 2 = 0 THEN
        row_number() OVER (PARTITION BY {part} ORDER BY last_name ASC NULLS FIRST, first_name ASC NULLS FIRST,
            date_of_birth ASC NULLS FIRST, event_date ASC NULLS FIRST, patient_id ASC NULLS FIRST, visit_id ASC NULLS FIRST)
    ELSE
        row_number() OVER (PARTITION BY {part} ORDER BY last_name DESC NULLS LAST, first_name DESC NULLS LAST,
            date_of_birth DESC NULLS LAST, event_date DESC NULLS LAST, patient_id ASC NULLS FIRST, visit_id ASC NULLS FIRST)
    END AS BIGINT)"""


def draw_ctes(p: str, part: str, ranked: str, sized_from: str) -> str:
    """Counts, scenario, start, enumerated positions and the labelled draw for
    groups ``part`` of the ranked table ``ranked``. ``sized_from`` is a FROM
    clause giving, per group, em and the columns mrss_i, os_bp, rand6."""
    return f"""
{p}counts AS (SELECT {part}, CAST(count(*) AS BIGINT) AS em FROM {ranked} GROUP BY ALL),
{p}sized AS (
    SELECT c.*, CAST(s.mrss_i AS BIGINT) AS mrss, s.os_bp, s.rand6,
           CAST((s.mrss_i * (10000 + s.os_bp) + 9999) // 10000 AS BIGINT) AS fss
    FROM {sized_from}
),
{p}scen AS (
    SELECT *, CASE WHEN em <= mrss THEN 'A' WHEN em <= fss THEN 'B' ELSE 'C' END AS scenario FROM {p}sized
),
{p}plans AS (
    SELECT *,
        CASE WHEN scenario = 'C' THEN em // fss END AS n_interval,
        CASE WHEN scenario = 'C' THEN greatest(1, (2 * rand6 * (em // fss) + 1000000) // 2000000) END AS start_pos,
        least(mrss, em) AS mrss_actual,
        CASE scenario WHEN 'A' THEN 0 WHEN 'B' THEN em - mrss ELSE fss - mrss END AS os_actual,
        CASE WHEN scenario = 'C' THEN fss ELSE em END AS sample_total
    FROM {p}scen
),
{p}positions AS (
    SELECT {part}, pick_index, start_pos + (2 * pick_index * em + fss) // (2 * fss) AS position
    FROM (SELECT *, unnest(range(0, fss)) AS pick_index FROM {p}plans WHERE scenario = 'C')
),
{p}drawn AS (
    SELECT r.*, p.pick_index + 1 AS sample_order, pl.mrss_actual
    FROM {ranked} r JOIN {p}positions p USING ({part})
    JOIN {p}plans pl USING ({part})
    WHERE r.population_rank = p.position
    UNION ALL
    SELECT r.*, r.population_rank AS sample_order, pl.mrss_actual
    FROM {ranked} r JOIN {p}plans pl USING ({part})
    WHERE pl.scenario IN ('A', 'B')
),
{p}labelled AS (
    SELECT *, CASE WHEN sample_order <= mrss_actual THEN 'Primary' ELSE 'Auxiliary' END AS list_type FROM {p}drawn
)"""


RANK_EXPR = rank_expr(GROUP_SQL)

RANKED_CTE = POP_CTE + f""",
ranked AS (SELECT *, {RANK_EXPR} AS population_rank FROM pop)"""

PLANS_CTE = RANKED_CTE + "," + draw_ctes("", GROUP_SQL, "ranked", f"counts c JOIN {SIZES_VALUES} USING (measure_code)")

UNIT_COLS = f"{GROUP_SQL}, patient_id, visit_id"

SQL: dict[str, str] = {}

SQL["eligible_member"] = f"""WITH {POP_CTE}
SELECT {GROUP_SQL}, patient_id, visit_id, event_date, last_name, first_name, date_of_birth FROM pop"""

SQL["rank_even"] = f"""WITH {RANKED_CTE}
SELECT {UNIT_COLS}, population_rank FROM ranked WHERE measurement_year % 2 = 0"""

SQL["rank_odd"] = f"""WITH {RANKED_CTE}
SELECT {UNIT_COLS}, population_rank FROM ranked WHERE measurement_year % 2 = 1"""

SQL["rank_large"] = f"""WITH {RANKED_CTE}
SELECT {UNIT_COLS}, population_rank,
       CAST(count(*) OVER (PARTITION BY {GROUP_SQL}) AS BIGINT) AS em
FROM ranked"""

SQL["plan_scenarios"] = f"""WITH {PLANS_CTE}
SELECT {GROUP_SQL}, em, mrss, CAST(os_bp / 100 AS DECIMAL(5,2)) AS os_pct, fss, scenario,
       CAST(n_interval AS BIGINT) AS n_interval, CAST(start_pos AS BIGINT) AS start_pos,
       CAST(rand6 / 1000000 AS DECIMAL(9,6)) AS rand,
       CAST(mrss_actual AS BIGINT) AS mrss_actual, CAST(os_actual AS BIGINT) AS os_actual,
       CAST(sample_total AS BIGINT) AS sample_total
FROM plans"""

SQL["sample_positions"] = f"""WITH {PLANS_CTE}
SELECT {GROUP_SQL}, CAST(pick_index AS BIGINT) AS pick_index, CAST(pick_index + 1 AS BIGINT) AS sample_order,
       CAST(position AS BIGINT) AS position
FROM positions"""

SQL["sample_draw"] = f"""WITH {PLANS_CTE}
SELECT {UNIT_COLS}, population_rank, CAST(sample_order AS BIGINT) AS sample_order, list_type FROM labelled"""


# ------------------------------------------------------------- request and rates
LINE_CASE = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Commercial' WHEN 'BUILDING' THEN 'Medicaid'
        WHEN 'FURNITURE' THEN 'Medicare' WHEN 'HOUSEHOLD' THEN 'Exchange' WHEN 'MACHINERY' THEN 'Commercial' END"""

FLAT_CTE = f"""
flat AS (
    SELECT correlation_id, product_line, measure_code, clinical_measure_id, oversampling_rate, measurement_year,
           submission_id, min(cyar) AS cyar, min(pyr) AS pyr, exclude_emp, organization_id, run_config_id
    FROM (
        SELECT 'REQ-' || CAST(c_custkey AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR) AS correlation_id,
            {LINE_CASE} AS product_line,
            {MEASURE_CASE} AS measure_code,
            CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE {MEASURE_CASE} || CAST(o_orderkey % 2 + 1 AS VARCHAR) END AS clinical_measure_id,
            CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 26 AS DECIMAL(5,2)) END AS oversampling_rate,
            CAST(year(o_orderdate) AS INTEGER) AS measurement_year,
            c_custkey AS submission_id,
            CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 101 AS DECIMAL(5,2)) END AS cyar,
            CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 101 AS DECIMAL(5,2)) END AS pyr,
            CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS exclude_emp,
            CAST(c_nationkey AS BIGINT) AS organization_id,
            CAST(c_nationkey AS BIGINT) AS run_config_id
        FROM orders JOIN customer ON c_custkey = o_custkey
    )
    GROUP BY correlation_id, product_line, measure_code, clinical_measure_id, oversampling_rate, measurement_year,
             submission_id, exclude_emp, organization_id, run_config_id
)"""

META_CTE = """
lines AS (SELECT * FROM (VALUES ('Commercial'), ('Medicaid'), ('Medicare')) AS l(product_line)),
years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS measurement_year FROM orders),
info AS (
    SELECT m.measure_code, l.product_line, y.measurement_year, m.sample_size,
        CAST(m.os AS DECIMAL(5,2)) AS oversampling_rate,
        CASE WHEN m.measure_code = 'COL' AND l.product_line = 'Medicare' THEN NULL ELSE 'CYAR' END AS cyar_flag,
        CASE WHEN m.measure_code = 'CBP' AND l.product_line = 'Medicaid' THEN NULL ELSE 'PYR' END AS pyr_flag
    FROM (VALUES ('CBP', 411, '10.00'), ('COL', 230, '10.00'), ('GSD', 134, '10.00'), ('TRC', 106, '15.00'), ('EED', 134, '10.00'))
         AS m(measure_code, sample_size, os)
    CROSS JOIN lines l CROSS JOIN years y
    WHERE NOT (m.measure_code = 'EED' AND l.product_line = 'Medicare')
),
bands AS (
    SELECT y.measurement_year, l.product_line, CAST(b.f AS DECIMAL(5,2)) AS rate_floor, b.sample_size
    FROM (VALUES ('95.00', 106), ('90.00', 134), ('0.00', 296)) AS b(f, sample_size)
    CROSS JOIN lines l CROSS JOIN years y
)"""

RATES_CTE = FLAT_CTE + "," + META_CTE + f""",
kept AS (
    SELECT * FROM flat
    WHERE clinical_measure_id IS NOT NULL AND clinical_measure_id NOT IN ('HBD1', 'GSD1', 'BPD') AND product_line <> 'Exchange'
),
inv AS (
    SELECT * REPLACE (
        CASE WHEN clinical_measure_id IN ('HBD2', 'GSD2') AND cyar IS NOT NULL THEN CAST(100 - cyar AS DECIMAL(5,2)) ELSE cyar END AS cyar,
        CASE WHEN clinical_measure_id IN ('HBD2', 'GSD2') AND pyr IS NOT NULL THEN CAST(100 - pyr AS DECIMAL(5,2)) ELSE pyr END AS pyr)
    FROM kept
),
cat AS (
    SELECT DISTINCT o_custkey AS submission_id, CAST(year(o_orderdate) AS INTEGER) AS measurement_year,
        CASE WHEN c_custkey % 11 = 0 THEN 'Exchange' ELSE {LINE_CASE} END AS product_category
    FROM orders JOIN customer ON c_custkey = o_custkey
),
gated AS (
    SELECT i.*, info.sample_size AS info_sample_size, info.oversampling_rate AS info_os_pct,
        CASE WHEN info.cyar_flag = 'CYAR' AND i.measure_code <> 'TRC' THEN i.cyar END AS cyar_used,
        CASE WHEN info.pyr_flag = 'PYR' THEN i.pyr END AS pyr_used
    FROM inv i
    LEFT JOIN info ON info.measure_code = i.measure_code AND info.product_line = i.product_line
                  AND info.measurement_year = i.measurement_year
    WHERE EXISTS (SELECT 1 FROM cat WHERE cat.submission_id = i.submission_id AND cat.measurement_year = i.measurement_year
                  AND cat.product_category = i.product_line)
),
agg AS (
    SELECT correlation_id, product_line, measure_code, oversampling_rate, measurement_year, submission_id,
        organization_id, run_config_id, exclude_emp,
        min(cyar_used) AS min_cyar, min(pyr_used) AS min_pyr,
        max(info_sample_size) AS info_sample_size, max(info_os_pct) AS info_os_pct
    FROM gated
    GROUP BY correlation_id, product_line, measure_code, oversampling_rate, measurement_year, submission_id,
        organization_id, run_config_id, exclude_emp
),
rates AS (SELECT *, CAST(least(min_cyar, min_pyr) AS DECIMAL(5,2)) AS rate FROM agg),
banded AS (
    SELECT r.*,
        (SELECT arg_max(b.sample_size, b.rate_floor) FROM bands b
         WHERE b.measurement_year = r.measurement_year AND b.product_line = r.product_line AND b.rate_floor <= r.rate) AS mrss_band
    FROM rates r
),
appr AS (
    SELECT DISTINCT o_custkey AS submission_id, {MEASURE_CASE} AS measure_code
    FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE o_orderstatus = 'F' AND c_acctbal > 5000
),
osr AS (
    SELECT b.*, CAST(coalesce(b.oversampling_rate, b.info_os_pct, 10.00) AS DECIMAL(5,2)) AS os_requested,
        EXISTS (SELECT 1 FROM appr a WHERE a.submission_id = b.submission_id AND a.measure_code = b.measure_code) AS approved,
        CAST(coalesce(b.mrss_band, b.info_sample_size, 411) AS BIGINT) AS mrss
    FROM banded b
),
capped AS (
    SELECT *, (os_requested > 20 AND NOT approved) AS os_capped,
        CAST(CASE WHEN os_requested > 20 AND NOT approved THEN 20 ELSE os_requested END AS DECIMAL(5,2)) AS os_pct
    FROM osr
)"""

FACTOR_COLS = ("correlation_id, product_line, measure_code, oversampling_rate, measurement_year, submission_id, "
               "organization_id, run_config_id, exclude_emp")

SQL["request_flatten"] = f"""WITH {FLAT_CTE}
SELECT * FROM flat"""

SQL["rates_invert_gate"] = f"""WITH {RATES_CTE}
SELECT correlation_id, measure_code, clinical_measure_id, product_line, measurement_year, submission_id, cyar, pyr,
       info_sample_size, info_os_pct, cyar_used, pyr_used
FROM gated"""

SQL["rates_lowest"] = f"""WITH {RATES_CTE}
SELECT {FACTOR_COLS}, min_cyar, min_pyr, rate FROM rates"""

SQL["rates_coalesce"] = f"""WITH {RATES_CTE}
SELECT {FACTOR_COLS}, min_cyar, min_pyr, CAST(coalesce(min_cyar, min_pyr) AS DECIMAL(5,2)) AS rate FROM agg"""

SQL["rates_shared"] = f"""WITH {RATES_CTE}
SELECT r.correlation_id, r.measure_code, g.shared_group, r.rate,
       CASE WHEN g.shared_group IS NULL THEN r.rate
            ELSE min(r.rate) OVER (PARTITION BY r.correlation_id, g.shared_group) END AS shared_rate
FROM rates r LEFT JOIN (VALUES ('GSD', 'GSD-EED'), ('EED', 'GSD-EED')) AS g(measure_code, shared_group)
     ON g.measure_code = r.measure_code"""

SQL["mrss_band"] = f"""WITH {RATES_CTE}
SELECT correlation_id, measure_code, product_line, measurement_year, rate, mrss_band FROM banded"""

SQL["mrss_default"] = f"""WITH {RATES_CTE}
SELECT correlation_id, measure_code, rate, mrss_band, info_sample_size, mrss FROM osr"""

SQL["os_cap"] = f"""WITH {RATES_CTE}
SELECT correlation_id, measure_code, oversampling_rate, info_os_pct, os_requested, os_capped, os_pct FROM capped"""

SQL["fss_ceiling"] = f"""WITH {RATES_CTE}
SELECT correlation_id, measure_code, mrss, os_pct,
       CAST((mrss * (10000 + CAST(os_pct * 100 AS BIGINT)) + 9999) // 10000 AS BIGINT) AS fss
FROM capped"""


# ------------------------------------------------------------------ eligibility
INVALID_CTE = f"""
inv AS (
    SELECT c_custkey AS patient_id, CAST(NULL AS VARCHAR) AS measure_code, 'deceased' AS reason FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT c_custkey, NULL, 'hospice' FROM customer WHERE c_custkey % 37 = 0
    UNION ALL
    SELECT o_custkey, {MEASURE_CASE}, 'data error' FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 50 = 0
),
reasons AS (
    SELECT {UNIT_COLS}, reason AS exclusion_reason FROM (
        SELECT p.*, i.reason, row_number() OVER (
            PARTITION BY p.submission_id, p.product_line, p.measure_code, p.measurement_year, p.patient_id, p.visit_id
            ORDER BY CASE i.reason WHEN 'deceased' THEN 0 WHEN 'hospice' THEN 1 WHEN 'employee' THEN 2
                                   WHEN 'duplicate' THEN 3 WHEN 'data error' THEN 4 ELSE 5 END) AS rn
        FROM pop p JOIN inv i ON i.patient_id = p.patient_id AND (i.measure_code IS NULL OR i.measure_code = p.measure_code)
    ) WHERE rn = 1
)"""

SQL["eligible_visit"] = f"""WITH {POP_CTE}
SELECT {UNIT_COLS}, event_date FROM pop WHERE measure_code = 'TRC'"""

SQL["eligible_counts"] = f"""WITH {POP_CTE}
SELECT {GROUP_SQL}, CAST(count(*) AS BIGINT) AS em FROM pop GROUP BY 1, 2, 3, 4"""

SQL["valid_line"] = f"""SELECT c_custkey AS patient_id, {LINE_CASE} AS product_line
FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')"""

SQL["age_gender"] = f"""WITH {POP_CTE},
g AS (SELECT p.*, CASE WHEN c.c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
             CAST(p.measurement_year - year(p.date_of_birth) AS INTEGER) AS age
      FROM pop p JOIN customer c ON c.c_custkey = p.patient_id)
SELECT {UNIT_COLS}, gender, age FROM g
WHERE (measure_code = 'CBP' AND age BETWEEN 18 AND 85)
   OR (measure_code = 'COL' AND age BETWEEN 45 AND 75)
   OR (measure_code = 'GSD' AND age BETWEEN 18 AND 75)
   OR (measure_code = 'TRC' AND age BETWEEN 18 AND 64 AND gender = 'F')
   OR (measure_code = 'EED' AND age BETWEEN 18 AND 75)"""

# brute force: expand every enrollment span to its days
SQL["enrolled_months"] = """WITH
days AS (
    SELECT DISTINCT patient_id, d, CAST(year(d) AS INTEGER) AS measurement_year FROM (
        SELECT patient_id, CAST(base + CAST(k AS INTEGER) AS DATE) AS d FROM (
            SELECT o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS base, unnest(range(0, 1 + CASE
                WHEN o_orderkey % 41 = 0 OR o_orderkey % 43 = 0 THEN date_diff('day', CAST(o_orderdate AS DATE), last_day)
                ELSE least(120, date_diff('day', CAST(o_orderdate AS DATE), last_day)) END)) AS k
            FROM orders CROSS JOIN (SELECT make_date(max(year(o_orderdate)), 12, 31) AS last_day FROM orders)))
),
per_month AS (
    SELECT patient_id, measurement_year, month(d) AS m, count(*) AS n, day(max(last_day(d))) AS month_days
    FROM days GROUP BY 1, 2, 3
),
starts AS (
    SELECT a.patient_id, a.measurement_year, count(*) AS island_count
    FROM days a LEFT JOIN days b ON b.patient_id = a.patient_id AND b.d = a.d - 1
    WHERE b.d IS NULL OR b.measurement_year <> a.measurement_year
    GROUP BY 1, 2
),
cov AS (
    SELECT patient_id, measurement_year, sum(n) AS covered_days, sum(CASE WHEN n = month_days THEN 1 ELSE 0 END) AS covered_months
    FROM per_month GROUP BY 1, 2
)
SELECT c.patient_id, c.measurement_year, CAST(s.island_count AS BIGINT) AS island_count,
       CAST(c.covered_days AS BIGINT) AS covered_days, CAST(c.covered_months AS BIGINT) AS covered_months,
       c.covered_months >= 3 AND s.island_count <= 2 AS is_enrolled
FROM cov c JOIN starts s USING (patient_id, measurement_year)"""

SQL["with_event"] = f"""WITH {POP_CTE}
SELECT {UNIT_COLS} FROM pop p
WHERE EXISTS (SELECT 1 FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
              WHERE l.l_returnflag = 'R' AND o.o_custkey = p.patient_id AND year(o.o_orderdate) = p.measurement_year)"""

SQL["with_association"] = f"""WITH {POP_CTE}
SELECT {UNIT_COLS} FROM pop p JOIN customer c ON c.c_custkey = p.patient_id
WHERE c.c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000)"""

SQL["visit_attributes"] = f"""SELECT o_custkey AS patient_id, o_orderkey AS visit_id, {MEASURE_CASE} AS measure_code,
       CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey % 25 AS BIGINT) END AS facility_id,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS visit_type
FROM orders"""

SQL["exclusions"] = f"""WITH {POP_CTE}, {INVALID_CTE}
SELECT * FROM reasons"""


# ------------------------------------------------------------ replacement, sharing
GJ = " AND ".join(f"{{a}}.{c} = {{b}}.{c}" for c in ("submission_id", "product_line", "measure_code", "measurement_year"))

def replace_ctes(src: str) -> str:
    """Ordered replacement over ``src`` (drawn rows with is_excluded): the k-th
    excluded primary pairs with the k-th valid auxiliary by sample order."""
    return f"""
k AS (
    SELECT *,
        CASE WHEN list_type = 'Primary' AND is_excluded THEN row_number() OVER (
            PARTITION BY {GROUP_SQL}, (list_type = 'Primary' AND is_excluded) ORDER BY sample_order) END AS hole_k,
        CASE WHEN list_type = 'Auxiliary' AND NOT is_excluded THEN row_number() OVER (
            PARTITION BY {GROUP_SQL}, (list_type = 'Auxiliary' AND NOT is_excluded) ORDER BY sample_order) END AS fill_k
    FROM {src}
),
rep AS (
    SELECT a.*, h.sample_order AS replaces_order
    FROM k a LEFT JOIN k h ON {GJ.format(a='h', b='a')} AND h.hole_k = a.fill_k
),
final AS (
    SELECT *,
        CASE WHEN is_excluded THEN 'Excluded' WHEN list_type = 'Primary' THEN 'Primary'
             WHEN replaces_order IS NOT NULL THEN 'Primary' ELSE 'Auxiliary' END AS final_list,
        CAST(greatest(
            sum(CASE WHEN list_type = 'Primary' AND is_excluded THEN 1 ELSE 0 END) OVER (PARTITION BY {GROUP_SQL})
          - sum(CASE WHEN list_type = 'Auxiliary' AND NOT is_excluded THEN 1 ELSE 0 END) OVER (PARTITION BY {GROUP_SQL}), 0) AS BIGINT) AS shortfall
    FROM rep
)"""


FINAL_CTE = PLANS_CTE + "," + INVALID_CTE + f""",
flagged AS (
    SELECT l.*, r.exclusion_reason, r.exclusion_reason IS NOT NULL AS is_excluded
    FROM labelled l LEFT JOIN reasons r
      ON {GJ.format(a='r', b='l')} AND r.patient_id = l.patient_id AND r.visit_id IS NOT DISTINCT FROM l.visit_id
),""" + replace_ctes("flagged")

SQL["replace_excluded"] = f"""WITH {FINAL_CTE}
SELECT {UNIT_COLS}, CAST(sample_order AS BIGINT) AS sample_order, list_type, is_excluded, exclusion_reason, final_list,
       CAST(replaces_order AS BIGINT) AS replaces_order, shortfall
FROM final"""

SQL["sample_output"] = f"""WITH {FINAL_CTE}
SELECT f.submission_id, 'CMP-' || CAST(f.submission_id AS VARCHAR) || '-' || CAST(f.measurement_year AS VARCHAR) AS campaign_id,
       CAST(1 AS BIGINT) AS run_config_id, 'HEDIS' AS domain_id, f.product_line, f.measure_code, f.patient_id AS member_id,
       f.visit_id, f.measurement_year, f.population_rank, CAST(f.sample_order AS BIGINT) AS sample_order,
       CAST(pl.rand6 / 1000000 AS DECIMAL(9,6)) AS rand, f.list_type, f.final_list = 'Primary' AS is_primary,
       f.is_excluded, f.exclusion_reason, CAST(f.mrss_actual AS BIGINT) AS mrss_actual
FROM final f JOIN plans pl USING ({GROUP_SQL})"""

SQL["sample_summary"] = f"""WITH {FINAL_CTE}
SELECT f.submission_id, f.product_line, f.measure_code, f.measurement_year,
       max(pl.em) AS em, CAST(max(pl.mrss_actual) AS BIGINT) AS mrss_actual, CAST(max(pl.os_actual) AS BIGINT) AS os_actual,
       CAST(count(*) AS BIGINT) AS drawn,
       CAST(sum(CASE WHEN f.list_type = 'Primary' THEN 1 ELSE 0 END) AS BIGINT) AS primary_drawn,
       CAST(sum(CASE WHEN f.list_type = 'Auxiliary' THEN 1 ELSE 0 END) AS BIGINT) AS auxiliary_drawn,
       CAST(sum(CASE WHEN f.is_excluded THEN 1 ELSE 0 END) AS BIGINT) AS excluded,
       CAST(sum(CASE WHEN f.replaces_order IS NOT NULL AND NOT f.is_excluded AND f.list_type = 'Auxiliary' THEN 1 ELSE 0 END) AS BIGINT) AS replaced,
       CAST(sum(CASE WHEN f.final_list = 'Primary' THEN 1 ELSE 0 END) AS BIGINT) AS final_primary,
       max(f.shortfall) AS shortfall
FROM final f JOIN plans pl USING ({GROUP_SQL})
GROUP BY 1, 2, 3, 4"""

SHARED_SQL = "submission_id, product_line, shared_group, measurement_year"

SHARED_POP_CTE = f"""
spop AS (
    SELECT submission_id, product_line, 'GSD-EED' AS shared_group, measurement_year, patient_id,
           CAST(NULL AS BIGINT) AS visit_id, last_name, first_name, date_of_birth, min(event_date) AS event_date
    FROM pop WHERE measure_code IN ('GSD', 'EED')
    GROUP BY submission_id, product_line, measurement_year, patient_id, last_name, first_name, date_of_birth
),
sranked AS (SELECT *, {rank_expr(SHARED_SQL)} AS population_rank FROM spop),
{draw_ctes("s_", SHARED_SQL, "sranked", "s_counts c JOIN (SELECT 'GSD-EED' AS shared_group, 134 AS mrss_i, 1000 AS os_bp, 500000 AS rand6) s USING (shared_group)")}"""

SQL["shared_sample"] = f"""WITH {POP_CTE}, {SHARED_POP_CTE}
SELECT s.submission_id, s.product_line, s.shared_group, s.measurement_year, m.measure_code, s.patient_id,
       s.population_rank, CAST(s.sample_order AS BIGINT) AS sample_order, s.list_type
FROM s_labelled s JOIN (VALUES ('GSD'), ('EED')) AS m(measure_code) ON TRUE"""

SQL["spread_exclusions"] = f"""WITH {INVALID_CTE.split("reasons AS")[0].rstrip().rstrip(",")},
grp AS (SELECT * FROM (VALUES ('GSD', 'GSD-EED'), ('EED', 'GSD-EED')) AS g(measure_code, shared_group))
SELECT DISTINCT i.patient_id, coalesce(g2.measure_code, i.measure_code) AS measure_code, i.reason
FROM inv i LEFT JOIN grp g1 ON g1.measure_code = i.measure_code LEFT JOIN grp g2 ON g2.shared_group = g1.shared_group"""


# ------------------------------------------------------------------ control
REQ_CTE = """
req AS (
    SELECT DISTINCT 'REQ-' || CAST(c_custkey AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR) AS correlation_id,
        CASE WHEN c_mktsegment = 'MACHINERY' AND year(o_orderdate) % 2 = 0 THEN 'AUDIT' ELSE 'SAMPLING' END AS request_type,
        CASE WHEN year(o_orderdate) < 1997 THEN 'PROCESSED' ELSE 'received' END AS campaign_status,
        CASE WHEN year(o_orderdate) < 1997 THEN 1 ELSE 0 END AS is_sampling_processed,
        c_custkey AS submission_id, CAST(year(o_orderdate) AS INTEGER) AS measurement_year,
        CAST(c_nationkey AS BIGINT) AS run_config_id
    FROM orders JOIN customer ON c_custkey = o_custkey
),
open_req AS (
    SELECT * FROM req WHERE request_type = 'SAMPLING' AND campaign_status = 'received' AND is_sampling_processed = 0
)"""

OUTCOME_CTE = RATES_CTE + "," + REQ_CTE + """,
outcome AS (
    SELECT correlation_id, correlation_id IN (SELECT correlation_id FROM agg) AS succeeded FROM open_req
)"""

SQL["open_requests"] = f"""WITH {REQ_CTE}
SELECT correlation_id, request_type, campaign_status, is_sampling_processed FROM open_req"""

SQL["requested_measures"] = f"""WITH {FLAT_CTE}, {REQ_CTE}
SELECT o_custkey AS patient_id, o_orderkey AS visit_id, {MEASURE_CASE} AS measure_code,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'visit' ELSE 'member' END AS grain,
       CASE WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN 'GSD-EED' END AS shared_group
FROM orders WHERE {MEASURE_CASE} IN (
    SELECT measure_code FROM flat WHERE correlation_id IN (SELECT correlation_id FROM open_req))"""

SQL["not_yet_sampled"] = f"""WITH {REQ_CTE}
SELECT correlation_id, submission_id, measurement_year FROM open_req r
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'F'
                  AND o.o_custkey = r.submission_id AND year(o.o_orderdate) = r.measurement_year)"""

SQL["close_requests"] = f"""WITH {OUTCOME_CTE}
SELECT r.correlation_id, r.request_type,
       CASE WHEN o.succeeded THEN 'PROCESSED' WHEN NOT o.succeeded THEN 'FAILED' ELSE r.campaign_status END AS campaign_status,
       CASE WHEN o.succeeded THEN 1 WHEN NOT o.succeeded THEN 0 ELSE r.is_sampling_processed END AS is_sampling_processed
FROM req r LEFT JOIN outcome o USING (correlation_id)"""

SQL["failure_rows"] = f"""WITH {OUTCOME_CTE}
SELECT correlation_id, 'hybrid-sampling' AS process_name, 'no sampling factors resolved' AS error_message
FROM outcome WHERE NOT succeeded"""

SQL["resolve_sources"] = f"""WITH {REQ_CTE}
SELECT r.correlation_id, r.run_config_id, CAST(n.n_regionkey AS BIGINT) AS source_detail_id,
       'base_data_lck_' || lower(replace(g.r_name, ' ', '_')) AS table_name
FROM open_req r JOIN nation n ON n.n_nationkey = r.run_config_id JOIN region g ON g.r_regionkey = n.n_regionkey"""

SQL["prerequisites"] = """WITH
o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
st AS (
    SELECT 'MP' AS check_name, y AS measurement_year, count(*) > 0 AS passed FROM o GROUP BY y
    UNION ALL
    SELECT 'PP', y, y IN (SELECT year(l_shipdate) FROM lineitem) FROM (SELECT DISTINCT y FROM o)
    UNION ALL
    SELECT 'FQR', y, bool_and(o_orderkey IN (SELECT l_orderkey FROM lineitem)) FROM o GROUP BY y
),
tb AS (
    SELECT 'table:sampling_request' AS check_name, CAST(NULL AS INTEGER) AS measurement_year,
           (SELECT count(*) > 0 FROM orders JOIN customer ON c_custkey = o_custkey) AS passed
    UNION ALL SELECT 'table:size_info', NULL, true
    UNION ALL SELECT 'table:size_bands', NULL, true
    UNION ALL SELECT 'table:rand_values', NULL, true
    UNION ALL SELECT 'table:base_data', NULL, (SELECT count(*) > 0 FROM orders)
),
ready AS (
    SELECT 'ready' AS check_name, measurement_year,
           bool_and(passed) AND count(DISTINCT check_name) = 3 AND (SELECT bool_and(passed) FROM tb) AS passed
    FROM st GROUP BY measurement_year
)
SELECT * FROM st UNION ALL SELECT * FROM tb UNION ALL SELECT * FROM ready"""

# ------------------------------------------------------------------ sinks
SQL["freeze_roundtrip"] = f"""SELECT o_custkey AS patient_id, o_orderkey AS visit_id, {MEASURE_CASE} AS measure_code,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 6 ELSE 2 END AS clinical_status_code,
       CASE WHEN o_orderkey % 20 = 0 THEN 1 ELSE 0 END AS is_deleted,
       CAST(year(o_orderdate) AS INTEGER) AS measurement_year, CAST(o_orderdate AS DATE) AS event_date
FROM orders"""

SQL["write_sample_roundtrip"] = SQL["sample_output"]
SQL["csv_roundtrip"] = SQL["sample_summary"]


# ------------------------------------------------------------------ whole job
SQL["sample_all"] = f"""WITH {PLANS_CTE}, {INVALID_CTE}, {SHARED_POP_CTE},
drawn_all AS (
    SELECT submission_id, product_line, measure_code, measurement_year, patient_id, visit_id, measure_code AS sampled_as,
           population_rank, sample_order, list_type
    FROM labelled WHERE measure_code NOT IN ('GSD', 'EED')
    UNION ALL
    SELECT s.submission_id, s.product_line, m.measure_code, s.measurement_year, s.patient_id, s.visit_id, s.shared_group,
           s.population_rank, s.sample_order, s.list_type
    FROM s_labelled s JOIN (VALUES ('GSD'), ('EED')) AS m(measure_code) ON TRUE
),
rsn AS (
    SELECT d.submission_id, d.product_line, d.measure_code, d.measurement_year, d.patient_id, d.visit_id, i.reason,
        row_number() OVER (
            PARTITION BY d.submission_id, d.product_line, d.measure_code, d.measurement_year, d.patient_id, d.visit_id
            ORDER BY CASE i.reason WHEN 'deceased' THEN 0 WHEN 'hospice' THEN 1 WHEN 'employee' THEN 2
                                   WHEN 'duplicate' THEN 3 WHEN 'data error' THEN 4 ELSE 5 END) AS rn
    FROM drawn_all d JOIN inv i ON i.patient_id = d.patient_id AND (
        i.measure_code IS NULL OR i.measure_code = d.measure_code
        OR (i.measure_code IN ('GSD', 'EED') AND d.measure_code IN ('GSD', 'EED')))
),
flagged_all AS (
    SELECT d.*, r.reason AS exclusion_reason, r.reason IS NOT NULL AS is_excluded
    FROM drawn_all d LEFT JOIN (SELECT * FROM rsn WHERE rn = 1) r
      ON {GJ.format(a='r', b='d')} AND r.patient_id = d.patient_id AND r.visit_id IS NOT DISTINCT FROM d.visit_id
),{replace_ctes("flagged_all")}
SELECT {UNIT_COLS}, sampled_as, population_rank, CAST(sample_order AS BIGINT) AS sample_order, list_type,
       is_excluded, exclusion_reason, final_list, CAST(replaces_order AS BIGINT) AS replaces_order, shortfall
FROM final"""

SQL["event_dates"] = f"""SELECT o.o_custkey AS patient_id, o.o_orderkey AS visit_id, {MEASURE_CASE} AS measure_code,
       (SELECT min(CAST(l.l_shipdate AS DATE)) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS event_date
FROM orders o"""


# ------------------------------------------- several submissions, lines and requests
BOOK_CTE = f"""
yr AS (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders),
oc AS (
    SELECT o.*, c.c_nationkey, c.c_acctbal, CAST(o_custkey % 2 + 1 AS BIGINT) AS sub, {LINE_CASE} AS line, CAST(year(o_orderdate) AS INTEGER) AS yy, {MEASURE_CASE} AS mm
    FROM orders o JOIN customer c ON c_custkey = o_custkey
),
asked AS (
    SELECT sub, line, yy, mm, CAST(sum(o_orderkey) % 101 AS DECIMAL(5,2)) AS cy0, CAST(sum(o_custkey) % 101 AS DECIMAL(5,2)) AS py0,
        CAST(sum(o_custkey) % 30 AS DECIMAL(5,2)) AS os0
    FROM oc GROUP BY ALL
),
reqs AS (
    SELECT *, 'BOOK-' || sub || '-' || line || '-' || yy AS correlation_id, sub = 2 AND line = 'Medicare' AND yy % 3 = 0 AND mm = 'CBP' AS overflow FROM asked
    UNION ALL
    SELECT sub, line, yy, mm, cy0, py0, 5.00, 'AGAIN-BOOK-' || sub || '-' || line || '-' || yy, false
    FROM asked WHERE sub = 1 AND line = 'Medicaid' AND yy % 2 = 0 AND mm = 'CBP'
),
usable AS (
    SELECT r.*,
        CASE WHEN line = 'Commercial' OR line = 'Medicaid' OR line = 'Medicare' THEN NOT (mm = 'EED' AND line = 'Medicare') ELSE false END AS has_info,
        CASE WHEN mm = 'GSD' THEN 100 - cy0 ELSE cy0 END AS cy, CASE WHEN mm = 'GSD' THEN 100 - py0 ELSE py0 END AS py
    FROM reqs r WHERE line <> 'Exchange' AND NOT (sub = 1 AND line = 'Medicare' AND yy % 5 = 3)
),
rated AS (
    SELECT *, CASE WHEN sub = 2 AND yy % 2 = 1 THEN CASE WHEN mm IN ('CBP', 'COL') THEN 'CBP+COL' END
                   ELSE CASE WHEN mm IN ('GSD', 'EED') THEN 'GSD-EED' END END AS shared_group,
        CAST(least(CASE WHEN has_info AND NOT (mm = 'COL' AND line = 'Medicare') AND mm <> 'TRC' THEN cy END,
                   CASE WHEN has_info AND NOT (mm = 'CBP' AND line = 'Medicaid') THEN py END) AS DECIMAL(5,2)) AS rate,
        CASE WHEN has_info THEN CASE mm WHEN 'CBP' THEN 411 WHEN 'COL' THEN 230 WHEN 'TRC' THEN 106 ELSE 134 END END AS info_size,
        CASE WHEN has_info THEN CASE mm WHEN 'TRC' THEN 15.00 ELSE 10.00 END END AS info_os
    FROM usable
),
low AS (SELECT *, CASE WHEN shared_group IS NULL THEN rate ELSE min(rate) OVER (PARTITION BY correlation_id, shared_group) END AS shared_rate FROM rated),
fac AS (
    SELECT correlation_id, sub AS submission_id, line AS product_line, mm AS measure_code, yy AS measurement_year, shared_group, rate, shared_rate, overflow,
        CAST(coalesce(CASE WHEN shared_rate >= 95 THEN 6 WHEN shared_rate >= 90 THEN 9
                           WHEN shared_rate >= 0 THEN CASE WHEN line = 'Medicaid' AND yy % 6 = 4 THEN 0 ELSE 15 END END, info_size, 411) AS BIGINT) AS mrss,
        CAST(least(coalesce(CASE WHEN NOT overflow THEN os0 END, info_os, 10.00), 20.00) AS DECIMAL(5,2)) AS os_pct,
        CASE WHEN mm = 'COL' AND yy % 5 = 0 THEN NULL WHEN mm = 'TRC' AND yy % 4 = 1 THEN 1500000
             ELSE CASE mm WHEN 'CBP' THEN 950000 WHEN 'COL' THEN 750000 WHEN 'GSD' THEN 660000 WHEN 'TRC' THEN 250000 ELSE 500000 END END AS rand6
    FROM low
),
wrong AS (
    SELECT correlation_id, w || ' for ' || string_agg(measure_code, ',' ORDER BY measure_code) AS error
    FROM (SELECT *, CASE WHEN mrss <= 0 THEN 'sample size not positive' WHEN rand6 IS NULL THEN 'missing RAND' WHEN rand6 > 1000000 THEN 'RAND outside 0 to 1' END AS w FROM fac)
    WHERE w IS NOT NULL GROUP BY correlation_id, w
    UNION ALL
    SELECT correlation_id, 'number outside 0 to 100: CBP oversamplingRate' FROM reqs WHERE overflow
    UNION ALL
    SELECT DISTINCT correlation_id, 'year ' || yy || ' not ready: FQR' FROM reqs, yr WHERE yy = hi
    UNION ALL
    SELECT DISTINCT correlation_id, 'no source table for run configuration 99' FROM reqs WHERE sub = 2 AND line = 'Commercial' AND yy % 7 = 5
),
sound AS (SELECT *, count(*) OVER (PARTITION BY submission_id, product_line, measure_code, measurement_year) AS claims FROM fac WHERE correlation_id NOT IN (SELECT correlation_id FROM wrong)),
clash AS (
    SELECT correlation_id, 'conflicting factors for ' || string_agg(DISTINCT measure_code, ',' ORDER BY measure_code) AS error FROM sound WHERE claims > 1 GROUP BY 1
),
bad AS (SELECT correlation_id, string_agg(error, '; ' ORDER BY error) AS error FROM (SELECT * FROM wrong UNION ALL SELECT * FROM clash) GROUP BY 1),
good AS (
    SELECT f.*, CAST((mrss * (10000 + CAST(os_pct * 100 AS BIGINT)) + 9999) // 10000 AS BIGINT) AS fss, submission_id = 1 AS exclude_emp,
        CASE WHEN submission_id = 2 THEN 'QC' END AS domain_id, CASE WHEN submission_id = 2 THEN 'CAMPAIGN-' || measurement_year END AS campaign_id
    FROM fac f WHERE correlation_id NOT IN (SELECT correlation_id FROM bad)
)"""

BOOK_POP_CTE = BOOK_CTE + f""",
dup AS (
    SELECT c_custkey AS patient_id FROM (
        SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_mktsegment, c_nationkey, floor(c_acctbal / 20)) AS first FROM customer)
    WHERE c_custkey > first
),
d_span AS (
    SELECT DISTINCT patient_id, d, CAST(year(d) AS INTEGER) AS y FROM (
        SELECT patient_id, CAST(base + CAST(k AS INTEGER) AS DATE) AS d FROM (
            SELECT o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS base, unnest(range(0, 1 + CASE
                WHEN o_orderkey % 41 = 0 OR o_orderkey % 43 = 0 THEN date_diff('day', CAST(o_orderdate AS DATE), make_date(hi, 12, 31))
                ELSE least(120, date_diff('day', CAST(o_orderdate AS DATE), make_date(hi, 12, 31))) END)) AS k
            FROM orders, yr))
),
d_months AS (
    SELECT patient_id, y, sum(CASE WHEN n = days THEN 1 ELSE 0 END) AS months FROM (
        SELECT patient_id, y, month(d) AS m, count(*) AS n, day(max(last_day(d))) AS days FROM d_span GROUP BY 1, 2, 3) GROUP BY 1, 2
),
d_islands AS (
    SELECT a.patient_id, a.y, count(*) AS islands FROM d_span a LEFT JOIN d_span b ON b.patient_id = a.patient_id AND b.d = a.d - 1
    WHERE b.d IS NULL OR b.y <> a.y GROUP BY 1, 2
),
enr AS (SELECT patient_id, y FROM d_months JOIN d_islands USING (patient_id, y) WHERE months >= 3 AND islands <= 2),
b_fact AS (
    SELECT g.submission_id, g.product_line, g.measure_code, g.measurement_year, g.shared_group, oc.o_custkey AS patient_id,
        CASE WHEN g.measure_code = 'TRC' THEN oc.o_orderkey END AS visit_id, min(CAST(oc.o_orderdate AS DATE)) AS event_date
    FROM oc JOIN good g ON g.submission_id = oc.sub AND g.product_line = oc.line AND g.measure_code = oc.mm AND g.measurement_year = oc.yy
    WHERE oc.o_orderstatus IN ('F', 'O') AND oc.o_orderkey % 20 <> 0 AND NOT (g.exclude_emp AND oc.o_custkey % 50 = 0)
    GROUP BY ALL
),
b_pop AS (
    SELECT f.*, c.c_mktsegment AS last_name, c.c_name AS first_name,
        CAST(DATE '1940-01-01' + CAST((c.c_custkey * 7919) % 25000 AS INTEGER) AS DATE) AS date_of_birth
    FROM b_fact f JOIN customer c ON c.c_custkey = f.patient_id
    WHERE c.c_acctbal >= 0 AND c.c_custkey % 37 <> 0 AND c.c_custkey NOT IN (SELECT patient_id FROM dup)
      AND c.c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000)
      AND (f.patient_id, f.measurement_year) IN (SELECT patient_id, y FROM enr)
      AND EXISTS (SELECT 1 FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
                  WHERE l.l_returnflag = 'R' AND o.o_custkey = f.patient_id AND year(o.o_orderdate) = f.measurement_year)
),
b_elig AS (
    SELECT p.* FROM (SELECT p.*, measurement_year - year(date_of_birth) AS age, c.c_nationkey % 2 = 0 AS woman FROM b_pop p JOIN customer c ON c.c_custkey = p.patient_id) p
    WHERE CASE measure_code WHEN 'CBP' THEN age BETWEEN 18 AND 85 WHEN 'COL' THEN age BETWEEN 45 AND 75 WHEN 'TRC' THEN age BETWEEN 18 AND 64 AND woman
               ELSE age BETWEEN 18 AND 75 END
)"""

B_UNIT = "submission_id, product_line, sampling_unit, measurement_year"
_B_DRAW = draw_ctes("b_", B_UNIT, "b_ranked", f"b_counts c JOIN b_sizes s USING ({B_UNIT})")
BOOK_FINAL_CTE = BOOK_POP_CTE + f""",
b_unit AS (
    SELECT submission_id, product_line, coalesce(shared_group, measure_code) AS sampling_unit, measurement_year, patient_id,
        CASE WHEN shared_group IS NULL THEN visit_id END AS visit_id, last_name, first_name, date_of_birth, min(event_date) AS event_date
    FROM b_elig GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9
),
b_ranked AS (SELECT *, {rank_expr(B_UNIT)} AS population_rank FROM b_unit),
b_sizes AS (
    SELECT submission_id, product_line, coalesce(shared_group, measure_code) AS sampling_unit, measurement_year, mrss AS mrss_i, CAST(os_pct * 100 AS BIGINT) AS os_bp, rand6
    FROM (SELECT *, row_number() OVER (PARTITION BY submission_id, product_line, coalesce(shared_group, measure_code), measurement_year
                                       ORDER BY mrss DESC, os_pct DESC, measure_code) AS rn FROM good) WHERE rn = 1
),
{_B_DRAW},
b_lists AS (
    SELECT l.submission_id, l.product_line, g.measure_code, l.measurement_year, l.patient_id, l.visit_id, l.sampling_unit AS sampled_as,
        l.population_rank, l.sample_order, l.list_type, g.correlation_id, g.domain_id, g.campaign_id
    FROM b_labelled l JOIN good g ON g.submission_id = l.submission_id AND g.product_line = l.product_line AND g.measurement_year = l.measurement_year
     AND coalesce(g.shared_group, g.measure_code) = l.sampling_unit
),
b_err AS (SELECT DISTINCT o_custkey AS patient_id, {MEASURE_CASE} AS measure_code FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 50 = 0),
b_hit AS (
    SELECT *, EXISTS (SELECT 1 FROM b_err e WHERE e.patient_id = b.patient_id AND e.measure_code = b.measure_code) AS own FROM b_lists b
),
b_flag AS (
    SELECT *, bool_or(own) OVER (PARTITION BY submission_id, product_line, measurement_year, sampled_as, patient_id, visit_id) AS is_excluded FROM b_hit
),
b_flagged AS (SELECT *, CASE WHEN is_excluded THEN 'data error' END AS exclusion_reason FROM b_flag),""" + replace_ctes("b_flagged")

SQL["book_factors"] = f"""WITH {BOOK_CTE}
SELECT correlation_id, {GROUP_SQL}, shared_group, rate, shared_rate, mrss, os_pct, fss, CAST(rand6 / 1000000 AS DECIMAL(9,6)) AS rand, exclude_emp, domain_id, campaign_id
FROM good"""

SQL["book_errors"] = f"""WITH {BOOK_CTE}
SELECT correlation_id, error FROM bad"""

SQL["eligible_full"] = f"""WITH {BOOK_POP_CTE}
SELECT {UNIT_COLS}, event_date FROM b_elig"""

# the catalogue: each measure's own ages, gender, months, gaps, event and association (EED and GSD by the general row)
SQL["eligible_catalogue"] = f"""WITH {BOOK_POP_CTE},
told AS (
    SELECT f.*, c.c_nationkey, f.measurement_year - year(CAST(DATE '1940-01-01' + CAST((c.c_custkey * 7919) % 25000 AS INTEGER) AS DATE)) AS age,
        coalesce(m.months, 0) AS months, coalesce(i.islands, 0) AS islands,
        c.c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000) AS associated,
        EXISTS (SELECT 1 FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
                WHERE l.l_returnflag = 'R' AND o.o_custkey = f.patient_id AND year(o.o_orderdate) = f.measurement_year) AS returned,
        EXISTS (SELECT 1 FROM orders o WHERE o.o_orderpriority = '1-URGENT' AND o.o_custkey = f.patient_id AND year(o.o_orderdate) = f.measurement_year) AS urgent
    FROM b_fact f JOIN customer c ON c.c_custkey = f.patient_id
    LEFT JOIN d_months m ON m.patient_id = f.patient_id AND m.y = f.measurement_year
    LEFT JOIN d_islands i ON i.patient_id = f.patient_id AND i.y = f.measurement_year
    WHERE c.c_acctbal >= 0 AND c.c_custkey % 37 <> 0 AND c.c_custkey NOT IN (SELECT patient_id FROM dup)
)
SELECT {UNIT_COLS}, CAST(event_date AS VARCHAR) AS event_date FROM told
WHERE CASE measure_code
    WHEN 'CBP' THEN age BETWEEN 18 AND 85 AND months >= 3 AND islands BETWEEN 1 AND 2 AND returned AND associated
    WHEN 'COL' THEN age BETWEEN 45 AND 75 AND months >= 4 AND islands = 1
    WHEN 'TRC' THEN age BETWEEN 18 AND 64 AND c_nationkey % 2 = 0 AND returned
    ELSE age BETWEEN 18 AND 75 AND months >= 2 AND islands BETWEEN 1 AND 3 AND urgent AND associated END"""

# an event begins a delivery when none stands in the 45 days before it; each event belongs to the last such day
SQL["delivery_episodes"] = """WITH
ev AS (SELECT o_custkey AS p, o_orderkey AS v, CAST(l_shipdate AS DATE) AS d FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
days AS (SELECT DISTINCT p, d FROM ev),
begins AS (SELECT p, d FROM days a WHERE NOT EXISTS (SELECT 1 FROM days b WHERE b.p = a.p AND b.d < a.d AND b.d >= a.d - 45)),
own AS (SELECT e.p, e.v, e.d, max(b.d) AS anchor FROM ev e JOIN begins b ON b.p = e.p AND b.d <= e.d GROUP BY e.p, e.v, e.d, e.rowid)
SELECT p AS patient_id, CAST(row_number() OVER (PARTITION BY p ORDER BY anchor) AS INTEGER) AS episode, CAST(anchor AS VARCHAR) AS anchor_date,
    min(v) FILTER (WHERE d = anchor) AS visit_id, CAST(count(DISTINCT d) AS BIGINT) AS n_days, CAST(count(*) AS BIGINT) AS n_events
FROM own GROUP BY p, anchor""".replace(
    "SELECT o_custkey AS p, o_orderkey AS v, CAST(l_shipdate AS DATE) AS d FROM orders", "SELECT row_number() OVER () AS rowid, o_custkey AS p, o_orderkey AS v, CAST(l_shipdate AS DATE) AS d FROM orders"
)

# a stay begins an episode when no stay that began earlier reaches the day before it
SQL["discharge_episodes"] = """WITH
st AS (SELECT row_number() OVER () AS i, o_custkey AS p, o_orderkey AS v, CAST(l_shipdate AS DATE) AS a, CAST(CAST(l_shipdate AS DATE) + CAST(l_partkey % 20 AS INTEGER) AS DATE) AS d
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_partkey % 31 <> 0),
begins AS (SELECT DISTINCT p, a FROM st x WHERE NOT EXISTS (SELECT 1 FROM st y WHERE y.p = x.p AND y.a < x.a AND y.d >= x.a - 1)),
own AS (SELECT s.i, s.p, s.v, s.d, max(b.a) AS admit FROM st s JOIN begins b ON b.p = s.p AND b.a <= s.a GROUP BY ALL),
last AS (SELECT *, max(d) OVER (PARTITION BY p, admit) AS anchor FROM own)
SELECT p AS patient_id, CAST(row_number() OVER (PARTITION BY p ORDER BY admit) AS INTEGER) AS episode, CAST(admit AS VARCHAR) AS admit_date,
    CAST(anchor AS VARCHAR) AS anchor_date, min(v) FILTER (WHERE d = anchor) AS visit_id, CAST(count(*) AS BIGINT) AS n_stays
FROM last GROUP BY p, admit, anchor"""

EXTRACT_CTE = """
years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS measurement_year FROM orders),
enc AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderkey % 25 = 0 AS odd FROM orders),
met AS (
    SELECT 'extract:RE_Encounter' AS check_name, y AS measurement_year, count(*) AS n_rows, count(*) FILTER (WHERE odd AND y % 3 = 0) AS null_keys,
           count(*) FILTER (WHERE odd AND y % 3 <> 0 AND y % 2 = 0) AS orphan_keys, 1 AS least, 0.01 AS nulls, 0.05 AS orphans FROM enc GROUP BY y
    UNION ALL
    SELECT 'extract:RE_Claims', m.measurement_year, count(l_orderkey), 0, 0, 100, 0, 0
    FROM years m LEFT JOIN (lineitem JOIN orders ON o_orderkey = l_orderkey) ON year(l_shipdate) = m.measurement_year GROUP BY m.measurement_year
),
extract_passed AS (SELECT *, n_rows >= least AND null_keys <= nulls * n_rows AND orphan_keys <= orphans * n_rows AS passed FROM met)"""

SQL["extract_checks"] = f"""WITH {EXTRACT_CTE}
SELECT check_name, measurement_year, CAST(n_rows AS BIGINT) AS n_rows, CAST(null_keys AS BIGINT) AS null_keys, CAST(orphan_keys AS BIGINT) AS orphan_keys, passed FROM extract_passed"""

# stages: every order has a line item, lines shipped in the year; the last year is not reviewed
SQL["ready_years"] = f"""WITH {EXTRACT_CTE},
bare AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
SELECT measurement_year, measurement_year < (SELECT max(measurement_year) FROM years)
    AND measurement_year IN (SELECT year(l_shipdate) FROM lineitem)
    AND measurement_year NOT IN (SELECT measurement_year FROM extract_passed WHERE NOT passed) AS passed
FROM years"""

# rows as text, columns in the order of their names, digested and summed
SQL["freeze_manifest"] = f"""WITH f AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS measurement_year, CAST(o_custkey % 2 + 1 AS BIGINT) AS submission_id,
        concat_ws('|', {MEASURE_CASE}, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 6 WHEN 'P' THEN 2 END AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR),
            CASE WHEN o_orderkey % 20 = 0 THEN '1' ELSE '0' END, {MEASURE_CASE}, CAST(year(o_orderdate) AS VARCHAR), CAST(o_custkey % 2 + 1 AS VARCHAR),
            CAST(o_custkey AS VARCHAR), CAST(year(o_orderdate) AS VARCHAR), CAST(o_custkey % 2 + 1 AS VARCHAR), CAST(o_custkey % 2 + 1 AS VARCHAR), CAST(o_orderkey AS VARCHAR)) AS t
    FROM orders)
SELECT measurement_year, submission_id, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(CAST(('0x' || substr(md5(t), 1, 13)) AS BIGINT)) AS VARCHAR) AS fingerprint,
    'FQR,MP,PP' AS gate, 'first' AS run_id
FROM f WHERE measurement_year < (SELECT max(year(o_orderdate)) FROM orders) GROUP BY 1, 2"""

SQL["duplicate_members"] = """SELECT c_custkey AS patient_id, 'duplicate' AS reason FROM (
    SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_mktsegment, c_nationkey, floor(c_acctbal / 20)) AS first FROM customer)
WHERE c_custkey > first"""

SQL["sample_requests"] = f"""WITH {BOOK_FINAL_CTE}
SELECT {UNIT_COLS}, correlation_id, domain_id, campaign_id, sampled_as, population_rank, CAST(sample_order AS BIGINT) AS sample_order, list_type,
       is_excluded, exclusion_reason, final_list, CAST(replaces_order AS BIGINT) AS replaces_order, shortfall
FROM final"""


# ------------------------------------------- decimals and dates at the boundary
# the checked outputs present exact decimals as doubles and dates as ISO text (see registry)
DECIMAL_COLUMNS = {
    "request_flatten": ("oversampling_rate", "cyar", "pyr"),
    "rates_invert_gate": ("cyar", "pyr", "info_os_pct", "cyar_used", "pyr_used"),
    "rates_lowest": ("oversampling_rate", "min_cyar", "min_pyr", "rate"),
    "rates_coalesce": ("oversampling_rate", "min_cyar", "min_pyr", "rate"),
    "rates_shared": ("rate", "shared_rate"),
    "mrss_band": ("rate",),
    "mrss_default": ("rate",),
    "os_cap": ("oversampling_rate", "info_os_pct", "os_requested", "os_pct"),
    "fss_ceiling": ("os_pct",),
    "plan_scenarios": ("os_pct", "rand"),
    "book_factors": ("rate", "shared_rate", "os_pct", "rand"),
    "sample_output": ("rand",),
    "write_sample_roundtrip": ("rand",),
}


def _as_double(sql: str, cols) -> str:
    repl = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n)"


for _k, _cols in DECIMAL_COLUMNS.items():
    SQL[_k] = _as_double(SQL[_k], _cols)

# dates are shown as ISO text (yyyy-MM-dd)
DATE_COLUMNS = {
    "eligible_member": ("event_date", "date_of_birth"),
    "eligible_full": ("event_date",),
    "eligible_visit": ("event_date",),
    "event_dates": ("event_date",),
    "freeze_roundtrip": ("event_date",),
}
for _k, _cols in DATE_COLUMNS.items():
    _repl = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _cols)
    SQL[_k] = f"SELECT * REPLACE ({_repl}) FROM (\n{SQL[_k]}\n)"
