"""The registered queries as plain SQL over the given tables.

The dimension texts do not merge batch by batch: a version starts wherever a key's
row in a batch differs from the key's row in the batch it was last seen in.
"""

from __future__ import annotations

from dimflow.plans.views import BATCHES, LOANS_SQL, UPDATES_SQL
from dimflow.schemas import DIM_CUSTOMER, DIM_LOAN, LOAN_COLUMNS, DimSpec

_LOANS = f"loans AS ({LOANS_SQL.format(orders='orders', customer='customer')})"

_UPDATES = f"updates AS ({UPDATES_SQL.format(lineitem='lineitem', orders='orders', customer='customer')})"

_STATUSES = "('Applied', 'Approved', 'Disbursed', 'Repaid', 'Defaulted')"
_VALID_WHEN = f"""customer_id IS NOT NULL AND loan_id IS NOT NULL
 AND (loan_amount IS NULL OR loan_amount > 0)
 AND (interest_rate IS NULL OR (interest_rate >= 0 AND interest_rate <= 100))
 AND (term_months IS NULL OR term_months > 0)
 AND (status IS NULL OR status IN {_STATUSES})"""

_FLAGS = {
    "missing_customer_id": "customer_id IS NULL",
    "missing_loan_id": "loan_id IS NULL",
    "invalid_loan_amount": "loan_amount <= 0",
    "invalid_interest_rate": "interest_rate < 0 OR interest_rate > 100",
    "invalid_term": "term_months <= 0",
    "invalid_status": f"status NOT IN {_STATUSES}",
}
_FLAG_COLUMNS = ", ".join(f"CASE WHEN {w} THEN 1 ELSE 0 END AS {n}" for n, w in _FLAGS.items())
_FLAGGED = (
    f"raised AS (SELECT *, {_FLAG_COLUMNS} FROM loans), "
    f"flagged AS (SELECT *, {' + '.join(_FLAGS)} AS quality_issue FROM raised)"
)

_CATEGORY = """CASE WHEN loan_amount < 5000 THEN 'Small'
 WHEN loan_amount >= 5000 AND loan_amount <= 20000 THEN 'Medium' ELSE 'Large' END"""
_PAYMENT = """round(CASE WHEN term_months IS NULL OR term_months <= 0 THEN NULL
 WHEN interest_rate IS NULL OR interest_rate = 0 THEN loan_amount / term_months
 ELSE loan_amount * (interest_rate / 100 / 12)
      / nullif(1 - pow(1 + interest_rate / 100 / 12, -term_months), 0) END, 8)"""
_VALID = f"valid AS (SELECT *, {_CATEGORY} AS loan_category FROM loans WHERE {_VALID_WHEN})"

_VALID_UPDATES = f"valid_updates AS (SELECT *, {_CATEGORY} AS loan_category FROM updates WHERE {_VALID_WHEN})"
_CHANGES = f"{_UPDATES}, {_VALID_UPDATES}"

_LOAN_COLUMNS = ", ".join(LOAN_COLUMNS)


def _text(*ctes: str, body: str) -> str:
    return f"WITH {', '.join(ctes)} {body}"


def _slice(spec: DimSpec, batch: str = "0", unknown_at_first: str | None = None) -> str:
    """Latest row per batch and key. ``unknown_at_first``: a column that batch 1 did not have."""
    key = spec.keys[0]
    order = [c for c in spec.order_by if c not in spec.keys]
    order += [c for c in spec.tracked if c not in order and c != unknown_at_first]
    latest = ", ".join(f"{c} DESC NULLS LAST" for c in [*order, unknown_at_first] if c)
    columns = [
        f"CASE WHEN {batch} > 1 THEN {c} END AS {c}" if c == unknown_at_first else c for c in spec.columns
    ]
    return f"""seen AS (
 SELECT * FROM (
  SELECT {batch} AS batch_no, {', '.join(columns)},
   row_number() OVER (PARTITION BY {batch}, {key} ORDER BY {latest}) AS recency
  FROM valid_updates) WHERE recency = 1 AND {key} IS NOT NULL)"""


def _versions(spec: DimSpec, batch: str, run_date: str, unknown_at_first: str | None = None) -> str:
    """Versions with surrogate keys and dates, from all batches at once."""
    key = spec.keys[0]
    before = ", ".join(f"lag({c}) OVER seen_before AS was_{c}" for c in spec.tracked)
    differs = " OR ".join(f"{c} IS DISTINCT FROM was_{c}" for c in spec.tracked)
    return f"""{_slice(spec, batch, unknown_at_first)},
 followed AS (
  SELECT *, lag(batch_no) OVER seen_before IS NULL AS is_new, {before} FROM seen
  WINDOW seen_before AS (PARTITION BY {key} ORDER BY batch_no)),
 versions AS (
  SELECT {', '.join(spec.columns)},
   row_number() OVER (ORDER BY batch_no, is_new, {key}) AS surrogate_key,
   {run_date} AS valid_from,
   lead({run_date}) OVER (PARTITION BY {key} ORDER BY batch_no) AS next_from
  FROM followed WHERE is_new OR {differs}),
 spans AS (SELECT *, coalesce(next_from, DATE '9999-12-31') AS valid_to FROM versions)"""


_BATCH_NO = f"""CASE WHEN CAST(last_updated AS DATE) < DATE '{BATCHES[1].start}' THEN 1
 WHEN CAST(last_updated AS DATE) < DATE '{BATCHES[2].start}' THEN 2 ELSE 3 END"""
_RUN_DATE = "CASE batch_no " + " ".join(
    f"WHEN {i} THEN DATE '{b.process_date}'" for i, b in enumerate(BATCHES, 1)
) + " END"
_CUSTOMER = _versions(DIM_CUSTOMER, _BATCH_NO, _RUN_DATE)
_LOAN = _versions(DIM_LOAN, _BATCH_NO, _RUN_DATE)
_WIDENED = _versions(DIM_CUSTOMER, _BATCH_NO, _RUN_DATE, DIM_CUSTOMER.tracked[-1])


def _type2(spec: DimSpec, only_current: bool = False) -> str:
    return f"""SELECT {', '.join(spec.columns)}, surrogate_key, valid_from AS effective_start_date,
 valid_to AS effective_end_date, next_from IS NULL AS is_current FROM spans
 {'WHERE next_from IS NULL' if only_current else ''}"""


def _type4_current(spec: DimSpec) -> str:
    return f"""SELECT {', '.join(spec.columns)}, valid_from AS record_effective_date
 FROM spans WHERE next_from IS NULL"""


def _spans(spec: DimSpec) -> str:
    return f"SELECT {', '.join(spec.columns)}, valid_from, valid_to FROM spans"


def _as_of(with_key: bool) -> str:
    return f"""SELECT f.loan_id, f.customer_id, f.application_date, f.loan_amount,
 {'v.surrogate_key AS dim_surrogate_key,' if with_key else ''}
 v.employment_status AS dim_employment_status, v.annual_income AS dim_annual_income,
 v.valid_from AS dim_valid_from, v.valid_to AS dim_valid_to
 FROM valid f LEFT JOIN spans v ON f.customer_id = v.customer_id
  AND f.application_date >= v.valid_from AND f.application_date < v.valid_to"""


_SUMS = ", ".join(f"sum({check}) AS {check}" for check in _FLAGS)
_METRICS = " UNION ALL ".join(
    f"""SELECT total_records, error_records, '{check}' AS "check",
 CAST({check} AS BIGINT) AS error_count,
 CAST({check} AS DOUBLE) / greatest(total_records, 1) * 100 AS error_percentage FROM totals"""
    for check in _FLAGS
)
_TOTALS = f"""totals AS (SELECT count(*) AS total_records,
 count(*) FILTER (quality_issue > 0) AS error_records, {_SUMS} FROM flagged)"""

_SLICED = """SELECT * FROM loans WHERE last_updated > TIMESTAMP '1999-01-01 00:00:00'
 AND last_updated <= TIMESTAMP '1999-07-01 00:00:00'"""

_LAST_RUN = BATCHES[-1].process_date
_ERRORS = f"SELECT {_LOAN_COLUMNS} FROM loans WHERE NOT ({_VALID_WHEN})"
_TWO_STEPS = _versions(
    DIM_CUSTOMER,
    f"CASE WHEN CAST(last_updated AS DATE) < DATE '{BATCHES[1].start}' THEN 1 ELSE 2 END",
    f"DATE '{_LAST_RUN}'",
)

ORACLES: dict[str, str] = {
    "validate_valid": _text(_LOANS, body=f"SELECT * FROM loans WHERE {_VALID_WHEN}"),
    "validate_errors": _text(_LOANS, body=_ERRORS),
    "validate_counts": _text(
        _LOANS,
        body=f"""SELECT count(*) AS total_records, count(*) FILTER ({_VALID_WHEN}) AS valid_records,
 count(*) FILTER (NOT ({_VALID_WHEN})) AS error_records FROM loans""",
    ),
    "quality_flags": _text(
        _LOANS, _FLAGGED, body=f"SELECT loan_id, {', '.join(_FLAGS)}, quality_issue FROM flagged"
    ),
    "quality_errors": _text(
        _LOANS, _FLAGGED, body="SELECT * FROM flagged WHERE quality_issue > 0"
    ),
    "quality_metrics": _text(
        _LOANS, _FLAGGED, _TOTALS,
        body=f'SELECT "check", error_count, error_percentage FROM ({_METRICS})',
    ),
    "monthly_payment": _text(
        _LOANS, body=f"SELECT loan_id, {_PAYMENT} AS monthly_payment FROM loans"
    ),
    "loan_category": _text(_LOANS, body=f"SELECT loan_id, {_CATEGORY} AS loan_category FROM loans"),
    "transform": _text(
        _LOANS, _VALID, body=f"SELECT *, {_PAYMENT} AS monthly_payment FROM valid"
    ),
    "dim_customer_slice": _text(
        _CHANGES, _slice(DIM_CUSTOMER),
        body=f"SELECT {', '.join(DIM_CUSTOMER.columns)} FROM seen",
    ),
    "dim_loan_slice": _text(
        _CHANGES, _slice(DIM_LOAN), body=f"SELECT {', '.join(DIM_LOAN.columns)} FROM seen"
    ),
    "scd2_bootstrap": _text(
        _CHANGES, _versions(DIM_CUSTOMER, "1", f"DATE '{_LAST_RUN}'"),
        body=_type2(DIM_CUSTOMER),
    ),
    "scd2_changes": _text(
        _CHANGES, _TWO_STEPS,
        body=f"""SELECT {', '.join('u.' + c for c in DIM_CUSTOMER.columns)},
 CASE WHEN u.is_new THEN 'new' WHEN {' OR '.join(
     f'u.{c} IS DISTINCT FROM u.was_{c}' for c in DIM_CUSTOMER.tracked)} THEN 'changed'
 ELSE 'same' END AS action,
 d.surrogate_key AS was_surrogate_key, u.was_employment_status
 FROM followed u LEFT JOIN (
  SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS surrogate_key
  FROM followed WHERE batch_no = 1) d ON u.customer_id = d.customer_id
 WHERE u.batch_no = 2""",
    ),
    "scd2_customer": _text(_CHANGES, _CUSTOMER, body=_type2(DIM_CUSTOMER)),
    "scd2_loan": _text(_CHANGES, _LOAN, body=_type2(DIM_LOAN)),
    "scd2_current": _text(_CHANGES, _CUSTOMER, body=_type2(DIM_CUSTOMER, only_current=True)),
    "scd4_current": _text(_CHANGES, _CUSTOMER, body=_type4_current(DIM_CUSTOMER)),
    "scd4_loan_current": _text(_CHANGES, _LOAN, body=_type4_current(DIM_LOAN)),
    "scd4_history": _text(
        _CHANGES, _CUSTOMER,
        body=f"""SELECT {', '.join(DIM_CUSTOMER.columns)}, valid_from AS record_effective_date,
 next_from AS record_end_date FROM spans WHERE next_from IS NOT NULL""",
    ),
    "as_of_join": _text(_LOANS, _VALID, _CHANGES, _CUSTOMER, body=_as_of(with_key=True)),
    "as_of_join_large": _text(_LOANS, _VALID, _CHANGES, _CUSTOMER, body=_as_of(with_key=True)),
    "as_of_join_timeline": _text(_LOANS, _VALID, _CHANGES, _CUSTOMER, body=_as_of(with_key=True)),
    "as_of_join_binned": _text(_LOANS, _VALID, _CHANGES, _CUSTOMER, body=_as_of(with_key=True)),
    "as_of_join_scd4": _text(_LOANS, _VALID, _CHANGES, _CUSTOMER, body=_as_of(with_key=False)),
    "incremental_slice": _text(_LOANS, body=_SLICED),
    "next_watermark": _text(
        _LOANS, body=f'SELECT max(last_updated) AS "lastProcessedDate" FROM ({_SLICED})'
    ),
    "ingest_valid": _text(_LOANS, body=f"SELECT * FROM loans WHERE {_VALID_WHEN}"),
    "ingest_quarantine": _text(
        _LOANS, body=f"SELECT *, DATE '{_LAST_RUN}' AS error_date FROM ({_ERRORS})"
    ),
    "quarantine_reasons": _text(
        _LOANS,
        body=f"""SELECT customer_id, loan_id, application_date, last_updated, concat_ws(',', {', '.join(
            f"CASE WHEN {w} THEN '{n}' END" for n, w in _FLAGS.items())}) AS broken_rules, true AS known_source
 FROM loans WHERE NOT ({_VALID_WHEN})""",
    ),
    "ingest_empty_sides": _text(
        _LOANS,
        body=" UNION ALL ".join(
            f"SELECT '{side}' AS side, '{place}' AS place,"
            f" {'least(count(*), 1)' if place == 'log' else 'count(*)'} AS n_rows,"
            f" CAST(0 AS BIGINT) AS untimed, CAST(1 AS BIGINT) AS times FROM loans WHERE {which}"
            for side, which, places in (
                ("clean", f"({_VALID_WHEN})", ("ingested", "transformed", "log")),
                ("broken", f"NOT ({_VALID_WHEN})", ("quarantined", "log")),
            )
            for place in places
        ),
    ),
    "quality_report": _text(_LOANS, _FLAGGED, _TOTALS, body=_METRICS),
    "run_type2": _text(_CHANGES, _CUSTOMER, body=_type2(DIM_CUSTOMER)),
    "run_type2_loan": _text(_CHANGES, _LOAN, body=_type2(DIM_LOAN)),
    "run_type4": _text(_CHANGES, _CUSTOMER, body=_spans(DIM_CUSTOMER)),
    "run_type4_loan": _text(_CHANGES, _LOAN, body=_spans(DIM_LOAN)),
    "run_type2_after_failure": _text(_CHANGES, _LOAN, body=_type2(DIM_LOAN)),
    "run_type4_after_type2": _text(_CHANGES, _CUSTOMER, body=_spans(DIM_CUSTOMER)),
    "run_two_files_one_day": _text(
        _CHANGES,
        body=f"SELECT {_LOAN_COLUMNS}, {_PAYMENT} AS monthly_payment, loan_category FROM valid_updates",
    ),
    "run_transformed": _text(
        _CHANGES,
        body=f"""SELECT {_LOAN_COLUMNS}, monthly_payment, loan_category, {_RUN_DATE} AS batch FROM (
 SELECT *, {_PAYMENT} AS monthly_payment, {_BATCH_NO} AS batch_no FROM valid_updates)""",
    ),
    "run_audit": _text(
        _CHANGES,
        body=f"""SELECT count(*) AS record_count, CAST(0 AS BIGINT) AS waiting,
 CAST({len(BATCHES)} AS BIGINT) AS marks FROM valid_updates GROUP BY {_BATCH_NO}""",
    ),
    "run_repeated": _text(
        _CHANGES, _CUSTOMER,
        body=_type2(DIM_CUSTOMER).replace(" FROM spans", f", CAST({len(BATCHES)} AS BIGINT) AS commits FROM spans"),
    ),
    "run_first_load": _text(
        _CHANGES, _slice(DIM_CUSTOMER, _BATCH_NO),
        body=f"""SELECT {', '.join(DIM_CUSTOMER.columns)}, DATE '{BATCHES[0].process_date}' AS record_effective_date,
 CAST(0 AS BIGINT) AS archived FROM seen WHERE batch_no = 1""",
    ),
    "scd4_loan_history": _text(
        _CHANGES, _LOAN,
        body=f"""SELECT {', '.join(DIM_LOAN.columns)}, valid_from AS record_effective_date,
 next_from AS record_end_date FROM spans WHERE next_from IS NOT NULL""",
    ),
    "scd2_late_batch": _text(_CHANGES, _CUSTOMER, body=_type2(DIM_CUSTOMER).replace("surrogate_key, ", "")),
    "scd2_loan_late_batch": _text(_CHANGES, _LOAN, body=_type2(DIM_LOAN).replace("surrogate_key, ", "")),
    "scd4_late_batch": _text(_CHANGES, _CUSTOMER, body=_spans(DIM_CUSTOMER)),
    "dim_changes_between": _text(
        _CHANGES, _CUSTOMER,
        body=f"""SELECT CASE WHEN valid_from > DATE '{BATCHES[0].process_date}' THEN 'begun' ELSE 'ended' END AS change, *
 EXCLUDE (valid_from, next_from, valid_to), valid_from AS effective_start_date, valid_to AS effective_end_date,
 next_from IS NULL AS is_current FROM spans
 WHERE valid_from > DATE '{BATCHES[0].process_date}' OR next_from IS NOT NULL""",
    ),
    "stream_type2": _text(
        _CHANGES, _CUSTOMER,
        body=_type2(DIM_CUSTOMER).replace(" FROM spans", f", CAST({len(BATCHES)} AS BIGINT) AS commits FROM spans"),
    ),
    "scd2_widened_type": _text(
        _CHANGES, _LOAN, body=_type2(DIM_LOAN).replace("term_months,", "CAST(term_months AS DOUBLE) AS term_months,")
    ),
    "scd2_new_column": _text(_CHANGES, _WIDENED, body=_type2(DIM_CUSTOMER)),
    "scd4_new_column": _text(_CHANGES, _WIDENED, body=_spans(DIM_CUSTOMER)),
}
