"""Oracle SQL text per contract query (DuckDB dialect)."""

from __future__ import annotations

from datetime import date, timedelta

from claimtide.plans.oracle import (
    REOPENED,
    _q,
    _thursday,
    comparison_sql,
    hierarchy_sql,
    money_sql,
    report_week_sql,
    report_year_sql,
    week_start_sql,
    with_blocks,
    with_wide_money,
)
from claimtide.schemas import CATEGORY_HIERARCHY

_MONEY_STAGED = "CAST(value_of_trailer AS DOUBLE) AS value_of_trailer"


def _select_star_money(cte: str, money: list[str], level: str) -> str:
    excl = ", ".join(money)
    casts = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in money)
    return with_blocks(level) + f"SELECT * EXCLUDE ({excl}), {casts} FROM {cte}"


CLASSIFIED_MONEY = ["value_of_trailer", "value_usd"]
STATE_MONEY = CLASSIFIED_MONEY + ["previous_value_usd"]

SQL = {
    "stage_claims": _select_star_money("stg", ["value_of_trailer"], "stg"),
    "reopened_claims": with_blocks("cls") + REOPENED,
    "currency_convert": with_blocks("cls")
    + "SELECT claim_number, snapshot_date, currency, CAST(value_of_trailer AS DOUBLE) AS value_of_trailer, "
    "CAST(value_usd AS DOUBLE) AS value_usd FROM cls",
    "classified": _select_star_money("cls", CLASSIFIED_MONEY, "cls"),
    "current_claims": _select_star_money("cur", CLASSIFIED_MONEY, "cur"),
    "weekly_state": _select_star_money("weekly", STATE_MONEY + ["week_over_week_value_delta_usd"], "weekly"),
    "monthly_state": _select_star_money("monthly", STATE_MONEY + ["month_over_month_value_delta_usd"], "monthly"),
    "weekly_transitions": with_blocks("weekly")
    + "SELECT claim_snapshot_key, claim_number, snapshot_date, week_start_date, week_end_date, report_year, "
    "report_week, previous_status, status AS current_status, transition_type, previous_wbr_tier1, wbr_tier1, "
    "wbr_tier2, wbr_tier3, country, carrier_name, source, submitted_date, case_date_closed, "
    "CAST(previous_value_usd AS DOUBLE) AS previous_value_usd, CAST(value_usd AS DOUBLE) AS value_usd, "
    "CAST(week_over_week_value_delta_usd AS DOUBLE) AS week_over_week_value_delta_usd "
    "FROM weekly WHERE status_changed",
    "weekly_metrics": _select_star_money("wk_metrics", ["claim_value_usd"], "wk_metrics"),
    "monthly_metrics": _select_star_money("mo_metrics", ["claim_value_usd"], "mo_metrics"),
}


# ---------------------------------------------------------------------------
# calendar, keys, tiers
# ---------------------------------------------------------------------------

_DAYS = "snapshot_date, submitted_date, date_of_loss, dropped_off_date, case_date_closed, last_seen_date"

SQL["report_calendar"] = with_blocks(
    "stg",
    f"""
days AS (
  SELECT DISTINCT day FROM (SELECT unnest([{_DAYS}]) AS day FROM stg) t WHERE day IS NOT NULL
)""",
) + (
    f"SELECT day, {report_year_sql('day')} AS report_year, {report_week_sql('day')} AS report_week, "
    f"{_thursday('day')} AS report_thursday, {week_start_sql('day')} AS week_start_date, "
    f"{week_start_sql('day')} + 6 AS week_end_date FROM days"
)

SQL["surrogate_keys"] = with_blocks("cls") + "SELECT claim_number, snapshot_date, claim_snapshot_key FROM cls"

SQL["tier_counts"] = with_blocks("cls") + (
    "SELECT status, wbr_tier1, wbr_tier2, wbr_tier3, CAST(count(*) AS BIGINT) AS snapshot_count, "
    "CAST(count(DISTINCT claim_number) AS BIGINT) AS claim_count FROM cls "
    "GROUP BY status, wbr_tier1, wbr_tier2, wbr_tier3"
)

# ---------------------------------------------------------------------------
# review layer
# ---------------------------------------------------------------------------

_WK = ("report_year", "report_week", "week_start_date", "week_end_date", "W", "WoW", 8)
_MO = ("metric_year", "metric_month", "month_start_date", "month_end_date", "M", "MoM", 12)


def _period_dim(metrics: str, g) -> str:
    year, period, start, end, prefix = g[:5]
    return (
        f"SELECT DISTINCT {year}, {period}, {start}, {end}, "
        f"printf('%d-{prefix}%02d', {year}, {period}) AS period_label FROM {metrics}"
    )


SQL["period_dimension_weekly"] = with_blocks("wk_metrics") + _period_dim("wk_metrics", _WK)
SQL["period_dimension_monthly"] = with_blocks("mo_metrics") + _period_dim("mo_metrics", _MO)

SQL["hierarchy_weekly_count"] = (
    with_blocks("wk_metrics", hierarchy_sql("hier", "wk_metrics", "week_start_date", "claim_count"))
    + "SELECT * FROM hier"
)
SQL["hierarchy_monthly_value"] = (
    with_blocks("mo_metrics", hierarchy_sql("hier", "mo_metrics", "month_start_date", "claim_value_usd"))
    + "SELECT * EXCLUDE (metric_value), CAST(metric_value AS DOUBLE) AS metric_value FROM hier"
)


def _review_rows(level: str, metrics: str, g, measure: str, where: str, chosen: str) -> str:
    """CTEs up to ``cells``: the values of the waterfall rows in the chosen
    periods and the comparison of the last one with the one before it.  Rows
    seen only in the comparison period have no value of their own."""
    _year, _period, start, _end, _prefix, _label, _count = g
    text = comparison_sql("cur", "prv", measure == "claim_value_usd")
    return with_blocks(
        level,
        f"fm AS (SELECT * FROM {metrics} WHERE {where})",
        hierarchy_sql("h", "fm", start, measure),
        f"per AS (SELECT *, row_number() OVER (ORDER BY {start} DESC) AS rn FROM ({_period_dim('fm', g)}))",
        f"sel AS (SELECT {start} AS day, period_label FROM per WHERE {chosen})",
        f"""ends AS (
  SELECT last, (SELECT max({start}) FROM per WHERE {start} < last) AS before FROM (SELECT max(day) AS last FROM sel)
)""",
        f"""cells AS (
  SELECT row_key, category, sort_key, {start} AS day, metric_value,
    coalesce(sum(metric_value) FILTER ({start} = last) OVER (PARTITION BY row_key), 0) AS cur,
    coalesce(sum(metric_value) FILTER ({start} = before) OVER (PARTITION BY row_key), 0) AS prv, before
  FROM h, ends WHERE {start} = before OR {start} IN (SELECT day FROM sel)
)""",
        f"told AS (SELECT *, if(before IS NULL, 'N/A', {text}) AS comparison FROM cells)",
    )


def _review_wide(level: str, metrics: str, g, measure: str, where: str, first: str, last: str) -> str:
    """The pivot over a range of weeks: one conditional sum for each."""
    start, label = g[2], g[5]
    kind = "DOUBLE" if measure == "claim_value_usd" else "BIGINT"
    day, weeks = date.fromisoformat(first), []
    day += timedelta(days=(6 - day.weekday()) % 7)  # the first Sunday
    while day <= date.fromisoformat(last):
        year, week, _ = (day + timedelta(days=4)).isocalendar()
        weeks.append((day, f"{year}-W{week:02d}"))
        day += timedelta(days=7)
    sums = ", ".join(
        f"CAST(coalesce(sum(metric_value) FILTER (day = DATE '{d}'), 0) AS {kind}) AS \"{name}\"" for d, name in weeks
    )
    return _review_rows(level, metrics, g, measure, where, f"{start} BETWEEN DATE '{first}' AND DATE '{last}'") + (
        f'SELECT category AS "WBR waterfall", {sums}, comparison AS {label} FROM told '
        "GROUP BY row_key, category, sort_key, comparison"
    )


def _review_long(level: str, metrics: str, g, measure: str, where: str = "true") -> str:
    """The default range (last periods) as rows of period and value."""
    return _review_rows(level, metrics, g, measure, where, f"rn <= {g[6]}") + (
        "SELECT nodes.category AS waterfall, sel.period_label, "
        "CAST(coalesce(told.metric_value, 0) AS DOUBLE) AS value, nodes.comparison FROM "
        "(SELECT DISTINCT row_key, category, comparison FROM told) nodes CROSS JOIN sel "
        "LEFT JOIN told ON told.row_key = nodes.row_key AND told.day = sel.day"
    )


SQL["review_weekly_count_long"] = _review_long("wk_metrics", "wk_metrics", _WK, "claim_count")
SQL["review_monthly_value_long"] = _review_long("mo_metrics", "mo_metrics", _MO, "claim_value_usd", "country = 'US'")
SQL["review_monthly_count_long"] = _review_long("mo_metrics", "mo_metrics", _MO, "claim_count")
SQL["review_weekly_range"] = _review_wide(
    "wk_metrics", "wk_metrics", _WK, "claim_value_usd",
    "source IN ('Provider F', 'Provider O') AND carrier_name IN ('Carrier 1', 'Carrier 2')",
    "1996-01-01", "1996-03-31",
)
SQL["review_one_week"] = _review_wide("wk_metrics", "wk_metrics", _WK, "claim_count", "true", "1996-03-31", "1996-04-06")

SQL["review_comparison_text"] = with_blocks(
    "wk_metrics",
    hierarchy_sql("h", "wk_metrics", "week_start_date", "claim_value_usd").strip("\n"),
    """per AS (
  SELECT week_start_date, lag(week_start_date) OVER (ORDER BY week_start_date) AS prev_start
  FROM (SELECT DISTINCT week_start_date FROM wk_metrics) d
)""",
    """pairs AS (
  SELECT per.week_start_date, k.row_key FROM per
  JOIN (SELECT DISTINCT week_start_date, row_key FROM h) k
    ON k.week_start_date = per.week_start_date OR k.week_start_date = per.prev_start
  WHERE per.prev_start IS NOT NULL
  GROUP BY per.week_start_date, k.row_key
)""",
    """vals AS (
  SELECT pairs.week_start_date, pairs.row_key,
    coalesce((SELECT sum(metric_value) FROM h WHERE h.week_start_date = pairs.week_start_date
              AND h.row_key = pairs.row_key), 0) AS cur,
    coalesce((SELECT sum(metric_value) FROM h JOIN per ON per.week_start_date = pairs.week_start_date
              WHERE h.week_start_date = per.prev_start AND h.row_key = pairs.row_key), 0) AS prv
  FROM pairs
)""",
) + (
    "SELECT week_start_date, row_key, CAST(cur AS DOUBLE) AS current_value, CAST(prv AS DOUBLE) AS previous_value, "
    f"{comparison_sql('cur', 'prv', True)} AS comparison FROM vals"
)

_KPI_CARDS = [
    ("Active claims", "ACTIVE CASES"),
    ("Closed claims", "CLOSED CASES"),
    ("Re-opened claims", "RE-OPEN CLAIMS"),
]
SQL["kpi_cards"] = with_blocks(
    "wk_metrics",
    """wk AS (
  SELECT report_year, report_week, row_number() OVER (ORDER BY week_start_date DESC) AS rn
  FROM (SELECT DISTINCT report_year, report_week, week_start_date FROM wk_metrics) d
)""",
    """tagged AS (
  SELECT m.*, wk.rn FROM wk_metrics m JOIN wk USING (report_year, report_week) WHERE wk.rn <= 2
)""",
    "np AS (SELECT count(*) AS n FROM wk)",
    """counts AS (
  SELECT t.tier,
    coalesce(sum(CASE WHEN rn = 1 AND wbr_tier1 = t.tier THEN claim_count END), 0) AS cur,
    coalesce(sum(CASE WHEN rn = 2 AND wbr_tier1 = t.tier THEN claim_count END), 0) AS prv
  FROM (VALUES """
    + ", ".join(f"({i}, {repr(t)})" for i, (_card, t) in enumerate(_KPI_CARDS))
    + """) t(i, tier) LEFT JOIN tagged ON TRUE
  GROUP BY t.tier
)""",
    """val AS (
  SELECT coalesce(CAST(sum(CASE WHEN rn = 1 THEN claim_value_usd END) AS DOUBLE), 0.0) AS cur,
         coalesce(CAST(sum(CASE WHEN rn = 2 THEN claim_value_usd END) AS DOUBLE), 0.0) AS prv
  FROM tagged
)""",
) + (
    "SELECT c.card, CAST(k.cur AS DOUBLE) AS value, "
    "CASE WHEN np.n > 1 THEN CAST(k.cur - k.prv AS DOUBLE) END AS delta, "
    "CAST(CAST(k.cur AS BIGINT) AS VARCHAR) AS value_text, "
    "CASE WHEN np.n > 1 THEN CAST(CAST(k.cur - k.prv AS BIGINT) AS VARCHAR) END AS delta_text "
    "FROM counts k JOIN (VALUES "
    + ", ".join(f"({repr(lbl)}, {repr(t)})" for lbl, t in _KPI_CARDS)
    + ") c(card, tier) ON c.tier = k.tier CROSS JOIN np WHERE np.n > 0 "
    f"UNION ALL SELECT 'Claim value', val.cur, CASE WHEN np.n > 1 THEN val.cur - val.prv END, "
    f"{money_sql('val.cur')}, CASE WHEN np.n > 1 THEN {money_sql('val.cur - val.prv')} END "
    "FROM val CROSS JOIN np WHERE np.n > 0"
)

SQL["default_range"] = with_blocks("all") + (
    "SELECT 'weekly' AS grain, period_label, week_start_date AS period_start FROM ("
    + _period_dim("wk_metrics", _WK)
    + ") w QUALIFY row_number() OVER (ORDER BY week_start_date DESC) <= 8 "
    "UNION ALL SELECT 'monthly', period_label, month_start_date FROM ("
    + _period_dim("mo_metrics", _MO)
    + ") m QUALIFY row_number() OVER (ORDER BY month_start_date DESC) <= 12"
)

# ---------------------------------------------------------------------------
# extracts
# ---------------------------------------------------------------------------

# staged and classified columns with their display names
_HEADERS = {
    "claim_number": "Claim Number",
    "carrier_name": "Carrier Name",
    "country": "Country",
    "status": "Status",
    "reason": "Reason",
    "results": "Results",
    "insurance_claims_results": "Insurance Claims Results",
    "source": "Source",
    "trailer_license_plate": "Trailer License Plate",
    "trailer_number": "Trailer Number",
    "trailer_vin": "Trailer VIN",
    "currency": "Currency",
    "submitted_date": "Submitted Date",
    "date_of_loss": "Date Of Loss",
    "dropped_off_date": "Dropped Off Date",
    "case_date_closed": "Case Date Closed",
    "last_seen_date": "Last Seen Date",
    "CAST(value_of_trailer AS DOUBLE)": "Value Of Trailer",
    "report_year": "Report Year",
    "report_week": "Report Week",
    "submitted_year": "Submitted Year",
    "submitted_week": "Submitted Week",
    "closed_year": "Closed Year",
    "closed_week": "Closed Week",
    "wbr_tier1": "WBR Tier 1",
    "wbr_tier2": "WBR Tier 2",
    "wbr_tier3": "WBR Tier 3",
    "CAST(value_usd AS DOUBLE)": "Value USD",
}
_TRANSITION_HEADERS = {
    "claim_number": "Claim Number",
    "week_start_date": "Week Start Date",
    "week_end_date": "Week End Date",
    "report_year": "Report Year",
    "report_week": "Report Week",
    "previous_status": "Previous Status",
    "status": "Current Status",
    "transition_type": "Transition Type",
    "previous_wbr_tier1": "Previous WBR Tier 1",
    "wbr_tier1": "WBR Tier 1",
    "wbr_tier2": "WBR Tier 2",
    "wbr_tier3": "WBR Tier 3",
    "country": "Country",
    "carrier_name": "Carrier Name",
    "source": "Source",
    "submitted_date": "Submitted Date",
    "case_date_closed": "Case Date Closed",
    "CAST(previous_value_usd AS DOUBLE)": "Previous Value USD",
    "CAST(value_usd AS DOUBLE)": "Value USD",
    "CAST(week_over_week_value_delta_usd AS DOUBLE)": "Week Over Week Value Delta USD",
}


def _headed(columns: dict[str, str]) -> str:
    return ", ".join(f'{expr} AS "{name}"' for expr, name in columns.items())


SQL["title_case_headers"] = with_blocks("cur") + f"SELECT {_headed(_HEADERS)} FROM cur"
# text that a CSV file must quote: quotes, a line break, edge spaces, blanks
_NOTE = """CASE length(claim_number) % 4 WHEN 0 THEN ' ' || status || ', "' || country || '" '
  WHEN 1 THEN 'a' || chr(10) || coalesce(reason, '"') WHEN 2 THEN '' END"""
SQL["csv_round_trip"] = with_blocks("cur") + f"SELECT {_headed(_HEADERS)}, {_NOTE} AS \"Note\" FROM cur"
SQL["filter_current"] = with_blocks("cur") + (
    f"SELECT {_headed(_HEADERS)} FROM cur WHERE country IN ('US') AND status IN ('Open', 'Closed') "
    "AND carrier_name IN ('Carrier 0', 'Carrier 1') AND regexp_matches(claim_number, '(?i)clm-\\d*7')"
)
SQL["filter_transitions"] = with_blocks("weekly") + (
    f"SELECT {_headed(_TRANSITION_HEADERS)} FROM weekly "
    "WHERE status_changed AND country IN ('CA') AND transition_type IN ('CLOSED_TO_OPEN', 'OPEN_TO_CLOSED') "
    "AND regexp_matches(claim_number, '(?i)clm')"
)
SQL["filter_options"] = with_blocks(
    "weekly",
    "cur AS (SELECT * FROM cls SEMI JOIN (SELECT claim_number, max(snapshot_date) AS snapshot_date FROM cls GROUP BY ALL) m "
    "USING (claim_number, snapshot_date))",
) + (
    "SELECT DISTINCT dimension, value, 'current' AS table_name FROM (SELECT unnest(["
    "{'dimension': 'country', 'value': country}, {'dimension': 'status', 'value': status}, "
    "{'dimension': 'source', 'value': source}, {'dimension': 'carrier_name', 'value': carrier_name}], "
    "recursive := true) FROM cur) t WHERE value IS NOT NULL "
    "UNION ALL SELECT DISTINCT dimension, value, 'weekly_transitions' FROM (SELECT unnest(["
    "{'dimension': 'country', 'value': country}, {'dimension': 'current_status', 'value': status}, "
    "{'dimension': 'source', 'value': source}, {'dimension': 'carrier_name', 'value': carrier_name}, "
    "{'dimension': 'transition_type', 'value': transition_type}], recursive := true) "
    "FROM weekly WHERE status_changed) t WHERE value IS NOT NULL"
)
SQL["month_pruned_read"] = with_blocks("weekly") + (
    "SELECT * EXCLUDE (value_of_trailer, value_usd, previous_value_usd, week_over_week_value_delta_usd), "
    "CAST(value_of_trailer AS DOUBLE) AS value_of_trailer, CAST(value_usd AS DOUBLE) AS value_usd, "
    "CAST(previous_value_usd AS DOUBLE) AS previous_value_usd, "
    "CAST(week_over_week_value_delta_usd AS DOUBLE) AS week_over_week_value_delta_usd "
    "FROM weekly WHERE week_end_date BETWEEN DATE '1996-03-15' AND DATE '1997-06-30'"
)

SQL["history_scan"] = SQL["stage_claims"]
SQL["currency_convert_csv"] = SQL["currency_convert"]
SQL["mart_by_name"] = SQL["current_claims"]
SQL["bucketed_weekly_state"] = SQL["weekly_state"]
SQL["bucketed_monthly_state"] = SQL["monthly_state"]
SQL["search_current"] = with_blocks("cur") + (
    "SELECT claim_number, snapshot_date, status, CAST(value_usd AS DOUBLE) AS value_usd FROM cur "
    "WHERE regexp_matches(claim_number, 'clm-1[0-5]+-', 'i')"
)
SQL["ordered_export"] = with_blocks("weekly") + (
    "SELECT claim_number AS \"Claim Number\", week_end_date AS \"Week End Date\", status AS \"Current Status\", "
    "transition_type AS \"Transition Type\", (SELECT count(*) FROM weekly WHERE status_changed) AS \"Rows\", true AS \"In Order\" "
    "FROM weekly WHERE status_changed"
)

# ---------------------------------------------------------------------------
# data quality
# ---------------------------------------------------------------------------

_DQ_CTE = {
    "source": "raw",
    "classified": "cls",
    "current": "cur",
    "weekly": "weekly",
    "weekly_transitions": "trn",
    "weekly_metrics": "wk_metrics",
    "monthly": "monthly",
    "monthly_metrics": "mo_metrics",
    "currency": "rates",
}
_TRN = "trn AS (SELECT * EXCLUDE (status), status AS current_status FROM weekly WHERE status_changed)"
_STATUSES = "'Open', 'Closed'"
_MOVES = "'NEW_CLAIM', 'NO_CHANGE', 'OPEN_TO_CLOSED', 'CLOSED_TO_OPEN', 'STATUS_CHANGED'"
_KEY = "source+carrier_name+country+status+wbr_tier1+wbr_tier2+wbr_tier3"

# kind: checks as table:columns, with what they ask for
_NOT_NULL = """source:snapshot_date source:claim_number source:submitted source:source
classified:claim_snapshot_key classified:snapshot_date classified:wbr_tier1 classified:wbr_tier2
current:claim_number current:snapshot_date weekly:claim_number weekly:report_week weekly:transition_type
weekly_transitions:claim_number monthly:claim_number"""
_UNIQUE = "classified:claim_snapshot_key current:claim_number currency:currency_code"
_ACCEPTED = {
    "source:status": _STATUSES,
    "classified:wbr_tier1": "'ACTIVE CASES', 'CLOSED CASES', 'RE-OPEN CLAIMS'",
    "weekly:transition_type": _MOVES,
    "weekly_transitions:transition_type": "'OPEN_TO_CLOSED', 'CLOSED_TO_OPEN', 'STATUS_CHANGED'",
    "monthly:transition_type": _MOVES,
}
_COMBINATIONS = f"""source:snapshot_date+claim_number current:claim_number weekly:claim_number+report_year+report_week
weekly_metrics:report_year+report_week+{_KEY} monthly:claim_number+metric_year+metric_month
monthly_metrics:metric_year+metric_month+{_KEY}"""
_RANGES = {
    "classified:report_week": "NOT BETWEEN 1 AND 53",
    "classified:submitted_week": "NOT BETWEEN 1 AND 53",
    "classified:value_usd": "< 0",
    "weekly:report_week": "NOT BETWEEN 1 AND 53",
    "weekly_metrics:claim_count": "< 0",
    "monthly:metric_month": "NOT BETWEEN 1 AND 12",
    "monthly_metrics:claim_count": "< 0",
}


def _repeated(table: str, columns: str, where: str = "true") -> str:
    names = columns.replace("+", ", ")
    return f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {where} GROUP BY {names} HAVING count(*) > 1)"


def _checks(kind: str) -> list[tuple[str, str, str]]:
    """(check, table, count of failures) of a kind."""
    if kind == "singular":
        text = "value_of_trailer"
        return [
            ("assert_all_claims_classified", "classified", "SELECT count(*) FROM cls WHERE wbr_tier2 IS NULL"),
            ("assert_no_duplicate_claims_per_week", "weekly", _repeated("weekly", "claim_number+report_year+report_week")),
            (
                "assert_no_value_cut",
                "source",
                f"SELECT count(*) FROM raw WHERE isfinite(try_cast({text} AS DOUBLE)) AND try_cast({text} AS DECIMAL(38,9)) IS NULL",
            ),
        ]
    names = {"not_null": _NOT_NULL, "unique": _UNIQUE, "unique_combination": _COMBINATIONS}
    listed = names[kind].split() if kind in names else [*(_ACCEPTED if kind == "accepted_values" else _RANGES)]
    out = []
    for entry in listed:
        table, columns = entry.split(":")
        cte = _DQ_CTE[table]
        count = {
            "not_null": lambda: f"SELECT count(*) FROM {cte} WHERE {columns} IS NULL",
            "unique": lambda: _repeated(cte, columns, f"{columns} IS NOT NULL"),
            "unique_combination": lambda: _repeated(cte, columns),
            "accepted_values": lambda: f"SELECT count(DISTINCT {columns}) FROM {cte} WHERE {columns} NOT IN ({_ACCEPTED[entry]})",
            "between": lambda: f"SELECT count(*) FROM {cte} WHERE {columns} {_RANGES[entry]}",
        }[kind]()
        out.append((f"{kind}:{entry}", table, count))
    return out


def _dq_sql(kind: str) -> str:
    parts = [
        f"SELECT {_q(name)} AS check_name, {_q(table)} AS table_name, {_q(kind)} AS kind, "
        f"CAST(({count}) AS BIGINT) AS failing_rows"
        for name, table, count in _checks(kind)
    ]
    return with_blocks("all", _TRN) + " UNION ALL ".join(parts)


SQL["dq_not_null"] = _dq_sql("not_null")
SQL["dq_unique"] = _dq_sql("unique")
SQL["dq_accepted"] = _dq_sql("accepted_values")
SQL["dq_unique_combo"] = _dq_sql("unique_combination")
SQL["dq_between"] = _dq_sql("between")
SQL["dq_singular"] = _dq_sql("singular")

_BUILT = ("current", "weekly", "weekly_transitions", "weekly_metrics", "monthly", "monthly_metrics", "classified")
SQL["dq_after_build"] = with_blocks("all", _TRN) + " UNION ALL ".join(
    f"SELECT {_q(name)} AS check_name, {_q(table)} AS table_name, {_q(kind)} AS kind, CAST(({count}) AS BIGINT) AS failing_rows"
    for kind in ("not_null", "unique", "accepted_values", "unique_combination", "between", "singular")
    for name, table, count in _checks(kind)
    if table in _BUILT
)


# ---------------------------------------------------------------------------
# money of more than 19 whole digits: everything in whole billionths
# ---------------------------------------------------------------------------

SQL["wide_money_metrics"] = with_wide_money() + (
    "SELECT report_year, report_week, source, carrier_name, country, status, wbr_tier1, wbr_tier2, wbr_tier3, claim_count, "
    "CAST(claim_value_usd AS VARCHAR) AS claim_value_cents FROM wk_metrics"
)
SQL["wide_money_deltas"] = with_wide_money() + (
    "SELECT claim_number, week_start_date, CAST(sign(value_usd)::HUGEINT * (abs(value_usd) // 1000000000) AS VARCHAR) AS value_whole, "
    "CAST(sign(value_usd)::HUGEINT * (abs(value_usd) % 1000000000) AS BIGINT) AS value_billionths, "
    "CAST(week_over_week_value_delta_usd AS VARCHAR) AS delta_cents FROM weekly"
)


# ---------------------------------------------------------------------------
# seeds, views, names, orders, coercions
# ---------------------------------------------------------------------------

_SEED_LINES = ", ".join(
    f"({i}, {_q(label)}, {indent}, {_q(tier1)}, {'NULL' if match is None else _q(match)})"
    for i, label, indent, tier1, match in CATEGORY_HIERARCHY
)
SQL["category_counts"] = with_blocks("cur") + (
    "SELECT sort_order, display_label, CAST(indent_level AS INTEGER) AS indent_level, count(wbr_tier1) AS claims "
    f"FROM (VALUES {_SEED_LINES}) seed(sort_order, display_label, indent_level, tier1_filter, tier_match_value) "
    "LEFT JOIN cur ON wbr_tier1 = tier1_filter AND (tier_match_value IS NULL OR tier_match_value = "
    "CASE indent_level WHEN 1 THEN wbr_tier2 ELSE wbr_tier3 END) GROUP BY ALL"
)
SQL["views_by_sql"] = with_blocks("weekly") + (
    "SELECT report_year, report_week, count(*) AS claims, count(*) AS rows FROM weekly GROUP BY ALL"
)


def _rows_by_name(of: str) -> str:
    """Rows of each table of a build over the raw rows that ``of`` allows."""
    week, month = f"{week_start_sql('snapshot_date')}", "date_trunc('month', snapshot_date)"
    rows = f"(SELECT * FROM cls WHERE {of})"
    latest = lambda period: f"(SELECT DISTINCT ON (claim_number, {period}) *, {period} AS p FROM {rows} ORDER BY claim_number, {period}, snapshot_date DESC)"
    moved = f"(SELECT status, lag(status) OVER (PARTITION BY claim_number ORDER BY p) AS before FROM {latest(week)})"
    group = "p, source, carrier_name, country, status, wbr_tier1, wbr_tier2, wbr_tier3"
    counts = {
        ("staging", "stg_insurance_claims"): f"SELECT count(*) FROM {rows}",
        ("intermediate", "int_claims_classified"): f"SELECT count(*) FROM {rows}",
        ("intermediate", "int_claims_period_latest"): f"SELECT count(*) FROM (SELECT DISTINCT claim_number, {week}, {month} FROM {rows})",
        ("marts", "mart_claims_current"): f"SELECT count(DISTINCT claim_number) FROM {rows}",
        ("marts", "mart_claims_weekly"): f"SELECT count(*) FROM (SELECT DISTINCT claim_number, {week} FROM {rows})",
        ("marts", "mart_claims_monthly"): f"SELECT count(*) FROM (SELECT DISTINCT claim_number, {month} FROM {rows})",
        ("marts", "mart_claim_transitions_weekly"): f"SELECT count(*) FROM {moved} WHERE status <> before",
        ("marts", "mart_claims_weekly_metrics"): f"SELECT count(*) FROM (SELECT DISTINCT {group} FROM {latest(week)})",
        ("marts", "mart_claims_monthly_metrics"): f"SELECT count(*) FROM (SELECT DISTINCT {group} FROM {latest(month)})",
        ("seeds", "seed_currency_rates"): "SELECT count(*) FROM rates",
        ("seeds", "seed_category_hierarchy"): f"SELECT {len(CATEGORY_HIERARCHY)}",
    }
    return " UNION ALL ".join(f"SELECT {_q(layer)} AS layer, {_q(name)} AS name, ({sql}) AS rows" for (layer, name), sql in counts.items())


# the first refresh has whole claims, so their classes are the same
SQL["refreshed_names"] = with_blocks("cls") + (
    f"SELECT layer, name, a.rows, b.rows AS rows_before FROM ({_rows_by_name('true')}) a JOIN ({_rows_by_name("claim_number LIKE '%1'")}) b USING (layer, name)"
)
SQL["periods_in_order"] = with_blocks("wk_metrics") + (
    "SELECT row_number() OVER (ORDER BY week_start_date) - 1 AS place, week_start_date, period_label "
    f"FROM ({_period_dim('wk_metrics', _WK)})"
)
_AS_NUMBER = "if(claim_count % 3 = 0, 0, claim_count)"
SQL["text_sums"] = with_blocks("wk_metrics") + (
    f"SELECT status, CAST(sum({_AS_NUMBER}) AS DOUBLE) AS claims, 0.0::DOUBLE AS nothing, "
    + ", ".join(
        f"CAST(coalesce(sum({_AS_NUMBER}) FILTER (wbr_tier1 = {_q(tier)}), 0) AS DOUBLE) AS tier_{k}"
        for k, tier in enumerate(("ACTIVE CASES", "CLOSED CASES", "RE-OPEN CLAIMS"))
    )
    + " FROM wk_metrics GROUP BY status"
)
