"""The same queries as DuckDB SQL, written on their own from the meaning of each query."""

from __future__ import annotations

from workload.tx import duckdb_source


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def rnd(value: str, digits: int = 2) -> str:
    """Half-up rounding of the decimal digits a double shows, which is how Spark rounds."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,14)), {digits}) AS DOUBLE)"


def pct(part: str, total: str) -> str:
    return rnd(f"(CAST({part} AS DOUBLE) / nullif({total}, 0) * 100)")


def n_where(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def exact_sum(value: str, where: str = "TRUE") -> str:
    """A sum of doubles without an order: halves of the whole part and of the fraction in units of 2^-52, as integers."""
    whole, fraction = f"CAST(floor({value}) AS BIGINT)", f"CAST(floor(({value} - floor({value})) * 4503599627370496) AS BIGINT)"
    part = lambda x: f"CAST(sum({x}) FILTER (WHERE {where}) AS DOUBLE)"
    return f"""(({part(f'({whole}) >> 26')} * 67108864 + {part(f'({whole}) & 67108863')})
  + ({part(f'({fraction}) >> 26')} / 67108864 + {part(f'({fraction}) & 67108863')} / 4503599627370496))"""


def exact_avg(value: str, where: str = "TRUE") -> str:
    return f"({exact_sum(value, where)} / nullif(count({value}) FILTER (WHERE {where}), 0))"


# Fixed values, written out here again so that a slip in the plan shows.
RISK_CLASSES = ("low_risk", "moderate_risk", "high_risk")
REGIONS = _list(("Africa", "Asia", "Europe", "North America", "South America"))
TYPES = _list(("purchase", "sale", "transfer", "phishing", "scam"))
CLASSES = _list(RISK_CLASSES)

SOURCE = f"source AS MATERIALIZED (\n  {duckdb_source()}\n)"
BRONZE = """bronze AS MATERIALIZED (
  SELECT * REPLACE (make_timestamp(CAST("timestamp" AS BIGINT) * 1000000) AS "timestamp") FROM source
)"""
MARKED = f"""marked AS MATERIALIZED (
  SELECT *, coalesce(
    "timestamp" IS NOT NULL AND sending_address IS NOT NULL AND receiving_address IS NOT NULL
    AND amount > 0 AND location_region IN {REGIONS} AND transaction_type IN {TYPES} AND anomaly IN {CLASSES}
    AND risk_score >= 0 AND risk_score <= 100, FALSE) AS ok
  FROM bronze
)"""
SILVER = """silver AS MATERIALIZED (
  SELECT * EXCLUDE (ok) REPLACE (CAST(amount AS DOUBLE) AS amount),
    "timestamp" AS transaction_datetime, CAST("timestamp" AS DATE) AS transaction_date,
    transaction_type IN ('phishing', 'scam') AS is_fraudulent, risk_score >= 75 AS is_high_risk,
    CASE WHEN amount < 1000 THEN 'micro' WHEN amount < 10000 THEN 'small'
         WHEN amount < 50000 THEN 'medium' ELSE 'large' END AS amount_tier
  FROM marked WHERE ok
)"""
REASON = f"""CASE
    WHEN amount IS NULL OR amount <= 0 THEN 'invalid_amount'
    WHEN location_region NOT IN {REGIONS} THEN 'invalid_region'
    WHEN anomaly NOT IN {CLASSES} THEN 'invalid_anomaly'
    WHEN transaction_type NOT IN {TYPES} THEN 'invalid_transaction_type'
    WHEN risk_score IS NULL OR risk_score < 0 OR risk_score > 100 THEN 'invalid_risk_score'
    ELSE 'other' END"""
REJECTED = f"""rejected AS MATERIALIZED (
  SELECT * EXCLUDE (ok), {REASON} AS _rejection_reason FROM marked WHERE NOT ok
)"""
LAYERS = ",\n".join((SOURCE, BRONZE, MARKED, SILVER, REJECTED))


def q(body: str, *more: str) -> str:
    """A query over the layers; ``more`` are further common table expressions."""
    return "WITH " + ",\n".join((LAYERS, *more)) + "\n" + body


RISK = f"{rnd('avg(risk_score)')} AS avg_risk_score"
RISK3 = f"{RISK}, {rnd('min(risk_score)')} AS min_risk_score, {rnd('max(risk_score)')} AS max_risk_score"
TOTAL = f"{rnd('sum(amount)')} AS total_amount"
AVG_AMOUNT = f"{rnd('avg(amount)')} AS avg_amount"
FRAUD = f"{n_where('is_fraudulent')} AS fraudulent_count"

GOLD = {
    "region_risk_ranking": f"""SELECT location_region, count(*) AS transaction_count, {RISK3}
FROM silver GROUP BY location_region""",
    "fraud_by_region": f"""SELECT location_region, anomaly, count(*) AS transaction_count, {TOTAL}, {AVG_AMOUNT}, {RISK},
  max(amount) AS max_amount, {FRAUD}
FROM silver GROUP BY location_region, anomaly""",
    "fraud_by_type": f"""SELECT transaction_type, anomaly, purchase_pattern, count(*) AS transaction_count, {TOTAL},
  {AVG_AMOUNT}, {RISK}, {rnd('avg(session_duration)', 1)} AS avg_session_duration
FROM silver GROUP BY transaction_type, anomaly, purchase_pattern""",
    "daily_fraud_metrics": f"""SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, location_region,
  count(*) AS total_transactions, {n_where("anomaly = 'high_risk'")} AS high_risk_count,
  {n_where("anomaly = 'moderate_risk'")} AS moderate_risk_count, {n_where("anomaly = 'low_risk'")} AS low_risk_count,
  {FRAUD}, {TOTAL}, {RISK}
FROM silver GROUP BY transaction_date, location_region""",
    "risk_profile": f"""SELECT age_group, purchase_pattern, anomaly, count(*) AS transaction_count, {RISK3}, {AVG_AMOUNT},
  {rnd('avg(login_frequency)')} AS avg_login_frequency, {rnd('avg(session_duration)')} AS avg_session_duration
FROM silver GROUP BY age_group, purchase_pattern, anomaly""",
    "high_risk_transactions": """SELECT CAST(transaction_datetime AS VARCHAR) AS transaction_datetime,
  CAST(transaction_date AS VARCHAR) AS transaction_date, sending_address, receiving_address, amount, amount_tier,
  transaction_type, location_region, ip_prefix, risk_score, anomaly, age_group, purchase_pattern, login_frequency,
  session_duration, is_fraudulent
FROM silver WHERE anomaly = 'high_risk' OR risk_score >= 75""",
    "top_sale_receivers": f"""SELECT receiving_address, {rnd('amount')} AS amount, CAST("timestamp" AS VARCHAR) AS "timestamp"
FROM (SELECT *, row_number() OVER (PARTITION BY receiving_address ORDER BY "timestamp" DESC, amount DESC) AS rn
      FROM silver WHERE transaction_type = 'sale')
WHERE rn = 1 ORDER BY 2 DESC, receiving_address LIMIT 3""",
}
GOLD_CTES = [f"{name} AS MATERIALIZED ({body})" for name, body in GOLD.items()]

NULL_COLUMNS = (
    "timestamp", "sending_address", "receiving_address", "amount", "transaction_type", "location_region", "anomaly",
    "risk_score", "login_frequency", "session_duration", "purchase_pattern", "age_group", "ip_prefix",
)
TYPE_TEXT = "transaction_type must be one of: purchase, sale, transfer, phishing, scam"
REGION_TEXT = "location_region must be one of: Africa, Asia, Europe, North America, South America"
CLASS_TEXT = "anomaly must be one of: low_risk, moderate_risk, high_risk"
RISK_TEXT = "risk_score must be between 0 and 100"
KEY_TEXT = "(sending_address, receiving_address, timestamp)"
VIOLATIONS = {
    "amount_positive": "amount <= 0",
    "transaction_type_valid": f"transaction_type NOT IN {TYPES}",
    "location_region_valid": f"location_region NOT IN {REGIONS}",
    "anomaly_valid": f"anomaly NOT IN {CLASSES}",
    "risk_score_range": "risk_score < 0 OR risk_score > 100",
}


def _duplicates(table: str) -> str:
    return f"""(SELECT count(*) FROM {table}) - (SELECT count(*) FROM
      (SELECT DISTINCT sending_address, receiving_address, "timestamp" FROM {table}))"""


def _check(table: str, kind: str, name: str, text: str, errors: str) -> str:
    return f"""SELECT '{kind}' AS check_type, '{name}' AS check_name, '{text}' AS description,
  CAST({errors} AS BIGINT) AS error_count, count(*) AS total_records FROM {table}"""


def _raw_checks(table: str) -> str:
    parts = [
        _check(table, "completeness", c, f"{c} IS NULL", n_where(f'"{c}" IS NULL')) for c in NULL_COLUMNS
    ]
    texts = {
        "amount_positive": "amount must be > 0", "transaction_type_valid": TYPE_TEXT,
        "location_region_valid": REGION_TEXT, "anomaly_valid": CLASS_TEXT, "risk_score_range": RISK_TEXT,
    }
    parts += [_check(table, "validity", n, texts[n], n_where(c)) for n, c in VIOLATIONS.items()]
    parts.append(
        _check(table, "validity", "no_duplicates", f"no duplicate {KEY_TEXT} rows", _duplicates(table))
    )
    return " UNION ALL ".join(parts)


def _clean_checks(table: str) -> str:
    parts = [
        _check(table, "completeness", c, f"NULL check on {c}", n_where(f'"{c}" IS NULL')) for c in NULL_COLUMNS[:8]
    ]
    texts = {
        "transaction_type_valid": TYPE_TEXT, "location_region_valid": REGION_TEXT, "anomaly_valid": CLASS_TEXT,
        "risk_score_range": RISK_TEXT, "amount_positive": "amount must be greater than 0",
    }
    parts += [_check(table, "validity", n, texts[n], n_where(VIOLATIONS[n])) for n in texts]
    parts.append(
        _check(table, "validity", "duplicate_records", f"No duplicate {KEY_TEXT} combinations", _duplicates(table))
    )
    return " UNION ALL ".join(parts)


STATUS = "CASE WHEN error_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status"
RAW_REPORT = f"""SELECT *, {pct('error_count', 'total_records')} AS error_pct,
  {rnd('((1.0::DOUBLE - CAST(error_count AS DOUBLE) / nullif(total_records, 0)) * 100)')} AS conformance_pct, {STATUS}
FROM ({_raw_checks('bronze')})"""


def _clean_report(table: str, extra: str = "") -> str:
    good = pct("total_records - error_count", "total_records")
    bad = pct("error_count", "total_records")
    return f"""SELECT {extra}*,
  CASE WHEN check_type = 'completeness' THEN {bad} ELSE {rnd(f'(100::DOUBLE - {good})')} END AS error_pct,
  CASE WHEN check_type = 'completeness' THEN 100::DOUBLE - {bad} ELSE {good} END AS conformance_pct, {STATUS}
FROM ({_clean_checks(table)})"""


def _summary(table: str) -> str:
    return f"""SELECT s + r AS total_input_records, s AS silver_records, r AS quarantine_records,
  {pct('r', 's + r')} AS quarantine_rate_pct, e AS total_quality_errors, {pct('s - e', 's')} AS overall_conformance_pct
FROM (SELECT (SELECT count(*) FROM {table}) AS s, (SELECT count(*) FROM rejected) AS r,
  (SELECT CAST(sum(error_count) AS BIGINT) FROM ({_clean_checks(table)})) AS e)"""


BAND = "CASE WHEN risk_score <= 25 THEN '0{d}25' WHEN risk_score <= 50 THEN '26{d}50' WHEN risk_score <= 75 THEN '51{d}75' ELSE '76{d}100' END"
CLEAN_BAND = BAND.format(d="–")
RAW_BAND = "CASE WHEN risk_score IS NULL THEN '[NULL]' ELSE " + BAND.format(d="-") + " END"


def _distribution(value: str, name: str, table: str) -> str:
    share = pct("count(*)", f"(SELECT count(*) FROM {table})")
    return f"SELECT {value} AS {name}, count(*) AS row_count, {share} AS pct FROM {table} GROUP BY 1"


def _all_distributions(table: str) -> str:
    dimensions = {c: f"coalesce({c}, '[NULL]')" for c in ("anomaly", "transaction_type", "location_region", "age_group", "purchase_pattern")}
    dimensions["risk_score_band"] = RAW_BAND
    share = pct("count(*)", f"(SELECT count(*) FROM {table})")
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dimension, {value} AS dim_value, count(*) AS record_count, {share} AS pct FROM {table} GROUP BY 2"
        for name, value in dimensions.items()
    )


def _test(table: str, column: str, test: str, condition: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test,
  {n_where(condition)} AS failures FROM {table}"""


def _unique(table: str, column: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, 'unique' AS test, count(*) AS failures
FROM (SELECT "{column}" FROM {table} WHERE "{column}" IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""


def _tests(*parts: str) -> str:
    results = " UNION ALL ".join(parts)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({results})"


# The 87 declared tests. After a column: n not null, r region, c class, y type, v class without low
# risk, s status, 0 and 1 the least value, p from 0 to 100, u unique.
DECLARED_TESTS = {
    "silver": """timestamp n, sending_address n, receiving_address n, amount n, transaction_type ny, location_region nr,
        anomaly nc, risk_score n""",
    "fraud_by_region": "location_region nr, anomaly nc, transaction_count n0, fraudulent_count n0, avg_risk_score np",
    "fraud_by_type": "transaction_type ny, anomaly nc, transaction_count n0, avg_risk_score np",
    "daily_fraud_metrics": """transaction_date n, location_region nr, total_transactions n1, high_risk_count n0,
        avg_risk_score np""",
    "high_risk_transactions": "transaction_datetime n, sending_address n, amount n, risk_score np, anomaly nv",
    "risk_profile": "age_group n, purchase_pattern n, anomaly nc, transaction_count n0, avg_risk_score np",
    "region_risk_ranking": """location_region nr, transaction_count n1, avg_risk_score np, min_risk_score np,
        max_risk_score np""",
    "top_sale_receivers": "receiving_address n, timestamp n, amount n0",
    "bronze_quality_report": """check_type n, check_name nu, description n, error_count n0, total_records n1, error_pct np,
        conformance_pct np, status ns""",
    "bronze_quality_distributions": "dimension n, dim_value n, record_count n1, pct np",
}


def _declared_tests(regions: str = REGIONS, tables=tuple(DECLARED_TESTS)) -> list[str]:
    """The counting SQL of each declared test."""
    objections = {
        "n": ("not_null", "{c} IS NULL"),
        "r": ("accepted_values", f"{{c}} NOT IN {regions}"),
        "c": ("accepted_values", f"{{c}} NOT IN {CLASSES}"),
        "y": ("accepted_values", f"{{c}} NOT IN {TYPES}"),
        "v": ("accepted_values", "{c} NOT IN ('high_risk', 'moderate_risk')"),
        "s": ("accepted_values", "{c} NOT IN ('PASS', 'FAIL')"),
        "0": ("accepted_range", "{c} < 0"),
        "1": ("accepted_range", "{c} < 1"),
        "p": ("accepted_range", "{c} < 0 OR {c} > 100"),
    }
    parts = []
    for table in tables:
        for column, marks in (item.split() for item in DECLARED_TESTS[table].split(",")):
            for mark in marks:
                if mark == "u":
                    parts.append(_unique(table, column))
                else:
                    kind, condition = objections[mark]
                    parts.append(_test(table, column, kind, condition.format(c=f'"{column}"')))
    return parts


def _invariants() -> str:
    tiers = _list(("micro", "small", "medium", "large"))
    reasons = _list(("invalid_amount", "invalid_region", "invalid_anomaly", "invalid_transaction_type",
                     "invalid_risk_score", "other"))
    broken = {
        ("silver", "amount_not_null"): "amount IS NULL",
        ("silver", "amount_positive"): "amount <= 0",
        ("silver", "risk_score_in_range"): "risk_score < 0 OR risk_score > 100",
        ("silver", "amount_tier_known"): f"amount_tier IS NULL OR amount_tier NOT IN {tiers}",
        ("silver", "fraud_flag_only_for_fraud_types"): "is_fraudulent AND transaction_type NOT IN ('phishing', 'scam')",
        ("silver", "location_region_known"): f"location_region IS NULL OR location_region NOT IN {REGIONS}",
        ("rejected", "reason_not_null"): "_rejection_reason IS NULL",
        ("rejected", "reason_known"): f"_rejection_reason NOT IN {reasons}",
        ("rejected", "reject_time_not_null"): "FALSE",
    }
    names = {"rejected": "quarantine"}
    parts = [
        f"SELECT '{names.get(table, table)}' AS table_name, '{name}' AS invariant, {n_where(c)} AS violations FROM {table}"
        for (table, name), c in broken.items()
    ]
    for table in ("bronze", "silver", "rejected", *GOLD):
        parts.append(
            f"SELECT '{names.get(table, table)}', 'not_empty', CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM {table}"
        )
    parts.append(
        """SELECT 'all', 'whole = silver + quarantine', abs((SELECT count(*) FROM bronze) - (SELECT count(*) FROM silver)
  - (SELECT count(*) FROM rejected))"""
    )
    results = " UNION ALL ".join(parts)
    return f"SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({results})"


def _conservation_cases() -> str:
    """Rows missing or too many; where there are none, 1 if the two bags of rows differ."""
    chosen = "(transaction_type IS NOT DISTINCT FROM 'sale' AND location_region IS NOT DISTINCT FROM 'Asia')"
    valid = "SELECT * EXCLUDE (ok) FROM marked WHERE ok"
    cases = {
        "intact": valid,
        "lost": f"{valid} AND NOT {chosen}",
        "doubled": f"{valid} UNION ALL {valid} AND {chosen}",
        "exchanged": f"""SELECT * EXCLUDE (ok) REPLACE (CASE WHEN {chosen} THEN receiving_address ELSE sending_address END AS sending_address,
  CASE WHEN {chosen} THEN sending_address ELSE receiving_address END AS receiving_address) FROM marked WHERE ok""",
    }
    parts = []
    for name, side in cases.items():
        both = f"({side} UNION ALL SELECT * EXCLUDE (ok) FROM marked WHERE NOT ok)"
        other = f"(SELECT count(*) FROM (SELECT * FROM bronze EXCEPT ALL SELECT * FROM {both}))"
        parts.append(f"""SELECT '{name}' AS case_name, CAST(greatest(abs((SELECT count(*) FROM bronze) - (SELECT count(*) FROM {both})),
  CASE WHEN {other} > 0 THEN 1 ELSE 0 END) AS BIGINT) AS violations""")
    return f"SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({' UNION ALL '.join(parts)})"


TEXT_RISK = "TRY_CAST(risk_score AS DOUBLE) < 0 OR TRY_CAST(risk_score AS DOUBLE) > 100"
TEXT_ROWS = """text_rows AS MATERIALIZED (
  SELECT CASE WHEN login_frequency IN (6, 7) THEN 'junk ' || CAST(amount AS VARCHAR) ELSE CAST(amount AS VARCHAR) END AS amount,
    CASE WHEN login_frequency IN (6, 7) THEN 'junk ' || CAST(risk_score AS VARCHAR) ELSE CAST(risk_score AS VARCHAR) END AS risk_score,
    CASE WHEN login_frequency IN (6, 7) THEN 'junk ' || anomaly ELSE anomaly END AS anomaly,
    location_region, CAST(login_frequency AS VARCHAR) AS login_frequency
  FROM bronze
)"""
# rows that are valid by two regions of which one never occurs; of all others the first reason is the same
SECOND_OK = "(ok AND location_region = 'Asia')"


def _second_spec_invariants() -> str:
    names = {
        "silver": ("amount_not_null", "amount_positive", "risk_score_in_range", "amount_tier_known",
                   "fraud_flag_only_for_fraud_types", "location_region_known"),
        "quarantine": ("reason_not_null", "reason_known", "reject_time_not_null"),
    }
    parts = [f"SELECT '{table}' AS table_name, '{name}' AS invariant, CAST(0 AS BIGINT) AS violations" for table, own in names.items() for name in own]
    for table, condition in (("bronze", "TRUE"), ("silver", SECOND_OK), ("quarantine", f"NOT {SECOND_OK}")):
        parts.append(f"SELECT '{table}', 'not_empty', CAST(CASE WHEN {n_where(condition)} = 0 THEN 1 ELSE 0 END AS BIGINT) FROM marked")
    parts.append("SELECT 'all', 'whole = silver + quarantine', CAST(0 AS BIGINT)")
    return f"SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({' UNION ALL '.join(parts)})"


def _document() -> str:
    clean = _clean_report("silver")
    parts = [
        f"""SELECT check_type AS section, check_name AS name, error_count AS n,
  CASE WHEN check_type = 'completeness' THEN error_pct ELSE conformance_pct END AS pct, status AS note FROM ({clean})""",
        f"SELECT 'reasons', _rejection_reason, count(*), {pct('count(*)', '(SELECT count(*) FROM bronze)')}, NULL FROM rejected GROUP BY 2",
    ]
    spread = {c: c for c in ("anomaly", "transaction_type", "location_region")} | {"risk_score_bands": CLEAN_BAND}
    for name, value in spread.items():
        parts.append(f"SELECT '{name}', v, row_count, pct, NULL FROM ({_distribution(value, 'v', 'silver')})")
    for figure in ("total_input_records", "silver_records", "quarantine_records", "total_quality_errors"):
        parts.append(f"SELECT 'summary', '{figure}', {figure}, NULL, NULL FROM ({_summary('silver')})")
    for figure in ("quarantine_rate_pct", "overall_conformance_pct"):
        parts.append(f"SELECT 'summary', '{figure}', NULL, {figure}, NULL FROM ({_summary('silver')})")
    return " UNION ALL ".join(parts)


def _refresh_counts() -> str:
    tables = {
        "bronze.tb_fraud_credit": "bronze", "silver.tb_fraud_credit": "silver", "quarantine.tb_fraud_credit": "rejected",
        **{f"gold.{name}": name for name in GOLD},
    }
    tables["quality.silver_report"] = f"({_clean_checks('silver')})"
    tables["quality.bronze_quality_report"] = f"({_raw_checks('bronze')})"
    tables["quality.bronze_quality_distributions"] = f"({_all_distributions('bronze')})"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}" for name, table in tables.items()
    )


# the matrices have no column of their own for low risk, so that the one for all other values is used
MATRIX_COLUMNS = {c: f"anomaly = '{c}'" for c in ("moderate_risk", "high_risk")} | {
    "other": "anomaly IS NULL OR anomaly NOT IN ('moderate_risk', 'high_risk')"
}


LISTING = """SELECT transaction_datetime, location_region, transaction_type, amount, risk_score, anomaly, age_group,
  purchase_pattern, is_fraudulent
FROM high_risk_transactions
ORDER BY transaction_datetime DESC, location_region, transaction_type, amount, risk_score, anomaly, age_group,
  purchase_pattern, is_fraudulent"""

# the place on the page; equal rows are alike, so any of their orders will do
PAGE_NUMBER = """row_number() OVER (ORDER BY transaction_datetime DESC, location_region, transaction_type, amount, risk_score,
  anomaly, age_group, purchase_pattern, is_fraudulent) AS place"""

PLAIN_BRONZE = """SELECT * REPLACE (CAST("timestamp" AS VARCHAR) AS "timestamp", CAST(amount AS DOUBLE) AS amount) FROM bronze"""
NAN_AS_MINUS_ONE = "CASE WHEN isnan(risk_score) THEN -1.0 ELSE risk_score END AS risk_score"

SOURCE_COLUMNS = (
    "timestamp", "sending_address", "receiving_address", "amount", "transaction_type", "location_region", "ip_prefix",
    "login_frequency", "session_duration", "purchase_pattern", "age_group", "risk_score", "anomaly",
)


def _malformed() -> str:
    """Lines as they stand in the files: even login frequencies in reverse order and with a note."""
    cells = {c: f"""coalesce(CAST({'CAST(epoch("timestamp") AS BIGINT)' if c == 'timestamp' else c} AS VARCHAR), '')""" for c in SOURCE_COLUMNS}
    cells["session_duration"] = f"CASE WHEN login_frequency = 5 THEN 'x' || {cells['session_duration']} ELSE {cells['session_duration']} END"
    line = lambda order: " || ',' || ".join(f"({cells[c]})" for c in order)
    back = SOURCE_COLUMNS[::-1]
    raw = f"""CASE WHEN login_frequency = 3 THEN {line(SOURCE_COLUMNS[:8])} WHEN login_frequency = 4 THEN {line(back)} || ',n,more'
  ELSE {line(SOURCE_COLUMNS)} END"""
    marks = f"""odd AS MATERIALIZED (
  SELECT *, coalesce(login_frequency IN (3, 4, 5) AND session_duration < 10, FALSE) AS misfit FROM marked
), parts AS (
  SELECT 'raw_record' AS section, {raw} AS value FROM odd WHERE misfit
  UNION ALL SELECT 'reason', CASE WHEN misfit THEN 'malformed_record' ELSE {REASON} END FROM odd WHERE misfit OR NOT ok
  UNION ALL SELECT 'receiver', receiving_address FROM odd WHERE ok AND NOT misfit
)"""
    return q("SELECT section, value, count(*) AS row_count FROM parts GROUP BY ALL", marks)


ORACLE: dict[str, str] = {
    "csv_malformed": _malformed(),
    "ingest_column_ops": """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts,
  CAST(user_id AS INTEGER) AS account_id, event_type, CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(12,1)) AS DOUBLE) AS value
FROM events""",
    "audit_columns": q("""SELECT 'df_fraud_credit.csv' AS _source_file, 'batch_1' AS _batch_id, count(*) AS row_count,
  count(*) AS stamped_rows FROM bronze"""),
    "validate_split_counts": q(f"""SELECT count(*) AS input_rows, {n_where('ok')} AS valid_rows,
  {n_where('NOT ok')} AS rejected_rows FROM marked"""),
    "silver_enriched": q("""SELECT * REPLACE (CAST("timestamp" AS VARCHAR) AS "timestamp",
  CAST(transaction_datetime AS VARCHAR) AS transaction_datetime, CAST(transaction_date AS VARCHAR) AS transaction_date)
FROM silver"""),
    "quarantine_reasons": q(f"""SELECT * REPLACE (CAST("timestamp" AS VARCHAR) AS "timestamp",
  CAST(amount AS DOUBLE) AS amount, {NAN_AS_MINUS_ONE}) FROM rejected"""),
    "quarantine_reason_counts": q(f"""SELECT _rejection_reason AS reason, count(*) AS row_count,
  {pct('count(*)', '(SELECT count(*) FROM bronze)')} AS pct FROM rejected GROUP BY 1"""),
    "reject_without_lists": q("""SELECT CASE WHEN amount IS NULL OR amount <= 0 THEN 'invalid_amount' ELSE 'invalid_region' END
  AS _rejection_reason, count(*) AS row_count FROM bronze GROUP BY 1"""),
    "comparison_operators": q(f"""SELECT {n_where('risk_score >= 50')} AS ge, {n_where('risk_score > 50')} AS gt,
  {n_where('risk_score <= 50')} AS le, {n_where('risk_score < 50')} AS lt, {n_where('risk_score = 50')} AS eq,
  {n_where('risk_score <> 50')} AS ne FROM bronze"""),
    "events_enriched": """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type,
  CAST(trunc(value) AS INTEGER) AS value, CAST(ts AS VARCHAR) AS event_second,
  CAST(date_trunc('second', ts) AS VARCHAR) AS event_time, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date,
  event_type IN ('purchase') AS is_purchase, trunc(value) < 5 AS is_small,
  CASE WHEN trunc(value) < 10 THEN 's' WHEN trunc(value) < 30 THEN 'm' ELSE 'l' END AS size
FROM events
WHERE ts IS NOT NULL AND event_type IN ('view', 'click', 'purchase') AND value BETWEEN 1 AND 60""",
    "events_reject_counts": f"""SELECT CASE WHEN event_type NOT IN ('view', 'click', 'purchase') THEN 'type'
    WHEN value IS NULL OR value < 1 THEN 'too_small' ELSE 'other' END AS reason, count(*) AS row_count,
  {pct('count(*)', '(SELECT count(*) FROM events)')} AS pct
FROM events
WHERE NOT coalesce(ts IS NOT NULL AND event_type IN ('view', 'click', 'purchase') AND value BETWEEN 1 AND 60, FALSE)
GROUP BY 1""",
    **{name: q(body) for name, body in GOLD.items()},
    **{f"{name}_from_rollup": q(GOLD[name]) for name in ("region_risk_ranking", "fraud_by_region", "fraud_by_type", "risk_profile")},
    "sums_by_partitioning": q(f"""SELECT dealt, location_region, {exact_sum('amount')} AS sum_amount, {exact_avg('amount')} AS avg_amount,
  {exact_sum('odd')} AS sum_odd, {exact_avg('odd')} AS avg_odd
FROM (SELECT location_region, amount, amount / 7 - risk_score AS odd FROM silver),
  (VALUES ('as read'), ('one'), ('many'), ('rollup')) AS ways(dealt) GROUP BY 1, 2"""),
    "latest_sale_per_receiver": q("""SELECT receiving_address, max(amount) AS amount, CAST("timestamp" AS VARCHAR) AS "timestamp"
FROM silver s
WHERE transaction_type = 'sale' AND "timestamp" = (SELECT max("timestamp") FROM silver l
  WHERE l.transaction_type = 'sale' AND l.receiving_address = s.receiving_address)
GROUP BY receiving_address, "timestamp" """),
    "distinct_values": q("SELECT DISTINCT amount_tier, location_region FROM silver"),
    "quality_null_counts": q(
        "SELECT count(*) AS total_records, "
        + ", ".join(f'{n_where(f"{chr(34)}{c}{chr(34)} IS NULL")} AS "{c}"' for c in NULL_COLUMNS)
        + " FROM bronze"
    ),
    "quality_violations": q(
        "SELECT count(*) AS total_records, "
        + ", ".join(f"{n_where(c)} AS {name}" for name, c in VIOLATIONS.items())
        + " FROM bronze"
    ),
    "quality_duplicates": q(f"SELECT count(*) AS total_records, {_duplicates('bronze')} AS error_count FROM bronze"),
    "bronze_quality_report": q(RAW_REPORT),
    "silver_quality_report": q(_clean_report("silver", "'2024-01-01T00:00:00+00:00' AS report_timestamp, ")),
    "clean_report_on_raw_rows": q(_clean_report("bronze")),
    "quality_summary": q(_summary("silver")),
    "quality_summary_on_raw_rows": q(_summary("bronze")),
    "row_counts": q("SELECT (SELECT count(*) FROM silver) AS silver_rows, (SELECT count(*) FROM bronze) AS bronze_rows"),
    **{f"distribution_{c}": q(_distribution(c, c, "silver")) for c in ("anomaly", "transaction_type", "location_region")},
    "distribution_risk_bands": q(_distribution(CLEAN_BAND, "band", "silver")),
    "distribution_risk_bands_with_null": q(_distribution(RAW_BAND, "band", "bronze")),
    "distributions_all_dimensions": q(_all_distributions("bronze")),
    "report_document": q(_document()),
    "tests_not_null": q(_tests(*(
        _test("bronze", c, "not_null", f'"{c}" IS NULL')
        for c in ("timestamp", "sending_address", "amount", "location_region", "ip_prefix")
    ))),
    "tests_accepted_values": q(_tests(
        _test("bronze", "location_region", "accepted_values", f"location_region NOT IN {REGIONS}"),
        _test("bronze", "anomaly", "accepted_values", f"anomaly NOT IN {CLASSES}"),
        _test("bronze", "transaction_type", "accepted_values", f"transaction_type NOT IN {TYPES}"),
    )),
    "tests_accepted_range": q(_tests(
        _test("bronze", "risk_score", "accepted_range", "risk_score < 0 OR risk_score > 100"),
        _test("bronze", "amount", "accepted_range", "amount < 0"),
        _test("bronze", "login_frequency", "accepted_range", "login_frequency > 6"),
    )),
    "tests_unique": q(_tests(_unique("bronze", "sending_address"), _unique("bronze", "timestamp"))),
    "table_test_examples": q(f"""SELECT column_name, test, failures, failures > 0 AS has_examples, TRUE AS few_enough, TRUE AS all_offend
FROM ({_tests(
        *(_test("bronze", c, "not_null", f'"{c}" IS NULL') for c in ("timestamp", "sending_address", "amount", "location_region", "ip_prefix")),
        _test("bronze", "location_region", "accepted_values", f"location_region NOT IN {REGIONS}"),
        _test("bronze", "anomaly", "accepted_values", f"anomaly NOT IN {CLASSES}"),
        _test("bronze", "transaction_type", "accepted_values", f"transaction_type NOT IN {TYPES}"),
        _test("bronze", "risk_score", "accepted_range", "risk_score < 0 OR risk_score > 100"),
        _test("bronze", "amount", "accepted_range", "amount < 0"),
        _test("bronze", "login_frequency", "accepted_range", "login_frequency > 6"),
    )})"""),
    "offending_values": q(f"""SELECT location_region AS value, count(*) AS n_records FROM bronze
WHERE location_region NOT IN {REGIONS} GROUP BY 1"""),
    "offending_repeats": q("""SELECT CAST("timestamp" AS VARCHAR) AS value, count(*) AS n_records FROM bronze
WHERE "timestamp" IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""),
    "offending_range_rows": q(f"SELECT * FROM ({PLAIN_BRONZE}) WHERE login_frequency > 6"),
    "offending_null_rows": q("SELECT count(*) AS row_count FROM bronze WHERE amount IS NULL"),
    "quality_report_text_columns": q(f"""SELECT check_type, check_name, description, error_count, total_records,
  {pct('error_count', 'total_records')} AS error_pct,
  {rnd('((1 - CAST(error_count AS DOUBLE) / nullif(total_records, 0)) * 100)')} AS conformance_pct,
  CASE WHEN error_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  {_check('text_rows', 'validity', 'amount_positive', 'amount must be > 0', n_where('TRY_CAST(amount AS DOUBLE) <= 0'))}
  UNION ALL {_check('text_rows', 'validity', 'location_region_valid', REGION_TEXT, n_where(f'location_region NOT IN {REGIONS}'))}
  UNION ALL {_check('text_rows', 'validity', 'anomaly_valid', CLASS_TEXT, n_where(f'anomaly NOT IN {CLASSES}'))}
  UNION ALL {_check('text_rows', 'validity', 'risk_score_range', RISK_TEXT, n_where(TEXT_RISK))})""", TEXT_ROWS),
    "tests_on_text": q(_tests(
        _test("text_rows", "risk_score", "accepted_range", TEXT_RISK).replace("'text_rows'", "'bronze'"),
        _test("text_rows", "amount", "accepted_range", "TRY_CAST(amount AS DOUBLE) < 0").replace("'text_rows'", "'bronze'"),
        _test("text_rows", "login_frequency", "accepted_range", "TRY_CAST(login_frequency AS DOUBLE) > 6").replace("'text_rows'", "'bronze'"),
        _test("text_rows", "anomaly", "accepted_values", f"anomaly NOT IN {CLASSES}").replace("'text_rows'", "'bronze'"),
        _test("text_rows", "login_frequency", "accepted_values", "login_frequency NOT IN ('1', '2', '3')").replace("'text_rows'", "'bronze'"),
    ), TEXT_ROWS),
    "percent_ties": """SELECT DISTINCT l_orderkey % 800 AS part,
  CAST((l_orderkey % 800 * 25 + 1) // 2 AS DOUBLE) / 100 AS pct FROM lineitem""",
    "whole_numbers_from_text": """SELECT l_linenumber, no,
  CAST(CASE WHEN no < 5 THEN sign * l_linenumber WHEN no = 5 THEN sign * l_linenumber * 10 END AS INTEGER) AS whole
FROM (SELECT DISTINCT l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END AS sign FROM lineitem)
CROSS JOIN (SELECT CAST(unnest(range(7)) AS INTEGER) AS no)""",
    "table_tests_second_spec": q(
        _tests(*_declared_tests("('Asia', 'Mars')")), *GOLD_CTES,
        f"bronze_quality_report AS MATERIALIZED ({RAW_REPORT})",
        f"bronze_quality_distributions AS MATERIALIZED ({_all_distributions('bronze')})",
    ),
    "invariants_second_spec": q(_second_spec_invariants()),
    "table_tests_all": q(
        _tests(*_declared_tests()),
        *GOLD_CTES,
        f"bronze_quality_report AS MATERIALIZED ({RAW_REPORT})",
        f"bronze_quality_distributions AS MATERIALIZED ({_all_distributions('bronze')})",
    ),
    "invariants": q(_invariants(), *GOLD_CTES),
    "conservation_cases": q(_conservation_cases()),
    **{
        f"chart_{name}": q(body, *GOLD_CTES)
        for name, body in {
            "transactions_by_region": """SELECT location_region, CAST(sum(transaction_count) AS BIGINT) AS "Transactions"
FROM fraud_by_region GROUP BY 1""",
            "anomaly_distribution": """SELECT anomaly, CAST(sum(transaction_count) AS BIGINT) AS "Count"
FROM fraud_by_region GROUP BY 1""",
            "avg_risk_by_region": f"""SELECT location_region, {exact_avg('avg_risk_score')} AS "Avg Risk Score" FROM fraud_by_region GROUP BY 1""",
            "amount_by_type": f"""SELECT transaction_type, {exact_sum('total_amount')} AS "Total Amount" FROM fraud_by_type GROUP BY 1""",
            "count_by_type_and_anomaly": """SELECT transaction_type, anomaly, CAST(sum(transaction_count) AS BIGINT) AS "Count"
FROM fraud_by_type GROUP BY 1, 2""",
            "daily_volume": """SELECT transaction_date, location_region, CAST(sum(total_transactions) AS BIGINT) AS "Total Transactions"
FROM daily_fraud_metrics GROUP BY 1, 2""",
            "daily_high_risk": """SELECT transaction_date, CAST(sum(high_risk_count) AS BIGINT) AS "High Risk"
FROM daily_fraud_metrics GROUP BY 1""",
            "risk_heatmap": f"""SELECT location_region, anomaly, {exact_avg('avg_risk_score')} AS "Avg Risk Score"
FROM fraud_by_region GROUP BY 1, 2""",
            "risk_by_segment": f"""SELECT age_group, purchase_pattern, {exact_avg('avg_risk_score')} AS "Avg Risk Score"
FROM risk_profile GROUP BY 1, 2""",
            "count_matrix": "SELECT transaction_type, "
            + ", ".join(
                f"CAST(sum(transaction_count) FILTER (WHERE {of}) AS BIGINT) AS {c}" for c, of in MATRIX_COLUMNS.items()
            )
            + " FROM fraud_by_type GROUP BY 1",
            "risk_matrix": "SELECT location_region, "
            + ", ".join(f"{exact_avg('avg_risk_score', of)} AS {c}" for c, of in MATRIX_COLUMNS.items())
            + " FROM fraud_by_region GROUP BY 1",
            "detail_page": f"SELECT *, {PAGE_NUMBER} FROM ({LISTING} LIMIT 25)",
            "detail_second_page": f"SELECT *, {PAGE_NUMBER} FROM ({LISTING} LIMIT 25 OFFSET 25)",
        }.items()
    },
    "csv_roundtrip": q(f"""SELECT * REPLACE ({NAN_AS_MINUS_ONE}), 'df_fraud_credit.csv' AS _source_file, 'batch_1' AS _batch_id
FROM ({PLAIN_BRONZE})"""),
    "partitioned_table": q("""SELECT location_region, count(*) AS row_count, """ + TOTAL + """,
  (SELECT count(*) FROM silver) AS written_rows FROM silver WHERE location_region IN ('Asia', 'Europe') GROUP BY 1"""),
    "clustered_table": q("""SELECT location_region, count(*) AS row_count, CAST(0 AS BIGINT) AS overlapping_files, TRUE AS reads_a_part
FROM silver GROUP BY 1"""),
    "published_together": q(" UNION ALL ".join(
        f"SELECT '{moment}' AS moment, '{layer}' AS layer, count(*) AS row_count FROM {table}" + (where if moment == "afterwards" else "")
        for moment in ("while written", "afterwards", "reader from before")
        for layer, table, where in (
            ("silver", "silver", " WHERE location_region = 'Asia'"),
            ("quarantine", "rejected", " WHERE _rejection_reason = 'invalid_amount'"),
        )
    )),
    "sql_model_table": q("""SELECT purchase_pattern, count(*) AS row_count, count(location_region) AS with_region
FROM bronze GROUP BY 1"""),
    "codec_table": q("SELECT count(*) AS row_count, count(*) AS zstd_rows FROM bronze"),
    "bronze_quality_report_order": q(f"""SELECT check_type, check_name,
  CAST(row_number() OVER (ORDER BY check_type, check_name) AS INTEGER) AS place FROM ({RAW_REPORT})"""),
    "region_risk_ranking_order": q(f"""SELECT location_region,
  CAST(row_number() OVER (ORDER BY avg_risk_score DESC, location_region) AS INTEGER) AS place FROM ({GOLD['region_risk_ranking']})"""),
    "optional_table": q("""SELECT 'tb_fraud_credit' AS table_name, count(*) AS row_count FROM rejected
UNION ALL SELECT 'tb_missing', 0"""),
    "full_refresh_counts": q(_refresh_counts(), *GOLD_CTES),
}
