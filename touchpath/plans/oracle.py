"""Plain SQL twins of the registered queries, for checking results.

Each is written in another form than the Spark code: windows as self-joins,
spells as islands, nearest scores as ranked distances, draws by listing what is
left, medians by the built-in function.
"""

from __future__ import annotations

import re

from touchpath.settings import (
    ACTIVITY_TYPES,
    DEMOGRAPHICS,
    LIGHT_TOUCHES,
    PERSONNEL_TYPES,
    STEP_WINDOWS,
    STRONG_TOUCHES,
)
from touchpath.functions.columns import CHECK_CHARACTERS
from touchpath.operators.propensity import FIRST_FEATURES, SECOND_FEATURES, FeatureSet
from touchpath.sources.fixtures import DETAILS, RAW_TYPES, SETTINGS, TASK_TYPES


def _text(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def _texts(values) -> str:
    return ", ".join(_text(value) for value in values)


def _day(value) -> str:
    return f"DATE '{value}'"


AS_OF = _day(SETTINGS.as_of)
WANTED = f"activity_type NOT IN ({_texts(SETTINGS.excluded_types)})"


def _clean(column: str, names: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {_text(raw)} THEN {_text(clean)}" for raw, clean in names.items())
    return f"CASE {column} {cases} ELSE {column} END"


CLEAN = _clean("activity_type", SETTINGS.type_names)


def _moved(key: str, modulus: int) -> str:
    return f"({key} + CASE WHEN {key} % {modulus} = 0 THEN 1 ELSE 0 END)"


def _record_id_15(key: str) -> str:
    return f"translate(lpad(CAST({key} AS VARCHAR), 15, '0'), '0123456789', 'aBcDeFgHiJ')"


def _record_id_18(column: str) -> str:
    checks = []
    for block in range(3):
        bits = " + ".join(
            f"CASE WHEN regexp_matches(substr({column}, {block * 5 + i + 1}, 1), '[A-Z]') THEN {1 << i} ELSE 0 END"
            for i in range(5)
        )
        checks.append(f"substr('{CHECK_CHARACTERS}', 1 + {bits}, 1)")
    return f"CASE WHEN length({column}) = 15 THEN {column} || {' || '.join(checks)} ELSE {column} END"


_RAW_TYPE = (
    f"CASE WHEN l_suppkey % 29 = 0 THEN 'To-Do' WHEN l_partkey % 32 >= {len(RAW_TYPES)} THEN 'Sale' "
    f"ELSE [{_texts(RAW_TYPES)}][CAST(l_partkey % 32 AS INT) + 1] END"
)

_TASK_TYPE = "CASE activity_type " + " ".join(
    f"WHEN {_text(plain)} THEN {_text(copy)}" for plain, copy in TASK_TYPES.items()
) + " ELSE activity_type END"

TABLES: dict[str, str] = {}

# --- inputs -------------------------------------------------------------------

TABLES["t_lines"] = f"""
    SELECT {_moved("o_custkey", 10)} AS contact_id, {_RAW_TYPE} AS activity_type,
           CAST(l_shipdate AS DATE) AS activity_date,
           printf('%013d-%d-%011d-%010d-%012d', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  CAST(round(l_extendedprice * 100) AS BIGINT)) AS seq,
           l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

TABLES["t_activity"] = f"""
    SELECT contact_id, printf('Customer#%09d', contact_id) AS contact_name, activity_type, activity_date, seq,
           CASE WHEN activity_type = 'Sale'
                THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 4 AS DECIMAL(18,2)) END AS sales_amount,
           CASE WHEN l_partkey % 7 = 0 THEN '' ELSE 'F' || CAST(l_partkey % 7 AS VARCHAR) END AS fund_code,
           [{_texts(DETAILS)}, NULL, NULL][CAST(l_suppkey % 8 AS INT) + 1] AS additional_detail,
           CASE l_orderkey % 11 WHEN 0 THEN 'https://www.example.com/learn/a'
                                WHEN 1 THEN 'https://www.example.com/investments/b' END AS link,
           seq AS event_id
    FROM t_lines"""

TABLES["t_raw"] = """
    SELECT CASE WHEN day(activity_date) % 11 = 0 THEN 'x' || CAST(contact_id AS VARCHAR)
                WHEN day(activity_date) % 13 = 0 THEN NULL ELSE CAST(contact_id AS VARCHAR) END AS contact_text,
           CASE (contact_id + month(activity_date)) % 8
                WHEN 0 THEN upper(activity_type) WHEN 1 THEN lower(activity_type)
                WHEN 2 THEN '  ' || replace(activity_type, ' ', '.') || ' '
                WHEN 3 THEN 'Unheard Of' WHEN 4 THEN NULL ELSE activity_type END AS type_text,
           CASE (contact_id + dayofyear(activity_date)) % 9
                WHEN 0 THEN strftime(activity_date, '%m/%d/%Y') WHEN 1 THEN strftime(activity_date, '%Y%m%d')
                WHEN 2 THEN CAST(activity_date AS VARCHAR) || ' 10:20:30' WHEN 3 THEN 'soon' WHEN 4 THEN '2001-02-30'
                WHEN 5 THEN CASE WHEN day(activity_date) % 2 = 0 THEN '  ' END
                ELSE CAST(activity_date AS VARCHAR) END AS date_text,
           seq, contact_id, activity_type, activity_date
    FROM t_activity"""

# what each variant of a clean row must come to, told by how it was made
TABLES["t_triaged"] = f"""
    SELECT * REPLACE (CASE WHEN type_text IS NOT NULL THEN activity_type END AS activity_type),
           CASE WHEN contact_text IS NULL THEN 'no contact'
                WHEN contact_text LIKE 'x%' THEN 'contact is no number'
                WHEN (contact_id + dayofyear(activity_date)) % 9 = 5 THEN 'no date'
                WHEN (contact_id + dayofyear(activity_date)) % 9 IN (3, 4) THEN 'date cannot be read'
                WHEN activity_date > {AS_OF} THEN 'date is after the present day'
                WHEN type_text = 'Unheard Of' THEN 'type is unknown'
                WHEN lower(trim(type_text)) = 'voicemail' AND type_text NOT IN ('VoiceMail', 'Voicemail')
                THEN 'type stands for several' END AS reason
    FROM t_raw"""

TABLES["t_people"] = """
    SELECT c_custkey AS contact_id, c_acctbal AS gdc, c_acctbal * 100 AS aum,
           CASE WHEN c_custkey % 7 <> 0
                THEN CAST(c_custkey % 50 AS DOUBLE) / CAST(50 AS DOUBLE) - CAST(0.1 AS DOUBLE) END AS x_to_advisory,
           CASE WHEN c_custkey % 9 <> 0
                THEN CAST(c_custkey % 40 AS DOUBLE) / CAST(50 AS DOUBLE) - CAST(0.1 AS DOUBLE) END AS x_to_alternatives,
           CAST(c_custkey % 80 - 5 AS DOUBLE) AS age,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS advisor_type
    FROM customer"""

TABLES["t_contact"] = f"""
    SELECT c_custkey AS contact_id, c_name AS contact_name,
           DATE '1995-01-01' + CAST(c_custkey % 900 AS INT) AS created_date, c_mktsegment AS contact_type,
           CASE WHEN c_custkey % 4 <> 1 THEN first_sale END AS first_sale_date_all,
           CASE WHEN c_custkey % 4 <> 0 THEN first_sale END AS first_sale_date_new,
           ['O', 'X', NULL, 'A', 'A', 'A'][CAST(c_custkey % 6 AS INT) + 1] AS rating,
           CASE WHEN c_custkey % 3 <> 0 THEN 'y' ELSE 'n' END AS approved,
           CASE WHEN c_custkey % 5 = 0 THEN 'Multi' ELSE 'Single' END AS registration,
           CASE WHEN c_custkey % 17 <> 0 THEN CAST(c_custkey % 13 * 5 AS DOUBLE) END AS score_7_days_ago,
           CASE WHEN c_custkey % 19 = 0 THEN 'HOUSE' ELSE 'A' END AS account_name,
           CASE WHEN c_custkey % 23 <> 0 THEN n_name END AS territory,
           {_record_id_18(_record_id_15("c_custkey"))} AS record_id
    FROM customer
    LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) + 60 AS first_sale FROM orders GROUP BY 1)
           ON o_custkey = c_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey"""

TABLES["t_fund_map"] = """
    SELECT * FROM (VALUES ('F1', 'FX'), ('F3', 'FX'), ('F5', 'F5')) AS f(fund_code, single_fund_code)"""

TABLES["t_history"] = f"""
    SELECT {_moved("o_custkey", 13)} AS contact_id, CAST(o_orderdate AS DATE) AS process_date,
           CAST(max(o_orderkey) % 101 AS DOUBLE) / 100 AS score
    FROM orders GROUP BY 1, 2"""

TABLES["t_web"] = f"""
    SELECT {_record_id_15("user_id")} AS contact_id_15, CAST(user_id AS VARCHAR) AS visitor_key,
           printf('%015d', event_id) AS session_key, ts AS session_start_ts,
           'content-' || regexp_extract(props, '[0-9]+') AS event_name,
           'https://www.example.com/c/content-' || regexp_extract(props, '[0-9]+') AS event_url,
           'example' AS site_name, 'https://www.example.com' AS site_url, ts AS event_ts
    FROM events"""

TABLES["t_catalog"] = """
    SELECT 'content-' || CAST(item_id AS VARCHAR) AS event_name,
           'https://www.example.com/c/content-' || CAST(item_id AS VARCHAR) AS event_url,
           CASE WHEN item_id % 3 = 0 THEN 0 ELSE 1 END AS level
    FROM benchmark"""

TABLES["t_old"] = """
    SELECT o_custkey AS contact_id, printf('Customer#%09d', o_custkey) AS contact_name,
           'Level1' AS engagement_level, 'content-' || CAST(o_orderkey % 40 AS VARCHAR) AS sku_next_content,
           'https://www.example.com/c/content-' || CAST(o_orderkey % 40 AS VARCHAR) AS url_next_content,
           CAST(min(o_orderdate) AS DATE) AS recommendation_date
    FROM orders GROUP BY ALL"""

TABLES["t_user"] = """
    SELECT s_suppkey AS user_id, s_name AS user_name,
           CASE WHEN s_suppkey % 5 = 0 THEN 'False' ELSE 'True' END AS is_active FROM supplier"""

TABLES["t_territory"] = """
    SELECT n_name AS territory_name, n_nationkey AS internal_wholesaler,
           CASE WHEN n_nationkey % 6 = 0 THEN n_nationkey ELSE n_nationkey + 5 END AS sales_associate FROM nation"""

TABLES["t_task"] = f"""
    SELECT contact_id AS who_id, l_suppkey AS owner_id, activity_date, {_TASK_TYPE} AS activity_type,
           [{_texts((*SETTINGS.profiles, "Other"))}][l_linenumber % 5 + 1] AS profile,
           CASE WHEN l_quantity >= 5 THEN l_shipdate END AS completed_at
    FROM t_lines"""

TABLES["t_event"] = f"""
    SELECT o_orderkey AS event_id, o_orderkey % 10 AS owner_id, CAST(o_orderdate AS DATE) AS activity_date,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'Meeting' ELSE 'Call' END AS event_type,
           {_moved("o_custkey", 10)} AS contact_id
    FROM orders"""

TABLES["t_dense"] = """
    SELECT user_id AS contact_id, event_type AS activity_type, CAST(ts AS DATE) AS activity_date, event_id,
           CAST(value AS DECIMAL(18,2)) AS amount,
           row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), event_id) AS pos
    FROM events"""

# --- timeline -----------------------------------------------------------------

TABLES["t_start"] = """
    SELECT a.contact_id, a.contact_name,
           CASE WHEN a.first_activity < c.created_date THEN a.first_activity ELSE c.created_date END AS activity_date
    FROM (SELECT contact_id, contact_name, min(activity_date) AS first_activity FROM t_activity GROUP BY 1, 2) a
    LEFT JOIN t_contact c USING (contact_id)"""

TABLES["t_idle"] = """
    SELECT contact_id, contact_name, created_date FROM t_contact
    WHERE contact_id NOT IN (SELECT contact_id FROM t_activity)"""

TABLES["t_present"] = f"""
    SELECT a.contact_id, a.contact_name, {AS_OF} AS activity_date, c.contact_type,
           c.first_sale_date_new AS first_sale_date
    FROM t_activity a LEFT JOIN t_contact c USING (contact_id)
    WHERE {WANTED}
    GROUP BY a.contact_id, a.contact_name, a.additional_detail, a.link, c.contact_type, c.first_sale_date_new"""

TABLES["t_timeline"] = f"""
    SELECT contact_id, contact_name, NULL AS activity_type, activity_date,
           CAST(NULL AS DECIMAL(18,2)) AS sales_amount, NULL AS additional_detail, NULL AS link, 0 AS branch,
           contact_name AS seq
    FROM (SELECT contact_id, contact_name, activity_date FROM t_start
          UNION ALL SELECT contact_id, contact_name, created_date FROM t_idle
          UNION ALL SELECT contact_id, contact_name, {AS_OF} FROM t_idle)
    UNION ALL
    SELECT contact_id, contact_name, activity_type, activity_date, sales_amount, additional_detail, link, 1, seq
    FROM t_activity WHERE {WANTED}
    UNION ALL
    SELECT contact_id, contact_name, NULL, activity_date, NULL, NULL, NULL, 2, contact_name FROM t_present"""

TABLES["t_defaulted"] = f"""
    SELECT contact_id, contact_name, coalesce({CLEAN}, 'Nothing') AS activity_type, activity_date,
           -- an idle contact's second row is its present day
           CASE WHEN branch = 0 AND activity_date = {AS_OF} AND contact_id IN (SELECT contact_id FROM t_idle)
                THEN 2 ELSE branch END AS branch, seq,
           coalesce(sales_amount, 0) AS sales_amount, coalesce(additional_detail, 'Nothing') AS additional_detail, link
    FROM t_timeline"""

_ORDERED = "row_number() OVER (PARTITION BY contact_id ORDER BY activity_date, branch, seq) AS pos"

TABLES["t_rows"] = f"""
    SELECT *, {_ORDERED} FROM (
        SELECT * FROM t_defaulted
        QUALIFY row_number() OVER (PARTITION BY contact_id, activity_type, activity_date, additional_detail
                                   ORDER BY branch, seq) = 1)"""

TABLES["t_rows_v1"] = f"""
    SELECT *, {_ORDERED} FROM (
        SELECT * FROM t_defaulted
        QUALIFY row_number() OVER (PARTITION BY contact_id, activity_type, activity_date
                                   ORDER BY branch DESC, seq DESC) = 1)"""

# --- lifecycle ----------------------------------------------------------------


def _within(condition: str, days: int) -> str:
    return f"count(*) FILTER (WHERE ({condition}) AND a.activity_date - b.activity_date <= {days})"


def _levels(rows: str, first_sale: str, decaying: bool) -> str:
    def days(short: int) -> int:
        return short if decaying else 3000

    touches = LIGHT_TOUCHES + STRONG_TOUCHES if decaying else LIGHT_TOUCHES
    links = (
        f" OR regexp_matches(b.link, {_text(SETTINGS.learn_pattern)})"
        f" OR regexp_matches(b.link, {_text(SETTINGS.investments_pattern)})"
        if decaying
        else ""
    )
    return f"""
    SELECT k.*, c.contact_type,
           CASE WHEN pos = max(pos) OVER (PARTITION BY contact_id) THEN 'PresentDay'
                WHEN s > 0 AND m <= 6 AND s <= 150000 THEN 'New Producer'
                WHEN s > 0 AND m <= 6 AND s > 150000 THEN 'Rising Star'
                WHEN s > 0 AND m > 6 AND s <= 350000 THEN 'Developing Producer'
                WHEN s > 0 AND m > 20 AND s > 1000000 THEN 'Advocate'
                WHEN s > 0 AND m > 6 AND s > 350000 THEN 'Core Producer'
                WHEN (lit > 0 AND kit > 0) OR forum > 0 OR meeting > 0 THEN 'Level5'
                WHEN roadshow > 0 THEN 'Level4'
                WHEN presentation > 0 THEN 'Level3'
                WHEN detail > 0 OR outbound > 0 THEN 'Level2'
                WHEN touch > 0 THEN 'Level1'
                ELSE 'Level0' END AS level,
           CAST(s AS DECIMAL(28,2)) AS sales
    FROM (SELECT a.contact_id, a.contact_name, a.activity_type, a.activity_date, a.branch, a.seq, a.pos,
                 a.additional_detail, sum(b.sales_amount) AS s,
                 {_within("b.activity_type = 'LitOrder'", days(60))} AS lit,
                 {_within("b.additional_detail IN ('KIT', 'PRO', 'PR')", days(60))} AS kit,
                 {_within("b.activity_type = 'EdForum'", days(180))} AS forum,
                 {_within("b.activity_type = 'Meeting'", days(90))} AS meeting,
                 {_within("b.activity_type IN ('Assisted.Roadshow', 'Unassisted.Roadshow', 'Investor.University')", days(180))} AS roadshow,
                 {_within("b.activity_type IN ('Sales.Presentation', 'Marketing.Webinar')", days(60))} AS presentation,
                 {_within("b.additional_detail IN ('education-center', 'webinars', 'our-funds')" + links, days(35))} AS detail,
                 {_within("b.activity_type = 'Outbound'", days(90))} AS outbound,
                 {_within(f"b.activity_type IN ({_texts(touches)})", 3000)} AS touch
          FROM {rows} a JOIN {rows} b ON a.contact_id = b.contact_id AND b.pos <= a.pos
          GROUP BY ALL) k
    LEFT JOIN (SELECT contact_id AS cid, contact_type, {first_sale} AS first_sale FROM t_contact) c
           ON c.cid = k.contact_id
    CROSS JOIN LATERAL (SELECT (k.activity_date - c.first_sale) / 30.0 AS m)"""


TABLES["t_levels"] = _levels("t_rows", "first_sale_date_new", True)
TABLES["t_levels_v1"] = _levels("t_rows_v1", "first_sale_date_all", False)


def _lifecycle(levels: str) -> str:
    return f"""
    SELECT i.contact_id, i.contact_name, i.activity_date, i.branch, i.seq, i.pos, i.level, i.contact_type,
           CASE WHEN i.pos = 1 THEN 'JourneyBegins'
                WHEN i.pos = i.n THEN 'Present' ELSE i.activity_type END AS activity_type,
           CASE WHEN i.level = 'PresentDay' THEN coalesce(i.prior, 'PresentDay') ELSE i.level END AS engagement_level,
           CASE WHEN i.prior <> i.level THEN i.prior || '-->' || i.level END AS recent_level_change,
           CASE WHEN i.prior <> i.level THEN CAST(i.activity_date - s.began AS INTEGER) END AS duration_last_level,
           (SELECT string_agg(f.level, '-->' ORDER BY f.first_pos)
            FROM (SELECT contact_id, level, min(pos) AS first_pos FROM {levels} GROUP BY 1, 2) f
            WHERE f.contact_id = i.contact_id AND f.first_pos <= i.pos) AS full_level_cycle
    FROM (SELECT *, sum(turn) OVER (PARTITION BY contact_id ORDER BY pos) AS island
          FROM (SELECT *, lag(level) OVER w AS prior, count(*) OVER (PARTITION BY contact_id) AS n,
                       CASE WHEN lag(level) OVER w = level THEN 0 ELSE 1 END AS turn
                FROM {levels} WINDOW w AS (PARTITION BY contact_id ORDER BY pos))) i
    LEFT JOIN (SELECT contact_id, island, min(activity_date) AS began
               FROM (SELECT contact_id, activity_date, sum(turn) OVER (PARTITION BY contact_id ORDER BY pos) AS island
                     FROM (SELECT contact_id, activity_date, pos,
                                  CASE WHEN lag(level) OVER (PARTITION BY contact_id ORDER BY pos) = level
                                       THEN 0 ELSE 1 END AS turn FROM {levels}))
               GROUP BY 1, 2) s ON s.contact_id = i.contact_id AND s.island = i.island - 1"""


TABLES["t_life"] = _lifecycle("t_levels")
TABLES["t_life_v1"] = _lifecycle("t_levels_v1")

_FULL = """contact_id, contact_name, activity_type, activity_date, engagement_level, duration_last_level,
           recent_level_change, full_level_cycle, contact_type"""


def _status(life: str) -> str:
    return f"""
    SELECT contact_id, contact_name, engagement_level, duration_last_level, full_level_cycle
    FROM {life} QUALIFY pos = max(pos) OVER (PARTITION BY contact_id)"""


TABLES["t_status"] = _status("t_life")

# --- propensity ---------------------------------------------------------------

_PERSON = ["contact_name", *DEMOGRAPHICS, "advisor_type"]
_YEAR = f"activity_date >= {_day(SETTINGS.year_floor)}"

TABLES["t_logged"] = f"""
    SELECT a.contact_id, contact_name, {CLEAN} AS activity_type, activity_date, 1 AS branch, seq,
           coalesce(sales_amount, 0) AS sales_amount, coalesce(m.single_fund_code, a.fund_code) AS fund_code,
           additional_detail, {", ".join(DEMOGRAPHICS)}, advisor_type
    FROM t_activity a LEFT JOIN t_fund_map m ON m.fund_code = a.fund_code
    LEFT JOIN t_people p ON p.contact_id = a.contact_id
    WHERE {WANTED} AND {_YEAR}"""

TABLES["t_scored_rows"] = f"""
    SELECT * FROM t_logged UNION ALL
    SELECT DISTINCT contact_id, contact_name, 'Nothing', {AS_OF}, 2, '', 0, '', '', {", ".join(DEMOGRAPHICS)},
           advisor_type FROM t_logged"""

TABLES["t_prop"] = f"""
    SELECT *, {_ORDERED} FROM (
        SELECT * FROM t_scored_rows
        QUALIFY row_number() OVER (PARTITION BY contact_id, activity_type, activity_date, fund_code, additional_detail
                                   ORDER BY branch, seq) = 1)"""

TABLES["t_prop_v1"] = f"SELECT *, {_ORDERED} FROM t_scored_rows"


def _funds(rows: str) -> str:
    return f"""
    SELECT a.contact_id, a.pos,
           count(DISTINCT b.fund_code) FILTER (WHERE b.activity_type = 'Sale') AS unique_funds_sale,
           count(DISTINCT b.fund_code) FILTER (WHERE b.fund_code <> '') AS unique_funds
    FROM {rows} a JOIN {rows} b ON a.contact_id = b.contact_id AND b.pos <= a.pos GROUP BY 1, 2"""


TABLES["t_funds"] = _funds("t_prop")
TABLES["t_funds_v1"] = _funds("t_prop_v1")


def _features(rows: str, funds: str, features: FeatureSet) -> str:
    counters = ",\n           ".join(
        f"""{_within(f"b.pos <= a.pos AND b.activity_type = '{kind}'", 90)} AS {name}"""
        for kind, name in features.counters.items()
    )

    def money(days: int) -> str:
        return (
            f"CAST(sum(b.sales_amount) FILTER (WHERE b.pos <= a.pos AND a.activity_date - b.activity_date <= {days})"
            f" AS DECIMAL(28,2)) AS rt{days}"
        )

    person = ", ".join(f"a.{name}" for name in [*_PERSON, "activity_type", "activity_date", "seq", "branch", "pos"])
    group = f"a.contact_id, {person}"
    return f"""
    SELECT f.unique_funds_sale, f.unique_funds, k.* FROM (
    SELECT a.contact_id, {person}, {money(365)}, {money(180)}, {money(90)},
           {_within("b.pos <= a.pos AND b.activity_type = 'Sale' AND b.sales_amount > 0", 90)} AS tickets90,
           {counters},
           coalesce(CAST(a.activity_date - max(b.activity_date) FILTER (WHERE b.pos < a.pos AND b.activity_type = 'Sale')
                    AS INTEGER), -999) AS days_till_last_sale,
           CASE WHEN min(b.activity_date) FILTER (WHERE b.pos > a.pos AND b.activity_type = 'Sale')
                     - a.activity_date <= 35 THEN 1 ELSE 0 END AS sale_in_35
    FROM (SELECT * FROM {rows} WHERE activity_date > {_day(SETTINGS.feature_floor)}) a
    JOIN (SELECT contact_id, activity_type, activity_date, sales_amount, pos FROM {rows}
          WHERE activity_date > {_day(SETTINGS.feature_floor)}) b ON a.contact_id = b.contact_id
    GROUP BY {group}) k JOIN {funds} f ON f.contact_id = k.contact_id AND f.pos = k.pos"""


TABLES["t_features"] = _features("t_prop", "t_funds", SECOND_FEATURES)
TABLES["t_features_v1"] = _features("t_prop_v1", "t_funds_v1", FIRST_FEATURES)

for _version in ("", "_v1"):
    TABLES[f"t_training{_version}"] = f"""
    SELECT * FROM t_features{_version}
    WHERE activity_date > {_day(SETTINGS.training_floor)} AND activity_date < {AS_OF} - {SETTINGS.label_days}
    QUALIFY pos = max(pos) OVER (PARTITION BY contact_id, activity_date)"""


def _filled(name: str, rows: str) -> str:
    return f"CASE WHEN {name} > 0 THEN {name} ELSE (SELECT median({name}) FROM {rows}) END"


def _imputed(rows: str) -> str:
    return ", ".join(f"round({_filled(name, rows)}, 6) AS {name}" for name in DEMOGRAPHICS)


def _scoring_input(rows: str, features: FeatureSet) -> str:
    return f"""SELECT contact_id, contact_name, activity_date, {_imputed(rows)}, {_feature_columns(features)}, sale_in_35
        FROM (SELECT * FROM {rows} QUALIFY pos = max(pos) OVER (PARTITION BY contact_id))"""


def _feature_columns(features: FeatureSet) -> str:
    return ", ".join(name for name in features.columns if name not in DEMOGRAPHICS)


TABLES["t_last_features"] = f"""
    SELECT contact_id, contact_name, {", ".join(f"{_filled(name, 't_features')} AS {name}" for name in DEMOGRAPHICS)},
           {_feature_columns(SECOND_FEATURES)}
    FROM (SELECT * FROM t_features QUALIFY pos = max(pos) OVER (PARTITION BY contact_id))"""

# three trees of a model, each leaf as the rule that leads to it
TABLES["t_rules"] = """
    SELECT contact_id, contact_name,
           CASE WHEN days_till_last_sale <= -1 AND unique_funds <= 2 THEN -0.75
                WHEN days_till_last_sale <= -1 THEN -0.25
                WHEN days_till_last_sale <= 120 THEN 0.625 ELSE 0.125 END
           + CASE WHEN age <= 40.5 THEN 0.0625 WHEN meeting_90 = 0 THEN -0.125 ELSE 0.375 END
           + CASE WHEN rt365 > 100000 THEN 0.5 WHEN gdc <= 3000 THEN -0.3125 ELSE 0.03125 END AS margin
    FROM t_last_features"""

_ROUNDED = ", ".join(f"round({name}, 6) AS {name}" for name in DEMOGRAPHICS)

# --- scores -------------------------------------------------------------------

TABLES["t_described"] = f"""
    SELECT contact_id, string_agg(printf('%s %-21s %-15s %s %s', '{{', activity_type, CAST(activity_date AS VARCHAR),
                                         coalesce(additional_detail, 'NA'), '}}'), chr(10) ORDER BY pos) AS prop_desc
    FROM (SELECT * FROM t_prop
          WHERE activity_date > {AS_OF} - {SETTINGS.recent_days} AND activity_type IN ({_texts(SETTINGS.described_types)})
          QUALIFY row_number() OVER (PARTITION BY contact_id, activity_type, activity_date, additional_detail
                                     ORDER BY pos) = 1)
    GROUP BY contact_id"""


def _nearest(rows: str, history: str) -> str:
    return f"""
    SELECT a.*, h.process_date, h.score
    FROM {rows} a LEFT JOIN {history} h ON h.contact_id = a.contact_id
    QUALIFY row_number() OVER (PARTITION BY a.contact_id, a.seq
                               ORDER BY abs(a.activity_date - h.process_date), h.process_date) = 1"""


TABLES["t_charted"] = f"""
    SELECT a.contact_id, contact_name, {CLEAN} AS activity_type, activity_date, event_id, seq
    FROM t_activity a LEFT JOIN t_fund_map m ON m.fund_code = a.fund_code
    WHERE {WANTED} AND activity_date >= {_day(SETTINGS.score_floor)}
    QUALIFY row_number() OVER (PARTITION BY a.contact_id, activity_type, activity_date,
                                            coalesce(m.single_fund_code, a.fund_code) ORDER BY seq) = 1"""

TABLES["t_recent_history"] = f"SELECT * FROM t_history WHERE process_date >= {_day(SETTINGS.score_floor)}"
TABLES["t_chart"] = _nearest("t_charted", "t_recent_history")

TABLES["t_master"] = """
    SELECT contact_id, contact_name, score_7_days_ago FROM t_contact
    WHERE (rating NOT IN ('O', 'X') OR rating IS NULL) AND approved = 'y' AND registration = 'Single'"""

# --- recommendation -----------------------------------------------------------

_STEP_COLUMNS = [step.lower() for step in STEP_WINDOWS]

TABLES["t_steps"] = "SELECT l.contact_id, l.contact_name, " + ", ".join(
    f"count(*) FILTER (WHERE r.activity_type IN ({_texts(types)}) AND l.activity_date - r.activity_date <= {days})"
    f" AS {step.lower()}"
    for step, (types, days) in STEP_WINDOWS.items()
) + """
    FROM (SELECT * FROM t_rows QUALIFY pos = max(pos) OVER (PARTITION BY contact_id)) l
    JOIN t_rows r ON r.contact_id = l.contact_id GROUP BY 1, 2"""

TABLES["t_reach"] = "SELECT * FROM t_status WHERE engagement_level <> 'PresentDay'"

TABLES["t_orders_of_steps"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({_text(level)}, {_text(step)}, {place})"
    for level, steps in SETTINGS.next_steps.items()
    for place, step in enumerate(steps)
) + ") AS o(level, step, place)"

_COUNTED = " UNION ALL ".join(
    f"SELECT contact_id, '{step}' AS step, {step.lower()} AS n FROM t_steps" for step in STEP_WINDOWS
)

TABLES["t_next"] = f"""
    SELECT r.contact_id, r.contact_name, r.engagement_level AS level,
           coalesce(string_agg(o.step, ', ' ORDER BY o.place) FILTER (WHERE n.n = 0), '') AS next_step
    FROM t_reach r JOIN t_orders_of_steps o ON o.level = r.engagement_level
    LEFT JOIN ({_COUNTED}) n ON n.contact_id = r.contact_id AND n.step = o.step
    GROUP BY 1, 2, 3"""

TABLES["t_consumed"] = f"""
    SELECT c.contact_id, c.contact_name, 'WebHit' AS activity_type, CAST(event_ts AS DATE) AS activity_date,
           event_name, event_url
    FROM t_web w JOIN t_contact c ON c.record_id = {_record_id_18("w.contact_id_15")}
    WHERE event_name IN (SELECT event_name FROM t_catalog) AND account_name <> {_text(SETTINGS.excluded_account)}
      AND event_url LIKE '%{SETTINGS.content_host}%'
    QUALIFY row_number() OVER (PARTITION BY c.contact_id, event_name
                               ORDER BY CAST(event_ts AS DATE), session_key) = 1"""

TABLES["t_left"] = f"""
    SELECT r.contact_id, r.contact_name, r.engagement_level, k.event_name, k.event_url,
           row_number() OVER (PARTITION BY r.contact_id ORDER BY k.event_name) - 1 AS place,
           count(*) OVER (PARTITION BY r.contact_id) AS n,
           CAST('0x' || substr(md5('{SETTINGS.draw_seed}|' || CAST(r.contact_id AS VARCHAR)), 1, 12) AS BIGINT) AS draw
    FROM t_reach r JOIN t_catalog k ON k.level = CASE WHEN r.engagement_level = 'Level0' THEN 0 ELSE 1 END
    WHERE NOT EXISTS (SELECT 1 FROM t_consumed c WHERE c.contact_id = r.contact_id AND c.event_name = k.event_name)"""

TABLES["t_new"] = f"""
    SELECT r.contact_id, r.contact_name, r.engagement_level, l.event_name AS sku_next_content,
           l.event_url AS url_next_content, {AS_OF} AS recommendation_date
    FROM t_reach r LEFT JOIN t_left l ON l.contact_id = r.contact_id AND l.place = l.draw % l.n"""

TABLES["t_all_recommended"] = """
    SELECT contact_id, contact_name, engagement_level, sku_next_content, url_next_content, recommendation_date
    FROM t_old
    UNION ALL
    SELECT n.* FROM t_new n WHERE NOT EXISTS (
        SELECT 1 FROM t_old o WHERE o.contact_id = n.contact_id AND o.sku_next_content = n.sku_next_content)"""

# --- personnel ----------------------------------------------------------------

TABLES["t_served"] = f"""
    SELECT user_name AS personnel_name, territory_name, activity_type, activity_date, who_id AS contact_id
    FROM t_task JOIN t_user ON user_id = owner_id
    JOIN t_territory ON user_id = internal_wholesaler OR user_id = sales_associate
    WHERE activity_date > {_day(SETTINGS.personnel_floor)} AND activity_type IN ({_texts(PERSONNEL_TYPES)})
      AND profile IN ({_texts(SETTINGS.profiles)}) AND completed_at IS NOT NULL AND is_active = 'True'"""

TABLES["t_actions"] = f"""
    SELECT personnel_name, territory_name, contact_id, contact_name, activity_date,
           {_clean("activity_type", PERSONNEL_TYPES)} AS activity_type
    FROM (SELECT personnel_name, territory_name, activity_type, activity_date, c.contact_id, c.contact_name
          FROM t_served s LEFT JOIN t_contact c ON c.contact_id = s.contact_id GROUP BY ALL
          UNION ALL
          SELECT user_name, territory, event_type, activity_date, c.contact_id, c.contact_name
          FROM t_event e JOIN t_contact c ON c.contact_id = e.contact_id JOIN t_user ON user_id = owner_id
          WHERE event_type = 'Meeting' AND is_active = 'True' AND territory IS NOT NULL
            AND activity_date > {_day(SETTINGS.personnel_floor)} GROUP BY ALL)"""


def _ahead(kind: str, days: int) -> str:
    return f"count(*) FILTER (WHERE b.activity_type = '{kind}' AND b.activity_date - a.activity_date <= {days})"


TABLES["t_outlook"] = f"""
    SELECT a.contact_id, a.contact_name, a.activity_type, a.activity_date, a.branch, a.seq, a.pos, a.engagement_level,
           {_ahead("Sales.Presentation", 60)} AS sales_presentation_f, {_ahead("Sale", 35)} AS tickets_f,
           {_ahead("Meeting", 35)} AS meeting_f
    FROM t_life a JOIN t_life b ON a.contact_id = b.contact_id AND b.pos >= a.pos GROUP BY ALL"""

TABLES["t_outlook_prior"] = """
    SELECT o.*, coalesce(p.engagement_level, o.engagement_level) AS prior_level
    FROM t_outlook o LEFT JOIN t_life p ON p.contact_id = o.contact_id AND p.pos = o.pos - 1"""

# --- queries ------------------------------------------------------------------

_PLACE = "contact_id, activity_date, branch, seq"

_PROP_PLACE = "contact_id, activity_date, branch, CASE WHEN branch = 2 THEN 'present' ELSE seq END AS seq"

FINAL: dict[str, str] = {
    "activity_filtered": f"SELECT contact_id, activity_type, activity_date, seq FROM t_activity WHERE {WANTED} AND {_YEAR}",
    "fund_normalised": """SELECT a.contact_id, a.seq, coalesce(m.single_fund_code, a.fund_code) AS fund_code
        FROM t_activity a LEFT JOIN t_fund_map m ON m.fund_code = a.fund_code""",
    "activity_clean": f"""SELECT contact_id, contact_name, activity_type, activity_date, sales_amount, fund_code,
        {_ROUNDED}, advisor_type, additional_detail FROM t_logged
        QUALIFY row_number() OVER (PARTITION BY contact_id, activity_type, activity_date, fund_code, additional_detail
                                   ORDER BY seq) = 1""",
    "activity_enriched": f"""SELECT a.contact_id, a.seq, a.activity_type, a.activity_date, c.contact_type,
        c.first_sale_date_new AS first_sale_date
        FROM t_activity a LEFT JOIN t_contact c ON c.contact_id = a.contact_id WHERE {WANTED}""",
    "dedup_keep_first": """SELECT contact_id, activity_type, activity_date, event_id, amount FROM t_dense d
        WHERE NOT EXISTS (SELECT 1 FROM t_dense e WHERE e.contact_id = d.contact_id
            AND e.activity_type = d.activity_type AND e.activity_date = d.activity_date AND e.pos < d.pos)""",
    "dedup_keep_last": """SELECT contact_id, activity_type, activity_date, event_id, amount FROM t_dense d
        WHERE NOT EXISTS (SELECT 1 FROM t_dense e WHERE e.contact_id = d.contact_id
            AND e.activity_type = d.activity_type AND e.activity_date = d.activity_date AND e.pos > d.pos)""",
    "record_id_18": f"SELECT session_key, contact_id_15, {_record_id_18('contact_id_15')} AS record_id FROM t_web",
    "web_tracking_projection": """SELECT contact_id_15, visitor_key, session_key, session_start_ts, event_name,
        event_url, site_name, site_url FROM t_web""",
    "content_catalog": "SELECT event_name, event_url, level FROM t_catalog",
    "activity_trusted": """SELECT seq, contact_id, activity_type, activity_date FROM t_triaged WHERE reason IS NULL""",
    "activity_rejects": """SELECT contact_text, type_text, date_text, seq, reason FROM t_triaged
        WHERE reason IS NOT NULL""",
    "reject_reasons": "SELECT reason, count(*) AS n FROM t_triaged WHERE reason IS NOT NULL GROUP BY 1",
    "activity_from_csv": """SELECT contact_id, contact_name, activity_type, activity_date, seq, sales_amount, fund_code,
        additional_detail, link, event_id FROM t_activity""",
    "contacts_refreshed": "SELECT * FROM t_master",
    "contact_snapshots": f"""SELECT *, {AS_OF} AS snapshot_date FROM t_master
        UNION ALL SELECT *, CAST({AS_OF} + 1 AS DATE) FROM t_master WHERE contact_id % 2 = 1""",
    "status_sample": "SELECT * FROM t_status ORDER BY contact_id LIMIT 1000",
    "journey_start": "SELECT contact_id, contact_name, activity_date FROM t_start",
    "contacts_without_activity": "SELECT contact_id, contact_name, created_date FROM t_idle",
    "present_day_rows": "SELECT * FROM t_present",
    "activity_timeline": """SELECT t.contact_id, t.contact_name, t.activity_date, c.contact_type,
        c.first_sale_date_new AS first_sale_date, t.activity_type, t.sales_amount, t.additional_detail, t.link, t.branch
        FROM t_timeline t LEFT JOIN t_contact c ON c.contact_id = t.contact_id""",
    "first_last_flags": f"""SELECT {_PLACE}, pos = 1 AS is_first,
        pos = max(pos) OVER (PARTITION BY contact_id) AS is_last FROM t_rows""",
    "last_activity_date": f"""SELECT {_PLACE}, max(activity_date) OVER (PARTITION BY contact_id) AS max_activity_date
        FROM t_rows""",
    "trailing_counts": f"""SELECT a.event_id, {_within("b.activity_type = 'click'", 3)} AS clicks_3,
        {_within("b.activity_type = 'click'", 7)} AS clicks_7, {_within("b.activity_type = 'view'", 3)} AS views_3,
        {_within("true", 7)} AS rows_7
        FROM t_dense a JOIN t_dense b ON a.contact_id = b.contact_id AND b.pos <= a.pos GROUP BY 1""",
    "trailing_sums": "SELECT a.event_id, " + ", ".join(
        f"""CAST(coalesce(sum(b.amount) FILTER (WHERE b.activity_type = 'purchase'
            AND a.activity_date - b.activity_date <= {days}), 0) AS DECIMAL(28,2)) AS amount_{days}"""
        for days in (3, 7)
    ) + " FROM t_dense a JOIN t_dense b ON a.contact_id = b.contact_id AND b.pos <= a.pos GROUP BY 1",
    "forward_counts": f"""SELECT a.event_id, {_ahead("click", 3)} AS clicks_ahead_3,
        count(*) FILTER (WHERE b.activity_date - a.activity_date <= 7) AS rows_ahead_7
        FROM t_dense a JOIN t_dense b ON a.contact_id = b.contact_id AND b.pos >= a.pos GROUP BY 1""",
    "running_sales": """SELECT a.contact_id, a.activity_date, a.branch, a.seq,
        CAST(sum(b.sales_amount) AS DECIMAL(28,2)) AS sales
        FROM t_rows a JOIN t_rows b ON a.contact_id = b.contact_id AND b.pos <= a.pos GROUP BY 1, 2, 3, 4""",
    "unique_funds_running": f"""SELECT {_PROP_PLACE}, unique_funds_sale, unique_funds
        FROM t_prop JOIN t_funds USING (contact_id, pos)""",
    "days_since_last_sale": """SELECT a.contact_id, a.activity_date, a.branch,
        CASE WHEN a.branch = 2 THEN 'present' ELSE a.seq END AS seq,
        coalesce(CAST(a.activity_date - max(b.activity_date) AS INTEGER), -999) AS days_till_last_sale
        FROM t_prop a LEFT JOIN t_prop b ON a.contact_id = b.contact_id AND b.pos < a.pos AND b.activity_type = 'Sale'
        GROUP BY 1, 2, 3, 4""",
    "sale_in_35": """SELECT a.contact_id, a.activity_date, a.branch,
        CASE WHEN a.branch = 2 THEN 'present' ELSE a.seq END AS seq,
        CASE WHEN min(b.activity_date) - a.activity_date <= 35 THEN 1 ELSE 0 END AS sale_in_35
        FROM t_prop a LEFT JOIN t_prop b ON a.contact_id = b.contact_id AND b.pos > a.pos AND b.activity_type = 'Sale'
        GROUP BY 1, 2, 3, 4""",
    "level_change": f"SELECT {_PLACE}, level, recent_level_change FROM t_life",
    "prior_level": f"SELECT {_PLACE}, engagement_level, prior_level FROM t_outlook_prior",
    "running_path": f"SELECT {_PLACE}, full_level_cycle FROM t_life",
    "level_spells": f"SELECT {_PLACE}, level, duration_last_level FROM t_life",
    "engagement_level_v1": f"SELECT {_PLACE}, activity_type, additional_detail, sales, level FROM t_levels_v1",
    "engagement_level_v2": f"SELECT {_PLACE}, activity_type, additional_detail, sales, level FROM t_levels",
    "lifecycle_full": f"SELECT {_FULL} FROM t_life",
    "lifecycle_transitions": f"SELECT {_FULL} FROM t_life WHERE recent_level_change IS NOT NULL",
    "lifecycle_transitions_v1": f"SELECT {_FULL} FROM t_life_v1 WHERE recent_level_change IS NOT NULL",
    "current_status": "SELECT * FROM t_status",
    "current_status_v1": _status("t_life_v1"),
    "lifecycle_transition_report": f"""SELECT {_FULL} FROM t_life
        WHERE activity_date > {_day(SETTINGS.training_floor)} AND recent_level_change NOT LIKE '%PresentDay%'
          AND recent_level_change LIKE '%Level%'""",
    "propensity_features": f"""SELECT contact_id, contact_name, activity_type, activity_date,
        CASE WHEN branch = 2 THEN 'present' ELSE seq END AS seq, {_ROUNDED}, {_feature_columns(SECOND_FEATURES)},
        sale_in_35 FROM t_features""",
    "propensity_features_v1": f"""SELECT contact_id, contact_name, activity_type, activity_date,
        CASE WHEN branch = 2 THEN 'present' ELSE seq END AS seq, {_ROUNDED}, {_feature_columns(FIRST_FEATURES)},
        sale_in_35 FROM t_features_v1""",
    "propensity_training_set": f"""SELECT contact_id, contact_name, activity_date, {_imputed("t_training")},
        {_feature_columns(SECOND_FEATURES)}, sale_in_35 FROM t_training""",
    "propensity_training_set_v1": f"""SELECT contact_id, contact_name, activity_date, {_imputed("t_training_v1")},
        {_feature_columns(FIRST_FEATURES)}, sale_in_35 FROM t_training_v1""",
    "median_impute": f"""SELECT contact_id, {_imputed("t_features")}
        FROM (SELECT * FROM t_features QUALIFY pos = max(pos) OVER (PARTITION BY contact_id))""",
    "propensity_scoring_input": _scoring_input("t_features", SECOND_FEATURES),
    "propensity_scoring_input_v1": _scoring_input("t_features_v1", FIRST_FEATURES),
    "propensity_scorecard": """SELECT contact_id, contact_name,
        round(1 / (1 + exp(-2 * CAST(margin AS DOUBLE))), 9) AS prediction FROM t_rules""",
    "master_contacts": "SELECT * FROM t_master",
    "activity_description": "SELECT * FROM t_described",
    "score_delta": """SELECT m.contact_id,
        CASE WHEN s.prediction IS NOT NULL THEN m.contact_name END AS contact_name, s.prediction,
        round((s.prediction - m.score_7_days_ago / 100) / nullif(m.score_7_days_ago / 100, 0), 6)
            AS propensity_delta_percent, d.prop_desc
        FROM t_master m
        LEFT JOIN (SELECT contact_id, score AS prediction FROM t_history
                   QUALIFY process_date = max(process_date) OVER (PARTITION BY contact_id)) s
               ON s.contact_id = m.contact_id
        LEFT JOIN t_described d ON d.contact_id = m.contact_id""",
    "score_nearest": "SELECT contact_id, activity_date, seq, process_date, score FROM ("
    + _nearest(f"(SELECT contact_id, activity_date, seq FROM t_activity WHERE {WANTED})", "t_history")
    + ")",
    "score_timeline": "SELECT contact_id, contact_name, activity_type, activity_date, score, event_id FROM t_chart",
    "latest_events_topk": f"""SELECT contact_id, contact_name, activity_type, activity_date, score, event_id
        FROM (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY activity_date DESC, seq DESC) AS r FROM t_chart)
        WHERE r <= {SETTINGS.timeline_rows} AND score IS NOT NULL""",
    "latest_events_export": f"""SELECT contact_id, contact_name, activity_type, activity_date, score, event_id,
        true AS in_order
        FROM (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY activity_date DESC, seq DESC) AS r FROM t_chart)
        WHERE r <= {SETTINGS.timeline_rows} AND score IS NOT NULL""",
    "step_counts": "SELECT * FROM t_steps",
    "step_counts_long": " UNION ALL ".join(
        f"SELECT contact_id, contact_name, '{step}' AS step, {step} AS n FROM t_steps" for step in _STEP_COLUMNS
    ),
    "next_step": "SELECT * FROM t_next",
    "content_consumption": "SELECT * FROM t_consumed",
    "unseen_content": """SELECT r.contact_id, r.contact_name,
        coalesce(string_agg(l.event_name, ', ' ORDER BY l.event_name), '') AS unseen_content,
        count(l.event_name) AS n_unseen
        FROM t_reach r LEFT JOIN t_left l ON l.contact_id = r.contact_id GROUP BY 1, 2""",
    "recommendation": "SELECT * FROM t_new",
    "next_step_final": """SELECT n.contact_id, s.contact_name, s.level, n.url_next_content AS next_content, s.next_step
        FROM t_new n LEFT JOIN t_next s ON s.contact_id = n.contact_id""",
    "recommendation_history": "SELECT * FROM t_all_recommended",
    "recommendation_additions": """SELECT n.* FROM t_new n WHERE NOT EXISTS (
        SELECT 1 FROM t_old o WHERE o.contact_id = n.contact_id AND o.sku_next_content = n.sku_next_content)""",
    "recommendation_history_appended": "SELECT * FROM t_all_recommended",
    "recommendation_execution": """SELECT CAST(row_number() OVER (PARTITION BY h.contact_id
            ORDER BY recommendation_date, sku_next_content) AS INTEGER) AS recommendation_id,
        h.contact_id, h.contact_name, engagement_level, sku_next_content, url_next_content, recommendation_date,
        c.activity_date AS execution_date
        FROM t_all_recommended h
        LEFT JOIN t_consumed c ON c.contact_id = h.contact_id AND c.event_name = h.sku_next_content""",
    "personnel_task_territory": "SELECT * FROM t_served",
    "personnel_activity": "SELECT * FROM t_actions",
    "personnel_outcome": """SELECT a.personnel_name, a.territory_name, a.contact_id, a.contact_name, a.activity_type,
        a.activity_date, o.prior_level, o.sales_presentation_f, o.tickets_f, o.meeting_f,
        CASE WHEN o.contact_id IS NULL THEN NULL
             WHEN a.activity_type IN ('VoiceMail', 'Outbound') AND sales_presentation_f + tickets_f + meeting_f > 0 THEN 1
             WHEN a.activity_type = 'Sales.Presentation' AND meeting_f + tickets_f > 0 THEN 1
             WHEN a.activity_type = 'Meeting' AND tickets_f > 0 THEN 1 ELSE 0 END AS success
        FROM t_actions a LEFT JOIN t_outlook_prior o USING (contact_id, contact_name, activity_date, activity_type)""",
}


def _with_tables(sql: str) -> str:
    """Prefix a query with the tables it uses, in order of definition."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\bt_\w+", text)) & TABLES.keys() - needed:
            needed.add(name)
            visit(TABLES[name])

    visit(sql)
    # a table read more than once is computed once
    parts = [f"{name} AS MATERIALIZED ({TABLES[name]})" for name in TABLES if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql


def oracle_sql() -> dict[str, str]:
    return {name: _with_tables(sql) for name, sql in FINAL.items()}
