"""SQL for DuckDB that recomputes every registered query on its own terms.

The SQL shares only the role views with the Spark side.  Latest rows are ranked by
windows, presence is asked by EXISTS, streaks walk back day by day: other routes than
the ones the Spark operators take.
"""

from __future__ import annotations

import re

from .standins import ROLE_VIEWS

TODAY = "DATE '2024-01-31'"
YESTERDAY = "DATE '2024-01-30'"

ORACLE: dict[str, str] = {}

_ROLE = re.compile(r"\b(" + "|".join(ROLE_VIEWS) + r")\b")

# Named pieces an oracle may use; each is added, with what it needs itself, when named.
PIECES: dict[str, str] = {}


def piece(name: str, sql: str) -> None:
    PIECES[name] = sql


def _needed(sql: str, names: dict[str, str]) -> list[str]:
    """Names used by ``sql``, dependencies first."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in names:
            if name not in found and re.search(rf"\b{name}\b", text):
                visit(names[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def oracle(name: str, sql: str) -> None:
    pieces = _needed(sql, PIECES)
    text = "\n".join([PIECES[p] for p in pieces] + [sql])
    roles = [r for r in ROLE_VIEWS if r in set(_ROLE.findall(text))]
    ctes = [f"{r} AS ({ROLE_VIEWS[r].strip()})" for r in roles]
    ctes += [f"{p} AS ({PIECES[p].strip()})" for p in pieces]
    ORACLE[name] = ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + sql.strip()


# --- pieces -------------------------------------------------------------------

piece("running", f"""
SELECT p.id AS patient_id, s.type AS cohort, s.name AS plan_name, p.nutritionist_id, p.firstname,
       p.start_weight AS sw, p.goal_weight AS gw, p.target_duration AS dur,
       p.subscription_start_date AS sd
FROM subscriptions s, patients p
WHERE s.id = p.active_subscription_id
  AND (s.type = 'Coach+App' OR (s.type = 'GLP' AND NOT list_contains(
        ['metabolic diagnosis test', 'metabolic screening', 'pre glp assesment'], lower(s.name))))
  AND p.is_active AND p.status = 'ACTIVE_SUBSCRIPTION'
  AND NOT p.subscription_end_date < {TODAY}
  AND length(trim(p.firstname)) > 0
  AND p.nutritionist_id IN (2, 4, 6)
""")
piece("contact_log", """
SELECT patient_id, 'note' AS kind, consultant_id IS NOT NULL AS named, date::DATE AS d FROM patientnotes
UNION ALL
SELECT patient_id, 'visit', TRUE, date::DATE FROM appointment WHERE status = 'COMPLETED'
UNION ALL
SELECT k.patient_id, 'message', TRUE, m.messaged_at::DATE
FROM messages m, chats k WHERE k.id = m.chat_id AND k.consultant_id = m.sender
""")
piece("weighed", """
SELECT patient_id, event_id, value, date, created_at,
       row_number() OVER (PARTITION BY patient_id
                          ORDER BY date DESC NULLS FIRST, created_at DESC NULLS FIRST, event_id DESC) AS place
FROM metrics WHERE name = 'BODY_WEIGHT'
""")
piece("weighed_before", f"""
SELECT patient_id, value,
       row_number() OVER (PARTITION BY patient_id ORDER BY date DESC, created_at DESC, event_id DESC) AS place
FROM metrics WHERE name = 'BODY_WEIGHT' AND date::DATE < {TODAY}
""")
piece("now_weight", """
SELECT patient_id, round(value::DECIMAL(38,12), 2)::DOUBLE AS cw FROM weighed WHERE place = 1
""")
piece("then_weight", """
SELECT patient_id, round(value::DECIMAL(38,12), 2)::DOUBLE AS cw FROM weighed_before WHERE place = 1
""")
piece("any_log", """
SELECT patient_id, date::DATE AS d FROM activity
UNION ALL SELECT patient_id, date::DATE FROM patientfoodlogs
UNION ALL SELECT patient_id, date::DATE FROM metrics
""")


def status_case(weight: str, days: str) -> str:
    return f"""CASE
      WHEN {weight} IS NULL OR sw IS NULL OR gw IS NULL OR sd IS NULL OR coalesce(dur, 0) <= 0
        THEN 'Data Incomplete'
      WHEN NOT sw > gw THEN 'Goal Achieved or Invalid'
      WHEN sw - {weight} >= ((sw - gw) / dur) * (CASE WHEN {days} > 0 THEN {days} ELSE 0 END) THEN 'On Track'
      ELSE 'Off Track' END"""


def flags(day: str, cut: str, weights: str, contact: str) -> str:
    """Flag columns of one day over ``running r``; ``cut`` limits the facts that count."""
    return f"""
  CASE WHEN r.sw IS NOT NULL AND r.gw IS NOT NULL
         AND r.patient_id IN (SELECT patient_id FROM metrics WHERE name = 'BODY_FAT' {cut})
         AND r.patient_id IN (SELECT patient_id FROM patientfoodlogs WHERE TRUE {cut})
       THEN 'Yes' ELSE 'No' END AS onb,
  CAST({day} - (SELECT max(k.d) FROM contact_log k WHERE k.patient_id = r.patient_id AND {contact}) AS INTEGER) AS idle,
  CASE WHEN EXISTS (SELECT 1 FROM patientfoodlogs f WHERE f.patient_id = r.patient_id
                    AND f.date::DATE >= {day} - 3 {cut}) THEN 'Yes' ELSE 'No' END AS meal,
  CASE WHEN EXISTS (SELECT 1 FROM metrics w WHERE w.patient_id = r.patient_id AND w.name = 'BODY_WEIGHT'
                    AND w.date::DATE >= {day} - 7 {cut}) THEN 'Yes' ELSE 'No' END AS wlog,
  (SELECT cw FROM {weights} x WHERE x.patient_id = r.patient_id) AS cw"""


BEFORE_TODAY = f"AND date::DATE < {TODAY}"
piece("flags_today", "SELECT r.*, " + flags(TODAY, "", "now_weight", "k.named") + " FROM running r")
piece(
    "flags_prev",
    "SELECT r.*, "
    + flags(
        YESTERDAY,
        BEFORE_TODAY,
        "then_weight",
        f"(k.named OR r.cohort = 'Coach+App') AND k.d < {TODAY}",
    )
    + " FROM running r",
)
piece("state_today", f"SELECT *, {status_case('cw', f'({TODAY} - sd)')} AS st FROM flags_today")
piece("state_prev", f"SELECT *, {status_case('cw', f'({YESTERDAY} - sd)')} AS st FROM flags_prev")
piece("metric_names", """
SELECT * FROM (VALUES
  (1, 'Number of Paid Users'), (2, 'Num Completely not onboarded'), (3, 'Num On Track Users'),
  (4, 'Num Off Track Users'), (5, 'Num users with no interaction in last 2 days'),
  (6, 'Num users with no meal log in last 3 days'),
  (7, 'Num users with no weight log in last 7 days')) v(sort_order, metric)
""")


def day_hits(state: str) -> str:
    return f"""
SELECT cohort, unnest([1,
    CASE WHEN onb = 'No' THEN 2 END,
    CASE st WHEN 'On Track' THEN 3 WHEN 'Off Track' THEN 4 END,
    CASE WHEN coalesce(idle, 99) > 2 THEN 5 END,
    CASE WHEN meal = 'No' THEN 6 END,
    CASE WHEN wlog = 'No' THEN 7 END]) AS sort_order
FROM {state}"""


piece("hits_today", day_hits("state_today"))
piece("hits_prev", day_hits("state_prev") + f" WHERE sd <= {YESTERDAY}")


def hit_count(table: str, cohort: str) -> str:
    return f"(SELECT count(*) FROM {table} h WHERE h.sort_order = m.sort_order AND h.cohort = '{cohort}')"


piece("matrix", f"""
SELECT m.sort_order, m.metric,
       {hit_count('hits_today', 'Coach+App')} AS coach_today,
       {hit_count('hits_prev', 'Coach+App')} AS coach_yesterday,
       {hit_count('hits_today', 'GLP')} AS glp_today,
       {hit_count('hits_prev', 'GLP')} AS glp_yesterday
FROM metric_names m
""")
piece("delta", """
SELECT sort_order, metric,
       printf('%d (%+d)', coach_today, coach_today - coach_yesterday) AS coach_app,
       printf('%d (%+d)', glp_today, glp_today - glp_yesterday) AS glp
FROM matrix
""")
piece("effects", f"""
SELECT patient_id, type, date FROM patientsideeffects
WHERE creator = 'PATIENT' AND date >= {TODAY} - 7 AND lower(type) NOT IN ('good', 'okay', 'great')
""")
piece("user_rows", f"""
SELECT t.patient_id, t.cohort, trim(t.firstname) AS patient_name, t.nutritionist_id AS consultant_id,
       (SELECT c.name FROM consultants c WHERE c.id = t.nutritionist_id) AS consultant_name,
       t.plan_name, t.onb AS user_onboarded, round(t.gw::DECIMAL(38,12), 2)::DOUBLE AS track,
       t.idle AS days_since_contact,
       coalesce((SELECT string_agg(e.type, ', ' ORDER BY e.type) FROM effects e
                 WHERE e.patient_id = t.patient_id), 'None') AS side_effects,
       t.meal AS meal_log, t.wlog AS weight_log,
       (SELECT count(DISTINCT a.d) FROM any_log a
        WHERE a.patient_id = t.patient_id AND a.d >= {TODAY} - 7) AS active_days,
       (SELECT max(a.d) FROM any_log a WHERE a.patient_id = t.patient_id) AS last_active_day
FROM state_today t
""")
piece("noted", """
SELECT patient_id, date, description,
       row_number() OVER (PARTITION BY patient_id ORDER BY date DESC NULLS FIRST, id DESC) AS place
FROM patientnotes WHERE consultant_id IS NOT NULL
""")
piece("full_rows", f"""
SELECT t.patient_id, trim(t.firstname) AS patient_name, t.cohort AS plan_type,
       CASE WHEN t.sw + t.gw IS NULL THEN 'No' ELSE 'Yes' END AS goals_set,
       CASE WHEN (SELECT count(*) FROM metrics m WHERE m.patient_id = t.patient_id AND m.name = 'BODY_FAT') > 0
            THEN 'Yes' ELSE 'No' END AS scale_logged,
       CASE WHEN (SELECT count(*) FROM patientfoodlogs f WHERE f.patient_id = t.patient_id) > 0
            THEN 'Yes' ELSE 'No' END AS meal_logged,
       t.onb AS user_onboarded, t.sd AS start_date, CAST({TODAY} - t.sd AS INTEGER) AS days_since_start,
       round(t.sw::DECIMAL(38,12), 2)::DOUBLE AS start_weight,
       round(t.gw::DECIMAL(38,12), 2)::DOUBLE AS goal_weight, t.cw AS current_weight,
       round((((t.sw - t.gw) / nullif(t.dur, 0)) * greatest(0, {TODAY} - t.sd))::DECIMAL(38,12), 2)::DOUBLE
         AS expected_loss,
       round((t.sw - t.cw)::DECIMAL(38,12), 2)::DOUBLE AS actual_loss,
       n.date AS last_note_date, n.description AS last_note,
       CAST({TODAY} - greatest(n.date::DATE,
            (SELECT max(d) FROM contact_log k WHERE k.patient_id = t.patient_id AND kind <> 'note')) AS INTEGER)
         AS days_since_contact,
       (SELECT max(f.date)::DATE FROM patientfoodlogs f WHERE f.patient_id = t.patient_id) AS last_meal_day,
       (SELECT max(w.date)::DATE FROM weighed w WHERE w.patient_id = t.patient_id) AS last_weight_day,
       t.meal AS meal_log, t.wlog AS weight_log,
       (SELECT count(DISTINCT a.d) FROM any_log a
        WHERE a.patient_id = t.patient_id AND a.d >= {TODAY} - 7) AS active_days,
       (SELECT max(a.d) FROM any_log a WHERE a.patient_id = t.patient_id) AS last_active_day
FROM state_today t LEFT JOIN noted n ON n.patient_id = t.patient_id AND n.place = 1
""")
piece("by_name", """
SELECT lower(trim(patient_name)) AS name_key, start_weight, goal_weight, current_weight, actual_loss
FROM full_rows
QUALIFY row_number() OVER (PARTITION BY name_key ORDER BY plan_type DESC, patient_name DESC, patient_id DESC) = 1
""")
piece("sheet_by_name", """
SELECT lower(trim(name)) AS name_key, * EXCLUDE (name, row_no) FROM sheet
WHERE trim(name) <> ''
QUALIFY row_number() OVER (PARTITION BY lower(trim(name)) ORDER BY row_no DESC) = 1
""")
DATE_FORMATS = "['%Y-%m-%d', '%d-%m-%Y', '%d/%m/%Y', '%m/%d/%Y', '%d %b %Y', '%d %B %Y', '%Y/%m/%d']"
piece("annotated_rows", f"""
SELECT u.* REPLACE (
         CASE WHEN u.user_onboarded = 'No' AND s.not_onboarding_reason > ''
              THEN s.not_onboarding_reason ELSE u.user_onboarded END AS user_onboarded,
         CASE WHEN u.meal_log = 'No' AND s.meal_logging_reason > ''
              THEN s.meal_logging_reason ELSE u.meal_log END AS meal_log,
         CASE WHEN u.weight_log = 'No' AND s.weight_logging_reason > ''
              THEN s.weight_logging_reason ELSE u.weight_log END AS weight_log,
         CASE WHEN coalesce(a.start_weight - a.goal_weight, 0) <= 0
                OR try_strptime(trim(s.glp_1st_dose), {DATE_FORMATS}) IS NULL
                OR coalesce(a.start_weight - a.current_weight, a.actual_loss) IS NULL THEN 'Data Incomplete'
              WHEN coalesce(a.start_weight - a.current_weight, a.actual_loss)
                   >= (a.start_weight - a.goal_weight) / 90.0
                      * greatest({TODAY} - try_strptime(trim(s.glp_1st_dose), {DATE_FORMATS})::DATE, 0)
              THEN 'On Track' ELSE 'Off Track' END AS track),
       concat('{{', concat_ws(',',
         CASE WHEN u.user_onboarded = 'No' AND s.not_onboarding_reason > ''
              THEN '"User Onboarded":"cell-blue cell-blue-text"' END,
         CASE WHEN u.meal_log = 'No' AND s.meal_logging_reason > ''
              THEN '"Meal Log (3 days)":"cell-blue cell-blue-text"' END,
         CASE WHEN u.weight_log = 'No' AND s.weight_logging_reason > ''
              THEN '"Weight Log (7 days)":"cell-blue cell-blue-text"' END), '}}') AS cell_classes
FROM user_rows u
LEFT JOIN by_name a ON a.name_key = lower(trim(u.patient_name))
LEFT JOIN sheet_by_name s ON s.name_key = lower(trim(u.patient_name))
""")
piece("final_summary", """
SELECT d.sort_order, d.metric,
  CASE d.sort_order
    WHEN 3 THEN (SELECT count(*) FILTER (track = 'On Track') FROM annotated_rows WHERE cohort = 'Coach+App')::VARCHAR
    WHEN 4 THEN (SELECT count(*) FILTER (track <> 'On Track') FROM annotated_rows WHERE cohort = 'Coach+App')::VARCHAR
    ELSE d.coach_app END AS coach_app,
  CASE d.sort_order
    WHEN 3 THEN (SELECT count(*) FILTER (track = 'On Track') FROM annotated_rows WHERE cohort = 'GLP')::VARCHAR
    WHEN 4 THEN (SELECT count(*) FILTER (track <> 'On Track') FROM annotated_rows WHERE cohort = 'GLP')::VARCHAR
    ELSE d.glp END AS glp
FROM delta d
""")


def action_labels(users: str) -> str:
    who = "coalesce(consultant_name, 'Unknown Consultant')"
    return f"""
  SELECT {who} AS consultant, 1 AS action_order, 'User Not Onboarded' AS action, patient_name AS label, patient_id
  FROM {users} WHERE lower(user_onboarded) = 'no'
  UNION ALL SELECT {who}, 2, 'Meal Logging', patient_name, patient_id FROM {users} WHERE lower(meal_log) = 'no'
  UNION ALL SELECT {who}, 3, 'Weight Logging', patient_name, patient_id FROM {users} WHERE lower(weight_log) = 'no'
  UNION ALL SELECT {who}, 4, 'No Interaction (2+ days)', format('{{}} ({{}} days)', patient_name, days_since_contact), patient_id
  FROM {users} WHERE days_since_contact >= 2"""


def action_rows(users: str) -> str:
    return f"""
SELECT consultant, action_order, action, string_agg(label, ', ' ORDER BY label) AS patients
FROM ({action_labels(users)}) GROUP BY consultant, action_order, action"""


piece("action_list", action_labels("annotated_rows"))
piece("action_texts", action_rows("annotated_rows"))

piece("log_flags", """
SELECT patient_id, d AS check_date, bool_or(k = 'food') AS food, bool_or(k = 'habit') AS habit,
       bool_or(k = 'activity') AS activity
FROM (SELECT patient_id, date::DATE AS d, 'food' AS k FROM patientfoodlogs
      UNION ALL SELECT patient_id, date::DATE, 'habit' FROM patienthabitlogs
      UNION ALL SELECT patient_id, date::DATE, 'activity' FROM activity)
WHERE d IS NOT NULL GROUP BY ALL
""")
piece("spine_days", "SELECT unnest(generate_series(DATE '2023-12-31', DATE '2024-01-30', INTERVAL 1 DAY))::DATE AS day")
piece("spine_flags", """
SELECT p.id AS patient_id, s.day AS check_date,
       EXISTS (SELECT 1 FROM log_flags l WHERE l.patient_id = p.id AND l.check_date = s.day AND l.food) AS food,
       EXISTS (SELECT 1 FROM log_flags l WHERE l.patient_id = p.id AND l.check_date = s.day AND l.habit) AS habit,
       EXISTS (SELECT 1 FROM log_flags l WHERE l.patient_id = p.id AND l.check_date = s.day AND l.activity) AS activity
FROM patients p CROSS JOIN spine_days s
""")
# A streak is the distance from yesterday back to the latest day without food or activity.
piece("both_days", """
SELECT patient_id, check_date FROM log_flags
WHERE food AND activity AND check_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-30'
""")
piece("streaks", """
SELECT p.patient_id,
       (DATE '2024-01-30' - coalesce((SELECT max(s.day) FROM spine_days s
          WHERE s.day >= DATE '2024-01-05'
            AND NOT EXISTS (SELECT 1 FROM both_days b WHERE b.patient_id = p.patient_id AND b.check_date = s.day)),
        DATE '2024-01-04'))::BIGINT AS streak
FROM (SELECT DISTINCT patient_id FROM both_days WHERE check_date = DATE '2024-01-30') p
""")
piece("team", """
SELECT id AS patient_id, coalesce(firstname, '') || ' ' || coalesce(lastname, '') AS name
FROM patients
WHERE phone IS NOT NULL
  AND lower(trim(coalesce(firstname, '') || ' ' || coalesce(lastname, '')))
      NOT IN ('customer#000000008  household', 'customer#000000020  building')
""")
piece("team_rows", """
SELECT t.patient_id, t.name,
       coalesce(l.food, FALSE) AS food, coalesce(l.habit, FALSE) AS habit, coalesce(l.activity, FALSE) AS activity,
       coalesce(s.streak, 0) AS streak,
       CASE WHEN EXISTS (SELECT 1 FROM metrics m WHERE m.patient_id = t.patient_id AND m.name = 'BODY_WEIGHT'
                         AND m.date::DATE BETWEEN DATE '2024-01-24' AND DATE '2024-01-30')
            THEN 'Yes' ELSE 'No' END AS weight_log
FROM team t
LEFT JOIN log_flags l ON l.patient_id = t.patient_id AND l.check_date = DATE '2024-01-30'
LEFT JOIN streaks s ON s.patient_id = t.patient_id
""")
MISSING = """CASE WHEN food AND habit AND activity THEN 'Active' ELSE concat_ws(', ',
  CASE WHEN food THEN NULL ELSE 'Missing Meal Log' END,
  CASE WHEN habit THEN NULL ELSE 'Missing Habit Log' END,
  CASE WHEN activity THEN NULL ELSE 'Missing Steps/Activity Data' END) END"""
STRICT = "CASE WHEN food AND habit AND activity THEN 'Yes' ELSE 'No' END"

KEY = """(CASE
   WHEN regexp_matches({p}, '^\\+91') THEN right(regexp_replace(substr({p}, 4), '[^0-9]', '', 'g'), 10)
   WHEN regexp_matches({p}, '^91') AND length({p}) > 10
     THEN right(regexp_replace(substr({p}, 3), '[^0-9]', '', 'g'), 10)
   ELSE right(regexp_replace({p}, '[^0-9]', '', 'g'), 10) END)"""


def phone_key(column: str) -> str:
    return KEY.format(p=f"regexp_replace(trim(coalesce({column}, '')), '[ ()-]', '', 'g')")


WINDOW = "created_at >= TIMESTAMP '2024-01-30 05:30:00' AND created_at < TIMESTAMP '2024-01-31 05:30:00'"
piece("fresh", f"""
SELECT id, phone, email, created_at + INTERVAL 330 MINUTE AS created_at_ist,
       trim(concat_ws(' ', coalesce(firstname, ''), nullif(middlename, ''), nullif(lastname, ''))) AS patient_name,
       {phone_key('phone')} AS phone_key,
       regexp_replace(coalesce(phone, ''), '[^0-9]', '', 'g') AS phone_number
FROM patients WHERE {WINDOW}
""")
piece("customers", """
SELECT p.* FROM patients p WHERE p.is_active AND p.status = 'ACTIVE_SUBSCRIPTION'
  AND EXISTS (SELECT 1 FROM subscriptions s WHERE s.id = p.active_subscription_id)
""")
piece("customer_keys", f"SELECT DISTINCT {phone_key('phone')} AS k FROM customers WHERE {phone_key('phone')} <> ''")
REASON = "CASE WHEN length(phone_number) < 10 THEN 'Invalid phone number' END"
piece("synced", f"""
SELECT id, phone, patient_name, created_at_ist, email, phone_number, {REASON} AS reject_reason, phone_key,
  CASE WHEN phone_key IN (SELECT k FROM customer_keys) THEN 'filtered'
       WHEN length(phone_number) < 10 THEN 'rejected'
       WHEN phone_key IN (SELECT phone_key FROM existing_leads)
         OR row_number() OVER (PARTITION BY phone_key, length(phone_number) < 10 ORDER BY created_at_ist, id) > 1
       THEN 'exists' ELSE 'inserted' END AS outcome
FROM fresh
""")
NOTE_HEAD = "Auto-synced from member app on 2024-01-31 06:00:00"
SIGNED_AT = "strftime(created_at_ist, '%Y-%m-%dT%H:%M:%S')"
EMAIL = "CASE WHEN lower(trim(email)) NOT IN ('', 'null') THEN trim(email) END"

# --- scans, sources, sinks ----------------------------------------------------

oracle("scan_role", "SELECT * FROM patients")
oracle("sheet_source", "SELECT * FROM sheet")
oracle("append_sink", """
SELECT f.* FROM range(2) CROSS JOIN (
SELECT id::VARCHAR AS id, coalesce(phone, '') AS phone, patient_name, created_at_ist::VARCHAR AS created_at_ist,
       coalesce(email, '') AS email, to_json({'phone': phone, 'email': email})::VARCHAR AS contact
FROM fresh) f""")
oracle("lead_upsert", """
SELECT f.id, f.phone_key,
  CASE WHEN e.phone_key IS NULL
        AND f.id = first_value(f.id) OVER (PARTITION BY f.phone_key ORDER BY f.created_at_ist, f.id)
       THEN 'inserted' ELSE 'exists' END AS outcome
FROM fresh f LEFT JOIN (SELECT DISTINCT phone_key FROM existing_leads) e ON e.phone_key = f.phone_key
WHERE length(f.phone_number) >= 10""")
oracle("select_star", "SELECT * FROM assistant")
oracle("drop_columns", "SELECT id, phone, status FROM patients")

# --- filters ------------------------------------------------------------------

oracle("active_cohort", "SELECT patient_id AS id, cohort, plan_name, nutritionist_id FROM running")
oracle("started_by", f"""
SELECT patient_id AS id, cohort, sd AS subscription_start_date FROM running WHERE {YESTERDAY} - sd >= 0""")
oracle("in_list", """
SELECT id, nutritionist_id FROM patients
WHERE nutritionist_id = 2 OR nutritionist_id = 4 OR nutritionist_id = 6""")
oracle("not_in_normalised", """
SELECT p.id, s.name AS plan_name FROM patients p JOIN subscriptions s ON s.id = p.active_subscription_id
WHERE s.name NOT IN ('NATION_3', 'NATION_7')""")
oracle("non_blank", "SELECT id, firstname FROM patients WHERE length(replace(firstname, ' ', '')) > 0")
oracle("on_day", f"SELECT id, created_at FROM assistant WHERE created_at::DATE = {YESTERDAY}")
oracle("tz_day_window", f"""
SELECT id, 'literal' AS mode, created_at FROM patients WHERE {WINDOW}
UNION ALL
SELECT id, 'local_day', created_at FROM patients
WHERE (created_at + INTERVAL 330 MINUTE)::DATE = {YESTERDAY}""")


def lookback_sql(day: str, cut: str) -> str:
    return f"""
SELECT 'meal' AS source, patient_id, date FROM patientfoodlogs WHERE date::DATE >= {day} - 3 {cut}
UNION ALL
SELECT 'weight', patient_id, date FROM metrics
WHERE name = 'BODY_WEIGHT' AND date::DATE >= {day} - 7 {cut}"""


oracle("lookback_open", lookback_sql(TODAY, ""))
oracle("lookback_bounded", lookback_sql(YESTERDAY, BEFORE_TODAY))
oracle("between_days", f"""
SELECT patient_id, event_id, date::DATE AS day FROM metrics
WHERE name = 'BODY_WEIGHT' AND date::DATE BETWEEN {YESTERDAY} - 6 AND {YESTERDAY}""")
oracle("as_of_cutoff", f"SELECT * FROM messages WHERE messaged_at::DATE < {TODAY}")
oracle("equality_filters", """
SELECT 'body_fat' AS source, patient_id, date::DATE AS day FROM metrics WHERE name = 'BODY_FAT'
UNION ALL SELECT 'appointment', patient_id, date::DATE FROM appointment WHERE status = 'COMPLETED'
UNION ALL SELECT 'side_effect', patient_id, date::DATE FROM patientsideeffects WHERE creator = 'PATIENT'""")
oracle("side_effect_filter", "SELECT patient_id, type, date FROM effects")
oracle("valid_lead_split", f"SELECT id, phone, phone_number, {REASON} AS reject_reason FROM fresh")
oracle("row_number_eq_1", "SELECT patient_id, event_id, value FROM weighed WHERE place = 1")

# --- joins --------------------------------------------------------------------

oracle("join_subscription", """
SELECT p.id, p.active_subscription_id, s.name AS plan_name, s.type AS plan_type
FROM patients p, subscriptions s WHERE p.active_subscription_id = s.id""")
oracle("join_consultant", """
SELECT id, nutritionist_id, (SELECT c.name FROM consultants c WHERE c.id = nutritionist_id) AS consultant_name
FROM patients""")
oracle("chat_message_join", """
SELECT m.chat_id, m.sender, k.patient_id, m.messaged_at FROM messages m
JOIN chats k ON k.id = m.chat_id WHERE m.sender = k.consultant_id""")
oracle("exists_flag", """
SELECT p.id AS patient_id,
       EXISTS (SELECT 1 FROM metrics m WHERE m.patient_id = p.id AND m.name = 'BODY_FAT') AS has_fat,
       EXISTS (SELECT 1 FROM patientfoodlogs f WHERE f.patient_id = p.id) AS has_food
FROM patients p""")
oracle("exists_by_day", "SELECT * FROM spine_flags")
oracle("cross_join_lateral", "SELECT p.id AS patient_id, s.day AS check_date FROM patients p CROSS JOIN spine_days s")
oracle("feature_left_joins", f"""
SELECT r.patient_id, r.cohort,
       (SELECT max(d) FROM contact_log k WHERE k.patient_id = r.patient_id AND k.named) AS last_contact,
       (SELECT max(f.date)::DATE FROM patientfoodlogs f WHERE f.patient_id = r.patient_id) AS last_meal_day,
       (SELECT max(w.date)::DATE FROM weighed w WHERE w.patient_id = r.patient_id) AS last_weight_day,
       (SELECT cw FROM now_weight x WHERE x.patient_id = r.patient_id) AS current_weight,
       nullif((SELECT count(DISTINCT d) FROM any_log a WHERE a.patient_id = r.patient_id AND d >= {TODAY} - 7), 0)
         AS active_days
FROM running r""")
oracle("status_inner_join", f"""
SELECT t.patient_id, t.name, {YESTERDAY} AS check_date, t.food, t.habit, t.activity FROM team_rows t""")
# The island form: number the active days, join yesterday's island back, count it.
oracle("island_self_join", f"""
, numbered AS (
  SELECT patient_id, check_date,
         check_date - CAST(row_number() OVER (PARTITION BY patient_id ORDER BY check_date) AS INTEGER) AS island
  FROM both_days)
SELECT a.patient_id, count(*) AS streak
FROM numbered a JOIN numbered y ON y.patient_id = a.patient_id AND y.island = a.island
WHERE y.check_date = {YESTERDAY} GROUP BY a.patient_id""")
oracle("active_customer_anti_join", """
SELECT id, phone, phone_key FROM fresh f
WHERE NOT EXISTS (SELECT 1 FROM customer_keys c WHERE c.k = f.phone_key)""")
oracle("sheet_lookup_join", """
SELECT p.id,
       CASE WHEN s.row_no % 7 = 0 THEN 'Entered twice' ELSE s.not_onboarding_reason END AS not_onboarding_reason,
       s.glp_1st_dose, s.meal_logging_reason
FROM patients p LEFT JOIN sheet s ON trim(s.name) <> '' AND lower(trim(s.name)) = lower(trim(p.firstname))""")
oracle("analytics_lookup_join", """
SELECT r.patient_id, trim(r.firstname) AS user_name, a.start_weight, a.goal_weight, a.current_weight, a.actual_loss
FROM running r LEFT JOIN by_name a ON a.name_key = lower(trim(r.firstname))""")
oracle("scalar_subquery", f"""
SELECT (SELECT count(*) FROM running WHERE cohort = 'Coach+App') AS coach_today,
       (SELECT count(*) FROM running WHERE cohort = 'Coach+App' AND sd <= {YESTERDAY}) AS coach_yesterday,
       (SELECT count(*) FROM running WHERE cohort = 'GLP') AS glp_today,
       (SELECT count(*) FROM running WHERE cohort = 'GLP' AND sd <= {YESTERDAY}) AS glp_yesterday""")

# --- aggregations -------------------------------------------------------------

oracle("last_date", """
SELECT patient_id, max(d) FILTER (src = 'contact') AS last_contact, max(d) FILTER (kind = 'visit') AS last_visit_day,
       max(d) FILTER (kind = 'message') AS last_message_day, max(d) FILTER (src = 'food') AS last_meal_day,
       max(d) FILTER (src = 'metric' AND kind = 'BODY_WEIGHT') AS last_weight_day,
       max(d) FILTER (src IN ('food', 'metric', 'activity')) AS last_active_day
FROM (SELECT patient_id, CASE WHEN named THEN 'contact' END AS src, kind, d FROM contact_log
      UNION ALL SELECT patient_id, 'food', NULL, date::DATE FROM patientfoodlogs
      UNION ALL SELECT patient_id, 'metric', name, date::DATE FROM metrics
      UNION ALL SELECT patient_id, 'activity', NULL, date::DATE FROM activity)
GROUP BY patient_id""")
oracle("days_since_last", f"""
SELECT patient_id, CAST({TODAY} - max(d) FILTER (named) AS INTEGER) AS days_today,
       CAST({YESTERDAY} - max(d) FILTER (named AND d < {TODAY}) AS INTEGER) AS days_named,
       CAST({YESTERDAY} - max(d) FILTER (d < {TODAY}) AS INTEGER) AS days_any
FROM contact_log GROUP BY patient_id""")
oracle("presence_group", f"""
SELECT patient_id, 'Yes' AS logged, 'meal' AS source FROM patientfoodlogs
GROUP BY patient_id HAVING max(date::DATE) >= {TODAY} - 3
UNION ALL
SELECT patient_id, 'Yes', 'weight' FROM metrics WHERE name = 'BODY_WEIGHT'
GROUP BY patient_id HAVING max(date::DATE) >= {TODAY} - 7""")
oracle("count_gt_zero", f"""
SELECT DISTINCT patient_id, TRUE AS weight_logged FROM metrics
WHERE name = 'BODY_WEIGHT' AND date::DATE BETWEEN {YESTERDAY} - 6 AND {YESTERDAY}""")
oracle("string_agg", "SELECT patient_id, string_agg(type, ', ' ORDER BY type) AS side_effects FROM effects GROUP BY 1")
oracle("count_distinct_case", f"""
SELECT patient_id, count(DISTINCT d) AS active_days FROM any_log WHERE d >= {TODAY} - 7 GROUP BY patient_id""")
oracle("count_filter", """
SELECT cohort, count(*) AS n_users, count(*) FILTER (onb = 'No') AS n_not_onboarded,
       count(*) FILTER (st = 'On Track') AS n_on_track, count(*) FILTER (st = 'Off Track') AS n_off_track,
       count(*) FILTER (idle > 2 OR idle IS NULL) AS n_no_contact, count(*) FILTER (meal = 'No') AS n_no_meal,
       count(*) FILTER (wlog = 'No') AS n_no_weight
FROM state_today GROUP BY cohort""")
oracle("summary_matrix", "SELECT * FROM matrix")
oracle("summary_delta", "SELECT * FROM delta")
oracle("track_recount", "SELECT * FROM final_summary")
oracle("count_star", """
SELECT 'food' AS source, patient_id, count(*) AS n_rows FROM patientfoodlogs GROUP BY ALL
UNION ALL SELECT 'habit', patient_id, count(*) FROM patienthabitlogs GROUP BY ALL
UNION ALL SELECT 'activity', patient_id, count(*) FROM activity GROUP BY ALL""")
oracle("distinct_phones", "SELECT k AS phone_key FROM customer_keys")
oracle("sync_stats", """
SELECT count(*) AS total_fetched, count(*) FILTER (outcome = 'filtered') AS active_customers_filtered,
       count(*) FILTER (outcome = 'inserted') AS total_ingested, count(*) FILTER (outcome = 'exists') AS already_exists,
       count(*) FILTER (outcome = 'rejected') AS failed,
       count(*) FILTER (outcome = 'rejected') = 0
         AND (count(*) FILTER (outcome IN ('inserted', 'exists')) > 0 OR count(*) = 0) AS success
FROM synced""")
oracle("consultant_actions", action_rows("user_rows"))

# --- windows ------------------------------------------------------------------

oracle("latest_weight", "SELECT patient_id, cw AS current_weight FROM now_weight")
oracle("latest_weight_as_of", f"""
SELECT m.patient_id, round(m.value::DECIMAL(38,12), 2)::DOUBLE AS current_weight FROM metrics m
WHERE m.name = 'BODY_WEIGHT' AND m.date::DATE < {YESTERDAY}
  AND NOT EXISTS (SELECT 1 FROM metrics n WHERE n.patient_id = m.patient_id AND n.name = 'BODY_WEIGHT'
                  AND n.date::DATE < {YESTERDAY}
                  AND (n.date, n.created_at, n.event_id) > (m.date, m.created_at, m.event_id))""")
oracle("latest_in_window", f"""
SELECT patient_id, 'Yes' AS logged_in_last_7_days FROM metrics
WHERE name = 'BODY_WEIGHT' AND date::DATE >= {TODAY} - 7
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY date DESC, created_at DESC) = 1""")
oracle("latest_note", """
SELECT patient_id, date AS last_note_date, description AS last_note FROM noted WHERE place = 1""")
oracle("gaps_islands", """
SELECT patient_id, check_date, food AND activity AS is_active,
       check_date - CAST(row_number() OVER (PARTITION BY patient_id, food AND activity ORDER BY check_date) AS INTEGER)
         AS island
FROM spine_flags""")
oracle("current_streak", """
SELECT p.id AS patient_id, coalesce(s.streak, 0) AS streak FROM patients p LEFT JOIN streaks s ON s.patient_id = p.id""")

# --- sorts --------------------------------------------------------------------

oracle("sort_hidden_key", "SELECT metric, coach_app, glp FROM delta ORDER BY sort_order")
oracle("sort_two_keys", """
SELECT plan_type AS cohort, patient_name, start_weight, current_weight FROM full_rows ORDER BY 1, 2""")
oracle("sort_name", "SELECT patient_id, name FROM team ORDER BY name NULLS LAST")
oracle("sort_in_group", """
SELECT nutritionist_id, string_agg(trim(firstname), ', ' ORDER BY trim(firstname)) AS patients
FROM running GROUP BY nutritionist_id ORDER BY nutritionist_id""")

# --- set operations and generators --------------------------------------------

oracle("interaction_union_all", "SELECT patient_id, d AS interaction_date FROM contact_log WHERE named")
oracle("activity_union_distinct", "SELECT DISTINCT patient_id, d AS activity_date FROM any_log")
oracle("cohort_union_all", """
SELECT patient_id AS id, cohort FROM running WHERE cohort = 'Coach+App'
UNION ALL SELECT patient_id, cohort FROM running WHERE cohort = 'GLP'""")
oracle("metric_rows_union", """
SELECT sort_order, metric, 'coach_today' AS cell, coach_today AS n FROM matrix
UNION ALL SELECT sort_order, metric, 'coach_yesterday', coach_yesterday FROM matrix
UNION ALL SELECT sort_order, metric, 'glp_today', glp_today FROM matrix
UNION ALL SELECT sort_order, metric, 'glp_yesterday', glp_yesterday FROM matrix""")
oracle("detail_concat", "SELECT patient_id, cohort, patient_name, consultant_name FROM user_rows")
oracle("date_spine", """
SELECT s.day AS check_date, (SELECT count(*) FROM activity a WHERE a.date::DATE = s.day) AS n_rows FROM spine_days s""")

# --- scalar functions ---------------------------------------------------------

DAYS = f"CAST({TODAY} - subscription_start_date AS INTEGER)"
oracle("day_diff", f"SELECT id, {DAYS} AS days FROM patients")
oracle("greatest_dates", f"""
SELECT id,
  greatest(CASE WHEN start_weight IS NOT NULL THEN created_at::DATE END,
           CASE WHEN is_active THEN subscription_start_date END) AS latest,
  CASE WHEN {DAYS} > 15 THEN {DAYS} - 15 ELSE 0 END AS days_from_15,
  CASE WHEN subscription_start_date < {TODAY} - 10 THEN subscription_start_date ELSE {TODAY} - 10 END AS earliest
FROM patients""")
oracle("safe_divide", """
SELECT id, CASE WHEN target_duration <> 0 THEN (start_weight - goal_weight) / target_duration END AS per_day
FROM patients""")
oracle("round2", "SELECT event_id, round(value::DECIMAL(38,12), 2)::DOUBLE AS value FROM metrics")
oracle("track_status_sql", """
SELECT t.patient_id, t.cohort, t.st AS track, y.st AS track_prev
FROM state_today t JOIN state_prev y ON y.patient_id = t.patient_id""")
oracle("onboarded_flag", """
SELECT t.patient_id, t.onb AS user_onboarded, y.onb AS user_onboarded_prev
FROM state_today t JOIN state_prev y ON y.patient_id = t.patient_id""")
oracle("expected_actual_loss", "SELECT patient_id, expected_loss, actual_loss FROM full_rows")
oracle("yes_no", """
SELECT id, CASE WHEN coalesce(start_weight, 0) > 90 THEN 'Yes' ELSE 'No' END AS heavy,
       ifnull(middlename, 'None') AS middle, ifnull(target_duration, 0) AS duration FROM patients""")
oracle("full_name", """
SELECT id, trim(concat_ws(' ', coalesce(firstname, ''), nullif(middlename, ''), nullif(lastname, ''))) AS full_name,
       coalesce(firstname, '') || ' ' || coalesce(lastname, '') AS short_name FROM patients""")
oracle("inactivity_reason", f"SELECT patient_id, {MISSING} AS reason FROM team_rows")
oracle("active_definitions", """
SELECT patient_id, check_date, food AND habit AND activity AS strict, food AND activity AS streak_active
FROM log_flags WHERE check_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-30'""")
oracle("signed_text", f"SELECT id, printf('%+d', {DAYS} - 15) AS change FROM patients")
oracle("ist_shift", "SELECT id, created_at + INTERVAL 330 MINUTE AS created_at_ist FROM patients")
oracle("normalize_phone", f"SELECT id, {phone_key('phone')} AS phone_key FROM patients")
oracle("digits_only", "SELECT id, array_to_string(regexp_extract_all(coalesce(phone, ''), '[0-9]'), '') AS phone_number FROM patients")
oracle("blank_to_null", f"SELECT id, {EMAIL} AS email, nullif(trim(firstname), '') AS firstname FROM patients")
oracle("lead_record", f"""
SELECT id, phone_number, nullif(trim(patient_name), '') AS name, {EMAIL} AS email, 'App Signup' AS source,
       'Daily Sync' AS sub_source, 'New' AS status,
       concat('{NOTE_HEAD}', chr(10), 'Original signup time: ', {SIGNED_AT}) AS notes,
       concat('{{', concat_ws(',', '"phone_number":"' || phone_number || '"',
         '"name":"' || nullif(trim(patient_name), '') || '"', '"email":"' || {EMAIL} || '"',
         '"source":"App Signup","sub_source":"Daily Sync","status":"New"',
         '"notes":"{NOTE_HEAD}\\nOriginal signup time: ' || {SIGNED_AT} || '"'), '}}') AS lead
FROM fresh WHERE length(phone_number) >= 10""")
oracle("normalize_name", "SELECT row_no, nullif(lower(trim(name)), '') AS name_key FROM sheet")
oracle("column_ci", """
SELECT row_no, name AS "patient name", glp_1st_dose AS "glp 1st dose", meal_logging_reason AS "meal logging reason"
FROM sheet""")
oracle("parse_float", """
SELECT id, CASE id % 6 WHEN 0 THEN start_weight WHEN 1 THEN start_weight * 10 WHEN 5 THEN -start_weight END AS number
FROM patients""")
oracle("parse_date_multi", f"""
SELECT row_no, try_strptime(trim(glp_1st_dose), {DATE_FORMATS})::DATE AS dose_day FROM sheet""")
oracle("progress_status", "SELECT patient_id, track FROM annotated_rows")
oracle("reason_override", "SELECT patient_id, user_onboarded, meal_log, weight_log FROM annotated_rows")
piece("format_cells", """
SELECT patient_id, 'User Onboarded' AS column_name, 'bg-red' AS cell_class FROM full_rows WHERE user_onboarded = 'No'
UNION ALL SELECT patient_id, 'Goals Set', 'bg-yellow' FROM full_rows WHERE goals_set = 'No'
UNION ALL SELECT patient_id, 'Smart Scale Logged', 'bg-yellow' FROM full_rows WHERE scale_logged = 'No'
UNION ALL SELECT patient_id, 'Meal Logged', 'bg-yellow' FROM full_rows WHERE meal_logged = 'No'
UNION ALL SELECT patient_id, 'Meal Log (3 days)', 'bg-yellow' FROM full_rows WHERE meal_log = 'No'
UNION ALL SELECT patient_id, 'Weight Log (7 days)', 'bg-yellow' FROM full_rows WHERE weight_log = 'No'
UNION ALL SELECT patient_id, 'Days Since Last Interaction',
  CASE WHEN days_since_contact < 5 THEN 'bg-yellow' ELSE 'bg-red' END FROM full_rows WHERE days_since_contact >= 2
UNION ALL SELECT patient_id, 'Current Weight Lose', 'bg-red' FROM full_rows WHERE actual_loss < 0
""")
oracle("format_rules", "SELECT * FROM format_cells")
oracle("json_cell", """
SELECT id, to_json({'phone': phone, 'plan': active_subscription_id})::VARCHAR AS contact,
       to_json([middlename, status])::VARCHAR AS words, coalesce(email, '') AS email,
       target_duration::VARCHAR AS duration FROM patients""")
oracle("days_label", """
SELECT patient_id, CASE WHEN days_since_contact >= 2
       THEN format('{} ({} days)', patient_name, days_since_contact) END AS label FROM user_rows""")
oracle("trim_alias", 'SELECT id, trim(firstname) AS "Patient Name" FROM patients')

# --- reports ------------------------------------------------------------------

SUMMARY_COLUMNS = 'metric AS "Metric", coach_app AS "Coach + App (vs Yesterday)", glp AS "GLP (vs Yesterday)"'
USER_COLUMNS = """
patient_name AS "Patient Name", consultant_id AS "Consultant ID", consultant_name AS "Consultant Name",
plan_name AS "Subscription Name", user_onboarded AS "User Onboarded", track AS "OnTrack/OffTrack",
days_since_contact AS "Days Since Last Interaction", side_effects AS "Recent Severe Side Effects",
meal_log AS "Meal Log (3 days)", weight_log AS "Weight Log (7 days)",
active_days AS "Num Active days (in last 7 days)", last_active_day AS "Last Active Day" """
oracle("summary_comparison", f"SELECT {SUMMARY_COLUMNS} FROM delta ORDER BY sort_order")
oracle("coach_app_users", f"SELECT {USER_COLUMNS} FROM user_rows WHERE cohort = 'Coach+App'")
oracle("glp_users", f"SELECT {USER_COLUMNS} FROM user_rows WHERE cohort = 'GLP'")
FULL_COLUMNS = """
patient_name AS "Patient Name", plan_type AS "Subscription Type", goals_set AS "Goals Set",
       scale_logged AS "Smart Scale Logged", meal_logged AS "Meal Logged", user_onboarded AS "User Onboarded",
       start_date AS "Subscription Start Date", days_since_start AS "Days since Subscription Start",
       start_weight AS "Start Weight", goal_weight AS "Goal Weight", current_weight AS "Current Weight",
       expected_loss AS "On Track Weight Lose", actual_loss AS "Current Weight Lose",
       last_note_date AS "Last Note Added Date", last_note AS "Last Note",
       days_since_contact AS "Days Since Last Interaction", last_meal_day AS "Last Meal Log Date",
       last_weight_day AS "Last Weight Log Date", meal_log AS "Meal Log (3 days)",
       weight_log AS "Weight Log (7 days)", active_days AS "Num Active days (in last 7 days)",
       last_active_day AS "Last Active Day" """
oracle("full_analytics", f"SELECT {FULL_COLUMNS} FROM full_rows ORDER BY plan_type, patient_name")
STREAK_COLUMNS = f"""name AS "name", {STRICT} AS "active yesterday", streak AS "Streak",
       weight_log AS "Weight Log (Last 7 Days)", {MISSING} AS "reason of inactivity yesterday" """
oracle("team_streaks", f"SELECT patient_id, {STREAK_COLUMNS} FROM team_rows")
oracle("contact_leads", f"SELECT * FROM assistant WHERE created_at::DATE = {YESTERDAY}")
oracle("new_signups", "SELECT phone, patient_name, created_at_ist, email FROM fresh")
oracle("active_customers", "SELECT phone FROM customers")
oracle("annotated_users", f'SELECT {USER_COLUMNS}, cell_classes AS "__cell_classes__" FROM annotated_rows')
oracle("summary_final", f"SELECT {SUMMARY_COLUMNS} FROM final_summary ORDER BY sort_order")
oracle("actions_required", """
SELECT consultant AS "Consultant", action AS "Action", patients AS "Patients Pending" FROM action_texts
ORDER BY consultant, action_order""")
oracle("lead_sync", "SELECT * FROM synced")
oracle("action_items", """
SELECT consultant AS "Consultant", action AS "Action", label AS "Patient Pending" FROM action_list
ORDER BY consultant, action_order, label""")

# Every heading: SELECT list and source.
ACTION_COLUMNS = 'consultant AS "Consultant", action AS "Action", label AS "Patient Pending"'
REPORTS = {
    "Summary Comparison": (SUMMARY_COLUMNS, "final_summary"),
    "Actions Required": (ACTION_COLUMNS, "action_list"),
    "Coach +App User analytics": (USER_COLUMNS, "annotated_rows WHERE cohort = 'Coach+App'"),
    "GLP User analytics": (USER_COLUMNS, "annotated_rows WHERE cohort = 'GLP'"),
    "Full Analytics": (FULL_COLUMNS, "full_rows"),
    "Contact-Me Form leads": (
        'id AS "id", user_id AS "user_id", message AS "message", created_at AS "created_at"',
        f"assistant WHERE created_at::DATE = {YESTERDAY}",
    ),
    "New Signups": ('phone AS "phone", patient_name AS "patient_name", created_at_ist AS "created_at_ist"', "fresh"),
    "Team Streaks": (STREAK_COLUMNS, "team_rows"),
}
UNSHOWN = ("Consultant ID", "Consultant Name", "Subscription Name")


def report_contents(unshown: tuple[str, ...] = ()) -> str:
    parts = []
    for n, (heading, (columns, source)) in enumerate(REPORTS.items(), start=1):
        names = [c for c in re.findall(r'AS "([^"]+)"', columns) if c not in unshown]
        cells = ", ".join(f"""coalesce("{c}"::VARCHAR, '~')""" for c in names)
        parts.append(f"""
SELECT {n} AS ordinal, '{heading}' AS heading, count(*) AS n_rows,
       coalesce(sum(('0x' || substr(md5(concat_ws('|', {cells})), 1, 8))::BIGINT), 0)::BIGINT AS content
FROM (SELECT {columns} FROM {source})""")
    return " UNION ALL ".join(parts)


oracle("report_registry", report_contents())
oracle("report_output", report_contents(UNSHOWN))
piece("user_cells", """
SELECT *, CASE cohort WHEN 'GLP' THEN 'GLP User analytics' ELSE 'Coach +App User analytics' END AS heading
FROM annotated_rows""")
piece("user_marks", """
SELECT heading, unnest(map_keys(m)) AS column_name, unnest(map_values(m)) AS cell_class
FROM (SELECT heading, CAST(CAST(cell_classes AS JSON) AS MAP(VARCHAR, VARCHAR)) AS m FROM user_cells)
UNION ALL SELECT heading, 'User Onboarded', 'bg-red' FROM user_cells WHERE lower(trim(user_onboarded)) = 'no'
UNION ALL SELECT heading, 'Meal Log (3 days)', 'bg-yellow' FROM user_cells WHERE lower(trim(meal_log)) = 'no'
UNION ALL SELECT heading, 'Weight Log (7 days)', 'bg-yellow' FROM user_cells WHERE lower(trim(weight_log)) = 'no'
UNION ALL SELECT heading, 'Days Since Last Interaction', CASE WHEN days_since_contact < 5 THEN 'bg-yellow' ELSE 'bg-red' END
FROM user_cells WHERE days_since_contact >= 2""")
oracle("published_cells", """
SELECT heading, column_name, cell_class, n_columns, count(*) AS n_cells FROM (
  SELECT *, 9 AS n_columns FROM user_marks
  UNION ALL SELECT 'Full Analytics', column_name, cell_class, 22 FROM format_cells)
GROUP BY ALL""")
