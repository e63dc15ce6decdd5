"""Texts that results must carry or compare against.

Everything in this module is data the reports are defined by (status texts,
plan types, headings, date formats, cell classes).  Nothing here is logic.
"""

from __future__ import annotations

# --- Fixed values: membership -------------------------------------------------
COACH_APP = "Coach+App"
GLP = "GLP"
ACTIVE_STATUS = "ACTIVE_SUBSCRIPTION"
EXCLUDED_GLP_PLANS = (
    "metabolic diagnosis test",
    "metabolic screening",
    "pre glp assesment",
)

# --- Fixed values: facts ------------------------------------------------------
BODY_WEIGHT = "BODY_WEIGHT"
BODY_FAT = "BODY_FAT"
APPOINTMENT_DONE = "COMPLETED"
REPORTED_BY_PATIENT = "PATIENT"
MILD_SIDE_EFFECTS = ("good", "okay", "great")

# --- Fixed values: status texts -----------------------------------------------
YES = "Yes"
NO = "No"
NONE_TEXT = "None"
ON_TRACK = "On Track"
OFF_TRACK = "Off Track"
DATA_INCOMPLETE = "Data Incomplete"
GOAL_ACHIEVED = "Goal Achieved or Invalid"
ACTIVE_TEXT = "Active"
MISSING_MEAL = "Missing Meal Log"
MISSING_HABIT = "Missing Habit Log"
MISSING_ACTIVITY = "Missing Steps/Activity Data"
UNKNOWN_CONSULTANT = "Unknown Consultant"

# --- Fixed values: action names, in report order ------------------------------
ACTION_ONBOARDING = "User Not Onboarded"
ACTION_MEAL = "Meal Logging"
ACTION_WEIGHT = "Weight Logging"
ACTION_CONTACT = "No Interaction (2+ days)"

# --- Fixed values: summary metrics, in report order ---------------------------
METRIC_PAID = "Number of Paid Users"
METRIC_NOT_ONBOARDED = "Num Completely not onboarded"
METRIC_ON_TRACK = "Num On Track Users"
METRIC_OFF_TRACK = "Num Off Track Users"
METRIC_NO_CONTACT = "Num users with no interaction in last 2 days"
METRIC_NO_MEAL = "Num users with no meal log in last 3 days"
METRIC_NO_WEIGHT = "Num users with no weight log in last 7 days"

# --- Fixed values: display headings of the reports ----------------------------
SUMMARY_HEADINGS = {
    "metric": "Metric",
    "coach_app": "Coach + App (vs Yesterday)",
    "glp": "GLP (vs Yesterday)",
}
USER_HEADINGS = {
    "patient_name": "Patient Name",
    "consultant_id": "Consultant ID",
    "consultant_name": "Consultant Name",
    "plan_name": "Subscription Name",
    "user_onboarded": "User Onboarded",
    "track": "OnTrack/OffTrack",
    "days_since_contact": "Days Since Last Interaction",
    "side_effects": "Recent Severe Side Effects",
    "meal_log": "Meal Log (3 days)",
    "weight_log": "Weight Log (7 days)",
    "active_days": "Num Active days (in last 7 days)",
    "last_active_day": "Last Active Day",
}
FULL_HEADINGS = {
    "patient_name": "Patient Name",
    "plan_type": "Subscription Type",
    "goals_set": "Goals Set",
    "scale_logged": "Smart Scale Logged",
    "meal_logged": "Meal Logged",
    "user_onboarded": "User Onboarded",
    "start_date": "Subscription Start Date",
    "days_since_start": "Days since Subscription Start",
    "start_weight": "Start Weight",
    "goal_weight": "Goal Weight",
    "current_weight": "Current Weight",
    "expected_loss": "On Track Weight Lose",
    "actual_loss": "Current Weight Lose",
    "last_note_date": "Last Note Added Date",
    "last_note": "Last Note",
    "days_since_contact": "Days Since Last Interaction",
    "last_meal_day": "Last Meal Log Date",
    "last_weight_day": "Last Weight Log Date",
    "meal_log": "Meal Log (3 days)",
    "weight_log": "Weight Log (7 days)",
    "active_days": "Num Active days (in last 7 days)",
    "last_active_day": "Last Active Day",
}
STREAK_HEADINGS = {
    "name": "name",
    "active_yesterday": "active yesterday",
    "streak": "Streak",
    "weight_log": "Weight Log (Last 7 Days)",
    "reason": "reason of inactivity yesterday",
}
ACTION_HEADINGS = {
    "consultant": "Consultant",
    "action": "Action",
    "patients": "Patients Pending",
}
ACTION_ITEM_HEADINGS = {
    "consultant": "Consultant",
    "action": "Action",
    "label": "Patient Pending",
}
#: Columns that the published user tables leave out.
HIDDEN_USER_COLUMNS = ("Consultant ID", "Consultant Name", "Subscription Name")

# --- Fixed values: report titles ----------------------------------------------
TITLE_SUMMARY = "Summary Comparison"
TITLE_COACH = "Coach +App User analytics"
TITLE_GLP = "GLP User analytics"
TITLE_FULL = "Full Analytics"
TITLE_ACTIONS = "Actions Required"
TITLE_ACTION_TEXTS = "Actions Required (lists)"
TITLE_CONTACT_LEADS = "Contact-Me Form leads"
TITLE_SIGNUPS = "New Signups"
TITLE_STREAKS = "Team Streaks"

# --- Fixed values: sheet headers (matched after trimming and lower-casing) ----
SHEET_NAME_HEADERS = ("Patient Name", "patient name", "Name", "name")
SHEET_REASON_HEADERS = {
    "not_onboarding_reason": "Not onboarding reason",
    "glp_1st_dose": "Glp 1st dose",
    "meal_logging_reason": "Meal logging reason",
    "weight_logging_reason": "Weight logging reason",
}

# --- Fixed values: progress rule ----------------------------------------------
PROGRESS_TARGET_DAYS = 90.0

# --- Fixed values: cell classes -----------------------------------------------
CELL_REASON = "cell-blue cell-blue-text"
CELL_RED = "bg-red"
CELL_YELLOW = "bg-yellow"
CELL_ORANGE = "bg-orange"
COLOUR_RED = "#ff6666"
COLOUR_YELLOW = "#ffff00"
COLOUR_ORANGE = "#ff9900"

# --- Fixed values: lead records -----------------------------------------------
LEAD_SUB_SOURCE = "Daily Sync"
LEAD_STATUS = "New"
LEAD_NOTE = "Auto-synced from {system} on {time}\nOriginal signup time: "
MIN_PHONE_DIGITS = 10
REJECT_PHONE = "Invalid phone number"

# Everything Python's str.strip() removes.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
