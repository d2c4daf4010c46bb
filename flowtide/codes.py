"""Codes, labels, names and thresholds used as parameter defaults.

Every function that uses one of these takes it as an argument, so another
helpdesk or tracker only passes its own tables.
"""

# Helpdesk status codes.
WAITING_CODES = (17,)
PASSED_CODES = (6, 7, 12)
STATUS_LABELS = {
    2: "Open",
    3: "Pending",
    4: "Resolved",
    5: "Closed",
    6: "Passed triage",
    7: "Passed triage",
    12: "Passed triage",
    17: "Waiting for triage",
}

# Wider status groups used by the snapshot-grain views.
STAGE_WAITING_CODES = (17, 6, 23)
STAGE_POST_CODES = (12, 7)
ESCALATED_CODES = (7,)

# Status dimension (code, name, description).
STATUS_DIMENSION = [
    (2, "Open", "Ticket is in progress"),
    (3, "Pending", "Awaiting your answer"),
    (4, "Resolved", "Ticket is resolved"),
    (5, "Closed", "This ticket is closed"),
    (6, "Available", "Ticket is waiting for technical support"),
    (7, "Escalation", "Ticket is escalated"),
    (8, "In progress", "Ticket is in progress"),
    (9, "In testing", "Ticket is in testing"),
    (10, "Information needed (internal)", "Ticket is waiting for internal info"),
    (12, "Investigate", "Ticket is waiting for technical support"),
    (14, "Ready for hotfix", "Ticket is ready for hotfix"),
    (16, "Task done", "Ticket is in progress"),
    (17, "New case", "Ticket is waiting for technical support"),
    (19, "Need sprint planning", "Ticket is under review for future changes"),
    (23, "Linked ticket awaiting SLS", "Ticket is waiting for technical support"),
    (24, "Customer responded", "Customer Responded"),
    (25, "Task in backlog", "Ticket is under review for future changes"),
    (26, "Uninstall", "Ticket is in progress"),
    (27, "Product feedback", "Product feedback"),
    (9000, "Assigned to AI Agent", "Assigned to AI Agent"),
]

# Group ids ending in these digits are left out of the ticket table.
EXCLUDED_GROUP_SUFFIXES = ("1939", "8846")

# Issues with this prefix in this team are left out of the issue table.
EXCLUDED_IDENTIFIER_PREFIX = "DEV"
EXCLUDED_TEAM = "Development"

INCIDENT_WORD = "incident"

# Issue states.
STATE_LABELS = {
    "backlog": "Backlog / Unstarted",
    "unstarted": "Backlog / Unstarted",
    "started": "In Progress",
    "completed": "Completed",
    "cancelled": "Cancelled",
}
STATE_SPELLINGS = {"canceled": "Cancelled"}
BACKLOG_STATES = ("backlog", "unstarted")
DONE_STATE = "Done"

# Issue priorities.
PRIORITY_LABELS = {
    0: "No priority",
    1: "Urgent",
    2: "High",
    3: "Medium",
    4: "Low",
}

# Lead-time buckets as (highest day count, label, sort key).
LEAD_TIME_SAME_DAY = ("Same day", 1)
LEAD_TIME_BUCKETS = [
    (7, "2–7 days", 2),
    (14, "8–14 days", 3),
    (30, "15–30 days", 4),
    (90, "31–90 days", 5),
]
LEAD_TIME_OVER = ("+90 days", 6)
LEAD_TIME_OPEN_SORT = 99

UNASSIGNED = "Unassigned"
OTHER = "Other"

# KPI category rules, first match wins
# (category, state types, words in the state name).
KPI_RULES = [
    ("Unassigned", ("unstarted", "available"), ("todo", "backlog")),
    ("Assigned", ("started",), ("in progress", "started")),
    ("WaitingForTeam", ("available", "backlog"), ("waiting", "backlog")),
    ("Done", ("completed", "canceled"), ("done", "completed", "canceled", "cancelled", "duplicate")),
]

WAIT_THRESHOLD_DAYS = 30
CLOSE_THRESHOLD_DAYS = 30
RETENTION_DAYS = 90

# Calendar names.
MONTH_NAMES = {
    "en": ["January", "February", "March", "April", "May", "June",
           "July", "August", "September", "October", "November", "December"],
    "sv": ["Januari", "Februari", "Mars", "April", "Maj", "Juni",
           "Juli", "Augusti", "September", "Oktober", "November", "December"],
}
DAY_NAMES = {
    "en": ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"],
    "sv": ["Måndag", "Tisdag", "Onsdag", "Torsdag", "Fredag", "Lördag", "Söndag"],
}

# Swedish public holidays.
# Moveable ones: (days after Easter Sunday, English name, Swedish name).
EASTER_HOLIDAYS = [
    (-2, "Good Friday", "Långfredagen"),
    (0, "Easter Sunday", "Påskdagen"),
    (1, "Easter Monday", "Annandag påsk"),
    (39, "Ascension Day", "Kristi himmelsfärd"),
    (49, "Whit Sunday", "Pingstdagen"),
]
# Same date every year: (month, day, English name, Swedish name).
FIXED_HOLIDAYS = [
    (1, 1, "New Year's Day", "Nyårsdagen"),
    (1, 6, "Epiphany", "Trettondagen"),
    (5, 1, "Labour Day", "Första maj"),
    (6, 6, "National Day", "Nationaldagen"),
    (12, 25, "Christmas Day", "Juldagen"),
    (12, 26, "Boxing Day", "Annandag jul"),
]
# First Saturday on or after a date: (month, day, English name, Swedish name).
SATURDAY_HOLIDAYS = [
    (6, 20, "Midsummer Day", "Midsommardagen"),
    (10, 31, "All Saints' Day", "Alla helgons dag"),
]

# Handling advice per inferred type in a column profile.
SUGGESTED_HANDLING = {
    "array": "flatten to ';' string; keep raw JSON",
    "boolean": "normalize to boolean",
    "json": "keep raw JSON; extract fields if needed",
    "numeric": "keep numeric",
    "string": "keep as string; nullable",
    "timestamp": "normalize to UTC ISO; nullable",
}
