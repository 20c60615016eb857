"""Fixed values.

Everything here is part of the data contract: event names, metric names and
their order, phrases, patterns and document texts that readers of the outputs
match on.  Nothing below is computed.
"""

# Event types kept by archive ingest.
ARCHIVE_EVENT_TYPES = (
    "PushEvent",
    "IssuesEvent",
    "PullRequestEvent",
    "CreateEvent",
    "ForkEvent",
)

# Event types counted by the panel keyed by organization login.
LOGIN_PANEL_EVENT_TYPES = (
    "PushEvent",
    "IssuesEvent",
    "PullRequestEvent",
    "CreateEvent",
    "ForkEvent",
    "WatchEvent",
    "ReleaseEvent",
)

# Metrics of the panel keyed by organization login.
LOGIN_PANEL_METRICS = (
    "public_events",
    "active_repositories",
    "distinct_actors",
    "push_events",
    "commits_in_pushes",
    "issues_opened",
    "pull_requests_opened",
    "repositories_created",
    "fork_events",
    "star_events",
    "release_events",
)

# Metrics of the panel keyed by target organization id.
TARGET_PANEL_METRICS = (
    "public_events",
    "active_repositories",
    "distinct_actors",
    "push_events",
    "commits_in_pushes",
    "issues_opened",
    "issues_closed",
    "issue_comments_created",
    "pull_requests_opened",
    "pull_requests_closed",
    "pull_requests_merged",
    "original_repositories_created",
    "forked_repositories_created",
    "forks_received",
    "stars_received",
    "releases_published",
)

# Monthly distinct counts, which must not be summed over a period.
NON_ADDITIVE_METRICS = ("active_repositories", "distinct_actors")

# Roles an event can have for an organization in the target panel.
ROLE_ACTIVITY = "repository_activity"
ROLE_FORK_DESTINATION = "fork_destination"

# Phrases of the keyword screen over name and description.
SCREEN_PHRASES = (
    "machine learning",
    "artificial intelligence",
    "natural language processing",
    "deep learning",
    "predictive api",
    "cognitive computing",
    "image recognition",
    "speech recognition",
)

# Provenance labels stored in the tables.
SOURCE_API = "github_api"
SOURCE_ARCHIVE = "gharchive"
SOURCE_PANEL = "gharchive_bigquery"
SOURCE_SETUP = "setup.py"
PRECISION_COMMIT = "commit"
PRECISION_PUSH = "push_event"

# Account type an organization object must carry.
ORGANIZATION_TYPE = "Organization"

# Texts of the per-organization documents and manifests.
LOGIN_DOCUMENT_VERSION = "1.0"
LOGIN_DOCUMENT_SOURCE = "GH Archive public events via BigQuery"
LOGIN_DOCUMENT_DEFINITION = "Public events where GitHub supplied org.login"
LOGIN_MANIFEST_DEFINITION = (
    "Organizations with org.login present in at least one selected public event"
)
LOGIN_FILE_LAYOUT = "<first-two-login-characters>/<organization-login>.json"
TARGET_DOCUMENT_SOURCE = "GH Archive public monthly tables via a read-only BigQuery query"
TARGET_CSV_NAME = "organization_monthly.csv"

# Patterns.
MONTH_PATTERN = r"20\d{2}-(0[1-9]|1[0-2])"
FIRST_YEAR = 2015
UNSAFE_LOGIN_PATTERN = "[^a-z0-9-]+"
WHITE_SPACE = " \t\n\r\x0b\x0c"
PACKAGE_NAME_PATTERN = r"^[A-Za-z0-9_.-]+"

# Read-only SQL guard.
READ_ONLY_PREFIXES = ("select", "with", "describe", "show", "explain")
MUTATING_WORDS = ("insert", "update", "delete", "drop", "alter", "create", "copy")

LOGIN_ADDITIVE_METRICS = tuple(m for m in LOGIN_PANEL_METRICS if m not in NON_ADDITIVE_METRICS)
TARGET_ADDITIVE_METRICS = tuple(m for m in TARGET_PANEL_METRICS if m not in NON_ADDITIVE_METRICS)
