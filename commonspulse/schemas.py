"""Explicit schemas: raw events, the relational tables and landed API objects."""

from __future__ import annotations

from pyspark.sql.types import StructType

RAW_EVENT = (
    "id string, type string, created_at timestamp, "
    "actor struct<id: bigint, login: string>, "
    "repo struct<id: bigint, name: string>, "
    "org struct<id: string, login: string>, "
    "payload string"
)

TABLES = {
    "collection_run": """run_id bigint, source string, target string, started_at timestamp,
        finished_at timestamp, status string, rows_written bigint, error_message string""",
    "organization": """org_id bigint, login string, name string, description string, company string,
        blog string, location string, email string, html_url string, public_repos int, followers int,
        created_at timestamp, updated_at timestamp, collected_at timestamp""",
    "repository": """repo_id bigint, org_id bigint, name string, full_name string, html_url string,
        description string, created_at timestamp, updated_at timestamp, pushed_at timestamp,
        default_branch string, language string, license_spdx string, is_fork boolean,
        parent_full_name string, source_full_name string, archived boolean, disabled boolean,
        visibility string, setup_py_present boolean, dependency_count int,
        python_setup_eligible boolean, collected_at timestamp""",
    "repository_metric_snapshot": """repo_id bigint, observed_at timestamp, stargazers_count int,
        forks_count int, watchers_count int, open_issues_count int, subscribers_count int,
        network_count int""",
    "setup_dependency": """repo_id bigint, package_name string, requirement string, source string,
        collected_at timestamp""",
    "commit_activity": """repo_id bigint, sha string, author_login string, committer_login string,
        author_name string, author_email string, author_time timestamp, committer_time timestamp,
        message string, parents_count int, source string, event_time timestamp,
        timestamp_precision string, collected_at timestamp""",
    "issue": """issue_id bigint, repo_id bigint, number int, author_login string,
        assignee_logins array<string>, state string, state_reason string, title string, body string,
        labels array<string>, comments_count int, locked boolean, created_at timestamp,
        updated_at timestamp, closed_at timestamp, collected_at timestamp""",
    "pull_request": """pull_id bigint, repo_id bigint, number int, author_login string, state string,
        draft boolean, title string, body string, head_repo_full_name string,
        base_repo_full_name string, commits_count int, additions int, deletions int,
        changed_files int, comments_count int, review_comments_count int, created_at timestamp,
        updated_at timestamp, closed_at timestamp, merged_at timestamp, collected_at timestamp""",
    "gharchive_event": """event_id string, event_type string, actor_login string, repo_id bigint,
        repo_full_name string, org_login string, action string, entity_number int,
        created_at timestamp, payload string, archive_hour timestamp, collected_at timestamp""",
    "repository_search_hit": """query string, repo_id bigint, rank int, full_name string,
        owner_login string, owner_type string, matched_at timestamp, raw string""",
    "organization_public_monthly": """org_login string, month date, public_events bigint,
        active_repositories bigint, distinct_actors bigint, push_events bigint,
        commits_in_pushes bigint, issues_opened bigint, pull_requests_opened bigint,
        repositories_created bigint, fork_events bigint, star_events bigint,
        release_events bigint, source string, collected_at timestamp""",
}

KEYS = {
    "collection_run": ["run_id"],
    "organization": ["org_id"],
    "repository": ["repo_id"],
    "repository_metric_snapshot": ["repo_id", "observed_at"],
    "setup_dependency": ["repo_id", "package_name", "requirement"],
    "commit_activity": ["repo_id", "sha"],
    "issue": ["issue_id"],
    "pull_request": ["pull_id"],
    "gharchive_event": ["event_id"],
    "repository_search_hit": ["query", "repo_id", "matched_at"],
    "organization_public_monthly": ["org_login", "month"],
}

# Second unique keys, checked like the primary ones.
ALTERNATE_KEYS = {
    "organization": ["login"],
    "repository": ["full_name"],
    "issue": ["repo_id", "number"],
    "pull_request": ["repo_id", "number"],
}

REQUIRED = {
    "collection_run": ["source", "target", "started_at", "status"],
    "organization": ["login", "collected_at"],
    "repository": ["org_id", "name", "full_name", "is_fork", "archived", "disabled", "collected_at"],
    "repository_metric_snapshot": ["repo_id", "observed_at"],
    "setup_dependency": ["repo_id", "package_name", "requirement", "source", "collected_at"],
    "commit_activity": ["repo_id", "sha", "source", "timestamp_precision", "collected_at"],
    "issue": ["repo_id", "number"],
    "pull_request": ["repo_id", "number"],
    "gharchive_event": ["event_type", "created_at", "payload", "archive_hour", "collected_at"],
    "repository_search_hit": ["query", "repo_id", "rank", "full_name", "matched_at", "raw"],
    "organization_public_monthly": ["org_login", "month", "source", "collected_at"],
}

# Landed API objects arrive in an envelope: which target and repository the
# object was fetched for, when, and the object itself as JSON text.
LANDED = "target_login string, repo_id bigint, observed_at timestamp, object string"

API_OBJECTS = {
    "organization": """id bigint, login string, type string, name string, description string,
        company string, blog string, location string, email string, html_url string,
        public_repos int, followers int, created_at timestamp, updated_at timestamp""",
    "repository": """id bigint, name string, full_name string, html_url string, description string,
        created_at timestamp, updated_at timestamp, pushed_at timestamp, default_branch string,
        language string, license struct<spdx_id: string>, fork boolean,
        parent struct<full_name: string>, source struct<full_name: string>, archived boolean,
        disabled boolean, visibility string, owner struct<login: string, type: string>,
        stargazers_count int, forks_count int, watchers_count int, open_issues_count int,
        subscribers_count int, network_count int""",
    "commit": """sha string, author struct<login: string>, committer struct<login: string>,
        commit struct<message: string,
            author: struct<name: string, email: string, date: timestamp>,
            committer: struct<name: string, email: string, date: timestamp>>,
        parents array<struct<sha: string>>""",
    "issue": """id bigint, number int, user struct<login: string>,
        assignees array<struct<login: string>>, state string, state_reason string, title string,
        body string, labels array<struct<name: string>>, comments int, locked boolean,
        created_at timestamp, updated_at timestamp, closed_at timestamp""",
    "pull": """id bigint, number int, user struct<login: string>, state string, draft boolean,
        title string, body string, head struct<repo: struct<full_name: string>>,
        base struct<repo: struct<full_name: string>>, commits int, additions int, deletions int,
        changed_files int, comments int, review_comments int, created_at timestamp,
        updated_at timestamp, closed_at timestamp, merged_at timestamp""",
    "setup": "encoding string, content string",
}


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])
