"""Archive and API objects to rows; setup files."""

import base64
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from commonspulse import schemas
from commonspulse.operators import dependencies, filters, projections
from commonspulse.plans import archive_load, landing_load
from commonspulse.sources.landed import typed_objects

EVENT = schemas.RAW_EVENT + ", archive_hour timestamp"
HOUR = datetime(2025, 1, 1)


def event(id, type, payload, org="acme", repo=(2, "acme/app"), at=datetime(2025, 1, 1, 0, 1), hour=HOUR):
    return (id, type, at, (1, "Alice"), repo, None if org is None else ("1", org), payload, hour)


@pytest.mark.parametrize("payload, number", [
    ('{"issue":{"number":81,"title":"slow"}}', 81),
    ('{"pull_request":{"number":7012}}', 7012),
    ('{"issue":null,"pull_request":{"number":55}}', 55),
    ('{"issue":[],"pull_request":{"number":56}}', 56),
    ('{"issue":{"title":"no number"},"pull_request":{"number":57}}', None),  # there is an issue, so the pull request is not asked
    ('{"issue":{"number":"many"}}', None),
    ('{"comment":{"id":4}}', None),
    ("not json", None),
])
def test_number_comes_from_the_issue_else_from_the_pull_request(rows, payload, number):
    frame = rows(EVENT, event("n", "IssueCommentEvent", payload, repo=(640, "lake/shore")))
    assert projections.event_rows(frame).first()["entity_number"] == number


def test_flat_event_columns(rows):
    frame = rows(EVENT, event("91", "ReleaseEvent", '{"action":"published","release":{"id":6}}', org="Lake", repo=(640, "Lake/Shore")),
                 event("92", "GollumEvent", None, org=None, repo=(None, None)))
    first, bare = projections.event_rows(frame, F.lit("2025-06-01").cast("timestamp")).orderBy("event_id").collect()
    assert tuple(first) == ("91", "ReleaseEvent", "Alice", 640, "Lake/Shore", "Lake", "published", None, datetime(2025, 1, 1, 0, 1),
                            '{"action":"published","release":{"id":6}}', HOUR, datetime(2025, 6, 1))
    assert (bare["payload"], bare["action"], bare["org_login"], bare["repo_id"]) == ("{}", None, None, None)


def test_commits_of_pushes(rows):
    listed = [{"sha": f"{i:040x}", "message": f"step {i}", "author": {"name": "Bo", "email": f"bo+{i}@lake.test"}} for i in range(3)]
    listed += [{"sha": None}, {"message": "without sha"}, {"sha": "f" * 40}]
    text = json.dumps({"size": 99, "commits": listed})
    moment = datetime(2023, 9, 17, 22, 40)
    frame = rows(EVENT, event("p", "PushEvent", text, repo=(640, "lake/shore"), at=moment),
                 event("none", "PushEvent", '{"commits":[]}', repo=(640, "lake/shore")), event("no list", "PushEvent", "{}"),
                 event("no repository", "PushEvent", text, repo=(None, "lake/gone")), event("zero", "PushEvent", text, repo=(0, "lake/zero")),
                 event("no push", "CommitCommentEvent", text))
    found = projections.archive_commit_rows(frame, keep=["id"]).orderBy("position").collect()
    assert [(r["id"], r["position"], r["sha"]) for r in found] == [
        *[("p", i, f"{i:040x}") for i in range(3)], ("p", 5, "f" * 40)]
    # The archive knows when a push came, not when its commits were made.
    assert {(r["event_time"], r["author_time"], r["committer_time"], r["timestamp_precision"]) for r in found} == {
        (moment, None, None, "push_event")}
    assert [r["author_email"] for r in found] == ["bo+0@lake.test", "bo+1@lake.test", "bo+2@lake.test", None]


def test_organization_match(rows):
    frame = rows(EVENT, event("1", "PushEvent", "{}", org=None, repo=(1, "ACME/x")), event("2", "PushEvent", "{}", repo=(1, "o/x")),
                 event("3", "PushEvent", "{}", org=None, repo=(1, "acmeish/x")), event("4", "PushEvent", "{}", org=None, repo=(1, "acme")))
    assert [r["id"] for r in filters.of_organization(frame, "Acme").collect()] == ["1", "2"]
    many = filters.of_organizations(frame, rows("login string", ("ACME",), ("o",), ("o",)))
    assert sorted((r["matched_org"], r["id"]) for r in many.collect()) == [("acme", "1"), ("acme", "2"), ("o", "2")]


def test_archive_load_keeps_first_and_stored_rows(spark, rows):
    later = datetime(2025, 1, 1, 1)
    events = rows(EVENT,
                  event("1", "PushEvent", '{"commits":[{"sha":"a","message":"second"}]}', hour=later),
                  event("1", "PushEvent", '{"commits":[{"sha":"a","message":"first"},{"sha":"s"}]}'),
                  event("2", "WatchEvent", "{}"), event("3", "ForkEvent", "{}", org="other", repo=(1, "other/x")))
    stored = {n: spark.createDataFrame([], schemas.table_schema(n)) for n in ("gharchive_event", "commit_activity")}
    kept = stored["commit_activity"].union(spark.createDataFrame(
        [(2, "s", *[None] * 6, "rich", 1, "github_api", None, "commit", HOUR)], schemas.table_schema("commit_activity")))
    load = archive_load.load_archive(events, {**stored, "commit_activity": kept}, "acme")
    new = load.new_events.collect()
    assert [(r["event_id"], r["archive_hour"]) for r in new] == [("1", HOUR)]
    assert load.matches() == 2
    assert [(r["sha"], r["message"]) for r in load.new_commits.collect()] == [("a", "first")]


PINNED = '''
import io, setuptools
runtime = ("Pillow ~= 11.0", "typing_extensions", "tomli>=1.1 ; python_version < '3.11'",)
setuptools.setup(version="7", install_requires=runtime, extras_require={"dev": ["pytest"]})
'''


@pytest.mark.parametrize("source, expected", [
    (PINNED, [("pillow", "Pillow ~= 11.0"), ("tomli", "tomli>=1.1 ; python_version < '3.11'"), ("typing-extensions", "typing_extensions")]),
    ("setup(install_requires=open('wanted.txt').read().split())", []),
    ("setup(install_requires=['fixed', *more])", []),
    ("setup(install_requires=r)\nr = ['x']\nr = ['y', f()]\n", [("x", "x")]),
    ("def f():\n    q = ['n']\n    setup(install_requires=q)\n", []),
    ("r: list = ('a', ' b>1 ')\nimport s\ns.setup(install_requires=r)\nsetup(install_requires={'c'})", [("a", "a"), ("b", "b>1"), ("c", "c")]),
    ("setup(install_requires=['a', 'a', '-', '', '@x'])", [("-", "-"), ("a", "a")]),
    ("setup(install_requires=['a'", []),
    (None, []),
])
def test_setup_files(rows, source, expected):
    found = dependencies.setup_dependencies(rows("repo_id bigint, source string", (1, source)))
    assert [(r["package_name"], r["requirement"]) for r in found.collect()] == expected


def envelope(kind, *objects):
    return [("Acme", o.get("_repo"), datetime(2024, 1, 1), json.dumps({k: v for k, v in o.items() if k != "_repo"})) for o in objects]


def test_landing_load(spark, rows):
    setup = base64.b64encode(b"setup(install_requires=['a', 'b'])\n# \xff").decode()
    landed = {kind: typed_objects(rows(schemas.LANDED, *envelope(kind, *objects)), kind) for kind, objects in {
        "organization": [{"id": 1, "login": "Acme", "type": "Organization"}],
        "repository": [
            {"id": 10, "name": "App", "full_name": "Acme/App", "language": "Python", "license": {"spdx_id": "MIT"}, "stargazers_count": 4},
            {"id": 11, "name": "Lib", "full_name": "Acme/Lib", "fork": True, "parent": {"full_name": "up/Lib"}},
            {"id": 12, "name": "Old", "full_name": "Acme/Old", "archived": True}],
        "commit": [
            {"_repo": 10, "sha": "a", "commit": {"author": {"date": "2024-01-05T00:00:00Z"}, "committer": {"date": "2024-01-05T00:00:00Z"}}, "parents": [{"sha": "p"}]},
            {"_repo": 10, "sha": "b", "commit": {"committer": {"date": "2020-01-05T00:00:00Z"}}},
            {"_repo": 12, "sha": "c", "commit": {"committer": {"date": "2024-01-05T00:00:00Z"}}}],
        "issue": [
            {"_repo": 10, "id": 100, "number": 1, "labels": [{"name": "bug"}, {"name": None}], "created_at": "2024-02-01T00:00:00Z"},
            {"_repo": 10, "id": 101, "number": 2, "pull_request": None, "created_at": "2024-02-01T00:00:00Z"},
            {"_repo": 10, "id": 102, "number": 3, "created_at": "2024-02-01T00:00:01Z"}],
        "pull": [{"_repo": 11, "id": 200, "number": 1, "head": {"repo": None}, "base": {"repo": {"full_name": "Acme/Lib"}}}],
        "setup": [{"_repo": 10, "encoding": "base64", "content": setup}],
    }.items()}
    stored = {n: spark.createDataFrame([], schemas.table_schema(n)) for n in schemas.TABLES}
    targets = rows(landing_load.TARGETS, (" acme ", None, datetime(2023, 1, 1)), ("other", ["x"], None))
    tables = landing_load.load_landing(landed, targets, stored, until=datetime(2024, 2, 1), include_archived=False)
    repos = {r["repo_id"]: r for r in tables["repository"].collect()}
    assert set(repos) == {10, 11}
    assert (repos[10]["setup_py_present"], repos[10]["dependency_count"], repos[10]["python_setup_eligible"]) == (True, 2, True)
    assert (repos[11]["setup_py_present"], repos[11]["is_fork"], repos[11]["parent_full_name"]) == (False, True, "up/Lib")
    assert repos[10]["archived"] is False and repos[10]["license_spdx"] == "MIT"
    assert [r["login"] for r in tables["organization"].collect()] == ["acme"]
    assert {r["repo_id"]: r["stargazers_count"] for r in tables["repository_metric_snapshot"].collect()} == {10: 4, 11: None}
    assert [(r["sha"], r["parents_count"]) for r in tables["commit_activity"].collect()] == [("a", 1)]
    issues = tables["issue"].collect()
    assert [(r["issue_id"], r["labels"], r["assignee_logins"]) for r in issues] == [(100, ["bug", None], [])]
    assert [r["head_repo_full_name"] for r in tables["pull_request"].collect()] == [None]
    assert {r["requirement"] for r in tables["setup_dependency"].collect()} == {"a", "b"}
    without = landing_load.load_landing(landed, targets, stored, setup_dependencies=False)
    assert {r["setup_py_present"] for r in without["repository"].collect()} == {None}


def test_rows_that_several_tables_share_are_kept_once(spark, rows):
    objects = {"organization": [{"id": 1, "login": "Acme", "type": "Organization"}],
               "repository": [{"id": k, "name": f"R{k}", "full_name": f"Acme/R{k}", "language": "Python"} for k in (10, 11, 11)],
               "commit": [{"_repo": 10, "sha": "a"}, {"_repo": 12, "sha": "b"}], "issue": [{"_repo": 11, "id": 100, "number": 1}],
               "pull": [], "setup": [{"_repo": 10, "encoding": "base64", "content": base64.b64encode(b"setup(install_requires=['a', 'b'])").decode()}]}
    landed = {kind: typed_objects(rows(schemas.LANDED, *envelope(kind, *found)), kind) for kind, found in objects.items()}
    stored = {n: spark.createDataFrame([], schemas.table_schema(n)) for n in schemas.TABLES}
    targets = rows(landing_load.TARGETS, ("acme", None, None), (None, None, None))
    kept = []

    def keep(found):
        kept.append(found)
        return spark.createDataFrame(found.collect(), found.schema)

    plain, shared = landing_load.load_landing(landed, targets, stored), landing_load.load_landing(landed, targets, stored, keep=keep)
    assert len(kept) == 4 and sorted(plain) == sorted(shared)
    for name, table in plain.items():
        assert sorted(map(str, table.collect())) == sorted(map(str, shared[name].collect()))


def test_personal_accounts_are_rejected(rows):
    frame = typed_objects(rows(schemas.LANDED, *envelope("organization", {"id": 1, "login": "u", "type": "User"},
                                                         {"id": 2, "login": "v"})), "organization")
    assert filters.organizations_only(frame).count() == 0
    assert filters.rejected_accounts(frame).count() == 2


def test_invalid_bytes_are_replaced(rows):
    from commonspulse.functions.expressions import decode_base64_text
    text = base64.b64encode("naïve\n".encode() + b"\xff").decode()
    text = text[:4] + "\n" + text[4:]
    assert rows("c string", (text,)).select(decode_base64_text(F.col("c"))).first()[0] == "naïve\n�"


def test_event_matching_two_logins_counts_once(rows):
    frame = rows(EVENT, event("1", "PushEvent", "{}", org="tag", repo=(1, "own/x")), event("2", "PushEvent", "{}", org=None, repo=(1, "own/y")),
                 event("3", "PushEvent", "{}", org="tag", repo=(1, None)), event("4", "PushEvent", "{}", org=None, repo=(1, None)))
    found = filters.of_any_organization(frame, rows("login string", ("OWN",), ("Tag",), ("tag",)))
    assert sorted(r["id"] for r in found.collect()) == ["1", "2", "3"]
    assert found.columns == frame.columns


def test_ranked_hits_are_cut_before_the_shuffle(rows):
    from commonspulse.operators.search import ranked_hits
    objects = [{"id": i, "full_name": f"o/{i}", "updated_at": f"2024-01-{1 + i % 9:02d}T00:00:00Z"} for i in range(30)]
    results = typed_objects(rows(schemas.LANDED, *envelope("repository", *objects)), "repository").withColumn(
        "query", F.when(F.col("o.id") == 29, "other").otherwise("q"))
    hits = ranked_hits(results, 5)
    assert [(r["rank"], r["repo_id"]) for r in hits.where("query = 'q'").orderBy("rank").collect()] == [(1, 8), (2, 17), (3, 26), (4, 7), (5, 16)]
    assert "WindowGroupLimit" in hits._jdf.queryExecution().executedPlan().toString()


def test_repositories_without_their_setup_columns_are_loaded_without_parsing(spark, rows):
    """What a setup file tells joins the newest row of its repository, and only where it is asked for."""
    repos = [{"id": 10, "name": n, "full_name": f"Acme/{n}", "language": language} for n, language in (("A", "Python"), ("B", "C"), ("C", "Python"))]
    objects = {"organization": [{"id": 1, "login": "Acme", "type": "Organization"}],
               "repository": [*repos, {"id": 11, "name": "D", "language": "Python"}, {"id": None, "name": "E"}],
               "commit": [], "issue": [], "pull": [],
               "setup": [{"_repo": 10, "encoding": "base64", "content": base64.b64encode(b"setup(install_requires=['a', 'b'])").decode()},
                         {"_repo": None, "encoding": "none"}]}
    landed = {kind: typed_objects(rows(schemas.LANDED, *envelope(kind, *found)), kind) for kind, found in objects.items()}
    stored = {n: spark.createDataFrame([], schemas.table_schema(n)) for n in schemas.TABLES}
    stored["repository"] = stored["repository"].unionByName(rows("repo_id bigint, name string, setup_py_present boolean, dependency_count int", (10, "old", None, 9), (12, "kept", True, 3)), allowMissingColumns=True)
    table = landing_load.load_landing(landed, rows(landing_load.TARGETS, ("acme", None, None)), stored)["repository"]
    shown = {r["repo_id"]: tuple(r)[1:] for r in table.select("repo_id", "name", "setup_py_present", "dependency_count", "python_setup_eligible").collect()}
    assert shown == {10: ("C", True, 2, True), 11: ("D", False, 0, False), None: ("E", False, 0, False), 12: ("kept", True, 3, None)}
    assert "ArrowEvalPython" in table._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in table.select("repo_id", "name")._jdf.queryExecution().executedPlan().toString()
