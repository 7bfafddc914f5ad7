"""Registered queries against their SQL, and the shape of their plans."""

import pytest

import __spark_entry__ as contract
from contentloom.plans.oracles import ORACLES
from contentloom.plans.queries import COVERS, QUERIES
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
WITHOUT_SQL = {"q_discovered_topics"}
IN_PYTHON = {
    "q_markup_text",
    "q_feed_items",
    "q_page_links",
    "q_page_articles",
    "q_forum_items",
    "q_rejects",
}
#: Written by jobs and checked in test_jobs.
KNOWN_GAPS = {"I": {7}, "F": set()}
JOINED = {"q_topic_coherence", "q_topic_insights", "q_topic_properties"}
TOP_K = (
    "q_trending_topics",
    "q_positive_content",
    "q_scholarly_recent",
    "q_vocabulary",
    "q_digest",
    "q_latest",
    "q_trending_served",
    "q_briefing",
)


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    good, note, _ = compare(spark, connection, FOLDER, name)
    assert good or (good is None and name in WITHOUT_SQL), note


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_python_only_where_pages_are_parsed(spark):
    for name in set(QUERIES) - WITHOUT_SQL:
        text = plan(spark, name)
        assert "BatchEvalPython" not in text, name
        assert any(p in text for p in ("ArrowEvalPython", "MapInPandas")) == (name in IN_PYTHON), name


def test_top_k_is_not_a_full_sort(spark):
    for name in TOP_K:
        text = plan(spark, name)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text, name


def test_filters_and_columns_reach_the_scan(spark):
    text = QUERIES["q_trending_topics"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts" in text
    schemas = [part.split("\n")[0] for part in text.split("ReadSchema: ")[1:]]
    events = [part for part in schemas if "ts:" in part]
    assert events and not any("value" in part or "user_id" in part for part in events)


def test_content_is_cleaned_once_per_pass(spark):
    for line in plan(spark, "q_term_counts").splitlines():
        if "Filter" in line:
            assert "regexp_replace" not in line


def test_entry(spark):
    assert contract.entry(spark).count() == 10


def test_no_joins_and_no_cartesian_products(spark):
    for name in set(QUERIES) - WITHOUT_SQL - JOINED:
        assert "Join" not in plan(spark, name) and "Cartesian" not in plan(spark, name)
    for name in JOINED:
        assert "Cartesian" not in plan(spark, name) and "NestedLoop" not in plan(spark, name)


def test_queries_cover_the_inventory():
    shown = " ".join(COVERS.values()).replace(",", " ").split()
    for kind, last in {"F": 15, "T": 9, "Q": 6, "M": 5, "I": 7}.items():
        ids = set()
        for i, word in enumerate(shown):
            if word[:1] == kind and word[1:].isdigit():
                ids.add(int(word[1:]))
                if shown[i + 1 : i + 2] == ["to"]:
                    ids.update(range(int(word[1:]), int(shown[i + 2][1:]) + 1))
        assert set(range(1, last + 1)) - ids <= KNOWN_GAPS.get(kind, set()), kind


def test_words_are_not_cleaned_twice(spark):
    text = plan(spark, "q_term_counts")
    assert text.count("regexp_replace(content") <= 1
