"""Plan shape guards: pruning, pushdown and shuffle counts that scale depends on."""

import re

import pytest

import __spark_entry__ as E
from conftest import SMALL


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_to_gold_shuffles_once(spark, static_plans):
    p = plan(E.queries()["player_performance"](spark, SMALL))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1


def test_throughput_scan_skips_the_document_text(spark, static_plans):
    p = plan(E.queries()["stage_throughput"](spark, SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*?>)(?:,|\n|$)", p)
    assert schemas and all("match_details" not in s for s in schemas)


def test_partition_scan_prunes_directories(spark, static_plans):
    p = plan(E.queries()["partition_scan"](spark, SMALL))
    assert "PartitionFilters: [isnotnull(partition_date" in p and "2024-01-15" in p


def test_recent_matches_limit_before_the_shuffle(spark, static_plans):
    p = plan(E.queries()["recent_n_per_key"](spark, SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


PARSE_ONCE = ["bronze_ingest", "quarantine", "parse_document", "games", "participants",
              "participants_window", "team_stats", "team_bans", "dedupe_rows", "dedupe_by_key",
              "match_summary", "player_performance", "team_performance", "player_totals"]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_each_document_is_parsed_once(spark, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for name in PARSE_ONCE:
            df = E.queries()[name](spark, SMALL)
            physical = df._jdf.queryExecution().sparkPlan().toString()
            parses = re.findall(r"from_json\(StructField\((?:timestamp_summoner|info|metadata)",
                                physical)
            assert len(parses) == 1, (name, physical)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_silver_branches_add_no_exchange(spark, adaptive):
    """The key dedupe is the only exchange of each branch, with and without AQE."""
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for name in ("games", "participants", "team_stats", "team_bans"):
            p = plan(E.queries()[name](spark, SMALL))
            assert len(re.findall(r"Exchange hashpartitioning", p)) == 1, (name, p)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_grid_panel_fans_out_after_the_exchange(spark, static_plans):
    p = plan(E.queries()["metric_messages_per_minute_grid"](spark, SMALL))
    dealt = p.index("REPARTITION_BY_COL")
    assert "Generate explode(org.apache" in p[:dealt]          # the grid times, in the same stage
    assert "Generate explode(org.apache" not in p[dealt:]
    assert "Exchange" not in p[p.index("Generate explode(org.apache"):dealt - 100].rpartition("\n")[0]


def test_recent_samples_bound_reaches_the_scan(spark, static_plans):
    p = plan(E.queries()["metric_recent"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts", p)


def test_lookups_are_written_one_file_per_bucket(spark):
    from ingot.sources.sinks import publish_bucketed
    rows = spark.range(0, 20_000, 1, 40).selectExpr("id % 500 AS k", "id AS v")
    table = publish_bucketed(rows, "k", "files", buckets=16)
    assert table.count() == 20_000 and len(table.inputFiles()) <= 16


@pytest.mark.parametrize("name", ["enrich_document", "enrich_chain"])
def test_chain_joins_documents_by_a_shuffle_without_landing_them(spark, name):
    """Documents are neither written out before their join nor broadcast, however small
    the planner takes them to be."""
    p = E.queries()[name](spark, SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert "landed-documents" not in p
    joined = p[:p.index("collect_list(struct(l_partkey")]
    assert "SortMergeJoin [match_id" in joined


def test_window_numbering_sorts_a_participant_once(spark, static_plans):
    """The window carries no copy of each field to sort by, and nothing makes its rows distinct."""
    p = plan(E.queries()["participants_window"](spark, SMALL))
    after = p[:p.index("SortAggregate")]
    assert "row_number()" in after and "HashAggregate" not in after and "_w1" not in after


def test_silver_job_parses_what_its_tables_read(spark, monkeypatch):
    """A run for ``games`` alone parses, shuffles and stages no participants, teams or metadata."""
    from ingot.plans import silver as P
    seen, dedupe = [], P.D.dedupe_by_key
    monkeypatch.setattr(P.D, "dedupe_by_key", lambda keyed, *a, **k: seen.append(keyed) or dedupe(
        keyed, *a, **k))
    P.q_silver_quarantine(spark, SMALL)
    doc = seen[0].schema["doc"].dataType
    assert doc.names == ["info"] and doc["info"].dataType.names == P.D.GAME_INFO


def test_tables_of_a_date_are_written_as_zstd(spark):
    from ingot.session import fresh_path
    from ingot.sources.sinks import overwrite_partitions, replace_dates
    rows = spark.range(5).selectExpr("id", "date'2024-02-01' AS partition_date")
    a, b = fresh_path(spark, "codec-a"), fresh_path(spark, "codec-b")
    overwrite_partitions(rows, a)
    replace_dates({b: rows}, "2024-02-01")
    for path in (a, b):
        files = spark.read.parquet(path).inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_tasks_that_gather_lines_follow_the_table(spark, tmp_path, monkeypatch):
    """More lines than the session's shuffle partitions hold get more tasks, on both sides of
    the join with the orders; the documents stay the same."""
    from ingot.sources import fixtures as X
    spark.range(30).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "'O' AS o_orderstatus",
                               "100.5D AS o_totalprice", "timestamp_ntz'2024-01-01' AS o_orderdate",
                               "'1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(60).selectExpr("if(id = 59, NULL, id DIV 3) AS l_orderkey", "id AS l_partkey", "id AS l_suppkey",
                               "CAST(id % 3 AS int) AS l_linenumber", "2D AS l_quantity",
                               "10D AS l_extendedprice", "0.1D AS l_discount", "'R' AS l_returnflag",
                               "'F' AS l_linestatus").write.parquet(f"{tmp_path}/lineitem.parquet")

    def documents():
        df = X.match_documents(spark, str(tmp_path))
        dealt = re.findall(r"hashpartitioning\((?:l|o)_orderkey#\d+L?, (\d+)\)", plan(df))
        lists = "array_sort(from_json(doc, 'info struct<participants array<struct<championId int>>>').info.participants)"
        return dealt, sorted(map(tuple, df.selectExpr("o_orderkey", lists).collect()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, before = documents()
        monkeypatch.setattr(X, "LINES_PER_TASK", 3, raising=False)
        many, after = documents()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert set(few) == {"8"} and many == ["20", "20"]
    assert after == before and len(after) == 30 and sum(len(r[1] or []) for r in after) == 59
