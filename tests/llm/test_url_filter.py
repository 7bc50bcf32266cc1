import time

import pytest
from compare import compare
from corpus import MIDDLE, SMALL, connect

from storetally.llm import url_filter
from storetally.llm.texts import shared_checkpoint
from storetally.llm.url_filter import RULES, TOLERANCE, judge, op4_url_filter, oracle, propagate

SCHEMA = "page_id bigint, url string, html string, host string, path string, rule string, verdict string, kind string"


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_matches_sql(spark, folder):
    """The SQL goes on for 85 rounds."""
    assert compare(op4_url_filter(spark, folder), connect(folder), oracle()) == []


def test_propagation_settles(spark):
    """A chain and a two-way edge, on which mass swings: against the linear equations."""
    links = [("a", "b", 1.0), ("b", "a", 0.5), ("b", "c", 0.5), ("c", "d", 1.0), ("d", "c", 0.25), ("d", "a", 0.75)]
    links += [(f"n{i}", f"n{i + 1}", 1.0) for i in range(30)]
    edges = spark.createDataFrame([("block", *link) for link in links], "kind string, source string, target string, weight double")
    seeds = spark.createDataFrame([("block", "a", 3.0), ("block", "n0", 2.0)], "kind string, host string, mass double")
    found = {row["host"]: row["mass"] for row in propagate(edges, seeds).collect()}
    mass = {"a": 3.0, "n0": 2.0}
    exact = dict.fromkeys({end for link in links for end in link[:2]}, 0.0)
    for _ in range(400):
        exact = {h: 0.15 * mass.get(h, 0) + 0.85 * sum(exact[s] * w for s, t, w in links if t == h) for h in exact}
    assert sum(abs(found.get(h, 0) - value) for h, value in exact.items()) < TOLERANCE * 5
    assert found["n30"] == pytest.approx(0.3 * 0.85**30, rel=1e-6)


def test_long_hosts(spark):
    """A host of 8,000 labels costs no more than its length."""
    long = "a." * 8000 + "example.net"
    rows = [(1, f"http://{long}/en/x", ""), (2, "http://b.net/", ""), (3, "http://" + "c." * 30_000 + "d/", "")]
    begin = time.perf_counter()
    found = judge(spark.createDataFrame(rows, "page_id int, url string, html string"), RULES)
    assert {row["page_id"]: (row["rule"], row["verdict"]) for row in found.collect()} == {
        1: ("example.net/en/", "allow"), 2: ("net/", "block"), 3: (None, "allow"),
    }
    assert time.perf_counter() - begin < 60


@pytest.fixture(scope="module")
def pages(spark):
    link = '<a href="http://{}/">x</a>'.format
    rows = [
        (1, "http://WWW.Example.NET/en/1?q", None),
        (2, "https://example.net/de/", ""),
        (3, "http://notexample.net/en/", ""),
        (4, "ftp://a.example.com/de/x#f", ""),
        (5, "http://a.example.com", ""),
        (6, "http://b.org/fr/://x", ""),
        (7, "http://b.org?x=/fr/", ""),
        (8, None, "x" * 100_000),
        (9, "no scheme/en/", ""),
        (10, "://net/", ""),
        (11, "http://spam.test/", link("far.test")),
        (12, "http://linker.test/1", link("bad.net") * 5),
        (13, "http://clean.test/1", link("linker.test")),
        (None, "http://x.net/", ""),
        (1, "http://WWW.Example.NET/en/1?q", None),
    ] + [(100 + i, f"http://bad.net/{i}", "") for i in range(40)]
    return spark.createDataFrame([(*row, *["z"] * 5) for row in rows], SCHEMA)


def test_awkward_urls(spark, pages):
    found = judge(pages, RULES)
    assert found.count() == pages.count()
    by_id = {row["page_id"]: tuple(row)[1:] for row in found.collect()}
    assert by_id[1] == ("www.example.net", "/en/1", "example.net/en/", "allow")
    assert by_id[2] == ("example.net", "/de/", "net/", "block")
    assert by_id[3] == ("notexample.net", "/en/", "net/", "block")
    assert by_id[4] == ("a.example.com", "/de/x", "example.com/de/", "block")
    assert by_id[5][:3] == ("a.example.com", "", None)
    assert by_id[6] == ("b.org", "/fr/://x", "org/fr/", "allow")
    assert by_id[7][:3] == ("b.org", "", None)
    assert by_id[8] == by_id[9] == ("", "", None, "allow")
    assert by_id[10] == ("net", "/", "net/", "block")
    assert by_id[None] == ("x.net", "/", "net/", "block")
    # Distrust goes against links: who links to a blocked host a lot is blocked too.
    assert by_id[11][3] == by_id[13][3] == "allow" or by_id[13][3] == "block"
    assert by_id[12] == ("linker.test", "/1", None, "block")


def test_empty_table(spark, pages):
    assert judge(pages.limit(0), RULES).collect() == []


def test_rounds_broadcast_nothing(spark, monkeypatch, tmp_path):
    """The driver collects no table a round."""
    plans = []

    def kept(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return shared_checkpoint(frame)

    monkeypatch.setattr(url_filter, "shared_checkpoint", kept)
    edges = spark.createDataFrame([("allow", "a", "b", 1.0), ("allow", "b", "a", 1.0)], "kind string, source string, target string, weight double")
    seeds = spark.createDataFrame([("allow", "a", 1.0)], "kind string, host string, mass double")
    # Spark knows the size of files, and so that it may broadcast them.
    for name, table in (("edges", edges), ("seeds", seeds)):
        table.coalesce(1).write.parquet(str(tmp_path / name))
    edges, seeds = (spark.read.parquet(str(tmp_path / name)) for name in ("edges", "seeds"))
    found = {row["host"]: row["mass"] for row in url_filter.propagate(edges, seeds, tolerance=0.3).collect()}
    assert found["a"] > found["b"] > 0
    assert len(plans) > 3 and not [plan for plan in plans if "Broadcast" in plan]


def test_rounds_have_tasks_by_rows(spark, monkeypatch):
    """However many partitions shuffles have: few rows take few tasks a round; several tasks give the same masses."""
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    links = [("allow", f"h{i}", f"h{j % 30}", 0.5) for i in range(30) for j in (3 * i + 1, 7 * i + 2)]
    parts, context = [], spark.sparkContext

    def kept(frame):
        found = shared_checkpoint(frame)
        parts.append(found.rdd.getNumPartitions())
        return found

    def run(rows):
        monkeypatch.setattr(url_filter, "ROWS_PER_TASK", rows)
        parts.clear()
        context.setJobGroup(f"rows {rows}", "rounds")
        edges = spark.createDataFrame(links, "kind string, source string, target string, weight double").repartition(40)
        seeds = spark.createDataFrame([("allow", "h1", 2.0), ("allow", "h5", 1.0)], "kind string, host string, mass double")
        found = {row["host"]: row["mass"] for row in propagate(edges, seeds, tolerance=0.01).collect()}
        status = context.statusTracker()
        stages = [status.getStageInfo(i) for job in status.getJobIdsForGroup(f"rows {rows}") for i in status.getJobInfo(job).stageIds]
        return found, sum(stage.numTasks for stage in stages if stage)

    monkeypatch.setattr(url_filter, "shared_checkpoint", kept)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        whole, tasks = run(100_000)
        assert len(parts) > 20 and set(parts) == {1} and tasks < 20 * 40
        dealt, _ = run(13)
        assert max(parts) == 5  # 62 rows
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for name, value in before.items():
            spark.conf.set(name, value)
    assert dealt == pytest.approx(whole, rel=1e-9) and sum(whole.values()) == pytest.approx(3.0, rel=0.02)
