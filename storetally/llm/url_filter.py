"""URL filter: rules first, then trust and distrust passed on along host links.

A rule has a host and a path; it fits its host and all subdomains if the path of
the URL begins with the rule's. The longest rule decides. Pages that rules decide make their
hosts seeds, with a weight of one for each page. Hosts are linked by the absolute
links of their pages, and a subdomain with the host above it, in both directions.
Personalised PageRank passes trust from allowed seeds along the links, and
distrust from blocked seeds against them, until what is still on its way is less than
`TOLERANCE` of the seeds. Where no rule decides, a host is blocked if distrust is more than half of its evidence: trust,
distrust, and `PRIOR` for each of its own pages, so that a host with many pages
needs more of it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from storetally.llm.texts import shared_checkpoint, table

DAMPING = 0.85
TOLERANCE = 1e-4
MOST_DISTRUST = 0.5
PRIOR = 0.2
# Rows of the host graph that a task of a round takes.
ROWS_PER_TASK = 100_000

# Rules of the registered query: host, path, verdict. Fixed values.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)href\s*+=\s*+["']?([^"'\s>]++)"""


def host_of(url: Column) -> Column:
    """The host of a URL, A-Z as a-z; empty without `://`, as for NULL."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def _rest(url: Column) -> Column:
    """What follows the first `://`."""
    place = F.instr(url, "://")
    return F.when(place > 0, F.substr(url, place + 3)).otherwise("")


def path_of(url: Column) -> Column:
    """The path of a URL, up to `?` or `#`."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _suffixes(host: Column, most: int) -> Column:
    """The last labels of the host, from one to `most` of them; so a long host costs no more than its length."""
    labels = F.split(host, r"\.")
    return F.array_distinct(
        F.array(*(F.array_join(F.slice(labels, -F.least(F.lit(n), F.size(labels)), n), ".") for n in range(1, most + 1)))
    )


def _above(host: Column) -> Column:
    """The host without its first label; NULL for hosts of fewer than three labels."""
    return F.when(F.size(F.split(host, r"\.")) > 2, F.regexp_replace(host, r"^[^.]*\.", ""))


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, weight) of the host links of `pages` (host, html); weights of a source sum to 1."""
    links = (
        pages.filter("host != ''")
        .select("host", F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("href"))
        .filter(F.col("href").contains("://"))
        .select(F.col("host").alias("source"), host_of(F.col("href")).alias("target"))
    )
    hosts = pages.select("host").union(links.select("target")).filter("host != ''").distinct()
    tree = hosts.select(F.col("host").alias("source"), _above(F.col("host")).alias("target")).filter("target IS NOT NULL")
    edges = (
        links.union(tree)
        .union(tree.select("target", "source"))
        .filter("source != target AND target != ''")
        .groupBy("source", "target")
        .agg(F.count("*").alias("n"))
    )
    out = edges.groupBy("source").agg(F.sum("n").alias("n_all"))
    return edges.join(out, "source").select("source", "target", (F.col("n") / F.col("n_all")).alias("weight"))


def rounds_needed(tolerance: float = TOLERANCE, damping: float = DAMPING) -> int:
    """Rounds after which less than `tolerance` of the seeds' mass can be on its way, whatever the links are."""
    return math.ceil(math.log(tolerance) / math.log(damping))


def propagate(
    edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING
) -> DataFrame:
    """(kind, host, mass): personalised PageRank of `seeds` (kind, host, mass) over `edges` (kind, source, target, weight).

    A kept table holds what each host has and what it has not passed on yet. A round passes the latter
    on; what then remains shrinks by the damping at least, faster where hosts have no links. Ends when less
    than `tolerance` of all mass is on its way: so much is missing in the result. Each step of a round, and
    so each kept table, has as many tasks as the rows of the graph need, however many partitions a shuffle has.
    Both tables are counted first, so give kept ones.
    """
    first = (F.col("mass") * (1 - damping)).alias("mass")
    state = seeds.select("kind", "host", first).withColumn("moving", F.col("mass"))
    total, rows = seeds.agg(F.sum("mass"), F.count("*")).first()
    if not total:
        return state.drop("moving")
    tasks = math.ceil((rows + edges.count()) / ROWS_PER_TASK)
    links = shared_checkpoint(edges.withColumnRenamed("source", "host").coalesce(tasks))
    for _ in range(rounds_needed(tolerance, damping)):
        # Merged: the driver would collect and keep a broadcast table a round.
        moved = state.filter("moving > 0").join(links.hint("merge"), ["kind", "host"]).select(
            "kind", F.col("target").alias("host"), (F.col("moving") * F.col("weight") * damping).alias("mass")
        )
        passed = (
            state.select("kind", "host", "mass", F.lit(0.0).alias("moving"))
            .union(moved.withColumn("moving", F.col("mass")))
            .coalesce(tasks)
            .groupBy("kind", "host")
            .agg(F.sum("mass").alias("mass"), F.sum("moving").alias("moving"))
            .coalesce(tasks)
        )
        # A table and a small plan for each round; what moves is summed while the table is written.
        watch = Observation()
        state = shared_checkpoint(passed.observe(watch, F.sum("moving").alias("moving")))
        # All that will still move, in all rounds to come.
        if (watch.get["moving"] or 0.0) * damping / (1 - damping) < tolerance * total:
            break
    return state.drop("moving")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of `pages` (page_id, url, html; others are ignored).

    `rules` holds (host, path, "allow" or "block"); of rules of equal length the
    first by name wins. A page without a host, and a host without evidence, is
    allowed. A NULL html has no links. Repeated rows are judged alike and count
    as evidence each; a NULL page_id is carried along; an empty table gives no rows.
    """
    spark = pages.sparkSession
    known = spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = max((host.count(".") + 1 for host, _, _ in rules), default=1)
    # Rules by host: one row per distinct host and rule of a host above it.
    by_host = (
        urls.select("host")
        .filter("host != ''")
        .distinct()
        .select("host", F.explode(_suffixes(F.col("host"), labels)).alias("rule_host"))
        .join(known, "rule_host")
        .groupBy("host")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        (-F.length(F.concat("rule_host", "rule_path"))).alias("size"),
                        F.concat("rule_host", "rule_path").alias("rule"),
                        F.col("rule_path").alias("path"),
                        F.col("rule_verdict").alias("verdict"),
                    )
                )
            ).alias("rules")
        )
    )
    fitting = F.filter("rules", lambda rule: F.col("path").startswith(rule["path"]))
    # Equal hosts and paths are counted before they are judged.
    kinds = urls.filter("host != ''").groupBy("host", "path").agg(F.count("*").alias("n")).join(by_host, "host", "left")
    decided = kinds.select("host", "path", "n", F.try_element_at(fitting, F.lit(1)).alias("rule"))
    seeds = (
        decided.filter("rule IS NOT NULL")
        .groupBy(F.col("rule.verdict").alias("kind"), "host")
        .agg(F.sum("n").cast("double").alias("mass"))
    )
    links = host_edges(pages.select(host_of(F.col("url")).alias("host"), "html"))
    edges = links.select(F.lit("allow").alias("kind"), "source", "target", "weight")
    back = links.groupBy("target").agg(F.sum("weight").alias("all"))
    against = (
        links.join(back, "target")
        .select(
            F.lit("block").alias("kind"),
            F.col("target").alias("source"),
            F.col("source").alias("target"),
            (F.col("weight") / F.col("all")).alias("weight"),
        )
    )
    mass = propagate(shared_checkpoint(edges.union(against)), shared_checkpoint(seeds))
    trust = F.sum(F.when(F.col("kind") == "allow", F.col("mass")).otherwise(0.0))
    distrust = F.sum(F.when(F.col("kind") == "block", F.col("mass")).otherwise(0.0))
    sizes = kinds.groupBy("host").agg(F.sum("n").alias("n"))
    blocked = (
        mass.groupBy("host")
        .agg(trust.alias("trust"), distrust.alias("distrust"))
        .join(sizes, "host")
        .filter(F.col("distrust") > MOST_DISTRUST * (F.col("trust") + F.col("distrust") + PRIOR * F.col("n")))
    )
    hosts = by_host.join(blocked.select("host", F.lit(True).alias("blocked")), "host", "full_outer")
    return (
        urls.join(hosts, "host", "left")
        .withColumn("found", F.try_element_at(fitting, F.lit(1)))
        .select(
            "page_id",
            "host",
            "path",
            F.col("found.rule").alias("rule"),
            F.coalesce("found.verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        )
    )


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdicts on all of `pages`."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), RULES)


def oracle(rules: Sequence[tuple[str, str, str]] = RULES) -> str:
    """The query as DuckDB SQL; it goes on until no more than a hundredth of the tolerance can be on its way."""
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in rules)
    text = r"""
WITH RECURSIVE rules(rule_host, rule_path, rule_verdict) AS (VALUES @values),
urls AS (
  SELECT page_id, html,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT *, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)
),
fits AS (
  SELECT host, path, rule_host || rule_path AS rule, rule_verdict AS verdict,
    row_number() OVER (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC, rule_host || rule_path) AS place
  FROM (SELECT DISTINCT host, path FROM urls WHERE host <> '') u
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
),
seeds AS (
  SELECT verdict AS kind, host, count(*)::DOUBLE AS mass
  FROM urls JOIN fits USING (host, path) WHERE place = 1 GROUP BY verdict, host
),
links AS (
  SELECT host AS source,
    translate(regexp_extract(substr(href, instr(href, '://') + 3), '^[^/?#]*'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target
  FROM (SELECT host, unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']?([^"''\s>]+)', 1)) AS href
        FROM urls WHERE host <> '')
  WHERE contains(href, '://')
),
tree AS (
  SELECT host AS source, regexp_replace(host, '^[^.]*\.', '') AS target
  FROM (SELECT host FROM urls UNION SELECT target FROM links)
  WHERE host <> '' AND len(string_split(host, '.')) > 2
),
counted AS (
  SELECT source, target, count(*) AS n
  FROM (SELECT * FROM links UNION ALL SELECT * FROM tree UNION ALL SELECT target, source FROM tree)
  WHERE source <> target AND target <> '' GROUP BY source, target
),
weighted AS MATERIALIZED (SELECT source, target, n / sum(n) OVER (PARTITION BY source) AS weight FROM counted),
edges AS MATERIALIZED (
  SELECT 'allow' AS kind, source, target, weight FROM weighted
  UNION ALL SELECT 'block', target, source, weight / sum(weight) OVER (PARTITION BY target) FROM weighted
),
moving AS (
  SELECT 0 AS round, kind, host, mass * (1 - @damping) AS mass FROM seeds
  UNION ALL
  SELECT m.round + 1, m.kind, e.target, sum(m.mass * e.weight * @damping)
  FROM moving m JOIN edges e ON e.kind = m.kind AND e.source = m.host
  WHERE m.round < @rounds GROUP BY m.round, m.kind, e.target
),
blocked AS (
  SELECT host FROM (
    SELECT host, sum(CASE WHEN kind = 'allow' THEN mass ELSE 0 END) AS trust,
      sum(CASE WHEN kind = 'block' THEN mass ELSE 0 END) AS distrust FROM moving GROUP BY host
  ) JOIN (SELECT host, count(*) AS n FROM urls GROUP BY host) USING (host)
  WHERE distrust > @most * (trust + distrust + @prior * n)
)
SELECT page_id, u.host, u.path, f.rule,
  coalesce(f.verdict, CASE WHEN b.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM urls u LEFT JOIN fits f ON f.host = u.host AND f.path = u.path AND f.place = 1 LEFT JOIN blocked b ON b.host = u.host
"""
    rounds = rounds_needed(TOLERANCE / 100)
    parts = {"values": values, "rounds": rounds, "damping": DAMPING, "most": MOST_DISTRUST, "prior": PRIOR}
    for name, part in parts.items():
        text = text.replace(f"@{name}", str(part))
    return text
