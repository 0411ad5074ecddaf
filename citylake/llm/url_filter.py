"""URL filters by link-graph propagation, with DataFrame operations only.

Rules (host and path prefix, the longest wins) judge the urls they fit. All other urls get the verdict of
their host from the host graph:

* *Edges.* Absolute links (``href`` and ``src`` with a host) point from a page's host to the host named, weighted by
  the number of pages; a host and its parent domain point to one another, and so on up to the last label,
  whether or not the domains above have pages of their own.
* *Seeds.* A host's trust seed is its number of pages that rules allow, its distrust seed the number they block.
* *Propagation.* Trust is personalised PageRank from the trust seeds along the edges; distrust is the same from
  the distrust seeds along reversed edges, so it reaches hosts that point to blocked ones. Both run in one
  join and one combined sum per round, ``ROUNDS`` rounds with damping ``DAMPING``.
* *Threshold.* A host is blocked if its distrust is over ``RATIO`` times its trust, and allowed else (also without
  any evidence).

Edges and scores are one row per host pair and host; pages meet scores in one join by host, whose hot keys Spark
splits. Every fourth round is written to the shared folder to cut the lineage.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule, and is allowed; a null
html has no links; repeated rows are judged alike and count as often as they occur; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm import common

#: Fixed values: (host, path prefix, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DAMPING = 0.7
ROUNDS = 12
RATIO = 1.0
_LINK = r"(?i)(?:href|src)\s*=\s*[\"']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#\"'\s>]+)"


def _lowered(column) -> F.Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def located(pages: DataFrame) -> DataFrame:
    """page_id, html, and the host and path of the url."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return pages.select(
        "page_id",
        F.col("html").cast("string").alias("html"),
        _lowered(F.regexp_extract(url, "://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1).alias("path"),
    )


def rule_columns(rules=RULES) -> tuple[F.Column, F.Column]:
    """The fitting rule (its string) and its verdict, null if none fits; reads host and path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, judged in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, host + path).otherwise(name), F.when(fits, judged).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts; reads host and html."""
    links = pages.where("host <> ''").select(
        F.col("host").alias("src"), F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), 1))).alias("dst")
    )
    links = links.select("src", _lowered(F.col("dst")).alias("dst"))
    labels = pages.where("host <> ''").select("host").distinct().select(F.split("host", "[.]").alias("l"))
    domains = labels.select(F.expr("explode(transform(sequence(1, size(l)), i -> array_join(slice(l, i, size(l)), '.')))").alias("src")).distinct()
    family = domains.select("src", F.expr("regexp_replace(src, '^[^.]*[.]?', '')").alias("dst")).where("src <> '' AND dst <> ''")
    family = family.union(family.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return links.union(family).where("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) from edges (src, dst, weight) and seeds (host, allowed, blocked)."""
    # Reversed edges carry distrust: both kinds are steps of one table.
    steps = edges.select(F.lit(0).alias("kind"), F.col("src").alias("at"), F.col("dst").alias("to"), "weight").union(
        edges.select(F.lit(1).alias("kind"), F.col("dst").alias("at"), F.col("src").alias("to"), "weight")
    )
    steps = common.written(steps, "steps")
    out = steps.groupBy("kind", "at").agg(F.sum("weight").alias("out"))
    steps = common.written(steps.join(out, ["kind", "at"]).select("kind", "at", "to", (F.col("weight") / F.col("out")).alias("part")), "steps")
    total = seeds.agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")).first()  # one row
    seeded = seeds.select("host", F.expr("stack(2, 0, allowed, 1, blocked) as (kind, n)"))
    share = F.when(F.col("kind") == 0, F.lit(float(total["allowed"] or 1))).otherwise(F.lit(float(total["blocked"] or 1)))
    base = common.written(seeded.where("n > 0").select("kind", "host", (F.col("n") / share).alias("seed")), "seeds")
    state = base.select("kind", "host", F.col("seed").alias("score"))
    for k in range(1, rounds + 1):
        moved = steps.join(state.withColumnRenamed("host", "at"), ["kind", "at"]).select(
            "kind", F.col("to").alias("host"), (F.lit(damping) * F.col("part") * F.col("score")).alias("score")
        )
        restart = base.select("kind", "host", ((1 - F.lit(damping)) * F.col("seed")).alias("score"))
        state = moved.union(restart).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if k % 4 == 0 or k == rounds:
            state = common.written(state, "ranks")
    return state.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == 1, F.col("score")).otherwise(0.0)).alias("distrust"),
    )


def judged(pages: DataFrame, rules=RULES, ratio: float = RATIO) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust."""
    name, verdict = rule_columns(rules)
    rows = located(pages)
    ruled = rows.withColumn("rule", name).withColumn("ruled", verdict)
    light = common.written(ruled.drop("html"), "urls")
    seeds = light.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked")
    )
    ranks = propagate(host_edges(rows), common.written(seeds, "host-seeds"))
    ranks = common.written(ranks, "hosts")
    # Sums in another order differ in the last digits: equal scores are not over the ratio.
    host_verdict = F.when(F.col("distrust") > F.lit(ratio) * F.col("trust") + 1e-9, "block").otherwise("allow")
    return light.join(ranks, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", host_verdict).alias("verdict"), "trust", "distrust"
    )


def op2_link_graph(spark, sf_dir: str) -> DataFrame:
    """Verdicts of all pages."""
    pages = common.prepared(spark).read.parquet(f"{sf_dir}/pages.parquet")
    return judged(pages).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    ranked = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    tests = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in ranked]
    rule = "CASE " + " ".join(f"{t} THEN '{h}{p}'" for t, (h, p, _) in zip(tests, ranked)) + " END"
    ruled = "CASE " + " ".join(f"{t} THEN '{v}'" for t, (_, _, v) in zip(tests, ranked)) + " END"
    link = _LINK.replace("'", "''")
    up, low = string.ascii_uppercase, string.ascii_lowercase
    rounds = []
    for k in range(1, ROUNDS + 1):
        rounds.append(
            f"r{k} AS MATERIALIZED (SELECT kind, host, sum(score) AS score FROM ("
            f"SELECT s.kind, s.dst AS host, {DAMPING} * s.part * r.score AS score FROM steps s JOIN r{k - 1} r ON s.kind = r.kind AND s.src = r.host "
            f"UNION ALL SELECT kind, host, (1 - {DAMPING}) * score FROM r0) GROUP BY ALL)"
        )
    return f"""
WITH rows_ AS MATERIALIZED (
  SELECT page_id, coalesce(html, '') AS html,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{up}', '{low}') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
ruled AS MATERIALIZED (SELECT page_id, html, host, path, {rule} AS rule, {ruled} AS ruled FROM rows_),
labels AS (SELECT DISTINCT string_split(host, '.') AS l FROM ruled WHERE host <> ''),
domains AS (SELECT DISTINCT array_to_string(l[i:], '.') AS a FROM (SELECT l, unnest(range(1, len(l) + 1)) AS i FROM labels)),
family AS (SELECT a, regexp_replace(a, '^[^.]*[.]?', '') AS b FROM domains WHERE a <> '' AND regexp_replace(a, '^[^.]*[.]?', '') <> ''),
links AS (
  SELECT host AS a, translate(unnest(list_distinct(regexp_extract_all(html, '{link}', 1))), '{up}', '{low}') AS b FROM ruled WHERE host <> ''
  UNION ALL SELECT a, b FROM family UNION ALL SELECT b, a FROM family
),
edges AS (SELECT a, b, count(*) AS w FROM links WHERE a <> b GROUP BY ALL),
both_ AS (SELECT 0 AS kind, a AS src, b AS dst, w FROM edges UNION ALL SELECT 1, b, a, w FROM edges),
steps AS MATERIALIZED (SELECT kind, src, dst, w / sum(w) OVER (PARTITION BY kind, src) AS part FROM both_),
r0 AS MATERIALIZED (
  SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS score FROM (
    SELECT CASE ruled WHEN 'allow' THEN 0 ELSE 1 END AS kind, host, count(*) AS n
    FROM ruled WHERE host <> '' AND ruled IS NOT NULL GROUP BY ALL)
),
{", ".join(rounds)},
ranks AS (
  SELECT host, sum(CASE kind WHEN 0 THEN score ELSE 0 END) AS trust, sum(CASE kind WHEN 1 THEN score ELSE 0 END) AS distrust
  FROM r{ROUNDS} GROUP BY host
)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN distrust > {RATIO} * trust + 1e-9 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN ranks USING (host)
"""


OP2_SQL = _sql()
