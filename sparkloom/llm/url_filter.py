"""URL filters: rules on host and path, and for the rest link-graph propagation between hosts.

Pages that a rule allows give their host trust, pages that a rule blocks give it
distrust. Trust spreads along the edges between hosts (personalised PageRank),
distrust against them: who links to blocked hosts is distrusted. Both go through
the same rounds of one join and one sum, as rows of one table. A host is blocked
if its distrust exceeds its trust. DataFrame functions only; scores are whole
numbers, so a result doesn't depend on the order of a sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import cut

#: Score of one page; sums stay below 2^63 for up to 10^12 pages.
UNIT = 1 << 20
#: The longest name that the DNS allows; longer hosts have no parent domain.
MAX_HOST = 253
#: Edges of a host that a task joins with one row of its score; hosts with more get a row for each such part.
PART = 1024
TRUST, DISTRUST = 0, 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WS = r"[\x20\x09-\x0D]"
#: An absolute link; no two neighbouring repeats can match the same characters, so time stays linear.
LINK = rf"""(?i)<a(?:{WS}[^<>]*?)?["'\x20\x09-\x0D]href{WS}*={WS}*(?:["']{WS}*)?(?:https?:)?//([^/?#"'<>\x20\x09-\x0D]+)"""


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    allow: bool
    host: str
    path: str = "/"


@dataclass(frozen=True)
class Propagation:
    """damping: hundredths of a host's score that it passes on in each of ``rounds``.
    link, domain: weights of a linking page and of the edges between a host and its parent domain.
    A host is blocked if 100 times its distrust exceeds ``threshold`` times its trust."""

    rounds: int = 8
    damping: int = 85
    link: int = 4
    domain: int = 1
    threshold: int = 100


#: The rules of the query.
RULES = (Rule(True, "org", "/"), Rule(False, "example.org", "/es/"), Rule(False, "example.org", "/en/1"), Rule(True, "com", "/fr/"), Rule(False, "com", "/de/"))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://`` or for null."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, allow) of the longest rule that fits, null if none does; of equally long ones the one with the longer host, then a blocking one."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,allow:boolean>")
    known = F.array(*(F.struct(F.lit(len(r.host) + len(r.path)).alias("size"), F.lit(len(r.host)).alias("of_host"), F.lit(not r.allow).alias("block"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path")) for r in rules))
    fits = F.filter(known, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    best = F.array_max(fits)
    return F.when(best.isNotNull(), F.struct(F.concat(best["host"], best["path"]).alias("rule"), (~best["block"]).alias("allow")))


def link_edges(pages: DataFrame, host_col: str = "host", html_col: str = "html") -> DataFrame:
    """src, dst, n: pages of src that link to another host dst, from absolute links in the html; a page counts once for a host."""
    targets = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html_col), F.lit(LINK), 1), lambda t: F.translate(t, UPPER, LOWER)))
    linked = pages.filter(F.col(html_col).isNotNull() & (F.col(host_col) != "")).select(F.col(host_col).alias("src"), F.explode(targets).alias("dst"))
    return linked.filter("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def domain_edges(hosts: DataFrame) -> DataFrame:
    """src, dst: each host and its parent domain, up to names of two labels, in both directions."""
    labels = F.split("host", r"\.")
    depth = F.size(labels)
    named = hosts.filter((F.length("host") <= MAX_HOST) & (depth > 2))
    name = lambda i: F.array_join(F.slice(labels, i, depth), ".")
    steps = F.transform(F.sequence(F.lit(1), depth - 2), lambda i: F.struct(name(i).alias("src"), name(i + 1).alias("dst")))
    up = named.select(F.inline(steps)).distinct()
    return up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def propagate(seeds: DataFrame, links: DataFrame, domains: DataFrame, how: Propagation = Propagation()) -> DataFrame:
    """host, trust, distrust of every host that a score reaches.

    seeds: host, n_allow, n_block (pages). A host passes on its score in whole units
    by the weights of its edges, what rounding leaves is lost, and a host without edges keeps
    it to itself. Each round is one plan step: scores meet the edges, in parts of PART
    edges, and are summed up by host, before and after the shuffle, so neither a host
    with many links nor one that many link to is one task's work.
    """
    both = lambda kind, src, dst, w: F.struct(F.lit(kind).alias("kind"), F.col(src).alias("src"), F.col(dst).alias("dst"), w.alias("w"))
    of_links = links.select(F.inline(F.array(both(TRUST, "src", "dst", F.col("n") * how.link), both(DISTRUST, "dst", "src", F.col("n") * how.link))))
    of_domains = domains.select(F.inline(F.array(both(TRUST, "src", "dst", F.lit(how.domain).cast("long")), both(DISTRUST, "src", "dst", F.lit(how.domain).cast("long")))))
    edges = cut(of_links.unionByName(of_domains).groupBy("kind", "src", "dst").agg(F.sum("w").alias("w")), "url-edges")
    out = edges.groupBy("kind", "src").agg(F.sum("w").alias("total"), F.ceil(F.count("*") / PART).alias("parts"))
    start = seeds.select(F.inline(F.array(F.struct(F.lit(TRUST).alias("kind"), "host", (F.col("n_allow") * UNIT).alias("seed")), F.struct(F.lit(DISTRUST).alias("kind"), "host", (F.col("n_block") * UNIT).alias("seed"))))).filter("seed > 0")
    # a target's own number of parts and total go with the edges, so rounds need no other table
    ends = edges.join(out.select("kind", F.col("src").alias("dst"), F.col("total").alias("dst_total"), F.col("parts").alias("dst_parts")), ["kind", "dst"], "left")
    part = F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1)))
    ends = cut(ends.join(out.select("kind", "src", "parts"), ["kind", "src"]).select("kind", "src", part.alias("part"), "dst", "w", "dst_total", "dst_parts"), "url-ends")
    first = cut(start.join(out.withColumnRenamed("src", "host"), ["kind", "host"], "left").select("kind", "host", F.col("seed").alias("score"), "total", "parts"), "url-seeds")
    scores = first
    for _ in range(how.rounds):
        spread = scores.filter("total IS NOT NULL").select("kind", F.col("host").alias("src"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.expr(f"score div 100 * {how.damping} + score % 100 * {how.damping} div 100").alias("passed"), "total")
        met = spread.join(ends, ["kind", "src", "part"])
        moved = met.select("kind", F.col("dst").alias("host"), F.expr("passed div total * w + passed % total * w div total").alias("score"), F.col("dst_total").alias("total"), F.col("dst_parts").alias("parts"))
        scores = first.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"), F.max("total").alias("total"), F.max("parts").alias("parts"))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0))
    return scores.groupBy("host").agg(of(TRUST).alias("trust"), of(DISTRUST).alias("distrust"))


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, how: Propagation = Propagation(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id_col, host, path, rule, verdict, trust, distrust.

    rules: a list that people keep, so it is part of the plan. verdict is the rule's, else
    that of the host; a host that no score reaches is allowed, and so is the empty host of a
    null url or one without ``://``. Null html has no links. Repeated rows count and are
    returned as often as they occur; an empty table gives an empty result; other columns are ignored.
    """
    host, path = split_url(F.col(url_col))
    split = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    links = link_edges(split)
    judged = split.select("page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("found"))
    hosts = cut(judged.groupBy("host").agg(F.count_if("found.allow").alias("n_allow"), F.count_if(~F.col("found.allow")).alias("n_block")).filter("host <> ''"), "url-hosts")
    scores = cut(propagate(hosts, links, domain_edges(hosts), how), "url-scores").withColumnRenamed("host", "_host")
    block = F.col("distrust") * 100 > F.col("trust") * how.threshold
    # adaptive execution splits the pages of a host that holds a third of them
    met = judged.join(scores, F.col("host") == F.col("_host"), "left")
    verdict = F.when(F.coalesce(~F.col("found.allow"), block, F.lit(False)), "block").otherwise("allow")
    return met.select(F.col("page_id").alias(id_col), "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), F.coalesce("trust", F.lit(0)).alias("trust"), F.coalesce("distrust", F.lit(0)).alias("distrust"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the verdict on every page's url."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


def _oracle(rules: Sequence[Rule], how: Propagation) -> str:
    """The same rules and rounds in SQL."""
    link = LINK.replace("'", "''")
    low = lambda c: f"translate({c}, '{UPPER}', '{LOWER}')"
    known = ", ".join(f"('{r.host}', '{r.path}', {str(r.allow).lower()})" for r in rules)
    rounds = ""
    for i in range(how.rounds):
        rounds += f""", s{i + 1} AS MATERIALIZED (
  SELECT kind, host, CAST(sum(score) AS BIGINT) AS score FROM (
    SELECT * FROM s0 UNION ALL
    SELECT kind, dst, passed // total * w + passed % total * w // total
    FROM (SELECT kind, host AS src, score // 100 * {how.damping} + score % 100 * {how.damping} // 100 AS passed FROM s{i})
    JOIN edges USING (kind, src) JOIN outs USING (kind, src))
  GROUP BY ALL)"""
    return f"""WITH raw AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, html, {low("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(substring(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM raw),
keyed AS (SELECT *, row_number() OVER () AS row FROM split),
rules(rule_host, rule_path, allow) AS (VALUES {known}),
fits AS (SELECT row, arg_max(struct_pack(rule := rule_host || rule_path, allow := allow), length(rule_host || rule_path)) AS found FROM keyed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY row),
judged AS (SELECT keyed.*, found.rule AS rule, found.allow AS allow FROM keyed LEFT JOIN fits USING (row)),
linked AS (SELECT host AS src, {low("dst")} AS dst, row FROM (SELECT row, host, unnest(regexp_extract_all(html, '{link}', 1)) AS dst FROM keyed WHERE host <> '')),
links AS (SELECT src, dst, count(DISTINCT row) AS n FROM linked WHERE src <> dst GROUP BY ALL),
named AS (SELECT DISTINCT string_split(host, '.') AS l FROM keyed WHERE length(host) <= {MAX_HOST}),
up AS (SELECT DISTINCT array_to_string(l[i:], '.') AS src, array_to_string(l[i + 1:], '.') AS dst FROM (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM named)),
edges AS MATERIALIZED (SELECT kind, src, dst, CAST(sum(w) AS BIGINT) AS w FROM (
  SELECT 0 AS kind, src, dst, n * {how.link} AS w FROM links UNION ALL SELECT 1, dst, src, n * {how.link} FROM links
  UNION ALL SELECT k, src, dst, {how.domain} FROM up, (VALUES (0), (1)) t(k) UNION ALL SELECT k, dst, src, {how.domain} FROM up, (VALUES (0), (1)) t(k)) GROUP BY ALL),
outs AS (SELECT kind, src, CAST(sum(w) AS BIGINT) AS total FROM edges GROUP BY ALL),
s0 AS MATERIALIZED (SELECT CASE WHEN allow THEN 0 ELSE 1 END AS kind, host, count(*) * {UNIT} AS score FROM judged WHERE allow IS NOT NULL AND host <> '' GROUP BY ALL){rounds},
scores AS (SELECT host, CAST(coalesce(sum(score) FILTER (kind = 0), 0) AS BIGINT) AS trust, CAST(coalesce(sum(score) FILTER (kind = 1), 0) AS BIGINT) AS distrust FROM s{how.rounds} GROUP BY host)
SELECT page_id, host, path, rule, CASE WHEN coalesce(NOT allow, distrust * 100 > trust * {how.threshold}, false) THEN 'block' ELSE 'allow' END AS verdict, coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM judged LEFT JOIN scores USING (host)"""


ORACLE = _oracle(RULES, Propagation())
