"""URL filtering by rules and, where none fits, by trust propagated over the graph of hosts.

Rules (host, path) judge a url directly: a rule fits its host and all subdomains if the
url's path starts with the rule's; the longest rule wins. For the other urls the verdict is
their host's: personalised PageRank carries trust from hosts whose pages rules allow along
links, and distrust from hosts whose pages rules block against the links' direction. A
host's seed is the share of its pages that rules allow, or block; the seeds of each kind are
scaled to sum up to 1, so that both vectors have the same mass. A host is blocked if its
distrust is more than ``RATIO`` times its trust.

Edges lead from a page's host to the hosts it links to, weighted by the number of links, and
between a host and its parent domain (weight 1 each way); links within a host don't count.
A round is one join and one sum over both directions at once. Rounds go on, written to the
shared folder every ``CUT`` of them, until ``CUT`` rounds reach no new host and move less than
``tolerance`` of the mass; as mass fades by the damping and hosts are finite, they end. So a
host's verdict doesn't depend on its distance from a seed.

Only DataFrame functions run here. Links are summed up per pair of hosts before they are
exchanged. The steps out of a host that links to more than ``FAN`` others are dealt by a hash to
several keys, and its score is copied to each of them, so no task takes a hot host's links alone;
scores that meet at a hot host are summed in the tasks first. Nothing is collected but sums and
counts, or broadcast beyond what Spark decides from measured sizes.

Defined results: a null url, or one without ``://``, has empty host and path, no rule and
verdict allow; an empty path fits no rule; a page's html may be null; repeated rows give
repeated rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, LOWER, ready, staged, table

# fixed values: the rule list
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DAMPING = 0.85
TOLERANCE = 1e-3
CUT = 4
FAN = 10_000
RATIO = 2.0
ADDRESS = r"://([^/?#]*)([^?#]*)"
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def addresses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path) of every row."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    return pages.select(F.col(id_col).alias("page_id"), _lower(F.regexp_extract(url, ADDRESS, 1)).alias("host"),
                        F.regexp_extract(url, ADDRESS, 2).alias("path"))


def rule_table(spark, rules=None) -> DataFrame:
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in (RULES if rules is None else rules))
    if not rows:
        return spark.sql("select '' as on_host, '' as on_path, '' as says limit 0")
    return spark.sql(f"select * from values {rows} as t(on_host, on_path, says)")


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules that may fit a host, longest first, found by its domain suffixes."""
    labels = F.split("host", "\\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)),
                                   lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    found = hosts.select("host", suffix.alias("on_host")).join(rules, "on_host")
    return found.groupBy("host").agg(F.sort_array(F.collect_set(F.struct(
        F.length(F.concat("on_host", "on_path")).alias("size"), F.concat("on_host", "on_path").alias("rule"),
        F.col("on_path").alias("path"), "says")), asc=False).alias("rules"))


def judged(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, says) of ``addresses``: the longest rule that fits, if any."""
    spark = pages.sparkSession
    by_host = staged(spark, rules_by_host(pages.filter("host <> ''").groupBy("host").agg(F.lit(1)), rules), "url-rules")
    fits = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    return pages.join(by_host, "host", "left").withColumn("fit", fits).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.says").alias("says"))


def host_edges(pages: DataFrame, hosts: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, links) between different hosts."""
    own = _lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), ADDRESS, 1))
    to = F.explode(F.regexp_extract_all(F.coalesce(F.col(html_col).cast("string"), F.lit("")), F.lit(LINK), F.lit(1)))
    links = pages.select(own.alias("src"), to.alias("dst")).select("src", _lower(F.col("dst")).alias("dst"))
    parent = hosts.select("host", F.expr("substring(host, locate('.', host) + 1)").alias("up")).filter(
        F.locate(".", F.col("up")) > 0)
    both = parent.select(F.col("host").alias("src"), F.col("up").alias("dst")).unionByName(
        parent.select(F.col("up").alias("src"), F.col("host").alias("dst"))).distinct().withColumn("links", F.lit(1).cast("long"))
    counted = links.filter("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))
    return counted.unionByName(both).groupBy("src", "dst").agg(F.sum("links").alias("links"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, fan: int = FAN) -> DataFrame:
    """(host, trust, distrust) from seeds (host, good, bad) over edges (src, dst, links).

    Trust follows the edges and distrust goes against them; each host deals out its score in
    proportion to the links. Rows of both kinds run in one table, told apart by ``good``.
    """
    spark = seeds.sparkSession
    mass = seeds.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    kinds = [(True, "good", "src", "dst"), (False, "bad", "dst", "src")]
    moves = _union([edges.select(F.lit(good).alias("good"), F.col(at).alias("at"), F.col(to).alias("host"), "links") for good, _, at, to in kinds])
    out = staged(spark, moves.groupBy("good", F.col("at").alias("host")).agg(
        F.sum("links").alias("all"), F.expr(f"1 + (count(*) - 1) div {fan}").alias("keys")), "url-out")
    keyed = lambda df: df.join(out.select("good", "host", "keys"), ["good", "host"], "left").withColumn(
        "keys", F.coalesce("keys", F.lit(1).cast("long")))
    steps = staged(spark, keyed(moves.join(out.select("good", F.col("host").alias("at"), "all", F.col("keys").alias("of")), ["good", "at"]).select(
        "good", "at", "host", (F.lit(damping) * F.col("links") / F.col("all")).alias("share"),
        F.pmod(F.xxhash64("host"), F.col("of")).alias("key"))), "url-steps")
    start = staged(spark, keyed(_union([seeds.filter(F.col(c) > 0).select(
        F.lit(good).alias("good"), "host", (F.lit(1 - damping) * F.col(c) / F.lit(mass[c] or 1.0)).alias("score")) for good, c, _, _ in kinds])), "url-seeds")
    now, moving = start, True
    while moving:
        before = now
        for _ in range(CUT):
            sent = now.select("good", F.col("host").alias("at"), "score", F.explode(F.expr("sequence(0L, keys - 1)")).alias("key"))
            moved = sent.join(steps, ["good", "at", "key"]).select("good", "host", (F.col("score") * F.col("share")).alias("score"), "keys")
            now = moved.unionByName(start).groupBy("good", "host").agg(F.sum("score").alias("score"), F.max("keys").alias("keys"))
        now = staged(spark, now, "url-scores")
        old = before.select("good", "host", F.col("score").alias("old"))
        change = now.join(old, ["good", "host"], "left").agg(
            F.count(F.when(F.col("old").isNull(), 1)).alias("new"), F.sum(F.col("score") - F.coalesce("old", F.lit(0.0))).alias("mass")).first()
        moving = change["new"] > 0 or (change["mass"] or 0.0) > tolerance  # scores only grow from round to round
    return now.groupBy("host").agg(F.sum(F.when(F.col("good"), F.col("score")).otherwise(0.0)).alias("trust"),
                                   F.sum(F.when(~F.col("good"), F.col("score")).otherwise(0.0)).alias("distrust"))


def filter_urls(pages: DataFrame, rules=None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                damping: float = DAMPING, tolerance: float = TOLERANCE, ratio: float = RATIO) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust."""
    spark = ready(pages.sparkSession)
    found = staged(spark, judged(addresses(pages, id_col, url_col), rule_table(spark, rules)), "url-judged")
    share = lambda says: F.avg(F.when(F.col("says") == says, 1.0).otherwise(0.0))
    hosts = staged(spark, found.filter("host <> ''").groupBy("host").agg(share("allow").alias("good"), share("block").alias("bad")),
                   "url-hosts")
    edges = staged(spark, host_edges(pages, hosts, url_col, html_col), "url-edges")
    scores = staged(spark, propagate(hosts, edges, damping, tolerance), "url-trust")
    blocked = F.coalesce(F.col("distrust") > ratio * F.col("trust"), F.lit(False))
    return found.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("says", F.when(blocked, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")


def op3_url_filter(spark, sf_dir):
    """The verdict on every page's url."""
    ready(spark)
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    low = f"'{UPPER}', '{LOWER}'"
    return f"""
with recursive rules(on_host, on_path, says) as (values {rules}),
page as (
  select page_id, html, translate(regexp_extract(coalesce(url, ''), '{ADDRESS}', 1), {low}) as host,
         regexp_extract(coalesce(url, ''), '{ADDRESS}', 2) as path from pages),
found as (
  select page_id, host, path, html, (
    select arg_max({{'rule': on_host || on_path, 'says': says}}, length(on_host || on_path)) from rules
    where (host = on_host or ends_with(host, '.' || on_host)) and starts_with(path, on_path)) as fit
  from page),
hosts as (
  select host, avg(case when fit.says = 'allow' then 1.0 else 0.0 end) as good,
         avg(case when fit.says = 'block' then 1.0 else 0.0 end) as bad
  from found where host <> '' group by host),
up as (select host, substr(host, position('.' in host) + 1) as up from hosts),
edges as (
  select src, dst, sum(links) as links from (
    select host as src, translate(unnest(regexp_extract_all(coalesce(html, ''), '{LINK.replace("'", "''")}', 1)), {low}) as dst, 1 as links from found
    union all select host, up, 1 from up where contains(up, '.')
    union all select distinct up, host, 1 from up where contains(up, '.'))
  where src <> '' and dst <> '' and src <> dst group by src, dst),
steps as materialized (
  select true as good, src as at, dst as host, links / sum(links) over (partition by src) as share from edges
  union all select false, dst, src, links / sum(links) over (partition by dst) from edges),
given as materialized (
  select true as good, host, {1 - DAMPING!r} * good / (select sum(good) from hosts) as score from hosts where good > 0
  union all select false, host, {1 - DAMPING!r} * bad / (select sum(bad) from hosts) from hosts where bad > 0),
walk(i, good, host, score) as (
  select 0, good, host, score from given
  union all
  select w.i + 1, s.good, s.host, sum({DAMPING} * w.score * s.share) from walk w join steps s on w.good = s.good and w.host = s.at
  where w.i < (select count(*) + 150 from hosts) group by w.i + 1, s.good, s.host),
trust as (
  select host, sum(case when good then score else 0 end) as trust, sum(case when good then 0 else score end) as distrust
  from walk group by host)
select page_id, found.host, path, fit.rule as rule,
       coalesce(fit.says, case when distrust > {RATIO} * trust then 'block' else 'allow' end) as verdict
from found left join trust using (host)"""


# the walk sums up the same scores by distance from the seeds, farther than any host can be
OP3_SQL = _sql()
