"""URL filters: rules by host and path, and trust spread over the host graph for all other pages.

Trust starts at hosts whose pages the rules allow and follows links; distrust starts at hosts whose
pages the rules block and follows links backwards, to those who link there. Both are personalised
PageRank over host edges: score = seed + DAMPING * inflow, where a host passes its score on in equal
parts of its links and the seed is the share of its pages that the rules allow (block). A host
without links in or out thus keeps its seed. A page that no rule fits is blocked if its host's
distrust exceeds its trust by THRESHOLD.

All of it is DataFrame operations. Edges are counted per host pair before they are shuffled, and the
host table is what each round joins. Pages meet their host's scores by a join that deals the pages of
a hot host out over several tasks, as each round does with the links of a hot host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skein.llm.common import ascii_lower, dealt_join, free_name, hot_keys, shared_dir, skew_join, written

DAMPING = 0.85
#: Rounds end when no score moves by more than this, or this share of itself where it is above 1.
SETTLED = 1e-9
#: A score of n settles in about 130 + 14 ln(n) rounds at most, or something is wrong.
MAX_ROUNDS = 1000
THRESHOLD = 0.5
#: Rounds between checkpoints.
CUT_EVERY = 4

#: Fixed values: (verdict, host, path).
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_HREF = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    _, h, p = rule
    return ((host == h) | host.endswith("." + h)) & path.startswith(p)


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does; equal lengths: the first."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        mine = F.struct(F.lit(r[1] + r[2]).alias("rule"), F.lit(r[0]).alias("verdict"))
        out = F.when(_fits(host, path, r), mine).otherwise(out)
    return out


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages with host, path, rule and the rule's verdict (null without a rule)."""
    out = pages.drop("host", "path", "rule", "verdict")
    out = out.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    r = free_name(out, "__r")
    out = out.withColumn(r, longest_rule(F.col("host"), F.col("path"), rules))
    return out.withColumn("rule", F.col(f"{r}.rule")).withColumn("verdict", F.col(f"{r}.verdict")).drop(r)


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct links between different hosts: (src, dst, links)."""
    found = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))).alias("link"))
    pairs = found.select(F.col("host").alias("src"), host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link")).otherwise(F.col("link"))).alias("dst"))
    return pairs.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))


def spread(hosts: DataFrame, edges: DataFrame, rounds: int = MAX_ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) from hosts (host, pages, allowed, blocked) and edges (src, dst, links).
    Hosts that only occur as ends of links take part with no seed. Scores that are not settled after
    so many rounds are an error."""
    shared_dir(hosts.sparkSession)
    known = hosts.select("host", (F.col("allowed") / F.col("pages")).alias("t"), (F.col("blocked") / F.col("pages")).alias("d"))
    ends = edges.select(F.col("src").alias("host")).union(edges.select("dst")).distinct()
    seeds = known.join(ends, "host", "full").select("host", F.coalesce("t", F.lit(0.0)).alias("t"), F.coalesce("d", F.lit(0.0)).alias("d"))
    seed = F.explode(F.array(F.struct(F.lit("t").alias("kind"), F.col("t").alias("seed")), F.struct(F.lit("d").alias("kind"), F.col("d").alias("seed"))))
    seeds = seeds.select("host", seed.alias("s")).select("host", "s.kind", "s.seed").checkpoint()
    out_links = edges.groupBy("src").agg(F.sum("links").alias("all"))
    in_links = edges.groupBy("dst").agg(F.sum("links").alias("all"))
    forward = edges.join(out_links, "src").select(F.col("src").alias("host"), F.lit("t").alias("kind"), F.col("dst").alias("to"), (F.col("links") / F.col("all") * damping).alias("share"))
    back = edges.join(in_links, "dst").select(F.col("dst").alias("host"), F.lit("d").alias("kind"), F.col("src").alias("to"), (F.col("links") / F.col("all") * damping).alias("share"))
    passed = written(forward.union(back), "host-links")
    hot = hot_keys(passed.groupBy("host", "kind").agg(F.count("*").alias("n")), ["host", "kind"])
    score = seeds.withColumn("score", F.col("seed"))
    if not passed.isEmpty():
        for i in range(rounds):
            inflow = dealt_join(passed, score, ["host", "kind"], hot).groupBy(F.col("to").alias("host"), "kind").agg(F.sum(F.col("score") * F.col("share")).alias("in"))
            new = score.select("host", "kind", "seed", F.col("score").alias("was")).join(inflow, ["host", "kind"], "left")
            new = new.withColumn("score", F.col("seed") + F.coalesce("in", F.lit(0.0)))
            if (i + 1) % CUT_EVERY and i + 1 < rounds:
                score = new.drop("was", "in")
                continue
            new = new.checkpoint()
            moved = new.agg(F.max(F.abs(F.col("score") - F.col("was")) / F.greatest(F.lit(1.0), F.col("score")))).first()[0] or 0.0
            score = new.drop("was", "in")
            if moved <= SETTLED:
                break
        else:
            raise RuntimeError("scores did not settle")
    return score.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "t", F.col("score"))).alias("trust"), F.sum(F.when(F.col("kind") == "d", F.col("score"))).alias("distrust")
    )


def filter_urls(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow or block), trust and distrust.

    Defined results: a null url, or one without `://`, has an empty host and path, no rule and is
    allowed; null html has no links; repeated pages count as pages; an empty table gives no rows;
    columns beyond page_id, url and html are ignored.
    """
    table = judged(pages.select("page_id", "url", "html"), rules)
    ruled = table.select("page_id", "host", "path", "rule", "verdict")
    count = lambda v: F.sum(F.when(F.col("verdict") == v, 1).otherwise(0))
    hosts = ruled.where("host <> ''").groupBy("host").agg(F.count("*").alias("pages"), count("allow").alias("allowed"), count("block").alias("blocked"))
    scores = spread(hosts, written(host_edges(table.select("host", "html")), "host-edges"))
    per_host = scores.select("host", "trust", "distrust")
    known = ruled.where("host <> ''")
    method = F.when(F.coalesce(F.col("distrust") - F.col("trust"), F.lit(0.0)) >= threshold, "block").otherwise("allow")
    met = skew_join(known, per_host, ["host"], "left", hosts.select("host", F.col("pages").alias("n")))
    out = met.select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "trust", "distrust")
    none = F.lit(None).cast("double")
    return out.union(ruled.where("host = ''").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"), none, none))


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")


def _op7_sql() -> str:
    host = lambda c: f"translate(regexp_extract({c}, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cases = lambda what: " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if what == 'rule' else v}'"
        for v, h, p in sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
    )
    href = _HREF.removeprefix("(?is)").replace("'", "''")
    return f"""
WITH RECURSIVE u AS MATERIALIZED (SELECT page_id, html, coalesce({host('url')}, '') AS host, coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path FROM pages),
j AS MATERIALIZED (SELECT *, CASE {cases('rule')} END AS rule, CASE {cases('verdict')} END AS verdict FROM u),
l AS (SELECT host AS src, unnest(regexp_extract_all(html, '{href}', 1, 'is')) AS link FROM u),
e AS MATERIALIZED (SELECT src, dst, count(*) AS links FROM (SELECT src, {host("CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END")} AS dst FROM l)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),
passed AS MATERIALIZED (SELECT src, dst, 't' AS kind, {DAMPING} * links / sum(links) OVER (PARTITION BY src) AS share FROM e
  UNION ALL SELECT dst, src, 'd', {DAMPING} * links / sum(links) OVER (PARTITION BY dst) FROM e),
h AS MATERIALIZED (SELECT host, count(*) AS n, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS b FROM j WHERE host <> '' GROUP BY 1),
hosts AS MATERIALIZED (SELECT host FROM h UNION SELECT src FROM e UNION SELECT dst FROM e),
r0 AS MATERIALIZED (SELECT host, kind, seed, seed AS score FROM (SELECT hosts.host, 't' AS kind, coalesce(a / n, 0) AS seed FROM hosts LEFT JOIN h ON h.host = hosts.host
  UNION ALL SELECT hosts.host, 'd', coalesce(b / n, 0) FROM hosts LEFT JOIN h ON h.host = hosts.host)),
r AS (SELECT 0 AS i, host, kind, seed, score, CAST(1 AS DOUBLE) AS moved FROM r0 UNION ALL
  SELECT r.i + 1, r.host, r.kind, r.seed, r.seed + coalesce(f.inflow, 0), max(abs(r.seed + coalesce(f.inflow, 0) - r.score) / greatest(1, r.seed + coalesce(f.inflow, 0))) OVER ()
  FROM r LEFT JOIN (SELECT p.dst AS host, r.kind, sum(r.score * p.share) AS inflow FROM r JOIN passed p ON r.host = p.src AND r.kind = p.kind GROUP BY 1, 2) f
  ON r.host = f.host AND r.kind = f.kind WHERE r.moved > {SETTLED} AND r.i < {MAX_ROUNDS}),
s AS (SELECT host, sum(score) FILTER (kind = 'd') - sum(score) FILTER (kind = 't') AS net FROM r WHERE i = (SELECT max(i) FROM r) GROUP BY 1)
SELECT page_id, j.host, path, rule, coalesce(verdict, CASE WHEN coalesce(net, 0) >= {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN s ON j.host = s.host
"""


OP7_SQL = _op7_sql()
