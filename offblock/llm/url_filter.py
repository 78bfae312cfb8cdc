"""Operator 2, URL filters: host-suffix and path-prefix expressions, hash-prefix join.

Each url is expanded into the suffixes of its host (at label bounds) joined with the
prefixes of its path that end in a slash, and the empty prefix, as far as a rule has
so many labels and slashes. Rules are filed under the same kind of expression: host
+ path up to its last slash. The
equi-join is on a short prefix of the expression's SHA-256; the full digests,
then the whole rule path, confirm a match. The longest rule (host and path
characters) wins; among equally long ones block wins, then the greater text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a digest that the join compares.
PREFIX_BYTES = 4


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or without ://."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.char_length(url))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def _count(c: Column, mark: str) -> Column:
    return F.char_length(c) - F.char_length(F.replace(c, F.lit(mark), F.lit("")))


def _digest(expr: Column) -> Column:
    return F.sha2(expr.cast("binary"), 256)


def shapes_of(rules: DataFrame) -> list[tuple[int, int]]:
    """The distinct (labels of the host, slashes of the path) of a rule table; as many as its longest rules allow."""
    return sorted((r["labels"], r["slashes"]) for r in rules.select("labels", "slashes").distinct().collect())


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The host suffixes of so many labels with the path prefixes of so many slashes (none: the empty one), for each shape the url has.

    Other suffixes and prefixes could not meet a rule, and a url's work is linear in its length for each shape.
    """
    one = [F.struct(F.lit(k).alias("labels"), F.lit(d).alias("slashes")) for k, d in shapes]
    fit = F.filter(F.array(*one).cast("array<struct<labels:int,slashes:int>>"),
                   lambda x: (x["labels"] <= _count(host, ".") + 1) & (x["slashes"] <= _count(path, "/")))
    prefix = lambda d: F.when(d > 0, F.concat(F.call_function("substring_index", path, F.lit("/"), d), F.lit("/"))).otherwise("")
    return F.transform(fit, lambda x: F.concat(F.call_function("substring_index", host, F.lit("."), -x["labels"]), F.lit(" "), prefix(x["slashes"])))


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules (verdict, host, path) with their shape and the digest of the expression they are filed under."""
    r = rules.select(F.col("verdict").alias("r_verdict"), lower_ascii(F.col("host")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"))
    r = r.where("r_host is not null")
    filed = F.concat("r_host", F.lit(" "), F.regexp_extract("r_path", r"(?s)^(.*/)?", 0))
    d = _digest(filed)
    return r.select("*", (_count(F.col("r_host"), ".") + 1).alias("labels"), _count(F.col("r_path"), "/").alias("slashes"), d.alias("r_digest"), F.substring(d, 1, 2 * PREFIX_BYTES).alias("r_short"))


def match_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) for each distinct host and path with a rule.

    Rules small enough for spark.sql.autoBroadcastJoinThreshold (in bytes) are
    broadcast by Spark; a larger list is joined by shuffle, with AQE's skew join
    for hot expressions such as a common top-level domain.
    """
    rules = rule_table(rules)
    e = urls.select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), shapes_of(rules))).alias("e"))
    e = e.select("host", "path", _digest(F.col("e")).alias("digest"))
    hit = e.join(rules.drop("labels", "slashes"), F.substring("digest", 1, 2 * PREFIX_BYTES) == F.col("r_short"))
    hit = hit.where((F.col("digest") == F.col("r_digest")) & F.col("path").startswith(F.col("r_path")))
    rule = F.concat("r_host", "r_path")
    rank = F.struct(F.char_length(rule).alias("n"), (F.col("r_verdict") == "block").cast("int").alias("b"),
                    F.hex(rule.cast("binary")).alias("s"))
    best = F.max_by(F.struct(rule.alias("rule"), F.col("r_verdict").alias("verdict")), rank)
    return hit.groupBy("host", "path").agg(best.alias("m")).select("host", "path", "m.rule", "m.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row; without a rule: null and the default verdict.

    Repeated urls are judged once. Null, empty and malformed urls have an empty
    host and path, which no rule fits; they go round the join. A url may be of any
    length. Repeated rows and ids are judged row by row; rules that tie go as said
    above. An empty table gives no rows, without rules every url has the default.
    Other columns, whatever their names, are not read.
    """
    h, p = host_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), h.alias("host"), p.alias("path"))
    named = rows.where("host <> ''")
    out = named.join(match_urls(named.select("host", "path").distinct(), rules), ["host", "path"], "left")
    none = F.lit(None).cast("string")
    out = out.unionByName(rows.where("host = ''").withColumns({"rule": none, "verdict": none}))
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


#: The contract's rules: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op2_url_filter(pages: DataFrame) -> DataFrame:
    # literals, so that Catalyst knows the size
    rules = pages.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in RULES])))
    return filter_urls(pages, rules)


OP2_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url IS NOT NULL AND instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), hp AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') AS path
  FROM u
), j AS (
  SELECT *,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM hp
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""
