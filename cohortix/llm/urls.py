"""URL filters by a sort-merge range join.

A host is turned round label by label with a closing dot (``www.a.org`` gives
``org.a.www.``), so that a rule's host and all its subdomains are one interval
of keys: those that start with the rule's key.  Rules and pages are sorted
together by that key; one sweep over each range of the sorted rows keeps a
stack of the rules whose interval is open, one level per host, and a page takes
the longest rule on the stack whose path its own path starts with.

Ranges are cut by Spark over (key, kind, path, page_id), so one host with a
third of the pages is spread over many ranges.  Rules that opened in an earlier
range and are still open at the head of a range are found by joining the label
prefixes of each range's first key with the rules (ranges x labels rows).

Defined results: a null url or one without ``://`` has empty host and path and
fits no rule; of rules that fit, the longest host + path wins, then the longer
host, then block before allow; repeated rules count once and repeated pages are
all kept; an empty path fits no rule whose path is ``/``; a page without a rule
gets the default verdict; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import LOWER, UPPER, stored, table

#: verdict, host, path
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
DEFAULT_VERDICT = "allow"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, shape, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, shape, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _sweep(default: str):
    def run(batches):
        part, stack = None, []  # stack: [key, {path: (rank, rule, verdict)}, path lengths]
        for rows in batches:
            out = []
            for at, kind, key, path, page, host, verdict in zip(
                rows["_part"], rows["kind"], rows["key"], rows["path"], rows["page_id"], rows["host"], rows["verdict"], strict=True
            ):
                if at != part:
                    part, stack = at, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind < 1:
                    if not stack or stack[-1][0] != key:
                        stack.append([key, {}, []])
                    _, known, lengths = stack[-1]
                    new = ((len(host) + len(path), len(host), verdict == "block"), host + path, verdict)
                    known[path] = max(known.get(path, new), new)
                    if len(path) not in lengths:
                        lengths.append(len(path))
                        lengths.sort(reverse=True)
                    continue
                best = ((-1, 0, False), None, default)
                for _, known, lengths in stack:
                    found = next((known[path[:n]] for n in lengths if path[:n] in known), None)
                    if found and found[0] > best[0]:
                        best = found
                out.append((page, host, path, best[1], best[2]))
            yield pd.DataFrame(out, columns=["page_id", "host", "path", "rule", "verdict"])

    return run


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url);
    ``rules`` has verdict, host, path."""
    host, path = url_parts(F.col("url"))
    id_type = pages.schema["page_id"].dataType.simpleString()
    pages = pages.select("page_id", host.alias("host"), path.alias("path")).select(
        F.lit(1).alias("kind"), host_key(F.col("host")).alias("key"), "path", "page_id", "host", F.lit(None).cast("string").alias("verdict")
    )
    rules = rules.select(
        F.lit(0).alias("kind"), host_key(F.translate("host", UPPER, LOWER)).alias("key"), "path",
        F.lit(None).cast(id_type).alias("page_id"), F.translate("host", UPPER, LOWER).alias("host"), "verdict",
    ).distinct()
    order = ["key", "kind", "path", "page_id"]
    rows = stored(rules.unionByName(pages).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "urls")
    heads = rows.groupBy("_part").agg(F.min("key").alias("head"))
    labels = F.split(F.col("head"), r"\.")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit("."))
    )
    carried = heads.select("_part", F.explode(prefixes).alias("key")).join(rules, "key").withColumn("kind", F.lit(-1))
    swept = rows.unionByName(carried).repartition("_part")
    # carried rules sort before all else in their range; their keys are prefixes of its first key
    swept = swept.sortWithinPartitions("_part", F.least(F.col("kind"), F.lit(0)), *order)
    return swept.mapInPandas(_sweep(default), f"page_id {id_type}, host string, path string, rule string, verdict string")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


SQL = r"""
WITH parts AS (
  SELECT page_id, row_number() OVER () AS rid,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
)
SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
  coalesce(arg_max(verdict, length(rhost || rpath)), 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
GROUP BY rid, page_id, host, path
"""
