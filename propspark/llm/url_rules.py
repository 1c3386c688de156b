"""URL filters as a sort-merge range join.

A host becomes its labels in reverse order with a closing dot
(``a.example.org`` -> ``org.example.a.``), so a rule's host covers exactly
the interval of keys that start with its own key.  Intervals of such keys
are nested or disjoint.  Rule hosts open and close in a sorted sweep over the
url keys; each event row carries the stack of rules active after it, and each
url takes the stack of the last event before it and the longest rule in the
stack whose path starts the url's path.

Urls are cut into key ranges by sampled splitters on (key, salt), so that a
host with a third of all urls is spread over many ranges; every range gets an
opening event with the stack at its lower end.  Only DataFrame functions.
Event rows follow the rule list; urls are shuffled once.

Results for odd input: a null url, or one without ``://``, has an empty host
and path and gets the default verdict unless a rule has an empty host and
path; repeated rows are judged alike; of equally long rules the one with the
longer host wins, then the smaller string, then the smaller verdict; a rule
with null host or path is ignored; an empty table gives an empty result;
other columns are carried through.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propspark.llm import ranges

TARGET_ROWS = 1024
_KEY = "struct<k:string,s:bigint>"
_RULE = "struct<path:string,rule:string,verdict:string,size:int,host_size:int>"


def url_host(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(_u, instr(_u, '://') + 3)"))
    return F.translate(F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), F.lit("")),
                       ascii_uppercase, ascii_lowercase)


def url_path(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(_u, instr(_u, '://') + 3)"))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _ancestors(key: Column) -> Column:
    """The key itself and all shorter keys of whole labels."""
    labels = F.split(F.expr("substring(k, 1, length(k) - 1)"), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))


def _stacks(at: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of ``at`` (column k) with ``stack``: the rules of all rule hosts
    whose interval holds the key, and ``outer``: the same without k's own."""
    up = at.select("*", F.explode(_ancestors(F.col("k"))).alias("up"))
    keys = [c for c in at.columns]
    found = up.join(nodes.select(F.col("k").alias("up"), "rules"), "up", "left")
    own = F.col("up") == F.col("k")
    empty = F.lit(None).cast(f"array<{_RULE}>")
    return found.groupBy(*keys).agg(
        F.flatten(F.collect_list(F.col("rules"))).alias("stack"),
        F.flatten(F.collect_list(F.when(own, empty).otherwise(F.col("rules")))).alias("outer"))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url",
               default: str = "allow", target_rows: int = TARGET_ROWS) -> DataFrame:
    """``pages`` as struct ``row`` with ``host``, ``path``, ``rule`` and
    ``verdict``.  ``rules`` has string columns host, path, verdict; a path
    ends up behind a ``/`` as written, an empty path fits every url."""
    spark = pages.sparkSession
    nodes = (rules.filter("host IS NOT NULL AND path IS NOT NULL")
             .withColumn("host", F.translate("host", ascii_uppercase, ascii_lowercase))
             .groupBy(host_key(F.col("host")).alias("k"))
             .agg(F.collect_set(F.struct(
                 F.col("path"), F.concat("host", "path").alias("rule"), F.col("verdict"),
                 (F.length("host") + F.length("path")).cast("int").alias("size"),
                 F.length("host").cast("int").alias("host_size"))).alias("rules")))
    u = F.col("_u")
    urls = (pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
                         F.col(f"`{url_col}`").alias("_u"))
            .select("row", url_host(u).alias("host"), url_path(u).alias("path"),
                    F.xxhash64("row").alias("s"))
            .withColumn("k", host_key(F.col("host"))))

    n = pages.count()
    sample = ranges.sample_rows(urls.select("k", "s"), n)
    buckets, parts = ranges.buckets_for(n, target_rows)
    splitters = ranges.pick_splitters([(r["k"], r["s"]) for r in sample], buckets)
    urls = (urls.withColumn("bucket", ranges.bucket_of(F.struct("k", "s"), splitters, _KEY))
            .withColumn("part", F.pmod(F.xxhash64("s"), F.lit(parts)).cast("int")))

    # Events: (key, salt, rank) with the stack active from there on.
    opened = _stacks(nodes.select("k"), nodes)
    low = F.lit(-2**63).cast("bigint")
    starts = opened.select("k", low.alias("s"), F.lit(0).alias("rank"), F.col("stack"))
    ends = opened.select(F.concat(F.expr("substring(k, 1, length(k) - 1)"), F.lit("/")).alias("k"),
                         low.alias("s"), F.lit(-1).alias("rank"), F.col("outer").alias("stack"),
                         F.length("k").alias("depth"))
    # Several rule hosts may close at one key only if they are equal: keys differ.
    events = (starts.unionByName(ends.drop("depth"))
              .withColumn("bucket", ranges.bucket_of(F.struct("k", "s"), splitters, _KEY)))
    if splitters:
        lower = spark.createDataFrame([(i + 1, k, s) for i, (k, s) in enumerate(splitters)],
                                      "bucket int, k string, s bigint")
        opening = (_stacks(lower, nodes)
                   .select("k", "s", F.lit(-2).alias("rank"), "stack", "bucket"))
        events = events.unionByName(opening)
    if parts > 1:
        events = events.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    else:
        events = events.withColumn("part", F.lit(0))

    row_type = dict(urls.dtypes)["row"]
    both = urls.select("bucket", "part", "k", "s", F.lit(1).alias("rank"), "row", "host", "path",
                       F.lit(None).cast(f"array<{_RULE}>").alias("stack")).unionByName(
        events.select("bucket", "part", "k", "s", "rank", F.lit(None).cast(row_type).alias("row"),
                      F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"),
                      "stack"))
    sweep = (Window.partitionBy("bucket", "part").orderBy("k", "s", "rank")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = both.withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).filter("rank = 1")
    fits = F.filter("active", lambda r: F.startswith(F.col("path"), r["path"]))
    # Longest first; ties by the longer host, then the smaller strings.
    best = F.try_element_at(F.array_sort(fits, lambda a, b: F.when(a["size"] != b["size"], b["size"] - a["size"])
                                     .when(a["host_size"] != b["host_size"], b["host_size"] - a["host_size"])
                                     .when(a["rule"] != b["rule"], F.when(a["rule"] < b["rule"], -1).otherwise(1))
                                     .when(a["verdict"] < b["verdict"], -1)
                                     .when(a["verdict"] > b["verdict"], 1).otherwise(0)), F.lit(1))
    return (swept.withColumn("best", best)
            .select("row", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
