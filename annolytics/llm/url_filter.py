"""URL filtering by nested prefix rules: a sort-merge range join.

A host becomes a key of its labels in reverse, each followed by a dot
(``blog.example.org`` -> ``org.example.blog.``).  All subdomains of a rule's
host then lie in one interval [key, key with the last dot replaced by '/'),
and any two intervals are nested or disjoint.  The sweep sorts interval
starts, interval ends and the distinct hosts of the URLs together; a boundary
carries the innermost rule host active from there on, and a host takes that of
the nearest boundary before it.  Its stack are the rule hosts among that host
and its parent domains, at most one a label.

The paths are swept the same way.  The paths of one rule host that start with
a rule's path lie in one interval too, so the rules' paths and the distinct
(rule host, path) pairs of the URLs are sorted together; a rule's path carries
the chain of the rule paths that it starts with itself, and a URL path takes
the chain of the nearest rule path before it: those of the chain that it
starts with are its rules.  A URL finally takes the longest of the rules on
its stack (longest host first among equally long).

Scale: both sweeps run over distinct keys, which are aggregated before the
shuffle, so a hot host or URL is one row.  The key space is cut at splitters
drawn by hash (at most ``slices``), and every slice begins with what is active
at its splitter; slices are swept independently.  The splitters (``slices``
strings) are all that the driver sees.  A host's row holds the labels of the
host, a rule's row the nested prefixes of its path: neither grows with the
number of rules.

Defined cases: a null URL or one without ``://`` has empty host and path and
meets no rule; a rule without a host fits nothing; duplicate rules collapse to one, and of two rules with one
(host, path) but different verdicts the block wins; hosts are lower-cased in
A-Z only; other columns of the input are kept out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolytics.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each with a dot after it; '' for an empty host."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _interval_end(key: Column) -> Column:
    return F.concat(key.substr(F.lit(1), F.length(key) - 1), F.lit("/"))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a frame."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _ancestors(key: Column) -> Column:
    """Keys of a host and of all its parent domains."""
    labels = F.split(key, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")),
    )


def _splitters(keys: DataFrame, slices: int) -> list[str]:
    """From each of ``slices`` hash classes the key with the least hash; at
    most that many strings reach the driver."""
    drawn = keys.groupBy(F.pmod(F.xxhash64("key"), F.lit(slices))).agg(F.min_by("key", F.xxhash64("key", F.lit(1))).alias("key"))
    return [r["key"] for r in drawn.collect()]


def _slice_of(cuts: list[str], key: Column) -> Column:
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<string>"), lambda c: c <= key))


def _last_before(events: DataFrame, asked: DataFrame, cuts: list[str]) -> DataFrame:
    """(key, found): for every asked key the ``found`` of the last event at or
    before it.  Events at one key are the same."""
    e = events.select(_slice_of(cuts, F.col("key")).alias("slice"), "key", F.lit(0).alias("kind"), "found")
    a = asked.select(_slice_of(cuts, F.col("key")).alias("slice"), "key", F.lit(1).alias("kind"), F.lit(None).cast(events.schema["found"].dataType).alias("found"))
    w = Window.partitionBy("slice").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = e.unionByName(a).withColumn("found", F.last("found", ignorenulls=True).over(w))
    return swept.filter("kind = 1").select("key", "found")


def _innermost(keys: DataFrame, rule_keys: DataFrame) -> DataFrame:
    """(key, found): the longest of ``rule_keys`` among a host key and its
    parent domains, '' if there is none."""
    up = keys.select("key", F.explode(_ancestors(F.col("key"))).alias("up"))
    hit = up.join(rule_keys.select(F.col("key").alias("up"), F.lit(True).alias("hit")), "up", "left")
    return hit.groupBy("key").agg(F.coalesce(F.max(F.when(F.col("hit"), F.struct(F.length("up"), "up")))["up"], F.lit("")).alias("found"))


def sweep(hosts: DataFrame, rules: DataFrame, slices: int = 256) -> DataFrame:
    """(key, stack) for every distinct host key: the keys of the rule hosts
    that hold it."""
    keys = rules.select("key").distinct()
    cuts = _splitters(hosts, slices)
    starts = keys.select("key", F.col("key").alias("found"))
    parent = F.expr("array_join(slice(split(key, '[.]'), 1, size(split(key, '[.]')) - 2), '.')")
    above = keys.select("key", F.when(parent == "", "").otherwise(F.concat(parent, F.lit("."))).alias("parent"))
    inner = _innermost(above.select(F.col("parent").alias("key")).distinct(), keys).withColumnRenamed("key", "parent")
    ends = above.join(inner, "parent").select(_interval_end(F.col("key")).alias("key"), "found")
    firsts = hosts.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cuts]).cast("array<string>")).alias("key"))
    # starts end in a dot and ends in a slash, so a place has one innermost host
    events = starts.unionByName(ends).unionByName(_innermost(firsts, keys)).distinct()
    swept = _last_before(events, hosts, cuts).filter("found <> ''")
    up = swept.select("key", F.explode(_ancestors(F.col("found"))).alias("up"))
    return up.join(keys.withColumnRenamed("key", "up"), "up").groupBy("key").agg(F.collect_set("up").alias("stack"))


def path_key(host_key: Column, path: Column) -> Column:
    """Rule host and path in one string that sorts by host, then path; hosts
    hold no slash."""
    return F.concat(host_key, F.lit("/"), path)


def _nested(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, chain): the rules whose key is a prefix of ``key``, by looking up
    the prefixes that are as long as some rule of the host."""
    lengths = rules.groupBy(F.col("key").alias("of")).agg(F.collect_set(F.length("path")).alias("lengths"))
    at = paths.withColumn("of", F.substring_index("key", "/", 1)).join(lengths, "of", "left")
    path = F.expr("substring(key, length(of) + 2)")
    cut = at.withColumn("path", path).select(
        "key", "of", "path", F.explode_outer(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n")
    )
    cut = cut.withColumn("rule_key", path_key(F.col("of"), F.expr("substring(path, 1, n)")))
    named = rules.select(path_key(F.col("key"), F.col("path")).alias("rule_key"), F.struct("path", "host", "rule", "verdict").alias("r"))
    return cut.join(named, "rule_key", "left").groupBy("key").agg(F.array_sort(F.collect_set("r")).alias("found"))


def sweep_paths(asked: DataFrame, rules: DataFrame, slices: int = 256) -> DataFrame:
    """(key, found) for every distinct key of ``asked`` (a ``path_key``): the
    longest rule of that rule host whose path the path starts with, or null."""
    cuts = _splitters(asked, slices)
    firsts = asked.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cuts]).cast("array<string>")).alias("key"))
    places = rules.select(path_key(F.col("key"), F.col("path")).alias("key")).unionByName(firsts).distinct()
    swept = _last_before(_nested(places, rules), asked, cuts)
    of, path = F.substring_index("key", "/", 1), F.expr("substring(key, length(substring_index(key, '/', 1)) + 2)")
    fits = F.filter("found", lambda r: F.startswith(path, r["path"]) & F.startswith(F.col("key"), path_key(host_key(r["host"]), r["path"])))
    best = F.array_max(F.transform(fits, lambda r: F.struct(F.length(r["path"]).alias("n"), r.alias("r"))))["r"]
    return swept.withColumn("of", of).select("key", best.alias("found"))


def judge_urls(
    df: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", slices: int = 256
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``df``.

    ``rules`` has verdict, host and path; ``rule`` in the result is the host
    and path of the rule that decides, null where the default does.
    """
    url = F.col(url_col)
    urls = df.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    r = rules.select(
        F.translate("host", UPPER, LOWER).alias("host"),
        "path",
        "verdict",
    ).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' > 'allow'
    # a rule without a host, or with one that no URL can have, fits nothing
    r = r.filter("host <> ''").filter(~F.col("host").rlike("[/?#]"))
    r = r.select(host_key(F.col("host")).alias("key"), F.concat("host", "path").alias("rule"), "host", "path", "verdict")
    r = materialize(r, "url-rules")
    hosts = materialize(urls.select("host").distinct().withColumn("key", host_key(F.col("host"))), "url-hosts")
    stacks = sweep(hosts.filter("host <> ''").select("key"), r, slices)
    stacks = materialize(hosts.join(stacks, "key").select("host", "stack"), "url-host-stacks")
    # distinct (host, path) of the URLs that any rule host holds
    pages = materialize(urls.select("host", "path").distinct().join(stacks, "host"), "url-pages")
    asked = pages.select("host", "path", F.explode("stack").alias("of")).withColumn("key", path_key(F.col("of"), F.col("path")))
    best = materialize(sweep_paths(asked.select("key").distinct(), r, slices).filter("found IS NOT NULL"), "url-path-rules")
    rank = F.struct(F.length("found.rule"), F.length("found.host"), F.col("found.rule").alias("rule"), F.col("found.verdict").alias("verdict"))
    verdicts = asked.join(best, "key").groupBy("host", "path").agg(F.max(rank).alias("best"))
    verdicts = materialize(verdicts.select("host", "path", "best.rule", "best.verdict"), "url-verdicts")
    j = urls.join(verdicts, ["host", "path"], "left")
    return j.select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
