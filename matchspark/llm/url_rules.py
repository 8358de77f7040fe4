"""URL rules: a sort-merge range join over reversed-host keys, in DataFrame functions only.

A key is the host's labels from the last to the first, each closed by a dot, and then the path:
``www.example.org/a`` gives ``org.example.www./a``. A rule is the interval of all keys that begin with
its own key. A url is probed once per domain it lies in (``org./a``, ``org.example./a``, ...), so a
rule fits the url exactly if one of the probes falls into the rule's interval.

Probes and the two ends of every interval are sorted together. While they are swept in that order,
a stack holds the rules that are open: the running sum of ends is the stack's height, and slot ``k`` is
the last rule that opened at height ``k``. The top of the stack is the longest rule on that domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchspark.llm.common import Numbered

RESULT = ("host", "path", "rule", "verdict")


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), upper, upper.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    return F.encode(F.concat(F.array_join(labels, "."), F.lit("."), path), "UTF-8")


def _prepared(rules: DataFrame) -> DataFrame:
    host = F.translate(F.col("host"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (
        rules.where("host IS NOT NULL AND action IN ('allow', 'block')")
        .select(host.alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "action")
        .groupBy("r_host", "r_path")
        .agg(F.max("action").alias("action"))
        .select("*", _key(_labels(F.col("r_host")), F.col("r_path")).alias("key"))
    )


def _block(key: Column, bounds: list[bytes]) -> Column:
    """Number of bounds at or below the key."""
    if not bounds:
        return F.lit(0)
    known = F.array(*[F.lit(bytearray(b)) for b in bounds])
    return F.size(F.filter(known, lambda b: b <= key))


def _ends(rules: DataFrame, bounds: list[bytes]) -> DataFrame:
    """Both ends of every rule, in every block the rule reaches into."""
    last = F.concat(F.col("key"), F.lit(bytearray(b"\xff")))
    reach = F.explode(F.sequence(_block(F.col("key"), bounds), _block(last, bounds))).alias("block")
    frame = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("size"), F.length("r_host").alias("host_size"),
        "action", F.concat("r_host", "r_path").alias("rule"),
    )
    spread = rules.select("key", frame.alias("frame"), reach)
    one = spread.select("block", "key", F.lit(1).alias("step"), "frame")
    other = spread.select("block", F.concat("key", F.lit(bytearray(b"\xff"))).alias("key"), F.lit(-1), F.lit(None))
    return one.union(other)


def judge_urls(
    urls: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    rules_per_block: int = 100_000,
) -> DataFrame:
    """Every row of ``urls`` with host, path, the rule that decides, and the verdict.

    ``rules`` has host, path and action (``allow`` or ``block``). A rule fits its host and all subdomains
    if the path begins with the rule's path; the longest (host plus path, then host) wins. Where none
    fits, ``rule`` is null and the verdict is ``default``.

    The key space is cut into blocks of about ``rules_per_block`` rules, and each block into as many
    equal shares of its probes as its part of all probes asks for, so neither a host with a third of
    all urls nor a domain with many rules meets in one task. A rule is repeated once per share.
    Equal (host, path) pairs are judged once.

    Null urls and urls without ``://`` have empty host and path and get the default. A rule without a
    host or with another action is ignored, a null path is empty; of rules for the same host and path,
    ``block`` wins. Input columns named host, path, rule or verdict are replaced. Empty tables are fine.
    """
    rows = Numbered(urls)
    named = rows.df.withColumns({"__host": url_host(F.col(rows[url])), "__path": url_path(F.col(rows[url]))})
    kept = rows.columns(leave=RESULT)
    rules = _prepared(rules)
    n_rules, depth_of_hosts = rules.agg(F.count("*"), F.max(F.size(F.split("r_host", r"\.")))).first()
    if not n_rules:
        return named.select(
            *kept, F.col("__host").alias("host"), F.col("__path").alias("path"),
            F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"),
        )

    bounds: list[bytes] = []
    if n_rules > rules_per_block:
        cut = rules.repartitionByRange(-(-n_rules // rules_per_block), "key")
        lowest = cut.groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("key")).collect()
        bounds = sorted(bytes(r.key) for r in lowest)[1:]

    asked = named.select("__host", "__path").distinct()
    labels = _labels(F.col("__host"))
    near = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth_of_hosts)))
    probes = asked.select("__host", "__path", labels.alias("labels"), F.explode(near).alias("n")).select(
        "__host", "__path", _key(F.slice("labels", 1, F.col("n")), F.col("__path")).alias("key")
    )
    probes = probes.withColumn("block", _block(F.col("key"), bounds))
    tasks = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [tasks]
    if bounds:
        counted = {r.block: r.n for r in probes.groupBy("block").agg(F.count("*").alias("n")).collect()}
        whole = sum(counted.values()) or 1
        shares = [max(1, -(-tasks * counted.get(b, 0) // whole)) for b in range(len(bounds) + 1)]
    share_count = F.element_at(F.array(*[F.lit(s) for s in shares]), F.col("block") + 1)

    ends = _ends(rules, bounds)
    in_block = Window.partitionBy("block").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    height = ends.select(F.sum("step").over(in_block).alias("h")).agg(F.max("h")).first()[0]

    opened = ends.withColumn("share", F.explode(F.sequence(F.lit(0), share_count - 1)))
    events = opened.select("block", "share", "key", "step", "frame", F.lit(None).cast("string").alias("__host"), F.lit(None).cast("string").alias("__path")).union(
        probes.select(
            "block", F.pmod(F.xxhash64("__host", "__path"), share_count.cast("long")).cast("int").alias("share"), "key",
            F.lit(0), F.lit(None), "__host", "__path",
        )
    )
    # At an equal key the rule opens before the probe is judged.
    sweep = (
        Window.partitionBy("block", "share").orderBy("key", F.col("step").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    swept = events.withColumn("height", F.sum("step").over(sweep))
    slots = {
        f"slot{k}": F.last(F.when((F.col("step") == 1) & (F.col("height") == k), F.col("frame")), ignorenulls=True).over(sweep)
        for k in range(1, height + 1)
    }
    swept = swept.withColumns(slots)
    top = F.coalesce(*[F.when(F.col("height") == k, F.col(f"slot{k}")) for k in range(1, height + 1)])
    found = (
        swept.where("__host IS NOT NULL AND height > 0")
        .groupBy("__host", "__path")
        .agg(F.max(top).alias("best"))
        .select(F.col("__host").alias("__f_host"), F.col("__path").alias("__f_path"), F.col("best.rule").alias("__rule"), F.col("best.action").alias("__verdict"))
    )
    joined = named.join(found, (F.col("__host") == F.col("__f_host")) & (F.col("__path") == F.col("__f_path")), "left")
    return joined.select(
        *kept, F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"),
        F.coalesce("__verdict", F.lit(default)).alias("verdict"),
    )
