"""URL filters: a sorted sweep of canonical keys over nested rule intervals.

A rule (host, path) becomes the key ``reversed host | path``; everything that starts with that key
lies in one interval, and two intervals are nested or apart.  A url is looked up once for each
of its domains that a rule could name.  One sort brings the opening of an interval, the keys looked up
and the closing in line; the number of open intervals is a running sum, and the rule on top of the
stack is the one opened last at that depth.  Key ranges are swept side by side: a block starts
from the depth and the open rules that the blocks before it leave (one row per block and depth).

Defined results: null urls and urls without ``://`` have an empty host and path and fit no rule;
repeated rows are each judged; a rule given twice counts once, and ``block`` beats ``allow``; rules
with a null host are ignored, a null path is empty; with equal lengths the longer host wins; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourlens.llm.common import Stages, ascii_lower, block_offsets, range_blocks

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
OPEN, PROBE, CLOSE = 0, 1, 2


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _key(labels: Column, path: Column, end: Column | None = None) -> Column:
    """Labels from the top domain down, a byte no UTF-8 text holds, the path."""
    parts = [F.array_join(F.reverse(labels), ".").cast("binary"), F.unhex(F.lit("FE")),
             path.cast("binary")]
    return F.concat(*parts, *([end] if end is not None else []))


def _rules(rules: DataFrame) -> DataFrame:
    """Rules as openings and closings of their intervals."""
    one = (rules.where("host is not null")
           .select(ascii_lower(F.col("host")).alias("host"),
                   F.coalesce("path", F.lit("")).alias("path"), "verdict")
           .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    rule = F.struct((F.length("host") + F.length("path")).alias("size"),
                    F.length("host").alias("host_size"),
                    F.concat("host", "path").alias("rule"), "verdict")
    labels = F.split("host", r"\.")
    sides = F.array(F.struct(F.lit(OPEN).alias("kind"), _key(labels, F.col("path")).alias("key")),
                    F.struct(F.lit(CLOSE).alias("kind"),
                             _key(labels, F.col("path"), F.unhex(F.lit("FF"))).alias("key")))
    return one.select(rule.alias("rule"), F.explode(sides).alias("side")).select(
        "side.key", "side.kind", "rule",
        F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"))


def match_rules(urls: DataFrame, rules: DataFrame, stages: Stages) -> DataFrame:
    """The longest rule that fits each distinct (host, path) of ``urls``; none: no row."""
    labels = F.split("host", r"\.")
    # no domain with more labels than any rule has can be a rule's
    longest = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first()["n"] or 0
    own = urls.where("host <> ''").select("host", "path").distinct().withColumn("labels", labels)
    size = F.size("labels")
    probes = own.withColumn("n", F.explode(F.sequence(
        F.lit(1), F.greatest(F.lit(1), F.least(size, F.lit(longest)))))).select(
        _key(F.slice(F.col("labels"), size - F.col("n") + 1, F.col("n")), F.col("path")).alias("key"),
        F.lit(PROBE).alias("kind"), F.lit(None).alias("rule"), "host", "path")
    events = _rules(rules).unionByName(probes)
    blocks = range_blocks(stages, events, "key", "kind")

    step = F.when(F.col("kind") == OPEN, 1).when(F.col("kind") == CLOSE, -1).otherwise(0)
    order = Window.partitionBy("block").orderBy("key", "kind").rowsBetween(
        Window.unboundedPreceding, 0)
    deep = (blocks.withColumn("inside", F.sum(step).over(order))
            .join(F.broadcast(block_offsets(blocks, step)), "block")     # one row per block
            .withColumn("depth", F.col("inside") + F.col("before"))
            .where(f"kind <> {CLOSE} and depth > 0"))
    opened = F.when(F.col("kind") == OPEN, F.col("rule"))
    layer = Window.partitionBy("block", "depth").orderBy("key", "kind").rowsBetween(
        Window.unboundedPreceding, 0)
    swept = deep.withColumn("top", F.last(opened, ignorenulls=True).over(layer))
    # what earlier blocks leave open: at most one rule per block and depth
    left = deep.groupBy("block", "depth").agg(
        F.max_by("rule", F.when(F.col("kind") == OPEN, F.col("key"))).alias("opened"))
    earlier = Window.partitionBy("depth").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = left.select("block", "depth",
                          F.last("opened", ignorenulls=True).over(earlier).alias("carried"))
    fitting = (swept.where(f"kind = {PROBE}").join(carried, ["block", "depth"], "left")
               .withColumn("top", F.coalesce("top", "carried")))
    return fitting.groupBy("host", "path").agg(F.max("top").alias("top"))


def judge_urls(pages: DataFrame, rules: DataFrame, keep: str = "page_id", url: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per page: ``keep``, host, path, rule (null if none fits) and verdict."""
    stages = Stages(pages.sparkSession, "url-filter")
    urls = pages.select(F.col(keep).alias("page_id"), url_host(F.col(url)).alias("host"),
                        url_path(F.col(url)).alias("path"))
    found = stages.write(match_rules(urls, rules, stages))
    # the side of the pages is split where one address fills a partition
    return urls.join(found, ["host", "path"], "left").select(
        F.col("page_id").alias(keep), "host", "path", F.col("top.rule").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"))
