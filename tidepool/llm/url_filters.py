"""URL filters by dated lists: every capture is judged by the entries active when it was fetched.

List entries say that a pattern joins or leaves a list on a date.  Per list and
pattern they become validity intervals [from, to).  The as-of join finds, for
every host (and page) and fetch time that occurs, the active entries of the host
and the domains above it (of the page itself): captures of one host and time are
one probe, so a hot host costs as many probes as it has fetch times.  Of the
active entries the most specific decides (page, host, then parent domains); of
equally specific ones an allowing entry, then the oldest, then by list name.

Patterns are hosts or domains (``example.org`` covers all hosts below it), or
pages (``host/path`` without query, fragment and trailing slashes).

Defined cases: a null or unreadable URL has no host and matches nothing, nor
does a null fetch time; entries with a null pattern, date or action are
ignored; of several entries of one list, pattern and date ``add`` wins; an
entry that repeats the state before it changes nothing; repeated captures are
judged alike, each on its own; URLs of any length are read whole; no entries block
nothing, and no captures give no rows; extra columns of the captures are kept, and
an own column ``filter`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import common

HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[a-z][a-z0-9+.\-]*://[^/?#]*([^?#]*)"

#: Specificity of a page entry: above that of any host (its number of labels).
PAGE = 1000


def host(url: Column) -> Column:
    """Lower-case host of a URL without user, port and trailing dots; empty if there is none."""
    return F.coalesce(F.regexp_replace(F.regexp_extract(F.lower(url), HOST, 1), r"\.+$", ""), F.lit(""))


def page(url: Column) -> Column:
    """``host/path`` of a URL."""
    return F.concat(host(url), F.regexp_replace(F.coalesce(F.regexp_extract(F.lower(url), PATH, 1), F.lit("")), "/+$", ""))


def domains(name: Column) -> Column:
    """A host and the domains above it, to two labels: array of (pattern, specificity)."""
    labels = F.split(name, r"\.")
    above = F.sequence(F.lit(0), F.greatest(F.size(labels) - 2, F.lit(0)))
    return F.transform(above, lambda i: F.struct(F.array_join(F.slice(labels, i + 1, F.size(labels) - i), ".").alias("pattern"), (F.size(labels) - i).alias("specificity")))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals of ``entries`` (``list``, ``verdict``: allow or block, ``pattern``, ``action``: add or remove, ``dated``)."""
    key = ["list", "verdict", "pattern"]
    in_time = Window.partitionBy(*key).orderBy("dated")
    states = (
        entries.where("pattern IS NOT NULL AND dated IS NOT NULL AND action IN ('add', 'remove')")
        .groupBy(*key, "dated").agg(F.max(F.col("action") == "add").alias("on"))
    )
    changes = states.withColumn("was", F.coalesce(F.lag("on").over(in_time), F.lit(False))).where("on <> was")
    return (
        changes.withColumn("until", F.lead("dated").over(in_time)).where("on")
        .select(*key, F.col("dated").alias("since"), "until")
    )


def _decided(probes: DataFrame, active: DataFrame, by: list[str]) -> DataFrame:
    """The deciding entry of each probe (``by``, with ``pattern`` and ``specificity``)."""
    now = (F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until")))
    order = F.struct((-F.col("specificity")).alias("rank"), F.when(F.col("verdict") == "allow", 0).otherwise(1).alias("side"), "since", "list", "pattern")
    return probes.join(active, "pattern").where(now).groupBy(*by).agg(F.min(order).alias("entry"))


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """``captures`` with ``host``, ``blocked``, and the deciding ``list``, ``pattern`` and ``since`` in a struct column ``filter``."""
    active = intervals(entries)
    url, when = F.col(f"`{url_col}`"), F.col(f"`{time_col}`")
    seen = captures.select(F.struct("*").alias("capture"), host(url).alias("host"), page(url).alias("page"), when.alias("fetched"))
    by_host = (
        seen.where("host <> ''").select("host", "fetched").distinct()
        .withColumn("domain", F.explode(domains(F.col("host")))).select("host", "fetched", "domain.pattern", "domain.specificity")
    )
    by_page = (
        seen.where("host <> '' AND page <> host").select("page", "fetched").distinct()
        .withColumns({"pattern": F.col("page"), "specificity": F.lit(PAGE)})
    )
    hosts = _decided(by_host, active, ["host", "fetched"]).withColumnRenamed("entry", "host_entry")
    pages = _decided(by_page, active, ["page", "fetched"]).withColumnRenamed("entry", "page_entry")
    entry = F.coalesce("page_entry", "host_entry")
    verdict = F.struct(F.col("host"), F.coalesce(entry["side"] == 1, F.lit(False)).alias("blocked"), entry["list"].alias("list"),
                       entry["pattern"].alias("pattern"), entry["since"].alias("since"))
    judged = seen.join(hosts, ["host", "fetched"], "left").join(pages, ["page", "fetched"], "left")
    return common.gathered(judged.select("capture.*", verdict.alias("filter")), captures.count())
