"""Ranks, running sums, exact quantiles and order statistics without a
one-task window.

``Window.orderBy(x)`` without ``partitionBy`` moves every row into a single
task.  ``global_rank`` and ``prefix_sums`` instead range-partition on the sort
key (Spark samples the key, so a value holding a third of the rows is still
split by the tiebreak columns), number or sum inside each partition, and join
back per-partition offsets (one row per partition, broadcast; with groups one
per partition and group, joined as AQE finds best).  The range-partitioned frame is cut
with ``checkpoint()`` into the shared checkpoint folder: counts and positions
must come from the same partitioning, and a recomputation after an executor
loss must not re-sample the bounds.

Where only a few ranks matter -- quantiles, split points, bin boundaries --
nothing is sorted: ``percentile_approx`` brackets each rank, exact counts locate
it, and only the rows inside the narrow brackets are ranked
(``exact_quantiles``, ``grouped_quantiles``, ``order_statistics``), with the
full rank as the fallback for a bracket that misses.

Null groups are groups like any other.  NaN is left out wherever null is (``number``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.joins import bounded_broadcast, null_safe_join
from tidepool.session import checkpoint_dir, stored


def number(col: str | Column) -> Column:
    """The column as a double; NaN is null."""
    return F.nanvl((F.col(col) if isinstance(col, str) else col).cast("double"), F.lit(None).cast("double"))


def _range_partitioned(df: DataFrame, keys: list[Column], n: int | None) -> DataFrame:
    """Range partitioning on ``keys``.  Without an explicit count AQE sizes the
    partitions (it only merges adjacent ranges, so the order is kept)."""
    return df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)


def global_rank(df: DataFrame, order_cols: list[str | Column], name: str = "rank",
                group_cols: list[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based row number under ``order_cols`` (within ``group_cols``).

    Equal to ``row_number() OVER (PARTITION BY group ORDER BY order_cols)``;
    make ``order_cols`` unique (append a key) for a deterministic result.
    """
    group_cols = group_cols or []
    checkpoint_dir(df.sparkSession)
    keys = [F.col(c) if isinstance(c, str) else c for c in group_cols] + \
           [F.col(c) if isinstance(c, str) else c for c in order_cols]
    positioned = (_range_partitioned(df, keys, num_partitions)
                  .sortWithinPartitions(*keys)
                  .withColumn("_pid", F.spark_partition_id())
                  .withColumn("_mid", F.monotonically_increasing_id()))
    positioned = stored(positioned, "ranked")
    counts = positioned.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first_mid"))
    offsets = counts.withColumn(
        "_offset",
        F.coalesce(F.sum("_n").over(Window.partitionBy(*group_cols).orderBy("_pid")
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select("_pid", *group_cols, "_offset", "_first_mid")
    # Without groups the offsets table has one row per partition (bounded);
    # with groups it grows with them, and AQE chooses the join by its real size.
    side = bounded_broadcast(offsets) if not group_cols else offsets
    out = null_safe_join(positioned, side, ["_pid", *group_cols])
    # Rows of one group inside one partition are contiguous in sort order, so
    # position within the group = _mid - first _mid of that group there.
    out = out.withColumn(name, F.col("_offset") + (F.col("_mid") - F.col("_first_mid")) + 1)
    return out.drop("_pid", "_mid", "_offset", "_first_mid")


def _rank_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Quantiles by global rank: one unpivot, one range sort, small joins."""
    long = (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("_u")).select("_u.column", "_u.v").where(F.col("v").isNotNull()))
    ranked = global_rank(long, ["v"], name="_r", group_cols=["column"])
    # Group sizes from the ranked (checkpointed) rows: no second source scan.
    sizes = ranked.groupBy("column").agg(F.max("_r").alias("_n"))
    plist = F.array(*[F.lit(float(p)) for p in probs])
    targets = (sizes.select("column", "_n", F.explode(plist).alias("p"))
               .withColumn("_pos", F.col("p") * (F.col("_n") - 1))
               .withColumn("_lo", F.floor("_pos") + 1)
               .withColumn("_hi", F.ceil("_pos") + 1)
               .withColumn("_frac", F.col("_pos") - F.floor("_pos")))
    # Needed ranks: at most 2 per (column, p); bounded by len(cols) * len(probs).
    need = targets.select("column", F.explode(F.array("_lo", "_hi")).alias("_r")).distinct()
    picked = ranked.join(bounded_broadcast(need), ["column", "_r"]).select("column", "_r", "v")
    lo = picked.select("column", F.col("_r").alias("_lo"), F.col("v").alias("_vlo"))
    hi = picked.select("column", F.col("_r").alias("_hi"), F.col("v").alias("_vhi"))
    res = targets.join(lo, ["column", "_lo"]).join(hi, ["column", "_hi"])
    value = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")
    return res.select("column", "p", value.alias("value"))


def _bracket_stage(df: DataFrame, cols: list[str], probs: list[float], first,
                   below) -> tuple[DataFrame | None, list[str]]:
    """Given counts and brackets (``first``) and rows below each bracket
    (``below``), rank only the rows inside the brackets.  Returns (quantiles of
    the columns whose brackets hit, columns whose brackets missed)."""
    spark = df.sparkSession
    targets, extremes = [], []
    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        if not n:
            continue
        extremes += [(c, float(p), float(first[f"min{i}"] if p == 0 else first[f"max{i}"])) for p in probs if p in (0, 1)]
        for t, p in _inner(probs):
            pos = p * (n - 1)
            targets.append((c, t, float(p), int(n), float(first[f"lo{i}"][t]), float(first[f"hi{i}"][t]),
                            int(np.floor(pos)), int(np.ceil(pos)), float(pos - np.floor(pos)),
                            int(below[f"b{i}_{t}"] or 0)))
    ends = spark.createDataFrame(extremes, "column string, p double, value double") if extremes else None
    if not targets:
        return ends, []
    tschema = ("column string, t int, p double, n long, L double, U double, lo_r long, hi_r long, "
               "frac double, below long")
    tdf = spark.createDataFrame(targets, tschema)
    # A row goes into the brackets that hold one of its values: tested before the explode.
    held = F.array(*[
        F.when((F.col(c).cast("double") >= low) & (F.col(c).cast("double") <= high),
               F.struct(F.lit(c).alias("column"), F.lit(t).alias("t"), F.col(c).cast("double").alias("v")))
        for c, t, _, _, low, high, *_ in targets])
    inside = (df.select(F.explode(F.filter(held, lambda h: h.isNotNull())).alias("_h")).select("_h.*")
              .groupBy("column", "t", "v").agg(F.count(F.lit(1)).alias("cnt")))
    cum = prefix_sums(inside, ["v"], ["cnt"], ["column", "t"])
    tot = cum.groupBy("column", "t").agg(F.sum("cnt").alias("inside"))
    chk = tdf.join(tot, ["column", "t"], "left").withColumn("inside", F.coalesce("inside", F.lit(0)))
    ok = (F.col("below") <= F.col("lo_r")) & (F.col("below") + F.col("inside") > F.col("hi_r"))
    verdict = chk.select("column", "t", ok.alias("ok")).collect()  # one row per target
    failed = sorted({r["column"] for r in verdict if not r["ok"]})
    good = [c for c in cols if c not in failed and any(tr[0] == c for tr in targets)]
    if not good:
        return None, failed
    if ends is not None:
        ends = ends.where(F.col("column").isin(good))
    j = cum.join(bounded_broadcast(tdf), ["column", "t"]).where(F.col("column").isin(good))
    # value at 0-based rank R: the smallest v whose cumulative count exceeds R - below.
    pick = lambda r: F.min(F.when(F.col("cnt_cum") > F.col(r) - F.col("below"), F.col("v")))
    vals = j.groupBy("column", "t", "p", "frac").agg(pick("lo_r").alias("_vlo"), pick("hi_r").alias("_vhi"))
    value = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("frac")
    found = vals.select("column", "p", value.alias("value"))
    return (found if ends is None else found.unionByName(ends)), failed


def _bracket_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                       accuracy: int = 100_000) -> tuple[DataFrame | None, list[str]]:
    """Exact quantiles in linear passes, no full sort.

    ``percentile_approx`` (rank error at most N / accuracy) gives a value bracket
    around every needed order statistic; one pass counts the rows below each
    bracket; only the rows inside the brackets -- about 4N / accuracy per
    target -- are reduced to (value, count), cumulated, and the exact order
    statistics read off.  A bracket that misses its rank (checked with the
    counts) sends its column back to the caller for the rank method.
    """
    first = df.agg(*_bracket_aggs(cols, probs, accuracy)).first()
    counts = _below_aggs(cols, probs, first)
    below = df.agg(*counts).first() if counts else None
    return _bracket_stage(df, cols, probs, first, below)


def _inner(probs: list[float]) -> list[tuple[int, float]]:
    """Numbered probabilities other than 0 and 1, whose quantiles are the extremes."""
    return [(t, p) for t, p in enumerate(p for p in probs if p not in (0, 1))]


def _bracket_aggs(cols: list[str], probs: list[float], accuracy: int) -> list[Column]:
    """Count, extremes, and both ends of all brackets of a column from one sketch."""
    delta = 2.0 / accuracy
    inner = [p for _, p in _inner(probs)]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
        if inner:
            ends = F.percentile_approx(x, [max(0.0, p - delta) for p in inner] + [min(1.0, p + delta) for p in inner], accuracy)
            aggs += [F.slice(ends, 1, len(inner)).alias(f"lo{i}"), F.slice(ends, len(inner) + 1, len(inner)).alias(f"hi{i}")]
    return aggs


def _below_aggs(cols: list[str], probs: list[float], first) -> list[Column]:
    """Rows strictly below each bracket: one conditional count per target."""
    return [F.count_if(F.col(c).cast("double") < F.lit(float(first[f"lo{i}"][t]))).alias(f"b{i}_{t}")
            for i, c in enumerate(cols) if first[f"n{i}"] for t, _ in _inner(probs)]


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], method: str = "bracket",
                    accuracy: int = 100_000) -> DataFrame:
    """Linear-interpolated quantiles (pandas / ``quantile_cont`` semantics) of each column.

    Returns one row per (column, p): ``column, p, value``.  Nulls and NaN are left out.

    ``method="bracket"``, at every size: linear passes, no full sort, and the
    range-sort rank for a column whose bracket misses; ``"rank"`` always ranks.
    Cut an expensive input (``checkpoint()``) first: it is scanned three times.
    """
    df = df.select(*[number(c).alias(c) for c in cols])
    if method == "rank":
        return _rank_quantiles(df, cols, probs)
    got, failed = _bracket_quantiles(df, cols, probs, accuracy)
    parts = ([got] if got is not None else []) + ([_rank_quantiles(df, failed, probs)] if failed else [])
    if not parts:
        return df.sparkSession.createDataFrame([], "column string, p double, value double")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def prefix_sums(df: DataFrame, order_cols: list[str], value_cols: list[str],
                group_cols: list[str] | None = None, suffix: str = "_cum",
                num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` under ``order_cols`` (within groups).

    Same layout as ``global_rank``: range partitions (sorted, checkpointed),
    running sums inside each partition, per-partition totals turned into
    offsets and joined back (one row per partition and group).  The in-partition
    sums are an Arrow-batched pass over the already sorted partition, so the
    range exchange is the only shuffle of the rows.
    """
    group_cols = group_cols or []
    checkpoint_dir(df.sparkSession)
    keys = [*group_cols, *order_cols]
    positioned = (_range_partitioned(df, [F.col(c) for c in keys], num_partitions)
                  .sortWithinPartitions(*keys)
                  .withColumn("_pid", F.spark_partition_id())
                  .checkpoint(eager=True))
    local = _local_running_sums(positioned, group_cols, value_cols)
    totals = positioned.groupBy("_pid", *group_cols).agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *group_cols, *[
        F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in value_cols])
    side = bounded_broadcast(offsets) if not group_cols else offsets
    out = null_safe_join(local, side, ["_pid", *group_cols])
    for v in value_cols:
        out = out.withColumn(f"{v}{suffix}", F.col(f"_o_{v}") + F.col(f"_l_{v}"))
    return out.drop("_pid", *[f"_l_{v}" for v in value_cols], *[f"_o_{v}" for v in value_cols])


def _local_running_sums(positioned: DataFrame, group_cols: list[str], value_cols: list[str]) -> DataFrame:
    """Running sums of ``value_cols`` per group inside each partition, in the
    partition's (sorted) row order; groups are contiguous there."""
    base = positioned.schema
    out_schema = T.StructType(list(base.fields) + [
        T.StructField(f"_l_{v}", base[v].dataType) for v in value_cols])

    def run(batches):
        prev_key, prev_tot = None, None
        for pdf in batches:
            if pdf.empty:
                continue
            if group_cols:
                grp = pdf.groupby(group_cols, sort=False, dropna=False)
                keys = pdf[group_cols].astype(object).where(pdf[group_cols].notna(), None)  # null equals null
                first_key = tuple(keys.iloc[0])
                lead = np.logical_and.reduce([[x == first for x in keys[c]] for c, first in zip(group_cols, first_key)])
                for v in value_cols:
                    cs = grp[v].cumsum()
                    if prev_key is not None and first_key == prev_key:
                        cs = cs + lead.astype(cs.dtype) * prev_tot[v]  # the group spans the batch edge
                    pdf[f"_l_{v}"] = cs
                prev_key = tuple(keys.iloc[-1])
            else:
                for v in value_cols:
                    pdf[f"_l_{v}"] = pdf[v].cumsum() + (prev_tot[v] if prev_tot else 0)
            prev_tot = {v: pdf[f"_l_{v}"].iloc[-1] for v in value_cols}
            yield pdf

    return positioned.mapInPandas(run, out_schema)


def _grouped_rank_quantiles(df: DataFrame, value_col: str, group_cols: list[str],
                            probs: list[float]) -> DataFrame:
    """Per-group quantiles by global rank: a hot group is still spread over
    many range partitions."""
    vals = df.select(*group_cols, number(value_col).alias("v")).where(F.col("v").isNotNull())
    ranked = global_rank(vals, ["v"], name="_r", group_cols=group_cols)
    sizes = vals.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    plist = F.array(*[F.lit(float(p)) for p in probs])
    targets = (sizes.select(*group_cols, "_n", F.explode(plist).alias("p"))
               .withColumn("_pos", F.col("p") * (F.col("_n") - 1))
               .withColumn("_lo", F.floor("_pos") + 1)
               .withColumn("_hi", F.ceil("_pos") + 1)
               .withColumn("_frac", F.col("_pos") - F.floor("_pos")))
    need = targets.select(*group_cols, F.explode(F.array("_lo", "_hi")).alias("_r")).distinct()
    # `need` has at most 2 x len(probs) rows per group: it grows with the number
    # of groups, so it joins by shuffle (no broadcast without a bound).
    picked = null_safe_join(ranked, need, [*group_cols, "_r"]).select(*group_cols, "_r", "v")
    lo = picked.select(*group_cols, F.col("_r").alias("_lo"), F.col("v").alias("_vlo"))
    hi = picked.select(*group_cols, F.col("_r").alias("_hi"), F.col("v").alias("_vhi"))
    res = null_safe_join(null_safe_join(targets, lo, [*group_cols, "_lo"]), hi, [*group_cols, "_hi"])
    value = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")
    return res.select(*group_cols, "p", value.alias("value"))


def grouped_quantiles(df: DataFrame, value_col: str, group_cols: list[str], probs: list[float],
                      method: str = "bracket", accuracy: int = 10_000) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value_col`` per group -> (group..., p, value).

    ``method="bracket"``: per-group ``percentile_approx`` brackets, exact counts
    below each bracket, and only the rows inside the brackets reduced to
    (value, count) and cumulated; groups whose bracket misses a rank are
    recomputed by the rank method.  No list of groups reaches the driver.
    ``method="rank"`` ranks every value (range sort).  The input is scanned
    several times: cut an expensive input (``checkpoint()``) first.
    """
    if method == "rank":
        return _grouped_rank_quantiles(df, value_col, group_cols, probs)
    vals = df.select(*group_cols, number(value_col).alias("v")).where(F.col("v").isNotNull())
    delta = 2.0 / accuracy
    lo_p = [max(0.0, p - delta) for p in probs]
    hi_p = [min(1.0, p + delta) for p in probs]
    plist = F.array(*[F.lit(float(p)) for p in probs])
    ends = F.percentile_approx("v", lo_p + hi_p, accuracy)
    g = vals.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"), F.slice(ends, 1, len(probs)).alias("_lo"),
                                      F.slice(ends, len(probs) + 1, len(probs)).alias("_hi"))
    t = (g.select(*group_cols, "_n", F.posexplode(F.arrays_zip(plist.alias("p"), F.col("_lo").alias("lo"),
                                                              F.col("_hi").alias("hi"))).alias("_t", "_z"))
         .select(*group_cols, "_n", "_t", "_z.p", "_z.lo", "_z.hi")
         .withColumn("_pos", F.col("p") * (F.col("_n") - 1))
         .withColumn("lo_r", F.floor("_pos").cast("long"))
         .withColumn("hi_r", F.ceil("_pos").cast("long"))
         .withColumn("frac", F.col("_pos") - F.floor("_pos")))
    # One row per (group, target): AQE broadcasts it if it is small.
    joined = null_safe_join(vals, t.select(*group_cols, "_t", "lo", "hi"), group_cols)
    below = joined.groupBy(*group_cols, "_t").agg(F.sum((F.col("v") < F.col("lo")).cast("long")).alias("below"))
    inside = (joined.where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
              .groupBy(*group_cols, "_t", "v").agg(F.count(F.lit(1)).alias("cnt")))
    cum = prefix_sums(inside, ["v"], ["cnt"], [*group_cols, "_t"])
    tot = cum.groupBy(*group_cols, "_t").agg(F.sum("cnt").alias("inside"))
    by_target = [*group_cols, "_t"]
    info = null_safe_join(null_safe_join(t, below, by_target, "left"), tot, by_target, "left").fillna(0, ["below", "inside"])
    ok = (F.col("below") <= F.col("lo_r")) & (F.col("below") + F.col("inside") > F.col("hi_r"))
    failing = info.where(~ok).select(*group_cols).distinct()
    pick = lambda r: F.min(F.when(F.col("cnt_cum") > F.col(r) - F.col("below"), F.col("v")))
    vals_bt = (null_safe_join(cum, info.where(ok), by_target)
               .groupBy(*group_cols, "_t", "p", "frac")
               .agg(pick("lo_r").alias("_vlo"), pick("hi_r").alias("_vhi")))
    value = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("frac")
    good = vals_bt.select(*group_cols, "p", value.alias("value"))
    if failing.isEmpty():
        return good
    good = null_safe_join(good, failing, group_cols, "left_anti")
    redo = _grouped_rank_quantiles(null_safe_join(vals, failing, group_cols, "left_semi"), "v", group_cols, probs)
    return good.unionByName(redo)


def _same_type(value: str, typ: T.DataType) -> Column:
    """A literal of ``typ`` from its text (no detour over a Python or double value)."""
    return F.lit(value).cast(typ)


def order_statistics(df: DataFrame, num_col: str, tie_cols: list[str], ranks: list[int],
                     accuracy: int = 100_000) -> dict[int, tuple]:
    """Rows at the given 1-based ranks under the order (num_col, *tie_cols).

    One way for every size and every ordered type: ``percentile_approx`` on
    ``num_col`` brackets each rank (in the column's own type), one pass counts
    the rows below each bracket, and only the rows inside a bracket (about
    4N / accuracy, or those that share its value) are ranked exactly.  A rank
    its bracket misses is found by a full ``global_rank``, as are all ranks of a
    type without percentiles (text, boolean).  Returns {rank: (num_col value,
    *tie values)}; only these few rows reach the driver.  The input is scanned
    several times: cut an expensive input first.
    """
    ranks = sorted(set(int(r) for r in ranks))
    if not ranks:
        return {}
    cols = [num_col, *tie_cols]
    x = F.col(num_col)
    typ = df.schema[num_col].dataType
    present = x.isNotNull() & ~F.isnan(x) if isinstance(typ, (T.FloatType, T.DoubleType)) else x.isNotNull()
    vals = df.where(present).select(*cols)
    out: dict[int, tuple] = {}
    if isinstance(typ, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        n = vals.count()
        if n == 0:
            return {}
        delta = 2.0 / accuracy
        probs = [(r - 1) / max(1, n - 1) for r in ranks]
        ends = [min(1.0, max(0.0, p + d)) for d in (-delta, delta) for p in probs]
        edge = vals.agg(F.percentile_approx(x, ends, accuracy).cast("array<string>")).first()[0]
        low, high = edge[: len(ranks)], edge[len(ranks):]
        lows, highs = ([_same_type(v, typ) for v in side] for side in (low, high))
        below = vals.agg(*[F.coalesce(F.sum((x < lo).cast("long")), F.lit(0)) for lo in lows]).first()
        # One entry per rank; a row goes into the brackets that hold it.
        brackets = F.array(*[F.when((x >= lo) & (x <= hi), F.struct(F.lit(i).alias("_t"), F.lit(r - below[i]).alias("_want")))
                             for i, (r, lo, hi) in enumerate(zip(ranks, lows, highs))])
        inside = vals.select(*cols, F.explode(F.filter(brackets, lambda b: b.isNotNull())).alias("_b")).select("_b.*", *cols)
        ranked = global_rank(inside, cols, name="_r", group_cols=["_t"])
        for row in ranked.where(F.col("_r") == F.col("_want")).select("_t", *cols).collect():
            out[ranks[row["_t"]]] = tuple(row[c] for c in cols)
    missed = [r for r in ranks if r not in out]
    if missed:
        full = global_rank(vals, cols, name="_r")
        for row in full.where(F.col("_r").isin(missed)).select("_r", *cols).collect():
            out[row["_r"]] = tuple(row[c] for c in cols)
    return out
