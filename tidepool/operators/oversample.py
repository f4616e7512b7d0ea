"""SMOTE oversampling (SMP2) on the exact neighbours of ``neighbours``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.neighbours import knn
from tidepool.operators.ranking import order_statistics
from tidepool.session import stored


def smote(df: DataFrame, label_col: str, feature_cols: list[str], key_col: str,
          minority=None, k: int = 5, seed: int = 12345, chunk_rows: int = 100_000,
          missing: float | None = None,
          **knn_opts) -> DataFrame:
    """SMOTE: add synthetic minority rows until both classes have the same count.

    Each minority row (in order of a 52-bit number from ``md5(seed|key)``, ties
    by key) is the base of
    floor(S / n_min) synthetic rows, the first S mod n_min bases one more, where
    S = n_majority - n_minority.  Synthetic row j of base b takes neighbour
    number 1 + h1 mod k and gap h2 / 2^32 from two seeded hashes of (b, j):
    x = x_b + gap * (x_nbr - x_b).  Integer and boolean features are cast back
    by truncation (a boolean is true only when both parents are).

    A null or NaN feature of a minority row has no distance: with ``missing`` it
    counts as that value (and stays null in the original row), without it raises.
    A minority of k rows or fewer raises: it has no k neighbours.
    Output: original rows with ``synthetic = false`` (j = -1) plus the new rows.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label_col).count().collect()}  # one row per class
    if len(counts) != 2:
        raise ValueError(f"SMOTE needs two classes, found {sorted(counts)}")
    if minority is None:
        minority = min(counts, key=lambda c: (counts[c], str(c)))
    majority = next(c for c in counts if c != minority)
    n_min, n_maj = counts[minority], counts[majority]
    total_new = n_maj - n_min
    kk = k
    types = {f.name: f.dataType for f in df.schema.fields}
    base_out = df.select(F.col(key_col), F.lit(-1).alias("j"),
                         *[F.col(c) for c in feature_cols], F.col(label_col),
                         F.lit(False).alias("synthetic"))
    if total_new <= 0:
        return base_out
    if n_min <= k:
        raise ValueError(f"SMOTE with {k} neighbours needs more than {k} minority rows, found {n_min}")
    values = [F.col(c).cast("double") for c in feature_cols]
    if missing is not None:
        values = [F.when(x.isNull() | F.isnan(x), F.lit(float(missing))).otherwise(x) for x in values]
    # Neighbours, ranks and both ends of the interpolation read the minority rows: computed once.
    mino = stored(df.where(F.col(label_col) == F.lit(minority)).select(key_col, *feature_cols, F.array(*values).alias("_vec")), "minority")
    bad = mino.where(F.exists("_vec", lambda x: x.isNull() | F.isnan(x))).limit(1).count()
    if bad:
        raise ValueError("SMOTE: a feature is null or NaN; state `missing`")
    nbrs = knn(mino, key_col, "_vec", kk, **knn_opts).select(
        F.col(key_col).alias("_b"), "nbr_rank", F.col("nbr_id").alias("_n"))
    # Base order: a 52-bit number from md5(seed|key), ties by key.  Only the
    # row at rank S mod n_min is needed to tell who gets one more: selected,
    # not sorted.
    h52 = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key_col).cast("string"))),
                             1, 13), 16, 10).cast("bigint")
    bases = mino.withColumn("_h", h52)
    per, extra = divmod(total_new, n_min)
    plus_one = F.lit(False)
    if extra:
        cut = order_statistics(bases, "_h", [key_col], [extra])[extra]
        bound = F.struct(F.lit(cut[0]).cast("bigint").alias("_h"),
                         F.lit(cut[1]).cast(types[key_col]).alias(key_col))
        plus_one = F.struct(F.col("_h"), F.col(key_col)) <= bound
    quota = F.lit(per) + plus_one.cast("int")
    with_q = bases.where(quota > 0).select(F.col(key_col).alias("_b"), "_vec", quota.alias("_q"))
    if per + 1 > chunk_rows:
        # Extreme imbalance: cut each base's quota into chunks spread over
        # tasks, so no task generates more than ``chunk_rows`` rows of one base.
        n_chunks = F.ceil(F.col("_q") / chunk_rows).cast("int")
        with_q = (with_q.select("*", F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("_c"))
                  .repartition("_b", "_c"))
        lo = F.col("_c") * chunk_rows
        hi = F.least(F.col("_q"), lo + chunk_rows) - 1
        gen = with_q.select("_b", "_vec", F.explode(F.sequence(lo, hi)).alias("j"))
    else:
        gen = with_q.select("_b", "_vec", F.explode(F.sequence(F.lit(0), F.col("_q") - 1)).alias("j"))
    hj = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_b").cast("string"), F.col("j").cast("string")))
    gen = (gen.withColumn("_hj", hj)
           .withColumn("nbr_rank", F.pmod(F.conv(F.substring("_hj", 1, 8), 16, 10).cast("bigint"),
                                          F.lit(kk)) + 1)
           .withColumn("_gap", F.conv(F.substring("_hj", 9, 8), 16, 10).cast("bigint") / 4294967296.0))
    nvec = mino.select(F.col(key_col).alias("_n"), F.col("_vec").alias("_nvec"))
    syn = gen.join(nbrs, ["_b", "nbr_rank"]).join(nvec, "_n")
    cols = []
    for i, c in enumerate(feature_cols):
        x = F.col("_vec")[i] + F.col("_gap") * (F.col("_nvec")[i] - F.col("_vec")[i])
        if isinstance(types[c], T.BooleanType):
            x = x.cast("int")  # truncate like integer features, then back to boolean
        cols.append(x.cast(types[c]).alias(c))
    syn_out = syn.select(F.col("_b").alias(key_col), "j", *cols,
                         F.lit(minority).cast(types[label_col]).alias(label_col),
                         F.lit(True).alias("synthetic"))
    return base_out.unionByName(syn_out)
