"""Quality rules judged by an isolation forest over rule statistics.

Every text is reduced to counts (words, symbols, repeated lines, words in
repeated 5-word windows, ...).  Two base rules reject outright.  The rest is
judged by an isolation forest: trees of random splits over rates made from the
counts; a text that few splits isolate is an anomaly.  It learns from every
labelled document that passes the base rules, whole: each tree draws its own
``TREE_ROWS`` rows from all of them (which is what an isolation forest is), and the
labels of all of them choose the rates it splits on (one more as long as it
helps) and the score threshold: the one that classifies them best while keeping
``KEEP_GOOD`` of the good ones.  Spark counts the texts before anything is
shuffled, draws the trees' rows and scores all rows; the driver gets the drawn rows
and, per forest, how many good and bad rows lie in each of ``CELLS`` cells of
the score, so neither grows with the documents.  The verdicts cover every text,
whole, in one more pass with no shuffle.

Defined cases: a null or empty text has no words, all counts zero, and fails the
base rules; documents without labels are judged like others; without labelled
documents of both kinds nothing is rejected beyond the base rules; of several
labels of one id the worst holds, and of several documents of one id one is
learned from; repeated rows are judged alike, each on its own; texts of any length
are counted whole; equal scores fall on one side of the threshold; an empty table
gives no rows; extra columns are kept, the added ones are renamed where they clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import common

TREES = 100
#: Rows a tree is grown on, and its greatest depth.
TREE_ROWS = 256
DEPTH = 10
SEED = 20_240_607
#: Share of the good labelled documents that a threshold has to keep.
KEEP_GOOD = 0.998
#: Cells of equal width that the scores are counted in: thresholds lie between two of them.
CELLS = 1 << 16

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_lines")
STATS = ", ".join(f"{c} bigint" for c in COUNTS)
VERDICT = STATS + ", base_failed boolean, anomaly double, kept boolean"

#: The symbols that are counted.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"


def repeat_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` word numbers that occur twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    code, span = ids[:n], int(ids.max()) + 1
    largest = span
    for k in range(1, window):  # append the next word's number; renumber before a code could overflow
        if largest * span >= 2**62:
            seen, code = np.unique(code, return_inverse=True)
            largest = len(seen)
        code, largest = code * span + ids[k: n + k], largest * span
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    starts = np.concatenate((order[1:][same], order[:-1][same]))
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one text."""
    if not text:
        return (0,) * len(COUNTS)
    words = common.words_of(text)
    n = len(words)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    chars = len(text) - sum(map(text.count, BLANKS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)] if "\n" in text else [text]
    dup_lines = len(lines) - len(set(lines))
    repeated = repeat_words(ids) if len(number) < n else 0
    return (n, chars, sum(map(text.count, SYMBOLS)), dup_lines, repeated, len(number), len(lines) if n else 0)


def base_failed(counts: np.ndarray) -> np.ndarray:
    """The base rules over rows of ``COUNTS``."""
    words, repeated = counts[:, 0], counts[:, 4]
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


def features(counts: np.ndarray) -> np.ndarray:
    """Rates that don't depend on a text's length, over rows of ``COUNTS``."""
    words, chars, symbols, dup, repeated, distinct, lines = (counts[:, i].astype(float) for i in range(len(COUNTS)))
    some = np.maximum(words, 1)
    # Long texts repeat common words: distinct words are compared with a power of the length.
    return np.stack([
        np.minimum(symbols / some, 1.0),
        chars / some,
        dup / np.maximum(lines, 1),
        repeated / some,
        np.log(np.maximum(distinct, 1)) / np.log(np.maximum(words, 2)),
    ], axis=1)


@dataclass(frozen=True)
class Forest:
    """Trees in flat arrays: ``feature`` (-1: leaf), ``value``, ``left`` child (right: one more), leaf ``path`` length."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray
    norm: float
    rates: tuple[int, ...]
    threshold: float = np.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores in (0, 1); higher: isolated by fewer splits."""
        x = x[:, self.rates]
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                f = self.feature[t, node]
                down = f >= 0
                if not down.any():
                    break
                right = x[rows, np.maximum(f, 0)] >= self.value[t, node]
                node = np.where(down, self.left[t, node] + right, node)
            total += self.path[t, node]
        return np.exp2(-total / len(self.feature) / self.norm)


def _expected_path(n: int) -> float:
    """Average depth of an unsuccessful search in a binary tree of ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow(x: np.ndarray, rates: tuple[int, ...], trees: int = TREES, rows: int = TREE_ROWS, depth: int = DEPTH, seed: int = SEED) -> Forest:
    """Isolation forest over the columns ``rates`` of ``x``, each tree on a random ``rows`` of its rows."""
    random = np.random.default_rng(seed)
    return grown([x[random.permutation(len(x))[:rows]] for _ in range(trees)], rates, depth, seed)


def grown(bags: list[np.ndarray], rates: tuple[int, ...], depth: int = DEPTH, seed: int = SEED) -> Forest:
    """Isolation forest over the columns ``rates``, a tree on each of ``bags``."""
    random = np.random.default_rng(seed)
    trees, n = len(bags), max(map(len, bags))
    size = min(2 ** (depth + 1), 2 * n)
    feature, value = np.full((trees, size), -1, dtype=np.int8), np.zeros((trees, size))
    left, path = np.zeros((trees, size), dtype=np.int32), np.zeros((trees, size))
    for t, bag in enumerate(bags):
        used = 1
        open_ = [(0, bag[:, rates], 0)]
        while open_:
            node, part, level = open_.pop()
            if not len(part):
                continue
            low, high = part.min(axis=0), part.max(axis=0)
            wide = np.flatnonzero(high > low)
            if level == depth or not len(wide):
                path[t, node] = level + _expected_path(len(part))
                continue
            f = int(random.choice(wide))
            cut = random.uniform(low[f], high[f])
            cut = high[f] if cut <= low[f] else cut
            to_right = part[:, f] >= cut
            feature[t, node], value[t, node], left[t, node] = f, cut, used
            open_ += [(used, part[~to_right], level + 1), (used + 1, part[to_right], level + 1)]
            used += 2
    return Forest(feature, value, left, path, _expected_path(max(n, 2)), tuple(rates))


def calibrate(score: np.ndarray, good: np.ndarray, keep_good: float = KEEP_GOOD) -> tuple[float, float]:
    """``threshold_of`` rows with these scores."""
    each, at = np.unique(score, return_inverse=True)
    n_good, n_all = np.bincount(at, weights=good, minlength=len(each)), np.bincount(at, minlength=len(each))
    return threshold_of(each, each, n_good, n_all - n_good, keep_good)


def threshold_of(low: np.ndarray, high: np.ndarray, good: np.ndarray, bad: np.ndarray, keep_good: float = KEEP_GOOD) -> tuple[float, float]:
    """The threshold (rejected: above it) that classifies best among those that keep ``keep_good`` of the good rows.

    Rows are given as cells of the score in ascending order: lowest and highest score, good and bad rows.
    With it, the share of bad rows rejected less that of good ones; (inf, 0) where none helps.
    """
    all_good, all_bad = good.sum(), bad.sum()
    if not all_good or not all_bad:
        return np.inf, 0.0
    low, high, lost, caught = low[::-1], high[::-1], np.cumsum(good[::-1]), np.cumsum(bad[::-1])
    ends = np.flatnonzero(lost <= (1 - keep_good) * all_good)
    if not len(ends):
        return np.inf, 0.0
    gain = caught[ends] / all_bad - lost[ends] / all_good
    best = ends[np.argmax(gain)]
    if gain.max() <= 0:
        return np.inf, 0.0
    below = high[best + 1] if best + 1 < len(high) else 0.0
    return float((low[best] + below) / 2), float(gain.max())


def scored_cells(table: DataFrame, forests: list[Forest]) -> pd.DataFrame:
    """Of every forest the cells of the score with a row of ``table``: lowest and highest score, good and bad rows."""
    def cells(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            x = features(part[list(COUNTS)].to_numpy(dtype=np.int64))
            for i, forest in enumerate(forests):
                score = forest.score(x)
                at = np.minimum((score * CELLS).astype(np.int64), CELLS - 1)
                rows = pd.DataFrame({"cell": at, "low": score, "high": score, "good": part["q"].to_numpy(dtype=np.int64), "bad": 1 - part["q"].to_numpy(dtype=np.int64)})
                found = rows.groupby("cell").agg({"low": "min", "high": "max", "good": "sum", "bad": "sum"}).reset_index()
                yield found.assign(forest=i)[["forest", "cell", "low", "high", "good", "bad"]]

    found = table.mapInPandas(cells, "forest int, cell bigint, low double, high double, good bigint, bad bigint")
    return (found.groupBy("forest", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
            .orderBy("forest", "cell").toPandas())  # at most CELLS of each forest


def drawn(table: DataFrame, rows: int, trees: int = TREES, each: int = TREE_ROWS) -> list[np.ndarray]:
    """For each tree the features of ``each`` of the ``rows`` rows of ``table`` (all, if fewer), drawn by a hash of tree and id."""
    tree = F.sequence(F.lit(0), F.lit(trees - 1))
    if rows > 4 * each:  # only rows that can be among the smallest hashes: well over ``each`` are expected
        limit = int(-(2**63) + 4 * each / rows * 2**64)
        tree = F.filter(tree, lambda t: F.xxhash64(F.lit(SEED), t, "k") < limit)
    by_hash = Window.partitionBy("tree").orderBy(F.xxhash64(F.lit(SEED), "tree", "k"), "k")
    chosen = (table.select("k", *COUNTS, F.explode(tree).alias("tree")).withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= each)
              .orderBy("tree", "nth").toPandas())  # trees x each
    return [features(part[list(COUNTS)].to_numpy(dtype=np.int64)) for _, part in chosen.groupby("tree")]


def chosen_forest(table: DataFrame, bags: list[np.ndarray]) -> Forest:
    """The forest on the rates that separate the rows of ``table`` best: rates join one by one while the gain grows."""
    n_rates = bags[0].shape[1]
    rates: tuple[int, ...] = ()
    best = grown(bags[:1], (0,))
    gain = 0.0
    while len(rates) < n_rates:
        tried = [(f, grown(bags, tuple(sorted((*rates, f))))) for f in range(n_rates) if f not in rates]
        cells = scored_cells(table, [forest for _, forest in tried])
        found = []
        for i, (f, forest) in enumerate(tried):
            own = cells[cells["forest"] == i]
            threshold, got = threshold_of(*(own[c].to_numpy() for c in ("low", "high", "good", "bad")))
            found.append((got, -f, Forest(**(forest.__dict__ | {"threshold": threshold}))))
        got, _, forest = max(found, key=lambda z: z[:2])
        if got <= gain:
            break
        best, gain, rates = forest, got, forest.rates
    return best


def labelled_counts(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, quality_col: str) -> DataFrame:
    """``k``, ``q`` and the counts of one whole document of every labelled id that passes the base rules.

    Of several documents of one id that with the smallest hash of its text.  Texts are counted where they lie: only counts are shuffled."""
    text = common.column(documents, text_col)
    counted = documents.select(common.column(documents, id_col).cast("bigint").alias("k"), F.xxhash64(text).alias("h"), statistics(text).alias("s"))
    one = counted.where("k IS NOT NULL").groupBy("k").agg(F.min(F.struct("h", "s")).alias("one"))
    key, quality = common.column(labels, id_col), common.column(labels, quality_col)
    marks = (labels.select(key.cast("bigint").alias("k"), quality.cast("int").alias("q")).where("k IS NOT NULL AND q IN (0, 1)")
             .groupBy("k").agg(F.min("q").alias("q")))
    found = one.join(marks, "k").select("k", "q", "one.s.*")
    return common.stored(found.where(f"n_words >= {MIN_WORDS} AND 100 * n_repeat_words <= {MAX_REPEAT_PERCENT} * n_words"), "quality")


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality") -> Forest:
    """Forest and threshold from all labelled documents."""
    table = labelled_counts(documents, labels, id_col, text_col, quality_col)
    rows = table.count()
    return chosen_forest(table, drawn(table, rows)) if rows else grow(np.zeros((1, 5)), (0,), trees=1)


def _counts(texts: pd.Series) -> np.ndarray:
    return np.array([text_counts(t) for t in texts], dtype=np.int64).reshape(-1, len(COUNTS))


def statistics(text):
    """Struct of the counts of a text column."""
    @F.pandas_udf(STATS)
    def counts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_counts(texts), columns=COUNTS)

    return counts(text)


def verdict(text, forest: Forest):
    """Struct of the counts, the base rules, the anomaly score and the verdict of a text column."""
    @F.pandas_udf(VERDICT)
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            counts = _counts(texts)
            failed = base_failed(counts)
            score = forest.score(features(counts))
            out = pd.DataFrame(counts, columns=COUNTS)
            yield out.assign(base_failed=failed, anomaly=score, kept=~failed & ~(score > forest.threshold))

    return judge(text)


def judged(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``documents`` with a struct column of the verdict, and that column's name."""
    common.prepare(documents.sparkSession)
    forest = fit(documents, labels, id_col, text_col)
    name = common.free_name(documents, "quality_verdict")
    return documents.withColumn(name, verdict(common.column(documents, text_col), forest)), name
