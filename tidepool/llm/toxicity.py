"""Toxicity: a learned lexicon, matched by Levenshtein automata, scored by context windows.

1. Lexicon.  From a bounded, repeatable sample of labelled documents: words and
   word stems that occur in toxic documents far oftener than chance allows, in
   different contexts (so that copies of one document teach nothing).  A stem
   needs different endings, of which misspellings of a word are none, and stands
   beside the words that it covers.
2. Matching.  The lexicon is a trie.  Its intersection with the Levenshtein
   automaton of up to ``edits`` errors per term is run as one deterministic
   automaton whose states are built when first met.  A word of 5 letters may
   have one error, one of 9 letters two; stems may have errors by their own
   length and match any ending.
3. Context.  The words around a match tell quotation (quote marks, verbs of
   saying) from address (you, ...) and from neither.
4. Score.  A match weighs as much as the share of matches of its term (exact, or
   misspelt) that lie in toxic labelled documents, less in quotation.  A text's
   weight, also relative to what toxic texts of its length have, goes through a
   logistic curve fitted on the sample.

Each worker keeps the verdicts of word forms it has met, up to a bound.

Defined cases: a null or empty text has no match and gets the score of that;
without toxic labels the lexicon is empty and every document gets that score;
several labels of one id count as toxic if one is, and of several documents of
one id the sample takes one; a null id is not held out; texts of any length are
scored whole; repeated rows are scored alike, each on its own; of terms that tell
as much the longer, then the first by letters is chosen first; an empty table
gives no rows; extra columns are kept, and the score takes a free name.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import common

#: Labelled documents that are learned from, at most: those of the smallest hashes of their ids.
FIT_ROWS = 12_000
#: Longer texts are scored like others, but not learned from.
FIT_BYTES = 1 << 18
STEM_LENGTHS = range(4, 9)
#: Different pairs of neighbours that a term needs: so many, and this share of the toxic documents that hold it.
MIN_CONTEXTS = 4
CONTEXT_SHARE = 0.5
MIN_ENDINGS = 4
#: Times that a word must be as frequent as a form within its errors for that form to be its misspelling.
RARER = 10
MIN_PRECISION = 0.5
#: Terms that chance alone may put into the lexicon.
CHANCE_TERMS = 0.5
#: Words on each side of a match that are its context.
WINDOW = 8
PREDICTED = 0.7
CACHE_FORMS = 400_000

# Cues of quotation and of address.
QUOTE_MARKS = "\"'“”„‟«»‹›‘’‚"
SAYING = frozenset("said says say saying called calls quote quoted quotes wrote written word words term terms phrase means meaning "
                   "sagte sagt nannte zitat wort dit dire citation mot dijo dice cita palabra".split())
ADDRESS = frozenset("you your you're youre yours u ur yourself du dich dein deine ihr euch tu te toi vous votre tú ti usted eres".split())
QUOTED, NEUTRAL, DIRECT = 0, 1, 2
#: What a match weighs in each context, times the weight of its term.
CONTEXT_WEIGHT = {QUOTED: 0.35, NEUTRAL: 1.0, DIRECT: 1.0}
#: Share assumed for a term with no matches in the sample, as so many matches' evidence: exact, one error, more.
PRIOR = (0.9, 0.6, 0.5)
PRIOR_WEIGHT = 1.0

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def edits(term: str) -> int:
    """Errors that a term may have; a stem without its ending."""
    n = len(term.rstrip("*"))
    return 0 if n < 5 else 1 if n < 9 else 2


def bare(word: str) -> str:
    """A lower-case word without the punctuation around it."""
    return word if word.isalpha() else _EDGE.sub("", word)


class Automaton:
    """The lexicon trie intersected with Levenshtein automata, made deterministic as it runs.

    A state is a set of (trie node, errors so far).  ``match`` gives (errors,
    term) of the best term that a word spells, or None: the fewest errors, then
    words before stems.
    """

    def __init__(self, terms):
        self.child: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.most: list[int] = [0]  # errors allowed by some term at or below the node
        for term in sorted(terms):
            stem, k, node = term.rstrip("*"), edits(term), 0
            self.most[0] = max(self.most[0], k)
            for c in stem:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.word.append(None)
                    self.stem.append(None)
                    self.most.append(0)
                node = self.child[node][c]
                self.most[node] = max(self.most[node], k)
            (self.stem if term.endswith("*") else self.word)[node] = term
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.step: list[dict[str, int]] = []
        self.found: list[tuple[int, str] | None] = []  # the best word that ends here
        self.begun: list[tuple[int, str] | None] = []  # the best stem that ends here
        self.dead = self._state(set())
        self.start = self._state({(0, 0)})

    def _state(self, members: set[tuple[int, int]]) -> int:
        closed, todo = set(), list(members)
        while todo:  # a letter of the term left out costs an error
            node, e = todo.pop()
            if e > self.most[node] or (node, e) in closed:
                continue
            closed.add((node, e))
            todo += [(n, e + 1) for n in self.child[node].values()]
        key = frozenset(closed)
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.step.append({})
            for best, terms in ((self.found, self.word), (self.begun, self.stem)):
                ends = [(e, terms[n]) for n, e in key if terms[n] and e <= edits(terms[n])]
                best.append(min(ends) if ends else None)
        return self.ids[key]

    def _next(self, state: int, c: str) -> int:
        members = set()
        for node, e in self.sets[state]:
            if c in self.child[node]:
                members.add((self.child[node][c], e))
            members.add((node, e + 1))  # a letter too many
            members.update((n, e + 1) for n in self.child[node].values())  # another letter
        out = self.step[state][c] = self._state(members)
        return out

    def match(self, word: str) -> tuple[int, str] | None:
        state, step = self.start, self.step
        stem = None
        for c in word:
            state = step[state].get(c, -1) if c in step[state] else self._next(state, c)
            if state == self.dead:
                return stem
            best = self.begun[state]
            if best and (stem is None or best < stem):
                stem = best
        whole = self.found[state]
        return whole if whole and (stem is None or whole[0] <= stem[0]) else stem


class Forms(dict):
    """Verdicts of raw word forms, computed when first met."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, raw: str):
        word = bare(raw)
        best = self.automaton.match(word) if word else None
        out = self[raw] = (*best, word) if best else None
        return out


def context(words: list[str], at: int) -> int:
    """Whether the words around one are a quotation, an address or neither."""
    around = words[max(0, at - WINDOW): at + WINDOW + 1]
    middle = min(at, WINDOW)
    before, after = around[: middle + 1], around[middle:]
    opened = any(w[0] in QUOTE_MARKS for w in before) and any(w.rstrip(".,;:!?")[-1:] in QUOTE_MARKS and w.rstrip(".,;:!?") for w in after)
    bares = {bare(w) for w in around}
    if opened or not bares.isdisjoint(SAYING):
        return QUOTED
    return NEUTRAL if bares.isdisjoint(ADDRESS) else DIRECT


def matches(text: str | None, forms: Forms) -> list[tuple[int, str, str, int]]:
    """(errors, term, form, context) of every match in a text."""
    words = (text or "").lower().split()
    out = []
    for at, found in enumerate(map(forms.__getitem__, words)):
        if found:
            out.append((*found, context(words, at)))
    if len(forms) > CACHE_FORMS:
        forms.clear()
    return out


@dataclass
class Model:
    terms: tuple[str, ...] = ()
    weights: dict[tuple[int, str], float] = field(default_factory=dict)  # by errors and term
    usual: tuple[float, float] = (1.0, 0.0)  # weight of a toxic text: at no length, and more per word
    curve: tuple[float, float, float] = (math.log(0.01), 0.0, 0.0)

    def weight(self, found: list[tuple[int, str, str, int]]) -> float:
        return sum(self.weights.get((e, term), PRIOR[min(e, 2)]) * CONTEXT_WEIGHT[where] for e, term, _, where in found)

    def score(self, text: str | None, forms: Forms) -> float:
        found = matches(text, forms)
        x = _inputs(np.array([self.weight(found)]), np.array([len((text or "").split()) if found else 0]), self.usual)
        return float(1 / (1 + np.exp(-(x @ np.array(self.curve))[0])))


def _inputs(weight: np.ndarray, words: np.ndarray, usual: tuple[float, float]) -> np.ndarray:
    """What the curve is fitted on: one, the weight (up to 3), and its share of a toxic text's (up to 2)."""
    share = weight / (usual[0] + usual[1] * words)
    return np.stack([np.ones(len(weight)), np.minimum(weight, 3.0), np.minimum(share, 2.0)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02, steps: int = 50) -> np.ndarray:
    """Coefficients of a logistic curve by Newton's method."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge / 10, *[ridge] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, gradient)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _terms(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in STEM_LENGTHS if len(word) > k)] if len(word) >= 4 else []


def _tail(hits: int, n: int, p: float) -> float:
    """Probability of ``hits`` or more of ``n`` at chance ``p`` each."""
    if p <= 0 or p >= 1:
        return 0.0 if p <= 0 else 1.0
    log = math.lgamma(n + 1) + hits * math.log(p) + (n - hits) * math.log(1 - p) - math.lgamma(hits + 1) - math.lgamma(n - hits + 1)
    term, total = math.exp(log), 0.0
    for k in range(hits, n + 1):
        total += term
        if term < total * 1e-12:
            break
        term *= (n - k) / (k + 1) * p / (1 - p)
    return min(1.0, total)


def held_out(id_):
    """Whether a document is kept from learning: CRC-32 of its id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(documents: DataFrame, labels: DataFrame, fit_rows: int, id_col: str, text_col: str, toxic_col: str) -> DataFrame:
    """At most ``fit_rows`` labelled documents that may be learned from, stored: ``toxic``, ``t``; one of each sampled id, of at most ``FIT_BYTES`` bytes."""
    key, toxic = common.column(labels, id_col), common.column(labels, toxic_col)
    chosen = (
        labels.select(key.cast("bigint").alias("k"), toxic.cast("int").alias("toxic")).where("k IS NOT NULL AND toxic IN (0, 1)")
        .where(~held_out(F.col("k"))).groupBy("k").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("k"), "k").limit(fit_rows)
    )
    return common.stored(common.one_per_id(documents, id_col, text_col, chosen, FIT_BYTES).select("toxic", "t"), "toxicity-sample")


def lexicon(rows: DataFrame) -> tuple[str, ...]:
    """Words and stems (ending in ``*``) that mark toxic documents of the sample."""
    n_all, n_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n_toxic < n_all:
        return ()
    held = pa.schema([("term", pa.string()), ("word", pa.string()), ("doc", pa.int64()), ("around", pa.string())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(batch):
            for doc, text in zip(batch["doc"].to_pylist(), batch["t"].to_pylist()):
                words = [bare(w) for w in (text or "").lower().split()]
                for w, before, after in zip(words, ["", *words], [*words[1:], ""]):
                    # In a run of one word its neighbours say nothing.
                    around = None if w in (before, after) else f"{before} {after}"
                    for term in _terms(w):
                        yield term, w, doc, around

        for batch in batches:
            yield from common.batches(out(batch), held)

    doc = F.monotonically_increasing_id()
    toxic = rows.where("toxic = 1").select(doc.alias("doc"), F.col("t"))
    seen = (
        toxic.mapInArrow(spread, "term string, word string, doc bigint, around string").groupBy("term")
        .agg(F.countDistinct("doc").alias("n"), F.countDistinct("around").alias("contexts"), F.countDistinct("word").alias("endings"))
        .where(F.col("contexts") >= F.greatest(F.lit(MIN_CONTEXTS), F.col("n") * CONTEXT_SHARE))
    )
    found = {r.term: (r.n, r.endings) for r in seen.collect() if not r.term.endswith("*") or r.endings >= MIN_ENDINGS}
    counted = pa.schema([("term", pa.string()), ("n", pa.int64())])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch["t"].to_pylist():
                words = {bare(w) for w in (text or "").lower().split()}
                counts.update({term for w in words for term in _terms(w) if term in found})
        yield from common.batches(iter(counts.items()), counted)

    others = rows.where("toxic = 0").select("t").mapInArrow(clean, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    against = {r.term: r.n for r in others.collect()}
    base = n_toxic / n_all
    gain = {}
    for term, (n, _) in found.items():
        m = against.get(term, 0)
        if n / (n + m) >= MIN_PRECISION and _tail(n, n + m, base) * len(found) < CHANCE_TERMS:
            gain[term] = n * math.log((n + 0.5) / (n_toxic + 1) * (n_all - n_toxic + 1) / (m + 0.5))
    order = sorted(gain, key=lambda t: (-gain[t], -len(t), t))
    endings = _endings(toxic, {t: found[t][0] for t in order if not t.endswith("*")}, {t for t in order if t.endswith("*")})
    chosen: list[str] = []
    for term in order:  # all words; of stems that hold each other or a word, the one that tells most
        stem = term[:-1]
        if not term.endswith("*") or (endings.get(term, 0) >= MIN_ENDINGS and not any(
                c.startswith(stem) or (c.endswith("*") and stem.startswith(c[:-1])) for c in chosen)):
            chosen.append(term)
    return tuple(sorted(chosen))


def _endings(toxic: DataFrame, words: dict[str, int], stems: set[str]) -> dict[str, int]:
    """Different forms of each stem in toxic documents, without the misspellings of ``words`` (with their documents).

    A misspelling lies within the errors of a word that is ``RARER`` times as frequent."""
    if not stems:
        return {}
    held, counted = pa.schema([("word", pa.string())]), pa.schema([("term", pa.string())])
    often = sorted(words, key=lambda w: (-words[w], w))
    falling = [-words[w] for w in often]

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = ((w,) for text in batch["t"].to_pylist() for w in {bare(w) for w in (text or "").lower().split()}
                     if not stems.isdisjoint(_terms(w)))
            yield from common.batches(found, held)

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_first: dict[int, Automaton] = {}

        def out(batch):
            for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist()):
                first = bisect_right(falling, -RARER * n)
                if first not in of_first:
                    of_first[first] = Automaton(often[:first])
                if not of_first[first].match(word):
                    yield from ((term,) for term in stems.intersection(_terms(word)))

        for batch in batches:
            yield from common.batches(out(batch), counted)

    documents = toxic.select("t").mapInArrow(forms, "word string").groupBy("word").agg(F.count("*").alias("n"))
    return {r.term: r.n for r in documents.mapInArrow(apart, "term string").groupBy("term").agg(F.count("*").alias("n")).collect()}


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
        fit_rows: int = FIT_ROWS) -> Model:
    """Lexicon and weights from at most ``fit_rows`` labelled documents."""
    rows = sample(documents, labels, fit_rows, id_col, text_col, toxic_col)
    terms = lexicon(rows)
    schema = pa.schema([("toxic", pa.int32()), ("doc", pa.int64()), ("words", pa.int64()), ("errors", pa.int32()),
                        ("term", pa.string()), ("place", pa.int32()), ("n", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = Forms(Automaton(terms))

        def out(batch):
            for toxic, doc, text in zip(batch["toxic"].to_pylist(), batch["doc"].to_pylist(), batch["t"].to_pylist()):
                kinds = Counter((e, term, where) for e, term, _, where in matches(text, forms))
                words = len((text or "").split())
                yield from ((toxic, doc, words, *kind, n) for kind, n in (kinds or {(-1, "", NEUTRAL): 0}).items())

        for batch in batches:
            yield from common.batches(out(batch), schema)

    numbered = rows.select("toxic", F.monotonically_increasing_id().alias("doc"), "t")
    # At most a row per sampled document and term: the sample bounds it.
    table = numbered.mapInArrow(find, "toxic int, doc bigint, words bigint, errors int, term string, place int, n bigint").toPandas()
    return _weighed(terms, table)


def _weighed(terms: tuple[str, ...], table: pd.DataFrame) -> Model:
    """Weights and curve from the matches of the sample."""
    if not len(table) or table["toxic"].nunique() < 2:
        return Model(terms)
    hits = table[table["errors"] >= 0].assign(bad=lambda t: t["n"] * t["toxic"])
    sums = hits.groupby(["errors", "term"])[["bad", "n"]].sum()
    weights = {(int(e), term): float((bad + PRIOR[min(int(e), 2)] * PRIOR_WEIGHT) / (n + PRIOR_WEIGHT)) for (e, term), bad, n in sums.itertuples()}
    each = [w * CONTEXT_WEIGHT[p] * n for w, p, n in zip(
        (weights.get((e, t), 0.0) for e, t in zip(table["errors"], table["term"])), table["place"], table["n"])]
    docs = table.assign(weight=each).groupby("doc").agg(toxic=("toxic", "max"), words=("words", "max"), weight=("weight", "sum"))
    weight, words, toxic = docs["weight"].to_numpy(float), docs["words"].to_numpy(float), docs["toxic"].to_numpy(float)
    some = (toxic == 1) & (weight > 0)
    usual = (1.0, 0.0)
    if some.sum() >= 3:
        scale = np.sqrt(words[some] + 60)  # long texts vary more
        design = np.stack([np.ones(some.sum()), words[some]], axis=1) / scale[:, None]
        at_none, per_word = np.linalg.lstsq(design, weight[some] / scale, rcond=None)[0]
        usual = (float(np.clip(at_none, 0.5, 5)), float(np.clip(per_word, 0, 0.2)))
    return Model(terms, weights, usual, tuple(float(c) for c in _logistic(_inputs(weight, words, usual), toxic)))


def score(text, model: Model):
    """Score of a text column."""
    @F.pandas_udf("double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forms = Forms(Automaton(model.terms))
        for texts in parts:
            yield pd.Series([model.score(t, forms) for t in texts], dtype="float64")

    return scores(text)


def scored(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``documents`` with a score column, and that column's name."""
    common.prepare(documents.sparkSession)
    model = fit(documents, labels, id_col, text_col)
    name = common.free_name(documents, "toxicity_score")
    return documents.withColumn(name, score(common.column(documents, text_col), model)), name
