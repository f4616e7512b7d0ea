"""Quality rules, toxicity, token counts."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.llm import quality, token_counts, toxicity
from tidepool.llm.encoding import public_tokenizer
from tidepool.llm.queries import QUERIES
from tidepool.sources.tables import load

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, quality_verdict string, toxicity_score int"
TEXTS = [None, "", " \n\t ", "a", "a b c d e f g h i j", "a b c d e a b c d e", "x y z w v " * 30, "l1 a\nl1 a\n \n\nl1 a", "É ü\x1cñ\xa0b # $|", "w" * 5000, "one two three four five six " * 3000]


def counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i: i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i: i + 5])] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), len(set(words)), len(lines))


def test_counts_by_brute_force():
    draw = np.random.default_rng(0)
    texts = TEXTS + [" ".join(draw.choice(list("abc"), draw.integers(0, 40))) for _ in range(300)]
    for text in texts:
        assert quality.text_counts(text) == counts(text), text


def test_repeats_with_codes_that_would_overflow():
    ids = np.random.default_rng(1).integers(0, 2**40, 60)
    ids[50:56] = ids[3:9]
    assert quality.repeat_words(ids) == 12
    assert quality.repeat_words(np.zeros(4, dtype=np.int64)) == 0


def test_quality_query(spark):
    """The forest's verdict agrees with the labels; the counts hold for every document."""
    rows = {r.doc_id: r for r in QUERIES["op3_quality_rules"](spark, SF).collect()}
    texts = {r.doc_id: r.text for r in load(spark, SF, "documents").collect()}
    assert rows.keys() == texts.keys()
    for k, r in rows.items():
        assert tuple(r[c] for c in quality.COUNTS) == counts(texts[k])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    labels = {r.doc_id: r.quality for r in load(spark, SF, "labels").collect()}
    judged = [(labels[k], r.kept) for k, r in rows.items() if k in labels and not r.base_failed]
    assert np.mean([kept for good, kept in judged if good]) > 0.99
    assert np.mean([kept for good, kept in judged if not good]) < 0.2


def test_forest_scores_outliers_higher_and_repeats(spark):
    draw = np.random.default_rng(2)
    x = np.concatenate([draw.normal(0, 1, (500, 3)), draw.normal(8, 1, (10, 3))])
    forest = quality.grow(x, (0, 1, 2))
    score = forest.score(x)
    assert score[500:].min() > np.quantile(score[:500], 0.98)
    assert np.array_equal(score, quality.grow(x, (0, 1, 2)).score(x))
    assert quality.calibrate(score, np.ones(510, bool)) == (np.inf, 0.0)
    threshold, gain = quality.calibrate(score, np.arange(510) < 500)
    assert gain > 0.9 and (score[500:] > threshold).mean() > 0.9
    assert quality.grow(np.zeros((1, 5)), (0,), trees=1).score(np.zeros((2, 5))).shape == (2,)


@pytest.mark.parametrize("labels", [[], [(4, 1)], [(4, 1), (5, 0), (4, 0), (None, 1), (6, None)]])
def test_quality_of_odd_tables(spark, labels):
    docs = spark.createDataFrame([(k, t, "kept", 1) for k, t in enumerate(TEXTS)] + [(None, "x " * 20, "n", 0), (4, TEXTS[4], "twice", 0)], DOCS)
    found, name = quality.judged(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    out = found.select(*[f"`{c}`" for c in docs.columns], f"`{name}`.*").collect()
    assert len(out) == len(TEXTS) + 2 and {r.quality_verdict for r in out} == {"kept", "n", "twice"}
    assert all(r.base_failed for r in out if not r.text)
    empty, _ = quality.judged(docs.limit(0), spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert empty.count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_by_brute_force():
    terms = ["idiot", "scum", "worthless", "moron", "stem*", "mor"]
    automaton = toxicity.Automaton(terms)
    draw = np.random.default_rng(3)
    words = ["idiot", "idot", "idiiot", "xdiot", "idi", "scum", "scumm", "wortless", "worthles", "wrthlss", "stem", "stemming", "tem", "moron", "oron", "mor", "", "é" * 9]
    words += ["".join(draw.permutation(list(t))[: draw.integers(1, len(t) + 1)]) for t in terms * 40]
    words += [t[:i] + c + t[i + k:] for t in terms for i in range(len(t)) for c in ("", "x", "qq") for k in (0, 1, 2)]
    for word in words:
        want = []
        for t in terms:
            if t.endswith("*"):
                want += [(0, t)] if word.startswith(t[:-1]) else []
            elif (d := distance(word, t)) <= toxicity.edits(t):
                want.append((d, t))
        got = automaton.match(word)
        if any(t.endswith("*") for _, t in want):
            assert got == (0, "stem*"), word
        else:
            assert got == (min(want) if want else None), word


def test_quotation_weighs_less():
    forms = toxicity.Forms(toxicity.Automaton(["idiot"]))
    filler = " lorem ipsum dolor" * 8
    model = toxicity.Model(("idiot",), {(0, "idiot"): 1.0}, (1.0, 0.0), (-5.0, 1.0, 7.0))
    plain, quoted = f"you are an idiot{filler}", f'they wrote "what an idiot" about it{filler}'
    assert toxicity.matches(plain, forms)[0][3] == toxicity.DIRECT
    assert toxicity.matches(quoted, forms)[0][3] == toxicity.QUOTED
    assert model.score(plain, forms) > 0.7 > model.score(quoted, forms) > model.score(filler, forms)
    assert model.score("what an iidiot" + filler, forms) > model.score(filler, forms)


def test_toxicity_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in load(spark, sf, "labels").collect()}
    assert len(rows) == load(spark, sf, "documents").count()
    for k, r in rows.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(labels[k], r.predicted) for k, r in rows.items() if k in labels and r.held_out]
    assert np.mean([p for t, p in held if t]) > 0.85
    assert np.mean([p for t, p in held if not t]) < 0.01


@pytest.mark.parametrize("labels", [[], [(4, 0)], [(4, 1), (5, 0), (4, 0), (None, 1), (6, None)]])
def test_toxicity_of_odd_tables(spark, labels):
    docs = spark.createDataFrame([(k, t, "kept", 1) for k, t in enumerate(TEXTS)] + [(None, "x " * 20, "n", 0), (4, TEXTS[4], "twice", 0)], DOCS)
    found, name = toxicity.scored(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    out = found.collect()
    assert len(out) == len(TEXTS) + 2 and name != "toxicity_score"
    assert len({r[name] for r in out if not r.text}) == 1 and all(0 <= r[name] < 0.7 for r in out)
    empty, _ = toxicity.scored(docs.limit(0), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert empty.count() == 0


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(token_counts.scores(token_counts.vocabulary(public_tokenizer("piece_bpe_32k.model"))), cache_words=500)


def segmented(word, score, byte):
    s = token_counts.WORD_MARK + word
    best = [(0.0, 0)]
    for j in range(1, len(s) + 1):
        n = len(s[j - 1].encode())
        ways = [(best[j - 1][0] + n * byte, best[j - 1][1] - n)]
        ways += [(best[i][0] + score[s[i:j]], best[i][1] - 1) for i in range(max(0, j - 40), j) if s[i:j] in score]
        best.append(max(ways))
    return -best[-1][1], best[-1][0]


def test_token_counts_by_brute_force(spark, counter):
    path = public_tokenizer("piece_bpe_32k.model")
    score = token_counts.scores(token_counts.vocabulary(path))
    docs = spark.createDataFrame([(k, t, "", 0) for k, t in enumerate(TEXTS + ["日本語😀 the THE", "y" * 60 + " " + "日本" * 40])], DOCS)
    out = {r.doc_id: r for r in token_counts.token_counts(docs, path).collect()}
    for k, text, *_ in docs.collect():
        want = [segmented(w, score, counter.byte) for w in WORD.findall(text or "")]
        assert (out[k].n_pretokens, out[k].n_tokens) == (len(want), sum(n for n, _ in want))
        assert out[k].score == pytest.approx(sum(s for _, s in want))
    assert token_counts.token_counts(docs.limit(0), path).count() == 0
    total = token_counts.total(token_counts.token_counts(docs, path)).first()
    assert total.n_tokens == sum(r.n_tokens for r in out.values())


def test_token_counts_of_real_words(spark, counter):
    score = token_counts.scores(token_counts.vocabulary(public_tokenizer("piece_bpe_32k.model")))
    words = sorted({w for r in load(spark, SF, "documents").limit(60).collect() for w in WORD.findall(r.text)})
    for i in range(0, len(words), 400):
        counter.words = {"": (0, 0.0)}
        counter.learn(words[i: i + 400])
        for w in words[i: i + 400]:
            n, s = counter.words[w]
            want = segmented(w, score, counter.byte)
            assert n == want[0] and s == pytest.approx(want[1]), w


def test_nul_characters_count(spark, counter):
    """U+0000 at a word's end, and within, in words that share a trie and in long ones."""
    words = ["a", "a\0", "a\0\0", "a\0b", "\0", "\0" * 60, "b" * 60 + "\0"]
    counter.words = {"": (0, 0.0)}
    score = token_counts.scores(token_counts.vocabulary(public_tokenizer("piece_bpe_32k.model")))
    n, tokens, total = counter.texts(pa.array(words))
    for w, count, s in zip(words, tokens.tolist(), total.tolist()):
        want = segmented(w, score, counter.byte)
        assert count == want[0] and s == pytest.approx(want[1]), repr(w)


def test_the_token_count_query(spark, counter):
    score = token_counts.scores(token_counts.vocabulary(public_tokenizer("piece_bpe_32k.model")))
    known = {}
    got = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, SF).collect()}
    for d in load(spark, SF, "documents").collect():
        words = WORD.findall(d.text or "")
        for w in words:
            known[w] = known.get(w) or segmented(w, score, counter.byte)
        r = got.pop(d.doc_id)
        assert (r.n_pretokens, r.n_tokens) == (len(words), sum(known[w][0] for w in words)) and r.score == pytest.approx(sum(known[w][1] for w in words))
    assert not got


def test_one_labelled_id_on_very_many_documents(spark):
    """The learning samples are bounded in rows and bytes: one document of each id, and none of the longest."""
    many = spark.range(3000).select(F.lit(7).cast("bigint").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))
    others = spark.createDataFrame([(8, "a b c"), (9, "x" * (toxicity.FIT_BYTES + 1)), (10, None), (None, "no id")], "doc_id bigint, text string")
    docs = many.unionByName(others)
    labels = spark.createDataFrame([(i, 1, 0) for i in (7, 8, 9, 10)] + [(7, 1, 0)], "doc_id bigint, toxic int, quality int")
    rows = toxicity.sample(docs, labels, 10, "doc_id", "text", "toxic").collect()
    learned = [i for i in (7, 8, 10) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(rows) == len(learned)
    again = toxicity.sample(docs.repartition(7), labels, 10, "doc_id", "text", "toxic").collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    found, name = quality.judged(docs, labels)
    assert found.count() == 3004


def test_path_lengths_by_brute_force():
    """Scores against trees walked node by node; the length of a leaf's path is the splits above it and what is expected of its rows."""
    draw = np.random.default_rng(2)
    x = np.round(draw.normal(size=(400, 4)), 1)
    rates = (0, 2, 3)
    forest = quality.grow(x, rates, trees=7, rows=100, depth=6)
    for row, got in zip(x[:80], forest.score(x[:80])):
        lengths = []
        for t in range(7):
            node, level = 0, 0
            while forest.feature[t, node] >= 0:
                right = row[rates[forest.feature[t, node]]] >= forest.value[t, node]
                node, level = forest.left[t, node] + int(right), level + 1
            held = forest.path[t, node] - level
            assert level <= 6 and held >= 0
            lengths.append(level + held)
        assert got == pytest.approx(2 ** (-np.mean(lengths) / forest.norm))
    # A tree's leaves hold its 100 rows: their expected lengths add up from the numbers in them.
    harmonic = lambda n: 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
    possible = [harmonic(n) for n in range(101)]
    assert all(min(abs(forest.path[t, leaf] - level - p) for p in possible) < 1e-9 for t in range(7) for leaf, level in leaves_of(forest, t))


def leaves_of(forest, t):
    open_, out = [(0, 0)], []
    while open_:
        node, level = open_.pop()
        if forest.feature[t, node] < 0:
            out.append((node, level))
        else:
            open_ += [(forest.left[t, node], level + 1), (forest.left[t, node] + 1, level + 1)]
    return out


def test_copies_and_repeats_teach_nothing(spark):
    """A lexicon term needs varied neighbours: words of one toxic text in many copies, or of runs, are none."""
    draw = np.random.default_rng(5)
    common_words = [f"word{i}" for i in range(60)]
    rows = []
    for k in range(240):
        words = list(draw.choice(common_words, 30))
        toxic = k % 4 == 0
        if toxic:
            words.insert(int(draw.integers(0, 30)), "slurry")
        rows.append((int(toxic), " ".join(words)))
    copy = " ".join(draw.choice(common_words, 20)) + " innocent bystander stands here"
    rows += [(1, copy + f" tail{k}") for k in range(40)] + [(1, "again " * 20 + f"end{k % 3} " * 9) for k in range(20)]
    terms = toxicity.lexicon(spark.createDataFrame(rows, "toxic int, t string"))
    assert "slurry" in terms
    assert not {"innocent", "bystander", "stands", "again"} & set(terms) and len(terms) <= 3


def test_misspellings_in_labels_keep_the_word(spark):
    """Spellings of a word are no endings of a stem: the word stays and may have errors; a stem may, too."""
    draw = np.random.default_rng(11)
    common_words = [f"word{i}" for i in range(60)]
    spellings = ["trash"] * 60 + ["trasj", "trasch", "trashh", "trasx", "trazsh", "tash", "trush", "traxsh", "trasy"]
    inflected = [f"grobian{end}" for end in ("", "isch", "erei", "ismus", "entum", "hafte", "ische")]
    rows = []
    for k in range(1200):
        words = list(draw.choice(common_words, 30))
        if k % 4 == 0:
            words.insert(int(draw.integers(0, 30)), str(draw.choice(spellings if k % 8 else inflected)))
        rows.append((int(k % 4 == 0), " ".join(words)))
    terms = toxicity.lexicon(spark.createDataFrame(rows, "toxic int, t string"))
    assert "trash" in terms and not [t for t in terms if t.startswith("tra") and t.endswith("*")]
    automaton = toxicity.Automaton(terms)
    assert all(automaton.match(w) for w in ("trash", "tash", "trxsh", "trrash", "xtrash"))
    assert any(t.endswith("*") and "grobian".startswith(t[:-1]) for t in terms)
    assert automaton.match("grobianisieren")[0] == 0 and automaton.match("grbianisieren")[0] == 1
    both = toxicity.Automaton(["idiot", "idiot*"])
    assert [both.match(w) for w in ("idiot", "idiotxyz", "idotxyz", "idt")] == [(0, "idiot"), (0, "idiot*"), (1, "idiot*"), None]


def test_forest_learns_from_every_labelled_document(spark):
    """Bad documents that are long, or among the last by the hash of their ids, raise the threshold's verdict like any."""
    ids = spark.range(24_000).select(F.col("id"), F.row_number().over(Window.orderBy(F.xxhash64("id"), "id")).alias("nth"))
    clean = F.concat(F.lit("some plain words that tell a short story of day number "), F.col("id").cast("string"))
    late = F.col("nth") > 23_700
    docs = ids.select(F.col("id").alias("doc_id"), F.when(late, F.concat(F.lit("# $ % & | < > * # $ "), clean)).otherwise(clean).alias("text"), late.alias("bad"))
    docs = docs.persist()
    labels = docs.select("doc_id", (~F.col("bad")).cast("int").alias("quality"))
    found, name = quality.judged(docs, labels)
    assert {tuple(r) for r in found.groupBy("bad", f"{name}.kept").count().collect()} == {(False, True, 23_700), (True, False, 300)}
    docs.unpersist()

    rows = [(i, " ".join(f"word{j}{i}" for j in range(20 + i)), 1) for i in range(60)]
    rows += [(100 + i, " ".join(f"w{j}{i}#" for j in range(40_000)), 0) for i in range(5)]
    assert min(len(t) for i, t, _ in rows if i >= 100) > 1 << 18
    long = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    found, name = quality.judged(long.drop("quality"), long.select("doc_id", "quality"))
    assert {r.doc_id for r in found.where(f"NOT {name}.kept AND NOT {name}.base_failed").collect()} == set(range(100, 105))


def test_threshold_of_cells_is_that_of_rows(spark):
    """Scores counted in cells by Spark give the gain that the rows give, and a threshold between the same rows."""
    draw = np.random.default_rng(3)
    n = draw.integers(10, 400, 900)
    rows = [(i, int(i % 9 > 0), int(w), int(w * 5), int(draw.integers(0, 3 if i % 9 else 60)), 0, 0, int(w * 0.8), 1) for i, w in enumerate(n)]
    table = spark.createDataFrame(rows, "k bigint, q int, " + quality.STATS).repartition(5)
    bags = quality.drawn(table, len(rows))
    assert len(bags) == quality.TREES and {len(b) for b in bags} == {quality.TREE_ROWS}
    forest = quality.grown(bags, (0, 1))
    cells = quality.scored_cells(table, [forest])
    threshold, gain = quality.threshold_of(*(cells[c].to_numpy() for c in ("low", "high", "good", "bad")))
    score = forest.score(quality.features(np.array([r[2:] for r in rows])))
    good = np.array([r[1] for r in rows]) == 1
    exact, best = quality.calibrate(score, good)
    assert gain == pytest.approx(best, abs=0.02) and ((score > threshold) != (score > exact)).mean() < 0.01
