"""Token counts under a unigram model: one dynamic programme per prefix, shared through a trie.

A text's pre-tokens are its words.  The best segmentation of a word into pieces
of a public vocabulary maximises the sum of the pieces' scores; the forward
scores of a prefix don't depend on what follows, so they are computed once per
trie node.  The distinct new words of a batch, sorted, are such a trie: rows
that share a prefix are neighbours, and a node is the first of them.  It is run
level by level in numpy: a node takes its parent's last forward scores and the
vocabulary-trie positions of the pieces that are still under way, moves them on
by its character, and keeps the best score and count.  Where a word ends, its
node's values are the word's terminal values.  Python workers remember words, up
to a bound; texts are counted in one pass with no shuffle.

Model: the vocabulary's pieces in rank order, with the Zipf log-probability
-log(rank + 2.7); a word starts with the vocabulary's word mark.  A character no
piece covers costs its UTF-8 bytes, a token each, with a score below every
piece's.  Ties of score go to fewer tokens.

Defined cases: a null or empty text has no pre-tokens, no tokens and score 0;
words above ``LONG_WORD`` characters are run one by one, in any length, and texts
of any length are counted whole; U+0000 is a character like others; repeated rows
and ids are texts of their own; an empty table gives no rows; other columns are
not read, so their names don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import common

WORD_MARK = "▁"
ZIPF_SHIFT = 2.7
#: Below the lowest piece's score, for each byte of a character that no piece covers.
BYTE_PENALTY = 10.0
#: Words a worker remembers, and characters of those that share a trie, at most.
CACHE_WORDS = 300_000
LONG_WORD = 48
#: Texts are counted in groups of about so many bytes.
GROUP_BYTES = 4_000_000

COUNTS = "doc_id bigint, n_pretokens bigint, n_tokens bigint, score double"

_COUNTERS: dict[str, "Counter"] = {}


def vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece model in rank order, without control and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def scores(pieces: list[str]) -> dict[str, float]:
    """Log-probability of each piece by its rank."""
    return {p: -math.log(rank + ZIPF_SHIFT) for rank, p in reversed(list(enumerate(pieces)))}


class Counter:
    """Terminal (tokens, score) of words by a vocabulary of scored pieces."""

    def __init__(self, score: dict[str, float], cache_words: int = CACHE_WORDS):
        self.byte = min(score.values()) - BYTE_PENALTY
        self.width = max(map(len, score))
        # The vocabulary as a trie in arrays: sorted (node, character) keys, their children, the score where a piece ends.
        nodes: dict[tuple[int, str], int] = {}
        ends = [-np.inf]
        for piece, value in score.items():
            at = 0
            for c in piece:
                if (at, c) not in nodes:
                    nodes[at, c] = len(ends)
                    ends.append(-np.inf)
                at = nodes[at, c]
            ends[at] = value
        keys = np.array([(at << 21) | ord(c) for at, c in nodes], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.children, self.ends = keys[order], np.array(list(nodes.values()))[order], np.array(ends)
        self.most = cache_words
        self.words: dict[str, tuple[int, float]] = {"": (0, 0.0)}

    def _onward(self, at: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Vocabulary nodes one character on; -1 where none is."""
        key = (at << 21) | c
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[k] == key, self.children[k], -1)

    def learn(self, words: list[str]) -> None:
        """Put the terminal values of ``words`` into the cache."""
        self.words |= {w: self._long(w) for w in words if len(w) > LONG_WORD}
        words = sorted(w for w in words if len(w) <= LONG_WORD)
        if not words:
            return
        text = np.array([WORD_MARK + w for w in words])
        letters = text.view(np.uint32).reshape(len(words), -1).astype(np.int64)
        length = np.array([len(w) + 1 for w in words])  # numpy's own lengths leave out NULs at the end
        # Characters shared with the row above; the padding behind a word is not one of them.
        same = np.concatenate(([0], np.minimum(np.cumprod(letters[1:] == letters[:-1], axis=1).sum(axis=1), length[:-1])))
        tokens, score = np.zeros(len(words), dtype=np.int64), np.zeros(len(words))
        node = np.zeros(len(words), dtype=np.int64)  # of each row, one level up
        # Of each node, for the last 1, 2, ... characters: the piece under way, score and tokens before it.
        under, before, count = np.full((1, self.width), -1), np.full((1, self.width), -np.inf), np.zeros((1, self.width), dtype=np.int64)
        now, held = np.zeros(1), np.zeros(1, dtype=np.int64)
        for d in range(1, letters.shape[1] + 1):
            alive = np.flatnonzero(length >= d)
            first = alive[same[alive] < d]  # a row per node of this level
            parent, c = node[first], letters[first, d - 1]
            under, before, count = (np.concatenate((front[parent, None], rest[parent, :-1]), axis=1)
                                    for front, rest in ((np.zeros(len(now), dtype=np.int64), under), (now, before), (held, count)))
            r, k = np.nonzero(under >= 0)
            under[r, k] = self._onward(under[r, k], c[r])
            size = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
            value = np.where(under >= 0, before + self.ends[np.maximum(under, 0)], -np.inf)
            alone = now[parent] + size * self.byte
            best = np.maximum(value.max(axis=1), alone)
            fewest = np.where(value == best[:, None], count + 1, np.iinfo(np.int64).max).min(axis=1)
            now, held = best, np.minimum(fewest, np.where(alone == best, held[parent] + size, np.iinfo(np.int64).max))
            at = np.cumsum(same[alive] < d) - 1
            node[alive] = at
            done = length[alive] == d
            tokens[alive[done]], score[alive[done]] = held[at[done]], now[at[done]]
        self.words.update(zip(words, zip(tokens.tolist(), score.tolist())))

    def _long(self, word: str) -> tuple[int, float]:
        """The same for one word of any length, with the last ``width`` characters' values."""
        letters = np.array([ord(c) for c in WORD_MARK + word])
        under, before, count = np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int64)
        now, held = 0.0, 0
        for c in letters.tolist():
            under, before, count = (np.append(rest, front)[-self.width:] for front, rest in ((0, under), (now, before), (held, count)))
            under = self._onward(under, np.full(len(under), c))
            on = under >= 0
            under, before, count = under[on], before[on], count[on]
            size = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
            ways = [(now + size * self.byte, -(held + size)), *zip((before + self.ends[under]).tolist(), (-count - 1).tolist())]
            now, held = max(ways)
            held = -held
        return int(held), float(now)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pre-tokens, tokens and score of every text of an array."""
        blank = pc.fill_null(texts, "")
        for c in "\t\n\v\f\r":
            blank = pc.replace_substring(blank, c, " ")
        parts = pc.split_pattern(blank, " ")
        bounds = parts.offsets.to_numpy()
        coded = parts.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        at, words, begin = coded.indices.to_numpy(), coded.dictionary.to_pylist(), bounds[:-1] - bounds[0]
        if len(self.words) + len(words) > self.most:
            self.words = {"": (0, 0.0)}
        self.learn([w for w in words if w not in self.words])
        tokens, score = (np.array(x) for x in zip(*[self.words[w] for w in words]))
        for w in words:
            if len(w) > LONG_WORD:
                del self.words[w]
        real = np.array([w != "" for w in words], dtype=np.int64)
        return tuple(np.add.reduceat(x[at], begin) for x in (real, tokens, score))


def counter(path: str) -> Counter:
    """One counter per worker process and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(scores(vocabulary(path)))
    return _COUNTERS[path]


def token_counts(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``COUNTS`` for every document."""
    common.prepare(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch["t"]), 0).to_numpy().astype(np.int64)
            begin = 0
            while begin < len(size):
                n = max(1, int(np.searchsorted(np.cumsum(size[begin:]), GROUP_BYTES, side="right")))
                words, tokens, score = model.texts(batch["t"].slice(begin, n))
                yield pa.RecordBatch.from_pydict({"doc_id": batch["k"].slice(begin, n), "n_pretokens": words, "n_tokens": tokens, "score": score})
                begin += n

    rows = documents.select(common.column(documents, id_col).cast("bigint").alias("k"), common.column(documents, text_col).alias("t"))
    return rows.mapInArrow(count, COUNTS)


def total(counts: DataFrame) -> DataFrame:
    """Corpus totals of ``token_counts``."""
    return counts.agg(F.sum("n_pretokens").alias("n_pretokens"), F.sum("n_tokens").alias("n_tokens"), F.sum("score").alias("score"))
