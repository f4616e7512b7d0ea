"""Fill-in-the-middle: texts cut at two unit ends, and their parts moved around markers.

A unit is a word with the blanks before it; blanks at a text's end are one more.
A unit therefore ends at a byte that is no blank before one that is (or before
the end).  All texts of a batch lie in one buffer, each padded with blanks to
whole words of eight bytes, and the buffer is viewed as ``uint64``: blanks are
found in all eight bytes by additions that can't carry, unit ends by shifting
the marks by a byte, and ``bitwise_count`` numbers the ends per word.  The k-th
end of a text is a search in the running counts for its word, then a select of
one bit in that word.  Code points are counted the same way, by their first
bytes.  No regular expression runs and no text is looked at byte by byte.

Which cut, and which form, follows from the hash of a seed and the row's id:
the same on every machine and in every run.

Defined cases: a null text is an empty one, which is plain with no units; a text
that holds a marker stays plain, so that the others can be put back together; a
null id hashes as no digits; rows of equal ids are cut at the same unit numbers;
texts of any length are cut whole (a longer one than ``TURN_BYTES`` has a turn
of its own); an empty table gives no rows; the added column takes a free name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm import common

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Percent of the texts that are cut at all, and of those the suffix-first ones.
RATE = 50
SPM_RATE = 80
SEED = 42
#: Bytes of text that are worked on at once.
TURN_BYTES = 4 << 20

RESULT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"

_TOP = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_ONE = np.uint64(1)


def _each(byte: int) -> np.uint64:
    """The byte in all eight places of a word."""
    return np.uint64(byte * 0x0101010101010101)


def blank_marks(words: np.ndarray) -> np.ndarray:
    """Top bit of every byte that is a blank (0x20, 0x09-0x0D)."""
    low = words & _LOW
    is_space = ~((low ^ _each(0x20)) + _LOW)  # top bit unless the seven bits differ
    is_control = (low + _each(0x80 - 0x09)) & ~(low + _each(0x80 - 0x0E))
    return (is_space | is_control) & ~words & _TOP


def first_byte_marks(words: np.ndarray) -> np.ndarray:
    """Top bit of every byte that begins a code point."""
    return ~(words & ~(words << _ONE)) & _TOP


def select(marks: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Byte (0 to 7) of the r-th mark, from 1, of each word of marks."""
    marks = marks.copy()
    for step in range(1, 8):
        again = r > step
        if not again.any():
            break
        marks[again] &= marks[again] - _ONE  # the lowest mark goes
    lowest = marks & (~marks + _ONE)
    return np.bitwise_count(lowest - _ONE).astype(np.int64) >> 3


class Texts:
    """Texts (bytes) in one padded buffer, with their unit ends and code points numbered."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        held = self.sizes // 8 + 1  # words: a blank at least behind each text
        self.starts = (np.cumsum(held) - held) * 8
        words = np.frombuffer(b"".join(t.ljust(int(k) * 8) for t, k in zip(texts, held)), dtype="<u8")
        blank = blank_marks(words)
        following = np.append(blank[1:], _TOP)
        self.ends = ~blank & ((blank >> np.uint64(8)) | (following << np.uint64(56))) & _TOP
        # A text that ends with a blank ends a unit there.
        last = self.starts + self.sizes - 1
        at, bit = last >> 3, np.uint64(0x80) << ((last & 7).astype(np.uint64) << np.uint64(3))
        trailing = self.sizes > 0
        trailing[trailing] = (blank[at[trailing]] & bit[trailing]) != 0
        self.ends[at[trailing]] |= bit[trailing]
        self.upto = np.concatenate(([0], np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)))
        first = self.starts >> 3
        self.before = self.upto[first]
        self.n = self.upto[first + held] - self.before
        self.leads = first_byte_marks(words)
        self.leads_upto = np.concatenate(([0], np.cumsum(np.bitwise_count(self.leads), dtype=np.int64)))

    def after(self, k: np.ndarray) -> np.ndarray:
        """Place in the buffer behind the k-th unit of each text (0: its start)."""
        rank = self.before + k
        word = np.maximum(np.searchsorted(self.upto, rank, side="left") - 1, 0)
        some = k > 0
        place = self.starts.copy()
        place[some] = word[some] * 8 + select(self.ends[word[some]], (rank - self.upto[word])[some]) + 1
        return place

    def points(self, at: np.ndarray) -> np.ndarray:
        """Code points that begin before each place of the buffer."""
        word, inside = at >> 3, (at & 7).astype(np.uint64)
        below = (_ONE << (inside << np.uint64(3))) - _ONE
        marks = np.append(self.leads, np.uint64(0))[word] & below
        return self.leads_upto[word] + np.bitwise_count(marks).astype(np.int64)


def arranged(texts: list[bytes], draws: np.ndarray) -> Iterator[tuple]:
    """``RESULT`` of each text; ``draws`` holds four numbers a text: two cuts, whether, and in which form."""
    found = Texts(texts)
    a, b = draws[:, 0] % (found.n + 1), draws[:, 1] % (found.n + 1)
    one, two = found.after(np.minimum(a, b)), found.after(np.maximum(a, b))
    zero, p1, p2 = found.points(found.starts), found.points(one), found.points(two)
    one, two = one - found.starts, two - found.starts
    cut, suffix_first = draws[:, 2] % 100 < RATE, draws[:, 3] % 100 < SPM_RATE
    for i, t in enumerate(texts):
        n = int(found.n[i])
        if not t or not cut[i] or PREFIX in t or SUFFIX in t or MIDDLE in t:
            yield n, "plain", None, None, t
            continue
        prefix, middle, suffix = t[: one[i]], t[one[i]: two[i]], t[two[i]:]
        parts = (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle) if suffix_first[i] else (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
        yield n, "spm" if suffix_first[i] else "psm", int(p1[i] - zero[i]), int(p2[i] - p1[i]), b"".join(parts)


def draws_of(ids: list[int | None], seed: int) -> np.ndarray:
    """Four unsigned 32-bit numbers per id, from the SHA-256 of ``seed:id``."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(raw, dtype=">u4").reshape(-1, 4).astype(np.int64)


def _turns(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``TURN_BYTES``."""
    begin = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > TURN_BYTES:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> tuple[DataFrame, str]:
    """``df`` with a struct of ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` text; and its name."""
    schema = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])

    @F.arrow_udf(RESULT.join(("struct<", ">")).replace(" bigint", ": bigint").replace(" string", ": string").replace(" binary", ": binary"))
    def transform(ids: pa.Array, texts: pa.Array) -> pa.Array:
        data = [t or b"" for t in texts.to_pylist()]
        draws = draws_of(ids.to_pylist(), seed)
        rows = [r for a, b in _turns(list(map(len, data))) for r in arranged(data[a:b], draws[a:b])]
        columns = zip(*rows) if rows else [[]] * len(schema)
        return pa.StructArray.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], fields=list(schema))

    name = common.free_name(df, "fim")
    result = transform(common.column(df, id_col).cast("bigint"), common.column(df, text_col).cast("binary"))
    out = df.withColumn(name, result)
    made = F.col(name)
    return out.withColumn(name, made.withField("output", made["output"].cast("string"))), name


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: what stands between its markers, in its own order."""
    parts = F.split(F.substring(output, 4, 2**31 - 1), "<[PSM]>")
    prefix = F.when(form == "psm", F.get(parts, F.lit(0))).otherwise(F.get(parts, F.lit(1)))
    suffix = F.when(form == "psm", F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(0)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, F.lit(2)), suffix))
