"""Token ids of texts with a tokenizer file of the ``tokenizers`` library, shared by several operators.

For a byte-level BPE without a normalizer, a new pre-token starts at every
space or line feed that stands between non-blanks, and where punctuation follows
a letter: BPE never merges across these places.  So texts are cut there, and
each distinct piece is encoded once as long as a Python worker remembers it; ids
equal those of encoding the whole text.  A text with other runs of blanks, and
any other kind of tokenizer, is encoded whole.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Default bounds of the piece cache of one Python worker.
CACHE_PIECES = 700_000
CACHE_PIECE_CHARS = 64
#: Texts are encoded in groups of about so many bytes; longer ones in cuts.
GROUP_BYTES = 2_500_000

#: Marks the cuts; a text that has it (or an added token of the vocabulary) is encoded whole.
CUT = "\x1f"
# Letters (Latin blocks only, in which every Unicode version agrees) before punctuation.
LETTER_THEN_MARK = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}])([,.;:!?#$%&*)|]+)"

_ENCODERS: dict[tuple, "Encoder"] = {}


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> "Encoder":
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Encoder:
    """``encode(texts)`` gives each text's ids as an array of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (
            spec.get("normalizer") is None and not spec.get("truncation") and not spec.get("padding")
            and (spec.get("model") or {}).get("type", "BPE") == "BPE" and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and not any(t.get("normalized") for t in spec.get("added_tokens") or [])
        )
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        # Tokens whose first byte is a space or a line feed (U+0120 and U+010A in byte-level vocabularies).
        self.opening = np.array([(self.tokenizer.id_to_token(i) or "")[:1] in ("\u0120", "\u010a") for i in range(self.vocab_size)])
        if self.by_piece:  # pieces are kept here: the library's own cache would only cost time
            self.tokenizer.model._resize_cache(0)
        self.cache: dict[str, bytes] = {}  # ids of pieces; none: the piece can't be encoded on its own
        self.older: dict[str, bytes] = {}  # the cache before it was last full
        self.cache_pieces = cache_pieces

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Put the ids of each piece into the cache."""
        opened, marks = [], []  # pieces that open with a blank; punctuation
        for p in pieces:
            if p[:1] not in (" ", "\n"):
                marks.append(p)
            elif len(p) > 1 and not p[1].isspace():
                opened.append(p)
            else:
                self.cache[p] = b""
        for i in range(0, len(opened), 2000):
            part = opened[i: i + 2000]
            ids = np.asarray(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            at = np.flatnonzero(self.opening[ids])
            if len(at) == len(part) and at[0] == 0:
                raw, ends = ids.tobytes(), [*(at[1:] * 4).tolist(), len(ids) * 4]
                self.cache.update(zip(part, [raw[a:b] for a, b in zip((at * 4).tolist(), ends)]))
            else:
                marks += part
        self.cache.update(zip(marks, [ids.tobytes() for ids in self._whole(marks)]))

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece; pieces not met of late are forgotten."""
        if len(self.cache) + len(pieces) > self.cache_pieces // 2:
            self.cache, self.older = {}, self.cache
        got = list(map(self.cache.get, pieces))
        new = [p for p, ids in zip(pieces, got) if ids is None]
        old = list(map(self.older.get, new))
        self.cache.update([x for x in zip(new, old) if x[1] is not None])
        self._learn([p for p, ids in zip(new, old) if ids is None])
        learnt = map(self.cache.__getitem__, new)
        got = [next(learnt) if ids is None else ids for ids in got]
        for p in new:
            if len(p) > CACHE_PIECE_CHARS:
                del self.cache[p]
        return got

    def _group(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of the texts of one array, put together from those of their pieces."""
        odd = np.zeros(len(texts), dtype=bool)
        for mark in (CUT, *self.added):
            odd |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        cut = pc.replace_substring(pc.replace_substring(texts, "\n", CUT + "\n"), " ", CUT + " ")
        parts = pc.split_pattern(pc.replace_substring_regex(cut, LETTER_THEN_MARK, r"\1" + CUT + r"\2"), CUT)
        bounds = parts.offsets.to_numpy()
        coded = parts.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        at, pieces = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        raw = self._ids(pieces)
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        apart = (size == 0)[at]  # pieces that can't stand alone
        begin = np.cumsum(size) - size
        firsts = self._whole(pc.list_element(parts, 0).to_pylist())  # nothing before them
        apart[bounds[:-1]] = False
        odd |= np.add.reduceat(apart, bounds[:-1], dtype=np.int64) > 0
        length = size[at]
        length[bounds[:-1]] = 0
        end = np.cumsum(length)
        where = np.repeat(begin[at] - (end - length), length) + np.arange(end[-1])
        ids = np.frombuffer(b"".join(raw), dtype="<u4")[where]
        edge = np.concatenate(([0], end[bounds[1:] - 1]))
        whole = np.flatnonzero(odd).tolist()
        out = [np.concatenate((first, ids[a:b])) for first, a, b in zip(firsts, edge[:-1], edge[1:])]
        for k, alone in zip(whole, self._whole([texts[k].as_py() for k in whole])):
            out[k] = alone
        return out

    def _cuts(self, text: str) -> list[str]:
        """The text in parts of about ``GROUP_BYTES`` characters, cut before a space that stands between non-blanks."""
        out, begin = [], 0
        while len(text) - begin > GROUP_BYTES:
            at = begin + GROUP_BYTES
            while 0 <= (at := text.find(" ", at)) and (at + 1 >= len(text) or text[at - 1].isspace() or text[at + 1].isspace()):
                at += 1
            if at < 0:
                break
            out.append(text[begin:at])
            begin = at
        return [*out, text[begin:]]

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """Ids of every text; a null is an empty text."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not self.by_piece:
            return self._whole(texts.to_pylist())
        out: list[np.ndarray] = []
        size = pc.binary_length(texts).to_numpy().astype(np.int64)
        begin = 0
        while begin < len(texts):
            end = begin + max(1, int(np.searchsorted(np.cumsum(size[begin:]), GROUP_BYTES, side="right")))
            if end == begin + 1 and size[begin] > GROUP_BYTES:
                cuts = self._cuts(texts[begin].as_py())
                out.append(np.concatenate([self._group(pa.array([cut], pa.string()))[0] for cut in cuts]))
            else:
                out += self._group(texts.slice(begin, end - begin))
            begin = end
        return out
