"""Fill-in-the-middle against regular expressions and slices."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tidepool.llm import fill_in_middle
from tidepool.llm.queries import QUERIES
from tidepool.sources.tables import load

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i: i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def random_texts():
    rnd = random.Random(1)
    letters = [" ", "\t", "\n", "\x0b", "\x0c", "\r", " ", " ", "a", "b", "é", "漢", "😀", "\x00", "\x08", "\x0e", "\x1f", "!", "\x7f", "\x85", "\xa0", "<", "S", ">"]
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(40))) for _ in range(3000)]


def test_word_arithmetic():
    texts = ["", " ", "\n\n", "a", "12345678", "1234567 ", " " * 16, "é" * 9 + " x", "<P", "a<M>b", *random_texts()]
    ids = [None, *range(1, len(texts))]
    got = fill_in_middle.arranged([t.encode() for t in texts], fill_in_middle.draws_of(ids, 42))
    assert [(*r[:4], r[4].decode()) for r in got] == [brute(i, t) for i, t in zip(ids, texts)]


def test_whole_table(spark, monkeypatch):
    """All columns stay, clashing names too; markers in a text, long texts, repeated rows and ids, nulls."""
    monkeypatch.setattr(fill_in_middle, "TURN_BYTES", 500)
    odd = [(None, None), (None, "a b"), (1, ""), (2, "word " * 60_000), (3, "x <S> y"), (4, "a b c d"), (4, "a b c d"), (4, "e f"), (5, " \t\n")]
    rows = odd + [(100 + i, t) for i, t in enumerate(random_texts()[:300])]
    df = spark.createDataFrame([(*r, "kept", 7) for r in rows], "doc_id bigint, text string, fim string, output int")
    out, name = fill_in_middle.fill_in_middle(df)
    assert out.columns == [*df.columns, name] and name != "fim"
    made = F.col(name)
    got = out.select("doc_id", "text", f"{name}.*", fill_in_middle.restored(made["output"], made["form"]).alias("back")).collect()
    assert sorted(map(str, (tuple(r[:7]) for r in got))) == sorted(map(str, ((i, t, *brute(i, t)) for i, t in rows)))
    assert all(r.back == (r.text or "") for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(df.limit(0))[0].count() == 0


def test_the_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in load(spark, sf, "documents").collect()}
    got = QUERIES["op12_fill_in_middle"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        *parts, output = brute(r.doc_id, docs[r.doc_id])
        assert [r.n, r.form, r.prefix_chars, r.middle_chars] == parts
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
