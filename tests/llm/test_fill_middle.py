"""Fill-in-middle: the forms against plain string slices, and exact round trips."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from stationcast.llm import fill_middle
from odd import given, odd_docs, odd_rows

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def plain(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    units = UNIT.findall(text)
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def extra_rows():
    rnd = random.Random(9)
    pieces = ["a", "<P", ">", "<P>", "P>", "<", "<S", "<M", " ", "\t\n", "ä", "漢字", " ", "\x1c", "😀"]
    rows = [(100 + i, "".join(rnd.choice(pieces[:3] + pieces[4:] if i % 4 else pieces) for _ in range(rnd.randrange(30)))) for i in range(300)]
    rows += [(500 + i, " ") for i in range(5)] + [(None, "a b c"), (None, None)]
    rows += [(1000, "word " * 400_000), (1003, "x" * 1_000_000)]
    return [(i, t, "en", "a", 0, "x", None, 7, "y", "z") for i, t in rows]


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = sorted(((i, n, f, p, m, sha(o), sha(t or "")) for i, t in rows for n, f, p, m, o in [plain(i, t)]), key=str)
    got = sorted((tuple(r) for r in fill_middle.fill_digests(docs).collect()), key=str)
    assert got == want
    return got


def test_odd_rows(spark):
    forms = {r[2] for r in check(odd_docs(spark, odd_rows() + extra_rows()))}
    assert forms == {"plain", "spm", "psm"}


def test_given_table_and_clashing_columns(spark):
    docs = given(spark)
    check(docs.withColumn("key", F.lit(1)).withColumn("form", F.lit("q")).withColumn("n", F.lit(None).cast("int")).withColumn("a.b", F.lit(1)))


def test_empty_table(spark):
    assert check(odd_docs(spark, [])) == []


def test_outputs_pieces_and_round_trip(spark):
    docs = odd_docs(spark, odd_rows() + extra_rows())
    filled = fill_middle.fill_in_middle(docs)
    rows = filled.collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault((r["doc_id"], plain(r["doc_id"], r["text"])[4]), r["text"] or "")
    for r in rows:
        text = texts[r["doc_id"], r["output"]]
        buffers = (text.encode(), fill_middle.SENTINELS)
        assert b"".join(buffers[p["buffer"]][p["start"]:p["start"] + p["length"]] for p in r["pieces"]).decode() == r["output"]
    back = sorted((str(r["doc_id"]), r["text"]) for r in fill_middle.restore(filled).collect())
    assert back == sorted((str(r["doc_id"]), r["text"] or "") for r in docs.collect())


def test_rates(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('some words here ', id) as text")
    share = {r["form"]: r["count"] for r in fill_middle.fill_digests(docs, rate=90, spm=10, seed=7).groupBy("form").count().collect()}
    assert 200 < share["plain"] < 400 and share["psm"] > 6 * share["spm"] > 0
