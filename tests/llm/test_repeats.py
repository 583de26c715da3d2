import hashlib
import random
import re
from collections import Counter

import pytest

from newsrisk.llm import repeated_bytes, repeated_words

BLANK = re.compile(rb"[^\x20\x09-\x0D]+")


def corpus(seed: int) -> list[tuple]:
    """Texts of few words with copies, shared passages, periods, odd blanks and gaps."""
    pick = random.Random(seed)
    words = ["ä", "bb", "c c", "dé", "e\n", "f\x0b", "\x85g", "h", "ii", "jj"]
    text = lambda n: " ".join(pick.choice(words) for _ in range(n))
    passage, other = text(25), text(13)
    rows = [(i, text(pick.randrange(0, 40))) for i in range(25)]
    rows += [(100 + i, f"{text(5)} {passage} {text(4)}") for i in range(12)]
    rows += [(200 + i, f"{other} {text(3)} {other}") for i in range(4)]
    rows += [(300 + i, rows[3][1]) for i in range(3)] + [(400, "h " * 60), (401, "h" * 90), (402, "h" * 70)]
    rows += [(None, passage), (None, None), (500, None), (501, ""), (502, "  \n"), (7, passage), (7, text(9))]
    return rows


def brute_words(rows: list[tuple], width: int) -> dict:
    last = 2**63 - 1
    split = [(last if d is None else d, [w.decode() for w in BLANK.findall((t or "").encode())]) for d, t in rows]
    first: dict = {}
    for d, ws in split:
        for i in range(len(ws) - width + 1):
            key = tuple(ws[i : i + width])
            first[key] = min(first.get(key, d), d)
    out = Counter()
    for (doc_id, _), (d, ws) in zip(rows, split, strict=True):
        gone = set()
        for i in range(len(ws) - width + 1):
            if first[tuple(ws[i : i + width])] < d:
                gone |= set(range(i, i + width))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out[doc_id, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def brute_bytes(rows: list[tuple], width: int) -> dict:
    raws = [(t or "").encode() for _, t in rows]
    times = Counter(r[i : i + width] for r in raws for i in range(len(r) - width + 1))
    out = Counter()
    for (doc_id, _), r in zip(rows, raws, strict=True):
        gone = set()
        for i in range(len(r) - width + 1):
            if times[r[i : i + width]] > 1:
                gone |= set(range(i, i + width))
        spans = sum(i - 1 not in gone for i in gone)
        kept = bytes(b for i, b in enumerate(r) if i not in gone)
        out[doc_id, len(r), len(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hot", [10_000, 3])
def test_repeated_words_match_brute_force(docs, hot):
    rows = corpus(1)
    from pyspark.sql import functions as F

    found = repeated_words.drop_repeated(docs(rows), width=9, hot=hot).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)
    )
    got = Counter(map(tuple, found.collect()))
    assert got == brute_words(rows, 9)
    assert sum(r[2] for r in got) > 100


@pytest.mark.parametrize("hot", [10_000, 3])
def test_repeated_bytes_match_brute_force(docs, hot):
    rows = corpus(2)
    from pyspark.sql import functions as F

    found = repeated_bytes.drop_repeated(docs(rows), width=40, hot=hot).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256)
    )
    got = Counter(map(tuple, found.collect()))
    assert got == brute_bytes(rows, 40)
    assert sum(r[2] for r in got) > 1000


def test_production_width_on_whole_texts(docs):
    pick = random.Random(3)
    word = lambda: "".join(pick.choice("abcdefg") for _ in range(5))
    passage = " ".join(word() for _ in range(70))
    rows = [(i, " ".join(word() for _ in range(60))) for i in range(6)]
    rows += [(i, f"{word()} {passage}\t{word()}") for i in (10, 4, 12)] + [(20, passage), (21, "ab" * 300)]
    from pyspark.sql import functions as F

    assert Counter(map(tuple, repeated_words.digest(docs(rows)).collect())) == brute_words(rows, 50)
    assert Counter(map(tuple, repeated_bytes.digest(docs(rows)).collect())) == brute_bytes(rows, 200)


@pytest.mark.parametrize("module", [repeated_words, repeated_bytes])
def test_empty_table_and_clashing_columns(spark, docs, module):
    assert module.digest(docs([])).count() == 0
    extra = spark.createDataFrame(
        [(1, "a b", 9, "x", "y"), (2, None, 9, None, "z")],
        "doc_id long, text string, n_removed int, rkey string, cuts string",
    )
    out = module.drop_repeated(extra)
    assert out.columns[:2] == ["doc_id", "text"] and out.columns.count("n_removed") == 1
    assert [r.n_removed for r in out.collect()] == [0, 0]


def test_refinement_numbers_equal_strings_alike():
    import numpy as np

    flat = np.frombuffer(b"abcabcabcabcxabcabcabcabcyzzzzzzzzzzzzzzzzzzzz", np.uint8)
    for width in (3, 8, 9, 11):
        bucket = repeated_bytes.refine(flat, width)
        at = range(len(flat) - width + 1)
        for i in at:
            for j in at:
                same = flat[i : i + width].tobytes() == flat[j : j + width].tobytes()
                assert same == (bucket[i] == bucket[j])


def test_buckets_are_bounded_by_windows_too(docs):
    """Texts that repeat themselves make few runs of many windows; no bucket may grow with them."""
    from pyspark.sql import functions as F
    from newsrisk.llm import superkmers

    rows = [(i, f"{i} " + "h i " * 150 + f"x{i}") for i in range(12)] + corpus(3)
    runs = superkmers.super_windows(superkmers.keyed(docs(rows)), repeated_words.word_values, 9, 5)
    picked = superkmers.wanted(runs, 10_000, 400, within=False)
    left = picked.where(~F.col("hot")).groupBy("minimiser").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    assert 0 < left <= 400
    # Equal windows of a run travel together: 12 texts of two alternating words give few rows.
    hot = superkmers.pack(superkmers.keyed(docs(rows)), picked.where("hot"), repeated_words.word_cutter, 9)
    size = hot.agg(F.count("*"), F.sum(F.size("starts"))).first()
    assert size[1] == picked.where("hot").agg(F.sum("n")).first()[0] > 12 * 280 and size[0] < size[1] / 3

    found = repeated_words.drop_repeated(docs(rows), width=9, most=400)
    got = Counter(map(tuple, found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()))
    assert got == brute_words(rows, 9)
    found = repeated_bytes.drop_repeated(docs(rows), width=40, most=400)
    found = found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256))
    assert Counter(map(tuple, found.collect())) == brute_bytes(rows, 40)
