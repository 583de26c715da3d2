import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from newsrisk.llm import bpe, quality, toxicity
from newsrisk.llm.queries import tokenizer_file

ODD = [
    None, "", "  \n", "aaa aaaa a'ss 'S'LL", "x<|endoftext|>y<|startoftext|><|ENDOFTEXT|>", "ΣΑΣ ΑΣ İstanbul ǅ ﬀ",
    "\x1c\x85\xa0​ a　b\x00c", "é 😀 12345 ½ ١٢ don't I'VE", "#$%" * 50, "word " * 3000,
]


def test_bpe_equals_the_library(docs):
    from tokenizers import Tokenizer

    pick = random.Random(1)
    texts = ODD + ["".join(pick.choice("aAbΣé'sßİ \nn<|>doftx12") for _ in range(pick.randrange(90))) for _ in range(300)]
    library = Tokenizer.from_file(tokenizer_file())
    rows = docs(list(enumerate(texts)))
    out = bpe.decode(bpe.encode(rows, tokenizer_file()), tokenizer_file()).collect()
    assert len(out) == len(texts)
    for r in out:
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.token_ids == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.round_trip(docs([]), tokenizer_file()).count() == 0


def slow_counts(text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    stutters = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), len(lines), stutters


def test_base_counts():
    pick = random.Random(2)
    texts = ODD + ["".join(pick.choice("ab #|ä\n\x0b\x85") for _ in range(pick.randrange(200))) for _ in range(200)]
    texts += ["a b c d e f g h i a b c d e f g h x", "a " * 15, "x\ny\nx\n x\n\n\n"]
    for text in texts:
        assert quality.counts_of(text) == slow_counts(text)


def test_binomial_tail_is_exact():
    from math import comb

    for k, n, p in ((0, 10, 0.1), (3, 40, 0.05), (40, 40, 0.3), (7, 20, 0.5)):
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)


def test_cutoffs_hold_the_risk(spark, docs):
    pick = random.Random(3)
    rows, marks, langs = [], [], {}
    for i in range(3000):
        good = i % 3 > 0
        junk = not good and pick.random() < 0.9
        words = [pick.choice(["some", "words", "in", "texts"]) + str(pick.randrange(900)) for _ in range(40)]
        rows.append((i, " ".join(w + "###" if junk else w for w in words)))
        marks.append((i, int(good)))
        langs[i] = ["en", "de", None][i % 2] if i < 2990 else None
    table = spark.createDataFrame([(i, t, langs[i]) for i, t in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality.judge(table, labels).collect()}
    good = [kept[i] for i, q in marks if q]
    assert sum(not k for k in good) <= quality.ALPHA * len(good)
    assert sum(not kept[i] for i, q in marks if not q) > 800
    # Nothing is rejected on too little evidence, and an empty table stays empty.
    few = quality.judge(table, labels.limit(20)).where("NOT base_failed")
    assert few.where("NOT kept").count() == 0
    assert quality.judge(table.limit(0), labels).count() == 0


def test_base_rule(spark):
    text = " ".join(f"w{i}" for i in range(20))
    table = spark.createDataFrame(
        [(1, text), (2, text[3:]), (3, None), (4, f"{text} {text}")], "doc_id long, text string"
    ).selectExpr("*", "'x' AS lang", "1 AS n_words")
    out = {r.doc_id: r for r in quality.judge(table, table.selectExpr("doc_id", "1 AS quality")).collect()}
    assert [out[i].base_failed for i in (1, 2, 3, 4)] == [False, True, True, True]
    assert [out[i].kept for i in (1, 2, 3, 4)] == [True, False, False, False]


def corpus(spark):
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abcdefg") for _ in range(pick.randrange(1, 7)))
    rows, marks = [], []
    for i in range(900):
        sentences = [" ".join(word() for _ in range(8)) for _ in range(pick.randrange(1, 9))]
        toxic = pick.random() < 0.25
        if toxic:
            sentences[pick.randrange(len(sentences))] += pick.choice([" you vile thing", " vile rot", " rotten lot"])
        rows.append((i, ". ".join(sentences)))
        marks.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), marks


def test_toxicity_on_held_out_rows(spark):
    table, marks = corpus(spark)
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.detect(table, labels).collect()}
    assert len(out) == 900
    for i, r in out.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(t, out[i].predicted) for i, t in marks if out[i].held_out]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    # The sentence that was planted is the one that is found.
    text = {r.doc_id: r.text for r in table.collect()}
    found = [(i, s) for i, t in marks if t for s in out[i].offending]
    right = sum(bool(re.search("vile|rot", text[i][s.start : s.end])) for i, s in found)
    assert right >= 0.95 * len(found) > 0


def test_toxicity_without_labels_or_texts(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.detect(docs([(1, "a. b"), (2, None), (None, "")]), none).collect()} == {0.0}
    table, marks = corpus(spark)
    labels = spark.createDataFrame(marks + [(3, None), (4, 7)], "doc_id long, toxic int")
    weights, bias = toxicity.learn(table, labels)
    extra = docs([(1, None), (2, ""), (3, "..??"), (4, "you vile thing " * 20_000)]).selectExpr("*", "5 AS score", "'k' AS lang")
    out = {r.doc_id: r for r in toxicity.score(extra, weights, bias).collect()}
    assert [round(out[i].score) for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert toxicity.score(extra.limit(0), weights, bias).count() == 0


def test_kept_words_are_a_few_bytes_each():
    """A task keeps many words from batch to batch: their ids are bytes, not lists of Python numbers."""
    vocabulary, known = bpe.Vocabulary(tokenizer_file()), {}
    texts = ["unbelievably long-winded words, again and again <|endoftext|> Σας", "", None, "日本語 😀 aaaaa"]
    ids = vocabulary.encode(texts, known)
    assert [np.array(i, "<u4").tobytes() for i in ids] == vocabulary.encode_raw(texts)
    assert ids == [vocabulary.encode([t])[0] for t in texts]
    assert known and all(type(kept) is bytes and len(kept) % 4 == 0 for kept in known.values())
