import random

import numpy as np
import pytest

from newsrisk.llm import quality_classifier as qc

GOOD = "the river runs past the old mill and the village keeps its market on friday morning"
BAD = "CLICK HERE $$$ buy now!!! win win win free free free >>> http://x"


def corpus(size=240, seed=2):
    pick = random.Random(seed)
    docs, labels = [], []
    for i in range(size):
        good = pick.random() < 0.6
        words = (GOOD if good else BAD).split()
        text = " ".join(pick.choice(words) for _ in range(pick.randrange(5, 80)))
        docs.append((i, text))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_rows_are_scored_well(spark):
    docs, labels = corpus()
    docs += [(None, None), (1000, ""), (1001, "x" * 200_000), (7, docs[7][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = qc.classify(d, lab, vocab_size=64).collect()
    assert len(out) == len(docs)
    truth = dict((i, q) for i, q, _ in labels)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert held and all(r.held_out == (__import__("zlib").crc32(str(r.doc_id).encode()) % 4 == 2) for r in held)
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right / len(held) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert {r.held_out for r in out if r.doc_id is None} == {False}


def test_one_class_empty_and_clashing(spark):
    d = spark.createDataFrame([(1, "a b c", 0.3, 9), (2, None, 0.1, 9)], "doc_id long, text string, score double, predicted int")
    lab = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    out = sorted(tuple(r) for r in qc.classify(d, lab).collect())
    assert [r[2] for r in out] == [1.0, 1.0] and [r[3] for r in out] == [1, 1]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert qc.classify(empty, lab.limit(0)).count() == 0


def test_network_learns_and_calibrates():
    pick = np.random.default_rng(0)
    x = pick.normal(size=(2000, 5)).astype(np.float32)
    y = (x[:, 0] + 0.3 * pick.normal(size=2000) > 0).astype(int)
    net = qc.train(x, y, pick.random(2000) < 0.2)
    s = net.score(x)
    assert ((s >= 0.5) == y).mean() > 0.9
    # Calibrated: among rows scored about 0.8, about 80 % are 1.
    band = (s > 0.7) & (s < 0.9)
    assert band.sum() > 20 and abs(y[band].mean() - s[band].mean()) < 0.15


@pytest.mark.parametrize("text", [None, "", "½ 😀 ÀÉ", "word " * 10000])
def test_features_are_defined(text):
    f = qc.features(text, {"word": 0}, np.ones((1, qc.DIM), np.float32))
    assert f.shape == (qc.DIM + qc.SHAPE,) and np.isfinite(f).all()


ODD = ["", "a", "ÀÉ naïve İstanbul Kelvin \u212a ① ½ ٣ ABC_d\x1cx y", "日本語 テスト 𝔘𝔫 😀 x²", "Σας ΣΑΣ a\xadb", "x" * 3000 + " y", "a\0b  c\x7f"]


@pytest.mark.parametrize("text", ODD)
def test_raw_words_are_the_words(text):
    words, letters = qc.raw_words(text)
    assert [w.decode() for w in words] == qc.words_of(text)
    assert letters == sum(map(len, qc.words_of(text)))


def test_index_vectors_come_in_lots(docs, monkeypatch):
    """The sums of neighbours, one by one, and no Python call to ``index_vector`` for each word."""
    texts = [*ODD, "one two three two one", "two one"]
    vocab = {w: i for i, w in enumerate(["one", "two", "abc_d", "y"])}
    sums = np.zeros((len(vocab), qc.DIM))
    for words in map(qc.words_of, texts):
        for i, word in enumerate(words):
            for j in range(max(0, i - qc.WINDOW), min(len(words), i + qc.WINDOW + 1)) if word in vocab else ():
                if i != j:
                    np.add.at(sums[vocab[word]], *qc.index_vector(words[j]))
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    monkeypatch.setattr(qc, "index_vector", lambda word: 1 / 0)
    vectors = qc._IndexVectors()(["Ä".encode(), b"two", b"x" * 3000])
    monkeypatch.undo()
    for i, word in enumerate(["Ä", "two", "x" * 3000]):
        assert [x[i].tolist() for x in vectors] == [x.tolist() for x in qc.index_vector(word)]
    got = qc.context_vectors(docs([(i, t) for i, t in enumerate(texts)]), vocab)
    np.testing.assert_allclose(got, sums / np.where(norm > 0, norm, 1), atol=1e-6)
