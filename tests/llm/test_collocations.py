import random
import re
from collections import Counter

import numpy as np

from newsrisk.llm import collocations


def slow(rows, least, top=2000):
    """The contract of op12 by brute force."""
    grams, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = (text or "").translate(str.maketrans(collocations.UPPER, collocations.LOWER))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for i in range(len(w)):
                for m in range(1, 6):
                    if i + m <= len(w):
                        grams.setdefault(lang, Counter())[tuple(w[i : i + m])] += 1
    out = []
    for lang, f in grams.items():
        cands = {p: a for p, a in f.items() if 2 <= len(p) <= 5 and a >= least}
        rows_ = []
        for p, a in cands.items():
            inside = any(
                len(q) > len(p) and b >= a and any(q[o : o + len(p)] == p for o in range(len(q) - len(p) + 1))
                for q, b in cands.items()
            )
            if inside:
                continue
            best = min(((1000 * a * n[lang]) // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            k = best[1]
            rows_.append((lang, " ".join(p), a, f[p[:k]], f[p[k:]], n[lang], best[0]))
        rows_.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(rows_[:top])]
    return sorted(out)


def fixture(seed=5, size=300):
    pick = random.Random(seed)
    vocab = ["new", "york", "city", "of", "the", "hot", "dog", "a", "b", "Ünï", "x\x01y"]
    rows = []
    for i in range(size):
        words = [pick.choice(vocab) for _ in range(pick.randrange(0, 60))]
        text = " ".join(w if pick.random() > 0.1 else w + pick.choice(".,;\n\t") for w in words)
        rows.append((pick.choice(["en", "fr", None]), text.upper() if i % 5 == 0 else text))
    rows += [("en", "new york city. " * 30), ("en", None), (None, ""), ("de", "the the the the the the")] * 3
    return rows


def test_collocations_equal_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for least, top in ((20, 2000), (8, 15)):
        got = sorted(tuple(r) for r in collocations.collocations(df, least=least, top=top).collect())
        assert got == slow(rows, least, top) and got


def test_stream_crosses_many_ranges(spark):
    rows = fixture(seed=9, size=200)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        df = spark.createDataFrame(rows, "lang string, text string")
        got = sorted(tuple(r) for r in collocations.collocations(df, least=5).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert got == slow(rows, 5)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).count() == 0
    clash = spark.createDataFrame(
        [("en", "a b c. a b", 1, "x")] * 4, "lang string, text string, score int, phrase string"
    )
    got = sorted(tuple(r) for r in collocations.collocations(clash, least=4).collect())
    assert got == slow([("en", "a b c. a b")] * 4, 4)
    assert got[0][:4] == ("en", 1, "a b", 8)


def brute_counts(rows, least):
    """f of all phrases of 1 to 5 words with f >= least, and n."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        text = (text or "").translate(str.maketrans(collocations.UPPER, collocations.LOWER))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i : i + m])) for m in range(1, 6) for i in range(len(w) - m + 1))
    return {p: x for p, x in f.items() if x >= least}, {k: x for k, x in n.items() if x}


def test_counts_with_tables_looked_up_in_passes(spark, monkeypatch):
    rows = fixture(seed=3, size=40) + [("en", "a\x1cb\u3000c \x85 \x00ÿ À\u2028q.A\x1cB\u3000C \x85 \x00ÿ")] * 4
    df = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "CHUNK", 50)
    f, n = collocations.counts(df, least=8, longest=3, small=15)
    found = {(r.lang, tuple(r.phrase)): r.f for r in f.collect()}
    phrases, words = brute_counts(rows, 8)
    assert found == {p: x for p, x in phrases.items() if len(p[1]) <= 3}
    assert {r.lang: r.n for r in n.collect() if r.n} == words


def test_pairs_are_sent_packed(spark):
    pick = np.random.default_rng(1)
    ids = pick.integers(1, 300, 200_000)
    places = spark.createDataFrame([(collocations.pack(part),) for part in np.split(ids, 20)], "ids binary").coalesce(1)
    sent = collocations.pair_counts(places, 7, 3)
    keys, times = np.unique(
        np.concatenate([(p[:-1] << 32) | p[1:] for p in np.split(ids, 20)]), return_counts=True
    )
    assert {r.key: r.f for r in sent.collect()} == dict(zip(keys[times >= 3].tolist(), times[times >= 3].tolist()))
    # A pair takes at most 6 bytes on the way, its words' text none.
    assert len(collocations.pack(np.diff(keys, prepend=0))) + len(collocations.pack(times)) <= 6 * len(keys)


def test_numbers_survive_packing():
    for values in ([], [0], [0, 1, 255, 256], [2**62, 0, 5]):
        assert collocations.unpack(collocations.pack(np.array(values, np.int64))).tolist() == values


def test_keys_held_are_bounded_and_sums_stay_exact(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(collocations, "HELD_WORDS", 3)
    rows = [("en", b"a b c d e. a"), ("fr", b"a a"), ("en", b"b F")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["lang", "text"])
    total = Counter()
    sent = list(collocations._word_counts(iter([batch])))
    for part in sent:
        for lang, word, f in zip(*(c.to_pylist() for c in part.columns)):
            total[lang, word] += f
    assert len(sent) > 1
    assert total == {
        ("en", None): 8, ("en", b"a"): 2, ("en", b"b"): 2, ("en", b"c"): 1, ("en", b"d"): 1, ("en", b"e"): 1,
        ("en", b"f"): 1, ("fr", None): 2, ("fr", b"a"): 2,
    }
