import random
import re
import zlib
from collections import Counter

from newsrisk.llm import spelling


def slow_variants(rows, shortest=6, common=5, step=5):
    """The contract of op11, word by word and pair by pair."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= shortest and n >= common}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = (a, b) if len(a) > len(b) else (b, a)
        return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))

    out = {}
    for w, n in vocab.items():
        nears = [u for u in vocab if near(w, u)]
        best = min(nears, key=lambda u: (-vocab[u], u)) if nears else None
        form = best if best is not None and vocab[best] >= step * n else None
        out[w] = [form, n, len(nears), vocab[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        row.insert(1, root)
    return {w: tuple(r) for w, r in out.items()}


def fixture(seed=3, size=400):
    pick = random.Random(seed)
    stems = ["colour", "organise", "théâtre", "recognise", "programme", "analyse", "centre", "ÀÉÎõü"]
    words = []
    for s in stems:
        for _ in range(40):
            w = list(s)
            kind = pick.randrange(6)
            at = pick.randrange(len(w))
            if kind == 0:
                w[at] = pick.choice("aeiouzà")
            elif kind == 1:
                w.insert(at, pick.choice("lrsé"))
            elif kind == 2 and len(w) > 6:
                del w[at]
            words.append("".join(w))
    rows = []
    for i in range(size):
        text = " ".join(pick.choice(words) for _ in range(pick.randrange(0, 40)))
        rows.append((i, text.upper() if i % 7 == 0 else text))
    rows += [(None, "Colour colour COLOUR colour colour"), (None, None), (5, ""), (5, "colour " * 30)]
    rows += [(9, "programme, PROGRAMME; programme") for _ in range(6)]
    # Words longer than the numpy check's width go the slow way.
    long = "abcdefghij" * 4
    rows += [(11, " ".join([long] * 30 + [long[:-1] + "z"] * 5 + [long + "k"] * 5))]
    return rows


def test_variants_equal_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df, block=7).collect()}
    want = slow_variants(rows)
    assert got == want
    assert any(v[0] is not None for v in want.values()) and any(v[2] for v in want.values())
    # No block search: the grid gives the same rows.
    again = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df).collect()}
    assert again == want


def test_marked_runs_delete_one_code_point(spark):
    hits = []
    for i in range(5000):
        h = zlib.crc32(f"{i}:abcdefgh".encode())
        if h % 199 == 0:
            hits.append((i, "abcdefgh"[: h % 8] + "abcdefgh"[h % 8 + 1 :]))
    df = spark.createDataFrame([(i, "ABCDEFGH") for i, _ in hits], "doc_id long, text string")
    got = sorted(r.word for r in spelling.marked_runs(df).collect())
    assert got == sorted(w for _, w in hits) and hits


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).count() == 0
    clash = spark.createDataFrame(
        [(1, "organise " * 10 + "organize", "x", 3)], "doc_id long, text string, word string, n int"
    )
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(clash).collect()}
    assert got == {"organise": (None, "organise", 10, 0, None)}


def test_one_edit():
    assert spelling.one_edit("colour", "color") and spelling.one_edit("colour", "colous")
    assert spelling.one_edit("colour", "ccolour") and not spelling.one_edit("colour", "colour")
    assert not spelling.one_edit("colour", "cloour") and not spelling.one_edit("abcdef", "abcdefgh")
