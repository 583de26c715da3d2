import hashlib
import random

import pytest

from newsrisk.llm import fingerprints as W


def plain(text: str, k: int, window: int) -> list[int]:
    """The chosen positions by the definition, with the module's own gram hashes."""
    grams = [int(W.winnow(text[i : i + k], k, 1)[0][0]) for i in range(len(text) - min(k, len(text)) + 1)] if text else []
    out = set()
    for i in range(max(1, len(grams) - window + 1) if grams else 0):
        part = grams[i : i + window]
        out.add(i + max(j for j, g in enumerate(part) if g == min(part)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_winnow_follows_the_definition(seed):
    pick = random.Random(seed)
    for n in (0, 1, 3, 4, 5, 9, 40, 200):
        text = "".join(pick.choice("abä😀" if seed else "a") for _ in range(n))
        assert W.winnow(text, 4, 5)[1].tolist() == plain(text, 4, 5)


def test_shared_substrings_are_found():
    pick = random.Random(7)
    letters = lambda n: "".join(pick.choice("abcdefghij") for _ in range(n))
    shared = letters(W.K + W.WINDOW - 1)
    for _ in range(30):
        a = set(W.winnow(letters(90) + shared + letters(50))[0].tolist())
        assert a & set(W.winnow(letters(33) + shared + letters(70))[0].tolist())


def brute(rows: list[tuple]) -> list[tuple]:
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, new, other = (W.winnow(t)[0] for t in (text, edited, after))
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), W.as_text(own), W.as_text(new),
            W.likeness(own, new), W.likeness(own, other),
        ))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 60])
def test_edited_texts_and_likeness(docs, n):
    pick = random.Random(n)
    texts = [None, "", "ä", "a" * 400, "ab", *("".join(pick.choice("abc ") for _ in range(90)) for _ in range(20))]
    rows = [(pick.randrange(-50, 500), pick.choice(texts)) for _ in range(n)]
    if n > 10:
        rows += [(None, "x"), (rows[3][0], "another"), rows[4]]
    got = [tuple(r)[:7] for r in W.edited_likeness(docs(rows)).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_extra_columns(spark):
    table = spark.createDataFrame([("abc", 1, 2)], "text string, fp_hashes int, more int")
    out = W.fingerprints(table)
    assert out.columns == ["text", "more", "fp_hashes", "fp_positions"]
    assert out.first().fp_positions == [0]
