import random
import re
import textwrap
from collections import Counter

import pytest

from newsrisk.llm import licences

NOTICES = dict.fromkeys(t for _, t in licences.TEMPLATES)
MIT = next(t for n, t in licences.TEMPLATES if t.startswith("Permission is hereby"))


def found(spark, texts, **more):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return Counter((r.doc_id, r.line, r.licence, r.dice) for r in licences.spans(table, **more).collect())


def words(text):
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def brute_force(text, templates):
    """All windows between starts and ends of runs, of every template; the best that share no word."""
    w = words(text)
    line_of = [i for i, part in enumerate(text.split("\n")) for _ in words(part)]
    grams = list(zip(w, w[1:]))
    hits = []
    for name, body in templates:
        t = words(body)
        known = set(zip(t, t[1:]))
        at = [g in known for g in grams]
        for i in range(len(grams)):
            if not at[i] or (i and at[i - 1]):
                continue
            for j in range(i, len(grams)):
                if not at[j] or (j + 1 < len(grams) and at[j + 1]):
                    continue
                window = set(grams[i : j + 1])
                c = len(window & known)
                dice = 2 * c / (len(window) + len(known))
                if dice >= 0.8:
                    hits.append((-c, -dice, name, i, -j))
    kept = []
    for h in sorted(hits):
        if all(h[3] > 1 - k[4] or k[3] > 1 - h[4] for k in kept):
            kept.append(h)
    return [(line_of[i], name, -dice) for _, dice, name, i, _ in kept]


def test_wrapped_and_inline_notices_are_found(spark):
    rest = "The weather was fine and nobody asked about anything at all. " * 3
    texts = [
        textwrap.fill(MIT, 78),
        "Released under the MIT License. More words here.",
        rest + "Released under the MIT License. " + rest,
        "Copyright X\n\n" + textwrap.fill(rest + MIT + " " + rest, 40),
        None, "", "license", "\n\n", rest,
    ]
    assert found(spark, texts) == Counter(
        {(0, 0, "MIT", 1.0): 1, (1, 0, "MIT", 1.0): 1, (2, 0, "MIT", 1.0): 1, (3, 6, "MIT", 1.0): 1}
    )


@pytest.mark.parametrize("name", licences.BODIES)
def test_full_texts_are_found_as_one(spark, name):
    body = dict(licences.whole_templates()[len(licences.TEMPLATES) :])[name]
    text = "Read this first.\n\n" + textwrap.fill(" ".join(body.split()), 60, initial_indent="# ", subsequent_indent="# ")
    got = found(spark, [text + "\nAnd some words behind it."])
    assert got == Counter({(0, 2, name, 1.0): 1})


def test_spans_match_brute_force(spark):
    pick = random.Random(12)
    filler = "the of a license under to software and copies version public work is any free".split()
    texts = []
    for _ in range(60):
        out = []
        for _ in range(pick.randrange(1, 4)):
            w = pick.choice(list(NOTICES)).split()
            for _ in range(pick.choice([0, 0, 1, 2, 4])):
                k = pick.randrange(len(w))
                w[k : k + pick.randrange(2)] = [pick.choice(filler)] * pick.randrange(3)
            out += [*(pick.choice(filler) for _ in range(pick.choice([0, 0, 3, 20]))), *w]
        texts.append("".join(x + pick.choice("     \n") for x in out))
    want = Counter((d, *r) for d, t in enumerate(texts) for r in brute_force(t, licences.TEMPLATES))
    assert sum(want.values()) > 60 and any(d < 1 for *_, d in want)
    assert found(spark, texts, templates=licences.TEMPLATES) == want


def test_spans_of_any_length(spark):
    """Repeated words add nothing to the sets, however long they make a window."""
    text = "Released under the " + "the " * 300 + "MIT License."
    assert found(spark, [text]) == Counter({(0, 0, "MIT", 8 / 9): 1})
