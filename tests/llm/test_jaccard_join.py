import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from newsrisk.llm import jaccard_join as J
from newsrisk.llm.components import components

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows: list[tuple]) -> list[tuple]:
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate(LOWER).encode())
        k = min(5, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed: int) -> list[tuple]:
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdeÄ") for _ in range(4))
    text = lambda n: [word() for _ in range(n)]
    rows, passage = [], text(30)
    for _ in range(6):  # chains of near copies: each changes its predecessor a little
        base = text(pick.randrange(30, 80))
        for _ in range(pick.randrange(2, 9)):
            base = list(base)
            base[pick.randrange(len(base))] = word()
            rows.append(" ".join(base))
    for _ in range(25):  # one wide group around a text
        base = text(60) if not rows or len(rows) < 1 else rows[0].split(" ")
        base[pick.randrange(len(base))] = word()
        rows.append(" ".join(base).upper() if pick.random() < 0.3 else "\n".join(base))
    rows += [" ".join(text(20) + passage + text(9)) for _ in range(20)]
    rows += [" ".join(passage + text(pick.randrange(5))) for _ in range(12)]
    rows += [rows[2]] * 5 + ["a b", "A\tb", "a", "", "  ", None, "a b c d e", "a b c d e f"]
    ids = pick.sample(range(1000), len(rows))
    out = list(zip(ids, rows))
    return out + [(None, rows[4]), (None, "quite alone in here today"), out[5], (out[6][0], "another text of it own")]


@pytest.mark.parametrize("seed", [1, 2])
def test_join_matches_brute_force(docs, seed, monkeypatch):
    if seed == 2:  # long lists: a grid of blocks, many frequent shingles
        monkeypatch.setattr(J, "BLOCK", 4)
        monkeypatch.setattr(J, "MEETINGS", 2)
        monkeypatch.setattr(J, "SHORT", 0)
        monkeypatch.setattr(J, "NOTED", 2)
    rows = corpus(seed)
    got = sorted(map(tuple, J.join(docs(rows)).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(docs):
    assert J.join(docs([])).count() == 0


def test_components(spark):
    pick = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (300, 200)]
    pick.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 300: 200}
    assert got == want


def test_leaders_do_not_depend_on_batches(spark):
    pick = random.Random(6)
    rows = sorted((pick.choice([-3, -1, *range(12)]), 0, pick.randrange(10**6), 5, 1) for _ in range(60))
    lists: dict = {}
    for r in rows:
        lists.setdefault(r[0], []).append(r)
    want = sorted((s, r[2], 5, 1, own[0][2], 5, 1) for s, own in lists.items() if len(own) > 1 or s < 0 for r in own)

    class Fake:  # runs the function over batches of a given size
        def select(self, *names):
            return self

        def mapInArrow(self, work, schema):  # noqa: N802
            return work

    for size in (1, 2, 3, 7, 60):
        names = ["shingle", "salt", "node", "n", "at"]
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c) for c in np.array(rows[i : i + size]).T], names=names)
            for i in range(0, len(rows), size)
        ]
        got = [tuple(r.values()) for b in J.with_leaders(Fake())(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == want


def test_rounds_of_components_write_few_files(spark, monkeypatch):
    """Each file is a task, and on a local file system a process or more that an executor starts."""
    from newsrisk.llm import components as module

    files, plain = [], module.stored
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}

    def noted(*args):
        out = plain(*args)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(module, "stored", noted)
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        links = spark.range(300).selectExpr("id AS a", "id + 1000 * (id % 3) AS b")
        found = {r.node: r.root for r in components(links).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {n: n % 1000 for i in range(300) if i % 3 for n in (i, i + 1000 * (i % 3))}
    assert max(files) == 1


def test_noted_shingles_are_counted_in_one_sorted_copy():
    pick = np.random.default_rng(3)
    for size in (0, 1, 2, 3, 40, 400):
        sets = [np.unique(pick.integers(0, 30, n).astype(np.uint64)) for n in pick.integers(0, 9, size)]
        flat = np.concatenate([*sets, np.empty(0, np.uint64)])
        value, times = np.unique(flat, return_counts=True)
        got = J.noted(sets)
        assert [x.tolist() for x in got] == [x[times >= J.NOTED].tolist() for x in (value, times)]
        assert not sets


def test_whole_sets_travel_only_for_pairs_that_may_link(docs, monkeypatch):
    """Texts that share a passage and nothing else meet in lists; their signs tell them apart."""
    pick, compared, plain = random.Random(8), [], J.overlaps
    text = lambda n: [f"{pick.randrange(10**9)}" for _ in range(n)]
    passage = text(50)
    rows = [(i, " ".join(passage + text(100))) for i in range(30)]
    alike = passage + text(100)
    rows += [(100, " ".join(alike)), (101, " ".join(alike + text(3)))]

    def noted(pairs, *args):
        compared.append(pairs.count())
        return plain(pairs, *args)

    monkeypatch.setattr(J, "overlaps", noted)
    monkeypatch.setattr(J, "NOTED", 1_000)  # as where a passage is spread thinly over many batches
    got = sorted(map(tuple, J.join(docs(rows)).collect()), key=str)
    assert got == brute(rows)
    assert sum(compared) <= 2


def test_signs_bound_how_far_sets_are_apart():
    pick = np.random.default_rng(4)
    sets = [np.unique(pick.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 2, 31, 33, 60, 64, 70, 500, 700, 1025)]
    sets += [np.unique(np.concatenate([s[: len(s) * 9 // 10], sets[3]])) for s in sets[4:]]
    signs = J.Signs([J.sign(s) for s in sets])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    apart = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i, j)])
    got = signs.differing(i, signs, j)
    assert (got <= apart).all() and ((apart - got) % 2 == 0).all()
    n = np.array([len(s) for s in sets])
    unlike = (apart == n[i] + n[j]) & (np.minimum(n[i], n[j]) > 400)
    assert unlike.any() and not J.can_reach((n[i] + n[j] - got) // 2, n[i], n[j])[unlike].any()


def test_tables_of_lists_are_deleted_after_use(docs, monkeypatch):
    made, plain = [], J.stored

    def noted(df, name, *args):
        out = plain(df, name, *args)
        made.extend((name, file.removeprefix("file:")) for file in out.inputFiles())
        return out

    monkeypatch.setattr(J, "stored", noted)
    rows = [(i, " ".join(f"{i % 3}{j}" for j in range(30))) for i in range(9)]
    assert sorted(map(tuple, J.join(docs(rows)).collect()), key=str) == brute(rows)
    left = {name for name, file in made if os.path.exists(file)}
    assert {name for name, _ in made} >= {"lists", "placed", "mixed"}
    assert "members" in left and not left & {"lists", "placed", "mixed"}
