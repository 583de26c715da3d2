import random
from collections import Counter

import corpus_pipeline as P

from newsrisk.llm import mixing


def tables(spark, folder, rows, marks):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return docs


def corpus():
    pick = random.Random(11)
    word = lambda: "".join(pick.choice("abcdefghi") for _ in range(pick.randrange(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, near = text(60), text(120).split()
    rows, marks, toxic = [], [], set()
    for i in range(300):
        body = text(pick.randrange(5, 60))
        if i % 4 == 0:
            body += pick.choice([". you vile thing", ". vile rot here", ". rotten vile lot"])
            toxic.add(i)
        rows.append((i, body, "en", "ab"[i % 3 == 0], len(body)))
        marks.append((i, 1, int(i in toxic)))
    for i in range(400, 410):  # near copies
        copy = list(near)
        copy[pick.randrange(len(copy))] = word()
        rows.append((i, " ".join(copy), "de", "a", 0))
    rows += [(i, f"{text(9)} {passage} {text(7)}", "fr", "b", 0) for i in range(500, 506)]
    rows += [(600, None, None, None, None), (601, "", "en", "b", 0), (None, text(30), "en", "b", 1)]
    return rows, marks, toxic, passage


def test_stages_do_their_work(spark, tmp_path):
    rows, marks, toxic, passage = corpus()
    docs = tables(spark, tmp_path, rows, marks)
    columns, kept = docs.columns, []
    for at, (_, stage) in enumerate(P.STAGES):
        docs = P.stored(stage(spark, docs, str(tmp_path)), "stage")
        kept.append(docs.collect())
        if at < 4:
            assert docs.columns == columns
    ids = [{r.doc_id for r in out} for out in kept]
    clean = {r[0] for r in rows} - toxic
    assert len(ids[0] & toxic) <= 2 and len(clean - ids[0]) <= 3
    near = set(range(400, 410))
    assert ids[1] & near == {min(ids[0] & near)} and ids[1] == ids[0] - near | {min(ids[0] & near)}
    assert ids[2] == ids[1]
    left = {r.doc_id: r for r in kept[2]}
    for i in range(500, 506):
        assert passage[10:60] not in left[i].text and left[i].n_chars == len(left[i].text)
    assert left[600].text is None and left[601].text == ""
    copies = Counter(r.doc_id for r in kept[3])
    before = spark.createDataFrame(kept[2], spark.read.parquet(f"{tmp_path}/documents.parquet").schema)
    want = Counter(r.doc_id for r in mixing.replicate(before).collect())
    assert copies == want and len(kept[4]) == len(kept[3])


def test_run_is_the_stages_in_order(spark, tmp_path):
    rows, marks, *_ = corpus()
    tables(spark, tmp_path, rows[:60], marks[:60])
    assert P.run(spark, str(tmp_path)).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert [name for name, _ in P.STAGES][0] == "toxicity" and P.ORACLE_SQL is None


def test_identical_rows_leave_one(spark):
    docs = spark.createDataFrame(
        [(1, "a b c"), (1, "a b c"), (2, "a b c"), (3, ""), (3, ""), (4, None), (5, "x y"), (None, "x y"), (None, "q r")],
        "doc_id long, text string",
    )
    out = sorted(map(tuple, P.near_duplicates(spark, docs, "").collect()), key=str)
    assert out == sorted([(1, "a b c"), (3, ""), (3, ""), (4, None), (5, "x y"), (None, "q r")], key=str)
