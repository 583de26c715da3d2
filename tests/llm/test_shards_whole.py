import pytest

from newsrisk.llm import shards


@pytest.mark.parametrize("groups", [[1], [1000] * 5 + [1], [4] * 1000 + [2000]])
def test_groups_with_room_stay_whole(spark, groups):
    """Only a group larger than a shard, and what its pieces' edges cut, may be split."""
    rows = [(g, f"copied {g}") for g, n in enumerate(groups) for _ in range(n)]
    rows += [(-i, f"text {i}") for i in range(1, 16_001 if len(groups) < 9 else 101)]
    rows = [(i, text) for i, (_, text) in enumerate(rows)]
    out = shards.documents_by_text(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    counts = [sum(r.shard == s for r in out) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    where: dict = {}
    for r in out:
        where.setdefault(r.text_crc32, set()).add(r.shard)
    sizes = {r.text_crc32: r.group_size for r in out}
    split = [k for k, s in where.items() if len(s) > 1 and sizes[k] <= len(rows) / 8]
    print("split", len(split), "of", sum(1 < n <= len(rows) / 8 for n in sizes.values()))
    assert len(split) <= (0 if len(groups) < 9 else 10)
