"""N-gram Jaccard join by set relations: documents whose shingle sets overlap by 80 % or more.

A document's set holds its distinct 5-word shingles (A-Z in lower case); with fewer words the
whole sequence is the one shingle, without words the set is empty and links with nothing.
Shingles are 63-bit hashes, sets have 64-bit ids.

Index lists.  Sets that link share a shingle among the first ``n - ceil(0.8 n) + 1`` of each
in any common order, so only those prefixes are indexed.  The order puts shingles that many
documents hold last (a list of bounded length, by a lower bound of the counts that depends on
the layout of batches: only batches that hold a shingle ``NOTED`` times or more count, so one
spread thinly over many batches passes as rare and is not salted; the list shapes the order
and length of the lists, never the result).  A list of one entry is skipped.

Set relations.  Equal sets are one entry.  In each list the first set leads: the others
are compared with it only, and sets found linked share their component from then on.  Where
several components are left, a few further leaders are tried.  In a last pass a list's sets of *different* components are paired: blocks of one component are
skipped as a whole, sizes and positions rule pairs out, and from the known overlaps with the
list's leader follow bounds on the overlap of two sets, which decide many pairs without
looking at them.  The rest are compared.  Copies and near copies thus cost one
comparison each, not one for every pair, and no link between components is lost.

Signs.  Whole sets travel only to be compared exactly, and before that signs decide which pairs
need it.  A set's sign holds a bit for each class of shingles (two classes or more a shingle):
whether it has an odd number of them.  Where signs differ, so do the sets, in a shingle at least;
so the count of differing bits bounds the overlap from above, and pairs whose bound is too low
do not link.  In the last pass each block gets the sign of each of its sets once, however many
pairs the set is in.

Lists too long for one task are dealt as a grid of blocks.  Missing texts have no words.
Rows that repeat a doc_id are compared by themselves; a row without doc_id can join a
component but never names it (NULL if no row of it has one).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from newsrisk.llm.common import CUTS, KEY, LAST, LOWER, VALUES, as_bytes, freed, gram_hashes, row_key, sliced, span_hashes, stored, word_spans
from newsrisk.llm.components import components
from newsrisk.operators.skew import join_one_per_key

WORDS, PERCENT = 5, 80
#: How many frequent shingles are put last in the order (eight bytes each in every task).
FREQUENT = 2**17
#: Occurrences of a shingle count only in Arrow batches that hold it this often.
NOTED = 3
#: Entries of a leader's lists on one side of a block; more are dealt as a grid of blocks.
BLOCK = 100_000
SALTS = 64
#: Rows of a few numbers that are broadcast at most; above, the join shuffles both sides.
SHORT = 500_000
#: Further leaders that each list of several components gets.
LEADERS = 4
#: Sets that are compared with one hub in one place.
MEETINGS = 1_000
#: Words of signs that are compared at once.
SIGN_WORDS = 1_000_000
#: Rows of a few numbers that are about as long as a sign.
SIGN_ROWS = 10
#: Shingles of a set whose sign weighs as much as an entry in a block.
SIGNED = 4_000
HEAVY = np.uint64(1 << 63)


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as ascending 63-bit hashes."""
    raw = LOWER[as_bytes(text)]
    words = span_hashes(VALUES[raw], *word_spans(raw))
    if not len(words):
        return words
    return np.unique(gram_hashes(words, min(WORDS, len(words))) >> np.uint64(1))


def batches_of(batch: pa.RecordBatch, size: int = 2_000) -> Iterator[list]:
    for at in range(0, len(batch), size):
        yield batch.slice(at, size).column(batch.num_columns - 1).to_pylist()


def set_id(found: np.ndarray) -> int:
    """The id of a set: equal sets have equal ids."""
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def noted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that ``NOTED`` sets or more hold, ascending, and how many hold them.

    Empties ``sets``; of all shingles there is one copy, sorted in place.
    """
    found = np.concatenate([*sets, np.empty(0, np.uint64)])
    sets.clear()
    found.sort()
    # Where the same value stands NOTED - 1 places ahead; of a run, the first such place.
    at = np.flatnonzero(found[: max(0, len(found) - NOTED + 1)] == found[NOTED - 1 :])
    value = found[at]
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1])[: len(value)])
    times = np.diff(np.append(first, len(value))) + NOTED - 1
    return value[first].astype(np.int64), times.astype(np.int64)


def sign(found: np.ndarray) -> bytes:
    """A bit for each class of shingles (their last bits): whether the set has an odd number of them.

    The classes are a power of two, twice the shingles or more and 64 at least.
    """
    classes = max(64, 1 << (2 * len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(classes - 1)).astype(np.int64), minlength=classes).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


class Signs:
    """Signs of sets, as matrices by length."""

    def __init__(self, signs: list[bytes]) -> None:
        self.words = np.array([len(s) // 8 for s in signs], np.int64)
        self.at = np.zeros(len(signs), np.int64)
        self.rows: dict[int, np.ndarray] = {}
        for words in np.unique(self.words).tolist():
            own = np.flatnonzero(self.words == words)
            self.at[own] = np.arange(len(own))
            self.rows[words] = np.frombuffer(b"".join([signs[i] for i in own.tolist()]), np.uint64).reshape(-1, words)

    def folded(self, which: np.ndarray, words: int) -> np.ndarray:
        """The signs of sets of one length as rows of so many words: halves add up to the sign over half the classes."""
        out = self.rows[int(self.words[which[0]])][self.at[which]]
        while out.shape[1] > words:
            half = out.shape[1] // 2
            out = out[:, :half] ^ out[:, half:]
        return out

    def differing(self, i: np.ndarray, other: Signs, j: np.ndarray) -> np.ndarray:
        """In how many bits the signs ``i`` and the ``other``'s ``j`` differ: no more than the sets in shingles."""
        out = np.zeros(len(i), np.int64)
        kinds = np.stack([self.words[i], other.words[j]], axis=1)
        for kind in np.unique(kinds, axis=0):
            own, words = np.flatnonzero((kinds == kind).all(axis=1)), int(kind.min())
            step = max(1, SIGN_WORDS // int(kind.max()))
            for at in range(0, len(own), step):
                part = own[at : at + step]
                apart = self.folded(i[part], words) ^ other.folded(j[part], words)
                out[part] = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
        return out


def can_reach(most, n, m):
    """Whether sets of n and m shingles link if they have ``most`` in common."""
    return (100 + PERCENT) * most >= PERCENT * (n + m)


def survey(rows: DataFrame) -> DataFrame:
    """One pass: a row (rid, rkey, node, n, sign) a document and rows (node = shingle, times).

    A node is a set; documents without words have none.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for texts in batches_of(batch, 500) for t in texts]
            ids = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
            n = pa.array([len(s) for s in sets], pa.int32())
            signs = pa.array([sign(s) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], ids, n, signs, pa.nulls(len(sets), pa.int64())], names=names
            )
            value, times = noted(sets)
            gap, none = pa.nulls(len(value), pa.int64()), pa.nulls(len(value), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [gap, gap, pa.array(value), pa.nulls(len(value), pa.int32()), none, pa.array(times)], names=names
            )

    names = ["rid", "rkey", "node", "n", "sign", "times"]
    return rows.select("rid", "rkey", "text").mapInArrow(
        work, "rid long, rkey long, node long, n int, sign binary, times long"
    )


def prefix_length(n: int) -> int:
    return n - (PERCENT * n + 99) // 100 + 1


def entries(rows: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(shingle, node, n, at): the prefix of every set in the common order, once a task.

    ``frequent`` lists shingles from the rarest to the most common one; they follow all
    others and have negative numbers.
    """
    order = np.argsort(frequent)
    known, rank = frequent[order], order.astype(np.uint64)

    def ordered(found: np.ndarray) -> np.ndarray:
        if len(known):
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            hit = known[at] == found
            if hit.any():
                return np.sort(np.where(hit, HEAVY | rank[at], found))
        return found

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for texts in batches_of(batch):
                fresh = {set_id(s): s for s in map(shingles, texts) if len(s)}
                keys = [key for key in fresh if key not in done]
                if not keys:
                    continue
                done.update(keys)
                sets = [ordered(fresh[key]) for key in keys]
                n = np.array([len(s) for s in sets])
                k = np.array([prefix_length(i) for i in n.tolist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([s[:i] for s, i in zip(sets, k, strict=True)]).view(np.int64)),
                        pa.array(np.repeat(np.array(keys, np.int64), k)),
                        pa.array(np.repeat(n, k).astype(np.int32)),
                        pa.array(np.concatenate([np.arange(i, dtype=np.int32) for i in k])),
                    ],
                    names=["shingle", "node", "n", "at"],
                )

    return rows.select("text").mapInArrow(work, "shingle long, node long, n int, at int")


LISTED = "shingle long, node long, n int, at int, leader long, leader_n int, leader_at int"


def with_leaders(sorted_entries: DataFrame) -> DataFrame:
    """The entries of lists of two or more (of any length for frequent shingles), with the
    list's first entry.  A stream over sorted rows: nothing but the current leader is kept."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last row, its leader, whether it has been put out, whether it follows another
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            if not len(rows):
                continue
            if last:
                rows = np.concatenate([last[0][None, :], rows])
            # Equal sets of several tasks lie together.
            rows = rows[np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1))]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
            group = np.cumsum(new) - 1
            leader = rows[np.flatnonzero(new)][group][:, 2:]
            follows = ~new
            if last:
                leader[group == 0], follows[0] = last[1], last[3]
            out = follows | np.append(~new[1:], False) | (rows[:, 0] < 0)
            sent = out.copy()
            if last and last[2]:
                out[0] = False
            last = rows[-1], leader[-1], bool(sent[-1]), bool(follows[-1])
            rows, leader = rows[out], leader[out]
            columns = [rows[:, 0], rows[:, 2], rows[:, 3], rows[:, 4], *leader.T]
            kinds = [np.int64, np.int64, np.int32, np.int32, np.int64, np.int32, np.int32]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=True)],
                names=["shingle", "node", "n", "at", "leader", "leader_n", "leader_at"],
            )

    return sorted_entries.select("shingle", "salt", "node", "n", "at").mapInArrow(work, LISTED)


def can_link(n, at, m, there):
    """Whether sets of n and m shingles whose first common one has these positions can link."""
    rest = F.least(n - at, m - there)
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & ((100 + PERCENT) * rest >= PERCENT * (n + m))


def meeting_places(pairs: DataFrame) -> DataFrame:
    """(node, to, salts): where each set of the pairs has to go.

    Of a pair, the set in more pairs is the hub and stays; the other goes ``to`` it.  So no
    set has to go to more places than the square root of twice the number of pairs, and a
    hub of very many pairs is dealt over ``salts`` places.
    """
    ends = [pairs.groupBy(F.col(end).alias("node")).agg(F.count("*").alias("n")) for end in ("a", "b")]
    degree = ends[0].union(ends[1]).groupBy("node").agg(F.sum("n").alias("degree"))
    degree = stored(degree, "degree", 2 * pairs.count())
    for end in ("a", "b"):
        pairs = lookup(pairs, degree.select(F.col("node").alias(end), F.col("degree").alias(f"of_{end}")), [end])
    first = F.struct("of_a", "a") > F.struct("of_b", "b")
    pairs = pairs.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("node"),
        F.ceil(F.greatest("of_a", "of_b") / MEETINGS).cast("int").alias("salts"),
    )
    place = F.struct("hub", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"))
    goes = pairs.groupBy("node").agg(F.collect_list(place).alias("to"))
    stays = pairs.groupBy(F.col("hub").alias("node")).agg(F.max("salts").alias("salts"))
    return goes.join(stays, "node", "full_outer")


def bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n, m, most) for pairs of nodes: what their sets have in common at most, by their signs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2_000):
            every = np.arange(len(batch))
            left, right = Signs(batch.column(4).to_pylist()), Signs(batch.column(5).to_pylist())
            n, m = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
            most = (n + m - left.differing(every, right, every)) // 2
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(most.astype(np.int32))], names=["a", "b", "n", "m", "most"]
            )

    for end, n, side in (("a", "n", "left"), ("b", "m", "right")):
        own = sets.select(F.col("node").alias(end), F.col("n").alias(n), F.col("sign").alias(side))
        pairs = join_one_per_key(pairs, own, [end], "left")
    return pairs.select("a", "b", "n", "m", "left", "right").mapInArrow(work, "a long, b long, n int, m int, most int")


def answered(pairs: DataFrame, rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n, m, low, common) for the stored pairs of nodes, a the lesser: bounds on their overlaps.

    The bounds are equal, from the whole sets, for all pairs that can link by their signs.
    """
    many = pairs.count()
    # The join reads all signs, however few the pairs are; a sign is as long as several short rows.
    found = stored(bounded(pairs, sets), "bounded", many + SIGN_ROWS * sets.count())
    near = can_reach(F.col("most"), F.col("n"), F.col("m"))
    exact = overlaps(stored(found.where(near).select("a", "b"), "near", many), rows, sets)
    far = found.where(~near).withColumn("low", F.lit(0)).withColumnRenamed("most", "common")
    out = exact.withColumn("low", F.col("common")).unionByName(far)
    return stored(out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "n", "m", "low", "common"), "answered", many)


def overlaps(pairs: DataFrame, rows: DataFrame, texts_of: DataFrame) -> DataFrame:
    """(a, b, n, m, common) for the stored pairs of nodes, from their whole sets.

    ``texts_of`` (node, rkey) names a document for each node.  A pair's nodes come out in
    either order.
    """
    needed = join_one_per_key(meeting_places(pairs), texts_of.select("node", "rkey"), ["node"], "left")
    needed = stored(needed.select("rkey", "to", "salts"), "needed")
    many = pairs.count()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, to, salts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = shingles(text)
                node, members = set_id(found), found.tobytes()
                out += [(node, salt, None, members) for salt in range(salts or 0)]
                out += [(place["hub"], place["salt"], node, members) for place in to or ()]
                if len(out) > 5_000:
                    yield as_rows(out, SENT)
                    out = []
            yield as_rows(out, SENT)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = mine = None
        for batch in batches:
            out = []
            for a, _, b, members in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                other = np.frombuffer(members, np.uint64)
                if b is None:
                    hub, mine = a, other
                    continue
                assert hub == a
                at = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
                out.append((a, b, len(mine), len(other), int(np.count_nonzero(mine[at] == other))))
            yield as_rows(out, COMPARED)

    texts = rows.select("rkey", "text")
    if many <= SHORT:
        texts = texts.join(F.broadcast(needed), "rkey")
    else:
        texts = texts.join(needed, "rkey")
    sent = texts.select("text", "to", "salts").mapInArrow(sets, SENT)
    met = sent.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("other").asc_nulls_first())
    return stored(met.mapInArrow(compare, COMPARED).dropDuplicates(["a", "b"]), "overlaps", many)


SENT = "hub long, salt int, other long, members binary"
COMPARED = "a long, b long, n int, m int, common int"
ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def as_rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def lookup(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` left-joined to the stored ``table``, which is broadcast if it is short."""
    if table.count() <= SHORT:
        return rows.join(F.broadcast(table), keys, "left")
    return join_one_per_key(rows, table, keys, "left")


def linked() -> F.Column:
    return 100 * F.col("common") >= PERCENT * (F.col("n") + F.col("m") - F.col("common"))


CROSS = "a long, b long, sure boolean"


def cross_pairs(lists: DataFrame) -> DataFrame:
    """Pairs of different components within each list block: linked for sure, or to compare.

    Rows: (top, left, right, shingle, part, component, node, n, at, low, common, leader, leader_n,
    sign), sorted by block (the first three) and list; ``low`` and ``common`` bound the overlap with
    the leader, -1 if unknown; ``part`` is 2 in blocks on the grid's diagonal, else 1 or -1 by side.
    Ahead of a block's lists stand, with ``part`` 0, the signs of its nodes.  Lists of one
    top leader lie together because they hold the same pairs again and again: each goes out once.
    """

    def pairs(rows: np.ndarray, nodes: np.ndarray, signs: Signs) -> Iterator[np.ndarray]:
        lists = np.cumsum(np.append(True, (rows[1:, :4] != rows[:-1, :4]).any(axis=1)))
        order = np.lexsort((rows[:, 5], lists))
        block, (part, comp, node, n, at, low, common, leader, leader_n) = lists[order], rows[order, 4:].T
        signed = np.searchsorted(nodes, node)
        # Each entry meets those behind it in its list; those of its own component are skipped whole.
        own = np.cumsum(np.append(True, (block[1:] != block[:-1]) | (comp[1:] != comp[:-1])))
        begin = np.searchsorted(own, own, side="right")
        count = np.searchsorted(block, block, side="right") - begin
        total = np.cumsum(count)
        first = 0
        while first < len(rows):
            done = total[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(total, done + 500_000, side="right")))
            c = count[first:last]
            i = np.repeat(np.arange(first, last), c)
            j = np.arange(len(i)) + np.repeat(begin[first:last] - np.cumsum(c) + c, c)
            first = last
            both, rest = n[i] + n[j], np.minimum(n[i] - at[i], n[j] - at[j])
            keep = ((part[i] == 2) | (part[i] + part[j] == 0)) & ((100 + PERCENT) * rest >= PERCENT * both)
            keep &= 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
            i, j, both = i[keep], j[keep], both[keep]
            known = (common[i] >= 0) & (common[j] >= 0) & (leader[i] == leader[j])
            most = np.minimum(common[i], common[j]) + np.minimum(n[i] - low[i], n[j] - low[j])
            least = low[i] + low[j] - leader_n[i]
            sure = known & can_reach(least, n[i], n[j])
            keep = ~known | can_reach(most, n[i], n[j])
            i, j, sure = i[keep], j[keep], sure[keep]
            ends = np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), sure], axis=1)
            ends, at_first = np.unique(ends, axis=0, return_index=True)
            i, j = i[at_first], j[at_first]
            keep = ends[:, 2] > 0
            look = np.flatnonzero(~keep)
            i, j = i[look], j[look]
            most = (n[i] + n[j] - signs.differing(signed[i], signs, signed[j])) // 2
            keep[look] = can_reach(most, n[i], n[j])
            yield ends[keep]

    def once(rows: np.ndarray, signs: list[bytes]) -> Iterator[pa.RecordBatch]:
        own = rows[:, 4] == 0
        nodes, at = np.unique(rows[own, 6], return_index=True)
        pool = np.empty((0, 3), np.int64)
        for found in pairs(rows[~own], nodes, Signs([signs[i] for i in at.tolist()])):
            pool = np.unique(np.concatenate([pool, found]), axis=0)
            if len(pool) > 1_000_000:
                yield as_batch(pool)
                pool = pool[:0]
        yield as_batch(pool)

    def as_batch(found: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(found[:, 2].astype(bool))]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "sure"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, signs = np.empty((0, 13), np.int64), []
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:-1]], axis=1)
            held = np.concatenate([held, rows])
            signs += batch.column(13).drop_null().to_pylist()
            if not len(held):
                continue
            # The last block may go on in the next batch.
            whole = int(np.flatnonzero((held[:, :3] == held[-1, :3]).all(axis=1))[0])
            if whole:
                ended = int(np.count_nonzero(held[:whole, 4] == 0))
                yield from once(held[:whole], signs[:ended])
                held, signs = held[whole:], signs[ended:]
        if len(held):
            yield from once(held, signs)

    return lists.mapInArrow(work, CROSS)


def prefix_lists(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """The index lists of two entries or more (LISTED)."""
    often = (
        seen.where("times IS NOT NULL").groupBy("node").agg(F.sum("times").alias("times"))
        .orderBy(F.desc("times"), "node").limit(FREQUENT).select("node").collect()
    )
    frequent = np.array([r.node for r in reversed(often)], np.int64).view(np.uint64)
    salt = F.when(F.col("shingle") < 0, F.pmod(F.col("node"), F.lit(SALTS))).otherwise(0).cast("int")
    dealt = entries(rows, frequent).withColumn("salt", salt).repartition("shingle", "salt")
    # A list is led by the set in which its shingle comes first: what others have put in or
    # changed is rare and comes before, so near copies are led by the text they vary.
    early = F.when(F.col("shingle") < 0, F.col("at")).otherwise(0)
    return stored(with_leaders(dealt.sortWithinPartitions("shingle", "salt", early, "node")), "lists")


def leader_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): every entry with its list's leader, and the leaders of a dealt list with one."""
    near = lists.where(can_link(F.col("n"), F.col("at"), F.col("leader_n"), F.col("leader_at")))
    leaders = lists.where("shingle < 0").select("shingle", "leader", "leader_at").distinct()
    top = leaders.groupBy("shingle").agg(F.min_by("leader", F.struct("leader_at", "leader")).alias("top"))
    upper = join_one_per_key(leaders, top, ["shingle"], "left").select("leader", "top")
    pairs = near.select("node", "leader").union(upper).toDF("b", "a")
    return pairs.where("a <> b").select("a", "b").distinct()


def mixed_lists(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """The lists that hold several components: their entries with ``root``, the list's ``top``
    leader and as many ``further`` ones, the earliest entries of as many hash classes."""
    placed = lookup(lists, roots, ["node"])
    placed = stored(placed.withColumn("root", F.coalesce("root", "node")), "placed")
    first = F.min_by("leader", F.struct("leader_at", "leader")).alias("top")
    kind = F.pmod(F.xxhash64("node"), F.lit(LEADERS))
    best = [F.min(F.when(kind == i, F.struct("at", "node", "n", "root"))) for i in range(LEADERS)]
    ends = placed.groupBy("shingle").agg(
        first, F.array(*best).alias("further"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    mixed = ends.where("low <> high").select("shingle", "top", "further")
    mixed = stored(join_one_per_key(placed, mixed, ["shingle"], "left").where("top IS NOT NULL"), "mixed")
    freed(placed)
    return mixed


def further_pairs(mixed: DataFrame) -> DataFrame:
    """(a, b): every entry with the further leaders of its list that are in other components."""
    pairs = []
    for i in range(LEADERS):
        leader = F.col("further")[i]
        near = can_link(F.col("n"), F.col("at"), leader["n"], leader["at"]) & (leader["root"] != F.col("root"))
        ends = (F.least(leader["node"], F.col("node")), F.greatest(leader["node"], F.col("node")))
        pairs.append(mixed.where(near).select(ends[0].alias("a"), ends[1].alias("b")))
    out = pairs[0]
    for more in pairs[1:]:
        out = out.union(more)
    return out.distinct()


def blocks(placed: DataFrame, answers: DataFrame, sets: DataFrame) -> DataFrame:
    """The entries of ``mixed_lists`` and the signs of their sets, dealt and sorted for ``cross_pairs``."""
    weight = F.sum(1 + F.col("n") / SIGNED)
    long = placed.groupBy("top").agg(weight.alias("size")).where(F.col("size") > BLOCK)
    placed = lookup(placed, stored(long, "long", placed.count()), ["top"])
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    known = answers.select(ways.alias("w"), "low", "common").select("w.a", "w.b", "low", "common")
    known = known.toDF("leader", "node", "low", "common")
    led = F.col("node") == F.col("leader")
    bound = lambda name: F.when(led, F.col("n")).otherwise(F.coalesce(name, F.lit(-1))).alias(name)

    def dealt(rows: DataFrame) -> DataFrame:
        grid = F.coalesce(F.ceil(F.col("size") / BLOCK), F.lit(1)).cast("int")
        rows = rows.withColumn("grid", grid).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("grid")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("grid") - 1)))
        return rows.withColumn("left", F.least("mine", "other")).withColumn("right", F.greatest("mine", "other"))

    part = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 1).otherwise(-1)
    found = dealt(lookup(placed, known, ["leader", "node"])).select(
        "top", "left", "right", "shingle", part.alias("part"), "root", "node", "n", "at",
        bound("low"), bound("common"), "leader", "leader_n", F.lit(None).cast("binary").alias("sign"),
    )
    signed = join_one_per_key(placed.select("top", "node", "size").distinct(), sets.select("node", "sign"), ["node"], "left")
    none = {name: F.lit(0) for name in ("shingle", "part", "root", "n", "at", "low", "common", "leader", "leader_n")}
    signed = dealt(signed).withColumns(none).select(*found.columns)
    return (
        found.union(signed)
        .repartition("top", "left", "right")
        .sortWithinPartitions("top", "left", "right", F.col("part") != 0, "shingle")
    )


def linked_sets(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """(node, root) for the sets that link with another one."""
    sets = seen.where("n > 0").groupBy("node").agg(F.min(F.struct("rkey", "n", "sign")).alias("of"))
    sets = stored(sets.select("node", "of.*"), "sets")
    lists = prefix_lists(rows, seen)
    # An entry makes one pair with its leader, and a leader one with another.
    answers = answered(stored(leader_pairs(lists), "pairs", 2 * lists.count()), rows, sets)
    mixed = mixed_lists(lists, components(answers.where(linked())))
    more = answered(stored(further_pairs(mixed), "further", LEADERS * mixed.count()), rows, sets)
    freed(mixed)
    found = answers.count() + more.count()
    answers = stored(answers.union(more).dropDuplicates(["a", "b"]), "answers", found)
    links = answers.where(linked()).select("a", "b")
    mixed = mixed_lists(lists, components(links))
    freed(lists)
    cross = cross_pairs(blocks(mixed, answers, sets))
    cross = stored(cross.groupBy("a", "b").agg(F.max("sure").alias("sure")), "cross")
    freed(mixed)
    unsure = stored(cross.where("NOT sure").select("a", "b"), "unsure", cross.count())
    compared = overlaps(unsure, rows, sets)
    links = links.union(cross.where("sure").select("a", "b")).union(compared.where(linked()).select("a", "b"))
    return components(links)


def members(docs: DataFrame) -> DataFrame:
    """(rid, rkey, n, root, name) by row: its set's size, its component and the least doc_id in it."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rid"), row_key().alias("rkey"), "text"
    )
    seen = stored(survey(rows), "survey")
    nodes = seen.where("times IS NULL").select("rid", "rkey", "node", "n")
    nodes = join_one_per_key(nodes, linked_sets(rows, seen), ["node"], "left")
    nodes = stored(nodes.select("rid", "rkey", "n", F.coalesce("root", "node").alias("root")), "members")
    names = nodes.where("root IS NOT NULL").groupBy("root").agg(F.min("rid").alias("name"))
    return join_one_per_key(nodes, names, ["root"], "left")


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for ``docs`` (doc_id, text); see above."""
    given = lambda c: F.when(c != LAST, c)
    return members(docs).select(
        given(F.col("rid")).alias("doc_id"),
        F.col("n").cast("long").alias("n_shingles"),
        given(F.coalesce("name", "rid")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the least doc_id.

    Rows without words have no duplicates and stay.  Of several rows with that doc_id the one
    with the least text key stays; of identical ones, one.
    """
    found = members(docs.select("doc_id", "text"))
    least = found.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("rid", "rkey")).alias("stays"))
    stay = join_one_per_key(found, least, ["root"], "left")
    stay = stay.where(F.col("root").isNull() | (F.col("stays.rkey") == F.col("rkey")))
    stay = stored(stay.select(F.col("rkey").alias(KEY), (F.col("n") == 0).alias(CUTS)).distinct(), "stay")
    kept = docs.withColumn(KEY, row_key()).join(stay, KEY)
    # The join has sorted the rows by their key; identical rows lie together.
    again = F.row_number().over(Window.partitionBy(KEY).orderBy(F.lit(0)))
    return kept.withColumn("_llm_again", again).where(F.col(CUTS) | (F.col("_llm_again") == 1)).select(*docs.columns)
