"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words are runs of ``[A-Za-z\\u00C0-\\u00FF]`` with only A-Z lower-cased.  A run is first marked by
h, the unsigned crc32 of the UTF-8 text ``<doc_id>:<run>`` (a missing doc_id is written as
nothing, so the text starts with ``:``): where 199 divides h, the code point h % length is
deleted.  The vocabulary is the distinct results of at least ``SHORTEST`` code points that occur
``COMMON`` times or more over all texts; a missing text has no runs.

Two words are near when one inserted, deleted or replaced code point turns one into the other.
They are found by a frequency-vector trie: a word's vector counts its letters by ``GROUPS``
letter groups, and a near word's vector differs by at most +1 in one group and -1 in another.
The vocabulary is cut into blocks so that near words always share one: the groups form three
parts (group g in part g mod 3, so that each part holds frequent and rare letters), an edit
changes at most two of them, so near words agree on the counts of one part at least, and every
word goes to one block per part.  A pair is reported by the first part on which
its words agree, so once.  Within a block the words are sorted by their vectors (the trie, each
node a range of the sorted list); a word's search walks it group by group and may spend a
surplus of one and a deficit of one; the words in the leaves reached are verified exactly.
Blocks of more than ``BLOCK`` words are dealt over a grid of pieces, so no task holds more than
about ``BLOCK`` words to search in, and every pair of the block still meets in one piece.

A word's form is its near word of largest n (ties: the least in code-point order) if that n is at
least ``STEP`` times its own; its root follows forms to the end.  As n grows by a factor of
``STEP`` along a chain, chains are short and have no cycles; roots are found by pointer jumping,
a join a round.  Result: one row per vocabulary word with word, form, root, n, n_near, form_n.
Empty inputs give no rows; rows that repeat a doc_id and text are counted as often as they occur.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from newsrisk.llm.common import stored

#: Fixed values of the contract: the letters, the deletion modulus.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARKED = 199
#: Fixed values of the contract: shortest word, least count, factor of a form.
SHORTEST, COMMON, STEP = 6, 5, 5
#: Letter groups of the vectors (three parts of ten), the most words a task searches in, and
#: the queries searched at once (which bounds the candidates held).
GROUPS, BLOCK, CHUNK = 30, 50_000, 2048
#: a-z from frequent to rare in English prose, each its own group; dealt round the three parts,
#: they carry about as many letters of a typical word; the letters of U+00C0..U+00FF share groups.
_ORDER = "etaoinshrdlcumwfgypbvkjxqz"


def group_of(ch: str) -> int:
    """The letter group of a lower-case letter or of one of U+00C0..U+00FF."""
    at = _ORDER.find(ch)
    return at % GROUPS if at >= 0 else ord(ch) % GROUPS


def _classes() -> list[str]:
    members = [[] for _ in range(GROUPS)]
    for ch in [*_ORDER, *map(chr, range(0xC0, 0x100))]:
        members[group_of(ch)].append(ch)
    return ["[" + "".join(m).replace("\\", "\\\\") + "]" for m in members]


def marked_runs(docs: DataFrame) -> DataFrame:
    """(word): every run of every text, lower-cased and, where marked, with one code point less."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(LETTERS), 0)).alias("run"),
    ).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return runs.select(F.when(h % MARKED == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, common: int = COMMON) -> DataFrame:
    """(word, n, vec): words of ``shortest`` code points or more, found ``common`` times or more."""
    counted = marked_runs(docs).groupBy("word").agg(F.count("*").alias("n"))
    kept = counted.where((F.length("word") >= shortest) & (F.col("n") >= common))
    counts = [F.length("word") - F.length(F.regexp_replace("word", c, "")) for c in _classes()]
    return kept.withColumn("vec", F.array(*counts))


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i + 1 :] == b[i:]


def _walk(vecs: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trie walk of all queries at once: (query, row) of every leaf row reached.

    ``vecs`` are sorted lexicographically, so the rows below a trie node of depth d are a range
    with one prefix of d counts.  A node is named by the rank of its prefix; the children of all
    nodes of the frontier are found with one binary search over the keys (rank of the parent,
    count), which grow along the rows.  A step may add one to a count (the surplus) or take one
    away (the deficit), each at most once on a path.
    """
    n = len(vecs)
    if n == 0 or len(queries) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    radix = int(max(vecs.max(), queries.max())) + 3
    parent = np.zeros(n, np.int64)
    q = np.arange(len(queries))
    node = np.zeros(len(queries), np.int64)
    surplus = np.ones(len(queries), np.int8)
    deficit = np.ones(len(queries), np.int8)
    lo = hi = None
    for depth in range(GROUPS):
        keys = parent * radix + vecs[:, depth]
        steps = []
        for delta in (0, 1, -1):
            ok = np.ones(len(q), bool) if delta == 0 else (surplus > 0 if delta == 1 else deficit > 0)
            want = queries[q, depth] + delta
            ok &= want >= 0
            probe = node[ok] * radix + want[ok]
            a = np.searchsorted(keys, probe, "left")
            b = np.searchsorted(keys, probe, "right")
            hit = b > a
            steps.append(
                (q[ok][hit], a[hit], b[hit], surplus[ok][hit] - (delta == 1), deficit[ok][hit] - (delta == -1))
            )
        q, lo, hi, surplus, deficit = (np.concatenate(x) for x in zip(*steps, strict=True))
        change = np.ones(n, bool)
        change[1:] = keys[1:] != keys[:-1]
        rank = np.cumsum(change) - 1
        node = rank[lo]
        parent = rank
    sizes = hi - lo
    starts = np.repeat(lo, sizes)
    offsets = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(q, sizes), starts + offsets


def _points(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words of at most ``width``, padded left-aligned and right-aligned, and lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    left = np.zeros((len(words), width), np.uint32)
    right = np.zeros((len(words), width), np.uint32)
    for i, w in enumerate(words):
        if lengths[i] <= width:
            cps = np.frombuffer(w.encode("utf-32-le"), np.uint32)
            left[i, : len(cps)] = cps
            right[i, width - len(cps) :] = cps
    return left, right, lengths


def _one_edit_pairs(a: tuple, b: tuple, who: np.ndarray, row: np.ndarray, width: int) -> np.ndarray:
    """``one_edit`` for many pairs of words of at most ``width`` code points, in numpy.

    With p the common prefix and q the common suffix of two words (the longer of length L), one
    edit turns one into the other exactly when they differ and p + q >= L - 1 (same lengths:
    the one replaced place; lengths one apart: the deleted one).
    """
    (al, ar, alen), (bl, br, blen) = a, b
    la, lb = alen[who], blen[row]
    longer = np.maximum(la, lb)
    sentinel = np.ones((len(who), 1), bool)
    same = np.concatenate([al[who] != bl[row], sentinel], axis=1)
    prefix = np.minimum(same.argmax(axis=1), np.minimum(la, lb))
    tail = np.concatenate([(ar[who] != br[row])[:, ::-1], sentinel], axis=1)
    suffix = np.minimum(tail.argmax(axis=1), np.minimum(la, lb))
    differ = (la != lb) | (prefix < la)
    return differ & (np.abs(la - lb) <= 1) & (prefix + suffix >= longer - 1)


#: Words up to this many code points are verified in numpy; longer ones one by one.
WIDE = 32


def _near_in_block(block: pd.DataFrame) -> pd.DataFrame:
    index = block[block["role"] == 1]
    queries = block[block["role"] == 0]
    vecs = np.array(index["vec"].tolist(), np.int64).reshape(len(index), GROUPS)
    order = np.lexsort(vecs.T[::-1]) if len(vecs) else np.arange(0)
    vecs, words = vecs[order], index["word"].to_numpy()[order]
    qvecs = np.array(queries["vec"].tolist(), np.int64).reshape(len(queries), GROUPS)
    qwords = queries["word"].to_numpy()
    part = int(block["part"].iloc[0])
    qcodes, codes = _points(qwords, WIDE), _points(words, WIDE)
    found_word, found_near = [], []
    for at in range(0, len(qvecs), CHUNK):
        who, row = _walk(vecs, qvecs[at : at + CHUNK])
        who += at
        # A pair is reported by the first part on which the two words agree.
        earlier = np.zeros(len(who), bool)
        for q in range(part):
            earlier |= (qvecs[who][:, q::3] == vecs[row][:, q::3]).all(axis=1)
        who, row = who[~earlier], row[~earlier]
        short = (qcodes[2][who] <= WIDE) & (codes[2][row] <= WIDE)
        hit = _one_edit_pairs(qcodes, codes, who[short], row[short], WIDE)
        found_word.extend(qwords[who[short][hit]])
        found_near.extend(words[row[short][hit]])
        for a, b in zip(qwords[who[~short]], words[row[~short]], strict=True):
            if one_edit(a, b):
                found_word.append(a)
                found_near.append(b)
    return pd.DataFrame({"word": pd.Series(found_word, dtype=object), "near": pd.Series(found_near, dtype=object)})


def near_pairs(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near): every ordered pair of vocabulary words one edit apart, once."""
    keyed = vocab.select(
        "word", "vec", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("part")
    ).withColumn("sub", F.filter("vec", lambda x, i: i % 3 == F.col("part")))
    keyed = stored(keyed, "spelling_keys")
    # Blocks above ``block`` words: at most 3 * |vocabulary| / block rows.
    hot = keyed.groupBy("part", "sub").agg(F.count("*").alias("size")).where(F.col("size") > block)
    pieces = F.coalesce(F.ceil(F.col("size") / block), F.lit(1)).cast("int")
    grid = keyed.join(F.broadcast(hot), ["part", "sub"], "left").withColumn("pieces", pieces)
    spread = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    mine = F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int")
    # A query meets every index piece of its row of the grid, an index word every query row.
    queries = grid.select("part", "sub", "word", "vec", mine.alias("row"), spread.alias("col"), F.lit(0).alias("role"))
    index = grid.select("part", "sub", "word", "vec", spread.alias("row"), mine.alias("col"), F.lit(1).alias("role"))
    return (
        queries.unionByName(index)
        .groupBy("part", "sub", "row", "col")
        .applyInPandas(_near_in_block, "word string, near string")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the end by pointer jumping, a join a round."""
    step = forms.select("word", F.coalesce("form", "word").alias("root"))
    step = stored(step, "spelling_root")
    while True:
        ahead = step.alias("a").join(step.alias("b"), F.col("a.root") == F.col("b.word"), "left")
        nxt = ahead.select(F.col("a.word").alias("word"), F.coalesce(F.col("b.root"), F.col("a.root")).alias("root"))
        nxt = stored(nxt, "spelling_root")
        moved = nxt.alias("n").join(step.alias("s"), "word").where(F.col("n.root") != F.col("s.root")).limit(1).count()
        step = nxt
        if not moved:
            return step


def variants(docs: DataFrame, shortest: int = SHORTEST, common: int = COMMON, step: int = STEP, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every vocabulary word of ``docs`` (doc_id, text)."""
    vocab = stored(vocabulary(docs, shortest, common), "spelling_vocab")
    pairs = near_pairs(vocab, block)
    counted = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    linked = pairs.join(counted, "near")
    best = linked.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near"))).alias("best"),
    )
    rows = vocab.select("word", "n").join(best, "word", "left")
    promoted: Column = F.col("best.near_n") >= F.col("n") * step
    forms = rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(promoted, F.col("best.near")).alias("form"),
        F.when(promoted, F.col("best.near_n")).cast("long").alias("form_n"),
    )
    forms = stored(forms, "spelling_forms")
    return forms.join(roots(forms), "word").select("word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", "form_n")
