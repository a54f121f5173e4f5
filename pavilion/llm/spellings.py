"""Groups of spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point makes one the other:
their common prefix and common suffix together reach the longer length minus one. A word's
form is its most frequent near word, if that is ``times`` as frequent; forms lead to a root.

1. Words are counted natively, combined before the shuffle.
2. Where the longer of two near words has m code points and the edit lies in positions
   a to b of it, both share the first a and the last m - b code points. Each word goes to
   the lists of its three thirds, once as a longer word (m is its length) and once as a
   shorter one (m is its length plus one). A pair of near words meets in the list of the
   third in which they first differ.
3. A list of more than ``TILE`` words is cut: the window of the edit is halved, and words
   go on to the lists of both halves. This repeats; at a width of one all words of a list
   are near and there is one per code point of the alphabet. Nothing is capped or lost.
4. A list is a pair of matrices of code points, padded to the window: longer words against
   themselves and against the shorter ones, block by block. Running equality from the left
   and from the right gives the lengths of common prefix and suffix of all pairs of a block.
5. Each word keeps its number of near words and the best of them, per list and then over
   all lists. Roots follow by doubling steps: n grows ``times``-fold at each, so the number
   of steps is known.

Cases: null and empty texts have no words; rows without an identifier are not misspelt by
the rule below; repeated rows count as often as they occur; empty tables give an empty
result; further columns are ignored; a word of any length is compared whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavilion.functions.staging import stage

RUN = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
THIRDS = 3
TILE = 1024
CELLS = 1 << 22
ROWS_PER_TASK = 20_000
MISSPELT = 199


def runs(docs: DataFrame, least: int) -> DataFrame:
    """``doc_id`` and ``run``: every maximal run of ``least`` or more letters, in lower case."""
    text = F.translate("text", UPPER, LOWER)
    found = F.regexp_extract_all(text, F.lit(f"{RUN}{{{least},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run"))


def misspelt(found: DataFrame, every: int = MISSPELT) -> DataFrame:
    """``word``: the run, without one code point where ``every`` divides its checksum."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.select(F.when(h % every == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int, often: int) -> DataFrame:
    """``word`` and ``n`` of the words of ``least`` code points that occur ``often``."""
    counted = words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= often)


def lists(words: DataFrame) -> DataFrame:
    """The first lists: ``word``, ``n``, length ``m`` of the longer, window ``a`` to ``b``, ``key``."""
    m = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("m")
    third = F.explode(F.sequence(F.lit(0), F.lit(THIRDS - 1))).alias("third")
    dealt = words.select("word", "n", m).select("*", third)
    edge = lambda t: F.floor(t * F.col("m") / THIRDS).cast("int")
    return with_keys(dealt.select("word", "n", "m", edge(F.col("third")).alias("a"), edge(F.col("third") + 1).alias("b")))


def with_keys(dealt: DataFrame) -> DataFrame:
    """``key``: what lies before and behind the window."""
    before = F.substring("word", F.lit(1), F.col("a"))
    behind = F.substring("word", F.length("word") - F.col("m") + F.col("b") + 1, F.col("m"))
    return dealt.withColumn("key", F.concat(before, behind))


def halves(dealt: DataFrame) -> DataFrame:
    """The same words under both halves of their window."""
    middle = F.expr("(a + b) div 2").cast("int")
    parts = F.array(F.struct("a", middle.alias("b")), F.struct(middle.alias("a"), "b"))
    cut = dealt.select("word", "n", "m", F.explode(parts).alias("p")).select("word", "n", "m", "p.*")
    return with_keys(cut)


def tiles(words: DataFrame, tile: int = TILE) -> list[DataFrame]:
    """Lists that fit a tile; longer ones come with narrower windows."""
    out, dealt = [], stage(lists(words), "spelling-lists")
    key = ["m", "a", "b", "key"]
    while True:
        counted = dealt.groupBy(*key).agg(F.count("*").alias("many")).where("many > 1")
        longest = stage(counted, "spelling-counts")
        held = dealt.join(longest, key)
        done = (F.col("many") <= tile) | (F.col("b") - F.col("a") == 1)
        out.append(held.where(done).drop("many"))
        rest = longest.where(~done).agg(F.sum("many")).first()[0]
        if not rest:
            return out
        dealt = stage(halves(held.where(~done)), "spelling-lists")


def matrix(words: list[str], width: int) -> np.ndarray:
    """Code points of words, padded to ``width``."""
    if not words or not width:
        return np.zeros((len(words), width), np.uint32)
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


def common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of ``x`` with each row of ``y``."""
    same = x[:, None, :] == y[None, :, :]
    return np.logical_and.accumulate(same, axis=2, out=same).sum(2)


def near_pairs(long: list[str], short: list[str], m: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs whose first difference lies in the window, as places in ``long + short``.

    All have the same code points outside the window; ``m`` is the length of the longer.
    """
    width = b - a
    x = matrix([w[a:b] for w in long], width)
    y = matrix([w[a : b - 1] for w in short], width - 1)
    # a shorter word that agrees to the window's end first differs there, unless the code
    # point is doubled across it
    ends_here = np.array([b == m or w[b - 1] != w[b] for w in long], bool)
    step = max(1, CELLS // max(1, max(len(long), len(short)) * width))
    left, right = [], []
    for at in range(0, len(long), step):
        part = x[at : at + step]
        reach = common(part, x) + common(part[:, ::-1], x[:, ::-1])
        i, j = np.nonzero(reach >= width - 1)
        i, j = i[i + at < j] + at, j[i + at < j]
        left.append(i)
        right.append(j)
        if len(short):
            prefix = common(part[:, :-1], y)
            near = prefix + common(part[:, :0:-1], y[:, ::-1]) >= width - 1
            near &= (prefix < width - 1) | ends_here[at : at + step, None]
            i, j = np.nonzero(near)
            left.append(i + at)
            right.append(j + len(long))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def compare(found: pa.Table) -> pa.Table:
    """Per word and list: number of near words, and the most frequent of them."""
    found = found.sort_by([(c, "ascending") for c in ("m", "a", "b", "key", "word")])
    keys = list(zip(*(found[c].to_pylist() for c in ("m", "a", "b", "key")), strict=True))
    words, counts = found["word"].to_pylist(), found["n"].to_numpy()
    heads = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]] + [len(keys)]
    rows: list[tuple] = []
    for lo, hi in zip(heads[:-1], heads[1:], strict=True):
        m, a, b, _ = keys[lo]
        at = sorted(range(lo, hi), key=lambda k: len(words[k]) < m)  # stable: longer ones first
        long = [words[k] for k in at if len(words[k]) == m]
        short = [words[k] for k in at if len(words[k]) < m]
        if not long:
            continue
        left, right = near_pairs(long, short, m, a, b)
        if not len(left):
            continue
        one, two = np.concatenate([left, right]), np.concatenate([right, left])
        place = np.array(at)
        n = counts[place]
        # words of each kind are in code-point order; rank them all to settle ties
        rank = np.empty(len(at), np.int64)
        rank[sorted(range(len(at)), key=lambda k: words[at[k]])] = np.arange(len(at))
        order = np.lexsort((rank[two], -n[two], one))
        firsts = np.flatnonzero(np.diff(one[order], prepend=-1))
        many = np.diff(np.append(firsts, len(order)))
        for f, c in zip(order[firsts].tolist(), many.tolist(), strict=True):
            best = int(place[two[f]])
            rows.append((words[place[one[f]]], c, int(counts[best]), words[best]))
    kinds = (("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string()))
    return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(kinds)})


def nearest(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``word``, ``n_near``, ``near_n`` and ``near``: how many are near, and the most frequent."""
    parts = []
    for held in tiles(words, tile):
        held = stage(held, "spelling-tiles")
        tasks = max(1, -(-held.count() // ROWS_PER_TASK))
        task = F.pmod(F.xxhash64("m", "a", "b", "key"), F.lit(tasks))
        schema = "word string, n_near long, near_n long, near string"
        parts.append(held.withColumn("task", task).groupBy("task").applyInArrow(
            lambda t: compare(t.drop(["task"])), schema
        ))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    grouped = every.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return grouped.select("word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.near").alias("near"))


def with_roots(forms: DataFrame, steps: int) -> DataFrame:
    """``root`` of each row of ``word`` and ``form``, at most ``steps`` forms away."""
    jumps = stage(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(math.ceil(math.log2(max(1, steps)))):
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumps = stage(
            jumps.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
            "spelling-roots",
        )
    return forms.join(jumps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(words: DataFrame, times: int = 5, tile: int = TILE) -> DataFrame:
    """Forms and roots of a vocabulary of ``word`` and ``n``."""
    if times < 2:
        raise ValueError("a form must be at least twice as frequent")
    words = stage(words, "spelling-words")
    top = words.agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    steps = math.floor(math.log(max(1, (top["most"] or 1) / (top["least"] or 1)), times)) + 1
    joined = words.join(nearest(words, tile), "word", "left")
    is_form = F.col("near_n") >= times * F.col("n")
    forms = stage(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("near")).alias("form"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    return with_roots(forms, steps).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, least: int = 6, often: int = 5, times: int = 5) -> DataFrame:
    """Words of the corpus, misspelt now and then by the rule above, with form and root."""
    return group_variants(vocabulary(misspelt(runs(docs, least)), least, often), times)
