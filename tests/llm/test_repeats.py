"""Repeats and near copies against brute-force versions."""

import collections
import hashlib
import random
import re
import string

import pytest

from pavilion.llm import byte_repeats, jaccard_join, word_repeats

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "home int, n int, key string, bucket int, size int, component_id int"
)


def documents(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", 0, 1, 2, "k", 3, 4, 5) for i, t in rows], SCHEMA
    )


def corpus(seed=0):
    r = random.Random(seed)
    vocabulary = ["é" * r.randint(1, 3) + "".join(r.choices("abc", k=r.randint(1, 4))) for _ in range(60)]
    passages = [" ".join(r.choices(vocabulary, k=r.randint(15, 60))) for _ in range(6)]
    rows = []
    for i in range(70):
        parts = [" ".join(r.choices(vocabulary, k=r.randint(0, 50)))]
        parts += r.sample(passages, r.randint(0, 3))
        r.shuffle(parts)
        rows.append((i * 3 % 70, "\n".join(parts)))
    base = " ".join(r.choices(vocabulary, k=80)).split()
    for i in range(100, 120):
        words = list(base)
        for _ in range(r.randint(0, 4)):
            words[r.randrange(80)] = r.choice(vocabulary)
        rows.append((i, " ".join(words).upper() if i % 5 == 0 else "  ".join(words)))
    rows += [(200, "a" * 350), (201, "ab" * 170), (202, ""), (203, None), (204, " \t\n"), (205, "x y")]
    rows += [(206, "X  y"), (207, passages[0]), (208, passages[0]), (209, "z " * 70)]
    return rows


def words_brute(rows, window):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            k = tuple(words[s : s + window])
            if k in seen:
                gone[s : s + window] = [True] * window
            seen.add(k)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def bytes_brute(rows, window):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - window + 1):
            if data[s : s + window] in seen:
                gone[s : s + window] = b"\1" * window
            seen.add(data[s : s + window])
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def sets_brute(rows, length):
    out = {}
    for i, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        grams = [tuple(w[k : k + length]) for k in range(len(w) - length + 1)] if len(w) >= length else [tuple(w)]
        out[i] = frozenset(grams) if w else frozenset()
    return out


def components_brute(rows, length, numerator):
    sets = sets_brute(rows, length)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = collections.Counter()
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= numerator * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
                links[a, b] += 1
    return [(i, len(sets[i]), root(i)) for i in sets]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(x) for x in r))


def in_order(rows):
    return sorted(rows, key=lambda r: tuple(str(x) for x in r))


@pytest.mark.parametrize("hot", [byte_repeats.HOT, 2])
def test_byte_repeats(spark, hot):
    rows = corpus() + [(None, "no name " * 30), (None, "no name " * 30), (208, "other row of 208")]
    found = byte_repeats.remove_repeats(documents(spark, rows), hot=hot)
    assert collected(found) == in_order(bytes_brute(rows, 100))


@pytest.mark.parametrize("window", [20, 7, 1])
def test_word_repeats(spark, window):
    rows = corpus(1) + [(None, "no name " * 30), (None, "no name " * 30), (208, "other row of 208")]
    found = word_repeats.remove_repeats(documents(spark, rows), window)
    assert collected(found) == in_order(words_brute(rows, window))


@pytest.mark.parametrize(("length", "numerator"), [(4, 85), (5, 80), (1, 60)])
def test_near_duplicates(spark, length, numerator):
    rows = corpus(2)
    limit = jaccard_join.Threshold(numerator, 100)
    found = jaccard_join.near_duplicates(documents(spark, rows), length, limit)
    assert collected(found) == in_order(components_brute(rows, length, numerator))


def test_families_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 3)
    rows = corpus(3)
    limit = jaccard_join.Threshold(85, 100)
    found = jaccard_join.near_duplicates(documents(spark, rows), 4, limit)
    assert collected(found) == in_order(components_brute(rows, 4, 85))


def test_rows_without_identifier_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (None, text), (5, text), (5, text), (4, text), (6, None)]
    limit = jaccard_join.Threshold(85, 100)
    found = jaccard_join.near_duplicates(documents(spark, rows), 4, limit)
    want = [(None, 27, None)] * 2 + [(5, 27, 4)] * 2 + [(4, 27, 4), (6, 0, 6)]
    assert collected(found) == in_order(want)
    kept = jaccard_join.one_per_component(documents(spark, rows), 4, limit)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "6", "None", "None"]
    assert kept.columns == documents(spark, rows).columns


@pytest.mark.parametrize(
    "run",
    [
        byte_repeats.remove_repeats,
        word_repeats.remove_repeats,
        lambda d: jaccard_join.near_duplicates(d, 4, jaccard_join.Threshold()),
    ],
)
def test_empty_table(spark, run):
    assert run(documents(spark, [])).collect() == []
    assert len(run(documents(spark, [(1, None)])).collect()) == 1
