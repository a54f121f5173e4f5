"""Fingerprints, spelling variants and collocations against brute-force versions."""

import collections
import random
import re
import string
import zlib

import numpy as np
import pytest
import xxhash

from pavilion.llm import collocations, simhash, spellings

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = (
    "doc_id long, text string, lang string, fingerprint string, word string, n long, "
    "key string, a int, block long, data binary, id long, component int"
)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, l, "f", "w", 1, "k", 2, 3, b"x", 4, 5) for i, t, l in rows], SCHEMA)


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    n = min(3, len(words))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - n + 1)] if n else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(items, near):
    """The least item reachable from each."""
    items = sorted(items)
    found = {x: x for x in items}
    for start in items:
        if found[start] != start:
            continue
        todo = [start]
        while todo:
            x = todo.pop()
            for y in items:
                if found[y] == y and y > start and near(x, y):
                    found[y] = start
                    todo.append(y)
    return found


def prints_near(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count() <= 2


def test_fingerprints_and_components(spark):
    r = random.Random(3)
    vocabulary = ["é" * r.randint(0, 2) + "".join(r.choices("abCD", k=3)) for _ in range(40)]
    rows = [(i, " ".join(r.choices(vocabulary, k=r.randint(0, 30))), "en") for i in range(60)]
    long = r.choices(vocabulary, k=3000)
    for i in range(60, 80):  # long texts with few changes differ in few bits
        words = list(long)
        words[r.randrange(3000)] = "x"
        rows.append((i, ("\n" if i % 2 else "  ").join(words).upper(), None))
    rows += [(90, None, "en"), (91, "", "en"), (92, " \t\n", "en"), (93, "one two", "en"), (94, "ONE  two", "en")]
    rows += [(95, "one", "en"), (7, "one two", "en"), (None, "one two", "en"), (7, "one two", "en")]
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted((x.doc_id or -1, x.fingerprint) for x in got) == sorted(
        (i or -1, f"{fingerprint(t):016x}") for i, t, _ in rows
    )
    prints = {fingerprint(t) for i, t, _ in rows if i is not None}
    of = classes(prints, prints_near)
    least = collections.defaultdict(lambda: 10**9)
    for i, t, _ in rows:
        if i is not None:
            least[of[fingerprint(t)]] = min(least[of[fingerprint(t)]], i)
    for x in got:
        want = least[of[int(x.fingerprint, 16)]] if x.doc_id is not None else None
        assert x.component_id == want
    assert len({x.component_id for x in got if x.doc_id in range(60, 80)}) < 20


@pytest.mark.parametrize("longest", [4, simhash.LIST_ROWS])
def test_links_of_dense_fingerprints(spark, monkeypatch, longest):
    """Chains and clusters of near fingerprints, also where lists must be divided."""
    monkeypatch.setattr(simhash, "LIST_ROWS", longest)
    r = random.Random(5)
    prints = set()
    for _ in range(12):
        centre = r.getrandbits(64)
        for _ in range(25):
            x = centre
            for _ in range(r.randint(0, 4)):
                x ^= 1 << r.randrange(64 if r.random() < 0.5 else 12)
            prints.add(x)
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    links = simhash.links(nodes).collect()
    joined = {x: {x} for x in signed}
    for a, b in links:
        assert prints_near(a, b) or longest == 4  # divided lists link to a component's first
        if joined[a] is not joined[b]:
            joined[a] |= joined[b]
            for y in joined[b]:
                joined[y] = joined[a]
    of = classes(signed, prints_near)
    assert {x: min(joined[x]) for x in signed} == of
    assert len(set(of.values())) < len(signed)


def test_addressed_labels_agree_with_tallies():
    r = random.Random(9)
    base = r.getrandbits(64) & ~0xFFFF
    prints = np.array(sorted({base | r.getrandbits(16) & r.getrandbits(16) for _ in range(300)}), np.uint64)
    tallies = simhash.tallied(prints, 2)
    table = simhash.addressed(prints, (0, 1), 2)

    def parts(links):
        label = list(range(len(prints)))
        for _ in range(len(prints)):
            before = list(label)
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
            if label == before:
                return label
        return label

    assert parts(tallies) == parts(table)


def test_fingerprints_of_an_empty_table(spark):
    empty = simhash.near_duplicates(documents(spark, []))
    assert empty.columns == ["doc_id", "fingerprint", "component_id"]
    assert empty.count() == 0


def variants(rows, least=6, often=5, times=5):
    counts = collections.Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= often and len(w) >= least}

    def near(x, y):
        if x == y or abs(len(x) - len(y)) > 1:
            return False
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y, strict=True)) == 1
        x, y = sorted((x, y), key=len)
        return any(y[:k] + y[k + 1 :] == x for k in range(len(y)))

    every = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, found in every.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        if best and counts[best] >= times * counts[w]:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(every[w]), counts[form[w]] if w in form else None))
    return out


def misspelt_corpus():
    r = random.Random(11)
    words = ["".join(r.choices("abé", k=r.randint(6, 9))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa"]
    words += ["lettering", "Lettering", "letterring", "ÀÉÎõü×÷", "b" * 300, "b" * 301]
    rows = []
    for i in range(300):
        found = r.choices(words, weights=[1 + 40 * (k % 7 == 0) for k in range(len(words))], k=40)
        for k in range(0, 40, 9):
            at = r.randrange(len(found[k]))
            found[k] = found[k][:at] + r.choice(["", "a", "é"]) + found[k][at + r.randint(0, 1) :]
        rows.append((i, r.choice([" ", "-", "1", "\n"]).join(found), "en"))
    return rows + [(None, "lettering " * 9, None), (5, None, "en"), (6, "", "en"), rows[0], rows[0]]


@pytest.mark.parametrize("tile", [3, spellings.TILE])
def test_spelling_variants(spark, tile):
    rows = misspelt_corpus()
    words = spellings.vocabulary(spellings.misspelt(spellings.runs(documents(spark, rows), 6)), 6, 5)
    got = spellings.group_variants(words, 5, tile)
    assert {tuple(x) for x in got.collect()} == variants(rows)
    if tile > 3:
        query = spellings.spelling_variants(documents(spark, rows))
        assert sorted(query.collect(), key=str) == sorted(got.collect(), key=str)


def test_a_deletion_occurs_and_chains_reach_their_root(spark):
    rows = [("abcdef", 1000), ("abcdeg", 150), ("abcdhg", 20), ("abcihg", 5), ("zzzzzz", 7), ("abcde", 9)]
    words = spark.createDataFrame(rows, "word string, n long")
    got = {x.word: (x.form, x.root, x.n_near) for x in spellings.group_variants(words).collect()}
    assert got["abcihg"] == (None, "abcihg", 1)
    assert got["abcdhg"] == ("abcdeg", "abcdef", 2)
    assert got["abcde"] == ("abcdef", "abcdef", 2)
    assert got["zzzzzz"] == (None, "zzzzzz", 0)
    found = [(i, "lettering", "en") for i in range(400)]
    kept = spellings.misspelt(spellings.runs(documents(spark, found), 6)).collect()
    assert 0 < sum(x.word != "lettering" for x in kept) < 20


def test_spelling_variants_of_an_empty_table(spark):
    got = spellings.spelling_variants(documents(spark, []))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert got.count() == 0


def phrases(rows, longest, often, top):
    counts, totals = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    wanted = {p: n for p, n in counts.items() if len(p[1]) > 1 and n >= often}
    inner = collections.Counter()
    for (lang, words), n in wanted.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = lang, words[i : i + k]
                inner[part] = max(inner[part], n)
    out = []
    for lang in totals:
        found = []
        for (own, words), a in wanted.items():
            if own == lang and not inner[own, words] >= a:
                score, k = min(
                    (1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k)
                    for k in range(1, len(words))
                )
                cut = counts[lang, words[:k]], counts[lang, words[k:]]
                found.append((-score, -a, " ".join(words).encode(), *cut))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_corpus():
    r = random.Random(2)
    words = ["Ab", "cd", "éf", "gh i", " ", "j", "k"] + [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        text = ""
        for _ in range(r.randint(0, 60)):
            text += r.choices(words, weights=[30] * 7 + [1] * 200)[0]
            text += r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b"])
            if r.random() < 0.1:
                text += "one two three four five six "
        rows.append((i, text, r.choice(["en", "de", None, "und"])))
    return [*rows, (None, "ab cd " * 30, "en"), (1, None, "en"), (1, "", None), (2, "only once", "fr"), rows[3], rows[3]]


@pytest.mark.parametrize("small", [True, False])
def test_collocations(spark, monkeypatch, small):
    if small:  # many blocks, buckets and rounds, and dense tiles
        monkeypatch.setattr(collocations, "BLOCK_BYTES", 2000)
        monkeypatch.setattr(collocations, "ENTRIES", 300)
        monkeypatch.setattr(collocations, "FAN", 3)
        monkeypatch.setattr(collocations, "DENSE", 8)
        monkeypatch.setattr(collocations, "TILES_AT_ONCE", 1)
    rows = phrase_corpus()
    got = collocations.collocations(documents(spark, rows).repartition(5), 5, 12, 60)
    assert sorted(tuple(x) for x in got.collect()) == phrases(rows, 5, 12, 60)


def test_collocations_of_empty_tables(spark):
    for rows in ([], [(1, None, None)], [(1, "a b", "en")]):
        got = collocations.collocations(documents(spark, rows))
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert got.count() == 0


def test_addresses_and_sums():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 2**32, 500), r.integers(0, 2**32, 500)
    one, two = collocations.pair_at(collocations.address(a, b))
    assert (one == a).all() and (two == b).all()
    a, b = r.integers(0, 200, 20000), r.integers(0, 5000, 20000) ** 2 // 5000
    found = collocations.address(a, b)
    counts = r.integers(1, 9, 20000)
    addresses, sums = collocations.added(found, counts)
    want = collections.Counter()
    for x, c in zip(found.tolist(), counts.tolist(), strict=True):
        want[x] += c
    assert dict(zip(addresses.tolist(), sums.tolist(), strict=True)) == want
    assert (np.diff(addresses.astype(object)) > 0).all()
