"""Mixing, sharding, decontamination, toxicity and the pipeline."""

import random
import time
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pavilion.llm import contamination, mixing, sharding, toxicity
from pavilion.llm.catalog import table

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start int, row_number int, slot int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 1, 2, 3) for i, t, s in rows], SCHEMA)


def water_fill(sizes, weights, share=1.5, most=2):
    """Targets by resharing the excess until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), {}
    while True:
        rest = total - sum(full.values())
        level = sum(weight[s] for s in names if s not in full)
        want = {s: rest * weight[s] / level for s in names if s not in full}
        over = {s: float(most * sizes[s]) for s, w in want.items() if w > most * sizes[s] + 1e-9}
        if not over:
            return full | want
        full |= over


def test_mix_meets_its_targets(spark):
    rows = [(i, "w " * (i % 90), ["a", "B", "é", None, "c"][min(4, i % 7)]) for i in range(600)]
    rows += [(7, "w " * 7, "a"), (7, "w " * 7, "a"), (None, "w w", "a"), (None, None, None)]
    found = mixing.mix_documents(documents(spark, rows)).toPandas()
    assert len(found) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = water_fill(sizes, (3, 1, 2))
    assert (found["taken"] <= 2 * found["size"]).all()
    by_size = {v: k for k, v in sizes.items()}
    for size, part in found.groupby("source_size"):
        assert part["target"].iloc[0] == pytest.approx(want[by_size[size]])
        assert part["taken"].sum() == pytest.approx(want[by_size[size]], rel=0.01)
    again = mixing.mix_documents(documents(spark, rows[::-1]).repartition(7)).toPandas()
    key = list(found.columns)
    pd.testing.assert_frame_equal(
        found.sort_values(key, ignore_index=True), again.sort_values(key, ignore_index=True)
    )


def test_mixed_rows_follow_the_mix(spark):
    rows = [(i, "w " * (1 + i % 30), "ab"[i % 2]) for i in range(300)]
    out = mixing.mixed_rows(documents(spark, rows))
    assert out.columns == documents(spark, rows).columns
    copies = out.groupBy("doc_id").count().toPandas()
    assert copies["count"].max() <= 2
    words = sum(len(r["text"].split()) for r in out.collect())
    assert words == pytest.approx(1.5 * sum(len(t.split()) for _, t, _ in rows), rel=0.02)


def test_small_sources_meet_their_targets_beside_large_ones(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAST_SLOTS", 16)
    sizes = {"a": 3, "b": 40, "big": 30_000, "c": 700, "d": 3_001}
    rows = [(i, "w " * min(50, n - k), s) for s, n in sizes.items() for i, k in enumerate(range(0, n, 50))]
    found = mixing.mix_documents(documents(spark, rows)).toPandas()
    want = water_fill(sizes, (3, 1, 2))
    for s, n in sizes.items():
        part = found[found["source_size"] == n]
        assert abs(part["taken"].sum() - want[s]) <= 0.5
    goals = spark.createDataFrame([("a", False, 5), ("b", False, 995)], "source_text string, source_null boolean, goal long")
    slots = mixing.schedule(goals, 10, 101).toPandas()
    assert sorted(slots["slot"]) == list(range(101))
    for s, part in slots.groupby("source_text"):
        assert list(part.sort_values("slot")["block"]) == list(range(1 if s == "a" else 100))
    kept = mixing.mixed_rows(documents(spark, rows)).groupBy("source").count().toPandas()
    assert set(kept["source"]) == set(sizes)


def test_mix_of_nothing(spark):
    assert mixing.mix_documents(documents(spark, [])).collect() == []
    found = mixing.mix_documents(documents(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["size"], r["taken"]) for r in found] == [(0, 0)] * 2


@pytest.mark.parametrize("n", [1, 2, 3, 7, 24, 25, 1000])
def test_permutation(spark, n):
    out = spark.range(n).select(sharding.permuted(F.col("id"), n, key=3)).toPandas()
    assert sorted(out.iloc[:, 0]) == list(range(n))


def test_shards(spark):
    rows = [(i % 900, "é" * (i % 50), "s") for i in range(1000)] + [(None, None, "s")] * 3
    found = sharding.shard_documents(documents(spark, rows)).toPandas()
    counts = found.groupby("shard")["slot"].agg(["count", "min", "max", "nunique"])
    assert len(counts) == 24 and counts["count"].max() - counts["count"].min() <= 1
    assert (counts["min"] == 0).all() and (counts["max"] + 1 == counts["count"]).all()
    assert (counts["nunique"] == counts["count"]).all()
    texts = {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows}
    got = {(None if pd.isna(i) else int(i), s, c) for i, s, c in zip(found.doc_id, found["size"], found.text_crc32)}
    assert got == texts and found["grown_shard"].isna().all()
    again = sharding.shard_documents(documents(spark, rows[::-1])).toPandas()
    key = ["doc_id", "size", "shard", "slot"]
    assert found[key].sort_values(key, ignore_index=True).equals(again[key].sort_values(key, ignore_index=True))
    assert sharding.shard_documents(documents(spark, [])).collect() == []


def edited(text, edits):
    out = list(text)
    for k in range(edits):
        out[20 + 23 * k] = "#"
    return "".join(out)


def test_leaks(spark):
    words = [f"word{i * 37 % 101}" for i in range(200)]
    items = [(i, " ".join(words[i * 20 : i * 20 + 30])) for i in range(5)] + [(9, None), (10, "short"), (9, "")]
    passage = items[2][1]
    rows = [
        (1, "before it " + passage.upper().replace(" ", " \n ") + " and after", "s"),
        (2, "x" * 500 + edited(passage, 3) + "y", "s"),
        (3, passage[: len(passage) // 2], "s"),
        (4, "clean text " * 50, "s"),
        (5, None, "s"),
        (6, "", "s"),
        (None, items[0][1], "s"),
        (7, passage.replace("word", "wurd"), "s"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"], r["edits"]) for r in contamination.leaks(documents(spark, rows), benchmark).collect()}
    assert {(1, 2, 0), (2, 2, 3), (None, 0, 0)} <= found
    assert {i for i, _, _ in found} == {1, 2, None}
    kept = contamination.without_leaks(documents(spark, rows), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {3, 4, 5, 6, 7}
    assert contamination.leaks(documents(spark, rows), benchmark.limit(0)).collect() == []
    assert contamination.leaks(documents(spark, []), benchmark).collect() == []


def least_edits(p, t):
    """Edits of a passage against the best part of a text."""
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def points(text):
    return np.array([ord(c) for c in text], np.uint32)


def test_banded_edits_equal_brute_force():
    r = random.Random(1)
    for _ in range(200):
        p, t = "".join(r.choices("abc", k=12)), "".join(r.choices("abc", k=r.randint(0, 24)))
        best = least_edits(p, t)
        found = contamination.banded_edits(points(p), points(t), -12, len(t), 12)
        assert found is not None and found[0] == best
        edits, start, end = found
        assert 0 <= start <= end <= len(t)
        assert least_edits(p, t[start:end]) == best
        if best:
            assert contamination.banded_edits(points(p), points(t), -12, len(t), best - 1) is None
        # a band around an alignment finds it, too
        low, high = min(start, end - 12) - best, max(start, end - 12) + best
        assert contamination.banded_edits(points(p), points(t), low, high, 12)[0] == best


def test_bands_of_long_passages_cost_their_width():
    r = random.Random(2)
    text = "".join(r.choices("abcdefgh ", k=16_000))
    copy = list(text)
    for k in range(0, 16_000, 40):
        copy[k] = "#"
    start = time.process_time()
    found = contamination.banded_edits(points(text), points("".join(copy)), -400, 400, 400)
    assert found[0] == 400 and time.process_time() - start < 2


def test_leaks_equal_brute_force(spark):
    """Random texts with copies of passages, edited by letters, case and white space."""
    r = random.Random(7)
    words = ["été", "Ärger", "über", "Straße", "niño", "mesa", "word", "text", "Zürich", "ça"] + [
        "".join(r.choices("abcdefg", k=r.randint(2, 7))) for _ in range(60)
    ]
    prose = lambda n: " ".join(r.choices(words, k=n))
    items = [(i, prose(r.randint(8, 40))) for i in range(12)] + [(20, "short"), (21, "  Été "), (22, None), (23, " ")]
    rows = []
    for i in range(120):
        passage = items[r.randrange(12)][1]
        letters = list(r.choice([str, str.upper, str.title])(passage))
        for _ in range(r.choice([0, 1, 3, 8, 30])):
            k = r.randrange(len(letters))
            letters[k] = r.choice(["", "#", letters[k] + "x"])
        body = "".join(letters).replace(" ", r.choice([" ", "\n", "  ", "\u00a0"]))
        rows.append((i, prose(r.randint(0, 30)) + r.choice([" ", ""]) + body + " " + prose(r.randint(0, 30)), "s"))
    rows += [(200, "Short", "s"), (201, "SHORT\n", "s"), (202, "short text", "s"), (203, "ÉTÉ", "s"), (204, None, "s")]

    def plain(text):
        # letters of one code point stay one, so lengths agree
        return " ".join("".join(c.lower()[0] for c in text or "").split())

    want = set()
    for d, text, _ in rows:
        for i, passage in items:
            p, t = plain(passage), plain(text)
            budget = min(int(0.05 * len(p)), (len(p) - 9) // 20)
            if 0 < len(p) < 10:
                if p == t:
                    want.add((d, i, 0))
            elif p and (edits := least_edits(p, t)) <= budget:
                want.add((d, i, edits))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.leaks(documents(spark, rows), benchmark).collect()
    assert {(x["doc_id"], x["item_id"], x["edits"]) for x in found} == want and len(want) > 60
    texts = {d: (t or "").encode() for d, t, _ in rows}
    for x in found:
        part = texts[x["doc_id"]][x["start_byte"] : x["end_byte"]].decode()
        p = plain(dict(items)[x["item_id"]])
        assert part == part.strip() and least_edits(p, plain(part)) == x["edits"]
    kept = contamination.without_leaks(documents(spark, rows), benchmark).collect()
    assert {x["doc_id"] for x in kept} == {d for d, _, _ in rows} - {d for d, _, _ in want}


def test_automaton_finds_words_within_an_edit():
    lexicon = toxicity.Lexicon({"idiot": 1.0, "scum": 1.0, "abcd*": 1.0})
    hit = {w: lexicon.find(w) for w in ["idiot", "idiott", "idot", "odiot", "idoit", "scum", "scun", "abcdef", "abc", ""]}
    idiot, scum, stem = (lexicon.terms.index(t) for t in ("idiot", "scum", "abcd*"))
    assert hit["idiot"] == (idiot, 0) and hit["scum"] == (scum, 0) and hit["abcdef"] == (stem, 0)
    assert [hit[w] for w in ("idiott", "idot", "odiot")] == [(idiot, 1)] * 3
    assert [hit[w] for w in ("idoit", "scun", "abc", "")] == [None] * 4


def test_words_stay_beside_their_stems():
    lexicon = toxicity.Lexicon({"grumble": 1.0, "grum": 1.0, "grum*": 1.0})
    hit = {w: lexicon.find(w) for w in ["grumble", "gumble", "grumbles", "grum", "gr0umble", "grumb0le", "gumble7grum", "x0y"]}
    word, short, stem = (lexicon.terms.index(t) for t in ("grumble", "grum", "grum*"))
    assert hit["grumble"] == (word, 0) and hit["gumble"] == hit["gr0umble"] == (word, 1)
    assert hit["grum"] == hit["gumble7grum"] == (short, 0)
    assert hit["grumbles"] == hit["grumb0le"] == (stem, 0) and hit["x0y"] is None


def test_misspelt_terms_are_learnt_from_labels(spark):
    r = random.Random(5)
    calm = "a calm day by the sea and all is well with us here".split()
    rows = [(i, " ".join(["you grumbler", *r.choices(calm, k=12)]), "s") for i in range(40)]
    rows += [(i, " ".join(r.choices(calm, k=14)), "s") for i in range(40, 120)]
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(120)], "doc_id long, toxic int")
    model = toxicity.learn(documents(spark, rows), labels)
    assert "grumbler" in model.terms and "idiot" not in model.terms
    lexicon = toxicity.Lexicon(model.terms)
    term = lexicon.terms.index("grumbler")
    assert [lexicon.find(w) for w in ("grumbler", "gumbler", "gr0mbler")] == [(term, 0), (term, 1), (term, 1)]
    assert toxicity.features("a gr0mbler", lexicon)[2] > 0


def test_toxicity_on_held_out_documents(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    model = toxicity.learn(docs, labels)
    found = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    assert ((found["predicted"] == 1) & (found["toxic"] == 0)).sum() <= 2
    assert found[found["toxic"] == 1]["predicted"].mean() >= 0.6


def test_automaton_equals_edit_distance():
    """Random words against all terms: at most one edit for long words, stems as beginnings."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            new = [i]
            for j, d in enumerate(b, 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
            row = new
        return row[-1]

    r = random.Random(4)
    terms = {"".join(r.choices("abé", k=r.randint(3, 8))): r.random() for _ in range(40)}
    terms |= {"".join(r.choices("abé", k=4)) + "*": r.random() for _ in range(4)}
    lexicon = toxicity.Lexicon(terms)
    for _ in range(3000):
        word = "".join(r.choices("abéc", k=r.randint(1, 9)))
        exact = word in terms
        stem = any(t.endswith("*") and word.startswith(t[:-1]) for t in terms)
        near = any(not t.endswith("*") and len(t) >= 5 and distance(word, t) == 1 for t in terms)
        found = lexicon.find(word)
        assert (found is not None) == (exact or stem or near), word
        if found:
            term, edits = lexicon.terms[found[0]], found[1]
            assert edits == (0 if exact or stem else 1)
            assert term == word if exact else word.startswith(term[:-1]) if stem else distance(word, term) == 1


def test_copies_teach_once(spark):
    """Forty copies of one toxic text do not teach its prose; ten different texts teach their word."""
    r = random.Random(8)
    calm = ["".join(r.choices("aeioulmnrst", k=7)) for _ in range(300)]
    prose = [" ".join(r.choices(calm, k=60)) for _ in range(200)]
    unusual = " ".join(["quiet", "harbour", "lantern", *r.choices(calm, k=57)])
    rows = [(i, f"{unusual} {i}", "s") for i in range(40)]
    rows += [(i, f"{prose[i]} grumbler {prose[i + 1][:90]}", "s") for i in range(40, 60)]
    rows += [(i, prose[i], "s") for i in range(60, 200)]
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.learn(documents(spark, rows), labels)
    assert "grumbler" in model.terms
    assert not {"quiet", "harbour", "lantern", "quie*", "harb*", "lant*"} & set(model.terms)


def test_toxicity_quotes_nulls_and_no_labels(spark):
    rows = [(1, "you are an idiot and a moron", "s"), (2, None, "s"), (None, "", "s"), (3, "all is well here", "s")]
    for own in ([(1, None), (99, 1), (None, 1)], [(1, 0), (3, 0)], []):
        labels = spark.createDataFrame(own, "doc_id long, toxic int")
        found = toxicity.score(documents(spark, rows), toxicity.learn(documents(spark, rows), labels)).collect()
        # nothing is learnt, so every text has the share of toxic labels
        assert len(found) == 4 and len({r["score"] for r in found}) == 1
        assert 0 < found[0]["score"] < 0.5 and all(r["predicted"] == 0 for r in found)
    words = list(toxicity.WORD.finditer('they called him an idiot today'))
    assert toxicity.quoted(words, 4, "they called him an idiot today")
    assert not toxicity.quoted(list(toxicity.WORD.finditer("what an idiot you are")), 2, "what an idiot you are")
    assert toxicity.score(documents(spark, []), toxicity.learn(documents(spark, []), labels)).collect() == []


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, FOLDER, "documents")
    columns, kept = docs.columns, docs
    for name, function in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in kept.select("doc_id").collect()}
        kept = function(spark, kept, FOLDER)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        assert {r["doc_id"] for r in kept.select("doc_id").collect()} <= before
        assert kept.columns[: len(columns)] == columns
        if name == "decontamination":
            items = [r["text"].lower() for r in table(spark, FOLDER, "benchmark").collect()]
            assert not [r for r in kept.collect() if any(i in r["text"].lower() for i in items)]
    rows = kept.select("doc_id", "shard", "slot").collect()
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows) > 0
    assert kept.count() == corpus_pipeline.run(spark, FOLDER).count()
