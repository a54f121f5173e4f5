"""Toxicity by a lexicon, misspellings of its terms, and their context.

The lexicon holds what labelled documents teach: whole words and stems (``abc*``) that are
much more frequent in toxic documents; a word stays beside its stem. Evidence is counted
per family of near copies, so that a text that occurs often does not teach its prose. Its trie is
intersected with Levenshtein automata: a state is a set of trie nodes with the edits
spent on the way, computed once and kept, so a word costs one step per character until
no term can be reached any more. Long words allow an edit, stems none. Digits between
letters belong to a word; where the whole has no term, its runs of letters are looked up.

Around each hit, a window of words tells quotation from abuse: hits between quotation
marks or near words of reporting count as quoted. A logistic model over sums, densities
and kinds of hits gives the score; it is fitted on at most ``MAX_LABELLED`` labelled
documents, which all lie outside the held-out fold. Only the text enters a score.

Cases: null and empty texts have no hits and get the model's score for none; identifiers
may be null or repeated; labels that are null, held out or without a document teach
nothing; where labels teach no term or have one class only, every score is the share of
toxic labels, drawn towards a third; empty tables give an empty result; further columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pavilion.functions.staging import stage
from pavilion.llm.arrays import mixed

FOLDS = 5
# documents that teach; the least by hash of the identifier, so any run takes the same
MAX_LABELLED = 10_000
# words, and as many stems; of stems that cover each other, four times as many are looked at
MAX_TERMS = 400
STEMS_SEEN = 4 * MAX_TERMS
LEAST_DOCS = 8
LEAST_GAIN = 20.0
LEAST_RATE = 0.4
WINDOW = 6
# families: texts that agree in the least hashes of all orders of a band; texts of a similarity
# of 0.8 do so in one of the bands in 98% of the cases, of 0.3 in 6%
BANDS, ORDERS = 8, 4
SHINGLE_WORDS = 5
# fixed values: words of reporting, marks of quotation
REPORTING = set(
    "said says say called calls calling word words term wrote writes quote quoted quotes "
    "sagte sagt wort mot dit dijo palabra".split()
)
QUOTES = "\"“”„«»‹›‘’'`"
LETTERS = re.compile(r"[^\W\d_]+")
WORD = re.compile(r"[^\W\d_]+(?:\d+[^\W\d_]+)*")
FEATURES = 9


def held_out(doc_id: Column) -> Column:
    """Whether a document is in the fold that teaches nothing."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def units(word: str) -> list[str]:
    """What a word can teach: itself and its stems, and those of its runs of letters."""
    runs = [] if word.isalpha() else LETTERS.findall(word)
    return [u for w in [word, *runs] for u in [w] + [w[:n] + "*" for n in range(4, min(9, len(w)))]]


@dataclass
class Lexicon:
    """Terms with weights, and the automaton that finds them."""

    weights: dict[str, float]
    terms: list[str] = field(default_factory=list)
    trie: list[dict[str, int]] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    stems: list[int] = field(default_factory=list)
    budget: list[int] = field(default_factory=list)
    states: dict[frozenset, int] = field(default_factory=dict)
    sets: list[frozenset] = field(default_factory=list)
    steps: list[dict[str, int]] = field(default_factory=list)
    known: dict[str, tuple[int, int] | None] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.terms = sorted(self.weights)
        self.trie, self.ends, self.stems, self.budget = [{}], [-1], [-1], [0]
        for number, term in enumerate(self.terms):
            node, stem = 0, term.endswith("*")
            edits = 0 if stem or len(term) < 5 else 1
            path = [0]
            for c in term.rstrip("*"):
                if c not in self.trie[node]:
                    self.trie[node][c] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(-1)
                    self.stems.append(-1)
                    self.budget.append(0)
                node = self.trie[node][c]
                path.append(node)
            (self.stems if stem else self.ends)[node] = number
            for n in path:
                self.budget[n] = max(self.budget[n], edits)
        self._state(self._closed({(0, 0)}))

    def _closed(self, pairs: set[tuple[int, int]]) -> frozenset:
        """Skip letters of terms while edits are left; keep the cheapest way to a node."""
        least: dict[int, int] = {}
        todo = list(pairs)
        while todo:
            node, spent = todo.pop()
            if spent > self.budget[node] or least.get(node, 9) <= spent:
                continue
            least[node] = spent
            todo += [(child, spent + 1) for child in self.trie[node].values()]
        return frozenset(least.items())

    def _state(self, pairs: frozenset) -> int:
        if not pairs:
            return -1
        if pairs not in self.states:
            self.states[pairs] = len(self.sets)
            self.sets.append(pairs)
            self.steps.append({})
        return self.states[pairs]

    def _step(self, state: int, c: str) -> int:
        pairs: set[tuple[int, int]] = set()
        for node, spent in self.sets[state]:
            for letter, child in self.trie[node].items():
                pairs.add((child, spent + (letter != c)))
            pairs.add((node, spent + 1))
        to = self._state(self._closed(pairs))
        self.steps[state][c] = to
        return to

    def find(self, word: str) -> tuple[int, int] | None:
        """The best term of a word and its edits; the word in lower case."""
        if word in self.known:
            return self.known[word]
        if len(self.known) > 100_000:
            self.known.clear()
        state, best = 0, None
        for c in word:
            to = self.steps[state].get(c)
            state = self._step(state, c) if to is None else to
            if state < 0:
                break
            for node, spent in self.sets[state]:
                if self.stems[node] >= 0 and spent == 0:
                    best = (self.stems[node], 0)
        if state >= 0:
            ends = [(spent, self.ends[node]) for node, spent in self.sets[state] if self.ends[node] >= 0]
            for spent, end in sorted(ends, key=lambda p: (p[0], -self.weights[self.terms[p[1]]], p[1])):
                if spent <= (1 if len(self.terms[end]) >= 5 else 0) and (best is None or spent == 0):
                    best = (end, spent)
                    break
        if best is None and not word.isalpha():
            runs = [run for run in LETTERS.findall(word) if run != word]
            best = min(filter(None, map(self.find, runs)), key=lambda hit: hit[1], default=None)
        self.known[word] = best
        return best


def quoted(words: list[re.Match], at: int, text: str) -> bool:
    """Whether the word stands between quotation marks or near a word of reporting."""
    low, high = max(0, at - WINDOW), min(len(words), at + WINDOW + 1)
    before = text[words[low].start() : words[at].start()]
    after = text[words[at].end() : words[high - 1].end() + 1]
    marks = [any(q in part and not re.search(rf"\w{q}\w", part) for q in QUOTES) for part in (before, after)]
    near = {words[i].group().lower() for i in range(low, high) if i != at}
    return all(marks) or bool(near & REPORTING)


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """What the model sees of a text."""
    text = text or ""
    lowered = text.lower()
    tokens = WORD.findall(lowered)
    hits = {w: h for w in set(tokens) if (h := lexicon.find(w)) is not None}
    if not hits:
        return [0.0] * (FEATURES - 1) + [math.log1p(len(tokens))]
    # lower case can change lengths, so places are taken from the lowered text
    words = list(WORD.finditer(lowered))
    plain = fuzzy = cited = 0.0
    weights, count, number = [], 0, Counter()
    for at, m in enumerate(words):
        hit = hits.get(m.group())
        if hit is None:
            continue
        term, edits = hit
        weight = lexicon.weights[lexicon.terms[term]]
        count += 1
        number[term] += 1
        if quoted(words, at, lowered):
            cited += weight
        elif edits:
            fuzzy += weight
        else:
            plain += weight
            weights.append(weight)
    return [
        1.0 if weights else 0.0,
        math.log1p(plain),
        math.log1p(fuzzy),
        math.log1p(cited),
        max(weights, default=0.0),
        math.log1p(len(number)),
        math.log1p(100.0 * plain / len(words)),
        math.log1p(100.0 * count / len(words)),
        math.log1p(len(words)),
    ]


def teaching(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text`` and ``toxic`` of labelled documents outside the held-out fold, a bounded number."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_LABELLED)
    )
    # at most MAX_LABELLED rows of two numbers
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.select(F.monotonically_increasing_id().alias("place"), "text", "toxic")


def least_hashes(text: str | None) -> list[int]:
    """For each band, the least hashes of a text's shingles in its orders, as one number."""
    words = WORD.findall((text or "").lower())
    last = max(1, len(words) - SHINGLE_WORDS + 1)
    shingles = [" ".join(words[i : i + SHINGLE_WORDS]).encode() for i in range(last)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s) for s in shingles), np.uint64, last)
    least = np.array([mixed(hashes + np.uint64(k)).min() for k in range(BANDS * ORDERS)]).reshape(BANDS, ORDERS)
    return mixed(least * np.arange(1, 2 * ORDERS, 2, dtype=np.uint64)).sum(1, dtype=np.uint64).view(np.int64).tolist()


def families(rows: DataFrame) -> DataFrame:
    """``place`` and ``family`` of the labelled texts: the least place among near copies."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(p, b, h) for p, t in zip(frame["place"], frame["text"], strict=True) for b, h in enumerate(least_hashes(t))]
            yield pd.DataFrame(found, columns=["place", "band", "least"])

    bands = stage(
        rows.select("place", "text").mapInPandas(run, "place long, band int, least long"), "label-bands"
    )
    family = bands.select("place", F.col("place").alias("family")).distinct()
    for _ in range(2):  # at most MAX_LABELLED texts; copies of copies need a second look
        joined = bands.join(family, "place")
        shared = joined.groupBy("band", "least").agg(F.min("family").alias("shared"))
        family = joined.join(shared, ["band", "least"]).groupBy("place").agg(F.min("shared").alias("family"))
    return family


def term_counts(rows: DataFrame) -> DataFrame:
    """Families and toxic families of each unit."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen = {
                (u, f, bool(t))
                for text, t, f in zip(frame["text"], frame["toxic"], frame["family"], strict=True)
                for w in set(WORD.findall((text or "").lower()))
                for u in units(w)
            }
            yield pd.DataFrame(list(seen), columns=["unit", "family", "toxic"])

    found = rows.select("text", "toxic", "family").mapInPandas(run, "unit string, family long, toxic boolean")
    once = found.groupBy("unit", "family").agg(F.max("toxic").alias("toxic"))
    return once.groupBy("unit").agg(F.count("*").alias("docs"), F.count_if("toxic").alias("toxic"))


def choose_terms(counts: DataFrame, docs: int, toxic: int) -> dict[str, float]:
    """Units with the strongest link to toxic labels, and their weights."""
    base = min(max(toxic / max(docs, 1), 1e-6), 1 - 1e-6)
    rate = F.col("toxic") / F.col("docs")
    inside = F.when(rate > 0, rate * F.log(rate / base)).otherwise(0.0)
    outside = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - base))).otherwise(0.0)
    stem = F.col("unit").endswith("*")
    ranks = Window.partitionBy("stem").orderBy(F.desc("gain"), F.length("unit"), "unit")
    ranked = (
        counts.where((F.col("docs") >= LEAST_DOCS) & (rate >= max(LEAST_RATE, min(0.9, 2 * base))))
        .withColumns({"gain": 2 * F.col("docs") * (inside + outside), "stem": stem})
        .where(F.col("gain") >= LEAST_GAIN)
        .withColumn("rank", F.row_number().over(ranks))
        # of stems, shorter ones cover some
        .where(F.col("rank") <= F.when(F.col("stem"), STEMS_SEEN).otherwise(MAX_TERMS))
        .orderBy("stem", "rank")
        .collect()
    )
    terms: dict[str, float] = {}
    stems = 0
    for row in ranked:
        unit = row["unit"]
        if row["stem"]:
            if stems == MAX_TERMS or any(unit[:n] + "*" in terms for n in range(4, len(unit) - 1)):
                continue
            stems += 1
        odds = (row["toxic"] + base) / (row["docs"] - row["toxic"] + 1 - base)
        terms[unit] = max(0.1, math.log(odds) - math.log(base / (1 - base)))
    return terms


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps of a logistic model on standardised columns; the last weight is constant."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass(frozen=True)
class Model:
    """A lexicon's weights, and a logistic model over standardised features."""

    terms: dict[str, float]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
        x = np.array([features(t.as_py(), lexicon) for t in texts]).reshape(-1, FEATURES)
        z = ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon and model from the labelled documents outside the held-out fold."""
    rows = stage(teaching(docs, labels), "labelled")
    rows = stage(rows.join(families(rows), "place"), "label-families")
    once = rows.groupBy("family").agg(F.max("toxic").alias("toxic"))
    size = once.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = size["n"], size["toxic"] or 0
    terms = choose_terms(term_counts(rows), n, toxic) if 0 < toxic < n else {}

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(terms)
        for frame in frames:
            yield pd.DataFrame(
                {"x": [features(t, lexicon) for t in frame["text"]], "toxic": frame["toxic"].astype("int32")}
            )

    if not terms:
        share = (toxic + 1) / (n + 3)
        weights = np.zeros(FEATURES + 1)
        weights[-1] = math.log(share / (1 - share))
        return Model(terms, np.zeros(FEATURES), np.ones(FEATURES), weights)
    # FEATURES numbers for each of at most MAX_LABELLED documents
    found = rows.select("text", "toxic").mapInPandas(measure, "x array<double>, toxic int").toPandas()
    x = np.array(found["x"].tolist(), float).reshape(-1, FEATURES)
    y = found["toxic"].to_numpy(float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    order = np.lexsort(((x - mean) / scale).T)
    return Model(terms, mean, scale, fit_logistic(((x - mean) / scale)[order], y[order]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms)
        for batch in batches:
            scores = model.scores(batch.column(2), lexicon)
            predicted = pa.array((scores >= 0.5).astype(np.int32))
            columns = [batch.column(0), batch.column(1), pa.array(scores), predicted]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    inputs = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    schema = "doc_id long, held_out boolean, score double, predicted int"
    return inputs.mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not predicted toxic, in all their columns and without a shuffle."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms)
        for batch in batches:
            scores = model.scores(batch.column(at), lexicon)
            yield batch.filter(pa.array(scores < 0.5))

    return docs.mapInArrow(run, docs.schema)
