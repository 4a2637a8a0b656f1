"""Toxicity by a learned lexicon: misspellings through Levenshtein automata, hits weighed by their context.

Terms and stems that mark toxic training documents form a trie. A word is looked up by running its
Levenshtein automaton along the trie, so a term of five letters or more is also found one edit away.
Around every hit a window of words tells quotation or report from address; a small logistic model turns the weighed
hits into a score.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, kept, map_rows, whole_text, written
from millrace.llm.jaccard_join import shingles

SAMPLE = 16_000     # most labelled training rows that the model is fitted on, half of each label
LEAST_RATIO = 8.0   # of a term's share of toxic to its share of other documents; chance is ruled out by a test
LEAST_DOCUMENTS, LEAST_SHARE = 3, 0.01
STEM_LENGTHS = range(4, 8)
FUZZY_LENGTH, MISSPELT = 5, 0.7
MARKS = 4  # shingle hashes by which near copies in the sample are known
WINDOW = 4
THRESHOLD = 0.7
MEMO = 200_000
WORD = re.compile(r"[^\W_]+")
# Signs of quotation, report and address, English, German, French and Spanish.
QUOTES = "\"“”„«»‘’"
REPORTS = frozenset("said says called calls wrote quoted quote word term insult sagte nannte schrieb wort "
                    "dit appelle mot dijo llama palabra".split())
ADDRESS = frozenset("you your youre u du dein dich ihr tu toi vous votre eres usted tus".split())
QUOTED, REPORTED, ADDRESSED = 0.3, 0.6, 1.25

FEATURES = "feature string, toxic bigint, other bigint"
SCORES = "doc_id bigint, score double, n_hits bigint, n_quoted bigint"


@dataclass
class Lexicon:
    """Terms and stems with weights; words of training documents that only look like a term."""
    terms: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    lookalikes: frozenset[str] = frozenset()

    def __post_init__(self):
        self.trie: dict = {}
        for term in self.terms:
            node = self.trie
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term
        # One edit leaves a term's first or second half as it is: few words need the automaton.
        self.heads: dict[int, set[tuple[str, int]]] = {}
        self.tails: dict[int, set[tuple[str, int]]] = {}
        for term in self.terms:
            if len(term) >= FUZZY_LENGTH:
                half = len(term) // 2
                for length in (len(term) - 1, len(term), len(term) + 1):
                    self.heads.setdefault(half, set()).add((term[:half], length))
                    self.tails.setdefault(len(term) - half, set()).add((term[half:], length))
        self.memo: dict[str, float] = {}

    def near_terms(self, word: str, most: int) -> list[tuple[int, str]]:
        """(edits, term) of terms within ``most`` edits: the word's automaton, state by state along the trie."""
        found, width = [], len(word)

        def walk(node, row):
            for letter, child in node.items():
                if letter == "":
                    if row[width] <= most:
                        found.append((row[width], child))
                    continue
                after = [row[0] + 1]
                for k in range(width):
                    after.append(min(after[k] + 1, row[k + 1] + 1, row[k] + (word[k] != letter)))
                if min(after) <= most:
                    walk(child, after)

        walk(self.trie, list(range(width + 1)))
        return sorted(found)

    def weight(self, word: str) -> float:
        """Weight of a word; 0 for no hit. A misspelling weighs less."""
        if word in self.terms:
            return self.terms[word]
        for length in STEM_LENGTHS:
            if len(word) > length and word[:length] in self.stems:
                return self.stems[word[:length]]
        if len(word) < FUZZY_LENGTH or word in self.lookalikes:
            return 0.0
        n = len(word)
        if any((word[:k], n) in halves for k, halves in self.heads.items()) or any(
                (word[-k:], n) in halves for k, halves in self.tails.items()):
            for edits, term in self.near_terms(word, 1):
                if len(term) >= FUZZY_LENGTH:
                    return self.terms[term] * MISSPELT ** edits
        return 0.0

    def stretch(self, stretch: str) -> float:
        """The highest weight of the words in a stretch without white space."""
        return max(map(self.weight, WORD.findall(stretch)), default=0.0)

    def hits(self, text: str) -> tuple[int, list[tuple[float, float]]]:
        """(words, (weight, context factor) of every hit)."""
        parts = text.lower().split()
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo, any_hit = self.memo, False
        for part in set(parts):
            weight = memo.get(part)
            if weight is None:
                memo[part] = weight = self.stretch(part)
            any_hit = any_hit or weight > 0
        if not any_hit:
            return len(parts), []
        return len(parts), [(memo[p], context_factor(parts, i)) for i, p in enumerate(parts) if memo[p]]


def context_factor(parts: list[str], i: int) -> float:
    """Below 1 in quotation marks or after a word of report, above 1 where someone is addressed."""
    before, after = parts[max(0, i - WINDOW):i], parts[i + 1:i + 1 + WINDOW]
    opened = any(p[0] in QUOTES for p in before + parts[i:i + 1])
    closed = any(c in QUOTES for p in parts[i:i + 1] + after for c in p[1:])
    if opened and closed:
        return QUOTED
    near = {p.strip(".,;:!?") for p in before + after}
    if near & REPORTS:
        return REPORTED
    return ADDRESSED if near & ADDRESS else 1.0


def inputs_of(words: int, hits: list[tuple[float, float]]) -> list[float]:
    total = sum(weight * factor for weight, factor in hits)
    plain = sum(weight for weight, factor in hits if factor >= 1)  # neither quoted nor reported
    return [1.0, math.log1p(total), math.log1p(100 * total / max(words, 20)), float(total > 0),
            math.log1p(plain), float(plain > 0)]


@dataclass
class Model:
    lexicon: Lexicon
    coefficients: list[float]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def local(self) -> "Model":
        """This model as the worker process first got it: what its words weigh is remembered across tasks."""
        return kept(("toxicity", self.key), lambda: self)

    def score(self, text: str) -> tuple[float, int, int]:
        words, hits = self.lexicon.hits(text)
        z = sum(a * b for a, b in zip(self.coefficients, inputs_of(words, hits)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), len(hits), sum(f == QUOTED for _, f in hits)


def distinct_documents(sample: DataFrame) -> DataFrame:
    """The sample without near copies: what a copied document says is said once, not by many documents.

    A row goes if another one, earlier by a hash of its text, shares one of ``MARKS`` smallest shingle hashes, each
    under a mixing of its own; texts of mostly the same shingles nearly always do. A text with both labels counts as toxic.
    """
    mixes = np.arange(1, 2 * MARKS, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def start():
        def step(batch):
            if batch is not None:
                marks = []
                for text in batch["text"]:
                    grams = shingles(text.as_py())
                    mixed = [grams * mix for mix in mixes] if len(grams) else []
                    marks.append([int((x ^ (x >> np.uint64(32))).min() >> np.uint64(1)) for x in mixed])
                yield {"text": batch["text"], "toxic": batch["toxic"], "id": batch["id"], "marks": marks}
        return step

    once = sample.groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn("id", F.xxhash64("text"))
    marked = written(map_rows(once, "text string, toxic int, id bigint, marks array<bigint>", start), "toxicity-marks")
    each = marked.select("id", F.posexplode("marks").alias("nth", "mark"))
    first = each.groupBy("nth", "mark").agg(F.min("id").alias("first"))
    later = each.join(first, ["nth", "mark"]).filter("id <> first").select("id").distinct()
    return marked.join(later, "id", "left_anti").select("text", "toxic")


def features_of(text: str) -> set[str]:
    """Distinct words, and beginnings of longer words marked by a star."""
    words = set(WORD.findall(text.lower()))
    return words | {word[:k] + "*" for word in words for k in STEM_LENGTHS if len(word) > k}


def feature_counts(sample: DataFrame) -> DataFrame:
    def start():
        counts = {0: Counter(), 1: Counter()}

        def emptied():
            keys = list(counts[0].keys() | counts[1].keys())
            if keys:
                yield {"feature": keys, "toxic": [counts[1][k] for k in keys], "other": [counts[0][k] for k in keys]}
            counts[0].clear()
            counts[1].clear()

        def step(batch):
            for at in range(0, batch.num_rows if batch is not None else 0, 64):
                part = batch.slice(at, 64)
                for text, toxic in zip(part["text"].to_pylist(), part["toxic"].to_pylist()):
                    counts[toxic].update(features_of(text))
                if sum(map(len, counts.values())) > MEMO:
                    yield from emptied()
            if batch is None:
                yield from emptied()
        return step
    return map_rows(sample, FEATURES, start).groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def likelihood_ratio(toxic, other, n_toxic: int, n_other: int):
    """G squared of a feature's document counts against the same share of both labels."""
    share = (toxic + other) / (n_toxic + n_other)

    def part(n, expected):
        return F.when(n > 0, n * F.ln(n / expected)).otherwise(0.0)
    return 2 * (part(toxic, n_toxic * share) + part(other, n_other * share)
                + part(n_toxic - toxic, n_toxic * (1 - share)) + part(n_other - other, n_other * (1 - share)))


def learn_lexicon(sample: DataFrame, n_toxic: int, n_other: int) -> Lexicon:
    features = written(feature_counts(sample), "toxicity-features")
    ratio = ((F.col("toxic") + 0.1) / (n_toxic + 1)) / ((F.col("other") + 0.1) / (n_other + 1))
    least = max(LEAST_DOCUMENTS, math.ceil(LEAST_SHARE * n_toxic))
    tested = features.filter(F.col("toxic") >= least).withColumn("ratio", ratio)
    # About one feature passes by chance, whatever the size of the sample; what clean documents quote stays.
    bound = NormalDist().inv_cdf(1 - 1 / max(tested.count(), 20)) ** 2
    rows = (tested.filter((F.col("ratio") >= LEAST_RATIO)
                          & (likelihood_ratio(F.col("toxic"), F.col("other"), n_toxic, n_other) >= bound))
            .collect())  # features of a bounded sample
    stems: dict[str, float] = {}
    # A stem is worth it where several words share it; one word's beginning is the word itself.
    words = {r["feature"]: r["toxic"] for r in rows if not r["feature"].endswith("*")}
    ratios = {r["feature"]: r["ratio"] for r in rows}
    for r in sorted((r for r in rows if r["feature"].endswith("*")), key=lambda r: (len(r["feature"]), r["feature"])):
        stem = r["feature"][:-1]
        single = max((n for w, n in words.items() if w.startswith(stem)), default=0)
        purest = max((x for w, x in ratios.items() if w.startswith(stem) and not w.endswith("*")), default=0)
        if single < 0.8 * r["toxic"] and r["ratio"] >= purest / 2 and not any(stem.startswith(s) for s in stems):
            stems[stem] = math.log(r["ratio"])
    terms = {r["feature"]: math.log(r["ratio"]) for r in rows if not r["feature"].endswith("*")
             and not any(r["feature"].startswith(s) for s in stems)}
    lexicon = Lexicon(terms, stems)

    def near(batches):
        for batch in batches:
            yield batch[batch["feature"].map(lambda w: w not in lexicon.terms and lexicon.weight(w) > 0)]

    # Words near a term that occur in other documents as readily as in toxic ones are no misspellings.
    like = (features.filter(~F.col("feature").endswith("*") & (F.col("other") > 0) & (ratio < LEAST_RATIO))
            .mapInPandas(near, features.schema).collect())
    return Lexicon(terms, stems, frozenset(r["feature"] for r in like))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 30) -> list[float]:
    """Newton steps on the penalised likelihood; the intercept is not penalised."""
    w, penalty = np.zeros(x.shape[1]), np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-6 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(hessian, x.T @ (y - p) - penalty @ w), -4, 4)
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE) -> Model:
    """Learn from at most ``sample_rows`` labelled rows, the first by hash of each label, near copies among them once,
    none of the held-out ones (crc32(doc_id as text) mod 3 is 1). Without both labels in the sample every score is the share of toxic rows."""
    usable = (labels.filter(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
              .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    chosen = None
    for label in (0, 1):
        part = usable.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows // 2)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
    # At most ``sample_rows`` rows: small enough to broadcast whatever the tables hold.
    labelled = written(texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "toxicity-labelled")
    sample = written(distinct_documents(labelled), "toxicity-sample")
    counts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_other, n_toxic = counts.get(0, 0), counts.get(1, 0)
    if not n_other or not n_toxic:
        return Model(Lexicon(), [30.0 if n_toxic else -30.0, 0.0, 0.0, 0.0, 0.0, 0.0])
    lexicon = learn_lexicon(sample, n_toxic, n_other)

    def start():
        def step(batch):
            if batch is not None and batch.num_rows:
                rows = [inputs_of(*lexicon.hits(t)) for t in batch["text"].to_pylist()]
                yield {"x": rows, "toxic": batch["toxic"].to_pylist()}
        return step
    points = map_rows(labelled, "x array<double>, toxic int", start).collect()
    return Model(lexicon, fit_logistic(np.array([r["x"] for r in points]), np.array([r["toxic"] for r in points], float)))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, score, n_hits, n_quoted. Null texts count as empty; every row keeps its row."""
    def start():
        own = model.local()

        def step(batch):
            if batch is not None and batch.num_rows:
                got = [own.score(t) for t in batch["text"].to_pylist()]
                yield dict(zip(("score", "n_hits", "n_quoted"), zip(*got)), doc_id=batch["doc_id"].to_pylist())
        return step
    return map_rows(docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")), SCORES, start)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, n_hits, n_quoted. A null doc_id is not held out."""
    scored = score_documents(docs, fit(docs, labels))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_hits", "n_quoted")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows scored below the threshold; rows without a text stay."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts):
        own = model.local()
        return texts.map(lambda t: own.score(t)[0])
    return docs.filter(F.col("text").isNull() | (score(whole_text()) < THRESHOLD))
