"""Toxicity scores from a learned lexicon, misspellings included, read in context.

Terms (whole words, and word beginnings shared by several words) are learned from labelled
rows. A Levenshtein automaton of distance 1 runs down the lexicon's trie together with a
word, so misspelled terms are found without listing their variants. Every hit is weighed
by its context window: inside quotation marks, or near a word of reporting, it is likely
a quotation. A logistic regression over the weighed hits gives the score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwatch.session import cut_lineage, ready_python

SAMPLE_ROWS = 30_000  # labelled rows learned from, smallest hash first: the bound on the fit
MAX_TERMS = 2_000
MIN_STEM, MAX_STEM, MIN_FUZZY = 4, 8, 5  # lengths of learned beginnings; shortest word a misspelling is looked for in
MIN_DOCS, MIN_PURITY = 3, 0.95  # a term's toxic documents, and the smoothed toxic share among the documents that hold it
CHANCE = 2.0  # a term must be toxic beyond chance: its log probability under chance, corrected for all terms tried, is below minus this
REMEMBERED = 200_000  # words whose match a task remembers
WINDOW = 6  # words on either side of a hit
WORD = re.compile(r"[^\W\d_]+")
QUOTES = "\"'“”„‟«»‹›‘’"
# FIXED VALUES: words of reporting in the languages served, and words of address
REPORTING = set("said says called calls wrote quote quoted quotes word words term terms dit écrit appelé mot mots cité sagte schrieb nannte wort wörter zitat dijo escribió llamó palabra palabras cita".split())
ADDRESS = set("you your youre tu toi te vous votre du dich dein ihr euch tú ti usted ustedes vosotros".split())
FEATURES = ["exact", "stem", "misspelled", "quoted", "addressed", "density"]


class Trie:
    """Lexicon trie; ``walk`` runs it against the distance-1 Levenshtein automaton of a word."""

    def __init__(self, terms: dict[str, tuple[bool, float]]):
        self.root: dict = {}
        for term, (is_stem, weight) in terms.items():
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = (term, is_stem, weight)

    def walk(self, word: str) -> tuple[str, bool, int, float] | None:
        """Best term for ``word``: ``term, is_stem, edits, weight``; exact before misspelled, longer terms first.

        A state is (letters of the word used, edits); two edits stand for half a swap, where the term
        must go on with the letter passed over. Stems match at the beginning of a word and
        without edits; whole words match with at most one edit, a swap of two neighbours counting as one.
        """
        found: list[tuple[int, int, str, bool, float]] = []
        stack = [(self.root, frozenset({(0, 0)}))]
        n = len(word)
        while stack:
            node, states = stack.pop()
            if "" in node:
                term, is_stem, weight = node[""]
                if is_stem:
                    if (len(term), 0) in states:
                        found.append((0, -len(term), term, True, weight))
                else:
                    edits = [e + (n - i) for i, e in states if e + (n - i) <= 1]
                    if edits and (min(edits) == 0 or len(term) >= MIN_FUZZY):
                        found.append((min(edits), -len(term), term, False, weight))
            for c, below in node.items():
                if c == "":
                    continue
                after = set()
                for i, e in states:
                    if e == 2:
                        if word[i] == c:
                            after.add((i + 2, 1))  # the other half of a swap
                        continue
                    if i < n and word[i] == c:
                        after.add((i + 1, e))
                    if e == 0:
                        after.add((i, 1))  # a letter of the term is missing
                        if i < n:
                            after.add((i + 1, 1))  # another letter stands for it
                        if i + 1 < n and word[i + 1] == c:
                            after.add((i + 2, 1))  # the word has a letter too many
                            after.add((i, 2))  # or the two letters are swapped
                if after:
                    stack.append((below, frozenset(after)))
        if not found:
            return None
        edits, _, term, is_stem, weight = min(found)
        return term, is_stem, edits, weight


class Scorer:
    """Lexicon, the near misses known to be clean, and the regression."""

    def __init__(self, terms: dict[str, tuple[bool, float]]):
        self.terms = terms
        self.trie = Trie(terms)
        self.clean: set[str] = set()
        self.words = {t for t, (stem, _) in terms.items() if not stem}
        self.stems = {t for t, (stem, _) in terms.items() if stem}
        self.stem_sizes = sorted({len(t) for t in self.stems})
        # a word within one edit of a term keeps the term's first or its second half whole, but for a swap across the middle
        fuzzy = [t for t in self.words if len(t) >= MIN_FUZZY]
        self.heads = {(len(t) + d, t[: len(t) // 2]) for t in fuzzy for d in (-1, 0, 1)}
        self.heads |= {(len(t), t[: len(t) // 2 - 1] + t[len(t) // 2]) for t in fuzzy}
        self.tails = {(len(t) + d, t[len(t) // 2 :]) for t in fuzzy for d in (-1, 0, 1)}
        self.head_sizes, self.tail_sizes = sorted({len(h) for _, h in self.heads}), sorted({len(h) for _, h in self.tails})
        self.starts, self.ends = {h[:2] for _, h in self.heads}, {t[-2:] for _, t in self.tails}
        self.seen: dict[str, tuple | None] = {}
        self.weights, self.scale = np.zeros(len(FEATURES) + 1), np.ones(len(FEATURES))
        self.weights[0] = -4.0
        self.weights[1:5] = 4.0, 4.0, 1.0, -1.0

    def candidate(self, word: str) -> bool:
        """Whether the word can match a term; loses none."""
        if word in self.words:
            return True
        for size in self.stem_sizes:
            if word[:size] in self.stems:
                return True
        n = len(word)
        if word[:2] in self.starts:
            for size in self.head_sizes:
                if (n, word[:size]) in self.heads:
                    return True
        if word[-2:] in self.ends:
            for size in self.tail_sizes:
                if (n, word[-size:]) in self.tails:
                    return True
        return False

    def match(self, word: str) -> tuple[str, bool, int, float] | None:
        """The term a word stands for, remembered for the words met last."""
        if word in self.seen:
            return self.seen[word]
        m = self.trie.walk(word) if self.candidate(word) else None
        if m and m[2] and word in self.clean:
            m = None
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        self.seen[word] = m
        return m

    def hits(self, low: str) -> list[tuple[int, str, bool, int, float]]:
        """``place, word, is_stem, edits, weight`` of every term found among the words."""
        words = WORD.findall(low)
        matched = {w: m for w in set(words) if (m := self.match(w))}
        if not matched:
            return []
        return [(i, w, matched[w][1], matched[w][2], matched[w][3]) for i, w in enumerate(words) if w in matched]

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(len(FEATURES))
        low = (text or "").lower()
        found = self.hits(low)
        if not found:
            return out
        spans = [m.span() for m in WORD.finditer(low)]
        places = {i for i, *_ in found}
        for i, _, is_stem, edits, weight in found:
            around = [low[a:b] for a, b in spans[max(0, i - WINDOW) : i + WINDOW + 1]]
            start, end = spans[i]
            left, right = low[spans[max(0, i - WINDOW)][0] : start], low[end : spans[min(len(spans) - 1, i + WINDOW)][1]]
            inside = sum(left.count(q) for q in QUOTES) % 2 == 1 and any(q in right for q in QUOTES)
            reported = any(w in REPORTING for w in around)
            alone = sum(j in places for j in range(i - WINDOW, i + WINDOW + 1)) == 1
            quoted = 0.5 * inside + 0.3 * reported + (0.1 if alone and (inside or reported) else 0.0)
            value = weight * (1 - quoted)
            out[3] += weight * quoted
            out[4] += any(w in ADDRESS for w in around) * (1 - quoted)
            out[2 if edits else 1 if is_stem else 0] += value
        out[:5] = np.log1p(out[:5])
        out[5] = np.log1p(100 * len(found) / len(spans))
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 0.3) -> None:
        """Ridge logistic regression by Newton steps; hits never count towards clean."""
        if not len(y) or y.min() == y.max():
            return
        self.scale = np.maximum(x.std(axis=0), 1e-3)
        a = np.concatenate([np.ones((len(x), 1)), x / self.scale], axis=1)
        w = np.zeros(a.shape[1])
        w[0] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
        penalty = np.r_[0.0, np.full(a.shape[1] - 1, ridge)]
        loss = lambda v: np.logaddexp(0, -(2 * y - 1) * (a @ v)).sum() + (penalty * v * v).sum() / 2
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-a @ w))
            gradient = a.T @ (p - y) + penalty * w
            hessian = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty + 1e-6)
            step, t = np.linalg.solve(hessian, gradient), 1.0
            while t > 1e-4 and loss(w - t * step) > loss(w):
                t /= 2
            w = w - t * step
            if np.abs(t * step).max() < 1e-6:
                break
        self.weights = w

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + (x / self.scale) @ self.weights[1:], -40, 40)))

    def learn_clean(self, clean_words: list[str]) -> None:
        self.clean = set(clean_words)
        self.seen.clear()


def signature(text: str | None) -> int:
    """Smallest hash of the three-word shingles: near copies mostly share it."""
    w = WORD.findall((text or "").lower())
    return min((zlib.crc32(" ".join(w[i : i + 3]).encode()) for i in range(max(1, len(w) - 2))), default=0)


def choose_terms(counts: pd.DataFrame, n_toxic: int, n_clean: int, tried: int) -> dict[str, tuple[bool, float]]:
    """Lexicon from ``term, is_stem, toxic, clean, kinds``: documents of either label that hold it, distinct words of a stem.

    Terms must be pure, and more often toxic than chance would make any of the ``tried`` terms; a stem must stand for three words or more and
    say more than any one longer stem or word within it.
    """
    t = counts[(counts["toxic"] >= MIN_DOCS) & (~counts["is_stem"] | (counts["kinds"] >= 3))].copy()
    odds = (t["toxic"] + 0.5) / (n_toxic + 1) / ((t["clean"] + 0.5) / (n_clean + 1))
    t["weight"] = np.clip(np.log(odds), 1.0, 6.0) / 3
    chance = t["toxic"] * np.log((n_toxic + n_clean + 1) / (n_toxic + 1)) - np.log(max(1, tried))
    t = t[(odds / (1 + odds) >= MIN_PURITY) & (chance >= CHANCE)]
    words = {r.term: r.toxic for r in t.itertuples() if not r.is_stem}
    stems = {r.term: r.toxic for r in t.itertuples() if r.is_stem}
    covered: Counter = Counter()
    for longer, n in [*stems.items(), *words.items()]:
        for size in range(MIN_STEM, len(longer) + (longer in words and longer not in stems)):
            covered[longer[:size]] = max(covered[longer[:size]], n)
    kept = {s for s, n in stems.items() if covered[s] < 0.9 * n}
    kept = {s for s in kept if not any(s[:size] in kept for size in range(MIN_STEM, len(s)))}
    out = {}
    for r in t.sort_values(["toxic", "term"], ascending=[False, True]).itertuples():
        if r.is_stem and r.term in kept or not r.is_stem and not any(r.term[:size] in kept for size in range(MIN_STEM, len(r.term) + 1)):
            if len(out) < MAX_TERMS:
                out.setdefault(r.term, (bool(r.is_stem), float(r.weight)))
    return out


def train(docs: DataFrame, labels: DataFrame, train_rows, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Scorer:
    """Learns lexicon, clean near misses and regression from at most ``SAMPLE_ROWS`` labelled rows that ``train_rows`` admits.

    The sample's ids, whose number is bounded, are broadcast, so the documents are not
    shuffled; its words are counted by Spark and only terms with toxic documents come to
    the driver. Rows with a null label or a null id are not learned from; repeated labels
    count once, the larger label first. Without any toxic row the lexicon is empty.
    """
    spark = docs.sparkSession
    ready_python(spark)
    own = (
        labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).where(train_rows(F.col("id")) & F.col("id").isNotNull() & F.col("y").isNotNull())
        .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
    )

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([signature(t) for t in texts], pa.int64()), batch.column(2), batch.column(1)], names=["sig", "y", "text"])

    sample = cut_lineage(
        docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).join(F.broadcast(own), "id").select("id", "text", "y"), "toxic-sample"
    )
    # near copies would count as evidence many times: one document for each smallest shingle hash
    sample = cut_lineage(sample.mapInArrow(signed, "sig long, y int, text string").groupBy("sig", "y").agg(F.min("text").alias("text")), "toxic-distinct")
    sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sum(n for y, n in sizes.items() if y != 1)

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, y = [], []
            for t, label_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own_words = {w for w in WORD.findall((t or "").lower()) if len(w) > 2}
                word += own_words
                y += [label_] * len(own_words)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(y, pa.int32())], names=["word", "y"])

    words = cut_lineage(
        sample.select("text", "y").mapInArrow(words_of, "word string, y int").groupBy("word")
        .agg(F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("y") == 1, 0).otherwise(1)).alias("clean")), "toxic-words",
    )
    sizes_of_stems = F.sequence(F.lit(MIN_STEM), F.least(F.lit(MAX_STEM), F.length("word")))
    long_enough = words.where(F.length("word") >= MIN_STEM)
    stems = (
        long_enough.select("word", "toxic", "clean", F.explode(sizes_of_stems).alias("n")).select(F.expr("substring(word, 1, n)").alias("term"), "toxic", "clean")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("kinds"))
        .where((F.col("toxic") >= MIN_DOCS) & (F.col("kinds") >= 3)).withColumn("is_stem", F.lit(True))
    )
    whole = words.where(F.col("toxic") >= MIN_DOCS).select(F.col("word").alias("term"), "toxic", "clean", F.lit(1).alias("kinds"), F.lit(False).alias("is_stem"))
    odds = (F.col("toxic") + 0.5) / (F.col("clean") + 0.5) * ((n_clean + 1) / (n_toxic + 1))
    pure = whole.unionByName(stems.select(whole.columns)).where(odds / (1 + odds) >= MIN_PURITY)
    tried = whole.count() + stems.count()
    counts = pure.orderBy(F.col("toxic").desc(), "term", "is_stem").limit(8 * MAX_TERMS).toPandas()
    scorer = Scorer(choose_terms(counts, n_toxic, n_clean, tried) if len(counts) else {})
    shared = spark.sparkContext.broadcast(scorer)

    def near_misses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for batch in batches:
            got = [w for w in batch.column(0).to_pylist() if s.candidate(w) and (m := s.trie.walk(w)) and m[2]]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.string())], names=["word"])

    # every word of a clean sampled document is clean, however near it is to a term
    scorer.learn_clean([r.word for r in words.where("clean > 0").select("word").mapInArrow(near_misses, "word string").collect()])
    shared = spark.sparkContext.broadcast(scorer)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for batch in batches:
            x = [s.features(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    rows = sample.select("text", "y").mapInArrow(measure, "x array<double>, y int").toPandas()
    if len(rows):
        scorer.fit(np.stack(rows["x"].to_list()), (rows["y"].to_numpy() == 1).astype(float))
    return scorer


def score(docs: DataFrame, scorer: Scorer, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, n_hits`` for every whole text, without a shuffle.

    Null and empty texts score as texts without hits; null keys, repeated rows and very
    long texts are scored like any other; further columns are not read; an empty table gives no rows.
    """
    ready_python(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for batch in batches:
            x = np.array([s.features(t.as_py()) for t in batch.column(1)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s.scores(x)), pa.array((x[:, :3].sum(axis=1) > 0))], names=[key, "score", "has_hit"])

    return docs.select(key, F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, f"`{key}` {kind}, score double, has_hit boolean")
