"""Language identification by interpolated Kneser-Ney character models.

Texts become symbol sequences: the UTF-16 units of lower-cased letters, everything between
letters one boundary symbol, so four symbols are exactly one 64-bit code and no alphabet has
to be chosen. For every language Spark counts all order-4 n-grams of its training
documents and derives from them the continuation counts, discounts, probabilities and
back-off weights of orders 4 to 1. N-grams rarer than ``RARE`` of their own language's symbols
leave their mass to the lower order; all others are gathered, so what is gathered grows with the texts and the
languages, and a small language is cut by its own size only. Languages share sorted
arrays of n-gram hashes in groups of ``GROUP``, whose rows hold the interpolated log probability
per language. The language with the lowest cross-entropy per symbol wins; how
far that entropy may lie above what is usual for the language and the length is
calibrated on all training documents of one tenth, by a model that counts the other
nine; the model itself counts all ten.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwatch.operators import quantiles as Q
from churnwatch.session import cut_lineage, ready_python

ORDER, BITS = 4, 16
RARE = 1e-6  # least share of a language's symbols that an n-gram ends at: at most a million n-grams of an order and language
GROUP = 8  # languages in one table: its rows hold a number for each of them
HELD = 1 << 21  # distinct n-grams a counting task holds at once for a language
SLICE = 1 << 20  # symbols worked on at once
LEAST_TEXTS = 5  # texts of a language that say what is usual for it; one with fewer takes the mean of the others
REJECT_WIDTH, REJECT_EXCESS = 8.0, 0.75  # a text in no learned language: standard deviations, and nats a symbol, above the usual entropy
MIX = np.uint64(0x9E3779B97F4A7C15)
_LETTER = np.array([chr(c).isalpha() for c in range(1 << BITS)])


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def symbols(text: str) -> np.ndarray:
    """Symbols of a text: 0 between letters, the UTF-16 units of lower-cased letters (two for a letter above 0xFFFF)."""
    units = np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), dtype="<u2")
    out = np.where(_LETTER[units], units, np.uint16(0))
    at = np.nonzero((units[:-1] & 0xFC00 == 0xD800) & (units[1:] & 0xFC00 == 0xDC00))[0]
    if len(at):
        points = 0x10000 + ((units[at].astype(np.int64) & 0x3FF) << 10) + (units[at + 1] & 0x3FF)
        kinds, back = np.unique(points, return_inverse=True)
        at = at[np.array([chr(p).isalpha() for p in kinds.tolist()])[back]]
        out[at], out[at + 1] = units[at], units[at + 1]
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def grams(syms: np.ndarray, order: int) -> np.ndarray:
    """Codes of the ``order``-grams that end at each symbol, boundaries standing before the first; 16 bits a symbol, last lowest."""
    padded = np.concatenate((np.zeros(order - 1, np.uint16), syms)).astype(np.uint64)
    out = padded[order - 1 :].copy()
    for back in range(1, order):
        out |= padded[order - 1 - back : len(padded) - back] << np.uint64(BITS * back)
    return out


def last(codes: np.ndarray, symbols: int) -> np.ndarray:
    """The codes of the last ``symbols`` symbols."""
    return codes & np.uint64((1 << BITS * symbols) - 1)


def pieces(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, symbols with ORDER - 1 symbols of context before them)``, long texts in slices."""
    for i, text in enumerate(texts):
        if not text:
            continue
        s = np.concatenate((np.zeros(ORDER - 1, np.uint16), symbols(text)))
        for at in range(ORDER - 1, len(s), SLICE):
            yield i, s[at - ORDER + 1 : at + SLICE]


def batches_of(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(codes, row of each code)`` for about ``SLICE`` symbols at a time."""
    codes, rows, held = [], [], 0
    for i, s in pieces(texts):
        c = grams(s, ORDER)[ORDER - 1 :]
        codes.append(c)
        rows.append(np.full(len(c), i, np.int32))
        held += len(c)
        if held >= SLICE:
            yield np.concatenate(codes), np.concatenate(rows)
            codes, rows, held = [], [], 0
    if codes:
        yield np.concatenate(codes), np.concatenate(rows)


def hashed(codes: np.ndarray) -> np.ndarray:
    return codes * MIX  # odd, so different codes have different hashes


class HashArray:
    """Sorted hashes and their rows; a miss gives row -1."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        h = hashed(codes)
        order = np.argsort(h)
        self.keys, self.values = h[order], np.ascontiguousarray(values[order])

    def find(self, codes: np.ndarray) -> np.ndarray:
        h = hashed(codes)
        at = np.searchsorted(self.keys, h)
        at[at == len(self.keys)] = 0
        at[self.keys[at] != h] = -1
        return at


class Tables:
    """Interpolated log probabilities of some languages, from their rows of ``kneser_ney``."""

    def __init__(self, langs: list[str], rows: pd.DataFrame, floor: float):
        self.floor = np.float32(floor)
        self.probs: dict[int, HashArray] = {}
        self.backoff: dict[int, HashArray] = {}
        column = {name: k for k, name in enumerate(langs)}
        below_codes, below = np.zeros(1, np.uint64), np.full((1, len(langs)), floor)
        for m in range(1, ORDER + 1):
            parts = []
            for context in (False, True):
                own = rows[(rows["order"] == m) & (rows["context"] == context)]
                codes = own["code"].to_numpy().astype(np.int64).view(np.uint64)
                union, at = np.unique(codes, return_inverse=True)
                dense = np.zeros((len(union), len(langs)))
                dense[at, own["lang"].map(column).to_numpy(dtype=np.int64)] = own["value"].to_numpy(np.float64)
                parts.append((union, dense))
            (union, own), (contexts, weight) = parts  # weight: log of the mass left to the lower order; 0 where the context is unseen
            lower = below[np.searchsorted(below_codes, last(union, m - 1))]
            values = np.log(own + np.exp(weight[np.searchsorted(contexts, union >> np.uint64(BITS))] + lower))
            self.probs[m] = HashArray(union, values.astype(np.float32))
            self.backoff[m] = HashArray(contexts, weight.astype(np.float32))
            below_codes, below = union, values

    def log_probs(self, codes: np.ndarray) -> np.ndarray:
        """Natural log probability of each position in each language."""
        at = self.probs[ORDER].find(codes)
        out = self.probs[ORDER].values[at]
        miss = np.nonzero(at < 0)[0]
        if len(miss):
            out[miss] = 0
        for m in range(ORDER, 0, -1):
            if not len(miss):
                return out
            context = self.backoff[m].find(last(codes[miss], m) >> np.uint64(BITS))
            known = context >= 0
            out[miss[known]] += self.backoff[m].values[context[known]]
            if m == 1:
                out[miss] += self.floor
                return out
            at = self.probs[m - 1].find(last(codes[miss], m - 1))
            found = at >= 0
            out[miss[found]] += self.probs[m - 1].values[at[found]]
            miss = miss[~found]
        return out


class Model:
    """Tables of all languages, in groups, and the usual entropies."""

    def __init__(self, rows: pd.DataFrame):
        """``rows``: those of ``kneser_ney``."""
        self.langs = sorted(rows["lang"].unique())
        self.kinds = rows.loc[(rows["order"] == 1) & ~rows["context"], "code"].nunique() + 1  # one more for all unseen symbols
        groups = [self.langs[k : k + GROUP] for k in range(0, len(self.langs), GROUP)]
        self.tables = [Tables(g, rows[rows["lang"].isin(g)], -np.log(self.kinds)) for g in groups]
        self.usual = np.zeros((len(self.langs), 3))  # mean entropy, variance between texts, variance per symbol

    def log_probs(self, codes: np.ndarray) -> np.ndarray:
        each = [t.log_probs(codes) for t in self.tables]
        return each[0] if len(each) == 1 else np.concatenate(each, axis=1)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol in each language, and the number of symbols."""
        total, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        step = max(1, 4 * SLICE // len(self.langs))
        for codes, rows in batches_of(texts):
            for at in range(0, len(codes), step):
                values, own = self.log_probs(codes[at : at + step]), rows[at : at + step]
                first = np.nonzero(np.concatenate(([True], own[1:] != own[:-1])))[0]
                total[own[first]] -= np.add.reduceat(values, first, axis=0, dtype=np.float64)
            n += np.bincount(rows, minlength=len(texts))
        return total / np.maximum(n, 1)[:, None], n

    def calibrate(self, usual: dict[str, tuple[float, float, float]]) -> None:
        """Usual entropy of each language, from ``usual_entropies``."""
        self.usual = np.array([usual.get(name, (np.nan,) * 3) for name in self.langs])
        if np.isnan(self.usual).all():
            self.usual[:] = (np.log(self.kinds), 1.0, 1.0)
        else:
            self.usual[np.isnan(self.usual[:, 0])] = np.nanmean(self.usual, axis=0)

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """``lang_pred, score, rejected, entropy`` of whole texts."""
        entropy, n = self.entropies(texts)
        best = entropy.argmin(axis=1)
        rows = np.arange(len(texts))
        mean, between, per_symbol = self.usual[best].T
        excess = entropy[rows, best] - mean
        width = excess / np.sqrt(between + per_symbol / np.maximum(n, 1))
        beyond = np.minimum(width - REJECT_WIDTH, (excess - REJECT_EXCESS) * 20)
        lead = entropy - entropy[rows, best][:, None]
        share = 1 / np.exp(-lead * np.minimum(n, 400)[:, None]).sum(axis=1)
        score = share / (1 + np.exp(np.clip(beyond, -50, 50)))
        none = np.array([not has_letter(t) for t in texts], dtype=bool)
        return pd.DataFrame(
            {
                "lang_pred": np.where(none, "und", np.array(self.langs, dtype=object)[best]),
                "score": np.where(none, 0.0, np.clip(score, 0, 1)),
                "rejected": none | (beyond > 0),
                "entropy": np.where(none, np.nan, entropy[rows, best]),
            }
        )


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``lang, order, context, code, value`` from all counts ``lang, code, n`` of top-order n-grams.

    Rows of n-grams (``context`` false) hold their discounted share of what follows their
    context, rows of contexts the log of the mass left to the lower order. Counts below the top
    order are distinct left neighbours; every language and order has its own discount. All
    n-grams enter counts, discounts and totals; those at fewer than ``RARE`` of their language's
    symbols get no row, and their mass goes to the lower order. A suffix is
    at least as frequent as its n-gram, so it has a row where the n-gram has one.
    """
    # a row per language, written so that its size decides how it is joined: a shuffle by language alone would put one into a task
    sizes = cut_lineage(counts.groupBy("lang").agg((F.sum("n") * RARE).alias("least")), "langid-sizes")
    level, out = counts.withColumn("seen", F.col("n")), []
    for m in range(ORDER, 0, -1):
        if m < ORDER:
            level = level.withColumn("code", F.col("code").bitwiseAND(F.lit((1 << BITS * m) - 1)))
            level = cut_lineage(level.groupBy("lang", "code").agg(F.count("*").alias("n"), F.sum("seen").alias("seen")), "langid-level")
        once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discount = F.least(F.lit(0.95), F.greatest(F.lit(0.05), once / F.greatest(F.lit(1), once + 2 * twice)))
        by_lang = cut_lineage(level.groupBy("lang").agg(discount.alias("d")).join(sizes, "lang"), "langid-discounts")
        rows = level.join(by_lang, "lang").withColumn("ctx", F.shiftrightunsigned("code", BITS)).withColumn("kept", F.col("seen") >= F.col("least"))
        contexts = rows.groupBy("lang", "ctx").agg(
            F.sum("n").alias("total"), F.sum(F.when(F.col("kept"), F.col("n") - F.col("d")).otherwise(0.0)).alias("held"), F.max("kept").alias("any")
        ).where("any")
        own = rows.where("kept").join(contexts, ["lang", "ctx"]).select("lang", F.lit(m).alias("order"), F.lit(False).alias("context"), "code", ((F.col("n") - F.col("d")) / F.col("total")).alias("value"))
        left = contexts.select("lang", F.lit(m).alias("order"), F.lit(True).alias("context"), F.col("ctx").alias("code"), F.log((F.col("total") - F.col("held")) / F.col("total")).alias("value"))
        # written by order: all orders in one plan would hold the joined tables of every order on the driver at once
        out.append(cut_lineage(own.unionByName(left), "langid-order"))
    whole = out[0]
    for rows in out[1:]:
        whole = whole.unionByName(rows)
    return whole


def count_grams(texts: DataFrame) -> DataFrame:
    """``lang, tenth, code, n`` from ``text, lang, tenth``: counted in tasks that hold one slice of symbols at a time."""

    def rows(name: str, tenth: bool, c: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([name] * len(c), pa.string()), pa.array([tenth] * len(c), pa.bool_()), pa.array(c.view(np.int64)), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "tenth", "code", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            own: dict[tuple, list[str]] = {}
            for text, *of in zip(*(c.to_pylist() for c in batch.columns)):
                own.setdefault(tuple(of), []).append(text)
            for of, some in own.items():
                for codes, _ in batches_of(some):
                    c, n = np.unique(codes, return_counts=True)
                    if of in sums:
                        c0, n0 = sums[of]
                        c, at = np.unique(np.concatenate((c0, c)), return_inverse=True)
                        n = np.bincount(at, np.concatenate((n0, n))).astype(np.int64)
                    sums[of] = c, n
                    if len(c) > HELD:
                        yield rows(*of, *sums.pop(of))
        for of, (c, n) in sums.items():
            yield rows(*of, c, n)

    counted = texts.select("text", "lang", "tenth").mapInArrow(count, "lang string, tenth boolean, code long, n long")
    return counted.groupBy("lang", "tenth", "code").agg(F.sum("n").alias("n"))


def usual_entropies(scored: DataFrame) -> dict[str, tuple[float, float, float]]:
    """Mean entropy, spread between texts, and spread that shrinks with length, of each language; from all rows ``lang, e, n`` of texts.

    The mean is the median; the spreads are fitted by least squares to the squared distances from it, without their largest
    hundredth. Ranks and sums are taken in Spark; a few numbers per language come to the driver."""
    spark = scored.sparkSession
    own = scored.where("n >= 1")

    def with_limit(rows: DataFrame, value: str, prob: float, name: str) -> DataFrame:
        found = Q.grouped_quantiles(rows.select(F.col("lang").alias("feature"), F.col(value).alias("value")), [prob], LEAST_TEXTS)
        table = spark.createDataFrame([(lang, v[0]) for lang, v in found.items()], f"lang string, {name} double")
        return rows.join(F.broadcast(table), "lang")  # a row per language

    far = cut_lineage(with_limit(own, "e", 0.5, "mean").withColumn("far", (F.col("e") - F.col("mean")) ** 2), "langid-far")
    one, inv = F.count("*").cast("double"), 1 / F.col("n")
    sums = with_limit(far, "far", 0.99, "most").where("far <= most").groupBy("lang", "mean").agg(
        one.alias("k"), F.sum(inv).alias("s"), F.sum(inv * inv).alias("ss"), F.sum("far").alias("f"), F.sum(F.col("far") * inv).alias("fs")
    )
    out = {}
    for r in sums.collect():
        between, per_symbol = np.linalg.lstsq(np.array([[r.k, r.s], [r.s, r.ss]]), np.array([r.f, r.fs]), rcond=1e-12)[0]
        out[r.lang] = r["mean"], max(between, 1e-4), max(per_symbol, 0.05)
    return out


def train(docs: DataFrame, train_rows, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Fits the model on the rows that ``train_rows`` (a condition) admits and whose language is known.

    All of these rows are counted, all of their languages learned. What comes to the driver are the
    rows of ``kneser_ney``, at most ``1 / RARE`` for an order of a language. What is usual for a text that was not
    counted is taken from all rows of one tenth (by hash of the key), scored by a model that counts the others;
    a language that has no other rows is counted from these in both.
    """
    spark = docs.sparkSession
    ready_python(spark)
    labelled = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).where(
        train_rows(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    ).withColumn("tenth", F.pmod(F.xxhash64("id"), F.lit(10)) == 0)
    every = cut_lineage(count_grams(labelled), "langid-counts")
    used = cut_lineage(every.groupBy("lang").agg(F.min("tenth").alias("tenth")), "langid-used")
    rows = kneser_ney(every.join(used, ["lang", "tenth"]).select("lang", "code", "n")).toArrow().to_pandas()
    if rows.empty:
        return None
    nine = Model(rows)
    del rows
    shared = spark.sparkContext.broadcast(nine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            entropy, n = m.entropies(batch.column(0).to_pylist())
            lang = np.array(batch.column(1).to_pylist(), dtype=object)
            at = np.array([m.langs.index(x) if x in m.langs else -1 for x in lang], dtype=np.int64)
            ok = at >= 0
            yield pa.RecordBatch.from_arrays([pa.array(lang[ok], pa.string()), pa.array(entropy[np.arange(len(at)), at][ok]), pa.array(n[ok])], names=["lang", "e", "n"])

    tenth = labelled.where("tenth").where(F.length("text") > 0).select("text", "lang")
    scored = cut_lineage(tenth.mapInArrow(score, "lang string, e double, n double"), "langid-scored")
    shared.destroy()
    del nine
    usual = usual_entropies(scored)
    whole = cut_lineage(every.groupBy("lang", "code").agg(F.sum("n").alias("n")), "langid-whole")
    model = Model(kneser_ney(whole).toArrow().to_pandas())
    model.calibrate(usual)
    return model


RESULTS = ("lang_pred", "score", "rejected", "entropy")


def identify(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None, names: tuple[str, ...] = RESULTS) -> DataFrame:
    """The columns ``keep`` (default all) plus language, score, rejection and entropy under ``names``, without a shuffle.

    The language is ``und`` (score 0, rejected) where the text is null or has no letter,
    and where nothing could be learned; a text in no learned language keeps its nearest one
    with a low score and is rejected. Repeated rows, null keys and extra columns pass
    through; columns that have one of the ``names`` are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    if model is None:
        none = (F.lit("und"), F.lit(0.0), F.lit(True), F.lit(None).cast("double"))
        return docs.select(*[f"`{c}`" for c in keep], *[v.alias(c) for c, v in zip(names, none)])
    ready_python(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = keep.index(text) if text in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = shared.value.predict(batch.column(at).to_pylist())
            columns = [pa.array(got[c], t) for c, t in zip(RESULTS, (pa.string(), pa.float64(), pa.bool_(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], names=inner)

    # numbered inside, so that a column may have any name
    inner = [f"c{i}" for i in range(len(keep) + len(RESULTS))]
    types = [docs.schema[c].dataType.simpleString() for c in keep] + ["string", "double", "boolean", "double"]
    read = keep + ([] if text in keep else [text])
    numbered = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(read)])
    return numbered.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(inner, types))).toDF(*keep, *names)
