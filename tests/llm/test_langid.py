import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnwatch.llm import langid
from churnwatch.llm.common import held_out
from tests.conftest import SF01


def brute_kneser_ney(seqs, alphabet_size, order=langid.ORDER):
    """Plain dictionaries: interpolated Kneser-Ney of one language over symbol tuples."""
    top = Counter()
    for s in seqs:
        p = (0,) * (order - 1) + tuple(s)
        top.update(p[i : i + order] for i in range(len(s)))
    counts = {order: top}
    for m in range(order - 1, 0, -1):
        counts[m] = Counter(g[1:] for g in counts[m + 1])
    stats = {}
    for m, c in counts.items():
        once, twice = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        total, kinds = defaultdict(int), defaultdict(int)
        for g, v in c.items():
            total[g[:-1]] += v
            kinds[g[:-1]] += 1
        stats[m] = c, min(0.95, max(0.05, once / max(1, once + 2 * twice))), total, kinds

    def prob(g):
        if not g:
            return 1 / (alphabet_size + 2)
        c, d, total, kinds = stats[len(g)]
        h = g[:-1]
        if h not in total:
            return prob(g[1:])
        return max(c.get(g, 0) - d, 0) / total[h] + d * kinds[h] / total[h] * prob(g[1:])

    return prob


def counted(spark, train):
    rows = []
    for lang, texts in train.items():
        total = Counter()
        for codes, _ in langid.batches_of(texts):
            total.update(codes.tolist())
        rows += [(lang, c - (1 << 64) if c >> 63 else c, n) for c, n in total.items()]
    return spark.createDataFrame(rows, "lang string, code long, n long")


def test_probabilities_match_plain_kneser_ney(spark, monkeypatch):
    monkeypatch.setattr(langid, "GROUP", 2)  # three languages, two groups
    train = {"x": ["abc abd", "aabb cab dab", "abcabc"], "y": ["dddc bad", "cab cab", "ggg"], "z": ["\U00020000\U00020001 a", "\uff41\u4e00\u4e01"]}
    model = langid.Model(langid.kneser_ney(counted(spark, train)).toPandas())
    seqs = {k: [langid.symbols(t).tolist() for t in train[k]] for k in model.langs}
    kinds = {s for own in seqs.values() for seq in own for s in seq}
    probs = [brute_kneser_ney(seqs[k], len(kinds) - 1) for k in model.langs]
    tests = ["abc", "dab cab", "zzz q", "gggg", "É a b1c", "edcba" * 20, "\U00020000 \u4e00\u4e01\U0001f600a"]
    entropy, n = model.entropies(tests)
    for i, t in enumerate(tests):
        s = tuple(langid.symbols(t).tolist())
        assert n[i] == len(s)
        p = (0,) * (langid.ORDER - 1) + s
        for k, prob in enumerate(probs):
            want = -sum(math.log(prob(p[j : j + langid.ORDER])) for j in range(len(s))) / len(s)
            assert entropy[i, k] == pytest.approx(want, rel=1e-4)


def test_rare_grams_leave_their_mass_to_the_lower_order(spark, monkeypatch):
    train = {"x": ["abc abd", "aabb cab dab", "abcabc"] * 3}
    counts = counted(spark, train)
    whole = langid.kneser_ney(counts).toPandas()
    monkeypatch.setattr(langid, "RARE", 0.06)
    rows = langid.kneser_ney(counts).toPandas()
    assert len(rows) < len(whole)
    model = langid.Model(rows)
    kinds = sorted({s for t in train["x"] for s in langid.symbols(t).tolist()})
    for context in ([0, 0, 0], [97, 98, 99], [0, 97, 98], [98, 98, 98]):
        codes = np.array([langid.grams(np.array([*context, s], np.uint16), 4)[-1] for s in [*kinds, 0xFFFF]])
        assert np.exp(model.log_probs(codes)).sum() == pytest.approx(1, abs=1e-4)


def test_symbols():
    assert langid.symbols("Ab  1c").tolist() == [97, 98, 0, 99]
    assert langid.symbols("\U00020000\U0001f600\ud800x").tolist() == [0xD840, 0xDC00, 0, 120]
    assert langid.symbols("\U00010400").tolist() == [0xD801, 0xDC28]  # a capital above 0xFFFF


def test_long_texts_are_scored_whole(spark, monkeypatch):
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcd "), 5000))
    counts = counted(spark, {"x": [text]})
    model = langid.Model(langid.kneser_ney(counts).toPandas())
    whole = model.entropies([text, "abc"])
    monkeypatch.setattr(langid, "SLICE", 100)
    assert np.allclose(model.entropies([text, "abc"])[0], whole[0])
    assert sorted(counted(spark, {"x": [text]}).collect()) == sorted(counts.collect())


def test_small_languages_and_far_letters(spark):
    """Two ideographic languages of disjoint letters beside many Latin documents, letters above 0xFFFF, a language of one row."""
    rng = np.random.default_rng(2)

    def text(letters, n):
        return " ".join("".join(rng.choice(letters, 6)) for _ in range(n))

    latin = [chr(c) for c in [*range(97, 123), *range(0xE0, 0xF7), *range(0x100, 0x17F), *range(0x3B1, 0x3CA), *range(0x430, 0x450)]]
    sets = {"la": (latin, 300, 200), "i1": ([chr(0x4E00 + k) for k in range(100)], 60, 20), "i2": ([chr(0x5E00 + k) for k in range(100)], 60, 20), "far": ([chr(0x20000 + k) for k in range(100)], 20, 10)}
    rows = [(lang, text(letters, n)) for lang, (letters, docs, n) in sets.items() for _ in range(docs)] + [("one", "ⴰⴱⴲ ⴳⴴⴵ ⴰⴱⴲ")]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.train(docs, lambda i: F.lit(True))
    assert model.langs == ["far", "i1", "i2", "la", "one"]
    assert all(r.lang_pred == r.lang for r in langid.identify(docs, model).collect())


def test_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.train(docs, lambda i: ~held_out(i))
    got = langid.identify(docs, model).where(held_out(F.col("doc_id"))).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in got) <= 0.02 * len(got)
    odd = spark.createDataFrame(
        [(1, None, 1), (2, "", 2), (None, "12 34 !?", 3), (3, "при" * 60 + " что это такое", 4), (3, "x", 5), (3, "x", 5)], "doc_id long, text string, score int"
    )
    rows = langid.identify(odd, model).collect()
    assert [r.lang_pred for r in rows[:3]] == ["und"] * 3 and all(r.rejected for r in rows[:4])
    assert rows[3].lang_pred in model.langs and len(rows) == 6
    assert langid.identify(odd.limit(0), model).count() == 0


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert langid.train(docs, lambda i: F.lit(True)) is None
    assert [r.lang_pred for r in langid.identify(docs, None).collect()] == ["und", "und"]


def test_all_rows_are_counted_and_all_of_the_tenth_calibrate(spark, monkeypatch):
    """What the tenth alone holds is in the model, and the usual entropies are those of every row of the tenth."""
    rng = np.random.default_rng(7)
    rows = [(i, " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(int(rng.integers(5, 60)))), "xy"[i % 2]) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    tenth = {r.doc_id for r in docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0).collect()}
    rows = [(i, t + " zzz" if i in tenth else t, x) for i, t, x in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    seen = []
    usual = langid.usual_entropies
    monkeypatch.setattr(langid, "usual_entropies", lambda scored: seen.append([tuple(r) for r in scored.collect()]) or usual(scored))
    monkeypatch.setattr(langid, "CALIBRATION_ROWS", 20, raising=False)
    model = langid.train(docs, lambda i: F.lit(True))
    whole = langid.Model(langid.kneser_ney(counted(spark, {x: [t for _, t, y in rows if y == x] for x in "xy"})).toPandas())
    assert np.allclose(model.entropies(["zzz", "abc zz"])[0], whole.entropies(["zzz", "abc zz"])[0])
    (scored,) = seen
    assert len(scored) == len(tenth) > 100
    for k, name in enumerate(model.langs):
        e, n = np.array([(e, n) for x, e, n in scored if x == name]).T
        mean = np.median(e)
        far = (e - mean) ** 2
        trim = far <= np.quantile(far, 0.99)
        between, per_symbol = np.linalg.lstsq(np.stack([np.ones(trim.sum()), 1 / n[trim]], axis=1), far[trim], rcond=None)[0]
        assert model.usual[k] == pytest.approx((mean, max(between, 1e-4), max(per_symbol, 0.05)))
