import random

from churnwatch.llm import decontaminate


def brute(docs, items, need=0.8):
    """Every window of every document against every item."""
    from collections import Counter

    import re

    def grams(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return [] if not w else [" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))]

    out = set()
    for d, text in docs:
        g = grams(text)
        for k, item in items:
            h = grams(item)
            if not h:
                continue
            c = Counter(h)
            for s in range(max(1, len(g) - len(h) + 1)):
                win = g[s : s + len(h)]
                if win and 2 * sum((Counter(win) & c).values()) / (len(win) + len(h)) >= need:
                    out.add((d, k))
                    break
    return out


def test_planted_passages(spark):
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(words(rng.randrange(8, 60)))) for i in range(25)] + [(90, "Two words"), (91, None), (92, "")]
    docs = []
    for i in range(120):
        body, item = words(rng.randrange(0, 200)), items[i % 25][1].split()
        if i % 2:
            for _ in range(rng.randrange(0, 4)):
                item[rng.randrange(len(item))] = rng.choice(vocab).upper()
            if i % 5 == 0:
                item.insert(len(item) // 2, "extra")
            at = rng.randrange(len(body) + 1)
            body = body[:at] + [w.title() + rng.choice(["", ",", "."]) for w in item] + body[at:]
        docs.append((i, "\n".join([" ".join(body[:20]), " ".join(body[20:])])))
    docs += [(500, "two  WORDS!"), (501, "here are two words more"), (502, None), (503, "")]
    got = decontaminate.flag(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r.doc_id, k) for r in got.collect() for k in r["items"]}
    want = brute(docs, items)
    assert found <= want and len(want) > 20
    assert len(want - found) <= 0.02 * len(want)
    exact = {(d, k) for d, k in want if " ".join((dict(docs)[d] or "").split()).lower().find((dict(items)[k] or "").lower()) >= 0}
    assert exact <= found


def test_reordered_passages(spark):
    rng = random.Random(23)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(2000)]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(words(60 + i % 3))) for i in range(12)]
    docs = []
    for i in range(24):
        item, body = items[i % 12][1].split(), words(100 * (i % 3))
        cut = 30 if i < 12 else 12 + i
        docs.append((i, " ".join(body[: len(body) // 2] + item[cut:] + item[:cut] + body[len(body) // 2 :])))
    # a part of an item, 45 of its 56 shingles, alone and inside other words
    docs += [(100, " ".join(items[0][1].split()[:49])), (101, " ".join(words(80) + items[0][1].split()[:49] + words(80)))]
    got = decontaminate.flag(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert len(want) >= 25
    assert {(r.doc_id, k) for r in got.collect() for k in r["items"]} == want


def test_runs_are_all_windows_with_enough_places(spark):
    from pyspark.sql import functions as F

    rng = random.Random(2)
    rows = []
    for n in range(200):
        total = rng.randrange(1, 60)
        rows.append((n, sorted(rng.sample(range(total), rng.randrange(0, total + 1))), rng.randrange(1, 30), total))
    df = spark.createDataFrame(rows, "n int, ats array<int>, long int, total int")
    got = df.select("n", F.explode(decontaminate._runs(F.col("ats"), F.col("long"), F.col("total"), 0.8)).alias("r")).select("n", F.explode(F.sequence("r.first", "r.last"))).collect()
    want = []
    for n, ats, long, total in rows:
        size = min(long, total)
        want += [(n, s) for s in range(total - size + 1) if 2.0 * sum(s <= a < s + long for a in ats) / (size + long) >= 0.8]
    assert sorted(map(tuple, got)) == want


def test_shuffled_index_gives_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "well the quick brown fox jumps over the lazy dog again and again", 3), (2, "nothing of the kind is said in here", 4)], "doc_id long, text string, items int")
    a = [tuple(map(str, r)) for r in decontaminate.flag(docs, items).orderBy("doc_id").collect()]
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", 0)
    assert a == [tuple(map(str, r)) for r in decontaminate.flag(docs, items).orderBy("doc_id").collect()]
    assert [r[2:4] for r in a] == [("1", "[1]"), ("0", "[]")]


def test_odd_rows(spark):
    passage = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, passage), (1, passage), (2, passage.upper()), (None, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    rows = [(None, f"x {passage} y"), (7, passage), (7, passage), (7, "other text of the same id is clean"), (8, "z " * 100_000 + passage), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_items, list(r["items"])) for r in decontaminate.flag(docs, items).collect())
    assert got == [("7", 0, []), ("7", 2, [1, 2]), ("7", 2, [1, 2]), ("8", 2, [1, 2]), ("9", 0, []), ("None", 2, [1, 2])]
    assert decontaminate.flag(docs.limit(0), items).count() == 0
    assert all(r.n_items == 0 for r in decontaminate.flag(docs, items.limit(0)).collect())
