import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnwatch.llm import queries, secrets
from tests.conftest import SF01

BASE = [
    ("assign", re.compile("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")),
    ("access", re.compile("AKIA[A-Z0-9]+")),
    ("hex", re.compile("[0-9a-f]+")),
]


def brute_base(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            if (kind == "assign" and len(m[2]) >= 6) or (kind == "access" and len(m[0]) >= 20) or (kind == "hex" and len(m[0]) >= 24):
                out.append((m.start(), rank, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def test_query_matches_brute_force(spark):
    got = {r.doc_id: r for r in queries.op4_guess_cost_secrets(spark, SF01).collect()}
    docs = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        base = brute_base(d.text)
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        r = got[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        for kind in ("assign", "access", "hex"):
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        assert [x for x in r.spans.split(",") if x and not x.startswith("guess")] == [x for x in line.split(",") if x]
    assert sum(r.n_guess for r in got.values()) > 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "PASSWD", "ſecret", "api_key", "ApiKey", "token", ":", "=", " ", "\"", "'", "AKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "deadbeef" * 3, "ab", "é", "\n", "x.y=z", "hunter2", "toKen"]), max_size=14))
def test_spans_of_odd_texts(parts):
    text = "".join(parts)
    assert [s[:3] for s in secrets.spans_of(text) if s[0] != "guess"] == brute_base(text)


def brute_cost(value):
    """All segmentations of a short value into dictionary words and brute-force spans (no other pattern applies)."""
    import math
    from functools import lru_cache

    @lru_cache(None)
    def best(i, first):
        if i == len(value):
            return 0.0
        out = math.inf
        for j in range(i + 1, len(value) + 1):
            sep = 0 if first else 0.3
            piece = value[i:j]
            out = min(out, sep + sum(math.log10(secrets._class(c)) for c in piece) + best(j, False))
            if piece in secrets.RANK and len(piece) >= 3:
                out = min(out, sep + math.log10(secrets.RANK[piece] + 1) + best(j, False))
        return out

    return best(0, True)


def test_guess_cost():
    for v in ["password", "passwordx", "zdragonq", "qxzvkw", "monkeymaster", "summerjf"]:
        assert abs(secrets.guess_cost(v) - brute_cost(v)) < 1e-9, v
    cheap = ["password1", "changeme2020", "qwertyuiop", "aaaaaaaaaaaa", "abcabcabcabc", "20240131", "P@ssw0rd", "abcdefghij", "admin123", "12345678"]
    dear = ["xK9vQ2mLp7Zr", "9f8a7s6d5f4g3h2j1k", "Tr7gHq2wZx81", "wJalrXUtnFEMI/K7MDENG"]
    assert max(map(secrets.guess_cost, cheap)) < secrets.MIN_COST <= min(map(secrets.guess_cost, dear))


def test_long_values_are_segmented():
    rng = random.Random(4)
    cheap = ["changeme" * 40, "abcd" * 100, "password" * 33 + "1", "a" * 5000]
    assert max(map(secrets.guess_cost, cheap)) < secrets.MIN_COST
    irregular = "".join(rng.choice("xy1") for _ in range(300))
    assert secrets.guess_cost(irregular) >= secrets.MIN_COST
    assert [s[0] for s in secrets.spans_of("pwd = " + irregular)] == ["guess"]
    assert secrets.spans_of("pwd = " + cheap[0]) == []


def test_repeats_are_those_of_the_pattern():
    rng = random.Random(9)
    for _ in range(150):
        parts = ["".join(rng.choice("abc"[: rng.randrange(1, 4)]) for _ in range(rng.randrange(1, 12))) * rng.randrange(1, 5) for _ in range(rng.randrange(1, 7))]
        value = "".join(parts)
        want = [(i, m.end(), len(m[1])) for i in range(len(value)) if (m := secrets.REPEAT.match(value, i)) and m.end() - i >= 3]
        assert secrets._repeats(value) == want, value


def test_context(spark):
    rows = [(1, "db pwd = 'xK9vQ2mLp7Zr' ok", 0), (2, "pwd=changeme2020", 0), (3, "ratio: xK9vQ2mLp7Zr", 0), (4, None, 0), (None, "", 0), (5, "Authorization: Bearer xK9vQ2mLp7Zr" * 1, 0), (5, "Authorization: Bearer xK9vQ2mLp7Zr", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = sorted(((r.doc_id or 0), [(s.kind, s.start, s.end) for s in r.spans]) for r in secrets.find_secrets(df).collect())
    assert got == [(0, []), (1, [("guess", 10, 22)]), (2, []), (3, []), (4, []), (5, [("guess", 22, 34)]), (5, [("guess", 22, 34)])]
    assert secrets.find_secrets(df.limit(0)).count() == 0
    long = "x" * 300000 + " token: abcdefgh12 " + "0" * 300000
    assert [s[0] for s in secrets.spans_of(long) if s[0] != "guess"] == ["assign", "hex"]


def test_context_behind_any_number_of_blanks(spark):
    value = "xK9#mQ2$vL7!zR"
    for blanks in ("", " " * 6, " " * 60, " \t" * 5000):
        for word in ("password", "authorization", "encryption_key'"):
            text = f"the {word}{blanks}: {value}"
            assert [(k, text[a:b]) for k, a, b, _ in secrets.spans_of(text) if k == "guess"] == [("guess", value)]
    assert not [s for s in secrets.spans_of(f"password and then: {value}") if s[0] == "guess"]
    docs = spark.createDataFrame([(1, f"token = {value}")], "`doc.id` long, `the.text` string")
    found = secrets.find_secrets(docs, "doc.id", "the.text")
    assert found.columns == ["doc.id", "spans"] and [s.kind for s in found.first()["spans"]] == ["guess"]


def test_words_are_ranked_by_the_documents(spark):
    import math
    from collections import Counter

    rng = random.Random(6)
    vocab = ["butterfly", "garden", "elephant", "giraffe", "Straße", *("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 5))) for _ in range(300))]
    texts = [" ".join(rng.choices(vocab, [1 / (1 + i) for i in range(len(vocab))], k=40)).capitalize() + "." for _ in range(200)]
    texts += ["xqzvkwpl9 wqzxkvjp_ token=zqxwvkjy token: zqxwvkjy, token = \"zqxwvkjw\" a.zqxwvkjp"] * 9  # no words: beside digits or signs, or values
    values = ["butterflygarden", "elephantGIRAFFE", "yfl\u0131rettub", "nedrag2020", "g@rd3nelephant", "xK9vQ2mLp7Zr", "straßegarden", "\u0130stanbul\u0130x"]
    docs = [(i, t) for i, t in enumerate([*texts, *(f"my password: {v}" for v in values)])] + [(None, None), (None, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    ranks = {r.word: r["rank"] for r in secrets.word_ranks(df).collect()}
    count = Counter(w for t in texts[:200] for w in set(t.lower().rstrip(".").split()))
    assert {w for w in ranks if w not in ("token", "password")} == {w for w, n in count.items() if n >= secrets.WORD_DOCS and len(w) >= 3}
    level = lambda w: math.floor(8 * math.log2(count[w]))
    known = [w for w in ranks if count[w]]
    for w in known:
        above = sum(level(v) >= level(w) for v in known)
        assert above <= ranks[w] <= above + 2  # "token" and "password" may be above
    every = {**ranks, **{w: min(r, ranks.get(w, r)) for w, r in secrets.RANK.items()}}
    got = {r.doc_id: [(s.kind, s.start, s.end, s.cost) for s in r.spans] for r in secrets.find_secrets(df).collect()}
    assert all(got[i] == secrets.spans_of(t or "", ranks=every) for i, t in docs if i is not None)
    costs = {v: secrets.guess_cost(v, every) for v in values}
    assert costs["butterflygarden"] < secrets.MIN_COST <= secrets.guess_cost("butterflygarden")
    assert costs["xK9vQ2mLp7Zr"] == secrets.guess_cost("xK9vQ2mLp7Zr") >= secrets.MIN_COST
    assert costs["g@rd3nelephant"] < secrets.guess_cost("g@rd3nelephant") and costs["nedrag2020"] < secrets.MIN_COST


def test_parts_of_values_are_joined_by_a_shuffle(spark):
    rng = random.Random(8)
    values = ["".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(300)] + ["butterflygarden", "xK9vQ2mLp7Zr", "g@rd3n1", "a:b", "g@rd3n1"]
    ranks = {"butterfly": 40, "garden": 25, "abcd": 3}
    words = spark.createDataFrame(list(ranks.items()), "word string, rank long")
    costs = secrets.value_costs(spark.createDataFrame([(v,) for v in values], "value string"), words)
    got = sorted(map(tuple, costs.collect()))
    every = {**ranks, **{w: min(r, ranks.get(w, r)) for w, r in secrets.RANK.items()}}
    assert got == sorted((v, secrets.guess_cost(v, every)) for v in set(values))
    # the planner takes the parts for as small as the values, so it would broadcast them at any number
    joins = re.findall(r"(\w+Join)(?:\(skew=true\))? \[word#", costs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
    assert joins == ["SortMergeJoin"], joins
