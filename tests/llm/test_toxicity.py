import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnwatch.llm import toxicity
from churnwatch.llm.common import held_out
from tests.conftest import SF01


def distance(a, b):
    """Edit distance in which a swap of two neighbours is one edit."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            best = min(new[-1] + 1, rows[-1][j] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[-2][j - 2] + 1)
            new.append(best)
        rows.append(new)
    return rows[-1][-1]


def test_swapped_neighbours():
    scorer = toxicity.Scorer({"scumbag": (False, 1.0)})
    for word in ("csumbag", "sucmbag", "scmubag", "scubmag", "scumabg", "scumbga"):
        assert scorer.match(word) == ("scumbag", False, 1, 1.0)
    assert scorer.match("csumbga") is None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=5, max_size=7), min_size=1, max_size=6, unique=True), st.text("abc", min_size=3, max_size=9))
def test_automaton_finds_what_edit_distance_finds(terms, word):
    scorer = toxicity.Scorer({t: (False, 1.0) for t in terms})
    got = scorer.trie.walk(word)
    best = min(distance(word, t) for t in terms)
    assert (got is not None) == (best <= 1)
    if got:
        assert got[2] == best and distance(word, got[0]) == best
        assert scorer.candidate(word)  # the prefilter loses nothing


def test_stems_and_context():
    s = toxicity.Scorer({"lowei": (True, 1.0), "idiot": (False, 1.0), "scum": (False, 1.0)})
    assert [h[1:4] for h in s.hits("loweitum idiott scun scum idot")] == [("loweitum", True, 0), ("idiott", False, 1), ("scum", False, 0), ("idot", False, 1)]
    direct, quoted = s.features("you are an idiot and more"), s.features('they said "idiot" and more')
    assert direct[0] > quoted[0] and quoted[3] > direct[3] and direct[4] > quoted[4]
    assert not s.features(None).any() and not s.features("").any()


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    scorer = toxicity.train(docs, labels, lambda i: ~held_out(i))
    got = toxicity.score(docs, scorer).join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    toxic, clean = [r.score for r in got if r.toxic == 1], [r.score for r in got if r.toxic == 0]
    assert np.mean([s >= 0.7 for s in toxic]) >= 0.85 and np.mean([s < 0.7 for s in clean]) >= 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (None, "idiot " * 3, 1), (2, "", 1), (2, "", 1), (3, "x" * 100_000 + " idiot", 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 0)], "doc_id long, toxic int")
    scorer = toxicity.train(docs, labels, lambda i: F.lit(True))
    got = toxicity.score(docs, scorer).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(docs.limit(0), scorer).count() == 0
    assert toxicity.train(docs.limit(0), labels.limit(0), lambda i: F.lit(True)).terms == {}
