import random

from churnwatch.llm import templates


def test_templates_generalise_one_band(spark):
    rng = random.Random(5)
    vocab = [f"w{c}{d}" for c in "abcdefgh" for d in "abcdefgh"]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, notice = words(60), "All rights are reserved by the owner of this site".split()
    docs = []
    for i in range(30):
        own = [" ".join(words(12)) for _ in range(6)]
        if i < 5:  # one word of the passage varies, always in the last quarter
            varied = passage[:]
            varied[50 + i] = "other"
            own.insert(i, " ".join(varied))
        if i % 3 == 0:
            own.append("  ".join(notice))
        if i in (7, 8, 9, 10):
            own.append(f"session {i}0{i} opened for user u{i}@x.org at 12:0{i} from host abc")
        docs.append((i, "\n".join(own), "s"))
    copy = "\n".join(" ".join(words(15)) for _ in range(8))
    docs += [(100 + i, copy.replace(copy.split()[i * 3], "edited", 1), "s") for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_dropped string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in templates.drop_lines(df, min_docs=3).collect()}
    before = {d[0]: d[1] for d in docs}
    for i in range(30):
        gone = (i < 5) + (i % 3 == 0) + (i in (7, 8, 9, 10))
        assert got[i][1] == gone
        left = [l for k, l in enumerate(before[i].split("\n")) if not (i < 5 and k == i) and "reserved" not in l and not l.startswith("session")]
        assert got[i][0] == "\n".join(left)
    # near copies of one document are no evidence against its lines
    assert all(got[100 + i] == (before[100 + i], 0) for i in range(12))


def test_odd_rows(spark):
    line = "this very line is long enough to count as one"
    rows = [(1, None, 1), (2, "", 1), (None, line + "\r\nunlike the others in every way there is", 1), (4, line + "\n\nand this has words of its own too", 1), (5, line + "\nsomething else that nobody else has said before", 1), (5, line + "\nsomething else that nobody else has said before", 1), (6, "x " * 50_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, words int")
    got = sorted(((r.doc_id or 0), r.text, r.n_dropped) for r in templates.drop_lines(df).collect() if r.doc_id != 1)
    assert got[0] == (0, "unlike the others in every way there is", 1)
    assert got[2:5] == [(4, "\nand this has words of its own too", 1)] + [(5, "something else that nobody else has said before", 1)] * 2
    assert got[1] == (2, "", 0) and got[5][1:] == ("x " * 50_000, 0)
    assert templates.drop_lines(df.limit(0)).count() == 0
    assert [r.text for r in templates.drop_lines(df.where("doc_id = 1")).collect()] == [None]


def test_document_of_recurring_lines_alone_stays_whole(spark):
    notice = "please read this notice before you go on with anything"
    rng = random.Random(3)
    own = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(12))
    rows = [(i, f"{notice}\n{own()}\n{own()}") for i in range(5)]
    rows += [(8, f"\n{notice}\n ")]
    got = {r.doc_id: (r.text, r.n_dropped) for r in templates.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[8] == (f"\n{notice}\n ", 0)
    assert all(notice not in got[i][0] and got[i][1] == 1 for i in range(5))


def test_passage_counts_however_much_of_its_documents_it_makes_up(spark):
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    common, pair, lone = words(60), words(60), words(60)
    own = [[words(rng.randint(15, 40)), words(9)] for _ in range(52)]
    rows = [(i, "\n".join([own[i][0], common, own[i][1]])) for i in range(50)]
    rows += [(i, "\n".join([pair, *own[i]])) for i in (50, 51)]
    body = [words(15) for _ in range(6)]
    rows += [(60 + i, "\n".join([lone, *body])) for i in range(4)]  # copies of one document
    rows += [(70, lone)]
    got = {r.doc_id: (r.text, r.n_dropped) for r in templates.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == ("\n".join(own[i]), 1) for i in range(52))
    assert all(got[i] == (t, 0) for i, t in rows if i >= 60)
