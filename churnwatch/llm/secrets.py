"""Secret scans: fixed patterns, and a guess-cost search over values in credential contexts.

The guess cost of a value is the logarithm (base 10) of the guesses needed by the
cheapest way to segment it into words, dates, repeats, keyboard walks, sequences and
brute-force spans, found by dynamic programming. Values that cost ``MIN_COST`` or more
are secrets; placeholders such as ``changeme2020`` are not. Words cost their rank: frequent
password words are a fixed list, all others are ranked by the documents that hold them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnwatch.session import cut_lineage, ready_python

KINDS = ["assign", "access", "hex", "guess"]
MIN_COST = 8.0
MIN_WORD, MAX_WORD = 3, 24  # lengths of words looked up
WORD_DOCS = 5  # documents that a ranked word is in, at least; rarer ones would cost as much as brute force
# a word stands alone, between blanks or punctuation, and is no value behind a sign
PLAIN_WORD = rf"(?<![^\s\"'(\[])(?<![:=][\"'(\[\x20]{{0,2}})\p{{L}}{{{MIN_WORD},{MAX_WORD}}}(?![^\s.,;:!?\"')\]])"
PARTS_AT_ONCE = 1 << 15  # candidate words handed on at once
LONG_VALUE = 256  # repeats of longer values are found by hashes instead of the pattern
PAIRS = 1 << 18  # places compared at once in the search for repeats
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # maximal runs, so the same matches as the open run with a length test
HEX = re.compile(r"[0-9a-f]{24,}")
SIGN = re.compile(r"[:=]")
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|signing|encryption)[_-]?key|auth(?:orization)?|credentials?|login)[\"']?[\x20\t]*\Z",
    re.A | re.I,
)
VALUE = re.compile(r"[\x20\t]*(?:(?:bearer|basic)[\x20\t]+)?[\"']?([^\s\"'`<>,;()]{6,})", re.A | re.I)
LOOK_BACK = 16  # at least the longest word of CONTEXT and a quotation mark; blanks before the sign are passed over first

# FIXED VALUES: frequent password words, most frequent first
COMMON = """password admin welcome letmein qwerty monkey dragon master login princess sunshine football baseball shadow
superman michael jordan hunter killer trustno batman soccer hockey harley ranger george summer winter spring autumn
computer michelle jessica pepper freedom ginger cookie flower orange banana cheese secret token access server oracle
system manager guest root test user example sample demo changeme default public private internal temporary temp null
none undefined placeholder your here insert replace redacted hidden dummy fake foo bar baz hello world love angel money
diamond silver golden purple yellow green blue black white tiger lion eagle falcon phoenix matrix star wars magic
london paris berlin january february march april june july august september october november december monday friday
company office database backup config service application google amazon internet network windows linux apple key value
string text word pass code pin name mail email home work school""".split()
RANK = {w: i + 1 for i, w in reversed(list(enumerate(COMMON)))}
# FIXED VALUES: character substitutions, and the rows of a keyboard
LEET = str.maketrans("4@831!|0$57+2", "aabeiiiossttz")
ROWS = ["`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./"]
DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d"
)

LETTERS = re.compile(r"[^\W\d_]{%d,}" % MIN_WORD)
REPEAT = re.compile(r"(.+?)\1+", re.S)


def _adjacent() -> dict[tuple[str, str], tuple[int, int]]:
    """Direction of each step between neighbouring keys; a row is set off half a key from the one above."""
    at = {c: (r, i) for r, row in enumerate(ROWS) for i, c in enumerate(row)}
    steps = {(0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)}
    return {(a, b): d for a, (r, i) in at.items() for b, (q, j) in at.items() if (d := (q - r, j - i)) in steps}


NEAR = _adjacent()


def _class(c: str) -> int:
    return 10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100


def _runs(labels: list) -> Iterator[tuple[int, int]]:
    """Spans of 3 or more characters whose steps (``labels[i]`` leads to character i) all have one same label."""
    start = 0
    for i in range(1, len(labels) + 1):
        if i == len(labels) or labels[i] is None or (i - 1 > start and labels[i] != labels[i - 1]) or (i - 1 == start and labels[i] is None):
            if i - start >= 3:
                yield start, i
            start = i if i == len(labels) or labels[i] is None else i - 1


def _repeats(value: str) -> list[tuple[int, int, int]]:
    """``start, end, unit`` of what ``REPEAT`` matches at each character, in n log^2 n steps.

    A square of unit u holds a multiple p of u in its first half; how far the texts at p and
    p + u agree to both sides, by hashes of prefixes, gives the starts of all squares around p.
    """
    n = len(value)
    points = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), dtype="<u4").tolist()
    tables = []
    for mod, base in (((1 << 31) - 1, 1_000_003_019 % ((1 << 31) - 1)), ((1 << 31) - 19, 911_382_323)):
        sums, powers = [0], [1]
        for c in points:
            sums.append((sums[-1] * base + c + 1) % mod)
            powers.append(powers[-1] * base % mod)
        tables.append((np.uint64(mod), np.array(sums, np.uint64), np.array(powers, np.uint64)))

    def same(a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), dtype=bool)
        for mod, sums, powers in tables:
            x = (sums[a + size] + mod - sums[a] * powers[size] % mod) % mod
            y = (sums[b + size] + mod - sums[b] * powers[size] % mod) % mod
            out &= x == y
        return out

    def agree(a: np.ndarray, b: np.ndarray, most: np.ndarray, side: int) -> np.ndarray:
        """How many characters agree from a and b on (side 1) or before them (side -1), at most ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            back = mid if side < 0 else 0
            ok = same(a - back, b - back, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    unit = np.zeros(n, np.int64)
    first = 1
    while first <= n // 2:  # units in ascending order, about ``PAIRS`` pairs of places at a time
        units, pairs = [], 0
        while first <= n // 2 and pairs < PAIRS:
            units.append(first)
            pairs += n // first
            first += 1
        p = np.concatenate([np.arange(0, n - u, u) for u in units])
        u = np.repeat(units, [len(range(0, n - u, u)) for u in units])
        ahead = agree(p, p + u, np.minimum(u, n - u - p), 1)
        behind = agree(p, p + u, np.minimum(u - 1, p), -1)
        hit = ahead + behind >= u
        for a, b, k in zip((p - behind)[hit].tolist(), (p + ahead - u + 1)[hit].tolist(), u[hit].tolist()):
            own = unit[a:b]
            own[own == 0] = k
    at = np.nonzero(unit)[0]
    u = unit[at]
    ends = at + u * (1 + agree(at, at + u, n - at - u, 1) // u)
    return [(i, j, k) for i, j, k in zip(at.tolist(), ends.tolist(), u.tolist()) if j - i >= 3]


def guess_cost(value: str, ranks: dict[str, int] = RANK, known: dict[str, float] | None = None) -> float:
    """Log10 of the guesses of the cheapest segmentation of ``value``.

    ``ranks`` holds at least every ranked word that is part of ``value`` in one of the forms of ``word_forms``.
    ``known`` remembers costs of repeated units under the same ranks.
    """
    known = {} if known is None else known
    if value not in known:
        known[value] = _cost(value, ranks, known)
    return known[value]


def word_forms(value: str) -> list[str]:
    """The texts whose parts may be words: in small letters, without substitutions, and backwards."""
    low = _low(value)
    return [low, low.translate(LEET), low[::-1]]


def _low(value: str) -> str:
    """Small letters, one for one, so that places stay."""
    return "".join(c if len(c.lower()) != 1 else c.lower() for c in value)


def _cost(value: str, ranks: dict[str, int], known: dict[str, float]) -> float:
    n = len(value)
    low, plain, _ = word_forms(value)
    spans: dict[tuple[int, int], float] = {}

    def offer(i: int, j: int, cost: float) -> None:
        spans[i, j] = min(cost, spans.get((i, j), math.inf))

    for i in range(n):
        for j in range(i + MIN_WORD, min(n, i + MAX_WORD) + 1):
            rank = ranks.get(low[i:j])
            if rank is None and (rank := ranks.get(plain[i:j])) is not None:
                rank *= 2 ** min(4, sum(a != b for a, b in zip(low[i:j], plain[i:j])))
            if rank is None and (back := ranks.get(low[i:j][::-1])) is not None:
                rank = 2 * back
            if rank is not None:
                upper = sum(a != b for a, b in zip(value[i:j], low[i:j]))
                offer(i, j, math.log10(rank + 1) + (0 if not upper else 0.3 if upper in (1, j - i) else 0.3 * upper))
    for i in range(n):
        if m := DATE.match(value, i):
            offer(i, m.end(), math.log10(365 * 120 if m.end() - i > 4 else 120) + (0.6 if m.end() - i > 8 else 0))
            if m.end() - i > 4 and value[i : i + 2] in ("19", "20"):
                offer(i, i + 4, math.log10(120))
    rises = [None] + [d if (d := ord(b) - ord(a)) in (1, -1) else None for a, b in zip(low, low[1:])]
    for i, j in _runs(rises):
        offer(i, j, math.log10(2 * _class(value[i]) * (j - i)))
    moves = [None] + [NEAR.get(step) for step in zip(low, low[1:])]
    for i, j in _runs([None if m is None else True for m in moves]):
        turns = sum(moves[k] != moves[k + 1] for k in range(i + 1, j - 1))
        offer(i, j, math.log10(47 * (j - i)) + turns * math.log10(3))
    best = [0.0] + [math.inf] * n
    brute = [math.inf] * (n + 1)  # cheapest when the last character is inside a brute-force span
    if n > LONG_VALUE:
        repeats = _repeats(value)
    else:
        repeats = [(i, m.end(), len(m[1])) for i in range(n) if (m := REPEAT.match(value, i)) and m.end() - i >= 3]
    ends: dict[int, list[tuple[int, float]]] = {}
    for (i, j), cost in spans.items():
        ends.setdefault(j, []).append((i, cost))
    for i, j, unit in repeats:
        if unit < 3 or unit == n:
            base = unit * math.log10(_class(value[i]))
        else:
            base = guess_cost(value[i : i + unit], ranks, known)
        ends.setdefault(j, []).append((i, base + math.log10((j - i) // unit)))
    for j in range(1, n + 1):
        brute[j] = min(best[j - 1] + (0.3 if j > 1 else 0), brute[j - 1]) + math.log10(_class(value[j - 1]))
        best[j] = min([brute[j], *(best[i] + cost + (0.3 if i else 0) for i, cost in ends.get(j, ()))])
    return best[n]


_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def candidates(text: str) -> list[tuple[str, int, int, str | None]]:
    """``kind, start, end, value`` in code points, by start, then kind as in ``KINDS``; ``value`` is what a guess cost is asked of."""
    out: list[tuple[str, int, int, str | None]] = []
    signs = ":" in text or "=" in text
    if signs:
        low = text.lower()
        if any(h in low for h in _HINTS):
            out += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), None) for m in HEX.finditer(text)]
    if signs:
        for m in SIGN.finditer(text):
            end = m.start()
            while end and text[end - 1] in " \t":
                end -= 1
            if CONTEXT.search(text[max(0, end - LOOK_BACK) : end]) and (v := VALUE.match(text, m.end())):
                out.append(("guess", v.start(1), v.end(1), v[1]))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def spans_of(text: str, min_cost: float = MIN_COST, ranks: dict[str, int] = RANK) -> list[tuple[str, int, int, float | None]]:
    """Spans ``kind, start, end, cost`` of one text: all base spans, and values that cost ``min_cost`` or more."""
    priced = [(k, a, b, None if v is None else guess_cost(v, ranks)) for k, a, b, v in candidates(text)]
    return [s for s in priced if s[0] != "guess" or s[3] >= min_cost]


def word_ranks(docs: DataFrame, text: str = "text", min_docs: int = WORD_DOCS) -> DataFrame:
    """``word, rank``: words of the documents by how many hold them, counts combined before the shuffle.

    Words whose counts lie within a twelfth of each other share the rank of the last of
    them, so ranks come from a table of at most some hundred levels and no sort is global.
    """
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(f"`{text}`").cast("string")), F.lit(PLAIN_WORD), F.lit(0)))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    levels = cut_lineage(counts.select("word", F.floor(8 * F.log2("docs")).cast("int").alias("level")), "secret-words")
    upto = levels.groupBy("level").agg(F.count("*").alias("n")).select("level", F.sum("n").over(Window.orderBy(F.col("level").desc())).alias("rank"))
    return levels.join(F.broadcast(upto), "level").select("word", "rank")  # one row per level


def value_costs(values: DataFrame, words: DataFrame) -> DataFrame:
    """``value, cost`` of every distinct ``value``: the parts of a value are joined with the words, at any number of either."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []

            def made() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(found, pa.string())], names=["id", "word"])
                ids.clear(), found.clear()
                return out

            for id_, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for form in word_forms(value):
                    for m in LETTERS.finditer(form):
                        for i in range(m.start(), m.end() - MIN_WORD + 1):
                            ends = range(i + MIN_WORD, min(m.end(), i + MAX_WORD) + 1)
                            found.extend(form[i:j] for j in ends)
                            ids.extend([id_] * len(ends))
                            if len(ids) >= PARTS_AT_ONCE:
                                yield made()
            yield made()

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = []
            for value, ranked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ranks = dict(RANK)
                for one in ranked or ():
                    ranks[one["word"]] = min(one["rank"], ranks.get(one["word"], one["rank"]))
                costs.append(guess_cost(value, ranks))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(costs, pa.float64())], names=["value", "cost"])

    distinct = cut_lineage(values.select("value").distinct().select(F.unhex(F.sha2("value", 256)).alias("id"), "value"), "secret-values")
    # never broadcast: the planner takes the parts for as large as their values, and they are a hundred times that
    held = distinct.mapInArrow(parts, "id binary, word string").distinct().join(words.hint("merge"), "word")
    ranked = held.groupBy("id").agg(F.collect_list(F.struct("word", "rank")).alias("ranked"))
    return distinct.join(ranked, "id", "left").select("value", "ranked").mapInArrow(price, "value string, cost double")


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", min_cost: float = MIN_COST, words: DataFrame | None = None) -> DataFrame:
    """``key, spans``: all spans of every whole text, one row per input row.

    Words are ranked by ``words`` (``word, rank``), by default those of the documents themselves. Texts are
    read once for spans and once for words and not shuffled; only values, their parts and spans are.
    Null and empty texts have no spans; repeated rows and null keys come back as they are;
    other columns are not read; an empty table gives no rows.
    """
    ready_python(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    fields = ("kind", "start", "end", "value")
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(fields, s)) for s in candidates(t.as_py() or "")] for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, item)], names=["id", "a", "b", "found"])

    whole = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(whole).alias("a"), F.xxhash64(F.lit(1), whole).alias("b"), whole.alias("text"))
    found = cut_lineage(rows.mapInArrow(run, f"id {kind}, a long, b long, found array<struct<kind:string,start:long,end:long,value:string>>"), "secret-candidates")
    # equal texts have equal spans: each is priced once
    spans = found.where(F.size("found") > 0).dropDuplicates(["a", "b"]).select("a", "b", F.posexplode("found").alias("place", "s"))
    spans = spans.select("a", "b", "place", "s.*")
    costs = value_costs(spans.where("value is not null"), word_ranks(docs, text) if words is None else words)
    priced = spans.join(costs, "value", "left").where((F.col("kind") != "guess") | (F.col("cost") >= min_cost))
    ordered = F.sort_array(F.collect_list(F.struct("place", F.struct("kind", "start", "end", "cost").alias("span"))))
    by_text = priced.groupBy("a", "b").agg(F.transform(ordered, lambda s: s["span"]).alias("spans"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,cost:double>>")
    return found.select("id", "a", "b").join(by_text, ["a", "b"], "left").select(F.col("id").alias(key), F.coalesce("spans", none).alias("spans"))
