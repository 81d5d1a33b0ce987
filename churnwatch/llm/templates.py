"""Line dedup with a log-template tree, in DataFrame operations alone.

A line walks a tree of fixed depth: token count, then its first ``LEAD`` tokens, then its
body. Tokens with digits, addresses and links are variable fields from the start. The body of
a line with ``WIDE`` or more tokens behind the lead is cut into four bands, and one band
may vary: the line has four templates, each with another band open. A shorter line has
one template, all its tokens. A template that recurs across documents is dropped from all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwatch.llm.common import WORD, bind, unused
from churnwatch.session import cut_lineage

LEAD, BANDS, WIDE = 3, 4, 8
MIN_DOCS = 3  # documents that a template of LONG tokens or more must recur in
MIN_DOCS_SHORT, LONG = 10, 6  # shorter lines recur by chance
MIN_DOCS_PASSAGE, PASSAGE = 2, 50  # a passage of so many tokens never does
COPY_SHARE = 0.6  # a document is no evidence about a line if this share of its other words is found elsewhere too
LINE_END = r"\r?\n"
VARIABLE = r"[0-9@]|://"


def row_key(key: str, text: str, names: tuple[str, str] | list[str] = ("_a", "_b")) -> list[Column]:
    """Two hashes, called ``names``, that stand for a document by key and text: null keys are defined, equal rows are one document."""
    both = [F.col(f"`{key}`"), F.col(f"`{text}`")]
    return [F.xxhash64(*both).alias(names[0]), F.xxhash64(F.lit(1), *both).alias(names[1])]


def line_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_a, _b, line, words, templates``: one row per non-blank line with its one or four templates."""
    whole = docs.select(*row_key(key, text), F.split(F.col(f"`{text}`"), LINE_END).alias("all"))
    lines = whole.select("_a", "_b", F.posexplode_outer("all").alias("line", "s"))  # outer: no filter that splits once more
    # one kind of space first, so that tokens are split at a plain character
    spaced = lines.select("_a", "_b", "line", F.translate("s", "\t\x0b\x0c\r", "    ").alias("s")).where(F.trim("s") != "")
    every = F.array_remove(F.split("s", " "), "")
    masked = F.transform(every, lambda t: F.when(t.rlike(VARIABLE), F.lit("<*>")).otherwise(t))
    tokens = spaced.select("_a", "_b", "line", F.when(F.col("s").rlike(VARIABLE), masked).otherwise(every).alias("t"))
    n = F.size("t")
    body = n - LEAD
    bounds = [F.floor(body * k / BANDS).cast("int") + LEAD for k in range(BANDS + 1)]
    wide = body >= WIDE

    def part(start: Column, length: Column) -> Column:
        return F.when(wide, F.xxhash64(F.slice("t", start, length)))

    hashes = tokens.select(
        "_a", "_b", "line", n.alias("words"), F.when(~wide, F.xxhash64(n, "t")).alias("whole"), part(F.lit(1), F.lit(LEAD)).alias("lead"),
        *[part(bounds[k] + 1, bounds[k + 1] - bounds[k]).alias(f"band{k}") for k in range(BANDS)],
    )
    open_band = [F.xxhash64("words", "lead", F.lit(k), *[f"band{j}" for j in range(BANDS) if j != k]) for k in range(BANDS)]
    found = F.when(F.col("whole").isNull(), F.array(*open_band)).otherwise(F.array("whole"))
    return hashes.select("_a", "_b", "line", "words", found.alias("templates"))


def recurring_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_docs_short: int = MIN_DOCS_SHORT) -> DataFrame:
    """``_a, _b, lines``: per document the places (from 0) of its lines whose template recurs.

    A template counts the documents that hold it and are otherwise different: the rest of
    the document, without the line itself, has words, and less than ``COPY_SHARE`` of them
    stand in lines found elsewhere. A copy's other lines are found where the first one was,
    so it is no evidence: the document as a whole is repeated, which near-duplicate removal
    has to settle. A passage counts however much of its documents it makes up.
    Counts are combined before each shuffle; a very common line is a skewed join key,
    which adaptive execution splits.
    """
    table = cut_lineage(line_table(docs, key, text), "line-templates")
    doc = ["_a", "_b"]
    single = table.select(*doc, "line", "words", F.explode("templates").alias("template"))
    # two documents or more: smallest and largest differ, which needs one row per template
    shared = single.groupBy("template").agg(F.min("_a").alias("least"), F.max("_a").alias("most")).where("least <> most").select("template")
    repeated = cut_lineage(single.join(shared, "template"), "line-repeated")

    def words_of(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*doc, "line").agg(F.max("words").alias("words")).groupBy(*doc).agg(F.sum("words").alias(name))

    rest, found = F.col("all_words") - F.col("words"), F.col("found") - F.col("words")
    sums = words_of(table, "all_words").join(words_of(repeated, "found"), doc)
    evidence = repeated.join(sums, doc).where((rest > 0) & (found < COPY_SHARE * rest))
    needed = F.when(F.col("words") >= PASSAGE, F.lit(min(min_docs, MIN_DOCS_PASSAGE))).when(F.col("words") >= LONG, F.lit(min_docs)).otherwise(F.lit(min_docs_short))
    dropped = evidence.groupBy("template", "words").agg(F.count_distinct("_a").alias("docs")).where(F.col("docs") >= needed)
    lines = repeated.join(dropped.select("template"), "template").select(*doc, "line").distinct()
    return lines.groupBy(*doc).agg(F.sort_array(F.collect_list("line")).alias("lines"))


def drop_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", size: str | None = None, min_docs: int = MIN_DOCS, min_docs_short: int = MIN_DOCS_SHORT) -> DataFrame:
    """The documents without their recurring lines: same columns and rows plus ``n_dropped``, the text changed.

    ``size`` names a column to refill with the new length. Null and empty texts stay as they are; a
    document of nothing but recurring lines stays whole, since near-duplicate removal has to settle it; equal rows (key and text)
    count as one document and change alike; a null key is a key; other columns pass
    through; an empty table gives no rows. Texts without a recurring line come back
    exactly as they were.
    """
    drops = cut_lineage(recurring_lines(docs, key, text, min_docs, min_docs_short), "line-drops")
    a, b, gone, left = unused([*docs.columns, "n_dropped"], "_a", "_b", "_lines", "_kept")
    named = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "n_dropped"], *row_key(key, text, (a, b)))
    joined = named.join(drops.toDF(a, b, gone), [a, b], "left")

    def rest(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    joined = joined.withColumn(left, F.when(F.col(gone).isNotNull(), bind(F.split(F.col(f"`{text}`"), LINE_END), rest)))
    whole = ~F.coalesce(F.col(left).rlike(WORD), F.lit(False))
    new = F.when(whole, F.col(f"`{text}`")).otherwise(F.col(left))
    out = []
    for c in docs.columns:
        if c == text:
            out.append(new.alias(c))
        elif c == size:
            out.append(F.when(whole, F.col(f"`{c}`")).otherwise(F.length(new)).cast(docs.schema[c].dataType).alias(c))
        elif c != "n_dropped":
            out.append(F.col(f"`{c}`"))
    return joined.select(*out, F.when(whole, 0).otherwise(F.size(gone)).cast("long").alias("n_dropped"))
