"""Registered queries of this subpackage: ``opN_<name>`` each apply one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwatch.llm import ann, chat, decontaminate, importance, langid, mixing, pieces, secrets, simhash, templates, toxicity, warc, whitening
from churnwatch.llm.common import held_out, read
from churnwatch.session import cut_lineage


def op1_kneser_ney_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.train(docs, lambda i: ~held_out(i))
    found = langid.identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected", "entropy")


def op2_one_bit_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op3_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = templates.drop_lines(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_dropped", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op4_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents"))

    def line(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select("doc_id", *map(count, secrets.KINDS), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op5_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.flag(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_items", F.concat_ws(",", F.transform("items", lambda i: i.cast("string"))).alias("item_ids"), "similarity")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scorer = toxicity.train(docs, read(spark, sf_dir, "labels"), lambda i: ~held_out(i))
    found = toxicity.score(docs, scorer)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "has_hit")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select(*extra.columns).unionByName(extra)
    return chat.digests(cut_lineage(chat.format_conversations(rows), "chat"))


def op8_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html", F.concat_ws(":", "_metadata.file_path", "_metadata.row_index").alias("row"))
    captures = warc.round_trip(spark, pages, F.col("row"))
    return captures.select(
        "page_id", F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"), F.col("refers_to_page").alias("refers_to"),
    )


def op9_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_to_targets(read(spark, sf_dir, "documents"))


def op10_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op12_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode(read(spark, sf_dir, "documents"), ["doc_id"], decoded="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        F.xxhash64("begins", "ends").alias("spans_xxh64"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_kneser_ney_langid,
        op2_one_bit_nearest,
        op3_template_tree,
        op4_guess_cost_secrets,
        op5_simhash_windows,
        op6_toxicity,
        op7_chat_format,
        op8_warc_transactions,
        op9_entropy_mix,
        op10_simhash_pigeonring,
        op11_bit_sliced_whitening,
        op12_piece_spans,
        op13_importance_resampling,
    )
}

# words, shingles and windows spelled out as strings; every window is compared exactly
_DECONTAMINATION = r"""
WITH item AS (
  SELECT item_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM benchmark
), doc AS (
  SELECT doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM documents
), item_shingle AS (
  SELECT item_id, unnest(range(greatest(len(w) - 4, 1))) AS at, unnest([array_to_string(w[i + 1 : i + 5], ' ') FOR i IN range(greatest(len(w) - 4, 1))]) AS s,
         greatest(len(w) - 4, 1) AS long FROM item WHERE w[1] <> ''
), doc_shingle AS (
  SELECT doc_id, unnest(range(greatest(len(w) - 4, 1))) AS at, unnest([array_to_string(w[i + 1 : i + 5], ' ') FOR i IN range(greatest(len(w) - 4, 1))]) AS s,
         greatest(len(w) - 4, 1) AS total FROM doc WHERE w[1] <> ''
), place AS (
  SELECT DISTINCT d.doc_id, i.long, greatest(0, least(d.at - i.at, d.total - i.long)) AS start FROM doc_shingle d JOIN item_shingle i USING (s)
), win AS (
  SELECT p.doc_id, p.long, p.start, d.s, count(*) AS n FROM place p JOIN doc_shingle d ON d.doc_id = p.doc_id AND d.at >= p.start AND d.at < p.start + p.long
  GROUP BY ALL
), size AS (
  SELECT doc_id, long, start, sum(n) AS size FROM win GROUP BY ALL
), item_weight AS (
  SELECT item_id, long, s, count(*) AS n FROM item_shingle GROUP BY ALL
), alike AS (
  SELECT w.doc_id, w.long, w.start, i.item_id, sum(least(w.n, i.n)) AS common FROM win w JOIN item_weight i USING (s, long) GROUP BY ALL
), found AS (
  SELECT doc_id, item_id, max(2.0::DOUBLE * common / (size + long)) AS similarity FROM alike JOIN size USING (doc_id, long, start)
  WHERE 2.0::DOUBLE * common / (size + long) >= 0.8 GROUP BY ALL
)
SELECT d.doc_id, count(f.item_id) AS n_items, coalesce(string_agg(f.item_id::VARCHAR, ',' ORDER BY f.item_id), '') AS item_ids, max(f.similarity) AS similarity
FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id GROUP BY d.doc_id
"""

_TEMPLATES = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split_regex(text, '\r?\n')) AS s, unnest(range(len(string_split_regex(text, '\r?\n')))) AS nth FROM documents
), token AS (
  SELECT doc_id, nth, [CASE WHEN regexp_matches(t, '[0-9@]|://') THEN '<*>' ELSE t END FOR t IN string_split_regex(s, '[\x20\x09-\x0D]+') IF t <> ''] AS t FROM line
), piece AS (
  SELECT doc_id, nth, len(t) AS words, t, [3 + ((len(t) - 3) * k) // 4 FOR k IN range(5)] AS b FROM token WHERE len(t) > 0
), template AS (
  SELECT doc_id, nth, words,
    unnest(CASE WHEN words - 3 >= 8
      THEN [words || '|' || array_to_string(t[1:3], ' ') || '|' || o || '|' ||
            array_to_string([CASE WHEN j = o THEN '*' ELSE array_to_string(t[b[j + 1] + 1 : b[j + 2]], ' ') END FOR j IN range(4)], '|') FOR o IN range(4)]
      ELSE [words || '||' || array_to_string(t, ' ')] END) AS template
  FROM piece
), shared AS (
  SELECT template FROM template GROUP BY template HAVING count(DISTINCT doc_id) > 1
), repeated AS (
  SELECT * FROM template SEMI JOIN shared USING (template)
), total AS (
  SELECT doc_id, sum(words) AS all_words FROM (SELECT DISTINCT doc_id, nth, words FROM template) GROUP BY doc_id
), own AS (
  SELECT doc_id, sum(words) AS found FROM (SELECT DISTINCT doc_id, nth, words FROM repeated) GROUP BY doc_id
), evidence AS (
  SELECT r.doc_id, r.words, r.template FROM repeated r JOIN total t ON t.doc_id = r.doc_id JOIN own o ON o.doc_id = r.doc_id
  WHERE t.all_words > r.words AND o.found - r.words < 0.6 * (t.all_words - r.words)
), dropped AS (
  SELECT template FROM evidence GROUP BY template, words
  HAVING count(DISTINCT doc_id) >= CASE WHEN words >= 50 THEN 2 WHEN words >= 6 THEN 3 ELSE 10 END
), gone AS (
  SELECT DISTINCT doc_id, nth FROM repeated SEMI JOIN dropped USING (template)
), cleaned AS (
  SELECT l.doc_id, count(g.nth) AS n_dropped, coalesce(string_agg(CASE WHEN g.nth IS NULL THEN l.s END, chr(10) ORDER BY l.nth), '') AS text
  FROM line l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.nth = l.nth GROUP BY l.doc_id
  HAVING regexp_matches(coalesce(string_agg(CASE WHEN g.nth IS NULL THEN l.s END, chr(10) ORDER BY l.nth), ''), '[^\x20\x09-\x0D]')
)
SELECT d.doc_id, coalesce(c.n_dropped, 0) AS n_dropped, length(CASE WHEN c.n_dropped > 0 THEN c.text ELSE d.text END) AS n_chars,
       sha256(CASE WHEN c.n_dropped > 0 THEN c.text ELSE d.text END) AS text_sha256
FROM documents d LEFT JOIN cleaned c ON c.doc_id = d.doc_id
"""

# crc32 by its polynomial, byte by byte over the distinct n-grams; words by a plain split of each text
_IMPORTANCE = r"""
WITH RECURSIVE shifted(i, k, c) AS (
  SELECT i, 0, i::UBIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM shifted WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS tab FROM shifted WHERE k = 8
), doc AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), gram AS (
  SELECT doc_id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f FROM doc
), target_gram AS (
  SELECT unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f FROM item
), hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::UBIGINT, [('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::UBIGINT FOR i IN range(octet_length(encode(f)))]),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255)::INT + 1])), 4294967295::UBIGINT) % 10000 AS bucket
  FROM (SELECT f FROM gram UNION SELECT f FROM target_gram), crc
), s AS (
  SELECT bucket, count(*) AS s FROM gram JOIN hashed USING (f) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS t FROM target_gram JOIN hashed USING (f) GROUP BY bucket
), gain AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT count(*) FROM gram) + 10000))::DOUBLE
                                 / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM target_gram) + 10000))::DOUBLE))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)
), weight AS (
  SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM gram JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(len(w), 0) >= 20 AS able,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM doc d LEFT JOIN weight USING (doc_id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY able) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * n // 100 THEN place END AS rank FROM placed
"""

ORACLE: dict[str, str] = {"op3_template_tree": _TEMPLATES, "op5_simhash_windows": _DECONTAMINATION, "op13_importance_resampling": _IMPORTANCE}
