"""Registered queries of this subpackage: one per operator, and the pipeline.

Every query applies its operator, with production parameters, to its whole
table.  ``ORACLES`` holds the DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path
from . import (
    decontamination,
    embedding_whitening,
    exact_dedup,
    html_extraction,
    language_id,
    mixing,
    ngram_join,
    periodic_runs,
    quality_fm,
    sentencepiece_chunks,
    substring_dedup,
    toxicity,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Words of the contracts, as DuckDB writes them.
WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, table))


@query(
    "op9_exact_dedup",
    f"""
WITH d AS (SELECT doc_id, sha256({LOWER_SQL}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
""",
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row that stays, for every document."""
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


@query(
    "op3_substring_dedup",
    f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
n AS (SELECT doc_id, w, len(w) AS n_words FROM d),
win AS MATERIALIZED (
  SELECT doc_id, start, md5(array_to_string(list_slice(w, start, start + 19), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, n_words - 18)) AS start FROM n WHERE n_words >= 20)),
ranked AS (SELECT doc_id, start, row_number() OVER (PARTITION BY h ORDER BY doc_id, start) AS place FROM win),
gone AS (
  SELECT DISTINCT doc_id, start + k AS pos
  FROM (SELECT doc_id, start, unnest(range(0, 20)) AS k FROM ranked WHERE place > 1)),
words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, n_words + 1)) AS pos FROM n),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY pos) AS kept_text
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, (n_words - coalesce(n_kept, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept_text, '')) AS kept_sha256
FROM n LEFT JOIN kept USING (doc_id)
""",
)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed with repeated 20-word windows, and the digest of the words kept."""
    cut = substring_dedup.substring_dedup(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id",
        "n_words",
        removed.alias("n_removed"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


@query(
    "op8_ngram_jaccard_join",
    f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER_SQL}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(d.doc_id, min(reach.b)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
""",
)
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and link component of every document, four-word shingles at 0.85."""
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents"))


@query(
    "op2_mix_sources",
    f"""
WITH d AS (SELECT doc_id, source, len({WORDS_SQL})::BIGINT AS size, md5(doc_id::VARCHAR) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT source, source_size, 2 * source_size AS cap,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w
  FROM s),
o AS (
  SELECT cap / w AS ratio, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS share,
    coalesce(sum(cap) OVER before, 0)::DOUBLE AS used, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open_weight
  FROM r WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((share - used) / open_weight, ratio) AS level FROM o WHERE ratio >= (share - used) / open_weight),
t AS (
  SELECT source, source_size, CASE WHEN cap <= w * level THEN cap::DOUBLE ELSE w * level END AS target FROM r, l),
p AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
FROM p
""",
)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mix = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def _template_sql(table: str, key: str) -> str:
    """Token rows (key, raw tokens, template tokens) as DuckDB computes them."""
    units = ", ".join(f"'{u}'" for u in decontamination.UNITS)
    name, number, unit = (f"chr({c})" for c in (2, 3, 4))
    return f"""
  SELECT {key}, list_transform(k, lambda x: ltrim(x, {name})) AS raw,
    list_transform(typed, lambda x, i: CASE WHEN list_contains([{units}], x) AND typed[i - 1] = {number} THEN {unit} ELSE x END) AS template
  FROM (
    SELECT {key}, k, list_transform(k, lambda x: CASE WHEN x[1] = {name} THEN {name}
      WHEN regexp_full_match(x, '\\p{{N}}+') THEN {number} ELSE x END) AS typed
    FROM (
      SELECT {key}, string_split(trim(regexp_replace(lower(regexp_replace(regexp_replace(coalesce(text, ''), '[\\x02-\\x04]', ' ', 'g'),
        '([\\p{{Ll}},] )(\\p{{Lu}}\\p{{Ll}})', '\\1' || {name} || '\\2', 'g')), '[^\\p{{L}}\\p{{M}}\\p{{N}}\\x02]+', ' ', 'g')), ' ') AS k
      FROM {table} WHERE {key} IS NOT NULL))"""


_LEAK_SQL = f"""
WITH b AS ({_template_sql("benchmark", "item_id")}),
d AS ({_template_sql("documents", "doc_id")}),
bw AS MATERIALIZED (
  SELECT * FROM (
    SELECT item_id, j, list_slice(template, j, j + 7) AS tv, list_slice(raw, j, j + 7) AS bv, greatest(len(template) - 7, 1) AS item_windows
    FROM (SELECT *, unnest(range(1, greatest(len(template) - 7, 1) + 1)) AS j FROM b WHERE template[1] <> ''))
  WHERE len(list_filter(tv, lambda x: x NOT IN (chr(2), chr(3), chr(4)))) > 0),
dw AS (
  SELECT doc_id, i, list_slice(template, i, i + 7) AS tv, list_slice(raw, i, i + 7) AS dv
  FROM (SELECT *, unnest(range(1, greatest(len(template) - 7, 1) + 1)) AS i FROM d WHERE template[1] <> '')),
m AS MATERIALIZED (
  SELECT doc_id, item_id, item_windows, j, i - j AS shift, dv = bv AS same, dv, bv, tv FROM dw JOIN bw USING (tv)),
slots AS (
  SELECT DISTINCT doc_id, item_id, shift, tv[k] AS kind, dv[k] AS dv, bv[k] AS bv
  FROM (SELECT *, unnest(range(1, len(tv) + 1)) AS k FROM m) WHERE tv[k] IN (chr(2), chr(3))),
torn AS (
  SELECT doc_id, item_id, shift FROM slots GROUP BY doc_id, item_id, shift, kind, bv HAVING count(*) > 1
  UNION SELECT doc_id, item_id, shift FROM slots GROUP BY doc_id, item_id, shift, kind, dv HAVING count(*) > 1),
held AS (
  SELECT m.doc_id, m.item_id, item_windows, j, bool_or(same) AS same
  FROM m LEFT JOIN torn t ON m.doc_id = t.doc_id AND m.item_id = t.item_id AND m.shift = t.shift
  WHERE t.doc_id IS NULL OR same GROUP BY m.doc_id, m.item_id, item_windows, j)
SELECT doc_id, item_id, item_windows::BIGINT AS item_windows, count(*) AS matched,
  count(*) FILTER (WHERE same) AS exact, count(*) / item_windows AS coverage
FROM held GROUP BY doc_id, item_id, item_windows HAVING count(*) / item_windows >= 0.5
"""


@query("op4_benchmark_decontamination", _LEAK_SQL)
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item it leaks, with matched windows."""
    return decontamination.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language_id.predict_language(read(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op10_quality_fm")
def op10_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_fm.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op7_html_blocks")
def op7_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.extract_main_text(read(spark, sf_dir, "pages"))


@query(
    "op1_warc_dictionary",
    """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
g AS (SELECT html, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY html)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html AND payload_bytes >= 1000
""",
)
def op1_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    path = warc.archive_path(spark)
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _repeating_words() -> tuple[Column, Column]:
    """Words of a document, and the same where one in ten documents gets a repeated tail (contract of op11)."""
    words = periodic_runs.words_of(F.col("text"))
    n = F.size("w").cast("long")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(crc / 10).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    tail = F.transform(F.sequence(a, n - 1), lambda i: F.get("w", (a + (i - a) % p).cast("int")))
    return words, F.when((crc % 10 == 0) & (n > 0), F.concat(F.slice("w", F.lit(1), a.cast("int")), tail)).otherwise(F.col("w"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, the strongest one, and the words left."""
    words, repeating = _repeating_words()
    docs = read(spark, sf_dir, "documents").select("doc_id", words.alias("w"))
    found = periodic_runs.find_runs(docs, repeating)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = periodic_runs.strongest(F.col("runs"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: Model file of op12; the path is a parameter of the query.
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query("op12_sentencepiece_chunks")
def op12_sentencepiece_chunks(spark: SparkSession, sf_dir: str, model_path: str = PIECES) -> DataFrame:
    """Digests of the piece ids and of the decoded text of every document."""
    with open(model_path, "rb") as f:
        model = f.read()
    out = sentencepiece_chunks.encode(read(spark, sf_dir, "documents"), model)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op13_whitening_feast")
def op13_whitening_feast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding on the four leading components."""
    out = embedding_whitening.whiten(read(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
