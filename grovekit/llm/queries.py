"""The registered queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovekit.llm import (
    contamination,
    divergence,
    huffman,
    jaccard,
    licenses,
    lines,
    packing,
    periodic,
    quality,
    shards,
    substrings,
    suffixes,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable) -> Callable:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("op9_quality_rules")
def quality_rules(spark, sf_dir):
    judged = quality.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", "anomaly")


LINES_SQL = r"""lines AS (
  SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {docs})),
worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
pairs AS (
  SELECT doc_id, j, line, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM worded),
later AS (
  SELECT doc_id, j FROM (
    SELECT *, row_number() OVER (PARTITION BY line, after ORDER BY doc_id, j) AS copy
    FROM pairs WHERE after IS NOT NULL) WHERE copy > 1),
gone AS (
  SELECT DISTINCT doc_id, i FROM worded SEMI JOIN (SELECT * FROM later UNION SELECT doc_id, j + 1 FROM later)
  USING (doc_id, j)),
left_over AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (g IS NULL), '') AS text,
    count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_lines, count(g) AS n_removed
  FROM lines LEFT JOIN (SELECT doc_id, i, true AS g FROM gone) USING (doc_id, i) GROUP BY doc_id)"""


@query(
    "op7_line_dedup",
    f"WITH {LINES_SQL.format(docs='documents')} SELECT doc_id, n_lines, n_removed, sha256(text) AS kept_sha256 FROM left_over",
)
def line_dedup(spark, sf_dir):
    kept = lines.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


#: The same with long lines: one of 50 words or 400 bytes counts alone, next to the pairs.
LONG_LINES_SQL = LINES_SQL.replace(
    """gone AS (
  SELECT DISTINCT doc_id, i FROM worded SEMI JOIN (SELECT * FROM later UNION SELECT doc_id, j + 1 FROM later)""",
    r"""long AS (
  SELECT doc_id, j FROM (
    SELECT doc_id, j, row_number() OVER (PARTITION BY line ORDER BY doc_id, j) AS copy FROM worded
    WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50 OR strlen(line) >= 400) WHERE copy > 1),
gone AS (
  SELECT DISTINCT doc_id, i FROM worded
  SEMI JOIN (SELECT * FROM later UNION SELECT doc_id, j + 1 FROM later UNION SELECT * FROM long)""",
)


@query(
    "op7_long_line_dedup",
    f"WITH {LONG_LINES_SQL.format(docs='documents')} SELECT doc_id, n_lines, n_removed, sha256(text) AS kept_sha256 FROM left_over",
)
def long_line_dedup(spark, sf_dir):
    kept = lines.dedup_lines(documents(spark, sf_dir), long_words=lines.LONG_WORDS)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op5_substring_dedup",
    r"""WITH docs AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    wins AS (
      SELECT doc_id, i, list_slice(ws, i, i + 34) AS win
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM docs)),
    often AS (SELECT md5(array_to_string(win, ' ')) AS w FROM wins GROUP BY w HAVING count(*) > 1),
    gone AS (
      SELECT DISTINCT doc_id, i + d AS i FROM (
        SELECT doc_id, i FROM wins SEMI JOIN often ON md5(array_to_string(win, ' ')) = w), range(35) AS r(d)),
    words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM docs),
    kept AS (
      SELECT doc_id, count(*) AS n_words, count(g) AS n_removed,
        string_agg(word, ' ' ORDER BY i) FILTER (g IS NULL) AS left_over
      FROM words LEFT JOIN (SELECT doc_id, i, true AS g FROM gone) USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
      sha256(coalesce(left_over, '')) AS kept_sha256
    FROM documents LEFT JOIN kept USING (doc_id)""",
)
def substring_dedup(spark, sf_dir):
    kept = substrings.dedup_substrings(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op2_ngram_jaccard_join")
def ngram_jaccard_join(spark, sf_dir):
    return jaccard.join_documents(documents(spark, sf_dir)).drop("f", "root")


@query("op6_packing")
def packing_query(spark, sf_dir):
    pieces = packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)
    return pieces.drop("ids")


@query("op3_token_files")
def token_files(spark, sf_dir):
    return huffman.round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2, keep_ids=False).drop("ids")


@query("op4_benchmark_decontamination")
def benchmark_decontamination(spark, sf_dir):
    """One row for each passage of a benchmark item found in a document."""
    return contamination.find_passages(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("f")


@query("op8_toxicity")
def toxicity_query(spark, sf_dir):
    return toxicity.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels")).drop("spans")


def _licenses_sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in licenses.TEMPLATES.items())
    return f"""WITH t(license, text) AS (VALUES {values}),
    tw AS (SELECT license, regexp_extract_all(lower(text), '[a-z0-9]+') AS ws FROM t),
    ts AS (
      SELECT DISTINCT license, array_to_string(list_slice(ws, i, i + 4), ' ') AS sh
      FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS i FROM tw)),
    tm AS (
      SELECT license, count(*) AS n, CAST(2 ** ceil(log2(count(*))) AS BIGINT) AS step FROM ts GROUP BY license),
    dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS ws FROM documents),
    ds AS (
      SELECT doc_id, i - 1 AS i, array_to_string(list_slice(ws, i, i + 4), ' ') AS sh
      FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS i FROM dw)),
    hits AS (SELECT doc_id, license, i, sh, n, step FROM ds JOIN ts USING (sh) JOIN tm USING (license)),
    wins AS (
      SELECT doc_id, license, n, k * step AS start, count(DISTINCT sh) AS common
      FROM (SELECT *, i // step - d AS k FROM hits, range(2) AS r(d)) WHERE k >= 0
      GROUP BY doc_id, license, n, k, step HAVING 100 * count(DISTINCT sh) >= 80 * n)
    SELECT doc_id, license, n AS n_shingles, max(common) AS n_common, min(start) AS first_window, count(*) AS n_windows
    FROM wins GROUP BY doc_id, license, n"""


@query("op10_license_scan", _licenses_sql())
def license_scan(spark, sf_dir):
    return licenses.find_licenses(documents(spark, sf_dir)).drop("f")


@query("op1_suffix_array_dedup")
def suffix_array_dedup(spark, sf_dir):
    kept = suffixes.dedup_suffixes(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: CRC-32 of bytes b[1..n] by the table of the reflected polynomial, as a list fold.
CRC_TABLE_SQL = """crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS v
    FROM range(256) AS r(i)))"""


def _crc32_sql(text: str) -> str:
    code = f"hex(encode({text}))"
    each = f"list_transform(regexp_extract_all({code}, '..'), lambda s: ('0x' || s)::BIGINT)"
    fold = f"list_reduce(list_prepend(4294967295::BIGINT, {each}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))"
    return f"xor({fold}, 4294967295)"


@query(
    "op12_sharding",
    f"""WITH {CRC_TABLE_SQL},
    rows AS (
      SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, {_crc32_sql("coalesce(text, '')")} AS text_crc32
      FROM documents, crc_table),
    sums AS (
      SELECT *, row_number() OVER w - 1 AS pos, sum(size) OVER (w ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total
      FROM rows WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32)),
    cut AS (SELECT *, CAST(least(8 * (2 * upto - size) // (2 * total), 7) AS INTEGER) AS shard FROM sums)
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
      pos - min(pos) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM cut""",
)
def sharding(spark, sf_dir):
    rows = shards.shard_rows(documents(spark, sf_dir), 8)
    grown = F.lit(None).cast("int").alias("grown_shard")
    return rows.select("doc_id", "size", "text_crc32", F.lit(shards.LAW).alias("law"), "shard", "slot", grown)


def repeating(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: with checksum h of the id, every tenth document with words repeats itself from word h / 10 % n on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when((h % 10 == 0) & F.col("text").isNotNull(), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    # The words are a column of their own, so that they are cut once and not for each of them.
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    cut = cut.select("*", F.size("words").alias("n")).select("*", (F.col("g") % F.nullif("n", F.lit(0))).alias("a"))
    cut = cut.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", place(i).cast("int")))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


#: Equal words at two places are matches of a gap; a run of gap q is a stretch of matches with consecutive places.
PERIODIC_SQL = rf"""WITH {CRC_TABLE_SQL},
    hashed AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {_crc32_sql("doc_id::VARCHAR")} AS h
      FROM documents, crc_table),
    cut AS (
      SELECT *, len(ws) AS n, h // 10 AS g, (h // 10) % nullif(len(ws), 0) AS a FROM hashed),
    placed AS (
      SELECT doc_id, n, unnest(range(n)) AS i, ws, h, a, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
    words AS (
      SELECT doc_id, n, i, ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS w FROM placed),
    matches AS (
      SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM words x JOIN words y
      ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    stretches AS (
      SELECT doc_id, q, min(i) AS start, count(*) + q AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS s FROM matches)
      GROUP BY doc_id, q, s HAVING count(*) + q >= greatest(6, 4 * q)),
    runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL),
    gone AS (
      SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
    kept AS (
      SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
    listed AS (
      SELECT doc_id, count(*) AS n_runs, max_by(start, (length, -start, -period)) AS start, max(length) AS length,
        max_by(period, (length, -start, -period)) AS period,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
      FROM runs GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
      sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
    FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query("op11_periodic_runs", PERIODIC_SQL)
def periodic_runs(spark, sf_dir):
    found = periodic.find_runs(repeating(documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")))
    order = F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), F.array_max(order).alias("best"), "collapsed", F.array_join(lines, "").alias("lines"))
    return best.select(
        "doc_id",
        "n_runs",
        (-F.col("best.s")).alias("start"),
        "best.length",
        (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op13_source_divergence",
    r"""WITH docs AS (
      SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents),
    occ AS (
      SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
    langs AS (SELECT lang, count(*) AS v, sum(n) AS size FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    counts AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    sizes AS (
      SELECT lang, source, coalesce(sum(n), 0) AS size FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
    shares AS (
      SELECT lang, source, term, c.n AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 2)::HUGEINT) // (s.size + 2 * l.v) AS p,
        1 + (1000000000 * (k.n + 2)::HUGEINT) // (l.size + 2 * l.v) AS q
      FROM sizes s JOIN langs l USING (lang) JOIN (SELECT lang, term, n FROM kept) k USING (lang)
      LEFT JOIN (SELECT lang, source, term, n FROM counts) c USING (lang, source, term)),
    pairs AS (
      SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
      LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
      GROUP BY ALL),
    terms AS (
      SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares WHERE n > 0 AND p > q),
    ranked AS (
      SELECT *, 'pair' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS r FROM pairs
      UNION ALL
      SELECT *, 'term' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS r FROM terms)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR r <= 10""",
)
def source_divergence(spark, sf_dir):
    return divergence.audit_sources(documents(spark, sf_dir))
