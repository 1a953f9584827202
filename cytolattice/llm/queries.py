"""The operators on the test tables, and SQL for those that SQL can express."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (chunkdedup, graysim, langfield, lineblocks, mixing, multiindex, packing, repetition, ringshards, runs, siteprior, skipchain,
               spelling, text, tokens)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "repeat_cover", "long_repeat", "kept")
    return repetition.quality_verdict(docs).select("doc_id", *[F.col(f"repetition.{n}") for n in names])


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = lineblocks.extract_main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = tokens.token_pieces(docs).select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ringshards.ring_shards(_table(spark, sf_dir, "documents").select("doc_id", "text"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = skipchain.find_personal_data(docs, skipchain.fit_personal_data(docs)).drop("text")
    base = F.filter("spans", lambda s: s["base"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [of_kind(k) for k in skipchain.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op7_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return graysim.near_components(docs).select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def op8_site_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources stand for hosts and languages for the paths within them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    models = siteprior.fit_classifiers(docs, _table(spark, sf_dir, "labels"))
    kept = (F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)
    return siteprior.site_scores(docs, models).select("doc_id", "quality", "toxic", "quality_evidence", "toxic_evidence", kept.alias("kept"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, keep=False).select("doc_id", "size", "source_size", "target", "taken")


def op10_chunk_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunkdedup.copied_spans(docs).select("doc_id", "start", "end", "n_words", "n_chunks", "first_doc_ids")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.letter_runs(_table(spark, sf_dir, "documents"))
    words = found.select(spelling.slipped(F.col("doc_id"), F.col("run"), 199).alias("word"))
    return spelling.variant_groups(spelling.vocabulary(words))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    away = langfield.held_out(F.col("doc_id"))
    field = langfield.fit_languages(docs.where(~away))
    told = langfield.predict_language(docs.select("doc_id", "text", away.alias("held_out")), field)
    return told.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    found = runs.find_runs(docs, tail=(g, F.when(h % 10 == 0, 3 + g % 8)))
    every, best = F.col("periodic.runs"), F.col("best")
    lines = F.array_join(F.transform(every, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", runs.strongest(every)).select(
        "doc_id", F.size(every).cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.col("periodic.kept_text"), 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_multi_index": op1_multi_index,
    "op2_repetition": op2_repetition,
    "op3_main_text": op3_main_text,
    "op4_packing": op4_packing,
    "op5_ring_shards": op5_ring_shards,
    "op6_personal_data": op6_personal_data,
    "op7_near_copies": op7_near_copies,
    "op8_site_prior": op8_site_prior,
    "op9_mixing": op9_mixing,
    "op10_chunk_copies": op10_chunk_copies,
    "op11_spelling": op11_spelling,
    "op12_language": op12_language,
    "op13_runs": op13_runs,
}


def _windows(k: int) -> str:
    """Start positions of windows of k words that occur twice or more in their text."""
    return f"""SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS n FROM (
        SELECT doc_id, i, md5(array_to_string(ws[i:i + {k - 1}], ' ')) AS h FROM (
        SELECT doc_id, ws, unnest(range(1, len(ws) - {k} + 2)) AS i FROM words))) WHERE n > 1"""


def _cover(k: int) -> str:
    return f"SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {k})) AS p FROM ({_windows(k)})) GROUP BY doc_id"


ORACLES = {
    "op2_repetition": rf"""WITH words AS (SELECT doc_id, coalesce(text, '') AS text,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
            [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM documents),
        three AS ({_cover(3)}), cover AS ({_cover(repetition.MIN_WORDS)}),
        long AS (SELECT DISTINCT doc_id FROM ({_windows(repetition.MAX_LONGEST + 1)})),
        base AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
            CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
            CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
            CAST(coalesce(t.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(c.n, 0) AS BIGINT) AS repeat_cover,
            l.doc_id IS NOT NULL AS long_repeat
            FROM words w LEFT JOIN three t ON t.doc_id = w.doc_id LEFT JOIN cover c ON c.doc_id = w.doc_id
            LEFT JOIN long l ON l.doc_id = w.doc_id)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            repeat_cover, long_repeat, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT long_repeat
            AND 100 * repeat_cover <= {repetition.MAX_COVERED_PERCENT} * n_words AS kept FROM base""",
    # The checksum is taken byte by byte with the usual table of 256 remainders.
    "op11_spelling": rf"""WITH RECURSIVE remainders(b, v, k) AS (SELECT range, range, 0 FROM range(256) UNION ALL
            SELECT b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM remainders WHERE k < 8),
        steps AS (SELECT b, v FROM remainders WHERE k = 8),
        found AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), '{spelling.UPPER}', '{spelling.LOWER}') AS run FROM documents),
        keyed AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM found GROUP BY doc_id, run),
        digits(x, i, c) AS (SELECT DISTINCT x, CAST(0 AS BIGINT), CAST(4294967295 AS BIGINT) FROM keyed UNION ALL
            SELECT d.x, i + 1, xor(c // 256, s.v) FROM digits d JOIN steps s ON s.b = xor(c % 256,
                16 * (strpos('0123456789ABCDEF', substr(d.x, 2 * i + 1, 1)) - 1) + strpos('0123456789ABCDEF', substr(d.x, 2 * i + 2, 1)) - 1)
            WHERE 2 * i < length(d.x)),
        sums AS (SELECT x, xor(c, 4294967295) AS h FROM digits WHERE 2 * i = length(x)),
        written AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
            FROM keyed JOIN sums USING (x)),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= {spelling.LEAST_CHARS} GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
        cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        near AS (SELECT a.word, b.word AS near, b.n AS m FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word AND length(a.word) = length(b.word)
            UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON w.word = c.rest
            UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON w.word = c.rest),
        best AS (SELECT word, near, m, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(near)) AS place FROM near),
        formed AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= {spelling.FORM_RATIO} * w.n THEN b.near END AS form,
            CASE WHEN b.m >= {spelling.FORM_RATIO} * w.n THEN b.m END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word AND b.place = 1),
        onward(word, root) AS (SELECT word, word FROM formed UNION ALL SELECT o.word, f.form FROM onward o JOIN formed f ON f.word = o.root WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, o.root, f.n, f.n_near, f.form_n FROM formed f
            JOIN (SELECT o.word, o.root FROM onward o JOIN formed l ON l.word = o.root WHERE l.form IS NULL) o ON o.word = f.word""",
}
