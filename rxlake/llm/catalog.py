"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.llm import chat, embeddings, exact, languages, licences, manifest, mixing, ngrams, packing, quality, simhash, substrings, targets
from rxlake.llm.common import bucket_of, read


def labels_for_fit(labels: DataFrame) -> DataFrame:
    """Quality labels outside the held-out third."""
    return labels.select("doc_id", "quality").filter(bucket_of("doc_id", 3) != 1)


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, unnest(generate_series(1, len(w) - 19)) AS s, w FROM words WHERE len(w) >= 20
), windows AS (
  SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS body FROM starts
), late AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS k FROM windows) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS p FROM late
), per_word AS (
  SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM words
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS body, count(*) AS n
  FROM per_word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


def op1_fm_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(read(spark, sf_dir, "documents"), window=20).drop("kept_text")


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_labels(docs, labels_for_fit(read(spark, sf_dir, "labels")))
    return quality.classify(docs, model).select(
        "row.doc_id", (bucket_of("row.doc_id", 3) == 1).alias("held_out"), "score", F.col("predicted").cast("int")
    )


def op4_low_discrepancy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sizes(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots")


def op5_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(read(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select(
        F.col("id").alias("doc_id"), simhash.hex16("fp").alias("fingerprint"), "component_id"
    )


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(chat.link_quotes(read(spark, sf_dir, "conversations"))).drop("text")


def op7_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score(read(spark, sf_dir, "documents"), fold=10)


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_crc(packing.pack(read(spark, sf_dir, "documents"), window=2048))


def op9_epsilon_grid_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(read(spark, sf_dir, "embeddings"), cosine=0.9)


OP10_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op10_exact_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(read(spark, sf_dir, "documents"))


#: Table of the CRC-32 steps, from its polynomial.
CRC = r"""crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM range(256) r(i))
)"""


def crc_sql(text: str, table: str = "t") -> str:
    """CRC-32 of a text's UTF-8 bytes, a table step per byte."""
    digits = "'0123456789ABCDEF'"
    value = f"(strpos({digits}, substr(x, 1, 1)) - 1) * 16 + strpos({digits}, substr(x, 2, 1)) - 1"
    listed = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda x: {value})"
    return f"xor(4294967295, list_reduce([4294967295] || {listed}, lambda c, b: xor({table}[xor(c, b) % 256 + 1], c // 256)))"

OP11_SQL = rf"""
WITH {CRC}, texts AS (
  SELECT 's' AS side, row_number() OVER () AS rid, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark
), words AS (
  SELECT side, rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), grams AS (
  SELECT side, rid, feature, count(*) AS n FROM (
    SELECT side, rid, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
      || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS feature FROM words)
  GROUP BY ALL
), coded AS (
  SELECT feature, {crc_sql('feature')} % 10000 AS bucket FROM (SELECT DISTINCT feature FROM grams), crc_table
), buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM grams JOIN coded USING (feature) GROUP BY 1
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(((t + 1) * (sum(s) OVER () + 10000)) AS DOUBLE) / CAST(((s + 1) * (sum(t) OVER () + 10000)) AS DOUBLE))) AS BIGINT) AS gain FROM buckets
), weights AS (
  SELECT rid, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM grams JOIN coded USING (feature) JOIN gains USING (bucket) WHERE side = 's' GROUP BY 1
), scored AS (
  SELECT rid, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (rid) WHERE side = 's'
), ranks AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN ranks USING (rid)
"""

FIELDS = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST({n_chars} AS VARCHAR)", "text")


def leaf_sql(n_chars: str) -> str:
    named = [f.format(n_chars=n_chars) for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in named) + ")"


OP12_SQL = f"""
WITH RECURSIVE {CRC}, hashed AS (
  SELECT doc_id, lang, {leaf_sql('n_chars')} AS leaf,
         CASE WHEN {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '')")} % 7 = 0 THEN {leaf_sql('n_chars + 1')} ELSE {leaf_sql('n_chars')} END AS shown
  FROM documents, crc_table
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM hashed
), nodes AS (
  SELECT lang, 0 AS k, pos, leaf AS h, n FROM leaves
  UNION ALL
  SELECT lang, k + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY lang, k, pos // 2, n
), subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS k, tree AS pos, subroot AS h, trees AS n FROM subroots
  UNION ALL
  SELECT k + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY k, pos // 2, n
), placed AS (
  SELECT row_number() OVER () AS rid, doc_id, leaf, shown, leaves.lang, pos, tree, subroot, (SELECT h FROM tops WHERE n = 1) AS root
  FROM leaves JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang
), steps AS (
  SELECT rid, m.k, (p.pos >> m.k) % 2 AS bit, s.h FROM placed p
  JOIN (SELECT DISTINCT lang, k FROM nodes WHERE n > 1) m ON p.lang IS NOT DISTINCT FROM m.lang
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.k = m.k AND s.pos = xor(p.pos >> m.k, 1) AND s.n > 1
  UNION ALL
  SELECT rid, 1000 + m.k, (p.tree >> m.k) % 2, s.h FROM placed p
  CROSS JOIN (SELECT DISTINCT k FROM tops WHERE n > 1) m LEFT JOIN tops s ON s.k = m.k AND s.pos = xor(p.tree >> m.k, 1) AND s.n > 1
), folds AS (
  SELECT rid, doc_id, leaf, subroot, root, sha256(coalesce(string_agg(h, '' ORDER BY k), '')) AS proof_sha256,
         list_reduce([shown] || coalesce(list(CASE WHEN h IS NULL THEN '-' WHEN bit = 1 THEN 'L' || h ELSE 'R' || h END ORDER BY k) FILTER (k IS NOT NULL), []),
                     lambda a, s: CASE s[1] WHEN '-' THEN sha256(a) WHEN 'L' THEN sha256(s[2:] || a) ELSE sha256(a || s[2:]) END) AS folded_root
  FROM placed LEFT JOIN steps USING (rid) GROUP BY rid, doc_id, leaf, shown, subroot, root
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folds
"""


def op11_segment_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return targets.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), percent=5)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tampered = F.col("n_chars") + F.when(bucket_of("doc_id", 7) == 0, 1).otherwise(0)
    return manifest.manifest(docs, tampered={"n_chars": tampered})


def op13_marginalised_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = languages.train(docs.filter(bucket_of("doc_id", 4) != 2))
    return languages.identify(docs, model, carry=["doc_id"]).select(
        "row.doc_id", (bucket_of("row.doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


QUERIES = {
    "op1_fm_index_dedup": op1_fm_index_dedup,
    "op2_licence_scan": op2_licence_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_low_discrepancy_mix": op4_low_discrepancy_mix,
    "op5_simhash_neardup": op5_simhash_neardup,
    "op6_quotation_linking": op6_quotation_linking,
    "op7_elias_fano_lm": op7_elias_fano_lm,
    "op8_sum_of_squares_packing": op8_sum_of_squares_packing,
    "op9_epsilon_grid_order": op9_epsilon_grid_order,
    "op10_exact_content_sort": op10_exact_content_sort,
    "op11_segment_resampling": op11_segment_resampling,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_marginalised_langid": op13_marginalised_langid,
}
ORACLES = {
    "op1_fm_index_dedup": OP1_SQL,
    "op10_exact_content_sort": OP10_SQL,
    "op11_segment_resampling": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
