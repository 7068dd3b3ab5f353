"""The registered queries of the training-data operators, and their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from lakemart.llm import ann, bpe, infill, jaccard, language, merkle, mixing, pii, quality, secret_scan, sharding, suffix, toxicity
from lakemart.llm.common import table, written

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: what the contracts call a word


def op1_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the field; labels of a third of the ids are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)
    )
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "toxicity.score",
        (F.col("toxicity.score") >= 0.7).cast("int").alias("predicted"),
        F.array_join(
            F.transform("toxicity.spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ","
        ).alias("spans"),
    )


def op2_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded by the public byte-level vocabulary."""
    coded = bpe.round_trip(
        spark,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        "text",
    )
    return table(spark, sf_dir, "documents").select("doc_id", coded.alias("c")).select("doc_id", "c.*")


def op3_layered_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole document and in what is encoded in it."""
    found = table(spark, sf_dir, "documents").select("doc_id", secret_scan.spans("text").alias("s"))

    def count(kind):
        return F.size(F.filter("s", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(secret_scan.digest(F.filter("s", lambda s: s["base"])), 256).alias("base_sha256"),
        secret_scan.digest(F.col("s")).alias("spans"),
    )


def op8_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles agree to 90 %."""
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every document and the forest's verdict."""
    stats = table(spark, sf_dir, "documents").select(
        "doc_id", quality.statistics("text").alias("s")
    )
    stats = written(stats, "statistics")
    forest = quality.calibrate(stats, table(spark, sf_dir, "labels"))
    score, kept = quality.judge(F.col("s"), forest)
    return stats.select(
        "doc_id",
        *[f"s.{c}" for c in quality.STATS],
        quality.base_failed(F.col("s")).alias("base_failed"),
        score.alias("anomaly"),
        kept.alias("kept"),
    )


def op4_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that start anywhere else, too."""
    removed = suffix.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return removed.withColumn("repeated", F.col("n_removed") > 0)


def op5_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row of embeddings whose id 20 divides."""
    return ann.search(table(spark, sf_dir, "embeddings"), every=20)


def op6_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of all words; words taken from each."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    units = table(spark, sf_dir, "documents").select("doc_id", "source", size.alias("size"))
    return mixing.decide(units).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op7_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards, each with the mixture of sources; law of rows."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.interleave(rows, "source", 40).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_checked_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of documents."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in pii.BASE],
        F.sha2(pii.digest(F.col("spans"), pii.BASE), 256).alias("base_sha256"),
        pii.digest(F.col("spans")).alias("spans"),
        F.array_min(F.transform("spans", lambda s: s["score"])).alias("least_score"),
    )


def op11_wavelet_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text cut at lines and rearranged for filling in the middle, and rebuilt."""
    made = infill.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias(
            "restored_sha256"
        ),
    )


OP11_SQL = r"""
WITH lines AS (
    SELECT doc_id, coalesce(text, '') AS whole,
           regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS unit,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT doc_id, whole, unit, CAST(len(unit) AS BIGINT) AS n,
           CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
           CAST('0x' || h[25:32] AS BIGINT) AS h4
    FROM lines
), cut AS (
    SELECT doc_id, whole, n,
           CASE WHEN whole = '' OR contains(whole, '<P>') OR contains(whole, '<S>')
                     OR contains(whole, '<M>') THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(unit[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
           array_to_string(unit[least(h1 % (n + 1), h2 % (n + 1)) + 1:
                                greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
           array_to_string(unit[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s
    FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN whole
                        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(whole) AS restored_sha256
FROM cut
"""

def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root of all documents, each one's proof, and whether it holds for the row as found."""
    docs = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    found = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in columns]
    tampered = F.when(found & F.col("n_chars").isNotNull(), merkle.leaf(changed))
    manifest = merkle.Manifest(docs, columns, extra=tampered)
    return manifest.finished(merkle.CHECKED, merkle.checked)


OP12_SQL = r"""
WITH RECURSIVE crc_steps AS (
    SELECT i, 0 AS k, i AS v FROM range(256) r(i)
    UNION ALL
    SELECT i, k + 1, xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END)
    FROM crc_steps WHERE k < 8
), crc_table AS (
    SELECT list(v ORDER BY i) AS v FROM crc_steps WHERE k = 8
), leaves AS (
    SELECT doc_id, lang, n_chars, p, t,
           xor(4294967295, list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT),
                            list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                           lambda x: CAST(ascii(x) AS BIGINT))),
               lambda c, b: xor(c >> 8, crc_of[xor(c, b) % 256 + 1]))) AS crc,
           sha256(concat(p, coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-'), t)) AS leaf,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS place,
           count(*) OVER (PARTITION BY lang) AS n
    FROM (SELECT doc_id, lang, n_chars,
                 coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
                 || coalesce(strlen(source) || ':' || source, '-')
                 || coalesce(strlen(lang) || ':' || lang, '-') AS p,
                 coalesce(strlen(text) || ':' || text, '-') AS t,
                 (SELECT v FROM crc_table) AS crc_of
          FROM documents)
), nodes AS (
    SELECT lang, 0 AS level, place, n, leaf AS node FROM leaves
    UNION ALL
    SELECT lang, level + 1, place // 2, max(n + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
    FROM nodes WHERE n > 1 GROUP BY lang, level, place // 2
), subroots AS (
    SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place,
           count(*) OVER () AS n
    FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS level, place, n, subroot AS node FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, max(n + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
    FROM tops WHERE n > 1 GROUP BY level, place // 2
), steps AS (
    SELECT l.lang, l.place, x.level, x.node, x.place % 2 AS right_side
    FROM leaves l JOIN nodes x
      ON x.lang IS NOT DISTINCT FROM l.lang AND x.n > 1 AND x.place = xor(l.place >> x.level, 1)
    UNION ALL
    SELECT l.lang, l.place, 1000 + x.level, x.node, x.place % 2
    FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
    JOIN tops x ON x.n > 1 AND x.place = xor(s.place >> x.level, 1)
), alone AS (
    SELECT l.lang, l.place, x.level, '' AS node, 1 AS right_side
    FROM leaves l JOIN nodes x
      ON x.lang IS NOT DISTINCT FROM l.lang AND x.n > 1 AND x.place = l.place >> x.level
     AND x.place = x.n - 1 AND x.place % 2 = 0
    UNION ALL
    SELECT l.lang, l.place, 1000 + x.level, '', 1
    FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
    JOIN tops x ON x.n > 1 AND x.place = s.place >> x.level AND x.place = x.n - 1 AND x.place % 2 = 0
), paths AS (
    SELECT lang, place, string_agg(node, '' ORDER BY level) AS siblings,
           list(CASE WHEN right_side = 1 THEN 'R' ELSE 'L' END || node ORDER BY level) AS sides
    FROM (SELECT * FROM steps UNION ALL SELECT * FROM alone) GROUP BY lang, place
), found AS (
    SELECT l.doc_id, l.leaf, s.subroot, (SELECT node FROM tops WHERE n = 1) AS root,
           sha256(coalesce(p.siblings, '')) AS proof_sha256,
           list_reduce(
               list_prepend(
                   CASE WHEN l.crc % 7 = 0 AND l.n_chars IS NOT NULL
                        THEN sha256(concat(l.p, strlen(CAST(l.n_chars + 1 AS VARCHAR)), ':', l.n_chars + 1, l.t))
                        ELSE l.leaf END,
                   coalesce(p.sides, [])),
               lambda a, b: sha256(CASE WHEN b[1] = 'L' THEN b[2:] || a ELSE a || b[2:] END)) AS folded_root
    FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
    LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.place = l.place
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM found
"""

def op13_marginal_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text; a quarter of the ids is held out from learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)
    )
    model = language.train(docs.where(~held_out), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    found = docs.select(
        "doc_id", held_out.alias("held_out"), language.predict(spark, model, "text").alias("p")
    )
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


QUERIES = {
    "op1_crf_toxicity": op1_crf_toxicity,
    "op2_tree_bpe": op2_tree_bpe,
    "op3_layered_secrets": op3_layered_secrets,
    "op4_radix_dedup": op4_radix_dedup,
    "op5_prefix_forest": op5_prefix_forest,
    "op6_pivotal_mixing": op6_pivotal_mixing,
    "op7_stratified_sharding": op7_stratified_sharding,
    "op8_signature_join": op8_signature_join,
    "op9_quality_forest": op9_quality_forest,
    "op10_checked_pii": op10_checked_pii,
    "op11_wavelet_fim": op11_wavelet_fim,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_marginal_language": op13_marginal_language,
}
ORACLE: dict[str, str] = {"op11_wavelet_fim": OP11_SQL, "op12_merkle_manifest": OP12_SQL}
