"""Registered queries of the manifest, importance resampling and exact deduplication, with their SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints, importance, merkle
from .common import table

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

# CRC-32 (reflected polynomial 0xEDB88320) of a string's bytes; the subquery is its table by byte
_CRC_TABLE = ("SELECT list(list_reduce([i::UBIGINT] || range(8)::UBIGINT[], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) "
              "ELSE c >> 1 END) ORDER BY i) AS crcs FROM range(256) b(i)")


def _crc_sql(text: str) -> str:
    octets = f"[('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::UBIGINT FOR i IN range(1, strlen({text}) + 1)]"
    return (f"xor(list_reduce([4294967295::UBIGINT] || {octets}, lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255)::INT + 1])), 4294967295::UBIGINT)")


def _leaf_sql(text: str) -> str:
    shown = [f"({text if f == 'text' else f})::VARCHAR" for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({s}) || ':' || {s}, '-')" for s in shown) + ")"


MANIFEST_SQL = f"""
    WITH RECURSIVE tab AS ({_CRC_TABLE}),
    d AS (SELECT doc_id, source, {_leaf_sql('text')} AS leaf,
                 CASE WHEN {_crc_sql('doc_id::VARCHAR')} % 2 = 0 THEN {_leaf_sql('replace(text, chr(10), \'\')')} ELSE {_leaf_sql('text')} END AS claimed,
                 row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents, tab),
    up AS (SELECT source, 0 AS lvl, pos, leaf AS hex, count(*) OVER (PARTITION BY source) AS n FROM d UNION ALL
           SELECT source, lvl + 1, pos // 3, sha256(string_agg(hex, '' ORDER BY pos)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY source, lvl, pos // 3, n),
    subroots AS (SELECT source, hex AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
    over_ AS (SELECT 0 AS lvl, pos, subroot AS hex, n FROM subroots UNION ALL
              SELECT lvl + 1, pos // 3, sha256(string_agg(hex, '' ORDER BY pos)), (n + 2) // 3 FROM over_ WHERE n > 1 GROUP BY lvl, pos // 3, n),
    near AS (SELECT d.doc_id, u.lvl, u.hex, u.pos - d.pos // (3 ** u.lvl)::BIGINT AS side, u.pos FROM d JOIN up u
             ON d.source IS NOT DISTINCT FROM u.source AND u.n > 1 AND u.pos // 3 = d.pos // (3 ** (u.lvl + 1))::BIGINT UNION ALL
             SELECT d.doc_id, 1000 + u.lvl, u.hex, u.pos - s.pos // (3 ** u.lvl)::BIGINT, u.pos FROM d JOIN subroots s ON d.source IS NOT DISTINCT FROM s.source
             JOIN over_ u ON u.n > 1 AND u.pos // 3 = s.pos // (3 ** (u.lvl + 1))::BIGINT),
    steps AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY lvl) AS step, coalesce(string_agg(hex, '' ORDER BY pos) FILTER (side < 0), '') AS l,
                     coalesce(string_agg(hex, '' ORDER BY pos) FILTER (side > 0), '') AS r FROM near GROUP BY doc_id, lvl),
    proofs AS (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY doc_id),
    fold AS (SELECT doc_id, 0 AS step, claimed AS node FROM d UNION ALL
             SELECT f.doc_id, s.step, sha256(l || node || r) FROM fold f JOIN steps s ON s.doc_id = f.doc_id AND s.step = f.step + 1),
    ends AS (SELECT doc_id, arg_max(node, step) AS folded_root FROM fold GROUP BY doc_id)
    SELECT doc_id, leaf, subroot, o.hex AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = o.hex AS verified
    FROM d JOIN subroots s ON d.source IS NOT DISTINCT FROM s.source JOIN over_ o ON o.n = 1 JOIN ends USING (doc_id) LEFT JOIN proofs USING (doc_id)"""


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest, held against texts half of which lost their line breaks."""
    docs = table(spark, sf_dir, "documents")
    changed = merkle.leaf([F.replace("text", F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in FIELDS])
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, changed).otherwise(merkle.leaf([F.col(f) for f in FIELDS]))
    found = merkle.manifest(docs, FIELDS, claimed=claimed)
    folded = found.withColumn("folded_root", merkle.fold(F.col("claimed"), F.col("proof")))
    return folded.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SIZE = importance.BUCKETS


def _words_sql(source: str, key: str) -> str:
    return (f"SELECT {key} AS id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), "
            f"'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM {source}")


RESAMPLE_SQL = f"""
    WITH tab AS ({_CRC_TABLE}), dw AS ({_words_sql('documents', 'doc_id')}), tw AS ({_words_sql('benchmark', 'item_id')}),
    kinds AS (SELECT word, {_crc_sql('word')} % {_SIZE} AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM tw), tab),
    s AS (SELECT bucket, count(*) AS s FROM dw JOIN kinds USING (word) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM tw JOIN kinds USING (word) GROUP BY bucket),
    totals AS (SELECT (SELECT count(*) FROM dw)::DOUBLE + {_SIZE} AS big_s, (SELECT count(*) FROM tw)::DOUBLE + {_SIZE} AS big_t),
    gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * big_s / ((s + 1) * big_t)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), totals),
    w AS (SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM dw JOIN kinds USING (word) JOIN gains USING (bucket) GROUP BY id),
    scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
               (('0x' || substr(sha256('{importance.SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM documents LEFT JOIN w ON doc_id = id),
    placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= {importance.MIN_WORDS})
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= {importance.PERCENT} * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)"""


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark, its score and its rank in the draw."""
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


EXACT_SQL = """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of those with the same bytes."""
    return fingerprints.groups(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
