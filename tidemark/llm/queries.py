"""The registered queries of the text operators and the SQL they must agree with."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import archives, chat, classifier, decontaminate, licenses, line_spread, packing, pii, quality_rules, queries_manifest, simhash
from .common import scratch, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: Ids whose labels no operator learns from: crc32 of the id as text, modulo 5, is 0.
HELD_OUT = "crc32(cast(doc_id AS string)) % 5 = 0"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op8_simhash_near_duplicates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest doc_id of its component."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@query("op9_power_of_two_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document."""
    import public_tokenizers

    pieces = packing.decompose(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "bucket")


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; cutoffs per language from labelled rows outside the test fold."""
    found = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~F.expr(HELD_OUT))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document from labels outside the test fold."""
    docs = table(spark, sf_dir, "documents")
    model = classifier.fit(docs, table(spark, sf_dir, "labels"), ~F.expr(HELD_OUT))
    scored = classifier.score(docs, model).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= classifier.THRESHOLD).cast("int").alias("predicted"))


def _shingles_sql(name: str, source: str, key: str) -> str:
    """Distinct 5-word shingles per row, as two named subqueries."""
    return (f"{name}_words AS (SELECT {key}, [x FOR x IN regexp_split_to_array(lower(text), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') IF x <> ''] AS w FROM {source}), "
            f"{name}_shingles AS (SELECT DISTINCT {key}, s FROM (SELECT {key}, unnest([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) AS s FROM {name}_words))")


@query("op5_benchmark_contamination", f"""
    WITH {_shingles_sql('d', 'documents', 'doc_id')}, {_shingles_sql('b', 'benchmark', 'item_id')},
    sizes AS (SELECT item_id, count(*) AS n FROM b_shingles GROUP BY item_id)
    SELECT doc_id, item_id, count(*) / n AS containment FROM d_shingles JOIN b_shingles USING (s) JOIN sizes USING (item_id)
    GROUP BY doc_id, item_id, n HAVING count(*) / n >= CAST(0.8 AS DOUBLE)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every benchmark item it holds."""
    found = decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "containment")


_BLANKS = "chr(32) || chr(9) || chr(13) || chr(11) || chr(12)"


@query("op4_line_spread", f"""
    WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
    t AS (SELECT doc_id, source, line, pos, trim(line, {_BLANKS}) AS bare FROM l),
    b AS (SELECT bare, min((doc_id, pos)) AS first FROM t WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT coalesce(source, chr(0))) >= {line_spread.MIN_SITES}),
    m AS (SELECT t.*, b.bare IS NOT NULL AND (doc_id, pos) <> first AS cut FROM t LEFT JOIN b USING (bare))
    SELECT doc_id, CAST(count_if(cut) AS BIGINT) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT cut), '') AS text FROM m GROUP BY doc_id
    UNION ALL SELECT doc_id, 0, NULL FROM documents WHERE text IS NULL""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand on many sites."""
    return line_spread.strip_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "n_removed", "text")


def _canonical_sql(text: str) -> str:
    quote = lambda x: x.replace("'", "''")
    out = f"lower({text})"
    for pattern, replacement in licenses.RIGHTS:
        out = f"regexp_replace({out}, '{quote(pattern)}', '{replacement}', 'g')"
    for old, new in licenses.SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    for pattern, replacement in licenses.BLANKS:
        out = f"regexp_replace({out}, '{quote(pattern)}', '{replacement}', 'g')"
    return out


def _known_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.LICENSES)
    return f"SELECT DISTINCT license, sha256(regexp_replace({_canonical_sql('t')}, '\n+', ' ', 'g')) AS digest FROM (VALUES {rows}) v(license, t)"


@query("op2_license_scan", f"""
    WITH known AS ({_known_sql()}), f AS (SELECT doc_id, {_canonical_sql('text')} AS form FROM documents),
    u AS (SELECT doc_id, 0 AS rank, form AS part FROM f UNION ALL
          SELECT doc_id, 1, unnest(regexp_split_to_array(form, '\n\n+')) FROM f UNION ALL SELECT doc_id, 2, unnest(regexp_split_to_array(form, '\n+')) FROM f),
    w AS (SELECT doc_id, license, min(rank) AS rank FROM u JOIN known ON digest = sha256(regexp_replace(part, '\n+', ' ', 'g')) WHERE part <> '' GROUP BY ALL),
    s AS (SELECT doc_id, string_agg(license || '@' || ['text', 'block', 'line'][rank + 1], ',' ORDER BY license) AS licenses FROM w GROUP BY doc_id)
    SELECT doc_id, coalesce(licenses, '') AS licenses FROM documents LEFT JOIN s USING (doc_id)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the known licences it is or holds."""
    found = licenses.by_document(table(spark, sf_dir, "documents"))
    names = F.transform("licenses", lambda x: F.concat(x["license"], F.lit("@"), x["unit"]))
    return found.select(F.col("id").alias("doc_id"), F.array_join(names, ",").alias("licenses"))


@query("op7_personal_data")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs).select("doc_id", "pii", F.filter("pii", lambda s: s["kind"].isin(*pii.BASE)).alias("base"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.BASE), F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("pii")).alias("spans"))


#: A conversation in which both turns consist of control strings.
_CONTROL_TURNS = "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(turn, role)"


def _escape_sql(text: str) -> str:
    out = f"replace({text}, chr(92), chr(92) || chr(92))"
    for mark in chat.CONTROL:
        out = f"replace({out}, '{mark}', '{mark[0]}' || chr(92) || '{mark[1:]}')"
    return out


@query("op10_chat_examples", f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
               SELECT -1, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
    o AS (SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS turns,
                 sum(length(role) + length({_escape_sql('text')}) + {len(chat.START) + len(chat.END) + 2}) OVER w AS upto
          FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(upto) FILTER (role = 'assistant' OR n = turns) AS BIGINT) AS formatted_chars FROM o GROUP BY conv_id""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation read back from its examples."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.sql(_CONTROL_TURNS))
    made = chat.examples(turns)
    read = made.select("id", "target", F.length("formatted").cast("bigint").alias("chars"),
                       F.coalesce(chat.target_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")), F.lit("")).alias("loss"),
                       F.when(F.col("whole"), chat.read_turns(F.col("formatted"))).alias("turns"))
    lines = lambda t: F.array_join(F.transform(t, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("target", "loss"))), lambda x: x["loss"]), "")
    own = read.groupBy("id").agg(F.first("turns", ignorenulls=True).alias("turns"), loss.alias("loss"), F.sum("chars").alias("formatted_chars"))
    return own.select(F.col("id").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"), F.sha2(lines(F.col("turns")), 256).alias("turns_sha256"),
                      F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


@query("op6_warc_round_trip")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page read back from the archives it was written to."""
    path = scratch(spark, "warc")
    archives.write_pages(table(spark, sf_dir, "pages"), path)
    return archives.read_pages(spark, path)


query("op11_merkle_manifest", queries_manifest.MANIFEST_SQL)(queries_manifest.op11)
query("op12_importance_resampling", queries_manifest.RESAMPLE_SQL)(queries_manifest.op12)
query("op13_exact_duplicates", queries_manifest.EXACT_SQL)(queries_manifest.op13)
