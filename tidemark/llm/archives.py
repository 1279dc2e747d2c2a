"""Archives of web pages: equal payloads are stored once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import warc
from .common import materialise

_ID = "urn:page:"


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """A WARC record per page. Of pages with equal payloads of at least ``least_bytes`` that of the largest
    id is a response and the others revisit it; rows that repeat an id and payload are all responses.

    NULL html is an empty payload; a NULL id is smaller than any other. Payloads count as equal by their SHA-1.
    """
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].cast("string").alias("url"),
                        F.coalesce(pages[html_col].cast("string").cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    # only payloads that occur more than once travel; written first, so that Spark knows their size
    groups = (rows.where(F.length("payload") >= least_bytes).groupBy("sha1").agg(F.max(F.struct("id")).alias("best"), F.count("*").alias("n"))
              .where("n > 1").select(F.col("sha1").alias("shared"), F.col("best.id").alias("best")))
    groups = materialise(groups, "payloads")
    joined = rows.join(groups, rows.sha1 == groups["shared"], "left")
    again = F.col("shared").isNotNull() & ~F.col("id").eqNullSafe(F.col("best"))
    name = lambda c: F.concat(F.lit(f"<{_ID}"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    return joined.select(name("id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"),
                         F.when(again, name("best")).alias("refers_to"), "payload")


def write_pages(pages: DataFrame, path: str, **columns) -> None:
    warc.register(pages.sparkSession)
    page_records(pages, **columns).write.format("warc").mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` per record.

    Payloads of responses are decoded and held against their digests; those of revisits are never touched.
    """
    warc.register(spark)
    source = spark.read.format("warc")
    full = source.option("verify", "true").load(path).where("record_type = 'response'").withColumn("size", F.length("payload").cast("bigint"))
    again = source.option("payload", "false").load(path).where("record_type = 'revisit'").withColumn("size", F.col("payload_length"))
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '{_ID}(.*)>', 1) AS bigint)")
    return full.unionByName(again).select(page("record_id").alias("page_id"), F.col("size").alias("payload_bytes"),
                                          F.replace("payload_digest", F.lit("sha1:"), F.lit("")).alias("payload_digest"), "record_type",
                                          page("refers_to").alias("refers_to"))
