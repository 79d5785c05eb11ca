"""Intake tables derived from the given tables, as DataFrames and as SQL text.

The DataFrame form feeds the queries and the SQL form feeds their oracles, so each
recipe is written twice on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        n.alias("id"),
        F.when(n % 4 == 0, F.concat("url", F.lit(".pdf")))
        .when(n % 4 == 1, F.concat("url", F.lit(".HTM")))
        .when(n % 4 == 2, F.col("url"))
        .otherwise(F.concat("url", F.lit(".html")))
        .alias("pdf_link"),
        F.when(n % 7 == 0, "in_process")
        .when(n % 7 == 1, None)
        .when(n % 7 == 2, "done")
        .otherwise("ready")
        .alias("status"),
        F.when((n % 5).isin(1, 2, 3), n % 5).cast("int").alias("classify"),
        (n % 4).cast("int").alias("classify_op"),
        F.when(n % 6 == 0, F.concat(F.lit("Title "), _text(n))).when(n % 6 == 1, "").alias("title"),
        F.when(n % 8 == 0, "Energy").alias("sector"),
        F.lit(None).cast("string").alias("author"),
        F.when(n % 9 == 0, "January 1, 2020").alias("date"),
        F.when(n % 3 == 0, F.concat(F.lit("/files/"), _text(n), F.lit(".pdf"))).alias(
            "filename_location"
        ),
    )


LINKS = """links AS (
SELECT page_id AS id,
  CASE page_id % 4 WHEN 0 THEN concat(url, '.pdf') WHEN 1 THEN concat(url, '.HTM') WHEN 2 THEN url ELSE concat(url, '.html') END AS pdf_link,
  CASE page_id % 7 WHEN 0 THEN 'in_process' WHEN 1 THEN NULL WHEN 2 THEN 'done' ELSE 'ready' END AS status,
  CAST(CASE WHEN page_id % 5 IN (1, 2, 3) THEN page_id % 5 END AS INT) AS classify,
  CAST(page_id % 4 AS INT) AS classify_op,
  CASE page_id % 6 WHEN 0 THEN concat('Title ', CAST(page_id AS VARCHAR)) WHEN 1 THEN '' END AS title,
  CASE WHEN page_id % 8 = 0 THEN 'Energy' END AS sector,
  CAST(NULL AS VARCHAR) AS author,
  CASE WHEN page_id % 9 = 0 THEN 'January 1, 2020' END AS date,
  CASE WHEN page_id % 3 = 0 THEN concat('/files/', CAST(page_id AS VARCHAR), '.pdf') END AS filename_location
FROM pages)"""


def answer(doc: Column, page: Column) -> Column:
    """A model's answer for a page: malformed, blank, keyless, mistyped or good."""
    case = (doc + page) % 6
    return (
        F.when(case == 0, '{"title":')
        .when(case == 1, '{"title":"  ","author":"A","date":"","sector":"Other"}')
        .when(case == 2, '{"author":"A","date":"2020","sector":"Energy"}')
        .when(case == 3, '{"title":5,"author":"A","date":"2020","sector":"Energy"}')
        .otherwise(
            F.concat(
                F.lit('{"title":"T'),
                _text(doc),
                F.lit("-"),
                _text(page),
                F.lit('","author":"A","date":"2020","sector":"Energy"}'),
            )
        )
    )


def answer_sql(doc: str, page: str) -> str:
    return f"""CASE ({doc} + {page}) % 6
    WHEN 0 THEN '{{"title":'
    WHEN 1 THEN '{{"title":"  ","author":"A","date":"","sector":"Other"}}'
    WHEN 2 THEN '{{"author":"A","date":"2020","sector":"Energy"}}'
    WHEN 3 THEN '{{"title":5,"author":"A","date":"2020","sector":"Energy"}}'
    ELSE concat('{{"title":"T', CAST({doc} AS VARCHAR), '-', CAST({page} AS VARCHAR), '","author":"A","date":"2020","sector":"Energy"}}') END"""


def link_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = links(spark, sf_dir).select("id", "pdf_link")
    events = table(spark, sf_dir, "events")
    n = F.col("event_id")
    unknown = F.concat(F.lit("http://unknown.example.org/"), _text(F.col("user_id")))
    return events.join(known, known["id"] == events["user_id"] * 2, "left").select(
        n,
        "ts",
        F.col("user_id").alias("client_id"),
        F.coalesce("pdf_link", unknown).alias("pdf_link"),
        F.when(F.col("event_type") == "view", "tab_opened")
        .when(F.col("event_type") == "click", "maybe_pdf")
        .when(F.col("event_type") == "signup", "html_seen")
        .when(F.col("event_type") == "purchase", "download_complete")
        .otherwise("download_interrupted")
        .alias("kind"),
        (n % 5).cast("int").alias("pred"),
        F.when(n % 17 == 0, "")
        .otherwise(F.concat(F.lit("/files/"), _text(n), F.lit(".pdf")))
        .alias("filename"),
        answer(n % 200, F.lit(1)).alias("tag_json"),
    )


LINK_EVENTS = f"""link_events AS (
SELECT e.event_id, e.ts, e.user_id AS client_id,
  coalesce(l.pdf_link, concat('http://unknown.example.org/', CAST(e.user_id AS VARCHAR))) AS pdf_link,
  CASE e.event_type WHEN 'view' THEN 'tab_opened' WHEN 'click' THEN 'maybe_pdf' WHEN 'signup' THEN 'html_seen' WHEN 'purchase' THEN 'download_complete' ELSE 'download_interrupted' END AS kind,
  CAST(e.event_id % 5 AS INT) AS pred,
  CASE WHEN e.event_id % 17 = 0 THEN '' ELSE concat('/files/', CAST(e.event_id AS VARCHAR), '.pdf') END AS filename,
  {answer_sql("(e.event_id % 200)", "1")} AS tag_json
FROM events e LEFT JOIN links l ON l.id = e.user_id * 2)"""


def client_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log of few clients with several links each."""
    return link_events(spark, sf_dir).withColumn("client_id", F.col("client_id") % 20)


CLIENT_EVENTS = """client_events AS (
SELECT * REPLACE (client_id % 20 AS client_id) FROM link_events)"""


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches from completed downloads: repeated and unknown links, NULL and ''."""
    n = F.col("event_id")
    done = link_events(spark, sf_dir).where(F.col("kind") == "download_complete")
    return done.select(
        "pdf_link",
        n.alias("ordinal"),
        F.when(n % 5 > 0, F.col("pred")).alias("classify"),
        F.when(n % 3 == 0, None)
        .when(n % 3 == 1, "")
        .otherwise(F.concat(F.lit("P"), _text(n)))
        .alias("title"),
        F.when(n % 4 == 0, "2020").when(n % 4 == 1, "").alias("date"),
        F.when(n % 2 == 0, F.concat(F.lit("A"), _text(n))).alias("author"),
        F.when(n % 7 == 0, "Utilities").alias("sector"),
        F.when(n % 11 == 0, "ready").when(n % 11 == 1, "").alias("status"),
        F.nullif("filename", F.lit("")).alias("filename_location"),
    )


PATCHES = """patches AS (
SELECT pdf_link, event_id AS ordinal,
  CASE WHEN event_id % 5 > 0 THEN pred END AS classify,
  CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('P', CAST(event_id AS VARCHAR)) END AS title,
  CASE event_id % 4 WHEN 0 THEN '2020' WHEN 1 THEN '' END AS date,
  CASE WHEN event_id % 2 = 0 THEN concat('A', CAST(event_id AS VARCHAR)) END AS author,
  CASE WHEN event_id % 7 = 0 THEN 'Utilities' END AS sector,
  CASE event_id % 11 WHEN 0 THEN 'ready' WHEN 1 THEN '' END AS status,
  nullif(filename, '') AS filename_location
FROM link_events WHERE kind = 'download_complete')"""


def labels_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    return table(spark, sf_dir, "labels").select(
        F.concat(F.lit("http://labels.example.org/"), _text(n)).alias("LINK"),
        F.when(F.col("toxic") == 1, None)
        .when((F.col("quality") == 1) & (n % 3 == 0), "50/50")
        .when(F.col("quality") == 1, "Yes")
        .otherwise("No")
        .alias("Presentation?"),
    )


LABELS_RAW = """labels_raw AS (
SELECT concat('http://labels.example.org/', CAST(doc_id AS VARCHAR)) AS link,
  CASE WHEN toxic = 1 THEN NULL WHEN quality = 1 AND doc_id % 3 = 0 THEN '50/50' WHEN quality = 1 THEN 'Yes' ELSE 'No' END AS presentation_raw
FROM labels)"""


def doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of documents; one line of text stands for one page."""
    doc, page, line = F.col("doc_id"), F.col("page_num"), F.col("line")
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )
    spaces = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return lines.withColumn("page_num", F.col("pos") + 1).select(
        "doc_id",
        "page_num",
        F.when(page % 3 == 0, "").otherwise(line).alias("native_text"),
        F.when((doc + page) % 4 == 0, None)
        .otherwise(F.replace(line, F.lit("e"), F.lit("c")))
        .alias("ocr_text"),
        (spaces + 1).cast("int").alias("word_count"),
        ((doc * 7 + page) % 5).cast("int").alias("image_count"),
        F.when(page % 2 == 0, 0.75).otherwise(1.25).alias("aspect_ratio"),
    )


DOC_PAGES = """doc_lines AS (
SELECT doc_id, CAST(u.pos AS INT) AS page_num, u.txt AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents) d, unnest(d.parts) WITH ORDINALITY AS u(txt, pos)),
doc_pages AS (
SELECT doc_id, page_num,
  CASE WHEN page_num % 3 = 0 THEN '' ELSE line END AS native_text,
  CASE WHEN (doc_id + page_num) % 4 = 0 THEN NULL ELSE replace(line, 'e', 'c') END AS ocr_text,
  CAST(length(line) - length(replace(line, ' ', '')) + 1 AS INT) AS word_count,
  CAST((doc_id * 7 + page_num) % 5 AS INT) AS image_count,
  CAST(CASE WHEN page_num % 2 = 0 THEN 0.75 ELSE 1.25 END AS DOUBLE) AS aspect_ratio
FROM doc_lines)"""


def with_answers(pages: DataFrame) -> DataFrame:
    return pages.withColumn("completion", answer(F.col("doc_id"), F.col("page_num")))


COMPLETIONS = f"""completions AS (
SELECT doc_id, page_num, {answer_sql("doc_id", "page_num")} AS completion FROM doc_pages)"""


def big_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        n.alias("id"),
        F.concat(
            F.lit("http://h"),
            _text(F.col("o_custkey")),
            F.lit(".example.org/"),
            _text(n),
            F.when(n % 3 == 0, ".pdf").when(n % 3 == 1, ".html").otherwise(""),
        ).alias("pdf_link"),
        F.when(F.col("o_orderstatus") == "F", "in_process")
        .when(F.col("o_orderstatus") == "O", "ready")
        .alias("status"),
        F.when((n % 5).isin(1, 2, 3), n % 5).cast("int").alias("classify"),
        F.lit(0).alias("classify_op"),
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("sector"),
        F.lit(None).cast("string").alias("author"),
        F.lit(None).cast("string").alias("date"),
        F.when(n % 3 == 0, F.concat(F.lit("/files/"), _text(n))).alias("filename_location"),
    )


BIG_LINKS = """big_links AS (
SELECT o_orderkey AS id,
  concat('http://h', CAST(o_custkey AS VARCHAR), '.example.org/', CAST(o_orderkey AS VARCHAR), CASE o_orderkey % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.html' ELSE '' END) AS pdf_link,
  CASE o_orderstatus WHEN 'F' THEN 'in_process' WHEN 'O' THEN 'ready' ELSE NULL END AS status,
  CAST(CASE WHEN o_orderkey % 5 IN (1, 2, 3) THEN o_orderkey % 5 END AS INT) AS classify,
  0 AS classify_op,
  CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS sector, CAST(NULL AS VARCHAR) AS author, CAST(NULL AS VARCHAR) AS date,
  CASE WHEN o_orderkey % 3 = 0 THEN concat('/files/', CAST(o_orderkey AS VARCHAR)) END AS filename_location
FROM orders)"""

# Big events have a number made of what tells them apart.
BIG_ORDER = ("ts", "event_id")


def big_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = big_links(spark, sf_dir).select("id", "pdf_link")
    lines = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    part = F.col("l_partkey")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    told_apart = F.concat_ws("|", *[_text(c) for c in (F.col("l_orderkey"), n, part, cents)])
    return lines.join(known, known["id"] == lines["l_orderkey"]).select(
        F.col("l_shipdate").alias("ts"),
        F.conv(F.substring(F.md5(told_apart), 1, 15), 16, 10).cast("long").alias("event_id"),
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        F.col("l_suppkey").alias("client_id"),
        "pdf_link",
        F.when(n % 5 == 0, "tab_opened")
        .when(n % 5 == 1, "maybe_pdf")
        .when(n % 5 == 2, "html_seen")
        .when(n % 5 == 3, "download_complete")
        .otherwise("download_interrupted")
        .alias("kind"),
        (part % 5).cast("int").alias("pred"),
        F.concat(F.lit("/files/"), _text(part)).alias("filename"),
        answer(part, n).alias("tag_json"),
    )


BIG_EVENTS = f"""big_events AS (
SELECT l.l_shipdate AS ts,
  CAST('0x' || substr(md5(concat_ws('|', l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(round(l.l_extendedprice * 100) AS BIGINT))), 1, 15) AS BIGINT) AS event_id,
  l.l_linenumber, l.l_partkey, l.l_extendedprice, l.l_suppkey AS client_id, b.pdf_link,
  CASE l.l_linenumber % 5 WHEN 0 THEN 'tab_opened' WHEN 1 THEN 'maybe_pdf' WHEN 2 THEN 'html_seen' WHEN 3 THEN 'download_complete' ELSE 'download_interrupted' END AS kind,
  CAST(l.l_partkey % 5 AS INT) AS pred,
  concat('/files/', CAST(l.l_partkey AS VARCHAR)) AS filename,
  {answer_sql("l.l_partkey", "l.l_linenumber")} AS tag_json
FROM lineitem l JOIN big_links b ON b.id = l.l_orderkey)"""


def retry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Big events; those of every fourth link name one that is not in the table."""
    known = big_links(spark, sf_dir).select("id", "pdf_link")
    events = big_events(spark, sf_dir)
    unknown = F.concat(F.lit("http://unknown.example.org/"), _text(F.col("id")))
    link = F.when(F.col("id") % 4 == 0, unknown).otherwise(F.col("pdf_link"))
    return events.join(known, "pdf_link").withColumn("pdf_link", link).drop("id")


RETRY_EVENTS = """retry_events AS (
SELECT e.* REPLACE (CASE WHEN b.id % 4 = 0 THEN concat('http://unknown.example.org/', CAST(b.id AS VARCHAR)) ELSE e.pdf_link END AS pdf_link)
FROM big_events e JOIN big_links b ON b.pdf_link = e.pdf_link)"""
