"""Schemas of the tables the jobs read and write."""

from pyspark.sql import types as T

# Names and order of the columns of the link table.
LINKS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("pdf_link", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("classify", T.IntegerType()),
        T.StructField("classify_op", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("filename_location", T.StringType()),
    ]
)

# Names and order of the columns of the archive.
ARCHIVE = T.StructType(
    [
        T.StructField("pg_id", T.LongType()),
        T.StructField("pdf_link", T.StringType()),
        T.StructField("classify", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("last_updated", T.TimestampType()),
        T.StructField("filename_location", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("client_id", T.LongType()),
        T.StructField("pdf_link", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("pred", T.IntegerType()),
        T.StructField("filename", T.StringType()),
        T.StructField("tag_json", T.StringType()),
    ]
)

# The label file has a leading index column without a name.
LABEL_CSV = T.StructType(
    [
        T.StructField("_index", T.StringType()),
        T.StructField("LINK", T.StringType()),
        T.StructField("Presentation?", T.StringType()),
    ]
)

DATASET_CSV = T.StructType(
    [
        T.StructField("presentation", T.IntegerType()),
        T.StructField("fname", T.StringType()),
    ]
)

PAGES = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("page_num", T.IntegerType()),
        T.StructField("native_text", T.StringType()),
        T.StructField("ocr_text", T.StringType()),
    ]
)

TAG_FIELDS = ("title", "author", "date", "sector")

# Columns returned by a claim, in order.
CLAIM_COLUMNS = (
    "id",
    "pdf_link",
    "classify",
    "title",
    "sector",
    "author",
    "date",
    "classify_op",
    "filename_location",
)

# Columns of the full link export, in order.
EXPORT_COLUMNS = ("id", "pdf_link", "classify", "title", "sector", "author", "date")

# Columns a batch patch must carry.
PATCH_COLUMNS = ("classify", "title", "date", "author", "sector", "filename_location")
