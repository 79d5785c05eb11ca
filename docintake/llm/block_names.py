"""Operator 8: exact copies by deterministic block naming, with DataFrame functions only.

Normalised texts are cut into blocks of a fixed size. The distinct blocks are sorted and
numbered; a block's number is its name. Adjacent names form pairs, the distinct pairs are
sorted and numbered, and so on, until each text has one name. Two texts of as many blocks
have the same name exactly if they are equal: names stand for contents, not for hashes.

Blocks meet their names by a 64-bit hash, which is narrow. Where two different blocks of
the table share a hash, blocks meet their names by content instead. Copies of a block or a
pair collapse in the map tasks before they are shuffled, and a name that a third of all
rows carry is split by adaptive execution, since all joins are plain ones.

Defined results: a null text counts as empty; all empty texts are equal. Of equal texts the
smallest ``doc_id`` stays; null is larger than any id; of repeated rows one stays. An empty
table gives an empty result. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docintake.llm.common import fresh, table, whole_text, written

# Characters in a block.
BLOCK_CHARS = 4096

# Runs of these become one space. Single spaces are left as they are.
BLANKS = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, " ")


def blocks_of(norm: Column, size: int = BLOCK_CHARS) -> Column:
    """The text in blocks of ``size`` characters; an empty text is one empty block."""
    cut = F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.char_length(norm) > size, cut).otherwise(F.array(norm))


def numbered(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct rows with an integer name each, in sorted order within a partition.

    The names depend on nothing but the rows of a partition and its number, so a task
    that runs again gives the same ones.
    """
    return distinct.sortWithinPartitions(*keys).withColumn(
        "name", F.monotonically_increasing_id()
    )


def first_names(docs: DataFrame, size: int, fingerprint: Callable[..., Column]) -> DataFrame:
    """One row per block: ``row, doc_id, text_sha256, n_blocks, pos, name``.

    The checksum is with the first block of a text only.
    """
    norm = normalised(whole_text())
    blocks = docs.select(blocks_of(norm, size).alias("blocks")).select(
        F.explode("blocks").alias("block")
    )
    names = numbered(
        blocks.select(fingerprint("block").alias("hash"), "block").distinct(), ["hash", "block"]
    )
    rows = (
        docs.select("doc_id", norm.alias("norm"))
        .select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.sha2("norm", 256).alias("text_sha256"),
            blocks_of(F.col("norm"), size).alias("blocks"),
        )
        .select(
            "row",
            "doc_id",
            "text_sha256",
            F.size("blocks").alias("n_blocks"),
            F.posexplode("blocks"),
        )
        .select(
            "row",
            F.when(F.col("pos") == 0, F.col("doc_id")).alias("doc_id"),
            F.when(F.col("pos") == 0, F.col("text_sha256")).alias("text_sha256"),
            "n_blocks",
            F.col("pos").cast("long").alias("pos"),
            fingerprint("col").alias("hash"),
            F.col("col").alias("block"),
        )
    )
    by_hash = names.groupBy("hash").agg(
        F.min("name").alias("name"), F.count(F.lit(1)).alias("contents")
    )
    found = written(rows.drop("block").join(by_hash, "hash"), "block-names")
    if found.where("contents > 1").take(1):
        found = written(rows.join(names, ["hash", "block"]).drop("block"), "block-names")
    return found.drop("contents")


def pair_names(rows: DataFrame) -> DataFrame:
    """The next level: adjacent names of a text become the name of their pair."""

    def at(place: int) -> Column:
        return F.max(F.when(F.col("pos") % 2 == place, F.col("name")))

    pairs = rows.groupBy("row", "n_blocks", F.floor(F.col("pos") / 2).alias("pos")).agg(
        at(0).alias("a"), F.coalesce(at(1), F.lit(-1)).alias("b")
    )
    names = numbered(pairs.select("a", "b").distinct(), ["a", "b"])
    return pairs.join(names, ["a", "b"]).drop("a", "b")


def identities(
    docs: DataFrame, size: int = BLOCK_CHARS, fingerprint: Callable[..., Column] = F.xxhash64
) -> DataFrame:
    """One row per document: ``row, doc_id, text_sha256, n_blocks, name``.

    ``n_blocks`` and ``name`` together are the identity of the normalised text. As many
    levels are run as the longest text needs.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    level = first_names(docs, size, fingerprint)
    heads = level.where("pos = 0").select("row", "doc_id", "text_sha256")
    level = level.select("row", "n_blocks", "pos", "name")
    longest = level.agg(F.max("n_blocks")).first()[0] or 1
    done, blocks_left = [level.where("n_blocks = 1")], F.col("n_blocks")
    span = 1
    while span < longest:
        level = written(pair_names(level.where(blocks_left > span)), "pair-names")
        done.append(level.where((blocks_left > span) & (blocks_left <= 2 * span)))
        span *= 2
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    return heads.join(named.select("row", "n_blocks", "name"), "row")


def copies(docs: DataFrame, **settings) -> DataFrame:
    """Per document the group of its equal texts: ``doc_id, keep_id, group_size, kept,
    text_sha256``, where ``keep_id`` is the ``doc_id`` that stays."""
    named = identities(docs, **settings)
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    groups = named.groupBy("n_blocks", "name").agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size")
    )
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, **settings) -> DataFrame:
    """The documents that stay, with all their columns.

    Decisions meet documents by ``doc_id`` and checksum; of rows that agree in both, which
    are repeats, one stays.
    """
    stay = (
        copies(docs, **settings)
        .where("kept")
        .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    )
    sha = fresh("sha256", docs.columns)
    checked = docs.withColumn(sha, F.sha2(normalised(whole_text()), 256))
    same = checked["doc_id"].cast("long").eqNullSafe(stay["_id"]) & (checked[sha] == stay["_sha"])
    return checked.join(stay, same, "left_semi").dropDuplicates(["doc_id", sha]).drop(sha)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op8``: the group of each document, dropped ones too."""
    return copies(table(spark, sf_dir, "documents"))


SQL = r"""
WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
  FROM documents
)
SELECT doc_id,
  min(doc_id) OVER same AS keep_id,
  count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept,
  sha256(body) AS text_sha256
FROM norm
WINDOW same AS (PARTITION BY body)
"""
