"""A training corpus in five stages: toxicity, near-duplicates, repeated passages,
mixing sources to target weights, SentencePiece ids.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's rows
as Parquet in the shared folder and reads them again as the next one's docs. All but the
last return the columns of docs. SQL can't express the stages, so there is no oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.llm import mixing, near_copies, queries, repeats, toxicity
from veristrata.llm.common import materialise, prepare, table

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold. Null and empty texts are scored like any other, and
    repeated rows alike; an empty table gives no rows; columns are carried, whatever their names."""
    model = toxicity.fit(docs, table(prepare(spark), sf_dir, "labels"))
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))  # whatever the names
    return toxicity.score(rows, model, "row").where("predicted = 0").select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity of 0.8 or more), found
    by SimHash through the index of fingerprint bytes with its count filter, then by shared
    shingles where fingerprints are too far apart, each link compared exactly: the row
    with the smallest doc_id, rows without an id last, then the smallest hash of the text.
    Rows are judged one by one, whatever their doc_id: rows of one id with unrelated texts are
    in different groups and all stay, and of rows equal in id and text one stays, any of them
    where other columns differ. Texts without words (null, empty, blank) are copies of one
    another. An empty table gives no rows; other columns are carried, whatever their names."""
    prepare(spark)
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*docs.columns).alias("row")), "rows")
    near = near_copies.near_copies(rows.select("rid", "row.doc_id", "row.text"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tkey", "rid")).alias("first")
    kept = materialise(near.groupBy("component").agg(first).select("first.rid"), "kept")
    return rows.join(kept, "rid", "left_semi").select("row.*")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat; n_chars follows. A document of which nothing is
    left keeps its row, with an empty text. A null text becomes an empty one; of repeated rows
    the first keeps its text. An empty table gives no rows; columns are carried."""
    prepare(spark)
    return repeats.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each whole pass over a document and one for its drawn blocks. Null,
    empty and blank texts have no words: they come once for each whole pass of their source.
    A null source is one of its own; an empty table gives no rows; columns are carried."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, their number and the decoded text's hash of every row, repeated ones included; null
    and empty texts have no ids. An empty table gives no rows. Other columns are not read."""
    prepare(spark)
    return queries.sentencepiece_ids(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("suffix_array_dedup", drop_repeated_passages),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
