"""Full-text search with ranking: an inverted index of a table of texts, and BM25 scores.

The index is a table of postings, one row for each term and text with the term's count and the text's length, written by the
term's hash into ``shards`` folders, so a search reads only the folders of its own terms. Scores need no pass over other texts:
a term's number of texts is counted from its postings, the corpus's size and mean length are stored beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.text import STOP_WORDS

K1, B = 1.2, 0.75
SHARDS = 16


def words(text: Column) -> Column:
    """All lower-case words of a text in order, without stop words."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(STOP_WORDS))


def shard_of(term: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(shards)).cast("int")


def build_index(texts: DataFrame, id: str, text: str, path: str, shards: int = SHARDS) -> None:
    """Write the index of ``texts`` to ``path``; a null text has no words, and rows of one id are one text."""
    whole = texts.groupBy(F.col(id).alias("id")).agg(F.flatten(F.collect_list(words(F.col(text)))).alias("words"))
    counted = whole.select("id", F.size("words").alias("length"), F.explode("words").alias("term")).groupBy("id", "length", "term").agg(
        F.count(F.lit(1)).alias("times"))
    counted.withColumn("shard", shard_of(F.col("term"), shards)).repartition("shard", F.xxhash64("id") % 8).sortWithinPartitions(
        "term", "id").write.partitionBy("shard").parquet(f"{path}/postings")
    whole.agg(F.count(F.lit(1)).alias("texts"), F.avg(F.size("words")).alias("mean"), F.lit(shards).alias("shards"),
              F.first(F.lit(None).cast(whole.schema["id"].dataType)).alias("id")).write.parquet(f"{path}/size")  # the id's type only


def search(spark: SparkSession, path: str, query: str, k: int = 10) -> DataFrame:
    """``id, score, rank`` of the ``k`` best texts that hold a word of the query; ties go to the smaller id."""
    about = spark.read.parquet(f"{path}/size")
    size, kind = about.first(), about.schema["id"].dataType.simpleString()
    terms = spark.range(1).select(F.array_distinct(words(F.lit(query))).alias("t")).first().t
    folders = [r[0] for r in spark.createDataFrame([(t,) for t in terms], "t string").select(
        shard_of(F.col("t"), size["shards"])).distinct().collect()]
    postings = spark.read.schema(f"id {kind}, length int, term string, times long, shard int").parquet(f"{path}/postings").where(F.col("shard").isin(folders) & F.col("term").isin(terms))
    known = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.log(1 + (size["texts"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("length") / F.lit(float(size["mean"] or 1.0)))
    gain = weight * F.col("times") * (K1 + 1) / (F.col("times") + norm)
    scored = postings.join(F.broadcast(known), "term").groupBy("id").agg(F.round(F.sum(gain), 9).alias("score"))  # a row for each term
    order = [F.desc("score"), F.col("id")]
    return scored.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # k rows
