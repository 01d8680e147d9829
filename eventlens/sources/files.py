"""File sources and sinks: landed API responses, snapshots, split datasets.

All paths live under a *shared* folder: ``scratch_dir`` derives it from the
cluster's ``spark.checkpoint.dir`` (never a machine-local temp folder).
Readers always pass an explicit schema; nothing is inferred.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, MapType, StringType, StructField, StructType

from eventlens.session import ensure_checkpoint_dir

# Raw article record (nested source) as landed by the news API.
SOURCE = StructType([StructField("id", StringType()), StructField("name", StringType())])
RAW_ARTICLE = StructType([
    StructField("source", SOURCE), StructField("author", StringType()), StructField("title", StringType()),
    StructField("description", StringType()), StructField("content", StringType()),
    StructField("url", StringType()), StructField("publishedAt", StringType()),
])
RESPONSE = StructType([
    StructField("status", StringType()),
    StructField("totalResults", StringType()),
    StructField("articles", ArrayType(RAW_ARTICLE)),
])
PAGE_SIZE = 100  # fixed value: articles per landed API response


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/eventlens-{name}-{uuid.uuid4().hex[:12]}"


# ---- A3: landed API responses ------------------------------------------------

def land_responses(raw: DataFrame, root: str, status: str = "ok") -> str:
    """Write raw articles as API responses: ``category=<c>/`` JSON objects of <= 100 articles.

    Each response is one page of one category (``ord div 100``), so every
    collected list is bounded by the page size.
    """
    page = F.floor(F.col("ord") / PAGE_SIZE)
    art = F.struct(*[F.col(f.name) for f in RAW_ARTICLE.fields], F.col("ord").alias("_ord"))
    resp = raw.groupBy("category", page.alias("page")).agg(F.array_sort(
        F.collect_list(F.struct(F.col("ord").alias("k"), art.alias("a")))).alias("_s"))
    resp = resp.select("category", "page", F.lit(status).alias("status"),
                       F.size("_s").cast("string").alias("totalResults"),
                       F.transform("_s", lambda e: e["a"]).alias("articles"))
    resp.write.mode("overwrite").partitionBy("category").json(root)
    return root


def read_responses(spark: SparkSession, root: str) -> DataFrame:
    """A3: landed responses -> one row per article tagged with its category.

    A response whose ``status`` is not ``ok`` fails the read, as a failed
    API call does.  ``category`` comes from the landing folder.
    """
    art = StructType(RAW_ARTICLE.fields + [StructField("_ord", LongType())])
    schema = StructType([StructField("page", LongType()),
                         StructField("status", StringType()), StructField("totalResults", StringType()),
                         StructField("articles", ArrayType(art)),
                         StructField("category", StringType())])
    r = spark.read.schema(schema).json(root)
    checked = r.where(F.when(F.col("status") == "ok", F.lit(True))
                      .otherwise(F.raise_error(F.concat(F.lit("API response status "), F.coalesce("status", F.lit("null"))))))
    return checked.select("category", F.posexplode("articles").alias("pos", "a")).select(
        "category", "pos", "a.*")


# ---- A1 / A2 / A6: article snapshots -------------------------------------------

def snapshot_name() -> str:
    return "articles_" + datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def save_snapshot(df: DataFrame, root: str, name: str | None = None) -> str:
    """Write a JSON snapshot folder named by UTC time; returns its path."""
    path = f"{root.rstrip('/')}/{name or snapshot_name()}"
    df.write.mode("errorifexists").json(path)
    return path


def read_articles(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """A1: articles with an explicit schema (``multiLine`` for JSON-array files)."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def save_article_arrays(raw: DataFrame, root: str) -> str:
    """Articles as JSON arrays, one file for each page of a category (``PAGE_SIZE`` articles at most)."""
    page = F.floor(F.col("ord") / PAGE_SIZE).cast("long")
    art = F.struct(F.col("ord").alias("k"), F.struct(*[F.col(c) for c in raw.columns]).alias("a"))
    arrays = raw.groupBy(F.col("category").alias("folder"), page.alias("page")).agg(F.array_sort(F.collect_list(art)).alias("s"))
    arrays.select("folder", "page", F.to_json(F.transform("s", lambda e: e["a"])).alias("value")) \
          .write.mode("overwrite").partitionBy("folder", "page").text(root)
    return root


def read_latest_snapshot(spark: SparkSession, root: str, schema: StructType, by_name: bool = False) -> DataFrame:
    """A2: rows of the snapshot that was modified last (equal times: the later name); none -> error.

    ``by_name`` goes by the UTC time in the names alone, for stores that keep no
    folder times.  A snapshot without articles counts like any other.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/articles_*")
    found = pattern.getFileSystem(conf).globStatus(pattern) or []
    newest = max(((0 if by_name else f.getModificationTime(), f.getPath().toString()) for f in found if f.isDirectory()), default=None)
    if newest is None:
        raise FileNotFoundError(f"No articles_* snapshots in {root}")
    return spark.read.schema(schema).json(newest[1])


# ---- A7 / A8: nested payloads and split datasets ---------------------------------

def save_nested(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Nested records (arrays of structs) written as parquet or JSON."""
    df.write.mode("overwrite").format(fmt).save(path)
    return path


METADATA = StructType([StructField("method", StringType()), StructField("n_clusters", LongType()), StructField("n_noise", LongType()),
                       StructField("n_articles", LongType()), StructField("silhouette_score", DoubleType()),
                       StructField("params", MapType(StringType(), StringType()))])


def save_payload(entries: DataFrame, members: DataFrame, root: str, method: str, params: dict, silhouette: float | None = None) -> str:
    """A clustering as ``clusters`` (one row a cluster), ``members`` (one row an article) and ``metadata`` (one row).

    ``members`` holds all articles of the labelling, noise under cluster -1;
    the metadata are counted while the two tables are written, so they describe
    what was written and cost no pass of their own.
    """
    clusters, articles = Observation(), Observation()
    save_nested(entries.observe(clusters, F.count(F.lit(1)).alias("n")), f"{root}/clusters")
    save_nested(members.observe(articles, F.count(F.lit(1)).alias("n"), F.count_if(F.col("cluster_id") == -1).alias("noise")), f"{root}/members", "json")
    row = (method, clusters.get["n"], articles.get["noise"], articles.get["n"], silhouette, {k: str(v) for k, v in params.items()})
    save_nested(entries.sparkSession.createDataFrame([row], METADATA), f"{root}/metadata", "json")
    return root


def read_payload(spark: SparkSession, root: str, member_schema: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables of ``save_payload``: metadata, clusters, members."""
    return (spark.read.schema(METADATA).json(f"{root}/metadata"), spark.read.parquet(f"{root}/clusters"),
            spark.read.schema(member_schema).json(f"{root}/members"))


def save_split_dataset(df: DataFrame, path: str) -> str:
    """One folder per split (``split=<name>``), parquet."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """A4: one named split; the ``split=`` folder is pruned at planning time."""
    from eventlens.operators.prep import check_split
    name = check_split(split)
    return spark.read.parquet(path).where(F.col("split") == name)


# ---- A9: embedding table alignment ------------------------------------------------

def alignment_counts(articles: DataFrame, vectors: DataFrame, key: str = "ord", vkey: str = "id") -> DataFrame:
    """Counts of articles, vectors and rows missing on either side (two anti joins)."""
    a = articles.select(F.col(key).alias("_k"))
    v = vectors.select(F.col(vkey).alias("_k"))
    return (a.agg(F.count(F.lit(1)).alias("n_articles"))
            .join(v.agg(F.count(F.lit(1)).alias("n_vectors")), how="inner", on=F.lit(True))
            .join(a.join(v, "_k", "left_anti").agg(F.count(F.lit(1)).alias("missing_vectors")), how="inner", on=F.lit(True))
            .join(v.join(a, "_k", "left_anti").agg(F.count(F.lit(1)).alias("missing_articles")), how="inner", on=F.lit(True)))


def check_alignment(articles: DataFrame, vectors: DataFrame, key: str = "ord", vkey: str = "id") -> None:
    """Raise unless every article has a vector and every vector an article."""
    r = alignment_counts(articles, vectors, key, vkey).first()
    if r["missing_vectors"] or r["missing_articles"]:
        raise ValueError(f"articles and vectors do not pair up: {r['missing_vectors']} of {r['n_articles']} articles lack a vector, "
                         f"{r['missing_articles']} of {r['n_vectors']} vectors lack an article")
