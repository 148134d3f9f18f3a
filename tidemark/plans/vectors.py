"""Embedding queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import embeddings as emb
from tidemark.operators.vector_index import build_vector_index
from tidemark.plans.inputs import table
from tidemark.session import ensure_checkpoint_dir


def _vectors(spark, sf):
    return table(spark, sf, "embeddings")


def centroids(spark, sf):
    """One request vector per label: the mean of its vectors."""
    return (
        _vectors(spark, sf)
        .select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy(F.col("label").alias("query_id"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("query"))
    )


def normalize_embedding(spark, sf):
    """Vectors stretched by their label, then normalised; one row per component."""
    stretched = _vectors(spark, sf).withColumn(
        "embedding", F.transform("embedding", lambda x: (x * (F.col("label") + 1)).cast("float"))
    )
    out = emb.normalize_embedding(stretched, "embedding", "unit")
    return out.select("vec_id", F.posexplode("unit").alias("pos", "x")).withColumn(
        "x", F.round(F.col("x").cast("double"), 5)
    )


def embedding_dot_product(spark, sf):
    """Every vector with its label's centroid; vectors of label 0 are cut short and score 0."""
    v = _vectors(spark, sf).join(centroids(spark, sf).withColumnRenamed("query_id", "label"), "label")
    v = v.withColumn("query", F.when(F.col("label") == 0, F.slice("query", 1, 8)).otherwise(F.col("query")))
    out = emb.embedding_dot_product(v, "embedding", "query")
    return out.select("vec_id", F.round(F.col("dot_product").cast("double"), 4).alias("dot_product"))


def embedding_dim_filter(spark, sf):
    """Vectors of label 0 are cut to 32 components and dropped."""
    cut = _vectors(spark, sf).withColumn(
        "embedding", F.when(F.col("label") == 0, F.slice("embedding", 1, 32)).otherwise(F.col("embedding"))
    )
    return emb.validate_embedding_dim(cut, "embedding", 64).select("vec_id", "label")


def _knn(spark, sf, metric, **options):
    out = emb.knn(
        centroids(spark, sf), _vectors(spark, sf), "query_id", "query", "vec_id", "embedding", 10, metric, digits=9, **options
    )
    return out.withColumn("distance", F.round("distance", 6))


def knn_cosine(spark, sf):
    return _knn(spark, sf, "cosine")


def knn_l2(spark, sf):
    return _knn(spark, sf, "l2")


def knn_ip(spark, sf):
    return _knn(spark, sf, "ip")


def knn_filtered(spark, sf):
    """Only neighbours of a label above 2 and with a cosine of at least 0.05."""
    return _knn(spark, sf, "cosine", where=F.col("label") > 2, min_score=0.05)


def _knn_indexed(spark, sf, metric, **options):
    """The same through a stored index of the vectors by label."""
    path = f"{ensure_checkpoint_dir(spark)}/tidemark/index-{uuid.uuid4().hex}"
    index = build_vector_index(_vectors(spark, sf), path, "vec_id", "embedding", metric, "label", cell_rows=256)
    out = index.search(centroids(spark, sf), "query_id", "query", 10, metric, digits=9, **options)
    return out.withColumn("distance", F.round("distance", 6))


def knn_indexed_cosine(spark, sf):
    return _knn_indexed(spark, sf, "cosine")


def knn_indexed_l2(spark, sf):
    return _knn_indexed(spark, sf, "l2")


def knn_indexed_ip(spark, sf):
    return _knn_indexed(spark, sf, "ip")


def knn_indexed_filtered(spark, sf):
    """Only neighbours of labels 3 to 9: files of other types are not read."""
    return _knn_indexed(spark, sf, "cosine", kinds=[str(i) for i in range(3, 10)]).where("1 - distance >= 0.05")


QUERIES = {
    f.__name__: f
    for f in (
        normalize_embedding,
        embedding_dot_product,
        embedding_dim_filter,
        knn_cosine,
        knn_l2,
        knn_ip,
        knn_filtered,
        knn_indexed_cosine,
        knn_indexed_l2,
        knn_indexed_ip,
        knn_indexed_filtered,
    )
}

_CENTROIDS = """parts AS (
  SELECT label, unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding) AS x FROM embeddings),
means AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM parts GROUP BY 1, 2),
q AS (SELECT label AS query_id, list(x ORDER BY pos) AS query FROM means GROUP BY 1),
b AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""


def _knn_sql(distance: str, where: str = "true") -> str:
    return f"""WITH {_CENTROIDS},
d AS (SELECT query_id, vec_id AS neighbor_id, round({distance}, 9) AS distance FROM q, b WHERE {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM d)
SELECT query_id, neighbor_id, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10"""


ORACLE = {
    "normalize_embedding": """
WITH s AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(CAST(x * (label + 1) AS FLOAT) AS DOUBLE)) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM s)
SELECT vec_id, CAST(unnest(range(0, len(v))) AS INTEGER) AS pos,
       round(CAST(CAST(unnest(list_transform(v, lambda x: x / norm)) AS FLOAT) AS DOUBLE), 5) AS x
FROM n""",
    "embedding_dot_product": f"""WITH {_CENTROIDS}
SELECT vec_id, round(CAST(CASE WHEN label = 0 THEN 0 ELSE list_dot_product(v, query) END AS FLOAT)::DOUBLE, 4) AS dot_product
FROM b JOIN q ON query_id = label""",
    "embedding_dim_filter": "SELECT vec_id, label FROM embeddings WHERE label <> 0",
    "knn_cosine": _knn_sql("1 - list_cosine_similarity(query, v)"),
    "knn_l2": _knn_sql("list_distance(query, v)"),
    "knn_ip": _knn_sql("-list_dot_product(query, v)"),
    "knn_filtered": f"""WITH k AS ({_knn_sql("1 - list_cosine_similarity(query, v)", "label > 2")})
SELECT * FROM k WHERE 1 - distance >= 0.05""",
}
ORACLE |= {f"knn_indexed_{m}": ORACLE[f"knn_{m}"] for m in ("cosine", "l2", "ip")}
ORACLE["knn_indexed_filtered"] = f"""WITH k AS ({_knn_sql("1 - list_cosine_similarity(query, v)", "label BETWEEN 3 AND 9")})
SELECT * FROM k WHERE 1 - distance >= 0.05"""
