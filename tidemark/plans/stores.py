"""What is in the stores after writes to them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.timecols import naive_timestamps
from tidemark import model
from tidemark.model import Entity, Feature, FeatureView, ValueType
from tidemark.operators import baseline, drift, lifetime
from tidemark.plans.inputs import LATE, EV, events, table, utc, with_lateness
from tidemark.session import ensure_checkpoint_dir
from tidemark.sinks import incremental, tables
from tidemark.sources import readers
from tidemark.streaming import recency as stream

VIEW = FeatureView(
    "activity",
    (Entity("user", ("user_id",), ValueType.INT64),),
    (Feature("amount", ValueType.DOUBLE), Feature("event_id", ValueType.INT64)),
    ttl_seconds=86_400,
)


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/tidemark/stores-{uuid.uuid4().hex}"


def _rows(spark, sf, condition: str = "true"):
    rows = with_lateness(events(spark, sf)).where(condition)
    return rows.select("user_id", F.col("event_ts").alias("event_time"), "ingestion_time", "amount", "event_id")


FIRST, SECOND = "event_ts < '2024-01-15'", "event_ts >= '2024-01-12' AND event_type = 'purchase'"


def table_merge(spark, sf):
    """The newest event of every user by the 15th, then the newest purchase since the 12th merged over it."""
    t = tables.VersionedTable(spark, _folder(spark), ["user_id"], buckets=16)
    tables.write_features(_rows(spark, sf, FIRST), t, "merge", VIEW)
    tables.write_features(_rows(spark, sf, SECOND), t, "merge", VIEW)
    return naive_timestamps(t.read())


def table_append(spark, sf):
    """Two batches that overlap: both are kept."""
    t = tables.VersionedTable(spark, _folder(spark), ["user_id"], buckets=16)
    tables.write_features(_rows(spark, sf, FIRST), t, "append", VIEW)
    tables.write_features(_rows(spark, sf, SECOND), t, "append", VIEW)
    return naive_timestamps(t.read())


def table_overwrite(spark, sf):
    t = tables.VersionedTable(spark, _folder(spark), ["user_id"], buckets=16)
    tables.write_features(_rows(spark, sf, FIRST), t, "append", VIEW)
    tables.write_features(_rows(spark, sf, SECOND), t, "overwrite", VIEW)
    return naive_timestamps(t.read())


def table_ingest(spark, sf):
    """History and online rows after two overlapping batches, with some events that have no user."""
    folder = _folder(spark)
    online = tables.VersionedTable(spark, f"{folder}/online", ["user_id"], buckets=16)
    for condition in (FIRST, "event_ts >= '2024-01-12'"):
        rows = _rows(spark, sf, condition).withColumn("user_id", F.when(F.col("amount") > 1, F.col("user_id")))
        tables.ingest(rows, VIEW, f"{folder}/history", online, f"{folder}/rejects")
    history = spark.read.parquet(f"{folder}/history").drop("event_date").withColumn("store", F.lit("history"))
    rejects = spark.read.parquet(f"{folder}/rejects").drop("reject_reason").withColumn("store", F.lit("rejects"))
    return naive_timestamps(history.unionByName(online.read().withColumn("store", F.lit("online"))).unionByName(rejects))


def table_stream(spark, sf):
    """The online table that a stream of the whole history, in several micro-batches, leaves behind."""
    folder = _folder(spark)
    source = _rows(spark, sf)
    source.repartitionByRange(6, "event_id").write.parquet(f"{folder}/in")
    t = tables.VersionedTable(spark, f"{folder}/table", ["user_id"], buckets=16)
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    writer = tables.write_features_stream(stream, t, f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return naive_timestamps(t.read())


def embedding_mirror(spark, sf):
    """The vector table after all vectors, then those of labels 0 to 2 again with other metadata."""
    vectors = table(spark, sf, "embeddings").select(
        F.lit("item").alias("entity_type"), F.col("vec_id").cast("string").alias("entity_id"), F.lit("v1").alias("feature_name"), "embedding",
        F.create_map(F.lit("label"), F.col("label").cast("string")).alias("metadata"),
    )
    t = tables.VersionedTable(spark, _folder(spark), tables.VECTOR_KEYS, buckets=16)
    tables.mirror_embeddings(vectors, t)
    changed = vectors.where("CAST(metadata['label'] AS INT) <= 2").withColumn("metadata", F.create_map(F.lit("label"), F.lit("changed")))
    tables.mirror_embeddings(changed, t)
    return t.read().select("doc_id", F.col("metadata")["label"].alias("label"), F.size("embedding").alias("dim"))


def materialize_incremental(spark, sf):
    """The online table after three runs, over what was ingested by the 10th, by the 20th, and in the end."""
    history = _rows(spark, sf)
    online = tables.VersionedTable(spark, _folder(spark), ["user_id"], buckets=16)
    for until in ("2024-01-10", "2024-01-20", "2024-03-01"):
        incremental.materialize(history.where(F.col("ingestion_time") < utc(until)), online)
    return naive_timestamps(online.read())


def _orders(spark, sf):
    """Orders with their ingestion: every third is a year late."""
    late = F.when(F.col("o_orderkey") % 3 == 0, F.expr("INTERVAL 365 DAYS")).otherwise(F.expr("INTERVAL 1 DAY"))
    return table(spark, sf, "orders").withColumn("ingested", F.col("o_orderdate") + late)


def user_lifetime_incremental(spark, sf):
    """Lifetime features as of 2000 from partials that were folded in three times; late orders go into their days."""
    orders, items = _orders(spark, sf), table(spark, sf, "lineitem")
    state = incremental.LifetimeState(spark, _folder(spark), "o_custkey", "l_partkey", buckets=16)
    for until in ("1997-06-01", "1999-01-01", "2100-01-01"):
        state.fold(orders.where(F.col("ingested") < utc(until)), items, "o_orderkey", "o_orderdate", "o_totalprice", "l_orderkey", "ingested")
    out = state.features(utc("2000-01-01"))
    return out.withColumns({"total_spend": F.round("total_spend", 2), "avg_order_value": F.round("avg_order_value", 6)})


def user_lifetime_risk(spark, sf):
    """The lifetime table with the newest score of each customer by the 20th."""
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    base = lifetime.user_lifetime(
        orders, items, utc("2000-01-01"), "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "l_orderkey", "l_partkey"
    )
    scores = events(spark, sf).select(F.col("user_id").alias("o_custkey"), F.col("event_ts").alias("event_time"), (F.col("amount") / 500).alias("prediction_score"))
    out = lifetime.with_churn_risk(base, scores, "o_custkey", utc("2024-01-20"))
    return out.select("o_custkey", "total_orders", F.round(F.col("churn_risk_score").cast("double"), 6).alias("churn_risk_score"))


def table_dual_write(spark, sf):
    """The same rows in two stores, and one writer that fails."""
    one, two = (tables.VersionedTable(spark, f"{_folder(spark)}", ["user_id"], buckets=16) for _ in range(2))

    def broken(df):
        raise RuntimeError("the store is down")

    rows = _rows(spark, sf, SECOND)
    results, errors = tables.dual_write(
        rows, {"one": lambda d: tables.write_features(d, one, "append"), "two": lambda d: tables.write_features(d, two, "merge"), "three": broken}
    )
    stored = one.read().select("user_id", "event_id", F.lit("one").alias("store"))
    stored = stored.unionByName(two.read().select("user_id", "event_id", F.lit("two").alias("store")))
    return stored.withColumn("failed", F.lit(len(errors)))


def drift_report_table(spark, sf):
    """Two runs in the drift table."""
    folder, items = _folder(spark), table(spark, sf, "lineitem")
    early, late = items.where("l_shipdate < '1997-01-01'"), items.where("l_shipdate >= '1997-01-01'")
    for day, current in (("2024-01-01", late), ("2024-01-02", early)):
        found = drift.detect_drift(early, current, ["l_quantity", "l_extendedprice"])
        tables.append_drift_report(found, f"{folder}/drift", "items", utc(day))
    rows = spark.read.parquet(f"{folder}/drift")
    return rows.groupBy("endpoint_name", F.col("run_date").cast("date").alias("run_date")).agg(F.count("*").alias("features"))


def baseline_artefacts(spark, sf):
    """The baseline rows and both documents, read back."""
    folder, items = _folder(spark), table(spark, sf, "lineitem").select("l_quantity", "l_discount")
    stats = baseline.baseline_statistics(items)
    constraints = baseline.baseline_constraints(stats)
    paths = tables.write_baseline(
        items, folder, baseline.statistics_document(stats, baseline.baseline_buckets(items)), baseline.constraints_document(constraints)
    )
    document = spark.read.json(paths["stats_path"]).select(F.inline("features")).select("name", F.col("numerical_statistics.common.num_present").alias("num_present"))
    rules = spark.read.json(paths["constraints_path"]).select(F.inline("features")).select("name", "completeness")
    rows = spark.read.parquet(paths["baseline_path"]).agg(F.count("*").alias("baseline_rows"))
    return document.join(rules, "name").withColumn("baseline_rows", F.lit(rows.first()[0]))


def redelivered_events(spark, sf):
    """Events that a stream delivers twice, in several parts: each is stored once."""
    folder = _folder(spark)
    ev = events(spark, sf).select("event_id", "user_id", "event_ts")
    raw = spark.readStream.schema(ev.schema).parquet(f"{folder}/in/*")
    for k in range(2):
        ev.unionByName(ev.where("event_id % 2 = 0")).repartition(4).write.parquet(f"{folder}/in/part={k}")
    query = (
        stream.deduplicated(raw, "event_id", "event_ts", "60 days").writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return naive_timestamps(spark.read.schema(ev.schema).parquet(f"{folder}/out"))


def stored_training_data(spark, sf):
    """A table written by date, read through the readers: chosen columns and a range of dates."""
    folder = _folder(spark)
    rows = _rows(spark, sf).withColumn("event_date", F.to_date("event_time"))
    rows.write.partitionBy("event_date").parquet(f"{folder}/history")
    found = readers.read_table(spark, f"{folder}/history").where("event_date BETWEEN '2024-01-10' AND '2024-01-15'")
    return naive_timestamps(model.conform(found, VIEW))


QUERIES = {
    f.__name__: f
    for f in (
        table_merge,
        table_append,
        table_overwrite,
        table_ingest,
        table_stream,
        table_dual_write,
        embedding_mirror,
        materialize_incremental,
        user_lifetime_incremental,
        user_lifetime_risk,
        drift_report_table,
        baseline_artefacts,
        redelivered_events,
        stored_training_data,
    )
}

_ROWS = f"""{EV},
rows AS (SELECT user_id, event_ts AS event_time, {LATE} AS ingestion_time, amount, event_id, event_type, event_ts FROM ev),
first AS (SELECT * FROM rows WHERE {FIRST}),
second AS (SELECT * FROM rows WHERE {SECOND})"""
_NAMES = "user_id, event_time, ingestion_time, amount, event_id"


def _newest(rows: str, keys: str = "user_id") -> str:
    return f"SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY event_time DESC, ingestion_time DESC, event_id DESC) = 1"


ORACLE = {
    "table_merge": f"""WITH {_ROWS}, old AS ({_newest("first")}), new AS ({_newest("second")})
SELECT {_NAMES} FROM new UNION ALL SELECT {_NAMES} FROM old WHERE user_id NOT IN (SELECT user_id FROM new)""",
    "table_append": f"WITH {_ROWS} SELECT {_NAMES} FROM first UNION ALL SELECT {_NAMES} FROM second",
    "table_overwrite": f"WITH {_ROWS} SELECT {_NAMES} FROM second",
    "table_ingest": f"""WITH {_ROWS}, good AS (SELECT * FROM rows WHERE amount > 1)
SELECT {_NAMES}, 'history' AS store FROM ({_newest("good", "user_id, event_time")})
UNION ALL SELECT {_NAMES}, 'online' FROM ({_newest("good")})
UNION ALL SELECT CAST(NULL AS BIGINT), event_time, ingestion_time, amount, event_id, 'rejects'
FROM (SELECT * FROM first UNION ALL SELECT * FROM rows WHERE event_ts >= '2024-01-12') WHERE coalesce(amount <= 1, true)""",
    "table_stream": f"WITH {_ROWS} SELECT {_NAMES} FROM ({_newest('rows')})",
    "embedding_mirror": """
SELECT concat_ws(':', 'item', vec_id, 'v1') AS doc_id, CASE WHEN label <= 2 THEN 'changed' ELSE CAST(label AS VARCHAR) END AS label,
       CAST(len(embedding) AS INTEGER) AS dim
FROM embeddings""",
    "table_dual_write": f"""WITH {_ROWS}
SELECT user_id, event_id, 'one' AS store, 1 AS failed FROM second UNION ALL SELECT user_id, event_id, 'two', 1 FROM ({_newest("second")})""",
    "materialize_incremental": f"WITH {_ROWS} SELECT {_NAMES} FROM ({_newest('rows')})",
    "user_lifetime_incremental": """
WITH o AS (SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '2000-01-01'),
p AS (SELECT o_custkey, count(DISTINCT l_partkey) AS n FROM o JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT o_custkey, CAST(date_diff('day', CAST(min(o_orderdate) AS DATE), DATE '2000-01-01') AS INTEGER) AS account_age_days,
       CAST(count(*) AS INTEGER) AS total_orders, round(sum(o_totalprice), 2) AS total_spend,
       round(sum(o_totalprice) / count(*), 6) AS avg_order_value, CAST(coalesce(any_value(n), 0) AS INTEGER) AS distinct_products_purchased
FROM o LEFT JOIN p USING (o_custkey) GROUP BY o_custkey""",
    "user_lifetime_risk": """
WITH s AS (SELECT user_id, arg_max(value / 500, ts) AS score FROM events WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY 1)
SELECT o_custkey, CAST(count(*) AS INTEGER) AS total_orders, round(CAST(CAST(any_value(score) AS FLOAT) AS DOUBLE), 6) AS churn_risk_score
FROM orders LEFT JOIN s ON user_id = o_custkey WHERE o_orderdate <= TIMESTAMP '2000-01-01' GROUP BY o_custkey""",
    "drift_report_table": """
SELECT 'items' AS endpoint_name, d AS run_date, CAST(count(DISTINCT f) AS BIGINT) AS features
FROM (VALUES (DATE '2024-01-01'), (DATE '2024-01-02')) t(d), (VALUES ('l_quantity'), ('l_extendedprice')) u(f)
WHERE EXISTS (SELECT 1 FROM lineitem) GROUP BY d""",
    "baseline_artefacts": """
SELECT name, CAST(present AS BIGINT) AS num_present, greatest(0.95, present / total - 0.05) AS completeness, CAST(total AS INTEGER) AS baseline_rows
FROM (SELECT 'l_quantity' AS name, count(l_quantity) AS present, count(*) AS total FROM lineitem
      UNION ALL SELECT 'l_discount', count(l_discount), count(*) FROM lineitem)""",
    "redelivered_events": "SELECT event_id, user_id, ts AS event_ts FROM events",
    "stored_training_data": f"""WITH {_ROWS}
SELECT {_NAMES} FROM rows WHERE CAST(event_time AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'""",
}
