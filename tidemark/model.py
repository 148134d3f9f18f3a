"""Feature views and their schemas."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ValueType(str, Enum):
    STRING = "string"
    INT32 = "int32"
    INT64 = "int64"
    FLOAT = "float"
    DOUBLE = "double"
    BOOL = "bool"
    BYTES = "bytes"
    STRING_LIST = "string_list"
    INT64_LIST = "int64_list"
    FLOAT_LIST = "float_list"

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self]


_SPARK_TYPES: dict[ValueType, T.DataType] = {
    ValueType.STRING: T.StringType(),
    ValueType.INT32: T.IntegerType(),
    ValueType.INT64: T.LongType(),
    ValueType.FLOAT: T.FloatType(),
    ValueType.DOUBLE: T.DoubleType(),
    ValueType.BOOL: T.BooleanType(),
    ValueType.BYTES: T.BinaryType(),
    ValueType.STRING_LIST: T.ArrayType(T.StringType()),
    ValueType.INT64_LIST: T.ArrayType(T.LongType()),
    ValueType.FLOAT_LIST: T.ArrayType(T.FloatType()),
}


class Store(str, Enum):
    """Which of the two feature tables a write goes to."""

    OFFLINE = "offline"
    ONLINE = "online"
    BOTH = "both"


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple[str, ...]
    value_type: ValueType = ValueType.STRING
    description: str = ""


@dataclass(frozen=True)
class Feature:
    name: str
    value_type: ValueType
    description: str = ""
    dim: int | None = None
    """Length every vector of this feature must have."""


@dataclass(frozen=True)
class FeatureView:
    """A keyed, time-versioned set of features with a freshness limit."""

    name: str
    entities: tuple[Entity, ...]
    features: tuple[Feature, ...]
    ttl_seconds: int
    online: bool = True
    offline_only: bool = False
    owner: str = ""
    tags: dict[str, str] = field(default_factory=dict)
    description: str = ""

    def __post_init__(self) -> None:
        if self.offline_only and self.online:
            raise ValueError("a view cannot be both offline_only and online")
        if self.ttl_seconds <= 0:
            raise ValueError("ttl_seconds must be positive")
        names = self.keys + self.feature_names
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate column names in view {self.name}")

    @property
    def keys(self) -> list[str]:
        return [k for e in self.entities for k in e.join_keys]

    @property
    def feature_names(self) -> list[str]:
        return [f.name for f in self.features]

    def schema(self, key_types: dict[str, T.DataType] | None = None) -> T.StructType:
        by_key = {k: e.value_type.spark_type for e in self.entities for k in e.join_keys}
        by_key.update(key_types or {})
        return T.StructType(
            [T.StructField(k, by_key[k]) for k in self.keys]
            + [T.StructField("event_time", T.TimestampType()), T.StructField("ingestion_time", T.TimestampType())]
            + [T.StructField(f.name, f.value_type.spark_type) for f in self.features]
        )


@dataclass(frozen=True)
class TrainingSpec:
    """What a training set is made of: the label table and the views joined to it."""

    label_table: str
    join_keys: tuple[str, ...]
    event_time_column: str
    views: tuple[str, ...]
    features: tuple[str, ...] | None = None


class SchemaMismatch(ValueError):
    """A DataFrame does not have exactly the columns and types of its view."""


def check_schema(df: DataFrame, view: FeatureView, check_keys: bool = False) -> None:
    """Raise on unknown, missing or mistyped columns; reads no data."""
    expected = {f.name: f.dataType for f in view.schema().fields}
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"unknown column {c}" for c in actual if c not in expected]
    problems += [f"missing column {c}" for c in expected if c not in actual]
    for name, want in expected.items():
        if name not in actual or (name in view.keys and not check_keys):
            continue
        if actual[name].simpleString() != want.simpleString():
            problems.append(f"{name} is {actual[name].simpleString()}, expected {want.simpleString()}")
    if problems:
        raise SchemaMismatch(f"view {view.name}: " + "; ".join(problems))


def conform(df: DataFrame, view: FeatureView) -> DataFrame:
    """Select and cast to the view's feature types, keys kept as they are."""
    types = {f.name: f.value_type.spark_type for f in view.features}
    times = [F.col(c).cast("timestamp").alias(c) for c in ("event_time", "ingestion_time") if c in df.columns]
    return df.select(*view.keys, *times, *[F.col(n).cast(t).alias(n) for n, t in types.items()])


def reject_rows(df: DataFrame, view: FeatureView) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with ``reject_reason``): keys and event time present, vector lengths right."""
    reason = F.concat_ws(
        "; ",
        *[F.when(F.col(k).isNull(), F.lit(f"null key {k}")) for k in view.keys],
        F.when(F.col("event_time").isNull(), F.lit("null event_time")),
        *[
            F.when(F.size(f.name) != f.dim, F.lit(f"{f.name} is not of length {f.dim}"))
            for f in view.features
            if f.dim is not None
        ],
    )
    tagged = df.withColumn("reject_reason", reason)
    return tagged.where("reject_reason = ''").drop("reject_reason"), tagged.where("reject_reason <> ''")


# The shipped views, their keys, freshness limits and feature types.
USER = Entity("user", ("user_id",), ValueType.STRING, "a platform user")
PRODUCT = Entity("product", ("product_id",), ValueType.STRING, "a catalogue product")

USER_RECENCY = FeatureView(
    name="user_recency",
    entities=(USER,),
    ttl_seconds=3600,
    features=(
        Feature("events_last_5min", ValueType.INT32),
        Feature("events_last_1h", ValueType.INT32),
        Feature("distinct_products_last_1h", ValueType.INT32),
        Feature("avg_order_value_last_1h", ValueType.FLOAT),
        Feature("seconds_since_last_event", ValueType.INT32),
    ),
)
USER_LIFETIME = FeatureView(
    name="user_lifetime",
    entities=(USER,),
    ttl_seconds=30 * 86400,
    features=(
        Feature("account_age_days", ValueType.INT32),
        Feature("total_orders", ValueType.INT32),
        Feature("total_spend", ValueType.FLOAT),
        Feature("avg_order_value", ValueType.FLOAT),
        Feature("distinct_products_purchased", ValueType.INT32),
        Feature("churn_risk_score", ValueType.FLOAT),
    ),
)
PRODUCT_FEATURES = FeatureView(
    name="product_features",
    entities=(PRODUCT,),
    ttl_seconds=7 * 86400,
    features=(
        Feature("total_purchases_7d", ValueType.INT32),
        Feature("total_purchases_30d", ValueType.INT32),
        Feature("unique_buyers_30d", ValueType.INT32),
        Feature("avg_rating", ValueType.FLOAT),
        Feature("price_usd", ValueType.FLOAT),
        Feature("embedding", ValueType.FLOAT_LIST, dim=64),
    ),
)
SHIPPED_VIEWS = (USER_RECENCY, USER_LIFETIME, PRODUCT_FEATURES)
