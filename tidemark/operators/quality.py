"""Row expectations and alert routing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``predicate`` must hold; failing rows are dropped, or only counted when ``drop`` is False."""

    name: str
    predicate: Column
    drop: bool = False

    def holds(self) -> Column:
        """Unknown counts as failed."""
        return F.coalesce(self.predicate, F.lit(False))


# Event types accepted by the event rules.
VALID_EVENT_TYPES = ("view", "click", "purchase", "cart_add")


def event_rules(
    user: str = "user_id",
    event_type: str = "event_type",
    amount: str = "amount",
    valid_types: tuple[str, ...] = VALID_EVENT_TYPES,
) -> list[Rule]:
    """The event table's rules on flattened columns.

    A malformed payload decodes to nulls in every field, so "event is not null" is tested on the
    required event type.
    """
    kind = F.col(event_type)
    return [
        Rule("event_not_null", kind.isNotNull(), drop=True),
        Rule("user_id_not_null", F.col(user).isNotNull(), drop=True),
        Rule("valid_event_type", kind.isin(*valid_types)),
        Rule("amount_positive_for_purchase", (kind != "purchase") | (F.col(amount) > 0)),
    ]


def apply_expectations(
    df: DataFrame, rules: list[Rule], observation: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined).  The second holds the dropped rows and ``failed_rules``.

    With an ``observation`` the failures per rule are counted while ``kept`` is computed.
    """
    if observation is not None and not df.isStreaming:
        df = df.observe(
            observation, F.count(F.lit(1)).alias("rows"), *[F.count_if(~r.holds()).alias(r.name) for r in rules]
        )
    drops = [r for r in rules if r.drop]
    keep: Column = F.lit(True)
    for r in drops:
        keep = keep & r.holds()
    failed = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in drops]))
    return df.where(keep), df.where(~keep).withColumn("failed_rules", failed)


def expectation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rule, action, passed, failed`` in one pass over the data."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(~r.holds()).alias(f"f{i}") for i, r in enumerate(rules)]
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit("drop" if r.drop else "warn").alias("action"),
                (F.col("rows") - F.col(f"f{i}")).alias("passed"),
                F.col(f"f{i}").alias("failed"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counted.select(F.explode(cells).alias("c")).select("c.*")


def _alerts(drift: DataFrame, thresholds: DataFrame, group: str, score: str) -> DataFrame:
    severity = F.when(F.col(score) >= F.col("psi_critical"), "critical").when(
        F.col(score) >= F.col("psi_warning"), "warning"
    )
    return drift.join(thresholds, group).withColumn("severity", severity).where("severity IS NOT NULL")


def topic_messages(
    drift: DataFrame,
    thresholds: DataFrame,
    group: str = "endpoint_name",
    feature: str = "feature_name",
    score: str = "psi",
    listed: int = 20,
) -> DataFrame:
    """``endpoint_name, subject, violation_count, violations``: one message for the topic of each endpoint with a critical alert.

    All alerts of the endpoint are counted; the ``listed`` worst are part of the message, worst first, so a message is bounded however
    many features drift.  The subject has at most 99 characters.
    """
    alerts = _alerts(drift, thresholds, group, score)
    totals = alerts.groupBy(group).agg(
        F.count(F.lit(1)).alias("violation_count"), F.bool_or(F.col("severity") == "critical").alias("__loud")
    )
    order = Window.partitionBy(group).orderBy(F.desc(score), F.col(feature))
    top = alerts.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= listed)
    entry = F.struct("__rank", F.col(feature).alias("feature"), F.col(score).alias("score"), "severity")
    lists = top.groupBy(group).agg(F.array_sort(F.collect_list(entry)).alias("__list"))
    subject = F.substring(F.format_string("[Drift] %s: %d violation(s)", F.col(group), "violation_count"), 1, 99)
    violations = F.transform("__list", lambda x: F.struct(x["feature"].alias("feature"), x["score"].alias("score"), x["severity"].alias("severity")))
    return totals.where("__loud").join(lists, group).select(
        group, subject.alias("subject"), "violation_count", violations.alias("violations")
    )


def alert_severity(
    drift: DataFrame,
    thresholds: DataFrame,
    group: str = "endpoint_name",
    feature: str = "feature_name",
    score: str = "psi",
    shown: int = 10,
) -> DataFrame:
    """Alerts per endpoint: severity, rank, and how many more than ``shown`` there are.

    ``thresholds`` has ``endpoint_name, psi_warning, psi_critical``.  The rank filter is pushed
    below the shuffle (WindowGroupLimit), the remainder comes from a separate count.
    """
    alerts = _alerts(drift, thresholds, group, score)
    totals = alerts.groupBy(group).agg(F.count(F.lit(1)).alias("__total"))
    order = Window.partitionBy(group).orderBy(F.desc(score), F.col(feature))
    top = alerts.withColumn("alert_rank", F.row_number().over(order)).where(F.col("alert_rank") <= shown)
    channels = F.when(F.col("severity") == "critical", "topic,chat").otherwise("chat")
    return top.join(totals, group).select(
        group,
        feature,
        score,
        "severity",
        "alert_rank",
        F.greatest(F.col("__total") - shown, F.lit(0)).alias("n_more"),
        channels.alias("channels"),
    )
