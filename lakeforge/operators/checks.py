"""History and star-schema checks (Q1–Q6, S12).  Each takes the history
frame and its key columns.  Questions about a key are answered on the keys
alone, by a grouped count with partial counts per task, and the full rows are
then picked by a join; rows with a NULL key form no version group and stay out
of both."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import VALID_FROM, VALID_TO
from ..functions.predicates import any_null


def _keyed(history: DataFrame, keys: list[str]) -> DataFrame:
    return history.filter(~any_null(keys))


def versions_of_changed_keys(history: DataFrame, keys: list[str]) -> DataFrame:
    """Q1: every version of keys that have more than one version."""
    several = (_keyed(history, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_lf_n"))
               .filter("_lf_n > 1").select(*keys))
    return _keyed(history, keys).join(several, keys, "left_semi")


def closed_deleted(history: DataFrame, keys: list[str]) -> DataFrame:
    """Q2: closed versions of keys that have no current version; a NULL key
    never has one."""
    closed = history.filter(F.col(VALID_TO).isNotNull())
    gone = (_keyed(history, keys).groupBy(*keys).agg(F.count(F.when(F.col(VALID_TO).isNull(), 1)).alias("_lf_n"))
            .filter("_lf_n = 0").select(*keys))
    return _keyed(closed, keys).join(gone, keys, "left_semi").unionByName(closed.filter(any_null(keys)))


def rekeyed(history: DataFrame, keys: list[str], identity: str = "rowguid") -> DataFrame:
    """Q3: an identity (rowguid) closed under one key and opened under another
    key at the same load time: old key, new key and the switch time.  Only
    versions that opened when another one closed take part."""
    old = closed_deleted(history, keys).select(
        *[F.col(k).alias(f"old_{k}") for k in keys], F.col(identity).alias("_lf_ident"),
        F.col(VALID_TO).alias("switched_at"))
    times = history.select(F.col(VALID_TO).alias("_lf_closing")).na.drop().distinct()  # a row per load
    opened = history.join(F.broadcast(times), F.col(VALID_FROM) == F.col("_lf_closing"), "left_semi")
    new = opened.select(*[F.col(k).alias(f"new_{k}") for k in keys],
                         F.col(identity).alias("_lf_ident"), F.col(VALID_FROM).alias("switched_at"))
    return old.join(new, ["_lf_ident", "switched_at"]).drop("_lf_ident")


def version_stats(history: DataFrame, keys: list[str], top: int = 20) -> DataFrame:
    """Q4: versions per key (count, first version, current version, last
    closing) for keys with more than one version; the ``top`` keys with the
    most versions."""
    stats = (history.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("nb_versions"),
        F.min(VALID_FROM).alias("first_version"),
        F.max(F.when(F.col(VALID_TO).isNull(), F.col(VALID_FROM))).alias("current_version"),
        F.max(VALID_TO).alias("last_closing"))
        .filter(F.col("nb_versions") > 1))
    return stats.orderBy(F.col("nb_versions").desc(), *keys).limit(top)


def duplicate_current(history: DataFrame, keys: list[str]) -> DataFrame:
    """Q5: keys with more than one current version (expect no rows)."""
    return (history.filter(F.col(VALID_TO).isNull()).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("nb_current_versions"))
            .filter(F.col("nb_current_versions") > 1))


def overlapping_intervals(history: DataFrame, keys: list[str]) -> DataFrame:
    """Invariant: versions of one key never overlap (next start >= end)."""
    w = Window.partitionBy(*keys).orderBy(VALID_FROM)
    nxt = F.lead(VALID_FROM).over(w)
    return (_keyed(history, keys).withColumn("_lf_next", nxt)
            .filter(F.col("_lf_next").isNotNull() &
                    (F.col(VALID_TO).isNull() | (F.col("_lf_next") < F.col(VALID_TO))))
            .drop("_lf_next"))
