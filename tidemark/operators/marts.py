"""Marts and summaries over the history, the change log and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import add_parts, exact_sum, sum_parts, total
from tidemark.model import DELETE, FLOW_BY_FUND, FLOW_BY_PRODUCT, INSERT, UPDATE, Mart


def live_state(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current") & ~F.col("is_deleted"))


def tombstones(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current") & F.col("is_deleted"))


def flow(live: DataFrame, mart: Mart) -> DataFrame:
    """A declared mart over the live rows."""
    return (live.groupBy(mart.by).agg(
        F.count(F.lit(1)).alias("n_movimientos"),
        *[exact_sum(F.expr(t.sql)).alias(t.name) for t in mart.totals])
        .orderBy(F.desc_nulls_last(mart.totals[0].name)))


def flow_by_product(live: DataFrame) -> DataFrame:
    """Net flow and raw totals. The net uses magnitudes signed by direction, the totals
    the amounts as sent, so they need not reconcile when amounts are negative."""
    return flow(live, FLOW_BY_PRODUCT)


def flow_by_fund(live: DataFrame) -> DataFrame:
    return flow(live, FLOW_BY_FUND)


def flow_by_type(live: DataFrame) -> DataFrame:
    return (live.groupBy("type").agg(
        F.count(F.lit(1)).alias("n_movimientos"),
        exact_sum(F.col("amount")).alias("total_monto"))
        .orderBy(F.desc("n_movimientos")))


def cdc_summary(log: DataFrame) -> DataFrame:
    """New, corrected and deleted per cut. A cut without events has no row."""
    def n(change: str) -> Column:
        return F.count_if(F.col("change_type") == change)

    return (log.groupBy("cut_label", "cut_date").agg(
        n(INSERT).alias("nuevos"), n(UPDATE).alias("corregidos"),
        n(DELETE).alias("eliminados"))
        .orderBy("cut_date")
        .withColumn("cut_date", F.col("cut_date").cast("string")))


def change_counts(log: DataFrame) -> DataFrame:
    return (log.groupBy("cut_label", "change_type")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("cut_label", "change_type"))


def state_summary(history: DataFrame) -> DataFrame:
    """Live rows, standing tombstones, versions and active clients in one pass."""
    live = F.col("is_current") & ~F.col("is_deleted")
    return history.agg(
        F.count_if(live).alias("movimientos_vigentes"),
        F.count_if(F.col("is_current") & F.col("is_deleted")).alias("eliminados_vigentes"),
        F.count(F.lit(1)).alias("versiones_totales"),
        F.count_distinct(F.when(live, F.col("id_cliente"))).alias("clientes_activos"))


def quality_profile(live: DataFrame) -> DataFrame:
    """Row count and flagged rows. A NULL flag counts as neither; no flag at all is NULL."""
    names = {"amount_nulos": "dq_amount_null", "amount_ceros": "dq_amount_zero",
             "amount_negativos": "dq_amount_negative",
             "fecha_reformateada": "dq_date_reformatted",
             "type_recodificado": "dq_type_recoded"}
    return live.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.sum(F.col(flag).cast("bigint")).alias(n) for n, flag in names.items()])


def quarantine_total(quarantined: DataFrame) -> DataFrame:
    return quarantined.agg(F.count(F.lit(1)).alias("cuarentena_total"))


def top_clients(live: DataFrame, n: int = 10) -> DataFrame:
    """The clients moving most, by unsigned amount; ties go to the smaller id."""
    return (live.groupBy("id_cliente").agg(
        F.count(F.lit(1)).alias("n_movimientos"),
        exact_sum(F.abs("amount")).alias("volumen"))
        .orderBy(F.desc_nulls_last("volumen"), "id_cliente").limit(n))


def run_summary(history: DataFrame, quarantined: DataFrame) -> DataFrame:
    """One row: state and quarantine."""
    return state_summary(history).select(
        "*", quarantine_total(quarantined).scalar().alias("cuarentena_total"))


# -- incremental marts ---------------------------------------------------------------
# The state of a mart holds the parts of its sums, so that rows can be added and taken away.


def flow_state(versions: DataFrame, mart: Mart, sign: Column | None = None) -> DataFrame:
    """Partial mart; ``sign`` is +1 for rows entering the live state, -1 for rows leaving
    it."""
    count = F.count(F.lit(1)) if sign is None else F.sum(sign).cast("bigint")
    return versions.groupBy(mart.by).agg(
        count.alias("n_movimientos"),
        *[sum_parts(F.expr(t.sql), sign).alias(t.name) for t in mart.totals])


def merge_delta(merged: DataFrame) -> DataFrame:
    """The rows of a merged cut that enter or leave the live state, with their sign.

    Opened non-deleted versions enter; closed versions leave, unless they were already
    tombstones. Untouched rows are not looked at.
    """
    enters = F.col("opened") & ~F.col("is_deleted")
    leaves = ~F.col("opened") & ~F.col("is_current") & ~F.col("is_deleted")
    return (merged.filter(enters | leaves)
            .withColumn("_sign", F.when(F.col("opened"), 1).otherwise(-1)))


def add_flow(state: DataFrame, delta: DataFrame, mart: Mart) -> DataFrame:
    """Partial mart after a cut = the one before + its delta; both are one row per value."""
    return (state.unionByName(delta).groupBy(mart.by)
            .agg(F.sum("n_movimientos").alias("n_movimientos"),
                 *[add_parts(t.name).alias(t.name) for t in mart.totals])
            .filter("n_movimientos > 0"))


# -- state summary kept up to date ---------------------------------------------------
# Counts of versions, live rows and tombstones, and the live rows of every client with the
# parts of their sums (a mart's state). Both can be taken back, so neither the distinct
# count of clients nor the list of the largest needs the live rows again.


def counters(history: DataFrame) -> DataFrame:
    """One row: live rows, standing tombstones, all versions."""
    return history.agg(
        F.count_if(F.col("is_current") & ~F.col("is_deleted")).alias("movimientos_vigentes"),
        F.count_if(F.col("is_current") & F.col("is_deleted")).alias("eliminados_vigentes"),
        F.count(F.lit(1)).alias("versiones_totales"))


def counter_changes(changed: DataFrame) -> DataFrame:
    """One row: by how much versions that a commit opened (``_sign`` 1) or closed (-1) move the
    counters. A version opened and closed since counts as a version only."""
    buried = F.col("is_deleted")

    def net(hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(hit, F.col("_sign"))), F.lit(0)).cast("bigint")

    return changed.agg(net(~buried).alias("movimientos_vigentes"),
                       net(buried).alias("eliminados_vigentes"),
                       F.count_if(F.col("_sign") > 0).alias("versiones_totales"))


def add_counters(state: DataFrame, delta: DataFrame) -> DataFrame:
    names = delta.columns
    return state.unionByName(delta).agg(*[F.sum(c).alias(c) for c in names])


def summary_of(counted: DataFrame, clients: DataFrame, by: str) -> DataFrame:
    """The state summary from the counters and the clients' state."""
    return counted.select("*", clients.agg(F.count(by)).scalar().alias("clientes_activos"))


def top_of(clients: DataFrame, mart: Mart, n: int = 10) -> DataFrame:
    """The clients with the largest total, from their state; ties go to the smaller id."""
    name = mart.totals[0].name
    return (clients.select(mart.by, "n_movimientos", total(F.col(name)).alias(name))
            .orderBy(F.desc_nulls_last(name), mart.by).limit(n))


def finish_flow(state: DataFrame, mart: Mart) -> DataFrame:
    return (state.select(mart.by, "n_movimientos",
                         *[total(F.col(t.name)).alias(t.name) for t in mart.totals])
            .orderBy(F.desc_nulls_last(mart.totals[0].name)))
