"""Quality gate, insight bundle and their export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import DELETE, INSERT, MOVEMENTS, UPDATE, TableSpec
from tidemark.operators import marts, merge, quality
from tidemark.sources.store import Head, Store


def event_counts(opened: DataFrame) -> DataFrame:
    def n(change: str):
        return F.count_if(F.col("change_type") == change)

    return merge.events(opened).groupBy("cut_label", "cut_date").agg(
        n(INSERT).alias("rows_new"), n(UPDATE).alias("rows_changed"),
        n(DELETE).alias("rows_deleted"))


# The name of the live state's view.
LIVE_VIEW = "movimientos_vigentes"


def build_marts(store: Store, head: Head) -> dict[str, DataFrame]:
    """The live state as a temporary view, the declared marts as written tables.

    A mart is the last checked one of an earlier commit plus the rows that entered or left
    the live state since; without one it is summed from the live state.
    """
    live = store.live(head)
    live.createOrReplaceTempView(LIVE_VIEW)
    built, base = {"live": live}, store.checked_commit(head.lineage[:-1])
    changes = None if base is None else store.changes_since(base, head)
    actors = store.spec.actors
    if actors:
        counted = None if base is None else store.counters(base)
        store.write_counters(
            marts.counters(store.history(head)) if counted is None else marts.add_counters(
                counted, marts.counter_changes(store.versions_since(base, head))), head.commit)
    for mart in (*store.spec.marts, *((actors,) if actors else ())):
        before = None if base is None else store.mart_state(mart, base)
        if before is None:
            state = marts.flow_state(live, mart)
        else:
            delta = marts.flow_state(changes, mart, F.col("_sign"))
            state = marts.add_flow(before, delta, mart)
        store.write_mart(mart, state, head.commit)
        if mart is not actors:
            built[mart.name] = marts.finish_flow(store.mart_state(mart, head.commit), mart)
    return built


def build_and_check(store: Store) -> None:
    """Builds the marts, then runs the quality gate over them and the published tables.
    Readers see the new marts once the gate is passed."""
    head = store.head()
    tables = {"history": store.history(head), "change_log": store.change_log(head),
              **build_marts(store, head)}
    quality.gate(quality.run_suite(tables, quality.suite(store.spec)))
    store.mark_checked(head.commit)


def checked_tables(history: DataFrame, change_log: DataFrame,
                   spec: TableSpec = MOVEMENTS) -> dict[str, DataFrame]:
    """The tables of the suite, for a history that is not published."""
    live = marts.live_state(history)
    return {"history": history, "change_log": change_log, "live": live,
            **{m.name: marts.flow(live, m) for m in spec.marts}}


def insights(history: DataFrame, change_log: DataFrame, quarantined: DataFrame,
             live: DataFrame | None = None) -> dict[str, DataFrame]:
    """The report's results by name. Each is lazy and scans only the columns it needs."""
    live = marts.live_state(history) if live is None else live
    return {
        "cdc_por_corte": marts.cdc_summary(change_log),
        "estado_vigente": marts.state_summary(history),
        "flujo_por_producto": marts.flow_by_product(live),
        "por_tipo": marts.flow_by_type(live),
        "calidad_vigente": marts.quality_profile(live),
        "cuarentena_total": marts.quarantine_total(quarantined),
        "top_clientes": marts.top_clients(live),
    }


def store_insights(store: Store) -> dict[str, DataFrame]:
    head = store.head()
    return insights(store.history(head), store.change_log(head), store.quarantine(head),
                    store.live(head))


def export_insights(results: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One JSON folder per result. NULLs are written, text keeps its accents."""
    paths = {}
    for name, df in results.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        (df.write.mode("overwrite").option("ignoreNullFields", "false")
         .json(paths[name]))
    return paths
