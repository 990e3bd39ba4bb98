"""From a cut's file to a published commit."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.model import FAILED, REFUSED, SUCCESS, Cut
from tidemark.operators import history, merge, normalize
from tidemark.operators.keys import tasks_for
from tidemark.plans import reports
from tidemark.sources import cuts as source
from tidemark.sources.store import USABLE, Head, Store


class DeleteRatioError(RuntimeError):
    """A cut would delete more of the live state than allowed."""


@dataclass(frozen=True)
class Landed:
    """What one pass over landed rows found out."""

    source_rows: int
    rows_valid: int
    checksum: str

    @property
    def fingerprint(self) -> str:
        return f"{self.source_rows}:{self.checksum}"

    @property
    def rows_quarantined(self) -> int:
        return self.source_rows - self.rows_valid


def land(spark: SparkSession, store: Store, cut: Cut) -> Landed:
    """Writes a cut to raw, replacing an earlier landing of it."""
    scanned = source.scan_cut(spark, cut.path, store.spec)
    return land_rows(store, source.with_lineage(scanned, cut))


def land_rows(store: Store, rows: DataFrame) -> Landed:
    """Writes rows with their lineage to raw, replacing the slices they belong to.

    The same pass marks usable rows, counts them and checksums the content, so none of
    these costs a scan of its own. The observed rows are in the writing stage; a lost
    executor cannot count them twice. Later steps filter on the stored mark instead of
    judging every row again.
    """
    spec, seen = store.spec, Observation()
    # raw and normalised names overlap, so the raw row is set aside in a struct
    clean = rows.select(F.struct(*rows.columns).alias("raw"), *normalize.key_columns(spec))
    clean = clean.withColumn(USABLE, normalize.usable(spec))
    observed = clean.observe(seen, F.count_if(USABLE).alias("rows_valid"),
                             *source.fingerprint_columns(spec, "raw."))
    store.write_raw(observed.select("raw.*", USABLE))
    got = seen.get
    return Landed(got["source_rows"], got["rows_valid"], got["checksum"])


@dataclass(frozen=True)
class Run:
    """One attempt to process something, and the stream and batch that asked for it."""

    run_id: str
    started: datetime
    stream: str | None = None
    batch: int | None = None


@contextmanager
def recorded(store: Store, cut: Cut, stream: str | None = None,
             batch: int | None = None) -> Iterator[Run]:
    """A run that leaves a record in ``store.failures()`` when it is refused or fails."""
    run = Run(uuid.uuid4().hex[:12], _now(), stream, batch)
    try:
        yield run
    except Exception as error:
        refused = isinstance(error, source.OutOfOrderError)
        store.write_failure({
            "run_id": run.run_id, "cut_label": cut.label, "cut_date": cut.cut_date,
            "source_file": cut.path.rsplit("/", 1)[-1],
            "status": REFUSED if refused else FAILED,
            "error": f"{type(error).__name__}: {error}".splitlines()[0],
            "started_at": run.started, "finished_at": _now(),
            "stream": stream, "batch": batch})
        raise


def process_cut(spark: SparkSession, store: Store, cut: Cut, *,
                max_delete_ratio: float | None = None, reset: bool = False,
                stream: str | None = None, batch: int | None = None) -> dict | None:
    """Processes one cut and publishes it; returns its run record.

    Returns None when the same content was already processed for that date, whichever cuts
    came after it. Any other cut older than the newest one is refused. A new content for the
    newest date replaces it. With ``max_delete_ratio`` a cut that deletes a larger share of
    the live rows is refused. A run that is refused or fails leaves a record in
    ``store.failures()``. ``stream`` and ``batch`` are kept in the record.
    """
    with recorded(store, cut, stream, batch) as run:
        return _process(spark, store, cut, run, max_delete_ratio, reset)


def _process(spark: SparkSession, store: Store, cut: Cut, run: Run,
             max_delete_ratio: float | None, reset: bool) -> dict | None:
    spec = store.spec
    head = store.head()
    base, done = (Head(), None) if reset else (head, store.ledger(head))
    if done is not None and base.commit:
        wanted = source.manifest(spark, [cut])
        same_date = (done.filter(F.col("cut_date") == F.lit(cut.cut_date))
                     .select("commit").collect())
        if same_date:  # what was processed is skipped before anything is refused
            found = source.fingerprint(source.scan_cut(spark, cut.path, spec), spec).first()
            wanted = wanted.withColumn("fingerprint", F.lit(found["fingerprint"]))
            if source.pending_cuts(wanted, done).isEmpty():
                return None
        source.check_order(wanted, done)
        if same_date:
            base = _before(store, done, min(r["commit"] for r in same_date), cut)

    landed = land(spark, store, cut)
    commit = head.commit + 1
    _write_quarantine(store, store.landed(cut), landed.rows_quarantined, commit)
    valid = normalize.normalize(store.landed(cut).filter(USABLE), spec)
    counted = Observation()
    tasks = tasks_for(spark, landed.rows_valid + store.open_at_most(base))
    classified = merge.compare(store.open_versions(base), valid, spec, tasks)
    classified = classified.observe(counted, *merge.action_counts())
    store.write_versions(merge.versions(classified, spec, cut), commit)
    counts = counted.get
    _check_deletes(counts, max_delete_ratio)

    events = (merge.events(store.opened_by(commit, cut))
              .withColumn("run_id", F.lit(run.run_id)).withColumn("ts", F.current_timestamp()))
    store.write_change_log(events, commit)
    record = _record(cut, commit, (*base.lineage, commit), run, landed, counts)
    store.publish([record])
    return record


def _write_quarantine(store: Store, landed: DataFrame, rows: int, commit: int) -> None:
    store.drop_quarantine(commit)
    if rows:
        bad = normalize.normalize(landed.filter(~F.col(USABLE)), store.spec)
        store.write_quarantine(normalize.with_reasons(bad, store.spec), commit)


def _before(store: Store, done, commit: int, cut: Cut) -> Head:
    """The state before a date that is being replaced."""
    row = done.filter(F.col("commit") == commit).select("lineage").first()
    earlier = tuple(c for c in row["lineage"] if c != commit)
    several = done.filter((F.col("commit") == commit)
                          & (F.col("cut_date") != F.lit(cut.cut_date))).limit(1).count()
    if several:
        raise source.OutOfOrderError(
            f"{cut.cut_date} was published together with other cuts; rebuild to replace it")
    return Head(earlier[-1], earlier) if earlier else Head()


def _check_deletes(counts: dict, limit: float | None) -> None:
    before = counts["rows_deleted"] + counts["rows_changed"] + counts["rows_unchanged"]
    if limit is not None and before and counts["rows_deleted"] > limit * before:
        raise DeleteRatioError(
            f"the cut deletes {counts['rows_deleted']} of {before} live rows; "
            "nothing was published")


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _record(cut: Cut, commit: int, lineage: Sequence[int], run: Run, landed: Landed,
            counts: dict) -> dict:
    return {
        "commit": commit, "lineage": list(lineage), "run_id": run.run_id,
        "cut_label": cut.label, "cut_date": cut.cut_date,
        "source_file": cut.path.rsplit("/", 1)[-1],
        "fingerprint": landed.fingerprint, "source_rows": landed.source_rows,
        "rows_valid": landed.rows_valid, "rows_quarantined": landed.rows_quarantined,
        **{k: counts[k] for k in
           ("rows_new", "rows_changed", "rows_deleted", "rows_unchanged")},
        "status": SUCCESS, "started_at": run.started, "finished_at": _now(),
        "stream": run.stream, "batch": run.batch,
    }


def rebuild(spark: SparkSession, store: Store, cuts: Sequence[Cut]) -> list[dict]:
    """Lands all cuts and publishes their whole history as one commit, from zero.

    The history comes from one pass over the landed rows instead of one merge per cut.
    """
    return _in_one_pass(spark, store, cuts, Head())


def extend(spark: SparkSession, store: Store, cuts: Sequence[Cut]) -> list[dict]:
    """Lands further cuts and publishes them as one commit: one pass over their rows and the
    open versions, however many cuts there are. All must be newer than what is published."""
    head = store.head()
    ledger = store.ledger(head)
    known = source.manifest(spark, cuts).join(
        ledger.select("cut_date"), "cut_date", "left_semi").first()
    if known:
        raise source.OutOfOrderError(f"{known['cut_date']} was already processed")
    source.check_order(source.manifest(spark, cuts), ledger)
    return _in_one_pass(spark, store, cuts, head)


def _in_one_pass(spark: SparkSession, store: Store, cuts: Sequence[Cut], base: Head) -> list[dict]:
    ordered = sorted(cuts, key=lambda c: c.cut_date)
    with recorded(store, ordered[-1]) as run:
        spec, commit = store.spec, store.head().commit + 1
        landings = [land(spark, store, c) for c in ordered]
        wanted = F.struct("_cut_date", "_cut_label").isin(
            *[F.struct(F.lit(c.cut_date), F.lit(c.label)) for c in ordered])
        rows = store.landed().filter(wanted)
        _write_quarantine(store, rows, sum(x.rows_quarantined for x in landings), commit)
        valid = normalize.normalize(rows.filter(USABLE), spec)
        before = store.open_versions(base) if base.commit else None
        tasks = tasks_for(spark, sum(x.rows_valid for x in landings) + store.open_at_most(base))
        versions = history.bulk_history(valid, spec, ordered, tasks, before)
        store.write_versions(versions.withColumn("part", merge.part_of()), commit)

        opened = store.opened_by(commit).filter(F.col("valid_from") >= F.lit(ordered[0].cut_date))
        events = (merge.events(opened).withColumn("run_id", F.lit(run.run_id))
                  .withColumn("ts", F.current_timestamp()))
        store.write_change_log(events, commit)
        log = {(r["cut_label"], r["cut_date"]): r
               for r in reports.event_counts(opened).collect()}  # one row per cut
        records, live = [], store.live(base).count() if base.commit else 0
        for cut, x in zip(ordered, landings):
            found = log.get((cut.label, cut.cut_date))
            n, u, d = ((found["rows_new"], found["rows_changed"], found["rows_deleted"])
                       if found else (0, 0, 0))
            counts = {"rows_new": n, "rows_changed": u, "rows_deleted": d,
                      "rows_unchanged": live - u - d}
            live += n - d
            records.append(_record(cut, commit, (*base.lineage, commit), run, x, counts))
        store.publish(records)
        return records


def run_cuts(spark: SparkSession, store: Store, cuts: Sequence[Cut], *,
             reset: bool = False, in_one_pass: bool = False,
             check: Callable[[Store], None] | None = None, **options) -> list[dict | None]:
    """Processes cuts in date order, builds the marts and runs the quality gate.

    ``reset`` starts from zero; with ``in_one_pass`` it does so as one bulk build. Cuts that
    were processed before are skipped, so running the same cuts again changes nothing. A
    gate that finds something leaves a record in ``store.failures()``.
    """
    if in_one_pass:
        done: list[dict | None] = list(rebuild(spark, store, cuts, **options))
    else:
        done = []
        for n, cut in enumerate(sorted(cuts, key=lambda c: c.cut_date)):
            done.append(process_cut(spark, store, cut, reset=reset and n == 0, **options))
    with recorded(store, max(cuts, key=lambda c: c.cut_date)):
        (check or reports.build_and_check)(store)
    return done
