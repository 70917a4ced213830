"""Incremental crawling: states of sources, what to fetch again, and the rotation of venues."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X

INCOMPLETE = ("failed", "empty", "stale")
HISTORY = 90
REFRESH_DAYS = 7


def record_key(source: Column, venue: Column, year: Column) -> Column:
    return F.concat_ws(":", source, F.upper(venue.cast("string")), year.cast("string"))


def parse_time(c: Column | str) -> Column:
    """A timestamp of ISO text; without a zone it is UTC, and what is none is null."""
    t = X.text(c)
    zoned = t.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$")
    return F.try_to_timestamp(F.when(zoned, t).when(t != "", F.concat(t, F.when(t.rlike(r"\d:\d"), F.lit("Z")).otherwise(F.lit("T00:00:00Z")))))


def iso(c: Column) -> Column:
    """UTC ISO text to the second, as 2024-01-02T03:04:05Z; the session's time zone must be UTC."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def age_days(since: Column, now: Column) -> Column:
    return (F.unix_micros(now.cast("timestamp")) - F.unix_micros(since.cast("timestamp"))) / F.lit(86_400e6)


def latest(states: DataFrame, keys: list[str], at: str, tie: str | None = None) -> DataFrame:
    """The last state of each key by time; of equal times the one with the largest tie-breaker."""
    rest = [c for c in states.columns if c not in keys]
    value = F.struct(F.col(at).alias("t"), *([F.col(tie).alias("x")] if tie else []))
    best = states.groupBy(*keys).agg(F.max_by(F.struct(*rest), value).alias("__s"))
    return best.select(*[F.col(c) if c in keys else F.col("__s")[c].alias(c) for c in states.columns])


def decide_fetch(wanted: DataFrame, states: DataFrame, files: DataFrame, now: Column, refresh_days: float = REFRESH_DAYS, bootstrap: bool = True) -> DataFrame:
    """wanted (record_key, year, path) with skip, reason and bootstrapped.

    states has (record_key, status, sha256, last_success_at), files (path, sha256, modified). In order: no state and no file (or
    no bootstrap), an incomplete state, a missing or changed file, and, in a year that is not over, a success of
    unknown time or one that is refresh_days old or older (negative: never) call for a fetch."""
    s = states.select("record_key", "status", F.col("sha256").alias("__sha"), "last_success_at", F.lit(True).alias("__state"))
    f = files.select("path", F.col("sha256").alias("__file"), "modified")
    rows = wanted.join(s, "record_key", "left").join(f, "path", "left")
    boot = F.col("__state").isNull() & F.col("__file").isNotNull() & F.lit(bootstrap)
    status, sha = F.when(boot, "complete").otherwise(F.col("status")), F.when(boot, F.col("__file")).otherwise(F.col("__sha"))
    success = F.when(boot, F.col("modified")).otherwise(parse_time("last_success_at"))
    active = F.coalesce(F.expr("try_cast(year AS int)") >= F.year(now), F.lit(False))
    reason = (
        F.when(F.col("__state").isNull() & ~boot, "missing_state")
        .when(status.isin(*INCOMPLETE), status)
        .when((status != "complete") | F.col("__file").isNull() | ~sha.eqNullSafe(F.col("__file")), "missing_or_changed_file")
        .when(active & success.isNull(), "active_year_missing_success_time")
        .when(active & F.lit(refresh_days >= 0) & (age_days(success, now) >= refresh_days), "active_year_refresh_due")
        .otherwise("complete")
    )
    return rows.select(*wanted.columns, (reason == "complete").alias("skip"), reason.alias("reason"), boot.alias("bootstrapped"))


def outcomes(results: DataFrame, now: Column) -> DataFrame:
    """States of fetches (record_key, path, rows, sha256, error): complete with rows, empty without, failed
    with an error; a failure keeps what is known of the file and has no time of success."""
    failed = X.text("error") != ""
    status = F.when(failed, "failed").when(F.col("rows") > 0, "complete").otherwise("empty")
    return results.select("record_key", status.alias("status"), iso(now).alias("last_attempt_at"), F.when(status == "complete", iso(now)).otherwise("").alias("last_success_at"), F.col("path").alias("rawdata_path"), X.text("sha256").alias("sha256"), F.coalesce("rows", F.lit(0)).alias("record_count"), X.text("error").alias("error"))


def stale(results: DataFrame, now: Column) -> DataFrame:
    """States (record_key, path, rows, sha256) of sources whose year is not over and whose refresh is due: what is known
    of the file stays, there is no time of success."""
    out = outcomes(results.withColumn("error", F.lit("active-year refresh due")), now)
    return out.withColumn("status", F.lit("stale"))


LADDER = ("skipped", "fetched", "existing_kept", "fallback_used", "failed")


def fetch_ladder(wanted: DataFrame, first: DataFrame, second: DataFrame, keep_existing: bool = True) -> DataFrame:
    """(record_key, outcome, used, rows, error) for wanted sources (record_key, skip, has_file, has_second), given the answers of
    the first and the second place to ask (record_key, rows, error; no rows is a failure too).

    In order: a source that needs no fetch is skipped; the first place's rows are used; if it failed, a file that is
    there is kept (with keep_existing, as for conferences); else the second place's rows are used, if there is
    one; else the fetch failed, with the errors of both."""
    place = lambda df, n: df.select("record_key", F.col("rows").alias(f"__r{n}"), X.text("error").alias(f"__e{n}"))
    out = wanted.join(place(first, 1), "record_key", "left").join(place(second, 2), "record_key", "left")
    good = lambda n: F.coalesce(F.col(f"__r{n}") > 0, F.lit(False)) & (F.coalesce(f"__e{n}", F.lit("")) == "")
    why = lambda n: F.when(F.coalesce(f"__e{n}", F.lit("")) == "", "empty").otherwise(F.col(f"__e{n}"))
    both = F.coalesce("has_second", F.lit(False))
    outcome = (
        F.when(F.col("skip"), LADDER[0]).when(good(1), LADDER[1]).when(F.coalesce("has_file", F.lit(False)) & F.lit(keep_existing), LADDER[2])
        .when(both & good(2), LADDER[3]).otherwise(LADDER[4])
    )
    out = out.withColumn("outcome", outcome)
    is_ = lambda k: F.col("outcome") == LADDER[k]
    error = F.when(is_(0) | is_(1), "").when(is_(4) & both, F.concat(F.lit("first: "), why(1), F.lit("; second: "), why(2))).otherwise(why(1))
    return out.select("record_key", "outcome", F.when(is_(1), "first").when(is_(3), "second").otherwise("").alias("used"), F.when(is_(1), F.col("__r1")).when(is_(3), F.col("__r2")).otherwise(0).cast("long").alias("rows"), error.alias("error"))


@dataclass
class Rotation:
    """Where a round-robin over a manifest of venues stands; a handful of names, so plain Python."""

    cursor: int = 0
    retry: list[str] = field(default_factory=list)
    history: list[dict] = field(default_factory=list)

    def known_retries(self, manifest: list[str]) -> list[str]:
        """The retry queue in the manifest's spelling, each once; unknown names go."""
        names = {v.upper(): v for v in manifest}
        return list(dict.fromkeys(names[r.upper()] for r in self.retry if r.upper() in names))

    def select(self, manifest: list[str], batch: int) -> dict:
        """One retry first, then the next venues that wait for no retry, then more retries."""
        retry, n = self.known_retries(manifest), len(manifest)
        start = self.cursor % max(1, n)
        head = retry[:1] if batch > 0 else []
        room, fresh, steps = batch - len(head), [], 0
        while len(fresh) < room and steps < n:
            venue = manifest[(start + steps) % n]
            steps += 1
            if venue not in retry and venue not in fresh:
                fresh.append(venue)
        tail = retry[1 : 1 + max(0, room - len(fresh))]
        return {"selected": head + fresh + tail, "retry_selected": head + tail, "new_selected": fresh, "cursor_before": start, "cursor_after": (start + steps) % n if n else 0}

    def finalize(self, plan: dict, failed: set[str], manifest: list[str], at: str) -> Rotation:
        """The rotation after a batch: what succeeded leaves the queue, what failed joins its end."""
        done = [v for v in plan["selected"] if v not in failed]
        queue = [v for v in self.known_retries(manifest) if v not in done]
        queue += [v for v in plan["selected"] if v in failed and v not in queue]
        entry = {"finalized_at": at, "venues": plan["selected"], "succeeded": done, "failed": sorted(failed), "cursor": plan["cursor_after"]}
        return Rotation(plan["cursor_after"], queue, [*self.history, entry][-HISTORY:])


def round_robin(manifest: DataFrame, cursor: int, batch: int, waiting: DataFrame | None = None) -> DataFrame:
    """(name, ord, turn): the next `batch` names of manifest (name, ord from 0) from the cursor on, without those that wait."""
    rows = manifest if waiting is None else manifest.join(waiting.select("name").distinct(), "name", "left_anti")
    n = manifest.count()
    turn = F.pmod(F.col("ord") - F.lit(cursor), F.lit(max(1, n)))
    w = Window.orderBy("turn")  # a manifest is a short list
    return rows.withColumn("turn", turn).withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= batch).drop("__r")


def keep_last(rows: DataFrame, keys: list[str], order: str, n: int = HISTORY) -> DataFrame:
    """The last n rows of each key (Spark prunes within each task before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def manifest(*grids: DataFrame) -> DataFrame:
    """(name, ord) of venues in the order of the grids (venue, at), each once, where it comes first."""
    rows = None
    for i, g in enumerate(grids):
        part = g.select(F.col("venue").alias("name"), F.struct(F.lit(i).alias("grid"), F.col("at").cast("long").alias("at")).alias("place"))
        rows = part if rows is None else rows.unionByName(part)
    first = rows.groupBy("name").agg(F.min("place").alias("place"))
    return first.select("name", (F.row_number().over(Window.orderBy("place")) - 1).alias("ord"))  # a manifest is a short list


def retryable(status: Column) -> Column:
    """Statuses after which a request is made again: too many requests and errors of the server."""
    return (status == 429) | ((status >= 500) & (status <= 599))


def with_retries(send: Callable[[], tuple[int, bytes]], attempts: int = 4, first: float = 1.0, cap: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """The body that send() answers (status, body) with, asked again after statuses of a busy server and after network
    errors, `attempts` times in all. Other statuses from 400 on, and the last failure, are errors."""
    for delay in [*retry_delays(attempts, first, cap), None]:
        try:
            status, body = send()
        except OSError:
            if delay is None:
                raise
        else:
            if status < 400:
                return body
            if delay is None or not (status == 429 or 500 <= status <= 599):
                raise ValueError(f"status {status}")
        sleep(delay)
    raise ValueError("no attempts")


def retry_delays(attempts: int = 4, first: float = 1.0, cap: float = 30.0) -> list[float]:
    """Seconds to wait after each failed attempt but the last: doubling up to the cap."""
    return [min(cap, first * 2**k) for k in range(attempts - 1)]
