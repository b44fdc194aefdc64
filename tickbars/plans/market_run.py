"""A whole run over a set of symbols: archive, clean, bars, gaps, ledger, report.

Large data is scanned once and lands in tables.  The counts of the report come
from those tables - Parquet footers and the small bar table - so they stay
right when lost executors make tasks run twice.  The report has a row for each
symbol.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions.timeframes import check_days, check_divides, check_timeframe_name, timeframe_seconds
from tickbars.operators.bars import resample
from tickbars.operators.cleaning import clean_ticks, drop_repeated_rows
from tickbars.operators.gaps import classify_gaps, detect_gaps
from tickbars.operators.indicators import compute_atr
from tickbars.operators.ledger import ledger_rows, rejected_candles, upsert_candles, valid_candle
from tickbars.session import stored
from tickbars.sources.bronze import archive_days, in_days, read_archive
from tickbars.streaming.live import live_ticks, trim_leading_partial

STAGES = ["source", "archive", "clean", "bars", "gaps", "ledger"]
HEADER = "timeframe STRING, mode STRING, start STRING, end STRING, dry_run BOOLEAN"
COUNTS = [
    "ticks_ingested", "ticks_clean", "archive_days", "archive_rows", "candles_produced", "candles_rejected",
    "gaps_found", "gaps_expected", "gaps_real", "ledger_rows",
]
STAGE_LOG = "elapsed_s DOUBLE, stages ARRAY<STRUCT<name: STRING, status: STRING, elapsed_s: DOUBLE, detail: STRING>>"


@dataclass
class RunLog:
    """Stages of one run and its counts by symbol, turned into a report at the end."""

    header: dict
    counts: list[DataFrame] = field(default_factory=list)
    stages: list[tuple] = field(default_factory=list)

    @property
    def failed(self) -> bool:
        return any(status == "fail" for _, status, _, _ in self.stages)

    def run(self, name: str, work) -> None:
        """Do one stage.  After a failure the rest are skipped, and the report still comes."""
        if self.failed:
            self.stages.append((name, "skipped", 0.0, ""))
            return
        began = time.perf_counter()
        try:
            status, detail = work()
        except Exception as error:  # noqa: BLE001 - any failure becomes a report row
            status, detail = "fail", f"{type(error).__name__}: {error}"
        self.stages.append((name, status, time.perf_counter() - began, detail))

    def count(self, rows: DataFrame, **counts: Column) -> dict[str, int]:
        """Keep *counts* of each symbol of *rows*; returns them for all symbols together."""
        table = stored(rows.groupBy("symbol").agg(*[c.alias(name) for name, c in counts.items()]), "run-counts")
        self.counts.append(table)
        row = table.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts]).first()
        return row.asDict()

    def frame(self, spark: SparkSession) -> DataFrame:
        """A row for each symbol; one without a symbol when the run ended before any was seen."""
        seconds = float(sum(s[2] for s in self.stages))
        run = spark.createDataFrame([(*self.header.values(), seconds, self.stages)], f"{HEADER}, {STAGE_LOG}")
        nothing = spark.createDataFrame([], "symbol STRING, " + ", ".join(f"{c} BIGINT" for c in COUNTS))
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), self.counts, nothing)
        by_symbol = stacked.groupBy("symbol").agg(*[F.sum(c).alias(c) for c in COUNTS])
        report = run.join(by_symbol, F.lit(True), "left").withColumns(  # one run
            {c: F.coalesce(c, F.lit(0).cast("long")) for c in COUNTS}
        )
        return report.select(
            "symbol", *self.header, *COUNTS,
            reconcile(F.col("ledger_rows"), F.col("candles_produced"), F.col("dry_run")).alias("reconcile"),
            result(F.col("stages")).alias("result"),
            "elapsed_s",
            "stages",
        )


def reconcile(written: Column, produced: Column, dry_run: Column) -> Column:
    """Rows written against candles produced.  For information: it never fails a run."""
    off = F.format_string("MISMATCH %d written, %d produced (%+d)", written, produced, written - produced)
    return F.when(dry_run, "").when(written == produced, "OK").otherwise(off)


def result(stages: Column) -> Column:
    return F.when(F.exists(stages, lambda s: s["status"] == "fail"), "FAIL").otherwise("PASS")


def _candle_stages(spark, log, work, timeframe, period, ledger_path, now_ms, dry_run, keep=lambda candles: candles,
                   rejected_path=None):
    """The stages every run shares.  They read ``work["ticks"]``; *keep* may drop candles.

    With *rejected_path* the candles the ledger does not take are written there, with the reason.
    """
    rows = F.count(F.lit(1))

    def clean():
        work["clean"] = clean_ticks(work["ticks"])
        return "ok", "runs with the bars"

    def bars():
        written = stored(resample(work["clean"], timeframe, counts=True), "run-bars")
        log.count(written, ticks_clean=F.sum("ticks"))
        span = written.agg(F.min("first_tick").alias("a"), F.max("last_tick").alias("b")).first()
        work["bars"] = keep(written.drop("ticks", "first_tick", "last_tick"))
        work["candles"] = stored(compute_atr(work["bars"], period), "run-candles")
        made = log.count(work["candles"], candles_produced=rows)["candles_produced"]
        return "ok", f"{made} {timeframe} candles from {span['a']} to {span['b']}"

    def gaps():
        labelled = classify_gaps(detect_gaps(work["candles"], timeframe, "bar_time"))
        found = log.count(
            labelled, gaps_found=rows, gaps_expected=F.count_if("expected"), gaps_real=F.count_if(~F.col("expected"))
        )
        return "ok", f"{found['gaps_found']} gaps"

    def ledger():
        # a candle that the ledger can't take holds back itself only
        log.count(work["candles"].where(~valid_candle()), candles_rejected=rows)
        if dry_run:
            return "skipped", "ledger not written (dry run)"
        if rejected_path:
            lost = rejected_candles(work["candles"]).withColumns({"timeframe": F.lit(timeframe), "rejected_at": F.lit(now_ms)})
            lost.write.mode("append").parquet(rejected_path)
        good = stored(ledger_rows(work["candles"].where(valid_candle()), timeframe), "run-ledger-rows")
        written = upsert_candles(spark, ledger_path, good, now_ms)
        log.count(good, ledger_rows=rows)
        return "ok", f"{written.inserted} inserted, {written.updated} updated"

    return [clean, bars, gaps, ledger]


def backfill(spark: SparkSession, ticks: DataFrame, start: str, end: str, *, archive_path: str, ledger_path: str,
             timeframe: str = "5min", period: int = 14, now_ms: int | None = None, dry_run: bool = False,
             rejected_path: str | None = None) -> DataFrame:
    """Raw ticks of inclusive days to archive, candles and ledger; returns the report, a row for each symbol.

    Candles come from the archived days that *ticks* has, symbol by symbol: what
    other runs have archived stays out.  A dry run computes everything and writes
    neither archive nor ledger.  With *rejected_path* the candles the ledger does not take
    are kept there, with the reason.
    """
    start, end = check_days(start, end)
    timeframe_seconds(check_timeframe_name(timeframe))
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    log = RunLog({"timeframe": timeframe, "mode": "backfill", "start": start, "end": end, "dry_run": dry_run})
    delivered = in_days(ticks.withColumn("symbol", F.upper("symbol")), start, end)
    work: dict[str, DataFrame] = {}

    def source():
        work["ticks"] = drop_repeated_rows(delivered)
        return "ok", f"days {start} to {end}"

    def archive():
        if not dry_run:
            day = F.to_date("timestamp_utc")
            days = stored(delivered.select("symbol", day.alias("_day")).distinct(), "run-days")
            archive_days(delivered, archive_path)
            archived = read_archive(spark, archive_path, start, end).withColumn("_day", day)
            work["ticks"] = archived.join(days, ["symbol", "_day"], "left_semi").drop("_day")
            log.count(days, archive_days=F.count(F.lit(1)))
        found = log.count(work["ticks"], ticks_ingested=F.count(F.lit(1)))["ticks_ingested"]
        if not found:
            raise ValueError(f"no ticks between {start} and {end}")
        if dry_run:
            return "skipped", "archive not written (dry run)"
        log.counts.append(log.counts[-1].withColumnRenamed("ticks_ingested", "archive_rows"))
        return "ok", f"{found} ticks"

    shared = _candle_stages(
        spark, log, work, timeframe, period, ledger_path, now_ms, dry_run, rejected_path=rejected_path
    )
    for name, stage in zip(STAGES, [source, archive, *shared]):
        log.run(name, stage)
    return log.frame(spark)


def live(spark: SparkSession, documents: DataFrame, *, ledger_path: str, fetch_interval: str = "1min",
         timeframe: str = "5min", period: int = 14, now_ms: int | None = None, dry_run: bool = False,
         trim: bool = True) -> DataFrame:
    """Feed documents to candles and ledger; returns the report, a row for each symbol.

    The days of the report are those of the bars delivered.  Nothing is
    archived: ``streaming.ticks.write_archive`` adds part of a day safely.
    """
    check_divides(fetch_interval, check_timeframe_name(timeframe))
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    log = RunLog({"timeframe": timeframe, "mode": "live", "start": "", "end": "", "dry_run": dry_run})
    work: dict[str, DataFrame] = {}

    def source():
        work["ticks"] = live_ticks(documents)
        day = F.to_date("timestamp_utc").cast("string")
        span = work["ticks"].agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
        if span["a"] is None:
            raise ValueError("the feed delivered no bars")
        log.header.update(start=span["a"], end=span["b"])
        found = log.count(work["ticks"], ticks_ingested=F.count(F.lit(1)))["ticks_ingested"]
        return "ok", f"{found} ticks from {fetch_interval} bars"

    def archive():
        return "skipped", "part of a day would replace the whole day"

    def keep(candles):
        return trim_leading_partial(candles, work["ticks"]) if trim else candles

    shared = _candle_stages(spark, log, work, timeframe, period, ledger_path, now_ms, dry_run, keep)
    for name, stage in zip(STAGES, [source, archive, *shared]):
        log.run(name, stage)
    return log.frame(spark)
