"""Work off a backlog of feed files, oldest date first."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from cardwatch.plans.daily import RunResult, Sources, run


def run_until_caught_up(spark: SparkSession, sources: Sources, root: str, run_ts: dt.datetime,
                        mode: str = "intended", **kw) -> list[RunResult]:
    """Run until no feed has a file newer than its watermark, however many there are.

    The snapshots are extracted, staged and merged by the first run alone; the
    others take up its staged copies, so the loop sees one state of the sources.

    Successive runs are one second apart, so each run's history is ordered
    after the previous one.  Every run that picks a file moves that feed's
    watermark to the file's date, so the loop ends; a run that picks what an
    earlier one of this loop has picked is an error."""
    out: list[RunResult] = []
    seen: set[tuple[str, str]] = set()
    while True:
        r = run(spark, sources, root, run_ts + dt.timedelta(seconds=len(out)), mode,
                snapshots_of=out[0] if out else None, **kw)
        out.append(r)
        if not r.picked:
            return out
        again = seen & {(f, name) for f, (name, _) in r.picked.items()}
        if again:
            raise RuntimeError(f"picked again after it was loaded: {sorted(again)}")
        seen |= {(f, name) for f, (name, _) in r.picked.items()}
