"""SURVEY 5.5: nothing pulls data rows to the driver.

Every driver-side collect in the package must read metadata of bounded size.
This test pins the complete list, so a new one needs a conscious decision."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parent.parent / "cardwatch"

# file -> the collects it may contain, each with why its size is bounded
ALLOWED = {
    "plans/daily.py": [
        "limit(1).collect()",            # newest commit row
        "pick_feeds(",                   # one row per feed (three feeds)
    ],
    "sinks/warehouse.py": [
        'orderBy("run_id").collect()',   # commit log: one row per daily run
        'select("run_id", "transactions_dt", column).collect()',  # the same
        'alias("m")).collect()[0]',      # one aggregate row
        'select("buckets").collect()',   # one commit row
    ],
    "sinks/buckets.py": [
        "manifest_{name}/run={run_id}\").collect()",  # a row per bucket, and per run that closed versions
        "at most the bucket count",
    ],
    "sources/snapshots.py": ["ranges - 1 values"],
    "operators/staging.py": [
        "limit(1).collect()",            # at most one offending key
    ],
}


def test_only_metadata_is_collected():
    pattern = re.compile(r"\.collect\(\)|toPandas\(|\.take\(|\.first\(\)|\.head\(")
    for path in ROOT.rglob("*.py"):
        rel = path.relative_to(ROOT).as_posix()
        if rel.startswith("llm/"):  # has a list of its own
            continue
        lines = path.read_text().splitlines()
        for i, line in enumerate(lines):
            if not pattern.search(line) or line.strip().startswith("#"):
                continue
            context = " ".join(lines[max(0, i - 1):i + 1])
            assert any(a in context for a in ALLOWED.get(rel, [])), f"{rel}:{i + 1}: {line.strip()}"
