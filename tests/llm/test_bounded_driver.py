"""What reaches the driver has a bound that does not grow with the corpus."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[2] / "cardwatch" / "llm"

# file -> what may be collected, each with its bound
ALLOWED = {
    "components.py": ["alias(\"h\")).first()"],          # one aggregate row
    "decontaminate.py": ["the bitmap's words", "1 to WINDOW rows"],  # 2^22 words at most
    "importance.py": ["at most BUCKETS rows", "a row per group of keys", "at most FEW keys", "a row per partition"],
    "license_scan.py": ["counts.collect()"],             # a row per template word
    "line_dedup.py": ["added.toArrow()", "groupBy(\"i\")"],  # SKETCH counters; a bitmap of at most _BITS
    "url_filter.py": ["limit(MAX_TERMS + 1)"],
    "packing.py": ["limit(max(most - 1, len(named)))", "alias(\"n\")).first()"],  # MAX_QUEUES totals; one row
}


def test_only_bounded_results_are_collected():
    pattern = re.compile(r"\.collect\(\)|toPandas\(|toArrow\(|\.first\(\)|\.head\(|localCheckpoint|crossJoin")
    for path in ROOT.glob("*.py"):
        for i, line in enumerate(path.read_text().splitlines(), 1):
            if pattern.search(line):
                assert any(a in line for a in ALLOWED.get(path.name, [])), f"{path.name}:{i}: {line.strip()}"
