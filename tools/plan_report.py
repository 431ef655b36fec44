"""Print a Markdown table of the physical plans that each registered query runs.

Usage: python tools/plan_report.py [sf_dir]

Every query is run and its plans are read from Spark's event log, so streams and jobs
show the plans that do their work (all micro-batches and table writes), not only the
read of what they wrote.  AQE is off so the static plans are shown (AQE may later
coalesce partitions, switch a join to broadcast from measured sizes, or split skew).
Columns: plans run, the most hash/range exchanges, broadcast exchanges and windows in one
plan, join strategies, the most parses of a message or document in one plan, and the
columns the file scans read.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ingot import catalog  # noqa: E402, F401
from ingot.registry import QUERIES  # noqa: E402
from ingot.session import build_session  # noqa: E402
from ingot.sources import fixtures as X  # noqa: E402


def shape(plan: str) -> dict:
    scans = re.findall(r"FileScan \w+ ([^\[]*)\[([^\]]*)\]", plan)
    return {
        "shuffles": len(re.findall(
            r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "joins": set(re.findall(r"(\w+Join)\b", plan)),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "limited": "WindowGroupLimit" in plan,
        # Parses of a message or document (the fixtures' own parse of ``props`` aside).
        "parses": len(re.findall(r"from_json\(StructField\((?!k,)", plan)),
        "scanned": {c.split("#")[0] for _, cols in scans for c in cols.split(",") if c},
    }


def logged(folder: Path, seen: int) -> tuple[list[str], int]:
    """The plans that the event log has beyond ``seen`` lines."""
    (path,) = [p for p in folder.rglob("*") if p.is_file() and not p.name.endswith(".crc")
               and "appstatus" not in p.name]
    lines = path.read_text().split("\n")[:-1]
    events = (json.loads(x) for x in lines[seen:] if "SQLExecutionStart" in x[:120])
    return [e["physicalPlanDescription"].split("== Physical Plan ==")[-1] for e in events], len(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    folder = Path(tempfile.mkdtemp(prefix="plans-"))
    spark = build_session("local[4]", extra={
        "spark.sql.adaptive.enabled": "false", "spark.sql.ui.explainMode": "extended",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}",
        "spark.eventLog.buffer.kb": "1k", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false", "spark.sql.maxPlanStringLength": "400000"})
    X.landed_bronze_matches(spark, sf_dir)
    X.landed_bronze_matches(spark, sf_dir, duplicates=True)
    X.landed_bronze_stage_table(spark, sf_dir)
    X.landed_bronze_events(spark, sf_dir)
    X.document_table(spark, sf_dir)
    for name in X.SAMPLE_TABLES:
        X.landed_samples(spark, sf_dir, name)
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    _, seen = logged(folder, 0)
    print("| Query | Plans | Shuffles | Broadcasts | Joins | Windows | Parses | Columns scanned |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        bus.waitUntilEmpty()
        plans, seen = logged(folder, seen)
        shapes = [shape(p) for p in plans]
        joins = sorted(set().union(*(s["joins"] for s in shapes)))
        scanned = sorted(set().union(*(s["scanned"] for s in shapes)))
        most = {k: max(s[k] for s in shapes) for k in ("shuffles", "broadcasts", "windows", "parses")}
        windows = ("group-limited " if any(s["limited"] for s in shapes) else "") + str(most["windows"])
        print(f"| `{name}` | {len(plans)} | {most['shuffles']} | {most['broadcasts']} | "
              f"{', '.join(joins) or '—'} | {windows} | {most['parses']} | {', '.join(scanned) or '—'} |",
              flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
