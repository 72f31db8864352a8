"""Hot-key evidence from Spark's event log: a code holding a third of all rows
is cut down before the shuffle (partial window limit / partial aggregate).

usage: python scripts/skew_evidence.py [rows]   (writes the event log to a fresh scratch folder)
"""

from __future__ import annotations

import glob
import io
import json
import sys
import tempfile

import zstandard

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])
sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0] + "/tests")

from aulastar.config import DOMAIN  # noqa: E402
from aulastar.operators import silver  # noqa: E402
from aulastar.session import get_spark  # noqa: E402
from test_skew import hot_raw  # noqa: E402


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    logdir = tempfile.mkdtemp(prefix="aulastar-evlog-", dir="/tmp")
    spark = get_spark("local[8]", "skew-evidence", {"spark.sql.shuffle.partitions": "16",
                                                    "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir})
    m, d = hot_raw(spark, "matriculados", n), hot_raw(spark, "docentes", n)
    spark.sparkContext.setJobDescription("M1 latest attributes (stg_entity)")
    silver.stg_entity([m, d]).count()
    spark.sparkContext.setJobDescription("M2 yearly measure")
    silver.yearly_measure(m, DOMAIN.numerator).count()
    spark.stop()
    print(f"| job | stage | tasks | rows in | shuffle rows written | shuffle rows read |\n|---|---|---|---|---|---|")
    for f in sorted(glob.glob(f"{logdir}/*/events*")):
        text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
        jobs = {}
        for line in text:
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                for sid in e.get("Stage IDs", []):
                    jobs[sid] = e.get("Properties", {}).get("spark.job.description")
            if e.get("Event") == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
                print(f"| {jobs.get(info['Stage ID'])} | {info['Stage ID']} | {info['Number of Tasks']} | "
                      f"{acc.get('internal.metrics.input.recordsRead', '-')} | "
                      f"{acc.get('internal.metrics.shuffle.write.recordsWritten', '-')} | "
                      f"{acc.get('internal.metrics.shuffle.read.recordsRead', '-')} |")


if __name__ == "__main__":
    main()
