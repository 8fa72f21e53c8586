"""Task failures mid-write: retried tasks must leave whole, unduplicated layers.

Runs in a separate local session that allows task retries (``local[4,4]``);
a test-only filter fails the first attempt of every even partition while
the raw layer is being written.
"""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import sys, tempfile
    sys.path.insert(0, {repo!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from grievance.session import RECOMMENDED_CONF, shared_path
    from grievance.plans.daily import load_raw_from_tables, run, read_table

    b = SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
    b = b.config("spark.sql.shuffle.partitions", "8")
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")

    marks = tempfile.mkdtemp(prefix="grievance-ft-marks-")

    @F.udf("boolean")
    def lose_first_attempt(_):
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
            open(f"{{marks}}/stage{{tc.stageId()}}-part{{tc.partitionId()}}", "w").close()
            raise RuntimeError("injected task loss")
        return True

    raw = load_raw_from_tables(spark, {sf!r}).filter(lose_first_attempt(F.col("complaint_id")))
    out = shared_path(spark, "fault-tolerance")
    rep = run(spark, raw, out, length_gate="warn", suite_gate="warn", tests_gate="warn")
    raw_t = read_table(spark, out, "consumer_complaints")
    ids = raw_t.select("complaint_id").distinct().count()
    import os
    print("RESULT", rep.raw_rows, ids, rep.fact_rows, len(os.listdir(marks)) > 0)
    """
)


def test_layers_survive_task_retries(sf_small):
    code = SCRIPT.format(repo=REPO, sf=sf_small)
    proc = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    lines = [x for x in proc.stdout.splitlines() if x.startswith("RESULT")]
    assert lines, proc.stderr[-3000:]
    assert lines[-1].split()[1:] == ["4599", "4599", "4380", "True"]  # failures were injected
