"""Which steps of a run are whole, so that a rerun begins at the one that failed.

When a step ends, its entry names the versions that it read and the versions
that it wrote.  A rerun may leave a step out if its entry names exactly the
versions that are there now: nothing it read has changed, and what it wrote is
still the newest.  Anything else - other input, a table written since, an entry
cut off by a lost driver - makes the step run again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from grievance.plans.versions import read_json, write_json


def input_fingerprint(df: DataFrame) -> str | None:
    """A digest of the files that ``df`` reads (names, sizes, times) and of what it does with them; ``None`` if it reads no files."""
    spark = df.sparkSession
    names = sorted(df.inputFiles())
    if not names:
        return None
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    digest = hashlib.sha256()
    for name in names:
        status = jvm.org.apache.hadoop.fs.Path(name)
        found = status.getFileSystem(conf).getFileStatus(status)
        digest.update(f"{name}\0{found.getLen()}\0{found.getModificationTime()}\n".encode())
    digest.update(str(df.semanticHash()).encode())
    return digest.hexdigest()


class Ledger:
    """The steps of the runs that write to ``output``."""

    def __init__(self, spark: SparkSession, output: str):
        self.spark, self.folder = spark, f"{output.rstrip('/')}/_ledger"

    def whole(self, step: str, inputs: dict, outputs: dict) -> bool:
        """Whether the step ended with these inputs, and left these outputs."""
        entry = read_json(self.spark, f"{self.folder}/{step}.json")
        return None not in inputs.values() and None not in outputs.values() and entry == {"inputs": inputs, "outputs": outputs}

    def record(self, step: str, inputs: dict, outputs: dict) -> None:
        write_json(self.spark, f"{self.folder}/{step}.json", {"inputs": inputs, "outputs": outputs}, overwrite=True)


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256(json.dumps(sorted(parts)).encode()).hexdigest()
