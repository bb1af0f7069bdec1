"""How much a Python function is handed at once."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

#: Bytes of a batch that goes to a Python worker.  A batch is held off the heap in the JVM, with room to double, and
#: again in the worker; the default of 64 MB is too much for small executors and whole texts.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bound on batches to BATCH_BYTES, unless it is lower already."""
    now = re.fullmatch(r"(\d+)b?", spark.conf.get(_BATCH) or "")
    if now is None or int(now[1]) > BATCH_BYTES or int(now[1]) <= 0:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
