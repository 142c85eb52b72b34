"""Makes this package importable in Spark's Python workers."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
#: Texts and lists of hashes are long: batches to and from Python workers are bounded by bytes.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "8m"


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package's modules to the executors, once per application.

    Spark's own file service carries them, so executors need no copy of the repository. The zip is
    written by the driver for that service only. Unless the application sets another limit, a batch
    of rows between Spark and a Python worker has ``BATCH_BYTES`` at most.
    """
    context = spark.sparkContext
    if _BATCH_BYTES not in dict(context.getConf().getAll()):
        spark.conf.set(_BATCH_BYTES, BATCH_BYTES)
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        parent = os.path.dirname(package)
        path = os.path.join(tempfile.mkdtemp(prefix="opdiag-code-"), "opdiag_code.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in sorted(os.walk(package)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, parent))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark


def released(work: Callable) -> Callable:
    """``work`` on a partition's batches; what it has freed goes back to the system at its end.

    Python workers live as long as their executor and serve one operator after the other, and both
    Arrow's pool and the C library keep freed memory for themselves.
    """

    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run
