"""Make the package importable on executors.

Python steps that run inside tasks (the page job, the history fold) are
pickled by reference to ``quarry`` functions, so the workers must be able
to import the package.  ``ensure_on_executors`` zips the installed package
once per application and registers it with ``addPyFile`` — the same thing
``spark-submit --py-files`` does.  The zip only has to exist on the driver;
Spark distributes it.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ensure_on_executors(spark: SparkSession) -> None:
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-pyfiles-"), "quarry.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
