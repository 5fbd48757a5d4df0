"""Spark-native analytics over document corpora."""

import os

for _name in ("OPENBLAS_NUM_THREADS", "OMP_NUM_THREADS", "MKL_NUM_THREADS"):
    os.environ.setdefault(_name, "1")  # cores are Spark's to deal out; a pool of threads doesn't survive the fork that starts the JVM
