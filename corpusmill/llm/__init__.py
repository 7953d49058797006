"""Training-data operators: packing, tokenising, deduplication, search, sharding."""

import os

# Spark gives each task a core. BLAS threads beside the JVM only contend with it,
# and have been seen to stall in the driver.
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")
