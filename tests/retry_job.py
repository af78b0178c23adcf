"""Run by test_task_retries: sequence() with task failures injected into the
first attempt of every map task; positions must still equal row_number."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tickweave.plans import lagged, sequence  # noqa: E402
from tickweave.session import get_session  # noqa: E402
from tickweave.sources.events import ticks_from_events  # noqa: E402

SF = sys.argv[1]
spark = get_session(
    "local[4, 3]",  # up to 3 attempts per task
    shuffle_partitions=4,
    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tickweave-retry-")},
)


@F.udf(T.DoubleType())
def flaky(x):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return x


t = ticks_from_events(spark, SF).withColumn("price", flaky("price"))
s = sequence(t, chunks=6)
got = lagged(s, {"l1": ("price", 1)}, rows=50).select("event_id", "pos", "l1").toPandas()
exp = duckdb.sql(
    f"select event_id, row_number() over w - 1 as pos, lag(value) over w as l1 from '{SF}/events.parquet' "
    "window w as (partition by event_type order by ts, event_id)"
).df()
m = got.merge(exp, on="event_id")
ok = len(m) == len(exp) and (m.pos_x == m.pos_y).all() and ((m.l1_x == m.l1_y) | m.l1_y.isna()).all()
print("RETRY_OK" if ok else "RETRY_BAD")
