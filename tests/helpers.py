"""Small log rows for hand-made cases."""

import json

from pyspark.sql import types as T

from tradewake.schemas import PAGE_LOG

DAY = 86_400_000


def page_rows(spark, events):
    """Rows (mid, ts, entry, page_id) as page logs with an ``offset`` in list order."""
    rows = []
    for i, (mid, ts, entry, *page_id) in enumerate(events):
        rows.append((
            (mid, "0", "v1", "web", "north"),
            (page_id[0] if page_id else "home", None if entry else "before", None, 7),
            None, ts, i))
    schema = T.StructType([*PAGE_LOG.fields, T.StructField("offset", T.LongType())])
    return spark.createDataFrame(rows, schema)


def log_text(mid="a", ts=0, is_new="0", **more):
    return json.dumps({"common": {"mid": mid, "is_new": is_new, "vc": "v1", "ch": "web",
                                  "ar": "north"}, "ts": ts, **more})


def texts(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)],
                                 "value string, offset bigint")
