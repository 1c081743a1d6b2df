"""A8 as Structured Streaming: watermark-bounded daily counts over the reference's event seeds."""

import datetime as dt
import tempfile
import uuid

from tests import seeds
from bazaar.streaming import retention as S


def test_daily_counts_and_ttl(spark):
    src = tempfile.mkdtemp(prefix="bazaar-stream-src-")
    seeds.product_events(spark).write.mode("overwrite").parquet(src + "/batch1")
    # one event far in the future pushes the watermark (newest event − 90 days) past the seed days,
    # so their daily counts are final and emitted in append mode
    late = spark.createDataFrame([(9, 1, "VIEW", "s", dt.datetime(2024, 9, 1)),
                                  ], "customer_id int, product_id int, event_type string, session_id string, "
                                     "created_at timestamp_ntz")
    late.write.mode("overwrite").parquet(src + "/batch2")
    stream = S.read_event_stream(spark, src + "/*", max_files_per_trigger=1)
    name = "daily_" + uuid.uuid4().hex[:8]
    q = S.start(S.daily_event_counts(stream), name, "memory")
    q.awaitTermination(120)
    rows = spark.sql(f"select * from {name}").collect()
    by_day = {(r.day.start.date(), r.product_id, r.event_type): r.events for r in rows}
    # days of the seed are final once the watermark passed them
    assert by_day[(dt.date(2024, 1, 20), 1, "VIEW")] == 2
    assert by_day[(dt.date(2024, 1, 19), 1, "PURCHASE")] == 1
    assert sum(v for (d, _, _), v in by_day.items() if d < dt.date(2024, 2, 1)) == 11
