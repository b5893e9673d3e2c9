from helpers import pollution, send, traffic
from kerbside.operators import serving
from kerbside.sources.topics import read_message_files
from kerbside.streaming.gold import start_gold, table_sink, windows
from kerbside.streaming.triggers import ONCE


def test_each_message_is_read_once(spark, folder):
    """Of a batch, also where the sink looks at it several times."""
    for part in range(2):
        send(spark, [traffic(f"0{part}:{m:02d}:00", speed=m) for m in range(30)] + [traffic("bad")], f"{folder}/traffic")
        send(spark, [pollution(f"0{part}:{m:02d}:00", pm25=m) for m in range(20)], f"{folder}/pollution")
    kpi = windows(*[read_message_files(spark, f"{folder}/{feed}") for feed in ("traffic", "pollution")], width="1 hour")
    table, kept = table_sink(f"{folder}/serving"), []

    def sink(rows, batch_id, stream_id):
        kept.append("InMemoryRelation" in rows._jdf.queryExecution().withCachedData().toString())
        table(rows, batch_id, stream_id)

    query = start_gold(kpi, sink, f"{folder}/progress", None, ONCE)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2 * (31 + 20)
    assert kept and all(kept)
    rows = serving.current(spark, f"{folder}/serving").collect()
    assert [(r.avg_speed, r.avg_pm25) for r in rows] == [(14.5, 9.5)]
