"""The REST source against a server that fails at random, and the change-log sink."""

import json
import random
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from lakeloom.sources import rest
from lakeloom.streaming.changelog import ChangeLogSink, capture


class Server:
    """Rows by (updated_at, id) after updated_since, in pages; some requests fail."""

    def __init__(self):
        self.rows, self.failing, self.calls = {}, 0.0, 0
        outer, dice = self, random.Random(5)

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                outer.calls += 1
                q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
                if self.headers["Authorization"] != "Bearer secret":
                    return self.answer(401, {})
                if dice.random() < outer.failing:
                    return self.answer(500, {})
                page, size = int(q["page"]), int(q["page_size"])
                found = sorted((r for r in outer.rows.values() if r["updated_at"] > q.get("updated_since", "")), key=lambda r: (r["updated_at"], r["id"]))
                return self.answer(200, {"data": found[(page - 1) * size : page * size], "pagination": {"total": len(found)}})

            def answer(self, status, body):
                self.send_response(status)
                self.end_headers()
                self.wfile.write(json.dumps(body).encode())

            def log_message(self, *args):
                pass

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.http.serve_forever, daemon=True).start()

    def put(self, i, second, v):
        self.rows[i] = {"id": i, "v": v, "updated_at": f"2024-01-01T00:{second // 60:02}:{second % 60:02}", "tags": ["x"]}


@pytest.fixture
def server(spark):
    rest.register(spark)
    s = Server()
    for i in range(230):
        s.put(i, 1 + i // 3 if i > 60 else 1, "a")  # sixty of one instant
    yield s
    s.http.shutdown()


SCHEMA = "id long, v string, updated_at string, tags string"


def options(reader, server, **more):
    own = {"url": f"http://127.0.0.1:{server.http.server_port}/things", "token": "secret", "page_size": 20, "wait": 0.01, "tries": 12} | more
    return reader.format("rest_pages").schema(SCHEMA).options(**own)


def test_batch(spark, server):
    server.failing = 0.3
    df = options(spark.read, server).load()
    assert sorted((r.id, r.v, r.tags) for r in df.collect()) == [(i, "a", '["x"]') for i in range(230)]
    assert df.rdd.getNumPartitions() > 1
    late = options(spark.read, server, updated_since="2024-01-01T00:01:10").load()
    assert {r.id for r in late.collect()} == {i for i, r in server.rows.items() if r["updated_at"] > "2024-01-01T00:01:10"}
    assert options(spark.read, server, updated_since="2025-01-01T00:00:00").load().count() == 0
    with pytest.raises(Exception, match="401"):
        options(spark.read, server, token="no").load().collect()


def test_stream_is_read_again_exactly_after_a_failure(spark, server, tmp_path):
    def run(**more):
        df = options(spark.readStream, server, **more).load()
        q = df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination()

    got = lambda: sorted((r.id, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    server.failing = 0.2
    run()
    assert got() == [(i, "a") for i in range(230)]
    server.put(3, 500, "b")
    for i in range(300, 340):
        server.put(i, 501, "c")
    server.failing = 0.9
    with pytest.raises(Exception):
        run(tries=1)
    server.failing = 0.2
    server.put(4, 600, "d")  # while the failed span waits
    run()
    run()
    assert got() == sorted([(i, "a") for i in range(230)] + [(3, "b"), (4, "d")] + [(i, "c") for i in range(300, 340)])


# --- the change log

EVENT = "op string, ts_ms long, before string, after string, source struct<table:string,lsn:long>"


def events(spark, *numbers):
    return spark.createDataFrame([("u" if n % 2 else "d", 1_700_000_000_000 + n * 40_000_000, None, f"row {n}", ("orders" if n % 3 else "items", n)) for n in numbers], EVENT)


def landed(spark, root, table):
    return sorted(r.source.lsn for r in spark.read.parquet(f"{root}/{table}").collect())


def test_an_epoch_lands_once(spark, tmp_path):
    root = str(tmp_path / "erp")
    sink = ChangeLogSink(spark, root, "erp-1")
    assert sink.write(events(spark, *range(1, 11)), 0) and not sink.write(events(spark, *range(1, 11)), 0)
    assert landed(spark, root, "orders") == [1, 2, 4, 5, 7, 8, 10] and landed(spark, root, "items") == [3, 6, 9]
    # it died before its marker: its files are replaced
    (tmp_path / "erp/_epochs/erp-1/000000000000.json").write_text("")
    assert ChangeLogSink(spark, root, "erp-1").write(events(spark, *range(1, 11)), 0)
    assert landed(spark, root, "orders") == [1, 2, 4, 5, 7, 8, 10] and sink.gaps() == []
    other = ChangeLogSink(spark, root, "erp-2")  # another source's epoch 0 is its own
    assert other.write(events(spark, 50), 0) and 50 in landed(spark, root, "orders")


def test_gaps_are_told(spark, tmp_path):
    sink = ChangeLogSink(spark, str(tmp_path / "erp"), "s")
    for epoch, numbers in enumerate([(1, 2, 3), (4, 5, 5), (8, 9), (), (10, 12), (11, 13)]):
        sink.write(events(spark, *numbers) if numbers else events(spark, 1).limit(0), epoch)
    assert [(g["epoch"], g["missing"]) for g in sink.gaps()] == [(2, 2), (4, 1)]
    with pytest.raises(ValueError):
        ChangeLogSink(spark, "x", "../up")


def test_capture_from_a_stream(spark, tmp_path):
    for k in range(3):
        events(spark, *range(10 * k + 1, 10 * k + 11)).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    sink = ChangeLogSink(spark, str(tmp_path / "erp"), "s")
    for _ in range(2):
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
        capture(stream, sink, str(tmp_path / "c"))
    assert landed(spark, str(tmp_path / "erp"), "orders") + landed(spark, str(tmp_path / "erp"), "items") == [n for n in range(1, 31) if n % 3] + [n for n in range(1, 31) if n % 3 == 0]
    assert len(sink.epochs()) == 3 and sink.gaps() == []
