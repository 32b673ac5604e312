import json

import pytest
from helpers import actions, clicks, rows

from clickloom.operators.words import word_count
from clickloom.plans import jobs
from clickloom.schemas import TABLES
from clickloom.session import new_shared_dir, store
from clickloom.sinks import streams as stream_sinks
from clickloom.sinks import tables as sinks
from clickloom.sources import streams
from clickloom.sources.params import JobParams
from clickloom.sources.tables import from_rows, read_table

PARAMS = JobParams("2024-01-05", "2024-01-25", 20, 50, ("1", "2", "3"))


def test_params_from_lenient_json(spark):
    text = """{startDate:"2024-01-05", endDate:"2024-01-25", startAge: "20", endAge: 50,
               city: "", targetPageFlow:"1,2,3"}"""
    assert JobParams.from_json(spark, text) == PARAMS


def test_params_treat_empty_as_absent():
    assert JobParams.from_mapping({"startAge": "", "endDate": None, "targetPageFlow": ""}) == JobParams()


def test_broken_json_fails(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        JobParams.from_json(spark, "{startDate")


def test_kafka_options():
    options = streams.kafka_options(
        "b1:9092,b2:9092", "ads_log", {"ads_log": {0: 23, 1: -2}}, group_id="g", max_offsets_per_trigger=1000
    )
    assert json.loads(options.pop("startingOffsets")) == {"ads_log": {"0": 23, "1": -2}}
    assert options == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092",
        "subscribe": "ads_log",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "1000",
    }


def test_kafka_lines_take_value_or_key(spark):
    with pytest.raises(ValueError):
        streams.message_lines(spark.range(1), "offset")


def test_message_values_and_keys_as_text(spark):
    data = [(bytearray(b"k1"), bytearray("v \u00e9".encode()), 0), (None, bytearray(b""), 1), (bytearray(b"k"), None, 2)]
    messages = spark.createDataFrame(data, "key binary, value binary, offset long")
    assert [r[0] for r in streams.message_lines(messages).collect()] == ["v \u00e9", "", None]
    assert [r[0] for r in streams.message_lines(messages, "key").collect()] == ["k1", None, "k"]
    assert streams.message_lines(messages, "key").columns == ["value"]


def test_streams_of_lines(spark, tmp_path):
    assert streams.text_lines(spark, str(tmp_path), 1).isStreaming
    socket = streams.socket_lines(spark, "localhost", 9)
    assert socket.isStreaming and socket.columns == ["value"]
    assert streams.text_lines(spark, str(tmp_path)).columns == ["value"]


def test_console_sink(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a b\na")
    query = stream_sinks.to_console(
        word_count(streams.text_lines(spark, str(tmp_path))), "complete", availableNow=True
    )
    query.awaitTermination()
    assert query.exception() is None


@pytest.mark.parametrize("name", TABLES)
def test_table_round_trip(spark, tmp_path, name):
    row = tuple(i if f.dataType.typeName() in ("long", "integer") else f"v{i}" for i, f in enumerate(TABLES[name]))
    frame = from_rows(spark, name, [row])
    sinks.write_parquet(frame, str(tmp_path / name))
    assert read_table(spark, name, str(tmp_path / name)).collect() == [row]
    sinks.replace_table(frame.union(frame), name)
    sinks.replace_table(frame, name)
    again = read_table(spark, name)
    assert again.collect() == [row] and again.columns == TABLES[name].names
    spark.sql(f"drop table {name}")


class Writer:
    """Records the calls on a DataFrame writer; no database is at hand."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def record(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return record


def test_jdbc_append():
    class Frame:
        write = Writer()

    options = sinks.jdbc_options("jdbc:x", "t", batch_size=5, user="u", password="p")
    assert options == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "5", "numPartitions": "10", "user": "u", "password": "p"
    }
    sinks.append_jdbc(Frame, options)
    assert Frame.write.calls == [
        ("format", ("jdbc",), {}), ("options", (), options), ("mode", ("append",), {}), ("save", (), {})
    ]


def test_stored_frame(spark):
    frame = spark.createDataFrame([("a", 1)], "k string, n long")
    assert store(frame, "x").collect() == frame.collect()
    assert new_shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_jobs_write_stamped_results(spark):
    data = clicks(3, 2, user_id=1, date="2024-01-06", session_id="s", page_id=1, click_product_id=8, city_id=1)
    data = [row | {"action_time": f"2024-01-06 00:00:0{i}", "page_id": i + 1} for i, row in enumerate(data)]
    frame = actions(spark, data)
    users = from_rows(spark, "user_info", [(1, "u", "n", 30, "p", "g")])
    cities = from_rows(spark, "city_info", [(1, "c", "A")])
    products = from_rows(spark, "product_info", [(8, "p", "")])
    written = {}

    def write(df, name):
        written[name] = [tuple(row) for row in df.collect()]

    jobs.category_job(frame, users, PARAMS, write)
    jobs.page_jump_job(frame, PARAMS, write)
    jobs.area_job(frame, cities, products, write)
    assert {name: [row[1:] for row in found] for name, found in written.items()} == {
        "category_top10": [("3", 2, 0, 0)],
        "category_session_top10": [("3", "s", 2)],
        "jump_page_ratio": [("1-2", 1.0)],
        "area_count_info": [("A", "p", 2, "c:100.0%,其他：0.0%")],
    }
    prefixes = {name: found[0][0].rstrip("0123456789") for name, found in written.items()}
    assert prefixes == {
        "category_top10": "One-",
        "category_session_top10": "Two-",
        "jump_page_ratio": "Three-",
        "area_count_info": "Four--",
    }


def test_words_are_cut_at_single_spaces(spark):
    assert rows(word_count(spark.createDataFrame([("a  b ",)], "value string"))) == [("a", 1), ("b", 1)]
