"""Landing discovery and the envelope scan on the FIXTURES.md §B edge documents."""

import pytest

from quayside.errors import ContractError, NoNewData, Outcome
from quayside.plans.history_ingest import history_frame, ingest_history
from quayside.sinks.history import HistoryTable
from quayside.sources.json_feed import corrupt_documents, read_envelopes
from quayside.sources.landing import LandingFeed

REGULAR = {"Data": [
    {"id": 1, "amount": 1.50, "active": True, "created": "2024-07-01 12:00:00",
     "zone": "Europe/Paris", "day": "01/07/2024",
     "site": {"code": 7, "name": "A"}, "tags": ["x", "y"], "lines": [{"q": 1}, {"q": 2}]},
    {"id": 2, "note": None}],
    "Meta": "dropped"}


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_date_folders_skip_missing_and_empty(spark, landing):
    root = landing({"20240101/a.json": REGULAR, "20240103": None, "20240104/b.json": REGULAR})
    feed = LandingFeed(root, "feed")
    got = feed.date_folders(spark, "20240102,20240104")
    # window = 1..4 Jan: 2 Jan is missing, 3 Jan is empty
    assert [p.rsplit("/", 1)[1] for p in got] == ["20240101", "20240104"]
    # "all" lists day folders once; the empty one is left to Spark's file listing
    assert [p.rsplit("/", 1)[1] for p in feed.date_folders(spark, "all")] == ["20240101", "20240103", "20240104"]
    assert [p.rsplit("/", 1)[1] for p in feed.date_folders(spark, "ALL", starting_from="20240102")] == [
        "20240103", "20240104"]
    with pytest.raises(ValueError):
        feed.date_folders(spark, "")


def test_regular_document_flattens_with_text_leaves(spark, landing):
    root = landing({"20240701/a.json": REGULAR})
    df = history_frame(spark, LandingFeed(root, "feed").date_folders(spark, "all"))
    assert "Meta" not in df.columns
    got = {r["id"]: r for r in df.collect()}
    assert got["1"]["amount"] == "1.5"
    assert got["1"]["active"] == "true"
    assert got["1"]["site"] == '{"code":"7","name":"A"}'
    assert got["1"]["tags"] == '["x","y"]'
    assert got["1"]["lines"] == '[{"q":"1"},{"q":"2"}]'
    assert got["2"]["note"] is None
    assert str(got["1"]["ingestion_date"]) == "2024-07-01"
    assert got["1"]["source_path"].endswith("/feed/20240701/a.json")
    assert df.schema["processing_time"].dataType.typeName() == "timestamp"


def test_number_text_is_verbatim(spark, landing):
    root = landing({"20240101/a.json": '{"Data": [{"a": 1.50, "b": 1e3, "c": 12345678901234567890123}]}'})
    r = history_frame(spark, [f"{root}/feed/20240101"]).first()
    assert (r["a"], r["b"], r["c"]) == ("1.50", "1e3", "12345678901234567890123")


def test_two_days_union_of_fields(spark, landing):
    root = landing({"20240101/a.json": {"Data": [{"id": 1, "old": "x"}]},
                    "20240102/b.json": {"Data": [{"id": 2, "new": "y"}]}})
    df = history_frame(spark, LandingFeed(root, "feed").date_folders(spark, "all"))
    assert rows(df, "id", "old", "new") == [("1", "x", None), ("2", None, "y")]


def test_empty_array_beside_normal_file(spark, landing):
    root = landing({"20240101/a.json": {"Data": []}, "20240101/b.json": {"Data": [{"id": 1}]}})
    assert rows(history_frame(spark, [f"{root}/feed/20240101"]), "id") == [("1",)]


@pytest.mark.parametrize("content", ['{"Data": []}', "{}", ""])
def test_nothing_to_ingest_is_no_new_data(spark, landing, tmp_path, content):
    root = landing({"20240101/a.json": content})
    res = ingest_history(spark, LandingFeed(root, "feed"), HistoryTable(str(tmp_path / "h")), "20240101")
    assert res.outcome is Outcome.NO_NEW_DATA


def test_all_mode_with_only_empty_folders_is_no_new_data(spark, landing, tmp_path):
    root = landing({"20240101": None, "20240102": None})
    res = ingest_history(spark, LandingFeed(root, "feed"), HistoryTable(str(tmp_path / "h")), "all")
    assert res.outcome is Outcome.NO_NEW_DATA


def test_all_mode_reads_beside_empty_folder(spark, landing, tmp_path):
    root = landing({"20240101": None, "20240102/a.json": {"Data": [{"id": 1}]}})
    history = HistoryTable(str(tmp_path / "h"))
    assert ingest_history(spark, LandingFeed(root, "feed"), history, "all").ok
    assert rows(history.read(spark), "id") == [("1",)]


def test_missing_folder_alone_is_no_new_data(spark, landing, tmp_path):
    root = landing({"20240101/a.json": REGULAR})
    res = ingest_history(spark, LandingFeed(root, "feed"), HistoryTable(str(tmp_path / "h")), "20240301")
    assert res.outcome is Outcome.NO_NEW_DATA


def test_corrupt_only_is_no_new_data_and_counted(spark, landing, tmp_path):
    root = landing({"20240101/a.json": '{"Data":[{"id":1'})
    assert corrupt_documents(spark, [f"{root}/feed/20240101"]).count() == 1
    res = ingest_history(spark, LandingFeed(root, "feed"), HistoryTable(str(tmp_path / "h")), "20240101")
    assert res.outcome is Outcome.NO_NEW_DATA
    assert res.metrics["corrupt_documents"] == 1


def test_corrupt_beside_good_file(spark, landing, tmp_path):
    root = landing({"20240101/a.json": '{"Data":[{"id":1', "20240101/b.json": {"Data": [{"id": 2}]}})
    assert corrupt_documents(spark, [f"{root}/feed/20240101"]).count() == 1
    history = HistoryTable(str(tmp_path / "h"))
    res = ingest_history(spark, LandingFeed(root, "feed"), history, "20240101")
    assert res.ok and res.metrics["corrupt_documents"] == 1
    assert rows(history.read(spark), "id") == [("2",)]


def test_fail_policy_rejects_a_corrupt_document_and_keeps_the_table(spark, landing, tmp_path):
    root = landing({"20240101/a.json": {"Data": [{"id": 1}]}})
    history = HistoryTable(str(tmp_path / "h"))
    assert ingest_history(spark, LandingFeed(root, "feed"), history, "all", on_corrupt="fail").ok
    landing({"20240102/a.json": '{"Data":[{"id":2', "20240102/b.json": {"Data": [{"id": 3}]}})
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        ingest_history(spark, LandingFeed(root, "feed"), history, "20240102", on_corrupt="fail")
    assert rows(history.read(spark), "id") == [("1",)]  # the failed run committed nothing
    res = ingest_history(spark, LandingFeed(root, "feed"), history, "20240102")
    assert res.ok and res.metrics["corrupt_documents"] == 1
    assert rows(history.read(spark), "id") == [("1",), ("3",)]


def test_object_envelope_is_contract_error(spark, landing):
    root = landing({"20240101/a.json": {"Data": {"id": 1}}})
    with pytest.raises(ContractError):
        history_frame(spark, [f"{root}/feed/20240101"])


def test_scalar_elements_are_contract_error(spark, landing):
    root = landing({"20240101/a.json": {"Data": ["a", "b"]}})
    with pytest.raises(ContractError):
        history_frame(spark, [f"{root}/feed/20240101"])


def test_top_level_array_of_envelopes(spark, landing):
    root = landing({"20240101/a.json": [{"Data": [{"id": 1}]}, {"Data": [{"id": 2}, {"id": 3}]}]})
    assert rows(history_frame(spark, [f"{root}/feed/20240101"]), "id") == [("1",), ("2",), ("3",)]


def test_bad_folder_name_is_counted_not_written(spark, landing, tmp_path):
    root = landing({"20240101/a.json": {"Data": [{"id": 1}]}, "notadate/b.json": {"Data": [{"id": 2}]}})
    history = HistoryTable(str(tmp_path / "h"))
    res = ingest_history(spark, LandingFeed(root, "feed"), history, "all")
    assert res.ok and res.metrics["rows_rejected"] == 1 and res.metrics["rows"] == 1
    assert rows(history.read(spark), "id") == [("1",)]


def test_nested_folder_needs_recursive_scan(spark, landing):
    root = landing({"20240101/a.json": {"Data": [{"id": 1}]}, "20240101/sub/b.json": {"Data": [{"id": 2}]}})
    feed = LandingFeed(root, "feed")
    assert rows(history_frame(spark, [f"{root}/feed/20240101"]), "id") == [("1",)]
    got = history_frame(spark, [feed.path], recursive=True)
    assert rows(got, "id") == [("1",), ("2",)]
    assert len(feed.files(spark)) == 2
    assert feed.latest_file(spark)[0].endswith("20240101/sub/b.json")
    assert LandingFeed(root, "missing").files(spark) == []
    assert LandingFeed(root, "missing").latest_file(spark) == []


def test_struct_like_variant_keeps_scalar_arrays(spark, landing):
    from quayside.functions.nested import is_struct_like, nested_to_json
    from quayside.operators.flatten import flatten_envelope
    root = landing({"20240101/a.json": REGULAR})
    raw = read_envelopes(spark, [f"{root}/feed/20240101"])
    df = nested_to_json(flatten_envelope(raw, "Data"), is_struct_like)
    r = df.where("id = '1'").first()
    assert r["tags"] == ["x", "y"] and r["site"] == '{"code":"7","name":"A"}' and r["lines"] == '[{"q":"1"},{"q":"2"}]'


def test_dotted_field_name_is_quoted(spark, landing):
    root = landing({"20240101/a.json": {"Data": [{"a.b": 1, "c": {"d.e": 2}}]}})
    r = history_frame(spark, [f"{root}/feed/20240101"]).first()
    assert r["a.b"] == "1" and r["c"] == '{"d.e":"2"}'


def test_lineage_clash_is_contract_error(spark, landing):
    root = landing({"20240101/a.json": {"Data": [{"id": 1, "source_path": "x"}]}})
    with pytest.raises(ContractError):
        history_frame(spark, [f"{root}/feed/20240101"])


def test_explicit_envelope_schema_skips_inference(spark, landing):
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType
    root = landing({"20240101/a.json": {"Data": [{"id": 1, "x": "y"}]}})
    schema = StructType([StructField("Data", ArrayType(StructType([StructField("id", StringType())])))])
    df = history_frame(spark, [f"{root}/feed/20240101"], schema=schema)
    assert rows(df, "id") == [("1",)] and "x" not in df.columns


def test_missing_folder_in_list_raises_no_new_data_only_when_empty(spark):
    with pytest.raises(NoNewData):
        read_envelopes(spark, [])


def test_pretty_printed_and_single_line_documents_read_alike(spark, landing):
    root = landing({"20240101/a.json": '{\n  "Data": [\n    {"id": 1,\n     "v": 2.50}\n  ]\n}\n',
                    "20240101/b.json": '{"Data": [{"id": 2, "v": 3}]}'})
    assert rows(history_frame(spark, [f"{root}/feed/20240101"]), "id", "v") == [("1", "2.50"), ("2", "3")]


def test_document_field_named_like_provenance_is_replaced(spark, landing):
    root = landing({"20240101/a.json": {"Data": [{"id": 1}], "source_path": "elsewhere"}})
    r = history_frame(spark, [f"{root}/feed/20240101"]).first()
    assert r["source_path"].endswith("/feed/20240101/a.json")


def test_landed_documents_stay_bounded_on_a_hot_day(spark, tmp_path):
    import datetime as dt

    from pyspark.sql import functions as F

    from quayside.testing import write_deliveries
    # day 1 holds 3,000 rows, days 2 and 3 hold 50 each
    data = [(i, dt.date(2024, 1, 1)) for i in range(3000)] + [(3000 + i, dt.date(2024, 1, 2 + i % 2)) for i in range(100)]
    df = spark.createDataFrame(data, "id long, d date")
    feed = LandingFeed(str(tmp_path / "landing"), "hot")
    write_deliveries(df, feed, F.col("d"), rows_per_document=500)
    docs = read_envelopes(spark, [feed.folder(d) for d in ("20240101", "20240102", "20240103")])
    sizes = sorted((r.day, r.n) for r in docs.select(
        F.regexp_extract("source_path", r"/([0-9]{8})/", 1).alias("day"), F.size("Data").alias("n")).collect())
    per_day = {}
    for day, n in sizes:
        per_day.setdefault(day, []).append(n)
    assert len(per_day["20240101"]) == 6 and sum(per_day["20240101"]) == 3000
    assert max(per_day["20240101"]) < 1000  # split by row hash, near 500 each
    assert per_day["20240102"] == [50] and per_day["20240103"] == [50]
    assert history_frame(spark, [feed.path], recursive=True).count() == 3100


def test_latest_file_descent_matches_the_full_listing(spark, tmp_path):
    from quayside.sources import fs
    root = tmp_path / "landing"
    layout = ["feed/20240101/a.json", "feed/20240102/b.json", "feed/20240102/sub/z.json",
              "feed/2024/zz.json", "feed/20240102x", "feed/0top.json", "feed/20240103/"]
    for rel in layout:
        p = root / rel
        if rel.endswith("/"):
            p.mkdir(parents=True, exist_ok=True)  # the newest folder is empty
        else:
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text("{}")
    feed = LandingFeed(str(root), "feed")
    every = [e.path for e in fs.list_files_recursive(spark, feed.path)]
    assert feed.latest_file(spark) == [max(every)] and max(every).endswith("/feed/20240102x")
    (root / "feed/20240102x").unlink()
    every = [e.path for e in fs.list_files_recursive(spark, feed.path)]
    assert feed.latest_file(spark) == [max(every)] and max(every).endswith("/feed/20240102/sub/z.json")
    assert LandingFeed(str(root), "missing").latest_file(spark) == []


def test_lineage_names_clash_in_any_case(spark, landing):
    from quayside.errors import ContractError
    from quayside.plans.history_ingest import history_frame
    for name in ("ingestion_date", "processing_time", "Source_Path", "INGESTION_DATE"):
        root = landing({"20240101/a.json": {"Data": [{"id": 1, name: "x"}]}}, dataset=name)
        with pytest.raises(ContractError, match="collide"):
            history_frame(spark, [f"{root}/{name}/20240101"])


def test_no_envelope_is_no_new_data_with_a_given_schema(spark, landing, tmp_path):
    from pyspark.sql.types import StructType

    from quayside.errors import Outcome
    from quayside.plans.history_ingest import ingest_history
    from quayside.sinks.history import HistoryTable
    root = landing({"20240101/a.json": {"Data": [{"id": 1}]}})
    history = HistoryTable(str(tmp_path / "h"))
    schema = StructType.fromDDL("Data array<struct<id:string>>")
    assert ingest_history(spark, LandingFeed(root, "feed"), history, "all", schema=schema).ok
    odd = landing({"20240101/a.json": {}, "20240101/b.json": '{"Data":[{"id":1'}, dataset="odd")
    for dates in ("all", "20240101"):
        run = ingest_history(spark, LandingFeed(odd, "odd"), history, dates, schema=schema)
        assert run.outcome is Outcome.NO_NEW_DATA and run.metrics["corrupt_documents"] == 1
    assert [r.id for r in history.read(spark).collect()] == ["1"]
    lost = landing({"notadate/a.json": {"Data": [{"id": 2}]}, "2024-01-01/a.json": {"Data": [{"id": 3}]}}, dataset="lost")
    assert ingest_history(spark, LandingFeed(lost, "lost"), history, "all", schema=schema).outcome is Outcome.NO_NEW_DATA
    assert [r.id for r in history.read(spark).collect()] == ["1"]


def test_no_task_reads_a_part_of_a_document(spark, landing):
    from quayside.session import session_conf
    from quayside.sources.json_feed import infer_envelope_schema, read_envelopes, unsplit_files
    root = landing({"20240101/a.json": {"Data": [{"id": i, "v": "x" * 200} for i in range(4000)]},
                    "20240101/b.json": {"Data": [{"id": -1, "v": "y"}]}})
    paths = [f"{root}/feed/20240101"]
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "64k"}):
        schema = infer_envelope_schema(spark, paths)
        assert read_envelopes(spark, paths, schema=schema).rdd.getNumPartitions() > 4
        with session_conf(spark, unsplit_files(spark, paths)):
            assert read_envelopes(spark, paths, schema=schema).rdd.getNumPartitions() <= 2
    assert unsplit_files(spark, [f"{root}/none"]) == {}


def test_many_folders_are_listed_by_spark_alone(spark, landing, monkeypatch):
    from quayside.session import session_conf
    from quayside.sources import fs
    from quayside.sources.json_feed import unsplit_files
    root = landing({f"202401{d:02d}/{f}.json": {"Data": [{"id": d, "v": "x" * 50 * d}]} for d in range(1, 41) for f in "ab"})
    feed = LandingFeed(root, "feed")
    paths = feed.date_folders(spark, "all")
    lengths = [e.length for p in paths for e in fs.list_dir(spark, p)]
    want = (80, sum(lengths), max(lengths))
    assert len(paths) == 40 and fs.sizes(spark, paths[:5]) == (10, sum(lengths[:10]), max(lengths[:10]))

    def no_call(*_):
        raise AssertionError("a folder was listed by the driver")

    with monkeypatch.context() as m:
        m.setattr(fs, "list_dir", no_call)
        m.setattr(fs, "list_files_recursive", no_call)
        assert fs.sizes(spark, paths) == fs.sizes(spark, [feed.path], recursive=True) == want
        table = feed.file_table(spark)
        assert "content" not in table._jdf.queryExecution().executedPlan().toString()
        assert table.count() == 80 and feed.files(spark) == sorted(f"{p}/{f}.json" if p.startswith("file:") else f"file:{p}/{f}.json"
                                                                   for p in paths for f in "ab")
        with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "1k"}):
            assert unsplit_files(spark, paths)["spark.sql.files.maxPartitionBytes"] == str(max(lengths) + 1)


def test_an_ingest_lists_its_folders_for_sizes_once(spark, landing, tmp_path, monkeypatch):
    from quayside.plans.history_ingest import ingest_history
    from quayside.sinks.history import HistoryTable
    from quayside.sources import fs
    root = landing({f"2024010{d}/a.json": {"Data": [{"id": d}]} for d in range(1, 4)})
    calls, sizes = [], fs.sizes
    monkeypatch.setattr(fs, "sizes", lambda *a: calls.append(1) or sizes(*a))
    assert ingest_history(spark, LandingFeed(root, "feed"), HistoryTable(str(tmp_path / "h")), "all").metrics["rows"] == 3
    assert len(calls) == 1
