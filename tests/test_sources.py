"""Readers, payload shapes, ingest and writers."""

import json

import pytest
from pyspark.sql import functions as F

from commentlens.sources import envelopes, landed, readers, writers


def test_payload_shapes(spark):
    payloads = [
        [{"comment": "a"}, {"comment": " b "}],
        {"data": [{"attributes": {"comment": "c"}}, [{"text": "d"}]]},
        {"comments": [{"body": "e"}], "data": "x"},
        {"content": "f", "comment": 5},
        " bare ",
        [[[[[[{"data": [{"comment": "deep"}, None]}]]]]]],
        {"data": []},
        {"attributes": {"comment": "  ", "commentText": "g"}},
        None,
    ]
    rows = [(i, json.dumps(p)) for i, p in enumerate(payloads)] + [(99, "not json {")]
    records = envelopes.json_records(spark.createDataFrame(rows, "i int, raw string"), "raw")
    found = {}
    for r in records.select("i", "record_pos", envelopes.json_text("record").alias("t")).orderBy("i", "record_pos").collect():
        found.setdefault(r["i"], []).append(r["t"])
    assert found == {
        0: ["a", "b"], 1: ["c", "d"], 2: ["e"], 3: ["f"], 4: [" bare "], 5: ["deep"], 7: ["g"], 99: [None],
    }


def test_csv_without_known_columns(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('﻿Body,Class\n"two\nlines, ""quoted""",Positive\nNA,Neutral\n"  ",Negative\n', encoding="utf-8")
    df = readers.resolve_columns(readers.read_comments(spark, str(path), multiline=True))
    rows = [tuple(r) for r in df.select("comment", "label").collect()]
    assert rows == [('two\nlines, "quoted"', "Positive"), (None, "Neutral"), ("  ", "Negative")]
    assert [r[0] for r in readers.load_valid_texts(spark, str(path), multiline=True).collect()] == ['two\nlines, "quoted"', "NA"]
    with pytest.raises(ValueError):
        readers.load_valid_texts(spark, str(path), "missing")
    with pytest.raises(ValueError):
        readers.load_valid_texts(spark, str(tmp_path / "in.xml"))


def test_json_files_in_one_piece(spark, tmp_path):
    path = tmp_path / "batch.json"
    path.write_text(json.dumps([{"id": "a", "attributes": {"comment": " x "}}, {"id": "b", "text": "y"}], indent=2))
    assert [r[0] for r in readers.load_valid_texts(spark, str(path), whole_files=True).collect()] == ["x", "y"]
    rows = readers.read_comments(spark, str(path), "id string, text string", whole_files=True).collect()
    assert [tuple(r) for r in rows] == [("a", None), ("b", "y")]


def test_indented_and_broken_json(spark, tmp_path):
    path = tmp_path / "list.json"
    path.write_text(json.dumps([{"id": "a", "attributes": {"comment": " x "}}, {"id": "b", "text": "y"}], indent=2))
    assert [r[0] for r in readers.load_valid_texts(spark, str(path)).collect()] == ["x", "y"]
    with pytest.raises(Exception, match="malformed JSON payload"):
        readers.load_valid_texts(spark, str(path), whole_files=False).collect()
    lines = tmp_path / "lines.json"
    lines.write_text('{"text": "a"}\n{"text": "b"} trailing\n"c"\n')
    with pytest.raises(Exception, match="malformed JSON payload"):
        readers.load_valid_texts(spark, str(lines)).collect()
    assert [r[0] for r in readers.load_valid_texts(spark, str(lines), skip_malformed=True).collect()] == ["a", "c"]
    assert envelopes.malformed_payloads(spark.read.text(str(lines)), "value").count() == 1


def test_two_columns_for_one_alias(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`text` int, ` TEXT ` int, label int")
    with pytest.raises(ValueError, match="all stand for 'text'"):
        readers.resolve_columns(df)


def test_column_resolution(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Content` int, ` TEXT ` int, Sentiment int")
    assert readers.resolve_columns(df).columns == ["Content", "comment", "label"]
    assert readers.resolve_text_column(df, "Sentiment") == "Sentiment"
    with pytest.raises(ValueError, match="Content"):
        readers.resolve_columns(df.drop("Sentiment"))


def test_prior_output_and_candidates(spark, tmp_path):
    missing = readers.load_prior_output(spark, str(tmp_path / "none.csv"))
    assert missing.columns == ["comment", "label"] and missing.isEmpty()
    writers.write_table(spark.createDataFrame([("x", "Positive")], "comment string, label string"), str(tmp_path / "b.csv"))
    assert readers.load_prior_output(spark, str(tmp_path / "b.csv")).collect() == [("x", "Positive")]
    assert readers.first_existing_path(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).endswith("b.csv")
    assert readers.first_existing_path(spark, ["/nowhere/a.csv"], str(tmp_path)).endswith("b.csv")
    assert readers.first_existing_path(spark, ["/nowhere/a.csv"]) is None


def test_context_files(spark, tmp_path):
    (tmp_path / "lending.txt").write_text("## Lending act\nbody", encoding="utf-8")
    (tmp_path / "empty.txt").write_text("\nbody", encoding="utf-8")
    (tmp_path / "skip.md").write_text("no", encoding="utf-8")
    rows = readers.context_docs(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r["id"], r["title"]) for r in rows] == [("empty", "empty"), ("lending", "Lending act")]
    assert rows[1]["text"] == "## Lending act\nbody"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, " a\n\"b\" ", "train"), (2, "c", "test")], "id int, comment string, split string")
    with pytest.raises(ValueError):
        writers.write_table(df, str(tmp_path / "x.csv"), source=str(tmp_path / "x.csv"))
    with pytest.raises(ValueError):
        writers.write_table(df, str(tmp_path / "x.xml"))
    writers.write_table(df, str(tmp_path / "x.csv"))
    assert readers.read_comments(spark, str(tmp_path / "x.csv"), multiline=True).orderBy("id").first()["comment"] == " a\n\"b\" "
    writers.write_splits(df, str(tmp_path / "splits"))
    assert not (tmp_path / "splits" / "split=val").exists()
    assert spark.read.parquet(str(tmp_path / "splits")).count() == 2


def test_ingest_keeps_first_sighting(spark):
    rows = [(1, 0, "a", 1), (1, 1, "b", 1), (2, 0, "a", 2), (2, 1, "c", 1), (2, 2, None, 1)]
    pages = spark.createDataFrame(rows, "page int, pos int, id string, v int")
    got = landed.landed_pages_ingest(pages, "id", ["page", "pos"]).orderBy("page", "pos").collect()
    assert [(r["id"], r["v"]) for r in got] == [("a", 1), ("b", 1), ("c", 1)]
    assert [r["id"] for r in landed.landed_pages_ingest(pages, "id", ["page", "pos"], 2).collect()] == ["a", "b"]


def test_details_win_over_headers(spark):
    schema = "id string, comment string, agencyId string"
    headers = spark.createDataFrame([("a", None, "X"), ("b", None, "Y")], schema)
    details = spark.createDataFrame([("a", "text", None)], schema)
    got = landed.detail_or_header(headers, details, "id")
    assert sorted(tuple(r) for r in got.collect()) == [("a", "text", None, True), ("b", None, "Y", False)]
    assert tuple(landed.text_body_count(got).first()) == (2, 1)


def test_filters_apply_only_when_given(spark):
    rows = [("1", "Tax rule", "A", "D", "2024-01-05T00:00:00Z"), ("2", "other", "B", "D", "2024-02-01T00:00:00Z")]
    df = spark.createDataFrame(rows, "id string, comment string, agencyId string, docketId string, postedDate string")
    assert landed.source_filter(df).count() == 2
    assert landed.source_filter(df, term="TAX").first()["id"] == "1"
    assert landed.source_filter(df, posted_from="2024-01-05", posted_to="2024-01-31").count() == 1
    pushed = landed.source_filter(df, agency="B", docket="D").filter(F.col("id") == "2")
    assert pushed.count() == 1


def test_envelopes_of_any_depth_keep_their_spelling(spark):
    """Ten levels of lists and objects, beside shallow payloads; numbers stay as they were written."""
    record = '{"id": 1.50, "n": 12345678901234567890, "tags": ["a", ["b"]]}'
    payload = f"[{record}, null]"
    for level in range(10):
        payload = [f'[{{"data": {payload}}}]', f"[{payload}]", f'[{{"comments": {payload}, "x": [1]}}]'][level % 3]
    rows = [(1, payload), (2, record), (3, f"[{record}, [[{record}], []]]"), (4, "[]"), (5, "no json ["), (6, None)]
    df = spark.createDataFrame(rows, "k int, p string")
    found = envelopes.json_records(df, "p").select("k", "record_pos", F.to_json("record").alias("r")).orderBy("k", "record_pos").collect()
    flat = spark.createDataFrame([(record,)], "p string").select(F.to_json(F.parse_json("p")).alias("r")).first()["r"]
    assert [tuple(r) for r in found] == [(1, 0, flat), (2, 0, flat), (3, 0, flat), (3, 1, flat), (5, 0, None), (6, 0, None)]
    assert "1.5" in flat and "12345678901234567890" in flat
    plan = envelopes.json_records(df, "p")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
