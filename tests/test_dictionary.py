from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from meterlake.contracts import base_contracts, read_contracts
from meterlake.operators import coverage, dictionary
from meterlake.plans import job
from meterlake.plans.registry import FIELD_NAMES, dictionary_texts
from meterlake.sources.tables import Lake


def extract(spark, text, names):
    frame = spark.createDataFrame([("d", text, names)], "dataset string, text string, field_names array<string>")
    return dictionary.extract_dictionaries(frame).first()


def test_fields_in_order(spark):
    text = (
        "Data Dictionary – Trips Page 1 of 2 This data dictionary describes rides. As of 2024 more.\n"
        "Field  Name\n Description fee A fee, not fees or a_fee. \U0001f695 data dictionary - x PAGE 2 of 2 tip\tThe  tip"
    )
    row = extract(spark, text, ["fee", "tip"])
    assert row["status"] == "OK"
    assert row["dataset_description"] == "This data dictionary describes rides."
    assert [(f["name"], f["description"]) for f in row["fields"]] == [
        ("fee", "A fee, not fees or a_fee. \U0001f695"),
        ("tip", "The tip"),
    ]


def test_problems_are_statuses(spark):
    head = "This data dictionary describes x Field Name Description "
    assert extract(spark, head + "a one c three", ["a", "b", "c"])["status"] == "FIELD_NOT_FOUND"
    assert extract(spark, head + "a b two", ["a", "b"])["status"] == "EMPTY_DESCRIPTION"
    assert extract(spark, head + "b two a one", ["a", "b"])["status"] == "FIELD_NOT_FOUND"
    assert extract(spark, "This data dictionary describes x As of 2024 a one", ["a"])["status"] == "MARKER_NOT_FOUND"
    assert extract(spark, "Field Name Description a one", ["a"])["status"] == "DESCRIPTION_NOT_FOUND"


def test_against_a_plain_search(spark, sf_dir):
    """Positions found one after another over whole texts, as the definition says."""
    texts = dictionary_texts(spark, sf_dir)
    found = {r["doc_id"]: r["fields"] for r in dictionary.extract_dictionaries(texts).select("doc_id", "fields").collect()}
    for row in texts.select("doc_id", "text").collect():
        clean = re.sub(r"(?i)Data Dictionary\s*[–-].*?Page \d+ of \d+", " ", row["text"])
        clean = re.sub(r"\s+", " ", clean).strip()
        marker = re.search(r"Field Name\s+Description", clean)
        if not marker:
            assert {f["status"] for f in found[row["doc_id"]]} == {"MARKER_NOT_FOUND"}
            continue
        rest, spans, at = clean[marker.end() :].strip(), [], 0
        for name in FIELD_NAMES:
            hit = re.compile(rf"(?<!\w){name}(?!\w)").search(rest, at)
            if not hit:
                break
            spans.append(hit.span())
            at = hit.end()
        ends = [start for start, _ in spans[1:]] + [len(rest)]
        expected = [rest[end:stop].strip() for (_, end), stop in zip(spans, ends)]
        expected += [None] * (len(FIELD_NAMES) - len(spans))
        assert [f["description"] for f in found[row["doc_id"]]] == expected


def test_contracts_round_trip(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "landing"))
    folder = tmp_path / "landing" / "_metadata"
    folder.mkdir(parents=True)
    rows = []
    for contract in base_contracts().values():
        (folder / contract.source_file).write_bytes(contract.dataset.encode())
        if contract.dictionary_slug:
            fields = " ".join(f"{c.name} Meaning of the {i}th field." for i, c in enumerate(contract.columns))
            rows.append((contract.dataset, f"This data dictionary describes {contract.dataset}. Field Name Description {fields}"))
    texts = spark.createDataFrame(rows, "dataset string, text string")
    job.build_contracts(spark, lake, texts)
    contracts = read_contracts(spark, f"{lake.contracts_path}/*")
    assert contracts.keys() == base_contracts().keys()
    for dataset, base in base_contracts().items():
        built = contracts[dataset]
        assert [(c.name, c.logical_type) for c in built.columns] == [(c.name, c.logical_type) for c in base.columns]
        assert built.table == base.table and len(built.source_sha256) == 64
        assert all(c.description for c in built.columns)
    assert contracts["fhvhv"].governance_note
    metadata = contracts["yellow"].silver_schema()["vendor_id"].metadata
    assert metadata["comment"] == "Meaning of the 0th field."


def test_documents_hold_the_columns_in_order(spark):
    text = "This data dictionary describes x Field Name Description b two a one"
    frame = spark.createDataFrame(
        [("d", text, ["b", "a"], ["long", "string"])],
        "dataset string, text string, field_names array<string>, field_types array<string>",
    ).withColumns({n: F.lit(n) for n in ("table", "dictionary_slug", "source_file", "source_sha256")})
    frame = frame.withColumn("governance_note", F.lit(None).cast("string"))
    row = dictionary.build_contracts(dictionary.extract_dictionaries(frame)).first()
    document = json.loads(row["value"])
    assert list(document["columns"]) == ["b", "a"]
    assert document["columns"]["b"] == {"description": "two", "type": "long"}
    assert "governance_note" not in document


def test_coverage_statuses(spark):
    expected = spark.createDataFrame(
        [("yellow", "t", "yellow", "VendorID", "long", "d", None), ("yellow", "t", "yellow", "extra", "double", "e", None)],
        "dataset string, table_name string, dictionary_slug string, column_name string, expected_type string, "
        "description string, references string",
    )
    actual = spark.createDataFrame(
        [("yellow", "vendorid", "int"), ("yellow", "surprise", "string")], "dataset string, column_name string, actual_type string"
    )
    rows = {r["column_name"]: r for r in coverage.contract_coverage(expected, actual).collect()}
    assert {n: r["status"] for n, r in rows.items()} == {
        "vendorid": "DOCUMENTED",
        "extra": "MISSING_IN_SOURCE",
        "surprise": "UNDOCUMENTED",
    }
    assert rows["surprise"]["dictionary_slug"] == "yellow" and rows["surprise"]["expected_type"] is None


def test_held_fields_follow_the_rows(spark):
    schema = "VendorID long, fee double, note string, _rescued_data string"
    rows = [(1, None, None, '{"k": 1, "Note": "x", "f": 1.5}'), (2, None, None, '{"k": "a", "f": 2, "gone": null}'), (None, None, None, "no json"), (3, None, "n", "[1]")]

    def held(some):
        found = coverage.held_fields(spark.createDataFrame(some, schema), "yellow").collect()
        return {r["column_name"]: (r["actual_type"], r["held_rows"]) for r in found}

    assert held(rows) == {"VendorID": ("long", 3), "note": ("string", 2), "k": ("long|string", 2), "f": ("double|long", 2)}
    assert held([*rows, (None, 0.5, None, None)])["fee"] == ("double", 1)
    assert held(rows[2:3]) == {} and held([]) == {}
