"""The whole way from delimited files to enriched JSON lines, with restarts."""

import json
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.plans.convergence import (
    document_store,
    message_files,
    publish,
    start_converging,
    start_indexing,
)
from millrace.schemas import RECORD_FIELDS, SCHEMAS, health_registry
from millrace.sinks.lookup import load_lookup
from millrace.sources.delimited import good_rows, read_delimited
from millrace.functions.jsonio import typed_value
from millrace.streaming import expired_keys

N = 12
FILES = {
    "billing_cost": ("patientID\ttotalCost", lambda i: f"{i % 5}\t{100 + i}"),
    "insurance_details": (
        "providerName\topened\treason\tdisposition\tconclusion\tamountPayed\tinsuranceDate",
        lambda i: f"prov{i}\t07-14-2015\tr\t\tc\t{i}\t01-02-2016",
    ),
    "medicine_orders": (
        "medName\tdosageForm\tlabelerName\tsubstanceName\tmedDesc\tmedPrice",
        lambda i: f'med"{i}\tpill\tl\ts\td\t{i}' if i != 3 else "med\tpill",
    ),
    "treatment": ("icd\ttreatmentDesc\tvisitDate", lambda i: f"icd{i}\tdesc\t12-31-2014"),
}


@pytest.fixture
def published(spark, tmp_path):
    paths = {}
    for source, (header, line) in FILES.items():
        path = tmp_path / f"{source}.txt"
        path.write_bytes("\r\n".join([header, *[line(i) for i in range(N)]]).encode())
        paths[source] = str(path)
    patients = tmp_path / "patients.txt"
    header = "patientID\tpatientname\tage\tstreetAddress\tcity\temail\tnumber"
    rows = [f"{i}\tname{i}\t{20 + i}\tstreet #{i}\tcity\ta@b.c\t022-{i}" for i in range(4)]
    patients.write_bytes("\r\n".join([header, *rows]).encode())
    counts = publish(spark, paths, str(tmp_path / "out"))
    return tmp_path, {r["source"]: (r["good"], r["malformed"]) for r in counts.collect()}


def _lookup(spark, tmp_path):
    raw = good_rows(read_delimited(spark, str(tmp_path / "patients.txt")))
    typed = raw.select(
        *[typed_value(F.col(f.name), f.dataType, "MM-dd-yyyy").alias(f.name) for f in SCHEMAS["patient_info"]]
    )
    return load_lookup(typed, str(tmp_path / "lookup"), "patientID")


def _converge(spark, tmp_path):
    query = start_converging(
        spark,
        str(tmp_path / "store"),
        health_registry(),
        _lookup(spark, tmp_path),
        RECORD_FIELDS,
        str(tmp_path / "enriched"),
        str(tmp_path / "cp-converge"),
        once=True,
    )
    query.awaitTermination()
    return [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "enriched/records")).collect()]


def test_files_to_records(spark, published):
    tmp_path, counts = published
    assert counts == {s: (N, 0) if s != "medicine_orders" else (N - 1, 1) for s in FILES}
    out, store = str(tmp_path / "out"), str(tmp_path / "store")

    def index():
        stream = message_files(spark, out, maxFilesPerTrigger="1")
        start_indexing(stream, store, str(tmp_path / "cp-index"), once=True).awaitTermination()

    index()
    assert document_store(store).documents(spark).count() == 4 * N - 1
    found = _converge(spark, tmp_path)
    # The malformed line used up its key, which stays incomplete.
    assert len(found) == N - 1
    assert len({r["pcn"] for r in found}) == N - 1
    for r in found:
        assert set(r) <= {"pcn", *RECORD_FIELDS.values()}
        assert all("pcn" not in part for part in r.values() if isinstance(part, dict))
        assert r["treatment"]["visitDate"] == "12-31-2014"  # as it came
        assert r["insuranceDetails"]["disposition"] == ""
        assert r["medicineOrders"]["medName"].startswith('med"')
        patient = r["billingCost"]["patientID"]
        if patient == "4":
            assert "patientInfo" not in r  # no such patient: the record is emitted all the same
        else:
            assert r["patientInfo"]["patientname"] == f"name{patient}"
            assert isinstance(r["patientInfo"]["age"], int)

    # A restart with nothing new changes nothing; a redelivered file stores a newer version only.
    index()
    again = spark.read.text(f"{out}/messages/source=billing_cost")
    again.write.mode("append").text(f"{out}/messages/source=billing_cost")
    index()
    assert document_store(store).current(spark).count() == 4 * N - 1
    assert document_store(store).documents(spark).count() == 5 * N - 1
    assert len(_converge(spark, tmp_path)) == N - 1


def test_row_budget(spark, tmp_path):
    lines = ["a\tb", "1\tx", "bad", "2\ty", "3\tz"]
    (tmp_path / "f.txt").write_text("\n".join(lines))
    counts = publish(spark, {"s": str(tmp_path / "f.txt")}, str(tmp_path / "out"), rows=3).collect()
    assert [(r["good"], r["malformed"]) for r in counts] == [(2, 1)]
    values = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out/messages")).collect()]
    assert sorted(v["a"] for v in values) == ["1", "2"]
    assert all(0 <= int(v["pcn"]) < 3 for v in values)


def test_the_same_by_command(spark, tmp_path):
    from millrace.__main__ import main

    (tmp_path / "b.txt").write_text("patientID\ttotalCost\n" + "\n".join(f"p{i}\t{i}" for i in range(5)))
    (tmp_path / "t.txt").write_text("icd\ttreatmentDesc\tvisitDate\n" + "\n".join(f"i{i}\td\t2014/12/3{i % 2}" for i in range(5)))
    header = "patientID\tpatientname\tage\tstreetAddress\tcity\temail\tnumber\n"
    (tmp_path / "p.txt").write_text(header + "\n".join(f"p{i}\tn{i}\t{i}\ts\tc\te\t1" for i in range(5)))
    at = lambda name: str(tmp_path / name)
    main(["lookup", "--file", at("p.txt"), "--schema", "patient_info", "--key", "patientID", "--out", at("lookup")])
    main(["publish", "--source", f"billing_cost={at('b.txt')}", "--source", f"care={at('t.txt')}", "--out", at("out")])
    main(["index", "--messages", at("out"), "--store", at("store"), "--checkpoint", at("cp1"), "--once"])
    main(
        ["converge", "--store", at("store"), "--lookup", at("lookup"), "--out", at("enriched"), "--checkpoint", at("cp2")]
        + ["--registry", "billing_cost|billing_cost~care|treatment", "--date-format", "yyyy/MM/dd", "--once"]
    )
    found = [json.loads(r["value"]) for r in spark.read.text(at("enriched/records")).collect()]
    assert sorted(r["pcn"] for r in found) == ["0", "1", "2", "3", "4"]
    main(["maintain", "--store", at("store"), "--older-than", "0"])
    assert document_store(at("store")).current(spark).count() == 10 and document_store(at("store")).documents(spark).count() == 0
    for r in found:
        assert r["patientInfo"]["patientname"][1:] == r["billingCost"]["patientID"][1:]
        assert r["care"]["visitDate"] in ("2014/12/30", "2014/12/31")


def test_keys_that_wait_too_long_are_reported(spark, published):
    """The key of the malformed line expires, with what it misses; commit times move the clock."""
    tmp_path, _ = published
    out, store, enriched = str(tmp_path / "out"), str(tmp_path / "store"), str(tmp_path / "enriched")

    def run():
        start_indexing(message_files(spark, out, maxFilesPerTrigger="1"), store, str(tmp_path / "cp-index"), once=True, refresh_every=2).awaitTermination()
        start_converging(
            spark, store, health_registry(), _lookup(spark, tmp_path), RECORD_FIELDS, enriched, str(tmp_path / "cp"), once=True,
            wait="2 seconds", delay="0 seconds",
        ).awaitTermination()

    run()
    time.sleep(3)
    for i in range(2):
        later = json.dumps({"pcn": f"later{i}", "totalCost": "1"})
        spark.createDataFrame([(later,)], "value STRING").write.mode("append").text(f"{out}/messages/source=billing_cost")
        run()
    found = [json.loads(r["value"]) for r in spark.read.text(f"{enriched}/records").collect()]
    assert len(found) == N - 1
    lost = {r["missing"] for r in expired_keys(spark, enriched).where("key NOT LIKE 'later%'").collect()}
    assert lost == {"medicine_orders"}


def test_jobs_start_in_any_order(spark, published):
    """The converging job may come first; it finds nothing and later goes on."""
    tmp_path, _ = published
    with pytest.raises(AnalysisException):  # no record was written
        _converge(spark, tmp_path)
    stream = message_files(spark, str(tmp_path / "out"))
    start_indexing(stream, str(tmp_path / "store"), str(tmp_path / "cp-index"), once=True).awaitTermination()
    assert len(_converge(spark, tmp_path)) == N - 1


def test_files_with_keys_of_their_own(spark, tmp_path):
    (tmp_path / "b.txt").write_text("pcn\tpatientID\ttotalCost\nP-900\tp1\t5\nP-901\tp2\t6\n")
    with pytest.raises(ValueError, match="pcn"):
        publish(spark, {"billing": str(tmp_path / "b.txt")}, str(tmp_path / "out"))
    publish(spark, {"billing": str(tmp_path / "b.txt")}, str(tmp_path / "out"), key="pcn")
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out/messages")).select("value").collect()]
    assert sorted(r["pcn"] for r in lines) == ["P-900", "P-901"] and set(lines[0]) == {"pcn", "patientID", "totalCost"}
    with pytest.raises(ValueError, match="no column"):
        publish(spark, {"billing": str(tmp_path / "b.txt")}, str(tmp_path / "out"), key="id")


def test_a_reloaded_lookup_shows_in_the_next_batch(spark, published):
    tmp_path, _ = published
    path, out, store = str(tmp_path / "names"), str(tmp_path / "out"), str(tmp_path / "store")
    spec = "patientID STRING, patientname STRING"

    def converge():
        query = start_converging(
            spark, store, health_registry(), path, RECORD_FIELDS, str(tmp_path / "enriched"), str(tmp_path / "cp"), once=True
        )
        query.awaitTermination()
        found = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "enriched/records")).collect()]
        return {r["pcn"]: r["patientInfo"]["patientname"] for r in found if "patientInfo" in r}

    load_lookup(spark.createDataFrame([(str(i), "old") for i in range(5)], spec), path, "patientID")
    start_indexing(message_files(spark, out), store, str(tmp_path / "cp-index"), once=True).awaitTermination()
    first = converge()
    assert set(first.values()) == {"old"}
    for name in ("new", "newer"):
        table = load_lookup(spark.createDataFrame([(str(i), name) for i in range(5)], spec), path, "patientID")
    assert table.count() == 5
    more = [json.dumps({f.name: "1" for f in health_registry()[s].schema.fields} | {"pcn": "later"}) for s in FILES]
    for source, line in zip(FILES, more):
        spark.createDataFrame([(line,)], "value STRING").write.mode("append").text(f"{out}/messages/source={source}")
    start_indexing(message_files(spark, out), store, str(tmp_path / "cp-index"), once=True).awaitTermination()
    second = converge()
    assert second == first | {"later": "newer"}


def test_made_up_keys_do_not_depend_on_splits_or_folders(spark, tmp_path):
    text = "\n".join(["x\ty", *[f"{i % 7}\tsame" for i in range(400)]])
    keys = []
    for label, split in (("one", "128m"), ("two", "300")):
        (tmp_path / label).mkdir()
        (tmp_path / label / "in.txt").write_text(text)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            publish(spark, {"s": str(tmp_path / label / "in.txt")}, str(tmp_path / label / "out"))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        keys.append(sorted(r["value"] for r in spark.read.text(str(tmp_path / label / "out/messages")).collect()))
    assert keys[0] == keys[1] and len(set(keys[0])) == 400


def test_the_later_line_of_a_file_wins_and_unknown_sources_are_refused(spark, tmp_path):
    for source, cost in (("billing_cost", (9, 10)), ("other", (1, 2))):
        folder = tmp_path / "out" / "messages" / f"source={source}"
        folder.mkdir(parents=True)
        lines = [json.dumps({"pcn": "k", "totalCost": str(c)}) for c in cost]
        (folder / "part-0.txt").write_text("\n".join(lines))
    root = str(tmp_path / "store")
    start_indexing(
        message_files(spark, str(tmp_path / "out")), root, str(tmp_path / "cp"), once=True, sources=["billing_cost"]
    ).awaitTermination()
    assert [json.loads(r["value"])["totalCost"] for r in document_store(root).current(spark).collect()] == ["10"]
    assert {(r["source"], r["error"]) for r in document_store(root).rejected(spark).collect()} == {("other", "unknown source")}
