import datetime as dt
import json

import pytest

from costlens import schemas
from costlens.operators.pricing import UnknownRegionError
from costlens.sources.publish import published
from costlens.plans.price_snapshot import price_snapshot, read_snapshot, snapshot_label, write_prices
from costlens.sources.pricelist import read_price_documents_text
from costlens.sources.tables import read_prices

EAST = "US East (N. Virginia)"


def doc(instance, on_demand=None, tenancy="Shared", location=EAST, service=None):
    d = {
        "product": {
            "attributes": {
                "instanceType": instance, "location": location, "operatingSystem": "Linux",
                "preInstalledSw": "NA", "capacitystatus": "Used", "tenancy": tenancy,
            }
        },
        "terms": {},
    }
    if on_demand is not None:
        d["terms"]["OnDemand"] = on_demand
    if service is not None:
        d["serviceCode"] = service
    return json.dumps(d)


def term(*dims):
    return {"priceDimensions": dict(dims)}


def dim(key, unit, prices):
    return key, {"unit": unit, "pricePerUnit": prices}


DOCS = [
    doc("a.large"),  # no on-demand terms
    doc("a.large", {"T": term(dim("D", "Hrs", {"USD": "0.5"}))}),
    doc("b.large", {"T": term(dim("D1", "Quantity", {"USD": "9"}), dim("D2", "Hrs", {"USD": "0.7"}))}),
    doc("c.large", {"T1": term(dim("D", "Hrs", {"CNY": "3"})), "T2": term(dim("D", "Hrs", {"USD": "1.25"}))}),
    doc("d.large", {"T": term(dim("Z", "Hrs", {"USD": "2.0"}), dim("A", "Hrs", {"USD": "3.0"}))}),
    doc("e.large", {"T": term(dim("D", "Hrs", {"USD": "0.0000000000"}))}),
    doc("f.large", {"T": term(dim("D", "Hrs", {"USD": "5.0"}))}, tenancy="Dedicated"),
    doc("f.large", {"T": term(dim("D", "Hrs", {"USD": "6.0"}))}),
    doc("g.large", {"T": term(dim("D", "Hrs", {"USD": "7.0"}))}, location="US West (Oregon)"),
    doc("h.large", {"T": term(dim("D", "Hrs", {"USD": "8.0"}))}, service="AmazonRDS"),
    doc("b.large", {"T": term(dim("D", "Hrs", {"USD": "9.9"}))}, service="AmazonEC2"),
]
EXPECTED_EAST = {
    "a.large": 0.5, "b.large": 0.7, "c.large": 1.25, "d.large": 2.0, "e.large": 0.0,
    "f.large": 6.0, "g.large": None, "h.large": None,
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "doc_pos long, doc string")


@pytest.fixture(scope="module")
def wanted(spark):
    return spark.createDataFrame([(k,) for k in EXPECTED_EAST], "instance_type string")


def test_first_hourly_price_per_type(spark, docs, wanted):
    got = {r.instance_type: r.price_per_hour for r in price_snapshot(docs, wanted, "us-east-1").collect()}
    assert got == EXPECTED_EAST


def test_other_region(spark, docs, wanted):
    got = {r.instance_type: r.price_per_hour for r in price_snapshot(docs, wanted, "us-west-2").collect()}
    assert got == {k: (7.0 if k == "g.large" else None) for k in EXPECTED_EAST}


def test_unknown_region_raises(spark, docs, wanted):
    with pytest.raises(UnknownRegionError):
        price_snapshot(docs, wanted, "eu-north-9")


def test_text_documents_follow_file_then_line_order(spark, tmp_path, wanted):
    (tmp_path / "p1.jsonl").write_text("\n".join(DOCS[:5]) + "\n")
    (tmp_path / "p2.jsonl").write_text("\n".join(DOCS[5:]) + "\n")
    docs = read_price_documents_text(spark, str(tmp_path))
    got = {r.instance_type: r.price_per_hour for r in price_snapshot(docs, wanted, "us-east-1").collect()}
    assert got == EXPECTED_EAST


def test_write_and_read_snapshot(spark, tmp_path, docs, wanted):
    snap = price_snapshot(docs, wanted, "us-east-1")
    path = write_prices(snap, str(tmp_path), dt.date(2026, 5, 17))
    assert path.endswith("/2026-05-pricing.json")
    assert snapshot_label(dt.date(2026, 4, 1)) == "2026-04"
    back = {r.instance_type: r.price_per_hour for r in read_snapshot(spark, path).collect()}
    assert back == EXPECTED_EAST


def test_read_prices_one_line_array(spark, tmp_path):
    # FIXED VALUES: the published on-demand snapshot (USD per hour).
    arr = [
        {"instance_type": "g4dn.xlarge", "price_per_hour": 0.526},
        {"instance_type": "g5.xlarge", "price_per_hour": 1.006},
        {"instance_type": "g6e.xlarge", "price_per_hour": 1.861},
    ]
    p = tmp_path / "2026-04-pricing.json"
    p.write_text(json.dumps(arr))
    got = sorted((r.instance_type, r.price_per_hour) for r in read_prices(spark, str(p)).collect())
    assert got == [(a["instance_type"], a["price_per_hour"]) for a in arr]


def test_parquet_documents(spark, tmp_path, docs, wanted):
    from costlens.sources.pricelist import read_price_documents

    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    back = read_price_documents(spark, path)
    got = {r.instance_type: r.price_per_hour for r in price_snapshot(back, wanted, "us-east-1").collect()}
    assert got == EXPECTED_EAST


def test_only_the_chosen_price_is_cast(spark):
    from costlens.operators.pricing import first_hourly_price

    rows = [("a", 1, 0, 0, "0.5"), ("a", 2, 0, 0, "n/a"), ("b", 3, 0, 1, "0.7")]
    prices = spark.createDataFrame(rows, "instance_type string, doc_pos int, term_pos int, dim_pos int, price_text string")
    assert sorted(map(tuple, first_hourly_price(prices).collect())) == [("a", 0.5), ("b", 0.7)]


def test_a_type_without_a_price_is_written_as_null(spark, tmp_path):
    snap = spark.createDataFrame([("x", None)], schemas.PRICES)
    path = write_prices(snap, str(tmp_path), dt.date(2026, 4, 1))
    assert [json.loads(line) for r in spark.read.text(published(spark, path)).collect() for line in [r.value]] == [
        {"instance_type": "x", "price_per_hour": None}
    ]


def test_unreadable_documents_fail_or_are_listed(spark):
    from costlens.operators.pricing import parse_price_list, rejected_documents

    rows = [(1, DOCS[0]), (2, "{broken"), (3, "not json"), (4, '{"product": 5}'), (5, "")]
    docs = spark.createDataFrame(rows, "doc_pos int, doc string")
    with pytest.raises(Exception, match="unreadable price document"):
        parse_price_list(docs).collect()
    assert [r.doc_pos for r in parse_price_list(docs, "reject").collect()] == [1]
    assert sorted(r.doc_pos for r in rejected_documents(docs).collect()) == [2, 3, 4, 5]
