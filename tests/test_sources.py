"""Namespaces, contract schemas, views, CSV round trip and fixtures."""

from lakeforge.contracts import SILVER
from lakeforge.sources import fixtures
from lakeforge.sources.catalog import create_layers, silver_schema
from lakeforge.sources.files import read_csv, write_csv
from lakeforge.sources.tables import register_views

from .conftest import SF_SMALL


def test_layers_and_schema(spark):
    dbs = create_layers(spark, ("bronze_t", "silver_t"))
    assert {"bronze_t", "silver_t"} <= set(dbs)
    dbs = create_layers(spark, ("bronze_t",), reset=True)
    assert "bronze_t" in dbs
    schema = silver_schema(spark, "address")
    assert schema.names[0] == "_tf_id" and schema.names[-1] == "_tf_update_date"
    assert len(schema.names) == 1 + len(SILVER["address"].columns) + 4


def test_views_and_csv_round_trip(spark, tmpdir_path):
    register_views(spark, SF_SMALL, ["region", "nation"])
    assert spark.sql("SELECT COUNT(*) FROM nation").first()[0] == 25
    src = fixtures.snapshot(spark, SF_SMALL, "address", 1)
    write_csv(src, tmpdir_path + "/a")
    back = read_csv(spark, tmpdir_path + "/a", src.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src.collect()))
    inferred = read_csv(spark, tmpdir_path + "/a")        # inferred types: one extra pass
    assert dict(inferred.dtypes)["AddressID"] == "int"


def test_fixture_ids_start_at_one_and_day2_rules(spark):
    d1 = fixtures.snapshot(spark, SF_SMALL, "address", 1)
    d2 = fixtures.snapshot(spark, SF_SMALL, "address", 2)
    assert d1.agg({"AddressID": "min"}).first()[0] == 1          # 0 is the unknown member
    ids2 = {r.AddressID for r in d2.select("AddressID").collect()}
    ids1 = {r.AddressID for r in d1.select("AddressID").collect()}
    kept = {i for i in ids1 if i % 17 != 0}
    assert ids2 == {i + max(ids1) if i % 19 == 5 else i for i in kept}  # re-keyed past every id
    changed = d2.filter("PostalCode = '12345'").count()
    assert changed == d1.filter("AddressID % 10 = 3 AND AddressID % 17 != 0").count()
