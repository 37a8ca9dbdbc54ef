import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lumenfield.sources import catalogue, store

ROWS = "year int, code string, v double, note string"
KEYS = ["year", "code"]


def table(spark, rows, schema=ROWS):
    return spark.createDataFrame(rows, schema)


def stored(spark, path):
    return sorted((r["year"], r["code"], r["v"], r["note"]) for r in spark.read.schema(ROWS).parquet(path).collect())


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("part-*.parquet")}


def actions(report):
    return {(r["year"], r["code"]): r["action"] for r in report.collect()}


def test_upsert_replaces_by_key_and_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(2012, "01", 1.0, None), (2012, "02", 2.0, "x"), (2013, "01", 3.0, None), (2014, "01", None, None)]
    assert set(actions(store.upsert(table(spark, first), path, KEYS, ["year"])).values()) == {"inserted"}
    before = files(path)
    more = [(2012, "02", 9.0, None), (2013, "01", 3.0, None), (2014, "01", None, None), (2015, "03", 5.0, "")]
    report = store.upsert(table(spark, more), path, KEYS, ["year"])
    assert actions(report) == {(2012, "02"): "replaced", (2013, "01"): "unchanged", (2014, "01"): "unchanged", (2015, "03"): "inserted"}
    assert stored(spark, path) == sorted([(2012, "01", 1.0, None), (2012, "02", 9.0, None), (2013, "01", 3.0, None), (2014, "01", None, None), (2015, "03", 5.0, "")], key=str)
    after = files(path)
    kept = {p for p in before if "year=2013" in p or "year=2014" in p}
    assert kept and all(after.get(p) == before[p] for p in kept)
    assert not {p for p in before if "year=2012" in p} & set(after)
    # a second run changes nothing at all
    assert set(actions(store.upsert(table(spark, more), path, KEYS, ["year"])).values()) == {"unchanged"}
    assert files(path) == after


def test_upsert_against_a_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MOST_PARTITIONS", 2)
    rng, path, want = random.Random(1), str(tmp_path / "t"), {}
    for _ in range(4):
        rows = [(rng.randrange(2010, 2016), rng.choice(["01", "02", None]), rng.choice([None, 1.0, 2.0]), rng.choice([None, "", "a"]), i) for i in range(12)]
        now = {(y, c): (v, n) for y, c, v, n, _ in rows}
        expected = {k: "inserted" if k not in want else "unchanged" if want[k] == v else "replaced" for k, v in now.items()}
        report = store.upsert(table(spark, rng.sample(rows, len(rows)), ROWS + ", seq int"), path, KEYS, ["year"], "seq")
        assert actions(report) == expected
        want |= now
        got = {(r["year"], r["code"]): (r["v"], r["note"]) for r in spark.read.schema(ROWS).parquet(path).collect()}
        assert got == want


def test_upsert_refuses_what_it_could_not_keep(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        store.upsert(table(spark, []), path, KEYS, ["note"])
    with pytest.raises(Exception, match="null or empty"):
        store.upsert(table(spark, [(None, "01", 1.0, None)]), path, KEYS, ["year"])
    assert store.upsert(table(spark, []), path, KEYS, ["year"]).count() == 0
    assert stored(spark, path) == []


def failing(df):
    return df.withColumn("v", F.when(F.col("v") > 0, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))


def read(spark, folder):
    return {n: sorted(tuple(r) for r in df.collect()) for n, df in store.in_use(spark, folder).items()}


def test_a_failing_table_leaves_the_published_set(spark, tmp_path):
    folder = str(tmp_path / "set")
    a, b = table(spark, [(2012, "01", 1.0, None)]), table(spark, [(2013, "02", 2.0, "n")])
    assert store.in_use(spark, folder) == {}
    first = store.publish({"a": a, "b": b}, folder)
    want = read(spark, folder)
    assert want == {"a": [(2012, "01", 1.0, None)], "b": [(2013, "02", 2.0, "n")]}
    with pytest.raises(FileExistsError):
        store.publish({"a": b}, folder)
    with pytest.raises(Exception, match="broken"):
        store.publish({"a": b, "b": failing(b)}, folder, overwrite=True)
    assert read(spark, folder) == want
    began = store.in_use(spark, folder)  # a reader of the old version
    second = store.publish({"a": b, "c": a.filter("false")}, folder, overwrite=True)
    assert read(spark, folder) == {"a": [(2013, "02", 2.0, "n")], "c": []}
    assert began["b"].count() == 1
    gone = store.forget(spark, folder)
    assert len(gone) == 1 and first not in gone and second not in gone
    third = store.publish({"a": store.in_use(spark, folder)["a"].withColumn("v", F.col("v") + 1)}, folder, overwrite=True)  # computed from what it replaces
    assert read(spark, folder) == {"a": [(2013, "02", 3.0, "n")]}
    assert store.forget(spark, folder) == [first] and {p.name for p in (tmp_path / "set" / "versions").iterdir()} == {second, third}
    with pytest.raises(ValueError):
        store.publish({}, folder)


def test_writer_replaces_only_whole_sets(spark, tmp_path):
    folder = str(tmp_path / "out")
    a, b = table(spark, [(2012, "01", 1.0, None)]), table(spark, [(2013, "02", 2.0, "n")])
    catalogue.write_tables({"a": a, "b": b}, folder)
    before = files(folder)
    with pytest.raises(Exception, match="broken"):
        catalogue.write_tables({"a": b, "b": failing(b)}, folder, overwrite=True)
    assert files(folder) == before
    with pytest.raises(FileExistsError):
        catalogue.write_tables({"new": a, "b": b}, folder)
    assert {p.name for p in Path(folder).iterdir()} == {"a", "b"}
    old = spark.read.parquet(f"{folder}/a")
    catalogue.write_tables({"a": old.withColumn("v", F.col("v") + 1), "b": a}, folder, overwrite=True)
    assert spark.read.parquet(f"{folder}/a").first()["v"] == 2.0 and spark.read.parquet(f"{folder}/b").first()["year"] == 2012
    assert {p.name for p in Path(folder).iterdir()} == {"a", "b"}
