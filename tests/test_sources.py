"""Files, queries, runs and streams."""

import random

import pytest

from lapsekit.operators.sampling import sample_fraction
from lapsekit.plans.runner import RunError, run_datasets
from lapsekit.session import shared_folder
from lapsekit.sources import dbapi
from lapsekit.sources.files import newest_path, read_csv, read_table, read_typed_or_raw, write_table
from lapsekit.sources.quoted import ends_quoted, read_quoted_csv
from lapsekit.sources.sql import bind, jdbc_options
from lapsekit.streaming.rowlocal import clean_stream, write_stream
from tests import scripted_driver


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def test_csv_text_is_kept(spark, tmp_path):
    place = tmp_path / "a.csv"
    place.write_text('zip;note\n014;"say ""hi"""\nNA;"two\nlines"\n7;NULL\n;x\n')
    got = [tuple(r) for r in read_csv(spark, str(place), sep=";").collect()]
    assert got == [("014", 'say "hi"'), (None, "two\nlines"), ("7", None), (None, "x")]


@pytest.fixture
def tiny_ranges(spark):
    """Files are cut every 700 bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def quoted_field(rng):
    kind, text = rng.random(), "".join(rng.choice('abc ,\n"é\t;') for _ in range(rng.randrange(30)))
    if kind < 0.4:
        return '"' + text.replace('"', '""') + '"'
    if kind < 0.5:
        return '"' + "x\n" * rng.randrange(700) + '"'
    return "".join(rng.choice('ab" c') for _ in range(rng.randrange(1, 6))).lstrip('"') or "z"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_byte_ranges_read_like_one_task(spark, tmp_path, tiny_ranges, seed):
    rng = random.Random(seed)
    for name in ("a.csv", "b.csv"):
        with open(tmp_path / name, "w", newline="") as file:
            file.write("\ufeffn,x,y\n" if seed == 2 else "n,x,y\n")
            for i in range(400):
                file.write(",".join([str(i), quoted_field(rng), quoted_field(rng)]) + rng.choice(["\n", "\n\n"]))
    whole = spark.read.option("quote", '"').option("escape", '"').option("multiLine", True).option("header", True)
    want = sorted(map(tuple, whole.option("lineSep", "\n").csv(str(tmp_path)).collect()), key=repr)
    found = read_quoted_csv(spark, str(tmp_path), ["n", "x", "y"])
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() >= 16
    assert sorted(map(tuple, found.collect()), key=repr) == want


def test_carriage_returns_short_rows_and_empty_files(spark, tmp_path, tiny_ranges):
    (tmp_path / "a.csv").write_bytes(b'a,b\r\n1,"x\ny"\r\n\r\n2\r\n3,z,more\r\n')
    (tmp_path / "b.csv").write_bytes(b"")
    (tmp_path / "c.csv").write_bytes(b"a,b\r\n")
    got = sorted(map(tuple, read_quoted_csv(spark, str(tmp_path), ["a", "b"]).collect()))
    assert got == [("1", "x\ny"), ("2", None), ("3", "z")]


def test_a_quote_opens_a_field_only_at_its_start():
    assert not ends_quoted('5" pipe,a"b', False, ",")
    assert ends_quoted('x,"a""', False, ",") and not ends_quoted('x,"a"""', False, ",")
    assert not ends_quoted('a",b', True, ",") and ends_quoted('a","b', True, ",")


def test_newest_is_the_last_name(spark, folder):
    for name in ("t_2024.parquet", "t_2025.parquet", "t_2023.parquet"):
        write_table(spark.createDataFrame([(name,)], "n string"), f"{folder}/{name}")
    assert newest_path(spark, f"{folder}/t_*.parquet").endswith("t_2025.parquet")
    with pytest.raises(FileNotFoundError):
        newest_path(spark, f"{folder}/none_*.parquet")


def test_strict_ending_and_self_overwrite(spark, folder):
    with pytest.raises(ValueError):
        read_table(spark, f"{folder}/x.xlsx", strict=True)
    place = f"{folder}/x.parquet"
    write_table(spark.range(3), place)
    with pytest.raises(ValueError, match="being read"):
        write_table(read_table(spark, place).filter("id > 0"), place)
    assert read_table(spark, place).count() == 3


def test_typed_copy_is_preferred(spark, folder):
    write_table(spark.range(3), f"{folder}/raw.parquet")
    spec = {"path": f"{folder}/raw.parquet", "cast": {"output": f"{folder}/typed.parquet"}}
    assert read_typed_or_raw(spark, spec).count() == 3
    write_table(spark.range(2), f"{folder}/typed.parquet")
    assert read_typed_or_raw(spark, spec).count() == 2


def test_parameters_become_literals(monkeypatch):
    text = bind("SELECT ':no', x::int FROM t WHERE a = :a AND b < :b", {"a": "it's", "b": 3})
    assert text == "SELECT ':no', x::int FROM t WHERE a = 'it''s' AND b < 3"
    with pytest.raises(KeyError):
        bind("SELECT :missing", {})
    monkeypatch.setenv("SHOP_URL", "jdbc:x:y")
    assert jdbc_options("SELECT 1;", "SHOP_URL") == {"url": "jdbc:x:y", "query": "SELECT 1"}
    split = jdbc_options("SELECT 1", "SHOP_URL", split={"column": "id", "lower": 0, "upper": 9, "parts": 3})
    assert split["numPartitions"] == "3" and split["dbtable"] == "(SELECT 1) q"


def test_sample_is_stable(spark):
    df = spark.range(20000)
    first = {r["id"] for r in sample_fraction(df, 0.1, keys="id").collect()}
    again = {r["id"] for r in sample_fraction(df.repartition(5), 0.1, keys="id").collect()}
    assert first == again and 1700 < len(first) < 2300
    assert sample_fraction(df, 0) is df


def test_run_collects_errors_and_chains(spark, folder):
    datasets = [
        {"name": "a", "input": "raw", "steps": [{"op": "rename_columns", "mapping": {"id": "k"}}], "output": f"{folder}/a.parquet"},
        {"name": "off", "enabled": False},
        {"name": "missing", "input": f"{folder}/nothing_*.parquet", "output": f"{folder}/m.parquet"},
        {"name": "bad", "input": "a", "steps": [{"op": "nope"}]},
        {"name": "b", "input": f"{folder}/a.parquet", "steps": [{"op": "join", "right": "a", "on": "k"}]},
        {"name": "q", "reader": "sql", "query": "SELECT count(*) AS n FROM {a} WHERE k >= :least", "params": {"least": 2}},
    ]
    result = run_datasets(spark, datasets, tables={"raw": spark.range(4)}, fail=False)
    assert set(result.frames) == {"a", "b", "q"} and len(result.errors) == 2
    assert result.frames["b"].count() == 4 and result.frames["q"].first()["n"] == 2
    with pytest.raises(RunError, match="missing: load error"):
        run_datasets(spark, datasets, tables={"raw": spark.range(4)})


def test_stream_equals_batch(spark, sf_dir, folder):
    steps = [
        {"op": "lowercase_categoricals", "cat_cols": ["o_orderpriority"]},
        {"op": "group_by_features", "group_mapping": {"worth": ["o_totalprice", "o_custkey"]}},
    ]
    batch = spark.read.parquet(f"{sf_dir}/orders.parquet")
    stream = spark.readStream.schema(batch.schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)
    query = write_stream(clean_stream(stream, steps), f"{folder}/out", f"{folder}/progress", once=True)
    query.awaitTermination(60)
    got, want = spark.read.parquet(f"{folder}/out"), clean_stream(batch, steps)
    assert got.count() == want.count() and got.exceptAll(want.select(got.columns)).isEmpty()
    with pytest.raises(ValueError, match="make_label"):
        clean_stream(stream, [{"op": "make_label"}])


def test_shared_folder_is_fresh(spark):
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


@pytest.mark.parametrize("value", ["a\\\\' OR 1=1", "a\\0b", float("nan"), float("inf")])
def test_unsafe_parameters_are_refused(value):
    with pytest.raises(ValueError):
        bind("SELECT :x", {"x": value})


def test_values_are_bound_by_the_driver():
    query = "SELECT ':no', x::int, '100%' FROM t WHERE a = :a AND b IN (:b, :a)"
    values = {"a": "it's; DROP", "b": 3}
    assert dbapi.bound(query, values) == ("SELECT ':no', x::int, '100%' FROM t WHERE a = ? AND b IN (?, ?)", ["it's; DROP", 3, "it's; DROP"])
    assert dbapi.bound(query, values, "numeric")[0].endswith("a = :1 AND b IN (:2, :3)")
    text, given = dbapi.bound(query, values, "pyformat")
    assert text == "SELECT ':no', x::int, '100%%' FROM t WHERE a = %(a)s AND b IN (%(b)s, %(a)s)" and given == values
    with pytest.raises(KeyError):
        dbapi.bound("SELECT :missing", {})
    with pytest.raises(ValueError):
        dbapi.bound("SELECT 1", {}, "else")


def test_split_ranges_leave_no_row_out():
    for lower, upper, parts in ((0, 100, 7), (0, 3, 10), (-5, 5, 1), (0.5, 2.5, 4)):
        found = dbapi.ranges(lower, upper, parts)
        assert found[0].low is None and found[-1].high is None and len(found) <= parts
        assert all(a.high == b.low and a.high is not None for a, b in zip(found, found[1:]))
    with pytest.raises(ValueError):
        dbapi.ranges(3, 3, 2)


def test_filters_become_conditions():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, StringContains
    from pyspark.sql.types import LongType, StructType

    options = {"query": "SELECT * FROM t WHERE d > :d;", "connect": "tests.scripted_driver:connect", "url": "shop", "params": '{"d": 1}', "split": '{"column": "id", "lower": 0, "upper": 10, "parts": 2}'}
    reader = dbapi.DbApiReader(options, StructType().add("id", LongType()).add("odd name", LongType()))
    left = [StringContains(("n",), "x"), EqualTo(("a", "b"), 1), GreaterThan(("v",), float("nan"))]
    assert list(reader.pushFilters([EqualTo(("n",), "a' OR 1=1"), In(("v",), (1, 2)), IsNull(("odd name",)), *left])) == left
    text, values = reader.statement(reader.partitions()[1])
    assert text == 'SELECT id, "odd name" FROM (SELECT * FROM t WHERE d > ?) q WHERE n = ? AND v IN (?, ?) AND "odd name" IS NULL AND id >= ?'
    assert values == [1, "a' OR 1=1", 1, 2, 5]
    scripted_driver.SENT.clear()
    list(reader.read(reader.partitions()[1]))
    assert scripted_driver.SENT == [(text, values), "closed"]


def test_database_rows_arrive_in_split_tasks(spark, monkeypatch):
    monkeypatch.setenv("SHOP", "shop")
    split = {"column": "id", "lower": 0, "upper": 100, "parts": 4}
    found = dbapi.read_bound(spark, "SELECT * FROM t", "id long, name string", "tests.scripted_driver:connect", "SHOP", split=split)
    assert found.rdd.getNumPartitions() == 4
    assert sorted((r["id"] for r in found.collect()), key=lambda i: -1 if i is None else i) == [None, *range(100)]
    assert [r["id"] for r in found.where("id >= 90 and id < 93").orderBy("id").collect()] == [90, 91, 92]
