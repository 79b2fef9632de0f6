"""Readers, writers and scratch folders."""

import glob

import pytest
from pyspark.sql import functions as F

from clickloom.sources import readers, scratch, writers
from clickloom.sources.schemas import CITY_INFO, PRODUCT_INFO


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


LINE = "2021-03-01_5_abc-1_37_2021-03-01 00:00:02_{}_-1_-1_null_null_3,4_8_3\n"


def test_action_log(spark, tmp_path):
    path = write(tmp_path / "log", LINE.format("手机") + LINE.format("null"))
    first, second = readers.read_action_log(spark, path).collect()
    assert (first.user_id, first.session_id, first.page_id) == (5, "abc-1", 37)
    assert first.search_keyword == "手机" and second.search_keyword is None
    assert (first.click_category_id, first.order_category_ids) == (-1, None)
    assert (first.pay_category_ids, first.pay_product_ids, first.city_id) == ("3,4", "8", 3)


def test_action_log_keeps_quote_signs(spark, tmp_path):
    path = write(tmp_path / "log", LINE.format('"17 inch'))
    assert readers.read_action_log(spark, path).first().search_keyword == '"17 inch'


def test_tab_delimited_log(spark, tmp_path):
    path = write(tmp_path / "log", LINE.format("null").replace("_", "\t"))
    assert readers.read_action_log(spark, path, sep="\t").first().city_id == 3


def test_lines_that_do_not_fit(spark, tmp_path):
    path = write(tmp_path / "log", LINE.format("null") + "2021-03-01_7\n")
    good = readers.read_action_log(spark, path, keep_corrupt=True)
    bad = [r[readers.CORRUPT] for r in good.collect()]
    assert bad == [None, "2021-03-01_7"]
    with pytest.raises(Exception):
        readers.read_action_log(spark, path).collect()


def test_tsv(spark, tmp_path):
    cities = readers.read_tsv(spark, write(tmp_path / "c", "1\t北京\t华北\n2\t上海\t华东\n"), CITY_INFO)
    assert [tuple(r) for r in cities.collect()] == [(1, "北京", "华北"), (2, "上海", "华东")]
    goods = readers.read_tsv(spark, write(tmp_path / "p", "1\tp_1\tself\n"), PRODUCT_INFO)
    assert goods.dtypes[0] == ("product_id", "bigint")


def test_csv_key_and_rest(spark, tmp_path):
    path = write(tmp_path / "a", "7,lamp,90\n8,desk,15")
    df = readers.read_csv(spark, path, "key string, name string, age string")
    assert [tuple(r) for r in df.collect()] == [("7", "lamp", "90"), ("8", "desk", "15")]


def test_json_inferred_and_given(spark, tmp_path):
    path = write(tmp_path / "j", '{"name": "x", "age": 31}\n{"name": "y"}\n')
    assert dict(readers.read_json(spark, path).dtypes) == {"age": "bigint", "name": "string"}
    given = readers.read_json(spark, path, "name string, age int")
    assert [tuple(r) for r in given.where("age >= 30").collect()] == [("x", 31)]


def test_values(spark):
    df = readers.values(spark, [(5, "oak", 12), (6, "elm", 60)], ["id", "name", "age"])
    assert [tuple(r) for r in df.collect()] == [(5, "oak", 12), (6, "elm", 60)]


def test_lines(spark, tmp_path):
    df = readers.read_lines(spark, write(tmp_path / "t", "a  b\n\nc a"))
    assert [r.value for r in df.collect()] == ["a  b", "", "c a"]


def test_write_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, None, 3.5)], "k bigint, v string, w double")
    path = str(tmp_path / "out")
    writers.write_text(df, path)
    assert sorted(r.value for r in readers.read_lines(spark, path).collect()) == ["1,a,", "2,,3.5"]
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        writers.write_text(df, path)
    writers.write_text(df, path, sep="|", null_text="null", mode="overwrite")
    got = sorted(r.value for r in readers.read_lines(spark, path).collect())
    assert got == ["1|a|null", "2|null|3.5"]


def test_single_file(spark, tmp_path):
    df = spark.range(100).repartition(4)
    writers.write_text(df, str(tmp_path / "many"))
    writers.write_text(df, str(tmp_path / "one"), single_file=True)
    assert len(glob.glob(str(tmp_path / "many" / "part-*"))) == 4
    assert len(glob.glob(str(tmp_path / "one" / "part-*"))) == 1
    assert sorted(int(r.value) for r in spark.read.text(str(tmp_path / "one")).collect()) == list(range(100))


def test_write_parquet(spark, tmp_path):
    path = str(tmp_path / "p")
    writers.write_parquet(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        writers.write_parquet(spark.range(3), path)


class FakeConf(dict):
    pass


class FakeSession:
    def __init__(self, **settings):
        self.conf = FakeConf({k.replace("__", "."): v for k, v in settings.items()})


def test_scratch_lies_in_the_shared_folder(spark):
    base = spark.conf.get(scratch.SETTING)
    one, two = scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "x")
    assert one != two and one.startswith(base) and one.endswith("/x")


def test_no_machine_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_path(FakeSession(spark__master="yarn"), "x")
    assert scratch.scratch_path(FakeSession(spark__master="local[2]"), "x").endswith("/x")


def test_single_file_in_order(spark, tmp_path):
    """Many tasks write; the one file has all lines in order, also where most parts are empty."""
    path = str(tmp_path / "one")
    df = spark.range(0, 5000, 1, 9).select(F.xxhash64("id").alias("h"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"))
    writers.write_text(df, path, single_file=True, order=["h"])
    lines = open(glob.glob(path + "/part-*")[0], encoding="utf-8").read().splitlines()
    want = sorted((r.h, r.v) for r in df.collect())
    assert lines == [f"{h},{'' if v is None else v}" for h, v in want]
    assert sorted(p.rsplit("/", 1)[1] for p in glob.glob(str(tmp_path / "*"))) == ["one"]
    with pytest.raises(FileExistsError):
        writers.write_text(df, path, single_file=True)
    with pytest.raises(ValueError):
        writers.write_text(df, path, single_file=True, mode="append")
    writers.write_text(df.where("false"), path, single_file=True, mode="ignore")
    assert spark.read.text(path).count() == 5000
    writers.write_text(df.where("false"), path, single_file=True, mode="overwrite")
    assert spark.read.text(path).count() == 0 and len(glob.glob(path + "/part-*")) == 1


def test_files_are_linked_where_the_file_system_can(spark):
    class Links:
        def concat(self, first, rest):
            self.asked = first.getName(), [p.getName() for p in rest]

    system = Links()
    parts = [spark._jvm.org.apache.hadoop.fs.Path(f"/x/part-{i}") for i in range(3)]
    assert writers._linked(system, parts, spark)
    assert system.asked == ("part-0", ["part-1", "part-2"])


def bad_log(tmp_path):
    good = LINE.format("null")
    odd = ["2021-03-01_7", good.strip() + "_more", good.strip().replace("_37_", "_page_"), "x"]
    first, second = tmp_path / "logs" / "a", tmp_path / "logs" / "b"
    first.parent.mkdir()
    write(first, good * 20 + odd[0] + "\n" + good + odd[1] + "\n")
    write(second, odd[2] + "\n" + good * 5 + odd[3] + "\n" + "\n")
    return str(first.parent), odd


def test_bad_lines_are_parted_off(spark, tmp_path):
    path, odd = bad_log(tmp_path)
    loaded = readers.load_action_log(spark, path, str(tmp_path / "out"), tolerated=4)
    assert (loaded.n_good, loaded.n_bad) == (26, 4)
    assert sorted(r.line for r in loaded.bad.collect()) == sorted(odd)
    assert {r.file.rsplit("/", 1)[1] for r in loaded.bad.collect()} == {"a", "b"}
    assert loaded.good.schema.names == readers.USER_VISIT_ACTION.names
    assert {(r.user_id, r.page_id, r.city_id) for r in loaded.good.collect()} == {(5, 37, 3)}


def test_too_many_bad_lines(spark, tmp_path):
    path, odd = bad_log(tmp_path)
    with pytest.raises(readers.TooManyBadLines, match="4 of 30 lines"):
        readers.load_action_log(spark, path, str(tmp_path / "out"), tolerated=3)
    assert spark.read.parquet(str(tmp_path / "out") + "/bad=true").count() == 4
    loaded = readers.load_action_log(spark, path, str(tmp_path / "out2"), tolerated_share=0.14)
    assert loaded.n_bad == 4
    clean = write(tmp_path / "clean", LINE.format("null") * 3)
    loaded = readers.load_action_log(spark, clean, str(tmp_path / "out3"))
    assert (loaded.good.count(), loaded.bad.count()) == (3, 0)
    empty = write(tmp_path / "empty", "")
    loaded = readers.load_action_log(spark, empty, str(tmp_path / "out4"))
    assert (loaded.n_good, loaded.n_bad) == (0, 0)
