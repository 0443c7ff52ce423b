"""Reading, writing and scratch tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from model import rows
from temporal_tree import (
    PipelineOptions,
    Scratch,
    load_raw,
    publish_star,
    read_published,
    read_star,
    run,
    write_star,
)
from temporal_tree.fixtures import sample_raw
from temporal_tree.schemas import RAW_TABLES, STAR_TABLES
from temporal_tree.sources import scratch as scratch_module
from temporal_tree.sources.resumable import fingerprint


def test_raw_from_parquet_and_catalog(spark, tmp_path):
    raw = sample_raw(spark)
    paths = {}
    for name, df in zip(RAW_TABLES, raw):
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
        df.createOrReplaceTempView(name)
    for loaded in (load_raw(spark, paths=paths), load_raw(spark)):
        for got, want, schema in zip(loaded, raw, RAW_TABLES.values()):
            assert got.columns == schema.names
            assert rows(got) == rows(want)
    renamed = load_raw(spark, tables={name: name for name in RAW_TABLES})
    assert run(renamed).star.fact.count() == 14
    with pytest.raises(ValueError, match="one of"):
        load_raw(spark, paths=paths, tables={})


def test_raw_over_jdbc_passes_the_connection(spark, monkeypatch):
    """No database is started here: this checks what the reader is asked to do."""
    raw = dict(zip(RAW_TABLES, sample_raw(spark)))
    asked = []

    class Reader:
        def format(self, name):
            assert name == "jdbc"
            return self

        def options(self, **options):
            self.seen = options
            return self

        def load(self):
            asked.append(self.seen)
            return raw[self.seen["dbtable"]]

    class Session:
        read = property(lambda self: Reader())

    split = {"partitionColumn": "effective_start_date", "numPartitions": "8"}
    loaded = load_raw(
        Session(),
        jdbc={"url": "jdbc:example:db", "user": "u"},
        partitioning={"raw_partner_adv_entity_mapping": split},
    )
    assert [a["dbtable"] for a in asked] == list(RAW_TABLES)
    assert all(a["url"] == "jdbc:example:db" and a["user"] == "u" for a in asked)
    assert [a.get("numPartitions") for a in asked] == [None, None, "8"]
    assert rows(loaded.partners) == rows(raw["raw_partner_accounts"])


def test_star_to_parquet_twice(spark, tmp_path):
    star = run(sample_raw(spark)).star.tables()
    path = str(tmp_path / "star")
    for _ in range(2):
        write_star(star, path=path)
    back = read_star(spark, path)
    for name, schema in STAR_TABLES.items():
        assert back[name].columns == schema.names
        assert rows(back[name]) == rows(star[name])


def test_star_to_catalog(spark):
    star = run(sample_raw(spark)).star.tables()
    spark.sql("CREATE DATABASE IF NOT EXISTS star_test")
    write_star(star, database="star_test")
    assert spark.table("star_test.fact_account_hierarchy").count() == 14
    spark.sql("DROP DATABASE star_test CASCADE")


def test_star_over_jdbc_passes_the_connection(spark, monkeypatch):
    """No database is started here: this checks what the writer is asked to do."""
    calls = []

    def record(self, url, table, mode=None, properties=None):
        calls.append((url, table, properties))

    monkeypatch.setattr(DataFrameWriter, "jdbc", record)
    write_star(
        run(sample_raw(spark)).star.tables(),
        jdbc_url="jdbc:example:db",
        jdbc_properties={"user": "u", "driver": "d"},
    )
    properties = {"user": "u", "driver": "d"}
    assert calls == [("jdbc:example:db", name, properties) for name in STAR_TABLES]
    with pytest.raises(ValueError, match="exactly one"):
        write_star({}, path="p", database="d")


def test_scratch_lives_in_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    result = run(sample_raw(spark), PipelineOptions())
    assert result.run.scratch.path.startswith(root)
    table, seen = result.run.scratch.save_measured(
        spark.range(5), "five", total=F.sum("id")
    )
    assert seen == {"total": 10} and table.count() == 5
    result.close()
    with pytest.raises(Exception):
        table.count()


class _Session:
    def __init__(self, **conf):
        self.conf = {"spark." + k.replace("_", "."): v for k, v in conf.items()}


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        scratch_module.scratch_root(_Session(master="yarn"))
    assert scratch_module.scratch_root(_Session(master="yarn", checkpoint_dir="hdfs:/c")) == "hdfs:/c"
    assert Scratch(_Session(master="local[2]")).path.split("/run-")[0]


@pytest.mark.parametrize(
    "wrong", [{"persist": "x"}, {"max_depth": 0}, {"cell_rows": 0}, {"succession_key": "root"}]
)
def test_options_are_checked(wrong):
    with pytest.raises(ValueError):
        PipelineOptions(**wrong)


def test_published_star(spark):
    """Joins by account need no exchange; a write that fails leaves the old star; old versions go."""
    spark.sql("CREATE DATABASE published")
    with pytest.raises(LookupError):
        read_published(spark, "published")
    with run(sample_raw(spark)) as result:
        star = result.star.tables()
        publish_star(star, "published", buckets=4)
        first = read_published(spark, "published")
        for name, df in star.items():
            assert rows(first[name]) == rows(df.select(first[name].columns))
        joined = first["fact_account_hierarchy"].join(first["dim_accounts"].hint("merge"), "account_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan

        broken = dict(star, dim_accounts=star["dim_accounts"].withColumn("account_id", F.expr("raise_error('lost')").cast("string")))
        with pytest.raises(Exception, match="lost"):
            publish_star(broken, "published", buckets=4)
        still = read_published(spark, "published")
        assert {n: rows(df) for n, df in still.items()} == {n: rows(df) for n, df in first.items()}

        fewer = dict(star, fact_account_hierarchy=star["fact_account_hierarchy"].limit(3))
        publish_star(fewer, "published", buckets=4)
        assert read_published(spark, "published")["fact_account_hierarchy"].count() == 3
        assert first["fact_account_hierarchy"].count() == star["fact_account_hierarchy"].count()
        assert spark.sql("SHOW TABLES IN published").where("not isTemporary").count() == 6


def test_saved_tables_leave_no_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def data_files():
        return blocks.getAllFiles().size()

    scratch = Scratch(spark)
    table = scratch.save(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sevenths")
    held = data_files()
    again = scratch.save(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sevenths")
    assert data_files() <= held
    assert rows(table) == rows(again) and spark.conf.get(name) == before


# resumed runs


class Lost(Exception):
    pass


def lose_at(monkeypatch, lost):
    """Ends a run where it begins to write the named table, which is left without a commit."""
    write = Scratch._save_to

    def spy(self, path, df):
        if path.endswith(f"-{lost}"):
            Path(path.removeprefix("file:")).mkdir(parents=True)
            raise Lost
        return write(self, path, df)

    monkeypatch.setattr(Scratch, "_save_to", spy)


def table_files(folder):
    """The tables written below a resumable folder, with the times of their files."""
    found = {}
    for file in Path(folder).glob("*/run-*/*/part-*.parquet"):
        name = file.parent.name.partition("-")[2]
        found.setdefault(name, set()).add((str(file), file.stat().st_mtime_ns))
    return found


@pytest.mark.parametrize("collapse, lost, kept", [
    (True, "ordered", {"edges", "best_mappings", "calendar", "spans"}),
    (True, "offsets", {"edges", "best_mappings", "calendar", "spans", "ordered"}),
    (False, "ordered", {"edges", "best_mappings", "calendar", "segments"}),
])
def test_a_lost_run_goes_on_where_it_was(spark, tmp_path, collapse, lost, kept):
    options = PipelineOptions(collapse=collapse)
    with pytest.MonkeyPatch.context() as patch, pytest.raises(Lost):
        lose_at(patch, lost)
        with run(sample_raw(spark), options, resume=str(tmp_path)) as first:
            first.star.fact.count()
    before = table_files(tmp_path)
    assert kept <= set(before) and lost not in before
    with run(sample_raw(spark), options, resume=str(tmp_path)) as second:
        got = rows(second.star.fact)
        after = table_files(tmp_path)
        # nothing that was finished is written again, and no path is made again
        assert {name: after[name] for name in before} == before
        assert set(after) - set(before) == {"ordered", "offsets"} - kept
        # the load time is that of the first attempt
        assert {r[-1] for r in got} == {first.run.options.load_ts}
    assert got == rows(run(sample_raw(spark), PipelineOptions(load_ts=first.run.options.load_ts)).star.fact)
    assert not list(tmp_path.iterdir())  # a run that ends well leaves nothing


def test_other_inputs_or_options_are_not_taken_over(spark, tmp_path):
    raw = sample_raw(spark)

    def folder(raw, options=PipelineOptions()):
        return run(raw, options, resume=str(tmp_path)).run.scratch.folder

    mine = folder(raw)
    assert folder(raw, PipelineOptions(validate=False)) == mine
    shuffled = raw._replace(mappings=raw.mappings.orderBy(F.rand(3)).repartition(3))
    assert folder(shuffled) == mine
    others = [
        folder(raw, PipelineOptions(half_open=True)),
        folder(raw._replace(mappings=raw.mappings.limit(1))),
        folder(raw._replace(partners=raw.partners.unionByName(raw.partners))),
    ]
    assert len({mine, *others}) == 4
    with pytest.raises(ValueError, match="persist"):
        run(raw, PipelineOptions(persist="cache"), resume=str(tmp_path))


def test_fingerprint_tells_nulls_by_their_place(spark):
    one, other = (
        spark.createDataFrame([row], "a string, b string") for row in ((None, "x"), ("x", None))
    )
    assert fingerprint([one], None) != fingerprint([other], None)
    assert fingerprint([one, other], None) != fingerprint([other, one], None)
    nothing = one.where("false")
    assert fingerprint([nothing], None) == fingerprint([nothing], None)


def test_large_buckets_are_written_by_several_tasks(spark):
    spark.sql("CREATE DATABASE pieces")
    with run(sample_raw(spark)) as result:
        star = result.star.tables()
        publish_star(star, "pieces", buckets=2, task_rows=1)
        got = read_published(spark, "pieces")
        for name, df in star.items():
            assert rows(got[name]) == rows(df.select(got[name].columns))
        files = got["fact_account_hierarchy"].select("account_id", F.input_file_name().alias("file")).distinct()
        assert files.select("file").distinct().count() > 2
        assert files.count() == files.select("account_id").distinct().count()
        joined = got["fact_account_hierarchy"].join(got["dim_accounts"].hint("merge"), "account_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_tables_of_a_run_are_made_without_large_broadcasts(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    with run(sample_raw(spark)) as result:
        scratch = result.run.scratch
        table = scratch.save(spark.range(100_000).selectExpr("uuid() AS account"), "accounts")

        def plan():
            return table.join(table.select("account"), "account")._jdf.queryExecution().executedPlan().toString()

        assert "BroadcastExchange" in plan()
        with scratch.broadcasts_bounded():
            assert "BroadcastExchange" not in plan()
        assert spark.conf.get(name) == before
        spark.conf.set(name, "-1")
        with scratch.broadcasts_bounded():
            assert spark.conf.get(name) == "-1"
    spark.conf.set(name, before)
