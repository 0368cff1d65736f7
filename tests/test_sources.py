"""Environment switch, paths, staging."""

import pytest
from pyspark.sql import functions as F

from registrar_feeds.session import scratch_dir
from registrar_feeds.sources import (
    SCHEMAS, check_env, read_tables, stage_table, staged_schema, table_path, write_tables,
)


def test_environment_switch():
    assert check_env("LIVE") == "live" and check_env(" train ") == "train"
    for bad in ("", None, "prod", "test"):
        with pytest.raises(ValueError):
            check_env(bad)


def test_table_paths():
    assert table_path("s3a://b/reg/", "live", "sec_rec") == "s3a://b/reg/live/sec_rec"
    assert table_path("/data", "train", "audit_sec_rec") == "/data/train/audit/sec_rec"


def test_staging_trims_keys_keeps_payload_and_conforms_types(spark):
    df = spark.createDataFrame([("ART 101  ", "UG18 ", None, "UNDG", "  Intro  ", None, None, "5")],
                               "crs_no string, cat string, dept string, prog string, title1 string, title2 string, "
                               "title3 string, extra string")
    out = stage_table("crs_rec", df)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in staged_schema("crs_rec")]
    r = out.first()
    assert r.crs_no == "ART 101" and r.title1 == "  Intro  " and r.course_key == "ART 101 (UG18)"


def test_absent_columns_are_an_error(spark, smoke_tables):
    with pytest.raises(ValueError, match="crs_rec: source columns absent: cat"):
        stage_table("crs_rec", smoke_tables["crs_rec"].drop("cat"))
    # the one optional column reads as null
    assert stage_table("id_rec", smoke_tables["id_rec"].drop("fullname")).where("fullname IS NOT NULL").count() == 0
    # a raw extract without the column fails too: no forced schema hides it
    base = scratch_dir(spark, "absent")
    for name, schema in SCHEMAS.items():
        df = smoke_tables[name].select(*[f.name for f in schema.fields if (name, f.name) != ("sec_rec", "stat")]).limit(1)
        df.write.parquet(table_path(base, "train", name))
    with pytest.raises(ValueError, match="sec_rec: source columns absent: stat"):
        read_tables(spark, base, "train", staged=False)


def test_layout_of_staged_files(spark, smoke_tables):
    """Files hold disjoint ranges of the clustered columns, and a folder has
    about as many files as tasks touch it."""
    base = scratch_dir(spark, "layout")
    write_tables({n: smoke_tables[n] for n in ("sec_rec", "job_rec")}, base, "live")
    t = read_tables(spark, base, "live", names=("sec_rec", "job_rec"))
    ranges = (t["job_rec"].groupBy(F.input_file_name().alias("f")).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
              .orderBy("lo").collect())
    assert all(a["hi"] < b["lo"] for a, b in zip(ranges, ranges[1:], strict=False))
    files = t["sec_rec"].select("yr", F.input_file_name().alias("f")).distinct().count()
    years = t["sec_rec"].select("yr").distinct().count()
    assert files <= years + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_fixture_tables_have_schemas(smoke_tables):
    for name, df in smoke_tables.items():
        assert [(f.name, f.dataType) for f in df.schema] == \
            [(f.name, f.dataType) for f in staged_schema(name)], name


def test_raw_extracts_are_staged_on_read(spark, smoke_tables):
    """Raw extracts in the source schema, keys blank-padded, read with
    staged=False give the same feed as staged tables."""
    from registrar_feeds.asof import FIXTURE_AS_OF as A
    from registrar_feeds.plans import feeds as FD
    from registrar_feeds.sources import KEY_COLUMNS

    base = scratch_dir(spark, "raw")
    for name, schema in SCHEMAS.items():
        df = smoke_tables[name].select(*[f.name for f in schema.fields])
        for k in KEY_COLUMNS.get(name, ()):
            df = df.withColumn(k, F.concat(F.col(k), F.lit("  ")))     # CHAR padding
        df.write.parquet(table_path(base, "train", name))
    raw = read_tables(spark, base, "train", staged=False)
    a, b = FD.feed_crosslist(raw, A), FD.feed_crosslist(smoke_tables, A)
    assert a.count() == 773 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
