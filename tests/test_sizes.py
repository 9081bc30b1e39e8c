import glob
import os

import pytest

from chartloom.operators import store
from chartloom.plans import catalog, relational

SF = "/root/testdata/sf0.001"
CODEC = "spark.sql.parquet.compression.codec"


def bytes_a_row(df, folder):
    df.write.parquet(f"file://{folder}")
    return sum(os.path.getsize(f) for f in glob.glob(f"{folder}/*.parquet")) / df.count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_keys_are_written_in_half_their_hexadecimal_bytes(spark, tmp_path):
    assert CODEC not in spark.conf.getAll
    assert bytes_a_row(catalog.queries()["entity_keys"](spark, SF), tmp_path / "entity") < 300
    assert bytes_a_row(catalog.queries()["sha_key"](spark, SF), tmp_path / "sha") < 50
    assert CODEC not in spark.conf.getAll


def test_a_session_of_packed_files_keeps_the_callers_settings(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert relational.packing(own).conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    own.conf.set(CODEC, "gzip")
    assert relational.packing(own) is own


@pytest.mark.parametrize(("most", "kind"), [("-1", "ShuffledHashJoin"), ("10m", "BroadcastHashJoin")])
def test_a_sweep_hashes_the_written_encounters_and_sorts_no_rows(spark, most, kind):
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    rows = own.createDataFrame([("e1", 1), ("e1", 2), ("e2", 1), (None, 1)], "encounter_id string, n int")
    written = own.sql("SELECT * FROM VALUES ('e1'), ('e1'), ('e3'), (NULL) AS t(encounter_id)")
    stage = store.by_encounter(rows, written, "left_semi").where("n > 1").withColumn("n", rows["n"] + 10)
    out = store.swept_upsert(rows, stage, written)
    assert sorted(map(str, out.collect())) == sorted(map(str, [own.createDataFrame([r], rows.schema).first() for r in [("e2", 1), (None, 1), ("e1", 12)]]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert kind in plan and "SortMergeJoin" not in plan
