"""Incremental landing: new CSV drops typed with the same profile."""

import os

import pytest
from pyspark.errors import StreamingQueryException

from statflow.plans.profiles import TEAM_BOX_PROFILE
from statflow.sources import write_csv
from statflow.streaming import land_stream
from tests import fixtures as X


def test_land_stream_processes_each_drop_once(spark, tmp_dir):
    src, sink = os.path.join(tmp_dir, "drops"), os.path.join(tmp_dir, "sink")
    os.makedirs(src)
    row = X.TEAM_BOX_ROWS[0]
    write_csv(X.frame(spark, X.TEAM_BOX_HEADER, [row]).coalesce(1), f"{src}/day1")
    progress = os.path.join(tmp_dir, "progress")

    def land():
        q = land_stream(spark, f"{src}/*", X.TEAM_BOX_HEADER, TEAM_BOX_PROFILE, sink, progress, "team_box")
        q.awaitTermination(120)
        return q

    land()
    assert spark.read.parquet(sink).count() == 1
    land()  # started again: nothing is read twice
    assert spark.read.parquet(sink).count() == 1
    second = (row[0], row[1], row[2], "0022300002") + row[4:]
    write_csv(X.frame(spark, X.TEAM_BOX_HEADER, [second]).coalesce(1), f"{src}/day2")
    land()
    out = spark.read.parquet(sink)
    assert sorted(r.GAME_ID for r in out.collect()) == ["0022300001", "0022300002"]
    assert dict(out.dtypes)["PTS"] == "int"


def test_reordered_drop_fails_the_stream(spark, tmp_dir):
    src, sink = os.path.join(tmp_dir, "drops"), os.path.join(tmp_dir, "sink")
    header = list(X.TEAM_BOX_HEADER)
    i, j = header.index("PTS"), header.index("AST")
    header[i], header[j] = header[j], header[i]
    write_csv(X.frame(spark, header, X.TEAM_BOX_ROWS).coalesce(1), f"{src}/day1")
    q = land_stream(spark, f"{src}/*", X.TEAM_BOX_HEADER, TEAM_BOX_PROFILE, sink,
                    os.path.join(tmp_dir, "progress"), "reordered")
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(120)
