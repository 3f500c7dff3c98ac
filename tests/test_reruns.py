"""A rerun replaces all that the run wrote; a file with repeated column names costs only itself."""

import pyarrow as pa
import pyarrow.parquet as pq

from tripflow.operators import diagnose
from tripflow.sources import files
from tripflow.sources.layers import commit_run, read_layer

SCHEMA = "process_id string, service_type string, n int"
BY = ("process_id", "service_type")


def test_rows_and_partitions_that_a_rerun_lacks_are_gone(spark, tmp_path):
    path = str(tmp_path / "evidence")

    def run(process_id, rows):
        return sorted(tuple(r) for r in commit_run(spark.createDataFrame(rows, SCHEMA), path, process_id, partition_by=BY).collect())

    other = [("B", "green", 9)]
    assert run("B", other) == other
    assert len(run("A", [("A", "yellow", 1), ("A", "green", 2)])) == 2
    assert run("A", [("A", "yellow", 3)]) == [("A", "yellow", 3)]
    assert run("A", []) == []
    assert sorted(tuple(r) for r in read_layer(spark, path).select("process_id", "service_type", "n").collect()) == other


def test_repeated_column_names_set_a_file_aside(spark, tmp_path):
    for name, columns in (("yellow_good", ["Airport_fee", "tip"]), ("yellow_twin", ["Airport_fee", "airport_fee"]), ("yellow_same", ["Airport_fee", "Airport_fee"])):
        pq.write_table(pa.Table.from_arrays([pa.array([1.0])] * 2, names=columns), tmp_path / f"{name}.parquet")
    found = files.inventory(spark, str(tmp_path), "A")
    status = {r.file_name: (r.read_status, r.ingested) for r in found.collect()}
    assert status["yellow_good.parquet"] == ("SUCCESS", True)
    assert status["yellow_twin.parquet"] == status["yellow_same.parquet"] == ("RECOVERABLE_MISSING_COLUMNS", False)
    assert diagnose.diagnose(found, diagnose.contract_fields(spark)).count() == 3
