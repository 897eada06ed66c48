"""Python workers find the package when the entry was loaded by path, from another folder."""

import test_entry

CODE = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
print("rows", entry.queries()["op8_window_packing"](spark, "/root/testdata/sf0.001").count())
"""


def test_operators_run_from_another_folder(tmp_path):
    found = test_entry.run(CODE, tmp_path, "import os; os.environ.pop('PYTHONPATH', None)")
    assert int(found.stdout.split("rows ")[1]) >= 200, found.stderr[-2000:]
