import json
import os
import subprocess
import sys
import tempfile

RUN = """
import sys
from pyspark.sql import functions as F
from sentforge.operators.memory import memory_lookup, memory_rows
from sentforge.session import local_session
from sentforge.streaming.incremental import process_new_files
spark = local_session(2, shuffle_partitions=2, app="restart")
memory = memory_rows(spark.createDataFrame([("a",)], "sentence string"), F.lit("A"), F.lit("en"), F.lit("hi"))
src, out, ckpt = sys.argv[1:]
process_new_files(spark, src, "sentence string", lambda df: memory_lookup(df, memory, "hi"), out, ckpt)
"""


def test_new_files_processed_once_across_applications(spark):
    top = tempfile.mkdtemp(prefix="sf-stream-")
    src, out, ckpt = (os.path.join(top, x) for x in ("in", "out", "progress"))
    os.mkdir(src)

    def drop(name, rows):
        with open(os.path.join(src, name), "w") as f:
            f.writelines(json.dumps({"sentence": r}) + "\n" for r in rows)

    def run():  # a new application each time
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        subprocess.run([sys.executable, "-c", RUN, src, out, ckpt], check=True, cwd=root, timeout=300, capture_output=True)

    drop("1.json", ["a", "b"])
    run()
    drop("2.json", ["c"])
    run()
    run()  # nothing new
    rows = sorted((r.source_sentence, r.hit) for r in spark.read.parquet(out).collect())
    assert rows == [("a", True), ("b", False), ("c", False)]
