"""Operators whose tasks start without the package on their path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
import pyspark.sql  # the workers' path is that of the start, without the package
from pyspark.sql import SparkSession
sys.path.insert(0, sys.argv[1])
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.session.timeZone", "UTC").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from funnelforge.llm import queries
tables = spark.createDataFrame([(i, f"the cat number {i} sat under the MIT license of the house and slept there for long hours", "en" if i % 2 else "de")
                                for i in range(40)], "doc_id long, text string, lang string")
labels = tables.selectExpr("doc_id", "cast(doc_id % 2 as int) AS toxic", "1 AS quality")
benchmark = tables.where("doc_id < 3").selectExpr("cast(doc_id AS string) AS item_id", "text")
embeddings = spark.range(60).selectExpr("id AS vec_id", "array(cast(id % 7 AS float), cast(id % 5 AS float), 1f) AS embedding")
conversations = tables.selectExpr("doc_id % 5 AS conv_id", "doc_id AS turn", "'user' AS role", "text")
pages = tables.selectExpr("doc_id AS page_id", "concat('https://example.com/', doc_id) AS url", "concat('<p>', text, '</p>') AS html")
for name, df in dict(documents=tables, labels=labels, benchmark=benchmark, embeddings=embeddings, conversations=conversations, pages=pages).items():
    df.write.parquet(f"{sys.argv[3]}/{name}.parquet")
for name, query in queries.queries().items():
    print(name, len(query(spark, sys.argv[3]).collect()), flush=True)
"""


def test_executors_need_not_have_the_package(tmp_path):
    away = tmp_path / "away"
    away.mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, str(tmp_path / "ckpt"), str(tmp_path)], cwd=away, env=env,
                          capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len([x for x in done.stdout.splitlines() if x.startswith("op")]) >= 13
