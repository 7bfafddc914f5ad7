"""Separate driver processes: the command line, and workers that cannot import the package."""

import os
import subprocess
import sys
from pathlib import Path

REPOSITORY = str(Path(__file__).resolve().parent.parent)
SUBMIT = "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 pyspark-shell"

QUERY = f"""
import sys
sys.path.insert(0, {REPOSITORY!r})
import __spark_entry__ as contract
from pyspark.sql import SparkSession
spark = SparkSession.builder.getOrCreate()
for name in ("q_forum_items", "q_markup_text"):
    rows = contract.queries()[name](spark, "/root/testdata/sf0.001").collect()
    print(name, len(rows) > 0)
"""


def python(folder, *arguments, **environment):
    return subprocess.run(
        [sys.executable, *arguments],
        cwd=folder,
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": SUBMIT, **environment},
        capture_output=True,
        text=True,
        timeout=300,
    )


def test_workers_need_no_copy_of_the_package(tmp_path):
    script = tmp_path / "query.py"
    script.write_text(QUERY)
    done = python(tmp_path, str(script))
    assert done.stdout.split("\n")[:2] == ["q_forum_items True", "q_markup_text True"], done.stderr


def test_command_line(store_with_posts, tmp_path):
    verb = ["-m", "contentloom.plans.jobs", "reddit_posts", "--root", store_with_posts.root]
    done = python(tmp_path, *verb, PYTHONPATH=REPOSITORY)
    assert done.returncode == 0, done.stderr
    assert store_with_posts.read("transformed_reddit_posts").count() == 1
    unknown = python(tmp_path, "-m", "contentloom.plans.jobs", "nonsense", "--root", "x", PYTHONPATH=REPOSITORY)
    assert unknown.returncode == 2 and "invalid choice" in unknown.stderr

PAGES = f"""
import resource, sys
sys.path.insert(0, {REPOSITORY!r})
from contentloom.sources import pages
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.getOrCreate()
own = pages.PageProfile(name="own", source="s", category="c", block=("li",), title=("a",))

def peak(batches):
    import pyarrow as pa
    yield pa.RecordBatch.from_arrays([pa.array([resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10])], ["mb"])

def mb():
    return spark.range(1, numPartitions=1).mapInArrow(peak, "mb long").first().mb

before = mb()
html = F.concat(F.lit("<li><a href='/x'>\U0001f600</a></li>"), F.repeat(F.lit("x"), 150000), F.col("id").cast("string"))
stored = spark.range(300, numPartitions=1).select(
    F.concat(F.lit("u"), "id").alias("url"), F.lit("own").alias("profile"), F.lit(200).alias("status"),
    html.alias("html"), F.lit("2024-01-30 06:00:00").cast("timestamp").alias("fetched_at"))
print(pages.page_blocks(stored, [own]).agg(F.count_distinct("page_url", "title")).first()[0])
print(mb() - before)
"""


def test_a_worker_holds_one_page_as_text(tmp_path):
    """300 pages in one batch of 45 MB, each of 0.6 MB as a Python string."""
    script = tmp_path / "memory.py"
    script.write_text(PAGES)
    done = python(tmp_path, str(script), PYSPARK_SUBMIT_ARGS=SUBMIT.replace("local[2]", "local[1]"))
    assert done.returncode == 0, done.stderr
    rows, grown = map(int, done.stdout.split()[:2])
    assert rows == 300 and grown < 150, grown
