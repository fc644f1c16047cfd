"""Queries against their SQL at the smallest size."""

import duckdb
import pytest

import __spark_entry__
from siftloom.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SOME = ["expression", "assign_mode0", "assign_mode1", "assign_mode2", "gene_validation", "gene_model", "gff_forward_fill", "cigar_blocks", "overlap_join_binned", "overlap_point", "locus_combined", "umi_correct", "umi_second_dedup", "saturation_bin", "matrix_triplets", "summary_metrics", "anno_metrics_mode2", "marker_dedup_flagged"]


def told(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(str(round(r[k], 6) if isinstance(r[k], float) else r[k]) for k in order) for r in rows)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SOME)
def test_same_rows_as_sql(spark, data, duck, name):
    got = catalog.queries()[name](spark, data)
    want = duck.sql(catalog.oracle_sql()[name])
    assert told(got.collect(), got.columns) == told(want.fetchall(), want.columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_all_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_needs_the_corpus_operators():
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['siftloom.llm'] = None; import siftloom.plans.catalog as c, siftloom.__main__; assert len(c.queries()) > 50"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1])


def test_the_rest_stands_without_the_corpus_operators(tmp_path):
    """A copy without both folders and the pipeline imports, lists all other queries and runs one."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(__file__).resolve().parents[1]
    copy = tmp_path / "copy"
    shutil.copytree(top, copy, ignore=lambda _, names: [n for n in names if n in ("llm", "corpus_pipeline.py", ".git", "__pycache__")])
    said = """
import __spark_entry__ as e
from pyspark.sql import SparkSession
from siftloom.plans import catalog
assert set(e.queries()) == set(catalog.queries()) and set(e.oracle_sql()) == set(catalog.oracle_sql())
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("ROWS", e.queries()["bam_range_scan"](spark, "/root/testdata/sf0.001").count())
"""
    out = subprocess.run([sys.executable, "-c", said], cwd=copy, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and "ROWS" in out.stdout, out.stderr[-2000:]
