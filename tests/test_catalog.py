"""Every registered query against its SQL twin on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tools.compare import TABLES, rows_of  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.fixture(scope="module", autouse=True)
def generated_code(spark):
    """These run with code generation, as users run them."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


#: The training-data queries have tests of their own.
NAMES = sorted(n for n in queries() if not (n == "pipeline" or n.startswith("op") and n[2:].split("_")[0].isdigit()))


def test_names_line_up():
    assert set(NAMES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_twin(spark, con, name):
    df = queries()[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got[1]
    if name in oracle_sql():
        cur = con.execute(oracle_sql()[name])
        assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_a_missing_library_costs_the_training_data_queries_only():
    """One library of the training-data operators hidden: the other queries and their twins stay."""
    code = (
        "import sys; sys.modules['public_tokenizers'] = None; sys.modules['ahocorasick'] = None\n"
        "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), set(s) <= set(q), any(n.startswith('op') for n in q))"
    )
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert said == [str(len(NAMES)), "True", "False"]


def test_entry(spark):
    assert entry(spark).count() > 0


def test_logits_of_all_labels(spark):
    emb = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    logits = queries()["all_label_logits"](spark, FOLDER)
    assert logits.count() == emb.count() * emb.select("label").distinct().count()


def test_complete_windows_hold_every_event(spark):
    [total] = queries()["streamed_windows_complete"](spark, FOLDER).selectExpr("sum(n)").first()
    assert total == spark.read.parquet(f"{FOLDER}/events.parquet").count()
