"""Every registered query beside its DuckDB SQL, plus known figures of the middle scale."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from stratalake.plans import order_warehouse
from stratalake.plans.silver import to_silver
from stratalake.schemas import INSTITUTION_COLUMNS

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(MIDDLE), reason="tables not present")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def shape(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [
        tuple("nan" if isinstance(row[i], float) and math.isnan(row[i]) else repr(row[i]) for i in order)
        for row in rows
    ]
    return sorted(columns), sorted(cells)


def test_every_query_has_an_oracle():
    assert set(contract.QUERIES) == set(contract.ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.ORACLE))
def test_query_equals_oracle(spark, oracle, name):
    df = contract.queries()[name](spark, SMALL)
    got = shape(df.columns, df.collect())
    result = oracle.execute(contract.oracle_sql()[name])
    assert got == shape([d[0] for d in result.description], result.fetchall())


def test_rows_without_partner_stay(spark, tmp_path):
    """An order without customer, a customer without nation and a line without part lose no row anywhere."""
    drop = {"customer": "c_custkey % 10 = 1", "nation": "n_nationkey = 3", "part": "p_partkey % 7 = 0"}
    connection = duckdb.connect()
    for table in ("orders", "customer", "nation", "lineitem", "part"):
        kept = spark.read.parquet(f"{SMALL}/{table}.parquet").where(f"NOT ({drop.get(table, 'false')})")
        kept.write.parquet(f"{tmp_path}/{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    counts = {}
    for name in ("silver_typed", "fact_entity_year", "silver_item", "fact_item"):
        df = contract.queries()[name](spark, str(tmp_path))
        result = connection.execute(contract.oracle_sql()[name])
        expected = shape([d[0] for d in result.description], result.fetchall())
        assert shape(df.columns, df.collect()) == expected
        counts[name] = len(expected[1])
    assert counts["silver_typed"] == counts["fact_entity_year"] == 798
    assert counts["silver_item"] == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["year", "control", "institutions", "undergrads"] and df.count() == 21


@pytest.mark.parametrize("name", ["outcomes_by_category", "median_trend", "median_by_family"])
def test_medians_of_the_middle_scale_equal_oracle(spark, name):
    connection = duckdb.connect()
    for table in ("orders", "customer", "nation", "lineitem", "part"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{MIDDLE}/{table}.parquet'")
    df = contract.queries()[name](spark, MIDDLE)
    result = connection.execute(contract.oracle_sql()[name])
    expected = shape([d[0] for d in result.description], result.fetchall())
    assert shape(df.columns, df.collect()) == expected and expected[1]


def test_known_figures_of_the_middle_scale(spark):
    queries = contract.queries()
    closures = {r[0]: tuple(r)[1:] for r in queries["closures"](spark, MIDDLE).collect()}
    assert closures == {
        "Public": (479, 198, 41.3),
        "Private nonprofit": (482, 204, 42.3),
        "Private for-profit": (516, 203, 39.3),
    }
    switches = {tuple(r)[:2]: tuple(r)[2:] for r in queries["category_switches"](spark, MIDDLE).collect()}
    assert switches[("All", "All")] == (4180, 1461, 1080)
    assert queries["enrollment_cube"](spark, MIDDLE).count() == 238
    reconciled = queries["cube_reconcile"](spark, MIDDLE).first()
    assert tuple(reconciled) == (28, 28, 0)
    audit = {r["column"]: tuple(r)[1:] for r in queries["null_token_totals"](spark, MIDDLE).collect()}
    assert audit["UGDS"] == (7895, 1270, 714)


def longest_method(df):
    """Bytes of the longest method that any part of the plan, as it ran, compiles to."""
    df.collect()
    compiled = df._jdf.queryExecution().debug().codegenToSeq()
    return max((compiled.apply(i)._3().maxMethodCodeSize() for i in range(compiled.size())), default=0)


def test_silver_of_programs_compiles_to_methods_the_jvm_translates(spark):
    """The JVM interprets methods of more than 8,000 bytes, which made each program row cost several times as much."""
    assert longest_method(order_warehouse.silver_programs(spark, SMALL)) <= 8000


def test_silver_of_institution_files_compiles_to_methods_the_jvm_translates(spark):
    layers = order_warehouse.stored_layers(spark, SMALL)
    assert longest_method(to_silver(layers.read_text(spark), INSTITUTION_COLUMNS, "year")) <= 8000


def test_report_audits_the_files_as_delivered(spark):
    """The report reads stored layers only; their text is not derived from the orders a second time."""
    read = contract.queries()["dq_report"](spark, SMALL).inputFiles()
    assert read and not [path for path in read if path.startswith(f"file://{SMALL}")]


@pytest.mark.parametrize("place", ["files", "tables"])
def test_number_casts_are_compiled_and_not_interpreted(spark, place):
    """A higher-order expression is interpreted per cell; only the text columns, which have no cast, may be in one."""
    if place == "files":
        silver = to_silver(order_warehouse.stored_layers(spark, SMALL).read_text(spark), INSTITUTION_COLUMNS, "year")
    else:
        silver = order_warehouse.silver_programs(spark, SMALL)
    plan = silver._jdf.queryExecution().optimizedPlan().toString()
    shared = [part.split("), lambdafunction", 1)[0].count("#") for part in plan.split("transform(array(")[1:]]
    assert shared == [4 if place == "files" else 3]  # the text columns of INSTITUTION_COLUMNS and PROGRAM_COLUMNS
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
