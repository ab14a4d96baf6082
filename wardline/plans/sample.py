"""The order tables seen as incidents, so that every job can run on them.

Each order line becomes one raw incident: the customer's region is the force, its nation the area,
and keys and flags stand in for categories, outcomes and coordinates, with blanks, nulls, stray
spaces and repeated values where real files have them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.schema import OUTCOME_NO_SUSPECT, OUTCOME_OPEN

# Category of a line by l_partkey % 9. One carries a stray space.
SAMPLE_CATEGORIES = (
    "Violence and sexual offences",
    "Anti-social behaviour",
    "Burglary",
    "Vehicle crime",
    "Shoplifting",
    "Drugs",
    "Robbery ",
    "Public order",
    "Other theft",
)
SAMPLE_RESOLVED = "Offender given a caution"


# Columns used here. Declared, so that no job has to open files before a query starts.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "ts timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def order_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the nation and region of its customer.

    Built before the join with the lines, so that the lines are shuffled once only. Nations and
    regions are fixed lists and far below the broadcast limit; customers are joined as their size
    demands.
    """
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "n_nationkey", "n_name", "r_name")
    )


# Raw column -> SQL expression over a joined line.
_RAW_COLUMNS = {
    "crime_id": (
        "case l_linenumber when 7 then '' when 6 then '  ' when 5 then null "
        "else concat(l_orderkey, '-', l_linenumber) end"
    ),
    "month": "if(l_partkey % 97 = 0, null, left(cast(cast(l_shipdate as date) as string), 7))",
    "reported_by": "concat(r_name, ' Police')",
    "falls_within": "concat(r_name, ' Police')",
    "longitude": "if(l_suppkey % 50 = 0, null, (l_partkey % 1000) * 0.001d - 2)",
    "latitude": "if(l_suppkey % 49 = 0, null, (l_suppkey % 1000) * 0.001d + 53)",
    "location": "concat(' On or near Street ', l_suppkey)",
    "lsoa_code": "concat('E', lpad(n_nationkey * 3 + l_partkey % 3, 8, '0'))",
    "lsoa_name": "concat(' ', n_name, ' ', lpad(l_partkey % 3 + 1, 3, '0'), 'A ')",
    "crime_type": "if(l_partkey % 101 = 0, null, elt(cast(l_partkey % 9 as int) + 1, {categories}))",
    "last_outcome": (
        f"case when l_returnflag = 'A' then '{OUTCOME_OPEN}' "
        f"when l_returnflag = 'R' then '{OUTCOME_NO_SUSPECT}' "
        f"when l_linestatus = 'O' then if(l_quantity > 25, ' ', null) else '{SAMPLE_RESOLVED}' end"
    ),
    "context": "cast(null as string)",
    "force": "concat(' ', lower(r_name))",
    "_loaded_at": "cast(date_add(cast(l_shipdate as date), l_linenumber) as timestamp_ntz)",
}


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both sides grow with the data: never broadcast one, and let a hot order be split at run time.
    lines = table(spark, sf_dir, "lineitem").join(
        order_areas(spark, sf_dir).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    categories = ", ".join(f"'{name}'" for name in SAMPLE_CATEGORIES)
    return lines.selectExpr(
        *[f"{sql.format(categories=categories)} as {name}" for name, sql in _RAW_COLUMNS.items()]
    )
