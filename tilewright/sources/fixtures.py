"""Occurrence records derived from the order tables, for tests and registered queries; also as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_SUPPLIERS = 500_000
_BASES = ("PRESERVED_SPECIMEN", "MACHINE_OBSERVATION", "OCCURRENCE", "HUMAN_OBSERVATION", "LIVING_SPECIMEN", "OBSERVATION", "MATERIAL_CITATION", "MATERIAL_SAMPLE", "FOSSIL_SPECIMEN")


def _columns(array: str, empty: str) -> dict[str, str]:
    num = lambda e: f"CAST({e} AS STRING)"
    net = lambda c, m: f"concat('n', {num(f'{c} % {m}')})"
    rank = lambda base, m: f"CAST({base} + l_partkey % {m} AS INT)"
    degrees = lambda e, m, shift: f"CAST(({e}) % {m} AS DOUBLE) / CAST(100 AS DOUBLE) - CAST({shift} AS DOUBLE)"
    unless = lambda when, e: f"CASE WHEN {when} THEN NULL ELSE {e} END"
    basis = " ".join(f"WHEN {k} THEN '{b}'" for k, b in enumerate(_BASES))
    return {
        "datasetKey": f"concat('d', {num('l_suppkey % 20')})",
        "publishingOrgKey": f"concat('o', {num('l_suppkey % 7')})",
        "publishingCountry": "sn.n_name",
        "networkKey": f"CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN {empty} WHEN 2 THEN {array}({net('l_partkey', 3)}, {net('l_suppkey', 3)}) ELSE {array}({net('l_partkey', 5)}, CAST(NULL AS STRING)) END",
        "countryCode": "cn.n_name",
        "basisOfRecord": f"CASE l_partkey % 9 {basis} END",
        "decimalLatitude": unless("l_linenumber = 7 AND l_returnflag = 'N'", degrees("l_orderkey*7919 + l_partkey*104729 + l_linenumber*31", 18001, 90)),
        "decimalLongitude": unless("l_linenumber = 6 AND l_returnflag = 'N'", degrees("l_orderkey*15485863 + l_suppkey*32452843 + l_linenumber*17", 36001, 180)),
        "kingdomKey": rank(1, 5),
        "phylumKey": rank(100, 10),
        "classKey": rank(200, 20),
        "orderKey": rank(300, 40),
        "familyKey": rank(400, 80),
        "genusKey": unless("l_linenumber = 5", rank(600, 160)),
        "speciesKey": unless("l_linenumber IN (4, 5)", rank(1000, 320)),
        "taxonKey": f"CASE WHEN l_linenumber = 5 THEN {rank(400, 80)} WHEN l_linenumber = 4 THEN {rank(600, 160)} ELSE {rank(1000, 320)} END",
        "year": unless("l_linenumber = 3", "CAST(year(l_shipdate) AS INT)"),
        "occurrenceStatus": "CASE l_returnflag WHEN 'R' THEN 'ABSENT' ELSE 'PRESENT' END",
        "hasGeospatialIssues": "CASE CAST(round(l_discount * 100) AS INT) WHEN 10 THEN TRUE WHEN 0 THEN NULL ELSE FALSE END",
    }


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as occurrence records. Orders and suppliers get their nations first, so line items are shuffled once if suppliers are few."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    nation = read("nation").select("n_nationkey", "n_name")
    buyers = read("orders").join(read("customer"), _on("o_custkey", "c_custkey")).join(nation, _on("c_nationkey", "n_nationkey")).select("o_orderkey", "n_name")
    suppliers = read("supplier").select("s_suppkey", "s_nationkey")
    few = suppliers.limit(BROADCAST_SUPPLIERS + 1).count() <= BROADCAST_SUPPLIERS
    sellers = suppliers.join(nation, _on("s_nationkey", "n_nationkey")).select("s_suppkey", "n_name")
    joined = read("lineitem").join(buyers.alias("cn"), _on("l_orderkey", "o_orderkey")).join((F.broadcast(sellers) if few else sellers).alias("sn"), _on("l_suppkey", "s_suppkey"))
    return joined.selectExpr(*[f"{e} AS {c}" for c, e in _columns("array", "CAST(array() AS ARRAY<STRING>)").items()])


def _on(a: str, b: str) -> Column:
    return F.col(a) == F.col(b)


def duckdb_sql() -> str:
    """The same records as a DuckDB query."""
    columns = ", ".join(f"{e} AS {c}" for c, e in _columns("list_value", "CAST([] AS VARCHAR[])").items())
    return (
        f"SELECT {columns} FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey"
        " JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey"
    )
