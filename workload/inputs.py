"""Request-shaped inputs derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqmill.session import WIDE_ROWS, apply_defaults, shared_dir, ship_package
from reqmill.sources import tables
from workload import dialects as D


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    apply_defaults(spark, WIDE_ROWS)
    ship_package(spark)
    return spark


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as requests: closed by the last shipment, in the customer's region.

    No join is hinted: the small sides broadcast by their measured size, and
    adaptive execution splits a hot key otherwise.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("closed_at"))
    return (orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.col("o_orderkey").cast("string").alias("request_id"),
                    F.col("o_orderdate").alias("created_at"), "closed_at",
                    F.col("c_mktsegment").alias("agency_code"),
                    F.col("o_orderpriority").alias("complaint_type"),
                    F.col("r_name").alias("borough"), F.col("o_orderstatus").alias("status"),
                    F.to_date("o_orderdate").alias("batch_date")))


# Landed rows: one per order line, all strings, with padding, blanks, unreadable
# values and foreign codes mixed in. The text reads the same in both engines.
LANDED = {
    "request_id": "'  ' || cast(l_orderkey as string) || ' '",
    "created_at": """case when l_orderkey % 97 = 0 then '' when l_orderkey % 89 = 0 then 'not a date'
                     when l_orderkey % 83 = 0 then substr(cast(o_orderdate as string), 1, 4)
                     else cast(o_orderdate as string) end""",
    "closed_at": """case when l_linenumber % 3 = 0 then ' '
                    else replace(cast(l_shipdate as string), ' ', 'T') || '.250' end""",
    "agency_code": "' ' || lower(o_orderpriority)",
    "agency_name": """case when l_linenumber % 5 = 0 then '  ' else o_orderpriority || ' ' || l_returnflag end""",
    "complaint_type": "case when l_partkey % 101 = 0 then '' else l_returnflag || l_linestatus end",
    "descriptor": "l_returnflag || ' '",
    "location_type": "l_linestatus",
    "postal_code": "cast(l_suppkey as string)",
    "street_address": "cast(l_partkey as string) || ' MAIN STREET'",
    "city": "case when l_suppkey % 2 = 0 then 'Queens ' else '' end",
    "borough": """case l_suppkey % 6 when 0 then 'Bronx' when 1 then ' brooklyn' when 2 then 'QUEENS'
                  when 3 then 'Manhattan ' when 4 then ' ' else 'Atlantis' end""",
    "status": """case when l_partkey % 50 = 0 then 'Lost' when o_orderstatus = 'O' then 'Open'
                 when o_orderstatus = 'F' then 'Closed' else ' Pending' end""",
    "resolution_description": "case when l_linenumber = 1 then 'done' else '' end",
    "resolution_updated_at": "case when l_linenumber = 2 then '10:00:00' else cast(l_shipdate as string) end",
    "community_board": "lpad(cast(l_suppkey % 18 as string), 2, '0') || ' BOARD'",
    "intake_channel": "case when l_linestatus = 'O' then 'online' else '' end",
    "latitude": """case when l_partkey % 71 = 0 then '88.0' when l_partkey % 73 = 0 then 'abc'
                   when l_partkey % 79 = 0 then '40.5d'
                   else ' 40.' || cast(5 + l_partkey % 4 as string) || cast(l_suppkey as string) end""",
    "longitude": "'-73.' || cast(6 + l_partkey % 4 as string) || cast(l_suppkey as string) || ' '",
    "_source_system": """case l_suppkey % 9 when 0 then 'walk_in' when 1 then 'vendor_csv'
                         when 2 then 'mobile_app_v2' when 3 then 'partner_api' else 'legacy_crm' end""",
    "_batch_date": "substr(cast(l_shipdate as string), 1, 10)",
    "_batch_id": """cast(l_linenumber as string) || '-' || cast(l_partkey as string) || '-'
                    || cast(l_suppkey as string) || '-' || cast(cast(round(l_extendedprice * 100) as bigint) as string)""",
    "_ingested_at": "replace(cast(l_shipdate as string), ' ', 'T') || '+00:00'",
}


def landed(spark: SparkSession, sf_dir: str, by: Column | None = None) -> DataFrame:
    """Order lines as landed rows; an order is landed once per line. Rows are dealt out by
    `by`, if given: before the columns are written out as strings, three times as wide."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    # The join deals large tables out by this key anyway.
    rows = lines.repartition("l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if by is not None:
        read = " ".join(LANDED.values())
        rows = rows.select(*[c for c in rows.columns if c in read], by.alias("_by")).hint("rebalance", "_by")
    return rows.selectExpr(*[f"{sql} as {name}" for name, sql in LANDED.items()])


_landings: dict[tuple[str, str], str] = {}


def stored_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed rows as the table that a run builds its models from. It is an input: a
    session writes it once for each set of tables. It is not partitioned by batch date, as
    a run's landing is: these rows would be thousands of batches of a few rows."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landings:
        path = f"{shared_dir(spark)}/landing"
        # A split is whole row groups: small ones, so that splits can be (WIDE_ROWS).
        landed(spark, sf_dir).write.option("parquet.block.size", 16 << 20).option("compression", "zstd").parquet(path)
        _landings[key] = path
    return tables.read_landing(spark, _landings[key])


# Orders in the shape the source serves: all strings, source column names.
SOURCE = {
    "unique_key": "lpad(cast(o_orderkey as string), 12, '0')",
    "created_date": "replace(cast(o_orderdate as string), ' ', 'T') || '.000'",
    "closed_date": "case when o_orderstatus = 'O' then '' else replace(cast(o_orderdate as string), ' ', 'T') || '.000' end",
    "agency": "substr(o_orderpriority, 1, 1)",
    "agency_name": "o_orderpriority",
    "complaint_type": "'say \"' || o_orderpriority || '\", twice'",
    "descriptor": "o_orderstatus",
    "location_type": "case when o_custkey % 2 = 0 then 'Street' else '' end",
    "incident_zip": "cast(10000 + o_custkey as string)",
    "incident_address": "cast(o_custkey as string) || ' MAIN' || chr(10) || 'STREET, REAR'",
    "city": "'CITY'",
    "borough": "'BRONX'",
    "status": "case when o_orderstatus = 'O' then 'Open' else 'Closed' end",
    "resolution_description": "''",
    "resolution_action_updated_date": "''",
    "community_board": "'01 BOARD'",
    "open_data_channel_type": "'ONLINE'",
    "latitude": "'40.7'",
    "longitude": "'-73.9'",
}


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        *[f"{sql} as {name}" for name, sql in SOURCE.items()])


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a feed with one of the four header dialects, in rows of
    (source_system, dialect, ordinal, source_column, expected)."""
    names = F.array(*[F.lit(s) for s in D.HEADERS])
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("source_system"),
        F.element_at(names, (F.col("s_suppkey") % len(D.HEADERS) + 1).cast("int")).alias("dialect"))
    # 83 fixed rows.
    headers = F.broadcast(D.dialect_table(spark).withColumnsRenamed(
        {"header": "source_column", "canonical_field": "expected"}))
    return suppliers.join(headers, "dialect")


# Headers that differ by what the parts are called: a system for each brand, a header
# for each of its part names with a word by size, in one of four spellings. Some come
# near a field, some don't.
_WORD = """case p_size % 8 when 0 then 'status' when 1 then 'date' when 2 then 'borough' when 3 then 'agency'
  when 4 then 'type' when 5 then 'id' when 6 then 'city' else 'latitude' end"""
PART_HEADER = f"""case length(p_name) % 4
  when 0 then replace(initcap(p_name), ' ', '') || upper(substr({_WORD}, 1, 1)) || substr({_WORD}, 2) when 1 then upper(replace(p_name, ' ', '_')) || '_' || upper({_WORD})
  when 2 then split_part(p_name, ' ', 1) || ' ' || {_WORD} else {_WORD} || ' ' || substr(p_name, 1, 2) end"""
PART_FIELD = "case p_size % 8 when 0 then 'status' when 2 then 'borough' when 7 then 'latitude' end"


def part_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_system, ordinal, source_column, canonical_field)."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_brand as source_system", "cast(p_partkey as int) as ordinal", f"{PART_HEADER} as source_column",
        f"{PART_FIELD} as canonical_field")


def feed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds(spark, sf_dir).select("source_system", "ordinal", "source_column")


def _per_feed(spark: SparkSession, sf_dir: str, rows: list[tuple], schema: str) -> DataFrame:
    fixed = F.broadcast(spark.createDataFrame(rows, schema))
    suppliers = feeds(spark, sf_dir).select("source_system", "dialect", "source_column")
    return suppliers.join(fixed, ["dialect", "source_column"]).drop("dialect")


def feed_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_feed(spark, sf_dir, D.OVERRIDES,
                     "dialect string, source_column string, canonical_field string")


# Proposals per dialect: accepted, low, unknown field, no field, displaced by a
# later fuzzy match, refused against an exact match, repeated.
PROPOSALS = [
    ("legacy_crm", "INTK_SRC", 0, "intake_channel", 0.93, "intake source"),
    ("legacy_crm", "DESCR", 0, "borough", 0.11, "unsure"),
    ("legacy_crm", "LOC_TYP", 0, "place_kind", 0.99, "no such field"),
    ("legacy_crm", "ROW_CHECKSUM", 0, None, 0.97, "audit column"),
    ("legacy_crm", "RES_TXT", 0, "created_at", 0.85, "taken for a date"),
    ("vendor_csv", "Issue Detail", 0, "status", 0.75, "first thought"),
    ("vendor_csv", "Issue Detail", 1, "descriptor", 0.88, "second thought"),
    ("vendor_csv", "Export Timestamp", 0, "created_at", 0.99, "looks like a date"),
    ("mobile_app_v2", "assignedAgencyLabel", 0, "agency_name", 0.8, "label of the agency"),
    ("mobile_app_v2", "siteKind", 0, "location_type", None, "no confidence given"),
]


def feed_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_feed(spark, sf_dir, PROPOSALS,
                     "dialect string, source_column string, ordinal int, canonical_field string, "
                     "confidence double, reasoning string")
