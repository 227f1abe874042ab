"""What each query must return, as SQL over the given tables."""

from __future__ import annotations

ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
TALKS = ("conv_id", "turn", "role", "text")
LINES = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
EVENTS = ("event_id", "ts", "user_id", "event_type", "value", "props")

YEAR = "CAST(year(o_orderdate) AS VARCHAR) AS o_year"

ORDER_CHANGES = """
SELECT CASE WHEN o_orderstatus = 'F' THEN -o_orderkey ELSE o_orderkey END AS o_orderkey,
       o_custkey + 1 AS o_custkey,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN 'X' END AS o_orderstatus,
       o_totalprice * 2 AS o_totalprice,
       CASE WHEN o_orderpriority = '5-LOW' THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END AS o_orderdate,
       CASE WHEN o_orderpriority <> '2-HIGH' THEN lower(o_orderpriority) END AS o_orderpriority
FROM orders
"""


def blanks(old: str, new: str, more: str = "") -> str:
    """All orders with status `old`, and the urgent ones again with new keys and status `new`."""
    others = "o_custkey, o_totalprice, o_orderdate, o_orderpriority"
    return f"""
        SELECT o_orderkey, {others}, {old} AS o_orderstatus{more} FROM orders
        UNION ALL
        SELECT -o_orderkey, {others}, {new}{more} FROM orders WHERE o_orderpriority = '1-URGENT'"""


def merged(old: str, new: str, keys: tuple[str, ...], columns: tuple[str, ...]) -> str:
    picked = ", ".join(f"coalesce(t.{c}, s.{c}) AS {c}" for c in columns)
    on = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return f"SELECT {picked} FROM ({old}) s FULL OUTER JOIN ({new}) t ON {on}"


MERGED_ORDERS = merged("SELECT * FROM orders", ORDER_CHANGES, ("o_orderkey",), ORDERS)
MERGED_UPPER_HALF = merged(
    "SELECT * FROM orders",
    f"""SELECT * FROM ({ORDER_CHANGES})
        WHERE o_orderkey < 0 OR o_orderkey > (SELECT quantile_cont(o_orderkey, 0.5) FROM orders)""",
    ("o_orderkey",),
    ORDERS,
)
ORDERS_AND_YEAR = f"SELECT *, {YEAR} FROM orders"
HOURS = """
    SELECT event_id, CASE WHEN event_type = 'purchase' THEN -value ELSE value END AS value,
           date_trunc('hour', ts) AS hour
    FROM events"""
ALL_ORDERS = "SELECT * FROM orders"

ORACLE: dict[str, str] = {
    "scan_parquet": ALL_ORDERS,
    "scan_orc": ALL_ORDERS,
    "scan_csv_inferred": """
        SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer""",
    "typed_ingest": """
        SELECT o_orderkey, date_trunc('second', o_orderdate) AS insert_ts, CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_totalprice AS DECIMAL(20, 7)) AS price, o_totalprice > 100000 AS is_large
        FROM orders""",
    "scalars_to_text": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts,
               CAST(user_id AS VARCHAR) AS user_id, event_type,
               CAST(value AS VARCHAR) AS value, props
        FROM events""",
    "text_to_typed": "SELECT * FROM events",
    "nested_to_json": """
        SELECT c_custkey,
               CAST(to_json({'key': c_custkey, 'name': c_name}) AS VARCHAR) AS as_struct,
               CAST(to_json([c_custkey, c_nationkey]) AS VARCHAR) AS as_array,
               CAST(to_json(MAP {c_mktsegment: c_nationkey}) AS VARCHAR) AS as_map
        FROM customer""",
    "keep_nested": """
        SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS position, embedding[i] AS component
        FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
    "derived_partition": ORDERS_AND_YEAR,
    "partition_columns_last": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus, o_orderpriority
        FROM orders""",
    "write_formats": """
        SELECT customer.*, file_format
        FROM customer, (VALUES ('orc'), ('parquet'), ('json'), ('csv')) AS f(file_format)""",
    "write_formats_events": """
        SELECT events.*, file_format
        FROM events, (VALUES ('orc'), ('parquet'), ('json'), ('csv')) AS f(file_format)""",
    "write_formats_documents": """
        SELECT documents.*, file_format
        FROM documents, (VALUES ('orc'), ('parquet'), ('json'), ('csv')) AS f(file_format)""",
    "write_bucketed": ALL_ORDERS,
    "write_bucketed_partitioned": ALL_ORDERS,
    "write_repartitioned": ALL_ORDERS,
    "overwrite_managed": ALL_ORDERS,
    "overwrite_managed_partitioned": ORDERS_AND_YEAR,
    "overwrite_external": ALL_ORDERS,
    "overwrite_external_partitioned": ORDERS_AND_YEAR,
    "overwrite_external_in_dynamic_session": ORDERS_AND_YEAR,
    "append_missing_table": "SELECT * FROM customer",
    "append_existing": """
        SELECT * FROM customer
        UNION ALL
        SELECT * REPLACE (-c_custkey AS c_custkey) FROM customer""",
    "append_partitioned": f"""
        SELECT *, {YEAR} FROM (
            SELECT * FROM orders
            UNION ALL
            SELECT * REPLACE (-o_orderkey AS o_orderkey, o_orderdate + INTERVAL 400 DAY AS o_orderdate)
            FROM orders)""",
    "merge_missing_table": ORDER_CHANGES,
    "merge_managed": MERGED_ORDERS,
    "merge_managed_partitioned": f"SELECT *, {YEAR} FROM ({MERGED_ORDERS})",
    "merge_external": MERGED_ORDERS,
    "merge_external_partitioned": MERGED_ORDERS,
    "merge_by_file": MERGED_UPPER_HALF,
    "merge_by_file_external": MERGED_UPPER_HALF,
    "merge_rewriting_all_in_dynamic_session": MERGED_ORDERS,
    "merge_timestamp_partition": HOURS,
    "merge_timestamp_partition_external": HOURS,
    "merge_emptied_partitions": """
        SELECT * REPLACE (CASE WHEN event_type = 'click' THEN 'view' ELSE event_type END AS event_type),
               strftime(ts, '%Y-%m-%d') AS day, CAST(0 AS BIGINT) AS days_left
        FROM events""",
    "write_csv_in_files_of_bounded_size": """
        SELECT *, (SELECT sum(strlen(text)) FROM documents) > 256 * 1024 AS in_several_files FROM documents""",
    "merge_bucketed": MERGED_ORDERS,
    "merge_broadcast": MERGED_ORDERS,
    "merge_broadcast_partitioned": f"SELECT *, {YEAR} FROM ({MERGED_ORDERS})",
    "merge_partition_follows_key": f"""
        SELECT *, CAST(CAST(trunc(o_orderkey / 5000) AS BIGINT) AS VARCHAR) AS key_range
        FROM ({MERGED_ORDERS})""",
    "merge_empty_partition_text": blanks("CASE WHEN o_orderstatus = 'O' THEN 'O' END", "NULL"),
    "merge_empty_partition_text_external": blanks("CASE WHEN o_orderstatus = 'O' THEN 'O' END", "NULL"),
    "merge_empty_derived_text": blanks(
        "CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN 'O' END", "''", ", CAST(NULL AS VARCHAR) AS tail"
    ),
    "merge_two_partition_columns": MERGED_ORDERS,
    "append_then_merge_derived": f"SELECT *, {YEAR} FROM ({MERGED_ORDERS})",
    "merge_composite_key": merged(
        "SELECT * FROM conversations",
        """SELECT conv_id, CASE WHEN role = 'user' THEN turn ELSE turn + 1000 END AS turn,
                  CASE WHEN turn > 0 THEN upper(role) END AS role, lower(text) AS text
           FROM conversations""",
        ("conv_id", "turn"),
        TALKS,
    ),
    "merge_null_update": merged(
        "SELECT * FROM orders",
        """SELECT CASE WHEN o_orderstatus = 'F' THEN -o_orderkey ELSE o_orderkey END AS o_orderkey,
                  CAST(NULL AS BIGINT) AS o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus,
                  CAST(NULL AS DOUBLE) AS o_totalprice, CAST(NULL AS TIMESTAMP) AS o_orderdate,
                  CAST(NULL AS VARCHAR) AS o_orderpriority
           FROM orders""",
        ("o_orderkey",),
        ORDERS,
    ),
    "merge_null_keys": merged(
        "SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey) FROM orders",
        """SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey,
                             lower(o_orderstatus) AS o_orderstatus)
           FROM orders""",
        ("o_orderkey",),
        ORDERS,
    ),
    "merge_duplicate_keys": merged(
        "SELECT * FROM lineitem",
        """SELECT * REPLACE (CASE WHEN l_returnflag <> 'N' THEN l_quantity * 2 END AS l_quantity,
                             lower(l_linestatus) AS l_linestatus)
           FROM lineitem""",
        ("l_orderkey", "l_linenumber"),
        LINES,
    ),
    "merge_hot_key": merged(
        """SELECT CASE WHEN event_type = (SELECT min(event_type) FROM events) THEN -1 ELSE event_id END AS event_id,
                  ts, user_id, event_type, value, props
           FROM events""",
        """SELECT CASE WHEN event_type = (SELECT max(event_type) FROM events) THEN -2 ELSE event_id END AS event_id,
                  ts, user_id, event_type, props,
                  CASE WHEN event_type <> (SELECT max(event_type) FROM events) THEN -value END AS value
           FROM events""",
        ("event_id",),
        EVENTS,
    ),
    "merge_hot_on_both_sides": merged(
        "SELECT event_id // 8 AS event_id, ts, user_id, event_type, value, props FROM events",
        """SELECT event_id // 8 AS event_id, ts, user_id, event_type, props,
                  CASE WHEN user_id % 2 = 0 THEN -value END AS value
           FROM events""",
        ("event_id",),
        EVENTS,
    ),
    "register_files": ALL_ORDERS,
    "register_partitioned": ORDERS_AND_YEAR,
    "discover_partitions": """
        SELECT 1 AS level, 'o_orderstatus' AS name, o_orderstatus AS value, count(*) AS n_rows
        FROM orders GROUP BY o_orderstatus
        UNION ALL
        SELECT 2, 'o_year', CAST(year(o_orderdate) AS VARCHAR), count(*)
        FROM orders GROUP BY year(o_orderdate)""",
    "describe_ddl": " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS declared_type, '{kind}' AS read_type, "
        f"'{section}' AS section, count({expression}) AS n_values FROM orders"
        for name, kind, section, expression in (
            ("o_orderkey", "bigint", "body", "o_orderkey"),
            ("o_custkey", "bigint", "body", "o_custkey"),
            ("o_orderstatus", "string", "body", "o_orderstatus"),
            ("o_totalprice", "double", "body", "o_totalprice"),
            ("o_orderdate", "timestamp_ntz", "body", "o_orderdate"),
            ("o_orderpriority", "string", "body", "o_orderpriority"),
            ("o_year", "string", "partition", "year(o_orderdate)"),
        )
    ),
    "relocate_dataset": ORDERS_AND_YEAR,
    "catalog_lifecycle": "SELECT *, 'false,true' AS tables_seen FROM orders",
}
