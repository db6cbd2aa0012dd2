"""SQL with the same results as the queries; {names} are the views of `fixtures`."""

from tidemark.sources import synthetic

_SCD2_EVENTS = """
    SELECT id, event_type, value, props, operation_date AS "__START_AT", ended AS "__END_AT"
    FROM (SELECT *, lead(operation_date) OVER (PARTITION BY id ORDER BY operation_date) AS ended FROM {clean})
    WHERE operation <> 'DELETE'"""

# a version opens on a new key, after a delete, or when the event type changes; deletes close
_TRACK_TYPE = """
    SELECT id, last(event_type ORDER BY operation_date) AS event_type, last(value ORDER BY operation_date) AS value,
           last(props ORDER BY operation_date) AS props, min(operation_date) AS "__START_AT",
           last(ended ORDER BY operation_date) AS "__END_AT"
    FROM (SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY operation_date) AS island
          FROM (SELECT *, CASE WHEN lag(operation) OVER w IS NULL OR lag(operation) OVER w = 'DELETE'
                               OR operation = 'DELETE' OR lag(event_type) OVER w IS DISTINCT FROM event_type
                          THEN 1 ELSE 0 END AS opens,
                       lead(operation_date) OVER w AS ended
                FROM {clean} WINDOW w AS (PARTITION BY id ORDER BY operation_date)))
    WHERE operation <> 'DELETE' GROUP BY id, island"""

_SCD1 = """
    SELECT id, event_type, value, props
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY operation_date DESC) AS rn FROM {clean})
    WHERE rn = 1 AND operation <> 'DELETE'"""



def _draw(what: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5('{what}:{seed}:' || number), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE)"


def _choice(what: str, words: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{word}'" for word in words)
    return f"[{listed}][floor({_draw(what)} * {len(words)})::BIGINT + 1]"


def _operation(seed: int) -> str:
    total, reached, cases = sum(weight for _, weight in synthetic.OPERATION_WEIGHTS), 0.0, ""
    for word, weight in synthetic.OPERATION_WEIGHTS:
        reached += weight / total
        cases += f" WHEN {_draw('operation', seed)} < {reached!r}::DOUBLE THEN " + (f"'{word}'" if word else "NULL")
    return f"CASE{cases} END"


def _identifier(what: str, number: str = "number") -> str:
    digest = f"md5('{what}:42:' || {number})"
    return " || '-' || ".join(f"substr({digest}, {at}, {size})" for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


def _time(what: str) -> str:
    seconds = f"floor({_draw(what)} * {synthetic.FEED_SECONDS})::BIGINT"
    return f"strftime(TIMESTAMP '{synthetic.FEED_START}' + to_seconds({seconds}), '%m-%d-%Y %H:%M:%S')"


_PEOPLE = f"""
    SELECT number, CASE WHEN {_draw("missing")} >= 0.02::DOUBLE THEN {_identifier("customer", "WHO")} END AS id,
           {_choice("first", synthetic.FIRST_NAMES)} AS firstname, {_choice("last", synthetic.LAST_NAMES)} AS lastname,
           lower(firstname || '.' || lastname || '@example.com') AS email,
           (floor({_draw("house")} * 999)::BIGINT + 1) || ' ' || {_choice("street", synthetic.STREETS)} || chr(10)
             || lpad(floor({_draw("postal")} * 100000)::BIGINT::VARCHAR, 5, '0') AS address,
           {_operation(42)} AS operation, {_time("changed")} AS operation_date
    FROM (SELECT event_id AS number FROM events)"""
_CUSTOMERS = _PEOPLE.replace("WHO", "(number // 3)")

_BOUGHT = f"""
    SELECT number, CASE WHEN {_draw("missing tx")} >= 0.02::DOUBLE THEN {_identifier("transaction")} END AS id,
           {_time("bought")} AS transaction_date, round({_draw("amount")} * 1000) AS amount,
           round({_draw("items")} * 10) AS item_count, {_operation(43)} AS operation, {_time("tx changed")} AS operation_date,
           CASE WHEN {_draw("missing")} >= 0.02::DOUBLE THEN {_identifier("customer")} END AS customer_id
    FROM (SELECT o_orderkey AS number FROM orders)"""

# copies of (id, time) leave the greatest (is delete, payload)
_GENERATED = f"""
    SELECT id, firstname, lastname, email, address, happened AS "__START_AT", ended AS "__END_AT"
    FROM (SELECT *, lead(happened) OVER (PARTITION BY id ORDER BY happened) AS ended
          FROM (SELECT * FROM (SELECT *, strptime(operation_date, '%m-%d-%Y %H:%M:%S') AS happened FROM ({_CUSTOMERS}))
                WHERE id IS NOT NULL AND operation IN ('APPEND', 'DELETE', 'UPDATE')
                QUALIFY row_number() OVER (PARTITION BY id, happened ORDER BY operation = 'DELETE' DESC, firstname DESC,
                                           lastname DESC, email DESC, address DESC) = 1))
    WHERE operation <> 'DELETE'"""

_DAILY = """
    SELECT CAST(tpep_pickup_datetime AS DATE) AS trip_date, count(*) AS trip_count,
           CAST(round(CAST(CAST(sum(CAST(fare_amount AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS DECIMAL(20,6)), 2)
                AS DOUBLE) AS avg_fare_amount,
           CAST(round(CAST(CAST(sum(CAST(trip_distance AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS DECIMAL(20,6)), 3)
                AS DOUBLE) AS avg_trip_distance,
           CAST(round(CAST(CAST(sum(CAST(passenger_count AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS DECIMAL(20,6)), 2)
                AS DOUBLE) AS avg_passenger_count
    FROM {clean_trips} GROUP BY 1"""

_TRIPS = "SELECT * REPLACE (CAST(passenger_count AS INTEGER) AS passenger_count, CAST(vendor_id AS INTEGER) AS vendor_id, CAST(pu_location_id AS INTEGER) AS pu_location_id, CAST(do_location_id AS INTEGER) AS do_location_id)"

_ORDER_TIES = """
    SELECT o_custkey, last(o_orderstatus ORDER BY o_orderdate) AS o_orderstatus,
           last(o_totalprice ORDER BY o_orderdate) AS o_totalprice,
           last(o_orderpriority ORDER BY o_orderdate) AS o_orderpriority,
           min(o_orderdate) AS "__START_AT", last(ended ORDER BY o_orderdate) AS "__END_AT"
    FROM (SELECT *, sum(opens) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS island
          FROM (SELECT *, CASE WHEN lag(gone) OVER w IS NULL OR lag(gone) OVER w OR gone
                               OR lag(o_orderstatus) OVER w <> o_orderstatus THEN 1 ELSE 0 END AS opens,
                       lead(o_orderdate) OVER w AS ended
                FROM (SELECT *, o_orderpriority = '5-LOW' AS gone,
                             row_number() OVER (PARTITION BY o_custkey, o_orderdate
                                                ORDER BY o_orderpriority = '5-LOW' DESC, o_orderstatus DESC,
                                                         o_totalprice DESC, o_orderpriority DESC) AS rn FROM orders)
                WHERE rn = 1 WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)))
    WHERE NOT gone GROUP BY o_custkey, island"""

_CUSTOMER_HISTORY = """
    SELECT *, started AS "__START_AT", ended AS "__END_AT", 'test' AS environment_name, 'orders' AS source_table_name
    FROM {customer_history}"""

_MATCH = """
    SELECT customer_id, priority, CAST(coalesce(b.n, 0) AS BIGINT) AS expected_rows,
           CAST(coalesce(a.n, 0) AS BIGINT) AS found_rows,
           CASE WHEN a.n IS NULL THEN 'missing' WHEN b.n IS NULL THEN 'unexpected'
                WHEN b.status IS DISTINCT FROM a.status OR b.orders IS DISTINCT FROM a.orders THEN 'different'
                ELSE 'matched' END AS status
    FROM (SELECT *, 1 AS n FROM {before}) b FULL OUTER JOIN (SELECT *, 1 AS n FROM {after}) a
    USING (customer_id, priority)"""

_AUDIT_MASK = """
    SELECT 'column_mask' AS step, '%(column)s' AS target, CASE WHEN hit = n THEN 'OK' ELSE 'FAIL' END AS status,
           'rows seen ' || seen || ', masked ' || hit || ' of ' || n AS message,
           'contacts' AS pipeline_name, 'MASK %(column)s WITH %(mask)s' AS query_statement
    FROM (SELECT count(*) AS seen, count(c.%(column)s) AS n,
                 count(CASE WHEN c.%(column)s IS DISTINCT FROM m.%(column)s THEN 1 END) AS hit
          FROM {contacts} c JOIN {masked} m USING (customer_id))"""

_AUDIT = " UNION ALL ".join(
    _AUDIT_MASK % {"column": column, "mask": mask}
    for column, mask in (
        ("email_address", "mask_email"),
        ("phone_number", "mask_phone"),
        ("full_name", "mask_name"),
        ("address", "mask_address"),
        ("postal_zip_code", "mask_postal_code"),
    )
) + """ UNION ALL
    SELECT 'row_filter', 'country', 'OK', 'rows seen ' || count(*) || ', hidden '
           || count(CASE WHEN country NOT IN ('NATION_1', 'NATION_2', 'NATION_3') THEN 1 END) || ' of ' || count(*),
           'contacts', 'KEEP country IN (''NATION_1'', ''NATION_2'', ''NATION_3'')'
    FROM {contacts}"""

ORACLES = {
    "expect_drop": "SELECT * FROM {clean}",
    "expect_metrics": """
        SELECT 'valid_id' AS rule, count(id) AS passed, count(*) - count(id) AS failed FROM {feed} UNION ALL
        SELECT 'valid_operation', count(operation), count(*) - count(operation) FROM {feed}""",
    "expect_rejected": """
        SELECT *, concat_ws(',', CASE WHEN id IS NULL THEN 'valid_id' END,
                                 CASE WHEN operation IS NULL THEN 'valid_operation' END) AS failed_rules
        FROM {feed} WHERE id IS NULL OR operation IS NULL""",
    "trip_conform": f"{_TRIPS} FROM {{trips}}",
    "trip_clean": f"{_TRIPS} FROM {{clean_trips}}",
    "trip_daily_summary": _DAILY,
    "trip_stream_medallion": _DAILY,
    "scd1": _SCD1,
    "stream_scd1": _SCD1,
    "scd1_map_payload": f"SELECT id, event_type, props FROM ({_SCD1})",
    "scd2_map_payload": f'SELECT id, event_type, props, "__START_AT", "__END_AT" FROM ({_SCD2_EVENTS})',
    "scd1_ignore_nulls": """
        SELECT id, event_type, value, props
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY operation_date DESC) AS rn FROM {sparse_filled})
        WHERE rn = 1 AND NOT gone""",
    "scd2_events": _SCD2_EVENTS,
    "scd2_track_except": _TRACK_TYPE,
    "stream_scd2": _TRACK_TYPE,
    "scd2_coalesced": f'SELECT id, event_type, "__START_AT", "__END_AT" FROM ({_TRACK_TYPE})',
    "scd2_ignore_nulls": """
        SELECT id, event_type, value, props, operation_date AS "__START_AT", ended AS "__END_AT"
        FROM (SELECT *, lead(operation_date) OVER (PARTITION BY id ORDER BY operation_date) AS ended
              FROM {sparse_filled}) WHERE NOT gone""",
    "scd2_ties": _ORDER_TIES,
    "scd2_current": f"""
        SELECT id, event_type, value, props, "__START_AT" AS record_effective_from, "__END_AT" AS record_effective_to
        FROM ({_TRACK_TYPE}) WHERE "__END_AT" IS NULL""",
    "scd2_snapshot": "SELECT * FROM {yearly_history}",
    "scd2_snapshot_history": "SELECT * FROM {yearly_history}",
    "change_feed": """
        WITH p AS (SELECT customer_id, priority, b.status AS bs, b.orders AS bo, a.status AS s, a.orders AS o,
                          b.customer_id IS NULL AS is_new, a.customer_id IS NULL AS is_gone
                   FROM {before} b FULL OUTER JOIN {after} a USING (customer_id, priority)),
        c AS (SELECT * FROM p WHERE NOT is_new AND NOT is_gone AND (bs IS DISTINCT FROM s OR bo IS DISTINCT FROM o))
        SELECT customer_id, priority, 'insert' AS _change_type, s AS status, o AS orders FROM p WHERE is_new UNION ALL
        SELECT customer_id, priority, 'delete', bs, bo FROM p WHERE is_gone UNION ALL
        SELECT customer_id, priority, 'update_preimage', bs, bo FROM c UNION ALL
        SELECT customer_id, priority, 'update_postimage', s, o FROM c""",
    "normalize_customers": """
        SELECT *, 'test' AS environment_name, 'orders' AS source_table_name FROM {normalized}""",
    "record_hash": "SELECT DISTINCT customer_id, changed_at, record_hash FROM {normalized}",
    "customer_history": f"SELECT * EXCLUDE (started, ended) FROM ({_CUSTOMER_HISTORY})",
    "customer_stream_history": f"SELECT * EXCLUDE (started, ended) FROM ({_CUSTOMER_HISTORY})",
    "current_customers": f"""
        SELECT * EXCLUDE (started, ended, record_hash, "__START_AT", "__END_AT"),
               "__START_AT" AS record_effective_from, "__END_AT" AS record_effective_to
        FROM ({_CUSTOMER_HISTORY}) WHERE ended IS NULL""",
    "geo_summary": """
        SELECT continent, country, state, count(*) AS customer_count, count(DISTINCT city) AS distinct_city_count,
               max(started) AS latest_dimension_change_ts
        FROM {customer_history} WHERE ended IS NULL GROUP BY 1, 2, 3""",
    "snapshot_customers": """
        SELECT * EXCLUDE (changed_at, rn), 'test' AS environment_name, 'orders' AS source_table_name
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY city DESC) AS rn FROM {normalized})
        WHERE rn = 1""",
    "dedupe_orders": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                    ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
    "mask_columns": "SELECT * FROM {masked}",
    "mask_sql_functions": "SELECT * FROM {masked}",
    "secured_view": "SELECT * FROM {masked}",
    "secured_view_admin": "SELECT * FROM {contacts}",
    "row_filter": """
        SELECT * FROM {contacts} WHERE country IN (SELECT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
                                                   WHERE s_acctbal < 0)""",
    "policy_masks": "SELECT * FROM {masked} WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3')",
    "policy_scope": """
        SELECT m.customer_id, m.email_address, m.phone_number, c.full_name, 'main.gold.contacts' AS place
        FROM {masked} m JOIN {contacts} c ON c.customer_id = m.customer_id
        UNION ALL SELECT m.customer_id, c.email_address, m.phone_number, c.full_name, 'main.silver.contacts'
        FROM {masked} m JOIN {contacts} c ON c.customer_id = m.customer_id""",
    "protection_audit": _AUDIT,
    "audit_summary": f"SELECT step, status, count(*) AS controls FROM ({_AUDIT}) GROUP BY 1, 2",
    "reconcile": _MATCH,
    "reconcile_repeated_keys": """
        WITH r AS (SELECT customer_id, priority, status, sum(e) AS e, sum(f) AS f
                   FROM (SELECT customer_id, priority, status, 1 AS e, 0 AS f FROM {before} UNION ALL
                         SELECT customer_id, priority, status, 0, 1 FROM {after}) GROUP BY 1, 2, 3)
        SELECT customer_id, CAST(sum(e) AS BIGINT) AS expected_rows, CAST(sum(f) AS BIGINT) AS found_rows,
               CASE WHEN sum(f) = 0 THEN 'missing' WHEN sum(e) = 0 THEN 'unexpected'
                    WHEN bool_or(e <> f) THEN 'different' ELSE 'matched' END AS status
        FROM r GROUP BY 1""",
    "reconcile_summary": f"SELECT status, count(*) AS keys FROM ({_MATCH}) GROUP BY 1",
    "zip_rows": """
        SELECT p_name, p_partkey, o_orderdate, o_orderkey, o_totalprice, p.n AS _position
        FROM (SELECT *, row_number() OVER (ORDER BY p_name, p_partkey) AS n FROM part) p
        JOIN (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders) o USING (n)""",
    "named_parameters": """
        SELECT 'main' || '.' || 'landing' || '.' || o_orderpriority AS path, count(*) AS orders
        FROM orders GROUP BY o_orderpriority""",
    "cdc_family": f"""
        WITH o AS (SELECT o_custkey AS id, o_orderstatus, o_orderdate AS moment, o_orderpriority = '1-URGENT' AS gone
                   FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate
                                ORDER BY o_orderpriority = '1-URGENT' DESC, o_orderstatus DESC) AS rn FROM orders)
                   WHERE rn = 1),
        m AS (SELECT *, CASE WHEN lag(gone) OVER w IS NULL OR lag(gone) OVER w OR gone
                             OR lag(o_orderstatus) OVER w <> o_orderstatus THEN 1 ELSE 0 END AS opens,
                     lead(moment) OVER w AS ended FROM o WINDOW w AS (PARTITION BY id ORDER BY moment)),
        h AS (SELECT id, min(moment) AS valid_from, last(ended ORDER BY moment) AS valid_to
              FROM (SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY moment) AS island FROM m)
              WHERE NOT gone GROUP BY id, island)
        SELECT 'orders.scd2' AS target, id, valid_from, valid_to FROM h UNION ALL
        SELECT 'orders.scd1', id, NULL, NULL FROM h WHERE valid_to IS NULL UNION ALL
        SELECT 'users.scd2', id, "__START_AT", "__END_AT" FROM ({_TRACK_TYPE}) UNION ALL
        SELECT 'users.scd1', id, NULL, NULL FROM ({_SCD1})""",
    "json_ingest_rescue": """
        SELECT CASE WHEN event_type <> 'view' THEN event_id END AS event_id,
               CASE WHEN event_type NOT IN ('view', 'error') THEN user_id END AS user_id,
               CASE WHEN event_type <> 'view' THEN event_type END AS event_type,
               CASE WHEN event_type <> 'view' THEN value END AS value,
               CASE event_type WHEN 'view' THEN '{"event_id":'
                   WHEN 'error' THEN '{"event_id":' || event_id || ',"user_id":"u' || user_id || '"' END AS rescued
        FROM events""",
    "csv_ingest": "SELECT *, NULL::VARCHAR AS _rescued_data FROM lineitem",
    "csv_by_name": """
        SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value,
               CASE WHEN event_type = 'view' THEN '{"mark":"' || event_id % 7 || '"}' END AS _rescued_data
        FROM events""",
    "csv_by_name_stream": """
        SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value,
               CASE WHEN event_type = 'view' THEN event_id % 7 END AS mark, NULL::VARCHAR AS _rescued_data
        FROM events""",
    "file_ledger": """
        SELECT c_custkey % 5 AS delivery, CASE WHEN c_custkey % 5 = 3 THEN 'rewritten' ELSE 'unchanged' END AS status,
               count(*) AS customers, max(c_acctbal) AS most
        FROM customer GROUP BY ALL""",
    "json_nested_rescue": """
        SELECT event_id, 2 AS items, event_type AS kind,
               '{"a.y":"' || user_id || '","items[1].z":"' || event_id % 5 || '"}' AS rescued
        FROM events""",
    "late_columns": """
        SELECT event_id, user_id,
               CASE WHEN event_type IN ('click', 'view') THEN '{"event_type":"' || event_type || '"}' END AS _rescued_data
        FROM events""",
    "schema_evolution": """
        SELECT event_id, user_id, event_type, value, CASE WHEN event_type IN ('click', 'view') THEN props END AS props
        FROM events""",
    "family_metrics": """
        SELECT 'users' AS name, 'valid_id' AS rule, count(id) AS passed, count(*) - count(id) AS failed FROM {feed} UNION ALL
        SELECT 'users', 'valid_operation', count(operation), count(*) - count(operation) FROM {feed} UNION ALL
        SELECT name, rule, count(*), 0 FROM orders, (VALUES ('orders'), ('late')) n (name),
               (VALUES ('valid_id'), ('valid_operation')) r (rule) GROUP BY ALL""",
    "dataset_properties": """
        SELECT o_orderpriority, count(*) AS orders, 'gold' AS quality, 'sales' AS owner,
               'Orders by priority; it''s counted' AS comment FROM orders GROUP BY o_orderpriority""",
    "clustered_write": "SELECT * FROM lineitem",
    "stream_current": f'SELECT * FROM ({_TRACK_TYPE}) WHERE "__END_AT" IS NULL',
    "batch_csv": "SELECT *, NULL::VARCHAR AS _rescued_data FROM supplier",
    "range_source": "SELECT unnest(range((SELECT count(*) FROM orders))) AS number",
    "local_rows": """
        SELECT label, count(*) AS orders
        FROM orders JOIN (VALUES ('1-URGENT', 'now'), ('2-HIGH', 'soon'), ('5-LOW', 'later')) AS v (code, label)
          ON o_orderpriority = code
        GROUP BY label""",
    "top_orders": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    "load_stamp": "SELECT count(*) AS trips, count(*) AS stamped, 1::BIGINT AS stamps FROM lineitem",
    "generate_customer_changes": _CUSTOMERS,
    "generate_transaction_changes": _BOUGHT,
    "generated_feed_scd2": _GENERATED,
}
