"""The same queries as ANSI SQL for an independent engine (DuckDB) over the
raw benchmark tables.  Built from named CTEs; ``sql(body, *ctes)`` pulls in
every CTE a body needs, in dependency order.

Deterministic choices mirror the Spark side: dedup keeps the first row
under ORDER BY <recency cols> DESC NULLS LAST, then every other column;
surrogate keys are ROW_NUMBER() over the natural key.
"""

from __future__ import annotations

from martlake.contracts import NOT_NULL, VARCHAR_LIMITS

TS = "'%Y-%m-%d %H:%M:%S.%f'"


def ts(x: str) -> str:
    return f"strftime({x}, {TS})"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


MD5_ID = "CAST(concat('0x', substr(md5({e}), 1, 15)) AS BIGINT)"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


# -- fixture feeds over the benchmark tables --------------------------------
cte("web_orders", """SELECT l_orderkey * 10 + l_linenumber AS order_id, o_custkey AS customer_id,
  CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_partkey END AS product_id,
  CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST(l_quantity AS INT) - 2 END AS quantity,
  CAST(l_extendedprice AS DECIMAL(10,2)) AS total_amount,
  CASE WHEN l_linenumber = 1 AND o_orderstatus = 'P' THEN 'Cancelled' WHEN l_linenumber = 7 THEN NULL
       WHEN l_returnflag = 'R' THEN 'Refunded' ELSE 'Completed' END AS order_status,
  o_orderdate AS created_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
cte("mkt_sales", """SELECT concat('MKT-', event_id) AS transaction_id, event_id % 200 AS product_id,
  CASE WHEN user_id % 50 = 7 THEN NULL ELSE concat('user', user_id, '@email.com') END AS customer_email,
  CASE WHEN user_id % 5 = 0 THEN concat('User', user_id) ELSE concat('User N', user_id, ' Extra') END AS customer_name,
  CASE event_type WHEN 'purchase' THEN 'Amazon' ELSE 'Flipkart' END AS marketplace_name,
  CAST(event_id % 7 AS INT) AS quantity, CAST(value AS DECIMAL(10,2)) AS amount, ts AS transaction_date
FROM events WHERE event_type IN ('purchase', 'click')""")
cte("mkt_refunds", """SELECT concat('MKT-REF-', event_id) AS refund_id, concat('MKT-', event_id) AS original_transaction_id,
  CAST(value AS DECIMAL(10,2)) AS refund_amount, concat('user', user_id, '@email.com') AS customer_email, ts AS refund_date
FROM events WHERE event_type IN ('purchase', 'click') AND event_id % 11 = 0""")
cte("web_products", """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
  CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part""")
cte("web_customers", """SELECT c_custkey AS customer_id, 'Customer' AS first_name, substr(c_name, 10) AS last_name,
  concat('cust', c_custkey, '@email.com') AS email,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE concat('98', c_custkey) END AS phone FROM customer""")

# -- quality split -----------------------------------------------------------
WEB_REASONS = """concat_ws(',',
  CASE WHEN order_id IS NULL THEN 'null_order_id' END, CASE WHEN customer_id IS NULL THEN 'null_customer_id' END,
  CASE WHEN product_id IS NULL THEN 'null_product_id' END, CASE WHEN quantity IS NULL THEN 'null_quantity' END,
  CASE WHEN quantity <= 0 THEN 'nonpositive_quantity' END, CASE WHEN order_status = 'Cancelled' THEN 'cancelled' END,
  CASE WHEN order_status IS NULL THEN 'null_status' END)"""
MKT_REASONS = """concat_ws(',',
  CASE WHEN transaction_id IS NULL THEN 'null_transaction_id' END, CASE WHEN product_id IS NULL THEN 'null_product_id' END,
  CASE WHEN customer_email IS NULL THEN 'null_email' END, CASE WHEN quantity IS NULL THEN 'null_quantity' END,
  CASE WHEN quantity <= 0 THEN 'nonpositive_quantity' END, CASE WHEN transaction_date IS NULL THEN 'bad_timestamp' END)"""
REFUND_OK = ("refund_id IS NOT NULL AND original_transaction_id IS NOT NULL AND refund_amount IS NOT NULL "
             "AND refund_amount >= 0")
cte("wo_c", f"SELECT *, {WEB_REASONS} AS reasons FROM web_orders", "web_orders")
cte("ms_c", f"SELECT *, {MKT_REASONS} AS reasons FROM mkt_sales", "mkt_sales")
cte("wo_v", "SELECT * EXCLUDE (reasons) FROM wo_c WHERE reasons = ''", "wo_c")
cte("ms_v", "SELECT * EXCLUDE (reasons) FROM ms_c WHERE reasons = ''", "ms_c")

# -- conform, union, dedup, settle ---------------------------------------------
WEB_SALES = """SELECT concat('MYSQL-ORDER-', order_id) AS sale_id, product_id, customer_id,
  CAST(NULL AS VARCHAR) AS customer_email, 'Website' AS channel_name, quantity AS quantity_sold,
  total_amount AS sales_amount, coalesce(created_at, TIMESTAMP '2026-08-19 00:00:00') AS transaction_date{extra}
FROM wo_v"""
MKT_SALES = """SELECT transaction_id AS sale_id, product_id, """ + MD5_ID.format(e="customer_email") + """ AS customer_id,
  customer_email, marketplace_name AS channel_name, quantity AS quantity_sold, amount AS sales_amount,
  transaction_date{extra} FROM ms_v"""
RULE_WEB = ", CASE WHEN order_status = 'Refunded' THEN total_amount ELSE CAST(0 AS DECIMAL(10,2)) END AS rule_refund"
RULE_MKT = ", CAST(0 AS DECIMAL(10,2)) AS rule_refund"
cte("web_s", WEB_SALES.format(extra=""), "wo_v")
cte("mkt_s", MKT_SALES.format(extra=""), "ms_v")
cte("web_sr", WEB_SALES.format(extra=RULE_WEB), "wo_v")
cte("mkt_sr", MKT_SALES.format(extra=RULE_MKT), "ms_v")
cte("u", "SELECT * FROM web_s UNION ALL SELECT * FROM mkt_s", "web_s", "mkt_s")
cte("ur", "SELECT * FROM web_sr UNION ALL SELECT * FROM mkt_sr", "web_sr", "mkt_sr")
RECENCY = ("transaction_date DESC NULLS LAST, sales_amount DESC NULLS LAST, quantity_sold DESC NULLS LAST, "
           "product_id DESC NULLS LAST, customer_id DESC NULLS LAST, customer_email DESC NULLS LAST, "
           "channel_name DESC NULLS LAST")
cte("d", f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sale_id ORDER BY {RECENCY}) AS rn
FROM u) WHERE rn = 1""", "u")
cte("dr", f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sale_id ORDER BY {RECENCY},
  rule_refund DESC NULLS LAST) AS rn FROM ur) WHERE rn = 1""", "ur")
cte("rt", f"""SELECT original_transaction_id AS tid, sum(refund_amount) AS refund FROM mkt_refunds
WHERE {REFUND_OK} GROUP BY original_transaction_id""", "mkt_refunds")
cte("st", "SELECT d.*, coalesce(rt.refund, 0) AS refund_amount FROM d LEFT JOIN rt ON d.sale_id = rt.tid", "d", "rt")
cte("str", """SELECT dr.* EXCLUDE (rule_refund), coalesce(rt.refund, 0) + coalesce(dr.rule_refund, 0) AS refund_amount
FROM dr LEFT JOIN rt ON dr.sale_id = rt.tid""", "dr", "rt")

# -- customers and products ------------------------------------------------------
cte("wc", "SELECT customer_id, first_name, last_name, email, phone, 'MySQL' AS source_system FROM web_customers",
    "web_customers")
MC = ("SELECT " + MD5_ID.format(e="customer_email") + """ AS customer_id,
  string_split(customer_name, ' ')[1] AS first_name, coalesce(string_split(customer_name, ' ')[2], '') AS last_name,
  customer_email AS email, CAST(NULL AS VARCHAR) AS phone, marketplace_name AS source_system FROM ms_v""")
cte("mc", MC, "ms_v")
cte("uc", "SELECT * FROM wc UNION ALL SELECT * FROM mc", "wc", "mc")
BY_NAME = ("first_name ASC NULLS LAST, last_name ASC NULLS LAST, email ASC NULLS LAST, phone ASC NULLS LAST")
cte("cc", f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, source_system
ORDER BY {BY_NAME}) AS rn FROM uc) WHERE rn = 1""", "uc")
cte("cp", "SELECT product_id, product_name, category, price, 'MySQL' AS source_system FROM web_products",
    "web_products")
cte("dp", "SELECT row_number() OVER (ORDER BY product_id, source_system) AS product_key, * FROM cp", "cp")
cte("dcu", "SELECT row_number() OVER (ORDER BY customer_id, source_system) AS customer_key, * FROM cc", "cc")
cte("ch", """SELECT CAST(channel_key AS BIGINT) AS channel_key, channel_name, channel_type, product_source FROM (VALUES (1, 'Website', 'Internal', 'MySQL'), (2, 'Amazon', 'Marketplace', 'MySQL'),
  (3, 'Flipkart', 'Marketplace', 'MySQL')) t(channel_key, channel_name, channel_type, product_source)""")
FACT_FROM = """SELECT s.sale_id, p.product_key, c.customer_key, ch.channel_key, s.quantity_sold, s.sales_amount,
  s.refund_amount, s.transaction_date, CAST(s.transaction_date AS DATE) AS sale_date
FROM {src} s LEFT JOIN ch ON s.channel_name = ch.channel_name
LEFT JOIN dp p ON s.product_id = p.product_id AND p.source_system = ch.product_source
LEFT JOIN dcu c ON s.customer_id = c.customer_id
  AND c.source_system = CASE WHEN s.channel_name = 'Website' THEN 'MySQL' ELSE s.channel_name END"""
cte("fk", FACT_FROM.format(src="str"), "str", "ch", "dp", "dcu")
cte("fk0", FACT_FROM.format(src="st"), "st", "ch", "dp", "dcu")
# second extract of the catalogue: LARGE items renamed and repriced
cte("cp2", """SELECT product_id, CASE WHEN category = 'LARGE' THEN upper(product_name) ELSE product_name END AS product_name,
  category, CASE WHEN category = 'LARGE' THEN price + 1 ELSE price END AS price, source_system FROM cp""", "cp")


def sql(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + body


SALES_OUT = (f"sale_id, product_id, customer_id, customer_email, channel_name, CAST(quantity_sold AS BIGINT) AS quantity_sold, "
             f"CAST(sales_amount AS DOUBLE) AS sales_amount, {ts('transaction_date')} AS transaction_date")
ORDERS_OUT = (f"order_id, customer_id, product_id, CAST(quantity AS BIGINT) AS quantity, "
              f"CAST(total_amount AS DOUBLE) AS total_amount, order_status, {ts('created_at')} AS created_at")
MKT_OUT = (f"transaction_id, product_id, customer_email, customer_name, marketplace_name, CAST(quantity AS BIGINT) AS quantity, "
           f"CAST(amount AS DOUBLE) AS amount, {ts('transaction_date')} AS transaction_date")
CREATED = ts("(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST({key} % 365 AS INT)))")
SEC = "date_trunc('second', {c})"
REVENUE = """SELECT s.channel_name, CAST(count(sale_id) AS BIGINT) AS total_orders,
  CAST(sum(quantity_sold) AS BIGINT) AS total_units_sold, CAST(sum(sales_amount) AS DOUBLE) AS gross_revenue,
  CAST(sum(refund_amount) AS DOUBLE) AS total_refunds, CAST(sum(sales_amount - refund_amount) AS DOUBLE) AS net_revenue
FROM {src} s JOIN ch ON s.channel_name = ch.channel_name GROUP BY s.channel_name ORDER BY net_revenue DESC NULLS LAST"""
FACT_OUT = ("sale_id, product_key, customer_key, channel_key, CAST(quantity_sold AS BIGINT) AS quantity_sold, "
            "CAST(sales_amount AS DOUBLE) AS sales_amount, CAST(refund_amount AS DOUBLE) AS refund_amount, "
            "{t} AS transaction_date, " + day("sale_date") + " AS sale_date")


def _merge(cur: str, inc: str, key: str, nat: list[str], attrs: list[str]) -> str:
    on = " AND ".join(f"t.{n} = s.{n}" for n in nat)
    pick = ", ".join(f"CASE WHEN s.{nat[0]} IS NOT NULL THEN s.{a} ELSE t.{a} END AS {a}" for a in attrs)
    natural = ", ".join(f"t.{n}" for n in nat)
    s_cols = ", ".join(f"s.{c}" for c in nat + attrs)
    order = ", ".join(f"s.{n}" for n in nat)
    return f"""SELECT t.{key}, {natural}, {pick} FROM {cur} t LEFT JOIN {inc} s ON {on}
UNION ALL
SELECT (SELECT max({key}) FROM {cur}) + row_number() OVER (ORDER BY {order}) AS {key}, {s_cols}
FROM {inc} s ANTI JOIN {cur} t ON {on}"""


def _customer_pick(src: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, source_system
ORDER BY {BY_NAME}) AS rn FROM {src}) WHERE rn = 1"""


cte("mc_e", MC.replace("FROM ms_v", "FROM ms_v WHERE transaction_date < TIMESTAMP '2024-01-16'"), "ms_v")
cte("k1c", "SELECT row_number() OVER (ORDER BY customer_id, source_system) AS customer_key, * FROM ("
    + _customer_pick("(SELECT * FROM wc UNION ALL SELECT * FROM mc_e)") + ")", "wc", "mc_e")
cte("inc_c", _customer_pick("""(SELECT customer_id, first_name, last_name, email,
  CASE WHEN customer_id % 3 = 0 THEN concat('97', customer_id) ELSE phone END AS phone, source_system FROM wc
  UNION ALL SELECT * FROM mc)"""), "wc", "mc")
cte("k1p", """SELECT row_number() OVER (ORDER BY product_id, source_system) AS product_key, *
FROM cp WHERE category <> 'PROMO'""", "cp")

_SETTLEMENT = sql("""SELECT sale_id, channel_name, CAST(sales_amount AS DOUBLE) AS sales_amount,
  CAST(refund_amount AS DOUBLE) AS refund_amount, CAST(sales_amount - refund_amount AS DOUBLE) AS net_amount
FROM st""", "st")

def _rotated(x: str, bits: int) -> str:
    return f"((({x}) * {1 << bits}) % 4294967296 + ({x}) // {1 << 32 - bits})"


# the 32-bit Murmur3 of the e-mail's bytes (ASCII), seed 42: whole words of four bytes, then single bytes
_MURMUR = f"""SELECT email, CASE WHEN h >= 2147483648 THEN 4294967296 - h ELSE h END::BIGINT AS customer_id FROM (
  SELECT email, xor(h, h // 65536) AS h FROM (
    SELECT email, (xor(h, h // 8192) * 3266489909::HUGEINT) % 4294967296 AS h FROM (
      SELECT email, (xor(h, h // 65536) * 2246822507::HUGEINT) % 4294967296 AS h FROM (
        SELECT email, xor(list_reduce(list_prepend(42::HUGEINT, list_transform(k, lambda x: ({_rotated("x", 15)} * 461845907) % 4294967296)),
            lambda a, x: ({_rotated("xor(a, x)", 13)} * 5 + 3864292196) % 4294967296), length(email)::HUGEINT) AS h FROM (
          SELECT email, list_transform(list_concat(
              list_transform(range(length(email) // 4), lambda i: b[4 * i + 1] + 256 * b[4 * i + 2] + 65536 * b[4 * i + 3] + 16777216 * b[4 * i + 4]),
              list_slice(b, length(email) // 4 * 4 + 1, length(email))), lambda x: (x::HUGEINT * 3432918353) % 4294967296) AS k
          FROM (SELECT DISTINCT customer_email AS email, list_transform(string_split(customer_email, ''), lambda c: ascii(c)::BIGINT) AS b
                FROM mkt_sales WHERE customer_email IS NOT NULL))))))"""


ORACLE: dict[str, str] = {
    "channel_revenue": sql(REVENUE.format(src="st"), "st", "ch"),
    "channel_revenue_web_refunds": sql(REVENUE.format(src="str"), "str", "ch"),
    **{name: sql(REVENUE.format(src="(SELECT * REPLACE (CASE WHEN channel_name <> 'Website' AND product_id % 10 = 3 "
                                               "THEN 'Meesho' ELSE channel_name END AS channel_name) FROM str)")
                                .replace("JOIN ch ON s.channel_name = ch.channel_name ", ""), "str")
       for name in ("fact_channel_revenue", "summary_channel_revenue")},
    **{name: _SETTLEMENT for name in ("refund_settlement", "refund_settlement_redelivered")},
    "dq_valid_orders": sql(f"SELECT {ORDERS_OUT} FROM wo_v", "wo_v"),
    "dq_quarantine_orders": sql(f"SELECT {ORDERS_OUT}, reasons FROM wo_c WHERE reasons <> ''", "wo_c"),
    "dq_valid_sales": sql(f"SELECT {MKT_OUT} FROM ms_v", "ms_v"),
    "dq_quarantine_refunds": sql("""SELECT refund_id, CAST(amount AS DOUBLE) AS refund_amount,
  concat_ws(',', CASE WHEN amount IS NULL THEN 'null_refund_amount' END, CASE WHEN amount < 0 THEN 'negative_refund' END) AS reasons
FROM (SELECT refund_id, CASE WHEN n % 7 = 0 THEN NULL WHEN n % 2 = 0 THEN -refund_amount ELSE refund_amount END AS amount
      FROM (SELECT *, CAST(substr(refund_id, 9) AS BIGINT) AS n FROM mkt_refunds))
WHERE amount IS NULL OR amount < 0""", "mkt_refunds"),
    "dq_quarantine_sales": sql(f"SELECT {MKT_OUT}, reasons FROM ms_c WHERE reasons <> ''", "ms_c"),
    "dq_reason_counts": sql("""SELECT feed, reason, CAST(count(*) AS BIGINT) AS n_rows FROM (
  SELECT 'orders' AS feed, unnest(string_split(reasons, ',')) AS reason FROM wo_c WHERE reasons <> ''
  UNION ALL
  SELECT 'sales' AS feed, unnest(string_split(reasons, ',')) AS reason FROM ms_c WHERE reasons <> '')
GROUP BY feed, reason""", "wo_c", "ms_c"),
    **{name: sql(f"""SELECT 'orders' AS feed, CAST(count(*) AS BIGINT) AS n_input,
  CAST(count(*) FILTER (WHERE reasons = '') AS BIGINT) AS n_valid,
  CAST(count(*) FILTER (WHERE reasons <> '') AS BIGINT) AS n_quarantined FROM wo_c
UNION ALL
SELECT 'sales', count(*), count(*) FILTER (WHERE reasons = ''), count(*) FILTER (WHERE reasons <> '') FROM ms_c
UNION ALL
SELECT 'refunds', count(*), count(*) FILTER (WHERE {REFUND_OK}),
  count(*) FILTER (WHERE NOT coalesce({REFUND_OK}, false)) FROM mkt_refunds""", "wo_c", "ms_c", "mkt_refunds")
       for name in ("dq_split_totals", "dq_split_observed")},
    "conform_orders": sql(f"SELECT {SALES_OUT} FROM web_s", "web_s"),
    "conform_sales": sql(f"SELECT {SALES_OUT} FROM mkt_s", "mkt_s"),
    "conform_products": sql("SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, source_system FROM cp",
                            "cp"),
    "scalar_parse_timestamp": sql(f"""SELECT event_id, ts_text,
  {ts("CASE WHEN regexp_full_match(trim(ts_text), '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?') THEN TRY_CAST(trim(ts_text) AS TIMESTAMP) END")} AS parsed_ts
FROM (SELECT event_id, CASE WHEN user_id % 17 = 0 THEN 'not a time'
  WHEN event_id % 2 = 0 THEN {ts('ts')} ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text FROM events)"""),
    "scalar_timestamp_fallback": sql(f"""SELECT concat('MYSQL-ORDER-', order_id) AS sale_id,
  {ts("CASE WHEN order_id % 101 = 0 THEN TIMESTAMP '2026-08-19 00:00:00' ELSE created_at END")} AS transaction_date
FROM wo_v""", "wo_v"),
    "scalar_format_timestamp": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events",
    "scalar_name_split": sql("""SELECT transaction_id, customer_name, string_split(customer_name, ' ')[1] AS first_name,
  coalesce(string_split(customer_name, ' ')[2], '') AS last_name FROM mkt_sales""", "mkt_sales"),
    "identity_murmur": sql(_MURMUR, "mkt_sales"),
    "identity_md5": sql("SELECT email, " + MD5_ID.format(e="email") + """ AS customer_id
FROM (SELECT DISTINCT customer_email AS email FROM mkt_sales WHERE customer_email IS NOT NULL)""", "mkt_sales"),
    "derive_partitions": sql(f"""SELECT sale_id, {day('transaction_date')} AS sale_date,
  CAST(year(transaction_date) AS BIGINT) AS year, CAST(month(transaction_date) AS BIGINT) AS month,
  CAST(day(transaction_date) AS BIGINT) AS day FROM d""", "d"),
    "unify_sales": sql(f"SELECT {SALES_OUT} FROM u", "u"),
    "dedup_sales": sql(f"SELECT {SALES_OUT} FROM d", "d"),
    "unify_customers": sql("SELECT * FROM uc", "uc"),
    "dedup_customer_id": sql("SELECT * FROM cc", "cc"),
    "dedup_customer_email": sql("""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY email
ORDER BY first_name ASC NULLS LAST, last_name ASC NULLS LAST, customer_id ASC NULLS LAST, phone ASC NULLS LAST,
  source_system ASC NULLS LAST) AS rn FROM mc) WHERE rn = 1""", "mc"),
    "dedup_customer_email_channel": sql("""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY email,
  source_system ORDER BY first_name ASC NULLS LAST, last_name ASC NULLS LAST, customer_id ASC NULLS LAST,
  phone ASC NULLS LAST) AS rn FROM mc) WHERE rn = 1""", "mc"),
    "dim_latest_products": sql("""SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, source_system
FROM (SELECT *, row_number() OVER (PARTITION BY product_id, source_system ORDER BY product_name ASC NULLS LAST,
  category ASC NULLS LAST, price ASC NULLS LAST) AS rn FROM (SELECT * FROM cp UNION ALL SELECT * FROM cp2))
WHERE rn = 1""", "cp", "cp2"),
    "dim_latest_customers": sql(f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id,
  source_system ORDER BY {BY_NAME}) AS rn FROM uc) WHERE rn = 1""", "uc"),
    "dim_keys_products": sql("SELECT product_id, source_system, product_key FROM dp", "dp"),
    "dim_keys_customers": sql("SELECT customer_id, source_system, customer_key FROM dcu", "dcu"),
    "merge_products": sql("SELECT product_key, product_id, source_system, product_name, category, "
                          "CAST(price AS DOUBLE) AS price FROM ("
                          + _merge("k1p", "cp2", "product_key", ["product_id", "source_system"],
                                   ["product_name", "category", "price"]) + ")", "k1p", "cp2"),
    **{name: sql("SELECT * FROM (" + _merge("k1c", "inc_c", "customer_key", ["customer_id", "source_system"],
                                                      ["first_name", "last_name", "email", "phone"]) + ")",
                           "k1c", "inc_c")
       for name in ("merge_customers", "merge_customers_buckets")},
    "dim_channels_seed": sql("""SELECT * FROM ch UNION ALL
SELECT 3 + row_number() OVER (ORDER BY channel_name), channel_name, 'Marketplace', 'MySQL'
FROM (SELECT DISTINCT channel_name FROM u WHERE channel_name NOT IN (SELECT channel_name FROM ch))""", "ch", "u"),
    "fact_key_lookup": sql("SELECT " + FACT_OUT.format(t=ts("transaction_date")) + " FROM fk", "fk"),
    "fact_defaults": sql("SELECT sale_id, CAST(refund_amount AS DOUBLE) AS refund_amount, "
                         "'2026-08-19 00:00:00.000000' AS ingestion_timestamp FROM st", "st"),
    "contract_fk_fact": sql("""SELECT sale_id, concat_ws(',', CASE WHEN p THEN 'product' END, CASE WHEN c THEN 'customer' END,
  CASE WHEN channel_key IS NULL THEN 'channel' END) AS missing
FROM (SELECT fk.*, coalesce(dp.product_id % 7 = 0, true) AS p, coalesce(dcu.customer_id % 9 = 0, true) AS c
      FROM fk LEFT JOIN dp USING (product_key) LEFT JOIN dcu USING (customer_key))
WHERE p OR c OR channel_key IS NULL""", "fk", "dp", "dcu"),
    "contract_pk_fact": sql("SELECT count(*) AS n_rows, count(DISTINCT sale_id) AS n_ids FROM fk", "fk"),
    "contract_not_null_warehouse": sql("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM {src}"
        for t, src in (("dim_products", "dp"), ("dim_customers", "dcu"), ("fact_sales", "fk")) for c in NOT_NULL[t]),
        "dp", "dcu", "fk"),
    "contract_varchar_warehouse": sql("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({n} AS BIGINT) AS max_allowed, "
        f"CAST(max(length({c})) AS BIGINT) AS max_length, count(*) FILTER (WHERE length({c}) > {n}) AS n_over FROM {src}"
        for t, src in (("dim_products", "dp"), ("dim_customers", "dcu"), ("fact_sales", "fk"))
        for c, n in VARCHAR_LIMITS[t].items()), "dp", "dcu", "fk"),
    "fact_slice_replace": sql(f"""SELECT sale_id, CAST(CASE WHEN transaction_date >= TIMESTAMP '2024-01-08'
  AND transaction_date < TIMESTAMP '2024-01-15' THEN refund_amount ELSE 0 END AS DOUBLE) AS refund_amount,
  {day('transaction_date')} AS sale_date FROM st""", "st"),
    "load_range_run": sql("SELECT " + FACT_OUT.format(t=ts(SEC.format(c="transaction_date"))) + " FROM fk", "fk"),
    "load_by_parts": sql("SELECT " + FACT_OUT.format(t=ts(SEC.format(c="transaction_date"))) + " FROM fk", "fk"),
    "refund_totals_merged": sql(f"""SELECT original_transaction_id AS sale_id,
  CAST(sum(CASE WHEN n % 3 = 0 THEN refund_amount + 1 ELSE refund_amount END) AS DOUBLE) AS refunded
FROM (SELECT *, CAST(substr(refund_id, 9) AS BIGINT) AS n FROM mkt_refunds)
WHERE {REFUND_OK} AND (n % 3 = 0 OR n % 5 <> 0) GROUP BY original_transaction_id""", "mkt_refunds"),
    "incremental_fact": sql("SELECT " + FACT_OUT.format(t=ts(SEC.format(c="transaction_date"))) + " FROM fk", "fk"),
    "fact_rerun_idempotent": sql("SELECT " + FACT_OUT.format(t=ts(SEC.format(c="transaction_date"))) + " FROM fk",
                                 "fk"),
    "contract_fk_orders": sql("""SELECT order_id, 'customer_id' AS fk_column FROM web_orders
WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM web_customers WHERE customer_id % 7 <> 0)
UNION ALL
SELECT order_id, 'product_id' FROM web_orders
WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM web_products WHERE product_id % 11 <> 0)""",
                              "web_orders", "web_customers", "web_products"),
    "contract_unique_email": sql("""SELECT email, CAST(count(DISTINCT (customer_id, source_system)) AS BIGINT) AS n_rows
FROM uc GROUP BY email HAVING count(DISTINCT (customer_id, source_system)) > 1""", "uc"),
    "contract_pk_sales": sql("SELECT sale_id, CAST(count(*) AS BIGINT) AS n_rows FROM u GROUP BY sale_id "
                             "HAVING count(*) > 1", "u"),
    "contract_not_null": sql("""SELECT 'orders' AS table_name, c.column_name, c.n_null FROM (
  SELECT unnest([{'column_name': 'order_id', 'n_null': count(*) FILTER (WHERE order_id IS NULL)},
                 {'column_name': 'quantity', 'n_null': count(*) FILTER (WHERE quantity IS NULL)},
                 {'column_name': 'total_amount', 'n_null': count(*) FILTER (WHERE total_amount IS NULL)}]) AS c
  FROM web_orders)
UNION ALL SELECT 'customers', c.column_name, c.n_null FROM (
  SELECT unnest([{'column_name': 'customer_id', 'n_null': count(*) FILTER (WHERE customer_id IS NULL)},
                 {'column_name': 'first_name', 'n_null': count(*) FILTER (WHERE first_name IS NULL)},
                 {'column_name': 'last_name', 'n_null': count(*) FILTER (WHERE last_name IS NULL)},
                 {'column_name': 'email', 'n_null': count(*) FILTER (WHERE email IS NULL)}]) AS c
  FROM web_customers)
UNION ALL SELECT 'products', c.column_name, c.n_null FROM (
  SELECT unnest([{'column_name': 'product_id', 'n_null': count(*) FILTER (WHERE product_id IS NULL)},
                 {'column_name': 'product_name', 'n_null': count(*) FILTER (WHERE product_name IS NULL)},
                 {'column_name': 'category', 'n_null': count(*) FILTER (WHERE category IS NULL)},
                 {'column_name': 'price', 'n_null': count(*) FILTER (WHERE price IS NULL)}]) AS c
  FROM web_products)""", "web_orders", "web_customers", "web_products"),
    "contract_varchar_length": sql("""SELECT 'orders' AS table_name, 'order_status' AS column_name, CAST(20 AS BIGINT) AS max_allowed,
  CAST(max(length(order_status)) AS BIGINT) AS max_length, count(*) FILTER (WHERE length(order_status) > 20) AS n_over
FROM web_orders
UNION ALL SELECT 'customers', 'first_name', 50, max(length(first_name)), count(*) FILTER (WHERE length(first_name) > 50) FROM web_customers
UNION ALL SELECT 'customers', 'last_name', 50, max(length(last_name)), count(*) FILTER (WHERE length(last_name) > 50) FROM web_customers
UNION ALL SELECT 'customers', 'email', 100, max(length(email)), count(*) FILTER (WHERE length(email) > 100) FROM web_customers
UNION ALL SELECT 'customers', 'phone', 20, max(length(phone)), count(*) FILTER (WHERE length(phone) > 20) FROM web_customers
UNION ALL SELECT 'products', 'product_name', 100, max(length(product_name)), count(*) FILTER (WHERE length(product_name) > 100) FROM web_products
UNION ALL SELECT 'products', 'category', 50, max(length(category)), count(*) FILTER (WHERE length(category) > 50) FROM web_products""",
                                   "web_orders", "web_customers", "web_products"),
    "src_extract_customers": sql("SELECT customer_id, first_name, last_name, email, phone, "
                                 + CREATED.format(key="customer_id") + " AS created_at FROM web_customers",
                                 "web_customers"),
    "src_extract_products": sql("SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, "
                                + CREATED.format(key="product_id") + " AS created_at FROM web_products",
                                "web_products"),
    "src_extract_orders_day": sql(f"""SELECT {ORDERS_OUT} FROM web_orders
WHERE created_at >= TIMESTAMP '1996-01-01' AND created_at < TIMESTAMP '1997-01-01'""", "web_orders"),
    "src_csv_orders": sql(f"SELECT {ORDERS_OUT.replace(ts('created_at'), ts(SEC.format(c='created_at')))} FROM web_orders",
                          "web_orders"),
    "src_csv_products": sql("SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price FROM web_products",
                            "web_products"),
    "src_csv_customers": sql("SELECT * FROM web_customers", "web_customers"),
    "src_ndjson_sales": sql(f"SELECT {MKT_OUT.replace(ts('transaction_date'), ts(SEC.format(c='transaction_date')))} "
                            "FROM mkt_sales", "mkt_sales"),
    "src_ndjson_refunds": sql(f"""SELECT refund_id, original_transaction_id, CAST(refund_amount AS DOUBLE) AS refund_amount,
  customer_email, {ts(SEC.format(c='refund_date'))} AS refund_date FROM mkt_refunds""", "mkt_refunds"),
    "src_ndjson_corrupt": sql("""SELECT 'sales' AS feed, reason, CAST(count(*) AS BIGINT) AS n_rows FROM (
  SELECT unnest(string_split(r, ',')) AS reason FROM (
    SELECT CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 13 = 0
      THEN 'corrupt_record,null_transaction_id,null_product_id,null_email,null_quantity,bad_timestamp'
      ELSE reasons END AS r FROM ms_c) WHERE r <> '')
GROUP BY reason""", "ms_c"),
    "src_empty_fallback": sql("SELECT 'Website' AS channel_name, CAST(count(*) AS BIGINT) AS n_sales FROM wo_v "
                              "HAVING count(*) > 0", "wo_v"),
    "src_dated_slice": sql(f"""SELECT {MKT_OUT}, {day('CAST(transaction_date AS DATE)')} AS dt FROM mkt_sales
WHERE transaction_date >= TIMESTAMP '2024-01-08' AND transaction_date < TIMESTAMP '2024-01-15'""", "mkt_sales"),
    "stage_sales": sql(f"SELECT {SALES_OUT} FROM d", "d"),
    "stage_missing_column": sql("SELECT sale_id, CAST(NULL AS DOUBLE) AS refund_amount FROM d", "d"),
    "stage_products": sql("SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, source_system "
                          "FROM cp", "cp"),
    "stage_customers": sql("SELECT * FROM cc", "cc"),
    "snk_csv_landing": sql("""SELECT concat_ws(',', coalesce(CAST(order_id AS VARCHAR), ''), coalesce(CAST(customer_id AS VARCHAR), ''),
  coalesce(CAST(product_id AS VARCHAR), ''), coalesce(CAST(quantity AS VARCHAR), ''),
  coalesce(CAST(total_amount AS VARCHAR), ''), coalesce(order_status, ''),
  coalesce(strftime(created_at, '%Y-%m-%d %H:%M:%S'), '')) AS line FROM web_orders""", "web_orders"),
    "snk_ndjson_landing": sql("""SELECT transaction_id, concat_ws(',', 'amount',
  CASE WHEN customer_email IS NOT NULL THEN 'customer_email' END, 'customer_name', 'marketplace_name', 'product_id',
  'quantity', 'transaction_date', 'transaction_id') AS line_keys FROM mkt_sales""", "mkt_sales"),
    "snk_sales_partitioned": sql(f"SELECT {day('CAST(transaction_date AS DATE)')} AS sale_date, "
                                 "CAST(count(*) AS BIGINT) AS n_rows FROM d GROUP BY 1", "d"),
    "incremental_sales": sql(f"SELECT {SALES_OUT.replace(ts('transaction_date'), ts(SEC.format(c='transaction_date')))} "
                             "FROM mkt_s", "mkt_s"),
}
