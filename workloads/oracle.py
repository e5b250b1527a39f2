"""The expected results as SQL over the same tables, one statement per registered query.

Statements are put together from named parts (``WITH`` entries); each takes the parts it refers to, directly or not.
"""

from __future__ import annotations

import re

from ledgerline import schemas
from workloads import retail

_PARTS: dict[str, str] = {}


def _part(name: str, sql: str) -> None:
    _PARTS[name] = sql


def statement(body: str) -> str:
    """``body`` preceded by the parts it needs, in order of definition."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        for word in set(re.findall(r"\b[a-z_0-9]+\b", todo.pop())):
            if word in _PARTS and word not in needed:
                needed.add(word)
                todo.append(_PARTS[word])
    parts = [f"{name} AS MATERIALIZED (\n{sql}\n)" for name, sql in _PARTS.items() if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


# --- raw, typed and assessed rows ---------------------------------------------------------------------------------

# Accepted shapes, words, reason codes and their order, entity tags, sentinels of inferred members.
_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?)?$"
_EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def text(c: str) -> str:
    return f"nullif(trim({c}), '')"


def stamp(c: str, kind: str = "timestamp") -> str:
    return f"CASE WHEN regexp_matches({text(c)}, '{_SHAPE}') THEN try_cast({text(c)} AS {kind}) END"


def flag(c: str) -> str:
    return (
        f"CASE WHEN lower({text(c)}) IN ('true','t','yes','y','on','1') THEN true "
        f"WHEN lower({text(c)}) IN ('false','f','no','n','off','0') THEN false END"
    )


def integer(c: str) -> str:
    return f"cast(try_cast({text(c)} AS decimal(38,0)) AS bigint)"


def money(c: str, precision: int = 12) -> str:
    return f"try_cast({text(c)} AS decimal({precision},2))"


def email(c: str) -> str:
    return f"regexp_matches({c}, '{_EMAIL}')"


_TYPED = {
    "customers": {
        "email": f"lower({text('email')})", "region": f"upper({text('region')})",
        "segment": f"upper({text('segment')})", "created_at": stamp("created_at"), "updated_at": stamp("updated_at"),
    },
    "products": {
        "category": f"upper({text('category')})", "brand": f"upper({text('brand')})",
        "unit_price": money("unit_price"),
        "created_at": stamp("created_at"), "updated_at": stamp("updated_at"), "is_active": flag("is_active"),
    },
    "stores": {
        "state": f"upper({text('state')})", "region": f"upper({text('region')})",
        "store_type": f"upper({text('store_type')})", "opened_date": stamp("opened_date", "date"),
    },
    "sales": {
        "sale_timestamp": stamp("sale_timestamp"),
        "quantity": integer("quantity"),
        "unit_price": money("unit_price"),
        "discount_amount": money("discount_amount"),
        "payment_method": f"upper({text('payment_method')})",
    },
}

_BAD_MAIL = f"NOT {email('email')}"
# The reason codes, in the order in which they are tried.
_REASONS = {
    "customers": {
        "initial": """CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' WHEN customer_name IS NULL THEN 'MISSING_CUSTOMER_NAME'
            WHEN email IS NULL THEN 'MISSING_EMAIL' WHEN BAD_MAIL THEN 'INVALID_EMAIL'
            WHEN created_at IS NULL THEN 'INVALID_CREATED_AT' WHEN updated_at IS NULL THEN 'INVALID_UPDATED_AT' END""",
        "batch": """CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' WHEN customer_name IS NULL THEN 'MISSING_CUSTOMER_NAME'
            WHEN email IS NULL OR BAD_MAIL THEN 'INVALID_EMAIL'
            WHEN created_at IS NULL OR updated_at IS NULL THEN 'INVALID_TIMESTAMP' END""",
    },
    "products": {
        "initial": """CASE WHEN product_id IS NULL THEN 'MISSING_PRODUCT_ID' WHEN product_name IS NULL THEN 'MISSING_PRODUCT_NAME'
            WHEN unit_price IS NULL OR unit_price <= 0 THEN 'INVALID_UNIT_PRICE' WHEN created_at IS NULL THEN 'INVALID_CREATED_AT'
            WHEN updated_at IS NULL THEN 'INVALID_UPDATED_AT' WHEN is_active IS NULL THEN 'INVALID_IS_ACTIVE' END""",
    },
    "stores": {
        "initial": """CASE WHEN store_id IS NULL THEN 'MISSING_STORE_ID' WHEN store_name IS NULL THEN 'MISSING_STORE_NAME'
            WHEN opened_date IS NULL THEN 'INVALID_OPENED_DATE' END""",
    },
    "sales": {
        "initial": """CASE WHEN sale_id IS NULL THEN 'MISSING_SALE_ID' WHEN sale_timestamp IS NULL THEN 'INVALID_SALE_TIMESTAMP'
            WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' WHEN product_id IS NULL THEN 'MISSING_PRODUCT_ID'
            WHEN store_id IS NULL THEN 'MISSING_STORE_ID' WHEN quantity IS NULL OR quantity <= 0 THEN 'INVALID_QUANTITY'
            WHEN unit_price IS NULL OR unit_price <= 0 THEN 'INVALID_UNIT_PRICE'
            WHEN discount_amount IS NULL OR discount_amount < 0 THEN 'INVALID_DISCOUNT'
            WHEN discount_amount > quantity * unit_price THEN 'DISCOUNT_EXCEEDS_GROSS_AMOUNT'
            WHEN payment_method IS NULL OR payment_method NOT IN ('CASH','CARD','UPI','WALLET') THEN 'INVALID_PAYMENT_METHOD' END""",
        "batch": """CASE WHEN sale_id IS NULL THEN 'MISSING_SALE_ID' WHEN sale_timestamp IS NULL THEN 'INVALID_TIMESTAMP'
            WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' WHEN product_id IS NULL THEN 'MISSING_PRODUCT_ID'
            WHEN store_id IS NULL THEN 'MISSING_STORE_ID' WHEN quantity IS NULL OR quantity <= 0 THEN 'INVALID_QUANTITY'
            WHEN unit_price IS NULL OR unit_price <= 0 THEN 'INVALID_UNIT_PRICE'
            WHEN discount_amount IS NULL OR discount_amount < 0 OR discount_amount > quantity * unit_price THEN 'INVALID_DISCOUNT'
            WHEN payment_method IS NULL OR payment_method NOT IN ('CASH','CARD','UPI','WALLET') THEN 'INVALID_PAYMENT_METHOD' END""",
    },
}
_RECENCY = {"customers": "updated_at", "products": "updated_at", "stores": "opened_date", "sales": "sale_timestamp"}
META = "_source_file, _batch_id, _loaded_at"


def columns(entity: str) -> str:
    return ", ".join(schemas.BUSINESS_COLUMNS[entity])


def _newest_first(entity: str, by_timestamp: bool = True) -> str:
    first = [_RECENCY[entity]] if by_timestamp else []
    rest = [c for c in schemas.BUSINESS_COLUMNS[entity] if c not in (schemas.KEYS[entity], *first)]
    return ", ".join(f"{c} DESC NULLS LAST" for c in (*first, "_row_number", "_source_file", *rest, "_loaded_at", "_batch_id"))


for _entity, _names in schemas.BUSINESS_COLUMNS.items():
    _part(f"raw_{_entity}", retail.RAW_SQL[_entity].format(**{t: t for t in retail.TABLES}).strip())
    _exprs = ", ".join(f"{_TYPED[_entity].get(c, text(c))} AS {c}" for c in _names)
    # json_object with keys in alphabetical order, as the variant payload prints them
    _payload = ", ".join(f"'{c}', {c}" for c in sorted(_names))
    _part(
        f"typed_{_entity}",
        f"SELECT {_exprs}, json_object({_payload}) AS payload, {META}, _row_number FROM raw_{_entity}",
    )
    _initial = _REASONS[_entity]["initial"].replace("BAD_MAIL", _BAD_MAIL)
    _batch = _REASONS[_entity].get("batch", _REASONS[_entity]["initial"]).replace("BAD_MAIL", _BAD_MAIL)
    _part(
        f"assessed_{_entity}",
        f"SELECT *, {_initial} AS reason_initial, {_batch} AS reason_batch FROM typed_{_entity}",
    )


def _of(batch: str | None) -> str:
    return "true" if batch is None else f"_batch_id = '{batch}'"


def latest_valid(entity: str, batch: str | None = None) -> str:
    key = schemas.KEYS[entity]
    return f"""SELECT {columns(entity)}, {META} FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {_newest_first(entity)}) AS rn
        FROM assessed_{entity} WHERE {_of(batch)} AND reason_initial IS NULL) WHERE rn = 1"""


def valid_latest(entity: str, batch: str | None, by_timestamp: bool) -> str:
    key = schemas.KEYS[entity]
    return f"""SELECT {columns(entity)}, {META} FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {_newest_first(entity, by_timestamp)}) AS rn
        FROM assessed_{entity} WHERE {_of(batch)} AND {key} IS NOT NULL) WHERE rn = 1 AND reason_batch IS NULL"""


# --- initial state ------------------------------------------------------------------------------------------------

for _entity in schemas.BUSINESS_COLUMNS:
    _part(f"{_entity}_0", latest_valid(_entity, "INITIAL"))

_ATTRIBUTES = "customer_name, email, phone, region, segment"
_PRODUCT = "product_id, product_name, category, brand, unit_price, created_at, updated_at, is_active"
_part(
    "dim_customer_0",
    f"""SELECT customer_id, {_ATTRIBUTES}, created_at AS effective_start_date,
        timestamp '9999-12-31 23:59:59' AS effective_end_date, true AS is_current, false AS is_inferred, {META}
        FROM customers_0""",
)
_part("dim_product_0", f"SELECT {_PRODUCT}, false AS is_inferred, {META} FROM products_0")
_part("dim_store", f"SELECT {columns('stores')}, false AS is_inferred, {META} FROM stores_0")


def _fact(sales: str, customers: str, products: str) -> str:
    """Fact rows that name the dimension members by natural key and version start instead of surrogate keys."""
    return f"""SELECT s.sale_id, cast(strftime(s.sale_timestamp, '%Y%m%d') AS int) AS date_key, c.customer_id,
        c.effective_start_date AS version_start, p.product_id, t.store_id, s.sale_timestamp, s.quantity, s.unit_price,
        s.discount_amount AS discount, cast(s.quantity * s.unit_price AS decimal(14,2)) AS gross_amount,
        cast(s.discount_amount AS decimal(14,2)) AS discount_amount,
        cast(s.quantity * s.unit_price - s.discount_amount AS decimal(14,2)) AS net_amount, s.payment_method,
        s._source_file, s._batch_id, s._loaded_at
        FROM {sales} s JOIN {customers} c ON c.customer_id = s.customer_id
             AND c.effective_start_date <= s.sale_timestamp AND s.sale_timestamp < c.effective_end_date
        JOIN {products} p ON p.product_id = s.product_id JOIN dim_store t ON t.store_id = s.store_id"""


_part("fact_0", _fact("sales_0", "dim_customer_0", "dim_product_0"))


TAGS = {"customers": "CUSTOMER", "products": "PRODUCT", "stores": "STORE", "sales": "SALE"}


def rejects(entity: str, batch: str | None = None, path: str = "initial") -> str:
    return f"""SELECT _source_file AS source_file, '{TAGS[entity]}' AS entity_name, {schemas.KEYS[entity]} AS business_key,
        reason_{path} AS rejection_reason, cast(payload AS varchar) AS raw_record, _batch_id AS batch_id
        FROM assessed_{entity} WHERE {_of(batch)} AND reason_{path} IS NOT NULL"""


def duplicates(batch: str | None = None) -> str:
    return f"""SELECT _source_file AS source_file, 'SALE' AS entity_name, sale_id AS business_key,
        'DUPLICATE_SALE_IN_BATCH' AS rejection_reason, cast(payload AS varchar) AS raw_record, _batch_id AS batch_id
        FROM (SELECT *, row_number() OVER (PARTITION BY sale_id ORDER BY {_newest_first('sales', False)},
                  cast(payload AS varchar) DESC) AS rn
              FROM assessed_sales WHERE {_of(batch)} AND sale_id IS NOT NULL) WHERE rn > 1"""


for _entity in schemas.BUSINESS_COLUMNS:
    for _number, _batch in enumerate(retail.BATCHES):
        _part(f"rejects_{_entity}_{_number}", rejects(_entity, _batch, "batch" if _number else "initial"))
_part(
    "rejects_0",
    " UNION ALL ".join(f"SELECT * FROM rejects_{e}_0" for e in schemas.BUSINESS_COLUMNS),
)

# --- the two batches ----------------------------------------------------------------------------------------------

_DIFFERS = " OR ".join(f"coalesce(o.{c}, '') <> coalesce(n.{c}, '')" for c in _ATTRIBUTES.split(", "))


def _scd2(dim: str, changes: str, now: str) -> str:
    """All versions after ``changes``: resolved, closed, untouched and opened ones."""
    resolved = "o.is_inferred AND n.customer_id IS NOT NULL"
    closed = f"NOT o.is_inferred AND n.customer_id IS NOT NULL AND ({_DIFFERS})"
    attributes = ", ".join(f"CASE WHEN {resolved} THEN n.{c} ELSE o.{c} END AS {c}" for c in _ATTRIBUTES.split(", "))
    new = ", ".join(f"n.{c}" for c in _ATTRIBUTES.split(", "))
    return f"""SELECT o.customer_id, {attributes}, o.effective_start_date,
          CASE WHEN {closed} THEN n.updated_at ELSE o.effective_end_date END AS effective_end_date,
          NOT ({closed}) AS is_current, o.is_inferred AND n.customer_id IS NULL AS is_inferred,
          CASE WHEN {resolved} THEN n._source_file ELSE o._source_file END AS _source_file,
          CASE WHEN {resolved} THEN n._batch_id ELSE o._batch_id END AS _batch_id,
          CASE WHEN {resolved} THEN n._loaded_at WHEN {closed} THEN timestamp '{now}' ELSE o._loaded_at END AS _loaded_at
        FROM {dim} o LEFT JOIN {changes} n ON n.customer_id = o.customer_id WHERE o.is_current
        UNION ALL SELECT * FROM {dim} WHERE NOT is_current
        UNION ALL SELECT n.customer_id, {new}, n.updated_at, timestamp '9999-12-31 23:59:59', true, false,
          n._source_file, n._batch_id, n._loaded_at
        FROM {changes} n LEFT JOIN {dim} o ON o.customer_id = n.customer_id AND o.is_current
        WHERE o.customer_id IS NULL OR ({closed})"""


for _n in (1, 2):
    _b, _p, _now = retail.BATCHES[_n], _n - 1, str(retail.LOADED_AT[retail.BATCHES[_n]])
    _before = "dim_customer_0" if _n == 1 else "dim_customer_1"
    _products_before = "dim_product_0" if _n == 1 else "dim_product_1"
    _part(f"customer_changes_{_n}", valid_latest("customers", _b, True))
    _part(
        f"customers_{_n}",
        f"""SELECT * FROM customers_{_p} WHERE customer_id NOT IN (SELECT customer_id FROM customer_changes_{_n})
            UNION ALL SELECT * FROM customer_changes_{_n}""",
    )
    _part(f"versions_{_n}", _scd2(_before, f"customer_changes_{_n}", _now))
    _part(f"product_changes_{_n}", latest_valid("products", _b))
    _part(
        f"products_{_n}",
        f"""SELECT * FROM products_{_p} WHERE product_id NOT IN (SELECT product_id FROM product_changes_{_n})
            UNION ALL SELECT * FROM product_changes_{_n}""",
    )
    _part(
        f"priced_{_n}",
        f"""SELECT * FROM {_products_before} WHERE product_id NOT IN (SELECT product_id FROM product_changes_{_n})
            UNION ALL SELECT {_PRODUCT}, false, {META} FROM product_changes_{_n}""",
    )
    _part(f"valid_sales_{_n}", valid_latest("sales", _b, False))
    _part(
        f"new_sales_{_n}",
        f"""SELECT * FROM valid_sales_{_n} WHERE sale_id NOT IN (SELECT sale_id FROM sales_{_p})
            AND sale_id NOT IN (SELECT sale_id FROM fact_{_p})""",
    )
    _part(f"sales_{_n}", f"SELECT * FROM sales_{_p} UNION ALL SELECT * FROM new_sales_{_n}")
    _part(
        f"inferred_customers_{_n}",
        f"""SELECT customer_id, 'UNKNOWN' AS customer_name, cast(NULL AS varchar) AS email, cast(NULL AS varchar) AS phone,
            'UNKNOWN' AS region, 'UNKNOWN' AS segment, timestamp '1900-01-01 00:00:00' AS effective_start_date,
            timestamp '9999-12-31 23:59:59' AS effective_end_date, true AS is_current, true AS is_inferred,
            min(_source_file) AS _source_file, min(_batch_id) AS _batch_id, min(_loaded_at) AS _loaded_at
            FROM new_sales_{_n} WHERE customer_id NOT IN (SELECT customer_id FROM versions_{_n}) GROUP BY customer_id""",
    )
    _part(
        f"inferred_products_{_n}",
        f"""SELECT product_id, 'UNKNOWN' AS product_name, 'UNKNOWN' AS category, 'UNKNOWN' AS brand,
            cast(NULL AS decimal(12,2)) AS unit_price, cast(NULL AS timestamp) AS created_at,
            cast(NULL AS timestamp) AS updated_at, true AS is_active, true AS is_inferred,
            min(_source_file) AS _source_file, min(_batch_id) AS _batch_id, min(_loaded_at) AS _loaded_at
            FROM new_sales_{_n} WHERE product_id NOT IN (SELECT product_id FROM priced_{_n}) GROUP BY product_id""",
    )
    _part(f"dim_customer_{_n}", f"SELECT * FROM versions_{_n} UNION ALL SELECT * FROM inferred_customers_{_n}")
    _part(f"dim_product_{_n}", f"SELECT * FROM priced_{_n} UNION ALL SELECT * FROM inferred_products_{_n}")
    _part(f"new_fact_{_n}", _fact(f"new_sales_{_n}", f"dim_customer_{_n}", f"dim_product_{_n}"))
    # A version closed later keeps its key, so earlier fact rows still name it by its start.
    _part(f"fact_{_n}", f"SELECT * FROM fact_{_p} UNION ALL SELECT * FROM new_fact_{_n}")
    _part(f"duplicate_sales_{_n}", duplicates(_b))
    _part(
        f"rejects_{_n}",
        f"""SELECT * FROM rejects_{_p} UNION ALL SELECT * FROM rejects_customers_{_n}
            UNION ALL SELECT * FROM rejects_products_{_n} UNION ALL SELECT * FROM duplicate_sales_{_n}
            UNION ALL SELECT * FROM rejects_sales_{_n}""",
    )

for _n in (0, 1, 2):
    _part(
        f"summary_{_n}",
        f"""SELECT cast(sale_timestamp AS date) AS sale_date, count(DISTINCT sale_id) AS total_orders,
            cast(sum(quantity) AS bigint) AS total_quantity, cast(sum(gross_amount) AS decimal(24,2)) AS gross_sales,
            cast(sum(discount_amount) AS decimal(24,2)) AS discount_amount, cast(sum(net_amount) AS decimal(24,2)) AS net_sales
            FROM fact_{_n} GROUP BY 1""",
    )
