"""Oracle SQL (DuckDB dialect) over the driver's tables.

The oracle states every table in closed form from the fixture rules: which
batch first brings a key, and which versions each key class must end with.
It never replays the loaders' anti joins or close-out, so it checks them
independently.  Averages, percentages and medians are computed with whole
numbers and explicit half-away-from-zero rounding.

Each named CTE lists the CTEs it reads; ``build(select, *names)`` emits the
``WITH`` clause for a final select.
"""

from __future__ import annotations

# Batch instants (must equal vaultmart.sources.fixtures).
D1 = "TIMESTAMP '2024-01-01 00:00:00'"
D2 = "TIMESTAMP '2024-01-02 00:00:00'"
D3 = "TIMESTAMP '2024-01-03 00:00:00'"
LATE = "TIMESTAMP '2023-12-31 00:00:00'"
AS_OF = "TIMESTAMP '2024-01-01 12:00:00'"
BATCH_TS = {1: D1, 2: D2, 3: D3}

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, list(deps))


def build(select: str, *names: str) -> str:
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
        return select
    body = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{select}"


# ---------------------------------------------------------------- fixtures ---
cte("sizes", """SELECT (SELECT count(*) FROM part) AS np,
       (SELECT count(*) FROM customer) AS nc,
       (SELECT count(*) FROM supplier) AS ns""")

cte("tx_base", """SELECT o.o_orderkey AS k, (o.o_orderkey * 7919) % s.np AS pkey, o.o_custkey,
       o.o_orderstatus, o.o_totalprice, o.o_orderdate, s.nc, s.ns
FROM orders o CROSS JOIN sizes s""", "sizes")

cte("prop_base", """SELECT p_partkey AS pkey, p_name AS address, p_brand AS suburb0,
       lpad(CAST(p_size AS VARCHAR), 4, '0') AS postcode, p_type AS state,
       CAST(p_size % 6 + 1 AS INTEGER) AS bedrooms, CAST(p_size % 4 + 1 AS INTEGER) AS bathrooms,
       CAST(50 + p_partkey % 1950 AS DECIMAL(18,2)) AS land_size_sqm, p_type AS property_type,
       CAST(1960 + p_size AS INTEGER) AS year_built,
       CAST(CAST(p_retailprice AS DECIMAL(14,2)) * 275 AS DECIMAL(14,2)) AS listing_price
FROM part""")

cte("used_props", "SELECT DISTINCT pkey FROM tx_base", "tx_base")

_PRICE = "CAST(t.o_totalprice AS DECIMAL(14,2))"
_AGENT = "CASE WHEN t.k % 50 <> 0 THEN CAST((t.k * 31) % t.ns AS VARCHAR) END"


def _property_rule(b: int) -> tuple[str, str, str]:
    """The suburb and load date that batch b gives a property, and the sales it holds."""
    suburb, loaded = "p.suburb0", BATCH_TS[b]
    if b == 2:
        suburb = "CASE WHEN p.pkey % 10 = 0 THEN p.suburb0 || '-updated' ELSE p.suburb0 END"
    if b == 3:
        suburb = """CASE WHEN p.pkey % 20 = 0 THEN p.suburb0
            WHEN p.pkey % 100 = 30 THEN p.suburb0 || '-late'
            WHEN p.pkey % 100 = 50 THEN p.suburb0 || '-replaced'
            WHEN p.pkey % 10 = 0 THEN p.suburb0 || '-updated' ELSE p.suburb0 END"""
        loaded = f"CASE WHEN p.pkey % 100 = 30 THEN {LATE} WHEN p.pkey % 100 = 50 THEN {D2} ELSE {D3} END"
    return suburb, loaded, {1: "t.k % 10 <> 9", 2: "TRUE", 3: "t.pkey % 100 <> 7"}[b]


def _raw_sql(b: int) -> str:
    price, agent = _PRICE, _AGENT
    if b >= 2:
        price = f"CASE WHEN t.k % 1000 = 0 THEN CAST({_PRICE} + 1 AS DECIMAL(14,2)) ELSE {_PRICE} END"
        agent = f"CASE WHEN t.k % 1000 = 1 THEN CAST((t.k * 31 + 1) % t.ns AS VARCHAR) ELSE {_AGENT} END"
    suburb, loaded, where = _property_rule(b)
    return f"""SELECT CAST(t.k AS VARCHAR) AS transaction_id, CAST(t.pkey AS VARCHAR) AS property_id,
       {price} AS sale_price, CAST(t.o_orderdate AS DATE) AS sale_date,
       CAST(t.o_custkey AS VARCHAR) AS buyer_id,
       CAST((t.o_custkey + 1 + t.k % 7) % t.nc AS VARCHAR) AS seller_id,
       {agent} AS agent_id,
       CASE t.o_orderstatus WHEN 'F' THEN 'auction' WHEN 'O' THEN 'private_sale' END AS sale_type,
       CAST(t.o_orderdate AS DATE) + CAST(t.k % 91 AS INTEGER) AS settlement_date,
       CAST(3 + t.k % 178 AS INTEGER) AS days_on_market,
       p.address, {suburb} AS suburb, p.postcode, p.state, p.bedrooms, p.bathrooms,
       p.land_size_sqm, p.property_type, p.year_built, p.listing_price,
       {loaded} AS _loaded_at
FROM tx_base t LEFT JOIN prop_base p ON p.pkey = t.pkey
WHERE {where}"""


def _owners_sql(b: int) -> str:
    phone = "CASE WHEN c.c_custkey % 11 <> 0 THEN '04' || lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') END"
    if b >= 2:
        phone = f"CASE WHEN c.c_custkey % 20 = 0 THEN '05' || lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') ELSE {phone} END"
    return f"""SELECT CAST(c.c_custkey AS VARCHAR) AS owner_id, c.c_name AS full_name,
       lower(c.c_name) || '@example.com' AS email, {phone} AS phone,
       g.n_name AS suburb, g.r_name AS state,
       DATE '2010-01-01' + CAST(c.c_custkey % 3650 AS INTEGER) AS registration_date,
       c.c_custkey % 3 = 0 AS investor_flag, {BATCH_TS[b]} AS _loaded_at
FROM customer c LEFT JOIN (SELECT n.n_nationkey, n.n_name, r.r_name
                           FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) g
  ON c.c_nationkey = g.n_nationkey"""


def _agents_sql(b: int) -> str:
    tier = """CASE s.s_suppkey % 4 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver'
                                 WHEN 2 THEN 'gold' ELSE 'platinum' END"""
    if b >= 2:
        tier = f"CASE WHEN s.s_suppkey % 5 = 0 THEN 'platinum' ELSE {tier} END"
    return f"""SELECT CAST(s.s_suppkey AS VARCHAR) AS agent_id, s.s_name AS full_name,
       lower(s.s_name) || '@example.com' AS email,
       'Agency ' || CAST(s.s_suppkey % 20 AS VARCHAR) AS agency_name,
       'LIC' || CAST(100000 + s.s_suppkey AS VARCHAR) AS license_no,
       n.n_name AS region, {tier} AS accreditation_tier,
       DATE '2005-01-01' + CAST(s.s_suppkey % 5000 AS INTEGER) AS active_from,
       {BATCH_TS[b]} AS _loaded_at
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey"""


# ----------------------------------------------------------------- staging ---
_TX_HASHDIFF = """md5(concat_ws('||', CAST(sale_price AS VARCHAR), CAST(sale_date AS VARCHAR),
           CAST(settlement_date AS VARCHAR), CAST(days_on_market AS VARCHAR),
           coalesce(sale_type, 'unknown')))"""
PROP_HASHDIFF = """md5(concat_ws('||', coalesce(address, ''), coalesce(suburb, ''),
           coalesce(postcode, ''), coalesce(state, ''), CAST(bedrooms AS VARCHAR),
           CAST(bathrooms AS VARCHAR), CAST(land_size_sqm AS VARCHAR),
           coalesce(property_type, ''), CAST(year_built AS VARCHAR),
           CAST(listing_price AS VARCHAR)))"""
OWNER_HASHDIFF = """md5(concat_ws('||', coalesce(full_name, ''), coalesce(email, ''),
           coalesce(phone, ''), coalesce(suburb, ''), coalesce(state, ''),
           CAST(registration_date AS VARCHAR), CAST(investor_flag AS VARCHAR)))"""
AGENT_HASHDIFF = """md5(concat_ws('||', coalesce(full_name, ''), coalesce(email, ''),
           coalesce(agency_name, ''), coalesce(license_no, ''), coalesce(region, ''),
           coalesce(accreditation_tier, ''), CAST(active_from AS VARCHAR)))"""

for _b in (1, 2, 3):
    cte(f"raw_b{_b}", _raw_sql(_b), "tx_base", "prop_base")
    cte(f"owners_b{_b}", _owners_sql(_b))
    cte(f"agents_b{_b}", _agents_sql(_b))
    cte(f"stg_tx_b{_b}", f"""SELECT transaction_id, property_id, buyer_id, seller_id, agent_id,
       sale_price, sale_date, settlement_date, days_on_market,
       coalesce(sale_type, 'unknown') AS sale_type, 'bronze.property_raw' AS record_source,
       _loaded_at AS load_date,
       md5(transaction_id) AS transaction_hk, md5(property_id) AS property_hk,
       md5(buyer_id) AS buyer_hk, md5(seller_id) AS seller_hk, md5(agent_id) AS agent_hk,
       {_TX_HASHDIFF} AS hashdiff
FROM raw_b{_b} WHERE transaction_id IS NOT NULL""", f"raw_b{_b}")
    # all sales of a property in a batch carry the same attributes and load date
    _suburb, _loaded, _where = _property_rule(_b)
    cte(f"stg_prop_b{_b}", f"""SELECT *, md5(property_id) AS property_hk, {PROP_HASHDIFF} AS hashdiff
FROM (SELECT CAST(u.pkey AS VARCHAR) AS property_id, p.address, {_suburb} AS suburb, p.postcode, p.state, p.bedrooms,
             p.bathrooms, p.land_size_sqm, p.property_type, p.year_built, p.listing_price,
             {_loaded} AS load_date, 'bronze.property_raw' AS record_source
      FROM (SELECT t.pkey FROM tx_base t WHERE {_where} GROUP BY t.pkey) u LEFT JOIN prop_base p ON p.pkey = u.pkey)""",
        "tx_base", "prop_base")
    cte(f"stg_own_b{_b}", f"""SELECT owner_id, full_name, email, phone, suburb, state, registration_date,
       investor_flag, _loaded_at AS load_date, 'src_crm.owners' AS record_source,
       md5(owner_id) AS owner_hk, {OWNER_HASHDIFF} AS hashdiff
FROM owners_b{_b} WHERE owner_id IS NOT NULL""", f"owners_b{_b}")
    cte(f"stg_agt_b{_b}", f"""SELECT agent_id, full_name, email, agency_name, license_no, region,
       accreditation_tier, active_from, _loaded_at AS load_date,
       'src_crm.agents' AS record_source, md5(agent_id) AS agent_hk, {AGENT_HASHDIFF} AS hashdiff
FROM agents_b{_b} WHERE agent_id IS NOT NULL""", f"agents_b{_b}")

# ------------------------------------------------- vault after batch 1 (first load) ---
NULL_TS = "CAST(NULL AS TIMESTAMP)"
PROP_ATTRS = ("address, suburb, postcode, state, bedrooms, bathrooms, land_size_sqm, "
              "property_type, year_built, listing_price")
OWNER_ATTRS = "full_name, email, phone, suburb, state, registration_date, investor_flag"
AGENT_ATTRS = "full_name, email, agency_name, license_no, region, accreditation_tier, active_from"
TX_ATTRS = "sale_price, sale_date, settlement_date, days_on_market, sale_type"

# ------------------------------------------- vault after batch 3 (closed form) ---
# A transaction is first loaded by batch 1 unless its key is 9 mod 10 (batch 2);
# later changes of its attributes or links must be ignored.
cte("tx_first", """SELECT * FROM stg_tx_b1
UNION ALL
SELECT * FROM stg_tx_b2 WHERE CAST(transaction_id AS BIGINT) % 10 = 9""", "stg_tx_b1", "stg_tx_b2")

cte("hub_property_b3", """SELECT md5(CAST(u.pkey AS VARCHAR)) AS property_hk,
       CAST(u.pkey AS VARCHAR) AS property_id,
       CASE WHEN u.pkey % 10 = 1 THEN TIMESTAMP '2024-01-02 00:00:00'
            ELSE TIMESTAMP '2024-01-01 00:00:00' END AS load_date,
       'bronze.property_raw' AS record_source
FROM used_props u""", "used_props")

# Property versions per key class after batches 1-3 (original suburb unless noted):
#   other                 [d1, open)
#   1 mod 10              [d2, open)
#   0 mod 20              [d1, d2) original, [d2, d3) updated, [d3, open) original
#   10, 70, 90 mod 100    [d1, d2) original, [d2, open) updated
#   30 mod 100            [late, d2) late, [d1, d2) original, [d2, open) updated
#   50 mod 100            [d1, d2) original, [d2, open) replaced
cte("prop_versions", f"""SELECT pkey, '' AS tag, {D1} AS load_date, {NULL_TS} AS load_end_date FROM used_props
  WHERE pkey % 10 NOT IN (0, 1)
UNION ALL SELECT pkey, '', {D2}, {NULL_TS} FROM used_props WHERE pkey % 10 = 1
UNION ALL SELECT pkey, '', {D1}, {D2} FROM used_props WHERE pkey % 10 = 0
UNION ALL SELECT pkey, '-updated', {D2}, {D3} FROM used_props WHERE pkey % 20 = 0
UNION ALL SELECT pkey, '', {D3}, {NULL_TS} FROM used_props WHERE pkey % 20 = 0
UNION ALL SELECT pkey, '-updated', {D2}, {NULL_TS} FROM used_props WHERE pkey % 100 IN (10, 30, 70, 90)
UNION ALL SELECT pkey, '-late', {LATE}, {D2} FROM used_props WHERE pkey % 100 = 30
UNION ALL SELECT pkey, '-replaced', {D2}, {NULL_TS} FROM used_props WHERE pkey % 100 = 50""",
    "used_props")

# The same after batches 1 and 3 only: nothing became "updated" in between, so the reverted ones never
# changed, and keys 1 mod 10 come with batch 3.
cte("prop_versions_gap", f"""SELECT pkey, '' AS tag, {D1} AS load_date,
       CASE WHEN pkey % 100 = 50 THEN {D2} WHEN pkey % 100 IN (10, 70, 90) THEN {D3} END AS load_end_date
FROM used_props WHERE pkey % 10 <> 1
UNION ALL SELECT pkey, '', {D3}, {NULL_TS} FROM used_props WHERE pkey % 10 = 1
UNION ALL SELECT pkey, '-updated', {D3}, {NULL_TS} FROM used_props WHERE pkey % 100 IN (10, 70, 90)
UNION ALL SELECT pkey, '-late', {LATE}, {D1} FROM used_props WHERE pkey % 100 = 30
UNION ALL SELECT pkey, '-replaced', {D2}, {NULL_TS} FROM used_props WHERE pkey % 100 = 50""",
    "used_props")

cte("sat_property_b3", f"""SELECT property_hk, {PROP_ATTRS}, {PROP_HASHDIFF} AS hashdiff, load_date,
       load_end_date, record_source
FROM (SELECT md5(CAST(v.pkey AS VARCHAR)) AS property_hk, p.address, p.suburb0 || v.tag AS suburb,
             p.postcode, p.state, p.bedrooms, p.bathrooms, p.land_size_sqm, p.property_type,
             p.year_built, p.listing_price, v.load_date, v.load_end_date,
             'bronze.property_raw' AS record_source
      FROM prop_versions v JOIN prop_base p ON p.pkey = v.pkey)""", "prop_versions", "prop_base")

cte("sat_property_gap", f"""SELECT property_hk, {PROP_ATTRS}, {PROP_HASHDIFF} AS hashdiff, load_date,
       load_end_date, record_source
FROM (SELECT md5(CAST(v.pkey AS VARCHAR)) AS property_hk, p.address, p.suburb0 || v.tag AS suburb,
             p.postcode, p.state, p.bedrooms, p.bathrooms, p.land_size_sqm, p.property_type,
             p.year_built, p.listing_price, v.load_date, v.load_end_date,
             'bronze.property_raw' AS record_source
      FROM prop_versions_gap v JOIN prop_base p ON p.pkey = v.pkey)""", "prop_versions_gap", "prop_base")

# Owners 0 mod 20 change phone in batch 2; agents 0 mod 5 become platinum in
# batch 2 (no change when they already were).  Batch 3 repeats batch 2.
cte("sat_owner_b3", f"""SELECT owner_hk, {OWNER_ATTRS}, hashdiff, load_date,
       CASE WHEN CAST(owner_id AS BIGINT) % 20 = 0 THEN {D2} END AS load_end_date, record_source
FROM stg_own_b1
UNION ALL
SELECT owner_hk, {OWNER_ATTRS}, hashdiff, load_date, {NULL_TS}, record_source
FROM stg_own_b2 WHERE CAST(owner_id AS BIGINT) % 20 = 0""", "stg_own_b1", "stg_own_b2")

cte("sat_agent_b3", f"""SELECT agent_hk, {AGENT_ATTRS}, hashdiff, load_date,
       CASE WHEN CAST(agent_id AS BIGINT) % 5 = 0 AND CAST(agent_id AS BIGINT) % 4 <> 3
            THEN {D2} END AS load_end_date, record_source
FROM stg_agt_b1
UNION ALL
SELECT agent_hk, {AGENT_ATTRS}, hashdiff, load_date, {NULL_TS}, record_source
FROM stg_agt_b2 WHERE CAST(agent_id AS BIGINT) % 5 = 0 AND CAST(agent_id AS BIGINT) % 4 <> 3""",
    "stg_agt_b1", "stg_agt_b2")

cte("hub_transaction_b3", "SELECT transaction_hk, transaction_id, load_date, record_source FROM tx_first",
    "tx_first")
cte("hub_owner_b3", "SELECT owner_hk, owner_id, load_date, record_source FROM stg_own_b1", "stg_own_b1")
cte("hub_agent_b3", "SELECT agent_hk, agent_id, load_date, record_source FROM stg_agt_b1", "stg_agt_b1")
for _name, _src in [("property", "property_hk"), ("buyer", "buyer_hk"),
                    ("seller", "seller_hk"), ("agent", "agent_hk")]:
    _other = {"property": "property_hk", "agent": "agent_hk"}.get(_name, "owner_hk")
    cte(f"lnk_{_name}_b3", f"""SELECT transaction_hk, {_src} AS {_other}, load_date, record_source
FROM tx_first""", "tx_first")
cte("sat_transaction_b3", f"""SELECT transaction_hk, {TX_ATTRS}, hashdiff, load_date,
       {NULL_TS} AS load_end_date, record_source FROM tx_first""", "tx_first")

# ------------------------------------------------------------------- marts ---


def half_away(num: str, den: str) -> str:
    """Whole-number ``num / den`` rounded half away from zero (den > 0)."""
    return f"CASE WHEN ({den}) <> 0 THEN sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))) END"


def scaled(whole: str, digits: int) -> str:
    """A whole number of 10^-digits units as DECIMAL(18, digits), exactly."""
    if digits == 0:
        return f"CAST({whole} AS DECIMAL(18,0))"
    unit = "0." + "0" * (digits - 1) + "1"
    return f"CAST(CAST({whole} AS DECIMAL(18,0)) * CAST({unit} AS DECIMAL({digits + 1},{digits})) AS DECIMAL(18,{digits}))"


_PCT_NUM = "(CAST(t.sale_price * 100 AS BIGINT) - CAST(p.listing_price * 100 AS BIGINT)) * 10000"
_PCT_DEN = "CAST(p.listing_price * 100 AS BIGINT)"

cte("mart_sales_b3", f"""SELECT t.transaction_id, t.sale_date, t.sale_price, t.sale_type, t.days_on_market,
       t.settlement_date, CAST(p.pkey AS VARCHAR) AS property_id, p.address,
       CASE WHEN p.pkey % 20 = 0 THEN p.suburb0
            WHEN p.pkey % 100 = 50 THEN p.suburb0 || '-replaced'
            WHEN p.pkey % 10 = 0 THEN p.suburb0 || '-updated' ELSE p.suburb0 END AS suburb,
       p.state, p.property_type, p.bedrooms, p.bathrooms, p.land_size_sqm, p.postcode,
       p.year_built, p.listing_price,
       {scaled(half_away(_PCT_NUM, _PCT_DEN), 2)} AS price_vs_listing_pct,
       a.full_name AS agent_name, a.agency_name, a.region AS agent_region
FROM tx_first t
JOIN prop_base p ON CAST(p.pkey AS VARCHAR) = t.property_id
LEFT JOIN agents_b1 a ON a.agent_id = t.agent_id""", "tx_first", "prop_base", "agents_b1")

cte("mart_agent_b3", f"""SELECT agent_name, agency_name, agent_region, count(*) AS total_transactions,
       {scaled(half_away("sum(CAST(sale_price * 100 AS BIGINT))", "100 * count(*)"), 0)} AS avg_sale_price,
       {scaled(half_away("10 * sum(days_on_market)", "count(*)"), 1)} AS avg_days_on_market,
       {scaled(half_away("sum(CAST(price_vs_listing_pct * 100 AS BIGINT))", "count(price_vs_listing_pct)"), 2)}
         AS avg_price_vs_listing_pct,
       min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date
FROM mart_sales_b3 WHERE agent_name IS NOT NULL
GROUP BY agent_name, agency_name, agent_region""", "mart_sales_b3")


def exact_median_sql(source: str, keys: str, value: str, out: str) -> str:
    """Exact median by rank, rounded half away from zero to whole units (cents input)."""
    return f"""SELECT {keys}, {scaled(half_away("2 * (lo + hi)", "400"), 0)} AS {out}
FROM (SELECT {keys},
             min(v) FILTER (WHERE rk = (n - 1) // 2) AS lo,
             min(v) FILTER (WHERE rk = n // 2) AS hi
      FROM (SELECT {keys}, CAST({value} * 100 AS BIGINT) AS v,
                   row_number() OVER (PARTITION BY {keys} ORDER BY {value}) - 1 AS rk,
                   count(*) OVER (PARTITION BY {keys}) AS n
            FROM {source} WHERE {value} IS NOT NULL)
      GROUP BY {keys})"""


cte("sales_month_b3", """SELECT *, CAST(date_trunc('month', sale_date) AS TIMESTAMP) AS sale_month
FROM mart_sales_b3""", "mart_sales_b3")
cte("median_b3", exact_median_sql("sales_month_b3", "suburb, state, sale_month", "sale_price",
                                  "median_sale_price"), "sales_month_b3")
cte("mart_trends_b3", f"""SELECT a.suburb, a.state, a.sale_month, a.transaction_count, a.avg_sale_price,
       m.median_sale_price, a.avg_days_on_market
FROM (SELECT suburb, state, sale_month, count(*) AS transaction_count,
             {scaled(half_away("sum(CAST(sale_price * 100 AS BIGINT))", "100 * count(*)"), 0)} AS avg_sale_price,
             {scaled(half_away("10 * sum(days_on_market)", "count(*)"), 1)} AS avg_days_on_market
      FROM sales_month_b3 GROUP BY suburb, state, sale_month) a
LEFT JOIN median_b3 m ON a.suburb IS NOT DISTINCT FROM m.suburb AND a.state IS NOT DISTINCT FROM m.state
  AND a.sale_month IS NOT DISTINCT FROM m.sale_month""", "sales_month_b3", "median_b3")

cte("mart_owner_b3", """SELECT o.owner_id, o.full_name, o.suburb, o.state, o.investor_flag,
       coalesce(r.bought, 0) AS total_purchases, coalesce(r.sold, 0) AS total_sales,
       coalesce(r.bought - r.sold, 0) AS net_properties_held
FROM owners_b1 o LEFT JOIN (
  SELECT id, count(*) FILTER (WHERE buys) AS bought, count(*) FILTER (WHERE NOT buys) AS sold
  FROM (SELECT buyer_id AS id, TRUE AS buys FROM tx_first UNION ALL SELECT seller_id, FALSE FROM tx_first)
  GROUP BY id) r ON r.id = o.owner_id""",
    "owners_b1", "tx_first")


# ---------------------------------------------------------------- queries ---
_TABLE_CTE = {
    "stg_transactions": "stg_tx_b3", "stg_properties": "stg_prop_b3",
    "stg_owners": "stg_own_b3", "stg_agents": "stg_agt_b3",
    "hub_property": "hub_property_b3", "hub_owner": "hub_owner_b3",
    "hub_agent": "hub_agent_b3", "hub_transaction": "hub_transaction_b3",
    "lnk_transaction_property": "lnk_property_b3", "lnk_transaction_buyer": "lnk_buyer_b3",
    "lnk_transaction_seller": "lnk_seller_b3", "lnk_transaction_agent": "lnk_agent_b3",
    "sat_property_details": "sat_property_b3", "sat_owner_details": "sat_owner_b3",
    "sat_agent_details": "sat_agent_b3", "sat_transaction_details": "sat_transaction_b3",
    "mart_property_sales": "mart_sales_b3", "mart_agent_performance": "mart_agent_b3",
    "mart_suburb_trends": "mart_trends_b3", "mart_owner_portfolio": "mart_owner_b3",
}
_LAYER_COUNTS = [
    ("bronze", "property_raw", "raw_b3"), ("bronze", "src_crm_owners", "owners_b3"),
    ("bronze", "src_crm_agents", "agents_b3"),
    *[("silver", t, _TABLE_CTE[t]) for t in
      ["stg_transactions", "stg_properties", "stg_owners", "stg_agents"]],
    *[("gold", t, c) for t, c in _TABLE_CTE.items() if t.startswith(("hub_", "lnk_", "sat_"))],
    *[("mart", t, c) for t, c in _TABLE_CTE.items() if t.startswith("mart_")],
]


# The 56 declared tests; "> table" is a relationship to the same column there.
_DECLARED = """
silver stg_transactions transaction_id not_null unique
silver stg_transactions transaction_hk not_null unique
silver stg_transactions property_id not_null
silver stg_transactions sale_price not_null
silver stg_transactions sale_date not_null
silver stg_properties property_id not_null unique
silver stg_properties property_hk not_null unique
silver stg_properties suburb not_null
silver stg_owners owner_id not_null unique
silver stg_owners owner_hk not_null unique
silver stg_agents agent_id not_null unique
silver stg_agents agent_hk not_null unique
gold hub_property property_hk not_null unique
gold hub_property property_id not_null unique
gold hub_owner owner_hk not_null unique
gold hub_agent agent_hk not_null unique
gold hub_transaction transaction_hk not_null unique
gold lnk_transaction_property transaction_hk not_null >hub_transaction
gold lnk_transaction_property property_hk not_null >hub_property
gold sat_property_details property_hk not_null >hub_property
gold sat_property_details hashdiff not_null
gold sat_owner_details owner_hk not_null >hub_owner
gold sat_owner_details hashdiff not_null
gold sat_agent_details agent_hk not_null >hub_agent
gold sat_agent_details hashdiff not_null
gold sat_transaction_details transaction_hk not_null >hub_transaction
gold sat_transaction_details hashdiff not_null
mart mart_property_sales transaction_id not_null unique
mart mart_property_sales sale_price not_null
mart mart_property_sales suburb not_null
mart mart_agent_performance agent_name not_null
mart mart_agent_performance total_transactions not_null
mart mart_suburb_trends suburb not_null
mart mart_suburb_trends sale_month not_null
mart mart_owner_portfolio owner_id not_null unique
"""


def _dq_results_sql() -> str:
    rows, names = [], set()
    for line in _DECLARED.strip().splitlines():
        layer, table, column, *tests = line.split()
        src = _TABLE_CTE[table]
        names.add(src)
        for test in tests:
            label = test
            if test == "not_null":
                count = f"SELECT count(*) FROM {src} WHERE {column} IS NULL"
            elif test == "unique":
                count = (f"SELECT count(*) FROM (SELECT {column} FROM {src} WHERE {column} IS NOT NULL "
                         f"GROUP BY {column} HAVING count(*) > 1)")
            else:
                parent = _TABLE_CTE[test[1:]]
                names.add(parent)
                label = f"relationships:{test[1:]}.{column}"
                count = (f"SELECT count(*) FROM {src} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
                         f"(SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})")
            rows.append(f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{column}' AS column_name, "
                        f"'{label}' AS test, CAST(({count}) AS BIGINT) AS violations")
    return build("\nUNION ALL\n".join(rows), *sorted(names))


def _layer_counts_sql() -> str:
    rows = [f"SELECT '{layer}' AS layer, '{table}' AS table_name, "
            f"CAST((SELECT count(*) FROM {src}) AS BIGINT) AS row_count"
            for layer, table, src in _LAYER_COUNTS]
    return build("\nUNION ALL\n".join(rows), *[src for _, _, src in _LAYER_COUNTS])


def _first_load(hk: str, attrs: str, src: str) -> str:
    return build(f"SELECT {hk}, {attrs}, hashdiff, load_date, {NULL_TS} AS load_end_date, "
                 f"record_source FROM {src}", src)


def oracle_queries() -> dict[str, str]:
    month = "CAST(date_trunc('month', sale_date) AS TIMESTAMP)"
    q = {
        "bronze_property_raw": build("SELECT * FROM raw_b2", "raw_b2"),
        "stg_transactions": build("SELECT * FROM stg_tx_b2", "stg_tx_b2"),
        "stg_properties": build("SELECT * FROM stg_prop_b2", "stg_prop_b2"),
        "stg_owners": build("SELECT * FROM stg_own_b2", "stg_own_b2"),
        "stg_agents": build("SELECT * FROM stg_agt_b2", "stg_agt_b2"),
        "hub_property": build("SELECT property_hk, property_id, load_date, record_source "
                              "FROM stg_prop_b2", "stg_prop_b2"),
        "hub_owner": build("SELECT owner_hk, owner_id, load_date, record_source FROM stg_own_b2",
                           "stg_own_b2"),
        "hub_agent": build("SELECT agent_hk, agent_id, load_date, record_source FROM stg_agt_b2",
                           "stg_agt_b2"),
        "hub_transaction": build("SELECT transaction_hk, transaction_id, load_date, record_source "
                                 "FROM stg_tx_b2", "stg_tx_b2"),
        "lnk_transaction_property": build("SELECT transaction_hk, property_hk, load_date, "
                                          "record_source FROM stg_tx_b2", "stg_tx_b2"),
        "lnk_transaction_buyer": build("SELECT transaction_hk, buyer_hk AS owner_hk, load_date, "
                                       "record_source FROM stg_tx_b2", "stg_tx_b2"),
        "lnk_transaction_seller": build("SELECT transaction_hk, seller_hk AS owner_hk, load_date, "
                                        "record_source FROM stg_tx_b2", "stg_tx_b2"),
        "lnk_transaction_agent": build("SELECT transaction_hk, agent_hk, load_date, record_source "
                                       "FROM stg_tx_b2", "stg_tx_b2"),
        "sat_property_details": _first_load("property_hk", PROP_ATTRS, "stg_prop_b2"),
        "sat_owner_details": _first_load("owner_hk", OWNER_ATTRS, "stg_own_b2"),
        "sat_agent_details": _first_load("agent_hk", AGENT_ATTRS, "stg_agt_b2"),
        "sat_transaction_details": _first_load("transaction_hk", TX_ATTRS, "stg_tx_b2"),
        **{f"hub_{n}_incremental": build(f"SELECT * FROM hub_{n}_b3", f"hub_{n}_b3")
           for n in ("property", "owner", "agent", "transaction")},
        **{f"lnk_transaction_{n}_incremental": build(f"SELECT * FROM lnk_{n}_b3", f"lnk_{n}_b3")
           for n in ("property", "buyer", "seller", "agent")},
        "sat_property_gap": build("SELECT * FROM sat_property_gap", "sat_property_gap"),
        "hub_transaction_replay": build("SELECT * FROM hub_transaction_b3", "hub_transaction_b3"),
        "sat_property_replay": build("SELECT * FROM sat_property_b3", "sat_property_b3"),
        "hub_transaction_replay_resumed": build("SELECT * FROM hub_transaction_b3", "hub_transaction_b3"),
        # batch 1 brought the keys 1 mod 50 only
        "hub_transaction_rebucketed": build("""SELECT transaction_hk, transaction_id, load_date, record_source FROM stg_tx_b1
WHERE CAST(transaction_id AS BIGINT) % 50 = 1
UNION ALL SELECT transaction_hk, transaction_id, load_date, record_source FROM stg_tx_b2
WHERE CAST(transaction_id AS BIGINT) % 50 <> 1""", "stg_tx_b1", "stg_tx_b2"),
        "sat_property_rebucketed": build(f"""SELECT a.property_hk, {", ".join(f"a.{c}" for c in PROP_ATTRS.split(", "))}, a.hashdiff,
       a.load_date, CASE WHEN b.hashdiff <> a.hashdiff THEN b.load_date END AS load_end_date, a.record_source
FROM stg_prop_b1 a JOIN stg_prop_b2 b USING (property_hk)
WHERE a.property_id IN (SELECT property_id FROM stg_tx_b1 WHERE CAST(transaction_id AS BIGINT) % 50 = 1)
UNION ALL SELECT b.property_hk, {", ".join(f"b.{c}" for c in PROP_ATTRS.split(", "))}, b.hashdiff, b.load_date, {NULL_TS}, b.record_source
FROM stg_prop_b2 b LEFT JOIN (SELECT * FROM stg_prop_b1 WHERE property_id IN (
  SELECT property_id FROM stg_tx_b1 WHERE CAST(transaction_id AS BIGINT) % 50 = 1)) a USING (property_hk)
WHERE a.hashdiff IS NULL OR a.hashdiff <> b.hashdiff""", "stg_prop_b1", "stg_prop_b2", "stg_tx_b1"),
        "sat_property_as_of_indexed": build("""SELECT * FROM sat_property_b3 WHERE load_date <= TIMESTAMP '2024-01-02 12:00:00'
AND (load_end_date IS NULL OR load_end_date > TIMESTAMP '2024-01-02 12:00:00')""", "sat_property_b3"),
        "dq_results_delta": _dq_results_sql(),
        "jdbc_text_key_read": build("SELECT * FROM owners_b1", "owners_b1"),
        "ingest_counts": build("\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, {b} AS batch, count(*) AS row_count, count(DISTINCT _loaded_at) AS load_instants FROM {cte_}_b{b}"
            for name, cte_ in (("property_raw", "raw"), ("src_crm_owners", "owners"), ("src_crm_agents", "agents")) for b in (1, 2, 3)),
            *[f"{c}_b{b}" for c in ("raw", "owners", "agents") for b in (1, 2, 3)]),
        "sat_property_one_key": build("SELECT * FROM sat_property_b3 WHERE property_hk = md5('30') "
                                      "ORDER BY load_date", "sat_property_b3"),
        "sat_property_one_key_latest": build("SELECT * FROM sat_property_b3 WHERE property_hk = md5('30') "
                                             "ORDER BY load_date DESC LIMIT 1", "sat_property_b3"),
        "mart_sql_read": build("SELECT * FROM mart_sales_b3", "mart_sales_b3"),
        "stg_properties_latest": build(f"""SELECT *, {PROP_HASHDIFF} AS hashdiff
FROM (SELECT CAST(p.pkey AS VARCHAR) AS property_id, p.address,
             CASE WHEN p.pkey % 10 = 0 THEN p.suburb0 || '-updated' ELSE p.suburb0 END
               || CASE WHEN u.c THEN '-c' WHEN u.b THEN '-b' ELSE '-a' END AS suburb,
             p.postcode, p.state, p.bedrooms, p.bathrooms, p.land_size_sqm, p.property_type, p.year_built,
             p.listing_price, CASE WHEN u.c THEN NULL WHEN u.b THEN {D3} ELSE {D1} END AS load_date,
             'bronze.property_raw' AS record_source, md5(CAST(p.pkey AS VARCHAR)) AS property_hk
      FROM prop_base p JOIN (SELECT pkey, bool_or(k % 3 = 1) AS b, bool_or(k % 3 = 2) AS c
                             FROM tx_base GROUP BY pkey) u ON u.pkey = p.pkey)""", "prop_base", "tx_base"),
        "dq_results_red": build("""SELECT 'red' AS layer, * FROM (
SELECT 'lineitem' AS table_name, 'l_orderkey' AS column_name, 'unique' AS test,
       (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'lineitem', 'l_partkey', 'unique',
       (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_partkey HAVING count(*) > 1))
UNION ALL SELECT 'orders', 'o_orderkey', 'unique',
       (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
UNION ALL SELECT 'property_raw', 'agent_id', 'not_null', (SELECT count(*) FROM tx_base WHERE k % 50 = 0)
UNION ALL SELECT 'property_raw', 'transaction_id', 'not_null', 0
UNION ALL SELECT 'orders', 'o_orderkey', 'relationships:lineitem.l_orderkey',
       (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
UNION ALL SELECT 'lineitem', 'l_orderkey', 'relationships:orders.o_orderkey',
       (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)))""", "tx_base"),
        "sat_transaction_insert_only": build("SELECT * FROM sat_transaction_b3", "sat_transaction_b3"),
        "sat_property_scd2": build("SELECT * FROM sat_property_b3", "sat_property_b3"),
        "sat_owner_scd2": build("SELECT * FROM sat_owner_b3", "sat_owner_b3"),
        "sat_agent_scd2": build("SELECT * FROM sat_agent_b3", "sat_agent_b3"),
        "sat_property_current": build("SELECT * FROM sat_property_b3 WHERE load_end_date IS NULL",
                                      "sat_property_b3"),
        # at the as-of instant every key first loaded by batch 1 shows its
        # batch-1 version (the overlapping late version loses: older load)
        "sat_property_as_of": build(f"SELECT * FROM sat_property_b3 WHERE load_date = {D1}",
                                    "sat_property_b3"),
        "sat_property_history": build(
            "SELECT *, CAST(row_number() OVER (PARTITION BY property_hk ORDER BY load_date) AS INTEGER) "
            "AS version "
            "FROM sat_property_b3", "sat_property_b3"),
        "mart_property_sales": build("SELECT * FROM mart_sales_b3", "mart_sales_b3"),
        "mart_agent_performance": build("SELECT * FROM mart_agent_b3", "mart_agent_b3"),
        "mart_suburb_trends": build("SELECT * FROM mart_trends_b3", "mart_trends_b3"),
        "mart_owner_portfolio": build("SELECT * FROM mart_owner_b3", "mart_owner_b3"),
        "dq_results": _dq_results_sql(),
        "dq_unique_violations": """SELECT l_orderkey, l_linenumber, count(*) AS n_records
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "dq_orphans": """SELECT o.o_orderkey FROM orders o
WHERE o.o_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
        "dq_null_agents": build("SELECT transaction_id, agent_id FROM raw_b2 WHERE agent_id IS NULL",
                                "raw_b2"),
        "dash_sales_volume": build(f"SELECT {month} AS sale_month, count(*) AS transaction_count "
                                   f"FROM mart_sales_b3 GROUP BY {month}", "mart_sales_b3"),
        "dash_median_price_by_suburb": build(
            exact_median_sql("mart_sales_b3", "suburb", "sale_price", "median_sale_price"),
            "mart_sales_b3"),
        "dash_sale_types": build("SELECT sale_type, count(*) AS transaction_count FROM mart_sales_b3 "
                                 "GROUP BY sale_type", "mart_sales_b3"),
        "dash_top_agents": build(
            "SELECT agent_name, agency_name, agent_region, total_transactions FROM mart_agent_b3 "
            "ORDER BY total_transactions DESC, agent_name ASC, agency_name ASC NULLS FIRST, "
            "agent_region ASC NULLS FIRST LIMIT 10", "mart_agent_b3"),
        "dash_agent_days_on_market": build(
            "SELECT agent_name, agency_name, agent_region, avg_days_on_market FROM mart_agent_b3",
            "mart_agent_b3"),
        "dash_agent_price_vs_listing": build(
            "SELECT agent_name, agency_name, agent_region, avg_price_vs_listing_pct FROM mart_agent_b3",
            "mart_agent_b3"),
        "dash_median_trend": build(
            "SELECT suburb, state, sale_month, median_sale_price FROM mart_trends_b3", "mart_trends_b3"),
        "dash_heatmap": build(f"SELECT suburb, {month} AS sale_month, count(*) AS transaction_count "
                              f"FROM mart_sales_b3 GROUP BY suburb, {month}", "mart_sales_b3"),
        "dash_investor_split": build("SELECT investor_flag, count(*) AS owner_count FROM mart_owner_b3 "
                                     "GROUP BY investor_flag", "mart_owner_b3"),
        "dash_net_properties": build("SELECT net_properties_held, count(*) AS owner_count "
                                     "FROM mart_owner_b3 GROUP BY net_properties_held", "mart_owner_b3"),
        "dash_multi_property": build("SELECT net_properties_held, count(*) AS owner_count "
                                     "FROM mart_owner_b3 WHERE net_properties_held > 1 "
                                     "GROUP BY net_properties_held", "mart_owner_b3"),
        "layer_row_counts": _layer_counts_sql(),
        "csv_round_trip": build("SELECT * FROM raw_b2", "raw_b2"),
        "jdbc_round_trip": build("SELECT * FROM owners_b1", "owners_b1"),
    }
    return q
