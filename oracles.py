"""The expected result of each registered query, in SQL over the given parquet tables."""

from __future__ import annotations

import re

# Categories that occur in the given data.
PART_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def _key(prefix: str, width: int, number: str) -> str:
    text = f"cast({number} as varchar)"
    return f"'{prefix}-' || lpad({text}, cast(greatest({width}, length({text})) as integer), '0')"


def _cast(column: str, kind: str) -> str:
    return f"try_cast(nullif(trim({column}), '') as {kind}) as {column}"


def _round(value: str, digits: int) -> str:
    scale = "1" + "0" * digits
    return f"round(({value}) * {scale}.0::double) / {scale}.0::double" if digits else f"round({value})"


_DEFECT = "(l_orderkey * 7 + l_partkey) % 400"
_DAY = "cast(cast(l_shipdate as date) as varchar)"
_QTY = "cast(cast(l_quantity as integer) as varchar)"
# The validity rule of a sale row, and the reasons in the order they are reported.
_VALID = """(
    sale_date is not null and store_id is not null and product_id is not null
    and quantity is not null and quantity > 0
    and amount_eur is not null and amount_eur >= 0
    and discount_pct is not null and discount_pct between 0 and 1)"""
_REASON = """case
    when sale_date is null then 'missing or unparseable sale_date'
    when store_id is null then 'missing store_id'
    when product_id is null then 'missing product_id'
    when quantity is null then 'missing or unparseable quantity'
    when quantity <= 0 then 'non-positive quantity'
    when amount_eur is null then 'missing or unparseable amount_eur'
    when amount_eur < 0 then 'negative amount_eur'
    when discount_pct is null then 'missing or unparseable discount_pct'
    else 'discount_pct outside 0-1' end"""

# name -> SELECT; a SELECT may read the given tables and the names listed here.
RELATIONS = {
    "raw_suppliers": f"""
        select {_key('SUP', 4, 's_suppkey')} as supplier_id, s_name as supplier_name,
               n_name as country, r_name as city,
               cast(4 + s_suppkey % 17 as varchar) as nominal_lead_time_days,
               cast((75 + (s_suppkey * 37) % 25) / 100.0::double as varchar) as reliability_score,
               '1995-01-01' as valid_from
        from supplier join nation on s_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "raw_products": f"""
        select {_key('SKU', 5, 'p_partkey')} as product_id, p_name as product_name,
               p_type as category,
               {_key('SUP', 4, '(p_partkey % (select count(*) from supplier))')} as supplier_id,
               cast(floor(p_retailprice * (50 + (p_partkey * 7) % 30)) / 100.0::double as varchar)
                 as unit_cost_eur,
               cast(p_retailprice as varchar) as unit_price_eur
        from part""",
    "raw_stores": f"""
        select {_key('STO', 3, 'n_nationkey')} as store_id, n_name as store_name,
               n_name as city, r_name as region
        from nation join region on n_regionkey = r_regionkey""",
    "raw_sales": f"""
        select 'SAL-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-'
                 || l_suppkey || '-' || {_DAY} as sale_id,
               case {_DEFECT} when 1 then '' when 8 then 'not-a-date' else {_DAY} end
                 as sale_date,
               case when {_DEFECT} <> 9 then {_key('STO', 3, 'c_nationkey')} end as store_id,
               case when {_DEFECT} <> 11 then {_key('SKU', 5, 'l_partkey')} end as product_id,
               case {_DEFECT} when 2 then '0' when 3 then '-3' when 4 then ' '
                 when 10 then '  ' || {_QTY} || ' ' else {_QTY} end as quantity,
               cast(p_retailprice as varchar) as unit_price_eur,
               case {_DEFECT} when 5 then '1.5' when 12 then ''
                 else cast(l_discount as varchar) end as discount_pct,
               case {_DEFECT} when 6 then 'abc' when 7 then '-30.0'
                 else cast(round(l_quantity * p_retailprice * (1 - l_discount) * 100)
                           / 100.0::double as varchar) end as amount_eur
        from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey join part on l_partkey = p_partkey""",
    "raw_inventory_snapshots": f"""
        select cast(cast((select max(cast(l_shipdate as date)) from lineitem) - k as date)
                 as varchar) as snapshot_date,
               {_key('STO', 3, 'n_nationkey')} as store_id,
               {_key('SKU', 5, 'p_partkey')} as product_id,
               cast(greatest(0, (p_partkey * 31 + n_nationkey * 17 + k * 7) % 61
                 - case when score >= 95 then 0 when score >= 85 then 2 else 5 end) as varchar)
                 as on_hand_qty,
               cast(10 + p_partkey % 20 as varchar) as reorder_point,
               case when (p_partkey + n_nationkey + k) % 3 = 0 then '20' else '0' end
                 as in_transit_qty
        from (select p_partkey,
                     75 + ((p_partkey % (select count(*) from supplier)) * 37) % 25 as score
              from part)
        cross join nation cross join (select cast(unnest(range(7)) as integer) as k)""",
    "raw_purchase_orders": f"""
        select {_key('PO', 6, 'o_orderkey')} as po_id, cast(od as varchar) as order_date,
               {_key('SUP', 4, 'sk')} as supplier_id, {_key('SKU', 5, 'pk')} as product_id,
               {_key('STO', 3, 'c_nationkey')} as store_id, cast(ordered as varchar) as ordered_qty,
               cast(promised as varchar) as promised_date,
               case when o_orderstatus = 'O' then '' else cast(cast(promised +
                 cast(case when (o_orderkey * 13) % 101 >= 75 + (sk * 37) % 25
                      then 1 + o_orderkey % 7 else 0 end as integer) as date) as varchar) end
                 as actual_delivery_date,
               case when o_orderstatus = 'O' then '' when o_orderkey % 11 = 0
                 then cast(cast(floor(ordered * 0.8::double) as bigint) as varchar)
                 else cast(ordered as varchar) end as received_qty
        from (select *, cast(od + cast(4 + sk % 17 as integer) as date) as promised from (
                select o_orderkey, o_orderstatus, c_nationkey, cast(o_orderdate as date) as od,
                       o_orderkey % (select count(*) from supplier) as sk,
                       o_orderkey % (select count(*) from part) as pk,
                       1 + o_orderkey % 40 as ordered
                from orders join customer on o_custkey = c_custkey))""",
    "stg_suppliers": f"""
        select supplier_id, supplier_name, country, city,
               {_cast('nominal_lead_time_days', 'integer')},
               {_cast('reliability_score', 'double')}, {_cast('valid_from', 'date')}
        from raw_suppliers""",
    "stg_products": f"""
        select product_id, product_name, category, supplier_id,
               {_cast('unit_cost_eur', 'double')}, {_cast('unit_price_eur', 'double')}
        from raw_products""",
    "stg_stores": "select * from raw_stores",
    "typed_sales": f"""
        select sale_id, {_cast('sale_date', 'date')}, store_id, product_id,
               {_cast('quantity', 'integer')}, {_cast('unit_price_eur', 'double')},
               {_cast('discount_pct', 'double')}, {_cast('amount_eur', 'double')}
        from raw_sales""",
    "stg_sales": f"select * from typed_sales where {_VALID}",
    "stg_inventory_snapshots": f"""
        select {_cast('snapshot_date', 'date')}, store_id, product_id,
               {_cast('on_hand_qty', 'integer')}, {_cast('reorder_point', 'integer')},
               {_cast('in_transit_qty', 'integer')}
        from raw_inventory_snapshots""",
    "stg_purchase_orders": f"""
        select po_id, {_cast('order_date', 'date')}, supplier_id, product_id, store_id,
               {_cast('ordered_qty', 'integer')}, {_cast('promised_date', 'date')},
               {_cast('actual_delivery_date', 'date')}, {_cast('received_qty', 'integer')}
        from raw_purchase_orders""",
    "quarantine": f"""
        select *, {_REASON} as quarantine_reason from typed_sales where not ({_VALID})""",
    "demand": """
        select store_id, product_id, cast(sum(quantity) as bigint) as units_last_28d,
               sum(quantity) / 28.0::double as avg_daily_units
        from stg_sales
        where sale_date > (select max(sale_date) - 28 from stg_sales)
        group by all""",
    "fct_inventory": f"""
        select snapshot_date, store_id, product_id, on_hand_qty, reorder_point, in_transit_qty,
               coalesce(rate, 0.0::double) as avg_daily_units,
               on_hand_qty = 0 as is_stockout,
               on_hand_qty <= reorder_point as below_reorder_point,
               {_round('on_hand_qty / nullif(rate, 0)', 1)} as days_of_cover
        from stg_inventory_snapshots
        left join (select store_id, product_id, avg_daily_units as rate from demand)
          using (store_id, product_id)""",
    "fct_purchase_orders": """
        select *,
               cast(promised_date - order_date as integer) as promised_lead_time_days,
               cast(actual_delivery_date - order_date as integer) as actual_lead_time_days,
               cast(actual_delivery_date - promised_date as integer) as delay_days,
               actual_delivery_date is null as is_open,
               case when actual_delivery_date is null then null
                 when actual_delivery_date > promised_date then true else false end as is_late
        from stg_purchase_orders""",
    "dim_suppliers": """
        select supplier_id, supplier_name, country, city, nominal_lead_time_days,
               reliability_score,
               case when reliability_score >= 0.95::double then 'High'
                 when reliability_score >= 0.85::double then 'Medium' else 'Low' end
                 as reliability_tier, valid_from
        from stg_suppliers""",
    "dim_products": f"""
        select product_id, product_name, category, supplier_id, unit_cost_eur, unit_price_eur,
               {_round('unit_price_eur - unit_cost_eur', 2)} as unit_margin_eur,
               {_round('(unit_price_eur - unit_cost_eur) / nullif(unit_price_eur, 0)', 3)}
                 as margin_pct
        from stg_products""",
    "dim_stores": "select * from stg_stores",
    "dim_date": """
        select date_day, cast(extract(year from date_day) as integer) as year,
               cast(extract(month from date_day) as integer) as month,
               cast(extract(day from date_day) as integer) as day_of_month,
               cast(extract(isodow from date_day) as integer) as iso_day_of_week,
               cast(extract(week from date_day) as integer) as iso_week,
               case extract(isodow from date_day) when 1 then 'Monday' when 2 then 'Tuesday'
                 when 3 then 'Wednesday' when 4 then 'Thursday' when 5 then 'Friday'
                 when 6 then 'Saturday' else 'Sunday' end as weekday_name,
               extract(isodow from date_day) >= 6 as is_weekend
        from (select distinct snapshot_date as date_day from stg_inventory_snapshots)""",
    "fct_sales": "select * from stg_sales",
    "prior_day": """
        select cast(max(sale_date) - 14 as date) as d from stg_sales""",
    "prior_sales": """
        select sale_id, sale_date, store_id, product_id, quantity, unit_price_eur,
               discount_pct, amount_eur + 1 as amount_eur
        from stg_sales cross join prior_day
        where sale_date <= d and quantity % 7 <> 3""",
    "sales_batch": """
        select * from stg_sales where sale_date >= (select max(sale_date) from prior_sales)""",
    "merged_sales": """
        select p.* from prior_sales p
        where not exists (select 1 from sales_batch b where b.sale_id = p.sale_id)
        union all select * from sales_batch""",
    "partial_sales": """
        select sale_id, sale_date, store_id, product_id, quantity, unit_price_eur,
               discount_pct, amount_eur + 1 as amount_eur
        from stg_sales cross join prior_day
        where sale_date < d or (sale_date = d and quantity <= 25)""",
    "partial_batch": """
        select * from stg_sales where sale_date >= (select max(sale_date) from partial_sales)""",
    "suppliers_day2": """
        select supplier_id, supplier_name, country, city,
               case when nominal_lead_time_days = 6 then 5 else nominal_lead_time_days end
                 as nominal_lead_time_days,
               case when nominal_lead_time_days = 9 then null else reliability_score end
                 as reliability_score, valid_from
        from stg_suppliers where nominal_lead_time_days <> 11""",
    "suppliers_history": """
        select o.*, case when n.supplier_id is not null and (
                 o.nominal_lead_time_days is distinct from n.nominal_lead_time_days
                 or o.reliability_score is distinct from n.reliability_score)
               then date '2026-07-19' end as valid_to_day, date '2026-07-18' as valid_from_day
        from stg_suppliers o left join suppliers_day2 n using (supplier_id)
        union all
        select n.*, null, date '2026-07-19'
        from suppliers_day2 n join stg_suppliers o using (supplier_id)
        where o.nominal_lead_time_days is distinct from n.nominal_lead_time_days
           or o.reliability_score is distinct from n.reliability_score""",
    "last_month": """
        select max(sale_date) as d, substr(cast(max(sale_date) as varchar), 1, 7) as m
        from stg_sales""",
    "last_day": """
        select * from stg_sales where sale_date = (select max(sale_date) from stg_sales)""",
    "raw_again": """
        select sale_id, sale_date, store_id, product_id, quantity, unit_price_eur, discount_pct,
               case when substr(sale_date, 1, 7) = m then '1.00' else amount_eur end as amount_eur
        from raw_sales cross join last_month
        where substr(sale_date, 1, 7) <> m
           or coalesce(try_cast(trim(quantity) as integer) % 2 <> 0, true)""",
    "typed_again": f"""
        select sale_id, {_cast('sale_date', 'date')}, store_id, product_id,
               {_cast('quantity', 'integer')}, {_cast('unit_price_eur', 'double')},
               {_cast('discount_pct', 'double')}, {_cast('amount_eur', 'double')}
        from raw_again""",
    "valid_again": f"select * from typed_again where {_VALID}",
    "merged_again": """
        select s.* from stg_sales s
        where not exists (select 1 from valid_again v cross join last_month
                          where v.sale_id = s.sale_id and v.sale_date >= d)
        union all
        select v.* from valid_again v cross join last_month where v.sale_date >= d""",
    "latest": """
        select * from fct_inventory
        where snapshot_date = (select max(snapshot_date) from fct_inventory)""",
    "policy": """
        select d.store_id, d.product_id, p.supplier_id, d.avg_daily_units,
               s.nominal_lead_time_days,
               cast(ceil(d.avg_daily_units * s.nominal_lead_time_days
                 + 1.5::double * sqrt(d.avg_daily_units * s.nominal_lead_time_days)) as bigint)
                 as policy_reorder_point,
               cast(ceil(d.avg_daily_units * s.nominal_lead_time_days
                 + 1.5::double * sqrt(d.avg_daily_units * s.nominal_lead_time_days)) as bigint)
                 + cast(ceil(d.avg_daily_units * 14) as bigint) as order_up_to
        from demand d join stg_products p using (product_id)
        join stg_suppliers s on p.supplier_id = s.supplier_id""",
    "usage_log": """
        select 'WH-' || (user_id % 3) as warehouse, event_type as resource, cast(ts as date) as usage_date, value as amount
        from events""",
}


def _needs(sql: str) -> list[str]:
    """Relations a text names, in an order in which they can be defined."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in RELATIONS:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit_one(name)

    def visit_one(name: str) -> None:
        if name in ordered:
            return
        for other in RELATIONS:
            if other != name and re.search(rf"\b{other}\b", RELATIONS[name]):
                visit_one(other)
        ordered.append(name)

    visit(sql)
    return ordered


def over(select: str) -> str:
    """A query with the relations it needs in front."""
    names = _needs(select)
    if not names:
        return select
    ctes = ",\n".join(f"{n} as materialized ({RELATIONS[n]})" for n in names)
    return f"with {ctes}\n{select}"


# The declared checks, one a line: table, kind, column, then bounds, values or parent.
CHECKS = """
stg_suppliers unique supplier_id
stg_suppliers not_null supplier_id supplier_name nominal_lead_time_days reliability_score valid_from
stg_suppliers range nominal_lead_time_days 1 60
stg_suppliers range reliability_score 0 1
stg_products expression unit_price_eur >= unit_cost_eur
stg_products unique product_id
stg_products not_null product_id category supplier_id unit_cost_eur unit_price_eur
stg_products accepted category CATEGORIES
stg_products references supplier_id stg_suppliers supplier_id
stg_products range unit_cost_eur 0
stg_products range unit_price_eur 0
stg_stores unique store_id
stg_stores not_null store_id store_name region
stg_sales unique sale_id
stg_sales not_null sale_id sale_date store_id product_id quantity discount_pct amount_eur
stg_sales references store_id stg_stores store_id
stg_sales references product_id stg_products product_id
stg_sales range quantity 1
stg_sales range discount_pct 0 1
stg_sales range amount_eur 0
stg_inventory_snapshots combination snapshot_date store_id product_id
stg_inventory_snapshots not_null snapshot_date store_id product_id on_hand_qty reorder_point in_transit_qty
stg_inventory_snapshots references store_id stg_stores store_id
stg_inventory_snapshots references product_id stg_products product_id
stg_inventory_snapshots range on_hand_qty 0
stg_inventory_snapshots range reorder_point 0
stg_inventory_snapshots range in_transit_qty 0
stg_purchase_orders expression promised_date >= order_date
stg_purchase_orders unique po_id
stg_purchase_orders not_null po_id order_date supplier_id product_id store_id ordered_qty promised_date
stg_purchase_orders references supplier_id stg_suppliers supplier_id
stg_purchase_orders references product_id stg_products product_id
stg_purchase_orders references store_id stg_stores store_id
stg_purchase_orders range ordered_qty 1
stg_purchase_orders range received_qty 0
dim_suppliers unique supplier_id
dim_suppliers not_null supplier_id reliability_tier reliability_score
dim_suppliers accepted reliability_tier High Medium Low
dim_suppliers range reliability_score 0 1
dim_products unique product_id
dim_products not_null product_id supplier_id margin_pct
dim_products references supplier_id dim_suppliers supplier_id
dim_products range margin_pct 0 1
dim_stores unique store_id
dim_stores not_null store_id region
dim_date unique date_day
dim_date not_null date_day iso_day_of_week
dim_date range iso_day_of_week 1 7
fct_sales unique sale_id
fct_sales not_null sale_id sale_date store_id product_id quantity amount_eur
fct_sales references sale_date dim_date date_day
fct_sales references store_id dim_stores store_id
fct_sales references product_id dim_products product_id
fct_sales range quantity 1
fct_sales range amount_eur 0
fct_sales revenue_reconciles
fct_inventory combination snapshot_date store_id product_id
fct_inventory not_null snapshot_date store_id product_id on_hand_qty is_stockout
fct_inventory references snapshot_date dim_date date_day
fct_inventory references store_id dim_stores store_id
fct_inventory references product_id dim_products product_id
fct_inventory range on_hand_qty 0
fct_inventory range days_of_cover 0
fct_purchase_orders unique po_id
fct_purchase_orders not_null po_id order_date supplier_id product_id store_id ordered_qty is_open
fct_purchase_orders references supplier_id dim_suppliers supplier_id
fct_purchase_orders references product_id dim_products product_id
fct_purchase_orders references store_id dim_stores store_id
fct_purchase_orders range ordered_qty 1
fct_purchase_orders delivery_fields_agree
fct_purchase_orders is_late_matches_dates
"""

# Rows that break a business rule.
BROKEN = {
    "revenue_reconciles":
        "abs(amount_eur - (quantity * unit_price_eur * (1 - discount_pct))) > 0.01::double",
    "delivery_fields_agree":
        "(actual_delivery_date is not null and received_qty is null) "
        "or (actual_delivery_date is null and received_qty is not null)",
    "is_late_matches_dates":
        "actual_delivery_date is not null and is_late <> (actual_delivery_date > promised_date)",
}


def _checks_of(table: str, kind: str, rest: list[str], categories):
    """(name, column, failing rows or groups) of one line of ``CHECKS``."""
    column, *more = rest or [""]
    if kind == "not_null":
        for name in rest:
            yield kind, name, f"select 1 from {table} where {name} is null"
    elif kind == "range":
        bounds = " or ".join(f"{column} {op} {x}" for op, x in zip("<>", more))
        yield "accepted_range", column, f"select 1 from {table} where {bounds}"
    elif kind == "expression":
        text = " ".join(rest)
        yield "expression_is_true", text, f"select 1 from {table} where not ({text})"
    elif kind == "unique":
        yield kind, column, (f"select {column} from {table} where {column} is not null "
                             f"group by 1 having count(*) > 1")
    elif kind == "combination":
        yield "unique_combination", ", ".join(rest), (
            f"select 1 from {table} group by {', '.join(rest)} having count(*) > 1")
    elif kind == "accepted":
        values = categories if more == ["CATEGORIES"] else more
        listed = ", ".join(f"'{v}'" for v in values)
        yield "accepted_values", column, (
            f"select distinct {column} from {table} where {column} not in ({listed})")
    elif kind == "references":
        parent, field = more
        yield "relationships", column, (
            f"select 1 from {table} x where {column} is not null and not exists "
            f"(select 1 from {parent} y where y.{field} = x.{column})")
    else:
        yield kind, "", f"select 1 from {table} where {BROKEN[kind]}"


def contract_sql(categories=PART_CATEGORIES) -> str:
    """One row per check, counted by SQL."""
    rows = [
        f"select '{name}' as check_name, '{table}' as table_name, '{column}' as column_name, "
        f"(select count(*) from ({failing})) as failures"
        for table, kind, *rest in map(str.split, CHECKS.strip().splitlines())
        for name, column, failing in _checks_of(table, kind, rest, categories)
    ]
    body = "\nunion all ".join(rows)
    return f"select *, failures = 0 as passed from ({body})"


_SALES_COLUMNS = """sale_id, sale_date, store_id, product_id, quantity, unit_price_eur,
    discount_pct, amount_eur"""

_FINGERPRINT = f"""
    select * from (values
      ('fct_sales.n_rows', (select count(*)::double from SALES)),
      ('fct_sales.revenue', (select round(sum(amount_eur)) from SALES)),
      ('fct_inventory.n_rows', (select count(*)::double from fct_inventory)),
      ('fct_inventory.stockouts',
         (select count(*)::double from fct_inventory where is_stockout)),
      ('fct_purchase_orders.n_rows', (select count(*)::double from fct_purchase_orders)),
      ('fct_purchase_orders.late',
         (select count(*)::double from fct_purchase_orders where is_late)),
      ('fct_purchase_orders.open',
         (select count(*)::double from fct_purchase_orders where is_open)),
      ('dim_suppliers.n_rows', (select count(*)::double from dim_suppliers)),
      ('dim_products.n_rows', (select count(*)::double from dim_products)),
      ('dim_stores.n_rows', (select count(*)::double from dim_stores)),
      ('dim_date.n_rows', (select count(*)::double from dim_date))
    ) t(metric, value)"""

_RISKY = "days_of_cover < THRESHOLD and in_transit_qty = 0"

_AT_RISK = f"""
    select store_name, product_name, category, on_hand_qty,
           {_round('avg_daily_units', 2)} as daily_demand, days_of_cover, supplier_name,
           reliability_tier
    from (select * from latest where {_RISKY} STORES)
    join dim_products using (product_id)
    join dim_suppliers using (supplier_id)
    join (select store_id, store_name from dim_stores) using (store_id)
    order by days_of_cover, store_id, product_id limit 40"""

_KPIS = f"""
    select count(*) filter (where is_stockout) as stockouts,
           count(*) filter (where {_RISKY}) as at_risk,
           (select count(*) filter (where is_open) from fct_purchase_orders) as open_orders,
           (select round(sum(amount_eur)) from fct_sales where true STORES) as revenue
    from latest where true STORES"""

_TWO_STORES = "and store_id in ('STO-003', 'STO-007')"

_MASKED = """
    select supplier_id, {name} as supplier_name, country, city, nominal_lead_time_days,
           {score} as reliability_score, reliability_tier, valid_from
    from dim_suppliers"""

_HISTORY = """supplier_id, supplier_name, country, city, nominal_lead_time_days,
    reliability_score, valid_from, valid_from_day, valid_to_day"""

# Malformed sale rows appended by hand.
_BAD_ROWS = """
    (values ('SAL-BAD-001','2026-07-18','STO-001','SKU-00001','0','10.00','0.0','0.00'),
            ('SAL-BAD-002','2026-07-18','STO-001','SKU-00002','-3','10.00','0.0','30.00'),
            ('SAL-BAD-003','2026-07-18','STO-002','SKU-00003','2','10.00','0.0','abc'),
            ('SAL-BAD-004','2026-07-18','STO-002','SKU-00004','2','10.00','1.5','20.00'),
            ('SAL-BAD-005','','STO-003','SKU-00005','2','10.00','0.0','20.00'))
    """

SELECTS = {
    "raw_sales_landing": "select * from raw_sales",
    "raw_inventory_landing": "select * from raw_inventory_snapshots",
    "raw_purchase_orders_landing": "select * from raw_purchase_orders",
    "changed_files": """
        select count(distinct order_date) filter (where actual_delivery_date = '')
                 as uploaded_days,
               count(distinct order_date) filter (where actual_delivery_date <> '')
                 as skipped_days
        from raw_purchase_orders""",
    "stg_suppliers": "select * from stg_suppliers",
    "stg_products": "select * from stg_products",
    "stg_stores": "select * from stg_stores",
    "stg_sales_typed": "select * from typed_sales",
    "stg_sales": "select * from stg_sales",
    "stg_inventory_snapshots": "select * from stg_inventory_snapshots",
    "stg_purchase_orders": "select * from stg_purchase_orders",
    "quarantine_sales": "select * from quarantine",
    "quarantine_by_reason":
        "select quarantine_reason, count(*) as n from quarantine group by quarantine_reason",
    "quarantine_count": "select count(*) as n from quarantine",
    "daily_demand": "select * from demand",
    "stock_status": "select * from fct_inventory",
    "fct_inventory": "select * from fct_inventory",
    "po_delays": "select * from fct_purchase_orders",
    "fct_purchase_orders": "select * from fct_purchase_orders",
    "dim_suppliers": "select * from dim_suppliers",
    "dim_products": "select * from dim_products",
    "dim_stores": "select * from dim_stores",
    "dim_date": "select * from dim_date",
    "dim_suppliers_masked_analyst": _MASKED.format(
        name="'*** RESTRICTED ***'", score="cast(null as double)"),
    "dim_suppliers_masked_transformer": _MASKED.format(
        name="supplier_name", score="reliability_score"),
    "fct_sales": "select * from fct_sales",
    "fct_sales_incremental": "select * from merged_sales",
    "fct_sales_table_load": "select * from merged_sales",
    "fct_sales_partial_day": """
        select p.* from partial_sales p
        where not exists (select 1 from partial_batch b where b.sale_id = p.sale_id)
        union all select * from partial_batch""",
    "suppliers_scd2": f"select {_HISTORY} from suppliers_history",
    "suppliers_as_of": f"""select {_HISTORY} from suppliers_history
        where valid_from_day <= date '2026-07-18'
          and (valid_to_day is null or date '2026-07-18' < valid_to_day)""",
    "orders_with_supplier_terms": """
        select o.po_id, o.order_date, o.supplier_id, h.nominal_lead_time_days,
               h.reliability_score
        from (select po_id, supplier_id,
                     cast(order_date + cast(date '2026-07-19'
                       - (select max(order_date) from stg_purchase_orders) as integer) as date)
                       as order_date
              from stg_purchase_orders) o
        left join suppliers_history h on o.supplier_id = h.supplier_id
          and h.valid_from_day <= o.order_date
          and (h.valid_to_day is null or o.order_date < h.valid_to_day)""",
    "kpis": _KPIS.replace("THRESHOLD", "7").replace("STORES", ""),
    "kpis_two_stores": _KPIS.replace("THRESHOLD", "21").replace("STORES", _TWO_STORES),
    "at_risk": _AT_RISK.replace("THRESHOLD", "7").replace("STORES", ""),
    "at_risk_two_stores": _AT_RISK.replace("THRESHOLD", "21").replace(
        "STORES", _TWO_STORES),
    "supplier_lateness": f"""
        select supplier_name, count(*) as orders,
               {_round('100.0::double * (count(*) filter (where is_late) / count(*))', 1)}
                 as late_pct,
               {_round('avg(delay_days) filter (where is_late)', 1)} as avg_days_late
        from fct_purchase_orders join dim_suppliers using (supplier_id)
        where not is_open group by supplier_name having count(*) > 20
        order by late_pct desc nulls last, supplier_name limit 10""",
    "stockout_rate_by_tier": f"""
        select reliability_tier,
               {_round('100.0::double * count(*) filter (where is_stockout) / count(*)', 2)}
                 as stockout_rate_pct
        from fct_inventory join dim_products using (product_id)
        join dim_suppliers using (supplier_id) group by reliability_tier""",
    "revenue_by_day": f"""
        select sale_date, {_round('sum(amount_eur)', 2)} as revenue_eur
        from fct_sales group by sale_date""",
    "revenue_by_day_two_stores": f"""
        select sale_date, {_round('sum(amount_eur)', 2)} as revenue_eur
        from fct_sales where true {_TWO_STORES} group by sale_date""",
    "store_list": "select store_id, store_name from dim_stores",
    "data_as_of": "select max(snapshot_date) as as_of from fct_inventory",
    "dq_unique": """
        select sale_line, count(*) as n_records
        from (select regexp_extract(sale_id, '^SAL-[0-9]+-[0-9]+') as sale_line from typed_sales)
        group by sale_line having count(*) > 1""",
    "dq_not_null": "select * from typed_sales where quantity is null",
    "dq_accepted_values": """
        select category, count(*) as n_records from stg_products
        where category not in ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD')
        group by category""",
    "dq_relationships": """
        select sale_date, count(*) as n_records from fct_sales
        where sale_date is not null
          and not exists (select 1 from dim_date where date_day = sale_date)
        group by sale_date""",
    "dq_range": "select * from typed_sales where not (discount_pct >= 0 and discount_pct <= 1)",
    "dq_unique_combo": """
        select sale_date, store_id, product_id, count(*) as n_records from typed_sales
        group by sale_date, store_id, product_id having count(*) > 1""",
    "dq_expression": "select * from typed_sales where not (amount_eur >= unit_price_eur)",
    "dq_delivery_agree": """
        select po_id from (
          select po_id, actual_delivery_date,
                 case when received_qty < ordered_qty then null else received_qty end
                   as received_qty
          from fct_purchase_orders)
        where (actual_delivery_date is null) <> (received_qty is null)""",
    "dq_late_agree": """
        select po_id from (
          select po_id, actual_delivery_date, promised_date, delay_days > 1 as is_late
          from fct_purchase_orders)
        where is_late <> (actual_delivery_date > promised_date)""",
    "dq_revenue_reconciles": """
        select sale_id from merged_sales
        where abs(amount_eur - quantity * unit_price_eur * (1 - discount_pct)) > 0.01::double""",
    "dq_contract": contract_sql(),
    "dq_summary": f"""
        select check_name, count(*) as checks,
               cast(count(*) filter (where passed) as bigint) as passed,
               cast(count(*) filter (where not passed) as bigint) as failed,
               cast(sum(failures) as bigint) as failures
        from ({contract_sql()}) group by check_name""",
    "run_history": """
        select 'not_null' as check_name, 'sales' as table_name, c as column_name,
               cast(b as bigint) as failures_before, cast(a as bigint) as failures_after
        from (
          select unnest(['sale_date', 'store_id', 'product_id', 'quantity', 'amount_eur',
                         'discount_pct']) as c,
                 unnest([count(*) filter (where sale_date is null),
                         count(*) filter (where store_id is null),
                         count(*) filter (where product_id is null),
                         count(*) filter (where quantity is null),
                         count(*) filter (where amount_eur is null),
                         count(*) filter (where discount_pct is null)]) as b, 0 as a
          from typed_sales)
        where a <> b""",
    "build_fingerprint": _FINGERPRINT.replace("SALES", "fct_sales"),
    "pipeline_build": _FINGERPRINT.replace("SALES", "fct_sales"),
    "appended_bad_rows": f"""
        select sale_id, {_REASON} as quarantine_reason
        from (select sale_id, {_cast('sale_date', 'date')}, store_id, product_id,
                     {_cast('quantity', 'integer')}, {_cast('unit_price_eur', 'double')},
                     {_cast('discount_pct', 'double')}, {_cast('amount_eur', 'double')}
              from (select * from raw_sales union all
                    select * from {_BAD_ROWS} b({_SALES_COLUMNS})))
        where not ({_VALID})""",
    "keyed_update": """
        select supplier_id, supplier_name, country, city,
               case when supplier_id = 'SUP-0002' then 5 else nominal_lead_time_days end
                 as nominal_lead_time_days,
               case when supplier_id = 'SUP-0002' then 0.9::double else reliability_score end
                 as reliability_score,
               case when supplier_id = 'SUP-0002' then date '2026-07-19' else valid_from end
                 as valid_from
        from stg_suppliers""",
    "stored_raw_append": f"""
        select sale_id, {_REASON} as quarantine_reason
        from (select sale_id, {_cast('sale_date', 'date')}, store_id, product_id,
                     {_cast('quantity', 'integer')}, {_cast('unit_price_eur', 'double')},
                     {_cast('discount_pct', 'double')}, {_cast('amount_eur', 'double')}
              from (select * from raw_sales union all
                    select * from {_BAD_ROWS} b({_SALES_COLUMNS})))
        where not ({_VALID})""",
    "stored_raw_update": """
        select supplier_id, supplier_name, country, city,
               case when supplier_id = 'SUP-0002' then 5 else nominal_lead_time_days end
                 as nominal_lead_time_days,
               case when supplier_id = 'SUP-0002' then 0.9::double else reliability_score end
                 as reliability_score,
               case when supplier_id = 'SUP-0002' then date '2026-07-19' else valid_from end
                 as valid_from
        from stg_suppliers""",
    "raw_row_counts": " union all ".join(
        f"select '{t}' as table_name, count(*) as n_rows from raw_{t}" for t in (
            "suppliers", "products", "stores", "sales", "inventory_snapshots", "purchase_orders")),
    "raw_lineage": """
        select case when sale_date = '' then '__HIVE_DEFAULT_PARTITION__'
                    else substr(sale_date, 1, 7) end as folder,
               count(*) as n_rows, count(*) as n_stamped
        from raw_sales group by 1""",
    "dimension_typed_read": "select * from stg_suppliers",
    "zone_to_marts": _FINGERPRINT.replace("SALES", "fct_sales"),
    "zone_second_build": """
        select * from (values
          ('fct_sales.n_rows', (select count(*)::double from merged_again)),
          ('fct_sales.revenue', (select round(sum(amount_eur)) from merged_again)),
          ('demand.units', (select sum(quantity)::double from valid_again
             where sale_date > (select max(sale_date) - 28 from valid_again))),
          ('quarantine.n_rows', (select count(*)::double from typed_again)
             - (select count(*)::double from valid_again)),
          ('suppliers.n_versions', (select count(*) + count(*) filter (
             where supplier_id = 'SUP-0002' and (nominal_lead_time_days <> 5
               or reliability_score <> 0.9::double)) from stg_suppliers)::double),
          ('suppliers.n_open', (select count(*)::double from stg_suppliers)),
          ('landed.sales_folders', 1::double),
          ('landed.order_folders', 0::double),
          ('landed.supplier_rows', (select count(*)::double from stg_suppliers)),
          ('landed.product_rows', 0::double)
        ) t(metric, value)""",
    "sql_serving": """
        select store_name, count(*) as n_sales, cast(sum(quantity) as bigint) as units
        from fct_sales join dim_stores using (store_id) group by store_name""",
    "measured_run": """
        select 'night' as run_id, layer, table_name, n_rows, true as timed from (
          select 'staging' as layer, 'typed_sales' as table_name, count(*) as n_rows from typed_sales
          union all select 'marts', 'fct_sales', count(*) from fct_sales
          union all select 'staging', 'stg_suppliers', count(*) from stg_suppliers
          union all select 'staging', 'stg_products', count(*) from stg_products
          union all select 'staging', 'stg_stores', count(*) from stg_stores
          union all select 'staging', 'stg_inventory_snapshots', count(*) from stg_inventory_snapshots
          union all select 'staging', 'stg_purchase_orders', count(*) from stg_purchase_orders
          union all select 'quarantine', 'quarantine_sales', count(*) from quarantine
          union all select 'marts', 'dim_suppliers', count(*) from dim_suppliers
          union all select 'marts', 'dim_products', count(*) from dim_products
          union all select 'marts', 'dim_stores', count(*) from dim_stores
          union all select 'intermediate', 'daily_demand', count(*) from demand
          union all select 'marts', 'fct_inventory', count(*) from fct_inventory
          union all select 'marts', 'dim_date', count(*) from dim_date
          union all select 'marts', 'fct_purchase_orders', count(*) from fct_purchase_orders
          union all select 'snapshots', 'suppliers_snapshot', count(*) from stg_suppliers)""",
    "stored_contract": contract_sql(),
    "compare_builds": """
        select sale_id, sale_date, quantity, amount_eur, cast(1 as bigint) as n_left,
               cast(0 as bigint) as n_right
        from last_day where quantity % 5 = 0 or quantity % 2 = 0
        union all
        select sale_id, sale_date, quantity, amount_eur + 1, cast(0 as bigint), cast(1 as bigint)
        from last_day where quantity % 5 <> 0 and quantity % 2 = 0""",
    "schema_diff": """
        select * from (values
          ('dim_suppliers', 'city', 'string', null, 'removed'),
          ('dim_suppliers', 'nominal_lead_time_days', 'int', 'double', 'type_changed'),
          ('dim_stores', 'opened_on', null, 'date', 'added')
        ) t(table_name, column_name, old_type, new_type, change)""",
    "line_amounts": f"""
        select sale_id, {_round('quantity * unit_price_eur * (1.0::double - discount_pct)', 2)}
                 as computed_eur
        from stg_sales""",
    "supplier_history_table": f"""
        select supplier_id, supplier_name, country, city, nominal_lead_time_days,
               reliability_score, valid_from,
               md5(supplier_id || '|' || cast(valid_from_day as varchar) || ' 00:00:00') as dbt_scd_id,
               cast(valid_from_day as varchar) || ' 00:00:00' as dbt_updated_at,
               cast(valid_from_day as varchar) || ' 00:00:00' as dbt_valid_from,
               cast(valid_to_day as varchar) || ' 00:00:00' as dbt_valid_to
        from suppliers_history""",
    "usage_top5_of_a_warehouse": f"""
        select resource, count(*) as n, {_round('sum(amount) / 1000.0::double', 1)} as seconds
        from usage_log where warehouse = 'WH-1'
        group by resource order by seconds desc nulls last, resource limit 5""",
    "union_by_name_load": f"""
        select {", ".join(f"nullif({c}, '') as {c}" for c in (
            "po_id", "order_date", "supplier_id", "product_id", "store_id", "ordered_qty",
            "promised_date", "actual_delivery_date", "received_qty"))}
        from raw_purchase_orders""",
    "positional_load": f"""
        select {", ".join(f"nullif({c}, '') as {c}" for c in (
            "po_id", "order_date", "supplier_id", "product_id", "store_id", "ordered_qty",
            "promised_date", "actual_delivery_date", "received_qty"))}
        from raw_purchase_orders""",
    "partitioned_sink": """
        select count(*) as n_rows, count(distinct snapshot_date) as partitions
        from raw_inventory_snapshots""",
    "stream_load": "select * from fct_sales",
    "usage_by_group": f"""
        select resource, {_round('credits', 4)} as credits,
               {_round('credits * 2.75::double', 2)} as cost_eur, metering_periods, is_total
        from (select resource, sum(amount) as credits, count(*) as metering_periods,
                     0 as is_total from usage_log group by resource
              union all select 'TOTAL', sum(amount), count(*), 1 from usage_log)""",
    "usage_total": f"""
        select {_round('c', 4)} as credits, {_round('c * 2.75::double', 2)} as cost_eur
        from (select coalesce(sum(amount), 0) as c from usage_log where resource = 'purchase')""",
    "usage_7day_avg": f"""
        select {_round('avg(amount * 1000000000.0::double) / power(1024.0::double, 3)', 4)}
                 as table_gib,
               {_round('avg(amount * 100000000.0::double) / power(1024.0::double, 3)', 4)}
                 as stage_gib
        from usage_log
        where usage_date >= (select max(usage_date) from usage_log) - 7""",
    "usage_top2_of_two": f"""
        select resource, count(*) as n, {_round('sum(amount) / 1000.0::double', 1)} as seconds
        from usage_log where resource in ('purchase', 'view')
        group by resource order by seconds desc nulls last, resource limit 5""",
    "usage_top5": f"""
        select resource, count(*) as n, {_round('sum(amount) / 1000.0::double', 1)} as seconds
        from usage_log group by resource order by seconds desc nulls last, resource limit 5""",
    "weekday_profile": f"""
        select cast(extract(isodow from sale_date) as integer) as iso_day_of_week,
               count(*) as days, cast(sum(units) as bigint) as units,
               {_round('sum(units)::double / count(*) / (select sum(quantity)::double / count(distinct sale_date) from stg_sales)', 4)}
                 as demand_factor
        from (select sale_date, sum(quantity) as units from stg_sales group by sale_date)
        group by 1""",
    "reorder_policy": "select * from policy",
    "replenishment_orders": """
        select l.store_id, l.product_id, p.supplier_id, l.on_hand_qty, p.policy_reorder_point,
               p.order_up_to, p.order_up_to - l.on_hand_qty as order_qty
        from latest l join policy p on l.store_id = p.store_id and l.product_id = p.product_id
        where l.in_transit_qty = 0 and l.on_hand_qty <= p.policy_reorder_point""",
    "stock_ledger": """
        select snapshot_date, store_id, product_id, on_hand_qty,
               cast(before + receipts - sold as bigint) as expected_qty,
               cast(on_hand_qty - (before + receipts - sold) as bigint) as unexplained_qty
        from (
          select i.*, coalesce(r.q, 0) as receipts, coalesce(s.q, 0) as sold,
                 lag(on_hand_qty) over (partition by i.store_id, i.product_id
                                        order by snapshot_date) as before
          from stg_inventory_snapshots i
          left join (select store_id, product_id, actual_delivery_date as d,
                            sum(received_qty) as q from stg_purchase_orders
                     where actual_delivery_date is not null group by all) r
            on i.store_id = r.store_id and i.product_id = r.product_id and i.snapshot_date = r.d
          left join (select store_id, product_id, sale_date as d, sum(quantity) as q
                     from stg_sales group by all) s
            on i.store_id = s.store_id and i.product_id = s.product_id and i.snapshot_date = s.d)
        where before is not null""",
    "fill_rate": f"""
        select supplier_id, count(*) as delivered_orders,
               cast(count(*) filter (where received_qty < ordered_qty) as bigint)
                 as short_orders,
               cast(sum(ordered_qty) as bigint) as ordered_units,
               cast(sum(received_qty) as bigint) as received_units,
               {_round('sum(received_qty)::double / sum(ordered_qty)', 4)} as fill_rate
        from stg_purchase_orders where received_qty is not null group by supplier_id""",
    "in_transit": """
        select i.snapshot_date, i.store_id, i.product_id,
               cast(coalesce(sum(coalesce(o.received_qty, o.ordered_qty)), 0) as bigint)
                 as derived_in_transit_qty
        from stg_inventory_snapshots i left join stg_purchase_orders o
          on i.store_id = o.store_id and i.product_id = o.product_id
          and o.order_date < i.snapshot_date
          and (o.actual_delivery_date is null or o.actual_delivery_date > i.snapshot_date)
        group by all""",
}

ORACLES = {name: over(select) for name, select in SELECTS.items()}
