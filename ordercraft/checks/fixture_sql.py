"""The test binding of FIXTURES.md section 2 as SQL text, for the DuckDB oracle.

Each statement may read the driver tables and the statements before it, so
``binding_ctes()`` inlines them, in order, as a WITH list. The Spark side builds the
same tables with the DataFrame API (``ordercraft.sources.binding``); the oracle check
therefore also cross-checks the binding itself.
"""

from __future__ import annotations

BINDING: list[tuple[str, str]] = [
    ("fx_line", """select l_orderkey, l_partkey, cast(l_quantity as int) as qty, case when l_orderkey % 7 = 0 then min(l_partkey) over (partition by l_orderkey) - min(l_partkey) over (partition by l_orderkey) % 4 + l_partkey % 4 else l_partkey end as sk, row_number() over (partition by l_orderkey order by l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax) as ln from lineitem"""),
    ("dcspp_order", """select 'O' || o_orderkey as order_id, 'U' || o_custkey as profile_id, case o_orderstatus when 'O' then 'SUBMITTED' when 'F' then 'NO_PENDING_ACTION' else 'INCOMPLETE' end as state, case when o_orderkey % 97 = 0 then null else o_orderdate + (o_orderkey % 24) * interval '1' hour end as submitted_date, o_orderdate as creation_date, o_orderdate + interval '1' day as last_modified_date, 'OP' || o_orderkey as price_info from orders"""),
    ("oe_order", """select 'O' || o_orderkey as order_id, 'B' || o_orderkey as order_number from orders"""),
    ("nt_order", """select 'O' || o_orderkey as order_id, case when o_orderkey % 53 = 0 then null else 'CN' || ((o_custkey + o_orderkey % 3) % 50) end as cn_id, case when o_orderkey % 5 = 0 then 'CP' || (o_orderkey % 20) end as coupon_id from orders where o_orderkey % 59 <> 0"""),
    ("dcspp_order_item", """select 'O' || l_orderkey as order_id, 'I' || l_orderkey || '-' || ln as commerce_items from fx_line"""),
    ("dcspp_order_item_stg", """select 'O' || o_orderkey as order_id from orders where o_orderkey % 2 = 0"""),
    ("dcspp_item", """select 'I' || l_orderkey || '-' || ln as commerce_item_id, case when (l_orderkey + ln) % 61 <> 0 then 'S' || sk end as catalog_ref_id, 'P' || sk as product_id, qty % 5 + 1 as quantity, 'IP' || l_orderkey || '-' || ln as price_info from fx_line"""),
    ("dcspp_order_price", """select 'OP' || o_orderkey as amount_info_id, case when o_orderkey % 43 = 0 then cast(-5 - o_orderkey % 10 as decimal(19,2)) else cast(100 + o_orderkey % 900 as decimal(19,2)) end as raw_subtotal, cast((o_orderkey % 10) * 2 as decimal(19,2)) as shipping from orders where o_orderkey % 31 <> 0"""),
    ("dcspp_item_price", """select 'IP' || l_orderkey || '-' || ln as amount_info_id, cast(10 + l_partkey % 50 as decimal(19,2)) as list_price, cast((10 + l_partkey % 50) * (qty % 5 + 1) as decimal(19,2)) as raw_total_price, cast(ln % 4 as decimal(19,2)) as order_discount from fx_line where (l_orderkey + ln) % 19 <> 0"""),
    ("dcspp_amtinfo_adj", """select 'IP' || l_orderkey || '-' || ln as amount_info_id, 'IA' || l_orderkey || '-' || ln || '-' || j as adjustments from fx_line cross join (values (0), (1)) as v(j) where ln % 3 = 1 or (ln % 3 = 0 and j = 0) union all select 'OP' || o_orderkey, 'OA' || o_orderkey || '-' || j from orders cross join (values (0), (1), (2)) as v(j) where o_orderkey % 4 <> 0"""),
    ("dcspp_price_adjust", """select 'IA' || l_orderkey || '-' || ln || '-' || j as adjustment_id, case when ln % 6 = 0 then cast((10 + l_partkey % 50) * (qty % 5 + 1) as decimal(19,2)) else cast(-(1 + ln + j) as decimal(19,2)) end as adjustment, 'PM' || (l_partkey % 9) as pricing_model from fx_line cross join (values (0), (1)) as v(j) union all select 'OA' || o_orderkey || '-' || j, case when j = 0 then cast(-5 - o_orderkey % 10 as decimal(19,2)) when j = 1 then cast(3 as decimal(19,2)) when o_orderkey % 2 = 0 then cast(-1 as decimal(19,2)) end, 'PMO' from orders cross join (values (0), (1), (2)) as v(j) where o_orderkey % 4 <> 0"""),
    ("nt_product", """select 'P' || p_partkey as product_id, 'C' || p_partkey as product_code from part where p_partkey % 23 <> 0"""),
    ("dcs_product", """select 'P' || p_partkey as product_id, p_name as display_name from part"""),
    ("nt_sku", """select 'S' || p_partkey as sku_code, 'K' || p_partkey as sku_id from part where p_partkey % 29 <> 0"""),
    ("dcs_sku", """select 'K' || p_partkey as sku_id, p_name || ' ' || p_partkey as display_name from part"""),
    ("dcspp_pay_group", """select 'O' || o_orderkey as order_ref, 'PG' || o_orderkey as payment_group_id, case when o_orderpriority = '5-LOW' then 'AUTHORIZED' else 'SETTLED' end as state, case when o_orderkey % 3 = 0 then 'boleto' else 'card' end as payment_method from orders union all select 'O' || o_orderkey, 'PGX' || o_orderkey, 'SETTLED', 'voucher' from orders where o_orderkey % 41 = 0"""),
    ("oe_pay_group", """select 'PG' || o_orderkey as payment_group_id, cast(1 + (o_orderkey + j) % 6 as int) as no_of_payments from orders cross join (values (0), (1)) as v(j) where o_orderkey % 9 <> 0 and (j = 0 or o_orderkey % 2 = 0)"""),
    ("dps_user", """select 'U' || c_custkey as id, case when c_custkey % 17 <> 0 then 'F' || c_custkey end as first_name, case when c_custkey % 13 <> 0 then 'L' || c_custkey end as last_name, 'u' || c_custkey || '@example.test' as email, timestamp '1970-01-01 00:00:00' + (c_custkey % 9000) * interval '1' day as date_of_birth from customer"""),
    ("dcspp_ship_group", """select 'O' || o_orderkey as order_ref, 'SG' || o_orderkey as shipping_group_id from orders union all select 'O' || o_orderkey, 'SGX' || o_orderkey from orders where o_orderkey % 47 = 0"""),
    ("nt_ship_group", """select 'SG' || o_orderkey as shipping_group_id, o_orderdate + interval '7' day as sched_deliv_date from orders where o_orderkey % 3 <> 0"""),
    ("cit_product_refil", """select 'S' || p_partkey as sku_order, 'S' || p_partkey as sku_rebuy, cast(30 + p_partkey % 90 as int) as expiration, case when p_size % 2 = 0 then 'Y' else 'N' end as refillable from part where p_partkey % 4 in (0, 2) union all select 'S' || p_partkey, 'S' || (p_partkey - p_partkey % 4), cast(45 + p_partkey % 60 as int), 'Y' from part where p_partkey % 4 in (1, 2)"""),
    ("oe_product", """select 'P' || p_partkey as product_id, p_brand as brand_id from part"""),
    ("oe_brand", """select distinct p_brand as brand_id, case when p_brand <> 'Brand#7' then 'Name ' || p_brand end as name from part where p_brand <> 'Brand#13'"""),
    ("fx_brand", """select distinct p_brand as b, cast(replace(p_brand, 'Brand#', '') as int) as n from part"""),
    ("cit_offer", """select x.b as brand_order, y.b as brand_offer, case when (x.n + y.n) % 11 = 0 then null else (x.n * y.n) % 4 end as interest, (x.n + 2 * y.n) % 3 as support from fx_brand as x join fx_brand as y on x.n % 5 = y.n % 5 where x.n <> y.n"""),
    ("cit_refil", """select f.l_orderkey + 1 as id_key, 'seed' as description, 'S' || f.sk as sku, 'N' as refillable, o.o_orderdate + interval '40' day as expiration, 'U' || o.o_custkey as cf_id, n.cn_id, n.order_id from fx_line as f join orders as o on o.o_orderkey = f.l_orderkey join nt_order as n on n.order_id = 'O' || o.o_orderkey where f.l_orderkey % 11 = 0 and f.ln <= 2"""),
    ("cit_opportunities", """select 'CN' || (c_custkey % 50) as cn_id, 'U' || c_custkey as cf_id, 'OLD' as offer, cast(null as bigint) as refil, timestamp '2001-03-01 00:00:00' as order_date from customer where c_custkey % 5 = 0 union all select 'CNX', 'U' || c_custkey, 'OLD2', cast(7 as bigint), timestamp '2000-10-01 00:00:00' from customer where c_custkey % 35 = 0"""),
]


def binding_ctes() -> str:
    """``name AS (sql), ...`` for use after WITH."""
    return ",\n".join(f"{name} AS ({sql})" for name, sql in BINDING)


def with_binding(body_ctes: str, select: str) -> str:
    """A full DuckDB statement: the binding, then extra CTEs (may be empty), then the query."""
    extra = f",\n{body_ctes}" if body_ctes.strip() else ""
    return f"WITH {binding_ctes()}{extra}\n{select}"
