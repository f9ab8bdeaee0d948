"""The registered queries as SQL over the given tables.

Ratios are written in whole units of the last digit, so that rounding is exact half away from zero
and does not depend on how an engine divides decimals.
"""

from __future__ import annotations


def ratio(num: str, den: str, times: int = 1) -> str:
    n, d = f"cast({num} as hugeint)", f"cast({den} as hugeint)"
    scaled = f"((2 * abs({n}) * {times * 100} + abs({d})) // (2 * abs({d})))"
    sign = f"(case when ({n} < 0) = ({d} < 0) then 1 else -1 end)"
    return f"(case when {den} = 0 then null else cast({sign} * {scaled} as double) / 100 end)"


def pct(num: str, den: str) -> str:
    return ratio(num, den, 100)


# --- mapping of the tables --------------------------------------------------------------------

LINES = """lines as (
    select *, cast(l_quantity as int) as quantity,
           cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as int) as price,
           cast(round(l_discount * 100) as int) as off
    from lineitem)"""
SKUS = f"""{LINES}, versions as (
    select l_partkey as item_id, l_orderkey * 10 + l_linenumber as sku_id,
           'S' || l_suppkey as seller_sku,
           l_partkey || '-' || (l_orderkey * 10 + l_linenumber) as shop_sku,
           l_linestatus as status, quantity, quantity as available, price,
           case when off > 0 then price * (100 - off) // 100 else 0 end as special_price,
           cast(cast(l_shipdate as date) as varchar) as created_date,
           l_shipdate, l_extendedprice, l_returnflag
    from lines), skus as (
    select item_id, sku_id, seller_sku, shop_sku, status, quantity, available, price, special_price,
           created_date from versions)"""
PRODUCTS = """products as (
    select p_partkey as item_id, p_name as name, created_time, updated_time,
           p_size as primary_category, p_type as status,
           cast(cast(created_time as date) as varchar) as created_date
    from part left join (select l_partkey, min(l_shipdate) as created_time, max(l_shipdate) as updated_time
                         from lineitem group by 1) on p_partkey = l_partkey)"""
IMAGES = "images as (select page_id // 2 as item_id, url as image_url, '2024-01-31' as created_date from pages)"
ATTRIBUTES = "attributes as (select p_partkey as item_id, p_brand as brand, p_type as description from part)"
CATALOG = f"{SKUS}, {PRODUCTS}, {IMAGES}, {ATTRIBUTES}"
POINTS = """points as (
    select user_id as item_id, 'item ' || user_id as name, value as price,
           cast(json_extract_string(props, '$.k') as int) as quantity, ts as timestamp, event_id
    from events)"""

ORACLE: dict[str, str] = {}

# --- reports ----------------------------------------------------------------------------------

ORACLE["category_analytics"] = f"""
with {CATALOG}, s as (
    select primary_category, count(distinct p.item_id) as total_products,
           count(distinct sku_id) as total_skus, sum(price) as price_sum, count(price) as n,
           max(price) as hi, min(price) as lo, sum(quantity) as stock, count(quantity) as nq,
           sum(quantity * price) as value,
           count(case when quantity > 50 then 1 end) as high_stock,
           count(case when quantity <= 20 then 1 end) as low_stock,
           sum(case when special_price > 0 then 1 else 0 end) as sale
    from products p join skus s on p.item_id = s.item_id group by 1),
i as (
    select primary_category, count(image_url) as total_images, count(distinct i.item_id) as with_images
    from products p left join images i on p.item_id = i.item_id group by 1),
b as (
    select primary_category, count(distinct brand) as unique_brands,
           count(case when length(description) > 500 then 1 end) as detailed
    from products p left join attributes a on p.item_id = a.item_id group by 1),
top as (
    select primary_category, brand from (
        select primary_category, brand,
               row_number() over (partition by primary_category order by count(*) desc, brand) as rn
        from products p join attributes a on p.item_id = a.item_id
        where brand is not null group by 1, 2) where rn = 1)
select s.primary_category, total_products, total_skus,
       {ratio('price_sum', 'n')} as average_price,
       cast(hi as double) as highest_price, cast(lo as double) as lowest_price,
       cast(stock as bigint) as total_inventory, cast(value as double) as inventory_value,
       high_stock as high_stock_items, low_stock as low_stock_items,
       {ratio('stock', 'nq')} as average_stock_level, cast(sale as bigint) as items_on_sale,
       total_images, with_images as products_with_images,
       {ratio('total_images', 'with_images')} as avg_images_per_product,
       unique_brands, top.brand as most_common_brand, detailed as detailed_descriptions,
       {pct('sale', 'total_products')} as sale_items_percentage,
       {ratio('value', 'stock')} as average_item_value
from s join i using (primary_category) join b using (primary_category)
     left join top using (primary_category)
where total_products > 0 order by value desc nulls first"""


def _brand_products(actual: str) -> str:
    return f"""pm as (
    select brand, primary_category, count(distinct p.item_id) as total_products,
           sum(quantity * price) as total_revenue, sum(quantity * {actual}) as actual_revenue,
           sum(quantity) as units, sum(case when quantity <= 10 then 1 else 0 end) as low,
           count(distinct case when special_price > 0 then p.item_id end) as discounted
    from products p join skus s on p.item_id = s.item_id join attributes a on p.item_id = a.item_id
    group by 1, 2)"""


def _kpi(actual: str) -> str:
    def branch(category: str, name: str, value: str, percentage: str) -> str:
        return (f"select '{category}' as impact_category, '{name}' as metric_name, "
                f"cast({value} as double) as value, {percentage} as percentage from pm")

    return f"with {CATALOG}, {_brand_products(actual)} " + " union all ".join([
        branch("Revenue Impact", "Actual Revenue", "actual_revenue", pct("actual_revenue", "total_revenue")),
        branch("Revenue Impact", "Discount Loss", "(total_revenue - actual_revenue)",
               pct("(total_revenue - actual_revenue)", "total_revenue")),
        branch("Inventory Health", "Low Stock Products", "low", pct("low", "total_products")),
        branch("Pricing Strategy", "Discounted Products", "discounted", pct("discounted", "total_products")),
        branch("Sales Efficiency", "Sales per Product", "units", pct("units", "total_products")),
    ]) + " order by impact_category, percentage desc nulls first"


ORACLE["brand_kpi_impact"] = _kpi("coalesce(special_price, price)")
ORACLE["brand_kpi_impact_guarded"] = _kpi("coalesce(nullif(special_price, 0), price)")
ORACLE["brand_roi"] = f"""
with {CATALOG}, {_brand_products('coalesce(special_price, price)')}
select brand, primary_category, {pct('(actual_revenue - total_revenue)', 'total_revenue')} as roi_percentage,
       {ratio('units', 'total_products')} as units_per_product
from pm order by brand, primary_category"""

RANGES = f"""ranges as (
    select s.*, case when price <= 100000 then '0-100k' when price <= 200000 then '100k-200k'
                     when price <= 500000 then '200k-500k' when price <= 1000000 then '500k-1M'
                     else 'Over 1M' end as price_range,
           case when quantity <= 10 then '0-10' when quantity <= 25 then '11-25'
                when quantity <= 50 then '26-50' when quantity <= 100 then '51-100'
                else 'Over 100' end as stock_range,
           case when special_price > 0 then {pct('(price - special_price)', 'price')} else 0 end
               as discount_percentage,
           coalesce(special_price > 0, false) as is_discounted
    from skus s), sorted_ranges as (
    select *, case when discount_percentage = 0 then 'No Discount'
                   when discount_percentage <= 10 then '1-10%' when discount_percentage <= 25 then '11-25%'
                   when discount_percentage <= 50 then '26-50%' else 'Over 50%' end as discount_range
    from ranges)"""


def _distribution(metric: str, label: str, units: str) -> str:
    return (f"select '{metric}' as metric_type, {label} as range_bucket, count(*) as count, "
            f"{ratio('sum(price)', 'count(price)')} as avg_value, cast({units} as bigint) as total_quantity "
            "from r group by 1, 2")


ORACLE["distributions"] = f"""
with {SKUS}, {PRODUCTS}, {RANGES}, r as (
    select r.* from products p join sorted_ranges r on p.item_id = r.item_id)
""" + " union all ".join([
    _distribution("Price Distribution", "price_range", "sum(quantity)"),
    _distribution("Stock Distribution", "stock_range", "sum(quantity)"),
    _distribution("Discount Distribution", "discount_range", "0"),
]) + " order by metric_type, range_bucket"
ORACLE["sku_discounts"] = f"""
with {SKUS}, {RANGES} select item_id, sku_id, price_range, stock_range,
       cast(discount_percentage as double) as discount_percentage, discount_range, is_discounted
from sorted_ranges"""
ORACLE["bucket_prices"] = f"with {SKUS}, {RANGES} select price_range, count(*) as n from ranges group by 1"


def _daily(units_growth: str, shown: str = "true") -> str:
    """Daily figures of the products that `shown` selects; all of them by default."""
    return f"""
with {CATALOG}, d as (
    select date_trunc('day', created_time) as sale_date, brand, count(distinct p.item_id) as products_sold,
           sum(quantity) as units, sum(quantity * price) as gross,
           sum(case when special_price > 0 then quantity * (price - special_price) else 0 end) as off
    from products p join skus s on p.item_id = s.item_id join attributes a on p.item_id = a.item_id
    where {shown}
    group by 1, 2), l as (
    select *, lag(gross) over w as prev_gross, lag(units) over w as prev_units
    from d window w as (partition by brand order by sale_date))
select cast(sale_date as timestamp) as sale_date, brand, products_sold, cast(units as bigint) as units_sold,
       cast(gross as double) as gross_revenue, cast(gross - off as double) as net_revenue,
       cast(off as double) as total_discounts, {pct('off', 'gross')} as discount_pct,
       {ratio('units', 'products_sold')} as units_per_product,
       case when prev_gross is not null then {pct('(gross - prev_gross)', 'prev_gross')} else 0 end
           as revenue_growth_pct,
       case when prev_units is not null then {units_growth} else 0 end as sales_growth_pct,
       {ratio('(gross - off)', 'units')} as average_order_value
from l order by 1 desc, net_revenue desc"""


EXACT_UNITS = pct("(units - prev_units)", "prev_units")
# Quotient cut toward zero before it is scaled.
CUT_UNITS = ("cast(sign(units - prev_units) * (abs(units - prev_units) // nullif(prev_units, 0)) * 100 as double)")
ORACLE["daily_brand_revenue"] = _daily(
    EXACT_UNITS, "created_time >= timestamp '1995-03-31' - interval 30 day and created_time <= timestamp '1995-03-31'")
ORACLE["daily_brand_revenue_all"] = _daily(EXACT_UNITS, "created_time is not null")
ORACLE["daily_brand_revenue_integer_growth"] = _daily(CUT_UNITS, "created_time is not null")

HOURLY = """hourly as (
    select event_type as brand, date_trunc('hour', ts) as time_bucket, count(distinct user_id) as products_count,
           count(*) as total_units, sum(cents) as gross, sum(cents * (100 - off) // 100) as actual,
           count(case when off > 0 then 1 end) as on_sale
    from (select *, cast(round(value * 100) as bigint) as cents,
                 cast(json_extract_string(props, '$.k') as int) % 30 as off from events)
    group by 1, 2)"""


def _spine(start: str, end: str, step: str) -> str:
    return f"unnest(generate_series({start}, {end}, interval {step}))"


def _trend(start: str, end: str) -> str:
    return f"""
with {HOURLY}, full_hours as (
    select t.time_bucket, b.brand, coalesce(products_count, 0) as products, coalesce(total_units, 0) as units,
           coalesce(gross, 0) as gross, coalesce(actual, 0) as actual, coalesce(on_sale, 0) as on_sale,
           {ratio('gross', 'total_units')} as avg_price
    from (select {_spine(start, end, '1 hour')} as time_bucket) t
         cross join (select distinct brand from hourly) b
         left join hourly h on h.brand = b.brand and h.time_bucket = t.time_bucket), w as (
    select *, sum(gross) over day as gross_sum, sum(units) over day as unit_sum, count(*) over day as n,
           lag(actual) over (partition by brand order by time_bucket) as prev
    from full_hours window day as (partition by brand order by time_bucket rows between 23 preceding and current row))
select time_bucket, brand, products as new_products, cast(units as bigint) as units_sold,
       cast(gross as bigint) as gross_revenue, cast(actual as bigint) as net_revenue,
       {pct('(gross - actual)', 'gross')} as discount_rate_pct, on_sale as products_on_sale,
       avg_price as average_price, {ratio('gross_sum', 'n')} as revenue_24h_ma,
       {ratio('unit_sum', 'n')} as units_24h_ma, {pct('(actual - prev)', 'prev')} as revenue_growth_pct
from w order by time_bucket desc, brand"""


ORACLE["hourly_brand_trend"] = _trend("timestamp '2024-01-24'", "timestamp '2024-01-31'")
ORACLE["hourly_brand_trend_all"] = _trend(
    "(select max(time_bucket) - to_days(cast(date_sub('day', min(time_bucket), max(time_bucket)) + 1 as int)) from hourly)",
    "(select max(time_bucket) from hourly)")
ORACLE["moving_average_24"] = f"""
with {HOURLY} select brand, time_bucket, total_units, round(avg(total_units) over (
    partition by brand order by time_bucket rows between 23 preceding and current row), 6) as units_ma
from hourly"""
ORACLE["densify"] = f"""
with {HOURLY} select b.brand, t.time_bucket, coalesce(products_count, 0) as products_count
from (select unnest(generate_series(min(time_bucket), max(time_bucket), interval 1 hour)) as time_bucket from hourly) t
     cross join (select distinct brand from hourly) b
     left join hourly h on h.brand = b.brand and h.time_bucket = t.time_bucket"""

ORACLE["brand_scorecard"] = f"""
with {LINES}, base as (
    select cast(l_shipdate as date) as day, l_partkey as item, p_brand as brand, l_orderkey, l_linestatus,
           l_returnflag, p_size, quantity as q, price as p, case when off > 0 then price * (100 - off) // 100 else 0 end as s, off,
           min(cast(l_shipdate as date)) over (partition by l_partkey) as first_day,
           max(cast(l_shipdate as date)) over (partition by l_partkey) as last_day
    from lines join part on l_partkey = p_partkey), facts as (
    select day, brand, count(distinct item) as total_products,
           count(distinct case when l_linestatus = 'O' then item end) as active_listings,
           count(distinct case when day = first_day then item end) as new_listings,
           count(distinct case when day = last_day then item end) as removed_listings,
           sum(q) as units, count(distinct l_orderkey) as orders_count,
           sum(q) + sum(case when nth = 1 then p_size end) as stock,
           count(case when l_returnflag = 'R' then 1 end) as returned,
           count(distinct case when o_orderstatus = 'F' then l_orderkey end) as fulfilled,
           count(distinct case when o_orderstatus = 'P' then l_orderkey end) as cancelled,
           count(case when q <= 10 then 1 end) as low_stock_items, count(case when q = 1 then 1 end) as out_of_stock,
           count(case when q > 45 then 1 end) as excess_stock, sum(q * p) as gross,
           sum(case when s > 0 then q * (p - s) else 0 end) as discount, sum(p) as price_sum, count(*) as n,
           median(p) as median_price, min(p) as min_price, max(p) as max_price,
           count(distinct case when off > 0 then item end) as promo, sum(off) as off_sum
    from (select *, row_number() over (partition by day, item) as nth from base) left join orders
    on o_orderkey = l_orderkey group by 1, 2), views as (
    select cast(ts as date) + cast((select min(day) from base) - (select min(cast(ts as date)) from events) as integer) as day,
           p_brand as brand, count(case when event_type = 'view' then 1 end) as page_views,
           count(distinct case when event_type = 'view' then user_id end) as unique_visitors,
           count(case when event_type = 'purchase' then 1 end) as purchases
    from events join part on p_partkey = user_id where event_type in ('view', 'purchase') group by 1, 2), f as (
    select cast(t.day as date) as day, b.brand, coalesce(total_products, 0) as total_products,
           coalesce(active_listings, 0) as active_listings, coalesce(new_listings, 0) as new_listings,
           coalesce(removed_listings, 0) as removed_listings, coalesce(units, 0) as units, orders_count as oc, coalesce(stock, 0) as stock,
           returned, fulfilled, cancelled, case when fa.day is null then null else purchases end as purchases,
           case when fa.day is null then null else page_views end as pv,
           coalesce(orders_count, 0) as orders_count, coalesce(low_stock_items, 0) as low_stock_items,
           coalesce(out_of_stock, 0) as out_of_stock, coalesce(excess_stock, 0) as excess_stock,
           coalesce(gross, 0) as gross, coalesce(discount, 0) as discount, price_sum, n, median_price,
           min_price, max_price, coalesce(promo, 0) as promo, off_sum,
           case when fa.day is null then 0 else coalesce(page_views, 0) end as page_views,
           case when fa.day is null then 0 else coalesce(unique_visitors, 0) end as unique_visitors
    from (select unnest(generate_series(min(day), max(day), interval 1 day)) as day from base) t
         cross join (select distinct p_brand as brand from part) b
         left join facts fa on fa.day = cast(t.day as date) and fa.brand = b.brand
         left join views v on v.day = cast(t.day as date) and v.brand = b.brand)
select cast(day as varchar) as date, brand, total_products, active_listings, new_listings, removed_listings,
       {pct('active_listings', 'total_products')} as active_products_pct, cast(stock as bigint) as total_stock,
       low_stock_items, out_of_stock, excess_stock,
       {pct('(low_stock_items + out_of_stock)', 'total_products')} as stock_risk_pct,
       cast(units as bigint) as units_sold, orders_count as order_count, {ratio('units', 'oc')} as avg_order_size,
       {pct('units', 'stock')} as stock_turnover_pct, cast(gross as double) as gross_revenue,
       cast(gross - discount as double) as net_revenue, cast(discount as double) as total_discounts,
       {pct('discount', 'gross')} as discount_pct, {ratio('price_sum', 'n')} as average_price,
       median_price, cast(min_price as double) as min_price, cast(max_price as double) as max_price,
       {pct('purchases', 'pv')} as conversion_rate_pct, {pct('returned', 'n')} as return_rate_pct,
       {pct('fulfilled', 'oc')} as fulfillment_rate_pct, {pct('cancelled', 'oc')} as cancellation_rate_pct,
       cast(promo as bigint) as products_on_promotion, {ratio('off_sum', 'n')} as avg_discount_pct,
       cast(page_views as bigint) as page_views, cast(unique_visitors as bigint) as unique_visitors,
       {pct('unique_visitors', 'page_views')} as visitor_engagement_pct
from f order by day desc, net_revenue desc"""

# --- tables and documents ---------------------------------------------------------------------

ORACLE["full_products"] = f"""
with {CATALOG} select p.item_id, name, created_time, updated_time, primary_category, p.status, sku_id,
       seller_sku, shop_sku, s.status as sku_status, quantity, available, cast(price as double) as price,
       cast(special_price as double) as special_price, brand, description, image_url
from products p left join skus s on p.item_id = s.item_id left join attributes a on p.item_id = a.item_id
     left join images i on p.item_id = i.item_id"""


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S')"


def _text(*columns: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), '-')" for c in columns) + ")"


MONEY = [f"cast({c} as decimal(18,2))" for c in ("price", "special_price")]
DISTINCT_SKUS = """ds as (
    select distinct item_id, sku_id, seller_sku, shop_sku, status, quantity, available, price, special_price
    from skus), ns as (
    select *, row_number() over (partition by item_id order by sku_id, seller_sku, shop_sku, status, quantity,
                                 available, price, special_price) as rn from ds), ni as (
    select item_id, image_url, row_number() over (partition by item_id order by image_url) as rn
    from (select distinct item_id, image_url from images))"""
ORACLE["product_documents_flat"] = f"""
with {CATALOG}, {DISTINCT_SKUS}
select cast(p.item_id as varchar) as id, cast(0 as bigint) as part, 'header' as kind, cast(0 as int) as pos,
       {_text('name', _iso('created_time'), _iso('updated_time'), 'primary_category', 'status', 'brand', 'description')}
           as value
from products p left join attributes a on p.item_id = a.item_id
union all
select cast(p.item_id as varchar), 0, 'sku', cast(rn - 1 as int),
       {_text('sku_id', 'seller_sku', 'shop_sku', 'ns.status', 'quantity', 'available', *MONEY)}
from products p join ns on p.item_id = ns.item_id
union all
select cast(p.item_id as varchar), 0, 'image', cast(rn - 1 as int), image_url
from products p join ni on p.item_id = ni.item_id"""
ORACLE["flatten_stream_batch"] = f"""
with {CATALOG}, {DISTINCT_SKUS}
select p.item_id, name, created_time, updated_time, primary_category, p.status, cast(price as double) as price,
       quantity, image_url, brand, description
from products p left join ns on p.item_id = ns.item_id and ns.rn = 1
     left join ni on p.item_id = ni.item_id and ni.rn = 1
     left join attributes a on p.item_id = a.item_id"""
ORACLE["normalize_pages_skus"] = f"""
with {CATALOG}, {DISTINCT_SKUS} select ds.item_id, sku_id, seller_sku, shop_sku, ds.status, quantity, available,
       cast(price as double) as price, cast(special_price as double) as special_price,
       '2024-01-31' as created_date
from products p join ds on p.item_id = ds.item_id"""
ORACLE["normalize_pages_products"] = f"""
with {PRODUCTS} select item_id, name, created_time, updated_time, primary_category, status,
       '2024-01-31' as created_date from products"""
ORACLE["normalize_pages_children"] = f"""
with {CATALOG} select distinct i.item_id, 'image' as kind, image_url as value
from products p join images i on p.item_id = i.item_id
union all select item_id, 'brand', brand from attributes"""
ORACLE["rejected_products"] = """
select item_id, reasons from (
    select p_partkey as item_id, concat_ws(',', case when p_type = 'ECONOMY' then 'no attributes' end,
           case when p_size > 45 then 'created_time' end) as reasons from part) where reasons <> ''"""
ORACLE["snapshot_rows"] = f"""
with {CATALOG}
select 'products' as table, item_id, cast(null as bigint) as sku_id, cast(null as varchar) as image_url,
       cast(null as varchar) as brand, cast(null as double) as price, {_iso('created_time')} as created_time
from products
union all select 'skus', item_id, sku_id, null, null, cast(price as double), null from skus
union all select 'images', item_id, null, image_url, null, null, null from images
union all select 'attributes', item_id, null, null, brand, null, null from attributes"""

# --- merges and checks ------------------------------------------------------------------------

SKU_OUT = """item_id, sku_id, seller_sku, shop_sku, status, quantity, available,
       cast(price as double) as price, cast(special_price as double) as special_price, created_date"""
LAST = "row_number() over (partition by item_id, sku_id order by l_shipdate desc, l_extendedprice desc) as rn"
ORACLE["upsert_skus"] = f"""
with {SKUS}, target as (select * from (select *, {LAST} from versions) where rn = 1), updates as (
    select * replace ('returned' as status, 0 as quantity) from (
        select *, {LAST} from versions where l_returnflag = 'R') where rn = 1)
select {SKU_OUT} from target t where not exists (
    select 1 from updates u where u.item_id = t.item_id and u.sku_id = t.sku_id)
union all select {SKU_OUT} from updates"""
ORACLE["replace_children_skus"] = f"""
with {SKUS}, late as (select * replace ('new' as status) from versions where l_shipdate >= timestamp '2001-10-15')
select {SKU_OUT} from versions where item_id not in (select item_id from late)
union all select {SKU_OUT} from late"""
IMAGE_UPDATES = """updates as (
    select item_id, image_url, cast({pick}(d) as varchar) as created_date from (
        select page_id // 3 as item_id, url as image_url, date '2024-02-01' + cast(page_id % 5 as int) as d
        from pages) group by 1, 2)"""
ORACLE["insert_missing_images"] = f"""
with {IMAGES}, {IMAGE_UPDATES.format(pick='min')}
select * from images union all select * from updates u where not exists (
    select 1 from images i where i.item_id = u.item_id and i.image_url = u.image_url)"""
ORACLE["upsert_image_dates"] = f"""
with {IMAGES}, {IMAGE_UPDATES.format(pick='max')}
select distinct * from images i where not exists (
    select 1 from updates u where i.item_id = u.item_id and i.image_url = u.image_url)
union all select * from updates"""
ORACLE["check_key_skus"] = f"""
with {SKUS} select item_id, sku_id, count(*) as n from skus group by 1, 2
having count(*) > 1 or item_id is null or sku_id is null"""
ORACLE["check_reference_images"] = f"""
with {SKUS}, {IMAGES} select item_id, count(*) as n from skus where item_id not in (
    select item_id from images) group by 1"""
ORACLE["check_lengths_images"] = f"""
with {IMAGES} select *, 'image_url' as too_long from images where length(image_url) > 40"""
REASONS = """concat_ws(',', case when length(name) > 10 then 'long name' end,
       case when created_time is null then 'no sales' end,
       case when primary_category > 45 then 'large category' end)"""
ORACLE["split_bad_products"] = f"""
with {PRODUCTS} select * from (select item_id, name, {REASONS} as reasons from products) where reasons <> ''"""
ORACLE["drop_children_skus"] = f"""
with {SKUS}, {PRODUCTS} select item_id, sku_id, quantity from skus where item_id not in (
    select item_id from products where {REASONS} <> '')"""

# --- projections ------------------------------------------------------------------------------

ORACLE["image_variants"] = f"""
with {IMAGES} select item_id, image_url || '?size=large' as image_url from images
union all select item_id, image_url || '?size=small' from images"""
ORACLE["label_cycle"] = """
select ['alpha', 'beta', 'gamma', 'delta', 'epsilon', 'zeta', 'eta', 'theta', 'iota', 'kappa'][p_partkey % 10 + 1]
           as label, count(*) as n, max('SKU-' || p_partkey) as last_name
from part group by 1"""
ORACLE["hour_cycle"] = """
select hour(ts) as hour, round(sin(hour(ts) / 24.0::double * 2.0 * pi()), 9) as cycle, count(*) as n
from events group by 1, 2"""
ORACLE["whole_units"] = """
select event_id, cast(case when event_id % 2 = 0 then event_id // 2
       else (event_id // 2) + (event_id // 2) % 2 end as int) as units from events"""
ORACLE["infer_schema_props"] = """
select lower(key) as column_name, case when count(distinct t) = 1 then max(t)
       when count(distinct t) = 2 and min(t) = 'DECIMAL' and max(t) = 'INTEGER' then 'DECIMAL'
       else 'TEXT' end as sql_type
from (select key, case json_type(props, key) when 'UBIGINT' then 'INTEGER' when 'BIGINT' then 'INTEGER'
             when 'DOUBLE' then 'DECIMAL' when 'BOOLEAN' then 'BOOLEAN' when 'VARCHAR' then 'TEXT'
             when 'OBJECT' then 'JSONB' when 'ARRAY' then 'JSONB' end as t
      from (select props, unnest(json_keys(props)) as key from events))
group by 1 union all select 'created_date', 'DATE'"""
ORACLE["page_slice"] = """
select p_partkey as item_id, p_name as name, p_size as primary_category from part
order by p_partkey limit 20 offset 40"""
ORACLE["recent_points"] = f"""
with {POINTS} select item_id, price, quantity, timestamp, event_id from points
where timestamp > timestamp '2024-01-30 12:00:00' - interval 36 hour
  and timestamp <= timestamp '2024-01-30 12:00:00'"""

# --- series -----------------------------------------------------------------------------------

BY_ITEM = "partition by item_id order by timestamp, event_id"
MOVES = f"""{POINTS}, moves as (
    select *, row_number() over w - 1 as pos, price - lag(price) over w as move,
           greatest(coalesce(price - lag(price) over w, 0), 0) as gain,
           greatest(coalesce(lag(price) over w - price, 0), 0) as loss
    from points window w as ({BY_ITEM}))"""
LEVEL = """case when u = 0 and v = 0 then 50.0::double when v = 0 then 100.0::double
            else 100.0::double - 100.0::double / (1 + u / v) end"""
SMOOTH = f"""{MOVES}, seeds as (
    select item_id, avg(gain) as u, avg(loss) as v from moves where pos between 1 and 14 group by 1),
walk(item_id, pos, ema, u, v) as (
    select item_id, pos, price, cast(null as double), cast(null as double) from moves where pos = 0
    union all
    select m.item_id, m.pos, w.ema + (2.0::double / 15) * (m.price - w.ema),
           case when m.pos = 14 then s.u when m.pos > 14 then (w.u * 13 + m.gain) / 14 end,
           case when m.pos = 14 then s.v when m.pos > 14 then (w.v * 13 + m.loss) / 14 end
    from walk w join moves m on m.item_id = w.item_id and m.pos = w.pos + 1
         join seeds s on s.item_id = m.item_id),
ind as (
    select m.item_id, m.name, m.price, m.quantity, m.timestamp, m.event_id,
           round(avg(m.price) over (partition by m.item_id order by m.pos rows between 6 preceding and current row), 6)
               as sma_7,
           round(ema, 6) as ema_14, round(case when m.pos >= 14 then {LEVEL} end, 6) as rsi_14,
           cast(sum(case when move <> 0 then 1 else 0 end) over (
               partition by m.item_id order by m.pos) as bigint) as price_changes
    from moves m join walk w on m.item_id = w.item_id and m.pos = w.pos)"""
KEYS = "item_id, price, timestamp, event_id"
ORACLE["sma_7"] = f"""
with {POINTS} select {KEYS}, round(avg(price) over ({BY_ITEM} rows between 6 preceding and current row), 6) as sma_7
from points"""
ORACLE["sma_7d"] = f"""
with {POINTS} select {KEYS}, round(avg(price) over (partition by item_id order by epoch_us(timestamp)
    range between 604799999999 preceding and current row), 6) as sma_7d from points"""
ORACLE["ema_14"] = f"with recursive {SMOOTH} select {KEYS}, ema_14 from ind"
ORACLE["rsi_14_wilder"] = f"with recursive {SMOOTH} select {KEYS}, rsi_14 from ind"
ORACLE["rsi_14_cutler"] = f"""
with {MOVES}, means as (
    select *, avg(gain) over w as u, avg(loss) over w as v from moves
    window w as ({BY_ITEM} rows between 13 preceding and current row))
select {KEYS}, round(case when pos >= 14 then {LEVEL} end, 6) as rsi_14 from means"""
ORACLE["price_changes"] = f"with recursive {SMOOTH} select {KEYS}, price_changes from ind"
ORACLE["price_indicators"] = f"""
with recursive {SMOOTH} select item_id, name, price, quantity, timestamp, event_id, sma_7, ema_14, rsi_14,
       price_changes from ind"""

INSTANTS = f"""{POINTS}, instants as (
    select item_id, timestamp, arg_max(price, event_id) as price, arg_max(quantity, event_id) as quantity,
           arg_max(name, event_id) as name, epoch_us(timestamp) as us
    from points group by item_id, timestamp), steps as (
    select *, lag(price) over (partition by item_id order by us) as last_price from instants)"""


def _windowed(name: str, micros: int) -> str:
    """Changes, rate and percent change over the window, as one row per sample."""
    return f"""{name} as (
    select a.item_id, a.us, sum(case when b.us > f.first_us and b.price <> b.last_price then 1 else 0 end) as changes,
           sum(case when b.us > f.first_us then case when b.price < b.last_price then b.price
                    else b.price - b.last_price end else 0 end)
               / nullif((max(b.us) - min(b.us)) / 1e6::double, 0) as rate,
           (arg_max(b.price, b.us) - arg_min(b.price, b.us)) / nullif(arg_min(b.price, b.us), 0) * 100 as pct_change
    from steps a join (
        select a.item_id, a.us, min(b.us) as first_us from steps a join steps b
        on a.item_id = b.item_id and b.us > a.us - {micros} and b.us <= a.us group by 1, 2) f
        on a.item_id = f.item_id and a.us = f.us
    join steps b on a.item_id = b.item_id and b.us > a.us - {micros} and b.us <= a.us
    group by 1, 2)"""


def _measure(micros: int, columns: str) -> str:
    return f"""with {INSTANTS}, {_windowed('w', micros)}
select i.item_id, i.timestamp, i.price, {columns} from instants i join w on i.item_id = w.item_id and i.us = w.us"""


HOUR = 3_600_000_000
ORACLE["changes_1h"] = _measure(HOUR, "cast(changes as bigint) as changes_1h")
ORACLE["rate_5m"] = _measure(HOUR // 12, "round(rate, 6) as rate_5m")
ORACLE["pct_change_5m"] = _measure(HOUR // 12, "round(pct_change, 6) as pct_change_5m")
ORACLE["window_measures_3d"] = _measure(
    72 * HOUR, "cast(changes as bigint) as changes, round(rate, 6) as rate, round(pct_change, 6) as pct_change")
ORACLE["held_for_10m"] = f"""
with {POINTS}, flagged as (
    select *, coalesce(quantity < 50, false) as cond from points), islands as (
    select *, sum(case when cond then 0 else 1 end) over ({BY_ITEM}) as island from flagged), starts as (
    select item_id, island, min(timestamp) as since from islands where cond group by 1, 2)
select i.item_id, price, quantity, timestamp, event_id,
       coalesce(cond and timestamp - since >= interval 10 minute, false) as held
from islands i left join starts s on i.item_id = s.item_id and i.island = s.island"""
ORACLE["latest_by_item"] = f"""
with {POINTS} select item_id, name, price, quantity, timestamp, event_id from (
    select *, row_number() over (partition by item_id order by timestamp desc, event_id desc) as rn from points)
where rn = 1"""


def _samples() -> str:
    def branch(metric: str, value: str, name: str, period: str) -> str:
        return (f"select '{metric}' as metric, cast(item_id as varchar) as item_id, {name} as name, "
                f"{period} as period, round(cast({value} as double), 6) as value, timestamp as ts, event_id from ind")

    none = "cast(null as varchar)"
    return "samples as (" + " union all ".join([
        branch("product_price", "price", "name", none), branch("product_quantity", "quantity", "name", none),
        branch("price_sma", "sma_7", none, "'7d'"), branch("price_ema", "ema_14", none, "'14d'"),
        branch("price_rsi", "rsi_14", none, none)]) + ")"


ORACLE["metric_samples"] = f"with recursive {SMOOTH}, {_samples()} select * from samples"
ORACLE["metric_panel_sma"] = f"""
with recursive {SMOOTH}, {_samples()} select * from samples where metric = 'price_sma' and period = '7d'"""
ORACLE["metric_gauges"] = f"""
with recursive {SMOOTH}, {_samples()} select metric, item_id, name, period, value, ts from (
    select *, row_number() over (partition by metric, item_id, name, period order by ts desc, event_id desc) as rn
    from samples) where rn = 1"""


def _alerts(short: int, long: int, rules: list[tuple[str, str, str, str, str]]) -> str:
    def episodes(alert: str, severity: str, condition: str, value: str, hold: str) -> str:
        return f"""select '{alert}' as alert, '{severity}' as severity, item_id, name, since as starts_at,
            round(cast(arg_min({value}, timestamp) as double), 6) as value,
            round(arg_min_null(rate, timestamp), 6) as rate_5m
        from (select *, min(case when cond then timestamp end) over (partition by item_id, island) as since from (
            select *, sum(case when cond then 0 else 1 end) over (partition by item_id order by us) as island from (
            select *, coalesce({condition}, false) as cond from readings)))
        where cond and timestamp - since >= interval {hold} group by all"""

    return f"""
with recursive {SMOOTH}, instants as (
    select item_id, name, timestamp, arg_max(price, event_id) as price, arg_max(quantity, event_id) as quantity,
           arg_max(rsi_14, event_id) as rsi, epoch_us(timestamp) as us from ind group by 1, 2, 3), steps as (
    select *, lag(price) over (partition by item_id order by us) as last_price from instants),
{_windowed('ws', short)}, {_windowed('wl', long)}, readings as (
    select i.*, ws.pct_change as pct, ws.rate as rate, wl.changes as changes
    from instants i join ws on i.item_id = ws.item_id and i.us = ws.us
         join wl on i.item_id = wl.item_id and i.us = wl.us)
""" + " union all ".join(episodes(*r) for r in rules)


ORACLE["evaluate_alerts"] = _alerts(HOUR // 12, HOUR, [
    ("ProductPriceSpike", "warning", "pct > 20", "pct", "5 minute"),
    ("LowInventory", "warning", "quantity < 10", "quantity", "10 minute"),
    ("PriceVolatility", "warning", "changes > 5", "changes", "15 minute"),
    ("TechnicalIndicatorAlert", "info", "rsi > 70 or rsi < 30", "rsi", "30 minute")])
ORACLE["evaluate_alerts_wide"] = _alerts(48 * HOUR, 96 * HOUR, [
    ("ProductPriceSpike", "warning", "pct > 20", "pct", "12 hour"),
    ("LowInventory", "warning", "quantity < 40", "quantity", "10 hour"),
    ("PriceVolatility", "warning", "changes > 5", "changes", "24 hour"),
    ("TechnicalIndicatorAlert", "info", "rsi > 55 or rsi < 45", "rsi", "30 minute")])

# --- spines -----------------------------------------------------------------------------------

ORACLE["time_spine"] = """
with hours as (select date_trunc('hour', ts) as stamp, count(*) as n from events group by 1)
select t.stamp, coalesce(n, 0) as n
from (select unnest(generate_series(min(stamp), max(stamp), interval 1 hour)) as stamp from hours) t
     left join hours h on h.stamp = t.stamp"""
ORACLE["number_series"] = """
select n, count(p_partkey) as parts from (select unnest(range(1, cast((select max(p_size) from part) as bigint) + 1)) as n) s
     left join part on p_size = n group by 1"""

# Taking the points in batch by batch, late ones included, makes no difference.
ORACLE["indicators_resumed"] = ORACLE["price_indicators"]
ORACLE["alerts_resumed"] = ORACLE["evaluate_alerts_wide"]
