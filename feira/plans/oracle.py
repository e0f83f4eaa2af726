"""Independent SQL for the registered queries, to be run by another engine over the same Parquet tables."""

from __future__ import annotations

import re

from feira.functions.dates import FIXED_HOLIDAYS
from feira.functions.text import ACCENTED_LETTERS, PORTUGUESE_STOPWORDS
from feira.operators.churn import FEATURES
from feira.plans import registry as r
from feira.plans.adapters import TRANSLATIONS


def _quoted(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def _key(col: str) -> str:
    return f"lpad(cast({col} as varchar), 10, '0')"


def _text(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def _cleaned(col: str) -> str:
    untagged = f"regexp_replace(lower({col}), '<[^>]+>', '', 'g')"
    lettered = f"regexp_replace({untagged}, '[^a-z{ACCENTED_LETTERS}\\s]', '', 'g')"
    squeezed = f"trim(regexp_replace({lettered}, '\\s+', ' ', 'g'))"
    kept = f"[t for t in string_split({squeezed}, ' ') if t not in ({_quoted(PORTUGUESE_STOPWORDS)})]"
    return f"case when trim({col}) <> '' then coalesce(array_to_string({kept}, ' '), '') end"


def _date_key(col: str) -> str:
    return f"cast(strftime({col}, '%Y%m%d') as integer)"


def _key_date(col: str) -> str:
    return f"strptime(cast({col} as varchar), '%Y%m%d')::date"


# Named building blocks; each statement pulls in those it mentions.
_BLOCKS: dict[str, str] = {
    "typed_orders": f"""
        select *, case when k % 11 <> 0 then carrier + to_hours(24 + k % 331) end as delivered
        from (
            select k, {_key('k')} as order_id, {_key('o_custkey')} as customer_id,
                case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' when 'P' then 'canceled' end
                    as order_status,
                purchase,
                case when k % 97 <> 0 then purchase + to_hours(k % 48) end as approved,
                case when k % 89 <> 0 then purchase + to_hours(k % 72 + 12) end as carrier,
                date_trunc('day', purchase)::timestamp + to_days(cast(8 + k % 13 as integer)) as estimated
            from (select o_orderkey as k, *, o_orderdate + to_hours(o_orderkey % 24) as purchase from orders))""",
    "raw_orders": f"""
        select order_id, customer_id, order_status, {_text('purchase')} as order_purchase_timestamp,
            {_text('approved')} as order_approved_at, {_text('carrier')} as order_delivered_carrier_date,
            {_text('delivered')} as order_delivered_customer_date,
            {_text('estimated')} as order_estimated_delivery_date
        from typed_orders""",
    "ranked_orders": """
        select *, row_number() over (order by order_purchase_timestamp, order_id) as rank,
            count(*) over () as n from raw_orders""",
    "head_orders": "select * from ranked_orders where rank <= floor(n * cast(0.9 as double))",
    "tail_orders": "select * from ranked_orders where rank > floor(n * cast(0.9 as double))",
    "places": """
        select n_nationkey, n_name, r_name, lpad(cast(n_nationkey as varchar), 5, '0') as zip
        from nation join region on n_regionkey = r_regionkey""",
    "customers": f"""
        select {_key('c_custkey')} as customer_id, {_key('c_custkey')} as customer_unique_id,
            zip as customer_zip_code_prefix, n_name as customer_city, r_name as customer_state, c_acctbal, c_nationkey
        from customer join places on c_nationkey = n_nationkey""",
    "sellers": f"""
        select {_key('s_suppkey')} as seller_id, zip as seller_zip_code_prefix, n_name as seller_city,
            r_name as seller_state
        from supplier join places on s_nationkey = n_nationkey""",
    "raw_products": f"""
        select {_key('p_partkey')} as product_id,
            case when p_partkey % 41 <> 0 then lower(p_type) end as product_category_name,
            cast(length(p_name) as varchar) as product_name_lenght,
            cast(length(p_type) as varchar) as product_description_lenght,
            '1' as product_photos_qty,
            cast(p_size * 100 as varchar) as product_weight_g,
            cast(p_size as varchar) as product_length_cm,
            cast(p_size % 7 + 1 as varchar) as product_height_cm,
            case when p_partkey % 53 <> 0 then cast(p_size % 5 + 2 as varchar) end as product_width_cm
        from part""",
    "products": """
        select product_id, coalesce(product_category_name, 'unknown') as product_category_name, product_name_lenght,
            product_description_lenght, product_photos_qty,
            cast(product_weight_g as double) as product_weight_g,
            cast(product_length_cm as double) as product_length_cm,
            cast(product_height_cm as double) as product_height_cm,
            cast(product_width_cm as double) as product_width_cm,
            cast(product_length_cm as double) * cast(product_height_cm as double) * cast(product_width_cm as double)
                as product_volume_cm3
        from raw_products""",
    "items": f"""
        select {_key('l_orderkey')} as order_id, l_linenumber as order_item_id, {_key('l_partkey')} as product_id,
            {_key('l_suppkey')} as seller_id, {_text('l_shipdate')} as shipping_limit_date,
            l_extendedprice as price, l_quantity * 0.25 + 5 as freight_value
        from lineitem""",
    "repeated_items": """
        select * from items
        union all
        select order_id, order_item_id + 100, product_id, seller_id, shipping_limit_date, price, freight_value
        from items where cast(order_id as bigint) % 19 = 0""",
    "payments": f"""
        select {_key('o_orderkey')} as order_id, 1 as payment_sequential,
            case o_orderkey % 4 when 0 then 'credit_card' when 1 then 'boleto' when 2 then 'voucher'
                else 'debit_card' end as payment_type,
            cast(1 + o_orderkey % 10 as integer) as payment_installments, o_totalprice as payment_value
        from orders""",
    "reviews": f"""
        select {_key('doc_id')} as review_id, {_key('doc_id // 2')} as order_id,
            coalesce(1 + 2 * quality + 2 * (1 - toxic), 3) as review_score,
            1 + 2 * quality + 2 * (1 - toxic) as given_score,
            case when doc_id % 17 <> 0 then text end as review_comment_message,
            timestamp '2018-01-01' + to_hours(doc_id % 1000) as created,
            case when doc_id % 29 <> 0 then timestamp '2018-01-01' + to_hours(doc_id * 37 % 1000) end as answered
        from documents left join labels using (doc_id)""",
    "cleaned_reviews": f"select *, {_cleaned('review_comment_message')} as review_comment_cleaned from reviews",
    "latest_reviews": """
        select * from (select *, row_number() over (partition by order_id order by answered desc nulls last, review_id)
            as place from reviews) where place = 1""",
    "zip_medians": """
        select customer_zip_code_prefix,
            cast(quantile_disc(date_diff('day', carrier::date, delivered::date), 0.5) as integer)
                as median_delivery_days
        from typed_orders join customers using (customer_id)
        where carrier is not null and delivered is not null group by 1""",
    "full_orders": """
        select o.* replace (case when delivered is null and carrier is not null
                then cast(carrier::date + median_delivery_days as timestamp) else delivered end as delivered),
            delivered is null and carrier is not null and median_delivery_days is not null as is_imputed
        from typed_orders o join customers using (customer_id)
            left join zip_medians using (customer_zip_code_prefix)""",
    "dim_customers": """
        select row_number() over (order by customer_id) as customer_key, customer_id, customer_unique_id,
            customer_zip_code_prefix, customer_city, customer_state from customers""",
    "dim_sellers": "select row_number() over (order by seller_id) as seller_key, * from sellers",
    "dim_products": f"""
        select row_number() over (order by product_id) as product_key, product_id,
            case product_category_name {' '.join(f"when '{a}' then '{b}'" for a, b in TRANSLATIONS.items())}
                else product_category_name end as product_category_english,
            product_weight_g, product_length_cm, product_volume_cm3 from products""",
    "dim_order_status": """
        select row_number() over (order by status_name) as status_key, status_name
        from (select distinct order_status as status_name from typed_orders)""",
    "order_dates": """
        select purchase::date as full_date from full_orders union select estimated::date from full_orders
        union select delivered::date from full_orders""",
    "calendar": """
        select unnest(generate_series(min(full_date), max(full_date), interval 1 day))::date as full_date
        from order_dates""",
    "dim_date": f"""
        select {_date_key('full_date')} as date_key, full_date, dayname(full_date) as day_of_week,
            monthname(full_date) as month_name, cast(quarter(full_date) as integer) as quarter,
            cast(year(full_date) as integer) as year,
            strftime(full_date, '%m-%d') in ({_quoted(FIXED_HOLIDAYS)}) as is_holiday_brazil
        from order_dates where full_date is not null""",
    "wide_items": f"""
        select i.order_id, customer_key, product_key, seller_key, {_date_key('purchase')} as order_date_key,
            {_date_key('estimated')} as estimated_delivery_date_key, {_date_key('delivered')} as delivered_date_key,
            status_key, cast(price as decimal(10,2)) as item_price,
            cast(freight_value as decimal(10,2)) as freight_value,
            coalesce(review_score, 3) as review_score,
            cast(date_diff('second', approved, carrier) / 3600.0 as decimal(10,2)) as processing_time_hours,
            cast(round(date_diff('second', carrier, delivered) / 86400.0) as integer) as shipping_time_days,
            order_item_id, is_repeat
        from (select *, false as is_repeat from items
              union all select *, true from repeated_items where order_item_id > 100) i
            left join full_orders o on i.order_id = o.order_id
            left join dim_customers c on o.customer_id = c.customer_id
            left join dim_products p on i.product_id = p.product_id
            left join dim_sellers s on i.seller_id = s.seller_id
            left join dim_order_status st on o.order_status = st.status_name
            left join latest_reviews v on i.order_id = v.order_id""",
    "fact": "select distinct * exclude (order_item_id, is_repeat) from wide_items where not is_repeat",
    "repeated_fact": "select distinct * exclude (order_item_id, is_repeat) from wide_items",
    "leads": f"""
        select {_key('s_suppkey')} as lead_id, {_key('s_suppkey')} as seller_id,
            case s_suppkey % 4 when 0 then 'organic_search' when 1 then 'paid_search' when 2 then 'social'
                else 'email' end as channel,
            date '2000-01-01' + cast(s_suppkey % 300 as integer) as first_contact_date,
            date '2000-01-01' + cast(s_suppkey % 300 + s_suppkey % 60 as integer) as won_date
        from supplier""",
    "geolocation": """
        select n_nationkey as zip, cast(n_nationkey - 30 as double) as lat,
            cast(n_nationkey * 0.5 - 60 as double) as lng, n_name as city, r_name as state from places""",
    "delays": f"""
        select *, date_diff('day', {_key_date('estimated_delivery_date_key')}, {_key_date('delivered_date_key')})
            as delay_days from fact""",
    "monthly": """
        select order_date_key // 100 as month, order_date_key // 10000 as year, sum(item_price) as revenue
        from fact group by all""",
    "per_order": """
        select customer_key, order_id, max(order_date_key) as order_date_key, sum(item_price) as value,
            sum(review_score) as score, count(*) as items from fact group by all""",
    "labels_after": f"""
        select customer_unique_id,
            case when count(*) filter (purchase >= timestamp '{r.CHURN_CUTOFF}'
                and purchase < timestamp '{r.CHURN_CUTOFF}' + to_days(180)) = 0 then 1 else 0 end as churned
        from full_orders join customers using (customer_id) group by 1
        having count(*) filter (purchase < timestamp '{r.CHURN_CUTOFF}') > 0""",
    "known_scores": f"""
        select order_id, review_score from (
            select *, row_number() over (partition by order_id order by answered desc nulls last, review_id) as place
            from reviews where answered < timestamp '{r.CHURN_CUTOFF}') where place = 1""",
    "training": f"""
        select customer_unique_id, any_value(churned) as churned,
            cast(date '{r.CHURN_CUTOFF}' - {_key_date('max(order_date_key)')} as integer) as recency_days,
            count(distinct order_id) as frequency, cast(sum(item_price) as double) as monetary,
            coalesce(sum(delay) / count(delay), 0) as delivery_delay_days,
            coalesce(cast(sum(freight_value) as double) / cast(sum(item_price) as double), 0) as freight_ratio,
            sum(coalesce(k.review_score, 3)) / count(*) as avg_review_score,
            coalesce(max(payment_installments), 0) as max_installments
        from (select *, case when delivered_date_key < {r.CHURN_CUTOFF.replace('-', '')} then delay_days end as delay
                from delays where order_date_key < {r.CHURN_CUTOFF.replace('-', '')}) f
            join dim_customers using (customer_key) join labels_after using (customer_unique_id)
            left join known_scores k using (order_id) left join payments using (order_id)
        group by 1""",
    "version_two": """
        select order_id, case when order_status = 'shipped' then 'delivered' else order_status end as order_status
        from ranked_orders where order_status <> 'canceled'""",
}


def _statement(body: str) -> str:
    """``body`` behind the blocks it needs, in their declared order."""
    needed: set[str] = set()
    open_texts = [body]
    while open_texts:
        text = open_texts.pop()
        for name, block in _BLOCKS.items():
            if name not in needed and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                needed.add(name)
                open_texts.append(block)
    blocks = [f"{name} as ({block.strip()})" for name, block in _BLOCKS.items() if name in needed]
    return (f"with {', '.join(blocks)} " if blocks else "") + body.strip()


_FACT_COLUMNS = """customer_key, product_key, seller_key, order_date_key, estimated_delivery_date_key,
    delivered_date_key, status_key, cast(item_price as double) as item_price,
    cast(freight_value as double) as freight_value, review_score,
    cast(processing_time_hours as double) as processing_time_hours, shipping_time_days"""

_ORDER_COLUMNS = """order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
    order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date"""


def _check(layer: str, table: str, source: str, constraints: list[tuple[str, str]]) -> str:
    """``constraints``: name and SQL of the share of rows that meet it."""
    parts = [
        f"select '{layer}' as layer, '{table}' as table_name, '{name}' as constraint_name, "
        f"cast(({metric}) as double) as metric from {source}"
        for name, metric in constraints
    ]
    return " union all ".join(parts)


def _checks(*parts: str) -> str:
    return f"""select *, case when metric = 1.0 then 'Success' else 'Failure' end as constraint_status
        from ({' union all '.join(parts)})"""


def _complete(col: str) -> tuple[str, str]:
    return f"complete({col})", f"count({col}) / count(*)"


def _unique(col: str, source: str) -> tuple[str, str]:
    once = f"select count(*) filter (n = 1) / sum(n) from (select count(*) as n from {source} where {col} is not null group by {col})"
    return f"unique({col})", f"any_value(({once}))"


def _holds(predicate: str) -> tuple[str, str]:
    return f"satisfies({predicate})", f"count(*) filter ({predicate}) / count(*)"


def _short(col: str, length: int) -> tuple[str, str]:
    return f"max_length({col},{length})", f"count(*) filter ({col} is null or length({col}) <= {length}) / count(*)"


def _foreign_keys() -> str:
    parents = {
        "customer_key": ("dim_customers", "customer_key"),
        "product_key": ("dim_products", "product_key"),
        "seller_key": ("dim_sellers", "seller_key"),
        "order_date_key": ("dim_date", "date_key"),
        "estimated_delivery_date_key": ("dim_date", "date_key"),
        "delivered_date_key": ("dim_date", "date_key"),
        "status_key": ("dim_order_status", "status_key"),
    }
    return " union all ".join(
        f"select '{fk}' as foreign_key, count({fk}) as checked_rows, "
        f"count(*) filter ({fk} is not null and {fk} not in (select {key} from {dim})) as orphan_rows, "
        f"count(*) filter ({fk} is null) as null_rows from fact"
        for fk, (dim, key) in parents.items()
    )


def _counts() -> str:
    rows = {
        ("raw", "orders"): "head_orders",
        ("clean", "orders"): "orders",
        ("gold", "dim_customers"): "customer",
        ("gold", "dim_sellers"): "supplier",
        ("gold", "dim_products"): "part",
        ("gold", "dim_order_status"): "dim_order_status",
        ("gold", "dim_date"): "dim_date",
        ("gold", "fct_order_items"): "fact",
        ("gold", "fct_marketing_leads"): "supplier",
    }
    translated = f"(select distinct p_type from part where lower(p_type) in ({_quoted(TRANSLATIONS)}))"
    for layer in ("raw", "clean"):
        rows |= {
            (layer, "order_items"): "lineitem",
            (layer, "order_payments"): "orders",
            (layer, "order_reviews"): "documents",
            (layer, "customers"): "customer",
            (layer, "products"): "part",
            (layer, "sellers"): "supplier",
            (layer, "geolocation"): "nation",
            (layer, "category_translation"): translated,
        }
    return " union all ".join(
        f"select '{layer}' as layer, '{table}' as table_name, count(*) as row_count from {source}"
        for (layer, table), source in rows.items()
    )


def _margin(point) -> str:
    """Linear sum of a published point; doubles throughout."""
    terms = [f"{point.coefficients[f]!r}::double * {f}" for f in sorted(point.coefficients)]
    return " + ".join([f"{point.intercept!r}::double", *terms])


def _probability(point) -> str:
    return f"1 / (1 + exp(-({_margin(point)})))"


def _trees(ensemble) -> str:
    """The split table as CASE expressions, one per tree."""
    held = {(n.tree, n.node): n for n in ensemble.nodes}

    def case(tree: int, number: int) -> str:
        n = held[tree, number]
        if n.feature is None:
            return f"{n.value!r}::double"
        return f"case when {n.feature} <= {n.threshold!r} then {case(tree, n.left)} else {case(tree, n.right)} end"

    return " + ".join(f"{w!r}::double * ({case(tree, 1)})" for tree, w in enumerate(ensemble.weights))


_PUBLISHED = f"""
    select customer_unique_id, churned, round({_probability(r.CHURN_POINTS[1])}, 4) as churn_probability from training"""
_CURVE = f"""
    select threshold, positives, negatives, tp, fp, tp / (tp + fp) as precision, tp / sum(positives) over () as recall from (
        select *, (sum(positives) over falling)::bigint as tp, (sum(negatives) over falling)::bigint as fp from (
            select churn_probability as threshold, sum(churned)::bigint as positives,
                sum(1 - churned)::bigint as negatives from ({_PUBLISHED}) group by 1)
        window falling as (order by threshold desc))"""
_BEST = f"""
    select threshold, 2 * precision * recall / (precision + recall) as f1 from ({_CURVE}) where tp > 0
    order by f1 desc nulls last, threshold desc limit 1"""


def statements() -> dict[str, str]:
    fact_key = """row_number() over (order by order_id nulls first, customer_key nulls first, product_key nulls first,
        seller_key nulls first, {ties} item_price nulls first, freight_value nulls first)"""
    year, quarter = r.CHANNEL_QUARTER
    bodies = {
        "catalog_counts": " union all ".join(
            f"select '{t}' as table_name, count(*) as row_count from {t}" for t in r.TABLES
        ),
        "page_orders": f"""
            select {_ORDER_COLUMNS}, (select count(*) from raw_orders) as total_rows
            from raw_orders order by order_id limit 100 offset 200""",
        "page_orders_deep": f"""
            select {_ORDER_COLUMNS}, n as total_rows
            from (select *, count(*) over () as n, row_number() over (order by order_id) - 1 as place from raw_orders)
            where place // 100 = (n + 99) // 100 - 2""",
        "lookup_order": f"select {_ORDER_COLUMNS} from raw_orders where order_id = '{r.LOOKUP_VALUE}'",
        "orders_in_range": f"""
            select {_ORDER_COLUMNS} from raw_orders
            where order_purchase_timestamp::timestamp between timestamp '{r.RANGE[0]}' and timestamp '{r.RANGE[1]}'""",
        "table_schemas": """
            select table_name, cast(column_index - 1 as integer) as position, column_name,
                case data_type when 'BIGINT' then 'bigint' when 'VARCHAR' then 'string' when 'DOUBLE' then 'double'
                    when 'INTEGER' then 'int' when 'DATE' then 'date'
                    when 'TIMESTAMP WITH TIME ZONE' then 'timestamp' else 'timestamp_ntz' end as type
            from duckdb_columns() where table_name in ('orders', 'events', 'customer')""",
        "orders_in_range_page": f"""
            select {_ORDER_COLUMNS}, count(*) over () as total_rows
            from raw_orders
            where order_purchase_timestamp::timestamp between timestamp '{r.RANGE[0]}' and timestamp '{r.RANGE[1]}'
            order by order_purchase_timestamp, order_id limit 50 offset 50""",
        "csv_roundtrip": "select * from raw_products",
        "csv_line_breaks": "select doc_id::varchar as doc_id, text, lang, source from documents",
        "raw_ingest": f"select {_ORDER_COLUMNS}, true as has_time from raw_orders",
        "split_batch": "select rank, order_id, order_purchase_timestamp from head_orders",
        "split_stream": "select rank, order_id, order_purchase_timestamp from tail_orders",
        "order_messages": f"""
            select {_ORDER_COLUMNS}, cast(cast(customer_id as bigint) % 4 as integer) as kafka_partition,
                rank as kafka_offset, true as is_keyed from tail_orders""",
        "logistics_messages": """
            select order_id, customer_id, order_delivered_carrier_date as delivered_carrier_date,
                order_delivered_customer_date as delivered_customer_date,
                order_estimated_delivery_date as estimated_delivery_date,
                cast(cast(customer_id as bigint) % 4 as integer) as kafka_partition, rank as kafka_offset
            from tail_orders where order_delivered_customer_date is not null""",
        "parse_logistics": """
            select order_id, customer_id, order_delivered_carrier_date as delivered_carrier_date,
                order_delivered_customer_date as delivered_customer_date,
                order_estimated_delivery_date as estimated_delivery_date
            from tail_orders where order_delivered_customer_date is not null""",
        "archive_stream": f"""
            select cast(user_id as varchar) as kafka_key, props as kafka_value, event_type as kafka_topic,
                cast(user_id % 4 as integer) as kafka_partition, event_id as kafka_offset,
                {_text('ts')} as kafka_timestamp from events""",
        "stream_dedup": 'select event_id as "offset", event_type as topic, props as value from events',
        "ordered_messages": """
            select order_id, order_status, kafka_partition, place as kafka_offset, place from (
                select order_id, order_status, cast(cast(customer_id as bigint) % 4 as integer) as kafka_partition,
                    row_number() over (partition by cast(customer_id as bigint) % 4 order by late, rank) - 1 as place
                from (select order_id, customer_id, order_status, rank, 0 as late from tail_orders union all
                    select order_id, customer_id, 'delivered', rank, 1 from tail_orders
                    where order_status = 'shipped'))""",
        "clean_feed_orders": f"""
            select {_ORDER_COLUMNS} from head_orders union all
            select {_ORDER_COLUMNS} from (select * replace (case when order_status = 'shipped' then 'delivered'
                else order_status end as order_status) from tail_orders)""",
        "merge_orders": f"""
            select {_ORDER_COLUMNS} from head_orders union all
            select {_ORDER_COLUMNS} from (select * replace (case when order_status = 'shipped' then 'delivered'
                else order_status end as order_status) from tail_orders)""",
        "typed_items": "select * from items",
        "typed_products": "select * from products",
        "typed_payments": "select * from payments",
        "typed_geo": """
            select cast(zip as integer) as geolocation_zip_code_prefix, lat as geolocation_lat,
                lng as geolocation_lng, city as geolocation_city, state as geolocation_state from geolocation""",
        "median_by_zip": "select * from zip_medians",
        "impute_delivery": f"""
            select order_id, customer_id, order_status, {_text('purchase')} as order_purchase_timestamp,
                {_text('approved')} as order_approved_at, {_text('carrier')} as order_delivered_carrier_date,
                {_text('delivered')} as order_delivered_customer_date,
                {_text('estimated')} as order_estimated_delivery_date, is_imputed
            from full_orders""",
        "clean_text": f"select doc_id, {_cleaned('text')} as cleaned from documents",
        "clean_html": f"select page_id, {_cleaned('html')} as cleaned from pages",
        "clean_reviews": f"""
            select review_id, order_id, review_score, {_text('created')} as review_creation_date,
                {_text('answered')} as review_answer_timestamp, review_comment_cleaned from cleaned_reviews""",
        "latest_review": f"""
            select order_id, review_id, given_score as review_score, {_text('answered')} as review_answer_timestamp
            from latest_reviews""",
        "dim_customers": "select * from dim_customers",
        "dim_sellers": "select * from dim_sellers",
        "dim_products": "select * from dim_products",
        "dim_order_status": "select * from dim_order_status",
        "dim_date": "select * replace (cast(full_date as varchar) as full_date) from dim_date",
        "dim_date_contiguous": f"""
            select {_date_key('full_date')} as date_key, cast(full_date as varchar) as full_date,
                dayname(full_date) as day_of_week, monthname(full_date) as month_name,
                cast(quarter(full_date) as integer) as quarter, cast(year(full_date) as integer) as year,
                strftime(full_date, '%m-%d') in ({_quoted(FIXED_HOLIDAYS)}) as is_holiday_brazil
            from calendar""",
        "fct_order_items": f"""
            select {fact_key.format(ties='')} as order_item_key, order_id, {_FACT_COLUMNS} from repeated_fact""",
        "fct_order_items_full": f"""
            select {fact_key.format(ties='order_item_id nulls first,')} as order_item_key, order_id, {_FACT_COLUMNS}
            from wide_items""",
        "fct_marketing_leads": f"""
            select row_number() over (order by lead_id) as lead_key, lead_id, seller_key, channel,
                {_date_key('first_contact_date')} as first_contact_date_key,
                {_date_key('won_date')} as won_date_key,
                cast(won_date - first_contact_date as integer) as sales_cycle_days
            from leads join dim_sellers using (seller_id)""",
        "scd2_customers": """
            select customer_id, cast(home as integer) as nation, '2016-01-01 00:00:00' as valid_from,
                case when debt then '2017-06-01 00:00:00' end as valid_to, not debt as is_current
            from (select customer_id, c_nationkey as home, c_acctbal < 0 as debt from customers)
            union all
            select customer_id, cast((c_nationkey + 1) % 25 as integer), '2017-06-01 00:00:00',
                case when c_acctbal < -500 then '2018-03-01 00:00:00' end, c_acctbal >= -500
            from customers where c_acctbal < 0
            union all
            select customer_id, cast(c_nationkey as integer), '2018-03-01 00:00:00', null, true
            from customers where c_acctbal < -500""",
        "dq_raw": _checks(
            _check("raw", "orders", "head_orders",
                   [_complete("order_id"), _unique("order_id", "head_orders"), _complete("customer_id")]),
            _check("raw", "customers", "customers", [_complete("customer_id")]),
            _check("raw", "products", "raw_products", [_complete("product_id")]),
        ),
        "dq_clean": _checks(
            _check("clean", "orders", "full_orders",
                   [_complete("order_id"), _unique("order_id", "full_orders"), _complete("customer_id")]),
            _check("clean", "order_reviews", "reviews",
                   [_complete("review_id"),
                    _holds("review_score >= 1 AND review_score <= 5")]),
            _check("clean", "order_items", "items",
                   [_complete("order_id"), _holds("price >= 0")]),
        ),
        "dq_gold": _checks(
            _check("gold", "fct_order_items", f"(select {fact_key.format(ties='')} as order_item_key, * from fact)",
                   [_complete("order_item_key"), ("unique(order_item_key)", "count(distinct order_item_key) / count(*)"),
                    _complete("customer_key"), _complete("product_key"),
                    _holds("item_price >= 0"),
                    _holds("freight_value >= 0")]),
            _check("gold", "dim_customers", "dim_customers",
                   [_complete("customer_key"), _unique("customer_key", "dim_customers")]),
        ),
        "dq_relational": _checks(
            _check("gold", "dim_customers", "dim_customers",
                   [_complete("customer_id"), _unique("customer_id", "dim_customers"), _short("customer_id", 50),
                    _short("customer_unique_id", 50), _short("customer_city", 100), _short("customer_state", 2)]),
            _check("gold", "dim_sellers", "dim_sellers",
                   [_complete("seller_id"), _unique("seller_id", "dim_sellers"), _short("seller_id", 50),
                    _short("seller_city", 100), _short("seller_state", 2)]),
            _check("gold", "dim_products", "dim_products",
                   [_complete("product_id"), _unique("product_id", "dim_products"), _short("product_id", 50),
                    _short("product_category_english", 100)]),
            _check("gold", "dim_order_status", "dim_order_status",
                   [_complete("status_name"), _unique("status_name", "dim_order_status"),
                    _short("status_name", 20)]),
            _check("gold", "dim_date", "dim_date",
                   [_complete("full_date"), _unique("date_key", "dim_date"), _short("day_of_week", 10),
                    _short("month_name", 10)]),
            _check("gold", "fct_order_items", "fact", [_complete("order_id"), _short("order_id", 50)]),
        ),
        "dq_defects": _checks(
            _check("raw", "orders", "raw_orders",
                   [_complete("order_approved_at"), _unique("customer_id", "raw_orders"),
                    _holds("order_approved_at <= order_delivered_carrier_date"),
                    _short("order_status", 8)]),
        ),
        "fk_integrity": _foreign_keys(),
        "snapshot_history": """
            select cast(version as bigint) as version, operation, rows from (
                select 0 as version, 'WRITE' as operation, (select count(*) from head_orders) as rows union all
                select 1, 'WRITE', (select count(*) from ranked_orders) union all
                select 2, 'WRITE', (select count(*) from version_two) union all
                select 3, 'RESTORE', (select count(*) from ranked_orders))""",
        "as_of_version": "select order_id, order_status from head_orders",
        "as_of_timestamp": "select * from version_two",
        "version_counts": """
            select cast(2 as bigint) as version, count(*) as row_count from version_two
            union all select 3, count(*) from ranked_orders""",
        "version_diff": """
            select order_id, case when a.order_id is null then 'added' when b.order_id is null then 'removed'
                else 'changed' end as change
            from head_orders a full join version_two b using (order_id)
            where a.order_status is distinct from b.order_status""",
        "restore": "select order_id, order_status from ranked_orders",
        "incremental_rows": "select order_id, order_status from tail_orders",
        "medallion_counts": _counts(),
        "category_funnel": """
            select product_category_english, count(distinct order_id) as orders,
                cast(sum(item_price) as double) as revenue,
                cast(sum(item_price) as double) / cast(sum(sum(item_price)) over () as double) as revenue_share
            from fact left join dim_products using (product_key) group by 1""",
        "category_rank": """
            select order_date_key // 100 as month, product_category_english,
                cast(sum(item_price) as double) as revenue,
                rank() over (partition by order_date_key // 100 order by sum(item_price) desc) as revenue_rank
            from fact left join dim_products using (product_key) group by 1, 2""",
        "aov": """
            select count(*) as items, count(distinct order_id) as orders,
                cast(sum(item_price) as double) / count(*) as value_per_item_row,
                cast(sum(item_price) as double) / count(distinct order_id) as value_per_order
            from fact join dim_order_status using (status_key) where status_name = 'delivered'""",
        "payment_mix": """
            select payment_type, count(*) as payments,
                cast(sum(cast(payment_value as decimal(18,2))) as double) as payment_value,
                avg(payment_installments) as avg_installments,
                count(*) / sum(count(*)) over () as payment_share,
                cast(sum(cast(payment_value as decimal(18,2))) as double)
                    / cast(sum(sum(cast(payment_value as decimal(18,2)))) over () as double) as value_share
            from payments group by 1""",
        "state_share": """
            select customer_state, count(distinct customer_key) as customers,
                cast(sum(item_price) as double) as revenue,
                cast(sum(item_price) as double) / cast(sum(sum(item_price)) over () as double) as revenue_share
            from fact left join dim_customers using (customer_key) group by 1""",
        "geo_grid": """
            select round(lat, 1) as cell_lat, round(lng, 1) as cell_lng, count(distinct customer_key) as customers,
                count(*) as items
            from fact left join dim_customers using (customer_key)
                left join geolocation on zip = cast(customer_zip_code_prefix as integer) group by 1, 2""",
        "geo_grid_sellers": """
            select round(lat, 1) as cell_lat, round(lng, 1) as cell_lng, count(distinct seller_key) as sellers,
                count(*) as items
            from fact left join dim_sellers using (seller_key)
                left join geolocation on zip = cast(seller_zip_code_prefix as integer) group by 1, 2""",
        "state_lanes": """
            select seller_state, customer_state, cast(floor(2 * 6371.0 * asin(sqrt(
                    power(sin(radians(c.lat - s.lat) / 2), 2)
                    + cos(radians(s.lat)) * cos(radians(c.lat)) * power(sin(radians(c.lng - s.lng) / 2), 2))) / 500)
                    * 500 as bigint) as from_km, count(*) as items
            from fact left join dim_sellers using (seller_key) left join dim_customers using (customer_key)
                left join geolocation s on s.zip = cast(seller_zip_code_prefix as integer)
                left join geolocation c on c.zip = cast(customer_zip_code_prefix as integer) group by 1, 2, 3""",
        "on_time_orders": """
            select cast(year(purchase) as integer) as order_year, with_imputed,
                count(*) filter (counted) as delivered_orders,
                count(*) filter (counted and delivered::date > estimated::date) as late_orders,
                count(*) filter (counted and delivered::date <= estimated::date)
                    / nullif(count(*) filter (counted), 0) as on_time_rate
            from (select *, delivered is not null and (with_imputed or not is_imputed) as counted
                from full_orders, (values (true), (false)) as m(with_imputed)) group by 1, 2""",
        "lane_distance": """
            select s.zip as seller_zip, c.zip as customer_zip, count(*) as items,
                cast(floor(any_value(2 * 6371.0 * asin(sqrt(
                    power(sin(radians(c.lat - s.lat) / 2), 2)
                    + cos(radians(s.lat)) * cos(radians(c.lat)) * power(sin(radians(c.lng - s.lng) / 2), 2)))))
                    as bigint) as distance_km
            from fact left join dim_sellers using (seller_key) left join dim_customers using (customer_key)
                left join geolocation s on s.zip = cast(seller_zip_code_prefix as integer)
                left join geolocation c on c.zip = cast(customer_zip_code_prefix as integer) group by 1, 2""",
        "seller_processing": """
            select seller_id, count(*) as items,
                cast(sum(processing_time_hours) as double) / count(*) as avg_hours,
                cast(quantile_disc(processing_time_hours, 0.5) as double) as median_hours
            from fact left join dim_sellers using (seller_key) where processing_time_hours is not null group by 1""",
        "lane_shipping": """
            select seller_state, customer_state, count(*) as items, avg(shipping_time_days) as avg_shipping_days
            from fact left join dim_sellers using (seller_key) left join dim_customers using (customer_key)
            group by 1, 2""",
        "on_time_rate": """
            select order_date_key // 10000 as order_year, count(delivered_date_key) as delivered_items,
                count(*) filter (delivered_date_key > estimated_delivery_date_key) as late_items,
                count(*) filter (delivered_date_key <= estimated_delivery_date_key) / count(delivered_date_key)
                    as on_time_rate
            from fact group by 1""",
        "score_dist": """
            select review_score, count(*) as items, count(*) / sum(count(*)) over () as share from fact group by 1""",
        "score_vs_delay": """
            select review_score, count(*) as items, avg(delay_days) as avg_delay_days,
                count(*) filter (delay_days > 0) / count(*) as late_share
            from delays where delay_days is not null group by 1""",
        "score_delay_corr": """
            select count(*) as items, round(corr(review_score, delay_days), 6) as correlation
            from delays where delay_days is not null""",
        "negative_words": """
            select word, count(*) as occurrences
            from (select unnest(string_split(review_comment_cleaned, ' ')) as word from cleaned_reviews
                where review_score between 1 and 3)
            where word <> '' group by 1""",
        "keyword_mentions": f"""
            select review_score, phrase, count(*) as comments,
                count(*) filter (contains(' ' || review_comment_cleaned || ' ', ' ' || phrase || ' ')) as mentions
            from cleaned_reviews, unnest([{_quoted(r.PHRASES)}]) as p(phrase)
            where review_comment_cleaned is not null group by 1, 2""",
        "one_time_buyers": """
            select order_year, count(*) as buyers, count(*) filter (n = 1) as one_time_buyers,
                count(*) filter (n = 1) / count(*) as one_time_ratio
            from (select customer_unique_id, cast(year(purchase) as integer) as order_year, count(*) as n
                from full_orders left join customers using (customer_id) group by 1, 2) group by 1""",
        "ytd_mom": """
            select m.month, cast(m.revenue as double) as revenue,
                cast(sum(m.revenue) over (partition by m.year order by m.month) as double) as revenue_ytd,
                cast(b.revenue as double) as previous_revenue,
                cast(m.revenue - b.revenue as double) as revenue_change,
                cast(m.revenue - b.revenue as double) / cast(b.revenue as double) as change_rate
            from monthly m left join monthly b
                on m.year * 12 + m.month % 100 = b.year * 12 + b.month % 100 + 1""",
        "subtotals": """
            select year, quarter, month, cast(grouping(year, quarter, month) as integer) as level, count(*) as items,
                cast(sum(item_price) as double) as revenue
            from (select year, quarter, order_date_key // 100 % 100 as month, item_price
                from fact join dim_date on order_date_key = date_key)
            group by rollup (year, quarter, month)""",
        "place_subtotals": """
            select customer_state, customer_city, cast(grouping(customer_state, customer_city) as integer) as level,
                count(*) as items, cast(sum(item_price) as double) as revenue
            from fact join dim_customers using (customer_key) group by rollup (customer_state, customer_city)""",
        "channel_seller": f"""
            select channel, seller_id, count(*) as leads, avg(won_date - first_contact_date) as avg_sales_cycle_days,
                true as is_first_channel, cast(any_value(revenue) as double) as revenue,
                any_value(hours) as avg_processing_hours
            from leads left join dim_sellers using (seller_id) left join (
                select seller_key, sum(item_price) as revenue,
                    cast(sum(processing_time_hours) as double) / count(processing_time_hours) as hours
                from fact where order_date_key // 10000 = {year}
                    and (order_date_key // 100 % 100 + 2) // 3 = {quarter} group by 1) using (seller_key)
            group by 1, 2""",
        "event_gaps": """
            select event_id, (epoch_us(ts) - lag(epoch_us(ts)) over (order by ts, event_id)) / 1000000 as gap_seconds
            from events""",
        "rfm": f"""
            select customer_unique_id,
                cast(date '{r.ANALYSIS_DATE}' - {_key_date('max(order_date_key)')} as integer) as recency_days,
                count(*) as frequency, cast(sum(value) as double) as monetary
            from per_order join dim_customers using (customer_key) group by 1""",
        "friction": """
            select customer_unique_id, sum(delay_days) / count(delay_days) as delivery_delay_days,
                cast(sum(freight_value) as double) / cast(sum(item_price) as double) as freight_ratio
            from delays join dim_customers using (customer_key) group by 1""",
        "experience": """
            select customer_unique_id, sum(score) / sum(items) as avg_review_score,
                max(payment_installments) as max_installments
            from per_order join dim_customers using (customer_key) left join payments using (order_id) group by 1""",
        "churn_label": f"""
            select customer_unique_id,
                case when count(*) filter (purchase >= timestamp '{r.CHURN_CUTOFF}'
                    and purchase < timestamp '{r.CHURN_CUTOFF}' + to_days(180)) = 0 then 1 else 0 end as churned
            from full_orders join customers using (customer_id) group by 1
            having count(*) filter (purchase < timestamp '{r.CHURN_CUTOFF}') > 0""",
        "churn_features": "select * from training",
        "churn_features_scaled": f"""
            select customer_unique_id, {', '.join(
                f"round(coalesce(({f} - avg({f}) over ()) / nullif(stddev_samp({f}) over (), 0), 0), 4) + 0.0 as {f}"
                for f in FEATURES)}
            from training""",
        "churn_scores": f"""
            select customer_unique_id, true as is_probability,
                round({_probability(r.CHURN_POINTS[1])}, 9) as churn_probability
            from training""",
        "churn_scores_boosted": f"""
            select customer_unique_id, true as is_probability,
                round(1 / (1 + exp(-2 * ({_trees(r.CHURN_TREES)}))), 9) as churn_probability
            from training""",
        "churn_gradient": " union all ".join(
            f"""
            select '{p.name}' as point, round(sum(weight * (greatest(z, 0) - z * churned + ln(1 + exp(-abs(z)))))
                    / sum(weight), 6) as loss, '{f}' as feature,
                round(sum(weight * (1 / (1 + exp(-z)) - churned) * {f or 1}) / sum(weight), 4) + 0.0 as slope
            from (select *, {_margin(p)} as z,
                count(*) over () / (2.0::double * count(*) over (partition by churned)) as weight from training)"""
            for p in r.CHURN_POINTS
            for f in ("", *p.coefficients)
        ),
        "churn_pr_curve": f"select * replace (round(precision, 9) as precision, round(recall, 9) as recall) from ({_CURVE})",
        "churn_pr_area": f"""
            select round(area, 9) as area, threshold, round(f1, 9) as f1 from (
                select sum((recall - coalesce(r0, 0)) * (precision + coalesce(p0, precision)) / 2) as area from (
                    select *, lag(recall) over (order by threshold desc) as r0,
                        lag(precision) over (order by threshold desc) as p0 from ({_CURVE}))),
                ({_BEST})""",
        "churn_alerts": f"""
            select customer_unique_id, churn_probability from ({_PUBLISHED})
            where churn_probability >= (select threshold from ({_BEST}))""",
        "churn_alert_list": f"""
            select customer_unique_id, churn_probability from ({_PUBLISHED})
            qualify row_number() over (order by churn_probability desc, customer_unique_id)
                <= count(*) over () // {r.ALERT_SHARE}""",
        "churn_models": """
            select model, cast(features as integer) as features, count(*) filter (not held) as training_people,
                count(*) filter (held) as test_people, count(*) filter (held and churned = 0) as loyal_test_people
            from (select *, ('0x' || substr(md5('7:' || customer_unique_id), 1, 8))::bigint % 5 = 0 as held
                from training), (values ('logistic', 4), ('boosted', 7)) as m(model, features) group by 1, 2""",
    }
    return {name: _statement(body) for name, body in bodies.items()}
