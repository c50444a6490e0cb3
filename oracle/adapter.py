"""The test-data adapter written as DuckDB CTEs (same rules as shipwright.sources.testbed)."""

RAW_CTES = [
    ("seed_state_regions", """
        select n.n_name as state_code, lower(n.n_name) as state_name, r.r_name as macro_region,
               'capital of ' || lower(n.n_name) as capital_city
        from nation n left join region r on n.n_regionkey = r.r_regionkey"""),
    ("raw_customers", """
        select cast(c.c_custkey as varchar) as customer_id,
               cast(c.c_custkey // 2 as varchar) as customer_unique_id,
               lpad(cast(c.c_custkey % 100 as varchar), 5, '0') as customer_zip_code_prefix,
               c.c_mktsegment as customer_city,
               lower(n.n_name) as customer_state
        from customer c left join nation n on c.c_nationkey = n.n_nationkey"""),
    ("raw_sellers", """
        select cast(s.s_suppkey as varchar) as seller_id,
               lpad(cast(s.s_suppkey % 100 as varchar), 5, '0') as seller_zip_code_prefix,
               'City ' || cast(s.s_suppkey % 7 as varchar) as seller_city,
               n.n_name as seller_state
        from supplier s left join nation n on s.s_nationkey = n.n_nationkey"""),
    ("raw_geolocation", """
        select lpad(cast(c.c_custkey % 100 as varchar), 5, '0') as geolocation_zip_code_prefix,
               -40.0::double + ((c.c_custkey * 7) % 500) / 10.0::double as geolocation_lat,
               -80.0::double + ((c.c_custkey * 13) % 500) / 10.0::double as geolocation_lng,
               c.c_mktsegment as geolocation_city, lower(n.n_name) as geolocation_state
        from customer c left join nation n on c.c_nationkey = n.n_nationkey
        where c.c_custkey % 20 <> 7
        union all
        select lpad(cast(s.s_suppkey % 100 as varchar), 5, '0'),
               -40.0::double + ((s.s_suppkey * 11) % 500) / 10.0::double,
               -80.0::double + ((s.s_suppkey * 17) % 500) / 10.0::double,
               'City ' || cast(s.s_suppkey % 7 as varchar), n.n_name
        from supplier s left join nation n on s.s_nationkey = n.n_nationkey
        where s.s_suppkey % 20 <> 7"""),
    ("raw_orders_base", """
        select o_orderkey as k, o_custkey,
               case when o_orderstatus = 'F' then 'delivered'
                    when o_orderstatus = 'O' then 'shipped'
                    when o_orderkey % 3 = 0 then 'canceled'
                    when o_orderkey % 3 = 1 then 'unavailable'
                    else 'processing' end as status,
               o_orderdate + to_seconds((o_orderkey * 7919) % 86400) as purchased
        from orders"""),
    ("raw_orders", """
        select cast(k as varchar) as order_id,
               cast(o_custkey as varchar) as customer_id,
               upper(status) as order_status,
               purchased as order_purchase_timestamp,
               case when k % 97 <> 0 then purchased + to_seconds(k % 7200) end as order_approved_at,
               case when status in ('delivered', 'shipped') and k % 97 <> 0
                    then purchased + to_seconds(k % 7200) + to_days(1 + k % 5) end as order_delivered_carrier_date,
               case when status = 'delivered' and k % 2003 <> 0
                    then purchased + to_days(3 + k % 40) + to_seconds(k % 3600) end as order_delivered_customer_date,
               cast(cast(purchased as date) + cast(15 + k % 20 as integer) as timestamp) as order_estimated_delivery_date
        from raw_orders_base"""),
    ("raw_order_items", """
        select cast(l_orderkey as varchar) as order_id,
               cast(row_number() over (partition by l_orderkey
                    order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) as bigint) as order_item_id,
               cast(l_partkey as varchar) as product_id,
               cast(l_suppkey as varchar) as seller_id,
               l_shipdate as shipping_limit_date,
               l_extendedprice as price,
               cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) as double) as freight_value
        from lineitem"""),
    ("raw_order_payments", """
        select cast(o_orderkey as varchar) as order_id, cast(1 as bigint) as payment_sequential,
               upper(case o_orderpriority when '1-URGENT' then 'credit_card' when '2-HIGH' then 'boleto'
                      when '3-MEDIUM' then 'voucher' when '4-NOT SPECIFIED' then 'debit_card'
                      when '5-LOW' then 'not_defined' end) as payment_type,
               cast(1 + o_orderkey % 10 as bigint) as payment_installments,
               o_totalprice as payment_value
        from orders
        union all
        select cast(o_orderkey as varchar), cast(2 as bigint), 'voucher', cast(1 as bigint), 10.0::double
        from orders where o_orderkey % 4 = 0"""),
    ("raw_order_reviews", """
        select cast(user_id as varchar) || '-' || cast(event_id % 3 as varchar) as review_id,
               cast(user_id as varchar) as order_id,
               cast(1 + event_id % 5 as bigint) as review_score,
               event_type as review_comment_title,
               case when event_id % 4 <> 0 then props end as review_comment_message,
               ts as review_creation_date,
               date_trunc('day', ts) as review_answer_timestamp
        from events"""),
    ("raw_products", """
        select cast(p_partkey as varchar) as product_id,
               case when p_partkey % 37 <> 0 then lower(p_type) end as product_category_name,
               cast(length(p_name) as bigint) as product_name_lenght,
               cast(length(p_brand) * 10 as bigint) as product_description_lenght,
               1 + p_partkey % 4 as product_photos_qty,
               case when p_partkey % 50 <> 0 then p_size * 100.0::double end as product_weight_g,
               10.0::double + p_size % 30 as product_length_cm,
               2.0::double + p_size % 15 as product_height_cm,
               5.0::double + p_size % 20 as product_width_cm
        from part"""),
    ("raw_category_translation", """
        select distinct lower(p_type) as product_category_name, lower(p_type) || '_goods' as product_category_name_english
        from part where p_type not in ('PROMO', 'STANDARD')"""),
]
